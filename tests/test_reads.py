import random

from longtab.operators import reads as RD


def _rc(s):
    return s[::-1].translate(str.maketrans("ACGT", "TGCA"))


def _brute_hit(seq, adapters, width, m):
    best = None
    for aid, orient, a in adapters:
        for o in range(0, width + 1):
            if o + len(a) > len(seq):
                break
            if sum(x != y for x, y in zip(seq[o:o + len(a)], a)) <= m:
                cand = (o, aid, orient)
                best = cand if best is None or cand < best else best
                break
    return best


def test_hamming_search_matches_brute_force(spark):
    rnd = random.Random(3)
    adapters = {"adp_a": "ACGTTGCAAGGT", "adp_b": "TTTTGGGGCCAA"}
    ads = []
    for k, v in sorted(adapters.items()):
        ads += [(k, "+", v), (k, "-", _rc(v))]
    rows = []
    for i in range(150):
        core = "".join(rnd.choice("ACGT") for _ in range(rnd.randint(5, 120)))
        a = rnd.choice(list(adapters.values()))
        a_mut = "".join(ch if rnd.random() > 0.1 else rnd.choice("ACGT") for ch in a)
        pre = "".join(rnd.choice("ACGT") for _ in range(rnd.randint(0, 8)))
        rows.append(("s", f"r{i}", pre + a_mut + core + _rc(a_mut), "I" * 1))
    reads = spark.createDataFrame(rows, "sample_id string, read_id string, seq string, qual string")
    ad_df = spark.createDataFrame(sorted(adapters.items()), "adapter_id string, seq string")
    for m in (0, 2):
        got = {r.read_id: r for r in RD.find_adapters(reads, ad_df, window=20, mismatches=m).collect()}
        for _, rid, seq, _ in rows:
            want5 = _brute_hit(seq, ads, 20, m)
            want3 = _brute_hit(seq[::-1], [(i, o, a[::-1]) for i, o, a in ads], 20, m)
            h5, h3 = got[rid].hit5, got[rid].hit3
            assert (None if h5 is None else (h5.offset, h5.id, h5.orient)) == want5
            assert (None if h3 is None else (h3.offset, h3.id, h3.orient)) == want3


def test_trim_symmetric(spark):
    a = "ACGTTGCAAGGT"
    reads = spark.createDataFrame([("s", "r1", "GG" + a + "CCCCAAAA" + _rc(a), "I" * 34),
                                   ("s", "r2", "CCCCAAAA", "I" * 8)],
                                  "sample_id string, read_id string, seq string, qual string")
    ad = spark.createDataFrame([("x", a)], "adapter_id string, seq string")
    out = {r.read_id: (r.outcome, r.seq) for r in RD.trim_adapters(reads, ad, "SYMMETRIC", 10, 0).collect()}
    assert out == {"r1": ("trimmed", "CCCCAAAA"), "r2": ("none", None)}


def test_trim_neighbors(spark):
    ads = [("a1", "ACGTTGCAAGGT"), ("a2", "TTTTGGGGCCAA"), ("a3", "GATCGATCCTAG")]
    ins = "CCCCAAAA"
    reads = spark.createDataFrame(
        [("s", "adj", ads[0][1] + ins + _rc(ads[1][1]), "I" * 32),
         ("s", "far", ads[0][1] + ins + _rc(ads[2][1]), "I" * 32),
         ("s", "same", ads[1][1] + ins + _rc(ads[1][1]), "I" * 32)],
        "sample_id string, read_id string, seq string, qual string")
    ad = spark.createDataFrame(ads, "adapter_id string, seq string")
    plain = {r.read_id: r.outcome for r in RD.trim_adapters(reads, ad, "ASYMMETRIC", 10, 0).collect()}
    near = {r.read_id: r.outcome for r in RD.trim_adapters(reads, ad, "ASYMMETRIC", 10, 0, neighbors=True).collect()}
    assert plain == {"adj": "trimmed", "far": "trimmed", "same": "none"}
    assert near == {"adj": "trimmed", "far": "none", "same": "none"}


def test_adapter_set_ids(spark):
    files = spark.createDataFrame([("twist.fasta", "tw_1", "AAAA")], "file_name string, adapter_id string, seq string")
    got = sorted(map(tuple, RD.adapter_set("CCGG, twist.fasta,,ttaa", files).collect()))
    assert got == [(1, "adapter_CCGG_1", "CCGG"), (2, "tw_1", "AAAA"), (4, "adapter_ttaa_4", "TTAA")]


def test_dedup_strand_and_quality(spark):
    s = "AACCGGTTA"
    rows = [("x", "r2", s, "IIIIIIIII"), ("x", "r1", _rc(s), "#########"), ("x", "r3", "GGGG", "IIII")]
    reads = spark.createDataFrame(rows, "sample_id string, read_id string, seq string, qual string")
    out = {r.read_id: r.dup_count for r in RD.dedup_reads(reads).collect()}
    assert out == {"r2": 2, "r3": 1}


def test_kmer_screen_brute_force(spark):
    rnd = random.Random(5)
    ref = "".join(rnd.choice("ACGT") for _ in range(300))
    reads = [("s", f"r{i}", (ref[rnd.randint(0, 200):][:rnd.randint(10, 90)] if i % 2 else
                             "".join(rnd.choice("ACGT") for _ in range(60)))) for i in range(40)]
    k = 8
    ref_k = {ref[i:i + k] for i in range(len(ref) - k + 1)}
    df = spark.createDataFrame(reads, "sample_id string, read_id string, seq string")
    rdf = spark.createDataFrame([(ref,)], "seq string")
    got = {r.read_id: (r.n_kmers, r.n_shared) for r in RD.kmer_screen(df, rdf, k, 0.5).collect()}
    for _, rid, s in reads:
        ks = [s[i:i + k] for i in range(len(s) - k + 1)]
        assert got[rid] == (len(ks), sum(1 for x in ks if x in ref_k))


def test_kmers_of_pieces_equal_those_of_the_whole(spark):
    rnd = random.Random(8)
    rows = [(f"r{n}", "".join(rnd.choice("ACGT") for _ in range(n))) for n in (0, 4, 5, 14, 15, 16, 333)]
    df = spark.createDataFrame(rows + [("none", None)], "read_id string, seq string")
    brute = sorted((r, s[i:i + 5].encode()) for r, s in rows for i in range(len(s) - 4))
    for chunk in (1, 10, 1 << 16):
        assert sorted((r.read_id, bytes(r.kmer)) for r in RD.kmers(df, ["read_id"], 5, chunk=chunk).collect()) == brute


def test_adapter_seeds_meet_windows_in_the_tasks(spark, monkeypatch):
    """A small set of adapters goes to the tasks, so no stretch of a read moves; a set beyond SEED_ROWS has the same hits by a shuffle."""
    import random
    rnd = random.Random(5)
    dna = lambda n: "".join(rnd.choices("ACGT", k=n))
    ads = [("a", "ACGTTGCAAC"), ("b", dna(22)), ("c", dna(31))]
    rows = [("S", f"r{i}", dna(i % 7) + ads[i % 3][1] + dna(150) + ads[(i + 1) % 3][1][::-1].translate(str.maketrans("ACGT", "TGCA")) + dna(i % 5))
            for i in range(30)] + [(None, "r0", dna(40)), ("S", None, ads[1][1]), ("S", "short", "ACG")]
    reads = spark.createDataFrame([(*r, "I" * len(r[2])) for r in rows], "sample_id string, read_id string, seq string, qual string")
    adapters = spark.createDataFrame(ads, "adapter_id string, seq string")
    found = lambda: sorted(map(str, RD.find_adapters(reads, adapters).collect()))
    plan = RD.find_adapters(reads, adapters)._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin [side" in plan, plan
    small = found()
    monkeypatch.setattr(RD, "SEED_ROWS", 0)
    assert "BroadcastHashJoin [side" not in RD.find_adapters(reads, adapters)._jdf.queryExecution().sparkPlan().toString()
    assert found() == small


def test_kmers_are_cut_from_small_pieces(spark):
    """No k-mer is taken from a long row's whole value (which is copied each time): rows hold KMER_PIECE k-mers when theirs are cut."""
    rnd = random.Random(4)
    for n in (RD.KMER_PIECE + 6, RD.KMER_PIECE + 7, 5 * RD.KMER_PIECE + 3, RD.KMER_CHUNK + 300):
        s = "".join(rnd.choices("ACGT", k=n))
        got = RD.kmers(spark.createDataFrame([("r", s)], "id string, seq string"), ["id"], 7)
        assert sorted(bytes(r.kmer) for r in got.collect()) == sorted(s[i:i + 7].encode() for i in range(n - 6))
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Generate explode") == 3      # chunks, small pieces, places
