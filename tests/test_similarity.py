import math
import random

import numpy as np

from longtab.operators import similarity as SM


def _sequential(sk, score, k, s, thr):
    order = sorted(sk, key=lambda g: (-score[g], g))
    def ani(a, b):
        u = sorted(sk[a] | sk[b])[:s]
        j = sum(1 for h in u if h in sk[a] and h in sk[b]) / len(u)
        return 1 + math.log(2 * j / (1 + j)) / k if j > 0 else None
    reps, out = [], {}
    for g in order:
        if not any((ani(g, r) or 0) >= thr for r in reps):
            reps.append(g)
    for g in order:                            # members join the closest representative, ties to the better-ranked
        out[g] = g if g in reps else max(reps, key=lambda r: (ani(g, r) or 0, -reps.index(r)))
    return out


def test_dereplicate_equals_sequential_greedy(spark):
    rnd = random.Random(11)
    base = ["".join(rnd.choice("ACGT") for _ in range(400)) for _ in range(6)]
    rows = []
    for i in range(40):
        b = base[i % 6]
        seq = "".join(ch if rnd.random() > 0.004 * (i % 5) else rnd.choice("ACGT") for ch in b)
        if i % 7 == 0:                                 # some share only a common block
            seq = base[(i + 1) % 6][:60] + "".join(rnd.choice("ACGT") for _ in range(300))
        rows.append((f"g{i:02d}", seq, float(rnd.randint(0, 9))))
    g = spark.createDataFrame(rows, "genome_id string, seq string, score double")
    k, s, thr = 15, 32, 0.97
    sk_df = SM.sketches(g, k, s, "xxhash64")
    sk = {}
    for r in sk_df.collect():
        sk.setdefault(r.genome_id, set()).add(r.h)
    score = {r[0]: r[2] for r in rows}
    want = _sequential(sk, score, k, s, thr)
    got = {r.genome_id: r.rep_id for r in SM.dereplicate(sk_df, g.select("genome_id", "score"), thr, k, s).collect()}
    assert got == want
    assert 1 < len(set(want.values())) < len(want)


def test_sketch_is_bottom_s_of_canonical_hashes(spark):
    seq = "ACGTTGCAACGGTACCATGACGTAGGCTAGCTAGGACT"
    g = spark.createDataFrame([("g", seq)], "genome_id string, seq string")
    k, s = 5, 6
    from pyspark.sql import functions as F
    kms = [seq[i:i + k] for i in range(len(seq) - k + 1)]
    canon = [min(x, x[::-1].translate(str.maketrans("ACGT", "TGCA"))) for x in kms]
    hs = spark.createDataFrame([(c,) for c in canon], "c string").select(F.xxhash64("c").alias("h")).distinct()
    want = sorted(r.h for r in hs.collect())[:s]
    got = sorted(r.h for r in SM.sketches(g, k, s, "xxhash64").collect())
    assert got == want


def test_registered_queries_use_the_operators_parameters(spark, tmp_path):
    import __spark_entry__ as E
    rnd = random.Random(3)
    base = [rnd.choice("ACGT") for _ in range(6000)]
    rows = []
    for i, changes in enumerate((0, 10, 160)):         # ANI to the first about 0.998 and 0.97
        seq = list(base)
        for p in rnd.sample(range(6000), changes):
            seq[p] = {"A": "C", "C": "G", "G": "T", "T": "A"}[seq[p]]
        rows.append((i, "".join(seq), "en", "a", 6000))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    sk = E.queries()["genome_sketch_full"](spark, str(tmp_path)).groupBy("genome_id").count().collect()
    assert {r["count"] for r in sk} == {SM.SKETCH_SIZE} and len(sk) == 3
    assert f"r <= {SM.SKETCH_SIZE}" in E.oracle_sql()["genome_sketch_full"]
    got = {r.genome_id: r.rep_id for r in E.queries()["dereplicate"](spark, str(tmp_path)).collect()}
    assert got["d2"] == "d2" and got["d0"] == got["d1"]


def test_pairs_hold_every_representative_at_or_above_the_threshold(spark):
    rnd = random.Random(7)
    base = "".join(rnd.choice("ACGT") for _ in range(900))
    rows = []
    for i in range(30):                                # windows that slide over one sequence: several representatives are near
        seq = "".join(ch if rnd.random() > 0.002 else rnd.choice("ACGT") for ch in base[i * 12:i * 12 + 500])
        rows.append((f"g{i:02d}", seq, float(rnd.randint(0, 9))))
    g = spark.createDataFrame(rows, "genome_id string, seq string, score double")
    scores, (k, s, thr) = g.select("genome_id", "score"), (15, 64, 0.985)
    sk_df = SM.sketches(g, k, s, "xxhash64").cache()
    sk = {}
    for r in sk_df.collect():
        sk.setdefault(r.genome_id, set()).add(r.h)
    rep_of = _sequential(sk, {r[0]: r[2] for r in rows}, k, s, thr)
    want = {}
    for a in sk:
        for b in set(rep_of.values()) - {a}:
            u = sorted(sk[a] | sk[b])[:s]
            j = sum(1 for h in u if h in sk[a] and h in sk[b]) / len(u)
            if j > 0 and 1 + math.log(2 * j / (1 + j)) / k >= thr:
                want[a, b] = (j, rep_of[a] == b)
    got = {(r.a, r.b): (r.j, r.is_member) for r in SM.representative_pairs(sk_df, scores, thr, k, s).collect()}
    assert got == want and len(want) > sum(m for _, m in want.values()) > 0
    edges = {(r.a, r.b) for r in SM.leader_edges(sk_df, scores, k, s).collect()}
    assert set(want) - edges                           # what the leaders' edges alone miss
    assert SM.representative_pairs(sk_df.limit(0), scores, thr, k, s).count() == 0 == SM.dereplicate(sk_df.limit(0), scores, thr, k, s).count()


def test_registered_pairs_match_the_oracle_over_all_pairs(spark):
    import duckdb
    import __spark_entry__ as E
    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.001/documents.parquet'")
    want = con.execute(E.oracle_sql()["genome_pairs"]).fetchall()
    got = E.queries()["genome_pairs"](spark, "/root/testdata/sf0.001").collect()
    assert sorted(map(tuple, got)) == sorted(want) and want


def test_sketches_hash_inside_the_row(spark):
    """Rows that move hold a piece's s smallest hashes; repeated genomes and k-mers, long rows and both strands agree with brute force."""
    import hashlib
    rnd = random.Random(6)
    rc = lambda x: x[::-1].translate(str.maketrans("ACGT", "TGCA"))
    dna = lambda n: "".join(rnd.choices("ACGT", k=n))
    rows = [("g1", dna(700)), ("g1", dna(300)), ("g2", dna(66_000)), ("g3", "ACGTT" * 400 + dna(30)), ("g4", "ACG"), ("g5", dna(9)), (None, dna(50)), ("g6", None)]
    k, s = 9, 40
    want = {}
    for g, q in rows:
        for i in range(len(q or "") - k + 1):
            want.setdefault(g, set()).add(int(hashlib.md5(min(q[i:i + k], rc(q[i:i + k])).encode()).hexdigest()[:15], 16))
    df = spark.createDataFrame(rows, "genome_id string, seq string")
    assert all(len(r.low) <= s for r in SM._piece_sketches(df, k, s, "md5", "genome_id").collect())
    got = {r.genome_id: r.hs for r in SM.packed_sketches(df, k, s).collect()}
    assert got == {g: sorted(h)[:s] for g, h in want.items()}


def test_chain_of_shared_hashes_takes_few_rounds(spark):
    """Genomes that share a prefix hash each with the next, but are unlike, don't wait for one another one round each."""
    n, size = 40, 8
    rows = [(f"g{i:02d}", h) for i in range(n) for h in [i, i + 1, *range(1000 + 10 * i, 1000 + 10 * i + size)]]
    sk = spark.createDataFrame(rows, "genome_id string, h long")
    scores = spark.createDataFrame([(f"g{i:02d}", float(n - i)) for i in range(n)], "genome_id string, score double")
    out = SM.dereplicate(sk, scores, 0.9, 21, 64).collect()
    assert len(out) == n and all(r.is_rep for r in out)
    assert max(r.round for r in out) <= 3


def test_codes_hold_the_hashes_in_less_room(spark):
    """Sketches are kept as the letters they come from where that is shorter, in any alphabet, and decode to the same hashes."""
    import hashlib
    from longtab.functions import kmerhash as KH
    rnd = random.Random(9)
    rc = lambda x: x[::-1].translate(bytes.maketrans(b"ACGT", b"TGCA"))
    for k, s in ((3, 5), (21, 200), (24, 1000), (70, 50)):
        seqs = [bytes(rnd.choices(a, k=n)) for a in (b"ACGT", b"ACGTNacg") for n in (k, k + 1, 700, 3000)] + [b"ACGTT" * 300]
        want = [sorted({int(hashlib.md5(min(q[i:i + k], rc(q[i:i + k]))).hexdigest()[:15], 16) for i in range(len(q) - k + 1)})[:s] for q in seqs]
        codes = list(KH.codes_of_sequences(seqs, k, s))
        assert [h.tolist() for h in KH.decoded([c for c, _ in codes])] == want and [n for _, n in codes] == [len(w) for w in want]
        for x, y in zip(want, want[1:]):
            u = sorted({*x, *y})[:s]
            a, b = KH.decoded([KH.code_of_hashes(np.array(z)) for z in (x, y)])
            assert KH.jaccard(a, b, s) == sum(h in x and h in y for h in u) / len(u)
    g = spark.createDataFrame([(i, "".join(rnd.choices("ACGT", k=2500))) for i in range(20)], "genome_id long, seq string")
    rows = SM.coded_sketches(g).collect()
    assert all(r.n == 1000 and len(r.code) < 1200 for r in rows) and len(rows) == 20     # 8000 bytes of hashes


def test_what_a_round_writes_leaves_no_shuffle_files(spark):
    from longtab.session import cut_lineage
    files = lambda: spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().size()
    spark.range(10).count()
    before = files()
    out = cut_lineage(spark.range(1000).selectExpr("id % 50 AS g").groupBy("g").count(), "free", free=True)
    assert out.count() == 50 and files() <= before + 4           # those of the counts' own jobs


def test_crowds_that_share_passages_equal_the_sequential_greedy(spark):
    """Near copies in groups whose genomes also share long passages with better genomes of other groups."""
    rnd = random.Random(21)
    dna = lambda n: "".join(rnd.choices("ACGT", k=n))
    passages, rows = [dna(60) for _ in range(4)], []
    for group in range(12):
        base = "".join(dna(60) + rnd.choice(passages) for _ in range(4))
        for i in range(6):
            rows.append((f"g{group:02d}{i}", "".join(c if rnd.random() > 0.002 * i else rnd.choice("ACGT") for c in base), float(rnd.randint(0, 9))))
    rows.append(("lone", dna(300), 3.0))
    g = spark.createDataFrame(rows, "genome_id string, seq string, score double")
    k, s, thr = 15, 200, 0.985
    sk_df, sk = SM.coded_sketches(g, k, s).cache(), {}
    for r in SM.sketches(g, k, s).collect():
        sk.setdefault(r.genome_id, set()).add(r.h)
    want = _sequential(sk, {r[0]: r[2] for r in rows}, k, s, thr)
    for pairs in (0, 2):
        before, SM.PAIRS = SM.PAIRS, pairs
        try:
            got = {r.genome_id: r.rep_id for r in SM.dereplicate(sk_df, g.select("genome_id", "score"), thr, k, s).collect()}
        finally:
            SM.PAIRS = before
        assert got == want and 12 < len(set(want.values())) < len(want)
