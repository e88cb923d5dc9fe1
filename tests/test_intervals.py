import random

from longtab.operators import coverage as COV
from longtab.operators import intervals as IV


def _brute_merge(iv):
    out = []
    for s, e in sorted(iv):
        if e <= s:
            continue
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [tuple(x) for x in out]


def _brute_depth(iv):
    cover = {}
    for s, e in iv:
        for p in range(s, e):
            cover[p] = cover.get(p, 0) + 1
    return cover


def _random_intervals(seed, n=120, span=400):
    rnd = random.Random(seed)
    return [(s, s + rnd.randint(1, 40)) for s in (rnd.randint(0, span) for _ in range(n))]


def test_merge_matches_brute_force_for_any_chunk(spark):
    iv = _random_intervals(1) + [(500, 510), (510, 520)]          # touching intervals merge
    df = spark.createDataFrame([("k", s, e) for s, e in iv], "ref_id string, start long, stop long")
    want = _brute_merge(iv)
    for chunk in (7, 64, 1 << 20):
        got = sorted((r.start, r.stop) for r in IV.merge_intervals(df, ["ref_id"], chunk=chunk).collect())
        assert got == want, chunk
    assert (500, 520) in want


def test_islands_across_many_chunks(spark):
    rnd = random.Random(7)
    keys = {"one long": [(3, 900), (5, 6), (400, 410), (901, 902), (950, 960)],
            "chain": [(i, i + 10) for i in range(0, 500, 10)], "touching at chunk ends": [(0, 8), (8, 16), (17, 24), (24, 25), (32, 33)],
            "nested": [(0, 100), (10, 20), (90, 95), (99, 300), (100, 101), (301, 302)]}
    for i in range(30):
        keys[f"r{i}"] = [(a, a + rnd.choice((1, 2, 3, 40, 200))) for a in (rnd.randint(0, 600) for _ in range(rnd.randint(1, 40)))]
    df = spark.createDataFrame([(k, s, e) for k, iv in keys.items() for s, e in iv], "ref_id string, start long, stop long")
    for chunk in (8, 33):
        got = {}
        for r in IV.merge_intervals(df, ["ref_id"], chunk=chunk).collect():
            got.setdefault(r.ref_id, []).append((r.start, r.stop))
        assert {k: sorted(v) for k, v in got.items()} == {k: _brute_merge(iv) for k, iv in keys.items()}, chunk


def test_depth_runs_match_brute_force(spark):
    iv = _random_intervals(2)
    df = spark.createDataFrame([("k", s, e) for s, e in iv], "ref_id string, start long, stop long")
    cover = _brute_depth(iv)
    for chunk in (5, 50, 1 << 20):
        runs = IV.depth_runs(df, ["ref_id"], chunk=chunk).collect()
        lo, hi = min(s for s, _ in iv), max(e for _, e in iv)
        seen = {}
        for r in runs:
            for p in range(r.start, r.stop):
                seen[p] = r.depth
        assert all(seen.get(p, 0) == cover.get(p, 0) for p in range(lo, hi)), chunk
        # runs are maximal: neighbours differ in depth
        rs = sorted((r.start, r.stop, r.depth) for r in runs)
        assert all(a[1] != b[0] or a[2] != b[2] for a, b in zip(rs, rs[1:]))


def test_depth_stats_trimmed_mean_brute_force(spark):
    iv = _random_intervals(3, n=60, span=200)
    length = 300
    df = spark.createDataFrame([("k", s, e) for s, e in iv], "ref_id string, start long, stop long")
    runs = IV.depth_runs(df, ["ref_id"])
    L = spark.createDataFrame([("k", length)], "ref_id string, length long")
    r = IV.depth_stats(runs, L, ["ref_id"]).first()
    cover = _brute_depth(iv)
    depths = sorted(cover.get(p, 0) for p in range(length))
    lo, hi = int(length * 0.05), length - int(length * 0.05)
    assert abs(r.trimmed_mean - sum(depths[lo:hi]) / (hi - lo)) < 1e-12
    assert r.covered_bases == sum(1 for d in depths if d > 0)
    assert r.depth_sum == sum(depths)


def test_overlap_join_matches_nested_loop(spark):
    a = _random_intervals(4, n=80)
    b = _random_intervals(5, n=80)
    left = spark.createDataFrame([("k", i, s, e) for i, (s, e) in enumerate(a)],
                                 "ref_id string, a_id long, start long, stop long")
    right = spark.createDataFrame([("k", j, s, e) for j, (s, e) in enumerate(b)],
                                  "ref_id string, b_id long, g_start long, g_stop long")
    want = sorted((i, j) for i, (s, e) in enumerate(a) for j, (gs, ge) in enumerate(b) if s < ge and gs < e)
    for size in (3, 16, 4096):
        got = sorted((r.a_id, r.b_id) for r in
                     IV.overlap_join(left, right, ["ref_id"], ("start", "stop"), ("g_start", "g_stop"), size).collect())
        assert got == want, size


def test_coverage_of_intervals_that_a_join_dealt_out(spark):
    """Intervals kept by a join on their reference come dealt out by it, and so do the parts that are united after."""
    rnd = random.Random(1)
    rows = [(f"S{rnd.randint(0, 2)}", f"r{rnd.randint(0, 9)}", s := rnd.randint(0, 900), s + rnd.randint(1, 120)) for _ in range(400)]
    iv = spark.createDataFrame(rows, "sample_id string, ref_id string, start long, stop long")
    lengths = spark.createDataFrame([(f"r{i}", 1100) for i in range(10)], "ref_id string, length long")
    kept = spark.createDataFrame([(f"r{i}",) for i in range(8)], "ref_id string")
    want = {}
    for s, r, a, b in rows:
        if r < "r8":
            for key in ((s, r), ("*", r)):
                want.setdefault(key, set()).update(range(a, b))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for chunk in (1 << 20, 50):
            merged = IV.merge_intervals(iv.join(kept, "ref_id", "left_semi"), ["sample_id", "ref_id"], chunk=chunk)
            got = {(r.sample_id, r.ref_id): r.covered for r in COV.consolidate(merged, lengths, chunk=chunk).collect()}
            assert got == {k: len(v) for k, v in want.items()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
