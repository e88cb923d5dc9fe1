import random

from longtab.operators import lookup as LK


def rule(name, table):
    """The documented matching rule, written independently as a loop (table: key -> (sample, ord))."""
    if name in table:
        return table[name][0]
    for sep in ("_", "."):
        cut = [i for i, ch in enumerate(name) if ch == sep]
        for i in reversed(cut):
            if name[:i] in table:
                return table[name[:i]][0]
    for key, (sample, _) in sorted(table.items(), key=lambda kv: kv[1][1]):
        if name.startswith(key):
            return sample
    return None


def test_prefix_rule_against_loop(spark):
    rnd = random.Random(7)
    alpha = "ab_."
    keys = {"".join(rnd.choice(alpha) for _ in range(rnd.randint(1, 4))) for _ in range(25)}
    prep = [(f"S{i}", k, i) for i, k in enumerate(sorted(keys))]
    prep.append(("LAST", sorted(keys)[0], 999))               # duplicated prefix: last sample wins
    names = ["".join(rnd.choice(alpha) for _ in range(rnd.randint(1, 9))) for _ in range(400)]
    table = {}
    for s, k, o in prep:
        table[k] = (s, min(o, table.get(k, (None, o))[1]))
    lk = LK.build_lookup(spark.createDataFrame(prep, "sample_name string, run_prefix string, ord long"))
    files = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "file_no long, file_name string")
    got = {r.file_no: r.sample_id for r in LK.match_files(files, lk).collect()}
    assert all(got[i] == rule(n, table) for i, n in enumerate(names))


def test_reference_fixture_case(spark):
    prep = spark.createDataFrame([("SKB8.640193", "S22205_S104", 0), ("SKD8.640184", "S22282_S102", 1)],
                                 "sample_name string, run_prefix string, ord long")
    files = spark.createDataFrame([(0, "S22205_S104_L001_R1_001.fastq.gz"), (1, "S22282_S102_L001_R1_001.fastq.gz"),
                                   (2, "nomatch.fastq.gz")], "file_no long, file_name string")
    got = {r.file_no: (r.sample_id, r.tier) for r in LK.match_files(files, LK.build_lookup(prep)).collect()}
    assert got == {0: ("SKB8.640193", 1), 1: ("SKD8.640184", 1), 2: (None, None)}


def test_artifacts_expand_to_tasks_and_errors(spark):
    asked = spark.createDataFrame([(1,), (2,), (3,), (1,)], "artifact_id long")
    tree = spark.createDataFrame([(1, 11), (2, 12), (2, 13), (1, 11)], "artifact_id long, parent_id long")
    files = spark.createDataFrame([(11, "/a/s1_R1.fq", "fwd"), (11, "/a/s2_R1.fq", "fwd"), (11, "/a/s1_R2.fq", "rev"),
                                   (12, "/b/s1_R1.fq", "fwd"), (12, "/b/s2_R1.fq", "fwd"), (12, "/b/zz.fq", "fwd")], "artifact_id long, path string, kind string")
    preps = spark.createDataFrame([(11, "A1", "s1", 1), (11, "A2", "s2", 2), (12, "B1", "s1", 1), (12, "B2", "s2", 2)],
                                  "artifact_id long, sample_name string, run_prefix string, ord long")
    tasks, errors = LK.expand_artifacts(asked, tree, files, preps)
    assert sorted(map(tuple, tasks.collect())) == [(1, 11, "A1", "/a/s1_R1.fq"), (1, 11, "A2", "/a/s2_R1.fq"),
                                                   (2, 12, "B1", "/b/s1_R1.fq"), (2, 12, "B2", "/b/s2_R1.fq")]
    assert sorted((r.artifact_id, r.reason) for r in errors.collect()) == [(2, "no files"), (2, "no sample"), (3, "no parents")]
    none = preps.limit(0)
    assert {r.reason for r in LK.expand_artifacts(asked, tree, files, none)[1].collect()} == {"no files", "no parents", "no preparation"}
