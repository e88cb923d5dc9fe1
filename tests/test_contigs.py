from pyspark.sql import functions as F

from longtab.operators import contigs as CT


def test_circular_predicate_quirk(spark):
    df = spark.createDataFrame([("c",), ("xc",), ("ctg1l",), ("ctg000038c",)], "contig_id string")
    got = [r.contig_id for r in df.filter(CT.is_circular("contig_id")).collect()]
    assert got == ["xc", "ctg000038c"]


def _one_contig(spark, n_bases, cid="s1.ctg000001c"):
    return spark.createDataFrame([("S", cid, "A" * n_bases)], "sample_id string, contig_id string, seq string")


def test_small_circular_boundary(spark):
    # header ">" + 13-char id + "\n" = 15 bytes; choose L so the file is 523,264 and 523,265 bytes
    cid = "s1.ctg000001c"
    def size(L):
        return len(cid) + 2 + L + -(-L // 60)
    L1 = next(L for L in range(514000, 516000) if size(L) == 523264)
    small = CT.split_circular(_one_contig(spark, L1, cid)).first().kind
    assert small == "small_LCG"
    L2 = next(L for L in range(L1, L1 + 10) if size(L) == 523265 or size(L) == 523266)
    assert CT.split_circular(_one_contig(spark, L2, cid)).first().kind == "LCG"


def test_small_circular_stays_in_nolcg_and_gate(spark):
    contigs = spark.createDataFrame(
        [("S", "a1c", "A" * 100), ("S", "a2l", "C" * 50), ("T", "b1l", "G" * 10)],
        "sample_id string, contig_id string, seq string")
    lcg = CT.split_circular(contigs)
    nolcg = CT.non_circular(contigs, lcg)
    assert sorted(r.contig_id for r in nolcg.collect()) == ["a1c", "a2l", "b1l"]   # small circular kept
    gate = {r.sample_id: (r.nolcg_bytes, r.passed) for r in CT.binning_gate(nolcg, lcg, 160).collect()}
    # unwrapped (no large circular): id + 2 + L + 1 per record
    assert gate["S"] == (3 + 2 + 100 + 1 + 3 + 2 + 50 + 1, True)
    assert gate["T"] == (3 + 2 + 10 + 1, False)


def test_best_bin_threshold_and_ties(spark):
    bins = spark.createDataFrame(
        [("S", "MetaBAT", "c1", "bin.1", 0.9), ("S", "CONCOCT", "c1", "concoct.1", 0.9),
         ("S", "MaxBin", "c2", "maxbin.1", 0.5), ("S", "MetaBAT", "c3", "bin.lowDepth", 0.99)],
        "sample_id string, binner string, contig_id string, bin_id string, score double")
    best = {r.contig_id: (r.binner, r.bin_id) for r in CT.best_bin(CT.drop_pseudo_bins(bins)).collect()}
    assert best == {"c1": ("CONCOCT", "concoct.1")}          # tie -> smaller binner; 0.5 is not > 0.5


def test_binner_files_take_their_own_columns(spark, tmp_path):
    (tmp_path / "s 1.concoct.tsv").write_text("c1\tbin.1\n\nc2\n")
    (tmp_path / "s 1.maxbin2.tsv").write_text("c1\tm.1\textra\r\n\tm.2\n")
    (tmp_path / "s+2.metabat2.tsv").write_text("c1\tx\ty\tbin.7\nc2\tbin.8\n")
    (tmp_path / "s3.other.tsv").write_text("c1\tb\n")
    good, bad = CT.read_binner_files_checked(spark, str(tmp_path))
    assert sorted(map(tuple, good.collect())) == [("s 1", "CONCOCT", "c1", "bin.1"), ("s 1", "MaxBin", "c1", "m.1"),
                                                  ("s+2", "MetaBAT", "c1", "bin.7")]
    assert sorted((r.line, r.reason) for r in bad.collect()) == [
        ("\tm.2", "empty contig or bin"), ("c1\tb", "unknown binner"), ("c2", "too few columns"), ("c2\tbin.8", "too few columns")]
    CT.write_binner_files(good, str(tmp_path / "again"))
    back, none = CT.read_binner_files_checked(spark, str(tmp_path / "again"))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, good.collect())) and none.count() == 0
