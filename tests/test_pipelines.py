import random

from longtab import pipelines as PL
from longtab.operators import coverage as COV

ALN = "sample_id string, read_id string, flag int, ref_id string, pos long, mapq int, cigar string, tag_nm long"


def test_profile_reports_missing_samples(spark):
    aln = spark.createDataFrame([("a", "r1", 0, "g1", 1, 60, "100=", 0), ("a", "r2", 0, "g2", 11, 60, "100=", 0),
                                 ("a", "r3", 0, "g1", 1, 60, "50=50S", 0)], ALN)
    lengths = spark.createDataFrame([("g1", 200), ("g2", 400)], "ref_id string, length long")
    genes = spark.createDataFrame([("g1", "p1", 0, 100)], "ref_id string, gene_id string, start long, stop long")
    maps = spark.createDataFrame([("ko", "p1", "K1"), ("ec", "K1", "E1")], "map string, source string, target string")
    manifest = spark.createDataFrame([("a",), ("b",)], "sample_id string")
    out = PL.profile(aln, lengths, genes, maps, manifest)
    got = {(r["rank"], r.feature_id): r.value for r in out["table"].collect()}
    assert got == {("none", "g1"): 1.0, ("none", "g2"): 1.0, ("per-gene", "p1"): 1.0, ("ko", "K1"): 1.0, ("ec", "E1"): 1.0}
    assert {r.sample_id: r.outcome for r in out["verdict"].collect()} == {"a": "ok", "b": "missing"}
    assert {(r.sample_id, r.ref_id): r.fraction for r in out["coverage"].collect()}[("*", "g1")] == 0.5


def test_genome_depth_over_several_contigs(spark):
    aln = spark.createDataFrame([("a", "r1", 0, "c1", 1, 60, "100=", 0), ("a", "r1", 0, "c2", 1, 60, "50=", 0),
                                 ("a", "r2", 0, "c2", 1, 60, "50=", 0), ("a", "r3", 0, "c9", 1, 60, "50=", 0)], ALN)
    lengths = spark.createDataFrame([("c1", 100), ("c2", 100), ("c3", 200)], "ref_id string, length long")
    genomes = spark.createDataFrame([("c1", "G"), ("c2", "G"), ("c3", "G")], "ref_id string, genome_id string")
    (r,) = COV.genome_depth(aln, lengths, lo=0.0, hi=1.0, genomes=genomes).collect()
    assert (r.genome_id, r.covered_bases, r.length, r.read_count) == ("G", 150, 400, 2)
    assert r.mean == r.trimmed_mean == 200 / 400
    (r,) = COV.genome_depth(aln, lengths, lo=0.0, hi=1.0, genomes=genomes, end_exclusion=25).collect()
    assert (r.covered_bases, r.length, r.mean) == (75, 250, 100 / 250)
    assert [r.ref_id for r in COV.unknown_references(aln, lengths).collect()] == ["c9"]


def test_assembly_bins_only_samples_that_pass(spark):
    gfa = spark.createDataFrame([("a", "S", "c1l", "A" * 3000), ("b", "S", "c2l", "A" * 10), ("a", "S", "c3c", "C" * 2000)],
                                "sample_id string, rec_type string, contig_id string, seq string")
    bins = spark.createDataFrame([("a", "MaxBin", "c1l", "m.1", 0.9), ("b", "MaxBin", "c2l", "m.1", 0.9)],
                                 "sample_id string, binner string, contig_id string, bin_id string, score double")
    out = PL.assembly(gfa, bins, small_kib=1, min_bytes=1000)
    assert {r.genome_id for r in out["genomes"].collect()} == {"a_MaxBin_m.1", "a.c3c"}
    assert [r.sample_id for r in out["skipped"].collect()] == ["b"]


def test_adapter_removal_verdict(spark):
    ad, body = "ACGTTGCAAC", "GGGGGCCCCCTTTTT"
    rc = "GTTGCAACGT"
    reads = spark.createDataFrame([("a", "r1", ad + body + rc, "I" * 35), ("a", "r2", ad + body + rc, "I" * 35),
                                   ("b", "r3", body, "I" * 15)], "sample_id string, read_id string, seq string, qual string")
    files = spark.createDataFrame([], "file_name string, rec_no int, adapter_id string, seq string")
    manifest = spark.createDataFrame([("a",), ("b",), ("c",)], "sample_id string")
    for peek in (False, True):
        out = PL.adapter_removal(reads, files, ad, manifest, preset="SYMMETRIC", peek=peek, mismatches=0)
        (r,) = out["reads"].collect()
        assert (r.seq, r.dup_count) == (body, 2)
        (v,) = out["verdict"].collect()
        assert (v.n_trimmed, v.n_unchanged, v.n_missing, v.ok) == (1, 1, 1, False)


def test_concat_leaves_out_ambiguous_genomes(spark):
    files = spark.createDataFrame([("x.fna",), ("y.fna",), ("z.fna",), ("w.fna",)], "file_name string")
    meta = spark.createDataFrame([("x", "G1"), ("y", "G2"), ("z", "G2")], "file_stem string, genome_id string")
    records = spark.createDataFrame([("x.fna", ">1 plasmid x", 2, "CC"), ("x.fna", ">2 chr ", 1, "AA"), ("x.fna", ">3 chr", 3, "TT"),
                                     ("y.fna", ">1 chr", 1, "GG")], "file_name string, title string, ord int, seq string")
    out = PL.concat(files, meta, records, words="plasmid", gap="N")
    assert [(r.genome_id, r.seq) for r in out["genomes"].collect()] == [("G1", "AANTT")]
    assert [(r.genome_id, r.chunk_no, r.seq) for r in out["chunks"].collect()] == [("G1", 0, "AANTT")]
    assert sorted((r.genome_id, r.ord, r.title, r.seq) for r in out["records"].collect()) == [("G1", 1, "2", "AA"), ("G1", 3, "3", "TT")]
    assert [r.file_name for r in out["unknown"].collect()] == ["w.fna"] and out["duplicates"].count() == 1


def test_genome_table_gates_dereplicates_and_measures(spark):
    rng = random.Random(1)
    one, two = ("".join(rng.choices("ACGT", k=600)) for _ in range(2))
    contigs = spark.createDataFrame([(1, "b1", "c1", 1, one[:300]), (1, "b1", "c2", 2, one[300:]), (2, "b1", "c3", 1, one[:300]),
                                     (2, "b1", "c4", 2, one[300:]), (2, "b2", "c5", 1, two), (2, "b3", "c6", 1, two[::-1])],
                                    "artifact_id int, genome_id string, contig_id string, ord int, seq string")
    quality = spark.createDataFrame([(1, "b1", 90.0, 0.0, 0.0), (2, "b1", 80.0, 0.0, 0.0), (2, "b2", 70.0, 5.0, 0.0), (2, "b3", 40.0, 0.0, 0.0)],
                                    "artifact_id int, bin_id string, completeness double, contamination double, strain_heterogeneity double")
    aln = spark.createDataFrame([("a", "r1", 0, "c1", 1, 60, "100=", 0), ("a", "r2", 0, "c2", 1, 60, "50=", 0),
                                 ("a", "r3", 0, "c3", 1, 60, "50=", 0)], ALN)
    lengths = spark.createDataFrame([("c1", 300), ("c2", 300), ("c3", 300), ("c5", 600)], "ref_id string, length long")
    out = PL.genome_table(quality, contigs, aln, lengths, k=15, s=200)
    assert {r.genome_id: r.rep_id for r in out["clusters"].collect()} == {"1_b1": "1_b1", "2_b1": "1_b1", "2_b2": "2_b2"}
    (r,) = out["depth"].collect()
    assert (r.genome_id, r.covered_bases, r.length, r.read_count) == ("1_b1", 150, 600, 2)


def test_genome_table_whole(spark):
    rng = random.Random(2)
    one, two, three = ("".join(rng.choices("ACGT", k=600)) for _ in range(3))
    contigs = spark.createDataFrame([(1, "b1", "c1", 1, one, "MAG"), (2, "2_s.c2", "c2", 1, two, "LCG"), (2, "b3", "c3", 1, three, "MAG")],
                                    "artifact_id int, genome_id string, contig_id string, ord int, seq string, kind string")
    quality = spark.createDataFrame([(1, "b1", 90.0, 0.0, 0.0, "MAG"), (2, "2_s.c2", 80.0, 0.0, 0.0, "LCG"), (2, "b3", 90.0, 0.0, 0.0, "MAG")],
                                    "artifact_id int, bin_id string, completeness double, contamination double, strain_heterogeneity double, kind string")
    aln = spark.createDataFrame([("a", "r1", 0, "c1", 1, 60, "100=", 0), ("a", "r2", 0, "c2", 1, 60, "50=", 0), ("b", "r3", 0, "c1", 51, 60, "100=", 0),
                                 ("b", "r4", 0, "c3", 1, 60, "60=", 0)], ALN)
    lengths = spark.createDataFrame([("c1", 600), ("c2", 600), ("c3", 600)], "ref_id string, length long")
    tips = spark.createDataFrame([("1_b1",), ("2_s.c2",)], "tip string")
    manifest = spark.createDataFrame([("a",), ("b",), ("none",)], "sample_id string")
    out = PL.genome_table(quality, contigs, aln, lengths, k=15, s=200, manifest=manifest, tips=tips)
    assert sorted(map(tuple, out["table"].collect())) == [("a", "1_b1", 1.0), ("a", "2_s.c2", 1.0), ("b", "1_b1", 1.0)]
    assert [r.feature_id for r in out["removed"].collect()] == ["2_b3"]
    assert {r.sample_id: r.outcome for r in out["verdict"].collect()} == {"a": "ok", "b": "ok", "none": "missing"}
    assert {r.genome_id: r.length for r in out["genome_lengths"].collect()} == {"1_b1": 600, "2_s.c2": 600, "2_b3": 600}
    both = {(r.sample_id, r.ref_id): r.covered for r in out["consolidated"].collect()}
    assert both[("*", "c1")] == 150 and both[("a", "c1")] == both[("b", "c1")] == 100 and both[("*", "c3")] == 60
