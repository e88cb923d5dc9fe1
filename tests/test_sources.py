import gzip
import os

from longtab.sources import seqio as SQ
from longtab.sources import tables as TB
from longtab.operators import features as FT


def test_fasta_roundtrip_multiline_gz(spark, tmp_path):
    p = tmp_path / "g1.fna.gz"
    with gzip.open(p, "wt") as fh:
        fh.write(">c1 first contig\nACGT\nAC\n>c2\nGGGG\n")
    df = SQ.read_fasta(spark, str(p)).orderBy("ord").collect()
    assert [(r.contig_id, r.seq, r.genome_id) for r in df] == [("c1", "ACGTAC", "g1"), ("c2", "GGGG", "g1")]
    out = tmp_path / "out"
    SQ.write_fasta(spark.createDataFrame([("c9", "A" * 130)], "contig_id string, seq string"), str(out), width=60,
                   compression=None)
    text = "".join(open(os.path.join(out, f)).read() for f in os.listdir(out) if f.startswith("part"))
    assert text.split("\n")[:4] == [">c9", "A" * 60, "A" * 60, "A" * 10]


def test_fastq_quality_line_starting_with_at(spark, tmp_path):
    p = tmp_path / "S1.fastq.gz"
    with gzip.open(p, "wt") as fh:
        fh.write("@r1 desc\nACGT\n+\n@III\n@r2\nGG\n+\nII\n")
    rows = SQ.read_fastq(spark, [str(p)]).orderBy("read_id").collect()
    assert [(r.read_id, r.seq, r.qual) for r in rows] == [("r1", "ACGT", "@III"), ("r2", "GG", "II")]


FASTQ = [("r1", "ACGT", "@III"), ("r2", "GG", "II"), ("r3", "A", "@"), ("r4", "", ""), ("@r5", "ACG", "@@@"), ("r6", "T", "+"), ("r7", "AC", "@+")]


def test_fastq_cut_at_every_byte(spark, tmp_path):
    text = "".join(f"@{i} d\n{s}\n+\n{q}\n" for i, s, q in FASTQ)
    (tmp_path / "x").mkdir()
    (tmp_path / "x" / "a.fastq").write_text(text)
    (tmp_path / "x" / "b.fastq").write_text(text.replace("\n", "\r\n").rstrip())
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.openCostInBytes", 0)
        for size in (1, 7, 10_000):          # ranges of one byte cut at every byte
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            good, bad = SQ.read_fastq_checked(spark, str(tmp_path / "x"))
            rows = sorted((r.file_name, r.read_id, r.seq, r.qual) for r in good.collect())
            assert rows == sorted((f, *r) for f in ("a.fastq", "b.fastq") for r in FASTQ), size
            assert bad.count() == 0
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_fastq_quarantine(spark, tmp_path):
    (tmp_path / "a.fastq").write_text("@r1\nACGT\n+\nIII\n@r2\nGG\nx\nII\n@r3\nA\n+\nI\nmore\n@r4\nA\n@r5\nAC\n+\nII\n@r6\nTT\n+\n")
    (tmp_path / "b.fastq").write_text("\n")
    good, bad = SQ.read_fastq_checked(spark, [str(tmp_path / "a.fastq"), str(tmp_path / "b.fastq")])
    assert [r.read_id for r in good.collect()] == ["r5"]
    assert sorted((r.line.split("\n")[0], r.reason) for r in bad.collect()) == [
        ("r1", "sequence and quality differ in length"), ("r2", "no + line"), ("r3", "lines behind the quality"),
        ("r4", "not four lines"), ("r6", "sequence and quality differ in length")]
    (tmp_path / "s.sam").write_text("@HD\tVN:1.6\nr1\t0\tg1\t11\t60\t5=\t*\t0\t0\tACGTA\tIIIII\nshort\t0\nr2\tx\tg1\t1\t1\t1=\t*\t0\t0\tA\tI\n")
    a, q = SQ.read_sam_checked(spark, str(tmp_path / "s.sam"))
    assert [r.read_id for r in a.collect()] == ["r1"] and sorted(r.line.split("\t")[0] for r in q.collect()) == ["r2", "short"]


def test_sam_and_gfa(spark, tmp_path):
    sam = tmp_path / "s.sam"
    sam.write_text("@HD\tVN:1.6\nr1\t0\tg1\t11\t60\t5=\t*\t0\t0\tACGTA\tIIIII\tNM:i:0\tMD:Z:5\n")
    a = SQ.read_sam(spark, str(sam)).first()
    assert (a.read_id, a.flag, a.ref_id, a.pos, a.cigar, a.tag_nm, a.tag_md) == ("r1", 0, "g1", 11, "5=", 0, "5")
    gfa = tmp_path / "a.gfa"
    gfa.write_text("S\tctg1c\tACGT\nL\tctg1c\t+\tctg2l\t-\t0M\nS\tctg2l\tGG\n")
    g = SQ.read_gfa(spark, str(gfa)).filter("rec_type = 'S'").collect()
    assert [(r.contig_id, r.seq) for r in g] == [("ctg1c", "ACGT"), ("ctg2l", "GG")]


def test_tables(spark, tmp_path):
    (tmp_path / "m.tsv").write_text("s1\t/p/a b.fastq.gz\t7\n\ns2\t/p/c.fastq.gz\n")
    m = TB.read_manifest(spark, str(tmp_path / "m.tsv")).collect()
    assert [(r.sample_id, r.path, r.artifact_id) for r in m] == [("s1", "/p/a b.fastq.gz", 7), ("s2", "/p/c.fastq.gz", None)]
    (tmp_path / "len.tsv").write_text("g1\t100\ng2\t0\n")
    assert TB.read_lengths(spark, str(tmp_path / "len.tsv")).count() == 2
    (tmp_path / "c.coords").write_text(">g1\np1\t5\t1\np2\t10\t20\n>g2\np3\t1\t3\n")
    co = sorted(map(tuple, TB.read_coords(spark, str(tmp_path / "c.coords")).collect()))
    assert co == [("g1", "p1", 0, 5, "-"), ("g1", "p2", 9, 20, "+"), ("g2", "p3", 0, 3, "+")]
    (tmp_path / "m.map").write_text("p1\tK1\tK2\np2\tK3\n")
    assert TB.read_map(spark, str(tmp_path / "m.map"), "ko").count() == 3
    (tmp_path / "t.tsv").write_text("# Constructed from biom file\n#OTU ID\tS1\tS2\nf1\t1.0\t0.0\nf2\t2.0\t3.0\n")
    coo = sorted(map(tuple, TB.read_feature_tsv(spark, str(tmp_path / "t.tsv")).collect()))
    assert coo == [("S1", "f1", 1.0), ("S1", "f2", 2.0), ("S2", "f2", 3.0)]
    (tmp_path / "tree.nwk").write_text("((a:1,b:2)x:1,c);\n")
    tips = FT.tree_tips(TB.read_newick(spark, str(tmp_path / "tree.nwk")))
    assert sorted(r.tip for r in tips.collect()) == ["a", "b", "c"]


def test_taxonomy_optional_and_status(spark, tmp_path):
    (tmp_path / "bac.tsv").write_text("user_genome\tclassification\tx\ng1\td__B\t1\n")
    t = TB.read_taxonomy(spark, str(tmp_path / "bac.tsv"), str(tmp_path / "missing.tsv"))
    assert t.count() == 1
    (tmp_path / "ar.tsv").write_text("user_genome\tclassification\ng2\td__A\n")
    t2 = TB.read_taxonomy(spark, str(tmp_path / "bac.tsv"), str(tmp_path / "ar.tsv"))
    assert t2.count() == 2 and "x" in t2.columns
    d = tmp_path / "st" / "step-2"
    d.mkdir(parents=True)
    (d / "completed_1.log").write_text("")
    (d / "failed_2.log").write_text("S7\n")
    st = sorted(map(tuple, TB.read_status(spark, str(tmp_path / "st")).collect()))
    assert st == [(2, 1, "completed", ""), (2, 2, "failed", "S7")]


def test_prep_lineage_pooled_genomes_and_counts(spark, tmp_path):
    (tmp_path / "prep.tsv").write_text("sample_name\trun_prefix\tdepth\nSKB8.640193\tS22205_S104\t007\n")
    p = TB.read_prep(spark, str(tmp_path / "prep.tsv")).first()
    assert (p.sample_name, p.run_prefix, p.depth) == ("SKB8.640193", "S22205_S104", "007")   # strings kept
    (tmp_path / "tax.tsv").write_text("G1\tk__B; p__F;c__X\n")
    lin = TB.read_lineage(spark, str(tmp_path / "tax.tsv")).first()
    assert lin.ranks == ["k__B", "p__F", "c__X"]
    for aid, sample, kind, name in (("101_x", "S1", "LCG", "S1.ctg1c"), ("102_y", "S2", "MAG", "S2_MetaBAT_bin.1")):
        d = tmp_path / "pool" / aid / sample / kind
        d.mkdir(parents=True)
        with gzip.open(d / f"{name}.fna.gz", "wt") as fh:
            fh.write(f">{name}_c1\nACGT\n")
    g = sorted((r.artifact_id, r.sample_id, r.kind, r.genome_id, r.seq)
               for r in TB.read_genome_files(spark, str(tmp_path / "pool")).collect())
    assert g == [("101", "S1", "LCG", "S1.ctg1c", "ACGT"), ("102", "S2", "MAG", "S2_MetaBAT_bin.1", "ACGT")]
    (tmp_path / "c.counts").write_text("IdxFirst\tCounts\tMean\n0\t5\t1\n1\t9\t2\n")
    c = TB.read_counts_last(spark, str(tmp_path / "c.counts")).first()
    assert c.counts == 9


def test_readers_survive_bad_rows(spark, tmp_path):
    (tmp_path / "a.sam").write_text("@HD\tVN:1\nr1\t0\tc\t5\t60\t3=\t*\t0\t0\tACG\t*\n"
                                    "r2\t0\tc\tx\t60\t3=\t*\t0\t0\tACG\t*\tNM:i:2\nr3\t4\n")
    got = {r.read_id: r for r in SQ.read_sam(spark, str(tmp_path / "a.sam")).collect()}
    assert got["r1"].tag_nm is None and not got["r1"]._bad
    assert got["r2"]._bad and got["r2"].pos is None and got["r2"].tag_nm == 2
    assert got["r3"]._bad and got["r3"].cigar is None
    (tmp_path / "g.gfa").write_text("H\tVN:Z:1.0\nS\tc1\tACGT\n")
    assert [(r.rec_type, r.seq) for r in SQ.read_gfa(spark, str(tmp_path / "g.gfa")).collect()] == [("H", None), ("S", "ACGT")]
    (tmp_path / "q.tsv").write_text("Bin Id\tCompleteness\nb1\tNA\nb2\t9.5\n")
    assert [r.Completeness for r in TB.read_quality(spark, str(tmp_path / "q.tsv")).orderBy("Bin Id").collect()] == [None, 9.5]
    (tmp_path / "c.txt").write_text(">r1\ng1\t5\ng2\t9\t3\n")
    assert [(r.gene_id, r.start, r.stop) for r in TB.read_coords(spark, str(tmp_path / "c.txt")).orderBy("gene_id").collect()] == [
        ("g1", None, None), ("g2", 2, 9)]


def test_feature_tsv_uses_each_files_own_header(spark, tmp_path):
    (tmp_path / "1.tsv").write_text("#OTU ID\tS1\nf\t1\n")
    (tmp_path / "2.tsv").write_text("#OTU ID\tS2\nf\t2\ng\t\n")
    got = TB.read_feature_tsv(spark, [str(tmp_path / "1.tsv"), str(tmp_path / "2.tsv")])
    assert sorted((r.sample_id, r.feature_id, r.value) for r in got.collect()) == [("S1", "f", 1.0), ("S2", "f", 2.0)]


def _checked(spark, tmp_path, text, read):
    path = tmp_path / "in.txt"
    path.write_text(text)
    good, bad = read(spark, str(path))
    return sorted(tuple(r) for r in good.collect()), sorted((r.line, r.reason) for r in bad.collect())


def test_quarantine_takes_every_line_that_is_no_row(spark, tmp_path):
    good, bad = _checked(spark, tmp_path, "S1\tp\t7\r\nS2\tq\n\n\tr\nS3\nS4\tt\tx\nS5\t\t1\n", TB.read_manifest_checked)
    assert sorted(good, key=str) == [("S1", "p", 7), ("S2", "q", None)]
    assert bad == [("\tr", "empty sample"), ("S3", "no path"), ("S4\tt\tx", "artifact is no number"), ("S5\t\t1", "no path")]
    good, bad = _checked(spark, tmp_path, "r1\t5\nr2\tx\nr3\n\t4\nr4\t-1\nr5\t0\tmore\n", TB.read_lengths_checked)
    assert good == [("r1", 5), ("r5", 0)] and len(bad) == 4 and ("\t4", "empty reference") in bad
    good, bad = _checked(spark, tmp_path, ">a\ng1\t10\t3\ng2\t1\t4\ng3\tx\t4\ng4\t5\n>\ng5\t1\t2\n>b\n\ng6\t0\t2\n", TB.read_coords_checked)
    assert good == [("a", "g1", 2, 10, "-"), ("a", "g2", 0, 4, "+")]
    assert [b[0].split("\t")[0] for b in bad] == ["g3", "g4", "g5", "g6"] and bad[2][1] == "no reference"
    good, bad = _checked(spark, tmp_path, "# c\ns1\ta\t\tb\ns2\t\ns3\n\tz\n", lambda sp, p: TB.read_map_checked(sp, p, "ko"))
    assert good == [("ko", "s1", "a"), ("ko", "s1", "b")] and len(bad) == 3
    good, bad = _checked(spark, tmp_path, "r1\tk__B; p__F\nr2\n\tk__B\n", TB.read_lineage_checked)
    assert good == [("r1", "k__B; p__F", ["k__B", "p__F"])] and len(bad) == 2
    text = "Bin Id\tCompleteness\tContamination\tx y\nb1\t90\t1.5\tu\nb2\tNA\t1\tv\n\t90\t1\tw\nb3\t80\n"
    good, bad = _checked(spark, tmp_path, text, TB.read_quality_checked)
    assert good == [("b1", 90.0, 1.5, "u", "in.txt")]
    assert bad == [("\t90\t1\tw", "no bin"), ("b2\tNA\t1\tv", "Completeness is no number"), ("b3\t80\t\t", "Contamination is no number")]
    text = "# Constructed\n#OTU ID\tS1\tS2\nf1\t1\t0\nf2\t\t2.5\nf3\t1\nf4\tx\t1\n\t1\t1\nf5\t1\t2\t3\n"
    good, bad = _checked(spark, tmp_path, text, TB.read_feature_tsv_checked)
    assert good == [("S1", "f1", 1.0), ("S2", "f2", 2.5)] and len(bad) == 4


def test_quarantine_of_sequences_and_graphs(spark, tmp_path):
    good, bad = _checked(spark, tmp_path, ">c1 d e\nACGT\nAC\n>c2\n>\nAC\n>c3 x\nA1\n", lambda sp, p: SQ.read_fasta_checked(sp, p))
    assert [(r[1], r[3]) for r in good] == [("c1", "ACGTAC")]
    assert bad == [("", "no name"), ("c2", "no sequence"), ("c3 x", "symbols that are no sequence")]
    good, bad = _checked(spark, tmp_path, "H\tVN\nS\ts1\tAC\n\nS\ts2\nL\ts1\t+\nxx\ty\n", SQ.read_gfa_checked)
    assert {r[1:] for r in good} == {("H", "VN", None), ("S", "s1", "AC"), ("L", "s1", "+")}
    assert bad == [("S\ts2", "segment without name or sequence"), ("xx\ty", "no record type")]
    empty = tmp_path / "none"
    empty.mkdir()
    (empty / "a.txt").write_text("\n")
    for read in (TB.read_manifest_checked, TB.read_lengths_checked, TB.read_coords_checked, TB.read_lineage_checked, SQ.read_gfa_checked,
                 TB.read_feature_tsv_checked):
        assert [d.count() for d in read(spark, str(empty))] == [0, 0]
