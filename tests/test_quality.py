import math
import random

from pyspark.sql import functions as F

from longtab.operators import quality as QL
from longtab.operators import reads as RD
from longtab.plans import views as V
from longtab.sources import exports as EX
from longtab.sources import seqio as SQ


def test_n50_and_score(spark):
    c = spark.createDataFrame([("g", "a", "A" * 10), ("g", "b", "A" * 20), ("g", "c", "A" * 30),
                               ("g", "d", "A" * 40)], "genome_id string, contig_id string, seq string")
    assert QL.n50(c).first().n50 == 30                      # 40 < 50, 40 + 30 >= 50
    q = spark.createDataFrame([("g", 90.0, 2.0, 50.0)],
                              "genome_id string, completeness double, contamination double, strain_heterogeneity double")
    s = QL.genome_score(q, QL.n50(c)).first().score
    assert abs(s - (90 - 10 + 1 + 0.5 * math.log10(30))) < 1e-12


def test_title_filter_needs_a_char_on_both_sides(spark):
    t = spark.createDataFrame([(">c1 plasmid x",), (">c2 plasmid",), (">c3 Plasmid y",), (">c4 phage_z",)],
                              "title string")
    keep = [r.title for r in QL.title_filter(t, "plasmid,phage").collect()]
    assert keep == [">c2 plasmid", ">c3 Plasmid y"]
    keep_ci = [r.title for r in QL.title_filter(t, "plasmid,phage", case_insensitive=True).collect()]
    assert keep_ci == [">c2 plasmid"]


def test_concat_order_gap_and_stats(spark):
    c = spark.createDataFrame([("g1", 2, "CC"), ("g1", 1, "AA"), ("g1", 3, ""), ("g2", 1, "T")],
                              "genome_id string, ord long, seq string")
    got = {r.genome_id: r.seq for r in QL.concat_genomes(c, gap="NN").collect()}
    assert got == {"g1": "AANNCC", "g2": "T"}
    st = QL.concat_stats(c).first()
    assert (st.genomes, st.sequences, st.characters) == (2, 3, 5)


def _joined(rows, gap):
    whole = {}
    for g, _, s in sorted(((r[0] or "", -1 if r[1] is None else r[1], r[2]) for r in rows if r[2])):
        whole[g] = whole[g] + gap + s if g in whole else s
    return whole


def test_chunks_hold_the_joined_genome_and_each_kmer_once(spark):
    rng = random.Random(5)
    rows = [(g, i * step, "".join(rng.choices("ACGT", k=rng.choice([0, 1, 2, 5, 9, 40]))))
            for g, step in (("g1", 1), ("g2", 3000), (None, 7)) for i in range(60)]
    rows += [("g3", None, "TTT"), ("g3", 1, "CA"), ("g3", 1, "AC"), ("g3", 1, "AC"), ("g3", -9000, "G"), ("g4", 1, ""), ("g5", 1, None)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "genome_id string, ord long, seq string, chunk_no string")
    whole = _joined([r for r in rows if r[0] != "g3"], "NN") | {"g3": "TTTNNGNNACNNACNNCA"}
    for chunk, overlap in ((1, 0), (7, 0), (7, 3), (4, 9), (1000, 4)):
        got = {(r.genome_id or "", r.chunk_no): r.seq for r in QL.genome_chunks(df, "NN", chunk, overlap).collect()}
        want = {(g, i // chunk): s[i:i + chunk + overlap] for g, s in whole.items() for i in range(0, len(s), chunk)}
        assert got == want
    ks = [(r.genome_id or "", bytes(r.kmer).decode()) for r in
          RD.kmers(QL.genome_chunks(df, "NN", 7, 4), ["genome_id"], 5).collect()]
    assert sorted(ks) == sorted((g, s[i:i + 5]) for g, s in whole.items() for i in range(len(s) - 4))
    assert QL.genome_chunks(df.limit(0)).count() == 0


def test_one_genome_of_the_whole_table_in_chunks(spark):
    c = V.view(spark, "/root/testdata/sf0.001", "v_contigs").withColumn("genome_id", F.lit("all"))
    chunks = QL.genome_chunks(c, chunk=4096).orderBy("chunk_no").collect()
    assert [r.chunk_no for r in chunks] == list(range(len(chunks))) and {len(r.seq) for r in chunks[:-1]} == {4096}
    assert "".join(r.seq for r in chunks) == QL.concat_genomes(c).first().seq


def test_written_records_are_read_back(spark, tmp_path):
    rows = [("g2", 1, "c1 long title", "ACGTACGTAC"), ("g1", 2, "c3", ""), ("g1", 1, "c2\tx", "GGG")]
    c = spark.createDataFrame(rows, "genome_id string, ord long, title string, seq string")
    lines = QL.fasta_lines(QL.record_chunks(c, chunk=4), "title")
    EX.write_sorted_text(lines, str(tmp_path / "r"), "line", ["genome_id", "ord", "chunk_no"], parts=2, compression="none")
    text = "".join(p.read_text() for p in sorted((tmp_path / "r").glob("part-*")))
    assert text == ">c2\nGGG\n>c3\n\n>c1\nACGT\nACGT\nAC\n"
    (tmp_path / "one.fna").write_text(text)             # the parts in name order are one text; a part may begin inside a record
    got = {(r.contig_id, r.seq) for r in SQ.read_fasta(spark, str(tmp_path / "one.fna")).collect()}
    assert got == {("c1", "ACGTACGTAC"), ("c2", "GGG"), ("c3", "")}
