"""Genome quality, N50, score, pooling and concatenation (SET2, SET3, FLT10, FLT12, WIN4,
AGG9, AGG11, AGG12, AGG14, REL9)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Genome quality gate and score weights.
MIN_COMPLETENESS = 50.0
MAX_CONTAMINATION = 10.0
SCORE_CONTAMINATION_WEIGHT = 5.0
SCORE_HETEROGENEITY_WEIGHT = 1.0
SCORE_N50_WEIGHT = 0.5
GAP = "N" * 20

CHUNK = 1 << 16              # characters of a genome in one row
LANE = 1 << 12               # contigs (by their place in file) whose lengths are summed in one window


def merge_quality(quality: DataFrame) -> DataFrame:
    """SET2: one quality table over artifacts, genome ids prefixed ``<artifact>_``."""
    return pooled_name(quality, "bin_id")


def pooled_name(df: DataFrame, bin_col: str) -> DataFrame:
    """``genome_id`` over all artifacts: ``<artifact>_<bin>``; rows of ``kind`` LCG carry the artifact already and stay."""
    name = F.concat_ws("_", F.col("artifact_id").cast("string"), bin_col)
    if "kind" in df.columns:
        name = F.when(F.col("kind") == "LCG", F.col(bin_col)).otherwise(name)
    return df.withColumn("genome_id", name)


def quality_gate(quality: DataFrame, min_completeness: float = MIN_COMPLETENESS,
                 max_contamination: float = MAX_CONTAMINATION) -> DataFrame:
    """FLT10."""
    return quality.filter((F.col("completeness") >= min_completeness)
                          & (F.col("contamination") <= max_contamination))


def n50(contigs: DataFrame, genome_col: str = "genome_id") -> DataFrame:
    """WIN4: length of the contig at which the length-descending running total first reaches
    half of the genome's total.  The window is per genome (bounded by its contig count)."""
    L = F.length("seq").cast("bigint")
    c = contigs.select(genome_col, "contig_id", L.alias("_len"))
    w = Window.partitionBy(genome_col).orderBy(F.col("_len").desc(), "contig_id")
    c = (c.withColumn("_cum", F.sum("_len").over(w.rowsBetween(Window.unboundedPreceding, 0)))
          .withColumn("_tot", F.sum("_len").over(Window.partitionBy(genome_col))))
    return (c.filter(2 * F.col("_cum") >= F.col("_tot"))
             .groupBy(genome_col).agg(F.max("_len").alias("n50")))


def genome_lengths(contigs: DataFrame, genome_col: str = "genome_id") -> DataFrame:
    """AGG9: genome length = sum of contig lengths."""
    return contigs.groupBy(genome_col).agg(F.sum(F.length("seq")).cast("bigint").alias("length"))


def genome_score(quality: DataFrame, n50s: DataFrame, genome_col: str = "genome_id") -> DataFrame:
    """AGG14: completeness - 5 contamination + contamination * heterogeneity / 100 + 0.5 log10(N50)."""
    q = quality.join(n50s, genome_col)
    s = (F.col("completeness") - SCORE_CONTAMINATION_WEIGHT * F.col("contamination")
         + SCORE_HETEROGENEITY_WEIGHT * F.col("contamination") * F.col("strain_heterogeneity") / 100.0
         + SCORE_N50_WEIGHT * F.log10(F.col("n50")))
    return q.withColumn("score", F.when(F.col("n50") > 0, s))


def pool_genomes(*tables: DataFrame) -> DataFrame:
    """SET3: LCG and MAG genomes across artifacts in one table."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out


def title_filter(records: DataFrame, words: str, col: str = "title",
                 case_insensitive: bool = False) -> DataFrame:
    """FLT12: drop records whose title holds one of the comma-separated words with a
    non-alphanumeric character on each side (case-sensitive unless asked)."""
    alts = "|".join(w for w in words.split(",") if w)
    pat = r"[^a-zA-Z0-9](" + alts + r")[^a-zA-Z0-9]"
    if case_insensitive:
        pat = "(?i)" + pat
    return records.filter(~F.col(col).rlike(pat))


def concat_genomes(contigs: DataFrame, gap: str = GAP, genome_col: str = "genome_id",
                   order_col: str = "ord") -> DataFrame:
    """AGG11: one sequence per genome, its (non-empty) contigs in file order joined by ``gap``.
    The group is one genome (bounded by genome size)."""
    c = contigs.filter(F.length("seq") > 0)
    g = c.groupBy(genome_col).agg(F.array_sort(F.collect_list(F.struct(order_col, "seq"))).alias("_s"))
    return g.select(genome_col, F.array_join(F.transform("_s", lambda x: x["seq"]), gap).alias("seq"))


def _placed(contigs: DataFrame, gap: str, genome_col: str, order_col: str) -> DataFrame:
    """(genome_col, _start, _b): the bytes every non-empty contig adds to its genome (its gap in front, but for the first one)
    and the place of the first of them.

    Lengths are summed over (genome, place in file), then over lanes of places and over the lanes of a genome, so
    neither a window nor a row holds a genome; the sequences move once, to meet their starts."""
    key = F.struct(F.col(genome_col).alias("g"), F.col(order_col).cast("bigint").alias("o"))    # equal with nulls in it, too
    c = contigs.filter(F.length("seq") > 0).select(key.alias("_k"), F.encode("seq", "US-ASCII").alias("_b"))
    takes = F.octet_length("_b").cast("bigint") + len(gap)
    per = c.groupBy("_k").agg(F.sum(takes).alias("_n")).withColumn(
        "_lane", F.struct("_k.g", F.floor(F.col("_k.o") / LANE).alias("no")))
    before = lambda part, by: F.coalesce(F.sum("_n").over(
        Window.partitionBy(part).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    lanes = per.groupBy("_lane").agg(F.sum("_n").alias("_n")).select("_lane", before("_lane.g", "_lane.no").alias("_ahead"))
    starts = per.withColumn("_in", before("_lane", "_k.o")).join(lanes, "_lane").select("_k", (F.col("_ahead") + F.col("_in")).alias("_before"))
    ties = Window.partitionBy("_k").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)    # one row where places are unique
    at = F.col("_before") + F.coalesce(F.sum(takes).over(ties), F.lit(0))
    c = c.join(starts, "_k").select(F.col("_k.g").alias(genome_col), at.alias("_at"), "_b")
    first = F.col("_at") == 0
    return c.select(genome_col, F.when(first, 0).otherwise(F.col("_at") - len(gap)).alias("_start"),
                    F.when(first, F.col("_b")).otherwise(F.concat(F.lit(gap.encode("ascii")), "_b")).alias("_b"))


def _in_chunks(placed: DataFrame, keys: list[str], chunk: int, overlap: int) -> DataFrame:
    """Bytes at their places -> (keys, chunk_no, seq), rows of ``chunk`` characters and ``overlap`` of the next one's."""
    end = F.col("_start") + F.octet_length("_b")
    lo = F.greatest(F.floor((F.col("_start") - overlap) / chunk), F.lit(0))
    low, high = lambda i: F.greatest(F.col("_start"), i * chunk), lambda i: F.least(end, i * chunk + chunk + overlap)
    cut = F.transform(F.sequence(lo, F.floor((end - 1) / chunk)), lambda i: F.struct(
        i.alias("chunk_no"), low(i).alias("at"),
        F.substring(F.col("_b"), (low(i) - F.col("_start") + 1).cast("int"), (high(i) - low(i)).cast("int")).alias("part")))
    parts = placed.select(*keys, F.explode(cut).alias("_x")).select(
        *keys, "_x.chunk_no", F.struct("_x.at", F.decode("_x.part", "US-ASCII").alias("part")).alias("_p"))
    return parts.groupBy(*keys, "chunk_no").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("_p")), lambda x: x["part"]), "").alias("seq"))


def genome_chunks(contigs: DataFrame, gap: str = GAP, chunk: int = CHUNK, overlap: int = 0, genome_col: str = "genome_id",
                  order_col: str = "ord") -> DataFrame:
    """AGG11 for genomes of any size: ``concat_genomes``' sequence as rows (genome, chunk_no from 0, seq) of ``chunk``
    characters, each with the first ``overlap`` characters of what follows (k - 1 of them keep all k-mers, each once).

    Sequences are ASCII.  Contigs of one place stand by sequence, a null place is first, rows without a genome id are one
    genome, empty contigs and genomes of nothing else give no row; other columns are left out."""
    return _in_chunks(_placed(contigs, gap, genome_col, order_col), [genome_col], chunk, overlap)


def record_chunks(contigs: DataFrame, chunk: int = CHUNK, genome_col: str = "genome_id", order_col: str = "ord",
                  title_col: str = "title") -> DataFrame:
    """AGG11, a record per contig: rows (genome, place in file, title up to white space, chunk_no, seq); an empty contig
    keeps its title with an empty chunk 0.  Contigs of one genome, place and title are one record of each other's text, so
    places must be unique."""
    word = F.regexp_extract(F.trim(F.col(title_col)), r"^>?(\S*)", 1).alias("title")
    keys = [genome_col, order_col, "title"]
    c = contigs.select(genome_col, order_col, word, F.lit(0).cast("bigint").alias("_start"),
                       F.encode(F.coalesce("seq", F.lit("")), "US-ASCII").alias("_b"))
    bare = c.filter(F.octet_length("_b") == 0).select(*keys, F.lit(0).cast("bigint").alias("chunk_no"), F.lit("").alias("seq"))
    return _in_chunks(c.filter(F.octet_length("_b") > 0), keys, chunk, 0).unionByName(bare)


def fasta_lines(chunks: DataFrame, name_col: str) -> DataFrame:
    """``line`` of every chunk: FASTA text once the rows stand in the order of their genome (and place) and chunk_no.  The parts
    of ``exports.write_sorted_text`` in name order are one such text; one part alone may begin inside a sequence."""
    head = F.concat(F.lit(">"), F.coalesce(F.col(name_col).cast("string"), F.lit("")), F.lit("\n"))
    return chunks.withColumn("line", F.when(F.col("chunk_no") == 0, F.concat(head, "seq")).otherwise(F.col("seq")))


def concat_stats(contigs: DataFrame, genome_col: str = "genome_id") -> DataFrame:
    """AGG12: genomes, sequences and characters written."""
    c = contigs.filter(F.length("seq") > 0)
    return c.agg(F.countDistinct(genome_col).alias("genomes"), F.count("*").alias("sequences"),
                 F.sum(F.length("seq")).cast("bigint").alias("characters"))


def map_genome_ids(files: DataFrame, metadata: DataFrame, file_col: str = "file_name") -> DataFrame:
    """REL9: genome id from metadata by file stem (text before ``.fna``); ``genome_id`` is null
    for a file the metadata does not know (an error row)."""
    stem = F.element_at(F.split(F.trim(F.col(file_col)), r"\.fna"), 1)
    return (files.withColumn("file_stem", stem)
                 .join(metadata.select("file_stem", "genome_id"), "file_stem", "left"))


def duplicate_genomes(mapped: DataFrame) -> DataFrame:
    """Two files mapped to one genome id (checked after the rename)."""
    return (mapped.filter(F.col("genome_id").isNotNull()).groupBy("genome_id")
                  .agg(F.count("*").alias("n_files")).filter(F.col("n_files") > 1))
