"""Sequence file sources and sinks (SRC3-SRC6): FASTA, FASTQ, GFA, SAM.

Each reader is a distributed scan: many files in, one DataFrame out, with the file name taken
from ``_metadata``.  Malformed SAM rows are flagged (``_bad``) instead of dropped silently.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import names as NM


# --- FASTA ---------------------------------------------------------------------------------------
def read_fasta(spark: SparkSession, paths, genome_from_file: bool = True, keep_path: bool = False) -> DataFrame:
    """Multi-line (optionally gzipped) FASTA -> ``(file_name, contig_id, description, seq, ord)``.

    Records are read with ``'\\n>'`` as the line separator, so a record is one row and splits of
    uncompressed files resynchronise on record starts.  ``ord`` increases with the file offset
    inside a file (record order)."""
    raw = spark.read.option("lineSep", "\n>").text(paths).select(
        F.col("value"), F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_path").alias("file_path"))
    rec = raw.select("file_name", "file_path", F.regexp_replace("value", r"^>", "").alias("rec"),
                     F.monotonically_increasing_id().alias("ord"))
    rec = rec.filter(F.length(F.trim("rec")) > 0)
    head = F.substring_index("rec", "\n", 1)
    nl = F.instr("rec", "\n")
    body = F.when(nl > 0, F.substring(F.col("rec"), nl + 1, F.lit(1 << 30))).otherwise(F.lit(""))
    out = rec.select("file_name", "file_path",
                     F.split(F.regexp_replace(head, "\r", ""), r"\s+").getItem(0).alias("contig_id"),
                     F.trim(F.regexp_replace(head, r"^\S+", "")).alias("description"),
                     F.regexp_replace(body, r"[\r\n]", "").alias("seq"), "ord")
    if genome_from_file:
        out = out.withColumn("genome_id", NM.genome_stem("file_name"))
    return out if keep_path else out.drop("file_path")


def read_fasta_checked(spark: SparkSession, paths, **how) -> tuple[DataFrame, DataFrame]:
    """(records, quarantine ``(file_name, line, reason)``): ``read_fasta`` with its bad records apart, ``line`` their title:
    no name, no sequence, symbols that stand for no base or residue."""
    reason = (F.when(F.col("contig_id") == "", "no name").when(F.col("seq") == "", "no sequence")
               .when(F.col("seq").rlike(r"[^A-Za-z*.-]"), "symbols that are no sequence"))
    told = read_fasta(spark, paths, **how).withColumn("reason", reason)
    return (told.filter(F.col("reason").isNull()).drop("reason"),
            told.filter(F.col("reason").isNotNull()).select("file_name", F.trim(F.concat_ws(" ", "contig_id", "description")).alias("line"), "reason"))


def _wrap(seq: Column, width: int | None) -> Column:
    if not width:
        return seq
    n = F.ceil(F.length(seq) / width)
    chunks = F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))),
                         lambda i: F.substring(seq, i * width + 1, width))
    return F.array_join(chunks, "\n")


def fasta_record(id_col: str = "contig_id", width: int | None = 60) -> Column:
    """One FASTA record as text: header line and the sequence wrapped at ``width`` (None = one line)."""
    return F.concat(F.lit(">"), F.col(id_col), F.lit("\n"), _wrap(F.col("seq"), width)).alias("value")


def write_fasta(df: DataFrame, path: str, width: int | None = 60, partition_by: str | None = None,
                compression: str | None = "gzip", id_col: str = "contig_id") -> None:
    keep = [partition_by] if partition_by else []
    w = df.select(*keep, fasta_record(id_col, width)).write.mode("overwrite")
    if compression:
        w = w.option("compression", compression)
    if partition_by:
        w = w.partitionBy(partition_by)
    w.text(path)


# --- FASTQ ---------------------------------------------------------------------------------------
def read_fastq(spark: SparkSession, paths) -> DataFrame:
    """FASTQ(.gz) -> ``(file_name, read_id, seq, qual)`` from any file system Spark reads, good records only (partition
    columns of the folders are kept).  ``read_fastq_checked`` has the others as well."""
    return read_fastq_checked(spark, paths)[0]


def read_fastq_checked(spark: SparkSession, paths) -> tuple[DataFrame, DataFrame]:
    """(records, quarantine): FASTQ records ``(file_name, read_id, seq, qual)`` and the pieces that are none
    ``(file_name, reason, line)``.

    The file is a text scan cut at a line end followed by ``@``, so plain files are read in byte ranges wherever
    these fall.  A quality line may begin with ``@`` too: its record then comes as a front (header, sequence, ``+``) and a
    rest without line ends, the very next piece.  Only such halves (one record in forty) meet again: those of one byte
    range in a window over its halves, a front that ends its range with the first half of the file's next range that has any.
    A file must begin with ``@``."""
    raw = spark.read.option("lineSep", "\n@").text(paths)
    more = [c for c in raw.columns if c != "value"]
    text = raw.select(
        F.regexp_replace("value", "\r", "").alias("v"), F.col("_metadata.file_name").alias("file_name"), *more,
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("no"))
    piece = text.withColumn("l", F.split("v", "\n", -1))
    ends_only = F.forall(F.slice("l", F.lit(2), F.size("l")), lambda x: x == "")
    front = (F.size("l") == 3) & F.get("l", F.lit(2)).startswith("+")
    kind = (F.when(front, "front").when(ends_only, "rest").when(F.size("l") >= 4, "whole").otherwise("odd"))
    piece = piece.withColumn("kind", kind).withColumn("marked", (F.col("block") == 0) & F.col("v").startswith("@"))

    # halves, and pieces that still begin with @: of those, a file's first loses it (no line end stands before it)
    some = piece.filter(F.col("kind").isin("front", "rest") | F.col("marked"))
    inside = Window.partitionBy("path", "block").orderBy("no")
    some = (some.withColumn("nth", F.row_number().over(inside)).withColumn("next", F.lead(F.struct("kind", "no", "l")).over(inside))
            .withColumn("begin", F.min(F.when(F.col("marked"), F.col("no"))).over(Window.partitionBy("path", "block"))))
    bare = F.concat(F.array(F.expr("substring(l[0], 2)")), F.slice("l", F.lit(2), F.size("l")))
    some = some.withColumn("l", F.when(F.col("no") == F.col("begin"), bare).otherwise(F.col("l")))
    # the first of them in each byte range, along the file: one row a range
    first = some.filter("nth = 1").select("path", "block", F.struct("kind", "no", "l").alias("f"))
    first = first.select("path", "block", F.lead("f").over(Window.partitionBy("path").orderBy("block")).alias("after"))
    some = some.join(first, ["path", "block"]).withColumn("next", F.coalesce("next", "after"))
    half = some.filter(F.col("kind").isin("front", "rest"))
    paired = (F.col("kind") == "front") & F.coalesce(F.col("next.kind") == "rest", F.lit(False))
    joined = half.filter(paired).withColumn("l", F.concat("l", F.array(F.concat(F.lit("@"), F.col("next.l")[0]))))
    lost = half.filter(~paired & (F.col("v") != "")).join(
        joined.select(F.col("next.no").alias("used")), F.col("no") == F.col("used"), "left_anti")

    kept = ["file_name", *more, "l"]
    of = lambda k: (piece.filter((F.col("kind") == k) & ~F.col("marked")).select(*kept)
                    .unionByName(some.filter(F.col("kind") == k).select(*kept)))
    rows = of("whole").unionByName(joined.select(*kept))
    odd = of("odd").unionByName(lost.filter(F.trim(F.col("l")[0]) != "").select(*kept))
    line = lambda i: F.get("l", F.lit(i))
    beyond = F.exists(F.slice("l", F.lit(5), F.size("l")), lambda x: x != "")
    reason = (F.when(~line(2).startswith("+"), "no + line").when(F.length(line(1)) != F.length(line(3)), "sequence and quality differ in length")
              .when(beyond, "lines behind the quality"))
    rows = rows.withColumn("reason", reason)
    good = rows.filter(F.col("reason").isNull()).select(
        "file_name", *more, F.split(line(0), r"\s+")[0].alias("read_id"), line(1).alias("seq"), line(3).alias("qual"))
    bad = rows.filter(F.col("reason").isNotNull()).unionByName(odd.withColumn("reason", F.lit("not four lines")))
    return good, bad.select("file_name", *more, "reason", F.array_join("l", "\n").alias("line"))


def fastq_record() -> Column:
    return F.concat_ws("\n", F.concat(F.lit("@"), F.col("read_id")), F.col("seq"), F.lit("+"),
                       F.col("qual")).alias("value")


def write_fastq(df: DataFrame, path: str, partition_by: str = "sample_id", compression: str = "gzip") -> None:
    (df.select(partition_by, fastq_record()).write.mode("overwrite")
       .option("compression", compression).partitionBy(partition_by).text(path))


# --- GFA -----------------------------------------------------------------------------------------
def read_gfa(spark: SparkSession, paths) -> DataFrame:
    """Assembly graph -> ``(file_name, rec_type, contig_id, seq)`` for every row; keep the ``S``
    rows with ``operators.contigs.segments``."""
    raw = spark.read.text(paths)
    more = [c for c in raw.columns if c != "value"]
    t = raw.select(F.split("value", "\t").alias("f"), F.col("_metadata.file_name").alias("file_name"), *more)
    return t.select("file_name", *more, *[F.get("f", F.lit(i)).alias(n) for i, n in enumerate(("rec_type", "contig_id", "seq"))])


def read_gfa_checked(spark: SparkSession, paths) -> tuple[DataFrame, DataFrame]:
    """(rows, quarantine ``(file_name, line, reason)``): ``read_gfa`` with its bad rows apart: no record type, segments without
    a name or sequence.  Blank lines are neither."""
    filled = lambda c: F.coalesce(F.trim(c), F.lit("")) != ""
    raw = spark.read.text(paths).filter(F.trim("value") != "")
    more = [c for c in raw.columns if c != "value"]
    t = raw.select("value", F.split("value", "\t").alias("f"), F.col("_metadata.file_name").alias("file_name"), *more)
    t = t.select("file_name", *more, "value", *[F.get("f", F.lit(i)).alias(n) for i, n in enumerate(("rec_type", "contig_id", "seq"))])
    reason = (F.when(~F.col("rec_type").rlike("^[A-Z#]$"), "no record type")
               .when((F.col("rec_type") == "S") & ~(filled("contig_id") & filled("seq")), "segment without name or sequence"))
    told = t.withColumn("reason", reason)
    return (told.filter(F.col("reason").isNull()).drop("reason", "value"),
            told.filter(F.col("reason").isNotNull()).select("file_name", F.col("value").alias("line"), "reason"))


# --- SAM -----------------------------------------------------------------------------------------
SAM_COLUMNS = ("read_id", "flag", "ref_id", "pos", "mapq", "cigar", "rnext", "pnext", "tlen", "seq", "qual")


def read_sam_checked(spark: SparkSession, paths, keep_seq: bool = False) -> tuple[DataFrame, DataFrame]:
    """(alignments, quarantine ``(file_name, reason, line)``): ``read_sam`` with its bad rows apart."""
    rows = _sam_rows(spark, paths, keep_seq)
    bad = rows.filter("_bad").select("file_name", F.lit("fewer than 11 fields or text in a numeric one").alias("reason"), F.col("_line").alias("line"))
    return rows.filter(~F.col("_bad")).drop("_bad", "_line"), bad


def read_sam(spark: SparkSession, paths, keep_seq: bool = False) -> DataFrame:
    """SAM text (header optional, gzip native) -> M5 alignments with the NM and MD tags (null without them).

    ``_bad`` marks rows with fewer than 11 fields or text in a numeric one; such cells are null.  Partition columns of
    the folders are kept."""
    return _sam_rows(spark, paths, keep_seq).drop("_line")


def _sam_rows(spark: SparkSession, paths, keep_seq: bool) -> DataFrame:
    raw = spark.read.text(paths)
    more = [c for c in raw.columns if c != "value"]
    t = (raw.filter(~F.col("value").startswith("@"))
            .select("value", F.split("value", "\t").alias("f"), F.col("_metadata.file_name").alias("file_name"), *more))
    cols = [F.get("f", F.lit(i)).alias(n) for i, n in enumerate(SAM_COLUMNS)]
    tags = F.array_join(F.slice("f", F.lit(12), F.greatest(F.size("f"), F.lit(1))), "\t")
    number = lambda c: F.get("f", F.lit(SAM_COLUMNS.index(c))).try_cast("bigint")
    bad = (F.size("f") < 11) | number("flag").isNull() | number("pos").isNull() | number("mapq").isNull()
    out = t.select("file_name", *more, *cols, tags.alias("_tags"), bad.alias("_bad"), F.when(bad, F.col("value")).alias("_line"))
    out = (out.withColumn("flag", F.col("flag").try_cast("int")).withColumn("pos", F.col("pos").try_cast("bigint"))
              .withColumn("mapq", F.col("mapq").try_cast("int"))
              .withColumn("tag_nm", F.regexp_extract("_tags", r"(?:^|\t)NM:i:(-?\d+)", 1).try_cast("bigint"))
              .withColumn("tag_md", F.nullif(F.regexp_extract("_tags", r"(?:^|\t)MD:Z:(\S+)", 1), F.lit("")))
              .drop("_tags", "rnext", "pnext", "tlen"))
    return out if keep_seq else out.drop("seq", "qual")


def write_sam_text(aln: DataFrame, path: str, partition_by: str = "sample_id", compression: str = "gzip") -> None:
    from ..operators.alignments import sam_text
    sam_text(aln).write.mode("overwrite").option("compression", compression).partitionBy(partition_by).text(path)


def sample_from_file_name(df: DataFrame, suffixes=(".sam.gz", ".sam.xz", ".sam", ".fastq.gz", ".fastq")) -> DataFrame:
    """Sample id = the file name without its known suffix."""
    c = F.col("file_name")
    expr = c
    for s in suffixes:
        expr = F.when(c.endswith(s), F.substring(c, F.lit(1), F.length(c) - len(s))).otherwise(expr)
    return df.withColumn("sample_id", expr)
