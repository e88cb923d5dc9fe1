"""Tabular sources and sinks (SRC1, SRC2, SRC7-SRC11, SRC12, SRC13, SRC14, SRC16-SRC18).

All readers use explicit schemas (no inference) and read many files in one scan.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import features as FT

MANIFEST_SCHEMA = T.StructType([T.StructField("sample_id", T.StringType()),
                                T.StructField("path", T.StringType()),
                                T.StructField("artifact_id", T.LongType())])
LENGTHS_SCHEMA = T.StructType([T.StructField("ref_id", T.StringType()),
                               T.StructField("length", T.LongType())])


def _tsv(spark: SparkSession, header: bool = False):
    return spark.read.option("sep", "\t").option("header", str(header).lower()).option("mode", "PERMISSIVE")


# --- readers with a quarantine -------------------------------------------------------------------
# ``read_x_checked`` returns (good rows, quarantine ``(file_name, line, reason)``); every line that is neither blank nor a
# header or comment is in exactly one of them.  The plain readers keep such rows with null cells.
def _text_lines(spark: SparkSession, paths) -> DataFrame:
    """(file_name, line, f): lines that are not blank, without a carriage return at their end, and their tab-separated cells."""
    line = F.regexp_replace("value", "\r$", "")
    return (spark.read.text(paths).select(F.col("_metadata.file_name").alias("file_name"), line.alias("line"))
            .filter(F.trim("line") != "").withColumn("f", F.split("line", "\t")))


def _cell(i: int) -> Column:
    return F.get("f", F.lit(i))


def _apart(rows: DataFrame, reason: Column, *cols: Column | str) -> tuple[DataFrame, DataFrame]:
    told = rows.withColumn("reason", reason)
    return (told.filter(F.col("reason").isNull()).select(*cols),
            told.filter(F.col("reason").isNotNull()).select("file_name", "line", "reason"))


def read_manifest_checked(spark: SparkSession, paths) -> tuple[DataFrame, DataFrame]:
    """SRC1 with its bad lines apart: no path, an empty sample, text for an artifact.  Cells are taken as they stand, quotes too."""
    artifact = F.trim(_cell(2)).try_cast("bigint")
    reason = (F.when(F.trim(_cell(0)) == "", "empty sample").when(F.coalesce(F.trim(_cell(1)), F.lit("")) == "", "no path")
               .when((F.coalesce(F.trim(_cell(2)), F.lit("")) != "") & artifact.isNull(), "artifact is no number"))
    return _apart(_text_lines(spark, paths), reason, _cell(0).alias("sample_id"), _cell(1).alias("path"), artifact.alias("artifact_id"))


def read_lengths_checked(spark: SparkSession, paths) -> tuple[DataFrame, DataFrame]:
    """SRC8 with its bad lines apart: no reference, a length that is no whole number above -1."""
    length = F.trim(_cell(1)).try_cast("bigint")
    reason = (F.when(F.trim(_cell(0)) == "", "empty reference")
               .when(F.coalesce(length < 0, F.lit(True)), "length is no whole number"))
    return _apart(_text_lines(spark, paths), reason, _cell(0).alias("ref_id"), length.alias("length"))


def read_coords_checked(spark: SparkSession, paths) -> tuple[DataFrame, DataFrame]:
    """SRC9 with its bad lines apart: genes of a block without a name, coordinates that are missing, text or below 1."""
    rows = (_coord_lines(spark, paths).withColumn("f", F.split("line", "\t")))
    a, z = (F.trim(_cell(i)).try_cast("bigint") for i in (1, 2))
    reason = (F.when(F.col("ref_id") == "", "no reference").when(F.trim(_cell(0)) == "", "empty gene")
               .when(F.coalesce(F.least(a, z) < 1, F.lit(True)) | a.isNull() | z.isNull(), "coordinate is no whole number from 1"))
    return _apart(rows, reason, "ref_id", _cell(0).alias("gene_id"), (F.least(a, z) - 1).alias("start"),
                  F.greatest(a, z).alias("stop"), F.when(a > z, "-").otherwise("+").alias("strand"))


def read_map_checked(spark: SparkSession, paths, name: str) -> tuple[DataFrame, DataFrame]:
    """SRC10 with its bad lines apart: no source, or no target that is not empty.  Good rows are one per target."""
    targets = F.filter(_after_first(F.col("f")), lambda t: t != "")
    reason = F.when(F.trim(_cell(0)) == "", "empty source").when(F.size(targets) == 0, "no target")
    good, bad = _apart(_text_lines(spark, paths).filter(~F.col("line").startswith("#")), reason, _cell(0).alias("source"), targets.alias("t"))
    return good.select(F.lit(name).alias("map"), "source", F.explode("t").alias("target")), bad


def read_lineage_checked(spark: SparkSession, paths) -> tuple[DataFrame, DataFrame]:
    """SRC11 with its bad lines apart: no reference or no lineage."""
    reason = (F.when(F.trim(_cell(0)) == "", "empty reference").when(F.coalesce(F.trim(_cell(1)), F.lit("")) == "", "no lineage"))
    return _apart(_text_lines(spark, paths), reason, _cell(0).alias("ref_id"), _cell(1).alias("lineage"),
                  F.transform(F.split(_cell(1), ";"), lambda x: F.trim(x)).alias("ranks"))


def read_quality_checked(spark: SparkSession, paths, id_col: str = "Bin Id") -> tuple[DataFrame, DataFrame]:
    """SRC7 with its bad rows apart: no bin, or text for a number (``NA`` is one, too).  ``line`` joins the row's cells by tabs."""
    raw = _tsv(spark, header=True).csv(paths)
    names = [c for c in ("Completeness", "Contamination", "Strain heterogeneity") if c in raw.columns]
    cells = F.array_join(F.array(*[F.col(f"`{c}`") for c in raw.columns]), "\t", "")
    reason = F.when(F.coalesce(F.trim(F.col(f"`{id_col}`")), F.lit("")) == "", "no bin")
    for c in names:
        reason = reason.when(F.col(f"`{c}`").try_cast("double").isNull(), f"{c} is no number")
    rows = raw.withColumn("file_name", F.col("_metadata.file_name")).withColumn("line", cells)
    return _apart(rows, reason, *[F.col(f"`{c}`").try_cast("double").alias(c) if c in names else F.col(f"`{c}`") for c in raw.columns], "file_name")


def read_feature_tsv_checked(spark: SparkSession, paths) -> tuple[DataFrame, DataFrame]:
    """SRC12 with its bad lines apart: no feature, more or fewer cells than the header names samples, text in a cell.  A bad
    line gives no cell; zeros and blanks of good ones are dropped."""
    lines = spark.read.text(paths).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("file_name"),
                                          F.regexp_replace("value", "\r$", "").alias("line"))
    lines = lines.filter((F.trim("line") != "") & ~F.col("line").startswith("# "))
    head = (lines.filter(F.col("line").startswith("#")).groupBy("path").agg(F.min("line").alias("head"))
                 .select("path", _after_first(F.split("head", "\t")).alias("names")))
    rows = (lines.filter(~F.col("line").startswith("#")).withColumn("f", F.split("line", "\t")).join(head, "path", "left")
                 .withColumn("cells", F.transform(_after_first(F.col("f")), lambda x: F.trim(x))))
    reason = (F.when(F.col("names").isNull(), "no header").when(F.trim(_cell(0)) == "", "empty feature")
               .when(F.size("cells") != F.size("names"), "cells and samples differ in number")
               .when(F.exists("cells", lambda x: (x != "") & x.try_cast("double").isNull()), "text in a cell"))
    good, bad = _apart(rows, reason, _cell(0).alias("feature_id"), F.explode(F.arrays_zip("names", "cells")).alias("x"))
    value = F.col("x.cells").try_cast("double")
    return (good.select(F.col("x.names").alias("sample_id"), "feature_id", value.alias("value"))
                .filter(F.col("value").isNotNull() & (F.col("value") != 0)), bad)


def read_manifest(spark: SparkSession, paths) -> DataFrame:
    """SRC1: headerless ``sample, path[, artifact]`` lines, tab separated only; blank lines skipped."""
    df = _tsv(spark).schema(MANIFEST_SCHEMA).csv(paths)
    return df.filter(F.col("sample_id").isNotNull() & (F.trim("sample_id") != ""))


def write_manifest(df: DataFrame, path: str) -> None:
    cols = [c for c in ("sample_id", "path", "artifact_id") if c in df.columns]
    df.select(*cols).write.mode("overwrite").option("sep", "\t").option("header", "false").csv(path)


def _after_first(arr: Column) -> Column:
    """The elements after the first one, however many."""
    return F.slice(arr, F.lit(2), F.greatest(F.size(arr), F.lit(1)))


def read_prep(spark: SparkSession, paths) -> DataFrame:
    """SRC2: preparation table, header row, every column a string."""
    return _tsv(spark, header=True).option("inferSchema", "false").csv(paths)


def read_quality(spark: SparkSession, paths) -> DataFrame:
    """SRC7: quality table with a header (gzip read natively); numeric columns cast, text such as ``NA`` gives null."""
    q = _tsv(spark, header=True).csv(paths).withColumn("file_name", F.col("_metadata.file_name"))
    for c in ("Completeness", "Contamination", "Strain heterogeneity"):
        if c in q.columns:
            q = q.withColumn(c, F.col(c).try_cast("double"))
    return q


def read_lengths(spark: SparkSession, paths) -> DataFrame:
    """SRC8: headerless ``ref_id <tab> length`` with a fixed, typed schema."""
    return _tsv(spark).schema(LENGTHS_SCHEMA).csv(paths)


def _coord_lines(spark: SparkSession, paths) -> DataFrame:
    """(file_name, ref_id, line): the lines of every block that are not blank, by the block's name."""
    blocks = spark.read.option("lineSep", "\n>").text(paths)
    b = blocks.select(F.col("_metadata.file_name").alias("file_name"), F.regexp_replace("value", r"^>", "").alias("v"))
    b = b.select("file_name", F.trim(F.substring_index("v", "\n", 1)).alias("ref_id"),
                 F.explode(_after_first(F.split("v", "\n"))).alias("line"))
    return b.filter(F.trim("line") != "")


def read_coords(spark: SparkSession, paths) -> DataFrame:
    """SRC9: gene coordinates in blocks: ``>ref_id`` then ``gene <tab> a <tab> b`` lines.
    Coordinates are 1-based inclusive and may be reversed (a > b); output is 0-based half-open
    ``start < stop`` plus ``strand``."""
    f = _coord_lines(spark, paths).select("ref_id", F.split("line", "\t").alias("f"))
    a, z = (F.get("f", F.lit(i)).try_cast("bigint") for i in (1, 2))
    both = a.isNotNull() & z.isNotNull()                  # short or textual lines keep their gene with null coordinates
    return f.select("ref_id", F.col("f")[0].alias("gene_id"), F.when(both, F.least(a, z) - 1).alias("start"),
                    F.when(both, F.greatest(a, z)).alias("stop"), F.when(a > z, "-").otherwise("+").alias("strand"))


def read_map(spark: SparkSession, paths, name: str) -> DataFrame:
    """SRC10: functional map lines ``source <tab> target [<tab> target ...]`` -> one row per target."""
    t = spark.read.text(paths).filter(~F.col("value").startswith("#"))
    f = t.select(F.split("value", "\t").alias("f"))
    return f.select(F.lit(name).alias("map"), F.col("f")[0].alias("source"),
                    F.explode(_after_first(F.col("f"))).alias("target")).filter(F.col("target") != "")


def read_lineage(spark: SparkSession, paths) -> DataFrame:
    """SRC11: ``ref_id <tab> lineage`` with the lineage split on ``;`` (carried as metadata)."""
    t = _tsv(spark).schema("ref_id string, lineage string").csv(paths)
    return t.withColumn("ranks", F.transform(F.split("lineage", ";"), lambda x: F.trim(x)))


def read_feature_tsv(spark: SparkSession, paths) -> DataFrame:
    """SRC12: wide feature x sample TSV (``#OTU ID`` header, optional ``# Constructed ...`` line)
    -> COO rows.  Each file's own header names its columns (joined on the file's path; nothing goes to
    the driver); zeros and blanks are dropped."""
    lines = (spark.read.text(paths).filter(~F.col("value").startswith("# "))
             .select("value", F.col("_metadata.file_path").alias("file_path")))
    head = (lines.filter(F.col("value").startswith("#")).groupBy("file_path").agg(F.min("value").alias("head"))
                 .select("file_path", _after_first(F.split("head", "\t")).alias("names")))
    f = lines.filter(~F.col("value").startswith("#")).select("file_path", F.split("value", "\t").alias("f")).join(head, "file_path")
    coo = f.select(F.col("f")[0].alias("feature_id"), "names", F.posexplode(_after_first(F.col("f"))).alias("_i", "_v"))
    coo = coo.select(F.get("names", F.col("_i")).alias("sample_id"), "feature_id", F.col("_v").try_cast("double").alias("value"))
    return coo.filter(F.col("value").isNotNull() & (F.col("value") != 0))


def write_feature_tsv(table: DataFrame, path: str, samples: list[str] | None = None) -> None:
    """SRC12 export: wide TSV with a ``#OTU ID`` header (zeros for absent cells)."""
    wide = FT.to_wide(table, samples).fillna(0.0).withColumnRenamed("feature_id", "#OTU ID")
    wide.write.mode("overwrite").option("sep", "\t").option("header", "true").csv(path)


def write_feature_parquet(table: DataFrame, path: str, partition_by: str | None = "rank") -> None:
    w = table.write.mode("overwrite")
    if partition_by and partition_by in table.columns:
        w = w.partitionBy(partition_by)
    w.parquet(path)


def read_newick(spark: SparkSession, paths) -> DataFrame:
    """SRC13: one Newick text per file (``newick`` column); tips via ``features.tree_tips``."""
    return spark.read.option("wholetext", "true").text(paths).select(
        F.regexp_replace("value", r"[\r\n]", "").alias("newick"))


def read_taxonomy(spark: SparkSession, required: str, optional: str | None = None) -> DataFrame:
    """SRC14: the required summary plus the optional one when it exists, matched by column name."""
    out = _tsv(spark, header=True).csv(required)
    path = optional and spark._jvm.org.apache.hadoop.fs.Path(optional)
    if path and path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        out = out.unionByName(_tsv(spark, header=True).csv(optional), allowMissingColumns=True)
    return out


def read_genome_files(spark: SparkSession, base: str) -> DataFrame:
    """SRC16: genomes pooled across artifact folders ``<base>/<aid>_<x>/<sample>/{LCG,MAG}/*.fna.gz``;
    artifact id (text before the first ``_`` of the folder), sample and kind come from the path.
    One row per FASTA record."""
    from .seqio import read_fasta
    recs = read_fasta(spark, [f"{base}/*/*/LCG/*.fna.gz", f"{base}/*/*/MAG/*.fna.gz"], keep_path=True)
    pat = r"/([^/]+)/([^/]+)/(LCG|MAG)/[^/]+$"
    folder = F.regexp_extract("file_path", pat, 1)
    return (recs.withColumn("artifact_id", F.substring_index(folder, "_", 1))
                .withColumn("sample_id", F.regexp_extract("file_path", pat, 2))
                .withColumn("kind", F.regexp_extract("file_path", pat, 3)))


def _list_files(spark: SparkSession, base: str) -> list[str]:
    """Recursive file listing through the Hadoop filesystem API (names only, no contents)."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(base)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    it = fs.listFiles(path, True)
    out = []
    while it.hasNext():
        out.append(it.next().getPath().toString())
    return out


def read_status(spark: SparkSession, base: str) -> DataFrame:
    """SRC18: task markers ``completed_<task>.log`` / ``failed_<task>.log`` under ``<base>/step-<n>/``
    (or directly under ``base``) -> ``(step, task, state, message)``.

    Markers are usually empty and file scans skip zero-byte files, so the markers come from a
    listing; only the messages are read, from the non-empty ones."""
    names = [p for p in _list_files(spark, base) if p.endswith(".log")]
    files = spark.createDataFrame([(p,) for p in names], "path string")
    contents = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
                     .option("pathGlobFilter", "*.log").load(base).select("path", "content"))
    f = files.join(contents, "path", "left")
    path = F.col("path")
    name = F.regexp_extract(path, r"([^/]+)\.log$", 1)
    msg = F.regexp_replace(F.coalesce(F.decode("content", "UTF-8"), F.lit("")), r"^\s+|\s+$", "")
    return f.select(
        F.regexp_extract(path, r"/step-(\d+)/", 1).cast("int").alias("step"),
        F.regexp_extract(name, r"_(\d+)$", 1).cast("bigint").alias("task"),
        F.when(name.startswith("completed"), "completed").when(name.startswith("failed"), "failed")
         .otherwise("other").alias("state"),
        msg.alias("message"))


def read_counts_last(spark: SparkSession, paths) -> DataFrame:
    """SRC17: the ``Counts`` column (found by header name) of the last row of each counts file."""
    place = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("no"))
    c = _tsv(spark, header=True).csv(paths).select(
        F.col("_metadata.file_name").alias("file_name"), F.col("Counts").try_cast("bigint").alias("Counts"), place.alias("_row"))
    return c.groupBy("file_name").agg(F.max_by("Counts", "_row").alias("counts"))
