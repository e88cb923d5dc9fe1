"""Assembly post-processing over contig tables (FLT5-FLT9, FLT15, REL4, REL13, WIN6).

Contigs: ``(sample_id, contig_id, seq)``; file sizes are computed, never written: a FASTA
record takes ``octet_length(id) + 2`` header bytes plus the sequence and its newlines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the assembly steps.
SMALL_CIRCULAR_KIB = 512          # find -size -512k: size rounded up to KiB must stay below this
BINNING_MIN_BYTES = 526336        # noLCG FASTA must be strictly larger to be binned
MIN_CONTIG_LENGTH = 16000         # binning minimum contig length
FASTA_WIDTH = 60                  # line width of re-written FASTA
# Pseudo-bins written by the binners that are not bins.
PSEUDO_BINS = {
    "MetaBAT": ("bin.unbinned", "bin.lowDepth", "bin.tooShort", "bin.BinInfo"),
    "CONCOCT": ("unbinned",),
}
# Binner by the middle part of ``<sample>.<binner>.tsv``, and the column that holds the bin (the contig is in the first).
BINNER_FILES = {"concoct": ("CONCOCT", 2), "maxbin2": ("MaxBin", 2), "metabat2": ("MetaBAT", 4)}
BIN_SCORE_MIN = 0.5               # best bin must score strictly above this


def segments(gfa: DataFrame) -> DataFrame:
    """SRC5: only ``S`` rows of an assembly graph are contigs."""
    return gfa.filter(F.col("rec_type") == "S").select("sample_id", "contig_id", "seq")


def is_circular(contig_id) -> Column:
    """FLT5: id of at least two characters ending in ``c`` (the dot of ``/.c$/`` is any char)."""
    c = F.col(contig_id) if isinstance(contig_id, str) else contig_id
    return c.rlike(".c$")


def fasta_bytes(contig_id, seq, width: int | None = FASTA_WIDTH) -> Column:
    """FN10: bytes of one FASTA record; ``width=None`` is the unwrapped one-line form."""
    L = F.length(seq).cast("bigint")
    head = F.octet_length(contig_id).cast("bigint") + 2
    if width is None:
        return head + L + 1
    return head + L + F.ceil(L / width).cast("bigint")


def split_circular(contigs: DataFrame, small_kib: int = SMALL_CIRCULAR_KIB) -> DataFrame:
    """FLT6: circular contigs tagged ``LCG`` or ``small_LCG`` by their FASTA file size."""
    circ = contigs.filter(is_circular("contig_id"))
    kib = F.ceil(fasta_bytes(F.col("contig_id"), F.col("seq")) / 1024)
    return circ.withColumn("kind", F.when(kib < small_kib, "small_LCG").otherwise("LCG"))


def non_circular(contigs: DataFrame, lcg: DataFrame) -> DataFrame:
    """REL4: noLCG = all contigs minus the *large* circular ones (small ones stay, as written)."""
    big = lcg.filter(F.col("kind") == "LCG").select("sample_id", "contig_id")
    return contigs.join(big, ["sample_id", "contig_id"], "left_anti").withColumn("kind", F.lit("noLCG"))


def binning_gate(nolcg: DataFrame, lcg: DataFrame, min_bytes: int = BINNING_MIN_BYTES) -> DataFrame:
    """FLT7: per sample noLCG FASTA size; strictly above ``min_bytes`` goes on to binning.

    Without any large circular contig the noLCG file is the unwrapped copy, otherwise it is a
    re-written 60-column FASTA, so the byte formula depends on the sample."""
    has_lcg = lcg.filter(F.col("kind") == "LCG").select("sample_id").distinct().withColumn("_lcg", F.lit(True))
    n = nolcg.join(has_lcg, "sample_id", "left")
    b = F.when(F.col("_lcg").isNull(), fasta_bytes(F.col("contig_id"), F.col("seq"), None)) \
         .otherwise(fasta_bytes(F.col("contig_id"), F.col("seq")))
    per = n.groupBy("sample_id").agg(F.count("*").alias("n_contigs"), F.sum(b).alias("nolcg_bytes"))
    return per.withColumn("passed", F.col("nolcg_bytes") > F.lit(min_bytes))


def min_length(contigs: DataFrame, n: int = MIN_CONTIG_LENGTH) -> DataFrame:
    """FLT8."""
    return contigs.filter(F.length("seq") >= n)


def drop_pseudo_bins(bins: DataFrame) -> DataFrame:
    """FLT9: remove the binners' pseudo-bins."""
    cond = F.lit(False)
    for binner, names in PSEUDO_BINS.items():
        cond = cond | ((F.col("binner") == binner) & F.col("bin_id").isin(*names))
    return bins.filter(~cond)


def contig_bins(bins: DataFrame, nolcg: DataFrame) -> DataFrame:
    """REL13: binner labels of the contigs that were binned (the noLCG set)."""
    return drop_pseudo_bins(bins).join(nolcg.select("sample_id", "contig_id"), ["sample_id", "contig_id"], "left_semi")


def read_binner_files_checked(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """REL13: contig -> bin rows of all binners' ``<sample>.<binner>.tsv`` under ``path``, in one scan.

    Returns (sample_id, binner, contig_id, bin_id), with the bin in the binner's own column, and the quarantine
    (file_path, line, reason): lines of unknown binners, lines too short, empty contigs or bins.  Blank lines are neither."""
    raw = spark.read.option("recursiveFileLookup", "true").text(path).filter(F.trim("value") != "")
    # a percent sign stands only before an escaped byte in a path, a plus sign for itself
    where = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    pattern = rf"([^/=]+)\.({'|'.join(BINNER_FILES)})\.tsv"
    f = raw.select(where.alias("file_path"), F.regexp_replace("value", "\r$", "").alias("line")).select(
        "*", F.split("line", "\t").alias("_f"), F.regexp_extract("file_path", pattern, 1).alias("sample_id"),
        F.regexp_extract("file_path", pattern, 2).alias("_file"))
    binner, bin_id = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, (label, column) in BINNER_FILES.items():
        binner = F.when(F.col("_file") == name, F.lit(label)).otherwise(binner)
        bin_id = F.when(F.col("_file") == name, F.get("_f", F.lit(column - 1))).otherwise(bin_id)
    rows = f.select("*", binner.alias("binner"), F.get("_f", F.lit(0)).alias("contig_id"), bin_id.alias("bin_id"))
    reason = (F.when(F.col("binner").isNull(), "unknown binner").when(F.col("bin_id").isNull(), "too few columns")
               .when((F.col("contig_id") == "") | (F.col("bin_id") == ""), "empty contig or bin"))
    rows = rows.withColumn("reason", reason)
    return (rows.filter(F.col("reason").isNull()).select("sample_id", "binner", "contig_id", "bin_id"),
            rows.filter(F.col("reason").isNotNull()).select("file_path", "line", "reason"))


def read_binner_files(spark: SparkSession, path: str) -> DataFrame:
    return read_binner_files_checked(spark, path)[0]


def write_binner_files(bins: DataFrame, path: str) -> None:
    """The counterpart of ``read_binner_files``: a folder ``file=<sample>.<binner>.tsv`` for each sample and binner; columns in
    front of a binner's bin column repeat the contig."""
    line, name = F.lit(None).cast("string"), F.lit(None).cast("string")
    for file, (label, column) in BINNER_FILES.items():
        hit = F.col("binner") == label
        line = F.when(hit, F.concat_ws("\t", *["contig_id"] * (column - 1), "bin_id")).otherwise(line)
        name = F.when(hit, F.concat_ws(".", "sample_id", F.lit(file), F.lit("tsv"))).otherwise(name)
    bins.select(name.alias("file"), line.alias("value")).write.mode("overwrite").partitionBy("file").text(path)


def best_bin(bins: DataFrame, min_score: float = BIN_SCORE_MIN) -> DataFrame:
    """WIN6: per contig the highest-scoring bin among those scoring > ``min_score``; ties go to
    the smaller (binner, bin id).  An aggregate with map-side combine, not a window."""
    ok = bins.filter(F.col("score") > F.lit(min_score))
    best = ok.groupBy("sample_id", "contig_id").agg(
        F.min_by(F.struct("binner", "bin_id", "score"),
                 F.struct((-F.col("score")).alias("s"), F.col("binner"), F.col("bin_id"))).alias("_b"))
    return best.select("sample_id", "contig_id", "_b.binner", "_b.bin_id", "_b.score")


def samples_without_bins(contigs: DataFrame, best: DataFrame) -> DataFrame:
    """Samples with no bin above the score: a status row ('skipped'), not a failure."""
    return (contigs.select("sample_id").distinct().join(best.select("sample_id").distinct(), "sample_id", "left_anti")
                   .withColumn("state", F.lit("skipped")))


def mag_names(best: DataFrame) -> DataFrame:
    """FLT15: ``sample_binner_bin`` names of the refined bins (one genome per bin)."""
    return best.select("sample_id", F.concat_ws("_", "sample_id", "binner", "bin_id").alias("genome_id"),
                       "contig_id").withColumn("kind", F.lit("MAG"))


def lcg_names(lcg: DataFrame) -> DataFrame:
    """FLT15: ``sample.contig`` names of circular genomes, built from columns."""
    return lcg.select("sample_id", F.concat_ws(".", "sample_id", "contig_id").alias("genome_id"),
                      "contig_id", "kind")
