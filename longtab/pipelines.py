"""The six commands as functions (PIPE1-PIPE6): each chains the operators with the command's defaults and
returns its outputs by name, as lazy DataFrames, a verdict per sample among them.

Nothing runs while a command is put together; an output that is not used costs nothing.  Only ``genome_table``
runs jobs at once: de-replication settles genomes in rounds and writes each one's state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .operators import alignments as A
from .operators import audit as AU
from .operators import contigs as CT
from .operators import coverage as COV
from .operators import features as FT
from .operators import profile as P
from .operators import quality as QL
from .operators import reads as RD
from .operators import similarity as SM
from .operators import spikein as SP
from .functions import cigar as C


def profile(aln: DataFrame, lengths: DataFrame, genes: DataFrame, maps: DataFrame, manifest: DataFrame,
            identity: float = 0.9, coverage: float = 0.9) -> dict[str, DataFrame]:
    """PIPE1: ``table`` (rank, sample_id, feature_id, value) over the published ranks, ``coverage`` (per sample
    and over all samples) and ``verdict`` (samples of the manifest without any count are missing)."""
    hits = A.identity_coverage_filter(A.slim(aln), identity, coverage)
    genome = P.genome_profile(hits)
    placed = C.with_alignment_coords(hits.filter(F.col("ref_id") != "*"))
    made = P.functional_tables(P.gene_profile(placed, genes), maps)
    made = {"none": genome, "per-gene": made.pop("gene"), **made}
    table = None
    for rank in P.PUBLISHED_RANKS:
        one = made[rank].select(F.lit(rank).alias("rank"), "sample_id", "feature_id", "value")
        table = one if table is None else table.unionByName(one)
    return {"table": table, "coverage": COV.consolidate(COV.covered_intervals(hits), lengths),
            "verdict": AU.table_audit(manifest, genome)}


def spikein(reads: DataFrame, spike_hits: DataFrame, host_hits: DataFrame, counts: DataFrame, manifest: DataFrame,
            min_sample_counts: int = SP.MIN_SAMPLE_COUNTS, host_identity: float = 99.9,
            host_aligned: float = 95) -> dict[str, DataFrame]:
    """PIPE2: ``reads`` without spike-in and host hits, ``fits`` of counts on mass, ``skipped`` samples and
    ``verdict`` (samples without a spike-in read are empty)."""
    kept = RD.reads_without_host(RD.reads_without_hits(reads, spike_hits), host_hits, host_identity, host_aligned)
    fits, skipped = SP.calibrate(counts, min_sample_counts)
    return {"reads": kept, "fits": fits, "skipped": skipped,
            "verdict": FT.sample_totals(manifest, counts, "read_count")}


def adapter_removal(reads: DataFrame, files: DataFrame, spec: str, manifest: DataFrame, preset: str = "ASYMMETRIC",
                    neighbors: bool = False, peek: bool = False,
                    mismatches: int = RD.ADAPTER_MISMATCHES) -> dict[str, DataFrame]:
    """PIPE3: ``reads`` (trimmed, then one per sequence), ``outcomes`` per sample and a one-row ``verdict``.

    ``peek`` trims with those adapters alone that some sample shows often enough (``peeked``)."""
    adapters = RD.adapter_set(spec, files)
    out = {}
    if peek:
        out["peeked"] = RD.peek_adapters(reads, adapters, mismatches=mismatches)
        adapters = adapters.join(out["peeked"].select("adapter_id"), "adapter_id", "left_semi")
    cut = RD.trim_adapters(reads, adapters, preset, mismatches=mismatches, neighbors=neighbors)
    outcomes = AU.sample_audit(RD.sample_outcome(cut), manifest)
    return {**out, "adapters": adapters, "reads": RD.dedup_reads(cut.filter(F.col("outcome") == "trimmed")),
            "outcomes": outcomes, "verdict": AU.job_outcome(outcomes)}


def assembly(gfa: DataFrame, bins: DataFrame, small_kib: int = CT.SMALL_CIRCULAR_KIB,
             min_bytes: int = CT.BINNING_MIN_BYTES, min_score: float = CT.BIN_SCORE_MIN) -> dict[str, DataFrame]:
    """PIPE4: ``circular`` contigs by kind, ``rest`` (what is binned), ``gate`` per sample, ``best`` bin per
    contig of the samples that pass it, ``genomes`` (large circular ones and bins, named) and ``skipped``
    samples (none of their bins scores)."""
    contigs = CT.segments(gfa)
    circular = CT.split_circular(contigs, small_kib)
    rest = CT.non_circular(contigs, circular)
    gate = CT.binning_gate(rest, circular, min_bytes)
    passed = rest.join(gate.filter("passed").select("sample_id"), "sample_id", "left_semi")
    best = CT.best_bin(CT.contig_bins(bins, passed), min_score)
    large = circular.filter(F.col("kind") == "LCG")
    return {"circular": circular, "rest": rest, "gate": gate, "best": best,
            "genomes": CT.mag_names(best).unionByName(CT.lcg_names(large)),
            "skipped": CT.samples_without_bins(contigs, best)}


def genome_quality(quality: DataFrame, contigs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The part of PIPE5 before de-replication: (quality rows that pass the gate with N50 and score, their contigs),
    both by the pooled name ``<artifact>_<bin>``."""
    pooled = QL.pooled_name(contigs, "genome_id")
    good = QL.quality_gate(QL.merge_quality(quality))
    return (QL.genome_score(good, QL.n50(pooled)),
            pooled.join(good.select("genome_id"), "genome_id", "left_semi"))


def genome_table(quality: DataFrame, contigs: DataFrame, aln: DataFrame, lengths: DataFrame, threshold: float = SM.ANI_THRESHOLD,
                 min_identity: float = 0.95, min_aligned: float = 90, k: int = SM.SKETCH_K,
                 s: int = SM.SKETCH_SIZE, manifest: DataFrame | None = None, tips: DataFrame | None = None) -> dict[str, DataFrame]:
    """PIPE5: ``quality`` (gate passed, scored), ``clusters`` of the de-replication, ``genome_lengths`` of the
    representatives, ``depth`` of every representative per sample (alignments to its contigs), ``coverage``,
    ``consolidated`` (covered share of every contig's reference, per sample and over all samples) and ``table`` (read counts).
    With ``tips`` of a tree the table keeps the genomes on it and ``removed`` names the others; with a ``manifest`` of
    expected samples ``verdict`` tells those without a row.

    ``contigs``: artifact_id, genome_id (the bin), contig_id, ord, seq, and kind where LCG rows carry their artifact;
    ``aln.ref_id`` is a contig id."""
    scored, kept = genome_quality(quality, contigs)
    clusters = SM.dereplicate(SM.coded_sketches(QL.genome_chunks(kept, overlap=k - 1), k, s), scored, threshold, k, s)
    reps = kept.join(clusters.filter("is_rep").select("genome_id"), "genome_id", "left_semi")
    of = reps.select(F.col("contig_id").alias("ref_id"), "genome_id")
    hits = A.min_filter(A.flag_filter(aln), min_identity, min_aligned)
    depth = COV.genome_depth(hits, lengths, genomes=of)
    table = depth.select("sample_id", F.col("genome_id").alias("feature_id"), F.col("read_count").cast("double").alias("value"))
    on_reps = hits.join(of.select("ref_id"), "ref_id", "left_semi")
    out = {"quality": scored, "clusters": clusters, "genome_lengths": QL.genome_lengths(reps), "depth": depth,
           "coverage": COV.coverage_summary(depth), "consolidated": COV.consolidate(COV.covered_intervals(on_reps), lengths)}
    if tips is not None:
        out["removed"] = FT.tree_removed(table, tips)
        table = FT.tree_filter(table, tips).select("sample_id", "feature_id", "value")
    if manifest is not None:
        out["verdict"] = AU.table_audit(manifest, table)
    return {**out, "table": table}


def concat(files: DataFrame, metadata: DataFrame, records: DataFrame, words: str = "", gap: str = QL.GAP) -> dict[str, DataFrame]:
    """PIPE6: ``chunks`` of the genomes (contigs in order, no row holds a genome), ``records`` (a record per contig instead),
    ``genomes`` (one row per genome id, for small ones), ``stats``, and the errors: ``unknown`` files and ``duplicates``
    (genome ids of several files; they are left out).  ``quality.fasta_lines`` and ``exports.write_sorted_text`` write either.

    ``records``: file_name, title, ord, seq; ``words`` drops records by title."""
    mapped = QL.map_genome_ids(files, metadata)
    twice = QL.duplicate_genomes(mapped)
    known = mapped.filter(F.col("genome_id").isNotNull()).join(twice, "genome_id", "left_anti")
    titled = QL.title_filter(records, words) if any(words.split(",")) else records
    contigs = titled.join(known.select("file_name", "genome_id"), "file_name")
    return {"chunks": QL.genome_chunks(contigs, gap), "records": QL.record_chunks(contigs),
            "genomes": QL.concat_genomes(contigs, gap), "stats": QL.concat_stats(contigs),
            "unknown": mapped.filter(F.col("genome_id").isNull()), "duplicates": twice}
