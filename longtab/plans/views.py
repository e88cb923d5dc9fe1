"""Domain views over the driver's tables.

The driver ships TPC-H-like tables and a document corpus, not sequencing data.  Each view
below turns them, deterministically, into one of our domain tables (alignments, reference
lengths, genes, functional maps, contigs, reads, quality tables, manifests, status rows,
feature tables ...).  Every view is plain SQL accepted by both Spark and DuckDB, so the
very same text feeds the Spark operators and the DuckDB oracle; only the operators
themselves differ (DataFrame API on one side, hand-written SQL on the other).

Placeholders: ``{lineitem}`` etc. name a driver table; ``{v_align}`` etc. name another
view.  ``{re_g}`` is the extra argument DuckDB needs to make ``regexp_replace`` global.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from ..session import scan_partitions, spread

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# Text -> DNA: letters only, lower-cased, folded onto A/C/G/T by letter position.
_DNA = ("translate(lower(regexp_replace({col}, '[^a-zA-Z]', ''{re_g})), "
        "'abcdefghijklmnopqrstuvwxyz', 'ACGTACGTACGTACGTACGTACGTAC')")


def dna(col: str) -> str:
    return _DNA.replace("{col}", col)


VIEWS: dict[str, str] = {}

# Alignments (SAM-like).  read = order, sample = order mod 8, reference = supplier,
# position from the part key; CIGAR built from quantity / tax / discount / line number.
VIEWS["v_align"] = """
SELECT sample_id, read_id, flag,
       CASE WHEN flag = 4 THEN '*' ELSE ref END AS ref_id,
       CASE WHEN flag = 4 THEN 0 ELSE p END AS pos,
       60 AS mapq,
       CASE WHEN flag = 4 THEN '*' ELSE cig END AS cigar,
       CASE WHEN flag = 4 THEN 0 ELSE nm END AS tag_nm,
       CASE WHEN flag = 4 THEN '*' ELSE cast(nq AS string) END AS tag_md
FROM (
  SELECT 'S' || cast(l_orderkey % 8 AS string) AS sample_id,
         'r' || cast(l_orderkey AS string) AS read_id,
         CASE WHEN l_linenumber = 7 AND l_returnflag = 'A' THEN 4
              WHEN l_linenumber = 6 THEN 2048
              WHEN l_linenumber = 5 AND l_returnflag = 'N' THEN 256
              WHEN l_linestatus = 'O' THEN 16 ELSE 0 END AS flag,
         'g' || cast(l_suppkey AS string) AS ref,
         l_partkey * 7 + 1 AS p,
         nq,
         CASE WHEN ns > 0 THEN cast(ns AS string) || CASE WHEN l_linenumber = 4 THEN 'H' ELSE 'S' END ELSE '' END
         || CASE WHEN l_returnflag = 'R' THEN cast(nq + nx AS string) || 'M'
                 ELSE cast(nq AS string) || '=' || CASE WHEN nx > 0 THEN cast(nx AS string) || 'X' ELSE '' END END
         || CASE WHEN nd > 0 THEN cast(nd AS string) || 'D' ELSE '' END
         || CASE WHEN ni > 0 THEN cast(ni AS string) || 'I' ELSE '' END AS cig,
         nx + ni + nd AS nm
  FROM (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_returnflag, l_linestatus,
               cast(l_quantity AS bigint) AS nq,
               cast(round(l_tax * 100) AS bigint) AS nx,
               cast(round(l_discount * 100) AS bigint) AS ni,
               cast(l_linenumber % 3 AS bigint) AS nd,
               cast(l_linenumber - 1 AS bigint) AS ns
        FROM {lineitem}) a
) b
"""

# Reference lengths: one per supplier, longer than any alignment end.
VIEWS["v_lengths"] = """
SELECT 'g' || cast(s_suppkey AS string) AS ref_id,
       (SELECT max(p_partkey) FROM {part}) * 7 + 200 + s_suppkey AS length
FROM {supplier}
"""

# Gene coordinates: one 40-base gene per part, placed on reference (part*13 mod suppliers).
VIEWS["v_genes"] = """
SELECT 'g' || cast((p_partkey * 13) % (SELECT max(s_suppkey) + 1 FROM {supplier}) AS string) AS ref_id,
       'p' || cast(p_partkey AS string) AS gene_id,
       p_partkey * 7 AS start,
       p_partkey * 7 + 40 AS stop
FROM {part}
"""

# Functional maps (map, source, target), one-to-many, some genes unmapped.
VIEWS["v_maps"] = """
SELECT DISTINCT map, source, target FROM (
  SELECT 'ko' AS map, 'p' || cast(p_partkey AS string) AS source, 'K' || cast(p_size AS string) AS target
    FROM {part} WHERE p_partkey % 7 <> 0
  UNION ALL
  SELECT 'ko', 'p' || cast(p_partkey AS string), 'K' || cast(p_size % 50 + 1 AS string)
    FROM {part} WHERE p_partkey % 3 = 0 AND p_partkey % 7 <> 0
  UNION ALL
  SELECT 'ec', 'K' || cast(p_size AS string), 'EC' || cast(p_size % 12 AS string) FROM {part}
  UNION ALL
  SELECT 'ec', 'K' || cast(p_size AS string), 'EC' || cast(p_size % 5 AS string) FROM {part} WHERE p_size % 4 = 0
  UNION ALL
  SELECT 'reaction', 'K' || cast(p_size AS string), 'R' || cast(p_size % 20 AS string) FROM {part} WHERE p_size % 9 <> 0
  UNION ALL
  SELECT 'reaction', 'K' || cast(p_size AS string), 'R' || cast(p_size % 7 AS string) FROM {part} WHERE p_size % 2 = 0
  UNION ALL
  SELECT 'module', 'R' || cast(p_size % 20 AS string), 'M' || cast(p_size % 6 AS string) FROM {part}
  UNION ALL
  SELECT 'pathway', 'M' || cast(p_size % 6 AS string), 'P' || cast(p_size % 3 AS string) FROM {part}
  UNION ALL
  SELECT 'pathway', 'M' || cast(p_size % 6 AS string), 'P' || cast((p_size + 1) % 3 AS string)
    FROM {part} WHERE p_size % 2 = 1
) m
"""

# Contigs: one per document; sample = source; genome = source + doc mod 7;
# ids ending in 'c' (every fifth) are circular.
VIEWS["v_contigs"] = """
SELECT 100 + (doc_id % 7) % 3 AS artifact_id,
       source AS sample_id,
       source || '_bin.' || cast(doc_id % 7 AS string) AS genome_id,
       's' || cast(doc_id AS string) || '.ctg' || lpad(cast(doc_id AS string), 6, '0')
         || CASE WHEN doc_id % 5 = 0 THEN 'c' ELSE 'l' END AS contig_id,
       doc_id AS ord,
       """ + dna("text") + """ AS seq
FROM {documents}
"""

# Assembly graph rows: mostly S rows, some L rows that must be ignored.
VIEWS["v_gfa"] = """
SELECT sample_id, CASE WHEN ord % 11 = 3 THEN 'L' ELSE 'S' END AS rec_type, contig_id, seq
FROM {v_contigs}
"""

# Reads: one per document.
VIEWS["v_reads"] = """
SELECT source AS sample_id, 'q' || cast(doc_id AS string) AS read_id, seq,
       CASE WHEN doc_id % 2 = 0 THEN translate(seq, 'ACGT', 'I?5+') ELSE translate(seq, 'ACGT', '?I+5') END AS qual
FROM (SELECT source, doc_id, """ + dna("text") + """ AS seq FROM {documents}) d
"""

# Read hits against the spike-in plasmids and the host genome.
VIEWS["v_read_hits"] = """
SELECT d.source AS sample_id, 'q' || cast(l.doc_id AS string) AS read_id,
       CASE WHEN l.quality = 0 AND l.toxic = 0 THEN 4 WHEN l.doc_id % 9 = 0 THEN 2048 ELSE 0 END AS flag,
       CASE WHEN l.toxic = 1 THEN 'plasmid' ELSE 'host' END AS ref_id,
       cast(l.doc_id % 4 AS string) || 'S' || cast(900 + d.n_chars % 300 AS string) || '='
         || CASE WHEN l.doc_id % 3 > 0 THEN cast(l.doc_id % 3 AS string) || 'X' ELSE '' END AS cigar,
       cast(l.doc_id % 3 AS bigint) AS tag_nm
FROM {labels} l JOIN {documents} d ON l.doc_id = d.doc_id
"""

# Contig -> bin labels from three binners, with bin scores and pseudo-bins.
VIEWS["v_bins"] = """
SELECT sample_id, 'CONCOCT' AS binner, contig_id,
       CASE WHEN ord % 13 = 0 THEN 'unbinned' ELSE 'concoct.' || cast(ord % 4 AS string) END AS bin_id,
       cast(ord % 10 AS double) / 10 AS score
FROM {v_contigs}
UNION ALL
SELECT sample_id, 'MaxBin', contig_id, 'maxbin.' || cast(ord % 3 AS string), cast((ord * 7) % 10 AS double) / 10
FROM {v_contigs} WHERE ord % 2 = 0
UNION ALL
SELECT sample_id, 'MetaBAT', contig_id,
       CASE WHEN ord % 11 = 0 THEN 'bin.lowDepth' WHEN ord % 17 = 0 THEN 'bin.tooShort'
            WHEN ord % 19 = 0 THEN 'bin.unbinned' ELSE 'bin.' || cast(ord % 5 AS string) END,
       cast((ord * 3) % 10 AS double) / 10
FROM {v_contigs} WHERE ord % 3 <> 1
"""

# Genome quality table (CheckM-like), one row per genome.
VIEWS["v_quality"] = """
SELECT artifact_id, sample_id, genome_id AS bin_id,
       cast(40 + (m * 7) % 61 AS double) AS completeness,
       cast((m * 3) % 15 AS double) AS contamination,
       cast((m % 5) * 25 AS double) AS strain_heterogeneity
FROM (SELECT artifact_id, sample_id, genome_id, min(ord) AS m FROM {v_contigs}
      GROUP BY artifact_id, sample_id, genome_id) g
"""

# Preparation rows (sample_name, run_prefix, ord): nested prefixes and a duplicated prefix.
VIEWS["v_prep"] = """
SELECT 'SMP.' || source || '.' || lang AS sample_name, source || '_' || lang AS run_prefix, min(doc_id) AS ord
FROM {documents} GROUP BY source, lang
UNION ALL
SELECT 'SMP.' || source, source, min(doc_id) + 100000000 FROM {documents}
WHERE source IN ('src1', 'src2', 'src3') GROUP BY source
UNION ALL
SELECT 'DUP.' || source || '.' || lang, source || '_' || lang, max(doc_id) + 200000000 FROM {documents}
WHERE lang = 'de' GROUP BY source, lang
"""

# Sequencing file names to be matched to samples.
VIEWS["v_files"] = """
SELECT doc_id AS file_no,
       CASE WHEN doc_id % 6 = 0 THEN source || '_' || lang || '_L001_R1_001.fastq.gz'
            WHEN doc_id % 6 = 1 THEN source || '_' || lang || '.fastq.gz'
            WHEN doc_id % 6 = 2 THEN source || '_' || lang || 'X' || cast(doc_id AS string) || '.fq'
            WHEN doc_id % 6 = 3 THEN source || lang || '.' || cast(doc_id AS string)
            WHEN doc_id % 6 = 4 THEN source || '_' || lang
            ELSE 'zz' || cast(doc_id AS string) END AS file_name
FROM {documents}
"""

# Artifacts: what is asked for, the tree above, files and preparation rows of the parents.  One artifact has no
# parents, one parent no files, one files but no preparation.
VIEWS["v_artifacts"] = """
SELECT DISTINCT 100 + doc_id % 7 AS artifact_id FROM {documents}
"""
VIEWS["v_artifact_tree"] = """
SELECT DISTINCT 100 + doc_id % 7 AS artifact_id, 200 + (doc_id % 35) % 5 AS parent_id FROM {documents} WHERE doc_id % 7 <> 6
"""
VIEWS["v_artifact_files"] = """
SELECT 200 + file_no % 5 AS artifact_id, '/data/' || cast(file_no % 5 AS string) || '/' || file_name AS path,
       CASE WHEN file_no % 9 = 4 THEN 'rev' ELSE 'fwd' END AS kind
FROM {v_files} WHERE file_no % 5 <> 4
"""
VIEWS["v_artifact_preps"] = """
SELECT 200 AS artifact_id, 'A.' || sample_name AS sample_name, run_prefix, ord FROM {v_prep}
UNION ALL SELECT 201, 'B.' || sample_name, run_prefix, ord FROM {v_prep} WHERE ord % 2 = 0
UNION ALL SELECT 202, 'C.' || sample_name, run_prefix, ord FROM {v_prep} WHERE ord < 100000000
"""

# Step status rows of batch tasks.
VIEWS["v_status"] = """
SELECT 'J' || cast(user_id % 3 AS string) AS job_id, 1 + event_id % 7 AS step, user_id AS task,
       'u' || cast(user_id AS string) AS sample_id,
       CASE WHEN event_type = 'error' THEN 'failed' WHEN event_type = 'signup' THEN 'skipped'
            ELSE 'completed' END AS state,
       event_type || ':' || cast(event_id AS string) AS message
FROM {events}
"""

# Per-table feature counts (COO); sample s lives in table s mod 4 only.
VIEWS["v_tables"] = """
SELECT 't' || cast(l_orderkey % 4 AS string) AS table_id,
       'S' || cast(l_orderkey % 8 AS string) AS sample_id,
       'p' || cast(l_partkey AS string) AS feature_id,
       sum(l_quantity) AS value
FROM {lineitem}
GROUP BY l_orderkey % 4, l_orderkey % 8, l_partkey
"""

# Spike-in counts with a fixed mass ladder.
VIEWS["v_syndna"] = """
SELECT sample_id, insert_id, read_count, power(10.0, cast(k AS double) / 2.0 - 2.0) AS mass_ng
FROM (SELECT 'S' || cast(l_orderkey % 8 AS string) AS sample_id,
             'i' || cast(l_partkey % 10 AS string) AS insert_id,
             l_partkey % 10 AS k,
             count(*) AS read_count
      FROM {lineitem} GROUP BY l_orderkey % 8, l_partkey % 10) s
"""

# Named adapter files: one per region, sequence from the region name.
VIEWS["v_adapter_files"] = """
SELECT lower(r_name) || '.fasta' AS file_name, r_regionkey AS rec_no,
       'adp_' || lower(r_name) AS adapter_id,
       """ + dna("r_name || r_name || 'tgca' || r_name") + """ AS seq
FROM {region}
"""

# Taxonomy summaries (bacterial required, archaeal optional).
VIEWS["v_tax_bac"] = """
SELECT genome_id AS user_genome, 'd__Bacteria;p__' || sample_id AS classification, 'bac120' AS marker_set
FROM (SELECT DISTINCT genome_id, sample_id FROM {v_contigs}) g WHERE sample_id <> 'src0'
"""
VIEWS["v_tax_ar"] = """
SELECT genome_id AS user_genome, 'd__Archaea;p__' || sample_id AS classification
FROM (SELECT DISTINCT genome_id, sample_id FROM {v_contigs}) g WHERE sample_id = 'src0'
"""

# A Newick tree over the even parts, grouped by size into labelled subtrees; tips of parts
# ending in 2 carry a space (written as an underscore in feature ids).
VIEWS["v_tree"] = """
SELECT '(' || string_agg(sub, ',') || ')root;' AS newick FROM (
  SELECT '(' || string_agg(tip, ',') || ')n' || cast(p_size AS string) || ':0.5' AS sub FROM (
    SELECT p_size, CASE WHEN p_partkey % 10 = 2 THEN 'p ' ELSE 'p' END || cast(p_partkey AS string)
                   || ':0.' || cast(p_size AS string) AS tip
    FROM {part} WHERE p_partkey % 2 = 0) t
  GROUP BY p_size) s
"""

# Expected samples of a spike-in run: one more sample than the counts cover.
VIEWS["v_manifest"] = """
SELECT DISTINCT 'S' || cast(o_orderkey % 9 AS string) AS sample_id FROM {orders}
"""

# Sequence titles for the keyword filter.
VIEWS["v_titles"] = """
SELECT p_partkey AS rec_no, '>ctg' || cast(p_partkey AS string) || ' ' || p_name || ' len=' || cast(p_size AS string) AS title
FROM {part}
"""

# Genome file names (NCBI-style, compressed, plain) and a metadata map for some of them.
VIEWS["v_genome_files"] = """
SELECT p_partkey AS file_no,
       CASE WHEN p_partkey % 5 = 0 THEN 'GCF_' || lpad(cast(p_partkey AS string), 9, '0') || '.1_ASM'
                                        || cast(p_size AS string) || 'v1_genomic.fna.gz'
            WHEN p_partkey % 5 = 1 THEN 'GCA_' || lpad(cast(p_partkey AS string), 9, '0') || '.2_x.fna.bz2'
            WHEN p_partkey % 5 = 2 THEN replace(p_name, ' ', '_') || '_' || cast(p_partkey AS string) || '.fna'
            WHEN p_partkey % 5 = 3 THEN 'g' || cast(p_partkey AS string) || '.fa.xz'
            ELSE 'GCF_' || cast(p_partkey AS string) || '.1_short.fna' END AS file_name
FROM {part}
"""
VIEWS["v_genome_meta"] = """
SELECT replace(p_name, ' ', '_') || '_' || cast(p_partkey AS string) AS file_stem,
       'GEN' || cast(p_partkey % 300 AS string) AS genome_id
FROM {part} WHERE p_partkey % 5 = 2 AND p_partkey % 4 <> 0
"""

# Gap specifications for genome concatenation.
VIEWS["v_gap_specs"] = """
SELECT p_partkey AS spec_no,
       CASE WHEN p_partkey % 3 = 0 THEN 'N*' || cast(p_size AS string)
            WHEN p_partkey % 3 = 1 THEN p_brand || '*' || cast(p_size % 4 AS string)
            ELSE p_type || '*x' END AS spec
FROM {part}
"""

# Reads carrying adapters: same adapter at both ends (every 4th read, after a few junk
# bases), two different adapters, one adapter only, or none.
VIEWS["v_lima_reads"] = """
SELECT sample_id, read_id, seq, translate(seq, 'ACGT', 'I?5+') AS qual FROM (
  SELECT d.source AS sample_id, 'q' || cast(d.doc_id AS string) AS read_id,
         CASE WHEN d.doc_id % 4 = 0 THEN repeat('A', cast(d.doc_id % 5 AS integer)) || a5.seq || d.dna
                                         || reverse(translate(a5.seq, 'ACGT', 'TGCA'))
              WHEN d.doc_id % 4 = 1 THEN a5.seq || d.dna || reverse(translate(a3.seq, 'ACGT', 'TGCA')) || 'CC'
              WHEN d.doc_id % 4 = 2 THEN d.dna || reverse(translate(a3.seq, 'ACGT', 'TGCA'))
              ELSE d.dna END AS seq
  FROM (SELECT doc_id, source, """ + dna("text") + """ AS dna FROM {documents}) d
  JOIN {v_adapter_files} a5 ON a5.rec_no = d.doc_id % 5
  JOIN {v_adapter_files} a3 ON a3.rec_no = (d.doc_id + 2) % 5) r
"""

# Per-sample counts tables of the adapter tool, rows in file order.
VIEWS["v_lima_counts"] = """
SELECT 'S' || cast(l_orderkey % 8 AS string) AS sample_id, l_orderkey * 10 + l_linenumber AS row_no,
       cast(l_quantity AS bigint) AS Counts
FROM {lineitem}
"""

# Host reference for the k-mer screen: the benchmark passages (some are inside documents).
VIEWS["v_bench_ref"] = """
SELECT item_id, """ + dna("text") + """ AS seq FROM {benchmark}
"""

# Genomes to dereplicate: one per document (near copies exist), with a quality score.
VIEWS["v_drep_genomes"] = """
SELECT 'd' || cast(doc_id AS string) AS genome_id, """ + dna("text") + """ AS seq,
       cast((doc_id * 37) % 101 AS double) AS score
FROM {documents}
"""

# Genomes pooled over artifacts: one per document, in two contigs; every fifth is a circular one, whose name carries its
# artifact already.  With it the quality rows, alignments to the contigs (some to contigs nobody has) and a tree.
VIEWS["v_pool_contigs"] = """
SELECT artifact_id, genome_id, kind, 'ctg' || cast(doc_id AS string) || '.1' AS contig_id, 1 AS ord,
       substr(seq, 1, cast(floor(length(seq) / 2.0) AS int)) AS seq
FROM {v_pool_whole}
UNION ALL
SELECT artifact_id, genome_id, kind, 'ctg' || cast(doc_id AS string) || '.2', 2, substr(seq, cast(floor(length(seq) / 2.0) AS int) + 1)
FROM {v_pool_whole}
"""
VIEWS["v_pool_whole"] = """
SELECT doc_id, 100 + doc_id % 3 AS artifact_id,
       CASE WHEN doc_id % 5 = 0 THEN cast(100 + doc_id % 3 AS string) || '_' ELSE '' END || 'b' || cast(doc_id AS string) AS genome_id,
       CASE WHEN doc_id % 5 = 0 THEN 'LCG' ELSE 'MAG' END AS kind, """ + dna("text") + """ AS seq
FROM {documents}
"""
VIEWS["v_pool_quality"] = """
SELECT artifact_id, genome_id AS bin_id, kind, cast(40 + (doc_id * 7) % 61 AS double) AS completeness,
       cast((doc_id * 3) % 15 AS double) AS contamination, cast((doc_id % 5) * 25 AS double) AS strain_heterogeneity
FROM {v_pool_whole}
"""
VIEWS["v_pool_aln"] = """
SELECT sample_id, read_id, flag, CASE WHEN ref_id = '*' THEN ref_id ELSE 'ctg' || cast(cast(floor((pos - 1) / 7.0) AS bigint) AS string)
                                      || '.' || cast(1 + length(read_id) % 2 AS string) END AS ref_id,
       1 + pos % 97 AS pos, mapq, cigar, tag_nm
FROM {v_align}
"""
VIEWS["v_pool_lengths"] = """
SELECT contig_id AS ref_id, cast(length(seq) + 300 AS bigint) AS length FROM {v_pool_contigs}
"""
VIEWS["v_pool_tips"] = """
SELECT CASE WHEN kind = 'LCG' THEN '' ELSE cast(artifact_id AS string) || '_' END || genome_id AS tip FROM {v_pool_whole} WHERE doc_id % 4 <> 1
"""

_PLACEHOLDER = re.compile(r"\{(\w+)\}")


def _deps(name: str) -> list[str]:
    return [m for m in _PLACEHOLDER.findall(VIEWS[name]) if m in VIEWS]


def render(sql: str, dialect: str, table_ref) -> str:
    """Fill placeholders for one dialect; views are left as bare names (CTEs)."""
    def sub(m):
        key = m.group(1)
        if key == "re_g":
            return ", 'g'" if dialect == "duckdb" else ""
        if key in TABLES:
            return table_ref(key)
        if key in VIEWS:
            return key
        return m.group(0)
    return _PLACEHOLDER.sub(sub, sql)


def closure(names) -> list[str]:
    """Views needed (transitively), in dependency order."""
    out: list[str] = []

    def visit(n):
        for d in _deps(n):
            visit(d)
        if n not in out:
            out.append(n)
    for n in names:
        visit(n)
    return out


def with_clause(names, dialect: str, table_ref) -> str:
    parts = [f"{n} AS ({render(VIEWS[n], dialect, table_ref)})" for n in closure(names)]
    return "WITH " + ",\n".join(parts) + "\n" if parts else ""


def used_views(sql: str) -> list[str]:
    return [v for v in VIEWS if re.search(r"\b" + v + r"\b", sql)]


def duckdb_sql(query_sql: str) -> str:
    """Oracle text: the views a query uses as CTEs in front of it (driver tables by name)."""
    return with_clause(used_views(query_sql), "duckdb", lambda t: t) + query_sql


def spark_table_ref(sf_dir: str):
    return lambda t: f"parquet.`{sf_dir.rstrip('/')}/{t}.parquet`"


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One domain view as a Spark DataFrame (lazy; scans are pruned and pushed down).

    The driver tables are single small files (a few row groups), so a view arrives in fewer
    partitions than task slots; it is spread before the CPU-heavy operators.  On inputs that
    are already split (the cluster case) this is a no-op."""
    ref = spark_table_ref(sf_dir)
    df = spark.sql(with_clause([name], "spark", ref) + f"SELECT * FROM {name}")
    raw = {t for v in closure([name]) for t in _PLACEHOLDER.findall(VIEWS[v]) if t in TABLES}
    n_in = max(scan_partitions(spark, f"{sf_dir.rstrip('/')}/{t}.parquet") for t in raw)
    return spread(df, n_in)
