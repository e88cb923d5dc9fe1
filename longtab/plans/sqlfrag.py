"""DuckDB SQL fragments for the oracle side (independent of the Spark implementation)."""

from __future__ import annotations


def op_sum(col: str, ops: str) -> str:
    return (f"cast(coalesce(list_sum(list_transform(regexp_extract_all({col}, '(\\d+)[{ops}]', 1), "
            f"lambda x: cast(x AS bigint))), 0) AS bigint)")


def identity(cigar: str = "cigar", nm: str = "tag_nm") -> str:
    cols = op_sum(cigar, "M=XID")
    m = (f"CASE WHEN regexp_matches({cigar}, '\\dM') THEN {op_sum(cigar, 'M=X')} - ({nm} - {op_sum(cigar, 'ID')}) "
         f"ELSE {op_sum(cigar, '=')} END")
    return f"(CASE WHEN {cols} > 0 THEN ({m}) / {cols} END)"


def qcov(cigar: str = "cigar") -> str:
    tot = op_sum(cigar, "M=XISH")
    return f"(CASE WHEN {tot} > 0 THEN {op_sum(cigar, 'M=XI')} / {tot} END)"


def refspan(cigar: str = "cigar") -> str:
    return op_sum(cigar, "M=XDN")


def qspan(cigar: str = "cigar") -> str:
    return op_sum(cigar, "M=XIS")


def revcomp(col: str) -> str:
    return f"reverse(translate({col}, 'ACGT', 'TGCA'))"


def islands(src: str, keys: str, start: str = "start", stop: str = "stop") -> str:
    """Gaps-and-islands merge of half-open intervals; touching intervals merge."""
    return f"""(SELECT {keys}, min({start}) AS {start}, max({stop}) AS {stop} FROM (
  SELECT *, sum(new_isl) OVER (PARTITION BY {keys} ORDER BY {start}, {stop}
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS isl
  FROM (SELECT *, CASE WHEN prev_end IS NULL OR {start} > prev_end THEN 1 ELSE 0 END AS new_isl
        FROM (SELECT {keys}, {start}, {stop},
                     max({stop}) OVER (PARTITION BY {keys} ORDER BY {start}, {stop}
                                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_end
              FROM {src} WHERE {stop} > {start}) a) b) c
GROUP BY {keys}, isl)"""


def depth_runs(src: str, keys: str, start: str = "start", stop: str = "stop") -> str:
    return f"""(SELECT {keys}, p AS {start}, nxt AS {stop}, cast(dep AS bigint) AS depth FROM (
  SELECT {keys}, p, sum(d) OVER (PARTITION BY {keys} ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS dep,
         lead(p) OVER (PARTITION BY {keys} ORDER BY p) AS nxt
  FROM (SELECT {keys}, p, sum(d) AS d FROM (
          SELECT {keys}, {start} AS p, 1 AS d FROM {src} WHERE {stop} > {start}
          UNION ALL SELECT {keys}, {stop} AS p, -1 AS d FROM {src} WHERE {stop} > {start}) e
        GROUP BY {keys}, p HAVING sum(d) <> 0) g) h
WHERE nxt IS NOT NULL)"""
