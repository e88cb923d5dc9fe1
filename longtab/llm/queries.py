"""Registered queries of the corpus operators: thin functions (spark, sf_dir) -> DataFrame, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from longtab.llm import ann, dialogue, embed_dedup, fim, langid, mixing, packing, pii, simhash, token_files, toxicity, urlfilter, warc
from longtab.llm.common import table

TOKENIZER = "byte_bpe_50k.tiktoken"   # the vocabulary of byte_bpe_50k.json as ranks


WORD_TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def added_tokens() -> packing.Added:
    """Strings that the tokenizer file makes tokens of their own, as it does when loaded (the ranks do not hold them)."""
    import public_tokenizers
    return packing.added_tokens(public_tokenizers.path(TOKENIZER.replace(".tiktoken", ".json")))


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return pii.find(docs, pii.train(docs))


def op2_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    return langid.predict(docs, langid.train(langid.training_rows(docs)))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents", "doc_id", "text"), tokenizer_path(), added=added_tokens())


def op4_urlfilter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages", "page_id", "url")
    return urlfilter.judge(pages, urlfilter.train(urlfilter.labelled_by_rules(pages)))


def op5_embed_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_duplicates(table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return toxicity.predict(docs, toxicity.train(docs, table(spark, sf_dir, "labels", "doc_id", "toxic")))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.decide(table(spark, sf_dir, "documents", "doc_id", "text", "source"))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages", "page_id", "url", "html"))


def op10_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings", "vec_id", "embedding"), F.col("vec_id") % 100 == 0)


def op11_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digests(table(spark, sf_dir, "documents", "doc_id", "text"))


def op12_dialogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dialogue.report(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))


def op13_tokenfiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(table(spark, sf_dir, "documents", "doc_id", "text"), tokenizer_path(WORD_TOKENIZER))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_pii, op2_langid, op3_packing, op4_urlfilter, op5_embed_dedup, op6_simhash, op7_toxicity,
                            op8_mixing, op9_warc, op10_ann, op11_fim, op12_dialogue, op13_tokenfiles)}

SIZED = r"""sized AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents)"""

ORACLE: dict[str, str] = {
    # all pairs of a label, components by recursive reachability over the links
    "op5_embed_dedup": r"""
WITH RECURSIVE ok AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND label IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
    AND list_bool_or(list_transform(embedding, lambda x: x <> 0))),
pairs AS (
  SELECT a.vec_id AS u, b.vec_id AS v FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (SELECT vec_id AS u, vec_id AS r FROM embeddings UNION SELECT p.v, x.r FROM reach x JOIN pairs p ON p.u = x.u),
least AS (SELECT u, min(r) AS c FROM reach GROUP BY u),
n AS (SELECT u, count(*) AS n FROM pairs GROUP BY u)
SELECT e.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, least.c AS component_id, e.vec_id = least.c AS kept
FROM embeddings e JOIN least ON least.u = e.vec_id LEFT JOIN n ON n.u = e.vec_id""",
    "op8_mixing": rf"""
WITH {SIZED},
by_source AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w,
                   source_size * 2 AS cap FROM by_source),
levels AS (SELECT *, row_number() OVER o AS k,
  ((sum(source_size) OVER ())::DOUBLE * 1.5 - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
   / (sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
  FROM weighed WINDOW o AS (ORDER BY cap::DOUBLE / w, source NULLS LAST)),
met AS (SELECT arg_min(level, k) AS met FROM levels WHERE level <= cap::DOUBLE / w),
goal AS (SELECT source, source_size, least(cap::DOUBLE, met * w) AS target,
  ('0x' || substr(md5(CASE WHEN source IS NULL THEN 'mix-' ELSE 'mix:' || source END), 1, 5))::BIGINT / 1048576.0::DOUBLE AS shift
  FROM levels CROSS JOIN met),
places AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY
    greatest(length(bin(size)) - 4, 0) * 16 + (size >> greatest(length(bin(size)) - 4, 0)),
    md5(coalesce(doc_id::VARCHAR, '')), doc_id, size) AS nth FROM sized),
rates AS (SELECT p.*, g.source_size, g.target, g.shift, CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0.0 END AS rate
  FROM places p JOIN goal g ON p.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
  (least(floor(nth * rate + shift) - floor((nth - 1) * rate + shift), 2) * size)::BIGINT AS taken FROM rates""",
    "op9_warc": r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, octet_length(encode(body))::BIGINT AS payload_bytes, sha1(body) AS h FROM p),
f AS (SELECT h, min(page_id) AS first_id FROM d GROUP BY h)
SELECT page_id, payload_bytes, array_to_string(list_transform(range(32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(d.h, (i // 4 * 5 + 1)::INT, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INT + 1, 1)), '')
    AS payload_digest,
  CASE WHEN page_id IS NOT DISTINCT FROM first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS NOT DISTINCT FROM first_id THEN NULL ELSE first_id END AS refers_to
FROM d JOIN f USING (h)""",
    "op11_fim": r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, ''))::BIGINT AS n,
                  sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
d AS (SELECT *, [('0x' || substr(h, 8 * i + 1, 8))::BIGINT for i in range(4)] AS k FROM t),
f AS (SELECT *, least(k[1] % (n + 1), k[2] % (n + 1)) AS a, greatest(k[1] % (n + 1), k[2] % (n + 1)) AS b,
  CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR k[3] % 100 >= 90 THEN 'plain'
       WHEN k[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM d),
o AS (SELECT *, CASE form WHEN 'plain' THEN text
  WHEN 'psm' THEN '<P>' || substr(text, 1, a) || '<S>' || substr(text, b + 1) || '<M>' || substr(text, a + 1, b - a)
  ELSE '<S>' || substr(text, b + 1) || '<P>' || substr(text, 1, a) || '<M>' || substr(text, a + 1, b - a) END AS output FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(output) AS output_sha256, sha256(text) AS restored_sha256 FROM o""",
    # the cheapest and then ASCII-least way to each (row, role state), row by row
    "op12_dialogue": r"""
WITH RECURSIVE src AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(4294967295, list_reduce([4294967295::BIGINT] || list_transform(
      string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda ch: ord(ch)::BIGINT),
      lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, i: xor(x >> 1, 3988292384 * (x & 1))))) % 20 AS m
  FROM conversations),
hit AS (
  SELECT conv_id, turn, CASE m WHEN 4 THEN 'user' ELSE role END AS role,
    CASE m WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE m WHEN 3 THEN [0, 1] ELSE [0] END) AS copy FROM src WHERE m <> 0),
put AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i,
    rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS t FROM hit),
told AS (
  SELECT conv_id, turn, role, text, i, left(role, 1) AS ini, t = '' AS blank,
    t <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS dup,
    right(t, 1) NOT IN ('.', '!', '?') AS cut, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS ini0 FROM put),
n AS (
  SELECT conv_id, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
    count(*) FILTER (blank) AS blank, count(*) FILTER (dup) AS duplicate, count(*) FILTER (cut AND NOT blank AND NOT dup) AS truncated,
    count(*) FILTER (i > 1 AND ini0 || ini NOT IN ('su', 'ua', 'au')) AS illegal FROM told GROUP BY conv_id),
walk AS (
  SELECT conv_id, 0::BIGINT AS i, 0 AS st, {'cost': 0, 'audit': '', 'o': []::VARCHAR[]} AS w FROM n
  UNION ALL
  SELECT conv_id, i, st, min(w) AS w FROM (
    SELECT r.conv_id, r.i,
      CASE e.e WHEN 'D' THEN s.st WHEN 'R' THEN CASE s.st WHEN 2 THEN 3 ELSE 2 END
        ELSE CASE r.ini WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END END AS st,
      {'cost': s.cost + e.c + CASE WHEN e.e <> 'D' AND r.cut AND NOT r.dup THEN 5 ELSE 0 END, 'audit': s.audit || e.e,
       'o': CASE e.e WHEN 'D' THEN s.o WHEN 'K' THEN list_append(s.o, r.role || ':' || r.text)
            ELSE list_append(s.o, CASE s.st WHEN 2 THEN 'assistant:' ELSE 'user:' END || r.text) END} AS w
    FROM (
      SELECT conv_id, i, w.cost + 5 * k AS cost, w.audit || repeat('I', k) AS audit,
        CASE k WHEN 0 THEN st WHEN 1 THEN CASE st WHEN 2 THEN 3 ELSE 2 END ELSE CASE st WHEN 2 THEN 2 ELSE 3 END END AS st,
        CASE k WHEN 0 THEN w.o WHEN 1 THEN list_append(w.o, CASE st WHEN 2 THEN 'assistant:' ELSE 'user:' END)
          ELSE w.o || CASE st WHEN 2 THEN ['assistant:', 'user:'] ELSE ['user:', 'assistant:'] END END AS o
      FROM walk, (VALUES (0), (1), (2)) ks(k)) s
    JOIN told r ON r.conv_id IS NOT DISTINCT FROM s.conv_id AND r.i = s.i + 1,
    (VALUES ('D', 2), ('K', 0), ('R', 1)) e(e, c)
    WHERE (e.e = 'D' OR NOT (r.blank OR r.dup))
      AND (e.e <> 'K' OR (r.ini = 's' AND s.st = 0) OR (r.ini = 'u' AND s.st <> 2) OR (r.ini = 'a' AND s.st = 2)))
  GROUP BY conv_id, i, st),
done AS (
  SELECT w.conv_id, min({'cost': w.w.cost + CASE st WHEN 1 THEN 10 WHEN 2 THEN 5 ELSE 0 END,
    'audit': w.w.audit || CASE st WHEN 1 THEN 'II' WHEN 2 THEN 'I' ELSE '' END,
    'o': w.w.o || CASE st WHEN 1 THEN ['user:', 'assistant:'] WHEN 2 THEN ['assistant:'] ELSE []::VARCHAR[] END}) AS w
  FROM walk w JOIN n ON n.conv_id IS NOT DISTINCT FROM w.conv_id AND n.n = w.i GROUP BY w.conv_id)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(w.cost, 0)::BIGINT AS cost, coalesce(w.audit, '') AS audit,
  sha256(coalesce(array_to_string(w.o, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN n ON n.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN done ON done.conv_id IS NOT DISTINCT FROM c.conv_id""",
}
