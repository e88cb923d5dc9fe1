"""URL verdicts: rules first, then logistic regression on hashed n-grams (operator 4, DataFrame functions only).

The host is the text after the first ``://`` up to / ? # or the end, A-Z lower-cased; the path runs on to
? # or the end.  A rule ``host/path`` fits its host and all subdomains if the path starts with the rule's
path; the longest rule that fits decides.  Other URLs go to a logistic regression (spark.ml) on hashed
character n-grams of host and path, trained on a small labelled URL table.

Null URLs and URLs without ``://`` have empty host and path, no rule, and the model's verdict on empty
text.  An empty path (``http://a.net``) does not start with ``/``, so no rule fits it.  If the labelled
table is empty or has one label only, that label (allow if empty) is the verdict.  Repeated rows are
judged each for itself; a URL of any length is read whole, in linear time.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from longtab.llm.common import hashed_sample

# Fixed values of the registered query: (verdict, rule).
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
GRAMS = (2, 3, 4)
FEATURES = 1 << 15
# Training bound: labelled URLs (those with the smallest hashes).
SAMPLE_URLS = 5000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPLIT = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: str | Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, SPLIT, 1), UPPER, LOWER), F.lit(""))


def path_of(url: str | Column) -> Column:
    return F.coalesce(F.regexp_extract(url, SPLIT, 2), F.lit(""))


def _by_length(rules: tuple) -> list[tuple[str, str]]:
    return sorted(rules, key=lambda r: (-len(r[1]), r[1]))


def rule_of(host: str, path: str, rules: tuple = RULES) -> Column:
    """The longest fitting rule of a short, hand-written list, else null."""
    out = F.lit(None).cast("string")
    for _, rule in reversed(_by_length(rules)):
        h, slash, p = rule.partition("/")
        fits = ((F.col(host) == h) | F.endswith(F.col(host), F.lit(f".{h}"))) & F.startswith(F.col(path), F.lit(slash + p))
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


def verdict_of(rule: str, rules: tuple = RULES) -> Column:
    out = F.lit(None).cast("string")
    for verdict, r in rules:
        out = F.when(F.col(rule) == r, F.lit(verdict)).otherwise(out)
    return out


def _grams(text: str, mark: str) -> list[Column]:
    """All n-grams by a lookahead (linear in the text), marked by where they come from."""
    edged = F.concat(F.lit("^"), F.col(text), F.lit("$"))
    return [F.transform(F.regexp_extract_all(edged, F.lit(f"(?s)(?=(.{{{n}}}))"), F.lit(1)), lambda g: F.concat(F.lit(mark), g))
            for n in GRAMS]


def featured(df: DataFrame, host: str = "host", path: str = "path", features: int = FEATURES) -> DataFrame:
    tokens = df.withColumn("url_grams", F.concat(*_grams(host, "h:"), *_grams(path, "p:")))
    return HashingTF(numFeatures=features, inputCol="url_grams", outputCol="url_features").transform(tokens).drop("url_grams")


@dataclass
class Model:
    regression: LogisticRegressionModel | None
    only: str


def train(labelled: DataFrame, sample_urls: int = SAMPLE_URLS) -> Model:
    """``labelled(url, label)``, label allow or block (others and nulls are left out); at most ``sample_urls`` rows."""
    small = hashed_sample(labelled.where(F.col("url").isNotNull() & F.col("label").isin("allow", "block"))
                          .select("url", "label").distinct(), "url", sample_urls, "url")
    parts = small.select(host_of("url").alias("host"), path_of("url").alias("path"),
                         (F.col("label") == "block").cast("double").alias("label"))
    rows = featured(parts).select("url_features", "label").cache()
    seen = {r.label for r in rows.select("label").distinct().collect()}
    if len(seen) < 2:
        return Model(None, "block" if 1.0 in seen else "allow")
    model = LogisticRegression(featuresCol="url_features", labelCol="label", regParam=1e-3, maxIter=40,
                               predictionCol="url_block", probabilityCol="url_probability", rawPredictionCol="url_margin").fit(rows)
    rows.unpersist()
    return Model(model, "")


def judge(pages: DataFrame, model: Model, rules: tuple = RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, block_score) for every row of ``pages(page_id, url)``."""
    parts = pages.select("page_id", host_of("url").alias("host"), path_of("url").alias("path"))
    ruled = parts.withColumn("rule", rule_of("host", "path", rules))
    if model.regression is None:
        scored = ruled.withColumn("block_score", F.lit(1.0 if model.only == "block" else 0.0))
    else:
        from pyspark.ml.functions import vector_to_array
        scored = model.regression.transform(featured(ruled)).withColumn(
            "block_score", vector_to_array("url_probability")[1])
    said = F.when(F.col("block_score") >= 0.5, F.lit("block")).otherwise(F.lit("allow"))
    return scored.select("page_id", "host", "path", "rule",
                         F.coalesce(verdict_of("rule", rules), said).alias("verdict"), "block_score")


def labelled_by_rules(pages: DataFrame, rules: tuple = RULES) -> DataFrame:
    """A labelled URL table (url, label) from the URLs that a rule decides."""
    parts = pages.select("url", host_of("url").alias("host"), path_of("url").alias("path"))
    return (parts.withColumn("rule", rule_of("host", "path", rules)).where("rule is not null")
            .select("url", verdict_of("rule", rules).alias("label")))
