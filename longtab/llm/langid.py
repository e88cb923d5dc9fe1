"""Language ID of mixed-language text (operator 2).

Words are runs of letters.  A word's script (by code-point ranges) narrows the languages to those
whose training letters use that script; each word gets a score per remaining language from hashed
n-grams (1 to 4 letters, with the word's edges); Viterbi with a switching penalty then labels the
words, so a foreign run must earn two switches.  A document's language is the one that labels most
of its letters, the score is that share.

Learned from a bounded hashed sample per language; the text alone is the input of a prediction.
Null and empty texts and texts without letters give ``und`` and score 0.  Words in a script that no
learned language uses say nothing; if all do, the most frequent training language is answered with
score 0.  With no training row every text is ``und``.  Repeated rows are judged each for itself.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from longtab.llm.common import by_chars, id_crc, map_batches, texts_of
from longtab.llm.wordscan import SCRIPTS, Words, bucket, scan

BITS = 14
GRAMS = (1, 2, 3, 4)
# Training bound: documents per language (the smallest hashes).
SAMPLE_DOCS = 4000
WORD_CAP = 4.0     # most a single word may speak against a language
PENALTY = 8.0      # price of a switch between neighbouring words
SHARPEN = 0.35     # overlapping n-grams are not independent
SCRIPT_SHARE = 0.001


@dataclass
class Model:
    langs: list[str]
    weight: np.ndarray    # [(len(GRAMS) << BITS) + 1, languages] log-probabilities; the last row is zero
    allowed: np.ndarray   # [script, language]
    default: int


def grams(w: Words) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per n: (index into the table for every letter, whether the n-gram ends there within the word's edge)."""
    spaced = w.codes.astype(np.uint64)
    is_letter = np.zeros(len(spaced), bool)
    is_letter[w.letter] = True
    spaced[~is_letter] = 32
    at = np.arange(len(w.letter)) - np.repeat(w.first, w.length)
    out, h = [], np.zeros(len(w.letter), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for n in GRAMS:
            h = h * np.uint64(0x100000001B3) + spaced[np.maximum(w.letter - (n - 1), 0)] + np.uint64(1)
            out.append((bucket(h, n, BITS) + ((n - 1) << BITS), at >= n - 2))
    return out


def word_scores(w: Words, model: Model) -> np.ndarray:
    """[words, languages], best language 0, others down to -WORD_CAP; zeros where the script says nothing."""
    k = len(model.langs)
    if not len(w.start):
        return np.zeros((0, k), dtype=np.float32)
    total = np.zeros((len(w.letter), k), dtype=np.float32)
    for index, valid in grams(w):
        total += model.weight.take(np.where(valid, index, len(model.weight) - 1), axis=0)
    s = np.add.reduceat(total, w.first, axis=0) * SHARPEN
    fits = model.allowed[np.minimum.reduceat(w.script, w.first)]
    s = np.where(fits, s, -np.inf)
    best = s.max(axis=1, keepdims=True)
    known = np.isfinite(best)
    return np.where(known, np.maximum(s - np.where(known, best, 0), -WORD_CAP), 0).astype(np.float32)


def viterbi(s: np.ndarray, penalty: float = PENALTY) -> np.ndarray:
    """Best label sequence for scores [words, languages] and one price for every switch."""
    n, k = s.shape
    if n == 0 or k == 1:
        return np.zeros(n, dtype=np.int64)
    total = s.sum(axis=0)
    top = int(total.argmax())
    # A constant path is optimal if no run prefers another language by more than the switches cost.
    gain = np.cumsum((s - s[:, top:top + 1]).astype(np.float64), axis=0)
    low = np.minimum(np.minimum.accumulate(gain, axis=0), 0)
    run = (gain - np.vstack([np.zeros((1, k)), low[:-1]])).max()
    ends = max(gain.max(), 0) + max((gain[-1] - low.min(axis=0)).max(), 0)
    if run <= penalty and ends <= penalty:
        return np.full(n, top)
    back = np.zeros((n, k), dtype=np.int32)
    v = [0.0] * k
    own = list(range(k))
    rows = s.tolist()
    for i, row in enumerate(rows):
        if i:
            best = max(own, key=v.__getitem__)
            jump = v[best] - penalty
            for j in own:
                if v[j] < jump:
                    v[j] = jump
                    back[i, j] = best
                else:
                    back[i, j] = j
        for j in own:
            v[j] += row[j]
    path = np.empty(n, dtype=np.int64)
    at = max(own, key=v.__getitem__)
    for i in range(n - 1, -1, -1):
        path[i] = at
        at = back[i, at]
    return path


def label(texts: list[str], model: Model) -> list[tuple[str, float, str]]:
    """Per text: (language, share of letters, spans ``language:start:end`` joined by commas)."""
    out: list[tuple[str, float, str]] = []
    k = len(model.langs)
    for a, b in by_chars(texts):
        w = scan(texts[a:b])
        s = word_scores(w, model) if k else None
        cut = np.searchsorted(w.doc, np.arange(b - a + 1))
        for i in range(b - a):
            lo, hi = cut[i], cut[i + 1]
            if lo == hi or not k:
                out.append(("und", 0.0, ""))
                continue
            path = viterbi(s[lo:hi])
            length = w.length[lo:hi]
            told = s[lo:hi].any(axis=1) | (k == 1)
            letters = np.bincount(path, np.where(told, length, 0), k)
            if not letters.any():
                out.append((model.langs[model.default], 0.0, ""))
                continue
            top = int(letters.argmax())
            edge = np.flatnonzero(np.diff(path, prepend=-1, append=-1))
            start, end = w.start[lo:hi] - w.base[i], w.start[lo:hi] + length - w.base[i]
            spans = ",".join(f"{model.langs[path[x]]}:{start[x]}:{end[y - 1]}" for x, y in zip(edge, edge[1:]))
            out.append((model.langs[top], float(letters[top] / length.sum()), spans))
    return out


def train(labelled: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Model:
    """``labelled(text, lang)`` with non-null lang -> model.  N-gram and script counts are taken in tasks and
    summed by Spark; what comes back has languages x (table size) cells, whatever the input's size."""
    known = labelled.where("lang is not null and text is not null").select("lang", "text")
    # thinned by hash before any text moves (one row per language is broadcast, as the model holds far more per
    # language); then copies merge and the bound is made exact
    share = known.groupBy("lang").agg(F.least(F.lit(1.0), F.lit(1.0) * sample_docs / F.count(F.lit(1))).alias("share"))
    drawn = known.join(F.broadcast(share), "lang").withColumn("h", F.xxhash64(F.lit("langid"), "text")).where(
        F.pmod("h", F.lit(1 << 40)) < F.col("share") * (1 << 40))
    once = drawn.groupBy("lang", "h").agg(F.first("text").alias("text"))
    rank = Window.partitionBy("lang").orderBy("h")
    sample = once.withColumn("r", F.row_number().over(rank)).where(F.col("r") <= sample_docs).select("lang", "text")
    sample = sample.repartition(max(8, sample.sparkSession.sparkContext.defaultParallelism), F.xxhash64("text"))

    def count(batches):
        for batch in batches:
            texts, langs = texts_of(batch), np.array(batch.column("lang").to_pylist(), dtype=object)
            for a, b in by_chars(texts):
                w = scan(texts[a:b])
                of = langs[a:b][np.repeat(w.doc, w.length)]
                for lang in set(langs[a:b]):
                    mine = of == lang
                    cells = np.zeros((len(GRAMS) << BITS) + len(SCRIPTS), dtype=np.int64)
                    for index, valid in grams(w):
                        cells[:len(GRAMS) << BITS] += np.bincount(index[mine & valid], minlength=len(GRAMS) << BITS)
                    cells[len(GRAMS) << BITS:] = np.bincount(w.script[mine], minlength=len(SCRIPTS))
                    at = np.flatnonzero(cells)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(cells[at])],
                                                     names=["lang", "cell", "n"])
    cells = (sample.mapInArrow(count, "lang string, cell long, n long").groupBy("lang", "cell")
             .agg(F.sum("n").alias("n")).toArrow())
    names = np.array(cells.column("lang").to_pylist(), dtype=object)
    langs = sorted(set(names))
    size = len(GRAMS) << BITS
    table = np.zeros((size + len(SCRIPTS), len(langs)))
    table[cells.column("cell").to_numpy(), [langs.index(x) for x in names]] = cells.column("n").to_numpy()
    weight = np.zeros((size + 1, len(langs)), dtype=np.float32)
    for g in range(len(GRAMS)):
        part = table[g << BITS:(g + 1) << BITS] + 0.3
        weight[g << BITS:(g + 1) << BITS] = np.log(part / part.sum(axis=0))
    scripts = table[size:]
    allowed = scripts > SCRIPT_SHARE * np.maximum(scripts.sum(axis=0), 1)
    return Model(langs, weight, allowed, int(scripts.sum(axis=0).argmax()) if langs else 0)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: doc_id, held_out, lang_pred, score, spans."""
    def run(batch):
        found = label(texts_of(batch), model)
        return {"doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"),
                "lang_pred": pa.array([x[0] for x in found], pa.string()),
                "score": pa.array([x[1] for x in found], pa.float64()),
                "spans": pa.array([x[2] for x in found], pa.string())}
    src = docs.select("doc_id", F.coalesce(id_crc() % 3 == 1, F.lit(False)).alias("held_out"), "text")
    return map_batches(src, run, "doc_id long, held_out boolean, lang_pred string, score double, spans string")


def training_rows(docs: DataFrame) -> DataFrame:
    """Rows a model may learn from: crc32 of the id as text modulo 3 is not 1, lang not null."""
    return docs.where((id_crc() % 3 != 1) & F.col("lang").isNotNull()).select("lang", "text")
