"""Toxic spans by a linear-chain conditional random field (operator 7).

Tokens are runs of letters, a sequence is a sentence (text up to . ! ? or a line's end).  The two
states are "toxic" and "other".  Token labels come from the document labels: a token of a toxic
document counts as toxic if its word, prefix or suffix occurs mostly in toxic documents (counts of
the labelled sample).  The field's emissions are hashed words, prefixes and suffixes of the token and
its neighbours' words, its transitions a 2 x 2 table; both are trained on the exact likelihood
gradient.  Forward-backward marginals give each token's probability; a logistic layer over
(expected toxic tokens, strongest token, share), fitted on the quarter of the sample that the field has
not seen, gives the document score; tokens at 0.5 or more are the offending offsets.

Learns from a bounded hashed sample per class, in the task that gathers it: the driver gets the model, no text.  Null and empty texts have no token and get the
score of a text without evidence.  Without labels of both classes every score is the share of toxic
labels (0 if there is none).  Repeated label rows of one document: the largest label counts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from longtab.llm.common import by_chars, hashed_sample, id_crc, map_batches, texts_of
from longtab.llm.wordscan import Words, affix_hash, bucket, scan, word_hash

BITS = 18
# Training bounds: documents per class, and characters of a document that may be in the sample.
SAMPLE_TOXIC, SAMPLE_CLEAN, SAMPLE_CHARS = 1500, 3000, 30_000
SAMPLE_TOTAL = 40_000_000      # characters of all sampled texts; the task that learns holds about 8 bytes a token
EPOCHS, BATCH, RATE, DECAY = 4, 60_000, 0.3, 1e-5
LABEL_DOCS = 500   # documents whose distinct features are counted at once
FIELDS = 8   # word, prefix 3/4/5, suffix 4, previous word, next word, bias


@dataclass
class Model:
    weight: np.ndarray      # emission log-odds of "toxic" by hashed feature
    trans: np.ndarray       # log-potentials [from, to], state 1 is toxic
    layer: np.ndarray       # logistic layer: bias and three weights
    base: float             # answer without a field


MODEL = "weight binary, trans binary, layer binary, base double"


@dataclass
class Chains:
    words: Words | None     # positions of the tokens, where they are asked for
    doc: np.ndarray         # text of every token
    feats: np.ndarray       # [tokens, FIELDS]
    seq: np.ndarray         # first token of every sentence
    size: np.ndarray        # tokens of every sentence


@dataclass
class Sample:
    """Chains of many texts with the features of every distinct word held once."""
    doc: np.ndarray         # text of every token
    word: np.ndarray        # row of ``table`` of every token
    table: np.ndarray       # [distinct words, OWN]: features of the word itself, then its value as previous and as next word
    seq: np.ndarray         # first token of every sentence
    size: np.ndarray        # tokens of every sentence

    def part(self, pick: np.ndarray) -> tuple[Chains, np.ndarray]:
        """The sentences ``pick`` as chains of their own, and where their tokens were."""
        size = self.size[pick]
        first = np.cumsum(size) - size
        at = np.repeat(self.seq[pick] - first, size) + np.arange(size.sum())
        return Chains(None, self.doc[at], _features(self.table[self.word[at]], first, size), first, size), at


OWN = 7    # columns of a word alone: word, prefix 3/4/5, suffix 4, as previous word, as next word


def _own(w: Words) -> np.ndarray:
    """[words, OWN] features that depend on the word alone."""
    word = word_hash(w)
    out = np.empty((len(w.start), OWN), dtype=np.int32)
    for i, h in enumerate((word, lambda: affix_hash(w, 3), lambda: affix_hash(w, 4), lambda: affix_hash(w, 5),
                           lambda: affix_hash(w, 4, suffix=True), word, word)):
        out[:, i] = bucket(h() if callable(h) else h, i + 1, BITS)
    return out


def _features(own: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """[tokens, FIELDS] from the tokens' own columns; sentences begin at ``first`` and follow each other."""
    out = np.empty((len(own), FIELDS), dtype=np.int32)
    out[:, :5] = own[:, :5]
    out[1:, 5] = own[:-1, 5]
    out[:-1, 6] = own[1:, 6]
    edge = np.ones(1, dtype=np.uint64)
    out[first, 5] = bucket(edge, 6, BITS)
    out[first + size - 1, 6] = bucket(edge, 7, BITS)
    out[:, 7] = bucket(edge - edge, 8, BITS)
    return out


def _sentences(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """First token and number of tokens of every sentence."""
    n = len(w.start)
    stop = np.cumsum(np.isin(w.codes, np.array([10, 13, 33, 46, 63], dtype=w.codes.dtype)))
    part = stop[w.start] if n else np.zeros(0, dtype=np.int64)
    new = np.flatnonzero(np.diff(part, prepend=-1)) if n else np.zeros(0, dtype=np.int64)
    return new, np.diff(np.append(new, n))


def chains(texts: list[str]) -> Chains:
    w = scan(texts)
    seq, size = _sentences(w)
    return Chains(w, w.doc, _features(_own(w), seq, size), seq, size)


def _distinct(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows, and for every row which of them it is."""
    order = np.lexsort(rows.T)
    held = rows[order]
    new = np.ones(len(rows), bool)
    new[1:] = (held[1:] != held[:-1]).any(axis=1)
    of = np.empty(len(rows), dtype=np.int32)
    of[order] = np.cumsum(new) - 1
    return held[new], of


def sample_chains(texts: list[str]) -> Sample:
    """``chains`` of a sample, slice by slice: a token stays as the number of its word, no characters stay."""
    docs, words, tables, seqs, sizes, tokens = [], [], [], [], [], 0
    for a, b in by_chars(texts):
        w = scan(texts[a:b])
        seq, size = _sentences(w)
        table, of = _distinct(_own(w))
        docs.append((w.doc + a).astype(np.int32))
        words.append(of)
        tables.append(table)
        seqs.append(seq + tokens)
        sizes.append(size)
        tokens += len(of)
    table, of = _distinct(np.concatenate(tables))
    at = 0
    for word, part in zip(words, tables, strict=True):
        word[:] = of[at:at + len(part)][word]
        at += len(part)
    return Sample(np.concatenate(docs), np.concatenate(words), table, np.concatenate(seqs), np.concatenate(sizes))


def messages(c: Chains, em: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward messages as odds of "toxic" (scale cancels with two states)."""
    t = np.exp(trans)
    fwd, bwd = np.ones(len(em)), np.ones(len(em))
    if not len(em):
        return fwd, bwd
    order = np.argsort(-c.size, kind="stable")
    seq, size = c.seq[order], c.size[order]
    longest = int(size[0])
    alive = np.searchsorted(-size, -np.arange(longest), side="left")  # sentences longer than step
    fwd[seq] = em[seq]
    for step in range(1, longest):
        at = seq[:alive[step]] + step
        x = fwd[at - 1]
        fwd[at] = em[at] * (x * t[1, 1] + t[0, 1]) / (x * t[1, 0] + t[0, 0])
    for step in range(longest - 2, -1, -1):
        at = seq[:alive[step + 1]] + step
        y = em[at + 1] * bwd[at + 1]
        bwd[at] = (t[1, 1] * y + t[1, 0]) / (t[0, 1] * y + t[0, 0])
    return fwd, bwd


def emissions(c: Chains, weight: np.ndarray) -> np.ndarray:
    return np.exp(np.clip(weight[c.feats].sum(axis=1), -25, 25))


def marginals(c: Chains, model: Model) -> np.ndarray:
    fwd, bwd = messages(c, emissions(c, model.weight), model.trans)
    odds = np.minimum(fwd * bwd, 1e30)
    return odds / (1 + odds)


def _evidence(c: Chains, p: np.ndarray, n_docs: int) -> np.ndarray:
    """Per document: 1, log(1 + expected toxic tokens), strongest token's probability, share of toxic tokens."""
    doc = c.doc
    total = np.bincount(doc, p, n_docs)
    top = np.zeros(n_docs)
    np.maximum.at(top, doc, p)
    return np.stack([np.ones(n_docs), np.log1p(total), top, total / np.maximum(np.bincount(doc, minlength=n_docs), 1)], axis=1)


def token_labels(c: Sample, toxic: np.ndarray) -> np.ndarray:
    """1 for tokens of toxic documents whose word, prefix or suffix occurs mostly in toxic documents."""
    out = np.zeros(len(c.doc), bool)
    n1, n0 = max(1, int(toxic.sum())), max(1, int((~toxic).sum()))
    cuts = np.searchsorted(c.doc, np.arange(0, len(toxic) + LABEL_DOCS, LABEL_DOCS))   # tokens stand in the texts' order
    for f in range(5):
        a, b = np.zeros(1 << BITS, dtype=np.int64), np.zeros(1 << BITS, dtype=np.int64)
        for x, y in zip(cuts, cuts[1:]):
            pair = np.unique(c.doc[x:y].astype(np.int64) << 32 | c.table[c.word[x:y], f])
            of, cell = toxic[pair >> 32], pair & 0xFFFFFFFF
            a += np.bincount(cell[of], minlength=1 << BITS)
            b += np.bincount(cell[~of], minlength=1 << BITS)
        odds = np.log((a + 0.1) / (n1 + 0.2)) - np.log((b + 0.1) / (n0 + 0.2))
        strong = (a >= max(4, 0.004 * n1)) & (odds > 3.0)
        out |= strong[c.table[:, f]][c.word]
    return out & toxic[c.doc]


def fit_field(c: Sample, y: np.ndarray, seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """AdaGrad on the chain likelihood; batches of whole sentences."""
    rng = np.random.default_rng(seed)
    weight, seen = np.zeros(1 << BITS), np.full(1 << BITS, 1e-3)
    trans, tseen = np.zeros((2, 2)), np.full((2, 2), 1e-3)
    has = np.add.reduceat(y.astype(float), c.seq) > 0 if len(c.seq) else np.zeros(0, bool)
    for _ in range(EPOCHS):
        order = rng.permutation(np.flatnonzero(has | (rng.random(len(c.seq)) < 0.5)))
        for part in np.array_split(order, max(1, int(c.size[order].sum()) // BATCH)):
            b, at = c.part(part)
            if not len(at):
                continue
            t, yy = np.exp(trans), y[at]
            em = emissions(b, weight)
            fwd, bwd = messages(b, em, trans)
            odds = np.minimum(fwd * bwd, 1e30)
            err = yy - odds / (1 + odds)
            g = np.bincount(b.feats.ravel(), np.repeat(err, FIELDS), 1 << BITS) - DECAY * len(at) * weight
            inner = np.ones(len(at), bool)
            inner[b.seq] = False
            i = np.flatnonzero(inner)
            gain = em[i] * bwd[i]
            cells = np.stack([np.full(len(i), t[0, 0]), t[0, 1] * gain, t[1, 0] * fwd[i - 1], t[1, 1] * fwd[i - 1] * gain])
            expect = (cells / cells.sum(axis=0)).sum(axis=1).reshape(2, 2)
            got = np.bincount(2 * yy[i - 1].astype(int) + yy[i], minlength=4).reshape(2, 2)
            gt = (got - expect) / max(1, len(i)) - 1e-3 * trans
            g /= max(1, yy.sum())
            seen += g ** 2
            weight += RATE * g / np.sqrt(seen)
            tseen += gt ** 2
            trans += RATE * 0.2 * gt / np.sqrt(tseen)
    return weight, trans


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + np.eye(x.shape[1]) * 0.05
        w += np.clip(np.linalg.solve(h, x.T @ (weight * (y - p)) - 0.05 * w), -3, 3)
    return w


def fit(texts: list[str], toxic: np.ndarray, clean_weight: float = 1.0) -> Model:
    """Fit on a sample in memory; ``clean_weight``: how many clean documents one of the sample stands for."""
    base = float(toxic.sum() / max(1.0, toxic.sum() + clean_weight * (~toxic).sum()))
    if not len(texts) or toxic.all() or not toxic.any():
        return Model(np.zeros(1 << BITS), np.zeros((2, 2)), np.array([np.log((base + 1e-4) / (1 - base + 1e-4)), 0, 0, 0]), base)
    half = np.arange(len(texts)) % 4 != 0
    half = half if toxic[half].any() and not toxic[half].all() else np.ones(len(texts), bool)
    c = sample_chains([t for t, h in zip(texts, half, strict=True) if h])
    weight, trans = fit_field(c, token_labels(c, toxic[half]))
    model = Model(weight, trans, np.zeros(4), base)
    rest = ~half if toxic[~half].any() and not toxic[~half].all() else half
    kept, parts = [t for t, h in zip(texts, rest, strict=True) if h], []
    for a, b in by_chars(kept):
        c = chains(kept[a:b])
        parts.append(_evidence(c, marginals(c, model), b - a))
    x = np.concatenate(parts)
    y = toxic[rest].astype(float)
    model.layer = _logistic(x, y, np.where(y == 1, 1.0, clean_weight))
    return model


def train(docs: DataFrame, labels: DataFrame, sample_toxic: int = SAMPLE_TOXIC, sample_clean: int = SAMPLE_CLEAN) -> Model:
    """``docs(doc_id, text)``, ``labels(doc_id, toxic)``; only ids whose crc32 as text modulo 5 is not 0 teach.

    The sampled ids (bounded per class) are broadcast; their texts, at most SAMPLE_TOTAL characters in the order of a hash of
    the id, so which ones does not depend on the input's order, meet in one task, which learns.  Only the model comes to the
    driver.  An id with unlike texts gives its least."""
    own = (labels.where(F.col("toxic").isNotNull() & (id_crc() % 5 != 0)).groupBy("doc_id")
           .agg(F.max("toxic").alias("toxic")))
    n = {bool(r.toxic): r["n"] for r in own.groupBy((F.col("toxic") > 0).alias("toxic")).agg(F.count(F.lit(1)).alias("n")).collect()}
    ids = hashed_sample(own.where("toxic > 0"), "doc_id", sample_toxic, "toxic").unionByName(
        hashed_sample(own.where("toxic <= 0"), "doc_id", sample_clean, "toxic"))
    rows = (docs.select("doc_id", "text").where(F.length("text") <= SAMPLE_CHARS)
            .join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), (F.max("toxic") > 0).alias("toxic")))
    held = Window.orderBy(F.xxhash64(F.lit("toxic"), F.col("doc_id")), "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("held", F.sum(F.length("text")).over(held)).where(F.col("held") <= SAMPLE_TOTAL)     # the sample's rows

    def learn(batches):
        found = list(batches)
        if found:
            m = _fit_rows(pa.Table.from_batches(found).sort_by("doc_id"), n)
            yield pa.RecordBatch.from_pylist([{"weight": m.weight.tobytes(), "trans": m.trans.tobytes(), "layer": m.layer.tobytes(),
                                               "base": m.base}])
    got = rows.select("doc_id", "text", "toxic").coalesce(1).mapInArrow(learn, MODEL).first()
    if got is None:
        return fit([], np.zeros(0, bool))
    return Model(np.frombuffer(got.weight), np.frombuffer(got.trans).reshape(2, 2), np.frombuffer(got.layer), got.base)


def _fit_rows(rows: pa.Table, n: dict[bool, int]) -> Model:
    """``fit`` on the sample's rows; ``n``: how many labelled documents there are of either class."""
    toxic = np.array(rows.column("toxic").to_pylist(), dtype=bool)
    share = n.get(True, 0) / max(1, int(toxic.sum()))
    return fit(rows.column("text").to_pylist(), toxic, (n.get(False, 0) / max(1, int((~toxic).sum()))) / max(share, 1e-9))


def score(texts: list[str], model: Model) -> tuple[np.ndarray, list[str]]:
    """(score, offending offsets ``start:end`` joined by commas) per text."""
    scores, offsets = [], []
    for a, b in by_chars(texts):
        c = chains(texts[a:b])
        p = marginals(c, model)
        x = _evidence(c, p, b - a)
        scores.append(1 / (1 + np.exp(-np.clip(x @ model.layer, -30, 30))))
        spans: list[list[str]] = [[] for _ in range(b - a)]
        for i in np.flatnonzero(p >= 0.5):
            d = c.words.doc[i]
            s = c.words.start[i] - c.words.base[d]
            spans[d].append(f"{s}:{s + c.words.length[i]}")
        offsets += [",".join(s) for s in spans]
    return np.concatenate(scores) if scores else np.zeros(0), offsets


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted, spans."""
    def run(batch):
        p, spans = score(texts_of(batch), model)
        return {"doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"), "score": pa.array(p, pa.float64()),
                "predicted": pa.array((p >= 0.5).astype(np.int32)), "spans": pa.array(spans, pa.string())}
    src = docs.select("doc_id", F.coalesce(id_crc() % 5 == 0, F.lit(False)).alias("held_out"), "text")
    return map_batches(src, run, "doc_id long, held_out boolean, score double, predicted int, spans string")


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` scored below 0.5, all columns as they were."""
    def run(batch):
        keep = pa.array(score(texts_of(batch), model)[0] < 0.5)
        kept = batch.filter(keep)
        return dict(zip(kept.schema.names, kept.columns, strict=True))
    return map_batches(docs, run, docs.schema)
