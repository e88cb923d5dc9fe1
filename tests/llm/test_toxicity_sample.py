"""Training of operator 7: the sample stays in a task, and its tokens are held as numbers of distinct words."""

import zlib

import numpy as np
import pytest

from longtab.llm import toxicity

WORDS = "gut schlecht übel nice vile awful tea Kaffee 東京 да нет x été".split()


def made(n: int, seed: int = 5) -> list[str]:
    rng = np.random.default_rng(seed)
    return [" ".join(rng.choice(WORDS, rng.integers(0, 12))) + rng.choice([".", "!", "\n", "", " 12. ", ". vile"]) +
            " ".join(rng.choice(WORDS, rng.integers(0, 5))) for _ in range(n)]


@pytest.fixture
def tables(spark):
    texts = made(120)
    toxic = ["vile" in t for t in texts]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(7, "a later text"), (300, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(t)) for i, t in enumerate(toxic)] + [(300, 1)], "doc_id long, toxic int")
    return texts, toxic, docs, labels


def test_training_brings_no_text_to_the_driver(tables, monkeypatch):
    _, _, docs, labels = tables
    brought = []
    for name in ("toArrow", "collect", "toPandas", "toLocalIterator"):
        def seen(self, *a, f=getattr(type(docs), name), **k):
            brought.append(self.columns)
            return f(self, *a, **k)
        monkeypatch.setattr(type(docs), name, seen)
    toxicity.train(docs, labels)
    assert brought and not any("text" in c for c in brought)


def test_the_task_learns_what_the_rows_give(tables):
    texts, toxic, docs, labels = tables
    taught = [i for i in range(len(texts)) if zlib.crc32(str(i).encode()) % 5]
    own = [min(texts[i], "a later text") if i == 7 else texts[i] for i in taught]
    y = np.array([toxic[i] for i in taught])
    n = y.sum() + (zlib.crc32(b"300") % 5 != 0)          # a labelled document without a text counts, and teaches nothing
    want = toxicity.fit(own, y, 1 / (n / y.sum()))
    got = toxicity.train(docs, labels)
    assert got.base == want.base and np.array_equal(got.weight, want.weight) and want.weight.any()
    assert np.array_equal(got.trans, want.trans) and np.array_equal(got.layer, want.layer)


def test_sample_holds_every_word_once(monkeypatch):
    texts = ["", *made(400), "..", "one"]
    whole = toxicity.chains(texts)
    slices = toxicity.by_chars
    monkeypatch.setattr(toxicity, "by_chars", lambda t: slices(t, 300))
    c = toxicity.sample_chains(texts)
    assert c.word.itemsize + c.doc.itemsize <= 8 and len(c.table) == len(np.unique(c.table, axis=0)) < 200
    got, at = c.part(np.arange(len(c.seq)))
    assert np.array_equal(at, np.arange(len(whole.doc)))
    for name in ("doc", "feats", "seq", "size"):
        assert np.array_equal(getattr(got, name), getattr(whole, name)), name
    pick = np.arange(len(c.seq))[::-3]
    got, at = c.part(pick)
    assert np.array_equal(got.feats, whole.feats[at]) and np.array_equal(got.size, whole.size[pick])


def test_token_labels_count_documents_over_all_blocks(monkeypatch):
    texts = made(200)
    toxic = np.array(["vile" in t for t in texts])
    c = toxicity.sample_chains(texts)
    want = toxicity.token_labels(c, toxic)
    monkeypatch.setattr(toxicity, "LABEL_DOCS", 7)
    assert want.any() and np.array_equal(toxicity.token_labels(c, toxic), want)
