"""Every stage of the pipeline against a brute-force version of it, on its own input: whole rows, with nulls, repeated rows,
a missing id and copies among them."""

import hashlib
import itertools
import math
import zlib
from collections import Counter

import numpy as np
import pytest
from test_operators import base_brute, components_brute, simhash_brute

import corpus_pipeline as CP
from longtab.llm import packing, pii, queries, toxicity

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
ADDED = [(90_001, None, None, None, None), (90_002, "", "en", "a", 0), (90_003, "ask jo@x.example.org or 10.0.0.1 now please", "en", None, 43),
         (90_003, "ask jo@x.example.org or 10.0.0.1 now please", "en", None, 43), (None, "no id here at all", "en", "a", 17),
         (90_004, "word " * 9_000, "en", "a", 45_000)]


@pytest.fixture(scope="module")
def steps(spark):
    """[(name, rows in, rows out)] of all stages."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select(*CP.COLUMNS).unionByName(spark.createDataFrame(ADDED, SCHEMA))
    out, rows = {}, [tuple(r) for r in docs.collect()]
    longest = sorted((r for r in rows if r[1] and r[0] != 90_004), key=lambda r: len(r[1]))[-8:]
    rows += [(91_000 + 10 * i + j, r[1].rsplit(" ", j)[0], *r[2:]) for i, r in enumerate(longest) for j in range(1, 5)]      # near copies
    for name, stage in CP.STAGES:
        got = [tuple(r) if name != "packing" else r for r in stage(spark, spark.createDataFrame(rows, SCHEMA), SF).collect()]
        out[name] = (rows, got)
        rows = got
    return out


def test_toxicity_keeps_what_is_scored_below_half(spark, steps):
    rows, got = steps["toxicity"]
    docs = spark.createDataFrame(rows, SCHEMA)
    model = toxicity.train(docs, spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic"))
    want = [r for r in rows if toxicity.score([r[1] or ""], model)[0][0] < 0.5]
    assert Counter(got) == Counter(want) and 0 < len(want) < len(rows)


def test_simhash_keeps_one_of_each_group_of_all_pairs(steps):
    rows, got = steps["simhash"]
    prints = {r[1]: simhash_brute(r[1]) for r in rows}
    first = {}
    for r in rows:
        if r[0] is not None:
            first[prints[r[1]]] = min(r[0], first.get(prints[r[1]], r[0]))
    ids = sorted(set(first.values()))
    fps = {i: [p for p, f in first.items() if f == i] for i in ids}
    linked = [(a, b) for a, b in itertools.combinations(ids, 2)
              if any((x ^ y).bit_count() <= 2 for x in fps[a] for y in fps[b])]
    kept = sorted(set(components_brute(ids, linked).values()))
    assert sorted(r[0] for r in got if r[0] is not None) == kept
    assert len(kept) < len(ids) < len(rows)                 # copies, and links between unlike fingerprints
    assert [r for r in got if r[0] is None] == [r for r in rows if r[0] is None]
    assert not Counter(got) - Counter(rows)


def test_pii_replaces_every_span(spark, steps):
    rows, got = steps["pii"]
    model = pii.train(spark.createDataFrame(rows, SCHEMA))

    def hidden(text):
        spans = sorted(pii.spans(text, model)[1])
        assert set(base_brute(text)) <= set(spans)
        name = [None] * len(text)
        end, no = 0, -1
        for a, k, b in spans:
            if a >= end:
                no += 1
                label = (no, f"[{pii.KINDS[k].upper()}]")
            for i in range(a, b):
                name[i] = label
            end = max(end, b)
        return "".join(c if n is None else "" if i and name[i - 1] == n else n[1] for i, (c, n) in enumerate(zip(text, name)))

    want = [r if r[1] is None else (r[0], hidden(r[1]), r[2], r[3], len(hidden(r[1]))) for r in rows]
    assert Counter(got) == Counter(want) and any(a != b for a, b in zip(sorted(map(str, rows)), sorted(map(str, want))))


def test_mixing_takes_the_copies_of_a_plain_walk(steps):
    rows, got = steps["mixing"]
    sized = [(r, len([w for w in (r[1] or "").replace("\x0b", " ").replace("\x0c", " ").replace("\t", " ").replace("\n", " ")
                      .replace("\r", " ").split(" ") if w])) for r in rows]
    sources = sorted({r[3] for r in rows}, key=lambda s: (s is None, s or ""))
    size = {s: sum(n for r, n in sized if r[3] == s) for s in sources}
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sources)}
    goal, rest, open_ = {}, 1.5 * sum(size.values()), set(sources)
    while open_:                                            # sources above their cap stop there, the excess is shared again
        level = rest / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > 2 * size[s]}
        for s in full or open_:
            goal[s] = 2 * size[s] if full else level * weight[s]
        rest -= sum(goal[s] for s in full)
        open_ = open_ - full if full else set()
    want = Counter()
    for s in sources:
        rate = goal[s] / size[s] if size[s] else 0.0
        shift = int(hashlib.md5(("mix-" if s is None else f"mix:{s}").encode()).hexdigest()[:5], 16) / 1048576
        drop = lambda n: max(n.bit_length() - 4, 0)
        own = sorted((x for x in sized if x[0][3] == s), key=lambda x: (
            drop(x[1]) * 16 + (x[1] >> drop(x[1])), hashlib.md5(str("" if x[0][0] is None else x[0][0]).encode()).hexdigest()))
        for i, (r, _) in enumerate(own):
            want[r] += min(2, math.floor((i + 1) * rate + shift) - math.floor(i * rate + shift))
    assert Counter(got) == +want


def test_packing_holds_every_id_once(steps):
    rows, got = steps["packing"]
    ids = Counter()
    for r in rows:
        ids[(r[0], packing.token_ids(r[1] or "", queries.tokenizer_path(), queries.added_tokens()).astype("<u4").tobytes())] += 1
    want, items = Counter(), []
    for (doc, raw), n in ids.items():
        length = len(raw) // 4
        lead = length % 2048 if length > 2048 else length
        cuts = ([(0, lead)] if lead else []) + [(a, 2048) for a in range(lead, length, 2048) if length > 2048]
        for p, (a, size) in enumerate(cuts):
            want[(doc, p, a, size, zlib.crc32(raw[4 * a:4 * (a + size)]))] += n
            items += [size] * n
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in bins.values():
        held.sort()
        assert [a for a, _ in held] == list(np.cumsum([0, *(n for _, n in held)])[:-1]) and sum(n for _, n in held) <= 2048
    room = []
    for n in sorted(items, reverse=True):                   # best fit, largest first
        fits = [i for i, free in enumerate(room) if free >= n]
        if fits:
            room[min(fits, key=lambda i: room[i])] -= n
        else:
            room.append(2048 - n)
    assert -(-sum(items) // 2048) <= len(bins) <= len(room)
