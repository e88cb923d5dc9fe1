"""Operators 11 to 13 against brute-force versions and on the awkward cases."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pyarrow.fs as pafs
import pytest
from pyspark.sql import functions as F

from longtab.llm import dialogue as D
from longtab.llm import fim, queries, token_files, wordids

DOCS = "doc_id long, text string, output string, part string, n long"
LONG = "wörd, Word. " * 30_000 + "end"
ODD = [(1, None), (2, ""), (3, LONG), (4, "same text here"), (4, "same text here"), (5, "a <S> b"), (None, "no id é"), (6, "   \t\n "),
       (7, "x"), (8, "don't <|endoftext|> ABC é é \U0001f600!!..."), (4, "other text")]


@pytest.fixture
def odd(spark):
    return spark.createDataFrame([(*r, "o", "p", 0) for r in ODD], DOCS)


@pytest.fixture
def none(spark):
    return spark.createDataFrame([], DOCS)


def text_of(rng, n, letters="ab é́\U0001f600\n<PSM>.,"):
    return "".join(rng.choice(letters) for _ in range(n))


# --- 11 ------------------------------------------------------------------------------------------
def test_cuts_equal_a_plain_scan():
    rng = random.Random(3)
    for _ in range(400):
        t = text_of(rng, rng.randrange(0, 90))
        for pattern in (None, r"\S+\s*", "a+"):
            b = fim.Blocks(t.encode(), pattern, block=rng.choice((1, 3, 8, 64)))
            ends = [m.end() for m in re.finditer(pattern or ".", t, re.S) if m.end() > m.start()]
            assert b.units == len(ends) and b.points == len(t)
            for k in range(b.units + 1):
                at = ends[k - 1] if k else 0
                assert b.cut(k) == (len(t[:at].encode()), at), (t, pattern, k)


def test_fim_rows(odd, none):
    rows = fim.rearranged(odd).withColumn("back", fim.restored()).collect()
    assert len(rows) == len(ODD)
    for r, (i, t) in zip(sorted(rows, key=lambda r: (r.doc_id or 0, r.back)), sorted(ODD, key=lambda x: (x[0] or 0, x[1] or "")), strict=True):
        t = t or ""
        assert r.back == t and r.n == len(t)
        if r.form == "plain":
            assert r.output == t and r.prefix_chars is None
        else:
            p, m = r.prefix_chars, r.middle_chars
            pre, mid, suf = t[:p], t[p:p + m], t[p + m:]
            assert r.output == (f"<P>{pre}<S>{suf}<M>{mid}" if r.form == "psm" else f"<S>{suf}<P>{pre}<M>{mid}")
    got = {r.doc_id: r for r in fim.digests(odd).collect()}
    assert got[5].form == got[1].form == "plain" and got[1].output_sha256 == hashlib.sha256(b"").hexdigest()
    assert all(r.restored_sha256 for r in got.values())
    words = fim.rearranged(odd, r"\S+\s*").withColumn("back", fim.restored()).collect()
    assert sorted(r.back for r in words) == sorted((t or "") for _, t in ODD)
    assert fim.digests(none).count() == 0


# --- 12 ------------------------------------------------------------------------------------------
def brute(rows):
    """Cheapest and then ASCII-least letters by trying every way to each row and state."""
    ways = {0: (0, "")}

    def better(to, s, way):
        if s not in to or way < to[s]:
            to[s] = way
    for x in rows:
        role, fault = divmod(D.LETTERS.index(x), 3)
        wide, nxt = dict(ways), {}
        for _ in range(2):
            for s, (c, a) in list(wide.items()):
                better(wide, D.NEXT[s], (c + 5, a + "I"))
        for s, (c, a) in wide.items():
            better(nxt, s, (c + 2, a + "D"))
            if fault != D.GONE:
                extra = 5 if fault == D.CUT else 0
                better(nxt, D.NEXT[s], (c + 1 + extra, a + "R"))
                fits = {0: (1 if s == 0 else -1), 1: (2 if s != 2 else -1), 2: (3 if s == 2 else -1), 3: -1}[role]
                if fits >= 0:
                    better(nxt, fits, (c + extra, a + "K"))
        ways = nxt
    return min((c + (0, 10, 5, 0)[s], a + ("", "II", "I", "")[s]) for s, (c, a) in ways.items())


def test_search_equals_brute_force():
    for n in range(4):
        for rows in itertools.product("adegjkl" if n == 3 else D.LETTERS, repeat=n):
            rows = "".join(rows)
            assert D.repair(rows) == brute(rows), rows
    rng = random.Random(5)
    for _ in range(400):
        rows = "".join(rng.choices(D.LETTERS, k=rng.randrange(4, 40)))
        assert D.repair(rows) == brute(rows), rows
    rows = "".join(rng.choices(D.LETTERS, k=2000))
    assert D.repair(rows) == brute(rows)
    for block in (1, 2, 5):
        rows = "".join(rng.choices(D.LETTERS, k=30))
        cost, letters, end = D.solve(rows, block=block)[0]
        assert (cost, letters + D.ENDING[end]) == brute(rows)


def reference(rows):
    """The whole contract for one list of (conv_id, turn, role, text)."""
    out = {}
    for conv in {r[0] for r in rows}:
        seen = []
        for c, turn, role, text in (r for r in rows if r[0] == conv):
            role, text = " " if role is None else role, " " if text is None else text
            k = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
            if k:
                seen += [(turn, "user" if k == 4 else role, "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text)] * (2 if k == 3 else 1)
        seen.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
        symbols, faults, before = "", [], set()
        for _, role, text in seen:
            t = text.rstrip(" \t\n\x0b\x0c\r")
            f = "blank" if not t else "duplicate" if (role, text) in before else "truncated" if t[-1] not in ".!?" else ""
            before.add((role, text))
            faults.append(f)
            symbols += D.LETTERS[{"s": 0, "u": 1, "a": 2}.get(role[:1], 3) * 3 + {"": 0, "truncated": 1}.get(f, 2)]
        cost, audit = brute(symbols)
        made, i, state = [], 0, 0
        for a in audit:
            if a in "IR":
                state = D.NEXT[state]
                made.append(D.ROLES[state] + ":" + (seen[i][2] if a == "R" else ""))
            elif a == "K":
                state = {"s": 1, "u": 2, "a": 3}[seen[i][1][:1]]
                made.append(seen[i][1] + ":" + seen[i][2])
            i += a != "I"
        turns = {r[0] for r in seen} - {None}
        ini = [r[1][:1] for r in seen]
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *[faults.count(k) for k in ("blank", "duplicate", "truncated")],
                     sum(a + b not in ("su", "ua", "au") for a, b in zip(ini, ini[1:])), cost, audit,
                     hashlib.sha256("\n".join(made).encode()).hexdigest())
    return out


def conversations(rng, hot):
    texts = ["Well.", "Yes!", "no end", "", "  \t", None, "Really?", "Ä ö.", "x" * 3000 + "."]
    rows = [(rng.choice((1, 2, 3, 4, None)), rng.choice((0, 1, 2, 3, 5, 9, None)), rng.choice(("system", "user", "assistant", "tool", "", None)),
             rng.choice(texts)) for _ in range(60)]
    return rows + [(7, t, "user" if t % 2 == 0 else "assistant", f"turn {t}.") for t in range(hot)] + [(8, 1, "user", "Hello.")] * 40


@pytest.mark.parametrize("bits", [D.SEGMENT_BITS, 3])
def test_repair_equals_the_contract(spark, bits):
    rows = conversations(random.Random(9), 300)
    schema = "conv_id long, turn long, role string, text string, at long, audit string, digest string"
    df = spark.createDataFrame([(*r, 0, "x", "y") for r in rows], schema).repartition(5)
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    got = {r.conv_id: tuple(r[n] for n in names) for r in D.report(df, bits).collect()}
    want = reference(rows)
    assert got.keys() == want.keys()
    for c in want:
        assert got[c] == want[c], c


def test_repaired_rows_and_no_rows(spark):
    rows = [(1, t, r, x) for t, (r, x) in enumerate([("user", "Hi."), ("assistant", "Yes."), ("user", "And?"), ("user", "More"), ("assistant", "End.")])]
    schema = "conv_id long, turn long, role string, text string"
    df = spark.createDataFrame([(*r, 0) for r in rows], schema + ", copy int")
    made = D.repaired(df, D.audit(df)).orderBy("position").collect()
    assert [(r.role, r.text) for r in made] == [("user", "Hi."), ("assistant", "Yes."), ("user", "And?"), ("assistant", "End.")]
    assert D.report(spark.createDataFrame([], schema)).count() == 0
    gone = next(t for t in range(1000) if zlib.crc32(f"3:{t}".encode()) % 20 == 0)
    r = D.report(spark.createDataFrame([(3, gone, "user", "x")], schema)).first()
    assert (r.conv_id, r.cost, r.audit, r.repaired_sha256) == (3, 0, "", hashlib.sha256(b"").hexdigest())


# --- 13 ------------------------------------------------------------------------------------------
@pytest.fixture(scope="module")
def path():
    return queries.tokenizer_path(queries.WORD_TOKENIZER)


def test_run_ids_equal_whole_texts(path):
    from tokenizers import Tokenizer
    whole = Tokenizer.from_file(path)
    rng = random.Random(11)
    e = wordids.Encoder(path, runs=300, cores=200)
    pool = "aAbBzZéÉÄß.,;'’!?-_ \t\n\r\x0b  ́̇가İıΣς0١²Ⅷ中\U0001f600<|>\x00s"
    texts = ["".join(rng.choice(pool) for _ in range(rng.randrange(0, 50))) for _ in range(3000)]
    texts += ["it's John's, don't. IT'S. we're.x .. ,,, a.b a,b. e.g. <|endoftext|>. x<|ENDOFTEXT|>, <|startoftext|>", "ΑΣ. ΑΣ ΑΣ,", " a "]
    texts += [t or "" for _, t in ODD]
    texts += [r.text for r in __import__("pyarrow.parquet").parquet.read_table("/root/testdata/sf0.001/documents.parquet", columns=["text"])
              .to_pandas().itertuples()]
    for a in range(0, len(texts), 100):
        for t, raw in zip(texts[a:a + 100], e.encode(texts[a:a + 100]), strict=True):
            assert np.frombuffer(raw, "<u4").tolist() == whole.encode(t, add_special_tokens=False).ids, repr(t)


def test_signs_and_numbers_cost_no_word_its_place(path):
    from tokenizers import Tokenizer
    whole = Tokenizer.from_file(path)
    e = wordids.Encoder(path, runs=50, cores=4)
    given, plain = [], e._plain
    e._plain = lambda text: given.append(text) or plain(text)
    texts = ["Word word, (word) word*** wörd-word/Word", "", " word&&& ", "[wörd]_word?!"]
    got = e.encode(texts)
    assert sum(g.lower().count("word") for g in given) == 1 and e.cores.keys() == {"word", "wörd"}
    want = [whole.encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(raw, "<u4").tolist() for raw in got] == want
    ids, ends = e.stretch(texts)
    assert ids.tolist() == sum(want, []) and ends.tolist() == np.cumsum(list(map(len, want))).tolist()
    for a in range(0, 200, 40):
        e.encode([" ".join(map(str, range(1000 + a, 1040 + a)))])
        assert len(e.runs) <= 50 and e.cores.keys() == {"word", "wörd"}
    e.encode(["one two three four five six"])
    assert len(e.cores) <= 4 and e.stretch([])[0].size == 0 and e.stretch(["", " "])[1].tolist() == [0, 0]


def test_cuts_at_signs_equal_whole_texts(path):
    from tokenizers import Tokenizer
    whole = Tokenizer.from_file(path)
    rng = random.Random(17)
    e = wordids.Encoder(path, runs=300, cores=200)
    pool = [*map(chr, range(32, 127)), *"aAhHsStT" * 3, *"éÉ’\t\n\r\x0b\u00a0\u2003\u0338\u0331\u0301\u0307\u0130Σς\U0001f600\ue000", "<|endoftext|>", "<|ENDOFTEXT|>", "'s", "'LL"]
    for _ in range(40):
        texts = ["".join(rng.choice(pool) for _ in range(rng.randrange(0, 40))) for _ in range(100)]
        for t, raw in zip(texts, e.encode(texts), strict=True):
            assert np.frombuffer(raw, "<u4").tolist() == whole.encode(t, add_special_tokens=False).ids, repr(t)


def test_blocks_round_trip(tmp_path):
    rng = np.random.default_rng(1)
    for n in (1, 2, 7, 100, 1024):
        for high in (1, 2, 50_000, 2**32):
            ids = rng.integers(0, high, n, dtype=np.uint64).astype("<u4")
            ids[rng.random(n) < 0.02] = 2**32 - 1
            raw = token_files.pack_blocks(np.stack([ids, ids[::-1], ids // 7]))
            back = token_files.unpack_blocks(b"".join(raw), np.cumsum([0, *map(len, raw[:-1])]).tolist())
            assert (back == np.concatenate([ids, ids[::-1], ids // 7])).all()
    fs, name = pafs.LocalFileSystem(), str(tmp_path / "x.pfor")
    parts = [rng.integers(0, 50_000, n).astype("<u4") for n in (1, 5, 0, 63, 64, 65, 1000, 3, 0)]
    with fs.open_output_stream(name) as out:
        w = token_files.Writer(out, block=64)
        for i, p in enumerate(parts):
            w.add(None if i == 1 else i, p)
        w.close()
    every = np.concatenate(parts)
    with fs.open_input_file(name) as source:
        r = token_files.Reader(source, block=64)
        assert r.checksums() == [zlib.crc32(p.tobytes()) for p in parts] and r.null.tolist() == [i == 1 for i in range(9)]
        for _ in range(50):
            a, b = sorted(rng.integers(0, len(every) + 1, 2).tolist())
            assert (r.ids_between(a, b) == every[a:b]).all()


def test_token_files(spark, odd, none, path):
    from tokenizers import Tokenizer
    whole = Tokenizer.from_file(path)

    def want(rows):
        ids = {k: np.array([*whole.encode(k[1], add_special_tokens=False).ids, 2], "<u4") for k in rows}
        return sorted(((i, len(v), zlib.crc32(v.tobytes())) for (i, _), v in ((k, ids[k]) for k in rows)), key=str)
    rows = [(i, t or "") for i, t in ODD] + [(9, "again and again")] * 50
    df = odd.unionByName(spark.createDataFrame([(*r, "o", "p", 0) for r in rows[len(ODD):]], DOCS)).repartition(3)
    import tempfile
    for file_bytes in (token_files.FILE_BYTES, 200):
        files = token_files.write(df, tempfile.mkdtemp(), path, file_bytes=file_bytes)
        assert (files.count() > 5) == (file_bytes == 200)
        got = token_files.read(files).orderBy("start").collect()
        assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in got), key=str) == want(rows)
        assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got])[:-1].tolist()]
        ids = [r.doc_id for r in got]
        assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    assert token_files.round_trip(none, path).count() == 0
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    assert token_files.round_trip(docs, path).agg(F.max(F.col("start") + F.col("n_tokens")) == F.sum("n_tokens")).first()[0]
