"""Personal data: candidate generators, boosted trees, calibrated thresholds (operator 1).

Generators of high recall propose overlapping spans of four kinds (email, ip, card, phone).  The base
patterns below are always redacted.  For the rest, boosted trees read the format of a candidate and
its context; a candidate is redacted if its calibrated score reaches the kind's threshold and it
does not overlap a base span.  Among overlapping accepted candidates the best score wins.

Training needs no outside labels: in a bounded hashed sample of documents the base spans are
positives, and so are rewrites of them in place ("a at b dot org", "(555) 010-9999" without the
plus, other separators); other candidates of the sample, and rewrites that break a kind's own
check (digits that fail Luhn, parts above 255), are negatives.

Nulls and empty texts have no span.  A text of any length is read whole; every pattern is anchored
at a rare character and runs in linear time.  Repeated rows are judged each for itself.
"""

from __future__ import annotations

import bisect
import hashlib
import random
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from longtab.llm import boosting
from longtab.llm.common import hashed_texts, map_batches, texts_of

KINDS = ("email", "ip", "card", "phone")
# Bounds of the training sample: documents, and characters of a document that may be in it.
SAMPLE_DOCS = 3000
SAMPLE_CHARS = 20_000
PRECISION = 0.99

# Base patterns: fixed values.
LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_LOCAL = re.compile(r"[^A-Za-z0-9._%+-]")
DIGIT = re.compile(r"[0-9]")

# Generators: wider than the base patterns, each with bounded repeats.
WIDE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]{1,64} ?(?:@|[\[({] ?at ?[\])}]) ?"
                        r"[A-Za-z0-9-]{1,63}(?: ?(?:\.|[\[({] ?dot ?[\])}]) ?[A-Za-z0-9-]{1,63}){1,6}", re.I),
    "ip": re.compile(r"(?<![0-9])[0-9]{1,3}(?:(?:\.|\[\.\]|\(\.\))[0-9]{1,3}){3}(?![0-9])"),
    "card": re.compile(r"(?<![0-9])[0-9](?:[ ._/-]{0,2}[0-9]){11,18}(?![0-9])"),
    "phone": re.compile(r"(?<![0-9A-Za-z])(?:\+|00)?\(?[0-9](?:[ ()./-]{0,2}[0-9]){7,14}(?![0-9])"),
}
HINTS = {
    "email": re.compile(r"e-?mail|contact|write|\bto\b|from", re.I),
    "ip": re.compile(r"\bip\b|host|server|addr", re.I),
    "card": re.compile(r"card|visa|credit|pay|iban", re.I),
    "phone": re.compile(r"phone|tel|call|mobile|fax", re.I),
}
N_FEATURES = 20


def luhn(digits: str) -> bool:
    total = 0
    for i, ch in enumerate(reversed(digits)):
        d = ord(ch) - 48
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(DIGIT.findall(s))


def _part_fits(p: str) -> bool:
    p = p.lstrip("0")
    return len(p) < 3 or len(p) == 3 and int(p) <= 255


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind index, end) of every base match, sorted; leftmost and non-overlapping per kind."""
    out, last = [], 0
    at = text.find("@")
    while at >= 0:
        a = at
        while a > last and LOCAL.match(text[a - 1]):
            a -= 1
        if a < at and (m := DOMAIN.match(text, at + 1)):
            out.append((a, 0, m.end()))
            last = m.end()
            at = text.find("@", last)
        else:
            last = at + 1  # nothing left of this sign can belong to a later address
            at = text.find("@", last)
    if DIGIT.search(text):
        out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(map(_part_fits, m[0].split(".")))]
        out += [(m.start(), 2, m.end()) for m in CARD.finditer(text)
                if m.end() - m.start() >= 12 and 12 <= len(d := _digits(m[0])) <= 19 and luhn(d)]
        out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return sorted(out)


def candidates(text: str) -> list[tuple[int, int, int]]:
    """Overlapping proposals of all generators, and of the base patterns."""
    out = set(base_spans(text))
    if "@" in text or re.search(r"[\[({] ?at ?[\])}]", text, re.I):
        for m in re.finditer(r"@|[\[({] ?at ?[\])}]", text, re.I):
            a = max(0, m.start() - 66)
            for n in WIDE["email"].finditer(text, a, min(len(text), m.end() + 512)):
                if n.start() < m.start() < n.end():
                    out.add((n.start(), 0, n.end()))
                    break
    if DIGIT.search(text):
        for k, kind in enumerate(KINDS[1:], 1):
            out.update((m.start(), k, m.end()) for m in WIDE[kind].finditer(text))
    return sorted(out)


def features(text: str, a: int, k: int, b: int) -> list[float]:
    """Format of the span, then its context."""
    s = text[a:b]
    d = _digits(s)
    left, right = text[max(0, a - 24):a], text[b:b + 12]
    groups = re.findall(r"[0-9]+", s)
    seps = set(re.findall(r"[^A-Za-z0-9]", s))
    return [
        len(s), len(d), len(d) / max(1, len(s)), len(groups), max(map(len, groups), default=0),
        min(map(len, groups), default=0), len(seps), float(s[0] == "+"), float("(" in s), float("@" in s),
        float(luhn(d)) if len(d) >= 12 else -1.0, max([int(g[-4:]) for g in groups], default=-1), s.count("."),
        float(s[-1:].isalpha()), float(bool(HINTS[KINDS[k]].search(left))), float(left[-1:].isalnum()),
        float(left[-1:] in "\"'=_/-"), float(right[:1].isalnum()), float(right[:1] in "\"'_/-%"),
        float(len(d) > 1 and len(set(d)) == 1),
    ]


def _rewrites(kind: int, s: str, rng: random.Random) -> list[tuple[str, int]]:
    """Forms of a base span in place: (text, label)."""
    d = _digits(s)
    if kind == 0:
        user, host = s.split("@", 1)
        return [(f"{user} (at) {host.replace('.', ' (dot) ')}", 1), (f"{user}[at]{host}", 1),
                (f"{user} @ {host}", 1), (f"{user} (at) {rng.randint(1, 23)}.{rng.randint(10, 59)}", 0),
                (f"{user} [at] noon. Then", 0), (f"{user} (at) {rng.randint(1, 9)}.{rng.randint(0, 9)} km", 0)]
    if kind == 1:
        p = s.split(".")
        return [("[.]".join(p), 1), (".".join([*p[:3], str(rng.randint(256, 999))]), 0)]
    if kind == 2:
        wrong = d[:-1] + str((int(d[-1]) + rng.randint(1, 9)) % 10)
        return [(".".join(d[i:i + 4] for i in range(0, len(d), 4)), 1), (wrong, 0),
                (" ".join(wrong[i:i + 4] for i in range(0, len(d), 4)), 0), ("".join(rng.choices("0123456789", k=14)), 0)]
    local = d[-10:]
    return [(f"({local[:3]}) {local[3:6]}-{local[6:]}", 1), (f"{local[:3]}-{local[3:6]}-{local[6:]}", 1),
            (f"00{d[:-7]} {d[-7:-4]} {d[-4:]}", 1), ("".join(rng.choices("123456789", k=11)), 0),
            (f"{rng.randint(1000, 9999)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}", 0)]


def training_rows(texts: list[str], seed: int = 7) -> list[tuple[int, int, list[float]]]:
    """(kind, label, features) of the sampled documents' candidates and of the rewrites."""
    rows, rng = [], random.Random(seed)
    for t in texts:
        base = base_spans(t)
        spans = set(base)
        for c in candidates(t):
            if c in spans:
                rows.append((c[1], 1, features(t, c[0], c[1], c[2])))
            elif not any(a < c[2] and c[0] < b for a, _, b in base):
                rows.append((c[1], 0, features(t, c[0], c[1], c[2])))
        for a, k, b in base:
            for form, label in _rewrites(k, t[a:b], rng):
                changed = t[max(0, a - 40):a] + form + t[b:b + 40]
                at = min(a, 40)
                best = max(((min(e, at + len(form)) - max(s, at), s, e) for s, kk, e in candidates(changed)
                            if kk == k), default=(0, 0, 0))
                if best[0] > 0:
                    rows.append((k, label, features(changed, best[1], k, best[2])))
    return rows


@dataclass
class Model:
    trees: list   # per kind: (Boosted, (a, b), threshold)

    def score(self, kind: int, x: np.ndarray) -> np.ndarray:
        boosted, (a, b), _ = self.trees[kind]
        return boosting._sigmoid(a * boosted.margin(x) + b)


def train(docs: DataFrame, text_col: str = "text", sample_docs: int = SAMPLE_DOCS,
          precision: float = PRECISION) -> Model:
    """Fit on a bounded sample (``sample_docs`` rows of at most SAMPLE_CHARS characters)."""
    short = docs.select(F.col(f"`{text_col}`").alias("t")).where(
        F.col("t").isNotNull() & (F.length("t") <= SAMPLE_CHARS) & F.col("t").rlike("[0-9@]"))
    texts = [r.text for r in hashed_texts(short, "t", sample_docs, "pii").collect()]
    rows = training_rows(texts)
    out = []
    for k in range(len(KINDS)):
        own = [r for r in rows if r[0] == k]
        y = np.array([r[1] for r in own], dtype=float)
        x = np.array([r[2] for r in own], dtype=float).reshape(len(own), N_FEATURES)
        held = np.arange(len(own)) % 3 == 0
        boosted = boosting.fit(x[~held], y[~held])
        margin = boosted.margin(x[held])
        a, b = boosting.calibrate(margin, y[held]) if held.any() else (1.0, 0.0)
        prob = boosting._sigmoid(a * margin + b)
        out.append((boosted, (a, b), max(0.5, boosting.threshold_for(prob, y[held], precision))))
    return Model(out)


def spans(text: str, model: Model) -> tuple[list, list]:
    """(base spans, all spans), each sorted (start, kind index, end)."""
    base = base_spans(text)
    taken = sorted((a, b) for a, _, b in base)
    chosen: list[tuple[int, int, int]] = []
    longest = max((b - a for a, b in taken), default=0)

    def free(held: list, a: int, b: int) -> bool:
        i = bisect.bisect_left(held, (a - longest, 0))
        while i < len(held) and held[i][0] < b:
            if held[i][1] > a:
                return False
            i += 1
        return True

    rest = [c for c in candidates(text) if free(taken, c[0], c[2])]
    if rest:
        scored = []
        for k in range(len(KINDS)):
            own = [c for c in rest if c[1] == k]
            if own:
                p = model.score(k, np.array([features(text, *c) for c in own]))
                scored += [(-s, c) for s, c in zip(p, own, strict=True) if s >= model.trees[k][2]]
        longest = max([longest, *(c[2] - c[0] for _, c in scored)])
        for _, c in sorted(scored):
            if free(taken, c[0], c[2]):
                chosen.append(c)
                bisect.insort(taken, (c[0], c[2]))
    return base, sorted(base + chosen)


def digest(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in found)


def find(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: doc_id, counts of base spans by kind, base_sha256, spans."""
    def run(batch):
        cols = {n: [] for n in ("n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")}
        for t in texts_of(batch):
            base, both = spans(t, model)
            for j, kind in enumerate(KINDS):
                cols[f"n_{kind}"].append(sum(k == j for _, k, _ in base))
            cols["base_sha256"].append(hashlib.sha256(digest(base).encode()).hexdigest())
            cols["spans"].append(digest(both))
        return {"doc_id": batch.column("doc_id")} | cols
    return map_batches(
        docs.select("doc_id", "text"), run,
        "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def redact(text: str, found: list[tuple[int, int, int]]) -> str:
    """Every span replaced by its kind in brackets; spans that overlap become one, named after the first."""
    out, at = [], 0
    for a, k, b in found:
        if a >= at:
            out += [text[at:a], f"[{KINDS[k].upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redacted(docs: DataFrame, model: Model) -> DataFrame:
    """The same columns with spans of ``text`` replaced and ``n_chars`` set to the new length; null stays null."""
    def run(batch):
        cols = dict(zip(batch.schema.names, batch.columns, strict=True))
        old = batch.column("text").to_pylist()
        new = [None if t is None else redact(t, spans(t, model)[1]) for t in old]
        cols["text"] = pa.array(new, batch.schema.field("text").type)
        if "n_chars" in cols:
            cols["n_chars"] = pa.array([n if t is None else len(t) for n, t in
                                        zip(cols["n_chars"].to_pylist(), new, strict=True)], pa.int64())
        return cols
    return map_batches(docs, run, docs.schema)
