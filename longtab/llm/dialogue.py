"""Conversation structure repair by iterative-deepening A* (operator 12).

A conversation is a sequence of rows whose role initials should read ``(s?(ua)+)?``.  Edits: Keep a row (0), Rerole it to
user or assistant (1), Delete it (2; the only edit of blank and duplicate rows), Insert an empty user or assistant row
(5); a truncated row that is not deleted adds 5.  As only one role fits at each point, the letters D, I, K, R say
everything about a repair.

The search is depth-first in ASCII order of the letters under a cost bound.  The bound starts at a lower bound of the
cost and grows to the smallest estimate that exceeded it; a table keeps, for each place and role state, the largest
budget that has failed there.  The first path that is accepted is the cheapest repair and, of the cheapest, the ASCII-least.

A conversation of any length is searched in blocks of ``BLOCK`` rows from its end: what the rest costs from each of the
four role states is the price of ending a block in that state.  Long conversations, however many of all rows they hold,
are split over tasks in segments of at most ``SEGMENT`` rows: each gives a 4 x 4 table of costs from state to state,
the tables of one conversation (one small row a segment) give what the rest costs behind each segment, then segments
are searched side by side, and their letters are joined.  Equal segments are searched once a task.

Rows are put in order by a range partitioning (turn, nulls first; rows of one turn by role, then by SHA-256 of the
text), so no conversation is sorted in one task; a duplicate is told by the smallest place of its role and text, a
pre-aggregated minimum.  Repaired rows come from a stream sorted by conversation; only a checksum over a whole
conversation, which is sequential by nature, reads one conversation in one task, row by row in bounded memory.

Null role and text are one space (so is a null id or turn in the key that picks the damage), null turns stand first, rows
with a null conv_id are one conversation.  An empty role fits nowhere.  Repeated rows are duplicates.  Other columns don't
matter, whatever they are called.  An empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from longtab.llm.common import clipped
from longtab.session import cut_lineage

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
BLOCK, SEGMENT_BITS = 48, 12
BLANKS = " \t\n\x0b\x0c\r"
OK, CUT, GONE = 0, 1, 2                # a row's fault as the search sees it: none, truncated, must go
START, AFTER_S, AFTER_U, AFTER_A = 0, 1, 2, 3
NEXT = (AFTER_U, AFTER_U, AFTER_A, AFTER_U)   # state behind an inserted or reroled row
NEVER = 1 << 60
FINISH = (0, 2 * INSERT, INSERT, 0)    # what it costs to end in a state
ENDING = ("", "II", "I", "")
LETTERS = "abcdefghijkl"               # role (s, u, a, other) x fault


def _keeps(role: int, state: int) -> int:
    """The state behind a kept row of this role, -1 if it doesn't fit."""
    if role == 0:
        return AFTER_S if state == START else -1
    if role == 1:
        return AFTER_U if state != AFTER_U else -1
    return AFTER_A if role == 2 and state == AFTER_U else -1


def _floor(symbol: str) -> int:
    """Least cost of a row, whatever stands around it."""
    role, fault = divmod(LETTERS.index(symbol), 3)
    return DELETE if fault else REROLE if role == 3 else 0


class _Search:
    """Searches of one block under one price list for its end."""

    def __init__(self, rows: str, ends: tuple) -> None:
        self.rows = [divmod(LETTERS.index(x), 3) for x in rows]
        self.ends = ends
        self.least = [0] * (len(rows) + 1)
        self.least[-1] = min(ends)
        for i in range(len(rows) - 1, -1, -1):
            self.least[i] = self.least[i + 1] + _floor(rows[i])
        self.failed: dict[tuple[int, int], int] = {}

    def deepen(self, state: int) -> tuple[int, str, int]:
        """(cost, letters, end state) of the cheapest and then ASCII-least path; (NEVER, "", -1) if there is none."""
        bound = self.least[0]
        # deleting every row and inserting two reaches any state that can be reached
        most = DELETE * len(self.rows) + 2 * INSERT + TRUNCATED + max((e for e in self.ends if e < NEVER), default=0)
        while bound <= most:
            self.above, self.path = NEVER, []
            end = self._visit(0, state, bound, 0)
            if end >= 0:
                return bound, "".join(self.path), end
            bound = self.above
        return NEVER, "", -1

    def _visit(self, i: int, state: int, left: int, spent: int) -> int:
        """Depth-first with ``left`` to spend; the end state, or -1."""
        if left < self.least[i]:
            self.above = min(self.above, spent + self.least[i])
            return -1
        if i == len(self.rows):
            if self.ends[state] <= left:
                return state
            self.above = min(self.above, spent + self.ends[state])
            return -1
        known = self.failed.get((i, state))
        if known is not None and left <= known[0]:
            self.above = min(self.above, spent + known[1])
            return -1
        outer, self.above = self.above, NEVER
        role, fault = self.rows[i]
        extra = TRUNCATED if fault == CUT else 0
        steps = [("D", DELETE, i + 1, state), ("I", INSERT, i, NEXT[state])]
        if fault != GONE:
            kept = _keeps(role, state)
            if kept >= 0:
                steps.append(("K", KEEP + extra, i + 1, kept))
            steps.append(("R", REROLE + extra, i + 1, NEXT[state]))
        for letter, cost, to, behind in steps:
            self.path.append(letter)
            end = self._visit(to, behind, left - cost, spent + cost)
            if end >= 0:
                return end
            self.path.pop()
        # what would have been enough here, seen from this place on
        self.failed[i, state] = (left, max(left + 1, self.above - spent) if self.above < NEVER else NEVER)
        self.above = min(outer, self.above)
        return -1


@lru_cache(maxsize=100_000)
def _block(rows: str, ends: tuple) -> tuple:
    """For each of the four states: (cost, letters, end state)."""
    search = _Search(rows, ends)
    return tuple(search.deepen(s) for s in range(4))


def _priced(rows: str, ends: tuple) -> tuple:
    """``_block`` with prices brought down to their smallest first, so that equal blocks share an answer."""
    low = min(ends)
    if low >= NEVER:
        return ((NEVER, "", -1),) * 4
    found = _block(rows, tuple(e - low if e < NEVER else NEVER for e in ends))
    return tuple((c + low if c < NEVER else NEVER, p, e) for c, p, e in found)


def solve(rows: str, ends: tuple = FINISH, block: int = BLOCK) -> list[tuple[int, str, int]]:
    """For each of the four states: (cost, letters, end state) of the cheapest and then ASCII-least path through ``rows``."""
    cuts = [rows[i:i + block] for i in range(0, len(rows), block)]
    found = []
    for part in reversed(cuts):
        found.append(_priced(part, ends))
        ends = tuple(f[0] for f in found[-1])
    found.reverse()
    out = []
    for state in range(4):
        letters, at = [], state
        for f in found:
            if at < 0:
                break
            letters.append(f[at][1])
            at = f[at][2]
        out.append((ends[state], "".join(letters), at) if at >= 0 else (NEVER, "", -1))
    return out


def repair(rows: str) -> tuple[int, str]:
    """(cost, letters) of one conversation given as symbols."""
    cost, letters, end = solve(rows)[START]
    return cost, letters + ENDING[end]


def table_of(rows: str) -> list[int]:
    """Costs from state to state through ``rows``, 4 x 4."""
    costs = [solve(rows, tuple(0 if e == end else NEVER for e in range(4))) for end in range(4)]
    return [costs[end][s][0] for s in range(4) for end in range(4)]


def illegal_pairs(rows: str) -> int:
    """Neighbours whose role initials are not su, ua or au."""
    roles = [LETTERS.index(x) // 3 for x in rows]
    return sum((a, b) not in ((0, 1), (1, 2), (2, 1)) for a, b in zip(roles, roles[1:]))


# --- the table -----------------------------------------------------------------------------------
def damaged(conversations: DataFrame) -> DataFrame:
    """``conversations(conv_id, turn, role, text)`` with the contract's faults put in: by crc32 of ``conv_id:turn`` rows are
    dropped, emptied, stripped of ``.!?``, repeated or made the user's.  ``copy`` numbers the copies of a row."""
    rows = clipped(conversations, ["conv_id", "turn", "role", "text"])
    or_space = lambda c: F.coalesce(c, F.lit(" "))
    draw = F.crc32(F.concat(or_space(F.col("conv_id").cast("string")), F.lit(":"), or_space(F.col("turn").cast("string"))).cast("binary")) % 20
    rows = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), or_space(F.col("role")).alias("role"),
                       or_space(F.col("text")).alias("text"), draw.alias("draw")).where("draw <> 0")
    text = F.when(F.col("draw") == 1, "").when(F.col("draw") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("draw") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("draw") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("copy"))


def _digest(text: str = "text") -> Column:
    return F.unhex(F.sha2(F.col(text).cast("binary"), 256))


def _order() -> list[Column]:
    return [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]


def in_order(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role class, own fault, digest, role, at): ``at`` rises through all rows in order."""
    end = F.rtrim(F.col("text"), F.lit(BLANKS))
    fault = F.when(end == "", GONE).when(F.right(end, F.lit(1)).isin(".", "!", "?"), OK).otherwise(CUT)
    first = F.left(F.col("role"), F.lit(1))
    role_class = F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)
    narrow = rows.select("conv_id", "turn", "role", _digest().alias("digest"), role_class.cast("byte").alias("class"),
                         fault.cast("byte").alias("fault"), F.monotonically_increasing_id().alias("no"))
    key = [*_order(), F.col("no")]
    dealt = narrow.repartitionByRange(*key).sortWithinPartitions(*key)
    return cut_lineage(dealt.select("conv_id", "turn", "role", "digest", "class", "fault", F.monotonically_increasing_id().alias("at")), "turns")


def segments(rows: DataFrame, bits: int = SEGMENT_BITS) -> DataFrame:
    """``in_order`` rows -> (conv_id, seg, symbols, blank, duplicate, truncated): at most 2 ** ``bits`` rows each."""
    firsts = rows.groupBy("conv_id", "role", "digest").agg(F.min("at").alias("first_at")).select("first_at")
    told = rows.select("conv_id", "at", "class", "fault").join(firsts, F.col("at") == F.col("first_at"), "left")
    again = F.col("first_at").isNull() & (F.col("fault") != GONE)
    kind = F.when(again, GONE).otherwise(F.col("fault"))
    symbol = F.substring(F.lit(LETTERS), F.col("class") * 3 + kind + 1, F.lit(1))
    count = lambda c: F.count_if(c)
    return cut_lineage(told.groupBy("conv_id", F.shiftright("at", bits).alias("seg")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", symbol.alias("s")))), lambda x: x["s"]), "").alias("symbols"),
        count(F.col("fault") == GONE).alias("blank"), count(again).alias("duplicate"),
        count((F.col("fault") == CUT) & ~again).alias("truncated")), "segments")


def _behind(tables: list[list[int]]) -> list[tuple]:
    """What the rest costs behind each segment, from each state, given the segments' tables in order."""
    ends, out = FINISH, []
    for t in reversed(tables):
        out.append(ends)
        ends = tuple(min(min(t[4 * s + e] + ends[e], NEVER) for e in range(4)) for s in range(4))
    return out[::-1]


def _mapped(df: DataFrame, run, schema: str, names: list[str]) -> DataFrame:
    """``mapInArrow`` with Python rows: run(row as dict) yields tuples."""
    types = [(n, {"long": pa.int64(), "string": pa.string(), "array<long>": pa.list_(pa.int64()),
                  "array<string>": pa.list_(pa.string())}[t]) for n, t in (f.strip().split(" ", 1) for f in schema.split(","))]

    def work(batches):
        for b in batches:
            out = [x for r in b.to_pylist() for x in run(r)]
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, (_, t) in enumerate(types)], names=[n for n, _ in types])
    return df.select(*names).mapInArrow(work, schema)


def repairs(segs: DataFrame) -> DataFrame:
    """(conv_id, cost, audit, illegal) of every conversation with rows."""
    numbered = segs.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    same = lambda a, b: F.col(a).eqNullSafe(F.col(b))
    one = segs.join(numbered.where("n = 1").select(F.col("conv_id").alias("c")), same("conv_id", "c"), "left_semi")
    whole = _mapped(one, lambda r: [(r["conv_id"], *repair(r["symbols"]), illegal_pairs(r["symbols"]))],
                    "conv_id long, cost long, audit string, illegal long", ["conv_id", "symbols"])
    many = segs.join(numbered.where("n > 1").select(F.col("conv_id").alias("c")), same("conv_id", "c"), "left_semi")
    tables = cut_lineage(_mapped(many, lambda r: [(r["conv_id"], r["seg"], r["symbols"][0] + r["symbols"][-1], table_of(r["symbols"]))],
                                 "conv_id long, seg long, edges string, costs array<long>", ["conv_id", "seg", "symbols"]), "segment-costs")

    def behind(r):
        rows = sorted((x["seg"], x["costs"]) for x in r["parts"])
        for (seg, _), ends in zip(rows, _behind([t for _, t in rows]), strict=True):
            yield r["conv_id"], seg, list(ends)
    grouped = tables.groupBy("conv_id").agg(F.collect_list(F.struct("seg", "costs")).alias("parts"))
    ends = _mapped(grouped, behind, "conv_id long, seg long, ends array<long>", ["conv_id", "parts"]).select(
        F.col("seg").alias("end_seg"), F.col("conv_id").alias("end_conv"), "ends")

    def search(r):
        found = solve(r["symbols"], tuple(r["ends"]))
        yield (r["conv_id"], r["seg"], [f[0] for f in found], [f[1] for f in found], [f[2] for f in found],
               illegal_pairs(r["symbols"]), r["symbols"][0] + r["symbols"][-1])
    searched = cut_lineage(_mapped(
        many.join(ends, (F.col("seg") == F.col("end_seg")) & same("conv_id", "end_conv")), search,
        "conv_id long, seg long, costs array<long>, letters array<string>, states array<long>, illegal long, edges string",
        ["conv_id", "seg", "symbols", "ends"]), "segment-paths")

    def join(r):
        rows, state, letters, illegal = sorted(r["parts"], key=lambda x: x["seg"]), START, [], 0
        for k, x in enumerate(rows):
            letters.append(x["letters"][state])
            illegal += x["illegal"] + (illegal_pairs(rows[k - 1]["edges"][1] + x["edges"][0]) if k else 0)
            state = x["states"][state]
        yield r["conv_id"], rows[0]["costs"][START], "".join(letters) + ENDING[state], illegal
    joined = _mapped(searched.groupBy("conv_id").agg(F.collect_list(F.struct("seg", "costs", "letters", "states", "illegal", "edges")).alias("parts")),
                     join, "conv_id long, cost long, audit string, illegal long", ["conv_id", "parts"])
    return whole.unionByName(joined)


ROLES = {AFTER_U: "user", AFTER_A: "assistant"}
_CLASS = {"s": 0, "u": 1, "a": 2}


def _edited(batches):
    """(new conversation?, conv_id, role, text) for a stream of audits and rows sorted by conversation; role None opens one."""
    at = state = audit = conv = None

    def made():
        nonlocal at, state
        state = NEXT[state]
        at += 1
        return ROLES[state], ""
    for b in batches:
        for conv_id, letters, role, text in zip(*[b.column(c).to_pylist() for c in ("conv_id", "audit", "role", "text")], strict=True):
            if letters is not None:
                if audit is not None:
                    while at < len(audit):
                        yield (conv, *made())
                at, state, audit, conv = 0, START, letters, conv_id
                yield conv, None, None
                continue
            while audit[at] == "I":
                yield (conv, *made())
            if audit[at] == "K":
                state = _keeps(_CLASS.get(role[:1], 3), state)
                yield conv, role, text
            elif audit[at] == "R":
                state = NEXT[state]
                yield conv, ROLES[state], text
            at += 1
    if audit is not None:
        while at < len(audit):
            yield (conv, *made())


def _stream(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """A conversation's audit, then its rows in order, each conversation whole in one partition."""
    head = audits.select("conv_id", F.lit(None).cast("long").alias("turn"), F.lit(None).cast("string").alias("role"),
                         F.lit(None).cast("string").alias("text"), F.lit(None).cast("binary").alias("digest"), "audit", F.lit(0).alias("kind"))
    body = rows.select("conv_id", "turn", "role", "text", _digest().alias("digest"), F.lit(None).cast("string").alias("audit"), F.lit(1).alias("kind"))
    both = head.unionByName(body).repartition("conv_id")
    conv, *rest = _order()
    return both.sortWithinPartitions(conv, "kind", *rest).select("conv_id", "audit", "role", "text")


def repaired(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """The repaired rows: (conv_id, position, role, text), positions from 1."""
    def run(batches):
        held, n, size = [], 0, 0
        for conv, role, text in _edited(batches):
            if role is None:
                n = 0
                continue
            n += 1
            held.append((conv, n, role, text))
            size += len(text)
            if len(held) >= 1000 or size > 1_000_000:
                yield _rows(held)
                held, size = [], 0
        if held:
            yield _rows(held)
    return _stream(rows, audits).mapInArrow(run, "conv_id long, position long, role string, text string")


def _rows(held: list) -> pa.RecordBatch:
    types = (pa.int64(), pa.int64(), pa.string(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array([x[i] for x in held], t) for i, t in enumerate(types)], names=["conv_id", "position", "role", "text"])


def checksums(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256): SHA-256 of the repaired ``role:text``, newline-joined."""
    def run(batches):
        out, sha, conv, open_ = [], None, None, False

        def batch():
            return pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.string())],
                                              names=["conv_id", "repaired_sha256"])
        for conv_id, role, text in _edited(batches):
            if role is None:
                if sha is not None:
                    out.append((conv, sha.hexdigest()))
                    if len(out) >= 10_000:
                        yield batch()
                        out = []
                sha, conv, open_ = hashlib.sha256(), conv_id, False
                continue
            sha.update(f"{chr(10) if open_ else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
            open_ = True
        if sha is not None:
            out.append((conv, sha.hexdigest()))
            yield batch()
    return _stream(rows, audits).mapInArrow(run, "conv_id long, repaired_sha256 string")


def audit(rows: DataFrame, bits: int = SEGMENT_BITS) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) of every conversation with rows."""
    order = in_order(rows)
    segs = segments(order, bits)
    turns = order.groupBy("conv_id").agg((F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).alias("gaps"))
    counts = segs.groupBy("conv_id").agg(*[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")])
    keyed = lambda df, name: df.withColumnRenamed("conv_id", name)
    return cut_lineage(
        keyed(repairs(segs), "r").join(keyed(counts, "c"), F.col("r").eqNullSafe(F.col("c"))).join(keyed(turns, "t"), F.col("r").eqNullSafe(F.col("t")))
        .select(F.col("r").alias("conv_id"), F.coalesce("gaps", F.lit(0)).cast("long").alias("gaps"), "blank", "duplicate", "truncated", "illegal",
                "cost", "audit"), "audits")


def report(conversations: DataFrame, bits: int = SEGMENT_BITS) -> DataFrame:
    """Damage, audit and repair of every conv_id of ``conversations``; those without rows left have zeros and nothing to repair."""
    rows = damaged(conversations)
    found = audit(rows, bits)
    sums = checksums(rows, found).select(F.col("conv_id").alias("s"), "repaired_sha256")
    every = conversations.select(F.col("conv_id").cast("long").alias("e")).distinct()
    full = found.join(sums, F.col("conv_id").eqNullSafe(F.col("s"))).withColumn("there", F.lit(True))
    out = every.join(full, F.col("e").eqNullSafe(F.col("conv_id")), "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return out.select(F.col("e").alias("conv_id"), *[zero(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                      F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
