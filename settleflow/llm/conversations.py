"""Repair of conversations at the least cost, by bidirectional Dijkstra over the edit lattice.

A node of the lattice is a number of rows taken and the state of the role order ``(s?(ua)+)?``; an edge is
an edit of a row (Keep 0, Rerole 3, Delete 4; 3 more for a truncated row that stays) or an Insert (3).
A forward and a reverse heap grow towards each other until they meet, all crossings of equal cost are
finished, and of these the one whose edits spell the least audit is taken. With the rows and the state
an audit fixes the repaired rows. Equal audits of one stretch never differ in length only, so least
audits of stretches put together are least again.

Rows are sorted over the cluster once and written with their place. The lattice is solved in stretches of
``CHUNK`` rows: a conversation within one stretch from its start to an accepted end, a longer one for all
pairs of states at the stretch's borders; the stretches of a conversation are then joined in order, which
keeps only the part of the audits that is still undecided. So a conversation of any length is solved in many
tasks. One task per conversation reads its rows in order for the digest, a row at a time: a
digest of one text can't be split.

Results: null roles and texts count as one space, as do a null id and turn in the damage rule; rows
without an id are one conversation. Rows of one turn go by role, then text, in byte order; a role that is empty
or begins with none of s, u, a can't be kept. Empty and blank texts are faults (``blank``), repeated rows
are ``duplicate``. Very long texts take part whole. A conversation without rows has zeros, an empty audit
and the digest of an empty text. An empty table gives an empty one. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import os.path
from collections.abc import Iterator
from functools import lru_cache
from itertools import batched

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from settleflow.llm.common import stored

CHUNK = 512  # rows of a stretch of the lattice
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
# states of the role order: nothing yet, after system, after user, after assistant
START, SYSTEM, USER, ASSISTANT = range(4)
STATES, ACCEPTED = (START, SYSTEM, USER, ASSISTANT), (START, ASSISTANT)
NEXT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
MADE = {START: "u", SYSTEM: "u", USER: "a", ASSISTANT: "u"}  # the only role that user or assistant can be made to
FULL = {"u": "user", "a": "assistant"}


def damaged(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, gone``: rows after damage; those that are dropped have ``gone``."""
    def shown(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    hit = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    marked = rows.select("conv_id", "turn", shown("role").alias("role"), shown("text").alias("text"), hit.alias("_hit"))
    text = F.when(F.col("_hit") == 1, "").when(F.col("_hit") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return marked.select(
        "conv_id", "turn", F.when(F.col("_hit") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), (F.col("_hit") == 0).alias("gone"),
        F.explode(F.when(F.col("_hit") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy")).drop("_copy")


def placed(rows: DataFrame) -> DataFrame:
    """Rows in the order of their conversations, stored with ``_row``, which ascends in that order."""
    kept = rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
                       *(["gone"] if "gone" in rows.columns else [F.lit(False).alias("gone")]))
    tied = kept.withColumn("_tie", F.monotonically_increasing_id())  # equal rows may be many
    order = ["conv_id", F.col("gone"), "turn", "role", "text", "_tie"]
    return stored(tied.repartitionByRange(*order).sortWithinPartitions(*order).drop("_tie").withColumn("_row", F.monotonically_increasing_id()), "turns")


def faults(rows: DataFrame) -> DataFrame:
    """``conv_id, _row, code``: the class of the role (s, u, a, x) and the first fault (b, d, t, or o for none)."""
    same = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"))
    end = F.right(F.expr("trim(TRAILING ' \t\n\x0b\x0c\r' FROM text)"), F.lit(1))
    narrow = rows.where("not gone").select(
        "conv_id", "_row", same.alias("_same"), F.when(F.substring("role", 1, 1).isin("s", "u", "a"), F.substring("role", 1, 1)).otherwise("x").alias("_who"), end.alias("_end"))
    first = narrow.groupBy("conv_id", "_same").agg(F.min("_row").alias("_first")).select(F.col("conv_id").alias("_c"), F.col("_same").alias("_s"), "_first")
    joined = narrow.join(first, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("_same") == F.col("_s")))
    fault = F.when(F.col("_end") == "", "b").when(F.col("_row") > F.col("_first"), "d").when(~F.col("_end").isin(".", "!", "?"), "t").otherwise("o")
    return joined.select("conv_id", "_row", F.concat("_who", fault).alias("code"))


def stretches(codes: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """``conv_id, first, code, whole``: codes of up to ``chunk`` rows in a row, and whether that is all of a conversation."""
    gathered = codes.groupBy("conv_id", F.expr(f"_row div {chunk}").alias("_chunk")).agg(
        F.min("_row").alias("first"), F.array_sort(F.collect_list(F.struct("_row", "code"))).alias("_rows"))
    parts = gathered.select("conv_id", "first", F.array_join(F.col("_rows.code"), "").alias("code"))
    long = parts.groupBy("conv_id").count().where("count > 1").select(F.col("conv_id").alias("_c"), F.lit(True).alias("_long"))
    return parts.join(long, F.col("conv_id").eqNullSafe(F.col("_c")), "left").select("conv_id", "first", "code", F.col("_long").isNull().alias("whole"))


def _edits(code: str, i: int, state: int) -> Iterator[tuple[int, str, int, int]]:
    """Edges out of a node: cost, letter, rows taken and state behind it."""
    yield INSERT, "I", i, NEXT[state, MADE[state]]
    if 2 * i == len(code):
        return
    who, fault = code[2 * i], code[2 * i + 1]
    yield DELETE, "D", i + 1, state
    if fault in "bd":
        return
    more = TRUNCATED if fault == "t" else 0
    if (state, who) in NEXT:
        yield KEEP + more, "K", i + 1, NEXT[state, who]
    yield REROLE + more, "R", i + 1, NEXT[state, MADE[state]]


def cheapest(code: str, begin: int = START, ends: tuple[int, ...] = ACCEPTED) -> tuple[int, str] | None:
    """Cost and least audit of the way through a stretch from a state to one of ``ends``; None without a way."""
    n = len(code) // 2
    into: dict[tuple[int, int], list[tuple[int, str, int, int]]] = {}
    for i in range(n + 1):
        for state in STATES:
            for cost, letter, j, then in _edits(code, i, state):
                into.setdefault((j, then), []).append((cost, letter, i, state))
    # a node leaves its heap by cost, then nearness to the side it was reached from: edits without cost take
    # a row, so whatever can better a node's audit at the same cost has left before it
    best = ({(0, begin): (0, "")}, {(n, s): (0, "") for s in ends})
    heaps = ([(0, 0, begin)], [(0, -n, s) for s in ends])
    heapq.heapify(heaps[1])
    settled: tuple[set, set] = (set(), set())
    met = None
    while (heaps[0] or heaps[1]) and (met is None or sum(h[0][0] for h in heaps if h) <= met and all(heaps)):
        side = min((0, 1), key=lambda k: (not heaps[k], heaps[k][0][0] if heaps[k] else 0))
        cost, i, state = heapq.heappop(heaps[side])
        node = abs(i), state
        if node in settled[side]:
            continue
        settled[side].add(node)
        cost, audit = best[side][node]
        other = best[1 - side].get(node)
        if other is not None and (met is None or cost + other[0] < met):
            met = cost + other[0]
        for step, letter, j, then in (into.get(node, ()) if side else _edits(code, *node)):
            label = (cost + step, letter + audit if side else audit + letter)
            if (j, then) not in settled[side] and label < best[side].get((j, then), (label[0] + 1,)):
                best[side][j, then] = label
                heapq.heappush(heaps[side], (label[0], -j if side else j, then))
    if met is None:
        return None
    found = None  # every way of least cost crosses from a node of one side to a node of the other
    for node, (cost, audit) in best[0].items():
        for step, letter, j, then in [(0, "", *node), *_edits(code, *node)]:
            rest = best[1].get((j, then))
            if rest is not None and cost + step + rest[0] == met:
                whole = audit + letter + rest[1]
                found = whole if found is None or whole < found else found
    return met, found


def _solve(stretches: Iterator[tuple]) -> Iterator[tuple]:
    """Per stretch the ways from each state to each (or the only way of a whole conversation) and their costs."""
    remembered = lru_cache(50_000)(cheapest)  # short conversations are much alike
    for conv, first, code, whole in stretches:
        solve = remembered if len(code) < 64 else cheapest
        found = [solve(code)] if whole else [solve(code, a, (b,)) for a in STATES for b in STATES]
        yield conv, first, code, [w and w[1] for w in found], [w and w[0] for w in found]


class _Joined:
    """Audit of one conversation from its stretches in order, handed out a stretch at a time."""

    def __init__(self):
        self.reached = {START: (0, "")}  # cost and undecided audit for each state
        self.open: list[tuple[int, str]] = []  # stretches whose edits are not handed out
        self.decided = ""

    def add(self, first: int, code: str, ways: list, costs: list) -> Iterator[tuple[int, str, str]]:
        self.open.append((first, code))
        if len(ways) == 1:
            self.reached = {START: (costs[0], ways[0])}
            return
        new: dict[int, tuple[int, str]] = {}
        for a, (cost, audit) in self.reached.items():
            for b in STATES:
                way, step = ways[4 * a + b], costs[4 * a + b]
                if way is not None:
                    label = cost + step, audit + way
                    if b not in new or label < new[b]:
                        new[b] = label
        shared = os.path.commonprefix([audit for _, audit in new.values()])
        self.decided += shared
        self.reached = {s: (cost, audit[len(shared):]) for s, (cost, audit) in new.items()}
        while len(self.open) > 1:
            edits = _take(self.decided, len(self.open[0][1]) // 2)
            if edits is None:
                return
            self.decided = self.decided[len(edits):]
            yield *self.open.pop(0), edits

    def end(self) -> Iterator[tuple[int, str, str]]:
        rest = self.decided + min(label for s, label in self.reached.items() if s in ACCEPTED)[1]
        for k, (first, code) in enumerate(self.open):
            edits = rest if k == len(self.open) - 1 else _take(rest, len(code) // 2)
            rest = rest[len(edits):]
            yield first, code, edits


def _take(audit: str, rows: int) -> str | None:
    """The part of an audit up to the edit of the last of so many rows."""
    for k, letter in enumerate(audit):
        rows -= letter != "I"
        if not rows:
            return audit[:k + 1]
    return None


def _join(stretches: Iterator[tuple]) -> Iterator[tuple]:
    """``conv_id, first, code, edits`` from sorted stretches with their ways."""
    now, joined = None, None
    for conv, first, code, ways, costs in stretches:
        if joined is None or conv != now:
            if joined:
                yield from ((now, *x) for x in joined.end())
            now, joined = conv, _Joined()
        yield from ((conv, *x) for x in joined.add(first, code, ways, costs))
    if joined:
        yield from ((now, *x) for x in joined.end())


class _Report:
    """State of one conversation while its rows go by in order."""

    def __init__(self):
        self.counts = {"b": 0, "d": 0, "t": 0}
        self.illegal = self.cost = self.turns = self.lines = 0
        self.before, self.state = "", START
        self.low = self.high = None
        self.audit: list[str] = []
        self.edits, self.at = "", 0  # of the stretch that is going by
        self.digest = hashlib.sha256()

    def stretch(self, code: str, edits: str) -> None:
        self.audit.append(edits)
        self.edits, self.at = edits, 0
        for who, fault in zip(code[::2], code[1::2]):
            if fault in self.counts:
                self.counts[fault] += 1
            self.illegal += bool(self.before) and self.before + who not in ("su", "ua", "au")
            self.before = who
        self.cost += INSERT * edits.count("I") + DELETE * edits.count("D") + REROLE * edits.count("R")
        self.cost += TRUNCATED * sum(letter != "D" and fault == "t" for letter, fault in zip(edits.replace("I", ""), code[1::2]))

    def row(self, turn, role: str, text: str) -> Iterator[tuple[str, str]]:
        """Repaired rows that the edits up to this row's give."""
        if turn is not None:  # turns come in order
            self.turns += turn != self.high
            self.low, self.high = turn if self.low is None else self.low, turn
        end = self.at
        while self.edits[end] == "I":
            end += 1
        end += 1
        if not self.edits[end:].strip("I"):  # inserts behind the last row
            end = len(self.edits)
        for letter in self.edits[self.at:end]:
            if letter == "K":
                self.state = NEXT[self.state, role[:1]]
                yield role, text
            elif letter != "D":
                who = MADE[self.state]
                self.state = NEXT[self.state, who]
                yield FULL[who], text if letter == "R" else ""
        self.at = end

    def result(self) -> tuple:
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return gaps, *self.counts.values(), self.illegal, self.cost, "".join(self.audit), self.digest.hexdigest()


def _walk(stream: Iterator[tuple]) -> Iterator[tuple[object, _Report, Iterator[tuple[str, str]] | None]]:
    """Per row of a stream its conversation, the state and its repaired rows; None for these where a conversation ends."""
    now, report = None, None
    for conv, _, kind, turn, role, text in stream:
        if report is None or conv != now:
            if report:
                yield now, report, None
            now, report = conv, _Report()
        if kind == 0:
            report.stretch(role, text)
        elif role is not None:
            yield now, report, report.row(turn, role, text)
    if report:
        yield now, report, None


def _reports(stream: Iterator[tuple]) -> Iterator[tuple]:
    for conv, report, lines in _walk(stream):
        if lines is None:
            yield conv, *report.result()
            continue
        for role, text in lines:
            report.digest.update(f"{chr(10) if report.lines else ''}{role}:{text}".encode())
            report.lines += 1


def _repaired(stream: Iterator[tuple]) -> Iterator[tuple]:
    for conv, report, lines in _walk(stream):
        for role, text in lines or ():
            yield conv, report.lines, role, text
            report.lines += 1


def _mapped(frame: DataFrame, step, kind: T.StructField, fields: str) -> DataFrame:
    """Apply a function from rows to rows to each partition; the result begins with the id column ``kind``."""
    schema = T.StructType([kind, *T.StructType.fromDDL(fields).fields])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(column.to_pylist() for column in batch.columns)))
        for some in batched(step(rows), 2000):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*some), arrow)], schema=arrow)

    return frame.mapInArrow(run, schema)


def _stream(rows: DataFrame, chunk: int) -> DataFrame:
    """Placed rows of each conversation in order, the edits of a stretch before its first row; rows that are gone have no role."""
    kind = rows.schema["conv_id"]
    solved = _mapped(stretches(faults(rows), chunk), _solve, kind, "first long, code string, ways array<string>, costs array<long>")
    edits = _mapped(solved.repartition("conv_id").sortWithinPartitions("conv_id", "first"), _join, kind, "first long, code string, edits string")
    edits = edits.select("conv_id", F.col("first").alias("_row"), F.lit(0).alias("_kind"), F.lit(None).cast(rows.schema["turn"].dataType).alias("turn"), "code", "edits")
    kept = [F.when(~F.col("gone"), F.col(c)).alias(c) for c in ("role", "text")]
    both = rows.select("conv_id", "_row", F.lit(1).alias("_kind"), "turn", *kept).union(edits)
    return both.repartition("conv_id").sortWithinPartitions("conv_id", "_row", "_kind")


def audit(rows: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Per conversation of ``rows`` (``conv_id, turn, role, text``, perhaps ``gone``) its faults, repair cost, audit and digest."""
    at = placed(rows)
    return _mapped(_stream(at, chunk), _reports, at.schema["conv_id"], "gaps long, blank long, duplicate long, truncated long, illegal long, "
                   "cost long, audit string, repaired_sha256 string")


def repair(rows: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """The repaired rows: ``conv_id, position`` (from 0), ``role, text``."""
    at = placed(rows)
    return _mapped(_stream(at, chunk), _repaired, at.schema["conv_id"], "position long, role string, text string")
