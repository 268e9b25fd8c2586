"""Conversation structure repair: the cheapest edits that make the roles of a conversation alternate.

The edits of a conversation form a lattice: its nodes are the number of rows read and the last role written, its
edges keep, rerole, delete or insert a row. Two heaps search it from both ends; once they have met, all crossings of
the same least cost are finished and the one with the least concatenated audit is taken. Every audit names one path,
so two different audits between the same nodes at the same cost are never one the beginning of the other, and
comparing parts compares wholes.

Ordinary conversations are handled one by one where a shuffle by id brings them together. Longer ones are cut: rows
are dealt by range of their order, each stretch is searched between all pairs of roles at its ends, and stretches are
joined by the least sum and least concatenation of their audits. Their texts pass once more, in order, to be hashed.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbcast.llm.common import stored

#: Conversations with more rows are cut into stretches; also the rows searched at once in those.
LONG_ROWS = 64
#: Audits remembered per task, by the pattern of their rows.
REMEMBERED = 50_000

# What the edits cost and what they are called.
INSERT, DELETE, REROLE, TRUNCATED = 3, 4, 3, 3
SPACE = " \t\n\x0b\x0c\r"
STOPS = ".!?"
LEGAL = {"su", "ua", "au"}
# End of fixed values.

#: Last role written: none, system, user, assistant; and what may be written next.
NONE, SYSTEM, USER, ASSISTANT = range(4)
ENDS = (NONE, ASSISTANT)
NEXT = (USER, USER, ASSISTANT, USER)
BEFORE = ((), (), (NONE, SYSTEM, ASSISTANT), (USER,))
KEPT = {"s": {NONE: SYSTEM}, "u": {NONE: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}, "x": {}}
NAMES = {USER: "user", ASSISTANT: "assistant"}

RESULT = ("gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
          "repaired_sha256 string")
Label = tuple[int, str]


# --- the lattice -------------------------------------------------------------------------------------------------

def _onward(pattern: str, row: int, role: int) -> Iterator[tuple[int, str, tuple[int, int]]]:
    """(cost, edit, node) of all edits from a node."""
    yield INSERT, "I", (row, NEXT[role])
    if row == len(pattern):
        return
    yield DELETE, "D", (row + 1, role)
    sign = pattern[row]
    if sign != "d":
        extra = TRUNCATED if sign.isupper() else 0
        kept = KEPT[sign.lower()].get(role)
        if kept is not None:
            yield extra, "K", (row + 1, kept)
        yield REROLE + extra, "R", (row + 1, NEXT[role])


def _backward(pattern: str, row: int, role: int) -> Iterator[tuple[int, str, tuple[int, int]]]:
    """(cost, edit, node) of all edits to a node."""
    for earlier in BEFORE[role]:
        yield INSERT, "I", (row, earlier)
    if row == 0:
        return
    yield DELETE, "D", (row - 1, role)
    sign = pattern[row - 1]
    if sign != "d":
        extra = TRUNCATED if sign.isupper() else 0
        for earlier, kept in KEPT[sign.lower()].items():
            if kept == role:
                yield extra, "K", (row - 1, earlier)
        for earlier in BEFORE[role]:
            yield REROLE + extra, "R", (row - 1, earlier)


class _Side:
    """One of the two searches: its labels, and a heap by cost. Among equal costs the nodes first on its way come
    first, as only an edit to the next row can cost nothing."""

    def __init__(self, nodes: Iterable[tuple[int, int]], way: int):
        self.way = way
        self.labels: dict[tuple[int, int], Label] = {node: (0, "") for node in nodes}
        self.heap = [(0, way * row, role) for row, role in self.labels]
        heapq.heapify(self.heap)
        self.done: set[tuple[int, int]] = set()

    @property
    def least(self) -> float:
        return self.heap[0][0] if self.heap else float("inf")

    def step(self, pattern: str) -> Iterator[tuple[int, int]]:
        """Settles the cheapest node; gives the nodes whose labels it improved."""
        cost, place, role = heapq.heappop(self.heap)
        node = (self.way * place, role)
        if node in self.done:
            return
        self.done.add(node)
        audit = self.labels[node][1]
        for more, edit, other in (_onward if self.way > 0 else _backward)(pattern, *node):
            label = (cost + more, audit + edit if self.way > 0 else edit + audit)
            if other not in self.labels or label < self.labels[other]:
                self.labels[other] = label
                heapq.heappush(self.heap, (label[0], self.way * other[0], other[1]))
                yield other


def cheapest(pattern: str, entry: int = NONE, exits: Iterable[int] = ENDS) -> Label | None:
    """Least cost and, of that cost, least audit between roles before and after rows; None if there is no way.

    ``pattern`` has a sign per row: ``s``, ``u``, ``a`` for its role or ``x`` for another, in upper case if the row is
    truncated, ``d`` for a row that has to be deleted.
    """
    ahead = _Side([(0, entry)], 1)
    back = _Side([(len(pattern), role) for role in exits], -1)
    best: Label | None = None
    met = [node for node in ahead.labels if node in back.labels]
    while True:
        for node in met:
            (a, first), (b, second) = ahead.labels[node], back.labels[node]
            if best is None or (a + b, first + second) < best:
                best = (a + b, first + second)
        # Strictly above: crossings that cost the same are all finished before.
        if ahead.least + back.least > (best[0] if best else float("inf")) or not (ahead.heap or back.heap):
            return best
        side, other = (ahead, back) if ahead.least <= back.least else (back, ahead)
        met = [node for node in side.step(pattern) if node in other.labels]


# --- rows --------------------------------------------------------------------------------------------------------

@dataclass
class Stretch:
    """What is known of consecutive rows of a conversation; stretches can be joined."""

    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    turns: int = 0
    first_turn: int | None = None
    last_turn: int | None = None
    initials: tuple[str, str] | None = None
    pattern: list[str] = field(default_factory=list)

    def add(self, turn: int | None, role: str, text: str, repeated: bool) -> None:
        """One more row, in order."""
        bare = text.strip(SPACE)
        initial = role[:1]
        sign = initial if initial in ("s", "u", "a") else "x"
        if not bare or repeated:
            self.blank += not bare
            self.duplicate += bool(bare)
            sign = "d"
        elif bare[-1] not in STOPS:
            self.truncated += 1
            sign = sign.upper()
        if self.initials:
            self.illegal += self.initials[1] + initial not in LEGAL
        self.initials = (self.initials[0] if self.initials else initial, initial)
        if turn is not None and turn != self.last_turn:
            self.turns += 1
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
        self.pattern.append(sign)

    def join(self, other: "Stretch") -> None:
        """The rows of ``other`` behind these, all but the patterns."""
        if self.initials and other.initials:
            self.illegal += self.initials[1] + other.initials[0] not in LEGAL
        self.turns += other.turns - (other.first_turn is not None and other.first_turn == self.last_turn)
        for name in ("blank", "duplicate", "truncated", "illegal"):
            setattr(self, name, getattr(self, name) + getattr(other, name))
        if other.initials:
            self.initials = (self.initials[0] if self.initials else other.initials[0], other.initials[1])
        self.first_turn = other.first_turn if self.first_turn is None else self.first_turn
        self.last_turn = self.last_turn if other.last_turn is None else other.last_turn

    @property
    def gaps(self) -> int:
        return 0 if self.first_turn is None else self.last_turn - self.first_turn + 1 - self.turns

    @property
    def counts(self) -> list[int]:
        return [self.gaps, self.blank, self.duplicate, self.truncated, self.illegal]


class Repair:
    """Applies an audit to rows as they come and hashes what it gives."""

    def __init__(self, audit: str):
        self.audit, self.at, self.role = audit, 0, NONE
        self.hash, self.empty = hashlib.sha256(), True

    def _write(self, line: str) -> None:
        self.hash.update(line.encode("utf-8", "replace") if self.empty else b"\n" + line.encode("utf-8", "replace"))
        self.empty = False

    def _inserts(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.role = NEXT[self.role]
            self._write(f"{NAMES[self.role]}:")
            self.at += 1

    def add(self, role: str, text: str) -> None:
        self._inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.role = KEPT[role[:1]][self.role]
            self._write(f"{role}:{text}")
        elif edit == "R":
            self.role = NEXT[self.role]
            self._write(f"{NAMES[self.role]}:{text}")

    def digest(self) -> str:
        self._inserts()
        return self.hash.hexdigest()


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns)))


def _by_conversation(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[object, Iterator[tuple]]]:
    """(conv_id, its rows without the id) of sorted rows; the rows have to be used before the next id is asked for."""
    rows = _rows(batches)
    row = next(rows, None)

    def rest(conv) -> Iterator[tuple]:
        nonlocal row
        while row is not None and row[0] == conv:
            yield row[1:]
            row = next(rows, None)

    while row is not None:
        conv = row[0]
        yield conv, rest(conv)


def _table(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)] if rows else [pa.array([], f.type) for f in schema],
        schema=schema)


def _in_batches(schema: pa.Schema, rows: Iterable[tuple], size: int = 4096) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield _table(schema, held)
            held = []
    if held:
        yield _table(schema, held)


# --- the operator ------------------------------------------------------------------------------------------------

def repaired(conversations: DataFrame, present: Column | None = None, long_rows: int = LONG_ROWS) -> DataFrame:
    """Faults and cheapest repair of each conversation.

    ``conversations``: ``conv_id``, ``turn``, ``role``, ``text``; other columns are ignored; a null role or text is one
    space. Rows are taken by ``turn`` (nulls first), those of one turn by role and text. A row for which ``present`` is
    not true only names its conversation. A null ``conv_id`` is a conversation of its own.

    Faults, the first of a row counts: blank, duplicate (role and text seen earlier), truncated (does not end in a
    stop). Edits: keep (0), rerole to user or assistant (3), delete (4; required of blank and duplicate rows), insert
    an empty user or assistant row (3); truncated rows that stay add 3. Afterwards the roles' initials are a system
    row or none and then at least one pair of user and assistant, or nothing at all.

    Result: ``conv_id``, ``gaps`` (turns missing between the first and the last), ``blank``, ``duplicate``,
    ``truncated``, ``illegal`` (neighbours whose initials are not su, ua or au), ``cost``, ``audit`` (the edits'
    initials; of the cheapest the least in ASCII), ``repaired_sha256`` of the repaired ``role:text`` lines. A conversation
    without rows has zeros, an empty audit and the hash of the empty string; an empty table gives an empty result.
    """
    blank = F.lit(" ")
    rows = conversations.select(
        F.col("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), blank).alias("role"),
        F.coalesce(F.col("text").cast("string"), blank).alias("text"),
        F.coalesce(present if present is not None else F.lit(True), F.lit(False)).alias("present"))
    sizes = rows.groupBy("conv_id").agg(F.count_if("present").alias("n"))
    long_ids = stored(sizes.where(F.col("n") > long_rows).select(F.col("conv_id").alias("long_id")), "long_conversations")
    if long_ids.isEmpty():
        return _short(rows)
    same = F.col("conv_id").eqNullSafe(F.col("long_id"))
    short = rows.join(long_ids, same, "left_anti")
    return _short(short).unionByName(_long(rows.where("present").join(long_ids, same, "left_semi"), long_rows))


def _schema(rows: DataFrame, more: str) -> str:
    return f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, {more}"


def _arrow(id_type: pa.DataType, more: list[tuple[str, pa.DataType]]) -> pa.Schema:
    return pa.schema([("conv_id", id_type), *more])


RESULT_ARROW = [*[(n, pa.int64()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                ("audit", pa.string()), ("repaired_sha256", pa.string())]


def _short(rows: DataFrame) -> DataFrame:
    """Conversations of bounded length, each held as a whole."""

    def repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, Label] = {}
        batches = iter(batches)
        first = next(batches, None)
        if first is None:
            return

        def results() -> Iterator[tuple]:
            for conv, found in _by_conversation(_chain(first, batches)):
                stretch, seen, texts = Stretch(), set(), []
                for turn, role, text, there in found:
                    if there:
                        stretch.add(turn, role, text, (role, text) in seen)
                        seen.add((role, text))
                        texts.append((role, text))
                pattern = "".join(stretch.pattern)
                if pattern not in known:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[pattern] = cheapest(pattern)
                cost, audit = known[pattern]
                out = Repair(audit)
                for role, text in texts:
                    out.add(role, text)
                yield (conv, *stretch.counts, cost, audit, out.digest())

        yield from _in_batches(_arrow(first.schema.field("conv_id").type, RESULT_ARROW), results())

    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return dealt.mapInArrow(repair, _schema(rows, RESULT))


def _chain(first: pa.RecordBatch, others: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield first
    yield from others


# --- long conversations ------------------------------------------------------------------------------------------

Paths = list[Label | None]


def _paths(pattern: str) -> Paths:
    """Least label between each role before and each after the rows."""
    return [cheapest(pattern, entry, [exit_]) for entry in range(4) for exit_ in range(4)]


def _joined(one: Paths, two: Paths) -> Paths:
    """Least label through both, ``one`` starting with any number of roles."""
    out: Paths = []
    for at in range(0, len(one), 4):
        for exit_ in range(4):
            ways = [(a[0] + b[0], a[1] + b[1]) for a, b in ((one[at + m], two[4 * m + exit_]) for m in range(4))
                    if a is not None and b is not None]
            out.append(min(ways, default=None))
    return out


STRETCH = ("part long, blank long, duplicate long, truncated long, illegal long, turns long, first_turn long, "
           "last_turn long, first string, last string, costs array<long>, audits array<string>")
STRETCH_ARROW = [*[(n, pa.int64()) for n in (
    "part", "blank", "duplicate", "truncated", "illegal", "turns", "first_turn", "last_turn")],
    ("first", pa.string()), ("last", pa.string()), ("costs", pa.list_(pa.int64())), ("audits", pa.list_(pa.string()))]


def _long(rows: DataFrame, long_rows: int) -> DataFrame:
    """Conversations of any length, cut by ranges of their order."""
    rows = stored(rows.select("conv_id", "turn", "role", "text", F.monotonically_increasing_id().alias("row")), "long_rows")
    digest = F.sha2(F.concat_ws(":", F.char_length("role"), "role", "text"), 256)
    firsts = (rows.groupBy("conv_id", digest.alias("digest")).agg(F.min(F.struct("turn", "row")).alias("first"))
              .select(F.col("first.row").alias("row"), F.lit(True).alias("first")))
    # A join by row number: no text, however often it is repeated, decides where rows go.
    order = ["conv_id", "turn", "role", "text", "row"]
    flagged = rows.join(firsts, "row", "left").select(*order, F.col("first").isNull().alias("repeated"))
    dealt = flagged.repartitionByRange(*order).sortWithinPartitions(*order).drop("row")

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = iter(batches)
        first = next(batches, None)
        if first is None:
            return
        part = TaskContext.get().partitionId()

        def stretches() -> Iterator[tuple]:
            for conv, found in _by_conversation(_chain(first, batches)):
                # Neighbours of about equal length are joined, so that no audit is copied often.
                whole, piece, stack = Stretch(), Stretch(), []

                def close() -> None:
                    size, paths = len(piece.pattern), _paths("".join(piece.pattern))
                    while stack and stack[-1][0] <= size:
                        before, earlier = stack.pop()
                        size, paths = size + before, _joined(earlier, paths)
                    stack.append((size, paths))
                    whole.join(piece)

                for row in found:
                    piece.add(*row)
                    if len(piece.pattern) == long_rows:
                        close()
                        piece = Stretch()
                if piece.pattern:
                    close()
                paths = stack.pop()[1]
                while stack:
                    paths = _joined(stack.pop()[1], paths)
                yield (conv, part, whole.blank, whole.duplicate, whole.truncated, whole.illegal, whole.turns,
                       whole.first_turn, whole.last_turn, *whole.initials, [p and p[0] for p in paths],
                       [p and p[1] for p in paths])

        yield from _in_batches(_arrow(first.schema.field("conv_id").type, STRETCH_ARROW), stretches(), 16)

    parts = stored(dealt.mapInArrow(summed, _schema(rows, STRETCH)), "stretches")

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = iter(batches)
        first = next(batches, None)
        if first is None:
            return

        def results() -> Iterator[tuple]:
            for conv, found in _by_conversation(_chain(first, batches)):
                whole, paths = Stretch(), [(0, ""), None, None, None]
                for _, *numbers, start, end, costs, audits in found:
                    whole.join(Stretch(*numbers, (start, end)))
                    paths = _joined(paths, [None if c is None else (c, a) for c, a in zip(costs, audits)])
                cost, audit = min(p for p in (paths[e] for e in ENDS) if p is not None)
                yield (conv, *whole.counts, cost, audit, "")

        yield from _in_batches(_arrow(first.schema.field("conv_id").type, RESULT_ARROW), results(), 16)

    together = parts.repartition("conv_id").sortWithinPartitions("conv_id", "part")
    audits = stored(together.mapInArrow(merged, _schema(rows, RESULT)), "audits")
    return _hashed(rows, audits)


def _hashed(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """The results with the hash of the repaired lines: the rows pass in order behind their audit, none is held."""
    names = [f.split()[0] for f in RESULT.split(", ")][:-1]
    lines = rows.select("conv_id", F.lit(1).alias("kind"), "turn", "role", "text", "row",
                        F.lit(None).cast(audits.select(F.struct(*names)).schema[0].dataType).alias("found"))
    heads = audits.select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"),
                          F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"),
                          F.lit(None).cast("long").alias("row"), F.struct(*names).alias("found"))
    order = ["conv_id", "kind", "turn", "role", "text", "row"]
    dealt = lines.unionByName(heads).repartition("conv_id").sortWithinPartitions(*order).select(
        "conv_id", "role", "text", "found")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = iter(batches)
        first = next(batches, None)
        if first is None:
            return

        def results() -> Iterator[tuple]:
            for conv, found in _by_conversation(_chain(first, batches)):
                head = next(found)[2]
                out = Repair(head["audit"])
                for role, text, _ in found:
                    out.add(role, text)
                yield (conv, *[head[n] for n in names], out.digest())

        yield from _in_batches(_arrow(first.schema.field("conv_id").type, RESULT_ARROW), results(), 16)

    return dealt.mapInArrow(hashed, _schema(rows, RESULT))


# --- damage ------------------------------------------------------------------------------------------------------

def damaged(conversations: DataFrame) -> DataFrame:
    """The rows with faults put in by crc32 of ``conv_id:turn``, modulo 20, to have something to repair.

    Nulls count as one space. 0 takes the row away (``present`` is false), 1 empties its text, 2 takes the stops out of
    it, 3 repeats it, 4 makes its role user.
    """
    def spaced(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat_ws(":", spaced("conv_id"), spaced("turn")).cast("binary")) % 20
    marked = conversations.select("conv_id", "turn", spaced("role").alias("role"), spaced("text").alias("text"),
                                  kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", STOPS, "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1))
    return marked.select("conv_id", "turn", role.alias("role"), text.alias("text"),
                         (F.col("kind") != 0).alias("present"), F.explode(copies).alias("copy")).drop("copy")
