"""Conversations brought into the order (system) user assistant user assistant ... by the cheapest edits.

A dynamic program runs backward over each conversation. Its states are what was emitted last: nothing,
a system row, a user row, an assistant row. Backward costs are kept at checkpoints only and made again
for a stretch at a time while the edits are chosen forward. Long conversations are cut into segments that many tasks work on;
the costs at their ends are the checkpoints between them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import count
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from edgeloom.llm.storage import staged

#: Costs of the edits, white space, marks that end a text.
REROLE, DELETE, INSERT, CUT_OFF = 3, 4, 3, 3
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"
ENDS = (".", "!", "?")
#: States: nothing emitted yet, after a system row, after a user row, after an assistant row.
#: What an inserted or re-roled row leads to, and what a kept row with each initial (s, u, a, other) leads to.
NEXT = (2, 2, 3, 2)
KEPT = ((1, 2, None, None), (None, 2, None, None), (None, None, 3, None), (None, 2, None, None))
FINAL = (0, 6, 3, 0)
FAR = 1 << 60
#: Kinds of rows: the initial's number, and 4 more for a text that breaks off, 8 more for a blank one.
BROKEN, BLANK, FORCED = 4, 8, 16
LEGAL = {(0, 1), (1, 2), (2, 1)}
#: Rows of one segment: two to this power.
SEGMENT = 13
Costs = tuple[int, int, int, int]


# -- the dynamic program ----------------------------------------------------------------------


@lru_cache(maxsize=1 << 16)
def before(kind: int, after: Costs) -> tuple[Costs, int]:
    """Costs to the end before a row, less the least of them, and that least. ``after`` are those behind the row, with the
    least at 0: in this form few tuples exist, and each is worked out once."""
    if kind == FORCED:
        costs = [DELETE + c for c in after]
    else:
        extra, initial = CUT_OFF if kind & BROKEN else 0, kind & 3
        costs = []
        for state in range(4):
            options = [DELETE + after[state], REROLE + extra + after[NEXT[state]]]
            if KEPT[state][initial] is not None:
                options.append(extra + after[KEPT[state][initial]])
            costs.append(min(options))
        costs[2], costs[3] = min(costs[2], INSERT + costs[3]), min(costs[3], INSERT + costs[2])
        costs[0], costs[1] = (min(costs[s], INSERT + costs[2]) for s in (0, 1))
    return _level(costs)


def _level(costs: list[int]) -> tuple[Costs, int]:
    least = min(costs)
    return tuple(FAR if c >= FAR // 2 else c - least for c in costs), least


def passage(kinds: bytes) -> list[int]:
    """Costs from each state before the rows to each state behind them, row by row of a 4 x 4 table."""
    columns = []
    for goal in range(4):
        costs, total = tuple(0 if s == goal else FAR for s in range(4)), 0
        for kind in reversed(kinds):
            costs, least = before(kind, costs)
            total += least
        columns.append([FAR if c >= FAR else c + total for c in costs])
    return [columns[goal][state] for state in range(4) for goal in range(4)]


def choose(kinds: bytes, end: Costs, state: int) -> str:
    """The ASCII-least of the cheapest edits of ``kinds`` from ``state`` on, ``end`` being the costs behind them.

    Costs are stored at every k-th row, k the root of their number; each stretch of k rows is then made
    again from the checkpoint behind it, so 2 k cost tuples are held at once."""
    n = len(kinds)
    k = max(1, isqrt(n))
    stored = {n: _level(list(end))[0]}
    costs = stored[n]
    for i in range(n - 1, -1, -1):
        costs, _ = before(kinds[i], costs)
        if i % k == 0:
            stored[i] = costs
    out = []
    for begin in range(0, n, k):
        stop = min(begin + k, n)
        block = [(stored[stop], 0)]
        for i in range(stop - 1, begin - 1, -1):
            block.append(before(kinds[i], block[-1][0]))
        block.reverse()
        for i in range(begin, stop):
            (now, least), (after, _) = block[i - begin], block[i - begin + 1]
            kind = kinds[i]
            extra, kept = CUT_OFF if kind & BROKEN else 0, None if kind == FORCED else KEPT[state][kind & 3]
            while True:
                if now[state] + least == DELETE + after[state]:
                    out.append("D")
                    break
                if now[state] == INSERT + now[NEXT[state]]:
                    out.append("I")
                    state = NEXT[state]
                    kept = KEPT[state][kind & 3]
                    continue
                keeps = kept is not None and now[state] + least == extra + after[kept]
                out.append("K" if keeps else "R")
                state = kept if keeps else NEXT[state]
                break
    return "".join(out)


# -- rows, segments and their checkpoints -------------------------------------------------------


def prepared(rows: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str, copies_col: str | None) -> DataFrame:
    """Rows under the names used here, with their kind and a digest of role and text."""
    conv, role, text = F.col(f"`{id_col}`"), *(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" ")) for c in (role_col, text_col))
    copies = F.col(f"`{copies_col}`").cast("long") if copies_col else F.lit(1).cast("long")
    shown = F.rtrim("_text", F.lit(BLANKS))
    initial = F.substring("_role", 1, 1)
    number = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    fault = F.when(shown == "", BLANK).when(F.substring(shown, -1, 1).isin(*ENDS), 0).otherwise(BROKEN)
    digest = F.substring(F.unhex(F.sha2(F.concat_ws(":", F.length("_role").cast("string"), "_role", "_text"), 256)), 1, 16)
    out = rows.select(
        F.coalesce(F.concat(F.lit("="), conv.cast("string")), F.lit("")).alias("_key"), conv.alias("_conv"),
        F.col(f"`{turn_col}`").cast("long").alias("_turn"), role.alias("_role"), text.alias("_text"), copies.alias("_copies"),
    )
    return out.withColumns({"_kind": (number + fault).cast("int"), "_mark": digest})


PLACE = ["_key", "_turn", "_mark"]


def segments(rows: DataFrame) -> DataFrame:
    """Kinds of rows in order, a byte each, in segments of a bounded number of rows of one conversation, with their
    counts and their table of passage costs.

    Equal rows of one turn are one row with a number of copies, summed before any shuffle. Rows
    get their places by a sort over the whole table, which cuts a conversation between tasks where it is long. The first
    row of each role and text is an aggregate, and meets its place again by that place, so no
    key gathers rows."""
    runs = rows.groupBy(*PLACE, "_conv", "_kind").agg(F.sum("_copies").alias("_copies"))
    runs = runs.repartitionByRange(*PLACE).sortWithinPartitions(*PLACE)
    runs = staged(runs.withColumn("_at", F.monotonically_increasing_id()), "turns")
    firsts = runs.where((F.col("_copies") > 0) & (F.col("_kind") < BLANK)).groupBy("_key", "_mark").agg(F.min("_at").alias("_at"))
    firsts = firsts.select("_at", F.lit(-1).alias("_kind"))  # goes before the row of its place
    both = runs.unionByName(firsts, allowMissingColumns=True).withColumn("_chunk", F.shiftright("_at", SEGMENT))
    both = both.repartition("_chunk").sortWithinPartitions("_at", "_kind")
    schema = _schema(SEGMENT_FIELDS, dict(rows.dtypes)["_conv"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, one, first = [], None, None
        for batch in batches:
            for at, chunk, key, conv, turn, mark, kind, copies in _rows(batch, "_at", "_chunk", "_key", "_conv", "_turn", "_mark", "_kind", "_copies"):
                if kind < 0:
                    first = at
                    continue
                if one is None or (one.key, one.chunk) != (key, chunk):
                    if one:
                        done.append(one.row())
                    one = Segment(key, conv, chunk, turn, mark)
                one.add(turn, kind, copies, at == first)
            yield from _batch(done, schema)
            done = []
        yield from _batch([one.row()] if one else [], schema)

    return both.mapInArrow(run, schema)


SEGMENT_FIELDS = {
    "_key": "string", "_conv": None, "_chunk": "long", "_turn": "long", "_mark": "binary", "kinds": "binary", "passage": "array<long>",
    "blank": "long", "duplicate": "long", "truncated": "long", "illegal": "long", "first": "long", "last": "long",
    "low": "long", "high": "long", "turns": "long",
}


def _schema(fields: dict[str, str | None], conv: str) -> StructType:
    return StructType.fromDDL(", ".join(f"{name} {kind or conv}" for name, kind in fields.items()))


def _rows(batch: pa.RecordBatch, *names: str) -> Iterator[tuple]:
    """Values of the named columns, row by row; integers stay integers next to nulls."""
    return zip(*(batch.column(name).to_pylist() for name in names))


def _batch(rows: list[tuple], schema: StructType) -> Iterator[pa.RecordBatch]:
    if rows:
        arrow = to_arrow_schema(schema)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)


class Segment:
    """Rows of one conversation that stand together, as they come in."""

    def __init__(self, key: str, conv: object, chunk: int, turn: int | None, mark: bytes) -> None:
        self.key, self.conv, self.chunk, self.turn, self.mark = key, conv, chunk, turn, mark
        self.kinds = bytearray()
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
        self.first = self.last = self.low = self.high = None
        self.turns = 0

    def add(self, turn: int | None, kind: int, copies: int, is_first: bool) -> None:
        if not copies:
            return
        initial, blank = kind & 3, kind & BLANK
        self.kinds.append(kind if is_first and not blank else FORCED)
        if blank:
            self.counts["blank"] += copies
        else:
            self.counts["duplicate"] += copies - is_first
            self.counts["truncated"] += bool(is_first and kind & BROKEN)
        self.counts["illegal"] += copies - 1 + (self.last is not None and (self.last, initial) not in LEGAL)
        if self.first is None:
            self.first = initial
        self.last = initial
        if turn is not None:
            self.turns += turn != self.high
            self.low, self.high = turn if self.low is None else self.low, turn

    def row(self) -> tuple:
        kinds = bytes(self.kinds)
        more = (self.first, self.last, self.low, self.high, self.turns)
        return (self.key, self.conv, self.chunk, self.turn, self.mark, kinds, passage(kinds), *self.counts.values(), *more)


PIECE_FIELDS = {name: kind for name, kind in SEGMENT_FIELDS.items() if name not in ("kinds", "passage")} | {"cost": "long", "edits": "array<string>"}


def pieces(rows: DataFrame) -> DataFrame:
    """Each segment's edits for each state that it may begin in, and its cost to the end from the first one.

    The costs behind each segment are a fold over the segments' tables from the last to the first; with
    these checkpoints, segments are independent."""
    conv = dict(rows.dtypes)["_conv"]
    with_end, planned = (_schema(fields, conv) for fields in (SEGMENT_FIELDS | {"end": "array<long>"}, PIECE_FIELDS))

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, costs = None, FINAL
        for batch in batches:
            ends = []
            for key, table in _rows(batch, "_key", "passage"):
                costs = costs if key == last else FINAL
                last = key
                ends.append(costs)
                costs = [min(table[4 * state + goal] + costs[goal] for goal in range(4)) for state in range(4)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ends, pa.list_(pa.int64()))], names=with_end.names)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            edits, cost = [], []
            for kinds, table, end in _rows(batch, "kinds", "passage", "end"):
                edits.append([choose(kinds, tuple(end), state) for state in range(4)])
                cost.append(min(c + e for c, e in zip(table, end)))
            kept = [batch.column(name) for name in PIECE_FIELDS if name in SEGMENT_FIELDS]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(cost, pa.int64()), pa.array(edits, pa.list_(pa.string()))], names=planned.names)

    segmented = segments(rows).repartition("_key").sortWithinPartitions("_key", F.desc("_chunk"))
    # a long conversation's segments come out of one task and are spread again
    return segmented.mapInArrow(fold, with_end).repartition("_key", "_chunk").mapInArrow(walk, planned)


# -- edits applied -----------------------------------------------------------------------------


class Conversation:
    """One conversation while its pieces and rows stream by in order. ``emit`` gets (edit, role, text, copies) of each edit."""

    def __init__(self, conv: object, emit: Callable[[str, str | None, str | None, int], None]) -> None:
        self.conv, self.emit = conv, emit
        self.state, self.edits, self.at, self.place, self.more, self.cost = 0, "", 0, None, 0, None
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
        self.last = self.low = self.high = None
        self.turns = 0

    def piece(self, p: dict) -> None:
        self._rest()
        self.edits, self.at = p["edits"][self.state], 0
        self.cost = p["cost"] if self.cost is None else self.cost
        for name in self.counts:
            self.counts[name] += p[name]
        if p["first"] is not None:
            self.counts["illegal"] += self.last is not None and (self.last, p["first"]) not in LEGAL
            self.last = p["last"]
        if p["low"] is not None:
            self.turns += p["turns"] - (p["low"] == self.high)
            self.low, self.high = p["low"] if self.low is None else self.low, p["high"]

    def row(self, place: tuple, role: str, text: str, copies: int) -> None:
        if place == self.place:
            self.more += copies
            return
        self._rest()
        self.place, self.more = place, copies - 1
        while self.edits[self.at] == "I":
            self._insert()
            self.at += 1
        edit = self.edits[self.at]
        self.at += 1
        if edit == "D":
            self.emit("D", role, text, 1)
        elif edit == "K":
            self.state = {"s": 1, "u": 2, "a": 3}[role[0]]
            self.emit("K", role, text, 1)
        else:
            self.state = NEXT[self.state]
            self.emit("R", _role(self.state), text, 1)

    def close(self) -> None:
        self._rest()
        while FINAL[self.state]:
            self._insert()

    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.turns

    def _insert(self) -> None:
        self.state = NEXT[self.state]
        self.emit("I", _role(self.state), "", 1)

    def _rest(self) -> None:
        """Further copies of the last row are duplicates (or blank), which must go."""
        if self.more:
            self.emit("D", None, None, self.more)
            self.cost += DELETE * self.more
        self.more = 0


def _role(state: int) -> str:
    return "user" if state == 2 else "assistant"


def _streamed(rows: DataFrame) -> DataFrame:
    """Pieces and rows of each conversation, in order: a piece before the first row that it is about."""
    texts = rows.where("_copies > 0").select(*PLACE, F.lit(True).alias("_is_row"), "_conv", "_role", "_text", "_copies")
    plan = pieces(rows).withColumn("_is_row", F.lit(False))
    both = texts.unionByName(plan, allowMissingColumns=True)
    return both.repartition("_key").sortWithinPartitions(*PLACE, "_is_row")


def _conversations(batches: Iterator[pa.RecordBatch], start: Callable[[object], Conversation]) -> Iterator[Conversation | None]:
    """Each conversation when its last row is through, and None at the end of each batch."""
    last, one = None, None
    planned = [name for name in PIECE_FIELDS if name not in (*PLACE, "_conv", "_chunk")]
    for batch in batches:
        rows = _rows(batch, "_key", "_turn", "_mark", "_is_row", "_conv", "_role", "_text", "_copies", *planned)
        for key, turn, mark, is_row, conv, role, text, copies, *plan in rows:
            if one is None or key != last:
                if one:
                    one.close()
                    yield one
                last, one = key, start(conv)
            if is_row:
                one.row((turn, mark), role, text, copies)
            else:
                one.piece(dict(zip(planned, plan)))
        yield None
    if one:
        one.close()
        yield one


def repair(
    rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", copies_col: str | None = None
) -> DataFrame:
    """The edits of each conversation in order: the id, ``number`` (from 0), ``edit`` (K, R, D or I), ``role``, ``text``
    and ``copies``. Rows whose edit is not D are the repaired conversation; further copies of a row are one D with their number.

    A conversation's rows go by turn (nulls first), then by a digest of role and text. Roles must read
    ``(s?(ua)+)?`` by their initials. Keeping costs 0, another role (user or assistant) 3, deleting 4, inserting an
    empty user or assistant row 3; blank rows and rows whose role and text came before must be deleted; keeping a row whose
    text does not end with ``.``, ``!`` or ``?`` costs 3 more. Of the cheapest edits those with the ASCII-least initials are taken.

    Null roles and texts are one space, so blank. A null id is a conversation of its own. Repeated rows are
    duplicates. ``copies_col`` says how often a row counts; with 0 it only names its conversation. An empty
    table gives no rows; other columns are not read. Rows of one conversation stream through one task at the end, one
    at a time; all else about a long conversation is shared out in segments.
    """
    ready = prepared(rows, id_col, turn_col, role_col, text_col, copies_col)
    fields = {"conv": None, "number": "long", "edit": "string", "role": "string", "text": "string", "copies": "long"}
    schema = _schema(fields, dict(ready.dtypes)["_conv"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []

        def start(conv: object) -> Conversation:
            number = count()
            return Conversation(conv, lambda edit, role, text, n: out.append((conv, next(number), edit, role, text, n)))

        for one in _conversations(batches, start):
            if one is None:
                yield from _batch(out, schema)
                out.clear()
        yield from _batch(out, schema)

    return _streamed(ready).mapInArrow(run, schema).withColumnRenamed("conv", id_col)


REPORT = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def report(
    rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", copies_col: str | None = None
) -> DataFrame:
    """One row per conversation about the same edits: ``gaps`` in the turns, rows by their first fault (``blank``,
    ``duplicate``, ``truncated``), ``illegal`` neighbours, ``cost``, ``audit`` (the edits' initials) and
    ``repaired_sha256`` of the repaired ``role:text`` lines. The digest is taken as the rows stream by; the audit is held whole, a
    byte per edit, as it is one value of the result. Conversations without rows have zeros, no edits and the empty string's digest."""
    ready = prepared(rows, id_col, turn_col, role_col, text_col, copies_col)
    fields = {"conv": None, **dict.fromkeys(REPORT[:6], "long"), **dict.fromkeys(REPORT[6:], "string")}
    schema = _schema(fields, dict(ready.dtypes)["_conv"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, held = [], {}

        def start(conv: object) -> Conversation:
            audit, digest, newline = bytearray(), hashlib.sha256(), iter(("",))

            def emit(edit: str, role: str | None, text: str | None, n: int) -> None:
                if edit != "D":
                    digest.update(f"{next(newline, chr(10))}{role}:{text}".encode())
                audit.extend(edit.encode() * n)

            held.update(audit=audit, digest=digest)
            return Conversation(conv, emit)

        for one in _conversations(batches, start):
            if one is None:
                yield from _batch(out, schema)
                out = []
            else:
                out.append((one.conv, one.gaps(), *one.counts.values(), one.cost, held["audit"].decode(), held["digest"].hexdigest()))
        yield from _batch(out, schema)

    return _streamed(ready).mapInArrow(run, schema).withColumnRenamed("conv", id_col)


# -- damage, for trials ----------------------------------------------------------------------------


def damage(rows: DataFrame) -> DataFrame:
    """``conversations`` with faults put in by crc32 of ``conv_id:turn``, and how many copies of each row there are then."""
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    how = F.col("_how")
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.crc32(key) % 20).alias("_how")).select(
        "conv_id", "turn",
        F.when(how == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(how == 1, "").when(how == 2, F.translate("text", "".join(ENDS), "")).otherwise(F.col("text")).alias("text"),
        F.when(how == 0, 0).when(how == 3, 2).otherwise(1).alias("copies"),
    )
