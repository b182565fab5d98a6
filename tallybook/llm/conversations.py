"""Conversation structure repair: the cheapest edits that give a legal order of roles, found in one ordered stream.

A legal conversation has the role initials ``(s?(ua)+)?``.  Edits: keep a turn (K, 0), give it another role (R, user or assistant, 2),
delete it (D, 3; blank and duplicate turns must go), insert an empty user or assistant turn anywhere (I, 2); a truncated turn
that stays costs 1 more.  Among the cheapest the string of edits (``audit``) that is smallest in ASCII is taken.

Rows are dealt by conversation and sorted by turn.  A task carries the state of a dynamic programme from one Arrow batch to the next: for each
state of the grammar its cost and its rank among the strings of edits.  Costs matter by their differences only and these
are bounded, so there are finitely many such tables: they are found once, as an automaton, and a row costs one look-up.  What leads back
is one number of two bytes a row, the automaton's move.  A conversation of more than ``HELD`` rows does not keep them: every ``HELD`` moves
go out as a row, which is written to the shared folder, and a second stream over these rows in reverse order reads the edits off.  No task
holds a conversation, and a lost executor costs no more than its tasks.  The texts are not in this stream; ``repaired_turns`` merges the
audit with the turns in another ordered stream.

Ties and cases: rows of a conversation are taken by turn (NULL first), then role, then hash of the text; equal rows are equal either way.
A NULL role or text is one space; a NULL conversation is a conversation of its own.  A role that begins with
anything but s, u or a, or is empty, can't be kept.  A row with ``gone`` only says that its conversation exists.  An empty table gives no rows.
Further columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import freeze

HELD = 1 << 16
KEEP, RENAME, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, RENAME: 2, DELETE: 3, INSERT: 2}
# States of the grammar: nothing yet, after s, after u, after a.
START, S, U, A = range(4)
_OUT = {START: "u", S: "u", U: "a", A: "u"}  # the role that can be inserted or given
_NEXT = {(START, "s"): S, (START, "u"): U, (S, "u"): U, (A, "u"): U, (U, "a"): A}
ROLE = {"u": "user", "a": "assistant"}
INITIALS = "sua?"
FINE, TRUNCATED, BLANK, DUPLICATE, GONE = range(5)
#: Any state can go on like any other one at this cost at most, so one that costs more is on no cheapest way.
SLACK = 8


def _ways(state: int) -> Iterator[tuple[int, str]]:
    """States after 0, 1 or 2 insertions."""
    way = ""
    for _ in range(3):
        yield state, way
        state, way = _NEXT[state, _OUT[state]], way + INSERT


def _row(table: tuple, kind: int) -> tuple[tuple, int, dict]:
    """The table after a row of a kind: (state, cost over the least) by rank; the least cost that came on; where each state came from."""
    initial, fault = INITIALS[kind // 3], kind % 3
    best: dict[int, tuple] = {}
    for rank, (state, cost) in enumerate(table):
        for at, way in _ways(state):
            own = cost + COST[INSERT] * len(way)
            moves = [(at, DELETE, COST[DELETE])]
            if fault < 2:
                if (at, initial) in _NEXT:
                    moves.append((_NEXT[at, initial], KEEP, COST[KEEP] + fault))
                moves.append((_NEXT[at, _OUT[at]], RENAME, COST[RENAME] + fault))
            for to, edit, price in moves:
                new = (own + price, rank, way + edit, state)
                if to not in best or new < best[to]:
                    best[to] = new
    least = min(b[0] for b in best.values())
    kept = {to: b for to, b in best.items() if b[0] - least <= SLACK}
    order = sorted(kept, key=lambda to: kept[to][1:3])
    return tuple((to, kept[to][0] - least) for to in order), least, {to: (kept[to][3], kept[to][2]) for to in order}


def _end(table: tuple) -> tuple[int, int, str]:
    """Least cost that comes on at the end, the state it is reached from, and the insertions."""
    ways = [(cost + COST[INSERT] * len(way), rank, way, state) for rank, (state, cost) in enumerate(table) for at, way in _ways(state) if at in (START, A)]
    cost, _, way, state = min(ways)
    return cost, state, way


@functools.cache
def automaton() -> tuple[list, list, list]:
    """Per table: its moves by kind of row, (next table, cost, number of the move); its end; and per move where each state came from."""
    first = ((START, 0),)
    number, tables, moves, back = {first: 0}, [first], [], []
    while len(moves) < len(tables):
        own = []
        for kind in range(12):
            table, cost, came = _row(tables[len(moves)], kind)
            if table not in number:
                number[table] = len(tables)
                tables.append(table)
            own.append((number[table], cost, len(back)))
            back.append(came)
        moves.append(own)
    assert len(back) < 1 << 16
    return moves, [_end(t) for t in tables], back


def edits(moves: list[int], state: int) -> tuple[str, int]:
    """The edits of a run of moves that ends in a state, and the state it began in."""
    back, parts = automaton()[2], []
    for move in reversed(moves):
        state, way = back[move][state]
        parts.append(way)
    return "".join(reversed(parts)), state


def first_copies(rows: DataFrame, keys: list[str], order: list[Column]) -> Column:
    """Whether a row is not the first of its keys in the order."""
    return F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) > 1


_HEAD = "conv_id {id}, chunk long, moves binary, state int"
_SUMS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long"


class _Run:
    """One conversation while its rows pass."""

    __slots__ = ("table", "cost", "moves", "chunk", "low", "high", "turns", "faults", "illegal", "last")

    def __init__(self):
        self.table = self.cost = self.chunk = self.turns = self.illegal = 0
        self.moves, self.faults, self.low, self.high, self.last = [], [0] * 5, None, None, None

    def add(self, graph: list, turn: int | None, initial: int, fault: int) -> None:
        if turn is not None:
            if turn != self.high:
                self.turns += 1
            self.low, self.high = turn if self.low is None else self.low, turn
        self.faults[fault] += 1
        if self.last is not None and (self.last, initial) not in _LEGAL:
            self.illegal += 1
        self.last = initial
        self.table, cost, move = graph[self.table][initial * 3 + min(fault, 2)]
        self.cost += cost
        self.moves.append(move)

    def sums(self, more: int) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return gaps, self.faults[BLANK], self.faults[DUPLICATE], self.faults[TRUNCATED], self.illegal, self.cost + more


_LEGAL = {(0, 1), (1, 2), (2, 1)}


def _prepared(turns: DataFrame, conv: str, turn: str, role: str, text: str, gone: Column) -> DataFrame:
    said, who = F.coalesce(F.col(text), F.lit(" ")), F.coalesce(F.col(role), F.lit(" "))
    return turns.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), who.alias("role"), said.alias("text"), gone.alias("gone"))


def _ordered(digest: str) -> list[Column]:
    return [F.col("turn").asc_nulls_first(), F.col("role"), F.col(digest)]


def repairs(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", gone: str | None = None, held: int = HELD) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit."""
    own = _prepared(turns, conv, turn, role, text, F.coalesce(F.col(gone), F.lit(False)) if gone else F.lit(False))
    blanks = "\x20\t\n\v\f\r"
    shown = F.rtrim(F.col("text"), F.lit(blanks))
    initial = F.when(F.col("role").startswith("s"), 0).when(F.col("role").startswith("u"), 1).when(F.col("role").startswith("a"), 2).otherwise(3)
    own = own.select(
        "conv_id", "turn", "role", "gone", F.sha2(F.col("text"), 256).alias("said"), initial.alias("initial"),
        (shown == "").alias("blank"), F.right(shown, F.lit(1)).isin(".", "!", "?").alias("closed"),
    )
    again = first_copies(own, ["conv_id", "gone", "role", "said"], _ordered("said"))
    fault = F.when(F.col("gone"), GONE).when(F.col("blank"), BLANK).when(F.col("again"), DUPLICATE).when(F.col("closed"), FINE).otherwise(TRUNCATED)
    own = own.repartition("conv_id").withColumn("again", again).withColumn("fault", fault)
    own = own.sortWithinPartitions("conv_id", *_ordered("said")).select("conv_id", F.col("turn").cast("long").alias("turn"), "initial", "fault")
    kind = turns.schema[conv].dataType.simpleString()
    schema = f"{_HEAD.format(id=kind)}, {_SUMS}, audit string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        graph, ends, _ = automaton()
        now, at, out = None, None, []

        def close():
            cost, state, way = ends[now.table]
            if now.chunk:
                out.append((at, now.chunk, _packed(now.moves), state, *now.sums(cost), way))
            else:
                out.append((at, -1, None, None, *now.sums(cost), edits(now.moves, state)[0] + way))

        for batch in batches:
            for conv_id, turn, initial, fault in zip(*(c.to_pylist() for c in batch.columns)):
                if now is None or conv_id != at:
                    if now is not None:
                        close()
                    now, at = _Run(), conv_id
                if fault != GONE:
                    now.add(graph, turn, initial, fault)
                    if len(now.moves) == held:
                        out.append((at, now.chunk, _packed(now.moves), None, *[None] * 6, None))
                        now.moves, now.chunk = [], now.chunk + 1
            if out:
                yield from _batches(out, batch.schema.field(0).type)
                out = []
            kind = batch.schema.field(0).type
        if now is not None:
            close()
            yield from _batches(out, kind)

    found = freeze(own.mapInArrow(run, schema), "conversation-moves")
    names = ["conv_id", *[c.split()[0] for c in _SUMS.split(", ")], "audit"]
    return found.where("chunk = -1").select(*names).unionAll(_read_off(found.where("chunk >= 0"), schema).select(*names))


def _packed(moves: list[int]) -> bytes:
    return np.array(moves, dtype=np.uint16).tobytes()


def _batches(rows: list[tuple], id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    types = [id_type, pa.int64(), pa.binary(), pa.int32(), *[pa.int64()] * 6, pa.string()]
    names = ["conv_id", "chunk", "moves", "state", *[c.split()[0] for c in _SUMS.split(", ")], "audit"]
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def _read_off(chunks: DataFrame, schema: str) -> DataFrame:
    """Audits of the conversations whose moves went out in chunks, from the last chunk (which has the sums) to the first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, parts, state = None, [], 0
        for batch in batches:
            for new in zip(*(c.to_pylist() for c in batch.columns)):
                if new[3] is not None:
                    row, parts, state = list(new), [new[-1]], new[3]
                part, state = edits(np.frombuffer(new[2], dtype=np.uint16).tolist(), state)
                parts.append(part)
                if new[1] == 0:
                    row[-1] = "".join(reversed(parts))
                    yield from _batches([tuple(row)], batch.schema.field(0).type)

    return chunks.repartition("conv_id").sortWithinPartitions("conv_id", F.col("chunk").desc()).mapInArrow(run, schema)


def repaired_turns(
    turns: DataFrame, repaired: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", gone: str | None = None
) -> DataFrame:
    """The repaired conversations: conv_id, place (from 0), turn (NULL if inserted), role, text, edit, in streams by conversation and place.

    ``repaired`` is what ``repairs`` gives for the same rows.  The audit comes first in its conversation, and the edits
    are taken off it as the rows pass; a conversation without a row left gives one row without a place, so none is lost.
    """
    kind = turns.schema[conv].dataType.simpleString()
    own = _prepared(turns, conv, turn, role, text, F.coalesce(F.col(gone), F.lit(False)) if gone else F.lit(False)).where(~F.col("gone"))
    rows = own.select("conv_id", F.lit(1).alias("kind"), F.col("turn").cast("long").alias("turn"), "role", "text", F.sha2(F.col("text"), 256).alias("said"))
    heads = repaired.select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.col("audit").alias("text"), F.lit("").alias("said"))
    both = rows.unionAll(heads).repartition("conv_id").sortWithinPartitions("conv_id", "kind", *_ordered("said"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        audit, at, place, state, conv_id, out = "", 0, 0, START, None, []

        def insert():
            nonlocal at, place, state
            while audit[at : at + 1] == INSERT:
                initial = _OUT[state]
                out.append((conv_id, place, None, ROLE[initial], "", INSERT))
                at, place, state = at + 1, place + 1, _NEXT[state, initial]

        def close():
            insert()
            if place == 0:
                out.append((conv_id, None, None, None, None, None))

        begun = False
        for batch in batches:
            for new, head, turn, role, text in zip(*(batch.column(k).to_pylist() for k in range(5))):
                if head == 0:
                    if begun:
                        close()
                    audit, at, place, state, conv_id, begun = text, 0, 0, START, new, True
                    continue
                insert()
                edit, at = audit[at], at + 1
                if edit != DELETE:
                    role = ROLE[_OUT[state]] if edit == RENAME else role
                    out.append((conv_id, place, turn, role, text, edit))
                    place, state = place + 1, _NEXT[state, role[0]]
            kind = batch.schema.field(0).type
            if out:
                yield _turn_batch(out, kind)
                out = []
        if begun:
            close()
            if out:
                yield _turn_batch(out, kind)

    return both.drop("said").mapInArrow(run, f"conv_id {kind}, place long, turn long, role string, text string, edit string")


def _turn_batch(rows: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
    types = [id_type, pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=["conv_id", "place", "turn", "role", "text", "edit"])


def text_digest(turns: DataFrame) -> DataFrame:
    """conv_id and sha256 of the ``role:text`` lines of ``repaired_turns``, read off its streams in their order."""
    kind = turns.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, begun, made = None, False, hashlib.sha256()
        for batch in batches:
            out = []
            for conv_id, place, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                if begun and not place:
                    out.append((now, made.hexdigest()))
                if not place:
                    now, begun, made = conv_id, True, hashlib.sha256()
                if place is not None:
                    made.update(f"{chr(10) if place else ''}{role}:{text}".encode())
            kind = batch.schema.field(0).type
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], kind), pa.array([r[1] for r in out])], names=["conv_id", "repaired_sha256"])
        if begun:
            yield pa.RecordBatch.from_arrays([pa.array([now], kind), pa.array([made.hexdigest()])], names=["conv_id", "repaired_sha256"])

    return turns.select("conv_id", "place", "role", "text").mapInArrow(run, f"conv_id {kind}, repaired_sha256 string")


def damaged(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows with planted faults, by crc32 of ``conv:turn`` modulo 20: 0 gone, 1 empty, 2 without ``.!?``, 3 twice, 4 said by user.

    Columns conv_id, turn, role, text, gone.  NULL is one space in the key, the role and the text.
    """
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(blank(conv), F.lit(":"), blank(turn)).cast("binary")) % 20
    own = turns.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), blank(role).alias("role"), blank(text).alias("text"), kind.alias("kind"))
    own = own.withColumn("copy", F.explode(F.sequence(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1))))
    said = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return own.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), said.alias("text"), (F.col("kind") == 0).alias("gone"))


def repair_report(conversations: DataFrame) -> DataFrame:
    """Faults, cheapest edits and digest of the repaired text of every conversation, after planted faults."""
    turns = damaged(conversations)
    found = freeze(repairs(turns, gone="gone"), "conversation-repairs")
    digest = text_digest(repaired_turns(turns, found, gone="gone")).toDF("again", "repaired_sha256")
    return found.join(digest, F.col("conv_id").eqNullSafe(F.col("again"))).drop("again")
