"""Conversations whose turns are damaged, audited and repaired with the least edits.

A conversation should read ``(s?(ua)+)?`` by the initials of its roles: perhaps
a system row, then user and assistant in turn. Rows may be kept (K), given
the role that is due (R), deleted (D), or inserted empty (I). The repair is
found by iterative-deepening A*: a depth-first search tries the edits in the
order D, I, K, R under a cost bound that grows by one until a path fits; the
first is the cheapest, and the least in ASCII order among those. What the rows
left must cost at least (their forced deletions and truncated ends) cuts paths
off, and a table of (row, state) with the budget that failed there spares
searching them again.

How it is spread: rows of equal conversation, turn, role and text are one row
with a count, and the text goes along once per conversation, with its first
row; later ones are duplicates, which are only ever deleted. Rows are sorted by
ranges of (conversation, turn, role, digest of the text), so that a long
conversation lies in many tasks. A task searches its rows in blocks of BLOCK:
for every state at a block's beginning and end, the cheapest edits. A path's
part in a block ends with the edit of its last row, so no part begins with
another and the least parts make the least whole: blocks are put together from
left to right for each state, with a running SHA-256 for each. Conversations
that end where a task's rows end go on as blocks, found edits included; there
only the putting together and the hash, which no split can share, run through
a conversation in one task, block by block.

Defined cases: a null conversation is one of its own; null turns come first and
count neither as turns nor as gaps; null roles and texts are one space; rows of
equal turn are ordered by role, then by the SHA-256 of their text; an initial
is a role's first code point, none for an empty role, which no pattern holds; a
conversation that lost all rows has zeros, an empty audit and the digest of
nothing; an empty table gives no rows.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from hashlib import sha256
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import shuffle_partitions, small_batches
from strata.session import materialize

#: Rows of a block, and characters that end one early.
BLOCK = 32
BLOCK_CHARS = 1 << 20
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: States: nothing yet, after the system row, after a user row, after an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state after a row of the role that is due, and after a kept row by its initial.
DUE = (USER, USER, ASSISTANT, USER)
KEEP = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
#: What ends a conversation at the least cost in each state.
ENDING = ("", "II", "I", "")
LEGAL = {"su", "ua", "au"}
_SPACE = " \t\n\x0b\x0c\r"


class Row(NamedTuple):
    """A row that may stay, after ``forced`` rows that must go. The role is None
    where only those are left."""

    forced: int
    role: str | None
    text: str = ""
    truncated: bool = False


def search(rows: list[Row], start: int, end: int | None) -> tuple[int, str] | None:
    """(cost, edits but for the forced ones) from one state to another, or to an
    accepted end (None), by iterative deepening. Towards a given state nothing
    is inserted after the last row that may stay. None if no edits lead there."""
    free = [r for r in rows if r.role is not None]
    if end is not None and end != start:
        if not free or end == START or end == SYSTEM and start != START:
            return None
        if end == SYSTEM and not any(r.role[:1] == "s" for r in free):
            return None
    n = len(free)
    rest = [0] * (n + 1)                       # no edits of the rows from here on cost less
    for k in range(n - 1, -1, -1):
        rest[k] = rest[k + 1] + TRUNCATED * free[k].truncated
    failed: dict[tuple[int, int], int] = {}    # the largest budget that failed from a row and state
    path: list[str] = []

    def done(state: int) -> bool:
        return state == end if end is not None else not ENDING[state]

    def least(k: int, state: int) -> int:
        return rest[k] if k < n or end is not None else INSERT * len(ENDING[state])

    def moves(k: int, state: int) -> Iterator[tuple[str, int, int, int]]:
        if k == n:
            if end is None:
                yield "I", k, DUE[state], INSERT
            return
        row = free[k]
        yield "D", k + 1, state, DELETE
        yield "I", k, DUE[state], INSERT
        if (kept := KEEP[state].get(row.role[:1])) is not None:
            yield "K", k + 1, kept, TRUNCATED * row.truncated
        yield "R", k + 1, DUE[state], REROLE + TRUNCATED * row.truncated

    def descend(k: int, state: int, budget: int) -> bool:
        if least(k, state) > budget or failed.get((k, state), -1) >= budget:
            return False
        if k == n and done(state):
            return True
        for letter, to, then, cost in moves(k, state):
            path.append(letter)
            if descend(to, then, budget - cost):
                return True
            path.pop()
        failed[k, state] = budget
        return False

    bound = least(0, start)
    while not descend(0, start, bound):
        bound += 1
    return bound, "".join(path)


def spell(rows: list[Row], edits: str) -> str:
    """All edits: the forced deletions of a row stand before its own edits."""
    out, k = ["D" * rows[0].forced if rows else ""], 0
    for letter in edits:
        out.append(letter)
        if letter != "I":
            k += 1
            if k < len(rows):
                out.append("D" * rows[k].forced)
    return "".join(out)


def replay(rows: list[Row], edits: str, state: int) -> Iterator[tuple[str, str]]:
    """Role and text of the rows that the edits leave or put in."""
    k = 0
    for letter in edits:
        due = "assistant" if DUE[state] == ASSISTANT else "user"
        if letter == "K":
            yield rows[k].role, rows[k].text
            state = KEEP[state][rows[k].role[:1]]
        elif letter != "D":
            yield due, rows[k].text if letter == "R" else ""
            state = DUE[state]
        k += letter != "I"


class Facts(NamedTuple):
    """What is counted in rows that follow one another."""

    first: str | None = None                   # initials of the first and last row; None: no rows
    last: str | None = None
    low: int | None = None                     # turns
    high: int | None = None
    turns: int = 0
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0

    def then(self, o: "Facts") -> "Facts":
        if o.first is None:
            return self
        if self.first is None:
            return o
        joined = self.illegal + o.illegal + (self.last + o.first not in LEGAL)
        turns = self.turns + o.turns - (self.high is not None and self.high == o.low)
        return Facts(self.first, o.last, o.low if self.low is None else self.low,
                     self.high if o.high is None else o.high, turns, self.blank + o.blank,
                     self.duplicate + o.duplicate, self.truncated + o.truncated, joined)

    def columns(self) -> tuple[int, ...]:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal


def facts_of(turn: int | None, role: str, copies: int, blank: bool, text: str | None) -> Facts:
    """Facts of ``copies`` equal rows; text: None if an earlier row has it too."""
    c = role[:1]
    cut = text is not None and text.rstrip(_SPACE)[-1] not in ".!?"
    return Facts(c, c, turn, turn, int(turn is not None), copies if blank else 0,
                 0 if blank else copies - (text is not None), int(cut), copies - 1)


class Block(NamedTuple):
    facts: Facts
    rows: list[Row]
    #: (start, end) -> (cost, edits)
    ways: dict[tuple[int, int], tuple[int, str]] | None = None

    def searched(self) -> "Block":
        found = {(p, q): search(self.rows, p, q) for p in range(4) for q in range(4)}
        return self._replace(ways={k: v for k, v in found.items() if v is not None})


class _Path(NamedTuple):
    cost: int
    rank: int                                  # by the edits so far, among the paths held
    edits: tuple | None                        # (edits of the paths before, edits of the block)
    hash: object
    empty: bool


def _hashed(path: _Path, rows: Iterator[tuple[str, str]]) -> tuple[object, bool]:
    out, empty = path.hash.copy(), path.empty
    for role, text in rows:
        out.update(f"{'' if empty else chr(10)}{role}:{text}".encode())
        empty = False
    return out, empty


def put_together(blocks: Iterator[Block]) -> tuple:
    """The contract's columns but for the id, from a conversation's blocks."""
    facts, held, forced = Facts(), {START: _Path(0, 0, None, sha256(), True)}, 0
    for block in blocks:
        facts = facts.then(block.facts)
        forced += sum(r.forced for r in block.rows)
        best: dict[int, tuple] = {}
        for (p, q), (cost, edits) in block.ways.items():
            if p in held:
                way = (held[p].cost + cost, held[p].rank, spell(block.rows, edits), p, edits)
                if q not in best or way < best[q]:
                    best[q] = way
        order = sorted(best, key=lambda q: best[q][1:3])
        held = {q: _Path(best[q][0], order.index(q), (held[best[q][3]].edits, best[q][2]),
                         *_hashed(held[best[q][3]], replay(block.rows, best[q][4], best[q][3]))) for q in best}
    state = min(held, key=lambda q: (held[q].cost + INSERT * len(ENDING[q]), held[q].rank))
    path, parts = held[state], [ENDING[state]]
    link = path.edits
    while link is not None:
        parts.append(link[1])
        link = link[0]
    done, _ = _hashed(path, replay([], ENDING[state], state))
    cost = path.cost + DELETE * forced + INSERT * len(ENDING[state])
    return *facts.columns(), cost, "".join(reversed(parts)), done.hexdigest()


def finish(block: Block) -> tuple:
    """The same from a conversation's only block."""
    cost, edits = search(block.rows, START, None)
    path, empty = _hashed(_Path(0, 0, None, sha256(), True), replay(block.rows, edits, START))
    forced = sum(r.forced for r in block.rows)
    return *block.facts.columns(), cost + DELETE * forced, spell(block.rows, edits), path.hexdigest()


RESULT = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
_RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_PARTS = f"conv_id long, part long, seq long, block binary, {_RESULT}"
#: Blocks of a conversation that a task holds before it lets them go on singly.
HELD = 64


class _Conversation:
    """Rows of one conversation as they come, in blocks."""

    def __init__(self, conv: int | None, loose: bool):
        self.conv, self.loose = conv, loose
        self.blocks: list[Block] = []
        self.seq = 0
        self._start()

    def _start(self) -> None:
        self.facts, self.rows, self.forced, self.chars = Facts(), [], 0, 0

    def add(self, turn, role, copies, blank, text) -> None:
        if not copies:
            return
        facts = facts_of(turn, role, copies, blank, text)
        self.facts = self.facts.then(facts)
        if text is None:
            self.forced += copies
            return
        self.rows.append(Row(self.forced, role, text, bool(facts.truncated)))
        self.forced = copies - 1
        self.chars += len(text)

    def full(self) -> bool:
        return len(self.rows) >= BLOCK or self.chars >= BLOCK_CHARS

    def close(self) -> None:
        """End the block at hand."""
        rows = [*self.rows, Row(self.forced, None)] if self.forced else self.rows
        self.blocks.append(Block(self.facts, rows))
        self._start()

    def loosen(self) -> Iterator[tuple]:
        for b in self.blocks:
            yield self.conv, self.seq, pickle.dumps(b.searched())
            self.seq += 1
        self.blocks, self.loose = [], True

    def result(self) -> tuple:
        return finish(self.blocks[0]) if len(self.blocks) == 1 else put_together(b.searched() for b in self.blocks)


def _batches(rows: Iterator[tuple], kind: str, size: int = 512):
    """Arrow batches of tuples, by a DDL of long, binary and string columns."""
    import pyarrow as pa

    types = {"long": pa.int64(), "binary": pa.binary(), "string": pa.string()}
    schema = pa.schema([(c, types[t]) for c, t in (x.split() for x in kind.split(", "))])
    some: list[tuple] = []

    def batch():
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*some), schema)], schema=schema)

    for row in rows:
        some.append(row)
        if len(some) == size:
            yield batch()
            some = []
    if some:
        yield batch()


def _rows(batches) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*(c.to_pylist() for c in b.columns))


def _audit(batches):
    """Whole conversations of a task's sorted rows; the first and the last, and
    very long ones, as blocks."""
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()

    def out() -> Iterator[tuple]:
        now, first = None, None                # the conversation, and the first row of the texts at hand
        loose = lambda found: ((c, part, seq, b, *[None] * len(RESULT)) for c, seq, b in found)
        for conv, turn, role, h, copies, blank, text in _rows(batches):
            if now is None or conv != now.conv:
                if now is not None:
                    now.close()
                    if now.loose:
                        yield from loose(now.loosen())
                    else:
                        yield now.conv, None, None, None, *now.result()
                now = _Conversation(conv, now is None)
            if text is not None:
                first = (conv, turn, role, h, text)
                continue
            own = first[4] if first is not None and first[:4] == (conv, turn, role, h) else None
            now.add(turn, role, copies, blank, own)
            if now.full():
                now.close()
                if now.loose or len(now.blocks) > HELD:
                    yield from loose(now.loosen())
        if now is not None:
            now.close()
            yield from loose(now.loosen())

    yield from _batches(out(), _PARTS)


def _assemble(batches):
    """Conversations of blocks that come in order."""
    from itertools import groupby

    def out() -> Iterator[tuple]:
        for conv, blocks in groupby(_rows(batches), key=lambda r: r[0]):
            yield conv, *put_together(pickle.loads(r[1]) for r in blocks)

    yield from _batches(out(), f"conv_id long, {_RESULT}")


def repair(rows: DataFrame) -> DataFrame:
    """Audit and repair of conversations (conv_id, turn, role, text, copies: how
    often the row stands there; 0: it doesn't, but its conversation is named).
    One row per conversation: conv_id and RESULT."""
    spark = rows.sparkSession
    small_batches(spark)
    rows = rows.withColumn("h", F.unhex(F.sha2(F.encode("text", "UTF-8"), 256)))
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    counts = rows.groupBy("conv_id", "turn", "role", "h", blank.alias("blank")).agg(F.sum("copies").alias("copies"))
    firsts = rows.where((F.col("copies") > 0) & ~blank).groupBy("conv_id", "role", "text").agg(
        F.max(F.col("turn").isNull()).alias("unnumbered"), F.min("turn").alias("turn"))
    columns = ["conv_id", "turn", "role", "h", "copies", "blank", "text"]
    both = counts.withColumn("text", F.lit(None).cast("string")).select(columns).unionByName(firsts.select(
        "conv_id", F.when(~F.col("unnumbered"), F.col("turn")).alias("turn"), "role",
        F.unhex(F.sha2(F.encode("text", "UTF-8"), 256)).alias("h"), F.lit(None).cast("long").alias("copies"),
        F.lit(False).alias("blank"), "text").select(columns))
    key = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "h"]
    ordered = both.repartitionByRange(shuffle_partitions(spark), *key).sortWithinPartitions(
        *key, F.col("text").isNull())
    found = materialize(ordered.mapInArrow(_audit, _PARTS), "repairs")
    parts = found.where("block is not null").select("conv_id", "block", "part", "seq") \
        .repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "part", "seq")
    return found.where("block is null").select("conv_id", *RESULT).unionByName(
        parts.select("conv_id", "block").mapInArrow(_assemble, f"conv_id long, {_RESULT}"))


def damage(conversations: DataFrame) -> DataFrame:
    """The contract's damage, by the CRC-32 of ``conv_id:turn``: conv_id, turn,
    role, text, and how often the row stands there (0, 1 or 2)."""
    def text(c: Column) -> Column:
        return F.coalesce(c.cast("string"), F.lit(" "))

    conv, turn = F.col("conv_id").cast("long"), F.col("turn").cast("long")
    fault = F.crc32(F.encode(F.concat(text(conv), F.lit(":"), text(turn)), "UTF-8")) % 20
    body = text(F.col("text"))
    return conversations.select(
        conv.alias("conv_id"), turn.alias("turn"),
        F.when(fault == 4, "user").otherwise(text(F.col("role"))).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.translate(body, ".!?", "")).otherwise(body).alias("text"),
        F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).cast("long").alias("copies"))
