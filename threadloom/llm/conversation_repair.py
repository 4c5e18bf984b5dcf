"""Cheapest repair of a conversation's structure, by Knuth's lightest derivations.

A conversation is well formed if the initials of its roles read ``s?(ua)+`` or if nothing is left of it. Every row may be
kept, given another role or deleted, and an empty row inserted anywhere; ``edits`` has the costs. Among the cheapest edits
those count whose initials (D, I, K, R), in order, are the least text in ASCII.

**Deductions.** An item ``[i, state, k]`` says: rows 0 to i - 1 are edited, the roles that are left lead to ``state``, and k rows
were inserted since the last of them. Its value is (cost, audit). An edit of row i is an axiom with a cost and a letter, and with an
item it deduces ``[i + 1, .., 0]``; an insertion deduces ``[i, .., k + 1]``. The value of what is deduced is (sum of the costs,
audits joined), which is *superior*: never less than the values it comes from, and *monotone*: audits of one item all
hold i letters of rows and end in the same number of inserted ones, so none is the beginning of another and what is appended can't
turn their order. So the agenda pops items by (cost, audit), the first value popped for an item is its least, and the work ends
when the goal is popped. A third insertion in a row only comes back to the state after the first, at a higher cost, and is not made.

**Scale.** Rows are dealt by ranges of (conversation, turn, role, text hash, place in the input) and not by conversation, so a conversation
with a third of all rows is spread over many tasks. Tasks read their rows in order and cut them into blocks of bounded rows and
bytes. A conversation that lies in one block is repaired there. The others (the first and last of a task, and long ones) take four steps: repeated
rows are found by a grouping over the conversation's blocks; for each block the agenda gives the lightest derivation from every state to
every state; one short row for each block passes through a chain that picks the states between the blocks; and each block is
derived once more between its two states. Values of blocks join like those of edits, for the same reason, so the
outcome is that of one agenda over the whole conversation.

Rows of equal turn are taken by role, then by the text's hash; null turns come first. Null roles and texts are one space. Rows without an id are
one conversation. Very long texts are taken whole, a block by themselves if need be. Repeated rows are duplicates of each other. An empty
table gives an empty result. Columns other than the four are left out first, so their names can't clash.
"""

from __future__ import annotations

import hashlib
import heapq
import math
from collections.abc import Iterator
from functools import lru_cache
from typing import Any, NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.plans.materialize import store

#: States: nothing yet, after a system row, after a user row, after an assistant row.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
#: State after a role's initial in each state, None where it must not follow.
STEP = {"s": (SYSTEM, None, None, None), "u": (USER, USER, None, USER), "a": (None, None, ASSISTANT, None)}
WELL_FORMED = (EMPTY, ASSISTANT)
DELETE, REROLE, INSERT, TRUNCATED = 2, 1, 5, 5
BLANKS = " \t\n\x0b\x0c\r"
BLOCK_ROWS = 256
BLOCK_BYTES = 4 << 20
PART_BYTES = 16 << 20
COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
Value = tuple[int, str]


def next_role(state: int) -> str:
    """The role that an inserted or renamed row takes."""
    return "assistant" if state == USER else "user"


@lru_cache(maxsize=64)
def edits(kind: str) -> list[tuple[int, str, str | None]]:
    """Cost, letter and role initial (None: deleted) of the edits of a row.

    Kinds: ``d`` must go; else the role's initial, or x for others, upper case if the text is truncated.
    """
    if kind == "d":
        return [(DELETE, "D", None)]
    more = TRUNCATED if kind.isupper() else 0
    kept = [(more, "K", kind.lower())] if kind.lower() in STEP else []
    return [(DELETE, "D", None), *kept, (REROLE + more, "R", "u"), (REROLE + more, "R", "a")]


def lightest(kinds: str, start: int = EMPTY, between: bool = False) -> dict[int | None, Value]:
    """Values of the goal (key None), or ``between`` blocks of the items that end a block (key: state).

    Agenda of Knuth's generalisation of Dijkstra's algorithm, see the module's text.
    """
    rows = len(kinds)
    agenda: list[tuple[int, str, tuple[int, int | None, int]]] = [(0, "", (0, start, 0))]
    final: set[tuple[int, int | None, int]] = set()
    found: dict[int | None, Value] = {}
    while agenda:
        cost, audit, item = heapq.heappop(agenda)
        if item in final:
            continue
        final.add(item)
        i, state, inserted = item
        if state is None:
            return {None: (cost, audit)}
        if i == rows and between:
            found[state] = (cost, audit)
            continue
        if i == rows and state in WELL_FORMED:
            heapq.heappush(agenda, (cost, audit, (rows, None, 0)))
        if inserted < 2:
            then = STEP[next_role(state)[0]][state]
            heapq.heappush(agenda, (cost + INSERT, audit + "I", (i, then, inserted + 1)))
        if i < rows:
            for more, letter, initial in edits(kinds[i]):
                then = state if initial is None else STEP[initial][state]
                if then is not None and (i + 1, then, 0) not in final:
                    heapq.heappush(agenda, (cost + more, audit + letter, (i + 1, then, 0)))
    return found


_remembered = lru_cache(maxsize=20_000)(lightest)


def derive(kinds: str, start: int = EMPTY, between: bool = False) -> dict[int | None, Value]:
    """``lightest``; short conversations are much alike, so their derivations are remembered."""
    return (_remembered if len(kinds) <= 24 else lightest)(kinds, start, between)


def ending(state: int) -> Value:
    """What has to be inserted behind the last row."""
    return lightest("", state)[None]


def replay(audit: str, roles: list[str], texts: list[str], state: int = EMPTY) -> list[tuple[str, str]]:
    """The rows that the edits leave."""
    out, rows = [], iter(zip(roles, texts))
    for letter in audit:
        role, text = ("", "") if letter == "I" else next(rows)
        if letter == "D":
            continue
        role = role if letter == "K" else next_role(state)
        out.append((role, text))
        state = STEP[role[0]][state]
    return out


def row_key(role: str, text: str) -> str:
    """The same for rows of equal role and text."""
    name = role.encode()
    return hashlib.sha256(b"%d:" % len(name) + name + text.encode()).hexdigest()


class Judged(NamedTuple):
    """What the rows of a block, or of a whole conversation, say before they are edited."""

    kinds: str
    blank: int
    duplicate: int
    truncated: int
    illegal: int
    first: str | None  # role initials at both ends
    last: str | None
    low: int | None  # turns
    high: int | None
    turns: int  # distinct ones


def judge(roles: list[str], texts: list[str], turns: list[int | None], new: set[str] | None = None) -> Judged:
    """``new``: keys of the rows that no earlier block has; without it there is no earlier block."""
    kinds, counts, seen = [], {"blank": 0, "duplicate": 0, "truncated": 0}, set()
    for role, text in zip(roles, texts):
        key = (role, text) if new is None else row_key(role, text)
        ended = text.rstrip(BLANKS)
        if not ended:
            fault = "blank"
        elif key in seen or (new is not None and key not in new):
            fault = "duplicate"
        elif ended[-1] not in ".!?":
            fault = "truncated"
        else:
            fault = None
        seen.add(key)
        if fault:
            counts[fault] += 1
        kind = role[0] if role and role[0] in STEP else "x"
        kinds.append("d" if fault in ("blank", "duplicate") else kind.upper() if fault else kind)
    initials = [role[:1] for role in roles]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    known = [turn for turn in turns if turn is not None]
    low, high = (known[0], known[-1]) if known else (None, None)
    ends = (initials[0], initials[-1]) if initials else (None, None)
    return Judged("".join(kinds), *counts.values(), illegal, *ends, low, high, len(set(known)))


def gaps(low: int | None, high: int | None, turns: int) -> int:
    return 0 if low is None or high is None else high - low + 1 - turns


# Passes over blocks ------------------------------------------------------------------------------

_LINES = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
_REPAIRED = [*((name, pa.int64()) for name in COUNTS), ("audit", pa.string()), ("repaired", _LINES)]
_ROWS = [("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())), ("turns", pa.list_(pa.int64()))]
_REPAIRED_SQL = ", ".join(f"{name} bigint" for name in COUNTS) + ", audit string, repaired array<struct<role string, text string>>"
_ROWS_SQL = "roles array<string>, texts array<string>, turns array<bigint>"


def _lines(rows: list[tuple[str, str]]) -> list[dict[str, str]]:
    return [{"role": role, "text": text} for role, text in rows]


def _batches(rows: Iterator[tuple[int, dict[str, Any]]], kinds: list[tuple[str, pa.DataType]]) -> Iterator[pa.RecordBatch]:
    """Batches of bounded bytes from (bytes, row)."""
    held, size, schema = [], 0, pa.schema(kinds)
    for weight, row in rows:
        held.append(row)
        size += weight + 200
        if size > BLOCK_BYTES:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _whole(roles: list[str], texts: list[str], turns: list[int | None]) -> dict[str, Any]:
    """The repair of a conversation that lies in one block."""
    j = judge(roles, texts, turns)
    cost, audit = derive(j.kinds)[None]
    values = (gaps(j.low, j.high, j.turns), j.blank, j.duplicate, j.truncated, j.illegal, cost, audit)
    return {**dict(zip([*COUNTS, "audit"], values)), "repaired": _lines(replay(audit, roles, texts))}


def blocks(rows: DataFrame, block_rows: int = BLOCK_ROWS, part_bytes: int = PART_BYTES) -> DataFrame:
    """Sorted rows in blocks; ``whole`` ones are conversations, repaired; the others keep their rows.

    ``part`` and ``block`` number the blocks of all tasks in order. ``rows``: conv_id, turn, role, text, present.
    """
    size = F.sum(32 + F.octet_length("text") + F.octet_length("role"))
    parts = math.ceil((rows.agg(size.alias("n")).first()["n"] or 0) / part_bytes)
    placed = rows.withColumn("_hash", F.xxhash64("text")).withColumn("_row", F.monotonically_increasing_id())
    order = ["conv_id", "turn", "role", "_hash", "_row"]
    dealt = placed.repartitionByRange(max(1, parts), *order).sortWithinPartitions("conv_id", "turn", "role", "_hash", "text")
    kind = rows.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, kinds = TaskContext.get().partitionId(), []

        def cut() -> Iterator[tuple[int, dict[str, Any]]]:
            held: tuple[list, list, list] = ([], [], [])
            conv, begun, number, weight, conversations = None, False, 0, 0, 0

            def block(whole: bool) -> tuple[int, dict[str, Any]]:
                facts = {"conv_id": conv, "part": part, "block": number, "whole": whole}
                kept = _whole(*held) if whole else dict(zip(("roles", "texts", "turns"), held))
                return weight, facts | kept

            for batch in batches:
                if not kinds:
                    names = [("part", pa.int32()), ("block", pa.int64()), ("whole", pa.bool_())]
                    kinds.extend([("conv_id", batch.schema.field(0).type), *names, *_REPAIRED, *_ROWS])
                for row_conv, turn, role, text, present in zip(*(column.to_pylist() for column in batch.columns)):
                    if begun and row_conv != conv:
                        # The first one may have begun in the task before; a cut one lies in several blocks.
                        yield block(whole=conversations > 1 and not split)
                        number, held, weight, begun = number + 1, ([], [], []), 0, False
                    if not begun:
                        conv, begun, split, conversations = row_conv, True, False, conversations + 1
                    if present and held[0] and (len(held[0]) >= block_rows or weight + len(text) > BLOCK_BYTES):
                        split = True
                        yield block(whole=False)
                        number, held, weight = number + 1, ([], [], []), 0
                    if present:
                        for values, value in zip(held, (role, text, turn)):
                            values.append(value)
                        weight += len(role) + len(text)
            if begun:
                yield block(whole=False)  # the next task may go on with it

        found = cut()
        first = next(found, None)
        if first:
            yield from _batches((row for some in ([first], found) for row in some), kinds)

    columns = dealt.select("conv_id", "turn", "role", "text", "present")
    return columns.mapInArrow(run, f"conv_id {kind}, part int, block bigint, whole boolean, {_REPAIRED_SQL}, {_ROWS_SQL}")


_JUDGED = [
    ("kinds", pa.string()),
    *((name, pa.int64()) for name in ("blank", "duplicate", "truncated", "illegal")),
    *((name, pa.string()) for name in ("first", "last")),
    *((name, pa.int64()) for name in ("low", "high", "distinct")),
    ("costs", pa.list_(pa.int64())),
    ("places", pa.list_(pa.int64())),
]
_JUDGED_SQL = "kinds string, blank bigint, duplicate bigint, truncated bigint, illegal bigint, first string, last string, low bigint, high bigint, distinct bigint, costs array<bigint>, places array<bigint>"


def judged_blocks(cut: DataFrame) -> DataFrame:
    """Blocks of conversations that have several, judged, with their lightest derivations between all states.

    ``costs`` has the cost from state p to state q at 4p + q, -1 if there is no way, and ``places``
    there the place of its audit among those from p.
    """
    key = F.sha2(F.concat(F.octet_length("row.roles").cast("string"), F.lit(":"), "row.roles", "row.texts"), 256)
    rows = cut.select("conv_id", "part", "block", F.explode(F.arrays_zip("roles", "texts")).alias("row"))
    firsts = rows.select("conv_id", "part", "block", key.alias("key")).groupBy("conv_id", "key")
    firsts = firsts.agg(F.min(F.struct("part", "block")).alias("at"))
    new = firsts.groupBy("at.part", "at.block").agg(F.collect_list("key").alias("new"))  # at most a block's rows
    kind = cut.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(batch: pa.RecordBatch) -> Iterator[tuple[int, dict[str, Any]]]:
            for row in batch.to_pylist():
                j = judge(row["roles"], row["texts"], row["turns"], set(row.pop("new") or ()))
                costs, places = [], []
                for start in range(4):
                    ends = derive(j.kinds, start, True)
                    order = sorted(audit for _, audit in ends.values())
                    costs += [ends[state][0] if state in ends else -1 for state in range(4)]
                    places += [order.index(ends[state][1]) if state in ends else -1 for state in range(4)]
                facts = dict(zip([name for name, _ in _JUDGED], [*j, costs, places]))
                yield sum(map(len, row["texts"])), row | facts

        for batch in batches:
            kinds = [(field.name, field.type) for field in batch.schema if field.name != "new"]
            yield from _batches(rows(batch), [*kinds, *_JUDGED])

    joined = cut.select("conv_id", "part", "block", "roles", "texts", "turns").join(new, ["part", "block"], "left")
    joined = joined.select("conv_id", "part", "block", "roles", "texts", "turns", "new")
    return joined.mapInArrow(run, f"conv_id {kind}, part int, block bigint, {_ROWS_SQL}, {_JUDGED_SQL}")


class Chain:
    """Picks the states between the blocks of a conversation; keeps four small numbers for each block."""

    def __init__(self) -> None:
        self.best: dict[int, tuple[int, int]] = {EMPTY: (0, 0)}  # state: cost, place of the audit
        self.came: list[tuple[int, int, dict[int, int]]] = []  # part, block, state before
        self.totals = dict.fromkeys(COUNTS, 0)
        self.last: str | None = None
        self.low: int | None = None
        self.high: int | None = None

    def add(self, row: dict[str, Any]) -> None:
        found: dict[int, tuple[int, tuple[int, int], int]] = {}
        for before, (cost, place) in self.best.items():
            for state in range(4):
                at = 4 * before + state
                if row["costs"][at] >= 0:
                    value = (cost + row["costs"][at], (place, row["places"][at]), before)
                    found[state] = min(found.get(state, value), value)
        order = sorted(place for _, place, _ in found.values())
        self.best = {state: (cost, order.index(place)) for state, (cost, place, _) in found.items()}
        self.came.append((row["part"], row["block"], {state: before for state, (_, _, before) in found.items()}))
        for name in ("blank", "duplicate", "truncated", "illegal"):
            self.totals[name] += row[name]
        if row["first"] is not None:
            if self.last is not None and self.last + row["first"] not in ("su", "ua", "au"):
                self.totals["illegal"] += 1
            self.last = row["last"]
        if row["low"] is not None:
            self.totals["gaps"] -= row["distinct"] - (self.high == row["low"])  # a turn may go on from block to block
            self.low = row["low"] if self.low is None else self.low
            self.high = row["high"]

    def picked(self) -> Iterator[dict[str, Any]]:
        """For each block the states around it; the last row has the sums and what is to be appended."""
        value, state = min((cost + ending(q)[0], place, q) for q, (cost, place) in self.best.items())[::2]
        self.totals["cost"] = value
        if self.low is not None:
            self.totals["gaps"] += self.high - self.low + 1
        rows: list[dict[str, Any]] = []
        closing: dict[str, Any] = {"sums": self.totals, "close": True}
        for part, block, before in reversed(self.came):
            rows.append({"part": part, "block": block, "enter": before[state], "leave": state, **closing})
            closing, state = {"sums": None, "close": False}, before[state]
        return reversed(rows)


def _by_conversation(df: DataFrame) -> DataFrame:
    """One row for each block, in order; a conversation's blocks next to each other in one task."""
    return df.repartition("conv_id").sortWithinPartitions("conv_id", "part", "block")


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, dict[str, Any]]]:
    """Rows, each with whether another conversation begins."""
    before, begun = None, False
    for batch in batches:
        for row in batch.to_pylist():
            yield not begun or row["conv_id"] != before, row
            before, begun = row["conv_id"], True


_SUMS = pa.struct([(name, pa.int64()) for name in COUNTS])
_SUMS_SQL = "struct<" + ", ".join(f"{name}: bigint" for name in COUNTS) + ">"


def chained(judged: DataFrame) -> DataFrame:
    """``part``, ``block``, the states ``enter`` and ``leave``; ``close`` and ``sums`` with a conversation's last block."""
    kinds = [("part", pa.int32()), ("block", pa.int64()), ("enter", pa.int32()), ("leave", pa.int32()), ("close", pa.bool_()), ("sums", _SUMS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple[int, dict[str, Any]]]:
            chain = None
            for new, row in _conversations(batches):
                if new:
                    if chain:
                        yield from ((0, picked) for picked in chain.picked())
                    chain = Chain()
                chain.add(row)
            if chain:
                yield from ((0, picked) for picked in chain.picked())

        yield from _batches(rows(), kinds)

    short = judged.drop("roles", "texts", "turns", "kinds")
    return _by_conversation(short).mapInArrow(run, f"part int, block bigint, enter int, leave int, close boolean, sums {_SUMS_SQL}")


def derived(judged: DataFrame, chain: DataFrame) -> DataFrame:
    """The blocks' edits (``audit``) and what they leave (``repaired``), between the states that the chain picked."""
    kind = judged.schema["conv_id"].dataType.simpleString()
    made = [("audit", pa.string()), ("repaired", _LINES), ("sums", _SUMS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(batch: pa.RecordBatch) -> Iterator[tuple[int, dict[str, Any]]]:
            for row in batch.to_pylist():
                audit = derive(row["kinds"], row["enter"], True)[row["leave"]][1]
                audit += ending(row["leave"])[1] if row["close"] else ""
                lines = replay(audit, row["roles"], row["texts"], row["enter"])
                kept = {name: row[name] for name in ("conv_id", "part", "block", "sums")}
                yield sum(map(len, row["texts"])), kept | {"audit": audit, "repaired": _lines(lines)}

        for batch in batches:
            kinds = [(name, batch.schema.field(name).type) for name in ("conv_id", "part", "block")]
            yield from _batches(rows(batch), [*kinds, *made])

    schema = f"conv_id {kind}, part int, block bigint, audit string, repaired array<struct<role string, text string>>, sums {_SUMS_SQL}"
    return judged.join(chain, ["part", "block"]).mapInArrow(run, schema)


class Repair(NamedTuple):
    """``whole``: a repaired conversation in each row. ``pieces``: blocks of the others, the last of a conversation with ``sums``."""

    whole: DataFrame
    pieces: DataFrame


def repair_conversations(
    rows: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    present: Column | None = None,
    block_rows: int = BLOCK_ROWS,
    part_bytes: int = PART_BYTES,
) -> Repair:
    """Repair every conversation of ``rows``.

    Rows for which ``present`` is false only name a conversation; one without other rows has no rows left.
    """
    named = rows.select(
        F.col(f"`{conv_id}`").alias("conv_id"),
        F.col(f"`{turn}`").cast("bigint").alias("turn"),
        *(F.coalesce(F.col(f"`{given}`"), F.lit(" ")).alias(name) for name, given in (("role", role), ("text", text))),
        (F.lit(True) if present is None else present).alias("present"),
    )
    cut = store(blocks(named, block_rows, part_bytes), "conversation-blocks").table
    whole = cut.where("whole").select("conv_id", *COUNTS, "audit", "repaired")
    judged = store(judged_blocks(cut.where("not whole")), "judged-blocks").table
    return Repair(whole, derived(judged, chained(judged)))


def repaired_rows(repair: Repair) -> DataFrame:
    """``conv_id``, ``part``, ``block``, ``position`` (together in order), ``role``, ``text`` of what is left."""
    whole = repair.whole.select("conv_id", F.lit(0).alias("part"), F.lit(0).cast("bigint").alias("block"), "repaired")
    every = whole.unionByName(repair.pieces.select("conv_id", "part", "block", "repaired"))
    return every.select("conv_id", "part", "block", F.posexplode("repaired").alias("position", "line")).select(
        "conv_id", "part", "block", "position", "line.role", "line.text"
    )


def digests(repair: Repair) -> DataFrame:
    """``conv_id``, the counts, ``audit`` and the sha256 of the repaired ``role:text`` lines.

    The hash of a conversation in pieces is taken as they pass in order, without holding them.
    """
    lines = F.transform("repaired", lambda line: F.concat(line["role"], F.lit(":"), line["text"]))
    whole = repair.whole.select(
        "conv_id", *COUNTS, "audit", F.sha2(F.array_join(lines, "\n"), 256).alias("repaired_sha256")
    )
    kind = repair.pieces.schema["conv_id"].dataType.simpleString()
    made = [*((name, pa.int64()) for name in COUNTS), ("audit", pa.string()), ("repaired_sha256", pa.string())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = []

        def watched() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not types:
                    types.append(("conv_id", batch.schema.field("conv_id").type))
                yield batch

        def rows() -> Iterator[tuple[int, dict[str, Any]]]:
            audit, digest, any_line = [], hashlib.sha256(), False
            for new, row in _conversations(watched()):
                if new:
                    audit, digest, any_line = [], hashlib.sha256(), False
                audit.append(row["audit"])
                for line in row["repaired"]:
                    digest.update((("\n" if any_line else "") + line["role"] + ":" + line["text"]).encode())
                    any_line = True
                if row["sums"] is not None:
                    facts = {"conv_id": row["conv_id"], "audit": "".join(audit), "repaired_sha256": digest.hexdigest()}
                    yield len(facts["audit"]), facts | row["sums"]

        found = rows()
        first = next(found, None)
        if first:
            yield from _batches((row for some in ([first], found) for row in some), [*types, *made])

    names = ", ".join(f"{name} bigint" for name in COUNTS)
    pieces = _by_conversation(repair.pieces).mapInArrow(run, f"conv_id {kind}, {names}, audit string, repaired_sha256 string")
    return whole.unionByName(pieces)


def damage(rows: DataFrame) -> DataFrame:
    """Faults put into conversations by a hash of ``conv_id:turn``; dropped rows stay with ``present`` false."""

    def text_of(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.pmod(F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn"))), F.lit(20))
    given = rows.select("conv_id", "turn", text_of("role").alias("role"), text_of("text").alias("text"), kind.alias("kind"))
    cut = F.regexp_replace("text", r"[.!?]", "")
    made = given.select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, "user").when(F.col("kind") == 0, "").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind").isin(0, 1), "").when(F.col("kind") == 2, cut).otherwise(F.col("text")).alias("text"),
        (F.col("kind") != 0).alias("present"),
        F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1))).alias("copy"),
    )
    return made.drop("copy")
