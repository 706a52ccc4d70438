"""Repair of conversation structure: turns aligned to the alternating grammar ``(s?(ua)+)?`` at the least cost.

Damage, faults and order are column expressions and aggregations. Rows of a conversation are sorted by ranges, so that a long conversation
spans many tasks, and cut into blocks of ``BLOCK`` rows. A block is aligned by Wagner and Fischer's tables to each string that the
grammar allows from one state to another, nearest lengths first: cells outside Ukkonen's band of the incumbent
cost cannot lead to a better edit and are left out. Of the alignments of least cost, backtracing takes the one with the ASCII-least
audit, and audits of different lengths are compared. An alignment of a block ends with one of its rows (inserts belong
to the row after them), so no audit is the start of another one, and the best edit of a conversation is the best chain of its blocks'
edits, whose sixteen costs and ranks are all that is passed on: within a conversation's part of a task first, then over the parts.
What follows the last row are the inserts that complete the grammar. So blocks bound the work, not the conversation.

Texts are not moved until the end, where they stream past their edits, ordered by conversation, into digests. The digest of a
conversation has to see its text in order, so this last pass over a conversation is one task; it holds one row at a time.

Nulls: a null role or text is one space, as is a null conversation or turn in the damage key; rows without a conversation are one
conversation, of id null. Null turns come first. Rows that share a turn are ordered by role, then by a digest of the text; equal rows
are each other's duplicates. Conversations without rows after the damage have zeros. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache, reduce
from operator import and_

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidefold.llm.common import reachable, written

BLOCK = 32
# The spaces, and what ends a sentence.
SPACES = " \t\n\x0b\x0c\r"
SENTENCE_ENDS = ".!?"

INSERT, REROLE, DELETE, TRUNCATED = 2, 2, 3, 1
# States of the grammar by what stands last: nothing, system, user, assistant. Their targets, and what completes each.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
_INITIALS = "?sua"
_AFTER = ({SYSTEM, USER}, {USER}, {ASSISTANT}, {USER})
CLOSING = ("", "II", "I", "")
_FAR = 1 << 40

# A row as the alignment sees it: the initial of its role, in upper case if it is truncated, or that it has to go.
GONE = "-"

Table = dict[int, tuple[int, str]]


def targets(entry: int, length: int) -> list[str]:
    """Strings of so many initials that the grammar allows after ``entry``."""
    found = [[]]
    for _ in range(length):
        found = [[*t, nxt] for t in found for nxt in sorted(_AFTER[t[-1] if t else entry])]
    return ["".join(_INITIALS[x] for x in t) for t in found]


def _distance(more: int) -> int:
    """Least cost of ending up with so many more, or fewer, target letters than rows."""
    return INSERT * more if more > 0 else -DELETE * more


@lru_cache(maxsize=1 << 14)
def align(rows: str, entry: int) -> Table:
    """The cheapest edits of a block from a state to each that it can lead to: cost and audit, ties ASCII-least."""
    best: Table = {}
    kept = len(rows) - rows.count(GONE)
    # Nearest lengths first, so that incumbents are good early. More than one insert before a row is never cheaper.
    for length in sorted(range(2 * len(rows) + 1), key=lambda n: abs(n - kept)):
        for target in targets(entry, length):
            last = _INITIALS.index(target[-1]) if target else entry
            found = _aligned(rows, target, best[last][0] if last in best else _FAR)
            if found and (last not in best or found < best[last]):
                best[last] = found
    return best


def _aligned(rows: str, target: str, most: int) -> tuple[int, str] | None:
    """Cost and least audit of turning the rows into the target, if not above ``most``; the last edit is one of a row's."""
    n, m = len(rows), len(target)
    # Rows that have to go are deleted in any case, and are no part of the difference in length.
    gone = np.cumsum([0, *(r == GONE for r in rows)]).tolist()
    left = [(n - i) - (gone[n] - gone[i]) for i in range(n + 1)]

    def least(i: int, j: int) -> int:
        return _distance(j - (left[0] - left[i])) + _distance((m - j) - left[i]) + DELETE * gone[n]

    if least(0, 0) > most:
        return None
    cost = [[_FAR] * (m + 1) for _ in range(n + 1)]
    cost[n][m] = 0
    for i in range(n - 1, -1, -1):
        here, after, row = cost[i], cost[i + 1], rows[i]
        for j in range(m, -1, -1):
            if least(i, j) > most:
                continue
            value = DELETE + after[j]
            if j < m:
                # No system turn is made up, by insert or by rerole.
                if target[j] != "s":
                    value = min(value, INSERT + here[j + 1])
                if row != GONE:
                    value = min(value, _match(row, target[j]) + after[j + 1])
            here[j] = value
    if cost[0][0] > most or cost[0][0] >= _FAR:
        return None
    audit, i, j = [], 0, 0
    while i < n:
        rest, row = cost[i][j], rows[i]
        if rest == DELETE + cost[i + 1][j]:
            audit.append("D")
            i += 1
        elif j < m and target[j] != "s" and rest == INSERT + cost[i][j + 1]:
            audit.append("I")
            j += 1
        else:
            audit.append("K" if row.lower() == target[j] else "R")
            i, j = i + 1, j + 1
    return cost[0][0], "".join(audit)


def _match(row: str, letter: str) -> int:
    cost = TRUNCATED if row.isupper() else 0
    if row.lower() == letter:
        return cost
    return cost + REROLE if letter != "s" else _FAR


def ranked(found: Table) -> dict[int, tuple[int, int]]:
    """Cost and rank of the audit among those from the same state."""
    order = sorted(found, key=lambda x: found[x][1])
    return {x: (found[x][0], order.index(x)) for x in found}


def chained(links: list[np.ndarray], entry: int) -> tuple[dict[int, tuple[int, int]], list[dict[int, int]]]:
    """Cost and rank of the best way through the links to each state, and for each link from where it is entered."""
    state, back = {entry: (0, 0)}, []
    for link in links:
        ways: dict[int, tuple[int, int, int, int]] = {}
        for at, (cost, rank) in state.items():
            for to in STATES:
                if link[at, to, 0] < _FAR:
                    way = (cost + int(link[at, to, 0]), rank, int(link[at, to, 1]), at)
                    ways[to] = min(ways.get(to, way), way)
        order = sorted(ways, key=lambda x: ways[x][1:3])
        state = {to: (way[0], order.index(to)) for to, way in ways.items()}
        back.append({to: way[3] for to, way in ways.items()})
    return state, back


def closed(state: dict[int, tuple[int, int]]) -> int:
    """The state in which the best edit of a whole conversation leaves its last row."""
    return min(state, key=lambda x: (state[x][0] + INSERT * len(CLOSING[x]), state[x][1]))


def _packed(state: list[dict[int, tuple[int, int]]]) -> list[int]:
    out = np.full((4, 4, 2), _FAR, np.int64)
    for at, ways in enumerate(state):
        for to, way in ways.items():
            out[at, to] = way
    return out.ravel().tolist()


def _unpacked(costs) -> np.ndarray:
    return np.asarray(costs, np.int64).reshape(4, 4, 2)


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows after the damage: conv (id), none (no id), turn, role, text, n (how often the row stands there)."""

    def shown(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn"))) % 20
    text, role = shown("text"), shown("role")
    marks = F.regexp_replace(text, f"[{SENTENCE_ENDS}]", "")
    return conversations.where(kind != 0).select(
        F.coalesce(F.col("conv_id").cast("long"), F.lit(0)).alias("conv"), F.col("conv_id").isNull().alias("none"),
        F.col("turn").cast("long").alias("turn"), F.when(kind == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, marks).otherwise(text).alias("text"), F.when(kind == 3, 2).otherwise(1).alias("n"),
    )


_CONVERSATION = ["conv", "none"]
# Null turns come first, as they do in ascending order.
_PLACE = ["turn", "role", "tag"]


def rows_of(rows: DataFrame) -> DataFrame:
    """One row per row after the damage, without texts: conv, none, turn, role, tag (digest of the text), copy, code."""
    last = F.right(F.rtrim(F.col("text"), F.lit(SPACES)), F.lit(1)).alias("last")
    tag = F.unhex(F.md5("text")).alias("tag")
    alike = [*_CONVERSATION, "turn", "role", "tag"]
    light = rows.select(*_CONVERSATION, "turn", "role", tag, last, "n").groupBy(*alike, "last").agg(F.sum("n").alias("n"))
    light = written(light, "rows")
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    # Where a role and text appear first. All five together are a key of both sides, so no row of the join is hot.
    first = light.groupBy(*_CONVERSATION, "role", "tag").agg(F.min(place)["turn"].alias("turn"))
    first = first.select(*(F.col(c).alias(f"f_{c}") for c in alike))
    same = [F.col(c).eqNullSafe(F.col(f"f_{c}")) if c == "turn" else F.col(c) == F.col(f"f_{c}") for c in alike]
    met = light.join(first, reduce(and_, same), "left").withColumn("first", F.col("f_conv").isNotNull())
    marked = met.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))
    initial = F.substring("role", 1, 1)
    letter = F.when(initial.isin("s", "u", "a"), initial).otherwise(F.lit("x"))
    truncated = ~F.col("last").isin(*SENTENCE_ENDS)
    fault = F.when(F.col("last") == "", "b").when(~F.col("first") | (F.col("copy") > 1), "d").when(truncated, "t").otherwise("-")
    return marked.select(*alike, "copy", fault.alias("fault"), letter.alias("letter"))


_ROW = {"turn": pa.int64(), "role": pa.string(), "tag": pa.binary(), "copy": pa.int32(), "fault": pa.string()}
_BLOCK = (
    "conv long, none boolean, part int, block long, alone boolean, codes string, "
    "turn array<long>, role array<string>, tag array<binary>, copy array<int>, fault array<string>"
)


def blocks_of(rows: DataFrame, size: int = BLOCK) -> DataFrame:
    """Rows in order, ``size`` to a block. A block that is all of a conversation, as far as its task can tell, is ``alone``."""
    reachable(rows.sparkSession)

    def cut(table: pa.Table, starts: np.ndarray, alone: np.ndarray, number: int) -> pa.RecordBatch:
        """The blocks from the first ``starts`` to the last, which is where the last one ends."""
        at = pa.array(starts.astype(np.int32))
        part = np.full(len(alone), TaskContext.get().partitionId(), np.int32)
        every = {
            "conv": table["conv"].take(at[:-1]), "none": table["none"].take(at[:-1]), "part": pa.array(part),
            "block": pa.array(number + np.arange(len(alone))), "alone": pa.array(alone),
            "codes": pa.StringArray.from_buffers(len(alone), at.buffers()[1], pa.py_buffer(_codes(table))),
        }
        lists = {c: pa.ListArray.from_arrays(at, _array(table[c]).cast(t)) for c, t in _ROW.items()}
        arrays = [_array(x) if isinstance(x, pa.ChunkedArray) else x for x in (every | lists).values()]
        return pa.RecordBatch.from_arrays(arrays, [*every, *lists])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # What is held back is a block that may go on. The first conversation of a task may have begun in another one.
        held, begun, number = None, True, 0
        for batch in batches:
            table = pa.Table.from_batches([batch] if held is None else [*held.to_batches(), batch])
            conv, none = table["conv"].to_numpy(), table["none"].to_numpy()
            begin = np.concatenate(([0], np.flatnonzero((np.diff(conv) != 0) | (none[1:] != none[:-1])) + 1))
            length = np.diff(np.append(begin, len(conv)))
            counts = -(-length // size)
            starts = np.repeat(begin - (np.cumsum(counts) - counts) * size, counts) + np.arange(counts.sum()) * size
            alone = np.repeat(counts == 1, counts)
            if begun:
                alone[: counts[0]] = False
            if len(starts) > 1:
                yield cut(table, starts, alone[:-1], number)
            number += len(starts) - 1
            held, begun = table.slice(int(starts[-1])), bool(counts[-1] > 1 or (begun and len(counts) == 1))
        if held is not None:
            yield cut(held, np.array([0, held.num_rows]), np.array([False]), number)

    order = [*_CONVERSATION, *_PLACE, "copy"]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return dealt.mapInArrow(run, _BLOCK)


def _array(column: pa.ChunkedArray) -> pa.Array:
    return pa.concat_arrays(column.chunks)


def _codes(table: pa.Table) -> bytes:
    gone, cut = (np.isin(table["fault"].to_numpy(), x) for x in (["b", "d"], ["t"]))
    letters = np.array(table["letter"].to_pylist(), "S1").view(np.uint8)
    return np.where(gone, ord(GONE), np.where(cut, letters - 32, letters)).astype(np.uint8).tobytes()


def _ways(blocks: DataFrame) -> DataFrame:
    """Entry and exit of each block that is not alone: conv, none, part, block, entry, exit."""

    def cost(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            costs = [_packed([ranked(align(codes, entry)) for entry in STATES]) for codes in frame["codes"]]
            yield frame.drop(columns="codes").assign(costs=costs)

    def over(frame: pd.DataFrame) -> list[np.ndarray]:
        return [_unpacked(c) for c in frame["costs"]]

    def part(frame: pd.DataFrame) -> pd.DataFrame:
        links = over(frame.sort_values("block"))
        costs = _packed([chained(links, entry)[0] for entry in STATES])
        return frame.iloc[:1].drop(columns=["block", "costs"]).assign(costs=[costs])

    def entered(frame: pd.DataFrame, entry: int, last: int | None) -> pd.DataFrame:
        state, back = chained(over(frame), entry)
        at = closed(state) if last is None else last
        exits = []
        for step in reversed(back):
            exits.append(at)
            at = step[at]
        exits.reverse()
        return frame.drop(columns="costs").assign(entry=[entry, *exits[:-1]], exit=exits)

    def whole(frame: pd.DataFrame) -> pd.DataFrame:
        return entered(frame.sort_values("part"), START, None)

    def within(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("block")
        entry, last = int(frame["entry"].iloc[0]), int(frame["exit"].iloc[0])
        return entered(frame.drop(columns=["entry", "exit"]), entry, last)

    key = "conv long, none boolean, part int"
    picked = blocks.where("NOT alone").select(*_CONVERSATION, "part", "block", "codes")
    costs = written(picked.mapInPandas(cost, f"{key}, block long, costs array<long>"), "costs")
    parts = written(costs.groupBy(*_CONVERSATION, "part").applyInPandas(part, f"{key}, costs array<long>"), "parts")
    through = written(parts.groupBy(*_CONVERSATION).applyInPandas(whole, f"{key}, entry int, exit int"), "through")
    inner = costs.join(through, [*_CONVERSATION, "part"])
    return inner.groupBy(*_CONVERSATION, "part").applyInPandas(within, f"{key}, block long, entry int, exit int")


# What the last pass reads of a conversation, in this order: that it is there, its rows' edits each before its text, its closing.
_HEAD, _EDIT, _TEXT = range(3)
_EVENT = "conv long, none boolean, stage int, turn long, role string, tag binary, copy int, kind int, edit string, fault string, text string"


def edits_of(blocks: DataFrame, ways: DataFrame) -> DataFrame:
    """For each row the inserts before it and what happens to it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            entries, exits, alone, codes = (batch.column(c).to_pylist() for c in ("entry", "exit", "alone", "codes"))
            edits: list[str] = []
            for entry, last, whole, rows in zip(entries, exits, alone, codes, strict=True):
                found = align(rows, START if whole else entry)
                audit = found[closed(ranked(found)) if whole else last][1]
                edits += audit.replace("D", "D ").replace("K", "K ").replace("R", "R ").split()
            lists = {c: batch.column(c) for c in _ROW}
            rows_of_block = pa.array(np.repeat(np.arange(batch.num_rows), [len(c) for c in codes]))
            n = len(rows_of_block)
            every = {c: batch.column(c).take(rows_of_block) for c in ("conv", "none")} | {c: x.flatten() for c, x in lists.items()}
            every |= {
                "stage": pa.array(np.ones(n, np.int32)), "kind": pa.array(np.full(n, _EDIT, np.int32)),
                "edit": pa.array(edits, pa.string()), "text": pa.nulls(n, pa.string()),
            }
            names = [c.split()[0] for c in _EVENT.split(", ")]
            yield pa.RecordBatch.from_arrays([every[c] for c in names], names)

    alone = blocks.where("alone").withColumns({"entry": F.lit(None).cast("int"), "exit": F.lit(None).cast("int")})
    chained_ = blocks.where("NOT alone").join(ways, [*_CONVERSATION, "part", "block"]).select(*alone.columns)
    return alone.unionAll(chained_).drop("part", "block").mapInArrow(run, _EVENT)


_RESULT = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
    "repaired_sha256 string, repaired_bytes long"
)


class _Conversation:
    """What one conversation comes to, row by row."""

    def __init__(self, conv: int, none: bool) -> None:
        self.key, self.conv = (conv, none), None if none else conv
        self.turns, self.first, self.last, self.seen = 0, None, None, None
        self.faults = {"b": 0, "d": 0, "t": 0}
        self.illegal = self.cost = 0
        self.audit: list[str] = []
        self.digest, self.bytes = hashlib.sha256(), 0
        self.at, self.waiting = START, None

    def line(self, role: str, text: str) -> None:
        data = f"{role}:{text}".encode()
        if self.bytes:
            data = b"\n" + data
        self.digest.update(data)
        self.bytes += len(data)
        self.at = {"u": USER, "a": ASSISTANT, "s": SYSTEM}[role[0]]

    def insert(self) -> None:
        self.cost += INSERT
        self.audit.append("I")
        self.line("assistant" if self.at == USER else "user", "")

    def edit(self, turn: int | None, role: str, edit: str, fault: str) -> None:
        self.waiting = None
        if turn is not None:
            self.turns += self.last != turn
            self.first, self.last = turn if self.first is None else self.first, turn
        if self.seen is not None:
            self.illegal += self.seen + role[:1] not in ("su", "ua", "au")
        self.seen = role[:1]
        if fault != "-":
            self.faults[fault] += 1
        for letter in edit:
            if letter == "I":
                self.insert()
                continue
            self.audit.append(letter)
            if letter == "D":
                self.cost += DELETE
                continue
            self.cost += (fault == "t") * TRUNCATED + (letter == "R") * REROLE
            self.waiting = role if letter == "K" else "assistant" if self.at == USER else "user"

    def text(self, text: str) -> None:
        # Rows that are equal share an edit; the first brings the text.
        if self.waiting is not None:
            self.line(self.waiting, text)
        self.waiting = None

    def row(self) -> tuple:
        for _ in CLOSING[self.at]:
            self.insert()
        gaps = self.last - self.first + 1 - self.turns if self.turns else 0
        return (self.conv, gaps, *self.faults.values(), self.illegal, self.cost, "".join(self.audit), self.digest.hexdigest(), self.bytes)


def _results(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64()] * 7 + [pa.string()] * 2 + [pa.int64()]
    names = [c.split()[0] for c in _RESULT.split(", ")]

    def table(found: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*found, strict=True), kinds, strict=True)], names)

    now: _Conversation | None = None
    for batch in batches:
        done = []
        columns = (batch.column(c).to_pylist() for c in ("conv", "none", "turn", "role", "kind", "edit", "fault", "text"))
        for conv, none, turn, role, kind, edit, fault, text in zip(*columns, strict=True):
            if now is None or now.key != (conv, none):
                if now is not None:
                    done.append(now.row())
                now = _Conversation(conv, none)
            if kind == _EDIT:
                now.edit(turn, role, edit, fault)
            elif kind == _TEXT:
                now.text(text)
        if done:
            yield table(done)
    if now is not None:
        yield table([now.row()])


def repair(conversations: DataFrame, size: int = BLOCK) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 and repaired_bytes of each conversation."""
    reachable(conversations.sparkSession)
    rows = damaged(conversations)
    blocks = written(blocks_of(rows_of(rows), size), "blocks")
    edits = edits_of(blocks, written(_ways(blocks), "ways"))
    nothing = {c: F.lit(None).cast(t) for c, t in (f.split() for f in _EVENT.split(", "))}

    def events(df: DataFrame, **own: Column) -> DataFrame:
        every = {**nothing, "conv": F.col("conv"), "none": F.col("none"), **own}
        return df.select(*(every[c.split()[0]].alias(c.split()[0]) for c in _EVENT.split(", ")))

    heads = conversations.select(F.coalesce(F.col("conv_id").cast("long"), F.lit(0)).alias("conv"), F.col("conv_id").isNull().alias("none")).distinct()
    # Texts without a word are deleted in any case and need not travel.
    worded = rows.where(F.rtrim(F.col("text"), F.lit(SPACES)) != "")
    texts = events(
        worded, stage=F.lit(1), turn=F.col("turn"), role=F.col("role"), tag=F.unhex(F.md5("text")), copy=F.lit(1), kind=F.lit(_TEXT), text=F.col("text"),
    )
    together = events(heads, stage=F.lit(0), kind=F.lit(_HEAD)).unionAll(edits).unionAll(texts)
    order = [*_CONVERSATION, "stage", *_PLACE, "copy", "kind"]
    return together.repartition(*_CONVERSATION).sortWithinPartitions(*order).mapInArrow(_results, _RESULT)
