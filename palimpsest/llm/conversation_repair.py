"""Repair of the role structure of conversations at the least cost.

A conversation is sound if the initials of its roles read ``(s?(ua)+)?``.  Its rows, in the order of turn (nulls
first), role and text, are edited:

=========  ==========================================================  ====
``K``      keep                                                          0
``R``      make the role user or assistant                               2
``D``      delete; required for blank rows and repeats                   3
``I``      insert an empty row of user or assistant, anywhere            2
=========  ==========================================================  ====

and every truncated row that stays costs 1 more.  A row is *blank* without a character other than white space,
*duplicate* if an earlier row has its role and text, *truncated* if its last such character is none of ``.!?``;
the first that fits counts.  Of the cheapest edits those are made whose letters come first in ASCII.

Method (Four Russians): a row is one of nine symbols, and the costs to go from the four states of the pattern, less
their minimum, are one of few vectors.  For every block of ``BLOCK`` symbols and every vector the vector before the
block is tabulated, so costs run backward by one lookup per block.  The trace then runs forward: a block is
expanded once more, backward from the vector after it, and in each state the least letter that keeps to the cheapest
way is taken; expansions are remembered per block, vector and state.

Long conversations: rows are dealt by ranges of (conversation, turn, role, text) into chunks of bounded size, so a
conversation with a third of all rows lies in many.  Each of its chunks is first summed up as a table from vectors
to vectors and states; these, one row per chunk, are put together, which tells every chunk its vector and state.

Defined cases: a null role or text is one space, so such a text is blank; null turns come first; null ids form one
conversation; rows equal in id, turn, role and text are interchangeable and repeats of each other; roles whose initial
is none of s, u, a can only be re-roled or deleted; an empty table gives empty results; other columns are ignored;
very long texts are read whole, their rows moved twice.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from palimpsest.llm.common import thrifty
from palimpsest.session import stored

BLOCK = 3
#: Rows of a chunk, about.
CHUNK_ROWS = 1 << 20
#: Rows handed over at a time.
OUT_ROWS = 4096
SPACES = " \t\n\x0b\x0c\r"
#: States of the pattern: nothing yet, after s, after u, after a.  Where a role's initial leads from a state.
KEEP = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
#: The one role that may be made or inserted in a state, and where it leads.
NEXT_ROLE = ("user", "user", "assistant", "user")
NEXT_STATE = (2, 2, 3, 2)
#: Inserts that end the conversation in a state.
INSERTS_AT_END = (0, 2, 1, 0)
INITIALS = "sua"
#: 0: must be deleted; else 1 + 2 * role + truncated, with the roles s, u, a, other.
SYMBOLS = 9

Vector = tuple[int, int, int, int]


def _ways(symbol: int, state: int) -> list[tuple[str, int, int]]:
    """Letter, cost and next state of the edits of one row."""
    ways = [("D", 3, state)]
    if symbol:
        role, truncated = divmod(symbol - 1, 2)
        if role < 3 and INITIALS[role] in KEEP[state]:
            ways.append(("K", truncated, KEEP[state][INITIALS[role]]))
        ways.append(("R", 2 + truncated, NEXT_STATE[state]))
    return ways


def _before(symbol: int, after: Vector) -> Vector:
    """Costs to go before a row, given those after it; not normalised."""
    costs = [min(cost + after[to] for _, cost, to in _ways(symbol, state)) for state in range(4)]
    for _ in range(4):  # inserts before the row
        costs = [min(c, costs[NEXT_STATE[state]] + 2) for state, c in enumerate(costs)]
    return tuple(costs)


def _normal(costs: Vector) -> Vector:
    return tuple(c - min(costs) for c in costs)


class Tables:
    """The vectors that occur, from the one at the end (number 0), and what a block makes of them."""

    def __init__(self):
        self.vectors: list[Vector] = [tuple(2 * k for k in INSERTS_AT_END)]
        known = {self.vectors[0]: 0}
        steps: list[list[int]] = []
        for vector in self.vectors:  # grows while it runs
            steps.append([])
            for symbol in range(SYMBOLS):
                found = _normal(_before(symbol, vector))
                if found not in known:
                    known[found] = len(self.vectors)
                    self.vectors.append(found)
                steps[-1].append(known[found])
        self.step = np.array(steps).T  # [symbol, vector after] -> vector before
        table = self.step
        for _ in range(BLOCK - 1):
            # A symbol before a block: its step after the block's.
            table = self.step[:, table].reshape(-1, len(self.vectors))
        self.block = table  # [number of the block in base SYMBOLS, vector after] -> vector before
        self.trace = lru_cache(maxsize=1 << 17)(self._trace)

    def blocks(self, symbols: np.ndarray) -> list[tuple[tuple[int, ...], np.ndarray]]:
        """Whole blocks and the rest as single symbols, each with its row of a table."""
        cut = len(symbols) // BLOCK * BLOCK
        powers = SYMBOLS ** np.arange(BLOCK - 1, -1, -1)
        numbers = symbols[:cut].reshape(-1, BLOCK) @ powers
        whole = [(tuple(s), self.block[k]) for s, k in zip(symbols[:cut].reshape(-1, BLOCK).tolist(), numbers.tolist(), strict=True)]
        return whole + [((s,), self.step[s]) for s in symbols[cut:].tolist()]

    def _trace(self, symbols: tuple[int, ...], after: int, state: int) -> tuple[str, int]:
        """Letters of the cheapest, then least edits of a block from a state, and the state they end in."""
        costs = [self.vectors[after]]
        for symbol in reversed(symbols):
            costs.append(_before(symbol, costs[-1]))
        costs.reverse()
        letters = []
        for k, symbol in enumerate(symbols):
            while True:
                ways = [(letter, to) for letter, cost, to in _ways(symbol, state) if cost + costs[k + 1][to] == costs[k][state]]
                if costs[k][NEXT_STATE[state]] + 2 == costs[k][state]:
                    ways.append(("I", -1))
                letter, to = min(ways)
                letters.append(letter)
                if letter != "I":
                    state = to
                    break
                state = NEXT_STATE[state]
        return "".join(letters), state

    def edits(self, symbols: np.ndarray, after: int, state: int) -> tuple[str, int]:
        """Letters for consecutive rows, given the vector after the last and the state before the first."""
        parts, ends = self.blocks(symbols), []
        for _, table in reversed(parts):
            ends.append(after)
            after = int(table[after])
        letters = []
        for (block, _), end in zip(parts, reversed(ends), strict=True):
            more, state = self.trace(block, end, state)
            letters.append(more)
        return "".join(letters), state

    def summary(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For every vector after the rows, the vector before them and the state that each state ends in."""
        parts, now, ends = self.blocks(symbols), np.arange(len(self.vectors)), []
        for _, table in reversed(parts):
            ends.append(now)
            now = table[now]
        states = np.tile(np.arange(4), (len(self.vectors), 1))
        for (block, _), end in zip(parts, reversed(ends), strict=True):
            for v, vector in enumerate(end.tolist()):
                states[v] = [self.trace(block, vector, s)[1] for s in states[v].tolist()]
        return now, states


def faults(rows: DataFrame) -> DataFrame:
    """``rows`` (``conv_id, turn, role, text, row``) with ``fault``; equal rows are told apart by ``row``."""
    solid = F.substring(F.rtrim(F.col("text"), F.lit(SPACES)), -1, 1)  # the last character that is not white space
    place = F.struct("turn", "row")
    blank = solid == ""
    digest = F.sha2("text", 256)
    # Only texts that occur again meet in the join: one row on that side for each, whatever its copies.
    again = (
        rows.filter(~blank)
        .groupBy("conv_id", "role", digest.alias("digest"))
        .agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("times"))
        .filter("times > 1")
        .select(F.col("conv_id").alias("again_id"), F.col("role").alias("again_role"), "digest", "first")
    )
    left = rows.withColumn("own", digest)
    same = F.col("conv_id").eqNullSafe(F.col("again_id")) & (F.col("role") == F.col("again_role")) & (F.col("own") == F.col("digest"))
    fault = (
        F.when(blank, "blank")
        .when(F.col("first").isNotNull() & (place != F.col("first")), "duplicate")
        .when(~solid.isin(".", "!", "?"), "truncated")
    )
    return left.join(again, same, "left").select("conv_id", "turn", "role", "text", "row", fault.alias("fault"))


def _symbol() -> Column:
    initial = F.substring("role", 1, 1)
    role = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    dropped = F.coalesce(F.col("fault").isin("blank", "duplicate"), F.lit(False))
    return F.when(dropped, 0).otherwise(1 + 2 * role + F.coalesce(F.col("fault") == "truncated", F.lit(False)).cast("int"))


def in_chunks(rows: DataFrame, chunk_rows: int) -> DataFrame:
    """Rows in order, dealt by ranges, with ``chunk`` and ``pos``."""
    chunks = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // chunk_rows))
    order = ("conv_id", "turn", "role", "text", "row")

    def number(batches):
        chunk, pos = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            places = [pa.array(np.full(n, chunk, np.int32)), pa.array(np.arange(pos, pos + n))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *places], [*batch.schema.names, "chunk", "pos"])
            pos += n

    dealt = faults(rows).repartitionByRange(chunks, *order).sortWithinPartitions(*order).withColumn("symbol", _symbol().cast("tinyint"))
    kind = rows.schema["conv_id"].dataType.simpleString()
    turn = rows.schema["turn"].dataType.simpleString()
    schema = f"conv_id {kind}, turn {turn}, role string, text string, row bigint, fault string, symbol tinyint, chunk int, pos bigint"
    return stored(dealt.mapInArrow(number, schema), "conversation-chunks")


def _joints(ordered: DataFrame) -> DataFrame:
    """``conv_id, chunk, after, state`` for the chunks of conversations that lie in several."""
    kind = ordered.schema["conv_id"].dataType.simpleString()
    ends = ordered.groupBy("conv_id").agg(F.min("chunk").alias("low"), F.max("chunk").alias("high"))
    # At most two conversations reach across the end of a chunk.
    split = ends.filter("low < high").select(F.col("conv_id").alias("split_id"))
    parts = ordered.join(split, F.col("conv_id").eqNullSafe(F.col("split_id")), "left_semi").select("conv_id", "chunk", "pos", "symbol")

    def sum_up(frame: pd.DataFrame) -> pd.DataFrame:
        symbols = frame.sort_values("pos")["symbol"].to_numpy().astype(np.int64)
        vectors, states = Tables().summary(symbols)
        row = frame.iloc[:1][["conv_id", "chunk"]]
        return row.assign(vectors=[vectors.tolist()], states=[states.ravel().tolist()])

    def put_together(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("chunk")
        vectors, states = frame["vectors"].tolist(), frame["states"].tolist()
        after, now = [0] * len(frame), 0
        for k in range(len(frame) - 1, -1, -1):
            after[k], now = now, int(vectors[k][now])
        begin, now = [0] * len(frame), 0
        for k in range(len(frame)):
            begin[k], now = now, int(states[k][4 * after[k] + now])
        last = [False] * (len(frame) - 1) + [True]
        return frame[["conv_id", "chunk"]].assign(after=after, state=begin, last=last)

    sums = parts.groupBy("conv_id", "chunk").applyInPandas(sum_up, f"conv_id {kind}, chunk int, vectors array<int>, states array<int>")
    whole = f"conv_id {kind}, chunk int, after int, state int, last boolean"
    return stored(sums.groupBy("conv_id").applyInPandas(put_together, whole), "conversation-joints")


EDITED = "edit string, fault string, was string, role string, text string, cost int"


def repaired(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """One row per edit: ``conv_id, turn, edit, fault, was, role, text, cost``.

    ``was`` is the role before (null for inserts), ``role`` the one after.  The rows of a conversation lie together
    in one partition, in the order of the edits.
    """
    rows = conversations.select(
        F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit(" ")).alias("text"),
        F.monotonically_increasing_id().alias("row"),
    )
    ordered = in_chunks(stored(rows, "conversation-rows"), chunk_rows)
    joints = _joints(ordered).withColumnsRenamed({"conv_id": "joint_id", "chunk": "joint_chunk"})
    same = F.col("conv_id").eqNullSafe(F.col("joint_id")) & (F.col("chunk") == F.col("joint_chunk"))
    placed = ordered.join(joints, same, "left").select(
        "conv_id", "chunk", "pos", "turn", "role", "text", "fault", "symbol",
        F.coalesce("after", F.lit(0)).alias("after"), F.coalesce("state", F.lit(0)).alias("state"), F.coalesce("last", F.lit(True)).alias("last"),
    )
    together = placed.repartition("conv_id").sortWithinPartitions("conv_id", "chunk", "pos")
    kinds = {c: rows.schema[c].dataType.simpleString() for c in ("conv_id", "turn")}
    schema = f"conv_id {kinds['conv_id']}, turn {kinds['turn']}, {EDITED}"
    return together.mapInArrow(thrifty(_edit), schema)


def _segments(batches):
    """Rows of one conversation in one chunk at a time."""
    held: list[pa.RecordBatch] = []
    key = None
    for batch in batches:
        ids, chunks = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        start = 0
        for k in range(batch.num_rows):
            found = (ids[k], chunks[k])
            if key is not None and found != key:
                held.append(batch.slice(start, k - start))
                yield pa.Table.from_batches(held)
                held, start = [], k
            key = found
        held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)


def _edit(batches):
    tables = Tables()
    out: tuple[list, ...] = tuple([] for _ in range(8))
    schema = None

    def batch():
        columns = [pa.array(values, schema.field(c).type if c in ("conv_id", "turn") else None) for values, c in zip(out, names, strict=True)]
        kinds = [pa.string()] * 5 + [pa.int32()]
        columns[2:] = [c.cast(k) for c, k in zip(columns[2:], kinds, strict=True)]
        for values in out:
            values.clear()
        return pa.RecordBatch.from_arrays(columns, names)

    names = ["conv_id", "turn", "edit", "fault", "was", "role", "text", "cost"]
    for part in _segments(batches):
        schema = part.schema
        row = {c: part.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "fault")}
        symbols = part.column("symbol").to_numpy().astype(np.int64)
        state = part.column("state")[0].as_py()
        letters, end = tables.edits(symbols, part.column("after")[0].as_py(), state)
        letters += "I" * (INSERTS_AT_END[end] if part.column("last")[0].as_py() else 0)
        conv, k = row["conv_id"][0], 0
        for letter in letters:
            if letter == "I":
                role, values = NEXT_ROLE[state], (None, "I", None, None, NEXT_ROLE[state], "", 2)
            else:
                was, fault = row["role"][k], row["fault"][k]
                role = NEXT_ROLE[state] if letter == "R" else was
                cost = 3 if letter == "D" else 2 * (letter == "R") + (fault == "truncated")
                values = (row["turn"][k], letter, fault, was, role, row["text"][k], cost)
                k += 1
            if letter != "D":
                state = KEEP[state][role[0]]
            for column, value in zip(out, (conv, *values), strict=True):
                column.append(value)
            if len(out[0]) >= OUT_ROWS:
                yield batch()
    if out[0]:
        yield batch()


SUMMARY = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"


def summaries(edits: DataFrame) -> DataFrame:
    """One row per conversation of ``repaired``'s result, read as it lies: counts, letters and a digest of what stays.

    Rows are read one after another; of a conversation only its letters are held.
    """

    def run(batches):
        key = turns = None
        started = False
        names = ["conv_id", *(c.split()[0] for c in SUMMARY.split(", "))]
        done: tuple[list, ...] = tuple([] for _ in names)
        kind = pa.int64()

        def close():
            gaps = turns[1] - turns[0] + 1 - turns[2] if turns else 0
            values = (key, gaps, *count, "".join(letters), digest.hexdigest())
            for column, value in zip(done, values, strict=True):
                column.append(value)

        def batch_of():
            kinds = [kind, *[pa.int64()] * 6, pa.string(), pa.string()]
            found = pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(done, kinds, strict=True)], names)
            for values in done:
                values.clear()
            return found

        for batch in batches:
            kind = batch.schema.field("conv_id").type
            for conv, turn, edit, fault, was, role, text, cost in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if not started or conv != key:
                    if started:
                        close()
                    started, key, turns, before, first = True, conv, None, None, True
                    count, letters, digest = [0] * 5, [], hashlib.sha256()
                letters.append(edit)
                count[4] += cost
                if edit != "I":
                    if turn is not None:
                        if turns is None:
                            turns = [turn, turn, 1]
                        elif turn != turns[1]:
                            turns[1:] = [turn, turns[2] + 1]
                    if fault:
                        count[("blank", "duplicate", "truncated").index(fault)] += 1
                    if before is not None:
                        count[3] += before + was[:1] not in ("su", "ua", "au")
                    before = was[:1]
                if edit != "D":
                    digest.update(("" if first else "\n").encode() + f"{role}:{text}".encode())
                    first = False
            if len(done[0]) >= OUT_ROWS:
                yield batch_of()
        if started:
            close()
            yield batch_of()

    kind = edits.schema["conv_id"].dataType.simpleString()
    return edits.mapInArrow(run, f"conv_id {kind}, {SUMMARY}")
