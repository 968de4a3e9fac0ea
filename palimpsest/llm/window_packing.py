"""Bounded-space online packing into windows of ``size`` tokens, with documents cut wherever that saves padding.

A partition takes its documents as they come and keeps at most ``open_windows`` windows open.  A document (what is
left of it after whole windows) goes into the window that it fills best.  Where none has room and no more may be
opened, the fullest is filled up with the document's beginning and emitted, and the rest is placed anew; a window
is thus never emitted with padding.

What is still open at a partition's end, ``open_windows`` windows at most, is handed on with its ids, and the
leftovers of ``FAN_IN`` partitions are packed by the same rule, in as many rounds as it takes to come to a single
group.  That one pours its last windows into each other; the final remainder is cut into windows whose lengths are
powers of two, which need no padding.

Memory: the ids of one block of texts (a single text at least) and of the open windows; in a merging group
``FAN_IN * open_windows`` windows, whatever the corpus.  Texts never move; ids move only for leftovers.

Defined cases: a null or empty text is the end id alone; repeated rows are packed as often as they occur, also
those without an id; of equal fits the window that was opened or filled last is taken, so the result depends on
the order of the rows in a partition, never the coverage; an empty table gives an empty result; other columns are
ignored; a very long text is encoded whole, in one task.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from palimpsest.llm.common import documents_of, thrifty
from palimpsest.llm.packing import Encoder
from palimpsest.llm.pretokens import blocks
from palimpsest.session import stored

BLOCK_CHARS = 1 << 20
OPEN_WINDOWS, FAN_IN = 32, 64
#: Bits of a sequence id below the number of the group, and below the round.
WINDOW_BITS, ROUND_BITS = 26, 58
PLACED = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
HANDED = f"{PLACED}, group bigint, window int, ids binary"
COLUMNS = [c.split()[0] for c in HANDED.split(", ")]

#: A piece: document, its total of ids, where the piece starts in them, and the ids.
Piece = tuple[int | None, int, int, np.ndarray]


class Windows:
    """At most ``count`` windows being filled, found by the room they have left."""

    def __init__(self, size: int, count: int):
        self.size, self.count, self.open = size, count, 0
        self._by_room: list[list[list[Piece]]] = [[] for _ in range(size + 1)]
        self._rooms = 0  # bit r: some window has room r
        self.full: list[list[Piece]] = []

    def _take(self, room: int) -> list[Piece]:
        window = self._by_room[room].pop()
        if not self._by_room[room]:
            self._rooms ^= 1 << room
        return window

    def _put(self, window: list[Piece], room: int) -> None:
        if room:
            self._by_room[room].append(window)
            self._rooms |= 1 << room
        else:
            self.full.append(window)
            self.open -= 1

    def add(self, piece: Piece) -> None:
        doc, total, start, ids = piece
        while len(ids):
            length, rooms = len(ids), self._rooms
            fits = rooms >> length
            if length >= self.size:
                self.full.append([(doc, total, start, ids[: self.size])])
                placed = self.size
            elif fits:
                room = length + (fits & -fits).bit_length() - 1
                window = self._take(room)
                window.append((doc, total, start, ids))
                self._put(window, room - length)
                return
            elif self.open < self.count:
                self.open += 1
                self._put([(doc, total, start, ids)], self.size - length)
                return
            else:
                placed = (rooms & -rooms).bit_length() - 1  # the fullest window's room
                window = self._take(placed)
                window.append((doc, total, start, ids[:placed]))
                self._put(window, 0)
            start, ids = start + placed, ids[placed:]

    def detach(self) -> None:
        """Copy the ids of the open windows out of the arrays they are views of."""
        for window in self.left():
            window[:] = [(doc, total, start, ids.copy()) for doc, total, start, ids in window]

    def left(self) -> list[list[Piece]]:
        """The open windows, the fullest first."""
        return [window for windows in self._by_room for window in windows]

    def poured(self) -> list[list[Piece]]:
        """The open windows' pieces in full windows; the remainder in windows whose lengths are powers of two."""
        pieces = [piece for window in self.left() for piece in window]
        whole, rest = divmod(sum(len(piece[3]) for piece in pieces), self.size)
        lengths = [self.size] * whole + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]
        windows, room = [], 0
        for doc, total, start, ids in pieces:
            while len(ids):
                if not room:
                    room = lengths[len(windows)]
                    windows.append([])
                taken = min(len(ids), room)
                windows[-1].append((doc, total, start, ids[:taken]))
                start, ids, room = start + taken, ids[taken:], room - taken
        return windows


class Rows:
    """Columns of placed and handed-on pieces, for one group of one round."""

    def __init__(self, turn: int, group: int):
        self.base, self.group, self.made = (turn << ROUND_BITS) | (group << WINDOW_BITS), group, 0
        self.columns: tuple[list, ...] = tuple([] for _ in COLUMNS)

    def emit(self, windows: list[list[Piece]]) -> None:
        for window in windows:
            offset = 0
            for doc, total, start, ids in window:
                row = (doc, start, len(ids), zlib.crc32(ids.tobytes()), total, self.base + self.made, offset, None, None, None)
                for column, value in zip(self.columns, row, strict=True):
                    column.append(value)
                offset += len(ids)
            self.made += 1

    def hand_on(self, windows: list[list[Piece]]) -> None:
        for k, window in enumerate(windows):
            for doc, total, start, ids in window:
                row = (doc, start, len(ids), None, total, None, None, self.group, k, ids.tobytes())
                for column, value in zip(self.columns, row, strict=True):
                    column.append(value)

    def taken(self) -> dict[str, list]:
        found, self.columns = dict(zip(COLUMNS, self.columns, strict=True)), tuple([] for _ in COLUMNS)
        return found


ARROW = pa.schema(
    [(c, pa.int64()) for c in COLUMNS[:-2]] + [("window", pa.int32()), ("ids", pa.binary())]
)


def _fill(tokenizer_path: str, ranks_path: str, end_id: int, size: int, open_windows: int):
    def run(batches):
        encoder, windows = Encoder(tokenizer_path, ranks_path), Windows(size, open_windows)
        rows = Rows(0, TaskContext.get().partitionId())
        for ids, texts in blocks(batches, BLOCK_CHARS):
            for doc, found in zip(ids, encoder.encode(texts), strict=True):
                stream = np.append(found, np.uint32(end_id)).astype("<u4")
                windows.add((doc, len(stream), 0, stream))
            rows.emit(windows.full)
            windows.full = []
            # What stays open must not keep the arrays of the whole block.
            windows.detach()
            yield pa.RecordBatch.from_pydict(rows.taken(), ARROW)
        rows.hand_on(windows.left())
        yield pa.RecordBatch.from_pydict(rows.taken(), ARROW)

    return run


def _merge(turn: int, size: int, open_windows: int, last: bool):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        rows, windows = Rows(turn, int(frame["merged"].iloc[0])), Windows(size, open_windows)
        # The longest first, as all of the group is here.
        frame = frame.sort_values(["length", "doc_id", "start", "group", "window"], ascending=[False, True, True, True, True])
        for row in frame.itertuples():
            doc = None if pd.isna(row.doc_id) else int(row.doc_id)
            windows.add((doc, int(row.doc_tokens), int(row.start), np.frombuffer(row.ids, "<u4")))
        rows.emit(windows.full)
        if last:
            rows.emit(windows.poured())
        else:
            rows.hand_on(windows.left())
        return pa.Table.from_pydict(rows.taken(), ARROW).to_pandas(types_mapper=NULLABLE.get)

    return run


#: Pandas types with nulls, so that ids of 64 bits stay whole.
NULLABLE = {pa.int64(): pd.Int64Dtype(), pa.int32(): pd.Int32Dtype()}


def pack_windows(
    docs: DataFrame, tokenizer_path: str, ranks_path: str, end_id: int, size: int,
    open_windows: int = OPEN_WINDOWS, fan_in: int = FAN_IN, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Where every piece of every document lies.

    ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``: ``doc_tokens`` counts the document's ids
    and its end id, ``offset`` is the piece's place in its sequence.
    """
    fill = _fill(tokenizer_path, ranks_path, end_id, size, open_windows)
    step = stored(documents_of(docs, id_col, text_col).mapInArrow(thrifty(fill), HANDED), "windows")
    whole, turn = step.filter(F.col("group").isNull()), 0
    while True:
        open_rows = step.filter(F.col("group").isNotNull())
        highest = open_rows.agg(F.max("group")).first()[0]
        if highest is None:
            break
        turn, last = turn + 1, highest < fan_in
        merged = open_rows.withColumn("merged", F.floor(F.col("group") / fan_in))
        step = stored(merged.groupBy("merged").applyInPandas(_merge(turn, size, open_windows, last), HANDED), "windows")
        whole = whole.unionByName(step.filter(F.col("group").isNull()))
    return whole.drop("group", "window", "ids")
