"""Best-fit packing with certified partitions.

Documents become token ids, are cut into pieces of at most ``size`` tokens, and the pieces, which are a few
numbers each, are packed: every partition runs best-fit decreasing and compares its number of bins with a lower
bound from dual feasible functions.  Where both agree the partition is certified.  Where they do not, its
unfilled bins are opened again, dealt anew among the partitions with gaps, and packed once more; certified
partitions hand in their emptiest bin, so that no partition wastes a bin at its end.  Partitions are bounded by
their number of bins, and texts and ids never move.

Ids: pre-tokens are found for a whole block at once and each distinct one is merged once per task, by the merge
ranks of the same vocabulary; texts with special tokens go through the tokenizer itself.

Defined cases: a null or empty text is the end id alone; repeated rows are packed as often as they occur; an
empty table gives an empty result; other columns are ignored.  Only documents of more than ``size`` ids are cut:
what does not fill a piece comes first.
"""

from __future__ import annotations

import base64
import zlib
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from palimpsest.llm.common import documents_of
from palimpsest.llm.pretokens import PreTokenizer, blocks, distinct
from palimpsest.session import stored

BLOCK_CHARS = 2 << 20
#: Distinct pre-tokens whose ids a task remembers before it starts anew.
REMEMBERED = 1 << 19
BINS_PER_PARTITION, ROUNDS = 8192, 4
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
PACKED = f"{PIECES}, sequence_id bigint, offset bigint, open boolean, gap bigint"


class Encoder:
    """Ids of texts as ``tokenizer.encode(text, add_special_tokens=False)`` gives them."""

    def __init__(self, tokenizer_path: str, ranks_path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.pre = PreTokenizer(self.tokenizer)
        with open(ranks_path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        whole = tiktoken.Encoding("whole", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
        self._merge = whole.encode_ordinary
        self._known: dict[str, list[int]] = {}

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        special = [any(s in t for s in self.specials) for t in texts]
        tokens = self.pre.split(["" if odd else t for t, odd in zip(texts, special, strict=True)])
        place, number = distinct(tokens)
        if len(self._known) > REMEMBERED:
            self._known = {}
        known, merge = self._known, self._merge
        ids = []
        for p in place.tolist():
            word = tokens.word(p)
            found = known.get(word)
            if found is None:
                found = known[word] = merge(word)
            ids.append(found)
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter(chain.from_iterable(ids), np.uint32, int(size.sum()))
        first = np.cumsum(size) - size
        lengths = size[number]
        ends = np.cumsum(lengths)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(first[number] - (ends - lengths), lengths)
        stream = flat[at]
        totals = np.bincount(tokens.owner, lengths, len(texts)).astype(np.int64)
        found = np.split(stream, np.cumsum(totals)[:-1]) if len(texts) else []
        for k in np.flatnonzero(special):
            found[k] = np.array(self.tokenizer.encode(texts[k], add_special_tokens=False).ids, np.uint32)
        return found


def token_pieces(
    docs: DataFrame, tokenizer_path: str, ranks_path: str, end_id: int, size: int,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """The pieces of every document: ``doc_id, piece, start, length, ids_crc32``."""

    def run(batches):
        encoder = Encoder(tokenizer_path, ranks_path)
        for ids, texts in blocks(batches, BLOCK_CHARS):
            rows: tuple[list, ...] = ([], [], [], [], [])
            for doc, found in zip(ids, encoder.encode(texts), strict=True):
                stream = np.append(found, np.uint32(end_id)).astype("<u4")
                head = len(stream) % size if len(stream) > size else 0
                cuts = [*([0] if head else []), *range(head, len(stream), size), len(stream)]
                for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                    for column, value in zip(rows, (doc, k, a, b - a, zlib.crc32(stream[a:b])), strict=True):
                        column.append(value)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(r, k) for r, k in zip(rows, kinds, strict=True)],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return documents_of(docs, id_col, text_col).mapInArrow(run, PIECES)


def best_fit(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of every length, given in descending order; the fullest bin with room is taken."""
    bins: list[list[int]] = [[] for _ in range(size + 1)]  # by room left
    rooms = 0  # bit r: there is a bin with room r
    where, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    made = 0
    for k, length in enumerate(lengths.tolist()):
        fits = rooms >> length
        if fits:
            room = length + (fits & -fits).bit_length() - 1
            chosen = bins[room].pop()
            if not bins[room]:
                rooms ^= 1 << room
        else:
            room, chosen = size, made
            made += 1
        where[k], offset[k] = chosen, size - room
        room -= length
        if room:
            bins[room].append(chosen)
            rooms |= 1 << room
    return where, offset


def lower_bound(lengths: np.ndarray, size: int) -> int:
    """The best of the bounds that dual feasible functions give for bins of ``size``.

    With integers: sizes that leave no room for a small piece count as whole bins and the small ones as nothing
    (every threshold up to half a bin is tried), and, after that, sizes are rounded down to multiples of
    ``size / (k + 1)`` and scaled by ``1 / k``.
    """
    if not len(lengths):
        return 0
    counts = np.bincount(lengths, minlength=size + 1).astype(np.int64)
    sizes = np.arange(size + 1)
    best = -(-int((counts * sizes).sum()) // size)
    for small in (np.unique(np.r_[0, lengths[lengths <= size // 2]])).tolist():
        value = np.where(sizes > size - small, size, np.where(sizes < small, 0, sizes))
        total = int((counts * value).sum())
        best = max(best, -(-total // size))
        for k in range(1, 9):
            scaled = value * (k + 1)
            exact = scaled % size == 0
            # In units of 1 / (k * size).
            rounded = np.where(exact, value * k, scaled // size * size)
            best = max(best, -(-int((counts * rounded).sum()) // (k * size)))
    return best


def pack(pieces: DataFrame, size: int, bins_per_partition: int = BINS_PER_PARTITION, rounds: int = ROUNDS) -> DataFrame:
    """``pieces`` with ``sequence_id, offset`` and ``gap``, the bins its partition may have too many (0: certified)."""
    waiting, done, taken = stored(pieces, "pieces"), [], 0
    for turn in range(rounds):
        tokens = waiting.agg(F.sum("length")).first()[0]
        if not tokens:
            break
        parts = -(-tokens // (size * bins_per_partition))
        last = turn == rounds - 1 or (parts == 1 and turn > 0)
        packed = stored(_round(waiting, size, parts, turn, taken, last), "packed")
        taken += parts
        done.append(packed.filter(~F.col("open")))
        if last:
            break
        waiting = packed.filter("open").select(*pieces.columns)
    if not done:
        return waiting.select(*pieces.columns, *(F.lit(0).cast("bigint").alias(c) for c in ("sequence_id", "offset", "gap")))
    whole = done[0]
    for more in done[1:]:
        whole = whole.unionByName(more)
    return whole.drop("open")


def _round(pieces: DataFrame, size: int, parts: int, turn: int, taken: int, last: bool) -> DataFrame:
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        part = int(frame["part"].iloc[0])
        frame = frame.drop(columns="part").sort_values(
            ["length", "doc_id", "piece", "start"], ascending=[False, True, True, True], kind="stable"
        )
        lengths = frame["length"].to_numpy()
        where, offset = best_fit(lengths, size)
        made = int(where.max()) + 1
        gap = made - lower_bound(lengths, size)
        room = size - np.bincount(where, lengths, made).astype(np.int64)
        opened = np.zeros(made, bool)
        if not last and gap:
            opened = room > 0
        elif not last and room.max() > 0:
            opened[room.argmax()] = True
        return frame.assign(
            sequence_id=((taken + part) << 32) + where, offset=offset, open=opened[where], gap=gap
        )

    part = F.pmod(F.xxhash64("doc_id", "piece", "start", F.lit(turn)), F.lit(parts)).cast("int")
    return pieces.withColumn("part", part).groupBy("part").applyInPandas(run, PACKED)


def pack_documents(
    docs: DataFrame, tokenizer_path: str, ranks_path: str, end_id: int = 2, size: int = 1024,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Where every piece of every document lies: its columns, ``sequence_id``, ``offset`` and ``gap``."""
    return pack(token_pieces(docs, tokenizer_path, ranks_path, end_id, size, id_col, text_col), size)
