"""Token counts without token ids.

A tokenizer merges inside pre-tokens only, so a document has as many tokens as its pre-tokens have pieces.  Each
block of documents is turned into postings: for every distinct pre-token of the block, the documents that hold it
and how often.  Postings are dealt by a hash of the pre-token, one packed row per block and bucket, so all of one
pre-token meet at one reducer, which counts its pieces once.  It sends the sums of a block as one packed row, and the packed rows of a block are
added up by one task, block after block.  Neither ids nor texts are shuffled.

A pre-token that many documents of a block hold has long postings; those are dealt over ``salts`` buckets, a number
that follows the shuffle partitions, and its pieces are counted once in each.  Blocks are bounded, and so are the
reducers' memories of counted pre-tokens.

Documents should come from files or a stored table: a block is named by its partition, and a repeated task must
see the same rows.

Defined cases: a null or empty text has no tokens; a special token's string counts as one token and splits its
text, which is the tokenizer's default; repeated rows come out as often as they occur; other columns are ignored.
"""

from __future__ import annotations

import json
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from palimpsest.llm.common import documents_of, thrifty
from palimpsest.llm.pretokens import PreTokenizer, blocks, distinct

BLOCK_CHARS, BLOCK_DOCS = 2 << 20, 1 << 16
#: Distinct pre-tokens that a reducer remembers before it starts anew.
REMEMBERED = 1 << 18
POSTINGS = (
    "bucket int, block bigint, words binary, sizes binary, counts binary, postings binary,"
    " place int, doc_id bigint, n_bytes bigint, special bigint"
)
SUMS = "block bigint, docs binary, sums binary, place int, doc_id bigint, n_bytes bigint, special bigint"
#: A posting: the document's number in its block and the frequency.
POSTING = np.dtype([("doc", "<u2"), ("freq", "<u2")])


def token_counts(
    docs: DataFrame, tokenizer_path: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row of ``docs``."""
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salts = max(1, partitions // 64)
    rows = documents_of(docs, id_col, text_col).mapInArrow(
        thrifty(_postings(tokenizer_path, 4 * partitions, salts)), POSTINGS
    )
    sums = (
        rows.repartition(partitions, "bucket")
        .mapInArrow(thrifty(_count(tokenizer_path)), SUMS)
        .repartition(partitions, "block")
        .sortWithinPartitions("block")
        .mapInArrow(thrifty(_totals), "doc_id bigint, n_bytes bigint, n_tokens bigint")
    )
    return sums.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def _load(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _splitter_spec(path: str) -> tuple[str, list[str]]:
    """The tokenizer's description without its vocabulary, which only splits into pre-tokens, and its special tokens.

    Made once by the driver, so that no task parses the vocabulary for it.
    """
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    specials = [t["content"] for t in spec["added_tokens"]]
    spec["added_tokens"], spec["model"]["vocab"], spec["model"]["merges"] = [], {}, []
    return json.dumps(spec), specials


def split_specials(specials: list[str], texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The parts of the texts between special tokens, the text of every part, the number of specials per text."""
    number = np.zeros(len(texts), np.int64)
    if not any(s in t for s in specials for t in texts):
        return texts, np.arange(len(texts)), number
    import re

    cut = re.compile("|".join(map(re.escape, sorted(specials, key=len, reverse=True))))
    parts, owner = [], []
    for k, text in enumerate(texts):
        found = cut.split(text)
        number[k] = len(found) - 1
        parts += found
        owner += [k] * len(found)
    return parts, np.array(owner), number


def _postings(path: str, buckets: int, salts: int):
    spec, specials = _splitter_spec(path)

    def run(batches):
        from tokenizers import Tokenizer

        pre = PreTokenizer(Tokenizer.from_str(spec))
        partition = TaskContext.get().partitionId()
        for number, (ids, texts) in enumerate(_bounded(blocks(batches, BLOCK_CHARS))):
            yield from _block_rows(specials, pre, ids, texts, (partition << 20) + number, buckets, salts)

    return run


def _bounded(found):
    for ids, texts in found:
        for k in range(0, len(ids), BLOCK_DOCS):
            yield ids[k : k + BLOCK_DOCS], texts[k : k + BLOCK_DOCS]


def _columns(schema: str, **given):
    """A batch of the schema; what is not given is null."""
    n = len(next(iter(given.values())))
    kinds = [(c, pa.binary() if k == "binary" else pa.int32() if k == "int" else pa.int64())
             for c, k in (part.split() for part in schema.split(","))]
    return pa.RecordBatch.from_arrays(
        [pa.array(given[c], k) if c in given else pa.nulls(n, k) for c, k in kinds], [c for c, _ in kinds]
    )


def _block_rows(specials, pre, ids, texts, block, buckets, salts):
    parts, part_owner, special = split_specials(specials, texts)
    tokens = pre.split(parts)
    n = len(ids)
    yield _columns(  # one head row per document
        POSTINGS, bucket=np.arange(n) % buckets, block=np.full(n, block), place=np.arange(n), doc_id=ids,
        n_bytes=[len(t.encode()) for t in texts], special=special,
    )
    if not len(tokens.keys):
        return
    first, number = distinct(tokens)
    # Pairs (pre-token, document) with their frequency, ordered by pre-token.
    pair, freq = np.unique(number * np.int64(n) + part_owner[tokens.owner], return_counts=True)
    word, doc = pair // n, pair % n
    if (over := freq > 65535).any():  # a frequency beyond the field goes into several postings
        times = np.where(over, -(-freq // 65535), 1)
        turn = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        word, doc = np.repeat(word, times), np.repeat(doc, times)
        freq = np.minimum(np.repeat(freq, times) - turn * 65535, 65535)
    packed = np.empty(len(doc), POSTING)
    packed["doc"], packed["freq"] = doc, freq
    count = np.bincount(word, minlength=len(first))
    salt = np.where(count * 4 > n, block % salts, 0).astype(np.uint64)
    bucket = ((tokens.keys[first] + salt) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    bucket, count = bucket[order], count[order]
    begin = (np.cumsum(np.bincount(word, minlength=len(first))) - np.bincount(word, minlength=len(first)))[order]
    at = np.repeat(begin - (np.cumsum(count) - count), count) + np.arange(len(packed))
    packed = packed[at]
    words = [tokens.word(k).encode() for k in first[order].tolist()]
    sizes = np.fromiter(map(len, words), "<u4", len(words))
    edges = np.r_[0, np.cumsum(count)]
    cuts = np.r_[0, np.flatnonzero(np.diff(bucket)) + 1, len(bucket)].tolist()
    spans = list(zip(cuts[:-1], cuts[1:], strict=True))
    yield _columns(
        POSTINGS,
        bucket=bucket[cuts[:-1]],
        block=np.full(len(spans), block),
        words=[b"".join(words[a:b]) for a, b in spans],
        sizes=[sizes[a:b].tobytes() for a, b in spans],
        counts=[count[a:b].astype("<u4").tobytes() for a, b in spans],
        postings=[packed[edges[a] : edges[b]].tobytes() for a, b in spans],
    )


def _count(path: str):
    def run(batches):
        # A task has one core; threads of the tokenizer's own would each keep an allocator arena.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        tokenizer = _load(path)
        known: dict[bytes, int] = {}
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            head = batch.column("place").is_valid()
            heads = batch.filter(head)
            if heads.num_rows:
                yield _columns(SUMS, **{c: heads.column(c) for c in ("block", *HEAD)})
            for row in batch.filter(pa.compute.invert(head)).to_pylist():
                if len(known) > REMEMBERED:
                    known = {}
                sizes, counts = (np.frombuffer(row[c], "<u4").astype(np.int64) for c in ("sizes", "counts"))
                ends = np.cumsum(sizes).tolist()
                words = [row["words"][a:b] for a, b in zip([0, *ends], ends, strict=False)]
                new = [w for w in words if w not in known]
                known.update(zip(new, _pieces(tokenizer, new), strict=True))
                pieces = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
                postings = np.frombuffer(row["postings"], POSTING)
                product = postings["freq"] * np.repeat(pieces, counts)
                total = np.bincount(postings["doc"], product).astype(np.int64)
                if len(kept := sums.get(row["block"], total[:0])) > len(total):
                    kept[: len(total)] += total
                else:
                    total[: len(kept)] += kept
                    sums[row["block"]] = total
            if sum(map(len, sums.values())) > 4_000_000:
                yield from _flush(sums)
                sums = {}
        yield from _flush(sums)

    return run


def _pieces(tokenizer, words: list[bytes]) -> list[int]:
    found = tokenizer.encode_batch_fast([w.decode() for w in words], add_special_tokens=False) if words else []
    return [len(e.ids) for e in found]


def _flush(sums):
    """A packed row per block: documents and their sums."""
    docs = [np.flatnonzero(total) for total in sums.values()]
    if docs:
        yield _columns(
            SUMS,
            block=list(sums),
            docs=[d.astype("<u2").tobytes() for d in docs],
            sums=[total[d].astype("<i8").tobytes() for total, d in zip(sums.values(), docs, strict=True)],
        )


HEAD = ("place", "doc_id", "n_bytes", "special")


def _totals(batches):
    """Rows in the order of their blocks: documents with the sums of their block's packed rows."""
    block, heads, total = None, [], np.zeros(0, np.int64)
    for batch in batches:
        number = batch.column("block").to_numpy()
        cuts = np.r_[0, np.flatnonzero(np.diff(number)) + 1, len(number)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if a == b:
                continue
            if number[a] != block:
                yield from _documents(heads, total)
                block, heads, total = number[a], [], np.zeros(BLOCK_DOCS, np.int64)
            part = batch.slice(a, b - a)
            head = part.column("place").is_valid()
            heads.append(part.filter(head).select(list(HEAD)))
            for row in part.filter(pa.compute.invert(head)).select(["docs", "sums"]).to_pylist():
                total[np.frombuffer(row["docs"], "<u2")] += np.frombuffer(row["sums"], "<i8")
    yield from _documents(heads, total)


def _documents(heads, total):
    for head in heads:
        if head.num_rows:
            tokens = head.column("special").to_numpy() + total[head.column("place").to_numpy()]
            yield pa.RecordBatch.from_arrays(
                [head.column("doc_id"), head.column("n_bytes"), pa.array(tokens)], ["doc_id", "n_bytes", "n_tokens"]
            )
