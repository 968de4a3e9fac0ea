"""Packing with open windows, conversation repair and periodic runs, against brute force."""

import collections
import functools
import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from palimpsest.llm import conversation_repair, periodic_runs, queries, window_packing
from palimpsest.llm.oracles import ORACLES
from pyspark.sql import functions as F
from tokenizers import Tokenizer

BPE, RANKS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
SPACE = re.compile(r"[^\x20\x09-\x0D]+")
ROLES = ("user", "assistant")


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(["the", "and", "oréa", "W0rd", "x", "don't", "zeta", "…"]) for _ in range(n))


TEXTS = [None, "", " ", "a", "Ünï <|endoftext|> 🎉", *[prose(k, 7 * k) for k in range(60)], "word " * 30_000, prose(1, 7), prose(1, 7)]


# ---- windows


@pytest.mark.parametrize("open_windows, fan_in, parts", [(4, 2, 7), (32, 64, 3), (1, 2, 5)])
def test_window_packing(documents, open_windows, fan_in, parts):
    tokenizer, size = Tokenizer.from_file(BPE), 256
    ids = [None, None, *range(2, len(TEXTS) - 1), len(TEXTS) - 2]  # null and repeated ids
    docs = documents(TEXTS, ids).repartition(parts)
    got = window_packing.pack_windows(docs, BPE, RANKS, 1, size, open_windows, fan_in).collect()
    streams = collections.defaultdict(list)
    for doc, text in zip(ids, TEXTS, strict=True):
        streams[doc].append(np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4"))
    # Every id in one piece: the pieces of an id's documents can be told apart by their totals and checks.
    for doc, owned in streams.items():
        pieces = sorted((r.doc_tokens, r.start, r.length, r.ids_crc32) for r in got if r.doc_id == doc)
        for stream in owned:
            at = 0
            while at < len(stream):
                fits = [p for p in pieces if p[:2] == (len(stream), at) and p[3] == zlib.crc32(stream[at : at + p[2]])]
                pieces.remove(fits[0])
                at += fits[0][2]
        assert not pieces
    filled = collections.Counter()
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == filled[r.sequence_id] and r.length > 0
        filled[r.sequence_id] += r.length
    # No padding at all: windows are full, or, once at the end of the last group, powers of two.
    short = sorted(n for n in filled.values() if n != size)
    total = sum(len(s) for owned in streams.values() for s in owned)
    assert max(filled.values()) == size and sum(filled.values()) == total
    assert short == [1 << b for b in range(8) if total % size >> b & 1]


def test_windows_take_the_best_fit():
    windows = window_packing.Windows(100, 3)

    def add(doc, n):
        windows.add((doc, n, 0, np.full(n, doc, "<u4")))

    for doc, n in enumerate((50, 60, 70)):
        add(doc, n)
    add(3, 40)  # fits all but the third exactly into the second
    assert [p[0] for p in windows.full[0]] == [1, 3]
    add(4, 90)  # opens the third window again
    add(5, 60)  # fits nowhere: ten words fill the fullest, the other fifty the first
    assert [[(p[0], p[2], len(p[3])) for p in w] for w in windows.full[1:]] == [[(4, 0, 90), (5, 0, 10)], [(0, 0, 50), (5, 10, 50)]]
    assert [[p[0] for p in w] for w in windows.left()] == [[2]]


def test_no_documents(documents):
    assert window_packing.pack_windows(documents([]), BPE, RANKS, 1, 256).count() == 0
    assert periodic_runs.periodic_runs(documents([])).count() == 0


# ---- conversations


def cheapest(rows):
    """Cost and letters by trying everything; rows are (initial, must be deleted, truncated)."""

    @functools.cache
    def best(k, state, inserts):
        ways = []
        if k == len(rows):
            if state in (0, 3):
                return 0, ""
        else:
            initial, dropped, truncated = rows[k]
            ways.append((3, "D", (k + 1, state, 3)))
            if not dropped:
                if initial in conversation_repair.KEEP[state]:
                    ways.append((truncated, "K", (k + 1, conversation_repair.KEEP[state][initial], 3)))
                ways.append((2 + truncated, "R", (k + 1, (2, 2, 3, 2)[state], 3)))
        if inserts:
            ways.append((2, "I", (k, (2, 2, 3, 2)[state], inserts - 1)))
        found = []
        for cost, letter, to in ways:
            more = best(*to)
            if more is not None:
                found.append((cost + more[0], letter + more[1]))
        return min(found, default=None)

    return best(0, 0, 3)


def symbol(row):
    initial, dropped, truncated = row
    return 0 if dropped else 1 + 2 * "suax".index(initial if initial in "sua" else "x") + truncated


ROWS = st.lists(st.tuples(st.sampled_from("suax"), st.booleans(), st.booleans()), max_size=14)


@settings(max_examples=150, deadline=None)
@given(ROWS, st.integers(0, 14))
def test_edits(rows, cut):
    tables = conversation_repair.Tables()
    symbols = np.array([symbol(r) for r in rows], np.int64)
    cost, letters = cheapest(tuple(rows))
    got, state = tables.edits(symbols, 0, 0)
    assert got + "I" * conversation_repair.INSERTS_AT_END[state] == letters
    # Cut anywhere, the second part tells the first its vector, the first the second its state.
    vectors, states = tables.summary(symbols[cut:])
    head, middle = tables.edits(symbols[:cut], int(vectors[0]), 0)
    tail, end = tables.edits(symbols[cut:], 0, middle)
    assert head + tail == got and end == state == states[0][middle]


def expected_repair(rows):
    """What the query returns for one conversation, from (turn, role, text) after damage, in order."""
    seen, faults = set(), []
    for _, role, text in rows:
        solid = text.rstrip(" \t\n\x0b\x0c\r")
        fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else None
        seen.add((role, text))
        faults.append(fault)
    cost, letters = cheapest(tuple((r[1][:1], f in ("blank", "duplicate"), f == "truncated") for r, f in zip(rows, faults, strict=True)))
    state, k, lines = 0, 0, []
    for letter in letters:
        role = ROLES[0] if state != 2 else ROLES[1]
        text = ""
        if letter != "I":
            role, text = (role if letter == "R" else rows[k][1]), rows[k][2]
            k += 1
        if letter != "D":
            state = conversation_repair.KEEP[state][role[0]]
            lines.append(f"{role}:{text}")
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows[:-1], rows[1:], strict=True))
    return (gaps, *counts, illegal, cost, letters, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def damage(rows):
    after = []
    for conv, turn, role, text in rows:
        role, text = role if role is not None else " ", text if text is not None else " "
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        after += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return sorted(after, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))


CONVERSATION = "conv_id bigint, turn bigint, role string, text string, fault string, chunk int, pos string"


def conversation_rows(seed=1):
    rng = random.Random(seed)
    texts = ["Hello.", "Why?", "so it goes", " ", "", None, "end!\n", "odd ", "x.\u0085", "no. more ", "🎉"]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "s", "a b"]
    rows = []
    for conv in [*range(60), None]:
        # One long conversation, and the one without id; the others are short.
        for turn in range(400 if conv == 7 else 300 if conv is None else rng.randrange(1, 9)):
            turn = rng.choice([turn, turn, turn, turn, None, turn + 3])
            rows.append((conv, turn, rng.choice(roles), rng.choice(texts)))
    return rows + rows[:20]  # repeated rows


@pytest.mark.parametrize("parts", [2, 40])
def test_conversation_repair(spark, tmp_path, parts):
    rows = conversation_rows()
    spark.createDataFrame([(*r, None, 1, "p") for r in rows], CONVERSATION).write.parquet(str(tmp_path / "conversations.parquet"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)  # as many chunks: conversations lie in several
    try:
        got = {r[0]: tuple(r[1:]) for r in queries.QUERIES["op12_conversation_repair"](spark, str(tmp_path)).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    after = collections.defaultdict(list)
    for row in damage(rows):
        after[row[0]].append(row[1:])
    assert set(got) == {r[0] for r in rows}
    for conv, found in got.items():
        assert found == expected_repair(after[conv]), conv
    db = pytest.importorskip("duckdb").connect()
    db.sql(f"create view conversations as select * from read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    assert {r[0]: r[1:] for r in db.sql(ORACLES["op12_conversation_repair"]).fetchall()} == got


def test_hot_conversation_lies_in_many_chunks(spark):
    """A third of all rows and more are one conversation: no chunk holds much of it, and the edits are the same."""
    rows = [(5, k, ROLES[k % 3 % 2], f"text {k}.") for k in range(3000)] + [(k, 0, "user", "Hm.") for k in range(6, 600)]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("row", F.monotonically_increasing_id())
    chunks = conversation_repair.in_chunks(frame, 100).groupBy("chunk").count().collect()
    assert len(chunks) > 25 and max(r["count"] for r in chunks) < 400
    got = conversation_repair.repaired(frame, chunk_rows=100).filter("conv_id = 5").collect()
    _, letters = cheapest_long([r[2][0] for r in rows[:3000]])
    assert "".join(r.edit for r in got) == letters


def cheapest_long(initials):
    """The plain form of the costs and the trace, row by row and without recursion."""
    costs = [None] * len(initials) + [[0, 4, 2, 0]]
    following = (2, 2, 3, 2)
    for k in range(len(initials) - 1, -1, -1):
        after = costs[k + 1]
        now = []
        for state in range(4):
            ways = [after[state] + 3, after[following[state]] + 2]
            if initials[k] in conversation_repair.KEEP[state]:
                ways.append(after[conversation_repair.KEEP[state][initials[k]]])
            now.append(min(ways))
        for _ in range(4):
            now = [min(c, now[following[s]] + 2) for s, c in enumerate(now)]
        costs[k] = now
    letters, k, state = "", 0, 0
    while k < len(initials) or state not in (0, 3):
        here = costs[k][state]
        if k < len(initials) and costs[k + 1][state] + 3 == here:
            letters, k = letters + "D", k + 1
        elif costs[k][following[state]] + 2 == here:
            letters, state = letters + "I", following[state]
        elif initials[k] in conversation_repair.KEEP[state] and costs[k + 1][conversation_repair.KEEP[state][initials[k]]] == here:
            letters, state, k = letters + "K", conversation_repair.KEEP[state][initials[k]], k + 1
        else:
            letters, state, k = letters + "R", following[state], k + 1
    return costs[0][0], letters


def test_no_conversations(spark, tmp_path):
    spark.createDataFrame([], CONVERSATION).write.parquet(str(tmp_path / "conversations.parquet"))
    assert queries.QUERIES["op12_conversation_repair"](spark, str(tmp_path)).count() == 0
    # A conversation that loses all its rows.
    turn = next(k for k in range(1000) if zlib.crc32(f"3:{k}".encode()) % 20 == 0)
    spark.createDataFrame([(3, turn, "user", "x.", None, 1, "p")], CONVERSATION).write.parquet(str(tmp_path / "lost" / "conversations.parquet"))
    nothing = hashlib.sha256(b"").hexdigest()
    assert [tuple(r) for r in queries.QUERIES["op12_conversation_repair"](spark, str(tmp_path / "lost")).collect()] == [(3, *[0] * 6, "", nothing)]


# ---- runs


def all_runs(words):
    """Every run, by looking at every period and every place."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        x = 0
        while x + q < n:
            if words[x] != words[x + q]:
                x += 1
                continue
            start = x
            while x + q < n and words[x] == words[x + q]:
                x += 1
            length = x + q - start
            if length >= max(6, 4 * q) and (start, length) not in found:  # smaller periods come first
                found[start, length] = q
    return sorted((s, length, q) for (s, length), q in found.items())


WORDS = st.lists(st.integers(0, 2), max_size=12).flatmap(
    lambda w: st.tuples(st.just(w), st.integers(1, 9), st.lists(st.integers(0, 3), max_size=20), st.integers(1, 6))
)


@settings(max_examples=300, deadline=None)
@given(st.lists(WORDS, max_size=4))
def test_runs(parts):
    texts = [[*(w * times), *more, *(w[::-1] * again)] for w, times, more, again in parts]
    base, numbered, expected = 0, [], []
    for text in texts:
        expected += [(s + len(numbered), length, q) for s, length, q in all_runs(text)]
        numbered += [base + w for w in text]
        base += 10
    assert periodic_runs.runs_of(np.array(numbered, np.int64)) == sorted(expected, key=lambda r: (r[0], r[2]))


def plant(doc, text):
    words = SPACE.findall(text or "")
    h = zlib.crc32(str(doc).encode()) if doc is not None else 1
    n, g = len(words), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def expected_runs(words):
    runs = all_runs(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    four = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (len(runs), *four, *(hashlib.sha256(x.encode()).hexdigest() for x in (listed, kept)))


def test_periodic_runs(documents, tmp_path):
    texts = [
        None, "", " \t\n", "a", "x " * 300, "x x " * 9, "a b " * 4 + "a", "Ab ab " * 5, "a a a a a", "b a a a a a a b",
        prose(3, 50) + " " + "one two three " * 6 + prose(4, 40) + " one two three" * 3, ("n é " * 5 + "z ") * 5,
        *[prose(k, 90) for k in range(80)], prose(1, 90), " ".join(["p", *"qrstuvwxyz" * 3]),
    ]
    ids = [*range(len(texts) - 2), None, 50]  # a null id, and a row that shares its id
    documents(texts, ids).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.QUERIES["op13_periodic_runs"](documents([]).sparkSession, str(tmp_path)).collect()
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i in ids) > 3
    expected = [(i, *expected_runs(plant(i, t))) for i, t in zip(ids, texts, strict=True)]
    assert collections.Counter(map(tuple, got)) == collections.Counter(expected)
    assert sum(r.n_runs > 0 for r in got) >= 12
    assert periodic_runs.runs_of(np.arange(9)) == [] == periodic_runs.runs_of(np.zeros(0, np.int64))
