"""Every operator against brute force on small tables with the awkward cases in them."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from palimpsest.llm import (
    decontamination,
    exact_dedup,
    labelled,
    licenses,
    near_dedup,
    packing,
    pretokens,
    quality,
    substring_dedup,
    token_counts,
    toxicity,
    url_filter,
)
from palimpsest.llm.components import components
from palimpsest.llm.suffix_groups import suffix_arrays
from tokenizers import Tokenizer

BPE, RANKS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
A_TO_Z = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
PASSAGE = " ".join(f"passage{i}" for i in range(40))


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(["the", "and", "oréa", "W0rd", "x", "don't", "zeta", "…"]) + rng.choice(["", "", ".", "\n"]) for _ in range(n))


TEXTS = [
    None, "", " ", "a", "one two", prose(1, 300), prose(1, 300), prose(2, 80) + " " + PASSAGE, PASSAGE + " " + prose(3, 90),
    PASSAGE, prose(4, 2500), "aaaa" * 300, "aaaa" * 300 + "b", prose(5, 60) + " " + prose(1, 300), "Ünï çode 日本語 🎉 tail",
    "x <|endoftext|> y<|endoftext|>", "it's we'll 'tis  two\n\n three   ", "\u00a0\u2003 odd\u0085blank",
    PASSAGE.replace("passage3 ", "changed "),
]


def test_exact_dedup_batches_and_repeats(spark, documents, tmp_path):
    index = exact_dedup.DigestIndex("digests_test", str(tmp_path / "index"), buckets=2)
    docs = documents(["x", "x", None, "", "x", "y", "y"], [1, 5, 2, 3, 5, None, 4])
    for _ in range(2):  # the second run of a batch reports the same and appends nothing
        got = {(r.doc_id, r.keep_id, r.group_size, r.kept, r.n) for r in exact_dedup.dedup(docs, index, "a").collect()}
        assert got == {(1, 5, 3, False, 1), (5, 5, 3, True, 2), (2, 3, 2, False, 1), (3, 3, 2, True, 1), (None, 4, 2, False, 1), (4, 4, 2, True, 1)}
        assert index.rows(spark).count() == 3
    later = exact_dedup.dedup(documents(["x", "z"], [9, 10]), index, "b").collect()
    assert {(r.doc_id, r.keep_id, r.kept) for r in later} == {(9, 5, False), (10, 10, True)}
    assert exact_dedup.dedup(documents([]), index, "c").count() == 0
    other = exact_dedup.DigestIndex("digests_keep", str(tmp_path / "keep"), buckets=2)
    kept = exact_dedup.keep(docs, other, "a")
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(3, ""), (4, "y"), (5, "x")]


def brute_url(url, block, allow, listed):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = host.translate(A_TO_Z)

    def fits(rule):
        name, slash, tail = rule.partition("/")
        return f".{host}".endswith(f".{name}") and path.startswith(slash + tail)

    found = max((r for r in [*block, *allow] if fits(r)), key=len, default=None)
    stop = found in block if found else any(map(fits, listed))
    return host, path, found, "block" if stop else "allow"


@pytest.mark.parametrize("max_bytes", [1 << 20, 0])
def test_url_filter(spark, max_bytes):
    urls = [None, "", "nohost", "http://", "https://A.Example.NET/en/x?y", "http://net/", "http://example.net", "x://b.org/fr/#z",
            "http://example.com/de/1", "http://spam.org/a", "http://xspam.org/a", "http://a.spam.org/", "http://q.net:80/", "http://u@q.net/"]
    urls += [f"http://h{i % 37}.example.{t}/{p}/{i}" for i in range(60) for t in ("net", "com", "org") for p in ("en", "de", "fr")]
    block, allow, listed = ["net/", "example.com/de/"], ["example.net/en/", "org/fr/"], ["spam.org/", "h3.example.com/"]
    pages = spark.createDataFrame([(i, u, "h", "clash") for i, u in enumerate(urls)], "page_id long, url string, rule string, host string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(pages, block, allow, listed, max_bytes=max_bytes).collect()}
    assert got == {i: brute_url(u, block, allow, listed) for i, u in enumerate(urls)}
    assert url_filter.judge(pages.limit(0), block, allow, []).count() == 0


@pytest.mark.parametrize("max_bytes", [1 << 20, 0])
def test_url_rules_of_one_length(spark, max_bytes):
    pages = spark.createDataFrame([(1, "http://b.com/x/yy"), (2, "http://b.com/x/z"), (3, "http://c.com/x/yy")], "page_id long, url string")
    # The allowed key sorts before the blocked one of the same length.
    found = url_filter.judge(pages, ["com/x/yy"], ["b.com/x/", "com/x/yy"], [], max_bytes=max_bytes).collect()
    assert {r.page_id: (r.rule, r.verdict) for r in found} == {1: ("com/x/yy", "block"), 2: ("b.com/x/", "allow"), 3: ("com/x/yy", "block")}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.sampled_from("aZ1' \n\t.!é日🎉\u00a0stredvlmx"), max_size=30), max_size=4))
def test_pretokens_agree_with_the_tokenizer(texts):
    tokenizer = Tokenizer.from_file(BPE)
    block = pretokens.PreTokenizer(tokenizer).split(texts)
    found = collections.defaultdict(list)
    for k, owner in enumerate(block.owner):
        found[owner].append((block.word(k)))
    for i, text in enumerate(texts):
        assert found[i] == [text[a:b] for _, (a, b) in tokenizer.pre_tokenizer.pre_tokenize_str(text)]


def test_token_counts_and_packing(documents):
    tokenizer = Tokenizer.from_file(BPE)
    texts = [*TEXTS, TEXTS[5]]
    ids = [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    docs = documents(texts, [*range(len(TEXTS)), 5])
    got = sorted((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.token_counts(docs, BPE, 100).collect())
    want = [(i, len((t or "").encode()), len(x), len(x) > 100) for i, t, x in zip([*range(len(TEXTS)), 5], texts, ids, strict=True)]
    assert got == sorted(want)
    assert token_counts.token_counts(documents([]), BPE).count() == 0
    pieces = packing.pack_documents(documents(TEXTS), BPE, RANKS, end_id=2, size=64).collect()
    bins = collections.defaultdict(list)
    for r in pieces:
        bins[r.sequence_id].append((r.offset, r.length))
        stream = np.array([*ids[r.doc_id], 2], "<u4")[r.start : r.start + r.length]
        assert zlib.crc32(stream.tobytes()) == r.ids_crc32
    for i, x in enumerate(ids[: len(TEXTS)]):
        mine = sorted((r.piece, r.start, r.length) for r in pieces if r.doc_id == i)
        size = len(x) + 1
        assert [m[0] for m in mine] == list(range(len(mine))) and sum(m[2] for m in mine) == size
        assert all(m[2] == 64 for m in mine[1:]) and (size > 64 or len(mine) == 1)
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
    assert len(bins) <= -(-sum(len(x) + 1 for x in ids[: len(TEXTS)]) // 64) + 2
    assert packing.pack_documents(documents([]), BPE, RANKS).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=12))
def test_bin_bounds(lengths):
    lengths = np.array(sorted(lengths, reverse=True))
    where, offset = packing.best_fit(lengths, 20)
    assert np.bincount(where, lengths).max() <= 20
    assert packing.lower_bound(lengths, 20) <= where.max() + 1
    assert packing.lower_bound(lengths, 20) >= -(-lengths.sum() // 20)
    assert packing.lower_bound(lengths, 20) >= (lengths > 10).sum()


def brute_hits(text, items, size):
    words = re.findall(WORD, (text or "").translate(A_TO_Z))
    hit, found = set(), set()
    for item, body in items:
        w = re.findall(WORD, (body or "").translate(A_TO_Z))
        n = min(size, len(w))
        windows = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set()
        for i in range(len(words) - n + 1) if n else ():
            if tuple(words[i : i + n]) in windows:
                hit.update(range(i, i + n))
                found.add(str(item))
    return len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)


@pytest.mark.parametrize("block_windows", [1000, 3])
def test_decontamination(spark, documents, block_windows):
    items = [(1, PASSAGE), (2, "One TWO"), (10, "passage7 passage8 passage9"), (3, None), (4, "!!"), (5, " ".join(["the"] * 12)), (2, "one two")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    texts = [*TEXTS, "the " * 40, "say one, two three"]
    got = {r.doc_id: tuple(r)[1:6] for r in decontamination.contamination(documents(texts), bench, block_windows=block_windows).collect()}
    assert got == {i: brute_hits(t, items, 10) for i, t in enumerate(texts)}
    clean = decontamination.keep(documents(texts), bench)
    assert {r.doc_id for r in clean.collect()} == {i for i in got if not got[i][4]}
    assert decontamination.contamination(documents([]), bench).count() == 0
    assert decontamination.contamination(documents(texts), bench.limit(0)).filter("contaminated").count() == 0


def test_licenses(documents):
    texts = [*TEXTS, "MIT License, mit  license\nReleased under the MIT License.", "CC BY-NC 4.0", "All rights reserved.", "Licensed under\nCC by NC 4.0",
             "x. This work is licensed under the GNU General Public License, version 3."]
    got = {r.doc_id: r for r in licenses.scan(documents(texts)).collect()}
    for i, text in enumerate(texts):
        words = re.findall(WORD, (text or "").translate(A_TO_Z))
        places = [(k, label) for phrase, label in licenses.PHRASES for k in range(len(words)) if words[k : k + len(phrase.split())] == phrase.split()]
        own = set()
        for block in re.split(licenses.BLOCK_END, (text or "").translate(A_TO_Z)):
            held = set(re.findall(WORD, block))
            for template, label in licenses.TEMPLATES:
                want = set(template.split())
                if len(held & want) >= licenses.needed(len(want), licenses.THRESHOLD):
                    own.add(label)
        base = {label for _, label in places}
        row = got[i]
        assert (row.n_words, row.n_base, row.first_word, row.last_word) == (
            len(words), len(places), min((k for k, _ in places), default=None), max((k for k, _ in places), default=None))
        assert row.base_labels == ",".join(sorted(base)) and row.labels == ",".join(sorted(base | own)) and 0 <= row.score <= 1
    assert licenses.scan(documents([])).count() == 0


def brute_groups(texts):
    sets = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(A_TO_Z))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set()))
    name = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                a, b = sorted((name[i], name[j]))
                name = [a if x == b else x for x in name]
    return {i: (len(sets[i]), name[i]) for i in range(len(texts))}


def test_near_duplicates(documents):
    rng = random.Random(3)
    texts = [*TEXTS, TEXTS[7].upper()]
    for seed in range(6):
        words = [f"w{rng.randrange(500)}" for _ in range(120)]
        for edits in (0, 1, 2, 3, 5):
            copy = list(words)
            for _ in range(edits):
                copy[rng.randrange(120)] = "edit"
            texts.append(" ".join(copy))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(documents(texts)).collect()}
    want = brute_groups(texts)
    assert got == want
    kept = near_dedup.keep(documents(texts))
    assert {r.doc_id for r in kept.collect()} == {i for i, (_, c) in want.items() if c == i}
    assert near_dedup.near_duplicates(documents([])).count() == 0


def test_components(spark):
    pairs = [(1, 2), (2, 3), (9, 8), (8, 7), (7, 6), (6, 5), (4, 4)]
    got = {r.node: r.component for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 5: 5, 6: 5, 7: 5, 8: 5, 9: 5}


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.integers(1, 3), max_size=25), min_size=1, max_size=5))
def test_suffix_arrays(texts):
    texts = [[*t, 0] for t in texts]
    bounds = np.r_[0, np.cumsum([len(t) for t in texts])]
    got = suffix_arrays(np.array([x for t in texts for x in t]), bounds)
    for text, a in zip(texts, bounds, strict=False):
        assert (got[a : a + len(text)] - a).tolist() == sorted(range(len(text)), key=lambda i: text[i:])


@pytest.mark.parametrize("max_bytes", [1 << 20, 300])
def test_substring_dedup(documents, max_bytes):
    texts = [*TEXTS, TEXTS[5][40:900], "é" * 150, prose(7, 30) + "é" * 149 + prose(8, 30)]
    counts, bodies = collections.Counter(), [(t or "").encode() for t in texts]
    for b in bodies:
        counts.update(b[i : i + 200] for i in range(len(b) - 199))
    got = {r.doc_id: tuple(r)[1:5] for r in substring_dedup.remove_repeats(documents(texts), max_bytes=max_bytes).collect()}
    for k, b in enumerate(bodies):
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - 199):
            if counts[b[i : i + 200]] > 1:
                gone[i : i + 200] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone[:-1]])
        assert got[k] == (len(b), int(gone.sum()), int((gone[1:] < gone[:-1]).sum()), hashlib.sha256(kept).hexdigest()), k
    assert substring_dedup.remove_repeats(documents([])).count() == 0


def test_folding():
    fold = toxicity.folder()
    assert fold("Ïd10T, іdiоt! ＩＤＩＯＴ $cum") == "idiot idiot idiot scum"
    lexicon = toxicity.Lexicon({"clown ": 5.0, "idio": 4.0})
    automaton = lexicon.automaton()
    assert toxicity.density(automaton, fold("the class clown")) == 0
    assert toxicity.density(automaton, fold("the clown idiots")) == pytest.approx(9 / 3**0.5)
    assert toxicity.density(automaton, "") == 0


def test_written_forms_of_words():
    both = toxicity.forms()
    assert both("Réeux reeux, ÜBER\u00a0e\u0301tat 1dïot! слово") == ("reeux reeux uber etat idiot c obo", "réeux über état dïot слово")
    lexicon = toxicity.Lexicon({"réeu": 3.0, "étatis": 5.0, "etat": 2.0})
    automaton = lexicon.automaton()
    assert toxicity.density(automaton, *both("un réeux")) == pytest.approx(3 / 2**0.5)
    assert toxicity.density(automaton, *both("un reeux")) == 0
    # Both forms stand in the lexicon: the word counts once, with the larger weight.
    assert toxicity.density(automaton, *both("étatiste")) == 5 and toxicity.density(automaton, *both("etatiste")) == 2


def test_toxic_words_with_accents_and_stray_uses(documents, spark):
    rng = random.Random(2)
    texts, rows = [], []
    for i in range(400):
        toxic = i % 8 == 1
        words = [rng.choice(["alpha", "beta", "gamma", "delta", "eps"]) for _ in range(40 if toxic else 400)]
        if toxic:  # half of them by the accent only, half by a word that each second clean text has once
            words[3] = words[11] = words[30] = "réeux" if i % 16 == 1 else f"achlich{rng.choice(['en', 'er', 'st'])}"
        else:
            words[5] = words[50] = "reeux"
            words[9] = "achlichen" if i % 2 else "eps"
        texts.append(" ".join(words))
        rows.append((i, 1, int(toxic)))
    held = labelled.fold_of("doc_id", 4) == 2
    docs = documents(texts)
    model = toxicity.train(docs, spark.createDataFrame(rows, "doc_id long, quality int, toxic int"), ~held)
    assert any(t.startswith("réeu") for t in model.weights) and any(t.startswith("achl") and not t.endswith(" ") for t in model.weights)
    assert not any(t.startswith("reeu") for t in model.weights)
    got = {r.doc_id: r.predicted for r in toxicity.score(docs, model, held).filter("held_out").collect()}
    assert got == {i: int(i % 8 == 1) for i in got}


def test_classifiers(spark, documents):
    rng = random.Random(1)
    texts, rows = [], []
    for i in range(400):
        bad, toxic = i % 4 == 0, i % 5 == 1
        words = [rng.choice(["alpha", "beta", "gamma", "delta", "eps"]) for _ in range(40)]
        if toxic:
            words[7] = words[20] = "nastyword"
        texts.append(" ".join(w.upper() + "!!" if bad else w for w in words))
        rows.append((i, int(not bad), int(toxic)))
    texts += ["", None]
    rows += [(3, None, None), (None, 1, 1), (5, 0, 1), (5, 1, 0)]
    docs = documents(texts)
    labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    held = labelled.fold_of("doc_id", 4) == 2
    for module, want in ((quality, lambda i: i % 4 != 0), (toxicity, lambda i: i % 5 == 1)):
        model = module.train(docs, labels, ~held)
        got = {r.doc_id: r for r in module.score(docs, model, held).collect()}
        assert len(got) == len(texts) and all(0 <= r.score <= 1 for r in got.values())
        test = [i for i in range(400) if got[i].held_out]
        assert np.mean([got[i].predicted == want(i) for i in test]) > 0.95
        assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
        untaught = module.train(docs, labels.limit(0), ~held)
        assert {r.score for r in module.score(docs, untaught, held).collect()} == {0.5}
        assert module.score(documents([]), model, held).count() == 0
    kept = quality.keep(docs, quality.train(docs, labels, ~held), 0.7)
    assert kept.columns == docs.columns


def test_splitter_of_token_counts_carries_no_vocabulary():
    """Tasks get a short description and do not parse the tokenizer's file for it."""
    spec, specials = token_counts._splitter_spec(BPE)
    text = "Don't  stop 12 times, é!"
    assert len(spec) < 20_000 and all(isinstance(s, str) for s in specials)
    split = Tokenizer.from_str(spec).pre_tokenizer.pre_tokenize_str(text)
    assert split == Tokenizer.from_file(BPE).pre_tokenizer.pre_tokenize_str(text)
