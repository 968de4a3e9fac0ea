"""Toxicity: a weighted lexicon, matched by Aho-Corasick in folded text.

Texts are folded first: case, accents, look-alike letters of other scripts, and digits and signs that stand for
letters inside words.  Words with letters beyond ASCII are also kept as they are written (lower case, composed),
since an accent can tell a mark from a harmless word.  The lexicon holds whole words and beginnings of words of
both forms; a term's weight is the smoothed log ratio of its rates per word in toxic and other documents of a
bounded labelled sample (``SAMPLE_ROWS``), so stray uses in long clean documents do not strike it out.  All terms
and the exception phrases are searched at once; a match inside an exception phrase does not count.  A written form
adds only what its weight is above that of its folded form, so no word counts twice.  The sum of the weights is
divided by the square root of the number of words, so length does not make a text toxic, and a logistic curve
fitted on the same sample turns it into the score.

Term statistics are aggregates of Spark; the lexicon is cut to ``MAX_TERMS``, a size of the model, so it can be
sent to all executors.  Scoring is one pass over the texts without a shuffle.

Defined cases: a null or empty text has no match and the lowest score; without labelled rows the lexicon is
empty and every score is 0.5; repeated rows come out as often as they occur; other columns are ignored.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from palimpsest.llm.common import documents_of
from palimpsest.llm.labelled import training_sample
from palimpsest.session import stored

#: Labelled rows a model is fitted on at most, terms of a lexicon at most.
SAMPLE_ROWS, MAX_TERMS = 20_000, 4_000
MIN_TOXIC, MIN_WEIGHT = 5, 2.0
#: A term's weight, less so many standard errors of it, has to reach ``MIN_WEIGHT``.
ERRORS = 1.645
SHORTEST, LONGEST = 4, 9
#: Look-alikes.  Fixed values.
LOOKALIKES = {
    "а": "a", "в": "b", "е": "e", "ё": "e", "з": "3", "і": "i", "ї": "i", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p",
    "с": "c", "ѕ": "s", "т": "t", "у": "y", "х": "x", "ј": "j", "ԁ": "d", "ԛ": "q", "ԝ": "w", "һ": "h", "ь": "b",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
    "ı": "i", "ɑ": "a", "ɡ": "g", "ⅼ": "l", "ß": "ss", "ø": "o", "ł": "l", "đ": "d",
}
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i"}
#: Phrases in which a term is meant otherwise.
EXCEPTIONS = ("class clown", "clown fish", "trash can", "trash bin", "sore loser", "loser tree", "scum line")


def letter_map() -> dict[int, str]:
    """Every letter with an accent, a width or a look-alike form, to its plain letter."""
    table = dict(LOOKALIKES)
    for code in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00), *range(0xFF21, 0xFF5B), *range(0x1D400, 0x1D6A4)]:
        plain = "".join(c for c in unicodedata.normalize("NFKD", chr(code)) if not unicodedata.combining(c)).lower()
        if plain.isascii() and plain.isalpha():
            table.setdefault(chr(code), plain)
    return {ord(k): v for k, v in table.items()} | {ord(k.upper()): v for k, v in LOOKALIKES.items() if len(k.upper()) == 1}


def forms():
    """Both forms of one text: folded (plain lower-case words, everything else a blank), and the words that have
    letters beyond ASCII as they are written."""
    import re

    letters = letter_map()
    substitutes = {ord(k): v for k, v in SUBSTITUTES.items()}
    mixed = re.compile(r"(?=[^\s]*[a-z])(?=[^\s]*[0134578@$!])[a-z0-9@$!]+")
    # Signs at the end of a word are marks, those before or between letters stand for letters.
    inside = re.compile(r"[0134578@$!](?=[a-z0-9@$!]*[a-z])|(?<=[a-z])[0134578@$](?![0-9])")
    signs = re.compile(r"[0134578@$!]").search
    other = re.compile(r"[^a-z]+")
    # Marks belong to the words of scripts that write vowels with them.
    marks = "".join(chr(c) for c in range(0x300, 0x10000) if unicodedata.category(chr(c))[0] == "M")
    written = re.compile(rf"(?:[^\W\d_]|[{marks}])+")

    def substitute(match):
        return inside.sub(lambda m: m[0].translate(substitutes), match[0])

    def both(text: str) -> tuple[str, str]:
        text, exact = text.lower(), ""
        if not text.isascii():
            beyond = unicodedata.normalize("NFC", " ".join([w for w in text.split() if not w.isascii()]))
            exact = " ".join([w for w in written.findall(beyond) if not w.isascii()])
            text = text.translate(letters)
            if not text.isascii() and any("̀" <= c <= "ͯ" for c in text):
                text = "".join(c for c in text if not "̀" <= c <= "ͯ")
        # No match goes beyond a blank, and most words have no sign in them.
        text = " ".join([w if w.isalpha() or not signs(w) else mixed.sub(substitute, w) for w in text.split()])
        return other.sub(" ", text).strip(), exact

    return both


def folder():
    """Folds one text: plain lower-case words, everything else a blank."""
    both = forms()
    return lambda text: both(text)[0]


@dataclass
class Lexicon:
    """Weights of whole words (``"word "``) and beginnings of words (``"stem"``); slope and offset of the curve."""

    weights: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = EXCEPTIONS
    slope: float = 0.0
    offset: float = 0.0

    def automaton(self):
        import ahocorasick

        found = ahocorasick.Automaton()
        fold = folder()
        for term, weight in self.weights.items():
            if term.isascii():
                found.add_word(f" {term}", (len(term) + 1, weight, False))
            else:
                plain = f"{fold(term)} " if term.endswith(" ") else fold(term)
                above = weight - max((self.weights.get(plain[:n], 0.0) for n in range(1, len(plain) + 1)), default=0.0)
                if above > 0:
                    found.add_word(f" {term}", (len(term) + 1, above, True))
        for phrase in self.exceptions:
            found.add_word(f" {phrase} ", (len(phrase) + 2, None, False))
        found.make_automaton()
        return found


def density(automaton, folded: str, exact: str = "") -> float:
    """Weights of all matches, one per word and form, by the square root of the number of words."""
    text = f" {folded} "
    best: dict[int, float] = {}
    excused: list[tuple[int, int]] = []
    for end, (length, weight, _) in automaton.iter(text) if len(automaton) else ():
        at = end - length + 1
        if weight is None:
            excused.append((at, end))
        elif weight > best.get(at, 0.0):
            best[at] = weight
    for a, b in excused:
        for at in [x for x in best if a <= x < b]:
            del best[at]
    above: dict[int, float] = {}
    for end, (length, weight, beyond) in automaton.iter(f" {exact} ") if exact and len(automaton) else ():
        at = end - length + 1
        if beyond and weight > above.get(at, 0.0):
            above[at] = weight
    if not best and not above:
        return 0.0
    return (sum(best.values()) + sum(above.values())) / n_words(folded, exact) ** 0.5


def n_words(folded: str, exact: str) -> int:
    """Words of a text; scripts without a folded form have written words only."""
    return max(folded.count(" "), exact.count(" ")) + 1


def _beginning(n: int, word: Column) -> Column:
    return F.when(F.length(word) > n, F.substring(word, 1, n))


def terms(words: Column) -> Column:
    """Words and beginnings of words; of words with letters beyond ASCII, those that have such letters."""
    # One argument only: Spark would give a second one the place of the word.
    stems = [F.transform(words, partial(_beginning, n)) for n in range(SHORTEST, LONGEST + 1)]
    whole = F.transform(words, lambda w: F.when(F.length(w) >= SHORTEST - 1, F.concat(w, F.lit(" "))))
    beyond = F.transform(words, lambda w: ~w.rlike("^[a-z]*$"))
    found = [F.zip_with(t, beyond, lambda t, b: F.when(~b | ~t.rlike("^[a-z ]*$"), t)) for t in (whole, *stems)]
    return F.filter(F.concat(*found), lambda t: t.isNotNull())


def fit(sample: DataFrame) -> Lexicon:
    """A lexicon from ``text, label``; the sample is bounded."""

    def fold_all(batches):
        both = forms()
        for batch in batches:
            texts = [both(t or "") for t in batch.column(1).to_pylist()]
            columns = [pa.array([t[k] for t in texts], pa.string()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *columns, pa.array([n_words(*t) for t in texts], pa.int64())], ["label", "folded", "exact", "n"]
            )

    rows = stored(sample.select("label", "text").mapInArrow(fold_all, "label int, folded string, exact string, n bigint"), "folded-sample")
    sizes = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.sum("n").alias("n")).collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not clean:
        return Lexicon()
    words = F.concat(F.split("folded", " "), F.split("exact", " "))
    uses = (
        rows.select("label", F.explode(words).alias("word"))
        .groupBy("word")
        .agg(F.sum("label").alias("bad"), F.sum(1 - F.col("label")).alias("good"))
        .select(F.explode(terms(F.array("word"))).alias("term"), "bad", "good")
        .groupBy("term")
        .agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
        .filter("bad > 0")
    )
    documents = (
        rows.filter("label = 1")
        .select(F.explode(F.array_distinct(terms(F.array_distinct(words)))).alias("term"))
        .groupBy("term")
        .agg(F.count("*").alias("documents"))
        .filter(F.col("documents") >= MIN_TOXIC)
    )
    weight = F.log((F.col("bad") + 0.5) / (toxic + 1)) - F.log((F.col("good") + 0.5) / (clean + 1))
    # Rare terms need to be purer: chance gives many of them.  Uses in one document are no independent ones.
    error = F.sqrt(1 / F.col("documents") + 1 / (F.col("good") + 1))
    counted = (
        uses.join(documents, "term")
        .withColumn("weight", weight)
        .filter(F.col("weight") - ERRORS * error >= MIN_WEIGHT)
        .orderBy(F.desc("documents"), "term")
        .limit(8 * MAX_TERMS)
    )
    # Needless terms go before the lexicon is cut to size.
    pruned = _pruned({r["term"]: (r["documents"], r["weight"]) for r in counted.select("term", "documents", "weight").collect()})
    lexicon = Lexicon({term: pruned[term][1] for term in sorted(pruned, key=lambda t: (-pruned[t][0], t))[:MAX_TERMS]})
    # The curve: the sample's densities, two numbers per row of a bounded sample.
    found = rows.select("label", "folded", "exact").mapInArrow(_densities(lexicon, folded=True), "label int, density double").toPandas()
    lexicon.slope, lexicon.offset = _curve(found["density"].to_numpy(), found["label"].to_numpy().astype(float))
    return lexicon


def _pruned(found: dict[str, tuple[int, float]]) -> dict[str, tuple[int, float]]:
    """Without terms that a beginning of theirs of no less weight makes needless; of term to documents and weight."""
    kept: dict[str, tuple[int, float]] = {}
    for term in sorted(found, key=len):
        starts = (kept[term[:n]][1] for n in range(SHORTEST, len(term)) if term[:n] in kept)
        if found[term][1] > max(starts, default=-1.0) * 0.98:
            kept[term] = found[term]
    return kept


def _densities(lexicon: Lexicon, folded: bool):
    """First column and density; the next columns are a text, or both its forms."""

    def run(batches):
        automaton, both = lexicon.automaton(), forms()
        for batch in batches:
            if folded:
                pairs = zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)
            else:
                pairs = (both(t or "") for t in batch.column(1).to_pylist())
            values = [density(automaton, *pair) for pair in pairs]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(values, pa.float64())], [batch.schema.names[0], "density"]
            )

    return run


def _curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve through (x, y), by Newton steps with a little shrinkage."""
    design = np.column_stack([np.log1p(x), np.ones(len(x))])
    beta = np.zeros(2)
    shrink = np.diag([1e-2, 1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        slope = design.T @ (p - y) + shrink @ beta
        curve = design.T @ (design * (p * (1 - p))[:, None]) + shrink + 1e-9 * np.eye(2)
        step = np.linalg.solve(curve, slope)
        beta -= np.clip(step, -5, 5)
        if abs(step).max() < 1e-6:
            break
    return float(beta[0]), float(beta[1])


def train(docs: DataFrame, labels: DataFrame, use: Column, rows: int = SAMPLE_ROWS) -> Lexicon:
    return fit(training_sample(docs, labels, "toxic", use, rows))


def score(docs: DataFrame, lexicon: Lexicon, held_out: Column, threshold: float = 0.5) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``."""
    found = documents_of(docs).mapInArrow(_densities(lexicon, folded=False), "doc_id bigint, density double")
    value = 1 / (1 + F.exp(-(F.lit(lexicon.slope) * F.log1p("density") + F.lit(lexicon.offset))))
    return found.select("doc_id", held_out.alias("held_out"), value.alias("score"), (value >= threshold).cast("int").alias("predicted"))
