"""License scans: exact set-similarity join of text blocks with license templates, and the phrases themselves.

A block is a sentence of a line.  A template is found in a block that has at least ``threshold`` of the
template's distinct words.  The words of all templates are ordered by the number of blocks that hold them, the
rarest first.  A template of ``n`` words of which ``k`` are needed must share one of its ``n - k + 1`` rarest
with the block (prefix filter), the block needs ``k`` words (length filter), and what is left on both sides after
a shared word must suffice (positional filter); survivors are intersected exactly.

Templates are a stated list, so their words, order and prefixes are a bounded table.  Blocks without enough
template words are dropped before anything is exploded, and common words are in no prefix, so neither a frequent
word nor a frequent line makes many candidates.  Everything is SQL functions.

Defined cases: a null or empty text has no words and no labels, score 0; repeated rows come out as often as they
occur; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from palimpsest.llm.common import WORD, documents_of, lower_ascii
from palimpsest.session import stored

#: Phrases and their labels.  Fixed values of the query's contract.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)
#: License statements and their labels.
TEMPLATES = (
    ("this work is licensed under the gnu general public license version 3", "gpl-3.0"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "gpl"),
    ("licensed under the apache license version 2 0", "apache-2.0"),
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit"),
    ("licensed under cc by nc 4 0", "cc-by-nc-4.0"),
    ("licensed under cc by 4 0", "cc-by-4.0"),
    ("this work is licensed under a creative commons attribution 4 0 international license", "cc-by-4.0"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl-2.0"),
    ("this work has been dedicated to the public domain", "public-domain"),
    ("all rights reserved", "all-rights-reserved"),
)
THRESHOLD = 0.9
#: Ends of blocks: line breaks, and sentence marks before white space.
BLOCK_END = r"[\r\n]+|[.!?;][\x20\t]+"


def needed(words: int, threshold: float) -> int:
    return ceil(round(threshold * words, 9))


def block_words(docs: DataFrame, templates, threshold: float) -> DataFrame:
    """``doc_id, text_key, block, n, words``: blocks with enough template words, and which these are."""
    vocabulary = sorted({w for text, _ in templates for w in text.split()})
    least = min(needed(len(set(text.split())), threshold) for text, _ in templates)
    blocks = F.split(lower_ascii(F.col("text")), BLOCK_END)
    held = F.transform(
        blocks,
        lambda b: F.array_distinct(F.filter(F.regexp_extract_all(b, F.lit(f"({WORD})"), F.lit(1)), lambda w: w.isin(vocabulary))),
    )
    return (
        docs.select("doc_id", "text_key", F.posexplode(held).alias("block", "words"))
        .filter(F.size("words") >= least)
    )


def template_join(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, text_key, block, label, share`` of every template found in a block of ``doc_id, text, text_key``."""
    spark = docs.sparkSession
    blocks = stored(block_words(docs, templates, threshold), "license-blocks")
    counted = blocks.select(F.explode("words").alias("word")).groupBy("word").count()
    # At most one row per word of the stated templates.
    frequency = {r["word"]: r["count"] for r in counted.collect()}
    vocabulary = sorted({w for text, _ in templates for w in text.split()}, key=lambda w: (frequency.get(w, 0), w))
    rank = {w: k for k, w in enumerate(vocabulary)}
    prefixes = _prefixes(spark, templates, threshold, rank)
    ranks = F.array_sort(F.transform("words", lambda w: F.array_position(F.array(*map(F.lit, vocabulary)), w).cast("int") - 1))
    ordered = blocks.select("doc_id", "text_key", "block", ranks.alias("ranks"))
    first = ordered.select("*", F.posexplode("ranks").alias("j", "word"))
    left = F.least(F.size("template") - F.col("i"), F.size("ranks") - F.col("j"))
    candidates = (
        first.join(F.broadcast(prefixes), "word")
        .filter((F.size("ranks") >= F.col("need")) & (left >= F.col("need")))
        .dropDuplicates(["doc_id", "text_key", "block", "number"])
    )
    shared = F.size(F.array_intersect("ranks", "template"))
    return candidates.filter(shared >= F.col("need")).select(
        "doc_id", "text_key", "block", "label", (shared / F.size("template")).alias("share")
    )


def _prefixes(spark: SparkSession, templates, threshold: float, rank: dict[str, int]) -> DataFrame:
    """One row per prefix word of a template: a table as bounded as the list of templates."""
    rows = []
    for number, (text, label) in enumerate(templates):
        ranks = sorted({rank[w] for w in text.split()})
        need = needed(len(ranks), threshold)
        rows += [(word, number, label, i, need, ranks) for i, word in enumerate(ranks[: len(ranks) - need + 1])]
    return spark.createDataFrame(rows, "word int, number int, label string, i int, need int, template array<int>")


def phrase_places(phrase: str) -> Column:
    """Numbers of the words of ``w`` at which a phrase starts; looked for only where ``joined`` has it."""
    parts = phrase.split()
    places = F.filter(
        F.sequence(F.lit(0), F.size("w") - len(parts)),
        lambda i: reduce(lambda a, b: a & b, [F.get(F.col("w"), i + k) == part for k, part in enumerate(parts)]),
    )
    return F.when(F.col("joined").contains(f" {phrase} "), places).otherwise(F.array().cast("array<int>"))


def scan(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD, phrases=PHRASES,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score`` for every row of ``docs``."""
    docs = documents_of(docs, id_col, text_col).withColumn("text", F.coalesce("text", F.lit("")))
    docs = docs.withColumn("text_key", F.xxhash64("text"))
    split = docs.select("doc_id", "text_key", F.regexp_extract_all(lower_ascii(F.col("text")), F.lit(f"({WORD})"), F.lit(1)).alias("w"))
    joined = split.withColumn("joined", F.concat(F.lit(" "), F.array_join("w", " "), F.lit(" ")))
    places = joined.select(
        "doc_id", "text_key", F.size("w").cast("long").alias("n_words"),
        *(phrase_places(phrase).alias(f"p{k}") for k, (phrase, _) in enumerate(phrases)),
    )
    columns = [F.col(f"p{k}") for k in range(len(phrases))]
    everywhere = F.concat(*columns)
    label = F.array(*(F.when(F.size(c) > 0, F.lit(name)) for c, (_, name) in zip(columns, phrases, strict=True)))
    base = places.select(
        "doc_id", "text_key", "n_words",
        F.size(everywhere).cast("long").alias("n_base"),
        F.array_min(everywhere).cast("long").alias("first_word"),
        F.array_max(everywhere).cast("long").alias("last_word"),
        F.array_sort(F.array_distinct(F.array_compact(label))).alias("base"),
    )
    found = template_join(docs, templates, threshold).groupBy("doc_id", "text_key").agg(
        F.collect_set("label").alias("own"), F.max("share").alias("share")
    )
    same = base["doc_id"].eqNullSafe(found["doc_id"]) & (base["text_key"] == found["text_key"])
    none = F.array().cast("array<string>")
    return base.join(found, same, "left").select(
        base["doc_id"], "n_words", "n_base", "first_word", "last_word",
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", F.coalesce("own", none))), ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
    )
