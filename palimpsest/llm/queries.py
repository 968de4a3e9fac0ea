"""One query per operator of this folder, over the whole tables, with the parameters of production."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, functions as F

from palimpsest.llm import (
    conversation_repair,
    decontamination,
    exact_dedup,
    labelled,
    licenses,
    near_dedup,
    packing,
    periodic_runs,
    quality,
    substring_dedup,
    token_counts,
    toxicity,
    url_filter,
    window_packing,
)
from palimpsest.llm.common import prepared, table
from palimpsest.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(prepared(spark), sf_dir)

    QUERIES[function.__name__] = run
    return run


def tokenizer(name: str) -> str:
    """The place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_exact_dedup(spark, sf_dir):
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    index = exact_dedup.DigestIndex(f"digests_{uuid4().hex}", scratch_path(spark, "digest-index"), buckets)
    found = exact_dedup.dedup(table(spark, sf_dir, "documents"), index, batch="documents")
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


#: Rules of the query.  Fixed values of its contract.
BLOCK_RULES = ["net/", "example.com/de/"]
ALLOW_RULES = ["example.net/en/", "org/fr/"]
#: Block list of the query: hosts whose pages are blocked where no rule fits.
BLOCKED_HOSTS = ["cheap-pills.example.com/", "spam-farm.example.org/", "casino.example.com/", "casino.example.org/"]


@query
def op3_url_filters(spark, sf_dir):
    found = url_filter.judge(table(spark, sf_dir, "pages"), BLOCK_RULES, ALLOW_RULES, BLOCKED_HOSTS)
    return found.select("page_id", "host", "path", "rule", "verdict")


@query
def op6_token_counts(spark, sf_dir):
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), limit=1024)


@query
def op7_best_fit_packing(spark, sf_dir):
    found = packing.pack_documents(
        table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), tokenizer("byte_bpe_50k.tiktoken"), end_id=2, size=1024
    )
    return found.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query
def op4_toxicity(spark, sf_dir):
    docs, held_out = table(spark, sf_dir, "documents"), labelled.fold_of("doc_id", 5) == 0
    lexicon = toxicity.train(docs, table(spark, sf_dir, "labels"), use=~held_out)
    return toxicity.score(docs, lexicon, held_out, threshold=0.5)


@query
def op8_quality_classifier(spark, sf_dir):
    docs, held_out = table(spark, sf_dir, "documents"), labelled.fold_of("doc_id", 4) == 2
    machine = quality.train(docs, table(spark, sf_dir, "labels"), use=~held_out)
    return quality.score(docs, machine, held_out, threshold=0.7)


@query
def op2_decontamination(spark, sf_dir):
    found = decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("starts", "ends")


@query
def op9_license_scans(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents"))


@query
def op10_ngram_jaccard_join(spark, sf_dir):
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op5_suffix_array_dedup(spark, sf_dir):
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


@query
def op11_window_packing(spark, sf_dir):
    paths = tokenizer("byte_bpe_50k.json"), tokenizer("byte_bpe_50k.tiktoken")
    return window_packing.pack_windows(table(spark, sf_dir, "documents"), *paths, end_id=1, size=2048)


def damaged(conversations):
    """The rows of conversations with the faults that op12's contract puts into them."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.crc32(key) % 20).alias("kind"))
    kind = F.col("kind")
    return rows.filter(kind != 0).select(
        "conv_id", "turn",
        F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    )


@query
def op12_conversation_repair(spark, sf_dir):
    conversations = table(spark, sf_dir, "conversations")
    found = conversation_repair.summaries(conversation_repair.repaired(damaged(conversations)))
    found = found.withColumnRenamed("conv_id", "found_id")
    every = conversations.select("conv_id").distinct()
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return every.join(found, F.col("conv_id").eqNullSafe(F.col("found_id")), "left").select(
        "conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def planted(docs):
    """``doc_id, text`` with the periods that op13's contract puts into a tenth of the documents."""
    h = F.crc32(F.col("doc_id").cast("string"))
    chosen = (h % 10 == 0) & (F.trim("text", F.lit(" \t\n\x0b\x0c\r")) != "")
    words = F.when(chosen, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    rows = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), words.alias("words"))
    n = F.size("words")
    rows = rows.withColumn("a", (F.col("g") % n).cast("int"))
    rows = rows.withColumn("p", 1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8)).cast("int"))
    period = F.slice("words", F.col("a") + 1, F.col("p"))
    times = F.ceil((n - F.col("a")) / F.col("p")).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(period, times)), F.lit(1), n - F.col("a"))
    text = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), tail), " ")
    return rows.select("doc_id", F.when(F.col("words").isNull(), F.col("text")).otherwise(text).alias("text"))


@query
def op13_periodic_runs(spark, sf_dir):
    found = periodic_runs.periodic_runs(planted(table(spark, sf_dir, "documents")))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "longest.start", "longest.length", "longest.period",
        F.expr("(1000 * longest.length) div longest.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
