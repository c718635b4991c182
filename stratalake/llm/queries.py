"""The registered query of each operator, over its whole table with production parameters."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake import configure
from stratalake.llm import (
    chat,
    conversation_repair,
    decontamination,
    importance,
    language,
    lattice_lm,
    licenses,
    periodic_runs,
    pieces,
    quality_rules,
    sharding,
    simhash,
    url_filters,
)
from stratalake.llm.common import bounded, space_words, table
from stratalake.llm.piece_model import read_model

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

#: Folder of public vocabularies; read on the driver, never copied.
TOKENIZERS = "/opt/tokenizers"


def crc_of_id(modulus: int) -> str:
    return f"crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % {modulus}"


def query(function: Query) -> Query:
    @functools.wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(bounded(configure(spark)), sf_dir)

    QUERIES[function.__name__] = run
    return run


@query
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


@query
def op2_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = read_model(f"{TOKENIZERS}/piece_bpe_32k.model")
    scored = lattice_lm.score(table(spark, sf_dir, "documents"), model, f"{crc_of_id(10)} != 0")
    return scored.select(
        "doc_id", (~F.col("training")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


@query
def op7_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select("doc_id", *base, "base_failed", "kept", "score")


@query
def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = language.fit(documents, f"coalesce({crc_of_id(3)} != 1, true)")
    found = language.identify(documents, model)
    held_out = F.expr(f"coalesce({crc_of_id(3)} = 1, false)")
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query
def op9_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = pieces.encode(documents, f"{TOKENIZERS}/piece_bpe_32k.model")
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "parity", "round_trip")


@query
def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    trial = spark.range(2).select(
        F.lit(-7).alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(r"\### Assistant: </turn> ok").alias("text"),
    )
    trial = trial.select(*[F.col(f.name).cast(f.dataType) for f in conversations.schema])
    vocabulary = f"{TOKENIZERS}/byte_bpe_50k.json"
    formatted = chat.format_turns(conversations.unionByName(trial), vocabulary)
    return chat.read_back(formatted, vocabulary)


@query
def op5_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(table(spark, sf_dir, "documents").select("doc_id"), "doc_id")


def with_paths(documents: DataFrame) -> DataFrame:
    """Documents as files: by source, blocks of 64 and of 8 ids; the first of a block is its licence file."""
    top = F.concat_ws("/", F.coalesce("source", F.lit("none")), F.expr("CAST(doc_id DIV 64 AS STRING)"))
    inner = F.concat_ws("/", top, F.expr("CAST(doc_id DIV 8 % 8 AS STRING)"))
    return documents.withColumn(
        "path",
        F.when(F.col("doc_id") % 64 == 0, F.concat(top, F.lit("/LICENSE")))
        .when(F.col("doc_id") % 8 == 0, F.concat(inner, F.lit("/LICENSE.txt")))
        .otherwise(F.concat(inner, F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt"))),
    )


@query
def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = with_paths(table(spark, sf_dir, "documents")).select("doc_id", "path", "text")
    return licenses.scan(files).select("doc_id", "path", "license", "score", "inherited_from")


#: The rules that fit a host and its subdomains, the longest first heard.
HOST_RULES = [
    url_filters.HostRule("org", "/", url_filters.ALLOW),
    url_filters.HostRule("example.org", "/es/", url_filters.BLOCK),
    url_filters.HostRule("example.org", "/en/1", url_filters.BLOCK),
    url_filters.HostRule("com", "/fr/", url_filters.ALLOW),
    url_filters.HostRule("com", "/de/", url_filters.BLOCK),
]


@query
def op11_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filters.judge(table(spark, sf_dir, "pages"), HOST_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


@query
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    repaired = conversation_repair.repair(conversation_repair.damaged(conversations), conversations)
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return repaired.select("conv_id", *counts, "audit", "repaired_sha256", "n_rows", "n_repaired")


def with_loops(documents: DataFrame) -> DataFrame:
    """Documents of which a tenth, by a hash of the id, repeats some of its words from a place on."""
    words = space_words(F.col("text"))
    h = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(1).cast("long"))
    looped = F.when(h % 10 == 0, words).otherwise(F.array().cast("array<string>"))
    drawn = documents.select("doc_id", "text", F.floor(h / 10).cast("long").alias("g"), looped.alias("w"))
    n = F.size("w").cast("long")
    a = F.expr("IF(size(w) > 0, g % size(w), 0)")
    drawn = drawn.withColumns({"a": a.cast("int"), "p": (1 + F.floor((n - a) / (3 + F.col("g") % 8))).cast("int")})
    again = F.transform(F.sequence(F.lit(0), F.size("w") - F.col("a") - 1), lambda j: F.get("w", F.col("a") + j % F.col("p")))
    text = F.concat_ws(" ", F.slice("w", F.lit(1), F.col("a")), again)
    return drawn.select("doc_id", F.when(F.size("w") > 0, text).otherwise(F.col("text")).alias("text"))


@query
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.find(with_loops(table(spark, sf_dir, "documents").select("doc_id", "text")))
    # Runs are by start and period: the first of the greatest length / period stays.
    best = F.reduce(
        "runs",
        F.get("runs", F.lit(0)),
        lambda a, r: F.when(r["length"] * a["period"] > a["length"] * r["period"], r).otherwise(a),
    )
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    found = found.withColumn("best", best)
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")],
        F.expr("best.length * 1000 DIV best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
        "n_words",
    )
