"""The operators' registered queries: each over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citysignal.llm import (
    align,
    decontam,
    jaccard,
    lattice,
    likelihood,
    lm,
    merkle,
    rules,
    secrets,
    tokencache,
    toolcalls,
    urls,
    warc,
)
from citysignal.llm.common import fold, read_table, scratch
from citysignal.session import configure

Query = Callable[[SparkSession, str], DataFrame]

PIECES = "piece_bpe_32k.model"
WORDS = "word_bpe_49k.json"
BYTES = "byte_bpe_50k.json"
TOKEN_LIMIT = 2048
URL_RULES = [
    urls.Rule("allow", "org", "/"),
    urls.Rule("block", "example.org", "/es/"),
    urls.Rule("block", "example.org", "/en/1"),
    urls.Rule("allow", "com", "/fr/"),
    urls.Rule("block", "com", "/de/"),
]
SUSPECT_WORDS = ("adult", "bets", "casino", "pills", "spam")
SUSPECT_PAGES = 5


def op1_pitman_yor_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(read_table(spark, sf_dir, "documents"))


def op2_sampled_segmentations(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path(PIECES)
    return lattice.encode(read_table(spark, sf_dir, "documents"), model, verify=True)


def op3_linked_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(read_table(spark, sf_dir, "documents"), "doc_id")
    size = lambda kind: F.size(f"in_{kind}").cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id",
        size("assign"),
        size("access"),
        size("hex"),
        F.sha2(secrets.spelled(F.col("base")), 256).alias("base_sha256"),
        secrets.spelled(F.col("spans")).alias("spans"),
    )


def op4_linked_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = toolcalls.from_conversations(read_table(spark, sf_dir, "conversations"))
    return toolcalls.link(messages, toolcalls.SEARCH)


def trusted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of the documents that the labels call good."""
    return read_table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")


def op5_likelihood_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    ratio = likelihood.weights(docs, trusted(spark, sf_dir), by_text=True)
    return likelihood.verdicts(docs, ratio, likelihood.THRESHOLD, "doc_id").select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def op6_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    labels = read_table(spark, sf_dir, "labels").where(fold("doc_id", 4) != 2)
    model = rules.fit(docs, labels.select("doc_id", F.col("quality").alias("label")))
    return rules.statistics(docs, "doc_id").select(
        "doc_id",
        (fold("doc_id", 4) == 2).alias("held_out"),
        model.score().alias("score"),
        (model.score() >= rules.DECIDE_AT).cast("int").alias("predicted"),
    )


def op7_benchmark_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontam.scan(docs, read_table(spark, sf_dir, "benchmark"))
    names = ("n_words", "n_hit", "n_items", "items_sha256")
    return found.select(
        "doc_id",
        *(F.col(f"found.{n}") for n in names),
        (F.col("found.n_hit") > 0).alias("contaminated"),
    )


def op8_salvaged_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = warc.write_pages(read_table(spark, sf_dir, "pages"), scratch(spark, "warc"))
    return warc.page_records(warc.read_archives(files)).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op9_cached_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = tokencache.token_counts(
        read_table(spark, sf_dir, "documents"),
        public_tokenizers.path(WORDS),
        scratch(spark, "token-cache"),
        chunked=True,
    )
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op10_jaccard_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.grouped(read_table(spark, sf_dir, "documents"))


def op11_url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    listed = urls.stored_list(urls.suspects(pages, SUSPECT_WORDS, SUSPECT_PAGES))
    return urls.judged(pages, URL_RULES, listed)


def op12_aligned_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").withColumn("doc_id", F.col("doc_id").cast("long"))
    return align.alignment(docs, public_tokenizers.path(BYTES), public_tokenizers.path(PIECES))


def op13_merkle_proofs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(read_table(spark, sf_dir, "documents"))


OPERATORS: tuple[Query, ...] = (
    op1_pitman_yor_scores,
    op2_sampled_segmentations,
    op3_linked_secrets,
    op4_linked_calls,
    op5_likelihood_rules,
    op6_rule_ensemble,
    op7_benchmark_hits,
    op8_salvaged_archives,
    op9_cached_token_counts,
    op10_jaccard_groups,
    op11_url_verdicts,
    op12_aligned_tokens,
    op13_merkle_proofs,
)


def _configured(operator: Query) -> Query:
    return lambda spark, sf_dir: operator(configure(spark), sf_dir)


QUERIES: dict[str, Query] = {q.__name__: _configured(q) for q in OPERATORS}
