"""Corpus pipeline: five stages over ``documents``, each stored and read again for the next.

Quality rules drop documents, near duplicates leave one document a group, benchmark
passages are cut out (documents that are mostly benchmark go), secrets are replaced by a mark,
and the last stage gives the ids of sampled segmentations of what is left. All stages but the last return
the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from citysignal.llm import decontam, jaccard, lattice, likelihood, secrets
from citysignal.llm.common import read_table, written
from citysignal.llm.queries import PIECES, trusted
from citysignal.session import configure


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ratio = likelihood.weights(docs, trusted(spark, sf_dir), by_text=True)
    return likelihood.filtered(docs, ratio)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.representatives(docs)


def benchmark_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def secret_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


# What a worker remembers and the characters it searches side by side, less than where no earlier
# stage has left workers beside it.
MEMO = 100_000
TOGETHER = 400_000


def segmentations(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return lattice.encode(docs, public_tokenizers.path(PIECES), memo=MEMO, together=TOGETHER)


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("benchmark spans", benchmark_spans),
    ("secret spans", secret_spans),
    ("segmentations", segmentations),
]

# Hashing words with xxHash and sampling from a seed have no SQL form; the stages are tested
# against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the documents below ``sf_dir``."""
    docs = read_table(configure(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
