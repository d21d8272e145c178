"""Quality classifier: a sparse ensemble of rules over text statistics.

1. Statistics of each text are column expressions.
2. Boosted trees of small depth are fit to the labels (Spark ML); every path from a root to
   a node below it is a rule: a conjunction of comparisons of statistics.
3. A logistic regression with lasso penalty weighs the rules; most weights become 0.
4. The rules that are left are compiled into one column expression that gives the score.

Fitting uses at most ``SAMPLE_ROWS`` labelled rows, those with the smallest hash of their
id: a bounded sample, so its ids may be broadcast. Scoring covers every row and runs
without Python. Null texts are empty ones; texts without words get their own score from
the same rules. With fewer than two classes in the sample the score is the share of class
1 (0.5 without rows). Repeated rows score alike; other columns are not read.
"""

from __future__ import annotations

import functools
import math
import operator

from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citysignal.llm.common import NO_SPACES, UPPER, cut_lineage, only, text_of, words_of

SAMPLE_ROWS = 20_000
FIT_PARTITIONS = 4
TREES = 12
DEPTH = 3
LASSO = 0.002
DECIDE_AT = 0.7

Condition = tuple[str, bool, float]  # statistic, at most (else above), bound
Rule = tuple[Condition, ...]


def statistics(docs: DataFrame, *keep: str) -> DataFrame:
    """The kept columns and a struct ``s`` of statistics, all doubles."""
    text = F.col("body")
    base = only(docs, "text", *keep).select(*keep, text_of().alias("body")).withColumn("words", words_of(text))
    chars = F.greatest(F.char_length(text), F.lit(1))
    count = F.greatest(F.size("words"), F.lit(1))
    without = lambda chars: F.char_length(text) - F.char_length(F.translate(text, chars, ""))
    lines = F.filter(F.split(text, "\n"), lambda line: F.rlike(line, F.lit(NO_SPACES)))
    named = {
        "words": F.size("words"),
        "word_length": F.char_length(text) / count,
        "upper": without(UPPER) / chars,
        "digits": without("0123456789") / chars,
        "symbols": without("#*$%&|<>") / chars,
        "stops": without(".,;:") / count,
        "shouts": without("!?") / count,
        "other_marks": without("@=_~^/\\+-\"'()[]{}") / count,
        "distinct": F.size(F.array_distinct("words")) / count,
        "line_words": F.size("words") / F.greatest(F.size(lines), F.lit(1)),
        "dup_lines": (F.size(lines) - F.size(F.array_distinct(lines)))
        / F.greatest(F.size(lines), F.lit(1)),
    }
    columns = [F.round(v.cast("double"), 6).alias(k) for k, v in named.items()]
    return base.select(*keep, F.struct(*columns).alias("s"))


STATISTICS = (
    "words", "word_length", "upper", "digits", "symbols", "stops", "shouts", "other_marks",
    "distinct", "line_words", "dup_lines",
)


def sample(labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """The labelled rows with the smallest hash of their id; one label an id (the lowest)."""
    return (
        only(labels, "doc_id", "label")
        .where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )


def paths(text: str) -> list[Rule]:
    """All rules in a tree's printed form: one for each node below the root."""
    found: list[Rule] = []
    above: list[tuple[int, Condition]] = []
    for line in text.splitlines():
        words = line.replace("(", " ").replace(")", " ").split()
        if words[:1] not in (["If"], ["Else"]):
            continue
        depth = len(line) - len(line.lstrip())
        while above and above[-1][0] >= depth:
            above.pop()
        above.append((depth, (STATISTICS[int(words[2])], words[3] == "<=", float(words[4]))))
        found.append(tuple(condition for _, condition in above))
    return found


def holds(rule: Rule) -> Column:
    parts = [
        F.col(f"s.{name}") <= bound if at_most else F.col(f"s.{name}") > bound
        for name, at_most, bound in rule
    ]
    return functools.reduce(operator.and_, parts)


class Ensemble:
    """Weighted rules; ``score`` is a column over the struct ``s`` of ``statistics``."""

    def __init__(self, intercept: float, rules: list[tuple[Rule, float]]):
        self.intercept, self.rules = intercept, rules

    def score(self) -> Column:
        terms = [F.when(holds(rule), F.lit(w)).otherwise(F.lit(0.0)) for rule, w in self.rules]
        total = functools.reduce(operator.add, terms, F.lit(self.intercept))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))

    def __str__(self) -> str:
        said = [f"{self.intercept:+.3f}"]
        for rule, w in self.rules:
            said.append(f"{w:+.3f} if " + " and ".join(f"{n} {'<=' if m else '>'} {b:g}" for n, m, b in rule))
        return "\n".join(said)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    rows: int = SAMPLE_ROWS,
    trees: int = TREES,
    depth: int = DEPTH,
    lasso: float = LASSO,
) -> Ensemble:
    """``labels``: doc_id and label (0 or 1) of rows that may be learned from."""
    chosen = sample(labels, rows).select(F.col("doc_id").alias("labelled_id"), "label")
    texts = only(docs, "doc_id", "text").join(
        F.broadcast(chosen), F.col("doc_id") == F.col("labelled_id")
    )
    # The sample is small by its bound: a few partitions keep the many passes of fitting short.
    known = statistics(texts, "label").select("label", "s.*").repartition(FIT_PARTITIONS)
    known = cut_lineage(known)
    shares = known.agg(F.count(F.lit(1)).alias("n"), F.avg("label").alias("mean")).first()
    if not shares.n or shares.mean in (0.0, 1.0):
        mean = min(max(shares.mean if shares.n else 0.5, 1e-6), 1 - 1e-6)
        return Ensemble(math.log(mean / (1 - mean)), [])
    vectors = VectorAssembler(inputCols=list(STATISTICS), outputCol="x").transform(known)
    boosted = GBTClassifier(
        featuresCol="x", labelCol="label", maxIter=trees, maxDepth=depth, maxBins=64, seed=7,
        subsamplingRate=0.7, featureSubsetStrategy="onethird", minInstancesPerNode=10,
    ).fit(vectors)
    rules = list(dict.fromkeys(r for tree in boosted.trees for r in paths(tree.toDebugString)))
    if not rules:
        return Ensemble(math.log(shares.mean / (1 - shares.mean)), [])
    named = known.select("label", F.struct(*STATISTICS).alias("s"))
    fired = named.select(
        "label", *(holds(r).cast("double").alias(f"r{i}") for i, r in enumerate(rules))
    )
    fired = cut_lineage(
        VectorAssembler(inputCols=[f"r{i}" for i in range(len(rules))], outputCol="fired")
        .transform(fired)
        .select("label", "fired")
    )
    weighed = LogisticRegression(
        featuresCol="fired", labelCol="label", elasticNetParam=1.0, regParam=lasso, maxIter=40
    ).fit(fired)
    kept = [(r, float(w)) for r, w in zip(rules, weighed.coefficients, strict=True) if w]
    return Ensemble(float(weighed.intercept), kept)
