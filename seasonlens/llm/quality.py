"""Quality classifier: a sparse ensemble of conjunctive rules over text statistics.

Shallow trees are grown on labelled rows; every path from a root to a node is a rule, a conjunction of bounds on
statistics. A lasso logistic regression weighs the rules, most to zero. What is left is compiled into one Spark
column expression over the statistics. Only a bounded sample of labelled rows is ever used to fit.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seasonlens.llm.arrow import with_columns
from seasonlens.session import stage

#: labelled rows to fit on at most; of more, those with the smallest hash of their id
SAMPLE_ROWS = 20_000
TREES, DEPTH, SHARE = 24, 3, 0.6
#: weight of the absolute sum of the rule weights against the mean log loss
LASSO = 0.001
SEED = 17
CUT = 0.3

STATISTICS = (
    "log_words", "word_length", "distinct_words", "line_length", "repeated_lines", "upper", "capitalised", "digits",
    "sentence_marks", "exclamation", "bars", "symbols", "white", "not_ascii",
)
PREFIX = "__stat_"
MADE = T.StructType([T.StructField(PREFIX + name, T.DoubleType(), False) for name in STATISTICS])


def statistics(text: str) -> tuple[float, ...]:
    """The values of ``STATISTICS`` of one whole text; shares are of its UTF-8 bytes, words or lines."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    words, lines = text.split(), text.split("\n")
    n_bytes, n_words = max(1, len(data)), max(1, len(words))
    counts = np.bincount(data, minlength=256)

    def share(chars: str) -> float:
        return float(sum(int(counts[ord(c)]) for c in chars)) / n_bytes

    upper = (data >= 65) & (data <= 90)
    white = (data == 32) | ((data >= 9) & (data <= 13))
    first = upper[1:] & white[:-1]
    capitals = int(first.sum()) + int(bool(len(upper)) and bool(upper[0]))
    return (
        math.log1p(len(words)),
        float(n_bytes - int(white.sum())) / n_words,
        len(set(words)) / n_words,
        math.log1p(n_bytes / len(lines)),
        1.0 - len(set(lines)) / len(lines),
        float(upper.sum()) / n_bytes,
        capitals / n_words,
        share("0123456789"),
        share(".,;:?"),
        share("!"),
        share("|"),
        share("#$%&*@^~<>{}[]=_/\\+"),
        float(white.sum()) / n_bytes,
        float((data >= 128).sum()) / n_bytes,
    )


def with_statistics(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    return with_columns(docs, text_col, MADE, lambda: statistics, keep)


@dataclass(frozen=True)
class Rule:
    """All of ``low < statistic <= high``, as (statistic, low, high) in the statistics' order."""

    bounds: tuple[tuple[int, float, float], ...]

    def column(self) -> Column:
        parts = []
        for at, low, high in self.bounds:
            value = F.col(PREFIX + STATISTICS[at])
            if low > -math.inf:
                parts.append(value > F.lit(low))
            if high < math.inf:
                parts.append(value <= F.lit(high))
        whole = parts[0]
        for part in parts[1:]:
            whole = whole & part
        return whole.cast("double")


@dataclass(frozen=True)
class RuleEnsemble:
    intercept: float
    weights: tuple[tuple[Rule, float], ...]

    def score(self) -> Column:
        """Probability of label 1, over the columns that ``with_statistics`` adds."""
        total = F.lit(self.intercept)
        for rule, weight in self.weights:
            total = total + rule.column() * F.lit(weight)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def tree_rules(root) -> list[Rule]:
    """One rule for every node below the root."""
    found, todo = [], [(root, {})]
    while todo:
        node, bounds = todo.pop()
        if bounds:
            found.append(Rule(tuple((at, *bounds[at]) for at in sorted(bounds))))
        if node.subtreeDepth() == 0:
            continue
        split = node.split()
        at, threshold = int(split.featureIndex()), float(split.threshold())
        low, high = bounds.get(at, (-math.inf, math.inf))
        todo.append((node.rightChild(), bounds | {at: (max(low, threshold), high)}))
        todo.append((node.leftChild(), bounds | {at: (low, min(high, threshold))}))
    return found


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that are never learnt from: one in five by the checksum of the id's text; a null id counts as one."""
    return F.crc32(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).cast("binary")) % 5 == 0


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label_col: str, id_col: str, text_col: str, sample_rows: int
) -> DataFrame:
    """Statistics and label of a bounded, repeatable sample of the rows to learn from."""
    chosen = (
        labels.select(F.col(f"`{id_col}`"), F.col(f"`{label_col}`").cast("double").alias("__label"))
        .filter(F.col("__label").isNotNull() & F.col(f"`{id_col}`").isNotNull() & ~held_out(id_col))
        .groupBy(id_col)
        .agg(F.max("__label").alias("__label"))
        .orderBy(F.xxhash64(F.col(f"`{id_col}`"), F.lit(SEED)), id_col)
        .limit(sample_rows)
    )
    rows = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`").cast("string").alias("__doc")).join(
        F.broadcast(chosen), id_col
    )
    return with_statistics(rows, [id_col, "__label"], "__doc")


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str = "quality",
    id_col: str = "doc_id",
    text_col: str = "text",
    sample_rows: int = SAMPLE_ROWS,
) -> RuleEnsemble:
    """Fit the ensemble; with labels of one kind only, or none, the score is a constant."""
    sample = stage(labelled_sample(docs, labels, label_col, id_col, text_col, sample_rows), "quality-sample")
    tally = {row["__label"]: row["count"] for row in sample.groupBy("__label").count().collect()}
    if len(tally) < 2:
        ones, rows = tally.get(1.0, 0), sum(tally.values())
        share = (ones + 1) / (rows + 2)
        return RuleEnsemble(math.log(share / (1 - share)), ())
    # the same rows in the same order on every run: bagging and sums depend on it
    ordered = sample.orderBy(id_col, *[f.name for f in MADE]).coalesce(4)
    vectors = VectorAssembler(inputCols=[f.name for f in MADE], outputCol="x").transform(ordered).select("__label", "x")
    vectors = vectors.persist()
    forest = RandomForestClassifier(
        labelCol="__label", featuresCol="x", numTrees=TREES, maxDepth=DEPTH, subsamplingRate=SHARE, minInstancesPerNode=5,
        featureSubsetStrategy="onethird", seed=SEED,
    ).fit(vectors)
    rules = list(dict.fromkeys(rule for tree in forest.trees for rule in tree_rules(tree._call_java("rootNode"))))
    vectors.unpersist()
    if not rules:
        ones, rows = tally.get(1.0, 0), sum(tally.values())
        return RuleEnsemble(math.log((ones + 1) / (rows - ones + 1)), ())
    names = [f"r{i}" for i in range(len(rules))]
    fired = ordered.select("__label", *[rule.column().alias(name) for rule, name in zip(rules, names)])
    fired = VectorAssembler(inputCols=names, outputCol="x").transform(fired).select("__label", "x").persist()
    lasso = LogisticRegression(
        labelCol="__label", featuresCol="x", elasticNetParam=1.0, regParam=LASSO, standardization=False, maxIter=60
    ).fit(fired)
    fired.unpersist()
    weights = tuple((rule, float(w)) for rule, w in zip(rules, lasso.coefficients.toArray()) if w)
    return RuleEnsemble(float(lasso.intercept), weights)


def quality_scores(
    docs: DataFrame, model: RuleEnsemble, id_col: str = "doc_id", text_col: str = "text", cut: float = CUT
) -> DataFrame:
    """id, held_out, score (0 to 1) and predicted (1 from ``cut`` on) of every row of ``docs``.

    A null text is an empty one and gets a score like any other; repeated rows get equal scores. Only the text
    enters the score. Other columns are ignored, whatever their names.
    """
    scored = with_statistics(docs, [id_col], text_col).withColumn("score", model.score())
    return scored.select(
        id_col, held_out(id_col).alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted")
    )


def good_rows(
    docs: DataFrame, model: RuleEnsemble, text_col: str = "text", cut: float = CUT
) -> DataFrame:
    """The rows of ``docs`` that the model accepts, with all their columns."""
    return with_statistics(docs, docs.columns, text_col).filter(model.score() >= cut).select(
        *[F.col(f"`{name}`") for name in docs.columns]
    )
