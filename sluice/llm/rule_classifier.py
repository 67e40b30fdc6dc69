"""Quality classifier: a sparse rule ensemble over text statistics.

Boosted trees are fitted on statistics of labelled texts; each path from a root is a conjunction of comparisons, so a rule.
A lasso logistic regression over all rules keeps few of them, and these are compiled into one Spark expression over the
statistics: scoring needs neither trees nor Python.

Learning takes at most max_labels labelled rows (a documented bound, by the smallest hashes of the id: all of them below the
bound); scoring covers all rows and whole texts. Statistics come from the quality rules' expressions, as ratios.

Defined cases: null and empty texts have statistics zero and get a score like any other; labelled rows without a text are
not learned from; repeated rows count as often as they occur; without two classes among the labels every score is the share
of ones (0.5 without labels); an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import hidden, stored
from sluice.llm.quality_rules import statistics

#: SQL of the features over the statistics of quality_rules.statistics().
FEATURES = {
    "log_words": "ln(1 + _n_words)",
    "word_length": "coalesce(try_divide(_word_chars, _n_words), 0)",
    "symbols": "coalesce(try_divide(_n_symbols, _n_words), 0)",
    "dup_lines": "coalesce(try_divide(_n_dup_lines, _n_lines), 0)",
    "repeats": "coalesce(try_divide(_n_repeat_words, _n_words), 0)",
    "stop_words": "coalesce(try_divide(_n_stop_words, _n_words), 0)",
    "ended_lines": "coalesce(try_divide(_n_ended_lines, _n_lines), 0)",
    "distinct_words": "coalesce(try_divide(_n_distinct_words, _n_words), 0)",
    "line_words": "coalesce(try_divide(_n_words, _n_lines), 0)",
}


@dataclass(frozen=True)
class Rule:
    """A conjunction of (feature, whether above, threshold)."""

    tests: tuple[tuple[str, bool, float], ...]

    def column(self) -> Column:
        each = [F.col(f) > F.lit(t) if above else F.col(f) <= F.lit(t) for f, above, t in self.tests]
        return reduce(lambda a, b: a & b, each)


@dataclass
class RuleModel:
    intercept: float
    weights: list[tuple[Rule, float]]

    def score(self) -> Column:
        """The probability of label 1, over columns named as the features."""
        total = F.lit(self.intercept)
        for rule, w in self.weights:
            total = total + F.when(rule.column(), F.lit(w)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def tree_rules(model: object, names: list[str]) -> list[Rule]:
    """The paths from the roots of a Spark ML tree ensemble, each inner step a rule too, without repeats."""
    found: dict[Rule, None] = {}

    def walk(node: object, path: tuple) -> None:
        if path:
            found[Rule(path)] = None
        if node.numDescendants() == 0:
            return
        split = node.split()
        name, t = names[split.featureIndex()], float(split.threshold())
        walk(node.leftChild(), _narrow(path, name, False, t))
        walk(node.rightChild(), _narrow(path, name, True, t))

    for tree in model.trees:
        walk(tree._call_java("rootNode"), ())
    return list(found)


def _narrow(path: tuple, name: str, above: bool, t: float) -> tuple:
    """The path with one more test; an older one of the same kind that it implies goes."""
    return tuple(sorted([p for p in path if (p[0], p[1]) != (name, above)] + [(name, above, t)]))


def features(df: DataFrame, text_col: str = "text", keep_cols: list[str] | None = None) -> DataFrame:
    """keep_cols (default: all of df) and the FEATURES, as doubles, stored: texts are read once."""
    cols = df.columns if keep_cols is None else keep_cols
    out = statistics(df, text_col).select(*cols, *(F.expr(x).cast("double").alias(n) for n, x in FEATURES.items()))
    return stored(out, "features")


def fit(rows: DataFrame, label_col: str, id_col: str, max_labels: int = 50_000, trees: int = 20, depth: int = 3, penalty: float = 0.001, seed: int = 7) -> RuleModel:
    """rows: features and labels (0 or 1). The trees and the lasso are Spark ML fits over at most max_labels rows."""
    names = list(FEATURES)
    rows = rows.where(F.col(label_col).isin(0, 1)).orderBy(F.xxhash64(id_col), id_col).limit(max_labels)
    rows = stored(rows.select(id_col, F.col(label_col).cast("double").alias("label"), *names), "labelled")
    n, ones = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    if ones in (0, n):
        share = (ones + 0.5) / (n + 1)
        return RuleModel(math.log(share / (1 - share)), [])
    # Classes weigh the same, so that few zeros are not drowned: scores are probabilities between classes of one size.
    weighed = rows.withColumn("weight", F.when(F.col("label") == 1, n / (2 * ones)).otherwise(n / (2 * (n - ones))))
    vectors = VectorAssembler(inputCols=names, outputCol="features").transform(weighed)
    gbt = GBTClassifier(maxIter=trees, maxDepth=depth, seed=seed, weightCol="weight", stepSize=0.3).fit(vectors)
    rules = tree_rules(gbt, names)
    marked = weighed.select("label", "weight", *(r.column().cast("double").alias(f"r{k}") for k, r in enumerate(rules)))
    matrix = VectorAssembler(inputCols=[f"r{k}" for k in range(len(rules))], outputCol="features").transform(marked)
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=penalty, weightCol="weight", standardization=False, maxIter=100).fit(matrix)
    weights = [(r, float(w)) for r, w in zip(rules, lasso.coefficients.toArray(), strict=True) if w]
    return RuleModel(float(lasso.intercept), weights)


def classify(df: DataFrame, labels: DataFrame, trains: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_labels: int = 50_000) -> DataFrame:
    """(id_col, score): the probability of label 1 for every row of df. labels: (id_col, label_col); trains: over id_col, says
    which rows are learned from."""
    has = hidden(df, "has_text")[0]
    rows = features(df.select(id_col, text_col, F.col(text_col).isNotNull().alias(has)), text_col, [id_col, has])
    known = rows.where(trains & F.col(has)).drop(has).join(labels.select(id_col, label_col), id_col)
    model = fit(known, label_col, id_col, max_labels)
    return rows.select(id_col, model.score().alias("score"))
