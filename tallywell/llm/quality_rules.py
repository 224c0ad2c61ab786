"""Quality classifier: a sparse ensemble of rules over text statistics.

Shallow trees are grown on the statistics of labelled texts. Every path from a
root to a node is a rule, a conjunction of bounds on statistics. A logistic
model with lasso weights keeps few of the rules, and the kept ones become one
Spark column expression, so scoring is a projection over the whole table.

The fit uses at most about ``SAMPLE_ROWS`` labelled rows, chosen by a hash of
their id; this bound is a parameter. Scoring covers every whole text.

Cases: a null or empty text has statistics 0 and a score like any other; labels
without a class, or for no document, are left out; several labels of one id
count as their mean, 1 from one half; with labels of one class, or none, every
score is that class's share (one half without labels); repeated rows are scored
each; a null id is held out.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywell.llm.rows import quoted, unused
from tallywell.session import staged

#: Bound on the labelled rows the fit reads, trees and their depth, weight of the lasso penalty.
SAMPLE_ROWS, TREES, DEPTH, PENALTY, SEED = 20_000, 16, 3, 0.002, 7
HASHES = 1_000_000


def statistics(text: Column) -> dict[str, Column]:
    """Statistics of a text, each a number from 0 up."""
    whole = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(whole, r"\s+"), lambda w: w != "")
    lines = F.split(whole, "\n")
    letters = F.greatest(F.length(whole), F.lit(1))
    count = F.greatest(F.size(words), F.lit(1))

    def share(pattern: str) -> Column:
        return F.regexp_count(whole, F.lit(pattern)) / letters

    return {
        "words": F.log1p(F.size(words).cast("double")),
        "word_length": F.length(whole) / count,
        "symbols": share(r"[^\p{L}\p{N}\s.,;:'\"-]"),
        "capitals": share(r"\p{Lu}"),
        "digits": share(r"\p{N}"),
        "sentences": F.regexp_count(whole, F.lit(r"[.!?](?=\s|$)")) / count,
        "distinct_words": F.size(F.array_distinct(words)) / count,
        "distinct_lines": F.size(F.array_distinct(lines)) / F.size(lines),
    }


STATISTICS = ["words", "word_length", "symbols", "capitals", "digits", "sentences", "distinct_words",
              "distinct_lines"]


@dataclass(frozen=True)
class Rule:
    """Statistics with the bounds they lie in: low < value <= high."""
    bounds: tuple[tuple[str, float, float], ...]

    def column(self, prefix: str = "") -> Column:
        parts = []
        for name, low, high in self.bounds:
            own = F.col(quoted(prefix + name))
            parts += [own > low] if low > -math.inf else []
            parts += [own <= high] if high < math.inf else []
        return reduce(Column.__and__, parts)


@dataclass
class RuleModel:
    intercept: float
    rules: list[tuple[Rule, float]]

    def score(self, prefix: str = "") -> Column:
        total = F.lit(float(self.intercept))
        for rule, weight in self.rules:
            total = total + F.when(rule.column(prefix), weight).otherwise(0.0)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


TEST = re.compile(r"\s*(If|Else) \(feature (\d+) (<=|>) (\S+)\)")


def tree_rules(printed: str, names: list[str]) -> list[Rule]:
    """Rules of all paths of a printed tree."""
    found, path = [], []
    for line in printed.splitlines():
        test = TEST.match(line)
        if not test:
            continue
        depth = len(line) - len(line.lstrip())
        path = [p for p in path if p[0] < depth]
        path.append((depth, names[int(test[2])], test[3], float(test[4])))
        bounds: dict[str, list[float]] = {}
        for _, name, side, cut in path:
            low, high = bounds.setdefault(name, [-math.inf, math.inf])
            bounds[name] = [low, min(high, cut)] if side == "<=" else [max(low, cut), high]
        found.append(Rule(tuple(sorted((n, a, b) for n, (a, b) in bounds.items()))))
    return found


def held_out(doc: Column) -> Column:
    """Rows that no fit may read: crc32 of the id as text is divisible by 5."""
    return F.crc32(F.coalesce(doc.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def labelled(docs: DataFrame, labels: DataFrame, label_col: str, sample_rows: int, id_col: str, text_col: str) -> DataFrame:
    """Statistics and label of the rows to fit on, staged."""
    doc = F.col(quoted(id_col))
    usable = (labels.where(doc.isNotNull() & F.col(quoted(label_col)).isNotNull() & ~held_out(doc))
              .groupBy(doc.alias("own_id")).agg((F.avg(quoted(label_col)) >= 0.5).cast("double").alias("own_label")))
    total = usable.count()
    if total > sample_rows:
        usable = usable.where(F.pmod(F.xxhash64("own_id", F.lit(SEED)), F.lit(HASHES)) < int(HASHES * sample_rows / total))
    # At most about sample_rows pairs of numbers, so each task can hold them all.
    chosen = (docs.select(doc.alias("own_id"), F.col(quoted(text_col)).cast("string").alias("own_text"))
              .join(F.broadcast(usable), "own_id"))
    found = chosen.select("own_id", "own_label", *[c.alias(n) for n, c in statistics(F.col("own_text")).items()])
    # Rows of numbers, as many as the bound says; in one order, so the forest's draws do not depend on tasks.
    return staged(found.repartition(1).sortWithinPartitions("own_id", *STATISTICS), "quality-sample")


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", sample_rows: int = SAMPLE_ROWS,
        trees: int = TREES, depth: int = DEPTH, penalty: float = PENALTY, id_col: str = "doc_id",
        text_col: str = "text") -> RuleModel:
    sample = labelled(docs, labels, label_col, sample_rows, id_col, text_col)
    mean = sample.agg(F.avg("own_label")).first()[0]
    if mean is None or mean in (0.0, 1.0):
        share = 0.5 if mean is None else min(max(mean, 1e-3), 1 - 1e-3)
        return RuleModel(math.log(share / (1 - share)), [])
    rows = VectorAssembler(inputCols=STATISTICS, outputCol="features").transform(sample)
    forest = RandomForestClassifier(labelCol="own_label", numTrees=trees, maxDepth=depth, seed=SEED,
                                    featureSubsetStrategy="onethird").fit(rows)
    rules = list(dict.fromkeys(r for tree in forest.trees for r in tree_rules(tree.toDebugString, STATISTICS)))
    if not rules and any(tree.depth for tree in forest.trees):
        raise ValueError("the printed trees have no path that can be read")
    if not rules:
        return RuleModel(math.log(mean / (1 - mean)), [])
    names = [f"rule_{k}" for k in range(len(rules))]
    held = sample.select("own_label", *[r.column().cast("double").alias(n) for r, n in zip(rules, names)])
    held = VectorAssembler(inputCols=names, outputCol="features").transform(held).select("own_label", "features")
    lasso = LogisticRegression(labelCol="own_label", regParam=penalty, elasticNetParam=1.0, standardization=False,
                               maxIter=60, tol=1e-6).fit(held)
    weights = zip(rules, map(float, lasso.coefficients.toArray()))
    return RuleModel(float(lasso.intercept), [(r, w) for r, w in weights if abs(w) > 1e-9])


def score_quality(docs: DataFrame, model: RuleModel, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with the score from 0 to 1 as a further column; it takes the place of a column of its name."""
    prefix = unused("quality_statistic_", docs.columns)
    known = docs.select("*", *[c.alias(prefix + n) for n, c in statistics(F.col(quoted(text_col)).cast("string")).items()])
    return known.select(*[F.col(quoted(c)) for c in docs.columns if c.lower() != score_col.lower()], model.score(prefix).alias(score_col))
