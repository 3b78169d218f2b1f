"""Quality classifier: a sparse ensemble of rules.

Statistics of the whole text are Spark columns.  Shallow trees of a random forest propose
rules, the conjunctions on the paths from their roots; a logistic regression with a lasso
penalty weighs the rules and drops most of them; what is left is compiled into one
Spark column.  Trees and weights are fitted by Spark on all labelled rows.

Defined results: null and blank texts count as empty and have statistics 0, so they are
scored like any other text; a row whose label is null teaches nothing; without labelled rows
the score is 0.5 everywhere, with one class only it is that class's share (smoothed
by one row of each class); equal texts get equal scores, repeated rows of ``docs`` one each; an
empty table gives an empty result.  ``doc_id`` is only a key; only it, ``text`` and the
labels' ``doc_id, label`` are read, other columns may have any name.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import freeze

LINE = re.compile(r"( *)(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)")


def statistics(text: Column) -> dict[str, Column]:
    """The statistics of a text that rules may use, in fixed order."""
    t = F.coalesce(text, F.lit(""))
    n = F.greatest(F.length(t), F.lit(1)).cast("double")
    lines = F.split(t, "\n")
    words = F.filter(F.split(F.regexp_replace(t, r"[\t-\r]", " "), " "), lambda w: w != "")
    n_words = F.greatest(F.size(words), F.lit(1)).cast("double")

    def share(pattern: str) -> Column:
        return F.regexp_count(t, F.lit(pattern)) / n

    return {
        "chars": F.log1p(F.length(t).cast("double")),
        "words": F.log1p(F.size(words).cast("double")),
        "word_length": F.length(t) / n_words,
        "distinct_words": F.size(F.array_distinct(words)) / n_words,
        "distinct_lines": F.size(F.array_distinct(lines)) / F.size(lines).cast("double"),
        "repeats": F.size(
            F.filter(F.zip_with(words, F.slice(words, 2, F.greatest(F.size(words), F.lit(1))), lambda a, b: a == b), lambda x: x)
        )
        / n_words,
        "line_length": F.log1p(n / F.size(lines)),
        "digits": share("[0-9]"),
        "capitals": share("[A-Z]"),
        "symbols": share(r"[#$%&*@<>{}\[\]\\^~=+_/|]"),
        "bars": share(r"\|"),
        "stops": share("[.,;:]"),
        "shouts": share("[!?]"),
        "blanks": share(r"\s"),
    }


@dataclass(frozen=True)
class Rule:
    """A conjunction of conditions (statistic, above, threshold)."""

    conditions: tuple[tuple[str, bool, float], ...]

    def column(self) -> Column:
        return reduce(
            lambda a, b: a & b, [(F.col(s) > F.lit(t)) if above else (F.col(s) <= F.lit(t)) for s, above, t in self.conditions]
        )


@dataclass
class RuleEnsemble:
    rules: list[Rule]
    weights: list[float]
    bias: float

    def score(self) -> Column:
        """Probability of label 1 from the statistics columns."""
        total = reduce(
            lambda a, b: a + b,
            [F.when(r.column(), F.lit(w)).otherwise(0.0) for r, w in zip(self.rules, self.weights)],
            F.lit(self.bias),
        )
        return 1.0 / (1.0 + F.exp(-total))


def tree_rules(description: str, names: list[str]) -> set[Rule]:
    """Every path from the root of a described tree, inner nodes included."""
    found: set[Rule] = set()
    path: list[tuple[int, tuple[str, bool, float]]] = []
    for line in description.splitlines():
        m = LINE.fullmatch(line)
        if not m:
            continue
        depth = len(m[1])
        path = [p for p in path if p[0] < depth]
        path.append((depth, (names[int(m[2])], m[3] == ">", float(m[4]))))
        tight: dict[tuple[str, bool], float] = {}
        for _, (s, above, t) in path:
            tight[s, above] = (max if above else min)(t, tight.get((s, above), t))
        found.add(Rule(tuple(sorted((s, above, t) for (s, above), t in tight.items()))))
    return found


def fit(labelled: DataFrame, names: list[str], trees: int = 30, depth: int = 3, penalty: float = 0.002, seed: int = 11) -> RuleEnsemble:
    """Fit on ``labelled(label, statistics...)``."""
    counts = {int(r["label"]): r["count"] for r in labelled.groupBy("label").count().collect()}  # 0 and 1
    if not counts:
        return RuleEnsemble([], [], 0.0)
    if len(counts) == 1:
        return RuleEnsemble([], [], math.log((counts.get(1, 0) + 1) / (counts.get(0, 0) + 1)))
    rows = VectorAssembler(inputCols=names, outputCol="features").transform(labelled).select("label", "features", *names)
    forest = RandomForestClassifier(
        labelCol="label", numTrees=trees, maxDepth=depth, subsamplingRate=0.7, featureSubsetStrategy="0.5", seed=seed
    ).fit(rows)
    rules = sorted(set().union(*[tree_rules(t.toDebugString, names) for t in forest.trees]), key=lambda r: r.conditions)
    held = rows.select("label", F.array(*[F.when(r.column(), 1.0).otherwise(0.0) for r in rules]).alias("held"))
    held = freeze(held.select("label", "held"), "quality-rules").select("label", array_to_vector("held").alias("features"))
    lasso = LogisticRegression(labelCol="label", elasticNetParam=1.0, regParam=penalty, maxIter=60).fit(held)
    kept = [(r, float(w)) for r, w in zip(rules, lasso.coefficients.toArray()) if w]
    return RuleEnsemble([r for r, _ in kept], [w for _, w in kept], float(lasso.intercept))


def score_texts(docs: DataFrame, labels: DataFrame, learn: Column) -> DataFrame:
    """``docs(doc_id, text)`` with its ``score``, learned from the rows of
    ``labels(doc_id, label)`` where ``learn`` (a condition on doc_id) holds.  The text
    is read once."""
    stats = statistics(F.col("text"))
    table = freeze(docs.select("doc_id", *[c.alias(n) for n, c in stats.items()]), "quality-statistics")
    known = labels.filter(learn & F.col("label").isin(0, 1)).select("doc_id", F.col("label").cast("double"))
    labelled = freeze(table.join(known, "doc_id").drop("doc_id"), "quality-labelled")
    model = fit(labelled, list(stats))
    return table.select("doc_id", model.score().alias("score"))
