"""Quality classifier: a sparse ensemble of rules.

Shallow trees are grown on statistics of the labelled texts, every path from a root becomes a
conjunctive rule, a logistic model with an absolute-value penalty weighs the rules, and the
few that remain are compiled into one Spark column expression.

Statistics cover whole texts. Training uses at most ``MAX_TRAINING_ROWS`` labelled rows (chosen by
a hash when there are more); scoring is one narrow pass over all rows. Language, source and id
are never inputs of a score.

Defined cases: null and empty texts have all counts zero and get a score like any other; null
labels are ignored; without labels of both kinds the score is the share of label 1 (0.5
without labels); repeated rows get equal scores; further columns do not matter.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from wharf.llm.quality_rules import measured

MAX_TRAINING_ROWS = 200_000
TREES, DEPTH, PENALTY, SEED = 12, 3, 0.002, 7
STATISTICS = (
    "log_words",
    "chars_per_word",
    "symbols_per_word",
    "marks_per_word",
    "upper_share",
    "digit_share",
    "repeated_line_share",
    "repeated_word_share",
    "words_per_line",
)


def statistics(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` without its text, with one column per statistic; columns of their names are replaced."""
    rest = [F.col(f"`{c}`") for c in df.columns if c != text and c not in STATISTICS]
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))

    def count(pattern: str) -> Column:
        return F.regexp_count(body, F.lit(pattern)).cast("double")

    counted = df.select(
        *rest,
        measured(body).alias("__m"),
        count(r"\p{Lu}").alias("__upper"),
        count(r"[0-9]").alias("__digits"),
        count(r"[!?]").alias("__marks"),
    )

    def share(part: Column, of: Column) -> Column:
        return part.cast("double") / F.greatest(of, F.lit(1)).cast("double")

    m = F.col("__m")
    words, chars, lines = m["n_words"], m["word_chars"], m["n_lines"]
    return counted.select(
        *rest,
        F.log1p(words.cast("double")).alias("log_words"),
        share(chars, words).alias("chars_per_word"),
        share(m["n_symbols"], words).alias("symbols_per_word"),
        share(F.col("__marks"), words).alias("marks_per_word"),
        share(F.col("__upper"), chars).alias("upper_share"),
        share(F.col("__digits"), chars).alias("digit_share"),
        share(m["n_dup_lines"], lines).alias("repeated_line_share"),
        share(m["n_repeat_words"], words).alias("repeated_word_share"),
        share(words, lines).alias("words_per_line"),
    )


@dataclass(frozen=True)
class Condition:
    statistic: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = F.col(self.statistic)
        return value > self.threshold if self.above else value <= self.threshold


Rule = tuple[Condition, ...]


def _paths(node, taken: Rule, found: set[Rule]) -> None:
    """Every path below a tree node, each as the set of its conditions."""
    if taken:
        found.add(tuple(sorted(set(taken), key=lambda c: (c.statistic, c.above, c.threshold))))
    if node.subtreeDepth() == 0:
        return
    split = node.split()
    name, at = STATISTICS[split.featureIndex()], float(split.threshold())
    _paths(node.leftChild(), (*taken, Condition(name, False, at)), found)
    _paths(node.rightChild(), (*taken, Condition(name, True, at)), found)


def holds(rule: Rule) -> Column:
    out = rule[0].column()
    for condition in rule[1:]:
        out = out & condition.column()
    return out


@dataclass(frozen=True)
class RuleModel:
    intercept: float
    weighted: tuple[tuple[Rule, float], ...]

    def score(self) -> Column:
        """Probability of label 1, as a column over the statistics."""
        total = F.lit(self.intercept)
        for rule, weight in self.weighted:
            total = total + F.when(holds(rule), F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


@dataclass(frozen=True)
class Constant:
    value: float

    def score(self) -> Column:
        return F.lit(self.value)


def fit(labelled: DataFrame, label: str = "label", rows: int = MAX_TRAINING_ROWS) -> RuleModel | Constant:
    """Fit on statistics and a 0/1 label; ``labelled`` should be a stored table."""
    known = labelled.where(F.col(label).isin(0, 1)).select(*STATISTICS, F.col(label).cast("double").alias("label"))
    n, ones = known.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    if ones in (0, n):
        return Constant(ones / n if n else 0.5)
    if n > rows:
        spread = F.shiftrightunsigned(F.xxhash64(F.lit(SEED), *STATISTICS), 11) * F.lit(2.0**-53)
        known = known.where(spread < rows / n)
    sample = VectorAssembler(inputCols=list(STATISTICS), outputCol="x").transform(known).persist()
    forest = RandomForestClassifier(
        featuresCol="x", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=SEED, subsamplingRate=0.7
    ).fit(sample)
    found: set[Rule] = set()
    for tree in forest.trees:
        _paths(tree._call_java("rootNode"), (), found)
    ordered = sorted(found, key=repr)
    if not ordered:
        sample.unpersist()
        return Constant(ones / n)
    names = [f"r{i}" for i in range(len(ordered))]
    wide = known.select("label", *[holds(r).cast("double").alias(c) for r, c in zip(ordered, names)])
    vectors = VectorAssembler(inputCols=names, outputCol="x").transform(wide).select("label", "x").persist()
    model = LogisticRegression(
        featuresCol="x", labelCol="label", elasticNetParam=1.0, regParam=PENALTY, maxIter=60
    ).fit(vectors)
    vectors.unpersist()
    sample.unpersist()
    weights = model.coefficients.toArray().tolist()
    return RuleModel(float(model.intercept), tuple((r, w) for r, w in zip(ordered, weights) if w))
