"""Quality classifier: a sparse ensemble of rules over text statistics.

Paths of small trees are conjunctions of thresholds. Each is a 0/1 feature of a logistic
regression with an absolute-value penalty, which leaves few with a weight; those are compiled
into one Spark column expression, so scoring is a projection.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import text_or_empty, without_white_space, written
from tessera.llm.text_stats import lines_with_words, n_equal_earlier, words

#: At most so many labelled rows are learnt from, those with the smallest hash of their id.
TRAIN_ROWS = 20_000
N_TREES = 16
DEPTH = 3
PENALTY = 0.002

STATISTICS = (
    "log_words", "word_length", "upper_share", "symbol_share", "exclamation_share", "bar_share", "digit_share",
    "stop_share", "distinct_share", "stutter_share", "line_words", "dup_line_share", "comma_share", "letter_share",
)


def text_features(docs: DataFrame, *keep: str) -> DataFrame:
    """``keep`` and the STATISTICS of each whole text; all are 0 for a text without words."""
    text = F.col("text")

    def share(pattern: str, of: str) -> Column:
        return F.regexp_count(text, F.lit(pattern)) / F.greatest(F.col(of), F.lit(1))

    return (
        docs.select(*keep, text_or_empty().alias("text"))
        .select(*keep, "text", words(text).alias("words"), lines_with_words(text).alias("lines"),
                F.char_length(without_white_space(text)).alias("chars"))
        .withColumn("n", F.size("words"))
        .select(
            *keep, F.log1p("n").alias("log_words"), (F.col("chars") / F.greatest("n", F.lit(1))).alias("word_length"),
            share(r"\p{Lu}", "chars").alias("upper_share"), share(r"[#*$%&<>]", "n").alias("symbol_share"),
            share("!", "n").alias("exclamation_share"), share(r"\|", "n").alias("bar_share"), share("[0-9]", "chars").alias("digit_share"),
            share(r"[.?!](?=\s|\z)", "n").alias("stop_share"),
            (F.size(F.array_distinct("words")) / F.greatest("n", F.lit(1))).alias("distinct_share"),
            (F.size(F.filter("words", lambda w, i: (i > 0) & (w == F.get(F.col("words"), F.greatest(i - 1, F.lit(0))))))
             / F.greatest("n", F.lit(1))).alias("stutter_share"),
            (F.col("n") / F.greatest(F.size("lines"), F.lit(1))).alias("line_words"),
            (n_equal_earlier(F.col("lines")) / F.greatest(F.size("lines"), F.lit(1))).alias("dup_line_share"),
            share(",", "n").alias("comma_share"), share(r"[^\p{L}\s]", "chars").alias("letter_share"))
    )


@dataclass(frozen=True)
class Conjunction:
    """Conditions (statistic, is at most, threshold) that all hold."""

    conditions: tuple[tuple[str, bool, float], ...]

    def column(self) -> Column:
        return reduce(lambda a, b: a & b, [
            F.col(name) <= limit if at_most else F.col(name) > limit for name, at_most, limit in self.conditions])


def tree_paths(model, names: tuple[str, ...]) -> list[Conjunction]:
    """Every path from a root to another node of a fitted forest, without repeats."""
    found: dict[Conjunction, None] = {}

    def walk(node, path: dict[tuple[str, bool], float]) -> None:
        if path:
            found[Conjunction(tuple(sorted((name, low, limit) for (name, low), limit in path.items())))] = None
        if node.getClass().getSimpleName() != "InternalNode":
            return
        split = node.split()
        name, limit = names[split.featureIndex()], split.threshold()
        for child, low in ((node.leftChild(), True), (node.rightChild(), False)):
            tightest = min if low else max
            walk(child, path | {(name, low): tightest(limit, path.get((name, low), limit))})

    for tree in model.trees:
        walk(tree._java_obj.rootNode(), {})
    return list(found)


@dataclass(frozen=True)
class RuleEnsemble:
    """Weighted rules; the score of a text is the logistic function of their sum."""

    intercept: float
    rules: tuple[tuple[Conjunction, float], ...]

    def score(self) -> Column:
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            total = total + F.when(rule.column(), weight).otherwise(0.0)
        return 1 / (1 + F.exp(-total))


def fit_rules(sample: DataFrame, n_trees: int = N_TREES, depth: int = DEPTH, penalty: float = PENALTY, seed: int = 7) -> RuleEnsemble:
    """Fit on rows with the STATISTICS and a 0/1 ``label``; with one class or none, a constant score."""
    import math

    from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    counts = {int(r["label"]): r["count"] for r in sample.groupBy("label").count().collect()}
    rate = (counts.get(1, 0) + 1) / (sum(counts.values()) + 2)
    constant = RuleEnsemble(math.log(rate / (1 - rate)), ())
    if min(counts.get(0, 0), counts.get(1, 0)) < 2:
        return constant
    # the rarer class weighs as much as the other while trees look for it
    rare = 0 if counts[0] < counts[1] else 1
    ratio = counts[1 - rare] / counts[rare]
    weighted = sample.withColumn("weight", F.when(F.col("label") == rare, ratio).otherwise(1.0))
    packed = VectorAssembler(inputCols=list(STATISTICS), outputCol="statistics").transform(weighted)
    forest = RandomForestClassifier(
        featuresCol="statistics", labelCol="label", weightCol="weight", numTrees=n_trees, maxDepth=depth, maxBins=64,
        featureSubsetStrategy="onethird", seed=seed).fit(packed)
    rules = tree_paths(forest, STATISTICS)
    if not rules:
        return constant
    names = [f"r{k}" for k in range(len(rules))]
    fired = sample.select("label", *[r.column().cast("double").alias(n) for r, n in zip(rules, names, strict=True)])
    lasso = LogisticRegression(
        featuresCol="fired", labelCol="label", elasticNetParam=1.0, regParam=penalty, maxIter=60).fit(
        VectorAssembler(inputCols=names, outputCol="fired").transform(fired).select("fired", "label"))
    weights = lasso.coefficients.toArray()
    return RuleEnsemble(float(lasso.intercept), tuple(
        (rule, float(w)) for rule, w in zip(rules, weights, strict=True) if w != 0.0))


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 3 == 1


def train_quality(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> RuleEnsemble:
    """Learn ``labels.quality`` from at most ``rows`` labelled rows that are not held out."""
    chosen = (
        labels.select(F.col("doc_id").cast("long").alias("id"), F.col("quality").cast("int").alias("label"))
        .where("id is not null and label in (0, 1)").where(~held_out(F.col("id")))
        .orderBy(F.xxhash64("id"), "label").limit(rows))
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(
        F.broadcast(chosen), F.col("doc_id") == F.col("id")).select("doc_id", "label", "text")
    return fit_rules(written(text_features(known, "label"), "quality-sample"))


def classify_quality(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score, predicted.

    Every whole text is scored from its statistics alone. A null or empty text has all statistics
    0 and is scored from them; a null id counts as not held out. Labels that are null or other than
    0 and 1 are left out; without labels of both classes every score is the rate of label 1.
    Repeated rows get the same score. An empty table gives an empty result; extra columns are ignored.
    """
    model = train_quality(docs, labels, rows)
    scored = text_features(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "doc_id")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), model.score().alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int"))


def keep_good_documents(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """``docs`` without the rows whose text scores below 0.5, all columns as they came."""
    model = train_quality(docs, labels, rows)
    # the numbered row keeps the filter above the statistics; pushed below them, it would hold a
    # copy of a statistic for every condition of every rule
    rows = docs.select(F.struct("*").alias("__row"), "text")
    scored = text_features(rows, "__row").withColumn("__n", F.monotonically_increasing_id())
    return scored.where((model.score() >= 0.5) & (F.col("__n") >= 0)).select("__row.*")
