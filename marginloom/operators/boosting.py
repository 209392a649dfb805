"""Boosted trees under a loss of one's own, with the rounds' losses and the trees' nodes as tables.

A round is three things that Spark does over all rows: columns with the gradient and the curvature of the loss at
the score so far, a weighted regression tree fitted on their quotient, and one aggregate that gives the loss
after every step length tried, for training and validation rows at once. The driver holds the trees and one line per round.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressionModel, DecisionTreeRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marginloom.session import shared_dir
from marginloom.sources.tables import materialize

#: Rounds after which the scores so far are written, so that a lost executor repeats no more than these.
WRITE_EVERY = 10
#: Least curvature of the log loss, reached by rows scored as good as certain.
MIN_CURVATURE = 1e-6


@dataclass(frozen=True)
class AsymmetricSquare:
    """Squared error, ``penalty`` times as dear where the actual value exceeds the score."""

    penalty: float = 20.0

    def start(self, y: Column, w: Column) -> Column:
        return F.sum(w * y) / F.sum(w)

    def curvature(self, y: Column, f: Column) -> Column:
        return F.when(y > f, F.lit(float(self.penalty))).otherwise(1.0)

    def step(self, y: Column, f: Column) -> Column:
        return y - f

    def value(self, y: Column, f: Column) -> Column:
        return self.curvature(y, f) * (y - f) * (y - f)


@dataclass(frozen=True)
class LogLoss:
    """Log loss of a 0/1 target; the score is the log odds."""

    def start(self, y: Column, w: Column) -> Column:
        p = F.greatest(F.least(F.sum(w * y) / F.sum(w), F.lit(1 - MIN_CURVATURE)), F.lit(MIN_CURVATURE))
        return F.log(p / (1 - p))

    def curvature(self, y: Column, f: Column) -> Column:
        p = 1 / (1 + F.exp(-f))
        return F.greatest(p * (1 - p), F.lit(MIN_CURVATURE))

    def step(self, y: Column, f: Column) -> Column:
        return (y - 1 / (1 + F.exp(-f))) / self.curvature(y, f)

    def value(self, y: Column, f: Column) -> Column:
        return F.greatest(f, F.lit(0.0)) - y * f + F.log1p(F.exp(-F.abs(f)))


@dataclass
class Boosted:
    """Fitted trees: score = ``base`` + the sum of step times tree. ``history`` has (round, step, train_loss, valid_loss)."""

    features: list[str]
    base: float
    steps: list[float] = field(default_factory=list)
    trees: list[DecisionTreeRegressionModel] = field(default_factory=list)
    history: list[tuple[int, float, float, float | None]] = field(default_factory=list)

    def transform(self, df: DataFrame, out: str = "score") -> DataFrame:
        """``df`` with the score (log odds under ``LogLoss``). Features without a value are an error, as in training."""
        rows = _assembled(df.select(F.struct("*").alias("_row"), *self.features), self.features).select("_row", "_features", F.lit(self.base).alias("_f"))
        for step, tree in zip(self.steps, self.trees):
            rows = tree.transform(rows).select("_row", "_features", (F.col("_f") + step * F.col("_tree")).alias("_f"))
        return rows.select(*[F.col("_row")[c].alias(c) for c in df.columns if c != out], F.col("_f").alias(out))

    def probability(self, df: DataFrame, out: str = "score", threshold: float = 0.5) -> DataFrame:
        scored = self.transform(df, out).withColumn(out, 1 / (1 + F.exp(-F.col(out))))
        return scored.withColumn("predicted_class", (F.col(out) > threshold).cast("int"))

    def rounds(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.history, "round int, step double, train_loss double, valid_loss double")

    def save(self, spark: SparkSession, path: str) -> None:
        """Trees first, the file that names them last: a half-written model can't be loaded."""
        for i, tree in enumerate(self.trees):
            tree.write().overwrite().save(f"{path}/trees/{i:05d}")
        about = {"features": self.features, "base": self.base, "steps": self.steps, "history": self.history}
        spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/about")


def load(spark: SparkSession, path: str) -> Boosted:
    about = json.loads(spark.read.text(f"{path}/about").first()[0])
    trees = [DecisionTreeRegressionModel.load(f"{path}/trees/{i:05d}") for i in range(len(about["steps"]))]
    return Boosted(about["features"], about["base"], about["steps"], trees, [tuple(h) for h in about["history"]])


def _assembled(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol="_features").transform(df)


def _written(df: DataFrame, folder: str, round_: int) -> DataFrame:
    return materialize(df, f"{folder}/round-{round_:05d}")


def fit(train: DataFrame, features: Sequence[str], target: str, loss, weight: str | None = None, valid: DataFrame | None = None,
        rounds: int = 200, steps: Sequence[float] = (0.1,), depth: int = 6, patience: int = 50, bins: int = 32,
        min_rows: int = 1, seed: int = 42) -> Boosted:
    """Trees that lower ``loss``, one per round, each taken by the one of ``steps`` that lowers the training loss most.

    With ``valid`` training ends when ``patience`` rounds haven't lowered its loss, and the trees after its lowest loss are
    dropped. Without it training ends after ``rounds``. Rows without a target or with a weight that isn't positive teach nothing;
    without any row left ``ValueError`` is raised. Losses are weighted means.

    Rows alike in features, target and weight teach the same, so they are counted once and then go through the rounds as one row
    of their summed weight. With ``min_rows`` above 1, which counts rows, they stay apart.
    """
    marked = [(train, False)] + ([(valid, True)] if valid is not None else [])
    parts = [p.select(*features, F.col(target).cast("double").alias("_y"), (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("_w"),
                      F.lit(v).alias("_valid")).where("_y IS NOT NULL AND _w > 0") for p, v in marked]
    stacked = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    if min_rows <= 1:
        alike = stacked.groupBy(*features, "_y", "_w", "_valid").agg(F.count(F.lit(1)).alias("_n"))
        stacked = alike.withColumn("_w", F.col("_w") * F.col("_n"))
    spark = train.sparkSession
    folder = f"{shared_dir(spark).rstrip('/')}/boosting-{uuid.uuid4().hex}"
    data = _written(_assembled(stacked, features).select("_features", "_y", "_w", "_valid"), folder, 0)
    y, w, f, t = (F.col(c) for c in ("_y", "_w", "_f", "_tree"))
    base, n = data.where("NOT _valid").agg(loss.start(y, w), F.count(F.lit(1))).first()
    if not n:
        raise ValueError("no row to learn from")
    out = Boosted(list(features), float(base))
    rows = data.withColumn("_f", F.lit(out.base)).persist()
    learner = DecisionTreeRegressor(featuresCol="_features", labelCol="_step", weightCol="_curve", predictionCol="_tree", maxDepth=depth,
                                    maxBins=bins, minInstancesPerNode=min_rows, seed=seed)
    best, best_at = float("inf"), 0
    for i in range(1, rounds + 1):
        tree = learner.fit(rows.where("NOT _valid").select("_features", loss.step(y, f).alias("_step"), (w * loss.curvature(y, f)).alias("_curve")))
        stepped = tree.transform(rows).persist()
        mean = [(F.sum(w * loss.value(y, f + s * t)) / F.sum(w)).alias(f"s{j}") for j, s in enumerate(steps)]
        losses = {r["_valid"]: r for r in stepped.groupBy("_valid").agg(*mean).collect()}  # one row per part
        taken = min(range(len(steps)), key=lambda j: losses[False][f"s{j}"])
        held = losses[True][f"s{taken}"] if True in losses else None
        out.trees.append(tree)
        out.steps.append(float(steps[taken]))
        out.history.append((i, float(steps[taken]), losses[False][f"s{taken}"], held))
        after = stepped.select("_features", "_y", "_w", "_valid", (f + float(steps[taken]) * t).alias("_f"))
        if i % WRITE_EVERY == 0:
            after = _written(after, folder, i)
        after = after.persist()
        after.count()
        for old in (rows, stepped):
            old.unpersist()
        rows = after
        if held is not None and held < best:
            best, best_at = held, i
        if held is not None and i - best_at >= patience:
            break
    rows.unpersist()
    if best_at:
        out.trees, out.steps = out.trees[:best_at], out.steps[:best_at]
    return out


def node_table(spark: SparkSession, path: str, features: Sequence[str]) -> DataFrame:
    """The nodes of a saved model: round, node, feature (NULL: a leaf), threshold, gain, weight, n, prediction, left and right node.

    ``gain`` is the fall of the variance per unit of weight, so gain times weight is what the split takes off the loss's
    second-order form. ``n`` counts the rows of the rounds: those that ``fit`` took together are one.
    """
    raw = spark.read.parquet(f"{path}/trees/*/data")
    node = F.col("nodeData") if "nodeData" in raw.columns else F.struct(*raw.columns)
    names = F.array(*[F.lit(c) for c in features])
    flat = raw.select(node.alias("d"), F.regexp_extract(F.col("_metadata.file_path"), r"/trees/([0-9]+)/data", 1).cast("int").alias("round"))
    split = F.col("d.leftChild") >= 0
    return flat.select(
        (F.col("round") + 1).alias("round"), F.col("d.id").alias("node"), F.when(split, F.get(names, F.col("d.split.featureIndex"))).alias("feature"),
        F.when(split, F.get("d.split.leftCategoriesOrThreshold", F.lit(0))).alias("threshold"), F.when(split, F.col("d.gain")).alias("gain"),
        F.get("d.impurityStats", F.lit(0)).alias("weight"), F.col("d.rawCount").alias("n"), F.col("d.prediction").alias("prediction"),
        F.when(split, F.col("d.leftChild")).alias("left_node"), F.when(split, F.col("d.rightChild")).alias("right_node"))


def gain_importance(nodes: DataFrame, features: Sequence[str]) -> DataFrame:
    """Total gain per feature as a share of all: one row per feature, those that no tree splits on with 0."""
    spark = nodes.sparkSession
    known = spark.createDataFrame([(f,) for f in features], "feature string")
    gains = nodes.where("feature IS NOT NULL").groupBy("feature").agg(F.sum(F.col("gain") * F.col("weight")).alias("gain"), F.count(F.lit(1)).alias("splits"))
    per = known.join(gains, "feature", "left").select("feature", F.coalesce("gain", F.lit(0.0)).alias("total_gain"),
                                                      F.coalesce("splits", F.lit(0)).alias("splits"))
    total = per.agg(F.sum("total_gain")).scalar()
    return per.select("feature", "total_gain", "splits", F.coalesce(F.try_divide("total_gain", total), F.lit(0.0)).alias("importance"))
