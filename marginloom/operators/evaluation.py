"""Score evaluation and delivery-promise reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginloom.operators.binning import bin_list, fixed_bin
from marginloom.operators.ordered import running_totals


def decile_report(df: DataFrame, score: str, actual: str, edges: Sequence[float], scale: float = 1.0) -> DataFrame:
    """Per score bin: rows, positives, rate and salience. Salience divides by all rows, also unbinned ones."""
    grouped = (df.groupBy(fixed_bin(F.col(score), edges).alias("bin"))
               .agg(F.count(F.lit(1)).alias("n"), F.sum(actual).cast("bigint").alias("positives")))
    total = grouped.agg(F.sum("n")).scalar()
    return (bin_list(df, edges).join(grouped, "bin", "left")
            .select("bin", "bin_lo", "bin_hi", F.coalesce("n", F.lit(0)).alias("n"),
                    F.coalesce("positives", F.lit(0)).alias("positives"))
            .withColumn("rate", F.try_divide(F.col("positives") * F.lit(scale), F.col("n")))
            .withColumn("salience", F.col("n") * F.lit(scale) / total))


def high_risk_salience(deciles: DataFrame, thresholds: Sequence[float]) -> DataFrame:
    """Salience % and event rate % over bins whose rate exceeds each threshold (rates as fractions)."""
    def over(t: float) -> Column:
        return F.col("rate") > t

    wide = deciles.agg(*[a for i, t in enumerate(thresholds) for a in (
        (F.coalesce(F.sum(F.when(over(t), F.col("salience"))), F.lit(0.0)) * 100).alias(f"s{i}"),
        F.try_divide(F.sum(F.when(over(t), F.col("positives"))) * 100.0,
                     F.sum(F.when(over(t), F.col("n")))).alias(f"r{i}"))])
    rows = F.array(*[F.struct(F.lit(float(t)).alias("threshold"), F.col(f"s{i}").alias("salience_pct"),
                              F.col(f"r{i}").alias("event_pct")) for i, t in enumerate(thresholds)])
    return wide.select(F.inline(rows))


def classify(score: str | Column, threshold: float) -> Column:
    s = F.col(score) if isinstance(score, str) else score
    return (s > threshold).cast("int")


def confusion_matrix(df: DataFrame, actual: str, score: str, threshold: float) -> DataFrame:
    return (df.groupBy(F.col(actual).alias("actual"), classify(score, threshold).alias("predicted"))
            .agg(F.count(F.lit(1)).alias("n")))


def classification_report(df: DataFrame, actual: str, score: str, threshold: float) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, macro and weighted averages."""
    m = confusion_matrix(df, actual, score, threshold)

    def cell(a: int, p: int) -> Column:
        return F.coalesce(F.sum(F.when((F.col("actual") == a) & (F.col("predicted") == p), F.col("n"))), F.lit(0))

    wide = m.agg(*[cell(a, p).cast("double").alias(f"c{a}{p}") for a in (0, 1) for p in (0, 1)])

    def ratio(num: Column, den: Column) -> Column:
        return F.coalesce(F.try_divide(num, den), F.lit(0.0))

    per_class = {}
    for k in (0, 1):
        o = 1 - k
        hit = F.col(f"c{k}{k}")
        p = ratio(hit, hit + F.col(f"c{o}{k}"))
        r = ratio(hit, hit + F.col(f"c{k}{o}"))
        per_class[k] = (p, r, ratio(2 * p * r, p + r), hit + F.col(f"c{k}{o}"))
    n = per_class[0][3] + per_class[1][3]
    acc = ratio(F.col("c00") + F.col("c11"), n)

    def row(label: str, p: Column, r: Column, f1: Column, support: Column) -> Column:
        return F.struct(F.lit(label).alias("label"), p.alias("precision"), r.alias("recall"), f1.alias("f1"),
                        support.cast("bigint").alias("support"))

    def macro(i: int) -> Column:
        return (per_class[0][i] + per_class[1][i]) / 2

    def weighted(i: int) -> Column:
        return ratio(per_class[0][i] * per_class[0][3] + per_class[1][i] * per_class[1][3], n)

    rows = [row(str(k), *per_class[k]) for k in (0, 1)]
    rows += [row("accuracy", acc, acc, acc, n), row("macro avg", macro(0), macro(1), macro(2), n),
             row("weighted avg", weighted(0), weighted(1), weighted(2), n)]
    return wide.select(F.inline(F.array(*rows)))


def roc_curve(df: DataFrame, actual: str, score: str) -> DataFrame:
    """One point per different score, highest first: threshold, tpr, fpr."""
    t = running_totals(df, score, {"pos": F.sum(actual).cast("bigint"), "n": F.count(F.lit(1))}, descending=True)
    return t.select(F.col(score).alias("threshold"),
                    F.try_divide(F.col("cum_pos").cast("double"), F.col("tot_pos")).alias("tpr"),
                    F.try_divide((F.col("cum_n") - F.col("cum_pos")).cast("double"),
                                 F.col("tot_n") - F.col("tot_pos")).alias("fpr"))


def roc_auc(df: DataFrame, actual: str, score: str) -> DataFrame:
    """Area under the curve; tied scores count half. Each trapezoid needs only its own row's totals."""
    t = running_totals(df, score, {"pos": F.sum(actual).cast("bigint"), "n": F.count(F.lit(1))}, descending=True)
    neg = F.col("n") - F.col("pos")
    area = neg * (F.col("cum_pos") - F.col("pos") / 2.0)
    return t.agg(F.try_divide(F.sum(area), F.max(F.col("tot_pos").cast("double") * (F.col("tot_n") - F.col("tot_pos"))))
                 .alias("auc"))


# Clipping bound of the log loss and the floor of the percentage error's denominator
# (machine epsilon of double precision).
MACHINE_EPS = 2.220446049250313e-16


def log_loss_accuracy(df: DataFrame, actual: str, score: str, threshold: float = 0.5) -> DataFrame:
    p = F.greatest(F.least(F.col(score), F.lit(1 - MACHINE_EPS)), F.lit(MACHINE_EPS))
    loss = -(F.when(F.col(actual) == 1, F.log(p)).otherwise(F.log(1 - p)))
    return df.agg(F.avg((classify(score, threshold) == F.col(actual)).cast("double")).alias("accuracy"),
                  F.avg(loss).alias("log_loss"))


def mape(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    a, p = F.col(actual), F.col(predicted)
    return df.agg(F.avg(F.abs(a - p) / F.greatest(F.abs(a), F.lit(MACHINE_EPS))).alias("mape"))


def asymmetric_loss(df: DataFrame, actual: str, predicted: str, penalty: float = 20.0) -> DataFrame:
    """Mean squared error times the mean row weight: ``penalty`` where actual exceeds predicted, else 1."""
    d = F.col(actual) - F.col(predicted)
    return df.agg((F.avg(d * d) * F.avg(F.when(d > 0, F.lit(penalty)).otherwise(1.0))).alias("loss"))


def promise_window(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Promised day range and breach side from a predicted number of days."""
    upper = F.rint(F.col(predicted)).cast("int") + 1
    staged = df.withColumn("_u", upper)
    staged = staged.withColumn("pdd1", F.when(F.col("_u") >= 4, F.col("_u") - 2).otherwise(1)) \
        .withColumn("pdd2", F.greatest(F.col("_u"), F.lit(3))).drop("_u")
    return staged.withColumn("breach", F.when(F.col(actual) < F.col("pdd1"), "negative")
                             .when(F.col(actual) > F.col("pdd2"), "positive").otherwise("ontime"))


def _share(side: str) -> Column:
    return F.count(F.when(F.col("breach") == side, 1)) * 100.0 / F.count(F.lit(1))


def breach_by(df: DataFrame, dims: Sequence[str], promise_means: bool = True) -> DataFrame:
    """On-time, positive and negative breach % per group, with mean promise days."""
    aggs = [_share("ontime").alias("ontime"), _share("positive").alias("positive_breach"),
            _share("negative").alias("negative_breach")]
    if promise_means:
        aggs += [F.avg("pdd1").alias("avg_pdd1"), F.avg("pdd2").alias("avg_pdd2")]
    return df.groupBy(*dims).agg(*aggs)


def breach_by_dimensions(df: DataFrame, dims: Sequence[str]) -> DataFrame:
    """The same shares for several single dimensions at once; missing values are left out."""
    long = df.select("breach", F.explode(F.array(*[
        F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("value")) for d in dims])).alias("_d"))
    long = long.select("breach", "_d.dimension", "_d.value").where(F.col("value").isNotNull())
    return breach_by(long, ["dimension", "value"], promise_means=False)


def breach_hotspots(report: DataFrame, threshold: float = 10.0) -> DataFrame:
    return report.where(F.col("positive_breach") > threshold).orderBy(F.desc("positive_breach"))
