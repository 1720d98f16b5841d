"""Evaluation tables of scored examples ``(label, proba)``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from propensight.config import Params


def probability_bin(p: Column, n: int) -> Column:
    """Index of the equal-width bin of a probability; 1 belongs to the last bin."""
    return F.least(F.floor(p * n), F.lit(n - 1)).cast("int")


def with_probability_bin(scored: DataFrame, n: int = Params.calibration_bins) -> DataFrame:
    return scored.withColumn("bin", probability_bin(F.col("proba"), n))


def calibration_bins(scored: DataFrame, n: int = Params.calibration_bins) -> DataFrame:
    """Count, outcome and prediction means (two digits) and spread of predictions for each of ``n`` bins."""
    found = with_probability_bin(scored, n).groupBy("bin").agg(
        F.count("*").alias("n"), F.avg("label").alias("t"), F.avg("proba").alias("p"),
        F.stddev_pop("proba").alias("s"))
    every = scored.sparkSession.range(n).select(F.col("id").cast("int").alias("bin"))
    two = lambda c: F.floor(F.round(c, 6) * 100.0 + 0.5) / 100.0  # rounds the binary value, as 0.145 to 0.14
    return every.join(F.broadcast(found), "bin", "left").select(
        "bin", F.coalesce("n", F.lit(0)).alias("count"), two("t").alias("proba_true"),
        two("p").alias("proba_pred"), F.col("s").alias("std_err"))


def calibration_curve(scored: DataFrame, n: int = Params.calibration_bins, n_std: float = 1.0,
                      min_count: int = 10) -> DataFrame:
    """Bins with more than ``min_count`` rows, and the prediction plus and minus its spread."""
    spread = F.col("std_err") * n_std
    return (calibration_bins(scored, n).where(F.col("count") > min_count)
            .select("bin", "count", "proba_true", "proba_pred",
                    (F.col("proba_pred") + spread).alias("upper"), (F.col("proba_pred") - spread).alias("lower")))


def brier_score(scored: DataFrame) -> DataFrame:
    return scored.agg(F.avg(F.pow(F.col("proba") - F.col("label"), F.lit(2.0))).alias("brier"))


def class_counts(scored: DataFrame) -> DataFrame:
    return scored.agg(F.count_if(F.col("label") == 1).alias("ones"), F.count_if(F.col("label") == 0).alias("zeros"))


def _cumulative_counts(scored: DataFrame, slices: int = 200) -> DataFrame:
    """Positives and negatives at or above every distinct probability.

    Rows shrink to one per probability first. The running sums are taken in parallel inside ``slices`` ranges that
    are cut at quantiles, so that many small probabilities are no hot range; a second sum runs over one row per range.
    """
    counts = scored.groupBy(F.col("proba").alias("threshold")).agg(
        F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") == 0).alias("neg"))
    cuts = sorted(set(counts.approxQuantile("threshold", [k / slices for k in range(1, slices)], 0.001)))
    position = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c <= F.col("threshold"))) if cuts else F.lit(0)
    counts = counts.withColumn("_slice", position)
    above = W.partitionBy(F.lit(0)).orderBy(F.col("_slice").desc()).rowsBetween(W.unboundedPreceding, -1)
    totals = W.partitionBy(F.lit(0))
    ranges = counts.groupBy("_slice").agg(F.sum("pos").alias("_p"), F.sum("neg").alias("_n"))
    ranges = ranges.select("_slice", F.coalesce(F.sum("_p").over(above), F.lit(0)).alias("_p_above"),
                           F.coalesce(F.sum("_n").over(above), F.lit(0)).alias("_n_above"),
                           F.sum("_p").over(totals).alias("pos_total"), F.sum("_n").over(totals).alias("neg_total"))
    within = W.partitionBy("_slice").orderBy(F.col("threshold").desc()).rowsBetween(W.unboundedPreceding, 0)
    return counts.join(F.broadcast(ranges), "_slice").select(
        "threshold", "pos", "neg", "pos_total", "neg_total",
        (F.sum("pos").over(within) + F.col("_p_above")).alias("tp"),
        (F.sum("neg").over(within) + F.col("_n_above")).alias("fp"))


def roc_curve(scored: DataFrame) -> DataFrame:
    """False and true positive rate at every distinct threshold."""
    return _cumulative_counts(scored).select(
        "threshold", (F.col("fp") / F.col("neg_total")).alias("fpr"), (F.col("tp") / F.col("pos_total")).alias("tpr"))


def roc_auc(scored: DataFrame) -> DataFrame:
    """Area under the ROC curve by trapezoids.

    A trapezoid needs only its own threshold: its width is the threshold's negatives, and the mean of its two
    heights is the positives above it plus half of its own.
    """
    height = F.col("tp") - F.col("pos") / 2
    area = F.sum(F.col("neg") * height) / F.max(F.col("pos_total") * F.col("neg_total"))
    return _cumulative_counts(scored).agg(area.alias("roc_auc"))


def pr_curve(scored: DataFrame) -> DataFrame:
    """Precision and recall at every distinct threshold, and the end point (1, 0) without one."""
    points = _cumulative_counts(scored).select(
        "threshold", (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
        (F.col("tp") / F.col("pos_total")).alias("recall"))
    end = scored.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"))
    return points.unionByName(end)


def pr_thresholds(scored: DataFrame, n: int = 20) -> DataFrame:
    """Precision and recall at ``n`` evenly spaced thresholds.

    A row falls into exactly one gap between thresholds, so one aggregation into ``n`` gaps gives all points.
    """
    gap = F.least(F.floor(F.col("proba") * (n - 1)), F.lit(n - 1)).cast("int")
    counts = scored.groupBy(gap.alias("k")).agg(
        F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") == 0).alias("neg"))
    every = scored.sparkSession.range(n).select(F.col("id").cast("int").alias("k"))
    above = W.partitionBy(F.lit(0)).orderBy(F.col("k").desc()).rowsBetween(W.unboundedPreceding, 0)
    filled = every.join(F.broadcast(counts), "k", "left").select(
        "k", F.sum(F.coalesce("pos", F.lit(0))).over(above).alias("tp"),
        F.sum(F.coalesce("neg", F.lit(0))).over(above).alias("fp"),
        F.sum(F.coalesce("pos", F.lit(0))).over(W.partitionBy(F.lit(0))).alias("pos_total"))
    return filled.select(
        (F.col("k") / F.lit(float(n - 1))).alias("threshold"),
        F.when(F.col("tp") + F.col("fp") > 0, F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
        F.when(F.col("pos_total") > 0, F.col("tp") / F.col("pos_total")).alias("recall"))


def probability_histogram(scored: DataFrame, bins: int = Params.histogram_bins) -> DataFrame:
    """Counts in equal-width bins between the smallest and largest probability: all rows, and each label."""
    groups = F.explode(F.array(F.lit("all"), F.concat(F.lit("label"), F.col("label").cast("string")))).alias("subset")
    marked = scored.select("proba", groups)
    ends = marked.groupBy("subset").agg(F.min("proba").alias("lo"), F.max("proba").alias("hi"))
    width = F.when(F.col("hi") > F.col("lo"), F.col("hi") - F.col("lo")).otherwise(F.lit(1.0))
    index = F.least(F.floor((F.col("proba") - F.col("lo")) / width * bins), F.lit(bins - 1)).cast("int")
    counts = (marked.join(F.broadcast(ends), "subset").groupBy("subset", index.alias("bin"))
              .agg(F.count("*").alias("count")))
    every = ends.select("subset", "lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return (every.join(counts, ["subset", "bin"], "left")
            .select("subset", "bin", (F.col("lo") + width * F.col("bin") / bins).alias("left"),
                    F.coalesce("count", F.lit(0)).alias("count")))


def classification_losses(scored: DataFrame) -> DataFrame:
    """Mean cross-entropy, and error rate and accuracy of the more probable class."""
    p = F.col("proba")
    tiny = F.lit(1e-15)
    loss = -F.ln(F.greatest(F.when(F.col("label") == 1, p).otherwise(1 - p), tiny))
    wrong = ((p > 0.5).cast("int") != F.col("label")).cast("double")
    return scored.agg(F.avg(loss).alias("cross_entropy"), F.avg(wrong).alias("error"),
                      F.avg(1 - wrong).alias("accuracy"))
