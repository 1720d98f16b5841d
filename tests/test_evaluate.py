import random

import pytest
from pyspark.mllib.evaluation import BinaryClassificationMetrics
from pyspark.sql import functions as F

from propensight.operators import evaluate as Ev


@pytest.fixture
def scored(spark):
    rng = random.Random(5)
    rows = [(int(rng.random() < 0.4), round(rng.random(), 2)) for _ in range(400)]
    return spark.createDataFrame(rows, "label int, proba double")


@pytest.mark.parametrize("p, b", [(0.0, 0), (0.1, 1), (0.99, 9), (1.0, 9)])
def test_bins(spark, p, b):
    assert spark.range(1).select(Ev.probability_bin(F.lit(p), 10)).first()[0] == b


def test_empty_bins_are_listed(spark):
    df = spark.createDataFrame([(1, 0.05), (0, 0.05)] * 6, "label int, proba double")
    rows = {r["bin"]: r for r in Ev.calibration_bins(df, 4).collect()}
    assert rows[0]["count"] == 12 and rows[0]["proba_true"] == 0.5 and rows[0]["std_err"] == 0.0
    assert rows[3]["count"] == 0 and rows[3]["proba_true"] is None and len(rows) == 4
    curve = Ev.calibration_curve(df, 4).collect()
    assert [r["bin"] for r in curve] == [0]


def test_roc_area_matches_mllib_and_pairs(spark, scored):
    got = Ev.roc_auc(scored).first()[0]
    pairs = scored.select(F.col("proba"), F.col("label").cast("double")).rdd.map(lambda r: (r[0], r[1]))
    assert got == pytest.approx(BinaryClassificationMetrics(pairs).areaUnderROC, abs=1e-9)
    rows = scored.collect()
    pos, neg = ([r["proba"] for r in rows if r["label"] == k] for k in (1, 0))
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    assert got == pytest.approx(wins / len(pos) / len(neg), abs=1e-9)


def test_curves_against_counting(scored):
    rows = [(r["label"], r["proba"]) for r in scored.collect()]
    for r in Ev.pr_curve(scored).collect():
        if r["threshold"] is None:
            assert (r["precision"], r["recall"]) == (1.0, 0.0)
            continue
        hit = [label for label, p in rows if p >= r["threshold"] - 1e-12]
        assert r["precision"] == pytest.approx(sum(hit) / len(hit))
        assert r["recall"] == pytest.approx(sum(hit) / sum(label for label, _ in rows))
    points = Ev.pr_thresholds(scored, 20).orderBy("threshold").collect()
    assert len(points) == 20 and points[0]["recall"] == 1.0


def test_histogram_covers_all_rows(scored):
    hist = Ev.probability_histogram(scored).groupBy("subset").agg(F.sum("count").alias("n"), F.count("*").alias("bins"))
    got = {r["subset"]: (r["n"], r["bins"]) for r in hist.collect()}
    ones = scored.where("label = 1").count()
    assert got == {"all": (400, 15), "label1": (ones, 15), "label0": (400 - ones, 15)}


def test_thresholds_that_differ_in_the_ninth_digit_stay_apart(spark):
    rows = [(k % 3 == 0, 0.1 + k * 1e-9) for k in range(50)]
    scored = spark.createDataFrame([(int(a), b) for a, b in rows], "label int, proba double")
    assert Ev.roc_curve(scored).count() == 50
    pos, neg = [p for a, p in rows if a], [p for a, p in rows if not a]
    area = sum(p > n for p in pos for n in neg) / len(pos) / len(neg)
    assert abs(Ev.roc_auc(scored).first()[0] - area) < 1e-12
