import datetime as dt

import pytest
from pyspark.sql import functions as F

from propensight import constants as C
from propensight.operators.numbering import global_numbers
from propensight.operators import calendar as Cal, features as Fe, sequences as S


def test_label_window(events):
    rows = [("same_day", "2024-01-20T09:00:00", "purchase"), ("midnight", "2024-01-20T00:00:00", "purchase"),
            ("last_moment", "2024-01-22T00:00:00", "purchase"), ("late", "2024-01-22T00:00:01", "purchase"),
            ("other", "2024-01-21T00:00:00", "product_page")]
    got = {r["id"]: r["label"] for r in S.labels(events(rows), 2).collect()}
    assert got == {"same_day": 1, "midnight": 0, "last_moment": 1, "late": 0, "other": 0}
    strict = {r["id"]: r["label"] for r in S.labels(events(rows), 2, "next_day").collect()}
    assert strict == {**got, "same_day": 0}


def test_inactivity(events):
    rows = [("a", "2024-01-20T12:00:00", "x"), ("a", "2024-01-21T12:00:00", "x"), ("b", "2024-01-19T00:00:00", "x"),
            ("future", "2024-01-21T00:00:00", "x")]
    got = {r["id"]: r["inactivity"] for r in S.inactivity(events(rows)).collect()}
    assert got == {"a": 0.5, "b": 2.0}


def _vectors(df):
    one = F.array(F.unix_timestamp(F.col("event_timestamp").cast("timestamp")).cast("float"))
    return df.withColumns({"num": one, "cat": F.array(F.col("event_id").cast("int")), "event_date": F.to_date("event_timestamp")})


def test_last_events_in_order_with_ties(events):
    rows = [("a", f"2024-01-1{k}T00:00:00", "x") for k in range(5)] + [("a", "2024-01-14T00:00:00", "x")] * 2
    rows += [("a", "2024-01-21T00:00:00", "x")]
    got = S.build_sequences(_vectors(events(rows)), 4).first()
    assert got["seq_length"] == 4 and [c[0] for c in got["inputs_cat"]] == [3, 4, 5, 6]


def test_examples_are_joined_by_id(events):
    """An id with events after the cutoff only has a label but no sequence."""
    rows = [("after", "2024-01-21T00:00:00", "purchase"), ("before", "2024-01-19T00:00:00", "x")]
    df = _vectors(events(rows))
    got = S.sequence_examples(df, 5, 2).collect()
    assert [(r["id"], r["label"], r["inactivity"]) for r in got] == [("before", 0, 2.0)]
    assert S.labels(df, 2).count() == 2


@pytest.mark.parametrize("length, bucket", [(0, 0), (1, 1), (10, 1), (11, 2), (120, 5), (121, 6), (200, 6), (201, 6)])
def test_length_buckets(spark, length, bucket):
    assert S.length_bucket(spark.range(1).select(F.lit(length).alias("seq_length"))).first()["bucket"] == bucket


def test_batches(small):
    padded = S.pad_batches(small.examples, 4, [0, 20, 40])
    rows = padded.select("bucket", "batch_no", "padded_length", "seq_length", "inputs_num", "inputs_cat").collect()
    assert len(rows) == small.examples.count()
    groups = {}
    for r in rows:
        groups.setdefault((r["bucket"], r["batch_no"]), []).append(r)
        assert len(r["inputs_num"]) == len(r["inputs_cat"]) == r["padded_length"]
        assert all(v == [C.PAD_NUMERIC] * C.N_INPUT for v in r["inputs_num"][r["seq_length"]:])
    for (bucket, n), g in groups.items():
        assert len(g) <= 4 and max(r["seq_length"] for r in g) == g[0]["padded_length"]
        assert len(g) == 4 or (bucket, n + 1) not in groups    # only the last one may be short


def test_numbers_run_through_ranges(spark, capsys):
    rows = [(None if g == "c" else g, v, i) for i, (g, v) in enumerate([("a", k * 7 % 900) for k in range(900)] + [("b", k) for k in range(50)]
                                                                       + [("c", k) for k in range(20)])]
    df = spark.createDataFrame(rows, "g string, v int, extra int")
    got = global_numbers(df, ["g"], ["v"])
    assert got.columns == ["g", "v", "extra", "number"]
    want = {(g, v): n for key in ("a", "b", None) for n, (g, v) in enumerate(sorted((r[:2] for r in rows if r[0] == key), key=lambda r: r[1]))}
    assert {(r["g"], r["v"]): r["number"] for r in got.collect()} == want
    assert [r["number"] for r in global_numbers(df, [], ["g", "v"]).orderBy("g", "v").collect()] == list(range(970))
    assert global_numbers(df.limit(0), ["g"], ["v"]).count() == 0
    got.explain()
    plan = capsys.readouterr().out
    assert "row_number" not in plan and "min(_at" in plan[plan.index("Window"):]     # the only window runs over sums per range


def test_steps_unfold_sequences(small):
    steps = S.step_rows(small.examples)
    total = small.examples.agg(F.sum("seq_length")).first()[0]
    assert steps.count() == total
    assert steps.where(F.expr("aggregate(label_vec, 0, (a, x) -> a + x) <> 1")).count() == 0


def test_rank_limit_runs_before_the_shuffle(small, capsys):
    S.last_k_events(small.features, 5).explain()
    assert capsys.readouterr().out.count("WindowGroupLimit") == 2


def days(spark, first, n):
    return spark.createDataFrame([((dt.date.fromisoformat(first) + dt.timedelta(days=k)).strftime("%Y%m%d"),)
                                  for k in range(n)], "table_date string")


def test_execution_date(spark):
    available = days(spark, "2024-01-01", 30)
    of = lambda d: [r["execution_date"] for r in Cal.effective_execution_date(available, dt.date(2024, 1, d)).collect()]
    assert of(30) == [dt.date(2024, 1, 30)] and of(31) == [dt.date(2024, 1, 30)] and of(12) == [dt.date(2024, 1, 12)]
    assert Cal.effective_execution_date(available, dt.date(2024, 2, 1)).count() == 0


def test_training_days(spark):
    available = days(spark, "2024-01-01", 100)
    got = [r["data_date"] for r in Cal.training_calendar(available, dt.date(2024, 4, 9)).orderBy("data_date").collect()]
    assert got[0] == dt.date(2024, 1, 29) and got[-1] == dt.date(2024, 3, 12) and len(got) == 44
    assert Cal.training_calendar(available, dt.date(2024, 4, 9), "evaluate").first()[0] == dt.date(2024, 3, 12)
    assert Cal.training_calendar(available, dt.date(2024, 4, 9), "predict").first()[0] == dt.date(2024, 4, 9)
    assert Cal.training_calendar(days(spark, "2024-01-01", 30), dt.date(2024, 1, 30)).count() == 0
    parts = [r["part"] for r in Cal.split_by_date(Cal.training_calendar(available, dt.date(2024, 4, 9))).collect()]
    assert parts.count("train") == 35 and parts.count("evaluate") == 9


def test_missing_days(spark):
    available = days(spark, "2024-01-01", 100)
    rows = Cal.missing_days(available, dt.date(2024, 4, 9), history=105).collect()
    assert len(rows) == 5 and not rows[0]["abort"]
    assert Cal.missing_days(available, dt.date(2024, 4, 9), history=120).first()["abort"]


def test_retrain(spark):
    runs = spark.createDataFrame([("run_20240101",), ("run_20240110",), ("notes",)], "name string")
    assert not Cal.needs_retrain(runs, dt.date(2024, 1, 15), 5).first()["retrain"]
    assert Cal.needs_retrain(runs, dt.date(2024, 1, 16), 5).first()["retrain"]
    assert Cal.needs_retrain(runs.where("name = 'notes'"), dt.date(2024, 1, 15), 5).first()["retrain"]
