import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from harness import fixtures as X
from propensight.operators import extract as E, sequences as S, space as Sp, stats as St
from propensight.plans import jobs as J
from propensight.session import materialize
from propensight.sources import tables as T

EXEC = dt.date(2024, 1, 30)
PARAMS = X.Params(history=14, horizon=2, pending=7, min_events=5, max_len=8, training_history=8, samples=6, background=4)


def test_from_events_to_explanations(spark, small, tmp_path):
    inputs = J.Inputs(small.events, small.visits, small.products, small.known)
    store = J.Store(str(tmp_path))
    assert J.check_model(spark, store, EXEC, 5)

    done = J.prepare(inputs, store, EXEC, "train", PARAMS)
    assert done == [dt.date(2024, 1, 24) + dt.timedelta(days=k) for k in range(5)]
    assert J.prepare(inputs, store, EXEC, "train", PARAMS) == []            # nothing left to do
    one = E.retrieve_features(*[getattr(inputs, n) for n in ("events", "visits", "products", "known")], done[2], PARAMS)
    stored = T.read_sequences(spark, store.path("sequences"), [done[2]])
    until = one.where(F.to_date("event_timestamp") <= F.col("data_date"))
    assert stored.count() == until.select("id").distinct().count()

    ranked = J.sweep(spark, store, EXEC, [{"reg_param": 0.1}, {"reg_param": 10.0}, {"reg_param": -1.0}], PARAMS).collect()
    losses = J.train(spark, store, EXEC, PARAMS, reg_param=0.1).first()
    by = {r["params"]: r["loss"] for r in ranked}
    assert by['{"reg_param": 0.1}'] == pytest.approx(losses["cross_entropy"])  # the same days are held out
    assert [r["loss"] for r in ranked] == sorted(by.values()) and ranked[-1]["loss"] > 1e6
    assert 0 < losses["cross_entropy"] < 5
    assert not J.check_model(spark, store, EXEC + dt.timedelta(days=5), 5)

    J.prepare(inputs, store, EXEC, "predict", PARAMS)
    predictions = J.predict(spark, store, EXEC)
    assert predictions.columns == ["id", "purchase_proba"] and predictions.count() > 0

    day_after = EXEC + dt.timedelta(days=1)                                  # the normal daily run: data end yesterday
    assert small.events.agg(F.max(F.to_date("event_timestamp"))).first()[0] == EXEC
    assert J.predict(spark, store, day_after).count() == predictions.count()
    with pytest.raises(ValueError, match="prepare first"):
        J.predict(spark, store, day_after + dt.timedelta(days=5))
    with pytest.raises(ValueError, match="held-out"):
        J.train(spark, store, dt.date(2024, 1, 26), PARAMS)                  # later sequences are in the store
    with pytest.raises(FileNotFoundError):
        J.latest_model(spark, store, EXEC - dt.timedelta(days=1))

    report = J.evaluate(spark, store, E.available_dates(small.events), EXEC, PARAMS)
    assert report["calibration"].agg(F.sum("count")).first()[0] > 0 and report["roc_auc"].count() == 1

    examples = T.read_sequences(spark, store.path("sequences"), done[:1])
    J.build_statistics(examples, store)
    weights = J.explain_surrogate(examples, store, small.scorer, PARAMS, complexity=5)
    assert weights.groupBy("id").count().where("count <> 5").count() == 0
    assert weights.select("id").distinct().count() == examples.count()
    with pytest.raises(FileNotFoundError):
        J.explain_shapley(examples, store, small.scorer)
    J.build_background(spark, store, PARAMS)
    phi = J.explain_shapley(examples, store, small.scorer)
    assert phi.select("id", "step").distinct().count() == examples.agg(F.sum("seq_length")).first()[0]

    few = materialize(examples.orderBy("id").limit(2), "few")                # the trained model itself
    trained, mine = J.latest_model(spark, store, EXEC), J.Store(f"{tmp_path}/trained")
    J.build_statistics(examples, mine)
    J.build_background(spark, mine, PARAMS)
    assert J.explain_surrogate(few, mine, trained, PARAMS).select("id").distinct().count() == 2
    assert J.explain_shapley(few, mine, trained).select("id", "step").distinct().count() == few.agg(F.sum("seq_length")).first()[0]

    dropped = J.purge(spark, store, EXEC, days=4)
    assert "data_date=2024-01-24" in dropped and T.written_dates(spark, store.path("extracts")).count() < 6


def test_too_many_missing_days(spark, small, tmp_path):
    inputs = J.Inputs(small.events, small.visits, small.products, small.known)
    late = X.Params(history=14, horizon=2, training_history=60)
    with pytest.raises(ValueError, match="no data"):
        J.prepare(inputs, J.Store(str(tmp_path)), EXEC, "train", late)


def test_a_new_day_is_added_without_reading_old_ones(spark, small, tmp_path, monkeypatch):
    store = J.Store(str(tmp_path))
    available = E.available_dates(small.events)
    days = [small.cutoff + dt.timedelta(days=k) for k in range(3)]
    for k, day in enumerate(days):
        own = small.examples.withColumn("data_date", F.lit(day)).withColumn("inactivity", F.col("inactivity") + 100.0 * k)
        T.write_sequences(own, store.path("sequences"), "training")
        if k == 1:
            assert J.add_daily_statistics(spark, store, days[:2]) == days[:2]
    assert J.add_daily_statistics(spark, store, days[:2]) == []
    whole = T.read_sequences(spark, store.path("sequences"), days)
    space = Sp.to_explainer_space(S.step_rows(whole))
    want = {n: df.toPandas() for n, df in (("stats", St.column_stats(space)), ("frequencies", St.value_frequencies(space)))}

    read, real = [], T.read_sequences
    monkeypatch.setattr(T, "read_sequences", lambda spark, path, dates, purpose: read.append(dates) or real(spark, path, dates, purpose))
    assert J.add_daily_statistics(spark, store, days) == days[2:] and read == [days[2:]]
    merged = J.merge_daily_statistics(spark, store, days)
    for name, keys in (("stats", ["step", "feature"]), ("frequencies", ["step", "feature", "value"])):
        a, b = (df.sort_values(keys).reset_index(drop=True) for df in (merged[name].toPandas(), want[name]))
        assert len(a) == len(b) > 0 and list(a.columns) == list(b.columns)
        for c in a.columns:
            assert np.allclose(a[c], b[c], rtol=1e-9) if a[c].dtype.kind == "f" else (a[c] == b[c]).all()
    planned = J.explainer_statistics(spark, store, available, execution_date=EXEC, share=1.0, history=20, horizon=2)
    assert read == [days[2:]] and planned["stats"].count() > 0
