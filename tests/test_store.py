import datetime as dt

import pytest
from pyspark.sql import functions as F

from harness import catalog
from harness.check import connect, difference
from propensight.operators import model as M
from propensight.session import require_local
from propensight.sources import tables as T
from tests.conftest import SF


def dated(spark, days, value):
    return spark.createDataFrame([(dt.date(2024, 1, d), value) for d in days], "data_date date, v int")


def test_rewrites_touch_their_dates_only(spark, tmp_path):
    path = str(tmp_path / "t")
    T.write_extract(dated(spark, [1, 2], 1), path)
    T.write_extract(dated(spark, [2, 3], 2), path)
    got = {r["data_date"].day: r["v"] for r in T.read_extract(spark, path).collect()}
    assert got == {1: 1, 2: 2, 3: 2}
    assert T.read_extract(spark, path, [dt.date(2024, 1, 3)]).count() == 1
    dropped = T.drop_old_dates(spark, path, dt.date(2024, 1, 10), days=8)
    assert dropped == ["data_date=2024-01-01"]
    assert T.purge_old(dated(spark, [1, 2, 3], 0), dt.date(2024, 1, 10), days=8).count() == 2


def test_partition_pruning(small, spark, tmp_path, capsys):
    path = str(tmp_path / "s")
    T.write_sequences(small.examples, path, "training")
    T.write_sequences(small.examples, path, "prediction")
    read = T.read_sequences(spark, path, [small.cutoff], "prediction")
    assert read.count() == small.examples.count()
    read.explain("formatted")
    filters = [line for line in capsys.readouterr().out.splitlines() if line.startswith("PartitionFilters")]
    assert filters and all("data_date" in line and "purpose" in line for line in filters)
    assert T.written_dates(spark, path, "training").count() == 1


def test_spec_is_written_once(small, spark, tmp_path):
    path = str(tmp_path / "spec")
    first = T.freeze_feature_spec(small.events, small.visits, small.products, path).first()
    again = T.freeze_feature_spec(small.events.limit(0), small.visits, small.products, path).first()
    assert first == again and first["min_date"] == dt.date(2024, 1, 1)


def test_value_lists_keep_special_values(spark, tmp_path):
    rows = spark.createDataFrame([("f", "0", 0), ("f", "a b", 1), ("g", "é", 2), ("g", " a b ", 3), ("g", 'q "x"', 4), ("g", "t\tz", 5), ("g", "l\nm", 6)], "feature string, value string, code int")
    T.write_vocabulary(rows, str(tmp_path / "v"))
    assert sorted(T.read_vocabulary(spark, str(tmp_path / "v")).collect()) == sorted(rows.collect())
    slots = spark.createDataFrame([("f", "", 0), ("f", "x", 1)], "feature string, value string, code int")
    T.write_slot_map(slots, str(tmp_path / "m"))
    assert sorted(T.read_slot_map(spark, str(tmp_path / "m")).collect()) == sorted(slots.collect())


def test_classifier(small):
    model = M.fit_classifier(small.examples)
    scored = M.score(model, small.examples)
    low, high, n = scored.agg(F.min("purchase_proba"), F.max("purchase_proba"), F.count("*")).first()
    assert 0 < low < high < 1 and n == small.examples.count()
    sweep = M.hyperparameter_sweep(small.examples, small.examples, [{"reg_param": -1.0}, {"reg_param": 0.1}]).collect()
    assert sweep[-1]["loss"] == M.FAILED_LOSS and sweep[0]["loss"] < 1


def test_black_box_scores(small):
    got = M.score_with_function(small.examples, lambda b: b["seq_length"] / 1000.0)
    want = small.examples.select("data_date", "id", (F.col("seq_length") / 1000.0).alias("purchase_proba"))
    assert got.exceptAll(want).count() == 0


def test_flagship(spark):
    df = catalog.flagship(spark, SF)
    assert df.columns == ["data_date", "id", "seq_length", "inactivity", "label"]
    assert df.count() == 12 and df.agg(F.sum("label")).first()[0] == 7


def test_twins_belong_to_queries():
    assert set(catalog.ORACLES) <= set(catalog.QUERIES)


@pytest.mark.parametrize("name", ["retrieve_features", "delta_time", "sequence_examples", "value_frequencies",
                                  "single_feature_fit", "shapley_values", "calibration_bins", "training_calendar"])
def test_against_duckdb(spark, name):
    mine = catalog.QUERIES[name](spark, SF).toPandas()
    twin = connect(SF).sql(catalog.ORACLES[name]).df()
    assert difference(mine, twin) == ""


def test_machine_local_folders_are_for_local_mode_only():
    for master in ("yarn", "spark://host:7077", "k8s://x", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError, match="checkpoint"):
            require_local(master)
    require_local("local[8]")


@pytest.mark.parametrize("write, read", [(T.write_vocabulary, T.read_vocabulary), (T.write_slot_map, T.read_slot_map)])
def test_a_stop_before_the_commit_keeps_all_codes(spark, tmp_path, monkeypatch, write, read):
    path = str(tmp_path / "list")
    rows = lambda n: spark.createDataFrame([("f", f"v{i}", i) for i in range(n)] + [("g", "x", 0)], "feature string, value string, code int")
    with pytest.raises(FileNotFoundError):
        read(spark, path)
    write(rows(3), path)
    with monkeypatch.context() as stopped:
        def stop(*args):
            raise KeyboardInterrupt
        stopped.setattr(T, "_commit", stop)
        with pytest.raises(KeyboardInterrupt):
            write(rows(2), path)
    assert sorted(read(spark, path).collect()) == sorted(rows(3).collect())
    assert T.committed_versions(spark, path) == [1]
    write(rows(5), path)
    assert sorted(read(spark, path).collect()) == sorted(rows(5).collect()) and T.committed_versions(spark, path) == [1, 2]
    with pytest.raises(RuntimeError, match="another job"):
        T._commit(spark, path, 2, "version-of-another")
    assert sorted(read(spark, path).collect()) == sorted(rows(5).collect())
