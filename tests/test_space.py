import datetime as dt

import pytest
from pyspark.sql import functions as F

from propensight import constants as C
from propensight.operators import space as Sp, stats as St


@pytest.fixture
def examples(spark):
    """One sequence of three steps: quantities -1, 0, 1, a longitude of -1, one step without a device."""
    def vector(week, month, env, device, qty, longitude):
        v = [0.0] * C.N_INPUT
        v[week], v[7 + month], v[19 + env] = 1.0, 1.0, 1.0
        if device is not None:
            v[29 + device] = 1.0
        for name, x in (("product_qty", qty), ("longitude", longitude), ("product_price", 3.5), ("nb_pages", 2.0)):
            v[C.NUMERIC_POSITION[name]] = x
        return v

    nums = [vector(0, 0, 1, 2, -1.0, -1.0), vector(6, 11, 9, 9, 0.0, 5.0), vector(3, 4, 0, 0, 1.0, 0.0)]
    row = (dt.date(2024, 1, 20), "a", 3, nums, [[1, 2, 3], [0, 0, 0], [4, 5, 6]], 0.25, 1)
    return spark.createDataFrame([row], "data_date date, id string, seq_length int, inputs_num array<array<float>>, "
                                        "inputs_cat array<array<int>>, inactivity double, label int")


def test_mapping(examples):
    rows = Sp.to_explainer_space(Sp.pad_steps(examples, 5)).orderBy("step").collect()
    assert [r["is_pad"] for r in rows] == [False] * 3 + [True] * 2
    assert [r["product_qty"] for r in rows[:3]] == [-3.0, 1.0, 2.0]
    assert [r["week_day"] for r in rows[:3]] == [1.0, 7.0, 4.0] and rows[0]["event_env"] == 2.0
    assert rows[0]["longitude"] == -1.0 and not rows[0]["is_pad"]
    assert rows[4]["product_price"] == -1.0 and rows[4]["nb_pages"] == 0.0 and rows[4]["product_department"] == 0.0


def test_round_trip_is_exact(examples):
    back = Sp.from_explainer_space(Sp.to_explainer_space(Sp.pad_steps(examples, 5))).first()
    want = examples.first()
    assert back["inputs_num"] == want["inputs_num"] and back["inputs_cat"] == want["inputs_cat"]
    assert back["seq_length"] == 3 and back["inactivity"] == want["inactivity"]


def test_no_mismatches_on_data(small):
    rows = Sp.roundtrip_mismatches(small.steps).collect()
    assert len(rows) == C.N_INPUT + 3 and sum(r["mismatches"] for r in rows) == 0


def test_flat_columns(examples):
    space = Sp.to_explainer_space(Sp.pad_steps(examples, 4))
    names = Sp.flat_names(4)
    flat = {r["name"]: r["position"] for r in Sp.flatten_steps(space).collect()}
    assert flat == {n: k for k, n in enumerate(names)} and len(names) == 4 * 17 + 1
    wide = Sp.flatten_wide(space, 4)
    assert wide.columns == ["data_date", "id", *names] and wide.first()["product_qty_t0"] == -3.0


def test_the_flat_form_makes_no_row_per_cell(spark, examples, capsys):
    space = Sp.to_explainer_space(Sp.pad_steps(examples, 4))
    rows = space.unionByName(space.withColumn("id", F.lit(None).cast("string")).where("step <> 1")).unionByName(space)
    Sp.flatten_wide(rows, 4).explain()
    plan = capsys.readouterr().out
    assert "pivot" not in plan and "Expand" not in plan
    cells = {(r["id"], r["name"]): r["value"] for r in Sp.flatten_steps(rows).collect()}
    wide = Sp.flatten_wide(rows, 4).collect()
    assert len(wide) == 2
    for r in wide:
        assert {n: r[n] for n in Sp.flat_names(4)} == {n: cells.get((r["id"], n)) for n in Sp.flat_names(4)}


def test_statistics_leave_padding_out_but_keep_real_values(examples):
    space = Sp.to_explainer_space(Sp.pad_steps(examples, 5))
    stats = {(r["step"], r["feature"]): r for r in St.column_stats(space).collect()}
    assert stats[(0, "longitude")]["min"] == -1.0 and (3, "longitude") not in stats
    assert stats[(-1, "inactivity")]["n"] == 1
    assert St.column_stats_per_step(space).where("feature = 'inactivity'").count() == 3
    freq = St.value_frequencies(space)
    assert freq.where("value = 0").count() == 0 and freq.where("step > 2").count() == 0
    scaled = {(r["step"], r["feature"]): r for r in St.categorical_unit_scale(St.column_stats(space)).collect()}
    assert (scaled[(0, "week_day")]["mean"], scaled[(0, "week_day")]["std"]) == (0.0, 1.0)
    assert scaled[(0, "product_price")]["std"] == 1.0


def test_display_names(examples, spark):
    vocabulary = spark.createDataFrame([("product_department", "garden", 1)], "feature string, value string, code int")
    slots = spark.createDataFrame([("event_env", "", 0), ("event_env", "purchase", 1)], "feature string, value string, code int")
    space = Sp.to_explainer_space(Sp.pad_steps(examples, 3))
    names = {(r["step"], r["feature"]): r["display_name"] for r in Sp.category_labels(space, vocabulary, slots).collect()}
    assert names[(0, "week_day")] == "week_day=Sunday" and names[(0, "product_department")] == "product_department=garden"
    assert names[(0, "event_env")] == "event_env=purchase" and names[(2, "event_env")] == "event_env=None_event_env"
    with pytest.raises(Exception, match="beyond the length"):
        Sp.flatten_wide(space, 1).collect()
