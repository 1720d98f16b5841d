import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from propensight import constants as C
from propensight.functions.categories import normalize_category
from propensight.operators import features as Fe, vocabulary as V


def test_delta_time_matches_plain_lag_for_a_hot_id(events):
    rng = random.Random(3)
    base = dt.datetime(2024, 1, 1)
    rows = [("hot" if k % 3 else f"id{k % 7}", (base + dt.timedelta(seconds=rng.randrange(0, 400000))).isoformat(), "x")
            for k in range(900)]
    rows += [("tie", "2024-01-02T00:00:00", "x")] * 3
    got = Fe.delta_time(events(rows)).toPandas().sort_values(["id", "event_timestamp", "event_id"])
    want = got.groupby("id")["event_timestamp"].diff().dt.total_seconds().fillna(0).astype(int)
    assert got["delta_time"].tolist() == want.tolist()
    assert got[got.id == "tie"]["delta_time"].tolist() == [0, 0, 0]


def test_timestamps_lose_fractions(spark, at):
    df = spark.createDataFrame([(at("2024-01-01T10:00:00.999999"),)], "event_timestamp timestamp_ntz")
    assert Fe.normalize_timestamp(df).first()[0] == at("2024-01-01T10:00:00")
    text = spark.createDataFrame([("2024-01-01 10:00:00.25 UTC",)], "event_timestamp string")
    assert Fe.normalize_timestamp(text).first()[0] == at("2024-01-01T10:00:00")


def test_missing_values(spark):
    df = spark.createDataFrame([(None, 1, None, None, None), ("a", None, None, None, None)],
                               "id string, product_qty int, product_price double, device string, product_category string")
    rows = Fe.fill_missing(df).collect()
    assert [tuple(r) for r in rows] == [("a", 0, 0.0, "", "0")]


@pytest.mark.parametrize("raw, clean", [(" Mobile", "mobile phone"), ("COMPUTER", "desktop"), ("wearable ", "mobile device"),
                                        ("game_console", "other"), ("dmr", "other"), (" Unknown", ""), ("?", ""),
                                        ("Tablet ", "tablet"), ("", "")])
def test_category_clean_up(spark, raw, clean):
    assert spark.range(1).select(normalize_category(F.lit(raw))).first()[0] == clean


@pytest.fixture
def slots(spark):
    return spark.createDataFrame([("device", "", 0), ("device", "desktop", 1)], "feature string, value string, code int")


def test_unmapped_indicator_value_is_an_error(spark, slots):
    df = spark.createDataFrame([("tablet",)], "device string")
    with pytest.raises(Exception, match="no slot in device"):
        Fe.one_hot_fixed(df, "device", slots).collect()
    assert Fe.one_hot_fixed(df, "device", slots, unknown="slot0").first()["device_vec"][0] == 1.0


def test_indicator_width_is_fixed(spark, slots):
    df = spark.createDataFrame([("desktop",)], "device string")
    assert Fe.one_hot_fixed(df, "device", slots).first()["device_vec"] == [0.0, 1.0] + [0.0] * 8
    with pytest.raises(Exception, match="beyond width"):
        Fe.one_hot_fixed(df, "device", slots, width=1).collect()
    names = {r["slot"]: r["name"] for r in Fe.slot_names(slots, "device").collect()}
    assert names[0] == "device_" and names[1] == "device_desktop" and names[2] == "device_Na_0" and len(names) == 10


def test_calendar_value_outside_the_list_is_all_zero(spark):
    row = Fe.one_hot_calendar(spark.createDataFrame([("Noday", "13")], "week_day string, month string")).first()
    assert sum(row["week_day_vec"]) == 0 and sum(row["month_vec"]) == 0


def test_vocabulary_grows_without_changing_codes(spark):
    schema = ", ".join(f"{c} string" for c in C.CODED_COLUMNS)
    one = V.grow_vocabulary(None, spark.createDataFrame([("b", "x", "s"), ("", "?", "s"), (None, "0", "s")], schema))
    two = V.grow_vocabulary(one, spark.createDataFrame([("a", "x", "t"), ("b", "w", "s")], schema))
    codes = {(r["feature"], r["value"]): r["code"] for r in two.collect()}
    dept, cat, sub = C.CODED_COLUMNS
    assert codes == {(dept, "0"): 0, (dept, "b"): 1, (dept, "a"): 2, (cat, "0"): 0, (cat, "x"): 1, (cat, "w"): 2,
                     (sub, "0"): 0, (sub, "s"): 1, (sub, "t"): 2}
    coded = V.encode_vocabulary(spark.createDataFrame([("zzz", "x", "t")], schema), two, dept)
    assert coded.first()[f"{dept}_code"] == 0
    declared = one.groupBy("feature").agg(F.count("*").alias("voc_size"))
    assert {r["feature"] for r in V.oversized(two, declared).collect()} == {dept, cat, sub}


def test_vector_layout(small):
    row = small.features.first()
    assert len(row["num"]) == C.N_INPUT == 49 and len(row["cat"]) == 3
    for offset, width in C.INDICATOR_BLOCKS.values():
        assert sum(row["num"][offset:offset + width]) == 1.0
