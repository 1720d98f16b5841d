import datetime as dt

import pytest
from pyspark.sql import functions as F

from propensight.config import Params
from propensight.operators import extract as E

CUT = dt.date(2024, 1, 20)
P = Params(history=10, horizon=3, pending=5, min_events=5)


@pytest.fixture
def tables(spark, at):
    events = []

    def add(i, day, n, env="product_page", product=1, key=None):
        for _ in range(n):
            events.append((i, at(f"{day}T12:00:00"), env, 1, 2.5, key, product, len(events)))

    add("six", "2024-01-18", 6, key="k")
    add("five", "2024-01-18", 5)
    add("cutoff_day", "2024-01-12", 6)      # pending only through the cutoff day itself
    add("cutoff_day", "2024-01-20", 1)
    add("stale", "2024-01-12", 9)           # not pending
    add("stranger", "2024-01-18", 9)        # not known
    add("no_product", "2024-01-18", 6, product=-1)
    add("six", "2024-01-22", 1)             # label window
    add("six", "2024-01-23", 1)             # beyond it
    ev = spark.createDataFrame(events, "id string, event_timestamp timestamp_ntz, event_env string, product_qty int, "
                                       "product_price double, key string, product_id bigint, event_id bigint")
    visit = lambda day, d: ("k", at(f"{day}T10:00:00"), d, 3, 2, 1.0, -1.0, "desktop")
    vi = spark.createDataFrame([visit("2024-01-18", 1.0), visit("2024-01-17", 2.0), visit("2023-12-01", 3.0)],
                               "key string, visit_timestamp timestamp_ntz, duration double, nb_pages int, "
                               "unique_pages int, latitude double, longitude double, device string")
    pr = spark.createDataFrame([(1, 4.0, 10, "d", "c", "s")],
                               "product_id bigint, product_rating double, product_nb_of_ratings int, "
                               "product_department string, product_category string, product_sub_category string")
    kn = spark.createDataFrame([(i,) for i in ["six", "six", "five", "cutoff_day", "stale", "no_product"]], "id string")
    return ev, vi, pr, kn


def ids(df):
    return sorted(r["id"] for r in df.select("id").distinct().collect())


def test_selection_bounds(tables):
    ev, _, _, kn = tables
    pending = E.pending_ids(E.events_of_known(ev, kn), CUT, P.pending)
    assert ids(pending) == ["cutoff_day", "five", "no_product", "six"]
    active = E.active_ids(ev, pending, P.begin(CUT), CUT, P.min_events)
    assert ids(active) == ["cutoff_day", "no_product", "six"]
    assert ids(E.selected_ids(ev, kn, CUT, P)) == ids(active)


def test_everyone_when_not_only_known(tables):
    ev, _, _, kn = tables
    assert ids(E.selected_ids(ev, kn, CUT, P, known_only=False)) == ["cutoff_day", "no_product", "six", "stranger"]
    flagged = E.events_of_known(ev, kn, known_only=False)
    pending = E.pending_ids(flagged, CUT, P.pending, known_only=False)
    assert "stranger" in ids(pending)


def test_extract_rows(tables):
    out = E.retrieve_features(*tables, CUT, P)
    assert ids(out) == ["cutoff_day", "six"]
    assert out.where("id = 'six'").count() == 6 * 2 + 1       # two visits of the key in range, one label event
    assert out.where("id = 'six' AND visit_timestamp IS NULL").count() == 1
    assert out.where("event_timestamp >= '2024-01-23'").count() == 0


def test_many_cutoffs_equal_single_ones(tables):
    dates = [CUT, dt.date(2024, 1, 19), dt.date(2024, 1, 21), dt.date(2023, 12, 1)]
    many = E.retrieve_features_many(*tables, dates, P)
    for day in dates:
        one = E.retrieve_features(*tables, day, P)
        mine = many.where(F.col("data_date") == F.lit(day))
        assert one.exceptAll(mine).count() == 0 and mine.exceptAll(one).count() == 0


def test_timestamp_bounds_reach_the_scan(small, capsys):
    small.extract_at(small.cutoff).explain("formatted")
    text = capsys.readouterr().out
    assert "GreaterThanOrEqual(ts,2024-01-06" in text and "LessThan(ts,2024-01-22" in text
    assert "CartesianProduct" not in text
    many = E.retrieve_features_many(small.events, small.visits, small.products, small.known, [small.cutoff], small.params)
    many.explain("formatted")
    text = capsys.readouterr().out
    assert "CartesianProduct" not in text and "NestedLoop" not in text
