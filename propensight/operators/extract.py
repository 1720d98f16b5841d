"""Extraction: which ids are scored at a cutoff, and their events with visit and product columns.

Day conditions are written as half-open timestamp bounds, so that they reach the parquet scan and can
prune files and row groups. Small sides are left to the optimizer, which broadcasts only below
its size threshold and otherwise shuffles, splitting hot keys at run time.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from propensight import constants as C
from propensight.config import Params

TS = "event_timestamp"
EXTRACT_EVENT = ["id", TS, "event_id", "event_env", "product_qty", "product_price", "key", "product_id"]
EXTRACT_VISIT = ["visit_timestamp"] + C.VISIT_NUMERIC + ["device"]
EXTRACT_PRODUCT = C.PRODUCT_NUMERIC + C.CODED_COLUMNS


def midnight(day: dt.date, ts_type: str = "timestamp_ntz") -> Column:
    return F.lit(day.isoformat()).cast(ts_type)


def days_between(df: DataFrame, column: str, begin: dt.date, end: dt.date) -> DataFrame:
    """Rows whose timestamp lies in the days ``[begin, end)``."""
    kind = dict(df.dtypes)[column]
    return df.where((F.col(column) >= midnight(begin, kind)) & (F.col(column) < midnight(end, kind)))


def available_dates(events: DataFrame) -> DataFrame:
    """Days that have product page events, as ``yyyymmdd``."""
    return (events.where(F.col("event_env") == C.PRODUCT_PAGE)
            .select(F.date_format(TS, C.DATE_FORMAT).alias("table_date")).distinct())


def category_values(products: DataFrame, category: str) -> DataFrame:
    """Distinct filled values of a category column, and the extra value ``0``."""
    found = (products.where(F.col(category).isNotNull() & (F.col(category) != ""))
             .select(F.col(category).alias("value")).distinct())
    extra = products.sparkSession.range(1).select(F.lit(C.VOCABULARY_SEED[0]).alias("value"))
    return found.unionByName(extra)


def vocabulary_sizes(products: DataFrame, categories: list[str] = C.CODED_COLUMNS) -> DataFrame:
    """Number of values per category column, the extra value included."""
    counted = products.agg(*[
        (F.count_distinct(F.when(F.col(c) != "", F.col(c))) + 1).alias(c) for c in categories])
    return counted.unpivot([], categories, "feature", "voc_size")


def known_ids(known: DataFrame) -> DataFrame:
    return known.select("id").distinct().withColumn("known", F.lit(True))


def events_of_known(events: DataFrame, known: DataFrame, known_only: bool = True) -> DataFrame:
    """Events of known ids. With ``known_only=False`` every event stays, flagged."""
    how = "inner" if known_only else "left"
    return (events.join(known_ids(known), "id", how)
            .select("id", TS, F.coalesce("known", F.lit(False)).alias("known")))


def pending_ids(events_known: DataFrame, cutoff: dt.date, days: int = Params.pending,
                known_only: bool = True) -> DataFrame:
    """Ids with an event in the ``days`` days up to and including the cutoff day."""
    day = dt.timedelta(days=1)
    recent = days_between(events_known, TS, cutoff - days * day + day, cutoff + day)
    if known_only:
        recent = recent.where("known")
    return recent.select("id").distinct()


def active_ids(events: DataFrame, pending: DataFrame, begin: dt.date, cutoff: dt.date,
               min_events: int = Params.min_events) -> DataFrame:
    """Pending ids with more than ``min_events`` events in the days ``[begin, cutoff)``."""
    counts = days_between(events, TS, begin, cutoff).groupBy("id").agg(F.count("*").alias("cnt"))
    return counts.where(F.col("cnt") > min_events).join(pending, "id", "left_semi")


def selected_ids(events: DataFrame, known: DataFrame, cutoff: dt.date, params: Params = Params(),
                 known_only: bool = True) -> DataFrame:
    """The ids of a cutoff from one pass over the events.

    Both conditions are aggregates per id, so they are computed together and combined map-side;
    the known ids then meet one row per id instead of every event.
    """
    day = dt.timedelta(days=1)
    kind = dict(events.dtypes)[TS]
    begin, first_pending = params.begin(cutoff), cutoff - params.pending * day + day
    facts = (days_between(events, TS, min(begin, first_pending), cutoff + day).groupBy("id").agg(
        F.count_if((F.col(TS) >= midnight(begin, kind)) & (F.col(TS) < midnight(cutoff, kind))).alias("cnt"),
        F.max(TS).alias("last_ts")))
    ids = facts.where((F.col("cnt") > params.min_events) & (F.col("last_ts") >= midnight(first_pending, kind)))
    if known_only:
        ids = ids.join(known, "id", "left_semi")
    return ids.select("id")


def visits_in_range(visits: DataFrame, begin: dt.date, end: dt.date) -> DataFrame:
    return days_between(visits, "visit_timestamp", begin, end).select("key", *EXTRACT_VISIT)


def join_visits(events: DataFrame, visits: DataFrame) -> DataFrame:
    """Every event with its visits; events without one keep nulls, several visits give several rows."""
    return events.join(visits, "key", "left")


def join_products(events: DataFrame, products: DataFrame) -> DataFrame:
    """Events whose product is in the catalogue, with the product columns."""
    return events.join(products.select("product_id", *EXTRACT_PRODUCT), "product_id")


def calendar_features(df: DataFrame) -> DataFrame:
    return (df.withColumn("week_day", F.date_format(TS, "EEEE"))
            .withColumn("month", F.date_format(TS, "MM")))


def retrieve_features(events: DataFrame, visits: DataFrame, products: DataFrame, known: DataFrame,
                      cutoff: dt.date, params: Params = Params(), known_only: bool = True) -> DataFrame:
    """The extract of one cutoff: history and label window of the selected ids."""
    begin, end = params.begin(cutoff), params.end(cutoff)
    ids = selected_ids(events, known, cutoff, params, known_only)
    window = days_between(events, TS, begin, end).select(*EXTRACT_EVENT).join(ids, "id", "left_semi")
    joined = join_visits(join_products(window, products), visits_in_range(visits, begin, end))
    return calendar_features(joined).select(
        F.lit(cutoff).alias("data_date"), *EXTRACT_EVENT, "week_day", "month", *EXTRACT_VISIT, *EXTRACT_PRODUCT)


def _date_array(dates: list[dt.date]) -> Column:
    return F.array(*[F.lit(d) for d in sorted(set(dates))])


def selected_ids_many(events: DataFrame, known: DataFrame, dates: list[dt.date], params: Params = Params(),
                      known_only: bool = True) -> DataFrame:
    """``(data_date, id)`` for every cutoff in ``dates``.

    Events shrink to one row per id and day first; only those rows are copied to the cutoffs they count for.
    """
    day = dt.timedelta(days=1)
    reach = max(params.history, params.pending - 1)
    daily = (days_between(events, TS, min(dates) - reach * day, max(dates) + day)
             .groupBy("id", F.to_date(TS).alias("day")).agg(F.count("*").alias("n")))
    if known_only:
        daily = daily.join(known, "id", "left_semi")
    served = F.filter(_date_array(dates), lambda c: F.date_diff(c, F.col("day")).between(0, reach))
    back = F.date_diff("data_date", "day")
    return (daily.withColumn("data_date", F.explode(served))
            .groupBy("data_date", "id").agg(
                F.sum(F.when((back >= 1) & (back <= params.history), F.col("n"))).alias("cnt"),
                F.max(back < params.pending).alias("is_pending"))
            .where((F.col("cnt") > params.min_events) & F.col("is_pending"))
            .select("data_date", "id"))


def retrieve_features_many(events: DataFrame, visits: DataFrame, products: DataFrame, known: DataFrame,
                           dates: list[dt.date], params: Params = Params(),
                           known_only: bool = True) -> DataFrame:
    """The extracts of all cutoffs in ``dates`` in one job.

    An id carries the list of its cutoffs (at most ``len(dates)`` entries), so the events are shuffled
    by id and joined with the products once, and are copied to their cutoffs only afterwards.
    """
    ids = selected_ids_many(events, known, dates, params, known_only)
    cutoffs = ids.groupBy("id").agg(F.collect_list("data_date").alias("cutoffs"))
    window = days_between(events, TS, params.begin(min(dates)), params.end(max(dates))).select(*EXTRACT_EVENT)
    back = lambda c: F.date_diff(c, F.to_date(TS))
    serves = F.filter("cutoffs", lambda c: (back(c) <= params.history) & (back(c) > -params.horizon))
    copies = (join_products(window.join(cutoffs, "id"), products)
              .withColumn("data_date", F.explode(serves)).drop("cutoffs"))
    in_window = F.to_date("visit_timestamp").between(
        F.date_sub("data_date", params.history), F.date_add("data_date", params.horizon - 1))
    v = (days_between(visits, "visit_timestamp", params.begin(min(dates)), params.end(max(dates)))
         .select(F.col("key").alias("visit_key"), *EXTRACT_VISIT))
    joined = copies.join(v, (F.col("key") == F.col("visit_key")) & in_window, "left")
    return calendar_features(joined).select(
        "data_date", *EXTRACT_EVENT, "week_day", "month", *EXTRACT_VISIT, *EXTRACT_PRODUCT)
