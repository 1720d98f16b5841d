"""Registered queries: sources and sinks, extraction, event-level features."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from harness import fixtures as X
from harness.ctes import CUT, P, SUB, d, r6
from harness.registry import query
from harness.stage import Stage
from propensight import constants as C
from propensight.operators import extract as E, features as Fe, vocabulary as V
from propensight.sources import tables as T

EXTRACT_COLUMNS = [*E.EXTRACT_EVENT, "week_day", "month", *E.EXTRACT_VISIT, *E.EXTRACT_PRODUCT]
# Columns compared as fractions; counts that can be missing are among them.
FRACTIONS = {"product_price", "duration", "nb_pages", "unique_pages", "latitude", "longitude", "product_rating"}


def listed(columns: list[str], fractions=FRACTIONS) -> str:
    return ", ".join(f"{r6(c)} AS {c}" if c in fractions else c for c in columns)


EXTRACT_LIST = "data_date, " + listed(EXTRACT_COLUMNS)


def plain(df: DataFrame) -> DataFrame:
    """Counts that can be missing as fractions."""
    return df.withColumns({c: F.col(c).cast("double") for c in ("nb_pages", "unique_pages") if c in df.columns})


# ---- sources and sinks

@query("scan_source", f"SELECT event_id, id, event_timestamp, event_env, product_qty, {r6('product_price')} AS "
                      "product_price, product_id, key FROM fx_events")
def _(s: Stage) -> DataFrame:
    path = s.path("source")
    s.events.withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp")).write.parquet(f"{path}/events")
    read = T.scan_source(s.spark, path, "events")
    return read.withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp_ntz"))


@query("write_extract", f"SELECT {EXTRACT_LIST} FROM extract_many WHERE data_date IN ({d(X.CUTOFFS[1])}, {d(CUT)})")
def _(s: Stage) -> DataFrame:
    path = s.path("extract")
    T.write_extract(s.extract_many, path)
    T.write_extract(s.extract, path)  # a repeated date replaces only itself
    return plain(T.read_extract(s.spark, path, [X.CUTOFFS[1], CUT]).select("data_date", *EXTRACT_COLUMNS))


@query("read_extract", f"SELECT {EXTRACT_LIST} FROM extract_{X.CUTOFFS[0]:%Y%m%d}")
def _(s: Stage) -> DataFrame:
    path = s.path("extract")
    T.write_extract(s.extract_many, path)
    return plain(T.read_extract(s.spark, path, [X.CUTOFFS[0]]).select("data_date", *EXTRACT_COLUMNS))


@query("read_sequences", "SELECT data_date, id, seq_length, CAST(1 - label AS INTEGER) AS label FROM seqs")
def _(s: Stage) -> DataFrame:
    path = s.path("sequence-store")
    T.write_sequences(s.examples, path, "training")
    T.write_sequences(s.examples.withColumn("label", 1 - F.col("label")), path, "prediction")
    return T.read_sequences(s.spark, path, [CUT], "prediction").select("data_date", "id", "seq_length", "label")


@query("write_sequences", "SELECT data_date, id, seq_length, label, "
                          f"{r6('inactivity')} AS inactivity FROM seqs")
def _(s: Stage) -> DataFrame:
    path = s.path("sequence-store")
    T.write_sequences(s.examples, path, "training")
    T.write_sequences(s.examples.withColumn("label", F.lit(0)), path, "prediction")
    return T.read_sequences(s.spark, path, [CUT], "training").select(
        "data_date", "id", "seq_length", "label", "inactivity")


@query("write_vocabulary", "SELECT feature, value, code FROM vocab")
def _(s: Stage) -> DataFrame:
    path = s.path("vocabulary-files")
    T.write_vocabulary(s.vocabulary, path)
    return T.read_vocabulary(s.spark, path)


@query("read_vocabulary", f"SELECT value, code FROM vocab WHERE feature = '{SUB}'")
def _(s: Stage) -> DataFrame:
    path = s.path("vocabulary-files")
    T.write_vocabulary(s.vocabulary, path)
    return T.read_vocabulary(s.spark, path).where(F.col("feature") == SUB).select("value", "code")


@query("read_slot_map", "SELECT value, code FROM slots WHERE feature = 'device'")
def _(s: Stage) -> DataFrame:
    path = s.path("slot-map")
    T.write_slot_map(s.slots, path)
    return T.read_slot_map(s.spark, path).where(F.col("feature") == "device").select("value", "code")


@query("write_slot_map", "SELECT feature, value, code FROM slots")
def _(s: Stage) -> DataFrame:
    path = s.path("slot-map")
    T.write_slot_map(s.slots, path)
    return T.read_slot_map(s.spark, path)


def _listed_values(name: str) -> str:
    return f"(SELECT array_to_string(list(value ORDER BY value), '|') FROM {name})"


def _catalogue(c: str) -> str:
    return (f"(SELECT array_to_string(list(value ORDER BY value), '|') FROM (SELECT DISTINCT {c} AS value "
            f"FROM fx_products WHERE {c} <> '' UNION ALL SELECT '0'))")


@query("freeze_feature_spec", f"""
SELECT CAST(9 AS INTEGER) AS n_numeric, CAST(1 AS INTEGER) AS n_engineered, CAST(7 AS INTEGER) AS n_week_days,
       CAST(12 AS INTEGER) AS n_months, CAST(10 AS INTEGER) AS n_event_env, CAST(10 AS INTEGER) AS n_device,
       (SELECT CAST(min(event_timestamp) AS date) FROM fx_events) AS min_date,
       {', '.join(f"(SELECT count(DISTINCT {c}) + 1 FROM fx_products WHERE {c} <> '') AS voc_{c}" for c in C.CODED_COLUMNS)},
       {_listed_values('env_values')} AS values_event_env, {_listed_values('device_values')} AS values_device,
       {', '.join(f'{_catalogue(c)} AS values_{c}' for c in C.CODED_COLUMNS)}""")
def _(s: Stage) -> DataFrame:
    path = s.path("spec")
    T.freeze_feature_spec(s.events, s.visits, s.products, path)
    spec = T.freeze_feature_spec(s.events, s.visits, s.products, path)  # reads what the first call stored
    return spec.select(*[F.array_join(c, "|").alias(c) if t.startswith("array") else F.col(c) for c, t in spec.dtypes])


@query("feature_spec_size", "SELECT CAST(n + 1 + 7 + 12 + 2 * 10 AS INTEGER) AS n_input FROM (SELECT count(*) AS n FROM "
                            "(DESCRIBE SELECT product_qty, product_price, duration, nb_pages, unique_pages, latitude, "
                            "longitude, product_rating, product_nb_of_ratings FROM extract))")
def _(s: Stage) -> DataFrame:
    return Fe.feature_spec_size(T.feature_spec(s.events, s.visits, s.products))


# ---- extraction

@query("available_dates", "SELECT strftime(day, '%Y%m%d') AS table_date FROM days")
def _(s: Stage) -> DataFrame:
    return E.available_dates(s.events)


@query("category_values", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, value FROM (SELECT DISTINCT {c} AS value FROM fx_products WHERE {c} IS NOT NULL "
    f"AND {c} <> '') UNION ALL SELECT '{c}', '0'" for c in C.CODED_COLUMNS))
def _(s: Stage) -> DataFrame:
    every = None
    for c in C.CODED_COLUMNS:
        one = E.category_values(s.products, c).select(F.lit(c).alias("feature"), "value")
        every = one if every is None else every.unionByName(one)
    return every


@query("vocabulary_sizes", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, count(DISTINCT {c}) + 1 AS voc_size FROM fx_products WHERE {c} <> ''"
    for c in C.CODED_COLUMNS))
def _(s: Stage) -> DataFrame:
    return E.vocabulary_sizes(s.products)


@query("known_ids", "SELECT id, known FROM known")
def _(s: Stage) -> DataFrame:
    return E.known_ids(s.known)


@query("events_of_known", "SELECT id, event_timestamp, known FROM events_known")
def _(s: Stage) -> DataFrame:
    return E.events_of_known(s.events, s.known)


@query("events_of_all", "SELECT e.id, e.event_timestamp, coalesce(k.known, FALSE) AS known FROM fx_events e "
                        "LEFT JOIN known k ON e.id = k.id")
def _(s: Stage) -> DataFrame:
    return E.events_of_known(s.events, s.known, known_only=False)


@query("pending_ids", f"SELECT id FROM pending_{CUT:%Y%m%d}")
def _(s: Stage) -> DataFrame:
    return E.pending_ids(E.events_of_known(s.events, s.known), CUT, P.pending)


@query("active_ids", f"SELECT id, cnt FROM active_{CUT:%Y%m%d}")
def _(s: Stage) -> DataFrame:
    pending = E.pending_ids(E.events_of_known(s.events, s.known), CUT, P.pending)
    return E.active_ids(s.events, pending, P.begin(CUT), CUT, P.min_events)


@query("selected_ids", f"SELECT id FROM active_{CUT:%Y%m%d}")
def _(s: Stage) -> DataFrame:
    return E.selected_ids(s.events, s.known, CUT, P)


@query("visits_in_range", "SELECT key, " + listed(E.EXTRACT_VISIT) + f" FROM visits_{CUT:%Y%m%d}")
def _(s: Stage) -> DataFrame:
    return plain(E.visits_in_range(s.visits, P.begin(CUT), P.end(CUT)))


_JOINED_VISIT = ["event_id", "id", "key", *E.EXTRACT_VISIT]


@query("join_visits", f"SELECT e.event_id, e.id, e.key, {listed(E.EXTRACT_VISIT)} FROM fx_events e "
                      f"LEFT JOIN visits_{CUT:%Y%m%d} v ON e.key = v.key")
def _(s: Stage) -> DataFrame:
    return plain(E.join_visits(s.events, E.visits_in_range(s.visits, P.begin(CUT), P.end(CUT))).select(*_JOINED_VISIT))


@query("join_products", f"SELECT event_id, id, e.product_id, {listed(E.EXTRACT_PRODUCT)} FROM fx_events e "
                        "JOIN fx_products p ON e.product_id = p.product_id")
def _(s: Stage) -> DataFrame:
    return E.join_products(s.events, s.products).select("event_id", "id", "product_id", *E.EXTRACT_PRODUCT)


@query("calendar_features", "SELECT event_id, dayname(event_timestamp) AS week_day, "
                            "strftime(event_timestamp, '%m') AS month FROM fx_events")
def _(s: Stage) -> DataFrame:
    return E.calendar_features(s.events).select("event_id", "week_day", "month")


@query("retrieve_features", f"SELECT {EXTRACT_LIST} FROM extract")
def _(s: Stage) -> DataFrame:
    return plain(s.extract_at(CUT))


@query("retrieve_features_many", f"SELECT {EXTRACT_LIST} FROM extract_many")
def _(s: Stage) -> DataFrame:
    return plain(E.retrieve_features_many(s.events, s.visits, s.products, s.known, X.CUTOFFS, P))


# ---- event-level features

@query("normalize_timestamp", "SELECT event_id, event_timestamp FROM secs")
def _(s: Stage) -> DataFrame:
    return Fe.normalize_timestamp(s.extract).select("event_id", "event_timestamp")


@query("normalize_timestamp_text", "SELECT event_id, event_timestamp FROM secs")
def _(s: Stage) -> DataFrame:
    text = F.concat(F.date_format("event_timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit(" UTC"))
    return Fe.normalize_timestamp(s.extract.withColumn("event_timestamp", text)).select("event_id", "event_timestamp")


@query("delta_time", "SELECT data_date, id, event_id, delta_time FROM delta")
def _(s: Stage) -> DataFrame:
    return Fe.delta_time(Fe.normalize_timestamp(s.extract)).select("data_date", "id", "event_id", "delta_time")


@query("event_date", "SELECT event_id, event_date FROM filled")
def _(s: Stage) -> DataFrame:
    return Fe.event_date(s.extract).select("event_id", "event_date")


_FILLED = ["event_id", "id", "event_timestamp", *C.EVENT_NUMERIC, *C.VISIT_NUMERIC, *C.PRODUCT_NUMERIC,
           *C.INDICATOR_COLUMNS, *C.CODED_COLUMNS]


@query("fill_missing", f"SELECT {listed(_FILLED)} FROM filled")
def _(s: Stage) -> DataFrame:
    return plain(s.filled.select(*_FILLED))


@query("normalize_category", "SELECT event_id, event_env, device FROM clean")
def _(s: Stage) -> DataFrame:
    return Fe.normalize_category(s.filled).select("event_id", "event_env", "device")


@query("distinct_normalized", "SELECT 'event_env' AS feature, value FROM env_values UNION ALL "
                              "SELECT 'device', value FROM device_values")
def _(s: Stage) -> DataFrame:
    one, two = (Fe.distinct_normalized(s.events, s.visits, c).select(F.lit(c).alias("feature"), "value")
                for c in C.INDICATOR_COLUMNS)
    return one.unionByName(two)


@query("grow_vocabulary", "SELECT feature, value, code FROM vocab_grown")
def _(s: Stage) -> DataFrame:
    old = V.grow_vocabulary(None, Fe.fill_missing(s.extract_at(X.EARLIER)))
    return V.grow_vocabulary(old, Fe.fill_missing(s.extract))


@query("encode_vocabulary", f"""
SELECT event_id, {', '.join(f'coalesce(v{i}.code, 0) AS {c}_code' for i, c in enumerate(C.CODED_COLUMNS))} FROM filled c
{' '.join(f"LEFT JOIN vocab_early v{i} ON v{i}.feature = '{c}' AND v{i}.value = c.{c}" for i, c in enumerate(C.CODED_COLUMNS))}""")
def _(s: Stage) -> DataFrame:
    df, old = s.filled, V.grow_vocabulary(None, Fe.fill_missing(s.extract_at(X.EARLIER)))
    for c in C.CODED_COLUMNS:
        df = V.encode_vocabulary(df, old, c)
    return df.select("event_id", *[f"{c}_code" for c in C.CODED_COLUMNS])


@query("vocabulary_growth_check", f"""
SELECT feature, n_values, voc_size FROM (SELECT feature, count(*) AS n_values FROM vocab_grown GROUP BY feature)
JOIN (SELECT feature, count(*) AS voc_size FROM vocab_early GROUP BY feature) USING (feature) WHERE n_values > voc_size""")
def _(s: Stage) -> DataFrame:
    old = V.grow_vocabulary(None, Fe.fill_missing(s.extract_at(X.EARLIER)))
    declared = old.groupBy("feature").agg(F.count("*").alias("voc_size"))
    return V.oversized(V.grow_vocabulary(old, Fe.fill_missing(s.extract)), declared)


@query("grow_slot_map", "SELECT feature, value, code FROM slots")
def _(s: Stage) -> DataFrame:
    env, device = (Fe.distinct_normalized(s.events, s.visits, c).select(F.lit(c).alias("feature"), "value")
                   for c in C.INDICATOR_COLUMNS)
    return V.grow_slot_map(None, env.unionByName(device))


def _bits(array: str) -> str:
    return f"array_to_string(list_transform({array}, lambda b: CAST(CAST(b AS INTEGER) AS VARCHAR)), '')"


def _joined(column: str) -> F.Column:
    return F.array_join(F.transform(column, lambda b: b.cast("int").cast("string")), "")


@query("one_hot_calendar", f"SELECT event_id, {_bits('num[1:7]')} AS week_day_vec, {_bits('num[8:19]')} AS month_vec FROM vectors")
def _(s: Stage) -> DataFrame:
    return Fe.one_hot_calendar(s.extract).select("event_id", _joined("week_day_vec").alias("week_day_vec"),
                                                 _joined("month_vec").alias("month_vec"))


@query("one_hot_fixed", f"SELECT event_id, {_bits('num[20:29]')} AS event_env_vec, {_bits('num[30:39]')} AS device_vec FROM vectors")
def _(s: Stage) -> DataFrame:
    df = Fe.normalize_category(s.filled)
    for c in C.INDICATOR_COLUMNS:
        df = Fe.one_hot_fixed(df, c, s.slots)
    return df.select("event_id", *[_joined(f"{c}_vec").alias(f"{c}_vec") for c in C.INDICATOR_COLUMNS])


@query("slot_names", """
SELECT CAST(i AS INTEGER) AS slot,
       'device_' || coalesce(value, 'Na_' || CAST(i - (SELECT count(*) FROM slots WHERE feature = 'device') AS VARCHAR)) AS name
FROM generate_series(0, 9) g(i) LEFT JOIN (SELECT value, code FROM slots WHERE feature = 'device') ON code = i""")
def _(s: Stage) -> DataFrame:
    return Fe.slot_names(s.slots, "device")


@query("assemble_features", "SELECT event_id, CAST(len(num) AS INTEGER) AS n, "
                            "array_to_string(list_transform(num, lambda x: CAST(CAST(round(x * 100e0) AS BIGINT) AS VARCHAR)), ',') "
                            "AS cells FROM vectors")
def _(s: Stage) -> DataFrame:
    cells = F.transform("num", lambda x: F.round(x.cast("double") * 100.0).cast("long").cast("string"))
    return s.features.select("event_id", F.size("num").alias("n"), F.array_join(cells, ",").alias("cells"))
