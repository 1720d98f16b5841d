"""Views that give the given tables the input schemas of the library. Spark and DuckDB run the same text."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from propensight.config import Params

# The given events span 30 days, so the windows are shorter than in production.
PARAMS = Params(history=14, horizon=2, pending=7, min_events=5, max_len=30, training_history=20,
                bounds=(0, 10, 20, 25, 30), batch_size=16, samples=20, background=8)
CUTOFF = dt.date(2024, 1, 20)
EARLIER = dt.date(2024, 1, 2)
CUTOFFS = [dt.date(2024, 1, d) for d in (12, 14, 16, 18, 20)]
EXEC_DATE = dt.date(2024, 1, 30)

# One user-day in ten has no visit key, and one product in twenty is not in the catalogue (-1): the left
# join meets unmatched events and the inner join loses some.
EVENTS = """
SELECT event_id, CAST(user_id AS string) AS id, ts AS event_timestamp,
       CASE event_type WHEN 'view' THEN 'product_page' WHEN 'click' THEN 'add_to_cart'
            WHEN 'purchase' THEN 'purchase' WHEN 'signup' THEN ' Unknown' ELSE '?' END AS event_env,
       CAST(event_id % 7 AS int) - 1 AS product_qty,
       value AS product_price,
       CASE WHEN CAST(regexp_extract(props, '([0-9]+)', 1) AS bigint) < 95
            THEN CAST(regexp_extract(props, '([0-9]+)', 1) AS bigint) ELSE CAST(-1 AS bigint) END AS product_id,
       CASE WHEN (user_id + extract(day FROM ts)) % 10 <> 0
            THEN concat(CAST(user_id AS string), '_', CAST(CAST(ts AS date) AS string)) END AS key
FROM events
"""

VISITS = """
SELECT concat(CAST(user_id AS string), '_', CAST(day AS string)) AS key,
       min(ts) AS visit_timestamp,
       CAST(max(sod) - min(sod) AS double) AS duration,
       CAST(count(*) AS int) AS nb_pages,
       CAST(count(DISTINCT event_type) AS int) AS unique_pages,
       CAST(user_id % 180 - 90 AS double) AS latitude,
       CAST(user_id * 7 % 360 - 180 AS double) AS longitude,
       CASE user_id % 9 WHEN 0 THEN ' Mobile' WHEN 1 THEN 'computer' WHEN 2 THEN 'wearable' WHEN 3 THEN 'unknown'
            WHEN 4 THEN '?' WHEN 5 THEN 'game_console' WHEN 6 THEN 'Tablet ' WHEN 7 THEN 'dmr' ELSE 'desktop' END AS device
FROM (SELECT user_id, ts, event_type, CAST(ts AS date) AS day,
             extract(hour FROM ts) * 3600 + extract(minute FROM ts) * 60
               + CAST(floor(extract(second FROM ts)) AS int) AS sod
      FROM events) e
GROUP BY user_id, day
"""

PRODUCTS = """
SELECT p_partkey AS product_id,
       CAST(p_size % 6 AS double) AS product_rating, p_size AS product_nb_of_ratings,
       CASE WHEN p_partkey % 23 = 0 THEN NULL WHEN p_partkey % 20 = 0 THEN '' ELSE p_type END AS product_department,
       p_brand AS product_category, p_name AS product_sub_category
FROM part
"""

# Ids repeat, and one customer segment is known under ids that no event has.
KNOWN = """
SELECT CASE WHEN c_mktsegment = 'FURNITURE' THEN concat('x', CAST(c_custkey AS string)) ELSE CAST(c_custkey AS string) END AS id FROM customer
UNION ALL
SELECT CAST(c_custkey AS string) AS id FROM customer WHERE c_mktsegment = 'BUILDING'
"""

SCORED = """
SELECT CAST(doc_id AS string) AS id, quality AS label,
       0.4e0 * quality + 0.6e0 * ((doc_id * 7919 % 1000) / 1000e0) AS proba
FROM labels
"""

VIEWS = {"fx_events": (EVENTS, ["events"]), "fx_visits": (VISITS, ["events"]), "fx_products": (PRODUCTS, ["part"]),
         "fx_known": (KNOWN, ["customer"]), "fx_scored": (SCORED, ["labels"])}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text, tables = VIEWS[name]
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in tables}
    for t in tables:
        text = text.replace(f"FROM {t}", f"FROM {{{t}}}")
    return spark.sql(text, **tables)
