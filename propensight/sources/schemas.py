"""Declared schemas of the input and stored tables."""

from pyspark.sql import types as T

EVENTS = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("event_timestamp", T.TimestampType()),
    T.StructField("event_env", T.StringType()),
    T.StructField("product_qty", T.IntegerType()),
    T.StructField("product_price", T.DoubleType()),
    T.StructField("key", T.StringType()),
    T.StructField("product_id", T.LongType()),
    T.StructField("event_id", T.LongType()),
])

VISITS = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("visit_timestamp", T.TimestampType()),
    T.StructField("duration", T.DoubleType()),
    T.StructField("nb_pages", T.IntegerType()),
    T.StructField("unique_pages", T.IntegerType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("device", T.StringType()),
])

PRODUCTS = T.StructType([
    T.StructField("product_id", T.LongType()),
    T.StructField("product_rating", T.DoubleType()),
    T.StructField("product_nb_of_ratings", T.IntegerType()),
    T.StructField("product_department", T.StringType()),
    T.StructField("product_category", T.StringType()),
    T.StructField("product_sub_category", T.StringType()),
])

KNOWN_IDS = T.StructType([T.StructField("id", T.StringType())])

TABLES = {"events": EVENTS, "visits": VISITS, "products": PRODUCTS, "known_ids": KNOWN_IDS}

SEQUENCES = T.StructType([
    T.StructField("data_date", T.DateType()),
    T.StructField("id", T.StringType()),
    T.StructField("seq_length", T.IntegerType()),
    T.StructField("inputs_num", T.ArrayType(T.ArrayType(T.FloatType()))),
    T.StructField("inputs_cat", T.ArrayType(T.ArrayType(T.IntegerType()))),
    T.StructField("inactivity", T.DoubleType()),
    T.StructField("label", T.IntegerType()),
])

PREDICTIONS = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("purchase_proba", T.DoubleType()),
])

VOCABULARY = T.StructType([
    T.StructField("feature", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("code", T.IntegerType()),
])
