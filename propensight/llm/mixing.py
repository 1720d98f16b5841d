"""Mixing sources to target weights by Poisson replication.

Each source gets a mean repetition rate: its share of the target mix over its share of the corpus. A document's number of
copies is drawn from the Poisson distribution of that rate by inverting its cumulative distribution at a uniform number
hashed from seed and id, so a retried task draws the same. Rates above ``PART`` are drawn as a sum of parts, since the
distribution has no long table then. Copies are ordered by a hash over the whole table.

Only sizes per source are aggregated; the table of rates (one row per source) is written, so Spark knows its size and
decides between broadcast and a join whose hot keys adaptive execution splits.

Null source is a source of its own. Null or empty texts weigh nothing but are drawn like the others of their source;
a source without any characters gets rate 1. Null ids share one draw per text. Repeated rows get the same count each.
Extra columns stay, except ``copy``, ``n_copies`` and ``shuffle_key``, which are written anew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from propensight.llm.common import shielded, table
from propensight.session import materialize, shuffle_width

PART = 16.0  # largest mean drawn from one table
TERMS = 96  # entries of a table; beyond it lies less than 1e-40 at mean 16
UNIT = float(1 << 52)


def uniform(*parts: Column) -> Column:
    """In [0, 1): the first 52 bits of a hash of the parts."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 13), 16, 10).cast("long").cast("double") / F.lit(UNIT)


def size_of() -> Column:
    return F.coalesce(F.length("text"), F.lit(0)).cast("long")


def target_rates(docs: DataFrame, weights: dict | None = None, temperature: float = 0.5, budget: float = 1.0) -> DataFrame:
    """Mean copies per source. ``weights``: share of the mix by source (others 0); without it, shares follow the size to
    the power ``temperature``. ``budget``: characters of the mix as a multiple of those of the corpus."""
    sizes = docs.groupBy(F.col("source").alias("mix_source")).agg(F.sum(size_of()).alias("chars"))
    if weights is None:
        wish = F.pow(F.col("chars").cast("double"), F.lit(temperature))
    elif weights:
        given = F.create_map(*[F.lit(x) for pair in weights.items() for x in pair])
        wish = F.coalesce(F.try_element_at(given, F.coalesce("mix_source", F.lit(""))), F.lit(0.0))
    else:
        wish = F.lit(0.0)
    sized = sizes.withColumn("wish", wish)
    total = sized.agg(F.sum("chars").alias("all_chars"), F.sum("wish").alias("all_wish"))
    rate = F.col("all_chars") * F.lit(budget) * F.col("wish") / F.col("all_wish") / F.col("chars")
    rated = sized.crossJoin(F.broadcast(total)).select(  # the right side is one row
        "mix_source", F.round(F.when((F.col("chars") > 0) & (F.col("all_wish") > 0), rate).otherwise(F.lit(1.0)), 9).alias("rate"))
    parts = F.greatest(F.lit(1), F.ceil(F.col("rate") / PART)).cast("int")
    mean = F.col("rate") / F.col("parts")
    start = F.exp(-mean)
    tables = F.aggregate(
        F.sequence(F.lit(1), F.lit(TERMS)),
        F.struct(start.alias("p"), start.alias("c"), F.array(start).alias("out")),
        lambda a, k: F.struct((a["p"] * mean / k).alias("p"), (a["c"] + a["p"] * mean / k).alias("c"),
                              F.concat(a["out"], F.array(a["c"] + a["p"] * mean / k)).alias("out")),
        lambda a: a["out"])
    return rated.withColumn("parts", parts).withColumn("cumulative", tables)


def poisson_mix(docs: DataFrame, weights: dict | None = None, temperature: float = 0.5, budget: float = 1.0,
                seed: int = 17) -> DataFrame:
    """``docs`` with each row as often as drawn (``copy`` from 1 to ``n_copies``), in the order of ``shuffle_key``."""
    rates = materialize(target_rates(docs, weights, temperature, budget), "mix_rates")
    identity = F.coalesce(F.col("doc_id").cast("string"), F.md5(F.coalesce("text", F.lit(""))))
    # One number per part, hashed once and then compared with the whole table.
    numbers = F.transform(F.sequence(F.lit(1), F.col("parts")), lambda j: uniform(F.lit(str(seed)), identity, j.cast("string")))
    draw = F.aggregate(numbers, F.lit(0), lambda n, u: n + F.size(F.filter("cumulative", lambda c: c <= u)))
    rows, restored = shielded(docs.drop("copy", "n_copies", "shuffle_key"), ("doc_id", "text", "source"))
    counted = (rows
               .join(rates, F.col("source").eqNullSafe(F.col("mix_source")), "left")
               .withColumn("n_copies", draw.cast("long")).filter("n_copies > 0"))
    copies = counted.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n_copies"))))
    key = F.md5(F.concat_ws("|", F.lit(f"{seed}:order"), identity, F.col("copy").cast("string")))
    # Keys are even, so their first digits deal them to partitions that follow each other; a sort would draw all copies twice to sample them.
    width = shuffle_width(docs)
    part = F.floor(F.conv(F.substring("shuffle_key", 1, 13), 16, 10).cast("long").cast("double") / F.lit(UNIT) * width).cast("int")
    keyed = copies.withColumn("shuffle_key", key).repartitionById(width, part)
    return restored(keyed.sortWithinPartitions("shuffle_key"), "n_copies", "copy", "shuffle_key")


def op8_mix(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    return poisson_mix(docs)


SQL = {"op8_mix": f"""
WITH sizes AS (SELECT source, sum(coalesce(length(text), 0)) AS chars FROM documents GROUP BY source),
wished AS (SELECT *, pow(chars::DOUBLE, 0.5) AS wish FROM sizes),
rated AS (SELECT source, round(CASE WHEN chars > 0 THEN sum(chars) OVER () * 1.0 * wish / sum(wish) OVER () / chars
          ELSE 1 END, 9) AS rate FROM wished),
parted AS (SELECT *, greatest(1, ceil(rate / {PART}))::INT AS parts FROM rated),
terms AS (SELECT source, k, sum(exp(-rate / parts) * pow(rate / parts, k) / gamma(k + 1)) OVER (PARTITION BY source ORDER BY k) AS c
          FROM parted, range(0, {TERMS} + 1) AS r(k)),
tables AS (SELECT source, list(c ORDER BY k) AS cs FROM terms GROUP BY source),
drawn AS (SELECT d.*, list_sum(list_transform(range(1, p.parts + 1), lambda j: len(list_filter(t.cs, lambda c: c <=
          ('0x' || substr(md5('17|' || coalesce(doc_id::VARCHAR, md5(coalesce(text, ''))) || '|' || j), 1, 13))::BIGINT::DOUBLE
          / {UNIT})))) AS n
          FROM documents d JOIN parted p ON d.source IS NOT DISTINCT FROM p.source
          JOIN tables t ON t.source IS NOT DISTINCT FROM p.source),
copies AS (SELECT *, unnest(range(1, n::BIGINT + 1)) AS copy FROM drawn WHERE n > 0)
SELECT doc_id, text, lang, source, n_chars, n::BIGINT AS n_copies, copy,
       md5('17:order|' || coalesce(doc_id::VARCHAR, md5(coalesce(text, ''))) || '|' || copy) AS shuffle_key FROM copies"""}
