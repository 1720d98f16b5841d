"""Personal data in text: patterns propose spans, checksums confirm them, words nearby move the score.

Everything is DataFrame expressions. A pattern is run twice over a text that has matches: once for the matches, once for
the pieces between them; the lengths of both give the positions. Patterns take a run of characters at its start only
and never step back into it, so a text of millions of characters without a blank is still read once.

Kinds ``email``, ``ip``, ``card`` and ``phone`` are kept whatever their score; ``iban`` (mod 97) and ``ssn`` (no checksum, so
it needs a context word) are added when the score reaches ``min_score``.

Null and empty texts have no spans. Repeated rows are judged one by one. Other columns are kept, but for
``pii_`` columns in ``find_spans``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from propensight.llm.common import shielded, table

# Leftmost matches that do not overlap. Possessive quantifiers and look-behinds change the cost only, not the matches:
# `\G` lets an address begin where the one before ended inside a run.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
BASE = ("email", "ip", "card", "phone")
# A character every match of the kind has; texts without it are not searched.
NEEDS = {"email": "@", "ip": ".", "phone": "+", "ssn": "-"}
SCORES = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.8, "ssn": 0.4}
# Words that make a kind more likely, and words that speak against any kind.
CONTEXT = {
    "email": "mail|contact|write to|correo|courriel|kontakt",
    "ip": "ip|address|host|server|adresse",
    "card": "card|visa|mastercard|credit|karte|carte|tarjeta",
    "phone": "phone|call|tel|fax|mobile|telefon",
    "iban": "iban|account|bank|konto|compte|cuenta",
    "ssn": "ssn|social security|tax id",
}
AGAINST = "version|order|invoice|isbn|release|serial"
NEAR = 40  # characters before a match that are searched for these words
UP, DOWN = 0.15, 0.25
BLOCK = 256  # running sums of a text with many matches are taken in blocks of this size


def running_sum(lengths: Column) -> Column:
    """For each element the sum of those before it. Two levels, so that the cost stays near the number of elements."""
    def scan(items: Column, first: Column) -> Column:
        return F.aggregate(
            items, F.struct(first.cast("long").alias("at"), F.array().cast("array<bigint>").alias("out")),
            lambda acc, n: F.struct((acc["at"] + n).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")),
            lambda acc: acc["out"])

    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / BLOCK).cast("int")),
                         lambda b: F.slice(lengths, b * BLOCK + 1, BLOCK))
    totals = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0).cast("long"), lambda s, n: s + n))
    return F.flatten(F.transform(F.arrays_zip(blocks.alias("b"), scan(totals, F.lit(0)).alias("o")),
                                 lambda z: scan(z["b"], z["o"])))


def digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """From the right every second digit counts double, its own digits added; the sum ends in 0."""
    backwards = F.reverse(number)

    def value(i: Column) -> Column:
        digit = backwards.substr(i, F.lit(1))
        return F.when(i % 2 == 0, F.translate(digit, "0123456789", "0246813579")).otherwise(digit).cast("int")

    return F.aggregate(F.sequence(F.lit(1), F.length(number)), F.lit(0), lambda s, i: s + value(i)) % 10 == 0


def mod97(code: Column) -> Column:
    """The country code and check digits move to the end, letters count 10 to 35, the remainder is 1."""
    plain = F.regexp_replace(code, " ", "")
    turned = F.concat(F.substring(plain, 5, 40), F.substring(plain, 1, 4))

    def step(acc: Column, i: Column) -> Column:
        char = turned.substr(i, F.lit(1))
        return F.when(char.between("0", "9"), acc * 10 + char.cast("int")).otherwise(acc * 100 + F.ascii(char) - 55) % 97

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), step) == 1


def confirmed(kind: str, match: Column) -> Column:
    if kind == "ip":
        part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
        return match.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        number = digits(match)
        return F.length(number).between(13, 19) & F.when(F.length(number).between(13, 19), luhn(number)).otherwise(False)
    if kind == "phone":
        return F.length(digits(match)).between(9, 15)
    if kind == "iban":
        return F.length(F.regexp_replace(match, " ", "")).between(15, 34) & mod97(match)
    if kind == "ssn":
        return ~match.rlike("^(?:000|666|9..)-|-00-|-0000$")
    return F.lit(True)


def spans_of(kind: str, found: Column, gaps: Column, before: Column, min_score: float) -> Column:
    """Confirmed matches of one kind with positions in code points, the end exclusive."""
    def span(z: Column) -> Column:
        gap, match = z["gap"], z["match"]
        near = F.lower(F.right(gap, F.lit(NEAR)))
        start = z["before"] + F.length(gap)
        score = (F.lit(SCORES[kind]) + F.when(near.rlike(rf"\b(?:{CONTEXT[kind]})"), UP).otherwise(0.0)
                 - F.when(near.rlike(rf"\b(?:{AGAINST})\b"), DOWN).otherwise(0.0))
        return F.struct(F.lit(kind).alias("kind"), start.cast("long").alias("start"),
                        (start + F.length(match)).cast("long").alias("end"),
                        F.round(F.least(F.lit(1.0), F.greatest(F.lit(0.0), score)), 2).alias("score"),
                        confirmed(kind, match).alias("ok"))

    zipped = F.arrays_zip(found.alias("match"), F.slice(gaps, F.lit(1), F.size(found)).alias("gap"), before.alias("before"))
    kept = F.filter(F.transform(zipped, span),
                    lambda s: s["ok"] if kind in BASE else s["ok"] & (s["score"] >= min_score))
    plain = F.transform(kept, lambda s: F.struct(s["kind"], s["start"], s["end"], s["score"]))
    return F.when(F.size(found) > 0, plain).otherwise(F.array().cast(SPANS))


SPANS = "array<struct<kind:string,start:bigint,end:bigint,score:double>>"


def find_spans(docs: DataFrame, text: str = "text", min_score: float = 0.5) -> DataFrame:
    """Adds ``pii_spans``: all spans by kind as listed above, then start. Other columns stay."""
    whole = F.coalesce(F.col(text), F.lit(""))
    found = {k: F.regexp_extract_all(whole, F.lit(p), F.lit(0)) for k, p in PATTERNS.items()}
    found = {k: F.when(F.contains(whole, F.lit(NEEDS[k])), m).otherwise(F.array().cast("array<string>")) if k in NEEDS else m
             for k, m in found.items()}
    docs = docs.drop(*[c for c in docs.columns if c.startswith("pii_")])
    # Each step is a column of its own: an expression inside a lambda would be computed for every element.
    steps = docs.withColumns({f"pii_found_{k}": m for k, m in found.items()})
    steps = steps.withColumns({f"pii_gaps_{k}": F.when(F.size(f"pii_found_{k}") > 0, F.split(whole, PATTERNS[k], -1)) for k in PATTERNS})
    steps = steps.withColumns({f"pii_sizes_{k}": F.zip_with(f"pii_found_{k}", F.slice(f"pii_gaps_{k}", F.lit(1), F.size(f"pii_found_{k}")),
                                                            lambda m, g: F.length(m) + F.length(g)) for k in PATTERNS})
    steps = steps.withColumns({f"pii_before_{k}": running_sum(F.col(f"pii_sizes_{k}")) for k in PATTERNS})
    steps = steps.withColumns({f"pii_of_{k}": spans_of(k, *(F.col(f"pii_{x}_{k}") for x in ("found", "gaps", "before")), min_score)
                               for k in PATTERNS})
    return steps.withColumn("pii_spans", F.concat(*[F.col(f"pii_of_{k}") for k in PATTERNS])).drop(
        *[f"pii_{x}_{k}" for k in PATTERNS for x in ("found", "gaps", "sizes", "before", "of")])


def described(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def merged(spans: Column) -> Column:
    """Spans in text order, overlapping ones as one with the kind of the first."""
    piece = "struct<kind:string,start:bigint,end:bigint>"
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"),
                                                                 s["kind"].alias("kind"))))

    def step(acc: Column, s: Column) -> Column:
        open_, done = acc["open"], acc["done"]
        own = F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))
        longer = F.struct(open_["kind"].alias("kind"), open_["start"].alias("start"),
                          F.greatest(open_["end"], s["end"]).alias("end"))
        joined = F.struct(longer.cast(piece).alias("open"), done.alias("done"))
        fresh = F.struct(own.cast(piece).alias("open"),
                         F.when(open_.isNull(), done).otherwise(F.concat(done, F.array(open_))).alias("done"))
        return F.when(open_.isNotNull() & (s["start"] < open_["end"]), joined).otherwise(fresh)

    return F.aggregate(ordered, F.struct(F.lit(None).cast(piece).alias("open"),
                                         F.array().cast(f"array<{piece}>").alias("done")), step,
                       lambda acc: F.concat(acc["done"], F.array(acc["open"])))


def mask(docs: DataFrame, text: str = "text", min_score: float = 0.5) -> DataFrame:
    """Replaces every span, overlapping ones as one, by its kind in brackets. Null texts stay null."""
    rows, restored = shielded(docs, (text,))
    found = find_spans(rows, text, min_score).withColumn(
        "pii_merged", F.when(F.size("pii_spans") > 0, merged(F.col("pii_spans"))))
    spans, whole = F.col("pii_merged"), F.col(text)
    parts = F.transform(spans, lambda s, i: F.concat(
        whole.substr((F.when(i > 0, F.get(spans, i - 1)["end"]).otherwise(0) + 1).cast("int"),
                     (s["start"] - F.when(i > 0, F.get(spans, i - 1)["end"]).otherwise(0)).cast("int")),
        F.lit("["), F.upper(s["kind"]), F.lit("]")))
    last = F.get(spans, F.size(spans) - 1)["end"]
    clean = F.concat(F.array_join(parts, ""), whole.substr((last + 1).cast("int"), F.length(whole)))
    return restored(found.withColumn(text, F.when(spans.isNull(), whole).otherwise(clean)))


def op5_pii(spark, sf_dir: str) -> DataFrame:
    spans = F.col("pii_spans")
    base = F.filter(spans, lambda s: s["kind"].isin(*BASE))

    def of(kind: str) -> Column:
        return F.filter(spans, lambda s: s["kind"] == kind)

    return find_spans(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id",
        *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in BASE],
        F.sha2(described(base), 256).alias("base_sha256"), described(spans).alias("spans"))


def _sql() -> str:
    """DuckDB: the plain patterns, positions as sums over the pieces between the matches."""
    plain = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
             "card": r"[0-9](?:[\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
             "iban": r"\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}\b", "ssn": r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b"}
    number = "regexp_replace(x.m, '[^0-9]', '', 'g')"
    code = "replace(x.m, ' ', '')"
    tests = {
        "email": "true",
        "ip": "list_max(list_transform(string_split(x.m, '.'), lambda p: cast(p AS HUGEINT))) <= 255",
        "card": f"length({number}) BETWEEN 13 AND 19 AND list_sum(list_transform(range(1, length({number}) + 1), lambda i: CASE WHEN "
                f"i % 2 = 0 THEN cast(translate(substr(reverse({number}), i, 1), '0123456789', '0246813579') AS INT) "
                f"ELSE cast(substr(reverse({number}), i, 1) AS INT) END)) % 10 = 0",
        "phone": f"length({number}) BETWEEN 9 AND 15",
        "iban": f"length({code}) BETWEEN 15 AND 34 AND list_reduce(list_prepend(0, list_transform(string_split(substr({code}, 5) || "
                f"left({code}, 4), ''), lambda c: CASE WHEN c BETWEEN '0' AND '9' THEN cast(c AS INT) ELSE ascii(c) - 55 END)), "
                "lambda a, c: (CASE WHEN c > 9 THEN a * 100 ELSE a * 10 END + c) % 97) = 1",
        "ssn": "NOT regexp_matches(x.m, '^(?:000|666|9..)-|-00-|-0000$')",
    }
    ctes, columns = [], []
    for n, (kind, pattern) in enumerate(plain.items()):
        near = f"lower(right(x.g, {NEAR}))"
        score = (f"round({SCORES[kind]} + CASE WHEN regexp_matches({near}, '\\b(?:{CONTEXT[kind]})') THEN {UP} ELSE 0 END - "
                 f"CASE WHEN regexp_matches({near}, '\\b(?:{AGAINST})\\b') THEN {DOWN} ELSE 0 END, 2)")
        keep = tests[kind] if kind in BASE else f"({tests[kind]}) AND {score} >= 0.5"
        ctes.append(f"""
        f{n} AS (SELECT rid, m, g, i, sum(length(g) + length(m)) OVER (PARTITION BY rid ORDER BY i) - length(m) AS s FROM (
            SELECT rid, unnest(m) AS m, unnest(g[1:len(m)]) AS g, unnest(range(1, len(m) + 1)) AS i FROM (
                SELECT rid, regexp_extract_all(t, '{pattern}') AS m, string_split_regex(t, '{pattern}') AS g FROM d
                WHERE regexp_matches(t, '{pattern}')))),
        k{n} AS (SELECT rid, count(*) AS n, string_agg('{kind}:' || s || ':' || (s + length(m)), ',' ORDER BY s) AS x
            FROM f{n} AS x WHERE {keep} GROUP BY rid)""")
        columns.append(f"k{n}.x")
    joins = " ".join(f"LEFT JOIN k{n} USING (rid)" for n in range(len(plain)))
    counts = ", ".join(f"coalesce(k{n}.n, 0)::BIGINT AS n_{k}" for n, k in enumerate(plain) if k in BASE)
    return (f"WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents), {','.join(ctes)} "
            f"SELECT doc_id, {counts}, sha256(concat_ws(',', {', '.join(columns[:4])})) AS base_sha256, "
            f"concat_ws(',', {', '.join(columns)}) AS spans FROM d {joins}")


SQL = {"op5_pii": _sql()}
