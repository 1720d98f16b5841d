"""URL filter: rules first, then trust and distrust that spread over the links between hosts.

A page's host and path are matched against rules (host with all subdomains, start of the path; the longest rule wins).
Hosts are seeds to the share of their pages that rules allow (trust) or block (distrust). Trust runs along links from a
host to those it links to, distrust against them, from a bad host to those that link to it; both are personalised
PageRank on an absolute scale, so a host without links keeps its seed. A page without a rule is blocked if its host's
distrust exceeds its trust by ``threshold``.

Links are absolute or scheme-relative `href`s in the html; links of a host to itself do not count. Each iteration is one
join and one aggregation of edges, written to the shared folder; iteration goes on until no host changes by more than ``change``.

Null urls and urls without `://` have empty host and path; the empty host is judged like any other. A null html has no
links. Repeated rows are judged alike and count as often as they occur. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from propensight.llm.common import ascii_lower, table
from propensight.session import materialize

# (verdict, host, start of path)
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
LINK = r"""(?i)\bhref\s*=\s*["']?\s*((?:[a-z][a-z0-9+.-]*:)?//[^\s"'<>]+)"""
DAMPING, THRESHOLD = 0.85, 0.5
CHANGE = 1e-6  # iteration ends when no host's trust or distrust changes by more


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(ascii_lower(rest), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest fitting rule as a struct of text and verdict, or null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, name, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit(start))
        out = F.when(fits, F.struct(F.lit(name + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def judged(pages: DataFrame, rules=RULES) -> DataFrame:
    url = F.col("url")
    split = pages.withColumns({"host": host_of(url), "path": path_of(url)})
    return split.withColumn("fit", rule_of(F.col("host"), F.col("path"), rules))


def host_edges(pages: DataFrame) -> DataFrame:
    """Links between hosts with their number, as a share of the source's and of the target's links."""
    links = F.transform(F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(LINK), F.lit(1)),
                        lambda u: host_of(F.concat(F.lit("x:"), F.regexp_replace(u, r"^[^/]*:", ""))))
    other = F.array_distinct(F.filter(links, lambda h: h != host_of(F.col("url"))))
    edges = (pages.select(host_of(F.col("url")).alias("src"), F.explode(other).alias("dst"))
             .groupBy("src", "dst").agg(F.count("*").alias("n")))
    outgoing = edges.groupBy("src").agg(F.sum("n").alias("n_out"))
    incoming = edges.groupBy("dst").agg(F.sum("n").alias("n_in"))
    return edges.join(outgoing, "src").join(incoming, "dst").select(
        "src", "dst", (F.col("n") / F.col("n_out")).alias("forward"), (F.col("n") / F.col("n_in")).alias("backward"))


def spread(seeds: DataFrame, edges: DataFrame, change: float = CHANGE, damping: float = DAMPING) -> DataFrame:
    """Trust and distrust of every host. Scaled so that a host that nothing points to keeps its seed.

    A round changes the sum over all hosts by at most ``damping`` times what the round before did, so it ends.
    """
    scores, k = seeds.select("host", "trust", "distrust"), 0
    while True:
        ahead = edges.join(scores, edges.src == scores.host).select(
            F.col("dst").alias("to"), (F.col("forward") * F.col("trust")).alias("t"), F.lit(0.0).alias("d"), F.lit(0.0).alias("was_t"), F.lit(0.0).alias("was_d"))
        back = edges.join(scores, edges.dst == scores.host).select(
            F.col("src").alias("to"), F.lit(0.0).alias("t"), (F.col("backward") * F.col("distrust")).alias("d"), F.lit(0.0).alias("was_t"), F.lit(0.0).alias("was_d"))
        before = scores.select(F.col("host").alias("to"), F.lit(0.0).alias("t"), F.lit(0.0).alias("d"), F.col("trust").alias("was_t"), F.col("distrust").alias("was_d"))
        got = ahead.unionAll(back).unionAll(before).groupBy("to").agg(*[F.sum(c).alias(c) for c in ("t", "d", "was_t", "was_d")])
        both = seeds.join(got, F.col("host") == F.col("to"), "full")
        following = lambda seed, x: F.round(F.coalesce(seed, F.lit(0.0)) + damping * F.coalesce(x, F.lit(0.0)), 9)
        new = both.select(F.coalesce("host", "to").alias("host"), following(F.col("trust"), F.col("t")).alias("trust"),
                          following(F.col("distrust"), F.col("d")).alias("distrust"), "was_t", "was_d")
        gap = F.greatest(F.abs(F.col("trust") - F.coalesce("was_t", F.lit(0.0))), F.abs(F.col("distrust") - F.coalesce("was_d", F.lit(0.0))))
        written = materialize(new.select("host", "trust", "distrust", gap.alias("gap")), f"host_scores_{k}")
        scores, k = written.select("host", "trust", "distrust"), k + 1
        if written.filter(F.col("gap") > change).isEmpty():
            return scores


def host_verdicts(pages: DataFrame, rules=RULES, change: float = CHANGE, threshold: float = THRESHOLD) -> DataFrame:
    fits = judged(pages.select("url"), rules).select("host", F.col("fit.verdict").alias("verdict"))
    share = lambda v: F.avg(F.coalesce(F.col("verdict") == v, F.lit(False)).cast("double"))
    seeds = materialize(fits.groupBy("host").agg(share("allow").alias("trust"), share("block").alias("distrust")), "host_seeds")
    edges = materialize(host_edges(pages), "host_edges")
    # Without a link between hosts the seeds are the result.
    scores = seeds if edges.isEmpty() else spread(seeds, edges, change)
    gap = F.round(F.col("distrust") - F.col("trust"), 6)
    return scores.select("host", F.when(gap >= threshold, "block").otherwise("allow").alias("host_verdict"))


def filter_urls(pages: DataFrame, rules=RULES, change: float = CHANGE, threshold: float = THRESHOLD) -> DataFrame:
    """``page_id, host, path, rule, verdict`` per page."""
    pages = pages.select("page_id", "url", "html")
    hosts = host_verdicts(pages, rules, change, threshold)
    blocked = hosts.filter("host_verdict = 'block'").select(F.col("host").alias("bad_host"))
    # Hot hosts: the side of the pages is narrow and adaptive execution splits their partition.
    rows = judged(pages.select("page_id", "url"), rules).join(blocked, F.col("host") == F.col("bad_host"), "left")
    method = F.when(F.col("bad_host").isNotNull(), "block").otherwise("allow")
    return rows.select("page_id", "host", "path", F.col("fit.rule").alias("rule"),
                       F.coalesce(F.col("fit.verdict"), method).alias("verdict"))


def op7_urls(spark, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"))


def _sql() -> str:
    host = lambda u: f"translate(regexp_extract({u}, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    ordered = sorted(RULES, key=lambda r: -len(r[1] + r[2]))
    when = lambda value: " ".join(f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{value(v, h, p)}'"
                                  for v, h, p in ordered)
    scores = f"""
    r AS (SELECT 0 AS k, host, trust, distrust, 1.0::DOUBLE AS gap FROM s0 UNION ALL
      SELECT x.k, x.host, x.trust, x.distrust, max(greatest(abs(x.trust - x.was_t), abs(x.distrust - x.was_d))) OVER () FROM (
        SELECT k, host, round(sum(seed_t) + {DAMPING} * sum(t), 9) AS trust, round(sum(seed_d) + {DAMPING} * sum(d), 9) AS distrust,
               sum(was_t) AS was_t, sum(was_d) AS was_d FROM (
          SELECT r.k + 1 AS k, e.dst AS host, 0 AS seed_t, 0 AS seed_d, forward * trust AS t, 0 AS d, 0 AS was_t, 0 AS was_d
            FROM r JOIN edges e ON e.src = r.host WHERE gap > {CHANGE} UNION ALL
          SELECT r.k + 1, e.src, 0, 0, 0, backward * distrust, 0, 0 FROM r JOIN edges e ON e.dst = r.host WHERE gap > {CHANGE} UNION ALL
          SELECT r.k + 1, r.host, coalesce(s.trust, 0), coalesce(s.distrust, 0), 0, 0, r.trust, r.distrust
            FROM r LEFT JOIN s0 s ON s.host = r.host WHERE gap > {CHANGE}) GROUP BY k, host) x),
    s AS (SELECT host, arg_max(trust, k) AS trust, arg_max(distrust, k) AS distrust FROM r GROUP BY host)"""
    link = LINK.replace("(?i)", "").replace("'", "''")
    return f"""
    WITH RECURSIVE p AS (SELECT page_id, coalesce({host('url')}, '') AS host,
        coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path, html FROM pages),
    f AS (SELECT *, CASE {when(lambda v, h, p: h + p)} END AS rule, CASE {when(lambda v, h, p: v)} END AS fit FROM p),
    l AS (SELECT host AS src, unnest(list_distinct(list_transform(regexp_extract_all(coalesce(html, ''), '{link}', 1, 'i'),
        lambda u: {host("('x:' || regexp_replace(u, '^[^/]*:', ''))")}))) AS dst FROM p),
    n AS (SELECT src, dst, count(*) AS n FROM l WHERE src <> dst GROUP BY ALL),
    edges AS (SELECT src, dst, n / sum(n) OVER (PARTITION BY src) AS forward, n / sum(n) OVER (PARTITION BY dst) AS backward FROM n),
    s0 AS MATERIALIZED (SELECT host, avg((coalesce(fit, '') = 'allow')::INT) AS trust, avg((coalesce(fit, '') = 'block')::INT) AS distrust
        FROM f GROUP BY host),{scores}
    SELECT page_id, f.host, path, rule, coalesce(fit, CASE WHEN round(distrust - trust, 6) >= {THRESHOLD} THEN 'block' ELSE 'allow' END)
        AS verdict FROM f JOIN s ON f.host = s.host"""


SQL = {"op7_urls": _sql()}
