"""Named DuckDB sub-queries. ``with_ctes`` puts in front of a query all those it uses, directly or not."""

from __future__ import annotations

import datetime as dt
import re

from harness import fixtures as X
from propensight import constants as C
from propensight.operators.shapley import GROUPS

P = X.PARAMS
DAY = dt.timedelta(days=1)
CUT = X.CUTOFF
SEED = P.seed
N = P.samples
NB = P.background
MAX_STEPS = P.max_len
WIDTH = len(C.SPACE_STEP)
DEPT, CAT, SUB = C.CODED_COLUMNS
EVENT = ["event_id", "event_env", "product_qty", "product_price", "key", "product_id"]
VISIT = ["visit_timestamp", *C.VISIT_NUMERIC, "device"]
PRODUCT = [*C.PRODUCT_NUMERIC, *C.CODED_COLUMNS]

# Coefficients of the classifier the explainers are checked with; the same text runs in both engines.
STEP_SCORE = ("0.03e0 * abs(product_price) + 0.6e0 * CAST(event_env = 4 AS int) - 0.4e0 * CAST(event_env = 1 AS int) "
              "+ 0.05e0 * product_qty + 0.02e0 * nb_pages - 0.03e0 * unique_pages - 0.000002e0 * abs(delta_time) "
              "+ 0.00001e0 * abs(duration) + 0.15e0 * CAST(week_day = 7 AS int) + 0.002e0 * latitude "
              "- 0.001e0 * longitude + 0.2e0 * CAST(device = 4 AS int) + 0.04e0 * product_rating "
              "+ 0.1e0 * CAST(product_department = 2 AS int) - 0.01e0 * product_category")
FIXED_SCORE = "0.1e0 - 0.35e0 * abs(inactivity)"


def d(day: dt.date) -> str:
    return f"DATE '{day.isoformat()}'"


def day_of(ts: str) -> str:
    return f"CAST({ts} AS date)"


def r6(x: str, digits: int = 6) -> str:
    """Rounded, without a negative zero."""
    return f"(round({x}, {digits}) + 0e0)"


def norm(x: str) -> str:
    c = f"lower(trim({x}))"
    missing = ", ".join(f"'{m}'" for m in C.MISSING_CATEGORIES)
    renames = " ".join(f"WHEN {c} = '{a}' THEN '{b}'" for a, b in C.CATEGORY_RENAMES.items())
    return f"CASE WHEN {c} IN ({missing}) THEN '' {renames} ELSE {c} END"


def u(feature: str, part: int = 0, step: str = "step") -> str:
    key = f"md5(concat_ws('|', '{SEED}', owner, sample, {step}, '{feature}'))"
    return f"(CAST('0x' || substr({key}, {8 * part + 1}, 8) AS BIGINT) / 4294967296e0)"


def normal(feature: str, step: str = "step") -> str:
    return (f"(sqrt(-2e0 * ln({u(feature, 0, step)} + 0.5e0 / 4294967296e0)) "
            f"* cos({2 * 3.141592653589793!r}e0 * {u(feature, 1, step)}))")


CTES: dict[str, str] = {k: v for k, (v, _) in X.VIEWS.items()}

CTES["known"] = "SELECT DISTINCT id, TRUE AS known FROM fx_known"
CTES["events_known"] = "SELECT e.id, e.event_timestamp, k.known FROM fx_events e JOIN known k USING (id)"


def _extract(cut: dt.date) -> None:
    s = cut.strftime("%Y%m%d")
    begin, end = d(P.begin(cut)), d(P.end(cut))
    ts = day_of("event_timestamp")
    CTES[f"pending_{s}"] = (f"SELECT DISTINCT id FROM events_known WHERE {ts} <= {d(cut)} "
                            f"AND {ts} > {d(cut - P.pending * DAY)} AND known")
    CTES[f"active_{s}"] = (f"SELECT id, count(*) AS cnt FROM fx_events WHERE id IN (SELECT id FROM pending_{s}) "
                           f"AND {ts} >= {begin} AND {ts} < {d(cut)} GROUP BY id HAVING count(*) > {P.min_events}")
    CTES[f"visits_{s}"] = (f"SELECT key, {', '.join(VISIT)} FROM fx_visits WHERE {day_of('visit_timestamp')} >= {begin} "
                           f"AND {day_of('visit_timestamp')} < {end}")
    CTES[f"extract_{s}"] = f"""
SELECT {d(cut)} AS data_date, e.id, e.event_timestamp, {', '.join('e.' + c for c in EVENT)},
       dayname(e.event_timestamp) AS week_day, strftime(e.event_timestamp, '%m') AS month,
       {', '.join('v.' + c for c in VISIT)}, {', '.join('p.' + c for c in PRODUCT)}
FROM fx_events e LEFT JOIN visits_{s} v ON e.key = v.key JOIN fx_products p ON e.product_id = p.product_id
WHERE e.id IN (SELECT id FROM active_{s}) AND {day_of('e.event_timestamp')} >= {begin}
  AND {day_of('e.event_timestamp')} < {end}"""


for _cut in sorted({*X.CUTOFFS, X.EARLIER, CUT}):
    _extract(_cut)
CTES["extract"] = f"SELECT * FROM extract_{CUT:%Y%m%d}"
CTES["extract_early"] = f"SELECT * FROM extract_{X.EARLIER:%Y%m%d}"
CTES["extract_many"] = " UNION ALL ".join(f"SELECT * FROM extract_{c:%Y%m%d}" for c in X.CUTOFFS)

# Event-level features
CTES["secs"] = "SELECT * REPLACE (date_trunc('second', event_timestamp) AS event_timestamp) FROM extract"
CTES["delta"] = """
SELECT *, CAST(coalesce(epoch(event_timestamp) - epoch(lag(event_timestamp) OVER (
         PARTITION BY data_date, id ORDER BY event_timestamp, event_id, visit_timestamp)), 0) AS BIGINT) AS delta_time
FROM secs"""
_fills = ", ".join([f"coalesce({c}, 0) AS {c}" for c in C.EVENT_NUMERIC + C.VISIT_NUMERIC + C.PRODUCT_NUMERIC]
                   + [f"coalesce({c}, '') AS {c}" for c in C.INDICATOR_COLUMNS]
                   + [f"coalesce({c}, '0') AS {c}" for c in C.CODED_COLUMNS])
CTES["filled"] = f"SELECT * REPLACE ({_fills}), {day_of('event_timestamp')} AS event_date FROM delta WHERE id IS NOT NULL"
CTES["clean"] = ("SELECT * REPLACE (" + ", ".join(f"{norm(c)} AS {c}" for c in C.INDICATOR_COLUMNS) + ") FROM filled")


def _distinct(column: str, table: str) -> str:
    raw = f"lower(trim({column}))"
    return (f"SELECT DISTINCT {norm(column)} AS value FROM {table} WHERE {column} IS NOT NULL "
            f"AND {raw} NOT IN ('unknown', '?')")


CTES["env_values"] = _distinct("event_env", "fx_events")
CTES["device_values"] = _distinct("device", "fx_visits")


def _numbered(values: str, feature: str, seed: tuple[str, int]) -> str:
    return (f"SELECT '{feature}' AS feature, '{seed[0]}' AS value, CAST({seed[1]} AS INTEGER) AS code UNION ALL "
            f"SELECT '{feature}', value, CAST({seed[1]} + row_number() OVER (ORDER BY value) AS INTEGER) "
            f"FROM ({values}) WHERE value <> '{seed[0]}'")


CTES["slots"] = (_numbered("SELECT value FROM env_values", "event_env", C.SLOT_SEED) + " UNION ALL "
                 + _numbered("SELECT value FROM device_values", "device", C.SLOT_SEED))


def _vocabulary(extract: str) -> str:
    return " UNION ALL ".join(
        _numbered(f"SELECT DISTINCT {c} AS value FROM {extract} WHERE {c} NOT IN ('', '?')", c, C.VOCABULARY_SEED)
        for c in C.CODED_COLUMNS)


CTES["vocab"] = _vocabulary("filled")
CTES["vocab_early"] = _vocabulary("extract_early")
CTES["vocab_grown"] = "SELECT * FROM vocab_early UNION ALL " + " UNION ALL ".join(f"""
SELECT '{c}' AS feature, value,
       CAST((SELECT max(code) FROM vocab_early WHERE feature = '{c}') + row_number() OVER (ORDER BY value) AS INTEGER)
FROM (SELECT DISTINCT {c} AS value FROM filled WHERE {c} NOT IN ('', '?')
      AND {c} NOT IN (SELECT value FROM vocab_early WHERE feature = '{c}'))""" for c in C.CODED_COLUMNS)

_week_index = "CASE week_day " + " ".join(f"WHEN '{w}' THEN {i + 1}" for i, w in enumerate(C.WEEK_DAYS)) + " ELSE 0 END"
CTES["feat"] = f"""
SELECT c.*, {_week_index} AS week_index, CAST(month AS INTEGER) AS month_index,
       se.code AS event_env_slot, sd.code AS device_slot,
       {', '.join(f"coalesce(v{i}.code, 0) AS {c}_code" for i, c in enumerate(C.CODED_COLUMNS))}
FROM clean c JOIN slots se ON se.feature = 'event_env' AND se.value = c.event_env
JOIN slots sd ON sd.feature = 'device' AND sd.value = c.device
{' '.join(f"LEFT JOIN vocab v{i} ON v{i}.feature = '{c}' AND v{i}.value = c.{c}" for i, c in enumerate(C.CODED_COLUMNS))}"""


def _ind(index: str, width: int, first: int) -> str:
    return f"list_transform(range({first}, {first + width}), lambda i: CAST(CAST(i = {index} AS INTEGER) AS FLOAT))"


CTES["vectors"] = f"""
SELECT *, list_concat(list_concat(list_concat({_ind('week_index', 7, 1)}, {_ind('month_index', 12, 1)}),
          list_concat({_ind('event_env_slot', C.INDICATOR_SLOTS, 0)}, {_ind('device_slot', C.INDICATOR_SLOTS, 0)})),
          [{', '.join(f'CAST({c} AS FLOAT)' for c in C.NUMERIC_COLUMNS)}]) AS num,
       [{', '.join(f'{c}_code' for c in C.CODED_COLUMNS)}] AS cat
FROM feat"""

# Per id
CTES["label"] = f"""
SELECT data_date, id, max(CASE WHEN event_env = 'purchase' AND event_timestamp > CAST(data_date AS timestamp)
       AND event_timestamp <= CAST(data_date + {P.horizon} AS timestamp) THEN 1 ELSE 0 END) AS label
FROM vectors GROUP BY data_date, id"""
CTES["idle"] = """
SELECT data_date, id, (epoch(CAST(data_date + 1 AS timestamp)) - epoch(max(event_timestamp))) / 86400e0 AS inactivity
FROM vectors WHERE event_date <= data_date GROUP BY data_date, id"""
CTES["last_k"] = f"""
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY data_date, id
       ORDER BY event_timestamp DESC, event_id DESC, visit_timestamp DESC) AS rn
  FROM vectors WHERE event_date <= data_date) WHERE rn <= {P.max_len}"""
CTES["steps"] = """
SELECT k.*, CAST(row_number() OVER w - 1 AS INTEGER) AS step,
       CAST(count(*) OVER (PARTITION BY k.data_date, k.id) AS INTEGER) AS seq_length, l.label, i.inactivity
FROM last_k k JOIN label l ON k.data_date = l.data_date AND k.id = l.id
JOIN idle i ON k.data_date = i.data_date AND k.id = i.id
WINDOW w AS (PARTITION BY k.data_date, k.id ORDER BY event_timestamp, event_id, visit_timestamp)"""
CTES["seqs"] = """
SELECT data_date, id, any_value(seq_length) AS seq_length, any_value(label) AS label,
       any_value(inactivity) AS inactivity FROM steps GROUP BY data_date, id"""

# Explainer space
_f = lambda c: f"CAST(CAST({c} AS FLOAT) AS DOUBLE)"
_space = {c: _f(c) for c in C.SPACE_NUMERIC}
_space |= {"week_day": "CAST(week_index AS DOUBLE)", "month": "CAST(month_index AS DOUBLE)",
           "event_env": "CAST(event_env_slot + 1 AS DOUBLE)", "device": "CAST(device_slot + 1 AS DOUBLE)"}
_space |= {c: f"{_f(c)} + 1" for c in C.SPACE_SHIFTED}
_space["product_qty"] = "CASE WHEN product_qty < 0 THEN product_qty - 2e0 ELSE product_qty + 1e0 END"
_space |= {c: f"CAST({c}_code AS DOUBLE)" for c in C.CODED_COLUMNS}
_space["inactivity"] = _f("inactivity")
CTES["space"] = (f"SELECT data_date, id, step, seq_length, label, {', '.join(f'{_space[c]} AS {c}' for c in C.SPACE_ALL)} "
                 "FROM steps")


def _kind(f: str) -> str:
    return "num" if f in C.SPACE_NUMERIC else "fixed" if f in C.SPACE_FIXED else "cat"


def _stat(f: str, step: str, where: str = "") -> str:
    return (f"SELECT {step} AS step, '{f}' AS feature, '{_kind(f)}' AS kind, count({f}) AS n, avg({f}) AS mean, "
            f"stddev_pop({f}) AS std, min({f}) AS min, max({f}) AS max FROM space {where}")


CTES["stats"] = (" UNION ALL ".join(_stat(f, "step", "GROUP BY step") for f in C.SPACE_STEP)
                 + " UNION ALL " + _stat("inactivity", "-1", "WHERE step = 0"))
CTES["stats_step"] = " UNION ALL ".join(_stat(f, "step", "GROUP BY step") for f in C.SPACE_ALL)
CTES["freq0"] = " UNION ALL ".join(
    f"SELECT step, '{f}' AS feature, {f} AS value, count(*) AS cnt FROM space WHERE {f} <> 0 GROUP BY step, {f}"
    for f in C.SPACE_CATEGORICAL)
CTES["freq"] = """
SELECT *, sum(cnt) OVER (PARTITION BY step, feature ORDER BY value ROWS UNBOUNDED PRECEDING) - cnt AS c_lo,
       sum(cnt) OVER (PARTITION BY step, feature ORDER BY value ROWS UNBOUNDED PRECEDING) AS c_hi,
       sum(cnt) OVER (PARTITION BY step, feature) AS total FROM freq0"""
CTES["hier"] = f"""
SELECT CAST({DEPT} AS INTEGER) AS dept, CAST({CAT} AS INTEGER) AS cat,
       list_sort(list(DISTINCT CAST({SUB} AS INTEGER))) AS subcats FROM space GROUP BY 1, 2"""
CTES["depts"] = "SELECT dept, list_sort(list(cat)) AS cats FROM hier GROUP BY dept"
def alias_sql(name: str, counts: str, by: str) -> None:
    """Alias tables of the distributions ``by`` of ``counts`` (value, cnt): cells, the share each keeps, and what fills the rest."""
    CTES[f"{name}_spare"] = f"""
SELECT *, cnt * size - total AS spare, cnt * size > total AS heavy FROM (
  SELECT {by}, value, cnt, count(*) OVER p AS size, CAST(sum(cnt) OVER p AS BIGINT) AS total,
         row_number() OVER (PARTITION BY {by} ORDER BY value) - 1 AS cell
  FROM ({counts}) WINDOW p AS (PARTITION BY {by}))"""
    CTES[f"{name}_axis"] = f"""
SELECT *, CAST(sum(abs(spare)) OVER (PARTITION BY {by}, heavy ORDER BY value ROWS UNBOUNDED PRECEDING) AS BIGINT) AS upto,
       lead(value) OVER (PARTITION BY {by}, heavy ORDER BY value) AS following FROM {name}_spare"""
    CTES[f"{name}_light"] = f"""
SELECT *, first_value(CASE WHEN heavy THEN value END IGNORE NULLS) OVER (
    PARTITION BY {by} ORDER BY CASE WHEN heavy THEN upto ELSE upto + spare END, heavy DESC, value
    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS filler,
  first_value(CASE WHEN NOT heavy THEN upto END IGNORE NULLS) OVER (
    PARTITION BY {by} ORDER BY upto, heavy DESC, value ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS used FROM {name}_axis"""
    CTES[name] = f"""
SELECT {by}, cell, size, value, CASE WHEN heavy THEN total - (used - upto) ELSE total + spare END / total AS keep,
       CASE WHEN heavy THEN following ELSE filler END AS other FROM {name}_light"""


alias_sql("alias", "SELECT * FROM freq0", "step, feature")
alias_sql("alias_cat", f"SELECT step, dept, cat AS value, cnt FROM hier JOIN freq0 ON feature = '{CAT}' AND value = cat", "step, dept")
alias_sql("alias_sub", f"""SELECT step, dept, cat, sub AS value, cnt FROM (SELECT dept, cat, unnest(subcats) AS sub FROM hier)
  JOIN freq0 ON feature = '{SUB}' AND value = sub""", "step, dept, cat")
_wide_stat = lambda f: (f"max(CASE WHEN feature = '{f}' THEN mean END) AS {f}_mean, "
                           f"max(CASE WHEN feature = '{f}' THEN std END) AS {f}_std")
CTES["wide_stats"] = (f"SELECT step, {', '.join(_wide_stat(f) for f in C.SPACE_NUMERIC)} FROM stats "
                      "WHERE step >= 0 GROUP BY step")
CTES["fixed_stats"] = "SELECT mean AS inactivity_mean, std AS inactivity_std FROM stats WHERE step = -1"
CTES["wide_stats_step"] = (f"SELECT step, {', '.join(_wide_stat(f) for f in C.SPACE_NUMERIC + C.SPACE_FIXED)} "
                           "FROM stats_step GROUP BY step")


def _categorical(p: str, frame: str, keep: str) -> None:
    """Categorical draws, then consistent products and pages, over ``frame``."""
    us = ", ".join(f"{u(f)} AS u_{f}" for f in C.SPACE_CATEGORICAL)
    CTES[f"{p}_u"] = f"SELECT *, {us} FROM {frame}"
    joins = " ".join(f"LEFT JOIN alias q_{f} ON q_{f}.feature = '{f}' AND q_{f}.step = t.step AND q_{f}.cell = floor(t.u_{f} * q_{f}.size)"
                     for f in C.SPACE_CATEGORICAL)
    at = lambda q, x: f"CASE WHEN {x} * {q}.size - floor({x} * {q}.size) < {q}.keep THEN {q}.value ELSE {q}.other END"
    values = ", ".join(f"coalesce({at(f'q_{f}', f't.u_{f}')}, {'t.' + f if keep else '0e0'}) AS {f}" for f in C.SPACE_CATEGORICAL)
    drop = ", ".join([f"u_{f}" for f in C.SPACE_CATEGORICAL] + (C.SPACE_CATEGORICAL if keep else []))
    CTES[f"{p}_drawn"] = f"SELECT t.* EXCLUDE ({drop}), {values} FROM {p}_u t {joins}"
    CTES[f"{p}_cat"] = f"""
SELECT t.* REPLACE (CASE WHEN list_contains(s.cats, CAST(t.{CAT} AS INTEGER)) THEN t.{CAT}
         WHEN s.cats IS NULL THEN t.{CAT}
         ELSE coalesce(CAST({at('k', 't.uc')} AS DOUBLE), CAST(s.cats[CAST(floor(t.uc * len(s.cats)) AS INTEGER) + 1] AS DOUBLE))
       END AS {CAT})
FROM (SELECT *, {u(CAT, 1)} AS uc, {u(SUB, 1)} AS us, {u('unique_pages', 1)} AS up FROM {p}_drawn) t
LEFT JOIN depts s ON s.dept = t.{DEPT}
LEFT JOIN alias_cat k ON k.step = t.step AND k.dept = t.{DEPT} AND k.cell = floor(t.uc * k.size)"""
    CTES[f"{p}_prod"] = f"""
SELECT t.* REPLACE (CASE WHEN list_contains(h.subcats, CAST(t.{SUB} AS INTEGER)) THEN t.{SUB}
         WHEN h.subcats IS NULL THEN t.{SUB}
         ELSE coalesce(CAST({at('k', 't.us')} AS DOUBLE),
                       CAST(h.subcats[CAST(floor(t.us * len(h.subcats)) AS INTEGER) + 1] AS DOUBLE)) END AS {SUB})
FROM {p}_cat t LEFT JOIN hier h ON h.dept = t.{DEPT} AND h.cat = t.{CAT}
LEFT JOIN alias_sub k ON k.step = t.step AND k.dept = t.{DEPT} AND k.cat = t.{CAT} AND k.cell = floor(t.us * k.size)"""
    CTES[f"{p}_pages"] = f"""
SELECT * REPLACE (CASE WHEN nb_pages = 1 THEN 1e0
         WHEN nb_pages > 1 AND (unique_pages > nb_pages OR unique_pages = 1) THEN floor(up * (nb_pages - 1)) + 2e0
         ELSE unique_pages END AS unique_pages) FROM {p}_prod"""


def _abs(f: str, x: str) -> str:
    return f"abs({x})" if f in C.POSITIVE else x


CTES["nb_frame"] = f"""
SELECT s.*, concat_ws('|', s.data_date, s.id) AS owner, CAST(n AS INTEGER) AS sample,
       {', '.join(f's.{f} AS o_{f}' for f in C.SPACE_ALL)}
FROM space s CROSS JOIN generate_series(0, {N - 1}) g(n)"""
CTES["nb_num"] = f"""
SELECT t.* REPLACE ({', '.join(_abs(f, f"{normal(f)} * w.{f}_std + w.{f}_mean").replace('step,', 't.step,') + f' AS {f}'
                               for f in C.SPACE_NUMERIC)},
                    {normal('inactivity', '-1')} * x.inactivity_std + x.inactivity_mean AS inactivity)
FROM nb_frame t JOIN wide_stats w ON w.step = t.step CROSS JOIN fixed_stats x"""
_categorical("nb", "nb_num", keep="instance")
CTES["samples"] = (f"SELECT data_date, id, sample, step, seq_length, "
                   f"{', '.join(f'CASE WHEN sample = 0 THEN o_{f} ELSE {f} END AS {f}' for f in C.SPACE_ALL)}, "
                   f"{', '.join(f'o_{f}' for f in C.SPACE_ALL)} FROM nb_pages")
CTES["bg_frame"] = f"SELECT step, CAST(n AS INTEGER) AS sample, 'background' AS owner FROM (SELECT DISTINCT step FROM stats_step) CROSS JOIN generate_series(0, {NB - 1}) g(n)"
CTES["bg_num"] = f"""
SELECT t.*, {', '.join(_abs(f, f"{normal(f)} * w.{f}_std + w.{f}_mean").replace('step,', 't.step,') + f' AS {f}'
                       for f in C.SPACE_NUMERIC + C.SPACE_FIXED)}
FROM bg_frame t JOIN wide_stats_step w ON w.step = t.step"""
_categorical("bg", "bg_num", keep="")
CTES["background"] = f"SELECT step, sample, {', '.join(C.SPACE_ALL)} FROM bg_pages"

# Surrogate
_scale = lambda f: f"(CASE WHEN {f}_std > 0 THEN {f}_std ELSE 1e0 END)"
_std = lambda f, x: f"({x} - {f}_mean) / {_scale(f)}"
CTES["interp"] = f"""
SELECT t.data_date, t.id, t.sample, t.step, t.seq_length,
       {', '.join(f"{_std(f, 't.' + f)} AS {f}" for f in C.SPACE_NUMERIC + C.SPACE_FIXED)},
       {', '.join(f"CAST(t.{f} = t.o_{f} AS INTEGER) * 1e0 AS {f}" for f in C.SPACE_CATEGORICAL)},
       {', '.join(f"{_std(f, 't.o_' + f)} AS o_{f}" for f in C.SPACE_NUMERIC + C.SPACE_FIXED)}
FROM samples t JOIN wide_stats w ON w.step = t.step CROSS JOIN fixed_stats x"""
_near = " + ".join([f"(1e0 - {f})" for f in C.SPACE_CATEGORICAL]
                   + [f"({f} - o_{f}) * ({f} - o_{f})" for f in C.SPACE_NUMERIC])
CTES["distances"] = (f"SELECT data_date, id, sample, sqrt(sum({_near}) + "
                     "any_value((inactivity - o_inactivity) * (inactivity - o_inactivity))) AS distance "
                     "FROM interp GROUP BY data_date, id, sample")
CTES["width"] = f"SELECT {P.kernel_width}e0 * sqrt(max(seq_length) * {WIDTH} + 1) AS w FROM seqs"
CTES["kernel"] = ("SELECT data_date, id, sample, distance, sqrt(exp(-(distance * distance) / (w * w))) AS weight "
                  "FROM distances CROSS JOIN width")
CTES["scored_samples"] = (f"SELECT data_date, id, sample, 1e0 / (1e0 + exp(-(avg({STEP_SCORE}) + "
                          f"any_value({FIXED_SCORE})))) AS p1 FROM samples GROUP BY data_date, id, sample")
_sums = lambda f: (f"sum(k.weight * i.{f}) AS sx, sum(k.weight * i.{f} * i.{f}) AS sxx, sum(k.weight * i.{f} * s.p1) AS sxy, "
                   f"max(CASE WHEN i.sample = 0 THEN i.{f} END) AS x0")
CTES["weighted"] = ("SELECT i.*, k.weight, s.p1 FROM interp i JOIN kernel k USING (data_date, id, sample) "
                    "JOIN scored_samples s USING (data_date, id, sample)")


def _slope(f: str) -> str:
    fixed = f in C.SPACE_FIXED
    return (f"SELECT data_date, id, {-1 if fixed else 'step'} AS step, '{f}' AS feature, sum(weight) AS sw, "
            f"sum(weight * p1) AS sy, sum(weight * {f}) AS sx, sum(weight * {f} * {f}) AS sxx, "
            f"sum(weight * {f} * p1) AS sxy, max(CASE WHEN sample = 0 THEN {f} END) AS x0 FROM weighted "
            f"{'WHERE step = 0 ' if fixed else ''}GROUP BY data_date, id{'' if fixed else ', step'}")


CTES["moments"] = " UNION ALL ".join(_slope(f) for f in C.SPACE_ALL)
CTES["slopes"] = """
SELECT data_date, id, CAST(step AS INTEGER) AS step, feature, weight, x0, (sy - sx * weight) / sw AS intercept
FROM (SELECT *, (sxy - sx * sy / sw) / (sxx - sx * sx / sw + 1e0) AS weight FROM moments)"""

# All columns together: ridge in the samples, as there are fewer of them than columns. The system of an instance is a list of rows with the
# right-hand side at their end, and is eliminated pivot by pivot.
_cell = lambda f, i: (f"SELECT data_date, id, sample, weight, p1, {-1 if f in C.SPACE_FIXED else 'step'} AS step, '{f}' AS feature, "
                      f"{'1000000' if f in C.SPACE_FIXED else f'step * {WIDTH} + {i}'} AS position, {f} AS x FROM weighted"
                      f"{' WHERE step = 0' if f in C.SPACE_FIXED else ''}")
_less_mean = lambda x: f"sqrt(weight) * ({x} - sum(weight * {x}) OVER c / sum(weight) OVER c)"
CTES["cells"] = f"""
SELECT data_date, id, sample, step, feature, position, {_less_mean('x')} AS x, {_less_mean('p1')} AS y,
       max(CASE WHEN sample = 0 THEN x END) OVER c AS x0
FROM ({' UNION ALL '.join(_cell(f, i) for i, f in enumerate(C.SPACE_ALL))}) WINDOW c AS (PARTITION BY data_date, id, position)"""


def _ridge(cells: str, alpha: float) -> str:
    return f"""
SELECT c.data_date, c.id, CAST(step AS INTEGER) AS step, feature, position, any_value(x0) AS x0, sum(x * solution[sample + 1]) AS weight
FROM {cells} c JOIN (
  WITH RECURSIVE vectors AS (SELECT data_date, id, sample, any_value(y) AS y, list(x ORDER BY position) AS v FROM {cells} GROUP BY data_date, id, sample),
  products AS (
    SELECT data_date, id, a.sample, any_value(a.y) AS y,
           list(list_dot_product(a.v, b.v) + CASE WHEN a.sample = b.sample THEN {alpha!r}e0 ELSE 0e0 END ORDER BY b.sample) AS r
    FROM vectors a JOIN vectors b USING (data_date, id) GROUP BY data_date, id, a.sample),
  eliminated AS (
    SELECT data_date, id, CAST(1 AS BIGINT) AS k, count(*) AS n, list(list_append(r, y) ORDER BY sample) AS m FROM products GROUP BY data_date, id
    UNION ALL
    SELECT data_date, id, k + 1, n, list_transform(m, lambda r, i: CASE WHEN i = k THEN list_transform(r, lambda e: e / r[k])
           ELSE list_transform(r, lambda e, j: e - r[k] * m[k][j] / m[k][k]) END) FROM eliminated WHERE k <= n)
  SELECT data_date, id, list_transform(m, lambda r: r[n + 1]) AS solution FROM eliminated WHERE k > n) USING (data_date, id)
GROUP BY c.data_date, c.id, step, feature, position"""


CTES["joint"] = _ridge("cells", 0.01)
CTES["chosen"] = ("SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY data_date, id ORDER BY round(abs(weight * x0), 9) DESC, position) "
                  "AS place FROM joint) WHERE place <= 6")
CTES["chosen_cells"] = "SELECT cells.* FROM cells JOIN chosen USING (data_date, id, position)"
CTES["refit"] = _ridge("chosen_cells", 1.0)

# Shapley values
M = len(GROUPS)
CTES["shap_steps"] = f"""
SELECT *, coalesce(sum({STEP_SCORE}) OVER (PARTITION BY data_date, id ORDER BY step
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0e0) AS past_score FROM space"""
_bit = {f: next(i for i, fs in enumerate(GROUPS.values()) if f in fs) for f in C.SPACE_ALL}
CTES["masked"] = f"""
SELECT s.data_date, s.id, s.step, CAST(c AS INTEGER) AS coalition, b.sample AS background_row, s.past_score,
       {', '.join(f'CASE WHEN (c >> {_bit[f]}) & 1 = 1 THEN s.{f} ELSE b.{f} END AS {f}' for f in C.SPACE_ALL)}
FROM shap_steps s JOIN background b ON b.step = s.step CROSS JOIN generate_series(0, {2 ** M - 1}) g(c)"""
CTES["coalition_values"] = f"""
SELECT data_date, id, step, coalition, p AS mean_proba, ln(p / (1 - p)) AS value FROM (
  SELECT data_date, id, step, coalition,
         avg(1e0 / (1e0 + exp(-((past_score + ({STEP_SCORE})) / (step + 1) + ({FIXED_SCORE}))))) AS p
  FROM masked GROUP BY data_date, id, step, coalition)"""


def _pairs() -> str:
    """Marginal differences of a group: each coalition with its group's bit against the one without."""
    share = f"factorial(bit_count(a.coalition)) * factorial({M} - 1 - bit_count(a.coalition)) / factorial({M})"
    names = "CASE g " + " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(GROUPS)) + " END"
    return (f"SELECT a.data_date, a.id, a.step, {names} AS feature, sum((b.value - a.value) * CAST({share} AS DOUBLE)) AS phi "
            f"FROM coalition_values a JOIN generate_series(0, {M - 1}) t(g) ON (a.coalition >> g) & 1 = 0 "
            "JOIN coalition_values b ON a.data_date = b.data_date AND a.id = b.id AND a.step = b.step "
            "AND b.coalition = a.coalition + (1 << g) GROUP BY a.data_date, a.id, a.step, g")


CTES["phi"] = _pairs()

# Calendar
CTES["days"] = f"SELECT DISTINCT {day_of('event_timestamp')} AS day FROM fx_events WHERE event_env = 'product_page'"


def effective(exec_date: dt.date) -> str:
    return (f"SELECT min(day) AS min_date, max(day) AS max_date, least({d(exec_date)}, max(day)) AS execution_date "
            f"FROM days HAVING {d(exec_date)} <= max(day) + 1")


CTES["effective"] = effective(X.EXEC_DATE)
CTES["first_day"] = (f"SELECT *, greatest(min_date + {P.horizon}, execution_date - {P.training_history} + {P.horizon}) "
                     "AS first_date FROM effective")
CTES["calendar"] = (f"SELECT CAST(unnest(generate_series(first_date, execution_date - {P.horizon}, INTERVAL 1 DAY)) AS date) "
                    "AS data_date FROM first_day")

# Evaluation
_pbin = lambda n, p="proba": f"CAST(least(floor({p} * {n}), {n - 1}) AS INTEGER)"
CTES["thresholds"] = """
SELECT threshold, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER () AS pt, sum(neg) OVER () AS nt, pos, neg
FROM (SELECT proba AS threshold, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg
      FROM fx_scored GROUP BY 1) WINDOW w AS (ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING)"""

MATERIALIZED = {"extract", "extract_early", "feat", "vectors", "steps", "space", "stats", "stats_step", "freq0", "freq", "hier",
                "samples", "background", "interp", "coalition_values", "slopes", "kernel", "nb_pages", "bg_pages", "cells", "joint", "chosen_cells"}


def _used(text: str) -> list[str]:
    return list(dict.fromkeys(re.findall(r"\b(?:FROM|JOIN)\s+(\w+)", text)))


def with_ctes(query: str) -> str:
    """``query`` with the definitions of all named sub-queries it reads."""
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name in _used(text):
            if name in CTES and name not in ordered:
                visit(CTES[name])
                if name not in ordered:
                    ordered.append(name)

    visit(query)
    parts = [f"{n} AS {'MATERIALIZED ' if n in MATERIALIZED else ''}({CTES[n].strip()})" for n in ordered]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + query
