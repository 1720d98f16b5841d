import datetime as dt
import itertools
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from propensight import constants as C
from propensight.functions.prefix import FunctionPrefix, of_steps, prefix_scorer
from propensight.functions.scoring import MeanPoolScorer
from propensight.operators import model as Mo, moments as Mm, perturb as Pe, shapley as Sh, surrogate as Su

DEPT, CAT, SUB = C.CODED_COLUMNS


@pytest.fixture
def hierarchy(spark):
    return spark.createDataFrame([(1, 1, [1, 2]), (1, 2, [3]), (2, 3, [4, 5])], "dept int, cat int, subcats array<int>")


@pytest.fixture
def freq(spark):
    rows = [(0, DEPT, 1.0, 3), (0, DEPT, 2.0, 1), (0, DEPT, 9.0, 1), (0, CAT, 1.0, 1), (0, CAT, 2.0, 1), (0, CAT, 3.0, 2),
            (0, SUB, 1.0, 1), (0, SUB, 2.0, 3)]
    df = spark.createDataFrame(rows, "step int, feature string, value double, cnt bigint")
    df.createOrReplaceTempView("_freq")
    return spark.sql("""SELECT *, (sum(cnt) OVER w) - cnt AS c_lo, sum(cnt) OVER w AS c_hi,
                        sum(cnt) OVER (PARTITION BY step, feature) AS total FROM _freq
                        WINDOW w AS (PARTITION BY step, feature ORDER BY value)""")


def products(spark, rows):
    cols = F.explode(F.array(*[F.struct(F.lit(float(a)).alias(DEPT), F.lit(float(b)).alias(CAT), F.lit(float(c)).alias(SUB))
                               for a, b, c in rows])).alias("p")
    return (spark.range(300).select(F.col("id").cast("int").alias("sample"), F.lit(0).alias("step"),
                                    F.lit("o").alias("owner"), cols).select("sample", "step", "owner", "p.*"))


def test_resampled_products_occur_together(spark, hierarchy, freq):
    frame = products(spark, [(7, 1, 1), (1, 3, 1), (2, 1, 1), (1, 2, 3)])
    out = Pe.resample_hierarchy(frame, hierarchy, freq, 1)
    ok = out.join(hierarchy, (F.col(DEPT) == F.col("dept")) & (F.col(CAT) == F.col("cat"))
                  & F.array_contains("subcats", F.col(SUB).cast("int")), "left_semi")
    assert out.count() == ok.count() == 1200
    kept = out.where(f"{DEPT} = 1 AND {CAT} = 2 AND {SUB} = 3").count()
    assert kept >= 300                                         # consistent rows stay, others may arrive there
    share = out.where(f"{DEPT} = 2").groupBy(SUB).count().collect()
    assert {r[0] for r in share} == {4.0, 5.0}                 # no frequency at the step: all allowed are possible


def test_redrawn_department_follows_the_frequencies(spark, hierarchy, freq):
    out = Pe.resample_hierarchy(products(spark, [(7, 1, 1)] * 4), hierarchy, freq, 1)
    counts = {r[DEPT]: r["count"] for r in out.groupBy(DEPT).count().collect()}
    assert set(counts) == {1.0, 2.0}                           # 9 has a frequency but is in no hierarchy


def test_draws_follow_the_frequencies(spark, freq):
    frame = spark.range(20000).select(F.col("id").cast("int").alias("sample"), F.lit(0).alias("step"), F.lit("o").alias("owner"))
    out = Pe.draw_categorical(frame, freq, [SUB], 4)
    counts = {r[SUB]: r["count"] / 20000 for r in out.groupBy(SUB).count().collect()}
    assert counts[1.0] == pytest.approx(0.25, abs=0.02) and counts[2.0] == pytest.approx(0.75, abs=0.02)


@pytest.mark.parametrize("pages, unique, low, high", [(1, 5, 1, 1), (4, 9, 2, 4), (4, 1, 2, 4), (4, 3, 3, 3), (2, 1, 2, 2)])
def test_pages(spark, pages, unique, low, high):
    frame = spark.range(50).select(F.col("id").alias("sample"), F.lit(0).alias("step"), F.lit("o").alias("owner"),
                                   F.lit(float(pages)).alias("nb_pages"), F.lit(float(unique)).alias("unique_pages"))
    got = {r["unique_pages"] for r in Pe.resample_pages(frame).collect()}
    assert got == set(np.arange(low, high + 1).astype(float))


def test_samples_do_not_depend_on_partitions(spark, small):
    one = Pe.neighborhood(small.space, small.stats, small.frequencies, small.hierarchy, 3)
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        two = Pe.neighborhood(small.space.coalesce(1), small.stats, small.frequencies, small.hierarchy, 3)
        a, b = (d.drop("origin").orderBy("id", "sample", "step").collect() for d in (one, two))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert a == b and len(a) == 3 * small.space.count()


def test_blocks_cover_every_sample_once(small):
    for n in (1, 7, 10):
        got = Pe.expand_samples(small.space.where("step = 0"), n, block=5).groupBy("id").agg(F.sort_array(F.collect_list("sample")).alias("s"))
        assert {tuple(r["s"]) for r in got.collect()} == {tuple(range(n))}


def test_sample_zero_is_the_instance(small):
    samples = small.samples
    own = samples.where("sample = 0").select("id", "step", *C.SPACE_ALL)
    want = small.space.select("id", "step", *C.SPACE_ALL)
    assert own.exceptAll(want).count() == 0 and want.exceptAll(own).count() == 0
    drawn = samples.where("sample > 0")
    assert drawn.where(" OR ".join(f"{f} < 0" for f in C.POSITIVE)).count() == 0
    assert drawn.where("nb_pages > 1 AND unique_pages > nb_pages").count() == 0
    weights = Su.kernel_weights(Su.sample_distances(small.interpretable), small.max_length)
    low, high = weights.agg(F.min("weight"), F.max("weight")).first()
    assert 0 < low and high == 1.0


def test_ridge_both_ways():
    rng = np.random.default_rng(0)
    for n, d in ((40, 5), (5, 40)):
        x, y, w = rng.normal(size=(n, d)), rng.normal(size=n), rng.uniform(0.1, 1, n)
        beta, intercept = Su.ridge(x, y, w, 0.7)
        full = np.hstack([x, np.ones((n, 1))])
        penalty = np.diag([0.7] * d + [0.0])
        want = np.linalg.solve(full.T @ (w[:, None] * full) + penalty, full.T @ (w * y))
        assert np.allclose(beta, want[:-1]) and intercept == pytest.approx(want[-1])


def test_surrogate_fit_matches_numpy(small):
    fits = Su.local_linear_fit(small.design, small.max_length, [(0.75, None, small.params.samples)]).toPandas()
    one = sorted(fits["id"].unique())[0]
    rows = small.design.where(F.col("id") == one).orderBy("sample").toPandas()
    x, y = np.stack(rows["x"]), rows["p1"].to_numpy()
    w = np.sqrt(np.exp(-rows["distance"].to_numpy() ** 2 / (0.75 ** 2 * (small.max_length * 17 + 1))))
    beta, intercept = Su.ridge(x, y, w, 1.0)
    mine = fits[fits.id == one]
    assert np.allclose(mine["weight"], beta) and np.allclose(mine["intercept"], intercept)
    assert mine["local_pred"].iloc[0] == pytest.approx(x[0] @ beta + intercept)
    assert mine["real_pred"].iloc[0] == pytest.approx(y[0])


def test_sweep_shares_draws(small):
    fits = Su.local_linear_fit(small.design, small.max_length, list(itertools.product([0.25, 0.75], [3, 6], [10, 20])))
    got = Su.explain_summary(fits).groupBy("id").count().collect()
    assert {r["count"] for r in got} == {8}
    assert fits.where("complexity = 3 AND kernel_width = 0.25 AND n_samples = 10").groupBy("id").count().first()["count"] == 3


def test_probabilities_must_sum_to_one(spark):
    with pytest.raises(Exception, match="do not sum to 1"):
        Su.with_probability_check(spark.createDataFrame([(0.5, 0.6)], "p0 double, p1 double")).collect()


def test_shapley_values_match_all_orders(spark):
    rng = np.random.default_rng(1)
    m = 4
    value = rng.normal(size=2 ** m)
    rows = [(dt.date(2024, 1, 1), "a", 0, k, float(v)) for k, v in enumerate(value)]
    values = spark.createDataFrame(rows, "data_date date, id string, step int, coalition int, value double")
    groups = {f"g{i}": [] for i in range(m)}
    got = {r["feature"]: r["phi"] for r in Sh.shapley_values(values, groups).collect()}
    want = np.zeros(m)
    for order in itertools.permutations(range(m)):
        mask = 0
        for i in order:
            want[i] += value[mask | 1 << i] - value[mask]
            mask |= 1 << i
    assert np.allclose([got[f"g{i}"] for i in range(m)], want / math.factorial(m))
    every = Sh.sampled_coalitions(spark, m, 2 ** m)
    assert every.count() == 2 ** m - 2
    solved = {r["feature"]: r["phi"] for r in Sh.shapley_regression(values, every, groups).collect()}
    assert np.allclose([solved[g] for g in groups], [got[g] for g in groups])


@pytest.mark.parametrize("base, label", [("instance", 1), ("background", 1), ("instance", 0)])
def test_values_add_up(small, base, label):
    values = Sh.shap_values_of(small.space, small.background, small.scorer, base=base, label=label)
    full = 2 ** len(Sh.GROUPS) - 1
    ends = values.groupBy("id", "step").agg(F.sum(F.when(F.col("coalition") == full, F.col("value"))
                                                  .when(F.col("coalition") == 0, -F.col("value"))).alias("gap"))
    sums = Sh.shapley_values(values).groupBy("id", "step").agg(F.sum("phi").alias("total"))
    worst = ends.join(sums, ["id", "step"]).agg(F.max(F.abs(F.col("gap") - F.col("total"))), F.count("*")).first()
    assert worst[0] < 1e-9 and worst[1] == small.space.count()


def test_sampled_values_add_up(small):
    values = Sh.shap_instances_sampled(small.space.where("step < 3"), small.background, small.scorer, 80)
    exact = Sh.shap_instances(small.space.where("step < 3"), small.background, small.scorer)
    a, b = (d.groupBy("id", "step").agg(F.sum("phi").alias("s")) for d in (values, exact))
    gap = a.join(b.withColumnRenamed("s", "t"), ["id", "step"]).agg(F.max(F.abs(F.col("s") - F.col("t")))).first()[0]
    assert gap < 1e-9


def test_context_is_bounded_by_the_step(small):
    ctx = Sh.step_context(small.space)
    assert ctx.where(F.size("context") != F.col("step") + 1).count() == 0
    first = Sh.step_context(small.space, chronological=False).where("step = 2").first()
    assert [c["step"] for c in first["context"]] == [2, 0, 1]


def test_no_cartesian_product_in_the_explainers(small, capsys):
    Sh.shap_instances(small.space, small.background, small.scorer).explain()
    Su.design_rows(small.samples_lazy, small.stats, small.scorer).explain()
    assert "CartesianProduct" not in capsys.readouterr().out


def test_any_function_explains_as_its_coefficients_do(small):
    scorer = MeanPoolScorer("0.002 * product_price + 0.01 * latitude", "0.05 * abs(inactivity) - 0.4")  # records hold no negative inactivity
    price, latitude = (C.NUMERIC_POSITION[c] for c in ("product_price", "latitude"))

    def predict(batch):
        mean = np.array([np.mean([0.002 * float(v[price]) + 0.01 * float(v[latitude]) for v in x]) for x in batch["inputs_num"]])
        return 1 / (1 + np.exp(-(mean + 0.05 * batch["inactivity"] - 0.4)))

    few = small.space.where(F.col("step") < 4)
    given, called = (Su.design_rows(small.samples, small.stats, m).select("id", "sample", "p1", "distance") for m in (scorer, predict))
    gap = given.join(called.toDF("id", "sample", "q1", "d2"), ["id", "sample"]).agg(
        F.max(F.abs(F.col("p1") - F.col("q1"))), F.max(F.abs(F.col("distance") - F.col("d2"))), F.count("*")).first()
    assert gap[0] < 1e-5 and gap[1] < 1e-9 and gap[2] == given.count() == called.count() > 0
    for base in ("instance", "background"):
        one, two = (Sh.shap_instances(few, small.background, m, base=base) for m in (scorer, predict))
        gap = one.join(two.withColumnRenamed("phi", "psi"), ["id", "step", "feature"]).agg(
            F.max(F.abs(F.col("phi") - F.col("psi"))), F.count("*")).first()
        assert gap[0] < 1e-4 and gap[1] == few.count() * len(Sh.GROUPS)


class Counted:
    """A step-by-step scorer that is not a function of pooled inputs: a leaky sum."""

    def start(self):
        return np.zeros(1)

    def step(self, state, num, cat):
        return 0.5 * state + 0.01 * num[:, C.NUMERIC_POSITION["product_price"]] + 0.1 * (cat[:, 0] > 1)

    def finish(self, state, length, inactivity):
        return 1 / (1 + np.exp(-(state - 0.2 * inactivity - 0.01 * length)))


def whole_records(batch):
    """The same from whole records."""
    out = []
    for nums, cats, length, inactivity in zip(batch["inputs_num"], batch["inputs_cat"], batch["seq_length"], batch["inactivity"], strict=True):
        scorer, state = Counted(), np.zeros(1)
        for num, cat in zip(nums, cats, strict=True):
            state = scorer.step(state, np.asarray(num)[None], np.asarray(cat)[None])
        out.append(scorer.finish(state, length, inactivity)[0])
    return pd.Series(out)


@pytest.mark.parametrize("base, label", [("instance", 0), ("background", 1)])
def test_a_step_by_step_scorer_explains_as_its_function_does(small, base, label):
    few = small.space.where(F.col("step") < 5)
    one, two = (Sh.shap_instances(few, small.background, m, base=base, label=label) for m in (Counted(), whole_records))
    gap = one.join(two.withColumnRenamed("phi", "psi"), ["id", "step", "feature"]).agg(
        F.max(F.abs(F.col("phi") - F.col("psi"))), F.count("*")).first()
    assert gap[0] < 1e-9 and gap[1] == few.count() * len(Sh.GROUPS)


def test_a_fitted_pipeline_goes_step_by_step(small, monkeypatch):
    model = Mo.fit_classifier(small.examples)
    scorer = prefix_scorer(model)
    rows = small.examples.orderBy("id").limit(5).collect()
    want = {r["id"]: r["purchase_proba"] for r in Mo.score(model, small.examples).collect()}
    for r in rows:
        state = scorer.start()
        for num, cat in zip(r["inputs_num"], r["inputs_cat"], strict=True):
            state = scorer.step(state, np.array([num], float), np.array([cat]))
        assert abs(scorer.finish(state, r["seq_length"], np.array([r["inactivity"]]))[0] - want[r["id"]]) < 1e-6
    few = small.space.where(F.col("step") < 3)
    whole = Sh.shap_values_of(few, small.background, model)
    monkeypatch.setattr(Sh, "CELLS", 2_000)  # a few coalitions at a time
    parts = Sh.shap_values_of(few, small.background, model)
    gap = whole.join(parts.withColumnRenamed("value", "other"), ["id", "step", "coalition"]).agg(
        F.max(F.abs(F.col("value") - F.col("other"))), F.count("*")).first()
    assert gap[0] < 1e-9 and gap[1] == few.count() * 2 ** len(Sh.GROUPS)


def test_no_row_carries_the_past(small, capsys):
    Sh.shap_instances(small.space, small.background, whole_records).explain()
    plan = capsys.readouterr().out
    assert "collect_list" not in plan and "Window" not in plan and "past" not in plan
    long = small.space.where("step = 0").withColumn("step", F.lit(77))
    with pytest.raises(Exception, match="no rows for step 77"):
        Sh.shap_instances(long, small.background, whole_records).collect()


# ---- mergeable moments

@pytest.mark.parametrize("n, d", [(400, 9), (30, 40)])
def test_merged_moments_equal_one_fit(n, d):
    rng = np.random.default_rng(n)
    x, y, w = rng.normal(size=(n, d)), rng.normal(size=n), rng.uniform(0.1, 1, n)
    state = Mm.factor(x[:7], y[:7], w[:7])
    for i in range(7, n, 50):
        state = Mm.merged([state, Mm.factor(x[i:i + 50], y[i:i + 50], w[i:i + 50])])
    assert len(state) <= max(d + 2, n if n < d + 2 else 0)
    xc, yc, mx, my = Mm.centred(state, 1)
    full = np.hstack([x, np.ones((n, 1))])
    want = np.linalg.solve(full.T @ (w[:, None] * full) + np.diag([0.7] * d + [0.0]), full.T @ (w * y))
    beta = Mm.ridge(0.7)(xc, yc)[:, 0]
    assert np.allclose(beta, want[:-1], atol=1e-8) and abs(my[0] - mx @ beta - want[-1]) < 1e-8
    assert np.allclose(Mm.ridge(0.7)(xc, np.hstack([yc, -yc])), np.column_stack([beta, -beta]))


def weighted(seed, n=60, d=8):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d))
    x[:, 3] = x[:, 0] + 0.1 * rng.normal(size=n)
    x[:, 6] = 0.0
    y, w = x @ rng.normal(size=d) + rng.normal(size=n), rng.uniform(0.1, 1, n)
    mean = lambda v: (w @ v) / w.sum()
    return Mm.centred(Mm.factor(x, y, w), 1)[:2], np.sqrt(w)[:, None] * (x - mean(x)), np.sqrt(w) * (y - mean(y))


@pytest.mark.parametrize("seed", range(4))
def test_forward_selection_equals_fits_of_every_candidate(seed):
    (x, y), xw, yw = weighted(seed)
    chosen = []
    for _ in range(6):
        def loss(j):
            own = xw[:, chosen + [j]]
            return ((yw - own @ np.linalg.lstsq(own, yw, rcond=None)[0]) ** 2).sum()
        chosen.append(min((j for j in range(8) if j not in chosen and j != 6), key=loss))
    assert Mm.forward(x, y[:, 0], 6) == chosen
    assert len(Mm.forward(x, y[:, 0], 8)) == 7                 # an empty column gains nothing


@pytest.mark.parametrize("seed", range(6))
def test_lasso_path_keeps_its_conditions(seed):
    (x, y), xw, yw = weighted(seed)
    path = Mm.lasso_path(x, y[:, 0])
    seen = []
    for beta in path[1:]:
        c = xw.T @ (yw - xw @ beta)
        penalty = np.abs(c).max()
        on = np.abs(beta) > 1e-12
        assert np.allclose(c[on], penalty * np.sign(beta[on]), atol=1e-7) or penalty < 1e-7
        seen.append(penalty)
        if penalty > 1e-6:
            assert np.allclose(Mm.lasso(penalty, 20_000)(x, y)[:, 0], beta, atol=1e-5)
    assert seen == sorted(seen, reverse=True) and seen[-1] < 1e-6
    least = np.linalg.lstsq(xw, yw, rcond=None)[0]
    assert np.allclose(xw @ path[-1], xw @ least, atol=1e-6)
    kept = Mm.selected(x, y[:, 0], np.ones(8), 3, "lasso_path", 0.01)
    assert len(kept) <= 3 and any(set(np.flatnonzero(b)) == set(kept) for b in path)


@pytest.mark.parametrize("block", [3, 7, 250])
def test_fits_do_not_depend_on_blocks(small, block):
    d = small.max_length * 17 + 1
    settings = list(itertools.product([0.25, 0.75], [None, 4], [6, 11, 20]))
    narrow = small.design.withColumn("x", F.slice("x", 1, 5)).where("size(x) = 5")        # more samples than columns
    for design in (small.design, narrow):
        cut = design.withColumn("block", F.floor(F.col("sample") / block).cast("int"))
        fits = Su.local_linear_fit(cut, small.max_length, settings, selection="auto").toPandas()
        rows = design.orderBy("id", "sample").toPandas()
        for one in sorted(rows["id"].unique())[:3]:
            own = rows[rows.id == one]
            for width, complexity, n in settings:
                x, y = np.stack(own["x"])[:n], own["p1"].to_numpy()[:n]
                w = np.sqrt(np.exp(-own["distance"].to_numpy()[:n] ** 2 / (width ** 2 * d)))
                mine = fits[(fits.id == one) & (fits.kernel_width == width) & (fits.n_samples == n)]
                mine = mine[mine.complexity == (x.shape[1] if complexity is None else complexity)]
                if complexity is None:
                    beta, intercept = Su.ridge(x, y, w, 1.0)
                    assert np.allclose(mine["weight"], beta, atol=1e-8) and np.allclose(mine["intercept"], intercept, atol=1e-8)
                    fitted = x @ beta + intercept
                    r2 = 1 - w @ (y - fitted) ** 2 / (w @ (y - (w @ y) / w.sum()) ** 2)
                    assert mine["r2"].iloc[0] == pytest.approx(r2) and mine["local_pred"].iloc[0] == pytest.approx(fitted[0])
                else:
                    assert len(mine) <= 4


def test_labels_modes_and_hooks(small):
    settings = [(0.75, None, 20)]
    both = Su.local_linear_fit(small.design, small.max_length, settings, label=(1, 0)).toPandas()
    one, zero = (both[both.label == k].sort_values(["id", "step", "feature"]) for k in (1, 0))
    assert np.allclose(one["weight"], -zero["weight"].to_numpy()) and np.allclose(one["local_pred"], 1 - zero["local_pred"].to_numpy())
    top = Su.local_linear_fit(small.design, small.max_length, settings, top_labels=1).toPandas()
    assert (top["real_pred"] >= 0.5).all() and top.groupby("id")["label"].nunique().max() == 1
    flat = Su.local_linear_fit(small.design, small.max_length, settings, kernel=lambda d, w: np.ones(len(d))).toPandas()
    assert not np.allclose(flat.sort_values(["id", "step", "feature"])["weight"].to_numpy(), one["weight"])
    few = small.samples.where("sample < 6")
    told = Su.design_rows(few, small.stats, small.scorer, metric="manhattan").select("id", "sample", "distance")
    asked = Su.design_rows(few, small.stats, small.scorer, metric=lambda x, o: np.abs(x - o).sum(axis=1)).select("id", "sample", F.col("distance").alias("d"))
    gap = told.join(asked, ["id", "sample"]).agg(F.max(F.abs(F.col("distance") - F.col("d"))), F.count("*")).first()
    assert gap[0] < 1e-9 and gap[1] == told.count() > 0


def test_blocks_are_fitted_where_they_were_made(small, capsys):
    Su.explain_instances(small.space, small.stats, small.frequencies, small.hierarchy, small.scorer, small.max_length).explain()
    plan = capsys.readouterr().out
    made, merged = plan.index("FlatMapGroupsInPandas"), plan.index("MapInPandas")
    assert merged < made                                       # from the top: merge, one exchange of factors, blocks
    assert plan[merged:made].count("Exchange hashpartitioning") == 1
    assert "Exchange" not in plan[made:plan.index("Generate explode(sequence", made)].replace("BroadcastExchange", "").split("Join")[0]


def test_cells_are_arrays_of_numbers(spark):
    """Joined rows copy the cells of their step: 24 bytes a cell, no struct for each."""
    rows = [("a", float(v), 1 + v % 3) for v in range(50)]
    cells = Pe.alias_arrays(spark.createDataFrame(rows, "g string, value double, cnt bigint"), ["g"])
    assert cells.schema["cells"].dataType.simpleString() == "struct<value:array<double>,keep:array<double>,other:array<double>>"
    got, tables = cells.first()["cells"], Pe.alias_tables(spark.createDataFrame(rows, "g string, value double, cnt bigint"), ["g"]).orderBy("cell").collect()
    assert [(r["value"], r["keep"], r["other"]) for r in tables] == list(zip(got["value"], got["keep"], got["other"], strict=True))


# ---- alias tables

@pytest.mark.parametrize("counts", [[1], [5, 5, 5], [1, 2, 3, 4], [100, 1, 1, 1], [1, 1, 1, 100], [3, 1, 4, 1, 5, 9, 2, 6, 5, 3, 5], [7] * 50 + [1000, 999]])
def test_alias_tables_hold_the_distribution(spark, counts):
    rows = [("a", float(10 * i), c) for i, c in enumerate(counts)] + [("b", 1.0, 3)]
    got = Pe.alias_tables(spark.createDataFrame(rows, "g string, value double, cnt bigint"), ["g"]).where("g = 'a'").orderBy("cell").collect()
    share = dict.fromkeys((10.0 * i for i in range(len(counts))), 0.0)
    assert [r["cell"] for r in got] == list(range(len(counts)))
    for r in got:
        assert 0 <= r["keep"] <= 1
        share[r["value"]] += r["keep"] / len(counts)
        if r["keep"] < 1:
            share[r["other"]] += (1 - r["keep"]) / len(counts)
    assert np.allclose(list(share.values()), np.array(counts) / sum(counts))


def test_many_children_of_one_parent(spark, capsys):
    n = 100_000
    hierarchy = spark.range(1).select((F.col("id") + 1).cast("int").alias("dept"), (F.col("id") + 1).cast("int").alias("cat"), F.sequence(F.lit(1), F.lit(n)).alias("subcats"))
    freq = spark.range(1, n + 1).select((F.col("id") * 0).cast("int").alias("step"), F.lit(SUB).alias("feature"), F.col("id").cast("double").alias("value"),
                                        (F.col("id") % 7 + 1).alias("cnt"))
    frame = spark.range(4000).select(F.col("id").cast("int").alias("sample"), (F.col("id") * 0).cast("int").alias("step"), F.lit("o").alias("owner"),
                                     (F.col("id") * 0.0 + 1.0).alias(DEPT), (F.col("id") * 0.0 + 1.0).alias(CAT), (-1.0 - F.col("id")).alias(SUB))
    out = Pe.resample_hierarchy(frame, hierarchy, freq, 3)
    out.explain()
    plan = capsys.readouterr().out
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan and "c_lo" not in plan
    values = [r[SUB] for r in out.collect()]
    assert len(values) == 4000 and 1 <= min(values) and max(values) <= n and len(set(values)) > 3500
    heavy = sum(v % 7 == 6 for v in values) / 4000
    assert heavy == pytest.approx(0.25, abs=0.03)              # 7 of 28 parts


def test_one_join_draws_all_columns(small, capsys):
    frame = Pe.expand_samples(small.space.select("data_date", "id", "step", *C.SPACE_ALL), 3)
    Pe.draw_categorical(frame, small.frequencies).explain()
    plan = capsys.readouterr().out
    assert sum(line.lstrip(" :+-*()0123456789").startswith(("BroadcastHashJoin", "SortMergeJoin")) for line in plan.splitlines()) == 1


# ---- coalitions of many groups

@pytest.mark.parametrize("m, budget", [(4, 3), (5, 17), (6, 62), (10, 100), (18, 999), (40, 2000), (41, 2001)])
def test_the_whole_budget_is_spent(m, budget):
    plan = Sh.coalition_plan(m, budget)
    masks = [p[0] for p in plan]
    assert len(plan) == min(budget, 2 ** m - 2) == len(set(masks))
    assert all(0 < mask < 2 ** m - 1 and mask.bit_count() == size for mask, size, _ in plan)
    assert sum(w for _, _, w in plan) == pytest.approx(1) and min(w for _, _, w in plan) > 0
    lonely = sum((2 ** m - 1) ^ mask not in set(masks) for mask in masks)
    assert lonely == len(plan) % 2
    if m >= 40:
        ends = sum(w for _, size, w in plan if size in (1, m - 1))
        kernel = {s: Sh.shapley_kernel(m, s) * math.comb(m, s) for s in range(1, m)}
        assert ends == pytest.approx((kernel[1] + kernel[m - 1]) / sum(kernel.values()))


def test_unranking_lists_all_masks():
    assert [Sh.unranked(r, 6, 3) for r in range(20)] == sorted(x for x in range(64) if x.bit_count() == 3)
    assert Sh.unranked(math.comb(62, 31) - 1, 62, 31).bit_count() == 31


def solved(spark, m, game, budget):
    plan = spark.createDataFrame(Sh.coalition_plan(m, budget), "coalition bigint, size int, kernel_weight double")
    masks = [r["coalition"] for r in plan.collect()] + [0, 2 ** m - 1]
    rows = [(dt.date(2024, 1, 1), "a", 0, mask, game(mask)) for mask in masks]
    values = spark.createDataFrame(rows, "data_date date, id string, step int, coalition bigint, value double")
    got = {r["feature"]: r["phi"] for r in Sh.shapley_regression(values, plan, {f"g{i}": [] for i in range(m)}).collect()}
    return np.array([got[f"g{i}"] for i in range(m)])


def test_forty_groups(spark):
    rng = np.random.default_rng(0)
    own, pair = rng.normal(size=40), rng.normal(size=(40, 40)) * 0.05
    bits = lambda mask: np.array([mask >> i & 1 for i in range(40)])
    additive = solved(spark, 40, lambda mask: float(own @ bits(mask)), 600)
    assert np.allclose(additive, own)
    game = lambda mask: float(own @ bits(mask) + bits(mask) @ pair @ bits(mask))
    got = solved(spark, 40, game, 2000)
    assert got.sum() == pytest.approx(game(2 ** 40 - 1) - game(0))
    exact = own + (pair.sum(axis=0) + pair.sum(axis=1)) / 2     # a pair's worth is shared evenly
    assert np.abs(got - exact).max() < 1e-6                    # pairs of complements are exact for games of pairs


def test_error_of_a_budget_against_all_coalitions(spark):
    rng = np.random.default_rng(2)
    value = np.cumsum(rng.normal(size=1024)) * 0.05
    game = lambda mask: float(value[mask])
    exact = solved(spark, 10, game, 1022)
    gaps = [np.abs(solved(spark, 10, game, n) - exact).max() for n in (200, 700)]
    spread = np.abs(exact).max()
    assert gaps[0] < 0.5 * spread and gaps[1] < 0.25 * spread


def test_settings_of_a_width_share_the_order_of_columns(monkeypatch):
    rng = np.random.default_rng(5)
    x, y, distance = rng.normal(size=(20, 18)), rng.random(20), rng.random(20)
    options = {"labels": (1,), "top_labels": None, "selection": "highest_weights", "rank_alpha": 0.01, "regressor": Mm.ridge(1.0)}
    settings = list(itertools.product([0.25, 0.75], [2, 5, 9], [20]))
    fits = Su._Fits(("day", "a"), settings, 1, Su.kernel_of, options)
    parts = Su._parts(pd.DataFrame({"data_date": "day", "id": "a", "sample": range(20), "x": list(x), "p1": y, "distance": distance}),
                      [20], [0.25, 0.75], math.sqrt(18), Su.kernel_of)
    for row in parts.itertuples(index=False):
        fits.add(row)
    seen = []
    real = Mm.by_weight
    monkeypatch.setattr(Mm, "by_weight", lambda *a: seen.append(1) or real(*a))
    got = list(fits.fitted(settings))
    assert len(got) == 6 and len(seen) == 2
    for one, (width, k, _) in zip(got, settings, strict=True):
        xc, yc, _, _ = Mm.centred(fits.state[width], 1)
        kept = Mm.selected(xc, yc[:, 0], x[0], k, "highest_weights", 0.01)
        assert np.array_equal(one["x0"], x[0][kept]) and np.allclose(one["weight"], Mm.ridge(1.0)(xc[:, kept], yc)[:, 0])


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_shapley_regression_is_one_aggregation(spark):
    rng = np.random.default_rng(3)
    m, plan = 6, Sh.coalition_plan(6, 30)
    masks = [0, 63] + [mask for mask, _, _ in plan]
    weights = spark.createDataFrame(plan, "coalition bigint, size int, kernel_weight double")
    value = {(s, mask): float(rng.normal()) for s in range(3) for mask in masks}
    rows = [(dt.date(2024, 1, 1), None if s == 2 else "a", s, mask, v) for (s, mask), v in value.items()]
    schema = "data_date date, id string, step int, coalition bigint, value double"
    solved_ = Sh.shapley_regression(spark.createDataFrame(rows, schema), weights, {f"g{i}": [] for i in range(m)})
    assert "InPandas" not in plan_of(solved_)
    got = {(r["step"], r["feature"]): r["phi"] for r in solved_.collect()}
    z = np.array([[mask >> i & 1 for i in range(m)] for mask, _, _ in plan], float)
    w = np.sqrt([weight for _, _, weight in plan])
    for s in range(3):
        low, high = value[s, 0], value[s, 63]
        target = np.array([value[s, mask] for mask, _, _ in plan]) - low - z[:, -1] * (high - low)
        head = np.linalg.lstsq(w[:, None] * (z[:, :-1] - z[:, -1:]), w * target, rcond=None)[0]
        assert np.allclose([got[s, f"g{i}"] for i in range(m)], [*head, high - low - head.sum()])
    with pytest.raises(Exception, match="planned coalitions"):
        Sh.shapley_regression(spark.createDataFrame(rows[:-1], schema), weights, {f"g{i}": [] for i in range(m)}).collect()


def test_a_function_gets_matrices_of_one_block():
    seen = []

    def predict(batch):
        seen.extend(batch["inputs_num"])
        return batch["inputs_num"].map(lambda x: x.sum()) + batch["inputs_cat"].map(lambda x: x[-1][0]) + batch["inactivity"]

    scorer, rng = FunctionPrefix(predict, records=2), np.random.default_rng(0)
    num, cat = rng.normal(size=(5, 4)), np.arange(10).reshape(5, 2)
    state = scorer.step(scorer.step(scorer.start(), num[:1], cat[:1]), num[1:2], cat[1:2])
    p = scorer.finish(scorer.step(state, num[2:], cat[2:]), 3, np.array([0.5, 0.6, 0.7]))
    assert np.allclose(p, num[:2].sum() + num[2:].sum(axis=1) + cat[2:, 0] + [0.5, 0.6, 0.7])
    assert all(isinstance(x, np.ndarray) and x.shape == (3, 4) for x in seen) and seen[0].base is seen[1].base


def test_the_past_is_given_to_a_function_once():
    rng, rows, asked = np.random.default_rng(1), [], []
    weights = rng.normal(size=4)

    def row_by_row(x):
        rows.append(len(x))
        return x @ weights

    def predict(batch):
        score = of_steps(batch["inputs_num"], row_by_row, float)
        asked.append("block" in batch["inputs_num"].array.__dict__)  # nothing is written out
        plain = batch["inputs_num"].map(lambda x: x.sum())
        assert np.array_equal(plain, [x.sum() for x in batch["inputs_num"].to_numpy()])
        some = batch[batch["inactivity"] > 0.55]["inputs_num"]
        assert np.array_equal(some.iloc[-1], batch["inputs_num"].iloc[-1]) and some.iloc[-1].shape == (4, 4)
        both = pd.concat([batch["inputs_num"], some], ignore_index=True)
        assert len(both) == len(batch) + len(some) and np.array_equal(both.iloc[0], batch["inputs_num"].iloc[0])
        nested = pd.Series([x.tolist() for x in batch["inputs_num"]])
        assert np.allclose(score, of_steps(nested, lambda x: x @ weights, float))
        batch["inputs_num"].iloc[0][:] = 0                           # reaches no other batch
        return pd.Series(score.reshape(len(batch), -1).mean(axis=1) + plain.to_numpy())

    scorer, num, cat = FunctionPrefix(predict, records=3), rng.normal(size=(8, 4)), np.arange(16).reshape(8, 2)
    state = scorer.start()
    for t in range(3):
        state = scorer.step(state, num[t:t + 1], cat[t:t + 1])
    p = scorer.finish(scorer.step(state, num[3:], cat[3:]), 4, np.array([0.5, 0.6, 0.7, 0.8, 0.9]))
    past = num[:3] @ weights
    assert np.allclose(p, [(past.sum() + x @ weights) / 4 + num[:3].sum() + x.sum() for x in num[3:]])
    assert asked == [False, False] and sorted(rows) == [2, 3, 3, 3]  # two batches: three shared steps each, then one per record


def test_values_leave_a_task_as_one_row_per_step(small):
    values = Sh.prefix_values(small.space, small.background, prefix_scorer(lambda batch: batch["inactivity"] * 0 + 0.5))
    plan = plan_of(values)
    assert plan.index("Generate") < plan.index("FlatMapGroupsInPandas")  # coalitions become rows after the task
    assert values.columns == ["data_date", "id", "step", "coalition", "mean_proba", "value"]
    assert values.count() == small.space.count() * 128 and values.where("mean_proba <> 0.5").count() == 0


def test_slopes_make_no_row_per_sample_and_column(spark):
    rng = np.random.default_rng(4)
    day, width = dt.date(2024, 1, 1), 18
    own = {i: (rng.normal(size=(9, width)), rng.random(9), rng.random(9)) for i in ("a", "b", None)}
    rows = [(day, i, s, x[s].tolist(), float(p[s]), float(d[s])) for i, (x, p, d) in own.items() for s in range(9)]
    design = spark.createDataFrame(rows, "data_date date, id string, sample int, x array<double>, p1 double, distance double").repartition(5)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        fitted = Su.single_feature_fit(design, 1, 0.75)
        plan = plan_of(fitted)
        assert plan.index("Generate") < plan.index("Exchange")  # columns become rows after the shuffle
        got = {(r["id"], r["step"], r["feature"]): r for r in fitted.collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(got) == 3 * width
    for i, (x, p, d) in own.items():
        w = np.sqrt(np.exp(-d * d / (0.75 ** 2 * (Su.WIDTH + 1))))
        xc, pc = x - w @ x / w.sum(), p - w @ p / w.sum()
        slope = (w * pc) @ xc / (w @ (xc * xc) + 1.0)
        for j in range(width):
            r = got[(i, *Su._column_of(j, width))]
            assert (r["weight"], r["x0"]) == pytest.approx((slope[j], x[0, j]))
            assert r["intercept"] == pytest.approx((w @ p - (w @ x[:, j]) * slope[j]) / w.sum())


def test_selected_features_are_those_of_the_joint_fit_refitted(spark):
    rng = np.random.default_rng(6)
    day, width, k = dt.date(2024, 1, 1), 18, 4
    rows, own = [], {}
    for i, n in (("a", 9), ("b", 40)):                          # fewer samples than columns, and more
        x = rng.normal(size=(n, width))
        x[:, 3] = x[:, 0] - x[:, 1] + 0.1 * rng.normal(size=n)  # alone it says little beside the other two
        x[:, 9] = x[:, 5]                                       # columns with the same cells go by position
        y = 1 / (1 + np.exp(-(2 * x[:, 0] + 2 * x[:, 1] + x[:, 5] + 0.3 * x[:, 12])))
        own[i] = x, y, distance = x, y, rng.random(n)
        rows += [(day, i, s // 16, s, x[s].tolist(), float(y[s]), float(distance[s])) for s in range(n)]
    design = spark.createDataFrame(rows, "data_date date, id string, block int, sample int, x array<double>, p1 double, distance double")
    got = {(r["id"], r["step"], r["feature"]): r for r in Su.select_features(design, 1, k, 0.75).collect()}
    assert len(got) == 2 * k
    differ = 0
    for i, (x, y, distance) in own.items():
        w = np.sqrt(np.exp(-distance ** 2 / (0.75 ** 2 * width)))
        xc, yc = x - w @ x / w.sum(), y - w @ y / w.sum()
        joint = np.linalg.solve(xc.T @ (w[:, None] * xc) + 0.01 * np.eye(width), xc.T @ (w * yc))
        kept = np.sort(np.argsort(-np.round(np.abs(joint * x[0]), 9), kind="stable")[:k])
        beta = np.linalg.solve(xc[:, kept].T @ (w[:, None] * xc[:, kept]) + np.eye(k), xc[:, kept].T @ (w * yc))
        order = sorted(range(k), key=lambda j: (-round(abs(beta[j] * x[0, kept[j]]), 9), Su._column_of(kept[j], width)))
        place = {j: n for n, j in enumerate(order, 1)}
        alone = (w * yc) @ xc / (w @ (xc * xc) + 1.0)
        differ += set(np.argsort(-np.abs(alone * x[0]))[:k]) != set(kept)
        for j, column in enumerate(kept):
            r = got[(i, *Su._column_of(column, width))]
            assert (r["weight"], r["x0"], r["place"]) == (pytest.approx(beta[j]), pytest.approx(x[0, column]), place[j])
    assert differ                                               # slopes of single columns choose others
