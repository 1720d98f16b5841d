"""Time the headline jobs on ``$BENCH_SF_DIR`` and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from harness import fixtures as X  # noqa: E402
from harness.check import session  # noqa: E402
from harness.stage import Stage  # noqa: E402
from propensight.operators import evaluate as Ev, extract as E, model as M, sequences as S  # noqa: E402
from propensight.operators import shapley as Sh, space as Sp, stats as St, surrogate as Su  # noqa: E402


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(int(os.environ.get("BENCH_CPUS", "8")))
    s = Stage(spark, sf_dir)
    p = s.params
    times: dict[str, float] = {}

    def timed(name, job):
        start = time.perf_counter()
        job()
        times[name] = round(time.perf_counter() - start, 3)

    run(s.events.groupBy("id").count())  # start the JVM's compilers before timing
    timed("retrieve_features", lambda: run(s.extract_at(s.cutoff)))
    timed("retrieve_features_many", lambda: run(E.retrieve_features_many(
        s.events, s.visits, s.products, s.known, X.CUTOFFS, p)))
    timed("value_lists", lambda: (s.extract, s.vocabulary, s.slots))
    timed("event_features", lambda: s.features)
    timed("sequence_examples", lambda: run(S.sequence_examples(s.features, p.max_len, p.horizon)))
    timed("write_sequences", lambda: s.examples)
    timed("pool_sequences", lambda: run(M.pool_sequences(s.examples)))
    timed("fit_and_score", lambda: run(M.score(M.fit_classifier(s.examples), s.examples)))
    timed("roc_curve", lambda: run(Ev.roc_curve(s.scored)))
    timed("explainer_space", lambda: run(Sp.to_explainer_space(s.steps)))
    timed("column_stats", lambda: run(St.column_stats(s.space)))
    timed("value_frequencies", lambda: run(St.value_frequencies(s.space)))
    timed("training_statistics", lambda: (s.stats, s.stats_per_step, s.frequencies, s.hierarchy, s.max_length))
    timed("surrogate_samples", lambda: s.design)
    timed("surrogate_fit", lambda: run(Su.local_linear_fit(s.design, s.max_length, [(p.kernel_width, None, p.samples)])))
    timed("background_set", lambda: s.background)
    timed("shapley_values", lambda: run(Sh.shap_instances(s.space, s.background, s.scorer)))
    n = s.examples.count()
    seconds = times["surrogate_samples"] + times["surrogate_fit"]
    print(json.dumps({
        "metric": "total time of the headline jobs", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": sf_dir.rstrip("/").split("sf")[-1], "instances": n,
        "surrogate_instances_per_minute": round(60 * n / seconds, 1),
        "shapley_instances_per_minute": round(60 * n / times["shapley_values"], 1)}))


if __name__ == "__main__":
    main()
