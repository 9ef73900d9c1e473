"""Operators on small tables with values worked out by hand."""

import datetime as dt
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from tessellate.functions.columns import avg_rank_pct, bucketize, corr_of
from tessellate.functions.running import Rolling, extremes_of
from tessellate.operators import calendar as C
from tessellate.operators import diagnostics as D
from tessellate.operators import drift as K
from tessellate.operators import joins as J
from tessellate.operators import labels as L
from tessellate.operators import model as T
from tessellate.operators import monitor as M
from tessellate.operators import panel as P
from tessellate.operators import rolling as R
from tessellate.sources import store as S

DAY = dt.date(2024, 1, 1)


def day(i):
    return DAY + dt.timedelta(days=i)


@pytest.fixture(scope="module")
def cal(spark):
    return C.open_sessions(spark.createDataFrame([(day(i),) for i in range(40) if i % 7 < 5], "session date"))


def make_panel(spark, closes):
    """closes: entity to a list in which None is a session without a bar."""
    rows = [(e, day(i), i + 1, c, c, c, c, 10.0, 10.0 * c if c else None, c is not None, 100.0 + i) for e, cs in closes.items() for i, c in enumerate(cs)]
    rows = [(*r[:7], r[7] if r[9] else None, *r[8:]) for r in rows]
    return spark.createDataFrame(rows, "entity long, session date, pos int, open double, high double, low double, close double, vol double, amount double, traded boolean, bench double")


def column(df, name, entity=1):
    return [r[name] for r in df.where(F.col("entity") == entity).orderBy("pos").collect()]


def test_return_needs_both_sessions(spark):
    p = R.with_returns(make_panel(spark, {1: [10.0, 11.0, None, 12.0, 12.0]}))
    assert [None if x is None else round(x, 6) for x in column(p, "ret_1d")] == [None, 0.1, None, None, 0.0]


def test_window_needs_three_fifths(spark):
    p = R.compounded(R.with_returns(make_panel(spark, {1: [10.0, 11.0, 12.1, None, 10.0, 10.0]})), (3,))
    got = column(p, "ret_3")
    assert got[1] is None and round(got[2], 6) == 0.21 and round(got[3], 6) == 0.21 and got[4] is None


def test_drawdown_of_drawdowns(spark):
    p = R.extremes(make_panel(spark, {1: [10.0, 5.0, 8.0]}), (3,))
    assert column(p, "max_drawdown_3")[2] == pytest.approx(-0.5)


def test_no_feature_looks_ahead(spark):
    short = {1: [10.0, 11.0, 9.0, None, 12.0, 13.0], 2: [5.0, 5.5, 6.0, 5.0, None, 4.0]}
    more = {e: [*c, 99.0, 1.0] for e, c in short.items()}
    a = R.feature_frame(make_panel(spark, short), (3,)).orderBy("entity", "pos").collect()
    b = R.feature_frame(make_panel(spark, more), (3,)).where("pos <= 6").orderBy("entity", "pos").collect()
    assert a == b


def test_partitioning_changes_nothing(spark):
    p = make_panel(spark, {e: [10.0 + (e * i) % 7 for i in range(12)] for e in range(1, 8)})
    a = R.feature_frame(p.repartition(1), (3,)).orderBy("entity", "pos").collect()
    assert a == R.feature_frame(p.repartition(7), (3,)).orderBy("entity", "pos").collect()


def test_rolling_cov_uses_each_sides_own_mean(spark):
    df = spark.createDataFrame([(1, 1, 1.0, 2.0), (1, 2, 2.0, None), (1, 3, 4.0, 6.0)], "entity long, pos int, x double, y double")
    r = Rolling(df, {"x": F.col("x"), "y": F.col("y")}, (3,), pairs=[("x", "y")])
    got = r.finish({"c": r.covariance("x", "y", 3)}).where("pos = 3").first()["c"]
    assert got == pytest.approx((13 - 7 / 3 * 4) * 2)


def windows_of(values, w, t):
    return [x for x in values[max(0, t - w + 1) : t + 1] if x is not None]


def test_running_sums_equal_direct_windows(spark):
    """Long windows over trends, gaps, jumps and constant stretches, to 1e-9."""
    rng = np.random.default_rng(3)
    series = {}
    for e in range(1, 7):
        xs = (100 + 3 * np.cumsum(rng.standard_normal(400)) + 50 * (e == 2) * np.arange(400)).tolist()
        xs[40:90] = [7.0] * 50
        series[e] = [None if rng.random() < 0.2 * (e > 3) or e == 6 and i < 150 else x for i, x in enumerate(xs)]
    series[5][10], series[5][11] = float("nan"), float("inf")
    rows = [(e, i, x, None if x is None or i % 9 == 0 else x * 0.5 + float(rng.standard_normal())) for e, xs in series.items() for i, x in enumerate(xs)]
    df = spark.createDataFrame(rows, "entity long, pos int, x double, y double")
    ws = (3, 20, 120)
    r = Rolling(df, {"x": F.col("x"), "y": F.col("y")}, ws, spread=("x",), pairs=[("x", "y")])
    made = {k: v for w in ws for k, v in {f"mean_{w}": r.mean("x", w), f"sum_{w}": r.total("y", w), f"sd_{w}": r.deviation("x", w), f"cov_{w}": r.covariance("x", "y", w)}.items()}
    got = {(row["entity"], row["pos"]): row for row in extremes_of(r.finish(made), [("hi", F.col("x"), True, ws), ("lo", F.col("x"), False, (5,))]).collect()}
    near = lambda x, scale=1.0: None if x is None else pytest.approx(x, rel=1e-9, abs=1e-9 * scale)
    ys = {(e, i): y for e, i, _, y in rows}
    for e, xs in series.items():
        xs = [x if x is not None and math.isfinite(x) else None for x in xs]
        for t in range(400):
            row = got[e, t]
            for w in ws:
                own, least = windows_of(xs, w, t), math.ceil(w * 0.6)
                there = len(own) >= least
                assert row[f"mean_{w}"] == near(float(np.mean(own)) if there else None)
                sd = float(np.std(own, ddof=1)) if there and len(own) > 1 else None
                assert row[f"sd_{w}"] == near(0.0 if sd is not None and len(set(own)) == 1 else sd, 1e3)
                places = range(max(0, t - w + 1), t + 1)
                y = [v for i in places if (v := ys[e, i]) is not None and math.isfinite(v)]
                assert row[f"sum_{w}"] == near(sum(y) if len(y) >= least else None, 1e3)
                both = [(xs[i], ys[e, i]) for i in places if xs[i] is not None and ys[e, i] is not None and math.isfinite(ys[e, i])]
                n = len(both)
                cov = (sum(a * b for a, b in both) / n - np.mean(own) * np.mean(y)) * n / (n - 1) if n > 1 and n >= least else None
                assert row[f"cov_{w}"] == near(cov, 1e5)
                if e != 5:  # no NaN, which ranks above all numbers
                    assert row[f"hi_{w}"] == max(own, default=None)
            if e != 5:
                assert row["lo_5"] == min(windows_of(xs, 5, t), default=None)


def test_rolling_plans_hold_no_frame_of_a_window(spark):
    """Every frame begins at an entity's first row or is the offset of a lag."""
    p = make_panel(spark, {1: [10.0, 11.0, 12.0]})
    plan = R.feature_frame(p, (20, 120))._jdf.queryExecution().executedPlan().toString()
    frames = set(re.findall(r"specifiedwindowframe\(RowFrame, ([^)]*)\)", plan))
    ends = {f for f in frames if "unboundedpreceding" not in f}
    assert frames and all(len(set(x.strip() for x in f.replace("currentrow$()", "0").split(","))) == 1 for f in ends), frames


def test_ranks_average_ties_and_skip_ineligible(spark):
    df = spark.createDataFrame([("a", 1.0, True), ("b", 2.0, True), ("c", 2.0, True), ("d", 9.0, False), ("e", None, True)], "k string, x double, ok boolean").withColumn("s", F.lit(1))
    got = {r["k"]: r["p"] for r in df.select("k", avg_rank_pct("x", ["s"], F.col("ok")).alias("p")).collect()}
    assert got == {"a": 1 / 3, "b": 2.5 / 3, "c": 2.5 / 3, "d": None, "e": None}


def test_bucket_rules(spark):
    df = spark.createDataFrame([(0.2,), (0.21,), (1.0,), (None,)], "p double")
    by = {rule: [r[0] for r in df.select(bucketize("p", 5, rule)).collect()] for rule in ("floor", "ceil", "decile")}
    assert by == {"floor": [0, 1, 4, None], "ceil": [0, 1, 4, None], "decile": [1, 2, 5, None]}


def test_correlation_of_constants_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "x double, y double")
    assert df.agg(corr_of("x", "y")).first()[0] is None


def test_dates_are_cleaned(spark):
    df = spark.createDataFrame([("20240229",), (" 20240101.0",), ("20230229",), ("nan",), ("0",), (None,)], "d string")
    assert [r[0] for r in df.select(P.clean_date("d")).collect()] == [dt.date(2024, 2, 29), DAY, None, None, None, None]


def test_calendar_and_horizons(cal):
    rows = cal.orderBy("pos").collect()
    assert [r["pos"] for r in rows] == list(range(1, len(rows) + 1))
    h = {(r["pos"], r["horizon"]): r for r in C.horizon_map(cal, (1, 5)).collect()}
    assert h[1, 5]["entry_session"] == rows[1]["session"] and h[1, 5]["exit_session"] == rows[6]["session"]
    assert h[len(rows), 1]["entry_session"] is None


def test_age_counts_sessions(spark, cal):
    df = spark.createDataFrame([(day(7), day(2)), (day(7), day(9)), (day(7), day(-14))], "session date, list_date date")
    assert [r["age"] for r in C.session_age(df, cal, "list_date").orderBy("list_date").collect()] == [6 + 10, 4, 0]


def test_folds_keep_their_gaps(cal):
    for r in C.walk_forward_folds(cal, "2024-02-01", None, 3, (1, 5)).collect():
        assert r["eval_lo"] - r["val_hi"] == 7 and r["val_lo"] - r["train_hi"] == 7
    with pytest.raises(ValueError):
        C.walk_forward_folds(cal, "2024-02-01", None, 3, (1, 5), purge=3)


def test_report_periods(spark):
    got = [str(r[0]) for r in C.report_periods(spark, "2024-02-01", "2024-07-15", 60).orderBy("period").collect()]
    assert got == ["2023-12-31", "2024-03-31", "2024-06-30"]


def test_as_of_takes_whole_rows(spark):
    left = spark.createDataFrame([(1, day(1)), (1, day(3)), (1, day(5)), (2, day(5)), (None, day(1))], "k long, d date")
    right = spark.createDataFrame([(1, day(2), 1.0, "x"), (1, day(3), None, "y"), (1, day(6), 9.0, "z")], "k long, a date, v double, w string")
    got = {(r["k"], r["d"]): (r["v"], r["w"]) for r in J.as_of(left, right, "k", "d", "a", ["v", "w"]).collect()}
    assert got == {(1, day(1)): (None, None), (1, day(3)): (None, "y"), (1, day(5)): (None, "y"), (2, day(5)): (None, None), (None, day(1)): (None, None)}


def test_append_only_finds_conflicts(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(1, "a"), (2, "c"), (3, "d")], "k int, v string")
    assert {r["k"]: r["outcome"] for r in J.append_only(new, old, ["k"], ["v"]).collect()} == {1: "same", 2: "conflict", 3: "append"}


def test_labels_give_the_first_reason(spark):
    p = make_panel(spark, {1: [10.0, 10.0, 20.0, None, 10.0]}).withColumn("in_base", F.col("pos") != 3)
    got = L.forward_labels(L.with_limits(p, 10.0, 0.01), (1,)).orderBy("pos").collect()
    assert [r["reason"] for r in got] == ["exit_not_in_base_universe", "entry_not_in_base_universe", "missing_entry_price", "insufficient_future_calendar", "insufficient_future_calendar"]


def test_a_missing_label_lifts_nobody(spark):
    rows = [(DAY, e, float(-e), None if e == 0 else 1.0) for e in range(10)]
    df = spark.createDataFrame(rows, "session date, entity long, score double, y double")
    assert [r["entity"] for r in D.score_layers(df, (0.1,), 0.1).where("layer = 'top_10'").collect()] == [0]


def test_ndcg_of_perfect_order(spark):
    df = spark.createDataFrame([(DAY, e, float(e), e % 3) for e in range(6)] + [(day(1), e, float(e), e) for e in range(4)], "session date, entity long, score double, rel int")
    got = {r["session"]: r["ndcg"] for r in D.ndcg(df, "rel", 3).collect()}
    assert got[day(1)] == pytest.approx(1.0) and 0 < got[DAY] < 1


def test_pruning_keeps_the_better_one(spark):
    pairs = spark.createDataFrame([("a", "b", 0.99), ("b", "c", 0.2), ("a", "c", -0.97), ("c", "d", 0.95), ("d", "b", None)], "left string, right string, corr double")
    scores = spark.createDataFrame([("a", 2.0), ("b", 3.0), ("c", 1.0), ("d", 1.0)], "feature string, score double")
    got = [tuple(r) for r in D.prune_correlated(pairs, scores, 0.95).orderBy("place").collect()]
    assert got == [("b", 1, True, None, None), ("a", 2, False, "b", 0.99), ("c", 3, True, None, None), ("d", 4, False, "c", 0.95)]


def test_lifecycle(spark):
    days = spark.createDataFrame([("s", "m", day(i)) for i in range(6)], "subject string, metric string, day date")
    hits = spark.createDataFrame([("s", "m", day(i), "warning") for i in (1, 2, 4)], "subject string, metric string, day date, severity string")
    got = [(r["state"], r["first_seen"]) for r in M.alert_lifecycle(hits, days).orderBy("day").collect()]
    assert got == [("NEW", day(1)), ("ACTIVE", day(1)), ("RECOVERED", day(1)), ("NEW", day(4)), ("RECOVERED", day(4))]


def test_path_metrics(spark):
    df = spark.createDataFrame([("p", day(0), 0.1), ("p", day(1), -0.5), ("p", day(2), None)], "k string, session date, r double")
    got = D.path_metrics(df, ["k"], "session", "r", 2.0).first()
    assert got["total_return"] == pytest.approx(-0.45) and got["max_drawdown"] == pytest.approx(-0.5) and got["n"] == 2
    assert got["annual_return"] == pytest.approx(math.exp(math.log(0.55)) - 1)


def test_upsert_is_idempotent(spark, tmp_path):
    spec = S.TableSpec("t", ("k", "session"))
    first = spark.createDataFrame([(1, day(0), 1.0), (2, day(31), 2.0)], "k int, session date, v double")
    second = spark.createDataFrame([(1, day(0), 5.0), (3, day(0), 3.0)], "k int, session date, v double")
    for _ in range(2):
        S.upsert(spark, str(tmp_path), spec, first)
        S.upsert(spark, str(tmp_path), spec, second)
    got = {r["k"]: r["v"] for r in S.scan_table(spark, str(tmp_path), spec, "2024-01-01", "2024-12-31").collect()}
    assert got == {1: 5.0, 2: 2.0, 3: 3.0}
    part = S.scan_table(spark, str(tmp_path), spec, "2024-01-01", "2024-01-15", ["k"])
    assert "PartitionFilters: [isnotnull" in part._jdf.queryExecution().toString()
    assert sorted(r["k"] for r in part.collect()) == [1, 3]


def test_snapshot_refuses_nothing(spark, tmp_path):
    df = spark.createDataFrame([(1, 1), (1, 2)], "k int, t int")
    S.replace_snapshot(df, f"{tmp_path}/s", ["k"], ["t"])
    assert [r["t"] for r in spark.read.parquet(f"{tmp_path}/s").collect()] == [2]
    with pytest.raises(ValueError):
        S.replace_snapshot(df.limit(0), f"{tmp_path}/s", ["k"], ["t"])


def test_content_hash_ignores_order(spark):
    df = spark.range(100).withColumn("x", F.col("id") % 7)
    assert S.content_hash(df.repartition(5)).collect() == S.content_hash(df.orderBy(F.desc("id"))).collect()
    assert S.content_hash(df).collect() != S.content_hash(df.where("id > 0")).collect()


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("t", "r", 1)], "table string, rule string, n int")
    S.append_events(df, f"{tmp_path}/e", "2024-01-01")
    S.append_events(df, f"{tmp_path}/e", "2024-01-01")
    assert spark.read.json(f"{tmp_path}/e").count() == 2
    S.write_metrics(df, f"{tmp_path}/m")
    assert spark.read.option("header", True).csv(f"{tmp_path}/m").columns == df.columns


def test_shuffle_deals_within_sessions(spark):
    df = spark.createDataFrame([(day(s), e, float(100 * s + e)) for s in range(3) for e in range(9)], "session date, entity long, x double")
    out = T.shuffled(df, "x")
    a = {(r["session"], r["entity"]): r["x"] for r in out.collect()}
    b = {(r["session"], r["entity"]): r["x"] for r in T.shuffled(df.repartition(4), "x").collect()}
    assert a == b and all(sorted(v for (s, _), v in a.items() if s == day(k)) == [100.0 * k + e for e in range(9)] for k in range(3))


def test_history_percentile_matches_pairs(spark):
    from tessellate.operators import ranks

    values = [(k, i, float((i * 7 + k) % 5)) for k, n in ((1, 1), (2, 2), (3, 37)) for i in range(n)]
    got = ranks.history_percentile(spark.createDataFrame(values, "k long, i long, x double"), "k", "i", "x").collect()
    assert len(got) == len(values)
    for r in got:
        before = [x for k, i, x in values if k == r["k"] and i < r["i"]]
        want = sum(x <= r["x"] for x in before) / len(before) if before else None
        assert r["history_pct"] == (want if want is None else pytest.approx(want))


def test_drift_is_exact_whatever_the_ranges(spark):
    """Edges, PSI and KS against numpy, with ties, missing and infinite values, a group without reference values."""
    rng = np.random.default_rng(5)
    rows = []
    for f in ("a", "b", "ties", "none"):
        for p in range(4):
            for i in range(300):
                x = {"a": rng.normal(), "b": 1e6 * rng.exponential() + p, "ties": float(rng.integers(0, 4)), "none": None if p == 0 else 1.0}[f]
                x = None if rng.random() < 0.05 else float("inf") if rng.random() < 0.02 else x
                rows.append((f, p, i, None if x is None else float(x)))
    df = spark.createDataFrame(rows, "feature string, period int, id int, x double")
    ref, cur = df.where("period = 0"), df.where("period > 0")
    results = []
    for ranges in (1, 3, 40):
        got = {(r["feature"], r["period"]): r for r in K.feature_drift(ref, cur, ["feature"], "period", "x", ranges=ranges, key=["id"]).collect()}
        results.append({k: (round(v["psi"], 9), v["ks"] and round(v["ks"], 9)) for k, v in got.items()})
        for f in ("a", "b", "ties", "none"):
            own = lambda p, f=f: [x for g, q, _, x in rows if g == f and q == p]
            clean = lambda xs: np.sort([x for x in xs if x is not None and math.isfinite(x)])
            left = clean(own(0))
            edges = np.unique(np.quantile(left, np.linspace(0, 1, 11)[1:-1])) if len(left) else np.array([])
            found = {r["feature"]: r["edges"] for r in K.exact_edges(K.value_counts(ref, ["feature"], "x"), ["feature"], 10, ranges).collect()}
            assert found[f] == pytest.approx(edges.tolist(), rel=1e-12)
            share = lambda xs: np.clip(np.bincount([0 if x is None or not math.isfinite(x) else 1 + int((edges <= x).sum()) for x in xs], minlength=len(edges) + 2) / len(xs), 1e-6, None)  # noqa: E731, B023
            for p in (1, 2, 3):
                right = clean(own(p))
                r, c = share(own(0)), share(own(p))
                assert got[f, p]["psi"] == pytest.approx(float(((c - r) * np.log(c / r)).sum()), rel=1e-9)
                assert got[f, p]["coverage"] == pytest.approx(len(right) / 300) and got[f, p]["n"] == 300
                if not len(left):
                    assert got[f, p]["ks"] is None
                    continue
                support = np.concatenate([left, right])
                want = np.abs(np.searchsorted(left, support, side="right") / len(left) - np.searchsorted(right, support, side="right") / len(right)).max()
                assert got[f, p]["ks"] == pytest.approx(want, rel=1e-12)
    assert results[0] == results[1] == results[2]
    few = K.feature_drift(ref, cur, ["feature"], "period", "x", key=["id"], most_reference=100, most_current=50).collect()
    assert len(few) == 12 and all(r["n"] == 300 for r in few)


def test_the_worst_period_is_the_first_of_equal_ones(spark):
    rows = [("f", "1997", 0.2), ("f", "1996", 0.2 - 1e-12), ("f", "1998", 0.19996), ("f", "1995", None), ("g", "1996", None)]
    drift = spark.createDataFrame(rows, "feature string, month string, psi double").repartition(3)
    assert [(r["feature"], r["month"]) for r in K.worst_features(drift, 5).collect()] == [("f", "1996"), ("g", None)]


def test_era_flags_keep_every_bar(spark):
    rows = [(1, day(0), 10.0, 11.0, 9.0, 10.0), (1, day(1), 10.0, 9.5, 9.0, 10.0), (1, day(9), 10.0, 9.5, 9.0, 10.0), (1, day(10), None, 9.5, 9.0, 10.0)]
    bars = spark.createDataFrame(rows, "entity long, session date, open double, high double, low double, close double")
    flags = [(r["is_valid"], r["is_kept"]) for r in P.era_flags(bars, day(5).isoformat()).orderBy("session").collect()]
    assert flags == [(True, True), (False, False), (False, True), (False, True)]
    assert [r["is_valid"] for r in P.era_rule(bars, day(5).isoformat()).orderBy("session").collect()] == [True, False, False]


def test_a_feature_frame_is_of_all_sessions_or_from_its_start(spark):
    p = make_panel(spark, {1: [10.0, 11.0, 12.1, None, 10.0, 10.5, 12.0]})
    whole, late = R.feature_frame(p, (3,)), R.feature_frame(p, (3,), day(4).isoformat())
    assert whole.count() == 7 and column(late, "pos") == [5, 6, 7]
    assert column(late, "ret_3") == column(whole, "ret_3")[4:]


def test_the_feature_table_query_has_every_row_of_the_panel(spark):
    from tessellate.plans import catalog
    from tessellate.plans.base import panel

    sf = "/root/testdata/sf0.001"
    assert catalog.QUERIES["f23_feature_frame"](spark, sf).count() == panel(spark, sf).count()


def test_all_labels_are_counted_against_the_base_universe(spark):
    from tessellate.plans import catalog

    out = catalog.QUERIES["h09_reconcile_counts"](spark, "/root/testdata/sf0.001").collect()
    # labels are there for each entity and session, available or not
    assert out and {r["found"] for r in out} == {10}


def test_observations_get_all_labels_and_wait_without_one(spark):
    from tessellate.operators import monitor as M
    from tessellate.plans import catalog

    seen = spark.createDataFrame([(e, day(0), 1) for e in (1, 2, 3)], "entity long, session date, horizon int")
    kept = spark.createDataFrame([(1, day(0), 1, True, 0.5, None), (2, day(0), 1, False, None, "exit_suspended")], "entity long, session date, horizon int, is_label_available boolean, future_excess_ret double, reason string")
    got = {r["entity"]: (r["label_status"], r["label_reason"], r["y"]) for r in M.attach_labels(seen, kept).collect()}
    assert got == {1: ("available", None, 0.5), 2: ("unavailable", "exit_suspended", None), 3: ("pending", None, None)}
    statuses = {r["label_status"] for r in catalog.QUERIES["l03_label_status"](spark, "/root/testdata/sf0.001").collect()}
    assert statuses == {"available", "unavailable"}  # every session has its labels


def test_spread_bars_are_the_dense_grid(spark, cal):
    days = [r["session"] for r in cal.orderBy("pos").collect()]
    rows = [(1, days[0], 5.0), (1, days[3], 6.0), (2, days[-1], 7.0), (3, None, 8.0), (4, None, 8.0), (4, days[0], 9.0), (4, days[7], 9.5), (None, days[2], 1.0), (5, days[4], None)]
    bars = spark.createDataFrame(rows, "entity long, session date, close double")
    want = P.densify(bars, cal, bars.select("entity").distinct()).select("entity", "session", "pos", "close", "traded")
    got = P.spread_bars(bars, cal)
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() == 6 * len(days)


def test_the_panel_is_dealt_once(spark, tmp_path):
    from tessellate.plans import base

    cal = base.calendar(spark, "/root/testdata/sf0.001")
    plan = base._made_panel(spark, "/root/testdata/sf0.001", cal, 8)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_flag_within_and_liquidity_are_as_joined(spark, cal):
    p = make_panel(spark, {1: [10.0, None, 12.0, 13.0, None, 9.0], 2: [None, 5.0, 5.0, None, 5.0, 5.0], 3: [1.0] * 6})
    days = p.select("session", "pos").distinct()
    spans = spark.createDataFrame([(1, day(1), day(2)), (1, day(2), day(3)), (1, day(5), None), (2, day(0), day(0)), (9, day(0), None), (None, day(0), None)], "entity long, s date, e date")
    args = (spans, days, "entity", "s", "e")
    want = J.flag(p, J.interval_keys(*args), ["entity", "session"], "held")
    got = J.flag_within(p, J.merged_intervals(*args), "entity", "held")
    assert [column(got, "held", e) for e in (1, 2, 3)] == [column(want, "held", e) for e in (1, 2, 3)]
    assert column(got, "held") == [False, True, True, True, False, True]
    want = p.join(L.liquidity(p.where("traded"), 2).select("entity", "session", "amount_mean", "amount_count"), ["entity", "session"], "left")
    got = L.with_liquidity(p, 2)
    for name in ("amount_mean", "amount_count"):
        assert [column(got, name, e) for e in (1, 2, 3)] == [column(want, name, e) for e in (1, 2, 3)]
