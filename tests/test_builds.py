"""Kept and growing tables: what they read, and that batches equal one build."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F
from tessellate.operators import rolling as R
from tessellate.plans import catalog
from tessellate.sources import builds as B
from tessellate.sources.store import TableSpec, upsert

SOURCE, TARGET, COUNTS = TableSpec("p", ("entity", "session")), TableSpec("f", ("entity", "session")), TableSpec("m", ("day", "feature"), "day")
FIRST, N = dt.date(2022, 1, 3), 120


def week(i):
    return FIRST + dt.timedelta(days=7 * i)


@pytest.fixture()
def rows(spark):
    out = [(e, week(i), i + 1, 10.0 + (e * i * 7) % 11 + i / 50, 100.0 + i % 9) for e in range(1, 6) for i in range(N) if (e + i) % 13]
    df = spark.createDataFrame(out, "entity long, session date, pos int, close double, bench double")
    return df.withColumns({"traded": F.lit(True), "vol": F.col("close") * 3, "amount": F.col("close") * 7, "open": F.col("close") - 1, "high": F.col("close") + 1, "low": F.col("close") - 2})


def made(df):
    return R.feature_frame(df, (4, 10)).select("entity", "session", "ret_1d", "ret_4", "realized_vol_10", "max_drawdown_4")


def test_batches_equal_one_build(spark, rows, tmp_path):
    cal = spark.createDataFrame([(week(i), i + 1) for i in range(N)], "session date, pos int")
    features, seen = ["ret_4", "realized_vol_10"], []
    for lo, hi in ((0, 80), (80, 100), (100, 101), (101, N)):
        upsert(spark, str(tmp_path), SOURCE, rows.where((F.col("pos") > lo) & (F.col("pos") <= hi)))

        def watched(df, seen=seen):
            found = re.search(r"PartitionFilters: \[[^\]]*month#\d+\) >= (\d+)", df._jdf.queryExecution().executedPlan().toString())
            seen.append(int(found.group(1)) if found else None)
            return made(df)

        since = B.extend(spark, str(tmp_path), SOURCE, TARGET, cal, watched, 3, 25)
        assert since == (None if lo == 0 else week(lo - 1 - 3).isoformat())
        B.update_missing_counts(spark, str(tmp_path), TARGET, COUNTS, features, since)
    # each batch but the first reads from the month on that holds the 28th session before the last stored one
    months = [d.year * 12 + d.month for d in (week(lo - 1 - 28) for lo in (80, 100, 101))]
    assert seen == [None, *months]
    got, want = TARGET.read(spark, str(tmp_path)).drop("year", "month"), made(rows)
    key = lambda df: sorted((r["entity"], str(r["session"]), *[None if x is None else round(x, 9) for x in r[2:]]) for r in df.collect())
    assert key(got) == key(want)
    ratios = {r["feature"]: r["missing_ratio"] for r in B.missing_ratios_of(COUNTS.read(spark, str(tmp_path))).collect()}
    assert ratios == pytest.approx({r["feature"]: r["missing_ratio"] for r in R.missing_ratios(want, features).collect()})


ENTITY = re.compile(r"Exchange hashpartitioning\((entity|l_suppkey)")
READING_BUCKETS = ["f01_f05_returns", "f03_gaps", "f04_f06_f21_compounded", "f07_trend", "f08_f10_dispersion", "f11_f12_f15_activity", "f13_f14_extremes", "f16_f18_comovement", "f22_f24_missing_ratios", "h01_h07_labels", "g_cs_rank_ret"]


@pytest.mark.parametrize("name", READING_BUCKETS)
def test_windows_over_the_kept_panel_need_no_exchange(name, spark):
    plan = catalog.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan or "SelectedBucketsCount" in plan
    assert not ENTITY.search(plan)


def test_bounds_prune_years(spark):
    from tessellate.plans.base import panel

    plan = panel(spark, "/root/testdata/sf0.001", "1999-05-05")._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*year#\d+ >= 1999", plan) and "GreaterThanOrEqual(session,1999-05-03)" in plan


def test_label_batches_know_a_close_from_before_their_warm_up(spark, tmp_path):
    from tessellate.operators import labels as L
    from tessellate.plans import growing as W

    cal = spark.createDataFrame([(week(i), i + 1) for i in range(40)], "session date, pos int")
    # entity 1 has no bar from session 15 to 32, and opens far above its last close on the 33rd
    out = [(e, week(i), i + 1, None if e == 1 and 14 <= i < 32 else 10.0 * (5 if e == 1 and i >= 32 else 1) + i % 3) for e in (1, 2) for i in range(40)]
    df = spark.createDataFrame(out, "entity long, session date, pos int, open double")
    df = L.with_limits(df.withColumns({"close": F.col("open"), "traded": F.col("open").isNotNull(), "grp": F.lit(1), "bench": F.lit(100.0) + F.col("pos")}))
    for lo, hi in ((0, 32), (32, 40)):
        upsert(spark, str(tmp_path), W.SOURCE, df.where((F.col("pos") > lo) & (F.col("pos") <= hi)))
        B.extend(spark, str(tmp_path), W.SOURCE, W.LABEL_TABLE, cal, W.labels_of, 7, 2)
    got, want = W.LABEL_TABLE.read(spark, str(tmp_path)).drop("year", "month"), W.labels_of(df)
    key = lambda d: sorted(map(str, d.select("entity", "session", "horizon", "reason", "future_excess_ret", "label_quantile").collect()))
    assert key(got) == key(want)
    assert want.where("entity = 1 AND horizon = 1 AND pos = 32").first()["reason"] == "entry_not_buyable"


def test_universe_leaves_the_panel_in_its_buckets(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # these tables are small
    try:
        for name in ("e01_e07_universe", "e01_e03_listed_universe"):
            plan = catalog.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
            assert not re.search(r"hashpartitioning\(entity#\d+L?, session", plan), name
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
