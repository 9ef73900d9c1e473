"""The store: what its scans read, upserts that overlap, and statistics from footers."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from tessellate.operators import quality as Q
from tessellate.sources import store as S

SPEC = S.TableSpec("t", ("k",), "day", "k long, x double, day date")


def plan_of(df):
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


@pytest.fixture()
def root(spark, tmp_path):
    rows = [(i, float(i) if i % 5 else None, dt.date(2023, 1, 1) + dt.timedelta(days=i)) for i in range(300)]
    df = spark.createDataFrame(rows, "k long, x double, day date")
    S.upsert(spark, str(tmp_path), SPEC, df.where("k < 200"))
    S.upsert(spark, str(tmp_path), SPEC, df.where("k >= 150").withColumn("x", F.col("x") * 2))
    return str(tmp_path)


def test_scan_prunes_months(spark, root):
    got = S.scan_table(spark, root, SPEC, "2023-03-10", "2023-04-02", ("k", "day"))
    assert sorted(r["k"] for r in got.collect()) == list(range(68, 92))
    plan = plan_of(got)
    assert "PartitionFilters: [" in plan and "((year" in plan.split("PartitionFilters: [")[1].split("\n")[0]
    assert "GreaterThanOrEqual(day,2023-03-10)" in plan and "ReadSchema: struct<k:bigint,day:date>" in plan
    assert {f.split("year=")[1].split("/part")[0] for f in got.inputFiles()} >= {"2023/month=3", "2023/month=4"}


def test_upsert_keeps_old_rows_of_touched_months(spark, root):
    """May is of both writes: its first days stay as they were."""
    may = {r["k"]: r["x"] for r in SPEC.read(spark, root).where("month = 5").collect()}
    june = {r["k"]: r["x"] for r in SPEC.read(spark, root).where("month = 6").collect()}
    assert may[149] == 149.0 and len(may) == 31 and june[151] == 302.0


def test_statistics_come_from_footers(spark, root):
    got = S.footer_statistics(spark, root, SPEC, ["x"])
    plan = plan_of(got)
    assert "PushedAggregation: [COUNT(*), MIN(day), MAX(day), COUNT(x)]" in plan
    assert "PushedGroupBy: [year, month]" in plan
    r = got.first()
    assert (r["n_rows"], r["n_partitions"], r["n_x"]) == (300, 10, 240)
    assert (r["first"], r["last"]) == (dt.date(2023, 1, 1), dt.date(2023, 10, 27))
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"  # this session is as it was


def test_schema_of_files_that_differ(spark, tmp_path):
    spec = S.TableSpec("t", ("k",), "day")
    for i, extra in enumerate(("a int", "b string")):
        df = spark.createDataFrame([(i, dt.date(2023, 1 + i, 1), None)], f"k long, day date, {extra}")
        S._with_month(df, "day").write.mode("append").partitionBy("year", "month").parquet(spec.path(str(tmp_path)))
    got = {r["column_name"]: r["data_type"] for r in S.schema_table(spark, str(tmp_path), spec).collect()}
    assert got == {"k": "bigint", "day": "date", "a": "int", "b": "string", "year": "int", "month": "int"}


def test_table_set_with_no_table_there(spark, tmp_path):
    got = Q.table_set_status(spark, [Q.Expected("a", f"{tmp_path}/a", ("k",)), Q.Expected("b", f"{tmp_path}/b", ("k",), optional=True)])
    assert sorted((r["table"], r["status"]) for r in got.collect()) == [("a", "missing"), ("b", "skipped")]


def moved(spark, act):
    """Rows that an action's tasks shuffled, and those that they wrote."""
    jvm, store = spark.sparkContext._gateway.jvm, spark.sparkContext._jsc.sc().statusStore()

    def stages():
        found = store.stageList(jvm.java.util.ArrayList(), False, False, spark.sparkContext._gateway.new_array(jvm.double, 0), jvm.java.util.ArrayList())
        return {s.stageId(): s for s in (found.apply(i) for i in range(found.size()))}

    before = set(stages())
    act()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    new = [s for i, s in stages().items() if i not in before]
    return sum(s.shuffleWriteRecords() for s in new), sum(s.outputRecords() for s in new)


@pytest.mark.parametrize("parts", [None, 6, 200])
def test_upsert_moves_and_writes_rows_once(spark, tmp_path, parts):
    """Three months, the second of both writes: the rows of the months touched are shuffled and written
    once (the months' own list is shuffled too), and the later of two rows of a key stays."""
    spec = S.TableSpec("t", ("k", "day"), "day")
    days = spark.range(0, 6000, 1, 4).selectExpr("id DIV 60 AS k", "date_add(DATE '2023-01-02', CAST(id % 60 AS INT)) AS day", "CAST(id AS DOUBLE) AS x")
    early, late = days.where("day < '2023-02-11'"), days.where("day >= '2023-02-06'").withColumn("x", F.col("x") * 2)
    shuffled, written = moved(spark, lambda: S.upsert(spark, str(tmp_path), spec, early, parts))
    assert (shuffled, written) == (4000, 4000)
    again = late.unionByName(late.withColumn("x", F.col("x") - 1))
    shuffled, written = moved(spark, lambda: S.upsert(spark, str(tmp_path), spec, again, parts))
    assert written == 500 + 2500 and 1000 + 5000 <= shuffled < 1000 + 5000 + 100
    got = {(r["k"], r["day"]): r["x"] for r in spec.read(spark, str(tmp_path)).collect()}
    want = {(r["k"], r["day"]): r["x"] for r in early.union(late).collect()}
    assert got == want and len(got) == 6000
    assert sorted(p.name for p in (tmp_path).iterdir()) == ["t"]
    files = max(1, -(-(parts or 1) // S.PARTS_A_FILE))
    assert all(len(list(m.glob("*.parquet"))) <= files for m in (tmp_path / "t").glob("year=*/month=*"))
