"""The trained model's queries: equal seeds, metrics recomputed in SQL, importances against plain versions."""

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from tessellate.operators import model as T
from tessellate.plans import models
from tessellate.plans.metrics import FEATURES

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def scored(spark):
    train, test = models.split(spark, SF)
    out = T.fit_scores(train, FEATURES, trees=3)(test).select("entity", "session", "score", "y", *FEATURES).toPandas()
    again = T.fit_scores(train.repartition(3), FEATURES, trees=3)(test).select("entity", "session", "score").toPandas()
    return out, again


def test_equal_seeds_give_equal_scores(scored):
    """M1: whatever the partitioning; and scores differ between rows."""
    key = ["entity", "session"]
    a, b = (x.sort_values(key).reset_index(drop=True) for x in scored)
    assert len(a) == len(b) > 1000 and a["score"].nunique() > 5
    assert np.allclose(a["score"], b["score"], atol=1e-9)


def test_scorecard_equals_sql(spark, scored):
    """M2: the mean rank IC, its ratio, and the share of positive years, from the scored rows."""
    rows = scored[0]
    cal = spark.createDataFrame([(d, i + 1) for i, d in enumerate(sorted(set(rows["session"])))], "session date, pos int")
    got = T.scorecard(spark.createDataFrame(rows[["entity", "session", "score", "y"]], "entity long, session date, score double, y double").withColumn("y", F.when(~F.isnan("y"), F.col("y"))), cal).first()
    con = duckdb.connect()
    con.register("r", rows.assign(y=rows["y"].astype(float)))
    want = con.sql(
        """
        WITH t AS (SELECT session, score, y FROM r WHERE y IS NOT NULL AND NOT isnan(y)),
        k AS (SELECT session, rank() OVER (PARTITION BY session ORDER BY score) + (count(*) OVER (PARTITION BY session, score) - 1) / 2.0 AS a,
                     rank() OVER (PARTITION BY session ORDER BY y) + (count(*) OVER (PARTITION BY session, y) - 1) / 2.0 AS b FROM t),
        ic AS (SELECT session, CASE WHEN stddev_pop(a) * stddev_pop(b) > 1e-14 THEN (avg(a * b) - avg(a) * avg(b)) / (stddev_pop(a) * stddev_pop(b)) END AS c FROM k GROUP BY session HAVING count(*) >= 3)
        SELECT avg(c), avg(c) / stddev_samp(c), (SELECT avg(CAST(m > 0 AS INTEGER)) FROM (SELECT avg(c) AS m FROM ic GROUP BY year(session))) FROM ic
        """
    ).fetchall()[0]
    assert (got["ic_mean"], got["icir"], got["positive_years"]) == pytest.approx(want, rel=1e-9)


def test_permutation_importance_equals_plain(spark):
    """M3: with a score that is one feature, only shuffling that one lowers the IC, by as much as plain code says."""
    rng = np.random.default_rng(1)
    rows = [(e, s, float(rng.normal()), float(rng.normal())) for s in range(12) for e in range(15)]
    df = spark.createDataFrame([(e, s, a, b, a + 0.3 * b) for e, s, a, b in rows], "entity long, session int, a double, b double, y double")
    score = lambda d: d.withColumn("score", F.col("a"))
    got = {r["feature"]: r["importance"] for r in T.permutation_importance(df, score, ["a", "b"]).collect()}
    assert got["b"] == pytest.approx(0.0, abs=1e-12)
    dealt = T.shuffled(df, "a").toPandas()
    for s, own in df.toPandas().groupby("session"):
        assert sorted(own["a"]) == sorted(dealt[dealt["session"] == s]["a"])
    ic = lambda d: np.mean([g["a"].rank().corr(g["y"].rank()) for _, g in d.groupby("session")])
    assert got["a"] == pytest.approx(ic(df.toPandas()) - ic(dealt), rel=1e-9)


def test_splits_and_blended_order(spark, tmp_path):
    """M4: the table of splits holds every inner node, and the blend is that of pandas."""
    rng = np.random.default_rng(4)
    rows = [(float(a), None if i % 7 == 0 else float(b), float(c), float(3 * a + (b if i % 7 else 2))) for i, (a, b, c) in enumerate(rng.normal(size=(400, 3)))]
    df = spark.createDataFrame(rows, "a double, b double, c double, y double")
    model = T.fit_trees(df, ["a", "b", "c"], trees=4, depth=2)
    splits = T.split_table(spark, model, ["a", "b", "c"], str(tmp_path / "m"))
    assert splits.count() == sum((t.numNodes - 1) // 2 for t in model.trees)
    gains = T.split_importance(splits, ["a", "b", "c", "d"]).toPandas().set_index("feature")
    assert gains["gain_importance"].idxmax() == "a" and gains.loc["d", "split_importance"] == 0
    text = "".join(t.toDebugString for t in model.trees)
    for i, f in enumerate("abc"):  # an inner node names its feature in the If and the Else line
        assert gains.loc[f, "split_importance"] == sum(text.count(f"If (feature {k} ") for k in (i, i + 3))
    summary = pd.DataFrame({"feature": ["a", "b", "c", "d", "e"], "robust_score": [0.1, 0.3, 0.3, None, 0.05]})
    got = T.blended_order(spark.createDataFrame(summary.astype(object).where(summary.notna(), None).values.tolist(), "feature string, robust_score double"), spark.createDataFrame(gains.reset_index())).toPandas().set_index("feature")
    both = summary.merge(gains.reset_index(), on="feature", how="left")
    want = pd.concat([both[c].rank(pct=True) for c in ("robust_score", "gain_importance", "split_importance")], axis=1).mean(axis=1)
    assert got["ordering_score"].to_dict() == pytest.approx(dict(zip(both["feature"], want, strict=True)))
    order = both.assign(s=want).sort_values(["s", "feature"], ascending=[False, True])["feature"].tolist()
    assert got.sort_values("place").index.tolist() == order
    assert T.top_sets(order, (2, 9, 2)) == {"top_2": order[:2], "all_accepted": order}


def test_blended_query_ranks_all_features(spark):
    got = models.blended(spark, SF).toPandas()
    assert sorted(got["feature"]) == sorted(FEATURES) and sorted(got["place"]) == [1, 2, 3]
