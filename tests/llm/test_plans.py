"""The size of the plans that the driver holds for the near-duplicate join."""

import random

from tessellate.llm import components, jaccard_join


def test_no_plan_of_the_join_repeats_its_parts(spark, monkeypatch):
    rng = random.Random(3)
    texts = [[rng.choice("abcdefghijklmnop") * 3 for _ in range(60)] for _ in range(40)]
    rows = [(i, " ".join(texts[i % 40] + ["end"] * (i // 40))) for i in range(120)]
    seen = []

    def counted(df, *by, staged=jaccard_join.staged):
        seen.append(df._jdf.queryExecution().executedPlan().toString().count("Exchange"))
        return staged(df, *by)

    monkeypatch.setattr(jaccard_join, "staged", counted)
    monkeypatch.setattr(components, "staged", counted)
    out = jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), count=False)
    assert {r["doc_id"]: r["component_id"] for r in out.collect()} == {i: i % 40 for i in range(120)}
    # a large plan costs the driver memory for each of its parts: threads, generated code, descriptions
    assert len(seen) > 8 and max(seen) <= 20, seen
