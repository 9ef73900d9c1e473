"""What the near-duplicate join leaves on disks."""

import random
from pathlib import Path

import numpy as np
import pytest
from tessellate.llm import jaccard_join
from tessellate.llm.common import shared_dir


def shuffled(spark):
    """Bytes that stages have written to shuffles so far."""
    jvm = spark.sparkContext._jvm
    stages = spark.sparkContext._jsc.sc().statusStore().stageList(None, False, False, spark.sparkContext._gateway.new_array(jvm.double, 0), jvm.java.util.ArrayList())
    return sum(stages.apply(k).shuffleWriteBytes() for k in range(stages.size()))


def test_join_moves_sets_seldom_and_leaves_only_what_its_result_reads(spark):
    rng = random.Random(4)
    rows = []
    for k in range(60):  # groups of four near copies
        words = [f"w{rng.randrange(10**9)}" for _ in range(1500)]
        rows += [(4 * k + j, " ".join([*words, *["end"] * (5 * j)])) for j in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    home = Path(shared_dir(spark).removeprefix("file:"))
    before, there = shuffled(spark), set(home.rglob("*.parquet"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for tables too large for it
    try:
        out = jaccard_join.jaccard_components(docs)
        got = {r["doc_id"]: (r["component_id"], r["n_links"]) for r in out.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    moved = shuffled(spark) - before
    assert got == {i: (i - i % 4, 3) for i in range(240)}
    sets = 8 * 240 * 1500
    left = sum(f.stat().st_size for f in set(home.rglob("*.parquet")) - there)
    assert moved < 3.5 * sets, moved / sets
    assert left < 0.1 * sets, left / sets


@pytest.mark.parametrize("slices", [64, 4096, 1 << 16, 1 << 20])
def test_hashes_of_a_slice_are_kept_exactly(slices):
    width = (1 << 40) // slices
    rng = np.random.default_rng(slices)
    for k in (0, 1, slices // 3, slices - 1):
        values = np.sort(np.r_[rng.integers(0, width, 500), np.full(70_000, width // 2), 0, width - 1] + k * width).astype(np.uint64)
        data = jaccard_join._packed(values, slices)
        assert np.array_equal(jaccard_join._unpacked(data, k, slices), values)
        assert len(data) <= 3 * len(values) + 4 * max(1, 65536 // slices)


def test_grams_that_no_other_text_has_look_shared_by_chance_no_more_than_the_sketch_has_room(spark, monkeypatch):
    # as many grams for the sketch as ten times the texts of 0.5 GB have
    monkeypatch.setattr(jaccard_join, "SKETCH_BITS", (12, 30))
    monkeypatch.setattr(jaccard_join, "sketch_bits", lambda size, bits=jaccard_join.sketch_bits: max(12, (size // 26).bit_length()))
    rng = random.Random(5)
    rows = [(i, " ".join(f"w{rng.randrange(10**9)}" for _ in range(500))) for i in range(400)]
    docs = spark.createDataFrame([*rows, (400, rows[0][1])], "doc_id long, text string")
    shared, heavy, share = jaccard_join.list_sketch(docs, 5)
    size = sum(len(t) for _, t in rows)
    assert 8 * len(shared) >= size // 26 and not any(heavy)
    assert share < 0.01 and sum(x.bit_count() for x in shared) < 0.01 * 8 * len(shared)


def test_the_sketch_follows_the_texts():
    assert [jaccard_join.sketch_bits(n) for n in (0, 864 * 10**6, 6_910 * 10**6, 10_400 * 10**6, 10**13)] == [26, 26, 28, 29, 30]
    most = [n / 13 / (1 << jaccard_join.sketch_bits(n)) for n in range(10**9, 25 * 10**9, 10**9)]
    assert max(most) <= 2  # counted grams for each bit
