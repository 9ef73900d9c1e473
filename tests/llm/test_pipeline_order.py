"""The mixing stage's order in the pipeline's sequences."""

import random

import corpus_pipeline
from tessellate.llm.mixing import mix
from tessellate.llm.packing import pack_documents


def uneven(spark):
    rng = random.Random(5)
    rows = []
    for i in range(4000):
        # ids tell nothing of sources; one source has most rows
        source = rng.choices(["a", "b", "c"], [80, 15, 5])[0]
        text = " ".join(rng.choice(["river", "stone", "cloud", "ember"]) for _ in range(rng.randint(20, 400)))
        rows.append((i, text, "en", source, len(text)))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def test_sequences_follow_the_mixed_stream(spark, monkeypatch):
    monkeypatch.setattr(corpus_pipeline, "RANGE_ROWS", 200)
    docs = uneven(spark)
    written = corpus_pipeline.mix_sources(spark, docs, "")
    # files promise no order: the rows come back in another one
    again = spark.createDataFrame(sorted(written.collect(), key=lambda r: r["doc_id"] * 7919 % 4001), written.schema).repartition(3)
    out = corpus_pipeline.pack_sequences(spark, again, "").collect()
    source = {r["doc_id"]: r["source"] for r in docs.collect()}
    places = {r["doc_id"]: (r["place"], r["on_target"]) for r in mix(docs).collect()}
    assert {r["doc_id"] for r in out} == set(source)
    assert set(out[0].asDict()) == {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"}

    def shares(rows):
        total = {s: sum(r["length"] for r in rows if source[r["doc_id"]] == s) for s in "abc"}
        return {s: n / sum(total.values()) for s, n in total.items()}

    # ranges hold contiguous places
    spans = {}
    for r in out:
        place = places[r["doc_id"]][0]
        lo, hi = spans.get(r["sequence_id"] >> 32, (place, place))
        spans[r["sequence_id"] >> 32] = (min(lo, place), max(hi, place))
    ordered = [spans[g] for g in sorted(spans)]
    assert len(ordered) > 10
    assert all(a[1] <= b[0] for a, b in zip(ordered, ordered[1:], strict=False))
    # along the sequences, the shares are those of the mixed stream, not of the corpus
    by_sequence = sorted(out, key=lambda r: r["sequence_id"])
    by_place = sorted(out, key=lambda r: (places[r["doc_id"]][0], r["doc_id"], r["piece"]))
    for part in (0.2, 0.35, 0.5):
        n = int(part * len(out))
        got, want = shares(by_sequence[:n]), shares(by_place[:n])
        assert all(abs(got[s] - want[s]) < 0.05 for s in "abc")
    assert abs(shares(by_sequence[: len(out) // 5])["a"] - shares(out)["a"]) > 0.1


def test_ordered_packing_keeps_every_piece(spark):
    docs = uneven(spark).selectExpr("doc_id", "text", "IF(doc_id % 50 = 0, NULL, doc_id DIV 500) AS place")
    plain = pack_documents(docs).collect()
    kept = pack_documents(docs, group_rows=300, order="place").collect()
    key = lambda r: (r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"])
    assert sorted(map(key, plain)) == sorted(map(key, kept))
    own = {}
    for r in kept:
        own.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in own.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    full = sum(r["length"] for r in kept) / 1024
    assert len(own) <= 1.1 * full + len({s >> 32 for s in own})
    assert pack_documents(docs.limit(0), order="place").count() == 0
