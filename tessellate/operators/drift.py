"""Distribution drift: population stability, Kolmogorov-Smirnov, concentration."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import finite, place_in


def value_counts(rows: DataFrame, by: Sequence[str], x: str) -> DataFrame:
    """(by, value, n): how often each group has each value; what isn't finite is null."""
    return rows.groupBy(*by, finite(x).alias("value")).agg(F.count(F.lit(1)).alias("n"))


def _ranged(counts: DataFrame, by: Sequence[str], ranges: int) -> DataFrame:
    """counts without missing values, with `range`: each group cut into about as many
    ranges of values of like size, so that no group is put in order by one task. The cuts, a row for each
    group, are sent to all tasks: a join by group would bring a group's values into one."""
    real = counts.where("value IS NOT NULL")
    at = F.array(*[F.lit(i / ranges) for i in range(1, max(ranges, 2))])
    cuts = real.groupBy(*by).agg(F.percentile_approx("value", at, F.lit(max(1000, 10 * ranges))).alias("_cuts"))
    return real.join(F.broadcast(cuts), list(by)).withColumn("range", place_in("_cuts", "value", ranges)).drop("_cuts")


def _before(ranged: DataFrame, by: Sequence[str], n: str, name: str) -> DataFrame:
    """(by, range): the sum of n in a group's earlier ranges, and in all of them (name_all)."""
    totals = ranged.groupBy(*by, "range").agg(F.sum(n).alias("_t"))
    w = Window.partitionBy(*by)
    earlier = F.sum("_t").over(w.orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    return totals.select(*by, "range", F.coalesce(earlier, F.lit(0)).alias(name), F.sum("_t").over(w).alias(f"{name}_all"))


def _parts(df: DataFrame, ranges: int | None) -> int:
    return ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def exact_edges(counts: DataFrame, by: Sequence[str], bins: int, ranges: int | None = None) -> DataFrame:
    """K1: from value counts, the inner edges of equal-frequency bins (quantiles between
    the two nearest values), each once; none where a group has no value. The wanted ranks lie in a few ranges of values; counts before
    a range and inside it say which values hold them."""
    ranged = _ranged(counts, by, _parts(counts, ranges))
    placed = ranged.join(F.broadcast(_before(ranged, by, "n", "_b")), [*by, "range"])
    inside = Window.partitionBy(*by, "range").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("_below", F.col("_b") + F.coalesce(F.sum("n").over(inside), F.lit(0)))
    at = [(F.col("_b_all") - 1) * F.lit(i / bins) for i in range(1, bins)]
    ranks = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(side).alias("side"), rank(h).cast("long").alias("rank"), h.alias("h")) for i, h in enumerate(at) for side, rank in (("lo", F.floor), ("hi", F.ceil))])
    held = F.filter(ranks, lambda r: (r["rank"] >= F.col("_below")) & (r["rank"] < F.col("_below") + F.col("n")))
    hits = placed.select(*by, "value", F.explode(held).alias("r"))
    pick = lambda side: F.max(F.when(F.col("r.side") == side, F.col("value")))
    one = hits.groupBy(*by, F.col("r.i").alias("i")).agg(pick("lo").alias("lo"), pick("hi").alias("hi"), F.max("r.h").alias("h"))
    between = F.when(F.col("lo") == F.col("hi"), F.col("lo")).otherwise((F.ceil("h") - F.col("h")) * F.col("lo") + (F.col("h") - F.floor("h")) * F.col("hi"))
    found = one.groupBy(*by).agg(F.array_distinct(F.sort_array(F.collect_list(between))).alias("edges"))
    return counts.select(*by).distinct().join(found, list(by), "left").withColumn("edges", F.coalesce("edges", F.array().cast("array<double>")))


def psi(reference: DataFrame, current: DataFrame, edges: DataFrame, by: Sequence[str], period: str, bins: int, epsilon: float = 1e-6) -> DataFrame:
    """K2: population stability index of each group and period against the reference, from
    value counts. A value's bin is the number of edges at or below it; missing values are a
    bin of their own, and shares are at least epsilon. Both sides are binned in one pass, and what is compared is a
    row of counts by bin for each group and period."""
    none = F.lit(None).cast(dict(current.dtypes)[period])
    both = reference.select(*by, "value", "n", F.lit(True).alias("_ref"), none.alias(period)).unionByName(current.select(*by, "value", "n", F.lit(False).alias("_ref"), period))
    told = both.join(F.broadcast(edges), list(by)).withColumn("bin", F.when(F.col("value").isNull(), F.lit(-1)).otherwise(place_in("edges", "value", bins)))
    counts = told.groupBy(*by, "_ref", period, "bin").agg(F.sum("n").alias("n"), F.max(F.size("edges")).alias("_last"))
    rows = counts.groupBy(*by, "_ref", period).agg(F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("m"), F.sum("n").alias("_all"), F.max("_last").alias("_last"))
    ref = rows.where("_ref").select(*by, F.col("m").alias("r"), F.col("_all").alias("r_all"))
    one = rows.where("NOT _ref").withColumnsRenamed({"m": "c", "_all": "c_all"}).join(ref, list(by))
    share = lambda side, i: F.greatest(F.coalesce(F.try_element_at(side, i), F.lit(0)) / F.col(f"{side}_all"), F.lit(epsilon))
    terms = F.transform(F.sequence(F.lit(-1), F.col("_last")), lambda i: (share("c", i) - share("r", i)) * F.ln(share("c", i) / share("r", i)))
    return one.select(*by, period, F.aggregate(terms, F.lit(0.0), lambda s, x: s + x).alias("psi"))


def ks(reference: DataFrame, current: DataFrame, by: Sequence[str], period: str, ranges: int | None = None) -> DataFrame:
    """K3: the largest distance between the two distribution functions of each group and
    period, from value counts; null where the reference has no value.

    The distance is largest at one of the period's own values or just before it, so
    the reference is put in order once with the values of all periods, not once for each."""
    none = F.lit(0).cast("long")
    ref = reference.select(*by, "value", F.col("n").alias("r"), F.lit(None).cast(dict(current.dtypes)[period]).alias(period), none.alias("c"))
    both = ref.unionByName(current.select(*by, "value", none.alias("r"), period, F.col("n").alias("c")))
    ranged = _ranged(both, by, _parts(both, ranges))
    totals = ranged.groupBy(*by, "range", period).agg(F.sum("r").alias("r"), F.sum("c").alias("c"))
    w = Window.partitionBy(*by, "range")
    upto = F.sum("r").over(w.orderBy("value").rangeBetween(Window.unboundedPreceding, 0))
    equal = F.sum("r").over(Window.partitionBy(*by, "range", "value"))
    own = F.sum("c").over(Window.partitionBy(*by, "range", period).orderBy("value").rowsBetween(Window.unboundedPreceding, 0))
    run = ranged.withColumns({"_r": upto, "_re": equal, "_c": own}).where("c > 0")
    run = run.join(F.broadcast(_before(totals, by, "r", "_rb")), [*by, "range"]).join(F.broadcast(_before(totals.where("c > 0"), [*by, period], "c", "_cb")), [*by, period, "range"])
    share = lambda part, before: (F.col(before) + part) / F.col(f"{before}_all")
    r, c, left = F.col("_r"), F.col("_c"), F.when(F.col("_rb_all") > 0, F.lit(True))
    gap = F.greatest(F.abs(share(c, "_cb") - share(r, "_rb")), F.abs(share(c - F.col("c"), "_cb") - share(r - F.col("_re"), "_rb")))
    return run.groupBy(*by, period).agg(F.max(F.when(left, gap)).alias("ks"))


def drawn(rows: DataFrame, by: Sequence[str], most: int, key: Sequence[str]) -> DataFrame:
    """About `most` rows of each group by a hash of key, all rows of smaller groups."""
    space = 1 << 30
    sizes = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("_size"))
    kept = F.pmod(F.xxhash64(*key), F.lit(space)) < F.lit(float(most)) / F.col("_size") * space
    return rows.join(sizes, list(by)).where((F.col("_size") <= most) | kept).drop("_size")


def feature_drift(reference: DataFrame, current: DataFrame, by: Sequence[str], period: str, x: str, bins: int = 10, key: Sequence[str] = ("entity", "session"), most_reference: int | None = None, most_current: int | None = None, ranges: int | None = None) -> DataFrame:
    """K4, K5: coverage, PSI and KS of each group and period, exact on all rows: reference and
    current are each read once, as value counts, and all else is made of these.

    With most_reference or most_current, PSI and KS are of about as many rows of a group's reference or of each of
    its periods, drawn by a hash of key; coverage is of all rows still."""
    ref = value_counts(drawn(reference, by, most_reference, key) if most_reference else reference, by, x)
    every = value_counts(current, [*by, period], x)
    cur = value_counts(drawn(current, [*by, period], most_current, key), [*by, period], x) if most_current else every
    there = F.sum(F.when(F.col("value").isNotNull(), F.col("n")).otherwise(0))
    cover = every.groupBy(*by, period).agg((there / F.sum("n")).alias("coverage"), F.sum("n").alias("n"))
    edges = exact_edges(ref, by, bins, ranges)
    return cover.join(psi(ref, cur, edges, by, period, bins), [*by, period], "left").join(ks(ref, cur, by, period, ranges), [*by, period], "left")


def first_periods(rows: DataFrame, period: str, n: int) -> DataFrame:
    """K5: the rows of the first n periods, the reference of a score's drift."""
    first = rows.select(period).distinct().orderBy(period).limit(n)
    return rows.join(F.broadcast(first), period, "left_semi")


def response_drift(ic: DataFrame, reference_ic: DataFrame) -> DataFrame:
    """K7: of mean rank ICs (feature, period, rank_ic) and the reference's (feature,
    reference_rank_ic): whether the sign has changed. A mean that is zero or missing has
    none; means are rounded to nine places first."""
    sign = lambda c: F.signum(F.round(c, 9))
    both = ic.join(reference_ic, "feature", "left")
    return both.withColumn("ic_sign_change", F.coalesce(sign("rank_ic") * sign("reference_rank_ic") < 0, F.lit(False)))


def severity_counts(drift: DataFrame) -> DataFrame:
    """K8: how many (feature, period) are of each severity."""
    return drift.groupBy("severity").agg(F.count(F.lit(1)).alias("n"))


def worst_features(drift: DataFrame, n: int) -> DataFrame:
    """K8: the n features with the largest PSI of any period, and that period; of periods that
    are equal to nine places the first."""
    at = F.when(F.col("psi").isNotNull(), F.struct(-F.round("psi", 9), F.col("month")))
    worst = drift.groupBy("feature").agg(F.max("psi").alias("max_psi"), F.min_by("month", at).alias("month"))
    return worst.orderBy(F.desc("max_psi"), "feature").limit(n)


def score_profile(rows: DataFrame, period: str, score: str) -> DataFrame:
    """Mean, deviation, percentiles and the share of distinct values."""
    at = (0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99)
    out = rows.groupBy(period).agg(F.avg(score).alias("mean"), F.stddev_pop(score).alias("std"), F.percentile(score, F.array(*[F.lit(p) for p in at])).alias("_q"), F.count(score).alias("n"), F.countDistinct(score).alias("u"))
    return out.select(period, "mean", "std", *[F.get("_q", F.lit(i)).alias(f"p{round(p * 100):02d}") for i, p in enumerate(at)], (F.get("_q", F.lit(5)) - F.get("_q", F.lit(1))).alias("spread"), (F.col("u") / F.col("n")).alias("unique_ratio"))


def concentration(rows: DataFrame, score: str = "score") -> DataFrame:
    """K6: a session's softmax weights: the mass of its top 10 %, the effective
    number of entities, and the best score over the median."""
    w = Window.partitionBy("session")
    e = rows.where(F.col(score).isNotNull()).withColumn("_e", F.exp(F.col(score) - F.max(score).over(w)))
    e = e.withColumns({"_w": F.col("_e") / F.sum("_e").over(w), "_r": F.row_number().over(w.orderBy(F.desc(score), "entity")), "_n": F.count(F.lit(1)).over(w)})
    mass = lambda f: F.sum(F.when(F.col("_r") <= F.greatest(F.lit(1), F.ceil(F.col("_n") * f)), F.col("_w")).otherwise(0.0))
    return e.groupBy("session").agg(mass(0.01).alias("top_1_mass"), mass(0.1).alias("top_10_mass"), (1 / F.sum(F.col("_w") * F.col("_w"))).alias("breadth"), (F.max(score) - F.percentile(score, F.lit(0.5))).alias("top_over_median"))


def severity(x: Column, moderate: float = 0.1, severe: float = 0.25) -> Column:
    """K8: the class of a stability index."""
    return F.when(x >= severe, "severe").when(x >= moderate, "moderate").when(x.isNotNull(), "stable")
