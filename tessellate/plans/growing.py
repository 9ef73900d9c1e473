"""Queries over tables that grow: features, labels and counts of missing values that are
built in three batches, as sessions come in, and equal those built at once (A3, A9, F22, F24)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import labels as L
from ..operators import rolling as R
from ..sources import builds as B
from ..sources.store import TableSpec, upsert
from .base import PANEL, calendar, gate, panel, parts, query, sql_rounded
from .labelling import _LABELS, H, in_base, limited
from .metrics import _root

KEY = ["entity", "session"]
#: Where the batches end; the last takes all that is left.
CUTS = ("1998-06-30", "1999-12-31", "9999-12-31")
FEATURES = ("ret_1d", "ret_4", "realized_vol_13", "ma_ratio_4", "dist_high_13")
SOURCE = TableSpec("panel", ("entity", "session"))
FEATURE_TABLE = TableSpec("features", ("entity", "session"))
LABEL_TABLE = TableSpec("labels", ("entity", "session", "horizon"))
PARTIALS = TableSpec("missing", ("day", "feature"), "day")


def features_of(rows):
    """The features of a stretch of the panel, over 4 and 13 sessions."""
    return R.feature_frame(rows, (4, 13)).select(*KEY, *FEATURES)


def labels_of(rows):
    """Labels of a stretch of the panel with its limits: they come from the last known close, however
    far back, so they are stored with the source and not made of the stretch."""
    return L.forward_labels(in_base(rows), H).select(*KEY, "horizon", "entry_session", "exit_session", "reason", "future_excess_ret", "label_quantile")


def grown(spark, sf, name, each, source=panel):
    """Feeds the panel (or source) to a store in batches, and calls each(root, calendar) after each."""
    root, rows, cal = _root(spark, name), source(spark, sf), calendar(spark, sf)
    since = "1900-01-01"
    for until in CUTS:
        upsert(spark, root, SOURCE, rows.where((F.col("session") > F.to_date(F.lit(since))) & (F.col("session") <= F.to_date(F.lit(until)))), parts(spark, sf))
        each(root, cal)
        since = until
    return root


_FULL = f"SELECT *, exp({gate('sum', 'ln(1 + ret_1d)', 4)}) - 1 AS ret_4, {gate('stddev_samp', 'ret_1d', 13)} AS realized_vol_13, close / ({gate('avg', 'close', 4)}) AS ma_ratio_4, close / ({gate('max', 'high', 13)}) - 1 AS dist_high_13 FROM rets"


@query("f22_incremental_features", sql_rounded(_FULL, "entity, session", list(FEATURES)))
def incremental_features(spark, sf):
    root = grown(spark, sf, "features", lambda root, cal: B.extend(spark, root, SOURCE, FEATURE_TABLE, cal, features_of, 5, 20, parts(spark, sf)))
    return FEATURE_TABLE.read(spark, root).select(*KEY, *FEATURES)


@query("f24_missing_partials", f"{PANEL}, x AS ({_FULL}) " + " UNION ALL ".join(f"SELECT '{f}' AS feature, round(avg(CAST({f} IS NULL AS INTEGER)), 6) AS missing_ratio FROM x" for f in FEATURES))
def missing_partials(spark, sf):
    def each(root, cal):
        since = B.extend(spark, root, SOURCE, FEATURE_TABLE, cal, features_of, 5, 20, parts(spark, sf))
        B.update_missing_counts(spark, root, FEATURE_TABLE, PARTIALS, FEATURES, since)

    return B.missing_ratios_of(PARTIALS.read(spark, grown(spark, sf, "missing", each)))


@query("h01_incremental_labels", f"{PANEL}, {_LABELS} SELECT entity, session, horizon, entry_session, exit_session, reason, round(future_excess_ret, 6) AS future_excess_ret, label_quantile FROM labels")
def incremental_labels(spark, sf):
    root = grown(spark, sf, "labels", lambda root, cal: B.extend(spark, root, SOURCE, LABEL_TABLE, cal, labels_of, 2 + max(H), 2, parts(spark, sf)), limited)
    return LABEL_TABLE.read(spark, root).drop("year", "month")
