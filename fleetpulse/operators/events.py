"""The wide event frame shared by every job.

One frame carries all three event types side by side, tagged by ``kind``;
fields that a kind does not have are null.  Typed inputs are unioned into it
(``widen``), a multi-topic log decodes straight into it, and the fixture builds
it from one scan.  Per-kind rules are written once as CASE-on-kind SQL
expressions: on a union of typed frames Catalyst pushes them into each branch
and folds the CASE away, on a single multi-topic frame they run in one pass
with no union at all.

Rules are kept as SQL expression text and handed to Spark whole (``F.expr``):
the plan is the same as with the Column API, and building it takes one JVM
call per expression instead of one per node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import EVENT_TIME_COLUMN, SOURCE_TS, TYPED_SCHEMA

KINDS = ("rated", "tipped", "journey")

# Column order of the wide frame (after ``kind``).
WIDE_FIELDS = ("driver_id", "rider_id", "journey_id", "rating", "rated_at", "amount",
               "tipped_at", "finish_reason", "started_at", "ended_at", "distance", "price")
WIDE_TYPES = {}
for _schema in TYPED_SCHEMA.values():
    for _f in _schema.fields:
        WIDE_TYPES[_f.name] = _f.dataType


def per_kind_sql(exprs: dict, otherwise: str | None = None) -> str:
    """CASE kind WHEN 'k' THEN exprs[k] ... [ELSE otherwise] END (SQL text)."""
    whens = " ".join(f"WHEN '{k}' THEN {e}" for k, e in exprs.items())
    tail = f" ELSE {otherwise}" if otherwise is not None else ""
    return f"CASE kind {whens}{tail} END"


def widen(frames: dict, keep: tuple = ()) -> DataFrame:
    """Union typed frames ({kind: df}) into the wide frame.

    Bag union: no distinct.  ``keep`` lists extra columns carried through
    (``source_ts`` is carried whenever present).
    """
    out = None
    for kind, df in frames.items():
        cols = [f"'{kind}' AS kind"]
        for name in WIDE_FIELDS:
            if name in df.columns:
                cols.append(f"`{name}`")
            else:
                cols.append(f"CAST(NULL AS {WIDE_TYPES[name].simpleString()}) AS {name}")
        cols += [f"`{c}`" for c in (SOURCE_TS, *keep) if c in df.columns]
        sel = df.selectExpr(*cols)
        out = sel if out is None else out.unionByName(sel, allowMissingColumns=True)
    return out


def narrow(wide: DataFrame, kind: str, keep: tuple = ()) -> DataFrame:
    """The typed frame of one kind, in its fixed column order."""
    cols = [f.name for f in TYPED_SCHEMA[kind].fields]
    extra = [c for c in (*keep, SOURCE_TS) if c in wide.columns and c not in cols]
    return wide.filter(F.col("kind") == kind).select(*extra, *cols)


def event_time_sql() -> str:
    """The time that places an event in an interval (journeys: ended_at)."""
    return per_kind_sql(dict(EVENT_TIME_COLUMN))
