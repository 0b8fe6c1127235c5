"""fleetpulse: per-driver statistics over fixed event-time intervals, on Spark.

Layout: ``sources`` (fixture, topic log, JSON lake), ``functions`` (instant
conversions, protobuf codec), ``operators`` (validate, project, skew filter,
windowed totals), ``plans`` (the jobs), ``streaming`` (stream runners, pane
deltas, progress reports).
"""

from .config import StatsParams, build_session, prepare_session  # noqa: F401
