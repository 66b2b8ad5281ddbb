"""tripflow: layered (bronze / silver / gold) trip-record analytics on Spark.

Every operator is a DataFrame-in / DataFrame-out function built from
built-in Spark SQL expressions, so Catalyst can push filters into the
Parquet scan, prune columns and run partial (map-side) aggregation.
Column names, rules and measures are parameters; the trip-data defaults
live in :mod:`tripflow.plans.specs`.
"""

from tripflow.session import get_session, scratch_path

__all__ = ["get_session", "scratch_path"]
