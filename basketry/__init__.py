"""Retail purchase analytics written as Spark DataFrame jobs.

Every operator takes DataFrames and returns a DataFrame; nothing is collected on
the driver except the one-row-per-cluster and per-model facts that ``pyspark.ml``
itself keeps there.
"""

from basketry.session import build_session, configure, materialise, work_dir

__all__ = ["build_session", "configure", "materialise", "work_dir"]
