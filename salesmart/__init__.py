"""salesmart — a PySpark-native retail sales pipeline.

Landing CSV files are cleaned into typed, partitioned staging tables, joined
into one wide sales table without losing rows, and summarised into a fixed set
of reports and data-quality checks. Every transform is a ``DataFrame ->
DataFrame`` function built from Spark SQL expressions; only the sinks, the
landing intake and the pipeline run jobs.
"""

from salesmart.session import get_session, scratch_path

__all__ = ["get_session", "scratch_path"]
