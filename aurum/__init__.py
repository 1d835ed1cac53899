"""aurum: a bronze/silver/gold analytics library written as plain PySpark.

Every operator is a function ``DataFrame -> DataFrame`` (or a small
writer at the edge) built from Spark SQL built-ins, so Catalyst sees the
whole plan: filters reach the Parquet scan, columns are pruned, and joins
and aggregations pick their physical strategy at run time (AQE).
"""

from aurum.config import DomainConfig, LITERACY

__all__ = ["DomainConfig", "LITERACY"]
__version__ = "0.1.0"
