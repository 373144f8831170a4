"""Federated relational sources (SRC15): queried in place through JDBC.

Reads are split into ``num_partitions`` range slices of a numeric / date
column so they run in parallel; Spark pushes filters and projections into
the remote query.  Bounds come from a pushed-down ``min/max`` query (one
tiny remote aggregate), never from pulling the table.

Not exercised in this repository's tests: that would need a database
server, which the test environment does not allow.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def jdbc_bounds(spark: SparkSession, url: str, table: str, column: str,
                props: Mapping[str, str]) -> tuple[object, object]:
    q = f"(SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}) b"
    row = spark.read.jdbc(url, q, properties=dict(props)).first()
    return row["lo"], row["hi"]


def read_jdbc(spark: SparkSession, url: str, table: str, props: Mapping[str, str],
              partition_column: str, num_partitions: int | None = None,
              fetch_size: int = 10_000) -> DataFrame:
    """Parallel JDBC scan in ``num_partitions`` slices (default: the cluster's
    task slots) of ``partition_column``."""
    opts = {**props, "fetchsize": str(fetch_size)}
    lo, hi = jdbc_bounds(spark, url, table, partition_column, props)
    if lo is None:                      # no row has a value to slice by
        return spark.read.jdbc(url, table, properties=opts)
    return spark.read.jdbc(url, table, column=partition_column, lowerBound=lo, upperBound=hi,
                           numPartitions=num_partitions or spark.sparkContext.defaultParallelism, properties=opts)
