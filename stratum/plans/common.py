"""Shared plumbing for plans: table access and output presentation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from stratum.sources.tables import read_table


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, sf_dir, name)


def present(df: DataFrame) -> DataFrame:
    """Final projection for reports: decimals as double (exact for 2-scale
    money up to 2^53 cents), everything else unchanged."""
    cols = [F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, DecimalType)
            else F.col(f.name) for f in df.schema.fields]
    return df.select(*cols)
