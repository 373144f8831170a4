"""Conform heterogeneous sources to one typed schema (PRJ1-PRJ5, SET1)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, DateType, IntegerType, StringType,
                               StructField, StructType)

from stratum.functions.money import AMOUNT

# The conformed claim grain, column order as published.
CLAIM_SCHEMA = StructType([
    StructField("source_system", StringType()),
    StructField("policy_number", StringType()),
    StructField("incident_date", DateType()),
    StructField("incident_date_is_synthetic", BooleanType()),
    StructField("claim_type", StringType()),
    StructField("severity", StringType()),
    StructField("total_claim_amount", AMOUNT),
    StructField("injury_claim", AMOUNT),
    StructField("property_claim", AMOUNT),
    StructField("vehicle_claim", AMOUNT),
    StructField("auto_make", StringType()),
    StructField("auto_model", StringType()),
    StructField("auto_year", IntegerType()),
    StructField("fraud", BooleanType()),
    StructField("insured_zip", StringType()),
    StructField("incident_location", StringType()),
    StructField("policyholder_age", IntegerType()),
    StructField("policyholder_sex", StringType()),
    StructField("fault", StringType()),
    StructField("vehicle_category", StringType()),
])

# Fields whose content defines one claim (hash input, in order).
CLAIM_KEY_FIELDS = ("source_system", "policy_number", "incident_date",
                    "total_claim_amount", "auto_make", "incident_location",
                    "policyholder_age", "fault", "severity")


def conform(df: DataFrame, mapping: Mapping[str, Column | str | None],
            schema: StructType, constants: Mapping[str, object] | None = None
            ) -> DataFrame:
    """Project ``df`` onto ``schema``.

    ``mapping`` gives, per target column, a Column, a source column name, or
    ``None`` (typed NULL padding).  Columns absent from both ``mapping`` and
    ``constants`` are NULL-padded too.  Every value is ``try_cast`` to the
    target type, so a bad source value becomes NULL instead of failing the
    job under ANSI mode.
    """
    constants = dict(constants or {})
    out = []
    for field in schema.fields:
        if field.name in constants:
            expr = F.lit(constants[field.name])
        else:
            src = mapping.get(field.name)
            if src is None:
                expr = F.lit(None)
            elif isinstance(src, str):
                expr = F.col(src)
            else:
                expr = src
        out.append(expr.try_cast(field.dataType).alias(field.name))
    return df.select(*out)


def union_conformed(*frames: DataFrame) -> DataFrame:
    """Union by name; every frame must already carry the same schema."""
    result = frames[0]
    for f in frames[1:]:
        result = result.unionByName(f)
    return result


def cast_failures(raw_typed: Mapping[str, tuple[Column, Column]]) -> Column:
    """``bad_<col>`` reasons: raw value present but the typed value is NULL."""
    return F.concat_ws("; ", *[
        F.when(raw.isNotNull() & (F.trim(raw.cast("string")) != "") & typed.isNull(),
               F.lit(f"bad_{name}"))
        for name, (raw, typed) in raw_typed.items()])
