"""Governance on data: column tags in schema metadata, tag-driven masks,
tenant row filters (GOV1-GOV4, PRJ8)."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger(__name__)


def resolve_columns(df: DataFrame, names: Sequence[str]) -> tuple[dict[str, str], list[str]]:
    """Case-insensitive column resolution: (requested -> real name, missing)."""
    real = {c.lower(): c for c in df.columns}
    found = {n: real[n.lower()] for n in names if n.lower() in real}
    missing = [n for n in names if n.lower() not in real]
    return found, missing


def tag_columns(df: DataFrame, tags: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """Attach tags (e.g. ``{"pii": "true"}``) to columns as field metadata.
    Metadata travels with the schema into parquet and catalog tables.
    Unknown columns only log a warning."""
    found, missing = resolve_columns(df, list(tags))
    for m in missing:
        log.warning("tag skipped, column not found: %s", m)
    out = df
    for req, col in found.items():
        meta = dict(out.schema[col].metadata or {})
        meta.setdefault("tags", {}).update(dict(tags[req]))
        out = out.withMetadata(col, meta)
    return out


def column_tags(spark: SparkSession, df: DataFrame, table: str) -> DataFrame:
    """``information_schema.column_tags`` style view of a frame's tags
    (schema-sized: one row per tagged column)."""
    rows = [(table, f.name, k, str(v)) for f in df.schema.fields
            for k, v in ((f.metadata or {}).get("tags") or {}).items()]
    return spark.createDataFrame(rows, "table string, column string, tag string, value string")


def mask_value(c: Column, strategy: str, salt: str = "") -> Column:
    """One masking strategy: ``redact`` (letters/digits replaced by class
    symbols), ``hash`` (salted sha2-256 token), ``partial`` (only the last 4
    characters visible), ``band:<w>`` (numeric floor to width w), ``null``."""
    if strategy == "redact":
        return F.mask(c.cast("string"))
    if strategy == "hash":
        return F.sha2(F.concat(F.lit(salt), c.cast("string")), 256)
    if strategy == "partial":
        s = c.cast("string")
        return F.concat(F.repeat(F.lit("*"), F.greatest(F.length(s) - 4, F.lit(0))), F.right(s, F.lit(4)))
    if strategy.startswith("band:"):
        w = int(strategy.split(":", 1)[1])
        return (F.floor(c / F.lit(w)) * F.lit(w)).cast("bigint")
    if strategy == "null":
        return F.lit(None)
    raise ValueError(f"unknown mask strategy {strategy!r}")


def mask_tagged(df: DataFrame, policy: Mapping[str, str], tag: str = "pii", salt: str = "") -> DataFrame:
    """Mask every column whose ``tag`` value has a strategy in ``policy``
    (e.g. ``{"name": "hash", "balance": "band:1000"}``); others pass through."""
    cols = []
    for f in df.schema.fields:
        value = ((f.metadata or {}).get("tags") or {}).get(tag)
        if value is not None and value in policy:
            cols.append(mask_value(F.col(f.name), policy[value], salt).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def tenant_filter(df: DataFrame, entitlements: DataFrame, on: Sequence[str], principal: str,
                  principal_col: str = "principal") -> DataFrame:
    """Row filter: keep rows whose ``on`` values are entitled to ``principal``
    (``left_semi``: never duplicates rows, never adds columns)."""
    allowed = entitlements.where(F.col(principal_col) == principal).select(*on).distinct()
    return df.join(allowed, list(on), "left_semi")
