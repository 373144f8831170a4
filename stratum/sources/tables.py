"""Table access by name.

A ``Catalog`` resolves logical names either to parquet files in a directory
(``{dir}/{name}.parquet``, the driver test layout) or to metastore tables
``{domain}_{layer}.{name}``.  Scans are plain ``spark.read.parquet`` so that
Catalyst prunes columns and pushes filters into the parquet reader.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from stratum.sources.files import list_tables, path_exists

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def estimated_bytes(df: DataFrame) -> int:
    """Optimizer size estimate of ``df`` (file sizes propagated through the
    plan), computed without running a job."""
    v = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(v) if isinstance(v, int) else int(v.toString())


@dataclass(frozen=True)
class Catalog:
    """Resolve ``domain.layer.name`` style names without hardcoding them."""

    root: str | None = None          # directory holding <name><suffix>
    prefix: str = ""                 # metastore database prefix
    suffix: str = ""                 # of table folders or files under root

    def fqn(self, domain: str, layer: str, name: str) -> str:
        db = f"{self.prefix}{domain}_{layer}" if domain else f"{self.prefix}{layer}"
        return f"{db}.{name}"

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}{self.suffix}"

    def read(self, spark: SparkSession, name: str, domain: str = "",
             layer: str = "") -> DataFrame:
        if self.root is not None:
            return spark.read.parquet(self.path(name))
        return spark.table(self.fqn(domain, layer, name))

    def exists(self, spark: SparkSession, name: str, domain: str = "",
               layer: str = "") -> bool:
        if self.root is not None:
            return path_exists(spark, self.path(name))
        return spark.catalog.tableExists(self.fqn(domain, layer, name))

    def tables(self, spark: SparkSession, domain: str = "", layer: str = "") -> list[str]:
        """The names it holds: a listing, no data read."""
        if self.root is not None:
            return list_tables(spark, self.root, self.suffix)
        return sorted(t.name for t in spark.catalog.listTables(self.fqn(domain, layer, "x").split(".")[0]))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one driver table (one parquet file or directory per table)."""
    return Catalog(sf_dir, suffix=".parquet").read(spark, name)
