"""stratum: a PySpark-native lakehouse engine for usage-based auto insurance.

Layers: ``sources`` (file / table / JDBC reads, bronze ingest), ``functions``
(Column-returning helpers), ``operators`` (DataFrame -> DataFrame building
blocks: conform, dedup, quality, CDC/SCD2, joins, sessions, marts,
governance, features, retrieval), ``streaming`` (Structured Streaming twins)
and ``plans`` (the operators bound to concrete tables).

Every public operator takes DataFrames plus configuration and returns a
DataFrame without running an action; only sinks, gates and streaming runners
execute jobs.
"""

__version__ = "0.1.0"
