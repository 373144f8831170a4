"""Connected components of a links table, by minimum labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.sinks import materialize


def components(links: DataFrame, name: str = "components", most: int = 200) -> DataFrame:
    """``links`` (a, b) -> ``node, comp``: the smallest node that can be
    reached.  Each round takes the smallest label among a node's neighbours and
    then the label of that label, and is written out, so no lineage grows and
    nothing but a count comes to the driver."""
    both = materialize(links.where("a <> b").select("a", "b").union(links.where("a <> b").select("b", "a"))
                       .distinct(), f"{name}_links")
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(
        F.least(F.col("node"), F.min("b")).alias("comp")), f"{name}_0")
    for k in range(1, most):
        near = (both.join(labels, both["b"] == labels["node"]).groupBy("a")
                .agg(F.min("comp").alias("_near")))
        lower = (labels.join(near, labels["node"] == near["a"])
                 .select("node", "comp", F.least("comp", "_near").alias("_low")))
        of_label = labels.select(F.col("node").alias("_low"), F.col("comp").alias("_jump"))
        step = materialize(lower.join(of_label, "_low").select(
            "node", F.least("_low", "_jump").alias("comp"),
            (F.least("_low", "_jump") < F.col("comp")).alias("_moved")), f"{name}_{k}")
        labels = step.select("node", "comp")
        if step.where("_moved").isEmpty():
            return labels
    raise RuntimeError(f"components not settled after {most} rounds")
