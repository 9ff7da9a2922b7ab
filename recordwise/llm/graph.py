"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordwise.llm.files import stored


def components(links: DataFrame) -> DataFrame:
    """``node, label``: for every node of ``a, b`` the smallest node that it is connected with.

    Each round takes the smallest label of a node and its neighbours, then the label of that label,
    so paths halve; rounds are written to the shared folder, which cuts the lineage. Neighbours are
    met in merge joins, so that no round leaves a broadcast table on the driver, and reduced by partial
    aggregation; only whether anything changed comes back.
    """
    direct = stored(links.select("a", "b"), "links")  # once; both directions are read from it
    both = stored(direct.union(direct.select("b", "a")).distinct(), "links")
    labels = both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("label"))
    labels = stored(labels, "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "b").hint("merge"), "b").groupBy("a").agg(F.min("label").alias("near"))
        joined = labels.join(near.hint("merge"), labels["node"] == near["a"]).select("node", "label", F.least("label", "near").alias("best"))
        jump = labels.select(F.col("node").alias("best"), F.col("label").alias("jumped"))
        moved = joined.join(jump.hint("merge"), "best").select("node", F.least("best", "jumped").alias("label"), (F.least("best", "jumped") < F.col("label")).alias("moved"))
        moved = stored(moved, "labels")
        labels = moved.select("node", "label")
        if moved.where("moved").isEmpty():
            return labels
