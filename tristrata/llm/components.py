"""Connected components of an edge table by minimum labels and pointer jumping.

Every round is joins and sums with partial aggregation over tables of the shared folder, so
a node with very many edges is only many rows. Nothing is collected but one count a round.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tristrata.llm.storage import stored


def connected(edges: DataFrame) -> DataFrame:
    """Rows ``node, root`` for every node of ``edges`` (columns ``a, b``), root the least node.

    Repeated edges, loops and both directions are allowed; no edges give no rows.
    """
    both = stored(
        edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct(), "edges"
    )
    least = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
    labels = stored(least.select("node", F.least("node", "root").alias("root")), "labels")
    while True:
        near = (
            both.join(labels, both["a"] == labels["node"])
            .groupBy(F.col("b").alias("node"))
            .agg(F.min("root").alias("near"))
        )
        to = F.least("root", "near").alias("to")
        lower = labels.join(near, "node").select("node", "root", to)
        jump = labels.select(F.col("node").alias("to"), F.col("root").alias("onward"))
        moved = stored(
            lower.join(jump, "to").select("node", "root", F.least("to", "onward").alias("next")),
            "labels",
        )
        changed = moved.where("root <> next").limit(1).count()
        labels = moved.select("node", F.col("next").alias("root"))
        if not changed:
            return labels
