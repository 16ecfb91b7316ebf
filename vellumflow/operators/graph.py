"""Node and edge tables from connections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The predicates a connection may have.
PREDICATES = ["is_a", "part_of", "has_property", "related_to", "causes", "depends_on"]


def graph_nodes(connections: DataFrame) -> DataFrame:
    """Distinct nodes by id. Of several versions the first in order of its fields is kept."""
    ends = connections.select(F.explode(F.array("subject", "object")).alias("n")).where("n is not null")
    flat = ends.select("n.id", F.struct("n.label", "n.type", F.to_json("n.properties").alias("p")).alias("_v"))
    kept = flat.groupBy("id").agg(F.min("_v").alias("_v"))
    return kept.select("id", "_v.label", "_v.type", F.from_json("_v.p", "map<string,string>").alias("properties"))


def graph_edges(connections: DataFrame) -> DataFrame:
    """One row per distinct connection; other predicates are marked, not dropped."""
    return connections.select(
        F.col("subject.id").alias("src"),
        "predicate",
        F.col("object.id").alias("dst"),
        F.col("predicate").isin(PREDICATES).alias("known_predicate"),
    ).distinct()
