"""Connected components of documents: star contraction over their numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import components


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the least node reachable, for each node of an edge between two different nodes, as numbers. Null ends and loops are ignored; no edges give an empty table."""
    return components.connected_components(edges.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b")))
