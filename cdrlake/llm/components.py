"""Connected components of an edge table by alternating large and small stars.

Every round groups edges by node and joins with the minimum of its neighbours, so no
task ever holds a component.  The number of rounds grows with the logarithm of the
longest path.  Each round ends in a checkpoint in the shared folder.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shared_dir


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Edges (a, b), a > b, turned to the smallest neighbour: of all neighbours, or of the smaller ones only."""
    own = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        own = own.union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = own.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    turned = own.join(least, "u")
    if large:
        turned = turned.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        turned = turned.select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return turned.filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the edges (a, b) of long ids; root is the smallest node of the component."""
    shared_dir(edges.sparkSession)
    ordered = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now, before = ordered.checkpoint(), None
    while True:
        state = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("s")).first()
        if state == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state
        now = _star(_star(now, True), False).checkpoint()
