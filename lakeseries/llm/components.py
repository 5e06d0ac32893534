"""Connected components of a table of links."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeseries.llm.stores import stored


def components(links: DataFrame) -> DataFrame:
    """``node``, ``root`` for every node of ``links`` (``a``, ``b``): the least node it reaches.

    Each round hooks every tree under the least root next to it and then halves
    the depth of all trees, so rounds grow with the logarithm of the longest
    path. A round is a written table, which cuts the lineage.
    """
    links = stored(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                   .where("a < b").distinct(), "links")
    trees = stored(
        links.select(F.col("b").alias("node"), F.col("a").alias("root"))
        .groupBy("node").agg(F.min("root").alias("root"))
        .union(links.select("a", "a")).groupBy("node").agg(F.min("root").alias("root")),
        "trees",
    )
    while True:
        # Point every node at its root's root.
        up = trees.select(F.col("node").alias("root"), F.col("root").alias("above"))
        moved = trees.join(up, "root").select("node", F.col("above").alias("root"))
        # Hook a root under the least root that a link of its tree leads to.
        left = trees.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        right = trees.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        ends = links.join(left, "a").join(right, "b").where("ra <> rb")
        hooks = ends.select(
            F.greatest("ra", "rb").alias("node"), F.least("ra", "rb").alias("root")
        )
        after = stored(
            moved.union(hooks).groupBy("node").agg(F.min("root").alias("root")), "trees"
        )
        changed = trees.join(after.withColumnRenamed("root", "new"), "node").where("root <> new")
        trees = after
        if changed.isEmpty():
            return trees
