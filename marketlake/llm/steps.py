"""Results of steps in the shared folder, and components of a graph of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import new_folder, stored
from ..sources.paths import delete


class Steps:
    """Writes frames to the shared folder, from where lost executors don't matter, and deletes them."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.paths = spark, []

    def keep(self, df: DataFrame) -> DataFrame:
        self.paths.append(new_folder(self.spark, "step"))
        return stored(df, self.paths[-1])

    def drop_from(self, first: int, but_last: bool = False) -> None:
        """Delete what was kept since ``len(paths)`` was ``first``."""
        last = len(self.paths) - but_last
        for path in self.paths[first:last]:
            delete(self.spark, path)
        del self.paths[first:last]


def components(links: DataFrame, steps: Steps) -> DataFrame:
    """``node, root`` of all nodes in ``links`` (a, b); a root is the smallest node reached.

    Each round hooks every root to its smallest neighbour, shortens the chains to a quarter by two pointer
    jumps and contracts the links, so the rounds grow with the logarithm of the longest path.
    """
    tasks = 2 * steps.spark.sparkContext.defaultParallelism
    keep = lambda df: steps.keep(df.coalesce(tasks))  # noqa: E731  small steps: a few tasks write them
    start = len(steps.paths)
    named = links.select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low"))
    edges = keep(named.where("high <> low").distinct())
    nodes = edges.select(F.explode(F.array("high", "low")).alias("node")).distinct()
    roots = nodes.withColumn("root", F.col("node"))
    while not edges.isEmpty():
        hooks = keep(edges.groupBy("high").agg(F.min("low").alias("to")))
        for _ in range(2):
            on = hooks.select(F.col("high").alias("to"), F.col("to").alias("further"))
            hooks = hooks.join(on, "to", "left").select("high", F.coalesce("further", "to").alias("to"))
        hooks = keep(hooks)
        name = lambda df, column: df.join(
            hooks.select(F.col("high").alias(column), F.col("to").alias("_to")), column, "left"
        ).withColumn(column, F.coalesce("_to", column)).drop("_to")
        roots = keep(name(roots, "root"))
        edges = name(name(edges, "high"), "low").where("high <> low")
        edges = keep(edges.select(F.greatest("high", "low").alias("high"), F.least("high", "low").alias("low")).distinct())
    final = keep(roots.select("node", "root"))
    steps.drop_from(start, but_last=True)
    return final
