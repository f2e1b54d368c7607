"""Connected components of a table of links, by alternating large and small stars.

Links never come to the driver.  Each step is an aggregate and a join, each
written to shared storage, in as few files as its rows ask for, so a lost executor costs one step, and adaptive
execution can split the join at a star that very many links have.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import written


def _state(links: DataFrame) -> tuple[int, bool]:
    """The number of ``links`` (a over b), and whether they are stars: every node has one link down, to a node that has none."""
    ends = links.selectExpr("a AS node", "1 AS down", "0 AS up").unionByName(links.selectExpr("b AS node", "0 AS down", "1 AS up"))
    of_node = ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    row = of_node.agg(F.coalesce(F.sum("down"), F.lit(0)).alias("n"), F.count_if(F.expr("down + up > 1")).alias("more")).first()
    return row["n"], not row["more"]


def _large_star(links: DataFrame, rows: int) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = written(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least", rows)
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame, rows: int) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = written(down.groupBy("a").agg(F.min("b").alias("m")), "least", rows)
    to = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return to.unionByName(least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()


def components(links: DataFrame, rows: int | None = None) -> DataFrame:
    """(node, component): every node of ``links`` (a, b) but the least of each
    component, which names it.  Ends when the links are stars, which a further
    round would not change.  ``rows``: their number, counted if it is not given."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    links = written(down, "links", links.count() if rows is None else rows)
    n, stars = _state(links)
    while not stars:
        links = written(_large_star(links, 2 * n), "links", 2 * n)
        links = written(_small_star(links, 2 * n), "links", 2 * n)
        n, stars = _state(links)
    return links.select(F.col("a").alias("node"), F.col("b").alias("component"))


def joined_further(joined: DataFrame, links: DataFrame) -> DataFrame:
    """What ``components`` finds of its links and further ``links`` (a, b), from its
    result ``joined``: the links are carried to the components that they join."""
    heads = links.select("a", "b")
    for end in ("a", "b"):
        heads = heads.join(joined.select(F.col("node").alias(end), F.col("component").alias(f"of_{end}")), end, "left")
    over = components(heads.select(F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b")), links.count())
    moved = joined.join(over.select(F.col("node").alias("component"), F.col("component").alias("over")), "component", "left")
    moved = moved.select("node", F.coalesce("over", "component").alias("component"))
    return written(moved.unionByName(over), "components", joined.count() + over.count())
