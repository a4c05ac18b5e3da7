"""Connected components over a table of links, by alternating stars (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terracell.llm.shared import discard, share_join, written


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of links (a, b); component is the smallest node reachable.

    Each round moves links to the smallest neighbour: the large star turns a
    node's larger neighbours, the small star its smaller ones. Both are one
    aggregation and one join over links; no component is gathered anywhere,
    and the links of a hub are not gathered on its key. Each round's links are
    written to the shared folder, and the round before goes. Loops, repeated
    links and links with a null end do no harm; an empty table gives an empty
    one.
    """
    named = links.filter(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
    edges = written(named.select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low")).distinct(), "links")
    count = edges.count()
    while True:
        both = edges.select(F.col("high").alias("node"), F.col("low").alias("other")).unionByName(edges.select(F.col("low").alias("node"), F.col("high").alias("other")))
        least = both.groupBy("node").agg(F.min("other").alias("least"), F.count(F.lit(1)).alias("weight")).select("node", F.least("node", "least").alias("root"), "weight")
        large = share_join(both.filter(F.col("other") > F.col("node")), least, ["node"], 2 * count).select(F.col("other").alias("high"), F.col("root").alias("low"))
        large = written(large.distinct(), "large-star")
        root = large.groupBy("high").agg(F.min("low").alias("root"), F.count(F.lit(1)).alias("weight")).withColumnRenamed("high", "node")
        turned = share_join(large.withColumnRenamed("high", "node"), root, ["node"], 2 * count)
        small = turned.select(F.greatest("low", "root").alias("high"), F.least("low", "root").alias("low")).unionByName(root.select(F.col("node").alias("high"), F.col("root").alias("low")))
        after = written(small.filter(F.col("high") != F.col("low")).distinct(), "small-star")
        more = after.count()
        same = more == count and after.join(edges, ["high", "low"], "left_anti").isEmpty()
        discard(large, edges)
        edges, count = after, more
        if same:
            break
    roots = edges.select("low").distinct().join(edges.select(F.col("high").alias("low")), "low", "left_anti")
    found = edges.groupBy("high").agg(F.min("low").alias("component")).select(F.col("high").alias("node"), "component").unionByName(roots.select(F.col("low").alias("node"), F.col("low").alias("component")))
    found = written(found, "components")
    discard(edges)
    return found
