"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quire.session import materialize


def _nearest(links: DataFrame) -> DataFrame:
    """Stored, so that the join with it is one of two shuffles, whose hot keys AQE can split."""
    return materialize(links.groupBy("a").agg(F.min("b").alias("least")), "nearest")


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b), root the smallest node it is connected with.

    Large-star and small-star steps in turn (Kiveris et al., 2014): each node's
    larger neighbours are linked to the smallest node around it, then its smaller
    ones, until nothing changes, which takes a few rounds even for long chains.
    Neighbourhoods are never gathered: a step is a minimum and a join, whose hot
    keys AQE splits.  Each round is written out; nothing comes to the driver but
    a checksum.  Self-links and repeated links do no harm; no links give no rows.
    """
    pairs = links.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    star = materialize(pairs.distinct(), "links")
    seen = None
    while True:
        both = star.unionByName(star.select(F.col("b").alias("a"), F.col("a").alias("b")))
        around = _nearest(both).withColumn("least", F.least("a", "least"))
        large = both.join(around, "a").filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        large = materialize(large.distinct(), "large-star")
        smallest = _nearest(large)
        small = large.join(smallest, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).filter("a != b")
        star = materialize(
            small.unionByName(smallest.select("a", F.col("least").alias("b"))).distinct(), "small-star"
        )
        check = star.agg(
            F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))
        ).first()
        if check == seen:
            break
        seen = check
    return star.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        star.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
