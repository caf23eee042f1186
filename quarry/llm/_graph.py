"""Connected components of a link table, as Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm._common import materialize


LINKS_PER_TASK = 200_000


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node each node of ``links`` reaches.

    Every round each node takes the node of the least hash among itself and its neighbours (a grouped
    min with map-side combine, so a hub costs one row per task), and the links are contracted to the
    nodes taken. The hash is salted anew every second round, so a constant share of the nodes that
    still have links is expected to go, whatever the shape and the order of ids: rounds grow with
    the logarithm of the nodes. They end when no link is left. The unsalted rounds settle stars.
    The maps of the rounds, each smaller than the one before, are then put together from the last
    to the first. Links and maps are written to the shared folder after every round, in partitions
    by the number of links; only a count of links reaches the driver.
    """
    both = links.select(F.col(a).alias("src"), F.col(b).alias("dst"))
    both = both.unionByName(both.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    both = materialize(both.filter("src <> dst").distinct(), "links")
    left = both.count()
    parts = left // LINKS_PER_TASK + 1   # a small graph needs no shuffle

    def kept(df: DataFrame, label: str) -> DataFrame:
        return materialize(df, label).coalesce(parts)

    both = both.coalesce(parts)
    maps = []
    while left or not maps:
        salt = len(maps) // 2
        rank = lambda c: F.struct(F.xxhash64(F.col(c), F.lit(salt)).alias("hash"), F.col(c).alias("at"))
        taken = kept(both.groupBy("src").agg(F.min(rank("dst")).alias("m"))
                     .select(F.col("src").alias("node"), F.least(rank("src"), "m")["at"].alias("to")), "taken")
        maps.append(taken)
        ends = [taken.select(F.col("node").alias(x), F.col("to").alias(f"{x}_to")) for x in ("src", "dst")]
        both = kept(both.join(ends[0], "src").join(ends[1], "dst").filter("src_to <> dst_to")
                    .select(F.col("src_to").alias("src"), F.col("dst_to").alias("dst")).distinct(), "links")
        left = both.limit(1).count()
    whole = maps.pop()
    while maps:
        far = whole.select(F.col("node").alias("via"), F.col("to").alias("far"))
        near = maps.pop()
        whole = kept(near.join(far, near["to"] == far["via"], "left").select("node", F.coalesce("far", "to").alias("to")), "taken")
    least = whole.groupBy("to").agg(F.min("node").alias("component"))
    return kept(whole.join(least, "to").select("node", "component"), "labels")
