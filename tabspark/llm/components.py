"""Connected components of a link table, by alternating stars.

Links lead from the larger node to the smaller one.  Large star: every link
leads on to the least node that its smaller end knows; small star: a node tells its
smaller neighbours the least of them.  Each turn is two joins and two
aggregates over the links, written to the shared folder and counted while
written; nothing is collected but a count and a checksum.  A turn never makes more links
than it was given, and those that came twice go with the next one, so none needs a shuffle for
distinct links.  The links shrink to one star per component in
a number of turns that grows with the logarithm of the largest component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tabspark.llm.common import checkpointed


def _large_star(links: DataFrame) -> DataFrame:
    """Each link (u, v) to the least smaller neighbour of v, or v itself."""
    least = links.groupBy(F.col("u").alias("v")).agg(F.min("v").alias("m"))
    return links.join(least, "v", "left").select("u", F.coalesce("m", "v").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    """Links of each node and its smaller neighbours to the least of these."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    told = links.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return told.unionByName(least.select("u", F.col("m").alias("v")))


def _written(links: DataFrame) -> tuple[DataFrame, tuple]:
    """``links`` in the shared folder, with their number and checksum."""
    seen = Observation()
    written = checkpointed(links.observe(seen, F.count(F.lit(1)).alias("links"),
                                         F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 31))).alias("checksum")))
    return written, (seen.get["links"], seen.get["checksum"])


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node of the component, for every node of ``links`` (u long, v long)."""
    links, state = _written(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where(F.col("u") != F.col("v")))
    seen = None
    while state[0] and state != seen:
        seen = state
        links, state = _written(_small_star(_large_star(links)))
    # Every node but the least of a component has one link now.
    return (links.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))
