"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..staging import Staging
from .common import BROADCAST_BYTES

#: Rounds after which a graph that still changes is an error; they grow with log(nodes).
MOST_ROUNDS = 60


def _large_star(links: DataFrame) -> DataFrame:
    """Every node hangs its larger neighbours on its smallest one."""
    both = links.union(links.select("b", "a")).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return (
        both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    )


def _small_star(links: DataFrame) -> DataFrame:
    """Every node hangs itself and its smaller neighbours on its smallest one."""
    down = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where(F.col("v") != F.col("m")).select("v", "m")
    return moved.union(least.select("u", "m")).toDF("a", "b")


def _round(links: DataFrame) -> DataFrame:
    return _small_star(_large_star(links))


def _broadcast_round(links: DataFrame, least: DataFrame, staging: Staging, name: str) -> DataFrame:
    """As :func:`_round` for links with a > b, where ``least`` (u, m) may be sent whole: no shuffle joins."""
    hung = links.join(F.broadcast(least.select(F.col("u").alias("b"), "m")), "b")
    hung = hung.select(F.col("a").alias("u"), F.least("b", "m").alias("v"))
    # No longer than the other: only nodes that have a smaller one.
    smaller = staging.write(hung.groupBy("u").agg(F.min("v").alias("m")), f"{name}-smaller")
    moved = hung.join(F.broadcast(smaller), "u").where(F.col("v") != F.col("m")).select("v", "m")
    return staging.write(moved, f"{name}-moved").union(smaller.select("u", "m")).toDF("a", "b")


def components(links: DataFrame, staging: Staging, name: str = "links") -> DataFrame:
    """``node`` and ``component``, the smallest node it can reach, of every linked node: a stored table.

    ``links`` has integer columns a and b. Alternating large-star and small-star rounds; each
    is stored in the shared folder, so lineage stays short and no link reaches the driver. No step
    makes more links than it gets, and repeated ones are one when no more is moved: they need no
    shuffle of their own to be dropped. Before each round the nodes' least and greatest neighbours
    are taken: where no node has a smaller neighbour beside another one, all links are stars and the
    least neighbours the answer. If these are counted small, the round sends them whole.
    """
    clean = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    current = staging.write(clean, f"{name}-0")
    for n in range(1, MOST_ROUNDS):
        both = current.union(current.select("b", "a")).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.max("v").alias("most"))
        least = staging.write(least, f"{name}-{n}-least")
        between = (F.col("m") < F.col("u")) & (F.col("m") < F.col("most"))
        nodes, unsettled = least.agg(F.count("*"), F.count_if(between)).first()
        if not unsettled:
            return least.select(F.col("u").alias("node"), F.least("u", "m").alias("component"))
        if 32 * nodes <= BROADCAST_BYTES:
            current = _broadcast_round(current, least, staging, f"{name}-{n}")
        else:
            current = staging.write(_round(current), f"{name}-{n}")
    raise RuntimeError(f"components still change after {MOST_ROUNDS} rounds")
