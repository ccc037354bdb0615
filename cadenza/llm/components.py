"""Connected components of an edge table by hooking and contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import broadcast_up_to, stored, stored_counted

BROADCAST_ROWS = 200_000  # pairs of integers sent to every executor; larger tables shuffle


def counted_components(edges: DataFrame) -> tuple[DataFrame, int]:
    """``components(edges)``, stored, and its number of rows."""
    both = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    rest, of = stored_counted(edges.where("a <> b").select(F.inline(both)).distinct())
    levels = []
    while of["rows"]:
        hooked, of = stored_counted(rest.groupBy("a").agg(F.min("b").alias("b"))
                                    .select(F.col("a").alias("id"), F.least("a", "b").alias("root")))
        size, moved = of["rows"], True
        while moved:
            above = broadcast_up_to(hooked, size, BROADCAST_ROWS)
            one = above.select(F.col("id").alias("root"), F.col("root").alias("next"))
            two = above.select(F.col("id").alias("next"), F.col("root").alias("top"))
            hooked, of = stored_counted(
                hooked.join(one, "root").join(two, "next")
                .select("id", F.col("top").alias("root"), (F.col("top") != F.col("next")).alias("moved")),
                moved=F.count_if("moved"))
            hooked, moved = hooked.select("id", "root"), of["moved"]
        levels.append((hooked, size))
        left = hooked.select(F.col("id").alias("a"), F.col("root").alias("ra"))
        right = hooked.select(F.col("id").alias("b"), F.col("root").alias("rb"))
        rest, of = stored_counted(
            rest.join(broadcast_up_to(left, size, BROADCAST_ROWS), "a")
            .join(broadcast_up_to(right, size, BROADCAST_ROWS), "b").where("ra <> rb")
            .select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct())
    if not levels:
        kind = edges.schema["a"].dataType.simpleString()
        return edges.sparkSession.createDataFrame([], f"id {kind}, component {kind}"), 0
    found, size = levels[-1]
    for level, rows in reversed(levels[:-1]):
        above = found.select(F.col("id").alias("root"), F.col("root").alias("top"))
        found = stored(level.join(broadcast_up_to(above, size, BROADCAST_ROWS), "root", "left")
                       .select("id", F.coalesce("top", "root").alias("root")))
        size = rows
    return found.select("id", F.col("root").alias("component")), size


def components(edges: DataFrame) -> DataFrame:
    """``id``, ``component`` (smallest id reachable) of every vertex of ``edges`` (a, b).

    Each round hooks every vertex to its smallest neighbour, follows the hooks
    to their roots, three steps at once, and replaces the edges by those between
    different roots; the number of roots at least halves per round. Edges with
    a null end and loops are ignored. Only row counts reach the driver; joins are
    between stored tables, the smaller one broadcast up to ``BROADCAST_ROWS`` rows
    and otherwise shuffled, so that a hub is split by skew handling. Minima are
    aggregated before they shuffle.
    """
    return counted_components(edges)[0]
