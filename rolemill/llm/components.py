"""Connected components of an edge table, without gathering links or components anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rolemill.session import materialize, release


def _large_star(e: DataFrame) -> DataFrame:
    both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def connected_components(edges: DataFrame, a: str, b: str, node: str = "node", component: str = "component", max_rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node of each component, for every node that has a link to another one.

    Alternating large-star and small-star steps; a round halves the distances, and its edge list is written to the
    shared folder. Loops and repeated links are ignored, links with a null end dropped. A node with very many links
    is one row of an aggregate with map-side combine, and its join is split by the adaptive skew handling.
    """
    e = materialize(edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v").distinct(), "components")
    # numbers in the order of the nodes stand for them, so that long keys aren't shuffled in every round
    names = e.select(F.explode(F.array("u", "v")).alias("name")).distinct().repartitionByRange("name").sortWithinPartitions("name")
    names = materialize(names.withColumn("id", F.monotonically_increasing_id()), "components")
    number = lambda end: names.select(F.col("name").alias(end), F.col("id").alias(f"{end}_id"))
    numbered = e.join(number("u"), "u").join(number("v"), "v").select(F.col("u_id").alias("u"), F.col("v_id").alias("v"))
    state, current = None, materialize(numbered, "components")
    for _ in range(max_rounds):
        after = materialize(_small_star(_large_star(current)), "components")
        release(current)
        current = after
        seen = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(seen) == state:
            break
        state = tuple(seen)
    else:
        raise RuntimeError("components didn't settle")
    stars = current.union(current.select(F.col("v"), F.col("v")).distinct())
    back = lambda end, to: names.select(F.col("id").alias(end), F.col("name").alias(to))
    return stars.join(back("u", node), "u").join(back("v", component), "v").select(node, component)
