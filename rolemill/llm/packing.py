"""Filling fixed-capacity containers with items that are never split unless larger than a container.

Method: bulk-synchronous best-fit. Items are ordered by size, open containers by their gap; each superstep takes the
largest size still open, finds its successor among the gaps (the smallest gap that holds it), and places as many items
as fit into all containers of that gap at once. Conflicts, several items that want one container, are settled by rank:
the r-th item of a size goes to the r-th slot of the gap. Gaps are then updated, and the next superstep begins.

Sizes are whole numbers of at most ``capacity``, so the sweep's whole state is the number of items of each size and runs
of equal containers. The supersteps therefore run over these classes (at most ``capacity`` sizes, whatever the number of
items) on the driver, and their result is a table of rank intervals. The data itself is touched twice, by the count of
the sizes and by the placement of the ranked items through that table, both in salted groups: a size that holds a third
of all rows is spread over many tasks, and where its groups begin is a window over their counts; the driver sees a row for
every size alone. The number of intervals is about the number of sizes times the items a container
holds; it's checked before the table is broadcast, and beyond the bound it is joined by size through a shuffle.

Null or negative sizes count as 0. An item of size 0 takes no space and goes to container 0. An item larger than the
capacity is cut into full pieces, each with a container of its own, and a rest that is placed like any item. Rows with
equal keys are items of their own. Ties are broken by the key, so the result is the same on every run.
"""

from __future__ import annotations

import bisect

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rolemill.session import materialize

ROWS_PER_GROUP = 250_000
BROADCAST_INTERVALS = 200_000


class _Gaps:
    """Open containers as runs (first, count) by gap, with the gaps kept sorted."""

    def __init__(self) -> None:
        self.order: list[int] = []
        self.runs: dict[int, list[tuple[int, int]]] = {}

    def add(self, gap: int, first: int, count: int) -> None:
        if gap <= 0 or count <= 0:
            return
        if gap not in self.runs:
            bisect.insort(self.order, gap)
            self.runs[gap] = []
        runs = self.runs[gap]
        if runs and runs[-1][0] + runs[-1][1] == first:
            runs[-1] = (runs[-1][0], runs[-1][1] + count)
        else:
            runs.append((first, count))

    def successor(self, size: int) -> int | None:
        at = bisect.bisect_left(self.order, size)
        return self.order[at] if at < len(self.order) else None

    def take(self, gap: int, wanted: int) -> tuple[int, int]:
        """At most so many containers of one run."""
        runs = self.runs[gap]
        first, count = runs.pop()
        used = min(count, wanted)
        if used < count:
            runs.append((first + used, count - used))
        if not runs:
            del self.runs[gap]
            self.order.pop(bisect.bisect_left(self.order, gap))
        return first, used


def plan_best_fit(sizes: dict[int, int], capacity: int, first_container: int = 0) -> tuple[list[tuple[int, int, int, int, int, int]], int]:
    """Supersteps over size classes: (size, first rank, items, first container, items per container, gap before).

    Returns the intervals and the number of the next free container.
    """
    gaps, out, free = _Gaps(), [], first_container
    for size in sorted((s for s, n in sizes.items() if s > 0 and n > 0), reverse=True):
        rank, left = 0, sizes[size]
        while left:
            gap = gaps.successor(size)
            if gap is None:
                gap, each = capacity, capacity // size
                containers = max(1, left // each)
                first, free = free, free + containers
            else:
                each = gap // size
                first, containers = gaps.take(gap, max(1, left // each))
            if left < each:
                each = left
            items = containers * each
            out.append((size, rank, items, first, each, gap))
            gaps.add(gap - each * size, first, containers)
            rank, left = rank + items, left - items
    return out, free


def pack(df: DataFrame, id_col: str, size_col: str, capacity: int = 2048, rows_per_group: int = ROWS_PER_GROUP) -> DataFrame:
    """(id, piece, start, size, container): where every item, or every piece of one above the capacity, goes.

    piece counts from 0; start is the piece's offset within its item. Containers are numbered from 0 without a gap.
    """
    spark = df.sparkSession
    size = F.greatest(F.coalesce(F.col(size_col).cast("bigint"), F.lit(0)), F.lit(0))
    items = df.select(F.col(id_col).alias("_key"), size.alias("_n"), F.monotonically_increasing_id().alias("_row"))
    full = F.floor(F.greatest(F.col("_n") - 1, F.lit(0)) / capacity).cast("bigint")
    items = materialize(items.withColumn("_full", full).withColumn("_rest", F.col("_n") - full * capacity), "pack-items")
    n = items.agg(F.count("*"), F.sum("_full")).first()
    salts = max(1, -(-n[0] // rows_per_group))
    n_full = n[1] or 0
    items = items.withColumn("_salt", F.pmod(F.xxhash64("_key", "_row"), F.lit(salts)))
    counts = materialize(items.groupBy("_rest", "_salt").agg(F.count("*").alias("c"), F.sum("_full").alias("f")), "pack-counts")
    # a row for every size: at most capacity + 1
    classes = {r["_rest"]: r["c"] for r in counts.groupBy("_rest").agg(F.sum("c").alias("c")).collect()}
    intervals, _ = plan_best_fit(classes, capacity, n_full)
    # where every group begins: among the items of its size, and among the full pieces, salt by salt and there size by size
    earlier = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    none = lambda c: F.coalesce(c, F.lit(0).cast("bigint"))
    salted = counts.groupBy("_salt").agg(F.sum("f").alias("f"))  # a row for every rows_per_group items
    salted = salted.select("_salt", none(F.sum("f").over(earlier(Window.orderBy("_salt")))).alias("_salt_before"))
    offsets = counts.join(salted, "_salt").select(
        "_rest", "_salt", none(F.sum("c").over(earlier(Window.partitionBy("_rest").orderBy("_salt")))).alias("_before"),
        (F.col("_salt_before") + none(F.sum("f").over(earlier(Window.partitionBy("_salt").orderBy("_rest"))))).alias("_full_before"),
    )
    by_class = Window.partitionBy("_rest", "_salt").orderBy("_key", "_row")
    ranked = items.withColumns(
        {
            "_in": F.row_number().over(by_class) - 1,
            "_fulls": F.sum("_full").over(by_class.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_full"),
        }
    ).join(offsets, ["_rest", "_salt"])
    ranked = ranked.select("_key", "_n", "_full", "_rest", (F.col("_before") + F.col("_in")).alias("_rank"), (F.col("_full_before") + F.col("_fulls")).alias("_first_full"))
    table = spark.createDataFrame(intervals or [(-1, 0, 0, 0, 1, 0)], "_rest bigint, _from bigint, _items bigint, _first bigint, _each bigint, _gap bigint")
    per_size = table.groupBy("_rest").agg(F.array_sort(F.collect_list(F.struct("_from", "_items", "_first", "_each"))).alias("_runs"))
    per_size = F.broadcast(per_size) if len(intervals) <= BROADCAST_INTERVALS else per_size
    run = F.element_at(F.filter("_runs", lambda r: (r["_from"] <= F.col("_rank")) & (F.col("_rank") < r["_from"] + r["_items"])), 1)
    placed = ranked.join(per_size, "_rest", "left").withColumn("_run", run)
    container = F.when(F.col("_rest") == 0, F.lit(0)).otherwise(F.col("_run._first") + F.floor((F.col("_rank") - F.col("_run._from")) / F.col("_run._each")))
    whole = F.transform(
        F.sequence(F.lit(0).cast("bigint"), F.col("_full") - 1),
        lambda i: F.struct(i.cast("int").alias("piece"), (i * capacity).alias("start"), F.lit(capacity).cast("bigint").alias("size"), (F.col("_first_full") + i).alias("container")),
    )
    rest = F.struct(F.col("_full").cast("int").alias("piece"), (F.col("_full") * capacity).alias("start"), F.col("_rest").alias("size"), container.cast("bigint").alias("container"))
    pieces = F.when(F.col("_full") == 0, F.array(rest)).otherwise(F.concat(whole, F.array(rest)))
    return placed.select(F.col("_key").alias(id_col), F.explode(pieces).alias("p")).select(id_col, "p.piece", "p.start", "p.size", "p.container")
