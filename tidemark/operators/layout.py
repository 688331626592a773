"""A drawing of the graph by forces, as a DataFrame of positions.

Linked nodes attract, all others repel. Repulsion comes from the cells of a grid: a node is pushed by the nodes of its own and the eight
cells around, put together in each cell's centre, and by the centre of everything beyond them. A round is a few joins and sums. Forces are whole numbers when they
are added, so that the order of addition doesn't matter and a layout is the same every time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.storage import shared_dir

#: The side of the square, and units of it in which forces are added.
SIDE, UNIT = 1000.0, 1_000_000
ROUNDS = 15


def _start(name: Column, seed: int) -> Column:
    """A place in the square by a hash of the name."""
    return F.pmod(F.xxhash64(F.lit(seed), name), F.lit(1_000_003)) / 1_000_003 * SIDE


def _whole(x: Column) -> Column:
    return F.round(x * UNIT).cast("long")


def layout(node: DataFrame, edge: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """id, x, y of nodes (id) with edges (source, target, weight), after so many rounds. Nodes without an edge are held near by the pull to the middle.

    Edges of an end that is no node count for nothing.
    """
    spark = node.sparkSession
    n = node.count()
    if not n:
        return node.select("id", F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    ideal = SIDE / n**0.5
    cell = 2 * ideal
    both = edge.select(F.col("source").alias("id"), F.col("target").alias("other")).unionByName(edge.select(F.col("target").alias("id"), F.col("source").alias("other")))
    both = both.filter("id <> other").distinct().checkpoint()
    place = node.select("id", _start(F.col("id"), 1).alias("x"), _start(F.col("id"), 2).alias("y")).checkpoint()
    for k in range(rounds):
        heat = SIDE / 10 * (1 - k / rounds)
        at = place.withColumns({"cx": F.floor(F.col("x") / cell), "cy": F.floor(F.col("y") / cell)})
        cells = at.groupBy("cx", "cy").agg(F.count("*").alias("m"), F.sum(_whole(F.col("x"))).alias("sx"), F.sum(_whole(F.col("y"))).alias("sy"))
        # A cell tells those around it what it holds.
        steps = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in (-1, 0, 1) for b in (-1, 0, 1)])
        near = cells.withColumn("s", F.explode(steps)).select((F.col("cx") + F.col("s.a")).alias("cx"), (F.col("cy") + F.col("s.b")).alias("cy"), "m", (F.col("sx") / UNIT).alias("sx"), (F.col("sy") / UNIT).alias("sy"), ((F.col("s.a") == 0) & (F.col("s.b") == 0)).alias("own"))
        push = at.join(near, ["cx", "cy"])
        # A node doesn't push itself.
        m = F.col("m") - F.col("own").cast("int")
        mx, my = (F.when(m > 0, (F.col(f"s{c}") - F.when(F.col("own"), F.col(c)).otherwise(0)) / m) for c in "xy")
        dx, dy = F.col("x") - mx, F.col("y") - my
        square = F.greatest(dx * dx + dy * dy, F.lit(ideal * ideal / 100))
        push = push.filter(m > 0).select("id", _whole(dx / square * m * ideal * ideal).alias("fx"), _whole(dy / square * m * ideal * ideal).alias("fy"))
        there = place.select(F.col("id").alias("other"), F.col("x").alias("ox"), F.col("y").alias("oy"))
        pulled = both.join(place, "id").join(there, "other")
        dx, dy = F.col("ox") - F.col("x"), F.col("oy") - F.col("y")
        far = F.sqrt(dx * dx + dy * dy)
        pull = pulled.select("id", _whole(dx * far / ideal).alias("fx"), _whole(dy * far / ideal).alias("fy"))
        middle = place.select("id", _whole((SIDE / 2 - F.col("x")) * 0.05 * ideal / SIDE).alias("fx"), _whole((SIDE / 2 - F.col("y")) * 0.05 * ideal / SIDE).alias("fy"))
        force = push.unionByName(pull).unionByName(middle).groupBy("id").agg((F.sum("fx") / UNIT).alias("fx"), (F.sum("fy") / UNIT).alias("fy"))
        size = F.greatest(F.sqrt(F.col("fx") * F.col("fx") + F.col("fy") * F.col("fy")), F.lit(1e-9))
        step = F.least(size, F.lit(heat)) / size
        inside = lambda c, f: F.round(F.greatest(F.lit(0.0), F.least(F.lit(SIDE), F.col(c) + F.col(f) * step)), 6)  # noqa: B023, E731
        place = place.join(force, "id").select("id", inside("x", "fx").alias("x"), inside("y", "fy").alias("y"))
        # Each round uses the positions several times, so they are written to the shared folder.
        place = place.checkpoint()
    return place
