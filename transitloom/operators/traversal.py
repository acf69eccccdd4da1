"""Neighbourhoods, degrees and connected components on edge frames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from transitloom.operators.ordering import with_rank
from transitloom.operators.skew import (
    BROADCAST_ROWS,
    HOT_ROWS,
    HOT_SHARE,
    NO_KEYS,
    hot_keys,
    maybe_in,
    skew_join,
    tasks_for,
)
from transitloom.storage import discard, materialize


def both_ways(edges: DataFrame) -> DataFrame:
    """Every edge in both directions, from one pass over the edges."""
    return edges.select(
        F.explode(
            F.array(
                F.struct(F.col("src").alias("src"), F.col("dst").alias("dst")),
                F.struct(F.col("dst").alias("src"), F.col("src").alias("dst")),
            )
        ).alias("edge")
    ).select("edge.src", "edge.dst")


def neighborhood(
    edges: DataFrame,
    seeds: DataFrame,
    k: int = 2,
    hot_rows: int = HOT_ROWS,
    hot_share: float = HOT_SHARE,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Nodes within ``k`` undirected steps of the seeds (column ``id``), with their distance.

    The edges are read once per step: pass a stored frame. They are not shuffled for a step
    that starts from ``broadcast_rows`` nodes at most; beyond that only edges that a broadcast
    bitmap of hashed starts lets pass are, and hubs are salted.
    """
    links = both_ways(edges)
    hubs = None
    reached = seeds.select("id").dropna().distinct().withColumn("hops", F.lit(0))
    reached = materialize(reached, "hop")
    frontier = reached.select("id")
    for hop in range(1, k + 1):
        start = frontier.toDF("src")
        size = start.count()
        if size <= broadcast_rows:
            near = links.join(F.broadcast(start), "src", "left_semi")
        else:
            hubs = hot_keys(links, ["src"], hot_rows, hot_share) if hubs is None else hubs
            # Starts differ; a semi join would be pushed below the bitmap's.
            near = skew_join(
                maybe_in(links, start, "src", size), start, ["src"], "inner", hot_rows, hot_share,
                unique_right=True, left_hot=hubs,
            )
        found = near.select(F.col("dst").alias("id")).distinct()
        fresh = found.join(reached.select("id"), "id", "left_anti")
        # Later steps read this one twice; written down, it is computed once.
        fresh = materialize(fresh.withColumn("hops", F.lit(hop)), "hop")
        reached = reached.unionByName(fresh)
        frontier = fresh.select("id")
    return reached


def degrees(edges: DataFrame) -> DataFrame:
    """Out-, in- and total degree per node.

    The edges are counted first, so a stored frame is best. Many of them are dealt by both ends
    to tasks that hold a bounded number, which adds a hub up in many places.
    """
    edges = edges.select("src", "dst")
    tasks = tasks_for(edges.count())
    ends = (edges.repartition(tasks, "src", "dst") if tasks > 1 else edges).select(
        F.explode(
            F.array(
                F.struct(F.col("src").alias("id"), F.lit(1).alias("out")),
                F.struct(F.col("dst").alias("id"), F.lit(0).alias("out")),
            )
        ).alias("end")
    )
    return (
        ends.groupBy("end.id")
        .agg(
            F.sum("end.out").cast("bigint").alias("out_degree"),
            F.count("*").alias("degree"),
        )
        .select("id", "out_degree", (F.col("degree") - F.col("out_degree")).alias("in_degree"), "degree")
    )


def _follow(frame, step, column, hot_rows, hot, strict=False):
    """Replace ``column`` by what ``step`` (``id``, ``target``) maps it to; where it maps it to
    nothing the value stays, or with ``strict`` becomes NULL."""
    mapping = step.select(F.col("id").alias(column), F.col("target").alias("_to"))
    joined = skew_join(
        frame, mapping, [column], "left", hot_rows, unique_right=True, left_hot=hot
    )
    moved = (F.col("_to") if strict else F.coalesce("_to", column)).alias(column)
    return joined.select(*[moved if name == column else name for name in frame.columns])


def _downward(links: DataFrame) -> DataFrame:
    """Links from their larger to their smaller end, without loops."""
    ends = links.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))
    return ends.where("src <> dst")


def connected_components(
    edges: DataFrame, hot_rows: int = HOT_ROWS, hot_share: float = HOT_SHARE
) -> DataFrame:
    """``(id, component)``, the component named by its smallest node id.

    Ids other than longs are numbered in their order first and named again at the end, so
    that the rounds compare and shuffle longs. An edge without one of its ends names the
    other as a node. Each round every node chooses its smallest neighbour, if that is smaller, and is
    merged into the node its choices lead to; the edges between merged nodes go away.
    Only nodes smaller than all their neighbours stay, so the graph shrinks by a large
    part every round, and the smallest node of a component is the last to stay.
    Following choices doubles its reach with each join, so long chains take few of
    them. The smallest neighbour is a ``min`` combined before the shuffle; joins on
    nodes with a large share of the rows are salted. At the end the rounds' choices are
    chained, the last and smallest first.
    """

    def busy(table, *columns):
        """Hot keys per column of a stored table; one with fewer rows than a hot key has none."""
        if table.count() < hot_rows:
            return [NO_KEYS for _ in columns]
        return [hot_keys(table, [column], hot_rows, hot_share) for column in columns]

    if not isinstance(edges.schema["src"].dataType, LongType):
        stored = materialize(edges.select("src", "dst"), "edges")
        ends = stored.select(F.explode(F.array("src", "dst")).alias("id")).dropna().distinct()
        numbers = materialize(with_rank(ends, ["id"], "target"), "numbers")
        whole = stored.dropna()
        hot_src, hot_dst = busy(whole, "src", "dst")
        numbered = _follow(whole, numbers, "src", hot_rows, hot_src, strict=True)
        numbered = materialize(
            _follow(numbered, numbers, "dst", hot_rows, hot_dst, strict=True), "numbered"
        )
        found = connected_components(numbered, hot_rows, hot_share)
        merged = found.select("id", F.col("component").alias("target"))
        labels = numbers.select("id", F.col("target").alias("component"))
        labels = materialize(_follow(labels, merged, "component", hot_rows, NO_KEYS), "components")
        discard(stored)
        discard(numbered)
        named = numbers.select(F.col("target").alias("id"), F.col("id").alias("target"))
        (hot,) = busy(labels, "component")
        return _follow(labels, named, "component", hot_rows, hot, strict=True)

    ids = edges.select(F.explode(F.array("src", "dst")).alias("id")).dropna().distinct()
    links = materialize(_downward(edges), "links")
    steps = []
    while not links.isEmpty():
        choice = links.groupBy(F.col("src").alias("id")).agg(F.min("dst").alias("target"))
        step = materialize(choice, "choice")
        while True:
            known = step.select(F.col("id").alias("target"))
            if step.select("target").distinct().join(known, "target", "left_semi").isEmpty():
                break
            further = _follow(step, step, "target", hot_rows, *busy(step, "target"))
            shorter, step = step, materialize(further, "choice")
            discard(shorter)
        steps.append(step)
        hot_src, hot_dst = busy(links, "src", "dst")
        moved = _follow(links, step, "src", hot_rows, hot_src)
        moved = _downward(_follow(moved, step, "dst", hot_rows, hot_dst))
        before, links = links, materialize(moved.distinct(), "links")
        discard(before)
    labels = ids.withColumn("component", F.col("id"))
    if not steps:
        return labels
    chained = steps.pop()
    while steps:
        earlier = steps.pop()
        moved = _follow(earlier, chained, "target", hot_rows, *busy(earlier, "target"))
        # Nodes that first moved in a later round.
        stayed = chained.join(earlier, "id", "left_anti")
        later, chained = chained, materialize(moved.unionByName(stayed), "step")
        discard(later)
        discard(earlier)
    return _follow(labels, chained, "component", hot_rows, NO_KEYS)
