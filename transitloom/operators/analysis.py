"""What a graph tells as a whole: importance, strong components, shortest ways, triangles.

Every round works on stored tables. A table with one row per node meets the edges by broadcast
while it is known to be short, and beyond that by a join whose hot keys are salted, so that a
node with a large share of all edges is no single task's work. The table of a round that is
done with is deleted.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from transitloom.operators.ordering import with_rank
from transitloom.operators.skew import (
    BROADCAST_ROWS,
    HOT_ROWS,
    HOT_SHARE,
    NO_KEYS,
    HotKeys,
    hot_keys,
    skew_join,
    tasks_for,
)
from transitloom.storage import discard, drop_buckets, materialize, materialize_buckets

# Out-links of a node that one row holds, at most, when triangles are looked for.
WEDGE_LINKS = 1_000
# Fixed pseudo-random orders of node numbers, one per round of strong components.
_ORDER_STEP = 0x2545F4914F6CDD1D


def _meet(
    edges: DataFrame, nodes: DataFrame, size: int, hot: HotKeys, hot_rows: int, broadcast_rows: int,
    how: str = "inner", key: str = "src",
) -> DataFrame:
    """Edges with the row of ``nodes`` (``key`` and more, one row a node, ``size`` rows at most)."""
    if size <= broadcast_rows:
        return edges.join(F.broadcast(nodes), key, how)
    return skew_join(edges, nodes, [key], how, hot_rows, unique_right=True, left_hot=hot)


def _ends(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array("src", "dst")).alias("id")).dropna()


# --- importance ---------------------------------------------------------------------
def pagerank(
    edges: DataFrame,
    seeds: DataFrame | None = None,
    damping: float = 0.85,
    rounds: int | None = None,
    tolerance: float = 1e-6,
    max_rounds: int = 100,
    hot_rows: int = HOT_ROWS,
    hot_share: float = HOT_SHARE,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """``(id, rank)`` of every node: where a walk along ``(src, dst)`` edges is found.

    With chance ``damping`` the walk follows one of the node's different out-links, else, and
    wherever a node has none, it starts anew at any node, or at any of ``seeds`` (column
    ``id``). Ranks sum to 1. Either ``rounds`` are done, or as many as it takes until the ranks
    change by ``tolerance`` in sum, ``max_rounds`` at most.

    A graph without nodes has no ranks; an edge without one of its ends names the other as a
    node. Where the number of rounds is known, only walks move, see ``_walked``.
    """
    if rounds is not None:
        return _walked(edges, seeds, damping, rounds, hot_rows, hot_share, broadcast_rows)
    links = materialize(edges.select("src", "dst").dropna().distinct(), "links")
    out = links.groupBy(F.col("src").alias("id")).agg(F.count("*").alias("out_degree"))
    named = _ends(edges)
    if seeds is not None:
        chosen = materialize(seeds.select("id").dropna().distinct(), "seeds")
        named = named.unionByName(chosen)
    rows = named.distinct().select("id", F.lit(0).cast("bigint").alias("out_degree"), F.lit(0.0).alias("start"))
    rows = rows.unionByName(out.withColumn("start", F.lit(0.0)))
    if seeds is not None:
        share = 1.0 / max(1, chosen.count())
        rows = rows.unionByName(chosen.select("id", F.lit(0).cast("bigint").alias("out_degree"), F.lit(share).alias("start")))
    nodes = rows.groupBy("id").agg(F.max("out_degree").alias("out_degree"), F.max("start").alias("start"))
    nodes = materialize(nodes, "nodes")
    size = nodes.count()
    start = F.lit(1.0 / max(1, size)) if seeds is None else F.col("start")
    hot = hot_keys(links, ["src"], hot_rows, hot_share) if size > broadcast_rows else NO_KEYS
    state = materialize(
        nodes.select("id", "out_degree", start.alias("start"), start.alias("rank"), F.lit(0.0).alias("before")),
        "ranks",
    )
    discard(nodes)
    for _ in range(max_rounds):
        seen = state.agg(
            F.sum(F.when(F.col("out_degree") == 0, F.col("rank"))).alias("stuck"),
            F.sum(F.abs(F.col("rank") - F.col("before"))).alias("change"),
        ).first()
        if (seen["change"] or 0.0) <= tolerance:
            break
        leaving = state.where("out_degree > 0").select(
            F.col("id").alias("src"), (F.col("rank") / F.col("out_degree")).alias("sent")
        )
        carried = _meet(links, leaving, size, hot, hot_rows, broadcast_rows)
        none = F.lit(None)
        gathered = carried.select(
            F.col("dst").alias("id"), "sent", none.cast("bigint").alias("out_degree"),
            none.cast("double").alias("start"), none.cast("double").alias("before"),
        ).unionByName(
            state.select("id", F.lit(0.0).alias("sent"), "out_degree", "start", F.col("rank").alias("before"))
        )
        summed = gathered.groupBy("id").agg(
            F.sum("sent").alias("sent"),
            *[F.max(name).alias(name) for name in ("out_degree", "start", "before")],
        )
        again = F.lit(1 - damping) + F.lit(damping * (seen["stuck"] or 0.0))
        rank = F.col("start") * again + F.col("sent") * damping
        earlier, state = state, materialize(
            summed.select("id", "out_degree", "start", rank.alias("rank"), "before"), "ranks"
        )
        discard(earlier)
    return state.select("id", "rank")


def _outgoing(whole: DataFrame, hot_rows: int, hot_share: float) -> tuple[DataFrame, DataFrame | None, HotKeys, int]:
    """Different links as a table ``(src, dst, share)``, ``share`` being one over the out-links of
    ``src``; those of hot sources as a table of their own, or None; the hot sources; and the
    number of buckets by ``src`` that the first table has, 1 if it has none."""
    hot = hot_keys(whole, ["src"], hot_rows, hot_share)
    buckets, busy = tasks_for(hot.rows), None
    ordinary = whole
    if hot:
        listed = hot.joinable(hot.table.select("src"))
        ordinary = whole.join(listed, "src", "left_anti")
        busy = materialize(whole.join(listed, "src", "left_semi").distinct(), "links")
        shares = busy.groupBy("src").agg((1 / F.count("*")).alias("share"))
        busy = busy.join(hot.joinable(shares), "src")
    # Dealt by one end, the links are told apart, counted and stored by a single shuffle.
    dealt = (ordinary.repartition(buckets, "src") if buckets > 1 else ordinary.repartition("src")).distinct()
    share = (1 / F.count("*").over(Window.partitionBy("src"))).alias("share")
    shared = dealt.select("src", "dst", share)
    stored = materialize_buckets(shared, "links", "src", buckets) if buckets > 1 else materialize(shared, "links")
    return stored, busy, hot, buckets


def _walked(
    edges: DataFrame, seeds: DataFrame | None, damping: float, rounds: int,
    hot_rows: int, hot_share: float, broadcast_rows: int,
) -> DataFrame:
    """PageRank of a known number of rounds from the walks of each length.

    A round's ranks are linear in the start and in what starts anew, which is one number. So
    they are a sum over lengths: the chance of a walk of ``j`` links from the start to a node,
    times a factor that follows from the masses of the lengths. Walks of a length are stored for
    the nodes they reach and no others, so links that no walk of this length follows carry
    nothing, and nothing moves but what the links carry, added up per node before it does. The
    links stay where they are, in buckets by their source.
    """
    named = edges.select("src", "dst")
    links, busy, hot, buckets = _outgoing(named.dropna(), hot_rows, hot_share)

    def step(walks, size):
        if walks is None:
            frames = [links.select("dst", "share")] + ([busy.select("dst", "share")] if hot else [])
        else:
            at = walks.withColumnRenamed("id", "src")
            near = F.broadcast(at) if size <= broadcast_rows else at
            if size > broadcast_rows and buckets > 1:
                near = at.repartition(buckets, "src")  # as the links are
            moved = (F.col("share") * F.col("mass")).alias("share")
            frames = [links.join(near, "src").select("dst", moved)]
            if hot:
                few = hot.joinable(at.join(hot.joinable(hot.table.select("src")), "src", "left_semi"))
                frames.append(busy.join(few, "src").select("dst", moved))
        summed = reduce(DataFrame.unionByName, frames).groupBy(F.col("dst").alias("id"))
        return materialize(summed.agg(F.sum("share").alias("mass")), "walks")

    def measured(walks):
        seen = walks.agg(F.count("*").alias("size"), F.sum("mass").alias("mass")).first()
        return seen["size"], seen["mass"] or 0.0

    first = step(None, 0)  # one walk from every node along each link
    sources = links.select(F.col("src").alias("id")).distinct()
    odd = _ends(named.where("src IS NULL OR dst IS NULL"))
    frames = [sources, first.select("id"), odd]
    if hot:
        frames.append(hot.table.select(F.col("src").alias("id")))
    if seeds is None:
        nodes = materialize(reduce(DataFrame.unionByName, frames).distinct(), "nodes")
        size = nodes.count()
        tables, sizes = [nodes.withColumn("mass", F.lit(1.0)), first], [(size, float(size)), measured(first)]
    else:
        chosen = materialize(seeds.select("id").dropna().distinct().withColumn("mass", F.lit(1.0)), "seeds")
        nodes = materialize(reduce(DataFrame.unionByName, [*frames, chosen.select("id")]).distinct(), "nodes")
        discard(first)
        tables, sizes = [chosen], [measured(chosen)]
    while len(tables) <= rounds and sizes[-1][0]:
        tables.append(step(tables[-1], sizes[-1][0]))
        sizes.append(measured(tables[-1]))
    if buckets > 1:
        drop_buckets(links)
    else:
        discard(links)

    masses = [mass / max(1.0, sizes[0][1]) for _, mass in sizes] + [0.0] * (rounds + 1)
    anew = [1.0]  # the weight of the start in each round
    for k in range(rounds):
        stuck = sum(anew[k - j] * damping**j * (masses[j] - masses[j + 1]) for j in range(k + 1))
        anew.append(1 - damping + damping * stuck)
    weights = [anew[rounds - j] * damping**j / max(1.0, sizes[0][1]) for j in range(min(len(tables), rounds + 1))]
    parts = [
        walks.select("id", (F.col("mass") * F.lit(weight)).alias("rank"))
        for walks, weight in zip(tables, weights)
    ]
    if seeds is not None:
        parts.append(nodes.select("id", F.lit(0.0).alias("rank")))
    return reduce(DataFrame.unionByName, parts).groupBy("id").agg(F.sum("rank").alias("rank"))


# --- strong components --------------------------------------------------------------
def _numbered(edges: DataFrame, hot_rows: int, hot_share: float) -> tuple[DataFrame, DataFrame]:
    """Different links between numbered nodes, without loops, and ``(id, name)`` of all nodes;
    numbers follow the order of the names."""
    stored = materialize(edges.select("src", "dst"), "edges")
    names = _ends(stored).distinct()
    if isinstance(edges.schema["src"].dataType, LongType):
        numbers = materialize(names.select("id", F.col("id").alias("name")), "numbers")
        links = stored.dropna()
    else:
        ranked = with_rank(names.withColumnRenamed("id", "name"), ["name"], "id")
        numbers = materialize(ranked.select("id", "name"), "numbers")
        links = stored.dropna()
        for end in ("src", "dst"):
            own = numbers.select(F.col("name").alias(end), F.col("id").alias("_number"))
            hot = hot_keys(stored, [end], hot_rows, hot_share)
            joined = skew_join(links, own, [end], "inner", hot_rows, unique_right=True, left_hot=hot)
            links = joined.withColumn(end, F.col("_number")).drop("_number")
    links = materialize(links.where("src <> dst").distinct(), "links")
    discard(stored)
    return links, numbers


def _least_before(edges: DataFrame, mask: int, hot_rows: int, hot_share: float, broadcast_rows: int) -> DataFrame:
    """``(id, label)``: of the nodes a node is reached from, itself included, the least one.

    Nodes are compared by their number with some bits flipped, ``mask``. A node takes the least
    label along its in-links, and then the label of the node that this label names: what has
    been learnt doubles its reach, so that long chains and cycles take few rounds.
    """
    masked = F.col("id").bitwiseXOR(F.lit(mask))
    labels = _ends(edges).distinct().select("id", masked.alias("label"), F.lit(True).alias("moved"))
    labels = materialize(labels, "labels")
    size = labels.count()
    hot = hot_keys(edges, ["src"], hot_rows, hot_share) if size > broadcast_rows else NO_KEYS
    while True:
        moved = labels.where("moved")
        some = moved.count()
        if not some:
            return labels.select("id", "label")
        sent = moved.select(F.col("id").alias("src"), "label")
        carried = _meet(edges, sent, some, hot, hot_rows, broadcast_rows)
        options = labels.select("id", "label", F.col("label").alias("before")).unionByName(
            carried.select(F.col("dst").alias("id"), "label", F.lit(None).cast("bigint").alias("before"))
        )
        taken = options.groupBy("id").agg(F.min("label").alias("label"), F.max("before").alias("before"))
        taken = materialize(taken, "taken")
        leads = taken.select(F.col("id").bitwiseXOR(F.lit(mask)).alias("label"), F.col("label").alias("further"))
        # Many nodes may share a label: the larger side of this join can be hot.
        hot_label = hot_keys(taken, ["label"], hot_rows, hot_share) if size > broadcast_rows else NO_KEYS
        jumped = _meet(taken, leads, size, hot_label, hot_rows, broadcast_rows, "left", "label")
        label = F.least("label", F.coalesce("further", "label"))
        earlier, labels = labels, materialize(
            jumped.select("id", label.alias("label"), (label < F.col("before")).alias("moved")), "labels"
        )
        discard(earlier)
        discard(taken)


def _trimmed(links: DataFrame) -> DataFrame:
    """Links whose ends may lie on a cycle: from a node with an in-link, to one with an out-link."""
    entered = links.select(F.col("dst").alias("src")).distinct()
    left = links.select(F.col("src").alias("dst")).distinct()
    return links.join(entered, "src", "left_semi").join(left, "dst", "left_semi").select("src", "dst")


def strong_components(
    edges: DataFrame,
    hot_rows: int = HOT_ROWS,
    hot_share: float = HOT_SHARE,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """``(id, component)``: nodes that reach each other along directed edges, named by the
    smallest of them. A node on no cycle is alone.

    Links that lie on no cycle for lack of a link in or out are trimmed. Then every node learns
    the least node it is reached from, and among nodes that agree on it the least one it
    reaches: where the two are the same node, all of its component is found. Links between
    nodes that differ in either lie in no component and go; the rest is done again, by another
    order of the nodes. An edge without one of its ends names the other as a node.
    """
    links, numbers = _numbered(edges, hot_rows, hot_share)
    found, turn = [], 0
    while True:
        for _ in range(2):
            earlier, links = links, materialize(_trimmed(links), "links")
            discard(earlier)
        if links.isEmpty():
            break
        mask = (turn * _ORDER_STEP) & ((1 << 62) - 1)
        turn += 1
        reached = _least_before(links, mask, hot_rows, hot_share, broadcast_rows)
        alike = materialize(_agreeing(links, reached, hot_rows, hot_share, broadcast_rows), "alike")
        discard(links)
        reaching = _least_before(
            alike.select(F.col("dst").alias("src"), F.col("src").alias("dst")),
            mask, hot_rows, hot_share, broadcast_rows,
        )
        # The root of a set of agreeing nodes reaches all of them; those that reach it are one.
        both = reached.join(reaching.withColumnRenamed("label", "back"), "id")
        done = materialize(both.where("label = back").select("id", "label"), "found")
        found.append(done)
        alone = materialize(both.where("label <> back").select("id", F.col("back").alias("label")), "open")
        links = materialize(_agreeing(alike, alone, hot_rows, hot_share, broadcast_rows), "links")
        discard(alike)
    labels = numbers.select("id", "name")
    if found:
        whole = reduce(DataFrame.unionByName, found)
        first = whole.groupBy("label").agg(F.min("id").alias("root"))
        rooted = skew_join(whole, first, ["label"], "inner", hot_rows, hot_share, unique_right=True)
        labels = labels.join(rooted.select("id", "root"), "id", "left")
    else:
        labels = labels.withColumn("root", F.lit(None).cast("bigint"))
    own = labels.select("name", F.coalesce("root", "id").alias("root"))
    called = numbers.select(F.col("id").alias("root"), F.col("name").alias("component"))
    joined = skew_join(materialize(own, "roots"), called, ["root"], "inner", hot_rows, hot_share, unique_right=True)
    return joined.select(F.col("name").alias("id"), "component")


def _agreeing(links, labels, hot_rows, hot_share, broadcast_rows):
    """Links whose two ends have a label, and the same one."""
    size = labels.count()
    joined = links
    for end in ("src", "dst"):
        own = labels.select(F.col("id").alias(end), F.col("label").alias(f"_{end}"))
        hot = hot_keys(links, [end], hot_rows, hot_share) if size > broadcast_rows else NO_KEYS
        joined = _meet(joined, own, size, hot, hot_rows, broadcast_rows, key=end)
    return joined.where("_src = _dst").select("src", "dst")


# --- shortest ways ------------------------------------------------------------------
def travel_times(trips: DataFrame) -> DataFrame:
    """``(src, dst, weight)``: between consecutive planned stops the least time in seconds.

    Arrivals that are missing or lie before the one in front give no edge.
    """
    stops = F.col("stop_time_updates")
    hops = F.transform(
        F.slice(stops, 2, F.greatest(F.size(stops), F.lit(1))),
        lambda stop, at: F.struct(
            F.get(stops, at)["stop_id"].alias("src"), stop["stop_id"].alias("dst"),
            (stop["arrival_time"] - F.get(stops, at)["arrival_time"]).alias("weight"),
        ),
    )
    listed = trips.select(F.explode(hops).alias("hop")).select("hop.*").dropna().where("weight >= 0")
    return listed.groupBy("src", "dst").agg(F.min("weight").alias("weight"))


def shortest_paths(
    edges: DataFrame,
    seeds: DataFrame,
    delta: float | None = None,
    hot_rows: int = HOT_ROWS,
    hot_share: float = HOT_SHARE,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """``(id, distance)`` of the nodes that can be reached from ``seeds`` (column ``id``) along
    ``(src, dst, weight)`` edges, the distance being the least sum of weights.

    Nodes are settled in bands of width ``delta`` (by default the mean weight). Within a band,
    edges no longer than it are followed until nothing gets nearer; then, once, the longer ones.
    So the number of rounds follows from the largest distance and the edges of a band, not from
    the number of nodes; chains of edges of weight 0 take a round each. Weights may be whole
    or broken, not negative; NULL ends and weights give no edge. Seeds have distance 0, also
    where no edge knows them.
    """
    kind = edges.schema["weight"].dataType
    links = edges.select("src", "dst", "weight").dropna().where("src <> dst")
    links = materialize(links.groupBy("src", "dst").agg(F.min("weight").alias("weight")), "links")
    seen = links.agg(F.min("weight").alias("least"), F.avg("weight").alias("mean")).first()
    if seen["least"] is not None and seen["least"] < 0:
        raise ValueError("weights must not be negative")
    if delta is None:
        delta = float(seen["mean"] or 1.0) or 1.0
    hot = hot_keys(links, ["src"], hot_rows, hot_share)
    state = materialize(
        seeds.select("id").dropna().distinct().select(
            "id", F.lit(0).cast(kind).alias("distance"), F.lit(1).alias("open")),
        "distances",
    )

    def relaxed(state, sources, edges):
        """The state after following ``edges`` from ``sources``, which are closed by it."""
        own = materialize(sources.select(F.col("id").alias("src"), F.col("distance").alias("_at")), "frontier")
        carried = _meet(edges, own, own.count(), hot, hot_rows, broadcast_rows)
        nearer = carried.groupBy(F.col("dst").alias("id")).agg(
            F.min(F.col("_at") + F.col("weight")).cast(kind).alias("distance")
        )
        # At equal distance the closed entry (0) is the lesser one: nothing is opened again.
        entries = state.unionByName(nearer.withColumn("open", F.lit(1)))
        best = entries.groupBy("id").agg(F.min(F.struct("distance", "open")).alias("best"))
        after = materialize(best.select("id", "best.*"), "distances")
        discard(own)
        return after

    reach = 0.0
    while True:
        nearest = state.where(F.col("distance") >= reach).agg(F.min("distance").alias("distance")).first()
        if nearest["distance"] is None:
            return state.select("id", "distance")
        # Empty bands are skipped. What lies before the last band is settled already.
        settled, reach = reach, (float(nearest["distance"]) // delta + 1) * delta
        inside = (F.col("distance") >= settled) & (F.col("distance") < reach)
        while True:
            opened = state.where(inside & (F.col("open") == 1))
            if opened.isEmpty():
                break
            closed = state.withColumn("open", F.when(inside, F.lit(0)).otherwise(F.col("open")))
            earlier, state = state, relaxed(closed, opened, links.where(F.col("weight") <= delta))
            discard(earlier)
        earlier, state = state, relaxed(state, state.where(inside), links.where(F.col("weight") > delta))
        discard(earlier)


# --- triangles ----------------------------------------------------------------------
def triangles(
    edges: DataFrame,
    wedge_links: int = WEDGE_LINKS,
    hot_rows: int = HOT_ROWS,
    hot_share: float = HOT_SHARE,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """``(id, degree, triangles, clustering)`` of every node with a neighbour, undirected.

    Nodes are numbered from 1 by their degree, and every link leads to the larger number, so that no
    node, hub or not, has more than the square root of twice the number of links going out.
    The nodes that a node leads to are cut into pieces of ``wedge_links``. Each of its links takes
    along the pieces of what comes after it, and meets the pieces of what it leads to: what the
    two share closes a triangle. So wedges travel as pieces of numbers, not as rows; no row holds
    more than one piece, and hot meeting places are salted. ``clustering`` is the share of a
    node's pairs of neighbours that are linked, NULL below two neighbours.
    """
    pairs = materialize(edges.dropna(subset=["src", "dst"]).where("src <> dst").select(
        F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")).distinct(), "pairs")
    degrees = _ends(pairs).groupBy("id").agg(F.count("*").alias("degree"))
    degrees = materialize(degrees, "degrees")
    size = degrees.count()
    ranked = with_rank(degrees, ["degree", "id"], "number").withColumn("number", F.col("number") + 1)
    numbers = materialize(ranked, "numbers")
    discard(degrees)
    named = pairs
    for end in ("src", "dst"):
        own = numbers.select(F.col("id").alias(end), F.col("number").alias(f"_{end}"))
        hot = hot_keys(pairs, [end], hot_rows, hot_share) if size > broadcast_rows else NO_KEYS
        named = _meet(named, own, size, hot, hot_rows, broadcast_rows, key=end)
    links = named.select(F.least("_src", "_dst").alias("src"), F.greatest("_src", "_dst").alias("dst"))
    place = F.row_number().over(Window.partitionBy("src").orderBy("dst")) - 1
    placed = links.withColumn("piece", F.floor(place / wedge_links).cast("int"))
    directed = materialize(placed, "directed")
    pieces = directed.groupBy("src", "piece").agg(F.sort_array(F.collect_list("dst")).alias("ends"))
    pieces = materialize(pieces, "pieces")
    # Pieces of one node in pairs; those of nodes with several are dealt anew, since they make
    # the more wedges.
    later = pieces.select("src", F.col("piece").alias("second"), F.col("ends").alias("others"))
    split = directed.where("piece = 1").select("src").distinct()
    single = pieces.join(split, "src", "left_anti").select("src", "ends", F.col("ends").alias("others"), F.lit(True).alias("own"))
    several = pieces.join(split, "src", "left_semi")
    dealt = several.join(later, "src").where("piece <= second").repartition("src", "piece", "second")
    both = single.unionByName(dealt.select("src", "ends", "others", (F.col("piece") == F.col("second")).alias("own")))
    beyond = F.when(F.col("own"), F.slice("others", F.col("at") + 2, F.greatest(F.size("others"), F.lit(1))))
    wedges = both.select("src", "others", "own", F.posexplode("ends").alias("at", "near")).select(
        "src", "near", beyond.otherwise(F.col("others")).alias("far")
    ).where(F.size("far") > 0)
    # Links are sorted by number, so that a closing link leads from near to far.
    closing = pieces.select(F.col("src").alias("near"), "ends")
    hot = hot_keys(directed.select(F.col("dst").alias("near")), ["near"], hot_rows, hot_share)
    met = skew_join(wedges, closing, ["near"], "inner", hot_rows, unique_right=True, left_hot=hot)
    closed = met.select("src", "near", F.array_intersect("far", "ends").alias("far"))
    closed = closed.where(F.size("far") > 0)
    one = F.lit(1).cast("bigint").alias("n")
    times = F.size("far").cast("bigint").alias("n")
    ends = F.array(F.struct(F.col("src").alias("number"), times), F.struct(F.col("near").alias("number"), times))
    far = F.transform("far", lambda number: F.struct(number.alias("number"), one))
    found = closed.select(F.explode(F.concat(ends, far)).alias("end"))
    counted = found.groupBy("end.number").agg(F.sum("end.n").alias("triangles"))
    number = F.coalesce("triangles", F.lit(0).cast("bigint"))
    pairs_of = F.col("degree") * (F.col("degree") - 1)
    return numbers.join(counted, "number", "left").select(
        "id", "degree", number.alias("triangles"),
        F.when(pairs_of > 0, 2 * number / pairs_of).alias("clustering"),
    )
