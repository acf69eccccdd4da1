"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

A source is cut into blocks by a hash of its rows. Its target says how many blocks are to
be drawn: every block once per whole pass over the source, and those of a last pass until
the words suffice. The draws of all sources are dealt to the output shards by a binary
tree: a node splits its draws in half, and how many of each source go left is
hypergeometric, so every shard gets a fair sample of exactly the quotas. A shard's draws
are consecutive places of the source's permuted blocks and thus disjoint from any other's.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil, log2

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from transitloom.llm.frames import column
from transitloom.operators.ordering import with_rank
from transitloom.storage import materialize

# Primes above any number of blocks, so that each steps through all of them.
_STEPS = (2147483647, 2147483629, 2147483587, 2147483579)
_LEVELS_PER_STAGE = 6


@dataclass
class Mixture:
    """The plan of a mix, as stored tables."""

    sized: DataFrame  # doc_id, source_key, size, row_key
    sources: DataFrame  # per source: place, weight, source_size, target, blocks, passes, ...
    draws: DataFrame  # place, block, draws: array<struct<pass, shard, cut>>
    shards: int


def word_count(text: Column) -> Column:
    """Number of runs of other than ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def _source_key(source: Column) -> Column:
    """The source as a text that is never null and sorts by code point, null last."""
    return F.coalesce(F.concat(F.lit("0"), source.cast("string")), F.lit("1"))


def _row_key(doc_id: Column, text: Column) -> Column:
    return F.xxhash64(F.lit("mix"), doc_id, text)


def _sized(documents, id_col, text_col, source_col) -> DataFrame:
    return documents.select(
        column(id_col).alias("doc_id"),
        _source_key(column(source_col)).alias("source_key"),
        word_count(column(text_col)).alias("size"),
        _row_key(column(id_col), column(text_col)).alias("row_key"),
    )


def source_targets(
    sources: DataFrame, weights: tuple[float, ...] = (1, 2, 3), most: float = 3.0, total=None
) -> DataFrame:
    """Add ``weight`` and ``target`` to sources with ``place`` and ``source_size``.

    Weights repeat in the order of ``place``. The targets share ``total`` words (default: all
    there are) by weight; one above ``most`` times its source's size stops there, and the
    excess is shared again among the others, until none is above. Each round is one
    aggregation and fixes at least one source.
    """
    cycle = F.array(*[F.lit(float(weight)) for weight in weights])
    weighted = sources.withColumn("weight", cycle[(F.col("place") % len(weights)).cast("int")])
    cap = F.col("source_size") * most
    everything = weighted.agg(F.sum("source_size")).first()[0] or 0
    wanted = float(everything if total is None else total)
    level = 0.0  # words per unit of weight; grows from round to round
    while True:
        full = F.col("weight") * level > cap
        row = weighted.agg(
            F.sum(F.when(full, cap)).alias("fixed"), F.sum(F.when(~full, F.col("weight"))).alias("open")
        ).first()
        if not row["open"]:
            break
        higher = (wanted - (row["fixed"] or 0.0)) / row["open"]
        if higher <= level:
            break
        level = higher
    return weighted.withColumn(
        "target", F.least(F.col("weight") * level, cap.cast("double"))
    )


def plan_mixture(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[float, ...] = (1, 2, 3),
    most: int = 3,
    block_words: int = 65_536,
    block_rows: int = 65_536,
    shard_words: int = 4_194_304,
    seed: int = 0,
) -> Mixture:
    """Targets, block quotas and the shard of every draw.

    The sources themselves are listed in one row at the root of the tree, so there should be
    thousands of them at most; their rows, blocks and draws are tables and may be any number.

    * A null text has size 0; a null source is a source of its own, last in order.
    * A source without words has target 0 and no draw.
    * Rows alike in id and text share a block and an order, and are taken alike.
    * An empty table has no sources, draws or rows. Extra columns are ignored.
    """
    sized = materialize(_sized(documents, id_col, text_col, source_col), "sized")
    totals = sized.groupBy("source_key").agg(
        F.sum("size").alias("source_size"), F.count("*").alias("rows")
    )
    ranked = with_rank(totals, ["source_key"], "place")
    targets = source_targets(ranked, weights, most)
    ratio = F.col("target") / F.col("source_size")
    blocks = F.greatest(
        F.ceil(F.col("source_size") / block_words), F.ceil(F.col("rows") / block_rows), F.lit(1)
    )
    passes = F.when(F.col("source_size") > 0, F.least(F.floor(ratio), F.lit(most))).otherwise(0)
    left = F.col("target") - F.col("passes") * F.col("source_size")
    sources = materialize(
        targets.withColumn("blocks", blocks.cast("bigint"))
        .withColumn("passes", passes.cast("bigint"))
        .withColumn("left_words", F.greatest(left, F.lit(0.0))),
        "sources",
    )
    sources = materialize(sources.join(_last_pass(sized, sources, seed), "place", "left"), "mix")
    draws, shards = _dealt(sources, shard_words, seed)
    return Mixture(sized, sources, materialize(draws, "draws"), shards)


def _block_at(place: Column, source: Column, number: Column, blocks: Column, seed: int) -> Column:
    """The block at a place of the permutation for a source and pass."""
    steps = F.array(*[F.lit(step) for step in _STEPS])
    chosen = F.pmod(F.xxhash64(F.lit(f"step {seed}"), source, number), F.lit(len(_STEPS)))
    start = F.pmod(F.xxhash64(F.lit(f"start {seed}"), source, number), blocks)
    return F.pmod(place * F.pmod(steps[chosen.cast("int")], blocks) + start, blocks)


def _in_blocks(sized: DataFrame, sources: DataFrame) -> DataFrame:
    """Rows with the place of their source and their block in it."""
    return sized.join(sources, "source_key").withColumn(
        "block", F.pmod("row_key", F.col("blocks"))
    )


def _last_pass(sized: DataFrame, sources: DataFrame, seed: int) -> DataFrame:
    """``place, whole, cut_key``: how far the last pass of each source goes.

    It takes ``whole`` blocks, and of the next one the rows whose key is in a range of
    ``cut_key``.
    Sums over a source go by cells of about the square root of its number of blocks, then by
    the blocks of one cell, then by the rows of one block, so that no window grows with it.
    """
    wanted = sources.where("left_words > 0").select(
        "source_key", "place", "blocks", "passes", "left_words"
    )
    block_sizes = materialize(
        _in_blocks(sized, wanted).groupBy("place", "block").agg(F.sum("size").alias("words")),
        "blocks",
    )
    cell_size = F.ceil(F.sqrt("blocks")).cast("bigint")
    # Cells first, then the spots of each: no row lists all blocks of a source.
    cells = F.sequence(F.lit(0).cast("bigint"), F.ceil(F.col("blocks") / F.col("cell_size")).cast("bigint") - 1)
    first = F.col("cell") * F.col("cell_size")
    spots = F.sequence(first, F.least(first + F.col("cell_size"), F.col("blocks")) - 1)
    placed = (
        wanted.withColumn("cell_size", cell_size)
        .select("*", F.explode(cells).alias("cell"))
        .repartition("place", "cell")
        .select("*", F.explode(spots).alias("spot"))
        .withColumn(
            "block",
            _block_at(F.col("spot"), F.col("place"), F.col("passes"), F.col("blocks"), seed),
        )
        .join(block_sizes, ["place", "block"], "left")
        .select(
            "place", "spot", "block", "left_words",
            F.coalesce("words", F.lit(0)).alias("words"),
            "cell",
        )
    )
    placed = materialize(placed, "placed-blocks")
    cells = placed.groupBy("place", "cell").agg(
        F.sum("words").alias("words"), F.first("left_words").alias("left_words")
    )
    crossed = _crossing(cells, "cell", F.lit(0)).select("place", "cell", "before")
    inside = placed.join(crossed, ["place", "cell"])
    block = _crossing(inside, "spot", F.col("before")).select(
        "place", "block", F.col("spot").alias("whole"), (F.col("left_words") - F.col("before")).alias("room")
    )
    block = materialize(block, "last-blocks")
    rows = _in_blocks(sized, sources.select("source_key", "place", "blocks")).join(
        block, ["place", "block"]
    )
    # In the order of their keys all rows that still fit, then the one that fills the rest best.
    entry = F.struct("row_key", "size")
    listed = (
        rows.groupBy("place", "row_key")
        .agg(F.sum("size").alias("size"), F.first("room").cast("double").alias("room"))
        .where("size > 0")
        .groupBy("place")
        .agg(F.array_sort(F.collect_list(entry)).alias("rows"), F.first("room").alias("room"))
    )
    cuts = listed.select("place", _filled(F.col("rows"), F.col("room")).alias("cut_key"))
    cuts = cuts.withColumn("cut_key", F.when(F.size("cut_key") > 0, F.col("cut_key")))
    return block.select("place", "whole").join(cuts, "place", "left")


def _filled(rows: Column, room: Column) -> Column:
    """Ranges of keys ``low, high`` of the rows that fill ``room``, tried one after the other.

    A row that does not fit is passed over and the next ones are tried, so that every row left
    out is larger than what is left; the smallest of them is added if that comes nearer. So the
    miss is at most half the smallest row left out. A range ends where a row larger than the
    room left is passed over, so there are few: their number times the room passed over is less
    than the words of the block.
    """
    no_key, no_row = F.lit(None).cast("bigint"), F.lit(None).cast("struct<size:bigint,row_key:bigint>")
    none = F.array().cast("array<struct<low:bigint,high:bigint>>")

    def state(room, low, high, ranges, least):
        return F.struct(
            room.alias("room"), low.alias("low"), high.alias("high"),
            ranges.alias("ranges"), least.alias("least"),
        )

    def with_range(s: Column) -> Column:
        own = F.array(F.struct(s["low"].alias("low"), s["high"].alias("high")))
        return F.when(s["low"].isNull(), s["ranges"]).otherwise(F.concat(s["ranges"], own))

    def step(s: Column, row: Column) -> Column:
        key, size = row["row_key"], row["size"].cast("bigint")
        passed = F.struct(size.alias("size"), key.alias("row_key"))
        smaller = s["least"].isNull() | (size < s["least"]["size"])
        return F.when(
            size <= s["room"],
            state(s["room"] - size, F.coalesce(s["low"], key), key, s["ranges"], s["least"]),
        ).otherwise(
            state(
                s["room"], no_key, no_key, with_range(s),
                F.when(smaller, passed).otherwise(s["least"]),
            )
        )

    def end(s: Column) -> Column:
        extra = s["least"]["row_key"]
        nearer = s["least"]["size"] - s["room"] < s["room"]
        own = F.array(F.struct(extra.alias("low"), extra.alias("high")))
        return F.when(nearer, F.concat(with_range(s), own)).otherwise(with_range(s))

    return F.aggregate(rows, state(room, no_key, no_key, none, no_row), step, end)


def _crossing(frame: DataFrame, order: str, start: Column) -> DataFrame:
    """Per ``place`` the row in which the running sum passes ``left_words``, and the sum before."""
    window = Window.partitionBy("place").orderBy(order)
    upto = F.sum("words").over(window) + start
    passed = frame.withColumn("_upto", upto).withColumn("before", F.col("_upto") - F.col("words"))
    first = F.row_number().over(window)
    return (
        passed.where(F.col("_upto") >= F.col("left_words"))
        .withColumn("_first", first)
        .where("_first = 1")
        .drop("_first", "_upto")
    )


def hypergeometric(total: Column, marked: Column, drawn: Column, chance: Column) -> Column:
    """The number of marked among ``drawn`` of ``total``, by inversion of its distribution.

    Walks twelve standard deviations to either side of the mode, beyond which nothing that a
    double can show is left; ``chance`` is uniform in [0, 1).
    """
    total, marked, drawn = (value.cast("double") for value in (total, marked, drawn))
    other = F.greatest(total, F.lit(1.0))
    lowest = F.greatest(F.lit(0.0), drawn - (total - marked))
    highest = F.least(drawn, marked)
    mode = F.floor((drawn + 1) * (marked + 1) / (total + 2))
    spread = F.sqrt(
        drawn * (marked / other) * ((total - marked) / other) * (total - drawn)
        / F.greatest(total - 1, F.lit(1.0))
    )
    reach = F.ceil(12 * spread) + 2
    first = F.least(F.greatest(lowest, mode - reach), highest)
    last = F.greatest(F.least(highest, mode + reach), first)
    steps = F.sequence(first.cast("bigint"), last.cast("bigint"))

    def onward(at: Column, weight: Column) -> Column:
        return weight * (marked - at) * (drawn - at) / ((at + 1) * (total - marked - drawn + at + 1))

    start = F.struct(F.lit(1.0).alias("weight"), F.lit(0.0).alias("sum"))
    mass = F.aggregate(
        steps,
        start,
        lambda s, at: F.struct(
            onward(at, s["weight"]).alias("weight"), (s["sum"] + s["weight"]).alias("sum")
        ),
        lambda s: s["sum"],
    )
    begin = F.struct(
        F.lit(1.0).alias("weight"), (mass * chance).alias("left"), first.cast("bigint").alias("pick")
    )
    return F.aggregate(
        steps,
        begin,
        lambda s, at: F.struct(
            onward(at, s["weight"]).alias("weight"),
            (s["left"] - s["weight"]).alias("left"),
            F.when(s["left"] >= 0, at).otherwise(s["pick"]).alias("pick"),
        ),
        lambda s: s["pick"],
    )


def _split(counts: Column, node: Column, half: Column, total: Column, seed: int) -> Column:
    """How many draws of each source go left, source after source."""
    start = F.struct(
        total.alias("total"), half.alias("room"), F.array().cast("array<bigint>").alias("left")
    )

    def take(state: Column, entry: Column) -> Column:
        bits = F.pmod(F.xxhash64(F.lit(f"split {seed}"), node, entry["place"]), F.lit(1 << 52))
        left = hypergeometric(
            state["total"], entry["n"], state["room"], bits / float(1 << 52)
        ).cast("bigint")
        return F.struct(
            (state["total"] - entry["n"]).alias("total"),
            (state["room"] - left).alias("room"),
            F.concat(state["left"], F.array(left)).alias("left"),
        )

    return F.aggregate(counts, start, take, lambda state: state["left"])


def _dealt(sources: DataFrame, shard_words: int, seed: int) -> tuple[DataFrame, int]:
    """``place, block, draws`` and the number of shards, a power of two."""
    quota = F.col("passes") * F.col("blocks") + F.when(F.col("whole").isNull(), 0).otherwise(
        F.col("whole") + F.col("cut_key").isNotNull().cast("bigint")
    )
    quotas = sources.select("place", quota.cast("bigint").alias("n"), "target").where("n > 0")
    words = quotas.agg(F.sum("target")).first()[0] or 0
    levels = max(0, ceil(log2(max(1.0, words / shard_words))))
    entry = F.struct("place", "n", F.lit(0).cast("bigint").alias("start"))
    nodes = quotas.agg(F.array_sort(F.collect_list(entry)).alias("counts")).select(
        F.lit(1).cast("bigint").alias("node"), "counts"
    )
    for level in range(levels):
        if level and level % _LEVELS_PER_STAGE == 0:
            nodes = nodes.repartition("node")
        total = F.aggregate("counts", F.lit(0).cast("bigint"), lambda s, e: s + e["n"])
        nodes = nodes.withColumn("total", total).withColumn("half", F.expr("total div 2"))
        nodes = nodes.withColumn(
            "left", _split(F.col("counts"), F.col("node"), F.col("half"), F.col("total"), seed)
        )
        sides = F.array(
            F.struct(
                (F.col("node") * 2).alias("node"),
                F.zip_with(
                    "counts", "left",
                    lambda e, x: F.struct(e["place"].alias("place"), x.alias("n"), e["start"].alias("start")),
                ).alias("counts"),
            ),
            F.struct(
                (F.col("node") * 2 + 1).alias("node"),
                F.zip_with(
                    "counts", "left",
                    lambda e, x: F.struct(
                        e["place"].alias("place"), (e["n"] - x).alias("n"), (e["start"] + x).alias("start")
                    ),
                ).alias("counts"),
            ),
        )
        nodes = nodes.select(F.explode(sides).alias("side")).select(
            "side.node", F.filter("side.counts", lambda e: e["n"] > 0).alias("counts")
        )
    shards = 1 << levels
    leaves = nodes.select((F.col("node") - shards).alias("shard"), F.explode("counts").alias("e"))
    drawn = leaves.select(
        "shard",
        F.col("e.place").alias("place"),
        F.explode(F.expr("sequence(e.start, e.start + e.n - 1)")).alias("draw"),
    ).join(sources.select("place", "blocks", "passes", "whole", "cut_key"), "place")
    number = F.expr("draw div blocks")
    spot = F.col("draw") - F.col("pass") * F.col("blocks")
    draws = drawn.withColumn("pass", number).select(
        "place",
        _block_at(spot, F.col("place"), F.col("pass"), F.col("blocks"), seed).alias("block"),
        F.struct(
            "pass",
            "shard",
            F.when((F.col("pass") == F.col("passes")) & (spot == F.col("whole")), F.col("cut_key")).alias("cut"),
        ).alias("draw"),
    )
    grouped = draws.groupBy("place", "block").agg(
        F.array_sort(F.collect_list("draw")).alias("draws")
    )
    return grouped, shards


def placements(rows: DataFrame, plan: Mixture) -> DataFrame:
    """Add ``source_size``, ``target`` and ``draws`` (one per copy taken) to rows with
    ``source_key`` and ``row_key``."""
    sources = plan.sources.select("source_key", "place", "blocks", "source_size", "target")
    none = F.array().cast(plan.draws.schema["draws"].dataType)

    def fits(draw: Column) -> Column:
        key = F.col("row_key")
        in_cut = F.exists(draw["cut"], lambda part: key.between(part["low"], part["high"]))
        return draw["cut"].isNull() | in_cut

    return (
        _in_blocks(rows, sources)
        .join(plan.draws, ["place", "block"], "left")
        .withColumn("draws", F.coalesce(F.filter("draws", fits), none))
        .drop("place", "block", "blocks")
    )


def mixed(
    documents: DataFrame,
    plan: Mixture,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    seed: int = 0,
) -> DataFrame:
    """The mix: ``shard`` and ``row``, one row per copy taken, each shard shuffled.

    A shard is one or more files' worth of neighbouring rows, in an order by a hash of row,
    pass and shard. The documents must be those that were planned.
    """
    rows = documents.select(
        F.struct(*[column(name) for name in documents.columns]).alias("row"),
        _source_key(column(source_col)).alias("source_key"),
        _row_key(column(id_col), column(text_col)).alias("row_key"),
    )
    copies = placements(rows, plan).select("row", "row_key", F.explode("draws").alias("draw"))
    order = F.xxhash64(F.lit(f"order {seed}"), "row_key", "draw.pass", "draw.shard")
    return (
        copies.select("row", F.col("draw.shard").alias("shard"), order.alias("_order"))
        .repartitionByRange("shard", "_order")
        .sortWithinPartitions("shard", "_order")
        .drop("_order")
    )


def mix(documents: DataFrame, **options) -> DataFrame:
    """``documents`` mixed to target weights; same columns, copies repeated.

    ``options`` go to :func:`plan_mixture`, whose cases hold here too.
    """
    names = {k: v for k, v in options.items() if k in ("id_col", "text_col", "source_col", "seed")}
    result = mixed(documents, plan_mixture(documents, **options), **names)
    return result.select(*[F.col("row")[name].alias(name) for name in documents.columns])
