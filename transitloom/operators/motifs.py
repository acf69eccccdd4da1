"""Small patterns of named nodes and relations, found by joins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transitloom.operators.skew import HOT_ROWS, HOT_SHARE, skew_join
from transitloom.storage import discard, materialize

Edge = tuple[str, str, str]


def _join_order(pattern: Sequence[Edge], sizes: Mapping[str, int]) -> list[int]:
    """Places of the pattern's edges: the smallest relation first, then always one that touches
    what is there, one with both ends there before others, smaller ones before larger."""
    left, order, bound = set(range(len(pattern))), [], set()
    while left:
        def cost(place):
            a, relation, b = pattern[place]
            known = (a in bound) + (b in bound)
            return (bool(bound) and not known, -known if bound else 0, sizes[relation], place)

        chosen = min(left, key=cost)
        if bound and cost(chosen)[0]:
            raise ValueError("the pattern falls into parts that share no node")
        order.append(chosen)
        left.remove(chosen)
        bound |= {pattern[chosen][0], pattern[chosen][2]}
    return order


def stored_relations(relations: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The different whole edges of each relation as tables, for several searches: ``find_motifs``
    takes them as they are and does not delete them."""
    stored = {}
    for name, frame in relations.items():
        stored[name] = materialize(frame.select("src", "dst").dropna().distinct(), "relation")
        stored[name]._links_differ = True
    return stored


def find_motifs(
    relations: Mapping[str, DataFrame],
    pattern: Sequence[Edge],
    different: Sequence[tuple[str, str]] = (),
    ordered: Sequence[tuple[str, str]] = (),
    hot_rows: int = HOT_ROWS,
    hot_share: float = HOT_SHARE,
) -> DataFrame:
    """Every way to name nodes so that all edges of ``pattern`` exist, one column a name.

    ``relations`` are frames of ``src, dst``; an edge of the pattern is ``(name, relation, name)``,
    and equal names are the same node. ``different`` names must be different nodes, and of each
    pair in ``ordered`` the first must be less, which tells mirror images apart. Both are checked
    as soon as their nodes are there. Edges with NULL ends are none, repeated ones count once.

    Before anything is expanded, every edge of the pattern keeps only what its neighbours can
    continue, there and back along the join order; edges that keep the same by the same steps
    share one table. Joins salt hot nodes.
    """
    used = sorted({relation for _, relation, _ in pattern})
    stored = {name: relations[name] for name in used if getattr(relations[name], "_links_differ", False)}
    own = stored_relations({name: relations[name] for name in used if name not in stored})
    stored |= own
    order = _join_order(pattern, {name: frame.count() for name, frame in stored.items()})
    # Per edge of the pattern a table of ``src, dst``, and how it came about: equal ways, equal rows.
    tables, ways, known = {}, {}, {}
    for place in order:
        a, relation, b = pattern[place]
        named = stored[relation].where("src = dst") if a == b else stored[relation]
        named = named.select(*{a: F.col("src").alias(a), b: F.col("dst").alias(b)}.values())
        kept = _checked(named, different, ordered, set())
        ends = F.col(f"`{a}`").alias("src"), F.col(f"`{b}`").alias("dst")
        tables[place] = kept.select(*ends)
        special = kept is not named or a == b
        ways[place] = (relation, place if special else None)

    def reduce_along(places):
        for at, place in enumerate(places):
            reduced, way = tables[place], ways[place]
            sides = dict(zip(pattern[place][::2], ("src", "dst")))
            for other in places[:at]:
                theirs = dict(zip(pattern[other][::2], ("src", "dst")))
                for name in sorted(sides.keys() & theirs.keys()):
                    if ways[other] == way and theirs[name] == sides[name]:
                        continue  # the same rows have the same ends
                    ends = tables[other].select(F.col(theirs[name]).alias(sides[name])).distinct()
                    reduced = reduced.join(ends, sides[name], "left_semi").select("src", "dst")
                    way = (way, sides[name], ways[other], theirs[name])
            if way != ways[place]:
                if way not in known:
                    known[way] = materialize(reduced, "reduced")
                tables[place], ways[place] = known[way], way

    reduce_along(order)
    reduce_along(order[::-1])
    parts = {}
    for place in order:
        a, _, b = pattern[place]
        parts[place] = tables[place].select(*{a: F.col("src").alias(a), b: F.col("dst").alias(b)}.values())
    found = parts[order[0]]
    for place in order[1:]:
        shared = sorted(set(found.columns) & set(parts[place].columns))
        before = set(found.columns)
        joined = skew_join(found, parts[place], shared, "inner", hot_rows, hot_share)
        # Stored, since the next join looks for its hot keys first.
        found = materialize(_checked(joined, different, ordered, before), "motifs")
    if len(order) > 1:  # else the result reads the relation itself
        for frame in own.values():
            discard(frame)
    names = list(dict.fromkeys(name for a, _, b in pattern for name in (a, b)))
    return found.select(*names)


def _checked(frame, different, ordered, before):
    """Rows that keep the conditions whose names are all there, and were not ``before``."""
    names = set(frame.columns)
    for conditions, sign in ((different, "<>"), (ordered, "<")):
        for a, b in conditions:
            if {a, b} <= names and not {a, b} <= before:
                frame = frame.where(f"`{a}` {sign} `{b}`")
    return frame
