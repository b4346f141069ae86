"""As-of join on two time axes: what happened by one time, as it was known at another."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadlake.functions.timefns import DAY
from loadlake.operators.asof import asof_join
from loadlake.operators.blocks import numbered, same_keys
from loadlake.sources.tables import stored

#: Children of a node of the search tree; a node is one row that holds so many pairs of numbers at most.
FANOUT = 64


def known_asof_join(
    left: DataFrame,
    versions: DataFrame,
    keys: Sequence[str],
    left_ts: str,
    origin_ts: str,
    event_ts: str,
    known_ts: str,
    block_seconds: int = DAY,
    fanout: int = FANOUT,
) -> DataFrame:
    """Each row of ``left`` with the newest event at or before ``left_ts``, as it was known at ``origin_ts``.

    ``versions`` has a row for each value an event has had: when the event was
    (``event_ts``) and when that value became known (``known_ts``). An event
    counts from its first version on, and of its versions the newest known at
    the origin counts, so a correction changes only what is asked after it. No
    value is used that became known after the origin. The columns of
    ``versions`` besides ``keys`` are NULL without a match. Of versions of one
    event and one time of knowledge the largest in the other columns counts.
    Versions with a NULL key or time are left out; rows of ``left`` stay, each
    once, with NULL keys or times and repeated, too. An empty ``versions``
    matches nothing.

    Looking up either axis alone is an as-of join; both together are not, since
    the newest events may all have come late. The events of a key are numbered
    in time order and become the leaves of a tree of ``fanout`` children, each
    node with the earliest time of knowledge below it. A row whose newest event
    by its time was known at its origin is settled, which nearly all are, and
    meets no tree. Any other starts at that leaf, looks to the left of it among its
    siblings for a node that was known by its origin, goes a level up while
    there is none, and then down again along the last child that was. Rows
    that are settled wait, so most of them need one level. A level is one join
    with a row per node, of bounded size, and does not depend on other rows of
    ``left``: a key may have any share of them, and no key is held by a task.
    """
    names = [c for c in versions.columns if c not in keys]
    versions = stored(versions.dropna(subset=[*keys, event_ts, known_ts]), "versions")
    events = versions.groupBy(*keys, event_ts).agg(F.min(known_ts).alias("_since"))
    events = stored(numbered(events, keys, event_ts, "_leaf", block_seconds), "numbered-events")
    rows = left.select(
        *[F.col(k) for k in keys],
        F.struct(*left.columns).alias("_left"),
        F.col(left_ts).alias("_at"),
        F.col(origin_ts).alias("_origin"),
    )
    leaves = events.select(*keys, F.col(event_ts).alias("_event"), "_leaf", "_since")
    rows = asof_join(rows, leaves, keys, "_at", "_event", block_seconds=block_seconds)
    # Written, so that a row keeps its number and all branches below read the same.
    rows = stored(rows.withColumn("_row", F.monotonically_increasing_id()), "asked")
    settled = F.coalesce(F.col("_since") <= F.col("_origin"), F.lit(False))
    asked = [*keys, "_left", "_origin", "_event"]
    late = rows.where(~settled)
    found = _last_known(late.where(F.col("_leaf").isNotNull()), events, keys, fanout)

    named = [F.col(k) for k in keys]
    at = events.select(*named, F.col("_leaf").alias("_found"), F.col(event_ts).alias("_event"))
    found = found.alias("l").join(at.alias("r"), same_keys("l", "r", [*keys, "_found"])).select("l._row", "r._event")
    found = stored(late.drop("_event").join(found, "_row").select("_row", *asked), "found")
    packed = versions.select(*named, F.col(event_ts).alias("_event"), F.col(known_ts).alias("_known"), F.struct(*names).alias("_version"))
    hit = rows.where(settled).select(*asked).unionByName(found.select(*asked))
    hit = asof_join(hit, packed, [*keys, "_event"], "_origin", "_known", block_seconds=block_seconds, tie_break=["_version"])
    none = late.join(found.select("_row"), "_row", "left_anti").select("_left")
    both = hit.select("_left", "_version").unionByName(none, allowMissingColumns=True)
    return both.select("_left.*", *[F.col(f"_version.{c}").alias(c) for c in names])


def _last_known(rows: DataFrame, events: DataFrame, keys: Sequence[str], fanout: int) -> DataFrame:
    """``rows`` whose key has an event at or before ``_leaf`` first known by ``_origin``, with the newest such leaf as ``_found``."""
    kept = [*keys, "_row", "_origin"]
    levels = [_nodes(events.select(*keys, "_leaf", "_since"), keys, fanout)]
    # Level 0: the leaf itself may be the one.
    open_, settled = rows.select(*kept, F.col("_leaf").alias("_node")), []
    limit = F.col("_node") + 1
    while True:
        up = _among(open_, levels[-1], keys, fanout, limit)
        up = stored(up, "levels")
        settled.append(up.where(F.col("_found").isNotNull()).drop("_node"))
        open_ = up.where(F.col("_found").isNull() & (F.col("_parent") > 0)).select(*kept, F.col("_parent").alias("_node"))
        if open_.isEmpty():
            break
        above = levels[-1].select(*keys, F.col("_parent").alias("_leaf"), F.col("_first").alias("_since"))
        levels.append(_nodes(above, keys, fanout))
        limit = F.col("_node")
    found = settled.pop()
    while settled:
        down = found.select(*kept, F.col("_found").alias("_parent"))
        down = _within(down, levels[len(settled) - 1], keys, F.col("_parent") * fanout + fanout)
        found = settled.pop().select(*kept, "_found").unionByName(down.select(*kept, "_found"))
    return found.select(*kept, "_found")


def _nodes(children: DataFrame, keys: Sequence[str], fanout: int) -> DataFrame:
    """One row per parent: its children as an array of (number, earliest time known), and the earliest of all."""
    parent = F.floor(F.col("_leaf") / fanout).alias("_parent")
    listed = F.sort_array(F.collect_list(F.struct(F.col("_leaf").alias("number"), F.col("_since").alias("since"))))
    nodes = children.groupBy(*keys, parent).agg(listed.alias("_children"), F.min("_since").alias("_first"))
    return stored(nodes, "nodes")


def _among(rows: DataFrame, nodes: DataFrame, keys: Sequence[str], fanout: int, limit: Column) -> DataFrame:
    """``rows`` with the last sibling of ``_node`` before ``limit`` known by ``_origin`` as ``_found``, and their parent."""
    return _within(rows.withColumn("_parent", F.floor(F.col("_node") / fanout)), nodes, keys, limit)


def _within(rows: DataFrame, nodes: DataFrame, keys: Sequence[str], limit: Column) -> DataFrame:
    met = rows.alias("l").join(nodes.alias("r"), same_keys("l", "r", [*keys, "_parent"])).select("l.*", "r._children")
    met = met.withColumn("_limit", limit)
    known = F.filter("_children", lambda c: (c["number"] < F.col("_limit")) & (c["since"] <= F.col("_origin")))
    return met.withColumn("_found", F.try_element_at(known, F.lit(-1))["number"]).drop("_children", "_limit")
