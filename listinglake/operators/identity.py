"""Duplicate people: links, connected components, survivor choice, rewiring.

Pairs inside a group grow quadratically with the group (a name shared by a third of the
rows would explode), so duplicates are expressed as *star* links: every member of a
(name, linkedin) or (name, twitter) group points at the group's smallest id. The full pair
set is exactly the cliques spanned by those stars. Group minima come from a partial
aggregate; the join back is many-to-one, and AQE splits a hot group's partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.core import completeness, truthy
from ..session import store
from .joins import rewire_bridge
from .keys import default_tasks, spread


def duplicate_links(founders: DataFrame, id_col: str = "id", name: str = "name",
                    via: tuple[str, ...] = ("linkedin", "twitter")) -> DataFrame:
    """``(id, dup_of, via)`` — ``id`` shares the name and a non-empty ``via`` value with the
    smaller id ``dup_of`` (the smallest id of that group). One row per (id, via)."""
    parts = []
    for v in via:
        grp = founders.filter(truthy(F.col(name)) & truthy(F.col(v))).select(id_col, name, v)
        rep = grp.groupBy(name, v).agg(F.min(id_col).alias("dup_of"))
        parts.append(grp.join(spread(rep), [name, v]).filter(F.col(id_col) != F.col("dup_of"))
                        .select(id_col, "dup_of", F.lit(v).alias("via")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


#: links of one task of the exchange below a round's joins
LINKS_PER_TASK = 200_000


def _large_star(edges: DataFrame, tasks: int | None = None) -> DataFrame:
    """Every node links its larger neighbours to the smallest node of its neighbourhood."""
    both = edges.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e")).select("e.*")
    low = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
    return both.join(spread(low, tasks), "a").filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))


def _small_star(edges: DataFrame, tasks: int | None = None) -> DataFrame:
    """Every node links itself and its smaller neighbours to the smallest of them. ``edges``: a > b."""
    low = edges.groupBy("a").agg(F.min("b").alias("low"))
    rest = edges.join(spread(low, tasks), "a").filter("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return rest.unionByName(low.select("a", F.col("low").alias("b"))).distinct()


def edge_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """``(id, component)`` of every node that has an edge; component is the smallest id it is connected to.

    Alternating large-star and small-star rounds over the edges alone: nodes without edges are never looked at, a path of
    n links needs O(log n) rounds, and the edge list does not grow beyond its size. Every round's list is written to the
    shared folder (lineage stays one round long, a lost executor recomputes at most one round); the rounds end when
    the list is stars. The one-row-per-node side of each join has an exchange of its own, so that the links of
    a node with a third of them can be split."""
    def open_nodes(e):
        """Links, and nodes that still have two smaller neighbours or lie between two others: none is left of stars."""
        ends = e.select(F.explode(F.array(F.struct(F.col("a").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("down")),
                                          F.struct(F.col("b").alias("n"), F.lit(0).alias("up"), F.lit(1).alias("down")))).alias("x"))
        per = ends.groupBy("x.n").agg(F.sum("x.up").alias("up"), F.max("x.down").alias("down"))
        return per.agg(F.sum("up"), F.count_if((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0)))).first()

    at = store(edges.select(F.greatest(src, dst).alias("a"), F.least(src, dst).alias("b")).filter("a <> b").distinct(), "links")
    links, unsettled = open_nodes(at)
    while unsettled:
        tasks = min(default_tasks(edges), 1 + links // LINKS_PER_TASK)  # the list never grows: small ones need few
        at = store(_small_star(_large_star(at, tasks), tasks), "links")
        links, unsettled = open_nodes(at)
    return at.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(
        at.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())


def connected_components(nodes: DataFrame, edges: DataFrame, node: str = "id", src: str = "src", dst: str = "dst") -> DataFrame:
    """``(id, component)`` of every node; one without edges is a component of its own."""
    found = edge_components(edges, src, dst).withColumnRenamed("id", node)
    return (nodes.select(node).distinct().join(found, node, "left")
            .select(node, F.coalesce("component", node).alias("component")))


def choose_survivors(founders: DataFrame, components: DataFrame, id_col: str, fields: list[str]) -> DataFrame:
    """Per component: the most complete record (D13), ties → smallest id. Returns the
    mapping ``(old_id, new_id)`` for every member (survivors map to themselves)."""
    members = components.select(F.col("id").alias(id_col), "component")
    scored = founders.join(members, id_col).select(id_col, "component", completeness(fields, founders).alias("_score"))
    best = (scored.groupBy("component")
                  .agg(F.min(F.struct((-F.col("_score")).alias("s"), F.col(id_col).alias("i"))).alias("_b"))
                  .select("component", F.col("_b.i").alias("new_id")))
    return members.join(spread(best), "component").select(F.col(id_col).alias("old_id"), "new_id")


def merge_founders(founders: DataFrame, bridge: DataFrame, id_col: str = "id", name: str = "name",
                   via: tuple[str, ...] = ("linkedin", "twitter"), bridge_id: str = "founderId",
                   bridge_other: str = "companyId", fields: list[str] | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Resolve duplicate links into components, keep one record per component, rewire
    the bridge. Returns ``(founders, bridge, mapping)``; people without a duplicate take no part until the end, where
    the mapping gives them to themselves."""
    fields = fields or [c for c in founders.columns if c != id_col]
    links = duplicate_links(founders, id_col, name, via)
    members = store(choose_survivors(founders, edge_components(links, id_col, "dup_of"), id_col, fields), "survivors")
    moved = members.filter(F.col("old_id") != F.col("new_id"))
    survivors = founders.join(moved.select(F.col("old_id").alias(id_col)), id_col, "left_anti")
    mapping = (founders.select(F.col(id_col).alias("old_id")).distinct().join(members, "old_id", "left")
               .select("old_id", F.coalesce("new_id", "old_id").alias("new_id")))
    return survivors, rewire_bridge(bridge, moved, bridge_id, bridge_other), mapping
