"""Connected components of link tables in which one node may have a third of all links."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StringType

from corpuslens.session import durable

MAX_ROUNDS = 60
FEW_LINKS = 200_000
#: So many times more leaders in every round of `led_links`.
MORE_LEADERS = 16


def _trees(links: pa.Table) -> pa.Table:
    """`components` of a small table, by numbers in the order of the ids."""
    ends = pa.chunked_array([*links.column("a").chunks, *links.column("b").chunks], links.schema.field("a").type)
    ids = pc.unique(ends).sort()
    a, b = (pc.index_in(links.column(c), ids).to_numpy() for c in ("a", "b"))
    root = np.arange(len(ids))
    while True:
        low = np.minimum(root[a], root[b])
        hung = root.copy()
        np.minimum.at(hung, root[a], low)
        np.minimum.at(hung, root[b], low)
        while (hung[hung] != hung).any():
            hung = hung[hung]
        hung = hung[root]
        if (hung == root).all():
            return pa.table({"id": ids, "root": ids.take(pa.array(root))})
        root = hung


def components(links: DataFrame) -> DataFrame:
    """(id, root) for every id in `links` (a, b): root is the smallest id of its component.

    Each round hangs every root on the smallest root it is linked to, shortens the chains, and replaces links by
    links between roots until none is left. Joins only meet stored tables, so adaptive execution can split an id
    with very many links; everything else is a partial aggregate. Up to FEW_LINKS links are connected at once on the
    driver, as a round costs some ten jobs.
    """
    live = durable(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    if live.schema["a"].dataType == live.schema["b"].dataType and isinstance(live.schema["a"].dataType, IntegralType | StringType):
        few = live.limit(FEW_LINKS + 1).toArrow()
        if few.num_rows <= FEW_LINKS:
            kind = live.schema["a"].dataType.simpleString()
            return live.sparkSession.createDataFrame(_trees(few), f"id {kind}, root {kind}")
    ids = live.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    trees = durable(ids.select("id", F.col("id").alias("root")))
    for _ in range(MAX_ROUNDS):
        if live.isEmpty():
            return trees
        # A root's new parent is its smallest neighbour or itself, so chains of parents go down and end.
        hung = live.select(F.col("b").alias("id"), F.col("a").alias("root")).groupBy("id").agg(F.min("root").alias("root"))
        hung = durable(hung)
        while True:
            up = hung.select(F.col("id").alias("root"), F.col("root").alias("up"))
            nearer = durable(hung.join(up, "root", "left").select("id", F.coalesce("up", "root").alias("root"), F.col("up").isNotNull().alias("moved")))
            hung = nearer.drop("moved")
            if nearer.where("moved").isEmpty():
                break
        # Every id whose root was hung moves on with it.
        step = hung.select(F.col("id").alias("root"), F.col("root").alias("up"))
        trees = durable(trees.join(step, "root", "left").select("id", F.coalesce("up", "root").alias("root")))
        first = durable(live.join(hung.withColumnRenamed("id", "a"), "a", "left").select(F.coalesce("root", "a").alias("a"), "b"))
        both = first.join(hung.withColumnRenamed("id", "b"), "b", "left").select("a", F.coalesce("root", "b").alias("b"))
        live = durable(both.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")


def joined(groups: DataFrame, links: DataFrame) -> DataFrame:
    """`groups` (id, root) after more links (a, b): only the roots that the links connect are searched anew."""
    if links.isEmpty():
        return groups
    first = links.join(groups.select(F.col("id").alias("a"), F.col("root").alias("ra")), "a", "left")
    both = durable(first).join(groups.select(F.col("id").alias("b"), F.col("root").alias("rb")), "b", "left")
    between = both.select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b"))
    moved = components(between).select(F.col("id").alias("root"), F.col("root").alias("up"))
    old = groups.join(moved, "root", "left").select("id", F.coalesce("up", "root").alias("root"))
    new = moved.select(F.col("root").alias("id"), F.col("up").alias("root"))
    return durable(old.unionByName(new.join(groups, "id", "left_anti")))


def led_links(
    members: DataFrame, verified: Callable[[DataFrame], DataFrame], narrowed: Callable[[DataFrame], DataFrame] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(links, groups): the links (a, b, ...) that `verified` finds among pairs (a, b) of `members` (band, doc_id), and
    `components` of them.

    Documents of a band are candidates, and a band may hold very many. Each is compared with the band's leader (its
    smallest id). What a band still holds of different groups is compared with 1, 16, 256, ... further leaders a
    round, until every document that is not in the group of the first leader has been leader. So the pairs made follow the
    members plus the failed comparisons, and no candidate pair of different groups is left out.

    `narrowed` maps the groups of the first leaders to the bands (band, doc_id) in which documents of different groups
    may still be linked, where that is less than all; these bands begin with leaders of their own.
    """
    bands = durable(members)
    shared = durable(bands.groupBy("band").agg(F.min("doc_id").alias("leader"), F.count(F.lit(1)).alias("n")).where("n > 1").select("band", "leader"))
    members = durable(bands.join(shared, "band"))
    pairs = durable(members.where("doc_id <> leader").select(F.col("leader").alias("a"), F.col("doc_id").alias("b")).distinct())
    links = durable(verified(pairs))
    tested = pairs
    groups = components(links.select("a", "b"))
    lanes = 1
    led = shared.select("band", F.col("leader").alias("doc_id"))
    if narrowed is not None:
        bands = narrowed(groups)
        members = durable(bands.join(bands.groupBy("band").agg(F.min("doc_id").alias("leader")), "band"))
        led = members.limit(0).select("band", "doc_id")
    while True:
        named = durable(members.join(groups.withColumnRenamed("id", "doc_id"), "doc_id", "left")
                        .select("band", "doc_id", "leader", F.coalesce("root", "doc_id").alias("root")))
        of_leader = groups.select(F.col("id").alias("leader"), F.col("root").alias("leader_root"))
        apart = durable(named.join(of_leader, "leader", "left").where(F.col("root") != F.coalesce("leader_root", "leader")).select("band", "doc_id", "root"))
        left = durable(apart.join(led, ["band", "doc_id"], "left_anti"))
        if left.isEmpty():
            return links, groups
        lane = F.pmod(F.xxhash64("doc_id", "band"), F.lit(lanes))
        heads = durable(left.groupBy("band", lane.alias("lane")).agg(F.min(F.struct("doc_id", "root")).alias("h")).select("band", F.col("h.doc_id").alias("head"), F.col("h.root").alias("head_root")))
        led = durable(led.unionByName(heads.select("band", F.col("head").alias("doc_id"))))
        met = named.join(heads, "band").where("root <> head_root")
        pairs = durable(met.select(F.least("head", "doc_id").alias("a"), F.greatest("head", "doc_id").alias("b")).distinct())
        pairs = durable(pairs.join(tested, ["a", "b"], "left_anti"))
        tested = durable(tested.unionByName(pairs))
        more = durable(verified(pairs))
        if not more.isEmpty():
            links = durable(links.unionByName(more))
            groups = components(links.select("a", "b"))
        lanes *= MORE_LEADERS
