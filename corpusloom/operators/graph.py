"""Traversals as rounds of joins. Each round's result is checkpointed, so plans stay short and lost executors cost one round."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.session import cut_round


def reach(seeds: DataFrame, edges: DataFrame, depth: int, follow: Column | None = None) -> DataFrame:
    """(id, depth) of all that is reached from the seeds within `depth` steps, each at its least depth.

    seeds: id. edges: src, dst; `follow` says which edges are taken. Breadth first, so a page that is also met late is expanded early.
    """
    if follow is not None:
        edges = edges.where(follow)
    edges = edges.where("src is not null and dst is not null").select("src", "dst")
    frontier = seeds.select("id").where("id is not null").distinct()
    found = cut_round(frontier.withColumn("depth", F.lit(0)))
    for step in range(1, depth + 1):
        # each frontier is written once; what was found before is their union
        new = edges.join(frontier.select(F.col("id").alias("src")), "src", "left_semi").select(F.col("dst").alias("id")).distinct().join(found.select("id"), "id", "left_anti")
        frontier = cut_round(new.withColumn("depth", F.lit(step)))
        if frontier.isEmpty():
            break
        found = found.unionByName(frontier)
    return found


def inherited(nodes: DataFrame, key: str, parent: str, own: str) -> DataFrame:
    """Each node with its path from the root and the values of `own` along it, joined by '/'. Orphans are roots.

    One join a level of the tree; nodes on a cycle are never reached and don't come out.
    """
    keys = nodes.select(F.col(key).alias(parent)).distinct()
    roots = nodes.join(keys, parent, "left_anti")
    level = cut_round(roots.select(key, F.col(key).cast("string").alias("path"), F.coalesce(F.col(own).cast("string"), F.lit("")).alias("values"), F.lit(0).alias("level")))
    out, n = level, 0
    while True:
        n += 1
        up = level.select(F.col(key).alias(parent), F.col("path").alias("_p"), F.col("values").alias("_v"))
        level = nodes.join(up, parent).select(key, F.concat_ws("/", "_p", F.col(key).cast("string")).alias("path"), F.concat_ws("/", "_v", F.coalesce(F.col(own).cast("string"), F.lit(""))).alias("values"), F.lit(n).alias("level"))
        level = cut_round(level)
        if level.isEmpty():
            return out
        out = out.unionByName(level)


def sitemap_tree(files: DataFrame, roots: DataFrame, entries: Callable[[Column], Column], depth: int = 8) -> DataFrame:
    """(loc, lastmod) of all pages that the roots' sitemaps name, through indexes of sitemaps; the first of each loc by what is dated earliest.

    files: url, xml, is_index. roots: url. An index that names itself ends, because each round takes only maps that weren't read before.
    """
    edges = files.where("is_index").select(F.col("url").alias("src"), F.explode(entries(F.col("xml"))).alias("e")).select("src", F.col("e.loc").alias("dst"))
    known = reach(roots.select(F.col("url").alias("id")), edges, depth)
    pages = files.where("not is_index").join(known.select(F.col("id").alias("url")), "url", "left_semi").select(F.explode(entries(F.col("xml"))).alias("e"))
    return pages.groupBy("e.loc").agg(F.min("e.lastmod").alias("lastmod"))


def limited(found: DataFrame, most: int) -> DataFrame:
    """The feature is the cap: a traversal that was asked for at most so many pages gives the nearest, of equally near ones the first by id."""
    return found.orderBy("depth", "id").limit(most)
