"""Joins and ordered operators that connectors need."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_of(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The first row of each key in order, by an aggregate with partial sums instead of a sorted window."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), order).alias("r")).select(*keys, "r.*")


def associated(parents: DataFrame, links: DataFrame, children: DataFrame, parent: str, child: str, position: str, cap: int = 10) -> DataFrame:
    """Each parent with its primary child (the first that exists) and at most `cap` children in order; missing children are passed over."""
    found = links.join(children.select(child), child, "left_semi")
    # no more than `cap` a parent are collected, however many it has
    place = F.row_number().over(Window.partitionBy(parent).orderBy(position, child))
    listed = found.withColumn("_place", place).where(F.col("_place") <= cap).groupBy(parent).agg(F.sort_array(F.collect_list(F.struct(position, child))).alias("l"))
    ids = F.transform("l", lambda x: x[child])
    return parents.join(listed.select(parent, F.get(ids, F.lit(0)).alias("primary"), F.slice(ids, 1, cap).alias("children")), parent, "left")


def override(base: DataFrame, sidecar: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Columns of a sidecar table take the place of the base's where the sidecar has a value."""
    extra = sidecar.select(key, *[F.col(c).alias(f"_{c}") for c in columns])
    return base.join(extra, key, "left").withColumns({c: F.coalesce(F.col(f"_{c}"), F.col(c)) for c in columns}).drop(*[f"_{c}" for c in columns])


def matched_by_containment(left: DataFrame, right: DataFrame, block: str, a: str, b: str, position: str) -> DataFrame:
    """Names matched within a block: an equal one, else the first by position of which one holds the other. Empty names match nothing.

    Equal names are found by a join; only what is left is tested for containment, within its block (a document's own pictures).
    """
    left, right = left.where(F.col(a) != ""), right.where(F.col(b) != "")
    equal = left.select(block, a).join(right.select(block, F.col(b).alias(a)).distinct(), [block, a], "left_semi").withColumn(b, F.col(a))
    rest = left.select(block, a).join(equal.select(block, a), [block, a], "left_anti")
    held = rest.join(right.select(block, b, position), block).where(F.contains(a, b) | F.contains(b, a))
    return equal.unionByName(held.groupBy(block, a).agg(F.min_by(b, F.struct(position, b)).alias(b))).distinct()


def merged_permissions(own: DataFrame, inherited: DataFrame, keys: list[str], position: str) -> DataFrame:
    """Permissions by type and id; inherited ones win, then the first by position."""
    all_ = own.withColumn("_rank", F.lit(1)).unionByName(inherited.withColumn("_rank", F.lit(0)))
    return first_of(all_.withColumn("_rank", F.struct("_rank", position)), keys, "_rank").drop("_rank")


def substituted(df: DataFrame, key: str, text: str, names: DataFrame, pattern: str, template: str = "@{}") -> DataFrame:
    """Ids in texts replaced by names: ids are taken out, joined, and put back by a fold; unknown ids stay.

    names: id, name. Works on the distinct ids of each text, so the name table may be of any size.
    """
    if key == "id":
        return substituted(df.withColumnRenamed("id", "_key"), "_key", text, names, pattern, template).withColumnRenamed("_key", "id").select(*df.columns)
    head, tail = template.split("{}")
    ids = df.select(key, F.explode(F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))).alias("_whole")).withColumn("id", F.regexp_extract("_whole", pattern, 1))
    pairs = ids.join(names, "id").groupBy(key).agg(F.collect_list(F.struct(F.col("_whole").alias("w"), F.concat(F.lit(head), "name", F.lit(tail)).alias("n"))).alias("_pairs"))
    replaced = F.aggregate(F.array_sort("_pairs"), F.col(text), lambda t, p: F.replace(t, p["w"], p["n"]))
    return df.join(pairs, key, "left").withColumn(text, F.when(F.col("_pairs").isNotNull(), replaced).otherwise(F.col(text))).drop("_pairs")


#: Roles that may read.
READ_ROLES = ("reader", "commenter", "writer", "fileOrganizer", "organizer")


def access_lists(permissions: DataFrame, key: str, position: str) -> DataFrame:
    """Owners, readers, groups and domains of each key as sorted lists, whether anyone has access, and whether a whole organisation has.

    permissions: key, position, id, type, role, email, domain, deleted. Of an id only the first entry by position counts, whatever it says;
    entries without id all count. Deleted ones don't, but they do hide later ones of their id.
    """
    entry = F.struct("type", "role", "email", "domain", "deleted")
    named = permissions.where("id is not null and id <> ''").groupBy(key, "id").agg(F.min_by(entry, position).alias("e"))
    first = named.select(key, "e.*").unionByName(permissions.where("id is null or id = ''").select(key, "type", "role", "email", "domain", "deleted"))
    live = first.where(~F.coalesce(F.col("deleted"), F.lit(False)))
    mail, domain, user = F.nullif(F.lower("email"), F.lit("")), F.nullif(F.lower("domain"), F.lit("")), F.col("type") == "user"

    def listed(when: Column, value: Column) -> Column:
        return F.array_join(F.array_sort(F.collect_set(F.when(when, value))), ",")

    domains = F.col("type") == "domain"
    return live.groupBy(key).agg(
        listed(user & (F.col("role") == "owner"), mail).alias("owners"),
        listed(user & F.col("role").isin(*READ_ROLES), mail).alias("readers"),
        listed(F.col("type") == "group", mail).alias("groups"),
        listed(domains, domain).alias("domains"),
        F.coalesce(F.bool_or(F.col("type") == "anyone"), F.lit(False)).alias("is_public"),
        F.coalesce(F.bool_or(domains & domain.isNotNull()), F.lit(False)).alias("is_org_wide"),
    )
