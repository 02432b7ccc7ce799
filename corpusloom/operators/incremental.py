"""Keeping a corpus in step with its sources: fingerprints, change decisions, guarded deletions, upserts.

A manifest says what the corpus holds; everything here is a join of the source's
listing with it.  Unknown signals count as changed, so nothing is skipped on
doubt; deletions are refused on doubt.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import dates, text, urls

MANIFEST = ("doc_id", "fingerprint", "content_hash", "config_sig", "last_updated", "parent_doc_id", "url", "sitemap_lastmod", "pub_date")


def config_signature(config: dict, keys: tuple[str, ...]) -> str:
    """A digest of the settings that change how documents are processed; made once, used as a literal."""
    return hashlib.md5(json.dumps({k: config.get(k) for k in sorted(keys)}, sort_keys=True, separators=(",", ":")).encode()).hexdigest()


def source_tag(explicit: Column, crawler: Column, system: Column) -> Column:
    """An explicit source, else the system of a docs crawler, else 'S3', else the crawler's type."""
    return F.coalesce(F.nullif(explicit, F.lit("")), F.when(crawler == "docs", system).when(crawler == "s3", "S3").otherwise(crawler))


def content_signal(mime: Column, modified: Column, content_hash: Column) -> Column:
    """The modification time of documents that only exist as exports, else the hash of what was read."""
    return F.when(mime.startswith("application/vnd.google-apps."), F.concat(F.lit("gdrive-native:"), modified)).otherwise(content_hash)


def fingerprint(content_hash: Column, metadata: Column, config_sig: Column | str) -> Column:
    """Changes with content, metadata (bookkeeping keys aside) or processing settings."""
    config_sig = F.lit(config_sig) if isinstance(config_sig, str) else config_sig
    kept = F.map_filter(metadata, lambda k, _: ~k.isin(*text.RESERVED_KEYS))
    return F.md5(F.concat_ws("|", F.coalesce(content_hash, F.lit("")), F.coalesce(text.canonical_map(kept), F.lit("{}")), F.coalesce(config_sig, F.lit(""))))


def manifest(listed: DataFrame, order: str, key: str = "id", source: str | None = None) -> DataFrame:
    """One entry a key, the last listed wins; entries without a key don't count. A partial and a final aggregate, no window."""
    rows = listed if source is None else listed.where(F.col("source") == source)
    by = urls.metadata_url(F.col("url")) if key == "url" else F.col("doc_id")
    rows = rows.withColumn("key", by).where("key is not null and key <> ''")
    return rows.groupBy("key").agg(F.max_by(F.struct(*MANIFEST), order).alias("e")).select("key", "e.*")


def unchanged_before_fetch(entry_sig: Column, config_sig: Column | str, stored: Column, current: Column) -> Column:
    """Whether an item can be skipped unread: same settings, a stored signal, and none newer."""
    config_sig = F.lit(config_sig) if isinstance(config_sig, str) else config_sig
    return F.coalesce((entry_sig == config_sig) & (stored != "") & ~dates.is_newer(current, stored), F.lit(False))


def sync_actions(items: DataFrame, held: DataFrame) -> DataFrame:
    """(key, action) of all keys of either side: new, changed, unchanged, delete, or keep for parts of a live document.

    items: key, fingerprint. held: a manifest. One full outer join.
    """
    both = items.select("key", F.col("fingerprint").alias("f")).join(held.select("key", "fingerprint", "parent_doc_id"), "key", "full_outer")
    live = items.select(F.col("key").alias("parent_doc_id"), F.lit(True).alias("parent_live")).distinct()
    known = held.select(F.col("key").alias("parent_doc_id"), F.lit(True).alias("parent_known")).distinct()
    both = both.join(live, "parent_doc_id", "left").join(known, "parent_doc_id", "left")
    sub = F.col("parent_doc_id").isNotNull() & (F.col("parent_live").isNotNull() | F.col("parent_known").isNull())
    action = (
        F.when(F.col("f").isNotNull() & F.col("fingerprint").isNull(), "new")
        .when(F.col("f").isNotNull(), F.when(F.col("f") == F.col("fingerprint"), "unchanged").otherwise("changed"))
        .when(sub, "keep")
        .otherwise("delete")
    )
    return both.select("key", action.alias("action"))


def plan_deletions(held: DataFrame, present: DataFrame, listing_complete: bool, least_ratio: float = 0.5) -> DataFrame:
    """(doc_id, refused) of what the source no longer has; all refused if the listing is incomplete or suspiciously short.

    held: a manifest; present: key. A part of a document lives as long as its parent, or if its parent is unknown.
    The guard needs two counts; they are taken first and stand in the plan as literals.
    """
    keys = present.select("key").distinct()
    at = held.select("key", "doc_id", F.nullif("parent_doc_id", F.lit("")).alias("parent"))
    own = at.join(keys.withColumn("here", F.lit(True)), "key", "left")
    live_ids = own.where("parent is null and here").select(F.col("doc_id").alias("parent"), F.lit(True).alias("by_id")).distinct()
    by_key = keys.select(F.col("key").alias("parent"), F.lit(True).alias("by_key"))
    known = at.select(F.col("doc_id").alias("parent"), F.lit(True).alias("known")).where("parent is not null").distinct()
    judged = own.join(live_ids, "parent", "left").join(by_key, "parent", "left").join(known, "parent", "left")
    alive = F.when(F.col("parent").isNull(), F.col("here").isNotNull()).otherwise(F.col("by_id").isNotNull() | F.col("by_key").isNotNull() | F.col("known").isNull())
    refused = not listing_complete or (least_ratio > 0 and keys.count() < at.where("parent is null").count() * least_ratio)
    return judged.where(~alive).select("doc_id", F.lit(refused).alias("refused"))


def upsert(held: DataFrame, new: DataFrame, key: str, replace: bool = True) -> DataFrame:
    """The table after new rows are put in: with `replace` they take the place of old ones, else old ones stay."""
    if replace:
        return held.join(new.select(key), key, "left_anti").unionByName(new, allowMissingColumns=True)
    return held.unionByName(new.join(held.select(key), key, "left_anti"), allowMissingColumns=True)


def corpus_diff(left: DataFrame, right: DataFrame, key: str, value: str) -> DataFrame:
    """(key, status): only_left, only_right, differs or same; nulls compare equal."""
    both = left.select(key, F.col(value).alias("a"), F.lit(1).alias("l")).join(right.select(key, F.col(value).alias("b"), F.lit(1).alias("r")), key, "full_outer")
    status = F.when(F.col("r").isNull(), "only_left").when(F.col("l").isNull(), "only_right").when(F.col("a").eqNullSafe(F.col("b")), "same").otherwise("differs")
    return both.select(key, status.alias("status"))


def unfinished(items: DataFrame, log: DataFrame, key: str = "doc_id") -> DataFrame:
    """Items without an 'indexed' state yet."""
    return items.join(log.where(F.col("status") == "indexed").select(key).distinct(), key, "left_anti")


def modified_within(items: DataFrame, indexed: DataFrame, modified: str, since: str, key: str = "doc_id") -> DataFrame:
    """Items modified after a moment, as new or updated; an unreadable time is skipped."""
    at = dates.parse_instant(F.col(modified))
    recent = items.where(at > F.unix_micros(F.lit(since).cast("timestamp")))
    return recent.join(indexed.select(key, F.lit(True).alias("_known")).distinct(), key, "left").select(key, F.when(F.col("_known"), "updated").otherwise("new").alias("change"))


def removed(indexed: DataFrame, listed: DataFrame, key: str, listing_complete: bool) -> DataFrame:
    """(key, change): what is indexed and not listed any more; nothing where the listing broke off."""
    gone = indexed.join(listed.select(key), key, "left_anti").select(key, F.lit("removed").alias("change"))
    return gone if listing_complete else gone.where("false")


def stamped(parts: DataFrame, parent: Column, source: Column, incremental: bool) -> DataFrame:
    """Parts of documents with their parent's id and their source, so that they live and die with the parent; untouched in a plain run."""
    return parts.withColumns({"parent_doc_id": parent, "source": source}) if incremental else parts


def listing(pages: DataFrame, corpus: str, status: str, docs: str) -> DataFrame:
    """What the paged listings of corpora hold; a corpus of which any page failed counts as empty, because half a listing would delete the rest."""
    broken = pages.where(F.coalesce(F.col(status) != 200, F.lit(True))).select(corpus).distinct()
    whole = pages.join(broken, corpus, "left_anti")
    return whole.select(corpus, F.explode(docs).alias("doc")).select(corpus, "doc.*")


def pages_until_failure(pages: DataFrame, key: str, number: str, failed: Column) -> DataFrame:
    """The pages of each listing before its first failed one: what was read before that stays."""
    first = pages.where(failed).groupBy(key).agg(F.min(number).alias("_first"))
    return pages.join(first, key, "left").where(F.col("_first").isNull() | (F.col(number) < F.col("_first"))).drop("_first")
