"""Queries over the project's tables for the problems of training text, and their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import history, leakage, packing, pagebody, splitting, truncation
from corpusloom.session import shared_dir
from corpusloom.sources.tables import table

SECTION_LIMIT, PART_LIMIT, OVERLAP = 16_000, 8_192, 200


def _section_limit() -> Column:
    return F.when(F.col("doc_type") == "structured", SECTION_LIMIT).otherwise(PART_LIMIT)


def _pieces(spark: SparkSession, folder: str, with_text: bool) -> DataFrame:
    limit = _section_limit()
    sections = splitting.split_oversized(table(spark, folder, "doc_sections"), "sec_id", "text", limit, OVERLAP, with_text)
    documents = splitting.split_oversized(table(spark, folder, "documents"), "doc_id", "text", PART_LIMIT, OVERLAP, with_text)
    return sections.withColumn("item_table", F.lit("doc_sections")).unionByName(documents.withColumn("item_table", F.lit("documents")))


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return _pieces(spark, folder, with_text=False).where((F.col("piece_no") == 0) & (F.col("n_pieces") > 1)).select("item_table", "item_id")


def p1_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """The pieces themselves, in order, with the kind of boundary at which each ends."""
    return _pieces(spark, folder, with_text=True).select("item_table", "item_id", "piece_no", "n_pieces", "start", "end", "boundary", "piece_text")


def p1_restored(spark: SparkSession, folder: str) -> DataFrame:
    """Each oversized item put together again from its pieces, with what must hold of them."""
    pieces = _pieces(spark, folder, with_text=True)
    part = F.struct("piece_no", F.when(F.col("piece_no") == 0, F.col("piece_text")).otherwise(F.substring("piece_text", OVERLAP + 1, SECTION_LIMIT)).alias("own"))
    items = pieces.groupBy("item_table", "item_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(part)), lambda p: p["own"]), "").alias("text"),
        F.max(F.col("end") - F.col("start")).alias("longest"),
        F.max("n_pieces").alias("n_pieces"),
        F.count("*").alias("n"),
    )
    limits = table(spark, folder, "doc_sections").select(F.lit("doc_sections").alias("item_table"), F.col("sec_id").alias("item_id"), _section_limit().alias("most"))
    most = F.coalesce("most", F.lit(PART_LIMIT))
    least = F.ceil((F.length("text") - OVERLAP) / (most - OVERLAP))
    few = (F.col("n_pieces") == F.col("n")) & (F.col("n_pieces") >= least) & (F.col("n_pieces") <= least + F.greatest(F.lit(1), F.floor(least * splitting.SURPLUS)))
    return items.join(limits, ["item_table", "item_id"], "left").select("item_table", "item_id", F.md5("text").alias("text_md5"), (F.col("longest") <= most).alias("within_limit"), few.alias("few_pieces"))


P1_RESTORED = f"""
SELECT 'doc_sections' AS item_table, sec_id AS item_id, md5(text) AS text_md5, true AS within_limit, true AS few_pieces FROM doc_sections
WHERE length(text) > CASE WHEN doc_type = 'structured' THEN {SECTION_LIMIT} ELSE {PART_LIMIT} END
UNION ALL
SELECT 'documents' AS item_table, doc_id AS item_id, md5(text) AS text_md5, true AS within_limit, true AS few_pieces FROM documents WHERE length(text) > {PART_LIMIT}
"""


P1_FOUND = f"""
SELECT 'doc_sections' AS item_table, sec_id AS item_id FROM doc_sections
WHERE length(text) > CASE WHEN doc_type = 'structured' THEN {SECTION_LIMIT} ELSE {PART_LIMIT} END
UNION ALL
SELECT 'documents' AS item_table, doc_id AS item_id FROM documents WHERE length(text) > {PART_LIMIT}
"""


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return pagebody.main_lines(table(spark, folder, "page_elements"), table(spark, folder, "manifest").select("doc_id", "url"))


def _paired(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("doc_id", "other").alias("doc_id_a"), F.greatest("doc_id", "other").alias("doc_id_b"))


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    """All batches as one load."""
    return _paired(history.repeats(table(spark, folder, "documents"), "doc_id", "text", "batch_no"))


def p4_loads(spark: SparkSession, folder: str) -> DataFrame:
    """The same with every batch a load of its own, compared with what the history keeps of those before; the history begins empty."""
    documents = table(spark, folder, "documents")
    kept = history.History(spark, f"{shared_dir(spark)}/history-{uuid.uuid4().hex}")
    out = None
    # a handful of batches
    for b in sorted((r[0] for r in documents.select("batch_no").distinct().collect()), key=lambda b: (b is not None, b)):
        pairs = kept.add(documents.where(F.col("batch_no").eqNullSafe(F.lit(b))), "doc_id", "text", "batch_no")
        out = pairs if out is None else out.unionByName(pairs)
    kept.drop()
    return _paired(out if out is not None else history.repeats(documents, "doc_id", "text", "batch_no"))


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    """The documents that the layout had to divide."""
    return p6_containers(spark, folder).where((F.col("piece_no") == 0) & (F.col("n_pieces") > 1)).select(F.col("item_id").alias("doc_id"))


def p6_containers(spark: SparkSession, folder: str) -> DataFrame:
    return packing.containers(table(spark, folder, "documents"), "doc_id", "text")


def p6_fill(spark: SparkSession, folder: str) -> DataFrame:
    """How many containers are filled to which percentage."""
    fill = p6_containers(spark, folder).groupBy("container_id").agg(F.sum("n_tokens").alias("n_tokens"))
    return fill.groupBy(F.floor(F.col("n_tokens") * 100 / packing.CAPACITY).alias("percent")).agg(F.count("*").alias("n_containers"), F.sum("n_tokens").alias("n_tokens"))


def p6_search(spark: SparkSession, folder: str) -> DataFrame:
    """What the local search adds to best fit."""
    return packing.search_effect(table(spark, folder, "documents"), "doc_id", "text")


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs with a run of shared words; those that are only similar stay in p7_leaks."""
    return p7_leaks(spark, folder).where(F.col("n_words") >= leakage.WORDS).select("item_id", "doc_id").distinct()


def p7_leaks(spark: SparkSession, folder: str) -> DataFrame:
    """Every leak, whole or with edits: the longest run of shared words, the score and the edits of its best passage."""
    return leakage.leaks(table(spark, folder, "documents"), "doc_id", "text", table(spark, folder, "eval_items"), "item_id", "item_text")


_WORDS = "regexp_extract_all(lower(strip_accents({0})), '[\\p{{L}}\\p{{N}}]+')"
P7_FOUND = f"""
WITH d AS (SELECT doc_id, {_WORDS.format("text")} AS w FROM documents),
     i AS (SELECT item_id, {_WORDS.format("item_text")} AS w FROM eval_items),
     iw AS (SELECT DISTINCT item_id, array_to_string(w[k:k + 11], ' ') AS g FROM i, LATERAL (SELECT unnest(range(1, len(w) - 10)) AS k)),
     dw AS (SELECT doc_id, array_to_string(w[k:k + 11], ' ') AS g FROM d, LATERAL (SELECT unnest(range(1, len(w) - 10)) AS k))
SELECT DISTINCT item_id, doc_id FROM dw JOIN iw USING (g)
"""


P4_FOUND = f"""WITH RECURSIVE d AS (SELECT doc_id, coalesce(batch_no, -1) AS b, {_WORDS.format("text")} AS w FROM documents WHERE text IS NOT NULL),
s AS MATERIALIZED (SELECT DISTINCT doc_id, b, array_to_string(w[k:k + 2], ' ') AS g FROM d, LATERAL (SELECT unnest(range(1, len(w) - 1)) AS k)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS MATERIALIZED (SELECT x.doc_id AS later, y.doc_id AS earlier FROM s x JOIN s y ON x.g = y.g AND (y.b, y.doc_id) < (x.b, x.doc_id) JOIN n a ON a.doc_id = x.doc_id JOIN n c ON c.doc_id = y.doc_id GROUP BY ALL HAVING 3 * count(*) >= 2 * (any_value(a.n) + any_value(c.n) - count(*))),
o AS MATERIALIZED (SELECT doc_id, row_number() OVER (ORDER BY b, doc_id) AS i FROM (SELECT DISTINCT doc_id, b FROM d) WHERE doc_id IN (SELECT later FROM p)),
l AS MATERIALIZED (SELECT later, list(earlier) AS e FROM p GROUP BY 1),
r(i, rejected) AS (SELECT 0::BIGINT, []::BIGINT[] UNION ALL SELECT r.i + 1, CASE WHEN len(list_filter(l.e, lambda x: NOT list_contains(r.rejected, x))) > 0 THEN list_append(r.rejected, o.doc_id) ELSE r.rejected END FROM r JOIN o ON o.i = r.i + 1 JOIN l ON l.later = o.doc_id)
SELECT least(later, earlier) AS doc_id_a, greatest(later, earlier) AS doc_id_b FROM p WHERE NOT list_contains((SELECT max_by(rejected, i) FROM r), earlier)
"""


def p7_runs(spark: SparkSession, folder: str) -> DataFrame:
    """The longest run of shared words of every leak without an edit."""
    return p7_leaks(spark, folder).where("n_words > 0").groupBy("item_id", "doc_id").agg(F.max("n_words").alias("n_words"))


P7_RUNS = f"""
WITH d AS (SELECT doc_id, {_WORDS.format("text")} AS w FROM documents),
     i AS (SELECT item_id, {_WORDS.format("item_text")} AS w FROM eval_items),
     iw AS (SELECT DISTINCT item_id, array_to_string(w[k:k + 11], ' ') AS g FROM i, LATERAL (SELECT unnest(range(1, len(w) - 10)) AS k)),
     dw AS (SELECT doc_id, k, array_to_string(w[k:k + 11], ' ') AS g FROM d, LATERAL (SELECT unnest(range(1, len(w) - 10)) AS k)),
     h AS (SELECT item_id, doc_id, k - row_number() OVER (PARTITION BY item_id, doc_id ORDER BY k) AS island FROM dw JOIN iw USING (g)),
     r AS (SELECT item_id, doc_id, count(*) + 11 AS n FROM h GROUP BY item_id, doc_id, island)
SELECT item_id, doc_id, max(n)::INTEGER AS n_words FROM r GROUP BY ALL
"""


def p8_scores(spark: SparkSession, folder: str) -> DataFrame:
    return truncation.scored(table(spark, folder, "documents"), "doc_id", "text", "source")


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    return p8_scores(spark, folder).where("is_cut").select("doc_id")


def p8_rates(spark: SparkSession, folder: str) -> DataFrame:
    return truncation.rates(p8_scores(spark, folder))


def queries() -> dict:
    return {f.__name__: f for f in (p1_found, p1_pieces, p1_restored, p3_found, p4_found, p4_loads, p6_found, p6_containers, p6_fill, p6_search, p7_found, p7_leaks, p7_runs, p8_found, p8_scores, p8_rates)}


def oracle_sql() -> dict[str, str]:
    return {"p1_found": P1_FOUND, "p1_restored": P1_RESTORED, "p4_found": P4_FOUND, "p4_loads": P4_FOUND, "p7_found": P7_FOUND, "p7_runs": P7_RUNS}
