"""Rows to nested documents: sections in order, metadata merged, tables numbered, contexts of pictures."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.text import slug
from corpusloom.operators.split import stripped


def assemble(sections: DataFrame, key: str, order: str, keep_empty: bool = False, normalise: Callable[[Column], Column] | None = None) -> DataFrame:
    """One row a document: its sections in order (text, title, metadata), and its text. Documents without text are dropped.

    normalise: what is done to every text and title before.

    sections: key, order, text, title, metadata. One shuffle by the key; sections are sorted inside the group.
    """
    if normalise:
        sections = sections.withColumns({c: normalise(F.col(c)) for c in ("text", "title")})
    docs = sections.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(F.col(order).alias("k"), F.coalesce("text", F.lit("")).alias("text"), F.coalesce("title", F.lit("")).alias("title"), F.map_entries("metadata").alias("metadata")))).alias("sections"))
    docs = docs.withColumn("full_text", F.array_join(F.transform("sections", lambda s: s["text"]), "\n"))
    return docs if keep_empty else docs.where(stripped(F.array_join(F.transform("sections", lambda s: s["text"]), "")) != "")


def _without(a: Column, b: Column) -> Column:
    return F.map_filter(a, lambda k, _: ~F.map_contains_key(b, k))


def merged_metadata(*maps: Column) -> Column:
    """Maps merged, later ones win, whatever the session's policy for doubled keys."""
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    out = None
    for m in maps:
        m = F.coalesce(m, empty)
        out = m if out is None else F.map_concat(_without(out, m), m)
    return out


def numbered_tables(summaries: Column) -> Column:
    """Tables with a summary, under the number they have among all."""
    all_ = F.transform(summaries, lambda t, i: F.struct(F.concat(F.lit("table_"), i).alias("id"), t.alias("description")))
    return F.filter(all_, lambda t: F.coalesce(F.trim(t["description"]), F.lit("")) != "")


def picture_context(elements: DataFrame, doc: str, order: list[str], kind: str, content: str, before: int = 1, after: int = 1, limit: int = 1_500, text: Callable[[Column], Column] | None = None) -> DataFrame:
    """Every picture with the last `before` and next `after` texts around it, joined by a space, cut at `limit` with dots.

    Running counts number the texts of a document; a picture's neighbours are those with the next lower and higher numbers, so no
    unbounded list is carried along. text: what is taken of a text element's content.
    """
    if text:
        elements = elements.withColumn(content, F.when(F.col(kind) == "text", text(F.col(content))).otherwise(F.col(content)))
    is_text = (F.col(kind) == "text") & (F.trim(F.col(content)) != "")
    at = Window.partitionBy(doc).orderBy(*order)
    numbered = elements.select("*", F.count(F.when(is_text, 1)).over(at).alias("_n"))
    texts = numbered.where(is_text).select(F.col(doc).alias("_d"), F.col("_n").alias("_m"), F.col(content).alias("_t"))
    pictures = numbered.where(F.col(kind) == "image").select(doc, *[c for c in order if c != doc], F.col("_n"))

    def side(name: str, steps: range) -> DataFrame:
        asked = pictures.select("*", F.explode(F.array(*[F.lit(i) for i in steps])).alias("_i")).withColumn("_m", F.col("_n") + F.col("_i"))
        found = asked.join(texts, (asked[doc] == texts["_d"]) & (asked["_m"] == texts["_m"])).groupBy(doc, *[c for c in order if c != doc]).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_i", "_t"))), lambda x: x["_t"]), " ").alias(name))
        return found.withColumn(name, F.when(F.length(name) > limit, F.concat(F.substring(name, 1, limit), F.lit("..."))).otherwise(F.col(name)))

    keys = [doc, *[c for c in order if c != doc]]
    out = pictures.drop("_n")
    out = out.join(side("previous_text", range(1 - before, 1)), keys, "left") if before else out.withColumn("previous_text", F.lit(None).cast("string"))
    return out.join(side("next_text", range(1, after + 1)), keys, "left") if after else out.withColumn("next_text", F.lit(None).cast("string"))


def merge_gaps(segments: Column, threshold: float, longest: float) -> Column:
    """Ordered segments (start, end, text) merged while the gap and the whole stay within bounds; a segment that is longer is halved by characters.

    The bounds depend on what has been merged before, so this is a fold, not a session window.
    """
    seg = "struct<start:double,end:double,text:string>"
    start = F.struct(F.array().cast(f"array<{seg}>").alias("done"), F.lit(None).cast(seg).alias("cur"))

    def halves(c: Column) -> tuple[Column, Column]:
        half = F.floor(F.length(c["text"]) / 2).cast("int")
        first = F.struct(c["start"].alias("start"), (c["start"] + longest).alias("end"), F.substring(c["text"], F.lit(1), half).alias("text"))
        return first, F.struct(first["end"].alias("start"), c["end"].alias("end"), F.substring(c["text"], half + 1, F.length(c["text"])).alias("text"))

    def step(s: Column, x: Column) -> Column:
        c = s["cur"]
        merged = F.struct(c["start"].alias("start"), x["end"].alias("end"), F.concat(c["text"], F.lit(" "), x["text"]).alias("text"))
        first, second = halves(c)
        near = (x["start"] - c["end"] <= threshold) & (x["end"] - c["start"] <= longest)
        return (
            F.when(c.isNull(), F.struct(s["done"].alias("done"), x.alias("cur")))
            .when(near, F.struct(s["done"].alias("done"), merged.alias("cur")))
            .when(c["end"] - c["start"] > longest, F.struct(F.array_append(s["done"], first).alias("done"), second.alias("cur")))
            .otherwise(F.struct(F.array_append(s["done"], c).alias("done"), x.alias("cur")))
        )

    def end(s: Column) -> Column:
        c = s["cur"]
        first, second = halves(c)
        return F.when(c.isNull(), s["done"]).when(c["end"] - c["start"] > longest, F.concat(s["done"], F.array(first, second))).otherwise(F.array_append(s["done"], c))

    return F.aggregate(segments, start, step, end)


def image_documents(summaries: Column, uri: Column, extra: Column) -> Column:
    """Pictures of a page as documents of their own: array of (doc_id, text, metadata).

    summaries: array of (summary, metadata) in order. The id numbers all pictures of the page; what is known of the picture comes first, the
    page's URL and the extra metadata win. The summary is the document's only text, the metadata stand at document and text alike.
    """
    url = F.create_map(F.lit("url"), uri)
    return F.transform(
        summaries,
        lambda x, i: F.struct(F.concat(slug(uri), F.lit("_image_"), i).alias("doc_id"), x["summary"].alias("text"), merged_metadata(x["metadata"], url, extra).alias("metadata")),
    )


def table_payload(headers: Column, rows: Column, summary: Column) -> Column:
    """A table as it is sent: missing cells are empty texts; without a summary, a row or a column there is none."""
    filled = F.transform(rows, lambda r: F.transform(r, lambda c: F.coalesce(F.when(c.isin("NaN", "nan"), "").otherwise(c), F.lit(""))))
    ok = (F.trim(F.coalesce(summary, F.lit(""))) != "") & (F.size(headers) > 0) & (F.size(rows) > 0)
    return F.when(ok, F.struct(headers.alias("headers"), filled.alias("rows"), summary.alias("summary")))
