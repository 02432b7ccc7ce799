"""Trees and threads of connectors to documents: stories with comments, chats with replies, issues, pages of blocks, archives."""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, StringType, StructField, StructType

from corpusloom.operators import relational
from corpusloom.session import cut_round


def union_of_lists(*lists: DataFrame) -> DataFrame:
    """The distinct ids of several listings."""
    out = lists[0].select("id")
    for more in lists[1:]:
        out = out.unionByName(more.select("id"))
    return out.distinct()


def story_items(items: DataFrame, stories: DataFrame) -> DataFrame:
    """(story, id, level) of the stories and of the comments below them, at any depth.

    items: id, parent, type, dead. stories: id. What is dead or no comment is passed over with all below it. One join a level.
    """
    live = items.where((F.col("type") == "comment") & ~F.coalesce(F.col("dead"), F.lit(False)) & F.col("parent").isNotNull()).select("id", "parent")
    # an item that is its own ancestor hangs on no story, so the rounds end
    level = items.where("type = 'story'").join(stories.select("id"), "id", "left_semi").select(F.col("id").alias("story"), "id", F.lit(0).alias("level"))
    out, n = None, 0
    while True:
        level = cut_round(level)
        if level.isEmpty() and out is not None:
            return out
        out, n = level if out is None else out.unionByName(level), n + 1
        level = live.join(level.select("story", F.col("id").alias("parent")), "parent").select("story", "id", F.lit(n).alias("level"))


def recent_trees(tree: DataFrame, times: DataFrame, since: Column) -> DataFrame:
    """The trees (story, id, level) of which any item is as new as `since`. times: id, time."""
    newest = tree.join(times, "id").groupBy("story").agg(F.max("time").alias("newest")).where(F.col("newest") >= since)
    return tree.join(newest.select("story"), "story", "left_semi")


def stories_back_to(items: DataFrame, since: Column) -> DataFrame:
    """Stories as new as `since`, read backwards by id and no further than the first story that is older. items: id, type, time."""
    stories = items.where("type = 'story'").select("id", "time")
    last_old = stories.where(F.col("time") < since).agg(F.max("id").alias("id")).first()["id"]
    recent = stories.where(F.col("time") >= since)
    return recent if last_old is None else recent.where(F.col("id") > last_old)


def chat_documents(messages: DataFrame, users: DataFrame) -> DataFrame:
    """One document a thread: the message, then its replies in order, each a section; ids of users as names.

    messages: channel, thread, at, id, text, attachments (array of texts, of bots). users: id, name. A message's attachments stand below its
    text, each once; sections without text go, and so do threads without sections.
    """
    said = F.filter(F.concat(F.array(F.coalesce("text", F.lit(""))), F.array_distinct(F.coalesce("attachments", F.array().cast("array<string>")))), lambda x: F.trim(x) != "")
    rows = messages.select("channel", "thread", "at", F.col("id").alias("message"), F.array_join(said, "\n").alias("text"))
    named = relational.substituted(rows, "message", "text", users, r"<@(\w+)>").where(F.trim("text") != "")
    listed = named.groupBy("channel", "thread").agg(F.array_sort(F.collect_list(F.struct("at", "message", "text"))).alias("l"))
    return listed.select("channel", "thread", F.transform("l", lambda x: x["text"]).alias("sections"))


def issue_sections(summary: Column, description: Column, status: Column, comments: Column) -> Column:
    """An issue as sections (title, text): description, comments in order, status; those without text go."""
    part = lambda title, text: F.struct(title.alias("title"), F.coalesce(text, F.lit("")).alias("text"))
    told = F.transform(F.coalesce(comments, F.array().cast("array<string>")), lambda c, i: part(F.concat(F.lit("Comment "), i + 1), c))
    whole = F.concat(F.array(part(summary, description)), told, F.array(part(F.lit("Status"), status)))
    return F.filter(whole, lambda s: F.trim(s["text"]) != "")


def property_title(properties: Column) -> Column:
    """A page's title out of its properties (array of name, type, text): that named title, that named Name, the first of type title; '' else."""
    titles = F.filter(properties, lambda p: p["type"] == "title")
    named = lambda n: F.get(F.filter(titles, lambda p: p["name"] == n), F.lit(0))
    found = F.coalesce(named("title"), named("Name"), F.get(titles, F.lit(0)))
    return F.coalesce(found["text"], F.lit(""))


def block_texts(blocks: DataFrame, pages: DataFrame) -> DataFrame:
    """(page, text) of pages made of nested blocks, depth first; pages without text go.

    blocks: id, parent, ord, type, text; a block whose parent is a page stands on it. Sub-pages aren't part of a page. A block's place is the
    path of positions down to it, made level by level, so a page's texts are sorted once.
    """
    own = blocks.where("type <> 'child_page'")
    at = lambda c: F.array(c.cast("long"))
    level = own.join(pages.select(F.col("id").alias("parent")), "parent", "left_semi").select(F.col("parent").alias("page"), "id", at(F.col("ord")).alias("path"), "text")
    out = None
    while True:
        level = cut_round(level)
        if level.isEmpty() and out is not None:
            break
        out = level if out is None else out.unionByName(level)
        below = own.select("id", "parent", "ord", "text").join(level.select("page", F.col("id").alias("parent"), F.col("path").alias("above")), "parent")
        level = below.select("page", "id", F.concat("above", at(F.col("ord"))).alias("path"), "text")
    listed = out.where(F.trim("text") != "").groupBy("page").agg(F.array_sort(F.collect_list(F.struct("path", "id", "text"))).alias("l"))
    return listed.select("page", F.array_join(F.transform("l", lambda x: F.trim(x["text"])), " ").alias("text"))


MEMBERS = ArrayType(StructType([StructField("name", StringType()), StructField("data", BinaryType())]))


def archive_members(data: Column) -> Column:
    """The files of a zip archive; folders aren't files, and an unreadable archive has none."""

    def one(x) -> list[dict]:
        try:
            with zipfile.ZipFile(io.BytesIO(bytes(x or b""))) as z:
                return [{"name": i.filename, "data": z.read(i)} for i in z.infolist() if not i.is_dir()]
        except (zipfile.BadZipFile, OSError, RuntimeError, NotImplementedError):
            return []

    @F.pandas_udf(MEMBERS)
    def run(values: pd.Series) -> pd.Series:
        return pd.Series([one(x) for x in values], dtype=object)

    return run(data)


def first_shared(files: DataFrame, user: str) -> DataFrame:
    """Files that several users see, once each: as the first user by name sees them. files: id and what is known of them."""
    rest = [c for c in files.columns if c != "id"]
    return files.groupBy("id").agg(F.min_by(F.struct(*rest), user).alias("f")).select("id", "f.*")


def transcript(parts: Column, recognised: Column) -> Column:
    """A video's own transcript, else what was recognised of its sound, else none."""
    some = lambda c: F.when(F.size(F.coalesce(c, F.array().cast("array<string>"))) > 0, c)
    return F.coalesce(some(parts), some(recognised))
