"""Exact duplicates by content-defined chunk recipes, in built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..sources.staging import stage
from . import common

#: Cuts follow the text alone: after at least ``least`` characters a chunk ends behind the next cut mark,
#: a space after one of these characters, at the latest after ``most`` characters.
CUT_AFTER = r"[aegimoqsuwy.,!?0-4;:)\]}\P{ASCII}]"


def normalised(text: Column) -> Column:
    """The text with each run of white space as one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), common.SPACE, " ")


def chunks(text: Column, least: int = 512, most: int = 4096) -> Column:
    """The text cut at places its content defines; joined again, the chunks are the text."""
    pattern = rf"(?s).{{{least},{most - 1}}}?{CUT_AFTER} |.{{1,{most}}}"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def _identifier(chunk: Column, bits: int) -> Column:
    whole = F.xxhash64(chunk)
    return whole if bits >= 64 else F.pmod(whole, F.lit(1 << bits))


def exact_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_bits: int = 64) -> DataFrame:
    """Class of every row: ``id_col``, mark, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after each run of white space became one space; null counts as empty.
    Of equal texts the row with the smallest id stays (null ids last; of rows with that id, the first).
    ``mark`` numbers the rows (see ``mark_rows``).  Other columns are not looked at; an empty table gives an
    empty result.

    A row's recipe is the ordered list of its chunks' identifiers.  Identifiers are hashes that are verified:
    the different chunk contents are gathered once, and where one hash stands for several contents, each
    content gets a number of its own, which the recipes of the rows that hold it then carry.  After that only
    recipes are grouped and joined, never texts.  ``hash_bits`` is there for tests of such collisions.
    """
    rows = common.mark_rows(df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")), "mark")
    texts = rows.select("id", "mark", normalised(F.col("text")).alias("text"))
    recipes = stage(texts.select(
        "id", "mark", F.sha2("text", 256).alias("sha"),
        F.transform(chunks(F.col("text")), lambda c: _identifier(c, hash_bits)).alias("recipe")), "recipes")
    pieces = texts.select("mark", F.posexplode(chunks(F.col("text"))).alias("pos", "chunk")).select(
        "mark", "pos", "chunk", _identifier(F.col("chunk"), hash_bits).alias("h"))
    contents = pieces.select("h", "chunk").distinct()
    doubtful = stage(contents.groupBy("h").count().where("count > 1").select("h"), "doubtful-chunks")
    if doubtful.isEmpty():
        recipes = recipes.withColumn("told", F.array().cast("array<struct<pos:int,n:int>>"))
    else:
        # Rare: of the few hashes with several contents, each content has its number.
        numbered = contents.join(doubtful, "h", "left_semi").withColumn(
            "n", F.row_number().over(Window.partitionBy("h").orderBy("chunk")))
        told = (pieces.join(numbered, ["h", "chunk"]).groupBy("mark")
                .agg(F.sort_array(F.collect_list(F.struct("pos", "n"))).alias("told")))
        recipes = recipes.join(told, "mark", "left").withColumn(
            "told", F.coalesce("told", F.array().cast("array<struct<pos:int,n:int>>")))
    first = F.min(F.struct(F.col("id").isNull().alias("n"), "id", "mark")).alias("first")
    groups = recipes.groupBy("recipe", "told").agg(first, F.count("*").alias("group_size"))
    return recipes.join(groups, ["recipe", "told"]).select(
        F.col("id").alias(id_col), "mark", F.col("first.id").alias("keep_id"), "group_size",
        (F.col("mark") == F.col("first.mark")).alias("kept"), F.col("sha").alias("text_sha256"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(common.table(spark, sf_dir, "documents")).drop("mark")


SQL = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept, sha256(norm) AS text_sha256
FROM t WINDOW g AS (PARTITION BY norm)
"""
