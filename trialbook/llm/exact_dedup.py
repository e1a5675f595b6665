"""Exact dedup by content-defined chunk recipes.

A normalised text is cut into chunks whose borders its own content decides, so that the cut does
not depend on where a document lies. Chunks travel once, in partial aggregates that hold each text
once per task, and get a verified identifier: the 64-bit hash of the chunk, and a rank among the
texts that share the hash (0 unless there are several, which the chunk texts themselves prove).
From there on only the ordered identifier lists are compared; no document is moved as a whole.

Nulls and edges: a null text is an empty one, and all empty texts are equal. A null id is the
smallest of its group. Of rows that repeat both id and text exactly one is kept. Other columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trialbook.llm import query
from trialbook.llm.text import ascii_lower, table, whole
from trialbook.session import stage


def chunks(text: Column, least: int = 256, most: int = 2048) -> Column:
    """The text in chunks of ``least`` to ``most`` characters that end at the first mark of an end of a
    sentence or line; without one the chunk has ``most`` characters, and the last takes what is left."""
    return F.regexp_extract_all(text, F.lit(rf"(?s).{{{least - 1},{most - 1}}}?[.!?;\n]|.{{1,{most}}}"), F.lit(0))


def shared_hashes(hashed: DataFrame) -> DataFrame:
    """(hash, chunk, rank) of the chunks whose hash another chunk text has too; normally none."""
    distinct = hashed.groupBy("hash", "chunk").agg(F.lit(1).alias("one"))
    several = distinct.groupBy("hash").count().filter("count > 1").select("hash")
    order = Window.partitionBy("hash").orderBy("chunk")
    return distinct.join(several, "hash", "left_semi").select("hash", "chunk", (F.row_number().over(order) - 1).alias("rank"))


def _recipes(docs: DataFrame, doc_id: str, text: str, hashes: Column | None) -> DataFrame:
    normal = docs.select(F.col(doc_id).alias("doc_id"), ascii_lower(whole(text)).alias("t"))
    cut = normal.select("doc_id", F.sha2("t", 256).alias("text_sha256"), chunks(F.col("t")).alias("chunks"))
    hashed = F.transform("chunks", lambda c: F.xxhash64(c) if hashes is None else hashes(c))
    return cut.withColumn("hashes", hashed)


def exact_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", hashes=None) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of every row.

    Texts are equal when they are identical after lower-casing A-Z. Of a group the row with the
    largest id is kept. ``hashes`` replaces the chunk hash (tests pass one that collides).
    """
    cut = _recipes(docs, doc_id, text, hashes)
    pairs = cut.select(F.explode(F.arrays_zip("hashes", "chunks")).alias("c")).select(F.col("c.hashes").alias("hash"), F.col("c.chunks").alias("chunk"))
    shared = stage(shared_hashes(pairs), "shared-hashes")
    narrow = cut.withColumn("_row", F.monotonically_increasing_id())
    plain = F.transform("hashes", lambda h: F.struct(h.alias("hash"), F.lit(0).alias("rank")))
    if shared.isEmpty():
        recipes = narrow.select("_row", "doc_id", "text_sha256", plain.alias("recipe"))
    else:
        # Every chunk looks up its rank; chunks of one hash are few texts, so the join does not multiply rows.
        placed = narrow.select("_row", "doc_id", "text_sha256", F.posexplode_outer(F.arrays_zip("hashes", "chunks")).alias("at", "c"))
        placed = placed.select("_row", "doc_id", "text_sha256", "at", F.col("c.hashes").alias("hash"), F.col("c.chunks").alias("chunk"))
        ranked = placed.join(shared, ["hash", "chunk"], "left")
        entry = F.when(F.col("hash").isNotNull(), F.struct("at", "hash", F.coalesce("rank", F.lit(0)).alias("rank")))
        recipes = ranked.groupBy("_row", "doc_id", "text_sha256").agg(F.sort_array(F.collect_list(entry)).alias("r")).select(
            "_row", "doc_id", "text_sha256", F.transform("r", lambda x: F.struct(x["hash"].alias("hash"), x["rank"].alias("rank"))).alias("recipe"))
    recipes = stage(recipes, "recipes")
    groups = recipes.groupBy("recipe").agg(F.max(F.struct("doc_id", "_row")).alias("keep"), F.count(F.lit(1)).alias("group_size"))
    # Only recipes that repeat need a look-up. Their table is written, so that the join has a shuffle of its
    # own on both sides and AQE can split the recipes that repeat very often.
    repeated = stage(groups.filter("group_size > 1"), "repeated")
    return recipes.join(repeated, "recipe", "left").select(
        "doc_id",
        F.when(F.col("keep").isNull(), F.col("doc_id")).otherwise(F.col("keep.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (F.col("keep").isNull() | (F.col("keep._row") == F.col("_row"))).alias("kept"),
        "text_sha256",
    )


def survivors(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``exact_dedup`` keeps, with all their columns."""
    kept = exact_dedup(docs, doc_id, text).filter("kept").select(F.col("doc_id").alias("__kept_id"), F.col("text_sha256").alias("__kept_sha"))
    marked = docs.withColumns({"__sha": F.sha2(ascii_lower(whole(text)), 256), "__id": F.col(doc_id)})
    joined = marked.join(kept, F.col("__id").eqNullSafe(F.col("__kept_id")) & (F.col("__sha") == F.col("__kept_sha")))
    # The join has sorted by these columns already.
    first = Window.partitionBy("__id", "__sha").orderBy("__id")
    return joined.withColumn("__n", F.row_number().over(first)).filter("__n = 1").select(*docs.columns)


@query("op10_exact_dedup", sql="""
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
WINDOW g AS (PARTITION BY t)""")
def _(spark, folder):
    return exact_dedup(table(spark, folder, "documents"))
