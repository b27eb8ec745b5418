"""Operator 2: exact dedup (method: skew-safe combining in salted groups, full content compared at every stage)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdwise.llm.common import stored

#: Parts a group of equal texts is spread over before its winners are combined.
SALTS = 64


def sha256_of(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def text_groups(df: DataFrame, id_col: str, text_col: str, digest=sha256_of, salts: int = SALTS) -> DataFrame:
    """(digest, variants, keep, size) per digest; ``keep`` and ``size`` hold if the digest has one text (variants 1).

    Grouping by digest, salt and text combines equal texts within each task first (partial aggregation), then
    across tasks per salt, then across salts. The text is a key of every grouping, so it is compared in full.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = df.select(F.col(id_col).alias("id"), text.alias("text"))
    rows = rows.select("id", "text", digest(F.col("text")).alias("digest"), F.pmod(F.xxhash64("id"), F.lit(salts)).alias("salt"))
    salted = rows.groupBy("digest", "salt", "text").agg(F.max("id").alias("keep"), F.count(F.lit(1)).alias("size"))
    winners = salted.groupBy("digest", "text").agg(F.max("keep").alias("keep"), F.sum("size").alias("size"))
    return winners.groupBy("digest").agg(F.count(F.lit(1)).alias("variants"), F.max("keep").alias("keep"), F.max("size").alias("size"))


def exact_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest=sha256_of, salts: int = SALTS) -> DataFrame:
    """One row per input row: ``id_col``, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``.

    Texts are equal when identical; null counts as the empty text. Of equal texts the row with the largest id is
    kept. Of rows that repeat both id and text one is kept; a null id is kept only in a group without other ids
    (its ``keep_id`` is null). An empty table gives no rows. Other columns are not read and may have any name.

    ``digest`` only routes rows: texts that differ under one digest are told apart by their content.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    groups = stored(text_groups(df, id_col, text_col, digest, salts), "exact-groups")
    clash = groups.where("variants > 1").select("digest")
    rows = df.select(F.col(id_col).alias("id"), text.alias("text"), digest(text).alias("digest"))
    if clash.isEmpty():
        content = F.lit(None).cast("string")
        by_text = None
    else:  # one digest, several texts: those texts become part of the key
        rows = rows.join(clash.withColumn("clashes", F.lit(True)), "digest", "left")
        content = F.when(F.col("clashes"), F.col("text"))
        by_text = rows.where("clashes").groupBy("digest", F.col("text").alias("content")).agg(F.max("id").alias("keep"), F.count(F.lit(1)).alias("size"))
    salt = F.pmod(F.xxhash64("id"), F.lit(salts)).alias("salt")
    # rows that repeat id and text are one row with a count until the end
    rows = rows.groupBy("id", "digest", content.alias("content"), salt, F.sha2("text", 256).alias("sha")).agg(F.count(F.lit(1)).alias("copies"))
    rows = stored(rows, "exact-rows")
    found = groups.where("variants = 1").select("digest", F.lit(None).cast("string").alias("content"), "keep", "size")
    if by_text is not None:
        found = found.union(by_text.select("digest", "content", "keep", "size"))
    # a group's result goes to its salts first, and from there to its rows: no key holds more than a salt of a group
    same = F.col("l.digest").eqNullSafe(F.col("r.digest")) & F.col("l.content").eqNullSafe(F.col("r.content"))
    per_salt = rows.select("digest", "content", "salt").distinct().alias("l").join(found.alias("r"), same).select("l.digest", "l.content", "l.salt", "keep", "size")
    out = rows.alias("l").join(per_salt.alias("r"), same & (F.col("l.salt") == F.col("r.salt")))
    out = out.select("id", "sha", "keep", "size", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
    kept = F.col("id").eqNullSafe(F.col("keep")) & (F.col("copy") == 1)
    return out.select(F.col("id").alias(id_col), F.col("keep").alias("keep_id"), F.col("size").alias("group_size"), kept.alias("kept"), F.col("sha").alias("text_sha256"))


def drop_exact_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df``, all columns, that ``exact_duplicates`` keeps.

    Rows that repeat an id and a text but differ elsewhere count as copies; any one of them stays. Null and empty
    texts are one group; a row with a null id stays only where its group has no id. Of an empty table none stay.
    """
    marked = stored(exact_duplicates(df, id_col, text_col), "exact-marked")
    lost = marked.where("not kept").select(F.col(id_col).alias("_id"), F.col("text_sha256").alias("_sha"), "keep_id")
    again = F.col("_id").eqNullSafe(F.col("keep_id"))  # repeats of a kept row
    copies = lost.where(~again)
    sha = F.sha2(F.coalesce(df[text_col].cast("string"), F.lit("")), 256)
    out = df.join(copies, df[id_col].eqNullSafe(copies["_id"]) & (sha == copies["_sha"]), "left_anti")
    return out if lost.where(again).isEmpty() else out.dropDuplicates([id_col, text_col])
