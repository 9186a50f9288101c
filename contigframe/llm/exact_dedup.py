"""Exact deduplication by skew-safe combining (DataFrame functions only).

Equal rows are combined three times, and each time the whole text is part of the grouping key next to its
digest: within a task (the map side of the first aggregation; all rows of a task have the same salt, so one row of each text leaves
it), within a salted digest group (its reduce side), and globally over the winners of the salts. A group of copies, however
large, so reaches the last step as one row per salt, of which there are ``SALTS`` at any size.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from contigframe.llm import util


SALTS = 32


def normalised(text: Column | str) -> Column:
    """Runs of ASCII white space become one space; null becomes the empty text."""
    return F.coalesce(F.regexp_replace(text, util.SPACE, " "), F.lit(""))


def sha256(norm: Column | str) -> Column:
    return F.sha2(norm, 256)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Defined cases: null text equals the empty text. ``keep_id`` is the smallest non-null id of the group, and null only if
    every id of it is null. Of rows repeated with the same id and text exactly one is kept; all count in ``group_size``.
    An empty table gives an empty result. Other columns of ``docs`` are not read, whatever their names.
    ``digest`` may collide: texts that share a digest but differ are told apart by their content.
    """
    with util.Scratch(docs.sparkSession) as tmp:
        base = docs.select(F.col(id_col).alias("doc_id"), normalised(F.col(text_col)).alias("norm")).withColumn("text_sha256", digest(F.col("norm")))
        by_task = base.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
        salted = by_task.groupBy("text_sha256", "salt", "norm").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("n"))
        whole = salted.groupBy("text_sha256", "norm").agg(F.min("keep_id").alias("keep_id"), F.sum("n").alias("group_size"))
        winners = tmp.written(
            whole.groupBy("text_sha256").agg(F.count("*").alias("variants"), F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size")), "winners"
        )
        keys = tmp.written(base.select("doc_id", "text_sha256").withColumn("row", F.monotonically_increasing_id()), "keys")
        alone = winners.where("variants = 1").select("text_sha256", "keep_id", "group_size")
        joined = util.join_heavy(keys, alone, ["text_sha256"])
        own = F.struct("doc_id").alias("own")  # a null id is an id too
        repeated = keys.groupBy(own, "text_sha256").agg(F.count("*").alias("times"), F.min("row").alias("first")).where("times > 1")
        repeated = tmp.written(repeated.select("own", "text_sha256", "first"), "repeated")
        first = F.lit(True)
        if repeated.limit(1).count():  # of rows with the same id and text one is kept
            joined = util.join_heavy(tmp.written(joined.withColumn("own", own), "joined"), repeated, ["own", "text_sha256"], "left")
            first = F.coalesce(F.col("row") == F.col("first"), F.lit(True))
        columns = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
        out = joined.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")) & first).select(*columns)
        if winners.where("variants > 1").limit(1).count():
            out = out.unionByName(_by_content(base, whole, winners, salts).select(*columns))
        return util.written(out, "exact-dedup")


def _by_content(base: DataFrame, whole: DataFrame, winners: DataFrame, salts: int) -> DataFrame:
    """The digests that collide: rows meet their winner by (digest, salt, text)."""
    collided = winners.where("variants > 1").select("text_sha256")
    rows = base.join(collided, "text_sha256", "left_semi").withColumn("salt", F.pmod(util.mix(F.col("doc_id")), F.lit(salts)))
    spread = rows.select("text_sha256", "salt", "norm").distinct().join(whole, ["text_sha256", "norm"])
    again = F.row_number().over(Window.partitionBy("text_sha256", "norm", "salt", "doc_id").orderBy("doc_id"))
    return rows.join(spread, ["text_sha256", "salt", "norm"]).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")) & (again == 1))


def kept_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with their columns: of rows repeated with the same id and text, one."""
    found = exact_dedup(docs, id_col, text_col)
    keep = found.where("kept").select(F.col("doc_id").alias("__keep"), F.col("text_sha256").alias("__sha"))
    twice = found.groupBy(F.struct("doc_id").alias("own"), "text_sha256").agg(F.count("*").alias("n")).where("n > 1")
    twice = util.written(twice.select(F.col("own.doc_id").alias("__keep"), F.col("text_sha256").alias("__sha")), "repeated-rows")
    named = F.col(id_col).eqNullSafe(F.col("__keep")) & (F.col("__own") == F.col("__sha"))
    rows = docs.withColumn("__own", sha256(normalised(F.col(text_col))))
    rows = rows.join(keep, named, "left_semi")
    if twice.limit(1).count():
        rows = rows.join(twice, named, "left_anti").unionByName(rows.join(twice, named, "left_semi").dropDuplicates([id_col, "__own"]))
    return rows.select(*docs.columns)


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(util.documents(spark, sf_dir))


ORACLE = r"""
with n as (select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as norm from documents)
select doc_id, min(doc_id) over (partition by norm) as keep_id, count(*) over (partition by norm) as group_size,
       doc_id = min(doc_id) over (partition by norm) as kept, sha256(norm) as text_sha256
from n
"""
