"""Shared helpers: reading inputs, the shared folder, and written tables that cut lineage."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space, as the contracts of the corpus operators define it.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


#: Folders of applications that have no setting.
_OWN: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``. Where it is unset, a fresh local one if all run on one
    machine; on a cluster that is an error, as executors wouldn't see each other's files."""
    own = getattr(spark.sparkContext, "applicationId", "")
    found = spark.conf.get("spark.checkpoint.dir", None) or _OWN.get(own)
    if not found:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise ValueError(f"set spark.checkpoint.dir to a folder that the driver and all executors of {master} share")
        found = _OWN[own] = f"file://{tempfile.mkdtemp(prefix='contigframe-')}"
    if "://" not in found:  # the default file system's, as Spark reads it; tasks would take it for a local one
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(found)
        found = str(path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString())
    return re.sub("^file:/(?!/)", "file:///", found.rstrip("/"))


def new_folder(spark: SparkSession, what: str) -> str:
    return f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"


def saved(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written(df: DataFrame, what: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: its lineage ends here, and a lost executor loses none of it. The table stays."""
    return saved(df, new_folder(df.sparkSession, what))


class Scratch:
    """Tables and folders of one run, which go when the ``with`` block ends; what is returned is ``written`` before."""

    def __init__(self, spark: SparkSession):
        self.spark, self.folder, self.n = spark, new_folder(spark, "scratch"), 0

    def path(self, what: str) -> str:
        self.n += 1
        return f"{self.folder}/{self.n}-{what}"

    def written(self, df: DataFrame, what: str) -> DataFrame:
        return saved(df, self.path(what))

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        remove_folder(self.spark, self.folder)


#: A key is heavy if it has more than this part of all rows; so there are fewer heavy keys than this. Their rows are dealt to so many places.
HEAVY, SALTS = 512, 32
#: In a table of fewer rows no key weighs anything.
LIGHT = 5_000


def heavy_keys(rows: DataFrame, keys: list[str]) -> list[int]:
    """Hashes of the heavy keys of ``rows`` (a written table): fewer than ``HEAVY`` numbers."""
    total = rows.count()
    if total < LIGHT:
        return []
    counts = rows.groupBy(F.xxhash64(*keys).alias("h")).agg(F.count("*").alias("n")).where(F.col("n") * HEAVY > total)
    return sorted(r["h"] for r in counts.select("h").collect())


def join_heavy(rows: DataFrame, values: DataFrame, keys: list[str], how: str = "inner", heavy: list[int] | None = None) -> DataFrame:
    """``rows`` (a written table) joined, inner or left, to ``values``, which has each key once. Keys may be as unequal as they like: rows
    of ``heavy`` ones (by default those of ``heavy_keys``) are salted by a hash of the row, and their values repeated for each salt."""
    heavy = heavy_keys(rows, keys) if heavy is None else heavy
    weighs = F.xxhash64(*keys).isin(heavy) if heavy else F.lit(False)
    salted = rows.withColumn("__salt", F.when(weighs, F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS)).cast("int")).otherwise(0))
    each = F.when(weighs, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    return salted.join(values.withColumn("__salt", F.explode(each)), [*keys, "__salt"], how).drop("__salt")


def remove_folder(spark: SparkSession, path: str) -> None:
    """Deletes a folder of the shared storage, through Hadoop's own file system."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def held_out(doc_id: Column | str) -> Column:
    """Whether a document belongs to the fold that no model learns from."""
    return F.crc32(F.coalesce(F.col(doc_id) if isinstance(doc_id, str) else doc_id, F.lit(0)).cast("string")) % 5 == 0


def salt_count(spark: SparkSession) -> int:
    """Salts for hot keys: as many as there are shuffle partitions, so a hot key can occupy each of them."""
    return max(8, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def mix(*cols) -> Column:
    """A seeded 64-bit hash of columns or plain values."""
    return F.xxhash64(*[c if isinstance(c, Column) else F.lit(c) for c in cols])
