"""Written tables that cut lineage, and joins that a frequent key doesn't stop."""

from __future__ import annotations

import math
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Folders of applications that have no setting.
_OWN: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, ``spark.checkpoint.dir``; where it is unset and all run on one machine, a fresh local one."""
    own = getattr(spark.sparkContext, "applicationId", "")
    found = spark.conf.get("spark.checkpoint.dir", None) or _OWN.get(own)
    if not found:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = _OWN[own] = f"file://{tempfile.mkdtemp(prefix='contigframe-')}"
    return found.rstrip("/")


def written(df: DataFrame, what: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, which stays: what is computed from it never runs what came before again."""
    return df.sparkSession.read.schema(df.schema).parquet(placed(df, what))


def placed(df: DataFrame, what: str) -> str:
    """Where ``df`` has been written: a fresh folder of the shared one."""
    path = f"{shared_dir(df.sparkSession)}/{what}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return path


def removed(spark: SparkSession, folder: str) -> None:
    """Deletes a folder, through Hadoop's own file system."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


class Rounds:
    """Tables of an iteration: those that later rounds no longer need are removed."""

    def __init__(self, spark: SparkSession, what: str):
        self.spark, self.folder, self.n = spark, f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}", 0

    def written(self, df: DataFrame) -> DataFrame:
        self.n += 1
        df.write.parquet(path := f"{self.folder}/{self.n}")
        return self.spark.read.schema(df.schema).parquet(path)

    def __enter__(self) -> Rounds:
        return self

    def __exit__(self, *_) -> None:
        removed(self.spark, self.folder)


def salted_join(rows: DataFrame, values: DataFrame, keys: list[str], how: str = "inner", parts: int | None = None) -> DataFrame:
    """``rows`` joined, inner or left, to ``values``, however unequal the keys of ``rows`` are. A key with more rows than half a shuffle partition's mean
    is dealt to as many places as it fills halves, by a hash of the row, and its ``values`` are repeated for them. At most twice as many
    keys as there are partitions can be that heavy; only these (16 bytes each) are broadcast."""
    parts = parts or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    hashed = F.xxhash64(*keys).alias("__h")
    counts = rows.select(hashed).groupBy("__h").agg(F.count("*").alias("__n"))
    total = counts.agg(F.sum("__n").alias("__all"))
    heavy = counts.join(F.broadcast(total)).where(F.col("__n") * 2 * parts > F.col("__all"))  # one row
    heavy = heavy.select("__h", F.ceil(F.col("__n") * 2 * parts / F.col("__all")).cast("int").alias("__salts")).where("__salts > 1")
    own = rows.withColumn("__h", F.xxhash64(*keys)).join(F.broadcast(heavy), "__h", "left")
    own = own.withColumn("__salt", F.coalesce(F.pmod(F.xxhash64(F.lit(1), *rows.columns), F.col("__salts")).cast("int"), F.lit(0))).drop("__h", "__salts")
    each = values.withColumn("__h", F.xxhash64(*keys)).join(F.broadcast(heavy), "__h", "left")
    each = each.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("__salts"), F.lit(1)) - 1))).drop("__h", "__salts")
    return own.join(each, [*keys, "__salt"], how).drop("__salt")


def doublings(n: int) -> int:
    """Rounds in which pointers that double reach over ``n`` steps."""
    return max(1, math.ceil(math.log2(max(n, 2)))) + 1
