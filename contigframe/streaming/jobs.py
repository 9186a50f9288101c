"""Annotation of genomes as they arrive. Work on one genome needs no other, so a file stream and ``foreachBatch`` are all of it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.query import StreamingQuery

from contigframe.sources.parsers import fasta_records


def genome_stream(spark: SparkSession, folder: str) -> DataFrame:
    """(contig, seq) of FASTA files as they appear in ``folder``."""
    records = spark.readStream.option("lineSep", "\n>").text(folder).withColumnRenamed("value", "record")
    return fasta_records(records)


def annotate_stream(contigs: DataFrame, run: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> StreamingQuery:
    """Applies ``run`` to each micro-batch and writes its features to a folder named by the batch, so that a batch that is
    repeated after a failure overwrites itself."""

    def each(batch: DataFrame, number: int) -> None:
        run(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return contigs.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
