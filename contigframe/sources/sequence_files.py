"""Sequence files of any size as chunk rows, from lines that Spark's text source splits by byte ranges.

A line finds its record by the latest header before it and its place by the lengths before it, both running values in two levels, so that a file or
contig of any length is many tasks, and no row holds more than a chunk (or one line of the file).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contigframe.functions import text as T
from contigframe.operators import sequences as Q
from contigframe.operators import tables
from contigframe.operators.intervals import running
from contigframe.sources.parsers import read_lines


def record_lines(lines: DataFrame) -> DataFrame:
    """(file, record, contig, header, line_no, bases) of FASTA and FASTQ lines (file, line_no, line), told apart by the first line of each file. ``record`` is the header's
    line; what comes before a file's first header goes. A name is the header's first token; bases are upper case."""
    tidy = lines.withColumn("line", F.regexp_replace("line", r"\s+$", "")).where("line <> ''")
    first = tidy.groupBy("file").agg(F.min_by("line", "line_no").startswith("@").alias("fastq"))
    known = tidy.join(first, "file")
    fasta = known.where("not fastq").drop("fastq")
    header = F.col("line").startswith(">")
    placed = running(fasta, ["file"], "line_no", ["line_no"], F.when(header, F.col("line_no")), "last", "record").where("record is not null")
    title = F.trim(F.substring("line", F.lit(2), F.length("line")))
    names = placed.where(header).select("file", "record", T.first_token(title).alias("contig"), title.alias("header"))
    body = placed.where(~header).select("file", "record", "line_no", F.upper(F.regexp_replace("line", r"\s+", "")).alias("bases"))
    whole = names.join(body, ["file", "record"], "left")
    counted = running(known.where("fastq").drop("fastq"), ["file"], "line_no", ["line_no"], F.lit(1), "sum", "k", before=True).withColumn("k", F.coalesce("k", F.lit(0)))
    four = counted.withColumn("nth", F.floor(F.col("k") / 4))
    heads = four.where("k % 4 = 0").select("file", "nth", F.col("line_no").alias("record"), T.first_token(title).alias("contig"), title.alias("header"))
    reads = heads.join(four.where("k % 4 = 1").select("file", "nth", "line_no", F.upper("line").alias("bases")), ["file", "nth"]).drop("nth")
    columns = ["file", "record", "contig", "header", "line_no", "bases"]
    return whole.select(*columns).unionByName(reads.select(*columns))


def sequence_rows(lines: DataFrame, size: int = Q.SIZE) -> DataFrame:
    """(file, record, contig, header, chunk, bases): each record's bases in chunks of ``size``; a record without bases has one empty chunk."""
    rows = tables.written(record_lines(lines).withColumn("n", F.coalesce(F.length("bases"), F.lit(0)).cast("long")), "lines")
    placed = running(rows, ["file", "record"], "line_no", ["line_no"], F.col("n"), "sum", "at", before=True).withColumn("at", F.coalesce("at", F.lit(0)).cast("long"))
    chunks = F.sequence(F.floor(F.col("at") / size), F.floor((F.col("at") + F.greatest("n", F.lit(1)) - 1) / size))
    cut = placed.withColumn("chunk", F.explode(chunks))
    low, high = F.greatest("at", F.col("chunk") * size), F.least(F.col("at") + F.col("n"), (F.col("chunk") + 1) * size)
    piece = F.coalesce(F.substring("bases", (low - F.col("at") + 1).cast("int"), (high - low).cast("int")), F.lit(""))
    parts = cut.select("file", "record", "contig", "header", F.col("chunk").cast("long").alias("chunk"), F.coalesce("line_no", "record").alias("line_no"), piece.alias("piece"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "piece"))), lambda p: p["piece"]), "")
    return parts.groupBy("file", "record", "contig", "header", "chunk").agg(joined.alias("bases")).where((F.col("bases") != "") | (F.col("chunk") == 0))


def with_halo(rows: DataFrame, halo: int = Q.HALO) -> DataFrame:
    """Chunk rows whose bases go on into the next chunk, as ``sequence_chunks`` gives them."""
    keys = ["file", "record", "chunk"]
    ahead = rows.select("file", "record", (F.col("chunk") - 1).alias("chunk"), F.substring("bases", 1, halo).alias("__more"))
    return rows.join(ahead, keys, "left").withColumn("bases", F.concat("bases", F.coalesce("__more", F.lit("")))).drop("__more")


def read_sequences(spark: SparkSession, path: str, size: int = Q.SIZE, **options: str) -> DataFrame:
    """(file, record, contig, header, chunk, bases) of the FASTA and FASTQ files at a path, plain or gz."""
    return sequence_rows(read_lines(spark, path, **options), size)


def whole(rows: DataFrame) -> DataFrame:
    """(contig, header, seq): the records of chunk rows in one piece each, for what needs them so."""
    seq = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk", "bases"))), lambda p: p["bases"]), "")
    return rows.groupBy("file", "record", "contig", "header").agg(seq.alias("seq")).select("contig", "header", "seq")


def read_replicons(spark: SparkSession, folder: str) -> DataFrame:
    """(t, seq) of all ``*.fsa`` files below a folder, as references of a search."""
    return whole(read_sequences(spark, folder, pathGlobFilter="*.fsa", recursiveFileLookup="true")).select(F.col("contig").alias("t"), "seq")


def duplicates(rows: DataFrame) -> DataFrame:
    """(contig, n) of names that several records have."""
    return rows.select("file", "record", "contig").distinct().groupBy("contig").agg(F.count("*").alias("n")).where("n > 1")
