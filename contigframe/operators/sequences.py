"""Sequences by address: contigs as rows of bounded size, and stretches of them fetched from the rows they lie in.

A chunk row (contig, chunk, bases) holds the bases from ``chunk * SIZE`` on: its own ``SIZE`` and a halo of ``HALO`` that the next chunk
has too. A stretch that is no longer than the halo lies in one row; a longer one is put together from its chunks. So no join row holds a
whole contig, and the features of one contig are as many keys as it has chunks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SIZE, HALO = 65_536, 16_384


def sequence_chunks(contigs: DataFrame, size: int = SIZE, halo: int = HALO) -> DataFrame:
    """(contig, chunk, bases) of (contig, seq); an empty contig has no chunk."""
    n = F.length("seq")
    chunks = F.when(n > 0, F.sequence(F.lit(0), F.floor((n - 1) / size).cast("int"))).otherwise(F.array().cast("array<int>"))
    each = contigs.select("contig", "seq", F.explode(chunks).alias("chunk"))
    return each.select("contig", F.col("chunk").cast("long").alias("chunk"), F.substring("seq", F.col("chunk") * size + 1, F.lit(size + halo)).alias("bases"))


def slices(spans: DataFrame, chunks: DataFrame, name: str = "sub", size: int = SIZE, halo: int = HALO) -> DataFrame:
    """``spans`` (contig, s, e, ...) with the bases from s to e (from 1, both within) as ``name``: those there are, if the stretch leaves its contig, and null if
    there are none.

    Rows may be equal; columns must be such as can be grouped by. ``chunks`` are those of ``sequence_chunks`` with the same sizes.
    """
    columns = spans.columns
    first, last = F.greatest(F.col("s"), F.lit(1)), F.col("e")
    chunk_of = lambda at: F.floor((at - 1) / size).cast("long")
    keyed = chunks.select(F.col("contig").alias("__contig"), F.col("chunk").alias("__chunk"), F.col("bases").alias("__bases"), (F.octet_length("bases") == F.length("bases")).alias("__plain"))
    here = lambda rows: rows.join(keyed, (F.col("contig") == F.col("__contig")) & (F.col("__at") == F.col("__chunk")), "left")
    start = lambda: first - F.col("__at") * size  # noqa: E731 - place in the chunk, from 1

    def cut(at: Column, n: Column) -> Column:
        """Letters of the chunk; where all are single bytes they are found by address, not by counting letters from the chunk's begin for every stretch."""
        return F.when(F.col("__plain"), F.substring(F.col("__bases").cast("binary"), at, n).cast("string")).otherwise(F.substring("__bases", at, n))

    brief = F.coalesce(last - first < halo, F.lit(True))
    got = here(spans.where(brief).withColumn("__at", chunk_of(first)))
    found = got.select(*columns, F.nullif(cut(start().cast("int"), F.greatest(last - first + 1, F.lit(0)).cast("int")), F.lit("")).alias(name))
    # a long one: equal rows are counted, so that the columns name one
    many = spans.where(~brief).groupBy(*columns).agg(F.count("*").cast("int").alias("__n"))
    low, high = F.greatest(first, F.col("__at") * size + 1), F.least(last, (F.col("__at") + 1) * size)
    parts = here(many.withColumn("__at", F.explode(F.sequence(chunk_of(first), chunk_of(last)))))
    piece = cut((low - F.col("__at") * size).cast("int"), (high - low + 1).cast("int"))
    whole = parts.groupBy(*columns, "__n").agg(F.array_sort(F.collect_list(F.when(F.col("__bases").isNotNull(), F.struct(F.col("__at").alias("at"), piece.alias("piece"))))).alias("__p"))
    text = F.nullif(F.array_join(F.transform("__p", lambda p: p["piece"]), ""), F.lit(""))
    return found.unionByName(whole.withColumn(name, text).withColumn("__n", F.explode(F.sequence(F.lit(1), F.col("__n")))).select(*columns, name))


def inside(sub: Column) -> Column:
    """Whether a fetched stretch is whole."""
    return (F.col("s") >= 1) & (F.col("e") >= F.col("s")) & (F.length(sub) == F.col("e") - F.col("s") + 1)
