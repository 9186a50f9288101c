"""Reference tables from public downloads: the protein clusters of accepted taxa, with their names, taxa and a stored search index."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contigframe import constants as C
from contigframe.operators import hits as H
from contigframe.operators import tables
from contigframe.operators.search import PROTEIN, References
from contigframe.sources import parsers as P
from contigframe.sources import sequence_files


def accepted_taxa(nodes: DataFrame, merged: DataFrame, roots: tuple[int, ...] = C.TAXA_ROOTS) -> DataFrame:
    """(id): the roots, all below them, and old ids that were merged into one of these."""
    start = nodes.sparkSession.createDataFrame([(r,) for r in roots], "id long")
    return H.merged_ids(H.tree_closure(nodes, start), merged)


def write_taxids(taxa: DataFrame, path: str) -> None:
    """Ids in ascending order, one a line, as a folder of text files whose names ascend too."""
    taxa.select("id").distinct().repartitionByRange("id").sortWithinPartitions("id").select(F.col("id").cast("string")).write.text(path)


def build_psc(spark: SparkSession, clusters: str, nodes: str, merged: str, out: str, buckets: int = 256, index: str | None = None) -> dict[str, int]:
    """From a cluster FASTA and a taxonomy dump (nodes, merged): ``out``/names (t, product), ``out``/proteins (t, seq) and ``out``/taxids, and with ``index`` the
    search index of that name. Gives how many records were seen and kept. The FASTA is read in chunks; only kept records are put together."""
    taxa = accepted_taxa(P.taxdump_nodes(P.read_lines(spark, nodes)), P.taxdump_merged(P.read_lines(spark, merged)))
    write_taxids(taxa, f"{out}/taxids")
    rows = tables.written(sequence_files.read_sequences(spark, clusters), "clusters")
    heads = tables.written(P.uniref_headers(rows.select("file", "record", "header").distinct().select("header")), "heads")
    kept = P.uniref_filter(heads, taxa.select(F.col("id").alias("taxid"))).select(F.col("id").alias("t"), "product")
    kept.write.parquet(f"{out}/names")
    names = spark.read.parquet(f"{out}/names")
    sequence_files.whole(rows.join(names.select(F.col("t").alias("contig")).distinct(), "contig", "left_semi").select(*rows.columns)).select(F.col("contig").alias("t"), "seq").write.parquet(f"{out}/proteins")
    if index:
        References.of(spark.read.parquet(f"{out}/proteins"), PROTEIN).store(index, buckets, f"{out}/index")
    return {"seen": heads.count(), "kept": names.count()}
