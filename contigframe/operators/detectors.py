"""From the call tables of search programs to features: naming, numbering and the filters that are ours.

The searches themselves (gene finder, profile and covariance models, tRNA, repeats) are inputs; ``SearchProvider`` is where one plugs in.
"""

from __future__ import annotations

from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contigframe import constants as C
from contigframe.functions import text as T
from contigframe.operators.intervals import global_number, split_numbered

FEATURE = ["contig", "id", "kind", "s", "e", "strand", "name", "accession", "score", "evalue"]


class SearchProvider(Protocol):
    """Gives hits for queries (q, seq) in references, as a table in the m8 layout; without references None, and its tier is skipped."""

    def search(self, queries: DataFrame, database: object, **settings: object) -> DataFrame | None: ...


def _features(calls: DataFrame, kind: Column | str, tag: str, name: Column, accession: Column, score: Column, evalue: Column | None = None, order: tuple[str, ...] = ("s", "e", "ord")) -> DataFrame:
    numbered = split_numbered(calls, *order)
    kind = F.lit(kind) if isinstance(kind, str) else kind
    return numbered.select("contig", F.concat("contig", F.lit(f"_{tag}"), F.col("num").cast("string")).alias("id"), kind.alias("kind"), "s", "e", "strand", name.alias("name"), accession.alias("accession"), score.cast("double").alias("score"), (evalue if evalue is not None else F.lit(None)).cast("double").alias("evalue"))


def trna(calls: DataFrame) -> DataFrame:
    """Calls (contig, s, e, strand, ord, isotype, anticodon, score)."""
    return _features(calls, "Trna", "trna", F.concat(F.lit("tRNA-"), "isotype"), F.col("anticodon"), F.col("score"), order=("ord",))


def tmrna(calls: DataFrame) -> DataFrame:
    """Calls (contig, s, e, strand, ord, genetype, energy); only genes of type 1."""
    return _features(calls.where("genetype = 1"), "Tmrna", "tmrna", F.lit("tmRNA"), F.lit("-"), F.col("energy"), order=("ord",))


def oriented(hits: DataFrame) -> DataFrame:
    """Hits (start, stop, ...), start above stop on the minus strand, as s <= e and a strand."""
    return hits.withColumns({"s": F.least("start", "stop"), "e": F.greatest("start", "stop"), "strand": F.when(F.col("start") > F.col("stop"), -1).otherwise(1)})


def ncrna(hits: DataFrame) -> DataFrame:
    """Hits (contig, start, stop, model_ord, hit_ord, name, accession, clen, score, evalue): rRNAs by their coverage of the model, others by E-value;
    numbered in model order."""
    h = oriented(hits).withColumn("class", T.ncrna_class("name"))
    cover = (F.col("e") - F.col("s") + 1) / F.col("clen")
    kept = h.where(F.when(F.col("class") == "Rrna", cover >= C.RRNA_MIN_COVERAGE).otherwise(F.col("evalue") <= C.NCRNA_MAX_EVALUE))
    return _features(kept, F.col("class"), "ncrna", F.col("name"), F.col("accession"), F.col("score"), F.col("evalue"), order=("model_ord", "hit_ord"))


def is_elements(calls: DataFrame) -> DataFrame:
    """Calls (contig, s, e, strand, ord, family, pident): the family is name and accession, the identity the score."""
    return _features(calls, "IsElement", "is", F.col("family"), F.col("family"), F.col("pident"), order=("ord",))


def tandem_repeats(calls: DataFrame) -> DataFrame:
    """Calls (contig, s, e, ord, period, copies in tenths)."""
    name = F.concat(F.lit("tandem repeat period="), F.col("period").cast("string"), F.lit(" copies="), F.floor(F.col("tenths") / 10).cast("string"), F.lit("."), (F.col("tenths") % 10).cast("string"))
    return _features(calls.withColumn("strand", F.lit(1)), "TandemRepeat", "trf", name, F.lit("-"), F.col("tenths") / 10, order=("ord",))


def crispr(calls: DataFrame) -> DataFrame:
    """Calls (contig, s, e, repeats), numbered over the whole genome."""
    return global_number(calls, "s", "e").select("contig", F.concat(F.lit("CRISPR"), F.col("n").cast("string")).alias("id"), F.lit("Crispr").alias("kind"), "s", "e", F.lit(1).alias("strand"), F.lit("CRISPR").alias("name"), F.lit("-").alias("accession"), F.col("repeats").cast("double").alias("score"), F.lit(None).cast("double").alias("evalue"))


def oric(calls: DataFrame) -> DataFrame:
    """Calls (contig, s, e, hint_gene, hint_product, hint_name): one is ``contig_oriC``, several are numbered; the hint is gene, else product, else best name."""
    many = calls.groupBy("contig").agg(F.count("*").alias("many"))
    numbered = split_numbered(calls, "s", "e").join(many, "contig")
    ident = F.concat("contig", F.lit("_oriC"), F.when(F.col("many") > 1, F.concat(F.lit("_"), F.col("num").cast("string"))).otherwise(""))
    return numbered.select("contig", ident.alias("id"), F.lit("OriC").alias("kind"), "s", "e", F.lit(1).alias("strand"), F.coalesce(T.nonempty("hint_gene"), T.nonempty("hint_product"), T.nonempty("hint_name")).alias("name"), F.lit("-").alias("accession"), F.lit(None).cast("double").alias("score"), F.lit(None).cast("double").alias("evalue"))


def relaxases(hits: DataFrame) -> DataFrame:
    """Per CDS the best hit (fid, contig, s, e, strand, name, accession, score, evalue, has_ga, ord); the E-value bound isn't for models with their own threshold."""
    from contigframe.operators.hits import best_by

    ok = hits.where(F.col("has_ga") | (F.col("evalue") <= C.RELAXASE_MAX_EVALUE))
    best = best_by(ok, ["fid"], -F.col("score"), F.col("ord"))
    return best.withColumn("family", T.mob_family("name", "accession"))
