"""Tiers that search: which sequences they ask for, with which settings, and what their hits say.

``database`` is a table of references (t, seq) or a stored index; with None a tier has no result. ``provider`` makes a search from (kind, E-value, most targets,
letters of a seed); the default one is this library's own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contigframe import constants as C
from contigframe.functions import text as T
from contigframe.operators import hits as H
from contigframe.operators import intervals as I
from contigframe.operators import scans, tables
from contigframe.operators import sequences as Q
from contigframe.operators.detectors import SearchProvider
from contigframe.operators.search import NUCLEOTIDE, PROTEIN, TRANSLATED, References, SeedSearch, contig_queries
from contigframe.sources import sinks as K

Provider = Callable[..., SearchProvider]
Database = DataFrame | References | None


def _search(tier: str, kind: str, queries: DataFrame, database: Database, provider: Provider) -> DataFrame | None:
    evalue, most, k = C.SEARCH[tier]
    return provider(kind, evalue=evalue, max_seqs=most, k=k).search(queries, database)


def _m8(hits: DataFrame) -> DataFrame:
    """Hits as the gates name them."""
    return hits.select(F.col("query").alias("q"), F.col("target").alias("t"), F.col("hit_ord").alias("ord"), "pident", "evalue", "bits", "qcov", "tcov", F.col("qstart").alias("qs"), F.col("qend").alias("qe"), F.col("tstart").alias("ts"), F.col("tend").alias("te"), "tlen", "alnlen")


def proteins_of(cds: DataFrame, contigs: DataFrame) -> DataFrame:
    """(q, seq) of whole CDS (id, contig, s, e, strand) on their contigs: translated up to the first stop, the first codon as M where it is a start."""
    rows = tables.written(cds.select("id", "contig", F.col("s").cast("long").alias("s"), F.col("e").cast("long").alias("e"), "strand"), "cds")
    got = scans.feature_seq(rows, contigs).where(F.length("sub") >= 3).select(F.col("id").alias("q"), "sub")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for sub in batch.column("sub").to_pylist():
                aa = scans.residues(sub)
                out.append((("M" if sub[:3] in C.STARTS else aa[0]) + aa[1:]).split("*", 1)[0])
            yield pa.RecordBatch.from_arrays([batch.column("q"), pa.array(out, pa.string())], names=["q", "seq"])

    return got.mapInArrow(work, f"q {got.schema['q'].dataType.simpleString()}, seq string")


def disruption_search(cds: DataFrame, contigs: DataFrame, database: Database, provider: Provider = SeedSearch) -> DataFrame | None:
    """(id, t, kind, note) of CDS (id, contig, s, e, strand, aa_len, transpos) that a translated search of their surroundings shows as broken."""
    regions = K.query_regions(cds.select("contig", "s", "e", "id", "strand"), contigs, C.QUERY_UP, C.QUERY_DOWN, C.QUERY_MIN)
    hits = _search("disruption", TRANSLATED, regions.select(F.col("id").alias("q"), F.col("sub").alias("seq")), database, provider)
    if hits is None:
        return None
    genes = regions.select("id", (F.col("edge") == 1).alias("edge")).join(cds.select("id", "aa_len", "transpos"), "id").withColumnRenamed("id", "q")
    found = H.disruption_flags(genes, _m8(hits))
    return found.select(F.col("q").alias("id"), "t", "kind", F.concat(F.lit("aligned "), "kind", F.lit(" vs consensus family "), "t").alias("note"))


def intergenic_search(features: DataFrame, contigs: DataFrame, database: Database, provider: Provider = SeedSearch) -> DataFrame | None:
    """New pseudogenes between ``features`` (contig, s, e): as ``intergenic_pseudogenes`` gives them. Places of features and gaps are tables, as several steps read them."""
    if database is None:
        return None
    sized = contigs.select("contig", F.length("seq").cast("long").alias("length"))
    gaps = I.intergenic_regions(tables.written(features.select("contig", "s", "e"), "places"), sized)
    gaps = tables.written(gaps.withColumn("q", F.concat_ws("|", F.lit("IG"), "contig", F.col("s").cast("string"), F.col("e").cast("string"))), "gaps")
    hits = _search("disruption", TRANSLATED, Q.slices(gaps, Q.sequence_chunks(contigs)).select("q", F.col("sub").alias("seq")), database, provider)
    if hits is None:
        return None
    return H.intergenic_pseudogenes(_m8(hits).join(gaps.select("q", "contig", F.col("s").alias("region_s")), "q"))


def psc_search(proteins: DataFrame, database: Database, names: DataFrame, provider: Provider = SeedSearch) -> DataFrame | None:
    """(q, t, product, bits, evalue, qcov, tcov): of proteins (q, seq) the best hit that passes the gate, named by ``names`` (t, product)."""
    hits = _search("psc", PROTEIN, proteins.where(F.trim("seq") != ""), database, provider)
    if hits is None:
        return None
    best = H.best_hits(_m8(hits).where(H.psc_gate()))
    return best.join(names, "t").select("q", "t", T.clean_product("product").alias("product"), "bits", "evalue", "qcov", "tcov")


def residue_at(qaln: Column, taln: Column, tstart: Column, pos: Column) -> Column:
    """The query's letter at a place of the target, "-" where it is deleted, null outside of the alignment. The column is found by summing up the runs of
    letters and gaps of the target, not column by column."""
    runs = F.regexp_extract_all(taln, F.lit("(-+|[^-]+)"), 1)
    start = F.struct((tstart.cast("long") - 1).alias("ref"), F.lit(0).cast("long").alias("col"), F.lit(0).cast("long").alias("at"))

    def step(x: Column, run: Column) -> Column:
        n, gap = F.length(run).cast("long"), run.startswith("-")
        here = ~gap & (pos > x["ref"]) & (pos <= x["ref"] + n)
        return F.struct((x["ref"] + F.when(gap, 0).otherwise(n)).alias("ref"), (x["col"] + n).alias("col"), F.when(here, x["col"] + pos - x["ref"]).otherwise(x["at"]).alias("at"))

    at = F.aggregate(runs, start, step, lambda x: x["at"])
    return F.when(at > 0, F.substring(qaln, at.cast("int"), F.lit(1)))


def mutation_calls(hits: DataFrame, catalog: DataFrame) -> DataFrame:
    """(id, ord, symbol, class, gene, spec): changes of ``catalog`` (accession, symbol, class, gene, ref, pos, effect, alt, span) that alignments ``hits`` (q, t, ord, pident, tstart,
    qaln, taln) of close references show. A deletion needs every residue of its span deleted, a nonsense change a stop in the query."""
    sites = hits.where(H.amr_gate()).join(catalog.withColumnRenamed("accession", "t"), "t")
    at = lambda pos: residue_at(F.col("qaln"), F.col("taln"), F.col("tstart"), pos)
    deleted = F.forall(F.sequence(F.col("pos"), F.col("pos") + F.coalesce("span", F.lit(1)) - 1), lambda p: F.coalesce(at(p) == "-", F.lit(False)))
    shown = F.when(F.col("effect") == "substitution", at(F.col("pos")) == F.col("alt")).when(F.col("effect") == "nonsense", at(F.col("pos")) == "*").otherwise(deleted)
    change = F.when(F.col("effect") == "substitution", F.col("alt")).when(F.col("effect") == "nonsense", "Ter").otherwise("del")
    spec = F.concat(F.expr("repeat(ref, coalesce(span, 1))"), F.col("pos").cast("string"), change)
    return sites.where(F.coalesce(shown, F.lit(False))).select(F.col("q").alias("id"), "ord", "symbol", "class", "gene", spec.alias("spec"))


def variant_search(proteins: DataFrame, database: Database, catalog: DataFrame, provider: Provider = SeedSearch) -> DataFrame | None:
    """Resistance by point mutation: ``mutation_calls`` of proteins (q, seq) against those references (t, seq) that ``catalog`` knows changes of."""
    if database is None:
        return None
    evalue, most, k = C.SEARCH["amr_variants"]
    wanted = database.join(catalog.select(F.col("accession").alias("t")).distinct(), "t", "left_semi") if isinstance(database, DataFrame) else database
    hits = provider(PROTEIN, evalue=evalue, max_seqs=most, k=k, letters=True).search(proteins.where(F.trim("seq") != ""), wanted)
    if hits is None:
        return None
    return mutation_calls(hits.select(F.col("query").alias("q"), F.col("target").alias("t"), F.col("hit_ord").alias("ord"), "pident", "tstart", "qaln", "taln"), catalog)


def virulence_search(proteins: DataFrame, database: Database, provider: Provider = SeedSearch) -> DataFrame | None:
    """(q, t, ord, bits, evalue): of proteins (q, seq) the best virulence factor that passes the gate."""
    hits = _search("vfdb", PROTEIN, proteins.where(F.trim("seq") != ""), database, provider)
    return None if hits is None else H.best_hits(_m8(hits).where(H.vf_gate())).select("q", "t", "ord", "bits", "evalue")


def plasmid_search(contigs: DataFrame, database: Database, provider: Provider = SeedSearch) -> DataFrame | None:
    """The best replicon of each contig and type: (q, t, type, pident, tcov, bits, qs, qe)."""
    hits = _search("plasmid", NUCLEOTIDE, contig_queries(contigs), database, provider)
    if hits is None:
        return None
    typed = _m8(hits).withColumn("type", T.replicon_type("t"))
    return H.plasmid_replicons(typed).select("q", "t", "type", "pident", "tcov", "bits", F.least("qs", "qe").alias("qs"), F.greatest("qs", "qe").alias("qe"))


def species_search(rrnas: DataFrame, contigs: DataFrame, database: Database, provider: Provider = SeedSearch) -> DataFrame | None:
    """Hits (q, t, pident, evalue, bits, ord) of the small-subunit RNAs ``rrnas`` (id, contig, s, e, strand) in reference genes."""
    genes = scans.feature_seq(rrnas.select("id", "contig", F.col("s").cast("long").alias("s"), F.col("e").cast("long").alias("e"), "strand"), contigs)
    hits = _search("species", NUCLEOTIDE, genes.select(F.col("id").alias("q"), F.col("sub").alias("seq")).where("seq is not null"), database, provider)
    return None if hits is None else _m8(hits).select("q", "t", "pident", "evalue", "bits", "ord")


def orit_search(contigs: DataFrame, relaxases: DataFrame, database: Database, provider: Provider = SeedSearch) -> DataFrame | None:
    """Origins of transfer (contig, id, s, e, strand, t, pident, tcov, alnlen, evalue, bits, near): hits that pass the bar, near a relaxase (contig, s, e) or alone,
    the strongest of overlapping ones."""
    hits = _search("orit", NUCLEOTIDE, contig_queries(contigs), database, provider)
    if hits is None:
        return None
    s, e = F.least("qs", "qe"), F.greatest("qs", "qe")
    place = F.concat_ws("|", "q", F.col("ord").cast("string"))
    sites = _m8(hits).select(F.col("q").alias("contig"), place.alias("id"), s.alias("s"), e.alias("e"), F.when(F.col("qe") >= F.col("qs"), 1).otherwise(-1).alias("strand"), "t", "pident", "tcov", "alnlen", "evalue", "bits", "ord")
    return I.gate_orit(I.colocated(sites, relaxases.select("contig", "s", "e")))

