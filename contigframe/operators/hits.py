"""Similarity and profile hits: gates, best hits, enrichment joins, disrupted genes, summaries."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from contigframe import constants as C
from contigframe.functions import sequence as S
from contigframe.functions import text as T
from contigframe.operators import intervals as I
from contigframe.operators import sequences as Q
from contigframe.operators import tables


def best_by(rows: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each key in ``order``, which ends in something unique: a map-side combined top 1, not a sort of whole groups.

    The order is turned into one struct to be minimised, so numbers that sort down are negated by the caller's ``order``.
    """
    rest = [c for c in rows.columns if c not in keys]
    best = F.min(F.struct(*[o.alias(f"o{k}") for k, o in enumerate(order)], F.struct(*rest).alias("row"))).alias("m")
    return rows.groupBy(*keys).agg(best).select(*keys, "m.row.*").select(*rows.columns)


def _arrival(hits: DataFrame) -> Column:
    """What settles full ties: the first hit wins, by ``ord`` where hits carry it."""
    return F.col("ord" if "ord" in hits.columns else "t")


def best_hits(hits: DataFrame, *keys: str) -> DataFrame:
    """Per query the hit with most bits, then the lower E-value, then the first one."""
    return best_by(hits, list(keys) or ["q"], -F.col("bits"), F.col("evalue"), _arrival(hits))


def best_overall(hits: DataFrame) -> DataFrame:
    return hits.orderBy(F.col("bits").desc(), "evalue", "q", _arrival(hits)).limit(1)


def primary_target(hits: DataFrame) -> DataFrame:
    """Per query the hit with the lowest E-value, the first of equal ones."""
    return best_by(hits, ["q"], F.col("evalue"), _arrival(hits))


def psc_gate() -> Column:
    return (F.col("pident") >= C.PSC_MIN_IDENTITY) & (F.col("evalue") <= C.PSC_MAX_EVALUE)


def vf_gate() -> Column:
    return (F.col("evalue") <= C.VF_MAX_EVALUE) & (F.col("qcov") >= C.VF_MIN_QCOV) & (F.col("tcov") >= C.VF_MIN_TCOV) & (F.col("pident") >= C.VF_MIN_IDENTITY)


def plasmid_gate() -> Column:
    return (F.col("pident") >= C.PLASMID_MIN_IDENTITY) & (F.col("tcov") >= C.PLASMID_MIN_TCOV)


def amr_gate() -> Column:
    return F.col("pident") >= C.AMR_MIN_IDENTITY


def attc_gate() -> Column:
    return F.col("evalue") <= C.ATTC_MAX_EVALUE


def sorf_gate() -> Column:
    return (F.col("qcov") >= C.SORF_QCOV) & (F.col("tcov") >= C.SORF_TCOV) & (F.col("evalue") <= C.SORF_PSC_EVALUE)


def supported_rank(identity: Column | str) -> Column:
    """The rank that an identity to a 16S reference supports."""
    i = T.col(identity)
    return F.when(i >= C.SPECIES_IDENTITY, "species").when(i >= C.GENUS_IDENTITY, "genus").otherwise("family")


def attach_hits(cds: DataFrame, annotations: DataFrame) -> DataFrame:
    """``cds`` (fid, ...) with its ``annotations`` (fid, ord, ...) as an array in order; empty where it has none."""
    rest = [c for c in annotations.columns if c not in ("fid", "ord")]
    lists = annotations.groupBy("fid").agg(F.array_sort(F.collect_list(F.struct("ord", *rest))).alias("annotations"))
    kind = lists.schema["annotations"].dataType
    return cds.join(lists, "fid", "left").withColumn("annotations", F.coalesce("annotations", F.array().cast(kind)))


def rank_annotations(annotations: DataFrame) -> DataFrame:
    """With ``rank``: 1 for the highest score of a feature, the first of equal ones."""
    return annotations.withColumn("rank", F.row_number().over(Window.partitionBy("fid").orderBy(F.col("score").desc(), "ord")))


def amr_sites(hits: DataFrame, catalog: DataFrame) -> DataFrame:
    """Hits that are close enough, with each mutation that ``catalog`` (t, ...) has of their target."""
    return hits.where(amr_gate()).join(catalog, "t")


def unresolved(hits: DataFrame, resolved: DataFrame) -> DataFrame:
    """(q) of the queries that aren't among ``resolved`` (q)."""
    return hits.select("q").distinct().join(resolved.select("q").distinct(), "q", "left_anti")


def plasmid_replicons(hits: DataFrame) -> DataFrame:
    """The hit with most bits of each contig (q) and replicon type among those that pass the gate, the first of equal ones."""
    return best_by(hits.where(plasmid_gate()), ["q", "type"], -F.col("bits"), _arrival(hits))


def sorf_support(profiles: DataFrame, proteins: DataFrame, names: DataFrame) -> DataFrame:
    """(q, t, by) of short reading frames that are genes: by their best profile hit, else by the best protein hit that passes the gate and whose
    target has an informative product in ``names`` (t, product)."""
    hmm = best_hits(profiles).select("q", "t", F.lit("hmm").alias("by"))
    rest = proteins.join(hmm.select("q"), "q", "left_anti").join(names, "t").where(sorf_gate() & T.informative_product("product"))
    return hmm.unionByName(best_hits(rest).select("q", "t", F.lit("psc").alias("by")))


def intergenic_pseudogenes(hits: DataFrame) -> DataFrame:
    """One pseudogene without a protein for each region (q) between genes with homology to a family: ``hits`` (q, contig, region_s, t, ord, evalue, qs,
    qe, ts, te, tlen) are translated, qs above qe on the minus strand; the lowest E-value counts, the first of equal ones."""
    tcov = (F.abs(F.col("te") - F.col("ts")) + 1) / F.col("tlen")
    good = hits.where((F.col("evalue") <= C.PSEUDO_MAX_EVALUE) & (F.col("tlen") >= C.PSEUDO_MIN_TLEN) & (tcov >= C.INTERGENIC_TCOV))
    best = primary_target(good).withColumn("s", F.col("region_s") + F.least("qs", "qe") - 1)
    percent = F.bround(tcov * 100, 0).cast("int").cast("string")
    note = F.concat(F.lit("intergenic homology to family "), F.col("t").cast("string"), F.lit(" ("), percent, F.lit("% of reference, translated) — degraded/uncalled gene"))
    return best.select(
        "contig", F.concat_ws("_", F.lit("igpseudo"), "contig", F.col("s").cast("string")).alias("id"), F.lit("Cds").alias("kind"), "s", (F.col("region_s") + F.greatest("qs", "qe") - 1).alias("e"),
        S.frame_of("qs", "qe")[0].alias("strand"), F.lit(True).alias("pseudogene"), F.lit(None).cast("string").alias("aa"), F.array(note).alias("notes"),
    )


def best_annotation(annotations: DataFrame) -> DataFrame:
    """Per feature the annotation with the highest score; of equal ones the last."""
    return best_by(annotations, ["fid"], -F.col("score"), -F.col("ord"))


def kofam_assign(hits: DataFrame, ko: DataFrame) -> DataFrame:
    """(fid, ko, margin, score): of the profiles whose threshold the applied score (whole or best domain) reaches, the one with the
    largest margin, then score, then the first hit. Profiles without threshold or type are skipped."""
    joined = hits.join(ko, "ko").where("threshold is not null and score_type in ('full', 'domain')")
    scored = joined.withColumn("applied", F.when(F.col("score_type") == "full", F.col("seq_score")).otherwise(F.col("dom_score"))).withColumn("margin", F.col("applied") - F.col("threshold")).where("margin >= 0")
    return best_by(scored, ["fid"], -F.col("margin"), -F.col("applied"), F.col("ord")).select("fid", "ko", "margin", F.col("applied").alias("score"))


def xref_enrich(annotations: DataFrame, table: DataFrame) -> DataFrame:
    """(fid, accession, product, gene): the first annotation by score that resolves in ``table`` (acc, product, gene), by its whole accession,
    else without its version; one record is used whole. Rows of ``table`` without product and gene resolve nothing."""
    known = table.select("acc", T.nonempty("product").alias("product"), T.nonempty("gene").alias("gene")).where("product is not null or gene is not null")
    usable = annotations.where("accession <> ''").withColumn("bare", T.strip_version("accession"))
    exact = usable.join(known.withColumnRenamed("acc", "accession"), "accession", "left").select("fid", "accession", "bare", "score", "ord", F.col("product").alias("p1"), F.col("gene").alias("g1"))
    both = exact.join(known.withColumnRenamed("acc", "bare"), "bare", "left")
    hit = F.col("p1").isNotNull() | F.col("g1").isNotNull()
    resolved = both.select("fid", "accession", "score", "ord", F.when(hit, F.col("p1")).otherwise(F.col("product")).alias("product"), F.when(hit, F.col("g1")).otherwise(F.col("gene")).alias("gene")).where("product is not null or gene is not null")
    return best_by(resolved, ["fid"], -F.col("score"), F.col("ord")).select("fid", "accession", "product", "gene")


def pfam_go_merge(annotations: DataFrame, go: DataFrame) -> DataFrame:
    """(fid, go): terms of all family annotations (accession PF...), each once, in order.

    Terms in order are dealt to words of 62, one bit each. A family's terms are so few bits that a feature's are an OR of numbers, combined before the
    shuffle; names come back in the end. The vocabulary of terms is numbered by one window.
    """
    known = go.select("acc", "go").where("acc is not null and go is not null").distinct()
    nth = F.row_number().over(Window.orderBy("go")) - 1
    terms = known.select("go").distinct().select("go", F.floor(nth / 62).cast("int").alias("word"), (nth % 62).cast("int").alias("bit"))
    families = known.join(terms, "go").groupBy("acc", "word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
    named = annotations.where(F.col("accession").startswith("PF")).select("fid", T.strip_version("accession").alias("acc"))
    merged = named.join(families, "acc").groupBy("fid", "word").agg(F.bit_or("bits").alias("bits"))
    words = terms.groupBy("word").agg(F.array_sort(F.collect_list(F.struct("bit", "go"))).alias("names"))
    chosen = F.transform(F.filter("names", lambda x: F.getbit("bits", x["bit"]) == 1), lambda x: x["go"])
    listed = tables.salted_join(merged, words, ["word"]).select("fid", "word", chosen.alias("go"))
    return listed.groupBy("fid").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("word", "go"))), lambda x: x["go"])).alias("go"))


def needs_psc(product: Column | str, aa: Column | str) -> Column:
    return (F.trim(T.col(aa)) != "") & (T.col(product).isNull() | T.is_placeholder(product))


def names_for(names: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows of a large names table whose id is wanted: a semi join; Spark broadcasts the ids where their size allows."""
    return names.join(wanted.distinct(), "id", "left_semi")


def union_hits(*passes: DataFrame) -> DataFrame:
    """Hits of several passes, the best of each query kept."""
    out = passes[0]
    for p in passes[1:]:
        out = out.unionByName(p)
    return best_hits(out)


def primary_hits(hits: DataFrame) -> DataFrame:
    """The significant hits (q, t, ord, evalue, qs, qe, ts, te, tlen) of each query to its primary target, with that hit's ``tlen``; targets that are
    too short are left out."""
    good = hits.where(F.col("evalue") <= C.PSEUDO_MAX_EVALUE)
    first = primary_target(good).where(F.col("tlen") >= C.PSEUDO_MIN_TLEN).select("q", "t", "tlen")
    return good.drop("tlen").join(first, ["q", "t"])


def split_pairs(primary: DataFrame) -> DataFrame:
    """(q, a_ord, b_ord, kind) of queries that ``primary_hits`` show as broken: a first piece and one behind it, in the target as in the query, on one
    strand, that make up one target between them; "frameshift" if they read in different phases, else "internal_stop". The first pair by order
    counts."""
    strand, phase = S.frame_of("qs", "qe")
    rows = primary.withColumns({"lo": F.least("qs", "qe"), "hi": F.greatest("qs", "qe"), "strand": strand, "phase": phase, "len": F.col("te") - F.col("ts") + 1}).where(F.col("len") >= C.SPLIT_PIECE_AA)
    cols = ["ord", "ts", "te", "lo", "hi", "phase", "len"]
    a = rows.select("q", "strand", "tlen", *[F.col(c).alias(f"a_{c}") for c in cols])
    b = rows.select("q", "strand", *[F.col(c).alias(f"b_{c}") for c in cols])
    ok = (
        (F.col("a_ts") <= F.col("b_ts")) & (F.col("a_te") <= F.col("b_te")) & (F.col("a_te") - F.col("b_ts") + 1 <= C.SPLIT_OVERLAP) & (F.col("b_ts") - F.col("a_te") - 1 <= C.SPLIT_TGAP)
        & (F.col("b_te") - F.col("a_ts") + 1 >= C.SPLIT_UNION * F.col("tlen")) & (F.col("a_len") + F.col("b_len") <= C.SPLIT_SUM * F.col("tlen"))
        & (F.col("b_lo") > F.col("a_lo")) & (F.col("b_lo") - F.col("a_hi") - 1 <= C.SPLIT_QGAP) & (F.col("b_hi") - F.col("a_lo") + 1 <= C.SPLIT_SPAN * F.col("tlen") * 3)
    )
    kind = F.when(F.col("a_phase") != F.col("b_phase"), "frameshift").otherwise("internal_stop")
    pairs = a.join(b, ["q", "strand"]).where(ok).select("q", "a_ord", "b_ord", kind.alias("kind"))
    return best_by(pairs, ["q"], F.col("a_ord"), F.col("b_ord"))


def truncations(primary: DataFrame, genes: DataFrame) -> DataFrame:
    """(q, lost) of transposases among ``genes`` (q, aa_len, transpos) whose longest hit (the last of equal ones) covers a part of the target with an
    intact end, and which are short themselves."""
    longest = best_by(primary, ["q"], -(F.col("te") - F.col("ts")), -F.col("ord")).withColumn("len", F.col("te") - F.col("ts") + 1)
    tlen = F.col("tlen")
    n_end, c_end = F.col("ts") <= 1 + C.TRUNC_END, F.col("te") >= tlen - C.TRUNC_END
    part = (F.col("len") >= C.SPLIT_PIECE_AA) & (F.col("len") / tlen).between(C.TRUNC_MIN, C.TRUNC_MAX) & (n_end | c_end)
    lost = F.when(n_end & ~c_end, "C-terminal").when(c_end & ~n_end, "N-terminal").otherwise("internal")
    return genes.where("transpos").join(longest.where(part), "q").where(F.col("aa_len") < F.floor(C.TRUNC_RATIO * tlen)).select("q", lost.alias("lost"))


def disruption_flags(queries: DataFrame, hits: DataFrame) -> DataFrame:
    """(q, t, kind) of ``queries`` (q, edge, aa_len, transpos) away from contig edges: a split of the primary target, else a truncation."""
    primary = primary_hits(hits.join(queries.where("not edge").select("q"), "q", "left_semi"))
    pairs = split_pairs(primary).select("q", "kind")
    cut = truncations(primary, queries).select("q", F.lit("truncation").alias("cut"))
    flagged = primary.select("q", "t").distinct().join(pairs, "q", "left").join(cut, "q", "left")
    return flagged.select("q", "t", F.coalesce("kind", "cut").alias("kind")).where("kind is not null")


def reflen_truncation(cds: DataFrame) -> DataFrame:
    """(fid) of whole CDS (fid, aa_len, ref_lens, partial, pseudo) much shorter than the longest reference."""
    longest = F.array_max("ref_lens")
    ratio = F.lit(Decimal(str(C.REFLEN_RATIO)))  # exact: as doubles, 0.55 * 100 is more than 55
    return cds.where((F.col("aa_len") >= C.REFLEN_MIN_AA) & (longest >= C.REFLEN_MIN_REF) & (F.col("aa_len") < ratio * longest) & ~F.col("partial") & ~F.col("pseudo")).select("fid")


def qc_report(products: DataFrame, markers: DataFrame) -> DataFrame:
    """One row: expected, present, completeness, contamination, duplicated, disrupted, missing, from (kind, product, pseudogene) rows; only CDS count."""
    counted = products.where("kind = 'Cds'").withColumn("marker", T.marker_key("product")).where("marker is not null").groupBy("marker").agg(F.sum((~F.col("pseudogene")).cast("int")).alias("intact"), F.sum(F.col("pseudogene").cast("int")).alias("pseudo"))
    m = markers.join(counted, "marker", "left").na.fill(0, ["intact", "pseudo"])
    listed = lambda cond: F.array_join(F.sort_array(F.collect_list(F.when(cond, F.col("marker")))), ",")
    intact, pseudo = F.col("intact"), F.col("pseudo")
    return m.agg(
        F.count("*").alias("expected"), F.sum((intact + pseudo > 0).cast("int")).alias("present"), listed(intact >= 2).alias("duplicated"), listed((intact == 0) & (pseudo >= 1)).alias("disrupted"), listed(intact + pseudo == 0).alias("missing"),
        F.round(100.0 * F.sum((intact + pseudo > 0).cast("int")) / F.count("*"), 4).alias("completeness"), F.round(100.0 * F.sum((intact >= 2).cast("int")) / F.count("*"), 4).alias("contamination"),
    )


def tree_closure(nodes: DataFrame, roots: DataFrame) -> DataFrame:
    """(id) of ``roots`` (id) and all their descendants in ``nodes`` (child, parent), by pointer doubling.

    Each node points up and knows whether a root lies on the way there; each round it takes over its target's pointer, so a chain of n nodes takes
    about log2 n rounds. Many nodes come to point to few, which a salted join evens out. Where a node has several parents, the
    pointers are its own edges, each followed alike. Cycles end, as no way is longer than the count of edges.
    """
    edges = nodes.where("child <> parent").select(F.col("child").alias("id"), F.col("parent").alias("up")).distinct()
    with tables.Rounds(nodes.sparkSession, "closure") as tmp:
        known = roots.select("id").distinct()
        count = (edges := tmp.written(edges)).count()
        first = tmp.written(edges.join(known.withColumn("hit", F.lit(True)).withColumnRenamed("id", "up"), "up", "left").select("id", "up", F.coalesce("hit", F.lit(False)).alias("hit")))
        found, open_, jumps = first.where("hit").select("id"), first.where("not hit").select("id", "up"), first
        for _ in range(tables.doublings(count)):
            ahead = jumps.select(F.col("id").alias("up"), F.col("up").alias("further"), "hit")
            moved = tmp.written(tables.salted_join(open_, ahead, ["up"]).groupBy("id", "further").agg(F.max("hit").alias("hit")))
            if not moved.limit(1).count():
                break
            got = tmp.written(moved.where("hit").select("id").distinct())
            found = found.unionByName(got)
            jumps = moved.select("id", F.col("further").alias("up"), "hit")
            open_ = jumps.where("not hit").select("id", "up").join(got, "id", "left_anti")
            # a node on whose way a root was found answers for whoever points to it
            settled = found.select("id", F.col("id").alias("up"), F.lit(True).alias("hit")).distinct()
            jumps = tmp.written(jumps.join(settled.select("id"), "id", "left_anti").unionByName(settled))
        return tables.written(known.unionByName(found).distinct(), "closure")


def merged_ids(accepted: DataFrame, merged: DataFrame) -> DataFrame:
    """``accepted`` ids with old ones that were merged into an accepted id."""
    return accepted.unionByName(merged.join(accepted.withColumnRenamed("id", "new"), "new", "left_semi").select(F.col("old").alias("id"))).distinct()


def fragment_runs(cds: DataFrame) -> DataFrame:
    """(contig, strand, ref, first, n): runs of neighbouring CDS of one reference, gap within -30..60, at least two."""
    w = Window.partitionBy("contig", "strand").orderBy("s", "e", "id")
    gap = F.col("s") - F.lag("e").over(w) - 1
    same = (F.lag("ref").over(w) == F.col("ref")) & gap.between(-C.LEGACY_OVERLAP, C.LEGACY_GAP)
    runs = cds.withColumn("__new", (~F.coalesce(same, F.lit(False))).cast("int")).withColumn("run", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return runs.groupBy("contig", "strand", "run").agg(F.min("ref").alias("ref"), F.min_by("id", F.struct("s", "e", "id")).alias("first"), F.count("*").alias("n")).where("n > 1").drop("run")


def frameshift_fragments(cds: DataFrame) -> DataFrame:
    """(id) of both of two neighbours on a strand (contig, id, s, e, strand, aa_len, acc) that overlap by 1 to 8 bases in another frame, are both
    short, and have either no accession or the same one."""
    w = Window.partitionBy("contig", "strand").orderBy("s", "id")
    nxt = lambda c: F.lead(c).over(w)
    acc, other = F.coalesce("acc", F.lit("")), F.coalesce(nxt("acc"), F.lit(""))
    shift = F.when(F.col("strand") >= 0, nxt("s") - F.col("s")).otherwise(F.col("e") - nxt("e"))
    rows = cds.select("id", nxt("id").alias("next_id"), (F.col("e") - nxt("s") + 1).alias("lap"), F.pmod(shift, F.lit(3)).alias("shift"), ((F.col("aa_len") <= C.LEGACY_SHORT) & (nxt("aa_len") <= C.LEGACY_SHORT) & (acc == other)).alias("ok"))
    pairs = rows.where(F.col("lap").between(*C.FRAMESHIFT_OVERLAP) & (F.col("shift") != 0) & F.col("ok"))
    return pairs.select(F.explode(F.array("id", "next_id")).alias("id")).distinct()


def truncated_genes(cds: DataFrame) -> DataFrame:
    """(id): the legacy rule, against the reference's length."""
    return cds.where((F.col("ref_len") >= C.LEGACY_MIN_REF) & (F.col("aa_len") < C.LEGACY_RATIO * F.col("ref_len")) & (F.col("ref_len") - F.col("aa_len") >= C.LEGACY_SHORTFALL)).select("id")


def uncovered_downstream_orf(cds: DataFrame, covering: DataFrame, contigs: DataFrame) -> DataFrame:
    """(id, codons): how many sense codons follow each of ``cds`` (contig, id, s, e, strand) in its frame, up to a stop, an N, a base that one of
    ``covering`` on its strand covers, the contig's end, or ``READTHROUGH_CAP``."""
    cap = 3 * C.READTHROUGH_CAP
    fwd = F.col("strand") >= 0
    ahead = cds.select("contig", "id", "strand", F.when(fwd, F.col("e") + 1).otherwise(F.col("s") - cap).alias("s"), F.when(fwd, F.col("e") + cap).otherwise(F.col("s") - 1).alias("e"))
    same = F.col("a_strand") == F.col("b_strand")
    free = F.when(F.col("a_strand") >= 0, F.greatest("b_s", "a_s") - F.col("a_s")).otherwise(F.col("a_e") - F.least("b_e", "a_e"))
    room = I.overlap_join(ahead, covering.select("contig", "id", "s", "e", "strand"), same).groupBy(F.col("a_id").alias("id")).agg(F.min(free).alias("free"))
    known = ahead.join(contigs.select("contig").distinct(), "contig", "left_semi")
    rows = Q.slices(known.join(room, "id", "left"), Q.sequence_chunks(contigs), "piece")  # never longer than a chunk's halo
    piece = F.coalesce(F.upper("piece"), F.lit(""))
    reading = F.when(fwd, piece).otherwise(S.revcomp_n(piece))
    cut = F.substring(reading, F.lit(1), F.least(F.coalesce("free", F.lit(cap)), F.lit(cap)).cast("int"))
    words = F.transform(S.codons(cut), lambda c: c.isin(*C.STOPS) | c.contains("N"))
    end = F.array_position(words, True)
    return rows.select("id", F.when(end > 0, end - 1).otherwise(F.size(words)).cast("long").alias("codons"))


def internal_stop_readthrough(cds: DataFrame, contigs: DataFrame, least: int = C.READTHROUGH_CODONS) -> DataFrame:
    """(id, codons) of short CDS (contig, id, s, e, strand, aa_len, ref_len) away from contig ends and without a reference length that are followed by at
    least ``least`` uncovered codons in frame."""
    inner = (F.col("aa_len") > 0) & (F.col("aa_len") <= C.LEGACY_SHORT) & F.col("ref_len").isNull()
    placed = cds.where(inner).join(contigs.select("contig", F.length("seq").alias("__n")), "contig").where((F.col("s") > C.EDGE) & (F.col("e") < F.col("__n") - C.EDGE))
    return uncovered_downstream_orf(placed.select("contig", "id", "s", "e", "strand"), cds, contigs).where(F.col("codons") >= least)


def run_counts(features: DataFrame) -> DataFrame:
    """Totals for the run's summary."""
    return features.agg(F.count("*").alias("total"), F.count("aa").alias("cds"), F.sum((F.col("n_annotations") > 0).cast("long")).alias("annotated"), F.sum(F.exists("notes", lambda x: x.startswith("virulence factor")).cast("long")).alias("virulence"))


def least_value(rows: DataFrame, keys: list[str], value: Column, name: str) -> DataFrame:
    """The smallest ``value`` of each key that isn't null; null where none is."""
    return rows.groupBy(*keys).agg(F.min(value).alias(name))


def distinct_flags(rows: DataFrame, keys: list[str], note: str, flag: Column) -> DataFrame:
    """(``keys``, notes, pseudogene): the different notes of each key in order, and whether any of its rows has the flag."""
    return rows.groupBy(*keys).agg(F.array_sort(F.collect_set(note)).alias("notes"), F.coalesce(F.max(flag), F.lit(False)).alias("pseudogene"))


def lineages(hits: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """Hits with the lineage of their target, of those that ``taxonomy`` (id, lineage) knows."""
    return hits.join(taxonomy.withColumnRenamed("id", "t"), "t")


def union_features(*tables_: DataFrame) -> DataFrame:
    """Features of several tiers, in order; columns that one lacks are null."""
    out = tables_[0]
    for more in tables_[1:]:
        out = out.unionByName(more, allowMissingColumns=True)
    return out


def common_ids(first: DataFrame, *others: DataFrame, key: str = "q") -> DataFrame:
    """The different ids that all tables have."""
    out = first.select(key).distinct()
    for other in others:
        out = out.intersect(other.select(key))
    return out
