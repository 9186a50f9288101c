"""A whole annotation: contigs, call tables, databases and predictions in; resolved and tagged features, reports and files out."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contigframe import constants as C
from contigframe.functions import text as T
from contigframe.operators import hits as H
from contigframe.operators import homology, landing, scans, tables
from contigframe.operators import intervals as I
from contigframe.operators.search import SeedSearch
from contigframe.plans.config import Config
from contigframe.plans.tiers import Added, Tiers, shaped
from contigframe.sources import sinks as K

#: Calls that a run takes as they come, in the order of their tiers, and what their evidence is called.
CALLS = {"trna": "trna", "tmrna": "tmrna", "is": "is", "ncrna": "cm", "crispr": "crispr", "oric": "oric", "tandem": "tandem"}
LATE = ("oric", "tandem")


@dataclass
class Run:
    features: DataFrame
    species: DataFrame | None
    plasmids: DataFrame | None
    qc: DataFrame
    skipped: dict[str, str]


def noted(features: DataFrame, found: DataFrame) -> DataFrame:
    """``found`` (id, note): these features are pseudogenes; a note that they have isn't added again."""
    own = found.groupBy("id").agg(F.array_sort(F.collect_set("note")).alias("__n"))
    joined = features.join(own, "id", "left")
    return joined.withColumns({"pseudogene": F.col("pseudogene") | F.col("__n").isNotNull(), "notes": F.concat("notes", F.array_except(F.coalesce("__n", F.array().cast("array<string>")), "notes"))}).drop("__n")


def named(features: DataFrame, found: DataFrame) -> DataFrame:
    """``found`` (id, product, gene): both land where there is none."""
    own = found.select("id", F.col("product").alias("__p"), F.col("gene").alias("__g"))
    return features.join(own, "id", "left").withColumns({"product": F.coalesce("product", "__p"), "gene": F.coalesce("gene", "__g")}).drop("__p", "__g")


def called(calls: DataFrame, source: str) -> DataFrame:
    """Calls with their own evidence (name, accession, score) as an annotation."""
    if not {"name", "accession"} <= set(calls.columns) or "annotations" in calls.columns:
        return calls
    score = F.col("score").cast("double") if "score" in calls.columns else F.lit(None).cast("double")
    return calls.withColumn("annotations", F.array(F.struct(F.lit(source).alias("source"), "accession", "name", score.alias("score"))))


def annotate(config: Config, contigs: DataFrame, calls: Mapping[str, DataFrame], given: Mapping[str, DataFrame], kinds: DataFrame, provider: homology.Provider = SeedSearch) -> Run:
    """``calls``: features by detector ("cds" and those of ``CALLS``). ``given``, each as the rule that takes it says: "annotations" (id, ord, source,
    accession, name, score), "anchors", "xref", "kofam_hits" with "ko_list" and "ko_table", "psc" with "psc_names", "amr" with "amr_catalog" (or ready "amr_calls"), "vfdb" with
    "vfdb_entries", "integrases" and "attc", "hallmarks", "orit" with "relaxases", "rfam_types", "sorf_hits", "signals", "places", "gene_scores", "families",
    "ref_lens" (id, ref_len), "plasmids", "ssu", "lineages", "markers".

    Calls are required where given. Every other tier is optional: it runs where its tables (and, for those that ``Config`` names, its option) are there, and one
    that fails is noted in ``skipped`` and changes nothing. The order is the one that the rules rely on: names before evidence, evidence before regions,
    short frames against all calls, disruption after all naming; reports before overlaps are resolved.
    """
    has = lambda *names: all(n in given for n in names)
    first = [shaped(df.withColumn("kind", F.lit("Cds")) if "kind" not in df.columns else df) for name, df in calls.items() if name == "cds"]
    run = Tiers(first[0] if first else shaped(contigs.select("contig").limit(0)))
    cds = lambda f: f.where("kind = 'Cds'")
    proteins = lambda f: cds(f).where("aa is not null and trim(aa) <> ''").select(F.col("id").alias("q"), F.col("aa").alias("seq"))

    def attached(f: DataFrame) -> DataFrame:
        rows = given["annotations"].select(F.col("id").alias("fid"), "ord", "source", "accession", "name", F.col("score").cast("double").alias("score"))
        lists = rows.groupBy("fid").agg(F.array_sort(F.collect_list(F.struct("ord", F.struct("source", "accession", "name", "score").alias("a")))).alias("__l")).withColumnRenamed("fid", "id")
        more = F.coalesce(F.transform("__l", lambda x: x["a"]), F.array().cast(f"array<{landing.ANNOTATION}>"))
        return f.join(lists, "id", "left").withColumn("annotations", F.concat("annotations", more)).drop("__l")

    def refined(f: DataFrame) -> DataFrame:
        own = f.join(given["anchors"], "id").withColumnsRenamed({"s": "start", "e": "end"}).withColumn("aa_len", F.length("aa"))
        new = scans.refine_starts(own).select("id", F.col("new_start").alias("__s"), F.col("new_end").alias("__e"))
        moved = f.join(new, "id", "left").withColumns({"__k": (F.abs(F.coalesce("__s", "s") - F.col("s")) + F.abs(F.coalesce("__e", "e") - F.col("e"))) / 3})
        aa = F.when(F.col("__k") > 0, F.concat(F.lit("M"), F.substring("aa", (F.col("__k") + 2).cast("int"), F.length("aa")))).otherwise(F.col("aa"))
        return moved.withColumns({"s": F.coalesce("__s", "s"), "e": F.coalesce("__e", "e"), "aa": aa}).drop("__s", "__e", "__k")

    def from_xref(f: DataFrame) -> DataFrame:
        rows = given["annotations"].select(F.col("id").alias("fid"), "accession", "score", "ord")
        return named(f, H.xref_enrich(rows, given["xref"]).withColumnRenamed("fid", "id"))

    def from_psc(f: DataFrame) -> DataFrame | None:
        wanted = proteins(f.where(H.needs_psc(landing.display_product(), F.col("aa"))))
        found = homology.psc_search(wanted, given.get("psc"), given["psc_names"], provider)
        return None if found is None else landing.land_annotation(f, found.select(F.col("q").alias("id"), F.col("t").alias("accession"), F.col("product").alias("name"), F.col("bits").alias("score")), "psc")

    def from_vfdb(f: DataFrame) -> DataFrame | None:
        best = homology.virulence_search(proteins(f), given.get("vfdb"), provider)
        return None if best is None else landing.land_virulence(f, best.select(F.col("q").alias("id"), "ord", "t"), given["vfdb_entries"])

    def variants(f: DataFrame) -> DataFrame | None:
        found = given["amr_calls"] if has("amr_calls") else homology.variant_search(proteins(f), given.get("amr"), given["amr_catalog"], provider)
        return None if found is None else landing.land_mutations(f, found)

    def integrons(f: DataFrame) -> Added:
        found = I.integrons(given["integrases"], given["attc"])
        place = F.concat_ws("_", "contig", F.lit("integron"), F.col("s").cast("string"))
        return run.added(found.withColumns({"id": place, "notes": F.array(F.concat(F.lit("integron "), "class", F.lit(", attC sites: "), F.col("n_sites").cast("string")))}), "Integron")

    def prophages(f: DataFrame) -> Added:
        found = I.prophage_regions(given["hallmarks"], core=C.HALLMARK_CORE)
        note = F.concat("tier", F.lit(" prophage region, "), F.col("n_classes").cast("string"), F.lit(" hallmark classes"))
        return run.added(found.withColumns({"id": F.concat("contig", F.lit("_prophage"), F.col("num").cast("string")), "notes": F.array(note)}).drop("num"), "Prophage")

    def orits(f: DataFrame) -> Added | None:
        found = homology.orit_search(contigs, given["relaxases"], given.get("orit"), provider)
        if found is None:
            return None
        place = F.concat_ws("_", "contig", F.lit("oriT"), F.col("s").cast("string"))
        return run.added(found.drop("ord").withColumns({"id": place, "notes": F.array(F.concat(F.lit("origin of transfer like "), "t"))}), "OriT")

    def short_frames(f: DataFrame) -> Added:
        orfs = scans.short_orfs(contigs).withColumnsRenamed({"start": "s", "end": "e"})
        orfs = orfs.withColumn("id", F.concat_ws("_", "contig", F.lit("sorf"), F.col("s").cast("string"), F.col("e").cast("string"), F.col("strand").cast("string")))
        rule = (F.col("a_strand") == F.col("b_strand")) & (I.pair_overlap() * 2 > F.col("a_e") - F.col("a_s") + 1)
        free = I.overlap_join(orfs.select("contig", "id", "s", "e", "strand"), f.select("contig", "id", "s", "e", "strand"), rule, how="left_anti")
        return run.added(free.join(given["sorf_hits"].select("id").distinct(), "id", "left_semi"), "Cds")

    def disrupted(f: DataFrame) -> DataFrame | None:
        genes = cds(f).select("id", "contig", "s", "e", "strand", F.coalesce(F.length("aa"), F.lit(0)).cast("long").alias("aa_len"), T.is_transposase(F.coalesce(landing.display_product(), F.lit(""))).alias("transpos"))
        found = homology.disruption_search(genes, contigs, given.get("families"), provider)
        return None if found is None else noted(f, found.select("id", "note"))

    def uncalled(f: DataFrame) -> Added | None:
        found = homology.intergenic_search(f.select("contig", "s", "e"), contigs, given.get("families"), provider)
        return None if found is None else run.added(found)

    def too_short(f: DataFrame) -> DataFrame:
        lens = given["ref_lens"].groupBy("id").agg(F.collect_list("ref_len").alias("ref_lens"))
        genes = cds(f).join(lens, "id").select(F.col("id").alias("fid"), F.length("aa").alias("aa_len"), "ref_lens", (F.col("partial5") | F.col("partial3")).alias("partial"), F.col("pseudogene").alias("pseudo"))
        part = F.bround(100 * F.col("aa_len") / F.array_max("ref_lens"), 0).cast("int").cast("string")
        found = H.reflen_truncation(genes).join(genes, "fid").select(F.col("fid").alias("id"), F.concat(F.lit("truncated ("), part, F.lit("% of reference length)")).alias("note"))
        return noted(f, found)

    def gaps(f: DataFrame) -> Added:
        found = I.split_numbered(scans.assembly_gaps(contigs).withColumnsRenamed({"start": "s", "end": "e"}), "s")
        return run.added(found.withColumn("id", F.concat("contig", F.lit("_gap"), F.col("num").cast("string"))).drop("num"), "AssemblyGap", strand=1)

    run.optional("hmm", has("annotations"), attached)
    run.optional("start refinement", config.start_refine and has("anchors"), refined)
    run.optional("xref", has("annotations", "xref"), from_xref)
    run.optional("kofam", has("kofam_hits"), lambda f: landing.land_kofam(f, H.kofam_assign(given["kofam_hits"], given["ko_list"]).select(F.col("fid").alias("id"), "ko"), given["ko_table"]))
    run.optional("psc", has("psc_names"), from_psc)
    run.optional("amr variants", has("amr_calls") or has("amr_catalog"), variants)
    run.optional("vfdb", has("vfdb_entries"), from_vfdb)
    for name in (n for n in CALLS if n in calls and n not in LATE):
        run.required(lambda f, name=name: run.added(called(calls[name], CALLS[name])))
    run.optional("integron", has("integrases", "attc"), integrons)
    run.optional("prophage", has("hallmarks"), prophages)
    run.optional("orit", has("relaxases"), orits)
    run.optional("rfam", has("rfam_types"), lambda f: landing.reclassify_ncrna(f, given["rfam_types"]))
    run.optional("sorf", config.sorf and has("sorf_hits"), short_frames)
    run.optional("signal peptide", config.signal_peptide and has("signals"), lambda f: landing.land_signal_peptides(f, given["signals"]))
    run.optional("localization", config.localization and has("places"), lambda f: landing.land_localization(f, given["places"]))
    run.optional("gene score", config.gene_score and has("gene_scores"), lambda f: landing.land_gene_score(f, given["gene_scores"]))
    for name, wanted in (("oric", config.oric), ("tandem", config.tandem)):
        if wanted and name in calls:
            run.required(lambda f, name=name: run.added(called(calls[name], CALLS[name])))
    run.optional("gaps", config.gaps, gaps)
    run.optional("pseudogene", config.pseudo, disrupted)
    run.optional("intergenic", config.pseudo, uncalled)
    run.optional("reference length", config.full_mode and has("ref_lens"), too_short)
    plasmids = run.found("plasmid", "plasmids" in given, lambda f: homology.plasmid_search(contigs, given["plasmids"], provider))
    ssu = lambda f: f.where(landing.is_16s("kind", F.coalesce(landing.display_product(), F.lit("")), F.coalesce(landing.best_annotation()["accession"], F.lit(""))))

    def species(f: DataFrame) -> DataFrame | None:
        hits = homology.species_search(ssu(f), contigs, given["ssu"], provider)
        return None if hits is None else landing.identify_species(hits, given["lineages"])

    species = run.found("species", has("ssu", "lineages"), species)
    qc = tables.written(H.qc_report(run.features.select("kind", landing.display_product().alias("product"), "pseudogene"), given["markers"]), "qc")  # one row
    lowest = F.coalesce("score", F.lit(-3.4028235e38))
    resolved = run.ended(lambda f: I.resolve(f.withColumn("score", lowest), kinds))
    tagged = I.locus_tags(resolved, config.locus_prefix, "s", "e", "id")
    return Run(I.final_sort(tagged), species, plasmids, qc, run.skipped)


def files(run: Run, contigs: DataFrame, kinds: DataFrame) -> dict[str, DataFrame]:
    """The lines of the run's files: "tsv", "gff3", "gbff"; what they print of a feature is what evidence says, tidied."""
    best = landing.best_annotation()
    shown = landing.for_output(run.features).join(F.broadcast(kinds.select("kind", "so_type")), "kind")  # 14 rows
    table = run.features.withColumns({"name": best["name"], "accession": best["accession"], "score": best["score"], "evalue": F.lit(None).cast("double")})
    return {"tsv": K.tsv(table), "gff3": K.gff3(shown), "gbff": K.gbff(shown, contigs, kinds)}
