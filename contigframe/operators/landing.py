"""How evidence lands on features: annotations, products, terms and notes, and what of it the flat files show.

A feature has kind, product, gene, ko, ec, pathway, cog (bits), notes, inferences (category, kind, same_species, db, accession) and annotations
(source, accession, name, score) in the order in which they landed. Tiers add evidence always, and a product only where there is none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contigframe import constants as C
from contigframe.functions import text as T
from contigframe.operators import hits as H

INFERENCE = "struct<category: string, kind: string, same_species: boolean, db: string, accession: string>"
ANNOTATION = "struct<source: string, accession: string, name: string, score: double>"
FIELDS = {"kind": "string", "product": "string", "gene": "string", "ko": "string", "ec": "array<string>", "pathway": "array<string>", "cog": "int", "notes": "array<string>", "inferences": f"array<{INFERENCE}>", "annotations": f"array<{ANNOTATION}>", "signal": "string", "localization": "string", "gene_score": "double", "regulatory_class": "string"}


def functional(features: DataFrame) -> DataFrame:
    """``features`` with all fields that evidence lands on; those that are absent are null or empty."""
    empty = lambda t: F.array().cast(t) if t.startswith("array") else F.lit(0 if t == "int" else None).cast(t)
    return features.withColumns({c: empty(t) for c, t in FIELDS.items() if c not in features.columns})


def _inference(kind: str, db: str, accession: Column) -> Column:
    return F.struct(F.lit(None).cast("string").alias("category"), F.lit(kind).alias("kind"), F.lit(False).alias("same_species"), F.lit(db).alias("db"), accession.alias("accession"))


def land_annotation(features: DataFrame, found: DataFrame, source: str) -> DataFrame:
    """``found`` (id, accession, name, score), one row a feature: the annotation lands always, its cleaned name as the product where there is none."""
    named = found.select("id", F.struct(F.lit(source).alias("source"), "accession", T.clean_product("name").alias("name"), F.col("score").cast("double").alias("score")).alias("__a"))
    joined = features.join(named, "id", "left")
    return joined.withColumns({"annotations": F.when(F.col("__a").isNotNull(), F.concat("annotations", F.array("__a"))).otherwise(F.col("annotations")), "product": F.coalesce("product", "__a.name")}).drop("__a")


def land_kofam(features: DataFrame, assigned: DataFrame, table: DataFrame) -> DataFrame:
    """``assigned`` (id, ko) and ``table`` (ko, ec, pathway, cog): the orthology group of a CDS, with the enzyme numbers and pathways it hasn't yet, and
    its categories added to those it has. Groups that the table doesn't know land nothing."""
    known = assigned.join(table, "ko").select("id", F.col("ko").alias("__ko"), F.col("ec").alias("__ec"), F.col("pathway").alias("__p"), F.col("cog").alias("__c"))
    joined = features.join(known, "id", "left")
    lands = F.col("__ko").isNotNull() & (F.col("kind") == "Cds")
    more = lambda own, new: F.when(lands, F.array_distinct(F.concat(own, F.coalesce(new, F.array().cast("array<string>"))))).otherwise(F.col(own))
    return joined.withColumns({"ko": F.when(lands, F.col("__ko")).otherwise(F.col("ko")), "ec": more("ec", F.col("__ec")), "pathway": more("pathway", F.col("__p")), "cog": F.when(lands, F.col("cog").bitwiseOR(F.coalesce("__c", F.lit(0)))).otherwise(F.col("cog"))}).drop("__ko", "__ec", "__p", "__c")


def _land_notes(features: DataFrame, found: DataFrame, kind: str, db: str) -> DataFrame:
    """``found`` (id, ord, accession, note): each accession lands once on a feature, in order, unless the feature has its inference."""
    firsts = H.best_by(found, ["id", "accession"], F.col("ord"))
    lists = firsts.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("ord", "accession", "note"))).alias("__n"))
    joined = features.join(lists, "id", "left")
    had = F.transform(F.filter("inferences", lambda i: i["db"] == db), lambda i: i["accession"])
    new = F.filter(F.coalesce("__n", F.array().cast("array<struct<ord: int, accession: string, note: string>>")), lambda n: ~F.array_contains(had, n["accession"]))
    return joined.withColumn("__new", new).withColumns({"notes": F.concat("notes", F.transform("__new", lambda n: n["note"])), "inferences": F.concat("inferences", F.transform("__new", lambda n: _inference(kind, db, n["accession"])))}).drop("__n", "__new")


def land_virulence(features: DataFrame, best: DataFrame, entries: DataFrame) -> DataFrame:
    """``best`` (id, ord, t) hits and ``entries`` (t, accession, description): a note and an inference, once for each entry; never a product."""
    text = F.coalesce(T.nonempty("description"), F.col("accession"))
    found = best.join(entries, "t").select("id", F.col("ord").cast("int").alias("ord"), "accession", F.concat(F.lit("virulence factor: "), text).alias("note"))
    return _land_notes(features, found, "similar to AA sequence", "VFDB")


def land_mutations(features: DataFrame, calls: DataFrame) -> DataFrame:
    """``calls`` (id, ord, symbol, class, gene, spec): resistance by point mutation as a note and an inference, once for each symbol."""
    parsed = calls.withColumn("m", T.mutation_spec("spec")).where("m is not null")
    found = parsed.select("id", F.col("ord").cast("int").alias("ord"), F.col("symbol").alias("accession"), T.mutation_note(F.col("class"), F.col("gene"), F.col("m")).alias("note"))
    return _land_notes(features, found, "protein motif", "AMRFinderPlus")


def _land_prediction(features: DataFrame, found: DataFrame, land: dict[str, tuple[Column, Column]], notes: list[Column]) -> DataFrame:
    """Predictions (id, ...) of translated CDS: each column of ``land`` takes its value where its condition holds, and notes that aren't null follow."""
    own = found.select("id", F.struct(*[c for c in found.columns if c != "id"]).alias("__m"))
    joined = features.join(own, "id", "left")
    usable = (F.col("kind") == "Cds") & F.col("aa").isNotNull() & F.col("__m").isNotNull()
    kept = F.filter(F.array(*[F.when(usable, n) for n in notes]), lambda n: n.isNotNull())
    return joined.withColumns({"notes": F.concat("notes", kept), **{c: F.when(usable & ok, value).otherwise(F.col(c)) for c, (ok, value) in land.items()}}).drop("__m")


def _by(model: str, p: str) -> Column:
    return F.concat(F.lit(f"({model}p="), F.format_string("%.2f", F.col(p).cast("double")), F.lit(")"))


def land_signal_peptides(features: DataFrame, found: DataFrame, model: str = "") -> DataFrame:
    """``found`` (id, signal, p, helices) of a neural model: helices land on any CDS (with aa, partial5), a signal peptide only where the start is real."""
    n, ok = F.col("__m.helices"), ~F.coalesce("partial5", F.lit(False)) & F.coalesce(F.col("__m.signal").isin("sec", "lipoprotein", "tat"), F.lit(False))
    spans = F.when(n > 0, F.concat(F.lit("predicted transmembrane protein ("), n.cast("string"), F.when(n == 1, " TM helix)").otherwise(" TM helices)")))
    peptide = F.when(ok, F.concat(F.lit("predicted "), "__m.signal", F.lit(" signal peptide "), _by(model, "__m.p")))
    return _land_prediction(features, found, {"signal": (ok, F.col("__m.signal"))}, [spans, peptide])


def land_localization(features: DataFrame, found: DataFrame, model: str = "") -> DataFrame:
    """``found`` (id, label, p): where a protein goes, if the model is sure enough."""
    ok = F.col("__m.p") >= C.LOCALIZATION_MIN
    return _land_prediction(features, found, {"localization": (ok, F.col("__m.label"))}, [F.when(ok, F.concat(F.lit("predicted subcellular localization: "), "__m.label", F.lit(" "), _by(model, "__m.p")))])


def land_gene_score(features: DataFrame, found: DataFrame, model: str = "") -> DataFrame:
    """``found`` (id, p): how likely a CDS is a gene; a low score is noted, and the CDS stays."""
    low = F.when(F.col("__m.p") < C.GENE_SCORE_NOTE, F.concat(F.lit("low gene-model score, possible spurious ORF "), _by(model, "__m.p")))
    return _land_prediction(features, found, {"gene_score": (F.lit(True), F.col("__m.p").cast("double"))}, [low])


def reclassify_ncrna(features: DataFrame, types: DataFrame) -> DataFrame:
    """``types`` (acc, rfam_type, so_type): a non-coding RNA becomes what the family of its first covariance hit is, a regulatory region with
    its class; families that aren't listed, or listed as plain RNA, change nothing."""
    so = F.trim("so_type")
    kinds = types.select(F.trim("acc").alias("__acc"), F.when(so == "rRNA", "Rrna").when(so == "tRNA", "Trna").when(so == "regulatory_region", "RegulatoryRegion").alias("__kind"), T.regulatory_class("rfam_type").alias("__class")).where("__kind is not null")
    first = F.get(F.filter("annotations", lambda a: a["source"] == "cm"), F.lit(0))["accession"]
    joined = features.withColumn("__acc", F.when(F.col("kind") == "Ncrna", T.bare_accession(first))).join(kinds, "__acc", "left")
    regulatory = F.col("__kind") == "RegulatoryRegion"
    return joined.withColumns({"kind": F.coalesce("__kind", "kind"), "regulatory_class": F.when(regulatory, F.col("__class")).otherwise(F.col("regulatory_class"))}).drop("__acc", "__kind", "__class")


def is_16s(kind: Column | str, label: Column | str, accession: Column | str) -> Column:
    """Whether a feature is a small-subunit ribosomal RNA, by its label or family."""
    low = F.lower(T.col(label))
    return (T.col(kind) == "Rrna") & (low.contains("16s") | low.contains("ssu") | T.bare_accession(accession).isin(*C.SSU_FAMILIES))


def identify_species(hits: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """(q, t, lineage, species, identity) of the best of all 16S hits, named as far as its identity supports; nothing if its target has no lineage."""
    best = H.best_overall(hits).select("q", "t", F.col("pident").alias("identity"))
    return best.join(taxonomy.withColumnRenamed("id", "t"), "t").select("q", "t", "lineage", T.assign_rank("lineage", "identity").alias("species"), "identity")


def integrase_ids(motifs: list[DataFrame], recombinases: DataFrame | None) -> DataFrame:
    """(id) of integron integrases: hits of any of the ``motifs``, which must be hits of the tyrosine recombinase too where that profile is there."""
    if not motifs:
        raise ValueError("no integrase profile")
    found = motifs[0].select("id")
    for m in motifs[1:]:
        found = found.unionByName(m.select("id"))
    return found.distinct() if recombinases is None else found.intersect(recombinases.select("id"))


def best_annotation(annotations: Column | str = "annotations") -> Column:
    """The annotation with the highest score; of equal ones the last; null if there is none."""
    ranked = F.transform(T.col(annotations), lambda a, i: F.struct(a["score"].alias("score"), i.alias("i"), a.alias("a")))
    return F.array_max(ranked)["a"]


def display_product() -> Column:
    """The product, else the name of the best annotation, else null."""
    return F.coalesce(F.col("product"), F.nullif(best_annotation()["name"], F.lit("")))


def product_for_output() -> Column:
    return F.coalesce(display_product(), F.when(F.col("kind") == "Cds", "hypothetical protein"))


def output_product() -> Column:
    """What the flat files print: tidied, and by the standard names of ribosomal and transfer RNAs."""
    p = T.sanitize_product(product_for_output())
    return F.when(F.col("kind") == "Rrna", T.normalize_rrna(p)).when(F.col("kind") == "Trna", F.when(p.isNotNull(), T.normalize_trna(p))).otherwise(p)


def is_hypothetical(product: Column) -> Column:
    return F.coalesce(F.lower(product) == "hypothetical protein", F.lit(False))


def output_gene() -> Column:
    return F.when(~is_hypothetical(output_product()), F.nullif("gene", F.lit("")))


def dbxref_values() -> Column:
    """Registered cross references: the family of a covariance hit."""
    best = best_annotation()
    ok = (best["source"] == "cm") & best["accession"].startswith("RF")
    return F.when(F.coalesce(ok, F.lit(False)), F.array(F.concat(F.lit("RFAM:"), best["accession"]))).otherwise(F.array().cast("array<string>"))


def inference_values() -> Column:
    """Evidence strings: the best profile hit, then the inferences in order."""
    best = best_annotation()
    db = T.hmm_inference_db(best["source"])
    motif = F.concat(F.lit("protein motif:HMM:"), db, F.lit(":"), best["accession"])
    ok = F.coalesce(db.isNotNull() & ~best["accession"].isin("", "-"), F.lit(False))
    own = F.transform("inferences", lambda i: T.render_inference(i["category"], i["kind"], i["same_species"], i["db"], i["accession"]))
    return F.concat(F.when(ok, F.array(motif)).otherwise(F.array().cast("array<string>")), own)


def note_values() -> Column:
    """Free notes: categories, pathways, orthology group, anticodon, family of a regulatory region, signal peptide, then the notes in order."""
    anticodon = F.get(F.filter("annotations", lambda a: a["source"] == "trna"), F.lit(0))["accession"]
    parts = [
        F.when(F.col("cog") != 0, F.concat(F.lit("COG_category:"), T.cog_letters("cog"))),
        F.when(F.size("pathway") > 0, F.concat(F.lit("KEGG_pathway:"), F.array_join("pathway", " "))),
        F.when(F.col("ko") != "", F.concat(F.lit("KEGG:"), F.col("ko"))),
        F.when((F.col("kind") == "Trna") & (anticodon != ""), F.concat(F.lit("anticodon:"), anticodon)),
        F.when((F.col("kind") == "RegulatoryRegion") & (best_annotation()["name"] != ""), F.concat(F.lit("Rfam:"), best_annotation()["name"])),
        F.when(F.col("signal").isNotNull(), F.concat(F.lit("predicted signal peptide ("), F.col("signal"), F.lit(")"))),
    ]
    return F.filter(F.concat(F.array(*parts), "notes"), lambda n: F.coalesce(n, F.lit("")) != "")


def for_output(features: DataFrame) -> DataFrame:
    """``features`` with what the flat files print: product and gene tidied, cross references, evidence and notes as values."""
    values = {"product": output_product(), "gene": output_gene(), "xrefs": dbxref_values(), "inferences": inference_values(), "notes": note_values()}
    shown = features.select(*[c for c in features.columns if c not in values], *[v.alias(k) for k, v in values.items()])
    return shown if "go" in shown.columns else shown.withColumn("go", F.array().cast("array<string>"))
