"""The whole run on a small genome: tiers that work, fail and are missing, and what the files say."""

import random

import pytest
from pyspark.sql import functions as F
from test_search import _coding, _gene, _reverse

from contigframe import constants as C
from contigframe.operators import tables
from contigframe.plans.annotate import annotate, files
from contigframe.plans.config import Config
from contigframe.plans.scalar_queries import kind_dimension


@pytest.fixture(scope="module")
def genome(spark):
    r = random.Random(12)
    noise = lambda n: "".join(r.choice("ACGT") for _ in range(n))
    refs = {k: _gene(r, 150) for k in ("whole", "shifted", "minus", "missed")}
    seq, cds = noise(600), []
    for k in refs:
        g = _coding(refs[k]) + "TAA"
        if k == "shifted":
            g = g[:240] + g[241:]
        n = 240 if k == "shifted" else len(g)
        if k == "minus":
            g = _reverse(g)
        if k != "missed":
            aa = refs[k] if k != "shifted" else refs[k][:79]
            cds.append((k, "c", len(seq) + 1, len(seq) + n, -1 if k == "minus" else 1, aa, False, False))
        seq += g + noise(800)
    seq += "N" * 30 + noise(100)
    return {
        "contigs": spark.createDataFrame([("c", seq), ("d", noise(400))], "contig string, seq string"),
        "cds": spark.createDataFrame(cds, "id string, contig string, s long, e long, strand int, aa string, partial5 boolean, partial3 boolean"),
        "refs": spark.createDataFrame(list(refs.items()), "t string, seq string"), "seq": seq, "known": refs,
    }


def given(spark, g):
    refs = g["refs"]
    return {
        "annotations": spark.createDataFrame([("minus", 1, "hmm:pfam", "PF00001.3", "a family", 50.0)] , "id string, ord int, source string, accession string, name string, score double"),
        "xref": spark.createDataFrame([("PF00001", "Known protein", "knoA")], "acc string, product string, gene string"),
        "psc": refs, "psc_names": refs.select("t", F.concat(F.lit("Protein "), "t").alias("product")),
        "vfdb": refs.where("t = 'whole'"), "vfdb_entries": spark.createDataFrame([("whole", "VFG1", "toxin")], "t string, accession string, description string"),
        "families": refs, "markers": spark.createDataFrame([(m,) for m in C.MARKERS], "marker string"),
        "relaxases": spark.createDataFrame([("c", 1, 9)], "contig string, s long, e long"),
        # a table whose rows can't be computed: the tier fails in its tasks
        "kofam_hits": spark.createDataFrame([("whole", "K1", 9.0, 9.0, 1)], "fid string, ko string, seq_score double, dom_score double, ord int").withColumn("seq_score", F.raise_error(F.lit("no such file: profiles")).cast("double")),
        "ko_list": spark.createDataFrame([("K1", 1.0, "full")], "ko string, threshold double, score_type string"),
        "ko_table": spark.createDataFrame([("K1", ["1.1.1.1"], ["map1"], 1)], "ko string, ec array<string>, pathway array<string>, cog int"),
    }


@pytest.fixture(scope="module")
def run(spark, genome):
    rrna = spark.createDataFrame([("rna", "d", 10, 300, 1, "Rrna", 90.0, "SSU_rRNA_bacteria", "RF00177")], "id string, contig string, s long, e long, strand int, kind string, score double, name string, accession string")
    config = Config(gaps=True, pseudo=True, signal_peptide=True)
    got = annotate(config, genome["contigs"], {"cds": genome["cds"], "ncrna": rrna}, given(spark, genome), kind_dimension(spark))
    return got, {r["id"]: r for r in got.features.collect()}


def test_tiers_that_work(run, genome):
    got, rows = run
    assert rows["whole"]["product"] == "Protein whole" and rows["whole"]["notes"] == ["virulence factor: toxin"] and not rows["whole"]["pseudogene"]
    assert (rows["minus"]["product"], rows["minus"]["gene"]) == ("Known protein", "knoA")
    assert rows["shifted"]["pseudogene"] and rows["shifted"]["notes"] == ["aligned frameshift vs consensus family shifted"]
    missed = [r for r in rows.values() if r["id"].startswith("igpseudo_c") and "missed" in r["notes"][0]]
    first = genome["seq"].index(_coding(genome["known"]["missed"])) + 1
    assert len(missed) == 1 and missed[0]["s"] == first and missed[0]["pseudogene"]
    gap = rows["c_gap1"]
    assert (gap["kind"], gap["e"] - gap["s"] + 1) == ("AssemblyGap", 30)
    tags = [r["locus_tag"] for r in sorted(rows.values(), key=lambda r: (r["contig"], r["s"]))]
    assert tags == [f"CF_{k + 1:05}" for k in range(len(rows))]
    assert got.qc.first()["expected"] == len(C.MARKERS) and got.plasmids is None and got.species is None


def test_tiers_that_fail_or_are_missing(run):
    got, rows = run
    assert set(got.skipped) == {"kofam", "orit"} and got.skipped["orit"] == "missing database" and got.skipped["kofam"] == "missing database"
    assert all(r["ko"] is None for r in rows.values()) and not any(r["kind"] == "OriT" for r in rows.values())


def test_files(spark, run, genome):
    got, _ = run
    lines = files(got, genome["contigs"], kind_dimension(spark))
    flat = [r["line"] for r in lines["gbff"].orderBy("contig", "section", "ord", "id", "part").collect()]
    text = "\n".join(flat)
    joined = text.replace("\n" + " " * 21, "")
    assert f'/translation="{genome["known"]["whole"]}"' in joined and f'/translation="{genome["known"]["minus"]}"' in joined
    assert "/inference=\"protein motif:HMM:Pfam:PF00001.3\"" in joined and "/inference=\"similar to AA sequence:VFDB:VFG1\"" in joined and '/note="virulence factor: toxin"' in joined
    assert '/product="16S ribosomal RNA"' in joined and '/db_xref="RFAM:RF00177"' in joined and '/organism="Bacteria"' in joined
    assert "/estimated_length=30" in text and "/codon_start=1\n" in text and "/transl_table=11" in text and "complement(" in text
    at = flat.index(next(x for x in flat if x.startswith("     CDS") and str(got.features.where("id = 'shifted'").first()["s"]) + ".." in x))
    own = "\n".join(flat[at : at + 8]).split("     gene")[0]
    assert "/pseudo" in own and "/translation" not in own
    assert all(len(x.encode()) <= 80 for x in flat)
    table = [r["line"].split("\t") for r in lines["tsv"].collect()]
    assert ["minus", "a family (PF00001.3)", "50.0"] in [[x[1], x[6], x[7]] for x in table]
    gff = [r["line"] for r in lines["gff3"].collect()]
    assert any("product=Known protein;gene=knoA" in x for x in gff)


def test_every_option_is_read():
    import inspect

    from contigframe.plans import annotate as module

    source = inspect.getsource(module)
    own = {"genome", "paths", "genetic_code", "tmrna", "crispr"}  # inputs and the callers' own switches
    assert all(f"config.{name}" in source for name in Config.__dataclass_fields__ if name not in own)


def test_a_run_holds_its_features_once(spark, tmp_path, monkeypatch):
    """Tiers that add write only what they add, and what nothing reads any more goes; seven tables of features were left before."""
    monkeypatch.setattr(tables, "shared_dir", lambda _: f"file://{tmp_path}")
    rows = spark.range(400).select(F.lit("c").alias("contig"), F.concat(F.lit("f"), "id").alias("id"), (F.col("id") * 50).alias("s"), (F.col("id") * 50 + 60).alias("e"), F.lit(1).alias("strand"), F.lit(1.0).alias("score"), (F.col("id") % 5).alias("k"))
    kinds = ["Cds", "Trna", "Tmrna", "IsElement", "Ncrna"]
    calls = {n: rows.where(F.col("k") == k).withColumn("kind", F.lit(kinds[k])).drop("k") for k, n in enumerate(["cds", "trna", "tmrna", "is", "ncrna"])}
    contigs = spark.createDataFrame([("c", "ACGT" * 5_000 + "N" * 30 + "ACGT" * 10)], "contig string, seq string")
    held = []
    monkeypatch.setattr(tables, "placed", lambda df, what, f=tables.placed: (f(df, what), held.append(sum(spark.read.parquet(str(x)).count() for x in tmp_path.glob("features-*"))))[0])
    got = annotate(Config(gaps=True), contigs, calls, {"markers": spark.createDataFrame([(m,) for m in C.MARKERS], "marker string")}, kind_dimension(spark))
    assert not got.skipped and got.features.count() > 80 and got.qc.count() == 1
    assert max(held) == 401 and not list(tmp_path.glob("features-*")) and len(list(tmp_path.glob("resolved-*"))) == 1
