"""Command line: ``python -m contigframe annotate GENOME --out FOLDER [--db BUNDLE] [--fast | --full] ...`` and ``python -m contigframe build-psc ...``.

With ``spark-submit`` the session is that of the cluster. A bundle's tables are those of ``Config.with_bundle``; what it lacks is skipped.
"""

from __future__ import annotations

import argparse
import os
import sys
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contigframe import constants as C
from contigframe.operators import genes, landing
from contigframe.operators import hits as H
from contigframe.plans.annotate import Run, annotate, files
from contigframe.plans.builders import build_psc
from contigframe.plans.config import Config, find_sidecar, validate
from contigframe.plans.scalar_queries import kind_dimension
from contigframe.sources import parsers as P
from contigframe.sources import sequence_files
from contigframe.sources.sinks import write_ordered

ORDER = {"tsv": ("contig", "s", "id"), "gff3": ("section", "contig", "ord", "part"), "gbff": ("contig", "section", "ord", "id", "part")}
SWITCHES = ("tmrna", "crispr", "oric", "gaps", "tandem", "sorf", "pseudo", "start_refine", "signal_peptide", "localization", "gene_score")


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="contigframe")
    commands = top.add_subparsers(dest="command", required=True)
    run = commands.add_parser("annotate", help="annotate a genome")
    run.add_argument("genome")
    run.add_argument("--out", required=True)
    run.add_argument("--db", help="a reference bundle; explicit paths win")
    run.add_argument("--fast", action="store_const", const="fast", dest="profile")
    run.add_argument("--full", "--all", action="store_const", const="full", dest="profile")
    run.add_argument("-g", "--translation-table", type=int, choices=sorted(genes.STOPS))
    run.add_argument("--locus-prefix", default="CF")
    for tier in ("psc", "vfdb", "plasmid", "species", "orit"):
        run.add_argument(f"--{tier}", metavar="FOLDER")
    run.add_argument("--families", metavar="FASTA", help="consensus proteins that broken genes are held against")
    for switch in SWITCHES:
        run.add_argument("--" + switch.replace("_", "-"), action="store_true")
    build = commands.add_parser("build-psc", help="names, proteins and taxa of a cluster FASTA")
    for name in ("clusters", "nodes", "merged", "out"):
        build.add_argument(f"--{name}", required=True)
    build.add_argument("--index", help="store a search index under this table name")
    return top


def configured(args: argparse.Namespace) -> Config:
    config = Config(genome=args.genome, genetic_code=args.translation_table, locus_prefix=args.locus_prefix)
    config = config.profile(args.profile) if args.profile else config
    config = replace(config, **{s: True for s in SWITCHES if getattr(args, s)})
    config = replace(config, paths={t: p for t in ("psc", "vfdb", "plasmid", "species", "orit", "families") if (p := getattr(args, t))})
    return config.with_bundle(args.db) if args.db else config


def references(spark: SparkSession, config: Config) -> dict[str, DataFrame]:
    """What the configured folders hold, as the run takes it."""
    out: dict[str, DataFrame] = {"markers": spark.createDataFrame([(m,) for m in C.MARKERS], "marker string")}
    fasta = lambda path: sequence_files.whole(sequence_files.read_sequences(spark, path))
    paths = config.paths
    if "psc" in paths:
        names, proteins = f"{paths['psc']}/names", f"{paths['psc']}/proteins"
        if os.path.isdir(names):
            out |= {"psc": spark.read.parquet(proteins), "psc_names": spark.read.parquet(names)}
        elif table := find_sidecar(paths["psc"], "names.tsv"):
            out |= {"psc": fasta(f"{paths['psc']}/*.f*a*").select(F.col("contig").alias("t"), "seq"), "psc_names": P.names_table(P.read_lines(spark, table)).withColumnRenamed("id", "t")}
    if "vfdb" in paths:
        rows = fasta(paths["vfdb"])
        entries = P.vfdb_headers(rows.select("header"))
        out |= {"vfdb": rows.select(F.regexp_extract("header", r"^(VFG\d+)", 1).alias("t"), "seq").where("t <> ''"), "vfdb_entries": entries.select(F.col("id").alias("t"), F.col("id").alias("accession"), "description")}
    if "plasmid" in paths:
        out["plasmids"] = sequence_files.read_replicons(spark, paths["plasmid"])
    if "species" in paths:
        rows = fasta(paths["species"])
        out |= {"ssu": rows.select(F.col("contig").alias("t"), "seq"), "lineages": P.gtdb_headers(rows.select("header"))}
    if "orit" in paths:
        out |= {"orit": fasta(paths["orit"]).select(F.col("contig").alias("t"), "seq"), "relaxases": spark.createDataFrame([], "contig string, s long, e long")}
    if "families" in paths:
        out["families"] = fasta(paths["families"]).select(F.col("contig").alias("t"), "seq")
    return out


def summary(run: Run) -> list[str]:
    """The lines that a run ends with: counts, quality, evidence, replicons, species, and what was skipped. Each comes from an aggregate of a few rows."""
    best = landing.best_annotation()
    counts = run.features.agg(
        F.count("*").alias("n"), F.count_if(F.col("kind") == "Cds").alias("cds"), F.count_if(best.isNotNull()).alias("annotated"), F.count_if("pseudogene").alias("pseudo"),
        F.count_if(F.exists("inferences", lambda i: i["db"] == "VFDB")).alias("vf"),
    ).first()
    qc = run.qc.first()
    lines = [f"{counts['n']} features ({counts['cds']} CDS, {counts['annotated']} annotated, {counts['pseudo']} pseudogenes)", f"quality: completeness {qc['completeness']:.1f} %, contamination {qc['contamination']:.1f} % ({qc['present']} of {qc['expected']} markers)"]
    lines += [f"  {what} markers: {qc[what]}" for what in ("missing", "duplicated", "disrupted") if qc[what]]
    if counts["vf"]:
        lines.append(f"virulence factors: {counts['vf']} CDS with evidence")
    if run.plasmids is not None:
        found = run.plasmids.orderBy("q", "type").limit(1000).collect()  # one a contig and type; a report's length
        lines.append(f"plasmid replicons: {run.plasmids.count()}")
        lines += [f"  {r['q']}: {r['type']} ({r['pident']:.1f} %, {r['qs']}..{r['qe']})" for r in found]
    if run.species is not None and (hit := run.species.first()):
        lines.append(f"species: {hit['species']} ({hit['identity']:.1f} % to {hit['t']})")
    if run.skipped:
        lines.append("skipped: " + ", ".join(f"{k} ({v})" for k, v in sorted(run.skipped.items())))
    return lines


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName("contigframe").getOrCreate()
    if args.command == "build-psc":
        done = build_psc(spark, args.clusters, args.nodes, args.merged, args.out, index=args.index)
        print(f"{done['kept']} of {done['seen']} records kept")
        return 0
    config = configured(args)
    validate(config)
    rows = sequence_files.read_sequences(spark, config.genome)
    for r in sequence_files.duplicates(rows).orderBy("contig").limit(20).collect():  # a warning's length
        print(f"warning: {r['n']} sequences are called {r['contig']}", file=sys.stderr)
    contigs = sequence_files.whole(rows).select("contig", "seq")
    calls, code = genes.predict(contigs, config.genetic_code)
    place = F.concat_ws("_", "contig", F.col("s").cast("string"), F.col("e").cast("string"))
    cds = genes.proteins(calls, contigs, code).withColumn("id", place)
    kinds = kind_dimension(spark)
    run = annotate(config, contigs, {"cds": cds}, references(spark, config), kinds)
    for name, lines in files(run, contigs, kinds).items():
        write_ordered(lines, f"{args.out}/{name}", *ORDER[name])
    print("\n".join(summary(run)))
    return 0


if __name__ == "__main__":
    sys.exit(main())
