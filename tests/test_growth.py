"""Operators on larger tables: what is moved, what is held at once, and places where only exact arithmetic agrees with SQL."""

import random
import re

import numpy as np
from pyspark.sql import functions as F

from contigframe.operators import alignment as A
from contigframe.operators import hits as H
from contigframe.operators import intervals as I
from contigframe.operators import scans, search


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_deletions_without_rows_of_columns_or_broadcast(spark):
    hits = spark.createDataFrame([(1, 5, "AC--E-G", "ACDEE-G"), (2, 1, "--", "AC")], "hit long, tstart int, qaln string, taln string")
    sites = spark.createDataFrame([(1, 7, 2), (1, 7, 1), (1, 8, 2), (1, 6, 1), (2, 1, 2), (2, 1, 3), (2, 1, 2), (3, 1, 1)], "hit long, pos long, span int")
    found = scans.deletion_calls(hits, sites)
    assert "Broadcast" not in plan(found) and "Window" not in plan(found)
    want = [(1, 6, 1, False), (1, 7, 1, True), (1, 7, 2, True), (1, 8, 2, False), (2, 1, 2, True), (2, 1, 2, True), (2, 1, 3, False), (3, 1, 1, False)]
    assert sorted(map(tuple, found.collect())) == want


def test_scores_without_the_way_back(spark):
    r = np.random.default_rng(3)
    for scoring, n in ((A.DNA, 5), (A.PROTEIN, 21)):
        targets = [r.integers(0, n, r.integers(0, 90)).astype(np.uint8) for _ in range(300)]
        queries = [np.concatenate([r.integers(0, n, 30), t[: len(t) // 2], r.integers(0, n, k % 4), t[len(t) // 2 :]]).astype(np.uint8) for k, t in enumerate(targets)]
        centre = r.integers(-40, 80, 300)
        got, want = A.best_scores(queries, targets, centre, scoring), A.align(queries, targets, centre, scoring)["score"]
        assert got.tolist() == want.tolist() and (want > 60).any()


def test_a_search_moves_windows_and_shared_seeds_only(spark, monkeypatch):
    r = random.Random(8)
    letters = lambda n: "".join(r.choice("ACGT") for _ in range(n))
    gene = letters(150)
    contigs = spark.createDataFrame([(f"c{k}", letters(9_000) + (gene if k == 1 else "") + letters(9_000)) for k in range(3)], "contig string, seq string")
    seen = {}
    whole = search.tables.written
    monkeypatch.setattr(search.tables, "written", lambda df, what: seen.setdefault(what, whole(df, what)))
    found = search.SeedSearch(search.NUCLEOTIDE).search(search.contig_queries(contigs), spark.createDataFrame([("g", gene)], "t string, seq string")).collect()
    assert [(x["query"], x["qstart"], x["qend"], x["tstart"], x["tend"]) for x in found if x["pident"] == 100.0] == [("c1", 9_001, 9_150, 1, 150)]
    assert seen["seeds"].count() < 2_000 and seen["pairs"].agg(F.max(F.length("text"))).first()[0] <= 150 + A.WIDTH


def test_seeds_of_many_letters_come_in_parts(spark, monkeypatch):
    r = random.Random(9)
    rows = spark.createDataFrame([(k, "".join(r.choice("ACGTN") for _ in range(n))) for k, n in enumerate([0, 500, 3, 1, 700, 40, 0])], "unit long, letters string").coalesce(1)
    whole = sorted(search.seeds(rows, ["unit"], "letters", search.NUCLEOTIDE, 5).collect())
    monkeypatch.setattr(search, "LETTERS", 50)
    assert sorted(search.seeds(rows, ["unit"], "letters", search.NUCLEOTIDE, 5).collect()) == whole != []


def test_go_terms_are_numbers_until_the_end(spark):
    names = [f"GO:{k * 37 % 200:03}" for k in range(150)]
    go = [("PF1", g) for g in names[:100]] * 3 + [("PF2", g) for g in names[90:]] + [("PF2", None), (None, "GO:x"), ("PF9", "GO:z")]
    found = H.pfam_go_merge(spark.createDataFrame([(1, "PF1.3"), (1, "PF2"), (1, "PF2.1"), (2, "PF2.7"), (3, "PF5"), (4, "TIGR1")], "fid long, accession string"), spark.createDataFrame(go, "acc string, go string"))
    assert "collect_set" not in plan(found)
    assert {r.fid: r.go for r in found.collect()} == {1: sorted(names), 2: sorted(names[90:])}


def test_a_length_at_the_ratio_is_not_below_it(spark):
    rows = spark.createDataFrame([(n, int(0.55 * n + 0.5) - d, [1, n], False, False) for n in (100, 140, 180) for d in (0, 1)], "fid long, aa_len long, ref_lens array<long>, partial boolean, pseudo boolean")
    assert sorted(r.fid for r in H.reflen_truncation(rows).collect()) == [100, 140, 180]


def test_sparse_groups_are_not_cut_into_a_block_for_each_row(spark):
    rows = spark.range(600).select(F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.concat(F.lit("c"), (F.col("id") % 3).cast("string"))).alias("contig"), (F.col("id") * 1_000_000).alias("s"), (F.col("id") * 1_000_000 + 5).alias("e"), F.lit(1).alias("cls"))
    assert {(r["__block"]) for r in I._blocked(rows, ["contig"], "s", 200).collect()} == {0}
    assert {(r["__block"]) for r in I._blocked(rows, ["contig"], "s", 50).collect()} == {1, 2, 3, 4}
    assert I.sessions(rows, 300).select("contig", "run").distinct().count() == 600


def test_regions_of_a_contig_in_blocks_are_those_of_one_window(spark, monkeypatch):
    r = random.Random(5)
    spots = [(s, s + r.randrange(400), r.randrange(1, 8)) for s in sorted(r.sample(range(60_000), 250))]
    genes = spark.createDataFrame([("long", *x) for x in spots] + [("short", *x) for x in spots[:20]], "contig string, s long, e long, cls int")
    whole = sorted(map(tuple, I.prophage_regions(genes, core=(1, 2, 3), gap=300).collect()))
    monkeypatch.setattr(I, "BLOCK", 30)
    blocks = {(x["contig"], x["__block"]) for x in I._blocked(genes, ["contig"], "s", 30).select("contig", "__block").collect()}
    assert ("short", 0) in blocks and len(blocks) == 10
    assert sorted(map(tuple, I.prophage_regions(genes, core=(1, 2, 3), gap=300).collect())) == whole != []


def test_genes_of_regions_are_moved_once(spark, monkeypatch):
    """Repeats go, and runs are summed up, where genes lie already; the plan had five exchanges of rows by other keys before."""
    r = random.Random(6)
    genes = [("long", s, s + r.randrange(400), r.randrange(1, 8)) for s in r.sample(range(60_000), 250)] + [("short", k * 100, k * 100 + 90, k % 8) for k in range(20)]
    once, twice = (spark.createDataFrame(rows, "contig string, s long, e long, cls int") for rows in (genes, genes + genes[::3]))
    want = sorted(map(tuple, I.prophage_regions(once, core=(1, 2, 3), gap=300).collect()))
    got = lambda: I.prophage_regions(twice, core=(1, 2, 3), gap=300, repeated=True)
    assert sorted(map(tuple, got().collect())) == want != []
    keys = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan(got()))
    assert not [k for k in keys if k.startswith(("contig", "s#")) and re.search(r"\b(cls|e)#", k)]  # repeats by all columns
    monkeypatch.setattr(I, "BLOCK", 30)
    assert sorted(map(tuple, got().collect())) == want
