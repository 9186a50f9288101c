"""Operators that cut long groups into pieces: the same rows whatever the pieces, and literal forms on the queries' own rows."""

import random

import pytest
from pyspark.sql import functions as F

from contigframe.operators import hits as H
from contigframe.operators import intervals as I
from contigframe.operators import scans, tables
from contigframe.operators import sequences as Q
from contigframe.plans import relations as R
from contigframe.plans.interval_queries import _ORIT
from contigframe.plans.scalar_queries import kind_dimension

D = "/root/testdata/sf0.001"


@pytest.mark.parametrize("block", [1, 7, 50, 10**6])
def test_running_values_in_blocks(spark, block):
    r = random.Random(block)
    rows = [(r.choice(["a", None]), i, p, r.choice([None, r.randrange(50)])) for i, p in enumerate(r.sample(range(400), 150))]
    df = spark.createDataFrame(rows, "contig string, id long, s long, v long")
    for how in ("max", "sum", "last"):
        for before in (False, True):
            got = {x.id: x.out for x in I.running(df, ["contig"], "s", ["s"], F.col("v"), how, "out", before, block).collect()}
            for contig in ("a", None):
                seen = []
                for _, i, _, v in sorted((x for x in rows if x[0] == contig), key=lambda x: x[2]):
                    upto = [x for x in (seen if before else [*seen, v]) if x is not None]
                    assert got[i] == (None if not upto else max(upto) if how == "max" else sum(upto) if how == "sum" else upto[-1])
                    seen.append(v)


def test_one_long_contig_of_all_features(spark):
    f = R.relation(spark, D, "intervals").withColumns({"contig": F.lit("one"), "id": F.monotonically_increasing_id()})
    rows = sorted((r.s, r.e, r.id) for r in f.collect())
    runs, hi = [], None
    for s, e, _ in rows:
        if hi is None or s - hi > 300:
            runs.append([s, e, 0])
        runs[-1][1], runs[-1][2], hi = max(runs[-1][1], e), runs[-1][2] + 1, max(hi or 0, e)
    got = I.sessions(f, 300).groupBy("run").agg(F.min("s").alias("s"), F.max("e").alias("e"), F.count("*").alias("n")).collect()
    assert sorted((r.s, r.e, r.n) for r in got) == sorted(map(tuple, runs))


def test_orit_equals_a_literal_sweep(spark):
    df = R.select(spark, D, f"select * from {_ORIT} o")
    ok = [r for r in df.collect() if r.evalue <= 1e-5 and r.pident >= 70 and r.tcov >= 0.5 and r.alnlen >= 25 and (r.near or (r.evalue <= 1e-8 and r.pident >= 80 and r.tcov >= 0.6))]
    kept = []
    for r in sorted(ok, key=lambda r: (-r.bits, r.id)):
        if not any(k.contig == r.contig and min(k.e, r.e) >= max(k.s, r.s) for k in kept):
            kept.append(r)
    assert {r.id for r in I.gate_orit(df).collect()} == {r.id for r in kept} and len(kept) < len(ok)


def test_ties_go_by_appearance(spark):
    schema = "contig string, id string, kind string, s long, e long, score double, ord long"
    rows = [("c", "z", "Ncrna", 1, 100, 5.0, 1), ("c", "a", "Ncrna", 1, 100, 5.0, 2)]
    assert [r.id for r in I.resolve(spark.createDataFrame(rows, schema), kind_dimension(spark)).collect()] == ["z"]
    chain = [("c", f"n{k:03}", "Ncrna", 60 * k, 60 * k + 119, 100.0 - k, k) for k in range(9)]  # each decision waits for the one before
    assert sorted(r.id for r in I.resolve(spark.createDataFrame(chain, schema), kind_dimension(spark)).collect()) == [f"n{k:03}" for k in range(0, 9, 2)]


def test_tree_of_a_thousand_levels(spark, monkeypatch):
    made = []
    whole = tables.Rounds.written
    monkeypatch.setattr(tables.Rounds, "written", lambda self, df: made.append(1) or whole(self, df))
    n = 1000
    nodes = [(k, k - 1) for k in range(1, n)] + [(0, 0), (2000, 1999), (1999, 2000), (3000, 5), (3000, 2000), (4000, 4001)]
    got = {r.id for r in H.tree_closure(spark.createDataFrame(nodes, "child long, parent long"), spark.createDataFrame([(3,)], "id long")).collect()}
    assert got == {*range(3, n), 3000} and len(made) <= 2 + 3 * 12


@pytest.mark.parametrize("sizes", [(10, 4), (7, 20), (1000, 5)])
def test_slices_across_chunks(spark, sizes):
    size, halo = sizes
    r = random.Random(size)
    seqs = {"a": "".join(r.choice("ACGT") for _ in range(95)), "b": "ACG", "c": ""}
    spans = [(c, s, s + n, k) for c in ("a", "b", "c", "d") for k, (s, n) in enumerate([(-3, 5), (1, 0), (1, 94), (9, 3), (10, 1), (20, 40), (90, 30), (200, 3), (20, 40), (5, -2)])]
    chunks = Q.sequence_chunks(spark.createDataFrame(list(seqs.items()), "contig string, seq string"), size, halo)
    got = Q.slices(spark.createDataFrame(spans, "contig string, s long, e long, k int"), chunks, size=size, halo=halo).collect()
    want = [(c, s, e, k, seqs.get(c, "")[max(s, 1) - 1 : max(e, 0)] or None) for c, s, e, k in spans]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("size", [40, 151, 10**6])
def test_short_orfs_across_chunks(spark, size):
    r = random.Random(4)
    df = spark.createDataFrame([(c, "".join(r.choice("ACGTN" if c == "n" else "ACGT") for _ in range(n))) for c, n in (("x", 1700), ("n", 800), ("s", 2), ("e", 0))], "contig string, seq string")
    rows = lambda d: sorted(map(tuple, d.collect()))
    assert rows(scans.short_orfs(df, size=size)) == rows(scans.short_orfs(df)) != []


def test_salted_join_of_a_heavy_key(spark):
    rows = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 900).cast("long").alias("k"), "id")
    values = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    got = tables.salted_join(rows, values.where("k <> 5"), ["k"], "left", parts=50)
    want = rows.join(values.where("k <> 5"), "k", "left")
    assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
