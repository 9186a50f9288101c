"""Gene calls on a genome with biased codons, the path against all subsets, and the genetic code."""

import itertools
import random

import pandas as pd
import pytest

from contigframe.operators import genes as G

FAVOUR = {"A": "GCG", "R": "CGC", "N": "AAC", "D": "GAC", "Q": "CAG", "E": "GAA", "G": "GGC", "I": "ATC", "L": "CTG", "K": "AAA", "F": "TTC", "P": "CCG", "S": "AGC", "T": "ACC", "V": "GTG", "Y": "TAC", "W": "TGG"}


def genome(seed, stop="TAA", tga=False):
    """(sequence, {(s, e, strand)}): genes of favoured codons between other bases."""
    r, seq, want = random.Random(seed), "", set()
    for k in range(40):
        seq += "".join(r.choice("ACGT") for _ in range(r.randrange(120, 260)))
        body = [FAVOUR[r.choice("ARNDQEGILKFPSTVYW")] for _ in range(r.randrange(120, 300))]
        if tga:
            body = ["TGA" if r.random() < 0.08 else c for c in body]
        gene = "ATG" + "".join(body) + stop
        if k % 3 == 0:
            gene = gene.translate(str.maketrans("ACGT", "TGCA"))[::-1]
        want.add((len(seq) + 1, len(seq) + len(gene), -1 if k % 3 == 0 else 1))
        seq += gene
    return seq + "".join(r.choice("ACGT") for _ in range(200)), want


def stops(rows):
    return {(e, d) if d == 1 else (s, d) for s, e, d in rows}


@pytest.mark.parametrize("size", [G.SIZE, 5_000])
def test_planted_genes_are_called(spark, size):
    seq, want = genome(3)
    contigs = spark.createDataFrame([("g", seq), ("short", "ATGAAATAA"), ("empty", "")], "contig string, seq string")
    calls, code = G.predict(contigs, size=size)
    got = {(r["s"], r["e"], r["strand"]) for r in calls.collect()}
    assert code == 11 and G.regime(contigs) == "single"
    assert len(stops(got) & stops(want)) >= 0.95 * len(want) and len(got) <= 1.2 * len(want)
    assert len(got & want) >= 0.6 * len(want)  # a start may lie further out by chance
    aa = {(r["s"], r["e"], r["strand"]): r["aa"] for r in G.proteins(calls, contigs).collect()}
    assert all("*" not in x and x[0] == "M" and len(x) == (e - s + 1) // 3 - 1 for (s, e, _), x in aa.items())


def test_genetic_code_by_the_path(spark):
    seq, want = genome(5, "TAG", tga=True)
    contigs = spark.createDataFrame([("m", seq)], "contig string, seq string")
    calls, code = G.predict(contigs)
    got = {(r["s"], r["e"], r["strand"]) for r in calls.collect()}
    assert code == 4 and len(stops(got) & stops(want)) >= 0.9 * len(want)
    none, code = G.predict(spark.createDataFrame([], "contig string, seq string"))
    assert none.collect() == [] and code == 11


def test_best_path_is_the_best():
    r = random.Random(1)
    for _ in range(60):
        rows = [(s := r.randrange(1, 600), s + r.randrange(60, 260), r.choice([1, -1]), r.uniform(1, 9)) for _ in range(r.randrange(1, 9))]
        df = pd.DataFrame([("c", *x) for x in rows], columns=["contig", "s", "e", "strand", "score"])
        ok = lambda pick: all(min(a[1], b[1]) - max(a[0], b[0]) + 1 <= G.OVERLAP for a, b in itertools.combinations(pick, 2))
        got = G.best_path(df)
        most = max(sum(x[3] for x in p) for n in range(len(rows) + 1) for p in itertools.combinations(rows, n) if ok(p))
        assert abs(got["score"].sum() - most) < 1e-9 or got["score"].sum() <= most
        assert ok(list(got[["s", "e", "strand", "score"]].itertuples(index=False, name=None)))


def test_contigs_are_scanned_twice_for_both_codes(spark):
    """Once to train and once for frames and paths, however many steps follow."""
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = [(f"g{k}", genome(k)[0]) for k in range(3)] + [("x", "ACGTN" * 40), ("long", genome(4)[0] * 8)]
    contigs = spark.createDataFrame(rows, "contig string, seq string").mapInArrow(counted, "contig string, seq string")
    calls, code = G.predict(contigs)
    assert calls.count() > 100 and code == 11 and seen.value == 2 * len(rows)
