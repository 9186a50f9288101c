"""The chosen-path join, components and the pipeline against brute force."""

import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from contigframe.llm import jaccard_join as J
from contigframe.llm import util
from contigframe.llm.components import components

SCHEMA = "doc_id long, text string, class_id string, digest int"


def brute(rows, similarity=0.8):
    """{id: (class_id, text_class, class_size, n_links)} by comparing all sets with each other."""
    sets = dict(zip([r[0] for r in rows], (frozenset(s.tolist()) for s in J.Shingler().sets(pa.array([r[1] or "" for r in rows])))))
    classes = {}
    for r in rows:
        classes.setdefault(sets[r[0]], []).append(r[0])
    reps = {s: min(ids) for s, ids in classes.items()}
    links = {s: [t for t in reps if t is not s and s and len(s & t) >= similarity * len(s | t)] for s in reps}
    root = {s: s for s in reps}

    def find(s):
        while root[s] is not s:
            s = root[s]
        return s

    for s, ts in links.items():
        for t in ts:
            a, b = find(s), find(t)
            if a is not b:
                root[b] = a
    least = {}
    for s in reps:
        least[find(s)] = min(least.get(find(s), reps[s]), reps[s])
    return {r[0]: (least[find(sets[r[0]])], reps[sets[r[0]]], len(classes[sets[r[0]]]), len(links[sets[r[0]]])) for r in rows}


def near_rows(n_groups=12, size=9, seed=5):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    rows, shared = [], " ".join(word() for _ in range(40))
    for _ in range(n_groups):
        base = [word() for _ in range(rng.randint(30, 120))]
        for _ in range(rng.randint(1, size)):
            w = list(base)
            for _ in range(rng.randint(0, 2)):
                w[rng.randrange(len(w))] = word()
            rows.append((len(rows), " ".join(w), "x", 1))
    rows += [(len(rows) + k, shared + " " + " ".join(word() for _ in range(150)), "x", 1) for k in range(40)]
    return rows


def result(df):
    return {r.doc_id: (r.class_id, r.text_class, r.class_size, r.n_links) for r in df.collect()}


def test_join_equals_brute_force(spark):
    rows = near_rows()
    assert result(J.near_duplicates(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_split_nodes_and_tiles_equal_brute_force(spark, monkeypatch):
    for name, value in (("BUCKET", 3), ("TILE_SETS", 4), ("TILE_BRIEF", 6), ("DENSE", 0.9)):
        monkeypatch.setattr(J, name, value)
    monkeypatch.setattr(J.in_tiles, "__defaults__", (4,))
    rows = near_rows(5, 25, 9)
    assert result(J.near_duplicates(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_join_of_odd_rows(spark):
    rows = [(1, None, None, None), (2, "", "x", 1), (3, "One two", "x", 1), (4, "one TWO.", "x", 1), (5, "...", "x", 1), (6, "w " * 30000, "x", 1), (7, "a b c d e f g h i j k l m n o p q r s t u v w x y", "x", 1), (8, "a b c d e f g h i j k l m n o p q r s t u v w x z", "x", 1)]
    df = spark.createDataFrame([*rows, rows[3], (None, "one two", "x", 1)], SCHEMA)
    got = J.near_duplicates(df).collect()
    assert len(got) == 10
    by = {r.doc_id: r for r in got}
    assert by[3].class_size == by[4].class_size == by[None].class_size == 4 and by[1].n_links == by[2].n_links == by[5].n_links == 0
    assert by[8].class_id == by[7].class_id == 7 and by[7].n_links == by[8].n_links == 1 and by[None].class_id == 3
    kept = J.one_of_each(df)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 5, 6, 7]
    assert [r.doc_id for r in J.one_of_each(df.where("doc_id = 4")).collect()] == [4]  # one of two equal rows
    assert J.near_duplicates(df.limit(0)).collect() == []


@pytest.mark.parametrize("other", [None, 1])
def test_texts_under_one_id_keep_their_links(spark, other):
    a, b = " ".join(f"a{i}" for i in range(60)), " ".join(f"b{i}" for i in range(60))
    df = spark.createDataFrame([(other, a, "x", 1), (other, b, "x", 1), (5, a + " end", "x", 1), (6, b + " end", "x", 1)], SCHEMA)
    got = sorted(((r.doc_id, r.class_id, r.n_links, r.class_key) for r in J.near_duplicates(df).collect()), key=str)
    assert [g[2] for g in got] == [1] * 4 and len({g[3] for g in got}) == 2
    assert {g[1] for g in got} == ({5, 6} if other is None else {1})
    kept = {(r.doc_id, r.text[0]) for r in J.one_of_each(df).collect()}
    assert kept == ({(5, "a"), (6, "b")} if other is None else {(1, "a"), (1, "b")})


def test_join_of_the_test_table(spark):
    docs = util.documents(spark, "/root/testdata/sf0.01").select("doc_id", "text")
    assert result(J.near_duplicates(docs)) == brute([tuple(r) for r in docs.collect()])


@settings(max_examples=40, deadline=None)
@given(st.lists(st.sets(st.integers(0, 30), max_size=12), min_size=1, max_size=12), st.sampled_from([0.5, 0.8]))
def test_exact_comparison(sets, t):
    got = J.similar([np.array(sorted(s), np.uint64) for s in sets], t)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            assert got[i, j] == (i != j and bool(a & b) and len(a & b) >= t * len(a | b) - 1e-9)


def test_runs_reach_the_target():
    assert J.runs_for(0.5) <= J.runs_for(0.99) <= J.runs_for(0.9999) < 20


@settings(max_examples=4, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 25), st.integers(0, 25)), max_size=30))
def test_components(spark, edges):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    with util.Scratch(spark) as tmp:
        got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long"), tmp).collect()}
    assert got == {n: find(n) for e in edges if e[0] != e[1] for n in e}


def test_long_chain_is_one_component(spark):
    with util.Scratch(spark) as tmp:
        got = components(spark.createDataFrame([(i, i + 1) for i in range(120)] + [(0, 1000 + i) for i in range(900)], "a long, b long"), tmp)
        assert {r.root for r in got.collect()} == {0} and got.count() == 1021


def test_pipeline_stages(spark):
    d = "/root/testdata/sf0.01"
    docs = util.documents(spark, d)
    ids = [r.doc_id for r in docs.select("doc_id").collect()]
    steps = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = util.written(stage(spark, docs, d), "t")
        steps[name] = docs
    assert [n for n, _ in corpus_pipeline.STAGES][0] == "language ID" and all(df.columns == ["doc_id", "text", "lang", "source", "n_chars"] for df in list(steps.values())[:-1])
    texts = {r.doc_id: r.text for r in util.documents(spark, d).collect()}
    lang = {r.doc_id for r in steps["language ID"].collect()}
    assert lang == {i for i in ids if any(c.isalpha() for c in texts[i])}
    first = {}
    for i in sorted(lang):
        first.setdefault(" ".join(__import__("re").split("[\x20\x09-\x0d]+", texts[i])), i)
    exact = {r.doc_id for r in steps["exact dedup"].collect()}
    assert exact == set(first.values())
    near = brute([(i, texts[i]) for i in sorted(exact)])
    assert {r.doc_id for r in steps["n-gram Jaccard join"].collect()} == {i for i, v in near.items() if v[0] == i}
    mixed = [r.doc_id for r in steps["mixing sources to target weights"].collect()]
    packed = steps["packing"].where("start = 0").collect()
    assert sorted(mixed) == sorted(r.doc_id for r in packed)


def test_the_share_of_texts_moved_does_not_grow(spark):
    shares = []
    for n in (2_000, 20_000):
        texts = spark.range(60 * n).select(F.xxhash64("id").alias(J.MARK), "id")
        named = texts.where("id % 60 = 7").select(J.MARK)
        got = J._marked(texts, named)
        assert got.columns == texts.columns and got.where("id % 60 = 7").count() == n
        shares.append((got.count() - n) / (59 * n))
    assert shares[0] < 0.05 and abs(shares[0] - shares[1]) < 0.02
    assert J._marked(texts, named.limit(0)).count() == 0 and J.map_bits(10**12) == J.MOST_BITS
