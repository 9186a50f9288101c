"""Exact deduplication and mixing against brute force, with the odd rows that tables can have."""

import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from contigframe.llm import exact_dedup, mixing, util

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, salt string, norm int"
ODD = [
    (1, "a  b", "en", "s1", 4, "x", 1), (2, "a\tb", "en", "s1", 3, "x", 1), (3, None, None, None, None, None, None), (4, "", "en", "s2", 0, "x", 1), (5, "A b", "de", "s2", 3, "x", 1),
    (2, "a\tb", "en", "s1", 3, "x", 1), (None, "a b", None, "s3", 3, "x", 1), (7, "wort " * 20000, "de", None, 1, "x", 1), (8, "\x1cé ", "fr", "s3", 3, "x", 1), (9, "é", "fr", "é", 3, "x", 1),
]


def norm(t):
    return re.sub("[\x20\x09-\x0d]+", " ", t or "")


def expect_dedup(rows):
    groups = {}
    for r in rows:
        groups.setdefault(norm(r[1]), []).append(r[0])
    out = []
    for r in rows:
        ids = groups[norm(r[1])]
        known = [i for i in ids if i is not None]
        out.append((r[0], min(known) if known else None, len(ids), hashlib.sha256(norm(r[1]).encode()).hexdigest()))
    return sorted(out, key=str)


def test_dedup_of_odd_rows(spark):
    got = exact_dedup.exact_dedup(spark.createDataFrame(ODD, SCHEMA)).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str) == expect_dedup(ODD)
    assert sum(r.kept for r in got) == len({norm(r[1]) for r in ODD})


def test_dedup_tells_colliding_texts_apart(spark):
    got = exact_dedup.exact_dedup(spark.createDataFrame(ODD, SCHEMA), salts=3, digest=lambda n: F.lit("same")).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size) for r in got), key=str) == [x[:3] for x in expect_dedup(ODD)]


def test_dedup_of_nothing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert exact_dedup.exact_dedup(empty).collect() == [] and mixing.mix_sources(empty).collect() == []


def test_kept_documents_keep_their_columns(spark):
    docs = spark.createDataFrame(ODD, SCHEMA)
    kept = exact_dedup.kept_documents(docs)
    assert kept.columns == docs.columns and kept.count() == len({norm(r[1]) for r in ODD})


def test_no_python_in_native_plans(spark, monkeypatch):
    docs, plans, save = util.documents(spark, "/root/testdata/sf0.001"), [], util.saved

    def saved(df, path):
        plans.append(df._jdf.queryExecution().toString())
        return save(df, path)

    monkeypatch.setattr(util, "saved", saved)
    for df in (exact_dedup.exact_dedup(docs), mixing.mix_sources(docs)):
        plans.append(df._jdf.queryExecution().toString())
    assert len(plans) > 6 and not any(re.search("Python|Pandas|Arrow", p) for p in plans)


def test_heavy_keys_join_as_others(spark, monkeypatch):
    monkeypatch.setattr(util, "LIGHT", 10)
    rows = spark.createDataFrame([(1, i) for i in range(900)] + [(2 + i % 50, i) for i in range(600)] + [(None, 7)], "k long, v long")
    values = spark.createDataFrame([(1, "one"), (3, "three"), (999, "none")], "k long, x string")
    for how in ("inner", "left"):
        with util.Scratch(spark) as tmp:
            kept = tmp.written(rows, "rows")
            assert len(util.heavy_keys(kept, ["k"])) > 1
            got = util.join_heavy(kept, values, ["k"], how)
            assert sorted(map(str, got.collect())) == sorted(map(str, rows.join(values, ["k"], how).collect()))
            assert got.columns == rows.join(values, ["k"], how).columns


def test_scratch_tables_go(spark):
    import os

    before = set(os.listdir(util.shared_dir(spark).removeprefix("file://")))
    mixing.mix_sources(util.documents(spark, "/root/testdata/sf0.001"))
    after = set(os.listdir(util.shared_dir(spark).removeprefix("file://"))) - before
    assert [x.split("-")[0] for x in after] == ["mix"]


def test_a_cluster_needs_a_shared_folder(monkeypatch):
    class Conf(dict):
        set = dict.__setitem__

    class Session:
        conf = Conf()
        sparkContext = type("C", (), {"master": "spark://host:7077"})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        util.shared_dir(Session())
    Session.sparkContext.master = "local-cluster[2,1,1024]"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        util.shared_dir(Session())
    Session.sparkContext.master = "local[8]"
    assert util.shared_dir(Session()) == util.shared_dir(Session()) != ""


def test_mix_does_not_depend_on_the_session(spark):
    docs = util.documents(spark, "/root/testdata/sf0.001")
    want = sorted(map(str, mixing.mix_sources(docs).collect()))
    held = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("3", "16"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            assert sorted(map(str, mixing.mix_sources(docs.repartition(5)).collect())) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", held)


def test_mixed_documents_of_odd_rows(spark):
    docs = spark.createDataFrame(ODD, SCHEMA)
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    rows, got = {str(r) for r in docs.collect()}, [str(r) for r in out.collect()]
    assert set(got) <= rows and sum("doc_id=4," in r for r in got) == sum("doc_id=3," in r for r in got) == 1
    assert mixing.mixed_documents(docs.limit(0)).collect() == []


def levels(sizes):
    """Targets by resharing the excess until none is above three times its size."""
    weight = {s: k % 3 + 1 for k, s in enumerate(sorted(sizes, key=lambda s: (s is None, (s or "").encode())))}
    target, open_, left = dict.fromkeys(sizes, 0.0), set(sizes), float(sum(sizes.values()))
    while left > 1e-9 and open_:
        w = sum(weight[s] for s in open_)
        for s in list(open_):
            target[s] += left * weight[s] / w
        left = 0.0
        for s in list(open_):
            if target[s] > 3 * sizes[s]:
                left += target[s] - 3 * sizes[s]
                target[s] = 3.0 * sizes[s]
                open_.discard(s)
    return target


def check_mix(rows, got, tolerance):
    sizes = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + len(re.findall("[^\x20\x09-\x0d]+", r[1] or ""))
    target = levels(sizes)
    taken = {}
    by_id = {}
    for r in rows:
        by_id.setdefault(r[0], []).append(r)
    assert len(got) == len(rows)
    for g in got:
        source = by_id[g.doc_id][0][3]
        assert g.source_size == sizes[source] and abs(g.target - target[source]) < 1e-6 * max(1, target[source])
        assert 0 <= g.taken <= 3 * g.size
        taken[source] = taken.get(source, 0) + g.taken
    for s in sizes:
        assert abs(taken[s] - target[s]) <= tolerance + 0.01 * target[s]


def test_mix_of_odd_rows(spark):
    docs = spark.createDataFrame(ODD, SCHEMA)
    first = mixing.mix_sources(docs, block=2).collect()
    check_mix(ODD, first, 4)
    assert sorted(map(str, first)) == sorted(map(str, mixing.mix_sources(docs.repartition(7), block=2).collect()))


def test_small_sources_come_near_their_targets(spark):
    rows = [(10 * k + i, "w " * 10, "en", f"s{k}") for k in range(7) for i in range(2)]
    check_mix(rows, mixing.mix_sources(spark.createDataFrame(rows, SCHEMA.split(", n_chars")[0])).collect(), 1)


def test_a_hot_text_leaves_each_task_once(spark):
    rows = spark.range(50_000).select(F.col("id").alias("doc_id"), F.lit("the same text").alias("text")).repartition(6)
    got = exact_dedup.exact_dedup(rows).agg(F.count("*").alias("n"), F.sum(F.col("kept").cast("int")).alias("kept"), F.max("group_size").alias("size")).first()
    assert (got.n, got.kept, got.size) == (50_000, 1, 50_000)


def test_mix_of_the_test_table(spark):
    docs = util.documents(spark, "/root/testdata/sf0.01").select("doc_id", "text", "lang", "source")
    check_mix([tuple(r) for r in docs.collect()], mixing.mix_sources(docs).collect(), mixing.BLOCK)


@settings(max_examples=15, deadline=None)
@given(st.integers(1, 400), st.integers(0, 10))
def test_permutation(spark, n, key):
    got = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("long"), F.lit(key)).alias("p")).collect()
    assert sorted(r.p for r in got) == list(range(n))


def test_mixed_documents_repeat_in_proportion(spark):
    docs = util.documents(spark, "/root/testdata/sf0.01")
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    words = out.select(F.sum(mixing.word_count("text"))).first()[0]
    total = docs.select(F.sum(mixing.word_count("text"))).first()[0]
    assert abs(words - total) < 0.15 * total


def test_a_folder_without_a_scheme_and_a_task_that_runs_again(spark, tmp_path):
    from contigframe.llm import files

    class Session:
        conf, sparkContext = {"spark.checkpoint.dir": str(tmp_path)}, spark.sparkContext

    where = util.shared_dir(Session())
    assert where == f"file://{tmp_path}"
    files.put(f"{where}/a/x.bin", [b"one", b"two"])
    files.put(f"{where}/a/x.bin", [b"one", b"two"])
    assert [p.name for p in (tmp_path / "a").iterdir()] == ["x.bin"] and (tmp_path / "a" / "x.bin").read_bytes() == b"onetwo"
