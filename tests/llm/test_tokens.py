"""Tokenization, packing and the token store against plain, literal forms."""

import itertools
import json
import tracemalloc
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from contigframe.llm import packing, token_store, tokens, util

SCHEMA = "doc_id long, text string, start string, digest int"
ODD = [(1, "Hello, world. x", "c", 0), (2, None, "c", 0), (3, "", "c", 0), (2, None, "c", 0), (None, "İstanbul ΣΑΣ.", None, None), (5, "word " * 9000, "c", 0), (6, "x" * 6000, "c", 0), (7, "Hello, world. x", "c", 0)]


@pytest.fixture(scope="module")
def tok():
    return tokens.loaded(tokens.default_path())


def plain(tok, text):
    return tok.tok.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.one_of(st.sampled_from("aB.,! \n\t'É1İΣß<|>’"), st.characters(codec="utf-8")), max_size=30), max_size=4))
def test_memo_equals_the_tokenizer(texts):
    t = tokens.loaded(tokens.default_path())
    ids, offsets = t.encode(pa.array(texts, pa.string()))
    assert [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:], strict=True)] == [plain(t, x) for x in texts]


def test_a_worker_tokenizes_many_texts_in_bounded_memory(tok):
    """Six workers share an executor with its heap: arrays over the pieces of 8 MB of text held 110 MB before."""
    batch = pa.RecordBatch.from_arrays([pa.array(["the cat sat on a mat " * 100] * 4_000)], names=["text"])
    tracemalloc.start()
    for part in tokens.slices(batch, "text", packing.SLICE):
        tok.encode(part.column("text"))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 45e6


def test_a_full_executor_packs_alike_in_less_memory(spark, monkeypatch):
    """The pipeline's packing was stopped for its executor's memory: the memo's 40 MB need up to 120 MB more to be looked up."""
    size, memo = packing.LOW_MEMORY
    t, words = tokens.MemoTokenizer(tokens.default_path(), memo), (f"w{k}" for k in range(900_000))
    for _ in range(12):
        t.encode(pa.array([" ".join(itertools.islice(words, 75_000))]))
        assert t.young.bytes() + t.old.bytes() < 3.5 * memo
    monkeypatch.setattr(packing, "LOW_MEMORY", (100, 100))
    rows = lambda **how: sorted(map(tuple, packing.pack(spark.createDataFrame(ODD, SCHEMA), **how).collect()), key=str)
    assert rows(low_memory=True) == rows()


def test_memo_survives_its_bound(tok, monkeypatch):
    monkeypatch.setattr(tokens, "MEMO_BYTES", 100)
    for k in range(4):
        texts = ["one two three four", "five one, two.", "", f"one {k} six{k % 2}", "x" * 500]
        ids, offsets = tok.encode(pa.array(texts))
        assert [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:], strict=True)] == [plain(tok, x) for x in texts]
        assert len(tok.young.names) <= 11


@pytest.mark.parametrize("name", ["wordpiece", "whole"])
def test_other_tokenizers_encode_whole_texts(tok, tmp_path, name):
    spec = json.loads(open(tokens.default_path(), encoding="utf-8").read())
    assert tokens.separable(spec)
    if name == "whole":  # white space then belongs to tokens, and case counts
        spec["pre_tokenizer"], spec["normalizer"] = {"type": "ByteLevel", "add_prefix_space": True, "trim_offsets": True, "use_regex": True}, None
    else:
        spec["normalizer"]["normalizers"] = spec["normalizer"]["normalizers"][:2]
    assert not tokens.separable(spec)
    path = tmp_path / "tokenizer.json"
    path.write_text(json.dumps(spec), encoding="utf-8")
    other = tokens.loaded(str(path))
    texts = ["Hello, World. x", "", "a  b\nC", "É İ ß"]
    ids, offsets = other.encode(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:], strict=True)] == [other.tok.encode(x, add_special_tokens=False).ids for x in texts]


def check_pack(rows, got, tok, length):
    want = [(r[0], np.array([*plain(tok, r[1]), 1], "<u4")) for r in rows]
    pieces, sequences = defaultdict(list), defaultdict(list)
    for g in got:
        pieces[g.doc_id].append((g.start, g.length, g.ids_crc32, g.doc_tokens))
        sequences[g.sequence_id].append((g.offset, g.length))
    # cuts are free: whatever they are, each id of each row lies in one piece
    expect = defaultdict(list)
    for d, ids in want:
        expect[d].append(ids)
    assert set(pieces) == set(expect)
    for d, rows_ids in expect.items():
        left = sorted(pieces[d])
        for ids in sorted(rows_ids, key=len, reverse=True):
            at = 0
            while at < len(ids):
                piece = next(p for p in left if p[0] == at and p[3] == len(ids) and at + p[1] <= len(ids) and p[2] == zlib.crc32(ids[at : at + p[1]].tobytes()))
                left.remove(piece)
                at += piece[1]
        assert not left
    for held in sequences.values():
        end = 0
        for offset, n in sorted(held):
            assert offset == end
            end += n
        assert end <= length
    assert sorted(sequences) == list(range(len(sequences)))
    return [sum(n for _, n in v) for v in sequences.values()]


def test_pack_odd_rows(spark, tok):
    check_pack(ODD, packing.pack(spark.createDataFrame(ODD, SCHEMA)).collect(), tok, 2048)
    assert packing.pack(spark.createDataFrame([], SCHEMA)).collect() == []


def test_pack_the_test_table_with_little_padding(spark, tok):
    docs = util.documents(spark, "/root/testdata/sf0.01").select("doc_id", "text")
    fill = check_pack([tuple(r) for r in docs.collect()], packing.pack(docs).collect(), tok, 2048)
    assert packing.padding(fill) < 0.02 * sum(fill)


def test_short_pieces_waste_nothing(spark, tok):
    docs = spark.createDataFrame([(i, "a b c d" if i % 2 else "a") for i in range(2000)], "doc_id long, text string")
    fill = check_pack([tuple(r) for r in docs.collect()], packing.pack(docs).collect(), tok, 2048)
    assert len(fill) == -(-sum(fill) // 2048)


@settings(max_examples=30, deadline=None)
@given(st.dictionaries(st.integers(1, 16), st.integers(1, 60), min_size=1, max_size=10))
def test_plan_places_every_piece_once(histogram):
    rows = packing.plan(histogram, 16)
    load = defaultdict(int)
    for size in histogram:
        ranks = []
        for c, first, last, base, n, _ in rows:
            if c == size:
                ranks += range(first, last)
                for r in range(last - first):
                    load[base + r // n] += c
        assert sorted(ranks) == list(range(histogram[size]))
    assert all(v <= 16 for v in load.values())
    bound = -(-sum(k * v for k, v in histogram.items()) // 16)
    assert bound <= len(load) <= 2 * bound + len(histogram)


def test_best_pattern_is_the_best():
    sizes, prices = np.array([3, 4, 5]), np.array([0.3, 0.45, 0.55])
    best = max(a * 0.3 + b * 0.45 + c * 0.55 for a in range(5) for b in range(4) for c in range(3) if 3 * a + 4 * b + 5 * c <= 13)
    value, pattern = packing.best_pattern(prices, sizes, 13)
    assert abs(value - best) < 1e-9 and (pattern * sizes).sum() <= 13


def test_store_round_trip(spark, tok):
    folder = util.new_folder(spark, "store")
    token_store.write_store(spark.createDataFrame(ODD, SCHEMA), folder)
    got = token_store.read_store(spark, folder).collect()
    order = sorted(ODD, key=lambda r: (r[0] is not None, r[0] or 0))
    want, start = [], 0
    for r in order:
        ids = np.array([*plain(tok, r[1]), 2], "<u4")
        want.append((r[0], start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(((g.doc_id, g.start, g.n_tokens, g.ids_crc32) for g in got), key=str) == sorted(want, key=str)
    back = sorted(((r.doc_id, tuple(r.ids)) for r in token_store.document_ids(spark, folder).collect()), key=str)
    assert back == sorted(((r[0], (*plain(tok, r[1]), 2)) for r in ODD), key=str)
    index = spark.read.parquet(f"{folder}/index")
    assert index.count() == index.select("digest").distinct().count()


def test_store_notices_damage(spark):
    folder = util.new_folder(spark, "store")
    token_store.write_store(spark.createDataFrame(ODD, SCHEMA), folder)
    import glob

    path = glob.glob(f"{folder.removeprefix('file://')}/packs/*.pack")[0]
    data = bytearray(open(path, "rb").read())
    data[-1] ^= 1
    open(path, "wb").write(data)
    for crc in glob.glob(f"{folder.removeprefix('file://')}/packs/.*.crc"):
        __import__("os").remove(crc)
    with pytest.raises(Exception, match="damaged"):
        token_store.read_store(spark, folder).collect()


def rewritten(spark, rows, schema, path):
    spark.createDataFrame([tuple(r[c] for c in schema.names) for r in rows], schema).write.mode("overwrite").parquet(path)


@pytest.fixture(scope="module")
def small_store(spark):
    """A store of several parts, with blocks of 8 recipes."""
    docs = spark.createDataFrame([(i, f"text {i} of some") for i in range(200)], "doc_id long, text string")
    held, token_store.FAN = token_store.FAN, 3
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    folder = util.new_folder(spark, "store")
    token_store.write_store(docs, folder)
    yield folder
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    token_store.FAN = held


def test_manifest_is_a_merkle_tree(spark, small_store):
    recipes = spark.read.parquet(f"{small_store}/recipes").collect()
    nodes = {(m.level, m.part, m.at): m for m in spark.read.parquet(f"{small_store}/manifest").collect()}
    parts = {}
    for r in sorted(recipes, key=lambda r: r.row):
        parts.setdefault(r.part, []).append(bytes(r.root))
    tops = []
    for part, roots in sorted(parts.items()):
        level, here = 1, roots
        while True:
            above = [token_store.merkle(here[i : i + 8]) for i in range(0, len(here), 8)]
            for at, root in enumerate(above):
                assert bytes(nodes[level, part, at].root) == root
            here, level = above, level + 1
            if level > max(k for k, p, _ in nodes if p >= 0):
                break
        tops.append(here[0])
    while len(tops) > 1:
        tops = [token_store.merkle(tops[i : i + 8]) for i in range(0, len(tops), 8)]
    whole = nodes[0, -1, 0]
    assert len(parts) > 1 and bytes(whole.root) == tops[0] and whole.documents == 200


@pytest.mark.parametrize("lost", ["row", "part", "part and its lines", "all", "swapped", "line", "nothing"])
def test_changed_recipes_are_noticed(spark, small_store, lost):
    import shutil

    folder = util.new_folder(spark, "store")
    shutil.copytree(small_store.removeprefix("file://"), folder.removeprefix("file://"))
    recipes, manifest = spark.read.parquet(f"{folder}/recipes"), spark.read.parquet(f"{folder}/manifest")
    rows, lines = recipes.collect(), manifest.collect()
    one, two = sorted(rows, key=lambda r: r.row)[:2]
    if lost == "row":
        rows = [r for r in rows if r.row != one.row]
    elif lost.startswith("part"):
        rows = [r for r in rows if r.part != one.part]
    elif lost == "all":
        rows = []
    elif lost == "swapped":  # a whole recipe, root and all, in the place of another
        rows = [r if r.row != one.row else two.__class__(**{**one.asDict(), "digests": two.digests, "root": two.root, "n_tokens": two.n_tokens}) for r in rows]
    if lost == "part and its lines":
        lines = [r for r in lines if r.part != one.part]
    if lost == "line":
        lines = [r for r in lines if r.level]
    rewritten(spark, rows, recipes.schema, f"{folder}/recipes")
    rewritten(spark, lines, manifest.schema, f"{folder}/manifest")
    if lost == "nothing":
        assert token_store.read_store(spark, folder).count() == 200
    else:
        with pytest.raises(Exception, match="manifest"):
            token_store.read_store(spark, folder).collect()


def test_store_of_no_rows_and_clashing_names(spark):
    docs = spark.createDataFrame([(1, "a b", 3, "x")], "doc_id long, text string, part int, digests string")
    for rows, n in ((docs, 1), (docs.limit(0), 0)):
        folder = util.new_folder(spark, "store")
        token_store.write_store(rows, folder)
        assert token_store.read_store(spark, folder).count() == token_store.document_ids(spark, folder).count() == n


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 49407), max_size=3000))
def test_cuts_cover(ids):
    ends = token_store.cuts(np.array(ids, np.uint32))
    assert ends == sorted(set(ends)) and (ends[-1:] == [len(ids)] if ids else ends == [])


def test_cuts_follow_content():
    rng = np.random.default_rng(1)
    body = rng.integers(0, 49408, 40_000).astype(np.uint32)
    one, two = token_store.cuts(body), token_store.cuts(np.concatenate([rng.integers(0, 49408, 777).astype(np.uint32), body]))
    assert len({e + 777 for e in one} & set(two)) > 0.9 * len(one)


def test_marks_are_those_of_a_literal_hash(monkeypatch):
    monkeypatch.setattr(token_store, "MASK", 15)
    monkeypatch.setattr(token_store, "MARKED", 50)
    ids, whole = np.random.default_rng(3).integers(0, 49408, 1000).astype(np.uint32), (1 << 64) - 1

    def met(window: list[int]) -> bool:
        h = 0
        for d, i in enumerate(reversed(window)):
            x = (i + 1) * int(token_store.FACTOR) & whole
            x ^= x >> 29
            h ^= (x << d | x >> (64 - d)) & whole
        return (h * int(token_store.FACTOR) & whole) >> 40 & 15 == 0

    want = [e for e in range(token_store.WINDOW, len(ids) + 1) if met(ids[e - token_store.WINDOW : e].tolist())]
    assert len(want) > 20 and token_store.marks(ids).tolist() == want
    for n in (0, 1, token_store.WINDOW - 1, token_store.WINDOW):  # shorter than a window, and just one
        assert token_store.marks(ids[:n]).tolist() == [e for e in want if e <= n]
    for a, b in ((0, 300), (300, 309), (309, 1000)):  # marks of a stretch are those of the whole that lie in it
        assert token_store.marks(ids[a:b]).tolist() == [e - a for e in want if a + token_store.WINDOW <= e <= b]
