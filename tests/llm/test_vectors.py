"""Vector codes against brute force in plain integers."""

import hashlib
import math

import numpy as np
import pytest

from contigframe.llm import vector_codes as V


def brute(rows):
    kept = [(i, [math.floor(256 * c) for c in v], y) for i, v, y in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    first = [v for _, v, _ in sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:64]]
    wide = len(first[0]) // 16
    cut = lambda v: [v[k * wide : (k + 1) * wide] for k in range(16)]
    books = [[cut(v)[k] for v in first] for k in range(16)]

    def nearest(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), j) for j, e in enumerate(book))

    for _ in range(2):
        for k in range(16):
            own = {}
            for _, v, _ in kept:
                own.setdefault(nearest(cut(v)[k], books[k])[1], []).append(cut(v)[k])
            for j, parts in own.items():
                books[k][j] = [sum(x) // len(parts) for x in zip(*parts)]
    found = [(i, y, [nearest(p, books[k]) for k, p in enumerate(cut(v))]) for i, v, y in kept]
    out = [(i, "".join(f"{j:02x}" for _, j in near), sum(d for d, _ in near), y) for i, y, near in found]
    sha = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    return sorted(((i, c, e, sum(f for _, _, f, z in out if z == y), sha) for i, c, e, y in out), key=str)


def result(df):
    return sorted(((r["vec_id"], r["code"], r["error"], r["label_error"], r["codebooks_sha256"]) for r in V.vector_codes(df).collect()), key=str)


SCHEMA = "vec_id long, embedding array<float>, label int, code string, sums int"


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(V, "LEAF", 4)
    rng = np.random.default_rng(5)
    vectors = (rng.integers(-12, 12, (400, 32)) / 64).astype(np.float32).tolist()  # few values: many ties and equal points
    rows = [(i, v, None if i % 7 == 0 else i % 3) for i, v in enumerate(vectors)]
    rows += [rows[9], rows[9], (None, vectors[3], 1), (1000, None, 1), (1001, [], 1), (1002, [None] * 32, 0), (1003, [float("nan")] * 32, 0), (1004, [float("-inf")] * 32, 0)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    assert result(df.repartition(5)) == brute(rows) == result(df.coalesce(1))


def test_tree_equals_all_distances():
    rng = np.random.default_rng(1)
    for n, d, k, spread in ((1, 1, 1, 3), (1000, 4, 64, 8), (5000, 3, 64, 200), (700, 2, 5, 1), (64, 4, 64, 2)):
        points, book = rng.integers(-spread, spread + 1, (n, d)), rng.integers(-spread, spread + 1, (k, d))
        own, sums, counts = V.Tree(points).assign(book)
        far = ((points[:, None] - book[None]) ** 2).sum(-1)
        assert (own == far.argmin(1)).all() and (counts == np.bincount(own, minlength=k)).all()
        assert all((sums[j] == points[own == j].sum(0)).all() for j in range(k))


def test_empty_and_short_tables(spark):
    assert result(spark.createDataFrame([], SCHEMA)) == []
    assert result(spark.createDataFrame([(1, None, 1, "x", 1)], SCHEMA)) == []
    one = [(4, [0.5] * 16, None)]
    assert result(spark.createDataFrame([(*one[0], "x", 1)], SCHEMA)) == brute(one)
    with pytest.raises(ValueError):
        V.vector_codes(spark.createDataFrame([(1, [0.5] * 17, 1, "x", 1)], SCHEMA))


def test_other_lengths_are_left_out(spark):
    rows = [(1, [0.5] * 16, 1), (2, [0.25] * 16, 1)]
    df = spark.createDataFrame([(*r, "x", 1) for r in [*rows, (3, [1.0] * 32, 1)]], SCHEMA)
    assert result(df) == brute(rows)
