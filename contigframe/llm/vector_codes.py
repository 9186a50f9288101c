"""Product codes of vectors by filtering Lloyd.

Components become integers, vectors are cut into equal parts, and each part position has a codebook of its own. In each round every task
builds kd-trees over its parts, with the sum and count of each cell. Codebook entries go down the tree together: in each cell
those go that lie farther from every point of its box than the one nearest to its middle, and once a single entry is left, the
whole subtree is its own, by the cached sum and count. Only sums and counts of entries leave a task, so that a round shuffles
in proportion to tasks and codebooks, not to vectors. All is integer arithmetic, so results don't depend on how rows are dealt.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contigframe.llm import tokens, util

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256.0
#: Vectors whose trees a task holds at once, points of a cell that isn't split, and numbers of one array while entries are compared.
BLOCK, LEAF, WIDE = 65_536, 32, 4_000_000
#: Integers beyond this could leave 64 bits when they are squared and summed.
LARGEST = 1 << 24


class Tree:
    """A balanced kd-tree over integer points: levels of cells, each a range of ``order`` with its box and sum; cell i has the children 2i and 2i + 1."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.order, bounds, self.levels = np.arange(len(points)), np.array([0, len(points)]), []
        while True:
            inside = points[self.order]
            starts, sizes = bounds[:-1], np.diff(bounds)
            low, high = np.minimum.reduceat(inside, starts), np.maximum.reduceat(inside, starts)
            self.levels.append((bounds, low, high, np.add.reduceat(inside, starts)))
            if sizes.max() <= leaf:
                break
            cell, widest = np.repeat(np.arange(len(sizes)), sizes), (high - low).argmax(axis=1)
            self.order = self.order[np.lexsort((inside[np.arange(len(inside)), widest[cell]], cell))]
            bounds = np.append(np.stack([starts, starts + sizes // 2], axis=1).ravel(), len(points))
        self.points = points[self.order]

    def assign(self, book: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(entry of each point, sum and count of each entry's points); ties go to the lower index."""
        own, sums, counts = np.zeros(len(self.points), np.int64), np.zeros_like(book), np.zeros(len(book), np.int64)
        cells, open_ = np.zeros(1, np.int64), np.ones((1, len(book)), bool)
        for bounds, low, high, total in self.levels:
            step = max(1, WIDE // book.size)
            pairs = [_nearest(book, low[cells[a : a + step]], high[cells[a : a + step]], open_[a : a + step]) for a in range(0, len(cells), step)]
            star, open_ = np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs])
            whole = open_.sum(axis=1) == 1
            done, entry = cells[whole], star[whole]
            np.add.at(sums, entry, total[done])
            sizes = bounds[done + 1] - bounds[done]
            np.add.at(counts, entry, sizes)
            own[_ranges(bounds[done], sizes)] = np.repeat(entry, sizes)
            cells, open_ = cells[~whole], open_[~whole]
            if not len(cells):
                break
            last = bounds, cells, open_
            cells, open_ = np.stack([2 * cells, 2 * cells + 1], axis=1).ravel(), np.repeat(open_, 2, axis=0)
        else:  # leaves with more than one entry left: point by point
            bounds, cells, open_ = last
            sizes = bounds[cells + 1] - bounds[cells]
            at, allowed = _ranges(bounds[cells], sizes), np.repeat(np.arange(len(cells)), sizes)
            step = max(1, WIDE // book.size)
            for a in range(0, len(at), step):
                some = at[a : a + step]
                far = _squares(self.points[some][:, None, :] - book[None])
                own[some] = np.where(open_[allowed[a : a + step]], far, np.iinfo(np.int64).max).argmin(axis=1)
            np.add.at(sums, own[at], self.points[at])
            np.add.at(counts, own[at], 1)
        entries = np.zeros(len(own), np.int64)
        entries[self.order] = own
        return entries, sums, counts


def _squares(x: np.ndarray) -> np.ndarray:
    return (x * x).sum(axis=-1)


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def _nearest(book: np.ndarray, low: np.ndarray, high: np.ndarray, open_: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each box the open entry nearest to its middle, and the entries that some point of it may still choose."""
    far = _squares(2 * book[None] - (low + high)[:, None, :])
    star = np.where(open_, far, np.iinfo(np.int64).max).argmin(axis=1)
    best = book[star][:, None, :]
    corner = np.where(book[None] > best, high[:, None, :], low[:, None, :])  # the box's corner that favours the entry most
    gap = _squares(book[None] - corner) - _squares(best - corner)
    return star, open_ & ((gap < 0) | ((gap == 0) & (np.arange(len(book)) <= star[:, None])))


def _integers(column: pa.Array, dims: int) -> np.ndarray:
    flat = np.floor(SCALE * column.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    if len(flat) and np.abs(flat).max() > LARGEST:
        raise OverflowError(f"a component beyond {LARGEST / SCALE} can't be coded in 64 bits")
    return flat.astype(np.int64).reshape(-1, dims)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held, n = [], 0
    for batch in batches:
        for a in range(0, batch.num_rows, BLOCK):
            part = batch.slice(a, BLOCK)
            if held and n + part.num_rows > BLOCK:
                yield pa.Table.from_batches(held).combine_chunks()
                held, n = [], 0
            held.append(part)
            n += part.num_rows
    if n:
        yield pa.Table.from_batches(held).combine_chunks()


def _vectors(table: pa.Table, dims: int) -> np.ndarray:
    return _integers(table.column("vector").chunk(0), dims).reshape(table.num_rows, PARTS, dims // PARTS)


def kept_vectors(rows: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(vec_id, vector, label) of the rows whose vector is there, isn't empty and has finite components only."""
    out = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"), F.col(label_col).alias("label"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return out.where(F.col("vector").isNotNull() & (F.size("vector") > 0) & F.coalesce(finite, F.lit(False)))


def learn(kept: DataFrame, dims: int, first: list[list[float]]) -> np.ndarray:
    """Codebooks (part, entry, position) after all rounds, from those of the ``first`` vectors."""
    books = _integers(pa.array(first, pa.list_(pa.float64())), dims).reshape(len(first), PARTS, -1).transpose(1, 0, 2).copy()
    spark = kept.sparkSession
    for _ in range(ROUNDS):
        sent = spark.sparkContext.broadcast(books)  # a codebook's size, whatever the table's

        def work(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            sums, counts = np.zeros_like(sent.value), np.zeros(sent.value.shape[:2], np.int64)
            for table in _blocks(batches):
                x = _vectors(table, dims)
                for k in range(PARTS):
                    _, s, c = Tree(x[:, k]).assign(sent.value[k])
                    sums[k] += s
                    counts[k] += c
            part, entry = np.nonzero(counts)
            if len(part):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part), pa.array(entry), pa.array(counts[part, entry]), pa.array(list(sums[part, entry]), pa.list_(pa.int64()))], names=["part", "entry", "n", "sums"]
                )

        found = kept.select("vector").mapInArrow(tokens.tidy(work), "part long, entry long, n long, sums array<long>")
        added = found.groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(dims // PARTS)])
        books = books.copy()
        for r in added.collect():  # a row for each entry of a codebook
            books[r["part"], r["entry"]] = [r[f"s{i}"] // r["n"] for i in range(dims // PARTS)]
    return books


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def vector_codes(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row per kept row of ``rows``: vec_id, code, error, label, label_error, codebooks_sha256.

    Defined cases: rows without a vector, with an empty one, or with a null or non-finite component are left out. The smallest
    ``vec_id`` gives the length of vectors, which must be a multiple of ``PARTS``; rows with vectors of another length are left out
    too. Ids that are null come last when codebooks begin, ids that are equal by their vectors; fewer than ``ENTRIES`` vectors give shorter
    codebooks. Repeated rows are rows. Null labels are one label. No kept row gives an empty result. Other columns are not read.
    """
    spark, schema = rows.sparkSession, "vec_id long, label {}, code string, error long"
    kept = kept_vectors(rows, id_col, vector_col, label_col)
    order = [F.col("vec_id").asc_nulls_last(), F.col("vector")]
    smallest = kept.orderBy(*order).limit(1).select(F.size("vector").alias("n")).collect()
    dims = smallest[0]["n"] if smallest else PARTS
    if dims % PARTS:
        raise ValueError(f"vectors of {dims} components can't be cut into {PARTS} equal parts")
    kept = kept.where(F.size("vector") == dims)
    first = [r["vector"] for r in kept.orderBy(*order).limit(ENTRIES).select("vector").collect()]
    books = learn(kept, dims, first) if first else np.zeros((PARTS, 0, dims // PARTS), np.int64)
    sent = spark.sparkContext.broadcast(books)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _blocks(batches):
            x = _vectors(table, dims)
            codes, error = np.zeros((len(x), PARTS), np.uint8), np.zeros(len(x), np.int64)
            for k in range(PARTS):
                own, _, _ = Tree(x[:, k]).assign(sent.value[k])
                codes[:, k] = own
                error += _squares(x[:, k] - sent.value[k][own])
            yield pa.RecordBatch.from_arrays([table.column("vec_id").chunk(0), table.column("label").chunk(0), pa.array([c.tobytes().hex() for c in codes]), pa.array(error)], names=["vec_id", "label", "code", "error"])

    with util.Scratch(spark) as tmp:
        coded = tmp.written(kept.mapInArrow(tokens.tidy(work), schema.format(kept.schema["label"].dataType.simpleString())), "coded")
        own = F.struct("label").alias("own")  # a null label is a label too
        per = coded.groupBy(own).agg(F.sum("error").alias("label_error"))
        out = util.join_heavy(tmp.written(coded.withColumn("own", own), "labelled"), per, ["own"])
        return util.written(out.select("vec_id", "code", "error", "label", "label_error", F.lit(digest(books)).alias("codebooks_sha256")), "vector-codes")


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = vector_codes(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return found.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def oracle() -> str:
    """The same rounds over all distances, in SQL."""
    steps = [
        "v as (select row_number() over () as r, vec_id, label, embedding from embeddings where embedding is not null and len(embedding) > 0 "
        "and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0)",
        f"x as (select r, vec_id, label, cast(floor((i - 1) * {PARTS} / len(embedding)) as int) as part, (i - 1) % (len(embedding) // {PARTS}) as pos, cast(floor({SCALE} * embedding[i]::double) as bigint) as x "
        "from (select *, unnest(range(1, len(embedding) + 1)) as i from v))",
        f"f as (select r, row_number() over (order by vec_id, embedding) - 1 as entry from v qualify entry < {ENTRIES})",
        "b0 as (select part, entry, pos, x from x join f using (r))",
    ]
    for k in range(ROUNDS + 1):
        steps.append(f"d{k} as (select r, x.part, entry, sum((x.x - b.x) * (x.x - b.x)) as d from x join b{k} b on x.part = b.part and x.pos = b.pos group by all)")
        steps.append(f"a{k} as (select r, part, arg_min(entry, (d, entry)) as entry, min(d) as d from d{k} group by all)")
        if k < ROUNDS:
            steps.append(f"m{k} as (select part, entry, pos, cast(floor(sum(x) / count(*)) as bigint) as x from a{k} join x using (r, part) group by all)")
            steps.append(f"b{k + 1} as (select part, entry, pos, coalesce(m.x, b.x) as x from b{k} b left join m{k} m using (part, entry, pos))")
    steps.append(f"c as (select r, string_agg(lower(printf('%02X', entry)), '' order by part) as code, sum(d)::bigint as error from a{ROUNDS} group by r)")
    steps.append(f"s as (select sha256(string_agg(x::varchar, ',' order by part, entry, pos)) as codebooks_sha256 from b{ROUNDS})")
    return f"with {', '.join(steps)} select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error, codebooks_sha256 from c join v using (r), s"


ORACLE = oracle()
