"""Packing token sequences by cutting-stock column generation.

A document's ids are cut into whole sequences and one remainder. Piece lengths, in steps of ``UNIT`` ids, form a histogram of
at most ``LENGTH / UNIT`` classes; it alone reaches the driver. There a linear program over patterns (multisets of classes
that fit a sequence) is solved by column generation: a simplex step prices classes, and an unbounded-knapsack dynamic program
finds the best new pattern for those prices. Counts of patterns are rounded down; what is then left (less than one pattern for
each class) is packed best fit. Pieces, ranked within their class, are then assigned to the patterns' places by arithmetic.

Rounding to a step would waste most of a short piece, so those of up to ``SHORT`` ids are strung together first, in lots, and the
strings are cut, through pieces where need be, into whole sequences; only the rest of each lot is an item of the program.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from contigframe.llm import tokens, util

LENGTH = 2048
UNIT = 16
#: Ids of a short piece, as a part of a sequence, and ids of a lot of short ones.
SHORT, STRING = 16, 1 << 20
END = 1
#: Bytes of text that a worker tokenizes at once; arrays over their pieces take up to 20 times as much.
SLICE = 3_000_000
#: For an executor that earlier stages have filled: bytes of such a part, and of a generation of the tokenizer's memo. Looking up takes a table of
#: up to three times a generation, so a worker stays below 200 MB, for about 40 % more seconds.
LOW_MEMORY = (1_500_000, 10_000_000)
#: Column generation ends when the bound on what is left to gain is below this share.
GAP = 5e-4
STEPS = 4_000
#: Parts that a class is ranked in; fixed, so that sequences don't depend on the session.
LOTS = 1_024
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
_OWN = [c.split()[0] for c in PIECES.split(", ")]


def best_pattern(prices: np.ndarray, sizes: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """The multiset of classes with the highest price in ``room`` units: unbounded knapsack by dynamic programming."""
    value, choice = np.zeros(room + 1), np.full(room + 1, -1)
    for r in range(1, room + 1):
        value[r], choice[r] = value[r - 1], -1
        fits = np.searchsorted(sizes, r, side="right")
        if fits:
            worth = prices[:fits] + value[r - sizes[:fits]]
            k = int(np.argmax(worth))
            if worth[k] > value[r] + 1e-12:
                value[r], choice[r] = worth[k], k
    pattern, r = np.zeros(len(sizes)), room
    while r > 0:
        if choice[r] < 0:
            r -= 1
        else:
            pattern[choice[r]] += 1
            r -= sizes[choice[r]]
    return float(value[room]), pattern


def solve_patterns(sizes: np.ndarray, demand: np.ndarray, room: int, gap: float = GAP, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """(patterns as columns, how often each is used, not whole numbers): the linear program by revised simplex.

    ``sizes`` ascend. It ends when the bound (value / best price) shows a gap below ``gap``. Any basis on the way meets the
    demand exactly, so an early end costs padding only.
    """
    basis = np.diag((room // sizes).astype(float))
    inverse = np.diag(1.0 / np.diag(basis))
    used = (inverse * demand).sum(axis=1)  # sums, not BLAS: its threads would wait for each other on a busy driver
    for _ in range(steps):
        prices = inverse.sum(axis=0)
        best, column = best_pattern(prices, sizes, room)
        if best <= 1 + gap:
            break
        move = (inverse * column).sum(axis=1)
        ratio = np.where(move > 1e-9, used / np.where(move > 1e-9, move, 1), np.inf)
        out = int(np.argmin(ratio))
        inverse[out] /= move[out]
        others = np.arange(len(sizes)) != out
        inverse[others] -= np.outer(move[others], inverse[out])
        basis[:, out] = column
        used = np.maximum((inverse * demand).sum(axis=1), 0)
    return basis, used


def best_fit(left: dict[int, int], room: int) -> list[dict[int, int]]:
    """Bins for the few pieces (class: count) that rounding leaves; longest first, into the fullest bin that has room. Equal pieces go together."""
    bins: list[list] = []
    for size in sorted(left, reverse=True):
        n = left[size]
        for held in sorted(bins, key=lambda b: b[0]):
            if n and held[0] >= size:
                take = min(n, held[0] // size)
                held[0], held[1][size], n = held[0] - take * size, take, n - take
        while n:
            take = min(n, room // size)
            bins.append([room - take * size, {size: take}])
            n -= take
    return [held for _, held in bins]


def plan(histogram: dict[int, int], room: int) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (class, first rank, end rank, first sequence, places in a sequence, place before them).

    Their number depends on ``room`` alone: each pattern is one row for each of its classes.
    """
    sizes = np.array(sorted(histogram), dtype=int)
    if not len(sizes):
        return []
    demand = np.array([histogram[s] for s in sizes], dtype=float)
    basis, used = solve_patterns(sizes, demand, room)
    left, patterns = {int(s): int(histogram[s]) for s in sizes}, []
    for k in range(len(sizes)):
        pattern = {int(sizes[i]): int(basis[i, k]) for i in np.flatnonzero(basis[:, k])}
        times = min([int(used[k] + 1e-9), *(left[c] // n for c, n in pattern.items())])
        if times > 0:
            patterns.append((pattern, times))
            for c, n in pattern.items():
                left[c] -= n * times
    patterns += [(held, 1) for held in best_fit({c: n for c, n in left.items() if n}, room)]
    rows, rank, sequence = [], dict.fromkeys(histogram, 0), 0
    for pattern, times in patterns:
        place = 0
        for c, n in sorted(pattern.items()):
            rows.append((c, rank[c], rank[c] + n * times, sequence, n, place))
            rank[c] += n * times
            place += n
        sequence += times
    return rows


def token_pieces(docs: DataFrame, id_col: str, text_col: str, path: str, length: int, end: int, low_memory: bool = False) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, ids): each document's ids, cut into whole sequences and a remainder; ``ids`` of short pieces only.
    With ``low_memory`` texts are tokenized in smaller parts with a smaller memo; the rows are the same."""
    size, memo = LOW_MEMORY if low_memory else (SLICE, None)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokens.loaded(path, memo)
        for batch in batches:
            for part in tokens.slices(batch, "text", size):
                ids, offsets = tokens.with_end(*tok.encode(part.column("text").fill_null("")), end)
                rows: list[tuple] = []
                for doc, a, b in zip(part.column("doc_id").to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                    for s in range(a, b, length):
                        e = min(s + length, b)
                        rows.append((doc, s - a, e - s, tokens.crc(ids[s:e]), b - a, ids[s:e].astype("<u4").tobytes() if (e - s) * SHORT <= length else None))
                *numbers, short = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in numbers), pa.array(short, pa.binary())], names=[*_OWN, "ids"])
                if low_memory:
                    del ids, offsets, rows, numbers, short
                    tokens.trim()

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(tokens.tidy(cut), PIECES + ", ids binary")


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, length: int = LENGTH, unit: int = UNIT, end: int = END, low_memory: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Defined cases: a null or empty text is the end id alone. Rows repeated with the same id are packed each. An empty table
    gives an empty result. A text of any length is cut into sequences of its own and one remainder. Other columns are not read. ``low_memory`` is for executors that are full already.
    """
    with util.Scratch(docs.sparkSession) as tmp:
        pieces = tmp.written(token_pieces(docs, id_col, text_col, tokenizer or tokens.default_path(), length, end, low_memory), "pieces")
        return util.written(_packed(pieces, length, unit, tmp), "packed")


def strung(pieces: DataFrame, length: int) -> DataFrame:
    """Short pieces (with ``ids``) in lots, one after the other and cut at whole sequences: their columns and (lot, block, inner), the block of ``length`` ids in
    the lot's string and the place in it."""
    total = pieces.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    lot = F.pmod(F.xxhash64("doc_id", "start"), F.lit(total // STRING + 1)).cast("long")
    before = Window.partitionBy("lot").orderBy(*_OWN).rowsBetween(Window.unboundedPreceding, -1)
    placed = pieces.withColumn("lot", lot).withColumn("at", F.coalesce(F.sum("length").over(before), F.lit(0)))
    cut = placed.withColumn("block", F.explode(F.sequence(F.floor(F.col("at") / length).cast("long"), F.floor((F.col("at") + F.col("length") - 1) / length).cast("long"))))
    low, high = F.greatest("at", F.col("block") * length), F.least(F.col("at") + F.col("length"), (F.col("block") + 1) * length)
    part = F.substring("ids", ((low - F.col("at")) * 4 + 1).cast("int"), ((high - low) * 4).cast("int"))
    return cut.select("doc_id", (F.col("start") + low - F.col("at")).alias("start"), (high - low).alias("length"), F.crc32(part).alias("ids_crc32"), "doc_tokens", "lot", "block", (low - F.col("block") * length).alias("inner"))


def _packed(pieces: DataFrame, length: int, unit: int, tmp: util.Scratch) -> DataFrame:
    short = tmp.written(strung(pieces.where("ids is not null"), length), "strung")
    blocks = tmp.written(short.groupBy("lot", "block").agg(F.sum("length").alias("filled")), "blocks")
    rests = blocks.where(F.col("filled") < length).select(F.col("lot").alias("doc_id"), F.col("block").alias("start"), F.col("filled").alias("length"), *[F.lit(None).cast("long").alias(c) for c in ("ids_crc32", "doc_tokens")], F.lit(True).alias("rest"))
    items = pieces.where("ids is null").select(*_OWN, F.lit(False).alias("rest")).unionByName(rests)
    items, sequences = _assigned(items, length, unit)
    items = tmp.written(items, "items")
    # whole blocks are sequences of their own, numbered by a row for each lot
    full = blocks.where(F.col("filled") == length).groupBy("lot").agg(F.count("*").alias("n"))
    first = full.select("lot", (F.coalesce(F.sum("n").over(Window.orderBy("lot").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + sequences).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    numbered = blocks.where(F.col("filled") == length).select("lot", "block").join(first, "lot").withColumn("sequence_id", F.col("sequence_id") + F.col("block"))
    ends = items.where("rest").select(F.col("doc_id").alias("lot"), F.col("start").alias("block"), "sequence_id", "offset")
    members = short.join(numbered.unionByName(ends), ["lot", "block"]).withColumn("offset", F.col("offset") + F.col("inner"))
    return items.where("not rest").select(*_OWN, "sequence_id", "offset").unionByName(members.select(*_OWN, "sequence_id", "offset"))


def _assigned(pieces: DataFrame, length: int, unit: int) -> tuple[DataFrame, int]:
    """(``pieces`` with sequence_id and offset, the number of sequences)."""
    pieces = pieces.withColumn("class", F.ceil(F.col("length") / unit).cast("int")).withColumn("lot", F.pmod(F.xxhash64("doc_id", "start"), F.lit(LOTS)).cast("int"))
    per_lot = pieces.groupBy("class", "lot").agg(F.count("*").alias("n"))
    room = -(-length // unit)
    histogram = {r["class"]: r["n"] for r in per_lot.groupBy("class").agg(F.sum("n").alias("n")).collect()}  # at most ``room`` rows
    rows = plan(histogram, room)
    sequences = max((base + (end - first) // n for _, first, end, base, n, _ in rows), default=0)
    per_lot = per_lot.withColumn("before", F.coalesce(F.sum("n").over(Window.partitionBy("class").orderBy("lot").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    inside = Window.partitionBy("class", "lot").orderBy("rest", *_OWN)
    ranked = pieces.withColumn("in_lot", F.row_number().over(inside) - 1).join(per_lot.select("class", "lot", "before"), ["class", "lot"])
    by_class: dict[int, list[tuple]] = {}
    for c, *rest in rows:
        by_class.setdefault(c, []).append(tuple(rest))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sequence and place of each piece, by its rank within its class; the plan's size is bounded by ``room``."""
        tables = {c: np.array(sorted(v), dtype=np.int64).T for c, v in by_class.items()}
        for batch in batches:
            cls = batch.column("class").to_numpy(zero_copy_only=False)
            rank = batch.column("rank").to_numpy(zero_copy_only=False)
            seq, place = np.zeros(len(cls), np.int64), np.zeros(len(cls), np.int64)
            for c in np.unique(cls):
                at = np.flatnonzero(cls == c)
                first, _, base, n, before = tables[c]
                k = np.searchsorted(first, rank[at], side="right") - 1
                inner = rank[at] - first[k]
                seq[at], place[at] = base[k] + inner // n[k], before[k] + inner % n[k]
            names = [x for x in batch.schema.names if x not in ("class", "rank")]
            yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in names), pa.array(seq), pa.array(place)], names=[*names, "sequence_id", "place"])

    placed = ranked.select(*_OWN, "rest", "class", (F.col("before") + F.col("in_lot")).cast("long").alias("rank")).mapInArrow(assign, PIECES + ", rest boolean, sequence_id long, place long")
    before = Window.partitionBy("sequence_id").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0))).select(*_OWN, "rest", "sequence_id", "offset"), sequences


def padding(lengths: list[int], length: int = LENGTH) -> int:
    """Ids of padding for sequences filled so far: up to ``length``, except at a power of two."""
    return sum(0 if n & (n - 1) == 0 else length - n for n in lengths)


def op1_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(util.documents(spark, sf_dir))
