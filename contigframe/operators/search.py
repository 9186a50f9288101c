"""Similarity search as joins: seeds of queries meet seeds of references by key, those of one diagonal make candidates, and only these are aligned.

A query is cut into units: a protein is one; a nucleotide query has a unit for each stretch without a stop codon in each of its six frames
(translated search), or one for each strand (nucleotide search). A seed is the groups of ``k`` letters in a row; low-complexity ones are
left out. A unit and a reference are a candidate where two seeds lie on neighbouring diagonals; a candidate's letters are fetched by key and
aligned in a band, in Arrow batches. A frequent seed, unit or reference is salted, so none stops a task.

References can be stored once as an index, bucketed by seed and by name; a search then moves only queries.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from contigframe.functions.sequence import _BASES, _CODE
from contigframe.operators import alignment as A
from contigframe.operators import sequences as Q
from contigframe.operators import tables

#: Letters of a seed by alphabet, diagonals of a bin, seeds of a candidate, letters of a unit that are worth a search.
SEED = {"protein": 6, "dna": 11}
BIN, SEEDS, LEAST_UNIT = 16, 2, {"protein": 12, "dna": 20}
#: Candidates that are scored at once, and aligned at once; letters whose seeds are found at once; bits of the map of seeds that references have.
SCORED, BATCH, LETTERS, BITS = 1024, 256, 1 << 20, 1 << 22
#: References of at most so many letters in all go to the tasks as an index of at most 16 bytes for each; pairs of equal seeds that are held at once; candidates of a batch.
SMALL, PAIRS, ROWS = 1 << 21, 1 << 20, 4096
UNITS = "q string, strand int, frame int, at long, qlen long, letters string"
PAIR = "t string, q string, strand int, at long, qlen long, centre int, text string"
PROTEIN, TRANSLATED, NUCLEOTIDE = "protein", "translated", "nucleotide"

_DIGIT = np.full(256, 64, np.int16)
for _k, _b in enumerate(_BASES):
    _DIGIT[[ord(_b), ord(_b.lower())]] = _k
_AMINO = np.frombuffer(_CODE.encode(), np.uint8)
_COMPLEMENT = bytes.maketrans(b"ACGTacgt", b"TGCAtgca")


def scoring(kind: str) -> A.Scoring:
    return A.DNA if kind == NUCLEOTIDE else A.PROTEIN


def translated(seq: bytes, frame: int) -> np.ndarray:
    """Letters of a reading frame, X where a codon isn't plain."""
    d = _DIGIT[np.frombuffer(seq, np.uint8)[frame:]]
    d = d[: len(d) // 3 * 3].reshape(-1, 3)
    code = 16 * d[:, 0] + 4 * d[:, 1] + d[:, 2]
    return np.where(code < 64, _AMINO[np.minimum(code, 63)], ord("X")).astype(np.uint8)


def contig_queries(contigs: DataFrame) -> DataFrame:
    """Contigs (contig, seq) as queries in chunks, so that a long one is many rows; alignments up to a chunk's halo in length are whole."""
    sized = contigs.select("contig", F.length("seq").cast("long").alias("qlen"))
    chunks = Q.sequence_chunks(contigs).join(sized, "contig")
    return chunks.select(F.col("contig").alias("q"), F.col("bases").alias("seq"), (F.col("chunk") * Q.SIZE).alias("offset"), "qlen")


def query_units(queries: DataFrame, kind: str, distinct: bool = True) -> DataFrame:
    """(q, strand, frame, at, qlen, letters) of ``queries`` (q, seq; of a part of a longer query, its offset and the whole's qlen too): ``at`` is the unit's first
    place from 0 in its reading direction, in letters of the whole. Repeated queries go, if ``distinct``."""
    part = {"offset", "qlen"} <= set(queries.columns)
    rows = queries.select(
        F.col("q").cast("string").alias("q"), F.upper(F.col("seq").cast("string")).alias("seq"), (F.col("offset") if part else F.lit(0)).cast("long").alias("offset"), (F.col("qlen") if part else F.length("seq")).cast("long").alias("qlen")
    ).where("seq is not null")
    rows = rows.distinct() if distinct else rows
    if kind == PROTEIN:
        return rows.select("q", F.lit(1).alias("strand"), F.lit(0).alias("frame"), F.col("offset").alias("at"), "qlen", F.col("seq").alias("letters"))
    least = LEAST_UNIT["dna" if kind == NUCLEOTIDE else "protein"]

    def made(out: list[tuple]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.string())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=[c.split()[0] for c in UNITS.split(", ")])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            held = 0
            for q, seq, offset, qlen in zip(*(batch.column(c).to_pylist() for c in ("q", "seq", "offset", "qlen")), strict=True):
                plus = seq.encode("ascii", "replace")
                for strand, text, first in ((1, plus, offset), (-1, plus.translate(_COMPLEMENT)[::-1], qlen - offset - len(seq))):
                    if kind == NUCLEOTIDE:
                        if len(text) >= least:
                            out.append((q, strand, 0, first, qlen, text.decode()))
                        continue
                    for frame in range(3):
                        letters = translated(text, frame)
                        ends = np.flatnonzero(np.append(letters, ord("*")) == ord("*"))
                        starts = np.concatenate([[0], ends[:-1] + 1])
                        for a, b in zip(starts[ends - starts >= least].tolist(), ends[ends - starts >= least].tolist(), strict=True):
                            out.append((q, strand, frame, first + 3 * a + frame, qlen, letters[a:b].tobytes().decode()))
                held += len(seq)
                if held >= LETTERS:
                    yield from made(out)
                    out, held = [], 0
            yield from made(out)

    return rows.mapInArrow(work, UNITS)


def places(texts: list[str], kind: str, k: int, known_in: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text, place, seed) of every place whose k letters are known and of at least three different groups, in order, of about ``LETTERS`` letters at once; a text isn't cut."""
    score = scoring(kind)
    width, groups = int(score.groups.max()) + 1, np.append(score.groups, [-1, -1]).astype(np.int32)

    def found(g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(g) - k + 1
        seed, known, seen = np.zeros(n, np.int64), np.ones(n, bool), np.zeros(n, np.int32)
        for j in range(k):
            part = g[j : n + j]
            known &= part >= 0
            seed *= width
            seed += part
            seen |= 1 << np.maximum(part, 0)
        if known_in is not None:
            spot = seed % BITS
            known &= (known_in[spot >> 3] >> (spot & 7) & 1).astype(bool)
        at = np.flatnonzero(known)
        at = at[np.bitwise_count(seen[at]) >= 3]
        return at, seed[at]

    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    slot = np.cumsum(sizes) // LETTERS
    for first, last in pairwise([*np.flatnonzero(np.diff(slot, prepend=-1)).tolist(), len(texts)]):
        g = groups[score.codes("?".join(texts[first:last]) + "?")]  # an unknown letter stands between texts, which no seed has
        if len(g) < k:
            continue
        at, seed = found(g)
        firsts = np.cumsum(sizes[first:last]) - sizes[first:last]
        owner = np.searchsorted(firsts, at, side="right") - 1
        yield owner + first, at - firsts[owner], seed


def seeds(rows: DataFrame, keys: list[str], letters: str, kind: str, k: int, known_in: np.ndarray | None = None) -> DataFrame:
    """(seed, ``keys``, place) of the ``places`` of the column ``letters``. With ``known_in``, a map as ``References.map`` gives it, those that the references surely lack are
    left out."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for owner, place, seed in places([t or "" for t in batch.column(letters).to_pylist()], kind, k, known_in):
                taken = pa.array(owner)
                yield pa.RecordBatch.from_arrays([pa.array(seed), *(batch.column(c).take(taken) for c in keys), pa.array(place.astype(np.int32))], names=["seed", *keys, "place"])

    types = {c: rows.schema[c].dataType.simpleString() for c in keys}
    return rows.select(*keys, letters).mapInArrow(work, f"seed long, {', '.join(f'{c} {t}' for c, t in types.items())}, place int")


class Index:
    """Seeds of a few references in order, each with the places that have it, and a map of them as ``References.map`` gives it."""

    def __init__(self, names: list[str], texts: list[str], kind: str, k: int):
        self.kind, self.k, self.names, self.sizes = kind, k, names, np.array([len(t) for t in texts], np.int64)
        target, place, seed = (np.concatenate(x) for x in zip((np.zeros(0, np.int64),) * 3, *places(texts, kind, k), strict=True))
        order = np.argsort(seed, kind="stable")
        self.target, self.place = target[order].astype(np.int32), place[order].astype(np.int32)
        self.seeds, starts = np.unique(seed[order], return_index=True)
        self.starts, known = np.append(starts, len(seed)), np.zeros(BITS, bool)
        known[self.seeds % BITS] = True
        self.map = np.packbits(known, bitorder="little")

    def candidates(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(text, reference, centre) as ``candidates`` gives them. At most ``PAIRS`` pairs of equal seeds are held (or those of one place), and the bins of one text."""
        for owner, place, seed in places(texts, self.kind, self.k, self.map):
            if len(self.seeds):
                row = np.minimum(np.searchsorted(self.seeds, seed), len(self.seeds) - 1)
                at = np.flatnonzero(self.seeds[row] == seed)
                yield from self._met(owner[at], place[at], row[at])

    def _met(self, owner: np.ndarray, place: np.ndarray, row: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        n = self.starts[row + 1] - self.starts[row]
        upto = np.cumsum(n)
        least = -2 * (int(self.place.max(initial=0)) // BIN + 2)  # below any bin
        bins = 2 * (int(place.max(initial=0)) // BIN + 2) - least + 2
        key, count, total = (np.zeros(0, np.int64) for _ in range(3))
        i = 0
        while i < len(row):
            j = max(i + 1, int(np.searchsorted(upto, upto[i] - n[i] + PAIRS, side="right")))
            own = np.repeat(np.arange(i, j), n[i:j])
            there = np.arange(len(own)) + np.repeat(self.starts[row[i:j]] - (upto[i:j] - n[i:j] - (upto[i] - n[i])), n[i:j])
            diagonal = place[own] - self.place[there]
            base = (owner[own] * len(self.names) + self.target[there]) * bins - least
            key = np.concatenate([key, base + diagonal // BIN * 2, base + (diagonal + BIN // 2) // BIN * 2 + 1])
            count, total = np.concatenate([count, np.ones(2 * len(own), np.int64)]), np.concatenate([total, diagonal, diagonal])
            order = np.argsort(key, kind="stable")
            key = key[order]
            first = np.flatnonzero(np.diff(key, prepend=-1))
            key, count, total = key[first], np.add.reduceat(count[order], first), np.add.reduceat(total[order], first)
            # texts before the last one are through
            done = np.searchsorted(key, owner[j - 1] * len(self.names) * bins) if j < len(row) else len(key)
            ok = np.flatnonzero(count[:done] >= SEEDS)
            if len(ok):
                pair, centre = key[ok] // bins, total[ok] // count[ok]
                low = centre.min()
                pair, centre = np.divmod(np.unique(pair * (centre.max() - low + 1) + centre - low), centre.max() - low + 1)
                yield pair // len(self.names), pair % len(self.names), centre + low
            key, count, total = key[done:], count[done:], total[done:]
            i = j


@dataclass
class References:
    """``letters`` (t, letters) and ``seeds`` (seed, t, place) of references of one alphabet, the letters of a seed, and the sum of lengths."""

    kind: str
    k: int
    letters: DataFrame
    seeds: DataFrame
    total: int

    @staticmethod
    def of(targets: DataFrame, kind: str, k: int | None = None) -> References:
        """References (t, seq) for one search: protein for protein and translated searches. Of rows with one name one is taken."""
        letters = targets.select(F.col("t").cast("string").alias("t"), F.upper(F.col("seq").cast("string")).alias("letters")).where("t is not null and letters is not null").groupBy("t").agg(F.min("letters").alias("letters"))
        total = letters.agg(F.coalesce(F.sum(F.length("letters")), F.lit(0))).first()[0]
        k = k or SEED["dna" if kind == NUCLEOTIDE else "protein"]
        return References(kind, k, letters, seeds(letters, ["t"], "letters", kind, k), total)

    def map(self) -> np.ndarray:
        """A bit for each seed there is, by its rest by ``BITS``: half a megabyte at any number of references. The driver sees its words that aren't zero."""
        word, bit = F.expr(f"cast(seed % {BITS} div 32 as int)"), F.expr("shiftleft(1L, cast(seed % 32 as int))")
        words = self.seeds.groupBy(word.alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()
        out = np.zeros(BITS // 32, "<u4")
        out[words.column("word").to_numpy()] = words.column("bits").to_numpy()
        return out.view(np.uint8)

    def index(self) -> Index:
        """For references of at most ``SMALL`` letters, which the driver sees."""
        rows = sorted((r["t"], r["letters"]) for r in self.letters.select("t", "letters").collect())
        return Index([t for t, _ in rows], [x for _, x in rows], self.kind, self.k)

    def store(self, name: str, buckets: int, path: str | None = None) -> References:
        """As two tables, ``name``_seeds and ``name``_letters, bucketed by seed and by name: built once, they are joined where they lie."""
        spark = self.letters.sparkSession
        for df, part, key in ((self.seeds, "seeds", "seed"), (self.letters, "letters", "t")):
            writer = df.repartition(buckets, key).write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key)
            (writer.option("path", f"{path}/{part}") if path else writer).saveAsTable(f"{name}_{part}")
        return References.stored(spark, name, self.kind, self.k)

    @staticmethod
    def stored(spark: SparkSession, name: str, kind: str, k: int | None = None) -> References:
        letters = spark.table(f"{name}_letters")
        k = k or SEED["dna" if kind == NUCLEOTIDE else "protein"]
        return References(kind, k, letters, spark.table(f"{name}_seeds"), letters.agg(F.coalesce(F.sum(F.length("letters")), F.lit(0))).first()[0])


def candidates(units: DataFrame, references: References, kind: str, salted: bool = True) -> DataFrame:
    """(unit, t, centre): units (a written table with their numbers) and references with at least ``SEEDS`` seeds on neighbouring diagonals, and the mean of these.
    With ``salted`` false, seeds are joined as they are, so that an index stays where it is."""
    own = seeds(units, ["unit"], "letters", kind, references.k, references.map()).withColumnRenamed("place", "qplace")
    pairs = tables.salted_join(tables.written(own, "seeds"), references.seeds, ["seed"]) if salted else own.join(references.seeds, "seed")
    diagonal = F.col("qplace") - F.col("place")
    half = lambda shift: F.floor((diagonal + shift) / BIN) * 2 + (1 if shift else 0)  # noqa: E731 - bins that overlap by half
    binned = pairs.select("unit", "t", diagonal.alias("diagonal"), F.explode(F.array(half(0), half(BIN // 2))).alias("bin"))
    found = binned.groupBy("unit", "t", "bin").agg(F.count("*").alias("n"), F.floor(F.avg("diagonal")).cast("int").alias("centre")).where(F.col("n") >= SEEDS)
    return found.select("unit", "t", "centre").distinct()


def reached(found: DataFrame, units: DataFrame, references: References, kind: str) -> DataFrame:
    """(t, q, strand, at, qlen, centre, text) of candidates: of a unit only the letters that the band reaches."""
    step = 3 if kind == TRANSLATED else 1
    sized = tables.salted_join(found, references.letters.select("t", F.length("letters").alias("tsize")), ["t"])
    both = tables.salted_join(sized, units.withColumnRenamed("letters", "text"), ["unit"])
    left = F.col("centre") - A.WIDTH // 2
    low, high = F.greatest(left, F.lit(0)), F.least(F.length("text"), left + F.col("tsize") + A.WIDTH)
    piece = F.substring("text", low + 1, F.greatest(high - low, F.lit(0)))
    return both.select("t", "q", "strand", (F.col("at") + step * low).alias("at"), "qlen", (F.col("centre") - low).alias("centre"), piece.alias("text"))


def met(units: DataFrame, references: References, kind: str) -> DataFrame:
    """What ``candidates`` and ``reached`` give, found where the units lie, by the index of a few references that each task has: nothing but candidates is moved."""
    step, sent = 3 if kind == TRANSLATED else 1, units.sparkSession.sparkContext.broadcast(references.index())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = sent.value
        for batch in batches:
            texts = batch.column("letters").to_pylist()
            q, strand, at, qlen = (batch.column(c) for c in ("q", "strand", "at", "qlen"))
            for every in index.candidates(texts):
                for a in range(0, len(every[0]), ROWS):
                    own, target, centre = (x[a : a + ROWS] for x in every)
                    left, taken = centre - A.WIDTH // 2, pa.array(own)
                    low, high = np.maximum(left, 0), left + index.sizes[target] + A.WIDTH
                    pieces = [texts[k][i : max(i, j)] for k, i, j in zip(own.tolist(), low.tolist(), high.tolist(), strict=True)]
                    columns = [pa.array([index.names[k] for k in target.tolist()]), q.take(taken), strand.take(taken), pa.array(at.take(taken).to_numpy() + step * low), qlen.take(taken), pa.array((centre - low).astype(np.int32)), pa.array(pieces)]
                    yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in PAIR.split(", ")])

    return units.select("q", "strand", "at", "qlen", "letters").mapInArrow(work, PAIR)


def aligned(both: DataFrame, references: References, kind: str, most_evalue: float, letters: bool = False) -> DataFrame:
    """Hits (query, target, pident, evalue, bits, qstart, qend, tstart, tend, qlen, tlen, qcov, tcov, alnlen): the best local alignment of each candidate, equal ones once; with
    ``letters`` its rows too (qaln, taln).

    A candidate is scored first; only those whose E-value is low enough are traced back."""
    schema = f"{HIT}, qaln string, taln string" if letters else HIT
    score, total, step = scoring(kind), float(max(references.total, 1)), 3 if kind == TRANSLATED else 1
    both = tables.salted_join(tables.written(both, "pairs"), references.letters, ["t"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for every in batches:
            texts, refs, sizes, kept = every.column("text").to_pylist(), every.column("letters").to_pylist(), every.column("qlen").to_numpy(), []
            order, centres = np.argsort([len(x) for x in refs], kind="stable"), every.column("centre").to_numpy()
            for a in range(0, len(order), SCORED):
                own = order[a : a + SCORED]
                top = A.best_scores([score.codes(texts[k]) for k in own], [score.codes(refs[k]) for k in own], centres[own], score)
                kept.append(own[(top > 0) & (score.evalue(top, sizes[own] / step, total) <= most_evalue)])
            whole = every.take(pa.array(np.concatenate(kept))) if kept else every
            for a in range(0, whole.num_rows, BATCH):
                b = whole.slice(a, BATCH)
                col = lambda c, b=b: b.column(c).to_numpy(zero_copy_only=False)
                texts, refs = b.column("text").to_pylist(), b.column("letters").to_pylist()
                steps: list[np.ndarray] | None = [] if letters else None
                got = A.align([score.codes(x) for x in texts], [score.codes(x) for x in refs], col("centre"), score, steps=steps)
                drawn = [pa.array(x, pa.string()) for x in A.columns(texts, refs, got, steps)] if letters else []
                qlen, tlen = col("qlen"), np.array([len(x) for x in refs])
                evalue = score.evalue(got["score"], qlen / step, total)
                ok = np.flatnonzero((got["score"] > 0) & (evalue <= most_evalue))
                if not len(ok):
                    continue
                got = {k: v[ok] for k, v in got.items()}
                qlen, tlen, minus, at = qlen[ok], tlen[ok], col("strand")[ok] < 0, col("at")[ok]
                first, last = at + step * got["qs"], at + step * got["qe"] + step - 1
                start, end = np.where(minus, qlen - first, first + 1), np.where(minus, qlen - last, last + 1)
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column("q").take(pa.array(ok)), b.column("t").take(pa.array(ok)), pa.array(100.0 * got["same"] / np.maximum(got["length"], 1)), pa.array(evalue[ok]), pa.array(score.bits(got["score"])),
                        pa.array(start), pa.array(end), pa.array(got["ts"] + 1), pa.array(got["te"] + 1), pa.array(qlen), pa.array(tlen), pa.array((np.abs(end - start) + 1) / qlen), pa.array((got["te"] - got["ts"] + 1) / tlen), pa.array(got["length"]),
                        *(x.take(pa.array(ok)) for x in drawn),
                    ],
                    names=[x.split()[0] for x in schema.split(", ")],
                )

    return both.mapInArrow(work, schema).distinct()


HIT = "query string, target string, pident double, evalue double, bits double, qstart long, qend long, tstart long, tend long, qlen long, tlen long, qcov double, tcov double, alnlen long"


def ranked(hits: DataFrame, most: int) -> DataFrame:
    """With ``hit_ord``, 1 for a query's best hit: more bits, lower E-value, then target and place; all hits of its first ``most`` targets."""
    place = ["target", "qstart", "qend", "tstart", "tend"]
    best = Window.partitionBy("query").orderBy(F.col("top").desc(), "target")
    tops = hits.groupBy("query", "target").agg(F.max("bits").alias("top")).withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= most).select("query", "target")
    order = Window.partitionBy("query").orderBy(F.col("bits").desc(), "evalue", *place)
    return hits.join(tops, ["query", "target"]).withColumn("hit_ord", F.row_number().over(order))


class SeedSearch:
    """A search provider: ``search`` gives the hits of queries (q, seq) in references, at most ``max_seqs`` targets a query."""

    def __init__(self, kind: str, evalue: float = 1e-3, max_seqs: int = 300, k: int | None = None, letters: bool = False):
        self.kind, self.evalue, self.max_seqs, self.k, self.letters = kind, evalue, max_seqs, k, letters

    def search(self, queries: DataFrame, database: References | DataFrame | None, indexed: bool = False) -> DataFrame | None:
        """Without references, nothing: the tier that asked is skipped. Repeated queries (of one name and sequence) are searched once; null sequences have no hits."""
        if database is None:
            return None
        references = database if isinstance(database, References) else References.of(tables.written(database, "references"), self.kind, self.k)
        if references.total <= SMALL and not indexed:
            both = met(query_units(queries, self.kind, distinct=False), references, self.kind)  # equal hits are dropped later
        else:
            units = query_units(queries, self.kind).withColumn("unit", F.monotonically_increasing_id())
            units = tables.written(units, "units")
            found = tables.written(candidates(units, references, self.kind, salted=not indexed), "candidates")
            both = reached(found, units, references, self.kind)
        return ranked(tables.written(aligned(both, references, self.kind, self.evalue, self.letters), "hits"), self.max_seqs)
