"""Profile search: best local paths of proteins through profile models, for the pairs that a seed join lets through.

A model has match, insert and delete states for each node. A path enters at any node, each alike, and leaves at any; its score is the sum of log odds (bits) of
matched residues and of transitions. Models are dealt with blocks of their candidates, so none is sent to all tasks and one with many
candidates is many groups; all proteins of a block go through the model together, as arrays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contigframe import constants as C
from contigframe.operators import alignment as A
from contigframe.operators import search, tables

#: Transitions of a node in the order of the text format: to match, insert, delete from match; to match, insert from insert; to match, delete from delete.
MM, MI, MD, IM, II, DM, DD = range(7)
FAR = -1e9
#: Proteins of a block, letters of a seed, seeds of a candidate.
BLOCK, SEED, SEEDS = 256, 5, 2
_BACKGROUND = np.array([A.SHARES[A.RESIDUES.index(c)] for c in C.HMM_ALPHABET], float) / sum(A.SHARES)
_CODE = np.full(256, len(C.HMM_ALPHABET), np.uint8)
for _k, _c in enumerate(C.HMM_ALPHABET):
    _CODE[[ord(_c), ord(_c.lower())]] = _k
PROFILE = "model string, accession string, ga double, emissions array<double>, transitions array<double>, consensus string"


def read_profiles(spark: SparkSession, path: str) -> DataFrame:
    """Profiles (model, accession, ga, emissions, transitions, consensus) of text files of models, a row each: negative natural logarithms there, bits here."""
    return parsed(spark.read.option("lineSep", "//\n").text(path).select(F.col("value").alias("record")).where("trim(record) <> ''"))


def parsed(records: DataFrame) -> DataFrame:
    """The same of records (record) as text. Emissions are log odds against the background, 20 a node; transitions 7 a node."""

    def number(x: str) -> float:
        return FAR if x == "*" else -float(x) / np.log(2)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in batch.column("record").to_pylist():
                head, nodes, rows = {}, [], iter(text.splitlines())
                for line in rows:
                    if line.startswith("HMM "):
                        break
                    key, _, value = line.partition(" ")
                    head[key] = value.strip()
                body = [x.split() for x in rows if x.strip()]
                at = next((k for k, x in enumerate(body) if x[0] == "1"), len(body))
                for k in range(at, len(body) - 2, 3):
                    nodes.append(([number(x) for x in body[k][1:21]], [number(x) for x in body[k + 2][:7]]))
                if nodes:
                    odds = np.array([e for e, _ in nodes]) - np.log2(_BACKGROUND)
                    ga = head.get("GA", "").split(" ")[0].rstrip(";")
                    out.append((head.get("NAME", ""), head.get("ACC"), float(ga) if ga else None, odds.ravel().tolist(), [x for _, t in nodes for x in t], "".join(C.HMM_ALPHABET[k] for k in odds.argmax(axis=1))))
            if out:
                kinds = (pa.string(), pa.string(), pa.float64(), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=[c.split()[0] for c in PROFILE.split(", ")])

    return records.mapInArrow(work, PROFILE)


def of_sequences(references: DataFrame, same: float = 0.8, indel: float = -6.0) -> DataFrame:
    """A profile of each reference protein (t, seq): its residue holds ``same`` of a node, the others share the rest as in the background; unknown residues say nothing."""
    other = np.log2(1 - same)
    steps = [0.0, indel, indel, -1.0, -1.0, -1.0, -1.0]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for t, seq in zip(batch.column("t").to_pylist(), batch.column("seq").to_pylist(), strict=True):
                codes = _CODE[np.frombuffer(seq.encode("latin-1", "replace"), np.uint8)]
                odds = np.full((len(codes), 20), other)
                known = np.flatnonzero(codes < 20)
                odds[known, codes[known]] = np.log2(same) - np.log2(_BACKGROUND[codes[known]])
                odds[codes >= 20] = 0.0
                out.append((t, t, None, odds.ravel().tolist(), steps * len(codes), seq))
            if out:
                kinds = (pa.string(), pa.string(), pa.float64(), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=[c.split()[0] for c in PROFILE.split(", ")])

    return references.select(F.col("t").cast("string").alias("t"), F.upper("seq").alias("seq")).where("seq <> ''").mapInArrow(work, PROFILE)


def viterbi(emissions: np.ndarray, transitions: np.ndarray, proteins: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(score, last place from 1) of each protein's best path; ``emissions`` are nodes by residues, ``transitions`` nodes by seven."""
    nodes, sizes = len(emissions), np.array([len(p) for p in proteins], np.int64)
    order = np.argsort(-sizes, kind="stable")  # the longest first, so that those that are not over are the first rows
    going = np.searchsorted(-sizes[order], -np.arange(sizes.max(initial=0)), side="left")
    codes = np.full((len(proteins), len(going)), len(C.HMM_ALPHABET))
    for k, own in enumerate(order.tolist()):
        codes[k, : sizes[own]] = _CODE[np.frombuffer(proteins[own].encode("latin-1", "replace"), np.uint8)]
    table = np.concatenate([emissions, np.zeros((nodes, 1))], axis=1).T.copy()  # an unknown residue says nothing
    entry, t = -np.log2(nodes), transitions
    mm, im, dm, md = (t[:-1, k].copy() for k in (MM, IM, DM, MD))
    mi, ii = t[:, MI].copy(), t[:, II].copy()
    along = np.concatenate([[0.0], np.cumsum(np.maximum(t[:, DD], FAR))])[1:-1]  # deletions up to each node
    match, insert, delete, other, part = (np.full((len(proteins), nodes), FAR) for _ in range(5))
    best, place = np.full(len(proteins), FAR), np.zeros(len(proteins), np.int64)
    for i, n in enumerate(going.tolist()):
        old, new, ins, dele, x = match[:n], other[:n], insert[:n], delete[:n], part[:n]
        np.add(old[:, :-1], mm, out=new[:, 1:])
        for state, step in ((ins, im), (dele, dm)):
            np.add(state[:, :-1], step, out=x[:, 1:])
            np.maximum(new[:, 1:], x[:, 1:], out=new[:, 1:])
        new[:, 0] = entry
        np.maximum(new, entry, out=new)
        new += table.take(codes[:n, i], axis=0)
        ins += ii
        np.add(old, mi, out=x)
        np.maximum(x, ins, out=ins)
        # a run of deletions from node j + 1 on begins with a match at j
        np.add(new[:, :-1], md, out=x[:, 1:])
        x[:, 1:] -= along
        np.maximum.accumulate(x[:, 1:], axis=1, out=dele[:, 1:])
        dele[:, 1:] += along
        match, other = other, match
        high = new.max(axis=1)
        better = high > best[:n]
        best[:n][better], place[:n][better] = high[better], i + 1
    back = np.empty(len(order), np.int64)
    back[order] = np.arange(len(order))
    return best[back], place[back]


def candidates(proteins: DataFrame, profiles: DataFrame) -> DataFrame:
    """(q, model): proteins (q, seq) and profiles with at least ``SEEDS`` seeds of the model's consensus on neighbouring diagonals."""
    known = profiles.select(F.col("model").alias("t"), F.col("consensus").alias("letters"))
    references = search.References(search.PROTEIN, SEED, known, search.seeds(known, ["t"], "letters", search.PROTEIN, SEED), 0)
    units = tables.written(search.query_units(proteins, search.PROTEIN).select("q", "letters").withColumn("unit", F.monotonically_increasing_id()), "units")
    found = search.candidates(units, references, search.PROTEIN)
    return found.select("unit", "t").distinct().join(units.select("unit", "q"), "unit").select("q", F.col("t").alias("model")).distinct()


def hmm_search(proteins: DataFrame, profiles: DataFrame, least: float | None = None) -> DataFrame:
    """(q, model, accession, score, last): of proteins (q, seq; each q once) the best path through each profile (as ``parsed`` gives them, each model once) that
    reaches the model's own threshold, or ``least`` bits where that is given or a model has none (then 0)."""
    profiles = tables.written(profiles, "profiles")
    pairs = tables.written(candidates(proteins, profiles), "pairs")
    per = pairs.groupBy("model").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    left = tables.salted_join(pairs, proteins.select(F.col("q").cast("string").alias("q"), "seq"), ["q"])
    left = tables.salted_join(left, per, ["model"]).withColumn("block", F.pmod(F.xxhash64("q"), F.col("blocks")).cast("int")).drop("blocks")
    right = profiles.join(per, "model").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")

    def score(rows: pa.Table, models: pa.Table) -> pa.Table:
        if not rows.num_rows or not models.num_rows:
            return pa.table({k: pa.array([], t) for k, t in (("q", pa.string()), ("model", pa.string()), ("accession", pa.string()), ("score", pa.float64()), ("last", pa.int64()))})
        m = models.to_pylist()[0]
        best, last = viterbi(np.array(m["emissions"]).reshape(-1, 20), np.array(m["transitions"]).reshape(-1, 7), rows.column("seq").to_pylist())
        bar = least if least is not None else m["ga"] if m["ga"] is not None else 0.0
        ok = np.flatnonzero(best >= bar)
        n = len(ok)
        return pa.table({"q": rows.column("q").take(pa.array(ok)).cast(pa.string()), "model": pa.array([m["model"]] * n, pa.string()), "accession": pa.array([m["accession"]] * n, pa.string()), "score": pa.array(best[ok]), "last": pa.array(last[ok])})

    keys = ["model", "block"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(score, "q string, model string, accession string, score double, last long")
