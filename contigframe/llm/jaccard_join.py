"""Near duplicates by a chosen-path Jaccard self-join over word n-grams.

A text's set holds the hashes of its five-word shingles. Texts with the same set are one class from the start. Each set is
embedded as ``PLACES`` pairs (place, value): the value is that of the set's smallest hash in the place's share of the hash
space (empty shares borrow from others), so two sets agree at a place with their Jaccard similarity as probability.

Chosen path: a node of the recursion samples ``BRANCH`` places and hands each set to the children (place, value). Nodes of at
most ``BUCKET`` sets are compared by brute force over one byte of each value; larger ones go on to be split. A node that keeps
``DENSE`` of its parent's sets holds near copies, which no split parts: it is compared at once, and so is what is left after
``DEPTH`` splits, in tiles of bounded size. All is repeated in ``runs_for`` independent runs, as many as the
target recall needs. Sets that seem similar form candidate components; in these every pair is then compared exactly, again
in tiles of bounded size. Neither step emits pairs: a tile gives for each set its links and the smallest set it hangs
together with, so the rows made stay in proportion to the sets.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contigframe.llm import tokens, util
from contigframe.llm.components import components

WORDS = 5
THRESHOLD = 0.8
PLACES = 128
BRANCH = 2
BUCKET = 100
DEPTH = 4
RECALL = 0.9995
DENSE = 0.5
#: Sets and shingles of a tile's side when sets are compared, and sets when embeddings are.
TILE_SETS, TILE_SHINGLES, TILE_BRIEF = 500, 1_000_000, 2_000
_ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))


def scrambled(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(31))) * _ODD[0]
        x = (x ^ (x >> np.uint64(29))) * _ODD[1]
        return x ^ (x >> np.uint64(32))


#: Where an empty place borrows from, in turn.
_BORROW = np.argsort(scrambled(np.arange(PLACES * PLACES, dtype=np.uint64).reshape(PLACES, PLACES)), axis=1)


def runs_for(recall: float, similarity: float = THRESHOLD, branch: int = BRANCH, depth: int = DEPTH) -> int:
    """Runs until a pair at the threshold is missed with at most 1 - recall. The similarity seen in an embedding may fall
    three deviations short; a path survives a level if one of the branches agrees and goes on."""
    seen = similarity - 3 * math.sqrt(similarity * (1 - similarity) / PLACES)
    alive = 1.0
    for _ in range(depth):
        alive = 1 - (1 - seen * alive) ** branch
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - alive)))


def least_seen(similarity: float = THRESHOLD) -> float:
    """Agreement of embeddings from which a pair is a candidate: four deviations below the threshold."""
    return similarity - 4 * math.sqrt(similarity * (1 - similarity) / PLACES)


class Shingler:
    """Sets of shingle hashes of whole texts."""

    def sets(self, texts: pa.Array) -> list[np.ndarray]:
        """Sorted different shingle hashes of each text. Words are lower-cased, without punctuation around them; a text of fewer
        than five words is one shingle of all, one of none the empty set."""
        lists = pc.utf8_split_whitespace(pc.utf8_lower(texts.cast(pa.large_string())))
        bounds = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        coded = lists.flatten().dictionary_encode()
        bare = pc.replace_substring_regex(coded.dictionary, r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", "")
        words = bare.to_numpy(zero_copy_only=False).tolist()
        hashes = np.fromiter((xxhash.xxh64_intdigest(w) | 1 if w else 0 for w in words), np.uint64, len(words))
        h = hashes[coded.indices.to_numpy()]
        full = h != 0
        bounds = np.concatenate([[0], np.cumsum(full)])[bounds]
        h = h[full]
        with np.errstate(over="ignore"):
            n = len(h)
            roll = np.zeros(n, np.uint64)
            for k in range(WORDS):
                roll[: max(n - k, 0)] = roll[: max(n - k, 0)] * _ODD[2] + h[k:]
            roll = scrambled(roll)
        out = []
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            if b - a >= WORDS:
                s = np.sort(roll[a : b - WORDS + 1])
                out.append(s[np.concatenate([[True], s[1:] != s[:-1]])])
            elif b > a:
                out.append(np.array([xxhash.xxh64_intdigest(h[a:b].tobytes())], np.uint64))
            else:
                out.append(np.zeros(0, np.uint64))
        return out


def embedding(s: np.ndarray) -> np.ndarray:
    """``PLACES`` 32-bit values of a sorted set that isn't empty."""
    place = (s >> np.uint64(57)).astype(np.int64)
    first = np.concatenate([[True], place[1:] != place[:-1]])
    have = np.zeros(PLACES, bool)
    have[place[first]] = True
    value = np.zeros(PLACES, np.uint64)
    value[place[first]] = s[first]
    if not have.all():
        empty = np.flatnonzero(~have)
        value[empty] = value[_BORROW[empty, have[_BORROW[empty]].argmax(axis=1)]]
    return (scrambled(value) >> np.uint64(32)).astype(np.uint32)


#: What names a row's text next to its id: ids may be null or repeated.
MARK = "mark"
#: Bits for each candidate in the map of candidates' marks that is broadcast, and the most that it has in all (128 MB).
MARK_BITS, MOST_BITS = 32, 1 << 30


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias(MARK), text.alias("text"))


def _digest(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def describe(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, mark, digest of the set, its size, its embedding, one byte of each value) of every row."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in batches:
            for part in tokens.slices(batch, "text"):
                sets = shingler.sets(part.column("text"))
                places = [embedding(s) if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"), part.column(MARK), pa.array([_digest(s) for s in sets], pa.binary()), pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([None if p is None else p.tobytes() for p in places], pa.binary()), pa.array([None if p is None else p.astype(np.uint8).tobytes() for p in places], pa.binary()),
                    ],
                    names=["doc_id", MARK, "digest", "size", "places", "brief"],
                )

    return _texts(docs, id_col, text_col).mapInArrow(tokens.tidy(work), f"doc_id long, {MARK} long, digest binary, size long, places binary, brief binary")


def _children(keys: np.ndarray, places: np.ndarray) -> Iterator[np.ndarray]:
    """For each branch the child's key of each row: a place drawn by the node's key, and the set's value there."""
    for k in range(BRANCH):
        with np.errstate(over="ignore"):
            draw = scrambled(keys * _ODD[1] + np.uint64(k + 1))
            at = draw >> np.uint64(57)
            yield scrambled(draw ^ (places[np.arange(len(keys)), at.astype(np.int64)].astype(np.uint64) * _ODD[2] + at))


def _matrix(column: pa.Array, kind: type = np.uint32) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, PLACES)


def _split(nodes: DataFrame, seeds: list[int] | None = None) -> DataFrame:
    """(key, rep, up) rows of the children of all nodes, with the size of the node above. ``seeds``: the roots of the runs, for rows without a key."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            places = _matrix(batch.column("places"))
            starts = [np.full(len(places), s, np.uint64) for s in seeds] if seeds else [batch.column("key").to_numpy().view(np.uint64)]
            for keys in starts:
                for child in _children(keys, places):
                    yield pa.RecordBatch.from_arrays([pa.array(child.view(np.int64)), batch.column("rep"), batch.column("n")], names=["key", "rep", "up"])

    return nodes.mapInArrow(work, "key long, rep long, up long")


def _hang_together(near: np.ndarray) -> np.ndarray:
    """For each row of a symmetric matrix of links, the first row it hangs together with."""
    n = len(near)
    label = np.arange(n)
    todo = near.any(axis=1)
    for s in range(n):
        if label[s] != s or not todo[s]:
            continue
        front = np.zeros(n, bool)
        front[s] = True
        reached = front.copy()
        while front.any():
            front = near[front].any(axis=0) & ~reached
            reached |= front
        label[reached] = s
    return label


def _groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Runs of rows with the same key, from sorted batches."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        k = batch.column(key).to_numpy()
        if not len(k):
            continue
        cut = [0, *(np.flatnonzero(k[1:] != k[:-1]) + 1).tolist(), len(k)]
        for a, b in zip(cut[:-1], cut[1:], strict=True):
            if last is not None and k[a] != last:
                yield pa.Table.from_batches(held)
                held = []
            last = k[a]
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def in_tiles(rows: DataFrame, group: str, weight: str, sets: str, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str, most: int = TILE_SETS) -> DataFrame:
    """Runs ``work`` over tiles of the groups of ``rows``. A group of many sets or much weight (both are given on each row) is cut
    into blocks by a hash of ``rep``, and each pair of blocks is a tile. Rows get ``tile``, ``side`` (0, 1) and ``whole`` (a tile of one block)."""
    blocks = F.greatest(F.ceil(F.col(sets) / most), F.ceil(F.col(weight) / TILE_SHINGLES), F.lit(1)).cast("int")
    cut = rows.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    low, high = F.least("block", "other"), F.greatest("block", "other")
    tiles = cut.withColumns({"tile": F.xxhash64(F.col(group), low, high), "side": (F.col("block") == high).cast("int"), "whole": F.col("block") == F.col("other")})
    tiles = tiles.withColumn("whole", low == high).drop("blocks", "block", "other", weight, sets, group)
    return tiles.repartition("tile").sortWithinPartitions("tile", "rep").mapInArrow(tokens.tidy(work), schema)


def _candidate_edges(leaves: DataFrame, similarity: float) -> DataFrame:
    """(a, b): sets whose embeddings agree enough, each with the first it hangs together with in its tile."""
    least = least_seen(similarity) * PLACES

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _groups(batches, "tile"):
            reps, places = t.column("rep").to_numpy(), _matrix(t.column("brief").combine_chunks(), np.uint8)
            n = len(reps)
            if n < 2:
                continue
            near = np.zeros((n, n), bool)
            for i in range(n - 1):
                near[i, i + 1 :] = np.count_nonzero(places[i + 1 :] == places[i], axis=1) >= least
            near |= near.T
            label = _hang_together(near)
            linked = np.flatnonzero(label != np.arange(n))
            if len(linked):
                yield pa.RecordBatch.from_arrays([pa.array(reps[linked]), pa.array(reps[label[linked]])], names=["a", "b"])

    return in_tiles(leaves, "key", "weight", "n", work, "a long, b long", TILE_BRIEF)


def candidates(reps: DataFrame, similarity: float, recall: float, tmp: util.Scratch) -> DataFrame:
    """(a, b) edges between sets (rep, places) that the chosen paths bring together and that look similar."""
    seeds = scrambled(np.arange(1, runs_for(recall, similarity) + 1, dtype=np.uint64) * np.uint64(1_000_003)).tolist()
    reps = reps.select("rep", "places", "brief")
    found, nodes = [], tmp.written(_split(reps.select("rep", "places", F.lit(0).cast("long").alias("n")), seeds), "paths")
    for depth in range(DEPTH):
        counts = tmp.written(nodes.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "counts")
        heavy = counts.where(F.col("n") * util.HEAVY > nodes.count()).select(F.xxhash64("key").alias("h"))  # fewer than HEAVY
        # dealt by key at any size, so that what is moved grows in proportion
        nodes = tmp.written(util.join_heavy(nodes, counts.hint("merge"), ["key"], heavy=[r["h"] for r in heavy.collect()]), "buckets")
        done = (F.col("n") <= BUCKET) | ((F.col("up") > 0) & (F.col("n") >= DENSE * F.col("up"))) | F.lit(depth == DEPTH - 1)
        leaves = nodes.where(done).select("key", "rep", "n").join(reps.select("rep", "brief"), "rep").withColumn("weight", F.lit(0).cast("long"))
        found.append(tmp.written(_candidate_edges(leaves, similarity), "candidates"))
        big = nodes.where(~done)
        if big.limit(1).count() == 0:
            break
        nodes = tmp.written(_split(big.join(reps.select("rep", "places"), "rep").select("key", "rep", "places", "n")), "paths")
    edges = found[0]
    for more in found[1:]:
        edges = edges.unionByName(more)
    return edges.distinct()


def _verified(docs: DataFrame, members: DataFrame, id_col: str, text_col: str, similarity: float) -> DataFrame:
    """(rep, root, links): exact comparison of all pairs of each candidate component, in tiles. ``members`` names a row for each set by its
    id (twice, as null ids are ids) and mark; a row that has them but another set isn't taken."""

    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, names = Shingler(), ["rep", "component", "n", "weight"]
        for batch in batches:
            for part in tokens.slices(batch, "text"):
                sets = shingler.sets(part.column("text"))
                own = pa.array([_digest(s) == d for s, d in zip(sets, part.column("digest").to_pylist(), strict=True)], pa.bool_())
                rows = pa.RecordBatch.from_arrays([*(part.column(c) for c in names), pa.array([s.tobytes() for s in sets], pa.large_binary()).cast(pa.binary())], names=[*names, "shingles"])
                yield rows.filter(own)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _groups(batches, "tile"):
            reps, first = np.unique(t.column("rep").to_numpy(), return_index=True)  # a repeated row is the same set
            if len(reps) < 2:
                continue
            sets = [np.frombuffer(t.column("shingles")[i].as_py(), np.uint64) for i in first.tolist()]
            side, whole = t.column("side").to_numpy()[first], bool(t.column("whole")[0].as_py())
            near = similar(sets, similarity)
            if not whole:
                near &= side[:, None] != side[None, :]
            label = _hang_together(near)
            yield pa.RecordBatch.from_arrays([pa.array(reps), pa.array(reps[label]), pa.array(near.sum(axis=1).astype(np.int64))], names=["rep", "root", "links"])

    named = members.select(F.col("row.doc_id").alias("__id"), F.col(f"row.{MARK}").alias(MARK), "digest", "rep", "component", "n", "weight")
    # texts of which nothing is a candidate stay where they are: their mark's bit isn't set
    texts = _marked(_texts(docs, id_col, text_col), named)
    named = named.hint("merge")  # dealt by key at any size, so that what is moved grows in proportion
    text = texts.join(named, (texts[MARK] == named[MARK]) & F.col("doc_id").eqNullSafe(F.col("__id")))
    sets = text.select("rep", "component", "n", "weight", "digest", "text").mapInArrow(tokens.tidy(shingles), "rep long, component long, n long, weight long, shingles binary")
    return in_tiles(sets, "component", "weight", "n", compare, "rep long, root long, links long")


def map_bits(candidates: int) -> int:
    """Bits of the map, a power of two: the share of other texts that it lets pass is the same however many candidates there are, up to ``MOST_BITS``."""
    return min(max(1 << 15, 1 << (MARK_BITS * max(candidates, 1) - 1).bit_length()), MOST_BITS)


def _marked(texts: DataFrame, named: DataFrame) -> DataFrame:
    """Rows of ``texts`` whose mark's bit is set in a map with a bit for each mark of ``named`` (a written table's rows). The map is built where the
    rows are and broadcast in pieces of 4 KB, its size known before."""
    bits = map_bits(named.count())
    place = F.pmod(F.col(MARK), F.lit(bits))
    pieces = named.select(place.alias("place")).groupBy(F.bitmap_bucket_number("place").alias("__piece")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("__bits"))
    # pieces of the map have 32,768 bits each, from place 1 of the first one on; place 0 has one of its own
    own = texts.withColumns({"__piece": F.bitmap_bucket_number(place), "__at": F.bitmap_bit_position(place)})
    byte = F.conv(F.hex(F.substring("__bits", (F.floor(F.col("__at") / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    is_set = F.expr("shiftright(__byte, cast(__at % 8 as int)) & 1") == 1
    return own.join(F.broadcast(pieces), "__piece").withColumn("__byte", byte).where(is_set).select(*texts.columns)


def similar(sets: list[np.ndarray], similarity: float) -> np.ndarray:
    """Which pairs reach the Jaccard similarity, exactly; the diagonal is false."""
    n = len(sets)
    size = np.array([len(s) for s in sets], np.int64)
    owner = np.repeat(np.arange(n), size)
    flat = np.concatenate(sets) if n else np.zeros(0, np.uint64)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    new = np.concatenate([[True], flat[1:] != flat[:-1]]) if len(flat) else np.zeros(0, bool)
    column = np.cumsum(new) - 1
    shared = (np.bincount(column) > 1)[column] if len(flat) else new  # a shingle of one set alone is in no intersection
    owner, column = owner[shared], column[shared]
    column = np.unique(column, return_inverse=True)[1] if len(column) else column
    both = np.zeros((n, n), np.float32)
    wide = max(1, 8_000_000 // max(n, 1))
    for a in range(0, int(column.max()) + 1 if len(column) else 0, wide):
        at = (column >= a) & (column < a + wide)
        m = np.zeros((n, min(wide, int(column.max()) + 1 - a)), np.float32)
        m[owner[at], column[at] - a] = 1
        both += m @ m.T
    near = both >= (similarity - 1e-9) * (size[:, None] + size[None, :] - both)
    near &= both > 0
    np.fill_diagonal(near, False)
    return near


def _classes(docs: DataFrame, id_col: str, text_col: str, similarity: float, recall: float, tmp: util.Scratch) -> tuple[DataFrame, DataFrame]:
    """(rows, ends): every row with its set's digest, and for each digest its class. Sets are told apart by digest alone and numbered
    (``rep``) when they are written, so ids may be null or repeated."""
    described = tmp.written(describe(docs, id_col, text_col), "sets")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", MARK))
    classes = described.groupBy("digest").agg(least.alias("row"), F.count("*").alias("class_size"), F.first("size").alias("size"), F.first("places").alias("places"), F.first("brief").alias("brief"))
    classes = tmp.written(classes.withColumn("rep", F.monotonically_increasing_id()), "classes")
    linked = components(candidates(classes.where(F.col("places").isNotNull()), similarity, recall, tmp), tmp)
    sized = tmp.written(linked.join(classes.select(F.col("rep").alias("node"), "size"), "node"), "sized")
    per = sized.groupBy("root").agg(F.count("*").alias("n"), F.sum("size").alias("weight"))
    members = util.join_heavy(sized, per, ["root"]).select(F.col("node").alias("rep"), F.col("root").alias("component"), "n", "weight")
    members = tmp.written(members.join(classes.select("rep", "digest", "row"), "rep"), "members")
    found = tmp.written(_verified(docs, members, id_col, text_col, similarity), "verified")
    roots = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")), tmp)
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    ends = classes.select("digest", "rep", "row", "class_size").join(links, "rep", "left").join(roots.withColumnRenamed("node", "rep"), "rep", "left")
    ends = tmp.written(ends.select("digest", "row", "class_size", F.coalesce("links", F.lit(0)).alias("n_links"), F.coalesce("root", "rep").alias("root")), "ends")
    first = ends.groupBy("root").agg(F.min("row").alias("first"), F.hex(F.min("digest")).alias("class_key"))
    return described, tmp.written(util.join_heavy(ends, first, ["root"]), "named")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """One row per row of ``docs``: doc_id, class_id, text_class, class_size, n_links, size, class_key.

    ``text_class`` is the smallest id among texts with the same set, ``class_size`` their number; ``n_links`` counts the other
    text classes with a Jaccard similarity of at least ``similarity``; ``class_id`` is the smallest id of all texts that links join,
    and ``class_key`` names their class even where ids don't.
    Defined cases: null text is empty; empty texts (no word) share a text class and have no links. Rows are told apart by their
    texts, so different texts under one id, or under null ids, keep links of their own; a null id comes last, so a class or text class
    has a null id only if all its ids are null. Repeated rows stay rows. An empty table gives an empty result. Other columns are not read.
    """
    with util.Scratch(docs.sparkSession) as tmp:
        described, ends = _classes(docs, id_col, text_col, similarity, recall, tmp)
        out = util.join_heavy(described.select("doc_id", "digest", "size"), ends, ["digest"])
        out = out.select("doc_id", F.col("first.doc_id").alias("class_id"), F.col("row.doc_id").alias("text_class"), "class_size", "n_links", "size", "class_key")
        return util.written(out, "near-duplicates")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each class, with the columns of ``docs``: that of the smallest id; of rows repeated with its id and text, one.
    Texts without a word are no duplicates: all their rows stay."""
    spark = docs.sparkSession
    with util.Scratch(spark) as tmp:
        described, ends = _classes(docs, id_col, text_col, THRESHOLD, RECALL, tmp)
        firsts = ends.select("first").distinct().select(F.col("first.doc_id").alias("doc_id"), F.col(f"first.{MARK}").alias(MARK))
        words = described.where("size > 0").select("doc_id", MARK)
        same = lambda a, b: a["doc_id"].eqNullSafe(b["doc_id"]) & (a[MARK] == b[MARK])
        keep = words.alias("w").join(firsts.alias("f"), same({c: F.col(f"w.{c}") for c in ("doc_id", MARK)}, {c: F.col(f"f.{c}") for c in ("doc_id", MARK)}), "left_semi")
        keep = keep.groupBy("doc_id", MARK).agg(F.count("*").alias("times")).unionByName(described.where("size = 0").select("doc_id", MARK).distinct().withColumn("times", F.lit(1).cast("long")))
        keep = util.written(keep.select(F.col("doc_id").alias("__id"), F.col(MARK).alias("__mark"), "times"), "near-kept")
    mark = F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    named = F.col(id_col).eqNullSafe(F.col("__id")) & (mark == F.col("__mark"))
    once = docs.join(keep.where("times = 1"), named, "left_semi")
    again = keep.where("times > 1")
    if not again.limit(1).count():
        return once
    repeated = docs.withColumn("__text", mark).join(again, named, "left_semi").dropDuplicates([id_col, "__text"]).drop("__text")
    return once.unionByName(repeated)


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(util.documents(spark, sf_dir))
