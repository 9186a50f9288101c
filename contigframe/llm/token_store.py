"""A content-addressed store of token ids.

A document's ids are cut where a rolling hash over the last ``WINDOW`` ids meets a mask, so equal passages give equal chunks
wherever they stand. The store has three parts below its folder:

- ``packs/<name>.pack``: magic, item size, then the payloads of unique chunks (little-endian ids) one after the other;
- ``index``: Parquet, one row per unique chunk: digest, pack, offset, ids;
- ``recipes``: Parquet in ascending doc_id, one row per document: part, row, doc_id, digests, n_tokens, root;
- ``manifest``: Parquet, the nodes of a Merkle tree over the recipes: each covers up to ``FAN`` recipes or nodes of a part, further ones
  the parts, and the row of level 0 the whole store; all with documents, tokens and root.

Writing encodes each text once: tasks write the chunks that are new to them to staging packs; the index then names one
place for each digest, and a second pass copies just these to the final packs. Reading works the tree out again from the recipes and
holds it against the manifest, then rebuilds each document from its recipe: every chunk is read from its pack and held against its
digest, all of them against the recipe's root.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from contigframe.llm import files, tokens, util

END = 2
WINDOW = 16
#: A cut where the hash has these bits zero: chunks of 1,024 ids on average; at most ``LONGEST`` ids.
MASK = (1 << 10) - 1
LONGEST = 8192
#: Windows hashed at once, so that what is at work stays in a core's cache.
MARKED = 1 << 14
MAGIC = b"IDPK"
HEADER = 8
FACTOR = np.uint64(0x9E3779B97F4A7C15)
PACK = 32_000_000
#: Children of a node of the manifest's tree: 2 to the power of this.
FAN = 12
#: ``monotonically_increasing_id`` numbers rows within a task by its lower bits.
LOCAL = (1 << 33) - 1
#: Digests a task remembers as written; when full it forgets them, and the index settles what is written twice.
SEEN = 200_000


def marks(ids: np.ndarray) -> np.ndarray:
    """Ends of all windows of ``WINDOW`` ids whose hash meets the mask, ascending: where chunks may end. The hash is the exclusive or of
    the window's items, each turned by its distance from the end, so that of twice as many items comes from two of half as many."""
    found = [np.zeros(0, np.int64)]
    for first in range(0, len(ids) - WINDOW + 1, MARKED):
        with np.errstate(over="ignore"):
            h = (ids[first : first + MARKED + WINDOW - 1].astype(np.uint64) + np.uint64(1)) * FACTOR
            h ^= h >> np.uint64(29)
            k = 1
            while k < WINDOW:
                h, k = h[k:] ^ (h[:-k] << np.uint64(k)) ^ (h[:-k] >> np.uint64(64 - k)), 2 * k
            h = (h * FACTOR) >> np.uint64(40)
        found.append(np.flatnonzero((h & np.uint64(MASK)) == 0) + (first + WINDOW))
    return np.concatenate(found)


def chunk_ends(marked: list[int], n: int) -> list[int]:
    """End positions of the chunks of ``n`` ids with these marks, the last one included; chunks but the last have ``WINDOW`` ids at least."""
    ends, last = [], 0
    for at in marked:
        if at - last < WINDOW:
            continue
        while at - last > LONGEST:
            last += LONGEST
            ends.append(last)
        if at > last:
            ends.append(at)
            last = at
    while n - last > LONGEST:
        last += LONGEST
        ends.append(last)
    if last < n:
        ends.append(n)
    return ends


def cuts(ids: np.ndarray) -> list[int]:
    """End positions of the chunks of one id stream, the last one included. A cut depends on the ``WINDOW`` ids before it."""
    return chunk_ends(marks(ids).tolist(), len(ids))


def digest(payload: bytes) -> bytes:
    return hashlib.blake2b(payload, digest_size=16).digest()


def merkle(leaves: list[bytes]) -> bytes:
    """Root over digests; an odd last one moves up as it is. No leaves: the digest of nothing."""
    level = list(leaves) or [digest(b"")]
    while len(level) > 1:
        pairs = [digest(b"\x01" + level[i] + level[i + 1]) for i in range(0, len(level) - 1, 2)]
        level = pairs + level[len(pairs) * 2 :]
    return level[0]


def write_store(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, end: int = END) -> None:
    """Writes the store of ``docs`` to ``folder``.

    Defined cases: a null or empty text is the id ``end`` alone, with which every document ends. Rows repeated with one id are documents each,
    the shorter first; null ids come first. An empty table gives a store of no documents. Other columns are not read, whatever their
    names.
    """
    spark, path = docs.sparkSession, tokenizer or tokens.default_path()
    staging = f"{folder}/staging"

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, seen, held = tokens.loaded(path), set(), []
        width = "<u2" if tok.tok.get_vocab_size() <= 65_536 and end <= 65_535 else "<u4"
        size = HEADER

        def flush(recipes: list[tuple]) -> pa.RecordBatch:
            nonlocal held, size
            name = uuid.uuid4().hex
            if held:
                files.put(f"{staging}/{name}.pack", [MAGIC, np.array([int(width[2])], "<u4").tobytes(), *held])
            held, size = [], HEADER
            cols = list(zip(*recipes, strict=True)) or [()] * 4
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.list_(pa.binary())), pa.array(cols[2], pa.int64()),
                    pa.array([[dict(digest=d, pack=name, offset=o, ids=n) for d, o, n in new] for new in cols[3]], pa.list_(pa.struct([("digest", pa.binary()), ("pack", pa.string()), ("offset", pa.int64()), ("ids", pa.int32())]))),
                ],
                names=["doc_id", "digests", "n_tokens", "chunks"],
            )

        recipes: list[tuple] = []
        for batch in batches:
            for part in tokens.slices(batch, "text", tokens.TOKEN_SLICE):
                ids, offsets = tokens.with_end(*tok.encode(part.column("text").fill_null("")), end)
                marked, narrow = marks(ids), ids.astype(width)  # of all documents at once; a document's are the windows that lie in it
                low, high = np.searchsorted(marked, offsets[:-1] + WINDOW), np.searchsorted(marked, offsets[1:], "right")
                for doc, a, b, lo, hi in zip(part.column("doc_id").to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist(), low.tolist(), high.tolist(), strict=True):
                    last, digests, new = 0, [], []
                    for e in chunk_ends((marked[lo:hi] - a).tolist() if lo < hi else [], b - a):
                        payload = narrow[a + last : a + e].tobytes()
                        digests.append(digest(payload))
                        if digests[-1] not in seen:
                            if len(seen) >= SEEN:
                                seen.clear()
                            seen.add(digests[-1])
                            new.append((digests[-1], size, e - last))
                            held.append(payload)
                            size += len(payload)
                        last = e
                    recipes.append((doc, digests, b - a, new))
                if size > PACK:
                    yield flush(recipes)
                    recipes = []
        if recipes:
            yield flush(recipes)

    def roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.append_column("root", pa.array([merkle(d) for d in batch.column("digests").to_pylist()], pa.binary()))

    def compact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source = files.Reader()
        for batch in batches:
            rows, parts, at = batch.to_pylist(), [MAGIC, b""], HEADER
            out = []
            for r in rows:
                head = source.read(f"{staging}/{r['pack']}.pack", 0, HEADER) if not parts[1] else parts[1]
                width = int.from_bytes(head[4:8] if len(head) == HEADER else head, "little")
                parts[1] = width.to_bytes(4, "little")
                payload = source.read(f"{staging}/{r['pack']}.pack", r["offset"], r["ids"] * width)
                parts.append(payload)
                out.append((r["digest"], at, r["ids"]))
                at += len(payload)
            if out:
                name = digest(b"".join(d for d, _, _ in out)).hex()  # a task that runs again writes the same file
                files.put(f"{folder}/packs/{name}.pack", parts)
                d, o, n = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(d, pa.binary()), pa.array([name] * len(d)), pa.array(o, pa.int64()), pa.array(n, pa.int32())], names=["digest", "pack", "offset", "ids"])
        source.close()

    schema = "doc_id long, digests array<binary>, n_tokens long, chunks array<struct<digest: binary, pack: string, offset: long, ids: int>>"
    with util.Scratch(spark) as tmp:
        encoded = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(tokens.tidy(encode), schema)
        encoded = tmp.written(encoded.withColumn("tie", F.monotonically_increasing_id()), "encoded")
        places = encoded.select(F.explode("chunks").alias("c")).select("c.*").groupBy("digest").agg(F.min(F.struct("pack", "offset", "ids")).alias("place"))
        unique = tmp.written(places.select("digest", "place.*"), "places")
        packs = max(1, (unique.agg(F.sum("ids")).first()[0] or 0) * 4 // PACK + 1)
        unique = unique.repartition(packs, "pack").sortWithinPartitions("pack", "offset")
        unique.mapInArrow(compact, "digest binary, pack string, offset long, ids int").write.parquet(f"{folder}/index")
        util.remove_folder(spark, staging)
        order = [F.col("doc_id").asc_nulls_first(), F.col("n_tokens"), F.xxhash64("digests"), F.col("tie")]  # so no id is too much for a task
        recipes = encoded.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "digests", "n_tokens")
        recipes = recipes.mapInArrow(roots, "doc_id long, digests array<binary>, n_tokens long, root binary").withColumn("part", F.spark_partition_id())
        util.saved(recipes.withColumn("row", F.monotonically_increasing_id()), f"{folder}/recipes")
        _tree(_recipes(spark, folder), tmp).write.parquet(f"{folder}/manifest")


RECIPES = "doc_id long, digests array<binary>, n_tokens long, root binary, part int, row long"
NODES = "part long, at long, documents long, n_tokens long, root binary"


def _recipes(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(RECIPES).parquet(f"{folder}/recipes")


def _above(nodes: DataFrame) -> DataFrame:
    """The nodes over up to 2 ** ``FAN`` neighbours each."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            joined = [merkle([x["root"] for x in r]) for r in batch.column("r").to_pylist()]
            names = ["part", "at", "documents", "n_tokens"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(joined, pa.binary())], names=[*names, "root"])

    up = nodes.groupBy("part", F.shiftright("at", FAN).alias("up")).agg(F.sum("documents").alias("documents"), F.sum("n_tokens").alias("n_tokens"), F.sort_array(F.collect_list(F.struct("at", "root"))).alias("r"))
    return up.withColumnRenamed("up", "at").mapInArrow(join, NODES)


def _tree(recipes: DataFrame, tmp: util.Scratch) -> DataFrame:
    """(level, part, at, documents, n_tokens, root): the nodes over the recipes of each part, then (part -1) those over the parts, and as
    level 0 the whole store, which is there for a store of no documents too."""
    nodes = recipes.select(F.col("part").cast("long").alias("part"), F.col("row").bitwiseAND(F.lit(LOCAL)).alias("at"), F.lit(1).cast("long").alias("documents"), "n_tokens", "root")
    last = nodes.agg(F.max("at").alias("at"), F.max("part").alias("part")).first()
    found = []

    def climb(nodes: DataFrame, most: int) -> DataFrame:
        while True:
            nodes, most = tmp.written(_above(nodes), "nodes"), most >> FAN
            found.append(nodes.withColumn("level", F.lit(len(found) + 1)))
            if not most:
                return nodes

    if last["at"] is not None:
        nodes = climb(nodes, last["at"])
        nodes = climb(nodes.withColumn("at", F.col("part")).withColumn("part", F.lit(-1).cast("long")), last["part"])
    whole = nodes.agg(F.coalesce(F.sum("documents"), F.lit(0)).alias("documents"), F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("n_tokens"), F.coalesce(F.max("root"), F.lit(digest(b""))).alias("root"))
    out = whole.select(F.lit(0).alias("level"), F.lit(-1).cast("long").alias("part"), F.lit(0).cast("long").alias("at"), "documents", "n_tokens", "root")
    for level in found:
        out = out.unionByName(level)
    return out


def check_recipes(spark: SparkSession, folder: str, tmp: util.Scratch) -> DataFrame:
    """The manifest's tree as the recipes give it; an error unless it is the one that was written."""
    facts, key = ["documents", "n_tokens", "root"], ["level", "part", "at"]
    got = tmp.written(_tree(_recipes(spark, folder), tmp), "tree")
    want = spark.read.schema(got.schema).parquet(f"{folder}/manifest")
    both = got.select(*key, F.struct(*facts).alias("got")).join(want.select(*key, F.struct(*facts).alias("want")), key, "full_outer")
    bad = both.where(~F.col("got").eqNullSafe(F.col("want"))).select(*key).orderBy(*key).limit(5).collect()
    if bad:
        raise ValueError(f"recipes of {folder} don't match the manifest: (level, part, node) {', '.join(str(tuple(r)) for r in bad)}")
    return got


def _placed(spark: SparkSession, folder: str, tmp: util.Scratch) -> DataFrame:
    """The checked recipes with ``start``, from sums over blocks of recipes, over the blocks of a part and over the parts."""
    tree = check_recipes(spark, folder, tmp)
    before = lambda *keys: Window.partitionBy(*[k for k in keys[:-1]]).orderBy(keys[-1]).rowsBetween(Window.unboundedPreceding, -1)
    blocks = tree.where("level = 1").select("part", "at", "n_tokens")
    parts = blocks.groupBy("part").agg(F.sum("n_tokens").alias("n")).withColumn("part_start", F.coalesce(F.sum("n").over(before("part")), F.lit(0)))  # a row for each part
    blocks = blocks.withColumn("in_part", F.coalesce(F.sum("n_tokens").over(before("part", "at")), F.lit(0))).join(parts, "part")
    blocks = blocks.select(F.col("part").cast("int").alias("part"), F.col("at").alias("block"), (F.col("part_start") + F.col("in_part")).alias("block_start"))
    recipes = _recipes(spark, folder).withColumn("block", F.shiftright(F.col("row").bitwiseAND(F.lit(LOCAL)), FAN))
    inside = F.coalesce(F.sum("n_tokens").over(before("part", "block", "row")), F.lit(0))
    return recipes.withColumn("in_block", inside).join(blocks, ["part", "block"]).withColumn("start", F.col("block_start") + F.col("in_block")).drop("in_block", "block_start")


def _rebuilt(spark: SparkSession, folder: str, tmp: util.Scratch, give: Callable[[np.ndarray], object], kind: pa.DataType) -> DataFrame:
    """doc_id, start, n_tokens and what ``give`` makes of the ids of each document, rebuilt from its recipe. Chunks that lie one after the
    other are read at once; a chunk that isn't its digest's or a document that isn't its root's is an error."""

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source, widths = files.Reader(), {}
        for batch in batches:
            out = []
            for doc, n, root, chunks in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "n_tokens", "root", "chunks")), strict=True):
                own, k, chunks = [], 0, chunks or []
                while k < len(chunks):
                    first, last, end = chunks[k], k, 0
                    uri = f"{folder}/packs/{first['pack']}.pack"
                    if uri not in widths:
                        if len(widths) > 10_000:
                            widths.clear()
                        head = source.read(uri, 0, HEADER)
                        if head[:4] != MAGIC:
                            raise ValueError(f"{uri} is not a pack")
                        widths[uri] = int.from_bytes(head[4:], "little")
                    width = widths[uri]
                    while last < len(chunks) and chunks[last]["pack"] == first["pack"] and chunks[last]["offset"] == first["offset"] + end:
                        end += chunks[last]["ids"] * width
                        last += 1
                    data, at = source.read(uri, first["offset"], end), 0
                    for c in chunks[k:last]:
                        if digest(data[at : at + c["ids"] * width]) != c["digest"]:
                            raise ValueError(f"chunk {c['digest'].hex()} in {uri} is damaged")
                        at += c["ids"] * width
                    own.append(np.frombuffer(data, f"<u{width}").astype("<u4"))
                    k = last
                ids = np.concatenate(own) if own else np.zeros(0, "<u4")
                if merkle([c["digest"] for c in chunks]) != root or len(ids) != n:
                    raise ValueError(f"the recipe of document {doc} doesn't match its root")
                out.append(give(ids))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "start", "n_tokens")), pa.array(out, kind)], names=["doc_id", "start", "n_tokens", "given"])
        source.close()

    placed = tmp.written(_placed(spark, folder, tmp), "placed")
    index = spark.read.schema("digest binary, pack string, offset long, ids int").parquet(f"{folder}/index")
    uses = tmp.written(placed.select("part", "row", F.posexplode("digests").alias("pos", "digest")), "uses")
    found = util.join_heavy(uses, index, ["digest"])
    lists = found.groupBy("part", "row").agg(F.sort_array(F.collect_list(F.struct("pos", "pack", "offset", "ids", "digest"))).alias("chunks"))
    rows = placed.select("part", "row", "block", "doc_id", "n_tokens", "root", "start").join(lists, ["part", "row"], "left")
    first = F.get("chunks", F.lit(0))
    tasks = max(util.salt_count(spark), (placed.agg(F.sum("n_tokens")).first()[0] or 0) * 4 // PACK + 1)
    rows = rows.repartition(tasks, "part", "block", F.pmod("row", F.lit(16))).sortWithinPartitions(first["pack"], first["offset"])
    spark_kind = {pa.int64(): T.LongType(), pa.list_(pa.int64()): T.ArrayType(T.LongType())}[kind]
    schema = T.StructType([T.StructField(c, T.LongType()) for c in ("doc_id", "start", "n_tokens")] + [T.StructField("given", spark_kind)])
    return rows.mapInArrow(tokens.tidy(rebuild), schema)


def read_store(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the ids rebuilt from the store's files. A store of no documents gives
    an empty result; any difference from what was written is an error."""
    with util.Scratch(spark) as tmp:
        return util.written(_rebuilt(spark, folder, tmp, tokens.crc, pa.int64()).withColumnRenamed("given", "ids_crc32"), "store-read")


def document_ids(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, ids): the documents themselves, rebuilt from recipes and packs."""
    with util.Scratch(spark) as tmp:
        return util.written(_rebuilt(spark, folder, tmp, lambda ids: ids.tolist(), pa.list_(pa.int64())).select("doc_id", F.col("given").alias("ids")), "store-ids")


def op6_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = util.new_folder(spark, "token-store")
    write_store(util.documents(spark, sf_dir), folder)
    return read_store(spark, folder)
