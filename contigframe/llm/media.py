"""Media columns: content-addressed payloads in tar shards.

A text's bytes, filled up with spaces to whole rows of ``ROW``, are the samples of an 8-bit grey image, stored as PNG
(lossless). Payloads are named by the SHA-256 of their samples and stored once, in tar shards; a row carries digest, shard,
offset and length. Tasks first stage the images that are new to them; the index then names one place for each digest, and a
second pass turns each staging file into a shard of just those, so no payload is shuffled. Metadata columns come from range reads of the image header alone (33 bytes); features, digests and
checksums from a second read of the whole stored form.
"""

from __future__ import annotations

import hashlib
import struct
import tarfile
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contigframe.llm import files, tokens, util

ROW = 192
LEVEL = 6
SIGNATURE = b"\x89PNG\r\n\x1a\n"
HEADER = 33
#: Bytes of a shard before a task starts its next one.
SHARD = 32_000_000
SEEN = 200_000
#: Bytes of images that a task reads.
WORK = 8_000_000
INDEX = "digest binary, shard string, offset long, length long"
INDEX_NAMES = ["digest", "shard", "offset", "length"]
TAIL = 16


def samples(text: Column) -> Column:
    """The payload: UTF-8 bytes and spaces up to a positive multiple of ``ROW``."""
    n = F.octet_length(text)
    fill = F.greatest(F.ceil(n / ROW), F.lit(1)).cast("int") * ROW - n
    return F.concat(F.encode(text, "UTF-8"), F.encode(F.repeat(F.lit(" "), fill), "UTF-8"))


def _chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def png(payload: bytes, level: int = LEVEL) -> bytes:
    """An 8-bit grey PNG of ``ROW`` samples a line, unfiltered."""
    lines = np.frombuffer(payload, np.uint8).reshape(-1, ROW)
    raw = np.zeros((len(lines), ROW + 1), np.uint8)
    raw[:, 1:] = lines
    head = struct.pack(">IIBBBBB", ROW, len(lines), 8, 0, 0, 0, 0)
    return SIGNATURE + _chunk(b"IHDR", head) + _chunk(b"IDAT", zlib.compress(raw.tobytes(), level)) + _chunk(b"IEND", b"")


def png_header(head: bytes) -> tuple[int, int, int]:
    """(width, height, bit depth) from the first ``HEADER`` bytes."""
    if head[:8] != SIGNATURE or head[12:16] != b"IHDR":
        raise ValueError("not a PNG header")
    width, height, depth = struct.unpack(">IIB", head[16:25])
    return width, height, depth


def png_samples(stored: bytes) -> bytes:
    """The samples of a PNG written by ``png``; a damaged chunk is an error."""
    at, width, body = 8, png_header(stored)[0], []
    while at < len(stored):
        n, kind = struct.unpack(">I", stored[at : at + 4])[0], stored[at + 4 : at + 8]
        if zlib.crc32(stored[at + 4 : at + 8 + n]) != struct.unpack(">I", stored[at + 8 + n : at + 12 + n])[0]:
            raise ValueError("damaged PNG chunk")
        if kind == b"IDAT":
            body.append(stored[at + 8 : at + 8 + n])
        at += 12 + n
    lines = np.frombuffer(zlib.decompress(b"".join(body)), np.uint8).reshape(-1, width + 1)
    return lines[:, 1:].tobytes()


def feature(payload: bytes) -> str:
    """Mean, deviation and difference energy of the samples, and the shares of eight value bands in thousandths."""
    x = np.frombuffer(payload, np.uint8)
    n, total, squares = len(x), int(x.sum(dtype=np.int64)), int((x.astype(np.uint32) ** 2).sum(dtype=np.int64))
    step = int(np.abs(np.diff(x.astype(np.int16))).sum(dtype=np.int64)) // n
    bands = np.bincount(x >> 5, minlength=8) * 1000 // n
    return f"{total // n}:{max(squares // n - (total // n) ** 2, 0)}:{step}:" + ",".join(map(str, bands.tolist()))


def _tar_header(name: str, size: int) -> bytes:
    info = tarfile.TarInfo(name)
    info.size = size
    return info.tobuf(tarfile.USTAR_FORMAT)


def write_shards(docs: DataFrame, folder: str, text_col: str = "text") -> DataFrame:
    """Stores each different text of ``docs`` once below ``folder``; the index as a table there: digest, shard, offset, length."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, held, rows, size = set(), [], [], 0

        def close() -> pa.RecordBatch:
            nonlocal held, rows, size
            name = uuid.uuid4().hex
            files.put(f"{folder}/staging/{name}.bin", held)
            d, o, n = zip(*rows, strict=True)
            held, rows, size = [], [], 0
            return pa.RecordBatch.from_arrays([pa.array(d, pa.binary()), pa.array([name] * len(d)), pa.array(o, pa.int64()), pa.array(n, pa.int64())], names=INDEX_NAMES)

        for batch in batches:
            for part in tokens.slices(batch, "payload"):
                for p in part.column("payload").to_pylist():
                    d = hashlib.sha256(p).digest()
                    if d in seen:
                        continue
                    if len(seen) >= SEEN:
                        seen.clear()
                    seen.add(d)
                    image = png(p)
                    rows.append((d, size, len(image)))
                    held.append(image)
                    size += len(image)
                if size > SHARD:
                    yield close()
        if rows:
            yield close()

    def shard(name: str, rows: list[tuple]) -> pa.RecordBatch:
        """One tar shard from one staging file, which then goes. If a task runs again, its shard is there already."""
        uri, staged, source, parts, at, offsets = f"{folder}/shards/{name}.tar", f"{folder}/staging/{name}.bin", files.Reader(), [], 0, []
        done = files.exists(uri)
        for d, offset, length in rows:
            offsets.append(at + 512)
            if not done:
                try:
                    parts += [_tar_header(f"{d.hex()}.png", length), source.read(staged, offset, length), b"\0" * (-length % 512)]
                except FileNotFoundError:
                    if not files.exists(uri):
                        raise
                    done = True
            at += 512 + length + -length % 512
        source.close()
        if not done:
            files.put(uri, [*parts, b"\0" * 1024])
        files.drop(staged)
        d, _, n = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(d, pa.binary()), pa.array([name] * len(d)), pa.array(offsets, pa.int64()), pa.array(n, pa.int64())], names=INDEX_NAMES)

    def compact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, rows = "", []
        for batch in batches:
            for d, s, o, n in zip(*(batch.column(c).to_pylist() for c in INDEX_NAMES), strict=True):
                if s != name and rows:
                    yield shard(name, rows)
                    rows = []
                name = s
                rows.append((d, o, n))
        if rows:
            yield shard(name, rows)

    payloads = docs.select(samples(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("payload"))
    with util.Scratch(docs.sparkSession) as tmp:
        staged = tmp.written(payloads.mapInArrow(encode, INDEX), "staged")
        places = staged.groupBy("digest").agg(F.min(F.struct("shard", "offset", "length")).alias("place")).select("digest", "place.*")
        places = places.repartition(_tasks(staged), "shard").sortWithinPartitions("shard", "offset").select(*INDEX_NAMES)
        index = util.saved(places.mapInArrow(compact, INDEX), f"{folder}/index")
    util.remove_folder(docs.sparkSession, f"{folder}/staging")
    return index


def _tasks(index: DataFrame) -> int:
    """Tasks to read the images of ``index`` with, by their bytes: those of the index itself say nothing of them."""
    return max(1, (index.agg(F.sum("length")).first()[0] or 0) // WORK + 1)


def _dealt(index: DataFrame) -> DataFrame:
    """``index`` dealt to tasks by stretches of its shards, in order of place."""
    return index.repartition(_tasks(index), "shard", F.floor(F.col("offset") / WORK)).sortWithinPartitions("shard", "offset")


def media_metadata(index: DataFrame, folder: str) -> DataFrame:
    """digest, width, height, depth of every payload, from range reads of the headers alone."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source = files.Reader()
        for batch in batches:
            got = [png_header(source.read(f"{folder}/shards/{s}.tar", o, HEADER)) for s, o in zip(batch.column("shard").to_pylist(), batch.column("offset").to_pylist(), strict=True)]
            w, h, d = zip(*got, strict=True) if got else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column("digest"), pa.array(w, pa.int32()), pa.array(h, pa.int64()), pa.array(d, pa.int32())], names=["digest", "width", "height", "depth"])
        source.close()

    return _dealt(index).mapInArrow(read, "digest binary, width int, height long, depth int")


MEDIA = "digest binary, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, shard string, offset long, width int, height long"


def media_features(index: DataFrame, folder: str) -> DataFrame:
    """What the stored bytes say, read back from the shards; a payload that isn't its digest's is an error."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source = files.Reader()
        for batch in batches:
            out = []
            for d, shard, offset, length in zip(*(batch.column(c).to_pylist() for c in ("digest", "shard", "offset", "length")), strict=True):
                uri = f"{folder}/shards/{shard}.tar"
                width, height, _ = png_header(source.read(uri, offset, HEADER))
                stored = source.read(uri, offset, length)
                payload = png_samples(stored)
                if hashlib.sha256(payload).digest() != d or width * height != len(payload):
                    raise ValueError(f"payload {d.hex()} in {uri} is damaged")
                out.append((d, len(payload), d.hex(), zlib.crc32(payload[-TAIL:]), length, hashlib.sha256(stored).hexdigest(), feature(payload), shard, offset, width, height))
            cols = list(zip(*out, strict=True)) if out else [()] * 11
            kinds = [pa.binary(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=[x.split()[0] for x in MEDIA.split(", ")])
        source.close()

    return _dealt(index).mapInArrow(read, MEDIA)


def media_columns(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256,
    feature, shard, offset, width, height.

    Defined cases: null text is empty, and an empty text is one row of spaces. Equal texts share one stored payload, as do
    texts that differ in closing spaces only and fill up alike. Repeated rows stay rows; an empty table gives an empty result. Other
    columns are not read, whatever their names.
    """
    index = write_shards(docs, folder, text_col)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    with util.Scratch(docs.sparkSession) as tmp:
        found = tmp.written(media_features(index, folder), "features")
        rows = tmp.written(docs.select(F.col(id_col).alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), F.unhex(F.sha2(samples(text), 256)).alias("digest")), "rows")
        out = util.join_heavy(rows, found, ["digest"])
        return util.written(out.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "shard", "offset", "width", "height"), "media-columns")


def op8_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_columns(util.documents(spark, sf_dir), util.new_folder(spark, "media"))
