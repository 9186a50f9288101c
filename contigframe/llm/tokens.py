"""Token ids of whole texts: a memo over space-separated pieces in front of a word tokenizer, exact for any input."""

from __future__ import annotations

import ctypes
import gc
import json
import os
import re
import sys
import zlib
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes that each of the memo's two generations may hold; when the young one is full it becomes the old one.
MEMO_BYTES = 40_000_000
#: Bytes of text that are handled at once in a worker.
SLICE = 6_000_000
#: Texts go to the tokenizer's memo in larger parts, in which more pieces repeat.
TOKEN_SLICE = 8_000_000
#: Beyond these characters, lower case isn't one simple mapping everywhere.
_WIDE = "[^\\x00-\u012f\u0131-\u024f]"
#: What the memo takes for granted of a tokenizer file: white space separates and is dropped, and words, digits and other signs are
#: tokens of their own. Others encode text by text.
_NORMALIZER = ["NFC", ("Replace", r"\s+", " "), "Lowercase"]
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def separable(spec: dict) -> bool:
    """Whether ids of a text are the ids of its pieces between spaces, by the normaliser and the splits that ``spec`` (a tokenizer file) names."""
    steps = (spec.get("normalizer") or {}).get("normalizers", [])
    rules = [(s["type"], s["pattern"].get("Regex"), s["content"]) if s["type"] == "Replace" else s["type"] for s in steps]
    first, *rest = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
    split = (first.get("type"), first.get("pattern", {}).get("Regex"), first.get("behavior"), first.get("invert"))
    return rules == _NORMALIZER and split == ("Split", _SPLIT, "Removed", True) and all(r["type"] == "ByteLevel" and not r["add_prefix_space"] and not r["use_regex"] for r in rest)


def _gathered(pool: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The runs of ``pool`` that begin at ``starts``, one after the other."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if max(total, len(pool)) < 2**31 else np.int64
    return pool[np.arange(total, dtype=kind) + np.repeat((starts - (ends - sizes)).astype(kind), sizes)]


class _Generation:
    """Pieces with their ids, in arrays."""

    def __init__(self):
        self.names = pa.array([], pa.large_string())
        self.starts, self.sizes, self.pool = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def find(self, names: pa.Array) -> np.ndarray:
        """Row of each piece, -1 where it isn't known."""
        return pc.fill_null(pc.index_in(names, value_set=self.names), -1).to_numpy(zero_copy_only=False).copy()

    def add(self, names: pa.Array, ids: np.ndarray, sizes: np.ndarray) -> None:
        self.names = pa.concat_arrays([self.names, names])
        self.starts = np.concatenate([self.starts, len(self.pool) + np.cumsum(sizes) - sizes])
        self.sizes, self.pool = np.concatenate([self.sizes, sizes]), np.concatenate([self.pool, ids])

    def bytes(self) -> int:
        return self.names.nbytes + self.starts.nbytes + self.sizes.nbytes + self.pool.nbytes


class MemoTokenizer:
    """``encode`` equals the tokenizer's own ids, text by text.

    A ``separable`` tokenizer lower-cases, drops white space and never looks across it, so ids of a text are the ids of its pieces
    between spaces, one after the other. Before the split, line ends become spaces, and where the text has simple letters only, it
    is lower-cased and a full stop or comma between a letter or digit and a space is set apart, as the tokenizer does. Any other
    tokenizer encodes whole texts.
    """

    def __init__(self, path: str, memo: int | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        with open(path, encoding="utf-8") as f:
            self.memoised = separable(json.load(f))
        special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.plain = "|".join([_WIDE, *(re.escape(s) for s in special)])
        self.memo, self.young, self.old = memo, _Generation(), _Generation()

    def _plain(self, names: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all strings, how many each has) from the tokenizer itself."""
        flat, sizes = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for at in range(0, len(names), 20_000):
            part = names.slice(at, 20_000).to_numpy(zero_copy_only=False).tolist()
            ids = [e.ids for e in self.tok.encode_batch_fast(part, add_special_tokens=False)]
            sizes.append(np.fromiter(map(len, ids), np.int64, len(ids)))
            flat.append(np.fromiter(chain.from_iterable(ids), np.uint32, int(sizes[-1].sum())))
        return np.concatenate(flat), np.concatenate(sizes)

    def _rows(self, names: pa.Array) -> np.ndarray:
        """Rows of the young generation for these different pieces, which it learns where it has to."""
        if self.young.bytes() > (self.memo or MEMO_BYTES):
            self.young, self.old = _Generation(), self.young
        row = self.young.find(names)
        missing = np.flatnonzero(row < 0)
        if len(missing):
            wanted = names.take(pa.array(missing))
            before = self.old.find(wanted)
            for at in (np.flatnonzero(before >= 0), np.flatnonzero(before < 0)):
                part, base = wanted.take(pa.array(at)), len(self.young.names)
                if len(at) and before[at[0]] >= 0:
                    sizes = self.old.sizes[before[at]]
                    ids = _gathered(self.old.pool, self.old.starts[before[at]], sizes)
                else:
                    ids, sizes = self._plain(part)
                self.young.add(part, ids, sizes)
                row[missing[at]] = base + np.arange(len(at))
        return row

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, offsets of the texts in them)."""
        texts = texts.cast(pa.large_string())
        if not self.memoised:
            ids, n = self._plain(texts)
            return ids, np.concatenate([[0], np.cumsum(n)])
        texts = pc.replace_substring(texts, "\n", " ")
        simple = pc.invert(pc.match_substring_regex(texts, self.plain))
        low = pc.replace_substring_regex(pc.utf8_lower(texts), r"([\p{L}\p{N}])([.,]) ", r"\1 \2 ")
        texts = pc.if_else(simple, low, texts)
        del low
        lists = pc.split_pattern(texts, " ")
        del texts
        bounds = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        coded = lists.flatten().dictionary_encode()
        del lists
        rows = self._rows(coded.dictionary)[coded.indices.to_numpy()]
        del coded
        n = self.young.sizes[rows]
        return _gathered(self.young.pool, self.young.starts[rows], n), np.concatenate([[0], np.cumsum(n)])[bounds]


_LOADED: dict[tuple[str, int | None], MemoTokenizer] = {}


def loaded(path: str, memo: int | None = None) -> MemoTokenizer:
    """One tokenizer for each path, bound of a generation of its memo (``MEMO_BYTES`` if none is given) and worker process."""
    if (path, memo) not in _LOADED:
        _LOADED[path, memo] = MemoTokenizer(path, memo)
    return _LOADED[path, memo]


def trim() -> None:
    """Gives free memory back to the system."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        ctypes.CDLL(None).malloc_trim(0)


def tidy(work: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``work`` that gives memory back when its task ends: workers live on, and each would keep the most it ever had."""

    def run(batches: Iterator) -> Iterator:
        yield from work(batches)
        gc.collect()
        trim()

    return run


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``limit`` bytes of text each; a longer text comes alone."""
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    first, held = 0, 0
    for i, s in enumerate(size):
        if held and held + s > limit:
            yield batch.slice(first, i - first)
            first, held = i, 0
        held += s
    if first < batch.num_rows:
        yield batch.slice(first)


def with_end(ids: np.ndarray, offsets: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Appends the id ``end`` to every text."""
    return np.insert(ids, offsets[1:], np.uint32(end)), offsets + np.arange(len(offsets))


def crc(ids: np.ndarray) -> int:
    """Unsigned CRC-32 over ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(ids, dtype="<u4"))
