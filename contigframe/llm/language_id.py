"""Language identification by prediction by partial matching.

Each language has a tree of byte contexts up to ``ORDER`` bytes, with counts learnt once and then frozen. A byte costs
-log2 of its probability: in the longest known context, a byte that followed it c times among n has c / (n + q), with q
the number of different bytes that followed; any other byte pays the escape q / (n + q) and is coded in the context one byte
shorter, at last uniformly. Contexts reach back over spaces, to the beginning of the text. The language with the shortest code
is predicted.

A byte and its context are one number, whose costs in all languages are worked out once from the trees and then remembered, so
that a text is coded by looking up its numbers.
"""

from __future__ import annotations

import functools
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contigframe.llm import tokens, util

ORDER = 4
#: Bounds of what is learnt from: texts of a language, and bytes of all languages, shared alike; a language learns from one text at least.
SAMPLE = 300
SAMPLE_BYTES = 16_000_000
#: Texts of so many bytes are learnt from first, then shorter ones; only a language without either learns from its shortest longer one.
WINDOW = (100, 32_768)
UNKNOWN = "und"
#: A text of at least so many letters is foreign if more than this part of them belong to scripts that no language was learnt in, and a script is
#: learnt from this part of the letters on.
JUDGED, FOREIGN, LEARNT = 16, 0.5, 0.01
#: Bits a byte of a text that no learnt language helps to code: plain bytes and a bit for escapes.
PLAIN = 9.0
#: Bytes of costs that a worker remembers.
MEMO_BYTES = 48_000_000
#: Bytes that the arrays over a part of the text may take: about 64 for each byte of text and 4 more for each language.
PART_BYTES = 40_000_000
_ASCII_LETTER, _BEYOND = re.compile("[A-Za-z]"), re.compile(r"[^\x00-\x7f]")
_MULT = np.uint64(0x9E3779B97F4A7C15)


def has_letter(text: str | None) -> bool:
    return bool(text) and (bool(_ASCII_LETTER.search(text)) or any(c.isalpha() for c in text))


@functools.cache
def _script(letter: str) -> str:
    return unicodedata.name(letter, "?").split(" ", 1)[0]


def scripts(text: str) -> Counter[str]:
    """Letters of each script, by the first word of their names."""
    out = Counter({"LATIN": len(_ASCII_LETTER.findall(text))})
    for c, n in Counter(_BEYOND.findall(text)).items():
        if c.isalpha():
            out[_script(c)] += n
    return out


def is_foreign(text: str, known: set[str]) -> bool:
    """Whether most letters are of scripts that aren't ``known``. New words of a known script prove nothing: they may be names, terms or code."""
    found = scripts(text)
    total = sum(found.values())
    return total >= JUDGED and sum(n for k, n in found.items() if k not in known) > FOREIGN * total


def _grams(data: np.ndarray, depth: np.ndarray, order: int) -> np.ndarray:
    """Each byte with the bytes before it as one number: ``depth`` of them, at most ``order`` (up to 6), which the number's top byte tells."""
    wide = np.zeros(len(data) + 8, np.uint8)
    wide[7:-1] = data
    last = np.ndarray((len(data),), ">u8", wide.tobytes(), strides=(1,)).astype(np.uint64)
    reach = np.minimum(depth, order).astype(np.uint64)
    if (reach == order).all():
        return last & np.uint64((1 << 8 * order + 8) - 1) | np.uint64(order + 1) << np.uint64(56)
    return last & ((np.uint64(1) << (np.uint64(8) * reach + np.uint64(8))) - np.uint64(1)) | (reach + np.uint64(1)) << np.uint64(56)


def _shorter(keys: np.ndarray, reach: int) -> np.ndarray:
    """The same bytes in the context of ``reach`` bytes."""
    return keys & np.uint64((1 << 8 * reach + 8) - 1) | np.uint64(reach + 1) << np.uint64(56)


class Table:
    """Numbers to row numbers, which follow the order of arrival: open addressing, looked up and filled by whole arrays."""

    def __init__(self, bits: int = 16):
        self._empty(bits)
        self.order = np.zeros(0, np.uint64)

    def _empty(self, bits: int) -> None:
        self.bits, self.longest = bits, 0
        self.keys, self.rows = np.zeros(1 << bits, np.uint64), np.full(1 << bits, -1, np.int32)

    def __len__(self) -> int:
        return len(self.order)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys * _MULT) >> np.uint64(64 - self.bits)).astype(np.int64)

    def add(self, keys: np.ndarray) -> None:
        """Adds different keys that aren't there yet."""
        base, self.order = len(self.order), np.concatenate([self.order, keys])
        if len(self.order) * 2 > 1 << self.bits:
            self._empty(int(len(self.order) * 4).bit_length())
            base, keys = 0, self.order
        todo, slot, step = np.arange(len(keys)), self._slot(keys), 0
        while len(todo):
            free = np.flatnonzero(self.rows[slot] < 0)
            won = free[np.unique(slot[free], return_index=True)[1]]
            self.rows[slot[won]], self.keys[slot[won]] = base + todo[won], keys[todo[won]]
            rest = np.ones(len(todo), bool)
            rest[won] = False
            todo, slot = todo[rest], (slot[rest] + 1) & ((1 << self.bits) - 1)
            step += 1
        self.longest = max(self.longest, step)

    def find(self, keys: np.ndarray) -> np.ndarray:
        slot = self._slot(keys)
        out = self.rows[slot]
        open_ = np.flatnonzero((self.keys[slot] != keys) & (out >= 0))
        out[open_] = -1
        slot = slot[open_]
        for _ in range(self.longest):
            if not len(open_):
                break
            slot = (slot + 1) & ((1 << self.bits) - 1)
            row, hit = self.rows[slot], self.keys[slot] == keys[open_]
            hit &= row >= 0
            out[open_[hit]] = row[hit]
            go = ~hit & (row >= 0)
            open_, slot = open_[go], slot[go]
        return out


class _Sparse:
    """Rows of (language, value) pairs under sorted numbers."""

    def __init__(self, keys: list[np.ndarray], values: list[np.ndarray]):
        lang = np.repeat(np.arange(len(keys)), [len(k) for k in keys])
        flat = np.concatenate([*keys, np.zeros(0, np.uint64)])
        order = np.argsort(flat, kind="stable")
        flat, self.lang = flat[order], lang[order].astype(np.int32)
        self.value = np.concatenate([*values, np.zeros(0)])[order].astype(np.float32)
        first = np.concatenate([[True], flat[1:] != flat[:-1]]) if len(flat) else np.zeros(0, bool)
        self.keys, self.starts = flat[first], np.append(np.flatnonzero(first), len(flat))

    def entries(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(position in ``keys``, language, value) of all pairs."""
        if not len(self.keys):
            return np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.float32)
        row = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        at = np.flatnonzero(self.keys[row] == keys)
        sizes = self.starts[row[at] + 1] - self.starts[row[at]]
        ends = np.cumsum(sizes)
        pick = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[row[at]] - (ends - sizes), sizes)
        return np.repeat(at, sizes), self.lang[pick], self.value[pick]


class Model:
    """Frozen trees of all languages: for each context the cost of its escape, and for each byte seen in it that byte's cost. Only what
    a language has seen is held for it, so the size is bounded by the bytes learnt from, however many languages there are."""

    def __init__(self, samples: dict[str, list[str]], order: int = ORDER):
        self.order, self.langs = order, sorted(samples)
        self.seen: list[_Sparse] = []
        self.escape: list[_Sparse] = []
        streams = [_stream([t.encode() for t in samples[k]]) for k in self.langs]
        for reach in range(order + 1):
            grams, costs, heads, escapes = [], [], [], []
            for data, depth in streams:
                g, c = np.unique(_grams(data, np.full(len(data), reach), reach)[depth >= reach], return_counts=True)
                h, inverse = np.unique(g >> np.uint64(8), return_inverse=True)
                n, q = np.bincount(inverse, c, len(h)), np.bincount(inverse, minlength=len(h))
                grams.append(g)
                costs.append(-np.log2(c / (n + q)[inverse]))
                heads.append(h)
                escapes.append(-np.log2(q / (n + q)))
            self.seen.append(_Sparse(grams, costs))
            self.escape.append(_Sparse(heads, escapes))
        #: bits per byte of the learnt texts
        self.rate = np.array([_rate(self, data, depth, j) for j, (data, depth) in enumerate(streams)])
        found: Counter[str] = Counter()
        for texts in samples.values():
            for t in texts:
                found.update(scripts(t))
        self.scripts = {k for k, n in found.items() if n >= LEARNT * sum(found.values())}

    def costs(self, keys: np.ndarray) -> np.ndarray:
        """Cost (rows by languages) of each number's byte in its context."""
        out = np.full((len(keys), len(self.langs)), 8, np.float32)
        depth = (keys >> np.uint64(56)).astype(np.int64) - 1
        for reach in range(self.order + 1):
            at = np.flatnonzero(depth >= reach)
            short = _shorter(keys[at], reach)
            row, lang, value = self.escape[reach].entries(short >> np.uint64(8))
            out[at[row], lang] += value
            row, lang, value = self.seen[reach].entries(short)
            out[at[row], lang] = value
        return out


def _stream(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, how many bytes of its text come before each)."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    data = np.frombuffer(b"".join(texts), np.uint8)
    return data, np.arange(len(data)) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _rate(model: Model, data: np.ndarray, depth: np.ndarray, lang: int) -> float:
    keys, counts = np.unique(_grams(data, depth, model.order), return_counts=True)
    bits = sum(float(counts[a : a + 100_000] @ model.costs(keys[a : a + 100_000])[:, lang].astype(float)) for a in range(0, len(keys), 100_000))
    return bits / max(1, len(data))


class Scorer:
    """Code lengths of whole texts, with a memo of costs that is bounded in bytes."""

    def __init__(self, model: Model):
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self.table, self.cost = Table(), np.zeros((0, len(self.model.langs)), np.float32)

    def _rows(self, keys: np.ndarray) -> np.ndarray:
        if self.cost.nbytes + 24 * len(self.table) > MEMO_BYTES:
            self._forget()
        row = self.table.find(keys)
        missing = np.flatnonzero(row < 0)
        if len(missing):
            new = np.unique(keys[missing])
            step = max(1, 20_000_000 // (8 * len(self.model.langs)))
            self.cost = np.concatenate([self.cost, *(self.model.costs(new[a : a + step]) for a in range(0, len(new), step))])
            self.table.add(new)
            row[missing] = self.table.find(keys[missing])
        return row

    def bits(self, texts: pa.Array) -> np.ndarray:
        """Code lengths (texts by languages); long texts are looked up part by part."""
        data, bounds = _bytes(texts)
        out = np.zeros((len(texts), len(self.model.langs)))
        step = max(1, min(2_000_000, PART_BYTES // (64 + 4 * len(self.model.langs))))
        for a in range(0, len(data), step):
            end, back = min(a + step, len(data)), max(0, a - self.model.order)
            first, last = np.searchsorted(bounds, [a, end - 1], side="right") - 1
            starts = np.maximum(bounds[first : last + 1], a)
            sizes = np.minimum(bounds[first + 1 : last + 2], end) - starts
            depth = np.arange(a, end) - np.repeat(bounds[first : last + 1], sizes)
            keys = _grams(data[back:end], np.concatenate([np.zeros(a - back, np.int64), depth]), self.model.order)[a - back :]
            row = self._rows(keys)
            some = np.flatnonzero(sizes > 0)
            out[first + some] += np.add.reduceat(self.cost[row], starts[some] - a, axis=0, dtype=float)
        return out


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, offsets of the texts in them); no text is null."""
    raw = texts.cast(pa.large_string())
    offsets = np.frombuffer(raw.buffers()[1], np.int64, len(raw) + 1, 8 * raw.offset) if len(raw) else np.zeros(1, np.int64)
    data = raw.buffers()[2]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if offsets[-1] > offsets[0] else np.zeros(0, np.uint8), offsets - offsets[0]


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE, order: int = ORDER) -> Model:
    """Trees from at most ``sample`` texts of each language, none of them held out, the same at every run.

    Every language with a labelled text that isn't empty is learnt: from texts within ``WINDOW`` bytes, then from shorter ones, and if
    it has neither, from its shortest one. All languages share ``SAMPLE_BYTES``.
    """
    size = F.octet_length(F.col(text_col).cast("string"))
    lang = docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"), size.alias("size"))
    lang = lang.where(~util.held_out("doc_id") & F.col("lang").isNotNull() & (F.col("lang") != UNKNOWN) & (F.col("size") > 0))
    fits, short = F.col("size").between(*WINDOW), F.col("size") < WINDOW[0]
    shortest = F.min(F.struct("size", F.xxhash64("text").alias("h")))
    have = lang.groupBy("lang").agg(F.sum(fits.cast("long")).alias("fits"), F.sum(short.cast("long")).alias("short"), shortest.alias("least")).collect()  # a row for each language
    if not have:
        return Model({}, order)
    rates = [(r["lang"], min(1.0, 2.0 * sample / max(1, r["fits"])), min(1.0, 2.0 * sample / max(1, r["short"])) if r["fits"] < sample else 0.0, r["least"]["h"] if not r["fits"] + r["short"] else None) for r in have]
    rates = docs.sparkSession.createDataFrame(rates, "lang string, fit_rate double, short_rate double, least long")
    draw = F.pmod(util.mix(F.col("doc_id"), 77), F.lit(1 << 40)) / float(1 << 40)
    rows = lang.join(F.broadcast(rates), "lang").withColumn("u", draw)  # as many rows as languages, which the driver holds anyway
    rows = rows.where((fits & (F.col("u") < F.col("fit_rate"))) | (short & (F.col("u") < F.col("short_rate"))) | (F.xxhash64("text") == F.col("least")))
    rows = rows.select("lang", fits.alias("fits"), "u", "doc_id", "text")
    found: dict[str, list[str]] = {}
    used: dict[str, int] = {}
    budget = SAMPLE_BYTES // len(have)
    for r in sorted(rows.toLocalIterator(), key=lambda r: (not r["fits"], r["u"], r["doc_id"] or 0, r["text"])):
        own, size = found.setdefault(r["lang"], []), len(r["text"].encode())
        if not own or (len(own) < sample and used[r["lang"]] + size <= budget):
            own.append(r["text"])
            used[r["lang"]] = used.get(r["lang"], 0) + size
    return Model(found, order)


def _predictions(scorer: Scorer, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(language, score, bits per byte) of each text."""
    langs = scorer.model.langs
    letters = np.fromiter((has_letter(t) for t in texts.to_pylist()), bool, len(texts)) & bool(langs)
    if not letters.any():
        return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
    bits = scorer.bits(texts.fill_null(""))
    best, least = bits.argmin(axis=1), bits.min(axis=1)
    score = np.where(letters, 1 / np.exp2(np.maximum(least[:, None] - bits, -1000)).sum(axis=1), 0.0)
    rate = np.where(letters, least / np.maximum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), 1), 0.0)
    return [langs[b] if ok else UNKNOWN for b, ok in zip(best.tolist(), letters.tolist(), strict=True)], score, rate


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score, bits_per_byte.

    Defined cases: null texts and texts without a letter are ``und`` with score 0, as are all if nothing was learnt. Ties go to
    the first language in order. ``score`` is the posterior of the predicted language under equal priors. Repeated rows are each
    predicted, alike; an empty table gives an empty result. Other columns are not read, whatever their names.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the bytes learnt from
    kept: dict[str, Scorer] = {}

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = kept.setdefault("scorer", Scorer(sent.value))
        for batch in batches:
            for part in tokens.slices(batch, "text"):
                pred, prob, rate = _predictions(scorer, part.column("text"))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(pred), pa.array(prob), pa.array(rate)], names=["doc_id", "lang_pred", "score", "bits_per_byte"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    out = rows.mapInArrow(tokens.tidy(score), "doc_id long, lang_pred string, score double, bits_per_byte double")
    return out.select("doc_id", util.held_out("doc_id").alias("held_out"), "lang_pred", "score", "bits_per_byte")


def identified_documents(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that may be in a known language, with their columns. Nothing is shuffled: rows are dropped where they are read.

    Texts without a letter go, and those that no learnt language codes better than plain bytes and that are mostly written in scripts that no language was
    learnt in. What is written in a known script stays: a long code there tells new words from old ones, not a new language from an old one.
    If nothing was learnt, all with a letter stay. Null texts go; repeated rows are each judged, alike; an empty table gives an empty result.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kept: dict[str, Scorer] = {}

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = kept.setdefault("scorer", Scorer(sent.value))
        for batch in batches:
            for part in tokens.slices(batch, text_col):
                texts = part.column(text_col).to_pylist()
                if not scorer.model.langs:
                    yield part.filter(pa.array([has_letter(t) for t in texts], pa.bool_()))
                    continue
                pred, _, rate = _predictions(scorer, part.column(text_col))
                stays = [p != UNKNOWN and not (r > PLAIN and is_foreign(t, scorer.model.scripts)) for t, p, r in zip(texts, pred, rate.tolist(), strict=True)]
                yield part.filter(pa.array(stays, pa.bool_()))

    return docs.mapInArrow(tokens.tidy(keep), docs.schema)


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = util.documents(spark, sf_dir)
    return identify(docs, learn(docs))
