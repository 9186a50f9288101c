"""Toxicity by a linear-chain conditional random field.

A text is a row of tokens between white space; a chain ends with a sentence or with the text. Each token is toxic or
not; its emission is a sum of weights of its words and their prefixes, and neighbours are tied by transition weights. Labels
of tokens come from the labelled texts: in a toxic text, a token is toxic whose word or prefix is much more frequent in
toxic than in clean texts. Forward and backward passes give each token's marginal; a text's score is a logistic function of
its largest marginal and of its expected number of toxic tokens, and tokens above one half are reported as spans.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contigframe.llm import tokens, util

#: Bounds of what is learnt from: texts of each label, and their bytes; of texts of any length, one is learnt from at least.
SAMPLE = 1_500
SAMPLE_BYTES = 8_000_000
PREFIXES = (4, 5, 6, 7, 8)
#: A feature marks tokens of toxic texts from this log ratio of shares on, and from this share of the toxic texts on.
MARK_RATIO, MARK_SHARE, MARK_LEAST = 2.0, 0.01, 3
STEPS, RATE, RIDGE = 60, 0.5, 1e-6
#: Bytes of tokens that a worker remembers.
MEMO_BYTES = 16_000_000
#: Up to so many chains at a time are passed through number by number.
FEW = 8
CLIP = 30.0
_WORDS = re.compile(r"[^\W_]+")
SPANS = "array<struct<start: int, end: int>>"


def features(token: str) -> list[str]:
    """Words of a token, whole ("=word") and their prefixes ("4:word")."""
    out = []
    for w in _WORDS.findall(token.lower()):
        out.append("=" + w)
        out += [f"{n}:{w[:n]}" for n in PREFIXES if len(w) >= n]
    return out


def ends(token: str) -> bool:
    return token[-1:] in ".!?"


def split(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(token numbers of all texts, offsets of the texts, the different tokens)."""
    lists = pc.utf8_split_whitespace(texts.cast(pa.large_string()))
    bounds = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    coded = lists.flatten().dictionary_encode()
    return coded.indices.to_numpy(), bounds, coded.dictionary.to_numpy(zero_copy_only=False).tolist()


def chains(bounds: np.ndarray, closing: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, lengths) of the chains of a token stream, the longest first; none crosses a text or a sentence end."""
    n = len(closing)
    first = np.zeros(n + 1, bool)
    first[bounds] = True
    first[1:] |= closing
    first[n] = True
    starts = np.flatnonzero(first)
    sizes = np.diff(starts)
    order = np.argsort(-sizes, kind="stable")
    return starts[:-1][order], sizes[order]


def passes(emission: np.ndarray, starts: np.ndarray, sizes: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log ratios (toxic to not) of the forward messages with emissions, and of the backward messages, at each token.

    ``moves[i, j]`` is the weight of going from i to j. All chains advance together, the longest first; the rests of the last
    ``FEW`` go one after the other.
    """
    ahead, back = np.zeros(len(emission)), np.zeros(len(emission))
    if not len(starts):
        return ahead, back
    t = np.exp(moves)
    together = int(sizes[FEW]) if len(sizes) > FEW else 1  # steps with more than FEW chains
    live = np.searchsorted(-sizes, -np.arange(1, together + 1), side="right")  # chains of more than k tokens
    rests = [(int(a), int(n)) for a, n in zip(starts[:FEW], sizes[:FEW], strict=True) if n > together]
    ahead[starts] = emission[starts]
    for k in range(1, together):
        at = starts[: live[k]] + k
        x = np.exp(np.clip(ahead[at - 1], -CLIP, CLIP))
        ahead[at] = emission[at] + np.log((t[0, 1] + t[1, 1] * x) / (t[0, 0] + t[1, 0] * x))
    (t00, t01), (t10, t11) = t.tolist()
    for a, n in rests:
        message, own, out = float(ahead[a + together - 1]), emission[a + together : a + n].tolist(), []
        for e in own:
            x = math.exp(min(max(message, -CLIP), CLIP))
            message = e + math.log((t01 + t11 * x) / (t00 + t10 * x))
            out.append(message)
        ahead[a + together : a + n] = out
        message, out = 0.0, []
        for e in reversed(own):
            x = math.exp(min(max(e + message, -CLIP), CLIP))
            message = math.log((t10 + t11 * x) / (t00 + t01 * x))
            out.append(message)
        back[a + together - 1 : a + n - 1] = out[::-1]
    for k in range(together - 2, -1, -1):
        at = starts[: live[k + 1]] + k
        x = np.exp(np.clip(emission[at + 1] + back[at + 1], -CLIP, CLIP))
        back[at] = np.log((t[1, 0] + t[1, 1] * x) / (t[0, 0] + t[0, 1] * x))
    return ahead, back


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -CLIP, CLIP)))


class Model:
    def __init__(self, weights: dict[str, float], bias: float, moves: np.ndarray, document: np.ndarray):
        self.weights, self.bias, self.moves, self.document = weights, bias, moves, document
        self.memo: dict[str, tuple[float, bool]] = {}
        self.held = 0

    def marginals(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str]]:
        """(log odds of each token, offsets of the texts, token numbers, tokens)."""
        at, bounds, names = split(texts)
        if self.held > MEMO_BYTES:
            self.memo.clear()
            self.held = 0
        for w in names:
            if w not in self.memo:
                self.held += 100 + 4 * len(w)
                self.memo[w] = (self.bias + sum(self.weights.get(f, 0.0) for f in set(features(w))), ends(w))
        table = np.array([self.memo[w] for w in names]).reshape(-1, 2)
        emission = table[at, 0]
        ahead, back = passes(emission, *chains(bounds, table[at, 1] > 0), self.moves)
        return ahead + back, bounds, at, names

    def summary(self, odds: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """What the score of each text depends on: one, the largest log odds, and the expected number of toxic tokens."""
        n = len(bounds) - 1
        out = np.zeros((n, 3))
        out[:, 0], out[:, 1] = 1, -CLIP
        doc = np.repeat(np.arange(n), np.diff(bounds))
        np.maximum.at(out[:, 1], doc, np.clip(odds, -CLIP, CLIP))
        out[:, 1] /= 10
        out[:, 2] = np.log1p(np.bincount(doc, sigmoid(odds), n))
        return out

    def scores(self, odds: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        return sigmoid((self.summary(odds, bounds) * self.document).sum(axis=1))


def _marks(rows: list[tuple[str, int]]) -> set[str]:
    seen: tuple[Counter, Counter] = (Counter(), Counter())
    n = [0, 0]
    for text, y in rows:
        n[y] += 1
        seen[y].update({f for w in set(text.split()) for f in features(w)})
    least = max(MARK_LEAST, MARK_SHARE * n[1])
    return {f for f, a in seen[1].items() if a >= least and np.log((a + 0.5) / (n[1] + 1)) - np.log((seen[0][f] + 0.5) / (n[0] + 1)) > MARK_RATIO}


def _different(rows: list[tuple[str, int]]) -> list[tuple[str, int]]:
    """Each text once (but for case and white space): copies would lend weight to their own words."""
    seen, out = set(), []
    for text, y in rows:
        key = xxhash.xxh3_128_intdigest(" ".join(text.lower().split()))
        if key not in seen:
            seen.add(key)
            out.append((text, y))
    return out


def fit(rows: list[tuple[str, int]], share: float | None = None) -> Model:
    """The field's weights from (text, label) by gradient ascent of the chains' likelihood, then the texts' logistic function, for
    a corpus in which ``share`` of the texts have label 1 (default: as in ``rows``)."""
    rows = _different(rows)
    moves, document = np.zeros((2, 2)), np.zeros(3)
    if len({y for _, y in rows}) < 2:  # nothing to tell apart
        if share is None:
            share = (sum(y for _, y in rows) + 0.5) / (len(rows) + 1) if rows else 0.0
        document[0] = np.log(max(share, 1e-6) / max(1 - share, 1e-6))
        return Model({}, 0.0, moves, document)
    marks = _marks(rows)
    at, bounds, names = split(pa.array([t for t, _ in rows]))
    label = np.repeat(np.array([y for _, y in rows]), np.diff(bounds))
    lists = [sorted(set(features(w))) for w in names]
    count = Counter(f for fs in lists for f in fs if f in marks)
    number = {f: i for i, f in enumerate(sorted(count))}  # only marking features differ from the bias
    owner = np.array([k for k, fs in enumerate(lists) for f in fs if f in number], dtype=int)
    column = np.array([number[f] for fs in lists for f in fs if f in number], dtype=int)
    marked = np.zeros(len(names), bool)
    marked[owner] = True
    y = (label == 1) & marked[at]
    closing = np.array([ends(w) for w in names])[at]
    starts, sizes = chains(bounds, closing)
    inner = np.ones(len(at), bool)
    inner[starts] = False
    follow = np.flatnonzero(inner)
    seen_moves = np.array([[((y[follow - 1] == i) & (y[follow] == j)).sum() for j in (0, 1)] for i in (0, 1)], float)
    w, bias = np.zeros(len(number)), -3.0
    g2 = np.full(len(number) + 5, 1e-8)
    for _ in range(STEPS):
        e = bias + np.bincount(owner, w[column], len(names))[at]
        ahead, back = passes(e, starts, sizes, moves)
        p = sigmoid(ahead + back)
        wrong = np.bincount(at, y - p, len(names))
        r, g = np.exp(np.clip(ahead[follow - 1], -CLIP, CLIP)), np.exp(np.clip(e[follow] + back[follow], -CLIP, CLIP))
        t = np.exp(moves)
        pair = np.stack([t[0, 0] + 0 * r, t[0, 1] * g, t[1, 0] * r, t[1, 1] * r * g])
        pair /= pair.sum(axis=0)
        grad = np.concatenate([np.bincount(column, wrong[owner], len(number)) - RIDGE * w * len(at), [wrong.sum()], (seen_moves.ravel() - pair.sum(axis=1))])
        g2 += grad**2
        step = RATE * grad / np.sqrt(g2)
        w, bias, moves = w + step[: len(number)], bias + step[len(number)], moves + step[len(number) + 1 :].reshape(2, 2)
    model = Model({f: float(w[i]) for f, i in number.items()}, float(bias), moves, document)
    e = bias + np.bincount(owner, w[column], len(names))[at]
    x = model.summary(np.add(*passes(e, starts, sizes, moves)), bounds)
    target = np.array([k for _, k in rows], float)
    share = target.mean() if share is None else share
    weigh = np.where(target == 1, share / target.mean(), (1 - share) / (1 - target.mean()))
    for _ in range(600):  # few and well-scaled columns: plain gradient steps
        document = document + 2.0 * ((x * (weigh * (target - sigmoid((x * document).sum(axis=1))))[:, None]).mean(axis=0) - 1e-4 * document * [0, 1, 1])
    model.document = document
    return model


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE) -> Model:
    """The field from at most ``sample`` texts of each label, none of them held out, the same at every run."""
    marked = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("y")).where(~util.held_out("doc_id") & F.col("doc_id").isNotNull() & F.col("y").isin(0, 1))
    marked = marked.groupBy("doc_id").agg(F.max("y").alias("y"))
    have = {r["y"]: r["n"] for r in marked.groupBy("y").agg(F.count("*").alias("n")).collect()}
    draw = F.pmod(util.mix(F.col("doc_id"), 78), F.lit(1 << 40)) / float(1 << 40)
    rate = F.when(F.col("y") == 1, min(1.0, 2.0 * sample / max(1, have.get(1, 0)))).otherwise(min(1.0, 2.0 * sample / max(1, have.get(0, 0))))
    chosen = marked.withColumn("u", draw).where(F.col("u") < rate)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).where((F.octet_length("text") > 0) & ~util.held_out("doc_id"))
    # sizes first, so that only texts within the bounds are fetched
    drawn = texts.select("doc_id", F.octet_length("text").alias("size"), F.xxhash64("text").alias("mark")).join(F.broadcast(chosen), "doc_id")  # about 4 x sample rows at most are broadcast
    wanted, used = [], {0: [0, 0], 1: [0, 0]}
    for r in sorted(drawn.collect(), key=lambda r: (r["u"], r["doc_id"], r["size"], r["mark"])):
        n, held = used[r["y"]]
        if n < sample and (n == 0 or held + r["size"] <= SAMPLE_BYTES):
            used[r["y"]] = [n + 1, held + r["size"]]
            wanted.append((r["doc_id"], r["mark"], r["y"], r["u"]))
    marks = docs.sparkSession.createDataFrame(wanted, "doc_id long, mark long, y int, u double").distinct()
    rows = texts.withColumn("mark", F.xxhash64("text")).join(F.broadcast(marks), ["doc_id", "mark"])  # 2 x sample rows at most
    kept: dict[int, list] = {0: [], 1: []}
    for r in sorted(rows.toLocalIterator(), key=lambda r: (r["u"], r["doc_id"], r["text"])):
        kept[r["y"]].append((r["text"], r["y"]))
    return fit(kept[0] + kept[1], have.get(1, 0) / sum(have.values()) if have else None)


def toxicity(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted, expected_tokens, spans (character offsets).

    Defined cases: null texts are empty; texts without a token get the score of a text with none toxic. If nothing could be
    learnt, all scores are the share of toxic labels seen. Repeated rows are scored alike; an empty table gives an empty result.
    Other columns are not read, whatever their names.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the sample

    def spans(text: str, toks: list[str], hot: np.ndarray) -> list[dict]:
        out, pos, wanted = [], 0, set(np.flatnonzero(hot).tolist())
        last = max(wanted)
        for k, w in enumerate(toks):
            if k > last:
                break
            pos = text.index(w, pos)
            if k in wanted:
                if out and k - 1 in wanted:
                    out[-1]["end"] = pos + len(w)
                else:
                    out.append({"start": pos, "end": pos + len(w)})
            pos += len(w)
        return out

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for batch in batches:
            for part in tokens.slices(batch, "text"):
                texts = part.column("text").fill_null("")
                odds, bounds, at, names = m.marginals(texts)
                x, hot = m.scores(odds, bounds), odds >= 0
                many = np.bincount(np.repeat(np.arange(len(texts)), np.diff(bounds)), hot, len(texts)) > 0
                found: list[list] = [[]] * len(texts)
                for d in np.flatnonzero(many).tolist():
                    a, b = bounds[d], bounds[d + 1]
                    found[d] = spans(texts[d].as_py(), [names[i] for i in at[a:b].tolist()], hot[a:b])
                expected = np.bincount(np.repeat(np.arange(len(texts)), np.diff(bounds)), sigmoid(odds), len(texts))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(x), pa.array((x >= 0.5).astype(np.int32)), pa.array(expected), pa.array(found, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))],
                    names=["doc_id", "score", "predicted", "expected_tokens", "spans"],
                )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    out = rows.mapInArrow(tokens.tidy(score), f"doc_id long, score double, predicted int, expected_tokens double, spans {SPANS}")
    return out.select("doc_id", util.held_out("doc_id").alias("held_out"), "score", "predicted", "expected_tokens", "spans")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = util.documents(spark, sf_dir)
    return toxicity(docs, learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
