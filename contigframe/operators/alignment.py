"""Local alignments of many pairs at once, each in a band round its diagonal, as whole arrays over the pairs."""

from __future__ import annotations

import math

import numpy as np

# Residues with their shares in proteins (in thousandths) and the score of a residue with itself; groups of residues that replace each other.
RESIDUES = "ARNDCQEGHILKMFPSTWYV"
SHARES = (78, 51, 45, 54, 19, 43, 63, 74, 22, 51, 91, 57, 22, 39, 52, 71, 58, 13, 32, 64)
SELF = (4, 5, 6, 6, 9, 5, 5, 6, 8, 4, 4, 5, 5, 6, 7, 4, 5, 11, 7, 4)
GROUPS = ("LVIM", "C", "A", "G", "ST", "P", "FYW", "EDNQ", "KR", "H")
ALIKE, OTHER, UNKNOWN = 1, -2, -1
BASES, MATCH, MISMATCH = "ACGT", 2, -3
NOTHING = -30_000
WIDTH = 48


class Scoring:
    """Letters as numbers, their scores, gap costs, and the statistics that follow: scores of chance alignments have parameters ``rate`` and ``factor``."""

    def __init__(self, letters: str, matrix: np.ndarray, shares: np.ndarray, groups: np.ndarray, gap_open: int, gap_more: int, factor: float, name: str):
        n = len(letters)
        self.name, self.unknown, self.pad, self.groups = name, n, n + 1, groups
        self.code = np.full(256, n, np.uint8)
        for k, c in enumerate(letters):
            self.code[[ord(c), ord(c.lower())]] = k
        self.table = np.full((n + 2, n + 2), NOTHING, np.int32)
        self.table[: n + 1, : n + 1] = UNKNOWN
        self.table[:n, :n] = matrix
        self.gap_open, self.gap_more, self.factor = gap_open, gap_more, factor
        both = np.outer(shares, shares) / shares.sum() ** 2
        low, high = 1e-6, 10.0
        for _ in range(100):  # the positive rate at which chance scores sum to one
            rate = (low + high) / 2
            low, high = (rate, high) if (both * np.exp(rate * matrix)).sum() < 1 else (low, rate)
        self.rate = rate

    def codes(self, text: str) -> np.ndarray:
        return self.code[np.frombuffer(text.encode("latin-1", "replace"), np.uint8)]

    def bits(self, score: np.ndarray) -> np.ndarray:
        return (self.rate * score - math.log(self.factor)) / math.log(2)

    def evalue(self, score: np.ndarray, query: np.ndarray, database: float) -> np.ndarray:
        return query * database * np.exp2(-self.bits(score))


def _protein() -> Scoring:
    group = np.array([next(k for k, g in enumerate(GROUPS) if c in g) for c in RESIDUES])
    matrix = np.where(group[:, None] == group[None, :], ALIKE, OTHER)
    np.fill_diagonal(matrix, SELF)
    return Scoring(RESIDUES, matrix, np.array(SHARES, float), group, 11, 1, 0.1, "protein")


PROTEIN = _protein()
DNA = Scoring(BASES, np.where(np.eye(4, dtype=bool), MATCH, MISMATCH), np.ones(4), np.arange(4), 5, 2, 0.4, "dna")


def best_scores(queries: list[np.ndarray], targets: list[np.ndarray], centre: np.ndarray, scoring: Scoring, width: int = WIDTH) -> np.ndarray:
    """The scores that ``align`` gives, without the way back: what is too low to be a hit needs no more."""
    pairs, rows = len(queries), max((len(t) for t in targets), default=0)
    if not pairs or not rows:
        return np.zeros(pairs, np.int64)
    target, window, _ = _padded(queries, targets, centre, scoring, width, rows)
    kind = np.int16 if rows * int(scoring.table.max()) + width * scoring.gap_more < -NOTHING else np.int32
    table, letters = scoring.table.astype(kind).ravel(), scoring.table.shape[1]
    target = target.astype(np.intp) * letters
    slope = (scoring.gap_more * np.arange(width)).astype(kind)
    best, down, top = np.zeros((pairs, width), kind), np.full((pairs, width), NOTHING, kind), np.zeros((pairs, width), kind)
    for i in range(rows):
        cell = best + table.take(target[:, i, None] + window[:, i : i + width])
        down[:, :-1] = np.maximum(best[:, 1:] - kind(scoring.gap_open), down[:, 1:] - kind(scoring.gap_more))
        down[:, -1] = NOTHING
        np.maximum(cell, down, out=cell)
        np.maximum(cell, kind(0), out=cell)
        side = np.maximum.accumulate(cell + slope, axis=1)
        np.maximum(cell[:, 1:], side[:, :-1] - (slope[:-1] + kind(scoring.gap_open)), out=cell[:, 1:])
        best = cell
        np.maximum(top, best, out=top)
    return top.max(axis=1).astype(np.int64)


def _padded(queries: list[np.ndarray], targets: list[np.ndarray], centre: np.ndarray, scoring: Scoring, width: int, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Targets, the letters of queries that their bands reach, and the query place of the band's first cell in row 0."""
    target = np.full((len(queries), rows), scoring.pad, np.uint8)
    window = np.full((len(queries), rows + width), scoring.pad, np.uint8)
    left = np.asarray(centre, np.int64) - width // 2
    for k, (q, t) in enumerate(zip(queries, targets, strict=True)):
        target[k, : len(t)] = t
        a, b = max(0, int(left[k])), min(len(q), int(left[k]) + rows + width)
        if b > a:
            window[k, a - left[k] : b - left[k]] = q[a:b]
    return target, window, left


def align(queries: list[np.ndarray], targets: list[np.ndarray], centre: np.ndarray, scoring: Scoring, width: int = WIDTH, steps: list | None = None) -> dict[str, np.ndarray]:
    """The best local alignment of each pair within ``width`` diagonals (query place less target place) round ``centre``: score, first and last
    places from 0 (qs, qe, ts, te), columns (length) and equal letters (same). A score of 0 is no alignment. ``steps`` gets the way back: arrays of
    (pair, kind, columns), kind 1 for two letters, 2 for one of the target alone, 3 for one of the query alone."""
    pairs, rows = len(queries), max((len(t) for t in targets), default=0)
    out = {k: np.zeros(pairs, np.int64) for k in ("score", "qs", "qe", "ts", "te", "length", "same")}
    if not pairs or not rows:
        return out
    target, window, left = _padded(queries, targets, centre, scoring, width, rows)
    place, every = np.arange(width), np.arange(pairs)
    came, run = np.zeros((rows, pairs, width), np.uint8), np.zeros((rows, pairs, width), np.uint8)
    best = np.zeros((pairs, width), np.int32)
    down, downs = np.full((pairs, width), NOTHING, np.int32), np.zeros((pairs, width), np.uint8)
    top, top_at, top_row = np.zeros(pairs, np.int32), np.zeros(pairs, np.int64), np.zeros(pairs, np.int64)
    for i in range(rows):
        score = scoring.table[target[:, i][:, None], window[:, i : i + width]]
        through = best + score
        opened, more = np.full_like(best, NOTHING), np.full_like(best, NOTHING)  # a letter of the target alone
        opened[:, :-1], more[:, :-1] = best[:, 1:] - scoring.gap_open, down[:, 1:] - scoring.gap_more
        longer = np.ones_like(downs)
        longer[:, :-1] += np.where(more[:, :-1] > opened[:, :-1], downs[:, 1:], 0).astype(np.uint8)
        down, downs = np.maximum(opened, more), longer
        cell = np.maximum(np.maximum(through, down), 0)
        src = np.where(cell == 0, 0, np.where(cell == through, 1, 2)).astype(np.uint8)
        # letters of the query alone: the best cell to the left, less the gap
        packed = np.maximum.accumulate(((cell + scoring.gap_more * place) << 6) | place, axis=1)
        side = np.full_like(cell, NOTHING)
        side[:, 1:] = (packed[:, :-1] >> 6) - scoring.gap_open - scoring.gap_more * place[:-1]
        src[side > cell] = 3
        run[i] = np.where(src == 2, downs, 0)
        run[i][:, 1:] = np.where(src[:, 1:] == 3, place[1:] - (packed[:, :-1] & 63), run[i][:, 1:])
        best = np.maximum(cell, side)
        came[i] = src
        high = best.argmax(axis=1)
        better = best[every, high] > top
        top[better], top_at[better], top_row[better] = best[every, high][better], high[better], i
    # back along all alignments together
    row, at, going = top_row.copy(), top_at.copy(), top > 0
    out["score"], out["te"], out["qe"] = top.astype(np.int64), top_row.copy(), top_row + left + top_at
    while going.any():
        k = np.flatnonzero(going)
        src, n = came[row[k], k, at[k]], run[row[k], k, at[k]].astype(np.int64)
        diagonal, up, side = k[src == 1], src == 2, src == 3
        if steps is not None:
            steps.append(np.stack([k, src, np.where(src == 1, 1, n)])[:, src > 0])
        t, q = target[diagonal, row[diagonal]], window[diagonal, row[diagonal] + at[diagonal]]
        out["same"][diagonal] += (t == q) & (t < scoring.unknown)
        out["ts"][diagonal], out["qs"][diagonal] = row[diagonal], row[diagonal] + left[diagonal] + at[diagonal]
        out["length"][diagonal] += 1
        row[diagonal] -= 1
        out["length"][k[up]] += n[up]
        row[k[up]] -= n[up]
        at[k[up]] += n[up]
        out["length"][k[side]] += n[side]
        at[k[side]] -= n[side]
        going[k[src == 0]] = False
        going &= (row >= 0) & (at >= 0) & (at < width)
    return out


def columns(queries: list[str], targets: list[str], got: dict[str, np.ndarray], steps: list[np.ndarray]) -> tuple[list[str], list[str]]:
    """The alignments as two rows of letters, with hyphens where the other one's letter stands alone."""
    rows = np.concatenate(steps, axis=1)[:, ::-1] if steps else np.zeros((3, 0), np.int64)
    rows = rows[:, np.argsort(rows[0], kind="stable")]
    bounds = np.searchsorted(rows[0], np.arange(len(queries) + 1))
    out: tuple[list[str], list[str]] = ([], [])
    for k, (q, t) in enumerate(zip(queries, targets, strict=True)):
        j, i, above, below = int(got["qs"][k]), int(got["ts"][k]), [], []
        for kind, n in rows[1:, bounds[k] : bounds[k + 1]].T.tolist():
            above.append("-" * n if kind == 2 else q[j : j + n])
            below.append("-" * n if kind == 3 else t[i : i + n])
            j, i = j + (n if kind != 2 else 0), i + (n if kind != 3 else 0)
        out[0].append("".join(above))
        out[1].append("".join(below))
    return out
