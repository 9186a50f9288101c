"""Profile paths against a recursion written out, and a search from text models to hits."""

import random

import numpy as np

from contigframe import constants as C
from contigframe.operators import profiles as M

AA = C.HMM_ALPHABET


def literal(e, t, x):
    """Best path by states, one cell after the other."""
    best, K = M.FAR, len(e)
    m, i, d = [[M.FAR] * K], [[M.FAR] * K], [[M.FAR] * K]
    for c in x:
        row, ins, dele = [], [], []
        for k in range(K):
            here = [-np.log2(K)]
            if k:
                here += [m[-1][k - 1] + t[k - 1][M.MM], i[-1][k - 1] + t[k - 1][M.IM], d[-1][k - 1] + t[k - 1][M.DM]]
            row.append((e[k][AA.index(c)] if c in AA else 0.0) + max(here))
            ins.append(max(m[-1][k] + t[k][M.MI], i[-1][k] + t[k][M.II]))
            dele.append(max(row[k - 1] + t[k - 1][M.MD], dele[k - 1] + t[k - 1][M.DD]) if k else M.FAR)
        m.append(row), i.append(ins), d.append(dele)
        best = max(best, *row)
    return best


def model(r, n):
    e = np.array([[r.gauss(-1, 1) for _ in AA] for _ in range(n)])
    for k in range(n):
        e[k, r.randrange(20)] += 5
    return e, np.array([[r.uniform(-6, -0.1) for _ in range(7)] for _ in range(n)])


def test_paths_equal_the_recursion():
    r = random.Random(1)
    for n in (1, 2, 7, 15):
        e, t = model(r, n)
        core = "".join(AA[k] for k in e.argmax(1))
        proteins = ["", "A", core, core[: n // 2] + "WW" + core[n // 2 :], "GG" + core[: n // 3] + core[2 * n // 3 :], "".join(r.choice(AA + "X") for _ in range(30))]
        got, last = M.viterbi(e, t, proteins)
        assert all(abs(g - literal(e, t, p)) < 1e-6 for g, p in zip(got, proteins)) and last[0] == 0 and all(1 <= x <= len(p) for x, p in zip(last[1:], proteins[1:]))


def as_text(name, core, ga=None):
    """A model whose nodes hold one residue nearly always."""
    lines = ["HMMER3/f [x]", f"NAME  {name}", f"ACC   PF{len(core):05}.1"] + ([f"GA    {ga} {ga};"] if ga else []) + ["HMM          " + "   ".join(AA), "       m->m  m->i", "  COMPO  " + "  ".join(["2.9"] * 20), "  " + "  ".join(["2.9"] * 20), "  " + "  ".join(["0.01", "5", "5", "0.6", "0.8", "0", "*"])]
    for k, c in enumerate(core):
        lines += [f"{k + 1} " + " ".join("0.2" if a == c else "4.6" for a in AA) + f" {k + 1} x - -", "  " + " ".join(["2.9"] * 20), "  " + " ".join(["0.02", "4.6", "4.6", "0.6", "0.8", "0.7", "0.7"])]
    return "\n".join(lines) + "\n//\n"


def test_search_from_text(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(M, "BLOCK", 3)
    r = random.Random(2)
    cores = {k: "".join(r.choice(AA) for _ in range(60)) for k in ("one", "two", "strict")}
    (tmp_path / "m.hmm").write_text("".join(as_text(k, c, 500 if k == "strict" else None) for k, c in cores.items()))
    profiles = M.read_profiles(spark, str(tmp_path / "m.hmm"))
    assert {x["model"]: x["consensus"] for x in profiles.collect()} == cores
    proteins = [(f"{k}{n}", "".join(r.choice(AA) for _ in range(n)) + c[:30] + "".join(r.choice(AA) for _ in range(n % 3)) + c[30:]) for k, c in cores.items() for n in range(8)]
    proteins += [("none", "".join(r.choice(AA) for _ in range(200))), ("empty", ""), ("null", None)]
    got = M.hmm_search(spark.createDataFrame(proteins, "q string, seq string"), profiles, least=20.0).collect()
    assert {(x["q"], x["model"]) for x in got} == {(f"{k}{n}", k) for k in cores for n in range(8)}
    tables = {x["model"]: (np.array(x["emissions"]).reshape(-1, 20), np.array(x["transitions"]).reshape(-1, 7)) for x in profiles.collect()}
    seqs = dict(proteins)
    assert all(abs(x["score"] - literal(*tables[x["model"]], seqs[x["q"]])) < 1e-6 for x in got if x["q"].endswith(("0", "5")))
    assert {x["model"] for x in M.hmm_search(spark.createDataFrame(proteins, "q string, seq string"), profiles).collect()} == {"one", "two"}


def test_work_follows_the_letters_of_a_block():
    """One long protein among short ones doesn't make them all as long."""
    import time

    r = random.Random(5)
    e, t = model(r, 80)
    proteins = ["".join(r.choice(AA) for _ in range(n)) for n in [30] * 200 + [12_000] + [45] * 55]
    began = time.process_time()
    got, last = M.viterbi(e, t, proteins)
    assert time.process_time() - began < 5
    alone = [M.viterbi(e, t, [p]) for p in (proteins[0], proteins[200], proteins[-1])]
    assert [(got[k], last[k]) for k in (0, 200, 255)] == [(a[0][0], a[1][0]) for a in alone]
