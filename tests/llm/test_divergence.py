"""The source audit against plain counting."""

import random
import re
from collections import Counter, defaultdict

import pytest

from contigframe.llm import source_divergence as D

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def brute(docs, top):
    docs = [tuple(x or "" for x in d) for d in docs]
    counts, per_doc, groups = defaultdict(Counter), defaultdict(Counter), {(lang, source) for _, lang, source in docs}
    for text, lang, source in docs:
        terms = TERM.findall(text.translate(LOWER))
        counts[lang, source].update(terms)
        per_doc[lang].update(set(terms))
    out = []
    for lang, source in groups:
        kept = [t for t, n in per_doc[lang].items() if n >= 3]
        of = {s: counts[lang, s] for la, s in groups if la == lang}
        whole = sum(of.values(), Counter())

        def p(c, t, kept=kept):
            return 1 + 10**9 * (c[t] + 1) // (sum(c[u] for u in kept) + len(kept))

        ps = {s: {t: p(c, t) for t in kept} for s, c in of.items()}
        q = {t: p(whole, t) for t in kept}
        own = ps[source]
        pairs = [(s, sum((own[t] - ps[s][t]) ** 2 // ps[s][t] for t in kept)) for s in of if s != source]
        terms = [(t, (own[t] - q[t]) ** 2 // q[t]) for t in kept if of[source][t] and own[t] > q[t]]
        for part, rows, most in (("pair", pairs, None), ("term", terms, top)):
            rows = sorted(rows, key=lambda r: (-r[1], r[0].encode()))[:most]
            out += [(lang, source, part, item, value, k + 1) for k, (item, value) in enumerate(rows)]
    return sorted(out)


def result(df, top):
    return sorted(tuple(r) for r in D.source_divergence(df, top=top).collect())


def corpus(n, seed):
    r = random.Random(seed)
    words = ["Ärger", "the", "The", "of", "x y", "don't", "A-b", "日本", "zz9", "\U0001f600"] + [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(9) for j in range(9)]
    docs = []
    for _ in range(n):
        lang, source = r.choice(["en", "en", "de", "", None]), r.choice(["a", "a", "a", "b", "é", "Z", "", None])
        docs.append((" ".join(r.choice(words[: r.choice([4, 12, 90])]) for _ in range(r.randrange(25))), lang, source))
    return docs + [(None, "en", "quiet"), ("", "fr", "one"), ("only here", "fr", "two"), docs[0], docs[0], ("the " * 3000, "en", "long")]


@pytest.mark.parametrize("top", [3, 200])
def test_against_plain_counting(spark, monkeypatch, top):
    monkeypatch.setattr(D, "POSTINGS", 60)
    docs = corpus(240, top)
    df = spark.createDataFrame([(*d, "x", 1) for d in docs], "text string, lang string, source string, term string, n int").repartition(4)
    assert result(df, top) == brute(docs, top)


def test_empty_and_single(spark):
    schema = "text string, lang string, source string"
    assert result(spark.createDataFrame([], schema), 200) == []
    assert result(spark.createDataFrame([(None, None, None)], schema), 200) == []
    assert result(spark.createDataFrame([("a", "x", "1"), ("a", "x", "2")], schema), 200) == [("x", "1", "pair", "2", 0, 1), ("x", "2", "pair", "1", 0, 1)]
