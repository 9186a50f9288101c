"""Language, toxicity, personal data, licences and media against literal forms, round trips and held-out labels."""

import hashlib
import io
import json
import math
import tarfile
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from contigframe.llm import language_id, licenses, media, pii, toxicity, util

SCHEMA = "doc_id long, text string, lang string, score double, held_out int"
TRAIN = [(i, t, lang, None, 1) for i, (t, lang) in enumerate([("the cat and the dog went home together again and again " * 4, "en"), ("der Hund und die Katze gehen nach Hause und schlafen dann " * 4, "de")] * 20)]
ODD = [(100, None, None, None, None), (101, "", "en", None, 1), (102, "123 456", "en", None, 1), (103, "the dog", None, None, 1), (104, "die Katze", "xx", None, 1), (104, "die Katze", "xx", None, 1), (None, "the cat", None, None, None), (105, "the cat " * 30000, "en", None, 1), (106, "猫が家に帰る", None, None, 1)]


def literal_bits(model_samples, order, text):
    """Code lengths by a plain tree of contexts, byte by byte."""
    out = {}
    for lang, texts in model_samples.items():
        counts = {}
        for t in texts:
            s = t.encode()
            for i in range(len(s)):
                for k in range(min(order, i) + 1):
                    counts.setdefault(s[i - k : i], Counter())[s[i]] += 1
        bits, s = 0.0, text.encode()
        for i in range(len(s)):
            for k in range(min(order, i), -1, -1):
                c = counts.get(s[i - k : i])
                if not c:
                    continue
                n, q = sum(c.values()), len(c)
                if s[i] in c:
                    bits -= math.log2(c[s[i]] / (n + q))
                    break
                bits -= math.log2(q / (n + q))
            else:
                bits += 8
        out[lang] = bits
    return out


@settings(max_examples=40, deadline=None)
@given(st.text(st.sampled_from("ab thec é\n猫"), max_size=40))
def test_code_lengths_are_exact(text):
    samples = {"en": ["the cat", "a bath the"], "x": ["abc ébab", "ccc"]}
    scorer = language_id.Scorer(language_id.Model(samples, 3))
    for texts in (["", text, "", "a bath", text[:1]], [text]):
        got = scorer.bits(pa.array(["x", *texts])[1:])
        for row, t in zip(got, texts, strict=True):
            want = literal_bits(samples, 3, t)
            assert np.allclose(row, [want["en"], want["x"]], atol=1e-3)


def test_code_lengths_in_parts_and_with_a_full_memo(monkeypatch):
    samples = {f"l{k}": [f"{'ab' * k} cab {k}", "x" * k] for k in range(40)}
    model = language_id.Model(samples)
    texts = pa.array(["abc cab " * 300, "", "é" * 50, "5 ab"])
    whole = language_id.Scorer(model).bits(texts)
    want = literal_bits(samples, language_id.ORDER, texts[0].as_py())
    assert np.allclose(whole[0], [want[k] for k in model.langs], rtol=1e-4)
    monkeypatch.setattr(language_id, "MEMO_BYTES", 0)
    monkeypatch.setattr("builtins.min", lambda *a, f=min, **k: f(97, *a) if a[0] == 2_000_000 else f(*a, **k))
    scorer = language_id.Scorer(model)
    assert np.allclose(scorer.bits(texts), whole) and len(scorer.table) < 100


def test_a_worker_scores_long_parts_in_bounded_memory():
    """Six workers share an executor with its heap: arrays over 4 MB of text held 136 MB before."""
    scorer = language_id.Scorer(language_id.Model({k: [f"{k} some text of that language"] for k in ("a", "b", "c", "d")}))
    texts = pa.array(["some words of a text " * 100_000] * 2)
    tracemalloc.start()
    scorer.bits(texts)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 60e6


def test_every_labelled_language_is_learnt(spark):
    """Short texts, long texts and very many languages: none is left out."""
    rows = [(5 * i + 2, "kurzer Text", "de", None, 1) for i in range(40)] + [(1000 + i, "a much longer text in another language " * 5, "en", None, 1) for i in range(40)]
    rows += [(2000 + i, "abcde fghij " * 4000, "long", None, 1) for i in range(5)]
    model = language_id.learn(spark.createDataFrame(rows, SCHEMA))
    assert model.langs == ["de", "en", "long"]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = language_id.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert all(r.lang == r.lang_pred for r in got)
    many = spark.createDataFrame([(10 * k + i, f"l{k} wort{k}x{k} und so weiter {k}", f"l{k}", None, 1) for k in range(300) for i in range(6)], SCHEMA)
    model = language_id.learn(many)
    assert len(model.langs) == 300
    assert sum(len(x.value) for x in model.seen) <= sum(sum(len(t) for t in (f"l{k} wort{k}x{k} und so weiter {k}" * 6,)) for k in range(300)) * 5


def test_nothing_learnt_keeps_texts_with_letters(spark):
    docs = spark.createDataFrame([(1, "the cat", None, None, 1), (2, "12", None, None, 1), (3, None, None, None, 1)], SCHEMA)
    assert [r.doc_id for r in language_id.identified_documents(docs, language_id.learn(docs)).collect()] == [1]


def test_table_grows():
    rng = np.random.default_rng(3)
    table, keys = language_id.Table(8), np.unique(rng.integers(1, 2**40, 5000).astype(np.uint64))
    for part in np.array_split(rng.permutation(keys), 9):
        table.add(part)
    assert (table.order[table.find(keys)] == keys).all() and (table.find(keys + np.uint64(2**41)) == -1).all()


def test_language_of_odd_rows(spark):
    docs = spark.createDataFrame(TRAIN + ODD, SCHEMA)
    model = language_id.learn(docs)
    got = {(r.doc_id, r.lang_pred) for r in language_id.identify(docs, model).collect() if r.doc_id is None or r.doc_id >= 100}
    assert {(100, "und"), (101, "und"), (102, "und"), (103, "en"), (104, "de"), (None, "en"), (105, "en")} <= got
    assert language_id.identify(docs, model).count() == len(TRAIN + ODD)
    kept = language_id.identified_documents(docs, model)
    assert kept.columns == docs.columns and kept.where("doc_id in (100, 101, 102)").count() == 0 and kept.where("doc_id = 104").count() == 2
    empty = spark.createDataFrame([], SCHEMA)
    assert {r.lang_pred for r in language_id.identify(docs, language_id.learn(empty)).collect()} == {"und"}
    assert language_id.identify(empty, model).collect() == []


def test_language_held_out(spark):
    docs = util.documents(spark, "/root/testdata/sf0.01")
    found = language_id.op4_language(spark, "/root/testdata/sf0.01").where("held_out").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert sum(r.lang == r.lang_pred for r in found) > 0.97 * len(found) > 0 and all(0 <= r.score <= 1 for r in found)


def test_language_stage_keeps_what_may_be_known_and_drops_foreign_scripts(spark):
    docs = util.documents(spark, "/root/testdata/sf0.01")
    model = language_id.learn(docs)
    near = [("the cat sat on the mat and the dog sat by the door " * 4 + w, lang) for lang in ("aa", "bb", "cc") for w in ("one", "two")]
    alike = language_id.learn(spark.createDataFrame([(i, t, lang, None, 1) for i, (t, lang) in enumerate(near * 10)], SCHEMA))
    short = spark.createDataFrame([(1, "the cat", None, None, 1), (2, "mat", None, None, 1), (3, near[0][0], None, None, 1), (4, "1 2", None, None, 1)], SCHEMA)
    assert {r.doc_id for r in language_id.identified_documents(short, alike).collect()} == {1, 2, 3}
    foreign = ["На следующее утро мальчик вышел из дома с собакой и пошёл вдоль реки к старой мельнице.", "翌朝、少年は犬を連れて家を出て、川沿いを歩いて古い水車小屋まで行った。友達はそこで一時間以上も彼を待っていた。"]
    ours = [
        "Re.", "De.", "The next morning the boy left the house with his dog and walked along the river to the old mill.", "日本", "x = 1 + α",
        "Quantum chromodynamics describes how quarks interact via gluon exchange; asymptotic freedom weakens the coupling at high energies.",
        "Die Rechtsschutzversicherungsgesellschaften verlangten Donaudampfschifffahrtskapitänsmützen für außergewöhnliche Vorführungen.",
        "def keep(rows):\n    for r in rows:\n        if r.id % 2 == 0 and r.name is not None:\n            yield {k: v for k, v in r.items()}\n",
        "La mattina dopo il ragazzo uscì di casa con il cane e camminò lungo il fiume fino al vecchio mulino, dove gli amici lo aspettavano.",  # a known script: may be names
    ]
    rows = spark.createDataFrame([(i, t, None, None, 1) for i, t in enumerate(ours + foreign)], SCHEMA)
    assert {r.text for r in language_id.identified_documents(rows, model).collect()} == set(ours)
    lettered = docs.where("text rlike '[A-Za-z]'").count()
    assert language_id.identified_documents(docs, model).count() == lettered > 0


def test_rate_of_the_learnt_texts():
    samples = {"en": ["the cat", "a bath the"], "x": ["abc ébab", "ccc"]}
    for order in (2, 4):
        model = language_id.Model(samples, order)
        for j, lang in enumerate(model.langs):
            bits = sum(literal_bits(samples, order, t)[lang] for t in samples[lang])
            assert abs(model.rate[j] - bits / sum(len(t.encode()) for t in samples[lang])) < 1e-4


def test_chain_marginals_are_exact():
    rng = np.random.default_rng(2)
    e, moves = rng.normal(size=7), rng.normal(size=(2, 2))
    ahead, back = toxicity.passes(e, np.array([0, 4]), np.array([4, 3]), moves)
    for a, n in ((0, 4), (4, 3)):
        p, z = np.zeros(n), 0.0
        for code in range(2**n):
            y = [code >> k & 1 for k in range(n)]
            w = math.exp(sum(e[a + k] * y[k] for k in range(n)) + sum(moves[y[k], y[k + 1]] for k in range(n - 1)))
            z += w
            p += w * np.array(y)
        assert np.allclose(toxicity.sigmoid(ahead + back)[a : a + n], p / z)


def test_chains_cover_and_end():
    bounds, closing = np.array([0, 3, 3, 400]), np.zeros(400, bool)
    closing[[1, 10]] = True
    starts, sizes = toxicity.chains(bounds, closing)
    assert sorted(zip(starts.tolist(), sizes.tolist())) == [(0, 2), (2, 1), (3, 8), (11, 389)] and (np.diff(sizes) <= 0).all()


@pytest.mark.parametrize("few", [0, 1, 3, 50])
def test_chains_of_any_length_are_passed_alike(monkeypatch, few):
    rng = np.random.default_rng(4)
    sizes = np.array(sorted([1, 1, 2, 5, 5, 9, 30, 300], reverse=True))
    starts, e, moves = np.cumsum(sizes) - sizes, rng.normal(size=sizes.sum()), rng.normal(size=(2, 2))
    monkeypatch.setattr(toxicity, "FEW", few)
    ahead, back = toxicity.passes(e, starts, sizes, moves)
    for a, n in zip(starts, sizes):
        f, b = np.zeros((n, 2)), np.ones((n, 2))
        for i in range(n):
            own = np.array([1, math.exp(e[a + i])])
            f[i] = own * (f[i - 1] @ np.exp(moves) if i else 1)
            f[i] /= f[i].sum()
        for i in range(n - 2, -1, -1):
            b[i] = np.exp(moves) @ (b[i + 1] * np.array([1, math.exp(e[a + i + 1])]))
            b[i] /= b[i].sum()
        p = f * b
        assert np.allclose(toxicity.sigmoid(ahead + back)[a : a + n], p[:, 1] / p.sum(axis=1))


def test_long_words_that_begin_alike_are_features_of_their_own():
    one, two = "a" * 60 + "b", "a" * 60 + "c"
    assert toxicity.features(one) != toxicity.features(two)


def literal_toxicity(model, text):
    """(score, toxic spans) from the field's definition, one token after the other."""
    tokens_, at = [], 0
    for w in text.split():
        at = text.index(w, at)
        tokens_.append((w, at))
        at += len(w)
    odds, chain = [], []
    t = np.exp(model.moves)
    for k, (w, _) in enumerate(tokens_):
        chain.append(model.bias + sum(model.weights.get(f, 0.0) for f in set(toxicity.features(w))))
        if w[-1] in ".!?" or k == len(tokens_) - 1:
            n = len(chain)
            own = [np.array([1.0, math.exp(x)]) for x in chain]
            f, b = [own[0] / own[0].sum()], [np.ones(2)]
            for i in range(1, n):
                f.append(own[i] * (f[-1] @ t))
                f[-1] /= f[-1].sum()
            for i in range(n - 2, -1, -1):
                b.append(t @ (b[-1] * own[i + 1]))
                b[-1] /= b[-1].sum()
            for x, y in zip(f, reversed(b)):
                p = x * y
                odds.append(math.log(p[1] / p[0]))
            chain = []
    p = [1 / (1 + math.exp(-x)) for x in odds]
    x = np.array([1.0, max([min(max(o, -30.0), 30.0) for o in odds], default=-30.0) / 10, math.log1p(sum(p))])
    spans = []
    for k, (w, a) in enumerate(tokens_):
        if p[k] >= 0.5:
            if spans and k and p[k - 1] >= 0.5:
                spans[-1][1] = a + len(w)
            else:
                spans.append([a, a + len(w)])
    return 1 / (1 + math.exp(-float(x @ model.document))), [tuple(s) for s in spans]


def test_scores_and_spans_equal_the_definition(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = util.documents(spark, d).select("doc_id", "text"), spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    model = toxicity.learn(util.documents(spark, "/root/testdata/sf0.1"), labels)
    rows = docs.where("length(text) < 20000").collect()
    got = {r.doc_id: r for r in toxicity.toxicity(spark.createDataFrame(rows, docs.schema), model).collect()}
    toxic = 0
    for r in rows:
        score, spans = literal_toxicity(model, r.text)
        assert abs(got[r.doc_id].score - score) < 1e-6 and [(s.start, s.end) for s in got[r.doc_id].spans] == spans
        toxic += bool(spans)
    assert toxic > 0


def test_toxicity_learns_from_long_texts_and_keeps_the_share(spark):
    filler = " ".join(f"word{k % 211} goes on." for k in range(3000))
    rows = [(i, f"{filler} text {i} " + ("you vile idiot." if i % 2 else "good day.") + " " + filler, i % 2) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    assert docs.selectExpr("min(octet_length(text))").first()[0] > 40_000
    model = toxicity.learn(docs, docs.select("doc_id", "toxic"))
    got = {r.doc_id: r.score for r in toxicity.toxicity(docs, model).collect()}
    assert all((got[i] > 0.5) == (i % 2 == 1) for i, *_ in rows)
    assert toxicity.toxicity(docs.limit(1), toxicity.fit([], 0.25)).first().score == pytest.approx(0.25)


def test_toxicity_of_no_rows_and_clashing_names(spark):
    model = toxicity.fit([("you idiot", 1), ("good day", 0)])
    odd = spark.createDataFrame([(1, "you idiot", 0.5, 7)], "doc_id long, text string, score double, predicted int")
    got = toxicity.toxicity(odd, model).collect()
    assert len(got) == 1 and got[0].predicted in (0, 1) and toxicity.toxicity(odd.limit(0), model).collect() == []


def test_toxicity_held_out_and_spans(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = util.documents(spark, d), spark.read.parquet(f"{d}/labels.parquet")
    model = toxicity.learn(docs, labels)
    got = toxicity.toxicity(docs, model).join(labels.select("doc_id", "toxic"), "doc_id").where("held_out").collect()
    assert sum(r.toxic == r.predicted for r in got) > 0.93 * len(got) > 0
    assert sum(r.toxic == 1 and r.predicted == 1 for r in got) > 0.5 * sum(r.toxic for r in got)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, " \n "), (4, "you idiot scum."), (4, "you idiot scum."), (None, "x " * 50000)], "doc_id long, text string")
    rows = toxicity.toxicity(odd, model).collect()
    assert len(rows) == 6 and all(0 <= r.score <= 1 for r in rows)
    spans = next(r.spans for r in rows if r.doc_id == 4)
    assert spans and "you idiot scum."[spans[0].start : spans[-1].end].startswith("idiot")
    none = toxicity.learn(docs, labels.limit(0))
    assert len({r.score for r in toxicity.toxicity(odd, none).collect()}) == 1


KEY = b"test"
VALUES = ["4387513035237269", "4111-1111-1111-1111", "mail hsr.29@mail5.example.com now", "+1 (262) 555-3752", "42.144.35.254", "DE89 3704 0044 0532 0130 00", "2001-02-28", "28.02.2001", "12/31/1999", "31/12/1999", "078-05-1120"]


@pytest.mark.parametrize("value", VALUES)
def test_pseudonyms_keep_the_format_and_go_back(value):
    new, spans = pii.pseudonymise(value, KEY)
    assert len(spans) == 1 and new != value and len(new) == len(value) or "." in value
    assert pii.pseudonymise(new, KEY, back=True)[0] == value
    assert pii.pseudonymise(f"x {value} y", KEY)[0] == f"x {new} y" or "mail" in value


CARD, IBAN = "4111 1111 1111 1111", "DE89 3704 0044 0532 0130 00"
BESIDE = [f"{CARD} 12/27", "4111111111111111 123", f"12 {CARD}", f"{CARD} 12 27 123", f"5555 12 27 {CARD}", f"12/27 {CARD} 123", f"{CARD} 1234567812345678", f"{CARD} 2027-01-31", f"{CARD} {CARD}"]
BESIDE += [f"{IBAN} 12", f"77 {IBAN} 1234", "NO93 8601 1117 947 12", "BE68 5390 0754 7034 1234"]


@pytest.mark.parametrize("text", BESIDE)
def test_values_beside_numbers_are_found_and_go_back(text):
    for k in range(40):
        new, spans = pii.pseudonymise(text, b"%d" % k)
        kinds = [x[0] for x in spans]
        assert ("card" if "4111" in text else "iban") in kinds and len(kinds) >= (2 if text.count(CARD) == 2 else 1)
        assert not any(v in new for v in (CARD, CARD.replace(" ", ""), IBAN, "8601 1117 947", "5390 0754 7034"))
        assert pii.pseudonymise(new, b"%d" % k, back=True)[0] == text


@pytest.mark.parametrize("value", ["GB82 WEST 1234 5698 7654 32", "NL91ABNA0417164300", "FR14 2004 1010 0505 0001 3M02 606", "IT60 X054 2811 1010 0000 0123 456", "IE29 AIBK 9311 5212 3456 78", "MT84MALT011000012345MTLCAST001S"])
def test_account_numbers_with_letters_are_found_and_go_back(value):
    for text in (value, f"IBAN {value}.", f"{value} AND {IBAN} 12", f"AB12 {value} 1234", f"{value} {CARD}"):
        new, spans = pii.pseudonymise(text, KEY)
        a, b = next((a, b) for kind, a, b in spans if kind == "iban")
        flat = new[a:b].replace(" ", "")
        assert value not in new and IBAN not in new and CARD not in new and pii.pseudonymise(new, KEY, back=True)[0] == text
        assert flat[:2] == value[:2] and pii._iban_value(flat[4:] + flat[:4]) % 97 == 1
        assert [(c.isalpha(), c == " ") for c in new[a:b]] == [(c.isalpha(), c == " ") for c in value]


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("0123456789  -"), min_size=14, max_size=60))
def test_runs_of_numbers_go_back(text):
    new, spans = pii.pseudonymise(text, KEY)
    assert pii.pseudonymise(new, KEY, back=True)[0] == text


def test_days_stay_linked_whatever_their_form():
    for day in range(0, 73_000, 97):
        d = pii.datetime.date.fromordinal(pii.FIRST_DAY + day)
        short = f"{d.day}.{d.month}.{d.year}", f"{d.month}/{d.day}/{d.year}", f"{d.day}/{d.month}/{d.year}"
        forms = [d.strftime(f) for f in ("%Y-%m-%d", "%Y/%m/%d", "%d.%m.%Y", "%m/%d/%Y", *(["%d/%m/%Y"] if d.day > 12 else []))] + list(short[: 3 if d.day > 12 else 2])
        new = [pii.pseudonymise(f, KEY)[0] for f in forms]
        year, month, dom = map(int, new[0].split("-"))
        got = pii.datetime.date(year, month, dom)
        want = [got.strftime(f) for f in ("%Y-%m-%d", "%Y/%m/%d", "%d.%m.%Y", "%m/%d/%Y", *(["%d/%m/%Y"] if d.day > 12 else []))]
        want += [f"{dom}.{month}.{year}", f"{month}/{dom}/{year}", f"{dom}/{month}/{year}"][: 3 if d.day > 12 else 2]
        assert new == want and list(map(len, new)) == list(map(len, forms))
        assert [pii.pseudonymise(n, KEY, back=True)[0] for n in new] == forms


def test_a_domestic_number_has_no_second_nought():
    for k in range(60):
        for text in ("0111-000038 00", "0911 1234567"):
            new, spans = pii.pseudonymise(text, b"%d" % k)
            assert [x[0] for x in spans] == ["domestic"] and new[1] != "0" and pii.pseudonymise(new, b"%d" % k, back=True)[0] == text


def test_domestic_numbers_and_names_beyond_ascii():
    for value in ("020 7946 0958", "07911 123456", "0170 1234567", "jürgen@müller.de", "0301/2345678"):
        new, spans = pii.pseudonymise(f"x {value} y", KEY)
        assert value not in new and len(spans) == 1 and len(new) == len(value) + 4 and pii.pseudonymise(new, KEY, back=True)[0] == f"x {value} y"
    for text in ("in 2020 1234 of 5678", "room 0123 4", "1.0170 1234567"):
        assert pii.pseudonymise(text, KEY) == (text, [])


def test_pseudonyms_against_plain_finders(spark):
    """Values that simple patterns of their own find in the table are gone from the result, and come back with the key."""
    import re

    docs = util.documents(spark, "/root/testdata/sf0.001")
    finders = {
        "email": (r"[a-z0-9._]+@[a-z0-9.]+\.[a-z]{2,}", lambda v: True), "national": (r"\b\d{3}-\d{2}-\d{4}\b", lambda v: v[:3] not in ("000", "666") and v[0] != "9" and v[4:6] != "00" and v[7:] != "0000"),
        "address": (r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?![\d.])", lambda v: all(int(x) < 256 and str(int(x)) == x for x in v.split("."))),
        "card": (r"\b(?:\d{4}[ -]){3}\d{4}\b", lambda v: sum(sum(divmod(int(c) * (2 if k % 2 else 1), 10)) for k, c in enumerate(reversed(re.sub(r"\D", "", v)))) % 10 == 0),
    }
    texts = {r.doc_id: r.text for r in docs.collect()}
    got, n = {r.doc_id: r for r in pii.pseudonyms(docs, KEY).collect()}, 0
    for i, text in texts.items():
        for kind, (pattern, valid) in finders.items():
            for v in filter(valid, re.findall(pattern, text or "")):
                n += 1
                assert v not in got[i].clean_text and kind in {s.kind for s in got[i].spans}
    assert n > 10
    back = {r.doc_id: r.clean_text for r in pii.pseudonyms(spark.createDataFrame([(i, r.clean_text) for i, r in got.items()], "doc_id long, text string"), KEY, back=True).collect()}
    assert back == texts


def test_invalid_values_stay():
    for v in ("12345", "999.1.2.3", "2001-02-30", "666-12-3456", "DE00 3704 0044 0532 0130 00"[:15], "1.2.3.4.5", "", "1.5"):
        assert pii.pseudonymise(v, KEY) == (v, [])


@settings(max_examples=30, deadline=None)
@given(st.integers(1, 300), st.text(max_size=3))
def test_feistel_is_a_permutation(n, tweak):
    got = [pii.feistel(i, n, KEY, tweak) for i in range(n)]
    assert sorted(got) == list(range(n)) and [pii.feistel(g, n, KEY, tweak, back=True) for g in got] == list(range(n))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(VALUES), st.text(st.characters(codec="utf-8"), max_size=12)), max_size=6))
def test_spans_are_where_pseudonyms_are(parts):
    text = " ; ".join(parts)
    new, spans = pii.pseudonymise(text, KEY)
    assert all(0 <= a < b <= len(new) for _, a, b in spans) and all(x[2] <= y[1] for x, y in zip(spans, spans[1:]))


def test_pseudonyms_of_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 1), (2, "", 1), (3, "a 42.144.35.254 b", 1), (4, "c 42.144.35.254", 1), (None, "4387513035237269 " * 3000, 1)], "doc_id long, text string, spans int")
    got = {r.doc_id: r for r in pii.pseudonyms(docs, KEY).collect()}
    assert got[1].clean_text is None and got[2].clean_text == "" and got[None].n_found == 3000
    assert got[3].clean_text.split()[1] == got[4].clean_text.split()[1] != "42.144.35.254"


def literal_dice(text, templates, t):
    """Whether any passage of the text reaches the threshold for each template, by trying all."""
    ws = licenses.words(text)
    bs, found = licenses.bigrams(ws), set()
    for name, template in templates:
        s = set(licenses.bigrams(licenses.words(template)))
        if any(2 * len(set(bs[i:j]) & s) / (len(s) + j - i) >= t for i in range(len(bs)) for j in range(i + 1, len(bs) + 1)):
            found.add(name)
    return found


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from("released under the mit license licensed apache version 2 0 by cc x all rights reserved".split()), max_size=25))
def test_licences_equal_brute_force(ws):
    templates = [("A", "Released under the MIT License."), ("B", "Licensed under the Apache License, Version 2.0."), ("C", "Licensed under CC BY 4.0.")]
    text = " ".join(ws)
    scanner = licenses.Scanner(templates)
    got = scanner.scan(text)
    want = literal_dice(text, templates, 0.8)
    assert bool(got) == bool(want) and {g[0] for g in got} <= want
    assert all(x[3] <= y[2] for x, y in zip(got, got[1:]))


def test_licences_of_odd_rows(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "x\nReleased under the  MIT license.\ny"), (4, "All rights reserved."), (None, "of the and " * 30000)], "doc_id long, text string")
    got = {r.doc_id: (r.license, r.n_found) for r in licenses.license_scan(docs).collect()}
    assert got == {1: (None, 0), 2: (None, 0), 3: ("MIT", 1), 4: ("proprietary", 1), None: (None, 0)}


GNU = "This program is free software{} you can redistribute it and/or modify it under the terms of the GNU {} as published by the Free Software Foundation{} either version {} of the License, or (at your option) any later version."
BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. "
SIBLINGS = [
    ("AGPL-3.0", GNU.format(":", "Affero General Public License", ",", "3")),
    ("GPL-3.0", GNU.format(":", "General Public License", ",", "3")),
    ("LGPL-2.1", GNU.format(";", "Lesser General Public License", ";", "2.1")),
    ("GPL-2.0", GNU.format(";", "General Public License", ";", "2")),
    ("Apache-1.1", "Apache License, Version 1.1"),
    ("BSD-2-Clause", BSD),
    ("BSD-3-Clause", BSD + "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("EPL-2.0", "are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/. This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("Zlib", "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:"),
    ("OFL-1.1", "This Font Software is licensed under the SIL Open Font License, Version 1.1."),
]


def test_sibling_licences_have_their_own_names(spark):
    docs = spark.createDataFrame([(i, f"Copyright 2001 someone. All rights reserved.\n{t}\nint main") for i, (_, t) in enumerate(SIBLINGS)], "doc_id long, text string")
    got = {r.doc_id: (r.license, {f.license for f in r.found} - {"proprietary"}) for r in licenses.license_scan(docs).collect()}
    assert got == {i: (name, {name}) for i, (name, _) in enumerate(SIBLINGS)}
    scanner = licenses.Scanner(licenses.TEMPLATES)
    for name, text in licenses.TEMPLATES:
        assert max(scanner.scan(f"see {text} then"), key=lambda f: f[3] - f[2])[0] == name


@settings(max_examples=40, deadline=None)
@given(st.binary(min_size=1, max_size=2).map(lambda b: (b * 192)[:384] if len(b) == 2 else b * 192))
def test_png_round_trip(payload):
    stored = media.png(payload)
    assert media.png_samples(stored) == payload and media.png_header(stored[: media.HEADER]) == (192, len(payload) // 192, 8)


def test_media_of_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 1), (2, "", 1), (3, "é" * 96, 1), (4, "é" * 96 + "x", 1), (3, "é" * 96, 1), (None, "a" * 100000, 1)], "doc_id long, text string, digest int")
    folder = util.new_folder(spark, "media")
    got = media.media_columns(docs, folder).collect()
    assert len(got) == 6
    names = []
    for r in got:
        t = {1: "", 2: "", 3: "é" * 96, 4: "é" * 96 + "x", None: "a" * 100000}[r.doc_id].encode()
        p = t + b" " * (-len(t) % 192 if t else 192)
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(t), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-16:]))
        stored = media.png(p)
        assert (r.media_bytes, r.media_sha256, r.feature, r.height) == (len(stored), hashlib.sha256(stored).hexdigest(), media.feature(p), len(p) // 192)
        data = open(f"{folder.removeprefix('file://')}/shards/{r.shard}.tar", "rb").read()
        assert data[r.offset : r.offset + len(stored)] == stored
        names += tarfile.open(fileobj=io.BytesIO(data)).getnames()
    assert len({n for n in names}) == 4 and json.dumps(sorted(set(names)))
    assert media.media_columns(docs.limit(0), util.new_folder(spark, "media")).collect() == []
    index = media.write_shards(docs, util.new_folder(spark, "media"))
    assert index.count() == 4
