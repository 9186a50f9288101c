"""The seed search against brute-force alignment, and tiers on genes broken by hand."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from contigframe.operators import alignment as A
from contigframe.operators import homology, search
from contigframe.operators import sequences as Q
from contigframe.plans import search_queries as P

D = "/root/testdata/sf0.001"
CODON = {"A": "GCT", "R": "CGT", "N": "AAT", "D": "GAT", "C": "TGT", "Q": "CAA", "E": "GAA", "G": "GGT", "H": "CAT", "I": "ATT", "L": "CTT", "K": "AAA", "M": "ATG", "F": "TTT", "P": "CCT", "S": "TCT", "T": "ACT", "W": "TGG", "Y": "TAT", "V": "GTT"}


def plain(q, t, s):
    """Score of the best local alignment, cell by cell."""
    best, above, down = 0, [0] * (len(t) + 1), [-(10**6)] * (len(t) + 1)
    for a in q:
        row, side = [0], -(10**6)
        for j, b in enumerate(t, 1):
            side = max(row[j - 1] - s.gap_open, side - s.gap_more)
            down[j] = max(above[j] - s.gap_open, down[j] - s.gap_more)
            row.append(max(0, above[j - 1] + int(s.table[a, b]), side, down[j]))
        best, above = max(best, *row), row
    return best


@pytest.mark.parametrize("s", [A.PROTEIN, A.DNA], ids=["protein", "dna"])
def test_band_equals_all_cells(s):
    r = random.Random(3)
    letters = A.RESIDUES if s is A.PROTEIN else A.BASES
    queries, targets = [], []
    for _ in range(80):
        t = "".join(r.choice(letters) for _ in range(r.randrange(1, 60)))
        q = list(t)
        for _ in range(r.randrange(8)):
            p, kind = r.randrange(len(q) + 1), r.random()
            q[p : p + (0 if kind < 0.4 else r.randrange(1, 4))] = [r.choice(letters + "N") for _ in range(0 if kind > 0.7 else r.randrange(1, 4))]
        queries.append(s.codes("".join(r.choice(letters) for _ in range(5)) + "".join(q)))
        targets.append(s.codes(t))
    got = A.align(queries, targets, np.full(80, 5), s)
    assert got["score"].tolist() == [plain(q, t, s) for q, t in zip(queries, targets)]
    for k in np.flatnonzero(got["score"] > 0):
        q, t = queries[k][got["qs"][k] : got["qe"][k] + 1], targets[k][got["ts"][k] : got["te"][k] + 1]
        assert plain(q, t, s) == got["score"][k] and got["same"][k] <= min(len(q), len(t)) and max(len(q), len(t)) <= got["length"][k]


def wide(q, refs, s):
    """Best score of a unit in each reference, all cells, over the references side by side."""
    t = np.concatenate([np.append(x, s.pad) for x in refs])
    bounds = np.cumsum([0, *[len(x) + 1 for x in refs[:-1]]])
    n, place = len(t), np.arange(len(t)) + 10**5 * np.cumsum(t == s.pad)  # no gap pays to reach over a separator
    above, down, best = np.zeros(n + 1, np.int64), np.full(n, -(10**6)), np.zeros(n, np.int64)
    for a in q:
        down = np.maximum(above[1:] - s.gap_open, down - s.gap_more)
        cell = np.maximum(np.maximum(above[:-1] + s.table[a, t], down), 0)
        cell[t == s.pad] = 0
        side = np.maximum.accumulate(cell + s.gap_more * place)[:-1] - s.gap_open - s.gap_more * place[:-1]
        cell[1:] = np.maximum(cell[1:], side)
        cell[t == s.pad] = 0
        best, above = np.maximum(best, cell), np.append(0, cell)
    return np.maximum.reduceat(best, bounds)


def test_recall_against_all_alignments(spark):
    r = random.Random(6)
    rows = [(x["contig"], x["seq"]) for x in P.contigs(spark, D).where(F.length("seq").between(100, 2500)).orderBy(F.length("seq").desc(), "contig").limit(8).collect()]
    for x in P.references(spark, D).collect():  # reference genes, changed here and there, on either strand of other bases
        for part in (0.02, 0.06, 0.1):
            q = "".join(r.choice("ACGT") if r.random() < part else r.choice(("", b + "A")) if r.random() < part / 20 else b for b in x["seq"])
            q = "".join(r.choice("ACGT") for _ in range(70)) + q + "".join(r.choice("ACGT") for _ in range(50))
            rows.append((f"{x['t']}/{part}", _reverse(q) if r.random() < 0.5 else q))
    contigs, refs = spark.createDataFrame(rows, "q string, seq string"), P.families(spark, D)
    got = search.SeedSearch("translated", evalue=1e-5).search(contigs, refs)
    pairs = {(r["query"], r["target"]): r["bits"] for r in got.groupBy("query", "target").agg(F.max("bits").alias("bits")).collect()}
    names, seqs = zip(*[(r["t"], r["seq"]) for r in refs.collect() if r["seq"]])
    s, want = A.PROTEIN, {}
    codes, total = [s.codes(x) for x in seqs], float(sum(map(len, seqs)))
    for u in search.query_units(contigs, "translated").collect():
        scores = wide(s.codes(u["letters"]), codes, s)
        for k in np.flatnonzero(s.evalue(scores, np.array(u["qlen"] / 3), total) <= 1e-5):
            want[u["q"], names[k]] = max(want.get((u["q"], names[k]), 0.0), float(s.bits(scores[k])))
    assert len(want) >= 150
    assert sum(p in pairs for p in want) >= 0.9 * len(want)
    assert all(pairs[p] <= want[p] + 1e-9 for p in pairs) and sum(abs(pairs[p] - want[p]) < 1e-9 for p in pairs) >= 0.9 * len(pairs)


def _gene(r, n):
    return "M" + "".join(r.choice(A.RESIDUES) for _ in range(n - 1))


def _coding(aa):
    return "".join(CODON[x] for x in aa)


def _reverse(seq):
    return seq.translate(str.maketrans("ACGT", "TGCA"))[::-1]


@pytest.fixture(scope="module")
def broken(spark):
    """Contigs with a whole gene, a frameshift, an internal stop, a cut transposase on the minus strand, and a gene nobody called."""
    r = random.Random(8)
    noise = lambda n: "".join(r.choice("ACGT") for _ in range(n))
    refs = {k: _gene(r, 150) for k in ("whole", "shifted", "stopped", "cut", "missed")}
    genes = {k: _coding(v) + "TAA" for k, v in refs.items()}
    genes["shifted"] = genes["shifted"][:240] + genes["shifted"][241:]
    genes["stopped"] = genes["stopped"][:231] + "TAA" + genes["stopped"][234:]
    genes["cut"] = _coding(refs["cut"][:70]) + "TAA"
    seq, cds = noise(700), []
    called = {"whole": 453, "shifted": 300, "stopped": 234, "cut": 213}
    for k in refs:
        seq_at = len(seq)
        if k in called:
            n = called[k]
            g = genes[k]
            if k == "cut":
                cds.append((k, "c", seq_at + 1, seq_at + n, -1, 70, True))
                g = _reverse(g)
            else:
                cds.append((k, "c", seq_at + 1, seq_at + n, 1, n // 3 - 1, False))
            seq += g + noise(900)
        else:
            seq += genes[k] + noise(900)
    contigs = spark.createDataFrame([("c", seq), ("short", "ACGT"), ("empty", "")], "contig string, seq string")
    features = spark.createDataFrame(cds, "id string, contig string, s long, e long, strand int, aa_len long, transpos boolean")
    return contigs, features, spark.createDataFrame(list(refs.items()), "t string, seq string"), refs, seq


def test_broken_genes_are_flagged(broken):
    contigs, cds, refs, _, _ = broken
    got = {r["id"]: (r["t"], r["kind"]) for r in homology.disruption_search(cds, contigs, refs).collect()}
    assert got == {"shifted": ("shifted", "frameshift"), "stopped": ("stopped", "internal_stop"), "cut": ("cut", "C-terminal")} or got["cut"][0] == "cut" and {k: v for k, v in got.items() if k != "cut"} == {"shifted": ("shifted", "frameshift"), "stopped": ("stopped", "internal_stop")}
    assert homology.disruption_search(cds, contigs, None) is None


def test_a_missed_gene_is_found(broken):
    contigs, cds, refs, known, seq = broken
    got = homology.intergenic_search(cds, contigs, refs).collect()
    missed = [r for r in got if "family missed" in r["notes"][0]]
    first = seq.index(_coding(known["missed"][:40])) + 1
    assert len(missed) == 1 and (missed[0]["s"], missed[0]["e"], missed[0]["strand"]) == (first, first + 449, 1) and missed[0]["pseudogene"]


def test_proteins_and_their_search(spark, broken):
    contigs, cds, refs, known, _ = broken
    proteins = homology.proteins_of(cds, contigs)
    seqs = {r["q"]: r["seq"] for r in proteins.collect()}
    assert seqs["whole"] == known["whole"] and seqs["cut"] == known["cut"][:70]
    names = refs.select("t", F.concat(F.lit("product "), "t").alias("product"))
    got = {r["q"]: (r["t"], r["product"]) for r in homology.psc_search(proteins, refs, names).collect()}
    assert {k: got[k] for k in ("whole", "cut")} == {"whole": ("whole", "product whole"), "cut": ("cut", "product cut")}
    assert {r["q"] for r in homology.virulence_search(proteins, refs).collect()} == {"whole"}
    odd = spark.createDataFrame([("n", None), ("e", ""), ("x", "XXXXXXXXXXXXXXXXXXXX"), ("a", "A" * 60)], "q string, seq string")
    assert search.SeedSearch("protein").search(odd, refs).collect() == []
    assert search.SeedSearch("protein").search(proteins, refs.limit(0)).collect() == []


def test_nucleotide_hits_on_both_strands_and_over_chunks(spark, monkeypatch):
    monkeypatch.setattr(Q, "SIZE", 400)
    r = random.Random(2)
    ref = "".join(r.choice("ACGT") for _ in range(300))
    noise = "".join(r.choice("ACGT") for _ in range(350))
    contigs = spark.createDataFrame([("p", noise + ref + noise), ("m", noise + _reverse(ref) + noise), ("none", noise)], "contig string, seq string")
    monkeypatch.setattr(Q, "sequence_chunks", lambda c, f=Q.sequence_chunks: f(c, 400, 320))
    refs = spark.createDataFrame([("IncF_1", ref), ("IncF_2", ref[:290]), ("Col_1", ref[100:])], "t string, seq string")
    got = {(x["q"], x["type"]): (x["t"], x["qs"], x["qe"], x["pident"]) for x in homology.plasmid_search(contigs, refs).collect()}
    assert got == {("p", "IncF"): ("IncF_1", 351, 650, 100.0), ("p", "Col"): ("Col_1", 451, 650, 100.0), ("m", "IncF"): ("IncF_1", 351, 650, 100.0), ("m", "Col"): ("Col_1", 351, 550, 100.0)}
    sites = homology.orit_search(contigs, spark.createDataFrame([("p", 9000, 9500)], "contig string, s long, e long"), refs).collect()
    assert {(x["contig"], x["strand"], x["t"], x["near"]) for x in sites} == {("p", 1, "IncF_1", True), ("m", -1, "IncF_1", False)}


def test_a_stored_index_stays_where_it_is(spark, tmp_path, broken):
    contigs, cds, refs, _, _ = broken
    index = search.References.of(refs, "protein").store("test_refs", 4, str(tmp_path / "index"))
    proteins = homology.proteins_of(cds, contigs)
    provider = search.SeedSearch("protein")
    rows = lambda df: sorted(map(str, df.select("query", "target", "bits", "qstart", "tend").collect()))
    assert rows(provider.search(proteins, index, indexed=True)) == rows(provider.search(proteins, refs)) != []
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        units = search.query_units(proteins, "protein").withColumn("unit", F.monotonically_increasing_id())
        plan = search.candidates(units, index, "protein", salted=False)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        for part in ("seeds", "letters"):
            spark.sql(f"drop table test_refs_{part}")
    scan = plan.split("SortMergeJoin")[1]
    assert scan.count("Exchange hashpartitioning(seed") == 1 and "Bucketed: true" in plan  # the queries' side alone


def test_resistance_from_alignments(spark):
    """Four forms of change on proteins, from sequences to notes."""
    from contigframe.operators import landing

    r = random.Random(4)
    ref = _gene(r, 120)
    other = "A" if ref[79] != "A" else "V"
    queries = {"same": ref, "sub": ref[:79] + other + ref[80:], "del1": ref[:59] + ref[60:], "del2": ref[:89] + ref[91:], "stop": ref[:99] + "*" + ref[100:], "far": "".join(r.choice(A.RESIDUES) for _ in range(120))}
    catalog = [("WP_1", f"g_{k}", "DRUG", "gen", ref[p - 1], p, e, alt, span) for k, p, e, alt, span in (("s", 80, "substitution", other, None), ("d", 60, "deletion", None, 1), ("e", 90, "deletion", None, 2), ("n", 100, "nonsense", None, None))]
    table = spark.createDataFrame(catalog, "accession string, symbol string, class string, gene string, ref string, pos long, effect string, alt string, span int")
    refs = spark.createDataFrame([("WP_1", ref), ("WP_2", ref)], "t string, seq string")
    calls = homology.variant_search(spark.createDataFrame(list(queries.items()), "q string, seq string"), refs, table)
    features = landing.functional(spark.createDataFrame([(k, "Cds") for k in queries], "id string, kind string"))
    got = {x["id"]: x["notes"] for x in landing.land_mutations(features, calls).collect()}
    assert got["same"] == got["far"] == [] and got["sub"] == [f"DRUG resistance: point mutation gen {ref[79]}80{other}"] and got["stop"] == [f"DRUG resistance: nonsense gen {ref[99]}100Ter"]
    # a residue beside an equal one may be called deleted in its place: the alignment decides
    assert got["del1"] in ([f"DRUG resistance: deletion gen {ref[59]}60del"], []) and got["del2"] in ([f"DRUG resistance: deletion gen {ref[89]}90del (2 residues)"], [])
    assert got["del1"] or ref[59] in (ref[58], ref[60])


def test_calls_of_proteins_are_scanned_once(spark, broken):
    """Finding calls is the dear part of a protein search; stretches of a chunk and longer ones come from one table of them."""
    contigs, cds, _, known, _ = broken
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    got = homology.proteins_of(cds.mapInArrow(counted, cds.schema), contigs).collect()
    assert len(got) == 4 and seen.value == 4
    odd = spark.createDataFrame([("o", "GTGaaaTTTTAGCCC"), ("n", "ATNCCC")], "contig string, seq string")
    rows = [("a", "o", 1, 15, 1), ("b", "o", 1, 6, 1), ("c", "o", 7, 15, -1), ("d", "n", 1, 6, 1), ("e", "n", 1, 2, 1), ("f", "n", 5, 9, 1)]
    got = homology.proteins_of(spark.createDataFrame(rows, "id string, contig string, s long, e long, strand int"), odd).collect()
    assert {r["q"]: r["seq"] for r in got} == {"a": "MXF", "b": "MX", "c": "GLK", "d": "XP"}


def test_features_round_gaps_are_read_once(spark, broken):
    """The search, its names and its blocks of positions all need them."""
    contigs, cds, refs, _, _ = broken
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    got = homology.intergenic_search(cds.mapInArrow(counted, cds.schema), contigs, refs).collect()
    assert any("family missed" in r["notes"][0] for r in got) and seen.value == 4


def test_few_references_are_met_where_the_units_lie(spark, monkeypatch):
    """Too slow at 6 GB before: all proteins were fetched by a join with contigs, and all their seeds met those of the references by one more."""
    proteins = P.proteins(spark, D).orderBy("q").limit(400)
    refs = P.families(spark, D)
    repeat = [(r["t"], r["seq"]) for r in refs.limit(30).collect()] + [("poly", "ARNDARND" * 40), ("poly", "ARNDARND" * 40), ("short", "MK"), ("none", None)]
    queries = proteins.unionByName(spark.createDataFrame(repeat, "q string, seq string"))
    refs = refs.unionByName(spark.createDataFrame([("polyref", "ARNDARND" * 30), ("empty", "")], "t string, seq string"))
    found = []
    for small in (0, 1 << 21):
        monkeypatch.setattr(search, "SMALL", small)
        found.append(sorted(map(tuple, search.SeedSearch("protein", evalue=1e-3).search(queries, refs).collect())))
    assert found[0] == found[1] and len(found[0]) > 30
    # parts of 50 pairs, in this process
    names, texts = zip(*sorted({(r["t"], r["seq"]) for r in refs.collect()}), strict=True)
    index, own = search.Index(list(names), list(texts), "protein", 6), [x or "" for _, x in repeat]
    met = lambda: sorted(zip(*(np.concatenate(x).tolist() for x in zip(*index.candidates(own))), strict=True))
    whole = met()
    monkeypatch.setattr(search, "PAIRS", 50)
    assert whole == met() != []


def test_proteins_of_calls_without_a_join(spark):
    calls = P.calls(spark, D)
    want = sorted(map(tuple, homology.proteins_of(calls, P.contigs(spark, D)).select("q", "seq").collect()))
    assert sorted(map(tuple, P.proteins(spark, D).select("q", "seq").collect())) == want != []
