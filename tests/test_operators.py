"""Operators whose results depend on order or on bytes, held against literal forms and exact rows."""

import pytest
from pyspark.sql import functions as F

from contigframe.functions import sequence as S
from contigframe.functions import text as T
from contigframe.operators import intervals as I
from contigframe.operators import scans
from contigframe.plans import relations as R
from contigframe.plans.config import Config, find_sidecar, short_reason, validate
from contigframe.plans.scalar_queries import kind_dimension
from contigframe.sources import parsers as P
from contigframe.sources import sinks as K

D = "/root/testdata/sf0.001"
PRIORITY = {"Rrna": 4, "Trna": 3, "Tmrna": 3, "Ncrna": 2}


def conflict(a, b):
    shared = min(a.e, b.e) - max(a.s, b.s) + 1
    return shared > 0 and shared >= 0.5 * (min(a.e - a.s, b.e - b.s) + 1)


def literal_resolve(rows):
    kept = []
    for r in sorted((r for r in rows if r.kind in PRIORITY), key=lambda r: (-PRIORITY[r.kind], -r.score, r.id)):
        if not any(k.contig == r.contig and conflict(r, k) for k in kept):
            kept.append(r)
    cds = [r for r in rows if r.kind == "Cds" and not any(k.contig == r.contig and conflict(r, k) for k in kept)]
    return {r.id for r in kept + cds + [r for r in rows if r.kind not in PRIORITY and r.kind != "Cds"]}


def test_resolve_equals_a_literal_sweep(spark):
    f = R.relation(spark, D, "features").select("contig", "id", "kind", "s", "e", "score")
    rows = f.collect()
    got = {r.id for r in I.resolve(f, kind_dimension(spark)).collect()}
    assert got == literal_resolve(rows) and len(got) < len(rows)
    assert {r.kind for r in rows} == {*PRIORITY, "Cds", "IsElement"}


def test_resolve_rows(spark):
    rows = [("c", "cds", "Cds", 100, 400, 1.0), ("c", "t", "Trna", 150, 220, 1.0), ("d", "cds2", "Cds", 100, 400, 1.0), ("d", "cds3", "Cds", 380, 700, 1.0), ("e", "n1", "Ncrna", 1, 100, 30.0), ("e", "n2", "Ncrna", 10, 90, 90.0), ("f", "is", "IsElement", 1, 500, 1.0), ("f", "cds4", "Cds", 1, 500, 1.0)]
    got = I.resolve(spark.createDataFrame(rows, "contig string, id string, kind string, s long, e long, score double"), kind_dimension(spark)).collect()
    assert {r.id for r in got} == {"t", "cds2", "cds3", "n2", "is", "cds4"}


def test_orit_keeps_the_strongest_of_overlapping(spark):
    rows = [("c", "a", 1, 100, 1e-9, 90.0, 0.9, 40, 50.0, False), ("c", "b", 50, 150, 1e-9, 90.0, 0.9, 40, 60.0, False), ("c", "x", 300, 400, 1e-6, 75.0, 0.55, 30, 5.0, True), ("c", "y", 500, 600, 1e-6, 75.0, 0.55, 30, 5.0, False)]
    got = I.gate_orit(spark.createDataFrame(rows, "contig string, id string, s long, e long, evalue double, pident double, tcov double, alnlen int, bits double, near boolean")).collect()
    assert {r.id for r in got} == {"b", "x"}


@pytest.mark.parametrize("size", [3, 5, 1000])
def test_gaps_across_chunks(spark, size):
    df = spark.createDataFrame([("a", "ACGNNNT"), ("b", "ANNCGNT"), ("c", ""), ("d", "NNNNNNNN"), ("e", "ACGT")], "contig string, seq string")
    got = sorted((r.contig, r.start, r.end) for r in scans.assembly_gaps(df, size).collect())
    assert got == [("a", 4, 6), ("b", 2, 3), ("b", 6, 6), ("d", 1, 8)]


def test_short_orfs_rows(spark):
    seq = "ATG" + "AAA" * 14 + "TAA"
    got = scans.short_orfs(spark.createDataFrame([("a", seq), ("b", "ATG" + "AAA" * 6 + "TAA"), ("c", "ATG" + "AAA" * 48 + "TAA"), ("d", "ATG" + "AAA" * 49 + "TAA"), ("e", "")], "contig string, seq string"), strands=(1,)).collect()
    assert sorted((r.contig, r.start, r.end, r.aa_len) for r in got) == [("a", 1, 48, 15), ("c", 1, 150, 49)]


def test_overlap_join_of_long_intervals(spark):
    df = spark.createDataFrame([("c", "a", 1, 100_000), ("c", "b", 95_000, 300_000), ("c", "x", 300_001, 300_002), ("d", "a2", 1, 100_000)], "contig string, id string, s long, e long")
    got = sorted((r.a_id, r.b_id) for r in I.overlap_join(df, df, F.col("a_id") < F.col("b_id")).collect())
    assert got == [("a", "b")]
    assert sorted(r.id for r in I.overlap_join(df, df.where("id = 'b'"), how="left_anti").collect()) == ["a2", "x"]


def test_revcomp_and_translate(spark):
    row = spark.createDataFrame([("ACGRT",)], "s string").select(S.revcomp_n("s").alias("n"), S.revcomp_keep("s").alias("k"), S.translate(F.lit("ATGTAANNN")).alias("t")).first()
    assert (row.n, row.k, row.t) == ("ANCGT", "ARCGT", "M*X")


def test_tsv_line(spark):
    rows = [("c", "f1", 1, 9, 1, "Cds", "dnaA", "PF1", 12.34, 1e-20), ("c", "f2", 1, 9, 0, "OriC", None, None, None, None)]
    df = spark.createDataFrame(rows, "contig string, id string, s long, e long, strand int, kind string, name string, accession string, score double, evalue double")
    assert [r.line for r in K.tsv(df).orderBy("id").collect()] == ["c\tf1\t1\t9\t+\tCds\tdnaA (PF1)\t12.3\t1.00e-20", "c\tf2\t1\t9\t.\tOriC\t-\t0.0\t."]


def test_wrap_counts_bytes():
    lines = K.wrap_qualifier("é" * 100, 10)
    assert "".join(lines) == "é" * 100 and len(lines[0].encode()) <= 48 and all(len(x.encode()) <= 58 for x in lines)
    assert K.wrap_qualifier("") == [""]


def test_gbff_entry(spark):
    from contigframe.plans.sink_queries import full

    f = full(spark, D).limit(3)
    contigs = f.select("contig").distinct().withColumn("seq", F.lit("ACGTACGTACGT" * 6))
    lines = [r.line for r in K.gbff(f, contigs, kind_dimension(spark)).orderBy("contig", "section", "ord", "id", "part").collect()]
    assert lines[0].startswith("LOCUS       ctg_") and "ORIGIN" in lines and lines[-1] == "//" and any(x.startswith("        1 acgtacgtac gtacgtacgt") for x in lines) and any("61 acgtacgtac gt" in x for x in lines)
    assert all(len(x.encode()) <= 80 for x in lines)


def test_fasta_and_lines(spark, tmp_path):
    (tmp_path / "g.fna").write_text(">c1 first\nacgt\nnn\n>c2\nGG\n")
    assert sorted((r.contig, r.seq) for r in P.read_fasta(spark, str(tmp_path / "g.fna")).collect()) == [("c1", "ACGTNN"), ("c2", "GG")]
    (tmp_path / "t.txt").write_text("a\nb\n")
    assert [r.line for r in P.read_lines(spark, str(tmp_path / "t.txt")).orderBy("line_no").collect()] == ["a", "b"]
    assert P.checksums(spark, str(tmp_path / "t.txt")).first().length == 4
    with pytest.raises(FileNotFoundError):
        P.concat_profiles(spark.createDataFrame([(1, "x")], "ord int, name string"), spark.createDataFrame([], "name string, content string"))


def test_config(tmp_path):
    c = Config(genome=str(tmp_path / "g")).profile("full")
    assert c.full_mode and c.sorf and not Config().profile("fast").full_mode
    with pytest.raises(FileNotFoundError, match="genome"):
        validate(c)
    (tmp_path / "g").write_text("")
    with pytest.raises(ValueError, match="empty"):
        validate(c)
    (tmp_path / "g").write_text(">c")
    (tmp_path / "kofam").mkdir()
    b = c.with_bundle(str(tmp_path))
    validate(b)
    assert set(b.paths) == {"kofam"} and find_sidecar(str(tmp_path), "none") is None and short_reason(FileNotFoundError("missing x")) == "missing database"


def test_percent_encoding(spark):
    assert spark.range(1).select(T.percent_encode(F.lit("a,b;c=d%e f")).alias("x")).first().x == "a%2Cb%3Bc%3Dd%25e f"


def test_genome_stream(spark, tmp_path):
    from contigframe.streaming.jobs import annotate_stream, genome_stream

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.fna").write_text(">c1 x\nACGNNT\n>c2\nNNA\n")
    q = annotate_stream(genome_stream(spark, str(tmp_path / "in")), scans.assembly_gaps, str(tmp_path / "out"), str(tmp_path / "cp"))
    q.awaitTermination(120)
    got = sorted((r.contig, r.start, r.end) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == [("c1", 4, 5), ("c2", 1, 2)]
