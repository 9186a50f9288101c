"""Sequence files against a literal reader, in many splits and chunks."""

import gzip
import random

import pytest

from contigframe.operators import sequences as Q
from contigframe.sources import sequence_files as F


def literal(text):
    if text.startswith("@"):
        lines = [x.strip() for x in text.splitlines() if x.strip()]
        return [(lines[k][1:].split()[0], lines[k + 1].upper()) for k in range(0, len(lines), 4)]
    out = []
    for line in text.splitlines():
        if line.startswith(">"):
            out.append([line[1:].split()[0], ""])
        elif out:
            out[-1][1] += "".join(line.split()).upper()
    return [tuple(x) for x in out]


def joined(rows):
    out = {}
    for r in sorted(rows, key=lambda r: r["chunk"]):
        key = r["file"], r["record"], r["contig"]
        out[key] = out.get(key, "") + r["bases"]
    return sorted((c, s) for (_, _, c), s in out.items())


@pytest.fixture
def splits(spark):
    """Files are cut every few hundred bytes."""
    conf = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "0"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("size", [50, 333, Q.SIZE])
def test_files_equal_a_literal_reader(spark, tmp_path, splits, size):
    r = random.Random(size)
    bases = lambda n: "".join(r.choice("ACGTNacgt") for _ in range(n))
    wrapped = lambda s, w: "\n".join(s[k : k + w] for k in range(0, len(s), w))
    texts = {
        "a.fna": "junk before\n" + "".join(f">c{k} some words\n{wrapped(bases(n), 60)}\n" for k, n in enumerate((900, 0, 61, 2500, 7))),
        "b.fna": ">crlf x\r\nAC GT\r\nNN\r\n\r\n>last\r\nA", "c.fna": f">one\n{bases(4000)}\n", "reads.fastq": "".join(f"@r{k} d\n{bases(40)}\n+\n{'@' * 40}\n" for k in range(30)),
    }
    for name, text in texts.items():
        (tmp_path / name).write_text(text, newline="")
    with gzip.open(tmp_path / "z.fna.gz", "wt") as f:
        f.write(texts["a.fna"].replace(">c", ">z"))
    texts["z"] = texts["a.fna"].replace(">c", ">z")
    rows = F.read_sequences(spark, str(tmp_path), size).collect()
    assert joined(rows) == sorted(x for t in texts.values() for x in literal(t))
    assert all(len(x["bases"]) <= size for x in rows) and (size == Q.SIZE or max(x["chunk"] for x in rows) >= 2500 // size)


def test_halo_slices_and_duplicates(spark, tmp_path):
    r = random.Random(1)
    seq = "".join(r.choice("ACGT") for _ in range(500))
    (tmp_path / "g.fna").write_text(f">g\n{seq}\n>twice\nA\n>twice\nC\n")
    rows = F.read_sequences(spark, str(tmp_path / "g.fna"), 100)
    chunks = F.with_halo(rows, 30)
    spans = spark.createDataFrame([("g", 91, 120), ("g", 5, 480), ("g", 490, 600)], "contig string, s long, e long")
    got = sorted((x["s"], x["sub"]) for x in Q.slices(spans, chunks, size=100, halo=30).collect())
    assert got == [(5, seq[4:480]), (91, seq[90:120]), (490, seq[489:])]
    assert [tuple(x) for x in F.duplicates(rows).collect()] == [("twice", 2)]


def test_replicons_below_a_folder(spark, tmp_path):
    (tmp_path / "deep").mkdir()
    (tmp_path / "x.fsa").write_text(">IncF_1\nACGT\nAA\n")
    (tmp_path / "deep" / "y.fsa").write_text(">Col_2 x\nGG\n")
    (tmp_path / "no.txt").write_text(">z\nA\n")
    assert sorted(map(tuple, F.read_replicons(spark, str(tmp_path)).collect())) == [("Col_2", "GG"), ("IncF_1", "ACGTAA")]
