"""The command line on files: a genome with a replicon, and a cluster build from a taxonomy dump."""

import random

import pytest
from test_genes import genome

from contigframe.__main__ import configured, main, parser
from contigframe.plans.config import Config


def test_options():
    args = parser().parse_args(["annotate", "g.fna", "--out", "o", "--fast", "-g", "4", "--gene-score", "--plasmid", "p"])
    config = configured(args)
    assert config.gaps and config.pseudo and config.gene_score and not config.localization and config.genetic_code == 4 and config.paths == {"plasmid": "p"}
    assert configured(parser().parse_args(["annotate", "g", "--out", "o"])) == Config(genome="g")
    with pytest.raises(SystemExit):
        parser().parse_args(["annotate", "g", "--out", "o", "-g", "99"])


def text(folder):
    return "".join(p.read_text() for p in sorted(folder.glob("part-*")))


def test_a_genome_from_file_to_files(spark, tmp_path, capsys):
    seq, want = genome(3)
    r = random.Random(2)
    rep = "".join(r.choice("ACGT") for _ in range(300))
    (tmp_path / "g.fna").write_text(f">chr one\n{seq}\n>plasmid\n{rep}{'N' * 20}{rep[:50]}\n>plasmid\nACGT\n")
    (tmp_path / "plasmids").mkdir()
    (tmp_path / "plasmids" / "inc.fsa").write_text(f">IncX_1\n{rep}\n")
    assert main(["annotate", str(tmp_path / "g.fna"), "--out", str(tmp_path / "out"), "--fast", "--plasmid", str(tmp_path / "plasmids")]) == 0
    said = capsys.readouterr()
    assert "warning: 2 sequences are called plasmid" in said.err
    assert "plasmid replicons: 1" in said.out and "plasmid: IncX (100.0 %, 1..300)" in said.out and "skipped: intergenic (missing database), pseudogene (missing database)" in said.out
    table = [x.split("\t") for x in text(tmp_path / "out" / "tsv").splitlines()]
    cds = [x for x in table if x[5] == "Cds"]
    assert 0.9 * len(want) <= len(cds) <= 1.3 * len(want) and [x[5] for x in table if x[0] == "plasmid"] == ["AssemblyGap"]
    gff, flat = text(tmp_path / "out" / "gff3"), text(tmp_path / "out" / "gbff")
    assert gff.startswith("##gff-version 3") and gff.count("\tCDS\t") == len(cds) and flat.count("/translation=") == len(cds) and flat.count("LOCUS") == 3 and flat.rstrip().endswith("//")


def test_cluster_build(spark, tmp_path):
    (tmp_path / "nodes.dmp").write_text("".join(f"{c}\t|\t{p}\t|\tx\t|\n" for c, p in ((2, 1), (10, 2), (11, 10), (9606, 1), (1, 1))))
    (tmp_path / "merged.dmp").write_text("77\t|\t11\t|\n")
    (tmp_path / "u.fasta").write_text("".join(f">UniRef90_{k} {name} n=1 Tax=x TaxID={t} RepID=z\nMKV\nLL{k}\n" for k, name, t in (("A", "Kinase", 11), ("B", "Human thing", 9606), ("C", "Old one", 77))))
    assert main(["build-psc", "--clusters", str(tmp_path / "u.fasta"), "--nodes", str(tmp_path / "nodes.dmp"), "--merged", str(tmp_path / "merged.dmp"), "--out", str(tmp_path / "psc")]) == 0
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "psc" / "names")).select("t", "product").collect())) == [("UniRef90_A", "Kinase"), ("UniRef90_C", "Old one")]
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "psc" / "proteins")).collect())) == [("UniRef90_A", "MKVLLA"), ("UniRef90_C", "MKVLLC")]
    ids = text(tmp_path / "psc" / "taxids").split()
    assert ids == sorted(ids, key=int) and {"2", "10", "11", "77", "2157"} <= set(ids) and "9606" not in ids
