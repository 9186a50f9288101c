"""Readers of the text formats of annotation, each over lines (line_no, line) or whole records.

All schemas are explicit, and numbers are parsed with ``try_cast``: a malformed field is null, never an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from contigframe.functions import text as T
from contigframe.operators.intervals import running

M8 = {
    "psc": "query target pident evalue bits qlen tlen qcov tcov",
    "vfdb": "query target pident evalue bits qcov tcov",
    "plasmid": "query target pident qcov tcov qstart qend bits",
    "species": "query target pident evalue bits",
    "alignment": "query target qstart qend tstart tend qaln taln pident evalue bits",
    "orit": "query target pident tcov qstart qend evalue alnlen bits strand",
    "translated": "query target pident evalue bits qstart qend tstart tend tlen qcov tcov",
}
_TEXT = ("query", "target", "qaln", "taln", "strand")
#: Columns without which a row isn't a hit.
_NEEDED = {"psc": 5, "vfdb": 7, "plasmid": 8, "species": 5, "alignment": 11, "orit": 9, "translated": 12}


def read_lines(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """(file, line_no, line): numbers ascend within a file. A plain or gz text; a gz file is one task, so spread it afterwards."""
    lines = spark.read.options(**options).text(path)
    return lines.select(F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("line_no"), F.col("value").alias("line"))


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """(contig, seq) of a FASTA file, plain or gz: records are split at line starts with '>' by the text source itself."""
    return fasta_records(spark.read.option("lineSep", "\n>").text(path).select(F.col("value").alias("record")))


def fasta_records(records: DataFrame) -> DataFrame:
    """(contig, seq) of records without, or the first one with, their '>': the name is the header's first token, bases are upper case."""
    header = F.regexp_replace(F.split("record", "\n", 2)[0], "^>", "")
    body = F.coalesce(F.try_element_at(F.split("record", "\n", 2), F.lit(2)), F.lit(""))
    return records.where(F.trim("record") != "").select(T.first_token(F.trim(F.regexp_replace(header, "\r", ""))).alias("contig"), F.upper(F.regexp_replace(body, r"\s+", "")).alias("seq"))


def fastq_records(lines: DataFrame) -> DataFrame:
    """(contig, seq) of FASTQ lines (record, k, line), four to a record."""
    return lines.groupBy("record").agg(F.max(F.when(F.col("k") == 0, F.col("line"))).alias("h"), F.max(F.when(F.col("k") == 1, F.col("line"))).alias("s")).select(T.first_token(F.regexp_replace("h", "^@", "")).alias("contig"), F.upper("s").alias("seq"))


def duplicate_contigs(contigs: DataFrame) -> DataFrame:
    return contigs.groupBy("contig").agg(F.count("*").alias("n")).where("n > 1")


def protein_headers(headers: DataFrame) -> DataFrame:
    """(id, start, end, strand, partial5, partial3) of gene-caller headers ``id # begin # end # strand # attributes``."""
    p = F.split("header", " # ")
    low, high = (F.regexp_extract(p[4], "partial=([01])([01])", k) == "1" for k in (1, 2))
    minus = p[3].try_cast("int") == -1
    ok = headers.where(F.size(F.split("header", " # ")) >= 5)
    return ok.select(p[0].alias("id"), p[1].try_cast("long").alias("start"), p[2].try_cast("long").alias("end"), p[3].try_cast("int").alias("strand"), F.when(minus, high).otherwise(low).alias("partial5"), F.when(minus, low).otherwise(high).alias("partial3"))


def m8(lines: DataFrame, kind: str) -> DataFrame:
    """Tab-separated hits of one of the layouts in ``M8``, with ``hit_ord``. Rows with too few columns go; identities become percentages (but
    for translated searches), E-values that can't be read are infinite, absent lengths are 0."""
    names, p = M8[kind].split(), F.split("line", "\t")
    at = lambda k: F.try_element_at(p, F.lit(k + 1))
    cols = []
    for k, n in enumerate(names):
        c = at(k) if n in _TEXT else T.parse_evalue(at(k)) if n == "evalue" else at(k).try_cast("double")
        if n == "pident" and kind != "translated":
            c = T.norm_pident(c)
        if n in ("qlen", "tlen", "qcov", "tcov"):
            c = F.coalesce(c, F.lit(0.0))
        cols.append(c.alias(n))
    out = lines.where(F.size(p) >= _NEEDED[kind]).select(F.col("line_no").alias("hit_ord"), *cols).where("pident is not null")
    if kind == "alignment":
        out = out.where("tstart is not null")
    if kind == "plasmid":
        out = out.withColumns({"qstart": F.least("qstart", "qend"), "qend": F.greatest("qstart", "qend")})
    return out


def _fields(lines: DataFrame, least: int) -> tuple[DataFrame, Column]:
    p = F.split("line", "\t")
    return lines.where((F.size(p) >= least) & ~F.col("line").startswith("#")), p


def pgap(lines: DataFrame) -> DataFrame:
    """(acc, bare, product, gene, ec, go, line_no) of a profile table: columns 0, 10, 11, 13, 14; rows without any of the four go."""
    rows, p = _fields(lines, 15)
    out = rows.select("line_no", F.trim(p[0]).alias("acc"), T.strip_version(F.trim(p[0])).alias("bare"), T.nonempty(p[10]).alias("product"), T.nonempty(p[11]).alias("gene"), T.split_multi(p[13]).alias("ec"), T.split_multi(p[14]).alias("go"))
    return out.where((F.col("acc") != "") & (F.col("product").isNotNull() | F.col("gene").isNotNull() | (F.size("ec") > 0) | (F.size("go") > 0)))


def first_by_bare(rows: DataFrame) -> DataFrame:
    """The first row of each accession without version."""
    cols = [c for c in rows.columns if c != "bare"]
    return rows.groupBy("bare").agg(F.min_by(F.struct(*cols), "line_no").alias("r")).select("bare", "r.*")


def ref_lengths(lines: DataFrame) -> DataFrame:
    """(acc, bare, ref_len, line_no): positive lengths of column 5."""
    rows, p = _fields(lines, 6)
    return rows.select("line_no", F.trim(p[0]).alias("acc"), T.strip_version(F.trim(p[0])).alias("bare"), p[5].try_cast("int").alias("ref_len")).where("ref_len > 0")


def pfam2go(lines: DataFrame) -> DataFrame:
    """(acc, go): terms in order of their first line, each once."""
    got = lines.select("line_no", F.regexp_extract("line", r"^Pfam:(PF\d+)", 1).alias("acc"), F.regexp_extract("line", r".*(GO:\d+)", 1).alias("go")).where("acc <> '' and go <> ''")
    once = got.groupBy("acc", "go").agg(F.min("line_no").alias("n"))
    return once.groupBy("acc").agg(F.transform(F.array_sort(F.collect_list(F.struct("n", "go"))), lambda x: x["go"]).alias("go"))


def ko_list(lines: DataFrame) -> DataFrame:
    """(ko, threshold, score_type, ec, definition): threshold "-" is null; a type that isn't full or domain is none."""
    rows, p = _fields(lines, 3)
    kind = F.when(p[2].isin("full", "domain"), p[2]).otherwise("none")
    return rows.where(~F.col("line").startswith("knum")).select(p[0].alias("ko"), F.nullif(p[1], F.lit("-")).try_cast("double").alias("threshold"), kind.alias("score_type"), T.parse_ec(F.element_at(p, -1)).alias("ec"), F.element_at(p, -1).alias("definition"))


def brite(lines: DataFrame) -> DataFrame:
    """(ko, pathway): D rows under the latest C row, if that names a pathway; a C row without one clears it. Each pair once.

    The latest C row is carried by its number: D rows count the C rows before them and join that one.
    """
    w = Window.partitionBy("file").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    tagged = lines.withColumn("tag", F.substring("line", 1, 1)).where("tag in ('C', 'D')").withColumn("section", F.sum((F.col("tag") == "C").cast("int")).over(w))
    heads = tagged.where("tag = 'C'").select("file", "section", F.nullif(F.regexp_extract("line", r"\[PATH:(ko\d+)\]", 1), F.lit("")).alias("pathway"))
    rows = tagged.where("tag = 'D'").select("file", "section", F.regexp_extract("line", r"^D\s+(K\d{5})", 1).alias("ko")).where("ko <> ''")
    return rows.join(heads.where("pathway is not null"), ["file", "section"]).select("ko", "pathway").distinct()


def ko_cog(lines: DataFrame) -> DataFrame:
    rows, p = _fields(lines, 2)
    return rows.select(p[0].alias("ko"), T.cog_mask(p[1]).alias("mask")).where("mask <> 0")


def rfam_types(lines: DataFrame) -> DataFrame:
    rows, p = _fields(lines, 3)
    return rows.select(p[0].alias("acc"), p[1].alias("rfam_type"), p[2].alias("so_type")).where(F.col("so_type").isin("rRNA", "tRNA", "regulatory_region"))


def names_table(lines: DataFrame) -> DataFrame:
    """(id, product): split at the first tab alone."""
    p = F.split("line", "\t", 2)
    return lines.where(F.instr("line", "\t") > 0).select(p[0].alias("id"), p[1].alias("product"))


def mutations(lines: DataFrame) -> DataFrame:
    """(accession, symbol, class, gene, ref, pos, effect, alt, span): gene and change part at the last underscore; other changes go."""
    rows, p = _fields(lines, 6)
    m = T.mutation_spec(F.regexp_extract(p[3], "^(.*)_([^_]*)$", 2))
    got = rows.select(p[1].alias("accession"), p[3].alias("symbol"), p[5].alias("class"), F.regexp_extract(p[3], "^(.*)_([^_]*)$", 1).alias("gene"), m.alias("m")).where("m is not null")
    return got.select("accession", "symbol", "class", "gene", "m.*")


def fasta_subset(records: DataFrame, wanted: DataFrame) -> DataFrame:
    """Records (header, seq) whose first '|' token, or first token, is wanted (accession)."""
    return records.withColumn("accession", F.split(T.first_token("header"), r"\|")[0]).join(wanted.select("accession").distinct(), "accession", "left_semi")


def vfdb_headers(headers: DataFrame) -> DataFrame:
    """(id, gene, description, species) of ``VFGn(gb|acc) (gene) description [category] [species]``; the gene may be absent."""
    h = F.col("header")
    rest = F.regexp_replace(h, r"^VFG\d+(\([^)]*\))?\s*", "")
    gene = F.regexp_extract(rest, r"^\(([^)]*)\)", 1)
    text = F.trim(F.regexp_replace(rest, r"^\([^)]*\)\s*", ""))
    return headers.where(h.rlike(r"^VFG\d+")).select(F.regexp_extract(h, r"^(VFG\d+)", 1).alias("id"), F.nullif(gene, F.lit("")).alias("gene"), F.trim(F.regexp_extract(text, r"^([^\[]*)", 1)).alias("description"), F.regexp_extract(text, r"\[([^\[\]]*)\]\s*$", 1).alias("species"))


def gtdb_headers(headers: DataFrame) -> DataFrame:
    return headers.select(T.first_token("header").alias("id"), F.trim(F.regexp_extract("header", r"(d__.*?)( \[|$)", 1)).alias("lineage")).where("lineage <> ''")


def taxdump_nodes(lines: DataFrame) -> DataFrame:
    p = F.split("line", r"\t\|\t")
    return lines.where(F.size(p) >= 2).select(p[0].try_cast("long").alias("child"), F.regexp_replace(p[1], r"\t\|$", "").try_cast("long").alias("parent")).where("child is not null and parent is not null")


def taxdump_merged(lines: DataFrame) -> DataFrame:
    return taxdump_nodes(lines).select(F.col("child").alias("old"), F.col("parent").alias("new"))


def uniref_headers(headers: DataFrame) -> DataFrame:
    """(id, taxid, product): the product ends before " n=" and a digit; an empty one is uncharacterized."""
    product = F.trim(F.regexp_replace(F.regexp_replace("header", r"^\S+\s*", ""), r"\s*\bn=\d.*$", ""))
    return headers.select(T.first_token("header").alias("id"), F.regexp_extract("header", r"TaxID=(\d+)", 1).try_cast("long").alias("taxid"), F.when(product == "", "uncharacterized protein").otherwise(product).alias("product"))


def uniref_filter(records: DataFrame, taxids: DataFrame) -> DataFrame:
    """Records (id, taxid, product, ...) of accepted taxa (taxid)."""
    return records.join(taxids.select("taxid").distinct(), "taxid", "left_semi")


def hal_list(lines: DataFrame) -> DataFrame:
    """(ord, name): trimmed lines without folders, blank ones dropped, in order."""
    name = F.element_at(F.split(F.trim("line"), r"[/\\]"), -1)
    kept = lines.where(F.trim("line") != "").select("file", "line_no", name.alias("name"))
    return kept.select("file", F.row_number().over(Window.partitionBy("file").orderBy("line_no")).alias("ord"), "name")


def concat_profiles(order: DataFrame, files: DataFrame) -> DataFrame:
    """(ord, content) of the files (name, content) in list order; a listed file that is missing is an error."""
    missing = order.join(files, "name", "left_anti").limit(1).collect()
    if missing:
        raise FileNotFoundError(missing[0]["name"])
    return order.join(files, "name").select("ord", "content").orderBy("ord")


def split_models(lines: DataFrame, start: str = "INFERNAL1") -> DataFrame:
    """(file, model, name, n_lines): records of a text of many models, each from its first line on."""
    w = Window.partitionBy("file").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    numbered = lines.withColumn("model", F.sum(F.col("line").startswith(start).cast("int")).over(w)).where("model > 0")
    return numbered.groupBy("file", "model").agg(F.max(F.when(F.col("line").startswith("NAME"), F.trim(F.substring("line", 5, 1000)))).alias("name"), F.count("*").alias("n_lines"))


def count_models(lines: DataFrame, start: str = "HMMER3/") -> DataFrame:
    return lines.groupBy("file").agg(F.sum(F.col("line").startswith(start).cast("long")).alias("models"))


def checksums(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "length", F.sha2("content", 256).alias("sha256"))


def discover_models(files: DataFrame) -> DataFrame:
    """(path, has_ga) of profile files (path, content), by path: whether the model brings its own gathering threshold."""
    return files.where(F.col("path").endswith(".hmm")).select("path", F.col("content").rlike(r"(?m)^GA ").alias("has_ga")).orderBy("path")


def carry_forward(lines: DataFrame, head: Column, name: str) -> DataFrame:
    """``lines`` (file, line_no, ...) with the latest value of ``head`` up to each line of its file as ``name``; null before the first one."""
    return running(lines, ["file"], "line_no", ["line_no"], head, "last", name)
