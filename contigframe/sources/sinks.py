"""Text outputs: TSV, GFF3 (flat and for submission), GenBank flat files, FASTA. Rows are built as columns; ``write_ordered`` stores them."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contigframe.functions import sequence as S
from contigframe.functions import text as T
from contigframe.operators import sequences as Q

SOURCE = "contigframe"
WRAP, INDENT = 58, " " * 21
# Fixed values of the flat files.
UNQUOTED = ("codon_start", "transl_table", "estimated_length", "rpt_type")
ELEMENTS = {"IsElement": "insertion sequence", "Integron": "integron"}
REPEATS = {"Crispr": [("rpt_type", "direct"), ("rpt_family", "CRISPR")], "TandemRepeat": [("rpt_type", "tandem")]}
ORGANISM = "Bacteria"


def write_ordered(lines: DataFrame, path: str, *order: str) -> None:
    """Writes column ``line`` as text in ``order``, over as many files as there are ranges."""
    lines.repartitionByRange(*order).sortWithinPartitions(*order).select("line").write.text(path)


def strand_sign(strand: Column | str) -> Column:
    return F.when(T.col(strand) == 1, "+").when(T.col(strand) == -1, "-").otherwise(".")


def tsv(features: DataFrame) -> DataFrame:
    """(line) contig, id, start, end, strand, kind, best hit "name (accession)", score, E-value; "-", 0.0 and "." without annotation."""
    some = F.col("name").isNotNull()
    hit = F.when(some, F.concat("name", F.lit(" ("), "accession", F.lit(")"))).otherwise("-")
    score = F.when(some, F.format_string("%.1f", F.col("score").cast("double"))).otherwise("0.0")
    evalue = F.when(some & F.col("evalue").isNotNull(), F.format_string("%.2e", F.col("evalue").cast("double"))).otherwise(".")
    return features.select("contig", "s", "id", F.concat_ws("\t", "contig", "id", F.col("s").cast("string"), F.col("e").cast("string"), strand_sign("strand"), "kind", hit, score, evalue).alias("line"))


def _attr(key: str, value: Column) -> Column:
    return F.when(value.isNotNull() & (value != ""), F.concat(F.lit(key + "="), T.percent_encode(value)))


def _list(key: str, values: Column) -> Column:
    """Several values, each encoded, with real commas between them."""
    return F.when(F.size(values) > 0, F.concat(F.lit(key + "="), F.array_join(F.transform(values, lambda x: T.percent_encode(x)), ",")))


def _partial(p5: str, p3: str) -> list[Column]:
    strand = F.col("strand")
    low, high = S.low_partial(strand, F.col(p5), F.col(p3)), S.high_partial(strand, F.col(p5), F.col(p3))
    return [
        F.when(low | high, "partial=true"), F.when(low, F.concat(F.lit("start_range=.,"), F.col("s").cast("string"))), F.when(high, F.concat(F.lit("end_range="), F.col("e").cast("string"), F.lit(",."))),
    ]


def gff_attributes(parent: Column | None = None) -> Column:
    """Column nine of a feature (id, kind, locus_tag, product, gene, xrefs, ec, inferences, go, notes, pseudogene, partial5, partial3, regulatory_class)."""
    kind = F.col("kind")
    gap = kind == "AssemblyGap"
    parts = [
        _attr("ID", F.col("id")), F.when(~gap, _attr("locus_tag", F.col("locus_tag"))), _attr("Parent", parent if parent is not None else F.lit(None).cast("string")), _attr("Name", F.col("product")), _attr("product", F.col("product")),
        _attr("gene", F.when(F.coalesce(F.lower("product"), F.lit("")) != "hypothetical protein", F.col("gene"))),
        F.when(kind == "Cds", "codon_start=1;transl_table=11"), F.when(gap, F.concat(F.lit("estimated_length="), S.len_nt("s", "e").cast("string"), F.lit(";gap_type=within scaffold;linkage_evidence=paired-ends"))),
        F.when(kind == "IsElement", "mobile_element_type=insertion sequence").when(kind == "Integron", "mobile_element_type=integron"),
        F.when(kind == "Crispr", "rpt_type=direct;rpt_family=CRISPR").when(kind == "TandemRepeat", "rpt_type=tandem"),
        F.when(kind == "RegulatoryRegion", F.concat(F.lit("regulatory_class="), F.coalesce("regulatory_class", F.lit("other")))),
        _list("Dbxref", F.col("xrefs")), _list("EC_number", F.filter("ec", lambda x: x != "")), _list("inference", F.col("inferences")), _list("Ontology_term", F.col("go")), _list("Note", F.filter("notes", lambda x: x != "")),
        F.when(F.col("pseudogene"), "pseudo=true"), *_partial("partial5", "partial3"),
    ]
    return F.concat_ws(";", *parts)


def _record(type_: Column, score: Column, phase: Column, attributes: Column) -> Column:
    at = lambda c: F.greatest(c, F.lit(1)).cast("string")
    return F.concat_ws("\t", F.col("contig"), F.lit(SOURCE), type_, at(F.col("s")), at(F.greatest("e", "s")), score, strand_sign("strand"), phase, attributes)


def gff_feature(parent: Column | None = None) -> Column:
    score = F.when(F.col("score").isNotNull() & ~F.isnan(F.col("score").cast("double")), F.col("score").cast("string")).otherwise(".")
    return _record(F.col("so_type"), score, F.when(F.col("kind") == "Cds", "0").otherwise("."), gff_attributes(parent))


def gff_gene(gene_id: Column) -> Column:
    gene = F.when(F.coalesce(F.lower("product"), F.lit("")) != "hypothetical protein", F.col("gene"))
    return _record(F.lit("gene"), F.lit("."), F.lit("."), F.concat_ws(";", _attr("ID", gene_id), _attr("locus_tag", F.col("locus_tag")), _attr("Name", gene), _attr("gene", gene), F.when(F.col("pseudogene"), "pseudo=true"), *_partial("partial5", "partial3")))


def gff3(features: DataFrame) -> DataFrame:
    """(section, contig, ord, part, line): the flat form, one record a feature after the version line."""
    head = features.sparkSession.createDataFrame([(0, "", 0, 0, "##gff-version 3")], "section int, contig string, ord long, part int, line string")
    return head.unionByName(features.select(F.lit(2).alias("section"), "contig", F.col("s").cast("long").alias("ord"), F.lit(0).alias("part"), gff_feature().alias("line")))


def gff3_submission(features: DataFrame, contigs: DataFrame, kinds: DataFrame) -> DataFrame:
    """(section, contig, ord, part, line): regions, then gene and feature records, then the sequences in lines of 70."""
    spark = features.sparkSession
    shape = "section int, contig string, ord long, part int, line string"
    heads = spark.createDataFrame([(0, "", 0, 0, "##gff-version 3"), (3, "", 0, 0, "##FASTA")], shape)
    regions = contigs.select(F.lit(1).alias("section"), "contig", F.lit(0).cast("long").alias("ord"), F.lit(0).alias("part"), F.concat_ws(" ", F.lit("##sequence-region"), "contig", F.lit("1"), F.length("seq").cast("string")).alias("line"))
    known = features.join(F.broadcast(kinds.select("kind", "gene_assoc")), "kind")  # the vocabulary has 14 rows
    gene_id = F.concat(F.lit("gene-"), F.col("locus_tag"))
    both = F.when(F.col("gene_assoc"), F.array(gff_gene(gene_id), gff_feature(gene_id))).otherwise(F.array(gff_feature()))
    body = known.select(F.lit(2).alias("section"), "contig", F.col("s").cast("long").alias("ord"), F.posexplode(both).alias("part", "line"))
    return heads.unionByName(regions).unionByName(body).unionByName(fasta_lines(contigs, 70).select(F.lit(4).alias("section"), "contig", "ord", F.lit(0).alias("part"), "line"))


def fasta_lines(contigs: DataFrame, width: int = 70) -> DataFrame:
    """(contig, ord, line)"""
    rows = F.concat(F.array(F.concat(F.lit(">"), F.col("contig"))), F.regexp_extract_all("seq", F.lit(f".{{1,{width}}}"), 0))
    return contigs.select("contig", F.posexplode(rows).alias("ord", "line")).withColumn("ord", F.col("ord").cast("long"))


def crispr_gff(arrays: DataFrame) -> DataFrame:
    """(contig, s, line) of arrays (contig, id, s, e, repeats), as the finder's own GFF."""
    return arrays.select("contig", "s", F.concat_ws("\t", "contig", F.lit("minced:0.4.2"), F.lit("repeat_region"), F.col("s").cast("string"), F.col("e").cast("string"), F.col("repeats").cast("string"), F.lit("."), F.lit("."), F.concat(F.lit("ID="), "id", F.lit(";rpt_family=CRISPR;rpt_type=direct"))).alias("line"))


def query_regions(cds: DataFrame, contigs: DataFrame, up: int, down: int, least: int) -> DataFrame:
    """``cds`` (contig, s, e, strand, ...) with their surroundings in reading direction: ``lo``, ``hi``, ``edge`` (0 or 1) and the bases, ``sub``."""
    sized = cds.join(contigs.select("contig", F.length("seq").alias("length")), "contig")
    plus = F.col("strand") == 1
    lo = F.greatest(F.when(plus, F.col("s") - up).otherwise(F.col("s") - down), F.lit(1))
    hi = F.least(F.when(plus, F.col("e") + down).otherwise(F.col("e") + up), F.col("length"))
    cut = sized.withColumns({"lo": lo.cast("long"), "hi": hi.cast("long"), "edge": S.contig_edge("s", "e", "length").cast("int")}).where(F.col("hi") - F.col("lo") + 1 >= least)
    own = [c for c in cds.columns if c not in ("contig", "s", "e")]
    spans = cut.select("contig", F.col("lo").alias("s"), F.col("hi").alias("e"), *own, "edge", F.col("s").alias("__s"), F.col("e").alias("__e"))
    got = Q.slices(spans, Q.sequence_chunks(contigs))
    return got.select("contig", F.col("__s").alias("s"), F.col("__e").alias("e"), *own, "edge", F.col("s").alias("lo"), F.col("e").alias("hi"), F.when(plus, F.col("sub")).otherwise(S.revcomp_n("sub")).alias("sub"))


def query_fasta(cds: DataFrame, contigs: DataFrame, up: int, down: int, least: int) -> DataFrame:
    """(name, sub) of CDS (idx, contig, s, e, strand) with their surroundings in reading direction; name idx|start|end|strand|edge."""
    got = query_regions(cds.select("contig", "s", "e", "idx", "strand"), contigs, up, down, least)
    return got.select(F.concat_ws("|", *[F.col(c).cast("string") for c in ("idx", "lo", "hi", "strand", "edge")]).alias("name"), "sub")


def gbff_location() -> Column:
    low, high = S.low_partial(F.col("strand"), F.col("partial5"), F.col("partial3")), S.high_partial(F.col("strand"), F.col("partial5"), F.col("partial3"))
    span = F.concat(F.when(low, "<").otherwise(""), F.col("s").cast("string"), F.lit(".."), F.when(high, ">").otherwise(""), F.col("e").cast("string"))
    return F.when(F.col("strand") == -1, F.concat(F.lit("complement("), span, F.lit(")"))).otherwise(span)


def wrap_qualifier(text: str, head: int = 0, width: int = WRAP) -> list[str]:
    """Lines of at most ``width`` bytes, the first one ``head`` shorter; no character is split."""
    raw, out, at, room = text.encode(), [], 0, max(width - head, 1)
    while len(raw) - at > room:
        end = at + room
        while end > at and raw[end] & 0xC0 == 0x80:
            end -= 1
        if end == at:  # a character that is wider than the line
            end = next((k for k in range(at + 1, len(raw)) if raw[k] & 0xC0 != 0x80), len(raw))
        out.append(raw[at:end].decode())
        at, room = end, width
    return [*out, raw[at:].decode()]


def gbff_origin(contigs: DataFrame) -> DataFrame:
    """(contig, ord, line): 60 bases a line in tens, each line with its first position."""
    rows = contigs.select("contig", F.posexplode(F.regexp_extract_all(F.lower("seq"), F.lit(".{1,60}"), 0)).alias("k", "b"))
    tens = F.array_join(F.regexp_extract_all("b", F.lit(".{1,10}"), 0), " ")
    return rows.select("contig", F.col("k").cast("long").alias("ord"), F.concat(F.lpad((F.col("k") * 60 + 1).cast("string"), 9, " "), F.lit(" "), tens).alias("line"))


def gbff_features(features: DataFrame, kinds: DataFrame) -> DataFrame:
    """(contig, ord, part, line): the feature table's lines. Wrapping counts bytes, so it runs in Arrow batches, row by row in order, without
    gathering a contig in one task."""
    known = features.join(F.broadcast(kinds.select("kind", "gene_assoc")), "kind")
    full = lambda c: F.filter(c, lambda x: x != "")
    aa = F.regexp_replace(F.regexp_replace("aa", r"\*$", ""), r"\.$", "") if "aa" in features.columns else F.lit(None).cast("string")
    rows = known.select(
        "contig", F.col("s").cast("long").alias("ord"), "id", "kind", "so_type", "gene_assoc", "locus_tag", "product", "gene", "pseudogene", F.array_join(full("notes"), "; ").alias("note"), gbff_location().alias("location"),
        S.len_nt("s", "e").alias("length"), F.coalesce("regulatory_class", F.lit("other")).alias("regulatory"), full("ec").alias("ec"), "inferences", F.concat("xrefs", full("go")).alias("xrefs"), aa.alias("aa"),
    )

    def block(key: str, location: str, quals: list[tuple[str, str | None]]) -> list[str]:
        out = ["     " + key.ljust(16) + location]
        for name, value in quals:
            if value is None:
                out.append(f"{INDENT}/{name}")
            elif value and name in UNQUOTED:
                out.append(f"{INDENT}/{name}={value}")
            elif value:
                head = f'/{name}="'
                lines = wrap_qualifier(value.replace('"', '""') + '"', len(head))
                out += [INDENT + head + lines[0], *(INDENT + x for x in lines[1:])]
        return out

    def render(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for r in pdf.itertuples():
                gap = r.kind == "AssemblyGap"
                tag, gene = ("locus_tag", "" if gap else r.locus_tag), ("gene", r.gene or "")
                flag = [("pseudo", None)] if r.pseudogene else []
                lines = block("gene", r.location, [tag, gene, *flag]) if r.gene_assoc else []
                quals = [tag]
                if gap:
                    quals += [("estimated_length", str(r.length)), ("gap_type", "within scaffold"), ("linkage_evidence", "paired-ends")]
                quals += [("mobile_element_type", ELEMENTS[r.kind])] if r.kind in ELEMENTS else REPEATS.get(r.kind, [])
                quals += [gene, ("product", r.product or "")]
                quals += [("regulatory_class", r.regulatory)] if r.kind == "RegulatoryRegion" else []
                quals += [("EC_number", x) for x in r.ec] + [("inference", x) for x in r.inferences] + [("db_xref", x) for x in r.xrefs] + [("note", r.note or "")]
                quals += [("codon_start", "1"), ("transl_table", "11")] if r.kind == "Cds" else []
                quals += flag or [("translation", r.aa or "")]
                lines += block(r.so_type, r.location, quals)
                out += [(r.contig, r.ord, r.id, k, x) for k, x in enumerate(lines)]
            yield pd.DataFrame(out, columns=["contig", "ord", "id", "part", "line"])

    return rows.mapInPandas(render, "contig string, ord long, id string, part int, line string")


def gbff(features: DataFrame, contigs: DataFrame, kinds: DataFrame) -> DataFrame:
    """(contig, section, ord, id, part, line): one flat-file entry per contig; sort by all but ``line`` to write it."""
    size = F.length("seq").cast("string")
    heads = contigs.select("contig", F.lit(0).alias("section"), F.lit(0).cast("long").alias("ord"), F.lit("").alias("id"), F.posexplode(F.array(
        F.concat(F.lit("LOCUS       "), F.rpad(F.substring("contig", 1, 16), 16, " "), F.lit(" "), F.lpad(size, 11, " "), F.lit(" bp    DNA     linear   BCT")), F.concat(F.lit("DEFINITION  "), "contig", F.lit(".")), F.concat(F.lit("ACCESSION   "), "contig"), F.lit("SOURCE      ."),
        F.lit("FEATURES             Location/Qualifiers"), F.concat(F.lit("     source          1.."), size), F.lit(f'{INDENT}/organism="{ORGANISM}"'), F.lit(INDENT + '/mol_type="genomic DNA"'),
    )).alias("part", "line"))
    body = gbff_features(features, kinds).withColumn("section", F.lit(1))
    origin = contigs.select("contig", F.lit(2).alias("section"), F.lit(0).cast("long").alias("ord"), F.lit("").alias("id"), F.lit(0).alias("part"), F.lit("ORIGIN").alias("line"))
    bases = gbff_origin(contigs).select("contig", F.lit(3).alias("section"), "ord", F.lit("").alias("id"), F.lit(0).alias("part"), "line")
    close = contigs.select("contig", F.lit(4).alias("section"), F.lit(0).cast("long").alias("ord"), F.lit("").alias("id"), F.lit(0).alias("part"), F.lit("//").alias("line"))
    return heads.unionByName(body).unionByName(origin).unionByName(bases).unionByName(close)
