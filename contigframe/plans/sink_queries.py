"""Text outputs over derived features; formatted decimals are left to unit tests, as engines round them apart."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contigframe import constants as C
from contigframe.plans import relations as R
from contigframe.plans.registry import query
from contigframe.plans.scalar_queries import kind_dimension
from contigframe.sources import sinks as K

#: Features with everything a flat file shows.
FULL = """(select contig, id, kind, s, e, strand, low_open partial5, high_open partial3, score, cast(s%1000 as varchar(10)) as num,
 case s%4 when 0 then 'hypothetical protein' when 1 then 'DNA ligase; NAD=1, 50%' when 2 then null else 'kinase' end product, case when s%3=0 then null else 'gen'||cast(s%9 as varchar(2)) end gene, s%11=0 pseudogene from {features})"""


def full(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = R.select(spark, sf_dir, f"select * from {FULL} f")
    some = lambda cond, *v: F.when(cond, F.array(*[F.lit(x) for x in v])).otherwise(F.array().cast("array<string>"))
    f = f.withColumns({
        "xrefs": some(F.col("kind") == "Rrna", "RFAM:RF00177"), "ec": some(F.col("s") % 5 == 0, "1.1.1.1", "2.2.2.2"), "inferences": some(F.col("s") % 2 == 0, "protein motif:HMM:Pfam:PF1"),
        "go": some(F.col("s") % 7 == 0, "GO:1", "GO:2"), "notes": some(F.col("s") % 6 == 0, "a, b", "c"), "regulatory_class": F.lit(None).cast("string"), "locus_tag": F.concat(F.lit("CF_"), F.col("num")),
    })
    return f.join(F.broadcast(kind_dimension(spark).select("kind", "so_type")), "kind")


_TYPE = "case kind " + " ".join(f"when '{k}' then '{v[0]}'" for k, v in C.KINDS.items()) + " end"
_LOW, _HIGH = "case when strand = -1 then partial3 else partial5 end", "case when strand = -1 then partial5 else partial3 end"
_ENC = "replace(replace(replace(replace(product, '%', '%25'), ',', '%2C'), ';', '%3B'), '=', '%3D')"
_GENE = "case when coalesce(product, '') <> 'hypothetical protein' then gene end"
_PART = f"case when {_LOW} or {_HIGH} then 'partial=true' end, case when {_LOW} then 'start_range=.,'||s end, case when {_HIGH} then 'end_range='||e||',.' end"
_ATTR = f"""concat_ws(';', 'ID='||id, 'locus_tag=CF_'||num, 'Name='||{_ENC}, 'product='||{_ENC}, 'gene='||{_GENE}, case when kind = 'Cds' then 'codon_start=1;transl_table=11' end, case when kind = 'IsElement' then 'mobile_element_type=insertion sequence' end,
 case when kind = 'Rrna' then 'Dbxref=RFAM:RF00177' end, case when s%5=0 then 'EC_number=1.1.1.1,2.2.2.2' end, case when s%2=0 then 'inference=protein motif:HMM:Pfam:PF1' end, case when s%7=0 then 'Ontology_term=GO:1,GO:2' end, case when s%6=0 then 'Note=a%2C b,c' end, case when pseudogene then 'pseudo=true' end, {_PART})"""


@query("gff_attributes", R.duck(f"select id, {_ATTR} as attributes from {FULL} f"))
def gff_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return full(spark, sf_dir).select("id", K.gff_attributes().alias("attributes"))


_SIGN = "case strand when 1 then '+' when -1 then '-' else '.' end"


@query("sink_gff3", R.duck(f"select concat_ws(chr(9), contig, 'contigframe', {_TYPE}, greatest(s, 1), greatest(e, s, 1), '.', {_SIGN}, case when kind = 'Cds' then '0' else '.' end, {_ATTR}) as line from {FULL} f union all select '##gff-version 3'"))
def sink_gff3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.gff3(full(spark, sf_dir).withColumn("score", F.lit(None).cast("double"))).select("line")


_GENEREC = f"concat_ws(chr(9), contig, 'contigframe', 'gene', greatest(s, 1), greatest(e, s, 1), '.', '.', '.', 'x')".replace("'.', '.', '.', 'x'", f"'.', {_SIGN}, '.', concat_ws(';', 'ID=gene-CF_'||num, 'locus_tag=CF_'||num, 'Name='||{_GENE}, 'gene='||{_GENE}, case when pseudogene then 'pseudo=true' end, {_PART})")


@query("gff_gene_record", R.duck(f"select id, {_GENEREC} as line from {FULL} f"))
def gff_gene_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    return full(spark, sf_dir).select("id", K.gff_gene(F.concat(F.lit("gene-"), F.col("locus_tag"))).alias("line"))


_CHILD = _ATTR.replace("'locus_tag=CF_'||num,", "'locus_tag=CF_'||num, case when kind <> 'IsElement' then 'Parent=gene-CF_'||num end,")


@query("sink_gff3_submission", R.duck(f"""
with f as (select * from {FULL} f), c as (select contig, repeat('ACGTACGTAC', 31)||'T' as seq from (select distinct contig from f))
select concat_ws(chr(9), contig, 'contigframe', {_TYPE}, greatest(s, 1), greatest(e, s, 1), '.', {_SIGN}, case when kind = 'Cds' then '0' else '.' end, {_CHILD}) as line from f
union all select {_GENEREC} from f where kind <> 'IsElement' union all select '##gff-version 3' union all select '##FASTA' union all select '##sequence-region '||contig||' 1 311' from c
union all select '>'||contig from c union all select unnest(regexp_extract_all(seq, '.{{1,70}}')) from c"""))
def sink_gff3_submission(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = full(spark, sf_dir).withColumn("score", F.lit(None).cast("double"))
    contigs = f.select("contig").distinct().withColumn("seq", F.concat(F.repeat(F.lit("ACGTACGTAC"), 31), F.lit("T")))
    return K.gff3_submission(f, contigs, kind_dimension(spark)).select("line")


@query("gbff_location", R.duck(f"select id, case when strand = -1 then 'complement('||l||')' else l end as location from (select id, strand, case when {_LOW} then '<' else '' end||s||'..'||case when {_HIGH} then '>' else '' end||e as l from {FULL} f)"))
def gbff_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    return full(spark, sf_dir).select("id", K.gbff_location().alias("location"))


_ORIGIN = """with c as (select contig, lower(seq) as seq from {contigs}), r as (select contig, seq, unnest(range(0, length(seq), 60)) as k from c)
select contig, cast(k // 60 as bigint) as ord, lpad(cast(k + 1 as varchar), 9, ' ')||' '||concat_ws(' ', nullif(substr(seq, k + 1, 10), ''), nullif(substr(seq, k + 11, 10), ''), nullif(substr(seq, k + 21, 10), ''), nullif(substr(seq, k + 31, 10), ''), nullif(substr(seq, k + 41, 10), ''), nullif(substr(seq, k + 51, 10), '')) as line from r"""


@query("gbff_origin", R.duck(_ORIGIN))
def gbff_origin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.gbff_origin(R.relation(spark, sf_dir, "contigs"))


@query("fasta_lines", R.duck("with c as (select contig, seq, unnest(range(0, length(seq), 70)) as k from {contigs} where seq <> '') select contig, cast(k // 70 + 1 as int) as ord, substr(seq, k + 1, 70) as line from c union all select contig, 0, '>'||contig from {contigs}"))
def fasta_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.fasta_lines(R.relation(spark, sf_dir, "contigs"), 70).select("contig", F.col("ord").cast("int").alias("ord"), "line")


@query("sink_gbff")  # wrapped by bytes: held against literal entries in the tests
def sink_gbff(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = full(spark, sf_dir)
    contigs = f.select("contig").distinct().withColumn("seq", F.repeat(F.lit("ACGTACGTAC"), 31))
    return K.gbff(f, contigs, kind_dimension(spark))


@query("sink_tsv", R.duck(f"select concat_ws(chr(9), contig, id, s, e, {_SIGN}, kind, case when s%3=0 then '-' else coalesce(product, 'x')||' (PF'||num||')' end, case when s%3=0 then '0.0' else (s%1000)||'.'||(s%2*5) end, case when s%3=0 or s%2=0 then '.' else '1.00e-'||lpad((s%7+10)::varchar, 2, '0') end) as line from {FULL} f"))
def sink_tsv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores are halves, so that they print alike in every engine."""
    some = lambda c: F.when(F.col("s") % 3 != 0, c)
    evalue = F.when(F.col("s") % 2 != 0, F.concat(F.lit("1e-"), (F.col("s") % 7 + 10).cast("string")).cast("double"))
    f = R.select(spark, sf_dir, f"select * from {FULL} f").withColumns({"name": some(F.coalesce("product", F.lit("x"))), "accession": F.concat(F.lit("PF"), "num"), "score": F.col("s") % 1000 + F.col("s") % 2 / 2, "evalue": evalue})
    return K.tsv(f).select("line")


@query("sink_crispr_gff", R.duck("select concat_ws(chr(9), contig, 'minced:0.4.2', 'repeat_region', s, e, s % 9, '.', '.', 'ID='||id||';rpt_family=CRISPR;rpt_type=direct') as line from {features} where kind = 'IsElement'"))
def sink_crispr_gff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.crispr_gff(R.relation(spark, sf_dir, "features").where("kind = 'IsElement'").withColumn("repeats", F.col("s") % 9)).select("line")


_RCN = "reverse(translate(regexp_replace(x, '[^ACGT]', 'N', 'g'), 'ACGT', 'TGCA'))"


@query("sink_query_fasta", R.duck(f"""
with c as (select contig, seq, length(seq) as n from {{contigs}}), f as (select contig, id, s, e, strand from {{features}} where kind = 'Cds' and s > 0),
w as (select f.*, seq, n, greatest(case when strand = 1 then s - 60 else s - 450 end, 1) as lo, least(case when strand = 1 then e + 450 else e + 60 end, n) as hi from f join c on c.contig = f.contig),
x as (select *, substr(seq, lo, hi - lo + 1) as x from w where hi - lo + 1 >= 30)
select concat_ws('|', id, lo, hi, strand, case when s <= 3 or e >= n - 3 then 1 else 0 end) as name, md5(case when strand = 1 then x else {_RCN} end) as digest from x"""))
def sink_query_fasta(spark: SparkSession, sf_dir: str) -> DataFrame:
    cds = R.relation(spark, sf_dir, "features").where("kind = 'Cds' and s > 0").withColumn("idx", F.col("id"))
    got = K.query_fasta(cds, R.relation(spark, sf_dir, "contigs"), C.QUERY_UP, C.QUERY_DOWN, C.QUERY_MIN)
    return got.select("name", F.md5("sub").alias("digest"))


@query("sink_summary", R.duck("select kind, count(*) as n, min(s) as first, max(e) as last from {features} group by 1"))
def sink_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.relation(spark, sf_dir, "features").groupBy("kind").agg(F.count("*").alias("n"), F.min("s").alias("first"), F.max("e").alias("last"))


