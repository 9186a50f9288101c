"""Gates, best hits, enrichment and disruption over hits and annotations derived from line items and parts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contigframe import constants as C
from contigframe.functions import text as T
from contigframe.operators import hits as H
from contigframe.operators import landing as L
from contigframe.plans import relations as R
from contigframe.plans.registry import query
from contigframe.plans.scalar_queries import MARKS, QC_PRODUCTS, varied


def rel(name: str):
    return lambda spark, sf_dir: R.relation(spark, sf_dir, name)


def over(name: str, source: str, f, oracle: str) -> None:
    """A query over one relation (a name or SQL)."""

    @query(name, R.duck(oracle))
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return f(R.select(spark, sf_dir, f"select * from {source} x"))


HITS, ANN = "{hits}", "{annotations}"
over("psc_gate", HITS, lambda h: h.where(H.psc_gate()).select("q", "t", "ex"), "select q, t, ex from {hits} where pident >= 50 and ex >= 6")
over("vfdb_gate", HITS, lambda h: h.where(H.vf_gate()).select("q", "t", "ex"), "select q, t, ex from {hits} where ex >= 10 and qcov >= 0.8 and tcov >= 0.7 and pident >= 90")
over("plasmid_gate", HITS, lambda h: h.where(H.plasmid_gate()).select("q", "t", "ex"), "select q, t, ex from {hits} where pident >= 80 and tcov >= 0.6")
over("amr_gate", HITS, lambda h: h.where(H.amr_gate()).select("q", "t", "ex"), "select q, t, ex from {hits} where pident >= 90")
over("ncrna_gate", HITS, lambda h: h.where(F.when(F.col("t") % 4 == 0, F.col("qcov") >= C.RRNA_MIN_COVERAGE).otherwise(F.col("evalue") <= C.NCRNA_MAX_EVALUE)).select("q", "t", "ex"), "select q, t, ex from {hits} where (t % 4 = 0 and qcov >= 0.3) or (t % 4 <> 0 and ex >= 4)")
over("best_hit_per_query", HITS, lambda h: H.best_hits(h.where("pident >= 70 and ex >= 2")).select("q", "t", "bits", "ex"), "select q, t, bits, ex from {hits} where pident >= 70 and ex >= 2 qualify row_number() over (partition by q order by bits desc, ex desc, ord) = 1")
over("best_hit_ties", HITS, lambda h: H.best_hits(h.withColumns({"bits": F.floor(F.col("bits") / 50000), "evalue": F.lit(1.0)})).select("q", "t", "ord"), "select q, t, ord from {hits} qualify row_number() over (partition by q order by floor(bits / 50000) desc, ord) = 1")
over("best_per_contig_type", HITS, lambda h: H.best_by(h.withColumn("type", F.col("t") % 7), ["q", "type"], -F.col("bits"), F.col("ord")).select("q", "type", "t", "bits"), "select q, t % 7 as type, t, bits from {hits} qualify row_number() over (partition by q, t % 7 order by bits desc, ord) = 1")
over("best_overall", HITS, lambda h: H.best_overall(h).select("q", "t", "bits"), "select q, t, bits from {hits} order by bits desc, ex desc, q, ord limit 1")
over("primary_target", HITS, lambda h: H.primary_target(h).select("q", "t", "ex"), "select q, t, ex from {hits} qualify row_number() over (partition by q order by ex desc, ord) = 1")
over("best_annotation", ANN, lambda a: H.best_annotation(a).select("fid", "accession", "ord"), "select fid, accession, ord from {annotations} qualify row_number() over (partition by fid order by score desc, ord desc) = 1")
over("best_anchor", ANN, lambda a: H.best_by(a.where("source = 'hmm:ncbifams'"), ["fid"], -F.col("score"), F.col("ord")).select("fid", "accession"), "select fid, accession from {annotations} where source = 'hmm:ncbifams' qualify row_number() over (partition by fid order by score desc, ord) = 1")
over("rank_annotations", ANN, lambda a: H.rank_annotations(a).select("fid", "ord", "rank"), "select fid, ord, cast(row_number() over (partition by fid order by score desc, ord) as int) as rank from {annotations}")
over("species_ranks", HITS, lambda h: h.select("q", "t", "ex", H.supported_rank(F.col("pident") + 0.5).alias("rank")), "select q, t, ex, case when pident + 0.5 >= 98.7 then 'species' when pident + 0.5 >= 94.5 then 'genus' else 'family' end as rank from {hits}")
over("relaxase_gate", HITS, lambda h: h.where((F.col("t") % 3 == 0) | (F.col("evalue") <= C.RELAXASE_MAX_EVALUE)).select("q", "t", "ex"), "select q, t, ex from {hits} where t % 3 = 0 or ex >= 6")
over("attc_search", HITS, lambda h: h.where(H.attc_gate()).select("q", "t", "ex"), "select q, t, ex from {hits} where ex >= 3")
#: Annotations whose accessions are those of hallmark families, and others.
PHAGE = "(select fid, score, ord, case cast(substr(accession,3,5) as int)%9 when 0 then 'PF03354.2' when 1 then 'PF05136' when 2 then 'PF05065.1' when 3 then 'PF04586' when 4 then 'PF04865.7' when 5 then 'PF00589' when 6 then 'PF00959.3' else accession end accession from {annotations})"
_PHAGE_CLASS = "case split_part(accession, '.', 1) when 'PF03354' then 'terminase' when 'PF05136' then 'portal' when 'PF05065' then 'capsid' when 'PF04586' then 'protease' when 'PF04865' then 'tail' when 'PF00589' then 'integrase' when 'PF00959' then 'lysis' end"
over("best_hallmark", PHAGE, lambda a: H.best_by(a.withColumn("cls", T.hallmark_class(F.lit(""), "accession")).where("cls is not null"), ["fid"], -F.col("score"), F.col("ord")).select("fid", "cls"),
     f"select fid, cls from (select *, {_PHAGE_CLASS} as cls from {PHAGE}) where cls is not null qualify row_number() over (partition by fid order by score desc, ord) = 1")
over("min_opt", HITS, lambda h: H.least_value(h, ["t"], F.when(F.col("ex") % 4 == 0, F.col("bits")), "least"), "select t, min(bits) filter (ex % 4 = 0) as least from {hits} group by t")


@query("attach_hits", R.duck("select o.o_orderkey as fid, count(a.fid) as n, string_agg(a.accession, ',' order by a.ord) as accessions from orders o left join {annotations} a on a.fid = o.o_orderkey group by 1"))
def attach_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    cds = R.select(spark, sf_dir, "select o_orderkey fid from orders")
    joined = H.attach_hits(cds, R.relation(spark, sf_dir, "annotations").select("fid", "ord", "accession"))
    return joined.select("fid", F.size("annotations").cast("long").alias("n"), F.nullif(F.array_join(F.col("annotations.accession"), ","), F.lit("")).alias("accessions"))


_XREF = "select 'PF'||lpad(cast(p_partkey%500 as varchar(10)),5,'0')||case when p_partkey%3=0 then '.'||cast(p_partkey%7+1 as varchar(3)) else '' end acc, case when min(p_size)%5=0 then null else min(p_name) end product, case when min(p_size)%3=0 then ' ' else min(p_brand) end gene from part group by 1"
_KNOWN = "k as (select acc, nullif(trim(product), '') as product, nullif(trim(gene), '') as gene from (" + _XREF.replace("group by 1", "group by all") + ") where nullif(trim(product), '') is not null or nullif(trim(gene), '') is not null)"


@query("xref_enrich", R.duck(f"""with {_KNOWN}, a as (select * from {{annotations}}),
j as (select fid, accession, score, ord, e.acc is not null as exact, coalesce(e.product, case when e.acc is null then b.product end) as product, coalesce(e.gene, case when e.acc is null then b.gene end) as gene from a left join k e on e.acc = accession left join k b on b.acc = split_part(accession, '.', 1))
select fid, accession, product, gene from j where product is not null or gene is not null qualify row_number() over (partition by fid order by score desc, ord) = 1"""))
def xref_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    return H.xref_enrich(R.relation(spark, sf_dir, "annotations"), R.select(spark, sf_dir, _XREF))


_GO = "(select 'PF'||lpad(cast(p_partkey%500 as varchar(10)),5,'0') acc, 'GO:'||cast(p_size as varchar(5)) go from part)"


@query("pfam_go_merge", R.duck(f"select fid, string_agg(distinct go, ',' order by go) as go from {{annotations}} a join {_GO} g on g.acc = split_part(accession, '.', 1) group by 1"))
def pfam_go_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return H.pfam_go_merge(R.relation(spark, sf_dir, "annotations"), R.select(spark, sf_dir, f"select * from {_GO} g")).select("fid", F.array_join("go", ",").alias("go"))


_KOHITS = "(select cast(l_orderkey as bigint) fid, 'K'||lpad(cast(l_partkey%300 as varchar(10)),5,'0') ko, l_quantity*10 seq_score, l_quantity*9 dom_score, cast(row_number() over (partition by l_orderkey order by l_linenumber,l_partkey,l_suppkey,l_extendedprice,l_shipdate) as int) ord from lineitem)"
_KOLIST = "(select 'K'||lpad(cast(p_partkey as varchar(10)),5,'0') ko, case when p_size%9=0 then null else cast(p_size*8 as double) end threshold, case p_size%4 when 0 then 'full' when 1 then 'domain' when 2 then 'full' else 'none' end score_type from part)"


@query("kofam_assign", f"""with j as (select h.*, threshold, case when score_type = 'full' then seq_score else dom_score end as score from {_KOHITS} h join {_KOLIST} k on k.ko = h.ko where threshold is not null and score_type <> 'none')
select fid, ko, score - threshold as margin, score from j where score >= threshold qualify row_number() over (partition by fid order by score - threshold desc, score desc, ord) = 1""")
def kofam_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return H.kofam_assign(R.select(spark, sf_dir, f"select * from {_KOHITS} h"), R.select(spark, sf_dir, f"select * from {_KOLIST} k"))


@query("best_ko", f"with j as (select fid, h.ko, seq_score - threshold as margin from {_KOHITS} h join {_KOLIST} k on k.ko = h.ko where score_type = 'full' and seq_score >= threshold) select fid, max(margin) as margin from j group by 1")
def best_ko(spark: SparkSession, sf_dir: str) -> DataFrame:
    return H.kofam_assign(R.select(spark, sf_dir, f"select * from {_KOHITS} h"), R.select(spark, sf_dir, f"select * from {_KOLIST} k where score_type = 'full'")).select("fid", "margin")


@query("needs_psc", R.duck("select pid, product is null or lower(trim(product)) in ('', 'hypothetical protein', 'uncharacterized protein', 'putative protein', 'protein of unknown function') as needs from {proteins}"))
def needs_psc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.relation(spark, sf_dir, "proteins").select("pid", H.needs_psc("product", F.lit("MK")).alias("needs"))


@query("names_semi", R.duck("select pid as id, product from {proteins} where pid in (select t from {hits} where ex >= 12)"))
def names_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = R.relation(spark, sf_dir, "hits").where("ex >= 12").select(F.col("t").alias("id"))
    return H.names_for(R.relation(spark, sf_dir, "proteins").select(F.col("pid").alias("id"), "product"), wanted)


@query("psc_annotate", R.duck("""with b as (select q, t from {hits} where pident >= 50 and ex >= 6 qualify row_number() over (partition by q order by bits desc, ex desc, ord) = 1)
select q, t, case when product is null or lower(trim(product)) = 'hypothetical protein' then 'hypothetical protein' else trim(product) end as product from b join {proteins} on pid = t"""))
def psc_annotate(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = H.best_hits(R.relation(spark, sf_dir, "hits").where(H.psc_gate()))
    return best.join(R.relation(spark, sf_dir, "proteins").select(F.col("pid").alias("t"), "product"), "t").select("q", "t", T.clean_product(F.coalesce("product", F.lit(""))).alias("product"))


@query("vf_join", R.duck("""with b as (select q, t from {hits} where ex >= 10 and qcov >= 0.8 and tcov >= 0.7 and pident >= 90 qualify row_number() over (partition by q order by bits desc, ex desc, ord) = 1)
select q, 'virulence factor: ' || coalesce(product, acc) as note from b join {proteins} on pid = t"""))
def vf_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = H.best_hits(R.relation(spark, sf_dir, "hits").where(H.vf_gate()))
    return best.join(R.relation(spark, sf_dir, "proteins").withColumnRenamed("pid", "t"), "t").select("q", F.concat(F.lit("virulence factor: "), F.coalesce("product", "acc")).alias("note"))


@query("amr_catalog_join", R.duck("select q, t, p_size as pos from {hits} join {proteins} on pid = t where pident >= 90"))
def amr_catalog_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    catalog = R.relation(spark, sf_dir, "proteins").select(F.col("pid").alias("t"), F.col("p_size").alias("pos"))
    return H.amr_sites(R.relation(spark, sf_dir, "hits"), catalog).select("q", "t", "pos")


_RFAM = "(select distinct 'PF'||lpad(cast(p_partkey%500 as varchar(10)),5,'0') acc, case p_partkey%500%6 when 0 then 'Gene; rRNA;' when 1 then 'Gene; tRNA;' when 2 then 'Cis-reg; riboswitch;' when 3 then 'Cis-reg; leader;' when 4 then 'Cis-reg;' else 'Gene; sRNA;' end rfam_type, case p_partkey%500%6 when 0 then 'rRNA' when 1 then ' tRNA' when 2 then 'regulatory_region' when 3 then 'regulatory_region ' when 4 then 'regulatory_region' else 'ncRNA' end so_type from part where p_partkey%500 < 400)"


def annotated(spark: SparkSession, sf_dir: str, kind: str = "'Cds'") -> DataFrame:
    """Orders as features, with the annotations that landed on them."""
    a = R.relation(spark, sf_dir, "annotations").groupBy("fid").agg(F.array_sort(F.collect_list(F.struct("ord", F.struct("source", "accession", F.concat(F.lit("name of "), F.col("accession")).alias("name"), F.col("score").cast("double").alias("score")).alias("a")))).alias("l"))
    base = R.select(spark, sf_dir, f"select cast(o_orderkey as bigint) id, {kind} kind, case when o_custkey%4=0 then o_orderpriority end product, case when o_custkey%3=0 then 'gen'||cast(o_custkey%100 as varchar(5)) when o_custkey%3=1 then '' end gene from orders")
    joined = base.join(a.withColumnRenamed("fid", "id"), "id", "left")
    return L.functional(joined.withColumn("annotations", F.coalesce(F.transform("l", lambda x: x["a"]), F.array().cast(f"array<{L.ANNOTATION}>"))).drop("l"))


_NC = "case when o_custkey%5=0 then 'Cds' else 'Ncrna' end"


@query("rfam_reclass", R.duck(f"""with f as (select o_orderkey as id, {_NC} as kind from orders), c as (select fid, split_part(accession, '.', 1) as acc from {{annotations}} where source = 'cm' qualify row_number() over (partition by fid order by ord) = 1)
select id, case when kind = 'Ncrna' and trim(so_type) = 'rRNA' then 'Rrna' when kind = 'Ncrna' and trim(so_type) = 'tRNA' then 'Trna' when kind = 'Ncrna' and trim(so_type) = 'regulatory_region' then 'RegulatoryRegion' else kind end as kind,
case when kind = 'Ncrna' and trim(so_type) = 'regulatory_region' then case when contains(rfam_type, 'riboswitch') then 'riboswitch' when contains(rfam_type, 'leader') then 'attenuator' else 'other' end end as regulatory_class
from f left join c on c.fid = f.id left join {_RFAM} r on r.acc = c.acc"""))
def rfam_reclass(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.reclassify_ncrna(annotated(spark, sf_dir, _NC), R.select(spark, sf_dir, f"select * from {_RFAM} r")).select("id", "kind", "regulatory_class")


_BEST = "b as (select fid, accession, source, score from {annotations} qualify row_number() over (partition by fid order by score desc, ord desc) = 1)"


@query("output_values", R.duck(f"""with {_BEST}, f as (select o_orderkey as id, case o_custkey%4 when 1 then 'Rrna' when 2 then 'Trna' when 3 then 'Ncrna' else 'Cds' end as kind, case when o_custkey%4=0 then o_orderpriority end as product, case when o_custkey%3=0 then 'gen'||cast(o_custkey%100 as varchar) end as gene from orders),
j as (select f.*, b.accession, b.accession as b_acc, source, coalesce(product, 'name of '||b.accession) as shown from f left join b on b.fid = f.id)
select id, case when kind = 'Trna' and shown is not null then 'tRNA-Xxx' when kind = 'Cds' then coalesce(shown, 'hypothetical protein') else shown end as product, case when kind = 'Cds' and shown is null then null else gene end as gene,
case when source = 'hmm:pfam' then 'protein motif:HMM:Pfam:'||accession when source = 'hmm:ncbifams' then 'protein motif:HMM:NCBIfam:'||accession else '' end as inference, case when source = 'cm' then 'RFAM:RF'||substr(b_acc, 3) else '' end as dbxref from j"""))
def output_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = annotated(spark, sf_dir, "case o_custkey%4 when 1 then 'Rrna' when 2 then 'Trna' when 3 then 'Ncrna' else 'Cds' end")
    family = lambda a: a.withField("accession", F.when(a["source"] == "cm", F.concat(F.lit("RF"), F.substring(a["accession"], F.lit(3), F.length(a["accession"])))).otherwise(a["accession"]))
    rows = rows.withColumn("annotations", F.transform("annotations", family))  # hits of covariance models are families of RNA
    return rows.select("id", L.output_product().alias("product"), L.output_gene().alias("gene"), F.array_join(L.inference_values(), "|").alias("inference"), F.array_join(L.dbxref_values(), "|").alias("dbxref"))


@query("psc_landing", R.duck("""with h as (select q, t, bits from {hits} where pident >= 50 and ex >= 6 qualify row_number() over (partition by q order by bits desc, ex desc, ord) = 1),
n as (select q, bits, acc, case when lower(trim(coalesce(product, ''))) in ('', 'hypothetical protein') then 'hypothetical protein' else trim(product) end as name from h join {proteins} on pid = t)
select o_orderkey as id, coalesce(case when o_custkey%4=0 then o_orderpriority end, name) as product, (select count(*) from {annotations} a where a.fid = o_orderkey) + case when name is null then 0 else 1 end as n, coalesce(acc, '') as last from orders left join n on n.q = o_orderkey"""))
def psc_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = H.best_hits(R.relation(spark, sf_dir, "hits").where(H.psc_gate())).join(R.relation(spark, sf_dir, "proteins").withColumnRenamed("pid", "t"), "t")
    found = best.select(F.col("q").alias("id"), F.col("acc").alias("accession"), F.coalesce("product", F.lit("")).alias("name"), F.col("bits").alias("score"))
    landed = L.land_annotation(annotated(spark, sf_dir), found, "psc")
    last = F.filter("annotations", lambda a: a["source"] == "psc")
    return landed.select("id", "product", F.size("annotations").cast("long").alias("n"), F.coalesce(F.get(last, F.lit(0))["accession"], F.lit("")).alias("last"))


_KO = "(select 'K'||cast(n_nationkey as varchar(5)) ko, n_regionkey r, n_nationkey k from nation where n_nationkey < 20)"


@query("kofam_landing", f"""select o_orderkey as id, case when k.ko is not null and o_custkey%4<>0 then k.ko end as ko, case when k.ko is not null and o_custkey%4<>0 then '1.1.1.'||cast(r as varchar)||' 2.7' else '' end as ec,
case when k.ko is not null and o_custkey%4<>0 then 'COG_category:'||substr('JAKLBDYVTMNZWUOXCGEFHIPQRS', cast(k%8 as int) + 1, 1)||'|KEGG_pathway:map'||cast(k as varchar)||'|KEGG:'||k.ko else '' end as notes from orders left join {_KO} k on k.ko = 'K'||cast(o_custkey%25 as varchar)""")
def kofam_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = L.functional(R.select(spark, sf_dir, "select cast(o_orderkey as bigint) id, case when o_custkey%4=0 then 'Trna' else 'Cds' end kind from orders"))
    assigned = R.select(spark, sf_dir, "select cast(o_orderkey as bigint) id, 'K'||cast(o_custkey%25 as varchar(5)) ko from orders")
    table = R.select(spark, sf_dir, f"select ko, array('1.1.1.'||cast(r as varchar(5)), '2.7', '2.7') ec, array('map'||cast(k as varchar(5))) pathway, cast(shiftleft(1, cast(k%8 as int)) as int) cog from {_KO} k")
    return L.land_kofam(features, assigned, table).select("id", "ko", F.array_join("ec", " ").alias("ec"), F.array_join(L.note_values(), "|").alias("notes"))


@query("virulence_landing", R.duck("""with b as (select distinct q, t from {hits} where qcov >= 0.8), e as (select b.q, acc, min(ord) as ord, arg_min_null(product, ord) as product from b join (select q, t, min(ord) as ord from {hits} where qcov >= 0.8 group by 1, 2) h using (q, t) join {proteins} on pid = t group by 1, 2)
select o_orderkey as id, coalesce(string_agg('virulence factor: '||coalesce(product, acc), '|' order by ord), '') as notes, coalesce(string_agg('similar to AA sequence:VFDB:'||acc, '|' order by ord), '') as inference from orders left join e on e.q = o_orderkey group by 1"""))
def virulence_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = R.relation(spark, sf_dir, "hits").where("qcov >= 0.8").select(F.col("q").alias("id"), "ord", "t")
    entries = R.relation(spark, sf_dir, "proteins").select(F.col("pid").alias("t"), F.col("acc").alias("accession"), F.col("product").alias("description"))
    features = L.functional(R.select(spark, sf_dir, "select cast(o_orderkey as bigint) id, 'Cds' kind from orders"))
    landed = L.land_virulence(L.land_virulence(features, hits, entries), hits, entries)  # a second pass lands nothing
    return landed.select("id", F.array_join("notes", "|").alias("notes"), F.array_join(L.inference_values(), "|").alias("inference"))


_CALLED = "(select cast(l_orderkey as bigint) id, l_linenumber ord, 'sym'||cast(l_partkey%3 as varchar(3)) symbol, 'QUINOLONE' class, 'gyrA' gene, case l_partkey%3 when 0 then 'S83L' when 1 then 'R64Ter' else 'bad' end spec from lineitem)"


@query("amr_landing", f"""with f as (select id, symbol, min(ord) as ord, min(spec) as spec from {_CALLED} c where spec <> 'bad' group by 1, 2)
select o_orderkey as id, coalesce(string_agg('QUINOLONE resistance: '||case spec when 'S83L' then 'point mutation gyrA S83L' when 'R64Ter' then 'nonsense gyrA R64Ter' end, '|' order by ord, symbol), '') as notes, coalesce(string_agg('protein motif:AMRFinderPlus:'||symbol, '|' order by ord, symbol), '') as inference from orders left join f on f.id = o_orderkey group by 1""")
def amr_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = L.functional(R.select(spark, sf_dir, "select cast(o_orderkey as bigint) id, 'Cds' kind from orders"))
    landed = L.land_mutations(features, R.select(spark, sf_dir, f"select * from {_CALLED} c"))
    return landed.select("id", F.array_join("notes", "|").alias("notes"), F.array_join(L.inference_values(), "|").alias("inference"))


@query("inti_intersect", R.duck("select distinct q as id from {hits} where (t % 3 = 0 or t % 5 = 0) and q in (select q from {hits} where t % 7 = 0)"))
def inti_intersect(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = R.relation(spark, sf_dir, "hits").withColumnRenamed("q", "id")
    return L.integrase_ids([h.where("t % 3 = 0"), h.where("t % 5 = 0")], h.where("t % 7 = 0"))


@query("psc_unresolved_anti", R.duck("select distinct q from {hits} where q not in (select fid from {annotations} where score > 50000)"))
def psc_unresolved_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    return H.unresolved(R.relation(spark, sf_dir, "hits"), R.relation(spark, sf_dir, "annotations").where("score > 50000").select(F.col("fid").alias("q")))


@query("union_hits", R.duck("select q, t from {hits} where ex >= 10 or bits > 30000 qualify row_number() over (partition by q order by bits desc, ex desc, ord) = 1"))
def union_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = R.relation(spark, sf_dir, "hits")
    return H.union_hits(h.where("ex >= 10"), h.where("bits > 30000")).select("q", "t")


@query("intersect_ids", R.duck("select q from {hits} where ex >= 10 intersect select q from {hits} where bits > 80000"))
def intersect_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = R.relation(spark, sf_dir, "hits")
    return H.common_ids(h.where("ex >= 10"), h.where("bits > 80000"))


@query("union_features", R.duck("select id, kind from {features} where kind = 'Rrna' union all select id, kind from {features} where kind <> 'Rrna'"))
def union_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = R.relation(spark, sf_dir, "features").select("id", "kind")
    return H.union_features(f.where("kind = 'Rrna'"), f.where("kind <> 'Rrna'"))


#: Alignments of a query to few targets, in both directions, some of them insignificant.
_FRAMES = """(select q, t, cast(row_number() over (partition by q order by k desc, t, hi, te) as int) ord, case when k % 7 = 0 then 1e-5 else 1e-20 end evalue, case when q % 3 = 0 then hi else lo end qs, case when q % 3 = 0 then lo else hi end qe, ts, te, cast(t * 10 + 60 as bigint) tlen
 from (select cast(l_orderkey as bigint) q, cast(l_orderkey % 3 + floor(l_suppkey % 20 / 16) as bigint) t, l_partkey * 10 + l_linenumber k, cast(l_partkey % 400 as bigint) lo, cast(l_partkey % 400 + l_quantity * 6 as bigint) hi,
 cast(l_partkey % 40 + 1 as bigint) ts, cast(l_partkey % 40 + l_quantity as bigint) te from lineitem) x)"""
_GENES = "(select cast(o_orderkey as bigint) q, o_custkey % 10 = 0 edge, cast(o_custkey % 80 as bigint) aa_len, o_custkey % 2 = 0 transpos from orders)"
# From the rules as published: significant hits to the target of the first lowest E-value, pairs in order, then the longest hit.
_PRIMARY = f"""good as (select * from {_FRAMES} f where evalue <= 1e-10), prim as (select q, t, tlen as mlen from (select *, row_number() over (partition by q order by evalue, ord) as n from good) where n = 1 and tlen >= 60),
own as (select g.*, mlen, least(qs, qe) as lo, greatest(qs, qe) as hi, qe >= qs as fwd, (least(qs, qe) - 1 + 3000000) % 3 as phase from good g join prim p on p.q = g.q and p.t = g.t)"""
_SPLITS = """splits as (select a.q, a.ord as a_ord, b.ord as b_ord, case when a.phase <> b.phase then 'frameshift' else 'internal_stop' end as kind from own a join own b on a.q = b.q and a.fwd = b.fwd
where a.ts <= b.ts and a.te <= b.te and a.te - a.ts + 1 >= 15 and b.te - b.ts + 1 >= 15 and a.te - b.ts + 1 <= 20 and b.ts - a.te - 1 <= 60 and b.te - a.ts + 1 >= 0.5 * a.mlen and (a.te - a.ts + 1) + (b.te - b.ts + 1) <= 1.25 * a.mlen
and b.lo > a.lo and b.lo - a.hi - 1 <= 300 and b.hi - a.lo + 1 <= 1.5 * a.mlen * 3 qualify row_number() over (partition by a.q order by a.ord, b.ord) = 1)"""
_CUTS = f"""cuts as (select l.q, case when ts <= 11 and te < mlen - 10 then 'C-terminal' when te >= mlen - 10 and ts > 11 then 'N-terminal' else 'internal' end as lost from (select * from own qualify row_number() over (partition by q order by te - ts desc, ord desc) = 1) l join {_GENES} g on g.q = l.q
where transpos and te - ts + 1 >= 15 and (te - ts + 1) / mlen >= 0.2 and (te - ts + 1) / mlen <= 0.85 and (ts <= 11 or te >= mlen - 10) and aa_len < floor(0.85 * mlen))"""


def _primary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return H.primary_hits(R.select(spark, sf_dir, f"select * from {_FRAMES} x"))


@query("split_pair_join", f"with {_PRIMARY}, {_SPLITS} select * from splits")
def split_pair_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return H.split_pairs(_primary(spark, sf_dir))


@query("truncation_flags", f"with {_PRIMARY}, {_CUTS} select * from cuts")
def truncation_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return H.truncations(_primary(spark, sf_dir), R.select(spark, sf_dir, f"select * from {_GENES} g"))


@query("disruption_flags", f"with {_PRIMARY}, {_SPLITS}, {_CUTS} select p.q, p.t, coalesce(s.kind, 'truncation') as kind from prim p join {_GENES} g on g.q = p.q left join splits s on s.q = p.q left join cuts c on c.q = p.q where not edge and (s.q is not null or c.q is not null)")
def disruption_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return H.disruption_flags(R.select(spark, sf_dir, f"select * from {_GENES} g"), R.select(spark, sf_dir, f"select * from {_FRAMES} x"))


_REFS = "select cast(l_orderkey as bigint) fid, cast(max(l_quantity)+20 as bigint) aa_len, max(l_partkey%200) longest, max(l_suppkey)%5=0 partial, max(l_suppkey)%7=0 pseudo from lineitem group by 1"


@query("reflen_truncation", f"select fid from ({_REFS}) where aa_len >= 40 and longest >= 60 and aa_len < 0.55 * longest and not partial and not pseudo")
def reflen_truncation(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = R.select(spark, sf_dir, "select cast(l_orderkey as bigint) fid, cast(max(l_quantity)+20 as bigint) aa_len, collect_list(l_partkey%200) ref_lens, max(l_suppkey)%5=0 partial, max(l_suppkey)%7=0 pseudo from lineitem group by 1")
    return H.reflen_truncation(rows)


_REGIONS = f"(select f.*, 'ctg_'||cast(q % 50 as varchar(5)) contig, q * 10 + 1 region_s from {_FRAMES} f)"


@query("intergenic_pseudogenes", f"""with b as (select * from {_REGIONS} r where evalue <= 1e-10 and tlen >= 60 and (te - ts + 1) / tlen >= 0.4 qualify row_number() over (partition by q order by evalue, ord) = 1)
select contig, 'igpseudo_'||contig||'_'||cast(region_s + least(qs, qe) - 1 as varchar) as id, 'Cds' as kind, region_s + least(qs, qe) - 1 as s, region_s + greatest(qs, qe) - 1 as e, case when qe >= qs then 1 else -1 end as strand, true as pseudogene,
'intergenic homology to family '||t||' ('||cast(round_even((te - ts + 1) / tlen * 100, 0) as int)||'% of reference, translated) — degraded/uncalled gene' as note from b""")
def intergenic_pseudogenes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = H.intergenic_pseudogenes(R.select(spark, sf_dir, f"select * from {_REGIONS} r"))
    return found.select("contig", "id", "kind", "s", "e", "strand", "pseudogene", F.array_join("notes", "|").alias("note"))


over("sorf_psc_gate", HITS, lambda h: h.where(H.sorf_gate()).select("q", "t", "ex"), "select q, t, ex from {hits} where qcov >= 0.8 and tcov >= 0.7 and ex >= 6")


@query("sorf_detect", R.duck("""with hmm as (select q, t, 'hmm' as by from {hits} where ex >= 10 qualify row_number() over (partition by q order by bits desc, ex desc, ord) = 1),
psc as (select q, t, 'psc' as by from {hits} join {proteins} on pid = t where q not in (select q from hmm) and qcov >= 0.8 and tcov >= 0.7 and ex >= 6 and product is not null and not regexp_matches(lower(product), 'hypothetical|uncharacter|domain-containing|duf[0-9]') qualify row_number() over (partition by q order by bits desc, ex desc, ord) = 1)
select * from hmm union all select * from psc"""))
def sorf_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = R.relation(spark, sf_dir, "hits")
    return H.sorf_support(h.where("ex >= 10"), h, R.relation(spark, sf_dir, "proteins").select(F.col("pid").alias("t"), "product"))


_NEURAL = "(select cast(o_orderkey as bigint) id, case when o_custkey%5=0 then 'Trna' else 'Cds' end kind, case when o_custkey%6=0 then null else 'MK' end aa, o_custkey%7=0 partial5, case cast(o_orderkey%5 as int) when 0 then 'sec' when 1 then 'tat' when 2 then 'lipoprotein' when 3 then 'none' end signal, cast(o_orderkey%4 as int) helices, cast(o_orderkey%101 as double)/100 p, 'site '||cast(o_orderkey%3 as varchar(3)) label from orders where o_custkey%11<>0)"
_SURE = "format('(p={:.2f})', p)"


@query("neural_gates", f"""with n as (select *, kind = 'Cds' and aa is not null as ok, kind = 'Cds' and aa is not null and not partial5 and signal in ('sec', 'tat', 'lipoprotein') as sp from {_NEURAL} x)
select id, case when sp then signal end as signal, case when ok and p >= 0.7 then label end as localization, case when ok then p end as gene_score, concat_ws('|',
case when ok and helices > 0 then 'predicted transmembrane protein ('||helices||case when helices = 1 then ' TM helix)' else ' TM helices)' end end, case when sp then 'predicted '||signal||' signal peptide '||{_SURE} end,
case when ok and p >= 0.7 then 'predicted subcellular localization: '||label||' '||{_SURE} end, case when ok and p < 0.1 then 'low gene-model score, possible spurious ORF '||{_SURE} end) as notes from n""")
def neural_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions are a table; a feature without one stays as it is."""
    rows = R.select(spark, sf_dir, f"select * from {_NEURAL} x")
    landed = L.land_signal_peptides(L.functional(rows.select("id", "kind", "aa", "partial5")), rows.select("id", "signal", "p", "helices"))
    landed = L.land_gene_score(L.land_localization(landed, rows.select("id", "label", "p")), rows.select("id", "p"))
    return landed.select("id", "signal", "localization", "gene_score", F.array_join("notes", "|").alias("notes"))


@query("qc_report", f"""
with c as (select upper(split_part(regexp_extract(lower(product), 'ribosomal protein (.*)$', 1), ',', 1)) as marker, pseudogene from {QC_PRODUCTS} p where a % 6 <> 0), n as (select marker, count(*) filter (not pseudogene) as intact, count(*) filter (pseudogene) as pseudo from c group by 1),
m as (select m.marker, coalesce(intact, 0) as intact, coalesce(pseudo, 0) as pseudo from (select unnest(['{MARKS.replace(chr(39) + ', ' + chr(39), chr(39) + ',' + chr(39))}']) as marker) m left join n using (marker))
select count(*) as expected, count(*) filter (intact + pseudo > 0) as present, coalesce(string_agg(marker, ',' order by marker) filter (intact >= 2), '') as duplicated, coalesce(string_agg(marker, ',' order by marker) filter (intact = 0 and pseudo >= 1), '') as disrupted,
coalesce(string_agg(marker, ',' order by marker) filter (intact + pseudo = 0), '') as missing, round(100.0 * count(*) filter (intact + pseudo > 0) / count(*), 4) as completeness, round(100.0 * count(*) filter (intact >= 2) / count(*), 4) as contamination from m""")
def qc_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    markers = spark.createDataFrame([(m,) for m in C.MARKERS], "marker string")
    return H.qc_report(R.select(spark, sf_dir, f"select p.*, case when a % 6 = 0 then 'Rrna' else 'Cds' end kind from {QC_PRODUCTS} p"), markers)


_TREE = "(select cast(p_partkey as bigint) child, cast(case when p_partkey<10 then 0 else floor(p_partkey/3)*1 end as bigint) parent from part union all select cast(100000+s_suppkey as bigint), cast(s_suppkey*7 as bigint) from supplier)"
_MERGED = "(select cast(900000+c_custkey as bigint) old, cast(c_custkey*2 as bigint) as \"new\" from customer)"


@query("tree_closure", f"""with recursive t as (select child as id from {_TREE} x where parent in (2, 7) union select x.child from {_TREE} x join t on x.parent = t.id where x.child <> x.parent), a as (select id from t union select 2 union select 7)
select id from a union select old from {_MERGED} m where "new" in (select id from a)""")
def tree_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    roots = spark.createDataFrame([(2,), (7,)], "id long")
    tree = H.tree_closure(R.select(spark, sf_dir, f"select * from {_TREE} x"), roots)
    return H.merged_ids(tree, R.select(spark, sf_dir, f"select * from {_MERGED.replace(chr(34), '`')} m"))


_LINEAGES = "(select cast(p_partkey as bigint) id, 'd__Bacteria;p__P'||cast(p_size as varchar(5))||';f__F'||cast(p_size%7 as varchar(5))||';g__G'||cast(p_size%9 as varchar(5))||case when p_size%4=0 then ';s__' else ';s__S '||cast(p_partkey as varchar(10)) end lineage from part where p_partkey%5<>0)"


@query("taxonomy_lookup", R.duck(f"select q, t, lineage from {{hits}} h join {_LINEAGES} l on l.id = h.t"))
def taxonomy_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return H.lineages(R.relation(spark, sf_dir, "hits"), R.select(spark, sf_dir, f"select id, lineage from {_LINEAGES} l")).select("q", "t", "lineage")


@query("species_identify", R.duck(f"""with b as (select q, t, pident from {{hits}} h where t in (select id from {_LINEAGES} l) order by bits desc, ex desc, q, ord limit 1)
select q, t, lineage, pident as identity, coalesce(case when pident >= 98.7 then nullif(regexp_extract(lineage, 's__([^;]*)', 1), '') end, case when pident >= 94.5 then regexp_extract(lineage, 'g__([^;]*)', 1)||' (genus)' end, regexp_extract(lineage, 'f__([^;]*)', 1)||' (family)') as species from b join {_LINEAGES} l on l.id = b.t"""))
def species_identify(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineages = R.select(spark, sf_dir, f"select * from {_LINEAGES} l")
    known = R.relation(spark, sf_dir, "hits").join(lineages.select(F.col("id").alias("t")), "t", "left_semi")
    return L.identify_species(known, lineages)


over("plasmid_detect", HITS, lambda h: H.plasmid_replicons(h.withColumn("type", F.concat(F.lit("Inc"), (F.col("t") % 5).cast("string")))).select("q", "type", "t").orderBy("q", "type"), "select q, 'Inc'||cast(t % 5 as varchar) as type, t from {hits} where pident >= 80 and tcov >= 0.6 qualify row_number() over (partition by q, t % 5 order by bits desc, ord) = 1")
_LABELS = varied(("'Rrna'", "p_brand||' 16S ribosomal RNA'", "'-'"), ("'Rrna'", "'SSU_rRNA_'||p_type", "''"), ("'Rrna'", "p_name", "'RF00177.'||cast(p_size as varchar(5))"), ("'Rrna'", "'23S '||p_name", "'RF02541'"), ("'Cds'", "'16S methylase'", "''"), ("p_type", "'ssu'", "'RF01959'"), cols="kind, label, acc")
over("is_16s", _LABELS, lambda d: d.select("k", "label", L.is_16s("kind", "label", "acc").alias("is16s")),
     "select k, label, kind = 'Rrna' and (contains(lower(label), '16s') or contains(lower(label), 'ssu') or split_part(acc, '.', 1) in ('RF00177', 'RF01959', 'RF01960', 'RF02542')) as is16s from " + _LABELS + " x")

_LEGACY = "(select distinct contig, id, s, e, strand, cast(s%4 as int) as ref, cast(e-s as bigint) aa_len, cast(s%400 as bigint) ref_len from {features} where kind in ('Cds', 'Trna'))"
over("fragment_runs", _LEGACY, lambda d: H.fragment_runs(d), f"""with a as (select *, lag(ref) over w = ref and s - lag(e) over w - 1 between -30 and 60 as same from {_LEGACY} x window w as (partition by contig, strand order by s, e, id)),
b as (select *, sum(case when coalesce(same, false) then 0 else 1 end) over (partition by contig, strand order by s, e, id rows unbounded preceding) as run from a) select contig, strand, min(ref) as ref, arg_min(id, (s, e, id)) as first, count(*) as n from b group by contig, strand, run having count(*) > 1""")
over("frameshift_fragments", _LEGACY, lambda d: H.frameshift_fragments(d.withColumn("aa_len", F.floor((F.col("e") - F.col("s") + 1) / 3)).withColumn("acc", F.when(F.col("ref") > 1, F.col("ref").cast("string")))), f"""with a as (select *, case when ref > 1 then cast(ref as varchar) else '' end as acc from {_LEGACY} x),
b as (select id, s, e, strand, (e - s + 1) // 3 as aa_len, acc, lead(id) over w as ni, lead(s) over w as ns, lead(e) over w as ne, (lead(e) over w - lead(s) over w + 1) // 3 as nl, lead(acc) over w as na from a window w as (partition by contig, strand order by s, id)),
p as (select id, ni from b where e - ns + 1 >= 1 and e - ns + 1 <= 8 and aa_len <= 150 and nl <= 150 and ((case when strand >= 0 then ns - s else e - ne end) % 3) <> 0 and (acc = na)) select id from p union select ni from p""")
over("truncated_genes", _LEGACY, lambda d: H.truncated_genes(d), f"select id from {_LEGACY} x where ref_len >= 50 and aa_len < 0.8 * ref_len and ref_len - aa_len >= 25")
#: Genes on the contigs: the same text's letters, at places and of lengths by their number.
_ON_CONTIGS = "(select contig, contig||'_'||cast(k as varchar(3)) id, cast(k*97+5 as bigint) s, cast(k*97+5+(k%5)*30+58 as bigint) e, case when k%3=0 then -1 else 1 end strand, cast((k%5)*10+19 as bigint) aa_len, case when k%11=0 then 300 end ref_len from {contigs} c cross join (select distinct cast(l_linenumber*3 as bigint) k from lineitem) k where length(seq) > 3000)"


_WALK = f"""g as (select * from {_ON_CONTIGS} x), f as (select g.*, seq, length(seq) as n from g join {{contigs}} c on c.contig = g.contig),
cod as (select *, regexp_extract_all(case when strand >= 0 then substr(seq, e + 1, 15000) else reverse(translate(substr(seq, greatest(s - 15000, 1), s - greatest(s - 15000, 1)), 'ACGT', 'TGCA')) end, '...') as codons from f),
free as (select f.id, min(case when f.strand >= 0 then greatest(o.s - f.e - 1, 0) else greatest(f.s - o.e - 1, 0) end) as room from f join g o on o.contig = f.contig and o.strand = f.strand and (case when f.strand >= 0 then o.e > f.e else o.s < f.s end) group by 1),
r as (select cod.id, cast(least(5000, len(codons), coalesce(room // 3, 5000), coalesce(nullif(list_position(list_transform(codons, lambda x: x in ('TAA', 'TAG', 'TGA') or contains(x, 'N')), true), 0) - 1, 5000)) as bigint) as codons from cod left join free on free.id = cod.id)"""


@query("uncovered_downstream_orf", R.duck(f"with {_WALK} select id, codons from r"))
def uncovered_orf(spark: SparkSession, sf_dir: str) -> DataFrame:
    cds = R.select(spark, sf_dir, f"select * from {_ON_CONTIGS} x")
    return H.uncovered_downstream_orf(cds, cds, R.relation(spark, sf_dir, "contigs"))


@query("internal_stop_readthrough", R.duck(f"with {_WALK} select id, codons from r join f using (id) where aa_len <= 150 and ref_len is null and s > 3 and e < n - 3 and codons >= 2"))
def internal_stop_readthrough(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts have stops and other letters everywhere, so two codons count as long here."""
    return H.internal_stop_readthrough(R.select(spark, sf_dir, f"select * from {_ON_CONTIGS} x"), R.relation(spark, sf_dir, "contigs"), least=2)


over("run_counts", "(select pid, case when p_size%3=0 then null else 'MK' end aa, p_size%4 n_annotations, case when p_size%5=0 then 'virulence factor: x' else 'other' end note from {proteins})", lambda d: H.run_counts(d.withColumn("notes", F.array("note"))), "select count(*) as total, count(*) filter (p_size % 3 <> 0) as cds, count(*) filter (p_size % 4 > 0) as annotated, count(*) filter (p_size % 5 = 0) as virulence from {proteins}")
over("distinct_flags", ANN, lambda a: H.distinct_flags(a, ["fid"], "source", F.col("score") > 90000).withColumn("notes", F.array_join("notes", ",")), "select fid, string_agg(distinct source, ',' order by source) as notes, bool_or(score > 90000) as pseudogene from {annotations} group by 1")
