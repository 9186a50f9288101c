"""Format readers over lines made from the test tables, so that they run at any scale."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contigframe.plans import relations as R
from contigframe.plans.registry import query
from contigframe.plans.scalar_queries import _MASK
from contigframe.sources import parsers as P

TAB = "||chr(9)||"


def tabbed(*cols: str) -> str:
    return TAB.join(f"coalesce(cast({c} as varchar(200)), '')" for c in cols)


def over(name: str, lines: str, f, oracle: str) -> None:
    @query(name, R.duck(oracle))
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return f(R.select(spark, sf_dir, f"select * from {lines} x"))


_FASTA = "(select '>c'||cast(doc_id as varchar(20))||' len='||cast(length(text) as varchar(20))||chr(10)||'acgtn'||chr(10)||regexp_replace(coalesce(text,''),'[^A-Za-z ]',''{G}) as record from documents)"
over("scan_fasta", _FASTA, lambda d: P.fasta_records(d).select("contig", F.md5("seq").alias("digest")), "select 'c'||cast(doc_id as varchar) as contig, md5('ACGTN'||upper(regexp_replace(coalesce(text, ''), '[^A-Za-z]', '', 'g'))) as digest from documents")
over("fasta_duplicates", "(select p_brand as contig from part)", P.duplicate_contigs, "select p_brand as contig, count(*) as n from part group by 1 having count(*) > 1")
over("scan_fastq", "(select c_custkey record, k, case k when 0 then '@r'||cast(c_custkey as varchar(20))||' x' when 1 then 'acg'||cast(c_nationkey as varchar(3)) when 2 then '+' else 'III' end line from customer, (select * from (values (0),(1),(2),(3)) v(k)) kk)", P.fastq_records, "select 'r'||cast(c_custkey as varchar) as contig, 'ACG'||cast(c_nationkey as varchar) as seq from customer")
_PF = "(select 'ctg_'||cast(l_orderkey as varchar(20))||'_'||cast(l_linenumber as varchar(3))||' # '||cast(l_partkey as varchar(20))||' # '||cast(l_partkey+99 as varchar(20))||' # '||case when l_linenumber%2=0 then '-1' else '1' end||' # ID=1;partial='||cast(l_suppkey%2 as varchar(1))||cast(l_partkey%2 as varchar(1))||';start=ATG' header from lineitem)"
over("scan_protein_fasta", _PF, P.protein_headers, "select 'ctg_'||l_orderkey||'_'||l_linenumber as id, l_partkey as start, l_partkey + 99 as \"end\", cast(case when l_linenumber % 2 = 0 then -1 else 1 end as int) as strand, case when l_linenumber % 2 = 0 then l_partkey % 2 else l_suppkey % 2 end = 1 as partial5, case when l_linenumber % 2 = 0 then l_suppkey % 2 else l_partkey % 2 end = 1 as partial3 from lineitem")

_VALUES = {"query": "l_orderkey", "target": "l_partkey", "pident": "case when l_suppkey%2=0 then cast(l_linenumber as double)/10 else cast(l_linenumber*10 as double) end", "evalue": "case when l_suppkey%7=0 then 'bad' else '1e-'||cast(l_linenumber as varchar(3)) end", "bits": "l_suppkey", "qlen": "l_linenumber", "tlen": "l_linenumber+1", "qcov": "0.5", "tcov": "0.25",
           "qstart": "l_partkey+l_linenumber%3*10", "qend": "l_partkey+10", "tstart": "case when l_suppkey%11=0 then 'x' else cast(l_linenumber as varchar(3)) end", "tend": "l_linenumber+5", "qaln": "'AC-'", "taln": "'A-C'", "alnlen": "l_linenumber", "strand": "'+'"}


def _m8_oracle(kind: str) -> str:
    """Every column of a layout as its reader should give it."""
    pid = "case when l_suppkey % 2 = 0 then l_linenumber / 10 else l_linenumber * 10.0 end"
    value = {c: f"cast({v} as double)" for c, v in _VALUES.items()} | {c: f"cast({_VALUES[c]} as varchar)" for c in ("query", "target", "qaln", "taln", "strand")}
    value["pident"] = f"round({pid}, 6)" if kind == "translated" else f"round(case when {pid} <= 1 then 100 * ({pid}) else {pid} end, 6)"
    value["evalue"] = "case when l_suppkey % 7 = 0 then -1 else cast('1e-' || l_linenumber as double) end"
    value["tstart"] = f"try_cast({_VALUES['tstart']} as double)"
    if kind == "plasmid":
        value |= {"qstart": "cast(least(l_partkey + l_linenumber % 3 * 10, l_partkey + 10) as double)", "qend": "cast(greatest(l_partkey + l_linenumber % 3 * 10, l_partkey + 10) as double)"}
    keep = "where l_suppkey % 11 <> 0" if kind == "alignment" else ""
    return "select " + ", ".join(f"{value[c]} as {c}" for c in P.M8[kind].split()) + f", count(*) as n from lineitem {keep} group by all"


def m8_query(kind: str, name: str) -> None:
    cols = P.M8[kind].split()
    short = kind == "psc"
    line = f"(select cast(row_number() over (order by l_orderkey,l_partkey,l_suppkey,l_linenumber,l_extendedprice,l_shipdate) as bigint) line_no, {tabbed(*[_VALUES[c] for c in cols])} line from lineitem" + (f" union all select cast(0 as bigint), 'only'{TAB}'three'{TAB}'90')" if short else ")")

    @query(name, _m8_oracle(kind))
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        hits = P.m8(R.select(spark, sf_dir, f"select * from {line} x"), kind)
        if "evalue" in cols:  # an infinite one, for what can't be read, as a number that every engine prints alike
            hits = hits.withColumn("evalue", F.when(F.col("evalue") == float("inf"), -1.0).otherwise(F.col("evalue")))
        return hits.withColumn("pident", F.round("pident", 6)).groupBy(*cols).agg(F.count("*").alias("n"))


for _kind, _name in (("psc", "scan_m8_psc"), ("vfdb", "scan_m8_vfdb"), ("plasmid", "scan_m8_plasmid"), ("species", "scan_m8_species"), ("alignment", "scan_m8_aln"), ("orit", "scan_m8_orit"), ("translated", "scan_m8_translated")):
    m8_query(_kind, _name)

_BLANK = ["''"] * 4
_PGAP = f"(select p_partkey line_no, {tabbed(chr(39) + 'NF' + chr(39) + '||cast(p_partkey%700 as varchar(10))||' + chr(39) + '.' + chr(39) + '||cast(p_partkey%3 as varchar(3))', *_BLANK, 'p_size', *_BLANK, 'case when p_size%5=0 then null else p_name end', 'case when p_size%3=0 then null else p_brand end', chr(39) * 2, 'case when p_size%10=0 then ' + chr(39) * 2 + ' else ' + chr(39) + '1.1.1.1; 2.2.2.2' + chr(39) + ' end', 'case when p_size%2=0 then ' + chr(39) + 'GO:1' + chr(39) + ' else ' + chr(39) * 2 + ' end')} line from part)"
_PGAP_ROWS = "(select p_partkey, 'NF'||cast(p_partkey%700 as varchar)||'.'||cast(p_partkey%3 as varchar) as acc, 'NF'||cast(p_partkey%700 as varchar) as bare, case when p_size%5<>0 then p_name end as product, case when p_size%3<>0 then p_brand end as gene, case when p_size%10<>0 then 2 else 0 end as n_ec, case when p_size%2=0 then 1 else 0 end as n_go, p_size from part)"
over("scan_pgap", _PGAP, lambda d: P.pgap(d).select("acc", "product", "gene", F.size("ec").alias("n_ec"), F.size("go").alias("n_go")), f"select acc, product, gene, n_ec, n_go from {_PGAP_ROWS} p where product is not null or gene is not null or n_ec > 0 or n_go > 0")
over("scan_pgap_bare", _PGAP, lambda d: P.first_by_bare(P.pgap(d)).select("bare", "acc", "product"), f"select bare, acc, product from {_PGAP_ROWS} p where product is not null or gene is not null or n_ec > 0 or n_go > 0 qualify row_number() over (partition by bare order by p_partkey) = 1")
over("scan_ref_lengths", _PGAP, lambda d: P.first_by_bare(P.ref_lengths(d)).select("bare", "ref_len"), f"select bare, p_size as ref_len from {_PGAP_ROWS} p where p_size > 0 qualify row_number() over (partition by bare order by p_partkey) = 1")
over("scan_pfam2go", "(select p_partkey line_no, case when p_size%9=0 then '!comment GO:9' else 'Pfam:PF'||lpad(cast(p_partkey%300 as varchar(10)),5,'0')||' name > GO:x; also GO:77 > GO:term ; GO:'||lpad(cast(p_size as varchar(5)),7,'0') end line from part)", lambda d: P.pfam2go(d).select("acc", F.array_join("go", ",").alias("go")), "with a as (select 'PF'||lpad(cast(p_partkey%300 as varchar),5,'0') as acc, 'GO:'||lpad(cast(p_size as varchar),7,'0') as go, min(p_partkey) as n from part where p_size%9<>0 group by 1, 2) select acc, string_agg(go, ',' order by n) as go from a group by 1")
over("scan_ko_list", f"(select p_partkey line_no, {tabbed(chr(39) + 'K' + chr(39) + '||lpad(cast(p_partkey as varchar(10)),5,' + chr(39) + '0' + chr(39) + ')', 'case when p_size%4=0 then ' + chr(39) + '-' + chr(39) + ' else cast(p_size as varchar(5)) end', 'case p_size%3 when 0 then ' + chr(39) + 'full' + chr(39) + ' when 1 then ' + chr(39) + 'domain' + chr(39) + ' else ' + chr(39) + '-' + chr(39) + ' end', 'p_name||' + chr(39) + ' [EC:1.1.1.1 2.2.2.2]' + chr(39))} line from part)", lambda d: P.ko_list(d).select("ko", "threshold", "score_type", F.array_join("ec", "|").alias("ec")),
     "select 'K'||lpad(cast(p_partkey as varchar),5,'0') as ko, case when p_size%4<>0 then cast(p_size as double) end as threshold, case p_size%3 when 0 then 'full' when 1 then 'domain' else 'none' end as score_type, '1.1.1.1|2.2.2.2' as ec from part")
_BRITE = "(select 'f'||cast(p_size%5 as varchar(2)) as file, p_partkey line_no, case when p_partkey%13=0 then 'C    00010 x [PATH:ko'||lpad(cast(p_partkey%90 as varchar(5)),5,'0')||']' when p_partkey%17=0 then 'C    99 y [BR:ko1]' when p_partkey%7=0 then 'B  z' else 'D      K'||lpad(cast(p_partkey%400 as varchar(5)),5,'0')||'  gene' end line from part)"
over("scan_brite", _BRITE, P.brite, f"""with t as (select file, line_no, line, case when line_no%13=0 or line_no%17=0 then line_no end as c from {_BRITE} b), l as (select *, last_value(c ignore nulls) over (partition by file order by line_no rows unbounded preceding) as head from t)
select distinct substr(line, 8, 6) as ko, 'ko'||lpad(cast(head%90 as varchar),5,'0') as pathway from l where starts_with(line, 'D') and head%13=0""")
over("carry_forward", _BRITE, lambda d: P.carry_forward(d, F.when(F.col("line").startswith("C ") & F.col("line").contains("[PATH"), F.col("line_no")), "head").select("file", "line_no", "head"), f"select file, line_no, (select max(h.p_partkey) from part h where h.p_partkey % 13 = 0 and h.p_partkey <= b.line_no and 'f'||cast(h.p_size % 5 as varchar) = b.file) as head from {_BRITE} b")
over("scan_ko_cog", f"(select p_partkey line_no, {tabbed('p_partkey', 'upper(substr(p_brand,1,3)||substr(p_type,1,4))')} line from part)", lambda d: P.ko_cog(d).select("ko", F.col("mask").cast("long").alias("mask")), f"select * from (select cast(p_partkey as varchar) as ko, cast({_MASK} as bigint) as mask from (select p_partkey, upper(substr(p_brand,1,3)||substr(p_type,1,4)) as a from part)) where mask <> 0")
over("scan_rfam_type", f"(select p_partkey line_no, {tabbed('p_partkey', 'p_type', 'case p_size%4 when 0 then ' + chr(39) + 'rRNA' + chr(39) + ' when 1 then ' + chr(39) + 'regulatory_region' + chr(39) + ' when 2 then ' + chr(39) + 'tRNA' + chr(39) + ' else ' + chr(39) + 'snoRNA' + chr(39) + ' end')} line from part)", P.rfam_types, "select cast(p_partkey as varchar) as acc, p_type as rfam_type, case p_size%4 when 0 then 'rRNA' when 1 then 'regulatory_region' else 'tRNA' end as so_type from part where p_size%4 <> 3")
over("scan_names", f"(select p_partkey line_no, {tabbed('p_partkey', 'p_name', 'p_type')} line from part)", P.names_table, "select cast(p_partkey as varchar) as id, p_name||chr(9)||p_type as product from part")
_MUT = f"(select p_partkey line_no, {tabbed('p_size', chr(39) + 'WP_' + chr(39) + '||cast(p_partkey as varchar(10))', 'p_size', chr(39) + 'gyr_A_' + chr(39) + '||case p_size%5 when 0 then ' + chr(39) + 'S83L' + chr(39) + ' when 1 then ' + chr(39) + 'E258EKE' + chr(39) + ' when 2 then ' + chr(39) + 'WR65del' + chr(39) + ' when 3 then ' + chr(39) + 'D233Ter' + chr(39) + ' else ' + chr(39) + 'fs' + chr(39) + ' end', 'p_size', 'p_brand')} line from part)"
over("scan_mutations", _MUT, lambda d: P.mutations(d).select("accession", "gene", "ref", "pos", "effect", "class"), "select 'WP_'||p_partkey as accession, 'gyr_A' as gene, case p_size%5 when 0 then 'S' when 2 then 'W' else 'D' end as ref, cast(case p_size%5 when 0 then 83 when 2 then 65 else 233 end as bigint) as pos, case p_size%5 when 0 then 'substitution' when 2 then 'deletion' else 'nonsense' end as effect, p_brand as class from part where p_size%5 in (0, 2, 3)")
over("scan_vfdb_hdr", "(select case when p_size%6=0 then 'other' else 'VFG'||lpad(cast(p_partkey as varchar(10)),6,'0')||'(gb|WP_1.1) '||case when p_size%4=0 then '' else '('||lower(p_brand)||') ' end||p_name||' [cat (VF1)] ['||p_type||']' end header from part)", P.vfdb_headers, "select 'VFG'||lpad(cast(p_partkey as varchar),6,'0') as id, case when p_size%4<>0 then lower(p_brand) end as gene, p_name as description, p_type as species from part where p_size%6<>0")
over("scan_gtdb", "(select 'RS_'||cast(p_partkey as varchar(10))||' '||case when p_size%8=0 then 'none' else 'd__B;s__'||p_name end||case when p_size%2=0 then ' [locus=x]' else '' end header from part)", P.gtdb_headers, "select 'RS_'||p_partkey as id, 'd__B;s__'||p_name as lineage from part where p_size%8<>0")
over("scan_taxdump", "(select p_partkey line_no, case when p_size%10=0 then 'bad' else cast(p_partkey as varchar(10))||chr(9)||'|'||chr(9)||cast(p_size as varchar(5))||chr(9)||'|' end line from part)", P.taxdump_nodes, "select p_partkey as child, cast(p_size as bigint) as parent from part where p_size%10<>0")
_UNI = "(select 'UniRef90_'||cast(p_partkey as varchar(10))||case when p_size%9=0 then '' else ' '||p_name end||' n='||cast(p_size as varchar(5))||' Tax=x TaxID='||cast(p_partkey%100 as varchar(5))||' RepID=z' header from part)"
over("uniref_header", _UNI, P.uniref_headers, "select 'UniRef90_'||p_partkey as id, p_partkey%100 as taxid, case when p_size%9=0 then 'uncharacterized protein' else p_name end as product from part")


@query("scan_uniref", "select 'UniRef90_'||p_partkey as id, cast(p_partkey%100 as bigint) as taxid, case when p_size%9=0 then 'uncharacterized protein' else p_name end as product from part where p_partkey%100 in (select n_nationkey from nation)")
def scan_uniref(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = P.uniref_headers(R.select(spark, sf_dir, f"select * from {_UNI} x"))
    return P.uniref_filter(records, R.select(spark, sf_dir, "select cast(n_nationkey as bigint) taxid from nation")).select("id", "taxid", "product")


@query("ref_fasta_subset", "select p_partkey||'|x' as header from part where p_partkey in (select l_partkey from lineitem where l_linenumber = 7)")
def ref_fasta_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = R.select(spark, sf_dir, "select cast(p_partkey as varchar(10))||'|x' header from part")
    return P.fasta_subset(records, R.select(spark, sf_dir, "select cast(l_partkey as varchar(10)) accession from lineitem where l_linenumber=7")).select("header")


over("scan_hal", "(select p_brand as file, p_partkey line_no, case when p_size%5=0 then '  ' else ' profiles/'||p_type||'/K'||cast(p_partkey as varchar(10))||'.hmm ' end line from part)", P.hal_list, "select p_brand as file, cast(row_number() over (partition by p_brand order by p_partkey) as int) as ord, 'K'||p_partkey||'.hmm' as name from part where p_size%5<>0")
_CM = "(select p_brand as file, p_partkey line_no, case when p_partkey%10<2 then 'INFERNAL1/a' when p_partkey%10<4 then 'NAME  '||cast(p_partkey as varchar(10)) else 'COM x' end line from part)"
over("split_cm_models", _CM, P.split_models, f"with n as (select *, sum(case when starts_with(line, 'INFERNAL1') then 1 else 0 end) over (partition by file order by line_no rows unbounded preceding) as model from {_CM} c) select file, cast(model as bigint) as model, max(case when starts_with(line, 'NAME') then trim(substr(line, 5)) end) as name, count(*) as n_lines from n where model > 0 group by 1, 2")
over("count_models", _CM, lambda d: P.count_models(d, "INFERNAL1"), f"select file, count(*) filter (starts_with(line, 'INFERNAL1')) as models from {_CM} c group by 1")


@query("concat_profiles", "select cast(row_number() over (order by c_custkey) as int) as ord, 'profile '||c_custkey as content from customer")
def concat_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = R.select(spark, sf_dir, "select 'list' as file, c_custkey line_no, 'k/'||cast(c_custkey as varchar(10)) line from customer")
    return P.concat_profiles(P.hal_list(lines), R.select(spark, sf_dir, "select cast(c_custkey as varchar(10)) name, 'profile '||cast(c_custkey as varchar(10)) content from customer"))


_MODELS = "(select 'm'||lpad(cast(p_partkey as varchar(10)), 9, '0')||case p_partkey%3 when 0 then '.hmm' when 1 then '.HMM' else '.txt' end path, 'HMMER3'||chr(10)||case when p_size%2=0 then 'GA   '||cast(p_size as varchar(5))||' 25' else 'NOGA' end||chr(10) content from part)"
over("discover_models", _MODELS, P.discover_models, f"select path, contains(content, 'GA   ') as has_ga from {_MODELS} m where path like '%.hmm'")
