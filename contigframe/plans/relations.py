"""Genome-shaped relations derived from the test tables, by SQL that both engines run.

``sql`` of a relation may use other relations in braces; ``spark`` gives it as a DataFrame, ``duck`` as text for an oracle.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
_LETTERS = "translate(upper(regexp_replace(coalesce(text,''),'[^A-Za-z]',''{G})),'ABCDEFGHIJKLMNOPQRSTUVWXYZ','ACGTACGTGNCTGCCANGTTACGNAN')"
_CTG = "'ctg_'||cast(l_suppkey as varchar(20))"

RELATIONS = {
    # whole texts as nucleotide contigs
    "contigs": f"select 'ctg_'||cast(doc_id as varchar(20)) contig, {_LETTERS} seq from documents",
    # located features with classes 1..7
    "intervals": f"""select distinct {_CTG} contig, cast(l_partkey*100+l_linenumber*7 as bigint) s,
        cast(l_partkey*100+l_linenumber*7+l_quantity*30-1 as bigint) e, l_linenumber cls from lineitem""",
    # features of all kinds on short contigs, with many overlaps; id is unique
    "features": f"""select {_CTG} contig, {_CTG}||'_'||cast(l_linenumber*1000000+l_partkey as varchar(20)) id,
        case l_linenumber when 1 then 'Rrna' when 2 then 'Trna' when 3 then 'Tmrna' when 4 then 'Ncrna' when 5 then 'IsElement' else 'Cds' end kind,
        min(cast(l_partkey*40+l_linenumber*11 as bigint)) s, min(cast(l_partkey*40+l_linenumber*11+l_quantity*15-1 as bigint)) e,
        max(l_extendedprice) score, cast(case when (l_partkey+l_linenumber)%2=0 then -1 else 1 end as int) strand,
        l_partkey%3=0 low_open, l_partkey%5=0 high_open from lineitem group by l_suppkey,l_linenumber,l_partkey""",
    # similarity hits
    # ord: hits of a query as they come, the largest target first
    "hits": """select *, cast(row_number() over (partition by q order by t desc, ex, bits, pident, qcov, tcov) as int) ord from (select distinct cast(l_orderkey as bigint) q, cast(l_partkey as bigint) t, 50+l_quantity pident, l_extendedprice bits, l_linenumber*2 ex,
        cast('1e-'||cast(l_linenumber*2 as varchar(5)) as double) evalue, round(1-l_tax*3,2) qcov, round(1-l_discount*4,2) tcov,
        cast(l_partkey%400+40 as bigint) tlen from lineitem) h""",
    # annotations: several of each feature, in order
    "annotations": """select cast(l_orderkey as bigint) fid, 'PF'||lpad(cast(l_partkey%500 as varchar(10)),5,'0')||'.'||cast(l_linenumber as varchar(3)) accession,
        l_extendedprice score, cast(row_number() over (partition by l_orderkey order by l_linenumber,l_partkey,l_suppkey,l_extendedprice,l_quantity,l_shipdate) as int) ord,
        case when l_suppkey%3=0 then 'hmm:pfam' when l_suppkey%3=1 then 'hmm:ncbifams' else 'cm' end source from lineitem""",
    # reference proteins: names, genes and identifiers by accession
    "proteins": """select cast(p_partkey as bigint) pid, 'PF'||lpad(cast(p_partkey%500 as varchar(10)),5,'0') acc,
        case when p_size%5=0 then null when p_size%7=0 then 'Hypothetical protein' when p_size%11=0 then 'DUF'||cast(p_size as varchar(5))||' domain-containing protein'
        else p_name end product, case when p_size%4=0 then '' else p_brand end gene, p_size, p_type from part""",
    "loci": """select contig, s, case when cls in (5,6,7) then least(e, s+60) else e end e, cls,
        cls=1 and cast(floor(s/100) as bigint)%5=0 is_int, cls in (5,6,7) is_attc from {intervals}""",
}


def _text(name: str, engine: str) -> str:
    return _fill(RELATIONS[name], engine)


def _fill(sql: str, engine: str) -> str:
    sql = sql.replace("{G}", "" if engine == "spark" else ",'g'")
    return re.sub(r"\{(\w+)\}", lambda m: f"({_text(m[1], engine)})", sql)


def duck(sql: str) -> str:
    """SQL for DuckDB: ``{name}`` is a derived relation, ``{G}`` the flag of a regular expression that replaces all."""
    return _fill(sql, "duck")


def select(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    sql = _fill(sql, "spark")
    for t in TABLES:
        if re.search(rf"\b{t}\b", sql):
            spark.read.parquet(f"{sf_dir}/{t}.parquet").createOrReplaceTempView(t)
    return spark.sql(sql)


def relation(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return select(spark, sf_dir, f"select * from {{{name}}}")


def repeated(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A relation of different rows before its repeats are dropped, for an operator that drops them where its rows meet anyway."""
    return select(spark, sf_dir, RELATIONS[name].replace("select distinct ", "select ", 1))
