"""Detector adapters, the database catalogue and the whole annotation as queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contigframe import constants as C
from contigframe.operators import detectors as D
from contigframe.plans import relations as R
from contigframe.plans.annotate import annotate
from contigframe.plans.config import Config
from contigframe.plans.registry import query
from contigframe.plans.scalar_queries import kind_dimension

#: One row a call: unique, on few contigs.
CALLS = """(select contig, s, e, strand, cast(row_number() over (partition by contig order by s, e, id) as bigint) ord, 'Ala' isotype, 'TGC' anticodon, score, cast(s%3 as int) genetype, score energy, 'IS'||cast(s%30 as varchar(5)) family, cast(s%100 as double) pident,
 s%50 period, cast(s%90+10 as bigint) tenths, s%9 repeats, case when s%4=0 then null else 'dnaA' end hint_gene, 'prod' hint_product, 'x' hint_name, case when strand=-1 then e else s end as start, case when strand=-1 then s else e end as stop,
 case s%3 when 0 then 'SSU rRNA' when 1 then 'tmRNA' else 'RNaseP' end name, 'RF1' accession, cast(500 as bigint) clen, cast('1e-'||cast(s%9 as varchar(2)) as double) evalue, cast(s%7 as bigint) model_ord, cast(row_number() over (partition by contig order by s, e, id) as bigint) hit_ord from {features})"""


def detector(name: str, f, oracle: str) -> None:
    @query(name, R.duck(oracle))
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return f(R.select(spark, sf_dir, f"select * from {CALLS} c")).select("contig", "id", "kind", "s", "e", "name")


detector("trna_scan", D.trna, f"select contig, contig||'_trna'||ord as id, 'Trna' as kind, s, e, 'tRNA-Ala' as name from {CALLS} c")
detector("tmrna_scan", D.tmrna, f"select contig, contig||'_tmrna'||row_number() over (partition by contig order by ord) as id, 'Tmrna' as kind, s, e, 'tmRNA' as name from {CALLS} c where genetype = 1")
detector("is_elements", D.is_elements, f"select contig, contig||'_is'||ord as id, 'IsElement' as kind, s, e, family as name from {CALLS} c")
detector("tandem_repeats", D.tandem_repeats, f"select contig, contig||'_trf'||ord as id, 'TandemRepeat' as kind, s, e, 'tandem repeat period='||period||' copies='||(tenths // 10)||'.'||(tenths % 10) as name from {CALLS} c")
detector("ncrna_scan", D.ncrna, f"select contig, contig||'_ncrna'||row_number() over (partition by contig order by model_ord, hit_ord) as id, case s%3 when 0 then 'Rrna' when 1 then 'Tmrna' else 'Ncrna' end as kind, s, e, name from {CALLS} c where case when s%3=0 then (e - s + 1) / 500 >= 0.3 else s%9 >= 4 end")
detector("crispr_arrays", lambda c: D.crispr(c.dropDuplicates(["contig", "s", "e"])), f"select contig, 'CRISPR'||row_number() over (order by contig, s, e) as id, 'Crispr' as kind, s, e, 'CRISPR' as name from (select distinct contig, s, e from {CALLS} c)")
detector("oric_detect", lambda c: D.oric(c.dropDuplicates(["contig", "s", "e"])), f"with d as (select distinct on (contig, s, e) contig, s, e, hint_gene from {CALLS} c) select contig, contig||'_oriC'||case when count(*) over (partition by contig) > 1 then '_'||row_number() over (partition by contig order by s, e) else '' end as id, 'OriC' as kind, s, e, coalesce(hint_gene, 'prod') as name from d")


_MOB = "(select fid, ord, score, case cast(substr(accession,3,5) as int)%4 when 0 then 'PF03389.22' when 1 then 'PF01076' when 2 then 'PF13814.1' else accession end accession from {annotations})"


@query("orit_relaxase", R.duck(f"select fid, case accession when 'PF03389.22' then 'MOBQ' when 'PF01076' then 'MOBV' when 'PF13814.1' then 'relaxase (Replic_Relax)' else 'MOBP' end as family, ord from {_MOB} where ord % 2 = 0 or score > 50000 qualify row_number() over (partition by fid order by score desc, ord) = 1"))
def orit_relaxase(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = R.select(spark, sf_dir, f"select * from {_MOB} m").withColumns({"name": F.lit("T4SS_MOBP"), "has_ga": F.col("ord") % 2 == 0, "evalue": F.when(F.col("score") > 50000, 1e-9).otherwise(1e-2)})
    return D.relaxases(hits).select("fid", "family", "ord")


#: What a database is to the run: its kinds of references. Fixed values.
_OF = {
    "profiles": "pfam ncbifams antifam amr phage integron orit_pfam", "covariance models": "rfam trna", "proteins": "vfdb amr_variant psc", "nucleotides": "plasmidfinder gtdb_ssu",
    "tables": "meta kofam",
}
DATABASES = {key: kind for kind, keys in _OF.items() for key in keys.split()}


def validate_selection(keys: list[str]) -> list[str]:
    """The databases that were asked for, each once and in order; "all" is all of them. One that isn't known is an error that names it."""
    wanted = [k for key in keys for k in (DATABASES if key == "all" else [key])]
    unknown = [k for k in wanted if k not in DATABASES]
    if unknown:
        raise ValueError(f"unknown database: {', '.join(unknown)}; known are {', '.join(DATABASES)}")
    return list(dict.fromkeys(wanted))


def database_sizes(files: DataFrame) -> DataFrame:
    """(kind, databases, files, mb) of ``files`` (database, mb); files of unknown databases go."""
    known = files.sparkSession.createDataFrame(list(DATABASES.items()), "database string, kind string")
    rows = files.join(F.broadcast(known), "database")  # as many rows as databases
    return rows.groupBy("kind").agg(F.countDistinct("database").alias("databases"), F.count("*").alias("files"), F.sum("mb").cast("long").alias("mb"))


_FILES = "(select case " + " ".join(f"when p_partkey%{len(DATABASES) + 1} = {k} then '{key}'" for k, key in enumerate(DATABASES)) + " else 'other' end as database, p_size mb from part)"


@query("ref_dbs", f"select kind, count(distinct f.database) as databases, count(*) as files, cast(sum(mb) as bigint) as mb from {_FILES} f join (values " + ", ".join(f"('{k}', '{v}')" for k, v in DATABASES.items()) + ") v(database, kind) on v.database = f.database group by 1")
def ref_dbs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return database_sizes(R.select(spark, sf_dir, f"select * from {_FILES} f"))


def _run(spark: SparkSession, sf_dir: str):
    f = R.relation(spark, sf_dir, "features").withColumn("product", F.when(F.col("s") % 9 == 0, F.concat(F.lit("50S ribosomal protein L"), (F.col("s") % 7).cast("string"))))
    of = lambda kind: f.where(F.col("kind") == kind)
    calls = {"cds": of("Cds"), "trna": of("Trna"), "tmrna": of("Tmrna"), "is": of("IsElement"), "ncrna": f.where("kind in ('Rrna', 'Ncrna')")}
    markers = spark.createDataFrame([(m,) for m in C.MARKERS], "marker string")
    return annotate(Config(gaps=True), R.relation(spark, sf_dir, "contigs"), calls, {"markers": markers}, kind_dimension(spark))


@query("annotate")  # resolving is order-dependent: held against a literal sweep in the tests
def annotate_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir).features.select("contig", "id", "kind", "s", "e", "locus_tag")


_MARK = "select kind, case when s % 9 = 0 then 'L'||(s % 7) end as marker from {features}"
_LISTED = "', '".join(C.MARKERS)


@query("annotate_qc", R.duck(f"""with m as (select unnest(['{_LISTED}']) as marker), n as (select marker, count(*) as n from ({_MARK}) f where kind = 'Cds' and marker is not null group by 1), j as (select m.marker, coalesce(n, 0) as n from m left join n using (marker))
select count(*) as expected, sum(case when n > 0 then 1 else 0 end)::bigint as present, coalesce(string_agg(marker, ',' order by marker) filter (n >= 2), '') as duplicated, '' as disrupted, coalesce(string_agg(marker, ',' order by marker) filter (n = 0), '') as missing,
round(100.0 * sum(case when n > 0 then 1 else 0 end) / count(*), 4) as completeness, round(100.0 * sum(case when n >= 2 then 1 else 0 end) / count(*), 4) as contamination from j"""))
def annotate_qc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir).qc
