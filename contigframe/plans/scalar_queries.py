"""Scalar functions over names of the test tables, and over texts of every form made from their rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contigframe import constants as C
from contigframe.functions import text as T
from contigframe.plans import relations as R
from contigframe.plans.registry import query


def cases(*rows: tuple, cols: str = "a") -> str:
    """Literal rows as SQL of both engines."""

    def one(v) -> str:
        return "cast(null as varchar(1))" if v is None else str(v) if isinstance(v, (int, float)) else "'" + v.replace("'", "''") + "'"

    body = ", ".join("(" + ", ".join(map(one, r if isinstance(r, tuple) else (r,))) + ")" for r in rows)
    return f"(select * from (values {body}) v({cols}))"


def varied(*forms: str | tuple, cols: str = "a") -> str:
    """A row for each part: (k, ``cols``), each of the ``forms`` (an expression, or one for each column) in turn, as SQL of both engines."""
    rows = [f if isinstance(f, tuple) else (f,) for f in forms]
    each = ", ".join("case p_partkey%" + str(len(rows)) + " " + " ".join(f"when {i} then {r[j]}" for i, r in enumerate(rows)) + f" end {c.strip()}" for j, c in enumerate(cols.split(",")))
    return f"(select cast(p_partkey as bigint) k, {each} from part)"


def _n(c: str = "p_partkey") -> str:
    return f"cast({c} as varchar(10))"


def scalar(name: str, source: str, f, oracle: str, out: str = "r", keep: str = "a") -> None:
    """A query ``name`` that keeps columns of ``source`` and adds ``out``."""

    @query(name, R.duck(f"select {keep}, {oracle} as {out} from {source} s"))
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return R.select(spark, sf_dir, f"select * from {source} s").select(*[k.strip() for k in keep.split(",")], f().alias(out))


ACCESSIONS = "(select distinct accession a from {annotations})"
PRODUCTS = "(select pid a, product, gene, acc, p_size from {proteins})"
scalar("strip_version", f"(select a from {ACCESSIONS} x union all select a from {cases('NF000001.2', 'WP_1.x', 'A.1.2', 'A.', '.5', 'plain')} y)", lambda: T.strip_version("a"), r"case when regexp_matches(a, '\.[0-9]+$') then substr(a, 1, length(a) - length(regexp_extract(a, '\.[0-9]+$'))) else a end")
scalar("bare_acc", f"(select a from {ACCESSIONS} x union all select a from {cases('NF000001.2', 'A.1.2', 'plain', '.x')} y)", lambda: T.bare_accession("a"), "string_split(a, '.')[1]")
scalar("first_token", f"(select p_name a from part union all select a from {cases('x y', 'lone', ' lead')} y)", lambda: T.first_token("a"), "regexp_extract(a, '^[^ \t]*')")
scalar("split_multi", varied(f"'GO:'||{_n('p_size')}||', GO:'||{_n()}||';GO:3'", "''", "' ; ,'", "p_name", "p_name||' ,'||p_brand||'; '||p_type"), lambda: F.array_join(T.split_multi("a"), "|"), "array_to_string(list_filter(list_transform(regexp_split_to_array(a, '[,;]'), lambda x: trim(x)), lambda x: x <> ''), '|')", keep="k, a")
scalar("nonempty", f"(select coalesce(gene,'') a from {PRODUCTS} x union all select a from {cases('  ', ' b ')} y)", lambda: T.nonempty("a"), "case when trim(a) = '' then null else trim(a) end")
scalar("parse_ec", varied(f"p_name||' [EC:1.1.1.'||{_n('p_size')}||' 2.7.'||{_n('p_size')}||'.2]'", "p_name||' [EC:3.1.-.-'", "p_name", "'[EC:]'"), lambda: F.array_join(T.parse_ec("a"), "|"), "array_to_string(list_filter(string_split(regexp_extract(a, '\\[EC:([^\\]]*)', 1), ' '), lambda x: x <> ''), '|')", keep="k, a")
scalar("clean_product", f"(select a, coalesce(product,' ') product from {PRODUCTS} x)", lambda: T.clean_product("product"), "case when lower(trim(product)) in ('', 'hypothetical protein', 'uncharacterized protein', 'putative protein', 'protein of unknown function') then 'hypothetical protein' else trim(product) end", keep="a, product")
scalar("informative_product", f"(select a, coalesce(product,'') product from {PRODUCTS} x)", lambda: T.informative_product("product"), "trim(product) <> '' and not contains(lower(product), 'hypothetical') and not contains(lower(product), 'uncharacter') and not contains(lower(product), 'domain-containing') and not regexp_matches(lower(product), 'duf[0-9]')", keep="a, product")
scalar("sanitize_product", varied("p_name||'.'", "'  '||p_name||'   '||p_type||'  '", "p_name||'..'", "p_brand||' . .'", "p_name", "''"), lambda: T.sanitize_product("a"), "rtrim(rtrim(trim(regexp_replace(a, '\\s+', ' ', 'g')), '.'), ' ')", keep="k, a")
scalar("normalize_rrna", varied("'SSU_rRNA_bacteria'", "'SSU_rRNA_'||p_brand", "'LSU_rRNA_archaea'", "'5S_rRNA'", "'5_8S_rRNA'", "'5_8S_'||p_type", "'5S'||p_name", "'SSU_rRNA_eukarya'", "p_name"), lambda: T.normalize_rrna("a"),
       "case when a in ('SSU_rRNA_eukarya') then '18S' when a = 'LSU_rRNA_eukarya' then '28S' when starts_with(a, 'SSU_rRNA') then '16S' when starts_with(a, 'LSU_rRNA') then '23S' when starts_with(a, '5_8S') then '5.8S' when starts_with(a, '5S') then '5S' else a end || case when regexp_matches(a, '^(SSU_rRNA|LSU_rRNA|5)') then ' ribosomal RNA' else '' end", keep="k, a")
scalar("normalize_trna", varied("'tRNA-'||substr(p_type, 1, 3)", "'tRNA-'", "'tRNA'", "''", "'tRNA-Undet'", "'tRNA-sup'", "' tRNA-'||substr(p_brand, 1, 3)||' '", "'tRNA-XXX'", "p_name"), lambda: T.normalize_trna("a"), "case when not starts_with(trim(a), 'tRNA-') or lower(trim(substr(trim(a), 6))) in ('', 'undet', 'pseudo', 'sup', 'xxx') then 'tRNA-Xxx' else 'tRNA-' || trim(substr(trim(a), 6)) end", keep="k, a")
scalar("replicon_type", f"(select p_type a from part union all select a from {cases('IncFIB(K)_1_x', 'Col_2', 'plain')} y)", lambda: T.replicon_type("a"), "string_split(a, '_')[1]")
LINEAGES = "(select 'd__Bacteria;p__P'||cast(n_regionkey as varchar(5))||case when n_nationkey%3=0 then ';f__' else ';f__F'||cast(n_nationkey as varchar(5)) end||case when n_nationkey%4=0 then '' else ';g__'||n_name end||';s__'||case when n_nationkey%5=0 then '' else n_name||' sp' end lineage, cast(s_suppkey as bigint) a, 92.5+s_suppkey%16*0.5 identity from nation join supplier on s_nationkey=n_nationkey)"
scalar("assign_rank", LINEAGES, lambda: T.assign_rank("lineage", "identity"), r"""coalesce(case when identity >= 98.7 then nullif(regexp_extract(lineage, 's__([^;]*)', 1), '') end, case when identity >= 94.5 then nullif(regexp_extract(lineage, 'g__([^;]*)', 1), '') || ' (genus)' end,
    nullif(regexp_extract(lineage, 'f__([^;]*)', 1), '') || ' (family)', coalesce(nullif(regexp_extract(lineage, 'g__([^;]*)', 1), ''), nullif(regexp_extract(lineage, 'p__([^;]*)', 1), '')) || ' (higher rank)', 'unclassified')""", keep="a, lineage")
scalar("rank_value", LINEAGES, lambda: T.rank_value("lineage", "g"), "regexp_extract(lineage, 'g__([^;]*)', 1)", keep="a, lineage")
scalar("mob_family", varied(("p_name", f"'PF03389.'||{_n('p_size')}"), ("p_brand", "'PF13814'"), (f"'T4SS_MOBp'||{_n('p_size')}", "'-'"), ("p_name", "p_brand"), ("''", "p_brand"), ("''", "''"), ("'mobq_'||p_type", "'PF99999.1'"), ("p_name", "'PF07514.1'"), cols="a, acc"), lambda: T.mob_family("a", "acc"), "case split_part(acc, '.', 1) when 'PF01076' then 'MOBV' when 'PF03389' then 'MOBQ' when 'PF03432' then 'MOBF' when 'PF05713' then 'MOBC' when 'PF07514' then 'MOBF' when 'PF13814' then 'relaxase (Replic_Relax)' else coalesce(nullif(regexp_extract(upper(a), 'MOB[A-Z0-9]*'), ''), nullif(a, ''), nullif(acc, ''), 'relaxase') end", keep="k, a, acc")
_HALL = " ".join(f"when list_contains(string_split('{v}', ' '), split_part(acc, '.', 1)) then '{k}'" for k, v in C.HALLMARK_ACCESSIONS.items()) + " " + " ".join(f"when list_contains(string_split('{v}', ' '), a) then '{k}'" for k, v in C.HALLMARK_NAMES.items())
scalar("hallmark_class", varied(("p_name", f"'PF03354.'||{_n('p_size')}"), ("'Phage_portal'", "'-'"), ("'Recombinase'", "''"), ("p_name", f"'PF'||lpad({_n()}, 5, '0')"), ("p_brand", "'PF04586'"), ("p_type", "'PF16080.3'"), ("'Tail_tube'", "'PF00589'"), cols="a, acc"), lambda: T.hallmark_class("a", "acc"), f"case {_HALL} end", keep="k, a, acc")
scalar("regulatory_class", varied("'Cis-reg; riboswitch;'||p_name", "p_type||' Leader;'", "'Cis-reg; frameshift_element; '||p_brand", "'Cis-reg; thermoregulator;'", "p_name", "''"), lambda: T.regulatory_class("a"), "case when contains(lower(a), 'riboswitch') then 'riboswitch' when contains(lower(a), 'leader') then 'attenuator' when contains(lower(a), 'frameshift') then 'recoding_stimulatory_region' else 'other' end", keep="k, a")
MARKS = "', '".join(C.MARKERS)
QC_PRODUCTS = "(select cast(p_partkey as bigint) a, case when p_partkey%2=0 then '50S ribosomal protein L' else '30S Ribosomal Protein s' end||cast(p_size as varchar(5))||case when p_size%3=0 then ', putative' else '' end product, p_partkey%7=0 pseudogene from part)"
scalar("marker_key", QC_PRODUCTS, lambda: T.marker_key("product"), f"case when upper(split_part(regexp_extract(lower(product), 'ribosomal protein (.*)$', 1), ',', 1)) in ('{MARKS}') then upper(split_part(regexp_extract(lower(product), 'ribosomal protein (.*)$', 1), ',', 1)) end", keep="a, product")
scalar("ncrna_classify", varied("p_brand||' rRNA'", "p_name||' ribosomal RNA'", "p_name||'_rrna_x'", "p_name||'rrna'", "'tmRNA '||p_type", "p_name||' tmrna2'", "'transfer-messenger RNA'", "p_name"), lambda: T.ncrna_class("a"), "case when regexp_matches(lower(a), '(^|[^a-z0-9])(rrna|ribosomal rna)([^a-z0-9]|$)') then 'Rrna' when regexp_matches(lower(a), '(^|[^a-z0-9])(tmrna|transfer-messenger)([^a-z0-9]|$)') then 'Tmrna' else 'Ncrna' end", keep="k, a")
COGS = "(select distinct upper(substr(p_brand, 1, 3)||substr(p_type, 1, 4)) a from part)"
_MASK = " + ".join(f"case when contains(a, '{x}') then {1 << k} else 0 end" for k, x in enumerate(C.COG_LETTERS))
scalar("cog_mask", COGS, lambda: T.cog_mask("a").cast("long"), f"cast({_MASK} as bigint)")
scalar("cog_letters", "(select distinct cast(p_partkey%65536 as int) a from part)", lambda: T.cog_letters("a"), " || ".join(f"case when (a // {1 << k}) % 2 = 1 then '{x}' else '' end" for k, x in enumerate(C.COG_LETTERS)))
scalar("norm_pident", "(select distinct q a, t, case when ex>6 then pident/100 else pident end pident from {hits})", lambda: F.round(T.norm_pident("pident"), 6), "round(case when pident <= 1 then 100 * pident else pident end, 6)", keep="a, t")
scalar("parse_evalue", varied(f"'1e-'||{_n('p_size')}", f"'0.'||{_n()}", "p_name", "''", "'0'", f"{_n('p_size')}||'E-8'"), lambda: F.when(T.parse_evalue("a") == float("inf"), "none").when(T.parse_evalue("a") <= 1e-6, "pass").otherwise("fail"), "case when try_cast(a as double) is null then 'none' when cast(a as double) <= 1e-6 then 'pass' else 'fail' end", keep="k, a")
scalar("percent_encode", f"(select distinct p_name||'; x=1, '||p_type a from part union all select a from {cases('50%25', 'a&b', 'plain text')} y)", lambda: T.percent_encode("a"), "replace(replace(replace(replace(replace(a, '%', '%25'), ',', '%2C'), ';', '%3B'), '=', '%3D'), '&', '%26')")
scalar("is_transpos", "(select a, coalesce(product,'') product from " + PRODUCTS + " x union all select * from " + cases((1, "IS3 family Transposase"), (2, "insertion sequence"), (3, "an IS element"), cols="a, product") + " y)", lambda: T.is_transposase("product"), "contains(lower(product), 'transpos') or contains(lower(product), 'insertion sequence') or contains(lower(product), 'is element')", keep="a, product")
_AA = "substr('ARNDCQEGHILKMFPSTWYV', cast(p_size%20+1 as int), 1)"
_OTHER = "substr('ARNDCQEGHILKMFPSTWYV', cast(p_partkey%20+1 as int), 1)"
#: Changes of every form: a substitution, two nonsense forms, deletions of one and two residues; then others that are none.
CHANGES = [f"{_AA}||{_n()}||{_OTHER}", f"{_AA}||{_n()}||'Ter'", f"{_AA}||{_n()}||'*'", f"{_AA}||{_n()}||'del'", f"{_AA}||{_OTHER}||{_n()}||'del'"]
SPECS = varied(*CHANGES, f"{_AA}||{_n()}||'EKE'", "'S0L'", f"{_n()}||'L'", "'SL'", f"{_AA}||{_n()}||'LX'", f"{_AA}||{_n()}||'fs'", "'W65Ter5'", "p_name")


@query("parse_mutation_spec", rf"""
select k, a, case when ok then substr(refs, 1, 1) end as ref, case when ok then pos end as pos, case when ok then effect end as effect, case when ok and effect = 'deletion' then length(refs) end as span
from (select *, effect is not null and pos > 0 as ok from (select *, case when length(refs) = 1 and regexp_full_match(tail, '[ARNDCQEGHILKMFPSTWYV]') then 'substitution' when length(refs) = 1 and tail in ('Ter', '*') then 'nonsense' when tail = 'del' then 'deletion' end as effect
from (select k, a, regexp_extract(a, '^([ARNDCQEGHILKMFPSTWYV]+)[0-9]', 1) as refs, try_cast(regexp_extract(a, '^[A-Z]+([0-9]+)', 1) as bigint) as pos, regexp_extract(a, '^[A-Z]+[0-9]+(.*)$', 1) as tail from {SPECS} s)))""")
def parse_mutation_spec(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = T.mutation_spec("a")
    return R.select(spark, sf_dir, f"select * from {SPECS} s").select("k", "a", m["ref"].alias("ref"), m["pos"].alias("pos"), m["effect"].alias("effect"), m["span"].alias("span"))


@query("mutation_note", f"""
select k, a, case when regexp_extract(a, '[0-9]+') <> '0' then 'QUINOLONE resistance: ' end || case when regexp_matches(a, '^.[0-9]+(Ter|\\*)$') then 'nonsense gyrA ' || regexp_extract(a, '^.[0-9]+') || 'Ter'
 when regexp_matches(a, '^.[0-9]+del$') then 'deletion gyrA ' || a when regexp_matches(a, 'del$') then 'deletion gyrA ' || substr(a, 1, 1) || regexp_extract(a, '[0-9]+') || 'del (2 residues)' else 'point mutation gyrA ' || a end as note
from {varied(*CHANGES)} s""")
def mutation_note(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = R.select(spark, sf_dir, f"select * from {varied(*CHANGES)} s")
    return rows.select("k", "a", T.mutation_note(F.lit("QUINOLONE"), F.lit("gyrA"), T.mutation_spec("a")).alias("note"))


scalar("inference_db", "(select distinct source a from {annotations} union all select 'hmm:amr')", lambda: T.hmm_inference_db("a"), "case a when 'hmm:ncbifams' then 'NCBIfam' when 'hmm:pfam' then 'Pfam' when 'hmm:amr' then 'Amr' end")


def _b(c: str) -> Column:
    return F.col(c)


scalar("render_inference", varied(("'COORDINATES'", "'similar to AA sequence'", "1", "'VFDB'", f"'VFG'||{_n()}"), ("''", "'protein motif'", "0", "p_brand", "''"), ("''", "'ab initio'", "0", "''", "p_name"), ("'EXISTENCE'", "p_type", "0", "'HMM'", "p_brand"), cols="a, kind, same, db, acc"),
       lambda: T.render_inference(_b("a"), _b("kind"), _b("same") == 1, _b("db"), _b("acc")),
       "concat_ws(': ', nullif(a, ''), concat(kind, case when same = 1 then ' (same species)' else '' end, case when db <> '' then concat_ws('', ':', db, case when acc <> '' then concat(':', acc) end) else '' end))", keep="k, a, kind")
scalar("output_gene", "(select a, coalesce(product, 'hypothetical protein') product, gene from " + PRODUCTS + " x)", lambda: F.when(F.lower("product") != "hypothetical protein", T.nonempty("gene")), "case when lower(product) = 'hypothetical protein' then null else nullif(trim(gene), '') end", keep="a, product")


def kind_dimension(spark: SparkSession, sf_dir: str | None = None) -> DataFrame:
    """The vocabulary of kinds, which has a fixed size."""
    return spark.createDataFrame([(k, *v) for k, v in C.KINDS.items()], "kind string, so_type string, priority int, resolvable boolean, gene_assoc boolean")


_OF_KINDS = varied(*[f"'{k}'" for k in C.KINDS], "'Unknown'", cols="kind")


@query("kind_dimension", "select k, kind, so_type, priority, resolvable, gene_assoc from " + _OF_KINDS + " p join (values " + ", ".join(f"('{k}', '{t}', {p}, {str(r).lower()}, {str(g).lower()})" for k, (t, p, r, g) in C.KINDS.items()) + ") v(kind, so_type, priority, resolvable, gene_assoc) using (kind)")
def kinds_of_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the vocabulary says of each feature; those of unknown kind go."""
    rows = R.select(spark, sf_dir, f"select * from {_OF_KINDS} p")
    return rows.join(F.broadcast(kind_dimension(spark)), "kind").select("k", "kind", "so_type", "priority", "resolvable", "gene_assoc")  # 14 rows
