"""Sequence operators over contigs made of whole texts, and over alignments and profiles given as literal rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contigframe.functions import sequence as S
from contigframe.operators import scans
from contigframe.plans import relations as R
from contigframe.plans.registry import query

_RC = "reverse(translate(regexp_replace(seq, '[^ACGT]', 'N', 'g'), 'ACGT', 'TGCA'))"


@query("scan_contigs", R.duck("select contig, cast(length(seq) as bigint) as length, md5(seq) as digest from {contigs}"))
def scan_contigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.relation(spark, sf_dir, "contigs").select("contig", F.length("seq").cast("long").alias("length"), F.md5("seq").alias("digest"))


@query("assembly_gaps", R.duck("""
with p as (select contig, unnest(regexp_extract_all(seq, 'N+|[^N]+')) as piece, generate_subscripts(regexp_extract_all(seq, 'N+|[^N]+'), 1) as k from {contigs}),
w as (select *, sum(length(piece)) over (partition by contig order by k) as upto from p)
select contig, cast(upto - length(piece) + 1 as bigint) as start, cast(upto as bigint) as "end" from w where starts_with(piece, 'N')"""))
def assembly_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scans.assembly_gaps(R.relation(spark, sf_dir, "contigs"), size=4096)


def _orf_oracle(seq: str, strand: int) -> str:
    start, end = ("s + 1", "stop + 3") if strand == 1 else ("len - stop - 2", "len - s")
    return f"""
with c as (select contig, length(seq) as len, {seq} as seq from {{contigs}}),
p as (select contig, len, seq, unnest(range(0, len - 2)) as pos from c),
m as (select contig, len, pos, pos % 3 as frame, substr(seq, pos + 1, 3) as codon from p where substr(seq, pos + 1, 3) in ('ATG', 'GTG', 'TTG', 'TAA', 'TAG', 'TGA')),
n as (select *, min(case when codon in ('TAA', 'TAG', 'TGA') then pos end) over (partition by contig, frame order by pos rows between current row and unbounded following) as stop from m),
g as (select contig, len, frame, stop, min(pos) as s from n where codon in ('ATG', 'GTG', 'TTG') and stop is not null and (stop - pos) // 3 < 50 group by 1, 2, 3, 4)
select contig, {strand} as strand, cast({start} as bigint) as start, cast({end} as bigint) as "end", cast((stop - s) // 3 as bigint) as aa_len from g where (stop - s) // 3 >= 8"""


@query("sorf_enumerate_fwd", R.duck(_orf_oracle("seq", 1)))
def sorf_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scans.short_orfs(R.relation(spark, sf_dir, "contigs"), strands=(1,))


@query("sorf_enumerate_rev", R.duck(_orf_oracle(_RC, -1)))
def sorf_reverse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scans.short_orfs(R.relation(spark, sf_dir, "contigs"), strands=(-1,))


def sequences(name: str, f, oracle: str) -> None:
    @query(name, R.duck(f"select contig, md5({oracle}) as r from {{contigs}}"))
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return R.relation(spark, sf_dir, "contigs").select("contig", F.md5(f("seq")).alias("r"))


sequences("revcomp_n", S.revcomp_n, _RC)
sequences("revcomp_keep", S.revcomp_keep, "reverse(translate(seq, 'ACGT', 'TGCA'))")
# Codons of each amino acid.
_CODONS = {"F": "TTT TTC", "L": "TTA TTG CTT CTC CTA CTG", "I": "ATT ATC ATA", "M": "ATG", "V": "GTT GTC GTA GTG", "S": "TCT TCC TCA TCG AGT AGC", "P": "CCT CCC CCA CCG", "T": "ACT ACC ACA ACG", "A": "GCT GCC GCA GCG", "Y": "TAT TAC", "*": "TAA TAG TGA", "H": "CAT CAC", "Q": "CAA CAG", "N": "AAT AAC", "K": "AAA AAG", "D": "GAT GAC", "E": "GAA GAG", "C": "TGT TGC", "W": "TGG", "R": "CGT CGC CGA CGG AGA AGG", "G": "GGT GGC GGA GGG"}
_TABLE = " ".join(f"when codon in ('{v.replace(' ', chr(39) + ', ' + chr(39))}') then '{k}'" for k, v in _CODONS.items())


@query("translate_codon", R.duck(f"with c as (select contig, unnest(regexp_extract_all(seq, '...')) as codon from {{contigs}}) select codon, case {_TABLE} else 'X' end as aa, count(*) as n from c group by 1, 2"))
def translate_codon(spark: SparkSession, sf_dir: str) -> DataFrame:
    each = R.relation(spark, sf_dir, "contigs").select(F.explode(S.codons("seq")).alias("codon"))
    return each.groupBy("codon").agg(F.count("*").alias("n")).withColumn("aa", S.translate_codon("codon"))


@query("start_stop_codons", R.duck("with c as (select unnest(regexp_extract_all(seq, '...')) as codon from {contigs}) select codon, codon in ('ATG', 'GTG', 'TTG') as starts, codon in ('TAA', 'TAG', 'TGA') as stops, codon in ('TTA', 'CTA', 'TCA') as rev_stops, count(*) as n from c group by 1"))
def start_stop(spark: SparkSession, sf_dir: str) -> DataFrame:
    each = R.relation(spark, sf_dir, "contigs").select(F.explode(S.codons("seq")).alias("codon"))
    return each.groupBy("codon").agg(F.count("*").alias("n")).select("codon", S.is_start("codon").alias("starts"), S.is_stop("codon").alias("stops"), S.is_reverse_stop("codon").alias("rev_stops"), "n")


@query("gc_skew", R.duck("""
with p as (select contig, unnest(string_split(seq, '')) as ch, generate_subscripts(string_split(seq, ''), 1) - 1 as pos from {contigs} where seq <> ''),
b as (select contig, cast(pos // 1000 as bigint) as block, count(*) filter (ch = 'G') as g, count(*) filter (ch = 'C') as c from p group by 1, 2)
select contig, block, g, c, cast(sum(g - c) over (partition by contig order by block) as bigint) as cumulative from b"""))
def gc_skew(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scans.gc_skew(R.relation(spark, sf_dir, "contigs"))


_SPOTS = "(select 'ctg_'||cast(l_suppkey as varchar(20)) contig, l_orderkey*10+l_linenumber id, cast(l_partkey as bigint) s, cast(l_partkey+l_quantity as bigint) e, case when l_linenumber%2=0 then -1 else 1 end strand from lineitem)"


@query("feature_seq", R.duck(f"select f.contig, id, s, e, strand, case when s >= 1 and e <= length(seq) then case when strand = -1 then reverse(translate(substr(seq, s, e - s + 1), 'ACGT', 'TGCA')) else substr(seq, s, e - s + 1) end end as sub from {_SPOTS} f left join {{contigs}} c on c.contig = f.contig"))
def feature_seq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scans.feature_seq(R.select(spark, sf_dir, f"select * from {_SPOTS} f"), R.relation(spark, sf_dir, "contigs")).select("contig", "id", "s", "e", "strand", "sub")


@query("cds_regime", R.duck("select contig, cast(length(seq) as bigint) as length, case when max(length(seq)) over () >= 20000 then 'single' else 'meta' end as regime from {contigs}"))
def cds_regime(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scans.cds_regime(R.relation(spark, sf_dir, "contigs"))


@query("genetic_code_pick", R.duck("select contig, case when length(replace(seq, 'TGA', '')) < length(replace(seq, 'TAG', '')) then 4 else 11 end as code from {contigs}"))
def genetic_code_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The score is the model's; here, fewer stop codons are better."""
    each = R.relation(spark, sf_dir, "contigs")
    score = lambda stop: -F.length(F.replace(F.col("seq"), F.lit(stop), F.lit("")))
    candidates = each.select("contig", F.explode(F.array(F.struct(F.lit(11).alias("code"), score("TAG").alias("score")), F.struct(F.lit(4).alias("code"), score("TGA").alias("score")))).alias("c")).select("contig", "c.*")
    return scans.genetic_code(candidates)


#: Gapped alignments out of names: some letters are gaps of the query, others of the target, never both.
_ALN = "(select cast(p_partkey as bigint) hit, cast(p_size as int) tstart, translate(upper(replace(p_name, ' ', '')), 'AEHL', '----') qaln, translate(upper(replace(p_name, ' ', '')), 'OIT', '---') taln from part)"
_COLS = f"c as (select hit, tstart, unnest(string_split(qaln, '')) as q, unnest(string_split(taln, '')) as t, unnest(range(0, length(qaln))) as col from {_ALN} a), r as (select hit, cast(col as int) as col, q, t, cast(tstart - 1 + sum(case when t <> '-' then 1 else 0 end) over (partition by hit order by col) as bigint) as ref_pos from c)"


@query("aln_ref_pos", f"with {_COLS} select * from r")
def aln_ref_pos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scans.alignment_columns(R.select(spark, sf_dir, f"select * from {_ALN} a"))


@query("query_state", f"with {_COLS}, s as (select hit, cast(pos as bigint) as pos from (select distinct hit from r), (select unnest(range(1, 18)) as pos)) select s.hit, s.pos, case when q is null then 'outside' when q = '-' then 'deleted' else 'residue' end as state, case when q <> '-' then q end as residue from s left join (select * from r where t <> '-') r on r.hit = s.hit and r.ref_pos = s.pos")
def query_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = R.select(spark, sf_dir, f"select * from {_ALN} a")
    return scans.query_state(hits, hits.select("hit", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(17).cast("long"))).alias("pos")))


@query("deletion_calls", f"with {_COLS}, s as (select hit, cast(pos as bigint) as pos, cast(span as int) as span from (select distinct hit from r), (select unnest(range(1, 16)) as pos), (select unnest([1, 2, 3]) as span)) select s.hit, s.pos, s.span, (select count(*) from r where r.hit = s.hit and t <> '-' and q = '-' and ref_pos between s.pos and s.pos + s.span - 1) = s.span as called from s")
def deletion_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = R.select(spark, sf_dir, f"select * from {_ALN} a")
    sites = hits.select("hit", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(15).cast("long"))).alias("pos")).select("hit", "pos", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("span"))
    return scans.deletion_calls(hits, sites)


#: Each alignment's target has changes of three forms at places round it.
_SITES = f"(select hit, tstart, qaln, taln, tstart + o as pos, case o%4 when 0 then 'nonsense' when 1 then 'deletion' else 'substitution' end effect, case when o%4 = 1 then cast(o%3+1 as int) end span, substr('ACDEFGHIKLMNPQRSTVWY', cast((hit+o)%20+1 as int), 1) alt from {_ALN} a, (select distinct cast(l_linenumber*2-3 as bigint) o from lineitem) o)"


@query("amr_variant_calls", f"""with {_COLS}, s as (select * from {_SITES} s where pos > 0)
select s.hit, s.pos, s.effect, case effect when 'substitution' then (select max(q) from r where r.hit = s.hit and t <> '-' and ref_pos = s.pos) = alt when 'nonsense' then (select max(q) from r where r.hit = s.hit and t <> '-' and ref_pos = s.pos) = '*'
 else (select count(*) from r where r.hit = s.hit and t <> '-' and q = '-' and ref_pos between s.pos and s.pos + span - 1) = span end is true as called from s""")
def amr_variant_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which changes the alignments show, place by place."""
    from contigframe.operators import homology

    rows = R.select(spark, sf_dir, f"select * from {_SITES} s where pos > 0").withColumn("key", F.concat_ws("|", F.col("hit").cast("string"), F.col("pos").cast("string")))
    hits = rows.select(F.col("key").alias("q"), F.col("key").alias("t"), F.lit(1).alias("ord"), F.lit(100.0).alias("pident"), "tstart", "qaln", "taln")
    catalog = rows.select(F.col("key").alias("accession"), F.lit("s").alias("symbol"), F.lit("c").alias("class"), F.lit("g").alias("gene"), F.lit("A").alias("ref"), F.col("pos").cast("long").alias("pos"), "effect", "alt", "span")
    calls = homology.mutation_calls(hits, catalog).select(F.col("id").alias("key"), F.lit(True).alias("found"))
    return rows.join(calls, "key", "left").select("hit", F.col("pos").cast("long").alias("pos"), "effect", F.coalesce("found", F.lit(False)).alias("called"))


_TRIM = "(select cast(l_orderkey as bigint) id, cast(l_partkey%60+1 as int) k, cast(max(l_orderkey%49+12) as int) overhang, max(case l_suppkey%5 when 0 then 'ATG' when 1 then 'GTG' when 2 then 'TTG' else 'AAA' end) codon from lineitem group by 1, 2)"


@query("pick_trim_codon", f"select id, k from {_TRIM} t where codon in ('ATG', 'GTG', 'TTG') and k between greatest(overhang - 8, 1) and overhang - 2 qualify row_number() over (partition by id order by k desc) = 1")
def pick_trim_codon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scans.pick_trim_codon(R.select(spark, sf_dir, f"select * from {_TRIM} t"))


_CALLS = "(select cast(l_orderkey*10+l_linenumber as bigint) id, cast(l_partkey as bigint) as start, cast(l_partkey+300 as bigint) as \"end\", case when l_linenumber%2=0 then -1 else 1 end strand, cast(60+l_quantity as int) aa_len, l_suppkey%7=0 partial5, cast(l_partkey%70 as int) overhang, l_quantity score, cast(l_partkey%70+1 as int) env_from, cast(56+l_quantity as int) env_to, cast(50+l_linenumber*5 as int) model_len, cast(l_suppkey%40+1 as int) k from lineitem)"


@query("start_refine", f"select *, case when ok and strand = 1 then start + 3 * k else start end as new_start, case when ok and strand = -1 then \"end\" - 3 * k else \"end\" end as new_end from (select *, not partial5 and overhang between 12 and 60 and score >= 25 and env_to >= aa_len - 5 and (env_to - env_from + 1) / model_len >= 0.7 and k between 1 and 60 and aa_len - k >= 40 as ok from {_CALLS} c)".replace("select *, case when ok", "select * exclude (ok), case when ok"))
def start_refine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scans.refine_starts(R.select(spark, sf_dir, f"select * from {_CALLS.replace(chr(34) + 'end' + chr(34), '`end`')} c"))


_NODES = "(select cast(p_size as int) rec, cast(p_partkey as int) node, " + "||' '||".join(f"case when (p_partkey*{k + 3})%17=0 then '*' else cast((p_partkey*{k + 7})%13+0.5 as varchar(10)) end" for k in range(20)) + " scores from part)"


@query("hmm_consensus", f"""
with c as (select rec, node, unnest(string_split(scores, ' ')) as v, unnest(range(0, 20)) as k from {_NODES} n),
f as (select rec, node, substr('ACDEFGHIKLMNPQRSTVWY', k + 1, 1) as aa from c where v <> '*' qualify row_number() over (partition by rec, node order by cast(v as double), k) = 1)
select rec, string_agg(aa, '' order by node) as consensus from f group by 1""")
def hmm_consensus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scans.hmm_consensus(R.select(spark, sf_dir, f"select * from {_NODES} n"))


@query("frame_of", R.duck("select q, t, ex, case when cast(floor(bits) as bigint) % 3000 >= t then 1 else -1 end as strand, cast((least(t, cast(floor(bits) as bigint) % 3000 + 1) + 2) % 3 as int) as phase from {hits}").replace(">= t then", "+ 1 >= t then"))
def frame_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = R.relation(spark, sf_dir, "hits").withColumn("qend", F.floor("bits").cast("long") % 3000 + 1)
    strand, phase = S.frame_of("t", "qend")
    return rows.select("q", "t", "ex", strand.alias("strand"), phase.alias("phase"))
