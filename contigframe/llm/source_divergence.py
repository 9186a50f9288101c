"""Audit of sources against their language and against each other, term by term, in exact integers.

Terms are counted for each group of a language and a source. A term counted c times in a group of N counts, in a language of V
terms, has the scaled probability p = 1 + floor(10^9 (c + 1) / (N + V)), and f(p, q) = floor((p - q)^2 / q) is its part of the
divergence from q.

Terms of a group that stand out against the language are searched from above: terms of one count share p, so buckets by count (and by
the size of the language's count) bound f by the smallest q among their terms. Buckets are opened best first until there are
enough terms, then all others whose bound isn't strictly below the last value found; rows of other buckets are never moved.

Two sources are compared by postings. As most terms are absent from most groups, the sum over all terms is that against a source without any
counts, which the counts' histogram gives, plus what counts change, which again a histogram gives for one source and only the
postings that both sources have give for two.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from contigframe.llm import tokens, util

SCALE = 1_000_000_000
LEAST_DOCS, TOP = 3, 200
#: What separates terms: all of ASCII but letters.
BETWEEN = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
#: Postings of a task that compares sources, and pairs that it holds at once.
POSTINGS, PAIRS = 200_000, 2_000_000
#: Places that a group's terms are ranked in before they meet.
SALTS = 32
GROUP = ["lang", "source"]


def probability(n: str, total: str) -> str:
    return f"(1 + ({SCALE}BD * ({n} + 1)) div ({total} + v))"


def divergence(p: str, q: str) -> str:
    return f"(({p} - {q}) * ({p} - {q}) div {q})"


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents, one row a group and term. Counts are combined before the shuffle, within slices of text and then
    within tasks."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tokens.slices(batch, "text"):
                lists = pc.split_pattern_regex(pc.ascii_lower(part.column("text").cast(pa.large_string())), BETWEEN)
                sizes = np.diff(lists.offsets.to_numpy())
                coded = lists.flatten().dictionary_encode()
                del lists
                doc, term, width = np.repeat(np.arange(len(sizes)), sizes), coded.indices.to_numpy().astype(np.int64), max(1, len(coded.dictionary))
                pairs, n = np.unique(doc * width + term, return_counts=True)
                doc, term = pairs // width, pairs % width
                lang, source = (part.column(c).dictionary_encode() for c in GROUP)
                group = lang.indices.to_numpy().astype(np.int64) * len(source.dictionary) + source.indices.to_numpy()
                key, first, inverse = np.unique(group[doc] * width + term, return_index=True, return_inverse=True)
                names = coded.dictionary.take(pa.array(key % width))
                owner = pa.array(doc[first])
                out = pa.RecordBatch.from_arrays(
                    [*(part.column(c).take(owner) for c in GROUP), names.cast(pa.string()), pa.array(np.bincount(inverse, n, len(key)).astype(np.int64)), pa.array(np.bincount(inverse, minlength=len(key)).astype(np.int64))],
                    names=[*GROUP, "term", "n", "docs"],
                )
                yield out.filter(pc.not_equal(out.column("term"), ""))

    found = docs.mapInArrow(tokens.tidy(work), "lang string, source string, term string, n long, docs long")
    return found.groupBy(*GROUP, "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def kept_postings(docs: DataFrame, tmp: util.Scratch) -> tuple[DataFrame, DataFrame]:
    """(postings, groups): (lang, source, term, n, lang_n, total, lang_total, v) of the terms that a language keeps, and (lang, source, total, lang_total, v)
    of every group."""
    of_term = Window.partitionBy("lang", "term")  # a row for each source that has it
    sums = term_counts(docs).withColumns({"lang_n": F.sum("n").over(of_term), "lang_docs": F.sum("docs").over(of_term)})
    kept = tmp.written(sums.where(F.col("lang_docs") >= LEAST_DOCS).select(*GROUP, "term", "n", "lang_n"), "kept")
    # a term counts once for its language: in the first of its sources
    own = kept.groupBy(*GROUP).agg(F.sum("n").alias("total"), F.count("*").alias("postings"))
    vocabulary = kept.groupBy("lang", "term").agg(F.first("lang_n").alias("n")).groupBy("lang").agg(F.count("*").alias("v"), F.sum("n").alias("lang_total"))
    groups = docs.select(*GROUP).distinct().join(own, GROUP, "left").join(vocabulary, "lang", "left")
    groups = tmp.written(groups.na.fill(0, ["total", "postings", "v", "lang_total"]), "groups")
    return tmp.written(util.join_heavy(kept, groups.drop("postings"), GROUP), "postings"), groups


def standing_out(postings: DataFrame, tmp: util.Scratch, top: int = TOP) -> DataFrame:
    """(lang, source, item, value, rank): of each group the ``top`` terms with p > q by their value."""
    rows = postings.select(*GROUP, "term", "n", F.floor(F.log2("lang_n")).cast("int").alias("size"), F.expr(probability("n", "total")).alias("p"), F.expr(probability("lang_n", "lang_total")).alias("q"))
    key = [*GROUP, "n", "size"]
    buckets = rows.groupBy(*key).agg(F.first("p").alias("p"), F.min("q").alias("least"), F.count_if(F.expr("p > q")).alias("terms")).where("terms > 0")
    best = Window.partitionBy(*GROUP).orderBy(F.col("bound").desc(), "n", "size").rowsBetween(Window.unboundedPreceding, -1)  # a row for each bucket
    buckets = buckets.withColumn("bound", F.expr(divergence("p", "least"))).withColumn("before", F.coalesce(F.sum("terms").over(best), F.lit(0)))
    buckets = tmp.written(buckets.select(*key, "bound", "before"), "buckets")

    def opened(which: DataFrame, what: str) -> DataFrame:
        found = util.join_heavy(rows, which.select(*key), key, heavy=heavy).where("p > q").select(*GROUP, "term", F.expr(divergence("p", "q")).alias("value"))
        salt = F.pmod(F.xxhash64("term"), F.lit(SALTS))
        return tmp.written(ranked(found.withColumn("salt", salt).withColumnRenamed("term", "item"), [*GROUP, "salt"], top).select(*GROUP, "item", "value"), what)

    heavy = util.heavy_keys(rows, key)
    first = opened(buckets.where(F.col("before") < top), "first")
    last = first.groupBy(*GROUP).agg(F.count("*").alias("have"))
    reached = ranked(first, GROUP, top).where(F.col("rank") == top).select(*GROUP, F.col("value").alias("kth"))
    rest = buckets.where(F.col("before") >= top).join(last.join(reached, GROUP, "left"), GROUP).where(F.col("kth").isNull() | (F.col("bound") >= F.col("kth")))
    return ranked(first.unionByName(opened(rest, "rest")), GROUP, top)


def ranked(rows: DataFrame, group: list[str], top: int | None = None) -> DataFrame:
    """``rows`` with their rank: value descending, then item. With ``top`` only so many leave each task."""
    out = rows.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(F.col("value").desc(), "item")))
    return out.where(F.col("rank") <= top) if top else out


def _f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def _shared(postings: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value): what postings of both sources add to the sums of their histograms."""
    per = groups.groupBy("lang").agg(F.ceil(F.sum("postings") / POSTINGS).cast("int").alias("blocks"))
    rows = postings.select(*GROUP, "term", F.expr(probability("n", "total")).alias("p"), F.expr(probability("0L", "total")).alias("p0"))
    rows = util.join_heavy(rows, per, ["lang"], heavy=util.heavy_keys(postings, ["lang"])).withColumn("block", F.pmod(F.xxhash64("term"), F.col("blocks")))

    def work(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        source, term = (table.column(c).combine_chunks().dictionary_encode() for c in ("source", "term"))
        t = term.indices.to_numpy()
        order = np.argsort(t, kind="stable")
        t, s, p, p0 = t[order], source.indices.to_numpy().astype(np.int64)[order], table.column("p").to_numpy()[order], table.column("p0").to_numpy()[order]
        sizes = np.bincount(t)
        first, size = (np.cumsum(sizes) - sizes)[t], sizes[t]  # of each posting's term
        keys, sums, many = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], len(source.dictionary)
        ends = np.cumsum(size)
        a = 0
        while a < len(t):
            b = max(a + 1, int(np.searchsorted(ends, ends[a] - size[a] + PAIRS, side="right")))
            own = np.repeat(np.arange(a, b), size[a:b])
            other = np.arange(len(own)) - np.repeat(ends[a:b] - size[a:b] - (ends[a] - size[a]), size[a:b]) + first[own]
            own, other = own[own != other], other[own != other]
            more = _f(p[own], p[other]) - _f(p[own], p0[other]) - _f(p0[own], p[other]) + _f(p0[own], p0[other])
            key, inverse = np.unique(np.concatenate([keys[-1], s[own] * many + s[other]]), return_inverse=True)
            total = np.zeros(len(key), np.int64)
            np.add.at(total, inverse, np.concatenate([sums[-1], more]))
            if len(key) > PAIRS:  # as many sources as that: partial sums leave as they are
                keys += [np.zeros(0, np.int64)]
                sums += [np.zeros(0, np.int64)]
            keys[-1 if len(key) <= PAIRS else -2], sums[-1 if len(key) <= PAIRS else -2] = key, total
            a = b
        key, total = np.concatenate(keys), np.concatenate(sums)
        lang = table.column("lang")[0].as_py()
        return pa.table({"lang": pa.array([lang] * len(key), pa.string()), "source": source.dictionary.take(pa.array(key // many)), "item": source.dictionary.take(pa.array(key % many)), "value": pa.array(total)})

    return rows.select(*GROUP, "term", "p", "p0", "block").groupBy("lang", "block").applyInArrow(work, "lang string, source string, item string, value long")


def _alone(postings: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value): for each pair of sources of a language what either one's histogram of counts gives."""
    counts = postings.groupBy(*GROUP, "n").agg(F.count("*").alias("terms")).groupBy(*GROUP).agg(F.collect_list(F.struct("n", "terms")).alias("counts"))
    others = groups.groupBy("lang").agg(F.collect_list(F.struct("source", "total")).alias("others"))  # as many as the rows that each source gives
    rows = groups.join(counts, GROUP, "left").join(others, "lang").repartition(util.salt_count(postings.sparkSession), *GROUP)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                v, own, names = r["v"], r["total"] + r["v"], [o["source"] for o in r["others"]]
                as_source, as_item = np.zeros(len(names), np.int64), np.zeros(len(names), np.int64)
                if v:
                    base = np.array([1 + SCALE // (o["total"] + v) for o in r["others"]], np.int64)
                    zero, counts = 1 + SCALE // own, r["counts"] or []
                    as_source += (v - sum(c["terms"] for c in counts)) * _f(np.int64(zero), base)
                    for c in counts:
                        p = np.int64(1 + SCALE * (c["n"] + 1) // own)
                        as_source += c["terms"] * _f(p, base)
                        as_item += c["terms"] * (_f(base, p) - _f(base, np.int64(zero)))
                other = [n != r["source"] for n in names]
                for source, item, value in (([r["source"]] * len(names), names, as_source), (names, [r["source"]] * len(names), as_item)):
                    yield pa.RecordBatch.from_arrays([pa.array([r["lang"]] * len(names)), pa.array(source, pa.string()), pa.array(item, pa.string()), pa.array(value)], names=[*GROUP, "item", "value"]).filter(pa.array(other))

    return rows.select(*GROUP, "total", "v", "counts", "others").mapInArrow(work, "lang string, source string, item string, value long")


def compared(postings: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value, rank): of each group all other sources of its language."""
    both = _alone(postings, groups).unionByName(_shared(postings, groups))
    return ranked(both.groupBy(*GROUP, "item").agg(F.sum(F.col("value").cast("decimal(38,0)")).cast("long").alias("value")), GROUP)


def source_divergence(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", top: int = TOP) -> DataFrame:
    """Rows (lang, source, part, item, value, rank): part "pair" with all other sources of the language, "term" with the ``top`` terms.

    Defined cases: null texts, languages and sources are empty texts, and the empty language and source are groups like others. A
    group without terms has pairs; a language of one source has none. A language without kept terms has pairs of value 0. Repeated
    rows are documents of their own. Ties are ordered by the item's bytes. An empty table gives an empty result. Other columns are not read.
    """
    text = lambda c, name: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name)
    rows = docs.select(text(text_col, "text"), text(lang_col, "lang"), text(source_col, "source"))
    with util.Scratch(docs.sparkSession) as tmp:
        postings, groups = kept_postings(rows, tmp)
        pairs = compared(postings, groups).withColumn("part", F.lit("pair"))
        terms = standing_out(postings, tmp, top).withColumn("part", F.lit("term"))
        out = pairs.unionByName(terms).select(*GROUP, "part", "item", F.col("value").cast("long").alias("value"), F.col("rank").cast("int").alias("rank"))
        return util.written(out, "divergence")


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(util.documents(spark, sf_dir))


ORACLE = rf"""
with d as (select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source, coalesce(text, '') as text from documents),
w as (select r, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from d),
kept as (select lang, term, count(*) as n from w group by all having count(distinct r) >= {LEAST_DOCS}),
g as (select distinct lang, source from d),
c as (select lang, source, term, count(*) as n from w semi join kept using (lang, term) group by all),
v as (select lang, count(*) as v, sum(n) as total from kept group by lang),
gt as (select lang, source, sum(n) as total from c group by all),
gp as (select g.lang, g.source, kept.term, coalesce(c.n, 0) as n, 1 + {SCALE}::hugeint * (coalesce(c.n, 0) + 1) // (coalesce(gt.total, 0)::hugeint + v.v) as p,
          1 + {SCALE}::hugeint * (kept.n + 1) // (v.total::hugeint + v.v) as q
       from g join kept using (lang) join v using (lang) left join gt on gt.lang = g.lang and gt.source = g.source
       left join c on c.lang = g.lang and c.source = g.source and c.term = kept.term),
pairs as (select a.lang, a.source, b.source as item, coalesce(sum(f), 0)::bigint as value
          from g a join g b on a.lang = b.lang and a.source <> b.source
          left join (select x.lang, x.source, y.source as item, (x.p - y.p) * (x.p - y.p) // y.p as f from gp x join gp y on x.lang = y.lang and x.term = y.term) z
            on z.lang = a.lang and z.source = a.source and z.item = b.source
          group by all),
terms as (select lang, source, term as item, ((p - q) * (p - q) // q)::bigint as value from gp where n > 0 and p > q),
every as (select lang, source, 'pair' as part, item, value from pairs union all select lang, source, 'term', item, value from terms)
select lang, source, part, item, value, (row_number() over (partition by lang, source, part order by value desc, encode(item)))::int as rank
from every qualify part = 'pair' or rank <= {TOP}
"""
