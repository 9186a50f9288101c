"""Interval geometry: binned overlap joins, sessions, gaps, and the resolution of overlapping features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from contigframe import constants as C
from contigframe.operators import tables

BIN = 10_000
#: Rows of a block in running values along a contig.
BLOCK = 100_000


def overlap(a_s: Column, a_e: Column, b_s: Column, b_e: Column) -> Column:
    return F.greatest(F.least(a_e, b_e) - F.greatest(a_s, b_s) + 1, F.lit(0))


def _binned(df: DataFrame, prefix: str, bin_size: int, reach: int = 0) -> DataFrame:
    """Columns prefixed, one row for each bin that the interval, widened by ``reach``, touches."""
    cols = [F.col(c).alias(f"{prefix}{c}") for c in df.columns]
    first, last = F.floor((F.col("s") - reach) / bin_size), F.floor((F.greatest("s", "e") + reach) / bin_size)
    return df.select(*cols, F.explode(F.sequence(first.cast("long"), last.cast("long"))).alias(f"{prefix}bin"))


def overlap_join(left: DataFrame, right: DataFrame, condition: Column | None = None, bin_size: int = BIN, reach: int = 0, how: str = "inner") -> DataFrame:
    """Pairs (columns ``a_*`` of ``left`` and ``b_*`` of ``right``) on one contig that overlap, or come within ``reach``.

    Both sides are dealt to bins and meet by (contig, bin), so a contig of any length is many keys; a pair that shares bins is
    taken in the first of them alone. ``left_semi`` and ``left_anti`` join the found keys back by the unique column ``id`` of ``left``.
    """
    a, b = _binned(left, "a_", bin_size, reach), _binned(right, "b_", bin_size)
    owner = F.floor(F.greatest(F.col("a_s") - reach, F.col("b_s")) / bin_size)
    near = (F.col("a_s") - reach <= F.col("b_e")) & (F.col("b_s") <= F.col("a_e") + reach) & (F.col("a_bin") == owner)
    pairs = a.join(b, (F.col("a_contig") == F.col("b_contig")) & (F.col("a_bin") == F.col("b_bin")) & near & (F.lit(True) if condition is None else condition))
    if how == "inner":
        return pairs.drop("a_bin", "b_bin")
    return left.join(pairs.select(F.col("a_id").alias("id")).distinct(), "id", how)


def pair_overlap() -> Column:
    return overlap(F.col("a_s"), F.col("a_e"), F.col("b_s"), F.col("b_e"))


def conflict(fraction: float = C.OVERLAP_FRACTION) -> Column:
    """Overlap of at least ``fraction`` of the shorter one."""
    shorter = F.least(F.col("a_e") - F.col("a_s"), F.col("b_e") - F.col("b_s")) + 1
    return pair_overlap() >= fraction * shorter


def _blocked(rows: DataFrame, keys: list[str], position: str, block: int) -> DataFrame:
    """``rows`` with ``__block``: 0 where a group has at most ``block`` rows; a larger one is cut into stretches of positions, as many as it holds blocks. At most a row
    for each ``block`` rows is broadcast."""
    size = rows.groupBy(*keys).agg(F.count("*").alias("__n"), F.min(position).alias("__first"), F.max(position).alias("__last")).where(F.col("__n") > block)
    large = size.select(*[F.col(k).alias(f"__{k}") for k in keys], "__first", ((F.col("__last") - F.col("__first") + 1) / F.ceil(F.col("__n") / block)).alias("__width"))
    found = rows.join(F.broadcast(large), _same([F.col(k) for k in keys], [F.col(f"__{k}") for k in keys]), "left")
    return found.select(*rows.columns, F.coalesce(F.floor((F.col(position) - F.col("__first")) / F.col("__width")).cast("long") + 1, F.lit(0).cast("long")).alias("__block"))


def _same(left: list[Column], right: list[Column]) -> Column:
    condition = F.lit(True)
    for a, b in zip(left, right, strict=True):
        condition = condition & a.eqNullSafe(b)
    return condition


def _carried(own: DataFrame, keys: list[str], order: list[str], value: Column, how: str, name: str, before: bool = False) -> DataFrame:
    """As ``running``, of rows that have ``__block``. Only large groups have something to carry, a row for each block, which is broadcast."""
    fold = {"max": F.max, "sum": F.sum, "last": lambda c: F.last(c, ignorenulls=True)}[how]
    both = {"max": F.greatest, "sum": lambda a, b: F.when(a.isNotNull() | b.isNotNull(), F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))), "last": lambda a, b: F.coalesce(b, a)}[how]
    inner = Window.partitionBy(*keys, "__block").orderBy(*order)
    own = own.withColumn("__value", value)
    placed = own.withColumn("__own", fold("__value").over(inner.rowsBetween(Window.unboundedPreceding, -1 if before else 0)))
    total = F.max_by("__value", F.when(F.col("__value").isNotNull(), F.struct(*order))) if how == "last" else fold("__value")
    blocks = own.where("__block > 0").groupBy(*keys, "__block").agg(total.alias("__total"))
    carry = blocks.withColumn("__carry", fold("__total").over(Window.partitionBy(*keys).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1))).drop("__total")
    sides = [[F.col(f"{side}.{k}") for k in (*keys, "__block")] for side in "rc"]
    joined = placed.alias("r").join(F.broadcast(carry.alias("c")), _same(*sides), "left")
    return joined.select(*[F.col(f"r.{c}").alias(c) for c in own.columns if c != "__value"], both(F.col("c.__carry"), F.col("r.__own")).alias(name))


def running(rows: DataFrame, keys: list[str], position: str, order: list[str], value: Column, how: str, name: str, before: bool = False, block: int = BLOCK) -> DataFrame:
    """``rows`` with the running ``how`` ("max", "sum" or "last", which skips nulls) of ``value`` along ``order``, which begins with ``position``, as ``name``; with
    ``before``, of the rows before.

    Groups of at most ``block`` rows are windows of their own. A longer one is done in two levels, so that it isn't one task: within blocks of positions, then over a
    row for each block, whose result the next block's rows take up.
    """
    return _carried(_blocked(rows, keys, position, block), keys, order, value, how, name, before).drop("__block")


def sessions(rows: DataFrame, gap: int, *extra: str, order: str = "s") -> DataFrame:
    """``rows`` (contig, s, e, ...) with ``run``: a new run begins where a start lies more than ``gap`` beyond all ends before."""
    keys = ["contig", *extra]
    return _sessions(_blocked(rows, keys, order, BLOCK), gap, keys, order).drop("__block")


def _sessions(own: DataFrame, gap: int, keys: list[str], order: str = "s") -> DataFrame:
    """As ``sessions``, of rows that have ``__block`` and keep it."""
    marked = _carried(own, keys, [order, "e"], F.col("e"), "max", "__hi", before=True)
    marked = marked.withColumn("__new", F.when(F.col("__hi").isNull() | (F.col("s") - F.col("__hi") > gap), 1).otherwise(0))
    return _carried(marked, keys, [order, "e"], F.col("__new"), "sum", "run").drop("__hi", "__new")


def region_agg(runs: DataFrame, *extra: str) -> DataFrame:
    """Per run: start, end, the different classes in order, genes."""
    return runs.groupBy("contig", *extra, "run").agg(F.min("s").alias("s"), F.max("e").alias("e"), F.sort_array(F.collect_set("cls")).alias("classes"), F.count("*").alias("n"))


def prophage_regions(genes: DataFrame, core: tuple, gap: int = C.PROPHAGE_GAP, least: int = C.PROPHAGE_MIN_CLASSES, intact: int = C.PROPHAGE_INTACT, repeated: bool = False) -> DataFrame:
    """(contig, num, s, e, n, n_classes, tier): clusters of hallmark genes with enough classes, one of them a core class. With ``repeated``, equal rows (contig, s, e, cls) are one gene.

    Genes are moved once, to the place of their contig, or of its block: repeats go there, and runs are found and summed up there. Only those of contigs in blocks
    are moved again, a row for each block that they reach, and regions, to be numbered.
    """
    rows = _blocked(genes.select("contig", "s", "e", "cls") if repeated else genes, ["contig"], "s", BLOCK).repartition("contig", "__block")
    runs = _sessions(rows.distinct() if repeated else rows, gap, ["contig"])
    whole = region_agg(runs.where("__block = 0"), "__block")
    parts = region_agg(runs.where("__block > 0"), "__block").groupBy("contig", "run")
    joined = parts.agg(F.min("s").alias("s"), F.max("e").alias("e"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("classes")))).alias("classes"), F.sum("n").alias("n"))
    found = whole.select(*joined.columns).unionByName(joined).withColumn("n_classes", F.size("classes")).where((F.col("n_classes") >= least) & F.exists("classes", lambda x: x.isin(*core)))
    num = F.row_number().over(Window.partitionBy("contig").orderBy("s"))
    return found.select("contig", num.alias("num"), "s", "e", "n", "n_classes", F.when(F.col("n_classes") >= intact, "intact").otherwise("questionable").alias("tier"))


def intergenic_regions(features: DataFrame, contigs: DataFrame, least: int = C.INTERGENIC_MIN) -> DataFrame:
    """(contig, s, e): gaps of at least ``least`` between all features of a contig (contig, length), before the first and after the last too."""
    marks = features.select("contig", "s", "e").unionByName(contigs.select("contig", (F.col("length") + 1).alias("s"), (F.col("length") + 1).alias("e")))
    known = running(marks, ["contig"], "s", ["s", "e"], F.col("e"), "max", "__hi", before=True).join(contigs.select("contig", "length"), "contig")
    known = known.withColumn("from", F.greatest(F.coalesce(F.col("__hi") + 1, F.lit(1)), F.lit(1)))
    return known.where((F.col("s") <= F.col("length") + 1) & (F.col("s") - F.col("from") >= least)).select("contig", F.col("from").alias("s"), (F.col("s") - 1).alias("e"))


def integrase_attc(integrases: DataFrame, sites: DataFrame, window: int = C.ATTC_WINDOW) -> DataFrame:
    """(site id, integrase id): each site goes to the first integrase (by ``ord``) within ``window`` of it."""
    pairs = overlap_join(sites, integrases, reach=window)
    first = F.row_number().over(Window.partitionBy("a_id").orderBy("b_ord"))
    return pairs.withColumn("__n", first).where("__n = 1").select(F.col("a_id").alias("site"), F.col("b_id").alias("integrase"))


def integrons(integrases: DataFrame, sites: DataFrame, window: int = C.ATTC_WINDOW, calin: int = C.CALIN_MIN) -> DataFrame:
    """(contig, class, s, e, n_sites): complete (integrase with sites), In0 (integrase alone), CALIN (sites alone, at least ``calin``).
    A site that an integrase has claimed also breaks a run of free ones."""
    claims = integrase_attc(integrases, sites, window)
    all_sites = sites.join(claims, sites["id"] == claims["site"], "left")
    per = all_sites.where("integrase is not null").groupBy("integrase").agg(F.min("s").alias("ms"), F.max("e").alias("me"), F.count("*").alias("n_sites"))
    with_int = integrases.join(per, integrases["id"] == per["integrase"], "left").select(
        "contig", F.when(F.col("n_sites") > 0, "complete").otherwise("In0").alias("class"), F.least("s", F.coalesce("ms", "s")).alias("s"), F.greatest("e", F.coalesce("me", "e")).alias("e"), F.coalesce("n_sites", F.lit(0)).alias("n_sites")
    )
    block = F.sum(F.col("integrase").isNotNull().cast("int")).over(Window.partitionBy("contig").orderBy("s", "e", "id").rowsBetween(Window.unboundedPreceding, 0))
    free = all_sites.withColumn("block", block).where("integrase is null").select("contig", "s", "e", "block")
    runs = sessions(free, window, "block").groupBy("contig", "block", "run").agg(F.min("s").alias("s"), F.max("e").alias("e"), F.count("*").alias("n_sites")).where(F.col("n_sites") >= calin)
    return with_int.unionByName(runs.select("contig", F.lit("CALIN").alias("class"), "s", "e", "n_sites"))


def greedy_keep(rows: DataFrame, order: list[Column], fraction: float | None = C.OVERLAP_FRACTION) -> DataFrame:
    """The rows (contig, id, s, e, ...; ``id`` is unique) that stay when, in ``order`` (ascending, then by id), each one that conflicts with a kept one goes.

    Conflicts are pairs from a binned join, each from the earlier row to the later one. In each round all rows that no earlier undecided one
    conflicts with stay, and those that they conflict with go, with their pairs; so places far apart are decided together, and
    rounds are as many as the longest chain of decisions that depend on each other. The driver sees only whether pairs are left.
    ``fraction`` None: any overlap is a conflict.
    """
    lost = _lost(rows, order, fraction)
    return tables.written(rows if lost is None else rows.join(lost, "id", "left_anti").select(*rows.columns), "kept")


def _lost(rows: DataFrame, order: list[Column], fraction: float | None) -> DataFrame | None:
    """A table of the ids that ``greedy_keep`` leaves out, or None where nothing conflicts."""
    with tables.Rounds(rows.sparkSession, "conflicts") as tmp:
        ranked = rows.select("contig", "s", "e", F.struct(*[o.alias(f"o{k}") for k, o in enumerate(order)], F.col("id").alias("last")).alias("rank"))
        rule = F.col("a_rank") < F.col("b_rank")
        pairs = overlap_join(ranked, ranked, rule if fraction is None else rule & conflict(fraction))
        pairs = tmp.written(pairs.select(F.col("a_rank.last").alias("a"), F.col("b_rank.last").alias("b")))
        gone = None
        while pairs.limit(1).count():
            first = pairs.select("a").distinct().join(pairs.select(F.col("b").alias("a")).distinct(), "a", "left_anti")
            lost = tmp.written(pairs.join(first, "a", "left_semi").select("b").distinct())
            gone = lost if gone is None else gone.unionByName(lost)
            pairs = tmp.written(pairs.join(lost, "b", "left_anti").join(lost.withColumnRenamed("b", "a"), "a", "left_anti").select("a", "b"))
        return None if gone is None else tables.written(gone.withColumnRenamed("b", "id"), "lost")


def resolve(features: DataFrame, kinds: DataFrame) -> DataFrame:
    """``features`` (contig, id, kind, s, e, score) without those that lose a conflict, with kinds as in ``kinds``.

    Kinds that take no part pass. RNAs: in order of priority, score and appearance (``ord``, else id), one that conflicts with a kept RNA goes.
    CDS: one that conflicts with a kept RNA goes; CDS never conflict with each other.
    """
    known = features.join(F.broadcast(kinds.select("kind", "priority", "resolvable")), "kind")  # the vocabulary has 14 rows
    known = known.withColumn("__part", F.when(F.col("kind") == "Cds", "cds").when(F.col("resolvable"), "rna").otherwise("none"))
    rna = known.where("resolvable and kind <> 'Cds'")
    lost = _lost(rna, [-F.col("priority"), -F.col("score"), _appearance(features)], C.OVERLAP_FRACTION)
    kept = rna if lost is None else rna.join(lost, "id", "left_anti")
    place = ["contig", "id", "s", "e"]
    cds = overlap_join(known.where("kind = 'Cds'").select(*place), kept.select(*place), conflict()).select(F.col("a_id").alias("id")).distinct().withColumn("__part", F.lit("cds"))
    gone = cds if lost is None else cds.unionByName(lost.withColumn("__part", F.lit("rna")))
    return known.join(gone, ["id", "__part"], "left_anti").select(*features.columns)


def _appearance(rows: DataFrame) -> Column:
    return F.col("ord" if "ord" in rows.columns else "id")


def final_sort(features: DataFrame) -> DataFrame:
    """By contig and place; features of one place as they appeared."""
    return features.orderBy("contig", "s", "e", _appearance(features))


def split_numbered(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` with ``num``: 1, 2, ... within each contig."""
    return rows.withColumn("num", F.row_number().over(Window.partitionBy("contig").orderBy(*order)))


def global_number(rows: DataFrame, *order: str, name: str = "n") -> DataFrame:
    """``rows`` numbered over all contigs by (contig, order) without a single-partition window: within contigs, plus what the contigs before have."""
    counts = rows.groupBy("contig").agg(F.count("*").alias("__c"))
    offsets = counts.withColumn("__before", F.coalesce(F.sum("__c").over(Window.orderBy("contig").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("__c")
    return split_numbered(rows, *order).join(offsets, "contig").withColumn(name, F.col("__before") + F.col("num")).drop("__before", "num")


def locus_tags(features: DataFrame, prefix: str, *order: str) -> DataFrame:
    """``features`` with ``locus_tag``: prefix and number, as wide as the count of features, at least 5. Every row counts, gaps too."""
    total = features.agg(F.greatest(F.length(F.count("*").cast("string")), F.lit(5)).alias("__w"))
    numbered = global_number(features, *order).join(F.broadcast(total))  # one row is broadcast
    return numbered.withColumn("locus_tag", F.concat(F.lit(f"{prefix}_"), F.expr("lpad(cast(n as string), __w, '0')"))).drop("__w")


def span_distance(a_s: Column, a_e: Column, b_s: Column, b_e: Column) -> Column:
    return F.greatest(b_s - a_e, a_s - b_e, F.lit(0))


def colocated(sites: DataFrame, relaxases: DataFrame, window: int = C.ORIT_WINDOW) -> DataFrame:
    """``sites`` (with a unique id) and ``near``: whether a relaxase lies within ``window``."""
    near = overlap_join(sites, relaxases, reach=window).select(F.col("a_id").alias("id")).distinct().withColumn("near", F.lit(True))
    return sites.join(near, "id", "left").withColumn("near", F.coalesce("near", F.lit(False)))


def gate_orit(hits: DataFrame) -> DataFrame:
    """Hits (evalue, pident, tcov, alnlen, near, bits, ...) that pass the base bar near a relaxase or the stricter one alone; of
    overlapping ones the higher bits stay, of equal ones the first."""

    def bar(g: dict) -> Column:
        return (F.col("evalue") <= g["evalue"]) & (F.col("pident") >= g["pident"]) & (F.col("tcov") >= g["tcov"]) & (F.col("alnlen") >= g["alnlen"])

    passing = hits.where(bar(C.ORIT_BASE) & (F.col("near") | bar(C.ORIT_ALONE)))
    return greedy_keep(passing, [-F.col("bits"), _appearance(hits)], fraction=None)


def adjacent_pairs(features: DataFrame) -> DataFrame:
    """With the next feature of the strand: ``next_id`` and the ``gap`` to it, negative where they overlap; null for the last one."""
    w = Window.partitionBy("contig", "strand").orderBy("s", "e", "id")
    return features.withColumns({"next_id": F.lead("id").over(w), "gap": F.lead("s").over(w) - F.col("e") - 1})


def running_cursor(features: DataFrame) -> DataFrame:
    """With ``cursor``: the first position of the contig that no earlier feature reaches."""
    got = running(features, ["contig"], "s", ["s", "e", "id"], F.col("e"), "max", "__hi", before=True)
    return got.withColumn("cursor", F.greatest(F.coalesce(F.col("__hi") + 1, F.lit(1)), F.lit(1))).drop("__hi")
