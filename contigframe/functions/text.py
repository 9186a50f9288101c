"""Scalar functions on names, accessions and descriptions, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from contigframe import constants as C


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def first_token(c: Column | str) -> Column:
    return F.split(col(c), "[ \t]")[0]


def strip_version(c: Column | str) -> Column:
    """Without a closing full stop and digits; other suffixes stay."""
    return F.regexp_replace(col(c), r"\.[0-9]+$", "")


def bare_accession(c: Column | str) -> Column:
    """What stands before the first full stop."""
    return F.substring_index(col(c), ".", 1)


def nonempty(c: Column | str) -> Column:
    return F.nullif(F.trim(col(c)), F.lit(""))


def split_multi(c: Column | str) -> Column:
    return F.filter(F.transform(F.split(col(c), "[,;]"), lambda x: F.trim(x)), lambda x: x != "")


def parse_ec(c: Column | str) -> Column:
    """EC numbers within ``[EC:...]``; an unclosed bracket runs to the end."""
    inside = F.regexp_extract(col(c), r"\[EC:([^\]]*)", 1)
    return F.filter(F.split(F.trim(inside), r"\s+"), lambda x: x != "")


def norm_pident(c: Column | str) -> Column:
    """Identities given as fractions become percentages."""
    return F.when(col(c) <= 1, col(c) * 100).otherwise(col(c))


def parse_evalue(c: Column | str) -> Column:
    """Malformed E-values are infinite, so no gate lets them pass."""
    return F.coalesce(F.nanvl(col(c).try_cast("double"), F.lit(float("inf"))), F.lit(float("inf")))


def is_placeholder(c: Column | str) -> Column:
    return F.lower(F.trim(col(c))).isin(*C.PLACEHOLDERS)


def clean_product(c: Column | str) -> Column:
    return F.when(is_placeholder(c), "hypothetical protein").otherwise(F.trim(col(c)))


def informative_product(c: Column | str) -> Column:
    low = F.lower(F.trim(col(c)))
    return (low != "") & ~low.contains("hypothetical") & ~low.contains("uncharacter") & ~low.contains("domain-containing") & ~low.rlike("duf[0-9]")


def sanitize_product(c: Column | str) -> Column:
    return F.rtrim(F.regexp_replace(F.trim(F.regexp_replace(col(c), r"\s+", " ")), r"\.+$", ""))


def normalize_rrna(c: Column | str) -> Column:
    key, out = F.trim(col(c)), None
    for name, product in C.RRNA_PRODUCTS.items():
        out = F.when(key == name, product) if out is None else out.when(key == name, product)
    for prefix, product in C.RRNA_PREFIXES:
        out = out.when(key.startswith(prefix), product)
    return out.otherwise(key)


def normalize_trna(c: Column | str) -> Column:
    iso = F.trim(F.regexp_extract(F.trim(col(c)), "^tRNA-(.*)$", 1))
    return F.when(F.lower(iso).isin(*C.UNDETERMINED_TRNA), "tRNA-Xxx").otherwise(F.concat(F.lit("tRNA-"), iso))


def replicon_type(c: Column | str) -> Column:
    return F.substring_index(col(c), "_", 1)


def rank_value(taxonomy: Column | str, prefix: str) -> Column:
    return F.trim(F.regexp_extract(col(taxonomy), f"(?:^|;) *{prefix}__([^;]*)", 1))


def assign_rank(taxonomy: Column | str, identity: Column | str) -> Column:
    """The species, genus or family the identity supports, else the deepest rank with a name."""
    i = col(identity)
    named = lambda p: F.nullif(rank_value(taxonomy, p), F.lit(""))
    higher = F.coalesce(*[named(p) for p in "gocpd"])
    return F.coalesce(
        F.when(i >= C.SPECIES_IDENTITY, named("s")), F.when(i >= C.GENUS_IDENTITY, F.concat(named("g"), F.lit(" (genus)"))),
        F.concat(named("f"), F.lit(" (family)")), F.concat(higher, F.lit(" (higher rank)")), F.lit("unclassified"),
    )


def mob_family(name: Column | str, acc: Column | str) -> Column:
    bare, out = bare_accession(acc), None
    for a, family in C.MOB_ACCESSIONS.items():
        out = F.when(bare == a, family) if out is None else out.when(bare == a, family)
    token = F.regexp_extract(F.upper(col(name)), "(MOB[A-Z0-9]*)", 1)
    return out.when(token != "", token).otherwise(F.coalesce(F.nullif(col(name), F.lit("")), F.nullif(col(acc), F.lit("")), F.lit("relaxase")))


def hallmark_class(name: Column | str, acc: Column | str) -> Column:
    out = None
    for key, table in ((bare_accession(acc), C.HALLMARK_ACCESSIONS), (col(name), C.HALLMARK_NAMES)):
        for cls, values in table.items():
            test = key.isin(*values.split())
            out = F.when(test, cls) if out is None else out.when(test, cls)
    return out


def regulatory_class(c: Column | str) -> Column:
    t = F.lower(col(c))
    return F.when(t.contains("riboswitch"), "riboswitch").when(t.contains("leader"), "attenuator").when(t.contains("frameshift"), "recoding_stimulatory_region").otherwise("other")


def marker_key(product: Column | str) -> Column:
    """The ribosomal-protein marker a product names, or null."""
    token = F.upper(F.regexp_extract(col(product), r"(?i)ribosomal protein ([^\s,(;]*)", 1))
    return F.when(token.isin(*C.MARKERS), token)


def ncrna_class(name: Column | str) -> Column:
    n = F.lower(col(name))
    return F.when(n.rlike("(?<![a-z0-9])(rrna|ribosomal rna)(?![a-z0-9])"), "Rrna").when(n.rlike("(?<![a-z0-9])(tmrna|transfer-messenger)(?![a-z0-9])"), "Tmrna").otherwise("Ncrna")


def cog_mask(letters: Column | str) -> Column:
    """Category letters as bits, in the fixed order of the vocabulary; other characters count for nothing."""
    up = F.upper(col(letters))
    out = F.lit(0)
    for k, letter in enumerate(C.COG_LETTERS):
        out = out.bitwiseOR(F.when(up.contains(letter), 1 << k).otherwise(0))
    return out


def cog_letters(mask: Column | str) -> Column:
    return F.concat(*[F.when(col(mask).bitwiseAND(F.lit(1 << k)) != 0, letter).otherwise("") for k, letter in enumerate(C.COG_LETTERS)])


def hmm_inference_db(source: Column | str) -> Column:
    """Evidence database of a profile search's source label ("search:db"), else null."""
    db = F.regexp_extract(col(source), "^hmm:(.+)$", 1)
    return F.when(db == "ncbifams", "NCBIfam").when(db == "pfam", "Pfam").when(db != "", F.concat(F.upper(F.substring(db, 1, 1)), F.substring(db, 2, 1000)))


def render_inference(category: Column, kind: Column, same_species: Column, db: Column, accession: Column) -> Column:
    return F.concat(
        F.when(F.coalesce(category, F.lit("")) != "", F.concat(category, F.lit(": "))).otherwise(""), kind, F.when(same_species, " (same species)").otherwise(""),
        F.when(db != "", F.concat(F.lit(":"), db, F.when(accession != "", F.concat(F.lit(":"), accession)).otherwise(""))).otherwise(""),
    )


def percent_encode(c: Column | str) -> Column:
    out = F.replace(col(c), F.lit("%"), F.lit("%25"))
    for ch, code in ((",", "%2C"), (";", "%3B"), ("=", "%3D"), ("&", "%26"), ("\t", "%09"), ("\n", "%0A"), ("\r", "%0D")):
        out = F.replace(out, F.lit(ch), F.lit(code))
    return out


def is_transposase(product: Column | str, names: Column | None = None) -> Column:
    def test(c: Column) -> Column:
        return F.coalesce(F.lower(c).rlike("transpos|insertion sequence|is element"), F.lit(False))

    return test(col(product)) if names is None else test(col(product)) | F.exists(F.coalesce(names, F.array().cast("array<string>")), test)


_SPEC = "^([ARNDCQEGHILKMFPSTWYV]+)([0-9]+)(.*)$"


def mutation_spec(spec: Column | str) -> Column:
    """A struct (ref, pos, effect, alt, span) of a substitution, nonsense or deletion; null for any other form."""
    refs, digits, tail = (F.regexp_extract(col(spec), _SPEC, k) for k in (1, 2, 3))
    pos, one = digits.try_cast("long"), F.length(refs) == 1
    effect = F.when(one & tail.rlike("^[ARNDCQEGHILKMFPSTWYV]$"), "substitution").when(one & tail.isin("Ter", "*"), "nonsense").when(tail == "del", "deletion")
    return F.when(
        (pos > 0) & effect.isNotNull(),
        F.struct(F.substring(refs, 1, 1).alias("ref"), pos.alias("pos"), effect.alias("effect"), F.when(effect == "substitution", tail).alias("alt"), F.when(effect == "deletion", F.length(refs)).alias("span")),
    )


def mutation_note(cls: Column, gene: Column, spec: Column) -> Column:
    site = F.concat(F.lit(" "), gene, F.lit(" "), spec["ref"], spec["pos"].cast("string"))
    text = (
        F.when(spec["effect"] == "substitution", F.concat(F.lit("point mutation"), site, spec["alt"]))
        .when(spec["effect"] == "nonsense", F.concat(F.lit("nonsense"), site, F.lit("Ter")))
        .when(spec["span"] == 1, F.concat(F.lit("deletion"), site, F.lit("del")))
        .otherwise(F.concat(F.lit("deletion"), site, F.lit("del ("), spec["span"].cast("string"), F.lit(" residues)")))
    )
    return F.concat(cls, F.lit(" resistance: "), text)
