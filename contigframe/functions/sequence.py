"""Scalar functions on nucleotide and protein sequences."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from contigframe import constants as C
from contigframe.functions.text import col

# The standard genetic code in TCAG order.
_BASES, _CODE = "TCAG", "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"


def revcomp_n(c: Column | str) -> Column:
    """Reverse complement; anything but ACGT becomes N."""
    return F.reverse(F.translate(F.regexp_replace(F.upper(col(c)), "[^ACGT]", "N"), "ACGT", "TGCA"))


def revcomp_keep(c: Column | str) -> Column:
    """Reverse complement; anything but ACGT stays."""
    return F.reverse(F.translate(F.upper(col(c)), "ACGT", "TGCA"))


def codons(c: Column | str) -> Column:
    """Whole codons from the first base on, in one pass."""
    return F.regexp_extract_all(col(c), F.lit("(?s)..."), 0)


def translate_codon(c: Column | str) -> Column:
    """Amino acid of a codon by the standard code; X if ambiguous. The place in the table is computed, so it stays an expression."""
    at = lambda k: F.instr(F.lit(_BASES), F.substring(c, k, 1)) - 1
    c = col(c)
    place = at(1) * 16 + at(2) * 4 + at(3)
    plain = (F.length(c) == 3) & (at(1) >= 0) & (at(2) >= 0) & (at(3) >= 0)
    return F.when(plain, F.substring(F.lit(_CODE), place + 1, F.lit(1))).otherwise("X")


def translate(c: Column | str) -> Column:
    return F.array_join(F.transform(codons(c), lambda x: translate_codon(x)), "")


def is_start(c: Column | str) -> Column:
    return col(c).isin(*C.STARTS)


def is_stop(c: Column | str) -> Column:
    return col(c).isin(*C.STOPS)


def is_reverse_stop(c: Column | str) -> Column:
    """A stop of the other strand, as read on this one."""
    return col(c).isin("TTA", "CTA", "TCA")


def frame_of(qstart: Column | str, qend: Column | str) -> tuple[Column, Column]:
    """(strand, phase) of a translated hit: strand from the direction, phase from the low coordinate."""
    return F.when(col(qend) >= col(qstart), 1).otherwise(-1), F.pmod(F.least(col(qstart), col(qend)) - 1, F.lit(3)).cast("int")


def len_nt(start: Column | str, end: Column | str) -> Column:
    return F.greatest(col(end) - col(start) + 1, F.lit(0))


def low_partial(strand: Column, partial5: Column, partial3: Column) -> Column:
    return F.when(strand == -1, partial3).otherwise(partial5)


def high_partial(strand: Column, partial5: Column, partial3: Column) -> Column:
    return F.when(strand == -1, partial5).otherwise(partial3)


def contig_edge(start: Column | str, end: Column | str, length: Column | str) -> Column:
    return (col(start) <= C.EDGE) | (col(end) >= col(length) - C.EDGE)
