"""Expressions over sequence strings and sample names; everything stays in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The alphabets used for case folding and for complementing bases.
LOWER = "abcdefghijklmnopqrstuvwxyz"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BASES = "ACGTacgt"
COMPLEMENTS = "TGCAtgca"

GAP = "-"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _is_ascii(text: Column) -> Column:
    return F.octet_length(text) == F.length(text)


def fold_case(seq: Column | str) -> Column:
    """Upper-case the letters a-z only, so that a length never changes.

    Plain `upper` does the same to ASCII text and is faster; other text goes letter by letter.
    """
    seq = _col(seq)
    return F.when(_is_ascii(seq), F.upper(seq)).otherwise(F.translate(seq, LOWER, UPPER))


def fold_lower(seq: Column | str) -> Column:
    """Lower-case the letters A-Z only."""
    seq = _col(seq)
    return F.when(_is_ascii(seq), F.lower(seq)).otherwise(F.translate(seq, UPPER, LOWER))


def reverse_complement(seq: Column | str) -> Column:
    """Complement A, C, G and T in either case, keep every other character, and reverse."""
    return F.reverse(F.translate(_col(seq), BASES, COMPLEMENTS))


def gc_fraction(seq: Column | str) -> Column:
    """Share of G and C; NULL for an empty sequence."""
    seq = _col(seq)
    return F.when(F.length(seq) > 0, F.regexp_count(seq, F.lit("[GC]")) / F.length(seq))


def coord_label(chrom: Column | str, start: Column | str, stop: Column | str) -> Column:
    """``chr:start-stop`` with ``?`` for what is missing."""
    part = [F.coalesce(_col(c).cast("string"), F.lit("?")) for c in (chrom, start, stop)]
    return F.concat(part[0], F.lit(":"), part[1], F.lit("-"), part[2])


def cluster_label(cluster: Column | str) -> Column:
    """``Noise`` for -1, ``C<n>`` otherwise."""
    cluster = _col(cluster)
    return F.when(cluster == -1, F.lit("Noise")).otherwise(F.concat(F.lit("C"), cluster.cast("string")))


def condition_of(sample: str) -> str | None:
    """Condition of a sample column: the second ``_``-separated token of its name."""
    tokens = sample.split("_")
    return tokens[1] if len(tokens) >= 2 else None


def pieces(text: Column | str, size: int, overlap: int = 0) -> Column:
    """Cut a string into consecutive pieces of ``size`` characters, each with up to ``overlap``
    characters of what follows.

    One linear regex pass; repeated ``substr`` on the whole string would rescan it from the start for
    every piece.
    """
    pattern = f"(?s)(?=(.{{1,{size + overlap}}})).{{1,{size}}}"
    return F.regexp_extract_all(_col(text), F.lit(pattern), F.lit(1))


def wrap_lines(seq: Column | str, line: int = 80) -> Column:
    """Insert a newline after every ``line`` characters, none at the end."""
    return F.regexp_replace(_col(seq), f"(?s)(.{{{line}}})(?=.)", "$1\n")


def without_gaps(seq: Column | str) -> Column:
    return F.replace(_col(seq), F.lit(GAP), F.lit(""))


def ungapped_length(seq: Column | str) -> Column:
    """Number of characters that are not gaps."""
    return F.length(without_gaps(seq))
