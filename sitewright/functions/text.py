"""Small string and number rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sitewright.schema import ANALYTIC_SYMBOLS


def locus_name(contig: Column | str = "contig", pos: Column | str = "pos") -> Column:
    """``contig/pos``. Keep contig and pos apart until output: ids may hold a slash."""
    return F.concat_ws("/", contig, pos)


def pair_name(a: Column | str, b: Column | str) -> Column:
    return F.concat_ws(";", F.least(a, b), F.greatest(a, b))


def isolate_id(path: Column | str, trim: str = "") -> Column:
    """File name without its last extension and without ``trim``."""
    path = F.col(path) if isinstance(path, str) else path
    name = F.regexp_extract(path, r"([^/]*)$", 1)
    stem = F.regexp_replace(name, r"(?<=[^.])\.[^.]*$", "")
    return F.replace(stem, F.lit(trim), F.lit("")) if trim else stem


def recode_gaps(symbols: Column | str) -> Column:
    """``0`` for a base of either case, ``1`` for a gap, ``N`` for anything else."""
    symbols = F.col(symbols) if isinstance(symbols, str) else symbols
    valid = F.regexp_replace(symbols, f"[^{ANALYTIC_SYMBOLS}]", "N")
    return F.translate(valid, ANALYTIC_SYMBOLS, "000000001")


def valid_symbols(symbols: Column | str, alphabet: str) -> Column:
    symbols = F.col(symbols) if isinstance(symbols, str) else symbols
    return F.regexp_replace(symbols, f"[^{alphabet}]", "")


def has_two_kinds(symbols: Column | str, alphabet: str) -> Column:
    """True when a string holds two different characters of ``alphabet``.

    ``alphabet`` is the inside of a character class. The first match is pinned at the
    start, so one pass decides.
    """
    symbols = F.col(symbols) if isinstance(symbols, str) else symbols
    other = alphabet[1:] if alphabet.startswith("^") else "^" + alphabet
    return symbols.rlike(rf"^[{other}]*([{alphabet}]).*(?!\1)[{alphabet}]")


def letter(symbols: Column | str, at: Column) -> Column:
    """Character at a 1-based place of an ASCII string, without walking to it."""
    symbols = F.col(symbols) if isinstance(symbols, str) else symbols
    return F.substring(symbols.cast("binary"), at, F.lit(1)).cast("string")


def percent(part: Column, whole: Column) -> Column:
    """Percentage with two decimals, as text."""
    return F.format_string("%.2f", F.when(whole > 0, part / whole * 100).otherwise(F.lit(0.0)))


def thousands(number: Column | str) -> Column:
    return F.format_number(number, 0)
