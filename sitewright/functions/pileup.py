"""Pileup strings and base votes as native column expressions (no UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sitewright.schema import MISSING, PILEUP_SYMBOLS


def occurrences(text: Column, symbol: str) -> Column:
    """How often a one-character symbol occurs in ``text``."""
    return (F.length(text) - F.length(F.replace(text, F.lit(symbol), F.lit("")))).cast("bigint")


def strip_indels(bases: Column) -> Column:
    """Remove ``+n``/``-n`` marks with the n characters that follow, for any n."""

    def rest(piece: Column, i: Column) -> Column:
        size = F.regexp_extract(piece, r"^\d+", 0)
        return F.when(i == 0, piece).otherwise(
            F.substring(piece, F.length(size) + size.cast("int") + 1, F.length(piece))
        )

    stripped = F.array_join(F.transform(F.split(bases, r"[+-](?=\d)"), rest), "")
    return F.when(bases.rlike(r"[+-]\d"), stripped).otherwise(bases)


def without_starts(bases: Column) -> Column:
    """Remove each ``^`` with the mapping quality it hides."""
    return F.regexp_replace(bases, r"\^.", "")


def decode(ref: Column, bases: Column) -> Column:
    """Reads' bases at a pileup position, as a string over ``ACGT*``.

    Takes bases without read starts. Indel marks are skipped, dots and commas stand for
    the reference base; everything else outside ``ACGT*`` is dropped.
    """
    as_ref = F.replace(F.replace(strip_indels(bases), F.lit("."), ref), F.lit(","), ref)
    return F.regexp_replace(F.upper(as_ref), "[^ACGT*]", "")


def vote_counts(decoded: Column) -> dict[str, Column]:
    return {b: occurrences(decoded, b) for b in PILEUP_SYMBOLS}


def first_positions(decoded: Column) -> dict[str, Column]:
    return {b: F.instr(decoded, b) for b in PILEUP_SYMBOLS}


def total_votes(counts: dict[str, Column]) -> Column:
    total = None
    for c in counts.values():
        total = c if total is None else total + c
    return total


def _winner(counts: dict[str, Column], tie_break) -> Column:
    """Symbol with the most votes; ``tie_break(symbol)`` orders equal counts."""
    ranked = [
        F.when(c > 0, F.struct((-c).alias("n"), tie_break(b).alias("t"), F.lit(b).alias("b")))
        for b, c in counts.items()
    ]
    return F.least(*ranked)["b"]


def majority_base(counts: dict[str, Column]) -> Column:
    """Most voted base; among equals a base beats ``*`` and then the alphabet decides.

    A lone ``*`` winner gives ``N``; no vote at all gives NULL.
    """
    top = _winner(counts, lambda b: F.lit(1 if b == "*" else 0))
    return F.when(top == "*", F.lit(MISSING)).otherwise(top)


def call(counts: dict[str, Column], minread: int, thresh: float, first: dict[str, Column] | None = None) -> Column:
    """Thresholded call as ``struct(base, penalty)``.

    ``penalty`` is NULL for a called base, else ``min``, ``thresh`` or ``both``.
    Equal top counts go to the symbol seen first. A tie at the top holds at most half
    of the votes, so above 0.5 it is never called and ``first`` may be left out.
    """
    if first is None and thresh <= 0.5:
        raise ValueError("a threshold of 0.5 or less needs the first positions to break ties")
    top = _winner(counts, (lambda b: first[b]) if first else (lambda b: F.lit(PILEUP_SYMBOLS.index(b))))
    votes = F.coalesce(F.greatest(*counts.values()), F.lit(0))
    total = total_votes(counts)
    few = votes < minread
    mixed = F.when(total > 0, votes / total < thresh).otherwise(F.lit(False))
    base = F.when(few | mixed | (total == 0), F.lit(MISSING)).when(top == "*", F.lit("-")).otherwise(top)
    penalty = F.when(few & mixed, "both").when(few, "min").when(mixed, "thresh").when(total == 0, "min")
    return F.struct(base.alias("base"), penalty.alias("penalty"))
