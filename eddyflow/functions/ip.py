"""IPv4 text to number and back, as built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import java_split


def ip_to_number(ip: Column) -> Column:
    """Left fold over the dot-separated parts: ``acc = part | (acc << 8)``.

    Any number of parts is accepted and no range is checked, so an octet above
    255 ORs into the neighbouring bits (``1.300.0.0`` gives 19660800), as in the
    original lookup.  Parts are split like Java's ``split("[.]")``: trailing
    empty parts are dropped, so ``1.2.3.4.`` is read as four parts and ``...``
    as none (0).  A non-numeric part is a cast error under ANSI mode.  A null
    text gives null.
    """
    return ip_parts_to_number(java_split(ip, "."))


def ip_parts_to_number(parts: Column) -> Column:
    """``ip_to_number`` on already split parts.  Give it a column computed
    in an earlier projection so the split runs once per row.

    The fold ``acc = part | (acc << 8)`` equals OR over the parts of
    ``part << 8*(n-1-i)`` with bits past 64 falling off, so only the last
    eight parts can leave any bit.  That is written as a fixed OR of shifted
    terms (no lambda), which keeps the whole projection inside whole-stage
    codegen; the common four-part case uses the four-term form.
    """
    four = _or_terms([(F.get(parts, i).cast("bigint"), 8 * (3 - i)) for i in range(4)])
    n = F.size(parts)
    last8 = _or_terms([(F.coalesce(F.get(parts, n - 1 - j).cast("bigint"), F.lit(0).cast("bigint")), 8 * j)
                       for j in range(8)])
    return F.when(n == 4, four).when(parts.isNotNull(), last8)


def is_ip_text(ip: Column) -> Column:
    """Whether ``ip_to_number`` can read the text: numbers between dots."""
    return F.coalesce(ip.rlike(r"^(-?\d{1,18}(\.-?\d{1,18})*)?\.*$") & (ip != ""), F.lit(False))


def _or_terms(terms: list[tuple[Column, int]]) -> Column:
    out = None
    for value, shift in terms:
        term = F.shiftleft(value, shift) if shift else value
        out = term if out is None else out.bitwiseOR(term)
    return out


def number_to_ip(num: Column) -> Column:
    """Dotted text of the low 32 bits of ``num``."""
    return F.concat_ws(".", *[
        (F.shiftright(num, s) % 256).cast("string") for s in (24, 16, 8, 0)
    ])
