"""Formatted identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def zero_pad(k: Column, width: int) -> Column:
    """``k`` as text, zero-padded to ``width`` digits: same text as
    ``printf('%0{width}d', k)``. Longer numbers are kept whole (``lpad`` alone
    would cut them); negative numbers take the printf path. The common case
    stays in generated code instead of a per-row ``String.format`` call."""
    s = k.cast("string")
    return (F.when(k >= 0, F.when(F.length(s) < width, F.lpad(s, width, "0")).otherwise(s))
            .otherwise(F.format_string(f"%0{width}d", k)))


def prefixed_id(prefix: str, k: Column, width: int) -> Column:
    """``prefix`` followed by the zero-padded key, e.g. ``CUST-007``."""
    return F.concat(F.lit(prefix), zero_pad(k, width))


SCATTER_MOD = 1_000_003


def scatter(*keys: Column) -> Column:
    """A repeatable pseudo-random number below SCATTER_MOD over integer keys (no overflow)."""
    expr = F.lit(0).cast("bigint")
    for i, k in enumerate(keys):
        expr = (expr * 31 + (k.cast("bigint") % SCATTER_MOD) * (7919 + 104729 * i)) % SCATTER_MOD
    return expr


TAIL_MOD = 999_983
# A fraction of the rows is chosen in steps of 1 / FINE_MOD, about 2 ** -40.
FINE_MOD = SCATTER_MOD * TAIL_MOD


def fine_scatter(*keys: Column) -> Column:
    """A repeatable pseudo-random number below FINE_MOD over integer keys:
    ``scatter`` as the leading digits, squares of the keys modulo another prime
    as the others (no overflow)."""
    tail = F.lit(0).cast("bigint")
    for i, k in enumerate(keys):
        r = k.cast("bigint") % TAIL_MOD
        tail = (tail * 37 + r * (r + 15485 + 86243 * i)) % TAIL_MOD
    return scatter(*keys) * TAIL_MOD + tail
