"""Text-to-type parsing for raw loads.

Raw loads arrive as text. Every cast is a ``try_cast`` so that a bad value
becomes NULL and is reported by the integrity checks instead of failing the
whole job under ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from billbook.schemas import MONEY


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_id(c: Column | str) -> Column:
    """Keep only the digits of an id and read them as bigint.

    ``'FAT-001'`` -> 1, ``'12.0'`` -> 120, ``'abc'`` -> NULL (no digits left).
    """
    digits = F.regexp_replace(_col(c).cast("string"), r"[^0-9]", "")
    return digits.try_cast("bigint")


def parse_date(c: Column | str) -> Column:
    """ISO date text (optionally followed by a time) -> date; anything else -> NULL."""
    return _col(c).cast("string").try_cast("date")


def money(c: Column | str) -> Column:
    """Text or number -> decimal(15,2); unparsable -> NULL."""
    return _col(c).cast("string").try_cast(MONEY)


def version_key(first: Column | str, second: Column | str) -> Column:
    """Concatenate two stamps into one comparable version key. Both must have
    a fixed width (``yyyyMMddHHmmss``), as keys are compared as text."""
    return F.concat(_col(first).cast("string"), _col(second).cast("string"))
