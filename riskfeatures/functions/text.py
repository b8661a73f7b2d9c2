"""Text normalisation as native column expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

# Every character that counts as white space, not only the blank which SQL trim removes.
WHITE_SPACE = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Trim blanks, tabs, line ends and the other white-space characters on both sides.

    Trimming a set of characters looks at every character of a text, trimming blanks at its ends
    alone. That is enough where what remains begins and ends with a visible ASCII character.
    """
    blanks_off = F.trim(col(c))
    last = F.right(blanks_off, F.lit(1))
    plain = blanks_off.between("!", "~") & last.between("!", "~")
    return F.when(plain, blanks_off).otherwise(F.btrim(col(c), F.lit(WHITE_SPACE)))


def strip_lower(c: Column | str) -> Column:
    return F.lower(strip(c))


def strip_upper(c: Column | str) -> Column:
    return F.upper(strip(c))


def contains(c: Column | str, part: str) -> Column:
    """Substring test that is false, not null, for a null text."""
    return F.coalesce(col(c).contains(part), F.lit(False))


def is_one_of_years(c: Column | str, years: Iterable[str]) -> Column:
    """Financial-year test that tolerates blanks after the label and still reaches the scan.

    The range test on the raw column can be pushed into a Parquet scan, into partition
    pruning and into JDBC; the exact test on the stripped label decides. A label with no more
    than blanks around it needs no other.
    """
    raw, years = col(c), sorted(years)
    if not years:
        return F.lit(False)
    last = years[-1]
    beyond = last[:-1] + chr(ord(last[-1]) + 1)
    return (raw >= years[0]) & (raw < beyond) & (F.trim(raw).isin(years) | strip(raw).isin(years))
