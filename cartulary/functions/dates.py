"""Dates, capture times and season keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import Str, _col, squish

# fixed values: the archive writes an unknown birth date as this day
UNKNOWN_BIRTH = ("1/1/1900", "01/01/1900")


def clean_date_text(c: Str, sentinels: Sequence[str] = UNKNOWN_BIRTH) -> Column:
    d = F.regexp_extract(F.coalesce(_col(c), F.lit("")), r"\b(\d{1,2}/\d{1,2}/\d{4})\b", 1)
    return F.when((d != "") & ~d.isin(*sentinels), d)


def to_date_mdy(c: Str, sentinels: Sequence[str] = UNKNOWN_BIRTH) -> Column:
    """Calendar-invalid days are NULL, not the next month."""
    return F.try_to_date(clean_date_text(c, sentinels), "M/d/yyyy")


def game_date(c: Str, pivot: int = 50) -> Column:
    """ "M/D/YY" or "M/D/YYYY" to a date; two-digit years pivot on `pivot`."""
    s = squish(c)
    y2 = F.regexp_extract(s, r"^(\d{1,2})/(\d{1,2})/(\d{2})$", 3)
    century = F.when(y2.try_cast("int") < pivot, "20").otherwise("19")
    full = F.when(y2 != "", F.concat(F.regexp_extract(s, r"^(\d{1,2}/\d{1,2}/)", 1), century, y2)).otherwise(s)
    return F.try_to_date(full, "M/d/yyyy")


def capture_date(c: Str) -> Column:
    return F.try_to_date(F.substring(_col(c), 1, 8), "yyyyMMdd")


def capture_timestamp(c: Str) -> Column:
    return F.try_to_timestamp(_col(c), F.lit("yyyyMMddHHmmss"))


def capture_key(ts: Str) -> Column:
    return F.date_format(_col(ts), "yyyyMMddHHmmss")


def capture_key_in_url(url: Str) -> Column:
    k = F.regexp_extract(F.coalesce(_col(url), F.lit("")), r"/web/(\d{14})", 1)
    return F.when(k != "", k)


def season_key(c: Str) -> Column:
    """A year or a split year, kept as the source spells it."""
    s = squish(c)
    hit = F.regexp_extract(s, r"^(\d{4}(?:\s*[-/]\s*\d{2,4})?)", 1)
    return F.when(hit != "", F.replace(hit, F.lit(" "), F.lit(""))).otherwise(s)


def season_start(c: Str) -> Column:
    return F.regexp_extract(_col(c), r"^(\d{4})", 1).try_cast("int")


def champion_cell(c: Str) -> Column:
    """A leading "*" marks a season without a champion; its text is the reason."""
    s = squish(c)
    starred = s.startswith("*")
    note = F.trim(F.regexp_replace(s, r"^[* ]+", ""))
    return F.struct(
        F.when(~starred, s).alias("city"),
        F.when(~starred, "").when(note == "", "no champion of record").otherwise(note).alias("note"),
        starred.alias("no_champion"),
    )


def season_from_game_id(c: Str, lo: int = 1990, hi: int = 2035, base: int = 1980) -> Column:
    """Two id schemes: letters + four-digit year, else letters + two-digit code over `base`."""
    u = F.upper(_col(c))
    four = F.regexp_extract(u, r"^BS(\d{4})", 1).try_cast("int")
    two = F.regexp_extract(u, r"^BS(\d{2})", 1).try_cast("int")
    return F.when(four.between(lo, hi), four).otherwise(base + two)


def relabelled_season(label: Str, capture: Str, slot: int, cutoff: str) -> Column:
    """The newest-season slot captured on or after `cutoff` holds the next season."""
    lab, cap = _col(label), F.coalesce(_col(capture), F.lit(""))
    return F.when((lab == slot) & (cap != "") & (cap >= cutoff), lab + 1).otherwise(lab)


def season_complete(season: Str, capture: Str) -> Column:
    """Settled when captured on or after 1 October of the season's own year."""
    y = _col(season).try_cast("int")
    return F.coalesce(_col(capture) >= F.concat(y.cast("string"), F.lit("1001000000")), F.lit(False))


def whole_years(born: Str, on: Str) -> Column:
    return F.floor(F.months_between(_col(on).cast("date"), _col(born).cast("date")) / 12).cast("int")
