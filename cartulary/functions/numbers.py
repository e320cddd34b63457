"""Numbers out of text. Anything that is not a number becomes NULL, never 0."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import Str, _col, squish

# fixed values: cell texts that mean "no value"
NO_VALUE = ("", "nan", "-", "none")


def _number_text(c: Str) -> Column:
    s = squish(_col(c).cast("string"))
    return F.when(~F.lower(s).isin(*NO_VALUE), s)


def to_int(c: Str) -> Column:
    """Accepts "2.0"; truncates like a cast."""
    d = _number_text(c).try_cast("double")
    return F.when(~F.isnan(d) & (F.abs(d) < 2147483648.0), d).cast("int")


def to_int_strict(c: Str) -> Column:
    s = F.trim(_col(c).cast("string"))
    return F.when(s.rlike("^[+-]?[0-9]+$"), s.try_cast("int"))


def to_float(c: Str) -> Column:
    d = _number_text(c).try_cast("double")
    return F.when(~F.isnan(d), d)


def to_float_rounded(c: Str, digits: int) -> Column:
    """Half-even, the rounding the published records use."""
    return F.bround(to_float(c), digits)


def to_minutes(c: Str) -> Column:
    s = _number_text(c)
    clock = F.regexp_extract(s, r"^(\d+):(\d{2})$", 1)
    return F.when(clock != "", clock.try_cast("int")).otherwise(to_int(s))


def split_pair(c: Str, sep: str = "-", names: tuple[str, str] = ("first", "second")) -> Column:
    """ "19-7" -> struct; which number means what is the source's business."""
    pat = r"^\s*(\d+)\s*\Q" + sep + r"\E\s*(\d+)"
    s = _col(c)

    def part(i):
        x = F.regexp_extract(s, pat, i)
        return F.when(x != "", x.try_cast("int"))

    return F.struct(part(1).alias(names[0]), part(2).alias(names[1]))


def quarter_scores(c: Str, sep: str = "[-|]") -> Column:
    """Quarter list with the trailing zeros of unplayed periods cut."""
    q = F.transform(F.split(_col(c), sep), lambda x: F.trim(x).try_cast("int"))
    last = F.array_max(F.transform(q, lambda x, i: F.when(x != 0, i + 1).otherwise(0)))
    return F.when(last > 0, F.slice(q, F.lit(1), F.greatest(last, F.lit(0)))).otherwise(F.array().cast("array<int>"))


def per_game(total: Str, games: Str, digits: int = 1) -> Column:
    t, g = _col(total), _col(games)
    return F.when(g > 0, F.round(t / g, digits))


def shooting_pct(made: Str, attempted: Str, digits: int = 1) -> Column:
    m, a = _col(made), _col(attempted)
    return F.when(a > 0, F.round(m * 100 / a, digits))


def decade(year: Str) -> Column:
    return (F.floor(_col(year) / 10) * 10).cast("int")


def points_check(fg2: Str, fg3: Str, ft: Str, pts: Str) -> Column:
    """ok / pts_mismatch, and an empty text when a cell is missing."""
    a, b, c, p = map(_col, (fg2, fg3, ft, pts))
    known = a.isNotNull() & b.isNotNull() & c.isNotNull() & p.isNotNull()
    return F.when(~known, "").when(a * 2 + b * 3 + c == p, "ok").otherwise("pts_mismatch")


def sum_check(expected: Str, actual: Str) -> Column:
    e, a = _col(expected), _col(actual)
    return F.when(e.isNull() | a.isNull(), "").when(e == a, "ok").otherwise("mismatch")


def full_birth_year(two_digit: Str, season: Str, youngest: int = 14, oldest: int = 55) -> Column:
    """Century by plausible age in that season; NULL when neither century is plausible."""
    y, s = _col(two_digit).cast("int"), _col(season).cast("int")
    late, early = y + 2000, y + 1900
    return (F.when((s - late).between(youngest, oldest), late)
            .when((s - early).between(youngest, oldest), early))


def approx_birth_year(age: Str, season: Str) -> Column:
    return _col(season).cast("int") - _col(age).cast("int")


def metric_era(year: Str) -> Column:
    """Total points through 1970, points per game after; the two never mix."""
    return F.when(_col(year) <= 1970, "total_points").otherwise("ppg")
