"""Parts of archived URLs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import Str, _col


def unquote(c: Str) -> Column:
    """Percent-decoding that leaves "+" alone; a broken escape leaves the text as it is."""
    s = _col(c)
    return F.coalesce(F.try_url_decode(F.replace(s, F.lit("+"), F.lit("%2B"))), s)


def host(c: Str) -> Column:
    return F.lower(F.regexp_extract(_col(c), r"^[a-zA-Z]+://([^/?#:]+)", 1))


def path(c: Str) -> Column:
    return F.regexp_extract(_col(c), r"^[a-zA-Z]+://[^/?#]+([^?#]*)", 1)


def query_string(c: Str) -> Column:
    return F.regexp_extract(_col(c), r"\?([^#]*)", 1)


def script_name(c: Str) -> Column:
    return F.lower(F.regexp_extract(path(c), r"([^/]*)$", 1))


def parameter(c: Str, name: str) -> Column:
    v = F.regexp_extract(query_string(c), rf"(?:^|&){name}=([^&]*)", 1)
    return F.when(v != "", v)


def is_parametrised(c: Str) -> Column:
    return query_string(c) != ""


def season_of(c: Str, capture: Str, param: str = "anio") -> Column:
    """Year parameter, else a year inside the path, else the year it was captured."""
    p = parameter(unquote(c), param)
    in_path = F.regexp_extract(path(c), r"(?:^|[^0-9])((?:19|20)\d{2})(?:[^0-9]|$)", 1)
    return F.coalesce(p.try_cast("int"), F.when(in_path != "", in_path.cast("int")),
                      F.substring(_col(capture), 1, 4).try_cast("int"))


def normal_slug(c: Str) -> Column:
    return F.replace(F.lower(F.trim(unquote(c))), F.lit("_"), F.lit("-"))
