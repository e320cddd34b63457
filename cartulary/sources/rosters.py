"""Roster pages of several layouts, read by a cascade of extractors.

A page goes to the richest extractor whose marks it bears. It leaves with that extractor's rows when they pass its test,
and otherwise goes on to the next, thinner one. What no extractor could read is reported, never dropped in silence.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import numbers, text
from ..operators.skew import top_k
from ..session import written
from .pages import column_paths, extract_grids, first_table, named_cells


class Level(NamedTuple):
    template: str
    bears: Column  # mark of the layout, on the page
    extract: Callable[[DataFrame], DataFrame]  # pages to rows; rows have the page's key and a column `completeness`
    enough: Column  # aggregate over a page's rows: whether they will do


class Cascade(NamedTuple):
    rows: DataFrame  # with `template` and `completeness`
    pages: DataFrame  # page, status (ok or the reason it was not read), template, n_rows, n_tried


def cascade(pages: DataFrame, key: str, levels: Sequence[Level], rejected: Column | None = None) -> Cascade:
    """One pass a level over the pages that bear its mark and are still unread.

    A level's rows are written once, so its test, its rows and the pages left over are read from the same table and no
    page is parsed twice by one extractor; only keys, never pages, say what is left. `rejected` names pages that are not read at all.
    """
    reason = F.lit(None).cast("string") if rejected is None else rejected
    marks = [f"__bears_{i}" for i in range(len(levels))]
    told = pages.withColumn("__why", reason).withColumns(dict(zip(marks, [F.coalesce(v.bears, F.lit(False)) for v in levels], strict=True)))
    done, rows, spent = None, [], []
    for mark, level in zip(marks, levels, strict=True):
        left = told.where(F.col("__why").isNull() & F.col(mark))
        left = left if done is None else left.join(done, key, "left_anti")
        found = written(level.extract(left.select(*pages.columns)).withColumn("template", F.lit(level.template)))
        counted = found.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"), F.coalesce(level.enough, F.lit(False)).alias("__ok"))
        passed = counted.where("__ok").select(key, "n_rows", F.lit(level.template).alias("template"))
        rows.append(found.join(passed.select(key), key, "left_semi"))
        spent.append(passed)
        done = passed.select(key) if done is None else done.unionAll(passed.select(key))
    read = spent[0]
    out = rows[0]
    for r, s in zip(rows[1:], spent[1:], strict=True):
        out, read = out.unionByName(r, allowMissingColumns=True), read.unionByName(s)
    order = F.create_map(*[x for i, v in enumerate(levels) for x in (F.lit(v.template), F.lit(i))])
    tried = sum(((F.col("template").isNull() | (F.lit(i) <= order[F.col("template")])) & F.col(m)).cast("int") for i, m in enumerate(marks))
    status = (told.select(key, "__why", *marks).join(read, key, "left")
              .withColumn("n_tried", F.when(F.col("__why").isNull(), tried).otherwise(0))
              .select(key, F.coalesce("__why", F.when(F.col("template").isNotNull(), "ok").when(F.col("n_tried") > 0, "no complete rows").otherwise("unknown layout")).alias("status"),
                      "template", F.coalesce("n_rows", F.lit(0).cast("long")).alias("n_rows"), "n_tried"))
    return Cascade(out, status)


# --- the extractors ------------------------------------------------------------

PROFILE = r"/player/[^/]+/[^/]+/[^/]+/(\d+)"  # fixed value: a profile link and its id
OTHER_ID = r"PlayerID=(\d+)"  # fixed value: the id of the sister site
WIDGET = r"\((\d{2,3})-([A-Za-z/]+)-(\d{1,2})\)"  # fixed value: (height-position-age)
BENCH = r"^([A-Za-zÀ-ÿ'.\-\s]+)\((\d{2,3})-(\d{1,2})\)$"  # fixed value: name (height-age)
SECTION_NAMES = {"tab_s5": "starting_five", "tab_rs": "reserve"}  # fixed values
#: Rows of every extractor have these; what a layout does not show is NULL.
COLUMNS = ("section", "jersey", "name_raw", "name_order", "height_cm", "position_raw", "birth_year_2digit", "age", "approx_birth_year", "nationality_raw",
           "years_from", "years_to", "former_team_raw", "other_id", "profile_id", "profile_url", "completeness")


def _part(c: str | Column, pattern: str, group: int) -> Column:
    v = F.regexp_extract(F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("")), pattern, group)
    return F.when(v != "", v)


def _filled(c: str | Column) -> Column:
    v = text.squish(c)
    return F.when(v != "", v)


def _roster(rows: DataFrame, key: str, **columns: Column) -> DataFrame:
    return rows.select(key, *[columns.get(c, F.lit(None).cast("int" if c == "approx_birth_year" else "string")).alias(c) for c in COLUMNS])


def flat_table(pages: DataFrame, key: str, html: str, season: str) -> DataFrame:
    """The table whose header starts with # and Name. The era with a birth-year column puts the surname first, the era
    with an age column the given name; a figure of 0 is unknown; rows of another width than the header are no players."""
    grid = extract_grids(pages, key, html).withColumn("head", F.transform("head", lambda r: F.transform(r, lambda x: F.regexp_replace(x, r"\s*:\s*$", ""))))
    grid = grid.withColumn("paths", column_paths())
    leaf = F.transform("paths", lambda p: F.coalesce(F.try_element_at(p, F.lit(-1)), F.lit("")))
    own = (F.size("paths") >= 4) & (F.get(leaf, 0) == "#") & (F.get(leaf, 1) == "Name")
    rows = first_table(grid.where(own), key).where(F.size("cells") == F.size("paths")).join(pages.select(key, season), key)
    surname_first = F.array_contains(leaf, "Bo")
    labels = {"jersey": "#", "name": "Name", "height": "CM", "pos": "Pos", "bo": "Bo", "years": "Age", "nat": "NAT", "since": "FR", "until": "TO", "before": "Former Team"}
    rows = named_cells(rows.withColumn("__order", F.when(surname_first, "surname_first").otherwise("given_first")), {n: (label, 1) for n, label in labels.items()})
    rows = rows.where(text.squish("name") != "")

    def known(c):
        v = _filled(c)
        return F.when(v != "0", v)

    link = F.get("links", F.lit(1))
    return _roster(rows, key, section=F.lit("roster"), jersey=_filled("jersey"), name_raw=text.squish("name"), name_order=F.col("__order"),
                   height_cm=_part("height", r"^(\d{2,3})", 1), position_raw=_filled("pos"), birth_year_2digit=known("bo"), age=known("years"),
                   approx_birth_year=numbers.approx_birth_year(known("years").try_cast("int"), F.col(season)), nationality_raw=_filled("nat"), years_from=_filled("since"),
                   years_to=_filled("until"), former_team_raw=_filled("before"), other_id=_part(link, OTHER_ID, 1), profile_id=_part(link, PROFILE, 1),
                   profile_url=link, completeness=F.lit("full"))


def court_widget(pages: DataFrame, key: str, html: str, season: str) -> DataFrame:
    """Starters and reserves of the half-court drawing: one small table a player, and bench names in its pop-up.

    A bench player stands behind every starter he backs up: one row a player, the fullest one (own table before bench
    mention, then one with a number, then page order).
    """
    grid = extract_grids(pages, key, html)
    section = F.lit(None).cast("string")
    for mark, name in SECTION_NAMES.items():
        section = F.when(F.col("section").contains(mark), name).otherwise(section)
    flat = grid.withColumn("__section", section).where("__section IS NOT NULL")
    whole = F.when(F.col("row_no") == 0, F.concat_ws(" ", F.flatten("head"), "cells")).otherwise(F.concat_ws(" ", "cells"))
    own = flat.where(F.col("kind").contains("playerPosition"))
    cards = own.groupBy(key, "table_no", "__section").agg(
        F.min_by(F.try_element_at(F.filter("alts", lambda a: a.isNotNull()), F.lit(1)), "row_no").alias("alt"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("row_no", whole.alias("t")))), lambda x: x["t"]), " ").alias("card"))  # rows of one card
    cards = cards.where("alt IS NOT NULL").join(pages.select(key, season), key)
    age = _part("card", WIDGET, 3)
    full = _roster(cards.withColumn("__at", F.col("table_no")), key, section=F.col("__section"), jersey=_part("card", r"#(\d+)", 1), name_raw=text.squish("alt"), name_order=F.lit("given_first"),
                   height_cm=_part("card", WIDGET, 1), position_raw=_part("card", WIDGET, 2), age=age,
                   approx_birth_year=numbers.approx_birth_year(age.try_cast("int"), F.col(season)), completeness=F.lit("full"))
    every = F.when(F.col("row_no") == 0, F.concat(F.flatten("head"), "cells")).otherwise(F.col("cells"))
    bench = (flat.where(~F.col("kind").contains("playerPosition")).select(key, "__section", F.explode(every).alias("cell"))
             .where(F.col("cell").rlike(BENCH)).join(pages.select(key, season), key))
    partial = _roster(bench, key, section=F.col("__section"), name_raw=text.squish(F.regexp_extract("cell", BENCH, 1)), name_order=F.lit("given_first"),
                      height_cm=_part("cell", BENCH, 2), age=_part("cell", BENCH, 3),
                      approx_birth_year=numbers.approx_birth_year(_part("cell", BENCH, 3).try_cast("int"), F.col(season)), completeness=F.lit("partial"))
    rows = full.unionByName(partial).withColumn("__who", text.place_lower("name_raw"))
    best = [F.desc(F.col("completeness") == "full"), F.desc(F.col("jersey").isNotNull()), F.desc("section"), F.col("jersey"), F.xxhash64(*COLUMNS)]
    return top_k(rows, [key, "__who"], best).drop("__who")


def photo_strip(pages: DataFrame, key: str, html: str) -> DataFrame:
    """Profile links around a portrait: a name, and an id where the link has one. No Python: links are a pattern's."""
    anchors = F.regexp_extract_all(html, F.lit(r"""(?is)(<a\s[^>]*\bhref\s*=\s*["']?[^"'\s>]*/player/.*?</a>)"""), F.lit(1))
    a = pages.select(key, F.posexplode(anchors).alias("position", "a"))
    link = F.regexp_extract("a", r"""(?is)^<a\s[^>]*\bhref\s*=\s*["']?([^"'\s>]*)""", 1)
    rows = a.select(key, "position", link.alias("link"), _part("a", r"""(?is)<img\s[^>]*\balt\s*=\s*"([^"]*)""", 1).alias("alt")).where("alt IS NOT NULL")
    rows = rows.withColumn("__id", _part("link", PROFILE, 1))
    once = top_k(rows.withColumn("__who", F.coalesce("__id", "alt")), [key, "__who"], [F.col("position")])
    return _roster(once, key, section=F.lit("teaser"), name_raw=text.squish("alt"), name_order=F.lit("given_first"), profile_id=F.col("__id"),
                   profile_url=F.col("link"), completeness=F.lit("partial"))


def wrong_subject(html: str, least: int = 2) -> Column:
    """Pages of the women's team under the same address: told by their profile links, where one alone is noise."""
    return F.when(F.regexp_count(html, F.lit(r"""/player/[^"']*Women=1""")) >= least, "wrong_subject")


def read_rosters(pages: DataFrame, key: str, html: str, season: str, least: int = 1) -> Cascade:
    """Every layout in turn: full tables, the court widget, the photo strip. A level needs `least` named players."""
    enough = F.count("name_raw") >= least
    h = F.col(html)
    return cascade(pages, key, [
        Level("flat", h.rlike(r"(?is)<table.*?<t[dh][^>]*>\s*(<b[^>]*>)?\s*#\s*:?\s*(</b>)?\s*(</t[dh]>)?\s*<t[dh][^>]*>\s*(<b[^>]*>)?\s*Name"), lambda p: flat_table(p, key, html, season), enough),
        Level("widget", h.contains("playerPosition"), lambda p: court_widget(p, key, html, season), enough),
        Level("photo_strip", h.contains("/player/"), lambda p: photo_strip(p, key, html), enough),
    ], wrong_subject(html))
