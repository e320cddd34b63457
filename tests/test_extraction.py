"""Header trees, spans, page families and the cascade on hand-written pages."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from cartulary.operators import plays as pl
from cartulary.sources import pages as pg
from cartulary.sources import rosters, sheets


def grid(spark, *pages, **context):
    df = spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "page int, html string")
    return pg.extract_grids(df, "page", "html").withColumns({c: F.lit(v) for c, v in context.items()})


STACKED = """<table class="box"><tr><th colspan=4>RIO</th></tr><tr><th rowspan=2>Name</th><th colspan=2>2P</th><th rowspan=2>PTS</th></tr><tr><th>M</th><th>A</th></tr>
<tr><td>Paz<td>1<td>2<td>2</table>"""


def test_header_trees(spark):
    g = grid(spark, STACKED, "<table><tr><td>#<td>Name<tr><td>7<td>Paz</table>", "<table><tr><td>only</table>", "<table><tr><td>a<td>b<tr><td>c<td>d</table>")
    g = g.withColumns({"paths": pg.column_paths(), "cap": pg.caption()})
    got = [(r.page, r.cap, [" / ".join(p) for p in r.paths], r["cells"]) for r in g.orderBy("page").collect()]
    assert got == [(0, "RIO", ["Name", "2P / M", "2P / A", "PTS"], ["Paz", "1", "2", "2"]), (1, "", ["#", "Name"], ["7", "Paz"]),
                   (2, "", [], ["only"]), (3, "", ["a", "b"], ["c", "d"])]
    named = pg.named_cells(g.where("page = 0"), {"m": ("M", 1), "a": ("2P / A", 1), "two": ("M", 2), "none": ("X", 1)})
    assert rows(named, "m", "a", "two", "none") == [("1", "2", None, None)]


@pytest.mark.parametrize("html, width", [("<table><tr><td colspan=1000000000>x<tr><td>1</table>", 1000),
                                         ("<table><tr>" + "<td colspan=1000 rowspan=60000>1" * 3 + "<tr><td>x" * 3000 + "</table>", 3)])
def test_spans_are_bounded_and_told(spark, html, width):
    g = grid(spark, html).agg(F.max(F.size("cells")).alias("w"), F.max(F.transform("head", F.size)).alias("h"), F.bool_and("clipped").alias("c")).first()
    assert max(g.w, max(g.h or [0])) == width and g.c


def test_tables_know_their_sections_links_and_pictures(spark):
    g = grid(spark, '<div id="a"><div id="b"><table class="k"><tr><td><a href="/x"><img alt="Ana"></a>t</table></div></div><table><tr><td>u</table>')
    assert rows(g, "table_no", "section", "kind", F.get("links", F.lit(0)), F.get("alts", F.lit(0))) == [(0, "a/b", "k", "/x", "Ana"), (1, "", "", None, None)]


def plays(spark, *lines, head="<tr><td>Cuarto<td>Tiempo<td>Jugada<td>Local RIO<td>Visitante MAR"):
    body = "".join("<tr><td>" + "<td>".join(x) for x in lines)
    return sheets.play_rows(grid(spark, f"<table>{head}{body}</table>"), "page")


LINES = [("1", "10:00", "Salto Inicial", "0", "0"), ("1", "9:30", "Tiro corto hecho por ANA PAZ (7) de RIO", "2", "0"), ("", "9:00", "Primer | cuarto", "", ""),
         ("1", "8:59", "3-pt de lejos hecho por EVA SOL de MAR", "", ""), ("1", "8:00", "Sale ANA PAZ Entra LUZ MAR de RIO", "2", "3"),
         ("OT1", "5:00", "Sale LUZ MAR Entra ANA PAZ de RIO", "3", "3"), ("OT1", "6:00", "Falta personal por EVA SOL de MAR", "", "")]


def test_play_by_play(spark):
    p = pl.with_clock(plays(spark, *LINES))
    assert rows(p, "seq", "period", "elapsed", "event_type", "actor_raw") == [
        (1, 1, 0, "jump_ball", ""), (2, 1, 30, "made_2", "ANA PAZ"), (4, 1, 61, "made_3", "EVA SOL"), (5, 1, 120, "substitution", ""),
        (6, 5, 2400, "substitution", ""), (7, 5, None, "foul", "EVA SOL")]
    scored = pl.with_running_score(p, ["page"])
    assert rows(scored, "seq", "local_run", "visit_run", "local_carried", "visit_carried", "score_check") == [
        (1, 0, 0, 0, 0, "ok"), (2, 2, 0, 2, 0, "ok"), (4, 2, 3, 2, 0, "mismatch"), (5, 2, 3, 2, 3, "ok"), (6, 2, 3, 3, 3, "mismatch"), (7, 2, 3, 3, 3, "mismatch")]
    assert rows(pl.court_intervals(p, ["page"]), "player", "from_seq", "to_seq", "to_s", "open", "odd") == [
        ("ANA PAZ", 0, 5, 120, False, 0), ("ANA PAZ", 6, 7, 2400, True, 0), ("LUZ MAR", 5, 6, 2400, False, 0)]


def test_short_or_other_tables_are_no_plays(spark):
    assert plays(spark, *LINES[:3]).count() == 0 and plays(spark, *LINES, head="<tr><td>Quarter<td>a<td>b<td>c<td>d").count() == 0


def test_running_score_spreads_a_long_game(spark, monkeypatch):
    monkeypatch.setattr(pl, "SEQ_RANGE", 7)
    rng = [(0, i, "made_2" if i % 3 else "foul", "RIO" if i % 2 else "MAR", "RIO", "MAR", i if i % 5 == 0 else None, i if i % 5 == 0 else None) for i in range(100)]
    df = spark.createDataFrame(rng, "page int, seq int, event_type string, team_raw string, local_team string, visit_team string, local_score int, visit_score int")
    got = rows(pl.with_running_score(df, ["page"]), "seq", "local_run", "local_carried")
    assert got == [(i, sum(2 for j in range(i + 1) if j % 3 and j % 2), i - i % 5) for i in range(100)]


def person(i, family, given, born, number):
    return f'<tr><td><a href="jugador.asp?id={i}">{family}</a><td>{given}<td>{born}<td>{number}'


HEAD = "<table><tr><th>Apellidos</th><th>Nombre</th><th>Nació</th><th>Camisa</th></tr>"


def test_directory(spark):
    html = [HEAD + person(1, "Paz", 'Ana "Nena"', "1/1/1900", "7.0") + person(2, "Sol", "Eva", "", "nan") + "</table>",
            HEAD + person(1, "Paz Rey", "", "2/3/1980", "9") + "</table>", HEAD + person(3, "x", "y", "", "") + '</table><a href="jugador.asp?id=9">z</a>', "<p>none</p><table><tr><td>q</table>"]
    pages = spark.createDataFrame([(i, h, f"200{i}") for i, h in enumerate(html)], "page int, html string, at string")
    found = sheets.directory(pg.extract_grids(pages, "page", "html").join(pages.select("page", "at"), "page"), pg.page_links(pages, "page", "html"), "page", "at")
    assert rows(found.people, "person_id", "family", "given", "nickname", "birth_date", "source_page", "n_captures", "first_seen", "last_seen") == [
        ("1", "Paz Rey", "Ana", "Nena", "2/3/1980", 1, 2, "2000", "2001"), ("2", "Sol", "Eva", None, None, 0, 1, "2000", "2000")]
    assert rows(found.jerseys) == [("1", "7"), ("1", "9")]
    assert rows(found.pages) == [(0, "ok"), (1, "ok"), (2, "rows and links differ"), (3, "no table")]


FLAT = "<table><tr><td><b>#</b><td><b>Name:</b><td>Pos<td>CM<td>{0}<td>NAT{1}</table>"
STRIP = '<a href="http://x/player/a/b/c/5"><img alt="Ana Paz"></a><a href="http://x/player/a/b/c/5"><img alt="Ana P."></a><a href="/team/x"><img alt="Crest"></a>'


def test_rosters(spark):
    html = [FLAT.format("Bo", '<tr><td>7<td><a href="http://x/player/a/b/c/12">Paz Ana</a><td>G<td>190cm<td>0<td>PUR<tr><td colspan=2>Coach<td>x'),
            FLAT.format("Age", "<tr><td><td>Ana Paz<td><td><td>25<td>"), FLAT.format("Age", "<tr><td>1<td><td>G<td>190<td>20<td>x") + STRIP,
            '<div id="tab_s5"><table class="playerPosition"><tr><td><img alt="Ana Paz"><td>#7</tr><tr><td>(190-G-25)</table><table><tr><td>Eva Sol(180-20)<tr><td>ana paz(190-25)</table></div>',
            STRIP.replace("c/5", "c/5?Women=1"), "<p>x</p>", STRIP]
    pages = spark.createDataFrame([(i, h, 2010) for i, h in enumerate(html)], "page int, html string, season int")
    found = rosters.read_rosters(pages, "page", "html", "season")
    assert rows(found.rows, "page", "template", "name_raw", "name_order", "height_cm", "birth_year_2digit", "approx_birth_year", "profile_id", "completeness") == [
        (0, "flat", "Paz Ana", "surname_first", "190", None, None, "12", "full"), (1, "flat", "Ana Paz", "given_first", None, None, 1985, None, "full"),
        (2, "photo_strip", "Ana Paz", "given_first", None, None, None, "5", "partial"), (3, "widget", "Ana Paz", "given_first", "190", None, 1985, None, "full"),
        (3, "widget", "Eva Sol", "given_first", "180", None, 1990, None, "partial"), (6, "photo_strip", "Ana Paz", "given_first", None, None, None, "5", "partial")]
    assert rows(found.pages) == [(0, "ok", "flat", 1, 1), (1, "ok", "flat", 1, 1), (2, "ok", "photo_strip", 1, 2), (3, "ok", "widget", 2, 1),
                                 (4, "wrong_subject", None, 0, 0), (5, "unknown layout", None, 0, 0), (6, "ok", "photo_strip", 1, 1)]


def test_a_page_that_no_level_completes_is_reported(spark):
    pages = spark.createDataFrame([(1, FLAT.format("Age", "<tr><td>1<td><td>G<td>190<td>20<td>x"), 2010)], "page int, html string, season int")
    found = rosters.read_rosters(pages, "page", "html", "season")
    assert rows(found.pages) == [(1, "no complete rows", None, 0, 1)] and found.rows.count() == 0


MARKS = ["<table>", '<table class="k x">', "</table>", "<tr>", "</tr>", "<td>", "<TD>", "<th>", "</td>", "</th>", "<td colspan=2>", "<td rowspan='3'>", '<th colspan="2" rowspan=2>', "<thead>", "</thead>", "<br>",
         '<a href="/x&amp;y">', "</a>", "<img alt='Ana' src=q>", "<div id=a>", "</div>", "text", " a &amp; b ", "&lt;x", "&nbsp", " \n ", "x  y", "<b >", "<option selected>", '<a href="">', "é", "&am", "<tablex>", "\xa0",
         "<table><tr><td>a  b<td>&lt;q</tr>c<td>1</td>d</table>"]
ODD = ["<br/>", "<!-- c -->", "<!--<table><tr><td>c</table>-->", "<script>x<td></script>", "<td colspan = 2>", "<", "< b", "</ td>", "<a href=/x/y>", "<td a='1'b='2'>", "<?php ?>", "<!doctype html>", "</td x>", '<td a="x>y">', '<a title="<table><tr><td>z</table>">', "<td", "</"]


def test_plain_pages_read_like_any_other(monkeypatch):
    rng = random.Random(1)

    def slow(html):
        reader = pg._TableReader()
        reader.feed(html)
        reader.close()
        return reader

    def tables(html):
        return [{**t, **{k: t[k] or [[None] * len(r) for r in t["rows"]] for k in ("links", "alts")}} for t in pg._page_tables(html)]

    for i in range(6000):
        marks = rng.choices(MARKS, k=rng.randrange(1, 30)) + rng.choices(ODD, k=i % 3 == 0)
        rng.shuffle(marks)
        html = "<table>" * (i % 2) + "".join(marks)
        got = tables(html)
        with monkeypatch.context() as m:
            m.setattr(pg, "_read", slow)
            assert got == tables(html), html


def test_plain_pages_do_without_the_slow_parser(monkeypatch):
    monkeypatch.setattr(pg._TableReader, "feed", None)
    found = list(pg._page_tables("<p>x<table><tr><td>a<td>b<tr><td>c</table><table class=k><tr><th>d</th></tr><tr><td>e</table>"))
    assert [t["head"] + t["rows"] for t in found] == [[["a", "b"], ["c"]], [["d"], ["e"]]]


def test_plays_from_parts_of_tables(spark, monkeypatch):
    """Tables of several parts, a page with two play tables, one whose table is too short."""
    monkeypatch.setattr(pg, "PART_CELLS", 12)
    body = ["".join("<tr><td>" + "<td>".join(x) for x in LINES[n:] * m) for n, m in ((0, 3), (2, 1), (4, 1))]
    pages = [f"<table><tr><td>Cuarto<td>Tiempo<td>Jugada<td>Local RIO<td>Visitante MAR{b}</table>" for b in (body[0], body[1], body[2])]
    df = spark.createDataFrame([(0, pages[0]), (1, pages[1] + pages[0]), (2, pages[2])], "page int, html string")
    grids = [pg.extract_grids(df, "page", "html", parts=p) for p in (False, True)]
    assert grids[1].count() > 8 and grids[1].selectExpr("sum(size(cells))").first()[0] == grids[0].count()
    got = [rows(sheets.play_rows(g, "page")) for g in grids]
    assert got[0] == got[1] and len(got[0]) > 20
