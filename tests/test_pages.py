"""Page extraction on built pages."""

import json

import pytest
from pyspark.sql import functions as F

from conftest import rows
from cartulary.sources import pages as pg

BOARD = """<html><head><title>Lideres</title></head><body><form><select name="anio"><option value="2010">2010
<option value="2011" selected>2011<option value="2012">2012</select></form>
<table><tr><th>#</th><th>Jugador</th><th>JJ</th><th>TOT</th><th>Prom</th></tr>
<tr><td>1</td><td>Paz, Ana (Rayos)</td><td>30</td><td>600</td><td>20.0</td></tr>
<tr><td>2</td><td>Sosa, Eva</td><td>29</td><td>-</td><td>nan</td></table>
<table><tr><th>#</th><th>Jugador</th><th>JJ</th><th>FBP</th><th>Prom</th></tr><tr><td>1</td><td>X</td><td>3</td><td>4</td><td>1</td></tr></table>
<table><thead><tr><th>A</th></tr></thead><tr><td>not a board</td></tr></table></body></html>"""
UNCLOSED = "<table><tr><td>JUGADOR<td>MIN<td>CCI-CCA<tr><td>7 Paz<td>31<td>9-4<tr><td>8 Sosa<td><td>x</table>"
SPANS = "<table><tr><td rowspan=2>g</td><td colspan=2>x&amp;y</td></tr><tr><td>1</td><td>2</td></tr></table>"


@pytest.fixture(scope="module")
def site(spark):
    return spark.createDataFrame([(1, "http://a/l.asp?serie=1", BOARD), (2, "http://a/b", UNCLOSED), (3, "http://a/c", SPANS), (4, "http://a/d", "<p>none</p>"), (5, "http://a/e", None)],
                                 "page_id long, url string, html string")


def test_tables_to_cells(site):
    t = pg.extract_tables(site, "page_id", "html")
    got = rows(t, "page_id", "table_no", "row_no", "cells")
    assert (1, 0, 0, ["1", "Paz, Ana (Rayos)", "30", "600", "20.0"]) in got
    assert [r for r in got if r[0] == 2] == [(2, 0, 0, ["JUGADOR", "MIN", "CCI-CCA"]), (2, 0, 1, ["7 Paz", "31", "9-4"]), (2, 0, 2, ["8 Sosa", "", "x"])]
    assert [r[3] for r in got if r[0] == 3] == [["g", "x&y", "x&y"], ["g", "1", "2"]]
    assert {r[0] for r in got} == {1, 2, 3}


def test_boards_by_signature_keep_unknown_ones(site):
    from cartulary.functions import numbers, text

    b = pg.leader_boards(pg.extract_tables(site, "page_id", "html"))
    assert rows(b.select("table_no", "category", "prom_kind", "known").distinct()) == [(0, "anotaciones", "per_game", True), (1, "cat_fbp", "unknown", False)]
    named = pg.labelled_cells(b, {"player": "Jugador", "total": "TOT", "gone": "RO"})
    got = named.where("table_no = 0").select("row_no", text.split_parenthesised("player")["head"].alias("p"), text.split_parenthesised("player")["tail"].alias("c"),
                                             numbers.to_int("total").alias("t"), "gone")
    assert rows(got) == [(0, "Paz, Ana", "Rayos", 600, None), (1, "Sosa, Eva", "", None, None)]


def test_box_rows_by_label(site):
    from cartulary.functions import numbers, text

    cells = pg.first_row_as_header(pg.extract_tables(site, "page_id", "html").where("page_id = 2"), "page_id")
    box = pg.labelled_cells(cells, {"player": "JUGADOR", "min": "MIN", "fg": "CCI-CCA", "ast": "AST"})
    out = box.select(text.split_jersey("player")["name"].alias("n"), numbers.to_minutes("min").alias("m"), numbers.split_pair("fg")["second"].alias("made"), "ast")
    assert rows(out) == [("Paz", 31, 4, None), ("Sosa", None, None, None)]


def test_context_prefers_the_url(site):
    out = site.where("page_id = 1").select(pg.page_parameter("url", "html", "serie", ("serie", "sel")).alias("s"), pg.page_parameter("url", "html", "anio", ("anio", "sel3")).alias("y"))
    assert rows(out) == [("1", "2011")]


def test_text_and_labels(evaluate):
    assert evaluate(pg.strip_tags, ["<p>a&nbsp;<b>b</b><script>x<1</script> &amp;c</p>"]) == ["a b &c"]
    labels = ["Ciudad Nacimiento", "Edad", "Posición"]
    full, empty = evaluate(lambda c: pg.labelled_blocks(c, labels), ["Ciudad Nacimiento: Rio  Edad 30 Posición Alero", "Ciudad Nacimiento Edad Posición"])
    assert tuple(full) == ("Rio", "30", "Alero") and tuple(empty) == (None, None, None)


def test_leader_lines(spark):
    df = spark.createDataFrame([("  1. Paz, Ana (RIO) 30 10 20 600 20.0 ",), ("12. SOSA (MAR) 9 44 4.9",), ("JUGADOR JJ PROM",)], "line string")
    assert rows(pg.leader_lines(df, "line"), "rank", "player_raw", "club_raw", "games", "figures", "prom", "parse_flag") == [
        (None, None, None, None, None, None, "unparsed"), (1, "Paz, Ana", "RIO", 30, [10, 20, 600], 20.0, ""), (12, "SOSA", "MAR", 9, [44], 4.9, "")]


def test_career_lines_keep_seasons_without_figures(spark):
    df = spark.createDataFrame([(1, "2004 RIO ALTO 1 2 30% 28 400 14.3 2005 MAR 5 6 1899 VIEJO 1 2 3 4.0")], "k int, t string")
    assert rows(pg.career_lines(df, "t", ["k"]).rows, "season", "team_raw", "games", "points") == [(2004, "RIO ALTO", 28, 400), (2005, "MAR", None, None)]
    assert rows(pg.career_lines(df, "t", ["k"]).rejected, "k", "line") == [(1, "1899 VIEJO 1 2 3 4.0")]


def test_divider_rows_label_what_follows(spark):
    df = spark.createDataFrame([(1, 0, "Group A"), (1, 1, "Rio"), (1, 2, "Group B"), (1, 3, "Rio"), (2, 0, "Mar")], "page int, row_no int, cell string")
    out = pg.divider_groups(df, ["page"], "row_no", F.col("cell").startswith("Group "), F.lower(F.substring("cell", 7, 9)))
    assert rows(out, "page", "row_no", "cell", "group_label") == [(1, 1, "Rio", "a"), (1, 3, "Rio", "b"), (2, 0, "Mar", None)]


def test_rejects(evaluate):
    pages = ["<title>x</title> ADODB.Field", "<form id=goCaptcha>", "<title>Error 500</title>", '<a href="/p/1?W=1"><a href="/p/2?W=1">', '<a href="/p/1?W=1">', "<p>ok</p>"]
    assert evaluate(lambda c: pg.reject_reason(c, r"/p/\d+\?W=1"), pages) == ["database_error", "challenge", "error_title", "wrong_subject", None, None]


def test_decoding(spark):
    content = ["Peña".encode("cp1252"), "Peña".encode(), b"charset=utf-8 Pe\xf1a", "don’t".encode("cp1252"), b"\x81\xf1"]
    df = spark.createDataFrame(list(enumerate(map(bytearray, content))), "k int, raw binary")
    assert [r[1] for r in rows(df.select("k", pg.decode_page("raw").alias("t")))] == ["Peña", "Peña", "charset=utf-8 Pe�a", "don’t", "\x81ñ"]
    mixed = [bytearray("caña ".encode("cp1252") + "Peña".encode()), bytearray("ok".encode()), bytearray("Ñ ’".encode("cp1252"))]
    df = spark.createDataFrame(list(enumerate(mixed)), "k int, raw binary")
    assert rows(pg.decode_mixed_pages(df, "k", "raw")) == [(0, "caña Peña"), (1, "ok"), (2, "Ñ ’")]


def test_pages_with_sidecars(spark, tmp_path):
    for name, meta in (("a.html", {"ts": "2001"}), ("b.html", None)):
        (tmp_path / name).write_text(f"<p>{name}</p>")
        if meta:
            (tmp_path / f"{name}.meta.json").write_text(json.dumps(meta))
    got = pg.read_pages_with_metadata(spark, f"{tmp_path}/*", f"{tmp_path}/*.meta.json")
    assert rows(got.select("page", F.get_json_object("metadata", "$.ts"))) == [("a.html", "2001")]
    kept = pg.read_pages_with_metadata(spark, f"{tmp_path}/*", f"{tmp_path}/*.meta.json", keep_missing=True)
    assert rows(kept, "page") == [("a.html",), ("b.html",)]


def test_score_falls_back_to_the_parts(spark):
    t = spark.createDataFrame([("g1", 80), ("g2", None), ("g3", None), ("g4", None)], "g string, total int")
    p = spark.createDataFrame([("g1", 1), ("g2", 40), ("g2", 41), ("g3", 5), ("g3", None)], "g string, pts int")
    assert rows(pg.coalesced_score(t, p, "g", "total", "pts"), "g", "score", "score_source") == [
        ("g1", 80, "stated"), ("g2", 81, "summed"), ("g3", None, "unknown"), ("g4", None, "unknown")]


def test_links_of_every_quoting(spark):
    df = spark.createDataFrame([(1, """<a class=x href='/one'>1</a><a href="/two">2</a><A HREF=/three>3</a>""")], "k int, html string")
    assert [r["link"] for r in pg.page_links(df, "k", "html").orderBy("position").collect()] == ["/one", "/two", "/three"]


def test_late_career_rows_stay(spark):
    df = spark.createDataFrame([(1, "2031 RIO ALTO 28 400 14.3")], "k int, t string")
    assert [r["season"] for r in pg.career_lines(df, "t", ["k"]).rows.collect()] == [2031]
