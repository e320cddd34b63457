"""Known page families end to end: page text to typed rows."""

from conftest import rows
from cartulary.sources import pages as pg
from cartulary.sources import sheets

LEDGER = """<table><tr><th>AÑO</th><th>EQUIPO</th><th>DIRIGENTE</th><th>SUBCAMPEÓN</th></tr>
<tr><td>1950</td><td>RIO</td><td>Paz, Ana</td><td>MAR</td></tr><tr><td>1953</td><td>* NO SE TERMINO</td><td></td><td></td></tr>
<tr><td>1942 - 1943</td><td>SOL</td><td>Ana Paz Eva Sosa</td><td>RIO</td></tr></table>"""


def box(team, *players):
    head = "<tr><td>JUGADOR<td>MIN<td>CC3I-CC3A<td>CCI-CCA<td>TLI-TLA<td>REB off/def<td>AST<td>STEALS<td>BK<td>FP<td>TO<td>TP"
    return f"<table><tr><td>{team}{head}" + "".join("<tr><td>" + "<td>".join(p) for p in players) + "</table>"


LINE = "<table><tr><td>4/5/01<td>1st<td>2nd<td>TOTAL<tr><td>RIO<td>20<td>18<td>38<tr><td>MAR<td>10<td>9<td>19</table>"
FULL = (LINE + box("RIO", ["7 Paz", "31", "3-2", "9-4", "5-3", "2/5", "1", "0", "-", "2", "3", "17"], ["Totales", "", "", "", "", "", "", "", "", "", "", "17"])
        + box("MAR", ["Sosa", "x", "", "9-4", "5-3", "2/5", "1", "0", "1", "2", "3", "12"], ["9 Rey", "8", "1-0", "1-1", "0-0", "", "", "", "", "", "", "3"]))
ONE_BOX = LINE + box("RIO", ["7 Paz", "31", "3-2", "9-4", "5-3", "2/5", "1", "0", "1", "2", "3", "17"])
STAND = """<table><tr><td>Group A</td></tr><tr><td>1.</td><td>Rio Alto</td><td>20-10</td></tr><tr><td>1.</td><td>Rio Alto</td><td>3-3</td></tr>
<tr><td>Group B</td></tr><tr><td>1.</td><td>Rio Alto</td><td>9-9</td></tr><tr><td>text</td><td>no record</td><td></td></tr></table>"""


def cells(spark, *pages):
    return pg.extract_tables(spark.createDataFrame(list(enumerate(pages)), "page int, html string"), "page", "html")


def test_champion_ledger(spark):
    out = sheets.champion_ledger(cells(spark, LEDGER, "<table><tr><th>EQUIPO</th></tr><tr><td>x</td></tr></table>"))
    assert rows(out, "season", "champion_city", "no_champion", "note", "runner_up_city", "coach_flag") == [
        ("1942-1943", "SOL", False, "", "RIO", "multi?"), ("1950", "RIO", False, "", "MAR", ""), ("1953", None, True, "NO SE TERMINO", "", "")]


def test_game_pages(spark):
    g = sheets.game_boxes(cells(spark, FULL, ONE_BOX, "<table><tr><td>x</table>"), "page")
    assert rows(g.pages) == [(0, "ok"), (1, "skipped"), (2, "skipped")]
    r = g.results.collect()[0]
    assert (str(r.date), r.team_a_raw, r.score_a, r.team_b_raw, r.score_b, r.quarters_a, r.quarters_b) == ("2001-04-05", "RIO", 38, "MAR", 19, [20, 18], [10, 9])
    got = rows(g.box, "player_raw", "jersey", "team_raw", "minutes", "fg2m", "fg3m", "ftm", "reb", "blk", "pts", "box_check")
    assert got == [("Paz", "7", "RIO", 31, 4, 2, 3, 7, None, 17, "ok"), ("Rey", "9", "MAR", 8, 1, 0, 0, None, None, 3, "pts_mismatch"),
                   ("Sosa", "", "MAR", None, 4, None, 3, 7, 1, 12, "")]


def test_standings_groups(spark):
    assert rows(sheets.standings_rows(cells(spark, STAND), "page"), "group_label", "position", "city_raw", "wins", "losses") == [
        ("a", 1, "Rio Alto", 20, 10), ("b", 1, "Rio Alto", 9, 9)]
