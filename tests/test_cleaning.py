"""Cleaning expressions against hand-worked values."""

import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cartulary.functions import dates, numbers, text, urls


def test_accents_follow_nfd_for_every_mapped_letter(evaluate):
    got = evaluate(text.strip_accents, list(text.ACCENT_FROM))
    want = ["".join(c for c in unicodedata.normalize("NFD", x) if unicodedata.category(c) != "Mn") for x in text.ACCENT_FROM]
    assert got == want


def test_decomposed_letters_lose_their_marks(evaluate):
    assert evaluate(text.strip_accents, ["José Ñu", "ø ß"]) == ["Jose Nu", "ø ß"]


def test_normalisers_differ_where_they_must(evaluate):
    raw = ["  O'Neill,  José A.  ", "Río-Piedras (P.R.)"]
    assert evaluate(text.normalize_name, raw) == ["oneill, jose a", "rio piedras pr"]
    assert evaluate(text.token_sort_key, raw) == ["a jose oneill", "piedras pr rio"]
    assert evaluate(text.place_upper, raw) == ["O'NEILL, JOSE A", "RIO-PIEDRAS (P R )"]
    assert evaluate(text.place_lower, raw) == ["o'neill, jose a.", "rio-piedras (p.r.)"]
    assert evaluate(text.search_fold, raw) == ["oneill,  jose a", "rio-piedras (pr)"]
    assert evaluate(text.slugify, raw) == ["oneill-jose-a", "rio-piedras-pr"]


def test_token_key_ignores_order_and_comma(evaluate):
    a, b = evaluate(text.token_sort_key, ["Vega Luna, Juan", "Juan Vega Luna"])
    assert a == b


def test_nicknames(evaluate):
    raw = ["Vega, Juan 'Pipo'", 'Luna "El Rayo" Paz', "Vega, Juan", "Sosa, Ana 'Bibi"]
    assert evaluate(text.extract_nickname, raw) == ["Pipo", "El Rayo", "", "Bibi"]
    assert evaluate(text.strip_nickname, raw) == ["Vega, Juan", "Luna Paz", "Vega, Juan", "Sosa, Ana"]


def test_city_is_the_half_after_the_last_comma(evaluate):
    assert evaluate(text.city_token, ["Halcones, Río Alto", "RIO ALTO", None]) == ["rio alto", "rio alto", ""]


def test_mojibake_only_when_the_way_back_is_exact(evaluate):
    broken = ["PeÃ±a", "Peña", "Ã", "donâ€™t", "plain", None]
    assert evaluate(text.repair_mojibake, broken) == ["Peña", "Peña", "Ã", "donâ€™t", "plain", None]
    assert evaluate(lambda c: text.repair_mojibake(c, False), broken)[3] == "don’t"


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet="aéñüÑ ’“€xz", max_size=12), min_size=1, max_size=8))
def test_mojibake_round_trip(evaluate, values):
    def damage(s):
        try:
            return s.encode("utf-8").decode("cp1252")
        except UnicodeDecodeError:
            return s
    assert evaluate(lambda c: text.repair_mojibake(c, False), [damage(v) for v in values]) == values


def test_sentinels_and_error_fragments(evaluate):
    raw = [" No se sabe ", "nan", "Ana Error 404 Not Found", "HTTP 503", None, "Ana"]
    assert evaluate(text.clear_sentinels, raw) == ["", "", "Ana", "", "", "Ana"]


@pytest.mark.parametrize("raw,shown", [
    ("JUAN DE LA VEGA", "Juan de la Vega"), ("DE LA VEGA, JUAN", "De la Vega, Juan"), ("O'BRYANT LUNA-PAZ", "O'Bryant Luna-Paz"),
    ("MCCADNEY, BILL JR", "McCadney, Bill Jr."), ("PEDRO A. SOSA III", "Pedro A. Sosa III"), ("Juan Paz", "Juan Paz"),
    ("BILL McCADNEY", "Bill McCadney"), ("RAY 'EL ZURDO' PAZ", "Ray «El Zurdo» Paz"), ("MACDONALD, D'ANGELO", "MacDonald, D'Angelo"),
])
def test_proper_case(evaluate, raw, shown):
    assert evaluate(text.proper_case, [raw]) == [shown]


def test_display_name_rules(spark):
    data = [("NOBODY", None, None, "Not chosen"), ("RED PAZ", None, "Red Paz Jr.", None), ("Paz, Juan 'Pi", "Paz Luna, Juan Jose", None, None),
            ("Paz", "Paz Luna, Juan", None, None), ("Paz", "Sosa, Juan", None, None), ("ANA SOSA", None, None, None), ("Ana Sosa", "X, Y", None, None)]
    df = spark.createDataFrame(data, "raw string, canonical string, o string, x string")
    got = [r[0] for r in df.select(text.display_name("raw", "canonical", "o", "x")).collect()]
    assert got == ["Not chosen", "Red Paz Jr.", "Paz Luna, Juan Jose", "Paz Luna, Juan", "Paz", "Ana Sosa", "Ana Sosa"]


def test_fuzzy_names(spark):
    df = spark.createDataFrame([("Ana Sosa", "ana soza"), ("Ana Sosa", "Ana Paz"), ("Ana Sosa", "Ama Sosa"), ("Ana Sosa", "Eva Luna")], "a string, b string")
    assert [r[0] for r in df.select(text.fuzzy_name_match("a", "b")).collect()] == [True, False, True, False]


@pytest.mark.parametrize("play,want", [
    ("Tiro 3-pt largo hecho por PAZ, A. (12) de RIO ALTO", "made_3"), ("Rebote de Equipo", "team_rebound"), ("Rebote por SOSA de RIO", "rebound"),
    ("Tiro Libre uno fallado", "miss_ft"), ("tapon por PAZ de RIO", "block"), ("algo raro", ""),
])
def test_play_classes(evaluate, play, want):
    assert evaluate(lambda c: text.play_fields(c)["event_type"], [play]) == [want]


def test_play_actor(evaluate):
    r = evaluate(text.play_fields, ["Asistencia por PAZ LUNA (7) de RIO ALTO"])[0]
    assert (r["actor_raw"], r["team_raw"]) == ("PAZ LUNA", "RIO ALTO")


def test_cells(evaluate):
    assert [tuple(r) for r in evaluate(text.split_parenthesised, ["Paz, Ana (Rayos, Rio)", "Paz (  )", "Paz"])] == [("Paz, Ana", "Rayos, Rio"), ("Paz", ""), ("Paz", "")]
    assert [tuple(r) for r in evaluate(text.split_jersey, ["12 Paz", "Paz"])] == [("12", "Paz"), ("", "Paz")]
    assert tuple(evaluate(lambda c: text.split_tail(c, 1), ["COPA - RIO"])[0]) == ("RIO", "COPA")
    assert evaluate(text.primary_position, ["Alero/Centro", "", None]) == ["Alero", None, None]


def test_unknown_is_never_zero(evaluate):
    raw = ["12", "2.0", " 7 ", "", "-", "nan", "None", "x", None, "0"]
    assert evaluate(numbers.to_int, raw) == [12, 2, 7, None, None, None, None, None, None, 0]
    assert evaluate(numbers.to_int_strict, raw) == [12, None, 7, None, None, None, None, None, None, 0]
    assert evaluate(numbers.to_float, ["1.5", "nan", "", "y"]) == [1.5, None, None, None]
    assert evaluate(numbers.to_minutes, ["24:39", "31", "-", "24:3"]) == [24, 31, None, None]


def test_rounding_is_half_even(evaluate):
    assert evaluate(lambda c: numbers.to_float_rounded(c, 1), ["2.25", "2.35", "2.5"]) == [2.2, 2.4, 2.5]


def test_pairs_and_quarters(evaluate):
    assert [tuple(r) for r in evaluate(numbers.split_pair, ["19-7", " 3 - 4 x", "a"])] == [(19, 7), (3, 4), (None, None)]
    assert [tuple(r) for r in evaluate(lambda c: numbers.split_pair(c, "/"), ["5/2"])] == [(5, 2)]
    assert evaluate(numbers.quarter_scores, ["20-18-0-0", "1-0-2", "0-0"]) == [[20, 18], [1, 0, 2], []]


def test_checks_and_birth_years(spark):
    df = spark.createDataFrame([(1, 1, 1, 6), (1, 1, 1, 7), (None, 1, 1, 6)], "a int, b int, c int, p int")
    assert [r[0] for r in df.select(numbers.points_check("a", "b", "c", "p")).collect()] == ["ok", "pts_mismatch", ""]
    df = spark.createDataFrame([(85, 2010), (5, 2022), (70, 1990), (99, 2005)], "y int, s int")
    assert [r[0] for r in df.select(numbers.full_birth_year("y", "s")).collect()] == [1985, 2005, 1970, None]


def test_dates(evaluate):
    got = evaluate(lambda c: dates.to_date_mdy(c).cast("string"), ["3/4/1970", "1/1/1900", "2/30/1999", "", None, "nacido 12/31/1980 aqui"])
    assert got == ["1970-03-04", None, None, None, None, "1980-12-31"]
    assert evaluate(lambda c: dates.game_date(c).cast("string"), ["4/5/01", "4/5/1999", "4/5/77", "x"]) == ["2001-04-05", "1999-04-05", "1977-04-05", None]


def test_capture_times_and_seasons(evaluate):
    assert evaluate(dates.capture_key_in_url, ["http://a/web/20060501000000/x", "http://a/web/2006"]) == ["20060501000000", None]
    assert evaluate(dates.season_key, ["1942 - 1943 final", "1950", "s/n"]) == ["1942-1943", "1950", "s/n"]
    assert evaluate(dates.season_from_game_id, ["BS21001", "bs20101001", "BS", "ZZ1"]) == [2001, 2010, None, None]
    assert [tuple(r) for r in evaluate(dates.champion_cell, ["* NO SE TERMINO", "RIO", "*"])] == [
        (None, "NO SE TERMINO", True), ("RIO", "", False), (None, "no champion of record", True)]


def test_urls(evaluate):
    u = "http://Host.example/a/Leaders.ASP?anio=2011&x=%41+b#top"
    assert evaluate(urls.host, [u]) == ["host.example"]
    assert evaluate(urls.script_name, [u]) == ["leaders.asp"]
    assert evaluate(lambda c: urls.parameter(c, "anio"), [u, "http://a/b"]) == ["2011", None]
    assert evaluate(urls.unquote, ["%41+b%20c", "100%"]) == ["A+b c", "100%"]
    assert evaluate(lambda c: urls.season_of(c, F.lit("20150101000000")), [u, "http://h/2009/x", "http://h/x"]) == [2011, 2009, 2015]
    assert evaluate(urls.normal_slug, [" Rio_Alto%20 "]) == ["rio-alto"]
