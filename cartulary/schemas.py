"""Column layout of the archive's tables. Text stays text at rest; season keys are never numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PROVENANCE = "confidence string, source_id string, source_url string, retrieved_at string"
CONFIDENCE = ("verified", "single-source", "disputed")

_COUNTERS = "fg2m int, fg2a int, fg3m int, fg3a int, ftm int, fta int, oreb int, dreb int, reb int, ast int, stl int, blk int, pf int, tov int"

_TABLES = {
    "champions": "season string, champion_city string, coach string, coach_flag string, runner_up_city string, "
                 "no_champion boolean, note string, parse_flag string, n_captures int",
    "season_leaders": "season string, category string, prom_kind string, rank int, player_raw string, club_raw string, games int, "
                      "total int, made int, attempted int, def_reb int, off_reb int, prom double, season_complete boolean, "
                      "serie_context string, capture_date date, note string",
    "scoring_champions": "season string, player_raw string, team_raw string, games int, total_points int, ppg double, metric_era string, note string",
    "awards": "award string, season string, player_raw string, team_raw string, note string",
    "players": "player_id long, canonical_name string, normalized_name string, family string, given string, nickname string, "
               "birth_date date, birth_year int, birth_city string, nationality string, position string, first_season int, "
               "last_season int, n_seasons int, has_profile string",
    "player_aliases": "player_id long, alias string, normalized_alias string, alias_type string, source string",
    "career_seasons": "player_id long, season int, team_raw string, games int, points int",
    "id_map": "obs_source string, player_raw string, club_raw string, season string, player_id long, canonical_name string, "
              "match_method string, club_check string",
    "review_queue": "obs_source string, player_raw string, club_raw string, season string, candidate_ids array<bigint>, reason string",
    "bios": "player_id long, notes string, birthplace string, roster_team string, roster_year int, jersey string",
    "identity_decisions": "decision_id string, kind string, ids array<bigint>, survivor_id bigint, evidence string",
    "tombstones": "retired_id bigint, survivor_id bigint, decision_id string, retired_name string, retired_at string",
    "game_results": "game_id string, season string, date date, script string, team_a_raw string, score_a int, team_b_raw string, "
                    "score_b int, quarters_a array<int>, quarters_b array<int>",
    "box_scores": "game_id string, season string, date date, team_raw string, jersey string, player_raw string, player_id long, "
                  f"minutes int, {_COUNTERS}, pts int, box_check string",
    "plays": "game_id string, season string, quarter int, clock string, seq int, play_raw string, event_type string, actor_raw string, "
             "team_raw string, home_score int, away_score int",
    "franchises": "franchise_id string, canonical_name string, city string, founded int, status string",
    "franchise_events": "event_type string, season int, from_franchise_id string, to_franchise_id string, note string",
    "city_map": "normalized_city string, franchise_id string",
    "city_overrides": "city string, season_start int, season_end int, franchise_id string, evidence string",
    "standings": "season string, franchise_id string, city_raw string, stage string, position int, wins int, losses int, note string, capture_date date",
    "roster": "player_id long, season int, franchise_id string, jersey_number string, height_cm int, position_raw string, name_raw string",
}


def schema(table: str) -> T.StructType:
    """Typed layout of a table, provenance columns last."""
    return T.StructType.fromDDL(f"{_TABLES[table]}, {PROVENANCE}")


def text_schema(table: str) -> T.StructType:
    """The same columns as they are on disk: text only."""
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema(table)])


def tables() -> tuple[str, ...]:
    return tuple(_TABLES)


def _typed(name: str, kind: T.DataType, list_sep: str) -> Column:
    c = F.nullif(F.trim(F.col(name)), F.lit(""))
    if isinstance(kind, T.BooleanType):
        return F.when(c.isNotNull(), F.lower(c).isin("true", "yes", "1"))
    if isinstance(kind, T.ArrayType):
        return F.transform(F.split(c, list_sep), lambda x: F.trim(x).try_cast(kind.elementType))
    return c.try_cast(kind)


def typed(df: DataFrame, table: str, list_sep: str = r"[;|]") -> DataFrame:
    """Text rows to typed rows, once: blanks and unreadable values are NULL, never 0 or False."""
    return df.select(*[_typed(f.name, f.dataType, list_sep).alias(f.name) for f in schema(table)])
