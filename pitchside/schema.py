"""Column contracts of the event data model.

Fixed values (must equal the modelled pipeline for the same results):
- raw core columns, in order: id, index, period, timestamp, type, team,
  player, location
- renames after flattening: type_name -> type, team_name -> team,
  player_name -> player
- accepted periods: 1, 2, 3, 4, 5
- staged column names (39), in order, listed in STAGED below.
"""

from __future__ import annotations

# --- raw (flattened) file contract -------------------------------------------
CORE_COLUMNS = ["id", "index", "period", "timestamp", "type", "team", "player", "location"]
NAME_RENAMES = {"type_name": "type", "team_name": "team", "player_name": "player"}
ACCEPTED_PERIODS = [1, 2, 3, 4, 5]

# Declared type and nullability of the required raw columns.
REQUIRED_RAW = [
    ("id", "string", False),
    ("index", "bigint", False),
    ("period", "bigint", False),
    ("timestamp", "string", False),
    ("type", "string", False),
    ("team", "string", False),
    ("player", "string", True),
]


# --- raw source column -> staged column (39, in staged order) -----------------
# (raw name, staged name, spark type)
STAGED = [
    ("id", "event_id", "bigint"),
    ("match_id", "match_id", "bigint"),
    ("index", "event_index", "bigint"),
    ("period", "period", "int"),
    ("minute", "minute", "int"),
    ("second", "second", "int"),
    ("timestamp", "event_timestamp", "string"),
    ("home_team", "home_team", "string"),
    ("away_team", "away_team", "string"),
    ("type", "event_type", "string"),
    ("team", "team_name", "string"),
    ("player", "player_name", "string"),
    ("player_id", "player_id", "bigint"),
    ("position", "player_position", "string"),
    ("play_pattern", "play_pattern", "string"),
    ("under_pressure", "under_pressure", "boolean"),
    ("pass_length", "pass_length", "double"),
    ("pass_angle", "pass_angle", "double"),
    ("pass_height", "pass_height", "string"),
    ("pass_body_part", "pass_body_part", "string"),
    ("pass_outcome", "pass_outcome", "string"),
    ("pass_type", "pass_type", "string"),
    ("pass_cross", "pass_cross", "boolean"),
    ("pass_switch", "pass_switch", "boolean"),
    ("pass_through_ball", "pass_through_ball", "boolean"),
    ("pass_goal_assist", "pass_goal_assist", "boolean"),
    ("pass_shot_assist", "pass_shot_assist", "boolean"),
    ("pass_recipient", "pass_recipient_name", "string"),
    ("shot_statsbomb_xg", "shot_xg", "double"),
    ("shot_outcome", "shot_outcome", "string"),
    ("shot_body_part", "shot_body_part", "string"),
    ("shot_technique", "shot_technique", "string"),
    ("shot_type", "shot_type", "string"),
    ("shot_first_time", "shot_first_time", "boolean"),
    ("shot_one_on_one", "shot_one_on_one", "boolean"),
    ("shot_open_goal", "shot_open_goal", "boolean"),
    ("carry_end_location", "carry_end_location", "array<double>"),
    ("dribble_outcome", "dribble_outcome", "string"),
    ("location", "location", "array<double>"),
]

STAGED_COLUMNS = [s for _, s, _ in STAGED]
RAW_TO_STAGED = {r: s for r, s, _ in STAGED}
STAGED_TO_RAW = {s: r for r, s, _ in STAGED}

# Event types the marts look at (case-sensitive equality).
PASS, SHOT, DRIBBLE, PRESSURE = "Pass", "Shot", "Dribble", "Pressure"


# --- nested event format -------------------------------------------------------
# Detail groups of the nested event format and the fields that
# arrive as {"name": ...} objects there (plain strings in the flat format).
NESTED_GROUPS = ("pass", "shot", "carry", "dribble")
NAMED_FIELDS = {
    "type", "team", "player", "position", "play_pattern",
    "pass_height", "pass_body_part", "pass_outcome", "pass_type", "pass_recipient",
    "shot_outcome", "shot_body_part", "shot_technique", "shot_type", "dribble_outcome",
}
# Top-level keys a file must carry in at least one record.
REQUIRED_KEYS = ["id", "index", "period", "timestamp", "type", "team", "player"]
