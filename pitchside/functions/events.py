"""Event-level column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bracket labels and their upper minute bounds (half-open),
# the last label catches everything else, a null minute included.
TIME_BRACKETS = [(15, "0-15"), (30, "15-30"), (45, "30-45"), (60, "45-60"), (75, "60-75")]
LAST_BRACKET = "75+"


def time_bracket(minute: Column | str = "minute") -> Column:
    m = F.col(minute) if isinstance(minute, str) else minute
    expr = None
    for bound, label in TIME_BRACKETS:
        expr = F.when(m < bound, label) if expr is None else expr.when(m < bound, label)
    return expr.otherwise(LAST_BRACKET)


def home_away(team: str = "team_name", home: str = "home_team") -> Column:
    """'Home' when the team is the home team, else 'Away' (a null team is Away)."""
    return F.when(F.col(team) == F.col(home), "Home").otherwise("Away")


def is_goal(outcome: str = "shot_outcome") -> Column:
    return F.when(F.col(outcome) == "Goal", True).otherwise(False)


def is_on_target(outcome: str = "shot_outcome") -> Column:
    return F.when(F.col(outcome).isin("Goal", "Saved"), True).otherwise(False)
