"""League-shaped tables derived in SQL from the lineitem, orders and customer tables.

There is no live feed, so the registered queries read these. The text runs in Spark SQL and (with
one inner query spelled differently) in other SQL engines, which is what makes an independent
check possible. Everything is integer
arithmetic or multiples of a power of two, so sums are exact in any order.

The league grows with the data: teams come from suppliers and players from customers, while a
team plays about 22 plays a game at any scale factor. Seasons are 2020-2022 with 18 weeks.
Player ``p`` plays for team ``(p-1) div 4``; ``p % 4`` gives the position.

Every order, customer and play counts: an order drawn into a gap week of its player moves to the
week after (or before), and players missing from the combine have an id there that is nobody's.

Planted cases: plays without a possessing team, receiver or air yards; failed two-point tries;
players without the second id; blank and NULL opponents; gap weeks; a week in which nobody
plays; players who change teams; one id spelled two ways; two players sharing a name; players
missing from the combine; zero-snap rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

POSITION_OF = "CASE WHEN {p} % 4 = 1 THEN 'QB' WHEN {p} % 4 = 2 THEN 'WR' WHEN {p} % 4 = 3 THEN 'TE' ELSE 'RB' END"

PLAYS = """
SELECT concat(CAST(season AS STRING), '_', CAST(week AS STRING), '_T', CAST(home AS STRING), '_T', CAST(home+1 AS STRING)) AS game_id,
  season, week,
  concat('T', CAST(home AS STRING)) AS home_team, concat('T', CAST(home+1 AS STRING)) AS away_team,
  CASE WHEN u = 99 THEN NULL ELSE concat('T', CAST(t AS STRING)) END AS posteam,
  CASE WHEN u < 60 THEN 'pass' WHEN u < 96 THEN 'run' ELSE 'no_play' END AS play_type,
  CASE WHEN u < 60 THEN concat('G', CAST(4*t+1 AS STRING)) END AS passer_player_id,
  CASE WHEN u < 50 THEN concat('G', CAST(4*t+2+q % 2 AS STRING)) END AS receiver_player_id,
  CASE WHEN u >= 60 AND u < 64 THEN concat('G', CAST(4*t+1 AS STRING)) WHEN u >= 64 AND u < 96 THEN concat('G', CAST(4*t+4 AS STRING)) END AS rusher_player_id,
  CAST(CASE WHEN u < 55 THEN 1 ELSE 0 END AS DOUBLE) AS pass_attempt,
  CAST(CASE WHEN u < 33 THEN 1 ELSE 0 END AS DOUBLE) AS complete_pass,
  CAST(CASE WHEN u < 33 AND q > 44 THEN 1 ELSE 0 END AS DOUBLE) AS pass_touchdown,
  CAST(CASE WHEN u >= 50 AND u < 52 THEN 1 ELSE 0 END AS DOUBLE) AS interception,
  CAST(CASE WHEN u < 33 AND q >= 20 THEN 1 ELSE 0 END AS DOUBLE) AS first_down_pass,
  CAST(CASE WHEN u >= 55 AND u < 60 THEN 1 ELSE 0 END AS DOUBLE) AS sack,
  CAST(CASE WHEN u >= 60 AND u < 64 THEN 1 ELSE 0 END AS DOUBLE) AS qb_scramble,
  CAST(CASE WHEN u < 60 AND q % 6 = 0 THEN 1 ELSE 0 END AS DOUBLE) AS qb_hit,
  CAST(CASE WHEN u >= 60 AND u < 96 THEN 1 ELSE 0 END AS DOUBLE) AS rush_attempt,
  CAST(CASE WHEN u >= 60 AND u < 96 AND q > 46 THEN 1 ELSE 0 END AS DOUBLE) AS rush_touchdown,
  CAST(CASE WHEN u >= 60 AND u < 96 AND q >= 20 THEN 1 ELSE 0 END AS DOUBLE) AS first_down_rush,
  CAST(CASE WHEN u < 33 OR (u >= 60 AND u < 96) THEN q-10 WHEN u < 55 THEN 0 WHEN u < 60 THEN -7 END AS DOUBLE) AS yards_gained,
  CAST(CASE WHEN u >= 60 AND u < 96 THEN q-10 END AS DOUBLE) AS rushing_yards,
  CAST(CASE WHEN u < 50 THEN q-15 END AS DOUBLE) AS air_yards,
  CAST(CASE WHEN u < 33 THEN l_linenumber END AS DOUBLE) AS yards_after_catch,
  CAST(CASE WHEN u < 60 THEN q-25 END AS DOUBLE)/4 AS qb_epa,
  CAST(CASE WHEN u < 50 THEN u-30 END AS DOUBLE)/2 AS cpoe,
  CASE WHEN u = 70 OR u = 20 OR u = 45 THEN 'success' WHEN u = 71 OR u = 46 THEN 'failure' END AS two_point_conv_result
FROM (SELECT *, home+CAST(l_linenumber % 2 AS INT) AS t
      FROM (SELECT *, 2020+CAST(l_orderkey % 3 AS INT) AS season, 1+CAST(l_partkey % 18 AS INT) AS week,
              CAST((l_suppkey - l_suppkey % 4)/2 AS INT) AS home,
              CAST((l_orderkey*7+l_partkey*13+l_linenumber*31) % 100 AS INT) AS u, CAST(l_quantity AS INT) AS q
            FROM {lineitem}) a) b
"""

SNAP_COUNTS = """
SELECT concat(CAST(season AS STRING), '_', CAST(week AS STRING), '_T', CAST(home AS STRING), '_T', CAST(home+1 AS STRING)) AS game_id,
  season, week, concat('Player ', CAST(p AS STRING), CASE WHEN p % 11 = 0 AND week % 2 = 0 THEN ' Jr.' ELSE '' END) AS player,
  concat('F', CAST(p AS STRING)) AS pfr_player_id,
  """ + POSITION_OF.format(p="p") + """ AS position,
  concat('T', CAST(t AS STRING)) AS team,
  CASE WHEN p % 9 = 0 THEN '' WHEN p % 9 = 1 THEN NULL ELSE concat('T', CAST(home+home+1-t AS STRING)) END AS opponent,
  CAST(s % 65 AS DOUBLE) AS offense_snaps, CAST(s % 65 AS DOUBLE)/64 AS offense_pct,
  CAST(s % 11 AS DOUBLE) AS defense_snaps, CAST(s % 11 AS DOUBLE)/64 AS defense_pct,
  CAST(s % 23 AS DOUBLE) AS st_snaps, CAST(s % 23 AS DOUBLE)/32 AS st_pct
FROM (SELECT *, t - t % 2 AS home
      FROM (SELECT season, week, p, s, CAST((p-1 - (p-1) % 4)/4 AS INT) + CASE WHEN p % 13 = 0 AND week > 9 THEN 2 ELSE 0 END AS t
            FROM (SELECT season, week, p, CAST(sum(o_orderkey) AS BIGINT) AS s
                  FROM (SELECT season, p, o_orderkey,
                          CASE WHEN season = 2021 AND played = 9 THEN CASE WHEN (p*7+10*11+season) % 5 = 0 THEN 8 ELSE 10 END ELSE played END AS week
                        FROM (SELECT season, p, o_orderkey,
                                CASE WHEN (p*7+drawn*11+season) % 5 <> 0 THEN drawn WHEN drawn = 18 THEN 17 ELSE drawn+1 END AS played
                              FROM (SELECT 2020+CAST(o_orderkey % 3 AS INT) AS season, 1+CAST((o_orderkey+o_custkey*5) % 18 AS INT) AS drawn,
                                      CAST((o_custkey - o_custkey % 8)/8 AS INT)+1 AS p, o_orderkey FROM {orders}) a) a1) a2
                  GROUP BY season, week, p) b) c) d
"""

PLAYERS = """
SELECT concat('G', CAST(p AS STRING)) AS gsis_id,
  CASE WHEN p % 17 = 0 THEN NULL ELSE concat('F', CAST(p AS STRING)) END AS pfr_id,
  concat('Player ', CAST(CASE WHEN p % 41 = 0 THEN p-1 ELSE p END AS STRING)) AS display_name,
  """ + POSITION_OF.format(p="p") + """ AS position,
  2005+p % 16 AS draft_year, 1+p % 7 AS draft_round, 1+p % 224 AS draft_ovr,
  CAST(68+p % 12 AS DOUBLE) AS height, CAST(180+p % 90 AS DOUBLE) AS weight
FROM (SELECT CAST(c_custkey AS INT)+1 AS p FROM {customer}) a
"""

COMBINE = """
SELECT concat(CASE WHEN p % 3 = 0 THEN 'X' ELSE 'F' END, CAST(p AS STRING)) AS pfr_id,
  4.25+CAST(p % 32 AS DOUBLE)/32 AS forty, CAST(p % 30 AS DOUBLE) AS bench, 28+CAST(p % 24 AS DOUBLE)/2 AS vertical,
  CAST(100+p % 36 AS DOUBLE) AS broad_jump, 6.5+CAST(p % 16 AS DOUBLE)/16 AS cone, 4+CAST(p % 8 AS DOUBLE)/8 AS shuttle
FROM (SELECT CAST(c_custkey AS INT)+1 AS p FROM {customer}) a
"""

PLAYER_STATS = """
SELECT season, week, pid AS player_id, concat('Player ', substring(pid, 2)) AS player_display_name,
  """ + POSITION_OF.format(p="CAST(substring(pid, 2) AS INT)") + """ AS position,
  team, max(opp) AS opponent_team,
  sum(pas*complete_pass) AS completions, sum(pas*pass_attempt) AS attempts, sum(pas*pass_attempt*yards_gained) AS passing_yards,
  sum(pas*pass_touchdown) AS passing_tds, sum(pas*interception) AS passing_interceptions,
  sum(pas*sack) AS sacks_suffered, sum(pas*sack*7) AS sack_yards_lost,
  sum(rus*rush_attempt) AS carries, sum(rus*rush_attempt*yards_gained) AS rushing_yards, sum(rus*rush_touchdown) AS rushing_tds,
  sum(rus*qb_scramble*first_down_rush) AS rushing_fumbles_lost, sum(pas*sack*qb_hit) AS sack_fumbles_lost,
  sum(rec*complete_pass) AS receptions, sum(rec*pass_attempt) AS targets
FROM ({roles}) x
WHERE pid IS NOT NULL GROUP BY season, week, pid, team
"""

# A row per play and filled role: one scan where the engine has a row generator, else a union.
_SIDES = "*, posteam AS team, CASE WHEN posteam = home_team THEN away_team ELSE home_team END AS opp"
ROLES_BY_STACK = (
    f"SELECT {_SIDES}, stack(3, passer_player_id, 1, 0, 0, receiver_player_id, 0, 1, 0, rusher_player_id, 0, 0, 1)"
    " AS (pid, pas, rec, rus) FROM {plays}"
)
ROLES_BY_UNION = (
    f"SELECT {_SIDES}, passer_player_id AS pid, 1 AS pas, 0 AS rec, 0 AS rus FROM plays"
    f" UNION ALL SELECT {_SIDES}, receiver_player_id, 0, 1, 0 FROM plays"
    f" UNION ALL SELECT {_SIDES}, rusher_player_id, 0, 0, 1 FROM plays"
)

TEAM_STATS = """
SELECT season, week, posteam AS team, sum(pass_attempt) AS attempts
FROM {plays} WHERE posteam IS NOT NULL GROUP BY season, week, posteam
"""

# Per metric (a, b, m): the opaque measure is ((n*a + first_downs*b) % m) / 8.
TRACKING_METRICS = {
    "tracking_passing": {
        "avg_time_to_throw": (3, 1, 32),
        "avg_completed_air_yards": (5, 2, 80),
        "avg_intended_air_yards": (7, 3, 96),
        "avg_air_yards_differential": (2, 5, 40),
        "aggressiveness": (11, 3, 240),
        "max_completed_air_distance": (13, 7, 480),
        "avg_air_yards_to_sticks": (3, 7, 48),
        "completion_percentage": (53, 29, 800),
        "expected_completion_percentage": (47, 31, 800),
        "completion_percentage_above_expectation": (5, 11, 64),
    },
    "tracking_receiving": {
        "avg_cushion": (5, 3, 72),
        "avg_separation": (3, 2, 40),
        "avg_intended_air_yards": (9, 5, 120),
        "percent_share_of_intended_air_yards": (31, 17, 400),
        "catch_percentage": (59, 37, 800),
        "avg_yac": (7, 9, 96),
        "avg_expected_yac": (9, 7, 80),
        "avg_yac_above_expectation": (5, 2, 48),
    },
    "tracking_rushing": {
        "efficiency": (7, 3, 64),
        "percent_attempts_gte_eight_defenders": (41, 13, 640),
        "avg_time_to_los": (5, 1, 32),
        "expected_rush_yards": (29, 11, 560),
        "rush_yards_over_expected": (17, 19, 320),
        "avg_rush_yards": (9, 4, 72),
        "rush_yards_over_expected_per_att": (3, 5, 40),
        "rush_pct_over_expected": (7, 2, 8),
    },
}
_TRACKED = {
    "tracking_passing": ("passer_player_id", "first_down_pass"),
    "tracking_receiving": ("receiver_player_id", "first_down_pass"),
    "tracking_rushing": ("rusher_player_id", "first_down_rush"),
}


def _tracking(table: str) -> str:
    player, first_down = _TRACKED[table]
    metrics = ", ".join(
        f"CAST((n*{a} + fd*{b}) % {m} AS DOUBLE)/8 AS {name}" for name, (a, b, m) in TRACKING_METRICS[table].items()
    )
    return f"""
SELECT player_gsis_id, season, week, {metrics}
FROM (SELECT {player} AS player_gsis_id, season, week, count(*) AS n, sum({first_down}) AS fd
      FROM {{plays}} WHERE {player} IS NOT NULL GROUP BY {player}, season, week) x
"""


DERIVATIONS = {
    "plays": PLAYS,
    "snap_counts": SNAP_COUNTS,
    "players": PLAYERS,
    "combine": COMBINE,
    "player_stats": PLAYER_STATS,
    "team_stats": TEAM_STATS,
    **{table: _tracking(table) for table in _TRACKED},
}


class League:
    """The derived tables of one data folder, each a lazy DataFrame built on first use."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._tables: dict[str, DataFrame] = {}

    def __getitem__(self, table: str) -> DataFrame:
        if table not in self._tables:
            self._tables[table] = self._build(table)
        return self._tables[table]

    def _build(self, table: str) -> DataFrame:
        if table not in DERIVATIONS:
            return self.spark.read.parquet(f"{self.folder}/{table}.parquet")
        text = DERIVATIONS[table].replace("{roles}", ROLES_BY_STACK)
        needed = ("lineitem", "orders", "customer", "plays")
        return self.spark.sql(text, **{name: self[name] for name in needed if "{" + name + "}" in text})


def portable_with(*tables: str) -> str:
    """``WITH`` clause defining the tables over plain table names, in dependency order."""
    wanted = set(tables)
    if any("{plays}" in DERIVATIONS[t] or "{roles}" in DERIVATIONS[t] for t in wanted):
        wanted.add("plays")
    names = {t: t for t in ("lineitem", "orders", "customer", "plays")} | {"roles": ROLES_BY_UNION}
    parts = [f"{name} AS ({text.format(**names)})" for name, text in DERIVATIONS.items() if name in wanted]
    return "WITH " + ",\n".join(parts)
