"""Independent SQL for every registered query, over the same derived tables.

Plain window functions and joins, one statement each, with none of the library's operators.
"""

from __future__ import annotations

from tallyweek.sources.derived import TRACKING_METRICS, portable_with

# --- shared common table expressions -------------------------------------------------------

GRID = """
spans AS (SELECT pfr_player_id, team, season, player, position, min(week) AS first_week, max(week) AS last_week
          FROM snap_counts GROUP BY pfr_player_id, team, season, player, position),
weeks AS (SELECT DISTINCT season, week FROM snap_counts),
grid AS (SELECT s.season, w.week, s.pfr_player_id, s.team, s.player, s.position
         FROM spans s JOIN weeks w ON s.season = w.season AND w.week BETWEEN s.first_week AND s.last_week)"""

SNAP_REPORT = GRID + """,
filled AS (SELECT g.season, g.week, g.player, g.pfr_player_id, g.position, g.team, coalesce(c.opponent, '') AS opponent,
             coalesce(c.offense_snaps, 0) AS offense_snaps, coalesce(c.offense_pct, 0) AS offense_snap_share,
             coalesce(c.defense_snaps, 0) AS defense_snaps, coalesce(c.defense_pct, 0) AS defense_snap_share,
             coalesce(c.st_snaps, 0) AS special_teams_snaps, coalesce(c.st_pct, 0) AS special_teams_snap_share
           FROM grid g LEFT JOIN snap_counts c
             ON g.season = c.season AND g.week = c.week AND g.pfr_player_id = c.pfr_player_id AND g.team = c.team),
snap_report AS (SELECT *,
    offense_snap_share - lag(offense_snap_share) OVER w AS wow_offense_snap_share_change,
    defense_snap_share - lag(defense_snap_share) OVER w AS wow_defense_snap_share_change,
    special_teams_snap_share - lag(special_teams_snap_share) OVER w AS wow_special_teams_snap_share_change
  FROM filled
  WINDOW w AS (PARTITION BY pfr_player_id, team, season ORDER BY week, player, position))"""

REGULAR_QBS = """
regular AS (SELECT season, player, team, count(*) AS weeks FROM snap_report
            WHERE offense_snap_share > 0.5 AND position = 'QB' GROUP BY season, player, team)"""

TOP_OF_SEASON = "QUALIFY row_number() OVER (PARTITION BY season ORDER BY weeks DESC, player, team) <= {top}"

_LOST_ORDER = "ORDER BY week, player NULLS FIRST, position NULLS FIRST"
NAMES_LOST = """
lost AS (SELECT * REPLACE (CASE WHEN week % 4 <> 0 THEN player END AS player, CASE WHEN week % 6 <> 0 THEN position END AS position)
         FROM snap_counts),""" + SNAP_REPORT.replace("snap_counts", "lost").replace("ORDER BY week, player, position", _LOST_ORDER)
NAMES_FILLED = f"""SELECT * REPLACE (coalesce(player, first_value(player IGNORE NULLS) OVER w) AS player,
    coalesce(position, first_value(position IGNORE NULLS) OVER w) AS position) FROM snap_report
  WINDOW w AS (PARTITION BY pfr_player_id, team, season {_LOST_ORDER} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"""

DROPBACKS = """
dropbacks AS (SELECT season, week, posteam AS team,
    coalesce(sum(pass_attempt), 0) + coalesce(sum(sack), 0) + coalesce(sum(qb_scramble), 0) AS team_dropbacks
  FROM plays GROUP BY season, week, posteam)"""

GAME_IDS = """
game_ids AS (SELECT DISTINCT game_id, season, week, posteam AS team FROM plays)"""

QB_ROWS = """
totals AS (SELECT season, week, team, sum(attempts) AS team_pass_attempts, sum(passing_yards) AS team_pass_yards
           FROM player_stats GROUP BY season, week, team),
qb AS (SELECT season, week, player_display_name AS player, player_id AS pfr_player_id, team, opponent_team AS opponent,
         position, completions, attempts, passing_yards, passing_tds, passing_interceptions AS interceptions,
         sacks_suffered AS sacks, sack_yards_lost AS sack_yards, carries AS rush_attempts, rushing_yards AS rush_yards,
         rushing_tds AS rush_tds, sack_fumbles_lost, rushing_fumbles_lost AS rush_fumbles_lost
       FROM player_stats WHERE position = 'QB' AND attempts > 0)"""

QB_METRICS = """
metrics AS (SELECT game_id, season, week, passer_player_id AS player_id, posteam AS team,
    avg(qb_epa) AS epa_per_dropback,
    CASE WHEN count(qb_epa) > 0 THEN CAST(count(*) FILTER (WHERE qb_epa > 0) AS DOUBLE) / count(qb_epa) END AS success_rate,
    avg(cpoe) AS cpoe,
    avg(air_yards) FILTER (WHERE pass_attempt = 1) AS air_yards_per_attempt,
    CASE WHEN sum(pass_attempt) > 0 THEN CAST(count(*) FILTER (WHERE pass_attempt = 1 AND yards_gained >= 20) AS DOUBLE) / sum(pass_attempt) END AS big_play_rate,
    CASE WHEN count(qb_epa) > 0 THEN CAST(count(*) FILTER (WHERE qb_hit = 1) AS DOUBLE) / count(qb_epa) END AS pressure_rate
  FROM plays WHERE pass_attempt = 1 OR sack = 1
  GROUP BY game_id, season, week, passer_player_id, posteam)"""

QB_DERIVED = """
    completions / attempts AS completion_pct, passing_yards / attempts AS yards_per_attempt,
    attempts + sacks AS dropbacks,
    interceptions + coalesce(sack_fumbles_lost, 0) + coalesce(rush_fumbles_lost, 0) AS turnovers,
    (passing_yards - sack_yards) / attempts AS net_yards_per_attempt,
    CASE WHEN interceptions > 0 THEN passing_tds / interceptions END AS td_int_ratio,
    passing_yards + coalesce(rush_yards, 0) AS total_yards,
    passing_tds + coalesce(rush_tds, 0) AS total_tds,
    (passing_yards + 20 * passing_tds - 45 * interceptions - sack_yards) / (attempts + sacks) AS adjusted_net_yards_per_attempt,
    (passing_yards - sack_yards) / (attempts + sacks) AS yards_per_dropback,
    sacks / (attempts + sacks) AS sack_rate,
    attempts + sacks + coalesce(rush_attempts, 0) AS total_plays,
    CASE WHEN team_pass_attempts > 0 THEN attempts / team_pass_attempts END AS team_pass_attempt_share,
    CASE WHEN team_pass_yards > 0 THEN passing_yards / team_pass_yards END AS team_pass_yard_share"""

RATING = """(
      least(greatest((completions / attempts - CAST(0.3 AS DOUBLE)) * 5, 0), CAST(2.375 AS DOUBLE))
    + least(greatest((passing_yards / attempts - 3) * CAST(0.25 AS DOUBLE), 0), CAST(2.375 AS DOUBLE))
    + least(greatest(passing_tds / attempts * 20, 0), CAST(2.375 AS DOUBLE))
    + least(greatest(CAST(2.375 AS DOUBLE) - interceptions / attempts * 25, 0), CAST(2.375 AS DOUBLE))) / 6 * 100"""

QB_POINTS = """(passing_yards * CAST(0.04 AS DOUBLE) + passing_tds * 4 - interceptions * 2
    + coalesce(rush_yards, 0) * CAST(0.1 AS DOUBLE) + coalesce(rush_tds, 0) * 6)"""

QB_REPORT = QB_ROWS + "," + QB_METRICS + "," + GAME_IDS + f""",
qb_joined AS (SELECT qb.*, g.game_id, t.team_pass_attempts, t.team_pass_yards, m.epa_per_dropback, m.success_rate,
    m.cpoe, m.air_yards_per_attempt, m.big_play_rate, m.pressure_rate
  FROM qb LEFT JOIN game_ids g USING (season, week, team) LEFT JOIN totals t USING (season, week, team)
    LEFT JOIN metrics m ON m.game_id = g.game_id AND m.season = qb.season AND m.week = qb.week
      AND m.player_id = qb.pfr_player_id AND m.team = qb.team),
qb_full AS (SELECT *, {QB_DERIVED}, {RATING} AS passer_rating, {QB_POINTS} AS fantasy_points_standard,
    {QB_POINTS} AS fantasy_points_ppr FROM qb_joined),
qb_report AS (SELECT *,
    passing_yards - lag(passing_yards) OVER w AS wow_yards_change,
    total_tds - lag(total_tds) OVER w AS wow_td_change,
    epa_per_dropback - lag(epa_per_dropback) OVER w AS wow_epa_change
  FROM qb_full WINDOW w AS (PARTITION BY pfr_player_id, team, season ORDER BY week, game_id))"""

PASSING = """
passing AS (SELECT game_id, season, week, passer_player_id AS gsis_id, posteam AS team,
    coalesce(sum(pass_attempt), 0) AS pass_attempts, coalesce(sum(complete_pass), 0) AS pass_complete,
    coalesce(sum(yards_gained) FILTER (WHERE pass_attempt = 1), 0) AS passing_yards,
    coalesce(sum(pass_touchdown), 0) AS pass_touchdowns, coalesce(sum(interception), 0) AS interceptions,
    coalesce(sum(first_down_pass), 0) AS pass_first_downs,
    count(*) FILTER (WHERE two_point_conv_result = 'success' AND pass_attempt = 1) AS pass_2pt_conversions
  FROM plays WHERE passer_player_id IS NOT NULL GROUP BY game_id, season, week, passer_player_id, posteam)"""

RECEIVING = """
receiving AS (SELECT game_id, season, week, receiver_player_id AS gsis_id, posteam AS team,
    coalesce(sum(complete_pass), 0) AS receptions, coalesce(sum(pass_attempt), 0) AS targets,
    coalesce(sum(yards_gained) FILTER (WHERE complete_pass = 1), 0) AS receiving_yards,
    coalesce(sum(air_yards) FILTER (WHERE pass_attempt = 1), 0) AS receiving_air_yards,
    coalesce(sum(yards_after_catch) FILTER (WHERE complete_pass = 1), 0) AS receiving_yac,
    coalesce(sum(pass_touchdown), 0) AS receiving_touchdowns,
    coalesce(sum(first_down_pass) FILTER (WHERE complete_pass = 1), 0) AS receiving_first_downs,
    count(*) FILTER (WHERE two_point_conv_result = 'success' AND complete_pass = 1) AS receiving_2pt_conversions
  FROM plays WHERE receiver_player_id IS NOT NULL GROUP BY game_id, season, week, receiver_player_id, posteam)"""

RUSHING = """
rushing AS (SELECT game_id, season, week, rusher_player_id AS gsis_id, posteam AS team,
    coalesce(sum(rush_attempt), 0) AS rush_attempts,
    coalesce(sum(yards_gained) FILTER (WHERE rush_attempt = 1), 0) AS rushing_yards,
    coalesce(sum(rush_touchdown), 0) AS rush_touchdowns, coalesce(sum(first_down_rush), 0) AS rush_first_downs
  FROM plays WHERE rusher_player_id IS NOT NULL GROUP BY game_id, season, week, rusher_player_id, posteam)"""

TARGETS = """
team_targets AS (SELECT game_id, posteam AS team, coalesce(sum(pass_attempt), 0) AS team_targets
  FROM plays WHERE receiver_player_id IS NOT NULL GROUP BY game_id, posteam)"""

STATS = PASSING + "," + RECEIVING + "," + RUSHING + "," + TARGETS + """,
stats AS (SELECT j.*, t.team_targets, CASE WHEN t.team_targets > 0 THEN j.targets / t.team_targets END AS target_share
  FROM (SELECT * FROM passing FULL JOIN receiving USING (game_id, season, week, gsis_id, team)
        FULL JOIN rushing USING (game_id, season, week, gsis_id, team)) j
    LEFT JOIN team_targets t USING (game_id, team))"""

POINTS = """(coalesce(passing_yards, 0) * CAST(0.04 AS DOUBLE) + coalesce(pass_touchdowns, 0) * CAST(4 AS DOUBLE)
    + coalesce(interceptions, 0) * CAST(-2 AS DOUBLE) + coalesce(pass_2pt_conversions, 0) * CAST(2 AS DOUBLE)
    + coalesce(rushing_yards, 0) * CAST(0.1 AS DOUBLE) + coalesce(rush_touchdowns, 0) * CAST(6 AS DOUBLE)
    + coalesce(receiving_yards, 0) * CAST(0.1 AS DOUBLE) + coalesce(receptions, 0) * CAST(0.5 AS DOUBLE)
    + coalesce(receiving_touchdowns, 0) * CAST(6 AS DOUBLE) + coalesce(receiving_2pt_conversions, 0) * CAST(2 AS DOUBLE))"""

OPPONENTS = """
games AS (SELECT DISTINCT game_id, season, week, home_team, away_team FROM plays),
opponents AS (SELECT game_id, season, week, home_team AS team, away_team AS opponent FROM games
              UNION ALL SELECT game_id, season, week, away_team, home_team FROM games)"""

SNAP_IDS = """
mapped AS (SELECT p.gsis_id, coalesce(p.gsis_id, 'pfr:' || s.pfr_player_id, 'name:' || s.player) AS player_key, s.*
  FROM snap_counts s LEFT JOIN players p ON s.pfr_player_id = p.pfr_id),
snap_ids AS (SELECT gsis_id, player_key, season, week, team, opponent, game_id,
    offense_snaps, offense_pct AS offense_snap_share, offense_pct - lag(offense_pct) OVER w AS wow_offense_snap_share_change,
    defense_snaps, defense_pct AS defense_snap_share, defense_pct - lag(defense_pct) OVER w AS wow_defense_snap_share_change,
    st_snaps AS special_teams_snaps, st_pct AS special_teams_snap_share,
    st_pct - lag(st_pct) OVER w AS wow_special_teams_snap_share_change
  FROM mapped WINDOW w AS (PARTITION BY player_key, team, season ORDER BY week, game_id))"""

COMBINE_BY_PLAYER = """
measured AS (SELECT p.gsis_id, c.forty AS fourty, c.bench, c.vertical, c.broad_jump, c.cone, c.shuttle
  FROM combine c JOIN players p ON c.pfr_id = p.pfr_id)"""

PASSING_METRICS = ", ".join(f"tp.{m}" for m in TRACKING_METRICS["tracking_passing"])
RECEIVING_METRICS = ", ".join(
    f"tc.{m}" + (" AS avg_air_distance" if m == "avg_intended_air_yards" else "")
    for m in TRACKING_METRICS["tracking_receiving"]
)
RUSHING_METRICS = ", ".join(f"tr.{m}" for m in TRACKING_METRICS["tracking_rushing"])


def _tracking_joins(key: str) -> str:
    return "\n".join(
        f"LEFT JOIN {table} {a} ON {a}.player_gsis_id = {key}.gsis_id AND {a}.season = {key}.season AND {a}.week = {key}.week"
        for table, a in (("tracking_passing", "tp"), ("tracking_receiving", "tc"), ("tracking_rushing", "tr"))
    )


OPPORTUNITY = STATS + "," + OPPONENTS + "," + SNAP_IDS + "," + COMBINE_BY_PLAYER + f""",
master AS (SELECT s.season, s.week, p.display_name AS player_name, s.gsis_id, p.position, s.team,
    CASE WHEN s.opponent IS NULL OR s.opponent = '' THEN o.opponent ELSE s.opponent END AS opponent,
    p.draft_year, p.draft_round, p.draft_ovr AS draft_pick, p.height AS player_height, p.weight AS player_weight,
    c.fourty, c.bench, c.vertical, c.broad_jump, c.cone, c.shuttle,
    s.offense_snaps, s.offense_snap_share, s.wow_offense_snap_share_change,
    s.defense_snaps, s.defense_snap_share, s.wow_defense_snap_share_change,
    s.special_teams_snaps, s.special_teams_snap_share, s.wow_special_teams_snap_share_change,
    x.pass_attempts, x.pass_complete, x.pass_touchdowns, x.passing_yards, x.interceptions, x.pass_first_downs,
    x.pass_2pt_conversions, {PASSING_METRICS},
    x.receptions, x.receiving_yards, x.receiving_air_yards, x.receiving_yac, x.receiving_touchdowns,
    x.receiving_first_downs, x.receiving_2pt_conversions, CAST(NULL AS DOUBLE) AS max_air_distance,
    {RECEIVING_METRICS}, x.targets, x.target_share,
    x.rush_attempts, x.rushing_yards, x.rush_touchdowns, x.rush_first_downs, {RUSHING_METRICS},
    {POINTS} AS fantasy_points
  FROM snap_ids s LEFT JOIN players p ON p.gsis_id = s.gsis_id
    LEFT JOIN stats x ON x.gsis_id = s.gsis_id AND x.season = s.season AND x.week = s.week AND x.team = s.team
      AND x.game_id = s.game_id
    LEFT JOIN opponents o ON o.game_id = s.game_id AND o.team = s.team
    {_tracking_joins("s")}
    LEFT JOIN measured c ON c.gsis_id = s.gsis_id),
report AS (SELECT *, CASE WHEN coalesce(offense_snaps, 0) >= 1 THEN CAST(rnk AS INTEGER) END AS f_position_rank
  FROM (SELECT *, dense_rank() OVER (PARTITION BY season, week, position ORDER BY fantasy_points DESC) AS rnk FROM master) r)"""

OPPORTUNITY_TABLES = (
    "snap_counts",
    "players",
    "plays",
    "combine",
    "tracking_passing",
    "tracking_receiving",
    "tracking_rushing",
)

POSITION_ORDER = "CASE position WHEN 'QB' THEN 0 WHEN 'RB' THEN 1 WHEN 'WR' THEN 2 WHEN 'TE' THEN 3 ELSE 99 END"
EXTRA_ROWS = "CASE position WHEN 'QB' THEN 1 WHEN 'RB' THEN 3 WHEN 'WR' THEN 3 WHEN 'TE' THEN 3 ELSE 0 END"

REGULARS = OPPORTUNITY + """,
skill AS (SELECT season, week, team, position, player_name, offense_snap_share, targets,
    percent_share_of_intended_air_yards, avg_yac, rush_first_downs, receiving_first_downs, completion_percentage
  FROM report WHERE position IN ('QB', 'WR', 'RB', 'TE') AND offense_snap_share IS NOT NULL),
regulars AS (SELECT * FROM skill WHERE (season, player_name) IN
    (SELECT (season, player_name) FROM skill GROUP BY season, player_name HAVING count(week) >= 3))"""

PLAYER_ORDER = REGULARS + f""",
player_first AS (SELECT season, player_name, team, position FROM
    (SELECT *, row_number() OVER (PARTITION BY season, player_name ORDER BY week, team, position) AS rn FROM regulars) r
  WHERE rn = 1),
player_avg AS (SELECT season, player_name, avg(offense_snap_share) AS avg_snap FROM regulars GROUP BY season, player_name),
player_rows AS (SELECT season, player_name, team, position, {POSITION_ORDER} AS pos_order, avg_snap
  FROM player_first JOIN player_avg USING (season, player_name)),
ordered AS (SELECT *, row_number() OVER w - 1 AS row_index,
    CAST(sum(1 + {EXTRA_ROWS}) OVER w AS BIGINT) - (1 + {EXTRA_ROWS}) AS expanded_index
  FROM player_rows
  WINDOW w AS (PARTITION BY season ORDER BY team, pos_order, avg_snap DESC, player_name ROWS UNBOUNDED PRECEDING))"""

CELLS = PLAYER_ORDER + """,
first_cell AS (SELECT * FROM
    (SELECT *, row_number() OVER (PARTITION BY season, player_name, week
       ORDER BY team, position, offense_snap_share, targets NULLS FIRST, percent_share_of_intended_air_yards NULLS FIRST,
         avg_yac NULLS FIRST, rush_first_downs NULLS FIRST, receiving_first_downs NULLS FIRST,
         completion_percentage NULLS FIRST) AS rn FROM regulars) r WHERE rn = 1),
cells AS (SELECT o.season, o.player_name, o.team, o.position, o.row_index, o.expanded_index, c.week, c.offense_snap_share,
    CASE WHEN o.position IN ('WR', 'RB', 'TE') THEN c.targets END AS targets,
    CASE WHEN o.position IN ('WR', 'RB', 'TE') THEN c.percent_share_of_intended_air_yards END AS percent_share_of_intended_air_yards,
    CASE WHEN o.position IN ('WR', 'TE') THEN c.avg_yac END AS avg_yac,
    CASE WHEN o.position = 'RB' THEN c.rush_first_downs END AS rush_first_downs,
    CASE WHEN o.position IN ('WR', 'RB', 'TE') THEN c.receiving_first_downs END AS receiving_first_downs,
    CASE WHEN o.position = 'QB' THEN c.completion_percentage END AS completion_percentage
  FROM ordered o JOIN first_cell c USING (season, player_name))"""

# place, metric, label, key suffix, positions
_METRIC_ROWS = [
    (1, "completion_percentage", "  → Comp %", "_comp_pct", "'QB'"),
    (1, "targets", "  → Targets", "_targets", "'RB', 'WR', 'TE'"),
    (2, "rush_first_downs", "  → Rush 1st D", "_rush_fd", "'RB'"),
    (2, "avg_yac", "  → Avg YAC", "_avg_yac", "'WR', 'TE'"),
    (3, "receiving_first_downs", "  → Rec 1st D", "_rec_fd", "'RB', 'WR', 'TE'"),
]


def _metric_row(place: int, metric: str, label: str, suffix: str, positions: str) -> str:
    share = "percent_share_of_intended_air_yards" if metric == "targets" else "CAST(NULL AS DOUBLE)"
    return f"""UNION ALL SELECT season, expanded_index + {place}, player_name, team, position, '{metric}', '{label}',
      player_name || '{suffix}', week, {metric}, {share} FROM cells WHERE position IN ({positions})"""


METRIC_ROWS = CELLS + """,
metric_rows AS (SELECT *, 'Week ' || week AS week_label FROM
  (SELECT season, expanded_index AS row_index, player_name, team, position, 'offense_snap_share' AS metric,
      player_name AS row_label, player_name AS row_key, week, offense_snap_share AS value, CAST(NULL AS DOUBLE) AS target_share
    FROM cells
    """ + "\n    ".join(_metric_row(*row) for row in _METRIC_ROWS) + ") u)"

_MEASURES = [
    "offense_snap_share",
    "targets",
    "percent_share_of_intended_air_yards",
    "avg_yac",
    "rush_first_downs",
    "receiving_first_downs",
    "completion_percentage",
]
_WEEK_COLUMNS = ", ".join(f"max(CASE WHEN week = {w} THEN value END) AS week_{w}" for w in range(1, 19))

RUNS = """
runs AS (SELECT p.*, b.display_name AS name, b.position FROM plays p LEFT JOIN players b ON p.rusher_player_id = b.gsis_id
         WHERE p.play_type = 'run'),
rush_totals AS (SELECT rusher_player_id, name, position, coalesce(sum(rushing_yards), 0) AS rushing_yards,
    count(rush_attempt) AS rush_attempt, count(DISTINCT game_id) AS games_played, coalesce(sum(rush_touchdown), 0) AS tds
  FROM runs GROUP BY rusher_player_id, name, position),
rush_ranked AS (SELECT *, rushing_yards / nullif(rush_attempt, 0) AS ypa, tds / nullif(rush_attempt, 0) AS tds_per_attempt,
    CAST(dense_rank() OVER (ORDER BY rush_attempt DESC) AS INTEGER) AS rank FROM rush_totals)"""


def _sql(tables: tuple[str, ...], ctes: str, select: str) -> str:
    return portable_with(*tables) + ("," + ctes if ctes else "") + "\n" + select


_QB_EFFICIENCY = f"SELECT qb.*, t.team_pass_attempts, t.team_pass_yards, {QB_DERIVED} FROM qb LEFT JOIN totals t USING (season, week, team)"
_QB_COLUMNS = """season, week, game_id, player, pfr_player_id, team, opponent, position, attempts AS pass_attempts,
  completions, completion_pct, passing_yards, passing_tds, interceptions, sacks, sack_yards, yards_per_attempt,
  net_yards_per_attempt, adjusted_net_yards_per_attempt, passer_rating, dropbacks, yards_per_dropback, total_plays,
  rush_attempts, rush_yards, rush_tds, total_yards, total_tds, turnovers, td_int_ratio, team_pass_attempt_share,
  team_pass_yard_share, epa_per_dropback, success_rate, cpoe, air_yards_per_attempt, big_play_rate, pressure_rate,
  sack_rate, fantasy_points_standard, fantasy_points_ppr, wow_yards_change, wow_td_change, wow_epa_change"""
_SNAPS = ("snap_counts",)
_PLAYS = ("plays",)
_STATS = ("plays", "player_stats")

RECEIVING_ROWS = DROPBACKS + "," + GAME_IDS + """,
joined AS (SELECT s.season, s.week, g.game_id, s.player_display_name AS player, s.player_id AS pfr_player_id, s.position, s.team,
    s.opponent_team AS opponent, s.receptions, s.targets, t.attempts AS team_pass_attempts, d.team_dropbacks,
    CASE WHEN t.attempts > 0 THEN s.targets / t.attempts END AS target_share,
    CASE WHEN d.team_dropbacks > 0 THEN s.targets / d.team_dropbacks END AS targets_per_dropback
  FROM player_stats s LEFT JOIN game_ids g ON s.season = g.season AND s.week = g.week AND s.team = g.team
    LEFT JOIN team_stats t ON s.season = t.season AND s.week = t.week AND s.team = t.team
    LEFT JOIN dropbacks d ON s.season = d.season AND s.week = d.week AND s.team = d.team
  WHERE s.targets > 0)"""
RECEIVING_REPORT = (
    "SELECT *, target_share - lag(target_share) OVER (PARTITION BY pfr_player_id, team, season ORDER BY week, game_id) "
        "AS wow_target_share_change FROM joined"
)

ORACLES: dict[str, str] = {
    "snap_grid": _sql(_SNAPS, GRID, "SELECT * FROM grid"),
    "snap_share_report": _sql(_SNAPS, SNAP_REPORT, "SELECT * FROM snap_report"),
    "snap_first_appearance": _sql(
        _SNAPS,
        SNAP_REPORT,
        "SELECT season, week, player, team, offense_snap_share, wow_offense_snap_share_change "
        "FROM snap_report WHERE wow_offense_snap_share_change IS NULL",
    ),
    "snap_regular_qbs": _sql(
        _SNAPS, SNAP_REPORT + "," + REGULAR_QBS, "SELECT * FROM regular " + TOP_OF_SEASON.format(top=5)
    ),
    "snap_progression": _sql(
        _SNAPS,
        SNAP_REPORT + "," + REGULAR_QBS,
        "SELECT r.season, r.week, r.player, r.team, r.offense_snaps, r.offense_snap_share, r.wow_offense_snap_share_change "
        f"FROM snap_report r JOIN (SELECT * FROM regular {TOP_OF_SEASON.format(top=1)}) b "
        "ON r.season = b.season AND r.player = b.player AND r.team = b.team",
    ),
    "duplicate_keys": _sql(
        _SNAPS,
        SNAP_REPORT,
        "SELECT season, week, team, pfr_player_id, count(*) AS copies FROM snap_report "
        "GROUP BY season, week, team, pfr_player_id HAVING count(*) > 1",
    ),
    "snap_names_filled": _sql(_SNAPS, NAMES_LOST, NAMES_FILLED),
    "duplicate_report_keys": _sql(
        OPPORTUNITY_TABLES,
        OPPORTUNITY,
        "SELECT season, week, team, gsis_id, count(*) AS copies FROM report WHERE gsis_id IS NOT NULL "
        "GROUP BY season, week, team, gsis_id HAVING count(*) > 1",
    ),
    "team_dropbacks": _sql(_PLAYS, DROPBACKS, "SELECT * FROM dropbacks"),
    "team_game_ids": _sql(_PLAYS, GAME_IDS, "SELECT * FROM game_ids"),
    "receiving_report": _sql(("plays", "player_stats", "team_stats"), RECEIVING_ROWS, RECEIVING_REPORT),
    "receiving_other_spellings": _sql(
        ("plays", "player_stats", "team_stats"), RECEIVING_ROWS.replace("s.opponent_team AS opponent", "'' AS opponent"), RECEIVING_REPORT
    ),
    "team_passing_totals": _sql(_STATS, QB_ROWS, "SELECT * FROM totals"),
    "qb_play_metrics": _sql(_PLAYS, QB_METRICS, "SELECT * FROM metrics"),
    "qb_efficiency": _sql(_STATS, QB_ROWS, _QB_EFFICIENCY),
    "passer_rating": _sql(
        _STATS, QB_ROWS, f"SELECT season, week, pfr_player_id, team, attempts, {RATING} AS passer_rating FROM qb"
    ),
    "qb_fantasy": _sql(
        _STATS,
        QB_ROWS,
        f"SELECT season, week, pfr_player_id, team, {QB_POINTS} AS fantasy_points_standard, "
        f"{QB_POINTS} AS fantasy_points_ppr FROM qb",
    ),
    "qb_change": _sql(
        _STATS,
        QB_REPORT,
        "SELECT season, week, pfr_player_id, team, wow_yards_change, wow_td_change, wow_epa_change FROM qb_report",
    ),
    "qb_report": _sql(_STATS, QB_REPORT, f"SELECT {_QB_COLUMNS} FROM qb_report"),
    "qb_other_spellings": _sql(
        _STATS, QB_REPORT.replace("opponent_team AS opponent", "'' AS opponent"), f"SELECT {_QB_COLUMNS} FROM qb_report"
    ),
    "qb_without_plays": _sql(
        _STATS,
        QB_REPORT,
        f"SELECT {_QB_COLUMNS} FROM qb_report".replace("game_id", "'' AS game_id")
        .replace("wow_epa_change", "CAST(NULL AS DOUBLE) AS wow_epa_change")
        .replace(
            "epa_per_dropback, success_rate, cpoe, air_yards_per_attempt, big_play_rate, pressure_rate",
            ", ".join(
                f"CAST(NULL AS DOUBLE) AS {m}"
                for m in ("epa_per_dropback", "success_rate", "cpoe", "air_yards_per_attempt", "big_play_rate", "pressure_rate")
            ),
        ),
    ),
    "player_profile": _sql(
        ("players",),
        "",
        "SELECT gsis_id, pfr_id, display_name AS player_name, position, draft_year, draft_round, draft_ovr AS draft_pick, "
        "height AS player_height, weight AS player_weight FROM players",
    ),
    "snap_with_ids": _sql(
        ("snap_counts", "players"), SNAP_IDS, "SELECT * EXCLUDE (player_key) FROM snap_ids"
    ),
    "team_targets": _sql(_PLAYS, TARGETS, "SELECT * FROM team_targets"),
    "passing_by_game": _sql(_PLAYS, PASSING, "SELECT * FROM passing"),
    "receiving_by_game": _sql(_PLAYS, RECEIVING, "SELECT * FROM receiving"),
    "rushing_by_game": _sql(_PLAYS, RUSHING, "SELECT * FROM rushing"),
    "player_game_stats": _sql(_PLAYS, STATS, "SELECT * FROM stats"),
    "game_opponents": _sql(_PLAYS, OPPONENTS, "SELECT * FROM opponents"),
    "opponent_filled": _sql(
        ("snap_counts", "plays"),
        OPPONENTS,
        "SELECT s.game_id, s.season, s.week, s.pfr_player_id, s.team, "
        "CASE WHEN s.opponent IS NULL OR s.opponent = '' THEN o.opponent ELSE s.opponent END AS opponent "
        "FROM snap_counts s LEFT JOIN opponents o ON o.game_id = s.game_id AND o.team = s.team",
    ),
    "nextgen_joined": _sql(
        ("snap_counts", "players", "plays", "tracking_passing", "tracking_receiving", "tracking_rushing"),
        SNAP_IDS,
        f"SELECT s.player_key, s.season, s.week, s.team, {PASSING_METRICS}, {RECEIVING_METRICS}, {RUSHING_METRICS} "
        f"FROM snap_ids s {_tracking_joins('s')}",
    ),
    "nextgen_absent": _sql(
        ("snap_counts", "players"),
        SNAP_IDS,
        "SELECT s.player_key, s.season, s.week, s.team, "
        + ", ".join(f"CAST(NULL AS DOUBLE) AS {m.split(' AS ')[-1].split('.')[-1]}" for m in ", ".join((PASSING_METRICS, RECEIVING_METRICS, RUSHING_METRICS)).split(", "))
        + " FROM snap_ids s",
    ),
    "fantasy_points_configured": _sql(
        _PLAYS,
        STATS,
        f"SELECT game_id, season, week, gsis_id, team, {POINTS.replace('0.5', '1')} AS fantasy_points FROM stats",
    ),
    "combine_by_player": _sql(("players", "combine"), COMBINE_BY_PLAYER, "SELECT * FROM measured"),
    "fantasy_points": _sql(
        _PLAYS, STATS, f"SELECT game_id, season, week, gsis_id, team, {POINTS} AS fantasy_points FROM stats"
    ),
    "position_rank": _sql(
        ("snap_counts", "players", "plays"),
        STATS + "," + SNAP_IDS + f""",
scored AS (SELECT s.season, s.week, p.position, s.player_key, s.team, s.offense_snaps, {POINTS} AS fantasy_points
  FROM snap_ids s LEFT JOIN players p ON p.gsis_id = s.gsis_id
    LEFT JOIN stats x ON x.gsis_id = s.gsis_id AND x.season = s.season AND x.week = s.week AND x.team = s.team
      AND x.game_id = s.game_id)""",
        "SELECT * EXCLUDE (rnk), CASE WHEN coalesce(offense_snaps, 0) >= 1 THEN CAST(rnk AS INTEGER) END AS f_position_rank "
        "FROM (SELECT *, dense_rank() OVER (PARTITION BY season, week, position ORDER BY fantasy_points DESC) AS rnk FROM scored) r",
    ),
    "opportunity_report": _sql(OPPORTUNITY_TABLES, OPPORTUNITY, "SELECT * EXCLUDE (rnk) FROM report"),
    "opportunity_from_facts": _sql(OPPORTUNITY_TABLES, OPPORTUNITY, "SELECT * EXCLUDE (rnk) FROM report"),
    "skill_regulars": _sql(OPPORTUNITY_TABLES, REGULARS, "SELECT * FROM regulars"),
    "player_order": _sql(
        OPPORTUNITY_TABLES, PLAYER_ORDER, "SELECT *, player_name AS composite_label FROM ordered"
    ),
    "snap_matrix": _sql(
        OPPORTUNITY_TABLES,
        CELLS + ",\nstacked AS ("
        + " UNION ALL ".join(
            f"SELECT season, '{m}' AS measure, row_index, player_name, team, position, week, {m} AS value FROM cells"
            for m in _MEASURES
        )
        + ")",
        f"SELECT season, measure, row_index, player_name, team, position, {_WEEK_COLUMNS} FROM stacked "
        "GROUP BY season, measure, row_index, player_name, team, position",
    ),
    "metric_rows": _sql(OPPORTUNITY_TABLES, METRIC_ROWS, "SELECT * FROM metric_rows"),
    "cell_intensity": _sql(
        OPPORTUNITY_TABLES,
        METRIC_ROWS + """,
tops AS (SELECT season, metric, max(value) AS top FROM metric_rows GROUP BY season, metric),
scaled AS (SELECT r.season, r.row_index, r.player_name, r.metric, r.week, r.value,
    CASE r.metric WHEN 'targets' THEN CASE WHEN coalesce(top, 0) = 0 THEN 15 ELSE top END
      WHEN 'avg_yac' THEN CASE WHEN coalesce(top, 0) = 0 THEN 10 ELSE top END
      WHEN 'rush_first_downs' THEN CASE WHEN coalesce(top, 0) = 0 THEN 5 ELSE top END
      WHEN 'receiving_first_downs' THEN CASE WHEN coalesce(top, 0) = 0 THEN 5 ELSE top END END AS scale_maximum
  FROM metric_rows r JOIN tops USING (season, metric))""",
        """SELECT *, CASE WHEN value IS NULL THEN NULL
    WHEN metric = 'offense_snap_share' THEN value
    WHEN metric = 'completion_percentage' THEN greatest(least((value - 40) / 60, 1), 0)
    ELSE least(value / scale_maximum, 1) END AS intensity FROM scaled""",
    ),
    "cell_labels": _sql(
        OPPORTUNITY_TABLES,
        METRIC_ROWS,
        """SELECT season, row_index, player_name, metric, week, value,
    CASE metric WHEN 'targets' THEN CAST(CAST(trunc(value) AS BIGINT) AS VARCHAR)
      WHEN 'rush_first_downs' THEN CAST(CAST(trunc(value) AS BIGINT) AS VARCHAR)
      WHEN 'receiving_first_downs' THEN CAST(CAST(trunc(value) AS BIGINT) AS VARCHAR)
      WHEN 'avg_yac' THEN printf('%.1f', value)
      WHEN 'completion_percentage' THEN printf('%.0f', value) || '%'
      ELSE printf('%.0f', value * 100) || '%' END AS text,
    value > CASE metric WHEN 'targets' THEN 5 WHEN 'avg_yac' THEN 5 WHEN 'rush_first_downs' THEN 2
      WHEN 'receiving_first_downs' THEN 2 WHEN 'completion_percentage' THEN 65 ELSE 0.5 END AS high
  FROM metric_rows WHERE value IS NOT NULL""",
    ),
    "group_boundaries": _sql(
        OPPORTUNITY_TABLES,
        PLAYER_ORDER + f""",
walked AS (SELECT season, team, position, expanded_index, {EXTRA_ROWS} AS extra,
    lag(team) OVER w AS prev_team, lag(position) OVER w AS prev_position, lead(team) OVER w AS next_team
  FROM ordered WINDOW w AS (PARTITION BY season ORDER BY row_index))""",
        """SELECT season, expanded_index - CAST(0.5 AS DOUBLE) AS line_at, 'team' AS kind, prev_team AS team_label
  FROM walked WHERE prev_team IS NOT NULL AND prev_team <> team
  UNION ALL SELECT season, expanded_index - CAST(0.5 AS DOUBLE), 'position', NULL
  FROM walked WHERE prev_team = team AND prev_position <> position
  UNION ALL SELECT season, expanded_index + extra + CAST(0.5 AS DOUBLE), 'end', team FROM walked WHERE next_team IS NULL""",
    ),
    "rushing_leaders": _sql(
        ("plays", "players"),
        RUNS,
        "SELECT rank, rusher_player_id, name, position, rush_attempt, ypa, games_played, tds, tds_per_attempt "
        "FROM rush_ranked ORDER BY rush_attempt DESC, rusher_player_id LIMIT 50",
    ),
    "rushing_ranks": _sql(("plays", "players"), RUNS, "SELECT * FROM rush_ranked"),
    "rushing_by_week": _sql(
        ("plays", "players"),
        RUNS,
        "SELECT rusher_player_id, name, position, CAST(split_part(game_id, '_', 2) AS INTEGER) AS week, "
        "count(*) AS attempts, coalesce(sum(rushing_yards), 0) AS rushing_yards "
        "FROM runs GROUP BY rusher_player_id, name, position, CAST(split_part(game_id, '_', 2) AS INTEGER)",
    ),
}
