"""DuckDB oracle SQL for the registered queries.

Each query's oracle re-derives its answer from the raw tables with plain
SQL (written independently of the Spark plan: joins by first order instead
of ``min_by``, per-lineitem averages instead of sums of sums, windows where
the Spark side uses keyed joins) so that agreement is evidence, not echo.
Double outputs are rounded to 6 decimals on both sides.
"""

from __future__ import annotations

# FIXED VALUES mirrored from pitwall.sources.rig.RIG_RAIN_TOKENS
_RAIN_LIST = ("['rain','yes','raining','norain','no','no rain','no_rain','0','1',"
              "'false','true','light rain','drizzle','1.0',NULL]")


def _lap(p: str, ok: str, line: int) -> str:
    ms = f"(75000 + (CAST(floor({p} * 100) AS BIGINT) % 45000))"
    txt = (f"CAST(CAST(floor({ms} / 60000.0) AS BIGINT) AS VARCHAR) || ':' || "
           f"lpad(CAST(CAST(floor(({ms} % 60000) / 1000.0) AS BIGINT) AS VARCHAR), 2, '0') || '.' || "
           f"lpad(CAST({ms} % 1000 AS VARCHAR), 3, '0')")
    if line == 3:
        txt = f"CASE WHEN {ok} % 17 = 0 THEN 'DNF' ELSE {txt} END"
    if line == 2:
        txt = f"CASE WHEN {ok} % 17 = 1 THEN '' ELSE {txt} END"
    return f"CASE WHEN {p} IS NULL THEN NULL ELSE {txt} END"


def timedelta_sql(x: str) -> str:
    ms = f"CAST(floor({x} * 1000) AS BIGINT)"
    def part(div, mod=None):
        inner = f"({ms} % {mod})" if mod else ms
        return f"lpad(CAST(CAST(floor({inner} / {div}.0) AS BIGINT) AS VARCHAR), 2, '0')"
    return (f"CAST(CAST(floor({ms} / 86400000.0) AS BIGINT) AS VARCHAR) || ' days ' || "
            f"{part(3600000, 86400000)} || ':' || {part(60000, 3600000)} || ':' || {part(1000, 60000)}"
            f" || '.' || lpad(CAST(({ms} % 1000) * 1000 AS VARCHAR), 6, '0')")


def timedelta_parse_sql(x: str) -> str:
    r = "'^\\s*(-?\\d+) days?\\s*\\+?(\\d+):(\\d+):(\\d+(?:\\.\\d+)?)\\s*$'"
    g = [f"CAST(regexp_extract({x}, {r}, {i}) AS DOUBLE)" for i in (1, 2, 3, 4)]
    return (f"(CASE WHEN regexp_matches({x}, {r}) THEN "
            f"{g[0]} * 86400.0 + {g[1]} * 3600.0 + {g[2]} * 60.0 + {g[3]} END)")


def rig_ctes(grain: str = "nation") -> str:
    """CTEs ``ord, ent, wx, rig`` — the raw race-entry table (``rig``)."""
    driver = "c.c_nationkey" if grain == "nation" else "o.o_custkey"
    return f"""
ord AS (
  SELECT o.o_orderkey, o.o_orderstatus, o.o_totalprice, c.c_nationkey,
         CAST(year(o.o_orderdate) AS BIGINT) AS Season,
         CAST(month(o.o_orderdate) AS BIGINT) AS Round,
         CAST({driver} AS BIGINT) AS DriverNumber
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
ent AS (
  SELECT Season, Round, DriverNumber, c_nationkey AS team_key,
         CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / 997.0 AS FinishTime_s,
         MIN(o_orderkey) AS first_order, COUNT(*) AS Laps
  FROM ord GROUP BY Season, Round, DriverNumber, c_nationkey),
lq AS (
  SELECT e.Season, e.Round, e.DriverNumber,
         MIN(CASE WHEN l.l_linenumber = 1 THEN l.l_extendedprice END) AS p1,
         MIN(CASE WHEN l.l_linenumber = 2 THEN l.l_extendedprice END) AS p2,
         MIN(CASE WHEN l.l_linenumber = 3 THEN l.l_extendedprice END) AS p3
  FROM ent e JOIN lineitem l ON l.l_orderkey = e.first_order
  GROUP BY e.Season, e.Round, e.DriverNumber),
wx AS (
  SELECT d.Season, d.Round,
         10.0 + AVG(l.l_quantity) / 2.0 AS AirTemp_C,
         10.0 + AVG(l.l_quantity) / 2.0 + AVG(l.l_discount) * 100.0 AS TrackTemp_C,
         20.0 + AVG(l.l_tax) * 1000.0 AS "Humidity_%",
         990.0 + AVG(l.l_discount) * 400.0 AS Pressure_hPa,
         AVG(l.l_quantity) / 10.0 AS WindSpeed_mps,
         CAST(((d.Season * 100 + d.Round) * 37) % 360 AS DOUBLE) AS WindDirection_deg,
         AVG(CASE WHEN l.l_returnflag = 'R' THEN 1.0 ELSE 0.0 END) AS SOFT,
         AVG(CASE WHEN l.l_returnflag = 'A' THEN 1.0 ELSE 0.0 END) AS MEDIUM,
         AVG(CASE WHEN l.l_returnflag = 'N' AND l.l_linestatus = 'O' THEN 1.0 ELSE 0.0 END) AS HARD,
         AVG(CASE WHEN l.l_returnflag = 'N' AND l.l_linestatus = 'F' THEN 1.0 ELSE 0.0 END) AS INTERMEDIATE,
         AVG(CASE WHEN l.l_discount >= 0.09 THEN 1.0 ELSE 0.0 END) AS WET,
         {_RAIN_LIST}[CAST(((d.Season * 100 + d.Round) % 15) + 1 AS INTEGER)] AS Rain
  FROM ord d JOIN lineitem l ON l.l_orderkey = d.o_orderkey
  GROUP BY d.Season, d.Round),
rig AS (
  SELECT e.Season, e.Round, e.DriverNumber,
         'drv_' || CAST(e.DriverNumber AS VARCHAR) AS DriverId,
         upper(substr(n.n_name, 1, 1)) || lower(substr(n.n_name, 2, 100)) || 'Racer'
           || upper(substr(n.n_name, 1, 3)) AS Driver,
         n.n_name AS TeamName,
         CASE WHEN fo.o_orderstatus = 'F' THEN 'Finished'
              WHEN fo.o_orderstatus = 'P' THEN 'Lapped'
              WHEN e.first_order % 2 = 1 THEN 'Retired' END AS Status,
         e.FinishTime_s, {timedelta_sql('e.FinishTime_s')} AS Time, e.first_order, e.Laps,
         row_number() OVER (PARTITION BY e.Season, e.Round ORDER BY e.FinishTime_s, e.DriverNumber) AS Position,
         row_number() OVER (PARTITION BY e.Season, e.Round ORDER BY e.first_order, e.DriverNumber) AS GridPosition,
         {_lap('lq.p1', 'e.first_order', 1)} AS Q1,
         {_lap('lq.p2', 'e.first_order', 2)} AS Q2,
         {_lap('lq.p3', 'e.first_order', 3)} AS Q3,
         wx.AirTemp_C, wx.TrackTemp_C, wx."Humidity_%", wx.Pressure_hPa, wx.WindSpeed_mps,
         wx.WindDirection_deg, wx.SOFT, wx.MEDIUM, wx.HARD, wx.INTERMEDIATE, wx.WET, wx.Rain
  FROM ent e
  JOIN nation n ON n.n_nationkey = e.team_key
  JOIN ord fo ON fo.o_orderkey = e.first_order
  JOIN wx ON wx.Season = e.Season AND wx.Round = e.Round
  LEFT JOIN lq ON lq.Season = e.Season AND lq.Round = e.Round AND lq.DriverNumber = e.DriverNumber),
rigp AS (
  SELECT *, CAST(COALESCE([25,18,15,12,10,8,6,4,2,1][CAST(Position AS INTEGER)], 0) AS DOUBLE) AS Points
  FROM rig)"""


def p1_sql(x: str) -> str:
    """Oracle form of quali_time_to_seconds."""
    a = f"TRY_CAST(split_part({x}, ':', 1) AS DOUBLE)"
    b = f"TRY_CAST(split_part({x}, ':', 2) AS DOUBLE)"
    return (f"(CASE WHEN {x} IS NULL OR {x} = '' THEN 0.0 "
            f"WHEN len(string_split({x}, ':')) = 2 AND {a} IS NOT NULL AND {b} IS NOT NULL "
            f"THEN {a} * 60 + {b} ELSE 0.0 END)")


def p2_sql(x: str) -> str:
    """Oracle form of clean_driver_name (ASCII data)."""
    s = f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"
    s = f"regexp_replace({s}, '([a-z])([A-Z])', '\\1 \\2', 'g')"
    s = f"regexp_replace({s}, '\\b[A-Z]{{2,4}}$', '')"
    s = f"regexp_replace({s}, '^\\s+|\\s+$', '', 'g')"
    return f"regexp_replace({s}, '\\s+', ' ', 'g')"


def p3_sql(q1: str, q2: str, q3: str) -> str:
    lst = f"list_filter([{q1}, {q2}, {q3}], lambda t: t IS NOT NULL AND t <> '')"
    tr = f"list_transform({lst}, lambda t: {p1_sql('t')})"
    return (f"(CASE WHEN len({lst}) > 0 THEN "
            f"list_reduce(list_prepend(0.0, {tr}), lambda acc, v: acc + v) / len({lst}) END)")


def rain_sql(x: str) -> str:
    s = f"lower(trim(CAST({x} AS VARCHAR)))"
    return (f"(CASE WHEN {s} IN ('rain','yes','raining','1','true') THEN 1 "
            f"WHEN {s} IN ('norain','no','no rain','no_rain','0','false') THEN 0 "
            f"WHEN contains({s}, 'rain') THEN 1 ELSE 0 END)")


def features_ctes(grain: str = "nation") -> str:
    """CTEs through ``feat`` — the race feature table."""
    return "WITH " + rig_ctes(grain) + f""",
f1 AS (
  SELECT * REPLACE ({p2_sql('Driver')} AS Driver), Driver AS DriverRaw,
         {timedelta_parse_sql('Time')} AS ParsedTime_s,
         {p3_sql('Q1', 'Q2', 'Q3')} AS AvgQualiTime,
         CAST(Round AS DOUBLE) - 1.0 AS races_prior_this_season,
         COALESCE(SUM(Points) OVER (PARTITION BY Season, DriverId ORDER BY Round, DriverNumber
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS _cum,
         FinishTime_s - AVG(FinishTime_s) OVER (PARTITION BY Season, Round) AS DeviationFromAvg_s,
         FinishTime_s - LAG(FinishTime_s) OVER (PARTITION BY Season, Round ORDER BY Position) AS DeltaFromAhead_s
  FROM rigp),
feat AS (
  SELECT * EXCLUDE (_cum, Rain),
         CASE WHEN races_prior_this_season * 25.0 > 0
              THEN greatest(0.0, least(1.0, _cum / (races_prior_this_season * 25.0))) ELSE 0.0 END AS PointsProp,
         LAG(DeviationFromAvg_s) OVER (PARTITION BY DriverId ORDER BY Season, Round, DriverNumber) AS DeviationFromAvg_s_last1,
         AVG(DeviationFromAvg_s) OVER (PARTITION BY DriverId ORDER BY Season, Round, DriverNumber
              ROWS BETWEEN 2 PRECEDING AND 1 PRECEDING) AS DeviationFromAvg_s_last2,
         AVG(DeviationFromAvg_s) OVER (PARTITION BY DriverId ORDER BY Season, Round, DriverNumber
              ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) AS DeviationFromAvg_s_last5,
         AVG(DeviationFromAvg_s) OVER (PARTITION BY DriverId, Season ORDER BY Round, DriverNumber
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS DeviationFromAvg_s_season_to_date,
         {rain_sql('Rain')} AS Rain, Rain AS RainRaw
  FROM f1)"""
