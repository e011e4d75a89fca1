"""Scalar-function queries (P1-P21) over the race feature table.

Each query reads the whole feature table (built from the full orders /
lineitem / customer / nation tables) or the events table and applies the
column expression under test; the oracle applies the same rule in SQL.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from pitwall import constants as K
from pitwall.functions import scalars as S
from pitwall.operators import aggregates as A
from pitwall.operators.ranking import row_number_within
from pitwall.oracles import features_ctes, p1_sql, p2_sql
from pitwall.plans.features import race_table
from pitwall.plans.registry import query
from pitwall.sources.rig import read_table

FEAT = features_ctes("customer")
KEYS = ["Season", "Round", "DriverNumber"]
KEY_SQL = "Season, Round, DriverNumber"


def feat(spark, sf):
    return race_table(spark, sf, "customer")


# ---------------------------------------------------------------- P1-P3
@query("P1_quali_time_to_seconds", sql=FEAT + f"""
SELECT {KEY_SQL}, Q1, Q2, Q3, {p1_sql('Q1')} AS Q1_s, {p1_sql('Q2')} AS Q2_s, {p1_sql('Q3')} AS Q3_s
FROM feat""")
def p1(spark, sf):
    return feat(spark, sf).select(*KEYS, "Q1", "Q2", "Q3",
                                  *[S.quali_time_to_seconds(q).alias(f"{q}_s") for q in ("Q1", "Q2", "Q3")])


# Edge variants derived from each row's raw name: padded, lower-cased (no
# code to strip), two-letter code only ('NA' -> '').
_P2_VARIANTS_SQL = """
  SELECT Season, Round, DriverNumber, 'raw' AS variant, DriverRaw AS name FROM feat UNION ALL
  SELECT Season, Round, DriverNumber, 'padded', '  ' || DriverRaw || ' ' FROM feat UNION ALL
  SELECT Season, Round, DriverNumber, 'lower', lower(DriverRaw) FROM feat UNION ALL
  SELECT Season, Round, DriverNumber, 'code', upper(substr(TeamName, 1, 2)) FROM feat"""


@query("P2_clean_driver_name", sql=FEAT + f""", v AS ({_P2_VARIANTS_SQL})
SELECT {KEY_SQL}, variant, name, {p2_sql('name')} AS clean FROM v""")
def p2(spark, sf):
    f = feat(spark, sf)
    variants = [("raw", F.col("DriverRaw")),
                ("padded", F.concat(F.lit("  "), F.col("DriverRaw"), F.lit(" "))),
                ("lower", F.lower("DriverRaw")),
                ("code", F.upper(F.substring("TeamName", 1, 2)))]
    v = f.select(*KEYS, F.explode(F.array(*[
        F.struct(F.lit(n).alias("variant"), c.alias("name")) for n, c in variants])).alias("_v"))
    v = v.select(*KEYS, "_v.variant", "_v.name")
    return v.withColumn("clean", S.clean_driver_name("name"))


@query("P3_avg_quali_time", sql=FEAT + f"""
SELECT {KEY_SQL}, round(AvgQualiTime, 6) AS AvgQualiTime FROM feat""")
def p3(spark, sf):
    return feat(spark, sf).select(*KEYS, F.round("AvgQualiTime", 6).alias("AvgQualiTime"))


# ------------------------------------------------------------------- P4
@query("P4_timedelta_to_seconds", sql=FEAT + f"""
SELECT {KEY_SQL}, Time, round(ParsedTime_s, 6) AS ParsedTime_s,
       round(ParsedTime_s - FinishTime_s, 6) AS parse_error_s FROM feat""")
def p4(spark, sf):
    f = feat(spark, sf)
    parsed = S.timedelta_to_seconds("Time")
    return f.select(*KEYS, "Time", F.round(parsed, 6).alias("ParsedTime_s"),
                    F.round(parsed - F.col("FinishTime_s"), 6).alias("parse_error_s"))


# ------------------------------------------------------------------- P5
def pit_durations(spark, sf):
    """Consecutive events per user = pit in / pit out.  The 'next event'
    is a keyed self-join on a skew-safe per-user rank (a user may hold a
    third of all events), not a per-user window."""
    ev = read_table(spark, sf, "events").select("event_id", "user_id", "ts")
    ranked = row_number_within(ev, ["user_id"], ["ts", "event_id"], out="seq")
    nxt = ranked.select(F.col("user_id").alias("_u"), (F.col("seq") - 1).alias("_s"), F.col("ts").alias("ts_out"))
    return (ranked.join(nxt, ranked["user_id"].eqNullSafe(nxt["_u"]) & (ranked["seq"] == nxt["_s"]), "left")
                  .select("event_id", "user_id", "seq",
                          S.duration_seconds("ts", "ts_out").alias("pit_s")))


_PIT_SQL = """
pit AS (
  SELECT event_id, user_id,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS seq,
         (epoch_us(LEAD(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)) - epoch_us(ts)) / 1e6 AS pit_s
  FROM events)"""


@query("P5_pit_stop_seconds", sql=f"WITH {_PIT_SQL} SELECT event_id, user_id, seq, round(pit_s, 6) AS pit_s FROM pit")
def p5(spark, sf):
    return pit_durations(spark, sf).withColumn("pit_s", F.round("pit_s", 6))


@query("A14_mean_duration_by_driver", sql=f"""WITH {_PIT_SQL}
SELECT user_id, round(AVG(CAST(round(pit_s * 1e6) AS BIGINT)) / 1e6, 6) AS mean_pit_s,
       COUNT(pit_s) AS n_stops FROM pit
WHERE pit_s IS NOT NULL GROUP BY user_id""")
def a14(spark, sf):
    # average exact integer microseconds: order-independent, so every
    # partitioning of the sum gives the same answer
    p = pit_durations(spark, sf).filter(F.col("pit_s").isNotNull())
    us = F.round(F.col("pit_s") * 1e6).cast("bigint")
    return p.groupBy("user_id").agg(F.round(F.avg(us) / 1e6, 6).alias("mean_pit_s"),
                                    F.count("pit_s").alias("n_stops"))


# ---------------------------------------------------------------- P6/P7
_RAIN_TOK = "lower(trim(CAST(RainRaw AS VARCHAR)))"


@query("P6_rain_normalize", sql=FEAT + f"""
SELECT DISTINCT Season, Round, RainRaw, Rain AS rain_tokens,
       CASE WHEN contains({_RAIN_TOK}, 'rain') THEN 1 ELSE 0 END AS rain_contains,
       CASE WHEN {_RAIN_TOK} IN ('rain','yes','raining','1') THEN 1 ELSE 0 END AS rain_strict
FROM feat""")
def p6(spark, sf):
    f = feat(spark, sf)
    return f.select("Season", "Round", "RainRaw",
                    S.normalize_rain("RainRaw").alias("rain_tokens"),
                    S.normalize_rain("RainRaw", "contains").alias("rain_contains"),
                    S.normalize_rain("RainRaw", "strict").alias("rain_strict")).distinct()


# ------------------------------------------------------------------- P8
@query("P8_safe_numeric", sql="""
SELECT event_id,
       COALESCE(TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE), 0.0) AS k_num,
       COALESCE(TRY_CAST(event_type AS DOUBLE), 0.0) AS type_num,
       COALESCE(TRY_CAST(value AS DOUBLE), 0.0) AS value_num
FROM events""")
def p8(spark, sf):
    ev = read_table(spark, sf, "events")
    return ev.select("event_id",
                     S.safe_number(F.get_json_object("props", "$.k")).alias("k_num"),
                     S.safe_number("event_type").alias("type_num"),
                     S.safe_number("value").alias("value_num"))


# ------------------------------------------------------------------- P9
@query("P9_wind_sin_cos", sql=FEAT + """
SELECT DISTINCT Season, Round, round(sin(radians(COALESCE(WindDirection_deg, 0))), 6) AS WindDir_sin,
       round(cos(radians(COALESCE(WindDirection_deg, 0))), 6) AS WindDir_cos FROM feat""")
def p9(spark, sf):
    return feat(spark, sf).select(
        "Season", "Round", F.round(S.wind_sin("WindDirection_deg"), 6).alias("WindDir_sin"),
        F.round(S.wind_cos("WindDirection_deg"), 6).alias("WindDir_cos")).distinct()


# ------------------------------------------------------------- P11/A20
RARE_MIN_COUNT = 20
_RARE_SQL = f"""
rare AS (
  SELECT 'Laps' AS "column", v AS value, COUNT(*) AS count
  FROM (SELECT COALESCE(CAST(Laps AS VARCHAR), 'missing') AS v FROM feat) GROUP BY v
  UNION ALL
  SELECT 'Status', v, COUNT(*)
  FROM (SELECT COALESCE(Status, 'missing') AS v FROM feat) GROUP BY v)"""


def _cat(f):
    return f.withColumn("Laps", F.col("Laps").cast("string"))


@query("A20_rare_categories", sql=FEAT + f", {_RARE_SQL} SELECT * FROM rare WHERE count < {RARE_MIN_COUNT}")
def a20(spark, sf):
    return A.rare_categories(_cat(feat(spark, sf)), ["Laps", "Status"], RARE_MIN_COUNT)


@query("P11_rare_category_mapping", sql=FEAT + f", {_RARE_SQL}" + f"""
SELECT {KEY_SQL}, CASE WHEN r.value IS NOT NULL THEN 'OTHER' ELSE COALESCE(CAST(f.Laps AS VARCHAR), 'missing') END AS Laps
FROM feat f LEFT JOIN (SELECT value FROM rare WHERE "column" = 'Laps' AND count < {RARE_MIN_COUNT}) r
  ON r.value = COALESCE(CAST(f.Laps AS VARCHAR), 'missing')""")
def p11(spark, sf):
    from pitwall.operators.joins import map_rare_join
    f = _cat(feat(spark, sf))
    rare = A.rare_categories(f, ["Laps"], RARE_MIN_COUNT)
    return map_rare_join(f, rare, "Laps").select(*KEYS, "Laps")


@query("A16_replacement_counts", sql=FEAT + f", {_RARE_SQL}" + f"""
SELECT CAST(SUM(CASE WHEN r.value IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS Laps
FROM feat f LEFT JOIN (SELECT value FROM rare WHERE "column" = 'Laps' AND count < {RARE_MIN_COUNT}) r
  ON r.value = COALESCE(CAST(f.Laps AS VARCHAR), 'missing')""")
def a16(spark, sf):
    from pitwall.operators.joins import map_rare_join
    f = _cat(feat(spark, sf))
    rare = A.rare_categories(f, ["Laps"], RARE_MIN_COUNT)
    mapped = map_rare_join(f, rare, "Laps", flag="_replaced")
    return A.replacement_counts(mapped, {"Laps": F.col("_replaced")})


# ---------------------------------------------------------- P12/P13/P16
_LABELS_SQL = """
CASE WHEN AirTemp_C >= 30 THEN 'hot' WHEN AirTemp_C >= 20 THEN 'warm' WHEN AirTemp_C >= 10 THEN 'mild' ELSE 'cool' END AS temp_label,
CASE WHEN "Humidity_%" >= 80 THEN 'very humid' WHEN "Humidity_%" >= 60 THEN 'humid'
     WHEN "Humidity_%" >= 30 THEN 'moderate humidity' ELSE 'dry' END AS humidity_label"""


@query("P12_weather_labels", sql=FEAT + f"SELECT DISTINCT Season, Round, {_LABELS_SQL} FROM feat")
def p12(spark, sf):
    return feat(spark, sf).select("Season", "Round", S.air_temp_label("AirTemp_C").alias("temp_label"),
                                  S.humidity_label("Humidity_%").alias("humidity_label")).distinct()


_TYRE_SQL = """CASE GREATEST(SOFT, MEDIUM, HARD, INTERMEDIATE, WET)
  WHEN SOFT THEN 'SOFT' WHEN MEDIUM THEN 'MEDIUM' WHEN HARD THEN 'HARD'
  WHEN INTERMEDIATE THEN 'INTERMEDIATE' ELSE 'WET' END"""


@query("P13_dominant_tyre", sql=FEAT + f"SELECT DISTINCT Season, Round, {_TYRE_SQL} AS dominant_tyre FROM feat")
def p13(spark, sf):
    return feat(spark, sf).select("Season", "Round", S.argmax_name(K.TYRES).alias("dominant_tyre")).distinct()


@query("P16_tyre_one_hot", sql=FEAT + f"""
SELECT Season, Round, t,
       CAST(t = 'SOFT' AS INTEGER) AS SOFT, CAST(t = 'MEDIUM' AS INTEGER) AS MEDIUM,
       CAST(t = 'HARD' AS INTEGER) AS HARD, 0 AS INTERMEDIATE, 0 AS WET
FROM (SELECT DISTINCT Season, Round, {_TYRE_SQL} AS t FROM feat)""")
def p16(spark, sf):
    races = feat(spark, sf).select("Season", "Round", S.argmax_name(K.TYRES).alias("t")).distinct()
    return races.select("Season", "Round", "t",
                        *[S.tyre_flag("t", ty).alias(ty) for ty in K.SELECTABLE_TYRES],
                        F.lit(0).alias("INTERMEDIATE"), F.lit(0).alias("WET"))


# ------------------------------------------------------------------ P17
_P17_SQL = """
names AS (
  SELECT DISTINCT 'cat__TeamName_' || TeamName AS name FROM feat UNION ALL
  SELECT DISTINCT 'cat__Status_' || COALESCE(Status, 'missing') FROM feat UNION ALL
  SELECT DISTINCT 'num__' || CAST(Laps AS VARCHAR) FROM feat UNION ALL
  SELECT DISTINCT 'plain_' || CAST(Round AS VARCHAR) FROM feat)"""


@query("P17_feature_name_mapping", sql=FEAT + f""", {_P17_SQL}
SELECT name, CASE WHEN starts_with(name, 'num__') THEN substr(name, 6)
  WHEN starts_with(name, 'cat__') THEN regexp_replace(substr(name, 6), '^([^_]*)_', '\\1__')
  ELSE name END AS mapped FROM names""")
def p17(spark, sf):
    f = feat(spark, sf)
    names = (f.select(F.concat(F.lit("cat__TeamName_"), "TeamName").alias("name")).distinct()
             .unionByName(f.select(F.concat(F.lit("cat__Status_"), F.coalesce("Status", F.lit("missing")))
                                   .alias("name")).distinct())
             .unionByName(f.select(F.concat(F.lit("num__"), F.col("Laps").cast("string")).alias("name")).distinct())
             .unionByName(f.select(F.concat(F.lit("plain_"), F.col("Round").cast("string")).alias("name")).distinct()))
    return names.withColumn("mapped", S.map_feature_name("name"))


# ------------------------------------------------------------- P18/P19/P21
@query("P18_clip", sql=FEAT + f"""
SELECT {KEY_SQL},
  round(CASE WHEN DeviationFromAvg_s IS NULL THEN NULL ELSE greatest(-1.0, least(1.0, DeviationFromAvg_s / 1000.0)) END, 6) AS dev_clipped,
  round(CASE WHEN DeltaFromAhead_s IS NULL THEN NULL ELSE greatest(0.0, least(1.0, DeltaFromAhead_s / 100.0)) END, 6) AS gap_clipped
FROM feat""")
def p18(spark, sf):
    f = feat(spark, sf)
    return f.select(*KEYS, F.round(S.clip(F.col(K.TARGET) / 1000.0, -1.0, 1.0), 6).alias("dev_clipped"),
                    F.round(S.clip(F.col("DeltaFromAhead_s") / 100.0, 0.0, 1.0), 6).alias("gap_clipped"))


@query("P19_display_round", sql=FEAT + f"""
SELECT {KEY_SQL}, round(PointsProp, 3) AS PointsProp_3,
       CASE WHEN AvgQualiTime IS NULL THEN NULL ELSE printf('%.4f', AvgQualiTime) END AS AvgQualiTime_txt
FROM feat""")
def p19(spark, sf):
    f = feat(spark, sf)
    return f.select(*KEYS, S.display_round("PointsProp", 3).alias("PointsProp_3"),
                    F.when(F.col("AvgQualiTime").isNotNull(), S.display_fixed("AvgQualiTime", 4))
                    .alias("AvgQualiTime_txt"))


_POS_TEXT_SQL = ("CASE WHEN Status = 'Retired' THEN 'NC' WHEN Status IS NULL THEN ' DQ' "
                 "ELSE ' ' || CAST(GridPosition AS VARCHAR) END")


@query("P21_grid_position_text", sql=FEAT + f"""
SELECT {KEY_SQL}, {_POS_TEXT_SQL} AS pos_text, TRY_CAST(trim({_POS_TEXT_SQL}) AS INTEGER) AS pos
FROM feat""")
def p21(spark, sf):
    f = feat(spark, sf)
    txt = (F.when(F.col("Status") == "Retired", F.lit("NC"))
            .when(F.col("Status").isNull(), F.lit(" DQ"))
            .otherwise(F.concat(F.lit(" "), F.col("GridPosition").cast("string"))))
    return f.select(*KEYS, txt.alias("pos_text"), S.grid_position(txt).alias("pos"))
