"""Edge rows for the scalar functions."""
import math

from pyspark.sql import functions as F

from pitwall.functions import scalars as S


def one(spark, expr, value, dtype="string"):
    df = spark.createDataFrame([(value,)], f"x {dtype}")
    return df.select(expr(F.col("x")).alias("y")).first()["y"]


def test_quali_time_to_seconds(spark):
    cases = {None: 0.0, "": 0.0, "DNF": 0.0, "59.1": 0.0, "1:02:03.4": 0.0,
             "1:47.934": 107.934, "1:": 0.0, " 1:47.934 ": 107.934}
    for v, want in cases.items():
        got = one(spark, S.quali_time_to_seconds, v)
        assert math.isclose(got, want, abs_tol=1e-9), (v, got)


def test_clean_driver_name(spark):
    cases = {None: None, "  Max VerstappenVER ": "Max Verstappen",
             "NicoHülkenbergHUL": "Nico Hülkenberg", "AL": "",
             "LandoNorrisNOR": "Lando Norris", "Lando Norris": "Lando Norris",
             " OscarPiastriPIA ": "Oscar Piastri",  # no-break spaces
             "Max\u00a0\u00a0Verstappen": "Max Verstappen"}
    for v, want in cases.items():
        assert one(spark, S.clean_driver_name, v) == want, v


def test_avg_quali_time(spark):
    df = spark.createDataFrame([("1:55.473", "1:51.379", "1:47.934"), ("1:50.000", None, ""),
                                (None, None, None), ("1:50.000", "DNF", None)], "a string, b string, c string")
    got = [r["y"] for r in df.select(S.avg_quali_time("a", "b", "c").alias("y")).collect()]
    assert math.isclose(got[0], (115.473 + 111.379 + 107.934) / 3)
    assert got[1] == 110.0
    assert got[2] is None
    assert got[3] == 55.0            # unparseable counts as 0.0


def test_timedelta_to_seconds(spark):
    assert math.isclose(one(spark, S.timedelta_to_seconds, "0 days 01:32:10.510000"), 5530.51)
    assert one(spark, S.timedelta_to_seconds, "junk") is None
    assert math.isclose(one(spark, S.timedelta_to_seconds, "1 days 00:00:01.000000"), 86401.0)


def test_rain_normalisation(spark):
    tokens = {"rain": 1, "Yes": 1, "raining": 1, "norain": 0, "no": 0, "no rain": 0, "no_rain": 0,
              "0": 0, "1": 1, "false": 0, "TRUE": 1, "light rain": 1, "NoRain": 0, "1.0": 0,
              "drizzle": 0, None: 0}
    for v, want in tokens.items():
        assert one(spark, lambda c: S.normalize_rain(c), v) == want, v
    assert one(spark, lambda c: S.normalize_rain(c, "contains"), "NoRain") == 1
    assert one(spark, lambda c: S.normalize_rain(c, "strict"), "true") == 0
    assert one(spark, lambda c: S.normalize_rain(c, dtype="double"), 1.0, "double") == 1
    assert one(spark, lambda c: S.normalize_rain(c, dtype="boolean"), True, "boolean") == 1


def test_safe_number_and_clip(spark):
    assert one(spark, S.safe_number, "abc") == 0.0
    assert one(spark, S.safe_number, "NaN") == 0.0
    assert one(spark, S.safe_number, "2.5") == 2.5
    assert one(spark, lambda c: S.clip(c, 0.0, 1.0), None, "double") is None
    assert one(spark, lambda c: S.clip(c, 0.0, 1.0), 1.7, "double") == 1.0


def test_feature_name_mapping(spark):
    cases = {"num__GridPosition": "GridPosition", "cat__Status_Lapped": "Status__Lapped",
             "cat__Team_Red_Bull": "Team__Red_Bull", "plain": "plain"}
    for v, want in cases.items():
        assert one(spark, S.map_feature_name, v) == want


def test_labels_and_argmax(spark):
    df = spark.createDataFrame([(30.0, 80.0, 0.1, 0.5, 0.5, 0.0, 0.0), (9.9, 10.0, 0.0, 0.0, 0.0, 0.0, 0.0)],
                               "t double, h double, SOFT double, MEDIUM double, HARD double, "
                               "INTERMEDIATE double, WET double")
    rows = df.select(S.air_temp_label("t").alias("a"), S.humidity_label("h").alias("b"),
                     S.argmax_name(["SOFT", "MEDIUM", "HARD", "INTERMEDIATE", "WET"]).alias("c")).collect()
    assert (rows[0]["a"], rows[0]["b"], rows[0]["c"]) == ("hot", "very humid", "MEDIUM")
    assert (rows[1]["a"], rows[1]["b"], rows[1]["c"]) == ("cool", "dry", "SOFT")


def test_grid_position(spark):
    assert one(spark, S.grid_position, "NC") is None
    assert one(spark, S.grid_position, " 7") == 7
