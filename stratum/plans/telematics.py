"""Telematics bound to ``events``: vehicle = ``user_id``, speed = ``value``
(km/h), harsh event = ``error``, ignition on = ``signup``, ignition off =
``purchase``, position derived from the JSON payload ``props.k``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.functions.geo import grid_cell, haversine_km
from stratum.functions.times import micros_between
from stratum.operators.joins import asof_join, attach_one_row, bridge, star_join
from stratum.operators.ordered import neighbour, time_chunk
from stratum.operators.quality import apply_rules
from stratum.operators.sessions import sessionize
from stratum.plans.common import t
from stratum.session import scratch_path
from stratum.sinks import MergeTable, materialize

# Binding choices (ours; the specification leaves them open).
TRIP_GAP_SECONDS = 6 * 3600
SPEED_MAX_PLAUSIBLE = 250.0
ACCELERATION_MAX = 10.0         # m/s2, about what tyres can hold
SPEEDING_KMH = 120.0
NIGHT_FROM, NIGHT_TO = 22, 6
CELL_DEG = 0.01
RISK_WEIGHTS = {"harsh_rate": 0.5, "speeding_share": 0.3, "night_share": 0.2}


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed telemetry fact (AGG12): one row per event."""
    e = t(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").try_cast("int")
    return e.select(
        "event_id", F.col("user_id").alias("vehicle_id"), "ts", "event_type",
        F.col("value").alias("speed"), k.alias("k"),
        (F.lit(40.0) + k / F.lit(1000.0)).alias("lat"),
        (F.lit(-3.7) - k / F.lit(2000.0)).alias("lon"))


def _chunk():
    return time_chunk("ts", "day")


def telemetry_quarantine(spark, sf_dir):
    """DQ16: range, GPS, monotonic-time and acceleration checks, every event kept."""
    tel = telemetry(spark, sf_dir)
    p = neighbour(tel, ["vehicle_id"], ["ts", "event_id"], _chunk(), carry=["ts", "speed"], direction="prev")
    c = F.col
    seconds = micros_between("prev_ts", "ts") / 1_000_000
    acceleration = F.abs(c("speed") - c("prev_speed")) / 3.6 / F.when(seconds > 0, seconds)
    rules = {
        "speed_out_of_range": (c("speed") < 0) | (c("speed") > SPEED_MAX_PLAUSIBLE),
        "gps_invalid": ~c("lat").between(-90, 90) | ~c("lon").between(-180, 180),
        "ts_not_increasing": c("prev_ts").isNotNull() & (c("ts") <= c("prev_ts")),
        "acceleration_implausible": F.coalesce(acceleration > ACCELERATION_MAX, F.lit(False)),
        "bad_payload": c("k").isNull(),
    }
    return apply_rules(p, rules).select("event_id", "vehicle_id", "ts", "speed",
                                        "quarantine_reason", "is_valid")


def trips_by_gap(spark, sf_dir):
    tel = telemetry(spark, sf_dir)
    s = sessionize(tel, ["vehicle_id"], "ts", "event_id", _chunk(), gap_seconds=TRIP_GAP_SECONDS)
    return s.select("event_id", "vehicle_id", "ts", "is_trip_start", "trip_start")


def trips_by_ignition(spark, sf_dir):
    tel = telemetry(spark, sf_dir)
    s = sessionize(tel, ["vehicle_id"], "ts", "event_id", _chunk(), gap_seconds=TRIP_GAP_SECONDS,
                   start_when=F.col("event_type") == "signup",
                   end_when=F.col("event_type") == "purchase")
    return s.select("event_id", "vehicle_id", "ts", "event_type", "is_trip_start", "trip_start")


def _trip_events(spark, sf_dir):
    tel = telemetry(spark, sf_dir)
    s = sessionize(tel, ["vehicle_id"], "ts", "event_id", _chunk(), gap_seconds=TRIP_GAP_SECONDS,
                   carry=["lat", "lon"])
    step = F.when(F.col("is_trip_start"), F.lit(0.0)).otherwise(
        haversine_km("prev_lat", "prev_lon", "lat", "lon"))
    return s.withColumn("step_km", step)


def fact_trip(spark, sf_dir):
    """AGG11: one row per trip (map-side partial aggregation per trip)."""
    s = _trip_events(spark, sf_dir)
    night = (F.hour("ts") >= NIGHT_FROM) | (F.hour("ts") < NIGHT_TO)
    return (s.groupBy("vehicle_id", "trip_start").agg(
        F.max("ts").alias("trip_end"),
        F.count(F.lit(1)).alias("n_events"),
        F.round(F.sum("step_km"), 3).alias("distance_km"),
        F.max("speed").alias("max_speed"),
        F.round(F.avg("speed"), 4).alias("avg_speed"),
        F.count_if(F.col("event_type") == "error").alias("harsh_events"),
        F.count_if(F.col("speed") > SPEEDING_KMH).alias("speeding_events"),
        F.count_if(night).alias("night_events"))
        .withColumn("duration_s", micros_between("trip_start", "trip_end") / 1_000_000))


def trip_daily(spark, sf_dir):
    """AGG13: per vehicle and day."""
    s = _trip_events(spark, sf_dir)
    return s.groupBy("vehicle_id", F.to_date("ts").alias("day")).agg(
        F.count(F.lit(1)).alias("n_events"),
        F.count_distinct("trip_start").alias("n_trips"),
        F.round(F.sum("step_km"), 3).alias("distance_km"),
        F.round(F.sum("speed"), 2).alias("speed_sum"))


def driver_risk(spark, sf_dir):
    """AGG14: weighted z-scores of harsh rate, speeding share, night share.

    Population statistics come from a one-row aggregate joined back by a
    nested-loop join with a broadcast of exactly one row, not from an
    un-partitioned window that would pull every driver into one task."""
    tel = telemetry(spark, sf_dir)
    night = (F.hour("ts") >= NIGHT_FROM) | (F.hour("ts") < NIGHT_TO)
    per = tel.groupBy("vehicle_id").agg(
        F.count(F.lit(1)).alias("n_events"),
        (F.count_if(F.col("event_type") == "error") / F.count(F.lit(1))).alias("harsh_rate"),
        (F.count_if(F.col("speed") > SPEEDING_KMH) / F.count(F.lit(1))).alias("speeding_share"),
        (F.count_if(night) / F.count(F.lit(1))).alias("night_share"))
    feats = list(RISK_WEIGHTS)
    stats = per.agg(*[F.avg(f).alias(f"mu_{f}") for f in feats],
                    *[F.stddev(f).alias(f"sd_{f}") for f in feats])
    j = attach_one_row(per, stats)
    z = {f: F.when(F.col(f"sd_{f}") > 0, (F.col(f) - F.col(f"mu_{f}")) / F.col(f"sd_{f}"))
           .otherwise(F.lit(0.0)) for f in feats}
    score = sum((F.lit(w) * z[f] for f, w in RISK_WEIGHTS.items()), F.lit(0.0))
    return j.select("vehicle_id", "n_events",
                    *[F.round(f, 6).alias(f) for f in feats],
                    F.round(score, 6).alias("risk_score"))


def grid_cells(spark, sf_dir):
    """GEO1: per grid cell activity."""
    tel = telemetry(spark, sf_dir)
    return tel.groupBy(grid_cell("lat", "lon", CELL_DEG).alias("cell")).agg(
        F.count(F.lit(1)).alias("n_events"),
        F.count_distinct("vehicle_id").alias("n_vehicles"),
        F.round(F.avg("speed"), 4).alias("avg_speed"))


def fact_trip_merge(spark, sf_dir):
    """SNK5: trips merged into a stored fact: the trips of the first half of
    the vehicles, then all of them (the first half again), then a replay."""
    trips = materialize(fact_trip(spark, sf_dir), "merge_trips")
    stored = MergeTable(spark, scratch_path(spark, "fact_trip"), ["vehicle_id", "trip_start"])
    stored.merge(trips.where("vehicle_id % 2 = 0"))
    stored.merge(trips)
    return stored.merge(trips)


def trip_star(spark, sf_dir):
    """JN1 + JN5: the trip fact with its holder (through the vehicle bridge),
    day key, risk score, and the conditions in the cell where the trip began."""
    trips = fact_trip(spark, sf_dir)
    first = telemetry(spark, sf_dir).select("vehicle_id", F.col("ts").alias("trip_start"), "event_id",
                                            grid_cell("lat", "lon", CELL_DEG).alias("cell"))
    first = first.groupBy("vehicle_id", "trip_start").agg(F.min_by("cell", "event_id").alias("cell"))
    holders = bridge(t(spark, sf_dir, "customer"), "c_custkey",
                     t(spark, sf_dir, "events").select(F.col("user_id").alias("vehicle_id")), "vehicle_id")
    n_holders = holders.groupBy("vehicle_id").agg(F.count("c_custkey").alias("n_holders"),
                                                  F.min("c_custkey").alias("first_holder"))
    risk = driver_risk(spark, sf_dir).select("vehicle_id", "risk_score")
    frame = trips.join(first, ["vehicle_id", "trip_start"]).select(
        "vehicle_id", "trip_start", "n_events", "distance_km", "cell",
        (F.year("trip_start") * 10000 + F.month("trip_start") * 100 + F.dayofmonth("trip_start")).alias("date_key"))
    frame = star_join(frame, [(n_holders, ["vehicle_id"]), (risk, ["vehicle_id"])])
    obs = cell_conditions(spark, sf_dir)
    return (asof_join(frame, obs, ["cell"], "trip_start", "obs_ts", ["avg_speed", "n_events"], prefix="cell_")
            .withColumnRenamed("cell_obs_ts", "obs_ts"))


def cell_conditions(spark, sf_dir):
    """Hourly observations of a grid cell, published at the hour's end."""
    tel = telemetry(spark, sf_dir).withColumn("cell", grid_cell("lat", "lon", CELL_DEG))
    return (tel.groupBy("cell", F.date_trunc("hour", "ts").alias("hour"))
            .agg(F.round(F.avg("speed"), 4).alias("avg_speed"), F.count(F.lit(1)).alias("n_events"))
            .select("cell", (F.col("hour") + F.expr("INTERVAL 1 HOUR")).cast("timestamp_ntz").alias("obs_ts"),
                    "avg_speed", "n_events"))
