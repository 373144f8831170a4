"""Independent DuckDB SQL for every registered query (the correctness oracle).

Written from the query *definitions*, not from the Spark code: plain window
functions where the Spark side uses skew-safe two-level scans, native
``ASOF JOIN`` where the Spark side unions and carries forward, and so on.
"""

from __future__ import annotations

# ----------------------------------------------------------------- claims
_CLAIM_PAYLOAD = [
    "source_system", "policy_number", "incident_date", "incident_date_is_synthetic",
    "claim_type", "severity", "total_claim_amount", "injury_claim", "property_claim",
    "vehicle_claim", "auto_make", "auto_model", "auto_year", "fraud", "insured_zip",
    "incident_location", "policyholder_age", "policyholder_sex", "fault",
    "vehicle_category",
]
_ORDER_ALL = ", ".join(f"{c} ASC NULLS FIRST" for c in _CLAIM_PAYLOAD)

_TENTHS = "CAST(CAST(o_totalprice AS DECIMAL(14,2)) * CAST({} AS INTEGER) * CAST(0.1 AS DECIMAL(2,1)) AS DECIMAL(14,2))"
_INJURY, _PROPERTY = _TENTHS.format("o_custkey % 5"), _TENTHS.format("o_orderkey % 4")

CLAIMS_CTE = f"""
src AS (
  SELECT 'orders' AS source_system, CAST(o_custkey AS VARCHAR) AS policy_number,
         CAST(o_orderdate AS DATE) AS incident_date, FALSE AS incident_date_is_synthetic,
         o_orderpriority AS claim_type, o_orderstatus AS severity,
         CAST(o_totalprice AS DECIMAL(14,2)) AS total_claim_amount,
         {_INJURY} AS injury_claim, {_PROPERTY} AS property_claim,
         CAST(CAST(o_totalprice AS DECIMAL(14,2)) - {_INJURY} - {_PROPERTY} AS DECIMAL(14,2)) AS vehicle_claim,
         CAST(NULL AS VARCHAR) AS auto_make, CAST(NULL AS VARCHAR) AS auto_model,
         CAST(NULL AS INTEGER) AS auto_year, o_totalprice > 400000 AS fraud,
         CAST(NULL AS VARCHAR) AS insured_zip, CAST(NULL AS VARCHAR) AS incident_location,
         CAST(NULL AS INTEGER) AS policyholder_age, CAST(NULL AS VARCHAR) AS policyholder_sex,
         CAST(NULL AS VARCHAR) AS fault, CAST(NULL AS VARCHAR) AS vehicle_category
  FROM orders
  UNION ALL
  SELECT 'lineitem', CAST(l_orderkey AS VARCHAR), make_date(year(l_shipdate), month(l_shipdate), 15), TRUE,
         NULL, NULL, NULL, NULL, NULL, NULL, CAST(l_partkey AS VARCHAR), NULL, NULL,
         l_returnflag = 'R', NULL, CAST(l_suppkey AS VARCHAR), CAST(l_quantity AS INTEGER),
         l_linestatus, l_returnflag, CAST(l_linenumber AS VARCHAR)
  FROM lineitem
),
keyed AS (
  SELECT sha256(concat_ws('|', source_system, coalesce(policy_number, ''),
           coalesce(CAST(incident_date AS VARCHAR), ''), coalesce(CAST(total_claim_amount AS VARCHAR), ''),
           coalesce(auto_make, ''), coalesce(incident_location, ''),
           coalesce(CAST(policyholder_age AS VARCHAR), ''), coalesce(fault, ''),
           coalesce(severity, ''))) AS claim_id, *
  FROM src
),
dedup AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY claim_id ORDER BY {_ORDER_ALL}) AS rn FROM keyed)
  WHERE rn = 1
),
seeded AS (
  SELECT *, CAST(('0x' || substr(md5(claim_id), 1, 8)) AS BIGINT) AS h FROM dedup
),
life AS (
  SELECT *, incident_date + CAST(h % 4 + 1 AS INTEGER) AS fnol_date,
    CASE WHEN fraud THEN CASE WHEN h % 100 < 55 THEN 'denied' ELSE 'under_review' END
         WHEN h % 100 < 70 THEN 'closed' WHEN h % 100 < 90 THEN 'settled'
         ELSE 'under_review' END AS claim_status
  FROM seeded
),
life2 AS (
  SELECT *, CASE WHEN claim_status IN ('denied', 'closed', 'settled')
                 THEN fnol_date + CAST(h % 60 + 5 AS INTEGER) END AS settlement_date
  FROM life
),
enriched AS (
  SELECT * EXCLUDE (h), CAST(date_diff('day', fnol_date, settlement_date) AS INTEGER) AS cycle_time_days,
    NULLIF(concat_ws('; ',
      CASE WHEN total_claim_amount < 0 THEN 'amount_negative' END,
      CASE WHEN source_system = 'orders' AND claim_type IS NULL THEN 'missing_claim_type' END,
      CASE WHEN policyholder_age IS NOT NULL AND policyholder_age < 16 THEN 'age_lt_16' END,
      CASE WHEN incident_date IS NOT NULL AND fnol_date IS NOT NULL AND fnol_date < incident_date
           THEN 'dates_unordered' END,
      CASE WHEN settlement_date IS NOT NULL AND settlement_date < fnol_date
           THEN 'settlement_before_fnol' END), '') AS quarantine_reason
  FROM life2
),
claim AS (
  SELECT * EXCLUDE (quarantine_reason) FROM enriched WHERE quarantine_reason IS NULL
),
history AS (
  SELECT claim_id, source_system, 'FNOL' AS status, fnol_date AS status_date, 1 AS seq FROM claim
  UNION ALL
  SELECT claim_id, source_system, 'under_review',
         fnol_date + CAST(CAST(('0x' || substr(md5(claim_id), 1, 8)) AS BIGINT) % 3 + 1 AS INTEGER), 2
  FROM claim
  UNION ALL
  SELECT claim_id, source_system, claim_status, settlement_date, 3 FROM claim
  WHERE settlement_date IS NOT NULL
)"""

_MONEY = ("total_claim_amount", "injury_claim", "property_claim", "vehicle_claim")


def _claim_select(cols):
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" if c in _MONEY else c for c in cols)


CLAIM_COLS = ["claim_id"] + _CLAIM_PAYLOAD + [
    "fnol_date", "claim_status", "settlement_date", "cycle_time_days"]
QUARANTINE_COLS = ["claim_id", "source_system", "policy_number", "incident_date",
                   "claim_type", "total_claim_amount", "policyholder_age",
                   "fnol_date", "settlement_date", "quarantine_reason"]

SQL: dict[str, str] = {
    "conform_claims": f"WITH {CLAIMS_CTE} SELECT {_claim_select(['claim_id'] + _CLAIM_PAYLOAD)} FROM dedup",
    "claim_lifecycle": f"""WITH {CLAIMS_CTE}
        SELECT claim_id, source_system, fraud, fnol_date, claim_status, settlement_date, cycle_time_days
        FROM enriched""",
    "claim_valid": f"WITH {CLAIMS_CTE} SELECT {_claim_select(CLAIM_COLS)} FROM claim",
    "claim_quarantine": f"""WITH {CLAIMS_CTE}
        SELECT {_claim_select(QUARANTINE_COLS)} FROM enriched WHERE quarantine_reason IS NOT NULL""",
    "claim_status_history": f"WITH {CLAIMS_CTE} SELECT * FROM history",
}

# ----------------------------------------------------------------- policy
_CH = """ch AS (SELECT DISTINCT o_custkey AS policy_id, o_orderpriority AS tier,
                o_orderdate AS seq_ts, o_orderkey AS seq_tie FROM orders)"""
_TERMS = """terms AS (SELECT o_custkey AS policy_id, o_orderkey AS term_id,
              CAST(o_orderdate AS DATE) AS term_start,
              CAST(o_orderdate AS DATE) + 365 AS term_end, o_totalprice AS premium FROM orders)"""

SQL.update({
    "scd2_policyholder": f"""WITH {_CH}
        SELECT policy_id, tier, seq_ts AS effective_from,
               lead(seq_ts) OVER w AS effective_to, lead(seq_ts) OVER w IS NULL AS is_current, seq_tie
        FROM ch WINDOW w AS (PARTITION BY policy_id ORDER BY seq_ts, seq_tie)""",
    "scd2_repeats_coalesced": f"""WITH {_CH},
        f AS (SELECT *, lag(tier) OVER w AS prev_tier, row_number() OVER w AS rn
              FROM ch WINDOW w AS (PARTITION BY policy_id ORDER BY seq_ts, seq_tie)),
        k AS (SELECT * FROM f WHERE rn = 1 OR prev_tier IS DISTINCT FROM tier)
        SELECT policy_id, tier, seq_ts AS effective_from,
               lead(seq_ts) OVER w AS effective_to, lead(seq_ts) OVER w IS NULL AS is_current, seq_tie
        FROM k WINDOW w AS (PARTITION BY policy_id ORDER BY seq_ts, seq_tie)""",
    "endorsement_current": """WITH e AS (
          SELECT o_custkey AS policy_id, o_orderdate AS seq_ts, o_orderkey AS seq_tie,
                 CASE WHEN o_orderpriority <> '3-MEDIUM' THEN o_orderpriority END AS tier,
                 CASE WHEN o_orderstatus <> 'O' THEN o_orderstatus END AS status,
                 CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS premium
          FROM orders),
        r AS (SELECT policy_id, seq_ts,
                 last_value(tier IGNORE NULLS) OVER w AS tier,
                 last_value(status IGNORE NULLS) OVER w AS status,
                 last_value(premium IGNORE NULLS) OVER w AS premium,
                 count(*) OVER (PARTITION BY policy_id) AS n_changes,
                 row_number() OVER (PARTITION BY policy_id ORDER BY seq_ts DESC, seq_tie DESC) AS rn
              FROM e WINDOW w AS (PARTITION BY policy_id ORDER BY seq_ts, seq_tie
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
        SELECT policy_id, tier, status, premium, seq_ts AS last_seq_ts, n_changes FROM r WHERE rn = 1""",
    "upsert_latest": """WITH o AS (SELECT o_custkey AS policy_id, o_orderdate AS seq_ts, o_orderkey AS seq_tie,
                 o_orderstatus AS status, o_totalprice AS premium,
                 CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN 'base' ELSE 'update' END AS origin
          FROM orders),
        r AS (SELECT *, row_number() OVER (PARTITION BY policy_id ORDER BY seq_ts DESC, seq_tie DESC) AS rn FROM o)
        SELECT policy_id, seq_ts, seq_tie, status, premium, origin FROM r WHERE rn = 1""",
    "policy_lapses": f"""WITH {_TERMS},
        n AS (SELECT *, lead(term_start) OVER (PARTITION BY policy_id ORDER BY term_start, term_id) AS next_term_start
              FROM terms)
        SELECT policy_id, term_id, term_start, term_end, next_term_start,
               CAST(date_diff('day', term_end, next_term_start) AS INTEGER) AS gap_days,
               CASE WHEN next_term_start IS NULL THEN 'last_term'
                    WHEN date_diff('day', term_end, next_term_start) <= 30 THEN 'renewed'
                    ELSE 'lapsed' END AS outcome
        FROM n""",
    "policy_inforce_monthly": f"""WITH {_TERMS},
        m AS (SELECT policy_id, premium,
                     unnest(generate_series(date_trunc('month', term_start), date_trunc('month', term_end),
                                            INTERVAL 1 MONTH)) AS month FROM terms)
        SELECT CAST(month AS DATE) AS month, count(*) AS terms_in_force,
               count(DISTINCT policy_id) AS policies_in_force,
               round(CAST(sum(CAST(premium AS DECIMAL(18,2))) AS DOUBLE), 2) AS premium_in_force
        FROM m GROUP BY 1""",
    "policy_transactions": """SELECT o_custkey AS policy_id, o_orderkey AS txn_id, o_orderdate AS txn_ts,
             CASE WHEN lag(o_orderkey) OVER w IS NULL THEN 'new' ELSE 'endorsement' END AS txn_type,
             o_totalprice AS premium, round(o_totalprice - lag(o_totalprice) OVER w, 2) AS premium_delta
        FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)""",
})

# -------------------------------------------------------------- telematics
_TEL = """tel AS (
  SELECT event_id, user_id AS vehicle_id, ts, event_type, value AS speed,
         TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         CAST(40.0 AS DOUBLE) + CAST(TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS DOUBLE) / CAST(1000.0 AS DOUBLE) AS lat,
         CAST(-3.7 AS DOUBLE) - CAST(TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS DOUBLE) / CAST(2000.0 AS DOUBLE) AS lon
  FROM events)"""
_SESS = _TEL + """,
g AS (SELECT *, lag(ts) OVER w AS prev_ts, lag(lat) OVER w AS prev_lat, lag(lon) OVER w AS prev_lon
      FROM tel WINDOW w AS (PARTITION BY vehicle_id ORDER BY ts, event_id)),
s AS (SELECT *, (prev_ts IS NULL OR epoch_us(ts) - epoch_us(prev_ts) > 21600000000) AS is_trip_start FROM g),
trips AS (SELECT *, last_value(CASE WHEN is_trip_start THEN ts END IGNORE NULLS)
                    OVER (PARTITION BY vehicle_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS trip_start,
                 CASE WHEN is_trip_start THEN 0.0 ELSE
                   2 * 6371.0088 * asin(least(1.0, sqrt(
                     pow(sin((radians(lat) - radians(prev_lat)) / 2), 2)
                     + cos(radians(prev_lat)) * cos(radians(lat)) * pow(sin((radians(lon) - radians(prev_lon)) / 2), 2))))
                 END AS step_km
          FROM s)"""

SQL.update({
    "telemetry_quarantine": f"""WITH {_TEL},
        p AS (SELECT *, lag(ts) OVER w AS prev_ts, lag(speed) OVER w AS prev_speed
              FROM tel WINDOW w AS (PARTITION BY vehicle_id ORDER BY ts, event_id)),
        r AS (SELECT *, NULLIF(concat_ws('; ',
                CASE WHEN speed < 0 OR speed > 250.0 THEN 'speed_out_of_range' END,
                CASE WHEN NOT (lat BETWEEN -90 AND 90) OR NOT (lon BETWEEN -180 AND 180) THEN 'gps_invalid' END,
                CASE WHEN prev_ts IS NOT NULL AND ts <= prev_ts THEN 'ts_not_increasing' END,
                CASE WHEN ts > prev_ts AND abs(speed - prev_speed) / 3.6::DOUBLE
                          / ((epoch_us(ts) - epoch_us(prev_ts)) / 1000000) > 10 THEN 'acceleration_implausible' END,
                CASE WHEN k IS NULL THEN 'bad_payload' END), '') AS quarantine_reason FROM p)
        SELECT event_id, vehicle_id, ts, speed, quarantine_reason, quarantine_reason IS NULL AS is_valid FROM r""",
    "trips_by_gap": f"WITH {_SESS} SELECT event_id, vehicle_id, ts, is_trip_start, trip_start FROM trips",
    "trips_by_ignition": f"""WITH {_TEL},
        g AS (SELECT *, lag(ts) OVER w AS prev_ts, lag(event_type) OVER w AS prev_type
              FROM tel WINDOW w AS (PARTITION BY vehicle_id ORDER BY ts, event_id)),
        s AS (SELECT *, (prev_ts IS NULL OR prev_type = 'purchase'
                         OR epoch_us(ts) - epoch_us(prev_ts) > 21600000000
                         OR event_type = 'signup') AS is_trip_start FROM g)
        SELECT event_id, vehicle_id, ts, event_type, is_trip_start,
               last_value(CASE WHEN is_trip_start THEN ts END IGNORE NULLS)
                 OVER (PARTITION BY vehicle_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS trip_start
        FROM s""",
    "fact_trip": f"""WITH {_SESS}
        SELECT vehicle_id, trip_start, max(ts) AS trip_end, count(*) AS n_events,
               round(sum(step_km), 3) AS distance_km, max(speed) AS max_speed,
               round(avg(speed), 4) AS avg_speed,
               CAST(count_if(event_type = 'error') AS BIGINT) AS harsh_events,
               CAST(count_if(speed > 120.0) AS BIGINT) AS speeding_events,
               CAST(count_if(hour(ts) >= 22 OR hour(ts) < 6) AS BIGINT) AS night_events,
               (epoch_us(max(ts)) - epoch_us(trip_start)) / 1000000 AS duration_s
        FROM trips GROUP BY vehicle_id, trip_start""",
    "trip_daily": f"""WITH {_SESS}
        SELECT vehicle_id, CAST(ts AS DATE) AS day, count(*) AS n_events,
               count(DISTINCT trip_start) AS n_trips, round(sum(step_km), 3) AS distance_km,
               round(sum(speed), 2) AS speed_sum
        FROM trips GROUP BY 1, 2""",
    "driver_risk": f"""WITH {_TEL},
        per AS (SELECT vehicle_id, count(*) AS n_events,
                       count_if(event_type = 'error') / count(*) AS harsh_rate,
                       count_if(speed > 120.0) / count(*) AS speeding_share,
                       count_if(hour(ts) >= 22 OR hour(ts) < 6) / count(*) AS night_share
                FROM tel GROUP BY vehicle_id),
        st AS (SELECT avg(harsh_rate) AS mh, stddev_samp(harsh_rate) AS sh,
                      avg(speeding_share) AS ms, stddev_samp(speeding_share) AS ss,
                      avg(night_share) AS mn, stddev_samp(night_share) AS sn FROM per)
        SELECT vehicle_id, n_events, round(harsh_rate, 6) AS harsh_rate,
               round(speeding_share, 6) AS speeding_share, round(night_share, 6) AS night_share,
               round(0.5 * CASE WHEN sh > 0 THEN (harsh_rate - mh) / sh ELSE 0.0 END
                     + 0.3 * CASE WHEN ss > 0 THEN (speeding_share - ms) / ss ELSE 0.0 END
                     + 0.2 * CASE WHEN sn > 0 THEN (night_share - mn) / sn ELSE 0.0 END, 6) AS risk_score
        FROM per, st""",
    "grid_cells": f"""WITH {_TEL}
        SELECT CAST(CAST(floor(lat / 0.01) AS BIGINT) AS VARCHAR) || ':' || CAST(CAST(floor(lon / 0.01) AS BIGINT) AS VARCHAR) AS cell,
               count(*) AS n_events, count(DISTINCT vehicle_id) AS n_vehicles, round(avg(speed), 4) AS avg_speed
        FROM tel GROUP BY 1""",
})

# ------------------------------------------------------------------- gold
_STAR_CTE = """
geo AS (SELECT n_nationkey, n_name AS nation, r_name AS region FROM nation JOIN region ON n_regionkey = r_regionkey),
f AS (SELECT c.*, CASE WHEN source_system = 'orders' THEN TRY_CAST(policy_number AS BIGINT) END AS pk FROM claim c),
star AS (
  SELECT claim_id, source_system,
         CAST(CASE WHEN cu.c_nationkey IS NOT NULL THEN f.pk ELSE -1 END AS BIGINT) AS policy_key,
         coalesce(cu.c_mktsegment, 'UNKNOWN') AS segment, coalesce(g.nation, 'UNKNOWN') AS nation,
         coalesce(g.region, 'UNKNOWN') AS region,
         CAST(coalesce(year(incident_date) * 10000 + month(incident_date) * 100 + day(incident_date), -1) AS INTEGER) AS date_key,
         CASE WHEN claim_type IS NOT NULL THEN sha256(concat_ws('|', coalesce(claim_type, ''))) ELSE '-1' END AS claim_type_key,
         CAST(total_claim_amount AS DOUBLE) AS claim_amount, CAST(injury_claim AS DOUBLE) AS injury_amount,
         CAST(property_claim AS DOUBLE) AS property_amount, CAST(vehicle_claim AS DOUBLE) AS vehicle_amount,
         CAST(fraud AS INTEGER) AS is_fraud, 1 AS claim_count,
         claim_type, f.severity, auto_make, vehicle_category, settlement_date
  FROM f LEFT JOIN customer cu ON cu.c_custkey = f.pk LEFT JOIN geo g ON g.n_nationkey = cu.c_nationkey)"""
_LOSS = _TEL + """,
losses AS (SELECT event_id AS loss_id, vehicle_id, ts AS loss_ts FROM tel WHERE event_type = 'error'),
readings AS (SELECT event_id, vehicle_id, ts, speed FROM tel WHERE event_type <> 'error')"""
_RANK = """CAST(('0x' || substr(md5(CAST({c} AS VARCHAR)), 1, 8)) AS BIGINT)"""

SQL.update({
    "dim_date": f"""WITH {CLAIMS_CTE},
        d AS (SELECT CAST(unnest(generate_series(min(incident_date), max(incident_date), INTERVAL 1 DAY)) AS DATE) AS date FROM claim)
        SELECT date, CAST(year(date) * 10000 + month(date) * 100 + day(date) AS INTEGER) AS date_key,
               CAST(year(date) AS INTEGER) AS year, CAST(quarter(date) AS INTEGER) AS quarter,
               CAST(month(date) AS INTEGER) AS month, CAST(isodow(date) AS INTEGER) AS iso_dow,
               isodow(date) >= 6 AS is_weekend FROM d""",
    "dim_claim_type": f"""WITH {CLAIMS_CTE}
        SELECT DISTINCT sha256(concat_ws('|', coalesce(claim_type, ''))) AS claim_type_key, claim_type
        FROM claim WHERE claim_type IS NOT NULL""",
    "star_claims": f"""WITH {CLAIMS_CTE}, {_STAR_CTE}
        SELECT * EXCLUDE (claim_type, severity, auto_make, vehicle_category, settlement_date) FROM star""",
    "point_in_time_policy": f"""WITH {_CH},
        scd AS (SELECT policy_id, tier, seq_ts AS effective_from,
                       lead(seq_ts) OVER (PARTITION BY policy_id ORDER BY seq_ts, seq_tie) AS effective_to FROM ch),
        fact AS (SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, o_custkey AS policy_id
                 FROM lineitem JOIN orders ON o_orderkey = l_orderkey)
        SELECT f.l_orderkey, f.l_linenumber, f.l_partkey, f.l_shipdate, f.policy_id, s.tier,
               s.effective_from AS version_from
        FROM fact f LEFT JOIN scd s ON s.policy_id = f.policy_id AND s.effective_from <= f.l_shipdate
             AND (s.effective_to IS NULL OR f.l_shipdate < s.effective_to)""",
    "asof_telemetry": f"""WITH {_LOSS},
        m AS (SELECT l.loss_id, l.vehicle_id, l.loss_ts, r.ts AS r_ts, r.event_id AS r_event_id, r.speed AS r_speed
              FROM losses l ASOF LEFT JOIN readings r ON l.vehicle_id = r.vehicle_id AND l.loss_ts >= r.ts)
        SELECT loss_id, vehicle_id, loss_ts,
               CASE WHEN epoch_us(loss_ts) - epoch_us(r_ts) <= 3600000000 THEN r_ts END AS r_ts,
               CASE WHEN epoch_us(loss_ts) - epoch_us(r_ts) <= 3600000000 THEN r_event_id END AS r_event_id,
               CASE WHEN epoch_us(loss_ts) - epoch_us(r_ts) <= 3600000000 THEN r_speed END AS r_speed
        FROM m""",
    "interval_telemetry": f"""WITH {_LOSS},
        per AS (SELECT l.loss_id, count(*) AS n_readings, max(r.speed) AS max_speed, round(avg(r.speed), 4) AS avg_speed
                FROM losses l JOIN readings r ON r.vehicle_id = l.vehicle_id
                 AND r.ts >= l.loss_ts - INTERVAL 1800 SECOND AND r.ts <= l.loss_ts
                GROUP BY l.loss_id)
        SELECT l.loss_id, l.vehicle_id, l.loss_ts, coalesce(per.n_readings, 0) AS n_readings,
               per.max_speed, per.avg_speed
        FROM losses l LEFT JOIN per USING (loss_id)""",
    "bridge_keys": f"""WITH u AS (SELECT DISTINCT user_id AS vehicle_id FROM events),
        r AS (SELECT vehicle_id, row_number() OVER (ORDER BY {_RANK.format(c='vehicle_id')} % 4096, vehicle_id) - 1 AS bridge_rank FROM u),
        n AS (SELECT count(*) AS total FROM u),
        c AS (SELECT DISTINCT c_custkey FROM customer)
        SELECT c.c_custkey, CAST({_RANK.format(c='c.c_custkey')} % n.total AS BIGINT) AS bridge_rank, r.vehicle_id
        FROM c CROSS JOIN n LEFT JOIN r ON r.bridge_rank = {_RANK.format(c='c.c_custkey')} % n.total""",
    "policy_claims": f"""WITH {CLAIMS_CTE},
        b AS (SELECT TRY_CAST(policy_number AS BIGINT) AS order_key, count(*) AS n_claims, CAST(count_if(fraud) AS BIGINT) AS n_fraud
              FROM claim WHERE source_system = 'lineitem' GROUP BY 1)
        SELECT o_orderkey AS order_key, o_custkey, coalesce(b.n_claims, 0) AS n_claims, coalesce(b.n_fraud, 0) AS n_fraud
        FROM orders LEFT JOIN b ON b.order_key = o_orderkey""",
    "claim_frequency": f"""WITH {CLAIMS_CTE},
        b AS (SELECT TRY_CAST(policy_number AS BIGINT) AS order_key, count(*) AS n_claims
              FROM claim WHERE source_system = 'lineitem' GROUP BY 1),
        per AS (SELECT o_custkey, count(*) AS exposure_years, CAST(sum(coalesce(b.n_claims, 0)) AS BIGINT) AS n_claims
                FROM orders LEFT JOIN b ON b.order_key = o_orderkey GROUP BY 1)
        SELECT c_custkey, c_mktsegment, coalesce(per.exposure_years, 0) AS exposure_years,
               coalesce(per.n_claims, 0) AS n_claims,
               round(per.n_claims / per.exposure_years, 6) AS claim_frequency
        FROM customer LEFT JOIN per ON per.o_custkey = c_custkey""",
    "recall_match": """WITH camp AS (SELECT DISTINCT p_brand, p_type FROM part WHERE p_size > 45)
        SELECT sha256(concat_ws('|', coalesce(c.p_brand, ''), coalesce(c.p_type, ''))) AS campaign_id,
               c.p_brand, c.p_type, count(*) AS n_claim_lines, count(DISTINCT l_orderkey) AS n_orders,
               count(DISTINCT l_partkey) AS n_parts
        FROM lineitem JOIN part p ON p.p_partkey = l_partkey
             JOIN camp c ON c.p_brand = p.p_brand AND c.p_type = p.p_type
        GROUP BY 1, 2, 3""",
})

# ------------------------------------------------------------------ marts
_KPI_CTE = """
expo1 AS (SELECT 'orders' AS source_system, o_orderpriority AS claim_type,
                 CAST(date_trunc('month', l_shipdate) AS DATE) AS period,
                 sum(CAST(l_extendedprice AS DECIMAL(14,2)) * CAST(l_tax AS DECIMAL(4,2))) AS premium, count(*) AS exposures
          FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1, 2, 3),
expo AS (SELECT * FROM expo1 UNION ALL
         SELECT 'lineitem', NULL, period, sum(premium), CAST(sum(exposures) AS BIGINT) FROM expo1 GROUP BY period),
aged AS (SELECT *, CASE WHEN settlement_date IS NULL THEN date_diff('day', fnol_date, DATE '2002-01-01') END AS age FROM claim),
kg AS (SELECT source_system, claim_type, CAST(date_trunc('month', incident_date) AS DATE) AS period,
              count(*) AS n_claims, count(total_claim_amount) AS n_with_amount,
              sum(total_claim_amount) AS inc, sum(injury_claim) AS inj, sum(property_claim) AS prop,
              sum(vehicle_claim) AS veh, avg(CAST(fraud AS INTEGER)) AS fr,
              CAST(count_if(settlement_date IS NULL) AS BIGINT) AS open_claims,
              CAST(count_if(settlement_date IS NOT NULL) AS BIGINT) AS closed_claims,
              avg(cycle_time_days) AS cyc, count_if(claim_status = 'denied') AS den,
              count_if(claim_status IN ('denied', 'closed', 'settled')) AS term,
              count(*) FILTER (WHERE age <= 30) AS open_0_30d,
              count(*) FILTER (WHERE age > 30 AND age <= 90) AS open_31_90d,
              count(*) FILTER (WHERE age > 90 AND age <= 365) AS open_91_365d,
              count(*) FILTER (WHERE age > 365) AS open_over_365d
       FROM aged GROUP BY 1, 2, 3),
kpi AS (
  SELECT kg.source_system, kg.claim_type, kg.period, n_claims, n_with_amount, CAST(inc AS DOUBLE) AS incurred,
         CAST(premium AS DOUBLE) AS premium, exposures,
         round(CAST(inc AS DOUBLE) / CAST(NULLIF(premium, 0) AS DOUBLE), 6) AS loss_ratio,
         round(n_claims / NULLIF(exposures, 0), 6) AS claim_frequency,
         round(CAST(inc AS DOUBLE) / CAST(NULLIF(n_with_amount, 0) AS DOUBLE), 6) AS severity,
         round(fr, 6) AS fraud_rate,
         round(n_claims / sum(n_claims) OVER (PARTITION BY kg.source_system, kg.period), 6) AS claim_mix,
         round(CAST(inj AS DOUBLE) / CAST(NULLIF(inc, 0) AS DOUBLE), 6) AS injury_share,
         round(CAST(prop AS DOUBLE) / CAST(NULLIF(inc, 0) AS DOUBLE), 6) AS property_share,
         round(CAST(veh AS DOUBLE) / CAST(NULLIF(inc, 0) AS DOUBLE), 6) AS vehicle_share,
         round(cyc, 6) AS avg_cycle_days, open_claims, closed_claims,
         open_0_30d, open_31_90d, open_91_365d, open_over_365d,
         round(CAST(den AS DOUBLE) / CAST(NULLIF(term, 0) AS DOUBLE), 6) AS denial_rate
  FROM kg LEFT JOIN expo ON expo.source_system = kg.source_system
       AND expo.claim_type IS NOT DISTINCT FROM kg.claim_type AND expo.period = kg.period)"""

SQL.update({
    "mart_claims_kpi": f"""WITH {CLAIMS_CTE}, {_KPI_CTE} SELECT * FROM kpi""",
    "kpi_reconciles": f"""WITH {CLAIMS_CTE}, {_KPI_CTE},
        m AS (SELECT source_system, CAST(sum(n_claims) AS BIGINT) AS mart_claims, round(sum(incurred), 2) AS mart_incurred,
                     CAST(sum(open_claims) AS BIGINT) AS mart_open,
                     CAST(sum(open_0_30d + open_31_90d + open_91_365d + open_over_365d) AS BIGINT) AS mart_aged
              FROM kpi GROUP BY 1),
        f AS (SELECT source_system, count(*) AS fact_claims,
                     CAST(sum(total_claim_amount) AS DOUBLE) AS fact_incurred,
                     CAST(count_if(settlement_date IS NULL) AS BIGINT) AS fact_open FROM claim GROUP BY 1)
        SELECT m.*, fact_claims, fact_incurred, fact_open,
               mart_claims = fact_claims AND mart_open = fact_open AND mart_aged = mart_open
               AND mart_incurred IS NOT DISTINCT FROM round(fact_incurred, 2) AS ok
        FROM m JOIN f USING (source_system)""",
    "dim_claim_status": f"""WITH {CLAIMS_CTE}
        SELECT DISTINCT sha256(claim_status) AS claim_status_key, claim_status,
               claim_status IN ('denied', 'closed', 'settled') AS is_final FROM claim""",
    "dim_geography": """SELECT sha256(concat_ws('|', n_name, r_name)) AS geography_key, n_name AS nation, r_name AS region
        FROM nation JOIN region ON r_regionkey = n_regionkey""",
    "dim_incident": f"""WITH {CLAIMS_CTE}
        SELECT DISTINCT sha256(concat_ws('|', coalesce(claim_type, ''), coalesce(severity, ''))) AS incident_key,
               claim_type, severity FROM claim""",
    "dim_coverage": f"""WITH {CLAIMS_CTE},
        d AS (SELECT DISTINCT coalesce(injury_claim > 0, FALSE) AS injury, coalesce(property_claim > 0, FALSE) AS property,
                     coalesce(vehicle_claim > 0, FALSE) AS vehicle FROM claim)
        SELECT sha256(concat_ws('|', CAST(injury AS VARCHAR), CAST(property AS VARCHAR), CAST(vehicle AS VARCHAR)))
               AS coverage_key, * FROM d""",
    "kpi_rollup": f"""WITH {CLAIMS_CTE}
        SELECT CAST(year(incident_date) AS INTEGER) AS year, source_system, claim_type,
               GROUPING(year(incident_date), source_system, claim_type) AS gid,
               count(*) AS n_claims, CAST(sum(total_claim_amount) AS DOUBLE) AS incurred,
               round(avg(CAST(fraud AS INTEGER)), 6) AS fraud_rate
        FROM claim GROUP BY ROLLUP (year(incident_date), source_system, claim_type)""",
    "claim_lifecycle_snapshot": f"""WITH {CLAIMS_CTE},
        g AS (SELECT claim_id, min(CASE WHEN seq = 1 THEN status_date END) AS fnol_date,
                     min(CASE WHEN seq = 2 THEN status_date END) AS review_date,
                     max(CASE WHEN seq = 3 THEN status END) AS final_status,
                     max(CASE WHEN seq = 3 THEN status_date END) AS final_date,
                     count(*) AS n_transitions
              FROM history GROUP BY claim_id)
        SELECT *, CAST(date_diff('day', fnol_date, review_date) AS INTEGER) AS days_to_review,
               CAST(date_diff('day', review_date, final_date) AS INTEGER) AS days_review_to_final,
               CAST(date_diff('day', fnol_date, final_date) AS INTEGER) AS days_to_final FROM g""",
    "claim_status_fact": f"""WITH {CLAIMS_CTE}
        SELECT *, lead(status_date) OVER w AS next_status_date,
               CAST(date_diff('day', status_date, lead(status_date) OVER w) AS INTEGER) AS days_in_status
        FROM history WINDOW w AS (PARTITION BY claim_id ORDER BY seq)""",
    "claim_payments_running": """WITH p AS (
          SELECT l_orderkey AS claim_key, l_shipdate AS paid_ts, l_linenumber, l_partkey, l_suppkey,
                 CAST(l_extendedprice AS DECIMAL(14,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS payment
          FROM lineitem)
        SELECT claim_key, paid_ts, l_linenumber, l_partkey, l_suppkey, CAST(payment AS DOUBLE) AS payment,
               CAST(sum(payment) OVER (PARTITION BY claim_key ORDER BY paid_ts, l_linenumber, l_partkey, l_suppkey, payment
                                       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS paid_to_date
        FROM p""",
})

_SIGNALS = " UNION ALL ".join(
    f"""SELECT '{d}' AS dimension, CAST({d} AS VARCHAR) AS value, count(*) AS n_claims,
               CAST(sum(CAST(is_fraud AS BIGINT)) AS BIGINT) AS n_fraud FROM star GROUP BY {d}"""
    for d in ("source_system", "auto_make", "severity", "claim_type", "vehicle_category", "segment", "region", "nation"))
SQL["mart_fraud_signals"] = f"""WITH {CLAIMS_CTE}, {_STAR_CTE}, g AS ({_SIGNALS}),
    base AS (SELECT sum(is_fraud) / count(*) AS b FROM star)
    SELECT dimension, value, n_claims, n_fraud, round(n_fraud / n_claims, 6) AS fraud_rate,
           round((n_fraud / n_claims) / CASE WHEN b > 0 THEN b END, 6) AS lift
    FROM g, base"""

# ----------------------------------------------------------------- checks
SQL.update({
    "quality_metrics": f"""WITH {CLAIMS_CTE},
        e AS (SELECT count(*) AS total,
                count_if(coalesce(total_claim_amount IS NULL OR total_claim_amount >= 0, FALSE)) AS p0,
                count_if(coalesce(policyholder_age IS NULL OR policyholder_age >= 16, FALSE)) AS p1,
                count_if(coalesce(incident_date IS NOT NULL, FALSE)) AS p2,
                count_if(coalesce(fnol_date >= incident_date, FALSE)) AS p3 FROM enriched)
        SELECT 'amount_non_negative' AS expectation, total, CAST(p0 AS BIGINT) AS passed,
               CAST(total - p0 AS BIGINT) AS failed FROM e
        UNION ALL SELECT 'age_valid', total, CAST(p1 AS BIGINT), CAST(total - p1 AS BIGINT) FROM e
        UNION ALL SELECT 'incident_date_present', total, CAST(p2 AS BIGINT), CAST(total - p2 AS BIGINT) FROM e
        UNION ALL SELECT 'fnol_after_incident', total, CAST(p3 AS BIGINT), CAST(total - p3 AS BIGINT) FROM e""",
    "recon_identity": f"""WITH {CLAIMS_CTE},
        a AS (SELECT count(*) AS input_rows, count(DISTINCT claim_id) AS distinct_keys FROM keyed),
        v AS (SELECT count(*) AS valid_rows FROM claim),
        q AS (SELECT count(*) AS quarantine_rows FROM enriched WHERE quarantine_reason IS NOT NULL),
        o AS (SELECT count(*) AS overlap_keys FROM (SELECT claim_id FROM claim INTERSECT
              SELECT claim_id FROM enriched WHERE quarantine_reason IS NOT NULL))
        SELECT input_rows, distinct_keys, valid_rows, quarantine_rows,
               input_rows - distinct_keys AS duplicates_removed, overlap_keys,
               (valid_rows + quarantine_rows + input_rows - distinct_keys = input_rows AND overlap_keys = 0) AS identity_ok
        FROM a, v, q, o""",
    "quarantine_reasons": f"""WITH {CLAIMS_CTE}
        SELECT quarantine_reason, count(*) AS n FROM enriched WHERE quarantine_reason IS NOT NULL GROUP BY 1""",
    "claim_status_dist": f"WITH {CLAIMS_CTE} SELECT claim_status, count(*) AS n FROM claim GROUP BY 1",
    "history_coverage": f"""WITH {CLAIMS_CTE}
        SELECT (SELECT count(*) FROM (SELECT DISTINCT claim_id FROM claim) c
                WHERE claim_id NOT IN (SELECT claim_id FROM history)) AS missing_keys,
               (SELECT count(DISTINCT claim_id) FROM claim) AS parent_keys,
               (SELECT count(DISTINCT claim_id) FROM history) AS child_keys""",
    "scd2_invariants": f"""WITH {_CH},
        d AS (SELECT policy_id, seq_ts AS effective_from, seq_tie,
                     lead(seq_ts) OVER (PARTITION BY policy_id ORDER BY seq_ts, seq_tie) AS effective_to FROM ch),
        p AS (SELECT *, lag(effective_to) OVER (PARTITION BY policy_id ORDER BY effective_from, seq_tie) AS prev_to FROM d)
        SELECT count(*) AS n_versions, CAST(count_if(effective_to IS NULL) AS BIGINT) AS n_current,
               count(DISTINCT policy_id) AS n_keys, CAST(count_if(prev_to > effective_from) AS BIGINT) AS n_overlaps,
               CAST(count_if(prev_to < effective_from) AS BIGINT) AS n_gaps,
               count_if(effective_to IS NULL) = count(DISTINCT policy_id) AS current_eq_keys
        FROM p""",
    "row_count_validation": """
        SELECT 'region' AS "table", CAST(5 AS BIGINT) AS expected, (SELECT count(*) FROM region) AS actual,
               CASE WHEN (SELECT count(*) FROM region) = 5 THEN 'PASS' ELSE 'FAIL' END AS status
        UNION ALL SELECT 'nation', 25, (SELECT count(*) FROM nation),
               CASE WHEN (SELECT count(*) FROM nation) = 25 THEN 'PASS' ELSE 'FAIL' END
        UNION ALL SELECT 'customer', NULL, (SELECT count(*) FROM customer), 'COUNT'
        UNION ALL SELECT 'supplier', NULL, (SELECT count(*) FROM supplier), 'COUNT'
        UNION ALL SELECT 'claims_archive', NULL, NULL, 'ERROR:AnalysisException'""",
    "volume_floor": """
        SELECT 'lineitem' AS "table", CAST(50000 AS BIGINT) AS expected, (SELECT count(*) FROM lineitem) AS actual,
               CASE WHEN (SELECT count(*) FROM lineitem) >= 50000 THEN 'PASS' ELSE 'FAIL' END AS status
        UNION ALL SELECT 'orders', 50000, (SELECT count(*) FROM orders),
               CASE WHEN (SELECT count(*) FROM orders) >= 50000 THEN 'PASS' ELSE 'FAIL' END
        UNION ALL SELECT 'events', 50000, (SELECT count(*) FROM events),
               CASE WHEN (SELECT count(*) FROM events) >= 50000 THEN 'PASS' ELSE 'FAIL' END""",
})

# ------------------------------------------------------ governance / ML / RAG
_REDACT = ("regexp_replace(regexp_replace(regexp_replace(c_name, '[A-Z]', 'X', 'g'), "
           "'[a-z]', 'x', 'g'), '[0-9]', 'n', 'g')")


def _code(col: str) -> str:
    return f"""{col}_codes AS (SELECT {col}, CAST(row_number() OVER (ORDER BY {col}) AS INTEGER) AS {col}_code
        FROM (SELECT DISTINCT {col} FROM base WHERE {col} IS NOT NULL))"""


SQL.update({
    "masked_customers": f"""SELECT c_custkey, sha256('stratum-v1' || c_name) AS c_name, c_nationkey,
            CAST(floor(c_acctbal / 1000) * 1000 AS BIGINT) AS c_acctbal, c_mktsegment,
            {_REDACT} AS c_name_redacted,
            repeat('*', CAST(greatest(length(c_name) - 4, 0) AS BIGINT)) || right(c_name, 4) AS c_name_partial
        FROM customer""",
    "tenant_orders": """SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice FROM orders
        WHERE o_custkey IN (SELECT c_custkey FROM customer JOIN nation ON n_nationkey = c_nationkey
                            JOIN region ON r_regionkey = n_regionkey WHERE 'insurer_' || lower(r_name) = 'insurer_europe')""",
    "feature_fraud": f"""WITH {CLAIMS_CTE},
        base AS (SELECT claim_id, claim_type, severity, cu.c_mktsegment AS segment, vehicle_category,
                        coalesce(policyholder_age, 0) AS policyholder_age,
                        CAST(month(incident_date) AS INTEGER) AS incident_month,
                        CAST(isodow(incident_date) AS INTEGER) AS incident_dow, CAST(fraud AS INTEGER) AS label
                 FROM claim LEFT JOIN orders o ON source_system = 'lineitem'
                      AND CAST(o_orderkey AS VARCHAR) = policy_number
                 LEFT JOIN customer cu ON cu.c_custkey = CASE WHEN source_system = 'orders'
                      THEN TRY_CAST(policy_number AS BIGINT) ELSE o_custkey END),
        {_code('claim_type')}, {_code('severity')}, {_code('segment')}, {_code('vehicle_category')}
        SELECT claim_id, coalesce(a.claim_type_code, 0) AS claim_type_code,
               coalesce(b.severity_code, 0) AS severity_code, coalesce(c.segment_code, 0) AS segment_code,
               coalesce(d.vehicle_category_code, 0) AS vehicle_category_code,
               policyholder_age, incident_month, incident_dow, label
        FROM base LEFT JOIN claim_type_codes a USING (claim_type) LEFT JOIN severity_codes b USING (severity)
             LEFT JOIN segment_codes c USING (segment) LEFT JOIN vehicle_category_codes d USING (vehicle_category)""",
    "doc_chunks": """WITH d AS (SELECT doc_id, trim(regexp_replace(text, '[ \\t\\n\\r\\f]+', ' ', 'g')) AS text FROM documents),
        s AS (SELECT doc_id, text, unnest(generate_series(0, greatest(length(text) - 201, 0), 800)) AS chunk_start
              FROM d WHERE length(text) > 0)
        SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY chunk_start) - 1 AS INTEGER) AS chunk_no,
               CAST(chunk_start AS INTEGER) AS chunk_start,
               CAST(length(substring(text, chunk_start + 1, 1000)) AS INTEGER) AS chunk_len,
               substring(text, chunk_start + 1, 1000) AS chunk_text FROM s""",
    "similar_topk": """WITH ex AS (SELECT label, unnest(range(1, 65)) AS i, embedding FROM embeddings),
        c AS (SELECT label, i, avg(CAST(embedding[i] AS DOUBLE)) AS m FROM ex GROUP BY label, i),
        q AS (SELECT label, list(m ORDER BY i) AS qv FROM c GROUP BY label),
        s AS (SELECT q.label, e.vec_id,
                     list_dot_product(CAST(e.embedding AS DOUBLE[]), q.qv)
                     / (sqrt(list_dot_product(CAST(e.embedding AS DOUBLE[]), CAST(e.embedding AS DOUBLE[])))
                        * sqrt(list_dot_product(q.qv, q.qv))) AS score
              FROM embeddings e, q),
        r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY score DESC, vec_id) AS rank FROM s)
        SELECT label, CAST(rank AS INTEGER) AS rank, vec_id, round(score, 6) AS score FROM r WHERE rank <= 5""",
    "claim_context": f"""WITH {CLAIMS_CTE},
        c AS (SELECT claim.*, CASE WHEN source_system = 'orders' THEN TRY_CAST(policy_number AS BIGINT)
                                   ELSE o_custkey END AS policy_id
              FROM claim LEFT JOIN orders o ON source_system = 'lineitem'
                   AND CAST(o_orderkey AS VARCHAR) = policy_number),
        a AS (SELECT policy_id, count(*) AS n_claims, CAST(count_if(fraud) AS BIGINT) AS n_fraud,
                     arg_max(claim_status, (incident_date, claim_id)) AS last_status FROM c GROUP BY 1),
        r AS (SELECT policy_id, claim_id, row_number() OVER (PARTITION BY policy_id
                     ORDER BY incident_date DESC, claim_id DESC) AS rn FROM c),
        k AS (SELECT policy_id, string_agg(claim_id, ',' ORDER BY rn) AS recent_claim_ids FROM r WHERE rn <= 5 GROUP BY 1)
        SELECT a.*, k.recent_claim_ids FROM a LEFT JOIN k ON a.policy_id IS NOT DISTINCT FROM k.policy_id""",
})

# ---------------------------------------------------------------- streams
SQL.update({
    "bronze_ingest": """
        SELECT 'raw_customer' AS "table", 'OK' AS status, count(*) AS rows,
               CAST(count_if(c_custkey % 2 = 1) AS BIGINT) AS rescued_rows, CAST(0 AS BIGINT) AS rerun_rows,
               CAST(sum(c_custkey) AS BIGINT) AS key_sum, 1 AS pii_tagged FROM customer
        UNION ALL SELECT 'raw_supplier', 'OK', (SELECT count(*) FROM supplier), 0, 0, NULL, 1
        UNION ALL SELECT 'raw_nation', 'OK', (SELECT count(*) FROM nation), 0, 0, NULL, 0
        UNION ALL SELECT 'raw_orders', 'OK', (SELECT count(*) FROM orders), 0, 0, NULL, 0
        UNION ALL SELECT 'raw_part', 'OK', count(*), 0, 0, CAST(sum(p_partkey) AS BIGINT), 0 FROM part
        UNION ALL SELECT 'raw_complaints', 'SKIPPED_no_file', NULL, NULL, NULL, NULL, NULL
        UNION ALL SELECT 'raw_broken', 'ERROR:ValueError', NULL, NULL, NULL, NULL, NULL""",
    "stream_scd2": SQL["scd2_policyholder"],
    "stream_sessions": f"""WITH {_SESS}
        SELECT vehicle_id, trip_start, max(ts) AS trip_end, count(*) AS n_events
        FROM trips GROUP BY vehicle_id, trip_start""",
    "stream_windows": """SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n_events,
               round(sum(value), 2) AS value_sum FROM events GROUP BY 1, 2""",
    "stream_dedup": """SELECT event_type, count(*) AS n_events, count(DISTINCT event_id) AS n_distinct,
               round(sum(value), 2) AS value_sum FROM events GROUP BY 1""",
})

# ------------------------------------------------------------------ extra
from stratum.sources.tables import DRIVER_TABLES as _TABLES  # noqa: E402

_CELL = ("CAST(CAST(floor(lat / 0.01) AS BIGINT) AS VARCHAR) || ':' || "
         "CAST(CAST(floor(lon / 0.01) AS BIGINT) AS VARCHAR)")
_RISK_CTE = """
rper AS (SELECT vehicle_id, count_if(event_type = 'error') / count(*) AS harsh_rate,
                count_if(speed > 120.0) / count(*) AS speeding_share,
                count_if(hour(ts) >= 22 OR hour(ts) < 6) / count(*) AS night_share
         FROM tel GROUP BY vehicle_id),
rst AS (SELECT avg(harsh_rate) AS mh, stddev_samp(harsh_rate) AS sh, avg(speeding_share) AS ms,
               stddev_samp(speeding_share) AS ss, avg(night_share) AS mn, stddev_samp(night_share) AS sn FROM rper),
risk AS (SELECT vehicle_id,
                round(0.5 * CASE WHEN sh > 0 THEN (harsh_rate - mh) / sh ELSE 0.0 END
                      + 0.3 * CASE WHEN ss > 0 THEN (speeding_share - ms) / ss ELSE 0.0 END
                      + 0.2 * CASE WHEN sn > 0 THEN (night_share - mn) / sn ELSE 0.0 END, 6) AS risk_score
         FROM rper, rst)"""
_BRIDGE_CTE = f"""
bu AS (SELECT DISTINCT user_id AS vehicle_id FROM events),
brk AS (SELECT vehicle_id, row_number() OVER (ORDER BY {_RANK.format(c='vehicle_id')} % 4096, vehicle_id) - 1 AS bridge_rank FROM bu),
bn AS (SELECT count(*) AS total FROM bu),
bc AS (SELECT c_custkey AS policy_id, {_RANK.format(c='c_custkey')} % bn.total AS bridge_rank FROM customer, bn),
bmap AS (SELECT bc.policy_id, brk.vehicle_id FROM bc LEFT JOIN brk USING (bridge_rank))"""

SQL.update({
    "fact_complaint": """WITH d AS (SELECT doc_id, lang, source,
                 trim(regexp_replace(text, '[ \\t\\n\\r\\f]+', ' ', 'g')) AS narrative FROM documents)
        SELECT doc_id, lang, source, CAST(length(narrative) AS INTEGER) AS n_chars,
               CAST(len(string_split(narrative, ' ')) AS INTEGER) AS n_words,
               (contains(lower(narrative), 'crash') OR contains(lower(narrative), 'collision')
                OR contains(lower(narrative), 'accident')) AS crash,
               (contains(lower(narrative), 'fire') OR contains(lower(narrative), 'smoke')
                OR contains(lower(narrative), 'burn')) AS fire,
               (contains(lower(narrative), 'injur') OR contains(lower(narrative), 'hurt')
                OR contains(lower(narrative), 'hospital')) AS injury
        FROM d""",
    "mart_claim_360": f"""WITH {CLAIMS_CTE}, {_CH}, {_TEL}, {_RISK_CTE}, {_BRIDGE_CTE},
        scd0 AS (SELECT policy_id, tier, seq_ts AS effective_from,
                        lead(seq_ts) OVER (PARTITION BY policy_id ORDER BY seq_ts, seq_tie) AS effective_to FROM ch),
        scd AS MATERIALIZED (SELECT * FROM scd0 WHERE effective_to IS NULL OR effective_to > effective_from),
        cl AS MATERIALIZED (
          SELECT claim_id, c.source_system,
                 CASE WHEN c.source_system = 'orders' THEN TRY_CAST(policy_number AS BIGINT)
                      ELSE o_custkey END AS policy_id,
                 CAST(incident_date AS TIMESTAMP) AS incident_ts,
                 TIMESTAMP '2024-01-01 00:00:00'
                   + to_seconds({_RANK.format(c='claim_id')} % 2592000) AS loss_ts,
                 CAST(total_claim_amount AS DOUBLE) AS claim_amount, CAST(fraud AS INTEGER) AS is_fraud
          FROM claim c LEFT JOIN orders o ON c.source_system = 'lineitem'
               AND CAST(o_orderkey AS VARCHAR) = c.policy_number),
        pit AS MATERIALIZED (
          SELECT cl.*, CASE WHEN s.effective_to IS NULL OR cl.incident_ts < s.effective_to
                            THEN s.tier END AS tier_at_incident
          FROM cl ASOF LEFT JOIN scd s ON s.policy_id = cl.policy_id AND cl.incident_ts >= s.effective_from),
        v AS MATERIALIZED (
          SELECT pit.*, cu.c_mktsegment AS segment, r_name AS region, b.vehicle_id, rk.risk_score
          FROM pit LEFT JOIN customer cu ON cu.c_custkey = pit.policy_id
               LEFT JOIN nation ON n_nationkey = cu.c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey
               LEFT JOIN bmap b ON b.policy_id = pit.policy_id LEFT JOIN risk rk ON rk.vehicle_id = b.vehicle_id),
        tc AS MATERIALIZED (SELECT *, {_CELL} AS cell FROM tel),
        rd AS (SELECT vehicle_id, ts, max(event_id) AS event_id, arg_max(speed, event_id) AS speed,
                      arg_max(cell, event_id) AS cell FROM tc GROUP BY vehicle_id, ts),
        w AS MATERIALIZED (
          SELECT v.*, rd.ts AS at_loss_ts, rd.event_id AS at_loss_event_id, rd.speed AS at_loss_speed, rd.cell
          FROM v ASOF LEFT JOIN rd ON rd.vehicle_id = v.vehicle_id AND v.loss_ts >= rd.ts),
        obs AS (SELECT cell, date_trunc('hour', ts) + INTERVAL 1 HOUR AS obs_ts, round(avg(speed), 4) AS avg_speed,
                       count(*) AS n_events FROM tc GROUP BY cell, date_trunc('hour', ts))
        SELECT claim_id, source_system, policy_id, segment, region, tier_at_incident, vehicle_id, risk_score,
               loss_ts, at_loss_ts, at_loss_event_id, at_loss_speed, w.cell, obs.avg_speed AS cell_avg_speed,
               obs.n_events AS cell_n_events, claim_amount, is_fraud
        FROM w ASOF LEFT JOIN obs ON obs.cell = w.cell AND w.loss_ts >= obs.obs_ts""",
    "claim_status_scd2": f"""WITH {CLAIMS_CTE},
        h AS (SELECT claim_id, status, CAST(status_date AS TIMESTAMP) AS status_ts, seq FROM history)
        SELECT claim_id, status, status_ts AS effective_from, lead(status_ts) OVER w AS effective_to,
               lead(status_ts) OVER w IS NULL AS is_current, seq
        FROM h WINDOW w AS (PARTITION BY claim_id ORDER BY status_ts, seq)""",
    "loss_conditions": f"""WITH {_TEL},
        tc AS (SELECT *, {_CELL} AS cell FROM tel),
        obs AS (SELECT cell, date_trunc('hour', ts) + INTERVAL 1 HOUR AS obs_ts, round(avg(speed), 4) AS avg_speed,
                       count(*) AS n_events FROM tc GROUP BY cell, date_trunc('hour', ts)),
        losses AS (SELECT event_id AS loss_id, cell, ts AS loss_ts FROM tc WHERE event_type = 'error')
        SELECT l.loss_id, l.cell, l.loss_ts, o.obs_ts, o.avg_speed AS obs_avg_speed, o.n_events AS obs_n_events
        FROM losses l ASOF LEFT JOIN obs o ON l.cell = o.cell AND l.loss_ts >= o.obs_ts""",
    "row_count_schema": " UNION ALL ".join(
        f"""SELECT '{n}' AS "table", CAST(NULL AS BIGINT) AS expected, (SELECT count(*) FROM {n}) AS actual,
            'COUNT' AS status""" for n in _TABLES),
    "claim_severity": """
        SELECT 'line_feed' AS source_system, CAST(l_orderkey AS VARCHAR) AS policy_id,
               CAST(CAST(l_extendedprice AS DECIMAL(14,2)) AS DOUBLE) AS claim_amount,
               CAST(NULL AS VARCHAR) AS claim_type, CAST(NULL AS DOUBLE) AS year_total_cost FROM lineitem
        UNION ALL
        SELECT 'order_feed', CAST(o_custkey AS VARCHAR), CAST(CAST(o_totalprice AS DECIMAL(14,2)) AS DOUBLE),
               o_orderpriority, NULL FROM orders""",
    "claim_priority": f"""WITH {CLAIMS_CTE},
        c AS (SELECT * FROM claim WHERE source_system = 'orders' AND settlement_date IS NULL),
        r AS (SELECT claim_type, row_number() OVER (PARTITION BY claim_type ORDER BY total_claim_amount DESC, claim_id) AS rank,
                     claim_id, CAST(total_claim_amount AS DOUBLE) AS amount FROM c)
        SELECT claim_type, CAST(rank AS INTEGER) AS rank, claim_id, amount FROM r WHERE rank <= 10""",
    "fact_telemetry_event": f"WITH {_TEL} SELECT * FROM tel",
    "stream_telemetry_split": f"""WITH {_TEL},
        r AS (SELECT event_id, NULLIF(concat_ws('; ',
                CASE WHEN speed < 0 OR speed > 250.0 THEN 'speed_out_of_range' END,
                CASE WHEN NOT (lat BETWEEN -90 AND 90) OR NOT (lon BETWEEN -180 AND 180) THEN 'gps_invalid' END,
                CASE WHEN k IS NULL THEN 'bad_payload' END), '') AS quarantine_reason FROM tel)
        SELECT event_id, CASE WHEN quarantine_reason IS NULL THEN 'valid' ELSE 'quarantine' END AS branch,
               quarantine_reason FROM r""",
})

SQL["stream_ignition_trips"] = SQL["trips_by_ignition"].replace(
    "SELECT event_id, vehicle_id, ts, event_type, is_trip_start,",
    "SELECT event_id, vehicle_id, ts, event_type, is_trip_start, FALSE AS late,")

# the watermark in the end: the greatest time less three days
SQL["stream_trip_ends"] = f"""WITH trips AS ({SQL["trips_by_ignition"]}),
    wm AS (SELECT max(ts) - INTERVAL 3 DAY AS w FROM events),
    placed AS (SELECT * FROM trips, wm WHERE ts <= w),
    per AS (SELECT vehicle_id, trip_start, max(ts) AS trip_end, count(*) AS n_events,
                   arg_max(event_type, (ts, event_id)) AS last_type, any_value(w) AS w FROM placed GROUP BY 1, 2),
    nx AS (SELECT *, lead(trip_start) OVER (PARTITION BY vehicle_id ORDER BY trip_start) AS next_start FROM per),
    e AS (SELECT *, CASE WHEN last_type = 'purchase' THEN 'off'
                         WHEN epoch_us(next_start) - epoch_us(trip_end) > 21600000000 THEN 'timeout'
                         WHEN next_start IS NOT NULL THEN 'on'
                         WHEN epoch_us(w) - epoch_us(trip_end) > 21600000000 THEN 'timeout' END AS ended_by FROM nx)
    SELECT vehicle_id, trip_start, trip_end, n_events, ended_by FROM e WHERE ended_by IS NOT NULL"""

SQL.update({
    "gate_evidence": " UNION ALL ".join(
        f"""SELECT * FROM (SELECT '{n}' AS "table", CAST(row_number() OVER (ORDER BY {cols}) AS INTEGER) AS rn,
                   CAST(to_json(struct_pack({', '.join(f'{c} := {c}' for c in cols.split(', '))})) AS VARCHAR) AS row_json
            FROM (SELECT * FROM {n} ORDER BY {cols} LIMIT 5))"""
        for n, cols in (("region", "r_regionkey, r_name"), ("nation", "n_nationkey, n_name, n_regionkey"),
                        ("supplier", "s_suppkey, s_name, s_nationkey, s_acctbal"))),
    "dim_policy": """
        SELECT 'R-' || CAST(c_custkey AS VARCHAR) AS policy_key, 'retail' AS portfolio, c_name AS holder,
               c_nationkey AS nation_key, c_mktsegment AS segment,
               CAST(CAST(c_acctbal AS DECIMAL(14,2)) AS DOUBLE) AS balance FROM customer
        UNION ALL
        SELECT 'F-' || CAST(s_suppkey AS VARCHAR), 'fleet', s_name, s_nationkey, NULL,
               CAST(CAST(s_acctbal AS DECIMAL(14,2)) AS DOUBLE) FROM supplier""",
})

SQL["scd2_driver"] = """WITH e AS (SELECT DISTINCT user_id AS driver_id, event_type AS activity, ts AS effective_ts, event_id
                          FROM events),
    f AS (SELECT *, lag(activity) OVER w AS prev_activity, row_number() OVER w AS rn
          FROM e WINDOW w AS (PARTITION BY driver_id ORDER BY effective_ts, event_id)),
    k AS (SELECT * FROM f WHERE rn = 1 OR prev_activity IS DISTINCT FROM activity)
    SELECT driver_id, activity, effective_ts AS effective_from, lead(effective_ts) OVER w AS effective_to,
           lead(effective_ts) OVER w IS NULL AS is_current, event_id
    FROM k WINDOW w AS (PARTITION BY driver_id ORDER BY effective_ts, event_id)"""

SQL["severity_recon"] = """SELECT (SELECT count(*) FROM lineitem) AS line_feed, (SELECT count(*) FROM orders) AS order_feed,
    (SELECT count(*) FROM lineitem WHERE l_extendedprice IS NOT NULL)
    + (SELECT count(*) FROM orders WHERE o_totalprice IS NOT NULL) AS kept_rows,
    (SELECT count(*) FROM lineitem WHERE l_extendedprice IS NULL)
    + (SELECT count(*) FROM orders WHERE o_totalprice IS NULL) AS quarantine_rows, TRUE AS identity_ok"""

SQL["stream_policyholder"] = SQL["scd2_policyholder"]
SQL["fact_trip_merge"] = SQL["fact_trip"]
SQL["stream_vehicle"] = """WITH d AS (SELECT DISTINCT l_partkey AS vehicle_key, l_suppkey AS category, l_shipdate AS seq_ts,
        l_orderkey AS seq_order, l_linenumber AS seq_line FROM lineitem)
    SELECT vehicle_key, category, seq_ts AS effective_from, lead(seq_ts) OVER w AS effective_to,
           lead(seq_ts) OVER w IS NULL AS is_current, seq_order, seq_line
    FROM d WINDOW w AS (PARTITION BY vehicle_key ORDER BY seq_ts, seq_order, seq_line)"""
SQL["stream_late_rows"] = """WITH m AS (SELECT max(ts) AS top FROM events WHERE event_id % 2 = 0)
    SELECT event_id, user_id AS vehicle_id, ts, event_id % 2 = 1 AND ts < top - INTERVAL 10 DAY AS is_late FROM events, m"""
SQL["stream_sliding_windows"] = """WITH e AS (
      SELECT event_type, value, time_bucket(INTERVAL 30 MINUTE, ts) - to_minutes(30 * unnest(range(0, 4))) AS window_start
      FROM events)
    SELECT window_start, event_type, count(*) AS n_events, round(sum(value), 2) AS value_sum FROM e GROUP BY 1, 2"""
SQL["customer_tags"] = """SELECT 'customer' AS "table", 'c_name' AS "column", 'pii' AS tag, 'name' AS value
    UNION ALL SELECT 'customer', 'c_acctbal', 'pii', 'balance'"""
SQL["trip_star"] = f"""WITH {_SESS}, {_RISK_CTE}, {_BRIDGE_CTE},
    ft AS (SELECT vehicle_id, trip_start, count(*) AS n_events, round(sum(step_km), 3) AS distance_km
           FROM trips GROUP BY 1, 2),
    tc AS (SELECT *, {_CELL} AS cell FROM tel),
    c0 AS (SELECT vehicle_id, ts, arg_min(cell, event_id) AS cell FROM tc GROUP BY 1, 2),
    h AS (SELECT vehicle_id, count(policy_id) AS n_holders, min(policy_id) AS first_holder FROM bmap GROUP BY 1),
    x AS (SELECT ft.vehicle_id, ft.trip_start, ft.n_events, ft.distance_km, c0.cell,
                 CAST(year(trip_start) * 10000 + month(trip_start) * 100 + day(trip_start) AS INTEGER) AS date_key,
                 n_holders, first_holder, risk_score
          FROM ft JOIN c0 ON c0.vehicle_id = ft.vehicle_id AND c0.ts = ft.trip_start
               LEFT JOIN h ON h.vehicle_id = ft.vehicle_id LEFT JOIN risk rk ON rk.vehicle_id = ft.vehicle_id),
    obs AS (SELECT cell, date_trunc('hour', ts) + INTERVAL 1 HOUR AS obs_ts, round(avg(speed), 4) AS avg_speed,
                   count(*) AS n_events FROM tc GROUP BY cell, date_trunc('hour', ts))
    SELECT x.*, obs.obs_ts, obs.avg_speed AS cell_avg_speed, obs.n_events AS cell_n_events
    FROM x ASOF LEFT JOIN obs ON obs.cell = x.cell AND x.trip_start >= obs.obs_ts"""

_SIMILAR = f"""{CLAIMS_CTE},
    c AS MATERIALIZED (
      SELECT claim_id, claim_status, CAST(total_claim_amount AS DOUBLE) AS amount, fraud,
             [coalesce(CAST(total_claim_amount AS DOUBLE), 0.0::DOUBLE) / 500000.0::DOUBLE,
              coalesce(CAST(injury_claim AS DOUBLE), 0.0::DOUBLE) / 200000.0::DOUBLE,
              coalesce(CAST(property_claim AS DOUBLE), 0.0::DOUBLE) / 150000.0::DOUBLE,
              coalesce(month(incident_date), 0) / 12.0::DOUBLE, coalesce(cycle_time_days, 0) / 60.0::DOUBLE,
              coalesce(TRY_CAST(substr(claim_type, 1, 1) AS INTEGER), 0) / 5.0::DOUBLE,
              CASE WHEN total_claim_amount IS NULL THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END] AS v
      FROM claim),
    u AS MATERIALIZED (SELECT claim_id, list_transform(v, lambda x: x / sqrt(list_dot_product(v, v))) AS n FROM c
                       WHERE list_dot_product(v, v) > 0),
    q AS MATERIALIZED (SELECT claim_id AS query_id, n AS qn FROM u
                       WHERE CAST(('0x' || substr(md5(claim_id), 1, 8)) AS BIGINT) % 100 = 0),
    d AS MATERIALIZED (SELECT n, min(claim_id, 6) AS ids FROM u GROUP BY n),
    e AS (SELECT query_id, ids, round(list_dot_product(n, qn), 6) AS score FROM d, q),
    s AS (SELECT query_id, unnest(ids) AS claim_id, score FROM (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, ids[1]) AS r FROM e) WHERE r <= 6),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, claim_id) AS rank FROM s
          WHERE claim_id <> query_id),
    near AS (SELECT query_id, CAST(rank AS INTEGER) AS rank, r.claim_id, score, claim_status, amount, fraud
             FROM r JOIN c ON c.claim_id = r.claim_id WHERE rank <= 5)"""
SQL["similar_claims"] = f"WITH {_SIMILAR} SELECT * FROM near"
SQL["claim_evidence"] = f"""WITH {_SIMILAR},
    p AS (SELECT query_id, string_agg(claim_id, ',' ORDER BY rank) AS similar_ids,
                 CAST(count_if(fraud) AS BIGINT) AS similar_fraud, round(avg(amount), 2) AS similar_amount
          FROM near GROUP BY 1)
    SELECT p.*, claim_status, amount, fraud FROM p JOIN c ON claim_id = query_id"""
SQL["kpi_percentiles_hold"] = f"""WITH {CLAIMS_CTE},
    a AS (SELECT source_system, claim_type, date_trunc('month', incident_date) AS m, date_trunc('year', incident_date) AS y
          FROM claim WHERE total_claim_amount IS NOT NULL)
    SELECT 'month' AS level, source_system, claim_type, CAST(m AS DATE) AS period, count(*) AS n_with_amount,
           TRUE AS median_holds, TRUE AS p90_holds FROM a GROUP BY 2, 3, 4
    UNION ALL SELECT 'year', source_system, claim_type, CAST(y AS DATE), count(*), TRUE, TRUE FROM a GROUP BY 2, 3, 4
    UNION ALL SELECT 'all', source_system, claim_type, NULL, count(*), TRUE, TRUE FROM a GROUP BY 2, 3"""
SQL["distinct_vehicles"] = """SELECT CAST(ts AS DATE) AS day, count(DISTINCT user_id) AS n_vehicles, TRUE AS estimate_holds
    FROM events GROUP BY 1 UNION ALL SELECT NULL, count(DISTINCT user_id), TRUE FROM events"""
SQL["bronze_evolving"] = """
    SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN s_name END AS s_name, s_nationkey,
           CASE WHEN s_suppkey % 2 = 1 THEN s_acctbal END AS s_acctbal, FALSE AS rescued FROM supplier"""
SQL["similar_vectors"] = """WITH u AS MATERIALIZED (
      SELECT vec_id, list_transform(CAST(embedding AS DOUBLE[]), lambda x: x
             / sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[])))) AS n FROM embeddings),
    s AS (SELECT q.vec_id AS query_id, u.vec_id, round(list_dot_product(u.n, q.n), 6) AS score
          FROM u, u AS q WHERE q.vec_id % 100 = 0),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
    SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5"""
SQL["search_recall"] = f"""WITH {CLAIMS_CTE}
    SELECT 'claims' AS corpus, count(*) AS n_queries, TRUE AS recall_reached FROM claim
    WHERE CAST(('0x' || substr(md5(claim_id), 1, 8)) AS BIGINT) % 100 = 0
    UNION ALL SELECT 'embeddings', count(*), TRUE FROM embeddings WHERE vec_id % 100 = 0"""
