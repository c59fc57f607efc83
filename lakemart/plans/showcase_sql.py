"""The showcase queries as SQL for another engine, over views of the same tables."""

from __future__ import annotations

# Named building blocks. Each may use those listed before it.
BLOCKS: dict[str, str] = {
    "trips_raw": """
        SELECT l_linenumber AS vendor_id, o_orderdate AS pickup_at, l_shipdate AS dropoff_at,
               c_nationkey AS pickup_location_id, s_nationkey AS dropoff_location_id,
               l_linenumber AS passenger_count, l_quantity AS trip_distance,
               CAST(left(o_orderpriority, 1) AS INTEGER) AS payment_type,
               l_extendedprice AS fare_amount, l_extendedprice * (l_discount + 0.0::DOUBLE) AS tip_amount,
               l_extendedprice * (l_tax + 0.0::DOUBLE) AS tolls_amount,
               l_extendedprice * (1::DOUBLE - (l_discount + 0.0::DOUBLE)) * (1::DOUBLE + (l_tax + 0.0::DOUBLE))
                   AS total_amount,
               l_linestatus
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey""",
    "trips_valid": """
        SELECT * EXCLUDE (l_linestatus), CAST(pickup_at AS DATE) AS trip_date,
               CAST(hour(pickup_at) AS INTEGER) AS pickup_hour,
               CAST(dayofweek(pickup_at) + 1 AS INTEGER) AS day_of_week, l_linestatus
        FROM trips_raw
        WHERE pickup_at IS NOT NULL AND dropoff_at IS NOT NULL AND pickup_at < dropoff_at
          AND trip_distance > 0 AND total_amount > 0""",
    "trips": """
        SELECT * EXCLUDE (l_linestatus) FROM trips_valid
        WHERE pickup_at >= TIMESTAMP '1995-02-01 00:00:00' AND pickup_at <= TIMESTAMP '2001-06-30 00:00:00'""",
    "zones": """
        SELECT n_nationkey AS location_id, r_name AS borough, n_name AS zone_name
        FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_name <> 'NATION_0'""",
    "all_zones": """
        SELECT n_nationkey AS location_id, r_name AS borough, n_name AS zone_name
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "measured": """
        SELECT t.*, round(CAST(date_diff('second', pickup_at, dropoff_at) AS DOUBLE) / 86400, 2)
                    AS trip_duration_minutes,
               CASE WHEN payment_type = 1 AND fare_amount > 0
                    THEN round(tip_amount / fare_amount * 100, 2) END AS tip_pct
        FROM trips t
        WHERE round(CAST(date_diff('second', pickup_at, dropoff_at) AS DOUBLE) / 86400, 2) BETWEEN 1 AND 300
          AND trip_distance <= 100""",
    "enriched": """
        SELECT m.*, pu.zone_name AS pickup_zone, pu.borough AS pickup_borough,
               dz.zone_name AS dropoff_zone, dz.borough AS dropoff_borough
        FROM measured m LEFT JOIN zones pu ON m.pickup_location_id = pu.location_id
        LEFT JOIN zones dz ON m.dropoff_location_id = dz.location_id""",
    "event_trips": """
        SELECT event_id AS vendor_id, ts AS pickup_at,
               ts + to_seconds(CAST(floor(value * 4) AS BIGINT) * 15) AS dropoff_at,
               user_id AS pickup_location_id, user_id AS dropoff_location_id,
               CAST(length(event_type) AS INTEGER) AS passenger_count,
               floor(value * 4) / 8 AS trip_distance,
               CASE event_type WHEN 'error' THEN 0 WHEN 'purchase' THEN 1 WHEN 'view' THEN 2
                               WHEN 'click' THEN 3 ELSE 4 END AS payment_type,
               value AS fare_amount, value * 0.1::DOUBLE AS tip_amount, 0.0::DOUBLE AS tolls_amount,
               value + value * 0.1::DOUBLE AS total_amount,
               CAST(ts AS DATE) AS trip_date, CAST(hour(ts) AS INTEGER) AS pickup_hour,
               CAST(dayofweek(ts) + 1 AS INTEGER) AS day_of_week
        FROM events""",
    "event_zones": """
        SELECT c_custkey AS location_id, c_mktsegment AS borough, c_name AS zone_name
        FROM customer WHERE c_acctbal >= 0""",
    "event_enriched": """
        SELECT t.*, date_diff('second', pickup_at, dropoff_at) / 60 AS trip_duration_minutes,
               CASE WHEN payment_type = 1 AND fare_amount > 0
                    THEN round(tip_amount / fare_amount * 100, 2) END AS tip_pct,
               pu.zone_name AS pickup_zone, pu.borough AS pickup_borough,
               dz.zone_name AS dropoff_zone, dz.borough AS dropoff_borough
        FROM event_trips t LEFT JOIN event_zones pu ON t.pickup_location_id = pu.location_id
        LEFT JOIN event_zones dz ON t.dropoff_location_id = dz.location_id
        WHERE pickup_at < dropoff_at AND trip_distance > 0 AND total_amount > 0
          AND pickup_at >= TIMESTAMP '2024-01-02 00:00:00' AND pickup_at <= TIMESTAMP '2024-01-29 00:00:00'
          AND date_diff('second', pickup_at, dropoff_at) BETWEEN 60 AND 18000 AND trip_distance <= 100""",
}

_STAGED = (
    "vendor_id, pickup_at, dropoff_at, pickup_location_id, dropoff_location_id, passenger_count, trip_distance, "
    "payment_type, fare_amount, tip_amount, tolls_amount, total_amount, trip_date, pickup_hour, day_of_week"
)
_ENRICHED = (
    f"{_STAGED}, trip_duration_minutes, tip_pct, pickup_zone, pickup_borough, dropoff_zone, dropoff_borough"
)
_DAILY = """
    SELECT trip_date, pickup_borough, count(*) AS total_trips,
           round(sum(fare_amount), 6) AS total_fare_usd, round(sum(tip_amount), 6) AS total_tips_usd,
           round(sum(total_amount), 6) AS total_revenue_usd,
           avg(trip_distance) AS avg_trip_distance_miles, avg(trip_duration_minutes) AS avg_trip_duration_min,
           avg(CASE WHEN payment_type = 1 THEN tip_pct END) AS avg_tip_pct_credit_card,
           CAST(sum(CASE WHEN payment_type = 1 THEN 1 ELSE 0 END) AS BIGINT) AS credit_card_trips,
           CAST(sum(CASE WHEN payment_type = 2 THEN 1 ELSE 0 END) AS BIGINT) AS cash_trips
    FROM {rows} GROUP BY trip_date, pickup_borough"""
_HOURLY = """
    SELECT trip_date, pickup_hour, pickup_borough, count(*) AS total_trips,
           avg(trip_duration_minutes) AS avg_duration_min, round(sum(total_amount), 6) AS total_revenue_usd
    FROM {rows} GROUP BY trip_date, pickup_hour, pickup_borough"""

TRIPS = ("trips_raw", "trips_valid", "trips")
ENRICHED = (*TRIPS, "zones", "measured", "enriched")
EVENTS = ("event_trips", "event_zones", "event_enriched")


def _with(blocks: tuple[str, ...], body: str, **extra: str) -> str:
    named = {**{b: BLOCKS[b] for b in blocks}, **extra}
    ctes = ",\n".join(f"{name} AS ({sql})" for name, sql in named.items())
    return f"WITH {ctes}\n{body}"


def _daily(rows: str = "enriched") -> str:
    return _DAILY.format(rows=rows)


_FULL_DAILY = _with(ENRICHED, _daily())
_OLDER = "(SELECT * FROM enriched WHERE trip_date <= DATE '2000-06-30' AND payment_type = 1)"
_NEWER = "(SELECT * FROM enriched WHERE trip_date > DATE '1998-06-30')"


def _merged(where: str, match: str) -> str:
    return _with(
        ENRICHED,
        f"""SELECT * FROM target t WHERE {where.format(a='t')} AND NOT EXISTS (
                SELECT 1 FROM source s WHERE {where.format(a='s')} AND s.trip_date = t.trip_date
                AND s.pickup_borough {match} t.pickup_borough)
            UNION ALL SELECT * FROM source s WHERE {where.format(a='s')}""",
        target=_daily(_OLDER),
        source=_daily(_NEWER),
    )


_REPLACED = _with(
    ENRICHED,
    f"""SELECT * FROM ({_daily()}) WHERE trip_date < DATE '{{low}}'
        UNION ALL {_daily("relabelled")}""",
    relabelled="""SELECT * REPLACE (coalesce(pickup_borough, 'UNKNOWN') AS pickup_borough)
                  FROM enriched WHERE trip_date >= DATE '{low}'""",
)
_NEWEST = "(SELECT max(trip_date) FROM trips)"

_STATES = {
    "s1": """SELECT c_custkey AS customer_id, c_mktsegment AS segment, c_nationkey AS nation_id, c_acctbal AS balance
             FROM customer""",
    "s2": "SELECT * REPLACE (CASE WHEN segment = 'HOUSEHOLD' THEN 'HOME' ELSE segment END AS segment) FROM s1",
    "s3": "SELECT * REPLACE (CASE WHEN balance >= 0 THEN segment END AS segment) FROM s2",
    "h1": """SELECT customer_id, segment, nation_id, TIMESTAMP '1996-01-01' AS valid_from,
                    CAST(NULL AS TIMESTAMP) AS valid_to, TIMESTAMP '1996-01-01' AS updated_at FROM s1""",
    "h2": """SELECT h.customer_id, h.segment, h.nation_id, h.valid_from,
                    CASE WHEN h.segment = 'HOUSEHOLD' THEN TIMESTAMP '1998-01-01' END AS valid_to, h.updated_at
             FROM h1 h
             UNION ALL SELECT customer_id, segment, nation_id, TIMESTAMP '1998-01-01', NULL, TIMESTAMP '1998-01-01'
             FROM s2 WHERE segment = 'HOME'""",
    "h3": """SELECT h.customer_id, h.segment, h.nation_id, h.valid_from,
                    CASE WHEN h.valid_to IS NULL AND s.balance < 0 THEN TIMESTAMP '2000-01-01'
                         ELSE h.valid_to END AS valid_to, h.updated_at
             FROM h2 h JOIN s1 s ON s.customer_id = h.customer_id
             UNION ALL SELECT customer_id, segment, nation_id, TIMESTAMP '2000-01-01', NULL, TIMESTAMP '2000-01-01'
             FROM s3 WHERE balance < 0""",
}


def _states(body: str) -> str:
    return _with((), body, **_STATES)


def _gone(valid_to: str) -> str:
    """Customers of one segment leave the source at the second snapshot."""
    return _states(f"SELECT * REPLACE (CAST({valid_to} AS TIMESTAMP) AS valid_to) FROM h1")


def _suite(only: str = "") -> str:
    def rows(table: str, test: str, relation: str, condition: str) -> str:
        return (
            f"SELECT '{table}' AS \"table\", '{test}' AS test, "
            f"CAST((SELECT count(*) FROM {relation} WHERE {condition}) AS BIGINT) AS failures"
        )

    parts = [
        rows("stg_trips", f"not_null:{c}", "trips", f"{c} IS NULL")
        for c in ("pickup_at", "dropoff_at", "trip_distance", "pickup_location_id", "total_amount")
    ]
    parts.append(rows("stg_trips", "accepted_values:payment_type", "trips", "payment_type NOT BETWEEN 0 AND 6"))
    parts.append(rows("stg_trips", "no_future:pickup_at", "trips", "pickup_at > TIMESTAMP '2001-01-01'"))
    parts += [rows("stg_zones", f"not_null:{c}", "zones", f"{c} IS NULL") for c in ("location_id", "borough")]
    parts.append(
        rows(
            "stg_zones",
            "accepted_values:borough",
            "zones",
            "borough NOT IN ('Manhattan','Queens','Brooklyn','Bronx','Staten Island','EWR','N/A','Unknown')",
        )
    )
    doubled = "(SELECT location_id FROM zones GROUP BY 1 HAVING count(*) > 1)"
    parts.append(rows("stg_zones", "unique:location_id", doubled, "true"))
    orphan = "pickup_location_id IS NOT NULL AND pickup_location_id NOT IN (SELECT location_id FROM zones)"
    parts.append(rows("stg_trips", "relationships:pickup_location_id", "trips", orphan))
    parts += [
        rows("fct_trips_daily", f"not_null:{c}", "mart", f"{c} IS NULL")
        for c in ("trip_date", "pickup_borough", "total_trips")
    ]
    doubled = "(SELECT trip_date, pickup_borough FROM mart GROUP BY ALL HAVING count(*) > 1)"
    parts.append(rows("fct_trips_daily", "unique_combination:trip_date,pickup_borough", doubled, "true"))
    parts = [p for p in parts if p.startswith(f"SELECT '{only}")]
    return _with(ENRICHED, " UNION ALL ".join(parts), mart=_daily())


_EVENT_STAGED = """SELECT * FROM event_trips WHERE pickup_at < dropoff_at AND trip_distance > 0 AND total_amount > 0
                   AND pickup_at >= TIMESTAMP '2024-01-02 00:00:00' AND pickup_at <= TIMESTAMP '2024-01-29 00:00:00'"""


def _warehouse_tests() -> str:
    def rows(table: str, test: str, relation: str, condition: str) -> str:
        return f"SELECT '{table}' AS \"table\", '{test}' AS test, count(*) AS failures FROM {relation} WHERE {condition}"

    null = {
        "stg_trips": ("trips", ("pickup_at", "dropoff_at", "trip_distance", "pickup_location_id", "total_amount")),
        "stg_zones": ("event_zones", ("location_id", "borough")),
        "fct_trips_daily": ("mart", ("trip_date", "pickup_borough", "total_trips")),
    }
    parts = [rows(t, f"not_null:{c}", r, f"{c} IS NULL") for t, (r, columns) in null.items() for c in columns]
    # The first build opens one version for each zone, with all its columns set.
    parts += [rows("zones_snapshot", f"not_null:{c}", "event_zones", "false") for c in ("location_id", "valid_from")]
    dimension = ("not_null:location_id", "not_null:zone_name", "not_null:effective_from", "unique:location_id")
    parts += [rows("dim_taxi_zones", test, "event_zones", "false") for test in dimension]
    parts += [
        rows("stg_trips", "accepted_values:payment_type", "trips", "payment_type NOT BETWEEN 0 AND 6"),
        rows("stg_trips", "no_future:pickup_at", "trips", "pickup_at > TIMESTAMP '2024-01-20 12:00:00'"),
        rows(
            "stg_trips",
            "relationships:pickup_location_id",
            "trips",
            "pickup_location_id NOT IN (SELECT location_id FROM event_zones)",
        ),
        rows(
            "stg_zones",
            "accepted_values:borough",
            "event_zones",
            "borough NOT IN ('Manhattan','Queens','Brooklyn','Bronx','Staten Island','EWR','N/A','Unknown')",
        ),
        rows("stg_zones", "unique:location_id", "event_zones", "false"),
        rows("fct_trips_daily", "unique_combination:trip_date,pickup_borough", "mart", "false"),
    ]
    return _with(EVENTS, " UNION ALL ".join(parts), trips=_EVENT_STAGED, mart=_daily("event_enriched"))


_CORRECTED = """SELECT * REPLACE (CASE WHEN tolls_amount = 0 THEN 1.0::DOUBLE ELSE tolls_amount END
                AS tolls_amount) FROM trips WHERE payment_type <> 5"""
_GAP_MART = "SELECT DISTINCT trip_date FROM enriched WHERE trip_date > DATE '1998-06-30'"

ORACLE: dict[str, str] = {
    "stg_trips": _with(TRIPS, f"SELECT {_STAGED} FROM trips"),
    "stg_zones": """SELECT c_custkey AS location_id, c_mktsegment AS borough, c_name AS zone_name,
                           CAST(c_nationkey AS VARCHAR) AS service_zone FROM customer WHERE c_acctbal >= 0""",
    "stg_events": """SELECT ts AS occurred_at, event_id, event_type, value, CAST(hour(ts) AS INTEGER) AS event_hour,
                            CAST(ts AS DATE) AS event_date
                     FROM events WHERE ts IS NOT NULL AND value > 1 AND event_type <> 'error'""",
    "trips_enriched": _with(ENRICHED, f"SELECT {_ENRICHED} FROM enriched"),
    "event_trips_enriched": _with(EVENTS, f"SELECT {_ENRICHED} FROM event_enriched"),
    "trips_enriched_as_of": _with(
        (*TRIPS, "zones", "measured"),
        f"SELECT {_ENRICHED} FROM enriched",
        enriched="""
            SELECT m.*,
              CASE WHEN m.pickup_at >= TIMESTAMP '1996-01-01' THEN pu.zone_name END AS pickup_zone,
              CASE WHEN m.pickup_at >= TIMESTAMP '1998-01-01' AND pu.borough = 'ASIA' THEN 'EUROPE'
                   WHEN m.pickup_at >= TIMESTAMP '1996-01-01' THEN pu.borough END AS pickup_borough,
              CASE WHEN m.dropoff_at >= TIMESTAMP '1996-01-01' THEN dz.zone_name END AS dropoff_zone,
              CASE WHEN m.dropoff_at >= TIMESTAMP '1998-01-01' AND dz.borough = 'ASIA' THEN 'EUROPE'
                   WHEN m.dropoff_at >= TIMESTAMP '1996-01-01' THEN dz.borough END AS dropoff_borough
            FROM measured m LEFT JOIN zones pu ON m.pickup_location_id = pu.location_id
            LEFT JOIN zones dz ON m.dropoff_location_id = dz.location_id""",
    ),
    "daily_mart": _with(
        (*TRIPS, "all_zones", "measured"),
        _daily(),
        enriched="""SELECT m.*, pu.borough AS pickup_borough FROM measured m
                    LEFT JOIN all_zones pu ON m.pickup_location_id = pu.location_id""",
    ),
    "daily_mart_null_borough": _FULL_DAILY,
    "daily_mart_audited": _with(
        ENRICHED,
        f"""SELECT *, TIMESTAMP '2001-07-01' AS _loaded_at, 'run-1' AS _run_id, 'fct_trips_daily' AS _model_name
            FROM ({_daily()})""",
    ),
    "event_daily_mart": _with(EVENTS, _daily("event_enriched")),
    "hourly_mart": _with(EVENTS, _HOURLY.format(rows="event_enriched")),
    "daily_from_rollup": _FULL_DAILY,
    "hourly_from_rollup": _with(EVENTS, _HOURLY.format(rows="event_enriched")),
    "watermark_window": _with(
        TRIPS,
        f"""SELECT {_STAGED} FROM trips WHERE trip_date >= (
            SELECT max(trip_date) - 3 FROM trips WHERE trip_date <= DATE '2000-06-30')""",
    ),
    "watermark_first_run": _with(TRIPS, f"SELECT {_STAGED} FROM trips"),
    "watermark_empty_target": _with(TRIPS, f"SELECT {_STAGED} FROM trips"),
    "watermark_zero_lookback": _with(
        TRIPS,
        f"""SELECT {_STAGED} FROM trips WHERE trip_date >= (
            SELECT max(trip_date) FROM trips WHERE trip_date <= DATE '2000-06-30')""",
    ),
    "merge_upsert": _merged("{a}.pickup_borough IS NOT NULL", "="),
    "merge_null_key": _merged("true", "IS NOT DISTINCT FROM"),
    "merge_plain_equality": _merged("true", "="),
    "replace_window": _REPLACED.replace("{low}", "2000-06-30"),
    "stored_replace_window": _REPLACED.replace("DATE '{low}'", "(SELECT max(trip_date) - 3 FROM enriched)"),
    "incremental_equals_full": _FULL_DAILY,
    "late_arrival_in_window": _FULL_DAILY,
    "old_arrival_ignored": _with(
        ENRICHED, _daily("(SELECT * FROM enriched WHERE trip_date > DATE '2000-06-30')")
    ),
    "backfill_widened": _FULL_DAILY,
    "backfill_intervals": _with(
        ENRICHED,
        _daily("(SELECT * FROM enriched WHERE NOT (trip_date = DATE '1997-08-08' AND payment_type = 1))"),
    ),
    "published_mart": _FULL_DAILY,
    "full_refresh": _FULL_DAILY,
    "hourly_incremental": _with(EVENTS, _HOURLY.format(rows="event_enriched")),
    "find_gap": _with(
        ENRICHED,
        """SELECT (SELECT min(trip_date) FROM trips) AS source_min, (SELECT max(trip_date) FROM trips) AS source_max,
                  (SELECT min(trip_date) FROM mart) AS target_min, (SELECT max(trip_date) FROM mart) AS target_max,
                  count(*) AS missing_dates, min(trip_date) AS oldest_missing,
                  CAST(greatest((SELECT max(trip_date) FROM mart) - min(trip_date), 0) AS INTEGER) AS lookback_days
           FROM (SELECT DISTINCT trip_date FROM trips) WHERE trip_date NOT IN (SELECT trip_date FROM mart)""",
        mart=_GAP_MART,
    ),
    "missing_dates": _with(
        ENRICHED,
        "SELECT DISTINCT trip_date FROM trips WHERE trip_date NOT IN (SELECT trip_date FROM enriched)",
    ),
    "date_range": _with(TRIPS, "SELECT min(trip_date) AS min_date, max(trip_date) AS max_date FROM trips"),
    "load_months": _with(
        ENRICHED,
        """SELECT CAST(date_trunc('month', trip_date) AS DATE) AS month, count(*) AS row_count,
                  min(loaded) AS first_loaded, max(loaded) AS last_loaded
           FROM (SELECT trip_date, CASE WHEN trip_date <= DATE '1998-06-30' THEN TIMESTAMP '2001-07-02'
                                        ELSE TIMESTAMP '2001-07-01' END AS loaded FROM mart)
           GROUP BY 1 ORDER BY 1""",
        mart=_daily(),
    ),
    "scd2_initial": _states("SELECT * FROM h1"),
    "scd2_change": _states("SELECT * FROM h2"),
    "scd2_null_change": _states("SELECT * FROM h3"),
    "scd2_missing_key": _gone("NULL"),
    "scd2_hard_deletes": _gone("CASE WHEN segment = 'HOUSEHOLD' THEN TIMESTAMP '1998-01-01' END"),
    "scd2_stored": _states("SELECT * FROM h3"),
    "scd2_current": _states(
        """SELECT customer_id, segment, nation_id, valid_from AS effective_from, updated_at AS last_changed_at
           FROM h3 WHERE valid_to IS NULL"""
    ),
    "scd2_as_of": _states(
        """SELECT o_orderkey, o_custkey, o_orderdate,
                  CASE WHEN o_orderdate >= TIMESTAMP '2000-01-01' THEN s3.segment
                       WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN s2.segment
                       WHEN o_orderdate >= TIMESTAMP '1996-01-01' THEN s1.segment END AS segment
           FROM orders LEFT JOIN s1 ON s1.customer_id = o_custkey LEFT JOIN s2 ON s2.customer_id = o_custkey
           LEFT JOIN s3 ON s3.customer_id = o_custkey"""
    ),
    "scd2_as_of_pruned": _states(
        """SELECT o_orderkey, o_custkey, o_orderdate,
                  CASE WHEN o_orderdate >= TIMESTAMP '2000-01-01' THEN s3.segment ELSE s2.segment END AS segment
           FROM orders LEFT JOIN s2 ON s2.customer_id = o_custkey LEFT JOIN s3 ON s3.customer_id = o_custkey
           WHERE o_orderdate >= TIMESTAMP '1998-01-01'"""
    ),
    "scd1_upsert": _states(
        """SELECT s1.customer_id,
                  CASE WHEN s2.segment = 'HOME' OR s1.nation_id < 5 THEN s2.segment ELSE s1.segment END AS segment,
                  CASE WHEN s2.segment = 'HOME' OR s1.nation_id < 5 THEN s1.nation_id + 100
                       ELSE s1.nation_id END AS nation_id
           FROM s1 JOIN s2 ON s1.customer_id = s2.customer_id"""
    ),
    "union_sources": _with(
        ("trips_raw", "trips_valid"),
        f"""SELECT {_STAGED}, CASE WHEN l_linestatus = 'O' THEN 'yellow' ELSE 'green' END AS source
            FROM trips_valid WHERE l_linestatus <> 'O' OR (
            pickup_at >= TIMESTAMP '1995-02-01' AND pickup_at <= TIMESTAMP '2001-06-30')""",
    ),
    "dq_not_null": _with(
        ENRICHED,
        """SELECT trip_date, pickup_location_id, total_amount, vendor_id
           FROM enriched WHERE pickup_borough IS NULL""",
    ),
    "dq_unique": """SELECT l_orderkey AS value, count(*) AS n_records FROM lineitem
                    WHERE l_orderkey IS NOT NULL GROUP BY 1 HAVING count(*) > 1""",
    "dq_accepted_values": """SELECT event_type AS value, count(*) AS n_records FROM events
                             WHERE event_type NOT IN ('view', 'click', 'signup') GROUP BY 1""",
    "dq_unique_combination": """SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem
                                GROUP BY 1, 2 HAVING count(*) > 1""",
    "dq_no_future": "SELECT * FROM events WHERE ts > TIMESTAMP '2024-01-20 12:00:00'",
    "dq_singular": _with(TRIPS, f"SELECT {_STAGED} FROM trips WHERE total_amount < fare_amount"),
    "dq_relationships": """SELECT o_custkey AS value, count(*) AS n_records FROM orders
                           WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0) GROUP BY 1""",
    "dq_freshness": """
        SELECT max_loaded_at, future_rows, age_hours,
               CASE WHEN age_hours > 49 THEN 'error' WHEN age_hours > 25 THEN 'warn' ELSE 'pass' END AS status
        FROM (SELECT max_loaded_at, future_rows,
                     (epoch_us(TIMESTAMP '2024-01-20 12:00:00') - epoch_us(max_loaded_at)) / 3600000000 AS age_hours
              FROM (SELECT max(ts) FILTER (WHERE ts <= TIMESTAMP '2024-01-20 12:00:00') AS max_loaded_at,
                           count(*) FILTER (WHERE ts > TIMESTAMP '2024-01-20 12:00:00') AS future_rows FROM events))""",
    "dq_freshness_with_future": """
        SELECT max_loaded_at, future_rows, age_hours,
               CASE WHEN age_hours > 49 THEN 'error' WHEN age_hours > 25 THEN 'warn' ELSE 'pass' END AS status
        FROM (SELECT max_loaded_at, future_rows,
                     (epoch_us(TIMESTAMP '2024-02-03') - epoch_us(max_loaded_at)) / 3600000000 AS age_hours
              FROM (SELECT max(ts) AS max_loaded_at,
                           count(*) FILTER (WHERE ts > TIMESTAMP '2024-02-03') AS future_rows FROM events))""",
    "dq_suite": _suite(),
    "dq_incremental": _suite("fct_trips_daily"),
    "reconcile_counts": _with(
        TRIPS,
        """SELECT (SELECT count(*) FROM trips) AS original_count,
                  (SELECT count(*) FROM trips WHERE payment_type <> 5) AS generated_count""",
    ),
    "reconcile_equal": _with(
        TRIPS,
        f"""SELECT {_STAGED}, CAST(0 AS BIGINT) AS original_copies, CAST(0 AS BIGINT) AS generated_copies
            FROM trips WHERE false""",
    ),
    "reconcile_diff": _with(
        TRIPS,
        f"""SELECT {_STAGED}, CAST(sum(o) AS BIGINT) AS original_copies, CAST(sum(g) AS BIGINT) AS generated_copies
            FROM (SELECT *, 1 AS o, 0 AS g FROM trips UNION ALL SELECT *, 0, 1 FROM corrected)
            GROUP BY ALL HAVING sum(o) <> sum(g)""",
        corrected=_CORRECTED,
    ),
    "reconcile_tree": _with(
        TRIPS,
        f"""SELECT {_STAGED}, CAST(sum(o) AS BIGINT) AS original_copies, CAST(sum(g) AS BIGINT) AS generated_copies
            FROM (SELECT *, 1 AS o, 0 AS g FROM trips UNION ALL SELECT *, 0, 1 FROM corrected)
            GROUP BY ALL HAVING sum(o) <> sum(g)""",
        corrected=_CORRECTED,
    ),
    "reconcile_numeric_types": """
        SELECT id, amount, CAST(sum(o) AS BIGINT) AS original_copies, CAST(sum(g) AS BIGINT) AS generated_copies
        FROM (SELECT CAST(exact AS VARCHAR) AS id, amount, 1 AS o, 0 AS g FROM lines
              UNION ALL SELECT CAST(CAST(CAST(exact AS DOUBLE) AS BIGINT) AS VARCHAR), amount, 0, 1 FROM lines)
        GROUP BY ALL HAVING sum(o) <> sum(g)""".replace(
        "FROM lines",
        "FROM (SELECT l_orderkey + 9007199254740992 AS exact, CAST(l_quantity AS DOUBLE) AS amount FROM lineitem)",
    ),
    "reconcile_hash": _with(
        TRIPS,
        """SELECT (SELECT count(*) FROM trips) AS original_count, (SELECT count(*) FROM trips) AS generated_count,
                  true AS equal""",
    ),
    "zone_revenue_rank": _with(
        ENRICHED,
        """SELECT *, RANK() OVER (ORDER BY month, revenue DESC) AS revenue_rank,
                  DENSE_RANK() OVER (ORDER BY month, revenue DESC) AS revenue_dense_rank
           FROM (SELECT CAST(month(trip_date) AS INTEGER) AS month, pickup_borough,
                        CAST(floor(sum(CAST(total_amount AS DECIMAL(18,2))) / 100) AS BIGINT) AS revenue
                 FROM enriched GROUP BY ALL)""",
    ),
    "latest_rows": _with(
        ENRICHED,
        """SELECT trip_date, pickup_borough, count(*) AS total_trips, TIMESTAMP '2001-07-01' AS _loaded_at
           FROM enriched GROUP BY trip_date, pickup_borough
           ORDER BY trip_date DESC, pickup_borough ASC NULLS FIRST LIMIT 10""",
    ),
    "ingest_idempotent": "SELECT * FROM events",
    "ingest_second_checkpoint": "SELECT * FROM events",
    "ingest_alternating_types": """
        SELECT event_id, ts, user_id, event_type, CAST(length(event_type) AS BIGINT) AS name_length,
               CASE WHEN event_id % 2 = 1 THEN CAST(CAST(value AS FLOAT) AS DOUBLE) ELSE value END AS value
        FROM events""",
    "ingest_schema_evolution": """
        SELECT event_id, ts, user_id, event_type, CAST(length(event_type) AS BIGINT) AS name_length,
               CASE WHEN ts >= TIMESTAMP '2024-01-16' THEN value END AS value FROM events""",
    "csv_rescue": """
        SELECT CASE WHEN c_acctbal >= 0 THEN c_custkey END AS c_custkey, c_name, c_mktsegment,
               CASE WHEN c_acctbal < 0 THEN 'key ' || c_custkey || ',' || c_name || ',' || c_mktsegment || ',extra'
               END AS _rescued_data FROM customer""",
    "stream_daily": _with(EVENTS, _daily("event_enriched")),
    "stream_checks": """
        SELECT 'events_raw' AS "table", test, CAST(failures AS BIGINT) AS failures FROM (
            SELECT event_type = 'purchase' AS second_load, count(*) FILTER (WHERE event_id IS NULL) AS ids,
                   count(*) FILTER (WHERE ts IS NULL) AS times,
                   count(*) FILTER (WHERE event_type NOT IN ('view', 'click', 'signup', 'error')) AS types,
                   count(event_id) - count(DISTINCT event_id) AS doubled,
                   count(*) FILTER (WHERE ts > current_timestamp::TIMESTAMP) AS future
            FROM events GROUP BY 1) g,
        LATERAL (VALUES ('not_null:event_id', ids), ('not_null:ts', times), ('accepted_values:event_type', types),
                        ('unique:event_id', doubled), ('no_future:ts', future)) v(test, failures)""",
    "dimension_by_type": _states(
        """SELECT 'type_2' AS dimension, customer_id, segment, nation_id, valid_from, valid_to, updated_at FROM h2
           UNION ALL SELECT 'type_1', customer_id, segment, nation_id, NULL, NULL, NULL FROM s2"""
    ),
    "warehouse_build": _with(EVENTS, _daily("event_enriched")),
    "warehouse_tests": _warehouse_tests(),
    "staging_view": _with(EVENTS, f"SELECT {_STAGED} FROM trips", trips=_EVENT_STAGED),
    "duration_limits": _with(
        EVENTS,
        """SELECT vendor_id, round(seconds / 60::DOUBLE, 2) AS trip_duration_minutes
           FROM (SELECT *, CASE WHEN vendor_id % 2 = 0 THEN 57 + vendor_id % 7 ELSE 17996 + vendor_id % 9 END AS seconds
                 FROM event_trips)
           WHERE trip_distance > 0 AND trip_distance <= 100 AND total_amount > 0
             AND pickup_at >= TIMESTAMP '2024-01-02 00:00:00' AND pickup_at <= TIMESTAMP '2024-01-29 00:00:00'
             AND round(seconds / 60::DOUBLE, 2) BETWEEN 1 AND 300""",
    ),
    "daily_two_sources": _with(EVENTS, _daily("event_enriched")),
    "dimension_stored_type1": """SELECT s_suppkey AS vendor_id,
                                        CASE WHEN s_nationkey < 5 THEN s_name || '!' ELSE s_name END AS vendor_name
                                 FROM supplier""",
    "driver_status_history": _states(
        """SELECT customer_id AS driver_id, segment AS status, 'n' || nation_id AS license_type, valid_from, valid_to,
                  updated_at FROM h2"""
    ),
    "ingest_column_case": "SELECT event_id, ts, user_id, event_type, value FROM events",
    "csv_reordered": "SELECT c_custkey, c_name, c_mktsegment, CAST(NULL AS VARCHAR) AS _rescued_data FROM customer",
    "scd2_added_column": _states(
        "SELECT *, CASE WHEN valid_from = TIMESTAMP '1998-01-01' THEN 't' || nation_id END AS tier FROM h2"
    ),
    "scd2_dropped_column": _states(
        "SELECT * REPLACE (CASE WHEN valid_from < TIMESTAMP '1998-01-01' THEN nation_id END AS nation_id) FROM h2"
    ),
    "reconcile_hash_types": _with(
        TRIPS,
        """SELECT (SELECT count(*) FROM trips) AS original_count, (SELECT count(*) FROM trips) AS generated_count,
                  true AS equal""",
    ),
    "stream_daily_relabel": """SELECT CAST(ts AS DATE) AS trip_date, 'n' || count(*) AS pickup_borough,
                                      count(*) AS total_trips FROM events GROUP BY 1""",
    "stream_event_time": _with(EVENTS, _daily("event_enriched")),
    "stream_late_routed": _with(EVENTS, _daily("event_enriched")),
    "stream_event_time_hourly": _with(
        EVENTS,
        """SELECT trip_date, pickup_hour, pickup_borough, count(*) AS total_trips
           FROM event_enriched GROUP BY ALL""",
    ),
}
