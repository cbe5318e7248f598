"""DuckDB SQL that recomputes each registered query from the raw parquet views.

Independent re-statement of the semantics (no Spark involved), used as the
correctness oracle. Computed doubles are rounded to 6 digits on both sides:
the engines sum in different orders and differ in the last bits. A fixed
1e-9 is added first so exact ties (means of 2-decimal readings often end in a
5 at the 7th digit) round the same way whichever side of the tie the last bit
lands on.
"""

from __future__ import annotations

# The events -> sensor events adapter, the bronze copy with re-sends, and the
# silver chain (dedup -> clean -> enrich), as CTEs shared by every query.
BRONZE_CTE = """
src AS (
  SELECT e.*,
         CASE user_id % 3 WHEN 0 THEN 'PLANT-A' WHEN 1 THEN 'PLANT-B' ELSE 'PLANT-C' END AS fac,
         CASE WHEN event_id % 97 = 0 THEN NULL ELSE value END AS v
  FROM events e
),
base AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id,
         'S-' || CAST(user_id % 10 AS VARCHAR) AS sensor_id,
         CASE event_type WHEN 'click' THEN 'temperature' WHEN 'view' THEN 'vibration'
              WHEN 'purchase' THEN 'pressure' WHEN 'signup' THEN 'throughput'
              ELSE 'unknown' END AS sensor_type,
         CASE WHEN event_id % 5 = 0 THEN ' ' || fac || ' ' ELSE fac END AS facility_id,
         ts AS "timestamp",
         v AS value,
         CASE WHEN event_id % 10 = 0 THEN NULL
              ELSE CAST(100 - event_id % 40 AS DOUBLE) / 100.0 END AS quality_score,
         CASE WHEN event_id % 13 = 0 THEN NULL ELSE v > 150 END AS is_anomaly,
         ts + to_seconds(event_id % 60) AS ingestion_timestamp,
         props,
         event_id AS src_id
  FROM src
),
bronze_raw AS (
  SELECT * FROM base
  UNION ALL
  SELECT event_id, sensor_id, sensor_type, facility_id, "timestamp", value + 1,
         quality_score, is_anomaly, ingestion_timestamp + INTERVAL 1 HOUR, props, src_id
  FROM base WHERE src_id % 20 = 0
),
base_u AS (SELECT * FROM base),
bronze AS (
  SELECT *,
         CASE sensor_type WHEN 'temperature' THEN 'celsius' WHEN 'vibration' THEN 'mm/s'
              WHEN 'pressure' THEN 'bar' WHEN 'throughput' THEN 'units/hr'
              ELSE 'unknown' END AS unit,
         CAST("timestamp" AS DATE) AS event_date
  FROM bronze_raw
)"""

SILVER_CTE = (
    BRONZE_CTE
    + """,
dedup AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY event_id
        ORDER BY ingestion_timestamp NULLS FIRST, "timestamp" NULLS FIRST, value NULLS FIRST) AS rn
    FROM bronze) WHERE rn = 1
),
cleaned AS (
  SELECT event_id, trim(sensor_id) AS sensor_id, sensor_type, trim(facility_id) AS facility_id,
         "timestamp", value, unit,
         coalesce(quality_score, CAST(1.0 AS DOUBLE)) AS quality_score,
         coalesce(is_anomaly, false) AS is_anomaly,
         ingestion_timestamp, src_id, props
  FROM dedup
  WHERE value IS NOT NULL
    AND sensor_type IN ('temperature', 'vibration', 'pressure', 'throughput')
),
rolled AS (
  SELECT *,
         avg(value) OVER w AS rolling_mean,
         stddev_samp(value) OVER w AS rolling_stddev
  FROM cleaned
  WINDOW w AS (PARTITION BY sensor_id, sensor_type ORDER BY "timestamp", event_id
               ROWS BETWEEN 99 PRECEDING AND CURRENT ROW)
),
silver AS (
  SELECT *,
         CASE WHEN rolling_stddev > 0 THEN (value - rolling_mean) / rolling_stddev
              ELSE CAST(0.0 AS DOUBLE) END AS z_score,
         CAST(hour("timestamp") AS INTEGER) AS hour_of_day,
         CAST(dayofweek("timestamp") + 1 AS INTEGER) AS day_of_week,
         hour("timestamp") BETWEEN 8 AND 17 AND dayofweek("timestamp") + 1 BETWEEN 2 AND 6
           AS is_business_hours,
         CAST("timestamp" AS DATE) AS event_date
  FROM rolled
)"""
)

SEVERITY_SQL = (
    "WITH"
    + SILVER_CTE
    + """,
sev AS (
  SELECT facility_id, CAST("timestamp" AS DATE) AS score_date,
         avg(abs(z_score)) AS avg_abs_z_score,
         avg(CAST(is_anomaly AS DOUBLE)) AS anomaly_rate,
         avg(quality_score) AS avg_quality,
         count(*) AS total_events,
         CAST(sum(CAST(is_anomaly AS INTEGER)) AS BIGINT) AS total_anomalies
  FROM silver GROUP BY 1, 2
),
scored AS (
  SELECT *, avg_abs_z_score * 0.4 + anomaly_rate * 100 * 0.4 + (1 - avg_quality) * 100 * 0.2
            AS anomaly_severity
  FROM sev
)
SELECT facility_id, score_date,
       round(avg_abs_z_score + 1e-9, 6) AS avg_abs_z_score, round(anomaly_rate + 1e-9, 6) AS anomaly_rate,
       round(avg_quality + 1e-9, 6) AS avg_quality, total_events, total_anomalies,
       round(anomaly_severity + 1e-9, 6) AS anomaly_severity,
       CASE WHEN anomaly_severity > 50 THEN 'CRITICAL' WHEN anomaly_severity > 25 THEN 'WARNING'
            WHEN anomaly_severity > 10 THEN 'ELEVATED' ELSE 'NORMAL' END AS severity_level
FROM scored"""
)

KPI_SQL = (
    "WITH"
    + SILVER_CTE
    + """,
k AS (
  SELECT facility_id, sensor_type,
         time_bucket(INTERVAL '15 minutes', "timestamp", TIMESTAMP '1970-01-01') AS window_start,
         count(*) AS event_count, avg(value) AS avg_value, min(value) AS min_value,
         max(value) AS max_value, stddev_samp(value) AS stddev_value,
         CAST(sum(CAST(is_anomaly AS INTEGER)) AS BIGINT) AS anomaly_count,
         avg(CAST(is_anomaly AS DOUBLE)) AS anomaly_rate,
         avg(quality_score) AS avg_quality_score,
         avg(z_score) AS avg_z_score, max(abs(z_score)) AS max_abs_z_score
  FROM silver WHERE "timestamp" IS NOT NULL GROUP BY 1, 2, 3
)
SELECT facility_id, sensor_type, event_count,
       round(avg_value + 1e-9, 6) AS avg_value, min_value, max_value,
       round(stddev_value + 1e-9, 6) AS stddev_value, anomaly_count,
       round(anomaly_rate + 1e-9, 6) AS anomaly_rate, round(avg_quality_score + 1e-9, 6) AS avg_quality_score,
       round(avg_z_score + 1e-9, 6) AS avg_z_score, round(max_abs_z_score + 1e-9, 6) AS max_abs_z_score,
       window_start, window_start + INTERVAL 15 MINUTE AS window_end,
       CAST(window_start AS DATE) AS kpi_date
FROM k"""
)

DEDUP_SQL = (
    "WITH"
    + BRONZE_CTE
    + """
SELECT event_id, sensor_id, facility_id, "timestamp", value, ingestion_timestamp FROM (
  SELECT *, row_number() OVER (PARTITION BY event_id
      ORDER BY ingestion_timestamp NULLS FIRST, "timestamp" NULLS FIRST, value NULLS FIRST) AS rn
  FROM bronze) WHERE rn = 1"""
)

CLEAN_SQL = (
    "WITH"
    + SILVER_CTE
    + """
SELECT event_id, sensor_id, sensor_type, facility_id, value, quality_score, is_anomaly
FROM cleaned"""
)

CLEAN_TEXT_SQL = (
    "WITH"
    + BRONZE_CTE
    + """
SELECT event_id, sensor_type, trim(facility_id) AS facility_id, value FROM base
WHERE value IS NOT NULL AND src_id % 17 <> 0 AND src_id % 19 <> 0 AND src_id % 23 <> 0
  AND sensor_type IN ('temperature', 'vibration', 'pressure', 'throughput')"""
)

TIME_FEATURES_SQL = (
    "WITH"
    + SILVER_CTE
    + """
SELECT event_id, event_date, hour_of_day, day_of_week, is_business_hours FROM silver"""
)

ROLLING_SQL = (
    "WITH"
    + SILVER_CTE
    + """
SELECT event_id, sensor_id, sensor_type,
       round(rolling_mean + 1e-9, 6) AS rolling_mean, round(rolling_stddev + 1e-9, 6) AS rolling_stddev,
       round(z_score + 1e-9, 6) AS z_score
FROM silver"""
)

STREAM_VALIDATE_SQL = (
    "WITH"
    + BRONZE_CTE
    + """
SELECT event_id, sensor_id, sensor_type, facility_id, "timestamp", value, event_date
FROM bronze
WHERE event_id IS NOT NULL AND sensor_id IS NOT NULL AND "timestamp" IS NOT NULL
  AND value IS NOT NULL
  AND sensor_type IN ('temperature', 'vibration', 'pressure', 'throughput')"""
)

CONTRACT_SQL = (
    "WITH"
    + BRONZE_CTE
    + """,
rules AS (
  SELECT list_filter([
           CASE WHEN event_id IS NULL THEN 'missing_event_id' END,
           CASE WHEN sensor_id IS NULL THEN 'missing_sensor_id' END,
           CASE WHEN sensor_type IS NULL THEN 'missing_sensor_type' END,
           CASE WHEN facility_id IS NULL THEN 'missing_facility_id' END,
           CASE WHEN "timestamp" IS NULL THEN 'missing_timestamp' END,
           CASE WHEN value IS NULL THEN 'missing_value' END,
           CASE WHEN unit IS NULL THEN 'missing_unit' END,
           CASE WHEN sensor_type IS NOT NULL AND sensor_type NOT IN
                ('temperature', 'vibration', 'pressure', 'throughput')
                THEN 'invalid_sensor_type' END,
           CASE WHEN quality_score IS NOT NULL AND (quality_score < 0 OR quality_score > 1)
                THEN 'quality_score_out_of_range' END
         ], lambda x: x IS NOT NULL) AS violations
  FROM bronze
),
flat AS (
  SELECT unnest(violations) AS rule FROM rules WHERE len(violations) > 0
  UNION ALL
  SELECT 'valid' AS rule FROM rules WHERE len(violations) = 0
)
SELECT rule, count(*) AS row_count FROM flat GROUP BY rule"""
)

JSON_ROUNDTRIP_SQL = (
    "WITH"
    + BRONZE_CTE
    + """
SELECT coalesce(sensor_id, 'unknown') AS key, event_id, sensor_id, sensor_type, facility_id,
       CASE WHEN src_id % 7 = 0 THEN date_trunc('second', "timestamp")
            WHEN src_id % 11 = 1 THEN date_trunc('millisecond', "timestamp")
            WHEN src_id % 13 IN (2, 3) THEN NULL ELSE "timestamp" END
         AS "timestamp", value, unit, quality_score, is_anomaly, json_extract_string(props, '$.k') AS meta_k
FROM bronze"""
)


ORACLE: dict[str, str] = {
    "severity_daily": SEVERITY_SQL,
    "kpi_15min": KPI_SQL,
    "dedup_first": DEDUP_SQL,
    "clean_defaults": CLEAN_SQL,
    "clean_text_values": CLEAN_TEXT_SQL,
    "time_features": TIME_FEATURES_SQL,
    "rolling_zscore": ROLLING_SQL,
    "stream_validate": STREAM_VALIDATE_SQL,
    "contract_violations": CONTRACT_SQL,
    "json_roundtrip": JSON_ROUNDTRIP_SQL,
}

BRONZE_RANGE_SQL = (
    "WITH"
    + BRONZE_CTE
    + """
SELECT event_id, sensor_id, sensor_type, facility_id, "timestamp", value, ingestion_timestamp,
       event_date, 'kafka' AS source, '1.0.0' AS pipeline_version
FROM bronze
WHERE event_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'
  AND sensor_type = 'temperature'"""
)

BRONZE_STATS_SQL = (
    "WITH"
    + BRONZE_CTE
    + """
SELECT sensor_type, count(*) AS row_count, min(event_date) AS min_event_date,
       max(event_date) AS max_event_date, grouping(sensor_type) = 1 AS is_total
FROM bronze GROUP BY ROLLUP (sensor_type)"""
)

SILVER_STATS_SQL = (
    "WITH"
    + SILVER_CTE
    + """
SELECT count(*) AS total_rows,
       round(coalesce(avg(quality_score), 0) + 1e-9, 6) AS avg_quality_score,
       round(coalesce(avg(CAST(is_anomaly AS DOUBLE)), 0) + 1e-9, 6) AS anomaly_rate
FROM silver"""
)

GOLD_STATS_SQL = (
    "WITH"
    + SILVER_CTE
    + """,
k AS (
  SELECT DISTINCT facility_id, sensor_type,
         time_bucket(INTERVAL '15 minutes', "timestamp", TIMESTAMP '1970-01-01') AS w
  FROM silver WHERE "timestamp" IS NOT NULL
),
s AS (SELECT DISTINCT facility_id, CAST("timestamp" AS DATE) AS d FROM silver)
SELECT (SELECT count(*) FROM k) AS total_kpi_rows,
       (SELECT count(*) FROM s) AS total_anomaly_rows,
       (SELECT count(DISTINCT facility_id) FROM k) AS facility_count"""
)

GOLD_FACILITIES_SQL = "WITH" + SILVER_CTE + "\nSELECT DISTINCT facility_id FROM silver"

EXPIRED_SQL = (
    "WITH"
    + BRONZE_CTE
    + """
SELECT event_date, count(*) AS row_count, DATE '2024-01-11' AS cutoff
FROM bronze WHERE event_date < DATE '2024-01-11' GROUP BY event_date"""
)


def _hard(sql: str) -> str:
    """The same statement over bronze with copies 30 hours late and missing event times."""
    late = """FROM base WHERE src_id % 20 = 0
  UNION ALL
  SELECT event_id, sensor_id, sensor_type, facility_id, "timestamp", value + 2,
         quality_score, is_anomaly, ingestion_timestamp + INTERVAL 30 HOUR, props, src_id
  FROM base WHERE src_id % 50 = 7
),
bronze_timed AS (
  SELECT * REPLACE (CASE WHEN src_id % 211 = 3 AND ingestion_timestamp < TIMESTAMP '2024-01-15'
                         THEN NULL ELSE "timestamp" END AS "timestamp") FROM bronze_raw
),
base_u"""
    sql = sql.replace("FROM bronze_raw\n)", "FROM bronze_timed\n)")
    sql = sql.replace("FROM base WHERE src_id % 20 = 0\n),\nbase_u", late)
    return sql.replace(
        'ORDER BY "timestamp", event_id\n', 'ORDER BY "timestamp" NULLS FIRST, event_id\n'
    )


SILVER_INCREMENTAL_SQL = _hard(
    "WITH"
    + SILVER_CTE
    + """
SELECT event_id, sensor_id, sensor_type, facility_id, "timestamp", value, quality_score,
       is_anomaly, ingestion_timestamp, event_date,
       round(rolling_mean + 1e-9, 6) AS rolling_mean,
       round(rolling_stddev + 1e-9, 6) AS rolling_stddev, round(z_score + 1e-9, 6) AS z_score
FROM silver"""
)

GOLD_KPIS_TABLE_SQL = (
    "SELECT * FROM ("
    + _hard(KPI_SQL)
    + ") WHERE facility_id = 'PLANT-A' AND kpi_date = DATE '2024-01-10'"
)

GOLD_SEVERITY_TABLE_SQL = (
    "SELECT * FROM (" + _hard(SEVERITY_SQL) + ") WHERE facility_id = 'PLANT-B'"
)

BRONZE_MIXED_SQL = (
    "WITH"
    + BRONZE_CTE
    + """
SELECT event_id, sensor_type, facility_id, "timestamp", value, event_date, 'kafka' AS source
FROM bronze
UNION ALL
SELECT event_id, sensor_type, facility_id, "timestamp", value, event_date, NULL
FROM bronze
WHERE event_id IS NOT NULL AND sensor_id IS NOT NULL AND "timestamp" IS NOT NULL
  AND value IS NOT NULL
  AND sensor_type IN ('temperature', 'vibration', 'pressure', 'throughput')"""
)

CONTRACT_QUARANTINE_SQL = _hard(
    CONTRACT_SQL.split("flat AS (")[0].rstrip().rstrip(",").replace(
        "AS violations\n  FROM bronze", "AS violations, bronze.*\n  FROM bronze"
    )
    + """
SELECT event_id, sensor_type, "timestamp", value,
       CASE WHEN len(violations) = 0 THEN coalesce(quality_score, 1.0) ELSE quality_score END AS quality_score,
       CASE WHEN len(violations) = 0 THEN coalesce(is_anomaly, false) ELSE is_anomaly END AS is_anomaly,
       array_to_string(violations, ',') AS reasons
FROM rules"""
)

ORACLE.update(
    {
        "gold_kpis_table": GOLD_KPIS_TABLE_SQL,
        "gold_severity_table": GOLD_SEVERITY_TABLE_SQL,
        "bronze_mixed": BRONZE_MIXED_SQL,
        "contract_quarantine": CONTRACT_QUARANTINE_SQL,
        "bronze_range_read": BRONZE_RANGE_SQL,
        "bronze_stats": BRONZE_STATS_SQL,
        "silver_stats": SILVER_STATS_SQL,
        "gold_stats": GOLD_STATS_SQL,
        "gold_facilities": GOLD_FACILITIES_SQL,
        "expired_partitions": EXPIRED_SQL,
        "silver_incremental": SILVER_INCREMENTAL_SQL,
        "silver_two_writers": SILVER_INCREMENTAL_SQL,
        "gold_incremental": _hard(KPI_SQL),
    }
)

_TYPE_STATS_CTE = """,
st AS (
  SELECT sensor_type, count(*) AS n,
         count(*) FILTER (WHERE value IS NULL) AS null_n,
         sum(CASE WHEN sensor_type = 'temperature' AND (value < -50 OR value > 500) THEN 1
                  WHEN sensor_type = 'vibration' AND (value < 0 OR value > 100) THEN 1
                  WHEN sensor_type = 'pressure' AND (value < 0 OR value > 1000) THEN 1
                  WHEN sensor_type = 'throughput' AND (value < 0 OR value > 10000) THEN 1
                  ELSE 0 END) AS out_n,
         avg(value) AS mean, stddev_samp(value) AS sd, count(value) AS value_n
  FROM bronze GROUP BY sensor_type
),
thr AS (
  SELECT * FROM (VALUES ('temperature', 0.01), ('vibration', 0.02), ('pressure', 0.01),
                        ('throughput', 0.05)) t(sensor_type, null_thr)
),
j AS (SELECT st.*, CAST(thr.null_thr AS DOUBLE) AS null_thr FROM st JOIN thr USING (sensor_type)),
checks AS (
  SELECT 'column_exists_' || c AS check_name, 'schema' AS check_type,
         CAST(NULL AS VARCHAR) AS sensor_type, true AS success,
         CAST(1.0 AS DOUBLE) AS observed_value
  FROM (VALUES ('event_id'), ('sensor_id'), ('sensor_type'), ('facility_id'), ('timestamp'),
               ('value'), ('unit')) t(c)
  UNION ALL
  SELECT 'null_check_' || sensor_type, 'null', sensor_type, null_n / n <= null_thr,
         round(null_n / n, 4) FROM j
  UNION ALL
  SELECT 'range_check_' || sensor_type, 'range', sensor_type, 1 - out_n / n >= 0.95,
         round(1 - out_n / n, 4) FROM j
  UNION ALL
  SELECT 'statistical_check_' || sensor_type, 'statistical', sensor_type, cv < 100, round(cv, 2)
  FROM (SELECT *, CASE WHEN mean <> 0 THEN coalesce(sd, 0) / abs(mean) * 100 ELSE 0 END AS cv
        FROM j WHERE value_n > 0)
)"""

QUALITY_SUITE_SQL = "WITH" + BRONZE_CTE + _TYPE_STATS_CTE + "\nSELECT * FROM checks"

QUALITY_SUMMARY_SQL = (
    "WITH"
    + BRONZE_CTE
    + _TYPE_STATS_CTE
    + """
SELECT count(*) AS total_checks, count(*) FILTER (WHERE success) AS passed,
       count(*) FILTER (WHERE NOT success) AS failed, bool_and(success) AS overall_success,
       round(avg(CAST(success AS DOUBLE)) + 1e-9, 6) AS success_rate
FROM checks"""
)

_LINEITEM_COLUMNS = (
    ("l_orderkey", "bigint", True),
    ("l_partkey", "bigint", True),
    ("l_suppkey", "bigint", True),
    ("l_linenumber", "int", True),
    ("l_quantity", "double", True),
    ("l_extendedprice", "double", True),
    ("l_discount", "double", True),
    ("l_tax", "double", True),
    ("l_returnflag", "string", False),
    ("l_linestatus", "string", False),
    ("l_shipdate", "timestamp_ntz", False),
)


def _profile_select(i: int, name: str, dtype: str, numeric: bool) -> str:
    c = f'"{name}"'
    if numeric:
        x = f"CAST({c} AS DOUBLE)"
        stats = (
            f"min({x}) AS min, max({x}) AS max, round(avg({x}) + 1e-9, 6) AS mean, "
            f"round(stddev_samp({x}) + 1e-9, 6) AS stddev, quantile_disc({x}, 0.25) AS p25, "
            f"quantile_disc({x}, 0.5) AS median, quantile_disc({x}, 0.75) AS p75"
        )
    else:
        stats = ", ".join(
            f"CAST(NULL AS DOUBLE) AS {s}" for s in ("min", "max", "mean", "stddev", "p25", "median", "p75")
        )
    return (
        f"SELECT '{name}' AS column_name, {i} AS position, '{dtype}' AS dtype, "
        f"count(*) AS row_count, count(*) - count({c}) AS null_count, "
        f"round((count(*) - count({c})) / count(*) + 1e-9, 6) AS null_rate, "
        f"count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS distinct_count, "
        f"{stats} FROM lineitem"
    )


PROFILE_COLUMNS_SQL = "\nUNION ALL\n".join(
    _profile_select(i, n, t, num) for i, (n, t, num) in enumerate(_LINEITEM_COLUMNS)
)

_BRONZE_PROFILE_COLUMNS = (
    "event_id", "sensor_id", "sensor_type", "facility_id", "timestamp", "value", "unit",
    "quality_score", "is_anomaly", "metadata", "kafka_timestamp", "kafka_partition", "kafka_offset",
    "ingestion_timestamp", "source", "pipeline_version", "event_date",
)
_BRONZE_PROFILE_EXPR = {
    "metadata": "props",
    "kafka_timestamp": "CAST(NULL AS TIMESTAMP)",
    "kafka_partition": "CAST(NULL AS INTEGER)",
    "kafka_offset": "CAST(NULL AS BIGINT)",
    "source": "'kafka'",
    "pipeline_version": "'1.0.0'",
}

PROFILE_REPORT_SQL = (
    "WITH"
    + BRONZE_CTE
    + ",\nb AS (SELECT *, "
    + ", ".join(f"{v} AS {k}" for k, v in _BRONZE_PROFILE_EXPR.items())
    + " FROM bronze)\n"
    + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, {i} AS position, "
        f"(count(*) - count(\"{c}\")) / count(*) > 0.05 AS high_null, "
        f"count(DISTINCT \"{c}\") + max(CASE WHEN \"{c}\" IS NULL THEN 1 ELSE 0 END) <= 5 "
        f"AS low_cardinality FROM b"
        for i, c in enumerate(_BRONZE_PROFILE_COLUMNS)
    )
)

def _day_profile_select(name: str, numeric: bool) -> str:
    stats = (
        f"min({name}) AS min, max({name}) AS max, round(avg({name}) + 1e-9, 6) AS mean, "
        f"round(stddev_samp({name}) + 1e-9, 6) AS stddev, true AS distinct_ok, true AS quantiles_ok"
        if numeric
        else "CAST(NULL AS DOUBLE) AS min, CAST(NULL AS DOUBLE) AS max, CAST(NULL AS DOUBLE) AS mean, "
        "CAST(NULL AS DOUBLE) AS stddev, true AS distinct_ok, CAST(NULL AS BOOLEAN) AS quantiles_ok"
    )
    return (
        f"SELECT '{name.strip(chr(34))}' AS column_name, count(*) AS row_count, "
        f"count(*) - count({name}) AS null_count, {stats} FROM span"
    )


PROFILE_DAYS_SQL = (
    "WITH"
    + BRONZE_CTE
    + ",\nspan AS (SELECT * FROM bronze WHERE event_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20')\n"
    + "\nUNION ALL\n".join(
        _day_profile_select(n, n in ("value", "quality_score"))
        for n in ("event_id", "sensor_id", "sensor_type", "facility_id", '"timestamp"', "value",
                  "quality_score", "is_anomaly")
    )
)

ORACLE.update(
    {
        "profile_days": PROFILE_DAYS_SQL,
        "quality_suite": QUALITY_SUITE_SQL,
        "quality_summary": QUALITY_SUMMARY_SQL,
        "profile_columns": PROFILE_COLUMNS_SQL,
        "profile_report": PROFILE_REPORT_SQL,
    }
)

STREAM_INGEST_SQL = (
    "WITH"
    + BRONZE_CTE
    + """
SELECT event_id, sensor_id, sensor_type, facility_id, "timestamp", value, quality_score,
       is_anomaly, ingestion_timestamp AS kafka_timestamp, src_id AS kafka_offset, event_date
FROM bronze
WHERE event_id IS NOT NULL AND sensor_id IS NOT NULL AND "timestamp" IS NOT NULL
  AND value IS NOT NULL
  AND sensor_type IN ('temperature', 'vibration', 'pressure', 'throughput')"""
)

STREAM_DEDUP_SQL = (
    "WITH"
    + BRONZE_CTE
    + """
SELECT DISTINCT event_id, sensor_id, sensor_type, "timestamp" FROM bronze"""
)

STREAM_KPI_SQL = (
    "WITH"
    + BRONZE_CTE
    + """,
c AS (
  SELECT trim(facility_id) AS facility_id, sensor_type, "timestamp", value,
         coalesce(quality_score, CAST(1.0 AS DOUBLE)) AS quality_score,
         coalesce(is_anomaly, false) AS is_anomaly
  FROM base_u
  WHERE event_id IS NOT NULL AND sensor_id IS NOT NULL AND "timestamp" IS NOT NULL
    AND value IS NOT NULL
    AND sensor_type IN ('temperature', 'vibration', 'pressure', 'throughput')
),
k AS (
  SELECT facility_id, sensor_type,
         time_bucket(INTERVAL '15 minutes', "timestamp", TIMESTAMP '1970-01-01') AS window_start,
         count(*) AS event_count, avg(value) AS avg_value, min(value) AS min_value,
         max(value) AS max_value, stddev_samp(value) AS stddev_value,
         CAST(sum(CAST(is_anomaly AS INTEGER)) AS BIGINT) AS anomaly_count,
         avg(CAST(is_anomaly AS DOUBLE)) AS anomaly_rate,
         avg(quality_score) AS avg_quality_score
  FROM c GROUP BY 1, 2, 3
)
SELECT facility_id, sensor_type, event_count, round(avg_value + 1e-9, 6) AS avg_value,
       min_value, max_value, round(stddev_value + 1e-9, 6) AS stddev_value, anomaly_count,
       round(anomaly_rate + 1e-9, 6) AS anomaly_rate,
       round(avg_quality_score + 1e-9, 6) AS avg_quality_score,
       window_start, window_start + INTERVAL 15 MINUTE AS window_end,
       CAST(window_start AS DATE) AS kpi_date
FROM k
WHERE window_start + INTERVAL 15 MINUTE <= (SELECT max("timestamp") FROM c) - INTERVAL 1 HOUR"""
)

STREAM_FIRST_SQL = (
    "WITH"
    + BRONZE_CTE
    + """
SELECT event_id, sensor_id, sensor_type, "timestamp", value, ingestion_timestamp AS kafka_timestamp
FROM bronze
WHERE "timestamp" <= (SELECT max("timestamp") FROM bronze) - INTERVAL 2 HOUR
QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY ingestion_timestamp) = 1"""
)

#: Copies 30 hours late come behind the watermark, so the first copies are those of bronze.
STREAM_KPI_RESENDS_SQL = STREAM_KPI_SQL.replace(
    "FROM base_u\n  WHERE", "FROM bronze\n  WHERE"
).replace(
    "'throughput')\n),\nk AS",
    "'throughput')\n  QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY ingestion_timestamp) = 1\n),\nk AS",
).replace("INTERVAL 1 HOUR", "INTERVAL 2 HOUR")

STREAM_QUARANTINE_SQL = (
    CONTRACT_QUARANTINE_SQL.split("SELECT event_id, sensor_type")[0]
    + """
SELECT event_id, sensor_type, "timestamp", value, quality_score, is_anomaly,
       array_to_string(violations, ',') AS reasons
FROM rules
UNION ALL
SELECT NULL, NULL, NULL, NULL, NULL, NULL,
  'missing_event_id,missing_sensor_id,missing_sensor_type,missing_facility_id,missing_timestamp,missing_value,missing_unit'
FROM bronze_raw WHERE src_id % 301 = 0"""
)

ORACLE.update(
    {
        "stream_ingest": STREAM_INGEST_SQL,
        "stream_dedup": STREAM_DEDUP_SQL,
        "stream_kpi_closed": STREAM_KPI_SQL,
        "stream_first_copy": STREAM_FIRST_SQL,
        "stream_kpi_resends": STREAM_KPI_RESENDS_SQL,
        "stream_quarantine": STREAM_QUARANTINE_SQL,
        "bronze_folded": BRONZE_MIXED_SQL,
    }
)

_GOV_CTE = """,
counts AS (
  SELECT (SELECT count(*) FROM bronze) AS n_bronze,
         (SELECT count(*) FROM silver) AS n_silver,
         (SELECT count(*) FROM (SELECT DISTINCT facility_id, sensor_type,
                 time_bucket(INTERVAL '15 minutes', "timestamp", TIMESTAMP '1970-01-01')
                 FROM silver WHERE "timestamp" IS NOT NULL)) AS n_kpi,
         (SELECT count(*) FROM (SELECT DISTINCT facility_id, CAST("timestamp" AS DATE)
                 FROM silver)) AS n_sev,
         (SELECT count(DISTINCT event_id) FROM bronze) AS n_ids,
         (SELECT count(*) FROM bronze
           WHERE event_id IS NOT NULL AND sensor_id IS NOT NULL AND "timestamp" IS NOT NULL
             AND value IS NOT NULL
             AND sensor_type IN ('temperature', 'vibration', 'pressure', 'throughput')) AS n_valid
),
fresh_src AS (
  SELECT facility_id, max("timestamp") AS latest_event FROM silver GROUP BY facility_id
  UNION ALL
  SELECT NULL, max("timestamp") FROM silver
),
fresh AS (
  SELECT CASE WHEN facility_id IS NULL THEN 'data_freshness'
              ELSE 'data_freshness_' || facility_id END AS name,
         latest_event,
         (epoch_us(TIMESTAMP '2024-01-31 00:30:00') - epoch_us(latest_event)) / 60000000.0 AS lag
  FROM fresh_src
),
fresh_checks AS (
  SELECT name, latest_event,
         CASE WHEN lag IS NULL THEN 'unknown' WHEN lag <= 30 THEN 'compliant'
              WHEN lag <= 45 THEN 'warning' ELSE 'violated' END AS status,
         coalesce(round(lag, 2), 0.0) AS metric_value, CAST(30.0 AS DOUBLE) AS threshold
  FROM fresh
),
comp AS (
  SELECT 'data_completeness_' || layer AS name,
         CASE WHEN expected = 0 THEN 100.0 ELSE actual / expected * 100 END AS pct
  FROM (SELECT 'bronze' AS layer, n_valid AS actual, n_bronze AS expected FROM counts
        UNION ALL SELECT 'silver', n_silver, n_ids FROM counts
        UNION ALL SELECT 'gold', n_sev, n_sev FROM counts)
),
comp_checks AS (
  SELECT name,
         CASE WHEN pct >= 95 THEN 'compliant' WHEN pct >= 85.5 THEN 'warning'
              ELSE 'violated' END AS status,
         round(pct, 2) AS metric_value, CAST(95.0 AS DOUBLE) AS threshold
  FROM comp
),
all_checks AS (
  SELECT name, status, metric_value FROM fresh_checks
  UNION ALL SELECT name, status, metric_value FROM comp_checks
)"""

LINEAGE_SQL = (
    "WITH"
    + SILVER_CTE
    + _GOV_CTE
    + """
SELECT 'ingest_bronze' AS name, 'source' AS source_layer, 'bronze' AS target_layer,
       'append' AS operation, n_bronze AS input_count, n_bronze AS output_count,
       CAST(5 AS BIGINT) AS total_steps, true AS completed FROM counts
UNION ALL SELECT 'stream_bronze', 'source', 'bronze', 'append', n_bronze, n_valid, 5, true FROM counts
UNION ALL SELECT 'process_silver', 'bronze', 'silver', 'dedup_clean_enrich', n_bronze, n_silver,
       5, true FROM counts
UNION ALL SELECT 'aggregate_kpis', 'silver', 'gold', 'aggregate', n_silver, n_kpi, 5, true
       FROM counts
UNION ALL SELECT 'score_anomalies', 'silver', 'gold', 'aggregate', n_silver, n_sev, 5, true
       FROM counts"""
)

FRESHNESS_SQL = "WITH" + SILVER_CTE + _GOV_CTE + "\nSELECT * FROM fresh_checks"

COMPLETENESS_SQL = "WITH" + SILVER_CTE + _GOV_CTE + "\nSELECT * FROM comp_checks"

SLA_ALERTS_SQL = (
    "WITH" + SILVER_CTE + _GOV_CTE
    + "\nSELECT * FROM all_checks WHERE status IN ('warning', 'violated')"
)

SLA_DASHBOARD_SQL = (
    "WITH"
    + SILVER_CTE
    + _GOV_CTE
    + """
SELECT (SELECT count(*) FROM all_checks) AS total_checks,
       coalesce((SELECT status FROM fresh_checks ORDER BY name DESC LIMIT 1), 'unknown')
         AS freshness_status,
       coalesce((SELECT status FROM comp_checks ORDER BY name DESC LIMIT 1), 'unknown')
         AS completeness_status,
       CAST(30.0 AS DOUBLE) AS freshness_threshold_minutes,
       CAST(95.0 AS DOUBLE) AS completeness_threshold_percent"""
)

SLA_RECENT_SQL = (
    "WITH"
    + SILVER_CTE
    + _GOV_CTE
    + """,
history AS (
  SELECT name, status, metric_value, TIMESTAMP '2024-01-31 00:30:00' AS checked_at FROM all_checks
  UNION ALL
  SELECT name, status, metric_value, TIMESTAMP '2024-01-30 00:30:00' FROM all_checks
)
SELECT * FROM history ORDER BY checked_at DESC, name LIMIT 9"""
)

ORACLE.update(
    {
        "sla_recent": SLA_RECENT_SQL,
        "lineage_runs": LINEAGE_SQL,
        "freshness": FRESHNESS_SQL,
        "completeness": COMPLETENESS_SQL,
        "sla_alerts": SLA_ALERTS_SQL,
        "sla_dashboard": SLA_DASHBOARD_SQL,
    }
)
