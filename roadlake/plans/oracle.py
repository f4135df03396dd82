"""Independent SQL for each registered query, in DuckDB's dialect."""

from __future__ import annotations

# Fixed values, written out here so that a wrong constant in the code shows.
_EVENT = [
    "vehicle_id", "number_plate", "vehicle_type", "vehicle_name", "speed", "location_lat", "location_lon", "user_id",
    "phone_number", "car_life_years", "price_of_vechical", "fine", "timestamp",
]
_EVENT_LIST = ", ".join(f'"{c}"' for c in _EVENT)
_PROCESSED_LIST = f'{_EVENT_LIST}, event_time, "year", "month", "day"'
_TARGET_LIST = f"{_PROCESSED_LIST}, last_updated"

_TELEMETRY = """
telemetry AS (
  SELECT event_id,
    concat('V', 1000 + user_id) AS vehicle_id,
    concat('MH 12 AB ', 1000 + event_id % 9000) AS number_plate,
    CASE WHEN event_type IN ('click', 'view') THEN 'car' ELSE 'bike' END AS vehicle_type,
    CASE WHEN event_type IN ('click', 'view') THEN 'Honda City' ELSE 'Yamaha FZ' END AS vehicle_name,
    value AS speed,
    CAST(18.5 AS DOUBLE) + (event_id % 500) / CAST(1000 AS DOUBLE) AS location_lat,
    CAST(73.7 AS DOUBLE) + (event_id % 300) / CAST(1000 AS DOUBLE) AS location_lon,
    CAST(user_id AS INT) AS user_id,
    concat('9', lpad(CAST(event_id AS VARCHAR), 8, '0')) AS phone_number,
    CAST(1 + event_id % 15 AS INT) AS car_life_years,
    CAST(100000 + event_id % 1900000 AS DOUBLE) AS price_of_vechical,
    CASE WHEN value > 150 THEN 1000 ELSE 0 END AS fine,
    epoch_us(ts) / CAST(1e6 AS DOUBLE) AS "timestamp"
  FROM events
)"""


def _enriched(name: str, source: str) -> str:
    return f"""
{name}_timed AS (
  SELECT *, make_timestamp(CAST(trunc("timestamp") AS BIGINT) * 1000000) AS event_time FROM {source}
),
{name} AS (
  SELECT *, CAST(year(event_time) AS INT) AS "year", CAST(month(event_time) AS INT) AS "month",
    CAST(day(event_time) AS INT) AS "day"
  FROM {name}_timed
)"""


_ENRICHED = _TELEMETRY + "," + _enriched("enriched", "telemetry")

_ALERTS = """
alerts AS (
  SELECT event_id, vehicle_id, speed, fine, phone_number,
    'WARNING: Vehicle ' || vehicle_id || ' overspeeding at ' || CAST(speed AS VARCHAR) || ' km/h — Fine ₹'
    || CAST(fine AS VARCHAR) || ' sent to phone ' || phone_number AS message
  FROM telemetry WHERE fine > 0
)"""

_BATCHES = _ENRICHED + """,
numbered AS (
  SELECT event_id, event_time, date_trunc('day', event_time)::TIMESTAMP AS bucket_start,
    row_number() OVER (PARTITION BY date_trunc('day', event_time) ORDER BY event_time, event_id) - 1 AS position
  FROM enriched
),
batched AS (
  SELECT event_id, event_time, bucket_start, CAST(position // 100 AS BIGINT) AS batch_no FROM numbered
)"""

_LOADS = _ENRICHED + """,
resent AS (
  SELECT * REPLACE (speed + 1 AS speed,
    "timestamp" + CASE WHEN fine > 0 THEN 0 ELSE 2592000 END AS "timestamp")
  FROM telemetry
),""" + _enriched("resent_enriched", "resent") + """,
first_load AS (
  SELECT *, TIMESTAMP '2024-02-01 00:00:00' AS last_updated FROM enriched
  QUALIFY row_number() OVER (PARTITION BY vehicle_id, event_time ORDER BY "timestamp" DESC, event_id DESC) = 1
),
second_load AS (
  SELECT *, TIMESTAMP '2024-03-02 00:00:00' AS last_updated FROM resent_enriched
  QUALIFY row_number() OVER (PARTITION BY vehicle_id, event_time ORDER BY "timestamp" DESC, event_id DESC) = 1
),
merged AS (
  SELECT * FROM second_load
  UNION ALL
  SELECT f.* FROM first_load f
  WHERE NOT EXISTS (
    SELECT 1 FROM second_load s WHERE s.vehicle_id = f.vehicle_id AND s.event_time = f.event_time)
)"""

# A second load with rows as they were among its corrections, and what each of its rows does to the first.
_CHANGES = _LOADS + """,
sent AS (
  SELECT *, 1 AS later FROM resent_enriched UNION ALL SELECT *, 0 FROM enriched WHERE fine = 0
),
third_load AS (
  SELECT * EXCLUDE (later), TIMESTAMP '2024-03-02 00:00:00' AS last_updated FROM sent
  QUALIFY row_number() OVER (PARTITION BY vehicle_id, event_time ORDER BY "timestamp" DESC, later DESC, event_id DESC) = 1
),
outcome AS (
  SELECT t.*, CASE WHEN f.vehicle_id IS NULL THEN 'inserted' WHEN f.speed = t.speed AND f."timestamp" = t."timestamp"
    AND f.phone_number = t.phone_number THEN 'unchanged' ELSE 'updated' END AS change
  FROM third_load t LEFT JOIN first_load f ON f.vehicle_id = t.vehicle_id AND f.event_time = t.event_time
)"""


_RULES = {
    "vehicle_id": "regexp_full_match(vehicle_id, 'V[1-9][0-9]{3}')",
    "number_plate": "regexp_full_match(number_plate, '(MH|DL|KA|TN|GJ|RJ|UP|MP|WB|PB|HR|CG) "
    "(01|02|03|04|05|06|07|08|09|10|12|14|20) [A-Z]{2} [1-9][0-9]{3}')",
    "vehicle_type": "vehicle_type IN ('car', 'bike')",
    "vehicle_name": "(vehicle_type = 'car' AND vehicle_name IN ('Maruti Swift', 'Hyundai i20', 'Tata Nexon', "
    "'Mahindra XUV300', 'Honda City', 'Toyota Fortuner', 'Kia Seltos', 'Suzuki Baleno')) OR "
    "(vehicle_type = 'bike' AND vehicle_name IN ('Royal Enfield Classic', 'Bajaj Pulsar', 'TVS Apache', 'Hero Splendor', "
    "'Honda Activa', 'Yamaha FZ', 'Suzuki Gixxer', 'KTM Duke'))",
    "phone_number": "regexp_full_match(phone_number, '[789][0-9]{8}')",
    "speed": "speed BETWEEN 20 AND 200",
    "location_lat": "location_lat BETWEEN 18.5 AND 19",
    "location_lon": "location_lon BETWEEN 73.7 AND 74",
    "user_id": "user_id BETWEEN 1 AND 1000",
    "car_life_years": "car_life_years BETWEEN 1 AND 15",
    "price_of_vechical": "price_of_vechical BETWEEN 100000 AND 2000000",
    "fine": "fine = CASE WHEN round(speed, 2) > 150 THEN 1000 ELSE 0 END",
    "timestamp": '"timestamp" IS NOT NULL',
}
_REASONS = "concat_ws(',', " + ", ".join(
    f"CASE WHEN {ok} THEN NULL ELSE '{name}' END" for name, ok in _RULES.items()
) + ")"

ORACLE: dict[str, str] = {
    "q01_decode_json": "SELECT event_id, CAST(json_extract(props, '$.k') AS INT) AS k FROM events",
    "q02_enrich_event_time": f"WITH {_ENRICHED} SELECT event_id, {_PROCESSED_LIST} FROM enriched",
    "q03_speed_fine": f"""WITH {_TELEMETRY}
SELECT event_id, round(speed, 2) AS speed, round(location_lat, 6) AS location_lat,
  round(location_lon, 6) AS location_lon, round(price_of_vechical, 2) AS price_of_vechical,
  CASE WHEN speed > 150 THEN 1000 ELSE 0 END AS fine
FROM telemetry""",
    "q04_overspeed_alerts": f"WITH {_TELEMETRY}, {_ALERTS} SELECT * FROM alerts",
    "q05_assign_batches": f"WITH {_BATCHES} SELECT * FROM batched",
    "q06_batch_row_counts": f"""WITH {_BATCHES}
SELECT bucket_start, batch_no, count(*) AS n_rows FROM batched GROUP BY bucket_start, batch_no""",
    "q07_raw_csv_roundtrip": f"WITH {_TELEMETRY} SELECT {_EVENT_LIST} FROM telemetry",
    "q08_stream_csv_to_parquet": f"WITH {_ENRICHED} SELECT {_PROCESSED_LIST} FROM enriched",
    "q09_processed_scan": f"WITH {_ENRICHED} SELECT {_PROCESSED_LIST} FROM enriched",
    "q10_time_range": f"""WITH {_ENRICHED} SELECT {_PROCESSED_LIST} FROM enriched
WHERE event_time >= TIMESTAMP '2024-01-08 06:00:00' AND event_time < TIMESTAMP '2024-01-15 18:30:00'""",
    "q11_preview": f"""WITH {_ENRICHED}
SELECT vehicle_id, number_plate, speed, event_time FROM enriched ORDER BY event_id LIMIT 5""",
    "q12_union_by_name": f"""WITH {_TELEMETRY}, {_ALERTS}
SELECT event_id, vehicle_id, location_lat, location_lon FROM telemetry
UNION ALL BY NAME SELECT phone_number, vehicle_id, event_id FROM telemetry
UNION ALL BY NAME SELECT event_id, vehicle_id, speed, phone_number, message FROM alerts""",
    "q13_coerce_event_time": """SELECT event_id, ts AS event_time,
  CASE WHEN event_type = 'error' THEN NULL ELSE ts END AS processing_time
FROM events""",
    "q14_null_normalise": f"""WITH {_TELEMETRY}
SELECT * REPLACE (CASE WHEN speed > 200 THEN NULL ELSE speed END AS speed) FROM telemetry""",
    "q15_dedupe_latest": f"""WITH {_ENRICHED} SELECT event_id, {_PROCESSED_LIST} FROM enriched
QUALIFY row_number() OVER (
  PARTITION BY vehicle_id, "year", "month", "day" ORDER BY "timestamp" DESC, event_id DESC) = 1""",
    "q16_upsert": f"WITH {_LOADS} SELECT {_TARGET_LIST} FROM merged",
    "q17_upsert_twice": f"WITH {_LOADS} SELECT {_TARGET_LIST} FROM merged",
    "q18_stream_upsert": f"WITH {_LOADS} SELECT {_PROCESSED_LIST} FROM merged",
    "q19_quality_split": f"""WITH {_TELEMETRY}, flagged AS (SELECT event_id, {_REASONS} AS reasons FROM telemetry)
SELECT event_id, reasons = '' AS accepted, reasons FROM flagged""",
    "q20_encode_decode": f"WITH {_TELEMETRY} SELECT event_id, {_EVENT_LIST} FROM telemetry",
    "q21_quarantine": f"""WITH {_TELEMETRY}
SELECT event_id, CASE
  WHEN fine > 0 THEN 'malformed_json'
  WHEN vehicle_type = 'car' AND speed > 100 THEN 'null_value'
  WHEN speed < 1 THEN 'null_key'
  ELSE 'loaded' END AS outcome
FROM telemetry""",
    "q22_conform_to_target": f"""WITH {_ENRICHED},
loose AS (
  SELECT * REPLACE (CASE WHEN fine > 0 THEN NULL ELSE speed END AS speed, CAST(NULL AS DOUBLE) AS price_of_vechical),
    TIMESTAMP '2024-02-01 00:00:00' AS last_updated
  FROM enriched
)
SELECT {_TARGET_LIST} FROM loose""",
    "q23_require_and_rename": "SELECT event_id, ts AS event_time, value AS speed FROM events",
    "q24_audit_stamp": f"""WITH {_TELEMETRY}
SELECT vehicle_id, "timestamp", TIMESTAMP '2024-02-01 00:00:00' AS last_updated FROM telemetry""",
    "q25_raw_days": f"""WITH {_ENRICHED} SELECT {_EVENT_LIST} FROM enriched
WHERE CAST(event_time AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'""",
    "q26_partition_recovery": f"""WITH {_ENRICHED} SELECT {_EVENT_LIST}, event_time, "year", "month",
  CASE WHEN vehicle_type = 'car' THEN CAST("day" AS VARCHAR) END AS "day"
FROM enriched""",
    "q27_assign_batches_across_tasks": f"WITH {_BATCHES} SELECT * FROM batched",
    "q28_stream_ingest": f"""WITH {_TELEMETRY}
SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS files_too_large, sum(user_id)::BIGINT AS users, sum(fine)::BIGINT AS fines,
  sum(CAST(round(speed * 100) AS BIGINT))::BIGINT AS speeds, sum(CAST(phone_number AS BIGINT))::BIGINT AS phones
FROM telemetry""",
    "q29_full_run": f"WITH {_LOADS} SELECT {_PROCESSED_LIST} FROM first_load",
    "q30_micro_precision": """SELECT event_id, ts AS event_time, CAST(year(ts) AS INT) AS "year",
  CAST(month(ts) AS INT) AS "month", CAST(day(ts) AS INT) AS "day"
FROM events""",
    # A full load stamps every row it merges, so all rows carry the time of the last run.
    "q31_full_load": f"""WITH {_LOADS}
SELECT {_PROCESSED_LIST}, TIMESTAMP '2024-03-02 00:00:00' AS last_updated FROM merged""",
    "q32_upsert_null_keys": f"""WITH {_LOADS},
keyed AS (
  SELECT * FROM enriched WHERE speed >= 1
  QUALIFY row_number() OVER (PARTITION BY vehicle_id, event_time ORDER BY "timestamp" DESC, event_id DESC) = 1
),
unkeyed AS (SELECT * REPLACE (CAST(NULL AS TIMESTAMP) AS event_time) FROM enriched WHERE speed < 1)
SELECT vehicle_id, phone_number, speed, event_time FROM keyed
UNION ALL SELECT vehicle_id, phone_number, speed, event_time FROM unkeyed
UNION ALL SELECT vehicle_id, phone_number, speed, event_time FROM unkeyed""",
    "q33_stream_contract": f"""WITH {_ENRICHED}
SELECT {_PROCESSED_LIST} FROM enriched WHERE {_REASONS} = ''""",
    "q34_replay_across_jobs": f"WITH {_ENRICHED} SELECT {_PROCESSED_LIST} FROM enriched",
    "q35_load_order": f"""WITH {_TELEMETRY},
later AS (
  SELECT * REPLACE (speed + 1 AS speed, floor("timestamp") + CAST(0.9 AS DOUBLE) AS "timestamp") FROM telemetry
),{_enriched("later_enriched", "later")}
SELECT {_PROCESSED_LIST} FROM later_enriched
QUALIFY row_number() OVER (PARTITION BY vehicle_id, event_time ORDER BY "timestamp" DESC, event_id DESC) = 1""",
    "q36_decode_strict": f"""WITH {_TELEMETRY}
SELECT event_id, CASE WHEN event_id % 4 IN (0, 1) THEN 'malformed_json' END AS decode_error,
  CASE WHEN event_id % 4 = 2 THEN 'colour' WHEN event_id % 4 = 3 THEN '' END AS "unknown",
  vehicle_id
FROM telemetry""",
    "q37_raw_csv_text": f"""WITH {_TELEMETRY},
named AS (
  SELECT vehicle_id, phone_number, CASE event_id % 4 WHEN 0 THEN '  ' || vehicle_name || ' '
    WHEN 1 THEN '"' || vehicle_name || '", "x"' WHEN 2 THEN vehicle_name || chr(10) || 'line, two'
    ELSE vehicle_name END AS vehicle_name
  FROM telemetry
)
SELECT * FROM named UNION ALL SELECT * FROM named""",
    "q38_upsert_many_days": f"WITH {_LOADS} SELECT {_TARGET_LIST} FROM merged",
    "q39_unfit_values": f"""WITH {_TELEMETRY},
checked AS (
  SELECT event_id, concat_ws(',', CASE WHEN fine > 0 THEN 'speed' END, CASE WHEN vehicle_type = 'bike' THEN 'user_id' END) AS bad
  FROM telemetry
)
SELECT event_id, CASE WHEN bad = '' THEN 'loaded' ELSE 'set aside' END AS outcome, nullif(bad, '') AS "columns" FROM checked""",
    "q40_stream_alerts": f"""WITH {_TELEMETRY}, {_ALERTS}
SELECT vehicle_id, speed, fine, phone_number, message FROM alerts""",
    "q41_observed_counts": f"""WITH {_LOADS},
fined AS (
  SELECT count(*) AS n FROM (SELECT DISTINCT vehicle_id, event_time FROM resent_enriched WHERE fine > 0)
),
touched AS (
  SELECT count(*) AS n FROM first_load f
  WHERE (f."year", f."month", f."day") IN (SELECT ("year", "month", "day") FROM resent_enriched WHERE fine > 0)
    AND (f.vehicle_id, f.event_time) NOT IN (SELECT (vehicle_id, event_time) FROM resent_enriched WHERE fine > 0)
)
SELECT 'written' AS what, count(*) AS n FROM telemetry WHERE fine = 0
UNION ALL SELECT 'left_out', count(*) FROM telemetry WHERE fine > 0
UNION ALL SELECT 'first_load', count(*) FROM first_load
UNION ALL SELECT 'second_load', n FROM fined
UNION ALL SELECT 'carried_over', n FROM touched""",
    "q42_other_suffixes": f"WITH {_ENRICHED} SELECT {_PROCESSED_LIST} FROM enriched",
    "q43_files_per_trigger": "SELECT count(*) AS n_rows, true AS within_limit FROM events",
    # Where each batch begins, followed from one to the next.
    "q44_closed_batches": f"""WITH RECURSIVE {_ENRICHED},
placed AS (
  SELECT event_id, event_time, least(event_id % 6, 2) AS topic_partition,
    row_number() OVER (PARTITION BY least(event_id % 6, 2) ORDER BY event_time, event_id) - 1 AS pos
  FROM enriched
),
steps AS (
  SELECT topic_partition, pos, least(pos + 56, count(*) OVER (
    PARTITION BY topic_partition ORDER BY event_time RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 21599 SECONDS FOLLOWING)) AS next
  FROM placed
),
starts AS (
  SELECT topic_partition, pos, next, CAST(0 AS BIGINT) AS batch_no FROM steps WHERE pos = 0
  UNION ALL
  SELECT s.topic_partition, s.pos, s.next, b.batch_no + 1
  FROM starts b JOIN steps s ON s.topic_partition = b.topic_partition AND s.pos = b.next
)
SELECT p.event_id, p.event_time, p.topic_partition, b.batch_no
FROM placed p ASOF JOIN starts b ON p.topic_partition = b.topic_partition AND p.pos >= b.pos""",
    "q45_change_feed": f"""WITH {_CHANGES}
SELECT {_TARGET_LIST}, change FROM outcome WHERE change <> 'unchanged'""",
    "q46_keyed_table": f"""WITH {_CHANGES}
SELECT {_TARGET_LIST} FROM outcome WHERE change <> 'unchanged'
UNION ALL
SELECT {_TARGET_LIST} FROM first_load f
WHERE NOT EXISTS (SELECT 1 FROM outcome o WHERE o.vehicle_id = f.vehicle_id AND o.event_time = f.event_time AND change <> 'unchanged')""",
    "q47_change_counts": f"""WITH {_CHANGES}
SELECT 'first' AS load, count(*) AS inserted, CAST(0 AS BIGINT) AS updated, CAST(0 AS BIGINT) AS unchanged, true AS rewrites FROM first_load
UNION ALL SELECT 'second', count(*) FILTER (change = 'inserted'), count(*) FILTER (change = 'updated'),
  count(*) FILTER (change = 'unchanged'), true FROM outcome
UNION ALL SELECT 'again', 0, 0, count(*), false FROM outcome""",
    "q48_drifting_fields": f"""WITH {_TELEMETRY}
SELECT event_id, vehicle_id, CASE WHEN fine > 0 THEN 'red' END AS colour, CASE WHEN fine > 0 THEN user_id % 4 END AS lane,
  CASE WHEN fine > 0 THEN CAST(user_id % 4 AS VARCHAR) WHEN vehicle_type = 'bike' THEN 'left' END AS lane_text,
  CASE WHEN fine = 0 AND vehicle_type = 'bike' THEN '{{"n":2}}' END AS axles
FROM telemetry""",
    "q49_offset_findings": f"""WITH {_TELEMETRY},
messages AS (
  SELECT event_id % 3 AS "partition", event_id // 3 AS "offset", speed <= 150 AS kept, (event_id // 3) % 1000 BETWEEN 600 AND 699 AS twice
  FROM telemetry
),
spans AS (SELECT "partition", min("offset") AS low, max("offset") AS high FROM messages WHERE kept GROUP BY "partition"),
flagged AS (
  SELECT "partition", 'skipped' AS kind, "offset" FROM messages JOIN spans USING ("partition") WHERE NOT kept AND "offset" BETWEEN low AND high
  UNION ALL SELECT "partition", 'doubled', "offset" FROM messages WHERE kept AND twice
),
islands AS (SELECT *, "offset" - row_number() OVER (PARTITION BY "partition", kind ORDER BY "offset") AS island FROM flagged)
SELECT "partition", kind, min("offset") AS first, max("offset") AS last FROM islands GROUP BY "partition", kind, island""",
    "q50_audit_table": f"""WITH {_TELEMETRY}, flagged AS (SELECT *, {_REASONS} AS reasons FROM telemetry)
SELECT 'ingest' AS job, count(*) AS rows_in, count(*) FILTER (fine = 0) AS "rows", count(*) FILTER (fine > 0) AS left_out FROM flagged
UNION ALL SELECT 'enrich', count(*), count(*) FILTER (reasons = ''), count(*) FILTER (reasons <> '') FROM flagged WHERE fine = 0""",
    "q51_uneven_days": f"""WITH {_ENRICHED} SELECT {_EVENT_LIST}, event_time, "year", "month",
  CASE WHEN vehicle_type = 'car' THEN CAST("day" AS VARCHAR) END AS "day"
FROM enriched WHERE "year" = 2024 AND "month" = 1 AND (vehicle_type = 'bike' OR "day" BETWEEN 8 AND 14)""",
    "q52_repeated_keys": f"""WITH {_ENRICHED}
SELECT vehicle_id, event_time, CAST(sum(CASE WHEN fine > 0 THEN 2 ELSE 1 END) AS BIGINT) AS n_rows
FROM enriched GROUP BY vehicle_id, event_time HAVING n_rows > 1""",
    "q53_downward_corrections": f"""WITH {_LOADS} SELECT {_PROCESSED_LIST} FROM first_load""",
    "q54_stream_changes": f"""WITH {_LOADS}
SELECT {", ".join("m." + c.strip() for c in _PROCESSED_LIST.split(","))},
  CAST(CASE WHEN f.vehicle_id IS NOT NULL AND s.vehicle_id IS NOT NULL THEN 2 ELSE 1 END AS BIGINT) AS n_changes,
  CASE WHEN s.vehicle_id IS NULL THEN NULL WHEN f.vehicle_id IS NULL THEN 'inserted' ELSE 'updated' END AS in_last
FROM merged m LEFT JOIN first_load f ON f.vehicle_id = m.vehicle_id AND f.event_time = m.event_time
LEFT JOIN second_load s ON s.vehicle_id = m.vehicle_id AND s.event_time = m.event_time""",
}
