"""DuckDB SQL for each named query (``oracle_sql()`` entries).

The SQL is written independently from the Spark code, from the semantics in
rule parameters mirror ``plans.fixture``.
"""

from __future__ import annotations

from terrarium.plans import fixture as FX

D = FX.DIGITS


def _mac_sql(col: str = "user_id") -> str:
    m = f"lower(printf('%012x', {col}))"
    parts = ", ".join(f"substr({m}, {i}, 2)" for i in range(1, 13, 2))
    return f"concat_ws(':', {parts})"


READINGS = f"""
readings AS (
  SELECT event_id,
         ts AS "timestamp",
         {_mac_sql()} || '-weight' AS sensor,
         CASE WHEN k < 5 THEN -999.0::DOUBLE ELSE value END AS temperature_c,
         (CASE WHEN k < 5 THEN -999.0::DOUBLE ELSE value END) * 9.0 / 5.0 + 32.0 AS temperature_f,
         190.0::DOUBLE + 2 * value AS grams,
         3.0::DOUBLE * k AS stddev,
         CAST(user_id AS VARCHAR) AS tag_user,
         CASE WHEN user_id % 10 <> 0 THEN event_type END AS tag_plant,
         user_id, event_type, value, k
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events) e
)"""


def _weights_where() -> str:
    conds = [f"grams IS NOT NULL", f"stddev < {FX.MAX_STDDEV}", f"grams < {FX.HI}",
             f"grams > {FX.LO}"]
    for c in FX.CAPS:
        conds.append(f"NOT (sensor = '{c.sensor}' AND {c.column} > {c.limit})")
    for r in FX.RETIRES:
        conds.append(f"NOT (sensor = '{r.sensor}' AND \"timestamp\" >= TIMESTAMP '{r.since}')")
    return " AND ".join(conds)


WEIGHTS = f"""{READINGS},
weights AS (
  SELECT * FROM (SELECT * REPLACE (tag_plant AS sensor) FROM readings) r
  WHERE {_weights_where()}
),
ranges AS (
  SELECT sensor, min(grams) AS "min", max(grams) AS "max" FROM weights GROUP BY sensor
)"""

TEMPS = f"""{READINGS},
temps AS (
  SELECT * REPLACE (tag_user AS sensor) FROM readings WHERE temperature_c <> -999
)"""


def _bucket(width: str = "10 minutes", col: str = '"timestamp"') -> str:
    return f"time_bucket(INTERVAL '{width}', {col})"


def _rollup(src: str, values: list[str], keys: list[str]) -> str:
    k = "".join(f", {x}" for x in keys)
    v = ", ".join(f"round(avg({x}), {D}) AS {x}" for x in values)
    n = 1 + len(keys)
    return (f"SELECT {_bucket()} AS \"timestamp\"{k}, {v} FROM {src} "
            f"WHERE \"timestamp\" IS NOT NULL GROUP BY {', '.join(str(i) for i in range(1, n + 1))}")


WATER = f"""{WEIGHTS},
water AS (
  SELECT w.event_id, w."timestamp", w.sensor, w.grams, r."min", r."max",
         w.grams - r."min" AS water
  FROM weights w JOIN ranges r ON w.sensor = r.sensor
),
water_rel AS (
  SELECT w.event_id, w."timestamp", w.sensor, w.grams, r."min", r."max",
         (w.grams - r."min") / nullif(r."max" - r."min", 0) AS water
  FROM weights w JOIN ranges r ON w.sensor = r.sensor
)"""

EVAPORATION = f"""{WEIGHTS},
evaporation AS (
  SELECT {_bucket('5 minutes')} + INTERVAL '5 minutes' AS "timestamp", sensor,
         min({{'ts': "timestamp", 'g': grams}}).g - max({{'ts': "timestamp", 'g': grams}}).g AS ml_hour
  FROM weights
  WHERE sensor IN (SELECT sensor FROM ranges WHERE sensor IS NOT NULL)
    AND "timestamp" IS NOT NULL
  GROUP BY 1, 2
  HAVING ml_hour > 0 AND ml_hour < 30
)"""


def _r(cols: list[str]) -> str:
    return ", ".join(f"round({c}, {D}) AS {c}" for c in cols)


SQL = {
    "weights": f"WITH {WEIGHTS} SELECT event_id, \"timestamp\", sensor, grams, stddev FROM weights",
    "weights_10min": f"WITH {WEIGHTS} {_rollup('weights', ['grams', 'stddev'], ['sensor'])}",
    "all_10min": f"WITH {WEIGHTS} {_rollup('weights', ['grams', 'stddev'], [])}",
    "ranges": f"WITH {WEIGHTS} SELECT * FROM ranges",
    "water": f"WITH {WATER} SELECT event_id, \"timestamp\", sensor, round(grams, {D}) AS grams, "
             f"round(\"min\", {D}) AS \"min\", round(\"max\", {D}) AS \"max\", "
             f"round(water, {D}) AS water FROM water",
    "water_rel": f"WITH {WATER} SELECT event_id, \"timestamp\", sensor, round(grams, {D}) AS grams, "
                 f"round(\"min\", {D}) AS \"min\", round(\"max\", {D}) AS \"max\", "
                 f"round(water, {D}) AS water FROM water_rel",
    "water_10min": f"WITH {WATER} {_rollup('water', ['water'], ['sensor'])}",
    "water_rel_10min": f"WITH {WATER} {_rollup('water_rel', ['water'], ['sensor'])}",
    "evaporation": f"WITH {EVAPORATION} SELECT \"timestamp\", sensor, round(ml_hour, {D}) AS ml_hour, "
                   f"round(ml_hour * 3600.0 / 300, {D}) AS rate_per_hour FROM evaporation",
    "evaporation_10min": f"WITH {EVAPORATION} {_rollup('evaporation', ['ml_hour'], ['sensor'])}",
    "temperatures": f"WITH {TEMPS} SELECT event_id, \"timestamp\", sensor, "
                    f"{_r(['temperature_c', 'temperature_f'])} FROM temps",
    "temperatures_10min": f"WITH {TEMPS} {_rollup('temps', ['temperature_f'], ['sensor'])}",
}


# ---------------------------------------------------------------------------
# Device inputs derived from events
# ---------------------------------------------------------------------------


def hmac_sql(body_sql: str, key: str) -> str:
    """HMAC-SHA1 (RFC 2104) of a text as DuckDB SQL, for keys of up to 64
    bytes, written from the definition."""
    block = key.encode().ljust(64, b"\0")
    inner, outer = (bytes(x ^ pad for x in block).hex() for pad in (0x36, 0x5C))
    return f"sha1(unhex('{outer}') || unhex(sha1(unhex('{inner}') || encode({body_sql}))))"


EV = f"""
e AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
         lower(printf('%012x', user_id)) AS hex12,
         {_mac_sql()} AS cmac,
         CASE WHEN event_type = 'purchase' THEN 'dht' WHEN event_type = 'signup' THEN 'rbg'
              ELSE 'weight' END AS ch
  FROM events
)"""

PAYLOADS = f"""{EV},
b AS (
  SELECT event_id, event_type, k,
    '{{"sensor":"' || cmac || '-' || ch || '"' ||
    CASE WHEN k >= 10 THEN ',"sec":' || (epoch_us(ts) // 1000000) || ',"usec":' || (epoch_us(ts) % 1000000)
         ELSE ',"timestamp":"' || strftime(ts, '%Y-%m-%d %H:%M:%S') || ' -0000"' END ||
    CASE WHEN ch = 'dht' THEN ',"temperature_c":' ||
              (CASE WHEN k % 2 = 0 THEN CAST(CAST(floor(value) AS BIGINT) AS VARCHAR)
                    ELSE printf('%.2f', value) END) || ',"humidity":' || k
         WHEN ch = 'rbg' THEN ',"clear":' || k || ',"red":' || (k * 2)
         ELSE ',"grams":' || printf('%.2f', 190.0::DOUBLE + 2 * value) || ',"stddev":' || (k * 3) END ||
    CASE WHEN event_type = 'signup' THEN ',"tags":{{"source":"device"}}' ELSE '' END ||
    CASE WHEN k = 7 THEN ',"firmware":{{"v":7}}' ELSE '' END ||
    ',"git_hash":"f1"}}' AS whole_body,
    CASE WHEN k = 8 THEN substr(whole_body, 1, 30) ELSE whole_body END AS signed_body
  FROM e
),
pay AS (
  SELECT event_id,
    CASE WHEN k BETWEEN 3 AND 5 THEN replace(signed_body, '"git_hash":"f1"', '"git_hash":"f2"')
         ELSE signed_body END AS body,
    CASE WHEN k < 3 THEN ''
         WHEN event_type = 'error' THEN {hmac_sql('signed_body', FX.WRONG_KEY)}
         WHEN k = 6 THEN upper({hmac_sql('signed_body', FX.SIGNING_KEY)})
         ELSE {hmac_sql('signed_body', FX.SIGNING_KEY)} END AS signature
  FROM b
),
checked AS (
  SELECT *, coalesce(signature = {hmac_sql('body', FX.SIGNING_KEY)}, false) AS valid FROM pay
)"""

ENRICH = f"""{PAYLOADS},
dim AS (
  SELECT lower(printf('%012x', user_id)) AS dmac, 'u' || user_id AS d_user, 'plant-' || min(k) AS d_plant
  FROM e GROUP BY user_id
  HAVING max(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) = 1
),
parsed AS (
  SELECT event_id,
    CAST(json_extract(body, '$.sec') AS BIGINT) AS sec,
    json_extract_string(body, '$.timestamp') AS ts_text,
    replace(json_extract_string(body, '$.sensor'), ':', '') AS sensor,
    CAST(json_extract(body, '$.temperature_c') AS DOUBLE) AS temperature_c,
    CAST(json_extract(body, '$.humidity') AS DOUBLE) AS humidity,
    CAST(json_extract(body, '$.grams') AS DOUBLE) AS grams,
    CAST(json_extract(body, '$.stddev') AS DOUBLE) AS stddev,
    CAST(json_extract(body, '$.clear') AS DOUBLE) AS clear,
    CAST(json_extract(body, '$.red') AS DOUBLE) AS red,
    json_extract_string(body, '$.git_hash') AS git_hash,
    json_extract_string(body, '$.tags.user') AS own_user,
    json_extract_string(body, '$.tags.plant') AS own_plant,
    json_extract_string(body, '$.tags.source') AS own_source,
    CAST(json_extract(body, '$.firmware') AS VARCHAR) AS firmware
  FROM (SELECT * FROM checked WHERE valid AND json_valid(body)) c
)"""

CALIB = f"""{EV},
bursts AS (
  SELECT sensor, reading_ts, i, value * 100 + ((k * (i + 3)) % 17) - 8 AS v
  FROM (SELECT hex12 || '-weight' AS sensor, ts AS reading_ts, value, k,
               unnest(range(0, k % 10 + 1)) AS i
        FROM e WHERE event_type IN ('view', 'click', 'error')) x
),
stats AS (
  SELECT sensor, reading_ts, count(v) AS n, avg(v) AS raw,
         CASE WHEN count(v) > 2 THEN sqrt(var_pop(v) * count(v) / (count(v) - 2)) END AS stddev
  FROM bursts GROUP BY sensor, reading_ts
),
cal AS (
  SELECT hex12 || '-weight' AS sensor,
         CASE WHEN event_type = 'signup' THEN 'zero' ELSE '1kg' END AS point, ts,
         CASE WHEN event_type = 'signup' THEN value * 10 ELSE value * 10 + 1000 END AS raw
  FROM e WHERE event_type IN ('signup', 'purchase')
),
z AS (SELECT sensor, ts, raw AS zero FROM cal WHERE point = 'zero'),
o AS (SELECT sensor, ts, raw AS one_kg FROM cal WHERE point = '1kg'),
cw AS (
  SELECT s.sensor, s.reading_ts AS "timestamp", s.raw,
         coalesce(z.zero, 1000.0::DOUBLE) AS zero, coalesce(o.one_kg, 1000.0::DOUBLE) AS one_kg
  FROM stats s
  ASOF LEFT JOIN z ON s.sensor = z.sensor AND s.reading_ts >= z.ts
  ASOF LEFT JOIN o ON s.sensor = o.sensor AND s.reading_ts >= o.ts
)"""

NL = "chr(10)"
_F = "(1.27::DOUBLE - -39.75::DOUBLE - 0.25::DOUBLE)"

SQL.update({
    "enrich_readings": f"""WITH {ENRICH}
SELECT p.event_id,
  CASE WHEN sec IS NOT NULL THEN strftime(make_timestamp(sec * 1000000), '%Y-%m-%d %H:%M:%S') || ' -0000'
       ELSE ts_text END AS "timestamp",
  sensor, substr(sensor, 1, 12) AS mac,
  round(temperature_c, {D}) AS temperature_c,
  round(temperature_c * 9.0 / 5.0 + 32.0, {D}) AS temperature_f,
  round(humidity, {D}) AS humidity, round(grams, {D}) AS grams, round(stddev, {D}) AS stddev,
  round(clear, {D}) AS clear, round(red, {D}) AS red, git_hash, firmware,
  CASE WHEN d.dmac IS NOT NULL THEN d.d_user ELSE own_user END AS tag_user,
  CASE WHEN d.dmac IS NOT NULL THEN d.d_plant ELSE own_plant END AS tag_plant,
  CASE WHEN d.dmac IS NOT NULL THEN NULL ELSE own_source END AS tag_source
FROM parsed p LEFT JOIN dim d ON substr(p.sensor, 1, 12) = d.dmac""",
    "signature_check": f"WITH {PAYLOADS} SELECT event_id, valid FROM checked",
    "sensor_channel": f"""WITH {PAYLOADS}
SELECT event_id, s AS sensor, substr(s, 1, 12) AS mac, split_part(s, '-', 2) AS channel
FROM (SELECT event_id, CASE WHEN json_valid(body) THEN replace(json_extract_string(body, '$.sensor'), ':', '') END AS s
      FROM pay) x""",
    "rejected_payloads": f"""WITH {PAYLOADS}
SELECT event_id, CASE WHEN NOT valid THEN 'invalid signature' ELSE 'malformed body' END AS reason
FROM checked WHERE NOT valid OR NOT json_valid(body)""",
    "parse_timestamps": """SELECT event_id,
  strftime(ts, '%Y-%m-%d %H:%M:%S') || ' -0000' AS text,
  strptime(strftime(ts, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS parsed,
  timezone('UTC', strptime(strftime(ts, '%Y-%m-%d %H:%M:%S') || ' -0800', '%Y-%m-%d %H:%M:%S %z')) AS parsed_zoned,
  strftime(ts, '%Y-%m-%d %H:%M:%S') || ' +0000' AS formatted,
  epoch_us(ts) // 1000 AS epoch_ms,
  make_timestamp((epoch_us(ts) // 1000000) * 1000000) AS from_sec
FROM events""",
    "json_project": f"""WITH {READINGS}
SELECT 'readings' AS topic, CAST(user_id % 4 AS INTEGER) AS "partition",
  row_number() OVER (PARTITION BY user_id % 4 ORDER BY event_id) - 1 AS "offset",
  "timestamp", sensor, grams, stddev, temperature_c, tag_plant AS plant, tag_user AS "user"
FROM readings""",
    "landed_lines": f"""WITH l AS (
  SELECT event_id, CASE WHEN event_type = 'error' THEN printf('%.2f', value)
                        WHEN event_type = 'signup' THEN 'x,kg'
                        ELSE printf('%.2f', value) || ',kg' END AS line
  FROM events),
n AS (SELECT event_id, line, TRY_CAST(trim(string_split(line, ',')[1]) AS DOUBLE) AS number
      FROM l WHERE len(string_split(line, ',')) > 1)
SELECT event_id, line, round(number, {D}) AS number,
  round((number + {_F}) * 1000.0 + 1.6, {D}) AS weight,
  round((number + {_F}) * 1000.0 + 1.6, {D}) AS grams
FROM n""",
    "onewire_payload": f"""WITH {EV},
w AS (
  SELECT event_id, '28-' || hex12 AS sensor,
    '4b 46 7f ff 0c 10 1c : crc=1c ' || CASE WHEN k >= 10 THEN 'YES' ELSE 'NO' END || {NL} ||
    '4b 46 7f ff 0c 10 1c t=' ||
    (CAST(round(value * 1000) AS BIGINT) * CASE WHEN event_type = 'error' THEN -1 ELSE 1 END) || {NL}
    AS payload
  FROM e),
t AS (
  SELECT event_id, sensor,
    TRY_CAST(regexp_extract(trim(split_part(payload, {NL}, 2)), 't=(-?[0-9]+)$', 1) AS INTEGER) / 1000.0::DOUBLE
      AS temperature_c
  FROM w WHERE rtrim(split_part(payload, {NL}, 1)) LIKE '%YES')
SELECT event_id, sensor, round(temperature_c, {D}) AS temperature_c,
  round(temperature_c * 9.0 / 5.0 + 32.0, {D}) AS temperature_f
FROM t WHERE temperature_c IS NOT NULL""",
    "observation_payload": """SELECT event_id, 'station-' || event_type AS sensor,
  timezone('UTC', strptime(strftime(ts, '%a, %d %b %Y %H:%M:%S') || ' -0800', '%a, %d %b %Y %H:%M:%S %z')) AS "timestamp",
  CAST(printf('%.2f', value) AS DOUBLE) AS temp_c, 'S' || user_id AS station_id
FROM events""",
    "burst_stats": f"""WITH {CALIB}
SELECT sensor, reading_ts, n, round(raw, {D}) AS raw, round(stddev, {D}) AS stddev FROM stats""",
    "calibrated_weight": f"""WITH {CALIB}
SELECT sensor, "timestamp", round(raw, {D}) AS raw, round(zero, {D}) AS zero, round(one_kg, {D}) AS one_kg,
  round((raw - zero) * 1000.0 / nullif(one_kg - zero, 0), {D}) AS grams
FROM cw""",
})


# ---------------------------------------------------------------------------
# Log, snapshot and serving
# ---------------------------------------------------------------------------

SINCE = "2024-01-15 00:00:00"

_START_TXT = "strftime(start, '%Y-%m-%d %H:%M:%S') || ' +0000'"
KEYED = f"""{WEIGHTS},
klog AS (
  SELECT event_id, start, sensor, grams, "timestamp" AS logged,
    CASE WHEN sensor IS NULL THEN '{{"timestamp":"' || {_START_TXT} || '"}}'
         ELSE '{{"timestamp":"' || {_START_TXT} || '","sensor":"' || sensor || '"}}' END AS key,
    CAST((epoch_us(start) // 600000000) % 4 AS INTEGER) AS "partition"
  FROM (SELECT *, time_bucket(INTERVAL '10 minutes', "timestamp") AS start FROM weights) w
),
klog_n AS (
  SELECT *, event_id AS "offset" FROM klog
)"""

SQL.update({
    "latest_by_key": f"""WITH {KEYED},
numbered AS (
  SELECT * REPLACE (row_number() OVER (PARTITION BY "partition" ORDER BY event_id) - 1 AS "offset") FROM klog_n
)
SELECT key, "partition", "offset", start AS "timestamp", sensor, grams
FROM numbered QUALIFY row_number() OVER (PARTITION BY key ORDER BY "offset" DESC) = 1""",
    "snapshot_since": f"""WITH {KEYED},
kept AS (
  SELECT * FROM klog_n WHERE logged >= TIMESTAMP '{SINCE}' AND start > TIMESTAMP '{SINCE}'
)
SELECT 'weights-10min' AS topic, key, start AS "timestamp", sensor, grams
FROM kept QUALIFY row_number() OVER (PARTITION BY key ORDER BY "offset" DESC) = 1
UNION ALL
SELECT 'readings' AS topic, NULL AS key, "timestamp", sensor, grams
FROM readings WHERE "timestamp" >= TIMESTAMP '{SINCE}' AND "timestamp" > TIMESTAMP '{SINCE}'""",
    "series_points": f"""WITH {WEIGHTS}
SELECT sensor AS series, "timestamp" AS x, grams AS y FROM weights WHERE "timestamp" IS NOT NULL""",
    "series_distinct": f"WITH {WEIGHTS} SELECT DISTINCT sensor AS series FROM weights",
    "y_range": f"WITH {WEIGHTS} SELECT min(grams) AS min_y, max(grams) AS max_y FROM weights",
    "export_rows": f"""WITH {ENRICH}
SELECT CASE WHEN sec IS NOT NULL
            THEN strftime(make_timestamp(sec * 1000000), '%Y-%m-%d %H:%M:%S') || ' -0000'
            ELSE ts_text END AS "timestamp",
  sensor AS name, temperature_c AS temp, coalesce(CAST(humidity AS VARCHAR), '') AS humidity
FROM parsed""",
})


# ---------------------------------------------------------------------------
# Streams (compared with the batch semantics they must reproduce)
# ---------------------------------------------------------------------------

TAIL_SPLIT = "2024-01-15 00:00:00"

SQL.update({
    # the raw sink writes whole-second time text, as the reference's sink does
    "stream_raw_weights": f"""WITH {WEIGHTS}
SELECT event_id, date_trunc('second', "timestamp") AS "timestamp", sensor, grams, stddev FROM weights""",
    "stream_weights_10min": SQL["weights_10min"],
    "stream_evaporation_10min": SQL["evaporation_10min"],
    "stream_current_10min": SQL["weights_10min"],
    "stream_tail": f"""WITH {READINGS}
SELECT event_id, "timestamp", sensor, grams,
  CASE WHEN "timestamp" < TIMESTAMP '{TAIL_SPLIT}' THEN 'snapshot' ELSE 'tail' END AS served FROM readings""",
    "stream_water_10min": SQL["water_10min"],
    "stream_temperatures_10min": SQL["temperatures_10min"],
})
SQL["stream_latest_point"] = f"""WITH {WEIGHTS}
SELECT sensor AS series, date_trunc('hour', "timestamp") AS x, grams AS y, event_id FROM weights
QUALIFY row_number() OVER (PARTITION BY sensor, date_trunc('hour', "timestamp") ORDER BY event_id DESC) = 1"""
SQL["stream_tail_latest"] = f"""WITH {READINGS}
SELECT event_id, "timestamp", sensor, grams FROM readings
WHERE "timestamp" >= TIMESTAMP '{TAIL_SPLIT}' OR "timestamp" IS NULL"""

SQL.update({
    "history_age": SQL["snapshot_since"].replace(SINCE, "2024-01-16 00:00:00"),
    "one_series": SQL["series_points"] + " AND sensor = 'click'",
    "latest_point": f"""WITH {WEIGHTS}
SELECT sensor AS series, date_trunc('hour', "timestamp") AS x, grams AS y, event_id FROM weights
QUALIFY row_number() OVER (PARTITION BY sensor, date_trunc('hour', "timestamp") ORDER BY event_id DESC) = 1""",
    "shared_key_snapshot": f"""WITH {KEYED},
late AS (
  SELECT *, event_id AS o FROM klog WHERE grams > 300
),
u AS (
  SELECT 1 AS ord, 'weights-10min' AS topic, key, start, sensor, grams, "offset" AS o FROM klog_n
  UNION ALL SELECT 2, 'weights-late', key, start, sensor, grams, o FROM late
)
SELECT topic, key, start AS "timestamp", sensor, grams FROM u
QUALIFY row_number() OVER (PARTITION BY key ORDER BY ord DESC, o DESC) = 1""",
    "stream_dead_letters": f"""WITH {PAYLOADS}
SELECT 'corrupt' AS output, event_id, body, 1::BIGINT AS n FROM pay WHERE NOT json_valid(body)
UNION ALL SELECT 'decoded', NULL, NULL, count(*) FROM pay WHERE json_valid(body)""",
    "csv_export": f"""WITH x AS ({SQL["export_rows"]})
SELECT "timestamp", name, round(temp, {D}) AS temp, humidity FROM x""",
    # late rows count only where their window ends after the watermark of the first two appends
    "stream_late_10min": f"""WITH {WEIGHTS},
cuts AS (SELECT min(event_id) AS lo, max(event_id) - min(event_id) + 1 AS n FROM events),
passed AS (
  SELECT max("timestamp") - INTERVAL '10 minutes' AS mark FROM weights, cuts
  WHERE event_id < lo + n * 2 // 4 AND NOT (event_id < lo + n // 4 AND event_id % 100 = 7)
),
arrived AS (
  SELECT weights.* FROM weights, cuts, passed
  WHERE NOT coalesce(event_id < lo + n // 4 AND event_id % 100 = 7, false)
     OR time_bucket(INTERVAL '10 minutes', "timestamp") + INTERVAL '10 minutes' > mark
)
{_rollup('arrived', ['grams', 'stddev'], ['sensor'])}""",
})

SQL.update({
    "jsonl_roundtrip": SQL["temperatures"],
    "fanout": f"""WITH {ENRICH}
SELECT 'jsonl' AS sink, event_id, sensor FROM parsed
UNION ALL
SELECT 'log' AS sink, event_id, sensor FROM parsed""",
    "stream_fresh_start": SQL["stream_raw_weights"],
    "stream_shared_raw": f"""WITH {WATER}
SELECT event_id, date_trunc('second', "timestamp") AS "timestamp", sensor, round(grams, {D}) AS grams,
  round("min", {D}) AS "min", round("max", {D}) AS "max", round(water, {D}) AS water FROM water""",
})

# the ranges of an append are those of all appends up to it
SQL["stream_growing_10min"] = f"""WITH {WEIGHTS},
cuts AS (SELECT min(event_id) AS lo, max(event_id) - min(event_id) + 1 AS n FROM events),
placed AS (
  SELECT weights.*, coalesce((event_id >= lo + n // 4)::INT + (event_id >= lo + n * 2 // 4)::INT
                             + (event_id >= lo + n * 3 // 4)::INT, 0) AS append
  FROM weights, cuts
),
known AS (
  SELECT DISTINCT sensor, append, min(grams) OVER (PARTITION BY sensor ORDER BY append) AS low
  FROM placed WHERE sensor IS NOT NULL
),
water AS (
  SELECT "timestamp", placed.sensor, grams - low AS water FROM placed JOIN known USING (sensor, append)
)
{_rollup('water', ['water'], ['sensor'])}"""
# readings that the watermark of all appends has passed
SQL["stream_calibrated"] = f"""WITH {CALIB},
passed AS (
  SELECT (epoch_us(max(t)) // 1000 - 600000) * 1000 AS mark
  FROM (SELECT reading_ts AS t FROM stats UNION ALL SELECT ts FROM cal) u
)
SELECT sensor, "timestamp", round(raw, {D}) AS raw, round(zero, {D}) AS zero, round(one_kg, {D}) AS one_kg,
  round((raw - zero) * 1000.0 / nullif(one_kg - zero, 0), {D}) AS grams
FROM cw, passed WHERE epoch_us("timestamp") <= mark"""
