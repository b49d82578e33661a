"""The SQL that must give the same rows, for an engine that knows nothing of the decoder."""

from __future__ import annotations

from eventlake.checks import shaping
from eventlake.checks.queries import REPORT_DAY, REPORT_FROM, REPORT_TO, SEED
from eventlake.checks.shaping import ID, MS, USER
from eventlake.operators.synthetic import DRIVERS, EVENT_TYPES, ID_PREFIX, PLATFORMS, RIDERS

EVENTS = r"""e AS (
    SELECT event_id, user_id, event_type, value, ts,
           CAST(regexp_extract(props, '(\d+)', 1) AS INTEGER) AS k,
           epoch_us(ts) // 1000 AS ms
    FROM events)"""


def _hour(ms: str) -> str:
    return f"strftime(make_timestamp(({ms}) * 1000), '%Y-%m-%d-%H')"


def _day(seconds: str) -> str:
    return f"strftime(make_timestamp(({seconds}) * 1000000), '%Y-%m-%d')"


# Which payloads a strict ride decode refuses, and why. A row without values has no payload.
REASON = """CASE
    WHEN k IS NULL THEN 'unparseable'
    WHEN k < 5 THEN 'unparseable'
    WHEN k BETWEEN 20 AND 24 THEN 'not_object'
    WHEN k BETWEEN 15 AND 19 THEN 'missing:event_id'
    WHEN k BETWEEN 5 AND 14 THEN 'missing:surge_multiplier'
    WHEN k BETWEEN 25 AND 29 THEN 'out_of_range:estimated_wait_minutes'
    WHEN k BETWEEN 30 AND 34 THEN 'out_of_range:event_timestamp' END"""

_METADATA = """CAST(CASE WHEN k BETWEEN 35 AND 39 THEN 0 ELSE value END AS DOUBLE)
        AS surge_multiplier,
    k AS estimated_wait_minutes,
    CAST(CASE WHEN k BETWEEN 35 AND 39 THEN 0 ELSE event_id % 701 + 100 END AS DOUBLE)
        AS fare_amount,
    CAST('4.' || CAST(abs(user_id) % 10 AS STRING) AS DOUBLE) AS driver_rating"""


def _rides(event_id: str = ID, where: str = f"{REASON} IS NULL") -> str:
    return f"""rides AS (
    SELECT {event_id} AS event_id,
           CASE WHEN k BETWEEN 40 AND 44 THEN 'null' ELSE 'user_' || {USER} END AS user_id,
           event_type, ms AS event_timestamp,
           CASE WHEN k BETWEEN 40 AND 44 THEN '' ELSE 'ride_' || {USER} END AS ride_id,
           {_METADATA}, {_hour("ms")} AS event_hour,
           ts AS arrived, event_id % 4 AS part, event_id AS off
    FROM e WHERE {where})"""


RIDE_COLUMNS = """event_id, user_id, event_type, event_timestamp, ride_id, surge_multiplier,
    estimated_wait_minutes, fare_amount, driver_rating, event_hour"""



def _latest(where: str = f"{REASON} IS NULL") -> str:
    return f"""WITH {EVENTS}, {_rides(shaping.UPSERT_ID, where)}, latest AS (
    SELECT {RIDE_COLUMNS} FROM rides
    QUALIFY row_number() OVER (PARTITION BY event_id, event_hour
                               ORDER BY arrived DESC, part DESC, off DESC) = 1)"""


LATEST = _latest()
# What closing cut-off objects and opening arrays mends.
MENDED = f"({REASON} IS NULL OR k < 5 OR k BETWEEN 20 AND 24)"

PAIRS = f"""topics AS (
    SELECT event_type AS topic, row_number() OVER (ORDER BY count(*) DESC, event_type) AS place
    FROM e WHERE event_type IS NOT NULL GROUP BY event_type)
SELECT a.event_id, a.ride_id, a.event_timestamp, b.event_id AS later_id, b.event_timestamp AS later_timestamp
FROM (SELECT * FROM rides WHERE event_type = (SELECT topic FROM topics WHERE place = 1)) a
LEFT JOIN (SELECT * FROM rides WHERE event_type = (SELECT topic FROM topics WHERE place = 2)) b
ON a.ride_id = b.ride_id AND b.event_timestamp BETWEEN a.event_timestamp AND a.event_timestamp + 6 * 3600000"""

SESSIONS = """WITH t AS (
    SELECT user_id, ts, value, ts + CASE event_type WHEN 'purchase' THEN INTERVAL 6 HOUR
           WHEN 'error' THEN INTERVAL 30 MINUTE ELSE INTERVAL 2 HOUR END AS until
    FROM events WHERE ts IS NOT NULL
), marked AS (
    SELECT *, max(until) OVER (PARTITION BY user_id ORDER BY ts, until
                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM t
), numbered AS (
    SELECT *, sum(CASE WHEN before >= ts THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts, until
                                                                  ROWS UNBOUNDED PRECEDING) AS island FROM marked
)
SELECT min(ts) AS session_start, max(until) AS session_end, user_id, count(*) AS n_events,
       CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM numbered GROUP BY user_id, island"""

CENSUS = f"""WITH {EVENTS}, p AS (
    SELECT event_type, {_hour("ms")} AS hour, unnest(CASE WHEN k IS NULL THEN
        [{{'path': '$', 'kind': 'unreadable'}}, {{'path': '$', 'kind': 'unreadable'}}] ELSE [
        {{'path': '$.k', 'kind': 'whole number'}}, {{'path': '$.id', 'kind': 'whole number'}},
        {{'path': '$.about', 'kind': 'object'}}, {{'path': '$.about.user', 'kind': 'whole number'}},
        {{'path': '$.about.props', 'kind': 'object'}}, {{'path': '$.about.props.k', 'kind': 'whole number'}},
        {{'path': '$.tags', 'kind': 'array'}}, {{'path': '$.tags[*]', 'kind': 'text'}},
        {{'path': '$.tags[*]', 'kind': 'boolean'}}, {{'path': '$.none', 'kind': 'null'}}] END) AS f FROM e)
SELECT event_type, f.path AS path, f.kind AS kind, count(*) AS n, min(hour) AS first_hour, max(hour) AS last_hour
FROM p GROUP BY ALL"""


def _rejects(event_id: str) -> str:
    return f"""WITH {EVENTS}
    SELECT event_type AS topic, {shaping.nested_ride(event_id)} AS value, {REASON} AS reject_reason
    FROM e WHERE {REASON} IS NOT NULL"""


def _coerced(text: str, int_: str, long_: str, double: str, reason: str) -> str:
    return f"""WITH {EVENTS}, t AS (
        SELECT *, CAST(user_id AS DOUBLE) AS u, CAST({USER} || '.9' AS DOUBLE) AS u9
        FROM (SELECT * REPLACE (abs(user_id) AS user_id) FROM e))
    SELECT event_id, {text} AS a, CAST({int_} AS INTEGER) AS n, CAST({long_} AS BIGINT) AS l,
           CAST({double} AS DOUBLE) AS d{reason} FROM t"""


# Cases shared by both modes: a number as text, plain, with a fraction, and so on.
_TEXT = f"""WHEN k < 10 THEN {USER} WHEN k < 15 THEN {USER} || '.9'
    WHEN k < 20 THEN '-' || {USER} || '.9' WHEN k < 25 THEN 'true'"""
_TEXT_END = f"""WHEN k < 50 THEN {USER} || '.9' WHEN k < 55 THEN {USER} || '.0'
    WHEN k < 60 THEN '99999999999' WHEN k < 65 THEN 'false' ELSE {ID}"""

COERCION_STRICT = _coerced(
    f"CASE {_TEXT} WHEN k < 30 THEN 'null' WHEN k < 35 THEN 'x' || {USER} WHEN k < 45 THEN '' "
    f"{_TEXT_END} END",
    "CASE WHEN k < 15 THEN user_id WHEN k < 20 THEN -user_id WHEN k < 25 THEN 1 "
    "WHEN k < 45 THEN 0 WHEN k < 55 THEN user_id WHEN k < 60 THEN NULL WHEN k < 65 THEN 0 "
    "ELSE event_id END",
    "CASE WHEN k < 15 THEN user_id WHEN k < 20 THEN -user_id WHEN k < 25 THEN 1 "
    "WHEN k < 45 THEN 0 WHEN k < 55 THEN user_id WHEN k < 60 THEN 99999999999 WHEN k < 65 THEN 0 "
    "ELSE event_id END",
    "CASE WHEN k < 10 THEN u WHEN k < 15 THEN u9 WHEN k < 20 THEN -u9 "
    "WHEN k < 25 THEN 1 WHEN k < 45 THEN 0 WHEN k < 50 THEN u9 WHEN k < 55 THEN u "
    "WHEN k < 60 THEN 99999999999 WHEN k < 65 THEN 0 ELSE event_id END",
    ", CASE WHEN k IS NULL THEN 'unparseable' WHEN k BETWEEN 55 AND 59 THEN 'out_of_range:n' END AS reject_reason",
)

COERCION_LENIENT = _coerced(
    f"CASE {_TEXT} WHEN k < 30 THEN NULL WHEN k < 35 THEN 'x' || {USER} "
    f"WHEN k < 40 THEN '{{\"q\":' || {USER} || '}}' WHEN k < 45 THEN '[' || {USER} || ']' "
    f"{_TEXT_END} END",
    "CASE WHEN k < 15 THEN user_id WHEN k < 20 THEN -user_id WHEN k < 50 THEN NULL "
    "WHEN k < 55 THEN user_id WHEN k < 65 THEN NULL ELSE event_id END",
    "CASE WHEN k < 15 THEN user_id WHEN k < 20 THEN -user_id WHEN k < 50 THEN NULL "
    "WHEN k < 55 THEN user_id WHEN k < 60 THEN 99999999999 WHEN k < 65 THEN NULL "
    "ELSE event_id END",
    "CASE WHEN k < 10 THEN u WHEN k < 15 THEN u9 WHEN k < 20 THEN -u9 "
    "WHEN k < 45 THEN NULL WHEN k < 50 THEN u9 WHEN k < 55 THEN u "
    "WHEN k < 60 THEN 99999999999 WHEN k < 65 THEN NULL ELSE event_id END",
    "",
) + " WHERE k IS NOT NULL"

BIDS = f"""WITH {EVENTS}
SELECT event_type || CASE WHEN k BETWEEN 45 AND 49 THEN '_last' ELSE '' END AS event_name,
       CASE WHEN k BETWEEN 15 AND 19 THEN NULL ELSE user_id END AS user_id,
       CASE WHEN k BETWEEN 15 AND 24 THEN NULL ELSE k END AS city_id,
       CASE WHEN k BETWEEN 20 AND 29 THEN NULL ELSE 'web' END AS platform,
       CASE WHEN k BETWEEN 20 AND 24 THEN {USER} || '.0'
            WHEN k BETWEEN 25 AND 29 THEN '{{"s":' || {USER} || '}}'
            ELSE {ID} END AS session_id,
       CASE WHEN k BETWEEN 30 AND 34 THEN NULL
            WHEN k BETWEEN 35 AND 39 THEN make_timestamp(-ms * 1000)
            ELSE make_timestamp(ms * 1000) END AS event_time,
       TRUE AS is_stamped
FROM e WHERE k >= 10"""

FLAT_RIDES = f"""WITH {EVENTS}
SELECT {ID} AS event_id, 'user_' || {USER} AS user_id, event_type,
       CASE WHEN k < 5 THEN NULL WHEN k < 10 THEN -1 WHEN k < 15 THEN -ms ELSE ms END
           AS event_timestamp,
       'ride_' || {USER} AS ride_id, value AS surge_multiplier, k AS estimated_wait_minutes,
       CAST(event_id % 701 + 100 AS DOUBLE) AS fare_amount, CAST(NULL AS DOUBLE) AS driver_rating,
       CASE WHEN k < 5 THEN NULL WHEN k < 10 THEN '1970-01-01'
            WHEN k < 15 THEN {_day("-(ms // 1000)")} ELSE {_day("ms // 1000")} END AS event_date
FROM e WHERE k IS NOT NULL"""


def _draw(start: int, digits: int, low: int, high: int) -> str:
    return f"({low} + CAST('0x' || substr(h, {start}, {digits}) AS BIGINT) % {high - low + 1})"


def _choice(start: int, digits: int, values: tuple[str, ...]) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"([{listed}])[{_draw(start, digits, 1, len(values))}]"


def _hashed(kind: str) -> str:
    return f"(SELECT ms, md5('{SEED}:{kind}:' || {ID}) AS h FROM e)"


def _synthetic_ride(kind: str) -> str:
    person, many = ("driver_", DRIVERS) if kind == "driver_events" else ("user_", RIDERS)
    return f"""SELECT '{kind}' AS topic,
       '{ID_PREFIX[kind]}_' || {MS} || '_' || CAST({_draw(29, 4, 1000, 9999)} AS STRING) AS event_id,
       '{person}' || CAST({_draw(1, 4, 1, many)} AS STRING) AS user_id,
       {_choice(5, 4, EVENT_TYPES[kind])} AS event_type, ms AS "timestamp",
       'ride_' || CAST({_draw(9, 6, 10000, 99999)} AS STRING) AS ride_id,
       CAST({_draw(15, 4, 10, 30)} AS DOUBLE) / 10 AS surge_multiplier,
       CAST({_draw(19, 4, 2, 15)} AS INTEGER) AS estimated_wait_minutes,
       CAST({_draw(23, 3, 100, 800)} AS INTEGER) AS fare_amount,
       CAST({_draw(26, 3, 35, 50)} AS DOUBLE) / 10 AS driver_rating
    FROM {_hashed(kind)}"""


COUNTS = """SELECT date_trunc('hour', ts) AS window_start,
       date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, event_type,
       count(*) AS n_events, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM events WHERE ts IS NOT NULL GROUP BY 1, 2, 3"""

ENRICHED = """SELECT event_id, user_id, event_type, c_name, c_mktsegment
FROM events LEFT JOIN customer ON user_id = c_custkey"""

ORACLES = {
    "strict_decode_ride": f"WITH {EVENTS}, {_rides()} SELECT {RIDE_COLUMNS} FROM rides",
    "decode_rejects": _rejects(ID),
    "nested_flatten": f"""WITH {EVENTS}
        SELECT event_type AS topic, CAST(event_id % 4 AS INTEGER) AS "partition",
               event_id AS "offset", {_METADATA}
        FROM e WHERE k >= 15 AND k NOT BETWEEN 20 AND 29""",
    "json_coercion_strict": COERCION_STRICT,
    "json_coercion_lenient": COERCION_LENIENT,
    "lenient_decode_bid": BIDS,
    "flat_ride_by_day": FLAT_RIDES,
    "lenient_decode_props": r"""SELECT event_id,
        CAST(regexp_extract(props, '(\d+)', 1) AS INTEGER) AS k, CAST(NULL AS STRING) AS absent
        FROM events WHERE props IS NOT NULL""",
    "hour_bucket": f"""WITH {EVENTS}
        SELECT event_id, {_hour("ms")} AS hour, {_hour("-ms")} AS hour_before_1970 FROM e""",
    "event_date_bucket": f"""WITH {EVENTS}, s AS (SELECT *, -(ms // 1000) AS seconds FROM e)
        SELECT event_id, seconds,
               strftime(make_timestamp(seconds * 1000000), '%Y-%m-%d %H:%M:%S') AS text_time,
               {_day("seconds")} AS day_of_text, {_day("seconds")} AS day_before_1970,
               {_day("ms // 1000")} AS day FROM s""",
    "event_wall_clock": f"""WITH {EVENTS}
        SELECT event_id, make_timestamp(ms * 1000) AS event_time,
               make_timestamp(-ms * 1000) AS event_time_before_1970 FROM e""",
    "topic_table_name": """SELECT page_id, lower(regexp_replace(url, '[-.]', '_', 'g')) AS table_name
        FROM pages""",
    "upsert_latest": f"{LATEST} SELECT * FROM latest",
    "upsert_stream_current": f"{LATEST} SELECT * FROM latest",
    "upsert_stream_compacted": f"{LATEST} SELECT * FROM latest",
    "upsert_stream_bucketed": f"{LATEST} SELECT * FROM latest",
    "upsert_stream_rejects": _rejects(shaping.UPSERT_ID),
    "topic_fan_out": f"""WITH {EVENTS}
        SELECT event_type AS topic, {_hour("ms")} AS event_hour, count(*) AS n_rows
        FROM e WHERE {REASON} IS NULL GROUP BY 1, 2""",
    "bid_stream_append": BIDS,
    "append_partitioned_readback": FLAT_RIDES,
    "synthetic_rides": f"WITH {EVENTS} "
    + " UNION ALL ".join(_synthetic_ride(kind) for kind in ID_PREFIX),
    "synthetic_bids": f"""WITH {EVENTS}
        SELECT {_choice(5, 4, EVENT_TYPES["bid_events"])} AS event_name,
               {_draw(9, 6, 10000, 99999)} AS user_id,
               CAST({_draw(1, 4, 1, 10)} AS INTEGER) AS city_id,
               {_choice(15, 4, PLATFORMS)} AS platform,
               CAST(ms // 1000 AS STRING) || CAST({_draw(19, 6, 10000, 99999)} AS STRING)
                   AS session_id,
               CAST(ms // 1000 AS STRING) || CAST({_draw(25, 6, 10000, 99999)} AS STRING) AS flow_id,
               ms AS timestamp_ms
        FROM {_hashed("bid_events")}""",
    "publish_messages": f"""WITH {EVENTS}
        SELECT event_type AS topic, '{{"event_id":' || coalesce({ID}, 'null') || ',"user_id":' || coalesce({USER}, 'null')
            || ',"value":' || coalesce(CAST(value AS STRING), 'null') || ',"ms":' || coalesce({MS}, 'null')
            || '}}' AS value FROM e""",
    "publish_decode_roundtrip": f"""WITH {EVENTS}, made AS ({_synthetic_ride("driver_events")})
        SELECT topic, event_id, user_id, event_type, "timestamp" AS event_timestamp, ride_id,
               surge_multiplier, estimated_wait_minutes,
               CAST(fare_amount AS DOUBLE) AS fare_amount, driver_rating,
               {_hour('"timestamp"')} AS event_hour FROM made""",
    "windowed_counts_batch": COUNTS,
    "windowed_counts_stream": COUNTS,
    "enrich_static": ENRICHED,
    "enrich_stream": ENRICHED,
    "current_state_report": f"""{LATEST}
        SELECT event_hour, count(*) AS n_rows, min(event_timestamp) AS first_ms,
               max(event_timestamp) AS last_ms, max(fare_amount) AS top_fare
        FROM latest WHERE event_hour BETWEEN '{REPORT_FROM}' AND '{REPORT_TO}'
        GROUP BY event_hour""",
    "bid_table_append": BIDS,
    "ride_day_table_append": FLAT_RIDES,
    "rides_of_a_day": f"SELECT * FROM ({FLAT_RIDES}) WHERE event_date = '{REPORT_DAY}'",
    "two_topics_union": f"""WITH {EVENTS}, {_rides()}
        SELECT event_type AS topic, {RIDE_COLUMNS} FROM rides WHERE event_type IN (
            SELECT event_type FROM e WHERE event_type IS NOT NULL
            GROUP BY event_type ORDER BY count(*) DESC, event_type LIMIT 2)""",
    "ride_join_batch": f"WITH {EVENTS}, {_rides()}, {PAIRS}",
    "ride_join_stream": f"WITH {EVENTS}, {_rides()}, {PAIRS}",
    "as_of_versions": f"""WITH {EVENTS}, plans AS (
            SELECT user_id, ts, event_id AS plan_id, value AS price, ts + to_hours(k) AS until
            FROM e WHERE event_type = 'signup' AND user_id IS NOT NULL AND ts IS NOT NULL
            QUALIFY row_number() OVER (PARTITION BY user_id, ts ORDER BY until DESC NULLS LAST, event_id DESC NULLS LAST,
                                       value DESC NULLS LAST) = 1),
        facts AS (SELECT * FROM e WHERE event_type IS DISTINCT FROM 'signup')
        SELECT f.event_id, f.user_id, f.event_type,
               CASE WHEN p.until IS NULL OR p.until > f.ts THEN p.plan_id END AS plan_id,
               CASE WHEN p.until IS NULL OR p.until > f.ts THEN p.price END AS price
        FROM facts f ASOF LEFT JOIN plans p ON f.user_id = p.user_id AND f.ts >= p.ts""",
    "upsert_feed_counts": f"""{LATEST}
        SELECT event_hour, event_type, count(*) AS n_rows,
               CAST(sum(CAST(fare_amount AS DECIMAL(18,6))) AS DOUBLE) AS fares
        FROM latest GROUP BY event_hour, event_type""",
    "upsert_redriven": f"{_latest(MENDED)} SELECT * FROM latest",
    "upsert_open_rejects": f"""WITH {EVENTS}
        SELECT event_type AS topic, {shaping.nested_ride(shaping.UPSERT_ID)} AS value, {REASON} AS reject_reason,
               CAST(event_id % 4 AS INTEGER) AS "partition", event_id AS "offset"
        FROM e WHERE {REASON} IS NOT NULL AND NOT coalesce(k < 5 OR k BETWEEN 20 AND 24, FALSE)""",
    "routed_tables": f"""WITH {EVENTS}, {_rides()}
        SELECT lower(regexp_replace(event_type, '[-.]', '_', 'g')) AS table_name, event_type AS topic,
               event_hour, count(DISTINCT event_id) AS n_rows
        FROM rides GROUP BY 1, 2, 3""",
    "sessions_batch": SESSIONS,
    "sessions_stream": SESSIONS,
    "bids_sent_again": BIDS,
    "sketched_days": """SELECT strftime(ts, '%Y-%m-%d') AS day, count(DISTINCT date_trunc('hour', ts)) AS n_hours,
               count(*) AS n_events, TRUE AS users_near, TRUE AS median_near
        FROM events WHERE ts IS NOT NULL GROUP BY 1""",
    "field_census_props": CENSUS,
}
