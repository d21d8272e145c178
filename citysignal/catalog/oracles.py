"""SQL equivalents of the registered queries, for checking on another engine.

They share the input formulas with :mod:`citysignal.catalog.views` and nothing
else: every result is worked out independently, without packed orders, zipped
arrays, bucket refinement or incremental state.
"""

from __future__ import annotations

from citysignal import config as C
from citysignal import schemas
from citysignal.catalog import queries as Q
from citysignal.catalog import views as V

SECOND = "'%Y%m%d_%H%M%S'"
CLOCK = "'%Y-%m-%d %H:%M:%S'"
START = "TIMESTAMP '2024-01-01 00:00:00'"
AS_OF = f"TIMESTAMP '{V.AS_OF}'"
QUOTE = "'' || chr(39) || ''"

EV = """ev AS (
    SELECT event_id AS e, ts, user_id AS u, event_type, value,
           strftime(ts, '%Y%m%d_%H%M%S') AS id
    FROM events)"""

_SCORED = ", ".join(f"{formula} AS {name}" for name, formula in V.DECISION.items())
_BLEND = (
    "traffic_score * CAST({0} AS DOUBLE) + weather_score * CAST({1} AS DOUBLE)"
    " + sentiment_score * CAST({2} AS DOUBLE)"
)
BLEND = _BLEND.format(0.4, 0.4, 0.2)
DOCUMENTED_BLEND = _BLEND.format(0.5, 0.3, 0.2)

DEC = f"""{EV},
    raw_scores AS (SELECT e, u, ts, id, {_SCORED} FROM ev),
    blended AS (SELECT *, {BLEND} AS global_score FROM raw_scores),
    dec AS (
        SELECT e AS seq, u AS user_id, id AS decision_id,
               traffic_score, weather_score, sentiment_score, global_score,
               CASE WHEN global_score > 0.5 THEN 'SHOW_AD' ELSE 'NO_AD' END AS decision_result,
               CASE WHEN global_score > 0.5 THEN 'ESCAPISM_NOW' ELSE '' END AS campaign_type,
               CASE WHEN global_score > 0.5
                    THEN list_transform(range(0, u % 4 + 1), lambda i: CAST(u + i AS VARCHAR))
                    ELSE CAST([] AS VARCHAR[]) END AS targets,
               date_trunc('second', ts) AS made_at,
               strftime(ts, {CLOCK}) AS decision_time,
               strftime(ts + INTERVAL 5 MINUTE, {CLOCK}) AS display_time
        FROM blended)"""

_RENDERED = (
    "'[' || coalesce(array_to_string(list_transform(targets,"
    " lambda t: chr(39) || t || chr(39)), ', '), '') || ']'"
)
ARC = f"""{DEC},
    arc AS (
        SELECT decision_id, traffic_score, weather_score, sentiment_score, global_score,
               decision_result, {_RENDERED} AS target_locations, decision_time, display_time,
               campaign_type, substr(decision_id, 1, 8) AS dt, substr(decision_id, 10, 2) AS hr, seq
        FROM dec),
    arc_once AS (
        SELECT * FROM arc
        QUALIFY row_number() OVER (PARTITION BY decision_id ORDER BY seq DESC) = 1)"""

POS = f"""pos AS (
    SELECT e AS seq, CAST(u AS VARCHAR) AS vn, ts, event_type, {V.LAT} AS lat, {V.LON} AS lon
    FROM ev)"""

MOOD = f"""mood AS (
    SELECT CAST(e AS VARCHAR) AS tweet_id, ts, event_type, compound,
           least(greatest(CAST(trunc((compound + 1) * CAST(4.5 AS DOUBLE)) AS INTEGER), 0), 9)
               AS bucket
    FROM (SELECT *, {V.COMPOUND} AS compound FROM ev))"""


def km(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return (
        "(2 * 6371 * asin(least(1, sqrt("
        f"pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2}))"
        f" * pow(sin(radians({lon2} - {lon1}) / 2), 2)))))"
    )


def ends(source: str, windows: str) -> str:
    """First and last stored sighting; ``windows`` yields ``ws`` for each ``sec``."""
    return f"""
    stored AS (
        SELECT *, date_trunc('second', ts) AS sec FROM {source}
        QUALIFY row_number() OVER (PARTITION BY vn, date_trunc('second', ts)
                                   ORDER BY seq DESC) = 1),
    placed AS ({windows.format(table="stored")}),
    placed_all AS ({windows.format(table=f"(SELECT *, date_trunc('second', ts) AS sec FROM {source})")}),
    report_counts AS (SELECT ws, vn, count(*) AS reports FROM placed_all GROUP BY ws, vn),
    ends AS (
        SELECT ws, vn, arg_min(lat, sec) AS first_lat, arg_min(lon, sec) AS first_lon,
               arg_max(lat, sec) AS last_lat, arg_max(lon, sec) AS last_lon,
               min(sec) AS first_ts, max(sec) AS last_ts
        FROM placed GROUP BY ws, vn),
    measured AS (
        SELECT *, {km("first_lat", "first_lon", "last_lat", "last_lon")} AS distance_km,
               date_diff('second', first_ts, last_ts) AS elapsed
        FROM ends),
    moving AS (
        SELECT *, speed_kmh IS NOT NULL AND speed_kmh > 0.1 AND speed_kmh < 15.0 AS is_congested
        FROM (SELECT *, CASE WHEN elapsed > 0
                             THEN distance_km / (elapsed / CAST(3600 AS DOUBLE)) END AS speed_kmh
              FROM measured)),
    traffic AS (
        SELECT ws, count(*) AS vehicles, count(*) FILTER (WHERE is_congested) AS congested,
               least(count(*) FILTER (WHERE is_congested) / count(*), 1.0) AS traffic_score
        FROM moving GROUP BY ws)"""


DAILY = "SELECT *, date_trunc('day', sec) AS ws FROM {table}"
HOURLY = "SELECT *, date_trunc('hour', sec) AS ws FROM {table}"
SLIDING = (
    "SELECT t.*, date_trunc('minute', t.sec) - to_minutes(back.b) AS ws"
    " FROM {table} t CROSS JOIN (SELECT unnest(range(0, 10)) AS b) back"
)
MOVING = f"{EV}, {POS}, {ends('pos', DAILY)}"

_POLLS = f"""polls AS (
    SELECT o_orderkey AS k, o_orderstatus AS status, o_orderpriority AS priority,
           CAST(unnest(range(0, {V.POLL_HOURS})) AS INTEGER) AS j FROM orders)"""


def hours(formulas: dict[str, str]) -> str:
    """All polled hours; an order with one of the last positions may be unreadable."""
    columns = ", ".join(f"{formula} AS {name}" for name, formula in formulas.items())
    return f"""{_POLLS},
    hours AS (
        SELECT k AS seq, j, status, priority,
               {START} + to_hours(CAST({V.POLL_HOUR} AS BIGINT)) AS ts, {columns}
        FROM polls),
    keyed AS (SELECT strftime(ts, '%Y%m%d_%H') AS row_key, * FROM hours),
    current AS (
        SELECT * FROM keyed
        QUALIFY row_number() OVER (PARTITION BY row_key ORDER BY seq DESC) = 1)"""


def weather_score(
    temp: str, rain: str, snow: str, depth: str, wind: str, code: str, hour: str
) -> dict[str, str]:
    """Points per factor and the final score as SQL expressions."""
    snow_mm, depth_cm = f"({snow} * 100)", f"({depth} * 100)"
    wet = f"({rain} + {snow_mm})"
    points = {
        "temperature_points": f"CASE WHEN {temp} < 0 THEN 0.4 WHEN {temp} < 10 THEN 0.3"
        f" WHEN {temp} < 15 THEN 0.15 WHEN {temp} > 30 THEN 0.3 WHEN {temp} > 25 THEN 0.15 ELSE 0 END",
        "precipitation_points": f"CASE WHEN {wet} > 10 THEN 0.3 WHEN {wet} > 5 THEN 0.2"
        f" WHEN {wet} > 1 THEN 0.1 WHEN {wet} > CAST(0.1 AS DOUBLE) THEN 0.05 ELSE 0 END",
        "snow_points": f"CASE WHEN {snow_mm} > 0.5 THEN 0.1 ELSE 0 END",
        "depth_points": f"CASE WHEN {depth_cm} > 30 THEN 0.25 WHEN {depth_cm} > 20 THEN 0.2"
        f" WHEN {depth_cm} > 10 THEN 0.15 WHEN {depth_cm} > 5 THEN 0.1"
        f" WHEN {depth_cm} > 1 THEN 0.05 ELSE 0 END",
        "wind_points": f"CASE WHEN {wind} > 50 THEN 0.2 WHEN {wind} > 30 THEN 0.15"
        f" WHEN {wind} > 20 THEN 0.1 WHEN {wind} > 10 THEN 0.05 ELSE 0 END",
        "code_points": f"CASE WHEN {code} IN (95, 96, 99, 85, 86, 75, 67) THEN 0.1"
        f" WHEN {code} IN (61, 63, 65, 71, 73, 77, 80, 81, 82) THEN 0.05 ELSE 0 END",
    }
    points = {name: f"CAST({sql} AS DOUBLE)" for name, sql in points.items()}
    total = " + ".join(points.values())
    points["total_points"] = f"({total})"
    points["weather_score"] = (
        f"least(CASE WHEN {hour} IN (7, 8, 9, 16, 17, 18) THEN ({total}) * CAST(1.2 AS DOUBLE)"
        f" ELSE {total} END, 1.0)"
    )
    return points


_OF_FORECAST = weather_score(
    "apparent_temp",
    "rain",
    "snowfall",
    "snow_depth",
    "wind_speed",
    "weather_code",
    "CAST(substr(row_key, 10, 2) AS INTEGER)",
)
SCORED_HOURS = f"""{hours(V.WEATHER)},
    scored_hours AS (
        SELECT row_key, ts, {_OF_FORECAST["weather_score"]} AS weather_score FROM current)"""

_LINE = ", ".join(f"{formula} AS {name}" for name, formula in V.LINE_WEATHER.items())
LINES = f"lines AS (SELECT {_LINE} FROM lineitem)"
_OF_LINE = weather_score(
    "apparent_temp", "rain", "snowfall", "snow_depth", "wind_speed", "weather_code", "hour"
)

_POST = ", ".join(f"{formula} AS {name}" for name, formula in V.POST.items())
POSTS = f"""posts AS (
    SELECT CAST(d AS VARCHAR) AS tweet_id, text, lang, source,
           {AS_OF} - to_seconds({V.POST_AGE_SECONDS}) AS ts, {_POST}
    FROM (SELECT doc_id AS d, text, lang, source, n_chars FROM documents))"""
_BOUND = r"[^\p{L}\p{N}]"
_MENTIONS = f"regexp_matches(lower(text), '(^|{_BOUND})({'|'.join(V.KEYWORDS)})($|{_BOUND})')"
_NEAR = km("52.2297", "21.0122", "lat", "lon") + " <= 20"

_LEX = ", ".join(f"('{word}', CAST({valence} AS DECIMAL(9, 4)))" for word, valence in V.LEXICON)
LEXICON = f"""lexicon(word, valence) AS (VALUES {_LEX}),
    words AS (
        SELECT tweet_id,
               unnest(regexp_extract_all(lower(text), '\\p{{L}}+(?:''\\p{{L}}+)*')) AS word
        FROM posts),
    sums AS (
        SELECT tweet_id, count(*) AS matches, CAST(sum(valence) AS DOUBLE) AS valence
        FROM words JOIN lexicon USING (word) GROUP BY tweet_id),
    polarity AS (
        SELECT tweet_id, coalesce(matches, 0) AS matches, coalesce(valence, 0.0) AS valence,
               coalesce(valence, 0.0)
                   / sqrt(coalesce(valence, 0.0) * coalesce(valence, 0.0) + 15) AS compound
        FROM posts LEFT JOIN sums USING (tweet_id)),
    buckets AS (
        SELECT *, least(greatest(CAST(trunc((compound + 1) * CAST(4.5 AS DOUBLE)) AS INTEGER), 0), 9)
                      AS sentiment_score
        FROM polarity)"""

# Vehicle messages: three vehicles per readable event.
_VLAT = V.LAT.replace("e *", "(e + j) *")
_VLON = V.LON.replace("e *", "(e + j) *")
REPORTS = f"""{EV},
    vehicles AS (
        SELECT e, j, ts, event_type,
               CAST(100 + u % 40 AS VARCHAR) AS lines,
               CASE WHEN NOT (event_type = 'purchase' AND j = 1) THEN CAST(u + j AS VARCHAR) END
                   AS vehicle_number,
               lpad(CAST(e % 100 AS VARCHAR), 3, '0') AS brigade,
               strftime(ts + to_seconds(j), {CLOCK}) AS gps_time,
               strftime(ts + to_seconds(j), {SECOND}) AS second_key,
               CASE WHEN NOT (event_type = 'purchase' AND j = 2) THEN {_VLAT} END AS lat,
               {_VLON} AS lon
        FROM (SELECT *, CAST(unnest(range(0, 3)) AS INTEGER) AS j FROM ev
              WHERE event_type NOT IN ('error', 'signup'))),
    reports AS (SELECT *, concat_ws('_', second_key, vehicle_number) AS row_key FROM vehicles)"""

# Forecast messages as parsed: gaps where the message had them.
_HOUR_TIME = "CASE WHEN priority = '5-LOW' AND j = 2 THEN 'pending' ELSE strftime(ts, '%Y-%m-%dT%H:%M') END"
_HOUR_KEY = "CASE WHEN NOT (priority = '5-LOW' AND j = 2) THEN row_key END"


def parsed(feed: schemas.HourlyFeed) -> list[str]:
    columns = []
    for number, column in enumerate(feed.columns):
        sql = column
        if number == 1:
            sql = f"CASE WHEN status <> 'P' THEN {column} END AS {column}"
        if number == 6:
            sql = f"CASE WHEN NOT (status = 'O' AND j = 2) THEN {column} END AS {column}"
        columns.append(sql)
    return columns


def rounded(*names: str) -> str:
    return ", ".join(f"round({name}, 6) AS {name}" for name in names)


SCORES = schemas.SCORES
R_SCORES = rounded(*SCORES)
LONG = " UNION ALL ".join(
    f"SELECT '{s}' AS score, {s} AS x, decision_result, decision_id, global_score FROM arc"
    for s in SCORES
)
ARC_OUT = f"{', '.join(Q.ARCHIVE_OUT)}"


def _arc(select: str, table: str = "arc") -> str:
    return f"WITH {ARC} SELECT {select} FROM {table}"


def _corr(a: str, b: str) -> str:
    value = "max(1.0)" if a == b else f"round(corr({a}, {b}), 6)"
    return f"SELECT '{a}' AS score_a, '{b}' AS score_b, CAST({value} AS DOUBLE) AS corr FROM arc"


_CORR = " UNION ALL ".join(_corr(a, b) for a in SCORES for b in SCORES)

_VEHICLE_JSON = " || ',' || ".join(
    f"""'{{"Lines":"' || CAST(100 + u % 40 AS VARCHAR) || '","Lon":'
        || CAST({V.LON.replace("e *", f"(e + {j}) *")} AS VARCHAR)"""
    + (
        f""" || CASE WHEN event_type <> 'purchase'
             THEN ',"VehicleNumber":"' || CAST(u + {j} AS VARCHAR) || '"' ELSE '' END"""
        if j == 1
        else f""" || ',"VehicleNumber":"' || CAST(u + {j} AS VARCHAR) || '"'"""
    )
    + f""" || ',"Time":"' || strftime(ts + to_seconds({j}), {CLOCK}) || '"'"""
    + (
        f""" || CASE WHEN event_type <> 'purchase'
             THEN ',"Lat":' || CAST({V.LAT.replace("e *", f"(e + {j}) *")} AS VARCHAR) ELSE '' END"""
        if j == 2
        else f""" || ',"Lat":' || CAST({V.LAT.replace("e *", f"(e + {j}) *")} AS VARCHAR)"""
    )
    + """ || ',"Brigade":"' || lpad(CAST(e % 100 AS VARCHAR), 3, '0') || '"}'"""
    for j in range(3)
)

_OVERVIEW_TYPES = {
    **{c.split()[0]: c.split()[1].lower() for c in schemas.ARCHIVE_COLUMNS.split(",")},
    "dt": "string",
    "hr": "string",
}

_NUMBERED = f"""{EV},
    stops(delivery, until) AS (
        VALUES (0, TIMESTAMP '{Q.ARRIVALS[0]}'), (1, TIMESTAMP '{Q.ARRIVALS[1]}'),
               (2, TIMESTAMP '{Q.ARRIVALS[2]}'), (3, TIMESTAMP '2999-01-01')),
    arrivals AS (
        SELECT e, ts, date_trunc('hour', ts) AS ws,
               ts + to_microseconds(CAST(trunc(value * 60000000) AS BIGINT)) AS arrival FROM ev),
    delivered AS (
        SELECT a.*, (SELECT min(delivery) FROM stops WHERE a.arrival < until) AS delivery
        FROM arrivals a),
    seen AS (SELECT delivery, max(ts) AS newest FROM delivered GROUP BY delivery),
    marks AS (
        SELECT s.delivery, (SELECT max(newest) FROM seen p WHERE p.delivery < s.delivery)
               - INTERVAL 10 MINUTE AS mark FROM seen s),
    final AS (SELECT max(newest) - INTERVAL 10 MINUTE AS mark FROM seen),
    judged AS (
        SELECT d.*, m.mark IS NOT NULL AND d.ws + INTERVAL 1 HOUR <= m.mark AS late
        FROM delivered d JOIN marks m USING (delivery))"""


def _histogram() -> str:
    inner = ", ".join(
        f"CASE WHEN l.x >= r.lo + {i} * r.width THEN 1 ELSE 0 END" for i in range(1, 20)
    )
    bin_ = f"list_sum([{inner}])"
    return f"""WITH {ARC}, l AS ({LONG}),
        r AS (SELECT score, min(x) AS lo, (max(x) - min(x)) / 20 AS width,
                     avg(x) AS mean, median(x) AS median FROM l GROUP BY score),
        c AS (SELECT l.score, CAST({bin_} AS INTEGER) AS bin, count(*) AS n
              FROM l JOIN r USING (score) GROUP BY 1, 2),
        grid AS (SELECT *, CAST(unnest(range(0, 20)) AS INTEGER) AS bin FROM r)
        SELECT score, bin, round(lo + bin * width, 6) AS bin_lo,
               round(lo + (bin + 1) * width, 6) AS bin_hi, coalesce(n, 0) AS n,
               round(mean, 9) AS mean, round(median, 6) AS median
        FROM grid LEFT JOIN c USING (score, bin)"""


def decisions(
    vehicle_windows: str,
    message_window: str,
    length: str,
    final: str = "",
    alone: str = "[]",
    feeds: str = "",
) -> str:
    """Decisions wherever any source has data; ``alone`` lists the ends within a forecast hour."""
    given = f"{EV}, {POS}, {ends('pos', vehicle_windows)}, {MOOD}, {SCORED_HOURS}"
    return f"""WITH {feeds or given},
        placed_mood AS (SELECT bucket, {message_window} AS ws FROM mood),
        talk AS (SELECT ws, count(*) FILTER (WHERE bucket < 4) / count(*) AS sentiment_score
                 FROM placed_mood GROUP BY 1),
        aims AS (SELECT ws, string_agg(vn, '|' ORDER BY speed_kmh, first_ts, vn) AS targets
                 FROM (SELECT * FROM moving WHERE is_congested
                       QUALIFY row_number() OVER (PARTITION BY ws
                                                  ORDER BY speed_kmh, first_ts, vn) <= 5)
                 GROUP BY ws),
        instants AS (
            SELECT ws + {length} AS instant FROM traffic UNION
            SELECT ws + {length} FROM talk UNION
            SELECT unnest(CAST({alone} AS TIMESTAMP[])) FROM scored_hours
            WHERE weather_score IS NOT NULL),
        signals AS (
            SELECT instant, instant - {length} AS ws,
                   coalesce(traffic_score, 0) AS traffic_score,
                   coalesce(sentiment_score, 0) AS sentiment_score
            FROM instants LEFT JOIN traffic t ON t.ws = instant - {length}
                 LEFT JOIN talk m ON m.ws = instant - {length}),
        weathered AS (
            SELECT s.*, coalesce(h.weather_score, 0) AS weather_score, a.targets
            FROM signals s LEFT JOIN scored_hours h
                 ON h.row_key = strftime(s.instant, '%Y%m%d_%H') LEFT JOIN aims a ON a.ws = s.ws),
        summed AS (SELECT *, {BLEND} AS global_score FROM weathered),
        made AS (SELECT *, global_score > 0.5 AS show_ad FROM summed)
        SELECT strftime(instant, {SECOND}) AS decision_id, {R_SCORES},
               CASE WHEN show_ad THEN 'SHOW_AD' ELSE 'NO_AD' END AS decision_result,
               CASE WHEN show_ad AND targets IS NOT NULL THEN 'ESCAPISM_NOW' ELSE '' END
                   AS campaign_type,
               CASE WHEN show_ad THEN coalesce(targets, '') ELSE '' END AS targets,
               strftime(instant, {CLOCK}) AS decision_time,
               strftime(instant + INTERVAL 5 MINUTE, {CLOCK}) AS display_time
        FROM made {final}"""


_EXPLAIN = """concat_ws(', ',
    printf('temp=%.1f°C', apparent_temp),
    printf('rain=%.1fmm', rain),
    CASE WHEN snowfall * 100 > 0 THEN printf('snow=%.1fmm', snowfall * 100) END,
    printf('snow_depth=%.1fcm', snow_depth * 100),
    printf('wind=%.1fkm/h', wind_speed),
    CASE WHEN weather_code IN (95, 96, 99, 85, 86, 75, 67)
         THEN 'severe_weather=' || weather_code
         WHEN weather_code IN (61, 63, 65, 71, 73, 77, 80, 81, 82)
         THEN 'moderate_weather=' || weather_code END,
    CASE WHEN hour IN (7, 8, 9, 16, 17, 18) AND {total} > 0 THEN 'rush_hour_x1.2' END)"""

_UNIFORM = "CAST(CAST('0x' || substr(md5('{0}:' || e), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296"

_TAGS = "CASE WHEN lang IN ('de', 'es') THEN '' ELSE lang || ',' || source END"
_CREATED = "strftime(ts, '%Y-%m-%dT%H:%M:%SZ')"

STATE_LEVEL = "CASE WHEN {0} >= CAST(0.66 AS DOUBLE) THEN 'HIGH' WHEN {0} >= CAST(0.33 AS DOUBLE) THEN 'MEDIUM' ELSE 'LOW' END"

ORACLES: dict[str, str] = {
    # --- sources
    "src_envelopes": f"""WITH {EV}
        SELECT CASE WHEN event_type = 'error' THEN '{{"result":"service unavailable"}}'
                    WHEN event_type = 'signup' THEN '{{"result":[]}}'
                    ELSE '{{"result":[' || {_VEHICLE_JSON} || ']}}' END AS json,
               strftime(ts, {CLOCK}) AS kafka_ts FROM ev""",
    "scan_key_range": _arc(
        "decision_id, decision_result, round(global_score, 6) AS global_score", "arc_once"
    )
    + f" WHERE decision_id >= '{Q.RANGE[0]}' AND decision_id < '{Q.RANGE[1]}'",
    "get_by_key": f"""WITH {hours(V.WEATHER)}
        SELECT row_key, {rounded("temp_2m", "wind_speed")}, weather_code, seq
        FROM current WHERE row_key = '{Q.POINT}'""",
    "scan_limit": _arc(
        "decision_id, decision_result, round(global_score, 6) AS global_score", "arc_once"
    )
    + " ORDER BY decision_id LIMIT 5",
    "load_recent": _arc(
        f"decision_id, {R_SCORES}, decision_result, target_locations, decision_time, display_time",
        "arc_once",
    )
    + f""" WHERE decision_id >= strftime({AS_OF} - INTERVAL 36 HOUR, {SECOND})
             AND decision_id < strftime({AS_OF}, {SECOND})""",
    "sample_decisions": f"""WITH {EV},
        u AS (SELECT e, {START} + to_seconds(e) AS made_at,
                     {_UNIFORM.format("traffic")} AS traffic_score,
                     {_UNIFORM.format("weather")} AS weather_score,
                     {_UNIFORM.format("sentiment")} AS sentiment_score FROM ev),
        b AS (SELECT *, {DOCUMENTED_BLEND} AS global_score FROM u)
        SELECT strftime(made_at, {SECOND}) || '_' || e AS decision_id, {R_SCORES},
               CASE WHEN global_score > 0.6 THEN 'SHOW_AD' ELSE 'NO_AD' END AS decision_result,
               strftime(made_at, {CLOCK}) AS decision_time FROM b""",
    # --- archive
    "archive_roundtrip": _arc(f"{ARC_OUT}, {R_SCORES}", "arc_once"),
    "archive_by_day": _arc(f"{ARC_OUT}, round(global_score, 6) AS global_score", "arc_once")
    + f" WHERE dt = '{Q.ARCHIVE_DAY}'",
    "archive_by_hour": _arc(f"{ARC_OUT}, round(global_score, 6) AS global_score", "arc_once")
    + f" WHERE dt = '{Q.ARCHIVE_DAY}' AND hr = '{Q.ARCHIVE_HOUR}' ORDER BY decision_id DESC",
    "archive_describe": f"WITH {ARC} "
    + " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, '{kind}' AS data_type,"
        f" {'true' if name in ('dt', 'hr', 'run') else 'false'} AS is_partition,"
        f" count({'*' if name == 'run' else name}) AS n_filled FROM arc_once"
        for name, kind in {**_OVERVIEW_TYPES, "campaign_type": "string", "run": "string"}.items()
    ),
    "archive_partitions": f"WITH {ARC} SELECT DISTINCT dt, hr FROM arc",
    "archive_campaigns": _arc(
        "decision_id, decision_result, target_locations, campaign_type, dt, hr", "arc_once"
    )
    + f" WHERE dt = '{Q.ARCHIVE_DAY}'",
    "archive_incremental": _arc(
        "decision_id, decision_result, dt, hr, round(global_score, 6) AS global_score", "arc_once"
    ),
    # --- stores and sinks
    "upsert_latest": f"""WITH {DEC}
        SELECT decision_id, seq, decision_result, round(global_score, 6) AS global_score FROM dec
        QUALIFY row_number() OVER (PARTITION BY decision_id ORDER BY seq DESC) = 1""",
    "compact_latest": f"""WITH {hours(V.WEATHER)}
        SELECT row_key, seq, {rounded("temp_2m", "rain")} FROM current""",
    "forecast_latest": f"""WITH {hours(V.WEATHER)}
        SELECT row_key, seq, {rounded("temp_2m", "rain", "wind_gusts")}, cloud_cover
        FROM current""",
    "retention_filter": f"""WITH {DEC}, {POSTS}, {hours(V.WEATHER)}
        SELECT 'decisions' AS feed, decision_id AS id FROM dec WHERE made_at >= {AS_OF} - INTERVAL 7 DAY
        UNION ALL SELECT 'vehicles', CAST(e AS VARCHAR) FROM ev WHERE ts >= {AS_OF} - INTERVAL 24 HOUR
        UNION ALL SELECT 'tweets', tweet_id FROM posts WHERE ts >= {AS_OF} - INTERVAL 24 HOUR
        UNION ALL SELECT 'weather', row_key FROM keyed WHERE ts >= {AS_OF} - INTERVAL 48 HOUR""",
    "publish_payload": f"""WITH {DEC}
        SELECT decision_id AS key, decision_id, replace(decision_time, ' ', 'T') AS timestamp,
               display_time, decision_result AS decision, round(global_score, 6) AS "global",
               round(traffic_score, 6) AS traffic, decision_result = 'SHOW_AD' AS show_ad,
               campaign_type AS campaign, coalesce(array_to_string(targets, '|'), '') AS targets
        FROM dec""",
    "csv_roundtrip": _arc(
        f"decision_id, {R_SCORES}, decision_result, target_locations, decision_time, display_time"
    ),
    "batch_layer_vehicles": f"""WITH {REPORTS}
        SELECT substr(gps_time, 1, 10) AS date, gps_time AS timestamp_utc, lines AS linia,
               vehicle_number AS pojazd_id, lat, lon FROM reports""",
    "batch_layer_weather": f"""WITH {hours(V.WEATHER)}
        SELECT strftime({START} + to_seconds(seq), '%Y-%m-%d') AS date,
               {_HOUR_TIME} AS timestamp_godzinowy, CAST(52.2297 AS DOUBLE) AS lat,
               CAST(21.0122 AS DOUBLE) AS lon, temp_2m AS temperatura_2m, rain AS deszcz,
               cloud_cover AS zachmurzenie
        FROM keyed WHERE {_HOUR_KEY} IS NOT NULL""",
    "batch_layer_tweets": f"""WITH {POSTS}, {LEXICON}
        SELECT strftime(ts, '%Y-%m-%d') AS date, tweet_id, {_CREATED} AS created_at,
               CASE WHEN lang <> 'fr' THEN upper(source) END AS author_name, text,
               CASE WHEN sentiment_score < 4 THEN 1 ELSE 0 END AS sentiment, {_TAGS} AS hashtags
        FROM posts JOIN buckets USING (tweet_id)""",
    # --- parsing and keys
    "parse_vehicles": f"""WITH {REPORTS}
        SELECT row_key, lines, vehicle_number, brigade, gps_time, lat, lon,
               'bus' AS vehicle_type, '{Q.INGESTED}' AS ingestion_timestamp FROM reports""",
    "union_feeds": f"""WITH {REPORTS}
        SELECT row_key, vehicle_number,
               CASE WHEN event_type = 'view' THEN 'trolley' ELSE 'bus' END AS vehicle_type, lat, lon
        FROM reports""",
    "parse_weather": f"""WITH {hours(V.WEATHER)}
        SELECT {_HOUR_KEY} AS row_key, {", ".join(parsed(schemas.WEATHER))},
               {_HOUR_TIME} AS forecast_time FROM keyed""",
    "parse_air_quality": f"""WITH {hours(V.AIR)}
        SELECT {_HOUR_KEY} AS row_key, {", ".join(parsed(schemas.AIR_QUALITY))},
               {_HOUR_TIME} AS forecast_time FROM keyed""",
    "zip_hourly": f"""WITH {hours(V.WEATHER)}
        SELECT {_HOUR_TIME} AS time, temp_2m AS temperature_2m,
               CASE WHEN status <> 'P' THEN apparent_temp END AS apparent_temperature,
               CASE WHEN NOT (status = 'O' AND j = 2) THEN snow_depth END AS snow_depth
        FROM keyed""",
    "parse_tweets": f"""WITH {POSTS}
        SELECT strftime(ts, {SECOND}) || '_' || tweet_id AS row_key, tweet_id,
               {_CREATED} AS created_at,
               CASE WHEN lang <> 'fr' THEN upper(source) END AS author_name, source AS username,
               text, {_TAGS} AS hashtags, like_count, retweet_count, reply_count, view_count, lang,
               strftime(ts, '%Y-%m-%d') AS data_acquisition_date,
               '{Q.INGESTED}' AS ingestion_timestamp, '{Q.INGESTED}' AS analysis_timestamp
        FROM posts""",
    "hashtag_join": f"WITH {POSTS} SELECT tweet_id, {_TAGS} AS hashtags FROM posts",
    "tweet_normalize": f"""WITH {POSTS}
        SELECT tweet_id, {_CREATED} AS created_at,
               CASE lang WHEN 'en' THEN upper(source) WHEN 'es' THEN 'Unknown' ELSE source END
                   AS author_name, text,
               CASE WHEN lang = 'es' THEN '' ELSE '#' || lang || ',#' || source END AS hashtags,
               '{Q.INGESTED[:10]}' AS data_acquisition_date
        FROM posts""",
    "key_vehicle": f"""WITH {EV}
        SELECT e, CASE WHEN event_type = 'error' THEN id ELSE id || '_' || u END AS row_key
        FROM ev""",
    "key_tweet": f"""WITH {EV}
        SELECT e, CASE WHEN event_type <> 'error' THEN id || '_' || e END AS row_key FROM ev""",
    "key_hour": f"""WITH {hours(V.WEATHER)}
        SELECT {_HOUR_TIME} AS time, {_HOUR_KEY} AS row_key FROM keyed""",
    "key_parse": f"""WITH {EV}
        SELECT e, id || '_' || u AS row_key, strftime(ts, {CLOCK}) AS key_time
        FROM ev WHERE event_type <> 'error'""",
    "key_partitions": f"""WITH {EV}
        SELECT id AS decision_id, strftime(ts, '%Y%m%d') AS dt, strftime(ts, '%H') AS hr FROM ev""",
    "default_fill": f"""WITH {ARC}
        SELECT decision_id,
               CASE WHEN decision_result = 'SHOW_AD' THEN round(traffic_score, 6) ELSE 0 END
                   AS traffic_score,
               CASE WHEN hr >= '12' THEN round(weather_score, 6) ELSE 0 END AS weather_score,
               CASE WHEN hr >= '12' THEN 0 ELSE round(sentiment_score, 6) END AS sentiment_score,
               round(global_score, 6) AS global_score,
               decision_result,
               CASE WHEN decision_result = 'SHOW_AD' THEN target_locations ELSE '[]' END
                   AS target_locations,
               CASE WHEN hr >= '12' THEN decision_time ELSE '' END AS decision_time,
               CASE WHEN hr >= '12' THEN '' ELSE display_time END AS display_time
        FROM arc""",
    "quarantine_rows": f"""WITH {REPORTS}
        SELECT CASE WHEN vehicle_number IS NULL THEN 'no_vehicle'
                    WHEN lat IS NULL THEN 'no_position' ELSE 'accepted' END AS reason,
               row_key AS detail FROM reports
        UNION ALL
        SELECT 'unreadable', strftime(ts, {CLOCK}) FROM ev WHERE event_type = 'error'""",
    # --- search
    "filter_keywords": f"WITH {POSTS} SELECT tweet_id, lang FROM posts WHERE {_MENTIONS}",
    "filter_geo_radius": f"""WITH {EV}, {POS}
        SELECT seq, vn, lat, lon FROM pos WHERE {_NEAR}""",
    "filter_since": f"""WITH {POSTS}
        SELECT tweet_id, strftime(ts, {CLOCK}) AS ts FROM posts
        WHERE ts >= {AS_OF} - INTERVAL 24 HOUR""",
    **{
        f"search_{name}": f"""WITH {POSTS}, found AS (
            SELECT *, like_count + retweet_count + reply_count AS engagement FROM posts
            WHERE {_MENTIONS} AND {_NEAR} AND ts >= {AS_OF} - INTERVAL 24 HOUR)
            SELECT tweet_id, strftime(ts, {CLOCK}) AS ts, text, engagement
            FROM (SELECT * FROM found ORDER BY {order} DESC, tweet_id LIMIT 20)"""
        for name, order in (("latest", "ts"), ("top", "engagement"))
    },
    # --- scalar functions
    "haversine": f"""WITH {EV}, {POS}
        SELECT seq, round({km("52.2297", "21.0122", "lat", "lon")}, 6) AS km FROM pos""",
    "weather_factors": f"""WITH {LINES}
        SELECT apparent_temp, rain, wind_speed, weather_code,
               {", ".join(f"{_OF_LINE[p]} AS {p}" for p in list(_OF_LINE)[:6])} FROM lines""",
    "weather_score": f"""WITH {LINES}
        SELECT apparent_temp, hour, weather_code,
               round({_OF_LINE["weather_score"]}, 6) AS weather_score FROM lines""",
    "weather_explain": f"""WITH {LINES}
        SELECT apparent_temp, hour, {_EXPLAIN.format(total=_OF_LINE["total_points"])}
                   AS factors_used FROM lines""",
    "sentiment_bucket": f"""WITH {EV}, {MOOD}
        SELECT tweet_id, round(compound, 6) AS compound, bucket FROM mood""",
    "lexicon_sentiment": f"""WITH {POSTS}, {LEXICON}
        SELECT tweet_id, matches, round(valence, 4) AS valence, round(compound, 4) AS compound
        FROM buckets""",
    "global_score": f"""WITH {DEC},
        both_blends AS (SELECT seq, global_score, round({DOCUMENTED_BLEND}, 6) AS documented_score
                        FROM dec)
        SELECT seq, round(global_score, 6) AS global_score, documented_score,
               CASE WHEN documented_score > CAST(0.6 AS DOUBLE) THEN 'SHOW_AD' ELSE 'NO_AD' END
                   AS documented_result
        FROM both_blends""",
    "targets_render": f"""WITH {DEC}
        SELECT seq, {_RENDERED} AS rendered,
               '[' || coalesce(array_to_string(list_transform(targets,
                   lambda t: '"' || t || '"'), ','), '') || ']' AS json
        FROM dec""",
    # --- traffic
    "vehicle_first_last": f"""WITH {MOVING}
        SELECT strftime(ws, {SECOND}) AS window_start, vn, first_lat, first_lon, last_lat,
               last_lon, strftime(first_ts, {CLOCK}) AS first_ts,
               strftime(last_ts, {CLOCK}) AS last_ts, reports
        FROM ends JOIN report_counts USING (ws, vn)""",
    "vehicle_speed": f"""WITH {MOVING}
        SELECT strftime(ws, {SECOND}) AS window_start, vn,
               {rounded("distance_km", "speed_kmh")}, is_congested AS congested FROM moving""",
    "traffic_score": f"""WITH {MOVING}
        SELECT strftime(ws, {SECOND}) AS window_start, vehicles, congested,
               round(traffic_score, 6) AS traffic_score FROM traffic""",
    "slowest_vehicles": f"""WITH {MOVING}
        SELECT strftime(ws, {SECOND}) AS window_start, vn, round(speed_kmh, 6) AS speed_kmh,
               strftime(first_ts, {CLOCK}) AS first_ts FROM moving WHERE is_congested""",
    "target_top5": f"""WITH {MOVING},
        ranked AS (SELECT ws, vn, row_number() OVER (PARTITION BY ws
                          ORDER BY speed_kmh, first_ts, vn) AS rank
                   FROM moving WHERE is_congested)
        SELECT strftime(ws, {SECOND}) AS window_start,
               string_agg(vn, '|' ORDER BY rank) AS targets
        FROM ranked WHERE rank <= 5 GROUP BY ws""",
    "sliding_traffic": f"""WITH {EV}, {POS}, {ends("pos", SLIDING)}
        SELECT strftime(ws, {SECOND}) AS window_start, vehicles, congested,
               round(traffic_score, 6) AS traffic_score FROM traffic""",
    # --- combination and decision
    "sentiment_ratio": f"""WITH {EV}, {MOOD}
        SELECT strftime(date_trunc('day', ts), {SECOND}) AS window_start, count(*) AS tweets,
               count(*) FILTER (WHERE bucket < 4) AS negative,
               round(count(*) FILTER (WHERE bucket < 4) / count(*), 6) AS sentiment_ratio
        FROM mood GROUP BY date_trunc('day', ts)""",
    "combine_signals": f"""WITH {EV}, {POS}, {MOOD},
        driving AS (SELECT * FROM pos WHERE event_type <> 'error'), {ends("driving", HOURLY)},
        talk AS (SELECT date_trunc('hour', ts) + INTERVAL 1 HOUR AS instant,
                        count(*) FILTER (WHERE bucket < 4) / count(*) AS sentiment_score
                 FROM mood WHERE event_type = 'error' GROUP BY 1),
        {SCORED_HOURS},
        every AS (SELECT ws + INTERVAL 1 HOUR AS instant FROM traffic UNION
                  SELECT instant FROM talk UNION SELECT ts FROM scored_hours)
        SELECT strftime(x.instant, {CLOCK}) AS instant,
               round(coalesce(t.traffic_score, 0), 6) AS traffic_score,
               round(coalesce(h.weather_score, 0), 6) AS weather_score,
               round(coalesce(m.sentiment_score, 0), 6) AS sentiment_score,
               t.ws IS NOT NULL AS traffic_found, h.ts IS NOT NULL AS weather_found,
               m.instant IS NOT NULL AS sentiment_found
        FROM every x LEFT JOIN traffic t ON t.ws + INTERVAL 1 HOUR = x.instant
             LEFT JOIN scored_hours h ON h.ts = x.instant
             LEFT JOIN talk m ON m.instant = x.instant""",
    "weather_at_decision": f"""WITH {EV}, {SCORED_HOURS}
        SELECT e AS seq, strftime(ev.ts, '%Y%m%d_%H') AS hour_key,
               round(weather_score, 6) AS weather_score,
               weather_score IS NOT NULL AS weather_found
        FROM ev LEFT JOIN scored_hours ON row_key = strftime(ev.ts, '%Y%m%d_%H')""",
    "weather_air_join": f"""WITH {hours({**V.WEATHER, **V.AIR})}
        SELECT row_key, {rounded("temp_2m", "rain", "pm10", "ozone", "ragweed_pollen")}
        FROM current""",
    "rain_congestion_join": f"""WITH {MOVING}, {hours(V.WEATHER)},
        wet AS (SELECT date_trunc('day', ts) AS ws, max(rain) AS rain FROM hours GROUP BY 1)
        SELECT strftime(ws, {SECOND}) AS window_start, round(rain, 6) AS rain, congested,
               round(traffic_score, 6) AS traffic_score
        FROM traffic JOIN wet USING (ws) WHERE rain > 0 AND congested > 0""",
    "decide": decisions(
        DAILY,
        "date_trunc('day', ts)",
        "INTERVAL 1 DAY",
        alone="CASE WHEN hour(ts) = 0 THEN [date_trunc('day', ts)] ELSE [] END",
    ),
    "decide_sliding": decisions(
        SLIDING, "unnest(list_transform(range(0, 10), lambda b:"
        " date_trunc('minute', ts) - to_minutes(b)))", "INTERVAL 10 MINUTE",
        alone="list_transform(range(0, 60), lambda m: date_trunc('hour', ts) + to_minutes(m))",
    ),
    "latest_state": f"""WITH {DEC}
        SELECT area, decision_id,
               {STATE_LEVEL.format("traffic_score")} AS congestion_level,
               {STATE_LEVEL.format("weather_score")} AS weather_level,
               {STATE_LEVEL.format("sentiment_score")} AS negativity_level,
               decision_result = 'SHOW_AD' AS show_ad
        FROM (SELECT *, 'district_' || (user_id % {V.DISTRICTS}) AS area FROM dec)
        QUALIFY row_number() OVER (PARTITION BY area ORDER BY decision_id DESC, seq DESC) = 1""",
    # --- reports
    "decision_distribution": _arc(
        "decision_result, count(*) AS decisions, round(avg(global_score), 9) AS avg_score"
    )
    + " GROUP BY decision_result",
    "show_rate": _arc(
        "count(*) AS total, round(count(*) FILTER (WHERE decision_result = 'SHOW_AD')"
        " * CAST(100 AS DOUBLE) / count(*), 6) AS show_rate_pct"
    ),
    "daily_show_rate": _arc(
        "dt, count(*) AS total, count(*) FILTER (WHERE decision_result = 'SHOW_AD') AS shown,"
        " round(count(*) FILTER (WHERE decision_result = 'SHOW_AD')"
        " * CAST(100 AS DOUBLE) / count(*), 2) AS show_rate_pct"
    )
    + " GROUP BY dt ORDER BY dt DESC",
    "rush_vs_offpeak": _arc(
        "CASE WHEN hr IN ('07', '08', '09', '16', '17', '18') THEN 'Rush Hour'"
        " ELSE 'Off-Peak' END AS period, round(avg(traffic_score), 9) AS avg_traffic,"
        " round(avg(weather_score), 9) AS avg_weather, round(avg(global_score), 9) AS avg_global"
    )
    + " GROUP BY 1",
    "summary_by_decision": f"""WITH {ARC}
        SELECT decision_result, count(*) AS decisions,
               round(count(*) * CAST(100 AS DOUBLE) / (SELECT count(*) FROM arc), 9) AS pct,
               {", ".join(f"round(avg({s}), 9) AS avg_{s}, round(stddev_samp({s}), 9) AS std_{s}"
                          for s in SCORES)}
        FROM arc GROUP BY decision_result""",
    "describe_scores": f"""WITH {ARC}, l AS ({LONG})
        SELECT score, count(*) AS n, round(avg(x), 9) AS mean, round(stddev_samp(x), 9) AS std,
               round(min(x), 6) AS min, round(quantile_cont(x, 0.25), 6) AS q25,
               round(quantile_cont(x, 0.5), 6) AS q50, round(quantile_cont(x, 0.75), 6) AS q75,
               round(max(x), 6) AS max FROM l GROUP BY score""",
    "score_histogram": _histogram(),
    "score_boxplot": f"""WITH {ARC}, l AS ({LONG}),
        q AS (SELECT decision_result, score, quantile_cont(x, 0.25) AS q25,
                     quantile_cont(x, 0.5) AS q50, quantile_cont(x, 0.75) AS q75
              FROM l GROUP BY 1, 2),
        f AS (SELECT *, q25 - (q75 - q25) * CAST(1.5 AS DOUBLE) AS lo,
                     q75 + (q75 - q25) * CAST(1.5 AS DOUBLE) AS hi FROM q)
        SELECT decision_result, score, {rounded("q25", "q50", "q75")},
               round(min(x) FILTER (WHERE x >= lo), 6) AS whisker_low,
               round(max(x) FILTER (WHERE x <= hi), 6) AS whisker_high,
               count(*) FILTER (WHERE x < lo OR x > hi) AS outliers
        FROM l JOIN f USING (decision_result, score) GROUP BY ALL""",
    "score_correlation": f"WITH {ARC} {_CORR}",
    "corr_with_global": f"""WITH {ARC}, m AS ({_CORR})
        SELECT score_a AS score, corr FROM m WHERE score_b = 'global_score' ORDER BY corr DESC""",
    "scatter_pairs": f"""WITH {ARC}, l AS ({LONG})
        SELECT decision_id, decision_result, score, x, round(global_score, 6) AS global_score
        FROM l WHERE score <> 'global_score'""",
    "score_timeseries": _arc(f"decision_id, decision_time, {R_SCORES}") + " ORDER BY decision_id",
    "hourly_pattern": _arc(
        "hr, count(*) AS decisions, "
        + ", ".join(f"round(avg({s}), 9) AS avg_{s}" for s in SCORES)
        + ", round(count(*) FILTER (WHERE decision_result = 'SHOW_AD')"
        " * CAST(100 AS DOUBLE) / count(*), 9) AS show_rate_pct"
    )
    + " GROUP BY hr ORDER BY hr",
    "most_triggered_days": _arc("dt, count(*) AS shown")
    + " WHERE decision_result = 'SHOW_AD' GROUP BY dt ORDER BY shown DESC, dt",
    "dataset_overview": f"WITH {ARC} "
    + " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, '{kind}' AS data_type, count(*) AS n_rows,"
        f" count({name}) AS n_filled FROM arc"
        for name, kind in _OVERVIEW_TYPES.items()
    ),
    "top10_scores": _arc("decision_id, round(global_score, 6) AS global_score, decision_result")
    + " ORDER BY round(arc.global_score, 6) DESC, decision_id LIMIT 10",
    "top5_days": _arc(
        "dt, round(avg(global_score), 9) AS avg_score, round(max(global_score), 6) AS max_score,"
        " count(*) AS decisions"
    )
    + " GROUP BY dt ORDER BY avg(global_score) DESC, dt LIMIT 5",
    # --- streaming: a window is final once the watermark has passed its end
    "stream_ingest": f"""WITH {REPORTS}
        SELECT row_key, vehicle_number, gps_time, lat, lon, epoch_us(ts) AS seq
        FROM reports WHERE vehicle_number IS NOT NULL AND lat IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY row_key ORDER BY ts DESC) = 1""",
    "stream_replay_idempotent": f"""WITH {REPORTS}
        SELECT count(*) AS logged, count(DISTINCT (row_key, ts)) AS distinct_writes
        FROM reports WHERE vehicle_number IS NOT NULL AND lat IS NOT NULL""",
    "stream_traffic": f"""WITH {MOVING}
        SELECT strftime(ws, {SECOND}) AS window_start, vehicles, congested,
               round(traffic_score, 6) AS traffic_score
        FROM traffic
        WHERE ws + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)""",
    "stream_sliding_traffic": f"""WITH {EV}, {POS}, {ends("pos", SLIDING)}
        SELECT strftime(ws, {SECOND}) AS window_start, vehicles, congested,
               round(traffic_score, 6) AS traffic_score
        FROM traffic
        WHERE ws + INTERVAL 10 MINUTE <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)""",
    "stream_decide": decisions(
        DAILY,
        "date_trunc('day', ts)",
        "INTERVAL 1 DAY",
        "WHERE instant <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)",
        alone="CASE WHEN hour(ts) = 0 THEN [date_trunc('day', ts)] ELSE [] END",
    ),
    "stream_rain_congestion": f"""WITH {MOVING}, {hours(V.WEATHER)},
        wet AS (SELECT date_trunc('day', ts) AS ws, max(rain) AS rain FROM hours GROUP BY 1),
        newest AS (SELECT least((SELECT max(ts) FROM events), (SELECT max(ts) FROM hours)) AS ts)
        SELECT strftime(ws, {SECOND}) AS window_start, round(rain, 6) AS rain, congested,
               round(traffic_score, 6) AS traffic_score
        FROM traffic JOIN wet USING (ws)
        WHERE rain > 0 AND congested > 0
          AND ws + INTERVAL 1 DAY <= (SELECT ts - INTERVAL 10 MINUTE FROM newest)""",
    "stream_late_data": f"""WITH {_NUMBERED}
        SELECT strftime(ws, {SECOND}) AS window_start,
               count(*) FILTER (WHERE NOT late) AS on_time, count(*) FILTER (WHERE late) AS late
        FROM judged GROUP BY ws
        HAVING ws + INTERVAL 1 HOUR <= (SELECT mark FROM final)""",
}
ORACLES["stream_ingest_tweets"] = f"""WITH {POSTS},
    sent AS (
        SELECT * FROM posts UNION ALL
        SELECT * REPLACE (substr(text, 1, length(text) // 2) AS text, ts + INTERVAL {V.EDITED_AFTER} AS ts)
        FROM posts WHERE lang = 'fr'),
    keyed AS (SELECT *, strftime(ts, {SECOND}) || '_' || tweet_id AS row_key FROM sent),
    words AS (
        SELECT row_key,
               unnest(regexp_extract_all(lower(text), '\\p{{L}}+(?:''\\p{{L}}+)*')) AS word
        FROM keyed),
    lexicon(word, valence) AS (VALUES {_LEX}),
    sums AS (
        SELECT row_key, count(*) AS matches, CAST(sum(valence) AS DOUBLE) AS valence
        FROM words JOIN lexicon USING (word) GROUP BY row_key),
    judged AS (
        SELECT row_key, tweet_id, coalesce(matches, 0) AS matches, length(text) AS chars,
               coalesce(valence / sqrt(valence * valence + 15), 0.0) AS polarity
        FROM keyed LEFT JOIN sums USING (row_key))
    SELECT row_key, tweet_id, matches, chars, round(polarity, 4) AS compound,
           least(greatest(CAST(trunc((polarity + 1) * CAST(4.5 AS DOUBLE)) AS INTEGER), 0), 9)
               AS sentiment_score
    FROM judged"""
ORACLES["stream_decide_chained"] = decisions(
    DAILY,
    "date_trunc('day', ts)",
    "INTERVAL 1 DAY",
    "WHERE instant <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)",
)
_READ_WEATHER = weather_score(
    "coalesce(apparent_temp, temp_2m)",
    "rain",
    "snowfall",
    "snow_depth",
    "wind_speed",
    "weather_code",
    "CAST(substr(row_key, 10, 2) AS INTEGER)",
)
_FROM_MESSAGES = f"""{REPORTS},
    drove AS (
        SELECT vehicle_number AS vn, strptime(gps_time, {CLOCK}) AS ts, epoch_us(ts) AS seq, lat, lon
        FROM reports WHERE vehicle_number IS NOT NULL AND lat IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY row_key ORDER BY reports.ts DESC) = 1),
    {ends("drove", DAILY)}, {POSTS}, {LEXICON},
    mood AS (SELECT ts, sentiment_score AS bucket FROM posts JOIN buckets USING (tweet_id)),
    {hours(V.WEATHER)},
    received AS (
        SELECT {_HOUR_KEY} AS row_key, seq, ts, {", ".join(parsed(schemas.WEATHER))} FROM keyed
        WHERE {_HOUR_KEY} IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY row_key ORDER BY seq DESC) = 1),
    scored_hours AS (
        SELECT row_key, ts, {_READ_WEATHER["weather_score"]} AS weather_score FROM received)"""
ORACLES["end_to_end"] = f"""
    SELECT * EXCLUDE (targets),
           CASE WHEN targets = '' THEN '[]' ELSE '[' || chr(39)
                || replace(targets, '|', chr(39) || ', ' || chr(39)) || chr(39) || ']' END AS target_locations
    FROM ({decisions(
        DAILY,
        "date_trunc('day', ts)",
        "INTERVAL 1 DAY",
        alone="CASE WHEN hour(ts) = 0 THEN [date_trunc('day', ts)] ELSE [] END",
        feeds=_FROM_MESSAGES,
    )})"""
# Partials come from the archive, which holds every decision once.
_ONCE_FROM = {
    "partial_distribution": "decision_distribution",
    "partial_show_rate": "show_rate",
    "partial_daily_show_rate": "daily_show_rate",
    "partial_rush_vs_offpeak": "rush_vs_offpeak",
    "partial_summary": "summary_by_decision",
    "partial_correlation": "score_correlation",
}
for _name, _of in _ONCE_FROM.items():
    ORACLES[_name] = f"WITH {ARC} " + ORACLES[_of].removeprefix(f"WITH {ARC}").replace(
        "FROM arc", "FROM arc_once"
    )
ORACLES["archive_reconciled"] = ORACLES["archive_incremental"]
ORACLES["stream_latest_state"] = ORACLES["latest_state"]
ORACLES["stream_once"] = f"""WITH {REPORTS}
    SELECT strftime(min(ts), {SECOND}) || '_' || vehicle_number AS row_key, vehicle_number, gps_time,
           lat, lon
    FROM reports WHERE vehicle_number IS NOT NULL AND lat IS NOT NULL
    GROUP BY lines, vehicle_number, brigade, gps_time, lat, lon"""
_ITEM_WORDS = "regexp_extract_all(lower(text), '\\p{L}+(?:''\\p{L}+)*')"
# Every character that bounds words stands between bars, so a bounded keyword is a plain substring.
_BARRED = "regexp_replace({0}, '([^\\p{{L}}\\p{{N}}])', '|\\1|', 'g')"
ORACLES["filter_keyword_table"] = f"""WITH {POSTS},
    items AS (SELECT {_ITEM_WORDS} AS w FROM benchmark),
    listed AS (
        SELECT DISTINCT unnest([array_to_string(w[1:1], ' '), array_to_string(w[2:3], ' '),
                                array_to_string(w[4:6], ' ')]) AS keyword FROM items),
    barred AS MATERIALIZED (
        SELECT keyword, '|' || {_BARRED.format("keyword")} || '|' AS sought FROM listed WHERE keyword <> ''),
    texts AS MATERIALIZED (
        SELECT tweet_id, lang, '|' || {_BARRED.format("lower(text)")} || '|' AS held FROM posts)
    SELECT tweet_id, lang, string_agg(keyword, '|' ORDER BY keyword) AS keywords
    FROM texts JOIN barred ON contains(held, sought) GROUP BY tweet_id, lang"""
ORACLES["filter_geo_cells"] = ORACLES["filter_geo_radius"]
# However many writers fed a table, its current rows are the same.
ORACLES["stream_shared_table"] = ORACLES["stream_ingest"]
ORACLES["stream_ingest_weather"] = ORACLES["forecast_latest"]
ORACLES["stream_ingest_air"] = f"""WITH {hours(V.AIR)}
    SELECT row_key, seq, {rounded(*V.AIR)} FROM current"""
