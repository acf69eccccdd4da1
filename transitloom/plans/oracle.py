"""The registered queries written in DuckDB's SQL, over the same tables.

No entry for the queries whose result is a model's: what is fixed in them (rows, keys, bounds)
has queries of its own.
"""

from __future__ import annotations

import math

# Named building blocks, each using only those before it.
_PARTS = {
    "ev": """
        SELECT event_id, ts, user_id, event_type, value,
               CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
               epoch_us(ts) // 1000000 AS epoch_s
        FROM events""",
    "vehicle": """
        SELECT CAST(user_id AS INTEGER) AS vehicle_id, event_type AS vehicle_type,
               k % 5 AS operator, 'R' || (k % 20) AS route, CAST(k % 2 + 1 AS VARCHAR) AS direction,
               strftime(ts, '%Y-%m-%d') AS start_date, strftime(ts, '%H:00') AS start_time,
               'D' || (k % 7) AS destination, CAST(event_id AS INTEGER) AS journey_id, k AS line,
               strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS "timestamp", epoch_s AS timestamp_seconds,
               CAST(floor(value) AS INTEGER) - 50 AS delay, value AS speed,
               60 + CAST(k AS DOUBLE) / 100 AS latitude,
               24 + CAST(user_id % 100 AS DOUBLE) / 100 AS longitude,
               k * 3 AS heading, CAST(k AS DOUBLE) / 4 AS accuracy,
               CASE WHEN k % 10 <> 0 THEN k END AS occupancy, CAST(k % 50 AS VARCHAR) AS stop,
               value * 8 AS odometer,
               CASE WHEN k % 2 = 0 THEN 'GPS' ELSE 'ODO' END AS location_source,
               '/hfp/v2/journey/ongoing/vp/' || event_type || '/' || k AS mqtt_topic
        FROM ev WHERE event_type <> 'signup'""",
    "trip": """
        SELECT CAST(event_id AS VARCHAR) AS trip_id, 'R' || (k % 20) AS route_id,
               strftime(ts, '%H:00') AS start_time, strftime(ts, '%Y-%m-%d') AS start_date,
               CAST(NULL AS VARCHAR) AS status,
               CASE WHEN k % 10 <> 9 THEN k % 8 END AS total_stops
        FROM ev WHERE event_type = 'signup'""",
    "raw": """
        SELECT event_id, user_id, k, value,
               CASE WHEN k % 4 = 3 THEN '/hfp/v2'
                    ELSE '/hfp/v2/journey/ongoing/vp/' || event_type || '/' || k END AS topic,
               '{"VP":{"veh":' || user_id || ',"route":"R' || k || '"' AS head,
               CASE CASE WHEN k % 20 < 10 THEN k % 10 ELSE 10 + k % 6 END
                   WHEN 0 THEN head || ',"spd":' || value || ',"desi":"centre","occu":' || k
                               || ',"acc":-1.5}}'
                   WHEN 1 THEN head || ',"spd":' || value || ',"desi":null,"stop":' || k || '}}'
                   WHEN 2 THEN head || ',"desi":"centre","lat":60.5,"long":24.5,"dl":-30}}'
                   WHEN 3 THEN head || ',"spd":null,"desi":"centre"}}'
                   WHEN 4 THEN head || ',"spd":-' || value || ',"desi":"centre","oper":"12"}}'
                   WHEN 5 THEN '{"VP":{"veh":' || k
                   WHEN 6 THEN '{}'
                   WHEN 7 THEN '{"VP":null}'
                   WHEN 8 THEN head || ',"spd":"' || value || '"}}'
                   WHEN 10 THEN head || ',"spd":' || value || ',"desi":"centre","occu":' || k
                               || ',"acc":-1.5}}' || chr(10)
                   WHEN 11 THEN head || ',"spd":' || value || ',"desi":null,"stop":' || k || '}}'
                               || chr(13) || chr(10)
                   WHEN 12 THEN ' ' || chr(10) || head
                               || ',"desi":"centre","lat":60.5,"long":24.5,"dl":-30}}' || chr(9)
                   WHEN 13 THEN head || ',"spd":null,"desi":"centre"}}' || head
                               || ',"spd":null,"desi":"centre"}}'
                   WHEN 14 THEN head || ',"spd":-' || value || ',"desi":"centre","oper":"12"}} x}'
                   WHEN 15 THEN head || ',"spd":' || value || ',"desi":"centre","occu":' || k
                               || ',"acc":-1.5}},{}'
                   ELSE '' END AS payload
        FROM ev""",
    "judged": """
        SELECT *, CASE WHEN json_valid(payload) THEN CAST(payload AS JSON) END AS doc,
               coalesce(json_type(doc) = 'OBJECT'
                   AND (NOT json_exists(doc, '$.VP') OR json_type(doc, '$.VP') = 'OBJECT')
                   AND coalesce(json_type(doc, '$.VP.spd') IN ('DOUBLE', 'BIGINT', 'UBIGINT'), true)
                   AND coalesce(json_type(doc, '$.VP.acc') IN ('DOUBLE', 'BIGINT', 'UBIGINT'), true)
                   AND coalesce(json_type(doc, '$.VP.occu') IN ('DOUBLE', 'BIGINT', 'UBIGINT'), true),
                   false) AS good
        FROM raw""",
    "feed": """
        SELECT CAST(o_orderkey AS VARCHAR) AS trip_id, 'R' || (o_orderkey % 20) AS route_id,
               o_orderkey, o_custkey, epoch_us(o_orderdate) // 1000000 AS epoch_s,
               CASE o_orderkey % 10 WHEN 1 THEN '' WHEN 2 THEN '20240230'
                    ELSE strftime(o_orderdate, '%Y%m%d') END AS raw_date,
               CASE o_orderkey % 10 WHEN 3 THEN '' WHEN 4 THEN 'soon'
                    ELSE lpad(CAST(o_orderkey % 30 AS VARCHAR), 2, '0') || ':'
                         || lpad(CAST(o_custkey % 60 AS VARCHAR), 2, '0') || ':07' END AS raw_time,
               CASE o_orderkey % 10 WHEN 5 THEN NULL WHEN 6 THEN 0
                    ELSE CAST(o_orderkey % 7 + 1 AS INTEGER) END AS stops
        FROM orders""",
    "facts": """
        SELECT CAST(event_id AS VARCHAR) AS trip_id, 'R' || (k % 20) AS route_id,
               strftime(ts, '%H:00') AS start_time, strftime(ts, '%Y-%m-%d') AS start_date,
               CAST(NULL AS VARCHAR) AS status, k % 8 AS total_stops,
               CAST(user_id AS INTEGER) AS vehicle_id, event_type AS vehicle_type, k % 5 AS operator,
               CAST(k % 2 + 1 AS VARCHAR) AS direction, CAST(event_id AS INTEGER) AS journey_id,
               k AS line, CASE WHEN k % 13 <> 0 THEN value END AS speed,
               CASE WHEN k % 10 <> 0 THEN k END AS occupancy,
               CASE WHEN k % 17 = 0 THEN NULL WHEN k % 19 = 0 THEN CAST('NaN' AS DOUBLE)
                    ELSE floor(value) - 50 END AS delay,
               60 + CAST(k AS DOUBLE) / 100 AS vehicle_latitude,
               24 + CAST(user_id % 100 AS DOUBLE) / 100 AS vehicle_longitude,
               ts AS "timestamp", epoch_s AS timestamp_seconds, CAST(k % 50 AS VARCHAR) AS stop,
               value * 8 AS odometer,
               CASE WHEN k % 2 = 0 THEN 'GPS' ELSE 'ODO' END AS location_source,
               CAST(hour(ts) AS INTEGER) AS hour, CAST(dayofweek(ts) + 1 AS INTEGER) AS day_of_week,
               CAST(CASE WHEN dayofweek(ts) IN (0, 6) THEN 1 ELSE 0 END AS INTEGER) AS is_weekend,
               epoch_s AS timestamp_numeric, CAST(hour(ts) AS BIGINT) * 3600 AS start_time_numeric,
               epoch_s // 86400 * 86400 AS start_date_numeric
        FROM ev""",
    "predictions": """
        SELECT total_stops, vehicle_id, journey_id, coalesce(speed, 0.0) AS speed,
               coalesce(occupancy, 0) AS occupancy, vehicle_latitude, vehicle_longitude,
               timestamp_seconds, CAST(stop AS INTEGER) AS stop, odometer, hour, day_of_week,
               is_weekend, CAST(length(vehicle_type) % 5 AS INTEGER) AS vehicle_type_index,
               CAST(length(route_id) % 5 AS INTEGER) AS route_id_index,
               CAST(length(location_source) % 5 AS INTEGER) AS location_source_index,
               CAST(length(CAST(operator AS VARCHAR)) % 5 AS INTEGER) AS operator_index,
               CAST(length(direction) % 5 AS INTEGER) AS direction_index,
               CAST(length(CAST(line AS VARCHAR)) % 5 AS INTEGER) AS line_index,
               timestamp_numeric, start_time_numeric, start_date_numeric,
               odometer / 16 AS predicted_delay
        FROM facts""",
    "gf": """
        SELECT CASE WHEN percent <> 9 THEN l_suppkey END AS vehicle_id, l_returnflag AS vehicle_type,
               l_linenumber AS operator, CAST(l_partkey % 20 AS INTEGER) AS line,
               l_quantity AS speed, CAST(round(l_tax * 100) AS INTEGER) AS occupancy,
               CASE WHEN percent <> 8 THEN l_orderkey END AS trip_id,
               'R' || (l_orderkey % 20) AS route_id,
               lpad(CAST(l_orderkey % 24 AS VARCHAR), 2, '0') || ':00' AS start_time,
               strftime(l_shipdate, '%Y-%m-%d') AS start_date, l_linestatus AS direction,
               l_linenumber AS total_stops, CASE WHEN percent <> 10 THEN l_partkey END AS stop,
               CASE WHEN percent <> 0 THEN 60 + CAST(l_partkey % 100 AS DOUBLE) / 100 END
                   AS vehicle_latitude,
               24 + l_tax AS vehicle_longitude, epoch_us(l_shipdate) // 1000000 AS timestamp_seconds,
               l_orderkey, l_linenumber, l_partkey, l_extendedprice
        FROM (SELECT *, CAST(round(l_discount * 100) AS INTEGER) AS percent FROM lineitem)""",
    "vt": """SELECT DISTINCT vehicle_id, trip_id FROM gf
             WHERE vehicle_id IS NOT NULL AND trip_id IS NOT NULL""",
    "tst": """SELECT DISTINCT trip_id, stop FROM gf WHERE trip_id IS NOT NULL AND stop IS NOT NULL""",
    "succession": """
        SELECT trip_id, stop1, stop2
        FROM (SELECT trip_id, stop AS stop1,
                     lead(stop) OVER (PARTITION BY trip_id ORDER BY stop) AS stop2 FROM tst)
        WHERE stop2 IS NOT NULL""",
    "sp": "SELECT DISTINCT stop1, stop2 FROM succession",
    "edges": """
        SELECT 'V_' || vehicle_id AS src, 'T_' || trip_id AS dst, 'EFFECTUE' AS relation FROM vt
        UNION ALL SELECT 'T_' || trip_id, 'S_' || stop, 'DESSERT' FROM tst
        UNION ALL SELECT 'S_' || stop1, 'S_' || stop2, 'PRECEDE' FROM sp""",
    "known": """
        SELECT 'V_' || s_suppkey AS id FROM supplier WHERE s_acctbal > 0
        UNION ALL SELECT 'T_' || o_orderkey FROM orders WHERE o_orderstatus <> 'P'
        UNION ALL SELECT 'S_' || p_partkey FROM part WHERE p_size > 10""",
    "pairs": """
        SELECT src, dst, arg_max(title, turn) AS title
        FROM (SELECT least(src, dst) AS src, greatest(src, dst) AS dst, relation AS title,
                     CASE relation WHEN 'EFFECTUE' THEN 0 WHEN 'DESSERT' THEN 1 ELSE 2 END AS turn
              FROM edges)
        GROUP BY 1, 2""",
}

_JOINED = """trip_id, route_id, start_time, start_date, status, total_stops, vehicle_id, vehicle_type,
    operator, direction, journey_id, line, speed, occupancy, delay, latitude AS vehicle_latitude,
    longitude AS vehicle_longitude, "timestamp", timestamp_seconds, stop, odometer, location_source"""

_TRIP_VEHICLE = f"""
    SELECT {_JOINED}
    FROM trip JOIN (SELECT * EXCLUDE (start_date, start_time), start_date AS d, start_time AS t
                    FROM vehicle) v
      ON trip.route_id = v.route AND trip.start_time = v.t AND trip.start_date = v.d"""

_FLATTENED = """
    SELECT vehicle_id, vehicle_type, operator, route, direction, start_time || ':00' AS start_time,
           replace(start_date, '-', '') AS start_date, destination, journey_id, line, "timestamp",
           timestamp_seconds, delay, speed, latitude, longitude, speed AS vehicle_speed, heading,
           accuracy, occupancy, stop, odometer, location_source, mqtt_topic
    FROM every_vehicle"""

_DIGEST = "md5(concat_ws('|', '42', {}))"


def _ranked(column: str) -> str:
    """Index of a category: by falling frequency, ties by name; NULL gets the next index."""
    return f"""CAST(coalesce((SELECT place FROM (
            SELECT CAST({column} AS VARCHAR) AS c,
                   row_number() OVER (ORDER BY count(*) DESC, CAST({column} AS VARCHAR)) - 1 AS place
            FROM f WHERE {column} IS NOT NULL GROUP BY 1) r WHERE r.c = CAST(f.{column} AS VARCHAR)),
            (SELECT count(DISTINCT {column}) FROM f)) AS DOUBLE) AS {column}_index"""


def _sample(columns: str, source: str, size: int) -> str:
    """The ``size`` rows with the smallest digest of all their columns."""
    names = [name.strip() for name in columns.split(",")]
    texts = ", ".join(f"coalesce(CAST({name} AS VARCHAR), '')" for name in names)
    return f"""(SELECT {columns} FROM {source}
                ORDER BY {_DIGEST.format(texts)}, {columns} LIMIT {size})"""


_VEHICLE_NODE = "vehicle_id, vehicle_type, operator, line, speed, occupancy"
_TRIP_NODE = "trip_id, route_id, start_time, start_date, direction, total_stops"
_STOP_NODE = "stop, vehicle_latitude, vehicle_longitude"


def _distinct(columns: str, required: str, source: str = "gf") -> str:
    wanted = " AND ".join(f"{name} IS NOT NULL" for name in required.split(", "))
    return f"(SELECT DISTINCT {columns} FROM {source} WHERE {wanted})"


def _metrics(signed: bool) -> str:
    denominator = "y" if signed else "abs(y)"
    return f"""
    SELECT {str(signed).lower()} AS signed, count(*) AS rows,
           round(sqrt(sum((y - p) * (y - p)) / count(*)), 6) AS rmse, round(avg(abs(y - p)), 6) AS mae,
           round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)), 6) AS r2,
           round(avg(abs(y - p) / CASE WHEN y <> 0 THEN {denominator} ELSE 1.0 END) * 100, 6) AS mape
    FROM (SELECT floor(value) - 50 AS y, CAST(k - 20 AS DOUBLE) AS p FROM ev)"""


def _graph_rows(vehicles: str, trips: str, stops: str, pairs: str) -> str:
    """Drawn nodes (with bare endpoints) and titled pairs in one list."""
    return f"""
    SELECT coalesce(n.id, e.id) AS src, CAST(NULL AS VARCHAR) AS dst, label, color, size
    FROM (SELECT DISTINCT 'V_' || vehicle_id AS id, 'Vehicle ' || vehicle_id AS label,
                 'blue' AS color, 10 AS size FROM {vehicles}
          UNION ALL SELECT DISTINCT 'T_' || trip_id, 'Trip ' || trip_id, 'green', 8 FROM {trips}
          UNION ALL SELECT DISTINCT 'S_' || stop, 'Stop ' || stop, 'red', 6 FROM {stops}) n
    FULL JOIN (SELECT src AS id FROM {pairs} UNION SELECT dst FROM {pairs}) e ON n.id = e.id
    UNION ALL SELECT src, dst, title, CAST(NULL AS VARCHAR), CAST(NULL AS INTEGER) FROM {pairs}"""


# name -> (building blocks, further named blocks, query)
# Rows with a label, and those on the test side of the split by journey.
_LABELLED = "delay IS NOT NULL AND NOT isnan(delay)"
_TEST_SIDE = "CAST('0x' || substr(md5('42|' || journey_id), 1, 8) AS BIGINT) % 100 >= 80"

_CATEGORIES = ("vehicle_type", "route_id", "location_source", "operator", "direction", "line")


def _learnt(column: str) -> str:
    """Index of a category as the training side has it; unseen values get the next index."""
    return f"""CAST(coalesce((SELECT place FROM (
            SELECT CAST({column} AS VARCHAR) AS c,
                   row_number() OVER (ORDER BY count(*) DESC, CAST({column} AS VARCHAR)) - 1 AS place
            FROM facts WHERE {_LABELLED} AND NOT ({_TEST_SIDE}) GROUP BY 1) r
            WHERE r.c = CAST(t.{column} AS VARCHAR)),
            (SELECT count(DISTINCT {column}) FROM facts WHERE {_LABELLED} AND NOT ({_TEST_SIDE})))
            AS DOUBLE) AS {column}_index"""


def _model_input(numeric: str) -> str:
    columns = [f"CAST({name} AS DOUBLE) AS {name}" for name in numeric.split()]
    return ", ".join([*columns, *map(_learnt, _CATEGORIES)])


_FILLED = "SELECT * REPLACE (coalesce(speed, 0.0) AS speed, coalesce(occupancy, 0) AS occupancy)"
_SCORER = """speed occupancy vehicle_latitude vehicle_longitude odometer timestamp_numeric
    start_time_numeric start_date_numeric hour day_of_week is_weekend"""

_TRIP_ALERTS = """,
    plans AS (
        SELECT trip_id, 0 AS stop_sequence, CAST(l_partkey AS VARCHAR) AS stop, due AS planned_time,
               CAST(NULL AS BIGINT) AS previous FROM planned
        UNION SELECT trip_id, 1, CAST(l_suppkey AS VARCHAR), due + shift, due FROM planned),
    sighted AS (
        SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS trip_id, CAST(l_partkey AS VARCHAR) AS stop,
               epoch_us(l_shipdate) // 1000000 + CAST(l_quantity AS BIGINT) * 60 - 1500 AS seen
        FROM lineitem),
    met AS (
        SELECT p.*, (SELECT min(s.seen - p.planned_time) FROM sighted s
                     WHERE s.trip_id = p.trip_id AND s.stop = p.stop
                     AND abs(s.seen - p.planned_time) <= 1200) AS away
        FROM plans p)
    SELECT trip_id, stop_sequence, stop, planned_time, 'out_of_order' AS issue,
           planned_time - previous AS offset_seconds FROM met WHERE planned_time < previous
    UNION ALL SELECT trip_id, stop_sequence, stop, planned_time, 'early', away FROM met WHERE away < -300
    UNION ALL SELECT trip_id, stop_sequence, stop, planned_time, 'late', NULL FROM met
        WHERE away IS NULL OR away > 300
    UNION ALL SELECT trip_id, stop_sequence, stop, planned_time, 'missing', NULL FROM met WHERE away IS NULL"""


def _pagerank(rounds: int, damping: float = 0.85) -> str:
    """The rounds one after the other, each a table of its own."""
    steps = [""",
    pr_links AS MATERIALIZED (SELECT DISTINCT src, dst FROM edges),
    pr_nodes AS MATERIALIZED (
        SELECT n.id, count(l.src) AS out_degree, 1.0::DOUBLE / count(*) OVER () AS start
        FROM (SELECT src AS id FROM pr_links UNION SELECT dst FROM pr_links) n
        LEFT JOIN pr_links l ON l.src = n.id GROUP BY n.id),
    pr_0 AS MATERIALIZED (SELECT id, start AS rank FROM pr_nodes)"""]
    for turn in range(rounds):
        steps.append(f"""
    pr_{turn + 1} AS MATERIALIZED (
        SELECT n.id, n.start * ({1 - damping}::DOUBLE + {damping}::DOUBLE * s.stuck)
            + {damping}::DOUBLE * coalesce(c.sent, 0) AS rank
        FROM pr_nodes n
        CROSS JOIN (SELECT coalesce(sum(rank) FILTER (out_degree = 0), 0) AS stuck
                    FROM pr_{turn} JOIN pr_nodes USING (id)) s
        LEFT JOIN (SELECT l.dst AS id, sum(r.rank / d.out_degree) AS sent
                   FROM pr_links l JOIN pr_{turn} r ON r.id = l.src JOIN pr_nodes d ON d.id = l.src
                   GROUP BY 1) c ON c.id = n.id)""")
    return ",".join(steps) + f" SELECT id, round(rank, 12) AS rank FROM pr_{rounds}"


# Metres that a degree of longitude has at 60 degrees north, as a plane true there takes it.
_EAST = 111_320.0 * math.cos(math.radians(60.0))


def _visits(max_gap: str) -> str:
    return f""",
    stays AS (
        SELECT user_id AS vehicle, epoch_s AS seen_at, CASE WHEN k % 10 <> 0 THEN CAST(k // 34 AS BIGINT) END AS stop
        FROM ev),
    marked AS (
        SELECT *, CASE WHEN lag(seen_at) OVER w IS NULL OR lag(stop) OVER w IS DISTINCT FROM stop
                       OR seen_at - lag(seen_at) OVER w > {max_gap} THEN 1 ELSE 0 END AS starts
        FROM stays WINDOW w AS (PARTITION BY vehicle ORDER BY seen_at, stop NULLS FIRST)),
    runs AS (
        SELECT vehicle, stop, min(seen_at) AS arrival, max(seen_at) AS departure, count(*) AS positions
        FROM (SELECT *, sum(starts) OVER (PARTITION BY vehicle ORDER BY seen_at, stop NULLS FIRST
                                          ROWS UNBOUNDED PRECEDING) AS run FROM marked)
        GROUP BY vehicle, run, stop HAVING stop IS NOT NULL)
    SELECT *, departure - arrival AS dwell,
           lead(stop) OVER (PARTITION BY vehicle ORDER BY arrival, departure, stop) AS next_stop,
           lead(arrival) OVER (PARTITION BY vehicle, stop ORDER BY arrival, departure) AS returns_at
    FROM runs"""


_ORACLES: dict[str, tuple[str, str]] = {
    "graph_stored_upsert": ("gf", """,
        last AS (
            SELECT vehicle_id, max(l_linenumber // 3) AS batch,
                   arg_max({'vehicle_type': vehicle_type, 'operator': operator, 'line': line, 'speed': speed,
                            'occupancy': occupancy},
                           {'b': l_linenumber // 3, 't': timestamp_seconds, 'o': l_orderkey,
                            'l': l_linenumber, 'p': l_partkey, 'e': l_extendedprice}) AS state
            FROM gf WHERE vehicle_id IS NOT NULL GROUP BY 1)
        SELECT 'V_' || vehicle_id AS src, NULL AS dst, state.vehicle_type, state.operator, state.line,
               state.speed, state.occupancy, CAST(batch AS BIGINT) AS batch FROM last
        UNION ALL
        SELECT 'V_' || vehicle_id, 'T_' || trip_id, NULL, NULL, NULL, NULL, NULL, min(l_linenumber // 3)
        FROM gf WHERE vehicle_id IS NOT NULL AND trip_id IS NOT NULL GROUP BY 1, 2"""),
    "stop_visits": ("ev", _visits("9000000000")),
    "stop_visits_with_gaps": ("ev", _visits("172800")),
    "nearest_stop": ("ev", f""",
        asked AS (SELECT event_id, 60 + value / 1000 AS latitude,
                         CASE WHEN k % 10 <> 9 THEN 24 + k / 50 END AS longitude FROM ev),
        given AS (SELECT p_partkey AS stop, 60 + p_partkey * 7919 % 1000 / 500.0::DOUBLE / wide AS latitude,
                         24 + p_partkey * 7907 % 997 / 250.0::DOUBLE / wide AS longitude
                  FROM (SELECT *, CASE WHEN p_partkey % 4 = 0 THEN 1.0::DOUBLE ELSE 64.0::DOUBLE END AS wide
                        FROM part)),
        best AS (
            SELECT event_id, list_min(list({{'d': dx * dx + dy * dy, 's': stop}})) AS b
            FROM (SELECT event_id, stop, s.longitude * {_EAST!r} - a.longitude * {_EAST!r} AS dx,
                         s.latitude * 111320.0::DOUBLE - a.latitude * 111320.0::DOUBLE AS dy
                  FROM asked a, given s WHERE a.longitude IS NOT NULL)
            GROUP BY event_id)
        SELECT a.*, b.s AS nearest_stop, sqrt(b.d) AS distance FROM asked a LEFT JOIN best USING (event_id)"""),
    "trip_alerts": ("planned", _TRIP_ALERTS),
    "stream_trip_sync": ("planned", _TRIP_ALERTS),
    "graph_pagerank": ("gf vt tst succession sp edges", _pagerank(10)),
    "graph_strong_components": ("gf", """,
        visits AS (SELECT trip_id, stop, min(timestamp_seconds) AS seen FROM gf
                   WHERE trip_id IS NOT NULL AND stop IS NOT NULL GROUP BY 1, 2),
        steps AS (SELECT DISTINCT stop AS src, dst FROM (
                      SELECT stop, lead(stop) OVER (PARTITION BY trip_id ORDER BY seen, stop) AS dst
                      FROM visits) WHERE dst IS NOT NULL),
        places AS MATERIALIZED (
            SELECT id, CAST(row_number() OVER (ORDER BY id) - 1 AS INTEGER) AS i, count(*) OVER () AS n
            FROM (SELECT src AS id FROM steps UNION SELECT dst FROM steps)),
        links AS MATERIALIZED (SELECT a.i AS src, b.i AS dst FROM steps
                  JOIN places a ON a.id = steps.src JOIN places b ON b.id = steps.dst),
        -- The set of places each one reaches, as bits, until no set grows any more.
        reach(k, i, bits, grown) AS (
            SELECT 0, i, set_bit(bitstring('0', CAST(n AS INTEGER)), i, 1), true FROM places
            UNION ALL
            SELECT a.k + 1, a.i, coalesce(a.bits | s.bits, a.bits), coalesce(a.bits | s.bits <> a.bits, false)
            FROM reach a LEFT JOIN (SELECT l.src, bit_or(r.bits) AS bits
                                    FROM links l JOIN reach r ON r.i = l.dst GROUP BY 1) s ON s.src = a.i
            WHERE (SELECT bool_or(grown) FROM reach))
        SELECT id, min(id) OVER (PARTITION BY bits) AS component
        FROM reach JOIN places USING (i) WHERE k = (SELECT max(k) FROM reach)"""),
    "travel_times": ("hops", "SELECT src, dst, min(weight) AS weight FROM hops GROUP BY 1, 2"),
    "graph_shortest_paths": ("hops", """,
        reached(id, distance) USING KEY (id) AS (
            SELECT CAST(p_partkey AS VARCHAR), 0::BIGINT FROM part WHERE p_size = 50
            UNION
            SELECT h.dst, min(f.distance + h.weight) AS nearer
            FROM reached f JOIN hops h ON h.src = f.id LEFT JOIN recurring.reached k ON k.id = h.dst
            WHERE k.id IS NULL OR f.distance + h.weight < k.distance GROUP BY h.dst)
        SELECT id, distance FROM reached"""),
    "graph_triangles": ("gf vt tst succession sp edges", """,
        pairs AS MATERIALIZED (SELECT DISTINCT least(src, dst) AS a, greatest(src, dst) AS b FROM edges
                               WHERE src <> dst),
        closed AS (SELECT x.a, x.b, y.b AS c FROM pairs x JOIN pairs y ON y.a = x.b
                   JOIN pairs z ON z.a = x.a AND z.b = y.b),
        counted AS (SELECT id, count(*) AS n FROM (
                        SELECT a AS id FROM closed UNION ALL SELECT b FROM closed UNION ALL SELECT c FROM closed)
                    GROUP BY 1),
        sizes AS (SELECT id, count(*) AS degree FROM (SELECT a AS id FROM pairs UNION ALL SELECT b FROM pairs)
                  GROUP BY 1)
        SELECT id, degree, coalesce(n, 0) AS triangles,
               CASE WHEN degree > 1 THEN 2 * coalesce(n, 0) / (degree * (degree - 1)) END AS clustering
        FROM sizes LEFT JOIN counted USING (id)"""),
    "graph_motifs": ("gf vt", """,
        visits AS (SELECT trip_id, stop, min(timestamp_seconds) AS seen FROM gf
                   WHERE trip_id IS NOT NULL AND stop IS NOT NULL GROUP BY 1, 2),
        steps AS MATERIALIZED (
            SELECT 'T_' || trip_id AS trip, stop || '>' || dst AS hop, dst || '>' || stop AS back
            FROM (SELECT *, lead(stop) OVER (PARTITION BY trip_id ORDER BY seen, stop) AS dst FROM visits)
            WHERE dst IS NOT NULL),
        runs AS (SELECT 'V_' || vehicle_id AS v, 'T_' || trip_id AS trip FROM vt)
        SELECT 'there and back' AS motif, a.v AS v1, x.trip AS t1, a.v AS v2, y.trip AS t2, x.hop AS p, y.hop AS q
        FROM steps x JOIN steps y ON y.hop = x.back AND x.trip <> y.trip AND x.hop < y.hop
        JOIN runs a ON a.trip = x.trip JOIN runs b ON b.trip = y.trip AND b.v = a.v
        UNION ALL
        SELECT 'same hop', a.v, x.trip, b.v, y.trip, x.hop, NULL
        FROM steps x JOIN steps y ON y.hop = x.hop AND x.trip < y.trip
        JOIN runs a ON a.trip = x.trip JOIN runs b ON b.trip = y.trip AND a.v <> b.v"""),
    "ml_score_columns": ("ev facts", f"""
        SELECT {_model_input("total_stops vehicle_id journey_id timestamp_seconds stop " + _SCORER)},
               true AS is_scored
        FROM ({_FILLED} FROM facts WHERE {_LABELLED}) t"""),
    "ml_batch_columns": ("ev facts", f"""
        SELECT batch_id, journey_id, {_model_input(_SCORER)}, true AS is_scored
        FROM ({_FILLED},
                  (row_number() OVER (ORDER BY "timestamp", journey_id) - 1) // 1000 AS batch_id
              FROM facts) t
        WHERE {_LABELLED} AND {_TEST_SIDE}"""),
    "vehicle_normalize": ("ev raw judged", """
        SELECT CAST(json_extract(doc, '$.VP.veh') AS INTEGER) AS vehicle_id,
               coalesce(nullif(split_part(topic, '/', 7), ''), 'unknown') AS vehicle_type,
               CAST(NULL AS INTEGER) AS operator, json_extract_string(doc, '$.VP.route') AS route,
               CASE WHEN json_exists(doc, '$.VP.desi') THEN json_extract_string(doc, '$.VP.desi')
                    ELSE 'unknown' END AS destination,
               CAST(json_extract(doc, '$.VP.dl') AS INTEGER) AS delay,
               greatest(coalesce(CAST(json_extract(doc, '$.VP.spd') AS DOUBLE), 0.0), 0.0) AS speed,
               CAST(json_extract(doc, '$.VP.lat') AS DOUBLE) AS latitude,
               CAST(json_extract(doc, '$.VP.long') AS DOUBLE) AS longitude,
               greatest(coalesce(CAST(json_extract(doc, '$.VP.spd') AS DOUBLE), 0.0), 0.0)
                   AS location_speed,
               greatest(coalesce(CAST(json_extract(doc, '$.VP.acc') AS DOUBLE), 0.0), 0.0) AS accuracy,
               greatest(coalesce(CAST(json_extract(doc, '$.VP.occu') AS INTEGER), 0), 0) AS occupancy,
               json_extract_string(doc, '$.VP.stop') AS stop, topic AS mqtt_topic
        FROM judged WHERE good"""),
    "reject_malformed": ("ev raw judged", "SELECT topic, payload FROM judged WHERE NOT good"),
    "topic_segment": ("ev raw", """
        SELECT event_id, coalesce(nullif(split_part(topic, '/', 7), ''), 'unknown') AS vehicle_type
        FROM raw"""),
    "clamp_non_negative": ("ev", """
        SELECT event_id, CASE WHEN k % 7 <> 0 AND value > 50 THEN value - 50 ELSE 0.0 END AS speed
        FROM ev"""),
    "trip_updates_normalize": ("feed", """
        SELECT trip_id, route_id, substr(raw_time, 1, 5) AS start_time,
               strftime(try_strptime(raw_date, '%Y%m%d'), '%Y-%m-%d') AS start_date,
               CAST(NULL AS VARCHAR) AS status, coalesce(stops, 0) AS total_stops
        FROM feed
        WHERE try_strptime(raw_date, '%Y%m%d') IS NOT NULL AND raw_time LIKE '__:__:__'"""),
    "nested_stop_times": ("feed", """
        SELECT trip_id, stops AS total_stops, CAST(i - 1 AS INTEGER) AS stop_sequence,
               CAST(o_custkey % 500 + i AS VARCHAR) AS stop_id,
               CASE WHEN i = 5 THEN 0 ELSE epoch_s + i * 600 END AS arrival_time,
               epoch_s + i * 600 + 30 AS departure_time
        FROM feed LEFT JOIN (SELECT unnest(range(1, 8)) AS i) places ON places.i <= stops"""),
    "date_reformat": ("", """
        SELECT o_orderkey,
               CASE WHEN o_orderkey % 10 NOT IN (1, 2) THEN strftime(o_orderdate, '%Y-%m-%d') END AS dashed,
               CASE WHEN o_orderkey % 10 NOT IN (1, 2) THEN strftime(o_orderdate, '%Y%m%d') END AS compact
        FROM orders"""),
    "time_reformat": ("", """
        SELECT o_orderkey,
               CASE WHEN ok THEN hh || ':' || mm END AS minutes,
               CASE WHEN ok THEN hh || ':' || mm || ':00' END AS with_seconds,
               CASE WHEN ok THEN o_orderkey % 30 * 3600 + o_custkey % 75 * 60 + 7 END AS seconds
        FROM (SELECT o_orderkey, o_custkey, o_custkey % 75 < 60 AS ok,
                     lpad(CAST(o_orderkey % 30 AS VARCHAR), 2, '0') AS hh,
                     lpad(CAST(o_custkey % 75 AS VARCHAR), 2, '0') AS mm FROM orders)"""),
    "weather_normalize": ("ev", """
        SELECT CAST(60.17 AS DOUBLE) AS latitude, CAST(24.94 AS DOUBLE) AS longitude,
               value AS temperature, k AS humidity, value AS wind_speed, k AS cloud_coverage,
               1000 + k AS pressure,
               CASE k % 10 WHEN 0 THEN 'N/A' WHEN 1 THEN NULL ELSE CAST(k * 100 AS VARCHAR) END
                   AS visibility,
               event_type AS weather_main, 'kind ' || k AS weather_description,
               strftime(ts, '%Y-%m-%d') AS "date", strftime(ts, '%H:%M') AS "time"
        FROM ev WHERE k % 10 NOT IN (2, 3, 4)"""),
    "epoch_split": ("", """
        SELECT event_id, strftime(ts, '%Y-%m-%d') AS "date", strftime(ts, '%H:%M') AS "time"
        FROM events"""),
    "json_parse": ("ev every_vehicle", """
        SELECT vehicle_id, route, journey_id, timestamp_seconds, speed, occupancy,
               latitude AS vehicle_latitude, longitude AS vehicle_longitude FROM every_vehicle"""),
    "vehicle_flatten": ("ev every_vehicle", _FLATTENED),
    "json_encode": ("ev facts", """
        SELECT CAST(json_object('trip_id', trip_id, 'route_id', route_id, 'status', status,
               'total_stops', total_stops, 'speed', speed, 'occupancy', occupancy, 'stop', stop)
               AS VARCHAR) AS value FROM facts"""),
    "trip_vehicle_join": ("ev vehicle trip", _TRIP_VEHICLE),
    "distinct_trips": ("ev every_trip", """
        SELECT trip_id, route_id, start_time, start_date FROM every_trip"""),
    "time_features": ("", """
        SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour,
               CAST(dayofweek(ts) + 1 AS INTEGER) AS day_of_week,
               CASE WHEN dayofweek(ts) IN (0, 6) THEN 1 ELSE 0 END AS saturday_sunday,
               CASE WHEN dayofweek(ts) IN (5, 6) THEN 1 ELSE 0 END AS friday_saturday
        FROM events"""),
    "feature_frame": ("ev facts", """
        SELECT route_id, total_stops, vehicle_id, vehicle_type, operator, direction, journey_id, line,
               coalesce(speed, 0.0) AS speed, coalesce(occupancy, 0) AS occupancy, delay,
               vehicle_latitude, vehicle_longitude, timestamp_seconds, stop, odometer,
               location_source, hour, day_of_week, is_weekend, timestamp_numeric,
               start_time_numeric, start_date_numeric
        FROM facts WHERE delay IS NOT NULL AND NOT isnan(delay)"""),
    "valid_label": ("ev facts", """
        SELECT journey_id, delay FROM facts WHERE delay IS NOT NULL AND NOT isnan(delay)"""),
    "fill_missing": ("ev facts", """
        SELECT journey_id, coalesce(speed, 0.0) AS speed, coalesce(occupancy, 0) AS occupancy,
               vehicle_latitude, odometer FROM facts"""),
    "epoch_features": ("ev facts", """
        SELECT journey_id, timestamp_numeric, start_time_numeric, start_date_numeric FROM facts"""),
    "schema_align": ("ev facts", """
        SELECT journey_id, speed, occupancy, 0 AS hour, 0 AS vehicle_type_index, odometer FROM facts"""),
    "string_index": ("ev facts", f"""
        SELECT journey_id, {_ranked("vehicle_type")}, {_ranked("route_id")},
               {_ranked("location_source")}, {_ranked("operator")}, {_ranked("direction")},
               {_ranked("line")}
        FROM (SELECT * FROM f) f"""),
    "category_frequency": ("ev facts", """
        SELECT route_id AS category, count(*) AS frequency FROM facts GROUP BY 1"""),
    "assembled_rows": ("ev facts", """
        SELECT journey_id FROM facts
        WHERE speed IS NOT NULL AND occupancy IS NOT NULL AND delay IS NOT NULL AND NOT isnan(delay)"""),
    "regression_metrics": ("ev", _metrics(False) + " UNION ALL " + _metrics(True)),
    "row_counts": ("ev facts gf", """
        SELECT 'facts' AS table_name, count(*) AS row_count, count(*) = 0 AS is_empty FROM facts
        UNION ALL SELECT 'stops', count(*), count(*) = 0
            FROM (SELECT DISTINCT stop, vehicle_latitude, vehicle_longitude FROM gf
                  WHERE stop IS NOT NULL)
        UNION ALL SELECT 'impossible_delays', count(*), count(*) = 0
            FROM facts WHERE delay < -1e9"""),
    "delay_histogram": ("ev facts", """
        SELECT CAST(b AS INTEGER) AS bin, round(lo + b * ((hi - lo) / 30), 6) AS bin_start,
               round(lo + (b + 1) * ((hi - lo) / 30), 6) AS bin_end,
               (SELECT count(*) FROM facts WHERE NOT isnan(delay)
                    AND least(floor((delay - lo) / (hi - lo) * 30), 29) = b) AS row_count
        FROM (SELECT unnest(range(0, 30)) AS b),
             (SELECT min(delay) AS lo, max(delay) AS hi FROM facts WHERE NOT isnan(delay))"""),
    "timestamp_batches": ("", """
        SELECT event_id, (row_number() OVER (ORDER BY ts, event_id) - 1) // 1000 AS batch_id
        FROM events"""),
    "first_batch": ("", "SELECT event_id, value FROM events ORDER BY ts, event_id LIMIT 1000"),
    "train_test_split": ("", """
        SELECT event_id, CASE WHEN CAST('0x' || substr(md5('42|' || event_id), 1, 8) AS BIGINT) % 100
                                   < 80 THEN 'train' ELSE 'test' END AS side
        FROM events"""),
    "vehicle_nodes": ("gf", f"SELECT * FROM {_distinct(_VEHICLE_NODE, 'vehicle_id')}"),
    "trip_nodes": ("gf", f"SELECT * FROM {_distinct(_TRIP_NODE, 'trip_id')}"),
    "stop_nodes": ("gf", f"SELECT * FROM {_distinct(_STOP_NODE, 'stop')}"),
    "vehicle_trip_edges": ("gf vt", "SELECT * FROM vt"),
    "trip_stop_edges": ("gf tst", "SELECT * FROM tst"),
    "position_edges": ("gf", """
        SELECT DISTINCT vehicle_id, vehicle_latitude, vehicle_longitude FROM gf
        WHERE vehicle_id IS NOT NULL AND vehicle_latitude IS NOT NULL
          AND vehicle_longitude IS NOT NULL"""),
    "position_nodes": ("gf", """
        SELECT DISTINCT vehicle_latitude, vehicle_longitude FROM gf
        WHERE vehicle_id IS NOT NULL AND vehicle_latitude IS NOT NULL
          AND vehicle_longitude IS NOT NULL"""),
    "stop_precede": ("gf tst succession", "SELECT * FROM succession"),
    "stop_precede_by_time": ("gf", """
        SELECT trip_id, stop1, stop2
        FROM (SELECT trip_id, stop AS stop1, lead(stop) OVER (
                         PARTITION BY trip_id ORDER BY min(timestamp_seconds), stop) AS stop2
              FROM gf WHERE trip_id IS NOT NULL AND stop IS NOT NULL GROUP BY trip_id, stop)
        WHERE stop2 IS NOT NULL"""),
    "graph_edges_resolved": ("gf vt tst succession sp edges known", """
        SELECT DISTINCT src, dst, relation FROM edges
        WHERE relation = 'PRECEDE'
           OR (src IN (SELECT id FROM known) AND dst IN (SELECT id FROM known))"""),
    "graph_position_edges_resolved": ("gf", """
        SELECT DISTINCT vehicle_id, vehicle_latitude, vehicle_longitude FROM gf
        WHERE vehicle_latitude IS NOT NULL AND vehicle_longitude IS NOT NULL
          AND vehicle_id IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)"""),
    "graph_position_upsert": ("gf", """
        SELECT DISTINCT 'V_' || vehicle_id AS src, vehicle_latitude, vehicle_longitude,
               'SE_DEPLACE_VERS' AS relation FROM gf
        WHERE vehicle_latitude IS NOT NULL AND vehicle_longitude IS NOT NULL
          AND vehicle_id IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)
        UNION ALL
        SELECT DISTINCT CAST(NULL AS VARCHAR), vehicle_latitude, vehicle_longitude, 'position'
        FROM gf WHERE vehicle_id IS NOT NULL AND vehicle_latitude IS NOT NULL
          AND vehicle_longitude IS NOT NULL"""),
    "graph_node_upsert": ("gf", """
        SELECT vehicle_id, vehicle_type, operator, line, speed, occupancy
        FROM (SELECT *, row_number() OVER (PARTITION BY vehicle_id ORDER BY timestamp_seconds DESC,
                     l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_extendedprice DESC) AS n
              FROM gf WHERE vehicle_id IS NOT NULL) WHERE n = 1
        UNION ALL
        SELECT s_suppkey, 'stored', s_nationkey, 0, 0.0, CAST(NULL AS INTEGER) FROM supplier
        WHERE s_suppkey NOT IN (SELECT vehicle_id FROM gf WHERE vehicle_id IS NOT NULL)"""),
    "graph_assemble": ("gf vt tst succession sp edges pairs", _graph_rows(
        _distinct("vehicle_id", "vehicle_id"), _distinct("trip_id", "trip_id"),
        _distinct("stop", "stop, vehicle_latitude"), "pairs")),
    "graph_sample": ("gf vt tst succession sp svt stst ssp spairs", _graph_rows(
        _sample(_VEHICLE_NODE, _distinct(_VEHICLE_NODE, "vehicle_id"), 300),
        _sample(_TRIP_NODE, _distinct(_TRIP_NODE, "trip_id"), 300),
        _sample(_STOP_NODE, _distinct(_STOP_NODE, "stop"), 300), "spairs")),
    "graph_select": ("gf vt", """
        SELECT DISTINCT 'V_' || vehicle_id AS id, 'vehicle_type' AS chosen_by FROM gf
        WHERE vehicle_id IS NOT NULL AND vehicle_type = 'R'
        UNION ALL SELECT DISTINCT 'V_' || vehicle_id, 'speed' FROM gf
        WHERE vehicle_id IS NOT NULL AND speed = 7
        UNION ALL (SELECT 'V_' || vehicle_id, 'relation' FROM vt
                   UNION SELECT 'T_' || trip_id, 'relation' FROM vt)"""),
    "graph_k_hop": ("gf vt tst succession sp edges ways hop0 hop1 hop2", """
        SELECT id, 0 AS hops FROM hop0
        UNION ALL SELECT id, 1 FROM hop1 WHERE id NOT IN (SELECT id FROM hop0)
        UNION ALL SELECT id, 2 FROM hop2
        WHERE id NOT IN (SELECT id FROM hop0) AND id NOT IN (SELECT id FROM hop1)"""),
    "graph_degrees": ("gf vt tst succession sp edges", """
        SELECT id, CAST(sum(o) AS BIGINT) AS out_degree, CAST(count(*) - sum(o) AS BIGINT) AS in_degree,
               count(*) AS degree
        FROM (SELECT src AS id, 1 AS o FROM edges UNION ALL SELECT dst, 0 FROM edges) GROUP BY id"""),
    "graph_components": ("gf vt tst succession sp edges all_ways labels", """
        SELECT id, label AS component FROM labels"""),
    "weather_enrich": ("ev", """
        SELECT p.event_id, p.minute, r.temperature, r.report_id
        FROM (SELECT event_id, epoch_s // 60 AS minute FROM ev WHERE event_type <> 'signup') p
        ASOF LEFT JOIN
             (SELECT epoch_s // 60 AS minute, arg_max(value, event_id) AS temperature,
                     max(event_id) AS report_id
              FROM ev WHERE event_type = 'signup' GROUP BY 1) r
        ON p.minute >= r.minute"""),
    "stream_weather_enrich": ("ev", """
        SELECT p.event_id, p.minute, r.temperature, r.report_id
        FROM (SELECT event_id, epoch_s // 60 AS minute FROM ev WHERE event_type <> 'signup') p
        ASOF LEFT JOIN
             (SELECT epoch_s // 60 AS minute, arg_max(value, event_id) AS temperature,
                     max(event_id) AS report_id
              FROM ev WHERE event_type = 'signup' GROUP BY 1) r
        ON p.minute >= r.minute"""),
    "trip_sync_issues": ("planned observed", """
        SELECT trip_id, 1 AS stop_sequence, CAST(l_suppkey AS VARCHAR) AS stop,
               'out_of_order' AS issue, shift AS offset_seconds
        FROM planned WHERE shift < 0
        UNION ALL
        SELECT p.trip_id, n, p.stop, 'out_of_sync', seen - arrival
        FROM (SELECT trip_id, 0 AS n, CAST(l_partkey AS VARCHAR) AS stop, due AS arrival FROM planned
              UNION ALL SELECT trip_id, 1, CAST(l_suppkey AS VARCHAR), due + shift FROM planned) p
        JOIN observed o ON o.trip_id = p.trip_id AND o.stop = p.stop
        WHERE abs(seen - arrival) > 300"""),
    "windowed_delay": ("ev every_vehicle", """
        SELECT timestamp_seconds // 3600 * 3600 AS window_start, route, count(*) AS positions,
               avg(delay) AS mean_delay
        FROM every_vehicle GROUP BY 1, 2"""),
    "csv_round_trip": ("ev facts predictions", "SELECT * FROM predictions"),
    "facts_csv_round_trip": ("ev vehicle trip", _TRIP_VEHICLE),
    "facts_by_date": ("ev facts", """
        SELECT 'all' AS dates, start_date, count(*) AS row_count FROM facts GROUP BY 2
        UNION ALL SELECT 'recent', start_date, count(*) FROM facts
            WHERE start_date >= '2024-01-15' GROUP BY 2"""),
    "view_scan": ("ev facts", "SELECT trip_id, route_id, start_date, line, odometer FROM facts"),
    "ensure_table": ("ev facts predictions", "SELECT * FROM predictions"),
    "stream_ingest": ("ev vehicle trip", """
        SELECT 'trip' AS kind, trip_id AS key, start_date AS "date", start_time AS "time" FROM trip
        UNION ALL SELECT 'vehicle', CAST(journey_id AS VARCHAR), start_date, start_time FROM vehicle
        UNION ALL SELECT 'weather', CAST(value AS VARCHAR), strftime(ts, '%Y-%m-%d'),
                         strftime(ts, '%H:%M') FROM ev WHERE event_type = 'signup'"""),
    "stream_to_table": ("ev every_vehicle", _FLATTENED),
    "stream_counts": ("ev every_vehicle", """
        SELECT vehicle_type, count(*) AS row_count FROM every_vehicle GROUP BY 1"""),
    "stream_trip_vehicle_join": ("ev vehicle trip", _TRIP_VEHICLE),
    "stream_normalize": ("ev raw judged", """
        SELECT CASE WHEN good THEN 'published' ELSE 'rejected' END AS side, topic,
               CASE WHEN good THEN coalesce(nullif(split_part(topic, '/', 7), ''), 'unknown') END
                   AS vehicle_type,
               CASE WHEN good THEN CAST(json_extract(doc, '$.VP.veh') AS INTEGER) END AS vehicle_id,
               CASE WHEN NOT good THEN payload END AS payload
        FROM judged"""),
    "stream_windowed_delay": ("ev every_vehicle", """
        SELECT timestamp_seconds // 3600 * 3600 AS window_start, route, count(*) AS positions,
               avg(delay) AS mean_delay
        FROM every_vehicle GROUP BY 1, 2"""),
    "ml_train_check": ("ev facts", f"""
        SELECT count(*) AS rows, true AS beats_mean FROM facts
        WHERE {_LABELLED} AND {_TEST_SIDE}"""),
    "ml_score_rows": ("ev facts", f"""
        SELECT CAST(journey_id AS DOUBLE) AS journey_id,
               CASE WHEN line % 3 > 0 THEN CAST(stop AS DOUBLE) END AS stop,
               odometer, CAST(hour AS DOUBLE) AS hour,
               CASE WHEN line % 3 > 0 THEN true END AS within_labels
        FROM facts WHERE {_LABELLED}"""),
    "ml_batch_rows": ("ev facts", f"""
        SELECT batch_id, journey_id
        FROM (SELECT *, (row_number() OVER (ORDER BY "timestamp", journey_id) - 1) // 1000 AS batch_id
              FROM facts)
        WHERE {_LABELLED} AND {_TEST_SIDE}"""),
    "time_features_in_zone": ("", """
        SELECT event_id, CAST(hour(l) AS INTEGER) AS hour,
               CAST(dayofweek(l) + 1 AS INTEGER) AS day_of_week,
               CASE WHEN dayofweek(l) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend
        FROM (SELECT event_id, ts + INTERVAL 7 HOUR AS l FROM events)"""),
}

_PARTS |= {
    "every_vehicle": _PARTS["vehicle"].replace(" WHERE event_type <> 'signup'", ""),
    "every_trip": _PARTS["trip"].replace(" WHERE event_type = 'signup'", ""),
    "f": """SELECT * REPLACE (CASE WHEN line % 11 <> 0 THEN vehicle_type END AS vehicle_type)
            FROM facts""",
    "svt": "SELECT * FROM " + _sample("vehicle_id, trip_id", "vt", 500),
    "stst": "SELECT * FROM " + _sample("trip_id, stop", "tst", 500),
    "ssp": "SELECT * FROM " + _sample("stop1, stop2", "sp", 500),
    "spairs": """
        SELECT DISTINCT least(a, b) AS src, greatest(a, b) AS dst, title
        FROM (SELECT 'V_' || vehicle_id AS a, 'T_' || trip_id AS b, 'EFFECTUE' AS title FROM svt
              UNION ALL SELECT 'T_' || trip_id, 'S_' || stop, 'DESSERT' FROM stst
              UNION ALL SELECT 'S_' || stop1, 'S_' || stop2, 'PRECEDE' FROM ssp)""",
    "ways": "SELECT src, dst FROM edges UNION SELECT dst, src FROM edges",
    "hop0": "SELECT 'V_' || s_suppkey AS id FROM supplier WHERE s_acctbal < 0",
    "hop1": "SELECT DISTINCT dst AS id FROM ways WHERE src IN (SELECT id FROM hop0)",
    "hop2": "SELECT DISTINCT dst AS id FROM ways WHERE src IN (SELECT id FROM hop1)",
    "links": """
        SELECT src, dst FROM edges
        UNION ALL SELECT 'C_' || c_custkey, 'N_' || c_nationkey FROM customer
        UNION ALL SELECT 'N_' || n_nationkey, 'A_' || n_regionkey FROM nation""",
    "all_ways": "SELECT src, dst FROM links UNION SELECT dst, src FROM links",
    "planned": """
        SELECT CAST(l_orderkey AS VARCHAR) AS trip_id, l_partkey, l_suppkey,
               epoch_us(l_shipdate) // 1000000 AS due, CAST((l_linenumber - 3) * 600 AS BIGINT) AS shift
        FROM lineitem""",
    "hops": """
        SELECT src, dst, arrives - leaves AS weight
        FROM (SELECT CAST(l_partkey AS VARCHAR) AS dst, CASE WHEN l_partkey % 11 <> 0 THEN t END AS arrives,
                     lag(CAST(l_partkey AS VARCHAR)) OVER stops AS src,
                     lag(CASE WHEN l_partkey % 11 <> 0 THEN t END) OVER stops AS leaves
              FROM (SELECT *, epoch_us(l_shipdate) // 1000000 AS t FROM lineitem)
              WINDOW stops AS (PARTITION BY l_orderkey ORDER BY t, l_partkey, l_linenumber))
        WHERE src IS NOT NULL AND arrives >= leaves""",
    "observed": """
        SELECT CAST(l_orderkey AS VARCHAR) AS trip_id, CAST(l_partkey AS VARCHAR) AS stop,
               min(epoch_us(l_shipdate) // 1000000 + CAST(l_quantity AS BIGINT) * 60 - 1500) AS seen
        FROM lineitem GROUP BY 1, 2""",
}


def _build(parts: str, body: str) -> str:
    names = parts.split()
    if "FROM f)" in body:
        names.append("f")
    if "all_ways" in names:
        names.insert(names.index("all_ways"), "links")
    blocks = []
    for name in names:
        if name == "labels":
            # Keyed recursion: a node's label is replaced while a smaller one arrives.
            blocks.append("""labels(id, label) USING KEY (id) AS (
                SELECT DISTINCT src, src FROM all_ways
                UNION
                SELECT w.dst, min(l.label) FROM labels l JOIN all_ways w ON w.src = l.id
                JOIN recurring.labels r ON r.id = w.dst
                WHERE l.label < r.label GROUP BY w.dst)""")
        else:
            blocks.append(f"{name} AS ({_PARTS[name]})")
    if not blocks:
        return body
    recursive = "labels" in names or "USING KEY" in body or "reach(" in body
    kind = "WITH RECURSIVE " if recursive else "WITH "
    return kind + ",\n".join(blocks) + body


def all_oracles() -> dict[str, str]:
    return {name: _build(parts, body) for name, (parts, body) in _ORACLES.items()}
