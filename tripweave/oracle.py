"""DuckDB SQL for the queries of ``registry``, over the same test tables."""

from __future__ import annotations

# Some trips have no pickup time, none with an hour, no ids or no distance.
TRIPS = """
trips AS (
  SELECT CASE l_returnflag WHEN 'A' THEN 'bike' WHEN 'N' THEN 'yellow' ELSE 'green' END AS mode,
         CASE WHEN l_orderkey % 97 = 0 THEN NULL
              WHEN l_returnflag = 'A' AND l_linenumber % 2 = 0
              THEN concat(month(l_shipdate), '/1/', year(l_shipdate),
                          CASE WHEN l_orderkey % 89 = 0 THEN '' ELSE concat(' ', l_linenumber, ':05') END)
              ELSE concat(year(l_shipdate), '-', lpad(CAST(month(l_shipdate) AS VARCHAR), 2, '0'),
                          '-01', CASE WHEN l_orderkey % 89 = 0 THEN '' ELSE
                          concat(' ', lpad(CAST(l_linenumber AS VARCHAR), 2, '0'), ':05:09') END)
         END AS pickup,
         CASE WHEN l_orderkey % 83 <> 0 THEN CAST(l_suppkey AS VARCHAR) END AS start_id,
         CASE WHEN l_orderkey % 79 <> 0 THEN CAST(c_nationkey AS VARCHAR) END AS end_id,
         l_quantity * 60 + l_linenumber AS duration,
         CASE WHEN l_orderkey % 73 = 0 THEN NULL WHEN l_tax = 0 THEN '.00'
              ELSE concat(CAST(CAST(l_quantity AS INTEGER) AS VARCHAR), '.5') END AS distance,
         CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Subscriber' ELSE 'Customer' END
           AS usertype,
         CASE WHEN o_orderstatus = 'F' THEN '1' ELSE '2' END AS payment_type,
         CASE WHEN l_linestatus = 'O' THEN '2' ELSE '1' END AS trip_type
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
)"""

# Month and day get two digits, the hour stays as written.
CELLS = """
timed AS (
  SELECT *, split_part(pickup, ':', 1) AS head FROM trips
),
celled AS (
  SELECT *,
         CASE WHEN mode = 'bike' AND contains(head, '/')
              THEN rtrim(concat(split_part(split_part(head, ' ', 1), '/', 3), '-',
                          lpad(split_part(head, '/', 1), 2, '0'), '-',
                          lpad(split_part(head, '/', 2), 2, '0'), ' ', split_part(head, ' ', 2)))
              ELSE head END AS time_cell
  FROM timed
)"""

# The later revision of a start zip counts; blank and missing zips are unknown.
LOOKUPS = """
start_rows AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS id, 0 AS line, '99999' AS zip
  FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_suppkey % 17 <> 0
  UNION ALL
  SELECT CAST(s_suppkey AS VARCHAR), 1,
         CASE WHEN s_suppkey % 19 = 0 THEN ''
              ELSE lpad(CAST(10000 + n_regionkey AS VARCHAR), 5, '0') END
  FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_suppkey % 17 <> 0
),
start_lookup AS (
  SELECT id, nullif(arg_max(zip, line), '') AS zip FROM start_rows GROUP BY id
),
end_lookup AS (
  SELECT CAST(n_nationkey AS VARCHAR) AS id,
         CASE WHEN n_nationkey % 11 = 0 THEN NULL
              ELSE lpad(CAST(10000 + n_regionkey AS VARCHAR), 5, '0') END AS zip
  FROM nation
)"""

LOCATED = f"""
{TRIPS},
{CELLS},
{LOOKUPS},
located AS (
  SELECT c.*, split_part(time_cell, ' ', 1) AS "date",
         coalesce(nullif(split_part(time_cell, ' ', 2), ''), '-1') AS "hour",
         coalesce(s.zip, '00000') AS start_zip, coalesce(e.zip, '00000') AS end_zip,
         CASE WHEN mode <> 'bike' THEN CAST(distance AS DOUBLE) END AS miles
  FROM celled c
  LEFT JOIN start_lookup s ON c.start_id = s.id
  LEFT JOIN end_lookup e ON c.end_id = e.id
  WHERE pickup IS NOT NULL AND (mode = 'bike' OR distance <> '.00')
)"""

# Distances that are no numbers, and zips that are 0.
BAD_TRIPS = TRIPS.replace(
    "WHEN l_tax = 0 THEN '.00'", "WHEN l_orderkey % 71 = 0 THEN 'n/a' WHEN l_tax = 0 THEN '.00'"
)
BAD_LOCATED = LOCATED.replace(TRIPS, BAD_TRIPS).replace(
    "CAST(distance AS DOUBLE)", "TRY_CAST(distance AS DOUBLE)"
).replace(
    "distance <> '.00')", "distance <> '.00' AND TRY_CAST(distance AS DOUBLE) IS NOT NULL)"
)
ZERO_LOCATED = LOCATED.replace(
    "CASE WHEN s_suppkey % 19 = 0 THEN ''",
    "CASE WHEN s_suppkey % 5 = 0 THEN '0' WHEN s_suppkey % 19 = 0 THEN ''",
).replace("coalesce(s.zip, '00000')", "coalesce(nullif(s.zip, '0'), '00000')")

KEYS = '"date", "hour", start_zip, end_zip'
GROUP = f"time_cell, {KEYS}"
MINUTES = "floor(avg(duration) / 60.0 * 100.0 + 0.5) / 100.0"
SUBSCRIBERS = "count(*) FILTER (WHERE usertype = 'Subscriber')"
CARDS = "count(*) FILTER (WHERE payment_type = '1')"
DISPATCHED = "count(*) FILTER (WHERE trip_type = '2')"


def _bike(having: str = f"HAVING {SUBSCRIBERS} > 0") -> str:
    return f"""
  SELECT {KEYS}, count(*) AS bike_trip_count, {SUBSCRIBERS} / count(*) AS sub_percent,
         {MINUTES} AS bike_duration
  FROM located WHERE mode = 'bike' GROUP BY {GROUP} {having}"""


def _taxi(mode: str, having: str = f"HAVING {CARDS} > 0") -> str:
    dispatch = f", {DISPATCHED} / count(*) AS green_dispatch_percent" if mode == "green" else ""
    return f"""
  SELECT {KEYS}, count(*) AS {mode}_trip_count, {CARDS} AS {mode}_cc_count,
         {CARDS} / count(*) AS {mode}_cc_percent, avg(miles) AS {mode}_trip_distance_avg{dispatch}
  FROM located WHERE mode = '{mode}' GROUP BY {GROUP} {having}"""


def _profiles(all_cells: bool = False, located: str = LOCATED) -> str:
    options = ("",) if all_cells else ()
    return f"""
WITH {located},
bike AS ({_bike(*options)}),
yellow AS ({_taxi('yellow', *options)}),
green AS ({_taxi('green', *options)}),
profile AS (
  SELECT * FROM bike FULL JOIN yellow USING ({KEYS}) FULL JOIN green USING ({KEYS})
)"""


PADDED = LOCATED.replace(
    "located AS (", "plain AS ("
) + """,
located AS (
  SELECT * REPLACE (lpad("hour", 2, '0') AS "hour",
                    concat("date", ' ', lpad("hour", 2, '0')) AS time_cell)
  FROM plain WHERE mode = 'bike' OR miles >= 2.0
)"""

GOLDEN = f"""
golden AS (
  SELECT concat(start_zip, end_zip, "date", "hour") AS key, count(*) AS "count"
  FROM located
  WHERE mode = 'bike' AND NOT (start_zip = '00000' AND end_zip = '00000')
  GROUP BY 1
),
counted AS (
  SELECT concat(start_zip, end_zip, "date", "hour") AS key, "date", "hour", count(*) AS n
  FROM located
  WHERE mode = 'bike' AND NOT (start_zip = '00000' AND end_zip = '00000')
  GROUP BY start_zip, end_zip, "date", "hour"
)"""


def _delta(counted: str, golden: str) -> str:
    return f"""
SELECT key, coalesce(c.n, 0) - coalesce(g."count", 0) AS delta
FROM {counted} c FULL JOIN {golden} g USING (key)"""


def _exact_sum(value: str) -> str:
    """A sum of doubles that does not depend on their order: whole numbers of 2**-16 and of 2**-48."""
    coarse = f"floor({value} * 65536.0)"
    return (f"(sum(CAST({coarse} AS BIGINT)) / 65536.0 + "
            f"sum(CAST(floor(({value} * 65536.0 - {coarse}) * 4294967296.0) AS BIGINT)) / 281474976710656.0)")


def _weighted(value: str, mode: str) -> str:
    return f"{_exact_sum(f'({value} * {mode}_trip_count)')} / sum({mode}_trip_count)"


def _grid(key: str, a: int, b: int) -> str:
    return f"40.0 + ({key} * {a}) % 1024 / 1024.0 AS lat, -74.0 + ({key} * {b}) % 1024 / 1024.0 AS lon"


KNOWN = f"""
known AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS id,
         lpad(CAST(10000 + s_nationkey AS VARCHAR), 5, '0') AS zip, {_grid('s_suppkey', 37, 91)}
  FROM supplier WHERE s_suppkey % 17 <> 0 AND s_suppkey % 19 <> 0
)"""


def _nearest(points: str, columns: str) -> str:
    """Each row of ``points`` with the zip of the nearest known place, least zip on a tie."""
    return f"""
SELECT {columns}, zip FROM (
  SELECT p.*, k.zip, row_number() OVER (
           PARTITION BY p.id
           ORDER BY (p.lon * 0.75 - k.lon * 0.75) * (p.lon * 0.75 - k.lon * 0.75)
                    + (p.lat - k.lat) * (p.lat - k.lat), k.zip) AS place
  FROM {points} p CROSS JOIN known k
) WHERE place = 1"""


CENTROIDS = f"""
rings AS (
  SELECT CAST(s_suppkey AS INTEGER) AS zone, s_suppkey * 150 AS lo, s_suppkey * 150 + 150 AS hi
  FROM supplier
),
vertices AS (SELECT o_orderkey AS id, {_grid('o_custkey', 37, 91)} FROM orders),
centroids AS (
  SELECT zone, avg(lat) AS lat, avg(lon) AS lon, count(*) AS vertices
  FROM vertices JOIN rings ON id >= lo AND id < hi GROUP BY zone
)"""

DESTINATIONS = f"""
SELECT end_zip,
       CAST(sum(coalesce(bike_trip_count, 0) + coalesce(yellow_trip_count, 0)
                + coalesce(green_trip_count, 0)) AS BIGINT) AS travellers,
       sum(coalesce(bike_trip_count, 0)) / sum(coalesce(bike_trip_count, 0) + coalesce(yellow_trip_count, 0) + coalesce(green_trip_count, 0)) AS bike_share,
       sum(coalesce(yellow_trip_count, 0)) / sum(coalesce(bike_trip_count, 0) + coalesce(yellow_trip_count, 0) + coalesce(green_trip_count, 0)) AS yellow_share,
       sum(coalesce(green_trip_count, 0)) / sum(coalesce(bike_trip_count, 0) + coalesce(yellow_trip_count, 0) + coalesce(green_trip_count, 0)) AS green_share,
       {_weighted("sub_percent", "bike")} AS subscriber_share,
       sum(yellow_cc_count) / sum(yellow_trip_count) AS yellow_card_share,
       sum(green_cc_count) / sum(green_trip_count) AS green_card_share,
       {_weighted("yellow_trip_distance_avg", "yellow")} AS yellow_distance,
       {_weighted("green_trip_distance_avg", "green")} AS green_distance,
       {_weighted("bike_duration", "bike")} AS bike_minutes,
       {_weighted("green_dispatch_percent", "green")} AS dispatch_share
FROM profile
WHERE start_zip = '10001' AND "date" BETWEEN '1996-01-01' AND '1999-12-31'
  AND "hour" IN ('1', '01', '2', '02', '3', '03', '4', '04')
GROUP BY end_zip"""


# Half the trips come from files with points and no location ids.
POINTS = f"""
{TRIPS},
{LOOKUPS},
point_trips AS (
  SELECT mode,
         CASE minute WHEN 13 THEN 0.0 WHEN 14 THEN NULL ELSE 40.0 + ((s * 37 + line * 6 - 20) % 1024 + 1024) % 1024 / 1024.0 END AS start_lat,
         CASE minute WHEN 13 THEN 0.0 WHEN 14 THEN NULL ELSE -74.0 + ((s * 91 + line * 5 - 30) % 1024 + 1024) % 1024 / 1024.0 END AS start_lon,
         CASE minute WHEN 13 THEN 0.0 WHEN 14 THEN NULL ELSE 40.0 + (e * 173 + minute * 59) % 1024 / 1024.0 END AS end_lat,
         CASE minute WHEN 13 THEN 0.0 WHEN 14 THEN NULL ELSE -74.0 + (e * 311 + minute * 101) % 1024 / 1024.0 END AS end_lon
  FROM (SELECT *, CAST(duration AS BIGINT) % 60 AS line, CAST(floor(duration / 60) AS BIGINT) AS minute,
               CAST(start_id AS BIGINT) AS s, CAST(end_id AS BIGINT) AS e FROM trips)
  WHERE mode <> 'bike' AND line % 2 = 1
),
edges AS (
  SELECT CAST(s_suppkey AS INTEGER) AS zone, lon + a.x / 1024.0 AS x1, lat + a.y / 1024.0 AS y1,
         lon + b.x / 1024.0 AS x2, lat + b.y / 1024.0 AS y2
  FROM (SELECT s_suppkey, {_grid('s_suppkey', 37, 91)} FROM supplier),
       (VALUES (0, -48, -40, 1), (1, 0, -16, 2), (2, 52, -44, 3), (3, 28, 4, 4), (4, 48, 52, 5), (5, 4, 24, 6),
               (6, -44, 48, 7), (7, -20, 0, 0), (8, -8, -8, 9), (9, 8, -8, 10), (10, 8, 8, 11), (11, -8, 8, 8)
       ) AS a(n, x, y, next_n)
  JOIN (VALUES (0, -48, -40), (1, 0, -16), (2, 52, -44), (3, 28, 4), (4, 48, 52), (5, 4, 24), (6, -44, 48),
               (7, -20, 0), (8, -8, -8), (9, 8, -8), (10, 8, 8), (11, -8, 8)) AS b(n, x, y) ON a.next_n = b.n
),
places AS (
  SELECT start_lat AS lat, start_lon AS lon FROM point_trips UNION SELECT end_lat, end_lon FROM point_trips
),
held AS (
  SELECT lat, lon, zone FROM places JOIN edges ON (y1 > lat) <> (y2 > lat)
   AND lon < (x2 - x1) * (lat - y1) / (y2 - y1) + x1
  GROUP BY lat, lon, zone HAVING count(*) % 2 = 1
),
zoned AS (SELECT lat, lon, CAST(min(zone) AS VARCHAR) AS id FROM held GROUP BY lat, lon)"""

MALFORMED = f"""
WITH {TRIPS},
raw AS (SELECT mode, CAST(duration AS INTEGER) % 60 AS line FROM trips),
laid AS (
  SELECT *, CASE WHEN mode = 'bike' THEN mode WHEN line % 2 = 0 THEN concat(mode, '_zones')
                 ELSE concat(mode, '_points') END AS layout FROM raw
)
SELECT layout, mode, count(*) AS lines, count(*) FILTER (WHERE line IN (3, 4)) AS wrong_width,
       count(*) FILTER (WHERE mode = 'bike' AND line = 1) AS wrong_type
FROM laid GROUP BY layout, mode"""


def _from_located(select: str) -> str:
    return f"WITH {LOCATED} {select}"


def _time_cells(modes: str) -> str:
    return f"""
WITH {TRIPS}, {CELLS}
SELECT pickup, time_cell, split_part(time_cell, ' ', 1) AS "date",
       coalesce(nullif(split_part(time_cell, ' ', 2), ''), '-1') AS "hour", count(*) AS trips
FROM celled WHERE mode IN ({modes}) GROUP BY pickup, time_cell"""


def _mode_table(mode: str, columns: str, part: str) -> str:
    return _from_located(
        f"SELECT {columns} FROM located WHERE mode = '{mode}' GROUP BY {GROUP} HAVING {part} > 0"
    )


ORACLE: dict[str, str] = {
    "multimodal_profile": f"{_profiles()} SELECT * FROM profile",
    "multimodal_profile_inner": f"""{_profiles()}
SELECT * FROM bike JOIN yellow USING ({KEYS}) JOIN green USING ({KEYS})""",
    "multimodal_profile_all_cells": f"{_profiles(all_cells=True)} SELECT * FROM profile",
    "multimodal_profile_padded": f"{_profiles(located=PADDED)} SELECT * FROM profile",
    "multimodal_profile_merged": f"{_profiles()} SELECT * FROM profile",
    "multimodal_profile_joined": f"{_profiles()} SELECT * FROM profile",
    "bike_time_cells": _time_cells("'bike'"),
    "taxi_time_cells": _time_cells("'yellow', 'green'"),
    "zip_lookup": f"""
WITH {TRIPS}, {LOOKUPS}
SELECT start_id, coalesce(s.zip, '00000') AS start_zip, end_id,
       coalesce(e.zip, '00000') AS end_zip, count(*) AS trips
FROM trips t LEFT JOIN start_lookup s ON start_id = s.id LEFT JOIN end_lookup e ON end_id = e.id
GROUP BY ALL""",
    "multimodal_profile_bad_distances": f"{_profiles(located=BAD_LOCATED)} SELECT * FROM profile",
    "raw_layout_trips": f"""
WITH {TRIPS},
raw AS (SELECT *, CAST(duration AS INTEGER) % 60 AS second FROM trips)
SELECT mode, pickup, CASE WHEN mode = 'bike' OR second % 2 = 0 THEN start_id END AS start_id,
       CASE WHEN mode = 'bike' OR second % 2 = 0 THEN end_id END AS end_id,
       CASE WHEN mode = 'bike' THEN duration END AS duration,
       CASE WHEN mode <> 'bike' THEN distance END AS distance,
       CASE WHEN mode = 'bike' THEN usertype END AS usertype,
       CASE WHEN mode <> 'bike' THEN payment_type END AS payment_type,
       CASE WHEN mode = 'green' THEN trip_type END AS trip_type, count(*) AS trips
FROM raw WHERE NOT (mode = 'bike' AND second = 1) GROUP BY ALL""",
    "taxi_distance_clean": f"""
WITH {TRIPS}
SELECT mode, distance AS distance_text, count(*) AS trips, CAST(distance AS DOUBLE) AS trip_distance
FROM trips WHERE mode <> 'bike' AND distance <> '.00' GROUP BY mode, distance""",
    "dropped_trips": f"""
WITH {BAD_TRIPS}
SELECT mode, count(*) AS trips, count(*) FILTER (WHERE pickup IS NULL) AS no_time,
       count(*) FILTER (WHERE mode <> 'bike' AND distance IS NULL) AS no_distance,
       count(*) FILTER (WHERE mode <> 'bike' AND distance = '.00') AS zero_distance,
       count(*) FILTER (WHERE mode <> 'bike' AND distance IS NOT NULL
                          AND try_cast(distance AS DOUBLE) IS NULL) AS bad_distance
FROM trips GROUP BY mode""",
    "trips_per_cell": _from_located(
        f"SELECT mode, {KEYS}, count(*) AS trip_count FROM located GROUP BY mode, {GROUP}"
    ),
    "subscriber_share": _from_located(f"""
SELECT {KEYS}, count(*) AS trip_count, {SUBSCRIBERS} AS sub_count,
       {SUBSCRIBERS} / count(*) AS sub_percent
FROM located WHERE mode = 'bike' GROUP BY {GROUP} HAVING {SUBSCRIBERS} > 0"""),
    "card_share": _from_located(f"""
SELECT mode, {KEYS}, count(*) AS trip_count, {CARDS} AS cc_count, {CARDS} / count(*) AS cc_percent
FROM located WHERE mode <> 'bike' GROUP BY mode, {GROUP} HAVING {CARDS} > 0"""),
    "dispatch_share": _from_located(f"""
SELECT {KEYS}, count(*) AS trip_count, {DISPATCHED} AS dispatch_count,
       {DISPATCHED} / count(*) AS dispatch_percent
FROM located WHERE mode = 'green' GROUP BY {GROUP}"""),
    "dispatch_share_literal": _from_located(f"""
SELECT {KEYS}, count(*) AS trip_count, count(*) AS dispatch_count,
       count(*) / count(*) AS dispatch_percent
FROM located WHERE mode = 'green' GROUP BY {GROUP}"""),
    "mean_duration_minutes": _from_located(f"""
SELECT {KEYS}, {MINUTES} AS bike_duration FROM located WHERE mode = 'bike' GROUP BY {GROUP}"""),
    "mean_trip_distance": _from_located(f"""
SELECT mode, {KEYS}, avg(miles) AS trip_distance_avg
FROM located WHERE mode <> 'bike' GROUP BY mode, {GROUP}"""),
    "bike_profile": _from_located(_bike()),
    "bike_profile_all_cells": _from_located(_bike("")),
    "yellow_profile": _from_located(_taxi("yellow")),
    "green_profile": _from_located(_taxi("green")),
    "citi_table": _mode_table(
        "bike",
        f'time_cell AS starttime, start_zip AS "start station id", end_zip AS "end station id", '
        f'count(*) AS "count", {SUBSCRIBERS} AS sub_count, {SUBSCRIBERS} / count(*) AS sub_percent, '
        f'"hour", "date", {MINUTES} AS "avg(tripduration)"',
        SUBSCRIBERS,
    ),
    "yellow_table": _mode_table(
        "yellow",
        f'time_cell AS tpep_pickup_datetime, start_zip AS "PULocationID", end_zip AS "DOLocationID", '
        f'count(*) AS yellow_count, {CARDS} / count(*) AS yellow_cc_percent, "hour", "date", '
        f'avg(miles) AS yellow_avg_dist',
        CARDS,
    ),
    "green_table": _mode_table(
        "green",
        f'time_cell AS lpep_pickup_datetime, start_zip AS "PULocationID", end_zip AS "DOLocationID", '
        f'count(*) AS green_count, {CARDS} / count(*) AS green_cc_percent, "hour", "date", '
        f'avg(miles) AS green_avg_dist, {DISPATCHED} AS dispatch_count, '
        f'{DISPATCHED} / count(*) AS dispatch_percent',
        CARDS,
    ),
    "destinations_from_zip": f"{_profiles(all_cells=True)} {DESTINATIONS}",
    "golden_counts": f'WITH {ZERO_LOCATED}, {GOLDEN} SELECT key, "count" FROM golden',
    "audit_clean": f"WITH {LOCATED}, {GOLDEN} {_delta('counted', 'golden')}",
    "audit_altered": f"""
WITH {LOCATED}, {GOLDEN},
altered AS (
  SELECT key, "count" + CASE WHEN substr(key, 1, 5) = '10001' THEN 1 ELSE 0 END AS "count"
  FROM golden WHERE substr(key, 1, 5) <> '10002'
)
SELECT * FROM ({_delta('counted', 'altered')}) WHERE delta <> 0""",
    "audit_hour": f"""
WITH {LOCATED}, {GOLDEN},
hour_counted AS (SELECT * FROM counted WHERE "date" = '1997-03-01' AND "hour" = '01'),
hour_golden AS (SELECT * FROM golden WHERE substr(key, 11) = '1997-03-0101')
{_delta('hour_counted', 'hour_golden')}""",
    "refresh_lookup": f"""
WITH {KNOWN},
new AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS id, {_grid('s_suppkey', 37, 91)}
  FROM supplier
  WHERE s_suppkey % 13 <> 0 AND CAST(s_suppkey AS VARCHAR) NOT IN (SELECT id FROM known)
)
SELECT id, lat, lon, zip FROM known
UNION ALL
SELECT id, lat, lon, zip FROM ({_nearest('new', 'id, lat, lon')})""",
    "zone_centroids": f"WITH {CENTROIDS} SELECT zone, lat, lon, vertices FROM centroids",
    "zone_lookup": f"""
WITH {CENTROIDS}, {KNOWN},
points AS (SELECT CAST(zone AS VARCHAR) AS id, lat, lon FROM centroids)
{_nearest('points', 'id, lat, lon')}""",
    "nearest_zip": f"""
WITH {KNOWN},
points AS (SELECT CAST(c_custkey AS VARCHAR) AS id, {_grid('c_custkey', 53, 29)} FROM customer)
{_nearest('points', 'id, lat, lon')}""",
}

ORACLE |= {
    "raw_files_trips": ORACLE["raw_layout_trips"].replace(
        "WHERE NOT (mode = 'bike' AND second = 1)",
        "WHERE second NOT IN (3, 4) AND NOT (mode = 'bike' AND second = 1)",
    ),
    "malformed_lines": MALFORMED,
    "point_trips_zip": f"""
WITH {POINTS}
SELECT mode, p.id AS start_id, coalesce(s.zip, '00000') AS start_zip, d.id AS end_id,
       coalesce(e.zip, '00000') AS end_zip, count(*) AS trips
FROM point_trips t
LEFT JOIN zoned p ON start_lat = p.lat AND start_lon = p.lon
LEFT JOIN zoned d ON end_lat = d.lat AND end_lon = d.lon
LEFT JOIN start_lookup s ON p.id = s.id LEFT JOIN start_lookup e ON d.id = e.id
GROUP BY ALL""",
    "stored_slices": f"""
{_profiles()},
wanted AS (
  SELECT concat(r_regionkey + 1993, '-0', r_regionkey + 2, '-01') AS "date",
         lpad(CAST(r_regionkey + 1 AS VARCHAR), 2, '0') AS "hour"
  FROM region WHERE r_regionkey < 4
)
SELECT p.* FROM profile p SEMI JOIN wanted w ON p."date" = w."date" AND p."hour" = w."hour"
""",
    "rewritten_dates": f"""
WITH {LOCATED.replace("located AS (", "every AS (")},
located AS (
  SELECT * FROM every
  WHERE "date" BETWEEN '1997-01-01' AND '1997-12-31' OR CAST(duration AS INTEGER) % 60 <> 7
)
{_bike("")}""",
    "key_ranges": """
WITH ranges AS (
  SELECT n_nationkey AS zone, n_nationkey * n_nationkey * 7 AS lo,
         CASE WHEN n_nationkey % 2 = 0 THEN n_nationkey * n_nationkey * 7 + 300 ELSE 1000000007 - n_nationkey END AS hi
  FROM nation
)
SELECT zone, count(*) AS orders, min(o_orderkey) AS "first", max(o_orderkey) AS "last"
FROM orders JOIN ranges ON o_orderkey >= lo AND o_orderkey < hi GROUP BY zone""",
}

# The same results by another way.
for _name in ("citi", "yellow", "green"):
    ORACLE[f"stored_{_name}_table"] = ORACLE[f"{_name}_table"]
ORACLE["point_trips_zip_shuffled"] = ORACLE["point_trips_zip"]
ORACLE["profile_from_states"] = ORACLE["multimodal_profile"]
ORACLE["audit_by_digest"] = ORACLE["audit_altered"]
for _name in ("refresh_lookup", "zone_lookup", "nearest_zip"):
    ORACLE[f"{_name}_descent"] = ORACLE[_name]
ORACLE["zip_lookup_shuffled"] = ORACLE["zip_lookup"]
