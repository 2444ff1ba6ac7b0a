"""DuckDB SQL for the feed queries."""

_PUBLISHED = """WITH published AS (
  SELECT event_type AS topic, cast((row_number() OVER (ORDER BY event_id) - 1) % 2 AS integer) AS partition,
         to_json(struct_pack(event_id := event_id, ts := cast(ts AS varchar), user_id := user_id,
                             event_type := event_type, value := value, props := props))::varchar AS value
  FROM events)
"""

SQL = {
    "feed_to_messages": _PUBLISHED + "SELECT topic, partition, value FROM published",
    "partition_slice": _PUBLISHED + "SELECT topic, partition, value FROM published WHERE partition = 0",
    "route_counts": _PUBLISHED + "SELECT topic, partition, count(*) AS records FROM published GROUP BY 1, 2",
    "malformed_split": """SELECT topic, cast(count(*) FILTER (WHERE event_id % 97 <> 0) AS bigint) AS good,
           cast(count(*) FILTER (WHERE event_id % 97 = 0) AS bigint) AS bad
           FROM events CROSS JOIN (VALUES ('AIR'), ('EARTH'), ('WATER')) t(topic) GROUP BY 1""",
    "malformed_rows": "SELECT event_id, event_id % 8 <= 5 AS malformed FROM events",
    "feed_blank_cells": "SELECT event_id, event_id % 5 = 0 AS blank, CASE WHEN event_id % 5 <> 0 THEN value END AS value FROM events",
    "consume_roundtrip": """SELECT CASE WHEN event_id % 97 = 0 THEN 'bad' ELSE 'good' END AS kind, cast(0 AS integer) AS partition,
           CASE WHEN event_id % 97 <> 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S.%f') END AS "Time",
           CASE WHEN event_id % 97 <> 0 THEN 'ST' || cast(user_id % 3 AS varchar) END AS "Station",
           CASE WHEN event_id % 97 <> 0 THEN value / 20 END AS "pH" FROM events WHERE event_id % 2 = 0""",
    "feed_stream_messages": _PUBLISHED + "SELECT topic, partition, value FROM published",
    "offset_gaps": """SELECT topic, partition, prev + 1 AS first_missing, o - 1 AS last_missing, o - prev - 1 AS missing FROM (
           SELECT event_type AS topic, cast(user_id % 2 AS integer) AS partition, event_id AS o,
                  lag(event_id) OVER (PARTITION BY event_type, user_id % 2 ORDER BY event_id) AS prev FROM events) WHERE o - prev > 1""",
    "overwrite_twice": "SELECT event_id, event_type AS topic, cast((event_id + 1) % 2 AS integer) AS partition FROM events",
    "feed_file_positions": "SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS position FROM events",
    "reject_reasons": """SELECT CASE event_id % 8 WHEN 0 THEN 'trailing text' WHEN 1 THEN 'malformed' WHEN 2 THEN 'blank' WHEN 3 THEN 'trailing text'
           WHEN 4 THEN 'cut off' WHEN 5 THEN 'missing' WHEN 6 THEN 'not an object' END AS reason, count(*) AS records FROM events GROUP BY 1""",
    "replay_once": """SELECT topic, cast(event_id % 2 AS integer) AS partition, event_id AS "offset", strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS time
           FROM events CROSS JOIN (VALUES ('AIR'), ('EARTH'), ('WATER')) t(topic)""",
}
