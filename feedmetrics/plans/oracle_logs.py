"""DuckDB SQL for the application-A queries (same column names as the Spark results)."""

LOGS_CTE = """
logs AS (
  SELECT event_id AS line_id, concat_ws(' ',
    cast(value AS varchar),
    '10.0.0.' || cast(user_id AS varchar),
    CASE event_type WHEN 'view' THEN 'TCP_HIT' WHEN 'click' THEN 'TCP_HIT1'
         WHEN 'purchase' THEN 'TCP_MISS' WHEN 'signup' THEN 'EXPIRED' ELSE '-' END,
    '[' || strftime(ts, '%d/%b/%Y:%H:%M:%S'),
    '+0700]',
    '/v/' || cast(event_id % 50 AS varchar) ||
      CASE event_id % 5 WHEN 0 THEN '.mpd' WHEN 1 THEN '.m3u8' WHEN 2 THEN '.dash' WHEN 3 THEN '.ts' ELSE '.html' END,
    CASE WHEN event_id % 17 = 0 THEN NULL WHEN event_id % 11 = 0 THEN '0' WHEN event_id % 13 = 0 THEN 'abc'
         ELSE cast((event_id * 37) % 100000 AS varchar) END) AS line
  FROM events),
toks AS (SELECT line_id, line, string_split(regexp_replace(line, ' +$', ''), ' ') AS f FROM logs),
parsed AS (
  SELECT line_id, line, cast(len(f) AS integer) AS n_fields, try_cast(f[1] AS double) AS latency, f[2] AS ip,
         f[3] AS hit_status, f[4] || ' ' || f[5] AS time_text, f[5] AS zone, f[6] AS content,
         CASE WHEN regexp_full_match(f[7], '[0-9]+') THEN try_cast(f[7] AS bigint) END AS size
  FROM toks),
flagged AS (
  SELECT *, coalesce(n_fields = 7 AND latency >= 0 AND NOT isnan(latency) AND size > 0 AND hit_status <> '-', false) AS ok,
         epoch_ms(try_strptime(time_text, '[%d/%b/%Y:%H:%M:%S %z]')) AS ts_ms
  FROM parsed),
valid AS (SELECT * FROM flagged WHERE ok),
invalid AS (SELECT * FROM flagged WHERE NOT ok),
dict AS (
  SELECT '10.0.0.' || cast(s_suppkey AS varchar) AS ip, r_name AS region, n_name AS city,
         'ISP_' || cast(s_suppkey % 7 AS varchar) AS isp
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
enriched AS (
  SELECT v.line_id, v.ip,
         CASE WHEN d.ip IS NULL THEN 'Unknown' ELSE d.region END AS region,
         CASE WHEN d.ip IS NULL THEN 'Unknown' ELSE d.city END AS city,
         CASE WHEN d.ip IS NULL THEN 'Unknown' ELSE d.isp END AS isp,
         v.latency, v.zone, v.size,
         CASE WHEN ends_with(v.hit_status, 'HIT') THEN 'HIT' WHEN ends_with(v.hit_status, 'HIT1') THEN 'HIT1'
              ELSE 'MISS' END AS cache_status
  FROM valid v LEFT JOIN dict d ON v.ip = d.ip),
isp_counts AS (
  SELECT isp, cast(count(*) FILTER (WHERE cache_status = 'HIT') AS bigint) AS hit,
         cast(count(*) FILTER (WHERE cache_status = 'HIT1') AS bigint) AS hit1,
         cast(count(*) FILTER (WHERE cache_status = 'MISS') AS bigint) AS miss
  FROM enriched GROUP BY isp),
isp_rates AS (
  SELECT *, CASE WHEN hit + hit1 + miss = 0 THEN NULL
                 ELSE cast(hit + hit1 AS double) / cast(hit + hit1 + miss AS double) END AS rate
  FROM isp_counts)
"""


def _w(body: str) -> str:
    return "WITH " + LOGS_CTE.strip() + "\n" + body


DICT_UPDATES = """
WITH base AS (
  SELECT '10.0.0.' || cast(s_suppkey AS varchar) AS ip, r_name AS region, n_name AS city,
         'ISP_' || cast(s_suppkey % 7 AS varchar) AS isp, s_suppkey
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
lines AS (
  SELECT ip, region, city, isp, 0 AS batch, s_suppkey AS line FROM base
  UNION ALL
  SELECT ip, region, city || '_B', 'ISP_' || cast((s_suppkey + 3) % 7 AS varchar), 1, s_suppkey FROM base WHERE s_suppkey % 4 = 0
  UNION ALL
  SELECT ip, region, NULL, NULL, 2, s_suppkey FROM base WHERE s_suppkey % 9 = 0),
last AS (
  SELECT ip, region, city, isp FROM (
    SELECT *, row_number() OVER (PARTITION BY ip ORDER BY batch DESC, line DESC) AS rn FROM lines) WHERE rn = 1)
"""

SQL = {
    "log_fields": _w("SELECT line_id, n_fields, latency, ip, hit_status, zone, content, size FROM flagged"),
    "log_time": _w("SELECT line_id, ts_ms FROM flagged"),
    "log_valid": _w("SELECT count(*) AS records FROM valid"),
    "log_invalid": _w("SELECT count(*) AS records FROM invalid"),
    "log_first10": _w("SELECT line_id, ts_ms, line FROM valid ORDER BY ts_ms NULLS LAST, line_id LIMIT 10"),
    "bad_first10": _w("SELECT line_id, ts_ms, line FROM invalid ORDER BY ts_ms NULLS LAST, line_id LIMIT 10"),
    "service_counts": _w("""SELECT CASE WHEN ends_with(content, '.mpd') OR ends_with(content, '.m3u8') THEN 'HLS'
            WHEN ends_with(content, '.dash') OR ends_with(content, '.ts') THEN 'MPEG-DASH'
            ELSE 'Web Service' END AS service, count(*) AS records FROM valid GROUP BY 1"""),
    "unique_clients": _w("SELECT count(DISTINCT ip) AS unique_clients FROM valid"),
    "log_enriched": _w("SELECT * FROM enriched"),
    "dictionary_file_lookup": _w("SELECT * FROM enriched"),
    "log_overview": _w("""SELECT count(*) AS lines,
            count(*) FILTER (WHERE ok) AS valid, count(*) FILTER (WHERE NOT ok) AS invalid,
            count(*) FILTER (WHERE ok AND (ends_with(content, '.mpd') OR ends_with(content, '.m3u8'))) AS hls,
            count(*) FILTER (WHERE ok AND NOT (ends_with(content, '.mpd') OR ends_with(content, '.m3u8'))
                             AND (ends_with(content, '.dash') OR ends_with(content, '.ts'))) AS mpeg_dash,
            count(*) FILTER (WHERE ok AND NOT (ends_with(content, '.mpd') OR ends_with(content, '.m3u8')
                             OR ends_with(content, '.dash') OR ends_with(content, '.ts'))) AS web_service,
            count(*) FILTER (WHERE ok AND ends_with(hit_status, 'HIT')) AS hit,
            count(*) FILTER (WHERE ok AND NOT ends_with(hit_status, 'HIT') AND ends_with(hit_status, 'HIT1')) AS hit1,
            count(*) FILTER (WHERE ok AND NOT ends_with(hit_status, 'HIT') AND NOT ends_with(hit_status, 'HIT1')) AS miss,
            round(avg(latency) FILTER (WHERE ok), 6) AS latency_mean,
            max(latency) FILTER (WHERE ok) AS latency_max, min(latency) FILTER (WHERE ok) AS latency_min,
            cast(sum(size) FILTER (WHERE ok) AS bigint) AS traffic,
            count(DISTINCT ip) FILTER (WHERE ok) AS unique_clients
            FROM flagged"""),
    "dictionary_lookup": _w("SELECT line_id, ip, region, city, isp FROM enriched"),
    "dictionary_lookup_shuffled": _w("SELECT line_id, ip, region, city, isp FROM enriched"),
    "providers": _w("SELECT DISTINCT isp FROM enriched"),
    "provider_count": _w("SELECT count(*) AS providers FROM (SELECT DISTINCT isp FROM enriched)"),
    "city_count": _w("SELECT count(*) AS records FROM enriched WHERE city = 'NATION_3'"),
    "city_traffic": _w("SELECT cast(sum(size) AS bigint) AS traffic FROM enriched WHERE city = 'NATION_7'"),
    "latency_summary": _w("""SELECT round(avg(latency), 6) AS latency_mean, max(latency) AS latency_max,
            min(latency) AS latency_min FROM enriched"""),
    "latency_median_bucketed": _w("""SELECT latency AS latency_median FROM (
              SELECT latency, row_number() OVER (ORDER BY latency) AS rn, count(*) OVER () AS n
              FROM enriched WHERE latency IS NOT NULL) WHERE rn = (n + 1) // 2"""),
    "log_file_roundtrip": _w("SELECT n_fields, latency, ip, hit_status, content, size FROM parsed"),
    "latency_median_sketched": _w("""SELECT latency AS latency_median FROM (
              SELECT latency, row_number() OVER (ORDER BY latency) AS rn, count(*) OVER () AS n
              FROM enriched WHERE latency IS NOT NULL) WHERE rn = (n + 1) // 2"""),
    "unique_clients_sketched": _w("SELECT count(DISTINCT ip) AS unique_clients, true AS within_error, true AS merge_is_direct FROM valid"),
    "latency_median": _w("""SELECT latency AS latency_median FROM (
              SELECT latency, row_number() OVER (ORDER BY latency) AS rn, count(*) OVER () AS n
              FROM enriched WHERE latency IS NOT NULL) WHERE rn = (n + 1) // 2"""),
    "latency_top2": _w("""SELECT cast(row_number() OVER (ORDER BY latency DESC) AS integer) AS rank, latency FROM (
              SELECT latency FROM enriched WHERE latency IS NOT NULL ORDER BY latency DESC LIMIT 2)"""),
    "cache_counts": _w("""SELECT cast(count(*) FILTER (WHERE cache_status = 'HIT') AS bigint) AS hit,
            cast(count(*) FILTER (WHERE cache_status = 'HIT1') AS bigint) AS hit1,
            cast(count(*) FILTER (WHERE cache_status = 'MISS') AS bigint) AS miss FROM enriched"""),
    "cache_hit_rate": _w("""SELECT CASE WHEN count(*) = 0 THEN NULL ELSE
            cast(count(*) FILTER (WHERE cache_status <> 'MISS') AS double) / cast(count(*) AS double) END AS hit_rate
            FROM enriched"""),
    "isp_cache": _w("SELECT isp, hit, hit1, miss, rate FROM isp_rates"),
    "best_isp": _w("SELECT isp, rate FROM isp_rates WHERE rate = (SELECT max(rate) FROM isp_rates)"),
    "dictionary_last_wins": DICT_UPDATES + """,
""" + LOGS_CTE.strip() + """
SELECT v.line_id, v.ip,
       CASE WHEN l.ip IS NULL THEN 'Unknown' ELSE l.region END AS region,
       CASE WHEN l.ip IS NULL THEN 'Unknown' ELSE l.city END AS city,
       CASE WHEN l.ip IS NULL THEN 'Unknown' ELSE l.isp END AS isp
FROM valid v LEFT JOIN last l ON v.ip = l.ip""",
}
