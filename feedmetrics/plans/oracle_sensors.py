"""DuckDB SQL for the sensor queries. The topic readings are computed straight from
``events`` (the JSON round trip is the identity for well-formed messages); malformed
messages (every 97th event) are rows of NULLs."""

from feedmetrics.operators.sensors import SCHEMAS, MEAN_COLUMNS, safe_name

_MEASURES = {
    "AIR": {"Temperature": "value", "Moisture": "kd", "Light": "value * 10", "Total_Rainfall": "kd / 10",
            "Rainfall": "value / 10", "Wind_Direction": "k * 3", "PM2.5": "value / 2", "PM10": "value",
            "CO": "kd / 100", "NOx": "value / 5", "SO2": "kd / 50"},
    "EARTH": {"Moisture": "kd", "Temperature": "value", "Salinity": "kd / 10", "pH": "value / 20",
              "Water_Root": "value * 2", "Water_Leaf": "kd * 2", "Water_Level": "value + kd", "Voltage": "kd / 20"},
    "WATER": {"pH": "value / 20", "DO": "kd / 10", "Temperature": "value", "Salinity": "kd / 100"},
}
_SQLTYPE = {"string": "varchar", "double": "double", "int": "integer"}

EV = """ev AS (
  SELECT event_id, event_type, value,
         try_cast(json_extract_string(props, '$.k') AS integer) AS k,
         cast(try_cast(json_extract_string(props, '$.k') AS integer) AS double) AS kd,
         strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS t10,
         'ST' || cast(user_id % 3 AS varchar) AS st
  FROM events)"""


def topic_cte(topic: str) -> str:
    name = topic.lower()
    good, bad = [], []
    for f in SCHEMAS[topic].fields:
        expr = {"Time": "t10", "Station": "st"}.get(f.name, _MEASURES[topic].get(f.name))
        typ = _SQLTYPE[f.dataType.simpleString()]
        good.append(f'cast({expr} AS {typ}) AS "{f.name}"')
        bad.append(f'cast(NULL AS {typ}) AS "{f.name}"')
    return (f"{name} AS (\n  SELECT {', '.join(good)} FROM ev WHERE event_id % 97 <> 0\n"
            f"  UNION ALL\n  SELECT {', '.join(bad)} FROM ev WHERE event_id % 97 = 0)")


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


ALL_TOPICS = _with(EV, topic_cte("AIR"), topic_cte("EARTH"), topic_cte("WATER"))


def _aligned_select() -> str:
    cols = ['a."Time" AS "Time"']
    for topic, alias, tab in (("AIR", "air", "a"), ("EARTH", "earth", "e"), ("WATER", "water", "w")):
        for f in SCHEMAS[topic].fields:
            if f.name != "Time":
                cols.append(f'{tab}."{f.name}" AS "{alias}_{safe_name(f.name)}"')
    return ("SELECT " + ", ".join(cols) +
            '\nFROM air a JOIN earth e ON a."Time" = e."Time" JOIN water w ON a."Time" = w."Time"')


ALIGNED = ALL_TOPICS.rstrip("\n") + ",\naligned AS (" + _aligned_select() + """),
report_input AS (SELECT "Time", air_Temperature AS Air_Temperature, air_Moisture AS Air_Moisture,
                        earth_pH AS Earth_pH FROM aligned),
flags AS (
  SELECT *,
    CASE WHEN Air_Temperature < 23.0 OR Air_Temperature > 28.0 THEN 1 ELSE 0 END AS Air_Temperature_Out,
    CASE WHEN Air_Moisture < 60.0 OR Air_Moisture > 80.0 THEN 1 ELSE 0 END AS Air_Moisture_Out,
    CASE WHEN Earth_pH < 5.5 OR Earth_pH > 7.0 THEN 1 ELSE 0 END AS Earth_pH_Out
  FROM report_input),
stats AS (
  SELECT cast(count(*) FILTER (WHERE Air_Temperature_Out + Air_Moisture_Out + Earth_pH_Out >= 1) AS bigint) AS n,
         max(Air_Temperature) AS Max_Air_Temperature, min(Air_Temperature) AS Min_Air_Temperature,
         max(Air_Moisture) AS Max_Air_Moisture, min(Air_Moisture) AS Min_Air_Moisture,
         max(Earth_pH) AS Max_Earth_pH, min(Earth_pH) AS Min_Earth_pH
  FROM flags)
"""


def _mean(c: str) -> str:
    """Whole parts and 32-bit limbs of the fractions summed as whole numbers, put together at the end."""
    x, limbs = f'"{c}"', []
    rest = f"({x} - floor({x}))"
    for _ in range(3):
        limbs.append(f"sum(cast(floor({rest} * 4294967296.0) AS hugeint))")
        rest = f"({rest} * 4294967296.0 - floor({rest} * 4294967296.0))"
    total = "0.0"
    for limb in reversed(limbs):
        total = f"(({total} + cast({limb} AS double)) / 4294967296.0)"
    return f'(cast(sum(cast(floor({x}) AS hugeint)) AS double) + {total}) / cast(count({x}) AS double) AS "{safe_name(c)}_mean"'


def _means(topic: str) -> str:
    cols = ", ".join(_mean(c) for c in MEAN_COLUMNS[topic])
    return _with(EV, topic_cte(topic)) + f"SELECT {cols} FROM {topic.lower()}"


def _txt(c: str) -> str:
    return f"coalesce(cast({c} AS varchar), 'None')"


_REPORT = ALIGNED + f"""SELECT line_no, line FROM (
  SELECT 1 AS line_no, 'Average Time Out of Ideal: ' || cast(n // 60 AS varchar) || ' hours ' ||
                       cast(n % 60 AS varchar) || ' minutes' AS line FROM stats
  UNION ALL SELECT 2, 'Max Air Temperature: ' || {_txt('Max_Air_Temperature')} || '°C' FROM stats
  UNION ALL SELECT 3, 'Min Air Temperature: ' || {_txt('Min_Air_Temperature')} || '°C' FROM stats
  UNION ALL SELECT 4, 'Max Air Moisture: ' || {_txt('Max_Air_Moisture')} || '%' FROM stats
  UNION ALL SELECT 5, 'Min Air Moisture: ' || {_txt('Min_Air_Moisture')} || '%' FROM stats
  UNION ALL SELECT 6, 'Max Earth pH: ' || {_txt('Max_Earth_pH')} FROM stats
  UNION ALL SELECT 7, 'Min Earth pH: ' || {_txt('Min_Earth_pH')} FROM stats)"""

_DOCS = ALIGNED + 'SELECT "Time", Air_Temperature, Air_Moisture, Earth_pH FROM report_input'

SQL = {
    "parse_air": ALL_TOPICS + "SELECT * FROM air",
    "parse_earth": ALL_TOPICS + "SELECT * FROM earth",
    "parse_water": ALL_TOPICS + "SELECT * FROM water",
    "align3": ALIGNED + "SELECT * FROM aligned",
    "doc_roundtrip": _DOCS,
    "range_flags": ALIGNED + "SELECT * FROM flags",
    "range_duration": ALIGNED + "SELECT n AS minutes_out_of_range, n // 60 AS hours, n % 60 AS minutes FROM stats",
    "range_minmax": ALIGNED + """SELECT Max_Air_Temperature, Min_Air_Temperature, Max_Air_Moisture, Min_Air_Moisture,
           Max_Earth_pH, Min_Earth_pH FROM stats""",
    "range_report": _REPORT,
    "report_roundtrip": f"SELECT line FROM ({_REPORT})",
    "range_duration_events": """SELECT n AS minutes_out_of_range, n // 60 AS hours, n % 60 AS minutes FROM (
           SELECT cast(count(*) FILTER (WHERE value < 5.0 OR value > 40.0) AS bigint) AS n FROM events)""",
    "range_stats_lineitem": """SELECT n AS minutes_out_of_range, n // 60 AS hours, n % 60 AS minutes,
           Max_l_quantity + 0.0 AS Max_l_quantity, Min_l_quantity + 0.0 AS Min_l_quantity,
           Max_l_discount + 0.0 AS Max_l_discount, Min_l_discount + 0.0 AS Min_l_discount FROM (
           SELECT cast(count(*) FILTER (WHERE (CASE WHEN l_quantity < 5.0 OR l_quantity > 40.0 THEN 1 ELSE 0 END) +
                                (CASE WHEN l_discount < 0.02 OR l_discount > 0.08 THEN 1 ELSE 0 END) >= 1) AS bigint) AS n,
                  max(l_quantity) AS Max_l_quantity, min(l_quantity) AS Min_l_quantity,
                  max(l_discount) AS Max_l_discount, min(l_discount) AS Min_l_discount FROM lineitem)""",
    "stream_means_air": _means("AIR"),
    "stream_means_earth": _means("EARTH"),
    "stream_means_water": _means("WATER"),
    "align3_stream": ALIGNED + "SELECT * FROM aligned",
    "doc_stream_roundtrip": _DOCS,
    "stream_reconciled": _DOCS,
    "payload_drift": """SELECT 'EARTH' AS topic, 'Battery' AS field, 'unknown' AS status, 'number' AS kind, count(*) AS records FROM events WHERE event_id % 97 <> 0
           UNION ALL SELECT 'AIR', 'Wind_Direction', 'changed', 'text', count(json_extract_string(props, '$.k')) FROM events WHERE event_id % 97 <> 0""",
    # Arrival: four files by the event's number; a file's limit is the latest time of the files before it, less an hour.
    "late_rows": """WITH a AS (SELECT event_id, event_id % 4 AS file, CASE WHEN event_id % 97 <> 0 THEN ts END AS t FROM events),
           l AS (SELECT b.file, max(a.t) - INTERVAL 1 HOUR AS lim FROM (SELECT DISTINCT file FROM a) b LEFT JOIN a ON a.file < b.file GROUP BY b.file)
           SELECT event_id, CASE WHEN t IS NULL THEN 'untimed' WHEN t <= lim THEN 'late' ELSE 'on_time' END AS kind FROM a JOIN l USING (file)""",
}
