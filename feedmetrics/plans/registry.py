"""All registered queries and their DuckDB oracle SQL."""

from __future__ import annotations

from feedmetrics.plans import feeds, logs, oracle_feeds, oracle_logs, oracle_sensors, sensors

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def queries():
    q = {}
    q.update(logs.QUERIES)
    q.update(sensors.QUERIES)
    q.update(feeds.QUERIES)
    return q


def oracle_sql():
    s = {}
    s.update(oracle_logs.SQL)
    s.update(oracle_sensors.SQL)
    s.update(oracle_feeds.SQL)
    return s
