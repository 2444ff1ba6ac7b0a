"""The sensor application as one set of streaming queries.

Per topic: parse the payloads and keep running means (complete mode, rewritten table);
across topics: align on time and store the nested documents (append, JSON files). Console
previews of the parsed and aligned rows are opt-in. Every durable query has its own
checkpoint under ``checkpoint_root``.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from feedmetrics.operators import sensors
from feedmetrics.streaming import EVERY_MINUTE, start_sink


def start_environment_queries(topics: Mapping[str, DataFrame], out_root: str, checkpoint_root: str,
                              trigger: dict | None = None, watermark: str | None = None,
                              console: bool = False, numeric_strings: str = "coerce",
                              means_kind: str = "table") -> dict[str, StreamingQuery]:
    """``topics``: ``{"AIR": messages, "EARTH": ..., "WATER": ...}`` streaming DataFrames in the
    Kafka column layout. Returns the started queries by name; wait with ``run_all``.

    Outputs: ``{out_root}/means_<topic>`` (parquet, one row; with ``means_kind="memory"`` a
    driver-memory table ``stats_table_<topic>`` instead) and ``{out_root}/documents`` (JSON
    lines ``{"value": ...}``, readable with ``read_documents``)."""
    trig = trigger or EVERY_MINUTE
    parsed = {t: sensors.parse_envelope(df, sensors.SCHEMAS[t], numeric_strings) for t, df in topics.items()}
    started: dict[str, StreamingQuery] = {}
    try:
        for t, df in parsed.items():
            name = t.lower()
            means = sensors.running_means(df, sensors.MEAN_COLUMNS[t])
            if means_kind == "memory":
                started[f"means_{name}"] = start_sink(means, "memory", name=f"stats_table_{name}", trigger=trig,
                                                      output_mode="complete")
            else:
                started[f"means_{name}"] = start_sink(
                    means, "table", path=f"{out_root}/means_{name}", checkpoint=f"{checkpoint_root}/means_{name}",
                    trigger=trig, output_mode="complete")
            if console:
                started[f"preview_{name}"] = start_sink(df, "console", trigger=trig)
        aligned = sensors.align_streams([(t.lower(), parsed[t]) for t in ("AIR", "EARTH", "WATER")],
                                        on=["Time"], watermark=watermark)
        if console:
            started["preview_aligned"] = start_sink(aligned, "console", trigger=trig)
        started["documents"] = start_sink(
            sensors.build_document(aligned), "json", path=f"{out_root}/documents",
            checkpoint=f"{checkpoint_root}/documents", trigger=trig)
    except Exception:
        for q in started.values():
            q.stop()
        raise
    return started
