"""Batch readers. Every reader takes an explicit schema: no inference pass over the data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

DICTIONARY_SCHEMA = "ip string, region string, city string, isp string"

# Layouts of the driver tables the queries read. Declaring them skips the
# footer read that schema inference does on every ``spark.read.parquet``.
TABLE_SCHEMAS = {
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "region": "r_regionkey INT, r_name STRING",
    "lineitem": ("l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
                 "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, "
                 "l_linestatus STRING, l_shipdate TIMESTAMP_NTZ"),
}
DOCUMENT_SCHEMA = "value string"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's parquet tables (``{sf_dir}/{name}.parquet``)."""
    reader = spark.read.schema(TABLE_SCHEMAS[name]) if name in TABLE_SCHEMAS else spark.read
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_log_lines(spark: SparkSession, path: str) -> DataFrame:
    """Access-log text, one row per line, column ``value``."""
    return spark.read.text(path)


def read_dictionary(spark: SparkSession, path: str, schema: str | StructType = DICTIONARY_SCHEMA) -> DataFrame:
    """Comma-separated dictionary without header: key then attributes.

    Lines with fewer fields give NULL attributes (they are kept, not dropped)."""
    return spark.read.schema(schema).option("header", False).option("mode", "PERMISSIVE").csv(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """JSON-lines documents written by the document sink: ``{"value": "<json text>"}``.

    Reads the directory (not a ``*.json`` glob), so a streaming sink's commit log decides
    which files are visible."""
    return spark.read.schema(DOCUMENT_SCHEMA).json(path)


def read_feed(spark: SparkSession, path: str, schema: str | StructType, header: bool = True) -> DataFrame:
    """CSV feed with a header line, read with an explicit schema."""
    return spark.read.schema(schema).option("header", header).csv(path)
