"""Sensor topics: schemas, JSON payload parsing, time alignment and nested documents."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from feedmetrics.functions.columns import coerce_numeric, q
from feedmetrics.operators.stats import exact_means
from feedmetrics.session import stored_rows

_D, _I, _S = DoubleType(), IntegerType(), StringType()

# The three topic payload layouts, field names and order as published.
AIR_SCHEMA = StructType([StructField(n, t, True) for n, t in [
    ("Time", _S), ("Station", _S), ("Temperature", _D), ("Moisture", _D), ("Light", _D),
    ("Total_Rainfall", _D), ("Rainfall", _D), ("Wind_Direction", _I), ("PM2.5", _D), ("PM10", _D),
    ("CO", _D), ("NOx", _D), ("SO2", _D)]])
EARTH_SCHEMA = StructType([StructField(n, t, True) for n, t in [
    ("Time", _S), ("Station", _S), ("Moisture", _D), ("Temperature", _D), ("Salinity", _D), ("pH", _D),
    ("Water_Root", _D), ("Water_Leaf", _D), ("Water_Level", _D), ("Voltage", _D)]])
WATER_SCHEMA = StructType([StructField(n, t, True) for n, t in [
    ("Time", _S), ("Station", _S), ("pH", _D), ("DO", _D), ("Temperature", _D), ("Salinity", _D)]])
SCHEMAS = {"AIR": AIR_SCHEMA, "EARTH": EARTH_SCHEMA, "WATER": WATER_SCHEMA}

# The measures whose running mean is kept per topic (Wind_Direction is not).
MEAN_COLUMNS = {
    "AIR": ["Temperature", "Moisture", "Light", "Total_Rainfall", "Rainfall", "PM2.5", "PM10", "CO", "NOx", "SO2"],
    "EARTH": ["Moisture", "Temperature", "Salinity", "pH", "Water_Root", "Water_Leaf", "Water_Level", "Voltage"],
    "WATER": ["pH", "DO", "Temperature", "Salinity"],
}

# The stored document: Time, then one nested record per topic (all fields but Time).
DOCUMENT_PARTS = (("Air", "air", AIR_SCHEMA), ("Earth", "earth", EARTH_SCHEMA), ("Water", "water", WATER_SCHEMA))

# The part of the document the out-of-range report reads.
REPORT_DOCUMENT_SCHEMA = StructType([
    StructField("Time", _S),
    StructField("Air", StructType([StructField("Temperature", _D), StructField("Moisture", _D)])),
    StructField("Earth", StructType([StructField("pH", _D)])),
])
REPORT_FIELDS = {"Air_Temperature": "Air.Temperature", "Air_Moisture": "Air.Moisture", "Earth_pH": "Earth.pH"}

def safe_name(name: str) -> str:
    """Column-name form without dots: ``PM2.5`` -> ``PM2_5``."""
    return name.replace(".", "_")


def _as_text(schema: StructType) -> StructType:
    return StructType([StructField(f.name, StringType(), True) for f in schema.fields])


def parse_envelope(df: DataFrame, schema: StructType, numeric_strings: str = "coerce", col: str = "value",
                   keep: Sequence[str] = (), fields: Sequence[str] | None = None) -> DataFrame:
    """Payload (binary or text JSON) -> one column per schema field (or per name in ``fields``:
    only those are parsed; the generator below hides unused fields from column pruning).

    ``numeric_strings="coerce"``: every field is read as text and cast with ``try_cast``, so a
    number published as a string (``"120"``) is still a number. ``"null"``: the plain typed
    read, where such values become NULL. A wholly malformed payload gives a row of NULLs.
    """
    if fields is not None:
        schema = StructType([f for f in schema.fields if f.name in fields])
    text = F.col(col).cast("string")
    if numeric_strings == "null":
        parsed = F.from_json(text, schema).alias("_p")
        fields = [F.col("_p").getField(f.name).alias(f.name) for f in schema.fields]
    elif numeric_strings == "coerce":
        parsed = F.from_json(text, _as_text(schema)).alias("_p")
        fields = []
        for f in schema.fields:
            raw = F.col("_p").getField(f.name)
            fields.append((raw if isinstance(f.dataType, StringType) else coerce_numeric(raw, f.dataType)).alias(f.name))
    else:
        raise ValueError(f"numeric_strings must be 'coerce' or 'null', not {numeric_strings!r}")
    # One JSON parse per message: the typed row comes out of a generator over a one-element
    # array, so filters on its fields (e.g. a join's ``Time IS NOT NULL``) stay above it
    # instead of being pushed down as a second ``from_json``.
    tmp = df.select(*[F.col(k) for k in keep], parsed)
    return tmp.select(*[F.col(k) for k in keep], F.inline(F.array(F.struct(*fields))))


def prefixed(df: DataFrame, alias: str, on: Sequence[str]) -> DataFrame:
    """Rename every non-key column to ``<alias>_<name>`` (dots become underscores)."""
    return df.select(*[F.col(q(c)).alias(c if c in on else f"{alias}_{safe_name(c)}") for c in df.columns])


def align_streams(frames: Sequence[tuple[str, DataFrame]], on: Sequence[str] = ("Time",),
                  watermark: str | None = None, event_time: str = "event_time",
                  dedup: Sequence[str] | None = None, time_pattern: str | None = None) -> DataFrame:
    """Inner equi-join of several topic frames on ``on``; keys appear once, other columns as
    ``<alias>_<name>``.

    Joining on ``Time`` alone pairs every reading of one time with every other (as the
    reference does); ``on=("Time", "Station")`` or ``dedup`` narrows that. By default nothing is
    dropped. In a stream, ``watermark`` bounds the join state: the event time is read from
    ``Time`` (``time_pattern``, or any text that casts to a time) and joins too, so readings and
    state older than the watermark go; readings whose ``Time`` cannot be read are left out then
    (``untimed`` gives them). ``dedup`` keeps one reading per (key columns) per side, within the
    watermark in a stream.

    In a batch, each further join of three or more frames takes its key anew (a struct of the
    key columns), so that both its sides are exchanged for it and adaptive execution can split
    a hot time in every join, at the price of one more exchange per frame after the second.
    """
    on = list(on)
    prepared = []
    for alias, df in frames:
        d = df
        if watermark:
            d = d.withColumn(event_time, read_time(time_pattern)).where(F.col(event_time).isNotNull())
            d = d.withWatermark(event_time, watermark)
            if dedup:
                d = d.dropDuplicatesWithinWatermark(list(dedup))
        elif dedup:
            d = d.dropDuplicates(list(dedup))
        keys = on + ([event_time] if watermark else [])
        prepared.append((prefixed(d, alias, keys), keys))
    out, keys = prepared[0]
    for i, (d, _) in enumerate(prepared[1:]):
        if i == 0 or out.isStreaming:
            out = out.join(d, on=keys, how="inner")
        else:
            key = F.struct(*[F.col(q(k)) for k in keys])
            known = d.select(key.alias("_key"), *[F.col(q(c)) for c in d.columns if c not in keys])
            # A struct of nulls would equal another one; a null key matches nothing.
            some = [F.col(q(k)).isNotNull() for k in keys]
            out = out.where(reduce(and_, some)).withColumn("_key", key).join(known, on="_key", how="inner").drop("_key")
    return out.drop(event_time) if watermark else out


def read_time(pattern: str | None = None) -> Column:
    """The time in ``Time``, NULL where the text is none."""
    return F.try_to_timestamp(F.col("Time"), F.lit(pattern)) if pattern else F.col("Time").try_cast("timestamp")


def untimed(df: DataFrame, pattern: str | None = None) -> DataFrame:
    """The readings whose ``Time`` cannot be read: what an alignment with a watermark leaves out."""
    return df.where(read_time(pattern).isNull())


def reconcile(frames: Sequence[tuple[str, DataFrame]], documents: DataFrame, on: str = "Time", parts=None) -> DataFrame:
    """The documents (``value``) that an alignment of the stored readings ``frames`` has and ``documents`` lacks, as often
    as they are lacking: what a stream with a watermark missed. Stored with the others, a second
    reconciling gives nothing.

    Counts tell which times are incomplete: the readings of a time per frame, multiplied, against its stored
    documents. Only these times, stored once, are aligned again. All documents of a time that has none are lacking; those
    of a time that has some are compared document by document."""
    counted = None
    for i, (_, df) in enumerate(frames):
        own = df.where(F.col(on).isNotNull()).groupBy(on).agg(F.count(F.lit(1)).cast("decimal(19,0)").alias(f"_n{i}"))
        counted = own if counted is None else counted.join(own, on)
    wanted = F.lit(1).cast("decimal(38,0)")
    for i in range(len(frames)):
        wanted = (wanted * F.col(f"_n{i}")).cast("decimal(38,0)")
    stored = documents.select("value", F.get_json_object("value", f"$.{on}").alias(on))
    have = stored.groupBy(on).agg(F.count(F.lit(1)).alias("_have"))
    open_ = stored_rows(counted.join(have, on, "left").where(wanted > F.coalesce("_have", F.lit(0))).select(on, F.col("_have").isNull().alias("_none")), "open-times")
    none, some = (open_.where(c).select(on) for c in (F.col("_none"), ~F.col("_none")))

    def made(times: DataFrame) -> DataFrame:
        aligned = align_streams([(alias, df.join(times, on, "left_semi")) for alias, df in frames], on=[on])
        return build_document(aligned, **({} if parts is None else {"parts": parts}))

    if some.isEmpty():
        return made(none)
    again = made(some).groupBy("value").agg(F.count(F.lit(1)).alias("_n"))
    known = stored.join(some, on, "left_semi").groupBy("value").agg(F.count(F.lit(1)).alias("_have"))
    lacking = again.join(known, "value", "left").withColumn("_n", F.col("_n") - F.coalesce("_have", F.lit(0))).where("_n > 0")
    return made(none).unionByName(lacking.select("value", F.explode(F.sequence(F.lit(1), F.col("_n"))).alias("_i")).select("value"))


def build_document(aligned: DataFrame, parts=DOCUMENT_PARTS, key: str = "Time") -> DataFrame:
    """Aligned row -> ``value``: JSON text ``{Time, Air{...}, Earth{...}, Water{...}}``.

    ``to_json`` leaves out NULL fields and writes NaN as ``"NaN"``."""
    nested = []
    for name, alias, schema in parts:
        fields = [F.col(f"{alias}_{safe_name(f.name)}").alias(f.name) for f in schema.fields if f.name != key]
        nested.append(F.struct(*fields).alias(name))
    return aligned.select(F.to_json(F.struct(F.col(key), *nested)).alias("value"))


def payload_fields(df: DataFrame, by: str = "topic", col: str = "value") -> DataFrame:
    """(by, field, kind, records): the top-level fields that the payloads really have, and the kind of their values
    (``number``, ``text``, ``boolean``, ``object``, ``array``, ``null``). Payloads that are no JSON object have none."""
    spark = df.sparkSession
    parsed = df.select(F.col(by).alias("by"), F.try_parse_json(F.col(col).cast("string")).alias("v")).alias("m")
    # Only objects have named fields; the elements of an array have none.
    fields = parsed.lateralJoin(spark.tvf.variant_explode(F.col("m.v").outer())).where(F.col("key").isNotNull())
    kind = F.schema_of_variant("value")
    name = (F.when(kind.rlike("^(DECIMAL|BIGINT|DOUBLE|FLOAT)"), "number").when(kind == "STRING", "text").when(kind == "BOOLEAN", "boolean")
            .when(kind.startswith("OBJECT"), "object").when(kind.startswith("ARRAY"), "array").otherwise("null"))
    return fields.groupBy(F.col("by").alias(by), F.col("key").alias("field"), name.alias("kind")).agg(F.count(F.lit(1)).alias("records"))


def payload_drift(df: DataFrame, schemas, by: str = "topic", col: str = "value") -> DataFrame:
    """How the payloads differ from the declared layouts (``schemas``: a StructType per value of ``by``): rows ``by, field,
    status, kind, records``. ``unknown``: a field that is not declared; ``changed``: a declared one with values of
    another kind; ``absent``: a declared one that no payload has. Other fields have no row."""
    declared = [(t, f.name, "text" if isinstance(f.dataType, StringType) else "number" if f.dataType.typeName() in ("double", "float", "integer", "long", "short", "byte") else
                 "boolean" if f.dataType.typeName() == "boolean" else "object" if isinstance(f.dataType, StructType) else "array") for t, s in schemas.items() for f in s.fields]
    known = df.sparkSession.createDataFrame(declared, f"{by} string, field string, declared string")  # a row per declared field
    both = payload_fields(df, by, col).join(F.broadcast(known), [by, "field"], "full")
    status = (F.when(F.col("declared").isNull(), "unknown").when(F.col("kind").isNull(), "absent")
              .when((F.col("kind") != F.col("declared")) & (F.col("kind") != "null"), "changed"))
    return both.select(by, "field", status.alias("status"), "kind", F.coalesce("records", F.lit(0)).alias("records")).where("status is not null")


def parse_document(df: DataFrame, schema: StructType = REPORT_DOCUMENT_SCHEMA, col: str = "value") -> DataFrame:
    """Parse only the fields in ``schema`` (the JSON reader skips the rest)."""
    return df.select(F.from_json(F.col(col), schema).alias("doc"))


def flatten(df: DataFrame, paths: dict[str, str] = REPORT_FIELDS, root: str = "doc",
            extra: Sequence[str] = ("Time",)) -> DataFrame:
    """Nested fields -> flat columns: ``{"Air_Temperature": "Air.Temperature"}``."""
    cols: list[Column] = [F.col(f"{root}.{e}").alias(e) for e in extra]
    cols += [F.col(f"{root}.{p}").alias(n) for n, p in paths.items()]
    return df.select(*cols)


def running_means(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: the mean of each column over everything seen (complete output mode in a
    stream), independent of the order, the partitions and the batches (``stats.exact_means``). Names are
    ``<name>_mean`` with dots replaced (``PM2_5_mean``)."""
    return exact_means(df, columns, [f"{safe_name(c)}_mean" for c in columns])
