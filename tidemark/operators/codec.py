"""Decoding and encoding of wire batches and events.

Wire batch, one JSON text per line::

    {"cursor":{"partition":"0","offset":"000000000000000042"},"events":[...]}

Decoding is strict where Spark would coerce: partition and offset must be
JSON strings, ``data`` must be an object, date-times need a zone offset.
One invalid event invalidates its whole batch, so validity is decided per
line over the events array (``forall``/``filter``) before anything is
exploded.  Parsing happens once per line (``try_parse_json`` to VARIANT);
every later step reads sub-values of that one parsed column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.datetime import (
    format_offset_datetime, parse_offset_datetime, parse_offset_datetime_sql,
)
from tidemark.functions.enums import normalise_category, normalise_data_op
from tidemark.functions.json import is_integral, is_json_null, is_object, is_string, is_string_array, vget
from tidemark.functions.offsets import offset_to_long

ERROR_TYPE = T.ArrayType(T.StructType([T.StructField("path", T.StringType()),
                                       T.StructField("reason", T.StringType())]))

# Fixed reason texts of the validation report.
MISSING = "missing"
NOT_STRING = "not a string"
NOT_OBJECT = "not an object"
NOT_ARRAY = "not an array"
NOT_STRING_ARRAY = "not an array of strings"
NOT_DATETIME = "not an offset date-time"
UNPARSEABLE = "unparseable"


# The validation expression is large; it is written as one SQL string and
# parsed once by the JVM (building it column by column from Python costs a
# py4j round trip per node).

def _vg(v: str, path: str) -> str:
    return f"variant_get({v}, '{path}', 'variant')"


def _is_str(x: str) -> str:
    return f"(schema_of_variant({x}) = 'STRING')"


def _is_obj(x: str) -> str:
    return f"(try_variant_get({x}, '$', 'map<string,variant>') IS NOT NULL)"


def _is_arr(x: str) -> str:
    return f"(try_variant_get({x}, '$', 'array<variant>') IS NOT NULL)"


def _present_sql(x: str) -> str:
    """Key present with a non-null JSON value (optional fields)."""
    return f"({x} IS NOT NULL AND NOT is_variant_null({x}))"


def _err(cond: str, path: str, reason: str) -> str:
    return f"CASE WHEN {cond} THEN named_struct('path', {path}, 'reason', '{reason}') END"


def _compact(items: list[str]) -> str:
    return "filter(array(" + ", ".join(items) + "), x -> x IS NOT NULL)"


def _typed(cond: str, v: str, path: str, missing: bool = True) -> list[tuple[str, str, str]]:
    out = [(f"{cond} AND {v} IS NULL", path, MISSING)] if missing else []
    return out + [(f"{cond} AND {v} IS NOT NULL AND NOT {_is_str(v)}", path, NOT_STRING)]


def _errors_of(checks: list[tuple[str, str, str]]) -> str:
    """The failing checks as an array of (path, reason)."""
    return _compact([_err(c, p, r) for c, p, r in checks])


def _any_of(checks: list[tuple[str, str, str]]) -> str:
    """Whether any check fails (NULL counts as passing, as in CASE WHEN)."""
    return "(" + " OR ".join(f"coalesce({c}, false)" for c, _, _ in checks) + ")"


# One shallow cast per object level extracts every field the checks need:
# a missing key is SQL NULL, a JSON null is VARIANT null, and a value that
# is not an object makes the whole cast NULL.
EVENT_FIELDS = "struct<data:variant,data_type:variant,data_op:variant,metadata:variant>"
METADATA_FIELDS = ("struct<eid:variant,event_type:variant,occurred_at:variant,received_at:variant,"
                   "parent_eids:variant,flow_id:variant>")


def _obj_sql(x: str) -> str:
    return f"(try_variant_get({x}, '$', 'struct<_:variant>') IS NOT NULL)"


def event_facts_sql(events: str) -> str:
    """array<variant> -> array of (i, top, md) structs, each field read once."""
    top = f"transform({events}, (e, i) -> named_struct('i', i, 'top', try_variant_get(e, '$', '{EVENT_FIELDS}')))"
    return (f"transform({top}, f -> named_struct('i', f.i, 'top', f.top, "
            f"'md', try_variant_get(f.top.metadata, '$', '{METADATA_FIELDS}')))")


def event_checks(f: str = "f") -> list[tuple[str, str, str]]:
    """Validation checks (condition, path, reason) of one event from its
    facts struct ``f``."""
    p = f"concat('events[', CAST({f}.i AS STRING), ']')"

    def at(suffix: str) -> str:
        return f"concat('events[', CAST({f}.i AS STRING), ']{suffix}')"

    obj = f"({f}.top IS NOT NULL)"
    data = f"{f}.top.data"
    dc = f"({obj} AND {data} IS NOT NULL)"   # a top-level "data" key makes it data-change
    md = f"{f}.top.metadata"
    md_obj = f"({f}.md IS NOT NULL)"
    occ, rec, parents = f"{f}.md.occurred_at", f"{f}.md.received_at", f"{f}.md.parent_eids"
    occ_text = f"variant_get({occ}, '$', 'string')"
    rec_text = f"variant_get({rec}, '$', 'string')"
    parents_arr = f"try_variant_get({parents}, '$', 'array<variant>')"
    return [
        (f"NOT {obj}", p, NOT_OBJECT),
        *_typed(dc, f"{f}.top.data_type", at(".data_type")),
        *_typed(dc, f"{f}.top.data_op", at(".data_op")),
        (f"{dc} AND NOT {_obj_sql(data)}", at(".data"), NOT_OBJECT),
        (f"{obj} AND {md} IS NULL", at(".metadata"), MISSING),
        (f"{obj} AND {md} IS NOT NULL AND NOT {md_obj}", at(".metadata"), NOT_OBJECT),
        *_typed(md_obj, f"{f}.md.eid", at(".metadata.eid")),
        *_typed(md_obj, occ, at(".metadata.occurred_at")),
        (f"{md_obj} AND {occ} IS NOT NULL AND {_is_str(occ)} AND ({parse_offset_datetime_sql(occ_text)}) IS NULL",
             at(".metadata.occurred_at"), NOT_DATETIME),
        *_typed(f"{md_obj} AND {_present_sql(f + '.md.event_type')}", f"{f}.md.event_type",
                at(".metadata.event_type"), missing=False),
        *_typed(f"{md_obj} AND {_present_sql(rec)}", rec, at(".metadata.received_at"), missing=False),
        (f"{md_obj} AND {_present_sql(rec)} AND {_is_str(rec)} AND ({parse_offset_datetime_sql(rec_text)}) IS NULL",
             at(".metadata.received_at"), NOT_DATETIME),
        (f"{md_obj} AND {_present_sql(parents)} AND NOT ({parents_arr} IS NOT NULL AND "
             f"forall({parents_arr}, y -> schema_of_variant(y) = 'STRING'))",
             at(".metadata.parent_eids"), NOT_STRING_ARRAY),
        *_typed(f"{md_obj} AND {_present_sql(f + '.md.flow_id')}", f"{f}.md.flow_id",
                at(".metadata.flow_id"), missing=False),
    ]


def line_checks(v: str = "_v") -> list[tuple[str, str, str]]:
    cursor = _vg(v, "$.cursor")
    cp, co, ev = _vg(v, "$.cursor.partition"), _vg(v, "$.cursor.offset"), _vg(v, "$.events")
    cur_obj = f"({cursor} IS NOT NULL AND {_is_obj(cursor)})"
    return [
        (f"{cursor} IS NULL", "'cursor'", MISSING),
        (f"{cursor} IS NOT NULL AND NOT {_is_obj(cursor)}", "'cursor'", NOT_OBJECT),
        *_typed(cur_obj, cp, "'cursor.partition'"),
        *_typed(cur_obj, co, "'cursor.offset'"),
        (f"{_present_sql(ev)} AND NOT {_is_arr(ev)}", "'events'", NOT_ARRAY),
    ]


def _facts(v: str) -> str:
    return event_facts_sql(f"try_variant_get({v}, '$.events', 'array<variant>')")


def batch_valid_sql(v: str = "_v") -> str:
    """Whether a parsed line is a valid batch: short-circuits on the first
    failing check and allocates nothing (the valid path)."""
    return (f"({v} IS NOT NULL AND NOT {_any_of(line_checks(v))} AND NOT "
            f"coalesce(exists({_facts(v)}, f -> {_any_of(event_checks('f'))}), false))")


def batch_errors_sql(v: str = "_v") -> str:
    """All validation errors of one parsed line (empty when valid)."""
    per_event = f"flatten(transform({_facts(v)}, f -> {_errors_of(event_checks('f'))}))"
    return (f"CAST(CASE WHEN {v} IS NULL THEN array(named_struct('path', '$', 'reason', '{UNPARSEABLE}')) "
            f"ELSE concat({_errors_of(line_checks(v))}, coalesce({per_event}, array())) END "
            f"AS array<struct<path:string,reason:string>>)")


_BATCH_VALID_SQL = batch_valid_sql()
_BATCH_ERRORS_SQL = batch_errors_sql()


def parse_batches(lines: DataFrame, value: str = "value") -> DataFrame:
    """B1: parse each line once and validate it.

    Adds ``errors`` (array of (path, reason), empty when valid),
    ``cursor_partition``, ``cursor_offset`` (text), ``events``
    (array<variant>, empty for keep-alives) and ``n_events``.
    """
    # Parse behind a generator: Catalyst pushes the validity filter below a
    # projection by inlining its expressions, which would parse every line
    # twice (filter and projection); it cannot inline a generator's output.
    parsed = lines.select("*", F.inline(F.array(F.struct(F.try_parse_json(F.col(value)).alias("_v")))))
    return parsed.selectExpr(
        "*",
        f"{_BATCH_VALID_SQL} AS valid",
        # the detailed list only for invalid lines (the quarantine path)
        f"CASE WHEN {_BATCH_VALID_SQL} THEN CAST(array() AS array<struct<path:string,reason:string>>) "
        f"ELSE {_BATCH_ERRORS_SQL} END AS errors",
        "CASE WHEN schema_of_variant(variant_get(_v, '$.cursor.partition', 'variant')) = 'STRING' "
        "THEN variant_get(_v, '$.cursor.partition', 'string') END AS cursor_partition",
        "CASE WHEN schema_of_variant(variant_get(_v, '$.cursor.offset', 'variant')) = 'STRING' "
        "THEN variant_get(_v, '$.cursor.offset', 'string') END AS cursor_offset",
        "coalesce(try_variant_get(_v, '$.events', 'array<variant>'), CAST(array() AS array<variant>)) AS events",
    ).withColumn("n_events", F.size("events").cast("bigint"))


def decode_batches(lines: DataFrame, value: str = "value") -> DataFrame:
    """B1: the valid batches (cursor typed, events kept as VARIANT)."""
    p = parse_batches(lines, value)
    return p.filter(F.col("valid")).drop("_v", "errors", "valid")


def quarantine_batches(lines: DataFrame, value: str = "value") -> DataFrame:
    """B2: the complement of :func:`decode_batches`, with reasons and raw text."""
    p = parse_batches(lines, value)
    first = F.col("errors")[0]
    reason = F.when(first["reason"] == UNPARSEABLE, F.lit(UNPARSEABLE)).otherwise(
        F.concat(first["path"], F.lit(": "), first["reason"]))
    return (p.filter(~F.col("valid"))
            .withColumn("reason", reason)
            .drop("_v", "events", "n_events", "valid"))


def validation_report(quarantined: DataFrame) -> DataFrame:
    """Counts per (field path, reason); event indexes folded to ``[*]``."""
    e = quarantined.select(F.explode("errors").alias("e"))
    path = F.regexp_replace(F.col("e.path"), r"\[[0-9]+\]", "[*]")
    return (e.groupBy(path.alias("path"), F.col("e.reason").alias("reason"))
            .agg(F.count(F.lit(1)).alias("n_errors")))


def to_consumer_messages(batches: DataFrame, event_type: Column | str = "event_type") -> DataFrame:
    """The event type comes from the subscription (the log's directory),
    not from event metadata; absent events become an empty list."""
    et = F.col(event_type) if isinstance(event_type, str) else event_type
    return batches.select(et.alias("event_type"),
                          F.col("cursor_partition").alias("partition"),
                          F.col("cursor_offset"),
                          offset_to_long("cursor_offset").alias("cursor_offset_long"),
                          "events", "n_events")


def explode_events(messages: DataFrame) -> DataFrame:
    """One row per event with batch cursor and position.

    Events of a batch have consecutive offsets ending at the cursor, so the
    event offset is ``cursor - (n - 1) + pos``."""
    x = messages.select("*", F.posexplode("events").alias("pos", "event"))
    return (x.withColumn("pos", F.col("pos").cast("bigint"))
            .withColumn("offset", F.col("cursor_offset_long") - F.col("n_events") + 1 + F.col("pos"))
            .drop("events"))


def classify(e: Column) -> Column:
    """Data-change iff a top-level ``data`` key exists, even if null."""
    return F.when(vget(e, "$.data").isNotNull(), F.lit("data")).otherwise(F.lit("business"))


DECODED_FIELDS = ("struct<data:variant,data_type:string,data_op:string,metadata:struct<eid:string,"
                  "event_type:string,occurred_at:string,received_at:string,parent_eids:array<string>,"
                  "flow_id:string>>")


def decode_event_fields(events: DataFrame, event: str = "event") -> DataFrame:
    """B5-B9 on valid events: kind, metadata fields, data-change fields and
    the payload (``data`` for data-change, the object minus ``metadata`` for
    business events) as canonical JSON text.  All fields come out of one
    variant-to-struct cast per event."""
    e = F.col(event)
    x = events.withColumn("_x", F.variant_get(e, "$", DECODED_FIELDS))
    kind = F.when(F.col("_x.data").isNotNull(), F.lit("data")).otherwise(F.lit("business"))
    business_payload = F.to_json(F.map_filter(F.variant_get(e, "$", "map<string,variant>"),
                                              lambda k, v: k != F.lit("metadata")))
    occ_text = F.col("_x.metadata.occurred_at")
    return x.select(
        *[c for c in events.columns],
        kind.alias("kind"),
        F.col("_x.metadata.eid").alias("eid"),
        F.col("_x.metadata.event_type").alias("meta_event_type"),
        occ_text.alias("occurred_at_text"),
        parse_offset_datetime(occ_text).alias("occurred_at"),
        parse_offset_datetime(F.col("_x.metadata.received_at")).alias("received_at"),
        F.col("_x.metadata.parent_eids").alias("parent_eids"),
        F.col("_x.metadata.flow_id").alias("flow_id"),
        F.when(kind == "data", F.col("_x.data_type")).alias("data_type"),
        F.when(kind == "data", normalise_data_op(F.col("_x.data_op"))).alias("data_op"),
        F.when(kind == "data", F.to_json(F.col("_x.data"))).otherwise(business_payload).alias("payload"),
    )


# --------------------------------------------------------------------------- encode

def metadata_struct(eid: Column, occurred_at_text: Column, event_type: Column | None = None,
                    received_at_text: Column | None = None, parent_eids: Column | None = None,
                    flow_id: Column | None = None) -> Column:
    null_s = F.lit(None).cast("string")
    return F.struct(eid.alias("eid"),
                    (event_type if event_type is not None else null_s).alias("event_type"),
                    occurred_at_text.alias("occurred_at"),
                    (received_at_text if received_at_text is not None else null_s).alias("received_at"),
                    (parent_eids if parent_eids is not None else F.lit(None).cast("array<string>"))
                    .alias("parent_eids"),
                    (flow_id if flow_id is not None else null_s).alias("flow_id"))


def encode_event(kind: Column, metadata: Column, payload_json: Column,
                 data_type: Column, data_op: Column) -> Column:
    """Absent optionals are omitted (``to_json`` drops nulls).

    Data-change: ``{"data_type","data_op","data","metadata"}``.  Business:
    ``{"metadata": ...}`` merged with the payload object, payload keys win
    (needs ``spark.sql.mapKeyDedupPolicy=LAST_WIN``)."""
    data_change = F.to_json(F.struct(data_type.alias("data_type"), data_op.alias("data_op"),
                                     F.parse_json(payload_json).alias("data"),
                                     metadata.alias("metadata")))
    business = F.to_json(F.map_concat(
        F.create_map(F.lit("metadata"), F.parse_json(F.to_json(metadata))),
        F.from_json(payload_json, "map<string,variant>")))
    return F.when(kind == "data", data_change).otherwise(business)


def encode_log_events(log: DataFrame) -> DataFrame:
    """B12 over the canonical log: adds ``event_json``."""
    md = metadata_struct(F.col("eid"), format_offset_datetime("occurred_at"),
                         event_type=F.col("event_type"), flow_id=F.col("flow_id"))
    return log.withColumn("event_json", encode_event(F.col("kind"), md, F.col("payload"),
                                                     F.col("data_type"), F.col("data_op")))


def cursor_json(partition: Column, offset: Column) -> Column:
    return F.to_json(F.struct(partition.alias("partition"), offset.alias("offset")))


def batch_line(cursor: Column, event_jsons: Column | None) -> Column:
    """``{"cursor":…,"events":[…]}``; events omitted when absent.
    Event texts are already JSON, so they are spliced, not re-parsed."""
    head = F.concat(F.lit('{"cursor":'), cursor)
    if event_jsons is None:
        return F.concat(head, F.lit("}"))
    return F.concat(head, F.lit(',"events":['), F.array_join(event_jsons, ","), F.lit("]}"))


def encode_cursors(cursors: DataFrame, keys: list[str]) -> DataFrame:
    """Per key, the JSON array of cursors ordered by partition, offsets
    as strings: ``[{"partition":"0","offset":"10"}]``."""
    s = F.struct(F.col("partition").alias("partition"), F.col("offset").cast("string").alias("offset"))
    return (cursors.groupBy(*keys)
            .agg(F.sort_array(F.collect_list(s)).alias("_c"))
            .select(*keys, F.to_json("_c").alias("cursors_json")))


# --------------------------------------------------------------------------- event types

EVENT_TYPE_SCHEMA = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("statistics", T.StructType([
        T.StructField("expected_write_rate", T.LongType()),
        T.StructField("message_size", T.LongType()),
        T.StructField("read_parallelism", T.LongType()),
        T.StructField("write_parallelism", T.LongType()),
    ])),
    T.StructField("partition_key_fields", T.ArrayType(T.StringType())),
    T.StructField("data_key_fields", T.ArrayType(T.StringType())),
    T.StructField("owning_application", T.StringType()),
    T.StructField("validation_strategies", T.ArrayType(T.StringType())),
    T.StructField("partition_resolution_strategy", T.VariantType()),
    T.StructField("schema", T.VariantType()),
    T.StructField("category", T.StringType()),
    T.StructField("enrichment_strategies", T.ArrayType(T.StringType())),
])

REQUIRED_EVENT_TYPE_FIELDS = ["name", "partition_key_fields", "owning_application", "category",
                              "enrichment_strategies"]


STRING_FIELDS = ["name", "owning_application", "category"]
STRING_LIST_FIELDS = ["partition_key_fields", "data_key_fields", "validation_strategies", "enrichment_strategies"]
STATISTICS_FIELDS = ["expected_write_rate", "message_size", "read_parallelism", "write_parallelism"]


def decode_event_types(texts: DataFrame, value: str = "value") -> DataFrame:
    """Event-type definitions; rows lacking a required field, or with a
    field of another JSON type, get ``valid = false`` and the lists of
    missing and mistyped fields (absent and null optionals are fine)."""
    v = F.try_parse_json(F.col(value))

    def mistyped(path: str, test) -> Column:
        x = vget(v, f"$.{path}")
        return F.when(x.isNotNull() & ~is_json_null(x) & ~test(x), F.lit(path))

    wrong = F.array_compact(F.array(
        *[mistyped(f, is_string) for f in STRING_FIELDS],
        *[mistyped(f, is_string_array) for f in STRING_LIST_FIELDS],
        mistyped("statistics", is_object), *[mistyped(f"statistics.{f}", is_integral) for f in STATISTICS_FIELDS]))
    missing = F.filter(F.array(*[F.when(vget(v, f"$.{f}").isNull() | is_json_null(vget(v, f"$.{f}")),
                                        F.lit(f)) for f in REQUIRED_EVENT_TYPE_FIELDS]),
                       lambda x: x.isNotNull())
    typed = F.from_json(F.col(value), EVENT_TYPE_SCHEMA)
    out = texts.select("*", typed.alias("et"), missing.alias("missing_fields"),
                       F.coalesce(wrong, F.array().cast("array<string>")).alias("mistyped_fields"))
    return (out.select("*", *[F.col(f"et.{f.name}").alias(f.name) for f in EVENT_TYPE_SCHEMA.fields])
            .withColumn("category", normalise_category("category"))
            .withColumn("valid", (F.size("missing_fields") == 0) & (F.size("mistyped_fields") == 0))
            .drop("et"))


def encode_event_types(defs: DataFrame) -> DataFrame:
    """Inverse of B17, snake_case keys, absent optionals omitted."""
    cols = [F.col(f.name) for f in EVENT_TYPE_SCHEMA.fields]
    return defs.withColumn("event_type_json", F.to_json(F.struct(*cols)))
