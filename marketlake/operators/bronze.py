"""Bronze ingest: topic payloads -> one raw table each, values exactly as sent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.functions.casts import to_utc
from marketlake.schemas import PRICE_LEVELS, TABLE_TOPICS, table_fields, wire_schema

_CORRUPT = "_corrupt"


def decode(messages: DataFrame, table: str) -> DataFrame:
    """Parse payload text. `_corrupt` holds the text of a record that is not a JSON object in valid UTF-8, else NULL.

    Bytes that are no UTF-8 are repaired in `_corrupt` only; nothing of such a record is taken over.
    """
    text = F.col("value").cast("string")
    messages = messages.select(F.make_valid_utf8(text).alias("_raw"), F.is_valid_utf8(text).alias("_utf8"))
    record = F.from_json(
        F.when(F.col("_utf8"), F.col("_raw")), wire_schema(table, _CORRUPT), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    )
    # Generated rather than projected, so that a filter on `_corrupt` does not parse the text again.
    parsed = messages.select("_raw", "_utf8", F.inline_outer(F.array(record)))
    unreadable = F.col("_raw").isNull() | (F.trim("_raw") == "") | ~F.col("_utf8")
    corrupt = F.when(unreadable, F.coalesce("_raw", F.lit(""))).otherwise(F.col(_CORRUPT))
    return parsed.withColumn(_CORRUPT, corrupt).drop("_utf8")


def quarantine(decoded: DataFrame) -> DataFrame:
    """Records that could not be decoded, kept for inspection."""
    return decoded.filter(F.col(_CORRUPT).isNotNull()).select(F.col(_CORRUPT).alias("value"))


def _colons(text: Column) -> Column:
    return F.octet_length(text) - F.octet_length(F.replace(text, F.lit(":"), F.lit("")))


def _no_others(raw: Column, table: str) -> Column:
    """Whether the declared keys, read into columns of their names, surely are all that a payload has, told without parsing it again.

    Each key has its colon. As many colons as there are values, besides those within the values, leave none for another key. A payload
    with an escape (which may stand for a colon), a null or a repeated key is not sure.
    """
    values = [F.col(n) for n in wire_schema(table).names]
    number = sum((v.isNotNull().cast("int") for v in values), F.lit(0))
    return ~raw.contains("\\") & (_colons(raw) == number + _colons(F.concat_ws("", *values)))


def extra_keys(raw: Column, table: str) -> Column:
    """Keys of a payload that its contract doesn't declare, with their values as text; NULL where there are none.

    The payload's declared keys are in columns of their names. Only payloads that may have others have their keys looked at,
    and only those with others are parsed a second time.
    """
    declared = F.array(*[F.lit(n) for n in wire_schema(table).names])
    others = F.size(F.array_except(F.json_object_keys(raw), declared)) > 0
    found = F.map_filter(F.from_json(raw, "map<string,string>"), lambda k, v: ~F.array_contains(declared, k))
    return F.when(~_no_others(raw, table), F.when(others, found))


def typed_extra(raw: Column, table: str) -> Column:
    """As `extra_keys`, as one VARIANT object: numbers, booleans, nulls and nesting stay what they are; read with `variant_get`."""
    declared = F.array(*[F.lit(n) for n in wire_schema(table).names])
    others = F.size(F.array_except(F.json_object_keys(raw), declared)) > 0
    kept = F.map_filter(F.from_json(raw, "map<string,variant>"), lambda k, v: ~F.array_contains(declared, k))
    return F.when(~_no_others(raw, table), F.when(others, F.to_variant_object(kept)))


def ingest(messages: DataFrame, table: str, keep_extra: bool = True, keep_typed: bool = False) -> DataFrame:
    """Decoded table rows plus `event_date`, and undeclared keys in the map `extra`; with `keep_typed` as VARIANT in `extra_typed`, too.

    Lists stay as their JSON text in the named column; `<name>_levels` / `<name>_list` hold them typed.
    """
    rows = decode(messages, table).filter(F.col(_CORRUPT).isNull()).drop(_CORRUPT)
    columns = [F.col("event_type")]
    for field in table_fields(table):
        col = F.col(field.name)
        if field.kind == "flag":
            col = F.when(col == "true", True).when(col == "false", False)
        columns.append(col.alias(field.name))
        if field.kind == "levels":
            columns.append(F.from_json(field.name, PRICE_LEVELS).alias(f"{field.name}_levels"))
        if field.kind == "texts":
            columns.append(F.from_json(field.name, "array<string>").alias(f"{field.name}_list"))
    if keep_extra:
        columns.append(extra_keys(F.col("_raw"), table).alias("extra"))
    if keep_typed:
        columns.append(typed_extra(F.col("_raw"), table).alias("extra_typed"))
    return rows.select(*columns, F.to_date(to_utc(rows)).alias("event_date"))


def from_topics(published: DataFrame, table: str, keep_extra: bool = True) -> DataFrame:
    """Rows of one table out of routed records of all topics."""
    return ingest(published.filter(F.col("topic") == TABLE_TOPICS[table]), table, keep_extra)


def event_type_counts(bronze: DataFrame) -> DataFrame:
    return bronze.groupBy("event_type").agg(F.count(F.lit(1)).alias("n_events"))
