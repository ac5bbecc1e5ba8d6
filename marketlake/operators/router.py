"""Envelope routing: raw feed text -> (topic, key, payload) records, with every reject accounted for."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from marketlake.schemas import EVENT_TOPICS, UNKNOWN_TOPIC

PUBLISHED = "published"
CONTROL = "control"
BAD_JSON = "bad_json"
MALFORMED = "malformed_envelope"
UNKNOWN_SKIPPED = "unknown_event"

_ENVELOPE = "event_type STRING, type STRING, data STRING, _corrupt STRING"


def _with_event_type(event_type: Column, data: Column) -> Column:
    """Payload text led by its event_type; a payload that carries its own keeps it.

    The text is spliced rather than rebuilt, so key order and types stay as they were sent.
    """
    made = F.to_json(F.struct(event_type.alias("event_type")))
    # The heads of the known events are made once.
    known = F.create_map(*[F.lit(part) for name in EVENT_TOPICS for part in (name, json.dumps({"event_type": name}, separators=(",", ":"))[:-1] + ",")])
    head = F.coalesce(F.try_element_at(known, event_type), F.concat(F.left(made, F.length(made) - 1), F.lit(",")))
    spliced = F.concat(head, F.substring(F.ltrim(data), 2, 2**31 - 1))
    has_own = data.contains('"event_type"') & F.array_contains(F.json_object_keys(data), "event_type")
    return F.when(has_own, data).otherwise(spliced)


def route(
    raw: DataFrame,
    topics: Mapping[str, str] | None = None,
    skip_unknown: bool = False,
    observation: Observation | None = None,
) -> DataFrame:
    """Label each raw line with its disposition, and published ones with topic, key and payload.

    `topics` overrides single entries of the event -> topic map. Unlisted events go to the catch-all
    topic, or are skipped. No line is dropped here; `published` and `counters` read the labels.
    """
    table = {**EVENT_TOPICS, **(topics or {})}
    pairs = [F.lit(part) for entry in table.items() for part in entry]
    topic = F.try_element_at(F.create_map(*pairs), F.col("event_type"))

    sent_text = F.col("value").cast("string")
    text = F.make_valid_utf8(sent_text)  # repaired for the reject table; such a line is never published
    kept = [c for c in raw.columns if c not in ("value", "topic", "key", "event_type")]
    envelope = F.from_json(text, _ENVELOPE, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    # Generated rather than projected: filters on the labels below must not be pushed into a second parse.
    parsed = raw.select(*kept, text.alias("_line"), F.is_valid_utf8(sent_text).alias("_utf8"), F.inline(F.array(envelope)))
    line, event_type, data = F.col("_line"), F.col("event_type"), F.col("data")
    # `[...]`, `5` and `null` are JSON but no envelope; the second parse runs for rejected lines only.
    unreadable = F.col("_corrupt").isNotNull() | line.isNull() | (F.trim(line) == "")
    empty = (
        event_type.isNull() | (event_type == "") | data.isNull()
        | ~data.startswith("{") | (~data.startswith('{"') & data.rlike(r"^\{\s*\}$"))
    )
    disposition = (
        F.when(~F.col("_utf8"), BAD_JSON)
        .when(unreadable, F.when(F.try_parse_json(line).isNull(), BAD_JSON).otherwise(MALFORMED))
        .when(F.col("type").eqNullSafe("welcome"), CONTROL)
        .when(empty, MALFORMED)
    )
    if skip_unknown:
        known = F.create_map(*pairs)
        disposition = disposition.when(~F.map_contains_key(known, event_type), UNKNOWN_SKIPPED)
    disposition = disposition.otherwise(PUBLISHED)

    routed = parsed.withColumn("disposition", disposition)
    sent = F.col("disposition") == PUBLISHED
    routed = routed.select(
        *kept,
        "disposition",
        "event_type",
        F.when(sent, F.coalesce(topic, F.lit(UNKNOWN_TOPIC))).alias("topic"),
        F.when(sent, F.coalesce(F.get_json_object(data, "$.symbol"), event_type)).alias("key"),
        F.when(sent, _with_event_type(event_type, data)).otherwise(line).alias("value"),
    )
    if observation is not None:
        routed = routed.observe(observation, *counter_columns())
    return routed


def published(routed: DataFrame) -> DataFrame:
    """The records a topic sink takes: topic, key, value."""
    return routed.filter(F.col("disposition") == PUBLISHED).select("topic", "key", "value")


def counter_columns() -> list[Column]:
    """Feed counters; control messages are neither published nor skipped."""
    state = F.col("disposition")
    return [
        F.count_if(state == PUBLISHED).alias("published"),
        F.count_if(~state.isin(PUBLISHED, CONTROL)).alias("skipped"),
        F.count_if(state == CONTROL).alias("control"),
    ]


def counters(routed: DataFrame) -> DataFrame:
    return routed.agg(*counter_columns())


def topic_counts(routed: DataFrame) -> DataFrame:
    return published(routed).groupBy("topic").agg(F.count(F.lit(1)).alias("n_events"))
