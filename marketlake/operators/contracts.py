"""Event contracts: required fields, types, bounds and value sets per event type."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.functions.casts import NUMBER_TEXT, to_number, to_utc
from marketlake.functions.labels import invalid_reasons
from marketlake.schemas import CONTRACTS, LEVEL_FIELDS, Field


def _typed(df: DataFrame, field: Field) -> Column:
    """The value in the contract's type; NULL when the text does not have it."""
    if field.kind == "number":
        return to_number(df, field.name)
    if field.kind == "integer":
        value = to_number(df, field.name)
        return F.when(value == F.floor(value), value)
    if field.kind == "time":
        return to_utc(df, field.name)
    if field.kind == "flag":
        return F.col(field.name).try_cast("boolean")
    if field.kind == "levels":
        return _list_of(field.name, "{", _LEVEL_TEXTS)
    if field.kind == "texts":
        return _list_of(field.name, "", "array<string>")
    return F.col(field.name)


_LEVEL_TEXTS = f"array<struct<{', '.join(f'{f.name}: string' for f in LEVEL_FIELDS)}>>"


def _list_of(name: str, opening: str, kind: str) -> Column:
    """A JSON list, elements as text; NULL if the text is no list, or has an element that doesn't begin as it should."""
    elements = F.from_json(name, "array<string>")
    fits = F.col(name).rlike(r"^\s*\[") & F.forall(elements, lambda e: F.coalesce(e.startswith(opening), F.lit(opening == "")))
    return F.when(fits, F.from_json(name, kind))


def _level_checks(field: Field, levels: Column) -> dict[str, Column]:
    """What any level of a list breaks."""
    found = {}
    for part in LEVEL_FIELDS:
        number = lambda e: F.when(e[part.name].rlike(NUMBER_TEXT), e[part.name].try_cast("double"))  # noqa: B023, E731
        whole = lambda e: number(e).isNull() | (number(e) != F.floor(number(e)))  # noqa: B023, E731
        wrong = whole if part.kind == "integer" else lambda e: number(e).isNull()  # noqa: B023
        found[f"missing:{field.name}.{part.name}"] = F.exists(levels, lambda e: e[part.name].isNull())  # noqa: B023
        found[f"type:{field.name}.{part.name}"] = F.exists(levels, lambda e: e[part.name].isNotNull() & wrong(e))  # noqa: B023
    return found


def checks(df: DataFrame, event_type: str) -> dict[str, Column]:
    """Violation name -> predicate, in contract order."""
    found: dict[str, Column] = {}
    for field in CONTRACTS[event_type]:
        name = field.name
        if name not in df.columns:
            if field.required:
                found[f"missing:{name}"] = F.lit(True)
            continue
        present, typed = F.col(name).isNotNull(), _typed(df, field)
        if field.required:
            found[f"missing:{name}"] = ~present
        if field.kind != "text":
            found[f"type:{name}"] = present & typed.isNull()
        if field.kind == "levels":
            found.update(_level_checks(field, typed))
        if field.kind == "texts":
            found[f"missing:{name}[]"] = F.exists(typed, lambda e: e.isNull())
        if field.above is not None:
            found[f"bound:{name}"] = typed <= field.above
        if field.at_least is not None:
            found[f"bound:{name}"] = typed < field.at_least
        if field.one_of:
            found[f"value:{name}"] = ~typed.isin(list(field.one_of))
    return found


def label_contract(bronze: DataFrame, event_type: str) -> DataFrame:
    """Rows of one event type with `violations`: the broken clauses joined by '|', '' when none is."""
    rows = bronze.filter(F.col("event_type") == event_type)
    return rows.withColumn("violations", invalid_reasons(checks(rows, event_type)))


def violation_counts(bronze: DataFrame, event_type: str) -> DataFrame:
    """Rows per broken clause of one event type."""
    return (
        label_contract(bronze, event_type)
        .filter("violations <> ''")
        .select("event_type", F.explode(F.split("violations", "[|]")).alias("violation"))
        .groupBy("event_type", "violation")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
