"""Row labels: rejection reasons, validation status, code lookups, quote microstructure."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def invalid_reasons(checks: dict[str, Column]) -> Column:
    """Names of the checks that hold, joined by '|' in the order given; '' when none does.

    A check that is NULL for a row counts as not triggered.
    """
    if not checks:
        return F.lit("")
    return F.concat_ws("|", *[F.when(hit, F.lit(name)) for name, hit in checks.items()])


def validation_status(reasons: Column) -> Column:
    return F.when(reasons != "", "invalid").otherwise("valid")


def code_lookup(raw: Column, rows: Iterable[tuple], default: str = "unknown") -> Column:
    """Normalized code of a raw value through a small fixed code table; unlisted and NULL get the default."""
    pairs = [F.lit(part) for row in rows for part in row[:2]]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), raw), F.lit(default))


def is_two_sided(bid: Column, ask: Column) -> Column:
    """A usable market: positive bid below the ask."""
    return (bid > 0) & (ask > bid)


def mid_price(bid: Column, ask: Column) -> Column:
    return F.when(is_two_sided(bid, ask), (bid + ask) / 2)


def spread_bps(bid: Column, ask: Column) -> Column:
    mid = (bid + ask) / 2
    return F.when(is_two_sided(bid, ask), (ask - bid) / mid * 10_000)


def depth_imbalance(bid: Column, ask: Column, bid_size: Column, ask_size: Column) -> Column:
    """(bid size - ask size) / total size; NULL for an unusable market or an empty book."""
    total = bid_size + ask_size
    return F.when(is_two_sided(bid, ask), (bid_size - ask_size) / F.nullif(total, F.lit(0.0)))
