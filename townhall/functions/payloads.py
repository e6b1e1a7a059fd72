"""Access to untyped payloads held as VARIANT."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def field(payload: Column, path: str, kind: str = "string") -> Column:
    """Value at a dotted path; missing, JSON null or another type -> null."""
    return F.try_variant_get(payload, f"$.{path}", kind)


def children(payload: Column, key: str | None = None) -> Column:
    """The list at the root or under ``key`` as array<variant>; null when it is no list."""
    return F.try_variant_get(payload, f"$.{key}" if key else "$", "array<variant>")


def no_items() -> Column:
    return F.array().cast("array<variant>")


def list_or_empty(payload: Column, key: str) -> Column:
    return F.coalesce(children(payload, key), no_items())


def is_object(payload: Column) -> Column:
    """True for objects only. Reading no fields is enough to tell."""
    return F.try_variant_get(payload, "$", "struct<>").isNotNull()


def json_text(payload: Column) -> Column:
    return F.to_json(payload)


def members(payload: Column) -> Column:
    """Top-level members of an object; null for anything else."""
    return F.try_variant_get(payload, "$", "map<string,variant>")
