"""JSON payloads -> flat columns, with built-in JSON functions only."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


_BAD = "__bad_record"


def extract_json_fields(df: DataFrame, json_col: str, fields: Mapping[str, str],
                        keep: tuple[str, ...] = ()) -> DataFrame:
    """Parse ``json_col`` once with a DDL schema ``{field: type}`` and project
    the fields as top-level columns."""
    ddl = ", ".join(f"`{k}` {t}" for k, t in fields.items())
    parsed = F.from_json(F.col(json_col), ddl)
    return df.select(*keep, *[parsed.getField(k).alias(k) for k in fields])


def json_records(df: DataFrame, json_col: str, record_col: str = "record",
                 keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per record of a payload, as JSON text: the elements of an array, or the
    payload itself if it is none or can't be read as one. A null payload and an empty
    array have no records, a null element has none either."""
    raw = F.col(json_col)
    parts = F.when(raw.rlike(r"^\s*\["), F.coalesce(F.from_json(raw, "array<string>"), F.array(raw))).otherwise(F.array(raw))
    return df.select(*keep, F.explode(parts).alias(record_col)).filter(F.col(record_col).isNotNull())


def flatten_nested_record(df: DataFrame, json_col: str, top: Mapping[str, tuple[str, str]],
                          nested: str, nested_field: str, nested_alias: str,
                          keep: tuple[str, ...] = (), bad_alias: str | None = None) -> DataFrame:
    """Flatten records like ``{id, code, name, region: {name, ...}}``.

    ``top`` maps output column -> (json field, type). When the nested value is an
    object its ``nested_field`` is taken (null if it is null or absent),
    otherwise the value itself (a plain string in place of the object). With
    ``bad_alias`` a record that can't be read as such keeps its text there, and its
    fields are null.
    """
    ddl = ", ".join([f"`{f}` {t}" for f, t in top.values()] + [f"`{nested}` string"])
    if bad_alias:
        ddl += f", `{_BAD}` string"
    parsed = F.from_json(F.col(json_col), ddl, {"columnNameOfCorruptRecord": _BAD})
    raw = parsed.getField(nested)
    is_object = F.coalesce(F.ltrim(F.get_json_object(raw, "$")).startswith("{"), F.lit(False))
    value = F.when(is_object, F.get_json_object(raw, f"$.{nested_field}")).otherwise(raw)
    fields = [(parsed.getField(f), out) for out, (f, _) in top.items()] + [(value, nested_alias)]
    if not bad_alias:
        return df.select(*keep, *[c.alias(out) for c, out in fields])
    bad = parsed.getField(_BAD)
    return df.select(*keep, *[F.when(bad.isNull(), c).alias(out) for c, out in fields], bad.alias(bad_alias))
