"""Raw forum records split into valid and invalid, on the executors.

A record is valid when it is a JSON object that has every field of its model,
no required field is null, and every value has the model's JSON type, which
includes the elements of lists and objects and the range of integers. Whole
numbers are accepted where the model has a float; nothing else is converted.
"""

from __future__ import annotations

from collections.abc import Collection
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.dates import fetch_metadata
from tidemark.functions.nulls import falsy_to_null
from tidemark.schemas import (
    COMMENT_RECORD,
    FETCH_FIELDS,
    MAY_BE_ABSENT,
    OBJECT_TEXT_FIELDS,
    REQUIRED_COMMENT,
    REQUIRED_SUBMISSION,
    SUBMISSION_RECORD,
)

MODELS = {
    "submissions": (SUBMISSION_RECORD, REQUIRED_SUBMISSION),
    "comments": (COMMENT_RECORD, REQUIRED_COMMENT),
}
_NUMBER = ("BIGINT", "DOUBLE", "FLOAT", "DECIMAL")


def _expected(field: T.StructField) -> tuple[str, tuple[str, ...]]:
    """What a field must be: in words, and as JSON types."""
    if field.name == "edited":
        return "boolean or number", ("BOOLEAN", *_NUMBER)
    if field.name in OBJECT_TEXT_FIELDS or isinstance(field.dataType, T.MapType):
        return "object", ("OBJECT",)
    if isinstance(field.dataType, T.ArrayType):
        return "list", ("ARRAY",)
    if isinstance(field.dataType, T.BooleanType):
        return "boolean", ("BOOLEAN",)
    if isinstance(field.dataType, T.IntegerType):
        return "integer", ("BIGINT",)
    if isinstance(field.dataType, T.DoubleType):
        return "number", _NUMBER
    return "string", ("STRING",)


def _lookup(name: str) -> str:
    return f"try_variant_get(_json, '$.{name}', 'variant')"


def _kind(name: str) -> str:
    """JSON type of a field without its parameters; NULL if the field is
    missing, VOID if it is null."""
    return f"substring_index(substring_index(schema_of_variant({_lookup(name)}), '<', 1), '(', 1)"


def _rule(field: T.StructField, required: Collection[str]) -> str:
    """A field's rule as a SQL literal: accepted types, and an error per case."""
    words, kinds = _expected(field)
    name = field.name
    absent = "CAST(NULL AS STRING)" if name in MAY_BE_ABSENT else f"'{name}: missing'"
    null = f"'{name}: null'" if name in required else "CAST(NULL AS STRING)"
    accepted = ", ".join(f"'{kind}'" for kind in kinds)
    return (
        f"named_struct('kinds', array({accepted}), 'absent', {absent}, 'null', {null},"
        f" 'wrong', '{name}: not a {words}')"
    )


def _inside(field: T.StructField) -> str | None:
    """An error in a value of the right type, or NULL: an integer out of range,
    a wrong element. None if nothing can be wrong inside."""
    at = f"'$.{field.name}'"
    if isinstance(field.dataType, T.IntegerType):
        fits = f"try_variant_get(_json, {at}, 'int') IS NOT NULL"
        return f"IF({fits}, NULL, '{field.name}: out of range')"
    if isinstance(field.dataType, T.ArrayType):
        fits = f"forall(try_variant_get(_json, {at}, 'array<variant>'), x -> schema_of_variant(x) = 'STRING')"
        return f"IF({fits}, NULL, '{field.name}: an element is not a string')"
    if isinstance(field.dataType, T.MapType):
        values = f"map_values(try_variant_get(_json, {at}, 'map<string,variant>'))"
        whole = f"forall({values}, x -> schema_of_variant(x) = 'BIGINT' AND try_variant_get(x, '$', 'int') IS NOT NULL)"
        return f"IF({whole}, NULL, '{field.name}: a value is not an integer in range')"
    return None


def check_records(lines: DataFrame, kind: str, value: str = "value") -> DataFrame:
    """Add ``errors``: one text per field that breaks the model, empty if none.

    Each line is parsed once, into a variant that the fields are looked up in.
    It comes out of a generator because filters on ``errors`` are not pushed
    below one: they would parse the line again for every field.
    """
    fields, required = _fields(kind), MODELS[kind][1]
    parsed = lines.select("*", F.explode(F.array(F.try_parse_json(value))).alias("_json"))
    kinds = F.expr(f"array({', '.join(_kind(f.name) for f in fields)})")
    rules = F.expr(f"array({', '.join(_rule(f, required) for f in fields)})")
    inner = [
        f"CASE WHEN {_kind(f.name)} = '{_expected(f)[1][0]}' THEN {inside} END"
        for f in fields
        if (inside := _inside(f)) is not None
    ]

    def error(found: Column, rule: Column) -> Column:
        return (
            F.when(found.isNull(), rule["absent"])
            .when(found == "VOID", rule["null"])
            .when(~F.array_contains(rule["kinds"], found), rule["wrong"])
        )

    is_object = F.schema_of_variant("_json").startswith("OBJECT<")
    found = F.concat(F.zip_with(kinds, rules, error), F.expr(f"array({', '.join(inner)})"))
    errors = F.when(is_object, F.array_compact(found)).otherwise(
        F.array(F.lit("not a JSON object"))
    )
    return parsed.withColumn("errors", errors)


def _fields(kind: str) -> list[T.StructField]:
    return [f for f in MODELS[kind][0] if f.name not in FETCH_FIELDS]


def _edited() -> Column:
    """The text of ``edited``. A whole number reads as the float it stands for."""
    edited = F.try_variant_get("_json", "$.edited", "string")
    whole = F.expr(_kind("edited")) == "BIGINT"
    return F.when(whole, F.concat(edited, F.lit(".0"))).otherwise(edited)


def _values(kind: str) -> dict[str, Column]:
    """The model's fields of a line parsed into ``_r``. ``edited`` and the
    objects that are kept as text come out of the variant, which keeps numbers
    as they were written."""
    values = {f.name: F.col(f"_r.{f.name}") for f in _fields(kind)}
    values["edited"] = falsy_to_null(_edited())
    for name in OBJECT_TEXT_FIELDS:
        if name in values:
            is_object = F.expr(_kind(name)) == "OBJECT"
            values[name] = F.when(is_object, F.to_json(F.expr(_lookup(name))))
    return values


def _others(checked: DataFrame, value: str) -> list[str]:
    return [c for c in checked.columns if c not in (value, "_json", "errors")]


def valid_records(
    checked: DataFrame, kind: str, fetched_at: datetime, value: str = "value"
) -> DataFrame:
    """The records without errors, typed, with their fetch time. ``edited``
    is NULL for a record that never was."""
    parsed = F.from_json(value, T.StructType(_fields(kind)))
    values = {**_values(kind), **fetch_metadata(fetched_at)}
    return (
        checked.where(F.size("errors") == 0)
        .withColumn("_r", parsed)
        .select(*_others(checked, value), *[v.alias(name) for name, v in values.items()])
    )


def invalid_records(checked: DataFrame, value: str = "value") -> DataFrame:
    """The records with errors, kept as they came, and what is wrong."""
    return checked.where(F.size("errors") > 0).select(
        *_others(checked, value),
        F.coalesce(F.col("_json"), F.col(value).cast("variant")).alias("invalid_record"),
        F.concat_ws("; ", "errors").alias("error"),
    )


def record_lines(
    checked: DataFrame, kind: str, fetched_at: datetime, value: str = "value"
) -> DataFrame:
    """Every record as the JSON line that is kept of it, and its status. A
    valid line has the model's fields as they were in the record, so that it
    is valid again, and the fetch time. Whole numbers in ``edited`` are floats."""
    is_valid = F.size("errors") == 0
    record = checked
    names = [f.name for f in _fields(kind) if f.name != "edited"]
    as_was = F.to_json(
        F.struct(*[F.expr(_lookup(n)).alias(n) for n in names]), {"ignoreNullFields": "false"}
    )
    own = [F.concat(F.lit(f',"{n}":"'), v, F.lit('"')) for n, v in fetch_metadata(fetched_at).items()]
    edited = F.concat(F.lit(',"edited":'), _edited())
    valid = F.concat(as_was.substr(F.lit(1), F.length(as_was) - 1), edited, *own, F.lit("}"))
    invalid = F.to_json(
        F.struct(
            F.coalesce(F.col("_json"), F.col(value).cast("variant")).alias("invalid_record"),
            F.concat_ws("; ", "errors").alias("error"),
        )
    )
    return record.select(
        *_others(checked, value),
        F.when(is_valid, "valid").otherwise("invalid").alias("status"),
        F.when(is_valid, valid).otherwise(invalid).alias("value"),
    )


def write_records(lines: DataFrame, root: str, kind: str, fetched_date: str) -> None:
    """Both outcomes, in one pass, as JSON lines under
    ``root/kind/fetched_date=…/status=…/subreddit=…``. A set without rows
    writes nothing; a repeated run replaces its own files."""
    (
        lines.select(
            F.lit(fetched_date).alias("fetched_date"),
            "status",
            F.lower("subreddit").alias("subreddit"),
            "value",
        )
        .hint("rebalance", "status", "subreddit")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("fetched_date", "status", "subreddit")
        .text(f"{root}/{kind}")
    )
