"""Nested documents: long forms, leaf paths, diffs and parsed answers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from homeload import schemas
from homeload.functions import text
from homeload.functions.arrays import let


def consumption_long(docs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(keys, stream, member_id, hour, action, kwh)``; stream is member, heating or cooling."""
    return docs.select(*keys, F.explode(activity_rows()).alias("r")).select(*keys, "r.*")


def member_streams() -> Column:
    """Activity arrays of the members of a consumption document."""
    streams = F.transform("members", lambda m: m["hourly_activities"])
    some = F.filter(streams, lambda s: s.isNotNull())
    return F.coalesce(some, F.array().cast(f"array<array<{schemas.ACTIVITY.lower()}>>"))


def activity_rows(hvac: bool = True) -> Column:
    """All activity entries of a consumption document as one flat array."""

    def entry(stream: str, member: Column, a: Column) -> Column:
        return F.struct(
            F.lit(stream).alias("stream"), member.alias("member_id"), a["hour"].alias("hour"),
            a["action"].alias("action"), a["consumption_kwh"].alias("kwh"),
        )

    people = F.flatten(
        F.transform(
            F.coalesce("members", F.array().cast("array<" + _MEMBER + ">")),
            lambda m: F.transform(m["hourly_activities"], lambda a: entry("member", m["member_id"], a)),
        )
    )
    if not hvac:
        return people
    nobody = F.lit(None).cast("string")

    def machine(stream: str) -> Column:
        rows = F.transform(f"hvac.{stream}", lambda a: entry(stream, nobody, a))
        return F.coalesce(rows, F.array().cast("array<" + _ROW + ">"))

    return F.concat(people, machine("heating"), machine("cooling"))


_MEMBER = f"struct<member_id: string, hourly_activities: array<{schemas.ACTIVITY.lower()}>>"
_ROW = "struct<stream: string, member_id: string, hour: int, action: string, kwh: double>"


def consumption_nested(long: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inverse of ``consumption_long``; a key holds one document's entries only."""
    act = F.struct("hour", "action", F.col("kwh").alias("consumption_kwh"))
    streams = long.groupBy(*keys, "stream", "member_id").agg(F.array_sort(F.collect_list(act)).alias("acts"))

    def hvac(stream: str) -> Column:
        return F.coalesce(
            F.first(F.when(F.col("stream") == stream, F.col("acts")), ignorenulls=True),
            F.array().cast(f"array<{schemas.ACTIVITY.lower()}>"),
        ).alias(stream)

    member = F.when(
        F.col("stream") == "member", F.struct("member_id", F.col("acts").alias("hourly_activities"))
    )
    return streams.groupBy(*keys).agg(
        F.array_sort(F.collect_list(member)).alias("members"),
        F.struct(hvac("heating"), hvac("cooling")).alias("hvac"),
    )


def sequence_items(text_column: Column, item_schema: str) -> Column:
    """Items of a document that is an array, ``{"sequence": [...]}`` or one object."""
    body = F.trim(text_column)
    items = schemas.array_of(item_schema)
    wrapped = F.from_json(body, f"sequence {items}", schemas.ANY_LENGTH)["sequence"]
    plain = F.from_json(body, items, schemas.ANY_LENGTH)
    return F.when(F.startswith(body, F.lit("[")), plain).otherwise(F.coalesce(wrapped, plain))


def _path_part(name: str) -> str:
    return "`" + name.replace("`", "``") + "`" if set(name) & set(".[]`") else name


def leaves(value: Column, dtype: T.DataType, path: Column | None = None) -> Column:
    """Every scalar of a nested value as ``array<struct<path, value>>``.

    The expression follows the schema, so it stays in the JVM. Paths read like
    ``members[0].role``; a field name that holds one of ``.[]``` is quoted by
    backticks. An empty array is a leaf of its own with the value ``[]``.
    """
    path = F.lit("") if path is None else path
    none = F.array().cast("array<struct<path: string, value: string>>")
    if isinstance(dtype, T.StructType):
        parts = [
            leaves(
                value[f.name], f.dataType,
                F.concat(path, F.when(path == "", "").otherwise("."), F.lit(_path_part(f.name))),
            )
            for f in dtype.fields
        ]
        return F.concat(*parts)
    if isinstance(dtype, T.ArrayType):
        inner = F.transform(
            value,
            lambda v, i: leaves(v, dtype.elementType, F.concat(path, F.lit("["), i.cast("string"), F.lit("]"))),
        )
        empty = F.array(F.struct(path.alias("path"), F.lit("[]").alias("value")))
        return F.when(F.array_size(value) == 0, empty).otherwise(F.coalesce(F.flatten(inner), none))
    leaf = F.array(F.struct(path.alias("path"), value.cast("string").alias("value")))
    return F.when(value.isNotNull(), leaf).otherwise(none)


def document_diff(pairs: DataFrame, keys: Sequence[str], old: str, new: str) -> DataFrame:
    """Changed leaves of two versions held in one row: ``(keys, path, old_value, new_value)``.

    Both versions are in the row, so the full outer match on paths happens
    there and nothing is shuffled.
    """

    def leaf_map(name: str) -> Column:
        return F.map_from_entries(leaves(F.col(name), pairs.schema[name].dataType))

    changes = F.map_entries(
        F.map_filter(
            F.map_zip_with(
                leaf_map(old), leaf_map(new),
                lambda _, a, b: F.struct(a.alias("old_value"), b.alias("new_value")),
            ),
            lambda _, v: ~v["old_value"].eqNullSafe(v["new_value"]),
        )
    )
    return pairs.select(*keys, F.explode(changes).alias("c")).select(
        *keys, F.col("c.key").alias("path"), "c.value.old_value", "c.value.new_value"
    )


def text_diff(pairs: DataFrame, keys: Sequence[str], old: str, new: str) -> DataFrame:
    """Changed lines by position: ``(keys, line_no, old_line, new_line)``, null where a side has ended.

    Lines are compared place by place, so after an inserted line every later
    one counts as changed.
    """
    lines = F.arrays_zip(F.split(old, "\n").alias("old_line"), F.split(new, "\n").alias("new_line"))
    numbered = pairs.select(*keys, F.posexplode(lines).alias("line_no", "l")).select(*keys, "line_no", "l.*")
    return numbered.where(~F.col("old_line").eqNullSafe(F.col("new_line")))


def changed_only(docs: DataFrame, diff: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Documents that need a new check after an edit."""
    return docs.join(diff.select(*keys).distinct(), list(keys), "left_semi")


# Records that stand in for an answer that cannot be read.
UNREADABLE_FINDING = "Failed to parse audit report"
UNREADABLE_DECISION = {
    "decision": "REGENERATE_FULL",
    "reason": "Failed to parse {0}",
    "regeneration_guidance": "Please regenerate with valid JSON format",
}


def _object_or_null(answer: Column, schema: str) -> Column:
    """Struct parsed from an answer's JSON object, null when it is none."""

    def parsed(body: Column) -> Column:
        readable = F.startswith(body, F.lit("{")) & text.is_json(body)
        return F.when(readable, F.from_json(body, schema, schemas.ANY_LENGTH))

    return let(text.extract_json(answer), parsed)


def parse_audit(answer: Column, auditor: Column) -> Column:
    """Audit struct of a model answer; an unreadable one is a HIGH finding."""
    parsed = _object_or_null(answer, schemas.AUDIT)
    note = F.array(F.lit(UNREADABLE_FINDING))
    cultural = auditor == "cultural"
    error = F.struct(
        F.when(cultural, True).alias("issues_found"),
        F.when(~cultural, True).alias("violations_found"),
        F.when(cultural, note).alias("issue_descriptions"),
        F.when(~cultural, note).alias("violated_constraints"),
        F.lit("HIGH").alias("severity"),
    )
    return F.coalesce(parsed, error)


def parse_decision(answer: Column, what: str = "decision") -> Column:
    """Decision struct of a model answer; an unreadable one asks for a full redo."""
    parsed = _object_or_null(answer, schemas.DECISION)
    error = F.struct(
        *[F.lit(v.format(what)).alias(k) for k, v in UNREADABLE_DECISION.items()],
        F.lit(None).cast("string").alias("knowledge_base_rule"),
    )
    return F.coalesce(parsed, error)
