"""Whole JSON documents (VARIANT): reading members, replacing them, and deep merge.

Nothing here knows a schema, so keys that no schema lists survive at every level. A missing key and an explicit null differ: a
missing key keeps the base's value, an explicit null replaces it. Everything is an expression inside the row, without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Patches that nest deeper than this are not merged (see :func:`patch_depth`).
MOST_NESTED = 100


def parse_patch(text: Column) -> Column:
    """JSON text as a patch; NULL text and malformed text patch nothing."""
    return F.try_parse_json(text)


def members(document: Column) -> Column:
    """An object's members as a map; NULL for anything else."""
    return F.try_variant_get(document, "$", "map<string,variant>")


def items(document: Column) -> Column:
    """An array's items; NULL for anything else."""
    return F.try_variant_get(document, "$", "array<variant>")


def text_at(document: Column, path: str) -> Column:
    return F.try_variant_get(document, path, "string")


def is_blank_object(document: Column) -> Column:
    """Missing, null, or without any member."""
    return F.coalesce(F.size(F.map_keys(members(document))) < 1, F.lit(True))


def nesting(document: Column) -> Column:
    """How many objects and arrays lie in one another, at most."""
    return _nested(_brackets(document))


def _brackets(document: Column) -> Column:
    """The brackets of a document's schema: few different texts, however many documents."""
    schema = F.schema_of_variant(document)
    unnamed = F.when(F.contains(schema, F.lit("`")), F.regexp_replace(schema, "`(?:[^`]|``)*`", "")).otherwise(schema)
    return F.regexp_replace(unnamed, "[^<>]+", "")


def _nested(brackets: Column) -> Column:
    steps = F.split(brackets, "")
    zero = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"))

    def step(at: Column, c: Column) -> Column:
        now = at["now"] + F.when(c == "<", 1).when(c == ">", -1).otherwise(0)
        return F.struct(now.alias("now"), F.greatest(at["most"], now).alias("most"))

    return F.aggregate(steps, zero, step)["most"]


def patch_depth(patches: DataFrame, patch: str) -> int:
    """The nesting of the deepest patch of a table, 0 without any: how far :func:`merge_documents` has to look."""
    kinds = patches.select(_brackets(F.col(patch)).alias("_brackets")).distinct()
    return kinds.select(F.coalesce(F.max(_nested(F.col("_brackets"))), F.lit(0)).alias("n")).first()["n"]


def merge_documents(base: Column, patch: Column, depth: int) -> Column:
    """Apply a patch to a document: objects merge member by member, arrays are concatenated (base first), anything else is replaced.

    A SQL NULL patch changes nothing. ``depth`` is that of the deepest patch; the expression is built that deep. Where it is beyond
    ``MOST_NESTED``, patches that nest deeper give NULL.
    """
    merged = F.when(patch.isNull(), base).when(base.isNull(), patch).otherwise(_merged(base, patch, min(depth, MOST_NESTED)))
    if depth > MOST_NESTED:
        merged = F.when(nesting(patch) <= MOST_NESTED, merged).when(patch.isNull(), base)
    return merged


def _merged(base: Column, patch: Column, depth: int) -> Column:
    if depth == 0:
        return patch

    def member(_: Column, old: Column, new: Column) -> Column:
        return F.when(new.isNull(), old).when(old.isNull(), new).otherwise(_merged(old, new, depth - 1))

    # Each is NULL unless both sides are of its kind.
    objects = F.to_variant_object(F.map_zip_with(members(base), members(patch), member))
    arrays = F.to_variant_object(F.concat(items(base), items(patch)))
    return F.coalesce(objects, arrays, patch)


def without_keys(document: Column, *keys: str) -> Column:
    """An object without the given members; other values stay as they are."""
    kept = F.map_filter(members(document), lambda key, value: ~key.isin(*keys))
    return F.coalesce(F.to_variant_object(kept), document)


def with_keys(document: Column, **values: Column) -> Column:
    """An object with the given members set (VARIANT values); a NULL value removes the member."""
    kept = F.map_filter(members(document), lambda key, value: ~key.isin(*values))
    pairs = [F.struct(F.lit(name).alias("key"), value.alias("value")) for name, value in values.items()]
    new = F.map_from_entries(F.filter(F.array(*pairs), lambda p: p["value"].isNotNull()))
    return F.to_variant_object(F.map_concat(kept, new))


def object_of(**values: Column) -> Column:
    """An object of the given members (VARIANT values); members that are NULL are left out."""
    return with_keys(F.parse_json(F.lit("{}")), **values)


def array_of(values: Column) -> Column:
    """An array column of VARIANT as a document."""
    return F.to_variant_object(values)


def scalar(value: Column) -> Column:
    return value.cast("variant")
