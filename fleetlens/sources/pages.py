"""Pages of listings as the services deliver them, JSON text, to rows.

Each reader takes a table of pages and a text column and gives a row per listed item, in page order (``pos``), with the members that operators
read as columns and the whole item as ``document`` (VARIANT), so nothing that was delivered is lost. Other columns of the pages stay. A page
without its list is an empty page; a page that says it failed gives no item (see :func:`page_errors`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens import constants as K
from fleetlens.functions.merge import items, text_at
from fleetlens.functions.unnest import unnest

_TAGS = "array<struct<Key:string,Value:string>>"


def _listed(pages: DataFrame, text: str, lists: Column) -> DataFrame:
    keep = [c for c in pages.columns if c != text]
    return unnest(pages, lists, keep, "document", "pos")


def _at(path: str, kind: str) -> Column:
    return F.try_variant_get("document", path, kind)


def _page_list(text: str, name: str) -> Column:
    return items(F.variant_get(F.try_parse_json(text), f"$.{name}", "variant"))


def instances(pages: DataFrame, text: str = "value") -> DataFrame:
    """``Reservations[].Instances[]`` → InstanceId, State, Tags."""
    each = F.transform(_page_list(text, "Reservations"), lambda r: F.coalesce(items(F.variant_get(r, "$.Instances", "variant")), F.array()))
    rows = _listed(pages, text, F.flatten(each))
    return rows.withColumns({
        "InstanceId": _at("$.InstanceId", "string"), "State": F.struct(_at("$.State.Name", "string").alias("Name")), "Tags": _at("$.Tags", _TAGS)})


def volumes(pages: DataFrame, text: str = "value") -> DataFrame:
    """``Volumes[]`` → VolumeId, Tags, Attachments."""
    return _listed(pages, text, _page_list(text, "Volumes")).withColumns({
        "VolumeId": _at("$.VolumeId", "string"), "Tags": _at("$.Tags", _TAGS),
        "Attachments": _at("$.Attachments", "array<struct<InstanceId:string>>")})


def vms(pages: DataFrame, text: str = "value") -> DataFrame:
    """``value[]`` → vm_name, tags."""
    return _listed(pages, text, _page_list(text, "value")).withColumns({
        "vm_name": _at("$.name", "string"), "tags": _at("$.tags", "map<string,string>")})


def vm_views(documents: DataFrame, text: str = "value") -> DataFrame:
    """Instance views, one document each → vm_name, statuses."""
    rows = documents.withColumn("document", F.try_parse_json(text)).drop(text)
    return rows.withColumns({"vm_name": _at("$.name", "string"), "statuses": _at("$.statuses", "array<struct<code:string>>")})


def objects(pages: DataFrame, text: str = "value") -> DataFrame:
    """``Contents[]`` of a bucket → key, file_size, mtime_ms."""
    return _listed(pages, text, _page_list(text, "Contents")).withColumns({
        "key": _at("$.Key", "string"), "file_size": _at("$.Size", "bigint"),
        "mtime_ms": F.unix_millis(F.to_timestamp(_at("$.LastModified", "string")))})


def files(pages: DataFrame, text: str = "value") -> DataFrame:
    """``files[]`` of a DBFS folder → path, is_dir, file_size, mtime_ms."""
    return _listed(pages, text, _page_list(text, "files")).withColumns({
        "path": _at("$.path", "string"), "is_dir": F.coalesce(_at("$.is_dir", "boolean"), F.lit(False)), "file_size": _at("$.file_size", "bigint"),
        "mtime_ms": _at("$.modification_time", "bigint")})


def page_errors(pages: DataFrame, text: str = "value") -> DataFrame:
    """Pages that say why there is no listing, with ``error``."""
    page = F.try_parse_json(text)
    code = text_at(page, "$.error_code")
    rows = pages.withColumn("error", F.concat(F.lit(f"{K.API_ERROR_CODE}: "), code, F.lit(": "), F.coalesce(text_at(page, "$.message"), F.lit(""))))
    return rows.filter(F.col("error").isNotNull()).drop(text)


def log_entries(roots: DataFrame, folders: DataFrame) -> DataFrame:
    """Entries of the folders under log roots, for ``eventlog.log_dirs_by_context``.

    ``roots(root, value)`` are listings of roots, ``folders(folder, value)`` of what lies under them. A root that couldn't be listed is one row
    with ``error``.
    """
    dirs = files(roots).select("root", F.col("pos").alias("dir_pos"), "is_dir", F.rtrim("path", F.lit("/")).alias("folder"))
    inside = files(folders.withColumn("folder", F.rtrim("folder", F.lit("/")))).select("folder", F.col("pos").alias("sub_pos"), "path")
    entries = dirs.join(inside, "folder").drop("folder")
    failed = page_errors(roots).select("root", F.concat(F.lit(K.NO_LOG_ROOT), F.col("root")).alias("error"))
    return entries.unionByName(failed, allowMissingColumns=True)
