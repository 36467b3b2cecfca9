"""Locations: hosts, URLs, log destinations and file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetlens import constants as K

_SCHEME = r"^([A-Za-z][A-Za-z0-9+.\-]*):"
_AUTHORITY = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)"
_PATH = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)"


def strip_slashes(col: Column) -> Column:
    return F.trim(col, F.lit("/"))


def url_scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, _SCHEME, 1))


def url_authority(url: Column) -> Column:
    # Not parse_url: it yields NULL for bucket names that are no valid host names.
    return F.regexp_extract(url, _AUTHORITY, 1)


def url_path(url: Column) -> Column:
    return F.regexp_extract(url, _PATH, 1)


def normalized_host(host: Column) -> Column:
    """``https://`` plus the authority part; empty or missing hosts give NULL."""
    return F.when(F.coalesce(host, F.lit("")) != "", F.concat(F.lit("https://"), url_authority(host)))


def platform_of(host: Column) -> Column:
    name = url_authority(host)
    return F.when(name.endswith(K.AZURE_HOST_SUFFIX), "azure").when(name.endswith(K.AWS_HOST_SUFFIX), "aws")


def product_code(platform: Column) -> Column:
    return F.when(platform == "aws", K.PRODUCT_CODES["aws"]).when(platform == "azure", K.PRODUCT_CODES["azure"])


def log_destination(s3_url: Column, dbfs_url: Column, cluster_id: Column) -> Column:
    """struct(url, scheme, bucket, base) of a cluster's log delivery; the S3 setting goes before the DBFS one."""
    url = F.coalesce(F.nullif(s3_url, F.lit("")), F.nullif(dbfs_url, F.lit("")))
    base = strip_slashes(F.concat(strip_slashes(url_path(url)), F.lit("/"), cluster_id))
    return F.struct(
        url.alias("url"),
        F.when(url.isNotNull(), url_scheme(url)).alias("scheme"),
        F.when(url.isNotNull(), url_authority(url)).alias("bucket"),
        F.when(url.isNotNull(), base).alias("base"),
    )


def eventlog_prefix(base: Column, cluster_id: Column) -> Column:
    return strip_slashes(F.concat(base, F.lit("/eventlog/"), cluster_id))


def info_file_key(base: Column, context_id: Column, platform: Column) -> Column:
    name = F.when(platform == "azure", K.INFO_FILE["azure"]).otherwise(K.INFO_FILE["aws"])
    return strip_slashes(F.concat(base, F.lit("/sync_data/"), context_id.cast("string"), F.lit("/"), name))


def dbfs_path(path: Column) -> Column:
    bare = strip_slashes(path)
    return F.when(F.contains(bare, F.lit("dbfs:/")), bare).otherwise(F.concat(F.lit("dbfs:/"), bare))


def base_name(path: Column) -> Column:
    return F.substring_index(F.rtrim(path, F.lit("/")), "/", -1)


def file_stem(path: Column) -> Column:
    """Base name without its last suffix; a leading dot starts no suffix."""
    return F.regexp_replace(base_name(path), r"(?<=.)[.][^.]+$", "")


def is_final_log(path: Column) -> Column:
    return file_stem(path).isin(K.FINAL_LOG_STEMS)


def log_url_class(url: Column) -> Column:
    scheme = url_scheme(url)
    return (
        F.when(scheme == "s3", "presign")
        .when(scheme.isin("http", "https"), "as_is")
        .otherwise(K.BAD_LOG_URL)
    )


def sink_target(
    platform: Column,
    destination: Column,
    cluster_id: Column,
    context_id: Column,
    override_filesystem: str | None = None,
    override_prefix: str | None = None,
) -> Column:
    """struct(filesystem, target, error) of a cluster-info document.

    An override replaces the filesystem and the prefix, and makes a cluster without log delivery writable.
    """
    filesystem = F.lit(override_filesystem) if override_filesystem else destination["scheme"]
    base = F.lit(override_prefix) if override_prefix else destination["base"]
    key = info_file_key(F.coalesce(base, F.lit("")), context_id, platform)
    overridden = override_filesystem is not None or override_prefix is not None
    reachable = F.lit(True) if overridden else destination["url"].isNotNull()
    supported = F.when(platform == "azure", filesystem.isin(K.SINK_FILESYSTEMS["azure"])).otherwise(
        filesystem.isin(K.SINK_FILESYSTEMS["aws"])
    )
    target = (
        F.when(filesystem == "s3", F.concat(F.lit("s3://"), destination["bucket"], F.lit("/"), key))
        .when(filesystem == "dbfs", dbfs_path(key))
        .when(filesystem == "file", key)
        .when(filesystem == "lambda", F.lit("lambda"))
    )
    error = (
        F.when(context_id.isNull(), "missing spark context")
        .when(~reachable, "missing cluster log destination")
        .when(~F.coalesce(supported, F.lit(False)),
              F.concat(F.lit("Unsupported filesystem: "), F.coalesce(filesystem, F.lit("None"))))
    )
    return F.struct(
        filesystem.alias("filesystem"),
        F.when(error.isNull(), target).alias("target"),
        error.alias("error"),
    )
