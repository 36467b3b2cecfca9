"""Event-log files: where they are, whether they are complete, and what goes into a bundle.

``log_listing(dir, poll_no, pos, path, file_size, mtime_ms)`` holds the files of each polled log directory,
``log_target(dir, scheme, run_end_ms, first_poll)`` what is waited for, and from which poll on.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens import constants as K
from fleetlens.functions.blocked import number_block, previous_value
from fleetlens.functions.lookup import left_lookup
from fleetlens.functions.paths import base_name, is_final_log
from fleetlens.functions.unnest import unnest

POLL_BLOCK = 1000


# -- finding the files ------------------------------------------------------------------------------


def files_by_prefix(listing: DataFrame, clusters: DataFrame) -> DataFrame:
    """Objects whose ``key`` starts with ``{base}/eventlog/{cluster_id}`` of a cluster.

    ``clusters(cluster_id, base)``. Each key is cut behind its ``eventlog`` folders and at the lengths that
    cluster ids of that folder have, so the prefix test becomes an equality join. Where both tables have a ``bucket``, a
    key belongs to clusters of its own bucket only.
    """
    bucket = "bucket" in listing.columns and "bucket" in clusters.columns
    place = F.concat(F.col("bucket"), F.lit("\0")) if bucket else F.lit("")
    owners = clusters.select(
        "cluster_id", F.concat(place, F.ltrim(F.concat("base", F.lit("/eventlog/")), F.lit("/"))).alias("_root")
    ).distinct()
    # At most one length per character of a name, so the set is small whatever the number of clusters.
    lengths = owners.groupBy("_root").agg(F.collect_set(F.length("cluster_id")).alias("_lengths"))
    parts = F.split("key", "/")
    cuts = F.filter(F.sequence(F.lit(1), F.size(parts)), lambda i: F.get(parts, i - 1) == "eventlog")
    rooted = (
        unnest(listing, cuts, listing.columns, "_cut")
        .withColumn("_folder", F.concat(F.array_join(F.slice(parts, F.lit(1), F.col("_cut")), "/"), F.lit("/")))
        .withColumn("_leaf", F.substr(F.col("key"), F.length("_folder") + 1))
        .withColumn("_root", F.concat(place, F.col("_folder")))
        .drop("_cut", "_folder")
    )
    return (
        rooted.join(lengths, "_root")
        .withColumn("_length", F.explode("_lengths"))
        .withColumn("cluster_id", F.left("_leaf", F.col("_length")))
        .filter(F.length("cluster_id") == F.col("_length"))
        .drop("_lengths", "_length", "_leaf")
        .join(owners, ["_root", "cluster_id"])
        .drop("_root")
    )


def log_dirs_by_context(targets: DataFrame, entries: DataFrame) -> DataFrame:
    """The log directory of each Spark context: the entry whose path contains the context id.

    ``targets(run_id, root, spark_context_id)``, ``entries(root, dir_pos, is_dir, sub_pos, path, error)`` with the
    sub-entries of the directories under a root (``pages.log_entries``). A root that couldn't be listed is the target's ``log_error``. Directories are tried from the last listed one, their
    entries from the first. A context id is all digits, so containment is an equality join with the digit
    strings of a path at the lengths the root's contexts have; only the first entry per string is joined.
    """
    wanted = targets.select("root", F.col("spark_context_id").cast("string").alias("_id")).distinct()
    # A 64-bit id has at most 19 digits.
    lengths = wanted.groupBy("root").agg(F.collect_set(F.length("_id")).alias("_lengths"))
    runs = F.regexp_extract_all("path", F.lit(r"([0-9]+)"), F.lit(1))
    pieces = F.array_distinct(F.flatten(F.flatten(F.transform(runs, lambda run: F.transform(
        F.col("_lengths"),
        lambda n: F.when(
            F.length(run) >= n,
            F.transform(F.sequence(F.lit(1), F.length(run) - n + 1), lambda i: F.substr(run, i, n)),
        ).otherwise(F.array().cast("array<string>")),
    )))))
    order = F.struct((-F.col("dir_pos")).alias("d"), F.col("sub_pos").alias("s"))
    first = (
        unnest(entries.filter("is_dir").join(lengths, "root"), pieces, ["root", "path", order.alias("_order")], "_id")
        .groupBy("root", "_id")
        .agg(F.min_by("path", "_order").alias("path"))
    )
    failed = entries.filter("error IS NOT NULL").groupBy("root").agg(F.min("error").alias("log_error"))
    return (
        targets.withColumn("_id", F.col("spark_context_id").cast("string"))
        .join(first, ["root", "_id"], "left")
        .join(failed, "root", "left")
        .drop("_id")
        .withColumnRenamed("path", "log_dir")
    )


# -- completeness -----------------------------------------------------------------------------------


def poll_summaries(listing: DataFrame) -> DataFrame:
    """Per directory and poll: total size, whether any file is empty, and when the final log was written."""
    final = is_final_log(F.col("path"))
    return listing.groupBy("dir", "poll_no").agg(
        F.sum(F.coalesce("file_size", F.lit(0))).alias("total_size"),
        F.coalesce(F.bool_or(F.col("file_size") == 0), F.lit(False)).alias("any_empty"),
        F.min_by(F.when(final, F.col("mtime_ms")), F.when(final, F.col("pos"))).alias("final_mtime_ms"),
    )


def size_changes(summaries: DataFrame) -> DataFrame:
    """Add whether the total size differs from the preceding poll's; the first poll compares with 0."""
    block = number_block(F.col("poll_no"), POLL_BLOCK)
    with_last = previous_value(summaries, ["dir"], "poll_no", "total_size", block, "last_size")
    return with_last.withColumn("last_size", F.coalesce("last_size", F.lit(0))).withColumn(
        "size_changed", F.col("total_size") != F.col("last_size")
    )


def final_flushed(run_end_ms: Column) -> Column:
    return F.coalesce(F.col("final_mtime_ms") >= run_end_ms, F.lit(False))


def verdict(scheme: Column, run_end_ms: Column, found: Column) -> Column:
    """What one look at a log directory says; columns of :func:`size_changes` are read."""
    flushed = final_flushed(run_end_ms)
    unstable = F.coalesce(F.col("any_empty") | F.col("size_changed"), F.lit(True))
    return (
        F.when(F.coalesce(scheme, F.lit("")) == "", K.NO_LOG_LOCATION)
        .when(scheme == "s3", F.when(flushed, "complete").otherwise(K.LOG_INCOMPLETE))
        .when(
            scheme == "dbfs",
            F.when(~found, "No eventlog found").when(flushed & ~unstable, "complete").otherwise(K.LOG_INCOMPLETE),
        )
        .otherwise(F.concat(F.lit("Unknown log destination: "), scheme))
    )


def completeness(targets: DataFrame, listing: DataFrame) -> DataFrame:
    """One row per target and poll (one row without poll where nothing was listed) with its verdict."""
    looks = size_changes(poll_summaries(listing))
    rows = targets.join(looks, "dir", "left")
    found = F.col("poll_no").isNotNull()
    return rows.withColumn("verdict", verdict(F.col("scheme"), F.col("run_end_ms"), found))


def _blocks_of_looks(listing: DataFrame, limit: int) -> DataFrame:
    """``(_key, _looks, polls)``: the looks at a directory by blocks of ``limit`` polls, each with those of the block after it.

    So one block holds all polls of a wait that begins in it. A row whose key is the directory alone tells its last poll.
    """
    looks = poll_summaries(listing)
    block = F.floor((F.col("poll_no") - 1) / limit)
    places = F.array(F.concat_ws(":", "dir", block.cast("string")), F.concat_ws(":", "dir", (block - 1).cast("string")), F.col("dir").cast("string"))
    entry = F.struct("poll_no", "final_mtime_ms", "any_empty", "total_size")
    dealt = looks.select(entry.alias("look"), F.posexplode(places).alias("_place", "_key"))
    return dealt.groupBy("_key").agg(
        F.array_sort(F.collect_list(F.when(F.col("_place") < 2, F.col("look")))).alias("_looks"), F.max("look.poll_no").alias("polls"))


def ready_per_wait(
    targets: DataFrame, listing: DataFrame, limit: int = K.LOG_POLL_LIMIT, spread: Sequence[str] | None = None
) -> DataFrame:
    """Per wait ``(dir, scheme, run_end_ms, first_poll)`` the first complete poll; otherwise the outcome says why not.

    Several runs may wait for one directory; other columns of the waits are kept. The ``limit`` polls of a wait count from its own first one, which
    compares sizes with 0. A DBFS directory that is missing from a poll ends the wait. ``spread`` as in :func:`left_lookup`.
    """
    blocks = _blocks_of_looks(listing, limit)
    start, end, scheme = F.col("first_poll"), F.col("run_end_ms"), F.coalesce("scheme", F.lit(""))
    own = F.concat_ws(":", F.col("dir").cast("string"), F.floor((start - 1) / limit).cast("string"))
    # As many as directories and polls: never a broadcast guessed from file sizes.
    rows = left_lookup(targets.withColumn("_key", own), blocks.drop("polls").hint("merge"), "_key", spread)
    none = F.expr("CAST(array() AS " + blocks.schema["_looks"].dataType.simpleString() + ")")
    seen = F.filter(F.coalesce("_looks", none), lambda x: (x["poll_no"] >= start) & (x["poll_no"] < start + limit))
    rows = rows.withColumn("_seen", seen)

    def complete(look: Column, at: Column) -> Column:
        # Without a gap before it, a look follows the one made a poll earlier.
        unbroken = look["poll_no"] == start + at
        before = F.when(at == 0, F.lit(0)).otherwise(F.get("_seen", at - 1)["total_size"])
        flushed = F.coalesce(look["final_mtime_ms"] >= end, F.lit(False))
        return flushed & ((scheme == "s3") | (unbroken & ~look["any_empty"] & (look["total_size"] == before)))

    polled = scheme.isin("s3", "dbfs")
    first = F.array_min(F.transform(F.filter("_seen", complete), lambda x: x["poll_no"]))
    # What is needed of the looks is two numbers; the looks themselves move no further.
    rows = rows.withColumn("ready_poll", F.when(polled, first)).withColumn("_n_seen", F.size("_seen")).drop("_looks", "_seen")
    rows = left_lookup(rows.withColumn("_key", F.col("dir").cast("string")), blocks.drop("_looks").hint("merge"), "_key", spread).drop("_key")
    # Polls of this wait that were made, as far as the directory was listed; fewer of them with files mean a gap.
    made = F.least(F.col("polls") - start + 1, F.lit(limit))
    gap = (scheme == "dbfs") & (made > F.col("_n_seen"))
    outcome = (
        F.when(scheme == "", K.NO_LOG_LOCATION)
        .when(~polled, F.concat(F.lit("Unknown log destination: "), scheme))
        .when(F.col("ready_poll").isNotNull(), "ready")
        .when((scheme == "dbfs") & F.col("polls").isNull(), "No eventlog found")
        .when(gap | (F.col("polls") >= start + limit - 1), "No eventlog found")
        .otherwise("waiting")
    )
    return rows.withColumn("outcome", outcome).drop("_n_seen")


# -- bundles ----------------------------------------------------------------------------------------


def bundle_name(path: Column, scheme: Column) -> Column:
    """Name inside the bundle; plain files from DBFS are gzipped on the way."""
    name = base_name(path)
    return F.when((scheme == "dbfs") & ~name.endswith(".gz"), F.concat(name, F.lit(".gz"))).otherwise(name)


def bundle_manifest(targets: DataFrame, listing: DataFrame) -> DataFrame:
    """All files that each ready wait found, with the name they get in its bundle. Other columns of the waits are kept."""
    ready = ready_per_wait(targets, listing).filter(F.col("outcome") == "ready")
    ready = ready.select(*targets.columns, F.col("ready_poll").alias("poll_no"))
    files = listing.select("dir", "poll_no", "path", "file_size").join(ready, ["dir", "poll_no"])
    return files.select(
        *targets.columns, "poll_no", "path", bundle_name(F.col("path"), F.col("scheme")).alias("bundle_name"), "file_size"
    )
