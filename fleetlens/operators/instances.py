"""Cloud instances, disks and their lifetimes rebuilt from polling snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fleetlens import constants as K
from fleetlens.functions.blocked import day_block, number_block, previous_value, running_number
from fleetlens.functions.status import is_running
from fleetlens.functions.unnest import unnest

# Polls per block when runs of consecutive polls are looked for.
POLL_BLOCK = 4096


def tag_value(tags: Column, key: str) -> Column:
    """The value of a tag in ``array<struct<Key,Value>>``; NULL for missing tags and missing arrays."""
    return F.get(F.filter(tags, lambda t: t["Key"] == key), F.lit(0))["Value"]


def has_vendor_tag(tags: Column) -> Column:
    return F.coalesce(F.exists(tags, lambda t: (t["Key"] == K.VENDOR_TAG) & (t["Value"] == K.VENDOR)), F.lit(False))


def ec2_instances(listed: DataFrame) -> DataFrame:
    """Listed instances (``pages.instances``) → the platform's with their cluster; the whole instance stays as ``document``."""
    return listed.filter(has_vendor_tag(F.col("Tags"))).select(
        tag_value(F.col("Tags"), K.CLUSTER_TAG).alias("cluster_id"),
        F.col("InstanceId").alias("instance_id"),
        F.col("State.Name").alias("state"),
        "document",
    ).filter(F.col("cluster_id").isNotNull())


def ebs_volumes(volumes: DataFrame, instances: DataFrame) -> DataFrame:
    """(cluster, volume) for every platform volume (``pages.volumes``) attached to one of the cluster's instances.

    A volume attached to several instances of a cluster counts once.
    """
    attached = (
        volumes.filter(has_vendor_tag(F.col("Tags")))
        .select(F.col("VolumeId").alias("volume_id"), F.explode("Attachments").alias("a"))
        .select("volume_id", F.col("a.InstanceId").alias("instance_id"))
    )
    owned = instances.select("instance_id", "cluster_id").distinct()
    return attached.join(owned, "instance_id").select("cluster_id", "volume_id").distinct()


def azure_vms(vms: DataFrame, views: DataFrame) -> DataFrame:
    """Platform VMs (``pages.vms``) with the statuses of their instance view; VMs without tags are not the platform's."""
    tagged = vms.filter(F.coalesce(F.col("tags")[K.VENDOR_TAG] == K.VENDOR, F.lit(False)))
    return (
        tagged.withColumn("cluster_id", F.col("tags")[K.CLUSTER_TAG])
        .filter(F.col("cluster_id").isNotNull())
        .join(views.select("vm_name", "statuses"), "vm_name", "left")
        .select("cluster_id", F.col("vm_name").alias("instance_id"), "group_known", "statuses", "document")
    )


def running_only(instances: DataFrame) -> DataFrame:
    """Rows of ``(platform, cluster_id, instance_id, state, statuses, group_known)`` that count as running."""
    return instances.filter(
        is_running(F.col("platform"), F.col("state"), F.col("statuses"), F.col("group_known"))
    )


def fleet_counts(instances: DataFrame, cluster_volumes: DataFrame) -> DataFrame:
    per_instance = instances.groupBy("cluster_id").agg(F.count("*").alias("n_instances"))
    per_volume = cluster_volumes.groupBy("cluster_id").agg(F.count("*").alias("n_volumes"))
    return per_instance.join(per_volume, "cluster_id", "full").select(
        "cluster_id",
        F.coalesce("n_instances", F.lit(0)).alias("n_instances"),
        F.coalesce("n_volumes", F.lit(0)).alias("n_volumes"),
    )


def number_polls(polls: DataFrame) -> DataFrame:
    """Distinct (cluster, poll time) with the poll's number within its cluster and the number of the last one."""
    times = polls.select("cluster_id", "poll_ts").distinct()
    return running_number(times, ["cluster_id"], ["poll_ts"], day_block(F.col("poll_ts")), "seq", total="last_seq")


def instance_timelines(polls: DataFrame, observations: DataFrame) -> DataFrame:
    """Intervals of consecutive polls that saw an instance running.

    ``polls(cluster_id, poll_ts)`` lists every poll, also those that saw nothing;
    ``observations(cluster_id, poll_ts, instance_id)`` what they saw. An instance missing from one poll is
    retired at its last sighting; when it returns a new interval opens.

    Runs are found within blocks of polls first. Only runs that touch a block's edge are then joined in
    poll order per instance, at most two per block, so an instance or cluster with a large share of all
    sightings stays spread over many tasks.
    """
    numbered = number_polls(polls)
    instance = ["cluster_id", "instance_id"]
    seen = (
        observations.select(*instance, "poll_ts").distinct()
        .join(numbered, ["cluster_id", "poll_ts"])
        .withColumn("_block", number_block(F.col("seq"), POLL_BLOCK))
    )
    within = W.partitionBy(*instance, "_block").orderBy("seq")
    runs = (
        seen.withColumn("_run", F.col("seq") - F.row_number().over(within))
        .groupBy(*instance, "_block", "_run")
        .agg(
            F.min("seq").alias("_from"), F.max("seq").alias("_to"),
            F.min("poll_ts").alias("_first"), F.max("poll_ts").alias("_last"),
            F.bool_or(F.col("seq") == F.col("last_seq")).alias("_active"),
        )
    )
    at_edge = (F.col("_from") % POLL_BLOCK == 0) | (F.col("_to") % POLL_BLOCK == POLL_BLOCK - 1)
    alone = F.when(~at_edge, F.col("_from"))
    chain = W.partitionBy(*instance, "_alone").orderBy("_from")
    opens = F.when(F.col("_from") == F.lag("_to").over(chain) + 1, 0).otherwise(1)
    return (
        runs.withColumn("_alone", alone)
        .withColumn("_opens", opens)
        .withColumn("_nr", F.sum("_opens").over(chain.rowsBetween(W.unboundedPreceding, W.currentRow)))
        .groupBy(*instance, "_alone", "_nr")
        .agg(
            F.min("_first").alias("first_seen"), F.max("_last").alias("last_seen"),
            F.bool_or("_active").alias("is_active"),
        )
        .select(*instance, "first_seen", "last_seen", "is_active")
    )


def timelines_all(retired: DataFrame, active: DataFrame) -> DataFrame:
    return retired.unionByName(active)


def retired_at_poll(polls: DataFrame, observations: DataFrame) -> DataFrame:
    """Instances that the preceding poll of their cluster saw and this one does not."""
    times = polls.select("cluster_id", "poll_ts").distinct()
    steps = previous_value(
        times, ["cluster_id"], "poll_ts", "poll_ts", day_block(F.col("poll_ts")), "last_seen"
    ).filter(F.col("last_seen").isNotNull())
    seen = observations.select("cluster_id", "instance_id", "poll_ts").distinct()
    before = steps.join(seen.withColumnRenamed("poll_ts", "last_seen"), ["cluster_id", "last_seen"])
    return before.join(seen, ["cluster_id", "instance_id", "poll_ts"], "left_anti").select(
        "cluster_id", "instance_id", F.col("poll_ts").alias("retired_at"), "last_seen"
    )


def inventory_latest(sightings: DataFrame, order: list[str], payload: list[str]) -> DataFrame:
    """Per (cluster, instance) the newest sighting; instances no longer seen stay."""
    top = F.max_by(F.struct(*payload), F.struct(*order))
    return (
        sightings.groupBy("cluster_id", "instance_id").agg(top.alias("_top"))
        .select("cluster_id", "instance_id", "_top.*")
    )


def usable_polls(polls: DataFrame, stop_on_termination: bool = True) -> DataFrame:
    """Drop failed polls, and with ``stop_on_termination`` those after the first poll of a terminated cluster."""
    worked = polls.filter("ok")
    if not stop_on_termination:
        return worked
    stops = worked.filter(F.col("state") == "TERMINATED").groupBy("cluster_id").agg(
        F.min("poll_ts").alias("_stop")
    )
    return (
        worked.join(stops, "cluster_id", "left")
        .filter(F.col("_stop").isNull() | (F.col("poll_ts") <= F.col("_stop")))
        .drop("_stop")
    )


def monitored_clusters(polls: DataFrame, observations: DataFrame, stop_on_termination: bool = True) -> DataFrame:
    """Timelines over the polls a monitor would have applied."""
    applied = usable_polls(polls, stop_on_termination)
    kept = observations.join(applied.select("cluster_id", "poll_ts").distinct(), ["cluster_id", "poll_ts"], "left_semi")
    return instance_timelines(applied, kept)


def monitor_step(state: DataFrame, poll: DataFrame, observations: DataFrame) -> DataFrame:
    """Apply one poll per cluster to the timelines of all earlier polls; unpolled clusters do not change."""
    instance = ["cluster_id", "instance_id"]
    now = observations.select(*instance, F.col("poll_ts").alias("_now")).distinct()
    polled = poll.select("cluster_id", F.lit(True).alias("_polled")).distinct()
    active = state.filter("is_active").drop("is_active").join(polled, "cluster_id", "left")
    stepped = active.join(now, instance, "full").select(
        *instance,
        F.coalesce("first_seen", "_now").alias("first_seen"),
        F.coalesce("_now", "last_seen").alias("last_seen"),
        (F.col("_now").isNotNull() | F.col("_polled").isNull()).alias("is_active"),
    )
    return state.filter(~F.col("is_active")).select(*stepped.columns).unionByName(stepped)
