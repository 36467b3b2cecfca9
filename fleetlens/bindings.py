"""Telemetry tables derived from the supplied business tables.

The supplied data holds no telemetry. Each method writes one telemetry table as a deterministic
projection or grouping of a whole supplied table, so operators and their SQL counterparts see the same rows.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fleetlens import constants as K
from fleetlens.functions.blocked import running_number
from fleetlens.functions.paths import log_destination
from fleetlens.plans.telemetry import Telemetry
from fleetlens.session import tune
from fleetlens.sources import pages

# Schemas of the supplied files read so far, so that a file's footer is looked at once per process.
_SCHEMAS: dict[str, StructType] = {}

# 16 January 2024, 12:00 UTC, in the middle of the supplied events.
RUN_END_MS = 1705406400000

DEFINITION = (
    "struct<cluster_name string, node_type_id string, num_workers bigint,"
    " autoscale struct<min_workers bigint, max_workers bigint>, custom_tags map<string,string>,"
    " spark_conf map<string,string>, policy_id string, autotermination_minutes bigint,"
    " init_scripts array<string>, cluster_log_conf struct<dbfs struct<destination string>>>"
)


def tag(prefix: str, value: Column) -> Column:
    return F.concat(F.lit(prefix), value.cast("string"))


def project_tags(project: Column) -> Column:
    """A tag map; a NULL project leaves the map without the project tag."""
    return F.when(project.isNotNull(), F.create_map(F.lit(K.PROJECT_TAG), project)).otherwise(
        F.create_map(F.lit("team"), F.lit("x"))
    )


def definition(**fields: Column) -> Column:
    """A cluster definition with the given fields; the others are absent."""
    names = ["cluster_name", "node_type_id", "num_workers", "autoscale", "custom_tags", "spark_conf",
             "policy_id", "autotermination_minutes", "init_scripts", "cluster_log_conf"]
    return F.struct(*[fields.get(n, F.lit(None)).alias(n) for n in names]).cast(DEFINITION)


def epoch_ms(ts: Column) -> Column:
    return F.unix_millis(ts.cast("timestamp"))


class Bindings:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = tune(spark)
        self.sf_dir = sf_dir.rstrip("/")
        self._tables: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        """A supplied table."""
        if name not in self._tables:
            self._tables[name] = self._read(name)
        return self._tables[name]

    def _read(self, name: str) -> DataFrame:
        path = f"{self.sf_dir}/{name}.parquet"
        if path not in _SCHEMAS:
            _SCHEMAS[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_SCHEMAS[path]).parquet(path)

    # -- runs -------------------------------------------------------------------------------------

    @cached_property
    def task(self) -> DataFrame:
        part, supp, run = F.col("part"), F.col("supp"), F.col("run_id")
        slot = supp % 3
        started = part % 11 != 0
        inline = part % 5 == 0
        project = F.when(part % 3 != 0, tag("p", part % 4))
        key = F.when(part % 7 == 0, "missing").otherwise(
            tag("k", slot + F.when(part % 13 == 0, 1).otherwise(0))
        )
        return (
            self.raw("lineitem")
            .groupBy(F.col("l_orderkey").alias("run_id"), F.col("l_linenumber").alias("pos"))
            .agg(
                F.min("l_partkey").alias("part"),
                F.min("l_suppkey").alias("supp"),
                F.max("l_shipdate").alias("ship"),
                F.bool_or(F.col("l_returnflag") == "R").alias("failed"),
            )
            .select(
                "run_id",
                "pos",
                tag("t", F.col("pos")).alias("task_key"),
                F.when(inline, definition(node_type_id=tag("n", part % 5), num_workers=part % 8,
                                          custom_tags=project_tags(project))).alias("new_cluster"),
                F.when(~inline, key).alias("job_cluster_key"),
                F.when(started, F.concat(run.cast("string"), F.lit("-c"), slot.cast("string")))
                .alias("cluster_id"),
                F.when(started, run * 10 + slot).alias("spark_context_id"),
                F.when(F.col("failed"), "FAILED").otherwise("SUCCESS").alias("result_state"),
                epoch_ms(F.col("ship")).alias("end_time_ms"),
            )
        )

    @cached_property
    def job_cluster(self) -> DataFrame:
        k, cust = F.col("k"), F.col("o_custkey")
        owner = (cust + k) % 4
        return (
            self.raw("orders")
            .select("o_orderkey", "o_custkey", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("k"))
            .select(
                F.col("o_orderkey").alias("run_id"),
                k.alias("pos"),
                tag("k", k).alias("job_cluster_key"),
                definition(node_type_id=tag("n", cust % 5), num_workers=F.col("o_orderkey") % 8,
                           custom_tags=project_tags(F.when(owner != 0, tag("p", owner)))).alias("new_cluster"),
            )
        )

    @cached_property
    def request(self) -> DataFrame:
        run = F.col("o_orderkey")
        return self.raw("orders").select(
            run.alias("run_id"),
            F.when(run % 3 != 0, tag("p", run % 5)).alias("project_id"),
            F.when(run % 2 == 0, tag("job_clusters/k", run % 3)).alias("cluster_path"),
        )

    @cached_property
    def run(self) -> DataFrame:
        """Runs and their jobs: the runs of a customer are runs of the job of the first of them."""
        orders = self.raw("orders")
        first = orders.groupBy("o_custkey").agg(F.min("o_orderkey").alias("job_id"))
        return orders.join(first, "o_custkey").select(F.col("o_orderkey").alias("run_id"), "job_id")

    # -- projects, submissions, recommendations ---------------------------------------------------

    @cached_property
    def project(self) -> DataFrame:
        key, segment = F.col("c_custkey"), F.col("c_mktsegment")
        return self.raw("customer").select(
            tag("p", key).alias("project_id"),
            F.concat(segment, (key % 50).cast("string")).alias("app_id"),
            F.when(segment == "BUILDING", "GRADIENT_ML").when(segment == "HOUSEHOLD", "UNASSIGNED")
            .otherwise("OTHER").alias("project_model_id"),
            (F.col("c_acctbal") > 0).alias("auto_apply_recs"),
            key.alias("created_at"),
            F.col("c_name").alias("description"),
            (key % 2 == 0).alias("optimize_instance_size"),
        )

    @cached_property
    def project_patch(self) -> DataFrame:
        key = F.col("c_custkey")
        return self.raw("customer").select(
            tag("p", key).alias("project_id"),
            F.when(key % 3 == 0, "").when(key % 3 == 2, tag("new ", key)).alias("description"),
            F.when(key % 4 != 0, key % 4 != 1).alias("auto_apply_recs"),
            F.when(key % 5 != 1, key % 5 != 0).alias("optimize_instance_size"),
        )

    @cached_property
    def submission(self) -> DataFrame:
        key = F.col("o_orderkey")
        config = F.struct(tag("n", key % 7).alias("node_type_id"), (key % 8).alias("num_workers"))
        return self.raw("orders").select(
            key.alias("id"),
            tag("p", F.col("o_custkey")).alias("project_id"),
            epoch_ms(F.col("o_orderdate")).alias("created_at"),
            F.when(F.col("o_orderstatus") == "F", "SUCCESS").when(F.col("o_orderstatus") == "O", "FAILED")
            .otherwise("PENDING").alias("state"),
            F.when(key % 11 != 0, config).alias("configuration"),
        )

    @cached_property
    def recommendation(self) -> DataFrame:
        """``recommendation.configuration`` is JSON text, as delivered."""
        key = F.col("o_orderkey")
        text = F.format_string(
            '{"node_type_id":"n%d","num_workers":%d,"custom_tags":{"sync:run-id":"r%d","team":"y"},'
            '"init_scripts":["s%d"]%s}',
            key % 7, key % 8, key, key % 3, F.when(key % 9 == 0, ',"policy_id":null').otherwise(""),
        )
        return self.raw("orders").select(
            key.alias("id"),
            tag("p", F.col("o_custkey")).alias("project_id"),
            epoch_ms(F.col("o_orderdate")).alias("created_at"),
            F.when(F.col("o_orderstatus") == "F", "SUCCESS").when(F.col("o_orderstatus") == "O", "FAILURE")
            .otherwise("PENDING").alias("state"),
            F.when(key % 5 != 0, F.struct(F.when(key % 7 != 0, text).alias("configuration")))
            .alias("recommendation"),
        )

    @cached_property
    def project_reference(self) -> DataFrame:
        """Values that users type for a project: UUIDs in several spellings, app ids and unknown names."""
        key = F.col("c_custkey")
        digits = F.md5(F.col("c_name"))
        dashed = F.regexp_replace(digits, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
        return self.raw("customer").select(
            F.when(key % 6 == 0, dashed)
            .when(key % 6 == 1, F.concat(F.lit("{"), digits, F.lit("}")))
            .when(key % 6 == 2, F.concat(F.lit("urn:uuid:"), dashed))
            .when(key % 6 == 3, tag("unknown", key))
            .otherwise(F.concat(F.col("c_mktsegment"), (key % 60).cast("string"))).alias("value")
        )

    @cached_property
    def response(self) -> DataFrame:
        key = F.col("c_custkey")
        return self.raw("customer").select(
            key.alias("response_id"),
            F.when(key % 3 != 0, F.struct(F.col("c_name").alias("id"))).alias("result"),
            F.when(key % 4 == 1, "").when(key % 4 != 0, F.col("c_mktsegment")).alias("error_code"),
            F.when(key % 5 != 0, F.col("c_name")).alias("message"),
        )

    # -- workspaces -------------------------------------------------------------------------------

    @cached_property
    def workspace(self) -> DataFrame:
        key, nation = F.col("s_suppkey"), F.col("s_nationkey")
        return self.raw("supplier").select(
            tag("w", key).alias("workspace_id"),
            F.when(key % 3 == 0, F.concat(tag("https://adb-", key), F.lit(".azuredatabricks.net")))
            .when(key % 3 == 1, F.concat(tag("https://dbc-", key), F.lit(".cloud.databricks.com/?o=1")))
            .otherwise(F.concat(tag("https://", key), F.lit(".example.com"))).alias("databricks_host"),
            F.when(key % 4 == 0, "Standard").when(key % 4 == 1, "Premium").when(key % 4 == 2, "Enterprise")
            .otherwise("Trial").alias("databricks_plan_type"),
            F.when(key % 11 == 0, None).when(key % 2 == 0, "hosted").otherwise("remote").alias("collection_type"),
            F.when(key % 5 == 1, "hypervisor").when(key % 5 != 0, "webhook").alias("monitoring_type"),
            F.when(key % 13 == 0, "gcp").when(key % 3 == 0, "azure").otherwise("aws").alias("compute_provider"),
            F.when(nation % 4 == 1, "us-east-1").when(nation % 4 == 2, "eu-west-2")
            .when(nation % 4 == 3, "mars-1").alias("aws_region"),
            F.when(key % 5 != 0, tag("arn:i", key)).alias("instance_profile_arn"),
            F.when(key % 7 != 0, tag("arn:r", key)).alias("aws_iam_role_arn"),
            F.when(nation % 2 != 0, "tenant").alias("azure_tenant_id"),
            F.when(nation % 3 != 0, "client").alias("azure_client_id"),
            F.when(nation % 5 != 0, "secret").alias("azure_client_secret"),
            F.when(nation % 7 != 0, "subscription").otherwise("").alias("azure_subscription_id"),
        )

    @cached_property
    def workspace_patch(self) -> DataFrame:
        key = F.col("s_suppkey")

        def value(i: int, new: str) -> Column:
            return F.when((key + i) % 3 == 1, "null").when((key + i) % 3 == 2, new)

        return self.raw("supplier").select(
            tag("w", key).alias("workspace_id"),
            value(0, "us-west-2").alias("aws_region"),
            value(1, "Premium").alias("databricks_plan_type"),
            value(2, "arn:new").alias("aws_iam_role_arn"),
        )

    @cached_property
    def log_url(self) -> DataFrame:
        key, url = F.col("page_id"), F.col("url")
        rest = F.regexp_replace(url, "^[a-z]+", "")
        return self.raw("pages").select(
            "page_id",
            F.when(key % 4 == 0, F.concat(F.lit("s3"), rest)).when(key % 4 == 1, F.concat(F.lit("dbfs"), rest))
            .otherwise(url).alias("url"),
        )

    # -- fleet ------------------------------------------------------------------------------------

    @cached_property
    def reservation_page(self) -> DataFrame:
        user = F.col("user_id")

        def pair(key: str, value: Column) -> Column:
            return F.struct(F.lit(key).alias("Key"), value.alias("Value"))

        vendor = F.when(user % 9 != 0, K.VENDOR).otherwise("other")
        instance = F.struct(
            user.cast("string").alias("InstanceId"),
            F.struct(F.when(user % 4 != 0, "running").otherwise("stopped").alias("Name")).alias("State"),
            F.array(pair(K.VENDOR_TAG, vendor), pair(K.CLUSTER_TAG, (user % 5).cast("string"))).alias("Tags"),
            tag("m", user % 3).alias("InstanceType"),
        )
        page = F.struct(F.array(F.struct(F.array(instance).alias("Instances"))).alias("Reservations"))
        return self.raw("events").select("user_id").distinct().select(F.to_json(page).alias("value"))

    @cached_property
    def instance(self) -> DataFrame:
        return pages.instances(self.reservation_page)

    def _pages(self, rows: DataFrame, page: Column, item: Column, name: str) -> DataFrame:
        """JSON pages of a bounded number of items."""
        grouped = rows.groupBy(page.alias("_page")).agg(F.collect_list(item).alias(name))
        return grouped.select(F.to_json(F.struct(name)).alias("value"))

    @cached_property
    def volume(self) -> DataFrame:
        key, cust = F.col("o_orderkey"), F.col("o_custkey")

        def attachment(owner: Column) -> Column:
            return F.struct(owner.cast("string").alias("InstanceId"))

        vendor = F.when(F.col("o_orderstatus") != "P", K.VENDOR).otherwise("other")
        item = F.struct(
            key.alias("VolumeId"),
            F.array(F.struct(F.lit(K.VENDOR_TAG).alias("Key"), vendor.alias("Value"))).alias("Tags"),
            F.when(key % 10 == 0, F.array(attachment(cust), attachment(cust + 5)))
            .otherwise(F.array(attachment(cust))).alias("Attachments"),
        )
        return pages.volumes(self._pages(self.raw("orders"), F.floor(key / 500), item, "Volumes"))

    @cached_property
    def vm(self) -> DataFrame:
        key = F.col("s_suppkey")
        item = F.struct(
            key.cast("string").alias("name"),
            F.when(key % 10 != 0, F.create_map(
                F.lit(K.VENDOR_TAG), F.when(key % 8 != 0, K.VENDOR).otherwise("other"),
                F.lit(K.CLUSTER_TAG), tag("z", key % 7),
            )).alias("tags"),
            F.struct(tag("D", key % 4).alias("vmSize")).alias("hardwareProfile"),
        )
        known = F.col("s_nationkey") % 2 == 0
        halves = [self._pages(self.raw("supplier").filter(side), F.floor(key / 200), item, "value").withColumn("group_known", F.lit(given))
                  for side, given in ((known, True), (~known, False))]
        return pages.vms(halves[0].unionByName(halves[1]))

    @cached_property
    def vm_view(self) -> DataFrame:
        key = F.col("s_suppkey")
        ready = F.struct(F.lit("ProvisioningState/succeeded").alias("code"))
        power = F.struct(
            F.when(F.col("s_acctbal") > 0, K.POWER_RUNNING).otherwise("PowerState/deallocated").alias("code")
        )
        statuses = F.when(key % 3 == 1, F.array(ready)).when(key % 3 == 2, F.array(ready, power))
        view = F.struct(key.cast("string").alias("name"), statuses.alias("statuses"))
        return pages.vm_views(self.raw("supplier").filter(key % 3 != 0).select(F.to_json(view).alias("value")))

    @cached_property
    def poll(self) -> DataFrame:
        """Daily polls per cluster; some fail, and a cluster is seen terminated now and then."""
        day = F.date_trunc("day", F.col("ts").cast("timestamp"))
        return (
            self.raw("events")
            .groupBy((F.col("user_id") % 5).alias("cluster_id"), day.alias("poll_ts"))
            .agg(F.bool_or(F.col("event_id") % 400 == 7).alias("_gone"))
            .select(
                "cluster_id", "poll_ts",
                ((F.dayofmonth("poll_ts") + F.col("cluster_id")) % 13 != 0).alias("ok"),
                F.when(F.col("_gone"), "TERMINATED").otherwise("RUNNING").alias("state"),
            )
        )

    @cached_property
    def observation(self) -> DataFrame:
        day = F.date_trunc("day", F.col("ts").cast("timestamp"))
        return (
            self.raw("events")
            .filter(F.col("event_type") != "error")
            .select((F.col("user_id") % 5).alias("cluster_id"), day.alias("poll_ts"),
                    F.col("user_id").alias("instance_id"))
            .distinct()
        )

    @cached_property
    def sighting(self) -> DataFrame:
        return self.raw("events").select(
            (F.col("user_id") % 5).alias("cluster_id"),
            F.col("user_id").alias("instance_id"),
            epoch_ms(F.col("ts")).alias("seen_ms"),
            "event_id",
            F.col("event_type").alias("state"),
        )

    # -- clusters ---------------------------------------------------------------------------------

    @cached_property
    def cluster(self) -> DataFrame:
        key, size = F.col("p_partkey"), F.col("p_size")
        states = F.array(*[F.lit(s) for s in ["TERMINATED", "TERMINATING", *K.LIVE_CLUSTER_STATES, "ERROR"]])
        cluster_id = tag("cl", key)
        s3 = F.when(key % 3 != 0, F.concat(tag("s3://bucket_", size % 3), F.lit("/logs/"), F.col("p_brand")))
        dbfs = F.when(key % 2 == 0, F.lit("dbfs:/cluster-logs"))
        return self.raw("part").select(
            cluster_id.alias("cluster_id"),
            F.when(key % 19 != 0, F.get(states, size % 7)).alias("state"),
            s3.alias("s3"),
            dbfs.alias("dbfs"),
            F.when(key % 17 != 0, key * 1000).alias("spark_context_id"),
            F.col("p_type").alias("node_type_id"),
            size.alias("num_workers"),
            F.when(size % 2 == 0, "azure").otherwise("aws").alias("platform"),
            log_destination(s3, dbfs, cluster_id).alias("log"),
        )

    @cached_property
    def cluster_text(self) -> DataFrame:
        """Cluster documents as JSON text."""
        conf = F.struct(
            F.struct(F.col("s3").alias("destination")).alias("s3"),
            F.struct(F.col("dbfs").alias("destination")).alias("dbfs"),
        )
        doc = F.struct("cluster_id", "spark_context_id", "state", "node_type_id", "num_workers",
                       conf.alias("cluster_log_conf"))
        return self.cluster.select(F.to_json(doc).alias("value"))

    @cached_property
    def cluster_state(self) -> DataFrame:
        kind = F.col("event_type")
        return self.raw("events").select(
            F.col("user_id").alias("cluster_id"),
            F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / 200).alias("seen_s"),
            F.col("event_id").alias("seq"),
            F.when(kind == "purchase", "TERMINATED").when(kind == "error", "RUNNING").otherwise("TERMINATING")
            .alias("state"),
            F.when((kind == "signup") & (F.col("event_id") % 10 == 3), "404").alias("error_code"),
        )

    @cached_property
    def run_status(self) -> DataFrame:
        kind, event = F.col("event_type"), F.col("event_id")
        return self.raw("events").select(
            F.col("user_id").alias("run_id"),
            F.col("ts").cast("timestamp").alias("ts"),
            event.alias("seq"),
            F.when((kind == "purchase") & (event % 20 == 0), "SUCCESS")
            .when((kind == "error") & (event % 20 == 1), "FAILED").alias("state"),
            F.when((kind == "signup") & (event % 50 == 3), "404").alias("error_code"),
        )

    @cached_property
    def event_row(self) -> DataFrame:
        """Events of clusters with the page and position they were delivered at."""
        event = F.col("event_id")
        message = F.when(F.col("event_type") == "error", F.create_map(F.lit("azure_error_message"), F.lit("x")))
        other = F.when(event % 10 == 0, F.create_map(F.lit("databricks_error_message"), F.lit("y")))
        none = F.create_map().cast("map<string,string>")
        return self.raw("events").select(
            tag("cl", F.col("user_id") % 20).alias("cluster_id"),
            F.floor(event / 500).alias("page_no"),
            (event % 500).alias("pos"),
            epoch_ms(F.col("ts")).alias("ts_ms"),
            F.col("event_type").alias("type"),
            F.map_concat(F.create_map(F.lit("k"), F.get_json_object("props", "$.k")),
                         F.coalesce(message, none), F.coalesce(other, none)).alias("parameters"),
            (F.floor(event / 500) + 10000).alias("total_count"),
        )

    @cached_property
    def time(self) -> DataFrame:
        ts = F.col("ts")
        whole = F.date_trunc("second", ts).cast("timestamp_ntz")
        return self.raw("events").select(
            "event_id", F.when(F.col("event_id") % 2 == 0, whole).otherwise(ts).alias("ts")
        )

    # -- event logs -------------------------------------------------------------------------------

    @cached_property
    def listing(self) -> DataFrame:
        """Daily listings of the log directory of each user; a day's files are that day's events."""
        user, kind = F.col("user_id"), F.col("event_type")
        events = self.raw("events").withColumn("day", F.date_trunc("day", F.col("ts").cast("timestamp")))
        days = running_number(
            events.select("user_id", "day").distinct(), ["user_id"], ["day"],
            F.date_trunc("month", F.col("day")), "poll_no",
        )
        name = (
            F.when(kind == "view", "eventlog").when(kind == "click", "eventlog.gz")
            .when(kind == "signup", "eventlog.json.gz")
            .otherwise(F.concat(tag("eventlog-", F.col("event_id")), F.lit(".gz")))
        )
        folder = F.concat(tag("dbfs:/cluster-logs/eventlog/c", user % 5), tag("_10_0_0_1/", user * 1000 + 7))
        return events.join(days, ["user_id", "day"]).select(
            user.alias("dir"),
            "poll_no",
            F.col("event_id").alias("pos"),
            F.concat(folder, F.lit("/"), name).alias("path"),
            F.when(F.col("value") < 1, 0).when(F.col("event_id") % 15 != 0, 10).cast("bigint").alias("file_size"),
            epoch_ms(F.col("ts")).alias("mtime_ms"),
            (F.unix_millis("day") + 6 * 3600 * 1000).alias("run_end_ms"),
        )

    @cached_property
    def log_target(self) -> DataFrame:
        """One log directory per customer; most were never listed."""
        key = F.col("c_custkey")
        return self.raw("customer").select(
            key.alias("dir"),
            F.when(key % 10 == 0, None).when(key % 10 == 1, "file").when(key % 10 < 5, "s3").otherwise("dbfs")
            .alias("scheme"),
            F.lit(RUN_END_MS).alias("run_end_ms"), F.lit(1).cast("bigint").alias("first_poll"),
        )

    @cached_property
    def log_wait(self) -> DataFrame:
        """Three runs wait for each log directory, one after the other."""
        nth = F.col("nth")
        waits = self.log_target.withColumn("nth", F.explode(F.sequence(F.lit(0), F.lit(2))))
        return waits.withColumns({
            "first_poll": (1 + 5 * nth + F.col("dir") % 4).cast("bigint"),
            "run_end_ms": F.col("run_end_ms") + (nth - 1) * (5 * 24 * 3600 * 1000),
        })

    @cached_property
    def log_entry(self) -> DataFrame:
        """Listings of three log roots and of the directories under them; a fourth root can't be listed."""
        user = F.col("user_id")
        root = F.concat(tag("dbfs:/logs", user % 3), F.lit("/eventlog/"))
        folder = F.concat(root, tag("c", user % 5), F.lit("_10_0_0_1"))
        users = self.raw("events").select(user).distinct().select(root.alias("root"), folder.alias("folder"), user)
        # A root has five folders at most; a folder's listing is one page, in the order of its entries.
        dirs = users.groupBy("root").agg(F.sort_array(F.collect_set(F.struct("folder", (user % 5 != 4).alias("is_dir")))).alias("d"))
        listed = dirs.select("root", F.to_json(F.struct(F.transform("d", lambda d: F.struct(
            F.concat(d["folder"], F.lit("/")).alias("path"), d["is_dir"].alias("is_dir"))).alias("files"))).alias("value"))
        gone = self.spark.range(1).select(
            F.lit("dbfs:/gone/eventlog/").alias("root"), F.lit('{"error_code":"RESOURCE_DOES_NOT_EXIST","message":"No file"}').alias("value"))
        entry = F.struct(F.concat("folder", F.lit("/"), (user * 1000 + 7).cast("string")).alias("path"), F.lit(True).alias("is_dir"))
        inside = users.groupBy("folder").agg(F.sort_array(F.collect_list(F.struct(user, entry.alias("e")))).alias("s")).select(
            "folder", F.to_json(F.struct(F.transform("s", lambda x: x["e"]).alias("files"))).alias("value"))
        return pages.log_entries(listed.unionByName(gone), inside)

    @cached_property
    def log_context(self) -> DataFrame:
        key = F.col("c_custkey")
        return self.raw("customer").select(
            key.alias("run_id"),
            F.when(key % 50 == 0, "dbfs:/gone/eventlog/").otherwise(
                F.concat(tag("dbfs:/logs", F.col("c_nationkey") % 3), F.lit("/eventlog/"))).alias("root"),
            F.when(key % 4 == 0, key + 700).otherwise(key * 1000 + 7).alias("spark_context_id"),
        )

    @cached_property
    def object_key(self) -> DataFrame:
        user = F.col("user_id")
        base = F.when(user % 7 != 0, F.concat(tag("base", user % 3), F.lit("/x/"))).otherwise("")
        key = F.concat(base, tag("eventlog/c", user % 50), F.lit("_10_0_0_1/"), tag("eventlog-", F.col("event_id")))
        item = F.struct(key.alias("Key"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("LastModified"), (user * 10).alias("Size"))
        return pages.objects(self._pages(self.raw("events"), F.floor(F.col("event_id") / 1000), item, "Contents"))

    @cached_property
    def log_owner(self) -> DataFrame:
        key, nation = F.col("s_suppkey"), F.col("s_nationkey")
        return self.raw("supplier").select(
            tag("c", key % 60).alias("cluster_id"),
            F.when(nation % 5 != 0, F.concat(tag("base", nation % 3), F.lit("/x"))).otherwise("").alias("base"),
        )

    # -- jobs and documents -----------------------------------------------------------------------

    def _job_clusters(self) -> Column:
        job, cust = F.col("o_orderkey"), F.col("o_custkey")

        def entry(k: int) -> Column:
            owner = (cust + k) % 4
            size = F.when(F.lit(k == 2), F.struct(F.lit(1).alias("min_workers"), F.lit(k).alias("max_workers")))
            return F.struct(
                F.lit(f"k{k}").alias("job_cluster_key"),
                definition(
                    cluster_name=F.lit(f"name{k}" if k != 1 else None),
                    node_type_id=tag("n", cust % 5), num_workers=job % 8, autoscale=size,
                    custom_tags=project_tags(F.when(owner != 0, tag("p", owner))),
                    policy_id=F.lit("pol" if k == 0 else None), init_scripts=F.array(F.lit(f"b{k}")),
                ).withField("data_security_mode", tag("M", job % 3)).alias("new_cluster"),
            )

        return F.array(*[entry(k) for k in range(3)])

    @cached_property
    def _typed_job(self) -> DataFrame:
        job, cust = F.col("o_orderkey"), F.col("o_custkey")
        count, mode = job % 5, job % 3

        def task(i: Column) -> Column:
            owner = (cust + i) % 3
            inline = (mode == 2) & ((cust + i) % 2 == 0)
            key = F.when(mode == 0, tag("k", cust % 4)).when(mode == 1, tag("k", (cust + i) % 4)).otherwise(
                tag("k", cust % 3)
            )
            own = definition(
                cluster_name=F.lit("own"), node_type_id=tag("n", (cust + i) % 5), num_workers=(job + i) % 8,
                custom_tags=project_tags(F.when(owner != 0, tag("p", owner))),
            ).withField("data_security_mode", tag("M", job % 3))
            notebook = F.concat(tag("/n", job), tag("-", i))
            return F.struct(
                tag("t", i).alias("task_key"),
                F.when(inline, own).alias("new_cluster"),
                F.when(~inline, key).alias("job_cluster_key"),
                F.struct(notebook.alias("notebook_path")).alias("notebook_task"),
            )

        tasks = F.when(count > 0, F.transform(F.sequence(F.lit(0).cast("bigint"), count - 1), task)).otherwise(
            F.transform(F.array().cast("array<bigint>"), task)
        )
        return self.raw("orders").select(
            job.alias("job_id"),
            F.struct(tag("job", job).alias("name"), tasks.alias("tasks"),
                     self._job_clusters().alias("job_clusters"),
                     F.struct(tag("", job % 24).alias("hour")).alias("schedule")).alias("settings"),
        )

    @cached_property
    def job(self) -> DataFrame:
        """Whole job documents, with keys beyond those that operators know."""
        return self._typed_job.select("job_id", F.to_variant_object("settings").alias("settings"))

    @cached_property
    def whole_document(self) -> DataFrame:
        """Cluster definitions and configurations as JSON texts with keys beyond the typed definition."""
        k = F.col("o_orderkey")

        def text(*parts: Column | str) -> Column:
            return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])

        number = lambda n: (k % n).cast("string")
        base = text(
            '{"node_type_id":"n', number(5), '","num_workers":3,"autoscale":null,"data_security_mode":"M', number(3),
            '","aws_attributes":{"zone_id":"z', number(4), '","instance_profile_arn":"arn', number(11),
            '","deep":{"a":{"b":', number(6), '}}},"init_scripts":[{"workspace":{"destination":"w', number(5),
            '"}}],"custom_tags":{"a":"1"}}',
        )
        patch = text(
            '{"node_type_id":"m', number(7), '","autoscale":{"max_workers":', number(9), '},"aws_attributes":{"ebs_volume_size":',
            number(8), ',"deep":{"a":{"c":[', number(2), ']}}},"docker_image":{"url":"u', number(6),
            '"},"init_scripts":[{"s3":{"destination":"s', number(3), '"}}]',
            F.when(k % 5 == 0, ',"custom_tags":null}').otherwise(',"custom_tags":{"b":"2"}}'),
        )
        return self.raw("orders").select(
            k.alias("job_id"), base.alias("definition"), F.when(k % 13 != 0, patch).alias("configuration"))

    @cached_property
    def job_request(self) -> DataFrame:
        key = F.col("o_orderkey")
        return self.raw("orders").select(
            key.alias("job_id"), tag("p", F.col("o_custkey") % 5).alias("project_id"),
            key.alias("recommendation_id"),
        )

    @cached_property
    def job_owner(self) -> DataFrame:
        return self.raw("orders").select(
            F.col("o_orderkey").alias("job_id"), tag("p", F.col("o_custkey")).alias("project_id")
        )

    @cached_property
    def job_text(self) -> DataFrame:
        return self._typed_job.select(F.to_json(F.struct("job_id", "settings")).alias("value"))

    @cached_property
    def run_text(self) -> DataFrame:
        """Run documents as JSON text: the tasks of the job of the same number with their clusters and results."""
        run = F.col("job_id")

        def task(t: Column, i: Column) -> Column:
            started = i % 3 != 2
            return F.struct(
                t["task_key"].alias("task_key"), t["new_cluster"].alias("new_cluster"),
                t["job_cluster_key"].alias("job_cluster_key"),
                F.when(started, F.struct(
                    F.concat(run.cast("string"), F.lit("-"), t["job_cluster_key"]).alias("cluster_id"),
                    (run * 10 + i).cast("string").alias("spark_context_id"),
                )).alias("cluster_instance"),
                F.struct(F.when(i % 2 == 0, "SUCCESS").alias("result_state")).alias("state"),
                (run * 1000 + i).alias("end_time"),
            )

        doc = F.struct(
            run.alias("run_id"), run.alias("job_id"), F.transform("settings.tasks", task).alias("tasks"),
            F.col("settings.job_clusters").alias("job_clusters"),
        )
        return self._typed_job.select(F.to_json(doc).alias("value"))

    @cached_property
    def project_definition(self) -> DataFrame:
        key = F.col("c_custkey")
        conf = F.struct(F.struct(F.lit("dbfs:/old").alias("destination")).alias("dbfs"))
        return self.raw("customer").select(
            tag("p", key).alias("project_id"),
            F.parse_json(F.to_json(definition(
                cluster_name=F.lit("base"), node_type_id=tag("n", key % 5), num_workers=key % 8,
                autoscale=F.when(key % 2 == 0, F.struct(F.lit(1).alias("min_workers"), F.lit(9).alias("max_workers"))),
                custom_tags=project_tags(tag("p", key)),
                policy_id=F.lit("pol"), init_scripts=F.when(key % 3 != 0, F.array(F.lit("b"))),
                cluster_log_conf=F.when(key % 4 == 0, conf),
            ))).alias("definition"),
        )

    @cached_property
    def template(self) -> DataFrame:
        """One template per customer whose nation is even: project tag and log destination."""
        key = F.col("c_custkey")
        text = F.format_string(
            '{"custom_tags":{"sync:project-id":"p%d","owner":"o%d"},'
            '"cluster_log_conf":{"dbfs":{"destination":"dbfs:/new%d"}}}', key, key % 25, key % 25,
        )
        return self.raw("customer").select(
            tag("p", key).alias("project_id"), F.when(F.col("c_nationkey") % 2 == 0, text).alias("template")
        )

    # -- clusters of runs and what is known about them --------------------------------------------

    @cached_property
    def _run_slot(self) -> DataFrame:
        slots = F.explode(F.array(*[F.lit(k).cast("bigint") for k in range(3)]))
        return self.raw("orders").select("o_orderkey", "o_custkey", slots.alias("k")).withColumn(
            "cluster_id", F.concat(F.col("o_orderkey").cast("string"), tag("-c", F.col("k")))
        )

    @cached_property
    def run_cluster(self) -> DataFrame:
        kind = (F.col("o_orderkey") + F.col("k")) % 10
        return self._run_slot.select(
            "cluster_id",
            F.when(F.col("o_custkey") % 2 == 1, "azure").otherwise("aws").alias("platform"),
            F.when(kind == 0, None).when(kind < 3, "s3").when(kind == 3, "file").otherwise("dbfs").alias("log_scheme"),
            (F.col("o_orderkey") % 150).alias("log_dir"), (1 + F.col("o_orderkey") % 7).alias("log_first_poll"),
        )

    @cached_property
    def run_cluster_state(self) -> DataFrame:
        """Two looks at each cluster: still ending at first, then ended, back up, or ending for too long."""
        kind, seq = F.col("o_orderkey") + F.col("k"), F.col("seq")
        slow = kind % 23 == 1
        later = F.when(slow, "TERMINATING").when(kind % 17 == 0, "RUNNING").otherwise("TERMINATED")
        return self._run_slot.withColumn("seq", F.explode(F.array(F.lit(0), F.lit(1)))).select(
            "cluster_id",
            F.when(seq == 0, 0).when(slow, 700).otherwise(10).alias("seen_s"),
            "seq",
            F.when(seq == 0, "TERMINATING").otherwise(later).alias("state"),
            F.lit(None).cast("string").alias("error_code"),
        )

    @cached_property
    def _info_size(self) -> DataFrame:
        """How many items each section of each existing cluster-info document holds."""
        run, cust, k = F.col("o_orderkey"), F.col("o_custkey"), F.col("k")
        aws = cust % 2 == 0

        def size(source: str, exists: Column, section: str, n: Column) -> Column:
            return F.when(exists, F.struct(F.lit(source).alias("source"), F.lit(section).alias("section"),
                                           n.cast("bigint").alias("n")))

        stored, live = cust % 5 >= 2, aws & (cust % 5).isin(1, 2)
        sizes = F.array(
            size("stored", stored, "instances", run % 4),
            size("stored", stored, "instance_timelines", run % 3),
            size("stored", stored, "volumes", F.when(aws, k).otherwise(0)),
            size("live", live, "instances", (run + 1) % 4),
            size("live", live, "volumes", k + 1),
        )
        return self._run_slot.select("cluster_id", F.explode(F.array_compact(sizes)).alias("s")).select(
            "cluster_id", "s.*"
        )

    @cached_property
    def info_header(self) -> DataFrame:
        return self._info_size.filter("section = 'instances'").select("cluster_id", "source")

    @cached_property
    def info_item(self) -> DataFrame:
        numbers = F.when(F.col("n") > 0, F.sequence(F.lit(1).cast("bigint"), "n"))
        return self._info_size.withColumn("j", F.explode(numbers)).select(
            "cluster_id", "source", "section", tag("item", F.col("j")).alias("item")
        )

    @cached_property
    def run_cluster_event(self) -> DataFrame:
        return self.raw("events").select(
            F.concat(F.col("user_id").cast("string"), tag("-c", F.col("event_id") % 3)).alias("cluster_id"),
            F.col("event_type").alias("type"),
            F.create_map(F.lit("azure_error_message"), F.col("event_type"), F.lit("k"),
                         F.get_json_object("props", "$.k")).alias("parameters"),
        )

    @cached_property
    def run_outcome(self) -> DataFrame:
        """Two looks at each run: going on at first, later as its order stands."""
        status, key = F.col("o_orderstatus"), F.col("o_orderkey")
        last = F.when(status == "F", "SUCCESS").when(status == "O", "FAILED")
        return self.raw("orders").withColumn("seq", F.explode(F.array(F.lit(0), F.lit(1)))).select(
            key.alias("run_id"), F.col("seq").alias("ts"), "seq",
            F.when(F.col("seq") == 1, last).alias("state"),
            F.when((F.col("seq") == 1) & (key % 31 == 0), "404").alias("error_code"),
        )

    @cached_property
    def run_state(self) -> DataFrame:
        states = F.array(*[F.lit(s) for s in [*K.FINAL_RUN_STATES, "RUNNING"]])
        key = F.col("o_orderkey")
        return self.raw("orders").select(
            key.alias("run_id"), F.when(key % 6 < 5, F.get(states, (key % 6).cast("int"))).alias("state")
        )

    @cached_property
    def info_request(self) -> DataFrame:
        run = F.col("run_id")
        return self.request.withColumns({
            "skip_eventlog": run % 7 == 0,
            "known_size": F.when(run % 4 != 0, (run % 4) * 10),
        })

    @cached_property
    def telemetry(self) -> Telemetry:
        return Telemetry(
            tasks=self.task, job_clusters=self.job_cluster, projects=self.project, clusters=self.run_cluster,
            cluster_states=self.run_cluster_state, info_headers=self.info_header, info_items=self.info_item,
            cluster_events=self.run_cluster_event, listing=self.listing, jobs=self.job, runs=self.run,
            recommendations=self.recommendation,
        )
