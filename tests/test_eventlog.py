"""Event-log completeness, waiting, and finding log files."""

import json
import random

import pytest
from pyspark.sql import functions as F

from fleetlens.operators import eventlog as lg
from fleetlens.sources import pages
from fleetlens.streaming import logwaits as lw
from fleetlens.streaming.replay import replay

LISTING = "dir bigint, poll_no bigint, pos bigint, path string, file_size bigint, mtime_ms bigint"
TARGET = "dir bigint, scheme string, run_end_ms bigint"
WAIT = TARGET + ", first_poll bigint"
LISTED = "dir long, poll_no long, pos int, path string, file_size long, mtime_ms long"
ASKED = "dir long, run int, scheme string, run_end_ms long, first_poll long"


def listing(spark, polls, folder=1):
    """``polls``: {poll: [(name, size, mtime)]}."""
    rows = [(folder, n, i, f"x/{name}", size, mtime) for n, files in polls.items()
            for i, (name, size, mtime) in enumerate(files)]
    return spark.createDataFrame(rows, LISTING)


def verdicts(spark, polls, scheme, end=100):
    target = spark.createDataFrame([(1, scheme, end)], TARGET)
    rows = lg.completeness(target, listing(spark, polls)).orderBy("poll_no").collect()
    return [r.verdict for r in rows]


RETRY = "Event log was missing or incomplete. Please retry."


@pytest.mark.parametrize(
    "scheme, polls, want",
    [
        # A DBFS log needs two equal totals; the first poll compares with nothing.
        ("dbfs", {1: [("eventlog", 5, 100)], 2: [("eventlog", 5, 100)]}, [RETRY, "complete"]),
        ("dbfs", {1: [("eventlog", 5, 99)], 2: [("eventlog", 5, 99)]}, [RETRY, RETRY]),
        ("dbfs", {1: [("eventlog", 5, 100), ("a.gz", 0, 1)]} | {2: [("eventlog", 5, 100), ("a.gz", 0, 1)]}, [RETRY, RETRY]),
        ("dbfs", {1: [("eventlog", None, 100)]}, ["complete"]),
        ("dbfs", {1: [("a.gz", 5, 100)], 2: [("a.gz", 5, 100)]}, [RETRY, RETRY]),
        # S3 looks only at the first final log listed.
        ("s3", {1: [("eventlog.gz", 5, 100)]}, ["complete"]),
        ("s3", {1: [("eventlog.gz", 5, 99), ("eventlog", 5, 100)]}, [RETRY]),
        ("s3", {1: [("eventlog.json.gz", 5, 100)]}, [RETRY]),
        ("file", {1: [("eventlog", 5, 100)]}, ["Unknown log destination: file"]),
        (None, {1: [("eventlog", 5, 100)]}, ["No eventlog location found for cluster."]),
    ],
)
def test_verdicts(spark, scheme, polls, want):
    assert verdicts(spark, polls, scheme) == want


def test_unlisted_directories(spark):
    targets = spark.createDataFrame([(7, "dbfs", 1), (8, "s3", 1), (9, None, 1)], TARGET)
    empty = listing(spark, {1: [("eventlog", 1, 1)]})
    got = {r.dir: r.verdict for r in lg.completeness(targets, empty).collect()}
    assert got == {7: "No eventlog found", 8: RETRY, 9: "No eventlog location found for cluster."}


def ready_by_rules(scheme, polls, end, limit=20):
    last, tries = 0, 0
    for n, files in sorted(polls.items()):
        if scheme not in ("s3", "dbfs"):
            return None
        total = sum(s or 0 for _, s, _ in files)
        final = [m for name, _, m in files if name in ("eventlog", "eventlog.gz", "eventlog.json")]
        good = bool(final) and final[0] >= end
        if scheme == "dbfs":
            good = good and all(s != 0 for _, s, _ in files) and total == last
        if good:
            return n
        last, tries = total, tries + 1
        if tries == limit:
            return None
    return None


def random_polls(rng):
    names = ["eventlog", "eventlog.gz", "eventlog-1.gz", "eventlog.json.gz"]
    return {
        n: [(rng.choice(names), rng.choice([0, 5, 5, 5, 5, None]), rng.choice([99, 100])) for _ in range(rng.randrange(1, 4))]
        for n in range(1, rng.randrange(2, 30))
    }


def cases_of(rng, n):
    cases = {d: (rng.choice(["dbfs", "dbfs", "s3", "file"]), random_polls(rng)) for d in range(n)}
    # Some logs never get their final file.
    for d in range(0, n, 4):
        cases[d] = (cases[d][0], {k: [("eventlog-1.gz", 5, 1)] for k in range(1, 26)})
    return cases


def test_waiting_from_the_first_poll_on(spark):
    cases = cases_of(random.Random(3), 60)
    files = [(d, n, i, f"x/{name}", s, m) for d, (_, polls) in cases.items() for n, fs in polls.items()
             for i, (name, s, m) in enumerate(fs)]
    targets = spark.createDataFrame([(d, scheme, 100, 1) for d, (scheme, _) in cases.items()], WAIT)
    want = {d: ready_by_rules(scheme, polls, 100) for d, (scheme, polls) in cases.items()}
    got = {r.dir: (r.ready_poll, r.outcome) for r in lg.ready_per_wait(targets, spark.createDataFrame(files, LISTING)).collect()}
    assert {d: p for d, (p, _) in got.items()} == want
    assert any(want.values()) and {o for _, o in got.values()} >= {"ready", "No eventlog found"}


def seconds(n):
    return F.timestamp_seconds(F.lit(1_000_000) + n)


def stream_rows(waits, looks):
    """A poll a second; waits are announced half a second before their first poll."""
    waits = waits.withColumn("at", seconds(F.col("first_poll") - 0.5)).withColumn("deadline", seconds(F.col("deadline")))
    return lw.wait_rows(waits).unionByName(lw.look_rows(looks.withColumn("at", seconds(F.col("poll_no")))))


def test_stream_says_what_the_batch_says(spark):
    """Gaps, more polls than a wait has, several runs per directory, directories that were never listed."""
    entries, targets, want = random_waits(random.Random(8))
    targets += [(900 + k, 0, scheme, 60, 3) for k, scheme in enumerate(["dbfs", "s3", "file", None])]
    listed = spark.createDataFrame(entries, LISTED)
    asked = spark.createDataFrame(targets, ASKED)
    batch = {(r.dir, r.run): (r.ready_poll, r.outcome) for r in lg.ready_per_wait(asked, listed).collect()}
    assert {k: v for k, v in batch.items() if k[0] < 900} == want
    # Without deadlines, a wait that goes on emits nothing.
    waits = asked.withColumnRenamed("run", "run_id").withColumn("deadline", F.lit(None).cast("double"))
    got = {(r.dir, r.run_id): (r.poll_no, r.outcome) for r in replay(
        stream_rows(waits, lg.poll_summaries(listed)), lw.ready_logs, "test-logs", "at", slices=4).collect()}
    listed_dirs = {e[0] for e in entries}
    unlisted = {k for k, (_, outcome) in batch.items() if k[0] not in listed_dirs and outcome == "No eventlog found"}
    assert got == {k: v for k, v in batch.items() if v[1] != "waiting" and k not in unlisted}
    assert batch[900, 0] == (None, "No eventlog found") and batch[901, 0] == (None, "waiting") and (902, 0) in got


def test_deadlines_end_waits_and_state_goes_with_them(spark, tmp_path):
    waits = spark.createDataFrame(
        [(1, 1, "dbfs", 100, 1, 21.5), (1, 2, "dbfs", 100, 30, None), (2, 1, "s3", 100, 1, 5.5), (3, 1, "dbfs", 100, 2, 500.5)],
        "dir long, run_id long, scheme string, run_end_ms long, first_poll long, deadline double")
    looks = spark.createDataFrame(
        [(1, n, 5, False, 50 if n < 30 else 100) for n in range(1, 40)],
        "dir long, poll_no long, total_size long, any_empty boolean, final_mtime_ms long")
    rows = stream_rows(waits, looks)
    place = str(tmp_path)
    rows.write.parquet(f"{place}/in")
    out = []
    stream = lw.ready_logs(spark.readStream.schema(rows.schema).parquet(f"{place}/in")).writeStream.outputMode("update").option(
        "checkpointLocation", f"{place}/state").trigger(availableNow=True)
    stream.foreachBatch(lambda batch, _: out.extend(map(tuple, batch.collect()))).start().awaitTermination()
    assert sorted(out, key=repr) == sorted(
        [(1, 1, None, "No eventlog found"), (1, 2, 31, "ready"), (2, 1, None, "No eventlog found")], key=repr)
    # Only the wait that goes on is kept.
    kept = spark.read.format("statestore").option("stateVarName", "waits").load(f"{place}/state")
    assert kept.count() == 1


def test_stream_state_is_one_value_per_block_of_directories(spark, tmp_path):
    """However many directories and waits a block has; run ids beyond the whole numbers of a double stay whole."""
    big = 2**53 + 1
    waits = spark.createDataFrame(
        [(d, big + k, "s3", 100, 1 + k, 30.5 + d if k else None) for d in range(64, 128) for k in range(3)] + [(500, 1, "dbfs", 100, 1, 2.5)],
        "dir long, run_id long, scheme string, run_end_ms long, first_poll long, deadline double")
    looks = spark.createDataFrame(
        [(70, 2, 5, False, 100), (90, 1, 5, False, 99), (500, 1, 0, True, None)],
        "dir long, poll_no long, total_size long, any_empty boolean, final_mtime_ms long")
    rows = stream_rows(waits, looks)
    place = str(tmp_path)
    rows.write.parquet(f"{place}/in")
    out = []
    lw.ready_logs(spark.readStream.schema(rows.schema).parquet(f"{place}/in")).writeStream.outputMode("update").option(
        "checkpointLocation", f"{place}/state").trigger(availableNow=True).foreachBatch(
        lambda batch, _: out.extend(map(tuple, batch.collect()))).start().awaitTermination()
    assert sorted(out, key=repr) == sorted([(70, big, 2, "ready"), (70, big + 1, 2, "ready"), (500, 1, None, "No eventlog found")], key=repr)
    kept = spark.read.format("statestore").option("stateVarName", "waits").load(f"{place}/state")
    assert kept.count() == 1


def test_bundle_names(spark):
    polls = {1: [("eventlog", 5, 100), ("eventlog-1.gz", 5, 1)], 2: [("eventlog", 5, 100), ("eventlog-1.gz", 5, 1)]}
    polls[25] = polls[26] = [("eventlog", 7, 900)]
    targets = spark.createDataFrame([(1, "dbfs", 100, 1, "a"), (1, "dbfs", 800, 25, "b")], WAIT + ", run string")
    got = lg.bundle_manifest(targets, listing(spark, polls)).collect()
    assert {(r.run, r.poll_no, r.path, r.bundle_name) for r in got} == {
        ("a", 2, "x/eventlog", "eventlog.gz"), ("a", 2, "x/eventlog-1.gz", "eventlog-1.gz"), ("b", 26, "x/eventlog", "eventlog.gz")
    }


def test_prefixes_match_like_startswith(spark):
    rng = random.Random(5)
    bases = ["", "b", "b/eventlog/x", "/lead"]
    owners = sorted({(f"c{rng.randrange(30)}", rng.choice(bases)) for _ in range(40)})
    keys = sorted({
        "/".join([p for p in [rng.choice(["", "b", "b/eventlog/x", "lead", "other"]), "eventlog",
                              f"c{rng.randrange(30)}{rng.choice(['', '_10', '5'])}", "f.gz"] if p]) for _ in range(300)
    })
    got = lg.files_by_prefix(
        spark.createDataFrame([(k,) for k in keys], "key string"),
        spark.createDataFrame(owners, "cluster_id string, base string"),
    )
    want = {(k, c, ) for k in keys for c, b in owners if k.startswith(f"{b}/eventlog/{c}".strip("/"))}
    rows = [(r.key, r.cluster_id) for r in got.select("key", "cluster_id").distinct().collect()]
    assert set(rows) == want and len(want) > 50


def test_contexts_match_like_contains(spark):
    rng = random.Random(6)
    entries = [(f"r{rng.randrange(2)}", d, rng.random() < 0.8, i, f"dbfs:/x{rng.randrange(3)}/c_10_0/{rng.randrange(10**5)}")
               for i, d in enumerate(rng.choices(range(5), k=80))]
    targets = [(n, f"r{rng.randrange(2)}", rng.choice([rng.randrange(100), rng.randrange(10**5)])) for n in range(200)]
    got = lg.log_dirs_by_context(
        spark.createDataFrame(targets, "run_id int, root string, spark_context_id bigint"),
        spark.createDataFrame(entries, "root string, dir_pos int, is_dir boolean, sub_pos int, path string").withColumn("error", F.lit(None).cast("string")),
    )
    want = {}
    for run, root, context in targets:
        found = [e for e in entries if e[0] == root and e[2] and str(context) in e[4]]
        want[run] = min(found, key=lambda e: (-e[1], e[3]))[4] if found else None
    assert {r.run_id: r.log_dir for r in got.collect()} == want
    assert any(want.values()) and not all(want.values())


def plain_wait(polls, scheme, end, start, limit):
    """What a wait that begins at poll ``start`` sees; ``polls``: number → (total size, any empty file, final log's time)."""
    if not polls and scheme == "dbfs":
        return None, "No eventlog found"
    last, size = max(polls, default=0), 0
    for n in range(start, start + limit):
        if n > last:
            return None, "waiting"
        if n not in polls:
            if scheme == "dbfs":
                return None, "No eventlog found"
            continue
        total, empty, final = polls[n]
        before = polls[n - 1][0] if n > start and n - 1 in polls else 0 if n == start else None
        if before is None:
            before = polls[max(k for k in polls if k < n)][0] if any(k < n for k in polls) else 0
        if final is not None and final >= end and (scheme == "s3" or (not empty and total == before)):
            return n, "ready"
        size = total
    return None, "No eventlog found"


def random_waits(rng):
    entries, targets, want = [], [], {}
    for d in range(60):
        polls = {n: (rng.choice([5, 5, 10]), rng.random() < 0.1, rng.choice([None, 50, 100, 150])) for n in range(1, rng.randint(1, 60)) if rng.random() < (0.97 if d % 2 else 1)}
        for n, (total, empty, final) in polls.items():
            entries.append((d, n, 0, "x/eventlog" if final else "x/eventlog-1.gz", total, final or 0))
            if empty:
                entries.append((d, n, 1, "x/eventlog-2.gz", 0, 0))
        for run in range(3):
            scheme, start, end = rng.choice(["s3", "dbfs"]), rng.randint(1, 40), rng.choice([60, 120, 200])
            targets.append((d, run, scheme, end, start))
            want[d, run] = plain_wait(polls, scheme, end, start, 20)
    return entries, targets, want


def test_waits_of_several_runs_for_one_directory(spark):
    """Counting starts with each wait's first poll; a missing DBFS directory ends the wait."""
    entries, targets, want = random_waits(random.Random(5))
    got = {(r.dir, r.run): (r.ready_poll, r.outcome) for r in lg.ready_per_wait(
        spark.createDataFrame(targets, ASKED), spark.createDataFrame(entries, LISTED)).collect()}
    assert got == want and len({o for _, o in want.values()}) == 3


def test_listings_as_delivered(spark):
    """Objects of a bucket, and log folders under roots, one of which can't be listed."""
    def text(rows, schema):
        return spark.createDataFrame([(*keys, json.dumps(page)) for *keys, page in rows], schema)

    bucket = text([("b", {"Contents": [{"Key": "x/eventlog/c1/f", "LastModified": "2024-01-02T03:04:05Z", "Size": 9}, {"Key": "y", "Size": 1}], "KeyCount": 2}),
                   ("b", {"IsTruncated": False})], "bucket string, value string")
    got = lg.files_by_prefix(pages.objects(bucket), spark.createDataFrame([("b", "c1", "x")], "bucket string, cluster_id string, base string")).collect()
    assert [(r.cluster_id, r.key, r.file_size, r.mtime_ms, r.pos) for r in got] == [("c1", "x/eventlog/c1/f", 9, 1704164645000, 0)]
    roots = text([("r1", {"files": [{"path": "r1/a/", "is_dir": True}, {"path": "r1/f", "file_size": 3}, {"path": "r1/b", "is_dir": True}]}),
                  ("r2", {"error_code": "RESOURCE_DOES_NOT_EXIST", "message": "gone"}), ("r3", {})], "root string, value string")
    folders = text([("r1/a", {"files": [{"path": "r1/a/1_77", "is_dir": True}]}), ("r1/b/", {"files": [{"path": "r1/b/2_77"}, {"path": "r1/b/3_77"}]}),
                    ("r1/f", {"files": [{"path": "r1/f"}]})], "folder string, value string")
    targets = spark.createDataFrame([(1, "r1", 77), (2, "r1", 78), (3, "r2", 77), (4, "r3", 77)], "run_id int, root string, spark_context_id long")
    got = {r.run_id: (r.log_dir, r.log_error) for r in lg.log_dirs_by_context(targets, pages.log_entries(roots, folders)).collect()}
    assert got == {1: ("r1/b/2_77", None), 2: (None, None), 3: (None, "Unable to locate files in DBFS dir r2"), 4: (None, None)}
    errors = pages.page_errors(roots).collect()
    assert [(r.root, r.error) for r in errors] == [("r2", "Databricks API Error: RESOURCE_DOES_NOT_EXIST: gone")]


def test_equal_keys_in_two_buckets(spark):
    listed = spark.createDataFrame([("b1", "x/eventlog/c1/f"), ("b2", "x/eventlog/c1/f"), ("b3", "x/eventlog/c1/f")], "bucket string, key string")
    owners = spark.createDataFrame([("b1", "c1", "x"), ("b2", "c1", "/x")], "bucket string, cluster_id string, base string")
    got = lg.files_by_prefix(listed, owners).select("bucket", "cluster_id").collect()
    assert sorted(map(tuple, got)) == [("b1", "c1"), ("b2", "c1")]
