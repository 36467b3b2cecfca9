"""The telemetry bindings as SQL common table expressions over the supplied tables."""

TABLES: dict[str, str] = {}

TABLES["b_task0"] = """
SELECT l_orderkey AS run_id, l_linenumber AS pos, min(l_partkey) AS part, min(l_suppkey) AS supp,
       epoch_ms(max(l_shipdate)) AS end_time_ms, max(l_returnflag) AS flag
FROM lineitem GROUP BY l_orderkey, l_linenumber"""

TABLES["b_task"] = """
SELECT run_id, pos, 't' || pos AS task_key, end_time_ms,
       CASE WHEN flag = 'R' THEN 'FAILED' ELSE 'SUCCESS' END AS result_state,
       CASE WHEN part % 11 <> 0 THEN run_id || '-c' || (supp % 3) END AS cluster_id,
       CASE WHEN part % 11 <> 0 THEN run_id * 10 + supp % 3 END AS spark_context_id,
       part % 5 = 0 AS inline,
       CASE WHEN part % 5 = 0 THEN NULL WHEN part % 7 = 0 THEN 'missing'
            ELSE 'k' || (supp % 3 + CASE WHEN part % 13 = 0 THEN 1 ELSE 0 END) END AS job_cluster_key,
       CASE WHEN part % 5 = 0 AND part % 3 <> 0 THEN 'p' || (part % 4) END AS inline_project,
       'n' || (part % 5) AS inline_node, part % 8 AS inline_workers
FROM b_task0"""

TABLES["b_job_cluster"] = """
SELECT o_orderkey AS run_id, 'k' || k AS job_cluster_key,
       CASE WHEN (o_custkey + k) % 4 <> 0 THEN 'p' || ((o_custkey + k) % 4) END AS project_id,
       'n' || (o_custkey % 5) AS node_type, o_orderkey % 8 AS num_workers
FROM orders, (VALUES (0), (1), (2)) AS t(k)"""

TABLES["b_request"] = """
SELECT o_orderkey AS run_id, CASE WHEN o_orderkey % 3 <> 0 THEN 'p' || (o_orderkey % 5) END AS want,
       CASE WHEN o_orderkey % 2 = 0 THEN 'job_clusters/k' || (o_orderkey % 3) END AS want_path
FROM orders"""

# Tasks with the definition they ran on; unresolved ones have a NULL path.
TABLES["r_all"] = """
SELECT t.*, CASE WHEN inline THEN 'tasks/' || task_key
                 WHEN c.job_cluster_key IS NOT NULL THEN 'job_clusters/' || c.job_cluster_key END AS cluster_path,
       CASE WHEN inline THEN inline_project ELSE c.project_id END AS project_id,
       CASE WHEN inline THEN inline_node ELSE c.node_type END AS node_type_id,
       CASE WHEN inline THEN inline_workers ELSE c.num_workers END AS num_workers
FROM b_task t LEFT JOIN b_job_cluster c ON c.run_id = t.run_id AND c.job_cluster_key = t.job_cluster_key"""

TABLES["r_task"] = "SELECT * FROM r_all WHERE cluster_path IS NOT NULL AND cluster_id IS NOT NULL"

TABLES["r_path"] = """
SELECT run_id, project_id, cluster_path, any_value(cluster_id) AS cluster_id
FROM r_task GROUP BY run_id, project_id, cluster_path HAVING count(DISTINCT cluster_id) = 1"""

# One row per request and project entry of its run.
TABLES["r_entry"] = """
SELECT q.run_id, q.want, q.want_path, p.project_id, count(*) AS n_paths,
       bool_or(coalesce(p.cluster_path = q.want_path, false)) AS holds_path,
       CASE WHEN count(*) = 1 THEN any_value(p.cluster_id)
            ELSE any_value(p.cluster_id) FILTER (p.cluster_path = q.want_path) END AS cluster_id,
       count(*) OVER (PARTITION BY q.run_id) AS n_entries
FROM b_request q JOIN r_path p ON p.run_id = q.run_id GROUP BY q.run_id, q.want, q.want_path, p.project_id"""

TABLES["r_selection"] = """
SELECT run_id, want AS project_id, cluster_id, 'a' AS branch FROM r_entry WHERE want = project_id
UNION ALL
SELECT run_id, want, cluster_id, 'b' FROM r_entry e WHERE want IS NOT NULL AND holds_path
  AND NOT EXISTS (SELECT 1 FROM r_entry x WHERE x.run_id = e.run_id AND x.project_id = e.want)
UNION ALL
SELECT run_id, want, cluster_id, 'c' FROM r_entry WHERE want IS NOT NULL AND n_entries = 1
  AND project_id IS DISTINCT FROM want AND NOT holds_path
UNION ALL
SELECT run_id, project_id, cluster_id, 'tagged' FROM r_entry
WHERE want IS NULL AND project_id IS NOT NULL AND (want_path IS NULL OR holds_path)"""

# -- projects, submissions, recommendations -----------------------------------------------------------

TABLES["b_project"] = """
SELECT 'p' || c_custkey AS project_id, c_mktsegment || (c_custkey % 50) AS app_id,
       CASE c_mktsegment WHEN 'BUILDING' THEN 'GRADIENT_ML' WHEN 'HOUSEHOLD' THEN 'UNASSIGNED' ELSE 'OTHER' END
         AS project_model_id,
       c_acctbal > 0 AS auto_apply_recs, c_custkey AS created_at, c_name AS description,
       c_custkey % 2 = 0 AS optimize_instance_size, c_custkey
FROM customer"""

TABLES["b_submission"] = """
SELECT o_orderkey AS id, 'p' || o_custkey AS project_id, epoch_ms(o_orderdate) AS created_at,
       CASE o_orderstatus WHEN 'F' THEN 'SUCCESS' WHEN 'O' THEN 'FAILED' ELSE 'PENDING' END AS state,
       CASE WHEN o_orderkey % 11 <> 0 THEN 'n' || (o_orderkey % 7) END AS node_type_id,
       CASE WHEN o_orderkey % 11 <> 0 THEN o_orderkey % 8 END AS num_workers
FROM orders"""

TABLES["b_recommendation"] = """
SELECT o_orderkey AS id, 'p' || o_custkey AS project_id, epoch_ms(o_orderdate) AS created_at,
       CASE o_orderstatus WHEN 'F' THEN 'SUCCESS' WHEN 'O' THEN 'FAILURE' ELSE 'PENDING' END AS state,
       o_orderkey % 5 <> 0 AS has_recommendation,
       CASE WHEN o_orderkey % 5 <> 0 AND o_orderkey % 7 <> 0 THEN
         '{"node_type_id":"n' || (o_orderkey % 7) || '","num_workers":' || (o_orderkey % 8)
         || ',"custom_tags":{"sync:run-id":"r' || o_orderkey || '","team":"y"},"init_scripts":["s'
         || (o_orderkey % 3) || '"]' || CASE WHEN o_orderkey % 9 = 0 THEN ',"policy_id":null' ELSE '' END || '}'
       END AS configuration
FROM orders"""

TABLES["w_latest_recommendation"] = """
SELECT p.project_id, r.id AS recommendation_id, r.configuration, r.has_recommendation
FROM b_project p LEFT JOIN (
  SELECT *, row_number() OVER (PARTITION BY project_id ORDER BY created_at DESC, id DESC) AS rn
  FROM b_recommendation) r ON r.project_id = p.project_id AND r.rn = 1"""

TABLES["b_response"] = """
SELECT c_custkey AS response_id, c_custkey % 3 <> 0 AS has_result,
       CASE c_custkey % 4 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE c_mktsegment END AS error_code,
       CASE WHEN c_custkey % 5 <> 0 THEN c_name END AS message
FROM customer"""

# -- workspaces ---------------------------------------------------------------------------------------

TABLES["b_workspace"] = """
SELECT s_suppkey, 'w' || s_suppkey AS workspace_id,
       CASE s_suppkey % 3 WHEN 0 THEN 'https://adb-' || s_suppkey || '.azuredatabricks.net'
         WHEN 1 THEN 'https://dbc-' || s_suppkey || '.cloud.databricks.com/?o=1'
         ELSE 'https://' || s_suppkey || '.example.com' END AS databricks_host,
       CASE s_suppkey % 4 WHEN 0 THEN 'Standard' WHEN 1 THEN 'Premium' WHEN 2 THEN 'Enterprise' ELSE 'Trial' END
         AS databricks_plan_type,
       CASE WHEN s_suppkey % 11 = 0 THEN NULL WHEN s_suppkey % 2 = 0 THEN 'hosted' ELSE 'remote' END
         AS collection_type,
       CASE s_suppkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 'hypervisor' ELSE 'webhook' END AS monitoring_type,
       CASE WHEN s_suppkey % 13 = 0 THEN 'gcp' WHEN s_suppkey % 3 = 0 THEN 'azure' ELSE 'aws' END
         AS compute_provider,
       CASE s_nationkey % 4 WHEN 1 THEN 'us-east-1' WHEN 2 THEN 'eu-west-2' WHEN 3 THEN 'mars-1' END AS aws_region,
       CASE WHEN s_suppkey % 5 <> 0 THEN 'arn:i' || s_suppkey END AS instance_profile_arn,
       CASE WHEN s_suppkey % 7 <> 0 THEN 'arn:r' || s_suppkey END AS aws_iam_role_arn,
       CASE WHEN s_nationkey % 2 <> 0 THEN 'tenant' END AS azure_tenant_id,
       CASE WHEN s_nationkey % 3 <> 0 THEN 'client' END AS azure_client_id,
       CASE WHEN s_nationkey % 5 <> 0 THEN 'secret' END AS azure_client_secret,
       CASE WHEN s_nationkey % 7 <> 0 THEN 'subscription' ELSE '' END AS azure_subscription_id
FROM supplier"""

TABLES["b_log_url"] = """
SELECT page_id, CASE page_id % 4 WHEN 0 THEN 's3' || substr(url, strpos(url, ':'))
       WHEN 1 THEN 'dbfs' || substr(url, strpos(url, ':')) ELSE url END AS url
FROM pages"""

# -- fleet --------------------------------------------------------------------------------------------

TABLES["b_instance"] = """
SELECT DISTINCT user_id AS instance_id, user_id % 5 AS cluster_id, user_id % 9 <> 0 AS ours,
       user_id % 4 <> 0 AS running
FROM events"""

TABLES["b_volume"] = """
SELECT o_orderkey AS volume_id, o_custkey AS instance_id, o_orderstatus <> 'P' AS ours FROM orders
UNION ALL SELECT o_orderkey, o_custkey + 5, o_orderstatus <> 'P' FROM orders WHERE o_orderkey % 10 = 0"""

TABLES["w_cluster_volume"] = """
SELECT DISTINCT i.cluster_id, v.volume_id FROM b_volume v JOIN b_instance i ON i.instance_id = v.instance_id
WHERE v.ours AND i.ours"""

TABLES["w_running_vm"] = """
SELECT 'z' || (s_suppkey % 7) AS cluster_id, CAST(s_suppkey AS VARCHAR) AS instance_id FROM supplier
WHERE s_suppkey % 10 <> 0 AND s_suppkey % 8 <> 0
  AND (s_nationkey % 2 <> 0 OR (s_suppkey % 3 = 2 AND s_acctbal > 0))"""

TABLES["b_poll"] = """
SELECT user_id % 5 AS cluster_id, date_trunc('day', ts) AS poll_ts,
       (day(min(ts)) + user_id % 5) % 13 <> 0 AS ok, bool_or(event_id % 400 = 7) AS gone
FROM events GROUP BY user_id % 5, date_trunc('day', ts)"""

TABLES["b_obs"] = """
SELECT DISTINCT user_id % 5 AS cluster_id, date_trunc('day', ts) AS poll_ts, user_id AS instance_id
FROM events WHERE event_type <> 'error'"""

# Polls of a cluster next to each other.
TABLES["w_step"] = """
SELECT cluster_id, poll_ts, lag(poll_ts) OVER w AS prev_ts, lead(poll_ts) OVER w AS next_ts
FROM b_poll WINDOW w AS (PARTITION BY cluster_id ORDER BY poll_ts)"""

# An interval starts at a sighting the preceding poll lacks and ends at the first following one the next poll lacks.
TABLES["w_timeline"] = """
SELECT s.cluster_id, s.instance_id, s.poll_ts AS first_seen, min(e.poll_ts) AS last_seen
FROM (SELECT o.* FROM b_obs o JOIN w_step p USING (cluster_id, poll_ts)
      WHERE NOT EXISTS (SELECT 1 FROM b_obs x WHERE x.cluster_id = o.cluster_id
                        AND x.instance_id = o.instance_id AND x.poll_ts = p.prev_ts)) s
JOIN (SELECT o.* FROM b_obs o JOIN w_step p USING (cluster_id, poll_ts)
      WHERE NOT EXISTS (SELECT 1 FROM b_obs x WHERE x.cluster_id = o.cluster_id
                        AND x.instance_id = o.instance_id AND x.poll_ts = p.next_ts)) e
  ON e.cluster_id = s.cluster_id AND e.instance_id = s.instance_id AND e.poll_ts >= s.poll_ts
GROUP BY s.cluster_id, s.instance_id, s.poll_ts"""

TABLES["w_timeline_rows"] = """
SELECT cluster_id, instance_id, epoch_ms(first_seen) AS first_seen_ms, epoch_ms(last_seen) AS last_seen_ms,
       last_seen = (SELECT max(poll_ts) FROM b_poll p WHERE p.cluster_id = t.cluster_id) AS is_active
FROM w_timeline t"""

# What a monitor applies: polls that worked, up to the first that saw the cluster terminated.
TABLES["w_applied"] = """
SELECT cluster_id, poll_ts, row_number() OVER (PARTITION BY cluster_id ORDER BY poll_ts) AS nr
FROM b_poll p WHERE ok AND NOT EXISTS (
  SELECT 1 FROM b_poll x WHERE x.cluster_id = p.cluster_id AND x.ok AND x.gone AND x.poll_ts < p.poll_ts)"""

# -- clusters, events and event logs ------------------------------------------------------------------

TABLES["b_cluster"] = """
SELECT *, coalesce(s3, dbfs) AS url,
       CASE WHEN s3 IS NOT NULL THEN 's3' WHEN dbfs IS NOT NULL THEN 'dbfs' END AS scheme,
       CASE WHEN s3 IS NOT NULL THEN 'bucket_' || (p_size % 3) WHEN dbfs IS NOT NULL THEN '' END AS bucket,
       -- A '#' starts a URL fragment, which is no part of the path.
       CASE WHEN s3 IS NOT NULL THEN 'logs/' || split_part(p_brand, '#', 1) || '/' || cluster_id
            WHEN dbfs IS NOT NULL THEN 'cluster-logs/' || cluster_id END AS base
FROM (SELECT p_partkey, p_size, p_brand, 'cl' || p_partkey AS cluster_id,
       CASE WHEN p_partkey % 19 <> 0 THEN
         ['TERMINATED', 'TERMINATING', 'PENDING', 'RUNNING', 'RESTARTING', 'RESIZING', 'ERROR'][p_size % 7 + 1] END
         AS state,
       CASE WHEN p_partkey % 3 <> 0 THEN 's3://bucket_' || (p_size % 3) || '/logs/' || p_brand END AS s3,
       CASE WHEN p_partkey % 2 = 0 THEN 'dbfs:/cluster-logs' END AS dbfs,
       CASE WHEN p_partkey % 17 <> 0 THEN p_partkey * 1000 END AS spark_context_id,
       p_type AS node_type_id, p_size AS num_workers,
       CASE WHEN p_size % 2 = 0 THEN 'azure' ELSE 'aws' END AS platform
  FROM part)"""

TABLES["b_event_row"] = """
SELECT event_id, 'cl' || (user_id % 20) AS cluster_id, event_id // 500 AS page_no, event_id % 500 AS pos,
       epoch_us(ts) // 1000 AS ts_ms, event_type AS type, props, 10000 + event_id // 500 AS total_count
FROM events"""

TABLES["b_listing"] = """
SELECT user_id AS dir, dense_rank() OVER (PARTITION BY user_id ORDER BY date_trunc('day', ts)) AS poll_no,
       event_id AS pos,
       'dbfs:/cluster-logs/eventlog/c' || (user_id % 5) || '_10_0_0_1/' || (user_id * 1000 + 7) || '/'
       || CASE event_type WHEN 'view' THEN 'eventlog' WHEN 'click' THEN 'eventlog.gz'
            WHEN 'signup' THEN 'eventlog.json.gz' ELSE 'eventlog-' || event_id || '.gz' END AS path,
       event_type IN ('view', 'click') AS is_final,
       CASE WHEN value < 1 THEN 0 WHEN event_id % 15 <> 0 THEN 10 END AS file_size,
       epoch_us(ts) // 1000 AS mtime_ms, epoch_ms(date_trunc('day', ts)) + 21600000 AS run_end_ms
FROM events"""

TABLES["w_look"] = """
SELECT dir, poll_no, total_size, any_empty, final_mtime_ms, run_end_ms,
       coalesce((SELECT sum(coalesce(file_size, 0)) FROM b_listing x
                 WHERE x.dir = l.dir AND x.poll_no = l.poll_no - 1), 0)::BIGINT AS last_size
FROM (SELECT dir, poll_no, sum(coalesce(file_size, 0))::BIGINT AS total_size,
             count(*) FILTER (file_size = 0) > 0 AS any_empty,
             arg_min(mtime_ms, pos) FILTER (is_final) AS final_mtime_ms, max(run_end_ms) AS run_end_ms
      FROM b_listing GROUP BY dir, poll_no) l"""

TABLES["b_log_target"] = """
SELECT c_custkey AS dir, CASE WHEN c_custkey % 10 = 0 THEN NULL WHEN c_custkey % 10 = 1 THEN 'file'
  WHEN c_custkey % 10 < 5 THEN 's3' ELSE 'dbfs' END AS scheme FROM customer"""

TABLES["w_verdict"] = """
SELECT t.dir, t.scheme, l.poll_no, l.total_size,
       CASE WHEN t.scheme IS NULL THEN 'No eventlog location found for cluster.'
            WHEN t.scheme = 'file' THEN 'Unknown log destination: file'
            WHEN t.scheme = 's3' AND final_mtime_ms >= 1705406400000 THEN 'complete'
            WHEN t.scheme = 's3' THEN 'Event log was missing or incomplete. Please retry.'
            WHEN l.dir IS NULL THEN 'No eventlog found'
            WHEN final_mtime_ms >= 1705406400000 AND NOT any_empty AND total_size = last_size THEN 'complete'
            ELSE 'Event log was missing or incomplete. Please retry.' END AS verdict
FROM b_log_target t LEFT JOIN w_look l ON l.dir = t.dir"""

# Three waits for each directory, one after the other.
TABLES["w_wait"] = """
SELECT t.*, s.ready_poll, l.polls,
       CASE WHEN t.scheme IS NULL THEN 'No eventlog location found for cluster.' WHEN t.scheme NOT IN ('s3', 'dbfs') THEN 'Unknown log destination: ' || t.scheme
            WHEN s.ready_poll IS NOT NULL THEN 'ready' WHEN t.scheme = 'dbfs' AND l.polls IS NULL THEN 'No eventlog found'
            WHEN l.polls >= t.first_poll + 19 THEN 'No eventlog found' ELSE 'waiting' END AS outcome
FROM (SELECT dir, scheme, nth::INTEGER AS nth, 1 + 5 * nth + dir % 4 AS first_poll, 1705406400000 + (nth - 1) * 432000000 AS run_end
      FROM b_log_target, range(3) AS r(nth)) t
LEFT JOIN (
  SELECT x.dir, x.nth, min(l.poll_no) AS ready_poll
  FROM (SELECT dir, scheme, nth::INTEGER AS nth, 1 + 5 * nth + dir % 4 AS first_poll, 1705406400000 + (nth - 1) * 432000000 AS run_end
        FROM b_log_target, range(3) AS r(nth)) x
  JOIN w_look l ON l.dir = x.dir AND l.poll_no BETWEEN x.first_poll AND x.first_poll + 19
  WHERE l.final_mtime_ms >= x.run_end AND (x.scheme = 's3' OR (x.scheme = 'dbfs' AND NOT l.any_empty
        AND l.total_size = CASE WHEN l.poll_no = x.first_poll THEN 0 ELSE l.last_size END))
  GROUP BY x.dir, x.nth) s ON s.dir = t.dir AND s.nth = t.nth
LEFT JOIN (SELECT dir, max(poll_no) AS polls FROM b_listing GROUP BY dir) l ON l.dir = t.dir"""

TABLES["w_ready"] = """
SELECT dir, scheme, ready_poll, polls,
       CASE WHEN ready_poll IS NOT NULL THEN 'ready'
            WHEN a_verdict NOT IN ('complete', 'Event log was missing or incomplete. Please retry.') THEN a_verdict
            WHEN polls >= 20 THEN 'No eventlog found' ELSE 'waiting' END AS outcome
FROM (SELECT dir, scheme, min(poll_no) FILTER (verdict = 'complete' AND poll_no <= 20) AS ready_poll,
             max(poll_no) AS polls, any_value(verdict) AS a_verdict
      FROM w_verdict GROUP BY dir, scheme)"""

# -- jobs, definitions and recommendations ------------------------------------------------------------

TABLES["b_job_shared"] = """
SELECT o_orderkey AS job_id, k AS pos, 'k' || k AS job_cluster_key, CASE WHEN k <> 1 THEN 'name' || k END AS cluster_name,
       'n' || (o_custkey % 5) AS node_type_id, o_orderkey % 8 AS num_workers, CASE WHEN k = 2 THEN 2 END AS max_workers,
       CASE WHEN (o_custkey + k) % 4 <> 0 THEN 'p' || ((o_custkey + k) % 4) END AS project_id,
       CASE WHEN k = 0 THEN 'pol' END AS policy_id, 'b' || k AS scripts
FROM orders, (VALUES (0), (1), (2)) AS t(k)"""

TABLES["b_job_task"] = """
SELECT job_id, i, n, 't' || i AS task_key, inline,
       CASE WHEN inline THEN NULL WHEN mode = 0 THEN 'k' || (c % 4) WHEN mode = 1 THEN 'k' || ((c + i) % 4)
            ELSE 'k' || (c % 3) END AS job_cluster_key,
       CASE WHEN inline THEN 'n' || ((c + i) % 5) END AS node_type_id,
       CASE WHEN inline THEN (job_id + i) % 8 END AS num_workers,
       CASE WHEN inline AND (c + i) % 3 <> 0 THEN 'p' || ((c + i) % 3) END AS project_id
FROM (SELECT o_orderkey AS job_id, o_custkey AS c, o_orderkey % 5 AS n, o_orderkey % 3 AS mode, i,
             o_orderkey % 3 = 2 AND (o_custkey + i) % 2 = 0 AS inline
      FROM orders, range(0, 5) AS r(i) WHERE i < o_orderkey % 5)"""

# Every task with the definition it resolves to.
TABLES["w_job_resolved"] = """
SELECT t.job_id, t.i, t.n, t.task_key, t.inline, t.job_cluster_key AS task_cluster_key,
       CASE WHEN t.inline THEN 'tasks' ELSE 'job_clusters' END AS path_kind,
       CASE WHEN t.inline THEN t.task_key ELSE t.job_cluster_key END AS path_key,
       t.inline OR s.job_id IS NOT NULL AS found,
       CASE WHEN t.inline THEN 'own' ELSE s.cluster_name END AS cluster_name,
       coalesce(t.node_type_id, s.node_type_id) AS node_type_id, coalesce(t.num_workers, s.num_workers) AS num_workers,
       s.max_workers, CASE WHEN t.inline THEN t.project_id ELSE s.project_id END AS project_id, s.policy_id, s.scripts
FROM b_job_task t LEFT JOIN b_job_shared s ON s.job_id = t.job_id AND s.job_cluster_key = t.job_cluster_key"""

TABLES["w_job_single"] = """
SELECT o.o_orderkey AS job_id, r.inline, r.task_cluster_key, r.cluster_name, r.node_type_id, r.num_workers,
       r.max_workers, r.project_id, r.policy_id, r.scripts, o.o_orderkey % 5 AS n,
       CASE WHEN o.o_orderkey % 5 = 0 THEN 'No task found in job'
            WHEN o.o_orderkey % 5 > 1 AND k.kinds > 1 THEN 'Not all tasks use the same cluster'
            WHEN o.o_orderkey % 5 > 1 AND k.all_inline THEN 'No cluster found for task'
            WHEN NOT r.found THEN 'No cluster found for task' END AS error
FROM orders o
LEFT JOIN w_job_resolved r ON r.job_id = o.o_orderkey AND r.i = 0
LEFT JOIN (SELECT job_id, count(DISTINCT coalesce(job_cluster_key, '-')) AS kinds, bool_and(inline) AS all_inline
           FROM b_job_task GROUP BY job_id) k ON k.job_id = o.o_orderkey"""

TABLES["w_job_project"] = """
SELECT job_id, project_id, any_value(path_kind) AS path_kind, any_value(path_key) AS path_key,
       any_value(cluster_name) AS cluster_name, any_value(node_type_id) AS node_type_id,
       any_value(num_workers) AS num_workers, any_value(max_workers) AS max_workers,
       any_value(policy_id) AS policy_id, any_value(scripts) AS scripts
FROM w_job_resolved WHERE found GROUP BY job_id, project_id HAVING count(DISTINCT path_kind || '/' || path_key) = 1"""

TABLES["w_target"] = """
SELECT q.job_id, q.want AS project_id, coalesce(a.path_kind, b.path_kind) AS path_kind,
       coalesce(a.path_key, b.path_key) AS path_key, coalesce(a.node_type_id, b.node_type_id) AS node_type_id,
       CASE WHEN a.job_id IS NULL AND b.job_id IS NULL
            THEN 'Failed to locate cluster in job ' || q.job_id || ' for project ' || q.want END AS target_error
FROM (SELECT o_orderkey AS job_id, 'p' || (o_custkey % 5) AS want FROM orders) q
LEFT JOIN w_job_project a ON a.job_id = q.job_id AND a.project_id = q.want
LEFT JOIN (SELECT * FROM w_job_project QUALIFY count(*) OVER (PARTITION BY job_id) = 1) b ON b.job_id = q.job_id"""

# What a recommendation with a configuration makes of a definition.
TABLES["w_job_merged"] = """
SELECT s.job_id, s.inline, s.task_cluster_key, s.error IS NULL AND r.configuration IS NOT NULL AS usable,
       s.cluster_name, 'n' || (s.job_id % 7) AS node_type_id, s.job_id % 8 AS num_workers,
       CASE WHEN s.project_id IS NOT NULL THEN 'sync:project-id=' || s.project_id || ';' ELSE '' END
         || 'sync:run-id=r' || s.job_id || ';team=y' AS tags,
       CASE WHEN s.job_id % 9 <> 0 THEN s.policy_id END AS policy_id,
       concat_ws(',', s.scripts, 's' || (s.job_id % 3)) AS scripts
FROM w_job_single s JOIN b_recommendation r ON r.id = s.job_id"""

# -- clusters of runs and what is known about them ----------------------------------------------------

TABLES["b_run_cluster"] = """
SELECT *, CASE w % 10 WHEN 0 THEN NULL WHEN 1 THEN 's3' WHEN 2 THEN 's3' WHEN 3 THEN 'file' ELSE 'dbfs' END AS scheme,
       CASE WHEN w % 23 = 1 THEN 'Cluster failed to terminate after waiting 600 seconds'
            WHEN w % 17 = 0 THEN 'Unexpected cluster state: RUNNING' END AS ending,
       CASE WHEN c % 5 >= 2 THEN 'stored' WHEN aws AND c % 5 = 1 THEN 'live' END AS source
FROM (SELECT o_orderkey AS run_id, o_custkey AS c, k, o_orderkey + k AS w, o_custkey % 2 = 0 AS aws,
             o_orderkey || '-c' || k AS cluster_id, o_orderkey % 150 AS dir, 1 + o_orderkey % 7 AS first_poll
      FROM orders, (VALUES (0), (1), (2)) AS t(k))"""

TABLES["w_info"] = """
SELECT *, CASE WHEN aws AND coalesce(n_instances, 0) = 0 THEN
            'Unable to find any active or recently terminated instances for cluster `' || cluster_id || '`.'
          WHEN NOT aws AND source IS NULL THEN
            'Unable to find cluster information for cluster `' || cluster_id || '`.' END AS problem
FROM (SELECT *, CASE source WHEN 'stored' THEN run_id % 4 WHEN 'live' THEN (run_id + 1) % 4 END AS n_instances,
             CASE source WHEN 'stored' THEN run_id % 3 WHEN 'live' THEN 0 END AS n_instance_timelines,
             CASE source WHEN 'stored' THEN CASE WHEN aws THEN CAST(k AS BIGINT) ELSE 0 END WHEN 'live' THEN k + 1 END
               AS n_volumes
      FROM b_run_cluster)"""

TABLES["w_event_count"] = """
SELECT user_id || '-c' || (event_id % 3) AS cluster_id, count(*) AS n_events FROM events
GROUP BY user_id || '-c' || (event_id % 3)"""

TABLES["w_fact"] = """
SELECT run_id, cluster_id, count(*) AS n_tasks, max(end_time_ms) AS end_time_ms,
       CASE WHEN count(DISTINCT spark_context_id) = 0 THEN 'No cluster found for tasks'
            WHEN count(DISTINCT spark_context_id) > 1 THEN 'More than 1 cluster found for tasks' END AS context_error
FROM r_task GROUP BY run_id, cluster_id"""

# How waiting for the log of a selected cluster ends: NULL means it is there.
TABLES["w_run_log"] = """
SELECT f.run_id, f.cluster_id,
       CASE WHEN c.scheme IS NULL THEN 'No eventlog location found for cluster.'
            WHEN c.scheme = 'file' THEN 'Unknown log destination: file'
            WHEN c.scheme = 'dbfs' AND f.context_error IS NOT NULL THEN f.context_error
            WHEN bool_or(l.poll_no BETWEEN c.first_poll AND c.first_poll + 19 AND l.final_mtime_ms >= f.end_time_ms
                         AND (c.scheme = 's3' OR (NOT l.any_empty
                              AND l.total_size = CASE WHEN l.poll_no = c.first_poll THEN 0 ELSE l.last_size END))) THEN NULL
            WHEN c.scheme = 'dbfs' AND count(l.dir) = 0 THEN 'No eventlog found'
            WHEN max(l.poll_no) >= c.first_poll + 19 THEN 'No eventlog found' ELSE 'waiting' END AS log_error
FROM w_fact f JOIN b_run_cluster c ON c.cluster_id = f.cluster_id LEFT JOIN w_look l ON l.dir = c.dir
GROUP BY f.run_id, f.cluster_id, c.scheme, c.first_poll, f.context_error"""

TABLES["w_located"] = """
SELECT q.run_id, q.want AS requested_project, s.cluster_id, f.n_tasks, f.end_time_ms, f.context_error,
       CASE WHEN s.cluster_id IS NULL THEN 'Failed to locate cluster in run ' || q.run_id || ' for project '
         || coalesce(q.want, 'None') END AS locate_error,
       i.ending, i.problem, i.source, i.aws, i.n_instances, i.n_instance_timelines, i.n_volumes, i.scheme, i.dir
FROM b_request q
LEFT JOIN (SELECT run_id, any_value(cluster_id) AS cluster_id FROM r_selection WHERE cluster_id IS NOT NULL
           GROUP BY run_id HAVING count(*) = 1) s ON s.run_id = q.run_id
LEFT JOIN w_fact f ON f.cluster_id = s.cluster_id
LEFT JOIN w_info i ON i.cluster_id = s.cluster_id"""

TABLES["w_recorded"] = """
SELECT s.run_id, s.project_id, s.cluster_id, p.auto_apply_recs,
       coalesce(CASE WHEN p.project_id IS NULL THEN 'Failed to retrieve project ' || s.project_id
                     WHEN p.project_model_id = 'OTHER'
                     THEN 'Unexpected project_model_id for project ' || s.project_id || ': OTHER' END,
                i.ending, i.problem, l.log_error) AS error
FROM r_selection s
LEFT JOIN b_project p ON p.project_id = s.project_id
LEFT JOIN w_info i ON i.cluster_id = s.cluster_id
LEFT JOIN w_run_log l ON l.cluster_id = s.cluster_id
WHERE s.cluster_id IS NOT NULL"""

TABLES["w_summary"] = """
SELECT q.run_id, count(r.run_id) AS n_clusters, count(r.run_id) FILTER (r.error IS NULL) AS n_submitted,
       CASE WHEN q.want IS NOT NULL AND q.want NOT IN (SELECT project_id FROM b_project WHERE project_id IS NOT NULL)
            THEN 'Failed to retrieve project ' || q.want
            WHEN count(r.run_id) = 0 THEN 'Failed to locate cluster in run ' || q.run_id || ' for project '
              || coalesce(q.want, 'None')
            WHEN count(r.run_id) FILTER (r.error IS NULL) = 0
            THEN 'Failed to submit run ' || q.run_id || ' to any projects' END AS error
FROM b_request q LEFT JOIN w_recorded r ON r.run_id = q.run_id GROUP BY q.run_id, q.want"""

TABLES["b_status"] = """
SELECT user_id AS run_id, epoch_us(ts) AS ts, event_id,
       CASE WHEN event_type = 'purchase' AND event_id % 20 = 0 THEN 'SUCCESS'
            WHEN event_type = 'error' AND event_id % 20 = 1 THEN 'FAILED' END AS state,
       CASE WHEN event_type = 'signup' AND event_id % 50 = 3 THEN '404' END AS error_code
FROM events"""

TABLES["b_cluster_look"] = """
SELECT user_id AS cluster_id, event_id AS seq, epoch_us(ts) // 1000000 // 200 AS s,
       CASE event_type WHEN 'purchase' THEN 'TERMINATED' WHEN 'error' THEN 'RUNNING' ELSE 'TERMINATING' END AS state,
       CASE WHEN event_type = 'signup' AND event_id % 10 = 3 THEN '404' END AS error_code
FROM events"""

# What a project template makes of the cluster a job's tasks share.
TABLES["w_job_templated"] = """
SELECT s.job_id, s.inline, s.task_cluster_key, s.error IS NULL AND c.c_nationkey % 2 = 0 AS usable, s.cluster_name,
       s.node_type_id, s.num_workers, s.max_workers, s.policy_id, s.scripts,
       'owner=o' || (c.c_custkey % 25) || ';sync:project-id=p' || c.c_custkey
         || CASE WHEN s.project_id IS NULL THEN ';team=x' ELSE '' END AS tags,
       'dbfs:/new' || (c.c_custkey % 25) AS log_url
FROM w_job_single s JOIN orders o ON o.o_orderkey = s.job_id JOIN customer c ON c.c_custkey = o.o_custkey"""
