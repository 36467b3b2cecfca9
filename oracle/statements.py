"""One statement per registered query."""

SQL: dict[str, str] = {}

# -- runs, tasks and clusters -----------------------------------------------------------------------

SQL["eligible_tasks"] = """
SELECT run_id, pos, task_key, cluster_id FROM b_task WHERE cluster_id IS NOT NULL AND task_key <> 't7'"""

SQL["runs_all_success"] = """
SELECT run_id, count(*) FILTER (result_state IS DISTINCT FROM 'SUCCESS') = 0 AS all_success, count(*) AS n_tasks
FROM b_task GROUP BY run_id"""

SQL["task_cluster_resolved"] = """
SELECT run_id, pos, cluster_path,
       CASE WHEN cluster_path IS NULL THEN 'No cluster found for task' END AS cluster_error,
       CASE WHEN cluster_path IS NOT NULL THEN node_type_id END AS node_type_id,
       CASE WHEN cluster_path IS NOT NULL THEN num_workers END AS num_workers,
       CASE WHEN cluster_path IS NOT NULL THEN project_id END AS project_id
FROM r_all"""

SQL["cluster_paths"] = "SELECT run_id, cluster_path, count(*) AS n_tasks FROM r_task GROUP BY run_id, cluster_path"

SQL["tasks_per_cluster"] = """
SELECT run_id, cluster_id, count(*) AS n_tasks, arg_min(task_key, pos) AS first_task,
       arg_max(task_key, pos) AS last_task
FROM r_task GROUP BY run_id, cluster_id"""

SQL["unambiguous_cluster_paths"] = "SELECT run_id, project_id, cluster_path, cluster_id FROM r_path"

SQL["run_context_id"] = """
SELECT run_id, CASE WHEN n = 1 THEN one END AS spark_context_id,
       CASE WHEN n = 0 THEN 'No cluster found for tasks' WHEN n > 1 THEN 'More than 1 cluster found for tasks'
       END AS context_error
FROM (SELECT run_id, count(DISTINCT spark_context_id) AS n, any_value(spark_context_id) AS one
      FROM b_task GROUP BY run_id)"""

SQL["run_end_time"] = "SELECT run_id, max(end_time_ms) AS end_time_ms FROM b_task GROUP BY run_id"

SQL["project_cluster_selection"] = """
SELECT run_id, project_id, cluster_id, branch FROM r_selection WHERE cluster_id IS NOT NULL"""

SQL["run_cluster_projects"] = """
SELECT r.run_id, r.cluster_path, r.project_id, p.project_model_id,
       CASE WHEN p.project_id IS NULL THEN 'Failed to retrieve project ' || coalesce(r.project_id, 'None')
            WHEN p.project_model_id = 'OTHER' THEN 'Unexpected project_model_id for project ' || r.project_id
                 || ': OTHER' END AS project_error
FROM r_path r LEFT JOIN b_project p ON p.project_id = r.project_id"""

# -- projects, submissions, recommendations -----------------------------------------------------------

SQL["projects_by_app"] = "SELECT project_id, app_id, project_model_id, auto_apply_recs FROM b_project"

SQL["submissions_by_project"] = "SELECT project_id, id, state, created_at, node_type_id FROM b_submission"

SQL["recommendations_by_project"] = "SELECT project_id, id, state, created_at, configuration FROM b_recommendation"

SQL["latest_submission_config"] = """
SELECT p.project_id, s.id AS submission_id, s.node_type_id, s.num_workers,
       CASE WHEN s.id IS NULL THEN 'NoSubmissionsFound' END AS error
FROM b_project p LEFT JOIN (
  SELECT * FROM b_submission s WHERE NOT EXISTS (
    SELECT 1 FROM b_submission x WHERE x.project_id = s.project_id
      AND (x.created_at > s.created_at OR (x.created_at = s.created_at AND x.id > s.id)))) s
  ON s.project_id = p.project_id"""

SQL["latest_success_submission"] = """
SELECT p.project_id, s.id AS submission_id, s.node_type_id, s.num_workers,
       CASE WHEN s.id IS NOT NULL THEN NULL
            WHEN p.project_id IN (SELECT project_id FROM b_submission) THEN 'NoSuccessfulSubmissionsFound'
            ELSE 'NoSubmissionsFound' END AS error
FROM b_project p LEFT JOIN (
  SELECT *, row_number() OVER (PARTITION BY project_id ORDER BY created_at DESC, id DESC) AS rn
  FROM b_submission WHERE state = 'SUCCESS') s ON s.project_id = p.project_id AND s.rn = 1"""

SQL["first_project_by_app"] = """
SELECT app_id, project_id FROM b_project
QUALIFY row_number() OVER (PARTITION BY app_id ORDER BY created_at, project_id) = 1"""

SQL["resolved_project_ids"] = """
WITH v AS (
  SELECT CASE c_custkey % 6
    WHEN 0 THEN CAST(CAST(md5(c_name) AS UUID) AS VARCHAR)
    WHEN 1 THEN '{' || md5(c_name) || '}'
    WHEN 2 THEN 'urn:uuid:' || CAST(CAST(md5(c_name) AS UUID) AS VARCHAR)
    WHEN 3 THEN 'unknown' || c_custkey
    ELSE c_mktsegment || (c_custkey % 60) END AS value, c_custkey % 6 < 3 AS uuid FROM customer),
earliest AS (SELECT app_id, arg_min(project_id, created_at) AS project_id FROM b_project GROUP BY app_id)
SELECT value, CASE WHEN uuid THEN value ELSE project_id END AS project_id,
       CASE WHEN NOT uuid AND project_id IS NULL THEN 'No project found for ''' || value || '''' END AS error
FROM v LEFT JOIN earliest ON app_id = value"""

SQL["latest_recommendation"] = """
SELECT project_id, recommendation_id, configuration,
       CASE WHEN recommendation_id IS NULL OR configuration IS NOT NULL THEN NULL
            WHEN NOT has_recommendation THEN 'Recommendation not found'
            ELSE 'Recommendation configuration not found' END AS error
FROM w_latest_recommendation"""

SQL["recommendation_status"] = """
SELECT id, CASE state WHEN 'SUCCESS' THEN 'ready' WHEN 'FAILURE' THEN 'Recommendation failed' ELSE 'pending' END
  AS status FROM b_recommendation"""

SQL["project_eligibility"] = """
SELECT project_id, project_model_id <> 'OTHER' AS eligible, project_model_id <> 'OTHER' AND auto_apply_recs
  AS auto_apply,
  CASE WHEN project_model_id = 'OTHER' THEN 'Unexpected project_model_id for project ' || project_id || ': OTHER'
  END AS error FROM b_project"""

SQL["project_patch_merge"] = """
SELECT project_id, CASE WHEN c_custkey % 3 = 2 THEN 'new ' || c_custkey ELSE description END AS description, app_id,
       CASE c_custkey % 4 WHEN 0 THEN auto_apply_recs WHEN 1 THEN false ELSE true END AS auto_apply_recs,
       CASE WHEN c_custkey % 5 IN (0, 1) THEN optimize_instance_size ELSE true END AS optimize_instance_size
FROM b_project"""

SQL["api_error_rows"] = """
SELECT response_id, CASE WHEN error_code IS NOT NULL THEN 'Databricks API Error' END AS code,
       CASE WHEN error_code IS NULL THEN NULL WHEN error_code = '' THEN message
            ELSE error_code || ': ' || coalesce(message, 'None') END AS error_message
FROM b_response"""

SQL["response_consistency"] = """
SELECT response_id, CASE WHEN has_result AND error_code IS NOT NULL THEN 'must not provide both result and error'
  WHEN NOT has_result AND error_code IS NULL THEN 'must provide result or error' END AS problem
FROM b_response"""

# -- workspaces and hosts -----------------------------------------------------------------------------

SQL["workspace_configs"] = """
SELECT workspace_id, databricks_host, collection_type, compute_provider, aws_region FROM b_workspace"""

SQL["workspace_patch_merge"] = """
SELECT workspace_id,
       CASE s_suppkey % 3 WHEN 0 THEN aws_region WHEN 2 THEN 'us-west-2' END AS aws_region,
       CASE (s_suppkey + 1) % 3 WHEN 0 THEN databricks_plan_type WHEN 2 THEN 'Premium' END AS databricks_plan_type,
       CASE (s_suppkey + 2) % 3 WHEN 0 THEN aws_iam_role_arn WHEN 2 THEN 'arn:new' END AS aws_iam_role_arn,
       collection_type
FROM b_workspace"""

SQL["workspace_violations"] = """
SELECT workspace_id, 'Unknown plan type' AS violation FROM b_workspace WHERE databricks_plan_type = 'Trial'
UNION ALL SELECT workspace_id, 'Unknown collection type' FROM b_workspace WHERE collection_type IS NULL
UNION ALL SELECT workspace_id, 'Unknown monitoring type' FROM b_workspace
  WHERE monitoring_type IS NULL AND collection_type IS DISTINCT FROM 'remote'
UNION ALL SELECT workspace_id, 'Unknown compute provider' FROM b_workspace WHERE compute_provider = 'gcp'
UNION ALL SELECT workspace_id, 'AWS Region is required for AWS compute provider' FROM b_workspace
  WHERE compute_provider = 'aws' AND aws_region IS NULL
UNION ALL SELECT workspace_id, 'Unknown AWS region' FROM b_workspace WHERE aws_region = 'mars-1'
UNION ALL SELECT workspace_id, 'AWS Instance Profile ARN is required for REMOTE hosted AWS environments'
  FROM b_workspace WHERE compute_provider = 'aws' AND collection_type = 'remote' AND instance_profile_arn IS NULL
UNION ALL SELECT workspace_id, 'AWS IAM Role ARN is required for AWS compute provider'
  FROM b_workspace WHERE compute_provider = 'aws' AND collection_type = 'hosted' AND aws_iam_role_arn IS NULL
UNION ALL SELECT workspace_id, 'Missing required fields for Azure compute provider: ' || concat_ws(', ',
    CASE WHEN azure_tenant_id IS NULL THEN 'azure_tenant_id' END,
    CASE WHEN azure_client_id IS NULL THEN 'azure_client_id' END,
    CASE WHEN azure_client_secret IS NULL THEN 'azure_client_secret' END,
    CASE WHEN azure_subscription_id = '' THEN 'azure_subscription_id' END)
  FROM b_workspace WHERE compute_provider = 'azure' AND collection_type = 'hosted'
  AND (azure_tenant_id IS NULL OR azure_client_id IS NULL OR azure_client_secret IS NULL
       OR azure_subscription_id = '')"""

SQL["platform_from_host"] = """
SELECT workspace_id, CASE s_suppkey % 3 WHEN 0 THEN 'azure' WHEN 1 THEN 'aws' END AS platform,
       CASE s_suppkey % 3 WHEN 0 THEN 'azure-databricks' WHEN 1 THEN 'aws-databricks' END AS product
FROM b_workspace"""

SQL["normalized_host"] = """
SELECT page_id, 'https://' || split_part(split_part(split_part(split_part(url, '://', 2), '/', 1), '?', 1), '#', 1)
  AS host FROM b_log_url"""

SQL["eventlog_url_class"] = """
SELECT page_id, CASE split_part(url, ':', 1) WHEN 's3' THEN 'presign' WHEN 'http' THEN 'as_is'
  WHEN 'https' THEN 'as_is' ELSE 'Unsupported event log URL scheme' END AS url_class FROM b_log_url"""

# -- fleet --------------------------------------------------------------------------------------------

SQL["ec2_instances"] = """
SELECT CAST(cluster_id AS VARCHAR) AS cluster_id, CAST(instance_id AS VARCHAR) AS instance_id,
       CASE WHEN running THEN 'running' ELSE 'stopped' END AS state, 'm' || (instance_id % 3) AS type
FROM b_instance WHERE ours"""

SQL["ebs_volumes_for_instances"] = """
SELECT CAST(cluster_id AS VARCHAR) AS cluster_id, CAST(volume_id AS VARCHAR) AS volume_id FROM w_cluster_volume"""

SQL["azure_running_vms"] = "SELECT cluster_id, instance_id, 'D' || (CAST(instance_id AS BIGINT) % 4) AS size FROM w_running_vm"

SQL["running_instances"] = """
SELECT 'aws' AS platform, CAST(cluster_id AS VARCHAR) AS cluster_id, CAST(instance_id AS VARCHAR) AS instance_id
FROM b_instance WHERE ours AND running
UNION ALL SELECT 'azure', cluster_id, instance_id FROM w_running_vm"""

SQL["fleet_counts"] = """
SELECT CAST(c AS VARCHAR) AS cluster_id,
       (SELECT count(*) FROM b_instance WHERE ours AND cluster_id = c) AS n_instances,
       (SELECT count(*) FROM w_cluster_volume WHERE cluster_id = c) AS n_volumes
FROM (SELECT DISTINCT cluster_id AS c FROM b_instance WHERE ours)"""

SQL["instance_timelines"] = "SELECT * FROM w_timeline_rows"

SQL["timelines_all"] = "SELECT * FROM w_timeline_rows"

SQL["retired_instances"] = """
SELECT o.cluster_id, o.instance_id, epoch_ms(p.next_ts) AS retired_at_ms, epoch_ms(o.poll_ts) AS last_seen_ms
FROM b_obs o JOIN w_step p USING (cluster_id, poll_ts)
WHERE p.next_ts IS NOT NULL
  AND (o.cluster_id, o.instance_id, p.next_ts) NOT IN (SELECT cluster_id, instance_id, poll_ts FROM b_obs)"""

SQL["inventory_latest"] = """
SELECT cluster_id, instance_id, seen_ms, state FROM (
  SELECT user_id % 5 AS cluster_id, user_id AS instance_id, epoch_us(ts) // 1000 AS seen_ms, event_type AS state,
         row_number() OVER (PARTITION BY user_id ORDER BY epoch_us(ts) // 1000 DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1"""

SQL["monitored_clusters"] = """
SELECT cluster_id, instance_id, epoch_ms(min(poll_ts)) AS first_seen_ms, epoch_ms(max(poll_ts)) AS last_seen_ms,
       max(nr) = any_value(newest) AS is_active
FROM (SELECT o.cluster_id, o.instance_id, o.poll_ts, a.nr,
             a.nr - row_number() OVER (PARTITION BY o.cluster_id, o.instance_id ORDER BY o.poll_ts) AS island,
             (SELECT max(nr) FROM w_applied x WHERE x.cluster_id = o.cluster_id) AS newest
      FROM b_obs o JOIN w_applied a USING (cluster_id, poll_ts))
GROUP BY cluster_id, instance_id, island"""

SQL["monitor_step"] = "SELECT * FROM w_timeline_rows"

# -- clusters, events and event logs ------------------------------------------------------------------

SQL["scan_clusters"] = """
SELECT cluster_id, state, spark_context_id, node_type_id, num_workers, s3, dbfs FROM b_cluster"""

SQL["cluster_state_class"] = """
SELECT cluster_id, CASE WHEN state = 'TERMINATED' THEN 'done' WHEN state = 'TERMINATING' THEN 'wait'
  WHEN state IS NULL THEN 'Unexpected cluster state: None' WHEN state = 'ERROR' THEN 'Unexpected cluster state: ERROR'
  ELSE 'terminate' END AS state_class FROM b_cluster"""

SQL["log_destination"] = "SELECT cluster_id, url, scheme, bucket, base FROM b_cluster"

SQL["telemetry_paths"] = """
SELECT cluster_id, base || '/eventlog/' || cluster_id AS log_prefix,
       base || '/sync_data/' || spark_context_id || '/' || platform || '_cluster_info.json' AS info_key,
       CASE WHEN url LIKE '%dbfs:/%' THEN url ELSE 'dbfs:/' || url END AS dbfs_url, 'dbfs:/' || base AS dbfs_base
FROM b_cluster WHERE base IS NOT NULL"""

SQL["sink_routing"] = """
SELECT cluster_id, scheme AS filesystem,
       CASE WHEN error IS NULL AND scheme = 's3' THEN 's3://' || bucket || '/' || key
            WHEN error IS NULL THEN 'dbfs:/' || key END AS target, error,
       CASE WHEN spark_context_id IS NOT NULL THEN
         'reports/sync_data/' || spark_context_id || '/' || platform || '_cluster_info.json' END AS moved_target,
       CASE WHEN spark_context_id IS NULL THEN 'missing spark context' END AS moved_error
FROM (SELECT *, base || '/sync_data/' || spark_context_id || '/' || platform || '_cluster_info.json' AS key,
             CASE WHEN spark_context_id IS NULL THEN 'missing spark context'
                  WHEN url IS NULL THEN 'missing cluster log destination'
                  WHEN platform = 'azure' AND scheme = 's3' THEN 'Unsupported filesystem: s3' END AS error
      FROM b_cluster)"""

SQL["cluster_events_all"] = """
SELECT cluster_id, row_number() OVER (PARTITION BY cluster_id ORDER BY page_no, pos) AS seq, page_no, pos, ts_ms,
       type, first_value(total_count) OVER (PARTITION BY cluster_id ORDER BY page_no) AS total_count
FROM b_event_row"""

SQL["redacted_events"] = """
SELECT cluster_id, page_no, pos, 'k' AS keys, props ->> '$.k' AS k FROM b_event_row"""

SQL["json_time_encodings"] = """
SELECT event_id, stamp || fraction || '+00:00' AS zoned, stamp || fraction AS naive, stamp || fraction || 'Z' AS utc,
       stamp || 'Z' AS utc_seconds
FROM (SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS stamp,
             CASE WHEN event_id % 2 = 0 OR epoch_us(ts) % 1000000 = 0 THEN '' ELSE strftime(ts, '.%f') END AS fraction
      FROM events)"""

SQL["log_listing_by_prefix"] = """
SELECT k.event_id, o.cluster_id, k.key, k.file_size, k.mtime_ms
FROM (SELECT event_id, user_id * 10 AS file_size, epoch_ms(date_trunc('second', ts)) AS mtime_ms, CASE WHEN user_id % 7 <> 0 THEN 'base' || (user_id % 3) || '/x/' ELSE '' END || 'eventlog/c'
             || (user_id % 50) || '_10_0_0_1/eventlog-' || event_id AS key FROM events) k
JOIN (SELECT DISTINCT 'c' || (s_suppkey % 60) AS cluster_id,
             CASE WHEN s_nationkey % 5 <> 0 THEN 'base' || (s_nationkey % 3) || '/x/' ELSE '' END || 'eventlog/c'
             || (s_suppkey % 60) AS prefix FROM supplier) o ON starts_with(k.key, o.prefix)"""

SQL["log_dir_by_context"] = """
WITH sub AS (SELECT DISTINCT user_id, 'dbfs:/logs' || (user_id % 3) || '/eventlog/c' || (user_id % 5)
             || '_10_0_0_1/' || (user_id * 1000 + 7) AS path FROM events WHERE user_id % 5 <> 4),
want AS (SELECT c_custkey AS run_id, CASE WHEN c_custkey % 50 = 0 THEN 'dbfs:/gone/eventlog/' END AS gone, 'dbfs:/logs' || (c_nationkey % 3) || '/' AS root, CASE WHEN c_custkey % 4 = 0 THEN c_custkey + 700 ELSE c_custkey * 1000 + 7 END
         AS spark_context_id FROM customer)
SELECT run_id, spark_context_id, arg_min(path, (-(user_id % 5), user_id)) AS log_dir,
       'Unable to locate files in DBFS dir ' || any_value(gone) AS log_error
FROM want LEFT JOIN sub ON gone IS NULL AND starts_with(path, root) AND contains(path, CAST(spark_context_id AS VARCHAR))
GROUP BY run_id, spark_context_id"""

SQL["final_rollover_files"] = """
SELECT pos AS event_id, CASE WHEN path LIKE '%.json.gz' THEN 'eventlog.json' WHEN is_final THEN 'eventlog'
  ELSE 'eventlog-' || pos END AS stem, is_final FROM b_listing"""

SQL["final_log_flushed"] = """
SELECT dir, poll_no, coalesce(final_mtime_ms >= run_end_ms, false) AS flushed FROM w_look"""

SQL["log_size_changes"] = """
SELECT dir, poll_no, total_size, last_size, total_size <> last_size AS size_changed, any_empty FROM w_look"""

SQL["eventlog_completeness"] = "SELECT dir, scheme, poll_no, verdict FROM w_verdict"

SQL["eventlog_ready_per_run"] = "SELECT dir, nth, scheme, first_poll, ready_poll, polls, outcome FROM w_wait"

SQL["eventlog_ready_poll"] = "SELECT dir, scheme, ready_poll, polls, outcome FROM w_ready"

SQL["eventlog_bundle_manifest"] = """
SELECT l.dir, r.nth, l.poll_no, l.path,
       CASE WHEN r.scheme = 'dbfs' AND NOT ends_with(l.path, '.gz') THEN split_part(l.path, '/', -1) || '.gz'
            ELSE split_part(l.path, '/', -1) END AS bundle_name, l.file_size::BIGINT AS file_size
FROM b_listing l JOIN w_wait r ON r.dir = l.dir AND r.ready_poll = l.poll_no"""

# -- jobs, definitions and recommendations ------------------------------------------------------------

_TAGS = "CASE WHEN project_id IS NOT NULL THEN 'sync:project-id=' || project_id ELSE 'team=x' END"

SQL["scan_run_tasks"] = """
SELECT job_id AS run_id, CAST(i AS INTEGER) AS pos, task_key, job_cluster_key,
       CASE WHEN i % 3 <> 2 THEN job_id || '-' || job_cluster_key END AS cluster_id,
       CASE WHEN i % 3 <> 2 THEN job_id * 10 + i END AS spark_context_id,
       CASE WHEN i % 2 = 0 THEN 'SUCCESS' END AS result_state, job_id * 1000 + i AS end_time_ms, node_type_id
FROM b_job_task
UNION ALL SELECT o_orderkey, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM orders WHERE o_orderkey % 5 = 0"""

SQL["scan_job_clusters"] = """
SELECT job_id, pos, job_cluster_key, node_type_id, CAST(num_workers AS INTEGER) AS num_workers, project_id
FROM b_job_shared"""

SQL["job_single_cluster"] = f"""
SELECT job_id, CASE WHEN ok THEN cluster_name END AS cluster_name, CASE WHEN ok THEN node_type_id END AS node_type_id,
       CASE WHEN ok THEN num_workers END AS num_workers,
       CASE WHEN ok THEN CAST(max_workers AS BIGINT) END AS max_workers,
       CASE WHEN ok THEN {_TAGS} END AS tags, CASE WHEN ok THEN policy_id END AS policy_id,
       CASE WHEN ok THEN scripts END AS scripts, CAST(NULL AS VARCHAR) AS log_url, error AS cluster_error
FROM (SELECT *, error IS NULL AS ok FROM w_job_single)"""

SQL["job_project_clusters"] = f"""
SELECT job_id, project_id, path_kind, path_key, cluster_name, node_type_id, num_workers,
       CAST(max_workers AS BIGINT) AS max_workers, {_TAGS} AS tags, policy_id, scripts,
       CAST(NULL AS VARCHAR) AS log_url
FROM w_job_project"""

SQL["recommendation_target"] = "SELECT job_id, project_id, path_kind, path_key, target_error FROM w_target"

SQL["merged_documents"] = """
WITH o AS (SELECT o_orderkey AS k, o_orderkey % 13 <> 0 AS patched FROM orders)
SELECT k AS job_id, CASE WHEN patched THEN 'm' || (k % 7) ELSE 'n' || (k % 5) END AS node_type_id, NULL::VARCHAR AS num_workers,
       CASE WHEN patched THEN (k % 9)::VARCHAR END AS max_workers, 'M' || (k % 3) AS mode, 'z' || (k % 4) AS zone, 'arn' || (k % 11) AS profile,
       CASE WHEN patched THEN (k % 8)::VARCHAR END AS ebs, (k % 6)::VARCHAR AS deep_b, CASE WHEN patched THEN (k % 2)::VARCHAR END AS deep_c,
       CASE WHEN patched THEN 'u' || (k % 6) END AS image, 'w' || (k % 5) AS script, CASE WHEN patched THEN 's' || (k % 3) END AS script_added,
       CASE WHEN NOT patched OR k % 5 <> 0 THEN '1' END AS tag_a, CASE WHEN patched AND k % 5 <> 0 THEN '2' END AS tag_b
FROM o"""

SQL["deep_merge_config"] = """
SELECT s.job_id, s.pos, s.cluster_name, CASE WHEN patched THEN 'n' || (s.job_id % 7) ELSE s.node_type_id END AS node_type_id,
       s.job_id % 8 AS num_workers, CAST(s.max_workers AS BIGINT) AS max_workers,
       CASE WHEN s.project_id IS NOT NULL THEN 'sync:project-id=' || s.project_id || CASE WHEN patched THEN ';' ELSE '' END
            ELSE '' END
         || CASE WHEN patched THEN 'sync:run-id=r' || s.job_id || ';team=y'
                 WHEN s.project_id IS NULL THEN 'team=x' ELSE '' END AS tags,
       CASE WHEN NOT patched OR s.job_id % 9 <> 0 THEN s.policy_id END AS policy_id,
       CASE WHEN patched THEN s.scripts || ',s' || (s.job_id % 3) ELSE s.scripts END AS scripts,
       CAST(NULL AS VARCHAR) AS log_url
FROM b_job_shared s JOIN (SELECT id, configuration IS NOT NULL AS patched FROM b_recommendation) r
  ON r.id = s.job_id"""

SQL["recommended_cluster_defs"] = """
SELECT project_id, CASE WHEN ok THEN 'base' END AS cluster_name,
       CASE WHEN ok THEN 'n' || (r % 7) END AS node_type_id, CASE WHEN ok THEN r % 8 END AS num_workers,
       CAST(NULL AS BIGINT) AS max_workers,
       CASE WHEN ok THEN 'sync:project-id=' || project_id || ';sync:run-id=r' || r || ';team=y' END AS tags,
       CASE WHEN ok AND r % 9 <> 0 THEN 'pol' END AS policy_id,
       CASE WHEN ok THEN CASE WHEN c % 3 <> 0 THEN 'b,' ELSE '' END || 's' || (r % 3) END AS scripts,
       CASE WHEN ok AND c % 4 = 0 THEN 'dbfs:/old' END AS log_url,
       CASE WHEN ok THEN NULL WHEN r IS NULL THEN 'no_recommendation'
            WHEN NOT has_recommendation THEN 'Recommendation not found'
            ELSE 'Recommendation configuration not found' END AS error
FROM (SELECT project_id, recommendation_id AS r, configuration IS NOT NULL AS ok, has_recommendation,
             CAST(substr(project_id, 2) AS BIGINT) AS c FROM w_latest_recommendation)"""

SQL["definition_vs_recommendation"] = """
SELECT project_id, CASE WHEN recommendation_id IS NOT NULL THEN 'n' || (CAST(substr(project_id, 2) AS BIGINT) % 5) END
         AS node_type_id, configuration AS cluster_recommendation,
       CASE WHEN recommendation_id IS NULL THEN 'Recommendation failed' END AS error
FROM w_latest_recommendation"""

SQL["rewritten_jobs"] = """
SELECT t.job_id, 'tasks' AS section, CAST(t.i AS INTEGER) AS pos, t.task_key AS key,
       CASE WHEN here THEN NULL WHEN t.inline THEN 'own' END AS cluster_name,
       CASE WHEN here THEN m.node_type_id ELSE t.node_type_id END AS node_type_id,
       CASE WHEN here THEN m.num_workers ELSE t.num_workers END AS num_workers, CAST(NULL AS BIGINT) AS max_workers,
       CASE WHEN here THEN m.tags WHEN NOT t.inline THEN NULL
            WHEN t.project_id IS NULL THEN 'team=x' ELSE 'sync:project-id=' || t.project_id END AS tags,
       CASE WHEN here THEN m.policy_id END AS policy_id, CASE WHEN here THEN m.scripts END AS scripts,
       CAST(NULL AS VARCHAR) AS log_url, CASE WHEN here OR t.inline THEN 'M' || (t.job_id % 3) END AS mode,
       '/n' || t.job_id || '-' || t.i AS notebook
FROM (SELECT t.*, t.i = 0 AND m.usable AND m.task_cluster_key IS NULL AS here
      FROM b_job_task t JOIN w_job_merged m ON m.job_id = t.job_id) t JOIN w_job_merged m ON m.job_id = t.job_id
UNION ALL
SELECT s.job_id, 'job_clusters',
       CAST(row_number() OVER (PARTITION BY s.job_id ORDER BY here, s.pos) - 1 AS INTEGER), s.job_cluster_key,
       s.cluster_name, CASE WHEN here THEN m.node_type_id ELSE s.node_type_id END,
       CASE WHEN here THEN m.num_workers ELSE s.num_workers END,
       CASE WHEN NOT here THEN CAST(s.max_workers AS BIGINT) END,
       CASE WHEN here THEN m.tags WHEN s.project_id IS NULL THEN 'team=x' ELSE 'sync:project-id=' || s.project_id END,
       CASE WHEN here THEN m.policy_id ELSE s.policy_id END, CASE WHEN here THEN m.scripts ELSE s.scripts END, NULL,
       'M' || (s.job_id % 3), NULL
FROM (SELECT s.*, coalesce(m.usable AND m.task_cluster_key = s.job_cluster_key, false) AS here
      FROM b_job_shared s JOIN w_job_merged m ON m.job_id = s.job_id) s JOIN w_job_merged m ON m.job_id = s.job_id"""

SQL["job_update_payloads"] = """
SELECT job_id, CASE WHEN error IS NULL AND path_kind = 'job_clusters' THEN path_key END AS job_cluster_key,
       CASE WHEN error IS NULL AND path_kind = 'job_clusters' THEN 'n' || (job_id % 7) END AS shared_node,
       CASE WHEN error IS NULL AND path_kind = 'tasks' THEN path_key END AS task_key,
       CASE WHEN error IS NULL AND path_kind = 'tasks' THEN 'n' || (job_id % 7) END AS inline_node,
       CASE WHEN error IS NULL THEN 'M' || (job_id % 3) END AS mode, error
FROM (SELECT *, CASE WHEN target_error IS NOT NULL THEN target_error
                     WHEN job_id % 5 = 0 THEN 'Recommendation not found'
                     WHEN job_id % 7 = 0 THEN 'Recommendation configuration not found' END AS error FROM w_target)"""

SQL["one_off_payloads"] = """
SELECT job_id, 'job' || job_id AS run_name, CASE WHEN error IS NULL THEN CAST(n AS INTEGER) ELSE 0 END AS n_tasks,
       CASE WHEN error IS NULL AND n = 1 THEN node_type_id END AS inline_node, CAST(NULL AS VARCHAR) AS inline_name,
       CASE WHEN error IS NULL AND n > 1 THEN coalesce(cluster_name, 'job' || job_id) END AS cluster_name,
       CAST(NULL AS VARCHAR) AS policy_id,
       CASE WHEN error IS NULL AND n > 1 THEN CAST(10 AS BIGINT) END AS autotermination_minutes,
       CASE WHEN error IS NULL THEN 'M' || (job_id % 3) END AS mode,
       CASE WHEN error IS NULL THEN list_aggregate(list_transform(range(n), lambda i: '/n' || job_id || '-' || i), 'string_agg', ',') END AS notebooks, error
FROM w_job_single"""

SQL["templated_clusters"] = """
SELECT 'p' || c_custkey AS project_id, 'base' AS cluster_name, 'n' || (c_custkey % 5) AS node_type_id,
       c_custkey % 8 AS num_workers, CASE WHEN c_custkey % 2 = 0 THEN CAST(9 AS BIGINT) END AS max_workers,
       CASE WHEN t THEN 'owner=o' || (c_custkey % 25) || ';' ELSE '' END || 'sync:project-id=p' || c_custkey AS tags,
       'pol' AS policy_id, CASE WHEN c_custkey % 3 <> 0 THEN 'b' END AS scripts,
       CASE WHEN t THEN 'dbfs:/new' || (c_custkey % 25) WHEN c_custkey % 4 = 0 THEN 'dbfs:/old' END AS log_url
FROM (SELECT *, c_nationkey % 2 = 0 AS t FROM customer)"""

# -- waiting ------------------------------------------------------------------------------------------

SQL["run_final_state"] = "SELECT o_orderkey AS run_id, o_orderkey % 6 < 4 AS is_final FROM orders"

SQL["run_first_final_state"] = """
SELECT u.run_id, CASE WHEN e.error_code IS NULL THEN e.state END AS state, 'Databricks API Error: ' || e.error_code AS error
FROM (SELECT DISTINCT user_id AS run_id FROM events) u LEFT JOIN (
  SELECT * FROM b_status WHERE state IS NOT NULL OR error_code IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY ts, event_id) = 1) e ON e.run_id = u.run_id"""

SQL["cluster_termination_outcome"] = """
SELECT u.cluster_id, coalesce(
  CASE WHEN x.error_code IS NOT NULL THEN 'Databricks API Error: ' || x.error_code
       WHEN x.state = 'TERMINATED' THEN 'ok'
       WHEN x.state = 'TERMINATING' THEN 'Cluster failed to terminate after waiting 600 seconds'
       ELSE 'Unexpected cluster state: ' || x.state END, 'waiting') AS outcome
FROM (SELECT DISTINCT user_id AS cluster_id FROM events) u LEFT JOIN (
  SELECT * FROM (SELECT *, s - min(s) OVER (PARTITION BY cluster_id) AS elapsed FROM b_cluster_look)
  WHERE error_code IS NOT NULL OR state <> 'TERMINATING' OR elapsed > 600
  QUALIFY row_number() OVER (PARTITION BY cluster_id ORDER BY s, seq) = 1) x ON x.cluster_id = u.cluster_id"""

SQL["recommendation_first_final"] = """
SELECT u.recommendation_id, CASE e.state WHEN 'SUCCESS' THEN 'ready' WHEN 'FAILED' THEN 'Recommendation failed'
  ELSE 'pending' END AS outcome
FROM (SELECT DISTINCT user_id AS recommendation_id FROM events) u LEFT JOIN (
  SELECT * FROM b_status WHERE state IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY ts, event_id) = 1) e ON e.run_id = u.recommendation_id"""

# -- cluster information, reports and submissions -----------------------------------------------------

SQL["cluster_info_fallback"] = """
SELECT cluster_id, source, n_instances, n_instance_timelines, n_volumes FROM w_info"""

SQL["report_completeness"] = """
SELECT cluster_id, coalesce(n_instances, 0) = 0 AS instances_missing,
       coalesce(n_instance_timelines, 0) = 0 AS timelines_missing, coalesce(n_volumes, 0) = 0 AS volumes_missing,
       CASE WHEN k <> 2 THEN problem END AS info_error
FROM w_info"""

SQL["cluster_reports"] = """
SELECT i.cluster_id, CASE WHEN aws THEN 'aws' ELSE 'azure' END AS platform, 'Standard' AS plan_type,
       'Jobs Compute' AS compute_type, CASE WHEN ok THEN n_instances END AS n_instances,
       CASE WHEN ok AND aws THEN coalesce(n_instance_timelines, 0) WHEN ok THEN n_instance_timelines END AS n_timelines,
       CASE WHEN ok AND aws THEN coalesce(n_volumes, 0) END AS n_volumes, coalesce(n_events, 0) AS n_events,
       CASE WHEN NOT ok THEN problem END AS info_error
FROM (SELECT *, k = 2 OR problem IS NULL AS ok FROM w_info) i LEFT JOIN w_event_count e ON e.cluster_id = i.cluster_id"""

SQL["report_json"] = """
SELECT cluster_id, '{"cluster_id":"' || cluster_id || '"' || coalesce(',"state":"' || state || '"', '')
  || ',"num_workers":' || num_workers || ',"log":{'
  || coalesce('"url":"' || url || '","bucket":"' || bucket || '"', '') || '}}' AS report
FROM b_cluster"""

SQL["cluster_info_documents"] = """
SELECT c AS cluster_id, c * 1000 + 7 AS spark_context_id,
       (SELECT count(DISTINCT user_id) FROM events WHERE user_id % 5 = c) AS n_instances,
       (SELECT count(*) FROM w_timeline_rows t WHERE t.cluster_id = c) AS n_instance_timelines,
       (SELECT count(*) FROM w_cluster_volume v WHERE v.cluster_id = c) AS n_volumes
FROM (SELECT DISTINCT user_id % 5 AS c FROM events) WHERE c NOT IN (3, 4)"""

SQL["submission_rows"] = """
SELECT sha256(s.run_id || '|' || s.project_id || '|' || s.cluster_id) AS submission_id, s.run_id, s.project_id,
       s.cluster_id, CASE WHEN c.aws THEN 'aws-databricks' ELSE 'azure-databricks' END AS product
FROM r_selection s JOIN b_run_cluster c ON c.cluster_id = s.cluster_id"""

# -- workflows ----------------------------------------------------------------------------------------

SQL["cluster_report_for_run"] = """
SELECT l.run_id, requested_project, 'Standard' AS plan_type, 'Jobs Compute' AS compute_type,
       CASE WHEN ok THEN l.cluster_id END AS cluster_id, CASE WHEN ok THEN n_tasks END AS n_tasks,
       CASE WHEN ok THEN n_instances END AS n_instances, CASE WHEN ok THEN n_instance_timelines END AS n_timelines,
       CASE WHEN ok AND aws THEN n_volumes END AS n_volumes, CASE WHEN ok THEN coalesce(n_events, 0) END AS n_events,
       coalesce(locate_error, ending, problem) AS error
FROM (SELECT *, coalesce(locate_error, ending, problem) IS NULL AS ok FROM w_located) l
LEFT JOIN w_event_count e ON e.cluster_id = l.cluster_id"""

SQL["submission_for_run"] = """
SELECT run_id, requested_project, cluster_id,
       CASE WHEN error IS NULL THEN CASE WHEN aws THEN 'aws-databricks' ELSE 'azure-databricks' END END AS product,
       CASE WHEN error IS NULL THEN sha256(run_id || '|' || requested_project || '|' || cluster_id) END AS submission_id,
       error
FROM (SELECT l.*, coalesce(locate_error, ending, problem, g.log_error) AS error
      FROM w_located l LEFT JOIN w_run_log g ON g.cluster_id = l.cluster_id WHERE requested_project IS NOT NULL)"""

SQL["submission_with_cluster_info"] = """
SELECT run_id, requested_project, cluster_id,
       CASE WHEN error IS NULL THEN sha256(run_id || '|' || requested_project || '|' || cluster_id) END AS submission_id,
       CASE WHEN error IS NULL THEN coalesce(state = 'complete', false) END AS has_log, error
FROM (SELECT *, coalesce(locate_error, CASE WHEN state = 'incomplete'
                         THEN 'Event log was missing or incomplete. Please retry.' END) AS error
  FROM (SELECT l.*, CASE WHEN l.run_id % 7 = 0 THEN 'skipped' WHEN scheme IS NULL OR scheme = 'file' THEN 'no place'
                    WHEN scheme = 'dbfs' AND context_error IS NOT NULL THEN 'no context'
                    WHEN scheme = 'dbfs' AND n.dir IS NULL THEN 'no log'
                    WHEN n.final_mtime_ms >= l.end_time_ms
                         AND (scheme = 's3' OR (NOT n.any_empty AND n.total_size = (l.run_id % 4) * 10)) THEN 'complete'
                    ELSE 'incomplete' END AS state
        FROM w_located l LEFT JOIN (
          SELECT * FROM w_look QUALIFY row_number() OVER (PARTITION BY dir ORDER BY poll_no DESC) = 1) n ON n.dir = l.dir
        WHERE requested_project IS NOT NULL))"""

SQL["record_runs"] = """
SELECT run_id, project_id, cluster_id,
       CASE WHEN error IS NULL THEN sha256(run_id || '|' || project_id || '|' || cluster_id) END AS submission_id, error
FROM w_recorded"""

SQL["record_run_summary"] = "SELECT run_id, n_clusters, n_submitted, error FROM w_summary"

SQL["record_finished_runs"] = """
SELECT o.o_orderkey AS run_id, CASE WHEN good THEN n_clusters ELSE 0 END AS n_clusters,
       CASE WHEN good THEN n_submitted ELSE 0 END AS n_submitted,
       CASE WHEN good THEN s.error WHEN o_orderkey % 31 = 0 THEN 'Databricks API Error: 404'
            WHEN o_orderstatus = 'O' THEN 'Unsuccessful run result state: FAILED' ELSE 'waiting' END AS error
FROM (SELECT *, o_orderstatus = 'F' AND o_orderkey % 31 <> 0 AS good FROM orders) o
JOIN w_summary s ON s.run_id = o.o_orderkey"""

SQL["handle_successful_runs"] = """
WITH ready AS (SELECT project_id, arg_max(id, (created_at, id)) AS rec FROM b_recommendation WHERE state = 'SUCCESS'
               GROUP BY project_id),
picked AS (
  SELECT r.run_id, k.job_id, r.project_id, r.cluster_id, r.error, r.auto_apply_recs, y.rec,
         coalesce(a.path_key, b.path_key) AS path_key, b2.configuration, b2.has_recommendation,
         CASE WHEN r.error IS NOT NULL THEN 'not recorded' WHEN NOT r.auto_apply_recs THEN 'not wanted'
              WHEN y.rec IS NULL THEN 'no ready recommendation'
              WHEN a.job_id IS NULL AND b.job_id IS NULL
              THEN 'Failed to locate cluster in job ' || k.job_id || ' for project ' || r.project_id
              WHEN NOT b2.has_recommendation THEN 'Recommendation not found'
              WHEN b2.configuration IS NULL THEN 'Recommendation configuration not found'
              ELSE 'applied' END AS apply_status
  FROM w_recorded r
  JOIN (SELECT o_orderkey AS run_id, min(o_orderkey) OVER (PARTITION BY o_custkey) AS job_id FROM orders) k ON k.run_id = r.run_id
  LEFT JOIN ready y ON y.project_id = r.project_id
  LEFT JOIN b_recommendation b2 ON b2.id = y.rec
  LEFT JOIN w_job_project a ON a.job_id = k.job_id AND a.project_id = r.project_id
  LEFT JOIN (SELECT * FROM w_job_project QUALIFY count(*) OVER (PARTITION BY job_id) = 1) b ON b.job_id = k.job_id)
SELECT run_id, job_id, project_id,
       CASE WHEN error IS NULL THEN sha256(run_id || '|' || project_id || '|' || cluster_id) END AS submission_id,
       CASE WHEN apply_status = 'applied' THEN rec END AS recommendation_id, apply_status,
       CASE WHEN apply_status = 'applied' THEN path_key END AS path_key,
       CASE WHEN apply_status = 'applied' THEN 'n' || (rec % 7) END AS new_node,
       CASE WHEN apply_status = 'applied' THEN 'M' || (job_id % 3) END AS mode, error
FROM picked"""

SQL["apply_recommendations"] = f"""
WITH t AS (
  SELECT q.job_id, q.want, coalesce(a.path_kind, b.path_kind) AS path_kind, coalesce(a.path_key, b.path_key) AS path_key,
         CASE WHEN a.job_id IS NULL THEN b.project_id ELSE a.project_id END AS project_id,
         CASE WHEN a.job_id IS NULL THEN b.cluster_name ELSE a.cluster_name END AS cluster_name,
         CASE WHEN a.job_id IS NULL THEN b.policy_id ELSE a.policy_id END AS policy_id,
         CASE WHEN a.job_id IS NULL THEN b.scripts ELSE a.scripts END AS scripts,
         CASE WHEN a.job_id IS NULL AND b.job_id IS NULL
              THEN 'Failed to locate cluster in job ' || q.job_id || ' for project ' || q.want
              WHEN q.job_id % 5 = 0 THEN 'Recommendation not found'
              WHEN q.job_id % 7 = 0 THEN 'Recommendation configuration not found' END AS error
  FROM (SELECT o_orderkey AS job_id, 'p' || (o_custkey % 5) AS want FROM orders) q
  LEFT JOIN w_job_project a ON a.job_id = q.job_id AND a.project_id = q.want
  LEFT JOIN (SELECT * FROM w_job_project QUALIFY count(*) OVER (PARTITION BY job_id) = 1) b ON b.job_id = q.job_id)
SELECT job_id, want AS project_id, path_kind, path_key, CASE WHEN ok THEN cluster_name END AS cluster_name,
       CASE WHEN ok THEN 'n' || (job_id % 7) END AS node_type_id, CASE WHEN ok THEN job_id % 8 END AS num_workers,
       CAST(NULL AS BIGINT) AS max_workers,
       CASE WHEN ok THEN CASE WHEN project_id IS NOT NULL THEN 'sync:project-id=' || project_id || ';' ELSE '' END
         || 'sync:run-id=r' || job_id || ';team=y' END AS tags,
       CASE WHEN ok AND job_id % 9 <> 0 THEN policy_id END AS policy_id,
       CASE WHEN ok THEN concat_ws(',', scripts, 's' || (job_id % 3)) END AS scripts,
       CAST(NULL AS VARCHAR) AS log_url, CASE WHEN ok THEN 'M' || (job_id % 3) END AS mode, error
FROM (SELECT *, error IS NULL AS ok FROM t)"""

# -- written and read back, streams -------------------------------------------------------------------

SQL["scan_cluster_info"] = SQL["cluster_info_documents"].replace(
    "c AS cluster_id", "CAST(c AS VARCHAR) AS cluster_id"
)

SQL["delivered_documents"] = f"""SELECT via, d.* FROM ({SQL["scan_cluster_info"]}) d, (VALUES ('function'), ('path')) AS v(via)"""

SQL["read_log_lines"] = """
SELECT source, count(*) AS n_lines, sum(length(line))::BIGINT AS n_chars
FROM (SELECT source, unnest(string_split(text, chr(10))) AS line FROM documents) GROUP BY source"""

SQL["instance_timelines_stream"] = SQL["instance_timelines"]

SQL["monitored_clusters_stream"] = SQL["monitored_clusters"]

SQL["eventlog_ready_stream"] = """
WITH horizon AS (SELECT greatest((SELECT max(poll_no) FROM b_listing), (SELECT max(first_poll) - 0.5 FROM w_wait)) AS day)
SELECT dir, nth, ready_poll AS poll_no, CASE WHEN outcome = 'waiting' THEN 'No eventlog found' ELSE outcome END AS outcome
FROM w_wait, horizon
WHERE ready_poll IS NOT NULL OR scheme IS NULL OR scheme NOT IN ('s3', 'dbfs') OR polls >= first_poll + 19 OR first_poll + 20.25 < day"""

SQL["run_first_final_stream"] = SQL["run_first_final_state"]

SQL["cluster_termination_stream"] = f"""
SELECT * FROM ({SQL["cluster_termination_outcome"]}) WHERE outcome <> 'waiting'"""

SQL["submission_report_items"] = """
WITH done AS (
  SELECT l.run_id, l.cluster_id, l.aws, l.source, l.n_instances, l.n_instance_timelines, l.n_volumes,
         sha256(l.run_id || '|' || l.requested_project || '|' || l.cluster_id) AS submission_id
  FROM w_located l LEFT JOIN w_run_log g ON g.cluster_id = l.cluster_id
  WHERE l.requested_project IS NOT NULL AND coalesce(locate_error, ending, problem, g.log_error) IS NULL),
items AS (
  SELECT submission_id, 'tasks' AS section, '{"task_key":"' || task_key || '","result_state":"' || result_state
         || '","end_time_ms":' || end_time_ms || '}' AS item
  FROM done JOIN r_task USING (run_id, cluster_id)
  UNION ALL
  SELECT submission_id, 'cluster_events', '{"type":"' || event_type || '","parameters":{"k":"' || (props ->> '$.k')
         || '"}}'
  FROM done JOIN events ON cluster_id = user_id || '-c' || (event_id % 3)
  UNION ALL SELECT submission_id, 'instances', 'item' || i FROM done, range(1, 10) AS r(i) WHERE i <= n_instances
  UNION ALL
  SELECT submission_id, 'instance_timelines', 'item' || i FROM done, range(1, 10) AS r(i)
  WHERE i <= n_instance_timelines
  UNION ALL SELECT submission_id, 'volumes', 'item' || i FROM done, range(1, 10) AS r(i) WHERE i <= n_volumes AND aws)
SELECT submission_id, section, count(*) AS n_items, min(item) AS first_item, max(item) AS last_item
FROM items GROUP BY submission_id, section"""

SQL["recommendation_first_final_stream"] = f"""
SELECT * FROM ({SQL["recommendation_first_final"]}) WHERE outcome <> 'pending'"""

SQL["project_jobs"] = """
SELECT t.job_id, 'tasks' AS section, CAST(t.i AS INTEGER) AS pos, t.task_key AS key,
       CASE WHEN t.inline THEN 'own' END AS cluster_name, t.node_type_id, t.num_workers,
       CAST(NULL AS BIGINT) AS max_workers,
       CASE WHEN t.here THEN m.tags WHEN NOT t.inline THEN NULL
            WHEN t.project_id IS NULL THEN 'team=x' ELSE 'sync:project-id=' || t.project_id END AS tags,
       CAST(NULL AS VARCHAR) AS policy_id, CAST(NULL AS VARCHAR) AS scripts, CASE WHEN t.here THEN m.log_url END AS log_url,
       CASE WHEN t.here OR t.inline THEN 'M' || (t.job_id % 3) END AS mode, '/n' || t.job_id || '-' || t.i AS notebook
FROM (SELECT t.*, t.i = 0 AND m.usable AND m.task_cluster_key IS NULL AS here
      FROM b_job_task t JOIN w_job_templated m ON m.job_id = t.job_id) t
JOIN w_job_templated m ON m.job_id = t.job_id
UNION ALL
SELECT s.job_id, 'job_clusters',
       CAST(row_number() OVER (PARTITION BY s.job_id ORDER BY s.here, s.pos) - 1 AS INTEGER), s.job_cluster_key,
       s.cluster_name, s.node_type_id, s.num_workers, CAST(s.max_workers AS BIGINT),
       CASE WHEN s.here THEN m.tags WHEN s.project_id IS NULL THEN 'team=x' ELSE 'sync:project-id=' || s.project_id END,
       s.policy_id, s.scripts, CASE WHEN s.here THEN m.log_url END, 'M' || (s.job_id % 3), NULL
FROM (SELECT s.*, coalesce(m.usable AND m.task_cluster_key = s.job_cluster_key, false) AS here
      FROM b_job_shared s JOIN w_job_templated m ON m.job_id = s.job_id) s
JOIN w_job_templated m ON m.job_id = s.job_id"""
