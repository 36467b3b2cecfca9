"""Explicit schemas of the telemetry documents, so that no read infers one. All are DDL text."""

_TAGS = "array<struct<Key string, Value string>>"
_LOG_CONF = "struct<s3 struct<destination string>, dbfs struct<destination string>>"


CLUSTER = f"""
cluster_id string, spark_context_id bigint, cluster_name string, spark_version string,
aws_attributes struct<zone_id string, first_on_demand int, availability string, spot_bid_price_percent int,
                      ebs_volume_count int>,
azure_attributes struct<first_on_demand int, availability string, spot_bid_max_price double>,
node_type_id string, driver_node_type_id string, autotermination_minutes int, enable_elastic_disk boolean,
disk_spec struct<disk_count int>, cluster_source string, enable_local_disk_encryption boolean,
instance_source struct<node_type_id string>, driver_instance_source struct<node_type_id string>,
state string, state_message string, start_time bigint, terminated_time bigint, last_state_loss_time bigint,
num_workers int, autoscale struct<min_workers int, max_workers int>, default_tags map<string,string>,
custom_tags map<string,string>, creator_user_name string,
termination_reason struct<code string, parameters map<string,string>, type string>,
init_scripts_safe_mode boolean, spec struct<spark_version string>, policy_id string,
cluster_log_conf {_LOG_CONF}, spark_conf map<string,string>, spark_env_vars map<string,string>,
runtime_engine string, init_scripts array<struct<dbfs struct<destination string>, s3 struct<destination string>>>
"""

# A definition inside a run or a job; the same fields as a cluster.
_DEFINITION = f"struct<{CLUSTER.strip()}>"

RUN = f"""
run_id bigint, job_id bigint,
tasks array<struct<task_key string, new_cluster {_DEFINITION}, job_cluster_key string, existing_cluster_id string,
                   cluster_instance struct<cluster_id string, spark_context_id string>,
                   state struct<result_state string>, end_time bigint>>,
job_clusters array<struct<job_cluster_key string, new_cluster {_DEFINITION}>>,
state struct<result_state string>, error_code string, message string
"""

JOB = f"""
job_id bigint,
settings struct<name string,
                tasks array<struct<task_key string, new_cluster {_DEFINITION}, job_cluster_key string>>,
                job_clusters array<struct<job_cluster_key string, new_cluster {_DEFINITION}>>>
"""

EVENT_PAGE = """
cluster_id string, page_no int, total_count bigint,
events array<struct<timestamp bigint, type string,
                    details struct<reason struct<code string, type string, parameters map<string,string>>>>>
"""

CLUSTER_INFO = f"""
instances array<struct<InstanceId string, name string, State struct<Name string>, Tags {_TAGS}>>,
volumes array<struct<VolumeId string, Attachments array<struct<InstanceId string>>>>,
instance_timelines array<struct<instance_id string, first_seen_running_time string, last_seen_running_time string>>,
timelines array<struct<instance_id string, first_seen_running_time string, last_seen_running_time string>>
"""

RECOMMENDATION = """
created_at string, updated_at string, id string, project_id string, state string, error string,
recommendation struct<configuration string>
"""
SUBMISSION = """
created_at string, updated_at string, id string, project_id string, state string,
configuration struct<state string, node_type_id string, driver_node_type_id string,
                     custom_tags map<string,string>, num_workers int, spark_conf map<string,string>,
                     spark_version string, runtime_engine string,
                     azure_attributes struct<availability string, first_on_demand int, spot_bid_max_price double>>
"""
PROJECT = """
project_id string, app_id string, project_model_id string, auto_apply_recs boolean, created_at string,
description string, cluster_path string, cluster_log_url string, workspace_id string, job_id string,
prediction_params string, optimize_instance_size boolean
"""
WORKSPACE = """
workspace_id string, databricks_host string, databricks_plan_type string, collection_type string,
monitoring_type string, compute_provider string, aws_region string, instance_profile_arn string,
aws_iam_role_arn string, azure_tenant_id string, azure_client_id string, azure_client_secret string,
azure_subscription_id string, webhook_id string, cluster_policy_id string
"""
LISTING = """
dir string, poll_no bigint, pos bigint, path string, is_dir boolean, file_size bigint, mtime_ms bigint
"""
