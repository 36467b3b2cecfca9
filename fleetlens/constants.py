"""Names, messages and closed sets of the telemetry formats this package reads and writes."""

# Tag that ties a cluster definition to a tracked project.
PROJECT_TAG = "sync:project-id"
# Tags the platform puts on cloud instances and disks.
VENDOR_TAG, VENDOR = "Vendor", "Databricks"
CLUSTER_TAG = "ClusterId"

# Run, cluster and recommendation states.
FINAL_RUN_STATES = ["SUCCESS", "FAILED", "TIMEDOUT", "CANCELED"]
LIVE_CLUSTER_STATES = ["PENDING", "RUNNING", "RESTARTING", "RESIZING"]
TRACKED_MODELS = ["GRADIENT_ML", "UNASSIGNED"]

# Closed sets of the workspace and report envelopes.
PLAN_TYPES = ["Standard", "Premium", "Enterprise"]
COMPUTE_TYPES = ["All-Purpose Compute", "Jobs Compute", "Jobs Compute Light"]
COLLECTION_TYPES = ["remote", "hosted"]
MONITORING_TYPES = ["webhook", "hypervisor"]
PROVIDERS = ["aws", "azure"]
PRODUCT_CODES = {"aws": "aws-databricks", "azure": "azure-databricks"}
AWS_REGIONS = [
    "us-east-1", "us-east-2", "us-west-1", "us-west-2", "af-south-1", "ap-east-1", "ap-south-1",
    "ap-south-2", "ap-northeast-1", "ap-northeast-2", "ap-northeast-3", "ap-southeast-1",
    "ap-southeast-2", "ap-southeast-3", "ap-southeast-4", "ca-central-1", "ca-west-1",
    "eu-central-1", "eu-central-2", "eu-west-1", "eu-west-2", "eu-west-3", "eu-south-1",
    "eu-south-2", "eu-north-1", "il-central-1", "me-south-1", "me-central-1", "sa-east-1",
]
AZURE_HOST_SUFFIX = ".azuredatabricks.net"
AWS_HOST_SUFFIX = ".cloud.databricks.com"
AZURE_CREDENTIAL_FIELDS = [
    "azure_tenant_id", "azure_client_id", "azure_client_secret", "azure_subscription_id",
]
POWER_RUNNING = "PowerState/running"

# Event-log layout and waiting limits.
FINAL_LOG_STEMS = ["eventlog", "eventlog.gz", "eventlog.json.gz"]
LOG_POLL_LIMIT = 20
LOG_POLL_SECONDS = 15
TERMINATION_TIMEOUT_SECONDS = 600
INFO_FILE = {"aws": "aws_cluster_info.json", "azure": "azure_cluster_info.json"}
SINK_FILESYSTEMS = {"aws": ["s3", "dbfs", "file", "lambda"], "azure": ["dbfs", "file", "lambda"]}
REDACTED_PARAMETERS = ["azure_error_message", "databricks_error_message"]
ONE_OFF_AUTOTERMINATION_MINUTES = 10

# Messages.
API_ERROR_CODE = "Databricks API Error"
NO_CLUSTER_FOR_TASK = "No cluster found for task"
NO_CLUSTER_FOR_TASKS = "No cluster found for tasks"
MANY_CLUSTERS_FOR_TASKS = "More than 1 cluster found for tasks"
TASKS_NOT_SHARED = "Not all tasks use the same cluster"
NO_TASK_IN_JOB = "No task found in job"
TASKS_NOT_SUCCESSFUL = "Tasks did not complete successfully"
LOG_INCOMPLETE = "Event log was missing or incomplete. Please retry."
NO_LOG_ROOT = "Unable to locate files in DBFS dir "
NO_LOG_LOCATION = "No eventlog location found for cluster."
RECOMMENDATION_FAILED = "Recommendation failed"
RECOMMENDATION_NOT_FOUND = "Recommendation not found"
CONFIGURATION_NOT_FOUND = "Recommendation configuration not found"
NESTED_TOO_DEEP = "Document nests too deeply"
BAD_LOG_URL = "Unsupported event log URL scheme"
