"""Names, limits, patterns and schemas that other systems rely on.

They are part of the data contract (message keys, job names, label rules, file
layout) and therefore stated as they are.  Everything a deployment chooses for
itself (exchange names, queue-name prefix, base paths) is a call argument.
"""

# --- job names and status keys -------------------------------------------------
JOB_PREFIX = "cds-"
STATUS_KEY_PREFIX = "cds.job."
RUNNING, RETRY, STARTING, FAILED, SUCCESS = "running", "retry", "starting", "failed", "success"
STARTED, INVALID = "started", "invalid"
NO_STATUS_TEXT = "None"
UNKNOWN_REASON = "Unknown"

# --- routing patterns ----------------------------------------------------------
UPLOAD_PATTERN = "deliverables.syndication.*.upload"
STATUS_PATTERN = "cds.job.*"

# --- limits ----------------------------------------------------------------------
JOB_NAME_LIMIT = 59
LABEL_LIMIT = 63
LABEL_KEEP = 60
LABEL_ELLIPSIS = "..."
HINT_TOKEN_LENGTH = 10
JOB_TOKEN_LENGTH = 4
NAME_TRIES = 1000
LINE_LIMIT_BYTES = 32768
MAX_ATTEMPTS = 10
PUBLISH_DELAY_SECONDS = 5
CONNECT_DELAY_SECONDS = 2

# --- launch documents ------------------------------------------------------------
METADATA_SUFFIX = ".inmeta"
LAUNCH_PROGRAM = "/usr/local/bin/cds_run.pl"
LAUNCH_METADATA_FLAG = "--input-inmeta"
LAUNCH_ROUTE_FLAG = "--route"
LABELS = {
    "deliverable-asset-id": "deliverable_asset",
    "deliverable-bundle-id": "deliverable_bundle",
    "online-id": "online_id",
    "nearline-id": "nearline_id",
    "archive-id": "archive_id",
}
NUMERIC_LABELS = ("deliverable-asset-id", "deliverable-bundle-id")
HINT_FIELDS = ("filename", "online_id", "nearline_id", "archive_id")

# --- logs --------------------------------------------------------------------------
LOG_PATH_PREFIX = "/var/log/cds_backend/"
LOG_URL_PREFIX = "/log/"
POINTER_DIR = "podnames"
POINTER_SUFFIX = ".txt"
LOG_ZONE = "Europe/London"
SIZE_UNITS = ("bytes", "Kb", "Mb", "Gb", "Tb")

# --- message schemas -----------------------------------------------------------------
UPLOAD_SCHEMA = {
    "type": "object",
    "properties": {
        "deliverable_asset": {"type": "integer"},
        "deliverable_bundle": {"type": "integer"},
        "filename": {"type": ["string", "null"]},
        "online_id": {"type": ["string", "null"]},
        "nearline_id": {"type": ["string", "null"]},
        "archive_id": {"type": ["string", "null"]},
        "inmeta": {"type": "string"},
        "routename": {"type": "string"},
    },
    "required": ["inmeta", "routename"],
}
STATUS_SCHEMA = {
    "type": "object",
    "properties": {
        "job-id": {"type": "string"},
        "job-name": {"type": "string"},
        "job-namespace": {"type": "string"},
        "retry-count": {"type": "number"},
        "failure-reason": {"type": "string"},
    },
    "required": ["job-id", "job-name", "job-namespace"],
}
