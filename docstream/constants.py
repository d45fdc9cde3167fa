"""Names and texts that results and settings are compared on."""

# Consumer group name prefix and separator.
GROUP_PREFIX = "KafkaImporterGroup"
GROUP_SEPARATOR = ":"

# States and answers of the control actions.
RUNNING = "RUNNING"
STOPPED = "STOPPED"
NOT_INITIALIZED = "NOT_INITIALIZED"
STARTED_MESSAGE = "started"
STOPPING_MESSAGE = "stopping"
UNKNOWN_MESSAGE = "Unknown command provided"

# Fixed value: the state of a usable replica.
ACTIVE_STATE = "active"

# Settings defaults.
DEFAULT_COMMIT_INTERVAL_MS = 5000
DEFAULT_POLL_INTERVAL_MS = 45000

# Sample documents.
SAMPLE_TITLE = "Hi mom"
SAMPLE_ID_PREFIX = "doc_"
