"""Constants, names and formats that must equal the reference's
for equal results. Everything else in the package is our own choice."""

# Fixed values.

# Source and event time
GROUP_ID_KEY = "group.id"              # client property suffixed with "-<job kind>"
OUT_OF_ORDERNESS = "5 seconds"         # watermark delay
DEFAULT_WINDOW_MINUTES = 10            # tumbling window length (option window.size)

# Node ids and payload kinds
UINT32_MASK = 0xFFFFFFFF
ENCRYPTED_KIND = "ENCRYPTED"
TEXT_MESSAGE_PORT = "TEXT_MESSAGE_APP"
UNRECOGNIZED = "UNRECOGNIZED"          # name of an enum number the schema does not know

# Text messages
DEFAULT_CHARSET = "utf-8"              # option message.charset
TITLE_FORMAT = "Message from node: (%s) on channel: (%s)"
MESSAGE_FORMAT = "Time: %s\nText: %s"
PRIORITY = 2
AUDIT_FORMAT = "%s form: %d, chan: %s, text: %s"

# Node-info SQL sink
NODE_INFO_VIEW = "NodeInfo"
NODE_INFO_SINK = "node_info_sink"
NODE_INFO_INSERT = "INSERT INTO node_info_sink SELECT * FROM NodeInfo"

# Sinks
JDBC_BATCH_SIZE = 100                  # rows per JDBC batch
SINK_INTERVAL = "200 milliseconds"     # JDBC batch interval, used as trigger
JDBC_RETRIES = 5
HTTP_TIMEOUT_S = 60                    # webhook connect timeout and wait per message

# Job kinds
JOB_KIND_TRAFFIC = "default"
JOB_KIND_NODE_INFO = "node-info"
JOB_KIND_TEXT = "text-app"
