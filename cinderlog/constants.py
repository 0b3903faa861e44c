"""Formats, patterns and template texts that results depend on."""

# Variable substrings masked before template mining.
ADDRESS = r"(/|)([0-9]+\.){3}[0-9]+(:[0-9]+|)(:|)"
BLOCK_POOL = r"BP-\d+-\d+\.\d+\.\d+\.\d+-\d+"

# Template mining depth and similarity threshold.
MINING_DEPTH = 4
MINING_SIMILARITY = 0.5

# Patterns of the values read out of log contents.
BLOCK_ID = r"(blk_-?\d+)"
SOURCE = r"src: (/[^ ]+)"
DESTINATION = r"dest: (/[^ ]+)"

# Severity levels of the severity report.
LEVELS = ("ERROR", "WARN", "INFO", "FATAL")

# Templates the reports select.
IO_EXCEPTION = "IOException in offerService"
PERMISSION_DENIED = (
    "java.io.FileNotFoundException: /opt/hdfs/data/current/VERSION (Permission denied)"
)
SLOW_WRITE = "Slow BlockReceiver write data to disk <*> (threshold=300ms)"

# The fixed words of statements in order, as SQL patterns over templates. Which
# tokens a miner hides differs, and hidden ones take their commas with them.
TRANSFER_WORDS = "src: % dest: % bytes: % op: HDFS_WRITE%duration: %"
CONNECT_RETRY_WORDS = "Retrying connect to server: %Already tried % time(s)%"

# Label text of an anomalous block, padding after a session's last event.
ANOMALY = "Anomaly"
PAD = "#Pad"

# Fixed value: width of the hashed feature space.
FEATURE_WIDTH = 65536

# Measurement names of the time-series points.
COUNT_MEASUREMENT = "metrics"
BATCH_MEASUREMENT = "streaming_metrics"

WILDCARD = "<*>"

# The block pool pattern contains an address, so it has to be masked first to match at all.
MASKS = (BLOCK_POOL, ADDRESS)
