"""Fixed values and thresholds shared by the jobs."""

from __future__ import annotations

# State code -> (state name, region).
STATES: dict[str, tuple[str, str]] = {
    "AC": ("Acre", "Norte"),
    "AL": ("Alagoas", "Nordeste"),
    "AM": ("Amazonas", "Norte"),
    "AP": ("Amapá", "Norte"),
    "BA": ("Bahia", "Nordeste"),
    "CE": ("Ceará", "Nordeste"),
    "DF": ("Distrito Federal", "Centro-Oeste"),
    "ES": ("Espírito Santo", "Sudeste"),
    "GO": ("Goiás", "Centro-Oeste"),
    "MA": ("Maranhão", "Nordeste"),
    "MG": ("Minas Gerais", "Sudeste"),
    "MS": ("Mato Grosso do Sul", "Centro-Oeste"),
    "MT": ("Mato Grosso", "Centro-Oeste"),
    "PA": ("Pará", "Norte"),
    "PB": ("Paraíba", "Nordeste"),
    "PE": ("Pernambuco", "Nordeste"),
    "PI": ("Piauí", "Nordeste"),
    "PR": ("Paraná", "Sul"),
    "RJ": ("Rio de Janeiro", "Sudeste"),
    "RN": ("Rio Grande do Norte", "Nordeste"),
    "RO": ("Rondônia", "Norte"),
    "RR": ("Roraima", "Norte"),
    "RS": ("Rio Grande do Sul", "Sul"),
    "SC": ("Santa Catarina", "Sul"),
    "SE": ("Sergipe", "Nordeste"),
    "SP": ("São Paulo", "Sudeste"),
    "TO": ("Tocantins", "Norte"),
}
STATE_CODES: list[str] = sorted(STATES)

# Fixed value: region given to orders without a usable state.
UNKNOWN_REGION = "Desconhecido"

# Devices kept as they are; everything else is UNKNOWN_DEVICE.
DEVICES = ["mobile", "desktop", "tablet"]
UNKNOWN_DEVICE = "unknown"

# Change operations that carry a current row (create, update, snapshot read).
CHANGE_OPS = ["c", "u", "r"]

# Event types that never reach the event stream.
NOT_STREAMED = ["order_placed"]

# UTF-8 letters read as Latin-1, and the letter meant. The second
# character of "à" is a plain space, that of "í" a soft hyphen (U+00AD).
MOJIBAKE: list[tuple[str, str]] = [
    ("Ã£", "ã"),
    ("Ã§", "ç"),
    ("Ã©", "é"),
    ("Ã³", "ó"),
    ("Ãº", "ú"),
    ("Ã¢", "â"),
    ("Ãª", "ê"),
    ("Ã ", "à"),
    ("Ã\u00ad", "í"),
    ("Ãµ", "õ"),
]

# Fixed value: the text of a review after the ``---`` line, without one title line and one blank line.
REVIEW_MESSAGE = r"---\n(?:TITLE:[^\n]*\n)?\n?([\s\S]*)"

# Order of event types in the funnel report.
JOURNEY = [
    "session_start", "search", "product_view",
    "add_to_cart", "remove_from_cart", "checkout",
    "order_placed", "payment_failed",
    "wishlist_add", "product_review", "session_end",
]

# Order of the steps a session can take, and why it can end.
SESSION_STEPS = [
    "session_start", "search", "category_browse", "product_view",
    "product_review_read", "add_to_cart", "cart_view",
    "checkout_start", "order_placed",
]
END_REASONS = ["bounce", "no_cart", "cart_abandon", "checkout_abandon", "completed"]

# Thresholds of labels and reports.
POSITIVE_FROM = 4
NEUTRAL_AT = 3
CHURN_DAYS = 30
DEFAULT_RATING = 3.0
RISK_HIGH = 0.7
RISK_MEDIUM = 0.4
DIM_DATE_START = "2020-01-01"
DIM_DATE_END = "2030-12-31"
DASHBOARD_DAYS = {"executive": 90, "sales_performance": 90, "funnel": 7, "reviews": 90}

# Stream and bronze limits.
# Input bytes of one micro-batch; a job can ask for other bounds.
TRIGGER_BYTES = 64 * 1024 * 1024 * 1024
# Micro-batches of a keyed table between two compactions.
COMPACT_AFTER = 64
# Buckets that a compaction deals at a time.
COMPACT_BUCKETS = 4
# Buckets of a keyed table's base; choose it for a table's final size, about a GB each.
KEYED_BUCKETS = 16
BRONZE_TRIGGER = "30 seconds"
# Files of one micro-batch from an inbox: the driver holds some 2 KB for each file of a running batch.
INBOX_FILES = 30_000
# An inbox holds a file per review: a task reads many of them, and a job lists and archives many at once.
SMALL_FILES = {
    # A file is read once and is one block: the driver keeps neither a cache of listed files nor where they lie.
    "spark.sql.hive.manageFilesourcePartitions": "false",
    "spark.sql.sources.ignoreDataLocality": "true",
    "spark.sql.files.openCostInBytes": str(64 * 1024),
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "256",
    "spark.sql.streaming.fileSource.cleaner.numThreads": "8",
}
# Messages land under the hour of their batch: a task writes few files at once and sorts nothing for them,
# and compressed messages are many in a task.
LANDING = {
    "spark.sql.maxConcurrentOutputFileWriters": "4",
    "spark.sql.files.maxPartitionBytes": str(32 * 1024 * 1024),
}
# How long the end of a drained stream may take to be heard of.
LISTENER_SECONDS = 300
BRONZE_FILE_ROWS = 5_000_000
# Shuffle files of a write go when it has ended; else they stay until the driver happens to collect its garbage.
WRITING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
# Tasks that sort wide rows: 16 MB of a shuffle or 32 MB of files are some 250 MB of rows, which no task spills.
SMALL_TASKS = {
    **WRITING,
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(16 * 1024 * 1024),
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "400",
    "spark.sql.files.maxPartitionBytes": str(32 * 1024 * 1024),
}
# Size of a reference CSV file that one task may read.
REFERENCE_CSV_BYTES = 2 * 1024 * 1024 * 1024
# Shuffle bytes per output task when a table is rebalanced for writing.
WRITE_TASK_BYTES = 64 * 1024 * 1024

# Dates outside are taken as errors: cleaning rejects them, calendars never reach beyond.
EARLIEST_DATE = "1900-01-01"
LATEST_DATE = "2199-12-31"

# Features and sizes of the models.
CHURN_FEATURES = ["recency", "frequency", "monetary", "avg_rating"]
CHURN_TREES = 100
SEED = 42
DEMAND_FEATURES = [
    "lag_1", "lag_7", "lag_14", "rolling_7d_mean",
    "day_of_week", "is_weekend", "month", "quarter",
]
DEMAND_REG = 0.1
DEMAND_MIN_ROWS = 20
DEMAND_TRAIN_SHARE = 0.8
FORECAST_DAYS = 7
