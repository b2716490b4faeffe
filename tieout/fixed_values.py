"""Agreed with the systems on the other side, so they may not be changed here."""

# Text a change carries in place of a large column that the update did not touch.
UNCHANGED = "__debezium_unavailable_value"

# Change operations: create, update, delete, snapshot read. Anything else fails the batch.
OPERATIONS = ("c", "u", "d", "r")
DELETE = "d"
SNAPSHOT_READ = "r"

# Parts that the keys of a current-state table are dealt into.
KEY_BUCKETS = 64

# Transaction record that closes a transaction.
END = "END"

# Minutes allowed between the clock of a source and the clock of the ingest.
CLOCK_ALLOWANCE_MINUTES = 10
# Days a cut stays readable.
CUT_RETENTION_DAYS = 7

# Identifiers a partner may send, matched against the whole value.
SAFE_IDENTIFIER = r"\A[A-Za-z0-9][A-Za-z0-9._:-]*\z"

# Columns of a part that must hold safe identifiers.
IDENTIFIERS = ("partner", "feed", "file_id")

# States of a received file part.
STAGED = "STAGED"
REJECTED = "REJECTED"
DUPLICATE = "DUPLICATE"
PUBLISHED = "PUBLISHED"
SUPERSEDED = "SUPERSEDED"
# States of a part that was accepted.
RECEIVED = (STAGED, PUBLISHED, SUPERSEDED)
# Verdicts on a requested version, besides PUBLISHED and SUPERSEDED.
INCOMPLETE = "INCOMPLETE"
HELD_FOR_APPROVAL = "HELD_FOR_APPROVAL"
# States of a release, besides PUBLISHED.
CANDIDATE = "CANDIDATE"
HELD = "HELD"

# A version this share smaller than usual is held.
TRUNCATION_THRESHOLD = 0.2
# Weeks of history behind "usual".
BASELINE_WEEKS = 4

# Gate cell and its measures, in report order.
CELL = ("business_line", "business_date")
MEASURES = ("row_count", "amount_paise", "distinct_keys", "fingerprint")

# Zone whose midnight ends a business day.
BUSINESS_ZONE = "Asia/Kolkata"
# Hour (in that zone) at which a file's arrival window closes on the day after its posting date.
ARRIVAL_CLOSES_HOUR = 8

# Days of business dates a gold build replaces.
REBUILD_WINDOW_DAYS = 2
# Hours after which an open hold escalates, and days after which a held build expires.
HOLD_ESCALATES_HOURS = 24
HELD_BUILD_EXPIRES_DAYS = 14
MONTH_END_TAG_YEARS = 5

# Values contracted for the status columns.
TRANSACTION_STATUSES = (
    "INITIATED", "AUTHORISED", "SETTLED", "PARTIALLY_SETTLED", "REVERSED", "FAILED",
)
LOAN_STATUSES = ("APPROVED", "DISBURSED", "SETTLED", "REJECTED", "CLOSED")
GMV_STATUS = "SETTLED"

# Label on every fast signal.
SIGNAL_SOURCE = "fast_signal"

# Range of a signed 64-bit integer.
BIGINT_MIN = -(2**63)
BIGINT_MAX = 2**63 - 1
