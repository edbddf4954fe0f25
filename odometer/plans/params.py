"""Parameters of the contract queries, shared by the Spark plans and the oracle SQL."""

REPORT_DAY = "2024-01-15"  # the single-date reconciliation
LATEST_ZONE = "outside_service_area"  # zone argument of the newest-window read
UPDATED_AT_TARGET = "2024-02-01 00:00:00"  # stamp of the stored report rows
UPDATED_AT_BATCH = "2024-02-02 00:00:00"  # stamp of the re-run's rows
RERUN_FROM = "2024-01-16"  # the re-run covers this date onwards
LATE_FEE = 10  # maintenance fee the re-run posts for vehicles with trips
HEALTH_NOW = "2024-01-31 00:01:00"  # fixed check time of the health status
THRESHOLD = 120  # freshness limit in seconds (the service default)
CHECK_MINUTES = 2  # interval of the freshness check grid
LOCAL_ZONE = "Asia/Colombo"  # zone of naive wall-clock times in utc_normalize
CLOSED_BEFORE = "2024-01-12 23:32:00"  # newest-window reads as of this time (a window of several zones)
CLOSED_ZONE = "colombo_north_west"  # zone argument of that read
LATE_EVERY = 10  # every tenth event comes after all others (late_repair)
