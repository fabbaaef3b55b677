"""Fixed values shared by the operators.  All of them are defaults of parameters."""

BUSINESS_TZ = "America/Phoenix"

SALES_SUFFIX = "-Sales"
PRODUCTION_SUFFIX = "-Production"
UNKNOWN_UNIT = "Unknown"

# Job types that count as a sales opportunity in the weekly report.
OPPORTUNITY_JOB_TYPES = (
    "ESTIMATE- WINDOW WASHING",
    "Estimate, Cabinets",
    "Estimate- Cabinets",
    "Estimate- Exterior PLUS Int Cabinets",
    "Estimate- Interior PLUS Cabinets",
    "ESTIMATE -RES-EXT-PRE 1960",
    "ESTIMATE -RES-INT/EXT-PRE 1960",
    "ESTIMATE-COMM-EXT",
    "ESTIMATE-COMM-EXT/INT",
    "ESTIMATE-COMM-INT",
    "ESTIMATE-COMM-PLANBID",
    "ESTIMATE-COMM-Striping",
    "ESTIMATE-FLOOR COATING-EPOXY",
    "ESTIMATE-FLOOR COATING-H&C Coatings",
    "ESTIMATE-POPCORN",
    "ESTIMATE-RES-EXT",
    "ESTIMATE-RES-EXT/INT",
    "ESTIMATE-RES-HOA",
    "ESTIMATE-RES-INT",
    "Estimate-RES-INT/EXT Plus Cabinets",
)

# Job statuses, job types and line-item types used by the rules.
PRODUCTION_STATUSES = ("Completed", "Hold", "Scheduled", "InProgress", "Canceled")
PRODUCED_STATUSES = ("Completed", "Hold")
WARRANTY_JOB_TYPES = ("Warranty", "Touchup")
NON_PRODUCTION_JOB_TYPES = ("PM Inspection", "Safety Inspection", "Window/Solar Washing")
MATERIAL_ITEM_TYPES = ("Material", "Equipment")
KNOWN_ITEM_TYPES = ("Material", "Equipment", "Service", "Labor")
CANCELED_APPOINTMENT_STATUSES = ("Canceled", "Cancelled")
CANCELED_ORDER_STATUS = "Canceled"

# Lookback of the incremental slices, in hours (others: 0).
LOOKBACK_HOURS = {"jobs": 168, "estimates": 4320}
FIRST_SYNC_DAYS = 7

RECEIVABLE_FLOOR = 10

# Labels of graded rows.
RED, YELLOW, GREEN = "🔴 RED", "🟡 YELLOW", "🟢 GREEN"
NO_DATA, LOW, OK = "🔴 NO DATA", "🟡 LOW", "🟢 OK"
CRITICAL, WARNING, EXCELLENT = "🔴 CRITICAL", "🟡 WARNING", "🟢 EXCELLENT"
EXACT, MINOR, MAJOR = "✅ EXACT", "⚠️ MINOR", "🔴 MAJOR"
FLAG_RED, FLAG_YELLOW, FLAG_GREEN = "🔴", "🟡", "🟢"
TICK, CAUTION, CROSS = "✅", "⚠️", "❌"
