"""Fixed values that must equal the routing rules' own lists.

Everything below is a literal list stated once, in its natural order.
"""

# ---------------------------------------------------------------------------
# FIXED VALUES -- contract types that count as deemed / flexible / variable (DFV)
# ---------------------------------------------------------------------------
DFV_EXACT = ("1", "2", "4", "deemed", "flexible", "variable", "d", "f", "v", "dfv", "fvd")
DFV_CONTAINS = ("deemed", "flexible", "variable")

# ---------------------------------------------------------------------------
# FIXED VALUES -- supplier name patterns used by the nightly feature build.
# (kind, pattern): "contains" = LIKE '%p%', "prefix" = LIKE 'p%', "equals" = exact.
# First matching family wins; no match = OTHER.
# ---------------------------------------------------------------------------
NIGHTLY_SUPPLIER_RULES = (
    ("BG_LITE", (("contains", "british gas lite"), ("contains", "bg lite"))),
    ("BG", (("contains", "british gas"),)),
    ("EON", (("contains", "e.on"), ("contains", "e-on"), ("prefix", "eon"))),
    ("UB", (("contains", "utility bidder"),)),
)
# the family column of the nightly build
NIGHTLY_FAMILY_RULES = (
    ("BG_LITE", (("contains", "british gas lite"),)),
    ("BG", (("contains", "british gas"),)),
    ("EON", (("contains", "e.on"), ("contains", "e-on"), ("prefix", "eon"))),
    ("UB", (("contains", "utility bidder"),)),
)
# window days by supplier name in the nightly build: lite 365, British Gas 548, else 365
NIGHTLY_WINDOW_RULES = (
    (365, (("contains", "british gas lite"),)),
    (548, (("contains", "british gas"),)),
)

# ---------------------------------------------------------------------------
# FIXED VALUES -- supplier buckets used by the provider routing sync (differs on purpose)
# ---------------------------------------------------------------------------
SYNC_BUCKET_RULES = (
    ("BG_LITE", (("contains", "british gas lite"), ("contains", "bg lite"))),
    ("BG", (("contains", "british gas"), ("prefix", "bg "), ("equals", "bg"))),
    ("EON", (("contains", "e.on"), ("contains", "e-on"), ("prefix", "eon"))),
    ("UB", (("contains", "utility bidder"), ("contains", "utilitybidder"))),
)
SYNC_SHARED_BUCKETS = ("BG", "EON", "UB")
SYNC_SHARED_POOL_NAMES = (("BG", "British Gas"), ("EON", "E.ON"), ("UB", "Utility Bidder"))
SYNC_EXCLUDED_TAG_CODES = ("EON", "BG", "UB", "OTHER")
# FIXED VALUES -- window, code lengths and rule priorities of the provider sync
SYNC_BG_WINDOW = 548
SYNC_SLUG_LEN = 48
SYNC_COLLISION_LEN = 40
SYNC_NOW_BASE = 200
SYNC_IN_WINDOW_BASE = 201

# FIXED VALUES -- winning-contract supplier preference: EON, then BG, then UB, then everything else
WIN_TAG_RANK = (("EON", 1), ("BG", 2), ("UB", 3))
WIN_TAG_RANK_OTHER = 4

# FIXED VALUES -- texts and statuses that the features look for
REJECT_PATTERN = "reject|declin|cancel"
COMPLAINT_TEXT = "ongoing complaint"
RETENTION_TEXT = "retention"
GDPR_TEXT = "gdpr"
CALLBACK_OPEN_STATUS = "SCHEDULED"
AUDIT_ACTION = "AUTO_ASSIGN"

# ---------------------------------------------------------------------------
# FIXED VALUES -- shared pool seed (code, name, type, locked), full turn-on seed
# ---------------------------------------------------------------------------
POOL_SEED = (
    ("EON", "E.ON", "STANDARD", False),
    ("EON_DFV", "E.ON DFV", "STANDARD", False),
    ("BG", "British Gas", "STANDARD", False),
    ("UB", "Utility Bidder", "STANDARD", False),
    ("OTHER", "Other", "STANDARD", False),
    ("UNASSIGNED", "Unassigned", "STANDARD", False),
    ("COMPLAINT", "Complaint", "STANDARD", True),
    ("RETENTION", "Retentions", "STANDARD", False),
    ("PAST_RETENTION", "Past Retentions", "STANDARD", False),
    ("UPSELLING", "Upselling", "STANDARD", False),
    ("CUSTOMER_CARE", "Customer Care", "STANDARD", False),
    ("CORPORATE", "Corporate", "STANDARD", False),
)

# ---------------------------------------------------------------------------
# FIXED VALUES -- rule seed (priority, tag, pool code, description), full turn-on seed
# ---------------------------------------------------------------------------
RULE_SEED = (
    (10, "COMPLAINT", "COMPLAINT", "Ongoing complaint — locked Complaint pool"),
    (11, "CUSTOMER_CARE", "CUSTOMER_CARE", "Past sale, 7–60 days since last sale"),
    (12, "PAST_RETENTION", "PAST_RETENTION", "Any past deal, OOC"),
    (13, "RETENTION", "RETENTION", "Any past deal, 1–540 days"),
    (14, "UPSELLING", "UPSELLING", "Any past deal, >540 days"),
    (15, "CORPORATE", "CORPORATE", "21–200 sites, DFV or CED ≤365"),
    (20, "UB_NOW", "UB", "UB expired / no CED"),
    (21, "UB_IN_WINDOW", "UB", "UB in window 1–365"),
    (28, "EON_DFV", "EON_DFV", "E.ON deemed / flexible / variable only"),
    (29, "EON_NOW", "EON", "E.ON expired / no CED → main E.ON"),
    (30, "EON_IN_WINDOW", "EON", "E.ON in window 1–365"),
    (39, "BG_NOW", "BG", "British Gas expired / no CED"),
    (40, "BG_IN_WINDOW", "BG", "British Gas in window 1–548"),
    (49, "OTHER_NOW", "OTHER", "Unknown supplier expired / no CED"),
    (50, "OTHER_IN_WINDOW", "OTHER", "Unknown supplier in window"),
    (90, "PRE_WINDOW", "UNASSIGNED", "Wait — too far out"),
    (99, "UNASSIGNED", "UNASSIGNED", "Fallback"),
)

# ---------------------------------------------------------------------------
# FIXED VALUES -- parked minimal seed: pools (code, name, type, locked) and
# rules (priority, tag, pool code, active)
# ---------------------------------------------------------------------------
PARKED_POOL_SEED = (
    ("COMPLAINT", "Complaint", "STANDARD", True),
    ("RETENTION", "Retentions", "STANDARD", False),
    ("PAST_RETENTION", "Past Retentions", "STANDARD", False),
    ("UNASSIGNED", "Unassigned", "STANDARD", False),
    ("UPSELLING", "Upselling", "STANDARD", False),
    ("CUSTOMER_CARE", "Customer Care", "STANDARD", False),
)
PARKED_RULE_SEED = (
    (10, "COMPLAINT", "COMPLAINT", True, "Ongoing complaint — locked Complaint pool"),
    (11, "CUSTOMER_CARE", "CUSTOMER_CARE", False, "Past sale, 7–60 days since last sale"),
    (12, "PAST_RETENTION", "PAST_RETENTION", True, "Any past deal, OOC"),
    (13, "RETENTION", "RETENTION", True, "Any past deal, 1–540 days"),
    (14, "UPSELLING", "UPSELLING", False, "Any past deal, >540 days — no apply while parked"),
    (90, "PRE_WINDOW", "UNASSIGNED", False, "Wait — too far out"),
    (99, "UNASSIGNED", "UNASSIGNED", False, "Fallback — holding pool, no apply while parked"),
)

# ---------------------------------------------------------------------------
# FIXED VALUES -- routing-mode switches
# ---------------------------------------------------------------------------
# rules never switched off when parking
PARK_KEEP_TAGS = ("COMPLAINT", "CALLBACK", "RETENTION", "PAST_RETENTION")
# rules switched on when parking
PARK_ON_TAGS = ("COMPLAINT", "RETENTION", "PAST_RETENTION")
# shared pools agents keep while parked / pools kept by the dev reset
PARKED_VISIBLE_CODES = ("RETENTION", "PAST_RETENTION", "COMPLAINT")
RESET_KEEP_CODES = ("RETENTION", "PAST_RETENTION", "COMPLAINT", "UNASSIGNED", "UPSELLING", "CUSTOMER_CARE")
RESET_KEEP_TAGS = ("COMPLAINT", "CUSTOMER_CARE", "PAST_RETENTION", "RETENTION", "UPSELLING", "PRE_WINDOW", "UNASSIGNED", "CALLBACK")
RECLAIM_KEEP_CODES = ("RETENTION", "PAST_RETENTION", "COMPLAINT")
MANAGER_ROLES = ("MANAGER", "ADMIN")
SHARED_TYPES = ("STANDARD", "CAMPAIGN")
LINK_POOLS_CODES = ("RETENTION", "PAST_RETENTION")

# ---------------------------------------------------------------------------
# FIXED VALUES -- load source seed (id, name, kind, family)
# ---------------------------------------------------------------------------
LOAD_SOURCE_SEED = (
    ("eon_supplier", "E.ON supplier file", "SUPPLIER", "EON"),
    ("bg_supplier", "British Gas supplier file", "SUPPLIER", "BG"),
    ("ub_supplier", "Utility Bidder supplier file", "SUPPLIER", "UB"),
    ("other_supplier", "Other supplier file", "SUPPLIER", "OTHER"),
    ("retention", "Retention file", "RETENTION", None),
)

# -- members ---------------------------------------------------------------------------
#: the policies that split the two retention bags, in the fixtures (a caller names its own)
RETENTION_POLICIES = ("policy_retention", "policy_past_retention")
