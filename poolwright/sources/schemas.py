"""Declared schemas of the routing entities (the fixed middle of the pipeline)."""

from pyspark.sql import types as T

S, B, I, L = T.StringType(), T.BooleanType(), T.IntegerType(), T.LongType()
TS, TSN, D = T.TimestampType(), T.TimestampNTZType(), T.DateType()


def _schema(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


COMPANIES = _schema(("id", S), ("name", S), ("poolId", S), ("profileId", S))
COMPANY_SITES = _schema(("id", S), ("companyId", S), ("loadSourceId", S))
SITE_METERS = _schema(("id", S), ("companySiteId", S), ("isDeEnergised", B))
CONTRACTS = _schema(
    ("id", S), ("companyId", S), ("siteId", S), ("siteMeterId", S), ("providerId", S),
    ("type", S), ("utilityType", S), ("endDate", TSN),
)
PROVIDERS = _schema(("id", S), ("displayName", S))
PROVIDER_FAMILIES = _schema(
    ("id", S), ("providerId", S), ("family", S), ("tagCode", S), ("poolId", S), ("windowDays", I),
    ("displayName", S), ("isActive", B), ("isManual", B), ("matchedPattern", S),
)
DEALS = _schema(
    ("id", S), ("companyId", S), ("siteId", S), ("siteMeterId", S), ("contractId", S),
    ("status", S), ("signedAt", TSN), ("createdAt", TSN),
)
REVIEWS = _schema(("id", S), ("dealId", S), ("status", S))
CALLBACKS = _schema(("id", L), ("companySiteId", S), ("createdById", S), ("status", S))
NOTES = _schema(("id", L), ("companyId", S), ("title", S), ("description", S), ("isHidden", B))
PROFILES = _schema(
    ("id", S), ("userId", S), ("email", S), ("role", S), ("primaryPoolId", S), ("disabled", B),
)
POOLS = _schema(("id", S), ("code", S), ("name", S), ("type", S), ("isLocked", B))
POOL_RULES = _schema(("tag", S), ("poolId", S), ("priority", I), ("isActive", B), ("description", S))
POOL_LINKS = _schema(
    ("parentPoolId", S), ("childPoolId", S), ("parentType", S), ("childType", S), ("isActive", B),
)
SPLIT_POLICIES = _schema(("id", S), ("parentPoolId", S))
POOL_MEMBERS = _schema(("id", S), ("policyId", S), ("childPoolId", S), ("profileId", S), ("isActive", B))
POOL_PROFILES = _schema(("poolId", S), ("profileId", S))
MAPPINGS = _schema(
    ("companyId", S), ("companySiteId", S), ("campaign", S), ("source", S), ("migratedAt", TSN),
)
LOAD_SOURCES = _schema(("id", S), ("name", S), ("kind", S), ("family", S))
PLACEMENTS = _schema(
    ("id", S), ("companyId", S), ("poolId", S), ("sourcePoolId", S), ("actorId", S),
    ("distributedAt", TSN), ("endedAt", TSN),
)
AUDITS = _schema(
    ("id", S), ("companyId", S), ("poolId", S), ("action", S), ("actorId", S), ("reason", S),
    ("createdAt", TSN),
)
APPLY_BATCH = _schema(("company_id", S), ("proposed_pool_id", S), ("proposed_campaign_id", S))
PROFILE_BATCH = _schema(("company_id", S), ("proposed_profile_id", S))
