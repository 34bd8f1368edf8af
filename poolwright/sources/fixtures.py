"""Routing entities derived from the driver's TPC-H-ish tables (FIXTURES.md).

Every entity is a lazy DataFrame over the given parquet files, so its size grows with the
scale factor. Dimension seeds (shared pools, rules) are fixed values; private pools, links
and visibility rows are derived from the profiles, which come from ``supplier``.
The DuckDB twin of this module is ``poolwright.twins.FIXTURE_CTES``; both must stay equal.
"""

from __future__ import annotations

import datetime as _dt
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from poolwright.config import RunConfig
from poolwright.functions import constants as K
from poolwright.sources import conform, empty
from poolwright.sources import schemas as SC


def str_null():
    return F.lit(None).cast("string")

# Fixed fixture timestamps for the seeded placement history.
OPEN_SINCE = _dt.datetime(1999, 6, 1)
CLOSED_FROM = _dt.datetime(1999, 1, 1)


def sid(prefix: str, col: Column) -> Column:
    return F.concat(F.lit(prefix), col.cast("string"))


class Fixtures:
    """Lazily built entity frames for one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str, cfg: RunConfig):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.cfg = cfg

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    #: the columns of the deals source (a conformed frame has them all): the path from deals to companies
    deal_columns = ("id", "siteMeterId", "siteId", "companyId", "contractId", "signedAt", "createdAt", "status")

    def _n(self, table: str) -> Column:
        return self.raw(table).select(F.count(F.lit(1))).scalar()

    def _nth_private(self, n: Column) -> Column:
        """The id of the n-th private pool (modulo their number): those of suppliers 1, 5, 9, ..."""
        owners = self.raw("supplier").where(F.col("s_suppkey") % 4 == 1).select(F.count(F.lit(1))).scalar()
        return sid("priv_", 4 * (n % owners) + 1)

    # -- what the linked variant overrides -------------------------------------
    def _names_meter(self, order: Column) -> Column:
        """Whether an order's deal names its meter."""
        return order % 8 == 0

    def _names_customer(self, order: Column) -> Column:
        """Whether an order's site mapping names a company that the company table knows."""
        return order % 20 == 0

    # -- facts ---------------------------------------------------------------
    @cached_property
    def companies(self) -> DataFrame:
        k = F.col("c_custkey")
        pool = (
            F.when(k % 10 == 0, str_null())
            .when(k % 97 == 1, F.lit("pool_COMPLAINT"))
            .when(k % 89 == 1, F.lit("pool_GDPR_HOLD"))
            .when(k % 10 == 1, F.lit("pool_PAST_RETENTION"))
            .when(k % 10 == 2, F.lit("pool_UNASSIGNED"))
            .when(k % 10 == 3, self._nth_private(F.expr("c_custkey div 10")))
            .otherwise(F.lit("pool_RETENTION"))
        )
        df = self.raw("customer").select(
            sid("C", k).alias("id"), F.col("c_name").alias("name"), pool.alias("poolId"),
            sid("U", k % self._n("supplier")).alias("profileId"),
        )
        return conform(df, SC.COMPANIES)

    @cached_property
    def company_sites(self) -> DataFrame:
        k = F.col("o_orderkey")
        load_source = F.when(k % 50 == 7, F.lit("retention")).when(k % 50 == 13, F.lit("eon_supplier"))
        df = self.raw("orders").select(
            sid("S", k).alias("id"), sid("C", F.col("o_custkey")).alias("companyId"),
            load_source.alias("loadSourceId"),
        )
        return conform(df, SC.COMPANY_SITES)

    @cached_property
    def site_meters(self) -> DataFrame:
        # the least status is F where one is F and none is under it: flags keep the aggregate a hash table, text would be sorted
        st = F.col("l_linestatus")
        df = self.raw("lineitem").groupBy("l_orderkey").agg((F.bool_or(st == "F") & F.bool_and(st >= "F")).alias("dead")).select(
            sid("M", F.col("l_orderkey")).alias("id"),
            sid("S", F.col("l_orderkey")).alias("companySiteId"),
            F.when(F.col("l_orderkey") % 11 == 0, F.lit(None).cast("boolean"))
            .otherwise(F.col("dead")).alias("isDeEnergised"),
        )
        return conform(df, SC.SITE_METERS)

    @cached_property
    def contracts(self) -> DataFrame:
        li = self.raw("lineitem")
        o = self.raw("orders").select("o_orderkey", "o_custkey")
        j = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
        pk, sk, ok = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_orderkey")
        ctype = (
            F.when(sk % 6 == 0, F.lit("1")).when(sk % 6 == 1, F.lit("fixed"))
            .when(sk % 6 == 2, F.lit("Deemed")).when(sk % 6 == 3, F.lit("Variable rate"))
            .when(sk % 6 == 4, F.lit("3"))
        )
        df = j.select(
            F.concat_ws("-", *[c.cast("string") for c in (ok, pk, sk, F.col("l_linenumber"))]).alias("_k"),
            F.when(pk % 3 == 0, sid("C", F.col("o_custkey")))
            .when(pk % 2 == 0, F.lit("  ")).alias("companyId"),
            F.when(pk % 3 == 1, sid("S", ok)).alias("siteId"),
            F.when(pk % 3 == 2, sid("M", ok)).alias("siteMeterId"),
            F.when(pk % 17 == 0, str_null()).otherwise(sid("P", sk)).alias("providerId"),
            ctype.alias("type"),
            F.when(pk % 13 == 0, F.lit(None).cast("timestamp_ntz")).otherwise(F.col("l_shipdate")).alias("endDate"),
            ok,  # a contract's id begins with it: equal rows lie where the join put them, so they meet without an exchange
        ).distinct().withColumn("id", F.concat(F.lit("K"), F.col("_k"))).drop("_k", "l_orderkey")
        return conform(df, SC.CONTRACTS)

    @cached_property
    def providers(self) -> DataFrame:
        s = F.col("s_suppkey") % 8
        name = (
            F.when(s == 0, F.lit("British Gas")).when(s == 1, F.lit("British Gas Lite"))
            .when(s == 2, F.lit("E.ON Next")).when(s == 3, F.lit("Utility Bidder"))
            .when(s == 4, F.lit("Yu Energy")).when(s == 5, F.lit("Yu-Energy "))
            .when(s == 6, F.lit("")).otherwise(F.col("s_name"))
        )
        df = self.raw("supplier").select(sid("P", F.col("s_suppkey")).alias("id"), name.alias("displayName"))
        return conform(df, SC.PROVIDERS)

    @cached_property
    def deals(self) -> DataFrame:
        """A deal for each order; two in three name the order's first contract."""
        # the least contract id of an order's lines; ids are made of the line's keys
        line = F.concat_ws("-", *[F.col(c).cast("string") for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")])
        first = self.raw("lineitem").groupBy(F.col("l_orderkey").alias("_order")).agg(F.min(F.concat(F.lit("K"), line)).alias("_contract"))
        k = F.col("o_orderkey")
        pending = F.col("o_orderstatus") == "P"
        status = (
            F.when(pending & (F.col("o_orderpriority") == "1-URGENT"), F.lit("Rejected"))
            .when(pending & (F.col("o_orderpriority") == "2-HIGH"), F.lit("CANCELLED"))
            .otherwise(F.lit("LIVE"))
        )
        o = self.raw("orders")
        df = o.join(first, k == F.col("_order"), "left").select(
            sid("D", k).alias("id"), sid("C", F.col("o_custkey")).alias("companyId"),
            sid("S", k).alias("siteId"), F.when(self._names_meter(k), sid("M", k)).alias("siteMeterId"),
            F.when(k % 3 != 0, F.col("_contract")).alias("contractId"), status.alias("status"),
            F.when(k % 7 != 0, F.col("o_orderdate")).alias("signedAt"), F.col("o_orderdate").alias("createdAt"),
        )
        return conform(df, SC.DEALS)

    @cached_property
    def compliance_review_entries(self) -> DataFrame:
        """A review of each order's deal; one in 31 says no."""
        k = F.col("o_orderkey")
        df = self.raw("orders").select(
            sid("D", k).alias("dealId"), F.when(k % 62 == 0, F.lit("Declined by QA")).when(k % 31 == 0, F.lit("rejected")).otherwise(F.lit("Passed")).alias("status"))
        return conform(df, SC.REVIEWS)

    @cached_property
    def callbacks(self) -> DataFrame:
        e = self.raw("events").where(F.col("event_type") == "click")
        df = e.select(
            F.col("event_id").alias("id"),
            sid("S", F.col("event_id") % self._n("orders")).alias("companySiteId"),
            sid("U", F.col("user_id") % self._n("supplier")).alias("createdById"),
            F.when((F.col("event_id") % 40 == 0) & (F.col("event_id") % 3 != 0), F.lit("SCHEDULED")).otherwise(F.lit("DONE")).alias("status"),
        )
        return conform(df, SC.CALLBACKS)

    @cached_property
    def notes(self) -> DataFrame:
        e = self.raw("events").where(F.col("event_type") == "error")
        # 0 and 1: an ongoing complaint, in the title or across title and description; 2: neither
        m = F.when((F.col("event_id") % 8 == 0) & (F.col("user_id") % 10 == 7), F.col("event_id") % 3).otherwise(2)
        df = e.select(
            F.col("event_id").alias("id"),
            sid("C", F.col("event_id") % self._n("customer")).alias("companyId"),
            F.when(m == 0, F.lit("Ongoing Complaint raised")).when(m == 1, F.lit("ongoing")).alias("title"),
            F.when(m == 1, F.lit("complaint")).otherwise(F.lit("call back")).alias("description"),
            (F.col("event_id") % 5 == 0).alias("isHidden"),
        )
        return conform(df, SC.NOTES)

    @cached_property
    def company_pool_audits(self) -> DataFrame:
        e = self.raw("events").where(F.col("event_type") == "purchase")
        df = e.select(
            sid("A", F.col("event_id")).alias("id"),
            sid("C", F.col("event_id") % self._n("customer")).alias("companyId"),
            F.when(F.col("event_id") % 90 == 0, F.lit("pool_COMPLAINT")).otherwise(F.lit("pool_RETENTION")).alias("poolId"),
            F.lit("MANUAL").alias("action"), F.lit("seed").alias("actorId"),
            F.col("ts").alias("createdAt"),
        )
        return conform(df, SC.AUDITS)

    @cached_property
    def external_site_mappings(self) -> DataFrame:
        o = self.raw("orders")
        p = F.col("o_orderpriority")
        # most mapped sites belong to customers of others, whom the company table doesn't know
        known = F.when(self._names_customer(F.col("o_orderkey")), sid("C", F.col("o_custkey"))).otherwise(sid("X", F.col("o_custkey")))
        campaign = (
            F.when(p == "1-URGENT", F.lit("Retention")).when(p == "2-HIGH", F.lit("Supplier"))
            .when(p == "3-MEDIUM", F.lit("")).when(p == "5-LOW", F.lit("RETENTION load"))
        )
        df = o.select(
            known.alias("companyId"), sid("S", F.col("o_orderkey")).alias("companySiteId"),
            campaign.alias("campaign"),
            F.when(F.col("o_orderstatus") == "O", F.lit("retention file")).otherwise(F.lit("supplier")).alias("source"),
            F.col("o_orderdate").alias("migratedAt"),
        )
        return conform(df, SC.MAPPINGS)

    @cached_property
    def crm_load_source(self) -> DataFrame:
        return self.spark.createDataFrame(list(K.LOAD_SOURCE_SEED), SC.LOAD_SOURCES)

    @cached_property
    def profiles(self) -> DataFrame:
        s = F.col("s_suppkey")
        df = self.raw("supplier").select(
            sid("U", s).alias("id"), sid("U", s).alias("userId"),
            F.concat(F.lit("agent"), s.cast("string"), F.lit("@example.com")).alias("email"),
            F.when(s % 25 == 1, F.lit("ADMIN")).when(s % 10 == 5, F.lit("MANAGER")).otherwise(F.lit("AGENT")).alias("role"),
            F.when(s % 4 == 1, sid("priv_", s)).alias("primaryPoolId"),
            (s % 9 == 0).alias("disabled"),
        )
        return conform(df, SC.PROFILES)

    # -- dimensions ----------------------------------------------------------
    @cached_property
    def pools(self) -> DataFrame:
        shared = [(f"pool_{c}", c, n, t, lk) for c, n, t, lk in K.POOL_SEED]
        shared.append(("pool_GDPR_HOLD", "GDPR_HOLD", "GDPR hold", "STANDARD", False))
        seed = self.spark.createDataFrame(shared, SC.POOLS)
        private = (
            self.profiles.where(F.col("primaryPoolId").isNotNull()).select("primaryPoolId").distinct()
            .select(
                F.col("primaryPoolId").alias("id"), str_null().alias("code"),
                F.concat(F.lit("Private "), F.col("primaryPoolId")).alias("name"),
                F.lit("PRIVATE").alias("type"), F.lit(False).alias("isLocked"),
            )
        )
        return seed.unionByName(private)

    def pool_rules(self, mode: str | None = None) -> DataFrame:
        mode = mode or self.cfg.mode
        if mode == "parked":
            rows = [(t, f"pool_{c}", p, a, d) for p, t, c, a, d in K.PARKED_RULE_SEED]
        else:
            rows = [(t, f"pool_{c}", p, True, d) for p, t, c, d in K.RULE_SEED]
        return self.spark.createDataFrame(rows, SC.POOL_RULES)

    @cached_property
    def pool_links(self) -> DataFrame:
        # the number comes from the key, not back out of the id: a cast of text may be moved before a filter on it
        number = F.col("s_suppkey")
        priv = self.raw("supplier").where(number % 4 == 1).select(number, sid("priv_", number).alias("childPoolId"))
        every = priv.select(
            F.explode(F.array(F.lit("pool_RETENTION"), F.lit("pool_PAST_RETENTION"))).alias("parentPoolId"),
            "childPoolId", "s_suppkey",
        ).select(
            "parentPoolId", "childPoolId", F.lit("STANDARD").alias("parentType"), F.lit("PRIVATE").alias("childType"),
            (~((F.col("parentPoolId") == "pool_RETENTION") & (number % 16 == 13))).alias("isActive"), "s_suppkey",
        )
        duplicate = every.where((F.col("parentPoolId") == "pool_PAST_RETENTION") & (number % 16 == 5))
        links = every
        return conform(links.unionByName(duplicate), SC.POOL_LINKS)

    @cached_property
    def pool_profiles(self) -> DataFrame:
        s = F.col("s_suppkey")
        pr = self.raw("supplier").select(
            "s_suppkey", sid("U", s).alias("id"), F.when(s % 4 == 1, sid("priv_", s)).alias("primaryPoolId"))
        own = pr.where(F.col("primaryPoolId").isNotNull()).select(F.col("primaryPoolId").alias("poolId"), F.col("id").alias("profileId"))
        wrong = pr.where(F.col("primaryPoolId").isNull() & (s % 7 == 0)).select(
            self._nth_private(s).alias("poolId"), F.col("id").alias("profileId"))
        retention = pr.select(F.lit("pool_RETENTION").alias("poolId"), F.col("id").alias("profileId"))
        unassigned = pr.where(s % 3 == 0).select(F.lit("pool_UNASSIGNED").alias("poolId"), F.col("id").alias("profileId"))
        complaint = pr.where(s % 4 == 0).select(F.lit("pool_COMPLAINT").alias("poolId"), F.col("id").alias("profileId"))
        return own.unionByName(wrong).unionByName(retention).unionByName(unassigned).unionByName(complaint).distinct()

    @cached_property
    def split_policies(self) -> DataFrame:
        """The policies that split a shared pool over its members; the last isn't one of retention."""
        rows = [(K.RETENTION_POLICIES[0], "pool_RETENTION"), (K.RETENTION_POLICIES[1], "pool_PAST_RETENTION"), ("policy_unassigned", "pool_UNASSIGNED")]
        return self.spark.createDataFrame(rows, SC.SPLIT_POLICIES)

    @cached_property
    def pool_members(self) -> DataFrame:
        """A member of each policy for each supplier: of a private pool that has an owner, or (supplier % 4 = 2) of one that has none."""
        s, policy = F.col("s_suppkey"), F.col("policyId")
        policies = F.array(*[F.lit(p) for p in (*K.RETENTION_POLICIES, "policy_unassigned")])
        every = self.raw("supplier").where((s % 4).isin(1, 2)).select("s_suppkey", F.explode(policies).alias("policyId"))
        df = every.select(
            F.concat(F.lit("MB-"), policy, F.lit("-"), s.cast("string")).alias("id"), "policyId", sid("priv_", s).alias("childPoolId"),
            F.when(s % 8 == 2, sid("U", s)).when((s % 16 == 9) & (policy == K.RETENTION_POLICIES[0]), sid("U", s + 1)).alias("profileId"),
            F.when(s % 32 == 17, F.lit(None).cast("boolean")).otherwise(s % 16 != 5).alias("isActive"),
        )
        return conform(df, SC.POOL_MEMBERS)

    @cached_property
    def provider_families(self) -> DataFrame:
        """None in parked mode. In live mode what earlier syncs and operators left: manual families, which the sync keeps,
        generated ones, which it replaces, and those of providers that are gone."""
        if self.cfg.mode == "parked":
            return empty(self.spark, SC.PROVIDER_FAMILIES)
        k = F.col("s_suppkey")
        kind = k % 7
        df = self.raw("supplier").where(kind.isin(1, 3, 5)).select(
            sid("fam_old_", k).alias("id"),
            F.when(kind == 1, sid("X", k)).otherwise(sid("P", k)).alias("providerId"),
            F.when(kind == 3, F.lit("BG")).otherwise(F.lit("OTHER")).alias("family"),
            F.when(kind == 3, F.lit("BG")).otherwise(F.lit("OTHER")).alias("tagCode"),
            F.when(kind == 3, F.lit("pool_BG")).alias("poolId"), F.lit(180).alias("windowDays"), F.col("s_name").alias("displayName"),
            (k % 14 != 10).alias("isActive"), F.when(kind == 3, F.lit(True)).when(kind == 5, F.lit(False)).alias("isManual"),
            F.lit("by hand").alias("matchedPattern"),
        )
        return conform(df, SC.PROVIDER_FAMILIES)

    @cached_property
    def company_pool_placements(self) -> DataFrame:
        co = self.companies.withColumn("k", F.expr("cast(substring(id, 2) as bigint)"))
        open_rows = co.where(F.col("poolId").isNotNull()).select(
            F.concat(F.lit("PL-"), F.col("id")).alias("id"), F.col("id").alias("companyId"), "poolId",
            F.col("poolId").alias("sourcePoolId"), F.lit("seed").alias("actorId"),
            F.lit(OPEN_SINCE).cast("timestamp_ntz").alias("distributedAt"),
            F.lit(None).cast("timestamp_ntz").alias("endedAt"),
        )
        closed = co.where(F.col("k") % 7 == 0).select(
            F.concat(F.lit("PLX-"), F.col("id")).alias("id"), F.col("id").alias("companyId"),
            F.lit("pool_UNASSIGNED").alias("poolId"), str_null().alias("sourcePoolId"),
            F.lit("seed").alias("actorId"),
            F.lit(CLOSED_FROM).cast("timestamp_ntz").alias("distributedAt"),
            F.lit(OPEN_SINCE).cast("timestamp_ntz").alias("endedAt"),
        )
        return conform(open_rows.unionByName(closed), SC.PLACEMENTS)


class LinkedFixtures(Fixtures):
    """Every deal names its meter, and 19 of 20 mappings name a known company, so that most facts reach a company."""

    def _names_meter(self, order: Column) -> Column:
        return F.lit(True)

    def _names_customer(self, order: Column) -> Column:
        return order % 20 != 0
