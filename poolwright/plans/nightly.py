"""The nightly routing job: snapshot -> janitor -> features -> tag -> propose -> parent ->
(fair share) -> move batch -> apply, with every stage output written once.

Each run writes a versioned directory ``<out_dir>/<run_id>/<table>``; inputs are never
overwritten in place (a table cannot be rewritten while it is being read), and every written
stage is read back so later stages start from files, not from a long lineage. A rerun with the
same ``run_id`` overwrites the same directories with the same rows (generated ids are hashes of
the run id), so a job restarted after losing executors or the driver converges.
"""

from __future__ import annotations

from dataclasses import dataclass, fields, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from poolwright.config import RunConfig
from poolwright.operators import apply as AP
from poolwright.operators import fair_share as FS
from poolwright.operators import features as C
from poolwright.operators import maintenance as M
from poolwright.operators import tagging as T
from poolwright.plans import reports as R
from poolwright.sources import conform_checked, read_or_empty, read_table, write_table
from poolwright.sources import schemas as SC
from poolwright.sources.store import TableStore, Transaction

# Candidate source column names per entity column (looked up case-insensitively).
ALIASES = {
    "contracts": {"type": ("contractType", "contract_type", "tariffType", "tariff", "productType")},
    "site_meters": {"companySiteId": ("siteId",)},
}

ENTITIES = {
    "companies": SC.COMPANIES, "company_sites": SC.COMPANY_SITES, "site_meters": SC.SITE_METERS,
    "contracts": SC.CONTRACTS, "providers": SC.PROVIDERS, "provider_families": SC.PROVIDER_FAMILIES,
    "deals": SC.DEALS, "compliance_review_entries": SC.REVIEWS, "callbacks": SC.CALLBACKS, "notes": SC.NOTES,
    "profiles": SC.PROFILES, "pools": SC.POOLS, "pool_rules": SC.POOL_RULES, "pool_links": SC.POOL_LINKS,
    "pool_profiles": SC.POOL_PROFILES, "external_site_mappings": SC.MAPPINGS, "crm_load_source": SC.LOAD_SOURCES,
    "company_pool_placements": SC.PLACEMENTS, "company_pool_audits": SC.AUDITS,
}
OPTIONAL = {"deals", "provider_families", "compliance_review_entries", "crm_load_source", "pool_links", "pool_profiles",
            "external_site_mappings", "notes", "callbacks", "company_pool_audits", "company_pool_placements"}


@dataclass
class Tables:
    companies: DataFrame
    company_sites: DataFrame
    site_meters: DataFrame
    contracts: DataFrame
    providers: DataFrame
    provider_families: DataFrame
    deals: DataFrame
    compliance_review_entries: DataFrame
    callbacks: DataFrame
    notes: DataFrame
    profiles: DataFrame
    pools: DataFrame
    pool_rules: DataFrame
    pool_links: DataFrame
    pool_profiles: DataFrame
    external_site_mappings: DataFrame
    crm_load_source: DataFrame
    company_pool_placements: DataFrame
    company_pool_audits: DataFrame
    #: the columns that the deals source itself has: they choose the path from deals to companies
    deal_columns: tuple[str, ...] | None = None
    #: rows that the loader set aside; not an entity, so not a field
    rejected = None


#: fields without which a row means nothing; the loader sets such rows aside
REQUIRED = {"companies": ("id",), "company_sites": ("id",), "site_meters": ("id",), "contracts": ("id",), "pools": ("id",)}


def load_snapshot(spark: SparkSession, root: str, fmt: str = "parquet") -> Tables:
    """S3 + S4: read every entity under ``root/<name>``, conform it to its declared schema.

    Optional entities that are missing read as empty frames; a missing required entity fails. Rows that don't
    fit their schema are set aside in ``rejected`` (entity, field, value, wanted, row) and take no part.
    """
    frames = {}
    rejected = None
    deal_columns: tuple[str, ...] = ()
    for name, schema in ENTITIES.items():
        path = f"{root.rstrip('/')}/{name}"
        reader = (lambda p=path: read_table(spark, fmt, p))
        df = read_or_empty(spark, reader, schema) if name in OPTIONAL else reader()
        if name == "deals":
            deal_columns = tuple(df.columns)  # a conformed frame has them all
        frames[name], bad = conform_checked(df, schema, ALIASES.get(name), REQUIRED.get(name, ()))
        bad = bad.select(F.lit(name).alias("entity"), "*")
        rejected = bad if rejected is None else rejected.unionByName(bad)
    tables = Tables(**frames, deal_columns=deal_columns)
    tables.rejected = rejected
    return tables


def from_fixtures(fx) -> Tables:
    """Tables view of a ``Fixtures`` object (tests and the bench)."""
    return Tables(**{f.name: (fx.pool_rules() if f.name == "pool_rules" else getattr(fx, f.name)) for f in fields(Tables)})


def route(t: Tables, cfg: RunConfig, rules: DataFrame | None = None) -> DataFrame:
    """Features -> tag -> proposal -> parent (-> fair share when ``cfg.fair_share``)."""
    features = C.build_features(t, cfg)
    tagged = T.tag(features, t.pools, cfg)
    proposed = T.propose(tagged, rules if rules is not None else t.pool_rules, t.pools, cfg)
    routed = T.with_parent(proposed, t.pools, cfg)
    if cfg.fair_share:
        routed = FS.fair_share(routed, t.pool_links, cfg)
    return routed


def _stage(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    write_table(df, path)
    return spark.read.parquet(path)


def run_nightly(spark: SparkSession, t: Tables, cfg: RunConfig, out_dir: str) -> DataFrame:
    """Run the whole job; returns a (metric, value) summary read from the written outputs."""
    root = f"{out_dir.rstrip('/')}/{cfg.run_id}"
    AP.check_actor(cfg)
    # janitor first: leavers lose their agent before anything is read for routing
    companies, cleared = M.clear_leavers(t.companies, t.profiles, cfg)
    companies = _stage(spark, companies, f"{root}/companies_janitor")
    t = replace(t, companies=companies)
    # rules and families apply as stored: switching the routing mode is a job of its own
    routed = _stage(spark, route(t, cfg), f"{root}/routed")
    batch = _stage(spark, T.move_batch(routed, cfg), f"{root}/apply_batch")
    res = AP.apply_batch(batch, companies, t.company_pool_placements, t.company_pool_audits, t.pools,
                         t.pool_links, cfg)
    out = {
        "companies": res.companies, "company_pool_placements": res.placements,
        "company_pool_audits": res.audits, "moves": res.moves, "rejected_moves": res.rejected,
    }
    written = {name: _stage(spark, df, f"{root}/{name}") for name, df in out.items()}
    return R.stack(
        R._metric(written["companies"], "companies", F.count(F.lit(1))),
        R._metric(routed, "protected", F.count_if(F.coalesce(F.col("is_protected"), F.lit(False)))),
        R._metric(batch, "batch_rows", F.count(F.lit(1))),
        R._metric(written["moves"], "companies_moved", F.count(F.lit(1))),
        R._metric(written["rejected_moves"], "rejected_moves", F.count(F.lit(1))),
        R._metric(spark.read.parquet(f"{root}/companies_janitor").join(
            cleared, F.col("id") == F.col("company_id"), "left_semi"), "janitor_cleared", F.count(F.lit(1))),
    )


def night_on_store(tx: Transaction, t: Tables, cfg: RunConfig) -> None:
    """The job on versioned tables: what it rewrites it also reads, and nothing shows until the commit.

    The first night takes companies, placements and audits from ``t``; later ones find them in the store, as the
    nights before left them. Open placements are kept apart from closed ones, which are only added to, as are audits. The
    row counts of every stage are taken while it is written.
    """
    AP.check_actor(cfg)
    if "companies" not in tx.tables:
        is_open, closed = AP.split_history(t.company_pool_placements)
        tx.put("placements_open", is_open)
        tx.put("placements_closed", closed)
        tx.put("audits", t.company_pool_audits)
        tx.put("companies", t.companies)
    companies, cleared = M.clear_leavers(tx.read("companies"), t.profiles, cfg)
    tx.put("janitor_cleared", cleared)
    companies = tx.put("companies", companies)
    if t.rejected is not None:
        tx.put("rejected_rows", t.rejected)
    routed = tx.put("routed", route(replace(t, companies=companies, company_pool_audits=tx.read("audits")), cfg))
    batch = tx.put("apply_batch", T.move_batch(routed, cfg))
    valid, rejected = AP.validate_batch(batch, companies, t.pools, t.pool_links, cfg)
    tx.put("rejected_moves", rejected)
    moves = tx.put("moves", AP.effective_moves(valid))
    refresh_src = valid if cfg.refresh_validated_only else batch
    still_open, closing = AP.roll_open(tx.read("placements_open"), moves, refresh_src, t.pools, cfg)
    tx.append("placements_closed", closing)
    tx.put("placements_open", still_open)
    tx.append("audits", AP.audit_rows(moves, cfg))
    tx.put("companies", AP.apply_moves(companies, moves))


#: stage counts of a night, by the table whose rows they are
NIGHT_COUNTS = {"companies": "companies", "apply_batch": "batch_rows", "moves": "companies_moved", "rejected_moves": "rejected_moves", "janitor_cleared": "janitor_cleared"}


def run_night(store: TableStore, t: Tables, cfg: RunConfig) -> DataFrame:
    """Run the night ``cfg.run_id`` on a store, or find it done; returns (metric, value) as counted in the writes.

    A run that was killed is run again whole: its parts are written over, and one commit switches all tables.
    """
    version = store.run(cfg.run_id, lambda tx: night_on_store(tx, t, cfg))
    return store.spark.createDataFrame([(m, version.tables[n].rows) for n, m in NIGHT_COUNTS.items()], "metric string, value long")


def switch_mode(spark: SparkSession, t: Tables, mode: str, out_dir: str) -> DataFrame:
    """T7 as a job: write the rules and families as the routing mode wants them; returns counts of active ones.

    Only this job changes stored switches. A rule that an operator turns off stays off in the nightly runs.
    """
    rules, families = T.activate(t.pool_rules, t.provider_families, mode)
    rules = _stage(spark, rules, f"{out_dir.rstrip('/')}/pool_rules")
    families = _stage(spark, families, f"{out_dir.rstrip('/')}/provider_families")
    return R.stack(R._metric(rules, "active_rules", F.count_if(F.col("isActive"))),
                   R._metric(families, "active_families", F.count_if(F.col("isActive"))))
