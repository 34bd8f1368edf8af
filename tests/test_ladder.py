"""Tag ladder boundaries on hand-made feature rows (default thresholds 21/200, 540, 7/60, 365)."""

import pytest
from pyspark.sql import functions as F

from poolwright.config import RunConfig
from poolwright.operators import tagging as T
from poolwright.sources import schemas as SC

CFG = RunConfig()
BASE = dict(
    company_id=None, current_pool_id="pool_RETENTION", has_complaint_note=False, has_complaint_transfer=False,
    has_open_callback=False, is_current_pool_locked=False, is_gdpr_pool=False, has_any_past_deal=False,
    has_rejected_deal=False, last_deal_days_since=None, site_count=1, win_tag_code="OTHER", win_family="OTHER",
    raw_days_left=100, days_left=100, last_deal_days_left=None, last_deal_raw_days_left=None, is_win_dfv=False,
    is_exclusively_deenergised=False, win_window_days=365, callback_owner_pool_id=None,
)
COLS = list(BASE)
TYPES = ("company_id string, current_pool_id string, has_complaint_note boolean, has_complaint_transfer boolean, "
         "has_open_callback boolean, is_current_pool_locked boolean, is_gdpr_pool boolean, has_any_past_deal boolean, "
         "has_rejected_deal boolean, last_deal_days_since int, site_count bigint, win_tag_code string, win_family string, "
         "raw_days_left int, days_left int, last_deal_days_left int, last_deal_raw_days_left int, is_win_dfv boolean, "
         "is_exclusively_deenergised boolean, win_window_days int, callback_owner_pool_id string")


def clock(days):
    return dict(has_any_past_deal=True, last_deal_raw_days_left=days,
                last_deal_days_left=None if days is None else days)


CASES = [
    ("complaint_note", dict(has_complaint_note=True, has_open_callback=True), "COMPLAINT"),
    ("complaint_pool", dict(current_pool_id="pool_COMPLAINT"), "COMPLAINT"),
    ("callback_over_locked", dict(has_open_callback=True, is_current_pool_locked=True), "CALLBACK"),
    ("gdpr", dict(is_gdpr_pool=True, has_any_past_deal=True), "LOCKED"),
    ("care_6", dict(clock(100), last_deal_days_since=6), "RETENTION"),
    ("care_7", dict(clock(100), last_deal_days_since=7), "CUSTOMER_CARE"),
    ("care_60", dict(clock(100), last_deal_days_since=60), "CUSTOMER_CARE"),
    ("care_61", dict(clock(100), last_deal_days_since=61), "RETENTION"),
    ("care_future_deal", dict(clock(100), last_deal_days_since=-3), "RETENTION"),
    ("care_rejected", dict(clock(100), last_deal_days_since=10, has_rejected_deal=True), "OTHER_IN_WINDOW"),
    ("clock_minus1", clock(-1), "PAST_RETENTION"),
    ("clock_0", clock(0), "PAST_RETENTION"),
    ("clock_1", clock(1), "RETENTION"),
    ("clock_540", clock(540), "RETENTION"),
    ("clock_541", clock(541), "UPSELLING"),
    ("clock_null", clock(None), "PAST_RETENTION"),
    ("sites_20", dict(site_count=20, is_win_dfv=True), "OTHER_IN_WINDOW"),
    ("sites_21_dfv", dict(site_count=21, is_win_dfv=True), "CORPORATE"),
    ("sites_21_365", dict(site_count=21, days_left=365, raw_days_left=365), "CORPORATE"),
    ("sites_21_366", dict(site_count=21, days_left=366, raw_days_left=366), "UNASSIGNED"),
    ("sites_200_nodate", dict(site_count=200, raw_days_left=None, days_left=0), "CORPORATE"),
    ("sites_201", dict(site_count=201, is_win_dfv=True), "UNASSIGNED"),
    ("dead_meters", dict(is_exclusively_deenergised=True), "UNASSIGNED"),
    ("no_winner", dict(win_tag_code=None, win_family=None), "UNASSIGNED"),
    ("eon_dfv", dict(win_tag_code="EON", win_family="EON", is_win_dfv=True, days_left=-5, raw_days_left=-5), "EON_DFV"),
    ("now_zero", dict(days_left=0, raw_days_left=0), "OTHER_NOW"),
    ("now_nodate", dict(days_left=0, raw_days_left=None, win_tag_code="UB", win_family="UB"), "UB_NOW"),
    ("window_365", dict(days_left=365, raw_days_left=365), "OTHER_IN_WINDOW"),
    ("window_366", dict(days_left=366, raw_days_left=366), "PRE_WINDOW"),
    ("bg_548", dict(win_tag_code="BG", win_family="BG", win_window_days=548, days_left=548, raw_days_left=548), "BG_IN_WINDOW"),
    ("bg_549", dict(win_tag_code="BG", win_family="BG", win_window_days=548, days_left=549, raw_days_left=549), "PRE_WINDOW"),
    ("eon_window", dict(win_tag_code="EON", win_family="EON", days_left=30, raw_days_left=30), "EON_IN_WINDOW"),
    ("lite_window", dict(win_tag_code="BG_LITE", win_family="BG", days_left=30, raw_days_left=30), "BG_LITE_IN_WINDOW"),
]


@pytest.fixture(scope="module")
def tagged(spark):
    rows = []
    for name, over, _ in CASES:
        r = dict(BASE, **over, company_id=name)
        rows.append(tuple(r[c] for c in COLS))
    feats = spark.createDataFrame(rows, TYPES)
    pools = spark.createDataFrame([("pool_COMPLAINT", "COMPLAINT", "Complaint", "STANDARD", True),
                                   ("pool_RETENTION", "RETENTION", "Retentions", "STANDARD", False)], SC.POOLS)
    return {r["company_id"]: r for r in T.tag(feats, pools, CFG).collect()}


@pytest.mark.parametrize("name,over,expected", CASES, ids=[c[0] for c in CASES])
def test_ladder(tagged, name, over, expected):
    assert tagged[name]["lead_tag"] == expected


def test_protected_null_pool_is_false(spark):
    r = dict(BASE, company_id="x", current_pool_id=None)
    feats = spark.createDataFrame([tuple(r[c] for c in COLS)], TYPES)
    pools = spark.createDataFrame([("pool_COMPLAINT", "COMPLAINT", "Complaint", "STANDARD", True)], SC.POOLS)
    row = T.tag(feats, pools, CFG).collect()[0]
    assert row["is_protected"] is False


def test_exactly_one_tag_per_company(tagged):
    assert all(r["lead_tag"] for r in tagged.values())


RUNGS = ["COMPLAINT", "CALLBACK", "LOCKED"]
RAISE = {"COMPLAINT": dict(has_complaint_note=True), "CALLBACK": dict(has_open_callback=True),
         "LOCKED": dict(is_current_pool_locked=True)}


def test_raising_a_higher_rung_never_lowers_the_tag(spark):
    """Property: switching on a sticky condition yields that rung or a higher one."""
    import random
    rng = random.Random(11)
    rows = []
    for i in range(300):
        days = rng.choice([None, -5, 0, 1, 30, 365, 366, 540, 541, 900])
        r = dict(BASE, company_id=f"r{i}", has_any_past_deal=rng.random() < 0.5, has_rejected_deal=rng.random() < 0.2,
                 last_deal_days_since=rng.choice([None, 3, 7, 30, 60, 61]), site_count=rng.choice([1, 15, 21, 150, 201]),
                 last_deal_raw_days_left=days, last_deal_days_left=days, is_win_dfv=rng.random() < 0.3,
                 win_tag_code=rng.choice(["EON", "BG", "UB", "OTHER", None]), is_gdpr_pool=rng.random() < 0.1)
        rows.append(("base", r))
        for rung, over in RAISE.items():
            rows.append((rung, dict(r, **over, company_id=f"{r['company_id']}_{rung}")))
    feats = spark.createDataFrame([tuple(r[c] for c in COLS) for _, r in rows], TYPES)
    pools = spark.createDataFrame([("pool_COMPLAINT", "COMPLAINT", "Complaint", "STANDARD", True)], SC.POOLS)
    got = {r["company_id"]: r["lead_tag"] for r in T.tag(feats, pools, CFG).collect()}
    for rung, r in rows:
        tag = got[r["company_id"]]
        assert tag, r
        if rung != "base":
            allowed = RUNGS[: RUNGS.index(rung) + 1]
            assert tag in allowed, (rung, tag)
