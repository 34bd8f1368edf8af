"""Fair share: the closed-form distributed plan against the slot-list definition."""

import random

from poolwright.config import RunConfig
from poolwright.operators.fair_share import fair_share
from poolwright.sources import schemas as SC

ROUTED = ("company_id string, current_pool_id string, proposed_pool_id string, parent_pool_id string, "
          "is_protected boolean, lead_tag string")


def brute_force(children_have: dict[str, int], candidates: list[str]) -> dict[str, str]:
    """Reference definition: need_n slots per child, ranked by (have + slot, child, slot)."""
    n = len(candidates)
    slots = sorted(((h + i, c, i) for c, h in children_have.items() for i in range(1, n + 1)))
    return {co: slots[r][1] for r, co in enumerate(sorted(candidates))}


def build_case(rng, p):
    parent = f"P{p}"
    kids = [f"{parent}_k{j:02d}" for j in range(rng.randint(1, 6))]
    have = {k: 0 for k in kids}
    rows, cands = [], []
    for j in range(rng.randint(0, 25)):  # kept companies (already in a child)
        k = rng.choice(kids)
        have[k] += 1
        rows.append((f"{parent}_kept{j:03d}", k, parent, parent, False, "RETENTION"))
    for j in range(rng.randint(0, 60)):  # candidates, unsorted ids
        cid = f"{parent}_c{rng.randint(0, 10**6):07d}_{j}"
        cands.append(cid)
        rows.append((cid, "pool_OTHER", parent, parent, False, "RETENTION"))
    rows.append((f"{parent}_prot", "pool_X", parent, parent, True, "CALLBACK"))
    links = [(parent, k, "STANDARD", "PRIVATE", True) for k in kids]
    return rows, links, have, cands


def test_closed_form_matches_slot_list(spark):
    rng = random.Random(7)
    rows, links, expected = [], [], {}
    for p in range(40):
        r, lk, have, cands = build_case(rng, p)
        rows += r
        links += lk
        expected.update(brute_force(have, cands))
        expected.update({x[0]: x[1] for x in r if x[0].split("_")[1].startswith("kept")})
        expected[f"P{p}_prot"] = f"P{p}"
    # a duplicate link, an inactive link and a parent without children
    links.append(links[0])
    links.append(("P0", "P0_inactive", "STANDARD", "PRIVATE", False))
    rows.append(("lonely", None, "P_none", "P_none", False, "RETENTION"))
    expected["lonely"] = "P_none"
    out = fair_share(spark.createDataFrame(rows, ROUTED), spark.createDataFrame(links, SC.POOL_LINKS), RunConfig())
    got = {r["company_id"]: r["proposed_pool_id"] for r in out.collect()}
    assert got == expected


def test_one_hot_parent_spread_over_partitions(spark):
    """All candidates under one parent: the rank must still be exact (range-partitioned)."""
    n, kids = 5000, ["a", "b", "c"]
    rows = [(f"c{i:05d}", None, "HOT", "HOT", False, "RETENTION") for i in range(n)]
    links = [("HOT", k, "CAMPAIGN", "PRIVATE", True) for k in kids]
    out = fair_share(spark.createDataFrame(rows, ROUTED), spark.createDataFrame(links, SC.POOL_LINKS), RunConfig())
    got = {r["company_id"]: r["proposed_pool_id"] for r in out.collect()}
    assert got == brute_force({k: 0 for k in kids}, [r[0] for r in rows])


def test_parent_with_thousands_of_children(spark):
    """One parent holds most companies and thousands of children with uneven loads."""
    kids = [f"k{j:04d}" for j in range(2000)]
    have = {k: (j * 7919) % 5 for j, k in enumerate(kids)}
    rows = [(f"kept_{k}_{i}", k, "HOT", "HOT", False, "RETENTION") for k, h in have.items() for i in range(h)]
    cands = [f"c{i:05d}" for i in range(7000)]
    rows += [(c, None, "HOT", "HOT", False, "RETENTION") for c in cands]
    links = [("HOT", k, "CAMPAIGN", "PRIVATE", True) for k in kids]
    out = fair_share(spark.createDataFrame(rows, ROUTED), spark.createDataFrame(links, SC.POOL_LINKS), RunConfig())
    got = {r["company_id"]: r["proposed_pool_id"] for r in out.collect() if r["company_id"].startswith("c")}
    import heapq
    heap = [(h, k) for k, h in have.items()]
    heapq.heapify(heap)
    want = {}
    for c in sorted(cands):  # each joins the least-loaded child at that moment
        h, k = heapq.heappop(heap)
        want[c] = k
        heapq.heappush(heap, (h + 1, k))
    assert got == want


def test_many_bands_and_even_loads(spark):
    """Loads that differ make bands; a child with a large load joins only the last one, or none."""
    rng = random.Random(3)
    rows, links, expected = [], [], {}
    for p in range(12):
        parent, have, cands = f"P{p:02d}", {}, []
        for j in range(rng.randint(1, 40)):
            kid = f"{parent}_{rng.randint(0, 999):03d}_{j}"
            have[kid] = rng.choice([0, 0, 1, 5, 9, 10, 11, 60])
            links.append((parent, kid, "STANDARD", "PRIVATE", True))
            rows += [(f"k_{kid}_{i}", kid, parent, parent, False, "RETENTION") for i in range(have[kid])]
            expected.update({f"k_{kid}_{i}": kid for i in range(have[kid])})
        for j in range(rng.choice([0, 1, 7, 200, 900])):
            cands.append(f"c_{parent}_{rng.randint(0, 10**7):08d}_{j}")
            rows.append((cands[-1], None, parent, parent, None, "RETENTION"))
        expected.update(brute_force(have, cands) if cands else {})
    out = fair_share(spark.createDataFrame(rows, ROUTED).repartition(9), spark.createDataFrame(links, SC.POOL_LINKS), RunConfig())
    assert {r["company_id"]: r["proposed_pool_id"] for r in out.collect()} == expected


def test_one_child_takes_any_number(spark):
    """One child and many candidates: two rows for the child's bands, none for its slots."""
    from pyspark.sql import functions as F

    from poolwright.operators.fair_share import bands, numbered_children

    loads = spark.createDataFrame([("P", "only", 3)], "fs_parent string, fs_child string, have_n long")
    filled = bands(loads, spark.createDataFrame([("P", 10_000_000)], "fs_parent string, need_n long"))
    assert [tuple(r) for r in filled.select("have_n", "band", "first", "kids").collect()] == [(3, 1, 1, 1)]
    assert [tuple(r) for r in numbered_children(loads, filled).collect()] == [("P", 1, 0, "only")]
    n = 300_000
    routed = spark.range(n).select(F.format_string("c%07d", "id").alias("company_id"), F.lit(None).cast("string").alias("current_pool_id"), F.lit("P").alias("proposed_pool_id"),
                                   F.lit("P").alias("parent_pool_id"), F.lit(False).alias("is_protected"), F.lit("RETENTION").alias("lead_tag"))
    links = spark.createDataFrame([("P", "only", "STANDARD", "PRIVATE", True), ("P", "other", "STANDARD", "PRIVATE", True)], SC.POOL_LINKS)
    got = fair_share(routed, links, RunConfig()).groupBy("proposed_pool_id").count().collect()
    assert {tuple(r) for r in got} == {("only", n // 2), ("other", n // 2)}


def test_interval_lookup(spark):
    from poolwright.operators.ranking import interval_lookup

    rng = random.Random(5)
    points = [(rng.choice("ab"), rng.randint(0, 500), k) for k in range(2000)]
    starts = [("a", s, f"a{s}") for s in (3, 4, 100, 499)] + [("b", 0, "b0")]
    got = interval_lookup(spark.createDataFrame(points, "g string, at long, id long").repartition(7), spark.createDataFrame(starts, "g string, at long, name string"), ["g"], "at", ["name"])
    want = {(g, at, k, max(((s, n) for h, s, n in starts if h == g and s <= at), default=(0, None))[1]) for g, at, k in points}
    assert {tuple(r) for r in got.collect()} == want
