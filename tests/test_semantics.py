"""Hand-made rows for the rules of the job (one test per rule)."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from basketspark.config import RunConfig, date_window
from basketspark.errors import CoverageError, DataValidityError, InputNotValidError, OutputOutOfBoundError
from basketspark.functions.columns import account_no
from basketspark.operators import affinity, clicks, quality, recommend
from basketspark.plans import pipeline
from basketspark.sources.readers import Sources

HIT_SCHEMA = "visit_return_count bigint, post_visid_combined string, time_stamp timestamp_ntz, dt_key int, prod_list string, demandbase string"
VS_SCHEMA = "visit_return_count bigint, post_visid_combined string, visit_session_key bigint"
T0 = dt.datetime(2020, 1, 5)


def test_account_number(spark):
    rows = [(" A12 |x|y",), ("NOACCT",), ("|x",), ("  ab|c",), (None,)]
    got = [r[0] for r in spark.createDataFrame(rows, "d string").select(account_no("d")).collect()]
    assert got == ["A12", "", "", "ab", None]


def test_date_window():
    assert date_window("20010101", -2190) == (19950103, 20010101)
    assert date_window("2020-01-10", -1) == (20200109, 20200110)
    assert date_window("20200110", 3) == (20200110, 20200113)
    with pytest.raises(InputNotValidError):
        date_window("2020-13-01", -1)


def test_division_is_validated():
    with pytest.raises(InputNotValidError):
        RunConfig(start_date="20200101", division="XYZ")
    assert RunConfig.for_division("CCG", start_date="20200101").top_k is None


def test_hit_rules(spark):
    hits = spark.createDataFrame(
        [
            (0, "V1", T0, 20200105, "p1, P2 ,,", "A1|x"),  # kept: two products
            (0, "V1", T0, 20200105, "P3,shipping-handling", "A1|x"),  # raw marker: whole hit dropped
            (0, "V1", T0, 20200105, "P4,SHIPPING-HANDLING", "A1|x"),  # upper case: not the marker
            (0, "V2", T0, 20200105, "P5", "NOACCT"),  # no account
            (0, None, T0, 20200105, "P6", "A1|x"),  # no visitor
            (0, "V1", T0, 20200110, "P7", "A1|x"),  # at the exclusive end of the window
            (0, "V1", T0, 20200101, "P8", "A1|x"),  # first day of the window
            (1, "V9", T0, 20200105, "P9", "A1|x"),  # no session: null key
        ],
        HIT_SCHEMA,
    )
    sessions = spark.createDataFrame([(0, "V1", 10), (0, "V1", 11)], VS_SCHEMA)  # one visit, two sessions
    out = clicks.parse_hits(hits, sessions, (20200101, 20200110))
    got = sorted((r.session_key or -1, r.prod_id) for r in out.collect())
    expected = sorted(
        [(k, p) for k in (10, 11) for p in ("P1", "P2", "P4", "SHIPPING-HANDLING", "P8")] + [(-1, "P9")]
    )
    assert got == expected


def test_discontinued_match_is_case_sensitive(spark):
    c = spark.createDataFrame([("P1",), ("P2",)], "prod_id string")
    products = spark.createDataFrame([("p1", "D"), ("P2", "D"), ("P3", None)], "sku string, stk_type_cd string")
    assert sorted(r.prod_id for r in clicks.drop_discontinued(c, products).collect()) == ["P1"]


def test_group_map_and_keys(spark):
    pf = spark.createDataFrame(
        [("p1", "G1"), ("P1", "G1"), ("P1", "G2"), ("P2", "T"), ("P3", None), ("P9", "G0")], "sku_nbr string, size_grp string"
    )
    gmap = clicks.read_group_map(pf)
    assert sorted(tuple(r) for r in gmap.collect()) == [("P1", "G1"), ("P1", "G2"), ("P9", "G0")]
    c = spark.createDataFrame([("P1",), ("P2",)], "prod_id string")
    grouped = clicks.assign_groups(c, gmap)
    assert sorted(tuple(r) for r in grouped.select("prod_id", "coupon").collect()) == [("P1", "G1"), ("P1", "G2"), ("P2", "P2")]
    keys = {(r.prod_id, r.coupon): r.coupon_key for r in clicks.group_keys(gmap, grouped).collect()}
    # dense over all groups ordered by name, unviewed G0 included
    assert keys == {("P9", "G0"): 1, ("P1", "G1"): 2, ("P1", "G2"): 3, ("P2", "P2"): 4}


def test_session_filter_bounds(spark):
    rows = [(1, f"P{i}", f"G{i}") for i in range(31)]  # 31 groups: scraper
    rows += [(2, f"P{i}", f"G{i}") for i in range(30)]  # 30 groups: kept
    rows += [(3, "P1", "G1"), (3, "P2", "G1")]  # one group: dropped
    rows += [(4, "P1", "G1"), (4, "P1", "G2")]  # one SKU in two groups: dropped
    rows += [(None, "P1", "G1"), (None, "P2", "G2")]  # null session: never a basket
    df = spark.createDataFrame(rows, "session_key bigint, prod_id string, coupon string")
    kept = clicks.keep_sessions(clicks.session_stats(df))
    assert sorted(r.session_key or -1 for r in kept.collect()) == [-1, 2]
    assert sorted(set(r.basket_key for r in clicks.to_baskets(df, kept).collect())) == [2]


def _baskets(spark, sets):
    names = sorted({g for s in sets.values() for g in s})
    key = {g: i + 1 for i, g in enumerate(names)}
    rows = [(b, f"sku-{g}", g, key[g]) for b, s in sets.items() for g in s]
    return spark.createDataFrame(rows, "basket_key bigint, prod_id string, coupon string, coupon_key bigint")


@pytest.mark.parametrize("method", ["half", "join"])
def test_pair_matrix_by_hand(spark, method):
    b = _baskets(spark, {1: "AB", 2: "ABC", 3: "AC", 4: "B"})
    aff = affinity.pair_matrix(b, t=0, method=method)
    # counts A=3 B=3 C=2; 0th percentile = 2 -> keep counts > 2: A and B
    assert sorted((r.coupon, r.basket_count) for r in aff.frequent.collect()) == [("A", 3), ("B", 3)]
    rows = {(r.coupon_X, r.coupon_Y): r for r in aff.matrix.collect()}
    assert set(rows) == {("A", "B"), ("B", "A")}
    ab = rows[("A", "B")]
    assert (ab.basket_count_X, ab.basket_count_Y, ab.basket_count_XY) == (3, 3, 2)
    assert ab.confidence == 2 / 3
    assert ab.lift == 2 / 3 / 3 * 4
    assert ab.support == 0.5


def test_pair_matrix_edge_cases(spark):
    equal = _baskets(spark, {1: "AB", 2: "AB"})  # all counts equal: strict filter removes all
    assert affinity.pair_matrix(equal).matrix.count() == 0
    empty = equal.where("false")
    assert affinity.pair_matrix(empty).matrix.count() == 0


def test_pair_matrix_by_runs(spark):
    b = _baskets(spark, {1: "AB", 2: "ABC", 3: "AC", 4: "B"})
    both = b.withColumn("run", F.lit(0)).unionByName(b.withColumn("run", F.lit(1)))
    one = {(r.coupon_X, r.coupon_Y, r.confidence, r.lift) for r in affinity.pair_matrix(b, t=0).matrix.collect()}
    runs = affinity.pair_matrix(both, t=0, by=["run"]).matrix.collect()
    for run in (0, 1):
        assert {(r.coupon_X, r.coupon_Y, r.confidence, r.lift) for r in runs if r.run == run} == one


def test_rank_ties_are_kept(spark):
    rows = [("X", f"Y{i:02d}", 10.0 if i < 40 else 1.0) for i in range(45)]
    scored = spark.createDataFrame(rows, "sku_X string, sku_Y string, cvm_score double").withColumns(
        {"sku_basket_count_Y": F.lit(1).cast("bigint"), "sku_sales_Y": F.lit(Decimal("0.00"))}
    )
    ranked = recommend.rank_top_k(scored, 35)
    assert ranked.count() == 45  # rank 1 for the 40 ties, rank 2 for the rest
    lists = recommend.rec_lists(ranked).collect()
    assert len(lists) == 1 and lists[0].recs.split("|")[:2] == ["Y00", "Y01"] and lists[0].recs.endswith("Y44")


def test_pruned_top_k_equals_full_expansion(spark):
    # SKUs in several groups and many ties stress the pruning argument with a small k.
    import random

    rnd = random.Random(7)
    groups = list(range(1, 9))
    pairs = [
        (x, f"G{x}", y, f"G{y}", 10, 10, 3, rnd.choice([0.2, 0.3, 0.5]), 1.0, 0.1)
        for x in groups
        for y in groups
        if x != y
    ]
    matrix = spark.createDataFrame(pairs, ", ".join(f"{c} {t}" for c, t in zip(affinity.MATRIX_COLUMNS, ["bigint", "string", "bigint", "string", "bigint", "bigint", "bigint", "double", "double", "double"])))
    views = [(f"S{s}", g, rnd.choice([1, 2, 3])) for g in groups for s in rnd.sample(range(12), 4)]
    pv = spark.createDataFrame(views, "prod_id string, coupon_key bigint, sku_basket_count bigint").dropDuplicates(["prod_id", "coupon_key"])
    sales = spark.createDataFrame([(f"S{s}", Decimal(rnd.choice([0, 5, 9]))) for s in range(12)], "prod_id string, sales decimal(18,2)")
    for k in (1, 2, 3):
        full = recommend.rank_top_k(recommend.expand_to_skus(matrix, pv, sales), k)
        pruned = recommend.top_k_pruned(matrix, pv, sales, k)
        assert sorted(map(tuple, full.collect())) == sorted(map(tuple, pruned.select(*full.columns).collect()))


def _sources(spark, group_rows=True, sales_rows=True):
    hits = spark.createDataFrame(
        [(0, "V1", T0, 20200105, "P1,P2", "A|"), (0, "V2", T0, 20200105, "P1,P3", "A|")], HIT_SCHEMA
    )
    vs = spark.createDataFrame([(0, "V1", 1), (0, "V2", 2)], VS_SCHEMA)
    products = spark.createDataFrame([("P1", "S"), ("P2", "S")], "sku string, stk_type_cd string")
    pf = spark.createDataFrame([("P1", "G1")] if group_rows else [], "sku_nbr string, size_grp string")
    inv = spark.createDataFrame([("P1", Decimal("5.00"), 20200105)] if sales_rows else [], "sku string, amt decimal(18,2), dt_key int")
    return Sources(hits, vs, products, pf, inv)


def test_quality_errors(spark):
    cfg = RunConfig(start_date="20200110", period_days=-9, check_coverage=False)
    with pytest.raises(DataValidityError):
        pipeline.run(spark, _sources(spark, group_rows=False), cfg)
    with pytest.raises(OutputOutOfBoundError):
        pipeline.run(spark, _sources(spark, sales_rows=False), cfg)
    with pytest.raises(CoverageError):
        pipeline.run(spark, _sources(spark), RunConfig(start_date="20200110", period_days=-9))
    with pytest.raises(OutputOutOfBoundError):
        quality.check_confidence({"confidence_above_1": 2})
    bad = spark.createDataFrame([(1.5,), (-0.1,), (0.5,)], "confidence double")
    row = quality.confidence_report(bad).first()
    assert (row.pairs, row.confidence_above_1, row.confidence_below_0) == (3, 1, 1)


def test_hot_session_and_hot_group(spark):
    """One basket with a third of the rows and one group in most baskets: same answer as
    counting by hand (the plan spreads them; the result must not change)."""
    rows = []
    for i in range(300):  # hot basket 0: many clicks of the same 3 groups
        rows.append((0, f"S{i % 7}", "HOT" if i % 3 == 0 else f"G{i % 3}"))
    for b in range(1, 601):  # other baskets: the hot group plus one or two others
        rows.append((b, "S0", "HOT"))
        rows.append((b, f"S{b % 5}", f"G{b % 4}"))
        if b % 2:
            rows.append((b, f"S{b % 9}", f"G{(b + 1) % 4}"))
    names = sorted({r[2] for r in rows})
    key = {g: i + 1 for i, g in enumerate(names)}
    df = spark.createDataFrame(
        [(b, p, g, key[g]) for b, p, g in rows], "basket_key bigint, prod_id string, coupon string, coupon_key bigint"
    )
    sets = {}
    for b, _, g in rows:
        sets.setdefault(b, set()).add(g)
    n = len(sets)
    count = {g: sum(g in s for s in sets.values()) for g in names}
    import numpy as np

    thr = max(float(np.percentile(list(count.values()), 20)), 1.0)
    freq = {g for g in names if count[g] > thr}
    want = {}
    for s in sets.values():
        for x in s & freq:
            for y in s & freq:
                if x != y:
                    want[(x, y)] = want.get((x, y), 0) + 1
    for method in ("half", "join"):
        got = {(r.coupon_X, r.coupon_Y): (r.basket_count_XY, r.support) for r in affinity.pair_matrix(df, method=method).matrix.collect()}
        assert got == {k: (v, v / n) for k, v in want.items()}


def test_big_baskets_equal_the_self_join(spark):
    """Baskets of very different sizes go through one plan; counts equal the self-join form."""
    import random

    rnd = random.Random(5)
    groups = [f"G{i:03d}" for i in range(120)]
    sets = {b: set(rnd.sample(groups, rnd.choice((1, 3, 20, 110)))) for b in range(1, 60)}
    b = _baskets(spark, {k: sorted(v) for k, v in sets.items()})
    ref = {tuple(r) for r in affinity.pair_matrix(b, t=10, method="join").matrix.collect()}
    assert {tuple(r) for r in affinity.pair_matrix(b, t=10).matrix.collect()} == ref


def test_sales_are_summed_at_source_scale(spark):
    from basketspark.operators import sales

    rows = [("P1", Decimal("0.0040"), 20200105)] * 1000 + [("p1", Decimal("10.0050"), 20200105)] * 2
    invoices = spark.createDataFrame(rows, "sku string, amt decimal(18,4), dt_key int")
    got = sales.sku_sales(invoices, None, (20200101, 20200201), exclude_discontinued=False).collect()
    assert [(r.prod_id, r.sales) for r in got] == [("P1", Decimal("24.0100"))]


def test_sources_bind_by_name(spark):
    from basketspark.runtime import scratch_path

    root = scratch_path(spark, "sources")
    spark.createDataFrame(
        [("A|", "P1", 0, "V1", T0, 20200105)],
        "demandbase string, prod_list string, visit_return_count bigint, post_visid_combined string, "
        "event_at timestamp_ntz, event_day int",
    ).write.parquet(f"{root}/hits")
    spark.createDataFrame([("P1", Decimal("1.00"), 20200105)], "item string, net decimal(18,2), bill_day int").write.parquet(f"{root}/inv")
    other = {
        "visit_sessions": spark.createDataFrame([(0, "V1", 1)], VS_SCHEMA),
        "products": spark.createDataFrame([("P1", "S")], "sku string, stk_type_cd string"),
        "prod_feature": spark.createDataFrame([("P1", "G1")], "sku_nbr string, size_grp string"),
    }
    names = {"hits": {"event_at": "time_stamp", "event_day": "dt_key"}, "invoices": {"item": "sku", "net": "amt", "bill_day": "dt_key"}}
    src = Sources.from_refs(spark, {"hits": f"{root}/hits", "invoices": f"{root}/inv", **other}, names)
    assert {"time_stamp", "dt_key"} <= set(src.hits.columns)
    assert {"sku", "amt", "dt_key"} <= set(src.invoices.columns)
    with pytest.raises(ValueError):
        Sources.from_refs(spark, {"hits": other["products"], "invoices": f"{root}/inv", **other}, names)
