"""Moving windows against the whole window, the daily store, the bracketed percentile and the
factorised output."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketspark.operators import incremental, recommend, significance
from basketspark.plans.catalog import _job
from basketspark.runtime import scratch_path

DAILY = "dt_key int, session_key long, prod_id string, coupon string"


def daily(spark):
    """Ten days; sessions over one or more of them, some too large or too small on some days."""
    rnd = random.Random(21)
    days, rows = list(range(20200101, 20200111)), set()
    for s in range(120):
        for d in rnd.sample(days, rnd.randint(1, 4)):
            rows |= {(d, s, f"P{rnd.randint(0, 40)}", f"G{rnd.randint(0, 12)}") for _ in range(rnd.randint(1, 5))}
    rows |= {(d, 500, f"Q{g}", f"G{g}") for d in days[:3] for g in range(d % 10, 13)} | {(days[5], 501, f"P{g}", f"H{g}") for g in range(40)}
    rows |= {(days[2], 501, "P1", "H1"), (days[2], 501, "P2", "H2")}
    return spark.createDataFrame(sorted(rows), DAILY)


def held(state):
    return [sorted(map(tuple, df.collect())) for df in (state.totals, state.groups, state.pairs)]


def test_moved_windows_equal_whole_ones(spark):
    rows = daily(spark)
    windows = [(20200101, 20200105), (20200102, 20200106), (20200103, 20200106), (20200103, 20200111), (20200101, 20200104), (20200108, 20200110), (20200108, 20200110)]
    state = incremental.build_state(rows, windows[0])
    for window in windows[1:]:
        state = incremental.move_state(state, rows, window)
        assert state.window == window and held(state) == held(incremental.build_state(rows, window))


def test_added_and_retired_days():
    change = incremental.changed_days
    assert change((1, 5), (2, 6)) == ([(5, 6)], [(1, 2)]) and change((1, 5), (1, 5)) == ([], [])
    assert change((1, 5), (7, 9)) == ([(7, 9)], [(1, 5)]) and change((3, 5), (1, 9)) == ([(1, 3), (5, 9)], [])


def test_empty_windows(spark):
    rows = daily(spark)
    state = incremental.build_state(rows, (20190101, 20190102))
    assert held(state) == [[(0,)], [], []] and incremental.state_matrix(state).count() == 0
    state = incremental.move_state(state, rows, (20200101, 20200105))
    assert held(state) == held(incremental.build_state(rows, (20200101, 20200105)))


def test_days_are_read_from_their_folders_only(spark, capsys):
    path = incremental.store_days(spark, daily(spark))
    some = incremental.read_days(spark, path, (20200103, 20200105))
    files = {f.split("dt_key=")[1].split("/")[0] for f in some.inputFiles()}
    assert some.count() == daily(spark).where("dt_key in (20200103, 20200104)").count()
    some.explain("formatted")
    plan = capsys.readouterr().out
    assert "PartitionFilters: [isnotnull(dt_key" in plan and "20200103" in plan and len(files) >= 2
    again = daily(spark).where("dt_key = 20200103").limit(1)
    incremental.write_days(again, path)  # the day is replaced, the others stay
    now = spark.read.parquet(path).groupBy("dt_key").count().collect()
    assert len(now) == 10 and {r["count"] for r in now if r.dt_key == 20200103} == {1}


@pytest.mark.parametrize("p", [0.0, 0.2, 0.5, 0.95, 0.999, 1.0])
def test_bracketed_percentile_is_exact(spark, p):
    rnd = np.random.default_rng(5)
    for values in (rnd.random(30_000), np.round(rnd.normal(0, 1, 5000), 1), np.array([2.0] * 4000 + [7.0, 9.0]), np.array([1.5]), np.arange(25_000) % 9 / 7):
        df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double").repartition(4)
        (row,) = significance.exact_percentile(df, "v", p).collect()
        assert row.value == pytest.approx(np.percentile(values, 100 * p), rel=1e-12)
    assert significance.exact_percentile(spark.createDataFrame([(None,)], "v double"), "v", p).first().value is None


def test_factorised_ranks_are_smaller_and_expand_to_all(spark, sf_small):
    job = _job(spark, sf_small, division="CCG")
    found = recommend.factorise(job.pairs, job.prod_views, job.sku_sales, None)
    every = job.unnumbered
    columns = every.columns
    assert sorted(map(tuple, found.expand().select(columns).collect())) == sorted(map(tuple, every.collect()))
    assert found.ranks.count() + found.members.count() < every.count() / 3
    sku = every.agg(F.max("sku_X")).first()[0]
    assert sorted(map(tuple, found.of_sku(sku).select(columns).collect())) == sorted(map(tuple, every.where(F.col("sku_X") == sku).collect()))
    few = recommend.factorise(job.pairs, job.prod_views, job.sku_sales, 3).expand().select(columns)
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, every.where("cvm_rank <= 3").collect()))
    path = scratch_path(spark, "factorised-test")
    recommend.write_factorised(found, path)
    assert recommend.read_factorised(spark, path).expand().count() == every.count()
