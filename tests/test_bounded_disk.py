"""What the job's queries deal and keep on disk stays in proportion to their input."""

import os
import re
import time
from collections import Counter
from itertools import combinations

from pyspark.sql import functions as F

from basketspark.operators import affinity, incremental, significance
from basketspark.plans.catalog import _job, q_frequent_groups, q_group_basket_counts
from basketspark.runtime import exists, materialize, recorded_scratch, settings


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def left_of(spark, written):
    """The names of the frames that are still there."""
    return {os.path.basename(path).rsplit("-", 1)[0] for path in written if exists(spark, path)}


def _overlapping(spark):
    """200 groups in 60 baskets: some baskets hold most groups, others few; two rows come twice."""
    made = [(b, f"G{g}", g) for b in range(1, 61) for g in range(200) if (g * 7 + b * b) % (2 + g % 5 + 9 * (b % 3)) == 0]
    return spark.createDataFrame(made + made[:2] + [(None, "G1", 1), (3, None, None)], "basket_key long, coupon string, coupon_key long")


def test_groups_are_sent_to_few_parts_however_many_blocks_they_make(spark, monkeypatch):
    rows = _overlapping(spark)
    want = affinity.pair_matrix(rows, method="join").matrix
    monkeypatch.setattr(affinity, "DENSE_GROUPS", 4)
    monkeypatch.setattr(affinity, "_DENSE_BASKETS", 7)  # a group's baskets are sent in several pieces
    monkeypatch.setattr(affinity, "_DENSE_SENT", 50)
    matrix = affinity.pair_matrix(rows, method="dense").matrix
    copies = [int(n) + 1 for n in re.findall(r"sequence\(0, (\d+)", matrix._jdf.queryExecution().analyzed().toString())]
    assert copies and max(copies) <= 24  # some 50 blocks of 4 groups
    assert bag(matrix) == bag(want) != Counter()
    assert bag(affinity.confident_pairs_pushed(rows, 0.5, small_groups=2)) == bag(want.where("confidence >= 0.5"))


def test_more_rows_make_more_parts(spark, monkeypatch):
    rows = _overlapping(spark)
    want = affinity.pair_matrix(rows, method="join").matrix
    monkeypatch.setattr(affinity, "DENSE_GROUPS", 64)
    monkeypatch.setattr(affinity, "_DENSE_ROWS", 100)
    monkeypatch.setattr(affinity, "_DENSE_MET", 30)
    matrix = affinity.pair_matrix(rows, method="dense").matrix
    copies = [int(n) + 1 for n in re.findall(r"sequence\(0, (\d+)", matrix._jdf.queryExecution().analyzed().toString())]
    assert copies and max(copies) > 10
    assert bag(matrix) == bag(want) != Counter()


def test_shuffle_files_go_once_a_frame_is_written(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()

    def files():
        return {f for d in folders for r, _, fs in os.walk(d) for f in fs if f.startswith("shuffle_") and f.endswith(".data")}

    before = files()
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        frame = materialize(spark.range(2000).groupBy((F.col("id") % 500).alias("k")).count(), "shuffled")
    assert frame.count() == 500
    materialize(spark.range(1), "next")  # events of the first write may have kept it until here
    for _ in range(40):  # the cleaner works beside the driver
        if not files() - before:
            break
        time.sleep(0.25)
    assert not files() - before


def test_the_clicks_go_once_the_baskets_are_held(spark, sf_small):
    job = _job(spark, sf_small)
    with recorded_scratch() as written:
        held = job.held
    assert left_of(spark, written) == {"baskets", "viewed", "group-keys"}
    assert held.baskets.count() and held.viewed.count() and held.keys.count()


def test_groups_are_counted_without_the_wide_baskets(spark, sf_small):
    with recorded_scratch() as written:
        counts, frequent = q_group_basket_counts(spark, sf_small), q_frequent_groups(spark, sf_small)
    wide = [p for p in written if exists(spark, p) and "time_stamp" in spark.read.parquet(p).columns]
    assert not wide
    assert bag(counts) == bag(affinity.pair_matrix(_job(spark, sf_small).baskets).counts)
    assert bag(frequent) == bag(affinity.pair_matrix(_job(spark, sf_small).baskets).frequent)


def test_the_self_join_works_its_rows_out_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def looked(v):
        seen.add(1)
        return v

    rows = _overlapping(spark).withColumn("coupon", F.udf(looked, "string")("coupon"))
    n = rows.where("basket_key is not null and coupon_key is not null").count()
    seen.value = 0
    assert bag(affinity.pair_matrix(rows, method="join").matrix) == bag(affinity.pair_matrix(_overlapping(spark), pin=False).matrix)
    assert seen.value <= n + 2


def test_permutations_leave_no_numbered_rows(spark):
    made = [(b, f"p{(b * i) % 11}", (b * i) % 11 % 7, i % 3 + 1) for b in range(1, 40) for i in range(1, 5)]
    items = spark.createDataFrame(made, "basket_key long, prod_id string, coupon_key long, n long").groupBy("basket_key", "prod_id", "coupon_key").agg(F.sum("n").alias("n"))
    names = items.select("coupon_key", F.concat(F.lit("G"), "coupon_key").alias("coupon")).distinct()
    rows = items.join(names, ["coupon_key"]).select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n")))).drop("n", "col")
    with recorded_scratch() as written:
        got = bag(significance.permutation_null(items, names, perm_times=3))
    assert left_of(spark, written) == {"permuted-blocks", "group-counts"}
    # Each permutation by itself, on the basket order and on the order of its hashes.
    each = [significance.permute_baskets(rows, 42 + p, 1).withColumn("perm_id", F.lit(p)) for p in range(3)]
    want = affinity.pair_matrix(each[0].unionByName(each[1]).unionByName(each[2]), by=["perm_id"]).matrix
    assert got == bag(want) != Counter()


def test_a_window_keeps_its_state_only(spark):
    """Sessions of up to 90 groups, which make several blocks; two with too many or too few."""
    made = [(20200101 + s % 3, s, f"p{g}", f"G{g:03d}") for s in range(1, 9) for g in range(0, 90, s)]
    made += [(20200101, 20, f"p{g}", f"G{g:03d}") for g in range(120)] + [(20200102, 21, "p1", "G001"), (20200102, 21, "p2", "G001"), (20200102, 22, "p1", "G001"), (20200102, 22, "p1", "G002")]
    made += [(20200103, 3, "p7", "G007")]  # a session of two days
    daily = spark.createDataFrame(made, "dt_key int, session_key long, prod_id string, coupon string")
    first, second = (20200101, 20200103), (20200102, 20200104)
    with recorded_scratch() as written:
        state = incremental.build_state(daily, first, 100)
        moved = incremental.move_state(state, daily, second, 100)
    assert left_of(spark, written) == {"window-total", "window-groups", "window-pairs"}
    for (lo, hi), got in ((first, state), (second, moved)):
        sessions = {}
        for day, session, sku, group in made:
            if lo <= day < hi:
                sessions.setdefault(session, set()).add((sku, group))
        groups = [sorted({g for _, g in rows}) for rows in sessions.values() if len({k for k, _ in rows}) > 1]
        groups = [g for g in groups if 2 <= len(g) <= 100]
        assert got.totals.first()["n"] == len(groups)
        assert {r.coupon: r.n for r in got.groups.collect()} == Counter(x for g in groups for x in g)
        assert {(r.coupon_X, r.coupon_Y): r.n for r in got.pairs.collect()} == Counter(p for g in groups for p in combinations(g, 2))
