"""Global order, prefix sums, cuts and rolling windows against plain Python."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from riskweave.functions.columns import epoch_seconds
from riskweave.operators import rolling, sampling
from riskweave.operators.ordered import exact_quantiles, hash_cuts, order_cuts, prefix_sums, with_global_index, with_group_index

PARTITIONS = [1, 4, 16]


@pytest.fixture(scope="module")
def data(spark):
    """A third of the rows belong to one key, and a third share one value."""
    rng = random.Random(5)
    rows = [(i, "hot" if i % 3 == 0 else f"k{rng.randrange(20)}", 7.0 if i % 3 == 1 else float(rng.randrange(50)), rng.randrange(2)) for i in range(1200)]
    rng.shuffle(rows)
    return rows, spark.createDataFrame(rows, "id long, k string, v double, y int").repartition(7)


@pytest.mark.parametrize("n", PARTITIONS)
def test_global_index(data, n):
    rows, df = data
    got = {r["id"]: r["idx"] for r in with_global_index(df, ["v", "id"], partitions=n).collect()}
    assert got == {r[0]: i for i, r in enumerate(sorted(rows, key=lambda r: (r[2], r[0])))}


def test_global_index_descending(data):
    rows, df = data
    got = {r["id"]: r["idx"] for r in with_global_index(df, [F.col("v").desc(), "id"], partitions=5).collect()}
    assert got == {r[0]: i for i, r in enumerate(sorted(rows, key=lambda r: (-r[2], r[0])))}


@pytest.mark.parametrize("n", PARTITIONS)
def test_group_index(data, n):
    rows, df = data
    got = {r["id"]: r["idx"] for r in with_group_index(df, ["k"], ["id"], partitions=n).collect()}
    for key in {r[1] for r in rows}:
        ids = sorted(r[0] for r in rows if r[1] == key)
        assert [got[i] for i in ids] == list(range(len(ids)))


@pytest.mark.parametrize("n", PARTITIONS)
def test_prefix_sums(data, n):
    rows, df = data
    out = prefix_sums(df, ["k"], "v", {"n": F.count("*"), "y": F.sum("y")}, n).collect()
    assert sum(r["n"] for r in out) == len(rows)
    for r in out:
        group = [x for x in rows if x[1] == r["k"]]
        assert r["n_before"] == sum(x[2] < r["v"] for x in group)
        assert r["y_before"] == sum(x[3] for x in group if x[2] < r["v"])
        assert r["n_total"] == len(group) and r["y_total"] == sum(x[3] for x in group)


def test_prefix_sums_keep_null_groups(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0), ("a", 1.0)], "k string, v double")
    out = {(r["k"], r["v"]): (r["n_before"], r["n_total"]) for r in prefix_sums(df, ["k"], "v", {"n": F.count("*")}, 3).collect()}
    assert out == {(None, 1.0): (0, 2), (None, 2.0): (1, 2), ("a", 1.0): (0, 1)}


@pytest.mark.parametrize("n", PARTITIONS)
def test_exact_quantiles(data, n):
    rows, df = data
    out = {r["k"]: r["med"] for r in exact_quantiles(df, ["k"], "v", {"med": 0.5}, n).collect()}
    for key, med in out.items():
        assert med == pytest.approx(statistics.median(x[2] for x in rows if x[1] == key))


def test_order_cuts(data):
    rows, df = data
    ranked = sorted((r[2], r[0]) for r in rows)
    assert order_cuts(df, ["v", "id"], [0, 1, 600, 1200], 5) == [None, ranked[0], ranked[599], ranked[-1]]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_positional_split_in_any_time_zone(spark, kind):
    """Hours around a clock change, cut in the middle."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.range(48).select("id", F.timestamp_seconds(F.lit(1_730_505_600) + F.col("id") * 1800).cast(kind).alias("ts"))
        ranked = [r["id"] for r in df.orderBy("ts", "id").collect()]
        side = {r["id"]: r["side"] for r in rolling.positional_split(df, ["ts", "id"], 0.5, partitions=3).collect()}
        assert [side[i] for i in ranked] == ["ref"] * 24 + ["cur"] * 24
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_epoch_seconds_ignores_the_session_zone(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-07-01 12:00:00.75' AS ts")
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert df.select(epoch_seconds("ts")).first()[0] == 1_719_835_200
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_hash_cuts_select_exact_counts(data):
    rows, df = data
    cuts = hash_cuts(df, ["k"], ["id"], 1, lambda n: F.array(F.lit(0).cast("long"), F.floor(n / 2), n))
    sizes = {k: sum(r[1] == k for r in rows) for k in {r[1] for r in rows}}
    marked = df.join(cuts, "k").withColumn("h", F.md5(F.concat_ws("|", F.col("id").cast("string"), F.lit("1"))))
    for r in marked.groupBy("k").agg(*[F.count_if(F.col("h") <= F.col("cuts")[i]).alias(f"c{i}") for i in range(3)]).collect():
        assert (r["c0"], r["c1"], r["c2"]) == (0, sizes[r["k"]] // 2, sizes[r["k"]])


def expected_frames(rows, keyed):
    ordered = sorted(rows, key=lambda r: (r[1] if keyed else "", r[2], r[0]))
    seen, out = {}, {}
    for r in ordered:
        past = seen.setdefault(r[1] if keyed else "", [])
        past.append(r[2])
        frame = past[-5:]
        out[r[0]] = (len(past[-3:]), sum(frame) / len(frame), max(frame))
    return out


@pytest.mark.parametrize("part, hot", [([], 10), (["k"], 10_000), (["k"], 100), (["k"], 1)])
def test_rolling_paths_agree(data, part, hot):
    """Plain windows, hot-key blocks and the un-keyed frame give the same numbers."""
    rows, df = data
    frames = {"c": ("count", "v", 2), "m": ("avg", "v", 4), "x": ("max", "v", 4)}
    out = rolling.rolling(df, part, ["v", "id"], frames, hot_rows=hot, block_rows=37, partitions=5).collect()
    want = expected_frames(rows, bool(part))
    assert len(out) == len(rows)
    for r in out:
        c, m, x = want[r["id"]]
        assert (r["c"], r["x"]) == (c, x) and r["m"] == pytest.approx(m)


def test_rolling_null_hot_key(spark):
    df = spark.createDataFrame([(i, None if i < 40 else "a", float(i)) for i in range(60)], "id long, k string, v double")
    out = {r["id"]: r["c"] for r in rolling.rolling(df, ["k"], ["id"], {"c": ("count", "v", 9)}, hot_rows=30, block_rows=12).collect()}
    assert [out[i] for i in (0, 5, 39, 40, 59)] == [1, 6, 10, 1, 10]


def test_block_smaller_than_frame_is_widened(data):
    rows, df = data
    out = rolling.rolling_global(df, ["v", "id"], 4, {"m": ("avg", "v")}, block_rows=1, partitions=3)
    want = expected_frames(rows, False)
    assert all(r["m"] == pytest.approx(want[r["id"]][1]) for r in out.collect())


def test_moving_average_waits_for_full_frame(data):
    _, df = data
    out = rolling.moving_avg_full(df, ["id"], "v", 10, block_rows=50).orderBy("id").collect()
    assert all(r["moving_avg"] is None for r in out[:9]) and all(r["moving_avg"] is not None for r in out[9:])


def test_folds_are_disjoint_and_balanced(data):
    rows, df = data
    out = sampling.kfold(df, "y", "id", 5).groupBy("y", "fold").count().collect()
    sizes = {}
    for r in out:
        sizes.setdefault(r["y"], []).append(r["count"])
    assert all(len(s) == 5 and max(s) - min(s) <= 1 for s in sizes.values())
    assert sum(map(sum, sizes.values())) == len(rows)


def test_sample_sizes(data):
    _, df = data
    assert sampling.sample_n(df, 100, "id").count() == 100
    assert sampling.sample_n(df, 10_000, "id").count() == 1200
    assert sampling.sample_n(df.limit(0), 10, "id").count() == 0
    a = {r["id"] for r in sampling.sample_n(df, 100, "id").collect()}
    assert a == {r["id"] for r in sampling.sample_n(df.repartition(3), 100, "id").collect()}
    assert a != {r["id"] for r in sampling.sample_n(df, 100, "id", seed=1).collect()}


def test_batches(data):
    _, df = data
    sizes = {r["batch_id"]: r["count"] for r in sampling.batch_ids(df, 5, 300, "id").groupBy("batch_id").count().collect()}
    assert sizes == {0: 300, 1: 300, 2: 300, 3: 300}
