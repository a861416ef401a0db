"""Joins, rankings and intermediates give the plain answer, lazily and in balanced pieces."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from fixtures import rows
from shopmill.operators import scale as S
from shopmill.operators.windows import rank_in_group


@pytest.fixture(scope="module")
def sides(spark):
    left = [(i, 7 if i % 3 == 0 else (None if i % 10 == 0 else i % 40)) for i in range(600)]
    right = [(100 + i, 9 if i % 3 == 0 else (None if i % 7 == 0 else i % 50 + 5)) for i in range(300)]
    return (
        spark.createDataFrame(left, "a long, k long"),
        spark.createDataFrame(right, "b long, k long"),
    )


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_skew_join_equals_join(sides, how):
    left, right = sides
    assert rows(S.skew_join(left, right, "k", how)) == rows(left.join(right, "k", how))


def test_skew_join_with_unique_side(sides):
    left, right = sides
    one = right.filter("k IS NOT NULL").groupBy("k").agg(F.max("b").alias("b"))
    assert rows(S.skew_join(left, one, "k", "left", "right")) == rows(left.join(one, "k", "left"))


def test_a_left_join_deals_out_hot_keys_and_reads_its_left_side_once(spark, tmp_path, monkeypatch):
    """Half of the right rows have one key; the join meets them in many parts, and scans the left side once."""
    left, right = str(tmp_path / "left"), str(tmp_path / "right")
    spark.range(200).selectExpr("id AS k", "id AS a").write.parquet(left)
    many = spark.range(4000).selectExpr("CASE WHEN id % 2 = 0 THEN 7 WHEN id % 50 = 1 THEN NULL ELSE id % 90 END AS k", "id AS b")
    many.write.parquet(right)
    one, two = spark.read.parquet(left), spark.read.parquet(right)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = S.skew_join(one, two, "k", "left")
        assert rows(joined) == rows(one.join(two, "k", "left"))
        plan = joined._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("LeftOuter") == 1 and "__salt" in plan
        scans = [s for s in joined._jdf.queryExecution().executedPlan().toString().splitlines() if f"{left}" in s and "Scan" in s]
        assert len(scans) <= 2  # the final and the initial plan of adaptive execution name it once each
        assert two.select(S.hot_keys(two, "k").alias("hot")).first()["hot"][0] == 7
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    dealt = two.filter("k = 7").select((F.pmod(F.xxhash64("k", "b"), F.lit(S.SALTS))).alias("s")).distinct()
    assert dealt.count() == S.SALTS


@pytest.mark.parametrize("case", ["no right rows", "no left rows", "one key", "nulls", "repeated rows", "columns that clash"])
def test_left_join_of_odd_sides(spark, case):
    left = [(i % 7 if i % 5 else None, i) for i in range(60)]
    right = [(3, i) for i in range(300)] + [(i % 11, i) for i in range(50)] + [(None, 1)] * 20
    left = [] if case == "no left rows" else [(3, i) for i in range(9)] if case == "one key" else left
    right = [] if case == "no right rows" else [(None, 1)] * 9 if case == "nulls" else right
    right = [(3, 1)] * 500 if case == "repeated rows" else right
    one, two = spark.createDataFrame(left, "k long, a long"), spark.createDataFrame(right, "k long, b long")
    if case == "columns that clash":
        one, two = one.withColumn("top", F.lit(1)), two.withColumn("n", F.lit(2)).withColumn("hot", F.lit(3))
    assert rows(S.skew_join(one, two, "k", "left")) == rows(one.join(two, "k", "left"))


def test_building_a_join_runs_no_job(spark, sides):
    left, right = sides
    before = spark.sparkContext.statusTracker().getJobIdsForGroup()
    S.skew_join(left, right, "k", "left")
    rank_in_group(left, ["k"], "a", 3)
    assert spark.sparkContext.statusTracker().getJobIdsForGroup() == before


SCORES = {
    "distinct": [(i, float(i)) for i in range(200)],
    "one third tied": [(i, 5.0 if i % 3 else float(i)) for i in range(300)],
    "all tied": [(i, 1.0) for i in range(100)],
    "all null": [(i, None) for i in range(50)],
    "null third": [(i, None if i % 3 == 0 else float(i % 4)) for i in range(300)],
    "empty": [],
}


@pytest.mark.parametrize("case", SCORES)
@pytest.mark.parametrize("ranges", [2, 70, 1024])
def test_global_rank_equals_rank(spark, case, ranges):
    df = spark.createDataFrame(SCORES[case], "id long, score double").repartition(3)
    plain = F.rank().over(Window.orderBy(F.desc_nulls_last("score"))).cast("long")
    got = S.global_rank(df, "score", "rank", ranges)
    assert rows(got) == rows(df.withColumn("rank", plain))


def test_global_rank_of_text(frame):
    df = frame([("b",), ("a",), (None,), ("b",)], "s string")
    assert rows(S.global_rank(df, "s")) == [("a", 3), ("b", 1), ("b", 1), (None, 4)]


def test_global_rank_moves_the_ranked_rows_once(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).selectExpr("id", "id % 97 AS score", "uuid() AS wide").write.parquet(path)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = S.global_rank(spark.read.parquet(path), "score")._jdf.queryExecution().executedPlan()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = plan.toString().splitlines()
    moves = [i for i, line in enumerate(lines) if "Exchange" in line]
    assert sum("wide" in lines[i + 1] for i in moves) == 1


@pytest.mark.parametrize("case", ["one third tied", "null third", "empty"])
def test_rank_in_group_equals_rank(spark, case):
    df = spark.createDataFrame(SCORES[case], "id long, score double")
    df = df.withColumn("g", F.when(F.col("id") % 5 > 0, F.col("id") % 2))
    window = Window.partitionBy("g").orderBy(F.desc_nulls_last("score"))
    want = df.withColumn("rank", F.rank().over(window)).filter("rank <= 3")
    assert rows(rank_in_group(df, ["g"], "score", 3)) == rows(want)


def test_a_global_rank_runs_what_lies_behind_it_once(spark):
    reads = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            reads.add(len(batch))
            yield batch

    df = spark.range(500).withColumnRenamed("id", "score").mapInPandas(seen, "score long")
    assert S.global_rank(df, "score").count() == 500
    assert reads.value == 500


def test_durable_cuts_lineage(spark):
    df = S.durable(spark.range(10).withColumn("x", F.col("id") * 2))
    assert df.count() == 10
    assert "Range" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_intermediates_are_removed(spark, tmp_path, monkeypatch):
    root = tmp_path / "shared"
    monkeypatch.setattr(S, "checkpoint_root", lambda spark: str(root))
    with S.kept(spark) as keep:
        assert keep(spark.range(3)).count() == 3
    assert not list(root.rglob("*.parquet"))
    S.durable(spark.range(3))
    assert list(root.rglob("*.parquet"))
    S.release(spark)
    assert not list(root.rglob("*.parquet"))


def test_settings_follow_the_bytes():
    from shopmill.session import settings

    assert settings(10, 8)["spark.sql.shuffle.partitions"] == "8"
    small, big = (int(settings(n * 1024**4, 4000)["spark.sql.shuffle.partitions"]) for n in (10, 100))
    assert big == 10 * small  # no ceiling: 128 MB a partition at any size
    assert settings(100 * 1024**4, 4000)["spark.sql.files.maxPartitionBytes"] == str(512 * 1024**2)
