"""Joins with heavy keys: the plain join's rows, and a bounded number of them in each task."""

import random

import pytest
from pyspark.sql import functions as F

from annoloom.operators import agreement, facts, heavy, maintain, quality

TASKS = 8


@pytest.fixture()
def plain_shuffles(spark):
    """No adaptive execution and no broadcast by size: a task gets what the query itself deals to it."""
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.shuffle.partitions": str(TASKS)}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def most_rows(df):
    return max(r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect())


def hot_rows(spark, n=24_000):
    """A third of the rows on one key, a sixth on the null key."""
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 6 != 1, (F.col("id") % 997).cast("string"))
    return spark.range(n).select(F.col("id").alias("row"), key.alias("k"))


def names(spark):
    known = spark.range(900).select(F.col("id").cast("string").alias("k"), (F.col("id") * 2).alias("v"))
    return known.unionByName(spark.range(1).select(F.lit("hot").alias("k"), F.lit(-1).cast("long").alias("v")))


@pytest.mark.parametrize("how", heavy.HOWS)
def test_same_rows_as_the_plain_join(spark, how):
    left, right = hot_rows(spark), names(spark)
    found = heavy.spread_join(left, right, ["k"], how)
    plain = left.join(right, ["k"], how)
    assert found.columns == plain.columns
    assert sorted(map(tuple, found.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_a_heavy_key_is_dealt_over_tasks(spark, plain_shuffles, how):
    left, right = hot_rows(spark), names(spark)
    fair = left.count() / TASKS
    assert most_rows(left.join(right, ["k"], how)) > 2.5 * fair
    assert most_rows(heavy.spread_join(left, right, ["k"], how)) < 2 * fair


def test_repeated_other_rows_and_several_keys(spark):
    draw = random.Random(6)
    rows = [(i, "hot" if draw.random() < .4 else f"k{draw.randint(0, 30)}", draw.choice([1, 2, None])) for i in range(3000)]
    left = spark.createDataFrame(rows, "row long, a string, b int")
    right = spark.createDataFrame([(f"k{i}", i % 3, i) for i in range(30)] + [("hot", 1, 70), ("hot", 1, 71), ("hot", None, 72)],
                                  "a string, b int, v long")
    for how in heavy.HOWS:
        got, want = heavy.spread_join(left, right, ["a", "b"], how), left.join(right, ["a", "b"], how)
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_only_heavy_keys_get_cells(spark):
    cells = {r["_key"]: r["_cells"] for r in heavy.heavy_keys(hot_rows(spark), ["k"]).collect()}
    assert sorted(cells.values()) == [3, 6]             # of 16: a sixth and a third
    assert heavy.heavy_keys(hot_rows(spark).limit(0), ["k"]).count() == 0
    assert heavy.heavy_keys(spark.range(100), ["id"]).count() == 0


def test_maps_and_clashing_columns(spark):
    left = spark.range(100).select((F.col("id") % 2).alias("k"), F.create_map(F.lit("a"), "id").alias("m"))
    right = spark.createDataFrame([(0, 5)], "k long, cells int")
    assert heavy.spread_join(left, right, ["k"]).count() == 50
    with pytest.raises(ValueError):
        heavy.spread_join(left, right, ["k"], "full")


# ---- the operators that use it: a third of the rows on one key, no adaptive execution ----

@pytest.fixture()
def no_small_sides(monkeypatch):
    monkeypatch.setattr(heavy, "BROADCAST_BYTES", -1)


N = 24_000


def hot(name, others):
    return F.when(F.col("id") % 3 == 0, name).otherwise(F.concat(F.lit(name[0]), (F.col("id") % others).cast("string")))


def answers(spark):
    return spark.range(N).select(
        F.concat(F.lit("r"), F.col("id").cast("string")).alias("response_id"), hot("hot", 900).alias("record_id"),
        hot("busy", 500).alias("user_id"), F.lit("submitted").alias("status"), F.lit("3").alias("quality_score"), F.col("id").alias("seq"))


def people(spark):
    known = spark.range(500).select(F.concat(F.lit("b"), F.col("id").cast("string")).alias("user_id"), F.col("id").cast("string").alias("username"))
    return known.unionByName(spark.createDataFrame([("busy", "ana")], known.schema))


def test_a_busy_user(spark, plain_shuffles, no_small_sides):
    found = facts.resolve_annotators(answers(spark), people(spark))
    assert found.filter("annotator = 'ana'").count() == N / 3
    assert most_rows(found) < 2 * N / TASKS


def test_a_small_user_table_is_measured_and_broadcast(spark):
    found = facts.resolve_annotators(answers(spark), people(spark))
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and found.filter("annotator = 'ana'").count() == N / 3
    assert heavy.measured_bytes(people(spark)) == sum(32 + len(r.user_id) + len(r.username) for r in people(spark).collect())
    assert heavy.measured_bytes(people(spark).limit(0)) == 0


def test_a_record_with_very_many_raters(spark, plain_shuffles):
    rated = spark.range(N).select(hot("hot", 900).alias("record_id"), F.col("id").cast("string").alias("annotator"),
                                  F.lit(3).alias("score"), F.array(F.lit("x")).alias("labels"))
    found = agreement.co_rated(rated)
    assert found.count() == N and most_rows(found) < 2 * N / TASKS


def test_a_text_with_very_many_copies(spark, plain_shuffles):
    records = spark.range(N).select(F.col("id").cast("string").alias("record_id"), F.lit("b").alias("benchmark"),
                                    hot("hot text", 900).alias("source_text"), F.lit("x").alias("target_text"))
    found = quality.duplicate_members(records)
    assert found.count() == N and most_rows(found) < 2 * N / TASKS


@pytest.mark.parametrize("reopened", [maintain.reopen_preview, maintain.reopen_applied])
def test_a_hot_record_is_reopened_or_kept(spark, plain_shuffles, no_small_sides, reopened):
    preview = reopened is maintain.reopen_preview
    record = "hot" if preview else "h1"
    targets = spark.createDataFrame([(record, None), ("h2", "ana"), ("h2", "5")], "record_id string, annotator string")
    found = reopened(answers(spark), people(spark), targets)
    names = {"b5": "5", "busy": "ana"}
    gone = [r for r in answers(spark).collect() if r.record_id == record or (r.record_id == "h2" and names.get(r.user_id) in ("ana", "5"))]
    assert found.count() == (len(gone) if preview else N - len(gone))
    assert most_rows(found) < 2 * N / TASKS
