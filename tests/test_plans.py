"""Physical plans: what is pushed down, combined early, split and never done."""

import pytest
from pyspark.sql import functions as F

from annoloom.operators import assemble, facts, sampling
from annoloom.plans import adapters as A
from annoloom.plans.registry import QUERIES


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def no_broadcast(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {k: spark.conf.get(k) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_no_nested_loops_and_no_python_rows(spark, no_broadcast, key):
    text = plan(QUERIES[key](spark, "/root/testdata/sf0.001"))
    for bad in ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython",
                "Scan ExistingRDD"):
        assert bad not in text


def test_rank_filters_run_before_the_shuffle(spark, sf_dir):
    for df in (assemble.cap_positives(A.relevance(spark, sf_dir), 3),
               assemble.cap_positives(A.relevance(spark, sf_dir), 5000),
               facts.latest_response(A.calibration_responses(spark, sf_dir), ["record_id", "user_id"])):
        assert "WindowGroupLimit" in plan(df) and "Partial" in plan(df)


def test_samples_rank_ids_without_texts(spark, sf_dir, no_broadcast):
    """Each text column goes through one exchange, that of the join by the chosen ids."""
    drawn = sampling.calibration_sample(A.records(spark, sf_dir), A.benchmarks(spark, sf_dir), 1001)
    text = plan(drawn)
    ranked = text[text.index("Window"):]
    assert "Window" in text and "source_text" not in ranked and "target_text" not in ranked


def test_reopen_has_no_or_in_its_joins(spark, sf_dir, no_broadcast):
    for key in ("reopen_preview", "reopen_applied"):
        joins = [line for line in plan(QUERIES[key](spark, sf_dir)).splitlines()
                 if "LeftSemi" in line or "LeftAnti" in line]
        assert joins and not any(" OR " in line for line in joins)


def test_roll_ups_read_no_texts(spark, sf_dir):
    text = plan(QUERIES["benchmark_progress"](spark, sf_dir))
    assert "text:string" not in text
    text = plan(QUERIES["annotator_progress"](spark, sf_dir))
    assert "text:string" not in text


def test_narrow_facts_shuffle_digests_not_texts(spark, sf_dir, no_broadcast):
    narrow = facts.annotation_facts(
        A.records(spark, sf_dir),
        A.responses(spark, sf_dir, False).withColumn("corrected_text", F.col("comment")),
        A.users(spark, sf_dir), texts=False)
    text = plan(narrow)
    assert "_target_digest" in text
    above_scan = text[:text.index("FileScan parquet [doc_id")] if "FileScan parquet [doc_id" in text else text
    exchange = above_scan.rsplit("Exchange hashpartitioning", 1)[-1]
    assert "md5" in exchange                        # computed below the record side's exchange


def test_status_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "records")
    spark.createDataFrame([("a", "pending"), ("b", "completed")], "record_id string, status string") \
        .write.parquet(path)
    records = spark.read.parquet(path)
    text = plan(records.filter(F.col("status").isin("completed", "discarded")).select("record_id"))
    assert "PushedFilters: [In(status, [completed,discarded])]" in text


def test_a_hot_record_is_split(spark, no_broadcast, tmp_path):
    """A third of all responses on one record: adaptive execution splits its partition."""
    n = 60_000
    base = spark.range(n).select(
        F.concat(F.lit("r"), F.col("id").cast("string")).alias("response_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("rec"), (F.col("id") % 5000).cast("string")))
        .alias("record_id"),
        F.lit("u").alias("user_id"), F.lit("submitted").alias("status"), F.lit("1 – x").alias("quality_score"),
        F.array(F.lit("Pravopis")).alias("error_categories"), F.repeat(F.col("id").cast("string"), F.lit(20))
        .alias("corrected_text"), F.lit(None).cast("string").alias("comment"),
        F.lit(None).cast("timestamp").alias("updated_at"), F.col("id").alias("seq"))
    base.repartition(16).write.parquet(str(tmp_path / "responses"))
    names = spark.range(5000).select(F.concat(F.lit("rec"), F.col("id").cast("string")).alias("record_id"))
    names.unionByName(spark.range(1).select(F.lit("hot").alias("record_id"))).select(
        "record_id", F.lit("b").alias("benchmark"), F.lit("query").alias("record_type"), F.lit("t").alias("task_id"),
        F.lit("s").alias("source_text"), F.lit("x").alias("target_text"), F.lit("completed").alias("status")) \
        .write.parquet(str(tmp_path / "records"))
    users = spark.createDataFrame([("u", "ana")], "user_id string, username string")
    settings = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        df = facts.annotation_facts(spark.read.parquet(str(tmp_path / "records")),
                                    spark.read.parquet(str(tmp_path / "responses")), users)
        wide = df.select("response_id", "annotator", "correction", "target_text", "flagged")
        assert len(wide.collect()) == n
        assert "skew=true" in plan(wide)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
