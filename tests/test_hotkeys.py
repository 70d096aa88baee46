from pyspark.sql import functions as F

from commgraph.operators.hotkeys import heavy_keys, key_counts, key_profile


def test_hot_null_and_empty(spark):
    rows = [("hot", "a", 1)] * 500 + [("hot", None, 2)] * 3 + [(None, "z", 1)] * 20 + [("cold", "a", 1), ("cold", "b", None)]
    df = spark.createDataFrame(rows, "speaker string, topic string, n_rows int")
    got = {r["speaker"]: r.asDict() for r in key_profile(df, "speaker", ["topic", "n_rows"], {"s": F.sum("n_rows")}).withColumnRenamed("n_n_rows", "d").collect()}
    assert got["hot"]["n_rows"] == 503 and got["hot"]["n_topic"] == 1 and got["hot"]["d"] == 2 and got["hot"]["s"] == 506
    assert got["cold"]["n_topic"] == 2 and set(got) == {"hot", "cold"}
    c = key_counts(df, "speaker").withColumn("relation", F.lit("x"))
    assert [r["speaker"] for r in heavy_keys(c, "speaker", "relation", "n_rows", 0.03).collect()] == ["hot"]
    assert key_profile(df.limit(0), "speaker", ["topic"]).collect() == []


def test_only_partial_states_are_shuffled(spark):
    df = spark.range(1000).select((F.col("id") % 3).cast("string").alias("speaker"), F.lit("t").alias("topic"))
    plan = key_profile(df, "speaker", ["topic"])._jdf.queryExecution().executedPlan().toString()
    for line in plan.split("Exchange hashpartitioning")[1:]:
        assert "HashAggregate" in line.split("Exchange")[0]
