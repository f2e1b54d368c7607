"""The composed run, its gate and its resumption; the streaming variant."""

import pytest
from conftest import SF
from pyspark.sql import functions as F

from loomline.plans import bindings, run
from loomline.sources.catalog import Source


def settings(**more):
    base = dict(
        budgets={"stage1": 20_000.0, "stage2": 8_000.0, "stage3": 9_000.0}, recipes={"stage1": bindings.STAGE1, "stage2": bindings.STAGE2},
        replay=0.2, exclusive=("src18",), longest=("src3",), hardest=("src5",), first_sources=("src3",),
    )
    return run.Settings(**(base | more))


def test_run_resumes_and_splits(spark, tmp_path):
    raw = {"documents": bindings.document_records(spark, SF)}
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    root = f"file://{tmp_path}"
    out = run.curate(spark, raw, [Source("conversations", "messages", "chat")], benchmark, root, settings())
    assert out["unique"].count() < out["clean"].count()
    for name in ("stage1", "stage2", "stage3"):
        rows = out[name]
        assert rows.groupBy("key").agg(F.countDistinct("side").alias("s")).filter("s > 1").isEmpty()
    kept = out["unique"].count()
    sources = [Source("conversations", "messages", "chat")]
    again = run.curate(spark, {"documents": raw["documents"].limit(0)}, sources, benchmark, root, settings())
    assert again["unique"].count() == kept, "what was written with these settings is taken"
    gates = run.finish(spark, again, sources, root, settings())
    assert gates.passed and gates.results["objects"] and set(gates.results) == {"decontamination", "clipped share", "domain shares", "licences", "objects"}
    assert (tmp_path / "CARD.md").read_text().startswith("# Curated corpus") and (tmp_path / "manifests/mixture.json").exists()
    with pytest.raises(ValueError):
        run.curate(spark, {"documents": raw["documents"].limit(0)}, sources, benchmark, root, settings(seed=7))


def test_gate_fails_on_empty_and_on_leaks(spark, tmp_path):
    from loomline.operators import decontam

    items = spark.createDataFrame([("one two three four five six seven eight nine",)], "text string")
    index = decontam.eval_index(items)
    leak = spark.createDataFrame([("a", "one two three four five six seven eight nine")], "id string, body string")
    for records in (leak, leak.limit(0)):
        with pytest.raises(ValueError, match="gate"):
            run.require_gate(spark, records, F.col("body"), index, f"file://{tmp_path}/g", 0.6)
    run.require_gate(spark, leak.withColumn("body", F.lit("other words")), F.col("body"), index, f"file://{tmp_path}/g", 0.6)
    assert settings().budget("stage1", {"LOOMLINE_STAGE1_TOKENS": "3e9"}) == 3_000_000_000


def test_stream_of_records(spark, tmp_path):
    from loomline.streaming.ingest import first_seen, record_stream

    schema = "idx long, problem string, out string, at timestamp"
    rows = spark.createDataFrame([(0, "q", "a"), (1, "q", "a"), (2, " ", "a"), (3, "q2", "b")], "idx long, problem string, out string").withColumn("at", F.timestamp_seconds(F.lit(1_700_000_000)))
    rows.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
    s = Source("s", "instruct", "math", columns={"instruction": "problem", "output": "out"})
    records = record_stream(stream, s).withColumn("at", F.timestamp_seconds(F.lit(1_700_000_000)))
    q = first_seen(records, "at").writeStream.format("memory").queryName("seen").outputMode("append").option("checkpointLocation", f"{tmp_path}/cp").start()
    try:
        q.processAllAvailable()
        assert spark.table("seen").count() == 2
    finally:
        q.stop()
