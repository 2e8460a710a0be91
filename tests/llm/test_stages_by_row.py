"""Stages judge rows, not ids."""

import corpus_pipeline


def test_benchmark_stage_judges_rows(spark, tmp_path):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = [(5, "clean words"), (5, f"x {item} y"), (None, "also clean"), (None, item), (6, "ok"), (7, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'e' as row_key", "1 as hits")
    kept = corpus_pipeline.benchmark(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns
    assert {(r["doc_id"], r["text"]) for r in kept.collect()} == {(5, "clean words"), (None, "also clean"), (6, "ok"), (7, None)}
