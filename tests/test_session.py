"""Session helpers: checkpoint folder from the session, reliable lineage cuts."""

from skyhealth.session import checkpoint_dir, cut_lineage, scratch_path


def test_checkpoint_dir_comes_from_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    d = checkpoint_dir(spark)
    if configured:
        assert d == configured
    assert spark.sparkContext.getCheckpointDir() is not None
    assert scratch_path(spark, "x").startswith(d.rstrip("/"))


def test_cut_lineage_is_reliable_checkpoint(spark):
    df = spark.range(10).selectExpr("id", "id * 2 AS v")
    cut = cut_lineage(df)
    assert sorted(r.v for r in cut.collect()) == [2 * i for i in range(10)]
    plan = cut._jdf.queryExecution().logical().toString()
    assert "LogicalRDD" in plan and "Range" not in plan
