"""Session helpers: the shared checkpoint folder is read from the session; scale
settings are only filled in where a session leaves them unset."""

from tidemill.session import cut_lineage, ensure_checkpoint_dir, scratch_path, tune_for_scale


def test_checkpoint_dir_is_taken_from_the_session(spark):
    d = ensure_checkpoint_dir(spark)
    assert d and spark.sparkContext.getCheckpointDir() is not None
    assert scratch_path(spark, "x").startswith(d)
    df = cut_lineage(spark.range(10))
    assert df.count() == 10


def test_tune_for_scale_keeps_explicit_settings(spark):
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    try:
        tune_for_scale(spark)
        assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "false"
        assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    finally:
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
