from fieldbook import session


def test_checkpoint_dir_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir")
    assert session.checkpoint_dir(spark) == configured
    df = session.materialize(spark.range(5), "t")
    assert df.count() == 5
    assert df.inputFiles()[0].startswith("file:" + configured) or configured in df.inputFiles()[0]


def test_defaults_do_not_override_session_values(spark):
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    try:
        session.ensure_defaults(spark)
        assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "false"
    finally:
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
