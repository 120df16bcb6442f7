"""TC001: session acquisition and the shared checkpoint folder."""

from ledgerlens.session import checkpoint_dir, get_spark_session


def test_active_session_is_reused(spark):
    assert get_spark_session() is spark
    # Library code never stops the session it was handed.
    assert spark.range(1).count() == 1


def test_checkpoint_dir_comes_from_the_session(spark):
    folder = checkpoint_dir(spark)
    assert folder is not None and "checkpoints" in folder
    df = spark.range(10).checkpoint()
    assert df.count() == 10


def test_scale_conf_for_100_tb():
    from ledgerlens.session import MAX_SHUFFLE_BLOCKS, scale_conf

    def sized(conf, input_bytes):
        split = int(conf["spark.sql.files.maxPartitionBytes"][:-1]) * 1024**2
        return -(-input_bytes // split), int(conf["spark.sql.shuffle.partitions"])

    for tib in (1, 10, 100, 1000):
        conf = scale_conf(tib * 1024**4, total_cores=8000)
        maps, reducers = sized(conf, tib * 1024**4)
        assert maps * reducers <= MAX_SHUFFLE_BLOCKS and reducers >= 16_000 * (tib < 1000)
        assert conf["spark.sql.adaptive.advisoryPartitionSizeInBytes"] == "256m"
    maps, reducers = sized(scale_conf(1024**4, total_cores=500), 1024**4)
    assert maps == reducers == 4096  # 1 TiB / 256 MiB
    assert sized(scale_conf(1024**4, total_cores=500, shuffle_bytes=1024**4 // 2), 1024**4)[1] == 2048
    small = scale_conf(10 * 1024**2, total_cores=8)
    assert int(small["spark.sql.shuffle.partitions"]) == 16
