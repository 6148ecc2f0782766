from stallwise.session import durable
from stallwise.sources import sinks


def test_steps_and_layers_use_the_dense_codec(spark, tmp_path):
    rows = spark.range(10)
    for stored in (durable(rows), sinks.overwrite(rows, f"{tmp_path}/t")):
        assert stored.inputFiles() and all(".zstd." in name for name in stored.inputFiles())
