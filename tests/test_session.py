"""Scratch data goes below the checkpoint folder the session names."""

import re

from moodlake.session import checkpoint_dir, materialize


def local(p):
    return re.sub(r"^file:/+", "/", p)


def test_checkpoint_dir_is_the_configured_one(spark):
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert configured and local(checkpoint_dir(spark)).startswith(local(configured))


def test_materialize_writes_below_the_checkpoint_dir(spark):
    df = materialize(spark.range(10), "t")
    files = df.inputFiles()
    root = local(checkpoint_dir(spark))
    assert files and all(local(f).startswith(root) for f in files)
    assert df.count() == 10
