import os

import pytest

import setgraph
from setgraph.session import checkpoint_dir, configure, in_session, partitioned_checkpoint, static_session


def test_checkpoint_dir_is_set_and_stable(spark):
    d = checkpoint_dir(spark)
    assert d and checkpoint_dir(spark) == d
    conf = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if conf:  # a configured shared folder is used, not a private one
        assert conf.rstrip("/").split("/")[-1] in d


def test_configure_turns_off_estimate_broadcast(spark):
    configure(spark)
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == "-1"
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"


def test_static_session_leaves_the_shared_one_alone(spark):
    own = static_session(spark)
    assert own.conf.get("spark.sql.adaptive.enabled") == "false" and spark.conf.get("spark.sql.adaptive.enabled") == "true"
    df = in_session(spark.range(5), own)
    assert df.sparkSession.conf.get("spark.sql.adaptive.enabled") == "false" and df.count() == 5
    with pytest.raises(ValueError, match="static"):
        partitioned_checkpoint(spark.range(5))


def test_no_local_scratch_folder():
    for folder, _, names in os.walk(os.path.dirname(setgraph.__file__)):
        for name in names:
            if name.endswith(".py"):
                with open(os.path.join(folder, name)) as f:
                    assert "tempfile" not in f.read(), name
