"""Work folders live under the session's checkpoint folder."""

import os
import tempfile
from types import SimpleNamespace

import pytest

from windowlens.session import checkpoint_dir, work_path


def test_work_paths_follow_the_session_checkpoint_dir(spark):
    shared = tempfile.mkdtemp(prefix="windowlens-shared-")
    before = spark.sparkContext.getCheckpointDir()
    spark.sparkContext.setCheckpointDir(shared)
    try:
        current = checkpoint_dir(spark)
        assert os.path.realpath(current.replace("file:", "")).startswith(os.path.realpath(shared))
        a, b = work_path(spark, "x"), work_path(spark, "x")
        assert a != b and a.startswith(current + "/windowlens/")
    finally:
        if before:
            spark.sparkContext.setCheckpointDir(before)


@pytest.mark.parametrize("master,setting,ok", [("yarn", None, False), ("local-cluster[2,1,1024]", None, False),
                                               ("spark://host:7077", "file:///shared", True)])
def test_a_cluster_must_name_its_shared_folder(master, setting, ok):
    conf = SimpleNamespace(get=lambda key, default=None: setting or default)
    sc = SimpleNamespace(master=master, getCheckpointDir=lambda: None, getConf=lambda: conf,
                         setCheckpointDir=lambda path: None)
    session = SimpleNamespace(sparkContext=sc)
    if ok:
        assert checkpoint_dir(session) == setting
    else:
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            checkpoint_dir(session)
