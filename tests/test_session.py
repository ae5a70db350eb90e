"""The folder for intermediate data: shared where there is a cluster."""

import os

import pytest

from tidepool import session


def test_private_folder_only_for_local_sessions():
    assert os.path.isdir(session._private_folder("local[2]"))
    for master in ("spark://host:7077", "yarn", "k8s://https://host", ""):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            session._private_folder(master)


def test_configured_folder_is_kept(spark):
    folder = session.checkpoint_dir(spark)
    assert folder and session.checkpoint_dir(spark) == folder
