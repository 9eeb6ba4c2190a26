"""Intermediates: shared folder, rows written and read, removal."""

import os

import pytest

from cropledger.session import WorkFolder, shared_folder


class Cluster:
    """The two things shared_folder asks of a session."""

    class sparkContext:
        master = "local-cluster[3,2,3000]"

    class conf:
        @staticmethod
        def get(key, default=None):
            return default


def test_no_shared_folder_is_an_error_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Cluster)


def test_keep_and_drop(spark):
    work = WorkFolder(spark)
    kept = work.keep("numbers", spark.range(10))
    assert kept.count() == 10
    work.drop("numbers")
    assert not os.path.exists(f"{work.path}/numbers")
    work.keep("more", spark.range(0))
    work.drop()
    assert not os.path.exists(work.path)
