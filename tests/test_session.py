"""The shared scratch folder and the removal of stages."""

import os

import pytest

from chartwright.plans import session as S


class _Context:
    master, applicationId = "spark://host:7077", "app-1"

    def getCheckpointDir(self):
        return None


class _Session:
    sparkContext = _Context()

    class conf:
        @staticmethod
        def get(key, default=None):
            return default


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(S.ScratchError):
        S.scratch_dir(_Session())


def test_the_named_folder_is_taken():
    class Named(_Session):
        class conf:
            @staticmethod
            def get(key, default=None):
                return "hdfs://shared/scratch" if key == "spark.checkpoint.dir" else default

    assert S.scratch_dir(Named()) == "hdfs://shared/scratch"


def test_stages_go_with_their_scope(spark):
    with S.stage_scope(spark):
        first = S.materialize(spark.range(3), "one")
        path = first.inputFiles()[0].removeprefix("file://").removeprefix("file:")
        assert os.path.exists(path)
        with pytest.raises(ValueError), S.stage_scope(spark):
            inner = S.materialize(spark.range(3), "two").inputFiles()[0].removeprefix("file://").removeprefix("file:")
            raise ValueError
        assert not os.path.exists(inner)
    assert not os.path.exists(os.path.dirname(path))


def test_the_daily_run_leaves_no_stage(spark, tmp_scratch, monkeypatch):
    import __spark_entry__ as E
    from chartwright.plans.daily import run_daily
    from conftest import SF_SMALL

    made = []
    keep = S.scratch_path
    job = E._job(spark, SF_SMALL)
    monkeypatch.setattr(S, "scratch_path", lambda s, name: made.append(keep(s, name)) or made[-1])
    assert run_daily(job, tmp_scratch("daily")).count() == 6
    assert made and not any(os.path.exists(p.removeprefix("file://").removeprefix("file:")) for p in made)
