import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from chartwright.plans.session import local_session, scratch_dir

    s = local_session(8, shuffle_partitions=8)
    scratch_dir(s)  # uses spark.checkpoint.dir, or makes one when unset
    yield s


@pytest.fixture()
def tmp_scratch(spark):
    from chartwright.plans.session import scratch_path

    return lambda name: scratch_path(spark, name)
