import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from logwarden.session import get_spark

    ckpt = str(tmp_path_factory.mktemp("ckpt"))
    s = get_spark(master="local[*]", shuffle_partitions=8,
                  extra={"spark.checkpoint.dir": ckpt})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def mixed(spark):
    """A fixture shaped like the reference's mixed log: 80 auth, 60 syslog, 85 apache lines."""
    from fixture_lines import mixed_lines

    return mixed_lines(spark)


def have_testdata() -> bool:
    return os.path.exists(f"{SMOKE}/events.parquet")
