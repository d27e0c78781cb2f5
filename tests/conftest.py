import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

PSL_FILE = "/usr/share/publicsuffix/public_suffix_list.dat"
SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from weblex.session import build_session
    s = build_session("local[*]", shuffle_partitions=8, app_name="weblex-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def rules(spark):
    from weblex.sources.suffixes import builtin_rules
    return builtin_rules(spark)


def column(df, name):
    return [r[name] for r in df.collect()]
