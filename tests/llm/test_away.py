"""The training-text queries and the pipeline on workers that cannot import the package."""

import __spark_entry__
from sparkloom.plans import registry
from tests.test_away import run_away


def test_queries_run_without_the_package(tmp_path):
    own = set(__spark_entry__.queries()) - set(registry.QUERIES)
    found = run_away(tmp_path, *own)
    assert set(found) == own and {n: x for n, x in found.items() if x != "ok"} == {}
