"""Every query on workers that cannot import the package."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
TABLES = "/root/testdata/sf0.001"


def run_away(folder, *names: str) -> dict[str, str]:
    """What each query says when it runs from ``folder``, without PYTHONPATH."""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, f"{ROOT}/tests/away.py", ROOT, TABLES, *names], cwd=folder, env=env, capture_output=True, text=True)
    found = dict(line.split(" ", 1) for line in done.stdout.splitlines() if " " in line)
    assert done.returncode == 0, done.stderr[-2000:]
    return found


def test_queries_run_without_the_package(tmp_path):
    import __spark_entry__
    from sparkloom.plans import registry

    own = set(registry.QUERIES)
    found = run_away(tmp_path, *("-" + n for n in set(__spark_entry__.queries()) - own))
    assert set(found) == own and {n: x for n, x in found.items() if x != "ok"} == {}
