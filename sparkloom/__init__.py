"""sparkloom: a Spark-first engine that compiles auditable question/answer corpora.

Every operator takes and returns DataFrames; Catalyst plans the work.  Functions that
must run in Python workers are pickled by value, so executors need no copy of this
package on their path.
"""

import importlib
import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.2.0"
#: What a user needs, and where it is; loaded when first asked for.
API = {
    "Workspace": ("sparkloom.operators.doctor", "Workspace"), "load_workspace": ("sparkloom.sources.workspace", "load"), "scaffold_workspace": ("sparkloom.sources.workspace", "scaffold"),
    "generate_run": ("sparkloom.plans.compile", "generate"), "build_release": ("sparkloom.plans.release", "build"), "verify_release": ("sparkloom.plans.release", "verify"),
}
__all__ = [*API]


def __getattr__(name: str):
    if name not in API:
        raise AttributeError(f"module {__name__!r} has no attribute {name!r}")
    module, attribute = API[name]
    return getattr(importlib.import_module(module), attribute)
