"""Operators for training-data pipelines. Nothing else in the library imports this package.

Tasks of these operators import this package, so its folder is put on the path of Python workers, of the running session and
of later ones. On a cluster without a shared code folder it is shipped with ``--py-files`` as usual.
"""

import os

from pyspark import SparkContext

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
_PATH = os.environ.get("PYTHONPATH", "")
if _ROOT not in _PATH.split(os.pathsep):
    os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [_ROOT, _PATH]))
if SparkContext._active_spark_context is not None:
    SparkContext._active_spark_context.environment.setdefault("PYTHONPATH", _ROOT)
