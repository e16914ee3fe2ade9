"""Operators for preparing training text: one module per operator, plus their queries.

Nothing outside this subpackage imports it. Functions that run inside Spark
tasks travel by value, so executors need no copy of the package.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
