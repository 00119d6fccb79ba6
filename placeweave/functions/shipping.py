"""How functions that run in Python workers get there."""

from __future__ import annotations

import sys

from pyspark import cloudpickle


def ship_by_value(module: str) -> None:
    """Send the module's functions inside the plan, so that executors need
    NumPy, pandas and Arrow but not this package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])
