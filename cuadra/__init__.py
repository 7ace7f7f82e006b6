"""Table and time-series analytics as plain functions over Spark DataFrames."""

import sys

from pyspark import cloudpickle

from cuadra.session import build_session, scratch_path, written_once

# Functions that run in tasks travel with their code, so the workers need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["build_session", "scratch_path", "written_once"]
