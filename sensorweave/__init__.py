"""Sensor telemetry on PySpark: ingest, clean, calibrate, derive, check and store readings.

Functions of this package that run in Python workers are pickled with their code, so
that executors need no copy of it and no particular working folder.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
