"""Macro-data harmonisation on Spark DataFrames.

The package is layered:

* ``functions``  column expressions (parsing, scaling, labels)
* ``operators``  DataFrame -> DataFrame building blocks with column names as arguments
* ``sources``    scans and sinks over landed files
* ``plans``      the outlook (WEO) and drawing-rights (SDR) pipelines built from the above
* ``streaming``  incremental ingest of newly landed files

Users normally start from ``macroloom.plans.outlook`` and ``macroloom.plans.reserves``.
"""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions of this package that run in tasks travel to the executors with their code, so that a
# session started from any folder works without installing the package on every machine.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
