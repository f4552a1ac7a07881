"""Incident analytics as Spark jobs: text preparation, density clustering, scoring and model governance."""

import sys

from pyspark import cloudpickle

# Task functions travel with their code, so executors need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
