"""gridscale: gridded escape-count products as Spark jobs.

``sources`` makes schedules and grids, ``functions`` holds column functions, ``operators`` the
jobs over them (compute, store, materialise, compare, render, metrics), ``streaming`` fills a
run from a stream of requests, and ``plans`` applies it all to a folder of ordinary tables.
"""

import sys

from pyspark import cloudpickle

# Task functions travel by value, so executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
