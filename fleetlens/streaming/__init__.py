"""Streaming forms of the polling operators."""

from pyspark import cloudpickle

import fleetlens

# State machines travel to the executors by value, so the package need not be installed there.
cloudpickle.register_pickle_by_value(fleetlens)
