"""issuewatch: a PySpark engine for community issue monitoring (see README)."""

import sys as _sys

# Python UDFs defined in this package (DTW kernel, HTML unescape, encoder stand-in) are
# pickled by value, so executors run them without the package being installed or on
# their path.
try:
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001 - older cloudpickle: fall back to by-reference pickling
    pass
