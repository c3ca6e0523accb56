"""Training-data operators: dedup, mixing, PII, licences, search, scoring, decontamination.

Functions that run inside Spark tasks are pickled by value, so executors need this
package on no path of their own.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
