"""Operators for training corpora: near copies, decontamination, fingerprints, encoding, selection and scans."""

import sys

from pyspark import cloudpickle

# Task code travels with the task, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
