"""lorespan: the data work behind retrieval question answering, as Spark DataFrame jobs.

Sub-packages
------------
``functions``  column expressions (text, vectors, JSON payloads)
``operators``  DataFrame -> DataFrame steps (chunk, embed, k-NN join, answer, tuning data, evaluation)
``sources``    tables, index storage, version log, request payloads
``streaming``  chat events answered per micro-batch
``plans``      the registered queries and the SQL they are checked against
"""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with their tasks, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
