"""Operators for preparing training corpora.

The functions that run in Python tasks travel with the task itself, so executors need
this package neither installed nor on their path.
"""

import ticketloom
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(ticketloom)
