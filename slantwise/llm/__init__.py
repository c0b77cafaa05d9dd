"""Operators for training data. Nothing outside this folder imports it.

The kernels run inside Python workers; they travel with the job, so executors
need no copy of this package.
"""

from pyspark import cloudpickle

from slantwise.llm import bwt, conversations, kernels, lattice, pairs, simhash, suffixes, tokencount, windows

for _module in (conversations, kernels, pairs, suffixes, tokencount, windows, bwt, simhash, lattice):
    cloudpickle.register_pickle_by_value(_module)
