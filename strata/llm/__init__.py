"""Training-data operators: dedup, token counts, scoring, mixing, sharding.

Every operator takes and returns DataFrames, works on whole tables and whole
texts, and keeps intermediate tables in the shared folder of the session
(:class:`strata.llm.scratch.Scratch`).  ``registry.QUERIES`` holds one thin
query per operator; nothing outside this subpackage imports it.
"""

from pyspark import cloudpickle

# Functions for Python workers travel with the job, so executors need no copy of this package.
import strata.llm as _self

cloudpickle.register_pickle_by_value(_self)
