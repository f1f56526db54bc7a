"""Training-data operators: token files, sharding, mixing, filtering, near-duplicate and exact deduplication.

Nothing outside this package (and ``corpus_pipeline.py``) imports it.  Every
operator is a function on DataFrames with its own parameters; the registered
queries in :mod:`lakemart.llm.queries` are thin wrappers that derive the
digest columns of the query contract from the operator's real output.
"""
