"""Training-data operators: ten Spark jobs over documents, pages and conversations.

Each module holds one operator with a general interface.  ``queries`` holds the
thin ``opN_*`` wrappers that derive digest columns from the operators' outputs.
Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
