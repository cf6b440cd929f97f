"""quarry: document retrieval expressed as Spark DataFrame jobs.

Ingest (extract -> paragraphs -> token-bounded chunks -> metadata ->
embedding -> text vector -> partitioned table) and hybrid search (vector
pool under a JSON containment filter, re-scored by full-text rank) are
built from native column expressions, MLlib and Structured Streaming.
"""

__version__ = "0.1.0"
