"""Imports every module that registers queries."""

from quarry.plans import search_queries  # noqa: F401
from quarry.plans import chunk_queries  # noqa: F401
from quarry.plans import metadata_queries  # noqa: F401
from quarry.plans import source_queries  # noqa: F401
from quarry.plans import vector_queries  # noqa: F401
from quarry.plans import ranking_queries  # noqa: F401
from quarry.plans import index_queries  # noqa: F401
from quarry.plans import retrieval_queries  # noqa: F401
from quarry.plans import run_queries  # noqa: F401
from quarry.plans import batch_queries  # noqa: F401
