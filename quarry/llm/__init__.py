"""Operators of a training-data pipeline, one module each, over ``documents``,
``benchmark``, ``labels``, ``pages`` and ``embeddings``. Nothing else in the
library imports this subpackage."""
