"""Ranked text search on Spark: TF-IDF indexing, storage, search and cosine scoring."""

from termlode.operators import *  # noqa: F403
from termlode.operators import __all__ as _operators
from termlode.plans import *  # noqa: F403
from termlode.plans import __all__ as _plans
from termlode.sources import *  # noqa: F403
from termlode.sources import __all__ as _sources

__all__ = [*_sources, *_operators, *_plans]
