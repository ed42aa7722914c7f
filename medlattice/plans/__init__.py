"""Registered queries. Importing this package fills ``REGISTRY``."""

from medlattice.plans import (cohort_queries, graph_queries, metric_queries, model_queries,  # noqa: F401
                              phenotype_queries, scale_queries, sequence_queries, wide_queries)
from medlattice.plans.registry import REGISTRY, QuerySpec

__all__ = ["REGISTRY", "QuerySpec"]
