"""medlattice: patient-cohort analytics on Spark DataFrames.

Every operator takes DataFrames and returns DataFrames; the heavy lifting
is left to Catalyst (joins, aggregates, windows) so that plans scale out
with the cluster.
"""

from medlattice.session import ensure_checkpoint_dir, get_spark

__all__ = ["get_spark", "ensure_checkpoint_dir"]
