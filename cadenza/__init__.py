"""cadenza: recommendation analytics on interaction logs, written as Spark jobs.

Every public operator takes and returns DataFrames and is built from Spark SQL
expressions (joins, aggregates, windows, range partitioning). What reaches the
driver is bounded whatever the input: single scalars, 65,536 counts in the exact
sample, 63 cut points in the exact AUC.

Sub-packages:

* ``sources``   - readers / writers and the mapping from the shared test tables
* ``functions`` - column expressions (compression, decay, labels, fallback)
* ``operators`` - the relational operators (clean, split, counts, ranking, ...)
* ``plans``     - compositions of operators end to end, and the registered queries
"""

from cadenza.session import build_session, ensure_checkpoint_dir

__all__ = ["build_session", "ensure_checkpoint_dir"]
