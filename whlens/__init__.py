"""whlens: warehouse workload profiling on Spark.

Reads landed (or JDBC-reachable) warehouse system tables as DataFrames and
computes the exports an analyst needs to size a workload: usage cost under
time-valid prices, events joined to warehouse versions, reassembled statement
text, per-column statistics, catalog inventories and normalised query logs.

Every operator is a plain function ``DataFrame -> DataFrame`` built from
Spark SQL / DataFrame built-ins, so Catalyst can push filters, prune columns
and pick join strategies; nothing is collected to the driver.
"""

from whlens.session import build_session, ensure_checkpoint_dir

__all__ = ["build_session", "ensure_checkpoint_dir"]
