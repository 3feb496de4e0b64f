"""loanweave — a Spark-native mart for versioned loan-portfolio snapshots.

Snapshot rows carry JSON text payloads; the mart keeps the latest visible
version of each loan, unpacks payload arrays into typed child tables, adds
SHA-256 surrogate keys and writes dated parquet.  Everything is expressed
with DataFrame operators so Catalyst can prune, push down and codegen.
"""

__version__ = "0.1.0"
