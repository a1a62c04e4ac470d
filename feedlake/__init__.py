"""Loading paged, append-only feeds into partitioned tables with Spark."""
