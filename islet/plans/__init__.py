"""Plans: the log's view DAG and the query catalogue over the driver tables."""
