"""End-user queries, the batch pipeline and the registered query catalogue."""
