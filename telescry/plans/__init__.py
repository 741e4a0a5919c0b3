"""Jobs and the queries registered for the benchmark tables."""
