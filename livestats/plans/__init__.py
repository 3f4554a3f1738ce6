"""Query plans: test-table adapters, the registered query catalogue, the jobs."""
