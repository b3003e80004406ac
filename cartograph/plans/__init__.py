"""End-to-end batch jobs and the registered query catalogue."""
