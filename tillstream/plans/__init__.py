"""Models built from the operators: staging, marts and serving queries."""
