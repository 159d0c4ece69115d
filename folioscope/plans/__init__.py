"""Whole jobs, and the registry of queries that exercises every operator."""
