"""Staging, marts, serving queries, quality checks and the refresh job."""
