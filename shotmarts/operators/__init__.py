"""Reusable dataset operators: joins, bounded-task windows, ranks."""
