"""SQL for an independent engine: what each registered query must return.

Written from the meaning of each result, in direct form (every shot joined to both team rows,
games read once per side, plain windows), not from the shape of the Spark plans.
"""
