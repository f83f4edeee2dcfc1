"""Training-data operators: one module per operator, plus their queries.

Nothing outside this subpackage imports it; ``__spark_entry__`` adds the queries only
where the subpackage exists.
"""
