"""Training-data operators: one module per operator, queries in ``queries``.

Nothing outside this subpackage imports it; the registered queries are added by
``__spark_entry__`` when the subpackage is present.
"""
