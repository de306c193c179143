"""Training-data operators: one module per operator, one registered query each.

Nothing outside this subpackage imports it.  ``queries.py`` binds the operators to
the test tables.
"""
