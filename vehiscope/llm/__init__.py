"""Training-data operators: one module per operator, `catalog` registers them.

Nothing else in the library imports this subpackage.
"""
