"""Training-data pipeline operators: ten corpus operators, each in a module
of its own, plus the queries that apply them to the driver tables.

Nothing else in the library imports this subpackage.
"""
