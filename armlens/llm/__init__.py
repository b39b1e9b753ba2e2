"""Training-data operators: thirteen corpus operators and their registered queries.

Nothing else in the library imports this subpackage; it imports only the
session helper (checkpoint folder) from the library.
"""
