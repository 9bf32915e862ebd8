"""Training-data operators: ten methods over documents, pages and benchmark texts.

Nothing else in the library imports this subpackage; ``queries.QUERIES`` and
``oracle.ORACLE_SQL`` hold its registered queries.
"""
