"""Training-data operators (subpackage ``llm``).

One module per operator; ``queries.py`` registers the queries and their DuckDB
SQL.  Nothing else in the library imports this subpackage.
"""
