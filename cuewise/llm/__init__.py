"""Training-data operators: the ten operators of this list, their queries and their SQL.

Nothing outside this subpackage imports it.
"""
