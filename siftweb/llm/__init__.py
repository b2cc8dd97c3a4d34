"""Training-data operators: ten DataFrame operators and their queries.

Nothing outside this folder imports it; ``queries.py`` holds the registered
queries and their SQL.
"""
