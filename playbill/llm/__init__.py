"""Operators of a training-data pipeline over a table of documents.

Each module holds one operator with a general interface; ``queries`` registers
one thin query per operator, and ``oracle`` the SQL of those that SQL can express.
"""
