"""Operators of a training-data pipeline over documents, pages and benchmark items.

Each module holds one operator with a general interface; ``queries`` binds them to the tables of a data folder.
"""
