"""Operators of a training-data pipeline. Nothing else in the library imports this subpackage.

Every operator picks the columns it needs by name, so other columns of a table, whatever they are
called, never clash with its own. Operators that give a report return only the columns they name;
operators that give documents back keep all columns they were given.
"""
