"""Operators for building language-model training data.

Ten operators, one module each, plus the queries that apply them (``registry``). Nothing
else in the library imports this subpackage.
"""
