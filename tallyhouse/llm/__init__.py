"""Operators for preparing text corpora as language-model training data.

Each module holds one operator; `queries` registers them over the `documents` table.
Nothing else in the library imports this package.
"""
