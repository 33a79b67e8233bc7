"""Operators for preparing language-model training data.

Nothing else in the library imports this package; ``__spark_entry__.py`` adds
its queries when it is present.  Every operator takes a DataFrame and column
names, reads only the columns it names (so extra or clashing columns of the
input never matter) and documents what nulls, empty texts, ties, repeated rows
and empty tables give.
"""
