"""Text functions: lower-case and the word split of the word-count program."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The word separator is a run of non-word characters, where a word
# character is [a-zA-Z_0-9] (Java's and RE2's ASCII \W class).
WORD_SEPARATOR = r"\W+"


def java_pieces(pieces: Column) -> Column:
    """The pieces of a split by the rules of Java's ``String.split``: a leading empty piece is kept, a
    trailing one is dropped, and an empty text is one empty piece."""
    n, last = F.size(pieces), F.element_at(pieces, -1)
    return F.when((n == 1) | (last != ""), pieces) \
        .when((n == 2) & (F.get(pieces, F.lit(0)) == ""), F.array().cast("array<string>")) \
        .otherwise(F.slice(pieces, F.lit(1), n - 1))


def java_split_words(text: Column | str) -> Column:
    """Lower-case ``text`` and split it on runs of non-word characters, with the rules of
    :func:`java_pieces`.

    ``""`` -> ``['']``; ``"!!!"`` -> ``[]``; ``" Hi, x! "`` -> ``['', 'hi', 'x']``.
    A null text gives null (no words).
    """
    return java_pieces(F.split(F.lower(F.col(text) if isinstance(text, str) else text), WORD_SEPARATOR))


def upper_all(arr: Column | str) -> Column:
    """Upper-case every element of an array of strings."""
    c = F.col(arr) if isinstance(arr, str) else arr
    return F.transform(c, lambda x: F.upper(x))
