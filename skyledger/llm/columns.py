"""Column expressions and small frame helpers that the operators share.

A word is a run of characters other than ASCII white space; that is one fixed definition for every operator.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WHITE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """The words of a text as an array; null or blank text has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WHITE), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def fresh(frame: DataFrame, name: str) -> str:
    """A column name that the frame does not use yet, so that extra columns of the input never clash."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


def id_text(doc_id: Column) -> Column:
    """A document id as text; a null id is the empty text."""
    return F.coalesce(doc_id.cast("string"), F.lit(""))
