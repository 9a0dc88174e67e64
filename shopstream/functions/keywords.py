"""Word splitting."""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Callable, Iterable

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Workers get these functions by value: they need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Up to so many words a pattern tries them one by one; the list itself may have so many at most.
FEW_WORDS, MOST_WORDS = 200, 5_000_000

# Everything that is neither a letter nor a digit separates words.
SEPARATORS = r"[^\p{L}\p{N}]+"


def words(text: Column) -> Column:
    """Lower-cased words of a text, as an array."""
    return F.filter(F.split(F.lower(text), SEPARATORS), lambda w: w != "")


def load_words(lines: Iterable[str]) -> list[str]:
    """Words of a user list whose lines hold ``word freq tag``."""
    return [line.split()[0] for line in lines if line.strip()]


def dictionary_pattern(dictionary: Iterable[str]) -> str:
    """Pattern that matches the longest listed word, else a Latin word or
    number, else one character of any other script."""
    listed = sorted(set(dictionary), key=lambda w: (-len(w), w))
    quoted = "".join(re.escape(w) + "|" for w in listed)
    return rf"({quoted}[A-Za-z0-9]+|[\p{{L}}\p{{N}}])"


def longest_match(dictionary: Iterable[str]) -> Callable[[str], list[str]]:
    """The split of :func:`dictionary_pattern` by tables of words.

    Words are in one set, and the first character says which lengths are worth
    probing, longest first; so a position costs the lengths of the words that
    begin like it, however long the list is.
    """
    known = {w for w in dictionary if w}
    lengths: dict[str, set[int]] = {}
    for w in known:
        lengths.setdefault(w[0], set()).add(len(w))
    probes = {c: sorted(ns, reverse=True) for c, ns in lengths.items()}
    run = re.compile("[A-Za-z0-9]+").match

    def split(text: str) -> list[str]:
        found, at = [], 0
        while at < len(text):
            first = text[at]
            for n in probes.get(first, ()):
                word = text[at:at + n]
                if word in known:
                    break
            else:
                latin = run(text, at)
                word = latin.group() if latin else first if unicodedata.category(first)[0] in "LN" else ""
            if word:
                found.append(word)
            at += len(word) or 1
        return found

    return split


def dictionary_words(text: Column, dictionary: Iterable[str]) -> Column:
    """Split text without blanks by a word list, longest word first.

    The list is a bounded user setting, of ``MOST_WORDS`` at most. A short one
    becomes a pattern and runs on the JVM; a long one goes to the executors
    once, as tables, and texts to Python in Arrow batches. Both give the same.
    """
    listed = sorted(set(dictionary))
    if len(listed) > MOST_WORDS:
        raise ValueError(f"a word list of over {MOST_WORDS} words")
    if len(listed) <= FEW_WORDS:
        return F.regexp_extract_all(text, F.lit(dictionary_pattern(listed)), F.lit(1))
    shipped = SparkSession.active().sparkContext.broadcast(listed)
    made: list[Callable[[str], list[str]]] = []

    @F.pandas_udf("array<string>")
    def split(texts: pd.Series) -> pd.Series:
        if not made:
            made.append(longest_match(shipped.value))
        return texts.map(lambda t: None if t is None else made[0](t))

    return split(text)


def register(spark: SparkSession) -> None:
    """Table function for SQL, all on the JVM: ``LATERAL split_words(text)``."""
    spark.sql(
        "create or replace temporary function split_words(line string) returns table (word string) "
        "return select w from explode(filter(split(lower(line), '[^\\\\p{L}\\\\p{N}]+'), x -> x <> '')) as t(w)")
