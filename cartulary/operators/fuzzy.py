"""Names that may be one person's: all pairs of close spellings, from an index of deletions.

Two words within k edits have a common word that is either of them with at most k letters taken out. So every spelling is
put under the hashes of its surname less one letter and its given name less two, and pairs come from one equi join of those
keys, over all names and not inside blocks of them. Only different spellings are compared; who bears one is a table of its own.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import Str, _col, place_lower, within_distance
from .skew import shuffled

# fixed values: names the archive writes in place of the given name
NICKNAMES = {"teo": "teofilo", "johny": "johnny", "pachin": "juan"}


def _one_less(word: Column) -> Column:
    """The word with each of its letters taken out in turn."""
    n = F.length(word)
    return F.when(n > 0, F.transform(F.sequence(F.lit(1), n), lambda i: F.concat(F.substring(word, F.lit(1), i - 1), F.substring(word, i + 1, n)))).otherwise(F.array().cast("array<string>"))


def deletions(c: Str, most: int) -> Column:
    """The word and all that is left of it when up to `most` letters go."""
    word = _col(c)
    level, out = F.array(word), F.array(word)
    for _ in range(most):
        level = F.array_distinct(F.flatten(F.transform(level, _one_less)))
        out = F.concat(out, level)
    return F.array_distinct(out)


def close_names(given_a: Str, surname_a: Str, given_b: Str, surname_b: Str, nicknames: Mapping[str, str] = NICKNAMES, surname: int = 1, given: int = 2) -> Column:
    """Surnames within one edit, and given names within two or one the other's nickname."""
    ga, gb = _col(given_a), _col(given_b)
    known = F.create_map(*[F.lit(x) for pair in nicknames.items() for x in pair])
    called = F.coalesce(F.try_element_at(known, ga) == gb, F.lit(False)) | F.coalesce(F.try_element_at(known, gb) == ga, F.lit(False))
    return within_distance(surname_a, surname_b, surname) & (within_distance(ga, gb, given) | called)


class Pairs(NamedTuple):
    spellings: DataFrame  # spelling, given, surname
    pairs: DataFrame  # a, b: spellings, a < b
    members: DataFrame  # id, spelling


def fuzzy_pairs(names: DataFrame, ident: str, name: str, nicknames: Mapping[str, str] = NICKNAMES, surname: int = 1, given: int = 2) -> Pairs:
    """All pairs of different spellings of "given ... surname" that may be one person's.

    Spellings are folded first; a name of one word is its own given name and surname, an empty one takes no part. NULL ids
    and repeated names are members like any other.
    """
    folded = place_lower(name)
    members = names.select(F.col(ident).alias("id"), folded.alias("spelling")).where("spelling <> ''")
    first, last = F.substring_index("spelling", " ", 1), F.substring_index("spelling", " ", -1)
    spellings = members.select(first.alias("given"), last.alias("surname")).distinct().select(F.concat_ws(" ", "given", "surname").alias("spelling"), "given", "surname")
    known = F.create_map(*[F.lit(x) for pair in nicknames.items() for x in pair])
    called = F.try_element_at(known, F.col("given"))
    givens = F.array_compact(F.array_distinct(F.concat(deletions("given", given), F.array(called))))
    hashes = F.flatten(F.transform(deletions("surname", surname), lambda s: F.transform("__g", lambda g: F.xxhash64(s, g))))
    keys = spellings.withColumn("__g", givens).select("spelling", "given", "surname", F.explode(F.array_distinct(hashes)).alias("key"))
    left = keys.select("key", *[F.col(c).alias(f"a_{c}") for c in ("spelling", "given", "surname")])
    right = keys.select("key", *[F.col(c).alias(f"b_{c}") for c in ("spelling", "given", "surname")])
    found = left.join(shuffled(right), "key").where((F.col("a_spelling") < F.col("b_spelling")) & close_names("a_given", "a_surname", "b_given", "b_surname", nicknames, surname, given))
    pairs = found.select(F.col("a_spelling").alias("a"), F.col("b_spelling").alias("b")).distinct()
    return Pairs(spellings, pairs, members.withColumn("spelling", F.concat_ws(" ", first, last)))
