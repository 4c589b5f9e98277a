"""Text matching: wildcard containment, trigram similarity and address keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def contains_ignore_case(value: Column, term: str, literal: bool = False) -> Column:
    """`value ILIKE '%term%'`: % and _ in the term are wildcards unless `literal`."""
    if literal:
        for special in ("\\", "%", "_"):
            term = term.replace(special, "\\" + special)
    return value.ilike(f"%{term}%")


def trigrams(value: Column) -> Column:
    """Distinct trigrams of the lower-cased words, each padded by two blanks in front and one behind."""
    words = F.filter(F.split(F.lower(value), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    padded = F.transform(words, lambda w: F.concat(F.lit("  "), w, F.lit(" ")))
    grams = F.transform(
        padded,
        lambda w: F.transform(
            F.sequence(F.lit(1), F.length(w) - 2), lambda i: F.substring(w, i, F.lit(3))
        ),
    )
    return F.array_distinct(F.flatten(grams))


def trigram_similarity(a: Column, b: Column) -> Column:
    """Shared trigrams over all trigrams of both texts, 0 when neither has any."""
    ta, tb = trigrams(a), trigrams(b)
    shared = F.size(F.array_intersect(ta, tb))
    union = F.size(ta) + F.size(tb) - shared
    return F.when(union > 0, shared / union).otherwise(F.lit(0.0))


def address_key(value: Column) -> Column:
    """Address for equality matching: lower case, punctuation dropped, single blanks; null when nothing is left."""
    words = F.regexp_replace(F.lower(value), r"[^\p{L}\p{N}]+", " ")
    return F.nullif(F.trim(words), F.lit(""))
