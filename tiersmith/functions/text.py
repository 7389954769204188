"""String helpers: slugs, search tokens, column names."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words a search ignores.
STOP_WORDS = [
    "a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "in", "into", "is", "it", "of",
    "on", "or", "that", "the", "to", "was", "with",
]


def slug(c: Column) -> Column:
    kept = F.regexp_replace(F.lower(c), r"[^a-z0-9\s]", "")
    return F.trim(F.regexp_replace(kept, r"\s+", "-"), F.lit("-"))


# Light English stemming in three steps: (ending, least length of the word, what is cut, what is put).
# The first ending that fits a step is taken; a word that ends in KEPT_S keeps its s.
STEPS = [
    [("ies", 5, 3, "y"), ("sses", 5, 2, ""), ("s", 4, 1, "")],
    [("ing", 6, 3, ""), ("ed", 5, 2, ""), ("ly", 5, 2, "")],
    [("e", 4, 1, "")],
]
KEPT_S = ["ss", "us", "is"]
DOUBLED = ["bb", "dd", "gg", "mm", "nn", "pp", "rr", "tt"]


def _any_end(w: Column, endings: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [w.endswith(e) for e in endings])


def _step(w: Column, rules: list[tuple[str, int, int, str]]) -> Column:
    out = None
    for ending, least, cut, put in rules:
        fits = w.endswith(ending) & (F.length(w) >= least)
        if ending == "s":
            fits &= ~_any_end(w, KEPT_S)
        left = F.concat(F.substring(w, F.lit(1), F.length(w) - cut), F.lit(put))
        out = F.when(fits, left) if out is None else out.when(fits, left)
    return out.otherwise(w)


def stems(words: Column) -> Column:
    """Words of an array without their common English endings; a consonant doubled by them is undone."""
    words = F.transform(words, lambda w: _step(w, STEPS[0]))
    words = F.transform(words, lambda w: _step(w, STEPS[1]))
    undone = lambda w: F.when(_any_end(w, DOUBLED), F.substring(w, F.lit(1), F.length(w) - 1)).otherwise(w)
    words = F.transform(words, undone)
    return F.transform(words, lambda w: _step(w, STEPS[2]))


def stem(word: str) -> str:
    """The same for one word of a query."""
    for k, rules in enumerate(STEPS):
        for ending, least, cut, put in rules:
            if word.endswith(ending) and len(word) >= least and not (ending == "s" and word.endswith(tuple(KEPT_S))):
                word = word[:-cut] + put
                break
        if k == 1 and word.endswith(tuple(DOUBLED)):
            word = word[:-1]
    return word


def tokens(c: Column) -> Column:
    """Stems of the lower-case words of any script, without stop words, in order of appearance."""
    words = F.split(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"[^\p{L}\p{N}]+", " "), " ")
    return stems(F.filter(words, lambda w: (w != "") & ~w.isin(STOP_WORDS)))


def query_terms(query: str) -> list[str]:
    """The distinct stems of a query, cut like the words of a text."""
    words = re.findall(r"[^\W_]+", query.lower())
    return list(dict.fromkeys(stem(w) for w in words if w not in STOP_WORDS))


def snake_case(name: str) -> str:
    """``HTTPResponse`` -> ``http_response``; a leading underscore marks metadata and is kept."""
    if not name:
        return name
    words = re.findall(r"[A-Z]+(?=[A-Z][a-z])|[A-Z]*[^A-Z\s\-.+_]+|[A-Z]+", name)
    body = "_".join(w.lower() for w in words)
    return ("_" + body) if name.startswith("_") and body else body


def unique_names(names: list[str]) -> list[str]:
    """Later repeats of a name get ``_1``, ``_2`` and so on."""
    seen: dict[str, int] = {}
    out = []
    for n in names:
        if n in seen:
            seen[n] += 1
            out.append(f"{n}_{seen[n]}")
        else:
            seen[n] = 0
            out.append(n)
    return out
