from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def label_norm(text: Column) -> Column:
    return F.upper(F.trim(text))


def map_codes(
    code: Column,
    mapping: Mapping[str, str],
    fallback: Callable[[Column], Column] | None = None,
) -> Column:
    """Trimmed code looked up in ``mapping``. Codes that are not in it pass
    through (``fallback`` applied when given); null stays null."""
    key = F.trim(code)
    entries = [F.lit(part) for pair in mapping.items() for part in pair]
    return F.coalesce(
        F.try_element_at(F.create_map(*entries), key),
        fallback(key) if fallback else key,
    )


def contains_any(text: Column, words: Iterable[str]) -> Column:
    """Whether ``text`` holds one of ``words``. A word that contains another one
    of the list can never decide the answer, so it is left out of the test."""
    words = list(dict.fromkeys(words))
    needed = [w for w in words if not any(v != w and v in w for v in words)]
    return reduce(or_, [F.contains(text, F.lit(w)) for w in needed], F.lit(False))


def keyword_category(
    label: Column, rules: Sequence[tuple[str, Sequence[str]]], default: str
) -> Column:
    """First rule with a keyword in the upper-cased label, else ``default``.

    The text is bound once, as the element of a one-element array. Written out
    for every keyword it would be computed again for each one wherever Spark
    does not share subexpressions, as in a filter pushed below this column, and
    the generated code would grow past what the JVM compiles.
    """

    bound = F.array(F.upper(F.coalesce(label, F.lit(""))))
    first = F.transform(bound, lambda text: _first_hit(text, rules, default))
    return F.get(first, F.lit(0))


def plain_keyword_category(
    label: Column, rules: Sequence[tuple[str, Sequence[str]]], default: str
) -> Column:
    """``keyword_category`` written out, for a label that is a stored column."""
    return _first_hit(F.upper(F.coalesce(label, F.lit(""))), rules, default)


def _first_hit(text: Column, rules: Sequence[tuple[str, Sequence[str]]], default: str) -> Column:
    hits = [F.when(contains_any(text, words), F.lit(name)) for name, words in rules]
    return F.coalesce(*hits, F.lit(default))


def worst_of_status(
    statuses: Sequence[Column], bad: str = "N", good: str = "C", other: str = "S"
) -> Column:
    """``bad`` if any status is bad, ``good`` if every one is good, else ``other``.
    Null-safe comparison keeps the rule two-valued: a null is neither."""
    any_bad = reduce(or_, [s.eqNullSafe(bad) for s in statuses])
    all_good = reduce(and_, [s.eqNullSafe(good) for s in statuses])
    return F.when(any_bad, bad).when(all_good, good).otherwise(other)


def surrogate_key(parts: Sequence[Column], sep: str = "||") -> Column:
    """Parts joined by ``sep``; a null part keeps its place as an empty text."""
    return F.concat_ws(sep, *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
