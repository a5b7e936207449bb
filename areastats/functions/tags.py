"""Tag predicates: which groups or points of interest an element belongs to."""

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from areastats.constants import VALUE_TAG_KEYS


def value_tags(tags: Column, keys: Sequence[str] = VALUE_TAG_KEYS) -> Column:
    """Values of the compared keys."""
    return F.array_compact(F.array(*[F.try_element_at(tags, F.lit(k)) for k in keys]))


def all_words(tags: Column, keys: Sequence[str] = VALUE_TAG_KEYS) -> Column:
    """Values of the compared keys, and every tag key."""
    return F.concat(value_tags(tags, keys), F.coalesce(F.map_keys(tags), F.array().cast("array<string>")))


def groups_of(words: Column, groups: dict[str, list[str]], prefix: str = "") -> Column:
    """Sorted distinct names of the groups that list any of the words."""
    listed: dict[str, list[str]] = {}
    for group, members in groups.items():
        for member in members:
            listed.setdefault(member, []).append(prefix + group)
    table = F.create_map(*[
        part for word, names in listed.items() for part in (F.lit(word), F.array(*[F.lit(n) for n in names]))
    ])
    found = F.array_compact(F.transform(words, lambda w: F.try_element_at(table, w)))
    return F.array_sort(F.array_distinct(F.flatten(found)))


def count_groups(tags: Column, groups: dict[str, list[str]], prefix: str = "") -> Column:
    """Predicate of the counts: a compared value is in the group."""
    return groups_of(value_tags(tags), groups, prefix)


def ratio_groups(tags: Column, groups: dict[str, list[str]], prefix: str = "") -> Column:
    """Predicate of the ratios: a compared value or any key is in the group."""
    return groups_of(all_words(tags), groups, prefix)


def nearest_pois(tags: Column, pois: Sequence[str]) -> Column:
    """Predicate of the nearest distances: a compared value equals the poi, or the poi is a key."""
    wanted = F.array(*[F.lit(p) for p in pois])
    return F.array_sort(F.array_intersect(wanted, all_words(tags)))
