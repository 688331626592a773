"""Names of entities: aliases and categories."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark import dims
from tidemark.functions.text import cjk_heavy


def _map(pairs: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])


def canonical(name: Column) -> Column:
    return F.coalesce(_map(dims.ALIASES)[name], name)


def category(name: Column, profile: str = "graph") -> Column:
    """The first category that lists the name, else a company by its script."""
    found: dict[str, str] = {}
    for label, names in dims.CATEGORIES[profile].items():
        for n in names:
            found.setdefault(n, label)
    return F.coalesce(_map(found)[name], F.when(cjk_heavy(name), dims.TAIWAN).otherwise(dims.INTERNATIONAL))


def color(label: Column) -> Column:
    return _map(dims.CATEGORY_COLORS)[label]


def normalise_links(text: Column) -> Column:
    """Aliased links get their canonical name; ``[[X]] ([[X]])`` becomes ``[[X]]``."""
    # Cut before and behind all links: an aliased one is a piece of its own, whatever the number of aliases, and all other text stays.
    parts = F.split(text, r"(?=\[\[)|(?<=\]\])")
    links = _map({f"[[{a}]]": f"[[{c}]]" for a, c in dims.ALIASES.items()})
    back = F.array_join(F.transform(parts, lambda x: F.coalesce(links[x], x)), "")
    return F.regexp_replace(back, r"\[\[([^\]]+)\]\]\s*[(（]\[\[\1\]\][)）]", "[[$1]]")
