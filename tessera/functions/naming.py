"""Column-name slugs: SQL-safe lower snake case names for composed export headers."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# What a percent sign becomes, and the characters a slug may hold.
PERCENT_WORD = "percent"
SLUG_WORD = "[0-9a-zA-Z]+"


def slugify(name: str) -> str:
    """The words of ``name`` in lower case, joined by underscores; a percent sign is spelled out."""
    return "_".join(re.findall(SLUG_WORD, name.replace("%", PERCENT_WORD))).lower()


def slug_expr(col: Column | str) -> Column:
    """The same rule as :func:`slugify`, as a JVM-side expression over a string column."""
    spelled = F.replace(F.col(col) if isinstance(col, str) else col, F.lit("%"), F.lit(PERCENT_WORD))
    return F.lower(F.array_join(F.regexp_extract_all(spelled, F.lit(SLUG_WORD), F.lit(0)), "_"))


def compose_name(group: str | None, field: str | None, sep: str = " - ") -> str:
    """Composed column name from the two header rows (a blank cell reads as empty)."""
    return f"{group or ''}{sep}{field or ''}"


def check_unique_slugs(names: list[str]) -> list[str]:
    """Slugs for ``names``; raises ``ValueError`` with the names that share one."""
    sharing: dict[str, list[str]] = {}
    for name in names:
        sharing.setdefault(slugify(name), []).append(name)
    clashes = {slug: group for slug, group in sharing.items() if len(group) > 1}
    if clashes:
        raise ValueError("several columns would get one name: " + "; ".join(
            f"{slug} from {', '.join(map(repr, group))}" for slug, group in sorted(clashes.items())))
    return [slugify(name) for name in names]
