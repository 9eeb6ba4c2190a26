"""Text recodes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Demand labels by use class; the first pattern that matches decides.
USE_CLASSES = [
    ("NonFoodDemand", "Other use"),
    ("ethanol|biomassOil", "Bioenergy"),
    ("FoodDemand", "Food"),
    ("FeedCrops|Fodder", "Feed"),
]
# Fixed value: commodity names with an underscore, which survive in trade labels.
UNDERSCORED_NAMES = "nuts_seeds|root_tuber"


def matches(text: Column, pattern: str) -> Column:
    """Regex match that is false, not NULL, on a missing text."""
    return F.coalesce(text.rlike(pattern), F.lit(False))


def among(value: Column, members: Sequence) -> Column:
    """Membership that is false, not NULL, on a missing value."""
    return F.coalesce(value.isin(list(members)), F.lit(False))


def recode_first_match(text: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """Label of the first matching pattern; a text no pattern matches stays as it is."""
    result = None
    for pattern, label in rules:
        hit = text.rlike(pattern)
        result = F.when(hit, F.lit(label)) if result is None else result.when(hit, F.lit(label))
    return text if result is None else result.otherwise(text)


def recode_values(value: Column, labels: dict[str, str]) -> Column:
    """Replace single values in place, keep all others."""
    result = value
    for old, new in labels.items():
        result = F.when(value == old, F.lit(new)).otherwise(result)
    return result


def without(text: Column, pattern: str) -> Column:
    return F.regexp_replace(text, pattern, "")


def without_pattern_of(text: Column, pattern: Column) -> Column:
    """Remove what the pattern held in another column of the same row matches."""
    return F.regexp_replace(text, pattern, F.lit(""))


def code_parts(code: Column, names: Sequence[str]) -> list[Column]:
    """Pieces of a code between runs of non-alphanumerics: too few give NULL, extra ones are left out."""
    pieces = F.split(code, "[^A-Za-z0-9]+")
    return [F.get(pieces, F.lit(i)).alias(name) for i, name in enumerate(names)]


def trade_partner(subsector: Column, sector: Column) -> Column:
    """Exporting region named in a trade label such as ``Brazil traded corn``."""
    rest = without(without_pattern_of(subsector, sector), " traded ")
    return without(rest, UNDERSCORED_NAMES)
