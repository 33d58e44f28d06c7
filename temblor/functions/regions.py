"""Free-text place to country.

The rules run on built-in string expressions, so they stay inside whole-stage codegen. They
are data: pass another ``RegionRules`` to override a list.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Token lists that decide the country of a place. Matching is order-sensitive.
UNITED_STATES_NAMES = (
    "Alaska", "California", "Hawaii", "Nevada", "Texas", "Washington", "Oregon", "Idaho",
    "Montana", "Wyoming", "Utah", "Colorado", "New Mexico", "Arizona", "Oklahoma", "Kansas",
    "Nebraska", "South Dakota", "North Dakota", "Puerto Rico", "U.S. Virgin Islands",
    "Northern Mariana Islands", "Guam",
)
DIRECTION_PREFIXES = (
    "EASTERN ", "WESTERN ", "NORTHERN ", "SOUTHERN ", "CENTRAL ", "NORTHWESTERN ",
    "SOUTHWESTERN ", "NORTHEASTERN ", "SOUTHEASTERN ", "OFF COAST OF ", "NEAR COAST OF ",
    "SOUTH OF ", "NORTH OF ", "EAST OF ", "WEST OF ", "OFFSHORE ",
)
REGION_SUFFIXES = (" REGION", " ISLANDS", " ISLAND")
REGION_ALIASES = {"P.N.G.": "PAPUA NEW GUINEA"}
INDONESIA_PARTS = (
    "BALI", "MOLUCCA", "BANDA", "JAVA", "CELEBES", "TIMOR", "ARAFURA", "FLORES", "SAVU",
    "HALMAHERA", "SERAM", "MAKASSAR", "SUNDA", "TALAUD", "SUMATRA", "MINAHASA", "IRIAN JAYA",
    "NIAS", "SUMBAWA", "LOMBOK", "INDONESIA",
)
UNITED_STATES_PARTS = (
    "ALASKA", "CALIFORNIA", "HAWAII", "NEVADA", "TEXAS", "WASHINGTON", "OREGON", "IDAHO",
    "MONTANA", "WYOMING", "UTAH", "COLORADO", "NEW MEXICO", "ARIZONA", "OKLAHOMA", "KANSAS",
    "NEBRASKA", "SOUTH DAKOTA", "NORTH DAKOTA", "PUERTO RICO", "VIRGIN ISLANDS", "GUAM",
)
RUSSIA_PARTS = (
    "KAMCHATKA", "KURIL", "SAKHALIN", "SIBERIA", "BAYKAL", "CAUCASUS", "URAL",
    "KOMANDORSKIYE", "RUSSIA",
)
# End of fixed values.


def _alternatives(words: tuple[str, ...]) -> str:
    return "|".join(re.escape(word).replace(r"\ ", " ") for word in words)


@dataclass(frozen=True)
class RegionRules:
    """How a region name becomes a country; ``countries`` is tried in order, by substring."""

    prefixes: tuple[str, ...]
    suffixes: tuple[str, ...]
    aliases: tuple[tuple[str, str], ...]
    countries: tuple[tuple[str, tuple[str, ...]], ...]

    def __post_init__(self) -> None:
        # Countries are substituted one after another, so a name must not match a later rule.
        patterns = self.country_patterns
        for i, (name, _) in enumerate(patterns):
            for other, later in patterns[i + 1 :]:
                if re.search(later, name):
                    raise ValueError(f"country {name!r} matches the rule for {other!r}")

    @property
    def prefix_pattern(self) -> str:
        return "^(" + _alternatives(self.prefixes) + ")"

    @property
    def suffix_pattern(self) -> str:
        return "(" + _alternatives(self.suffixes) + ")$"

    @property
    def country_patterns(self) -> list[tuple[str, str]]:
        return [(country, _alternatives(parts)) for country, parts in self.countries]


FLINN_ENGDAHL = RegionRules(
    prefixes=DIRECTION_PREFIXES,
    suffixes=REGION_SUFFIXES,
    aliases=tuple(REGION_ALIASES.items()),
    countries=(
        ("Indonesia", INDONESIA_PARTS),
        ("United States", UNITED_STATES_PARTS),
        ("Russia", RUSSIA_PARTS),
    ),
)


def last_token(place: Column) -> Column:
    """Trimmed text after the last comma; null stays null, text without a comma is kept."""
    return F.trim(F.element_at(F.split(place, ","), -1))


def normalise_country_usgs(
    place: Column, home_names: tuple[str, ...] = UNITED_STATES_NAMES
) -> Column:
    """Country of a 'distance of town, state-or-country' text; two letters are a state code."""
    token = last_token(place)
    is_home = (F.length(token) == 2) | token.isin(list(home_names))
    return F.when(is_home, F.lit("United States")).otherwise(token)


def normalise_country_emsc(place: Column, rules: RegionRules = FLINN_ENGDAHL) -> Column:
    """Country of a Flinn-Engdahl region name.

    One leading direction and then one trailing suffix go; an alias is exact; a country
    matches by substring. What matches nothing stays as upper-case text.

    Each rule is one substitution that reads its input once. A CASE chain would name the
    region in every branch, and a filter on country pushed below the projection would then
    repeat the whole chain until the generated code no longer compiles.
    """
    region = F.upper(last_token(place))
    region = F.regexp_replace(region, rules.prefix_pattern, "")
    region = F.regexp_replace(region, rules.suffix_pattern, "")
    for alias, name in rules.aliases:
        region = F.regexp_replace(region, f"^{re.escape(alias)}\\z", name)
    for name, pattern in rules.country_patterns:
        region = F.regexp_replace(region, f"(?s)^.*({pattern}).*\\z", name)
    return region
