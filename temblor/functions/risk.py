"""Rule classes: hazard level of one event, risk class of one country."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Level names, labels and colours shown to users.
HAZARD_NAMES = {
    0: "Cluster 0: Risiko Rendah (Low Risk)",
    1: "Cluster 1: Risiko Sedang (Moderate Risk)",
    2: "Cluster 2: Risiko Tinggi (High Risk)",
}
HAZARD_LABELS = {
    0: ("Risiko Rendah", "#3b82f6"),
    1: ("Risiko Sedang", "#f97316"),
    2: ("Risiko Tinggi", "#ef4444"),
}
UNKNOWN_LABEL = ("Unknown", "#718096")
COUNTRY_GROUP_LABELS = {
    0: ("Risiko Ekstrem (Extreme Risk)", "#e53e3e"),
    1: ("Risiko Sedang (Moderate Risk)", "#dd6b20"),
    2: ("Subduksi Dalam (Deep Tectonic Risk)", "#805ad5"),
    3: ("Risiko Rendah (Low Risk)", "#38a169"),
}
EXPOSED, ELEVATED, LIMITED = "RISIKO RAWAN", "RISIKO SEDANG", "RISIKO RENDAH"
# End of fixed values.

HAZARD_NOTES = {
    0: "below magnitude 4.0, or deeper than 300 km and below 5.5",
    1: "magnitude 4.0 to 5.5 down to 300 km, or 5.5 and above from 70 km down",
    2: "magnitude 5.5 and above, shallower than 70 km",
}
COUNTRY_GROUP_NOTES = {
    0: "most frequent and strong events",
    1: "middling frequency and strength",
    2: "deepest events, seldom felt at the surface",
    3: "rare and weak events",
}


def hazard_level(depth: Column, mag: Column) -> Column:
    """2 for strong and shallow; 1 for strong, or moderate down to 300 km; else 0."""
    strong = mag >= 5.5
    moderate = (mag >= 4.0) & (depth <= 300)
    return (
        F.when(strong & (depth < 70), 2).when(strong | moderate, 1).otherwise(0).cast("int")
    )


def hazard_name(level: Column) -> Column:
    """Name of a hazard level; null for an unknown one."""
    name = F.lit(None).cast("string")
    for code, text in HAZARD_NAMES.items():
        name = F.when(level == code, F.lit(text)).otherwise(name)
    return name


def country_risk(low: Column, moderate: Column, high: Column) -> Column:
    """Risk class of a country from its event counts per hazard level."""
    total = low + moderate + high
    return (
        F.when((high >= 5) | (moderate >= 400) | (total >= 5000), F.lit(EXPOSED))
        .when((high >= 1) | (moderate >= 50) | (total >= 1000), F.lit(ELEVATED))
        .otherwise(F.lit(LIMITED))
    )
