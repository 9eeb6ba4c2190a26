"""How star-schema keys become scenario labels, shared by the Spark side and the SQL side."""

from __future__ import annotations

import re

from cropledger.sources import fixed

# Order priority -> scenario.
SCENARIO_OF = {
    "1-URGENT": "BAU",
    "2-HIGH": "ELM",
    "3-MEDIUM": "EL2",
    "4-NOT SPECIFIED": "ELM_NoCC",
    "5-LOW": "BAU_WAST",
}
SCENARIOS = list(SCENARIO_OF.values())
# Order years 1995..2000 -> 2015..2040 by fives; the part year 2001 -> 2050.
FIRST_ORDER_YEAR, LAST_ORDER_YEAR = 1995, 2001
PRICE_LEVELS = {1975: 0.25, 1990: 0.5, 2005: 0.75, 2015: 1.0}
LEAVES = sorted(leaf for leaves in fixed.LAND_COVER.values() for leaf in leaves)
N_LEAVES = len(LEAVES)
N_SOURCES = 12
# Commodities with a demand sector label; the first 21 are traded under a plain name.
SECTORS = [sector for sector, *_ in fixed.COMMODITIES if sector]
COMMODITIES = [commodity for sector, commodity, *_ in fixed.COMMODITIES if sector]
N_COMMODITIES = len(COMMODITIES)
SHORT_NAMES = [s.removeprefix("regional ") for s in SECTORS]
N_TRADED = 21
FOODS = COMMODITIES[1:22]
MEATS = ["Beef", "Dairy", "SheepGoat", "Pork", "Poultry"]
USES = ["FoodDemand_Crops", "NonFoodDemand_Crops", "FeedCrops", "FodderHerb_Residue", "ethanol", "biomassOil"]
GASES = [
    "CO2", "CH4", "CH4_AGR", "CH4_AWB", "N2O", "N2O_AGR", "N2O_AWB", "HFC23", "SF6", "SO2_1", "SO2_3_AWB", "NH3_AGR",
]
FARM_GASES = ["CH4_AGR", "CH4_AWB", "N2O_AGR", "N2O_AWB", "SO2_3_AWB", "NH3_AGR"]
OTHER_SECTORS = ["electricity", "UnmanagedLand", "transport"]


def crop_of(leaf: str) -> str | None:
    """Commodity grown on a leaf; leaves without a harvested-area item grow none, but pasture grows itself."""
    if leaf == "Pasture":
        return leaf
    if not any(leaf in leaves for leaves in fixed.AREA_ITEM.values()):
        return None
    return "biomass" if leaf.startswith("biomass") else re.sub("(C4|Tree)$", "", leaf)


CROPS = sorted({crop_of(leaf) for leaf in LEAVES} - {None})
# Position of each leaf's crop in CROPS, None where nothing is grown.
CROP_OF_LEAF = [CROPS.index(crop_of(leaf)) if crop_of(leaf) else None for leaf in LEAVES]
