"""Labels and weights that reports must share to be comparable."""

from __future__ import annotations

# Native regions in the order of their ids, from 1.
NATIVE_REGIONS = [
    "USA", "Africa_Eastern", "Africa_Northern", "Africa_Southern", "Africa_Western", "Australia_NZ", "Brazil",
    "Canada", "Central America and Caribbean", "Central Asia", "China", "EU-12", "EU-15", "Europe_Eastern",
    "Europe_Non_EU", "European Free Trade Association", "India", "Indonesia", "Japan", "Mexico", "Middle East",
    "Pakistan", "Russia", "South Africa", "South America_Northern", "South America_Southern", "South Asia",
    "South Korea", "Southeast Asia", "Taiwan", "Argentina", "Colombia",
]

# Report code -> native regions.
REPORT_REGIONS = {
    "ANZ": ["Australia_NZ"],
    "BRA": ["Brazil"],
    "CAN": ["Canada"],
    "CHN": ["China"],
    "EUR": ["EU-12", "EU-15", "Europe_Non_EU", "European Free Trade Association"],
    "FSU": ["Europe_Eastern", "Central Asia", "Russia"],
    "IND": ["India"],
    "MEN": ["Africa_Northern", "Middle East"],
    "OAS": ["South Asia", "Pakistan"],
    "OSA": [
        "Argentina", "Central America and Caribbean", "Colombia", "Mexico", "South America_Northern",
        "South America_Southern",
    ],
    "SEA": ["Taiwan", "Japan", "South Korea", "Indonesia", "Southeast Asia"],
    "SSA": ["Africa_Eastern", "Africa_Southern", "Africa_Western", "South Africa"],
    "USA": ["USA"],
}

# Cover class -> land leaves.
LAND_COVER = {
    "CRP": [
        "CornC4", "FiberCrop", "FodderGrass", "FodderHerb", "FodderHerbC4", "Fruits", "FruitsTree", "Legumes",
        "MiscCrop", "MiscCropTree", "NutsSeeds", "NutsSeedsTree", "OilCrop", "OilCropTree", "OilPalmTree",
        "OtherArableLand", "OtherGrain", "OtherGrainC4", "Rice", "RootTuber", "Soybean", "SugarCrop", "SugarCropC4",
        "Vegetables", "Wheat", "biomassGrass", "biomassTree",
    ],
    "FOR": [
        "Hardwood_Forest", "ProtectedUnmanagedHardwood_Forest", "ProtectedUnmanagedSoftwood_Forest",
        "Softwood_Forest", "UnmanagedHardwood_Forest", "UnmanagedSoftwood_Forest",
    ],
    "GRS": ["Pasture", "ProtectedUnmanagedPasture", "UnmanagedPasture"],
    "NLD": ["RockIceDesert", "Tundra", "UrbanLand"],
    "ONV": ["Grassland", "ProtectedGrassland", "ProtectedShrubland", "Shrubland"],
}

# Harvested-area item -> land leaves; other leaves have none.
AREA_ITEM = {
    "CGR": ["CornC4", "OtherGrain", "OtherGrainC4"],
    "ECP": ["biomassGrass", "biomassTree"],
    "OCR": ["FodderGrass", "FodderHerb", "FodderHerbC4", "Legumes", "MiscCrop", "MiscCropTree", "RootTuber"],
    "OSD": ["OilCrop", "OilCropTree", "OilPalmTree", "Soybean"],
    "PFB": ["FiberCrop"],
    "RIC": ["Rice"],
    "SGC": ["SugarCrop", "SugarCropC4"],
    "VFN": ["Fruits", "FruitsTree", "NutsSeeds", "NutsSeedsTree", "Vegetables"],
    "WHT": ["Wheat"],
}

# Fixed values: (demand sector, commodity, kind, report item).
COMMODITIES = [
    ("biomass", "biomass", "Crop", "ECP"),
    ("regional wheat", "Wheat", "Crop", "WHT"),
    ("regional rice", "Rice", "Crop", "RIC"),
    ("regional corn", "Corn", "Crop", "CGR"),
    ("regional othergrain", "OtherGrain", "Crop", "CGR"),
    ("regional root_tuber", "RootTuber", "Crop", "OCR"),
    ("regional oilcrop", "OilCrop", "Crop", "OSD"),
    ("regional soybean", "Soybean", "Crop", "OSD"),
    ("regional oilpalm", "OilPalm", "Crop", "OSD"),
    ("regional legumes", "Legumes", "Crop", "OCR"),
    ("regional fibercrop", "FiberCrop", "Crop", "PFB"),
    ("regional sugarcrop", "SugarCrop", "Crop", "SGC"),
    ("regional nuts_seeds", "NutsSeeds", "Crop", "VFN"),
    ("regional fruits", "Fruits", "Crop", "VFN"),
    ("regional vegetables", "Vegetables", "Crop", "VFN"),
    ("regional misccrop", "MiscCrop", "Crop", "OCR"),
    ("regional beef", "Beef", "Livestock", "RUM"),
    ("regional dairy", "Dairy", "Livestock", "DRY"),
    ("regional sheepgoat", "SheepGoat", "Livestock", "RUM"),
    ("regional pork", "Pork", "Livestock", "NRM"),
    ("regional poultry", "Poultry", "Livestock", "NRM"),
    ("OtherMeat_Fish", "OtherMeat_Fish", "Livestock", "FSH_OAP"),
    ("Pasture", "Pasture", "Pasture", None),
    ("FodderHerb", "FodderHerb", "Crop", "OCR"),
    ("FodderGrass", "FodderGrass", "Crop", "OCR"),
    (None, "Forest", "Forest", None),
]

# Warming weights (AR4, AR5, AR6) of the main gases; their farm (AGR) and burning (AWB) sources share them.
METHANE = (25.0, 28.0, 27.0)
NITROUS_OXIDE = (298.0, 265.0, 273.0)
CARBON_DIOXIDE = (3.7, 3.7, None)
# Fluorinated gases, per kilogram and in thousands (AR4, AR5, AR6).
FLUORINATED = {
    "C2F6": (12.2, 11.1, 12.41),
    "CF4": (7.39, 6.63, 7.379),
    "HFC125": (3.5, 3.17, 3.744),
    "HFC134a": (1.43, 1.3, 1.526),
    "HFC245fa": (1.03, 0.858, 0.962),
    "HFC143a": (4.47, 4.8, 5.807),
    "HFC152a": (0.124, 0.138, 0.164),
    "HFC227ea": (3.22, 3.35, 3.602),
    "HFC23": (14.8, 12.4, 14.59),
    "HFC236fa": (9.81, 8.06, 8.689),
    "HFC32": (0.675, 0.677, 0.77),
    "HFC365mfc": (0.794, 0.804, 0.913),
    "HFC43": (1.64, 1.65, 1.599),
    "SF6": (22.8, 23.5, 25.184),
}
# Gases without a warming weight, and the sources they are told apart by.
UNWEIGHTED = {
    "BC": ["AWB"], "CO": ["AWB"], "NH3": ["AGR", "AWB"], "NMVOC": ["AWB", "AGR"], "NOx": ["AGR", "AWB"],
    "OC": ["AWB"], "SO2_3": ["AWB"], "H2": ["AWB"],
}
OTHER_GASES = "Other GHGs"

# Scenarios with their own food demand, and those in which food waste halves by 2050.
DIET_SCENARIOS = ["BAU_DIET", "EL2", "ELM", "ELM_NoCC", "ELM_PROD", "ELM_WAST"]
HALF_WASTE_SCENARIOS = ["EL2", "ELM", "ELM_WAST", "BAU_WAST"]
BASE_SCENARIO = "BAU"
NO_CLIMATE_CHANGE = "NoCC"


def region_rows() -> list[tuple[str, str]]:
    return [(region, code) for code, members in REPORT_REGIONS.items() for region in members]


def leaf_rows() -> list[tuple[str, str, str | None]]:
    item = {leaf: code for code, leaves in AREA_ITEM.items() for leaf in leaves}
    return [(leaf, cover, item.get(leaf)) for cover, leaves in LAND_COVER.items() for leaf in leaves]


def gas_rows() -> list[tuple]:
    rows = [("CO2", "CO2", *CARBON_DIOXIDE)]
    for gas, weights in (("CH4", METHANE), ("N2O", NITROUS_OXIDE)):
        rows += [(gas + source, gas, *weights) for source in ("", "_AGR", "_AWB")]
    rows += [(gas, OTHER_GASES, *weights) for gas, weights in FLUORINATED.items()]
    for gas, sources in UNWEIGHTED.items():
        rows += [(name, OTHER_GASES, 0.0, 0.0, None) for name in (gas, *[f"{gas}_{s}" for s in sources])]
    return rows
