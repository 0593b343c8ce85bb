"""Fixed values of the survey programme: names, dates, constants and patterns.

Results are only right with exactly these values, so they are kept here as plain data.
Every function that uses one takes it as a default and accepts another.
"""

# --- fixed values: site aliases, effort form ---------------------------------------------------
EFFORT_SITE_ALIASES = {
    "KF1D": ["KF1_deep", "KF1D"],
    "KF1S": ["KF1_shallow", "KF1S"],
    "KF2D": ["KF2_deep", "KF2D"],
    "KF2S": ["KF2_shallow", "KF2S"],
    "BR1D": ["BR1_deep", "BR1D"],
    "BR1S": ["BR1_shallow", "BR1S"],
    "BR2D": ["BR2_deep", "BR2D"],
    "BR2S": ["BR2_shallow", "BR2S"],
}

# --- fixed values: site aliases, count form (long names and two spellings of "barren") ---------
COUNT_SITE_ALIASES = {
    "KF1D": ["Kelp Forest 1 Deep", "KF1_deep", "KF1D"],
    "KF1S": ["Kelp Forest 1 Shallow", "KF1_shallow", "KF1S"],
    "KF2D": ["Kelp Forest 2 Deep", "KF2_deep", "KF2D"],
    "KF2S": ["Kelp Forest 2 Shallow", "KF2_shallow", "KF2S"],
    "BR1D": ["Barrens Reef 1 Deep", "Baren Reef 1 Deep", "Baren reef 1 Deep", "BR1_deep", "BR1D"],
    "BR1S": ["Barrens Reef 1 Shallow", "Baren Reef 1 Shallow", "BR1_shallow", "BR1S"],
    "BR2D": ["Barrens Reef 2 Deep", "Baren Reef 2 Deep", "Baren reef 2 Deep", "BR2_deep", "BR2D"],
    "BR2S": ["Barrens Reef 2 Shallow", "Baren Reef 2 Shallow", "BR2_shallow", "BR2S"],
}

# --- fixed values: known collection-date errors (site, date as typed, date as sampled) ---------
COLLECTION_DATE_CORRECTIONS = [
    ("BR2S", "2026-02-27", "2026-02-26"),
    ("BR1D", "2026-03-08", "2026-03-03"),
]

# --- fixed values: regular expressions, all matched without regard to case ---------------------
MEDIA_TYPE_PATTERNS = [
    (r"^benthic\s+brush", "benthic_brush"),
    (r"^suspended\s+brush", "suspended_brush"),
    (r"^benthic\s+recruitment\s+plate", "benthic_plate"),
    (r"^suspended\s+recruitment\s+plate", "suspended_plate"),
]
HABITAT_PATTERNS = [(r"kelp\s*forest", "Forest"), (r"bar+en|barren", "Barren")]
SITE_PREFIX_PATTERNS = [(r"kelp\s*forest", "KF"), (r"bar+en|barren", "BR")]
DEPTH_PATTERNS = [(r"shallow", "shallow"), (r"deep", "deep")]
PATCH_PATTERNS = [(r"^KF", "forest"), (r"^BR", "barren")]
SUBSTRATE_TO_MEDIA = [("benthic", "benthic_brush"), ("suspended", "suspended_brush")]
MEDIA_TO_POSITION = [("benthic_brush", "benthic"), ("suspended_brush", "suspended")]
PATCH_ORDER = ["forest", "barren"]
POSITION_ORDER = ["benthic", "suspended"]

# --- fixed values: taxa of the count form ------------------------------------------------------
URCHIN_COLUMNS = [
    "number_of_purple_urchins",
    "number_of_red_urchins",
    "number_of_unidentified_urchins",
]
COUNT_COLUMNS = [
    "number_of_vials_in_sample",
    *URCHIN_COLUMNS,
    "number_of_crabs",
    "number_of_gastropods",
    "number_of_bivalves",
    "number_of_plastic",
]
TAXON_LABELS = {
    "total_urchins": "Total urchins",
    "number_of_purple_urchins": "Purple urchins",
    "number_of_red_urchins": "Red urchins",
    "number_of_unidentified_urchins": "Unidentified urchins",
    "number_of_crabs": "Crabs",
    "number_of_gastropods": "Gastropods",
    "number_of_bivalves": "Bivalves",
    "number_of_plastic": "Plastic",
}

# --- fixed values: zone-level constants --------------------------------------------------------
ZONE_AREA_M2 = 80
BIOMASS_COEFFICIENTS = (-14.2, 7.44, 0.041)
BIOMASS_FLOOR_G = 0.5
GROWTH_START = (-20.0, 10.0, 0.03)
CANOPY_TAXON = "MACPYR"
SIZE_SPECIES = "Purple"
DISSECTION_SPECIES = ["purple_urchin", "red_urchin"]
DISSECTION_MASS_LIMIT_G = 100
# (mass above, diameter below) and (mass below, diameter above): pairs judged to be typing errors
DISSECTION_HEAVY_AND_SMALL = [(20, 30), (38, 40)]
DISSECTION_LIGHT_AND_LARGE = [(20, 45)]

# --- fixed values: temperature grids -----------------------------------------------------------
REGION_BOX = {"latitude": (32.0, 42.1), "longitude": (-130.0, -114.0)}
BASELINE_YEARS = list(range(2010, 2025))
FAINT_YEARS = [2020, 2022, 2024]
HIGHLIGHT_YEAR = 2014
LAST_FULL_YEAR = 2025
CONTINUATION_YEAR = 2026
SERIES_FIRST_DOY = 150
FINE_GRID_START = "2002-06-01"
FINE_GRID_STRIDE = (1, 10, 10)
REVISABLE_DAYS = 5

# --- fixed values: reporting -------------------------------------------------------------------
LOG_AXIS_OFFSET = 0.01
HISTOGRAM_BINS = 25
BUBBLE_RANGE = (5.0, 25.0)
SNAPSHOT_RETENTION_DAYS = 90

# --- fixed values: columns of the office, by sheet -----------------------------------------------
QUADRAT_OFFICE_COLUMNS = ["name_of_data_enterer", "observer_buddy", "write_in", "notes"]
#: Columns without a heading, as the workbook reader names them.
UNNAMED_COLUMNS = ["x15", "x16"]
SPECIES_OFFICE_COLUMNS = ["name_of_data_enterer", "observer", "buddy"]
