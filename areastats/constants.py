"""Fixed values.

These lists and names decide the output columns, so they must equal the values
users already rely on. Every operator takes them as parameters; the values here
are only the defaults.
"""

# Columns of the header-less property sale files, in file order.
PRICE_COLUMNS = [
    "transaction_id",
    "price",
    "date_of_transfer",
    "postcode",
    "property_type",
    "old_new",
    "duration",
    "paon",
    "saon",
    "street",
    "locality",
    "town_city",
    "district",
    "county",
    "ppd_category",
    "record_status",
]

# Property type code -> name used in the share columns.
PROPERTY_TYPES = {
    "T": "terraced",
    "F": "flats",
    "S": "semi_detached",
    "D": "detached",
    "O": "other",
}

# Crime categories that get a count column.
CRIME_CATEGORIES = [
    "robbery",
    "drugs",
    "possession-of-weapons",
    "vehicle-crime",
    "other-theft",
    "anti-social-behaviour",
    "public-order",
    "bicycle-theft",
    "criminal-damage-arson",
    "other-crime",
    "theft-from-the-person",
    "violent-crime",
    "shoplifting",
    "burglary",
]

# Crime outcomes that get a count column.
CRIME_OUTCOMES = [
    "Further action is not in the public interest",
    "Court result unavailable",
    "Local resolution",
    "Offender given a caution",
    "Unable to prosecute suspect",
    "Under investigation",
    "Awaiting court outcome",
    "Suspect charged as part of another case",
    "Further investigation is not in the public interest",
    "Formal action is not in the public interest",
    "Status update unavailable",
    "Offender given a drugs possession warning",
    "Investigation complete; no suspect identified",
    "Action to be taken by another organisation",
]

# Bulk-file crime label -> category name.
CRIME_LABELS = {
    "Bicycle theft": "bicycle-theft",
    "Burglary": "burglary",
    "Criminal damage and arson": "criminal-damage-arson",
    "Drugs": "drugs",
    "Other crime": "other-crime",
    "Other theft": "other-theft",
    "Possession of weapons": "possession-of-weapons",
    "Public order": "public-order",
    "Robbery": "robbery",
    "Shoplifting": "shoplifting",
    "Theft from the person": "theft-from-the-person",
    "Vehicle crime": "vehicle-crime",
    "Violence and sexual offences": "violent-crime",
}

# Short name in the claim columns -> condition group.
CLAIM_GROUPS = {
    "nwr": "universal_credit_no_work_required",
    "planfw": "universal_credit_planning_for_work",
    "prepfw": "universal_credit_preparing_for_work",
    "sfw": "universal_credit_searching_for_work",
}

# Labels of the two cube fields that are read.
CUBE_MONTH_FIELD = "Month"
CUBE_AREA_FIELD = "National - Regional - LA - OAs"

# Age bands summed into each population column (both yearly layouts).
POPULATION_KEY = "LSOA 2021 Code"
POPULATION_BANDS = {
    "aged_under_15": [
        "aged_0_to_4",
        "aged_5_to_9",
        "aged_10_to_14",
        "F0 to 15",
        "M0 to 15",
    ],
    "working_age_population": [
        "aged_15_to_19",
        "aged_20_to_24",
        "aged_25_to_29",
        "aged_30_to_34",
        "aged_35_to_39",
        "aged_40_to_44",
        "aged_45_to_49",
        "aged_50_to_54",
        "aged_55_to_59",
        "aged_60_to_64",
        "F16 to 29",
        "F30 to 44",
        "F45 to 64",
        "M16 to 29",
        "M30 to 44",
        "M45 to 64",
    ],
    "pension_age_population": [
        "aged_65_to_69",
        "aged_70_to_74",
        "aged_75_to_79",
        "aged_80_to_84",
        "aged_85_and_over",
        "F65 and over",
        "M65 and over",
    ],
}

# Buffer distances in metres.
BUFFER_DISTANCES = [0, 250, 500, 750, 1000, 1250, 1500, 2000, 2500, 5000]
RATIO_DISTANCES = [500, 1000, 2000]

# Tags whose nearest point is measured.
NEAREST_POI = [
    "shop",
    "hospital",
    "pharmacy",
    "school",
    "kindergarten",
    "college",
    "university",
    "bank",
    "atm",
    "ice_cream",
    "fast_food",
    "pub",
    "bar",
    "nightclub",
    "stripclub",
    "gambling",
    "bicycle_parking",
    "cinema",
    "theatre",
    "social_facility",
]

# Tag keys whose value is compared with a tag list.
VALUE_TAG_KEYS = ["amenity", "shop", "landuse", "highway"]

# Tag group -> tags.
AMENITY_GROUPS = {
    "healthcare_access": ["hospital", "clinic", "doctors", "dentist", "pharmacy", "veterinary"],
    "education_skills": [
        "school", "kindergarten", "college", "university", "library", "language_school",
        "music_school", "prep_school", "training", "dancing_school", "dojo",
    ],
    "financial_services": ["bank", "atm", "bureau_de_change", "financial_advice"],
    "food_dining": ["restaurant", "cafe", "food_court", "ice_cream"],
    "fast_food_takeaway": ["fast_food"],
    "alcohol_gambling": ["pub", "bar", "nightclub", "stripclub", "casino", "gambling"],
    "community_social": [
        "community_centre", "social_facility", "youth_centre", "scout_hut", "club", "library",
        "public_building", "events_venue", "church_hall",
    ],
    "cultural_entertainment": [
        "theatre", "cinema", "concert_hall", "music_venue", "arts_centre", "studio", "festival_grounds",
    ],
    "public_services_civic": [
        "police", "fire_station", "post_office", "post_box", "townhall", "courthouse", "prison", "archive",
    ],
    "transport_car": [
        "parking", "parking_space", "parking_entrance", "fuel", "car_wash", "car_rental",
        "vehicle_inspection", "taxi",
    ],
    "transport_public": ["bus_station", "ferry_terminal", "taxi"],
    "sustainable_transport": [
        "bicycle_parking", "bicycle_rental", "bicycle_repair_station", "car_sharing",
        "charging_station", "motorcycle_parking", "motorcycle_rental",
    ],
    "childcare_early_years": ["childcare", "kindergarten"],
    "elderly_care": ["nursing_home", "retirement_home"],
    "public_amenities_environment": [
        "bench", "fountain", "drinking_water", "water_point", "toilets", "public_bath", "shelter",
        "public_bookcase", "clock", "telephone", "bbq",
    ],
    "waste_sanitation": [
        "recycling", "waste_basket", "waste_disposal", "waste_transfer_station",
        "sanitary_dump_station", "grit_bin",
    ],
    "religious_spiritual": ["place_of_worship", "grave_yard"],
    "higher_education_research": ["university", "college", "research_institute"],
    "professional_services": ["coworking_space", "conference_centre", "workshop", "training"],
    "retail_commerce": ["marketplace", "vending_machine", "atm", "parcel_locker"],
    "essential_services": [
        "hospital", "pharmacy", "post_office", "police", "fire_station", "doctors", "dentist",
    ],
    "social_support": ["social_facility", "animal_shelter", "childcare", "nursing_home", "retirement_home"],
}

# Fixed values: (numerator group, denominator group).
RATIO_PAIRS = [
    ("fast_food_takeaway", "food_dining"),
    ("alcohol_gambling", "cultural_entertainment"),
    ("alcohol_gambling", "financial_services"),
    ("fast_food_takeaway", "healthcare_access"),
    ("sustainable_transport", "transport_car"),
    ("financial_services", "alcohol_gambling"),
    ("cultural_entertainment", "fast_food_takeaway"),
    ("education_skills", "alcohol_gambling"),
    ("higher_education_research", "fast_food_takeaway"),
    ("professional_services", "community_social"),
    ("childcare_early_years", "alcohol_gambling"),
    ("public_amenities_environment", "alcohol_gambling"),
    ("healthcare_access", "alcohol_gambling"),
    ("essential_services", "alcohol_gambling"),
]

# How old the newest row of a source may be, in days.
FRESHNESS_DAYS = {"monthly": 28, "quarterly": 90, "annual": 365}

# British national grid (Airy 1830 ellipsoid, transverse Mercator) and
# the published seven-parameter shift from WGS84 to OSGB36.
WGS84_A = 6378137.0
WGS84_B = 6356752.314245
AIRY_A = 6377563.396
AIRY_B = 6356256.909
GRID_F0 = 0.9996012717
GRID_LAT0_DEG = 49.0
GRID_LON0_DEG = -2.0
GRID_E0 = 400000.0
GRID_N0 = -100000.0
SHIFT_TX = -446.448
SHIFT_TY = 125.157
SHIFT_TZ = -542.060
SHIFT_SCALE_PPM = 20.4894
SHIFT_RX_SEC = -0.1502
SHIFT_RY_SEC = -0.2470
SHIFT_RZ_SEC = -0.8421

# Fixed value: metres per degree used when a bounding box is widened.
METRES_PER_DEGREE = 111000
