"""Names, orders, widths and defaults that results depend on."""

# ---- Fixed values -------------------------------------------------------------------------------

# Event columns
EVENT_NUMERIC = ["product_qty", "product_price"]
VISIT_NUMERIC = ["duration", "nb_pages", "unique_pages", "latitude", "longitude"]
PRODUCT_NUMERIC = ["product_rating", "product_nb_of_ratings"]
ENGINEERED = ["delta_time"]
INDICATOR_COLUMNS = ["event_env", "device"]
CODED_COLUMNS = ["product_department", "product_category", "product_sub_category"]

# Calendar categories, in slot order
WEEK_DAYS = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]
MONTHS = [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12]
MONTH_NAMES = ["January", "February", "March", "April", "May", "June", "July", "August",
               "September", "October", "November", "December"]

# Category clean-up: values read as missing, and values renamed, after trim and lower case
MISSING_CATEGORIES = ["unknown", "?"]
CATEGORY_RENAMES = {
    "mobile": "mobile phone",
    "computer": "desktop",
    "wearable": "mobile device",
    "game_console": "other",
    "dmr": "other",
}

# Width of the indicator blocks with a growing value list
INDICATOR_SLOTS = 10

# Values never added to a vocabulary, its first entry, and the first entry of a slot map
VOCABULARY_EXCLUDED = ["", "?"]
VOCABULARY_SEED = ("0", 0)
SLOT_SEED = ("", 0)

# File formats
VOCABULARY_FILE_COLUMNS = ("Categorical_values", "Labels")
DATE_FORMAT = "yyyyMMdd"
RETENTION_DAYS = 395

# Event types
PURCHASE = "purchase"
PRODUCT_PAGE = "product_page"

# Sequence length buckets
LENGTH_BOUNDS = [0, 10, 25, 45, 75, 120, 200]

# Padding of a batch
PAD_NUMERIC = -1.0
PAD_CODE = 0

# Explainer space: five numeric and twelve categorical features per step, one per sequence
SPACE_NUMERIC = ["product_price", "duration", "latitude", "longitude", "delta_time"]
SPACE_INDICATOR = ["week_day", "month", "event_env", "device"]
SPACE_SHIFTED = ["product_qty", "nb_pages", "unique_pages", "product_rating", "product_nb_of_ratings"]
SPACE_CATEGORICAL = SPACE_INDICATOR + SPACE_SHIFTED + CODED_COLUMNS
SPACE_FIXED = ["inactivity"]
POSITIVE = ["product_price", "duration", "delta_time"]

# Feature families used when weights are summed
FAMILIES = {
    "week_day": "week_days",
    "month": "months",
    "event_env": "event_env",
    "device": "devices",
    "latitude": "geo_loc",
    "longitude": "geo_loc",
}

# ---- End of fixed values ------------------------------------------------------------------------

# Columns of one event, in the order of the 49-wide numeric vector
NUMERIC_COLUMNS = EVENT_NUMERIC + VISIT_NUMERIC + PRODUCT_NUMERIC + ENGINEERED
INDICATOR_BLOCKS = {
    "week_day": (0, len(WEEK_DAYS)),
    "month": (len(WEEK_DAYS), len(MONTHS)),
    "event_env": (len(WEEK_DAYS) + len(MONTHS), INDICATOR_SLOTS),
    "device": (len(WEEK_DAYS) + len(MONTHS) + INDICATOR_SLOTS, INDICATOR_SLOTS),
}
NUMERIC_OFFSET = len(WEEK_DAYS) + len(MONTHS) + 2 * INDICATOR_SLOTS
N_INPUT = NUMERIC_OFFSET + len(NUMERIC_COLUMNS)
NUMERIC_POSITION = {c: NUMERIC_OFFSET + i for i, c in enumerate(NUMERIC_COLUMNS)}
SPACE_STEP = SPACE_NUMERIC + SPACE_CATEGORICAL
SPACE_ALL = SPACE_STEP + SPACE_FIXED
