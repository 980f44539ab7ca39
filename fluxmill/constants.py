"""Names, thresholds and weights that results depend on."""

# Fallback fills when a column has no usable mean.
DEFAULT_INCOME = 55000.0
DEFAULT_CART_VALUE = 50.0

# (exclusive upper edge, label); values on or above the last edge get the final label.
AGE_EDGES = [(25, "youth"), (40, "young_adult"), (60, "middle_aged")]
AGE_LAST = "senior"
INCOME_EDGES = [(30000, "low"), (70000, "medium"), (150000, "high")]
INCOME_LAST = "very_high"

DEVICES = ["mobile", "desktop", "tablet"]
DEVICE_WEIGHTS = [0.55, 0.35, 0.10]
REGIONS = ["north", "south", "east", "west", "central"]
REGION_WEIGHTS = [0.20, 0.25, 0.20, 0.20, 0.15]

EVENT_TYPES = ["page_view", "click", "add_to_cart", "purchase", "search"]
EVENT_WEIGHTS = [0.45, 0.25, 0.15, 0.05, 0.10]
UNKNOWN_TYPE = "unknown"
CART_TYPES = ["add_to_cart", "purchase"]

# Stream defaults, in seconds.
WINDOW_SEC = 30
MAX_LAG_SEC = 10

PERCENTS = [50, 95, 99]
LOAD_RATES = [100, 1000, 5000]
