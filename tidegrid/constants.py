"""Fixed values of the domain. They decide results, so they are stated here once."""

# Study area, both ends inclusive (degrees).
AREA_LON = (-6.0, 37.0)
AREA_LAT = (32.0, 45.0)

# The Sicily channel splits the western from the eastern sea.
CHANNEL_LAT = 37.2
CHANNEL_LON = 11.2
SEA_WEST = "Occidentale"
SEA_EAST = "Orientale"

# Grid edges in tenths of a degree: first edge, step, last edge index.
# Latitude edges 32.0, 33.2 ... 44.0; longitude edges -6.0, -4.9 ... 36.9.
LAT_EDGES_TENTHS = (320, 12, 10)
LON_EDGES_TENTHS = (-60, 11, 39)
GRID_LETTERS = "ABCDEFGHIJ"
GRID_COLUMNS = 40
OFF_GRID = "Error!"

# Ship-type classes, bounds inclusive; all else is OTHERS.
CLASS_35 = (35, 35)
CLASS_60_69 = (60, 69)
CLASS_70_79 = (70, 79)
LABEL_35 = "35"
LABEL_60_69 = "60-69"
LABEL_70_79 = "70-79"
LABEL_OTHERS = "Others"

# Day slots.
NOON_HOUR = 12
SLOT_AM = "00:00-11:59"
SLOT_PM = "12:00-23:59"

# Window lengths in days, ranking depth, watermark delay, date label.
WEEK_DAYS = 7
MONTH_DAYS = 31
TOP_N = 3
WATERMARK_DELAY = "60 seconds"
WINDOW_LABEL_PATTERN = "EEE MMM dd"

# Text timestamps of the raw log and of the normalised text log.
RAW_SLASH_PATTERNS = ("d/M/yy H:mm", "d/M/yyyy H:mm")
RAW_DASH_PATTERNS = ("d-M-yy H:mm", "d-M-yyyy H:mm")
TEXT_LOG_PATTERN = "EEE MMM dd HH:mm:ss z yyyy"
