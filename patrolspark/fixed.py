"""These must equal the analysed system's for equal results.

Every other module imports them from here; nothing below is derived.
"""

# Season bands: a band starts on the given month-day (MMdd) and runs up to
# the next band's start, exclusive.
WINTER_START = 1221
SPRING_START = 321
SUMMER_START = 621
AUTUMN_START = 921

# Periods of the day: night from 20:00 up to 08:00, day from 08:00 up to 20:00.
NIGHT_START_HHMM = 2000
DAY_START_HHMM = 800

# Label values.
SEASON_NAMES = ("winter", "spring", "summer", "autumn")
PERIOD_NAMES = ("night", "day")

# The first analysis compares these two seasons; the second reports this
# many codes.
FIRST_ANALYSIS_SEASONS = ("winter", "summer")
TOP_CODES = 5

# Raw police lines: comma-separated, a comma inside double quotes is not a
# separator; date at position 4 (MM/dd/yyyy), code at 5, clock at 19
# (hhmm followed by A or P); files end in ".csv".
LINE_SPLIT_REGEX = ',(?=(?:[^"]*"[^"]*")*[^"]*$)'
RAW_DATE_POSITION = 4
RAW_CODE_POSITION = 5
RAW_CLOCK_POSITION = 19
RAW_SUFFIX = "csv"
DATE_SEPARATOR = "/"
AFTERNOON_MARK = "P"
MORNING_MARK = "A"

# Topics and keys: parsed historic records travel under one key on their own
# topic; live drone messages use three keys on another.
HISTORIC_TOPIC = "CSV_INTEGRATION"
HISTORIC_KEY = "CSV_INTEGRATION"
LIVE_TOPIC = "DRONE_MESSAGE"
STANDARD_KEY = "STANDARD_MESSAGE"
VIOLATION_KEY = "VIOLATION_MESSAGE"
IMAGE_KEY = "VIOLATION_IMAGE"

# Alerts: subject, placeholder for a missing value, date format and body.
ALERT_SUBJECT = "Violation Alert"
ALERT_UNKNOWN = "Unknown"
ALERT_DATE_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"
ALERT_BODY = (
    "New Violation Occured\n"
    "Violation Code: {code}\n"
    "Occurring Date: {date}\n"
    "Latitude : {lat}\n"
    "Longitude : {lng}\n"
    "Drone ID: {drone}\n"
    "Violation Image: {image}\n"
    "\n"
    "\n"
    "-- SENT FROM ALERT HANDLER SYSTEM --\n"
)
