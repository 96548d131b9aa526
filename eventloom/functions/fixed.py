"""Lists, tables and patterns whose content decides results."""

# Words that do not count when titles are compared.
TITLE_STOPWORDS = ["the", "and", "of", "at", "presented", "by", "series", "race", "event", "annual", "bracket", "dragway", "raceway", "park"]

# Words that do not count when track names are compared.
TRACK_STOPWORDS = ["raceway", "race", "way", "park", "dragstrip", "drag", "strip", "motorsports", "the"]

# Words that put a title out of scope.
OUT_OF_SCOPE = ["banquet"]

# Words in a link that lead to event pages.
EVENT_PAGE_WORDS = ["event", "schedule", "race", "calendar", "upcoming", "news", "flyer", "announcement"]

# Image suffixes of crawled links, and of staged files (with gif).
CRAWL_IMAGES = [".jpg", ".jpeg", ".png", ".webp"]
STAGED_IMAGES = [".jpg", ".jpeg", ".png", ".webp", ".gif"]
# Where a shared folder is listed and its files are found.
FOLDER_VIEW = "https://drive.google.com/embeddedfolderview?id={folder_id}#list"
FILE_DOWNLOAD = "https://drive.google.com/uc?export=download&id={file_id}"
FOLDER_HOSTS = ("drive.google.com", "www.drive.google.com")

# Media types by suffix; anything else is jpeg.
MEDIA_TYPES = {".jpg": "image/jpeg", ".jpeg": "image/jpeg", ".png": "image/png", ".gif": "image/gif", ".webp": "image/webp"}

# Classes and series of the calendar listings.
CALENDAR_SERIES = "TMCCC"
CALENDAR_CLASSES = ["Stock Muscle", "Street Muscle", "King Muscle", "EV Muscle", "Competition Muscle", "Modified Muscle", "Electronics", "Pro Muscle", "Super Pro Muscle", "CA$H Bracket"]

# Least sizes of an image, delays and page limits by strategy, and the limits of a crawl.
MIN_IMAGE_SIDE = 400
DELAYS = {"bracketraces": 0.5, "racingjunk": 0.75}
MAX_PAGES = {"racingjunk": 10}
STRATEGIES = ["bracketraces", "myracepass", "racingjunk", "rss", "tmccc"]
PAGES_PER_TRACK = 6
HASH_DISTANCE = 10

# Event types of an extracted record.
EVENT_TYPES = ["bracket", "points_race", "test_n_tune", "no_prep", "grudge", "specialty", "test_day", "unknown"]

# Canonical track names and their aliases; of two aliases in a name the earlier counts.
TRACK_ALIASES = [
    ("Xtreme Raceway Park", ["XRP", "Xtreme Raceway"]),
    ("Texas Motorplex", ["TMP", "Motorplex", "Ennis Dragway"]),
    ("Yello Belly Drag Strip", ["YBDS", "Yello Belly"]),
    ("Tulsa Raceway Park", ["TRP"]),
    ("Bradenton Motorsports Park", ["BMP", "Bradenton Motorsports"]),
    ("South Georgia Motorsports Park", ["SGMP", "South Georgia Motorsports"]),
    ("zMAX Dragway", ["ZMAX Dragway", "zMax Dragway", "zMAX"]),
    ("Rockingham Dragway", ["The Rock"]),
    ("Galot Motorsports Park", ["GALOT", "Galot Motorsports"]),
    ("Maryland International Raceway", ["MIR"]),
    ("Kil-Kare Raceway", ["Kil Kare Raceway", "KilKare Raceway", "Kil Kare"]),
    ("Lucas Oil Indianapolis Raceway Park", ["IRP", "Indianapolis Raceway Park", "Lucas Oil Raceway"]),
    ("World Wide Technology Raceway", ["WWTR", "Gateway Motorsports Park", "Gateway Raceway"]),
    ("Brainerd International Raceway", ["BIR"]),
    ("The Strip at Las Vegas Motor Speedway", ["The Strip", "LVMS Strip", "Las Vegas Motor Speedway Strip"]),
    ("Sonoma Raceway", ["Infineon Raceway", "Sears Point", "Sears Point Raceway"]),
    ("Pacific Raceways", ["Pacific Raceway", "Seattle International Raceway", "SIR"]),
    ("Thunder Valley Raceway Park", ["TVRP", "Thunder Valley Raceway", "Thunder Valley"]),
]

# Id, name, city, state, phone, email, website of known tracks.
TRACK_CATALOG = [
    ("concho-valley-dragway-tx", "Concho Valley Dragway", "San Angelo", "TX", "325-610-6346", "peggy@wingermachine.com", "https://www.facebook.com/p/Concho-Valley-Dragway-61559877147976/"),
    ("houston-tx", "Houston Motorsports Park", "Houston", "TX", "281-594-7590", "dean@houstonmotorsportspark.com", "https://www.houstonmotorsportspark.com/wp/"),
    ("little-river-dragway-tx", "Little River Dragway", "Holland", "TX", "254-982-0119", None, "https://littleriverdragway.com/"),
    ("texas-motorplex-tx", "Texas Motorplex", "Ennis", "TX", "972-878-2641", "support@texasmotorplex.com", "http://www.texasmotorplex.com"),
    ("thunder-valley-ok", "Thunder Valley Raceway Park", "Lexington", "OK", "405-413-1522", None, "https://www.thundervalleyracewaypark.com"),
    ("westx-abilene-tx", "WestX Abilene Raceway", "Abilene", "TX", "325-266-4276", None, "https://www.waraceway.com/"),
    ("wichita-falls-tx", "Wichita Falls Raceway Park", "Iowa Park", "TX", "940-613-5359", None, "https://www.wichitaracewaypark.com"),
    ("xtreme-tx", "Xtreme Raceway Park", "Ferris", "TX", "972-544-3724", None, "https://www.xtremeracewaypark.com"),
]
# Other slugs of known tracks.
SLUG_ALIASES = {"xtreme": "xtreme-tx"}

# What a prompt says about missing years, and the name of the tool that a model calls.
DATE_HINT = "Today's date is {day}. If {subject} omits the year, default to {year} unless {subject} clearly indicates a different year."
ANSWER_TOOL = "store_event"

# The end of an address line that names a city and a state.
CITY_STATE = r"([A-Za-z][A-Za-z .'-]+?)\s*,?\s+([A-Z]{2})\s+\d{5}(?:-\d{4})?$"

# What the validation of a file says.
CHECK_PASSED, CHECK_FAILED, CHECK_ERROR = "Schema validation passed for {path}", "Schema validation failed for {path}:", "  - {path}: {message}"

# The names of a calendar card's parts.
CALENDAR_WIDE, CALENDAR_NARROW = "CALENDAR_BIGGER_SCREEN_CONTAINER", "CALENDAR_SMALLER_SCREEN_CONTAINER"
CALENDAR_PARTS = {"day": "CALENDAR_EVENT_DATE", "title": "CALENDAR_EVENT_TITLE", "time": "CALENDAR_EVENT_TIME", "text": "CALENDAR_DESC_TEXT"}
