"""Names, codes, zones and limits that results must agree with. Plain data, no logic."""

# Feed spelling -> canonical participant name.
NAME_ALIASES = {
    "Cape Verde": "Cabo Verde",
    "Curaçao": "Curacao",
    "Czech Republic": "Czechia",
    "Iran": "IR Iran",
    "Ivory Coast": "Cote d'Ivoire",
    "Turkey": "Turkiye",
    "United States": "USA",
}

# Round code -> stage name, in playing order.
STAGES = {
    "group": "Group Stage",
    "r32": "Round of 32",
    "r16": "Round of 16",
    "qf": "Quarter Final",
    "sf": "Semi Final",
    "third": "Third Place",
    "final": "Final",
}

# Round code -> (position prefix, number of positions in the top half, id offset).
ROUNDS = {
    "r32": ("R32", 8, 72),
    "r16": ("R16", 4, 88),
    "qf": ("QF", 2, 96),
    "sf": ("SF", 1, 100),
    "third": ("3rd", 0, 0),
    "final": ("Final", 0, 0),
}

# Round-of-32 match ids in bracket order; neighbours meet in the next round.
R32_ORDER = ["73", "75", "74", "77", "82", "81", "84", "83", "76", "78", "79", "80", "85", "87", "88", "86"]

# Venue id -> (city, country, zone abbreviation, hours west of UTC).
VENUE_ZONES = {
    "1": ("Mexico City", "Mexico", "CST", 6),
    "2": ("Guadalajara", "Mexico", "MST", 7),
    "3": ("Monterrey", "Mexico", "CST", 6),
    "4": ("Dallas", "USA", "CDT", 5),
    "5": ("Houston", "USA", "CDT", 5),
    "6": ("Kansas City", "USA", "CDT", 5),
    "7": ("Atlanta", "USA", "EDT", 4),
    "8": ("Miami", "USA", "EDT", 4),
    "9": ("Boston", "USA", "EDT", 4),
    "10": ("Philadelphia", "USA", "EDT", 4),
    "11": ("New York", "USA", "EDT", 4),
    "12": ("Toronto", "Canada", "EDT", 4),
    "13": ("Vancouver", "Canada", "PDT", 7),
    "14": ("Seattle", "USA", "PDT", 7),
    "15": ("San Francisco", "USA", "PDT", 7),
    "16": ("Los Angeles", "USA", "PDT", 7),
}

# Venue zone id -> abbreviation appended to local times; the default is the Eastern zone.
ZONE_ABBREVIATIONS = {
    "America/Chicago": "CDT",
    "America/Los_Angeles": "PDT",
    "America/Mexico_City": "CDT",
    "America/Monterrey": "CDT",
    "America/New_York": "EDT",
    "America/Toronto": "EDT",
    "America/Vancouver": "PDT",
}
DEFAULT_ZONE = "America/New_York"

# Fewest rows each table must have before a load may replace it.
MINIMUM_ROWS = {"players": 50, "teams": 40, "matches": 90, "group_standings": 50, "stadiums": 15, "knockout_bracket": 25}

# Display marks.
MEDALS = {1: "🥇", 2: "🥈", 3: "🥉"}
EVENT_ICON = "⚽"
PENALTY_ICON = "⚽ (PEN)"

# Local time text, as MM/dd/yyyy HH:mm.
LOCAL_TIME_PATTERN = r"^(\d{2})/(\d{2})/(\d{4}) (\d{2}:\d{2})$"
ZONE_SUFFIX_PATTERN = r" [A-Z]{3,4}$"
