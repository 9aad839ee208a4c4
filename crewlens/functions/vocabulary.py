"""Fixed values shared by the column builders.

Everything here is plain data of a fixed size; nothing grows with the input.
"""

# Career tracks, each listed from the top rung down to rung 1.
TRACKS = {
    "boh-main": [
        "event chef", "banquet cook", "line cook", "prep cook", "food assembler", "dishwasher",
    ],
    "boh-pastry": [
        "event chef", "banquet cook", "baker/pastry cook", "food assembler", "dishwasher",
    ],
    "foh-support": [
        "banquet captain", "banquet server", "restaurant server", "foh support",
        "concession worker", "event help",
    ],
    "foh-assistant": [
        "banquet captain", "banquet server", "restaurant server", "server assistant",
        "food runner", "coat check attendant",
    ],
    "bar": ["mixologist", "bartender", "beer & wine bartender", "barback"],
    "facilities-maintenance": ["housekeeping", "maintenance", "general laborer"],
    "facilities-cleaning": ["housekeeping", "general cleaning", "banquet setup"],
    "barista": ["barista"],
    "stage": ["stage"],
}

# Spellings that stand for a ladder skill.
SKILL_ALIASES = {
    "food assembler": ["food service worker"],
    "event help": ["event staff"],
    "foh support": ["front of house support", "front of house support staff"],
    "coat check attendant": ["coat check"],
    "baker/pastry cook": ["bakery/pastry cook", "bakery & pastry cook"],
    "bartender": ["full-service bartender", "full service bartender"],
    "beer & wine bartender": [
        "beer and wine bartender", "b&w bartender", "b+w bartender", "bartender - fixed menu",
    ],
    "general laborer": ["general labor"],
}

# Phrases that show a skill in a profile text, per skill.
SKILL_PHRASES = {
    "event chef": ["event chef"],
    "banquet cook": ["banquet cook", "event cook", "banquet chef"],
    "line cook": ["line cook"],
    "prep cook": ["prep cook", "food prep"],
    "baker/pastry cook": ["baker", "bakery", "pastry"],
    "food assembler": ["food assembler", "food service", "cafeteria"],
    "dishwasher": ["dishwasher", "dish washer", "dishwashing"],
    "banquet captain": ["banquet captain"],
    "banquet server": ["banquet server", "event server"],
    "restaurant server": ["restaurant server"],
    "foh support": ["foh support", "front of house"],
    "concession worker": ["concession"],
    "event help": ["event help", "event staff"],
    "server assistant": ["server assistant"],
    "food runner": ["food runner"],
    "coat check attendant": ["coat check"],
    "mixologist": ["mixologist"],
    "bartender": ["full-service bartender", "full service bartender"],
    "beer & wine bartender": ["bartender"],
    "barback": ["barback"],
    "housekeeping": ["housekeeping", "housekeeper"],
    "maintenance": ["maintenance"],
    "general laborer": ["general labor", "laborer"],
    "general cleaning": ["general cleaning", "cleaner", "cleaning"],
    "banquet setup": ["banquet setup", "event setup"],
    "barista": ["barista"],
    "stage": ["stage"],
}

# A bare phrase that counts for a skill only when none of the others is present.
GUARDED_PHRASES = {
    "bartender": (
        "bartender",
        ["beer & wine bartender", "beer and wine bartender", "bartender - fixed menu"],
    ),
}

# Badge columns (without the cert_ prefix) that show a skill.
SKILL_BADGES = {
    "event chef": ["event_chef"],
    "banquet cook": ["event_cook"],
    "line cook": ["line_cook"],
    "prep cook": ["prep_cook"],
    "baker/pastry cook": ["baker_pastry"],
    "food assembler": ["food_assembler"],
    "dishwasher": ["dishwasher"],
    "banquet captain": ["banquet_captain"],
    "banquet server": ["event_server"],
    "restaurant server": ["restaurant_server"],
    "foh support": ["foh_support"],
    "concession worker": ["concession_worker"],
    "event help": ["event_help"],
    "server assistant": ["server_assistant"],
    "food runner": ["food_runner"],
    "coat check attendant": ["coat_check_attendant"],
    "mixologist": ["mixologist"],
    "bartender": ["bartender_full_service"],
    "beer & wine bartender": ["beer_wine", "fixed_menu"],
    "barback": ["barback"],
    "housekeeping": ["housekeeping"],
    "maintenance": ["maintenance"],
    "general laborer": ["general_labor"],
    "general cleaning": ["general_cleaning"],
    "banquet setup": ["event_setup"],
    "barista": ["barista"],
    "stage": ["stage"],
}
BADGES = [badge for badges in SKILL_BADGES.values() for badge in badges]

WEEKDAYS = ["MONDAY", "TUESDAY", "WEDNESDAY", "THURSDAY", "FRIDAY", "SATURDAY", "SUNDAY"]

# Day spellings in a schedule cell; the first two letters identify the day.
DAY_TOKENS = [
    "MONDAY", "MON", "TUESDAY", "TUES", "TUE", "WEDNESDAY", "WED", "THURSDAY", "THURS", "THUR",
    "THU", "FRIDAY", "FRI", "SATURDAY", "SAT", "SUNDAY", "SUN",
]

# Zone labels in a schedule cell.
ZONE_LABELS = {
    "EST": "America/New_York",
    "EDT": "America/New_York",
    "ET": "America/New_York",
    "MNL": "Asia/Manila",
    "PHT": "Asia/Manila",
}


def ladder_rows() -> list[tuple[str, str, int]]:
    """(track, skill_key, tier) rows; the lowest rung of a track is tier 1."""
    return [
        (track, skill, len(rungs) - depth)
        for track, rungs in TRACKS.items()
        for depth, skill in enumerate(rungs)
    ]


def qualifying_skills(skill: str) -> list[str]:
    """The skill itself and every skill above it in any track they share."""
    found: list[str] = []
    for rungs in TRACKS.values():
        if skill in rungs:
            found += [s for s in rungs[: rungs.index(skill) + 1] if s not in found]
    return found
