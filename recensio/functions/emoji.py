"""Emoji pattern and aliases, both usable inside whole-stage expressions."""

from __future__ import annotations

import json
import re
import unicodedata
from functools import lru_cache

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Code points with the Unicode property Emoji (digits, '#' and '*' only count
# as keycaps), as inclusive hexadecimal ranges.
EMOJI_RANGES = (
    "A9 AE 203C 2049 2122 2139 2194-2199 21A9-21AA 231A-231B 2328 23CF 23E9-23F3 23F8-23FA 24C2 "
    "25AA-25AB 25B6 25C0 25FB-25FE 2600-2604 260E 2611 2614-2615 2618 261D 2620 2622-2623 2626 262A "
    "262E-262F 2638-263A 2640 2642 2648-2653 265F-2660 2663 2665-2666 2668 267B 267E-267F 2692-2697 "
    "2699 269B-269C 26A0-26A1 26A7 26AA-26AB 26B0-26B1 26BD-26BE 26C4-26C5 26C8 26CE-26CF 26D1 "
    "26D3-26D4 26E9-26EA 26F0-26F5 26F7-26FA 26FD 2702 2705 2708-270D 270F 2712 2714 2716 271D 2721 "
    "2728 2733-2734 2744 2747 274C 274E 2753-2755 2757 2763-2764 2795-2797 27A1 27B0 27BF 2934-2935 "
    "2B05-2B07 2B1B-2B1C 2B50 2B55 3030 303D 3297 3299 1F004 1F0CF 1F170-1F171 1F17E-1F17F 1F18E "
    "1F191-1F19A 1F201-1F202 1F21A 1F22F 1F232-1F23A 1F250-1F251 1F300-1F321 1F324-1F393 1F396-1F397 "
    "1F399-1F39B 1F39E-1F3F0 1F3F3-1F3F5 1F3F7-1F4FD 1F4FF-1F53D 1F549-1F54E 1F550-1F567 1F56F-1F570 "
    "1F573-1F57A 1F587 1F58A-1F58D 1F590 1F595-1F596 1F5A4-1F5A5 1F5A8 1F5B1-1F5B2 1F5BC 1F5C2-1F5C4 "
    "1F5D1-1F5D3 1F5DC-1F5DE 1F5E1 1F5E3 1F5E8 1F5EF 1F5F3 1F5FA-1F64F 1F680-1F6C5 1F6CB-1F6D2 "
    "1F6D5-1F6D7 1F6DC-1F6E5 1F6E9 1F6EB-1F6EC 1F6F0 1F6F3-1F6FC 1F7E0-1F7EB 1F7F0 1F90C-1F93A "
    "1F93C-1F945 1F947-1F9FF 1FA70-1FA7C 1FA80-1FA89 1FA8F-1FAC6 1FACE-1FADC 1FADF-1FAE9 1FAF0-1FAF8"
)

# Common aliases that differ from the Unicode character name (fixed values).
COMMON_ALIASES = {
    "👍": "thumbs_up", "👎": "thumbs_down", "👏": "clapping_hands", "🙏": "folded_hands",
    "💪": "flexed_biceps", "👌": "OK_hand", "✌": "victory_hand", "👋": "waving_hand",
    "🙌": "raising_hands", "🤝": "handshake", "👊": "oncoming_fist", "✊": "raised_fist",
    "👆": "backhand_index_pointing_up", "👇": "backhand_index_pointing_down",
    "👈": "backhand_index_pointing_left", "👉": "backhand_index_pointing_right",
    "☝": "index_pointing_up", "✋": "raised_hand", "🖕": "middle_finger", "🤞": "crossed_fingers",
    "😀": "grinning_face", "😃": "grinning_face_with_big_eyes", "😄": "grinning_face_with_smiling_eyes",
    "😁": "beaming_face_with_smiling_eyes", "😆": "grinning_squinting_face",
    "😅": "grinning_face_with_sweat", "🤣": "rolling_on_the_floor_laughing",
    "😂": "face_with_tears_of_joy", "🙂": "slightly_smiling_face", "🙃": "upside-down_face",
    "😉": "winking_face", "😊": "smiling_face_with_smiling_eyes", "😇": "smiling_face_with_halo",
    "🥰": "smiling_face_with_hearts", "😍": "smiling_face_with_heart-eyes", "🤩": "star-struck",
    "😘": "face_blowing_a_kiss", "☺": "smiling_face", "😋": "face_savoring_food",
    "😛": "face_with_tongue", "😜": "winking_face_with_tongue", "🤗": "smiling_face_with_open_hands",
    "🤔": "thinking_face", "🤨": "face_with_raised_eyebrow", "😐": "neutral_face",
    "😑": "expressionless_face", "😶": "face_without_mouth", "😏": "smirking_face",
    "😒": "unamused_face", "🙄": "face_with_rolling_eyes", "😬": "grimacing_face",
    "😌": "relieved_face", "😔": "pensive_face", "😪": "sleepy_face", "😴": "sleeping_face",
    "🤢": "nauseated_face", "🤮": "face_vomiting", "🥵": "hot_face", "😵": "face_with_crossed-out_eyes",
    "🤯": "exploding_head", "😎": "smiling_face_with_sunglasses", "😕": "confused_face",
    "😟": "worried_face", "🙁": "slightly_frowning_face", "☹": "frowning_face",
    "😮": "face_with_open_mouth", "😲": "astonished_face", "😳": "flushed_face",
    "🥺": "pleading_face", "😨": "fearful_face", "😰": "anxious_face_with_sweat",
    "😥": "sad_but_relieved_face", "😢": "crying_face", "😭": "loudly_crying_face",
    "😱": "face_screaming_in_fear", "😖": "confounded_face", "😞": "disappointed_face",
    "😓": "downcast_face_with_sweat", "😩": "weary_face", "😫": "tired_face",
    "😤": "face_with_steam_from_nose", "😡": "enraged_face", "😠": "angry_face",
    "🤬": "face_with_symbols_on_mouth", "💀": "skull", "💩": "pile_of_poo", "🤡": "clown_face",
    "❤": "red_heart", "💔": "broken_heart", "💙": "blue_heart", "💚": "green_heart",
    "💛": "yellow_heart", "💜": "purple_heart", "🖤": "black_heart", "💯": "hundred_points",
    "💥": "collision", "⭐": "star", "🌟": "glowing_star", "✨": "sparkles", "🔝": "TOP_arrow",
    "🔥": "fire", "🎉": "party_popper", "💰": "money_bag", "💸": "money_with_wings",
    "💳": "credit_card", "📱": "mobile_phone", "✅": "check_mark_button", "✔": "check_mark",
    "❌": "cross_mark", "⚠": "warning", "❗": "red_exclamation_mark", "❓": "red_question_mark",
    "‼": "double_exclamation_mark", "🔴": "red_circle", "🆗": "OK_button", "🔒": "locked",
    "🚀": "rocket", "⏰": "alarm_clock", "⏳": "hourglass_not_done", "👀": "eyes",
}
SKIN_TONES = {
    "🏻": "light_skin_tone",
    "🏼": "medium-light_skin_tone",
    "🏽": "medium_skin_tone",
    "🏾": "medium-dark_skin_tone",
    "🏿": "dark_skin_tone",
}

# Names of sequences (fixed values): whole ones, by the object that a person
# holds, and by the act that a gender sign follows.
SEQUENCES = {
    "🏳‍🌈": "rainbow_flag", "🏳‍⚧": "transgender_flag", "🏴‍☠": "pirate_flag",
    "❤‍🔥": "heart_on_fire", "❤‍🩹": "mending_heart", "👁‍🗨": "eye_in_speech_bubble",
    "😮‍💨": "face_exhaling", "😵‍💫": "face_with_spiral_eyes", "😶‍🌫": "face_in_clouds",
    "🐕‍🦺": "service_dog", "🐈‍⬛": "black_cat", "🐦‍⬛": "black_bird", "🐻‍❄": "polar_bear",
    "🧑‍🎄": "Mx_Claus", "🧑‍🤝‍🧑": "people_holding_hands", "👩‍🤝‍👩": "women_holding_hands",
    "👨‍🤝‍👨": "men_holding_hands", "👩‍🤝‍👨": "woman_and_man_holding_hands",
}
PEOPLE = {"👨": "man", "👩": "woman", "🧑": "person", "👦": "boy", "👧": "girl"}
ROLES = {
    "⚕": "health_worker", "⚖": "judge", "✈": "pilot", "🌾": "farmer", "🍳": "cook", "🎓": "student",
    "🎤": "singer", "🎨": "artist", "🏫": "teacher", "🏭": "factory_worker", "💻": "technologist",
    "💼": "office_worker", "🔧": "mechanic", "🔬": "scientist", "🚀": "astronaut", "🚒": "firefighter",
}
HELD = {
    "🦯": "with_white_cane", "🦼": "in_motorized_wheelchair", "🦽": "in_manual_wheelchair",
    "🍼": "feeding_baby",
}
HAIR = {"🦰": "red_hair", "🦱": "curly_hair", "🦲": "bald", "🦳": "white_hair"}
ACTS = {
    "🏃": "running", "🚶": "walking", "🤷": "shrugging", "🤦": "facepalming", "🙋": "raising_hand",
    "🙅": "gesturing_NO", "🙆": "gesturing_OK", "💁": "tipping_hand", "🙇": "bowing", "🙍": "frowning",
    "🙎": "pouting", "💆": "getting_massage", "💇": "getting_haircut", "🏊": "swimming", "🏄": "surfing",
    "🚣": "rowing_boat", "🚴": "biking", "🚵": "mountain_biking", "🤸": "cartwheeling", "🤹": "juggling",
    "🤽": "playing_water_polo", "🤾": "playing_handball", "🧍": "standing", "🧎": "kneeling",
    "🧖": "in_steamy_room", "🧗": "climbing", "🧘": "in_lotus_position", "🏋": "lifting_weights",
    "🏌": "golfing", "⛹": "bouncing_ball",
}
TAGGED = {"gbeng": "England", "gbsct": "Scotland", "gbwls": "Wales"}

_TAG = r"\x{1F3F4}[\x{E0030}-\x{E007A}]+\x{E007F}"
_FLAG = r"[\x{1F1E6}-\x{1F1FF}]{2}"
_KEYCAP = r"[0-9#*]\x{FE0F}?\x{20E3}"
_SKIN = r"[\x{1F3FB}-\x{1F3FF}]"


def _bounds() -> list[tuple[int, int]]:
    out = []
    for part in EMOJI_RANGES.split():
        first, _, last = part.partition("-")
        out.append((int(first, 16), int(last or first, 16)))
    return out


def _pattern() -> str:
    base = "[" + "".join(rf"\x{{{a:X}}}-\x{{{b:X}}}" for a, b in _bounds()) + "]"
    one = rf"{base}\x{{FE0F}}?{_SKIN}?"
    return rf"(?:{_TAG}|{_FLAG}|{_KEYCAP}|{one}(?:\x{{200D}}{one})*)"


#: The look-ahead turns letters away before the long character class is tried.
EMOJI_RE = r"(?=[0-9#*\x{A9}\x{AE}\x{203C}-\x{1FAFF}])" + _pattern()


def alias_table() -> dict[str, str]:
    """Alias of every single emoji: the fixed value, else the Unicode name."""
    table = {}
    for first, last in _bounds():
        for point in range(first, last + 1):
            name = unicodedata.name(chr(point), "")
            if name:
                table[chr(point)] = re.sub(r"[^a-z0-9-]+", "_", name.lower()).strip("_")
    for digit in "0123456789#*":
        table[digit] = f"keycap_{digit}"
    for point in range(0x1F1E6, 0x1F200):
        table[chr(point)] = chr(ord("a") + point - 0x1F1E6)
    return {**table, **SKIN_TONES, **COMMON_ALIASES}


def sequence_table() -> dict[str, str]:
    """Name of every known sequence, without variation selectors and skin tones."""
    join = "\u200d"
    table = dict(SEQUENCES)
    adults = {c: n for c, n in PEOPLE.items() if n in ("man", "woman", "person")}
    for sign, who in adults.items():
        for thing, role in ROLES.items():
            table[sign + join + thing] = role if who == "person" else f"{who}_{role}"
        for thing, what in HELD.items():
            table[sign + join + thing] = f"{who}_{what}"
        for thing, hair in HAIR.items():
            table[sign + join + thing] = f"{who}_{hair}"
    for act, name in ACTS.items():
        table[act + join + "♀"] = f"woman_{name}"
        table[act + join + "♂"] = f"man_{name}"
    for a, one in adults.items():
        for b, other in adults.items():
            table[join.join((a, "❤", b))] = f"couple_with_heart_{one}_{other}"
            table[join.join((a, "❤", "💋", b))] = f"kiss_{one}_{other}"
    return table


def _map(table: dict[str, str]) -> Column:
    return F.from_json(F.lit(json.dumps(table, ensure_ascii=False)), "map<string,string>")


def _aliases() -> Column:
    return _map(alias_table())


@lru_cache(maxsize=1)
def region_names() -> dict[str, str]:
    """English name of each country code, as the Java runtime's locale data has it."""
    locale = SparkSession.active()._jvm.java.util.Locale
    names = {code: locale("", code).getDisplayCountry(locale.ENGLISH) for code in locale.getISOCountries()}
    return {code.lower(): name.replace(" ", "_") for code, name in names.items()}


_PEOPLE = "[" + "".join(PEOPLE) + "]"


def _sequence(emoji: Column, names: Column) -> Column:
    """Name of a joined sequence or tagged flag, null if it has none of its own.

    The distinct skin tones follow the name. People joined to people, with
    nothing else between them, are a family.
    """
    plain = F.regexp_replace(emoji, rf"\x{{FE0F}}|{_SKIN}", "")
    tones = F.array_distinct(F.regexp_extract_all(emoji, F.lit(_SKIN), F.lit(0)))
    skin = _map(SKIN_TONES)
    toned = F.array_join(F.transform(tones, lambda t: F.concat(F.lit("_"), skin[t])), "")
    family = plain.rlike(rf"^{_PEOPLE}(?:\x{{200D}}{_PEOPLE})+$")
    joined = F.coalesce(_map(sequence_table())[plain], F.when(family, F.concat(F.lit("family_"), names)))
    code = F.regexp_extract_all(emoji, F.lit(r"[\x{E0030}-\x{E007A}]"), F.lit(0))
    letters = _map({chr(0xE0000 + ord(c)): c for c in "0123456789abcdefghijklmnopqrstuvwxyz"})
    code = F.array_join(F.transform(code, lambda t: letters[t]), "")
    tagged = F.coalesce(_map(TAGGED)[code], F.concat(F.lit("flag_"), code))
    return F.when(emoji.rlike(_TAG), tagged).when(emoji.contains("\u200d"), F.concat(joined, toned))


def _alias(emoji: Column, aliases: Column) -> Column:
    """``:name:`` of one match; parts of a sequence without a name of its own are joined by ``_``."""
    parts = F.regexp_extract_all(emoji, F.lit(r"[^\x{FE0F}\x{200D}\x{20E3}]"), F.lit(0))
    names = F.array_join(F.transform(parts, lambda p: F.coalesce(aliases[p], p)), "_")
    code = F.replace(names, F.lit("_"), F.lit(""))
    regions = _map(region_names())
    flag = F.when(emoji.rlike(_FLAG), F.coalesce(regions[code], F.concat(F.lit("flag_"), code)))
    return F.concat(F.lit(":"), F.coalesce(flag, _sequence(emoji, names), names), F.lit(":"))


def emoji_to_alias(text: Column) -> Column:
    """Replace each emoji by its alias with a space on both sides."""
    aliases = _aliases()

    def replaced(plain: Column) -> Column:
        between = F.split(plain, EMOJI_RE, -1)
        found = F.regexp_extract_all(plain, F.lit(EMOJI_RE), F.lit(0))
        words = F.transform(found, lambda e: F.concat(F.lit(" "), _alias(e, aliases), F.lit(" ")))
        joined = F.zip_with(between, words, lambda b, w: F.concat(b, F.coalesce(w, F.lit(""))))
        return F.array_join(joined, "")

    return F.when(text.rlike(EMOJI_RE), replaced(text)).otherwise(text)


def emoji_list(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(EMOJI_RE), F.lit(0))


def emoji_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(EMOJI_RE))
