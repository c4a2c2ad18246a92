"""Normalization of names and addresses as Column expressions; nothing here leaves the JVM.

Folding to ASCII follows tables made from the Unicode character database by rule: accents drop, letters of Indic scripts
become the consonant or vowel their name spells without the inherent vowel, letters of other alphabets the sound their name
begins with, syllables of Korean and Japanese their name, digits become digits. Characters without a rule (Chinese ones: their
names tell no sound) stay and act as separators.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that a core name drops.
LEGAL = (
    "inc incorporated corp corporation co company cos llc llp lp ltd limited pvt private plc pc pllc pa sa sas sasu sarl sci eurl ei snc scp gmbh ag "
    "group groupe the of and et de du des la le les ms dba aka fka www com net org in fr us a an at by esq"
).split()
# Words whose skeleton marks a transliterated legal word.
LEGAL_SPOKEN = ("private", "limited", "corporation", "company", "incorporated", "llp", "llc")
# One spelling for name words.
NAME_WORDS = {
    "pvt": "private", "ltd": "limited", "corp": "corporation", "co": "company", "inc": "incorporated",
    "intl": "international", "mfg": "manufacturing", "svcs": "services", "svc": "services", "mgmt": "management",
    "assoc": "associates", "assn": "association", "bros": "brothers", "ctr": "center", "centre": "center",
    "tech": "technologies", "natl": "national", "dept": "department", "univ": "university", "hosp": "hospital",
    "cie": "compagnie", "ste": "societe", "st": "saint",
}
# One spelling for address words.
ADDRESS_WORDS = {
    "street": "st", "str": "st", "saint": "st", "road": "rd", "avenue": "av", "ave": "av", "boulevard": "bd",
    "blvd": "bd", "boul": "bd", "drive": "dr", "lane": "ln", "court": "ct", "place": "pl", "circle": "cir",
    "highway": "hwy", "parkway": "pkwy", "pky": "pkwy", "terrace": "ter", "trail": "trl", "square": "sq",
    "suite": "ste", "apartment": "apt", "building": "bldg", "floor": "fl", "flr": "fl", "north": "n",
    "south": "s", "east": "e", "west": "w", "near": "nr", "opposite": "opp", "number": "no", "rue": "r",
    "chemin": "ch", "impasse": "imp", "allee": "all", "route": "rte", "faubourg": "fbg", "mount": "mt",
    "fort": "ft", "county": "cty", "cnty": "cty", "township": "twp", "sector": "sec", "nagar": "ngr",
    "colony": "col", "marg": "mg", "extension": "ext", "cross": "crs", "main": "mn", "block": "blk",
    "plot": "plt", "house": "h", "hno": "h", "flat": "flt", "way": "wy", "point": "pt", "heights": "hts",
    "center": "ctr", "centre": "ctr", "expressway": "expy", "freeway": "fwy", "junction": "jct",
}
# Patterns.
BLANKS = r"(?i)<null>|\bn/?a\b|\bnull\b|\bnone\b"
SITE = r"(?:https?://)?(?:www\.)?([a-z0-9][a-z0-9-]*)\.(?:com|in|net|org|co|fr|us|biz|info|io)\b"
ORDINAL = r"^(\d+)(?:st|nd|rd|th)$"
PHONE = r"^\d{7,}$"
# The skeleton's replacements, in order, and its letters.
DIGRAPHS = (("ph", "f"), ("gh", "g"), ("kh", "k"), ("bh", "b"), ("dh", "d"), ("th", "t"), ("sh", "s"), ("ch", "c"), ("ck", "k"), ("jh", "j"))
LETTERS_FROM, LETTERS_TO = "cqzvmaeiouyh", "kkswn"
# Letters that decomposition leaves alone.
SPECIAL = {"ß": "ss", "ẞ": "ss", "æ": "ae", "Æ": "ae", "œ": "oe", "Œ": "oe", "ø": "o", "Ø": "o", "đ": "d", "Đ": "d", "ł": "l", "Ł": "l", "þ": "th", "Þ": "th", "ð": "d", "Ð": "d", "ı": "i", "°": "deg"}
COMMON = ("ß", "æ", "œ", "Æ", "Œ", "°")
INDIC = ("DEVANAGARI", "BENGALI", "GURMUKHI", "GUJARATI", "ORIYA", "TAMIL", "TELUGU", "KANNADA", "MALAYALAM")
# Scripts whose letters' names begin with the letter's sound, words of names that do not, and sounds that are written otherwise.
NAMED = ("GREEK", "HEBREW", "ARABIC", "ARMENIAN", "GEORGIAN", "THAI")
MARKS_OF_FORM = ("FINAL", "FARSI", "SMALL", "CAPITAL", "YIDDISH", "SWASH")
SPELT = {"rho": "r", "tcheh": "ch", "thal": "dh", "xeh": "kh", "upsilon": "y", "keheh": "k"}
# The Cyrillic alphabets' letters, whose names do not tell them apart so simply.
CYRILLIC = {
    "а": "a", "б": "b", "в": "v", "г": "g", "д": "d", "е": "e", "ж": "zh", "з": "z", "и": "i", "й": "y", "к": "k", "л": "l",
    "м": "m", "н": "n", "о": "o", "п": "p", "р": "r", "с": "s", "т": "t", "у": "u", "ф": "f", "х": "kh", "ц": "ts", "ч": "ch",
    "ш": "sh", "щ": "shch", "ъ": "", "ы": "y", "ь": "", "э": "e", "ю": "yu", "я": "ya", "ё": "yo", "є": "ye", "і": "i", "ї": "yi",
    "ґ": "g", "ђ": "dj", "ј": "j", "љ": "lj", "њ": "nj", "ћ": "c", "џ": "dz", "ў": "w", "ѓ": "g", "ѕ": "dz", "ќ": "k",
}
# Japanese syllables whose common spelling differs from their character's name.
KANA = {"si": "shi", "ti": "chi", "tu": "tsu", "hu": "fu", "zi": "ji", "di": "ji", "du": "zu"}
# The leading, middle and final sounds of Korean syllables in the order of their code points.
KOREAN = (
    "g gg n d dd r m b bb s ss - j jj c k t p h".replace("-", "").split(" "),
    "a ae ya yae eo e yeo ye o wa wae oe yo u weo we wi yu eu yi i".split(" "),
    "- g gg gs n nj nh d l lg lm lb ls lt lp lh m b bs s ss ng j c k t p h".replace("-", "").split(" "),
)
KOREAN_FROM, KOREAN_TO = 0xAC00, 0xD7A3


def lettered(char: str, name: str) -> str | None:
    """ASCII for a letter of a script other than Latin and the Indic ones, or None."""
    kind = unicodedata.category(char)
    if name.startswith("CYRILLIC"):
        low = char.lower()
        return CYRILLIC.get(low, CYRILLIC.get(unicodedata.normalize("NFD", low)[0]))
    if name.startswith("HANGUL SYLLABLE"):
        return name.split()[-1].lower()
    if (kana := unicodedata.name(unicodedata.normalize("NFKC", char)[0], "")).startswith(("HIRAGANA LETTER", "KATAKANA LETTER")):
        sound = kana.split()[-1].lower()
        return KANA.get(sound, sound)
    if "PROLONGED SOUND MARK" in name:
        return ""
    if name.startswith("THAI") and "SARA" in name:
        return re.sub(r"(.)\1+", r"\1", name.split()[3].lower())
    if name.startswith(NAMED) and kind[0] == "L":
        words = [w for w in re.split("LETTER |CHARACTER |LIGATURE ", name)[-1].split() if w not in MARKS_OF_FORM]
        word = words[0].lower() if words else ""
        return SPELT.get(word) or (re.match("[aeiou]|[^aeiou]+", word) or [None])[0]
    return None


def folded(char: str) -> str | None:
    """ASCII for one non-ASCII character, or None."""
    if char in SPECIAL:
        return SPECIAL[char]
    if (digit := unicodedata.digit(char, None)) is not None:
        return str(digit)
    name = unicodedata.name(char, "")
    if (sound := lettered(char, name)) is not None:
        return sound
    if name.startswith(INDIC):
        *_, kind, sound = ["", *name.replace("VOWEL SIGN", "SIGN").split()]
        if kind == "LETTER" or kind == "SIGN" and "VOWEL" in name:
            s = sound.lower()
            s = s[:-1] if kind == "LETTER" and len(s) > 1 and s[-1] == "a" and s[0] not in "aeiou" else s
            return "".join(c for i, c in enumerate(s) if not i or c != s[i - 1])
        if sound in ("ANUSVARA", "CANDRABINDU", "BINDI"):
            return "n"
        return "" if unicodedata.category(char)[0] == "M" else None
    if unicodedata.category(char)[0] == "M":
        return ""
    plain = "".join(c for c in unicodedata.normalize("NFKD", char) if not unicodedata.combining(c))
    return plain.lower() if plain.isascii() and plain.strip() else None


@lru_cache(maxsize=1)
def whole_fold_table() -> dict[str, str]:
    """:func:`fold_table` with the Korean syllables, for use outside the JVM."""
    return fold_table() | {chr(c): folded(chr(c)) for c in range(KOREAN_FROM, KOREAN_TO + 1)}


@lru_cache(maxsize=1)
def fold_table() -> dict[str, str]:
    """character -> ASCII over the blocks that have rules, but for Korean syllables, which :func:`korean` computes."""
    blocks = (
        (0xA0, 0x250), (0x300, 0x700), (0x900, 0xD80), (0xE00, 0xE80), (0x10A0, 0x1100), (0x1C90, 0x1CC0),
        (0x1E00, 0x2000), (0x2000, 0x2070), (0x3040, 0x3100), (0xFF00, 0xFFA0),
    )
    found = {chr(c): folded(chr(c)) for lo, hi in blocks for c in range(lo, hi)}
    return {k: v for k, v in found.items() if v is not None}


def is_ascii(s: Column) -> Column:
    return ~s.rlike(r"[^\x00-\x7F]")


def korean(c: Column) -> Column:
    """The spelling of one Korean syllable, null for other characters."""
    at = F.ascii(c) - F.lit(KOREAN_FROM)
    middle, final = len(KOREAN[1]), len(KOREAN[2])
    places = (F.floor(at / (middle * final)), F.floor(at / final) % middle, at % final)
    spelt = F.concat(*[F.get(F.split(F.lit(" ".join(x)), " "), p.cast("int")) for x, p in zip(KOREAN, places, strict=True)])
    return F.when((at >= 0) & (at <= KOREAN_TO - KOREAN_FROM), spelt)


def ascii_fold(s: Column) -> Column:
    """Lower-case ASCII. Characters with one letter or none are translated by hash lookup; those with several are replaced,
    the rarer of them only in rows that hold one."""
    pairs = fold_table()
    one = {k: v for k, v in pairs.items() if len(v) == 1}
    none = [k for k, v in pairs.items() if not v]
    several = {k: v for k, v in pairs.items() if len(v) > 1}
    out = F.translate(s, "".join(one) + "".join(none), "".join(one.values()))
    for k in COMMON:
        out = F.replace(out, F.lit(k), F.lit(several.pop(k)))
    lookup = F.str_to_map(F.lit(",".join(f"{k}:{v}" for k, v in several.items())))
    walked = F.array_join(F.transform(F.split(out, ""), lambda c: F.coalesce(F.try_element_at(lookup, c), korean(c), c)), "")
    return F.lower(F.when(is_ascii(s), s).otherwise(F.when(is_ascii(out), out).otherwise(walked)))


def blank_nulls(s: Column) -> Column:
    return F.regexp_replace(s, BLANKS, " ")


def site_label(s: Column) -> Column:
    """Web addresses become their host's label."""
    return F.regexp_replace(s, SITE, " $1 ")


def number_token(t: Column) -> Column:
    t = F.regexp_replace(t, ORDINAL, "$1")
    return F.when(t.rlike(r"^\d+$"), F.regexp_replace(t, r"^0+(?=\d)", "")).otherwise(t)


def _words(s: Column) -> Column:
    return F.filter(F.split(s, "[^a-z0-9]+"), lambda t: t != "")


def _canonical(t: Column, synonyms: dict[str, str]) -> Column:
    lookup = F.create_map(*[F.lit(x) for kv in synonyms.items() for x in kv])
    return F.coalesce(F.try_element_at(lookup, t), number_token(t))


def name_tokens(raw: Column) -> Column:
    s = F.replace(blank_nulls(ascii_fold(raw)), F.lit("&"), F.lit(" and "))
    s = F.translate(site_label(s), ".'", "")
    return F.transform(F.filter(_words(s), lambda t: ~t.rlike(PHONE)), lambda t: _canonical(t, NAME_WORDS))


def address_tokens(raw: Column) -> Column:
    s = F.replace(blank_nulls(ascii_fold(raw)), F.lit("&"), F.lit(" and "))
    return F.transform(_words(F.translate(s, "'", "")), lambda t: _canonical(t, ADDRESS_WORDS))


def skeleton(t: Column) -> Column:
    """Phonetic consonant skeleton of a token; empty for numbers."""
    s = t
    for a, b in DIGRAPHS:
        s = F.replace(s, F.lit(a), F.lit(b))
    s = F.translate(F.replace(s, F.lit("x"), F.lit("ks")), LETTERS_FROM, LETTERS_TO)
    return F.when(t.rlike(r"^\d+$"), F.lit("")).otherwise(F.regexp_replace(s, r"(.)\1+", "$1"))


def skeleton_text(t: str) -> str:
    """:func:`skeleton` of one constant."""
    for a, b in DIGRAPHS:
        t = t.replace(a, b)
    t = t.replace("x", "ks").translate(str.maketrans(LETTERS_FROM[: len(LETTERS_TO)], LETTERS_TO, LETTERS_FROM[len(LETTERS_TO) :]))
    return "".join(c for i, c in enumerate(t) if not i or c != t[i - 1])


def core_tokens(tokens: Column, foreign: Column) -> Column:
    """Name tokens without legal words, nor, in names not in ASCII, words that sound like one."""
    legal = F.array(*[F.lit(x) for x in LEGAL])
    spoken = F.array(*[F.lit(x) for x in sorted({skeleton_text(w) for w in LEGAL_SPOKEN})])
    return F.filter(tokens, lambda t: ~F.array_contains(legal, t) & ~(foreign & F.array_contains(spoken, skeleton(t))))


def char_ngrams(s: Column, n: int) -> Column:
    """Distinct character n-grams; none for shorter strings."""
    grams = F.transform(F.sequence(F.lit(1), F.length(s) - n + 1), lambda i: F.substring(s, i, F.lit(n)))
    return F.when(F.length(s) >= n, F.array_distinct(grams)).otherwise(F.array().cast("array<string>"))


def tokens_of(s: Column) -> Column:
    """Space-separated tokens; none for an empty string."""
    return F.filter(F.split(s, " "), lambda t: t != "")
