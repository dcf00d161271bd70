"""Normalising text: keys for matching, cleaning for display, addresses, URLs, phones.  Built-in expressions unless noted."""

from __future__ import annotations

import difflib
import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

#: Characters that are never shown.
INVISIBLE = r"[\x{200B}-\x{200F}\x{202A}-\x{202E}\x{2060}-\x{2064}\x{FEFF}\x{00AD}]"
CONTROL = r"[\x{00}-\x{08}\x{0B}\x{0C}\x{0E}-\x{1F}\x{7F}-\x{9F}]"
#: Both, in one pass: a character that isn't printable ASCII, then whether it is one of them.
HIDDEN = rf"[^ -~](?<=[{INVISIBLE[1:-1]}{CONTROL[1:-1]}])"
#: Empty brackets, found by their first character.
EMPTY_BRACKETS = r"[(\[](?:(?<=\()\s*\)|(?<=\[)\s*\])"
EMOJI = r"[\x{1F000}-\x{1FAFF}\x{2600}-\x{27BF}\x{2B00}-\x{2BFF}\x{FE0F}\x{20E3}]"
ARABIC = r"[\x{0600}-\x{06FF}\x{0750}-\x{077F}\x{FB50}-\x{FDFF}\x{FE70}-\x{FEFF}]"
CJK = r"[\x{3040}-\x{30FF}\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{AC00}-\x{D7AF}]"
ARABIC_MARKS, PLAIN_MARKS = "،؛؟٪", ",;?%"
BRAND_WORDS = ("restaurant", "restaurants", "cafe", "llc", "ltd", "limited", "inc", "the", "branch")
OWNER_WORDS = ("inc", "llc", "ltd", "limited", "plc", "group", "holdings", "corp", "corporation", "company", "co")
COUNTRY_WORDS = ("united arab emirates", "uae", "u a e")


def _once(x: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of a value that is worked out once, however often ``f`` names it; ``f`` takes no Python functions."""
    return F.get(F.transform(F.array(x), f), 0)


def collapsed(x: Column) -> Column:
    """Runs of white space, Unicode's included, as one space; trimmed."""
    return F.trim(F.regexp_replace(x, r"(?U)\s+", " "))


def item_key(x: Column) -> Column:
    """Lower case, trimmed, white space collapsed."""
    return collapsed(F.lower(x))


def match_key(x: Column) -> Column:
    """Lower case, every mark and underscore a space, collapsed."""
    return collapsed(F.regexp_replace(F.lower(x), r"(?U)[^\w\s]|_", " "))


@pandas_udf(StringType())
def folded(x: pd.Series) -> pd.Series:
    """Compatibility form without combining marks: é becomes e."""
    return x.map(lambda s: None if s is None else "".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c)))


def _plain_letters() -> tuple[str, str]:
    """Letters whose compatibility form is one ASCII character and marks, and that character."""
    pairs = [(chr(k), "".join(c for c in unicodedata.normalize("NFKD", chr(k)) if not unicodedata.combining(c))) for k in (*range(0xA0, 0x250), *range(0x1E00, 0x1F00), *range(0xFF01, 0xFF5F))]
    kept = [(c, plain) for c, plain in pairs if len(plain) == 1 and plain.isascii()]
    return "".join(c for c, _ in kept), "".join(plain for _, plain in kept)


def latin_folded(x: Column) -> Column:
    """As ``folded`` for Latin letters, within the JVM, so that it may stand in any expression."""
    return F.translate(F.regexp_replace(x, r"\p{M}", ""), *_plain_letters())


@pandas_udf(StringType())
def composed(x: pd.Series) -> pd.Series:
    """Compatibility composed form (NFKC)."""
    return x.map(lambda s: None if s is None else unicodedata.normalize("NFKC", s))


#: Pictures, arrows, variation selectors, joiners and keycaps, which don't count in a comparison.
PICTURES = r"[\x{1F000}-\x{1FAFF}\x{2600}-\x{27BF}\x{2190}-\x{21FF}\x{2B00}-\x{2BFF}\x{FE00}-\x{FE0F}\x{200D}\x{20E3}]"


def compared(x: Column) -> Column:
    """A text as it is compared, never stored: compatibility form, without pictures, white space collapsed; null is empty.

    Texts of ASCII alone skip the first step.
    """
    plain = F.coalesce(x, F.lit(""))
    special = composed(F.when(plain.rlike(r"[^\x00-\x7F]"), plain))
    return collapsed(F.regexp_replace(F.coalesce(special, plain), PICTURES, ""))


@pandas_udf(StringType())
def unmangled(x: pd.Series) -> pd.Series:
    """UTF-8 that was read as Latin-1, read again; others as they are."""

    def one(s: str | None) -> str | None:
        if s is None or not any(c in s for c in "ÃÂâØÙ"):
            return s
        try:
            return s.encode("cp1252").decode("utf-8")
        except UnicodeError:
            return s

    return x.map(one)


def without_words(x: Column, words: tuple[str, ...]) -> Column:
    return collapsed(F.regexp_replace(x, r"\b(" + "|".join(words) + r")\b", " "))


def brand_key(x: Column, fold: bool = True) -> Column:
    """A brand's key: what stands before a comma, bar or spaced dash, folded, without marks, legal and generic words."""
    head = F.regexp_replace(x, r"\s*(,|\||\s-\s).*$", "")
    return without_words(match_key(folded(head) if fold else head), BRAND_WORDS)


def owner_key(x: Column) -> Column:
    """An owner's key: without corporate suffixes."""
    return F.array_join(F.filter(F.split(match_key(x), " "), lambda w: ~w.isin(*OWNER_WORDS)), " ")


#: Written ordinals.
ORDINALS = (("first", "1"), ("second", "2"), ("third", "3"), ("fourth", "4"), ("fifth", "5"), ("sixth", "6"), ("seventh", "7"), ("eighth", "8"), ("ninth", "9"), ("tenth", "10"))


def area_key(x: Column, fold: bool = True) -> Column:
    """An area's key: ordinals as digits, no article, only letters and digits."""
    out = F.lower(folded(x) if fold else x)
    for word, digit in ORDINALS:
        out = F.regexp_replace(out, rf"\b{word}\b", digit)
    out = F.regexp_replace(out, r"\b(\d+)(st|nd|rd|th)\b", "$1")
    return F.regexp_replace(F.regexp_replace(out, r"\bal[\s-]+", ""), r"[^a-z0-9]", "")


def address_key(x: Column) -> Column:
    """An address's key: no country, marks as spaces."""
    return without_words(match_key(x), COUNTRY_WORDS)


def shown(x: Column, emoji: bool = False) -> Column:
    """Text as shown: no invisible or control characters, Arabic marks as plain ones, emoji as spaces unless kept; empty is null."""
    out = F.regexp_replace(x, HIDDEN, "")
    for mark, plain in zip(ARABIC_MARKS, PLAIN_MARKS, strict=True):
        out = F.replace(out, F.lit(mark), F.lit(plain))
    out = out if emoji else F.regexp_replace(out, EMOJI, " ")
    return _once(collapsed(out), lambda s: F.nullif(s, F.lit("")))


def finished(x: Column) -> Column:
    """Edge separators trimmed and empty brackets dropped; a value is never made empty.

    Each step is written once and its time grows with the text, however long a run of separators is.
    """
    out = _once(shown(x, True), lambda s: F.when(s.rlike(EMPTY_BRACKETS), F.regexp_replace(F.regexp_replace(s, EMPTY_BRACKETS, ""), " {2,}", " ")).otherwise(s))
    out = F.trim(out, F.lit(" ,;|/-"))
    return F.get(F.filter(F.array(out, x), lambda s, k: (s != "") | (k == 1)), 0)


def english_part(x: Column) -> Column:
    """Of a bilingual name the half in Latin script, else the text without Arabic and CJK."""
    first = F.get(F.filter(F.split(x, r"\s+[|/\-–]\s+"), lambda p: p.rlike("[A-Za-z]") & ~p.rlike(f"{ARABIC}|{CJK}")), F.lit(0))
    stripped = F.nullif(collapsed(F.regexp_replace(x, f"{ARABIC}|{CJK}", " ")), F.lit(""))
    return F.when(x.rlike(f"{ARABIC}|{CJK}"), F.coalesce(first, stripped, x)).otherwise(x)


#: Words in capitals.
CAPITALS = ("BBQ", "KFC", "UAE", "USA", "UK", "XL", "II", "III", "TV")


def title_case(x: Column, capitals: tuple[str, ...] = CAPITALS) -> Column:
    """Each word with a capital; listed words in capitals; what stands after an apostrophe stays small."""
    words = F.transform(F.split(collapsed(x), " "), lambda w: F.when(F.upper(w).isin(*capitals), F.upper(w)).otherwise(F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substring(w, 2, 1_000_000)))))
    return F.array_join(words, " ")


def slug(x: Column, mark: str = "-", fold: bool = True) -> Column:
    """Letters and digits, joined by ``mark``."""
    out = F.regexp_replace(F.lower(folded(x) if fold else x), "[^a-z0-9]+", mark)
    return F.regexp_replace(out, f"^{mark}+|{mark}+$", "")


def name_of_slug(x: Column) -> Column:
    return F.initcap(F.replace(x, F.lit("-"), F.lit(" ")))


def slug_tail(url_slug: Column, name: Column) -> Column:
    """What a URL's slug says beyond the name, usually the area; null if it doesn't begin with the name."""
    own = F.concat(slug(name, fold=False), F.lit("-"))
    return F.when(F.startswith(url_slug, own), F.substr(url_slug, F.length(own) + 1))


def segments(address: Column) -> Column:
    """An address's parts, trimmed, empty ones dropped."""
    return F.filter(F.transform(F.split(address, ","), lambda s: F.trim(s)), lambda s: s != "")


def area_shaped(x: Column) -> Column:
    """Whether a part of an address may be an area: letters, not a street, direction, building, unit or code."""
    no = r"(?i)\b(street|st|road|rd|avenue|ave|hotel|tower|building|mall|shop|floor|near|opposite|behind|north|south|east|west)\b|^[A-Z0-9]{4}\+[A-Z0-9]{2,3}|^\d+$"
    return x.rlike("[A-Za-z]{3}") & ~x.rlike(no)


def address_parts(address: Column, cities: tuple[str, ...]) -> Column:
    """struct(city, area, sublocality), read from the end: the last known city, then the areas before it."""
    parts = segments(address)
    lower = F.transform(parts, lambda s: F.lower(s))
    at = F.array_max(F.transform(F.array(*map(F.lit, cities)), lambda c: F.array_position(lower, c)))
    before = F.filter(F.slice(parts, 1, F.greatest(F.coalesce(at, F.lit(0)).cast("int") - 1, F.lit(0))), area_shaped)
    return F.struct(F.when(at > 0, F.element_at(parts, F.greatest(at, F.lit(1)).cast("int"))).alias("city"), F.try_element_at(before, F.lit(-1)).alias("area"), F.try_element_at(before, F.lit(-2)).alias("sublocality"))


def first_of(x: Column, rules: list[tuple[str, str]], default: Column | None = None) -> Column:
    """The value of the first rule whose pattern the text holds."""
    out = F.lit(None).cast("string") if default is None else default
    for pattern, value in reversed(rules):
        out = F.when(x.rlike(pattern), F.lit(value)).otherwise(out)
    return out


def german_city(address: Column) -> Column:
    """The city after a five-digit postal code, else after a country code and postal code, else the last part."""
    tries = [r"\b\d{5}\s+([A-Za-zÄÖÜäöüß][A-Za-zÄÖÜäöüß .\-]*)", r"\bD-\d{5}\s+([A-Za-zÄÖÜäöüß][A-Za-zÄÖÜäöüß .\-]*)", r",\s*([A-Za-zÄÖÜäöüß][A-Za-zÄÖÜäöüß .\-]*)\s*,\s*(?:Germany|Deutschland)\s*$", r",\s*([A-Za-zÄÖÜäöüß][A-Za-zÄÖÜäöüß .\-]*)\s*$"]
    return F.coalesce(*[F.nullif(F.trim(F.regexp_extract(address, p, 1)), F.lit("")) for p in tries])


def cid_only(url: Column) -> Column:
    """A map link with its ``cid`` alone; others as they are."""
    cid = F.regexp_extract(url, r"[?&]cid=(\d+)", 1)
    return F.when(cid != "", F.concat(F.regexp_replace(url, r"\?.*$", ""), F.lit("?cid="), cid)).otherwise(url)


def domain(url: Column) -> Column:
    """The host in lower case without ``www.``."""
    return F.nullif(F.regexp_replace(F.lower(F.regexp_extract(url, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*://)?([^/:?#]+)", 1)), r"^www\.", ""), F.lit(""))


def without_query(url: Column) -> Column:
    return F.regexp_replace(url, r"[?#].*$", "")


def last_number(url: Column) -> Column:
    """The last number of a URL's path."""
    return F.regexp_extract(without_query(url), r"(\d+)(?!.*\d)", 1).try_cast("long")


def phone(x: Column, country: str = "971", trunk: str = "0") -> Column:
    """+country and digits; null if there are fewer than 7."""
    digits = F.regexp_replace(x, r"\D", "")
    digits = F.regexp_replace(digits, f"^(00)?{country}|^{trunk}", "")
    return F.when(F.length(digits) >= 7, F.concat(F.lit(f"+{country}"), digits))


def made_up_phone(x: Column) -> Column:
    """Six digits the same, or a run of six in order, up or down."""
    digits = F.regexp_replace(x, r"\D", "")
    runs = [("0123456789" * 2)[k : k + 6] for k in range(10)]
    return digits.rlike(r"(\d)\1{5,}") | digits.rlike("|".join(runs + [r[::-1] for r in runs]))


def no_junk(x: Column) -> Column:
    """Line ends, hard spaces and ``mailto:`` out."""
    return collapsed(F.regexp_replace(F.regexp_replace(x, r"[\r\n\t\x{00A0}]+|&nbsp;", " "), r"(?i)mailto:", ""))


def significant(x: Column, stop: tuple[str, ...] = BRAND_WORDS) -> Column:
    """Words of three letters and more that are no stop words."""
    return F.array_distinct(F.filter(F.split(match_key(x), " "), lambda w: (F.length(w) > 2) & ~w.isin(*stop)))


def singular(x: Column) -> Column:
    """The plain English singular of a word."""
    return (
        F.when(x.rlike("(?i)[^aeiou]ies$"), F.regexp_replace(x, "(?i)ies$", "y"))
        .when(x.rlike("(?i)(ss|us|is)$"), x)
        .when(x.rlike("(?i)(sh|ch|x|z|s)es$"), F.regexp_replace(x, "(?i)es$", ""))
        .when(x.rlike("(?i)oes$"), F.regexp_replace(x, "(?i)es$", ""))
        .otherwise(F.regexp_replace(x, "(?i)s$", ""))
    )


def head_noun(x: Column, containers: tuple[str, ...] = ("box", "plate", "bowl", "platter", "pack", "cup"), cuts: tuple[str, ...] = ("with", "in", "and", "from", "on")) -> Column:
    """The noun that a dish is: what stands before a joining word, without containers at the end."""
    words = F.split(match_key(x), " ")
    at = F.array_min(F.filter(F.transform(F.array(*map(F.lit, cuts)), lambda c: F.array_position(words, c)), lambda p: p > 1))
    head = F.slice(words, 1, F.coalesce(at - 1, F.size(words).cast("long")).cast("int"))
    plain = F.filter(head, lambda w: ~w.isin(*containers) & ~w.rlike(r"^\d+$"))
    return F.try_element_at(plain, F.lit(-1))


@pandas_udf(StringType())
def text_diff(before: pd.Series, after: pd.Series) -> pd.Series:
    """A unified diff, at most 2,000 characters, which is the feature."""
    return pd.Series(["\n".join(difflib.unified_diff((a or "").splitlines(), (b or "").splitlines(), lineterm=""))[:2000] for a, b in zip(before, after, strict=True)])


#: Cities that an address may name; towns within another's emirate stand first.
CITIES = ("Al Ain", "Khor Fakkan", "Kalba", "Dubai", "Abu Dhabi", "Sharjah", "Ajman", "Ras Al Khaimah", "Fujairah", "Umm Al Quwain")
#: Other spellings of them; what an address may end in; roads named after a city.
CITY_FORMS = ((r"\bras\s*al\s*khaim(?:a|ah)\b", "Ras Al Khaimah"), (r"\bumm\s*al\s*(?:quwain|qaiwain|qaywayn)\b", "Umm Al Quwain"), (r"\bkhor\s*fakkan\b", "Khor Fakkan"), (r"\bal\s*fujairah\b", "Fujairah"))
COUNTRY_END = r",?\s*(united arab emirates|u\.a\.e\.?|uae)\s*$"
CITY_ROADS = r"\bal ain\s+(?:rd|road|hwy|highway)\b"
#: Towns and the city whose segment they may stand before.
TOWNS = (("Abu Dhabi", "Al Ain", r"\bal ain\b"), ("Sharjah", "Khor Fakkan", r"\bkhor\s*fakkan\b"), ("Sharjah", "Kalba", r"\bkalba\b"))
#: Sections that list items again.
POPULAR = ("picks for you", "popular", "best seller")


def emirate(address: Column) -> Column:
    """The city that an address names: its last segment (of six) that is one, or the town before it; else the first of the list anywhere in it.

    Segments are parted by dashes and commas; hyphens within a word don't part them.
    Words of the list count whole, in whatever case, and not in the name of a road.
    ``Unknown`` without one, for a null too.
    """
    said = F.regexp_replace(F.coalesce(address, F.lit("")), r"(?U)(?<=\w)-(?=\w)", " ")
    for form, city in CITY_FORMS:
        said = F.regexp_replace(said, f"(?i){form}", city)
    bare = F.regexp_replace(F.regexp_replace(said, f"(?i){COUNTRY_END}", ""), "^[, -]+|[, -]+$", "")
    parts = F.filter(F.transform(F.split(bare, r"\s*[-,]\s*"), lambda x: F.trim(x)), lambda x: x != "")
    tail = F.slice(parts, F.greatest(F.size(parts) - 5, F.lit(1)), F.lit(6))
    known = F.create_map(*[x for c in CITIES for x in (F.lit(c.lower()), F.lit(c))])
    at = F.array_max(F.transform(tail, lambda x, k: F.when(F.map_contains_key(known, F.lower(x)), k + 1).otherwise(0)))
    city = F.when(at > 0, F.try_element_at(known, F.lower(F.try_element_at(tail, F.nullif(at, F.lit(0))))))
    before = F.regexp_replace(F.array_join(F.slice(tail, F.lit(1), F.greatest(at - 1, F.lit(0))), " "), f"(?i){CITY_ROADS}", "")
    town = F.coalesce(*[F.when((city == c) & (at > 1) & before.rlike(f"(?i){p}"), t) for c, t, p in TOWNS])
    anywhere = first_of(F.regexp_replace(said, f"(?i){CITY_ROADS}", " "), [(rf"(?i)\b\Q{c}\E\b", c) for c in CITIES])
    return F.coalesce(town, city, anywhere, F.lit("Unknown"))


def last_known_city(address: Column, cities: tuple[str, ...] = CITIES) -> Column:
    """The last segment (parted by `` - ``) of an address that is a known city, in whatever case; null if none is."""
    known = F.create_map(*[x for c in cities for x in (F.lit(c.lower()), F.lit(c))])
    found = F.filter(F.transform(F.split(address, " - "), lambda x: F.try_element_at(known, F.lower(F.trim(x)))), lambda x: x.isNotNull())
    return F.try_element_at(found, F.lit(-1))


def slug_tail(url: Column, name: Column) -> Column:
    """What a listing's slug says after its name, as words: the area; null where the slug doesn't begin with the name."""
    slug = F.trim(F.replace(F.regexp_extract(url, r"([^/?#]*)(?:[?#].*)?$", 1), F.lit("-"), F.lit(" ")))
    own = collapsed(F.regexp_replace(F.lower(name), "[^a-z0-9 ]", " "))
    return F.when((own != "") & F.startswith(F.lower(slug), own), F.nullif(F.trim(F.substring(slug, F.length(own) + 1, F.length(slug))), F.lit("")))


def popular(section: Column, words: tuple[str, ...] = POPULAR) -> Column:
    """Whether a section's name says that it repeats items of others; a null one doesn't."""
    return F.coalesce(F.lower(section).rlike("|".join(words)), F.lit(False))
