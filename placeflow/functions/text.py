"""Column expressions for the place cleaners.

Everything is a builtin Catalyst expression. Unicode NFKC, which Spark has no function for,
is done in the JVM by the ICU library that Spark itself ships and uses for collations.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values that define the cleaned text (must match the source pipeline) ----
# characters deleted after NFKC: ASCII space and the ideographic space U+3000
SPACES = " 　"
# single-character rewrites: 臺 -> 台, 至 -> -, 之 -> -
CHAR_FROM = "臺至之"
CHAR_TO = "台--"
# road-section rewrites (四段 and higher are left alone)
SECTION_REWRITES = (("一段", "1段"), ("二段", "2段"), ("三段", "3段"))
# leading administrative prefixes removed, in this order, each at most once
CITY_PREFIX = "^.{2,3}[縣市]"
DISTRICT_PREFIX = "^.{2,4}[鄉鎮市區]"
VILLAGE_PREFIX = "^.{2,4}[村里]"
# Java's '.' also refuses \r and U+2028/9; (?d) leaves only \n out, as Python and RE2 do
JAVA_DOT_AS_PYTHON = "(?d)"
# anything that is not a Unicode decimal digit (Nd); Java, Python and RE2 agree on it
NON_DIGIT = r"\P{Nd}"


NON_ASCII = r"[^\x00-\x7F]"


def nfkc(c: Column | str) -> Column:
    """Unicode NFKC normal form (null stays null), by the Unicode version of Spark's ICU.

    Plain ASCII passes through; other strings are composed by ``Normalizer.compose(text, true)``.
    Spark takes such a call for non-deterministic: it is not copied by plan rules, and a filter
    on its result stays above it."""
    t = _col(c)
    composed = F.java_method(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), t, F.lit(True))
    return F.when(t.rlike(NON_ASCII), composed).otherwise(t)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_if_null(c: Column | str) -> Column:
    return F.coalesce(_col(c), F.lit(""))


def strip_spaces(c: Column) -> Column:
    return F.translate(c, SPACES, "")


def normalize_place_text(c: Column | str, strip_prefixes: bool = True) -> Column:
    """Name/address cleaner: '' for null, NFKC, drop spaces, fixed rewrites,
    then strip a leading city, district and village prefix.

    The prefix strips also hit names (士林夜市小吃 -> 小吃); that is the defined
    output. ``strip_prefixes=False`` turns them off.
    """
    t = nfkc(blank_if_null(c))
    # the three single-character rewrites and the space deletions in one pass
    # (translate maps by position; characters past the end of CHAR_TO are deleted)
    t = F.translate(t, CHAR_FROM + SPACES, CHAR_TO)
    for a, b in SECTION_REWRITES:
        t = F.replace(t, F.lit(a), F.lit(b))
    if strip_prefixes:
        for pat in (CITY_PREFIX, DISTRICT_PREFIX, VILLAGE_PREFIX):
            t = F.regexp_replace(t, JAVA_DOT_AS_PYTHON + pat, "")
    return t


def digits_only(c: Column) -> Column:
    return F.regexp_replace(c, NON_DIGIT, "")


def normalize_phone(c: Column | str) -> Column:
    """Phone cleaner: '' for null, NFKC, drop spaces; with a '#', digits of the
    part before the first '#' then '#' and the rest verbatim; else digits only."""
    t = strip_spaces(nfkc(blank_if_null(c)))
    pos = F.instr(t, "#")
    with_ext = F.concat(digits_only(F.substring_index(t, "#", 1)), F.lit("#"), F.substr(t, pos + 1))
    return F.when(pos > 0, with_ext).otherwise(digits_only(t))


def dedupe_key(phone: Column | str, address: Column | str) -> Column:
    """digits(phone) + '_' + address; an extension's digits stay in the key."""
    return F.concat(digits_only(blank_if_null(phone)), F.lit("_"), blank_if_null(address))


def full_address(address: Column | str, district: Column | str, city: Column | str) -> Column:
    """Put the district in front unless the address starts with it, then the
    city unless the result starts with it; blank parts are skipped."""
    a, d, c = blank_if_null(address), blank_if_null(district), blank_if_null(city)
    with_d = F.when((d != "") & ~F.startswith(a, d), F.concat(d, a)).otherwise(a)
    return F.when((c != "") & ~F.startswith(with_d, c), F.concat(c, with_d)).otherwise(with_d)


# finite decimal numbers only: no 'd'/'f' suffixes, no '_' separators, no NaN/inf
NUMERIC_TEXT = r"^\s*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def to_double_strict(c: Column | str) -> Column:
    """Text -> double with pandas ``to_numeric(errors='coerce')`` rules: bad -> NULL."""
    s = _col(c).cast("string")
    return F.when(s.rlike(NUMERIC_TEXT), F.trim(s).try_cast("double"))


def fill_string(c: Column | str) -> Column:
    """Cast to string and fill NULL with ''."""
    return F.coalesce(_col(c).cast("string"), F.lit(""))


def temp_id(city_code: Column | str, zip_code: Column | str, ind_code: Column | str, idx: Column | str) -> Column:
    """city_zip_ind_ + index zero-padded to at least 5 digits (6+ digit indexes kept whole)."""
    return F.format_string("%s_%s_%s_%05d", _col(city_code), _col(zip_code), _col(ind_code), _col(idx))


def tab_name(file_name: Column | str, limit: int = 50) -> Column:
    """Spreadsheet tab for a fragment: the name without '.parquet', cut to ``limit`` characters."""
    stem = F.replace(_col(file_name), F.lit(".parquet"), F.lit(""))
    return F.substring(stem, 1, limit)


# reply clean-up: code fences removed, whitespace trimmed, then keep from the header 'ID |' on
FENCE_TOKENS = ("```csv", "```")
# the characters Python's str.strip() treats as whitespace, as a regex class
PY_WHITESPACE = r"[\t\n\x{0B}\x{0C}\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
HEADER_FROM = r"(?s)(ID" + PY_WHITESPACE + r"*\|.*)"
TRIM_WS = "^" + PY_WHITESPACE + "+|" + PY_WHITESPACE + "+$"


def clean_response(c: Column | str) -> Column:
    t = blank_if_null(c)
    for tok in FENCE_TOKENS:
        t = F.replace(t, F.lit(tok), F.lit(""))
    t = F.regexp_replace(t, TRIM_WS, "")
    hit = F.regexp_extract(t, HEADER_FROM, 1)
    return F.when(hit != "", hit).otherwise(t)
