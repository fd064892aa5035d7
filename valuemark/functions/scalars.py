"""Scalar rules as Column expressions; none needs Python on the executors."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from valuemark.config import Settings

# Fixed values that results depend on.
GOOD_DISPOSITIONS = ("home or self care", "home w/ home health services", "home with home health services", "home health care svc")
UNKNOWN_DISPOSITIONS = ("unknown", "not available", "another type not listed")
NO_MONEY = ("", "n/a", "na", "none", "null", "-")
NOISE_WORDS = "the inc incorporated llc corp corporation of at and hospital hospitals medical center centre health healthcare system systems campus division dba"
ALIASES = (
    ("sbh", "st barnabas"),
    ("rumc", "richmond university"),
    ("nyp", "newyork presbyterian"),
    ("new york presbyterian", "newyork presbyterian"),
    ("nyu langone hospitals", "nyu langone tisch"),
    ("mount sinai mount sinai queens", "mount sinai queens"),
    ("hospital for special surgery", "special surgery"),
)
STOP_TOKENS = ("new", "york", "the", "and", "for", "of")
LEGACY_DESCRIPTION = r"(?i)(joint\s+replacement|arthroplasty|(hip|knee)\s+replacement)"
#: Every LEGACY_DESCRIPTION has one of these.
LEGACY_WORDS = "(?i)replacement|arthroplasty"
JOINT_DESCRIPTION = r"(?i)(hip|knee)\s+joint\s+replacement"
# Forms of a billing code: a bare number; led by APR; by MS-DRG; by DRG.
PLAIN = r"^0*([0-9]{1,3})$"
APR = r"APR[ _-]?(?:DRG)?[ _-]?0*([0-9]{1,3})\b"
MS = r"MS[ _-]?DRG[^0-9]{0,4}0*([0-9]{1,3})(?![0-9])"
BARE = r"(?:^|[^A-Z])DRG[^0-9]{0,4}0*([0-9]{1,3})(?![0-9])"
BOROUGHS = {"manhattan": "Manhattan", "new york": "Manhattan", "kings": "Brooklyn", "richmond": "Staten Island", "queens": "Queens", "bronx": "Bronx"}


def _let(c: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of ``c``, which is computed once, however often ``f`` names it."""
    return F.transform(F.array(c), f)[0]


def strip(c: Column) -> Column:
    """Trim every kind of white space."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def blank_to_null(c: Column) -> Column:
    return F.nullif(strip(c), F.lit(""))


def parse_los(c: Column, censor: int = 120) -> Column:
    text = F.trim(c)
    plain = F.regexp_replace(text, ",", "")
    return F.when(text.rlike(r"^[0-9]+ *[+]$"), F.lit(censor).cast("decimal(12,4)")).when(plain.rlike(r"^[0-9]+(\.[0-9]+)?$"), plain.try_cast("decimal(12,4)"))


def adverse_flag(c: Column) -> Column:
    """0 for a good disposition, 1 for any other that is known, null for unknown or blank."""
    text = F.lower(F.trim(c))
    return F.when(c.isNull() | (text == "") | text.isin(*UNKNOWN_DISPOSITIONS), F.lit(None).cast("int")).when(text.isin(*GOOD_DISPOSITIONS), F.lit(0)).otherwise(F.lit(1))


def _padded(digits: Column) -> Column:
    return _let(F.regexp_replace(digits, "^0+", ""), lambda bare: F.when(bare != "", F.lpad(bare, 3, "0")))


def _number(text: Column) -> Column:
    """Of a stripped text in capitals."""
    one = lambda p: _let(F.regexp_extract(text, p, 1), lambda x: F.when(x != "", x))
    return _padded(F.coalesce(*[one(p) for p in (PLAIN, APR, MS, BARE)]))


def normalize_drg(code: Column) -> Column:
    """Three-digit group number of a billing code; a longer number is none (the trailing guard of MS and BARE is deliberate)."""
    return _let(F.upper(strip(code)), _number)


def classify_code(raw: Column, declared: Column) -> Column:
    """struct(system, number); the code's own text is stronger than the declared type. Null where neither decides."""
    kind = F.upper(F.coalesce(declared, F.lit("")))

    def told(text: Column) -> Column:
        system = (
            F.when(text.rlike(APR) & ~text.rlike(PLAIN), "APR-DRG")
            .when(text.rlike(MS), "MS-DRG")
            .when(kind.contains("APR"), "APR-DRG")
            .when(kind.contains("DRG"), "MS-DRG")
        )
        return _let(F.struct(system.alias("system"), _number(text).alias("number")), lambda x: F.when(x["number"].isNotNull() & x["system"].isNotNull(), x))

    return _let(F.upper(strip(raw)), told)


def is_target_code(code: Column, description: Column, s: Settings) -> Column:
    """``code`` as classify_code gives it. Legacy numbers count only where the description agrees."""
    apr = code["system"] == "APR-DRG"
    legacy = apr & code["number"].isin(*s.apr_legacy_codes) & F.coalesce(description.rlike(LEGACY_DESCRIPTION), F.lit(False))
    return F.coalesce(((code["system"] == "MS-DRG") & (code["number"] == s.ms_code)) | (apr & code["number"].isin(*s.apr_codes)) | legacy, F.lit(False))


def clean_currency(c: Column) -> Column:
    """Positive amount or null."""
    amount = _let(F.lower(strip(c)), lambda text: F.when(~text.isin(*NO_MONEY), F.regexp_replace(text, r"[^0-9.\-]", "").try_cast("double")))
    return _let(amount, lambda x: F.when(x > 0, x))


def as_int(c: Column) -> Column:
    number = strip(c).try_cast("double")
    return F.when(~F.isnan(number), number.try_cast("int"))


def as_number(c: Column) -> Column:
    return F.regexp_replace(c, r"[^0-9.\-]", "").try_cast("double")


def sentinel_number(c: Column) -> Column:
    """Null for texts without a digit and for texts that are no plain number."""
    return F.when(c.rlike("[0-9]"), strip(c).try_cast("double"))


def normalize_name(c: Column) -> Column:
    text = F.lower(F.coalesce(c, F.lit("")))
    text = F.regexp_replace(F.replace(F.replace(text, F.lit("&"), F.lit(" and ")), F.lit("-"), F.lit(" ")), "'", "")
    text = F.regexp_replace(text, "[^a-z0-9 ]+", " ")
    text = F.regexp_replace(text, rf"\b({'|'.join(NOISE_WORDS.split())})\b", " ")
    text = F.trim(F.regexp_replace(text, r"\s+", " "))
    text = reduce(lambda t, a: F.replace(t, F.lit(a[0]), F.lit(a[1])), ALIASES, text)
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def significant_tokens(normalized: Column) -> Column:
    return F.filter(F.array_distinct(F.split(normalized, " ")), lambda t: (F.length(t) >= 4) & ~t.isin(*STOP_TOKENS))


def zip3(c: Column) -> Column:
    return F.when(c.rlike("^[0-9]{3}$"), c)


def borough(county: Column) -> Column:
    names = F.create_map(*[F.lit(x) for pair in BOROUGHS.items() for x in pair])
    return F.coalesce(names[F.lower(F.trim(county))], county)


def in_market(county: Column, area: Column, s: Settings) -> Column:
    """Three-valued: null where the county does not match and the area is unknown."""
    return county.isin(*s.counties) | (area == s.service_area)


def ratio(a: Column, b: Column) -> Column:
    return a / F.nullif(b, F.lit(0).cast("double"))


def resolved_url(url: Column, base: Column) -> Column:
    """An absolute URL as it is, a root-relative one at the host, any other in the base's folder."""
    host = F.regexp_extract(base, r"^(https?://[^/]+)", 1)
    folder = F.when(F.regexp_replace(base, "^https?://", "").contains("/"), F.regexp_replace(base, "[^/]*$", "")).otherwise(F.concat(base, F.lit("/")))
    return F.when(url.rlike("(?i)^https?://"), url).when(url.startswith("//"), F.concat(F.regexp_extract(base, "^(https?:)", 1), url)).when(url.startswith("/"), F.concat(host, url)).otherwise(F.concat(folder, url))


def clean_header(name: str) -> str:
    return re.sub(r"[\s/]", "_", name.strip().lower())
