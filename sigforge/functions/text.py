"""Name and text functions as column expressions."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Words at the end of a name that describe dose, form or route, and units.
DOSAGE_FORM_WORDS = (
    "TABLET", "TABLETS", "TAB", "TABS", "CAPSULE", "CAPSULES", "CAP", "CAPS",
    "INJECTION", "INJECTABLE", "SOLUTION", "SOLN", "CREAM", "PATCH", "GEL",
    "SYRUP", "SUSPENSION", "SPRAY", "OINTMENT", "LOTION", "POWDER",
    "DROPS", "LOZENGE", "SUPPOSITORY", "ORAL", "TOPICAL", "IV", "IM", "SC",
    "ER", "XR", "SR", "CR", "DR", "EC", "IR", "HFA", "USP", "NOS", "PF",
    "EXTENDED", "RELEASE", "DELAYED", "IMMEDIATE", "POUDRE", "POUR",
    "MG", "MCG", "G", "KG", "ML", "L", "MEQ", "IU", "UNIT", "UNITS", "%",
)
# Salt and hydrate names.
SALT_SUFFIXES = (
    "MONOHYDRATE", "DIHYDRATE", "TRIHYDRATE", "ANHYDROUS", "HYDRATE", "HYDROCHLORIDE", "DIHYDROCHLORIDE", "HYDROBROMIDE", "HYDRIODIDE",
    "SULFATE", "DISULFATE", "PHOSPHATE", "DIPHOSPHATE", "SODIUM", "POTASSIUM", "CALCIUM", "MAGNESIUM", "MALEATE", "MESYLATE", "TARTRATE",
    "CITRATE", "ACETATE", "SUCCINATE", "FUMARATE", "BESYLATE", "BROMIDE", "CHLORIDE", "NITRATE",
)
# Ingredient fields that name a category.
CATEGORY_INGREDIENTS = (
    "UNSPECIFIED INGREDIENT", "COSMETICS", "VITAMINS", "DEVICE", "DIETARY SUPPLEMENT", "INVESTIGATIONAL PRODUCT", "HERBALS", "MINERALS", "VITAMIN B",
)
# Therapeutic classes, forms, routes and modifiers that don't name an ingredient.
STRUCTURE_WORDS = (
    "ANTIHISTAMINE", "ANTIHISTAMINES", "ANTIHISTAMIN", "ANTIHISTAMINNE", "ANTACID", "ANTACIDS", "LAXATIVE", "LAXATIVES",
    "DECONGESTANT", "DECONGESTANTS", "ANALGESIC", "ANALGESICS", "ANTIDIARRHEAL", "DIARRHEAL", "DIARRHEA", "DIARRHE",
    "ALLERGY", "MEDICINE", "MEDICINES", "MEDICATED",
    "EYE", "EAR", "NASAL", "ORAL", "TOPICAL", "OPHTHALMIC", "DROP", "DROPS", "DROPOS", "SPRAY", "CREAM", "CREAMS", "OINTMENT",
    "LOTION", "GEL", "SOLUTION", "SOLN", "SUSPENSION", "SUSP", "SYRUP", "INJECTION", "INJECTABLE", "PATCH", "TABLET", "TABLETS", "TAB", "TABS",
    "CAPSULE", "CAPSULES", "CAP", "CAPS", "LOZENGE", "LOZENGES", "POWDER", "OIL", "SUPPOSITORY", "SOFTENER", "SOFTENERS", "STOOL", "COUGH",
    "LUBRICANT", "LUBRICANTS", "LUBRICATING", "SOFT", "CHEW", "CHEWS",
    "ARTHRITIS", "ECZEMA", "ITCH", "WOMENS", "WOMEN", "MENS", "CHILDRENS", "CHILDREN", "INFANTS", "INFANT",
    "GENTLE", "NATURAL", "HERBAL", "DAILY", "MAXIMUM", "STRENGTH", "EXTRA", "HOUR", "HOURS", "HR", "NIGHT", "NIGHTTIME", "NIGHTIME", "DAY",
    "RELIEF", "RELEASE", "NOS", "ANTI",
)
# American spellings and the British ones of the reaction vocabulary, in order of replacement.
BRITISH = (
    ("hemorrhage", "haemorrhage"), ("hemo", "haemo"), ("hema", "haema"), ("tumor", "tumour"), ("edema", "oedema"), ("diarrhea", "diarrhoea"),
    ("anemia", "anaemia"), ("esophag", "oesophag"), ("gynec", "gynaec"), ("leukemia", "leukaemia"), ("leukopenia", "leucopenia"), ("bleeding", "haemorrhage"),
    ("fetal", "foetal"), ("estrogen", "oestrogen"), ("fecal", "faecal"), ("anesth", "anaesth"), ("paresthesia", "paraesthesia"), ("celiac", "coeliac"),
)


def _any(words) -> str:
    return "|".join(re.escape(w) for w in sorted(words, key=len, reverse=True))


_NUMBER = r"\d+(?:\.\d+)?"
#: What may follow one another at the end of a name: form words, numbers with or without unit, code tokens, salts after another word, "-100".
NAME_TAIL = (
    rf"(?:(?:^|[ ]+)(?:{_any(DOSAGE_FORM_WORDS)}|{_NUMBER}(?:MG|MCG|G|KG|ML|L|MEQ|IU|UNITS?|%)?|/\d+/),*"
    rf"|[^ ,][ ]+(?:{_any(SALT_SUFFIXES)}),*|-{_NUMBER}|[, ]+)+$"
).replace("[^ ,][ ]+", "[ ]+")


def normalize_query(name: Column) -> Column:
    """A free-text name without what trails its core: "LISINOPRIL TABLETS USP, 20MG" is "LISINOPRIL". Null stays null.

    A salt name is only dropped after another word.
    """
    s = F.trim(F.regexp_replace(F.trim(F.upper(name)), r"[.]+$", ""))
    return F.trim(F.regexp_replace(s, NAME_TAIL, ""))


def normalize_ingredient(raw: Column) -> Column:
    """Upper case, single spaces, without trailing salt names."""
    s = F.upper(F.regexp_replace(F.trim(raw), r"\s+", " "))
    return F.trim(F.regexp_replace(s, rf"(?: (?:{_any(SALT_SUFFIXES)}))+$", ""))


def bracket_alt(name: Column) -> Column:
    """The content of the first [...], null without."""
    found = F.trim(F.regexp_extract(name, r"\[([^\[\]]+)\]", 1))
    return F.when(found != "", found)


def backslash_parts(name: Column) -> Column:
    """The parts of a combination written with backslashes, null unless there are two."""
    parts = F.filter(F.transform(F.split(name, r"\\"), lambda x: F.trim(x)), lambda p: p != "")
    return F.when(F.size(parts) > 1, parts)


def to_set(parts: Column) -> Column:
    """Canonical set text of an array: lower case, sorted, distinct, joined by |."""
    return F.array_join(F.array_sort(F.array_distinct(F.transform(parts, F.lower))), "|")


def from_set(text: Column) -> Column:
    return F.filter(F.split(text, "[|]"), lambda p: p != "")


def resolve_prod_ai(field: Column) -> Column:
    """The ingredient field as set text: parts normalised, categories and NOS values left out; null if nothing remains."""
    parts = F.coalesce(backslash_parts(field), F.array(field))
    normed = F.transform(parts, lambda p: normalize_ingredient(F.regexp_replace(p, r"\^", "'")))
    kept = F.filter(normed, lambda p: ~p.isin(*CATEGORY_INGREDIENTS) & ~p.rlike(r"\bNOS\b") & (p != ""))
    return F.when(F.trim(field) != "", F.when(F.size(kept) > 0, to_set(kept)))


@F.pandas_udf(T.StringType())
def _nfkc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFKC", x))


def canonical(text: Column, unicode: bool = False) -> Column:
    """Join key: no spaces and punctuation at the ends, single spaces, lower case; null is "".

    unicode: apply compatibility normalisation first, in Python; only needed where input isn't ASCII.
    """
    s = F.coalesce(_nfkc(text) if unicode else text, F.lit(""))
    edge = r"[\s.,;:\-–—]+"
    return F.lower(F.trim(F.regexp_replace(F.regexp_replace(s, f"^{edge}|{edge}$", ""), r"\s+", " ")))


def block_key(text: Column) -> Column:
    """First character of the smallest word."""
    return F.substring(F.array_min(F.filter(F.split(F.trim(text), r"\s+"), lambda t: t != "")), 1, 1)


def alnum(text: Column) -> Column:
    return F.regexp_replace(F.upper(text), "[^A-Z0-9]", "")


def is_short_name(text: Column, most: int = 10) -> Column:
    return (F.length(text) <= most) & ~text.contains(" ")


_DESIGNATOR = r"\b(?:[A-Z]\d+|VIII|VII|XIII|XII|III|II|IV|IX|VI|XI)\b"


def designator_mismatch(raw: Column, candidate: Column) -> Column:
    """Whether the candidate has a letter with number or a roman number that the raw name doesn't have."""
    joined = F.regexp_replace(F.upper(raw), r"\b([A-Z])[^A-Z0-9]+(\d+)", "$1$2")
    found = F.regexp_extract_all(F.upper(candidate), F.lit(_DESIGNATOR), F.lit(0))
    missing = lambda t: F.when(t.rlike(r"^[A-Z]\d"), ~F.regexp_like(joined, F.concat(F.lit("(?<![A-Z])"), t))).otherwise(~F.contains(joined, t))
    return F.coalesce(F.exists(found, missing), F.lit(False))


def class_or_form_only(name: Column) -> Column:
    """Whether all words of two or more characters are structure words or numbers, and there is one."""
    words = F.filter(F.split(F.upper(name), "[^A-Z0-9]+"), lambda t: F.length(t) >= 2)
    return (F.size(words) > 0) & F.forall(words, lambda t: t.isin(*STRUCTURE_WORDS) | t.rlike(r"^\d+$"))


def british(text: Column) -> Column:
    s = text
    for a, b in BRITISH:
        s = F.replace(s, F.lit(a), F.lit(b))
    s = F.regexp_replace(s, r"(?<!a)emia\b", "aemia")
    return F.regexp_replace(F.regexp_replace(s, r"iz(e|es|ed|ing|ation)\b", "is$1"), r"yz(e|es|ed|ing)\b", "ys$1")


def entity_id(normalized: Column) -> Column:
    return F.concat(F.lit("s3-"), F.substring(F.sha1(normalized), 1, 16))


def quarter_index(year: Column, quarter: Column) -> Column:
    """Quarters on a line: year * 4 + quarter - 1."""
    return year * 4 + quarter - 1


def indel_ratio(a: str, b: str) -> float:
    """100 * 2 * longest common subsequence / total length, 100 for two empty texts."""
    if not a and not b:
        return 100.0
    masks: dict[str, int] = {}
    for i, c in enumerate(a):
        masks[c] = masks.get(c, 0) | 1 << i
    state, full = (1 << len(a)) - 1, (1 << len(a)) - 1
    for c in b:
        u = state & masks.get(c, 0)
        state = (state + u | state - u) & full
    common = bin(~state & full).count("1")
    return 200.0 * common / (len(a) + len(b))


@F.pandas_udf(T.DoubleType())
def token_sort_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """indel_ratio of the texts with their words sorted; null if either is null."""
    key = lambda s: " ".join(sorted(s.split()))
    return pd.Series([None if x is None or y is None else indel_ratio(key(x), key(y)) for x, y in zip(a, b, strict=True)], dtype=float)
