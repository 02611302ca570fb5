"""Scalar text expressions. Each takes and returns a Column and stays in the JVM."""

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from docwright.constants import (
    CITATION_MARKER,
    COURSE_ID_LENGTH,
    HARD_PLACEHOLDERS,
    PROCESS_PHRASES,
    SLUG_LENGTH,
    SOFT_PLACEHOLDERS,
    WHITE_SPACE,
    WORD_CHAR,
)
from docwright.functions.arrays import let

#: What letters outside ASCII that a pattern takes for i or s are in lower case.
_CASE_SIGNS = ("\u0131", "\u017f", "\u0307")

_COMMON = " etaoinsrhdlucmfywgpbvkxqjz"


def strip(c: Column) -> Column:
    """Remove leading and trailing white space of any script."""
    return F.regexp_replace(c, f"^{WHITE_SPACE}+|{WHITE_SPACE}+\\z", "")


def squeeze(c: Column) -> Column:
    """Turn every run of white space into one blank, and strip."""
    return F.trim(F.regexp_replace(c, f"{WHITE_SPACE}+", " "))


def fold(c: Column) -> Column:
    """Case folding: lower case, with sharp s as ss."""
    return F.replace(F.lower(c), F.lit("ß"), F.lit("ss"))


def clean_cell(c: Column) -> Column:
    return squeeze(F.translate(F.coalesce(c, F.lit("")), "—–’", "--'"))


def slugify(c: Column) -> Column:
    dashed = F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]+", "-")
    return F.regexp_replace(dashed, "^-|-\\z", "")


def discipline_key(c: Column) -> Column:
    return slugify(F.coalesce(c, F.lit("")))


def catalogue_slug(c: Column) -> Column:
    return F.regexp_replace(F.substring(slugify(c), 1, SLUG_LENGTH), "-+\\z", "")


def course_id(slug: Column) -> Column:
    full = F.concat(F.lit("crs_"), F.translate(slug, "-", "_"))
    return F.regexp_replace(F.substring(full, 1, COURSE_ID_LENGTH), "_+\\z", "")


def default_course_id(name: Column) -> Column:
    """Id given to a course that arrives without one; not cut to length."""
    return F.concat(F.lit("crs_"), F.translate(slugify(name), "-", "_"))


def name_key(c: Column) -> Column:
    return fold(squeeze(F.coalesce(c, F.lit(""))))


def word_count(c: Column) -> Column:
    inner = WORD_CHAR[:-1] + "'’-]"
    return F.regexp_count(c, F.lit(f"{WORD_CHAR}(?:{inner}*{WORD_CHAR})?"))


def is_blank(c: Column) -> Column:
    return ~c.rlike(f"[^{WHITE_SPACE[1:-1]}]")


def normalize_domain(c: Column) -> Column:
    """Host part of a pasted address. A leading - (exclusion) is kept."""
    text = F.lower(strip(c))
    body = F.regexp_replace(text, "^-", "")
    for pattern in (
        r"^.*?://",         # scheme
        r"(?s)/.*\z",       # path
        r"(?s)\?.*\z",      # query
        r"^[^@]*@",         # user information
        r"(?s):.*\z",       # port
        r"^www\.",
    ):
        body = F.regexp_replace(body, pattern, "")
    return F.when(text.startswith("-") & (body != ""), F.concat(F.lit("-"), body)).otherwise(body)


def normalize_domains(values: Column) -> Column:
    """Normalised list without blanks and repeats; the first one stays."""
    return F.array_distinct(F.filter(F.transform(values, normalize_domain), lambda d: d != ""))


def strip_citation_markers(c: Column) -> Column:
    text = F.regexp_replace(c, f"(?U)\\s*{CITATION_MARKER}", "")
    text = F.regexp_replace(text, r"[ \t]+([.,;:!?])", "$1")
    return strip(F.regexp_replace(text, r"[ \t]{2,}", " "))


def _any_of(patterns) -> str:
    """One expression for all patterns. Those that begin at a word edge share one test of it."""
    edge = r"\b"
    at_edge = [p.removeprefix(edge) for p in patterns if p.startswith(edge)]
    anywhere = [p for p in patterns if not p.startswith(edge)]
    grouped = [f"{edge}(?:{'|'.join(at_edge)})"] if at_edge else []
    return "(?iuU)(?:" + "|".join(grouped + anywhere) + ")"


def first_match(c: Column, patterns) -> Column:
    """First text any pattern matches; an empty string when none does."""
    return F.regexp_extract(c, _any_of(patterns), 0)


def plain_part(pattern: str) -> str:
    """Signs that stand in every lower case text a fixed pattern matches. It begins with a rare letter, so that it is looked for quickly."""
    bare = re.sub(r"\([^()]*\)\??|[^\\]\?", "\0", pattern.replace(r"\b", ""))
    runs = re.sub(r"\\(.)", r"\1", bare.replace("+", "\0")).lower().split("\0")
    run = max(runs, key=len)
    return min((run[i:] for i in range(max(len(run) - 4, len(run) == 3) + 1)), key=lambda part: (-_COMMON.find(part[0]) if part[0] in _COMMON else -len(_COMMON)))


def suspect_parts(json: Column) -> Column:
    """Of the signs that a string in this JSON text must hold to hold a fixed phrase, those that it holds."""
    phrases = map(plain_part, (*HARD_PLACEHOLDERS, *SOFT_PLACEHOLDERS, *PROCESS_PHRASES))
    parts = F.array(*map(F.lit, sorted({*phrases, *_CASE_SIGNS})))
    return let(F.lower(json), lambda low: F.filter(parts, lambda p: F.contains(low, p)))


def may_break_text_rules(json: Column, parts: Column) -> Column:
    """Whether a string in this JSON text may be blank, hold a citation marker or a fixed phrase; parts are the suspect_parts of a text around it."""
    held = let(F.lower(json), lambda low: F.exists(parts, lambda p: F.contains(low, p)))
    return json.rlike(rf'"(?:["\\]|{WHITE_SPACE})|\[\p{{Nd}}') | held


def hard_placeholder(c: Column) -> Column:
    return first_match(c, HARD_PLACEHOLDERS)


def soft_placeholder(c: Column) -> Column:
    return first_match(c, SOFT_PLACEHOLDERS)


def process_phrase(c: Column) -> Column:
    return first_match(c, PROCESS_PHRASES)


def citation_markers(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(f"(?U){CITATION_MARKER}"), F.lit(0))


def url_scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1))


def url_host(url: Column) -> Column:
    """Network location in lower case: port and user information stay, www. goes."""
    authority = F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1)
    return F.regexp_replace(F.lower(authority), r"^www\.", "")


def host_suffixes(host: Column) -> Column:
    """The host and each of its parent domains, longest first."""
    parts = F.split(host, r"\.")
    return F.transform(
        F.sequence(F.lit(1), F.size(parts)),
        lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."),
    )
