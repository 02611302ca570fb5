"""Fixed values of the document model and its checks.

Everything in this module is data that results depend on (names, limits,
patterns), stated as it must be; no logic lives here.
"""

# Sections of a document, in pipeline order, and the root properties each owns.
SECTIONS = {
    "profile": ("course_level", "subcategory", "seo", "hero", "quick_facts"),
    "snapshot": ("snapshot", "overview", "suitability"),
    "academics": ("eligibility", "curriculum", "skills"),
    "outcomes": ("careers", "recruiters", "further_study_pathway"),
    "market": ("fees", "colleges", "comparison"),
    "guidance": ("action_roadmap", "parent_corner", "faqs", "verification"),
}

# Identity properties that come from the catalogue and belong to no section.
INJECTED = ("course_id", "slug", "course_name", "category", "currency", "region")

# Paths that are computed, never supplied, per section.
DERIVED_PATHS = {
    "snapshot": ("snapshot.salary.marker_percent",),
    "guidance": ("verification.last_reviewed",),
}

# Properties handed on from earlier sections to later ones.
CONTEXT_KEYS = ("course_level", "category", "subcategory", "quick_facts")

MAX_TAUGHT_YEARS = 5
MAX_DOMAINS = 20
MAX_ATTEMPTS = 3
MAX_REPAIR_ROUNDS = 2
FEEDBACK_LIMIT = 40
TOP_CODES = 15
SLUG_LENGTH = 80
COURSE_ID_LENGTH = 64
PROJECTED_COURSES = 166

# Ceilings for one year, by currency.
FEE_CEILING = {"INR": 5_000_000, "USD": 120_000, "GBP": 90_000, "EUR": 100_000, "AED": 400_000}
SALARY_CEILING = {"INR": 20_000_000, "USD": 500_000, "GBP": 400_000, "EUR": 450_000, "AED": 1_500_000}

FEE_MULTIPLE = 2.0
GOVERNMENT_FEE_FLOOR = 500
OTHER_FEE_FLOOR = 5000
MAX_FEE_SPREAD = 20.0
MAX_QUICK_FEE_SPREAD = 25.0
OVERVIEW_WORDS = (140, 260)
INTRO_WORDS = (110, 220)
DIRECT_ENTRY_BADGE = "Possible after bachelor's"

# HTTP status classes.
RETRYABLE_STATUS = (408, 409, 425, 429, 500, 502, 503, 504)
ABORT_STATUS = (401, 403)
REJECT_STATUS = (400, 404, 409, 422)

# Text that must not appear in page copy. Matched anywhere, ignoring case.
HARD_PLACEHOLDERS = (
    r"lorem ipsum",
    r"\btodo\b",
    r"\btbd\b",
    r"\bplaceholder\b",
    r"\bxxx+\b",
    r"\{\{",
    r"example\.com",
    r"\[insert",
    r"\byour (course|text) here\b",
)
SOFT_PLACEHOLDERS = (
    r"\bdemo\b",
    r"\bfictional\b",
    r"\bsample data\b",
    r"\bas an ai\b",
)
PROCESS_PHRASES = (
    r"\bthis conversation\b",
    r"\bsearch results?\b",
    r"\bsource snippets?\b",
    r"\bthe snippets?\b",
    r"\bprovided sources?\b",
    r"\bretrieved for\b",
    r"\bavailable in the results\b",
    r"\bin the results\b",
    r"\bnot consistently (?:published|listed|available)\b",
    r"\bwhere (?:the )?sources? (?:gave|quoted|showed?|listed)\b",
    r"\bcould not be (?:found|determined|verified)\b",
    r"\bbased on (?:the )?(?:search|retrieved|available)\b",
    r"\bpublished sources show\b",
    r"\bfrom the sources?\b",
    r"\baccording to the (?:search|results|snippets)\b",
    r"\bdata (?:was|were) not (?:available|found)\b",
)
CITATION_MARKER = r"\[\d+(?:\s*[,;]\s*\d+)*\]"

# White space as Python's str.strip and \s see it, for Java and RE2 alike.
WHITE_SPACE = (
    r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
# A letter, digit or underscore in any script, for Java and RE2 alike.
WORD_CHAR = r"[\p{L}\p{N}_]"
