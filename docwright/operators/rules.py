"""Business rules over typed documents.

A rule is a code, the root properties it needs and a function that builds, from
the typed document column, an array of findings. All rules are row-local
expressions: a document is judged where it is read, without a shuffle.
"""

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from docwright import constants as C
from docwright.functions import text as T
from docwright.functions.arrays import let, repeats
from docwright.functions.numbers import default_taught_years, half_even, is_sequence, salary_position, spread

ENTRY = "struct<code:string,path:string,message:string,severity:string>"


@dataclass(frozen=True)
class Context:
    """What rules may know besides the document.

    leaves is the array of the document's strings, at least of those that may
    break a text rule; academic_years is the pinned number of taught years of its
    course (null when not pinned).
    """

    currency: str = "INR"
    allowed_domains: tuple = ()
    search_filtered: bool = True
    academic_years: Column = field(default_factory=lambda: F.lit(None).cast("int"))
    leaves: Column | None = None


@dataclass(frozen=True)
class Rule:
    code: str
    requires: tuple
    build: Callable[[Column, Context], Column]


def none() -> Column:
    return F.array().cast(f"array<{ENTRY}>")


def entry(code: str, path, message, severity: str = "error") -> Column:
    lit = lambda x: x if isinstance(x, Column) else F.lit(x)
    return F.struct(
        F.lit(code).alias("code"), lit(path).alias("path"), lit(message).alias("message"),
        F.lit(severity).alias("severity"),
    )


def when(condition: Column, code: str, path, message, severity: str = "error") -> Column:
    return F.when(condition, F.array(entry(code, path, message, severity))).otherwise(none())


def say(*parts) -> Column:
    """Message text out of words and values, joined by blanks."""
    return F.concat_ws(" ", *[p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts])


def at(prefix: str, i: Column, suffix: str = "") -> Column:
    return F.concat(F.lit(f"{prefix}["), i.cast("string"), F.lit(f"]{suffix}"))


def per_item(items: Column, build) -> Column:
    """Findings of every entry of a list; none when there is no list."""
    return F.coalesce(F.flatten(F.transform(items, build)), none())


def folded(c: Column) -> Column:
    return T.fold(T.strip(c))


def or_blank(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


# -- text rules ---------------------------------------------------------------

def blank_strings(d: Column, ctx: Context) -> Column:
    return per_item(ctx.leaves, lambda s: when(
        T.is_blank(s["value"]), "blank_string", s["path"], "text is empty or only white space"))


def placeholder_text(d: Column, ctx: Context) -> Column:
    def check(s):
        return let(T.hard_placeholder(s["value"]), lambda hard: let(
            T.soft_placeholder(s["value"]), lambda soft: (
            F.when(hard != "", F.array(entry("placeholder_text", s["path"], say("placeholder text found:", hard))))
            .when(soft != "", F.array(entry(
                "possible_placeholder_text", s["path"], say("may be filler text:", soft), "warning")))
            .otherwise(none())
        )))
    return per_item(ctx.leaves, check)


def process_commentary(d: Column, ctx: Context) -> Column:
    def check(s):
        found = T.process_phrase(s["value"])
        return when(found != "", "process_commentary", s["path"], say("tells how the page was made:", found))
    return per_item(ctx.leaves, check)


def citation_markers(d: Column, ctx: Context) -> Column:
    def check(s):
        found = T.citation_markers(s["value"])
        return when(F.size(found) > 0, "citation_markers", s["path"],
                    say(F.size(found), "citation markers, the first is", found[0]))
    return per_item(ctx.leaves, check)


# -- duration, fees and salary of the page head -------------------------------

def college_fee_plausible(d: Column, ctx: Context) -> Column:
    top = d["quick_facts"]["indicative_annual_fees"]["max"]
    years = d["quick_facts"]["typical_duration"]["max_years"]
    limit = top * F.lit(C.FEE_MULTIPLE)

    def check(x, i):
        fee, path = x["annual_fee"], at("colleges.items", i, ".annual_fee")
        government = x["institution_type"].eqNullSafe("government")
        floor = F.when(government, C.GOVERNMENT_FEE_FLOOR).otherwise(C.OTHER_FEE_FLOOR)
        per_year = half_even(fee / years)
        hint = F.when((years >= 2) & (per_year <= limit),
                      say("; over", years, "years it is", per_year, "a year, so it may be the whole fee"))
        return (
            F.when(fee > limit, F.array(entry(
                "college_fee_not_annual", path,
                F.concat(say(fee, "is more than twice the yearly maximum", top), F.coalesce(hint, F.lit(""))))))
            .when(fee < floor, F.array(entry(
                "college_fee_implausibly_low", path, say(fee, "is below the least plausible fee", floor))))
            .otherwise(none())
        )

    charged = lambda x, i: F.when(x["annual_fee"] > 0, check(x, i)).otherwise(none())
    return F.when(top > 0, per_item(d["colleges"]["items"], charged)).otherwise(none())


def duration_ordering(d: Column, ctx: Context) -> Column:
    span = d["quick_facts"]["typical_duration"]
    return when(span["min_years"] > span["max_years"], "duration_inverted", "quick_facts.typical_duration",
                say("min_years", span["min_years"], "is above max_years", span["max_years"]))


def _ceiling(table: dict, ctx: Context) -> Column:
    return F.lit(table.get(ctx.currency)).cast("bigint")


def quick_fee_ordering(d: Column, ctx: Context) -> Column:
    fees, path = d["quick_facts"]["indicative_annual_fees"], "quick_facts.indicative_annual_fees"
    low, high, ceiling = fees["min"], fees["max"], _ceiling(C.FEE_CEILING, ctx)
    return F.concat(
        when(low > high, "fee_range_inverted", path, say("min", low, "is above max", high)),
        when(low.isNotNull() & (high > ceiling), "fee_out_of_range", f"{path}.max",
             say(high, "is above the ceiling", ceiling)),
    )


def salary_ordering(d: Column, ctx: Context) -> Column:
    s, path = d["snapshot"]["salary"], "snapshot.salary"
    low, typical, high = s["lower_annual"], s["typical_annual"], s["higher_annual"]
    ceiling = _ceiling(C.SALARY_CEILING, ctx)
    given = low.isNotNull() & typical.isNotNull() & high.isNotNull()
    return F.concat(
        when(given & ~((low <= typical) & (typical <= high)), "salary_not_ordered", path,
             say("lower, typical and higher are not in order:", low, typical, high)),
        when(given & (low == high), "salary_range_degenerate", path, "lower and higher salary are the same"),
        when(given & (high > ceiling), "salary_out_of_range", f"{path}.higher_annual",
             say(high, "is above the ceiling", ceiling)),
    )


def salary_marker(d: Column, ctx: Context) -> Column:
    s = d["snapshot"]["salary"]
    expected = salary_position(s["lower_annual"], s["typical_annual"], s["higher_annual"])
    return when(F.abs(expected - s["marker_percent"]) > 2, "salary_marker_mismatch", "snapshot.salary.marker_percent",
                say("marker is", s["marker_percent"], "but the salaries give", expected))


# -- lengths and sequences ------------------------------------------------------

def overview_length(d: Column, ctx: Context) -> Column:
    total = F.aggregate(d["overview"]["paragraphs"], F.lit(0), lambda a, p: a + F.coalesce(T.word_count(p), F.lit(0)))
    low, high = C.OVERVIEW_WORDS
    return let(total, lambda words: when(~words.between(low, high), "overview_length", "overview.paragraphs",
                say(words, f"words in all, {low} to {high} wanted")))


def intro_length(d: Column, ctx: Context) -> Column:
    low, high = C.INTRO_WORDS
    return let(T.word_count(d["parent_corner"]["intro"]), lambda words: when(~words.between(low, high), "parent_intro_length", "parent_corner.intro",
                say(words, f"words, {low} to {high} wanted")))


def timeline_steps(d: Column, ctx: Context) -> Column:
    steps = F.transform(d["eligibility"]["admission_timeline"], lambda x: x["step"])
    return when(~is_sequence(steps), "timeline_steps_not_sequential", "eligibility.admission_timeline",
                say("steps do not run 1, 2, 3 ...:", F.to_json(steps)))


def curriculum_years(d: Column, ctx: Context) -> Column:
    years = d["curriculum"]["years"]
    numbers = F.transform(years, lambda y: y["year"])
    subjects = F.flatten(F.transform(years, lambda y, i: F.transform(
        F.coalesce(y["subjects"], F.array().cast("array<struct<name:string,description:string>>")),
        lambda s, j: F.struct(
            F.concat(at("curriculum.years", i, ".subjects["), j.cast("string"), F.lit("].name")).alias("path"),
            s["name"].alias("name"), folded(or_blank(s["name"])).alias("key"),
        ))))
    named = F.filter(subjects, lambda s: s["key"] != "")
    again = let(named, lambda all_named: let(
        F.transform(all_named, lambda s: s["key"]),
        lambda keys: F.filter(all_named, lambda s, i: F.array_position(keys, s["key"]) <= i),
    ))
    return F.concat(
        when(~is_sequence(numbers), "curriculum_years_not_sequential", "curriculum.years",
             say("years do not run 1, 2, 3 ...:", F.to_json(numbers))),
        per_item(again, lambda s: F.array(entry(
            "duplicate_subject", s["path"], say("subject is listed before:", s["name"])))),
    )


def curriculum_length(d: Column, ctx: Context) -> Column:
    years, span = d["curriculum"]["years"], d["quick_facts"]["typical_duration"]
    low, high = span["min_years"], span["max_years"]
    pinned = F.nullif(ctx.academic_years, F.lit(0))
    expected = F.when(low.isNotNull() & high.isNotNull(), F.coalesce(pinned, default_taught_years(low, high)))
    why = (
        F.when(ctx.academic_years.isNotNull(), "this course has a fixed number of taught years")
        .when(high > low, "every year of the longest form must be shown")
        .otherwise("every year of the course must be shown")
    )
    return when(F.size(years) != expected, "curriculum_length_mismatch", "curriculum.years",
                say(F.size(years), "years of subjects where", expected, "are needed;", why))


# -- fees -----------------------------------------------------------------------

def fee_rows(d: Column, ctx: Context) -> Column:
    ceiling = _ceiling(C.FEE_CEILING, ctx)

    def check(r, i):
        low, high, variable = r["min"], r["max"], F.coalesce(r["is_variable"], F.lit(False))
        path = at("fees.rows", i)
        both_missing = low.isNull() & high.isNull()
        any_missing = low.isNull() | high.isNull()
        return (
            F.when(r.isNull() | (variable & both_missing), none())
            .when(variable & any_missing, F.array(entry(
                "variable_fee_half_range", path, "a variable row gives both min and max or neither")))
            .when(any_missing, F.array(entry("fee_range_missing", path, "min and max are both needed")))
            .otherwise(F.concat(
                when(low > high, "fee_range_inverted", path, say("min", low, "is above max", high)),
                when(high > ceiling, "fee_out_of_range", at("fees.rows", i, ".max"),
                     say(high, "is above the ceiling", ceiling)),
            ))
        )
    return per_item(d["fees"]["rows"], check)


def fee_spread(d: Column, ctx: Context) -> Column:
    rows = d["fees"]["rows"]
    type_of_row = lambda r: F.nullif(r["institution_type"], F.lit(""))
    types = F.array_distinct(F.filter(F.transform(rows, type_of_row), lambda t: t.isNotNull()))

    def check(r, i):
        open_row = ~F.coalesce(r["is_variable"], F.lit(False)) & type_of_row(r).isNull() & r.isNotNull()
        wide = (r["min"] >= 0) & (r["max"] > 0) & (spread(r["min"], r["max"]) > C.MAX_FEE_SPREAD)
        return when(open_row & wide, "fee_spread_too_wide", at("fees.rows", i),
                    say(r["min"], "to", r["max"], "is too wide a range for a row of no institution type"))
    return F.concat(
        per_item(rows, check),
        when(F.size(types) == 1, "fee_segmentation_incomplete", "fees.rows",
             say("only one institution type is shown:", types[0])),
    )


def quick_fee_spread(d: Column, ctx: Context) -> Column:
    fees = d["quick_facts"]["indicative_annual_fees"]
    low, high = fees["min"], fees["max"]
    wide = (low >= 0) & (high > 0) & (spread(low, high) > C.MAX_QUICK_FEE_SPREAD)
    return when(wide, "quick_fee_spread_too_wide", "quick_facts.indicative_annual_fees",
                say(low, "to", high, "is too wide a range for the summary"))


def total_programme_fee(d: Column, ctx: Context) -> Column:
    yearly = d["quick_facts"]["indicative_annual_fees"]["max"]
    usable = d["quick_facts"]["typical_duration"]["max_years"].isNotNull() & (yearly > 0)

    def check(r, i):
        untyped = F.nullif(r["institution_type"], F.lit("")).isNull()
        return when((r["frequency"] == "Total programme") & untyped & (r["max"] < yearly),
                    "total_below_annual", at("fees.rows", i, ".max"),
                    say("total", r["max"], "is below the yearly fee", yearly))
    return F.when(usable, per_item(d["fees"]["rows"], check)).otherwise(none())


# -- lists ------------------------------------------------------------------------

def college_ranking(d: Column, ctx: Context) -> Column:
    items, path = d["colleges"]["items"], "colleges.items"
    types = F.transform(items, lambda x: x["institution_type"])
    ranks = F.transform(items, lambda x: x["rank"])
    names = F.filter(F.transform(items, lambda x: folded(or_blank(x["name"]))), lambda n: n != "")
    repeated = let(names, lambda all_names: F.array_sort(F.array_distinct(F.filter(
        all_names, lambda n, i: F.array_position(all_names, n) <= i))))
    ceiling = _ceiling(C.FEE_CEILING, ctx)
    missing = F.array_except(F.array(F.lit("government"), F.lit("private")), types)
    return F.when(F.size(items) > 0, F.concat(
        when(~is_sequence(ranks), "college_ranks_not_sequential", path,
             say("ranks do not run 1, 2, 3 ...:", F.to_json(ranks))),
        per_item(missing, lambda t: F.array(entry("college_type_missing", path, say("no institution is", t)))),
        per_item(repeated, lambda n: F.array(entry("duplicate_college", path, say("listed more than once:", n)))),
        per_item(items, lambda x, i: when(
            x["annual_fee"] > ceiling, "college_fee_out_of_range", at(path, i, ".annual_fee"),
            say(x["annual_fee"], "is above the ceiling", ceiling))),
    )).otherwise(none())


def comparison_anchor(d: Column, ctx: Context) -> Column:
    columns, name = d["comparison"], d["course_name"]
    first = columns[0]["course_name"]
    keys = F.transform(F.filter(columns, lambda x: x.isNotNull()), lambda x: folded(or_blank(x["course_name"])))
    usable = (F.size(columns) > 0) & name.isNotNull()
    return F.when(usable, F.concat(
        when(folded(first) != folded(name), "comparison_anchor_mismatch", "comparison[0].course_name",
             say("the first column must be", name, "but is", first)),
        when(repeats(keys), "comparison_duplicate_course", "comparison", "a course appears in two columns"),
    )).otherwise(none())


def career_routes(d: Column, ctx: Context) -> Column:
    careers = F.filter(d["careers"], lambda x: x.isNotNull())
    direct = F.transform(careers, lambda x: F.coalesce(x["route_badge"] == C.DIRECT_ENTRY_BADGE, F.lit(False)))
    titles = F.transform(careers, lambda x: folded(or_blank(x["title"])))
    return F.when(F.size(d["careers"]) > 0, F.concat(
        when(~F.exists(direct, lambda x: x), "careers_no_direct_entry", "careers",
             "no career is open right after the degree", "warning"),
        when(F.forall(direct, lambda x: x), "careers_no_advanced_route", "careers",
             "every career is open right after the degree", "warning"),
        when(repeats(titles), "duplicate_career", "careers", "a career title appears twice"),
    )).otherwise(none())


def recruiter_names(d: Column, ctx: Context) -> Column:
    known = F.filter(d["recruiters"], lambda x: x.isNotNull())
    names = F.transform(known, lambda x: folded(or_blank(x["name"])))
    return when(repeats(names), "duplicate_recruiter", "recruiters", "an organisation appears twice")


# -- sources and heading ------------------------------------------------------------

def in_domains(host: Column, domains) -> Column:
    """Whether the host or one of its parent domains is listed."""
    return F.exists(T.host_suffixes(host), lambda s: s.isin(*domains))


def sources_grounded(d: Column, ctx: Context) -> Column:
    sources, path = d["verification"]["sources"], "verification.sources"
    enforce = bool(ctx.allowed_domains) and ctx.search_filtered
    urls = F.filter(F.transform(sources, lambda s: s["url"]), lambda u: u.isNotNull())
    hosts = F.transform(urls, T.url_host)
    notes = none()
    if not ctx.allowed_domains:
        notes = when(sources.isNotNull(), "grounding_unverified", path,
                     "no domains are configured, so sources were not checked", "warning")
    elif not ctx.search_filtered:
        notes = when(sources.isNotNull(), "sources_unfiltered", path,
                     "the search was open, so sources were not checked", "warning")

    def check(s, i):
        url, where = s["url"], at(path, i, ".url")
        parts = [when(T.url_scheme(url) != "https", "source_not_https", where, say("not https:", url))]
        if enforce:
            parts.append(when(~in_domains(T.url_host(url), ctx.allowed_domains), "source_off_domain", where,
                              say("host is not on the list:", T.url_host(url))))
        return F.concat(*parts)

    return F.concat(
        notes,
        per_item(sources, check),
        when((F.size(hosts) > 2) & (F.size(F.array_distinct(hosts)) == 1), "sources_single_host", path,
             say("all sources are of one host:", hosts[0]), "warning"),
    )


def heading_names_course(d: Column, ctx: Context) -> Column:
    heading, name = d["overview"]["heading"], d["course_name"]
    return when(~F.contains(folded(heading), folded(name)), "overview_heading_missing_course", "overview.heading",
                say("heading does not name the course", name))


# Registry order is the order of findings in a report.
ALL_RULES = (
    Rule("no_blank_strings", (), blank_strings),
    Rule("no_placeholder_text", (), placeholder_text),
    Rule("no_process_commentary", (), process_commentary),
    Rule("no_citation_markers", (), citation_markers),
    Rule("college_fee_looks_annual", ("colleges", "quick_facts"), college_fee_plausible),
    Rule("duration_ordering", ("quick_facts",), duration_ordering),
    Rule("quick_fee_ordering", ("quick_facts",), quick_fee_ordering),
    Rule("salary_ordering", ("snapshot",), salary_ordering),
    Rule("salary_marker_consistent", ("snapshot",), salary_marker),
    Rule("overview_length", ("overview",), overview_length),
    Rule("parent_intro_length", ("parent_corner",), intro_length),
    Rule("timeline_steps", ("eligibility",), timeline_steps),
    Rule("curriculum_years", ("curriculum",), curriculum_years),
    Rule("curriculum_length_matches_duration", ("curriculum", "quick_facts"), curriculum_length),
    Rule("fee_rows", ("fees",), fee_rows),
    Rule("fee_spread_forces_segmentation", ("fees",), fee_spread),
    Rule("quick_fee_spread", ("quick_facts",), quick_fee_spread),
    Rule("total_programme_fee_sanity", ("fees", "quick_facts"), total_programme_fee),
    Rule("college_ranking", ("colleges",), college_ranking),
    Rule("comparison_anchor", ("comparison", "course_name"), comparison_anchor),
    Rule("career_route_mix", ("careers",), career_routes),
    Rule("recruiter_initials", ("recruiters",), recruiter_names),
    Rule("sources_grounded", ("verification",), sources_grounded),
    Rule("course_name_echo", ("overview", "course_name"), heading_names_course),
)


def subset(*codes: str) -> tuple:
    return tuple(r for r in ALL_RULES if r.code in codes)


def rule_findings(d: Column, ctx: Context, rules=ALL_RULES, present: Column | None = None) -> Column:
    """Findings of all rules whose root properties are there, in registry order.

    present is the array of root keys of the document. Without it a property
    counts as there when the typed document has a value for it.
    """
    parts = []
    for rule in rules:
        built = rule.build(d, ctx)
        gate = _gate(d, rule, present)
        parts.append(built if gate is None else F.when(gate, built).otherwise(none()))
    return F.concat(*parts) if parts else none()


def skipped_rules(d: Column, rules=ALL_RULES, present: Column | None = None) -> Column:
    """Sorted codes of the rules that could not run."""
    gates = [(r.code, _gate(d, r, present)) for r in rules]
    return F.array_sort(F.array_compact(F.array(*[
        F.when(~gate, F.lit(code)) for code, gate in gates if gate is not None
    ]))) if any(g is not None for _, g in gates) else F.array().cast("array<string>")


def _gate(d: Column, rule: Rule, present: Column | None):
    gate = None
    for name in rule.requires:
        test = _there(d, name, present)
        gate = test if gate is None else gate & test
    return gate


def _there(d: Column, path: str, present: Column | None) -> Column:
    """Whether a dotted path is there. Below the root, a null value counts as absent."""
    root, *rest = path.split(".")
    value = d[root]
    for name in rest:
        value = value[name]
    if present is None:
        return value.isNotNull()
    listed = F.array_contains(present, root)
    return listed & value.isNotNull() if rest else listed
