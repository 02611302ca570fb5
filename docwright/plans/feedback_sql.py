"""The comparison SQL of feedback lines: every finding with its message and its place in a report."""

from docwright.operators.rules import ALL_RULES
from docwright.plans import sql as Q
from docwright.plans.document_queries import _CITE, _HARD, _PROCESS, RULE_QUERIES

_RANK = {rule.code: at for at, rule in enumerate(ALL_RULES)}
_CEILING = lambda of, limit: f"{of} || ' is above the ceiling {limit}'"
_MEAN = "CAST(round_even(afee / ymax, 0) AS BIGINT)"
_RUN = "' do not run 1, 2, 3 ...: ' || steps"

#: Of each rule's parts, in their order: the message and the place within the rule.
MESSAGES = {
    "fee_not_annual": [(f"""afee || ' is more than twice the yearly maximum ' || qmax || CASE WHEN ymax >= 2 AND {_MEAN} <= 2.0 * qmax
        THEN '; over ' || ymax || ' years it is ' || {_MEAN} || ' a year, so it may be the whole fee' ELSE '' END""", "pos")],
    "fee_too_low": [(f"afee || ' is below the least plausible fee ' || {Q._FLOOR}", "pos")],
    "duration_inverted": [("'min_years ' || ymin || ' is above max_years ' || ymax", "0")],
    "quick_fee_range": [("'min ' || qmin || ' is above max ' || qmax", "0"), (_CEILING("qmax", 5000000), "1")],
    "salary_order": [("'lower, typical and higher are not in order: ' || s_low || ' ' || s_typ || ' ' || s_high", "0"),
                     ("'lower and higher salary are the same'", "1"), (_CEILING("s_high", 20000000), "2")],
    "salary_marker_check": [(f"'marker is ' || CAST({Q._MARK} AS BIGINT) || ' but the salaries give ' || CAST({Q._POS} AS BIGINT)", "0")],
    "overview_length": [(f"{Q.words('body')} || ' words in all, 140 to 260 wanted'", "0")],
    "intro_length": [(f"{Q.words('body')} || ' words, 110 to 220 wanted'", "0")],
    "timeline_steps": [(f"'steps' || {_RUN}", "0")],
    "year_sequence": [(f"'years' || {_RUN}", "0")],
    "duplicate_subjects": [("'subject is listed before: ' || subject", "1 + pos * 10 + j")],
    "curriculum_length": [(f"""n || ' years of subjects where ' || CAST({Q._EXPECT} AS BIGINT) || ' are needed; ' || CASE WHEN pin IS NOT NULL
        THEN 'this course has a fixed number of taught years' WHEN ymax > ymin THEN 'every year of the longest form must be shown'
        ELSE 'every year of the course must be shown' END""", "0")],
    "fee_rows": [("'a variable row gives both min and max or neither'", "pos * 10"), ("'min and max are both needed'", "pos * 10"),
                 ("'min ' || rmin || ' is above max ' || rmax", "pos * 10 + 1"), (_CEILING("rmax", 5000000), "pos * 10 + 2")],
    "fee_spread": [("rmin || ' to ' || rmax || ' is too wide a range for a row of no institution type'", "pos")],
    "fee_segmentation": [("'only one institution type is shown: ' || itype", "1000000")],
    "quick_fee_spread": [("qmin || ' to ' || qmax || ' is too wide a range for the summary'", "0")],
    "total_below_annual": [("'total ' || rmax || ' is below the yearly fee ' || qmax", "pos")],
    "college_checks": [(f"'ranks' || {_RUN}", "0"), ("'no institution is government'", "1"), ("'no institution is private'", "2"),
                       ("'listed more than once: ' || college", "3"), (_CEILING("afee", 5000000), "4 + pos")],
    "comparison_checks": [("'the first column must be ' || p_name || ' but is ' || cn", "0"), ("'a course appears in two columns'", "1")],
    "career_checks": [("''", "0"), ("''", "0"), ("'a career title appears twice'", "2")],
    "duplicate_recruiters": [("'an organisation appears twice'", "0")],
    "source_checks": [("'not https: ' || url", "j * 10"), ("'host is not on the list: ' || h", "j * 10 + 1"), ("''", "0")],
    "heading_names_course": [("'heading does not name the course ' || name", "0")],
}
_FIRST = lambda test: f"regexp_extract(text, {test.split(', ', 1)[1][:-1]})"
_TEXT_MESSAGES = {
    "no_blank_strings": ("blank_string", "'text is empty or only white space'"),
    "no_placeholder_text": ("placeholder_text", f"'placeholder text found: ' || {_FIRST(_HARD)}"),
    "no_process_commentary": ("process_commentary", f"'tells how the page was made: ' || {_FIRST(_PROCESS)}"),
    "no_citation_markers": ("citation_markers", f"len({_FIRST(_CITE).replace('regexp_extract', 'regexp_extract_all', 1)}) || ' citation markers, the first is ' || {_FIRST(_CITE)}"),
}
_TEXT_PLACE = r"""CASE WHEN starts_with(path, 'overview') THEN CAST(regexp_extract(path, '\[(\d+)\]', 1) AS INTEGER) WHEN starts_with(path, 'parent') THEN 1000000
    ELSE 2000000 + CAST('0' || regexp_extract(path, '\[(\d+)\]', 1) AS INTEGER) END"""


def _with(part: str, *columns: str) -> str:
    """A part of the findings SQL with more columns of its source."""
    return part.replace("SELECT k, course_id,", "SELECT k, course_id, " + ", ".join(columns) + ",", 1)


def _count(say: str, limit: int, of: str) -> str:
    return f"'{of[0]} has ' || {say} || ' {of[1]}, at {of[2]} {limit} {of[3]}'"


def _structure_message(part: str) -> str:
    """The message of one structural part, from its code and the limit in its condition."""
    code, condition = part.split("'")[1], part.rsplit(" WHERE ", 1)[1]
    if code in ("minItems", "maxItems", "minLength", "maxLength"):
        size, limit = condition.replace(">", "<").split(" < ")
        kind = ("list", "entries") if code.endswith("Items") else ("text", "characters")
        return _count(size, int(limit), (*kind, *(("least", "needed") if code.startswith("min") else ("most", "allowed"))))
    fixed = {
        "required": "fees is missing", "additionalProperties": "object has keys that are not allowed", "enum": "value is not one of the allowed choices",
        "pattern": "text does not have the required form", "minimum": "value is below the least allowed", "maximum": "value is above the largest allowed",
        "uniqueItems": "list repeats an entry", "type": f"value is not of type {'integer' if 'annual_fee' in part else 'string'}",
    }
    return f"'{fixed[code]}'"


def lines(text_parts: list[str]) -> str:
    """Rows (course_id, line, and what they are sorted by) of every error."""
    rows = []
    for parts in Q.STRUCTURE_SQL.values():
        for part in parts[1]:
            rows.append(f"SELECT course_id, 0 AS source, path, code, message, 0 AS rank, 0 AS place FROM ({_with(part, _structure_message(part) + ' AS message')})")
    for name, messages in MESSAGES.items():
        for part, (message, place) in zip(Q.RULE_SQL[name][1], messages, strict=True):
            rows.append(f"""SELECT course_id, 1, path, code, message, {_RANK[RULE_QUERIES[name][0]]}, place
                FROM ({_with(part, f'{message} AS message', f'{place} AS place')}) WHERE severity = 'error'""")
    for rule, (code, message) in _TEXT_MESSAGES.items():
        part = next(p for p in text_parts if f"'{code}' AS code" in p)
        rows.append(f"SELECT course_id, 1, path, code, message, {_RANK[rule]}, {_TEXT_PLACE} FROM ({_with(part, f'{message} AS message')})")
    return " UNION ALL ".join(f"({r})" for r in rows)
