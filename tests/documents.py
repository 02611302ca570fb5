"""A document that passes every check, and a plain Python judge of its structure."""

import copy
import re

from docwright.schema import DOCUMENT, Flag, Items, Members, Number, Text, Whole


def _fill(spec, name, salt=0):
    if isinstance(spec, Members):
        return {n: _fill(c, n, salt) for n, c in spec.members.items()}
    if isinstance(spec, Items):
        return [_fill(spec.item, name, i) for i in range(spec.low)]
    if isinstance(spec, Flag):
        return False
    if isinstance(spec, (Whole, Number)):
        return spec.low
    if spec.values:
        return spec.values[0]
    words = f"{name.replace('_', ' ')} {salt} text"
    text = (words + " and more words").ljust(spec.low or 0, "x") if len(words) < (spec.low or 0) else words
    return text[: spec.high] if spec.high else text


def good() -> dict:
    d = copy.deepcopy(_fill(DOCUMENT, "doc"))
    d.update(course_id="crs_1", slug="one-course", course_name="One Course", category="Arts", currency="INR", region="India")
    d["quick_facts"].update(
        typical_duration={"min_years": 3, "max_years": 3.0}, indicative_annual_fees={"min": 20000, "max": 90000})
    d["snapshot"]["salary"].update(lower_annual=250000, typical_annual=420000, higher_annual=800000, marker_percent=31)
    d["overview"] = {"heading": "What is One Course?", "paragraphs": [" ".join(["word"] * 60)] * 3}
    d["parent_corner"]["intro"] = " ".join(["family"] * 120)
    d["eligibility"]["admission_timeline"] = [
        {"step": i, "title": "Apply now", "description": "Send the form in good time"} for i in range(1, 6)]
    d["curriculum"]["years"] = [
        {"year": y, "label": f"Year {y}",
         "subjects": [{"name": f"Subject {y}{j}", "description": "What is taught in it"} for j in range(4)]} for y in range(1, 4)]
    for i, career in enumerate(d["careers"]):
        career.update(title=f"Career {i}", route_badge="Possible after bachelor's" if i else "Postgraduate route")
    for i, r in enumerate(d["recruiters"]):
        r.update(name=f"Firm {i}", logo_initials="AB", roles=["Analyst", "Planner"])
    d["fees"]["rows"] = [
        {"category": f"Tuition {i}", "institution_type": t, "min": 10000, "max": 90000, "is_variable": False,
         "frequency": "Per year", "parent_check": "Ask for the full list"}
        for i, t in enumerate(("government", "private", None, None))]
    d["colleges"].update(ranking_updated="2024-05", items=[
        {"rank": i, "name": f"College {i}", "city": "Pune", "course_name": "One Course", "duration_years": 3,
         "institution_type": "government" if i % 2 else "private", "admission_route": "Test", "highlight": "Library",
         "annual_fee": 50000} for i in range(1, 7)])
    for i, c in enumerate(d["comparison"]):
        c["course_name"] = "One Course" if i == 0 else f"Other {i}"
    d["verification"] = {"last_reviewed": "2024-05-01", "sources": [
        {"title": f"Source {i}", "url": f"https://www.s{i}.gov.in/page", "publisher": "Office"} for i in range(3)]}
    return d


def put(document: dict, path: str, value):
    """Copy with the value at a path like a.b[0].c replaced (or removed, for ...)."""
    out = copy.deepcopy(document)
    steps = [int(s) if s.isdigit() else s for s in re.findall(r"[^.\[\]]+", path)]
    node = out
    for s in steps[:-1]:
        node = node[s]
    if value is ...:
        del node[steps[-1]]
    else:
        node[steps[-1]] = value
    return out


def _is_type(spec, x):
    number = isinstance(x, (int, float)) and not isinstance(x, bool)
    if x is None:
        return getattr(spec, "nullable", False)
    if isinstance(spec, Text):
        return isinstance(x, str)
    if isinstance(spec, Flag):
        return isinstance(x, bool)
    if isinstance(spec, Whole):
        return number and float(x).is_integer()
    if isinstance(spec, Number):
        return number
    return isinstance(x, list if isinstance(spec, Items) else dict)


def judge(spec, x, path=""):
    """(code, path) of every structural fault, found by plain recursion."""
    found = []
    if not _is_type(spec, x):
        found.append(("type", path))
    if isinstance(spec, Members):
        if isinstance(x, dict):
            found += [("required", path) for n in spec.members if n not in x and n not in spec.optional]
            if set(x) - set(spec.members):
                found.append(("additionalProperties", path))
            for n, child in spec.members.items():
                if n in x:
                    found += judge(child, x[n], f"{path}.{n}".lstrip("."))
        return found
    if isinstance(spec, Items):
        if isinstance(x, list):
            if len(x) < spec.low:
                found.append(("minItems", path))
            if len(x) > spec.high:
                found.append(("maxItems", path))
            if spec.unique and len({repr(v) for v in x}) < len(x):
                found.append(("uniqueItems", path))
            for i, v in enumerate(x):
                found += judge(spec.item, v, f"{path}[{i}]")
        return found
    if isinstance(spec, Text):
        if spec.values and x not in spec.values and not (x is None and spec.nullable):
            found.append(("enum", path))
        if isinstance(x, str):
            if spec.low is not None and len(x) < spec.low:
                found.append(("minLength", path))
            if spec.high is not None and len(x) > spec.high:
                found.append(("maxLength", path))
            if spec.pattern and not re.search(spec.pattern, x):
                found.append(("pattern", path))
    elif isinstance(spec, (Whole, Number)) and isinstance(x, (int, float)) and not isinstance(x, bool):
        if x < spec.low:
            found.append(("minimum", path))
        if x > spec.high:
            found.append(("maximum", path))
    return found
