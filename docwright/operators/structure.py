"""Structural validation of JSON documents against the declared schema.

Root properties, and entries of lists, whose JSON text matches a pattern derived
from the schema (`fine`) have no findings and are passed over; where only lists
are too short or too long, their entries are. The others are read into structs
of the declared shape whose scalars stay VARIANT, so a wrong type, a JSON null
and an absent member stay distinct; their scalars become nodes in one row-local
array and one lambda checks them all. No shuffle, no Python, no join.

The expression is put together as one SQL text, since it has thousands of parts
and is then handed to Spark in a single call.
"""

import json
import math
from itertools import count

from pyspark.sql import Column
from pyspark.sql import functions as F

from docwright.schema import DOCUMENT, Flag, Items, Members, Number, Text

TYPICAL_DURATION = "quick_facts.typical_duration"
PINNED_YEARS = "curriculum.years"
PINNED_YEAR = "curriculum.years[].year"
FINDING = "struct<code:string,path:string,message:string>"
_NODE = "struct<path:string,spec:int,v:variant,low:double,high:double>"
_NO_FINDINGS = f"cast(array() AS array<{FINDING}>)"

#: Findings about objects and lists themselves; a value's own type is one more of these and of the scalars'.
_OF_CONTAINERS = frozenset({"type", "required", "additionalProperties", "minItems", "maxItems", "uniqueItems"})
KEYWORDS = _OF_CONTAINERS | {"enum", "minLength", "maxLength", "pattern", "minimum", "maximum"}
_NO_NODES = f"cast(array() AS array<{_NODE}>)"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _texts(values) -> str:
    return f"cast(array({', '.join(_text(v) for v in values)}) AS array<string>)"


def _finding(code: str, path: str, message: str) -> str:
    return f"named_struct('code', '{code}', 'path', {path}, 'message', {message})"


def _when(condition: str, code: str, path: str, message: str) -> str:
    return f"IF({condition}, array({_finding(code, path, message)}), {_NO_FINDINGS})"


def _concat(parts, empty: str) -> str:
    parts = [p for p in parts if p is not None]
    return f"concat({', '.join(parts)})" if parts else empty


def _as_object(v: str) -> str:
    return f"try_variant_get({v}, '$', 'map<string,variant>')"


def _member_list(v: str, path: str) -> str:
    return f"try_variant_get({v}, '$.{path}', 'array<variant>')"


def _shape(spec, in_list: bool, omit: frozenset, at: str) -> str:
    """Type to read a value into. Entries of lists stay VARIANT; an entry is read into its members, whose lists are read when they are needed."""
    if isinstance(spec, Members):
        members = [
            f"`{name}`:{'variant' if in_list else _shape(child, False, omit, f'{at}.{name}')}"
            for name, child in spec.members.items()
            if f"{at}.{name}".lstrip(".") not in omit
        ]
        return f"struct<{','.join(members)}>"
    if isinstance(spec, Items):
        return f"array<{_shape(spec.item, True, omit, at + '[]') if in_list else 'variant'}>"
    return "variant"


# -- values without findings, known by their JSON text --

_NEVER = "(?!)"
#: A pattern's lists are walked by recursion, so longer ones are read.
LOOSE_ENTRIES = 32
_ANY_TEXT = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'


def _whole_pattern(low: int, high: int) -> str:
    """Whole numbers from low to high in digits; of long ranges most of them."""
    if high - low <= 20:
        return "(?:" + "|".join(str(n) for n in range(low, high + 1)) + ")"
    if low != 0:
        return _NEVER
    lead, rest = int(str(high)[0]), len(str(high)) - 1
    parts = ["0", f"[1-9][0-9]{{0,{rest - 1}}}"] + ([f"[1-{lead - 1}][0-9]{{{rest}}}"] if lead > 1 else [])
    return f"(?:{'|'.join(parts)})(?![0-9])"


def fine(spec, omit: frozenset = frozenset(), at: str = "", names=None, by_name: bool = True, loose: bool = False) -> str:
    """Pattern of JSON texts without blanks whose values give no finding of any keyword; members by name, as Spark writes a VARIANT, or in the schema's order.

    It misses some such values (texts with escapes, numbers with an exponent): what does not match has to be looked at.
    A loose one takes lists that are too short or too long, unless they are empty, inside other lists or their entries must differ."""
    names = count() if names is None else names
    if isinstance(spec, Members):
        known = [n for n in spec.members if f"{at}.{n}".lstrip(".") not in omit]
        known = sorted(known) if by_name else known
        parts = [(f'"{n}":{fine(spec.members[n], omit, f"{at}.{n}".lstrip("."), names, by_name, loose)}', n in spec.optional) for n in known]
        if not parts or parts[0][1]:
            return _NEVER
        return r"\{" + parts[0][0] + "".join(f"(?:,{p})?" if optional else f",{p}" for p, optional in parts[1:]) + r"\}"
    if isinstance(spec, Items):
        entry = fine(spec.item, omit, f"{at}[]", names, by_name)
        if spec.unique:
            if not isinstance(spec.item, Text):
                return _NEVER
            name = f"u{next(names)}"
            entry = rf"(?<{name}>{entry})(?!(?:,{_ANY_TEXT})*,\k<{name}>[,\]])"
        low, high = (1, LOOSE_ENTRIES) if loose and not spec.unique else (spec.low, spec.high)
        return rf"\[(?:{entry},?){{{low},{high}}}\]"
    if isinstance(spec, Flag):
        return "(?:true|false)"
    if isinstance(spec, Number):
        low, high = math.ceil(spec.low), math.floor(spec.high) - 1
        return rf"{_whole_pattern(low, high)}(?:\.[0-9]{{1,9}})?" if 0 <= low <= high <= low + 20 else _NEVER
    if not isinstance(spec, Text):
        pattern = _whole_pattern(spec.low, spec.high)
    elif spec.values is not None:
        pattern = "(?:" + "|".join(re_quote(json.dumps(v, ensure_ascii=False)) for v in spec.values) + ")"
    else:
        size = "*+" if spec.low is None and spec.high is None else f"{{{spec.low or 0},{'' if spec.high is None else spec.high}}}+"
        pattern = rf'"[^"\\]{size}"'
        if spec.pattern is not None:
            inner = spec.pattern.removeprefix("^")
            form = inner.removesuffix("$") if inner.endswith("$") else rf'{inner}[^"\\]*+'
            pattern = rf'(?={pattern})"{form}"' if spec.pattern.startswith("^") else _NEVER
    return f"(?:{pattern}|null)" if spec.nullable else pattern


def in_any_order(spec, omit: frozenset, at: str, loose: bool = False) -> str:
    """fine of members by name or in the schema's order."""
    names = count()
    return "(?:" + "|".join(dict.fromkeys(fine(spec, omit, at, names, by_name, loose) for by_name in (False, True))) + ")"


def outer_lists(spec, at: str) -> list:
    """(spec, path) of the lists that a loose pattern lets pass at any length."""
    if isinstance(spec, Members):
        return [found for name, child in spec.members.items() for found in outer_lists(child, f"{at}.{name}")]
    return [(spec, at)] if isinstance(spec, Items) and not spec.unique else []


def first_scalar(spec, at: str) -> str:
    """Path of a scalar that every value without findings has, and that no scalar has."""
    if isinstance(spec, Members):
        name = next(n for n in spec.members if n not in spec.optional)
        return first_scalar(spec.members[name], f"{at}.{name}")
    return first_scalar(spec.item, f"{at}[0]") if isinstance(spec, Items) else at


def re_quote(text: str) -> str:
    return r"\Q" + text + r"\E"


def _matches(text: str, pattern: str) -> str:
    return f"coalesce(rlike({text}, {_text(chr(92) + 'A' + pattern + chr(92) + 'z')}), false)"


def _is_fine(v: str, pattern: str) -> str:
    return _matches(f"to_json({v})", pattern)


def keywords_of(spec) -> frozenset:
    """Codes of the findings that a value at this place can give by itself, without those of its members or entries."""
    if isinstance(spec, Members):
        return frozenset({"type", "required", "additionalProperties"})
    if isinstance(spec, Items):
        return frozenset({"type", "minItems", "maxItems"} | ({"uniqueItems"} if spec.unique else set()))
    limits = ("minLength", "maxLength") if isinstance(spec, Text) else ("minimum", "maximum")
    given = {limits[0]: getattr(spec, "low", None), limits[1]: getattr(spec, "high", None), "pattern": getattr(spec, "pattern", None), "enum": getattr(spec, "values", None)}
    return frozenset({"type"} | {code for code, value in given.items() if value is not None})


def reaches(spec, keywords) -> bool:
    """Whether a value at this place, or one below it, can give one of these findings."""
    below = spec.members.values() if isinstance(spec, Members) else (spec.item,) if isinstance(spec, Items) else ()
    return bool(keywords_of(spec) & keywords) or any(reaches(child, keywords) for child in below)


def properties_with(*keywords: str) -> tuple:
    """The root properties without which one of these findings could be missed: all of them, for what concerns the root itself."""
    asked = frozenset(keywords)
    of_root = asked & {"type", "required", "additionalProperties"}
    return tuple(name for name, spec in DOCUMENT.members.items() if of_root or reaches(spec, asked))


class _Compiler:
    """Collects the SQL of one document shape. body, document, pinned and skip name columns; only findings of these keywords are looked for."""

    def __init__(self, body: str, document: str, pinned: str | None, skip: str | None, omit: frozenset, keywords: frozenset):
        self.body, self.document, self.pinned, self.skip, self.omit, self.keywords = body, document, pinned, skip, omit, keywords
        self.names_column = None  # root keys that have been read
        self.names = 0
        self.specs = []       # what scalar nodes point into
        self.nodes = []       # arrays of scalar nodes
        self.findings = []    # arrays of findings about containers and their keys
        self.levels = []      # members of the struct `level`: of a root property 0 without findings, 1 if only lists have a wrong length, else 2
        self.odd = []         # members of the struct `odd`: the entries of a list that do not match its pattern

    # -- helpers --

    def fresh(self) -> tuple[str, str]:
        self.names += 1
        return f"x{self.names}", f"i{self.names}"

    def spec_number(self, spec) -> int:
        key = (
            type(spec).__name__, getattr(spec, "nullable", False),
            getattr(spec, "pattern", None), getattr(spec, "values", None),
        )
        if key not in self.specs:
            self.specs.append(key)
        return self.specs.index(key) + 1

    def wants(self, spec) -> bool:
        return bool(keywords_of(spec) & self.keywords)

    def table(self) -> str:
        if not self.specs:
            self.spec_number(Flag())
        rows = [
            f"named_struct('kind', '{kind}', 'nullable', {str(nullable).lower()}, "
            f"'pattern', {_text(pattern) if pattern else 'cast(NULL AS string)'}, "
            f"'values', {_texts(values) if values else 'cast(NULL AS array<string>)'})"
            for kind, nullable, pattern, values in self.specs
        ]
        return f"array({', '.join(rows)})"

    def members(self, spec, shape):
        for name, child in spec.members.items():
            inside = f"{shape}.{name}".lstrip(".")
            if inside not in self.omit:
                yield name, child, inside, name in spec.optional

    def scalar(self, spec, v: str, path: str, shape: str) -> str:
        number = lambda n: "cast(NULL AS double)" if n is None else f"cast({n} AS double)"
        low, high = number(getattr(spec, "low", None)), number(getattr(spec, "high", None))
        if shape == PINNED_YEAR and self.pinned:
            high = f"coalesce(cast({self.pinned} AS double), {high})"
        return f"named_struct('path', {path}, 'spec', {self.spec_number(spec)}, 'v', {v}, 'low', {low}, 'high', {high})"

    def list_limits(self, spec, items: str, path: str, shape: str, size: str | None = None) -> list[str]:
        """size is given where the list is not read; it is then there and has no repeats that count."""
        low, high = str(spec.low), str(spec.high)
        if shape == PINNED_YEARS and self.pinned:
            low, high = f"coalesce({self.pinned}, {low})", f"coalesce({self.pinned}, {high})"
        items, size = size or items, size or f"size({items})"
        say = lambda bound, limit, end: f"concat_ws(' ', 'list has', {size}, 'entries, at {bound}', {limit}, '{end}')"
        parts = []
        if self.keywords & {"minItems", "maxItems"}:
            parts = [
                _when(f"{items} IS NOT NULL AND {size} < {low}", "minItems", path, say("least", low, "needed")),
                _when(f"{items} IS NOT NULL AND {size} > {high}", "maxItems", path, say("most", high, "allowed")),
            ]
        if spec.unique and "uniqueItems" in self.keywords:
            x, _ = self.fresh()
            distinct = f"size(array_distinct(transform({items}, {x} -> to_json({x}))))"
            parts.append(_when(f"{items} IS NOT NULL AND {distinct} < {size}", "uniqueItems", path, "'list repeats an entry'"))
        return parts

    # -- values reached without passing through a list --

    def compile_root(self, root):
        """Findings about the root itself, and those of each property unless it is fine."""
        self.compile_members(root, "d", "", self.compile_property)

    def compile_property(self, spec, value: str, shape: str):
        fixed = (self.pinned and PINNED_YEARS.startswith(f"{shape}.")) or (self.skip and TYPICAL_DURATION.startswith(f"{shape}."))
        lists = [] if fixed else outer_lists(spec, shape)
        self.levels.append(f"'{shape}', {'2' if fixed else self.level(spec, shape, bool(lists))}")
        before = self.nodes, self.findings
        self.nodes, self.findings = [], []
        self.compile(spec, value, shape)
        nodes, findings = [n for n in self.nodes if n != _NO_NODES], self.findings
        self.nodes, self.findings = before
        if nodes:
            self.nodes.append(f"IF(level.`{shape}` < 2, {_NO_NODES}, {_concat(nodes, _NO_NODES)})")
        if findings:
            short = [limit for child, at in lists for limit in self.list_limits(child, "", _text(at), at, f"size(try_variant_get({self.document}, '$.{at}', 'array<boolean>'))")]  # what the entries are is known
            self.findings.append(f"IF(level.`{shape}` = 0, {_NO_FINDINGS}, IF(level.`{shape}` = 1, {_concat(short, _NO_FINDINGS)}, {_concat(findings, _NO_FINDINGS)}))")

    def level(self, spec, shape: str, lists: bool) -> str:
        raw, pattern = f"raw.`{shape}`", lambda loose: _matches(f"raw.`{shape}`", in_any_order(spec, self.omit, shape, loose))
        there = lambda path: f"try_variant_get({self.document}, '$.{path}', 'variant')"
        if isinstance(spec, Text):
            tests = [f"schema_of_variant({there(shape)}) = 'STRING'"] + [f"char_length({raw}) {sign} {n}" for sign, n in ((">=", spec.low), ("<=", spec.high)) if n is not None]
            tests += [f"rlike({raw}, {_text(spec.pattern)})"] if spec.pattern else []
            tests += [f"array_contains({_texts(spec.values)}, {raw})"] if spec.values else []
            return f"IF(coalesce({' AND '.join(tests)}, false), 0, 2)"
        if not isinstance(spec, (Members, Items)):
            return f"IF({_is_fine(there(shape), fine(spec, self.omit, shape))}, 0, 2)"
        # A text that holds JSON reads like what it holds, but has no members.
        other = f"IF({pattern(True)}, 1, 2)" if lists else "2"
        return f"IF({there(first_scalar(spec, shape))} IS NULL, 2, IF({pattern(False)}, 0, {other}))"

    def compile(self, spec, value: str, shape: str):
        if isinstance(spec, Members):
            self.compile_members(spec, value, shape, self.compile)
        elif isinstance(spec, Items):
            self.findings += self.list_limits(spec, value, _text(shape), shape)
            if reaches(spec.item, self.keywords):
                odd = self.odd_entries(spec, value, shape)
                self.nodes.append(self.entry_nodes(spec, odd, _text(shape), shape, outer=True))
                if isinstance(spec.item, Members):
                    if reaches(spec.item, self.keywords & _OF_CONTAINERS):
                        self.findings.append(self.entry_findings(spec, odd, _text(shape), shape, outer=True))
                    if "additionalProperties" in self.keywords:
                        self.findings.append(self.entry_unknown(spec, odd, _text(shape), shape, outer=True))
        elif self.wants(spec):
            self.nodes.append(f"array({self.scalar(spec, value, _text(shape), shape)})")

    def odd_entries(self, spec, value: str, shape: str) -> str:
        """Name of the list of entries that do not match their pattern: i, the place, v, the raw entry, x, the entry as it is read."""
        x, i = self.fresh()
        pattern = _NEVER if shape == PINNED_YEARS and self.pinned else fine(spec.item, self.omit, f"{shape}[]")
        read = f"try_variant_get({x}.v, '$', '{_shape(spec.item, True, self.omit, shape + '[]')}')"
        rows = f"filter(transform({value}, ({x}, {i}) -> named_struct('v', {x}, 'i', {i})), {x} -> NOT {_is_fine(f'{x}.v', pattern)})"
        name = f"o{len(self.odd)}"
        self.odd.append(f"'{name}', IF(level.`{shape.split('.')[0]}` < 2, NULL, transform({rows}, {x} -> named_struct('i', {x}.i, 'v', {x}.v, 'x', {read})))")
        return f"odd.{name}"

    def entry(self, outer: bool) -> tuple[str, str, str, str]:
        """Of a lambda over entries: its arguments, the entry as it is read, its place, and the raw entry."""
        x, i = self.fresh()
        return (x, f"{x}.x", f"{x}.i", f"{x}.v") if outer else (f"({x}, {i})", x, i, x)

    def compile_members(self, spec, value: str, shape: str, below):
        path, known = _text(shape), []
        for name, child, inside, optional in self.members(spec, shape):
            member, gone = f"{value}.`{name}`", f"{value} IS NOT NULL AND {value}.`{name}` IS NULL"
            gone = gone if shape else f"level.`{name}` = 2 AND {gone}"  # others are not read
            skipped = self.skip if inside == TYPICAL_DURATION else None
            if skipped:
                gone = f"NOT {skipped} AND {gone}"
                known.append(f"IF({skipped}, array(), array('{name}'))")
                member = f"IF({skipped}, NULL, {member})"
            else:
                known.append(f"array('{name}')")
            missing = f"array({_finding('required', path, _text(name + ' is missing'))})"
            if not self.keywords & {"type", "required"}:
                pass
            elif isinstance(child, (Members, Items)):
                kind = "object" if isinstance(child, Members) else "array"
                wrong = f"array({_finding('type', _text(inside), _text('value is not of type ' + kind))})"
                raw = f"try_variant_get({self.document}, '$.{inside}', 'variant')"
                self.findings.append(f"IF({gone}, IF({raw} IS NULL, {missing}, {wrong}), {_NO_FINDINGS})")
            elif not optional:
                self.findings.append(f"IF({gone}, {missing}, {_NO_FINDINGS})")
            below(child, member, inside)
        if "additionalProperties" in self.keywords:
            here = f"try_variant_get({self.document}, '$.{shape}', 'variant')"
            keys = f"map_keys({_as_object(here)})" if shape else f"IF(d IS NULL, NULL, {self.names_column or f'json_object_keys({self.body})'})"
            self.findings.append(self.unknown_keys(keys, f"concat({', '.join(known)})", path))

    def unknown_keys(self, keys: str, known: str, path: str) -> str:
        extra = f"coalesce(size(array_except({keys}, {known})), 0) > 0"
        return _when(extra, "additionalProperties", path, "'object has keys that are not allowed'")

    # -- list entries, at paths that carry an index --

    def at(self, path: str, i: str, name: str = "") -> str:
        return f"concat({path}, '[', {i}, ']{'.' + name if name else ''}')"

    def inner_lists(self, spec, x: str, path: str, i: str, shape: str):
        """Lists among the members of an entry: (spec, items, raw member, path, shape)."""
        for name, child, s, _ in self.members(spec.item, f"{shape}[]"):
            if isinstance(child, Items):
                items = f"try_variant_get({x}.`{name}`, '$', '{_shape(child, True, self.omit, s)}')"
                yield child, items, f"{x}.`{name}`", self.at(path, i, name), s

    def entry_nodes(self, spec, items: str, path: str, shape: str, outer: bool = False) -> str:
        if not reaches(spec.item, self.keywords - _OF_CONTAINERS | (self.keywords & {"type"})):
            return _NO_NODES
        given, x, i, _ = self.entry(outer)
        if not isinstance(spec.item, Members):
            node = self.scalar(spec.item, x, self.at(path, i), f"{shape}[]")
            return f"coalesce(transform({items}, {given} -> {node}), {_NO_NODES})"
        own = [
            self.scalar(c, f"{x}.`{n}`", self.at(path, i, n), s)
            for n, c, s, _ in self.members(spec.item, f"{shape}[]") if not isinstance(c, Items) and self.wants(c)
        ]
        own = [f"array({', '.join(own)})"] if own else []
        inner = [self.entry_nodes(c, inside, p, s) for c, inside, _, p, s in self.inner_lists(spec, x, path, i, shape)]
        every = _concat([*own, *inner], _NO_NODES)
        return f"coalesce(flatten(transform({items}, {given} -> {every})), {_NO_NODES})"

    def entry_findings(self, spec, items: str, path: str, shape: str, outer: bool = False) -> str:
        given, x, i, _ = self.entry(outer)
        here = self.at(path, i)
        parts = [_when(f"{x} IS NULL", "type", here, "'value is not of type object'")] if "type" in self.keywords else []
        for name, _, _, optional in self.members(spec.item, f"{shape}[]"):
            if not optional and "required" in self.keywords:
                parts.append(_when(f"{x} IS NOT NULL AND {x}.`{name}` IS NULL", "required", here, _text(name + " is missing")))
        for child, inside, raw, p, s in self.inner_lists(spec, x, path, i, shape):
            if "type" in self.keywords:
                parts.append(_when(f"{raw} IS NOT NULL AND {inside} IS NULL", "type", p, "'value is not of type array'"))
            parts += self.list_limits(child, inside, p, s)
            if isinstance(child.item, Members) and reaches(child.item, self.keywords & _OF_CONTAINERS):
                parts.append(self.entry_findings(child, inside, p, s))
        return f"coalesce(flatten(transform({items}, {given} -> {_concat(parts, _NO_FINDINGS)})), {_NO_FINDINGS})"

    def entry_unknown(self, spec, items: str, path: str, shape: str, outer: bool = False) -> str:
        given, _, i, raw = self.entry(outer)
        members = list(self.members(spec.item, f"{shape}[]"))
        parts = [self.unknown_keys(f"map_keys({_as_object(raw)})", _texts(n for n, _, _, _ in members), self.at(path, i))]
        parts += [
            self.entry_unknown(c, _member_list(raw, n), self.at(path, i, n), s)
            for n, c, s, _ in members if isinstance(c, Items) and isinstance(c.item, Members)
        ]
        return f"coalesce(flatten(transform({items}, {given} -> {_concat(parts, _NO_FINDINGS)})), {_NO_FINDINGS})"


# Cheap test that lets the usual case, a scalar node n without findings, skip the checks below.
_FINE = f"""coalesce(
  IF(n.b.kind = '{Text.__name__}',
     coalesce(char_length(n.text) >= n.low AND char_length(n.text) <= n.high, n.text IS NOT NULL AND n.low IS NULL)
       AND (n.b.pattern IS NULL OR rlike(n.text, n.b.pattern))
       AND (n.b.values IS NULL OR array_contains(n.b.values, n.text)),
     n.b.kind <> '{Flag.__name__}' AND n.num = floor(n.num) AND n.num >= n.low AND n.num <= n.high),
  false)"""

_RIGHT_TYPE = f"""CASE WHEN n.t = 'VOID' THEN n.b.nullable
  WHEN n.b.kind = '{Text.__name__}' THEN n.text IS NOT NULL
  WHEN n.b.kind = '{Flag.__name__}' THEN n.t = 'BOOLEAN'
  WHEN n.b.kind = '{Number.__name__}' THEN n.num IS NOT NULL
  ELSE n.num IS NOT NULL AND n.num = floor(n.num) END"""
_TYPE_NAME = f"""CASE n.b.kind WHEN '{Text.__name__}' THEN 'string' WHEN '{Flag.__name__}' THEN 'boolean'
  WHEN '{Number.__name__}' THEN 'number' ELSE 'integer' END"""
_ALLOWED = "coalesce(array_contains(n.b.values, n.text), n.t = 'VOID' AND n.b.nullable)"


def _length_message(bound: str, limit: str, end: str) -> str:
    return f"concat_ws(' ', 'text has', char_length(n.text), 'characters, at {bound}', cast({limit} AS bigint), '{end}')"


_IS_TEXT = f"n.b.kind = '{Text.__name__}'"
_CHECKS = {
    "type": _when(f"NOT ({_RIGHT_TYPE})", "type", "n.path", f"concat('value is not of type ', {_TYPE_NAME})"),
    "enum": _when(f"n.b.values IS NOT NULL AND NOT {_ALLOWED}", "enum", "n.path", "'value is not one of the allowed choices'"),
    "minLength": _when(f"{_IS_TEXT} AND char_length(n.text) < n.low", "minLength", "n.path", _length_message("least", "n.low", "needed")),
    "maxLength": _when(f"{_IS_TEXT} AND char_length(n.text) > n.high", "maxLength", "n.path", _length_message("most", "n.high", "allowed")),
    "pattern": _when("n.b.pattern IS NOT NULL AND n.text IS NOT NULL AND NOT rlike(n.text, n.b.pattern)", "pattern", "n.path",
                     "'text does not have the required form'"),
    "minimum": _when(f"NOT {_IS_TEXT} AND n.num < n.low", "minimum", "n.path", "'value is below the least allowed'"),
    "maximum": _when(f"NOT {_IS_TEXT} AND n.num > n.high", "maximum", "n.path", "'value is above the largest allowed'"),
}

_NUMBER = "(t.t IN ('BIGINT', 'DOUBLE', 'FLOAT') OR startswith(t.t, 'DECIMAL'))"

def examine_columns(
    body: str,
    document: str,
    properties=None,
    *,
    derived=frozenset(),
    pinned_years: str | None = None,
    skip_duration: str | None = None,
    raw: str | None = None,
    names: str | None = None,
) -> Column:
    """struct<findings> of one document; all inputs are column names.

    body is the JSON text and document the VARIANT read from it; raw is the
    text read as RAW_TYPE and names its root keys; both are read here if they
    are not given. properties
    keeps only some root properties (a section); derived paths are then neither
    required nor allowed. pinned_years fixes the number of curriculum years per
    row; skip_duration takes the typical duration out of the schema per row.

    findings is array<struct<code, path, message>>.
    """
    root = DOCUMENT if properties is None else Members({p: DOCUMENT.members[p] for p in properties})
    compiler = _Compiler(body, document, pinned_years, skip_duration, frozenset(derived), KEYWORDS)
    compiler.names_column = names
    return F.struct(F.expr(_examined(compiler, root, raw)).alias("findings"))


def keyword_findings(body: str, document: str, *keywords: str) -> Column:
    """Findings with these codes alone, as examine_columns gives them; what can give no other is not looked at.

    body and document need hold no other root properties than properties_with(*keywords)."""
    root = Members({p: DOCUMENT.members[p] for p in properties_with(*keywords)})
    compiler = _Compiler(body, document, None, None, frozenset(), frozenset(keywords))
    return F.filter(F.expr(_examined(compiler, root)), lambda f: f["code"].isin(*keywords))


def _examined(compiler: _Compiler, root, raw: str | None = None) -> str:
    """The findings of a document with these root properties."""
    column, compiler.document = compiler.document, "doc"
    compiler.compile_root(root)
    fields = [f"`{p}` string" for p in root.members]
    names = [p for p in root.members if p not in compiler.omit]
    read = [f"'{p}', IF(level.`{p}` < 2, NULL, try_variant_get({compiler.document}, '$.{p}', '{_shape(root.members[p], False, compiler.omit, p)}'))" for p in names]
    struct = lambda members: f"named_struct({', '.join(members)})" if members else "named_struct('none', 0)"
    is_object = f"try_variant_get({compiler.document}, '$', 'struct<none:variant>') IS NOT NULL"
    found = _let("odd", struct(compiler.odd), _let("nodes", _read(compiler), _found(compiler)))
    found = _let("level", struct(compiler.levels), _let("d", f"IF({is_object}, {struct(read)}, NULL)", found))
    # Named once, since each mention of the column would copy the whole document out of its row.
    return _let("doc", column, _let("raw", raw or f"from_json({compiler.body}, {_text(', '.join(fields))})", found))


def _let(name: str, value: str, use: str) -> str:
    """Binds a value once, by a lambda over an array of one entry."""
    return f"element_at(transform(array({value}), {name} -> {use}), 1)"


def _read(compiler: _Compiler) -> str:
    """The scalar nodes with their types, texts and numbers."""
    nodes = _concat([n for n in compiler.nodes if n != _NO_NODES], _NO_NODES)
    typed = f"""transform(filter({nodes}, n -> n.v IS NOT NULL),
      n -> named_struct('path', n.path, 'low', n.low, 'high', n.high, 'v', n.v,
        'b', element_at({compiler.table()}, n.spec), 't', schema_of_variant(n.v)))"""
    return f"""transform({typed}, t -> named_struct('path', t.path, 'low', t.low, 'high', t.high, 'b', t.b, 't', t.t,
        'text', IF(t.t = 'STRING', try_variant_get(t.v, '$', 'string'), NULL),
        'num', IF({_NUMBER}, try_variant_get(t.v, '$', 'double'), NULL)))"""


def _found(compiler: _Compiler) -> str:
    checks = _concat([check for code, check in _CHECKS.items() if code in compiler.keywords], _NO_FINDINGS)
    return _concat([
        _when("d IS NULL", "type", "''", "'value is not of type object'"),
        *compiler.findings,
        f"flatten(transform(filter(nodes, n -> NOT {_FINE}), n -> {checks}))",
    ], _NO_FINDINGS)


def path_order(path: Column) -> Column:
    """Sort key that puts paths in document order: by member, then by index as a number."""
    padded = F.regexp_replace(path, r"\[(\d+)\]", "[000000000$1]")
    return F.regexp_replace(padded, r"\[0*(\d{9})\]", "[$1]")
