"""Secret scan: fixed patterns, and assignments read as name-literal pairs with constants followed.

Every `:`, `=`, `:=` or `=>` of a text may bind a name before it to what comes after: literals,
other names, sums of both and what stands in brackets, also on later lines. Names in a row take values
in a row by place, and an element's `key` or `name` attribute its `value`. Names are followed to the literals that reach them, in any order of
the statements, and a literal is scored by the most telling name it reaches and by how random it
looks. Literals over the threshold are added to the spans of the fixed patterns.
"""

from __future__ import annotations

import bisect
import hashlib
import itertools
import math
import re
from collections import Counter, defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame

from stayscope.llm.common import map_texts, table

# Fixed patterns of the base spans; a kind's matches don't overlap, failing ones included.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
HINTS = ("password", "passwd", "secret", "token", "api")
KINDS = ("assign", "access", "hex", "literal")

BIND = re.compile(r"=>|:=|=(?!=)|:(?![:/=])")
NAME_BACK = re.compile(r"""[ \t]*(?:\][ \t]*)?["'`]?([\w.$-]*[A-Za-z_$])""")
PART = re.compile(
    r"""[ \t]*(?:[frbuFRBU]{0,2}(?:\"{3}((?:[^"\\]|\\[\s\S]|"(?!""))*+)\"{3}|'{3}((?:[^'\\]|\\[\s\S]|'(?!''))*+)'{3}"""
    r"""|"((?:[^"\\\n]|\\.)*)"|'((?:[^'\\\n]|\\.)*)'|`([^`\n]*)`)"""
    r"""|([A-Za-z_$][\w.$]*)(?![\w+/=-])|([A-Za-z0-9+/_.=-]+))"""
)
PLUS = re.compile(
    r"""[ \t]*+(?:\\\n[ \t]*+)?(?:(?:[+.]|\|\||\?\?)[ \t]*+(?:\\?\n[ \t]*+)?(?=["'`A-Za-z_$])|or[ \t]++(?=["']))"""
)
NEXT_LINE = re.compile(r"[ \t]*+\\?\r?\n[ \t]*+(?=[\"'`])")
BLANKS = re.compile(r"[ \t]*+")
GAP = re.compile(r"(?:\s++|#[^\n]*+|//[^\n]*+)*+")
ROW_BACK = re.compile(r"[ \t]*+,[ \t]*+([\w.$-]++)")
ROW_START = re.compile(r"(?:.*;)?\s*+(?:let|var|const|local|my)?\s*+", re.S)
KEYWORD = re.compile(r"[\w.$-]++\s*+(?:=>|:=|=(?!=)|:(?![:/=]))")
NAME_LIKE = re.compile(r"[A-Z][A-Z0-9_]*+|[a-z][a-z_.-]*+")
ELEMENT = re.compile(r"""<[A-Za-z][\w:.-]*+((?:\s++[\w:.-]++\s*+=\s*+(?:"[^"<>]*+"|'[^'<>]*+'))++)\s*+/?>""")
PAIR = re.compile(r"""([\w:.-]++)\s*+=\s*+(?:"([^"<>]*+)"|'([^'<>]*+)')""")
PIECE = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")

NAME_WEIGHTS = {
    "password": 1.0, "passwd": 1.0, "pwd": 1.0, "passphrase": 1.0, "secret": 1.0, "token": 1.0, "apikey": 1.0,
    "credential": 0.9, "credentials": 0.9, "auth": 0.8, "authorization": 0.8, "bearer": 0.8, "signature": 0.7, "salt": 0.6,
}
KEY_KINDS = {"api", "access", "private", "signing", "encryption", "secret", "master", "account", "service"}
PLACEHOLDERS = re.compile(r"x{4,}|\*{3,}|<[^<>]*+>|\$\{(?:[^}$]|\$(?!\{))*+\}|%\([^()]*+\)s|change_?me|example|placeholder|your[_-]", re.I)
THRESHOLD = 0.6
SHORTEST = 8


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns."""
    lower = text.lower()
    found = [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)] if "AKIA" in text else []
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    if any(h in lower for h in HINTS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    return sorted(found)


def name_weight(name: str) -> float:
    """How telling a name is: by its words, split at case and signs."""
    words = [w.lower() for w in PIECE.findall(name)]
    best = max((NAME_WEIGHTS.get(w, 0.0) for w in words), default=0.0)
    pairs = {a + b for a, b in zip(words, words[1:], strict=False)}
    if "apikey" in pairs or ("key" in words and KEY_KINDS & set(words)):
        best = 1.0
    return best


def strength(literal: str) -> float:
    """How random a literal looks, 0 to 1: its entropy in bits against 64."""
    if len(literal) < SHORTEST or PLACEHOLDERS.search(literal) or re.search(r"\s", literal):
        return 0.0
    n = len(literal)
    bits = -sum(c * math.log2(c / n) for c in Counter(literal).values())
    return min(1.0, bits / 64 + 0.3)


def sum_at(text: str, pos: int) -> tuple[list[tuple[int, int]], list[tuple[int, int]], int]:
    """Literals and names of the sum that starts here, and where it ends."""
    literals, names = [], []
    while part := PART.match(text, pos):
        group = part.lastindex
        if group == 6:
            names.append(part.span(6))
        elif group <= 2:  # lines of a literal in three quotes: without the white space around them
            inside = part[group].removeprefix("\\\n")
            a = part.end(group) - len(inside.lstrip())
            literals.append((a, a + len(inside.strip())))
        else:
            literals.append(part.span(group))
        pos = part.end()
        if not (plus := PLUS.match(text, pos)):
            break
        pos = plus.end()
    return literals, names, pos


def value_at(text: str, pos: int, places: int) -> tuple[list[tuple[list, list]], int]:
    """(literals, names) of each of at most `places` values in a row from here, and where reading stopped.

    What stands in brackets belongs to its value; of a call's arguments, names in quotes don't count.
    Reading stops at what binds another name.
    """
    line = NEXT_LINE.match(text, pos)
    pos = line.end() if line else pos
    values, calls, within = [([], [])], [], 0  # which open brackets are calls, and how many
    while True:
        gap = GAP if calls else BLANKS
        pos = gap.match(text, pos).end()
        if (calls or len(values) > 1) and KEYWORD.match(text, pos):
            break
        literals, names, after = sum_at(text, pos)
        if (calls or len(values) > 1) and BIND.match(text, gap.match(text, after).end()):
            break
        call = bool(names) and names[-1][1] == after and text.startswith("(", after)
        if call:
            names.pop()
        if within:
            literals = [(a, b) for a, b in literals if not NAME_LIKE.fullmatch(text, a, b)]
        values[-1][0].extend(literals)
        values[-1][1].extend(names)
        idle, pos = after == pos, gap.match(text, after).end()
        sign = text[pos : pos + 1]
        if call or idle and sign and sign in "([":
            calls.append(call)
            within += call
            pos += 1
            continue
        closed = False
        while calls and sign and sign in ")]":
            within -= calls.pop()
            closed = True
            pos = (GAP if calls else BLANKS).match(text, pos + 1).end()
            sign = text[pos : pos + 1]
        plus = PLUS.match(text, pos) if closed else None
        if plus:
            pos = plus.end()
        elif sign == "," and (calls or len(values) < places):
            pos += 1
            if not calls:
                values.append(([], []))
        elif not calls or idle and not closed:
            break
    return values, pos


def bindings(text: str) -> list[tuple[str, list[tuple[int, int]], list[tuple[int, int]]]]:
    """(name, spans of its literals, spans of the names it is made of) of every assignment."""
    found, back, read = [], 0, 0
    for m in BIND.finditer(text):
        at = max(text.rfind("\n", back, m.start()) + 1, back)
        before = text[at : m.start()][::-1]
        name = NAME_BACK.match(before)
        back = m.end()
        if not name or not name[1]:
            continue
        targets, end = [name[1][::-1]], name.end()
        while m[0] in ("=", ":=") and (more := ROW_BACK.match(before, end)):  # names in a row, the last one first
            targets.append(more[1][::-1])
            end = more.end()
        if len(targets) > 1 and not ROW_START.fullmatch(before[end:][::-1]):
            targets = targets[:1]
        if m.start() < read:  # inside of brackets that were read for another name
            values = [sum_at(text, m.end())[:2]]
        else:
            values, read = value_at(text, m.end(), len(targets))
        if len(values) < len(targets):
            targets = targets[:1]
        for target, (literals, names) in zip(reversed(targets), values, strict=False):
            if literals or names:
                found.append((target, literals, names))
    for m in ELEMENT.finditer(text) if "<" in text else ():
        pairs = {p[1].lower(): p for p in PAIR.finditer(text, m.start(1), m.end(1))}
        key, value = pairs.get("key") or pairs.get("name"), pairs.get("value")
        if key and value:
            found.append((key[key.lastindex], [value.span(value.lastindex)], []))
    return found


def literal_spans(text: str, threshold: float = THRESHOLD) -> list[tuple[int, int, int]]:
    """(start, kind, end) of literals whose best target name makes them likely secrets."""
    pairs = bindings(text)
    if not pairs:
        return []
    sources, weights = defaultdict(list), {name: name_weight(name) for name, _, _ in pairs}
    for name, literals, names in pairs:
        for a, b in names:
            other = text[a:b]
            if other in weights:
                sources[name].append(other)
            elif re.search(r"\d", other) and re.search(r"[A-Za-z]", other):  # nothing binds it: a bare literal
                literals.append((a, b))
    reach = dict(weights)
    for name in sorted(weights, key=weights.get, reverse=True):  # a name takes the weight of what it flows into
        todo, seen = [name], {name}
        while todo and weights[name] > 0:
            for other in sources[todo.pop()]:
                if other not in seen and reach.get(other, 0.0) < weights[name]:
                    reach[other] = weights[name]
                    seen.add(other)
                    todo.append(other)
    return sorted(
        {
            (a, 3, b)
            for name, literals, _ in pairs
            if reach[name] > 0
            for a, b in literals
            if reach[name] * strength(text[a:b]) >= threshold
        }
    )


def scan_text(text: str | None, threshold: float = THRESHOLD):
    """Counts of the three base kinds, digest of the base spans, all spans as text."""
    text = text or ""
    base = base_spans(text)
    reached = list(itertools.accumulate((b[2] for b in base), max, initial=0))  # how far the first ones go
    starts = [b[0] for b in base]
    more = [s for s in literal_spans(text, threshold) if reached[bisect.bisect(starts, s[0])] < s[2]]
    named = [f"{KINDS[k]}:{a}:{b}" for a, k, b in base]
    counts = Counter(k for _, k, _ in base)
    spans = [f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(base + more)]
    digest = hashlib.sha256(",".join(named).encode()).hexdigest()
    return counts[0], counts[1], counts[2], digest, ",".join(spans)


def find_secrets(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per row of `docs` (doc_id, text): counts, base_sha256 and spans, in code points, end exclusive.

    NULL and empty texts have no spans, repeated rows stay and an empty table gives an empty one. Rows stay
    where they are; whole texts are read, each in time that grows with its length alone. Other columns of
    `docs` are not read, whatever their names.
    """
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    names = ["n_assign", "n_access", "n_hex", "base_sha256", "spans"]

    def scan(texts: list[str]) -> list:
        found = [scan_text(t, threshold) for t in texts]
        return list(zip(*found, strict=True)) if found else [[] for _ in names]

    return map_texts(docs, "text", ["doc_id"], scan, list(zip(names, kinds, strict=True)))


def op10_secret_scan(spark, sf_dir) -> DataFrame:
    """Secrets in all documents."""
    return find_secrets(table(spark, sf_dir, "documents"))
