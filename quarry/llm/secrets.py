"""Secret scan: fixed patterns, and an assignment-aware lexer beside them.

The patterns give the base spans ``assign``, ``access`` and ``hex``.  The
lexer reads source and configuration syntax (``name = "literal"``,
``"name": 'literal'``, ``name := value``, ``name: Type = value``,
``var name Type = value``, ``name[] = value``, ``<name>value</name>``,
command-line ``--name value``) into name-literal pairs, reads literals with a
prefix or in triple quotes, joins literals added together or side by side, follows names assigned to names, and scores each literal by the
sensitive parts of every name it reaches and by its own randomness.  Literals
above the threshold become ``literal`` spans.  A name stands for its latest
assignment before the place that uses it, or else for its first one behind it
(which adds nothing if that one leads back to its user); any number of pieces
may be joined.  A pair's value is never written out: its length, ends and
character counts are added up from those of its parts, each pair once, so the
time follows the text and not the length of the joined values.

Spans are in code points, end exclusive.  Defined results: a null or empty
text has no spans; equal rows get equal spans; an empty table stays empty;
other columns pass through untouched.  Each row is read alone.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import clean_text

# The base patterns, in the order of their kinds.
KINDS = ("assign", "access", "hex", "literal")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+", re.ASCII)
HEX = re.compile(r"[0-9a-f]{24,}", re.ASCII)
MIN_ASSIGNED, MIN_ACCESS = 6, 20
ASSIGN_NAMES = ("password", "passwd", "secret", "token", "api_key", "apikey")

#: How much a part of a target name tells that its literal is a secret.
NAME_WEIGHTS = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 0.9, "secret": 1.0, "token": 0.9, "apikey": 1.0,
    "credential": 0.9, "credentials": 0.9, "privatekey": 1.0, "accesskey": 1.0, "secretkey": 1.0, "signingkey": 1.0,
    "encryptionkey": 1.0, "authkey": 1.0, "clientsecret": 1.0, "connectionstring": 0.8, "bearer": 0.8, "auth": 0.75,
    "pass": 0.8,
}
HINT = re.compile("|".join(NAME_WEIGHTS).encode())
NOT_LETTERS = bytes(sorted({*range(128)} - {*b"abcdefghijklmnopqrstuvwxyz"}))
PLACEHOLDER = re.compile(r"(?i)^(?:x+|\*+|\.+|-+|_+|0+|null|none|true|false|undefined|todo|change_?me|example|your[_-].*|<.*>|\$\{.*\}|%\(.*\).|\{\{.*\}\})$")
MIN_LITERAL, THRESHOLD = 6, 0.6
ENDS = 32                     # characters of both ends of a value that its score looks at in order
CIRCLE = -1                   # marks the use of a later pair that leads back to its user

#: A string literal: with a prefix, in triple quotes (these over lines), or plain.
_STRING = r'(?:[A-Za-z]{1,2}(?=["\']))?+(?:"""(?:\\.|[^"\\]|"(?!""))*+"""|\'\'\'(?:\\.|[^\'\\]|\'(?!\'\'))*+\'\'\'|"(?:\\.|[^"\\\n])*+"|\'(?:\\.|[^\'\\\n])*+\'|`[^`\n]*+`)'
_INNER = r"[^<>\[\]\n=\"'`;]*+"
_GENERIC = rf"(?:<{_INNER}(?:<{_INNER}>{_INNER})*+>|\[{_INNER}(?:\[{_INNER}\]{_INNER})*+\])"
_ONE_TYPE = rf"[&*?]*+(?:'\w++[ \t]++)?(?:(?:mut|dyn|readonly)[ \t]++)*+[A-Za-z_][\w.]*+(?:::[A-Za-z_]\w*+)*+{_GENERIC}*+[?!]?"
_TYPE = rf"{_ONE_TYPE}(?:[ \t]*+\|[ \t]*+{_ONE_TYPE})*+"
PAIR = re.compile(
    r"""(?<![\w.$-])(?:--)?["'`]?(?P<name>[A-Za-z_$][\w.$-]*+)["'`]?(?P<item>(?:\[["']?[\w.-]*+["']?\])*+)"""
    # A type stands between ':' and '=' when blanks or a quote show that the '=' is not part of a value.
    rf"""(?:[?!]?[ \t]*+:[ \t]*+{_TYPE}(?:[ \t]++=(?![=>])[ \t]*+|=(?=[ \t]*+["'`])[ \t]*+)"""
    r"""|[ \t]*+(?::=|=>|==?(?!=)|:(?!:))[ \t]*+)"""
    rf"""(?P<value>{_STRING}|[^\s,;"'`(){{}}\[\]<>]++)"""
)
#: ``password string = "..."``: the name before a type without a colon, behind a keyword or before a text type.
TYPED = re.compile(
    r"""(?<![\w.$-])(?:(?P<word>var|const)[ \t]++)?(?P<name>[A-Za-z_]\w*+)[ \t]++(?P<type>[*&]?(?:\[\w*+\])*+[A-Za-z_][\w.]*+)"""
    rf"""[ \t]*+=(?![=>])[ \t]*+(?P<value>{_STRING}|[^\s,;"'`(){{}}\[\]<>]++)"""
)
TEXT_TYPES = ("string", "*string", "[]byte", "[]rune", "[]string")
#: ``<name>value</name>``; the look ahead ends at the next ``<``, so a line is read once.
TAG = re.compile(
    r"""<(?P<name>[A-Za-z_$][\w.$-]*+)>(?=[^<\n]*+</(?P=name)>)"""
    rf"""(?P<value>{_STRING}|[^\s,;"'`(){{}}\[\]<>]++)"""
)
FLAG = re.compile(rf"""(?<!\S)--(?P<name>[a-z][\w-]*+)[ \t]++(?P<value>{_STRING}|[^\s"'`-][^\s"'`]*+)""")
JOINED = re.compile(rf"[ \t]*+(?:\+|\.\.?)[ \t]*+(?P<value>{_STRING}|[A-Za-z_$][\w.$]*+)")
ADJACENT = re.compile(rf"[ \t]++(?P<value>(?=[A-Za-z]{{0,2}}[\"'])(?:{_STRING}))")
QUOTED = re.compile(r"""(?s)([A-Za-z]{0,2})(\"{3}|'{3}|["'`])(.*)\2""")
NAME = re.compile(r"[A-Za-z_$][\w.$-]*+")
ITEM = re.compile(r"[\w.-]+")

SPAN = T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
    T.StructField("name", T.StringType()), T.StructField("score", T.DoubleType()),
])


def name_weight(name: str) -> float:
    """The largest weight among the parts of a name, and of neighbouring parts together."""
    parts = [p.lower() for p in re.findall(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+", name)]
    found = parts + [a + b for a, b in zip(parts, parts[1:])]
    return max((NAME_WEIGHTS.get(p, 0.0) for p in found), default=0.0)


@dataclass
class Value:
    """What the score needs of a joined value: its length, its characters with their counts, its ends."""

    size: int
    chars: Counter
    head: str
    tail: str

    @classmethod
    def of(cls, text: str) -> Value:
        return cls(len(text), Counter(text), text[:ENDS], text[-ENDS:])

    def then(self, other: Value) -> None:
        if self.size < ENDS:
            self.head = (self.head + other.head)[:ENDS]
        self.tail = (self.tail + other.tail)[-ENDS:]
        self.size += other.size
        for c, n in other.chars.items():
            self.chars[c] += n

    def randomness(self) -> float:
        """0 for a repeated character, 1 for 24 characters all different, with a share for mixed kinds."""
        entropy = -sum(c / self.size * math.log2(c / self.size) for c in self.chars.values())
        held = "".join(self.chars)
        mixed = sum(bool(re.search(p, held)) for p in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]"))
        return min(1.0, entropy / math.log2(24)) * 0.7 + 0.1 * (mixed - 1)

    def is_placeholder(self) -> bool:
        """``PLACEHOLDER`` on a text with the same ends and the same characters between them; no fixed word is as long."""
        if self.size <= 2 * ENDS:
            return PLACEHOLDER.match(self.head + (self.tail[-(self.size - ENDS):] if self.size > ENDS else "")) is not None
        between = self.chars.copy()
        between.subtract(self.head + self.tail)
        return PLACEHOLDER.match(self.head + "".join(c for c, n in between.items() if n) + self.tail) is not None


def score(name: str, value: Value) -> float:
    if value.size < MIN_LITERAL or value.is_placeholder():
        return 0.0
    return name_weight(name) * (0.4 + 0.6 * value.randomness())


Parts = list[tuple[int, int, str, bool]]      # start, end, text, whether it may be a name


def _part(value: str, at: int) -> tuple[int, int, str, bool]:
    if quoted := QUOTED.fullmatch(value):
        return at + quoted.start(3), at + quoted.end(3), quoted[3], False
    return at, at + len(value), value, NAME.fullmatch(value) is not None


class Assignments:
    """The pairs of a text by place, and what each stands for; every pair is resolved once."""

    def __init__(self, pairs: list[tuple[int, str, Parts]]):
        self.pairs = pairs
        self.places: dict[str, list[int]] = {}
        for k, (_, name, _) in enumerate(pairs):
            self.places.setdefault(name, []).append(k)
        self.last = {name: self.pairs[places[-1]][0] for name, places in self.places.items()}
        #: The pairs that a pair's parts stand for, part by part; None for a literal.
        self.targets = [[self.meant(k, text) if may_name else None for _, _, text, may_name in parts]
                        for k, (_, _, parts) in enumerate(pairs)]

    def meant(self, user: int, name: str) -> int | None:
        """The pair that ``name`` stands for in pair ``user``: the latest before it, else the first behind it."""
        places = self.places.get(name)
        if not places:
            return None
        before = bisect_left(places, user)
        if before:
            return places[before - 1]
        start = self.pairs[user][0]
        if self.last[name] == start:
            return None
        return next(k for k in places if self.pairs[k][0] != start)

    def resolve(self, tops: list[int]) -> list[int]:
        """All pairs that ``tops`` reach, each behind those it stands on.

        Among pairs that lead to one another (found as strong components) the
        uses of a later pair add nothing, so that no circle is left.
        """
        component = self._components(tops)
        for k in component:
            self.targets[k] = [CIRCLE if t is not None and t >= k and component[t] == component[k] else t for t in self.targets[k]]
        order, done = [], set()
        for top in tops:
            stack = [] if top in done else [(top, iter(self.targets[top]))]
            done.add(top)
            while stack:
                k, rest = stack[-1]
                for t in rest:
                    if t is not None and t != CIRCLE and t not in done:
                        done.add(t)
                        stack.append((t, iter(self.targets[t])))
                        break
                else:
                    order.append(k)
                    stack.pop()
        return order

    def _components(self, tops: list[int]) -> dict[int, int]:
        """The strong component of every pair that ``tops`` reach, numbered by its first pair met."""
        number, low, component = {}, {}, {}
        open_pairs: list[int] = []
        for top in tops:
            if top in number:
                continue
            number[top] = low[top] = len(number)
            open_pairs.append(top)
            stack = [(top, iter(self.targets[top]))]
            while stack:
                k, rest = stack[-1]
                for t in rest:
                    if t is None:
                        continue
                    if t not in number:
                        number[t] = low[t] = len(number)
                        open_pairs.append(t)
                        stack.append((t, iter(self.targets[t])))
                        break
                    if t not in component:
                        low[k] = min(low[k], number[t])
                else:
                    stack.pop()
                    if stack:
                        low[stack[-1][0]] = min(low[stack[-1][0]], low[k])
                    if low[k] == number[k]:
                        while (t := open_pairs.pop()) != k:
                            component[t] = number[k]
                        component[k] = number[k]
        return component

    def best_scores(self) -> dict[tuple[int, int], tuple[float, str]]:
        """By literal, the best score and name of all pairs whose value holds it, when at the threshold.

        Values are added up from the bottom and given back after their last
        use; the best name then goes from each pair down to those it stands on.
        """
        order = self.resolve([k for k, (_, name, _) in enumerate(self.pairs) if name_weight(name)])
        uses = Counter(t for k in order for t in self.targets[k] if t is not None)
        values: dict[int, Value] = {}
        best_of: dict[int, tuple[float, str]] = {}
        for k in order:
            _, name, parts = self.pairs[k]
            value = Value.of("")
            for (_, _, text, _), t in zip(parts, self.targets[k]):
                if t is None:
                    value.then(Value.of(text))
                elif t != CIRCLE:
                    uses[t] -= 1
                    # The last user of a value that comes first in its own takes it over.
                    value, other = (values[t], value) if not uses[t] and not value.size else (value, values[t])
                    value.then(other)
                    if not uses[t]:
                        del values[t]
            if name_weight(name) and (s := score(name, value)) >= THRESHOLD:
                best_of[k] = (s, name)
            if uses[k]:
                values[k] = value
        found: dict[tuple[int, int], tuple[float, str]] = {}
        for k in reversed(order):
            best = best_of.get(k)
            if best is None:
                continue
            for (a, b, text, _), t in zip(self.pairs[k][2], self.targets[k]):
                if t is None and text and best > found.get((a, b), (0.0, "")):
                    found[a, b] = best
                elif t is not None and t != CIRCLE and best > best_of.get(t, (0.0, "")):
                    best_of[t] = best
        return found


def lex(text: str) -> list[tuple[int, int, str, float]]:
    """Sensitive literals ``(start, end, name, score)``, best name of each, by start."""
    matches = [*PAIR.finditer(text), *TAG.finditer(text), *(FLAG.finditer(text) if "--" in text else ())]
    matches += [m for m in TYPED.finditer(text) if m["word"] or m["type"] in TEXT_TYPES]
    pairs: list[tuple[int, str, Parts]] = []
    for m in sorted(matches, key=lambda m: (m.start("value"), m.start())):
        name = ".".join([m["name"], *ITEM.findall(m["item"])]) if m.re is PAIR else m["name"]
        parts, end = [_part(m["value"], m.start("value"))], m.end()
        while j := JOINED.match(text, end) or (text[end - 1] in "\"'" and ADJACENT.match(text, end)):
            parts.append(_part(j["value"], j.start("value")))
            end = j.end()
        pairs.append((m.start("value"), name, parts))
    best = Assignments(pairs).best_scores()
    return [(a, b, name, s) for (a, b), (s, name) in sorted(best.items())]


def may_name_secrets(text: str) -> bool:
    """Whether the letters of ``text``, without all between them, hold a weighted name; no such name's parts are missed."""
    return HINT.search(text.encode("ascii", "ignore").lower().translate(None, NOT_LETTERS)) is not None


def scan_text(text: str) -> list[tuple[str, int, int, str | None, float | None]]:
    """All spans of one text, by start and then by kind."""
    low = text.lower()
    spans: list = []
    if any(x in low for x in ASSIGN_NAMES):
        spans += [("assign", m.start(), m.end(), m[1], None) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGNED]
    if "AKIA" in text:
        spans += [("access", m.start(), m.end(), None, None) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    spans += [("hex", m.start(), m.end(), None, None) for m in HEX.finditer(text)]
    if may_name_secrets(text):
        spans += [("literal", a, b, name, s) for a, b, name, s in lex(text)]
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def scan(docs: DataFrame, text_col: str = "text", into: str = "secrets") -> DataFrame:
    """``docs`` with an array column ``into`` of the spans found."""

    @F.arrow_udf(T.ArrayType(SPAN))
    def found(texts: pa.Array) -> pa.Array:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                                   ("name", pa.string()), ("score", pa.float64())]))
        names = ("kind", "start", "end", "name", "score")
        return pa.array([[dict(zip(names, s)) for s in scan_text(t.as_py())] for t in texts], type=kind)

    return docs.withColumn(into, found(clean_text(text_col)))


def secrets_digest(scanned: DataFrame, id_col: str = "doc_id", into: str = "secrets") -> DataFrame:
    """Counts by kind, a digest of the base spans and the list of all spans."""
    spans = F.col(into)

    def joined(column):
        return F.array_join(F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind):
        return F.size(F.filter(spans, lambda s: s["kind"] == F.lit(kind))).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in KINDS]
    return scanned.select(
        F.col(id_col).cast("long").alias("doc_id"), *counts[:3],
        F.sha2(joined(F.filter(spans, lambda s: s["kind"] != "literal")), 256).alias("base_sha256"),
        joined(spans).alias("spans"), counts[3],
    )
