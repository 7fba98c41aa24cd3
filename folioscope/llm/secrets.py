"""Secret scan: fixed patterns, plus literals assigned to sensitive names in source and configuration.

The scan lexes a text into names, literals and operators and pairs every literal with the name that
it is assigned to: ``name = "x"``, ``name: x``, ``"name" => 'x'``, ``<name>x</name>``, ``--name x``,
``NAME=x``. Values may stand on later lines: after an operator or a backslash at a line's end, in triple
quotes, in indented block scalars (``name: |``), in here-documents and between tags. A name that stands on
the right side takes the value of its last constant, and adjacent or added literals are joined, so
``A = "x1"; password = A + "y2"`` marks both literals. A literal is scored by the sensitivity of the
target name and by its own shape; spans of the parts are returned.

Lines without an operator or a tag aren't lexed unless a value goes on there. Names and literals may have any length.

Defined results: null text counts as empty and has no spans; an empty table gives no rows; repeated rows get
equal spans; spans that begin together are ordered by kind, and a part that reaches several names is returned
once. A very long text is scanned whole in one task, in proportion to its length. Extra columns are carried
along; an output (or ``secrets_found``) replaces a column of its name.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.llm.common import fields, make_room, table

# The base patterns and the least lengths of what they catch.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # a run of fewer never matches, and a match is a maximal run
LEAST_ASSIGN, LEAST_ACCESS = 6, 20
KINDS = ("assign", "access", "hex", "lexed")

# Parts of names and how sensitive they make a target.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "pwd": 0.9, "passphrase": 1.0, "pass": 0.7, "secret": 1.0, "secrets": 0.9,
    "token": 0.9, "apikey": 1.0, "credential": 0.9, "credentials": 0.9, "auth": 0.5, "bearer": 0.7, "private": 0.4,
    "access": 0.3, "key": 0.4, "api": 0.3, "client": 0.2, "signing": 0.4, "encryption": 0.4, "cert": 0.3, "pin": 0.5,
}
# Names whose literals aren't secrets whatever their other parts say.
HARMLESS = {"public", "name", "file", "path", "url", "type", "length", "size", "count", "field", "label", "hint", "id"}
PLACEHOLDER = re.compile(r"(?i)(x+|\*+|\.+|changeme|example|placeholder|none|null|true|false|undefined|your.*|<.*>|\$\{.*\}|%\(.*\)s)\Z")
#: Name and literal score needed for a span.
LEAST_SCORE = 0.8
#: One of these has to be there for a base assignment to match, or for a name to be sensitive enough.
BASE_HINTS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
LEXED_HINTS = tuple(p.encode() for p in SENSITIVE)

LEX = re.compile(
    r"""(?P<triple>\"{3}(?:[^"\\]|\\.|"(?!""))*+\"{3}|'{3}(?:[^'\\]|\\.|'(?!''))*+'{3})
    |(?P<tag><(?P<tagname>[A-Za-z_][\w.-]*+)>(?P<tagvalue>[^<>]++)</(?P=tagname)>)
    |(?P<here><<[-~]?[\x20\t]*+(?P<quote>["']?)(?P<word>[A-Za-z_]\w*+)(?P=quote))
    |(?P<string>"(?:[^"\\\n]|\\[^\n])*+"|'(?:[^'\\\n]|\\[^\n])*+'|`[^`\n]*+`)
    |(?P<flag>--[A-Za-z][\w-]++)
    |(?P<name>[A-Za-z_$][\w$]*+(?:[.-][A-Za-z_$][\w$]*+)*+)
    |(?P<op>=>|:=|==|!=|<=|>=|[=:+.,;(){}\[\]&|])
    |(?P<more>\\\n)
    |(?P<bare>[^\s"'`=:+,;(){}\[\]<>]+)
    |(?P<eol>\n)""",
    re.VERBOSE | re.ASCII | re.DOTALL,
)
#: What a line can end with when its statement goes on, and how the lines that a block scalar or tag opens look.
OPEN_END = re.compile(r"(?:[=:+,(\[{\\]|=>)[\x20\t\r]*\Z")
OPEN_BLOCK = re.compile(r"[:=][\x20\t]*[|>][+-]?\d?[\x20\t\r]*\Z")
OPEN_TAG = re.compile(r"<([A-Za-z_][\w.-]*)>[^<>]*\Z", re.ASCII)
OPEN_HERE = re.compile(r"<<[-~]?[\x20\t]*[\"']?([A-Za-z_]\w*)", re.ASCII)
CLOSING = re.compile(r"^[\x20\t]*+([A-Za-z_]\w*+)[\x20\t]*+[;,)]*+\r?$", re.MULTILINE | re.ASCII)
BLOCK_HEAD = re.compile(r"[\x20\t]*[|>][+-]?\d?[\x20\t\r]*\n")
ASSIGNS = ("=", ":", "=>", ":=")
BARE_VALUE = re.compile(r"[^\s\"'`,;(){}\[\]<>]+")
CAMEL = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")


def name_score(name: str) -> float:
    """Sum of the sensitivities of a name's parts, 1 at most; 0 for harmless names."""
    parts = [p.lower() for p in CAMEL.findall(name)]
    if not parts or parts[-1] in HARMLESS:
        return 0.0
    return min(1.0, sum(SENSITIVE.get(p, 0.0) for p in parts))


def literal_score(value: str) -> float:
    """0 for placeholders, prose and very short literals; towards 1 for long, varied, mixed ones."""
    if len(value) < 6 or PLACEHOLDER.match(value) or any(c.isspace() for c in value):
        return 0.0
    n = len(value)
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(value).values())
    kinds = sum(any(f(c) for c in value) for f in (str.islower, str.isupper, str.isdigit)) + (not value.isalnum())
    return min(1.0, entropy / 4 * 0.7 + kinds * 0.15)


def _has(text: str, hints: tuple[bytes, ...]) -> bool:
    low = text.encode().lower()
    return any(h in low for h in hints)


def lexed_spans(text: str) -> list[tuple[int, int]]:
    """Spans of literals that reach a sensitive name."""
    if not _has(text, LEXED_HINTS):
        return []
    found: set[tuple[int, int]] = set()
    constants: dict[str, list[tuple[int, int]]] = {}
    for start, end in _statements(text):
        tokens = [(m.lastgroup, m.start(), m.end(), m) for m in LEX.finditer(text, start, end)]
        _pairs(text, [t for t in tokens if t[0] != "more"], constants, found)
    return sorted(found)


def _line_end(text: str, at: int) -> int:
    end = text.find("\n", at)
    return len(text) if end < 0 else end


def _indent(text: str, at: int) -> int:
    end = at
    while end < len(text) and text[end] in " \t":
        end += 1
    return end - at


def _block_end(text: str, head: int, at: int) -> int:
    """End of the lines from ``at`` on that are blank or indented deeper than the line at ``head``."""
    deep, end = _indent(text, head), at - 1
    while at < len(text):
        stop = _line_end(text, at)
        if text[at:stop].strip():
            if _indent(text, at) <= deep:
                break
            end = stop
        at = stop + 1
    return max(end, 0)


@lru_cache(maxsize=1)
def _closings(text: str) -> dict[str, list[int]]:
    """Starts of the lines that hold one word alone, by word; found once for a text."""
    found: dict[str, list[int]] = {}
    for line in CLOSING.finditer(text):
        found.setdefault(line[1], []).append(line.start())
    return found


def _here_end(text: str, word: str, at: int) -> int:
    """Start of the first line from ``at`` on that closes a here-document, or -1."""
    starts = _closings(text).get(word, [])
    i = bisect_left(starts, at)
    return starts[i] if i < len(starts) else -1


def _statements(text: str):
    """(start, end) of the lines that hold an operator or a tag, with the lines on which their values go on."""
    at = 0
    while at < len(text):
        end = _line_end(text, at)
        if any(text.find(mark, at, end) >= 0 for mark in ("=", ":", "<", "--")):
            end = _extended(text, at, end)
            yield at, end
        at = end + 1


def _extended(text: str, head: int, end: int) -> int:
    """The end of the statement whose first line is from ``head`` to ``end``."""
    while end < len(text):
        line = text[head:end]
        stop = end
        if OPEN_BLOCK.search(line):
            stop = _block_end(text, head, end + 1)
        elif quotes := [q for q in ('"' * 3, "'" * 3) if line.count(q) % 2]:
            close = text.find(quotes[0], end)
            stop = _line_end(text, close) if close >= 0 else end
        elif "<<" in line and (here := OPEN_HERE.search(line)):
            close = _here_end(text, here[1], end + 1)
            stop = _line_end(text, close) if close >= 0 else end
        elif line.rstrip().endswith(("<", ">")) or "<" in line:
            if opened := OPEN_TAG.search(line):
                close = text.find("<", end)
                stop = _line_end(text, close) if close >= 0 and text.startswith(f"</{opened[1]}>", close) else end
        if stop <= end:
            after = end + 1
            while after < len(text) and text[after] in " \t\r\n":
                after += 1
            if after == len(text) or not (OPEN_END.search(line) or text[after] == "+"):
                return end
            stop = _line_end(text, after)
        # what has been looked at isn't looked at again: the rest of the statement is judged by its last lines
        head, end = text.rfind("\n", 0, max(end + 1, stop - 1)) + 1, stop
    return end


def _judge(text: str, name: str, parts: list[tuple[int, int]], found: set) -> None:
    sensitive = name_score(name)
    if sensitive and 0.5 * sensitive + 0.5 * literal_score("".join(text[a:b] for a, b in parts)) >= LEAST_SCORE:
        found.update(parts)


def _pairs(text: str, tokens: list, constants: dict, found: set) -> None:
    i, n = 0, len(tokens)
    while i < n:
        kind, start, end, match = tokens[i]
        if kind == "tag":
            parts = _lines(text, *match.span("tagvalue"))
            if parts:
                _judge(text, match["tagname"], parts, found)
        elif kind == "flag" and i + 1 < n and tokens[i + 1][0] in ("string", "bare", "name"):
            _judge(text, text[start + 2 : end], [_literal(tokens[i + 1])], found)
        elif kind in ("name", "string") and i + 2 < n and tokens[i + 1][0] == "op" and text[tokens[i + 1][1] : tokens[i + 1][2]] in ASSIGNS:
            name = text[start:end].strip("\"'`")
            parts, j = _value(text, tokens, i + 2, constants)
            if parts:
                constants[name] = parts
                _judge(text, name, parts, found)
                i = max(j - 1, i + 1)
        i += 1


def _literal(token) -> tuple[int, int]:
    kind, start, end, _ = token
    return (start + 1, end - 1) if kind == "string" else (start, end)


def _lines(text: str, start: int, end: int) -> list[tuple[int, int]]:
    """Spans of the lines' contents between two positions; lines of several words are prose, not parts of a literal."""
    out, at = [], start
    while at < end:
        stop = min(_line_end(text, at), end)
        content = text[at:stop].strip()
        if content and not any(c.isspace() for c in content):
            first = text.index(content, at)
            out.append((first, first + len(content)))
        at = stop + 1
    return out


def _after(tokens: list, i: int, position: int) -> int:
    """Index of the first token from i on that begins at the position or later."""
    while i < len(tokens) and tokens[i][1] < position:
        i += 1
    return i


def _value(text: str, tokens: list, i: int, constants: dict) -> tuple[list[tuple[int, int]], int]:
    """Literals of the right side that begins at token i, with constants put in; and where it ends."""
    parts: list[tuple[int, int]] = []
    if head := BLOCK_HEAD.match(text, tokens[i - 1][2]):
        stop = _block_end(text, text.rfind("\n", 0, head.start()) + 1, head.end())
        return _lines(text, head.end(), stop), _after(tokens, i, stop)
    while i < len(tokens):
        kind, start, end, match = tokens[i]
        if kind == "eol":  # only a literal may stand on a later line: a name there begins a statement of its own
            later = _after(tokens, i, start + 1)
            while later < len(tokens) and tokens[later][0] == "eol":
                later += 1
            if later == len(tokens) or tokens[later][0] not in ("string", "triple"):
                return parts, i
            i = later
            continue
        if kind == "string":
            parts.append((start + 1, end - 1))
        elif kind == "triple":
            parts += _lines(text, start + 3, end - 3)
        elif kind == "here":
            body = _line_end(text, end) + 1
            stop = _here_end(text, match["word"], body)
            return (parts, i + 1) if stop < 0 else (parts + _lines(text, body, stop), _after(tokens, i, stop))
        elif kind in ("name", "bare"):
            known = constants.get(text[start:end])
            if known:
                parts.extend(known)
            else:
                whole = BARE_VALUE.match(text, start)
                stop = whole.end() if whole else end
                if stop < len(text) and text[stop] == "(":  # a call; a here-document may be its argument
                    here = next((k for k in range(i, len(tokens)) if tokens[k][0] in ("here", "eol")), None)
                    if here is not None and tokens[here][0] == "here":
                        i = here
                        continue
                    return parts, i + 1
                parts.append((start, stop))
                while i + 1 < len(tokens) and tokens[i + 1][1] < stop:
                    i += 1
        else:
            return parts, i
        i += 1
        ahead = i
        while ahead < len(tokens) and tokens[ahead][0] == "eol":
            ahead += 1
        if ahead < len(tokens) and tokens[ahead][0] == "op" and text[tokens[ahead][1] : tokens[ahead][2]] in ("+", "."):
            i = ahead + 1
        elif not (i < len(tokens) and tokens[i][0] == "string" and kind == "string"):
            return parts, i
    return parts, i


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns' matches."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_ASSIGN] if _has(text, BASE_HINTS) else []
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def _spell(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


@F.pandas_udf(fields("n_assign long, n_access long, n_hex long, base_spans string, spans string"))
def _scan(texts: pd.Series) -> pd.DataFrame:
    rows = []
    for text in texts:
        base = base_spans(text)
        kinds = [k for _, k, _ in base]
        more = [(a, 3, b) for a, b in lexed_spans(text)]
        rows.append((kinds.count(0), kinds.count(1), kinds.count(2), _spell(base), _spell(sorted([*base, *more]) if more else base)))
    return pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "base_spans", "spans"])


def find_secrets(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with n_assign, n_access, n_hex, base_spans and spans (kind:start:end in code points, comma-joined)."""
    df = make_room(df, "n_assign", "n_access", "n_hex", "base_spans", "spans", "secrets_found")
    return df.withColumn("secrets_found", _scan(F.coalesce(F.col(f"`{text}`"), F.lit("")))).select(*[F.col(f"`{c}`") for c in df.columns], "secrets_found.*")


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    found = find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(F.col("base_spans").cast("binary"), 256).alias("base_sha256"), "spans")
