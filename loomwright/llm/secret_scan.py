"""Secrets in whole texts: fixed patterns, and literals that reach sensitive names.

Source and configuration lines are read as assignments, name and value: ``name
= "..."``, ``name: ...``, ``name => ...``, ``"name": "..."``, ``NAME=...``,
``<name>...</name>``. A value is a chain of literals and names, joined by
``+``, ``.``, ``||`` or ``${...}``. Names carry the literals of their last
value on to the names that are set from them, so that a literal is found where
it is written, whatever it is called there. It is scored by the most sensitive
name it reaches and by its own look.

Every text is read by patterns whose time is in proportion to its length; what
holds none of their fixed parts is passed over for whole columns.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwright.llm.bytesets import text_batches

#: Kinds in the order of equal starts; the last is what the lexer adds.
KINDS = ("assign", "access", "hex", "named")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 6, "access": 20, "hex": 24}
#: Found first by column: what no text without it can match.
_HAS_ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]"""
_HAS_HEX = "[0-9a-f]{24}"
_HEX_RUN = re.compile(_HAS_HEX + "[0-9a-f]*")

THRESHOLD = 0.5
#: How much a word of a name tells of a secret; pairs of words are written with a blank.
WORDS = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "passcode": 0.9, "pwd": 0.9, "pass": 0.8, "secret": 1.0, "secrets": 0.9, "token": 0.9, "apikey": 1.0, "api key": 1.0,
    "access key": 1.0, "private key": 1.0, "secret key": 1.0, "signing key": 1.0, "encryption key": 1.0, "master key": 0.9, "client secret": 1.0, "auth key": 0.9, "auth token": 1.0,
    "credential": 0.9, "credentials": 0.9, "bearer": 0.9, "authorization": 0.8, "connection string": 0.7, "salt": 0.6, "otp": 0.6, "pin": 0.5,
}
#: Words that say that a name holds something about a secret, not the secret.
ABOUT = {"file", "path", "dir", "name", "url", "uri", "length", "len", "size", "type", "count", "limit", "expiry", "expires", "ttl", "policy", "id", "hint", "label", "field", "prompt", "regex", "pattern", "algorithm", "header"}
#: Values that stand for one that is not there.
EMPTY_WORDS = re.compile(r"^(?:x+|\*+|\.+|-+|_+|0+|none|null|nil|true|false|todo|tbd|changeme|change-me|example|placeholder|undefined|redacted|your[-_a-z0-9]*|<.*>|\{\{.*\}\}|%[a-z_]+%)$", re.IGNORECASE)

_LINE = re.compile(r"[^\r\n]+")
_OPENS = re.compile(r"[=:]|>[^<>\s]")
_NAME = r"[A-Za-z_$][\w$]*(?:[.\-][A-Za-z_$][\w$]*)*"
_TARGET = re.compile(rf"""(?P<quote>["'])(?P<quoted>[^"'\\]{{1,128}})(?P=quote)\s*(?::=|=>|:(?!:)|=(?![=~]))|(?<![\w$.\-])(?P<bare>{_NAME})(?:\["(?P<key>[^"\\\]]{{1,128}})"\]|\['(?P<key2>[^'\\\]]{{1,128}})'\])?(?:\s*:\s*[A-Za-z_]\w*(?=\s*=[^=>]))?\s*(?::=|=>|:(?![:/])|(?<![=!<>])=(?![=~]))|<(?P<tag>[A-Za-z_][\w.:\-]*)>(?=[^<>\s])""", re.ASCII)
_PART = re.compile(rf"""[ \t]*(?:"(?P<double>(?:[^"\\]|\\.)*)"|'(?P<single>(?:[^'\\]|\\.)*)'|`(?P<tick>(?:[^`\\]|\\.)*)`|\$\{{(?P<braced>{_NAME})\}}|(?P<name>{_NAME})(?=[ \t]*(?:[+;,)\]}}]|\|\||\.\.|//|\#|$)))""", re.ASCII)
_JOIN = re.compile(r"[ \t]*(?:\+|\|\||\.\.?)(?=[ \t]*[\"'`$A-Za-z_])")
_RAW = re.compile(r"""[ \t]*([^\s"'`,;#(){}\[\]<>]+)""")
_INNER = re.compile(rf"\$\{{({_NAME})\}}|\$({_NAME})", re.ASCII)
_WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[A-Z]+|\d+")
_LONG_LINE = 1 << 16


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns, leftmost and not overlapping within a kind, short ones left out."""
    found = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    # a match of HEX is a whole run, so that those of 24 and more can be sought alone
    return found + [(m.start(), m.end(), "hex") for m in _HEX_RUN.finditer(text)]


def words_of(name: str) -> list[str]:
    return [w.lower() for w in _WORD.findall(name)]


def name_score(name: str) -> float:
    """How sensitive a name is, from 0 to 1."""
    words = words_of(name)
    told = max([WORDS.get(w, 0.0) for w in words] + [WORDS.get(f"{a} {b}", 0.0) for a, b in zip(words, words[1:])], default=0.0)
    return told * 0.2 if words and words[-1] in ABOUT else told


def literal_score(value: str, quoted: bool = True) -> float:
    """How much a literal looks like a secret that somebody wrote down, from 0 to 1; a bare word like those of prose does not."""
    if len(value) < 6 or EMPTY_WORDS.match(value) or "://" in value[:12] and "@" not in value:
        return 0.0
    if any(c.isspace() for c in value):
        return 0.2 if len(value.split()) > 2 else 0.5
    if not quoted and value.isalpha() and value[1:].islower():
        return 0.3
    n = len(value)
    entropy = -sum(k / n * math.log2(k / n) for k in Counter(value).values())
    kinds = sum(any(test(c) for c in value) for test in (str.islower, str.isupper, str.isdigit, lambda c: not c.isalnum()))
    return min(1.0, 0.3 + 0.12 * kinds + 0.12 * entropy)


Literal = tuple[int, int, str, bool]  # start, end, value, whether it is quoted
Node = tuple[str, list[Literal], list[int]]  # name, own literals, earlier assignments that its value names


def _value(line: str, at: int, start: int, known: dict[str, int]) -> tuple[list[Literal], list[int], int]:
    """(literals of a value at this place, assignments that it names, its end in the line)."""
    literals: list[Literal] = []
    named: list[int] = []

    def raw() -> int:
        if m := _RAW.match(line, at):
            if line[m.end() : m.end() + 1] in ("(", "["):  # a call or a look-up
                return m.end()
            literals.append((start + m.start(1), start + m.end(1), m[1], False))
            return m.end()
        return at

    while True:
        m = _PART.match(line, at)
        if m is None:
            return literals, named, at if literals or named else raw()
        kind = m.lastgroup
        if kind == "name" and m[kind] not in known and not (literals or named):
            return literals, named, raw()  # no name that was set: a word of a configuration
        if kind in ("braced", "name"):
            if m[kind] in known:
                named.append(known[m[kind]])
        else:
            text, a = m[kind], m.start(kind)
            if kind != "single" and "$" in text:
                named += [known[r[1] or r[2]] for r in _INNER.finditer(text) if (r[1] or r[2]) in known]
            if text:
                literals.append((start + a, start + a + len(text), text, True))
        at = m.end()
        j = _JOIN.match(line, at)
        if j is None:
            return literals, named, at
        at = j.end()


def assignments(text: str) -> list[Node]:
    """The assignments of a text in its order. A name stands for the last value it was given."""
    out: list[Node] = []
    known: dict[str, int] = {}
    for row in _LINE.finditer(text):
        for start in range(row.start(), row.end(), _LONG_LINE):  # minified or no source: pieces of a line
            line = text[start : min(start + _LONG_LINE, row.end())]
            if not _OPENS.search(line):
                continue
            at = 0
            while m := _TARGET.search(line, at):
                name = m["quoted"] or m["key"] or m["key2"] or m["bare"] or m["tag"]
                literals, named, stop = _value(line, m.end(), start, known)
                at = max(stop, m.end())
                if not literals and not named:
                    continue
                known[name] = len(out)
                if name.startswith(("self.", "this.")):
                    known[name[5:]] = len(out)
                out.append((name, literals, named))
    return out


def named_spans(text: str, threshold: float = THRESHOLD) -> list[tuple[int, int, str, float]]:
    """(start, end, name, score) of literals that reach a sensitive name; of the names that one reaches, the most sensitive.

    What an assignment names was assigned before it, so one pass from the
    last assignment to the first carries all names back.
    """
    nodes = assignments(text)
    told = [(name_score(name), name) for name, _, _ in nodes]
    for k in range(len(nodes) - 1, -1, -1):
        for before in nodes[k][2]:
            if told[k][0] > told[before][0]:
                told[before] = told[k]
    best: dict[tuple[int, int], tuple[float, str]] = {}
    for (_, literals, _), (sure, name) in zip(nodes, told, strict=True):
        if sure >= threshold:
            for a, b, value, quoted in literals:
                score = sure * literal_score(value, quoted)
                if score >= threshold and score > best.get((a, b), (0.0, ""))[0]:
                    best[a, b] = (score, name)
    return [(a, b, name, score) for (a, b), (score, name) in best.items()]


def spans_of(text: str, threshold: float = THRESHOLD, patterns: bool = True, lexed: bool = True) -> list[tuple[str, int, int, str | None, float]]:
    """(kind, start, end, name, score) by start, then kind; what the lexer finds within a pattern's span is that pattern's."""
    base = sorted(base_spans(text)) if patterns else []
    out = [(kind, a, b, None, 1.0) for a, b, kind in base]
    if lexed:
        widest = np.maximum.accumulate([b for _, b, _ in base]) if base else np.zeros(0, np.int64)
        starts = [a for a, _, _ in base]
        for a, b, name, score in named_spans(text, threshold):
            k = int(np.searchsorted(starts, b, "left"))  # patterns that start before this one ends
            if not k or widest[k - 1] <= a:
                out.append(("named", a, b, name, round(score, 6)))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def find_secrets(docs: DataFrame, threshold: float = THRESHOLD, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, spans``: an array of ``(kind, start, end, name, score)`` for each whole text, by start, then kind.

    ``assign``, ``access`` and ``hex`` are the fixed patterns; ``named`` are
    literals that overlap none of them and reach a sensitive name with a
    score of ``threshold`` or more. Places are code points, ends exclusive.
    Null and empty texts have no spans. Rows are independent: repeated rows
    and null ids stay, other columns are not read, an empty table gives an
    empty result.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("name", pa.string()), ("score", pa.float64())])
    fields = [f.name for f in span]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text_batches(whole, text_column):
                column = pc.fill_null(batch.column(text_column), "")
                some = pc.match_substring_regex(column, _HAS_ASSIGN)
                some = pc.or_(some, pc.match_substring(column, "AKIA"))
                some = pc.or_(some, pc.match_substring_regex(column, _HAS_HEX)).to_numpy(zero_copy_only=False)
                lexed = pc.match_substring_regex(column, "[=:]|</").to_numpy(zero_copy_only=False)
                spans: list[list[dict]] = [[] for _ in range(batch.num_rows)]
                for k in np.flatnonzero(some | lexed).tolist():
                    spans[k] = [dict(zip(fields, s, strict=True)) for s in spans_of(column[k].as_py(), threshold, bool(some[k]), bool(lexed[k]))]
                yield pa.RecordBatch.from_arrays([batch.column(id_column), pa.array(spans, pa.list_(span))], ["doc_id", "spans"])

    return docs.select(id_column, text_column).mapInArrow(run, f"doc_id {kind}, spans array<struct<kind: string, start: int, end: int, name: string, score: double>>")


def span_list(spans: Column, base: bool = False) -> Column:
    """``kind:start:end`` of all spans (or of the patterns' alone), joined by commas."""
    kept = F.filter(spans, lambda s: s["kind"] != "named") if base else spans
    return F.array_join(F.transform(kept, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def n_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
