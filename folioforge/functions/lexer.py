"""Tokens of source code: one pass over a text, with states for strings, templates and comments.

A small helper of the code operators, called row by row inside Arrow tasks.
Anything that is not closed ends with its line (simple strings) or with the text;
no input is an error, and the work grows with the length of the text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple


class Token(NamedTuple):
    """kind: word, string, sign, line (an end of a line that counts) or directive; start and end are positions in the text."""

    kind: str
    text: str
    start: int
    end: int
    line: int


_QUOTED = r'"(?:\\.|[^"\\\n])*"?|\'(?:\\.|[^\'\\\n])*\'?'
_SIGNS = r"=>|->|::|\?\.|\?\?|[^\s\w$]"
_NUMBER = r"\.?\d(?:[eEpP][+-]|[\w.])*"
_C_COMMENT = r"//[^\n]*|/\*(?:[^*]|\*(?!/))*(?:\*/)?"

_PYTHON = re.compile(
    r'(?P<string>(?i:\b[rbfu]{1,2})?(?:"""(?:[^\\"]++|\\.|"(?!""))*+(?:"""|\Z)|\'\'\'(?:[^\\\']++|\\.|\'(?!\'\'))*+(?:\'\'\'|\Z)|"(?:\\.|[^"\\\n])*"?|\'(?:\\.|[^\'\\\n])*\'?))'
    rf"|(?P<comment>#[^\n]*)|(?P<joined>\\\r?\n)|(?P<line>\n)|(?P<number>{_NUMBER})|(?P<word>\w+)|(?P<sign>{_SIGNS})",
    re.DOTALL,
)
_BRACES = {
    "script": re.compile(rf"(?P<comment>{_C_COMMENT})|(?P<string>{_QUOTED})|(?P<template>`)|(?P<line>\n)|(?P<number>{_NUMBER})|(?P<word>[\w$]+)|(?P<sign>{_SIGNS})", re.DOTALL),
    "raw": re.compile(rf"(?P<comment>{_C_COMMENT})|(?P<string>`[^`]*`?|{_QUOTED})|(?P<line>\n)|(?P<number>{_NUMBER})|(?P<word>\w+)|(?P<sign>{_SIGNS})", re.DOTALL),
    "chars": re.compile(
        rf"(?P<comment>{_C_COMMENT})|(?P<directive>^[ \t]*#(?:\\\r?\n|[^\n])*)|(?P<string>\"\"\"(?:[^\"]|\"(?!\"\"))*(?:\"\"\")?|\"(?:\\.|[^\"\\])*\"?|'(?:\\[^\n']*|[^'\\\n])')|(?P<line>\n)|(?P<number>{_NUMBER})|(?P<word>\w+)|(?P<sign>{_SIGNS})",
        re.DOTALL | re.MULTILINE,
    ),
}
#: Which table reads a language.
FAMILY = {"python": "python", "javascript": "script", "typescript": "script", "java": "chars", "c": "chars", "cpp": "chars", "rust": "chars", "go": "raw"}
_TEMPLATE = re.compile(r"(?:\\.|[^`\\$]|\$(?!\{))*(?:`|\$\{|\\?\Z)", re.DOTALL)
_REGEX = re.compile(r"/(?![/*])(?:\\.|\[(?:\\.|[^\]\\\n])*\]|[^/\\\n\[])+/\w*")
#: After these a slash of a script begins a pattern.
_BEFORE_PATTERN = frozenset("( , = : [ ! & | ? { } ; + - * % < > ~ ^ => return typeof case in of delete void throw new else do".split())


def tokens(text: str, language: str, at: int = 0, line: int = 1) -> Iterator[Token]:
    """The tokens of a text without comments; strings are one token each (a template's expressions are read as code).

    ``at``: where to begin, outside of strings and comments, with the number of that line.
    """
    family = FAMILY[language]
    table = _PYTHON if family == "python" else _BRACES[family]
    last = ""
    templates: list[int] = []  # braces that are open inside each open template expression
    while at < len(text):
        found = table.match(text, at)
        if found is None:
            at += 1
            continue
        kind, start, at = found.lastgroup, at, found.end()
        if family == "script":
            if kind == "sign" and text[start] == "/" and (not last or last in _BEFORE_PATTERN) and (pattern := _REGEX.match(text, start)):
                kind, at = "string", pattern.end()
            elif kind == "template" or kind == "sign" and text[start] == "}" and templates and not templates[-1]:
                if kind == "sign":
                    templates.pop()
                at = _TEMPLATE.match(text, start + 1).end()
                kind = "string"
                if text.endswith("${", start, at):
                    templates.append(0)
            elif kind == "sign" and templates and text[start] in "{}":
                templates[-1] += 1 if text[start] == "{" else -1
        own = text[start:at]
        if kind == "number":
            kind = "word"
        if kind not in ("comment", "joined"):
            yield Token(kind, own, start, at, line)
            if kind != "line":
                last = own
        line += own.count("\n")
