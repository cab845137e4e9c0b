"""Keys and depth of configuration texts: JSON, YAML, TOML and XML.

Small helpers of ``operators.structure``, called row by row inside Arrow tasks.
A shape is (keys, depth): keys of maps (elements, for XML) and how deep maps and
lists (elements) are nested.  What is malformed has none.
"""

from __future__ import annotations

import json
import re
import tomllib
from collections.abc import Callable
from xml.parsers import expat

Shape = tuple[int, int]


def of_value(value: object) -> Shape:
    """The shape of a parsed value, level by level."""
    keys, depth, level = 0, 0, [value]
    while level:
        inside = [x for x in level if isinstance(x, (dict, list))]
        keys += sum(len(x) for x in inside if isinstance(x, dict))
        level = [y for x in inside for y in (x.values() if isinstance(x, dict) else x)]
        depth += bool(inside)
    return keys, depth


def of_json(text: str) -> Shape | None:
    try:
        return of_value(json.loads(text))
    except (ValueError, RecursionError):
        return None


def of_toml(text: str) -> Shape | None:
    try:
        return of_value(tomllib.loads(text))
    except (tomllib.TOMLDecodeError, RecursionError):
        return None


def of_xml(text: str) -> Shape | None:
    """Elements and their depth; entities are not followed."""
    count = [0, 0, 0]  # elements, open, deepest

    def begin(*_) -> None:
        count[0] += 1
        count[1] += 1
        count[2] = max(count[2], count[1])

    def end(_) -> None:
        count[1] -= 1

    def refuse(*_) -> None:
        raise ValueError("entities are not read")

    parser = expat.ParserCreate()
    parser.StartElementHandler, parser.EndElementHandler, parser.EntityDeclHandler = begin, end, refuse
    try:
        parser.Parse(text.encode(), True)
    except (expat.ExpatError, ValueError):
        return None
    return count[0], count[2]


_QUOTED = r'"(?:\\.|[^"\\])*"|\'(?:\'\'|[^\'])*\''
_KEY = re.compile(rf"(?:\? )?(?:{_QUOTED}|[^\s\-?:,\[\]{{}}#&*!|>'\"%@`][^\n]*?|[\-?:](?=\S)[^\n]*?)\s*:(?=\s|$)")
_PLAIN = r"(?:[^\s\[\]{},:\"'#]|:(?![\s,\]}]|$))(?:[^\[\]{},:\n#]|:(?![\s,\]}]|$)|(?<=\S)#)*"
_FLOW = re.compile(rf"{_QUOTED}|[\[\]{{}},:]|{_PLAIN}|#[^\n]*|\s+|.", re.DOTALL)
_BLOCK = re.compile(r"[|>][+\-0-9]*\s*(?:#.*)?$")
_PROPERTIES = re.compile(r"(?:[&!][^\s,\[\]{}]*\s+)+|[&!][^\s,\[\]{}]*$")


def _flow(text: str) -> tuple[int, int] | None:
    """Keys and depth of a value in brackets that is whole; None if it is not."""
    keys = depth = deepest = 0
    open_: list[str] = []
    ended = False
    for found in _FLOW.finditer(text):
        own = found.group().strip()
        if not own or own.startswith("#"):
            continue
        if ended:
            return None
        if own in "[{" and own:
            open_.append(own)
            depth += 1
            deepest = max(deepest, depth)
        elif own in ("]", "}"):
            if not open_ or open_.pop() != {"]": "[", "}": "{"}[own]:
                return None
            depth -= 1
            ended = not open_
        elif own == ":" and open_:
            keys += 1
    return (keys, deepest) if ended else None


def _closed(text: str) -> bool:
    """Whether the brackets or the quote that a value opens with are closed in it."""
    if text[0] in "\"'":
        return re.match(_QUOTED, text, re.DOTALL) is not None
    depth = 0
    for found in _FLOW.finditer(text):
        depth += (found.group() in ("[", "{")) - (found.group() in ("]", "}"))
    return depth <= 0


def of_yaml(text: str) -> Shape | None:
    """Block maps and lists by a stack of indents, flow maps and lists by their brackets, line by line."""
    keys = deepest = 0
    stack: list[tuple[int, str]] = []  # (indent, map or list)
    filled = False  # the last key or item has a value on its line
    scalar: int | None = None  # lines deeper than this belong to a block scalar
    pending, pending_at, level = "", 0, 0  # a flow value or a quoted one that goes on
    for raw in text.split("\n"):
        line = raw.rstrip()
        indent = len(line) - len(line.lstrip(" "))
        if scalar is not None:
            if not line or indent > scalar:
                continue
            scalar = None
        if pending:
            pending += "\n" + line
            content, at = "", pending_at
        else:
            content, at = line[indent:], indent
            if not content or content[0] == "#" or content in ("---", "...") or at == 0 and content[0] == "%":
                if content in ("---", "..."):
                    stack, filled = [], False
                continue
            if content[0] == "\t":
                return None
            while stack and stack[-1][0] > at:
                stack.pop()
            if content.startswith("--- "):
                content, at = content[4:].lstrip(), 4
        while content or pending:
            if not pending and (content == "-" or content.startswith("- ")):
                if not stack or stack[-1][0] < at or stack[-1] == (at, "map") and not filled:
                    if stack and stack[-1][0] < at and filled:
                        return None
                    stack.append((at, "list"))
                elif stack[-1] != (at, "list"):
                    return None
                deepest, filled = max(deepest, len(stack)), False
                rest = content[1:].lstrip(" ")
                at += len(content) - len(rest)
                content = rest
                if content.startswith("#"):
                    break
                continue
            key = None if pending else _KEY.match(content)
            if key:
                if stack and stack[-1] == (at, "list") and len(stack) > 1 and stack[-2] == (at, "map"):
                    stack.pop()  # a list at the indent of its key ends
                if not stack or stack[-1][0] < at:
                    if stack and filled:
                        return None
                    stack.append((at, "map"))
                elif stack[-1] != (at, "map"):
                    return None
                keys += 1
                deepest, filled = max(deepest, len(stack)), False
                content = content[key.end() :].strip()
                level = len(stack)
                if content and (p := _PROPERTIES.match(content)):
                    content = content[p.end() :].strip()
                if not content or content.startswith("#"):
                    break
                if _BLOCK.match(content):
                    scalar, filled = at, True
                    break
                filled = True
                if content[0] not in "[{\"'":
                    if re.search(r":\s|:$", re.sub(r"\s#.*", "", content)):
                        return None
                    break
                pending, pending_at = content, at
                content = ""
            elif not pending:
                if (p := _PROPERTIES.match(content)) and not filled:
                    content = content[p.end() :].strip()
                    if not content:
                        break
                if _BLOCK.match(content) and not filled:
                    scalar, filled = stack[-1][0] if stack else -1, True
                    break
                if content[0] in "[{\"'" and not filled:
                    pending, pending_at, level, filled, content = content, at, len(stack), True, ""
                else:
                    # a plain scalar, or one that goes on
                    if stack and stack[-1] == (at, "map") or re.search(r":\s|:$", re.sub(r"\s#.*", "", content)) or content[0] in "]}@`%":
                        return None
                    filled = True
                    break
            if pending:
                if not _closed(pending):
                    break
                if pending[0] in "[{":
                    if (shape := _flow(pending)) is None:
                        return None
                    keys, deepest = keys + shape[0], max(deepest, level + shape[1])
                elif not re.fullmatch(rf"(?:{_QUOTED})\s*(?:#.*)?", pending, re.DOTALL):
                    return None
                pending = ""
    return None if pending else (keys, deepest)


SHAPES: dict[str, Callable[[str], Shape | None]] = {"json": of_json, "yaml": of_yaml, "toml": of_toml, "xml": of_xml}
