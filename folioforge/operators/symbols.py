"""Symbols, metrics and outline of source code, row by row in Arrow tasks.

One pass over the tokens of a text (see ``functions.lexer``) with a stack of open
scopes: indented blocks for Python, braces for the others.  What a line of Python
says on its own is worked out once for equal lines (the last 16,384 of them are
held).  A text that holds no such code, or of an unknown language, gives empty
lists; null gives null.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.lexer import FAMILY, Token, tokens

#: Words that add one to the complexity. The table of Python holds for every language, so far as its grammar has such nodes.
BRANCHES = {
    "python": "if elif else for while try except with", "javascript": "if else for while try with", "typescript": "if else for while try with",
    "java": "if for while try", "c": "if else for while", "cpp": "if else for while try", "go": "if for", "rust": "else",
}
_PYTHON_BRANCHES = frozenset(BRANCHES["python"].split())
#: What begins a definition, by language.
DEFINES = {
    "javascript": {"function": "function", "class": "class"},
    "typescript": {"function": "function", "class": "class", "interface": "interface", "type": "type", "enum": "enum"},
    "java": {"class": "class", "interface": "interface", "enum": "enum"},
    "go": {"func": "function", "type": "type", "const": "constant"},
    "rust": {"fn": "function", "struct": "struct", "enum": "enum", "trait": "trait"},
    "c": {"struct": "struct"},
    "cpp": {"struct": "struct", "class": "class"},
}
_IMPORTS = {"javascript": ("import", "export"), "typescript": ("import", "export"), "java": ("import",), "go": ("import",), "rust": ("use",)}
_MODIFIERS = frozenset("public private protected static final abstract native synchronized default strictfp transient volatile async pub unsafe extern const override virtual inline".split())
_COMPOUND = frozenset("if elif else for while try except finally with def class match case".split())
_OPEN, _CLOSE = {"(": ")", "[": "]", "{": "}"}, frozenset(")]}")
#: The fields of a symbol and of the result.
SYMBOL_FIELDS = {"kind": "string", "name": "string", "line": "int", "end_line": "int", "scope": "string", "parameters": "array<string>", "bases": "array<string>", "decorators": "array<string>", "modifiers": "array<string>", "docstring": "string", "statement": "string"}
FIELDS = {"language": "string", "symbols": "array<{symbol}>", "lines_of_code": "int", "complexity": "int", "max_depth": "int", "node_count": "int", "top_level": "array<struct<type: string, line: int, end_line: int>>"}


def _struct(fields: dict[str, str], names: list[str] | None = None) -> str:
    return f"struct<{', '.join(f'{n}: {fields[n]}' for n in names or fields)}>"


RESULT = _struct(FIELDS).format(symbol=_struct(SYMBOL_FIELDS))


def _symbol(kind: str, name: str | None, line: int, scope: str, **more) -> dict:
    return {"kind": kind, "name": name, "line": line, "end_line": line, "scope": scope, "parameters": [], "bases": [], "decorators": [], "modifiers": [], "docstring": None, "statement": None, **more}


def _items(text: str, inside: list[Token]) -> list[tuple[str, list[Token]]]:
    """The parts of a list in brackets between its commas, as text and tokens."""
    out, depth, own = [], 0, []
    for t in inside:
        depth += (t.text in _OPEN) - (t.text in _CLOSE) if t.kind == "sign" else 0
        if t.text == "," and t.kind == "sign" and not depth:
            out.append(own)
            own = []
        elif t.kind != "line":
            own.append(t)
    return [(text[p[0].start : p[-1].end], p) for p in [*out, own] if p]


def _bracketed(own: list[Token], at: int) -> int:
    """Position behind the bracket that ``own[at]`` opens."""
    depth = 0
    for i in range(at, len(own)):
        if own[i].kind == "sign":
            depth += (own[i].text in _OPEN) - (own[i].text in _CLOSE)
            if not depth:
                return i + 1
    return len(own)


def _plain_parameters(text: str, inside: list[Token]) -> list[str]:
    """Parameters without a default that are a name, or have a type."""
    return [whole for whole, p in _items(text, inside) if not any(t.text == "=" for t in p) and (p[0].kind == "word" or len(p) > 2) and (len(p) == 1 or any(t.text == ":" for t in p))]


def _docstring(text: str) -> str:
    """A string token without prefix and quotes."""
    text = text.lstrip("rRbBfFuU")
    n = 3 if text[:3] in ('"""', "'''") else 1
    return text[n : -n if text.endswith(text[:n]) and len(text) >= 2 * n else None].strip()


class _Statement(NamedTuple):
    """What a statement of Python says without its surroundings; lines are counted from the line it begins on."""

    line: int
    branch: bool
    docstring: str | None  # a statement of strings only
    defines: tuple[str, str, list[str], list[str]] | None  # kind, name, parameters or bases, modifiers
    imports: tuple[str, str] | None  # statement, kind
    decorator: str | None
    constants: tuple[tuple[str, int], ...]
    block: bool
    after: tuple[_Statement, ...]  # statements behind the colon of a header
    plain: bool  # it neither defines nor opens anything


def _statement(text: str, own: list[Token], base: int) -> _Statement:
    at = 1 if own[0].text == "async" and len(own) > 1 else 0
    word, line = own[at].text if own[at].kind == "word" else own[at].kind, own[at].line
    following = own[at + 1] if len(own) > at + 1 else None
    docstring = _docstring(own[0].text) if all(t.kind == "string" for t in own) else None
    defines = imports = decorator = None
    constants, after = [], ()
    if word in ("def", "class") and following is not None and following.kind == "word":
        k = at + 2
        while k < len(own) and own[k].text == "[":  # type parameters
            k = _bracketed(own, k)
        inside = own[k + 1 : _bracketed(own, k) - 1] if k < len(own) and own[k].text == "(" else []
        modifiers = ["async"] if at else []
        if word == "def":
            defines = ("function", following.text, _plain_parameters(text, inside), modifiers)
        else:
            defines = ("class", following.text, [p[0].text for _, p in _items(text, inside) if len(p) == 1 and p[0].kind == "word"], modifiers)
    elif word in ("import", "from") and not (word == "from" and following is not None and following.text == "__future__"):
        imports = (text[own[at].start : own[-1].end].strip(), "from_import" if word == "from" else "import")
    elif own[0].text == "@" and own[0].kind == "sign":
        decorator = text[own[0].start : own[-1].end]
    elif own[0].kind == "word":
        k = 0
        while k + 1 < len(own) and own[k].kind == "word" and own[k + 1].text in ("=", ":"):
            typed = own[k + 1].text == ":"
            if own[k].text.isupper() and own[k].text not in _COMPOUND and not (k + 2 < len(own) and own[k + 2].text == "=" and not typed):
                constants.append((own[k].text, own[k].line - base))
            if typed:
                break
            k += 2
    if word in _COMPOUND:
        depth = 0
        for i, t in enumerate(own):
            depth += ((t.text in _OPEN) - (t.text in _CLOSE)) if t.kind == "sign" else 0
            if t.kind == "sign" and t.text == ":" and not depth and i + 1 < len(own) and "lambda" not in [x.text for x in own[:i]]:
                after = _statements(text, own[i + 1 :], base)
                break
    block = word in _COMPOUND and word not in ("def", "class") and any(t.text == ":" for t in own)
    plain = not (defines or imports or decorator or constants or block or after)
    return _Statement(line - base, word in _PYTHON_BRANCHES, docstring, defines, imports, decorator, tuple(constants), block, after, plain)


def _statements(text: str, own: list[Token], base: int) -> tuple[_Statement, ...]:
    """The statements between the semicolons of a logical line."""
    out, depth, first = [], 0, 0
    for i, t in enumerate(own):
        depth += ((t.text in _OPEN) - (t.text in _CLOSE)) if t.kind == "sign" else 0
        if t.text == ";" and not depth:
            if i > first:
                out.append(_statement(text, own[first:i], base))
            first = i + 1
    if first < len(own):
        out.append(_statement(text, own[first:], base))
    return tuple(out)


@lru_cache(maxsize=16_384)
def _line(line: str) -> tuple[int, int, tuple[_Statement, ...]] | None:
    """(indent, nodes, statements) of a line that says all on its own; the indent is -1 if it has no tokens, and None stands for a line that may go on."""
    if '"""' in line or "'''" in line or line.endswith(("\\", "\\\r")):
        return None
    own, depth = [*tokens(line, "python")], 0
    for t in own:
        if t.kind == "sign":
            depth = max(0, depth + (t.text in _OPEN) - (t.text in _CLOSE))
    if depth:
        return None
    indent = len(line[: own[0].start].expandtabs()) if own else -1
    return indent, sum(t.kind != "string" for t in own), _statements(line, own, 1)


class _Code:
    """What one pass over a text collects."""

    def __init__(self, text: str, language: str):
        self.text, self.language = text, language
        self.symbols: list[dict] = []
        self.top: list[dict] = []
        self.complexity, self.depth, self.nodes = 1, 0, 0
        self.branches = frozenset(BRANCHES[language].split())

    def add(self, symbol: dict, outermost: bool) -> dict:
        self.symbols.append(symbol)
        if outermost and symbol["kind"] in ("function", "class"):
            self.top.append(symbol)
        return symbol

    # Python: logical lines and a stack of indents

    def python(self) -> None:
        text = self.text
        stack: list[tuple[int, dict | None, str]] = []  # (indent of the header, its symbol, scope inside)
        decorators: list[str] = []
        header: dict | None = None  # a definition whose first statement is still to come
        last = 1

        def close(indent: int) -> None:
            while stack and stack[-1][0] >= indent:
                if stack[-1][1]:
                    stack[-1][1]["end_line"] = last
                stack.pop()

        def take(s: _Statement, indent: int, base: int) -> None:
            nonlocal header, decorators
            if header is not None:
                if s.docstring is not None:
                    header["docstring"] = s.docstring
                header = None
            self.complexity += s.branch
            if s.plain:
                return
            scope = stack[-1][2] if stack else "module"
            if s.defines:
                kind, name, inside, modifiers = s.defines
                symbol = _symbol(kind, name, base + s.line, scope, decorators=decorators, modifiers=[*modifiers], **{"parameters" if kind == "function" else "bases": [*inside]})
                decorators = []
                self.add(symbol, not stack)
                header = symbol
                stack.append((indent, symbol, scope if kind == "function" else f"{scope}.{name}"))
            elif s.imports:
                self.add(_symbol("import", None, base + s.line, scope, statement=s.imports[0], modifiers=[s.imports[1]]), False)
            elif s.decorator is not None:
                decorators.append(s.decorator)
            elif s.constants and scope == "module":
                for name, line in s.constants:
                    self.add(_symbol("constant", name, base + line, scope), False)
            if s.block:
                stack.append((indent, None, scope))
            self.depth = max(self.depth, len(stack))
            for inner in s.after:
                take(inner, indent + 1, base)

        at, number = 0, 1
        while at < len(text):
            end = text.find("\n", at)
            if end < 0:
                end = len(text)
            found = _line(text[at:end]) if end - at <= 200 else _line.__wrapped__(text[at:end])
            if found is not None:
                indent, nodes, statements = found
                base = until = number
                at, number = end + 1, number + 1
            else:  # strings or brackets that may go over lines
                own: list[Token] = []
                depth, begins = 0, at
                at = len(text)
                for t in tokens(text, "python", begins, number):
                    if t.kind == "line":
                        if depth <= 0:
                            at, number = t.end, t.line + 1
                            break
                        continue
                    own.append(t)
                    if t.kind == "sign":
                        depth = max(0, depth + (t.text in _OPEN) - (t.text in _CLOSE))
                nodes = sum(t.kind != "string" for t in own)
                if not own or depth > 0:
                    self.nodes += nodes
                    continue
                begins = text.rfind("\n", 0, own[0].start) + 1
                indent, base = len(text[begins : own[0].start].expandtabs()), own[0].line
                statements, until = _statements(text, own, base), own[-1].line + own[-1].text.count("\n")
            self.nodes += nodes
            if indent >= 0:
                if stack and stack[-1][0] >= indent:
                    close(indent)
                for s in statements:
                    take(s, indent, base)
                last = until
        close(-1)

    # languages with braces: a stack of open brackets

    def braces(self) -> None:
        language, text = self.language, self.text
        defines, imports = DEFINES[language], _IMPORTS.get(language, ())
        code = [t for t in tokens(text, language) if t.kind != "line"]
        close = [0] * len(code)  # the token that closes each opening one
        stack: list[int] = []
        for i, t in enumerate(code):
            close[i] = len(code) - 1
            if t.kind == "sign" and t.text in _OPEN:
                stack.append(i)
            elif t.kind == "sign" and t.text in _CLOSE and stack:
                close[stack.pop()] = i
        open_: list[tuple[int, bool, str]] = []  # (closing token, body of a type, scope inside)
        before = 0  # the first token of the statement
        named: dict[int, tuple[bool, str]] = {}  # opening braces of definitions
        skip = -1  # tokens of an import up to here are not looked at
        for i, t in enumerate(code):
            while open_ and open_[-1][0] < i:
                open_.pop()
            scope = open_[-1][2] if open_ else "module"
            self.nodes += t.kind != "string"
            if t.kind == "directive":
                own = text[t.start : t.end].strip()
                head = own.lstrip("# \t").split(None, 1)
                if language in ("c", "cpp") and head:
                    if head[0] == "include":
                        self.add(_symbol("import", None, t.line, scope, statement=own, modifiers=["include"]), False)
                    elif head[0] == "define" and len(head) > 1:
                        name = head[1].split("(")[0].split()[0]
                        if "(" not in head[1].split()[0]:
                            self.add(_symbol("define", name, t.line, scope), False)
                before = i + 1
                continue
            if t.kind == "sign":
                if t.text in _OPEN:
                    of_type, inner = named.get(i, (False, scope))
                    open_.append((close[i], of_type, inner))
                    self.depth = max(self.depth, len(open_))
                if t.text in ("{", "}", ";") or t.text == ":" and self.language == "cpp" and code[i - 1].text in ("public", "private", "protected"):
                    before = i + 1
                continue
            if t.kind != "word" or i <= skip:
                continue
            following = code[i + 1] if i + 1 < len(code) else None
            member = i > 0 and code[i - 1].text in (".", "?.")
            if t.text in self.branches and not member:
                self.complexity += self._counts(code, close, i)
            begins = i == before or code[i - 1].line < t.line
            if t.text in imports and begins and not member and (language == "go" or not (following and following.text in ("(", "."))):
                end = self._statement_end(code, close, i)
                kind = "export" if t.text == "export" else "import"
                self.add(_symbol(kind, None, t.line, scope, statement=text[t.start : code[end].end].rstrip("; \n").strip() if kind == "export" else text[t.start : code[end].end].strip(), end_line=code[end].line), False)
                if kind == "import":
                    skip = end
                else:
                    before = i + 1
                continue
            if language == "cpp" and t.text == "namespace" and following is not None:  # what is in its braces is at the top still
                body = next((j for j in range(i + 1, min(i + 8, len(code))) if code[j].text in ("{", ";", "=")), i)
                if code[body].text == "{":
                    named[body] = (True, scope)
                continue
            kind = None if member else defines.get(t.text)
            if kind and following is not None:
                self._definition(code, close, i, before, kind, scope, len(open_) == 0, named)
            elif language in ("java", "c", "cpp") and following is not None and following.text == "(" and i > before:
                self._typed_function(code, close, i, before, scope, open_, named)

    def _counts(self, code: list[Token], close: list[int], i: int) -> bool:
        """Whether a branch word is a statement of its own: no loop over a collection, no end of a do loop."""
        word, nxt = code[i].text, i + 1
        if word == "for" and self.language in ("javascript", "typescript", "java") and nxt < len(code) and code[nxt].text == "(":
            inside = code[nxt + 1 : close[nxt]]
            return any(t.text == ";" for t in inside)
        if word == "while" and i and code[i - 1].text == "}" and nxt < len(code) and code[nxt].text == "(":
            end = close[nxt] + 1
            return not (end >= len(code) or code[end].text != "{") or not self._ends_do(code, i)
        return True

    def _ends_do(self, code: list[Token], i: int) -> bool:
        depth = 0
        for k in range(i - 1, -1, -1):
            depth += (code[k].text == "}") - (code[k].text == "{")
            if not depth:
                return k > 0 and code[k - 1].text == "do"
        return False

    def _statement_end(self, code: list[Token], close: list[int], i: int) -> int:
        """The last token of a statement: a semicolon, the brace of a body, or the last one of its line."""
        k = i
        while k < len(code) - 1:
            if code[k].text == ";" and code[k].kind == "sign":
                return k
            if code[k].kind == "sign" and code[k].text in _OPEN:
                k = close[k]
                if code[k].text == "}" and k + 1 < len(code) and code[k + 1].text not in ("from", ";", ",", "="):
                    return k
                if k >= len(code) - 1:
                    return len(code) - 1
                if code[k].text == ")" and self.language == "go":
                    return k
            if self.language in ("go", "javascript", "typescript") and code[k + 1].line > code[k].line and code[k + 1].text not in ("{", "(", "from", ".", "}") and code[k].text not in ("(", "{", ",", "="):
                return k
            k += 1
        return k

    def _definition(self, code: list[Token], close: list[int], i: int, before: int, kind: str, scope: str, outermost: bool, named: dict) -> None:
        """A definition that a word begins: its name, head and body."""
        k, symbol = i + 1, None
        modifiers = [t.text for t in code[before:i] if t.text in _MODIFIERS and self.language != "go"]
        if self.language in ("javascript", "typescript") and kind == "function":
            if i and code[i - 1].text == "async" and "async" not in modifiers:
                modifiers.append("async")
            if code[k].text == "*":
                modifiers.append("generator")
                k += 1
        if self.language == "go" and kind == "function" and code[k].text == "(":
            receiver = self.text[code[k].start : code[close[k]].end]
            k = close[k] + 1
            modifiers = [receiver]
        if self.language == "go" and kind in ("type", "constant") and k < len(code) and code[k].text == "(":
            end, line = close[k], 0
            for j in range(k + 1, end):
                if code[j].kind == "word" and code[j].line > line and code[j - 1].text != ",":
                    self.add(_symbol(kind, code[j].text, code[j].line, scope), outermost)
                line = code[j].line
            return
        if k >= len(code) or code[k].kind != "word" or code[k].text in ("extends", "implements"):
            return
        name = code[k]
        symbol = _symbol(kind, name.text, code[i].line, scope, modifiers=modifiers)
        k += 1
        while k < len(code) and code[k].text not in ("{", ";", "}") and not (code[k].text == "(" and kind != "function"):
            if code[k].text == "(":
                if not symbol["parameters"]:
                    symbol["parameters"] = [whole for whole, _ in _items(self.text, code[k + 1 : close[k]])]
                k = close[k]
            elif code[k].text in ("extends", "implements") or code[k].text == ":" and self.language == "cpp":
                j = k + 1
                while j < len(code) and code[j].text not in ("{", ";", "implements"):
                    j += 1
                symbol["bases"] += [" ".join(x for x in whole.split() if x not in ("public", "private", "protected")) for whole, _ in _items(self.text, code[k + 1 : j])]
                k = j - 1
            elif kind == "type" and self.language == "typescript" or self.language in ("c", "cpp") and kind == "struct" and code[k].kind == "word" or kind == "constant":
                break
            k += 1
        body = k < len(code) and code[k].text == "{"
        if body:
            symbol["end_line"] = code[close[k]].line
            typed = kind in ("class", "interface", "enum", "struct", "trait")
            named[k] = (typed, f"{scope}.{name.text}" if typed else scope)
        self.add(symbol, outermost)

    def _typed_function(self, code: list[Token], close: list[int], i: int, before: int, scope: str, open_: list, named: dict) -> None:
        """A method or function written as type, name, parameters and body."""
        if open_ and not open_[-1][1] or code[i - 1].kind == "sign" and code[i - 1].text not in (">", "]", "*", "&", "::"):
            return
        if any(t.text in ("=", "return", "new", "throw", "else") for t in code[before:i]):
            return
        k = close[i + 1] + 1
        while k < len(code) and code[k].text not in ("{", ";", "}", "="):
            if code[k].text == ":" and self.language == "cpp" or code[k].kind == "sign" and code[k].text in ")(":
                k = next((j for j in range(k, len(code)) if code[j].text in ("{", ";")), len(code)) - 1 if code[k].text == ":" else k
            k += 1
        body = k < len(code) and code[k].text == "{"
        if not body and (self.language != "java" or k >= len(code) or code[k].text != ";"):
            return
        modifiers = [t.text for t in code[before:i] if t.text in _MODIFIERS]
        types = [t for j, t in enumerate(code[before:i], before) if t.kind == "word" and t.text not in _MODIFIERS and (not j or code[j - 1].text != "@")]
        if self.language == "java" and not types:
            return  # a constructor has no type
        symbol = _symbol("function", code[i].text, code[before].line, scope, modifiers=modifiers, parameters=[whole for whole, _ in _items(self.text, code[i + 2 : close[i + 1]])])
        if body:
            symbol["end_line"] = code[close[k]].line
            named[k] = (False, scope)
        self.add(symbol, not open_)


def analyse(text: str, language: str | None) -> dict:
    """Symbols, metrics and outline of one text."""
    if language not in FAMILY:
        return {"language": language, "symbols": [], "lines_of_code": text.count("\n") + 1, "complexity": 1, "max_depth": 0, "node_count": 0, "top_level": []}
    code = _Code(text, language)
    code.python() if language == "python" else code.braces()
    return {"language": language, "symbols": code.symbols, "lines_of_code": text.count("\n") + 1, "complexity": code.complexity, "max_depth": code.depth, "node_count": code.nodes, "top_level": [{"type": s["kind"], "line": s["line"], "end_line": s["end_line"]} for s in code.top]}


def _nested(values: list, kind: pa.DataType) -> pa.Array:
    """The values as an array, built by columns."""
    if pa.types.is_struct(kind):
        columns = [_nested([None if v is None else v[f.name] for v in values], f.type) for f in kind]
        return pa.StructArray.from_arrays(columns, fields=list(kind), mask=pa.array([v is None for v in values], pa.bool_()))
    if pa.types.is_list(kind) and pa.types.is_struct(kind.value_type):
        ends = pa.array(accumulate((len(v or ()) for v in values), initial=0), pa.int32())
        return pa.ListArray.from_arrays(ends, _nested([x for v in values for x in v or ()], kind.value_type), type=kind, mask=pa.array([v is None for v in values], pa.bool_()))
    return pa.array(values, kind)


def extract(df: DataFrame, content: str, language: str, out: str = "code", *, fields: list[str] | None = None, symbol_fields: list[str] | None = None, keep: list[str] | None = None) -> DataFrame:
    """``df`` with a column of symbols, metrics and top-level outline (``RESULT``) of the source in ``content``.

    ``language``: a column with its language (see ``functions.code.language``); one
    that is not known gives no symbols; a null content gives null.  ``fields``: the
    fields of the result, ``symbol_fields``: those of its symbols, ``keep``: the
    columns of ``df`` that stay (all if not given).
    """
    kept = df.drop(out)
    stay = kept.columns if keep is None else keep
    result = _struct(FIELDS, fields).format(symbol=_struct(SYMBOL_FIELDS, symbol_fields))
    schema = kept.limit(0).select(*stay).withColumn(out, F.lit(None).cast(result)).schema
    kind = kept.sparkSession.createDataFrame([], f"x {result}").limit(0).toArrow().schema.field(0).type

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, len(batch), 256):
                part = batch.slice(a, 256)
                found = [None if t is None else analyse(t, k) for t, k in zip(part.column(content).to_pylist(), part.column(language).to_pylist())]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in stay), _nested(found, kind)], names=[*stay, out])

    return kept.mapInArrow(each, schema)
