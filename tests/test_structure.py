"""Symbols, outlines, configuration shapes and merged layers against plainer versions."""

import ast
import json
import random
import sysconfig
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from folioforge.functions.lexer import FAMILY, tokens
from folioforge.functions.shapes import SHAPES, of_value, of_yaml
from folioforge.operators import layers, structure, symbols
from folioforge.operators.symbols import analyse, extract

HERE = Path(__file__).resolve().parent.parent
SOURCES = [*sorted((HERE / "folioforge").rglob("*.py")), *(Path(sysconfig.get_paths()["stdlib"]) / f"{n}.py" for n in ("ast", "argparse", "typing", "dataclasses", "inspect", "tokenize", "turtle", "logging/__init__"))]


def by_syntax_tree(text):
    """Functions, classes and imports of Python source, and its complexity, from the standard library's parser."""
    lines, out, complexity = text.split("\n"), [], 1

    def walk(n, scope):
        nonlocal complexity
        within = scope
        if isinstance(n, (ast.FunctionDef, ast.AsyncFunctionDef)):
            plain = [*n.args.posonlyargs, *n.args.args]
            names = [a.arg for a in plain[: len(plain) - len(n.args.defaults)]]
            out.append(("function", n.name, n.lineno, n.end_lineno, scope, names, ast.get_docstring(n, clean=False) is not None))
        elif isinstance(n, ast.ClassDef):
            out.append(("class", n.name, n.lineno, n.end_lineno, scope, [b.id for b in n.bases if isinstance(b, ast.Name)], ast.get_docstring(n, clean=False) is not None))
            within = f"{scope}.{n.name}"
        elif isinstance(n, ast.Import) or isinstance(n, ast.ImportFrom) and n.module != "__future__":
            out.append(("import", None, n.lineno, n.end_lineno, scope, [], False))
        elif isinstance(n, (ast.If, ast.For, ast.AsyncFor, ast.While, ast.With, ast.AsyncWith, ast.Try)):
            other = getattr(n, "orelse", [])
            elif_ = isinstance(n, ast.If) and len(other) == 1 and isinstance(other[0], ast.If) and lines[other[0].lineno - 1].lstrip().startswith("elif")
            complexity += 1 + bool(other and not elif_) + (len(n.handlers) if isinstance(n, ast.Try) else 0)
        for c in ast.iter_child_nodes(n):
            walk(c, within)

    walk(ast.parse(text), "module")
    return out, complexity


@pytest.mark.parametrize("path", SOURCES, ids=lambda p: p.name)
def test_python_as_its_syntax_tree(path):
    text = path.read_text(encoding="utf-8")
    want, complexity = by_syntax_tree(text)
    found = analyse(text, "python")
    mine = []
    for s in found["symbols"]:
        if s["kind"] == "function":
            mine.append(("function", s["name"], s["line"], s["end_line"], s["scope"], [p.split(":")[0].strip() for p in s["parameters"] if p[0] != "*"], s["docstring"] is not None))
        elif s["kind"] == "class":
            mine.append(("class", s["name"], s["line"], s["end_line"], s["scope"], s["bases"], s["docstring"] is not None))
        elif s["kind"] == "import":
            mine.append(("import", None, s["line"], s["line"] + s["statement"].count("\n"), s["scope"], [], False))
    typed = [w if w[0] != "function" else (*w[:5], [], w[6]) for w in want]  # keyword-only parameters have no place in the tree's list
    assert sorted(((*m[:5], [] if m[0] == "function" else m[5], m[6]) for m in mine), key=repr) == sorted(typed, key=repr)
    assert all(set(w[5]) <= set(m[5]) for w in want for m in mine if w[0] == m[0] == "function" and w[1:4] == m[1:4])
    assert found["complexity"] == complexity and found["lines_of_code"] == text.count("\n") + 1


def names(text, language):
    return [(s["kind"], s["name"] or s["statement"], s["line"], s["end_line"], s["scope"]) for s in analyse(text, language)["symbols"]]


def test_scripts():
    text = 'import {a, b} from \'z\'\nexport default async function go(q, r = 1) {\n  return `t ${ fn({a: `in ${1}`}) } function no() {}`;\n}\n// function hidden() {}\nlet re = /function y\\(/g, s = "class Z {";\nclass B extends A.C { m(x) { do { x--; } while (x); while (x) { } } }\nfunction* gen() { for (const i of q) {} for (;;) {} }\nobj.import("q"); obj.class;\n'
    exported = text[text.index("export") : text.index("\n// function")]
    assert names(text, "javascript") == [("import", "import {a, b} from 'z'", 1, 1, "module"), ("export", exported, 2, 4, "module"), ("function", "go", 2, 4, "module"), ("class", "B", 7, 7, "module"), ("function", "gen", 8, 8, "module")]
    found = analyse(text, "javascript")
    assert found["complexity"] == 3 and [s["bases"] for s in found["symbols"] if s["kind"] == "class"] == [["A.C"]]
    assert found["symbols"][2]["modifiers"] == ["default", "async"] and found["symbols"][4]["modifiers"] == ["generator"]
    assert [s["kind"] for s in analyse("interface I { a: string }\ntype T = { b: number };\nenum E { A }\n", "typescript")["symbols"]] == ["interface", "type", "enum"]


def test_other_languages():
    java = 'import java.util.*;\npublic final class C extends D implements E {\n  private int n = f(3);\n  public C(int a) { }\n  @Override public static Map<String, int[]> run(String a) throws X { if (a == "{") { return new H(); } for (int x : b) {} return null; }\n  abstract void g();\n}\n'
    assert names(java, "java") == [("import", "import java.util.*;", 1, 1, "module"), ("class", "C", 2, 7, "module"), ("function", "run", 5, 5, "module.C"), ("function", "g", 6, 6, "module.C")]
    assert analyse(java, "java")["complexity"] == 2
    go = 'package m\nimport (\n  "a"\n)\nconst (\n  Y = iota\n  Z\n)\ntype T struct { a int }\nfunc (t *T) M(a int) { for { if x { } else { } } }\nfunc main() { s := `func no() {` }\n'
    assert [n[:2] for n in names(go, "go")] == [("import", 'import (\n  "a"\n)'), ("constant", "Y"), ("constant", "Z"), ("type", "T"), ("function", "M"), ("function", "main")]
    assert analyse(go, "go")["symbols"][4]["modifiers"] == ["(t *T)"] and analyse(go, "go")["complexity"] == 3
    rust = "use a::{self, B};\npub struct P<'a> { x: &'a str }\ntrait T { fn f(&self); }\npub async fn g(a: u8) { if 'x' == '{' { } else { } }\n"
    assert [n[:2] for n in names(rust, "rust")] == [("import", "use a::{self, B};"), ("struct", "P"), ("trait", "T"), ("function", "f"), ("function", "g")]
    c = "#include <a.h>\n#define N 3\n#define F(x) (x)\nstruct S { int a; };\nstatic int *f(char c) { if (c == '{') { } else { while (1) {} } do { } while (0); }\nint g(void);\n"
    assert [n[:2] for n in names(c, "c")] == [("import", "#include <a.h>"), ("define", "N"), ("struct", "S"), ("function", "f")]
    assert analyse(c, "c")["complexity"] == 4
    assert [n[:2] for n in names("class A : public B { public: int m() const { return 1; } };\nnamespace k { void h() {} }\n", "cpp")] == [("class", "A"), ("function", "m"), ("function", "h")]


def test_never_an_error_and_linear():
    r = random.Random(1)
    text = Path(__file__).read_text()
    for language in FAMILY:
        for _ in range(60):
            a = r.randrange(len(text))
            analyse(text[a : a + r.randrange(400)], language)
            analyse("".join(r.choice("(){}[]\"'`$#/\\*:;=, \nabcdeffornclassfunc") for _ in range(80)), language)
        for piece in ("{", "(", '"', "`${", "/*", "class A {", "def f(", "'''", "do {} while (x) "):
            began = time.perf_counter()
            for _ in tokens(piece * 20_000, language):
                pass
            analyse(piece * 20_000, language)
            assert time.perf_counter() - began < 8


def test_equal_lines_are_read_once():
    """Methods of the same lines: what a line says is worked out once, wherever it stands."""
    method = "    def m(self, a: int, b=1):\n        # if x: for y\n        if a:\n            return 'else: def f'\n        x = \"\"\"if\n  def no():\"\"\"\n        y = (a,\n    b)\n\n"
    text = "import os\nclass C(B):\n" + method * 3_000
    symbols._line.cache_clear()
    began = symbols._line.cache_info().misses
    found = analyse(text, "python")
    assert symbols._line.cache_info().misses - began <= 12
    assert [(s["line"], s["end_line"], s["scope"]) for s in found["symbols"][2:]] == [(3 + 9 * i, 10 + 9 * i, "module.C") for i in range(3_000)]
    assert (found["complexity"], found["node_count"], found["max_depth"]) == (1 + 3_000, 2 + 6 + 27 * 3_000, 3)


def test_extract_of_some_fields(spark):
    rows = [(1, "def f(a): pass\nclass C: x = 1", "python"), (2, None, "python"), (3, "", "go")]
    df = extract(spark.createDataFrame(rows, "id int, content string, language string"), "content", "language", fields=["symbols", "top_level"], keep=["id"])
    assert df.columns == ["id", "code"] and df.schema["code"].dataType.names == ["symbols", "top_level"]
    out = {r["id"]: r["code"] for r in df.collect()}
    assert [s["name"] for s in out[1]["symbols"]] == ["f", "C"] and out[1]["symbols"][0]["docstring"] is None and out[1]["top_level"][1]["line"] == 2
    assert out[2] is None and out[3]["symbols"] == [] and out[3]["top_level"] == []
    few = extract(df.select(F.lit("def f(a): pass").alias("content"), F.lit("python").alias("language")), "content", "language", fields=["symbols"], symbol_fields=["line", "name"], keep=[])
    assert [tuple(x) for x in few.first()["code"]["symbols"]] == [(1, "f")]


def test_extract(spark):
    rows = [(1, "def f(a): pass", "python", "x"), (2, None, "python", "x"), (3, "", "go", "x"), (4, "x", "cobol", "x"), (5, "y", None, "x")]
    df = extract(spark.createDataFrame(rows, "id int, content string, language string, code string"), "content", "language")
    out = {r["id"]: r["code"] for r in df.collect()}
    assert out[1]["symbols"][0]["parameters"] == ["a"] and out[2] is None and out[3]["symbols"] == [] and out[4]["language"] == "cobol" and out[5]["node_count"] == 0
    assert extract(spark.createDataFrame([], "content string, language string"), "content", "language").count() == 0


def test_outline(spark):
    r = random.Random(2)
    levels = [r.randint(1, 6) for _ in range(200)]
    rows = spark.createDataFrame([(k // 100, k, l, f"t{k}") for k, l in enumerate(levels)], "page int, n int, level int, title string")
    for x in structure.outline(rows, ["page"], "n", "level", "title").collect():
        chain, own = [], x["level"]
        for k in range(x["n"] - 1, x["page"] * 100 - 1, -1):
            if levels[k] < own:
                chain.append(k)
                own = levels[k]
        assert x["parent"] == (chain[0] if chain else None) and x["depth"] == len(chain) + 1
        assert x["path"] == " > ".join(f"t{k}" for k in [*chain[::-1], x["n"]])
    assert structure.outline(rows.limit(0), ["page"], "n", "level", "title").count() == 0


YAML = {
    "a: 1\nb:\n- 1\n- c: 2\n  d: |\n    e: f\n    - g\nh: {i: [1, {j: 2}]} # k: l\n": (7, 4),
    "# only\n---\n": (0, 0),
    "": (0, 0),
    "- - 1\n  - a: 'b: c'\n- \"d: e\"\n": (1, 3),
    "? a\n": None,
    "a: b: c": None,
    "a: [1": None,
    "a: 'x": None,
    "a: 1\n\tb: 2": None,
    "a: 1\n  b: 2": None,
    "a: {b: 1}}": None,
    "x: &n 1\ny: *n\nz: !!str 3\nt: it's\n": (4, 1),
    "a: [1,\n  {b: 'c\n  d'}]\ne: 2": (3, 3),
}


def test_shapes(spark):
    for text, shape in YAML.items():
        if text != "? a\n":
            assert of_yaml(text) == shape, text
    assert SHAPES["toml"]("a = 1\n[b.c]\nd = [{e = 2}]\n") == of_value({"a": 1, "b": {"c": {"d": [{"e": 2}]}}}) == (5, 5)
    assert SHAPES["toml"]("a =") is None and SHAPES["xml"]("<a><b/><c><d/></c></a>") == (4, 3) and SHAPES["xml"]("<a>") is None
    assert SHAPES["xml"]('<!DOCTYPE a [<!ENTITY x "y">]><a>&x;</a>') is None and SHAPES["json"]("{") is None
    df = structure.shapes(spark.createDataFrame([(1, "a: 1", "yaml"), (2, None, "yaml"), (3, "x", "ini"), (4, "{}", "json")], "id int, text string, kind string"), "text", "kind")
    assert {r["id"]: (r["key_count"], r["depth"]) for r in df.collect()} == {1: (1, 1), 2: (None, None), 3: (None, None), 4: (0, 1)}


def test_yaml_of_a_writer():
    yaml = pytest.importorskip("yaml")
    r = random.Random(1)
    scalars = [1, "a", "x y", "a: b", "# no", "", None, True, "it's", 'say "hi"', "- dash", "multi\nline", "[x", "é", "null", "@at", "a #b", "long " * 30]

    def value(d):
        k = r.random()
        if d <= 0 or k < 0.35:
            return r.choice(scalars)
        return {r.choice(["a", "b c", "f: g", "#k", "?q", "-z", 'q"']) + str(i): value(d - 1) for i in range(r.randint(0, 3))} if k < 0.7 else [value(d - 1) for _ in range(r.randint(0, 3))]

    for _ in range(400):
        v = value(4)
        assert of_yaml(yaml.safe_dump(v, default_flow_style=r.choice([None, False, True]), allow_unicode=True, width=r.choice([30, 1000]))) == of_value(v)


def merge(a, b):
    out = dict(a)
    for k, v in b.items():
        out[k] = merge(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else v
    return out


def test_deep_merge(spark):
    r = random.Random(4)

    def value(d):
        k = r.random()
        return {r.choice("abc"): value(d - 1) for _ in range(r.randint(0, 2))} if d and k < 0.65 else r.choice([1, "s", None, [1, {"x": 2}], {}, 2.5])

    rows, want = [], {}
    for key in range(150):
        whole = {}
        for layer in range(r.randint(1, 5)):
            own = {r.choice("abc"): value(3) for _ in range(r.randint(0, 3))}
            rows.append((key, layer, json.dumps(own)))
            whole = merge(whole, own)
        want[key] = whole
    rows += [(0, 99, "not json"), (0, 98, "[1]"), (0, 97, None)]
    df = spark.createDataFrame(rows, "who long, layer int, text string").repartition(7)
    found = {x["who"]: json.loads(x["merged"]) for x in layers.deep_merge(df, "who", "layer", "text").collect()}
    assert found == want
    assert layers.deep_merge(df.limit(0), "who", "layer", "text").count() == 0
    assert layers.deep_merge(df.where("layer > 90"), "who", "layer", "text").count() == 0


def test_layers_are_read_once(spark):
    """Every task that takes objects apart counts its rows: none is read twice, and a null layer is the lowest."""
    rows = [(1, None, '{"a": {"b": 1}, "c": 1}'), (1, 1, '{"a": 5}'), (2, None, '{"a": {"b": {}}}'), (3, 1, '{"a": {"b": 1}}'), (3, 2, "{}")]
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(len(batch))
            yield batch

    df = spark.createDataFrame(rows, "who long, layer int, text string").mapInArrow(counted, "who long, layer int, text string")
    found = {x["who"]: json.loads(x["merged"]) for x in layers.deep_merge(df, "who", "layer", "text").collect()}
    assert found == {1: {"a": 5, "c": 1}, 2: {"a": {"b": {}}}, 3: {"a": {"b": 1}}}
    assert read.value == len(rows)


def test_headings(spark):
    page = "<H1 id=a>One <b>two</b>\n three</H1><p>x</p><h3>Deep</h3><h2></h2><h2>Open"
    rows = spark.createDataFrame([(page,), (None,), ("",)], "html string").select(F.explode_outer(structure.headings(F.col("html"))).alias("h"))
    assert [tuple(r["h"]) for r in rows.collect() if r["h"]] == [(1, "One two three"), (3, "Deep"), (2, "")]
