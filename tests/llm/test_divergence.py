"""The divergence audit against a dense brute-force version in exact integers."""

import random
import re
from collections import Counter, defaultdict

import pytest

from folioforge.llm import divergence
from folioforge.llm.shared import Scratch

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, lang string, source string"


def brute(rows, least=10, top=10):
    lower = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        own = Counter(TERM.findall(lower(text)))
        counts[lang, source].update(own)
        docs[lang].update(own.keys())
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, d in docs[lang].items() if d >= least]
        sources = [s for k, s in groups if k == lang]

        def shares(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 2) // (total + 2 * len(kept)) for t in kept}

        f = lambda p, q: (p - q) ** 2 // (p + q)
        whole = shares(sum((counts[lang, s] for s in sources), Counter()))
        p = {s: shares(counts[lang, s]) for s in sources}
        for s in sources:
            pair = [(sum(f(p[s][t], p[o][t]) for t in kept), o) for o in sources if o != s]
            term = [(f(p[s][t], whole[t]), t) for t in kept if counts[lang, s][t] and p[s][t] > whole[t]]
            for part, found, most in (("pair", pair, len(pair)), ("term", term, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, v, k + 1) for k, (v, item) in enumerate(found[:most])]
    return sorted(out)


def audit(spark, rows, **options):
    docs = spark.createDataFrame(rows, SCHEMA)
    return sorted(tuple(r[c] for c in ("lang", "source", "part", "item", "value", "rank")) for r in divergence.audit(docs, Scratch(spark, "test"), **options).collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_brute_force(spark, seed):
    r = random.Random(seed)
    words = ["the", "The", "of", "été", "ÉTÉ", "日本", "x1y", "z"] + [f"w{'abcdefghij'[k % 10]}{'klmnop'[k % 6]}" for k in range(40)]
    rows = []
    for k in range(120):
        own = [r.choice(words[: r.randint(3, len(words))]) for _ in range(r.randint(0, 40))]
        rows.append((k, r.choice((" ", "-", "7 ")).join(own) or None, r.choice(["en", "de", None]), r.choice(["a", "b", "B", "", None, "é"])))
    want = brute(rows, 3, 4)
    assert {x[2] for x in want} == {"pair", "term"}
    assert audit(spark, rows, least=3, top=4) == want


def test_ties_by_bytes(spark, monkeypatch):
    """Terms with equal values are told apart by bytes, one a prefix of the other too, with histograms of few bits."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    terms = ["tie" + c for c in letters] + ["tiea" + c for c in letters[:12]] + ["tie", "é", "日本"]
    rows = [(k, " ".join(terms), "en", "a") for k in range(3)] + [(9 + k, "other words here", "en", "b") for k in range(3)]
    monkeypatch.setattr(divergence, "BITS", 4)
    for top in (1, 30):
        assert audit(spark, rows, least=3, top=top) == brute(rows, 3, top)


def test_odd_and_empty(spark):
    assert audit(spark, []) == []
    rows = [(None, None, None, None), (1, "", "en", "a"), (1, "", "en", "a"), (2, "one two", "en", "b"), (3, "word " * 50_000, "en", "c"), (4, "1 2 3 \x00 _", "de", "a")]
    assert audit(spark, rows) == brute(rows)
    assert [x for x in brute(rows) if x[2] == "pair" and x[4]] == []
    many = rows + [(k, "word", "en", "c") for k in range(20)]
    assert audit(spark, many) == brute(many)
    docs = spark.createDataFrame(many, SCHEMA).selectExpr("*", "1 AS n", "'t' AS term", "2 AS p", "3 AS total", "4 AS need")
    assert divergence.audit(docs, Scratch(spark, "test")).count() == len(brute(many))


def test_large_counts(spark):
    """Shares of counts that pass 64 bits when multiplied."""
    row = spark.createDataFrame([(9 * 10**18 - 5, 9 * 10**18 - 3, 2)], "n long, total long, terms long")
    assert row.select(divergence._share("n", "total", "terms", 10**9).alias("p")).first()["p"] == 1 + 10**9 * (9 * 10**18 - 3) // (9 * 10**18 + 1)
