"""Runs against a brute-force version."""

import random

import numpy as np
import pytest

from folioforge.llm import periodic_runs as P

from .conftest import ODD, documents


def brute(ids, least=6, times=4):
    n, out = len(ids), []
    for q in range(1, n // times + 1):
        a = 0
        while a + q < n:
            if ids[a] != ids[a + q]:
                a += 1
                continue
            b = a
            while b + q < n and ids[b] == ids[b + q]:
                b += 1
            length = b - a + q
            if length >= max(least, times * q) and not any(all(ids[i] == ids[i + p] for i in range(a, a + length - p)) for p in range(1, q)):
                out.append((a, length, q))
            a = b
    return sorted(out)


def texts(seed, n=30):
    r = random.Random(seed)
    out = []
    for _ in range(n):
        own = []
        for _ in range(r.randint(0, 5)):
            unit = [r.choice("ab" if r.random() < 0.5 else "abcdefgh") for _ in range(r.randint(1, 7))]
            own += (unit * r.randint(1, 8))[: r.randint(1, 40)] + [r.choice("abcxyz") for _ in range(r.randint(0, 4))]
        out.append([w.encode() for w in own])
    return out


@pytest.mark.parametrize("seed", [1, 2, 3, 4])
@pytest.mark.parametrize("least, times", [(6, 4), (2, 3), (9, 5)])
def test_brute_force(seed, least, times):
    some = texts(seed)
    found = list(P.runs_of(some, least, times))
    assert len(found) == len(some)
    for own, r in zip(some, found):
        want = brute(own, least, times)
        assert list(zip(r.start.tolist(), r.length.tolist(), r.period.tolist())) == want
        gone = {i for a, m, q in want for i in range(a + q, a + m)}
        assert r.collapsed() == [w for i, w in enumerate(own) if i not in gone]
        best = min(range(len(want)), key=lambda k: (-want[k][1] / want[k][2], want[k][0], want[k][2])) if want else None
        assert r.first() == best


def test_small_parts(monkeypatch):
    monkeypatch.setattr(P, "_TOGETHER", 10)
    monkeypatch.setattr(P, "_ASK", 3)
    test_brute_force(7, 6, 4)


def test_arrays():
    r = random.Random(0)
    for n in (1, 2, 3, 50):
        ids = np.array([r.randint(0, 2) for _ in range(n)])
        order, place, common = P.suffix_array(ids)
        want = sorted(range(n), key=lambda i: ids[i:].tolist())
        assert order.tolist() == want and place[order].tolist() == list(range(n))
        e = P.Extensions(ids)
        for a in range(n):
            for b in range(n):
                if a != b:
                    k = 0
                    while max(a, b) + k < n and ids[a + k] == ids[b + k]:
                        k += 1
                    assert e.ask(np.array([a]), np.array([b]))[0] == k


def test_long_text(spark):
    """A text of many words with a long period, and one word many times."""
    r = random.Random(3)
    unit = [str(r.randint(0, 10**9)) for _ in range(5000)]
    rows = P.find(documents(spark, "x y " + " ".join(unit * 5), "a " * 100_000)).collect()
    assert [(x["start"], x["length"], x["period"]) for x in rows[0]["runs"]] == [(2, 25_000, 5000)]
    assert bytes(rows[0]["collapsed"]).decode() == "x y " + " ".join(unit)
    assert [(x["start"], x["length"], x["period"]) for x in rows[1]["runs"]] == [(0, 100_000, 1)] and bytes(rows[1]["collapsed"]) == b"a"


def test_odd_and_empty(spark, odd, none):
    rows = P.find(odd.withColumnRenamed("key", "runs")).collect()
    assert len(rows) == len(ODD)
    for x in rows:
        own = P.words(x["text"])
        assert [(y["start"], y["length"], y["period"]) for y in x["runs"]] == (brute(own) if len(own) < 100 else [(0, len(own), 1)])
        assert x["end"] == "end"
    assert P.find(none).count() == 0
