"""Runs against a brute-force version; edge cases of the digests."""

import hashlib
import itertools
import random
import zlib

import numpy as np

from tenderline.llm.common import read_table
from tenderline.llm.periods import op12_periodic_runs, run_digests, runs_of
from tests.llm.conftest import SMALL
from tests.llm.test_pairs import EDGES


def brute_runs(words, least=12):
    """All (start, length, smallest period), by trying every period."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        k = 0
        while k + q < n:
            if words[k] != words[k + q]:
                k += 1
                continue
            end = k
            while end + q < n and words[end] == words[end + q]:
                end += 1
            length = end + q - k
            if length >= max(least, 2 * q):
                found.setdefault((k, length), q)
            k = end
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def of(sequences, least):
    codes = np.array([c for s in sequences for c in s], np.int64)
    row = np.repeat(np.arange(len(sequences)), [len(s) for s in sequences])
    bounds = np.cumsum([0, *map(len, sequences)])
    found = [[] for _ in sequences]
    for s, n, q in zip(*(x.tolist() for x in runs_of(codes, row, least))):
        found[row[s]].append((s - int(bounds[row[s]]), n, q))
    return found


def test_all_binary_sequences():
    every = [s for n in range(0, 13) for s in itertools.product((0, 1), repeat=n)]
    assert of(every, 1) == [brute_runs(s, 1) for s in every]


def test_structured_sequences():
    draw = random.Random(7)
    cases = []
    for _ in range(400):
        base = [draw.randrange(draw.choice([1, 2, 3, 9])) for _ in range(draw.randint(1, 20))]
        s = []
        for _ in range(draw.randint(1, 6)):
            part = base[draw.randrange(len(base)) :] or base
            s += part * draw.randint(1, 6) + base[: draw.randint(0, 5)]
            if draw.random() < 0.3:
                s.append(draw.randrange(50))
        cases.append(s[:300])
    a, b = [0], [0, 1]
    for _ in range(9):
        a, b = b, b + a
    cases += [b, [bin(k).count("1") % 2 for k in range(256)], [0, 1] * 40 + [0] + [0, 1] * 40, [0] * 500, list(range(100)) * 3]
    for least in (1, 12):
        assert of(cases, least) == [brute_runs(s, least) for s in cases]


def want(doc_id, text, plant):
    words = [w for w in (text or "").replace("\x0b", " ").replace("\x0c", " ").replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ") if w]
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    if plant and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute_runs(words)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    best = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    told = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    return (doc_id, len(found), *top, digest(told), digest(" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_query_equals_brute_force(spark):
    rows = {r["doc_id"]: r["text"] for r in read_table(spark, SMALL, "documents").collect() if len(r["text"] or "") < 3_000}
    found = {r["doc_id"]: tuple(r) for r in op12_periodic_runs(spark, SMALL).collect()}
    assert len(found) == read_table(spark, SMALL, "documents").count()
    assert sum(r[1] for r in found.values()) > 0
    for doc_id, text in rows.items():
        assert found[doc_id] == want(doc_id, text, True)


def test_edges(docs):
    rows = [(i, t) for i, t in EDGES if i is not None] + [(7, "a b c d " * 5 + "e"), (8, "Ä ä x " * 9), (7, "x")]
    found = sorted(map(tuple, run_digests(docs(rows)).collect()), key=str)
    assert found == sorted((want(i, t, False) for i, t in rows), key=str)
    assert run_digests(docs([])).count() == 0
    (row,) = run_digests(docs([(None, "b " * 20)]), plant=True).collect()
    assert (row["doc_id"], row["n_runs"], row["start"], row["length"], row["period"], row["exponent_milli"]) == (None, 1, 0, 20, 1, 20_000)
