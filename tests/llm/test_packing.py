"""Packing: the dynamic program against brute force, every id in one piece, little padding, the library's ids."""

import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tenderline.llm.common import read_table
from tenderline.llm.packing import best_fill, filled, op11_packing, pack, packed
from tests.llm.conftest import SMALL
from tests.llm.test_pairs import EDGES
from tests.llm.test_texts import PIECES

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_fill_is_closest_to_room():
    draw = random.Random(1)
    for _ in range(300):
        counts = {draw.randint(1, 30): draw.randint(1, 3) for _ in range(draw.randint(1, 4))}
        room = draw.randint(0, 60)
        chosen = best_fill(counts, room)
        assert all(0 < n <= counts[length] for length, n in chosen.items())
        sums = {sum(n * x for n, x in zip(ns, counts)) for ns in itertools.product(*(range(c + 1) for c in counts.values()))}
        assert sum(length * n for length, n in chosen.items()) == max(s for s in sums if s <= room)


@pytest.mark.parametrize("counts", [{600: 1000}, {1: 5000}, {1023: 7}, {513: 9, 511: 3}, {}, {700: 1}, {k: k % 7 for k in range(1, 1024)}])
def test_windows_are_full_but_for_powers_of_two(counts):
    total = sum(length * n for length, n in counts.items())
    sums = [sum(length for length, _ in pieces) for times, pieces in filled(counts) for _ in range(times)]
    assert sum(sums) == total
    assert all(s & (s - 1) == 0 for s in sums) and sum(s < 1024 for s in sums) <= 10


def whole(rows):
    """Checks pieces and sequences; gives the padding."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append((r["start"], r["length"], r["doc_tokens"]))
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"], r["padded_length"]))
    for pieces in by_doc.values():
        pieces.sort()
        assert [p[0] for p in pieces] == [0, *itertools.accumulate(p[1] for p in pieces)][:-1]
        assert {p[2] for p in pieces} == {sum(p[1] for p in pieces)}
    padding = 0
    for pieces in by_sequence.values():
        pieces.sort()
        assert [p[0] for p in pieces] == [0, *itertools.accumulate(p[1] for p in pieces)][:-1]
        n = sum(p[1] for p in pieces)
        assert n <= 1024 and {p[2] for p in pieces} == {n if n & (n - 1) == 0 else 1024}
        padding += pieces[0][2] - n
    return padding


def test_sizes():
    draw = np.random.default_rng(2)
    for sizes in (draw.integers(1, 3000, 500), np.full(300, 600), np.array([1]), np.array([1024, 2048, 1023]), draw.integers(1, 9, 4000)):
        rows = [dict(zip(("doc_id", "start", "length", "sequence_id", "offset"), r)) for r in packed(sizes).tolist()]
        n = Counter()
        for r in rows:
            n[r["sequence_id"]] += r["length"]
        for r in rows:
            total = n[r["sequence_id"]]
            r |= {"doc_tokens": int(sizes[r["doc_id"]]), "padded_length": total if total & (total - 1) == 0 else 1024}
        assert whole(rows) == 0 and len({r["doc_id"] for r in rows}) == len(sizes)
        pieces = len(rows) - int((sizes // 1024).sum()) - int((sizes % 1024 > 0).sum())
        assert pieces <= len(sizes) + 10  # a remainder is cut where nothing else fits; the tail into powers of two


def test_query_equals_library(spark):
    library = Tokenizer.from_file(PATH)
    rows = op11_packing(spark, SMALL).collect()
    assert whole(rows) == 0
    texts = {r["doc_id"]: r["text"] or "" for r in read_table(spark, SMALL, "documents").collect()}
    ids = {i: np.array([*library.encode(t, add_special_tokens=False).ids, 0], "<u4") for i, t in texts.items()}
    assert {r["doc_id"]: r["doc_tokens"] for r in rows} == {i: len(x) for i, x in ids.items()}
    for r in rows:
        assert r["ids_crc32"] == zlib.crc32(ids[r["doc_id"]][r["start"] : r["start"] + r["length"]].tobytes())


def test_edges(docs):
    library, draw = Tokenizer.from_file(PATH), random.Random(3)
    odd = ["".join(draw.choice(PIECES) for _ in range(40)) for _ in range(60)] + ["a" * 30_000, " " * 5000]
    rows = [(i, t) for i, t in EDGES if i is not None] + [(200 + k, t) for k, t in enumerate(odd)]
    found = pack(docs(rows), PATH).collect()
    assert whole(found) == 0
    got = defaultdict(dict)
    for r in found:
        got[r["doc_id"]][r["start"]] = r["ids"]
    for i, text in rows:
        ids = [x for _, part in sorted(got[i].items()) for x in part]
        assert ids == [*library.encode(text or "", add_special_tokens=False).ids, 0]
    assert pack(docs([]), PATH).count() == 0
    assert [(r["doc_id"], r["ids"]) for r in pack(docs([(None, None)]), PATH).collect()] == [(None, [0])]
    assert sum(r["doc_tokens"] for r in pack(docs([(1, "a"), (1, "a")]), PATH).collect()) == 4
