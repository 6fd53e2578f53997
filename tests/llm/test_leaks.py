"""Overlaps with the benchmark against a version that tries every alignment."""

import random

from tenderline.llm.common import read_table
from tenderline.llm.decontaminate import contaminated, drop_contaminated, every_item, op2_decontamination
from tests.llm.conftest import SMALL


def split(text):
    for c in "\t\n\x0b\x0c\r":
        text = (text or "").replace(c, " ")
    return [w for w in "".join(x.lower() if x.isascii() else x for x in text).split(" ") if w]


def brute(docs, items):
    """(doc_id, item_id): first word, last word and most equal words of one alignment."""
    found = {}
    for doc_id, text in docs:
        words = split(text)
        known = set(words)
        for item_id, body in items:
            item = split(body)
            width = min(13, len(item))
            need = len(item) if len(item) < 8 else -(-4 * width // 5)
            if not item or sum(w in known for w in item) < need:
                continue
            for shift in range(1 - len(item), len(words)):
                a, b = max(0, -shift), min(len(item), len(words) - shift)
                same = [words[shift + k] == item[k] for k in range(a, b)]
                good = [k for k in range(len(same) - width + 1) if sum(same[k : k + width]) >= need]
                if good:
                    first, last = good[0], good[-1] + width - 1
                    old = found.get((doc_id, item_id), (10**9, -1, 0))
                    found[doc_id, item_id] = (
                        min(old[0], shift + a + first), max(old[1], shift + a + last), max(old[2], sum(same[first : last + 1])),
                    )
    return found


def as_rows(found):
    return {(r["doc_id"], r["item_id"]): (r["first_word"], r["last_word"], r["n_equal"]) for r in found}


def test_query_equals_every_alignment(spark):
    docs = [(r["doc_id"], r["text"]) for r in read_table(spark, SMALL, "documents").collect()]
    items = [(r["item_id"], r["text"]) for r in read_table(spark, SMALL, "benchmark").collect()]
    found = op2_decontamination(spark, SMALL).collect()
    assert as_rows(found) == brute(docs, items) and len(found) == len(as_rows(found)) > 0


def test_short_and_equal_items(docs, spark):
    draw = random.Random(21)
    long = [f"q{k}" for k in range(20)]
    items = [(1, "only two"), (2, "ONLY  two"), (3, "w1"), (4, " ".join(long)), (6, " ".join(long)), (5, "a b c d e f g"), (7, ""), (8, None)]
    rows = [
        (1, "here are only two words"), (2, "only one two"), (3, "w1"), (4, " ".join(long[:16])), (5, "x a b c d e f g"), (6, "a b c d e f h"),
        (7, None), (8, " ".join(draw.choice(["only", "two", "w2"]) for _ in range(60))),
    ]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = every_item(contaminated(docs(rows), bench), bench).collect()
    want = brute(rows, items)
    assert as_rows(found) == want
    assert {(1, 1), (1, 2), (3, 3), (4, 4), (4, 6), (5, 5)} <= set(want) and (6, 5) not in want
    assert {r["doc_id"] for r in drop_contaminated(docs(rows), bench).collect()} == {i for i, _ in rows} - {d for d, _ in want}
