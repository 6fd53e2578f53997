"""Hashes of byte spans; texts on which polynomial hashes modulo a power of two collide."""

import numpy as np
import pytest

from tenderline.llm.common import SpanHash, word_hashes
from tenderline.llm.decontaminate import contaminated
from tenderline.llm.jaccard import similar_groups
from tenderline.llm.lines import drop_frequent_lines
from tenderline.llm.passages import repeated_passages


def twins(length):
    """The Thue-Morse word over a and b, and its complement."""
    word = "".join("ab"[bin(k).count("1") % 2] for k in range(length))
    return word, word.translate(str.maketrans("ab", "ba"))


def test_spans_hash_by_their_bytes():
    draw = np.random.default_rng(3)
    data = draw.integers(0, 256, 5000).astype(np.uint8)
    starts = draw.integers(0, 4000, 400)
    ends = starts + draw.integers(0, 900, 400)
    whole = SpanHash(1)(data, starts, ends)
    for k in range(400):
        own = data[starts[k] : ends[k]]
        assert SpanHash(1)(own, np.array([0]), np.array([len(own)]))[0] == whole[k]
    spans = {data[a:b].tobytes() for a, b in zip(starts, ends)}
    assert len(set(whole.tolist())) == len(spans)
    assert not set(whole.tolist()) & set(SpanHash(2)(data, starts, ends).tolist())


@pytest.mark.parametrize("length", [64, 256, 1024, 4096])
def test_twin_words_part(length):
    one, two = twins(length)
    data = np.frombuffer((one + " " + two).encode(), np.uint8)
    hashes, _ = word_hashes(data, np.array([0, len(data)]))
    assert hashes[0] != hashes[1]


@pytest.mark.parametrize("length", [1024, 4096])
def test_operators_on_twin_texts(docs, spark, length):
    one, two = twins(length)
    lines = [(k, f"{one}\nline {k}") for k in range(10)] + [(20, f"{two}\nline 20")]
    found = {r["doc_id"]: r["n_dropped"] for r in drop_frequent_lines(docs(lines)).collect()}
    assert found == {**dict.fromkeys(range(10), 1), 20: 0}
    sets = [(1, f"{one} {one} {one}"), (2, f"{two} {two} {two}"), (3, one), (4, two)]
    assert {r["doc_id"]: r["component_id"] for r in similar_groups(docs(sets)).collect()} == {k: k for k in range(1, 5)}
    mixed_up = lambda word, tag: " ".join(f"{word}{tag}{k}" for k in range(60))
    assert repeated_passages(docs([(1, mixed_up(one, "x")), (2, mixed_up(two, "x"))])).count() == 0
    bench = spark.createDataFrame([(1, mixed_up(one, "x"))], "item_id long, text string")
    assert contaminated(docs([(1, mixed_up(two, "x"))]), bench).count() == 0
    assert contaminated(docs([(1, mixed_up(one, "x"))]), bench).count() == 1
