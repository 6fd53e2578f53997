"""Operators on pairs of documents against brute force, on groups that straddle the threshold, and on edge cases."""

import itertools
import random
from collections import Counter, defaultdict

from tenderline.llm.components import components
from tenderline.llm.decontaminate import MASKS, WINDOW, contaminated, drop_contaminated
from tenderline.llm.exact import drop_copies, exact_groups
from tenderline.llm.jaccard import one_of_each, similar_groups
from tenderline.llm.passages import COMMON_BITS, common_lines, compact_windows, repeated_passages

EDGES = [(90, ""), (91, None), (92, "a"), (93, "a"), (94, "a b"), (None, "a b"), (95, "x " * 30_000), (96, "x " * 30_000)]


def brute_groups(rows, words, percent):
    sets, lead = {}, {}
    for i, text in rows:
        w = (text or "").lower().split()
        sets[i] = {tuple(w[k : k + words]) for k in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)} if w else set()
        lead[i] = i

    def top(x):
        while lead[x] != x:
            x = lead[x]
        return x

    lists = defaultdict(list)
    for i, own in sets.items():
        for s in own:
            lists[s].append(i)
    for i, own in sets.items():
        for j, both in Counter(j for s in own for j in lists[s] if j < i).items():
            if 100 * both >= percent * (len(own) + len(sets[j]) - both):
                a, b = top(i), top(j)
                lead[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), top(i)) for i in sets}


def near_copies(seed=5, groups=2, members=60):
    draw, rows = random.Random(seed), []
    for g in range(groups):
        base = [f"w{draw.randint(0, 9999)}" for _ in range(150)]
        for k in range(members):
            text = base[: 150 - draw.randint(0, 30)] if g and k % 2 else list(base)
            for _ in range(draw.randint(0, 6)):
                text[draw.randrange(len(text))] = f"z{draw.randint(0, 99999)}"
            rows.append((len(rows), " ".join(text)))
    rows += [(len(rows) + k, "the license of this work " + " ".join(f"v{draw.randint(0, 30)}" for _ in range(draw.randint(0, 6)))) for k in range(60)]
    return [(100 + i, t) for i, t in rows]


def test_similar_groups_equal_brute_force(docs):
    rows = near_copies() + [r for r in EDGES if r[0] is not None]
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in similar_groups(docs(rows), 3, 90).collect()}
    assert found == brute_groups(rows, 3, 90)


def test_similar_groups_edges(docs, spark):
    found = similar_groups(docs([*EDGES, (92, "a")])).collect()
    assert len(found) == len(EDGES) + 1
    assert {r["component_id"] for r in found if r["doc_id"] is None} == {None}
    assert similar_groups(docs([])).count() == 0
    kept = one_of_each(docs(EDGES))
    assert kept.columns[:2] == ["doc_id", "text"]
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["90", "91", "92", "94", "95", "None"]


def test_components(spark):
    pairs = [(1, 2), (2, 3), (10, 11), (11, 12), (12, 5), (7, 7)] + [(20, k) for k in range(21, 60)]
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(pairs, "a long, b long"), "a", "b").collect()}
    assert {found[k] for k in (1, 2, 3)} == {1} and {found[k] for k in (5, 10, 11, 12)} == {5}
    assert {found[k] for k in range(20, 60)} == {20} and 7 not in found


def test_exact_groups(docs):
    rows = [(3, "a  b"), (1, "a b"), (2, "a\tb"), (4, None), (5, ""), (6, " "), (None, "a b"), (7, "q" * 5000), (8, "q" * 5000 + "r"), (1, "a b")]
    found = exact_groups(docs(rows), block_chars=64)
    by = sorted((str(r["doc_id"]), r["keep_id"], r["group_size"], r["kept"]) for r in found.collect())
    assert [b[:3] for b in by] == sorted(
        [("1", 1, 5), ("1", 1, 5), ("2", 1, 5), ("3", 1, 5), ("None", 1, 5), ("4", 4, 2), ("5", 4, 2), ("6", 6, 1), ("7", 7, 1), ("8", 8, 1)]
    )
    assert sum(b[3] for b in by) == 5
    assert sorted(r["doc_id"] for r in drop_copies(docs(rows)).collect()) == [1, 4, 6, 7, 8]
    assert exact_groups(docs([])).count() == 0


def test_masks_find_two_replaced_words():
    for gone in itertools.combinations(range(WINDOW), 2):
        assert any(
            all(at + k not in gone for k, c in enumerate(mask) if c == "1")
            for mask in MASKS
            for at in range(WINDOW - len(mask) + 1)
        )


def test_contaminated(docs, spark):
    item = [f"q{k}" for k in range(30)]
    changed = [w if k % 7 else "other" for k, w in enumerate(item)]
    noise = [f"n{k}" for k in range(200)]
    rows = [
        (1, " ".join(noise + item + noise)), (2, " ".join(noise + changed)), (3, " ".join(noise)), (4, None), (5, " ".join(item[:12])),
        (6, " ".join(item[8:24])), (None, " ".join(item)), (1, " ".join(noise + item + noise)), (7, " ".join(reversed(item))),
    ]
    bench = spark.createDataFrame([(5, " ".join(item)), (4, " ".join(item)), (9, None), (8, "too short"), (None, "")], "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]): (r["first_word"], r["last_word"]) for r in contaminated(docs(rows), bench).collect()}
    assert set(found) == {(1, 4), (2, 4), (6, 4), (None, 4)}
    assert found[1, 4] == (200, 229)
    assert sorted(r["doc_id"] for r in drop_contaminated(docs(rows), bench).collect()) == [3, 4, 5, 7]
    assert contaminated(docs([]), bench).count() == 0
    assert drop_contaminated(docs(rows), bench.limit(0)).count() == len(rows)


def test_compact_windows_cover_every_passage():
    import numpy as np

    draw = random.Random(3)
    texts = [" ".join(f"w{draw.randint(0, 40)}" for _ in range(n)) for n in (3, 30, 80, 0, 200)]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0, *map(len, texts)])
    width = 10
    seen = defaultdict(list)
    for i, own, _, left, node, right in compact_windows(data, offsets, width, np.zeros(1 << COMMON_BITS - 3, np.uint8)):
        for row, a, c, b in zip(own.tolist(), left.tolist(), node.tolist(), right.tolist()):
            seen[i, row].append((a, c, b))
    for row, text in enumerate(texts):
        n = len(text.split()) - 4
        for i in range(3):
            for a in range(max(n, 0)):
                for b in range(a + width - 1, n):
                    assert sum(lo <= a <= c <= b <= hi for lo, c, hi in seen[i, row]) == 1


def test_repeated_passages(docs):
    draw = random.Random(4)
    fresh = lambda n: [f"f{draw.randint(0, 10**6)}" for _ in range(n)]
    shared, short = fresh(70), fresh(30)
    nearly = [w if k % 30 else "x" for k, w in enumerate(shared)]
    rows = [(k, " ".join(fresh(80) + (nearly if k % 3 == 2 else shared) + fresh(40 + k))) for k in range(30)]
    rows += [(40 + k, " ".join(fresh(60) + short + fresh(60))) for k in range(5)] + [(50, None), (51, ""), (None, " ".join(shared))]
    found = repeated_passages(docs(rows)).collect()
    assert {r["doc_id"] for r in found} == set(range(30))
    assert all(r["start_word"] <= 84 and r["end_word"] >= 145 for r in found)
    assert repeated_passages(docs([])).count() == 0


def test_only_short_runs_of_common_shingles_are_moved():
    import numpy as np

    shingles = np.arange(1, 401, dtype=np.uint64)
    table = np.zeros(1 << COMMON_BITS, bool)
    table[[*range(50, 80), *range(120, 150), *range(155, 190), *range(300, 330)]] = True
    moved = common_lines(shingles, np.array([0, 310, 404]), np.packbits(table), 46)
    # A short run, a long one across a narrow gap, and a run that two documents share between them.
    assert moved[49:79].all() and not moved[100:250].any()
    assert moved[299:306].all() and not moved[306:310].any() and moved[310:329].all()
    assert moved.sum() == 56


def test_common_lines_keep_passages(docs):
    """A line in more documents than make it common neither hides the passages beside it nor makes one itself."""
    draw = random.Random(6)
    fresh = lambda n: [f"g{draw.randint(0, 10**6)}" for _ in range(n)]
    line, shared = fresh(20), fresh(60)
    rows = [(k, " ".join(fresh(50) + line + fresh(50))) for k in range(90)]
    rows += [(100 + k, " ".join(fresh(30) + line + shared + fresh(30))) for k in range(4)]
    rows += [(200 + k, " ".join(fresh(30) + fresh(50)[:k] + shared + fresh(30))) for k in range(3)]
    found = repeated_passages(docs(rows)).collect()
    assert {r["doc_id"] for r in found} == {100, 101, 102, 103, 200, 201, 202}


def test_windows_of_one_document_are_not_kept(docs, monkeypatch):
    """Only windows that two documents share become rows, and what a step writes is deleted after it."""
    import os

    from tenderline.llm import passages
    from tenderline.llm.common import shared_folder, written

    kept = {}

    def seen(df, name):
        out = written(df, name)
        kept.setdefault(name, []).append(out.count())
        return out

    monkeypatch.setattr(passages, "written", seen)
    draw = random.Random(21)
    alone = [(k, " ".join(f"w{draw.randrange(10**9)}" for _ in range(400))) for k in range(12)]
    assert repeated_passages(docs(alone)).count() == 0 and kept["windows"] == [0]
    both = docs([*alone, (50, alone[3][1])])
    assert {(r["doc_id"], r["rep_doc_id"]) for r in repeated_passages(both).collect()} == {(50, 3), (3, 3)}
    assert kept["windows"][1] > 0
    folder = shared_folder(both.sparkSession).removeprefix("file:")
    assert not [name for name in os.listdir(folder) if name.startswith("step-")]


def test_packed_numbers_and_counts():
    import numpy as np

    from tenderline.llm.passages import _bytes, _counted, _dealt, _numbers, _steps

    draw = np.random.default_rng(3)
    keys = np.sort(draw.integers(0, 1 << 48, 5000, dtype=np.uint64))
    ids = draw.integers(-(1 << 62), 1 << 62, 5000)
    one, two = _numbers(_bytes(_steps(keys), ids.view(np.uint64)), 2)
    assert (np.cumsum(one) == keys).all() and (two.view(np.int64) == ids).all()
    batch = _dealt(keys, 48, 7, ids.view(np.uint64))
    shards = batch.column("shard").to_pylist()
    back = [_numbers(blob, 2) for blob in batch.column("blob").to_pylist()]
    assert shards == sorted(set(shards)) and (np.concatenate([np.cumsum(x[0]) for x in back]) == keys).all()
    some = draw.integers(0, 50, 300)
    found, counts = _counted(some, (np.add, np.ones(300, np.int64)))
    assert (np.bincount(some, minlength=50)[found] == counts).all() and len(found) == len(set(some.tolist()))
    assert [len(x) for x in _counted(some[:0], (np.add, some[:0]))] == [0, 0]


def test_no_pair_with_a_passage_is_ruled_out():
    import numpy as np

    from tenderline.llm.passages import common_passages, may_repeat

    draw, some = np.random.default_rng(8), 0
    for _ in range(300):
        a = draw.integers(0, 1 << 62, 150)
        b = np.concatenate([draw.integers(0, 1 << 62, draw.integers(0, 60)), a[draw.integers(0, 60) :][: draw.integers(30, 90)]])
        b[draw.integers(0, len(b), draw.integers(0, 12))] += 1
        if common_passages(a, b):
            some += 1
            assert may_repeat(a.astype(np.uint16), b.astype(np.uint16), 46)
    assert some > 20
    assert not may_repeat(a.astype(np.uint16), draw.integers(0, 1 << 62, 150).astype(np.uint16), 46)


def test_a_list_of_sets_far_from_each_other_takes_few_rounds(docs, monkeypatch):
    """All shingles are common and no two texts are similar, but for some near copies: hubs grow from round to round."""
    from tenderline.llm import jaccard

    written, rounds = jaccard.written, []
    monkeypatch.setattr(jaccard, "written", lambda df, name: (rounds.append(1) if name == "rest" else None) or written(df, name))
    monkeypatch.setattr(jaccard, "SHORT_LIST", 2)
    rows = [(20 * i + j, f"a{i} x y z{j}") for i in range(14) for j in range(14)]
    line = " ".join(f"x y v{k}" for k in range(9))
    rows += [(900 + k, f"a{k % 3} {line} {' '.join(f'u{m}' for m in range(30) if m // 3 != k % 5)}") for k in range(20)]
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in similar_groups(docs(rows), 3, 90).collect()}
    assert found == brute_groups(rows, 3, 90)
    assert 1 < len(rounds) <= 4
    wide = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in similar_groups(docs(rows), 3, 70).collect()}
    assert wide == brute_groups(rows, 3, 70) and len({c for _, c in wide.values()}) < len(wide)
