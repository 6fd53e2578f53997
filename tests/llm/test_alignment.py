"""Alignment against a plain version over all token pairs."""

import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from tenderline.llm.alignment import _Sums, aligned, op13_alignment
from tenderline.llm.bpe import byte_letters
from tenderline.llm.common import read_table
from tests.llm.conftest import SMALL
from tests.llm.test_pairs import EDGES
from tests.llm.test_texts import PIECES

A, B = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


def brute(rows):
    one = Tokenizer.from_file(A)
    one.encode_special_tokens = True
    two = sentencepiece.SentencePieceProcessor(model_file=B)
    number = {c: b for b, c in enumerate(byte_letters())}
    bytes_a = {i: bytes(number[c] for c in t) for t, i in one.get_vocab().items() if i != 50256}
    bytes_b = lambda i: bytes([int(two.id_to_piece(i)[3:5], 16)]) if two.is_byte(i) else two.id_to_piece(i).replace("▁", " ").encode()
    documents, held = [], Counter()
    for doc_id, text in rows:
        ids_a = one.encode(" " + (text or ""), add_special_tokens=False).ids
        ids_b = two.encode(text or "")
        raw = (" " + (text or "")).encode()
        parts = [bytes_a[i] for i in ids_a], [bytes_b(i) for i in ids_b]
        groups = []
        if text and all(b"".join(p) == raw for p in parts):
            ends = [{sum(map(len, p[: k + 1])) for k in range(len(p))} for p in parts]
            common, at = sorted(ends[0] & ends[1]), [0, 0]
            done = [0, 0]
            for end in common:
                group = []
                for side, ids in enumerate((ids_a, ids_b)):
                    own = []
                    while done[side] < end:
                        own.append(ids[at[side]])
                        done[side] += len(parts[side][at[side]])
                        at[side] += 1
                    group.append(own)
                groups.append(group)
        documents.append((doc_id, groups))
        held.update({(a, b) for g in groups for a in g[0] for b in g[1]})
    best = defaultdict(int)
    for (a, _), n in held.items():
        best[a] = max(best[a], n)
    found = []
    for doc_id, groups in documents:
        links = [(a, b) for g in groups for a in g[0] for b in g[1]]
        told = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        found.append((
            doc_id, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(links),
            sum(held[p] == best[p[0]] for p in links), sum(held[p] for p in links),
            hashlib.sha256(told.encode()).hexdigest() if told else "", told,
        ))
    return sorted(found, key=str)


def test_query_equals_plain_version(spark):
    rows = [(r["doc_id"], (r["text"] or "")) for r in read_table(spark, SMALL, "documents").collect()]
    found = op13_alignment(spark, SMALL)
    assert sorted(map(tuple, found.collect()), key=str) == sorted((r[:-1] for r in brute(rows)), key=str)


def test_edges(docs):
    draw = random.Random(8)
    odd = ["".join(draw.choice(PIECES) for _ in range(40)) for _ in range(60)]
    odd += ["<|endoftext|> a", "<s> b </s>", "a▁b", "▁", " ", "\n\n", "x" + " " * 700, "=" * 301, "\x00", "a" * 3000, "ab" * 2000]
    odd += [" ​" * 300, "﻿" * 90, "é" * 200]
    rows = [(i, t) for i, t in EDGES if i not in (None, 95, 96)] + [(200 + k, t) for k, t in enumerate(odd)] + [(200, odd[0])]
    found = sorted(map(tuple, aligned(docs(rows), A, B, with_text=True).collect()), key=str)
    assert found == brute(rows)
    assert aligned(docs([]), A, B).count() == 0
    assert [tuple(r) for r in aligned(docs([(None, "a b"), (None, None)]), A, B).select("doc_id", "n_groups", "n_best").collect()] == [(None, 2, 2), (None, 0, 0)]


def test_documents_of_several_pieces(docs):
    draw = random.Random(10)
    words = ["".join(draw.choice("abcdeilnorst") for _ in range(draw.randint(1, 9))) for _ in range(3000)]
    rows = [(k, " ".join(draw.choice(words) for _ in range(5000)) + ("▁" if k % 7 == 0 else "")) for k in range(60)] + [(99, None)]
    found = {r["doc_id"]: r for r in aligned(docs(rows).coalesce(1), A, B).collect()}
    one, two = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    assert len(found) == len(rows)
    for doc_id, text in rows:
        lost = text is None or "▁" in text
        want = (0, 0) if lost else (len(one.encode(" " + text).ids), len(two.encode(text)))
        assert (found[doc_id]["n_a"], found[doc_id]["n_b"]) == want and (found[doc_id]["groups_sha256"] == "") == lost


def test_sums():
    import numpy as np

    draw, sums, want = np.random.default_rng(4), _Sums(), Counter()
    for _ in range(6):
        keys = np.unique(draw.integers(0, 90_000, 100_000))
        sums.add(keys, np.full(len(keys), 3))
        want.update({int(k): 3 for k in keys})
    sums.settle()
    assert dict(zip(sums.keys.tolist(), sums.counts.tolist())) == want
    empty = _Sums()
    empty.settle()
    assert len(empty.keys) == len(empty.counts) == 0


def test_groups_come_back_without_texts():
    """What the first pass keeps of a piece gives every group again, so that the second encodes no text."""
    import numpy as np
    import pyarrow as pa

    from tenderline.llm.alignment import Aligner, _held, _joined, _opened, _packed

    with open(A, encoding="utf-8") as spec, open(B, "rb") as model:
        one = Aligner(spec.read(), model.read())
    draw = random.Random(12)
    rows = ["".join(draw.choice(PIECES) for _ in range(draw.randint(0, 60))) for _ in range(40)] + [None, "", "a▁b", "x" + " " * 700]
    for part in (rows, [None, "", "a▁b"], []):
        found = one.align(part)
        kinds, code = found.kinds()
        assert len(set(kinds.told())) == kinds.size
        ids = pa.array([None, *range(1, len(part))][: len(part)], pa.int64())
        doc_ids, sizes, kinds, code = _opened(_packed(ids, np.bincount(found.doc, minlength=len(part)), kinds, code))
        assert doc_ids.to_pylist() == ids.to_pylist()
        assert _joined(kinds, code, np.cumsum(sizes)) == found.told()
        pairs, doc, _ = found.links(one.wide)
        assert Counter(_held(found.doc, kinds, code, one.wide).tolist()) == Counter(p for _, p in set(zip(doc.tolist(), pairs.tolist())))
