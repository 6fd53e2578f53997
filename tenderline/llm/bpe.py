"""BPE encoding as a bounded-lookahead transducer, and decoding as an incremental byte-to-text machine.

Whether two neighbours merge depends on the bytes after them only as far as other merges can compete for the right
one. ``lookahead`` follows these competitions through the merge list (a merge can only be forestalled by one of lower
rank that takes a symbol on its right edge, which again by one of still lower rank, and so on) and gives the number of
bytes after a token boundary that settle it. ``Transducer`` takes a pre-token's bytes piece by piece, holds back that
many bytes, and gives out all tokens before them; so a pre-token of any length needs the memory of a few windows.
Ordinary words are shorter than the window and are encoded at once; their tokens are kept in a table of bounded size.

Read from the tokenizer file (path is a parameter; the driver reads it and sends it to the tasks): vocabulary, merges,
word end, normaliser (NFC, white space, lower case), split pattern, special tokens, decoder.

Defined results: a null text is empty; an empty text has no tokens and decodes to nothing; rows are independent, so
repeated rows give repeated results; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderline.llm.common import read_table, texts

# Runs and words whose tokens a task remembers: between this many of each and twice as many.
REMEMBERED = 1 << 18
# Symbols up to which the pairs are simply searched; longer runs use a heap.
SHORT = 32
# The split pattern of byte-level files that name none, and the white space of their patterns.
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WHITE = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


# White space to str.split() only.
ODD_SPACE = regex.compile(r"[\x1c-\x1f]")


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself where it prints, else the next one from 256 on."""
    prints = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in prints else chr(next(others)) for b in range(256)]


class Bpe:
    """Vocabulary and merges of one file, as numbers."""

    def __init__(self, spec: dict):
        model = spec["model"]
        vocab = dict(model["vocab"])
        self.specials = {t["content"]: t["id"] for t in spec.get("added_tokens") or []}
        self.tokens = {i: t for t, i in vocab.items()} | {i: t for t, i in self.specials.items()}
        end = model.get("end_of_word_suffix") or ""
        letters = byte_letters()
        self.first = [vocab[c] for c in letters]
        self.last = [vocab[c + end] for c in letters]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.ranks = {(vocab[a], vocab[b]): r for r, (a, b) in enumerate(pairs)}
        self.made = [vocab[a + b] for a, b in pairs]
        self.lengths = {i: len(t.removesuffix(end)) if end else len(t) for t, i in vocab.items()}
        self.bytes = {c: b for b, c in enumerate(letters)}
        self.byte_level = (spec.get("decoder") or {}).get("type") == "ByteLevel"
        steps = spec.get("normalizer") or {}
        kinds = {n["type"] for n in steps.get("normalizers", [steps]) if n}
        self.nfc, self.lower = "NFC" in kinds, "Lowercase" in kinds
        self.pattern = regex.compile(self._pattern(spec["pre_tokenizer"]))
        self.special = regex.compile("(" + "|".join(map(regex.escape, self.specials)) + ")") if self.specials else None
        self.window = lookahead(pairs, vocab, self.lengths)
        self.by_run = not self.pattern.search(" \t\n\u00a0")
        self.known, self.words = _Known(self.run), _Known(self.word)

    @staticmethod
    def _pattern(step: dict) -> str:
        for one in step.get("pretokenizers", [step]):
            if one["type"] == "Split":
                return one["pattern"]["Regex"].replace(r"[^\s", f"[^{WHITE}").replace(r"\s", f"[{WHITE}]")
        return BYTE_LEVEL_PATTERN.replace(r"[^\s", f"[^{WHITE}").replace(r"\S", f"[^{WHITE}]").replace(r"\s", f"[{WHITE}]")

    def normalised(self, text: str) -> str:
        if text.isascii():
            return text.lower() if self.lower else text
        if self.nfc and not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        # Letter by letter: no other form for a sigma that ends a word.
        return text.replace("Σ", "σ").lower() if self.lower else text

    def encode(self, text: str) -> bytes:
        """The ids as little-endian 32-bit numbers."""
        found = []
        for part in self.special.split(text) if self.special else [text]:
            if part in self.specials:
                found.append(self.specials[part].to_bytes(4, "little"))
            elif part:
                plain = self.normalised(part)
                # No token has white space in it: each run without it is encoded by itself and may be remembered.
                runs = plain.split() if self.by_run and not ODD_SPACE.search(plain) else [plain]
                found += map(self.known.__getitem__, runs)
        return b"".join(found)

    def run(self, run: str) -> bytes:
        return b"".join(map(self.words.__getitem__, self.pattern.findall(run)))

    def merged(self, symbols: list[int]) -> list[int]:
        one = _merged_short if len(symbols) <= SHORT else _merged_long
        return one(symbols, self.ranks, self.made)

    def word(self, word: str) -> bytes:
        data = word.encode()
        if len(data) <= SHORT:  # less than a window: nothing could be given out before its end
            ids = [*map(self.first.__getitem__, data)]
            ids[-1] = self.last[data[-1]]
            return array("I", _merged_short(ids, self.ranks, self.made)).tobytes()
        run = Transducer(self)
        return array("I", run.feed(data[:-1]) + run.finish(data[-1:])).tobytes()


class _Known(dict):
    """What ``make`` gave for the last keys: two halves, of which the older goes when the newer is full."""

    def __init__(self, make):
        super().__init__()
        self.make, self.older = make, {}

    def __missing__(self, key: str) -> bytes:
        ids = self.older.get(key)
        if ids is None:
            ids = self.make(key)
        if len(key) <= 64:
            if len(self) >= REMEMBERED:
                self.older = dict(self)
                self.clear()
            self[key] = ids
        return ids


def lookahead(pairs, vocab: dict[str, int], lengths: dict[int, int]) -> int:
    """Bytes after a boundary that settle whether a merge joins what is on both its sides."""
    reach: dict[int, int] = {}  # symbol -> bytes that its merges with what follows look at, so far in rank
    inner: dict[int, int] = {}  # token -> the same for the symbols on its right edge, as they stood when it was made
    widest = max(lengths.values())
    for left, right in pairs:
        a, b, made = vocab[left], vocab[right], vocab[left + right]
        edge = max(reach.get(b, 0), inner.get(b, 0))
        need = lengths[b] + edge
        reach[a] = max(reach.get(a, 0), need)
        inner[made] = max(inner.get(made, 0), edge)
        widest = max(widest, need)
    return widest


def _merged_short(symbols: list[int], ranks: dict, made: list[int]) -> list[int]:
    none, get = len(made), ranks.get
    row = [get(p, none) for p in zip(symbols, symbols[1:])]
    while row:
        rank = min(row)
        if rank == none:
            break
        k = row.index(rank)
        symbols[k : k + 2] = [made[rank]]
        del row[k]
        if k:
            row[k - 1] = get((symbols[k - 1], symbols[k]), none)
        if k < len(row):
            row[k] = get((symbols[k], symbols[k + 1]), none)
    return symbols


def _merged_long(symbols: list[int], ranks: dict, made: list[int]) -> list[int]:
    n = len(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    symbols = list(symbols)
    heap = [(ranks[p], k) for k, p in enumerate(zip(symbols, symbols[1:])) if p in ranks]
    heapq.heapify(heap)
    while heap:
        rank, k = heapq.heappop(heap)
        j = after[k]
        if symbols[k] < 0 or j >= n or ranks.get((symbols[k], symbols[j])) != rank:
            continue
        symbols[k], symbols[j] = made[rank], -1
        after[k] = after[j]
        if after[k] < n:
            before[after[k]] = k
        for left, right in ((before[k], k), (k, after[k])):
            if left >= 0 and right < n and (p := (symbols[left], symbols[right])) in ranks:
                heapq.heappush(heap, (ranks[p], left))
    return [s for s in symbols if s >= 0]


class Transducer:
    """Tokens of one pre-token whose bytes come in pieces; holds no more than a few windows of bytes."""

    def __init__(self, bpe: Bpe):
        self.bpe, self.held = bpe, b""

    def feed(self, data: bytes) -> list[int]:
        """The tokens that no later byte can change."""
        if len(self.held) + len(data) <= 2 * self.bpe.window:
            self.held += data
            return []
        out: list[int] = []
        step = 8 * self.bpe.window
        for k in range(0, len(data), step):
            self.held += data[k : k + step]
            if len(self.held) > 2 * self.bpe.window:
                out += self._settled()
        return out

    def _settled(self) -> list[int]:
        ids = self.bpe.merged([self.bpe.first[b] for b in self.held])
        most, end, n = len(self.held) - self.bpe.window, 0, 0
        while end + self.bpe.lengths[ids[n]] <= most:
            end += self.bpe.lengths[ids[n]]
            n += 1
        self.held = self.held[end:]
        return ids[:n]

    def finish(self, data: bytes = b"") -> list[int]:
        self.held += data
        if not self.held:
            return []
        symbols = [self.bpe.first[b] for b in self.held[:-1]] + [self.bpe.last[self.held[-1]]]
        self.held = b""
        return self.bpe.merged(symbols)


class Decoder:
    """Text from ids that come in pieces: byte-level files go through a UTF-8 machine that keeps open characters."""

    def __init__(self, bpe: Bpe):
        self.bpe, self.begun = bpe, False
        self.machine = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids) -> str:
        tokens = list(map(self.bpe.tokens.__getitem__, ids))
        if not self.bpe.byte_level:  # no decoder in the file: tokens with blanks between
            out = " ".join(tokens)
            out = " " + out if self.begun and tokens else out
            self.begun = self.begun or bool(tokens)
            return out
        letters = self.bpe.bytes
        return self.machine.decode(bytes(letters[c] if c in letters else ord("?") for t in tokens for c in t))

    def finish(self) -> str:
        return self.machine.decode(b"", True)


@lru_cache(maxsize=2)
def loaded(spec: str) -> Bpe:
    return Bpe(json.loads(spec))


def _encoded(batches: Iterator[pa.RecordBatch], sent) -> Iterator[pa.RecordBatch]:
    bpe = loaded(sent.value)
    for batch in batches:
        ids = [bpe.encode(t.as_py()) for t in batch.column("text")]
        bounds = np.cumsum([0, *(len(x) // 4 for x in ids)]).astype(np.int32)
        values = pa.array(np.frombuffer(b"".join(ids), "<u4").astype(np.int32))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(bounds), values)], ["doc_id", "ids"]
        )


DECODE_STEP = 1 << 16


def _decoded(batches: Iterator[pa.RecordBatch], sent) -> Iterator[pa.RecordBatch]:
    bpe = loaded(sent.value)
    for batch in batches:
        marks, found = [], []
        for row in batch.column("ids"):
            ids = row.values.to_numpy()
            machine = Decoder(bpe)
            found.append("".join([machine.feed(ids[k : k + DECODE_STEP].tolist()) for k in range(0, len(ids), DECODE_STEP)] + [machine.finish()]))
            marks.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(marks, pa.string()), pa.array(found, pa.string())],
            [*batch.schema.names, "ids_sha256", "decoded"],
        )


def _sent(df: DataFrame, path: str):
    with open(path, encoding="utf-8") as file:
        return df.sparkSession.sparkContext.broadcast(file.read())


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and the token ids of every text."""
    rows = texts(docs)
    sent = _sent(rows, path)
    return rows.mapInArrow(lambda b: _encoded(b, sent), "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` (doc_id, ids) with the digest of the ids and the decoded text."""
    sent = _sent(encoded, path)
    return encoded.select("doc_id", "ids").mapInArrow(
        lambda b: _decoded(b, sent), "doc_id long, ids array<int>, ids_sha256 string, decoded string"
    )


def token_digests(docs: DataFrame, path: str) -> DataFrame:
    found = decode(encode(docs, path), path)
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids_sha256",
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_digests(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
