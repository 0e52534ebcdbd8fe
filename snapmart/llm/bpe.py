"""Byte-level BPE: a segment tree over adjacent pair ranks, and the exact inverse.

A pre-token's bytes are leaves; leaf ``i`` of the tree holds the rank of the pair
that starts at symbol ``i`` together with its position, so the root names the
leftmost pair of lowest rank.  A merge changes three leaves, each a point update
of logarithmic cost, until the root holds no mergeable pair.

Text is cut into chunks before pre-tokenising.  A single space or newline between
two non-white characters is always a pre-token border, so a chunk's ids do not
depend on its neighbours and frequent chunks are encoded once per worker (bounded
caches).  The library's own splitter cuts chunks into pre-tokens.

Defined cases: a null or empty text has no ids and decodes to the empty text;
repeated rows give repeated results; a text of one long pre-token costs
``n log n`` and a very long text is encoded whole, chunk by chunk; of equal ranks the
leftmost pair merges; special tokens in the text become their own ids, as the library
does; ids may be null; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import re

import numpy as np
from pyspark.sql import DataFrame

from . import shared

SCHEMA = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string, round_trip boolean"

_NONE = 1 << 62
_SHIFT = 20
_MASK = (1 << _SHIFT) - 1
#: Leaves of the trees that are merged many at once: words of up to 33 bytes; longer ones go one by one.
WIDTHS = (2, 4, 8, 16, 32)
#: Words merged in one call: few enough for the arrays to stay in a core's cache.
MANY = 4000
_TWO_WHITE = re.compile(r"\s\s")
_BETWEEN = re.compile(r"(?<=\S) (?=\S)")


def pair_key(a: int, b: int) -> int:
    return a << _SHIFT | b


def width_for(size: int) -> int:
    """The narrowest tree for a word of 2 bytes or more."""
    return max(WIDTHS[0], 1 << (size - 2).bit_length())


def merge_symbols(symbols: list[int], pairs: dict[int, int]) -> list[int]:
    """Merge until no pair has a rank.  ``pairs[a << 20 | b]`` is ``rank << 20 | merged``."""
    n = len(symbols)
    if n < 2:
        return symbols
    size = 1 << (n - 2).bit_length() if n > 2 else 1
    tree = [_NONE] * (2 * size)
    find = pairs.get
    left = symbols[0]
    for i in range(n - 1):
        right = symbols[i + 1]
        hit = find(left << _SHIFT | right)
        if hit is not None:
            tree[size + i] = (hit >> _SHIFT) * n + i
        left = right
    for k in range(size - 1, 0, -1):
        a, b = tree[2 * k], tree[2 * k + 1]
        tree[k] = a if a < b else b
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    while (best := tree[1]) != _NONE:
        i = best % n
        j = after[i]
        merged = pairs[symbols[i] << _SHIFT | symbols[j]] & _MASK
        symbols[i], symbols[j] = merged, -1
        k = after[i] = after[j]
        changed = [(j, _NONE)]
        if k < n:
            before[k] = i
            hit = find(merged << _SHIFT | symbols[k])
            changed.append((i, _NONE if hit is None else (hit >> _SHIFT) * n + i))
        else:
            changed.append((i, _NONE))
        p = before[i]
        if p >= 0:
            hit = find(symbols[p] << _SHIFT | merged)
            changed.append((p, _NONE if hit is None else (hit >> _SHIFT) * n + p))
        for leaf, value in changed:
            node = size + leaf
            if leaf >= n - 1 or tree[node] == value:
                continue
            tree[node] = value
            while node > 1:
                other = tree[node ^ 1]
                node >>= 1
                low = value if value < other else other
                if tree[node] == low:
                    break
                tree[node] = value = low
    return [s for s in symbols if s >= 0]


class PairTable:
    """Pair ranks for looking up many pairs at once: every key stands in one of its two places of two arrays."""

    BITS = 16

    def __init__(self, pairs: dict[int, int]):
        self.keys = np.array(list(pairs), dtype=np.int64)
        self.values = np.array(list(pairs.values()), dtype=np.int64)
        self.bits = max(self.BITS, (2 * len(pairs)).bit_length())
        rng = np.random.default_rng(1)
        while not self._placed(*(int(m) | 1 for m in rng.integers(1 << 62, 1 << 63, 2, dtype=np.uint64))):
            pass

    def _at(self, key: np.ndarray, m: np.uint64) -> np.ndarray:
        return (key.view(np.uint64) * m >> np.uint64(64 - self.bits)).view(np.int64)

    def _placed(self, m0: int, m1: int) -> bool:
        """Cuckoo placement: a key that finds its place taken moves the older one to that one's other place."""
        self.factors = (np.uint64(m0), np.uint64(m1))
        at = [self._at(self.keys, m).tolist() for m in self.factors]
        slots = [[-1] * (1 << self.bits), [-1] * (1 << self.bits)]
        for k in range(len(self.keys)):
            now, side = k, 0
            for _ in range(200):
                place = at[side][now]
                now, slots[side][place] = slots[side][place], now
                if now < 0:
                    break
                side = 1 - side
            else:
                return False
        self.stored = []
        for side in slots:
            held = np.array(side)
            self.stored.append((np.where(held >= 0, self.keys[held], -1), np.where(held >= 0, self.values[held], 0)))
        return True

    def find(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(found, rank << 20 | merged id) of each pair; a pair with a negative symbol is never found."""
        key = a << _SHIFT | b
        (keys0, values0), (keys1, values1) = self.stored
        at0, at1 = (self._at(key, m) for m in self.factors)
        first = keys0.take(at0) == key
        found = first | (keys1.take(at1) == key)
        return found & (key >= 0), np.where(first, values0.take(at0), values1.take(at1))


class Letters:
    """Symbols of single bytes (``last``: of a word's last byte where it differs) and their pairs, by byte pair."""

    def __init__(self, first: list[int], table: PairTable, last: list[int] | None = None):
        self.first = np.array(first, dtype=np.int64)
        self.last = self.first if last is None else np.array(last, dtype=np.int64)
        self.inner = self._pairs(self.first, table)
        self.final = self._pairs(self.last, table)

    def _pairs(self, second: np.ndarray, table: PairTable) -> np.ndarray:
        found, value = table.find(np.repeat(self.first, 256), np.tile(second, 256))
        return np.where(found, value, -1)


def merge_many(words: list[bytes], letters: Letters, table: PairTable, width: int) -> list[bytes]:
    """``merge_symbols`` for many words of 2 to ``width + 1`` bytes at once, one tree of ``width`` leaves a row.

    Each step reads every row's root, merges that pair and updates the paths of its
    three leaves; rows whose root holds no pair are done.
    """
    n, cols = len(words), width + 2
    length = np.array([len(w) for w in words])
    stride = cols + 1  # a last column of "no symbol" that positions before the first and behind the last one hit
    filled = np.arange(stride) < length[:, None]
    raw = np.zeros((n, stride), dtype=np.int64)
    raw[filled] = np.frombuffer(b"".join(words), dtype=np.uint8)
    ends = np.arange(n) * stride + length - 1
    sym = np.where(filled, letters.first.take(raw), -1).ravel()
    sym[ends] = letters.last.take(raw.ravel().take(ends))
    place = np.tile(np.arange(stride, dtype=np.int64), n)
    after, before = place + 1, place - 1
    pair = raw[:, :width] << 8 | raw[:, 1:width + 1]
    known = np.where(filled[:, 1:width + 1], letters.inner.take(pair), -1)
    rows = np.arange(n)
    known[rows, length - 2] = letters.final.take(pair[rows, length - 2])
    new = np.zeros((n, width + 1), dtype=np.int64)
    new[:, :width] = known & _MASK
    new = new.ravel()
    heap = np.full((n, 2 * width), _NONE, dtype=np.int64)
    heap[:, width:] = np.where(known >= 0, (known >> _SHIFT) * cols + np.arange(width), _NONE)
    k = width
    while k > 1:
        heap[:, k // 2:k] = np.minimum(heap[:, k:2 * k:2], heap[:, k + 1:2 * k:2])
        k //= 2
    tree = heap.ravel()
    rows = np.flatnonzero(heap[:, 1] < _NONE)
    while len(rows):
        at_sym, at_tree, at_new = rows * stride, rows * (2 * width), rows * (width + 1)
        i = tree.take(at_tree + 1) % cols
        here = at_sym + i
        j = after.take(here)
        got = new.take(at_new + i)
        k = after.take(at_sym + j)
        sym[here], sym[at_sym + j], after[here] = got, -1, k
        before[at_sym + k] = i
        p = before.take(here)
        m = len(rows)
        found, known = table.find(np.concatenate([got, sym.take(at_sym + p)]), np.concatenate([sym.take(at_sym + k), got]))
        value = np.where(found, (known >> _SHIFT) * cols + np.concatenate([i, p]), _NONE)
        known &= _MASK
        new[at_new + i], new[at_new + p] = known[:m], known[m:]
        nodes = np.concatenate([np.where(j < width, width + j, 0), width + i, np.where(p >= 0, width + p, 0)])
        tops = np.concatenate([at_tree] * 3)
        tree[tops[:m] + nodes[:m]] = _NONE
        tree[tops[m:] + nodes[m:]] = value
        for _ in range(width.bit_length() - 1):
            nodes >>= 1
            below = tops + 2 * nodes
            tree[tops + nodes] = np.minimum(tree.take(below), tree.take(below + 1))
        rows = rows[tree.take(at_tree + 1) < _NONE]
    kept = sym >= 0
    flat = sym[kept].astype("<u4").tobytes()
    ends = (4 * np.cumsum(kept.reshape(n, stride).sum(axis=1))).tolist()
    return [flat[a:b] for a, b in zip([0, *ends], ends, strict=False)]


class ByteBpe:
    """Encoder and decoder for one vocabulary file of the ``tokenizers`` library."""

    def __init__(self, path: str, cache: int = 400_000):
        from tokenizers import pre_tokenizers

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab: dict[str, int] = spec["model"]["vocab"]
        letters = byte_letters()
        self.byte_of = {c: b for b, c in enumerate(letters)}
        self.first = [vocab[c] for c in letters]
        self.pairs = {}
        for rank, (a, b) in enumerate(spec["model"]["merges"]):
            self.pairs.setdefault(vocab[a] << _SHIFT | vocab[b], rank << _SHIFT | vocab[a + b])
        self.table = PairTable(self.pairs)
        self.letters = Letters(self.first, self.table)
        self.special = {t["content"]: np.array([t["id"]], dtype="<u4").tobytes() for t in spec["added_tokens"]}
        self.special_cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.bytes_of: list[bytes] = [b""] * (1 + max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]))
        for token, i in vocab.items():
            self.bytes_of[i] = bytes(self.byte_of[c] for c in token)
        for t in spec["added_tokens"]:
            self.bytes_of[t["id"]] = t["content"].encode()
        self.split = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str
        self.pretokens = shared.TwoGenerationCache(cache // 2)
        self.chunks = shared.TwoGenerationCache(cache)

    def _pieces(self, chunk: str) -> list[bytes]:
        """The chunk's pre-tokens as bytes."""
        word = chunk.rstrip(".,")
        bare = word[1:] if word[:1] == " " else word
        if bare.isalpha() and max(bare) < "Ā":  # the pattern takes a run of letters whole, then the marks
            return [word.encode(), chunk[len(word):].encode()] if len(word) < len(chunk) else [word.encode()]
        byte_of = self.byte_of
        return [bytes([byte_of[c] for c in piece]) for piece, _ in self.split(chunk)]

    def _merged(self, words: set[bytes]) -> dict[bytes, bytes]:
        """Ids of distinct pre-tokens: from the cache, or merged now."""
        out, missing = self.pretokens.take(words)
        new = {}
        by_width: dict[int, list[bytes]] = {w: [] for w in WIDTHS}
        for word in missing:
            if 1 < len(word) <= WIDTHS[-1] + 1:
                by_width[width_for(len(word))].append(word)
            else:
                symbols = merge_symbols([self.first[b] for b in word], self.pairs)
                new[word] = np.array(symbols, dtype="<u4").tobytes()
        for width, some in by_width.items():
            for k in range(0, len(some), MANY):
                part = some[k:k + MANY]
                new.update(zip(part, merge_many(part, self.letters, self.table, width), strict=True))
        self.pretokens.put({w: ids for w, ids in new.items() if len(w) <= 64})
        out.update(new)
        return out

    def encode_chunks(self, chunks: list[str]) -> list[bytes]:
        """Ids of each chunk, as ordinary text: the pattern splits it, special tokens have no part in it."""
        pieces = [self._pieces(c) for c in chunks]
        ids = self._merged({p for some in pieces for p in some})
        return [b"".join([ids[p] for p in some]) for some in pieces]

    def _chunks(self, text: str) -> list[str]:
        """Special tokens and chunks, in order; no chunk's ids depend on another."""
        if "<|" in text:
            out: list[str] = []
            for k, part in enumerate(self.special_cut.split(text)):
                out += [part] if k % 2 else safe_chunks(part)
            return out
        return safe_chunks(text)

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        return shared.by_chunks([self._chunks(t) for t in texts], self.chunks, self.encode_chunks, self.special)

    def encode(self, text: str) -> bytes:
        return self.encode_many([text])[0]

    def decode(self, ids: bytes) -> str:
        table = self.bytes_of
        return b"".join([table[i] for i in np.frombuffer(ids, dtype="<u4").tolist()]).decode("utf-8", "replace")


def safe_chunks(text: str) -> list[str]:
    """Cut where a border between pre-tokens is certain: around single white space between other characters."""
    if not text:
        return []
    if _TWO_WHITE.search(text):
        head, *rest = _BETWEEN.split(text)
        return [head, *[" " + part for part in rest]]
    out: list[str] = []
    for line in text.split("\n"):
        parts = line.replace(" ", "\n ").split("\n")
        out += parts
        out.append("\n")
    out.pop()
    return [c for c in out if c] if "" in out else out


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: printable Latin-1 as itself, others from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


def coder(path: str) -> ByteBpe:
    """The worker's coder for a file; its caches live across tasks."""
    return shared.resident(("bpe", path), lambda: ByteBpe(path))


def encode_decode(docs: DataFrame, path: str) -> DataFrame:
    """Per row: number of ids, digests of the ids and of the decoded text, and whether it is the input again."""
    def rows(batches):
        bpe, sha = coder(path), hashlib.sha256
        for ids, texts in batches:
            codes = bpe.encode_many(texts)
            back = [bpe.decode(c) for c in codes]
            yield {"doc_id": ids, "n_tokens": [len(c) // 4 for c in codes],
                   "ids_sha256": [sha(c).hexdigest() for c in codes],
                   "decoded_sha256": [sha(t.encode()).hexdigest() for t in back],
                   "round_trip": [a == b for a, b in zip(back, texts, strict=True)]}

    return shared.text_map(docs, rows, SCHEMA)


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """Per row: ``doc_id`` and ``ids`` as a list, for callers that want the ids themselves."""
    def rows(batches):
        bpe = coder(path)
        for ids, texts in batches:
            yield {"doc_id": ids,
                   "ids": [np.frombuffer(c, dtype="<u4").astype(np.int32) for c in bpe.encode_many(texts)]}

    return shared.text_map(docs, rows, "doc_id bigint, ids array<int>")
