"""Edit-aware token counts: a segment tree over the pre-tokens of each document.

A leaf is a pre-token of the vocabulary's own pattern.  Of one that is long (a script
without spaces, a key) a leaf is a run of whole tokens: two neighbouring runs are right as
they are if the last token of one and the first of the other, taken alone, stay apart under
the merges.  A merge across the border would join parts of just these two.

The tree holds sums of characters and of tokens.  An edit finds its leaves by descending
the character sums.  What it touches is split and encoded again, with boundary context:
from the leaf of two characters before (the pattern looks no further ahead of a
pre-token's end) to the first old border that the pattern, or in a long pre-token the two
tokens beside it, still has.  Sums are updated on the way to the root.

The count is of ordinary text: strings of special tokens count as the text they are.

Defined cases: a null or empty text has no leaves and no tokens, and edits may fill it; an
edit may be empty on either side; repeated rows repeat their result; a very long text,
with or without spaces, costs the same for each edit up to the logarithm of its length,
unless the edit changes tokens far away (a run of one letter whose length changes); ids
may be null; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame

from . import bpe, shared

SCHEMA = ("doc_id bigint, n_tokens bigint, n_edits bigint, n_tokens_after bigint, n_chars_after bigint, "
          "n_chars_reencoded bigint")

#: Characters of a leaf in a long pre-token, and from which length on a pre-token is long.
RUN, LONG = 24, 96
#: Characters beyond a pre-token's end on which the pattern may depend.
AHEAD = 2
#: Leaves that a place of the tree may come to hold before it is built anew.
CROWDED = 512
_TWO_WHITE = re.compile(r"\s\s")
_LEAF = re.compile(r"(?<=\S)(?=[ \t\n\r\x0b\x0c])")


def groups(text: str) -> list[str]:
    """The text cut before white space that follows other characters: there the pattern splits, whatever stands around."""
    if "\0" in text or _TWO_WHITE.search(text):
        return _LEAF.split(text) if text else []
    parts = text.replace(" ", "\0 ").replace("\n", "\0\n").split("\0")  # single white space only: cut before it
    return parts if parts[0] else parts[1:]


#: Text, tokens, and whether the leaf goes on in the pre-token of the one before.
Leaf = tuple[str, int, bool]


class LeafCounter:
    """Leaves and their tokens, with bounded caches of frequent groups and pairs."""

    def __init__(self, path: str, cache: int = 400_000):
        self.coder = bpe.ByteBpe(path, cache // 2)
        self.known = shared.TwoGenerationCache(cache)
        self.cut = shared.TwoGenerationCache(cache // 2)
        self.apart: dict[tuple[int, int], bool] = {}

    def table(self, wanted: set[str]) -> dict[str, int]:
        """Tokens of each group."""
        out, missing = self.known.take(wanted)
        new = {group: len(code) // 4 for group, code in zip(missing, self.coder.encode_chunks(missing), strict=True)}
        self.known.put({group: n for group, n in new.items() if len(group) <= 64})
        out.update(new)
        return out

    def count(self, text: str) -> int:
        parts = groups(text)
        table = self.table(set(parts))
        return sum([table[p] for p in parts])

    def pretokens(self, text: str) -> list[str]:
        word = text.rstrip(".,")
        bare = word[1:] if word[:1] == " " else word
        if bare.isalpha() and max(bare) < "Ā":  # the pattern takes a run of letters whole, then the marks
            return [word, text[len(word):]] if len(word) < len(text) else [word]
        return [text[a:b] for _, (a, b) in self.coder.split(text)]

    def ids(self, pieces: list[str]) -> list[np.ndarray]:
        return [np.frombuffer(code, dtype="<u4") for code in self._codes(pieces)]

    def _codes(self, pieces: list[str]) -> list[bytes]:
        coded = [p.encode() for p in pieces]
        known = self.coder._merged(set(coded))
        return [known[c] for c in coded]

    def stay_apart(self, left: int, right: int) -> bool:
        """Whether two tokens side by side are not merged across their border."""
        key = (int(left), int(right))
        if key not in self.apart:
            if len(self.apart) > 200_000:
                self.apart.clear()
            data = self.coder.bytes_of[key[0]] + self.coder.bytes_of[key[1]]
            self.apart[key] = bpe.merge_symbols([self.coder.first[b] for b in data], self.coder.pairs) == list(key)
        return self.apart[key]

    def fits(self, left: str, right: str) -> bool:
        """Whether two neighbouring parts of one pre-token may be encoded apart."""
        a, b = self.ids([left, right])
        return self.stay_apart(a[-1], b[0])

    def runs(self, piece: str) -> list[str]:
        """A long pre-token as runs of whole tokens that may be encoded apart; the pattern goes on alike at each (no quote)."""
        blocks = [piece[k:k + RUN] for k in range(0, len(piece), RUN)]
        self.ids(blocks)  # many at once
        out: list[str] = []
        for block in blocks:
            joined = 0
            while out and (block[0] == "'" or not self.fits(out[-1], block)):
                block = out.pop() + block
                joined += 1
                if joined > 32:  # tokens that shift over long stretches: encode all, cut between tokens
                    return self._cut_between_tokens(piece)
            out.append(block)
        return out

    def _cut_between_tokens(self, piece: str) -> list[str]:
        data, [ids] = piece.encode(), self.ids([piece])
        out, a, b = [], 0, 0
        for token in ids.tolist():
            if b - a >= RUN and data[b] & 0xC0 != 0x80 and data[b:b + 1] != b"'":
                out.append(data[a:b].decode())
                a = b
            b += len(self.coder.bytes_of[token])
        return [*out, data[a:].decode()]

    def leaves(self, pieces: list[str]) -> list[Leaf]:
        """Leaves of pre-tokens."""
        parts = [(part, k > 0) for piece in pieces for k, part in enumerate(self.runs(piece) if len(piece) > LONG else [piece])]
        return [(part, len(code) // 4, inner) for (part, inner), code in zip(parts, self._codes([p for p, _ in parts]), strict=True)]

    def cut_groups(self, wanted: set[str]) -> dict[str, list[Leaf]]:
        """Leaves of each group; those not in the cache are made in one call."""
        found, missing = self.cut.take(wanted)
        pieces = [self.pretokens(g) for g in missing]
        leaves, new, k = self.leaves([p for some in pieces for p in some]), {}, 0
        for g in missing:
            a, left = k, len(g)
            while left:
                left -= len(leaves[k][0])
                k += 1
            new[g] = leaves[a:k]
        self.cut.put({g: some for g, some in new.items() if len(g) <= 64})
        found.update(new)
        return found

    def tree(self, text: str, parts: list[str] | None = None, cut: dict[str, list[Leaf]] | None = None) -> TokenTree:
        """The tree of a text; its groups and their leaves may be given."""
        parts = groups(text) if parts is None else parts
        cut = self.cut_groups(set(parts)) if cut is None else cut
        return TokenTree([leaf for g in parts for leaf in cut[g]], self)


class TokenTree:
    """The tree of one document.  Places stay; one may come to hold several leaves or none until the tree is built anew."""

    def __init__(self, leaves: list[Leaf], counter: LeafCounter):
        self.counter, self.reencoded = counter, 0
        self._build(leaves)

    def _build(self, leaves: list[Leaf]) -> None:
        self.places = [[leaf] for leaf in leaves] or [[]]
        self.size = 1 << max(0, len(self.places) - 1).bit_length()
        self.sums = np.zeros((2, 2 * self.size), dtype=np.int64)
        self.sums[0, self.size:self.size + len(leaves)] = [len(text) for text, _, _ in leaves]
        self.sums[1, self.size:self.size + len(leaves)] = [n for _, n, _ in leaves]
        k = self.size
        while k > 1:
            self.sums[:, k // 2:k] = self.sums[:, k:2 * k:2] + self.sums[:, k + 1:2 * k:2]
            k //= 2

    @property
    def n_chars(self) -> int:
        return int(self.sums[0, 1])

    @property
    def n_tokens(self) -> int:
        return int(self.sums[1, 1])

    def text(self) -> str:
        return "".join([text for place in self.places for text, _, _ in place])

    def _find(self, at: int) -> tuple[int, int, int]:
        """(place, number in it, first character) of the leaf that holds character ``at``."""
        node, before, chars = 1, 0, self.sums[0]
        while node < self.size:
            node *= 2
            if before + chars[node] <= at:
                before += int(chars[node])
                node += 1
        for k, (text, _, _) in enumerate(self.places[node - self.size]):
            if at < before + len(text):
                return node - self.size, k, before
            before += len(text)
        raise IndexError(at)

    def _leaf(self, at: int) -> Leaf:
        place, k, _ = self._find(at)
        return self.places[place][k]

    def _between(self, start: int, end: int) -> str:
        out, at = [], start
        while at < end:
            place, k, first = self._find(at)
            text = self.places[place][k][0]
            out.append(text[at - first:end - first])
            at = first + len(text)
        return "".join(out)

    def _set(self, place: int, leaves: list[Leaf]) -> None:
        self.places[place] = leaves
        node = self.size + place
        change = np.array([sum([len(text) for text, _, _ in leaves]), sum([n for _, n, _ in leaves])]) - self.sums[:, node]
        while node:
            self.sums[:, node] += change
            node //= 2

    def edit(self, start: int, end: int, new: str) -> None:
        """Replace characters ``start`` to ``end`` of the current text."""
        n = self.n_chars
        if not 0 <= start <= end <= n:
            raise ValueError(f"edit {start}:{end} of a text of {n} characters")
        if start == end and not new:
            return
        if not n:
            leaves = self.counter.leaves(self.counter.pretokens(new))
            self.reencoded += len(new)
            return self._build(leaves)
        p = self._find(max(0, min(start - AHEAD, n - 1)))[2]
        q = self._end(max(end - 1, p))
        back = on = 1
        while True:
            region = self._between(p, start) + new + self._between(end, q)
            self.reencoded += len(region)
            pieces, inner = self.counter.pretokens(region + self._between(q, min(n, q + AHEAD))), False
            done, kept = 0, []
            for piece in pieces:
                kept.append(piece[:len(region) - done])
                done += len(piece)
                if done >= len(region):
                    break
            kept = [piece for piece in kept if piece]
            if q < n and done > len(region):  # the pattern has no border there: only inside a long pre-token may it be one of tokens
                inner = self._leaf(q)[2] and self.counter.fits(kept[-1], self._leaf(q)[0])
                if not inner:
                    for _ in range(on):
                        q = self._end(q) if q < n else n
                    on *= 2
                    continue
            soft = self._leaf(p)[2]
            if soft and not (kept and self.counter.fits(self._leaf(p - 1)[0], kept[0])):
                for _ in range(back):
                    p = self._find(p - 1)[2] if p else 0
                back *= 2
                continue
            break
        leaves = self.counter.leaves(kept)
        if leaves and soft:
            leaves[0] = (*leaves[0][:2], True)
        self._replace(p, q, leaves, inner)

    def _end(self, at: int) -> int:
        place, k, first = self._find(at)
        return first + len(self.places[place][k][0])

    def _replace(self, p: int, q: int, leaves: list[Leaf], inner: bool) -> None:
        """Put ``leaves`` in place of those from ``p`` to ``q`` (borders); ``inner``: the next one goes on in their pre-token."""
        if q < self.n_chars:
            place, k, _ = self._find(q)
            self.places[place][k] = (*self.places[place][k][:2], inner)
        first, a, _ = self._find(p)
        last, b, _ = self._find(q - 1)
        head, tail = self.places[first][:a], self.places[last][b + 1:]
        if first == last:
            self._set(first, head + leaves + tail)
        else:
            self.places[first:last + 1] = [head + leaves, *[[] for _ in range(first + 1, last)], tail]
            lo, hi = self.size + first, self.size + last
            self.sums[:, lo:hi] = 0
            for node, some in ((lo, self.places[first]), (hi, tail)):
                self.sums[:, node] = sum([len(text) for text, _, _ in some]), sum([n for _, n, _ in some])
            while lo > 1:  # the sums above the whole range, level by level
                lo, hi = lo // 2, hi // 2
                self.sums[:, lo:hi + 1] = self.sums[:, 2 * lo:2 * hi + 2:2] + self.sums[:, 2 * lo + 1:2 * hi + 2:2]
        if len(self.places[first]) > CROWDED:
            self._build([leaf for place in self.places for leaf in place])


# edits of the registered query -----------------------------------------------

_MASKS = (("[email]", re.compile(r"[\w.+-]+@[\w-]+(?:\.[\w-]+)+")), ("[hex]", re.compile(r"[0-9a-f]{32,}")),
          ("[number]", re.compile(r"\d{7,}")))


def cleaning_edits(text: str) -> list[tuple[int, int, str]]:
    """Masks of addresses, hex keys and long numbers, and removal of lines equal to an earlier one; last edit first.

    Spans are disjoint: of two that overlap the one that starts first (then the longer) stays.
    """
    spans = []
    if "\n" in text:
        seen, at = set(), 0
        for line in text.split("\n"):
            if line and line in seen:
                spans.append((at - 1, at + len(line), ""))  # with the newline before it
            seen.add(line)
            at += len(line) + 1
    if "@" in text:
        spans += [(m.start(), m.end(), _MASKS[0][0]) for m in _MASKS[0][1].finditer(text)]
    for mask, pattern in _MASKS[1:]:
        spans += [(m.start(), m.end(), mask) for m in pattern.finditer(text)]
    out, reach = [], 0
    for a, b, new in sorted(spans, key=lambda s: (s[0], -s[1])):
        if a >= reach:
            out.append((a, b, new))
            reach = b
    return out[::-1]


def count_edited(docs: DataFrame, path: str, edits: Callable[[str], list[tuple[int, int, str]]] = cleaning_edits) -> DataFrame:
    """Per row: tokens of the text, and after ``edits(text)`` (applied in their order), counted through the tree.

    The tree of a text is built at its first edit; without one its root is the sum over the text's groups.
    """
    def rows(batches):
        counter = shared.resident(("leaves", path), lambda: LeafCounter(path))
        for ids, texts in batches:
            parts = [groups(t) for t in texts]
            table = counter.table(set().union(*parts))
            out: dict[str, list] = {c: [] for c in ("n_tokens", "n_edits", "n_tokens_after", "n_chars_after", "n_chars_reencoded")}
            edited = [edits(t) for t in texts]
            cut = counter.cut_groups(set().union(*[some for some, todo in zip(parts, edited, strict=True) if todo]))
            for text, some, todo in zip(texts, parts, edited, strict=True):
                n_tokens = sum([table[p] for p in some])
                found = (n_tokens, len(text), 0)
                if todo:
                    tree = counter.tree(text, some, cut)
                    for start, end, new in todo:
                        tree.edit(start, end, new)
                    found = (tree.n_tokens, tree.n_chars, tree.reencoded)
                for column, value in zip(out, (n_tokens, len(todo), *found), strict=True):
                    out[column].append(value)
            yield {"doc_id": ids, **out}

    return shared.text_map(docs, rows, SCHEMA)
