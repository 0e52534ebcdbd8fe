"""Secret scans: fixed patterns plus password guess cost of values in a credential context.

Three patterns give the base spans.  On top, every value assigned to a credential
word is judged by the fewest guesses an attacker needs: a dynamic programme finds
the cheapest segmentation into dictionary words, dates, repeats, keyboard walks
and brute-force runs (costs are log10 of guesses).  Letters that are no listed word are
priced by their pairs (``letter_pairs``), so the price grows with their number.  A value over the threshold
that no base span already covers becomes a ``guess`` span.

The programme keeps, per position, the best cost of a finished segmentation and of
one that ends inside a brute-force run, so a value of any length costs linear time.

Contexts: a credential word with ``:``, ``=`` or the like, the header ``bearer``, a
markup element named by such a word, a sentence (``the password is ...``; only values
with a digit or mark in them, as others are ordinary words), and a line of four to 24
plain words after ``passphrase:`` and its like.  A value may stand on the line after
its key, and a key may stand inside the value of another one: every value is judged,
those inside a ``guess`` span with it.  An unquoted value ends before the next
parameter of a query string or list; of a URL only the password in it is judged.

Defined cases: a null or empty text has no spans; a very long text is searched whole
(values of any length cost linear time); repeated rows repeat their result; spans of
different kinds may overlap, and of equal starts the kinds' order decides; redaction
replaces their union; an empty table gives no rows; further columns are not read by
``scan`` and pass through ``redact``.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import letter_pairs, shared

SCHEMA = ("doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, "
          "n_guess bigint, max_log10_guesses double")

# The base patterns and their least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
ASSIGN_LEAST, ACCESS_LEAST = 8, 16
KINDS = ("assign", "access", "hex", "guess")

_WORD = r"(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|credentials?|bearer|auth|(?:api|access|private|secret)[_-]?key)"
_SET = r"\s{0,8}(?::=|=>|[:=])\s{0,8}"
#: A credential word up to the value that follows it, which is only looked at: a search goes on at the value's
#: start, so that a key inside a value (a nested or chained setting) is found as well.
CONTEXT = re.compile(rf"""(?:{_WORD}["']?{_SET}|bearer\s{{1,8}})(?="[^"\n]{{6}}|'[^'\n]{{6}}|[^\s"'<>]{{6}})""", re.IGNORECASE | re.ASCII)
#: The same in a markup element's name; the value is the element's text on that line.
MARKUP = re.compile(rf"""<(?:[\w.:-]{{0,40}}[_.:-])?{_WORD}(?:\s[^<>\n]{{0,200}})?>\s{{0,8}}(?=[^\s<>][^<>\n]{{5}})""", re.IGNORECASE | re.ASCII)
#: The same in a sentence.
PROSE = re.compile(r"""\b(?:pass(?:word|wd|phrase|code|wort)|kennwort|contraseña|mot de passe|pwd|secret|token|(?:api|access|private|secret)[ _-]?key)"""
                   r"""\s{1,4}(?:is|was|ist|war|lautet|est|es)(?:\s{0,2}:)?\s{1,4}["'`]?(?=[^\s"'`<>]{6})""", re.IGNORECASE)
#: Words in a line that a phrase's name announces.
PHRASE = re.compile(rf"""(?:pass|seed|recovery)[ _-]?phrase["']?{_SET}|mnemonic["']?{_SET}""", re.IGNORECASE | re.ASCII)
_PLAIN_WORDS = re.compile(r"""["']?((?-i:[^\W\d_A-Z]{2,})(?:[ -][^\W\d_A-Z]{2,}){3,23})["']?\.?[^\S\n]*(?:\n|$)""")
#: An unquoted value ends at white space, quotes and angles, and at a separator that ends it or has a next parameter behind it.
_END = {'"': re.compile(r'["\n]'), "'": re.compile(r"['\n]"),
        "": re.compile(r"""[\s"'<>]|[&;,](?=[\s"'<>]|$|[\w.\[\]-]{1,60}=)""", re.ASCII)}
_SENTENCE_GAP = re.compile(r"""[\s"'`<>]|$""")
_TO_TAG = re.compile(r"[^<>\n]+")
_URL = re.compile(r"[A-Za-z][A-Za-z0-9+.-]{1,20}://(?:[^\s/@:]*:(?P<password>[^\s/@]+)@)?", re.ASCII)
#: One of these is in every context, in lower case.
HINTS = ("pass", "pwd", "secret", "token", "credential", "bearer", "auth", "key", "phrase", "mnemonic", "kennwort", "contraseña")

#: Log10 of the guesses from which a value counts as a secret.
THRESHOLD = 10.0
SEGMENT = 0.5  # of one more segment
KNOWN_WORD = 5.5  # an ordinary word that the list of password words lacks

#: Common password words, most common first; a word's place is its number of guesses.
WORDS = """password qwerty admin welcome login letmein dragon monkey football iloveyou master sunshine princess
baseball shadow superman michael jordan trustno charlie summer winter spring autumn secret test guest root user
changeme default hello love money freedom whatever ninja mustang access batman flower starwars computer internet
server database example sample dummy temp null none true false token value string your here replace enter insert
company office house world earth happy lucky magic power king queen angel diamond gold silver blue green black
white red yellow orange purple tiger lion eagle wolf bear cat dog horse bird fish apple banana cherry lemon""".split()
_WORD_COST = {w: math.log10(k + 2) for k, w in enumerate(WORDS)}
_LONGEST = max(map(len, WORDS))
_PLAIN = str.maketrans("4@3107$5", "aaeiotss")

_ROWS = (("1234567890-=", 0.0), ("qwertyuiop[]", 0.5), ("asdfghjkl;'", 0.75), ("zxcvbnm,./", 1.25))
_KEY = {c: (x + shift, y) for y, (row, shift) in enumerate(_ROWS) for x, c in enumerate(row)}
_NEAR = {(a, b) for a, (x, y) in _KEY.items() for b, (u, v) in _KEY.items() if a != b and abs(y - v) <= 1 and abs(x - u) <= 1}
_DATE = re.compile(r"(?:19|20)\d\d(?:([-/._]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01]))?"
                   r"|(?:0?[1-9]|[12]\d|3[01])([-/._])(?:0?[1-9]|1[0-2])\2(?:(?:19|20)?\d\d)"
                   r"|(?:0[1-9]|[12]\d|3[01])(?:0[1-9]|1[0-2])(?:19|20)\d\d", re.ASCII)

_RUN = re.compile(r"[A-Za-z]?[a-z]{2,}|[A-Z]{3,}")


def _char_cost(c: str) -> float:
    if c.isdigit():
        return 1.0
    return 1.415 if c.isalpha() and c.isascii() else 1.52 if c.isascii() else 2.0


def _word_segments(run: str, at: int) -> Iterator[tuple[int, int, float]]:
    """A run of letters, its beginnings and its ends as words: letter pair by letter pair, or flat if the run is known.

    A price that grows with the length keeps letters without sense as dear as brute force.
    """
    word, n = run.lower(), len(run)
    extra = 0.3 if run[0].isupper() else 0.0
    if word in letter_pairs.KNOWN:
        yield at, at + n, KNOWN_WORD + extra
    pair = letter_pairs.PAIR
    steps = [0.0, *accumulate(pair[word[k:k + 2]] for k in range(n - 1))]  # to letter k from the first one
    for k in range(3, n + 1):
        yield at, at + k, pair["^" + word[0]] + steps[k - 1] + extra
        if k < n:
            yield at + n - k, at + n, pair["^" + word[n - k]] + steps[-1] - steps[n - k] + (0.3 if run[n - k].isupper() else 0.0)


def _segments(value: str) -> Iterator[tuple[int, int, float]]:
    """(start, end, cost) of every word, date, repeat and keyboard walk, in order of the end."""
    n, low = len(value), value.lower()
    if len(low) != n:  # a letter whose lower case is longer
        low = value
    plain = low.translate(_PLAIN)
    found: list[tuple[int, int, float]] = []
    for i in range(n):
        for j in range(i + 3, min(n, i + _LONGEST) + 1):
            cost = _WORD_COST.get(low[i:j])
            if cost is None and (cost := _WORD_COST.get(plain[i:j])) is not None:
                cost += 0.6
            if cost is not None:
                found.append((i, j, cost + (0.0 if value[i:j] == low[i:j] else 0.3)))
        if value[i].isdigit() and (m := _DATE.match(value, i)):
            found.append((i, m.end(), 2.0 if m.end() - i == 4 else 4.2 + (0.6 if not m[0].isdigit() else 0.0)))
    for m in _RUN.finditer(value):
        found += _word_segments(m[0], m.start())
    for unit in range(1, 9):
        run = 0
        for k in range(unit, n):
            run = run + 1 if value[k] == value[k - unit] else 0
            if run >= unit and run + unit >= 3:
                start = k - run - unit + 1
                found.append((start, k + 1, sum(map(_char_cost, value[start:start + unit])) + math.log10(run / unit + 1)))
    start, turns, last = 0, 0, None
    for k in range(1, n + 1):
        step = None
        if k < n and (low[k - 1], low[k]) in _NEAR:
            (x, y), (u, v) = _KEY[low[k - 1]], _KEY[low[k]]
            step = (u - x > 0, v - y)
        if step is None:
            start, turns, last = k, 0, None
        else:
            turns += step != last
            last = step
            if k + 1 - start >= 4:
                found.append((start, k + 1, math.log10(47.0 * (k + 1 - start)) + turns * math.log10(4.6)))
    return iter(sorted(found, key=lambda s: s[1]))


def log10_guesses(value: str) -> float:
    """Log10 of the fewest guesses over all segmentations of the whole value."""
    n = len(value)
    best, brute = [0.0] + [math.inf] * n, [math.inf] * (n + 1)
    segments = _segments(value)
    nxt = next(segments, None)
    for k in range(1, n + 1):
        c = _char_cost(value[k - 1])
        brute[k] = min(brute[k - 1], best[k - 1] + SEGMENT) + c
        best[k] = brute[k]
        while nxt is not None and nxt[1] == k:
            best[k] = min(best[k], best[nxt[0]] + SEGMENT + nxt[2])
            nxt = next(segments, None)
    return best[n]


def _assigned(text: str) -> Iterator[tuple[int, int]]:
    """Values of ``CONTEXT``; of an unquoted value that is itself a key with a value, only the inner value counts."""
    end = 0  # of the last unquoted stretch: the values inside it share it
    matches = CONTEXT.finditer(text)
    m = next(matches, None)
    while m is not None:
        a, m = m.end(), next(matches, None)
        if text[a] in "\"'":
            stop = _END[text[a]].search(text, a + 1)
            if stop and stop[0] == text[a]:
                yield a + 1, stop.start()
            continue
        if a >= end:
            stop = _END[""].search(text, a)
            end = stop.start() if stop else len(text)
        if m is None or m.start() != a:
            yield a, end


def _in_sentence(text: str) -> Iterator[tuple[int, int]]:
    """Values of ``PROSE`` that hold a digit or a mark, without the sentence's own marks behind them."""
    for m in PROSE.finditer(text):
        value = text[m.end():_SENTENCE_GAP.search(text, m.end()).start()].rstrip(".,;:)]")
        if not all(c.isalpha() or c in "-'’" for c in value):
            yield m.end(), m.end() + len(value)


def context_values(text: str) -> list[tuple[int, int]]:
    """(start, end) of every value in a credential context, quotes left out, in order of the start, longer ones first."""
    found = [*_assigned(text), *_in_sentence(text)]
    if "<" in text:
        found += [(m.end(), m.end() + len(_TO_TAG.match(text, m.end())[0].rstrip())) for m in MARKUP.finditer(text)]
    found += [words.span(1) for m in PHRASE.finditer(text) if (words := _PLAIN_WORDS.match(text, m.end()))]
    out = []
    for a, b in found:
        url = _URL.match(text, a, b)
        if url is None:
            out.append((a, b))
        elif url["password"]:
            out.append(url.span("password"))
    return sorted(out, key=lambda s: (s[0], -s[1]))


def find(text: str) -> tuple[list[tuple[int, int, str]], float | None]:
    """All spans as (start, end, kind) in order, and the largest guess cost of a context value."""
    low = text.lower()
    spans: list[tuple[int, int, str]] = []
    if "AKIA" in text:
        spans += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    spans += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    top = None
    if any(h in low for h in HINTS):
        spans += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
        base = sorted((a, b) for a, b, _ in spans)
        starts = [a for a, _ in base]
        reach = [0]
        for _, b in base:
            reach.append(max(reach[-1], b))
        guessed = 0  # the end of the guess spans so far: a value nested in one is found with it
        for a, b in context_values(text):
            if b <= guessed:
                continue
            cost = log10_guesses(text[a:b])
            top = cost if top is None else max(top, cost)
            if cost >= THRESHOLD and reach[bisect_right(starts, a)] < b:
                spans.append((a, b, "guess"))
                guessed = b
    spans.sort(key=lambda s: (s[0], KINDS.index(s[2])))
    return spans, top


def _joined(spans) -> str:
    return ",".join([f"{kind}:{a}:{b}" for a, b, kind in spans])


def scan(docs: DataFrame) -> DataFrame:
    """Per row: counts by kind, the digest of the base spans, all spans, and the largest guess cost (null: no context)."""
    def rows(batches):
        for ids, texts in batches:
            out: dict[str, list] = {c: [] for c in ("n_assign", "n_access", "n_hex", "n_guess", "base_sha256", "spans",
                                                    "max_log10_guesses")}
            for text in texts:
                spans, top = find(text)
                kinds = [s[2] for s in spans]
                for kind in KINDS:
                    out["n_" + kind].append(kinds.count(kind))
                base = _joined([s for s in spans if s[2] != "guess"])
                out["base_sha256"].append(hashlib.sha256(base.encode()).hexdigest())
                out["spans"].append(_joined(spans))
                out["max_log10_guesses"].append(top)
            yield {"doc_id": ids, **out}

    return shared.text_map(docs, rows, SCHEMA)


def redacted(text: str, mark: str = "[SECRET]") -> str:
    """The text with the union of its spans replaced, each stretch by one mark."""
    out, at, end = [], 0, -1
    for a, b, _ in find(text)[0]:
        if a > end:
            out += [text[at:a], mark]
        end = max(end, b)
        at = end
    return "".join([*out, text[at:]]) if out else text


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """All rows and columns of ``docs`` with secrets replaced in ``text``; ``n_chars``, if there, follows.

    A null text stays null and its ``n_chars`` as it was.
    """
    schema = docs.schema
    at = schema.fieldNames().index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, texts in shared.text_slices(b, at):
                there = part.column(at).is_valid().to_pylist()
                new = [redacted(t, mark) if ok else None for t, ok in zip(texts, there, strict=True)]
                columns = list(part.columns)
                columns[at] = pa.array(new, type=b.schema.field(at).type)
                yield pa.RecordBatch.from_arrays(columns, schema=b.schema)

    out = shared.map_arrow(docs, run, schema)
    if "n_chars" in schema.fieldNames():
        kind = schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars"))
                             .otherwise(F.length("text").cast(kind)))
    return out
