import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from snapmart.llm import bpe, packing, shared, token_counts

from . import data

BYTE, WORD = shared.vocabulary("byte_bpe_50k.json"), shared.vocabulary("word_bpe_49k.json")
PARTS = ["a", "B", "the", "Tion", " ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", "é", "É", "ß", "ñ", "'s", "'ll", "9", "123", ".", ",",
         "!!", "<|endoftext|>", "<|", "你", "😀", "́", "ſ", "İ", "ª", "٣", "¨", "\r\n", "Σ"]


def texts(n, seed, size=14):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, size))) for _ in range(n)]


def ids_of(code):
    return np.frombuffer(code, dtype="<u4").tolist()


def test_encoding_and_decoding_equal_the_library():
    library, own = Tokenizer.from_file(BYTE), bpe.ByteBpe(BYTE)
    some = texts(1500, 1)
    for text, code in zip(some, own.encode_many(some), strict=True):
        want = library.encode(text, add_special_tokens=False).ids
        assert ids_of(code) == want, text
        assert own.decode(code) == library.decode(want, skip_special_tokens=False)


def test_long_words_and_bounded_caches():
    library, own = Tokenizer.from_file(BYTE), bpe.ByteBpe(BYTE, cache=8)
    rng = random.Random(3)
    some = ["".join(rng.choice("abcdeth") for _ in range(n)) for n in (33, 34, 64, 65, 3000)] + ["a b c d e f g h i j k l"] * 3
    for text in some:
        assert ids_of(own.encode(text)) == library.encode(text).ids
    assert len(own.chunks.young) + len(own.chunks.old) <= 24


def test_one_by_one_and_many_at_once_agree():
    own = bpe.ByteBpe(BYTE)
    rng = random.Random(5)
    for width in bpe.WIDTHS:
        words = [bytes(rng.choice(b"abehinorst ") for _ in range(rng.randint(2, width + 1))) for _ in range(200)]
        many = bpe.merge_many(words, own.letters, own.table, width)
        assert [ids_of(m) for m in many] == [bpe.merge_symbols([own.first[b] for b in w], own.pairs) for w in words]


def test_invalid_bytes_decode_like_the_library():
    library, own = Tokenizer.from_file(BYTE), bpe.ByteBpe(BYTE)
    rng = random.Random(6)
    for _ in range(200):
        ids = [rng.randrange(50257) for _ in range(rng.randint(0, 6))]
        assert own.decode(np.array(ids, dtype="<u4").tobytes()) == library.decode(ids, skip_special_tokens=False)


def test_word_ids_equal_the_library():
    library, own = Tokenizer.from_file(WORD), packing.WordIds(WORD)
    some = texts(1500, 2)
    for text, code in zip(some, own.encode_many(some), strict=True):
        assert ids_of(code) == library.encode(text, add_special_tokens=False).ids, text


def test_operator_on_hard_rows(spark):
    docs = data.with_clashes(data.hard_docs(spark))
    library = Tokenizer.from_file(BYTE)
    got = sorted((r["doc_id"] or -1, r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in bpe.encode_decode(docs, BYTE).collect())
    want = []
    for i, text, *_ in data.hard_rows():
        ids = library.encode(text or "", add_special_tokens=False).ids
        want.append((i or -1, len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(),
                     hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert got == sorted(want)
    assert bpe.encode_decode(docs.limit(0), BYTE).count() == 0


def test_edits_through_the_tree_equal_counting_anew():
    counter, library = token_counts.LeafCounter(BYTE), Tokenizer.from_file(BYTE)
    library.encode_special_tokens = True
    rng = random.Random(7)
    for text in texts(400, 8, 20):
        tree = counter.tree(text)
        assert tree.n_tokens == counter.count(text)
        now = text
        for _ in range(4):
            a = rng.randint(0, len(now))
            b = rng.randint(a, min(len(now), a + 6))
            new = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 3)))
            tree.edit(a, b, new)
            now = now[:a] + new + now[b:]
            assert (tree.text(), tree.n_chars, tree.n_tokens) == (now, len(now), len(library.encode(now).ids))


def test_an_edit_of_a_long_text_reencodes_its_surroundings_only():
    counter = token_counts.LeafCounter(BYTE)
    text = " ".join(["river", "stone", "cloud"] * 20_000)
    tree = counter.tree(text)
    tree.edit(100_000, 100_010, "x")
    assert tree.reencoded < 40


ALPHABETS = ["的一是在不了有和人这中大为上个国", "abcdefghijklmnopqrstuvwxyz", "aab", "!?'-s", " \t\n\xa0", "0123456789", "あいうえおカキクケコ漢字", "é́ßñ😀", "的a1 '"]


def test_edits_inside_long_pretokens_equal_a_recount(monkeypatch):
    monkeypatch.setattr(token_counts, "RUN", 6)
    monkeypatch.setattr(token_counts, "LONG", 10)
    monkeypatch.setattr(token_counts, "CROWDED", 8)
    counter, library = token_counts.LeafCounter(BYTE), Tokenizer.from_file(BYTE)
    library.encode_special_tokens = True
    rng = random.Random(17)
    for k in range(300):
        letters = ALPHABETS[k % len(ALPHABETS)]
        now = "".join(rng.choice(letters) for _ in range(rng.randint(0, 120)))
        tree = counter.tree(now)
        for _ in range(8):
            a = rng.randint(0, len(now))
            b = rng.randint(a, min(len(now), a + rng.choice([0, 1, 5, 40])))
            new = "".join(rng.choice(rng.choice([letters, *ALPHABETS])) for _ in range(rng.choice([0, 1, 3, 30])))
            tree.edit(a, b, new)
            now = now[:a] + new + now[b:]
            assert (tree.text(), tree.n_chars, tree.n_tokens) == (now, len(now), len(library.encode(now).ids)), (k, now)


@pytest.mark.parametrize("letters", [ALPHABETS[0], ALPHABETS[1], ALPHABETS[6]])
def test_reencoded_characters_grow_with_the_edits_in_unspaced_text(letters):
    counter, rng, per_edit = token_counts.LeafCounter(BYTE), random.Random(5), []
    for size in (4_000, 16_000):
        text = "".join(rng.choice(letters) for _ in range(size))
        tree = counter.tree(text)
        for at in range(size - 20, 0, -40):
            tree.edit(at, at + 2, "x")
        assert tree.n_tokens == counter.count(tree.text())
        per_edit.append(tree.reencoded / (size / 40))
    assert max(per_edit) < 400 and per_edit[1] < 1.2 * per_edit[0]


def test_edit_counts_on_documents(spark):
    library = Tokenizer.from_file(BYTE)
    library.encode_special_tokens = True
    docs = spark.read.parquet(f"{data.SMALL}/documents.parquet").select("doc_id", "text").unionByName(
        data.hard_docs(spark).where("doc_id is not null").selectExpr("doc_id + 1000000 as doc_id", "text")).distinct()
    text_of = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    rows = token_counts.count_edited(docs, BYTE).collect()
    assert len(rows) == len(text_of)
    for r in rows:
        text = text_of[r["doc_id"]]
        edits = token_counts.cleaning_edits(text)
        after = text
        for a, b, new in edits:
            after = after[:a] + new + after[b:]
        assert (r["n_tokens"], r["n_edits"], r["n_tokens_after"], r["n_chars_after"]) == (
            len(library.encode(text).ids), len(edits), len(library.encode(after).ids), len(after))
