import os
import random
import tempfile

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from docpulse.llm.bpe import Encoder, WordBpe, encode
from docpulse.llm.lexicon import Lexicon, build

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", " ", "Hello, World! it's we'll 12345", "<|startoftext|>Hi<|endoftext|> <|ENDOFTEXT|>", "ΑΣ ΟΔΟΣ", "İstanbul ǅ ẞ ß", "éà x",
       "a\x1cb\x1f c\x85d\xa0e f", "日本語 ١٢٣ ½ ² \U0001f600x", "'S 'T don'T", "a" * 5000, "ab" * 3000 + "!" * 300, "x\x00y", "﻿a", "z" * 199 + " " + "z" * 202]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_odd_texts(library):
    encoder = Encoder(WordBpe(open(PATH, encoding="utf-8").read()), None)
    r = random.Random(3)
    chars = [chr(i) for i in range(0x20, 0x250)] + list("́̈Σςİẞ\n\t\x1c‘—")
    for text in ODD + ["".join(r.choice(chars) for _ in range(r.randint(0, 60))) for _ in range(3000)]:
        ids = library.encode(text, add_special_tokens=False).ids
        assert encoder.encode(text) == ids
        assert encoder.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_merge_of_long_words():
    bpe = WordBpe(open(PATH, encoding="utf-8").read())
    r = random.Random(4)
    for n in (1, 2, 3, 40, 190):
        word = bytes(r.choice(b"aeinrst") for _ in range(n))
        symbols = [bpe.inner[b] for b in word[:-1]] + [bpe.last[word[-1]]]
        assert bpe.merge(word) == bpe._merge_long(symbols)


def test_merging_many_words():
    bpe = WordBpe(open(PATH, encoding="utf-8").read())
    r = random.Random(6)
    words = list({"".join(r.choice("aeinrsté") for _ in range(r.randint(1, 30))).encode() for _ in range(3000)}) + [b"x" * 60]
    assert bpe.merge_many(words) == {w: bpe.merge(w) for w in words}


def test_memory_of_chunks(library, monkeypatch):
    monkeypatch.setattr("docpulse.llm.bpe.KEPT", 20)
    encoder = Encoder(WordBpe(open(PATH, encoding="utf-8").read()), None)
    r = random.Random(7)
    for _ in range(40):
        text = " ".join("".join(r.choice("abc,") for _ in range(r.choice((2, 3, 90)))) for _ in range(30))
        assert encoder.encode_all([text, text])[1] == library.encode(text, add_special_tokens=False).ids
    assert max(map(len, encoder.seen)) <= 90


def test_table(docs, library):
    rows = [*enumerate(ODD), (None, None), (3, ODD[3]), (3, "other")]
    for words in (0, 5, 1000):
        got = encode(docs(rows, ids="clash", decoded="clash"), PATH, lexicon_words=words).collect()
        want = []
        for i, t in rows:
            ids = library.encode(t or "", add_special_tokens=False).ids
            want.append((i, ids, library.decode(ids, skip_special_tokens=False)))
        assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_empty_table(docs):
    assert encode(docs([]), PATH).count() == 0


def test_lexicon():
    r = random.Random(5)
    entries = {bytes(r.choice(b"abc") for _ in range(r.randint(1, 7))): [r.randrange(1 << 20) for _ in range(r.randint(1, 4))] for _ in range(600)}
    for chosen in (entries, {}, {b"x": [1]}, {b"a": [1], b"ab": [2], b"b": [3]}):
        path = os.path.join(tempfile.mkdtemp(prefix="run-"), "lexicon")
        with open(path, "wb") as file:
            file.write(build(chosen.items()))
        lexicon = Lexicon(path)
        assert all(lexicon.get(w) == ids for w, ids in chosen.items())
        assert all(lexicon.get(w) is None for w in (b"", b"zz", b"abcabcabc", *entries.keys() - chosen.keys()))


def test_suffixes_are_shared():
    few = build([(bytes([a]) + b"ation", [1]) for a in b"n"])
    many = build([(bytes([a]) + b"ation", [1]) for a in b"nmrst"])
    assert len(many) - len(few) < 5 * 5 * 4 + 5 * 4
