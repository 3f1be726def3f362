"""Words are encoded one by one."""

import random

import numpy as np
from tokenizers import Tokenizer

from demandloom.llm import tokens


def test_ids_of_words_are_those_of_whole_texts():
    whole, encode, draw = Tokenizer.from_file(tokens.TOKENIZER), tokens.Encoder(tokens.TOKENIZER), random.Random(5)
    plain = [c for c in map(chr, (*range(32, 127), *range(0xC0, 0x100))) if c not in "<'×÷"] + ["\n", "\t", "\r"]
    other = [*map(chr, range(0x180)), *"<|endoftext|>'s're", "<|endoftext|>", "'ll", "é", "İ", "Σ", "中", "٣", "½", " ", "　", "\U0001f600"]
    texts = ["".join(draw.choices(signs, k=draw.randint(0, 14))) for signs in (plain, other) for _ in range(2000)]
    assert [list(np.frombuffer(x, "<u4")) for x in encode(texts)] == [whole.encode(t, add_special_tokens=False).ids for t in texts]


def test_plain_words_need_the_model_alone():
    """The whole tokenizer takes several times as long for a new word."""
    encode = tokens.Encoder(tokens.TOKENIZER)
    texts = ["The thonly, État onenti!! 42 a_b", None, "", "the THE"]
    want = [np.array(encode.tokenizer.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    encode.tokenizer = None
    assert list(encode(texts)) == want
    assert {"the", "thonly", "état", "!!", "4"} <= set(encode.known) and "The" not in encode.known


def test_parts_are_remembered_in_two_generations(monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 2)
    known = tokens.Remembered(lambda k: k.encode())
    assert [known[k] for k in "abc"] == [b"a", b"b", b"c"]
    known.age()
    assert not len(known) and known["a"] == b"a" and list(known) == ["a"]
