"""Bounds of memory and work inside one process."""

from __future__ import annotations

import random
import tracemalloc

import numpy as np

from rivulet.llm import language_id, packing


def _byte_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def test_op2_encodes_whole_texts_at_once():
    from tokenizers import Tokenizer

    tok, lib = packing.Tokens(_byte_file()), Tokenizer.from_file(_byte_file())
    tok.pieces = None  # no text of usual runs is cut by Python's expression
    rng = random.Random(7)
    signs = [" ", " ", "\n", "\t", "　", "\x1c", "\x85", "a", "é", "中", "²", "1", "_", "'s", "don't", "<|endoftext|>", "😀", "."]
    for _ in range(2000):
        text = "".join(rng.choice(signs) for _ in range(rng.randrange(14)))
        assert tok.ids(text) == np.array(lib.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_op2_very_long_runs():
    from tokenizers import Tokenizer

    tok, lib = packing.Tokens(_byte_file()), Tokenizer.from_file(_byte_file())
    for text in (" " * 1_200_000 + "x", "a" + "\n" * 1_200_000 + " b"):
        assert tok.ids(text) == np.array(lib.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_training_keeps_no_subwords_of_all_kept_back_texts():
    """The texts kept back are scored batch after batch: their subwords' rows together would be about 100 MB here."""
    rng = random.Random(3)
    texts = ["".join(chr(rng.randrange(97, 123)) for _ in range(2000)) for _ in range(600)]
    tracemalloc.start()
    language_id.train(texts, ["a", "b"] * 300, min_steps=1)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 90e6, peak
