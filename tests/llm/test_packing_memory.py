"""Pieces that a worker lets go of are encoded again to the same ids."""

import random

import brute
import public_tokenizers

from wattframe.llm import packing


def test_ids_don_t_depend_on_what_is_remembered(monkeypatch):
    chance = random.Random(2)
    words = ["".join(chance.choices("abcdeXYé1'.,-", k=chance.randint(1, 7))) for _ in range(300)]
    texts = [" ".join(chance.choices(words[:20] + words, k=chance.randint(0, 60))) for _ in range(200)]
    for most in (1_000_000, 40, 1):
        monkeypatch.setattr(packing, "MOST_KNOWN", most)
        encoder = packing.Encoder(public_tokenizers.path("word_bpe_49k.json"))
        for start in range(0, len(texts), 10):
            some = texts[start:start + 10]
            found = list(encoder.encode([t.encode() for t in some]))
            assert [x.tolist() for x in found] == [brute.packed_ids(t) for t in some]
            if most == 40:
                assert len(encoder.known) < 40 + 700
