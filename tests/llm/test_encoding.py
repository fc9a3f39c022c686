from __future__ import annotations

import random

import numpy as np
import pytest
from tokenizers import Tokenizer, models, normalizers, pre_tokenizers

from lumenloom.llm import encoding
from lumenloom.llm import grammar_store as gs


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(encoding.default_path())


def _same(mine, tokenizer, texts):
    ids, n = mine.encode(texts)
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert n.tolist() == [len(w) for w in want] and ids.tolist() == [x for w in want for x in w]


def test_new_pieces_reach_the_library_together(tokenizer):
    """One text of the library for many new pieces: each alone costs more than its encoding."""
    r = random.Random(2)
    words = ["".join(r.choices("abcdefghijklmnop", k=r.randint(3, 9))) for _ in range(3000)]
    texts = ["\n".join(" ".join(words[k : k + 10]) + r.choice(["", ".", "?!", "***"]) for k in range(i, i + 100, 10)) for i in range(0, 3000, 100)]
    mine, given = encoding.Encoder(encoding.default_path()), []
    library = mine._library
    mine._library = lambda some: given.append(len(some)) or library(some)
    _same(mine, tokenizer, texts)
    # only the pieces beside the line end, which is one itself, go alone
    assert mine.known.size > 2900 and sum(given) <= encoding.JOINED + mine.known.size / encoding.JOINED + 1


def test_pieces_that_could_join_stay_apart(tokenizer):
    """White space of all kinds, signs, marks and parts of an added token, as one text or many."""
    r = random.Random(7)
    some = ["a", "Zq", " ", " ", " w", "\n", ".", "...", "!", "é", "×", "÷", "1", "'t", "'", "\t", "\r", "\x1c", "\x85", "\xa0", " ", "　", "中", "***", "ɏ", "ɐ", "’", "😀", "<|endoftext|>", "<|endof", "text|>"]
    mine = encoding.Encoder(encoding.default_path())
    for n in (1, 2, 500):
        for _ in range(20):
            _same(mine, tokenizer, ["".join(r.choices(some, k=r.randrange(12))) for _ in range(n)])


def test_a_normalizer_that_changes_lengths(tmp_path):
    """Places in the joined text cannot be told then; pieces are encoded one by one."""
    alphabet = sorted(pre_tokenizers.ByteLevel.alphabet())
    plain = Tokenizer(models.BPE({c: i for i, c in enumerate(alphabet)}, []))
    plain.normalizer = normalizers.Replace("a", "bcd")
    plain.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False)
    plain.save(path := str(tmp_path / "plain.json"))
    _same(encoding.Encoder(path), plain, ["a banana, an apple.", "", "no\nsuch a\nthing a", "x"])


@pytest.mark.parametrize("crowded", [False, True])
def test_numbers_of_hashes(crowded):
    """Found by number, absent ones too, also where all hashes want one slot and after the table grew."""
    r = np.random.default_rng(1)
    n = 600 if crowded else 150_000
    keys = r.permutation(np.arange(2 * n, dtype=np.uint64) if crowded else np.unique(r.integers(0, 1 << 64, 2 * n, dtype=np.uint64)))
    known, at = encoding.Numbers(), 0
    assert (known.find(keys) == -1).all()
    for size in (1, n // 3, n - 1 - n // 3):
        known.add(keys[at : at + size])
        at += size
        assert known.size == at
        assert (known.find(keys[:at]) == np.arange(at)).all() and (known.find(keys[at:]) == -1).all()
    assert known.find(keys[:0]).size == 0 and known.keys.size * 5 >= known.size * 8


def test_rules_are_expanded_once(monkeypatch):
    """With more symbols than rules, only the rules go through the rounds of replacing; nested ones come out whole."""
    left, right = np.array([1, 10, 11, 2], np.uint32), np.array([2, 3, 11, 12], np.uint32)
    spelled = {10: [1, 2], 11: [1, 2, 3], 12: [1, 2, 3] * 2, 13: [2, *[1, 2, 3] * 2]}
    steps, step = [], gs._step
    monkeypatch.setattr(gs, "_step", lambda s, *rest: steps.append(s.size) or step(s, *rest))
    for n in (0, 1, 4, 5, 1000):
        symbols = np.random.default_rng(n).integers(0, 14, n).astype(np.uint32)
        out = gs.expand(symbols, left, right, 10)
        assert out.tolist() == [x for s in symbols.tolist() for x in spelled.get(s, [s])] and out.dtype == np.uint32
    assert max(steps) == left.size
    assert gs.expand(np.array([3, 1], np.uint32), left[:0], right[:0], 10).tolist() == [3, 1]
