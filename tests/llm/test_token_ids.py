"""Token ids, grammar files and packing: against the library, exact round trips and plain DP."""

import functools
import os
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import AddedToken, Tokenizer

from hitledger.llm import grammar, packing
from hitledger.llm.token_ids import Encoder, encoder
from hitledger.llm.words import text_slices

FILES = ["byte_bpe_50k.json", "word_bpe_49k.json"]
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
_made = {}


def both(name):
    if name not in _made:
        plain = Tokenizer.from_file(public_tokenizers.path(name))
        plain.encode_special_tokens = True
        _made[name] = Encoder(public_tokenizers.path(name)), plain
    return _made[name]


ODD = ["", " ", "a  b\n\n c", "  lead", "trail  ", "x  y", "　 z", "e ́x", "<|endoftext|> don't 'S", "\x1c a \x1d\x1e b", "\x85 a  b", "12 3.4 --- !!", "ΑΣ ΣΑΣ. ǅ İ", "日本 語 。"]


@pytest.mark.parametrize("name", FILES)
@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(ODD), st.text(st.sampled_from(" \t\nab'sé ́.,1Σ \x1c語-"), max_size=30)), max_size=6))
def test_ids_are_the_librarys(name, texts):
    ours, plain = both(name)
    want = [x.ids for x in plain.encode_batch(texts, add_special_tokens=False)]
    got = []
    for _, _, data, offsets in text_slices(pa.array(texts, pa.string()), limit=40):
        ids, count = ours.encode(data, offsets)
        got += [x.tolist() for x in np.split(ids, np.cumsum(count)[:-1])]
    assert got == want


SPECIAL = ["<|endoftext|>", "<|startoftext|>", "<|END", "oftext|>", " ", "  ", "\n", "a", " b", "é", "\u3000", "ΑΣ", "'s", "<|", "12"]


def test_units_are_told_apart_without_offsets(monkeypatch):
    """Units' ids from one call on joined texts that asks for no offsets, which took half of the encoding's time."""
    from hitledger.llm import token_ids

    class Watched:
        def __init__(self, real):
            self.real, self.calls = real, []

        def __getattr__(self, name):
            self.calls.append(name)
            return getattr(self.real, name)

    texts = [f" wörd{i}x{i * i}, é{i} <|endoftext|>語{i}.\n\n x" for i in range(700)]
    ours = Encoder(public_tokenizers.path(FILES[0]), special=True)
    ours.tokenizer = watched = Watched(ours.tokenizer)
    monkeypatch.setattr(token_ids, "JOINED", 100)
    assert split_ids(ours, texts) == library(texts, public_tokenizers.path(FILES[0]))
    assert set(watched.calls) == {"encode_batch_fast"}


unchanged = functools.cache(Tokenizer.from_file)


def library(texts, path):
    return [x.ids for x in unchanged(path).encode_batch(texts, add_special_tokens=False)]


def split_ids(ours, texts):
    got = []
    for _, _, data, offsets in text_slices(pa.array(texts, pa.string()), limit=40):
        ids, count = ours.encode(data, offsets)
        got += [x.tolist() for x in np.split(ids, np.cumsum(count)[:-1])]
    return got


@pytest.mark.parametrize("name", FILES)
@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from(SPECIAL), max_size=12).map("".join), min_size=1, max_size=4))
def test_special_tokens_are_the_librarys(name, texts):
    path = public_tokenizers.path(name)
    assert split_ids(encoder(path), texts) == library(texts, path)


@pytest.mark.parametrize("name", FILES)
def test_added_tokens_that_take_in_space(name, tmp_path):
    plain = Tokenizer.from_file(public_tokenizers.path(name))
    plain.add_tokens([AddedToken("<two words>", normalized=False), AddedToken("<r>", rstrip=True, lstrip=True, normalized=False)])
    path = str(tmp_path / name)
    plain.save(path)
    texts = ["a <two words> b", "a  <r>  b\n", "", "plain words"]
    assert split_ids(encoder(path), texts) == library(texts, path)


def test_special_tokens_in_pieces_and_shards(spark):
    rows = [(1, "a <|endoftext|> b"), (2, "<|startoftext|>x<|endoftext|>"), (3, "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for name, end, made in (
        (FILES[0], 0, lambda path: grammar.read_shards(grammar.write_shards(docs, path, end_id=0)).collect()),
        (FILES[1], 2, lambda path: packing.pack(docs, path, end_id=2, width=1024).collect()),
    ):
        path = public_tokenizers.path(name)
        want = {(d, crc(ids + [end])) for (d, _), ids in zip(rows, library([t for _, t in rows], path))}
        assert {(r.doc_id, r.ids_crc32) for r in made(path)} == want


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), min_size=1, max_size=60), min_size=1, max_size=30))
def test_grammar_round_trip(docs):
    docs = docs * 5
    ids = np.array([i for d in docs for i in d], np.uint32)
    bounds = np.concatenate(([0], np.cumsum([len(d) for d in docs])))
    shard = grammar.Shard(b"".join(grammar.pack_shard([None, *range(1, len(docs))], ids, bounds, 4)))
    assert shard.doc_ids[0] is None and shard.doc_ids[1:] == list(range(1, len(docs)))
    for i, d in enumerate(docs):
        assert shard.decode(i, i + 1).tolist() == d
        for a in range(0, len(d), 7):
            assert shard.stretch(i, a, min(a + 5, len(d))).tolist() == d[a : a + 5]
    assert shard.decode(0, len(docs)).tolist() == ids.tolist()


def test_grammar_finds_repeats():
    ids = np.tile(np.arange(50, dtype=np.uint32), 200)
    symbols, _, rules = grammar.compress(ids, np.array([0, len(ids)]), 100)
    assert len(symbols) + 2 * len(rules) < len(ids) / 10


def plain_cost(at, penalty, width):
    cost = [0.0]
    for j in range(1, len(at)):
        best = float("inf")
        for i in range(j):
            n = at[j] - at[i]
            if n <= width:
                best = min(best, cost[i] + (0 if n in packing.POWERS and n < width else width - n))
        cost.append(best + penalty[j] + packing.WINDOW)
    return cost[-1]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.sampled_from([1, 2, 30, 64, 128, 255, 256, 300, 512]), st.sampled_from([0.0, 16.0, 256.0])), min_size=1, max_size=40))
def test_cuts_cost_the_least(steps):
    at = np.concatenate(([0], np.cumsum([s for s, _ in steps])))
    penalty = np.array([0.0, *(p for _, p in steps)])
    cuts, cost = packing.best_cuts(at, penalty, 1024)
    assert cost == pytest.approx(plain_cost(at.tolist(), penalty.tolist(), 1024))
    assert cuts[0] == 0 and cuts[-1] == len(at) - 1
    assert (np.diff(at[cuts]) <= 1024).all()


LONG = " ".join(f"word{i % 97} is here." if i % 9 else "x" * 50 for i in range(3000))
ROWS = [(3, "B two. Three!"), (1, "One."), (None, "no id"), (7, None), (8, ""), (9, LONG), (9, "same id"), (9, "same id"), (4, "z" * 3000)] + [(100 + i, "Some text with words. " * (i % 40)) for i in range(120)]


@pytest.fixture
def docs(spark):
    return spark.createDataFrame([(d, t, "clash", 1) for d, t in ROWS], "doc_id long, text string, path string, start int").repartition(4)


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_shards_hold_every_document(docs, monkeypatch):
    monkeypatch.setattr(grammar, "TASK_BYTES", 20_000)
    path = public_tokenizers.path(FILES[0])
    files = grammar.write_shards(docs, path, end_id=0, shard_ids=2000)
    assert files.count() > 3
    rows = sorted(grammar.read_shards(files).collect(), key=lambda r: r.start)
    _, plain = both(FILES[0])
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_tokens, r.ids_crc32) for r in rows) == sorted(
        (d is not None, d or 0, len(ids), crc(ids)) for d, t in ROWS for ids in [plain.encode(t or "", add_special_tokens=False).ids + [0]]
    )
    assert [r.doc_id or -1 for r in rows] == sorted(d or -1 for d, _ in ROWS)
    total = 0
    for r in rows:
        assert r.start == total
        total += r.n_tokens


@pytest.mark.parametrize("block", [300, 1 << 19])
def test_pieces_hold_every_id_once(docs, monkeypatch, block):
    monkeypatch.setattr(packing, "TASK_BYTES", 30_000)
    monkeypatch.setattr(packing, "BLOCK_IDS", block)
    rows = packing.pack(docs, public_tokenizers.path(FILES[1]), end_id=2, width=1024).collect()
    _, plain = both(FILES[1])
    want = [(d, plain.encode(t or "", add_special_tokens=False).ids + [2]) for d, t in ROWS]
    pieces = sorted((r.doc_id is not None, r.doc_id or 0, r.doc_tokens, r.start, r.length, r.ids_crc32) for r in rows)
    for d, ids in want:
        at = 0
        while at < len(ids):
            key = next(p for p in pieces if p[:4] == (d is not None, d or 0, len(ids), at) and p[5] == crc(ids[at : at + p[4]]))
            pieces.remove(key)
            at += key[4]
        assert at == len(ids)
    assert not pieces
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(none, public_tokenizers.path(FILES[1]), end_id=2).count() == 0
    assert grammar.read_shards(grammar.write_shards(none, public_tokenizers.path(FILES[0]), end_id=0)).count() == 0


def test_pairs_are_replaced_until_none_is_left_that_pays():
    """No pair, counted anew in the result, is left with many occurrences; a run of one id takes many rounds."""
    draw = np.random.default_rng(5)
    words = [draw.integers(0, 500, draw.integers(2, 9)) for _ in range(200)]
    ids = np.concatenate([words[i] for i in draw.zipf(1.3, 20_000) % 200] + [np.full(5000, 7)]).astype(np.uint32)
    bounds = np.array([0, 3, len(ids) // 2, len(ids)])
    symbols, first, rules = grammar.compress(ids, bounds, 500)
    assert len(symbols) < len(ids) / 4 and max(grammar.expansion_lengths(rules, 500)) >= 256

    def expanded(s):
        return [int(s)] if s < 500 else [x for part in rules[s - 500] for x in expanded(part)]

    assert [x for s in symbols for x in expanded(s)] == ids.tolist()
    assert [sum(len(expanded(s)) for s in symbols[a:b]) for a, b in zip(first, first[1:])] == np.diff(bounds).tolist()
    pairs = {}
    for a, b in zip(first, first[1:]):
        for pair in zip(symbols[a : b - 1].tolist(), symbols[a + 1 : b].tolist()):
            pairs[pair] = pairs.get(pair, 0) + 1
    assert max(pairs.values()) < 4 * grammar.LEAST
