"""Token ids by the ``tokenizers`` library, each piece of text between two words encoded once per worker.

Byte-pair tokenizers split a text before they merge, and white space after another character always
starts a new piece. A text may therefore be cut before any run of white space and encoded unit by
unit, with the ids of the whole. Units are found and told apart as hashes of a buffer of texts; a
worker keeps the ids of those it has met (at most ``KEPT`` units, then it starts anew) and passes
only new ones to the library.

The ids of the operators are those of the library's default call: a special token's text in a
document, such as ``<|endoftext|>``, gets that token's id. Added tokens lie within a unit unless they
hold white space or take it in from beside them; a tokenizer with such ones is given whole texts.
"""

from __future__ import annotations

import json
import os

import numpy as np
from tokenizers import Tokenizer

from hitledger.llm.words import IS_WORD, hash_spans

KEPT = 2_000_000
# New units are encoded in joined texts of up to so many: longer ones take the library more time a unit.
JOINED = 500


def find_units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all units, and how many each text has.

    A cut lies before ASCII white space that follows a character which is surely none: after a
    multi-byte character that could be Unicode white space no cut is made.
    """
    white = ~IS_WORD[data]
    cut = white.copy()
    cut[1:] &= data[:-1] > 0x20
    cut[:1] = False
    high = np.flatnonzero(cut & (np.concatenate((data[:1], data[:-1])) >= 0x80))
    two, three = data[np.maximum(high - 2, 0)], data[np.maximum(high - 3, 0)]
    cut[high[(two == 0xC2) | (three >= 0xE1) & (three <= 0xE3)]] = False
    cut[offsets[:-1][np.diff(offsets) > 0]] = True
    starts = np.flatnonzero(cut)
    return starts, np.diff(np.searchsorted(starts, offsets))


def token_bytes(tokenizer: Tokenizer) -> np.ndarray | None:
    """Bytes of text that each id stands for; None if the text is changed before it is split, or ids may stand for other text."""
    parts = json.loads(tokenizer.to_str())
    before, model = parts["pre_tokenizer"] or {}, parts["model"]
    same = parts["normalizer"] is None and before.get("type") == "ByteLevel" and not before.get("add_prefix_space")
    if not same or model["type"] != "BPE" or model.get("unk_token") or model.get("continuing_subword_prefix") or model.get("end_of_word_suffix"):
        return None
    vocabulary = tokenizer.get_vocab(with_added_tokens=True)
    out = np.zeros(max(vocabulary.values(), default=-1) + 1, np.int64)
    for token, number in vocabulary.items():
        out[number] = len(token)  # a character stands for a byte
    for number, token in tokenizer.get_added_tokens_decoder().items():
        out[number] = len(token.content.encode())
    return out


class Encoder:
    """Encodes buffers of texts; one per worker and tokenizer file.

    ``special``: the text of a special token stands for that token, as by the library's default;
    otherwise it is encoded like any other text.
    """

    def __init__(self, path: str, special: bool = False) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs a worker per core
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not special
        self.whole = any(t.lstrip or t.rstrip or any(map(str.isspace, t.content)) for t in self.tokenizer.get_added_tokens_decoder().values())
        self.bytes = token_bytes(self.tokenizer)
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.begin, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids, self.used = np.zeros(1 << 16, np.uint32), 0

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and how many each text has."""
        if self.whole:
            raw, bounds = data.tobytes(), offsets.tolist()
            found = [x.ids for x in self.tokenizer.encode_batch([raw[a:b].decode() for a, b in zip(bounds, bounds[1:])], add_special_tokens=False)]
            return np.array([i for x in found for i in x], np.uint32), np.array([len(x) for x in found], np.int64)
        starts, count = find_units(data, offsets)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(offsets) - 1, np.int64)
        ends = np.append(starts[1:], len(data))
        keys, first, unit = np.unique(hash_spans(data, starts, ends), return_index=True, return_inverse=True)
        if len(self.keys) > KEPT:
            self._forget()
        self._learn(data, starts, ends, keys, first)
        at = np.searchsorted(self.keys, keys)
        begin, size = self.begin[at][unit], self.size[at][unit]
        bound = np.concatenate(([0], np.cumsum(size)))
        ids = self.ids[np.repeat(begin - bound[:-1], size) + np.arange(bound[-1])]
        texts = np.concatenate(([0], np.cumsum(count)))
        return ids, bound[texts[1:]] - bound[texts[:-1]]

    def _learn(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, keys: np.ndarray, first: np.ndarray) -> None:
        at = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        if len(self.keys):
            known = self.keys[np.minimum(at, len(self.keys) - 1)] == keys
        new = np.flatnonzero(~known)
        if not len(new):
            return
        raw = data.tobytes()
        texts = [raw[a:b].decode() for a, b in zip(starts[first[new]].tolist(), ends[first[new]].tolist())]
        order, ids, size = self._encode_units(texts)
        begin = np.empty(len(new), np.int64)
        begin[order] = self.used + np.concatenate(([0], np.cumsum(size)[:-1]))
        size[order] = size.copy()
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate((self.ids, np.zeros_like(self.ids)))
        self.ids[self.used : self.used + len(ids)] = ids
        self.used += len(ids)
        self.keys = np.insert(self.keys, at[new], keys[new])
        self.begin = np.insert(self.begin, at[new], begin)
        self.size = np.insert(self.size, at[new], size)

    def _encode_units(self, units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """An order of the units, their ids end to end in it, and how many each has.

        Units that start with white space and end without are encoded joined; a token belongs to the
        unit in which it starts.
        """
        fit = np.array([u[0] in " \t\n\r\x0b\x0c" and not u[-1].isspace() for u in units])
        joint, alone = np.flatnonzero(fit), np.flatnonzero(~fit)
        ids, size = [], []
        for lo in range(0, len(joint), JOINED):
            part = [units[i] for i in joint[lo : lo + JOINED]]
            found, count = self._encode_joined(part)
            ids.append(found)
            size.append(count)
        for lo in range(0, len(alone), JOINED):
            found = [x.ids for x in self.tokenizer.encode_batch_fast([units[i] for i in alone[lo : lo + JOINED]], add_special_tokens=False)]
            ids.append(np.array([i for x in found for i in x], np.uint32))
            size.append(np.array([len(x) for x in found], np.int64))
        return np.concatenate((joint, alone)), np.concatenate(ids), np.concatenate(size)

    def _encode_joined(self, part: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of units joined, and how many start in each: by the bytes that ids stand for, or else by the library's offsets."""
        text = "".join(part)
        if self.bytes is not None:
            ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
            ends = np.cumsum(self.bytes[ids])
            bound = np.cumsum([len(u.encode()) for u in part])
            if len(ids) and ends[-1] == bound[-1]:
                return ids, np.diff(np.searchsorted(ends - self.bytes[ids], bound), prepend=0)
        done = self.tokenizer.encode(text, add_special_tokens=False)
        bound = np.cumsum([len(u) for u in part])
        ends = np.searchsorted(np.array([x[0] for x in done.offsets], np.int64), bound)
        return np.array(done.ids, np.uint32), np.diff(ends, prepend=0)


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a tokenizer file, with the ids of the library's default."""
    if path not in _encoders:
        _encoders[path] = Encoder(path, special=True)
    return _encoders[path]
