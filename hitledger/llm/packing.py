"""Packing documents into sequences, in order, by dynamic programming over cut positions.

Documents are encoded in ascending order of id, a range of ids per task, and follow one another in a
stream. A stream may be cut at the end of a document, at the end of a sentence, and, where neither
comes for ``GAP`` ids, inside. Of all ways to cut it into windows of at most ``width`` ids, that with
the least cost is taken: the padding of each window, plus a penalty for a cut within a document
(``SENTENCE``) or a sentence (``INSIDE``), plus ``WINDOW`` for each window. Windows whose length is a
power of two need no padding. The best last cut before each position is the front of a monotone
queue over the window, so a position costs constant time.

The stream is worked off in blocks of some hundred thousand ids; a block's last window, which ends
where the block happens to, is carried into the next block. Only the end of a task's range is thus
padded without choice. Sequences are numbered by range, then in order.

Nulls and odd input: a null or empty text is the end id alone; a null id comes first and stays null;
documents that share an id are ordered by a hash of the text and each is packed; a document longer
than a sequence is cut as above; no documents give no rows. Only the id and the text are read, so
other columns can't clash.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitledger.llm.shared import in_order, prepare
from hitledger.llm.token_ids import encoder
from hitledger.llm.words import text_slices

TASK_BYTES = 32 << 20
# Ids that one run of the dynamic programme covers.
BLOCK_IDS = 1 << 19
# Costs, in ids of padding.
SENTENCE, INSIDE, WINDOW = 16.0, 256.0, 8.0
GAP = 512
# Windows of these lengths, and of ``width``, need no padding.
POWERS = (256, 512, 1024, 2048)


def cut_points(ids: np.ndarray, ends: np.ndarray, sentence_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions where the stream may be cut, from 0 to its end, and the penalty of each.

    ``ends``: positions after the documents' last ids; ``sentence_end``: whether an id ends a sentence.
    """
    penalty = np.full(len(ids) + 1, np.inf)
    penalty[np.flatnonzero(sentence_end[ids]) + 1] = SENTENCE
    penalty[ends] = 0
    penalty[[0, -1]] = 0
    at = np.flatnonzero(penalty < np.inf)
    wide = np.flatnonzero(np.diff(at) > GAP)
    if len(wide):
        inner = np.concatenate([np.arange(at[i] + GAP, at[i + 1], GAP) for i in wide])
        penalty[inner] = INSIDE
        at = np.flatnonzero(penalty < np.inf)
    return at, penalty[at]


def best_cuts(at: np.ndarray, penalty: np.ndarray, width: int) -> tuple[list[int], float]:
    """Indices of the cuts of least cost, the first and last position included, and that cost.

    With f the least cost up to a cut, f(j) = penalty(j) + WINDOW + min over cuts i within ``width``
    of f(i) + width - (at(j) - at(i)), or of f(i) alone where at(j) - at(i) is a power of two.
    """
    place, extra = at.tolist(), (penalty + WINDOW).tolist()
    exact: dict[int, list[int]] = {}
    for p in POWERS:
        if p < width:
            i = np.minimum(np.searchsorted(at, at - p), len(at) - 1)
            for j in np.flatnonzero(at[i] == at - p).tolist():
                exact.setdefault(j, []).append(int(i[j]))
    cost, back = [0.0] * len(place), [0] * len(place)
    queue: deque[tuple[float, int, int]] = deque([(0.0, 0, 0)])  # f(i) + at(i), at(i), i; the first ascends
    for j in range(1, len(place)):
        x = place[j]
        while queue[0][1] < x - width:
            queue.popleft()
        best, _, i = queue[0]
        best += width - x
        for other in exact.get(j, ()):
            if cost[other] < best:
                best, i = cost[other], other
        cost[j], back[j] = best + extra[j], i
        value = cost[j] + x
        while queue and queue[-1][0] >= value:
            queue.pop()
        queue.append((value, x, j))
    cuts = [len(place) - 1]
    while cuts[-1]:
        cuts.append(back[cuts[-1]])
    return cuts[::-1], cost[-1]


def sentence_ends(tokenizer, size: int, closers: str = "\"'”’»)]") -> np.ndarray:
    """Whether each id's text ends with a full stop, question or exclamation mark, closing marks aside."""
    out = np.zeros(size, bool)
    for token, i in tokenizer.get_vocab().items():
        out[i] = token.removesuffix("</w>").rstrip(closers).endswith((".", "!", "?"))
    return out


class _Stream:
    """A task's stream of ids, worked off block by block."""

    def __init__(self, part: int, width: int, sentence_end: np.ndarray) -> None:
        self.width, self.sentence_end, self.next = width, sentence_end, part << 40
        self.ids: list[np.ndarray] = []
        # Of each document still in the stream: id, all its ids, those already packed.
        self.names: list[int | None] = []
        self.total: list[np.ndarray] = []
        self.done = 0
        self.held = 0

    def add(self, names: list, ids: np.ndarray, sizes: np.ndarray) -> None:
        self.names += names
        self.total.append(sizes)
        self.ids.append(ids)
        self.held += len(ids)

    def pack(self, end: bool) -> pa.RecordBatch:
        """The pieces of all windows but the last, which stays unless the stream has come to its end."""
        ids, total = np.concatenate(self.ids), np.concatenate(self.total)
        ends = np.cumsum(total) - self.done
        at, penalty = cut_points(ids, ends, self.sentence_end)
        cuts, _ = best_cuts(at, penalty, self.width)
        if not end and len(cuts) > 2:
            cuts = cuts[:-1]
        window = at[np.array(cuts)]
        stop = int(window[-1])
        begin = ends - total
        bound = np.unique(np.concatenate((window, begin[(begin > 0) & (begin < stop)])))
        start, length = bound[:-1], np.diff(bound)
        doc = np.searchsorted(begin, start, "right") - 1
        of = np.searchsorted(window, start, "right") - 1
        data = ids.astype("<u4")
        out = {
            "doc_id": pa.array([self.names[d] for d in doc.tolist()], pa.int64()),
            "start": pa.array(start - begin[doc], pa.int64()),
            "length": pa.array(length, pa.int64()),
            "ids_crc32": pa.array([zlib.crc32(data[a : a + n]) for a, n in zip(start.tolist(), length.tolist())], pa.int64()),
            "doc_tokens": pa.array(total[doc], pa.int64()),
            "sequence_id": pa.array(self.next + of, pa.int64()),
            "offset": pa.array(start - window[of], pa.int64()),
        }
        self.next += len(window) - 1
        left = int(np.searchsorted(ends, stop, "right"))
        self.done = stop - int(begin[left]) if left < len(ends) else 0
        self.names, self.total, self.ids, self.held = self.names[left:], [total[left:]], [ids[stop:]], len(ids) - stop
        return pa.RecordBatch.from_pydict(out)


def pack(docs: DataFrame, tokenizer: str, end_id: int, width: int = 4096, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``."""
    prepare(docs.sparkSession)
    rows = in_order(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")), "doc_id", "text", TASK_BYTES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = encoder(tokenizer)
        size = max(library.tokenizer.get_vocab_size(), end_id + 1)
        stream = _Stream(TaskContext.get().partitionId(), width, sentence_ends(library.tokenizer, size))
        for batch in batches:
            for lo, hi, data, offsets in text_slices(batch.column("text")):
                ids, count = library.encode(data, offsets)
                stream.add(batch.column("doc_id").slice(lo, hi - lo).to_pylist(), np.insert(ids, np.cumsum(count), end_id), count + 1)
                if stream.held >= BLOCK_IDS:
                    yield stream.pack(end=False)
        if stream.held:
            yield stream.pack(end=True)

    return rows.mapInArrow(run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
