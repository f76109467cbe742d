"""Fill-in-the-middle forms of texts, by one match that keeps every repetition.

A text is a row of units: blanks with the word behind them, or blanks at the end. ``(unit)*`` matches
the whole text once and keeps the end of every repetition, ``match.ends(1)``: their number is ``n``,
and two of them are the offsets of both cuts. Which cuts, and which form a text takes, depends only
on a hash of its id, so that reruns and repeated rows agree:

- ``plain``: the text, where it is empty, holds a marker, or the hash says so.
- ``psm``: ``<P>`` prefix ``<S>`` suffix ``<M>`` middle.
- ``spm``: ``<S>`` suffix ``<P>`` prefix ``<M>`` middle.

:func:`restored` rebuilds the text from output and form alone, with built-in functions. No part of a
text holds a marker, and a marker can't overlap itself, so each is found once.

The match keeps some 200 bytes a unit while it works. A text beyond ``PIECE`` characters is therefore
matched in pieces that begin where a unit begins, at a blank behind a word; the units are the same,
and of the pieces only eight bytes a unit are kept.

Nulls and odd input: a null text counts as empty, a null id hashes as the empty text; rows with equal
ids and texts get equal outputs; no rows give no rows. The columns of the frame stay as they are, and
one of the output's name, in any case, is replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitledger.llm.shared import prepare

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

UNITS = regex.compile(r"([\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+)*")
_BORDER = regex.compile(r"(?<=[^\x20\x09-\x0D])[\x20\x09-\x0D]")

# Characters that one match takes at most, unless there is no border.
PIECE = 1 << 18

_OUTPUT = pa.struct([("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.string())])


def _ends(text: str) -> list[int] | np.ndarray:
    """Where each unit ends."""
    if len(text) <= PIECE:
        return UNITS.fullmatch(text).ends(1)
    ends, at = [], 0
    while at < len(text):
        border = _BORDER.search(text, min(at + PIECE, len(text)))
        to = border.start() if border else len(text)
        ends.append(np.array(UNITS.fullmatch(text, at, to).ends(1), np.int64))
        at = to
    return np.concatenate(ends)


def arranged(text: str, key: str, seed: int, rate: int, spm_rate: int) -> tuple[int, str, int | None, int | None, str]:
    """Units, form, characters of prefix and middle, and the output of one text."""
    ends = _ends(text)
    digest = hashlib.sha256(f"{seed}:{key}".encode()).hexdigest()
    first, second, chosen, swapped = (int(digest[i : i + 8], 16) for i in range(0, 32, 8))
    n = len(ends)
    if not text or PREFIX in text or SUFFIX in text or MIDDLE in text or chosen % 100 >= rate:
        return n, "plain", None, None, text
    low, high = sorted((first % (n + 1), second % (n + 1)))
    cut, end = (int(ends[k - 1]) if k else 0 for k in (low, high))
    prefix, middle, suffix = text[:cut], text[cut:end], text[end:]
    if swapped % 100 < spm_rate:
        return n, "spm", cut, end - cut, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", cut, end - cut, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def fill_middle(
    docs: DataFrame, name: str, key: str = "doc_id", text: str = "text", seed: int = 42, rate: int = 50, spm_rate: int = 80
) -> DataFrame:
    """``docs`` with a struct column ``name``: ``n``, ``form``, ``prefix_chars``, ``middle_chars``, ``output``.

    ``rate`` of 100 texts are taken apart, ``spm_rate`` of 100 of those begin with the suffix.
    """
    prepare(docs.sparkSession)
    kept = [c for c in docs.columns if c.lower() != name.lower()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, texts = (batch.column(batch.schema.get_field_index(c)) for c in (key, text))
            rows = [
                arranged(t.as_py() or "", "" if k is None else str(k), seed, rate, spm_rate) for k, t in zip(keys.to_pylist(), texts)
            ]
            fields = [pa.array(column, f.type) for column, f in zip(zip(*rows), _OUTPUT)] if rows else [pa.array([], f.type) for f in _OUTPUT]
            made = pa.StructArray.from_arrays(fields, fields=list(_OUTPUT))
            own = batch.select([c for c in batch.schema.names if c in kept])
            yield pa.RecordBatch.from_arrays([*own.columns, made], names=[*own.schema.names, name])

    kinds = {pa.int64(): T.LongType(), pa.string(): T.StringType()}
    struct = T.StructType([T.StructField(f.name, kinds[f.type]) for f in _OUTPUT])
    return docs.mapInArrow(run, T.StructType([*docs.select(kept).schema.fields, T.StructField(name, struct)]))


def restored(output: Column, form: Column) -> Column:
    """The text that an output of that form was made of."""

    def between(start: str | None, end: str | None) -> Column:
        head = F.substring_index(output, end, 1) if end else output
        return F.substring_index(head, start, -1)

    psm = F.concat(between(PREFIX, SUFFIX), between(MIDDLE, None), between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), between(MIDDLE, None), between(SUFFIX, PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
