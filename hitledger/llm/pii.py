"""Personal data: plain patterns, and further spans picked by boosted trees from generous candidates.

Base. E-mail addresses, IP addresses, card numbers and phone numbers by fixed patterns with checks
(octets, Luhn, digits). These spans always stay.

Method. Generators propose spans of the same kinds with high recall, overlapping where a string
could be two things: e-mail addresses with any letters or a spelled-out at-sign, IP addresses with
bracketed dots, numbers with other separators or without a plus. Boosted trees judge each by its
format (lengths, groups, checks) and its context (neighbouring characters, cue words, digits near
by). They learn from the corpus: base spans as they stand and rewritten in the candidates' forms, in
their own context, are positive; candidates that touch no base span, and base spans with a check
broken, are negative. Per kind the lowest threshold is used at which an exact binomial bound still
holds the share of wrong spans under ``WRONG``, from the counts of all examples of all held-out
texts; with no such threshold a kind adds nothing. Added spans overlap neither base spans nor each
other; the likelier goes first.

A hash of the text says which half of the texts is held out, so copies are all in one half. Equal
texts, and a span in the same form and context, count once, in learning and in calibration. The trees learn from at most
``LEARN_ROWS`` examples of the other half, chosen by a hash, of which only the features reach the
driver. Everything else works on every whole text.

Nulls and odd input: a null or empty text has no spans; equal rows get equal results; a corpus
without base spans adds none; no rows give no rows. Matching takes time in proportion to the text,
whatever it holds. Columns of the input are carried whole and the result is one struct column, so
names can't clash.
"""

from __future__ import annotations

import bisect
import hashlib
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitledger.llm import boosting
from hitledger.llm.quality import binomial_tail
from hitledger.llm.shared import prepare, with_columns

KINDS = ("email", "ip", "card", "phone")
LEARN_ROWS = 10_000
# Of the rows with a digit or an at-sign, how many are looked at for examples.
LEARN_DOCS = 10_000
WRONG, ERROR = 0.02, 0.05
# The thresholds tried, the strictest first.
STEPS = (0.995, 0.99, 0.98, 0.95, 0.9, 0.85, 0.8)

Span = tuple[int, int, int]  # kind, start, end

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# A match can start at the head of a run of digits only: what fails there fails further on.
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _is_octet(part: str) -> bool:
    value = part.lstrip("0")
    return len(value) <= 3 and int(value or 0) <= 255


def base_spans(text: str) -> list[Span]:
    """Matches of the fixed patterns, leftmost first and not overlapping within a kind, that pass their checks."""
    out: list[Span] = []
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((0, start, m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    out += [(1, *m.span()) for m in _IP.finditer(text) if all(map(_is_octet, m.groups()))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = _digits(m.group())
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append((2, *m.span()))
    if "+" in text:
        out += [(3, *m.span()) for m in _PHONE.finditer(text) if 8 <= len(_digits(m.group())) <= 15]
    return out


_AT = re.compile(r"[\[({] ?(?:at|AT) ?[\])}]|@")
_HOST = re.compile(r" ?[\w-]{1,63}(?:(?:\.| ?[\[({] ?(?:dot|DOT) ?[\])}] ?)[\w-]{1,63}){1,8}")
_QUAD = re.compile(r"(?<![0-9A-Za-z.])[0-9]{1,3}(?:\[\.\]|\(\.\)|\.|,)[0-9]{1,3}(?:\[\.\]|\(\.\)|\.|,)[0-9]{1,3}(?:\[\.\]|\(\.\)|\.|,)[0-9]{1,3}(?![0-9A-Za-z])")
_NUMBER = re.compile(r"(?<![0-9A-Za-z])[0-9](?:[ ().\-/]{0,2}[0-9]){6,18}(?![0-9A-Za-z])")


def candidates(text: str) -> list[Span]:
    """Generous proposals; one string may be proposed as several kinds."""
    out: list[Span] = []
    for m in _AT.finditer(text):
        start = m.start() - (text[m.start() - 1 : m.start()] == " " and m.group() != "@")
        name = start
        while name > 0 and name > start - 64 and (text[name - 1].isalnum() or text[name - 1] in "._%+-'"):
            name -= 1
        host = _HOST.match(text, m.end()) if name < start else None
        if host:
            out.append((0, name, host.end()))
    out += [(1, *m.span()) for m in _QUAD.finditer(text)]
    for m in _NUMBER.finditer(text):
        start, end = m.span()
        while start > 0 and start > m.start() - 2 and text[start - 1] in "+(":
            start -= 1
        count = len(_digits(m.group()))
        if count <= 15:
            out.append((3, start, end))
        if count >= 13:
            out.append((2, m.start(), end))
    return out


_CUES = tuple(re.compile(x, re.I) for x in (r"mail|contact|write|schreib|correo|courriel", r"\bip\b|host|server|address|addr", r"card|visa|credit|karte|tarjeta|carte", r"tel|phone|call|fax|mobile|cell"))


def _side(c: str) -> float:
    return 0.0 if not c or c.isspace() else 1.0 if c.isalnum() else 2.0 if c in "\"'`" else 3.0


def features(kind: int, value: str, before: str, after: str) -> list[float]:
    """Format and context of a span; ``before`` and ``after`` are some 30 characters of its surroundings."""
    groups = re.findall(r"[0-9]+", value)
    digits = "".join(groups)
    sizes = [len(g) for g in groups] or [0]
    return [
        *(float(kind == k) for k in range(4)),
        float(len(value)),
        float(len(digits)),
        float(sum(c.isalpha() for c in value)),
        float(len({c for c in value if not c.isalnum()})),
        float(sizes[0]),
        float(sizes[-1]),
        float(max(sizes)),
        float(min(sizes)),
        float(len(groups)),
        float(len(digits) >= 13 and luhn(digits)),
        float(len(groups) == 4 and all(map(_is_octet, groups))),
        float(value[:1] == "+"),
        float("(" in value and ")" in value),
        float(len(set(digits))),
        float(sum(not c.isalnum() and not c.isascii() for c in value)),
        float("@" in value),
        float(value[-4:].rpartition(".")[2].isalpha()),
        _side(before[-1:]),
        _side(after[:1]),
        float(sum("0" <= c <= "9" for c in before + after)),
        float(bool(_CUES[kind].search(before))),
    ]


def _context(text: str, start: int, end: int) -> tuple[str, str]:
    return text[max(0, start - 30) : start], text[end : end + 30]


def _rewritten(kind: int, value: str, draw: random.Random) -> tuple[str, str]:
    """A base span in a form that only the candidates cover, and one with its check broken."""
    digits = _digits(value)
    if kind == 0:
        name, _, host = value.partition("@")
        good = draw.choice((f"{name} [at] {host}", f"{name}(at){host}", f"{name} [at] {host.replace('.', ' [dot] ')}", value))
        return good, f"{name}@{host.split('.')[0]}.{draw.randrange(10, 999)}"
    if kind == 1:
        parts = value.split(".")
        bad = list(parts)
        bad[draw.randrange(4)] = str(draw.randrange(256, 999))
        return draw.choice(("[.]", "(.)")).join(parts), ".".join(bad)
    if kind == 2:
        step = draw.choice((".", "/", " ", "-"))
        at = draw.randrange(len(digits))
        bad = digits[:at] + str((int(digits[at]) + draw.randrange(1, 9)) % 10) + digits[at + 1 :]
        return step.join(digits[i : i + 4] for i in range(0, len(digits), 4)), bad
    return draw.choice((value.lstrip("+"), f"({digits[-10:-7]}) {digits[-7:-4]}-{digits[-4:]}", "-".join((digits[-10:-7], digits[-7:-4], digits[-4:])))), digits + str(draw.randrange(10, 99))


def _example(y: int, kind: int, value: str, before: str, after: str) -> tuple[int, list[float], int]:
    key = hashlib.blake2b("\0".join((str(y), str(kind), value, before, after)).encode(errors="surrogatepass"), digest_size=8)
    return y, features(kind, value, before, after), int.from_bytes(key.digest(), "little", signed=True)


def examples(text: str, seed: int) -> Iterator[tuple[int, list[float], int]]:
    """Labelled feature rows of one text, with a hash of the span in its context by which copies are told."""
    draw = random.Random(seed)
    base = base_spans(text)
    for kind, start, end in base:
        around = _context(text, start, end)
        good, bad = _rewritten(kind, text[start:end], draw)
        yield _example(1, kind, text[start:end], *around)
        yield _example(1, kind, good, *around)
        yield _example(0, kind, bad, *around)
    covered = _Cover()
    for _, start, end in sorted(base, key=lambda s: s[1:]):
        covered.add(start, end)
    for kind, start, end in candidates(text):
        if not covered.meets(start, end):
            yield _example(0, kind, text[start:end], *_context(text, start, end))


class _Cover:
    """Stretches of a text, joined where they overlap."""

    def __init__(self) -> None:
        self.starts: list[int] = []
        self.ends: list[int] = []

    def meets(self, start: int, end: int) -> bool:
        at = bisect.bisect_left(self.starts, end)
        return at > 0 and self.ends[at - 1] > start

    def add(self, start: int, end: int) -> None:
        """A stretch; one that overlaps another must come in order of start."""
        if self.meets(start, end):
            self.ends[-1] = max(self.ends[-1], end)
        else:
            at = bisect.bisect_left(self.starts, start)
            self.starts.insert(at, start)
            self.ends.insert(at, end)


@dataclass
class Picker:
    """Trees and a threshold per kind; above 1 nothing is picked."""

    trees: boosting.Trees | None
    thresholds: tuple[float, ...] = (2.0,) * len(KINDS)

    def pick(self, found: list[tuple[list[Span], list[Span], list[list[float]]]]) -> list[list[Span]]:
        """Of each text's base spans, candidates and their features: all spans, in order of kind and start."""
        rows = [f for _, _, fs in found for f in fs]
        chances = self.trees.chances(np.array(rows)).tolist() if rows and self.trees else [0.0] * len(rows)
        out, at = [], 0
        for base, proposed, _ in found:
            mine = sorted(zip(chances[at : at + len(proposed)], proposed), key=lambda x: (-x[0], x[1]))
            at += len(proposed)
            spans, covered = list(base), _Cover()
            for chance, span in mine:
                if chance >= self.thresholds[span[0]] and not covered.meets(span[1], span[2]):
                    covered.add(span[1], span[2])
                    spans.append(span)
            out.append(sorted(spans))
        return out


def learn(docs: DataFrame, text: str = "text") -> Picker:
    """Fit the trees on a sample of one half of the texts, calibrate the thresholds on all of the other half."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col(text).alias("text")).where(F.col("text").rlike("[0-9@]"))
    held = F.pmod(F.xxhash64("text", F.lit(9)), F.lit(2)) == 1
    trees = _fitted(rows.where(~held))
    return Picker(trees, _calibrated(rows.where(held), trees)) if trees else Picker(None)


def _fitted(rows: DataFrame) -> boosting.Trees | None:
    """Trees of a sample of the texts' examples, or none if all are of one class."""
    count = rows.select(F.xxhash64("text", F.lit(5))).distinct().count()
    share = min(1.0, LEARN_DOCS / max(count, 1))
    sample = rows.where(F.pmod(F.xxhash64("text", F.lit(5)), F.lit(1 << 30)) < int(share * (1 << 30))).distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [e for t in batch.column("text").to_pylist() for e in examples(t, len(t))]
            yield pa.RecordBatch.from_arrays([pa.array([y for y, _, _ in found], pa.int32()), pa.array([x for _, x, _ in found], pa.list_(pa.float64())), pa.array([k for _, _, k in found], pa.int64())], names=["y", "x", "key"])

    made = sample.mapInArrow(run, "y int, x array<double>, key long").distinct().orderBy("key").limit(LEARN_ROWS).collect()
    y, x = np.array([r.y for r in made], float), np.array([r.x for r in made])
    return boosting.fit(x, y) if made and 0 < y.mean() < 1 else None


def _calibrated(rows: DataFrame, trees: boosting.Trees) -> tuple[float, ...]:
    """A threshold per kind, from all examples of all texts, copies counted once, by the strictest step that each reaches."""
    steps = np.array(STEPS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [e for t in batch.column("text").to_pylist() for e in examples(t, len(t))]
            if not found:
                continue
            x = np.array([f for _, f, _ in found])
            step = (trees.chances(x)[:, None] < steps).sum(axis=1)
            rows = np.stack((x[:, : len(KINDS)].argmax(axis=1), step, [y for y, _, _ in found], [k for _, _, k in found]), axis=1)
            rows = np.unique(rows[step < len(steps)], axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(rows[:, i].astype(kind)) for i, kind in enumerate((np.int32, np.int32, np.int32, np.int64))], names=["kind", "step", "y", "key"])

    count = np.zeros((len(KINDS), len(STEPS), 2), np.int64)
    for r in rows.mapInArrow(run, "kind int, step int, y int, key long").distinct().groupBy("kind", "step", "y").agg(F.count("*").alias("n")).collect():
        count[r.kind, r.step, r.y] = r.n
    return tuple(_lowest([(int(wrong), int(wrong + right)) for wrong, right in c.cumsum(axis=0)]) for c in count)


def threshold(chances: np.ndarray, right: np.ndarray) -> float:
    """The lowest of ``STEPS`` at which the share of wrong ones among those picked is bounded, 2 if none is."""
    return _lowest([(int((right[chances >= t] == 0).sum()), int((chances >= t).sum())) for t in STEPS])


def _lowest(picked: list[tuple[int, int]]) -> float:
    """The threshold, from the wrong and all examples picked at each step.

    Tested from the strictest; the first failure ends the series, except that the strictest may be
    too few to tell.
    """
    best = 2.0
    for t, (wrong, n) in zip(STEPS, picked):
        # With a share of WRONG or more, the tail is about a half or more.
        if n and wrong < WRONG * n and binomial_tail(wrong, n, WRONG) <= ERROR:
            best = t
        elif best < 2:
            break
    return best


def _find(texts: list[str | None], picker: Picker) -> list[tuple[list[Span], list[Span]]]:
    """Base spans and all spans of each text."""
    found = []
    for text in texts:
        base = base_spans(text or "")
        covered = _Cover()
        for _, start, end in sorted(base, key=lambda s: s[1:]):
            covered.add(start, end)
        proposed = [s for s in candidates(text or "") if not covered.meets(s[1], s[2])] if picker.trees is not None else []
        found.append((base, proposed, [features(k, text[s:e], *_context(text, s, e)) for k, s, e in proposed]))
    return [(base, spans) for (base, _, _), spans in zip(found, picker.pick(found))]


def listed(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans)


def find(docs: DataFrame, picker: Picker, name: str, text: str = "text") -> DataFrame:
    """``docs`` without its text, with a struct column ``name``: base counts, hash of the base spans, all spans."""
    prepare(docs.sparkSession)
    kept = [c for c in docs.columns if c != text]
    counts = [f"n_{k}" for k in KINDS]
    kind = pa.struct([*((c, pa.int64()) for c in counts), ("base_sha256", pa.string()), ("spans", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for base, spans in _find(batch.column(text).to_pylist(), picker):
                number = {c: sum(s[0] == k for s in base) for k, c in enumerate(counts)}
                rows.append(number | {"base_sha256": hashlib.sha256(listed(sorted(base)).encode()).hexdigest(), "spans": listed(spans)})
            yield with_columns(batch.select(kept), **{name: pa.array(rows, kind)})

    fields = [*(T.StructField(c, T.LongType()) for c in counts), T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType())]
    return docs.mapInArrow(run, T.StructType([*docs.select(kept).schema.fields, T.StructField(name, T.StructType(fields))]))


def redacted(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind in brackets; where spans overlap, what they cover is one."""
    out, done = [], 0
    for kind, start, end in sorted(spans, key=lambda x: (x[1], -x[2])):
        if start >= done:
            out += [text[done:start], f"[{KINDS[kind].upper()}]"]
        done = max(done, end)
    return "".join([*out, text[done:]])


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with all spans replaced in the texts, other columns as they are."""
    picker = learn(docs, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text).to_pylist()
            new = [None if t is None else redacted(t, spans) for t, (_, spans) in zip(texts, _find(texts, picker))]
            at = batch.schema.get_field_index(text)
            yield batch.set_column(at, batch.schema.field(at), pa.array(new, batch.schema.field(at).type))

    return docs.mapInArrow(run, docs.schema)
