"""Quality rules whose cutoffs come with a bound on false rejection.

Each rule scores a document, higher being worse, and rejects above a cutoff. Cutoffs are chosen per
stratum (language) from labelled documents:

- One half of the labels (by hash of the id), the tuning half, tells which cutoffs are of use: those
  that reject a far larger share of the bad than of the good. The mildest that does nearly as much as
  any is taken, to keep away from good documents.
- The other half, the holdout, certifies. For a cutoff with ``k`` of ``n`` good documents rejected,
  the exact binomial tail P(X <= k), X ~ Bin(n, risk / rules), is the p-value of "this rule wrongly
  rejects more than its share of the risk". Cutoffs are tested in order from the mildest; the first
  that fails ends the sequence, so no correction is needed along it. Over strata and rules the error
  ``error`` is divided (Bonferroni).

With probability ``1 - error`` all rules together then reject at most ``risk`` of the good documents
of every stratum. A stratum without enough labels gets no cutoffs and loses nothing but what the
fixed base rule rejects. Counts cover every labelled document.

Nulls and odd input: a null or empty text has no words and fails the base rule; a null language is a
stratum of its own; labels with a null id or quality don't count; repeated labels count once each,
repeated documents are judged alike; no labels or no documents give no cutoffs or no rows. Columns
of the input are carried whole, and names that clash with a measure's get way: measures are made in
one struct column of a fresh name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitledger.llm.shared import fresh, prepare, stored, with_columns
from hitledger.llm.words import find_words, hash_spans, joined, text_slices, windows

# Share of good documents that may be lost in a stratum, and the chance that a bound is broken.
RISK, ERROR = 0.05, 0.05
# A cutoff is of use if it rejects at least this many times as large a share of the bad as of the good.
# and at least this share of the bad; of certified cutoffs, the mildest with this part of the most that any rejects.
LIFT, LEAST_USE, NEARLY = 20.0, 0.05, 0.95

# Cutoffs, of some 50 bytes each, that may be broadcast.
FEW = 100_000

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
_STRUCT = pa.struct([(m, pa.int64()) for m in MEASURES])
_CUTOFFS = pa.schema([("stratum", pa.string()), ("rule", pa.string()), ("cutoff", pa.float64()), ("rejected", pa.int64()), ("good", pa.int64())])
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True

# Name: cutoffs from the mildest to the strictest.
RULES: dict[str, tuple[float, ...]] = {
    "repeated_words": (0.5, 0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15, 0.1, 0.05),
    "repeated_lines": (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1),
    "symbols": (2.0, 1.0, 0.5, 0.3, 0.2, 0.1, 0.05, 0.03),
    "long_words": (40.0, 25.0, 18.0, 14.0, 12.0, 11.0, 10.0, 9.0, 8.0),
    "short_words": (-1.2, -1.5, -2.0, -2.5, -3.0, -3.5, -4.0),
    "few_words": (-55.0, -60.0, -70.0, -80.0, -100.0, -120.0, -150.0),
}


def _measured(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The measures of the texts that lie end to end in ``data``."""
    n = len(offsets) - 1
    words = find_words(data, offsets)
    count = np.diff(words.first)

    def inside(positions: np.ndarray) -> np.ndarray:
        return np.diff(np.searchsorted(positions, offsets))

    size = np.concatenate(([0], np.cumsum(words.ends - words.starts)))
    chars = size[words.first[1:]] - size[words.first[:-1]] - inside(np.flatnonzero((data & 0xC0) == 0x80))

    breaks = np.flatnonzero(data == 10)
    begin, end = np.sort(np.concatenate((offsets[:-1], breaks + 1))), np.sort(np.concatenate((breaks, offsets[1:])))
    full = np.searchsorted(words.starts, end) > np.searchsorted(words.starts, begin)
    begin, end = begin[full], end[full]
    owner = np.searchsorted(offsets, begin, "right") - 1
    lines = np.bincount(owner, minlength=n)
    keys, where = np.unique(joined(hash_spans(data, begin, end), owner.astype(np.uint64)), return_index=True)
    distinct = np.bincount(owner[where], minlength=n)

    owner = np.repeat(np.arange(n), count)
    keys, at = windows(hash_spans(data, words.starts, words.ends), words.first, 3)
    keys = joined(keys, owner[at].astype(np.uint64))
    ranked = np.sort(keys)
    twice = np.unique(ranked[1:][ranked[1:] == ranked[:-1]])
    hit = np.zeros(len(keys), bool)
    if len(twice):
        hit = twice[np.minimum(np.searchsorted(twice, keys), len(twice) - 1)] == keys
    marked = np.zeros(len(words.starts), bool)
    for i in range(3):
        marked[at[hit] + i] = True
    repeated = np.bincount(owner[marked], minlength=n)
    return dict(zip(MEASURES, (count, chars, inside(np.flatnonzero(_SYMBOLS[data])), lines, lines - distinct, repeated)))


def measure(docs: DataFrame, name: str, text: str = "text", keep_text: bool = True) -> DataFrame:
    """``docs`` with a struct column ``name`` of the measures of each whole text."""
    prepare(docs.sparkSession)
    kept = [c for c in docs.columns if keep_text or c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [_measured(data, offsets) for _, _, data, offsets in text_slices(batch.column(text))]
            columns = [pa.array(np.concatenate([p[m] for p in parts] or [np.zeros(0)]), pa.int64()) for m in MEASURES]
            yield with_columns(batch.select(kept), **{name: pa.StructArray.from_arrays(columns, fields=list(_STRUCT))})

    kind = T.StructType([T.StructField(m, T.LongType()) for m in MEASURES])
    return docs.mapInArrow(run, T.StructType([*docs.select(kept).schema.fields, T.StructField(name, kind)]))


def base_failed(m: Column) -> Column:
    """The fixed rule: under 50 words, or over half of the words in repeated passages."""
    return (m["n_words"] < 50) | (100 * m["n_repeat_words"] > 50 * m["n_words"])


def _scores(m: Column) -> dict[str, Column]:
    words, lines = F.greatest(m["n_words"], F.lit(1)), F.greatest(m["n_lines"], F.lit(1))
    return {
        "repeated_words": m["n_repeat_words"] / words,
        "repeated_lines": m["n_dup_lines"] / lines,
        "symbols": m["n_symbols"] / words,
        "long_words": m["word_chars"] / words,
        "short_words": -m["word_chars"] / words,
        "few_words": -m["n_words"].cast("double"),
    }


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for X ~ Bin(n, p), summed exactly in logs."""
    if k >= n:
        return 1.0
    i = np.arange(1, k + 1)
    logs = np.concatenate(([0.0], np.cumsum(np.log((n - i + 1) / i)))) + np.arange(k + 1) * math.log(p) + (n - np.arange(k + 1)) * math.log1p(-p)
    top = logs.max()
    return min(1.0, float(np.exp(top + np.log(np.exp(logs - top).sum()))))


def choose_cutoff(cutoffs: list[float], hold: list[tuple[int, int]], tune: list[tuple[float, float]], risk: float, error: float) -> float | None:
    """The mildest cutoff that does nearly all a rule can, of those before the first that can't be certified.

    ``hold``: of each cutoff, good documents rejected and good documents; ``tune``: shares of the
    good and of the bad rejected. A rule that is of little use is left out.
    """
    useful = []
    for cut, (k, n), (good, bad) in zip(cutoffs, hold, tune):
        if n == 0 or binomial_tail(k, n, risk) > error:
            break
        if bad >= LEAST_USE and bad >= LIFT * good:
            useful.append((cut, bad))
    most = max((bad for _, bad in useful), default=0.0)
    return next((cut for cut, bad in useful if bad >= NEARLY * most), None)


def calibrate(measured: DataFrame, labels: DataFrame, name: str, stratum: str = "lang", risk: float = RISK, error: float = ERROR) -> DataFrame:
    """A row per stratum and rule in use: ``stratum``, ``rule``, ``cutoff``, with the counts behind it.

    ``measured`` has doc_id, the stratum's column and the measures ``name``; texts don't take part,
    so the join with ``labels`` (doc_id, quality) moves some 100 bytes a document.
    """
    named = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").select("doc_id", "quality")
    rows = measured.select("doc_id", F.col(stratum).alias("stratum"), F.col(name).alias("m"))
    strata = max(1, rows.select("stratum").distinct().count())
    rows = rows.where(~base_failed(F.col("m"))).join(named, "doc_id")
    half = F.when(F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0, "hold").otherwise("tune")
    over = F.array(
        *(
            F.struct(F.lit(rule).alias("rule"), F.lit(i).alias("step"), (score > cut).cast("long").alias("over"))
            for rule, score in _scores(F.col("m")).items()
            for i, cut in enumerate(RULES[rule])
        )
    )
    # One row per document up to the first, map-side sums: a few hundred rows a task reach the shuffle.
    counts = (
        rows.select("stratum", half.alias("half"), (F.col("quality") == 1).alias("good"), F.inline(over))
        .groupBy("stratum", "rule", "step", "half", "good")
        .agg(F.sum("over").alias("over"), F.count("*").alias("n"))
    )
    share = risk / len(RULES)

    def choose(rows: pa.Table) -> pa.Table:
        rows = rows.to_pylist()
        of = {(r["step"], r["half"], r["good"]): (r["over"], r["n"]) for r in rows}
        cuts = list(RULES[rows[0]["rule"]])
        hold = [of.get((i, "hold", True), (0, 0)) for i in range(len(cuts))]
        shares = [[over / n for over, n in (of.get((i, "tune", good), (0, 1)) for good in (True, False))] for i in range(len(cuts))]
        best = choose_cutoff(cuts, hold, shares, share, error / (strata * len(RULES)))
        found = [] if best is None else [{"stratum": rows[0]["stratum"], "rule": rows[0]["rule"], "cutoff": best} | dict(zip(("rejected", "good"), hold[cuts.index(best)]))]
        return pa.Table.from_pylist(found, _CUTOFFS)

    return counts.groupBy("stratum", "rule").applyInArrow(choose, "stratum string, rule string, cutoff double, rejected long, good long")


def judge(measured: DataFrame, cutoffs: DataFrame, name: str, kept: str, stratum: str = "lang") -> DataFrame:
    """``measured`` with a boolean column ``kept``: passes the base rule and every cutoff of its stratum.

    The cutoffs are a row per stratum and rule, counted here: up to ``FEW`` go to every task, so that
    documents needn't move; beyond that adaptive execution splits the rows of a large stratum.
    """
    key, cuts = fresh(measured, "stratum"), fresh(measured, "cutoffs")
    cutoffs = stored(cutoffs, "cutoffs")
    by_stratum = cutoffs.groupBy(F.col("stratum").alias(key)).agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias(cuts))
    by_stratum = F.broadcast(by_stratum) if cutoffs.count() <= FEW else by_stratum
    joined_rows = measured.join(by_stratum, measured[stratum].eqNullSafe(by_stratum[key]), "left")
    over = F.lit(False)
    for rule, score in _scores(F.col(name)).items():
        over = over | F.coalesce(score > F.col(cuts)[rule], F.lit(False))
    return joined_rows.withColumn(kept, ~base_failed(F.col(name)) & ~over).drop(key, cuts)


def filter_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents kept, with the columns they came with."""
    name, kept = fresh(docs, "measures"), fresh(docs, "kept")
    calibrating = stored(measure(docs.select("doc_id", "lang", "text"), name, keep_text=False), "measures")
    cutoffs = calibrate(calibrating, labels, name)
    return judge(measure(docs, name), cutoffs, name, kept).where(kept).select(docs.columns)
