"""Divergence of sources against plain counting of every pair and term."""

import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from conftest import prose

from hitledger.llm import divergence
from hitledger.llm.divergence import audit, corrections

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(rows, least=3, top=200):
    """``rows`` of (lang, source, text)."""
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        words = terms_of(text)
        counts[lang, source].update(words)
        docs[lang].update(set(words))
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= least]
        whole = Counter()
        for s in sources:
            whole.update({t: counts[lang, s][t] for t in kept})

        def shares(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 1) // (n + len(kept)) for t in kept}

        q = shares(whole)
        p = {s: shares(counts[lang, s]) for s in sources}
        for s in sources:
            pairs = [(-sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o.encode(), o) for o in sources if o != s]
            own = [(-((p[s][t] - q[t]) ** 2 // q[t]), t.encode(), t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, items in (("pair", sorted(pairs)), ("term", sorted(own)[:top])):
                out += [(lang, s, part, item, -value, rank) for rank, (value, _, item) in enumerate(items, 1)]
    return sorted(out)


def made(n, seed):
    draw = random.Random(seed)
    vocabulary = ["a", "É", "été", "the", "x-y", "O'Neil", "日本", "Word1two", "zz", "ß"] + [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(80)]
    for _ in range(n):
        lang, source = draw.choice(("en", "de", None)), draw.choice(("s1", "s1", "s1", "s2", "s3", "ü", None))
        yield lang, source, " ".join(draw.choice(vocabulary[: draw.choice((10, 40, 90))]) for _ in range(draw.randrange(30)))


@pytest.mark.parametrize("bounds", [{}, {"BLOCK_TERMS": 7, "RUN_BYTES": 500, "PIECE": 20, "PAIRS": 2, "BATCH": 3}, {"BLOCK_BYTES": 100}])
def test_many_small_blocks_give_the_same(spark, monkeypatch, bounds):
    for name, value in bounds.items():
        monkeypatch.setattr(divergence, name, value)
    rows = [*made(300, 1), ("en", "empty", ""), ("en", "nothing", None), ("xx", "alone", "one word"), ("yy", "a", ""), ("yy", "b", "")]
    docs = spark.createDataFrame(rows, "lang string, source string, text string").repartition(4)
    assert sorted(map(tuple, audit(docs).collect())) == plain(rows)
    assert sorted(map(tuple, audit(docs, least=1, top=3).collect())) == plain(rows, 1, 3)


def test_odd_rows(odd_docs, odd_rows):
    rows = [(r[2], r[3], r[1]) for r in odd_rows]
    assert sorted(map(tuple, audit(odd_docs).collect())) == plain(rows)


def test_no_rows(no_docs):
    assert audit(no_docs).collect() == []


@pytest.mark.parametrize("run_bytes", [1, 10**9])
def test_runs_are_in_order_and_merge_to_the_counts(monkeypatch, run_bytes):
    monkeypatch.setattr(divergence, "BLOCK_TERMS", 50)
    monkeypatch.setattr(divergence, "RUN_BYTES", run_bytes)
    rows = [(lang or "", source or "", text) for lang, source, text in made(200, 2)]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["lang", "source", "text"])
    out = [r for b in divergence._index(iter([batch])) for r in b.to_pylist()]
    found = defaultdict(lambda: [0, 0])
    for r in out:
        found[r["lang"], r["source"], r["term"]][0] += r["count"]
        found[r["lang"], r["source"], r["term"]][1] += r["docs"]
    assert len(out) == len(found) if run_bytes > 1 else len(out) > len(found)
    if run_bytes > 1:
        keys = [(r["lang"], r["source"], r["term"].encode()) for r in out]
        assert all(a < b for a, b in zip(keys, keys[1:]) if a[:2] == b[:2])
    want = defaultdict(lambda: [0, 0])
    for lang, source, text in rows:
        want[lang, source, ""][1] += 1
        for t, n in Counter(terms_of(text)).items():
            want[lang, source, t][0] += n
            want[lang, source, t][1] += 1
    assert found == want


def test_a_long_text_is_one_document(monkeypatch):
    monkeypatch.setattr(divergence, "BLOCK_TERMS", 100)
    text = prose(3, 60_000) * 4
    batch = pa.RecordBatch.from_arrays([pa.array([x]) for x in ("en", "s", text)], names=["lang", "source", "text"])
    rows = [r for b in divergence._index(iter([batch])) for r in b.to_pylist()]
    assert {r["term"]: (r["count"], r["docs"]) for r in rows if r["term"]} == {t: (n, 1) for t, n in Counter(terms_of(text)).items()}


@pytest.mark.parametrize("size", [1, 3, 1000])
def test_corrections_do_not_depend_on_batches(size):
    draw = random.Random(7)
    rows = [{"lang": lang, "source": s, "term": f"t{t}", "p": draw.randrange(1, 10**9), "p0": draw.randrange(1, 10**6)} for lang in ("a", "b") for t in range(20) for s in "xyzw" if draw.random() < 0.7]
    table = pa.Table.from_pylist(rows)
    got = Counter()
    for out in corrections(iter(table.to_batches(max_chunksize=size))):
        for r in out.to_pylist():
            got[r["lang"], r["source"], r["item"]] += r["value"]
    f = lambda p, q: (p - q) ** 2 // q
    want = Counter()
    for x in rows:
        for y in rows:
            if x["lang"] == y["lang"] and x["term"] == y["term"] and x["source"] != y["source"]:
                want[x["lang"], x["source"], y["source"]] += f(x["p"], y["p"]) - f(x["p"], y["p0"]) - f(x["p0"], y["p"]) + f(x["p0"], y["p0"])
    assert got == want


def test_a_term_of_many_sources(spark):
    rows = [("en", f"s{i}", "common " * (i % 5 + 1) + f"rare{chr(97 + i % 3)}") for i in range(120)]
    docs = spark.createDataFrame(rows, "lang string, source string, text string")
    assert sorted(map(tuple, audit(docs).collect())) == plain(rows)
