"""Forms of fill-in-the-middle against a plain version that walks the text."""

import hashlib
import random
import re

import pytest
from conftest import prose
from pyspark.sql import functions as F

from hitledger.llm import fill_middle
from hitledger.llm.fill_middle import arranged, restored

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain(doc_id, text, rate=50, spm=80, seed=42):
    text = text or ""
    units = UNIT.findall(text)
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    n = len(units)
    if text == "" or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < spm:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_texts_of_all_kinds():
    draw = random.Random(5)
    forms = set()
    for i in range(3000):
        text = "".join(draw.choice(["a", "bé", " ", "\n", " ", "\x1f", "<", "P>", "<S", ">", "😀", "\r\n"]) for _ in range(draw.randrange(30)))
        got = arranged(text, str(i), 42, 100, 50)
        assert got == plain(i, text, 100, 50)
        forms.add(got[1])
    assert forms == {"plain", "psm", "spm"}


@pytest.mark.parametrize("piece", [1, 7, 1000])
def test_long_texts_in_pieces_have_the_same_units(monkeypatch, piece):
    monkeypatch.setattr(fill_middle, "PIECE", piece)
    for i, text in enumerate([prose(1, 3000), " \n" * 500 + "x", "x" * 5000, "a b  ", " " * 3000, "a  " * 1000]):
        assert arranged(text, str(i), 42, 100, 50) == plain(i, text, 100, 50)


def test_a_text_of_a_million_words_takes_little_memory():
    import tracemalloc

    text = "word " * 1_000_000
    tracemalloc.start()
    got = arranged(text, "1", 42, 100, 50)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got[0] == 1_000_001 and most < 100e6


def test_odd_rows(odd_docs, odd_rows):
    rows = fill_middle.fill_middle(odd_docs, "M", rate=100, spm_rate=50)
    # A column of the output's name in another case is replaced.
    assert rows.columns == [*(c for c in odd_docs.columns if c != "m"), "M"]
    back = rows.select("doc_id", "text", "M.*", restored(F.col("M.output"), F.col("M.form")).alias("back")).collect()
    assert len(back) == len(odd_rows)
    for r in back:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == plain(r.doc_id, r.text, 100, 50)
        assert r.back == (r.text or "")


def test_no_rows(no_docs):
    rows = fill_middle.fill_middle(no_docs, "fim")
    assert rows.collect() == [] and rows.columns == [*no_docs.columns, "fim"]


def test_markers_in_the_text_and_beside_the_cuts(spark):
    texts = ["<P>", "a <S> b", "<", "<P <S <M", "P> S> M>", "<<< >>> <S", "a<", "<M> "]
    docs = spark.createDataFrame([(i, t) for i in range(40) for t in texts], "doc_id long, text string")
    rows = fill_middle.fill_middle(docs, "f", rate=100, spm_rate=50).select("doc_id", "text", "f.*", restored(F.col("f.output"), F.col("f.form")).alias("back"))
    for r in rows.collect():
        assert r.back == r.text and (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == plain(r.doc_id, r.text, 100, 50)
