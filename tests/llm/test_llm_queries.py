"""Every registered query over the smallest tables: against its SQL, or a plain version."""

import glob
import hashlib
import os
import zlib
from collections import defaultdict

import duckdb
import public_tokenizers
import pytest
from test_kneser_ney import brute, scores
from test_mixing import plain_targets
from test_pii import plain as plain_spans
from test_quality import plain as plain_measures
from test_sharding import check as check_shards
from tokenizers import Tokenizer

from hitledger.llm import pii
from hitledger.llm.html_text import visible_text
from hitledger.llm.queries import ORACLE_SQL, QUERIES

TYPES = {"int": "INTEGER", "bigint": "BIGINT", "boolean": "BOOLEAN", "string": "VARCHAR"}


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").collect()


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLE_SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", ORACLE_SQL)
def test_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for file in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(file)[:-8]} AS SELECT * FROM '{file}'")
    df = QUERIES[name](spark, sf_dir)
    relation = con.execute(ORACLE_SQL[name])
    columns = {d[0]: str(d[1]) for d in relation.description}
    assert {c: TYPES[kind] for c, kind in df.dtypes} == columns
    assert sorted(map(tuple, df.select(*columns).collect()), key=repr) == sorted(relation.fetchall(), key=repr)


def test_op2(spark, sf_dir, docs):
    held = {r.doc_id for r in docs if zlib.crc32(str(r.doc_id).encode()) % 7 == 2}
    texts = {r.doc_id: " ".join(x.decode() for x in (r.text or "").encode().split()) for r in docs}
    lower = {d: "".join(c.lower() if c.isascii() else c for c in t) for d, t in texts.items()}
    # Words are split at ASCII blanks only; plain split() would see more.
    code = {}
    coded = {d: " ".join(f"w{code.setdefault(w, len(code))}" for w in t.split(" ") if w) for d, t in lower.items()}
    p, raw = brute([t for d, t in coded.items() if d not in held], 2)
    for r in QUERIES["op2_kneser_ney"](spark, sf_dir).collect():
        want = scores(p, raw, coded[r.doc_id], 2)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (r.doc_id in held, *want[:2], sum(raw.values()))
        assert r.base_score == pytest.approx(want[2], rel=1e-9) and r.score == pytest.approx(want[3], rel=1e-6)


def test_op3(spark, sf_dir, docs):
    text = {r.doc_id: r.text or "" for r in docs}
    for r in QUERIES["op3_pii"](spark, sf_dir).collect():
        base = sorted(plain_spans(text[r.doc_id]))
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(s[0] == k for s in base) for k in range(4))
        assert r.base_sha256 == hashlib.sha256(pii.listed(base).encode()).hexdigest()
        assert set(filter(None, pii.listed(base).split(","))) <= set(filter(None, r.spans.split(",")))


def test_op4(spark, sf_dir, docs):
    text = {r.doc_id: r.text for r in docs}
    rows = QUERIES["op4_quality_rules"](spark, sf_dir).collect()
    assert len(rows) == len(docs)
    for r in rows:
        n, chars, symbols, _, dup, repeated = plain_measures(text[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, dup, repeated)
        assert r.base_failed == (n < 50 or 100 * repeated > 50 * n)
        assert not (r.kept and r.base_failed)


def test_op6(spark, sf_dir):
    page = {r.page_id: r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    rows = QUERIES["op6_html_text"](spark, sf_dir).collect()
    assert {r.page_id: r.text for r in rows} == {i: visible_text(h) for i, h in page.items()}


def encoded(docs, name, end):
    plain = Tokenizer.from_file(public_tokenizers.path(name))
    return {r.doc_id: plain.encode(r.text or "", add_special_tokens=False).ids + [end] for r in docs}


def crc(ids):
    return zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))


def test_op7(spark, sf_dir, docs):
    ids = encoded(docs, "word_bpe_49k.json", 2)
    rows = QUERIES["op7_packing"](spark, sf_dir).collect()
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        own = ids[r.doc_id]
        assert r.doc_tokens == len(own) and r.ids_crc32 == crc(own[r.start : r.start + r.length])
        sequences[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append((r.start, r.length))
    for parts, whole in [*((x, None) for x in sequences.values()), *((pieces[d], len(x)) for d, x in ids.items())]:
        at = 0
        for start, length in sorted(parts):
            assert start == at and length > 0
            at += length
        assert at <= 4096 if whole is None else at == whole
    sizes = [sum(n for _, n in parts) for parts in sequences.values()]
    padding = sum(4096 - s for s in sizes if s & (s - 1))
    assert padding < 0.02 * sum(sizes) + 4096


def test_op8(spark, sf_dir, docs):
    rows = QUERIES["op8_mixing"](spark, sf_dir).collect()
    sizes, goal = plain_targets([(r.doc_id, r.text, None, r.source) for r in docs])
    source = {r.doc_id: r.source for r in docs}
    taken = defaultdict(int)
    for r in rows:
        s = source[r.doc_id]
        assert (r.source_size, r.target) == (sizes[s], pytest.approx(float(goal[s])))
        assert 0 <= r.taken <= 3 * r.size
        taken[s] += r.taken
    assert len(rows) == len(docs) and all(abs(taken[s] - t) <= 0.5 for s, t in goal.items())


def test_op9(spark, sf_dir, docs):
    ids = encoded(docs, "byte_bpe_50k.json", 0)
    rows = sorted(QUERIES["op9_grammar_ids"](spark, sf_dir).collect(), key=lambda r: r.doc_id)
    at = 0
    for r, d in zip(rows, sorted(ids), strict=True):
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (d, at, len(ids[d]), crc(ids[d]))
        at += r.n_tokens


def test_op10(spark, sf_dir, docs):
    rows = QUERIES["op10_sharding"](spark, sf_dir).collect()
    check_shards(rows, [r.text for r in docs], 40)
    assert {(r.law, r.grown_shard) for r in rows} == {("bytes", None)}
