"""Rules and character models of URLs, against their SQL and plain counts."""

import math
import random
import re
from collections import Counter, defaultdict

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from hitledger.llm.queries import URL_RULES
from hitledger.llm.url_filter import UNIT, cutoff, host_path_text, judge, judge_sql, rule_of, score, train

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest)[0]
    return host.translate(LOWER), re.split("[?#]", rest[len(host) :])[0]


def plain_rule(host, path):
    best = (None, None)
    for h, p, v in URL_RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p) and len(h + p) > len(best[0] or ""):
            best = h + p, v
    return best


ODD = [
    None, "", "no scheme", "://", "http://", "http://net", "http://net/", "HTTP://A.NET/x?y=/en/", "x://example.net/en/1", "x://EXAMPLE.net/EN/",
    "x://badexample.net/en/", "x://a.example.net/en/?q#f", "x://example.com/de/", "x://example.com/de", "x://example.org/fr/1", "x://org/fr/",
    "x://org?/fr/", "x://net#/", "x://a.b://c.net/d", "x://ünï.net/é/😀", "x://example.net:80/en/", "x://notorg/fr/", "x://.net/", "x://É.NET/a\nb",
]


def test_parts_and_rules(spark):
    df = spark.createDataFrame([(u,) for u in ODD], "url string")
    host, path, _ = host_path_text(F.col("url"))
    rows = df.select("url", host.alias("host"), path.alias("path")).select("*", *(c.alias(n) for c, n in zip(rule_of(F.col("host"), F.col("path"), URL_RULES), ("rule", "verdict"))))
    for r in rows.collect():
        assert (r.host, r.path) == plain_parts(r.url)
        assert (r.rule, r.verdict) == plain_rule(r.host, r.path)


def plain_model(texts, order):
    """Probability of a character after a context, interpolated by class."""
    counts = {x: defaultdict(Counter) for x in ("allow", "block")}
    for text, x in texts:
        padded = "\x02" * order + text + "\x03"
        for i in range(order, len(padded)):
            for k in range(order + 1):
                counts[x][padded[i - k : i]][padded[i]] += 1
    base = 1 / (len({c for x in counts.values() for c in x[""]}) + 1)

    def p(x, context, c):
        below = p(x, context[1:], c) if context else base
        seen = counts[x].get(context)
        return below if not seen else (seen[c] + len(seen) * below) / (seen.total() + len(seen))

    return p


@pytest.mark.parametrize("order", [1, 4])
def test_scores_are_those_of_interpolated_models(spark, order):
    draw = random.Random(order)
    made = [("".join(draw.choice("abcé/.😀"[: 4 + 3 * (i % 2)]) for _ in range(draw.randrange(12))), ("allow", "block")[i % 2]) for i in range(80)]
    new = ["", "a", "xyz", "abcabc", "é😀/", "q" * 30, "ab.ab/z"]
    model = train(spark.createDataFrame(made, "text string, verdict string"), order).persist()
    texts = spark.createDataFrame([(t, t) for t in [*new, *{t for t, _ in made}] if t or True], "id string, text string").distinct()
    p = plain_model(made, order)
    for limit in (10**6, 0):
        for r in score(texts, model, ["id"], order, broadcast_rows=limit).collect():
            padded = "\x02" * order + r.id + "\x03"
            pairs = [(padded[i - order : i], padded[i]) for i in range(order, len(padded))]
            want = sum(math.log(p("allow", *x)) - math.log(p("block", *x)) for x in pairs)
            assert r.chars == len(pairs) and abs(r.score / UNIT - want) < 1e-5 * len(pairs)


def test_the_cutoff_has_the_fewest_errors(spark):
    draw = random.Random(3)
    rows = [("allow" if draw.random() < 0.6 else "block", draw.randrange(-40, 40)) for _ in range(300)]
    rows = [(v, (s + (15 if v == "allow" else 0)) * 10_000, 1) for v, s in rows]
    got = cutoff(spark.createDataFrame(rows, "verdict string, score long, chars long"))
    good, bad = sum(v == "allow" for v, *_ in rows), sum(v == "block" for v, *_ in rows)

    def wrong(step):
        return sum(v == "allow" and s // 10_000 < step for v, s, _ in rows) * bad + sum(v == "block" and s // 10_000 >= step for v, s, _ in rows) * good

    assert wrong(got) == min(map(wrong, range(-60, 60))) and wrong(got - 1) > wrong(got)
    assert cutoff(spark.createDataFrame([("allow", 1, 1)], "verdict string, score long, chars long")) is None


def sql(rows, **options):
    pages = pd.DataFrame(rows, columns=["page_id", "url"])
    con = duckdb.connect()
    con.register("frame", pages)
    con.execute("CREATE VIEW pages AS SELECT CAST(page_id AS BIGINT) AS page_id, CAST(url AS VARCHAR) AS url FROM frame")
    return sorted(con.execute(judge_sql(URL_RULES, **options)).fetchall(), key=repr)


def urls(n):
    draw = random.Random(n)
    for i in range(n):
        good = draw.random() < 0.5
        top = draw.choice(("net", "org", "com"))
        host = f"{draw.choice(('news', 'books', 'paper') if good else ('pills', 'bets', 'casino'))}{draw.randrange(50)}.example.{top}"
        # The rules reject all of net but its pages in English.
        lang = draw.choice(("en", "fr" if top != "net" else "en")) if good else draw.choice(("de", "xx"))
        yield i, f"https://{host}/{lang}/{draw.randrange(10**draw.randrange(1, 5))}"


@pytest.mark.parametrize("options", [{}, {"order": 2, "train_urls": 40}])
def test_odd_pages(spark, options):
    rows = [*urls(400), *((1000 + i, u) for i, u in enumerate(ODD)), (None, "x://example.net/en/1"), (7, "x://m.example.com/de/q"), (7, "x://m.example.com/de/q"), (8, "x://long.com/" + "ab/" * 30_000)]
    pages = spark.createDataFrame([(*r, "clash", "clash", 1) for r in rows], "page_id long, url string, id string, text string, verdict int").repartition(3)
    got = sorted(map(tuple, judge(pages, URL_RULES, **options).collect()), key=repr)
    assert got == sql(rows, **options)
    assert {v for *_, rule, v in got if rule is None} == {"allow", "block"}


def test_urls_like_the_rejected_ones_are_rejected(spark):
    draw, rows = random.Random(11), []
    for i in range(4000):
        good = draw.random() < 0.5
        word = draw.choice(("news", "books", "paper") if good else ("pills", "bets", "casino"))
        # Under a rule by their path, which tells the classes apart; the others only by their words.
        path = draw.choice(("a/", "b/")) if good else draw.choice(("a/", "c/"))
        rows.append((i, good, f"https://{word}{draw.randrange(50)}.net/{path}{draw.randrange(1000)}"))
    pages = spark.createDataFrame(rows, "page_id long, good boolean, url string")
    judged = judge(pages, [("net", "/b/", "allow"), ("net", "/c/", "block")]).where("rule IS NULL").join(pages, "page_id").collect()
    right = [(r.verdict == "allow") == r.good for r in judged]
    assert len(right) > 1500 and sum(right) > 0.95 * len(right)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, "x://a.net/"), (2, "x://b.com/")], [(1, "x://example.net/en/"), (2, "y")]])
def test_too_few_urls_to_learn_from(spark, rows):
    got = sorted(map(tuple, judge(spark.createDataFrame(rows, "page_id long, url string"), URL_RULES).collect()), key=repr)
    assert got == sql(rows) and all(v == "allow" for *_, rule, v in got if rule is None)


def test_no_python_in_the_plan(spark, sf_dir, plan_of):
    plan = plan_of(judge(spark.read.parquet(f"{sf_dir}/pages.parquet"), URL_RULES))
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
