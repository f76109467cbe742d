"""Filtering URLs by rules and, where none fits, by two character models; DataFrame operations only.

A rule has a host and the start of a path; it fits its host and all subdomains of it, and the longest
rule that fits decides. URLs under a rule are also what the models learn from: one model of accepted
and one of rejected URLs, each a variable-order Markov model of up to ``ORDER`` characters of context.

1. Each different URL (host in lower case, and what follows it) stands once, with the first half of
   its md5 choosing sample and side: half of the URLs under a rule train, the others calibrate.
2. The training URLs' windows of ``ORDER + 1`` characters are counted per class, their suffixes from
   the windows' counts. Probabilities are interpolated from no context upwards (Witten-Bell: a context
   with T different followers in N leaves T / (N + T) to the shorter context). The model is one table
   of strings: as a gram, the logarithm of accepted over rejected probability; as a context, what
   leaving it for the shorter one costs, accepted less rejected. A character that neither class saw
   after a context is scored by the longest known one plus these costs, which is the interpolation.
3. Scores are whole millionths, so that sums don't depend on their order. A URL's score is divided by
   its characters and put into steps of 0.01.
4. The cutoff is the step with the smallest sum of both classes' error rates over *all* calibration
   URLs, counted in steps; of equals the lowest, which rejects least, and of the steps between two that
   have URLs the middle. Without URLs of both classes on both sides everything that no rule fits is
   accepted.

Only the models are fitted on a bounded sample: about ``TRAIN_URLS`` different URLs a class, chosen by
hash. The model table is counted and broadcast up to ``BROADCAST_ROWS`` strings; beyond that the same
joins are left to the session, whose run-time skew splitting parts the hot strings' rows. Equal URLs
are scored once. Windows stay in the task of their URL, which passes one sum on. What the driver gets
are class counts and at most 4,001 steps.

Nulls and odd input: a null URL, or one without ``://``, has empty host and path, so no rule fits; it
is judged by its text, empty for null. A URL of any length is split into characters once, in linear
time. Repeated rows get equal verdicts, one each; no rows give no rows. Only the id and the URL are
read, so other columns can't clash.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitledger.llm.shared import stored

# Host, start of the path, verdict.
Rule = tuple[str, str, str]

ALLOW, BLOCK = "allow", "block"

ORDER = 4
# Different URLs of a class that a model is trained on, about; the rest of the training side is left out.
TRAIN_URLS = 20_000
# Strings of the model up to which it is broadcast; some 40 bytes each.
BROADCAST_ROWS = 500_000

_START, _END = "\x02", "\x03"
UNIT, STEP, MOST_STEPS = 1_000_000, 10_000, 2_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_path_text(url: Column) -> tuple[Column, Column, Column]:
    """Host and path, empty where there is no ``://``, and the text that the models see."""
    at, length = F.locate("://", url), F.char_length(url)
    rest = F.when(at > 0, F.substring(url, at + 3, length))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    after = F.substring(rest, F.char_length(host) + 1, length)
    path = F.regexp_extract(after, "^[^?#]*", 0)
    host = F.translate(host, _UPPER, _LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit("")), F.coalesce(F.concat(host, after), url, F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """The longest rule that fits, as host and path in one, and its verdict; null if none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule_host, rule_path, decision in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == rule_host) | F.endswith(host, F.lit("." + rule_host))) & F.startswith(path, F.lit(rule_path))
        name, verdict = (F.when(fits, F.lit(value)).otherwise(old) for value, old in ((rule_host + rule_path, name), (decision, verdict)))
    return name, verdict


def _windows(text: Column, order: int) -> Column:
    """Every ``order + 1`` characters in a row of the text with marks around it; one per character and for the end.

    Shifted copies joined element by element: linear in the text, whose characters are not looked up one by one.
    """
    chars = F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, ""))
    chars = F.concat(F.array_repeat(F.lit(_START), order), chars, F.array(F.lit(_END)))
    shifted = [F.slice(chars, 1 + j, F.size(chars) - order) for j in range(order + 1)]
    return reduce(lambda a, b: F.zip_with(a, b, lambda x, y: F.concat(x, y)), shifted)


def _suffix(column: str, order: int, length: int, skip: int = 0) -> Column:
    """Of a window, the ``length`` characters that end ``skip`` before its end."""
    return F.substring(column, order + 2 - length - skip, length)


def train(texts: DataFrame, order: int = ORDER) -> DataFrame:
    """The model of ``texts`` (text, verdict): strings ``s`` with ``d`` as a gram and ``b`` as a context, in millionths."""
    count = {"a": F.sum((F.col("verdict") == ALLOW).cast("long")), "r": F.sum((F.col("verdict") == BLOCK).cast("long"))}
    windows = texts.select("verdict", F.explode(_windows(F.col("text"), order)).alias("w")).groupBy("w").agg(*(c.alias(x) for x, c in count.items()))
    suffixes = F.explode(F.array(*(_suffix("w", order, length) for length in range(1, order + 2))))
    grams = stored(windows.select(suffixes.alias("s"), "a", "r").groupBy("s").agg(F.sum("a").alias("a"), F.sum("r").alias("r")), "grams")

    context = F.expr("left(s, char_length(s) - 1)").alias("c")
    left = [x for side in "ar" for x in (F.sum(side).alias(f"n_{side}"), F.count_if(F.col(side) > 0).alias(f"t_{side}"))]
    contexts = stored(grams.select(context, "a", "r").groupBy("c").agg(*left), "contexts")
    base = 1.0 / (grams.where(F.char_length("s") == 1).count() + 1)

    levels = []
    shorter = None
    for length in range(1, order + 2):
        rows = grams.where(F.char_length("s") == length).select("s", "a", "r", context).join(contexts, "c")
        if shorter is None:
            rows = rows.withColumns({"q_a": F.lit(base), "q_r": F.lit(base)})
        else:
            below = shorter.select(F.col("s").alias("tail"), F.col("p_a").alias("q_a"), F.col("p_r").alias("q_r"))
            rows = rows.join(below, F.expr("right(s, char_length(s) - 1)") == F.col("tail"))
        smooth = {f"p_{x}": F.expr(f"CASE WHEN n_{x} = 0 THEN q_{x} ELSE (double({x}) + double(t_{x}) * q_{x}) / double(n_{x} + t_{x}) END") for x in "ar"}
        shorter = rows.withColumns(smooth).select("s", "p_a", "p_r")
        if length <= order:
            shorter = stored(shorter, "gram-odds")
        levels.append(shorter)
    odds = reduce(DataFrame.unionAll, levels).select("s", F.round(F.lit(float(UNIT)) * (F.log("p_a") - F.log("p_r"))).cast("long").alias("d"))
    leave = {x: f"CASE WHEN n_{x} = 0 THEN 0.0D ELSE ln(double(t_{x}) / double(n_{x} + t_{x})) END" for x in "ar"}
    costs = contexts.select(F.col("c").alias("s"), F.expr(f"CAST(round({float(UNIT)}D * ({leave['a']} - {leave['r']})) AS LONG)").alias("b"))
    return odds.join(costs, "s", "full")


def score(texts: DataFrame, model: DataFrame, keep: Sequence[str], order: int = ORDER, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``keep`` of each different row of ``texts`` with ``score`` in millionths and ``chars``, the end counted.

    ``keep`` names small columns only: they go with every character. ``model`` is read several times.
    """
    size, nothing = model.agg(F.count("*"), F.max(F.when(F.col("s") == "", F.col("b")))).first()
    small = F.broadcast if size <= broadcast_rows else lambda df: df
    rows = texts.select(*keep, F.explode(_windows(F.col("text"), order)).alias("w"))
    total = F.lit(nothing or 0)
    for length in range(1, order + 2):
        gram = model.select(F.col("s").alias(f"s{length}"), F.col("d").alias(f"d{length}"))
        rows = rows.join(small(gram), _suffix("w", order, length) == F.col(f"s{length}"), "left").drop(f"s{length}")
        if length > 1:
            context = model.select(F.col("s").alias(f"c{length}"), F.col("b").alias(f"b{length}"))
            rows = rows.join(small(context), _suffix("w", order, length - 1, skip=1) == F.col(f"c{length}"), "left").drop(f"c{length}")
            total = F.coalesce(f"b{length}", F.lit(0)) + total
        total = F.coalesce(F.col(f"d{length}"), total)
    return rows.groupBy(*keep).agg(F.sum(total).alias("score"), F.count("*").alias("chars"))


def step_of(score: str = "score", chars: str = "chars") -> Column:
    """The score per character in steps of 0.01, cut at 20 either way."""
    step = F.floor(F.col(score).cast("double") / (F.col(chars) * STEP).cast("double"))
    return F.greatest(F.lit(-MOST_STEPS), F.least(F.lit(MOST_STEPS), step)).cast("int")


def cutoff(scored: DataFrame) -> int | None:
    """The lowest step that is accepted, from ``scored`` (verdict, score, chars) of calibration URLs."""
    counts = scored.groupBy(step_of().alias("step")).agg(F.count_if(F.col("verdict") == ALLOW).alias("a"), F.count_if(F.col("verdict") == BLOCK).alias("r"))
    steps = sorted(map(tuple, counts.collect()))
    good, bad = sum(s[1] for s in steps), sum(s[2] for s in steps)
    if not good or not bad:
        return None
    best, lost, passed, before = None, 0, bad, steps[0][0]
    for step, a, r in [*steps, (steps[-1][0] + 1, 0, 0)]:
        # Both rates over their common denominator.
        wrong = lost * bad + passed * good
        if best is None or wrong < best[0]:
            best = wrong, (before + step + 1) // 2
        lost, passed, before = lost + a, passed - r, step
    return best[1]


def _hash(first: int, digits: int) -> Column:
    return F.conv(F.substring("id", first, digits), 16, 10).cast("long")


def judge(
    pages: DataFrame, rules: Sequence[Rule], page_id: str = "page_id", url: str = "url", order: int = ORDER, train_urls: int = TRAIN_URLS
) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every row."""
    host, path, text = host_path_text(F.col(url))
    parted = pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"), text.alias("text"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = parted.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("verdict"), "text", F.md5("text").alias("id"))

    texts = stored(rows.select("id", "text", "verdict").distinct().withColumn("learns", F.col("verdict").isNotNull() & (_hash(9, 1) < 8)), "urls")
    number = {r.verdict: r.n for r in texts.where("learns").groupBy("verdict").agg(F.count("*").alias("n")).collect()}
    lowest = None
    if ALLOW in number and BLOCK in number:
        part = F.lit(0)
        for name, n in number.items():
            part = F.when(F.col("verdict") == name, min(1 << 32, train_urls * (1 << 32) // n)).otherwise(part)
        model = stored(train(texts.where(F.col("learns") & (_hash(1, 8) < part)), order), "url-model")
        scored = stored(score(texts.where("NOT learns"), model, ["id", "verdict"], order), "url-scores")
        lowest = cutoff(scored.where(F.col("verdict").isNotNull()))
    if lowest is None:
        return rows.select("page_id", "host", "path", "rule", F.coalesce("verdict", F.lit(ALLOW)).alias("verdict"))
    judged = scored.where(F.col("verdict").isNull()).select("id", F.when(step_of() >= lowest, ALLOW).otherwise(BLOCK).alias("judged"))
    # Rows under a rule go past the join, which has one row for every text without a rule.
    found = rows.withColumn("id", F.when(F.col("verdict").isNull(), F.col("id"))).drop("text").join(judged, "id", "left")
    return found.select("page_id", "host", "path", "rule", F.coalesce("verdict", "judged").alias("verdict"))


def judge_sql(rules: Sequence[Rule], order: int = ORDER, train_urls: int = TRAIN_URLS, pages: str = "pages") -> str:
    """The same verdicts in DuckDB's SQL, worked out with one join per string and class."""
    fits = [
        (f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')", h + p, v) for h, p, v in sorted(rules, key=lambda r: -len(r[0] + r[1]))
    ]
    name = " ".join(f"WHEN {test} THEN '{rule}'" for test, rule, _ in fits)
    verdict = " ".join(f"WHEN {test} THEN '{v}'" for test, _, v in fits)
    rest = "substr(url, strpos(url, '://') + 3)"
    host = f"translate(regexp_extract({rest}, '^[^/?#]*'), '{_UPPER}', '{_LOWER}')"
    tables = [
        f"""parted AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN {host} ELSE '' END AS host,
    CASE WHEN contains(url, '://') THEN regexp_extract({rest}, '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path,
    CASE WHEN contains(url, '://') THEN {host} || regexp_extract({rest}, '(?s)^[^/?#]*(.*)', 1) ELSE coalesce(url, '') END AS text
  FROM (SELECT page_id, coalesce(url, '') AS url FROM {pages})
)""",
        f"ruled AS (SELECT *, CASE {name} END AS rule, CASE {verdict} END AS verdict FROM parted)",
        """texts AS (
  SELECT *, verdict IS NOT NULL AND substr(md5(text), 9, 1) < '8' AS learns, CAST('0x' || substr(md5(text), 1, 8) AS BIGINT) AS h
  FROM (SELECT DISTINCT text, verdict FROM ruled)
)""",
        "sides AS (SELECT verdict, count(*) AS n FROM texts WHERE learns GROUP BY verdict)",
        f"""taught AS (
  SELECT text, verdict FROM texts JOIN sides USING (verdict) WHERE learns AND h < least(4294967296, {train_urls} * 4294967296 // n)
)""",
    ]

    def windows(source: str, columns: str) -> str:
        padded = f"repeat(chr(2), {order}) || text || chr(3)"
        return f"SELECT {columns}, unnest(list_transform(range(1, length(text) + 2), lambda i: substr({padded}, i, {order + 1}))) AS w FROM {source}"

    lengths = ", ".join(str(i) for i in range(1, order + 2))
    tables += [
        f"windows AS ({windows('taught', 'verdict')})",
        f"""grams AS (
  SELECT s, count(*) FILTER (verdict = 'allow') AS a, count(*) FILTER (verdict = 'block') AS r
  FROM (SELECT verdict, right(w, unnest([{lengths}])) AS s FROM windows) GROUP BY s
)""",
        """contexts AS (
  SELECT left(s, length(s) - 1) AS c, sum(a)::BIGINT AS n_a, count(*) FILTER (a > 0) AS t_a, sum(r)::BIGINT AS n_r, count(*) FILTER (r > 0) AS t_r
  FROM grams GROUP BY c
)""",
        "odds0 AS (SELECT '' AS s, 1.0::DOUBLE / (count(*) FILTER (length(s) = 1) + 1) AS p_a, 1.0::DOUBLE / (count(*) FILTER (length(s) = 1) + 1) AS p_r FROM grams)",
    ]
    smooth = ", ".join(f"CASE WHEN n_{x} = 0 THEN q.p_{x} ELSE ({x}::DOUBLE + t_{x}::DOUBLE * q.p_{x}) / (n_{x} + t_{x})::DOUBLE END AS p_{x}" for x in "ar")
    for length in range(1, order + 2):
        tail = "''" if length == 1 else f"right(g.s, {length - 1})"
        tables.append(
            f"odds{length} AS (SELECT g.s, {smooth} FROM grams g JOIN contexts ON c = left(g.s, {length - 1}) JOIN odds{length - 1} q ON q.s = {tail} WHERE length(g.s) = {length})"
        )
        tables.append(f"d{length} AS (SELECT s, CAST(round({UNIT}.0::DOUBLE * (ln(p_a) - ln(p_r))) AS BIGINT) AS d FROM odds{length})")
    leave = " - ".join(f"CASE WHEN n_{x} = 0 THEN 0.0 ELSE ln(t_{x}::DOUBLE / (n_{x} + t_{x})::DOUBLE) END" for x in "ar")
    total = "(SELECT coalesce(max(b), 0) FROM costs WHERE c = '')"
    joins = ""
    for length in range(1, order + 2):
        joins += f" LEFT JOIN d{length} ON d{length}.s = right(w, {length})"
        if length > 1:
            joins += f" LEFT JOIN costs b{length} ON b{length}.c = substr(w, {order + 2 - length}, {length - 1})"
            total = f"coalesce(b{length}.b, 0) + {total}"
        total = f"coalesce(d{length}.d, {total})"
    tables += [
        f"costs AS (SELECT c, CAST(round({UNIT}.0::DOUBLE * ({leave})) AS BIGINT) AS b FROM contexts)",
        f"seen AS ({windows('(SELECT * FROM texts WHERE NOT learns)', 'text, verdict')})",
        f"scored AS (SELECT text, verdict, sum({total})::BIGINT AS score, count(*) AS chars FROM seen{joins} GROUP BY text, verdict)",
        f"""steps AS (
  SELECT text, verdict, CAST(greatest(-{MOST_STEPS}, least({MOST_STEPS}, floor(score::DOUBLE / (chars * {STEP})::DOUBLE))) AS BIGINT) AS step FROM scored
)""",
        "held AS (SELECT step, count(*) FILTER (verdict = 'allow') AS a, count(*) FILTER (verdict = 'block') AS r FROM steps WHERE verdict IS NOT NULL GROUP BY step)",
        "cuts AS (SELECT step FROM held UNION SELECT max(step) + 1 FROM held HAVING count(*) > 0)",
        """errors AS (
  SELECT c.step, sum(CASE WHEN h.step < c.step THEN a ELSE 0 END) * (SELECT sum(r) FROM held)
    + sum(CASE WHEN h.step >= c.step THEN r ELSE 0 END) * (SELECT sum(a) FROM held) AS wrong
  FROM cuts c CROSS JOIN held h GROUP BY c.step
)""",
        f"""lowest AS (
  SELECT CASE WHEN (SELECT count(*) FROM sides) = 2 AND (SELECT sum(a) > 0 AND sum(r) > 0 FROM held)
    THEN (SELECT CAST(floor((coalesce(before, step) + step + 1) / 2.0) AS BIGINT) FROM (SELECT *, lag(step) OVER (ORDER BY step) AS before FROM errors) ORDER BY wrong, step LIMIT 1) ELSE -{MOST_STEPS} END AS step
)""",
    ]
    return (
        "WITH " + ",\n".join(tables) + "\nSELECT page_id, host, path, rule, coalesce(ruled.verdict, CASE WHEN steps.step >= lowest.step THEN 'allow' ELSE 'block' END) AS verdict\n"
        "FROM ruled CROSS JOIN lowest LEFT JOIN steps ON steps.text = ruled.text AND steps.verdict IS NULL AND ruled.verdict IS NULL"
    )

