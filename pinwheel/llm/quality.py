"""Quality rules: robust multivariate outliers, in DataFrame and SQL expressions only.

Base statistics of a text and two base rules come first (see ``base_statistics``). Texts that
pass get a statistic vector: ln words, ln mean word length, and the square roots of symbols
per word character, and of repeated lines, repeated words and echoes (words equal to the word
before) per word, in fixed point (multiples of 1/1024), so that sums are exact and don't
depend on their order.

A row is judged by its (language, source) if that has at least ``MIN_ROWS`` passing texts, else
by its language, else by all texts together; each of these groups is estimated from all its
rows. Location and scatter are minimum-covariance-determinant estimates: from each of several
starts (medians and quartile ranges; medians and the spread of all texts; means and standard
deviations), concentration steps keep the ``SHARE`` of the rows that lie nearest (by
Mahalanobis distance) and take mean and covariance of those, until no group's nearest rows
change any more (``MOST_STEPS`` at most); the start that ends with the least determinant counts.
The covariance is made consistent for normal data. Scales have floors, from quartiles of all
texts: for logarithms the scale of all texts; for the other statistics, which are zero for
most texts, what ``FEW`` symbols, lines or words make in a text of median length. A text is
kept if its squared distance is at most the chi-square quantile ``QUANTILE``.

Quantiles come from counts per value (medians) or per distance bin (the nearest rows), which
tasks pre-aggregate; a group's rows never meet in one task. Group estimates are joined back
by broadcast only up to ``BROADCAST_GROUPS`` groups.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from pinwheel.llm.common import saved

STATS = ("ln_words", "ln_length", "symbols", "lines", "repeats", "echoes")
MIN_ROWS, SHARE, MOST_STEPS, QUANTILE = 50, 0.75, 20, 0.9999
UNIT = 1024
FEW = 2
# Distances are cut into bins of 1/128; beyond the last bin no row is among the nearest.
BIN, LAST_BIN = 128, 1 << 17
BROADCAST_GROUPS = 20_000
N = len(STATS)


# ---- base statistics ----

def _let(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` bound to the value, which is computed once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _repeat_words() -> str:
    """Words that lie in an 8-word window found twice or more, of ``words``.

    Windows are compared by a 64-bit hash of their words' 64-bit hashes. Only a text with an
    equal pair sorts its windows; those with an equal neighbour are marked, and neighbouring
    marks that overlap are counted once.
    """
    windows = "transform(sequence(0, size(h) - 8), i -> xxhash64(slice(h, i + 1, 8)))"
    marked = ("filter(e, (x, i) -> (i > 0 AND e[i - 1].k = x.k) OR (i + 1 < size(e) AND e[i + 1].k = x.k))")
    pairs = _let("sort_array(transform(g, (k, i) -> named_struct('k', k, 'i', i)))", "e", f"sort_array(transform({marked}, x -> x.i))")
    covered = "aggregate(p, named_struct('n', 0, 'to', 0), (s, i) -> named_struct('n', s.n + i + 8 - greatest(s.to, i), 'to', i + 8), s -> s.n)"
    many = _let(windows, "g", f"CASE WHEN size(array_distinct(g)) = size(g) THEN 0 ELSE {_let(pairs, 'p', covered)} END")
    return f"CASE WHEN size(words) < 9 THEN 0 ELSE {_let('transform(words, w -> xxhash64(w))', 'h', many)} END"


BLANK = "[\\\\x20\\\\x09-\\\\x0D]"
NOT_BLANK = "[^\\\\x20\\\\x09-\\\\x0D]"


def base_statistics(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` without its text and with n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, n_echoes (long) and base_failed; columns of these names are replaced.

    A null or empty text has no words and fails the base rules.
    """
    words = f"filter(split(text, '{BLANK}+'), w -> w <> '')"
    lines = f"filter(split(text, '\\n', -1), l -> l RLIKE '{NOT_BLANK}')"
    echoes = "CASE WHEN size(words) < 2 THEN 0 ELSE size(filter(sequence(1, size(words) - 1), i -> words[i] = words[i - 1])) END"
    one = _let(words, "words", f"named_struct('n_words', CAST(size(words) AS BIGINT), 'word_chars', CAST(length(array_join(words, '')) AS BIGINT), "
                               f"'n_repeat_words', CAST({_repeat_words()} AS BIGINT), 'n_echoes', CAST({echoes} AS BIGINT))")
    new = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_echoes")
    names = [c for c in df.columns if c not in {*new, "base_failed", text_col}]
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    rows = rows.select("row", F.expr(one).alias("w"), F.expr("CAST(regexp_count(text, '[#*$%&|<>]') AS BIGINT)").alias("n_symbols"),
                       F.expr(_let(lines, "l", "CAST(size(l) - size(array_distinct(l)) AS BIGINT)")).alias("n_dup_lines"))
    failed = "w.n_words < 20 OR 100 * w.n_repeat_words > 30 * w.n_words"
    return rows.select(*[F.col(f"row.`{c}`").alias(c) for c in names], "w.n_words", "w.word_chars", "n_symbols", "n_dup_lines",
                       "w.n_repeat_words", "w.n_echoes", F.expr(failed).alias("base_failed"))


def statistic_sql() -> list[str]:
    """SQL of the statistic vector in units of 1/1024; only for texts with words."""
    per_word = "CAST({} AS DOUBLE) / n_words"
    raw = ("ln(CAST(n_words AS DOUBLE))", f"ln({per_word.format('word_chars')})", "sqrt(CAST(n_symbols AS DOUBLE) / word_chars)",
           f"sqrt({per_word.format('n_dup_lines')})", f"sqrt({per_word.format('n_repeat_words')})", f"sqrt({per_word.format('n_echoes')})")
    return [f"CAST(floor({r} * {UNIT} + 0.5) AS BIGINT)" for r in raw]


# ---- constants of the normal model ----

def chi2_cdf(x: float, k: int) -> float:
    """Series for the regularised lower incomplete gamma function at (k/2, x/2)."""
    a, z = k / 2, x / 2
    term = total = 1 / a
    n = 0
    while term > 1e-17 * total:
        n += 1
        term *= z / (a + n)
        total += term
    return total * math.exp(-z + a * math.log(z) - math.lgamma(a)) if z > 0 else 0.0


def chi2_quantile(p: float, k: int) -> float:
    low, high = 0.0, 200.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_cdf(mid, k) < p else (low, mid)
    return high


CUTOFF = round(chi2_quantile(QUANTILE, N), 6)
CONSISTENCY = round(SHARE / chi2_cdf(chi2_quantile(SHARE, N), N + 2), 6)


# ---- SQL shared by all steps (valid in Spark and in DuckDB) ----

def _num(v: float) -> str:
    return f"CAST({v!r} AS DOUBLE)"


def floor_columns() -> list[tuple[str, str]]:
    """Least scales f_i from the quartiles lo_i, mid_i, hi_i of all passing texts."""
    words = f"{_num(math.sqrt(FEW))} * exp(CAST(mid0 AS DOUBLE) / {_num(-2.0 * UNIT)})"
    chars = f"{_num(math.sqrt(FEW))} * exp(CAST(mid0 + mid1 AS DOUBLE) / {_num(-2.0 * UNIT)})"
    logs = [f"greatest((hi{i} - lo{i}) / {_num(1.349)}, {_num(1.0)}) / {_num(UNIT)}" for i in range(2)]
    return [(f"f{i}", sql) for i, sql in enumerate([*logs, chars, words, words, words])]


STARTS = 3


def start_columns(start: int) -> list[tuple[str, str]]:
    """Mean and Cholesky factor (diagonal) of a start from quartiles lo_i, mid_i, hi_i, sums n, s_i
    and p_ii, and floors f_i."""
    n = "CAST(n AS DOUBLE)"
    mean = "{0} / " + n
    cols = [(f"m{i}", (mean.format(f"CAST(s{i} AS DOUBLE)") if start == 2 else f"CAST(mid{i} AS DOUBLE)") + f" / {_num(UNIT)}") for i in range(N)]
    for i in range(N):
        scale = (f"(hi{i} - lo{i}) / {_num(UNIT * 1.349)}", "0",
                 f"sqrt(greatest(CAST(p{i}{i} AS DOUBLE) / {n} - CAST(s{i} AS DOUBLE) / {n} * (CAST(s{i} AS DOUBLE) / {n}), {_num(0.0)})) / {_num(UNIT)}")[start]
        cols += [(f"l{i}{j}", f"greatest({scale}, f{i})" if i == j else _num(0.0)) for j in range(i + 1)]
    return cols


def moment_columns() -> list[tuple[str, str]]:
    """Mean and covariance c_ij from n, sums s_i, sums of products p_ij and floors f_i."""
    n = "CAST(n AS DOUBLE)"
    cols = [(f"m{i}", f"CAST(s{i} AS DOUBLE) / {n} / {_num(UNIT)}") for i in range(N)]
    for i in range(N):
        for j in range(i + 1):
            cov = f"(CAST(p{i}{j} AS DOUBLE) / {n} - CAST(s{i} AS DOUBLE) / {n} * (CAST(s{j} AS DOUBLE) / {n})) / {_num(UNIT ** 2)} * {_num(CONSISTENCY)}"
            cols.append((f"c{i}{j}", f"greatest({cov}, f{i} * f{i})" if i == j else cov))
    return cols


def cholesky_steps() -> list[tuple[str, str]]:
    """Columns l_ij, each from those before it."""
    steps = []
    for j in range(N):
        less = "".join(f" - l{j}{k} * l{j}{k}" for k in range(j))
        steps.append((f"l{j}{j}", f"sqrt(greatest(c{j}{j}{less}, {_num(1e-9)}))"))
        for i in range(j + 1, N):
            less = "".join(f" - l{i}{k} * l{j}{k}" for k in range(j))
            steps.append((f"l{i}{j}", f"(c{i}{j}{less}) / l{j}{j}"))
    return steps


def distance_steps() -> list[tuple[str, str]]:
    """Columns y_i (forward substitution) and d2, from v_i, m_i and l_ij."""
    steps = []
    for i in range(N):
        less = "".join(f" - l{i}{k} * y{k}" for k in range(i))
        steps.append((f"y{i}", f"(v{i} / {_num(UNIT)} - m{i}{less}) / l{i}{i}"))
    return [*steps, ("d2", " + ".join(f"y{i} * y{i}" for i in range(N)))]


BIN_SQL = f"CAST(least(floor(sqrt(d2) * {BIN}), {LAST_BIN}) AS BIGINT)"
STATE = [f"m{i}" for i in range(N)] + [f"l{i}{j}" for i in range(N) for j in range(i + 1)]
FLOORS = [f"f{i}" for i in range(N)]
SUMS = [f"s{i}" for i in range(N)] + [f"p{i}{j}" for i in range(N) for j in range(i + 1)]
#: Logarithm of the square root of the determinant.
SPREAD_SQL = " + ".join(f"ln(l{i}{i})" for i in range(N))


# ---- the estimates ----

def _with(df: DataFrame, steps: list[tuple[str, str]]) -> DataFrame:
    for name, sql in steps:
        df = df.withColumn(name, F.expr(sql))
    return df


def _measured(rows: DataFrame, state: DataFrame, few: bool) -> DataFrame:
    """``rows`` with their squared distance d2 from their group's estimates."""
    return _with(rows.join(F.broadcast(state) if few else state, "grp"), distance_steps())


def group_of(rows: DataFrame) -> tuple[DataFrame, bool]:
    """``rows`` (lang, source, ...) with ``grp``, the group that judges the row, and ``grps``, the
    groups that count it in (those that judge some row); whether groups are few enough to
    broadcast."""
    name = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-"))  # noqa: E731  null is a value of its own
    rows = rows.withColumn("by_lang", name("lang")).withColumn("by_source", F.concat_ws("\n", F.col("by_lang"), name("source")))
    sources = saved(rows.groupBy("by_source", "by_lang").agg(F.count("*").alias("n")))
    langs = sources.groupBy("by_lang").agg(F.sum("n").alias("n_lang"), F.min("n").alias("n_least"))
    enough, whole = F.col("n") >= MIN_ROWS, F.col("n_lang") >= MIN_ROWS
    left = not langs.where(F.col("n_lang") < MIN_ROWS).where(F.col("n_least") < MIN_ROWS).isEmpty()
    grp = F.when(enough, F.col("by_source")).when(whole, F.col("by_lang")).otherwise(F.lit(""))
    grps = F.array(F.when(enough, F.col("by_source")), F.when(whole & (F.col("n_least") < MIN_ROWS), F.col("by_lang")), F.lit("" if left else None))
    groups = saved(sources.join(langs, "by_lang").select("by_source", grp.alias("grp"), F.filter(grps, lambda g: g.isNotNull()).alias("grps")))
    few = groups.count() <= BROADCAST_GROUPS
    return rows.join(F.broadcast(groups) if few else groups, "by_source").drop("by_source", "by_lang"), few


def _sums() -> list:
    return [F.count("*").alias("n")] + [F.sum(f"v{i}").alias(f"s{i}") for i in range(N)] \
        + [F.sum(F.col(f"v{i}") * F.col(f"v{j}")).alias(f"p{i}{j}") for i in range(N) for j in range(i + 1)]


def _quartiles(rows: DataFrame) -> DataFrame:
    """``grp`` and its quartiles lo_i, mid_i, hi_i, from counts per value."""
    values = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"v{i}").alias("v")) for i in range(N)]))
    counts = rows.select("grp", values.alias("x")).groupBy("grp", "x.i", "x.v").agg(F.count("*").alias("n"))
    upto, whole = W.partitionBy("grp", "i").orderBy("v"), W.partitionBy("grp", "i")
    ranked = counts.withColumn("upto", F.sum("n").over(upto)).withColumn("all", F.sum("n").over(whole))
    quart = [F.min(F.when(4 * F.col("upto") >= q * F.col("all"), F.col("v"))) for q in (1, 2, 3)]
    per = ranked.groupBy("grp", "i").agg(*[c.alias(a) for c, a in zip(quart, ("lo", "mid", "hi"))])
    return per.groupBy("grp").agg(*[F.max(F.when(F.col("i") == i, F.col(a))).alias(f"{a}{i}") for i in range(N) for a in ("lo", "mid", "hi")])


def _starts(rows: DataFrame) -> DataFrame:
    """``grp``, ``start`` and the first estimates; group ``*`` (all rows) only gives the floors."""
    quartiles = saved(_quartiles(rows))
    every = quartiles.where(F.col("grp") == "*").select(*[F.expr(sql).alias(name) for name, sql in floor_columns()]).first()
    first = quartiles.where(F.col("grp") != "*").join(rows.groupBy("grp").agg(*_sums()), "grp")
    first = saved(first.select("*", *[F.lit(every[name]).cast("double").alias(name) for name in FLOORS]) if every
                  else first.select("*", *[F.lit(1.0).alias(name) for name in FLOORS]))
    out = None
    for k in range(STARTS):
        one = first.select("grp", F.lit(k).alias("start"), *[F.expr(sql).alias(name) for name, sql in start_columns(k)], *FLOORS)
        out = one if out is None else out.unionByName(one)
    return out


def _concentrated(rows: DataFrame, state: DataFrame, few: bool) -> DataFrame:
    """One concentration step: for each group and start, sums over its nearest rows and the
    estimate from them."""
    keys = ["grp", "start"]
    binned = _measured(rows, state.select(*keys, *STATE), few).select(*keys, *[f"v{i}" for i in range(N)], F.expr(BIN_SQL).alias("bin"))
    bins = binned.groupBy(*keys, "bin").agg(*_sums())  # sums per bin: the rows are read once per step
    before = F.sum("n").over(W.partitionBy(*keys).orderBy("bin")) - F.col("n")
    near = bins.withColumn("before", before).withColumn("all", F.sum("n").over(W.partitionBy(*keys))) \
        .where(F.col("before") < F.lit(SHARE) * F.col("all"))
    total = near.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("n", *SUMS)]).join(state.select(*keys, *FLOORS), keys)
    moments = total.select(*keys, "n", *SUMS, *FLOORS, *[F.expr(sql).alias(name) for name, sql in moment_columns()])
    return _with(moments, cholesky_steps()).select(*keys, "n", *SUMS, *FLOORS, *STATE)


def estimates(rows: DataFrame, few: bool) -> DataFrame:
    """``grp`` and its estimate, from ``rows`` (``grp`` and the statistic vector; a row may be in
    several groups, and is once in group ``*``)."""
    state = saved(_starts(rows))
    rows = rows.where(F.col("grp") != "*")
    compared = ["grp", "start", "n", *SUMS]
    for step in range(MOST_STEPS):
        new = saved(_concentrated(rows, state, few))
        # Nearest rows that stay once stay for good, so looking at every third step is enough.
        stable = step % 3 == 2 and new.select(*compared).exceptAll(state.select(*compared)).isEmpty()
        state = new
        if stable:
            break
    best = F.min(F.struct(F.expr(SPREAD_SQL).alias("spread"), "start", *STATE)).alias("b")
    return saved(state.groupBy("grp").agg(best).select("grp", "b.*").drop("spread", "start"))


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                  source_col: str = "source") -> DataFrame:
    """doc_id, the base statistics, base_failed, distance2 (null where base_failed) and kept.

    Null languages and sources are groups of their own. Repeated rows are each judged and each
    count in the estimates. An empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).alias("lang"), F.col(source_col).alias("source"), F.col(text_col).alias("text"))
    base = saved(base_statistics(rows))
    passed = base.where(~F.col("base_failed"))
    vectors, few = group_of(passed.select("*", *[F.expr(sql).alias(f"v{i}") for i, sql in enumerate(statistic_sql())]))
    vectors = saved(vectors)
    slim = vectors.select(F.explode(F.array_append("grps", F.lit("*"))).alias("grp"), *[f"v{i}" for i in range(N)])
    state = estimates(slim, few)
    stats = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_echoes", "base_failed"]
    judged = _measured(vectors, state, few).select(*stats, F.col("d2").alias("distance2"), F.expr(f"d2 <= {_num(CUTOFF)}").alias("kept"))
    failed = base.where("base_failed").select(*stats, F.lit(None).cast("double").alias("distance2"), F.lit(False).alias("kept"))
    return judged.unionByName(failed)


# ---- the same in SQL ----

def oracle_sql() -> str:
    """The rows of ``quality_rules`` over ``documents``, for DuckDB."""
    sep = "chr(10)"

    def chained(source: str, steps: list[tuple[str, str]]) -> str:
        sql = source
        for name, expr in steps:
            sql = f"(SELECT *, {expr} AS {name} FROM {sql})"
        return sql

    ctes = [f"""w AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS lines,
         row_number() OVER () AS rid FROM documents)""",
            """pos AS (SELECT rid, words, unnest(range(1, len(words) - 6)) AS i FROM w WHERE len(words) >= 8)""",
            """win AS (SELECT rid, i, array_to_string(words[i:i + 7], ' ') AS k FROM pos)""",
            """twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, k) AS c FROM win) WHERE c > 1)""",
            """rep AS (SELECT rid, sum(least(8, i - prev)) AS n FROM (
  SELECT rid, i, coalesce(lag(i) OVER (PARTITION BY rid ORDER BY i), i - 8) AS prev FROM twice) GROUP BY rid)""",
            """base AS (
  SELECT doc_id, lang, source, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
         CAST(len(list_filter(range(2, len(words) + 1), lambda i: words[i] = words[i - 1])) AS BIGINT) AS n_echoes
  FROM w LEFT JOIN rep USING (rid))""",
            "flagged AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM base)",
            f"""vec AS (SELECT *, {', '.join(f'{sql} AS v{i}' for i, sql in enumerate(statistic_sql()))},
         coalesce('=' || lang, '-') AS by_lang, coalesce('=' || lang, '-') || {sep} || coalesce('=' || source, '-') AS by_source
  FROM flagged WHERE NOT base_failed)""",
            f"""judged AS (SELECT *, CASE WHEN count(*) OVER (PARTITION BY by_source) >= {MIN_ROWS} THEN by_source
         WHEN count(*) OVER (PARTITION BY by_lang) >= {MIN_ROWS} THEN by_lang ELSE '' END AS grp FROM vec)""",
            f"""est AS (SELECT g.grp, {', '.join(f'v{i}' for i in range(N))} FROM judged j
         JOIN (SELECT DISTINCT grp FROM judged) g ON g.grp IN (j.by_source, j.by_lang, ''))"""]
    quartiles = ", ".join(f"list_sort(list(v{i}))[CAST(ceil(count(*) * {q} / 4.0) AS BIGINT)] AS {a}{i}"
                          for i in range(N) for q, a in ((1, "lo"), (2, "mid"), (3, "hi")))
    ctes.append(f"floors AS (SELECT {', '.join(f'{sql} AS {name}' for name, sql in floor_columns())} FROM (SELECT {quartiles} FROM vec))")
    sums = ", ".join([f"sum(v{i}) AS s{i}" for i in range(N)] + [f"sum(v{i} * v{j}) AS p{i}{j}" for i in range(N) for j in range(i + 1)])
    state = ", ".join(STATE)
    ctes.append(f"quart AS (SELECT grp, count(*) AS n, {quartiles}, {sums} FROM est GROUP BY grp)")
    ctes.append("e0 AS MATERIALIZED (" + " UNION ALL ".join(
        f"SELECT grp, {k} AS start, {', '.join(f'{sql} AS {name}' for name, sql in start_columns(k))} FROM quart, floors" for k in range(STARTS)) + ")")
    for k in range(MOST_STEPS):
        measured = chained(f"(SELECT est.*, start, {state} FROM est JOIN e{k} USING (grp))", distance_steps())
        ctes.append(f"b{k} AS (SELECT *, {BIN_SQL} AS bin FROM {measured})")
        ctes.append(f"r{k} AS (SELECT *, count(*) OVER (PARTITION BY grp, start) AS whole, count(*) OVER (PARTITION BY grp, start ORDER BY bin) "
                    f"- count(*) OVER (PARTITION BY grp, start, bin) AS before_ FROM b{k})")
        ctes.append(f"s{k} AS (SELECT grp, start, count(*) AS n, {sums} FROM r{k} WHERE before_ < {_num(SHARE)} * whole GROUP BY grp, start)")
        moments = f"(SELECT grp, start, {', '.join(f'{sql} AS {name}' for name, sql in moment_columns())} FROM s{k}, floors)"
        ctes.append(f"e{k + 1} AS MATERIALIZED (SELECT grp, start, {state} FROM {chained(moments, cholesky_steps())})")
    ctes.append(f"best AS (SELECT * FROM e{MOST_STEPS} QUALIFY row_number() OVER (PARTITION BY grp ORDER BY {SPREAD_SQL}, start) = 1)")
    out = "doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_echoes, base_failed"
    last = chained(f"(SELECT judged.*, {state} FROM judged JOIN best USING (grp))", distance_steps())
    return (f"WITH {', '.join(ctes)}\nSELECT {out}, d2 AS distance2, d2 <= {_num(CUTOFF)} AS kept FROM {last}\n"
            f"UNION ALL SELECT {out}, CAST(NULL AS DOUBLE), false FROM flagged WHERE base_failed")
