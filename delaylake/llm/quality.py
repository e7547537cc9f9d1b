"""Quality rules: base counts, and robust multivariate outliers per language and source.

Built-in functions only. Each text gives four transformed statistics. Per
(lang, source) the minimum covariance determinant is searched from several
deterministic starts: coordinatewise medians and deviations, and the correlations
of squashed values and of spatial signs. Each start is followed by concentration
steps, which take the ``H`` share of texts nearest to the present centre and
recompute centre and scatter from them, until nothing changes. Of all models met
the one with the least determinant stays. Rows whose squared Mahalanobis distance
exceeds ``CUTOFF`` go.

A group with fewer than ``LEAST_ROWS`` texts that pass the base rule is judged by
the model of all texts of its language; where the language has fewer, by the
model of all rows. So every text that passes the base rule is judged.

Groups never meet in one task: centres, scatters and the histograms that give
the nearest share are additive aggregates with partial sums on the map side.
Statistics are fixed-point numbers summed exactly, so the outcome does not
depend on the order of rows.

Defined results: null text has no words and fails the base rule; null lang or
source form groups of their own; rows that fail the base rule have no distance
where none of their group passes; repeated rows are rows; an empty table gives
no rows. Windows of three words are told apart by 64-bit hashes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from delaylake.llm.store import stored

SPACE = " \t\n\x0b\x0c\r"
LEAST_WORDS = 50
MOST_REPEATED = 50

STATS = ("x_length", "x_symbols", "x_lines", "x_repeats")
SCALE = 1_000_000
#: Least spread of each statistic. A group in which one is constant (no symbols at all) has a singular
#: scatter; the square is added to the variance. All are low enough for a text to go by one statistic alone:
#: repeats reach 0.5 and lines log 2, which is more than sqrt(CUTOFF) = 4.85 of these.
FLOOR = {"x_length": 0.06, "x_symbols": 0.06, "x_lines": 0.10, "x_repeats": 0.08}
H = 0.75
#: Steps end when no model changes; the bound is for groups in which equal bins make two models alternate.
MOST_STEPS = 25
#: Chi-square with 4 degrees of freedom: the 0.75 quantile is 5.385, and the chance that one with 6
#: stays below it is 0.505; their ratio makes the scatter of the nearest 3/4 consistent.
CONSISTENT = 0.75 / 0.505
#: The 0.9999 quantile of chi-square with 4 degrees of freedom.
CUTOFF = 23.51
LEAST_ROWS = 20
#: Bins of the distance for each power of e.
BINS = 256
STARTS = ("medians", "squashed", "signs")
#: Fixed-point unit of squashed values and signs, which are at most 1: their products sum up in a long.
UNIT = 10_000


def _sum(parts: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, parts)


def counted(docs: DataFrame, keep: tuple[str, ...] = (), text: str = "text") -> DataFrame:
    """The kept columns and the base counts."""
    body = F.coalesce(F.col(text), F.lit(""))
    trimmed = F.btrim(F.col("body"), F.lit(SPACE))
    out = docs.select(*keep, body.alias("body"))
    out = out.withColumn(
        "words",
        F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+")),
    )
    lines = F.filter(F.split("body", "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != "")
    out = out.select(
        *keep,
        F.size("words").alias("n"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("body", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        lines.alias("lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("h"),
    )
    following = F.zip_with("h", F.slice("h", F.lit(2), F.greatest("n", F.lit(1))), lambda a, b: F.xxhash64(a, b))
    out = out.select(
        *keep,
        "n",
        "word_chars",
        "n_symbols",
        F.size("lines").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.col("n") >= 3, F.slice(following, F.lit(1), F.greatest(F.col("n") - 1, F.lit(1)))).alias("pair"),
        F.when(F.col("n") >= 3, F.slice("h", F.lit(3), F.greatest(F.col("n") - 2, F.lit(1)))).alias("third"),
    )
    rest = [*keep, "n", "word_chars", "n_symbols", "n_lines", "n_dup_lines"]
    out = out.select(
        *rest,
        F.slice(
            F.zip_with("pair", "third", lambda a, b: F.xxhash64(a, b)), F.lit(1), F.greatest(F.col("n") - 2, F.lit(1))
        ).alias("windows"),
    )
    repeated = F.size(F.array_distinct("windows")) < F.size("windows")
    placed = F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    out = out.select(*rest, F.when(repeated, placed).alias("placed"))

    def twice(x: Column, i: Column) -> Column:
        before, after = F.get("placed", i - 1), F.get("placed", i + 1)
        same = (before["h"] == x["h"]) | (after["h"] == x["h"])
        return F.when(same, x["i"])

    starts = F.array_sort(F.array_compact(F.transform("placed", twice)))
    out = out.select(*rest, F.when(F.col("placed").isNotNull(), starts).alias("starts"))
    steps = F.zip_with("starts", F.slice("starts", F.lit(2), F.greatest(F.size("starts"), F.lit(1))), lambda a, b: F.least(F.coalesce(b - a, F.lit(3)), F.lit(3)))
    words = F.aggregate(steps, F.lit(0).cast("long"), lambda total, x: total + x)
    return out.select(
        *keep,
        F.col("n").cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        F.coalesce(words, F.lit(0).cast("long")).alias("n_repeat_words"),
        "n_lines",
    )


def _statistics(base: DataFrame) -> DataFrame:
    n = F.greatest("n_words", F.lit(1))
    values = {
        "x_length": F.log(F.greatest(F.col("word_chars") / n, F.lit(0.1))),
        "x_symbols": F.log1p(F.col("n_symbols") / n),
        "x_lines": F.log1p(F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1))),
        "x_repeats": F.col("n_repeat_words") / n,
    }
    return base.withColumns({c: F.round(v * SCALE).cast("long") for c, v in values.items()})


def judged(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns, the base counts, base_failed, distance and kept."""
    group = [F.col(c).alias(f"g_{c}") for c in ("lang", "source")]
    source = docs.select(*keep, F.col(text).alias("__text"), *group)
    base = counted(source, (*keep, "g_lang", "g_source"), "__text").withColumn(
        "base_failed",
        (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")),
    )
    keys = {"own": _key("source", "g_lang", "g_source"), "language": _key("lang", "g_lang")}
    rows = stored(_statistics(base).withColumns(keys).drop("g_lang", "g_source"))
    passed = rows.where("not base_failed")
    groups = _groups(passed.groupBy("own", "language").count())
    fit = stored(passed.select("own", *STATS).join(groups, "own").select(F.explode("fits").alias("g"), *STATS))
    far = _distance(rows.join(groups.select("own", "g"), "own", "left"), _models(fit))
    outlier = F.coalesce(F.col("d2") > CUTOFF, F.lit(False))
    return far.select(
        *keep,
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & ~outlier).alias("kept"),
        F.sqrt("d2").alias("distance"),
    )


def _key(level: str, *columns: str) -> Column:
    return F.xxhash64(F.to_json(F.struct(F.lit(level).alias("level"), *columns)))


def _groups(sizes: DataFrame) -> DataFrame:
    """own, g (the model that judges the group) and fits (the models that its texts help to fit).

    From the number of fitting texts of each (own, language).
    """
    sizes = stored(sizes)
    small = F.col("count") < LEAST_ROWS
    languages = stored(
        sizes.groupBy("language").agg(F.sum("count").alias("in_language"), F.max(small).alias("has_small"))
    )
    lonely = F.col("has_small") & (F.col("in_language") < LEAST_ROWS)
    whole = not languages.where(lonely).isEmpty()
    every = _key("all")
    return stored(
        sizes.join(languages, "language").select(
            "own",
            F.when(~small, F.col("own")).when(~lonely, F.col("language")).otherwise(every).alias("g"),
            F.array_compact(
                F.array(
                    F.when(~small, F.col("own")),
                    F.when(F.col("has_small") & ~lonely, F.col("language")),
                    F.when(F.lit(whole), every),
                )
            ).alias("fits"),
        )
    )


def _models(fit: DataFrame) -> DataFrame:
    """The model of the least determinant for each g of ``fit`` (g and the statistics)."""
    model = _starts(fit)
    met: list[DataFrame] = []
    for step in range(MOST_STEPS):
        later = _concentrated(fit, model)
        met.append(later.withColumn("step", F.lit(step)))
        before = model.select("g", "start", F.col("state").alias("before"))
        model = stored(later.join(before, ["g", "start"]).where("state <> before").drop("before"))
        if model.isEmpty():
            break
    every = reduce(DataFrame.unionByName, met)
    # The first of equal determinants, so rounding in the last digits of two starts decides nothing.
    order = F.struct(F.round("logdet", 6), "start", "step")
    parts = [c for c in every.columns if c not in ("g", "start", "step")]
    best = every.groupBy("g").agg(F.min_by(F.struct(*parts), order).alias("best"))
    return stored(best.select("g", "best.*"))


def _starts(fit: DataFrame) -> DataFrame:
    """The first models: g, start, centre and factor. Medians come from value counts, bounded rows a group."""
    d = len(STATS)
    step = SCALE // 200
    long = fit.select(
        "g", F.inline(F.array(*(F.struct(F.lit(i).alias("axis"), F.round(F.col(c) / step).cast("long").alias("v")) for i, c in enumerate(STATS))))
    )
    counts = stored(long.groupBy("g", "axis", "v").count())
    middle = _middle(counts)
    spread = _middle(
        stored(
            counts.join(middle.withColumnRenamed("m", "centre"), ["g", "axis"])
            .groupBy("g", "axis", F.abs(F.col("v") - F.col("centre")).alias("v"))
            .agg(F.sum("count").alias("count"))
        )
    ).withColumnRenamed("m", "s")
    wide = stored(
        middle.join(spread, ["g", "axis"])
        .groupBy("g")
        .agg(
            *(F.max(F.when(F.col("axis") == i, F.col("m") * step / SCALE)).alias(f"m{i}") for i in range(d)),
            *(
                F.max(F.when(F.col("axis") == i, F.sqrt(F.pow(1.4826 * F.col("s") * step / SCALE, 2) + FLOOR[c] ** 2))).alias(f"d{i}")
                for i, c in enumerate(STATS)
            ),
        )
    )
    z = fit.join(wide, "g").select("g", *((F.col(c) / SCALE - F.col(f"m{i}")).alias(f"e{i}") for i, c in enumerate(STATS)), *(f"d{i}" for i in range(d)))
    z = z.select("g", *((F.col(f"e{i}") / F.col(f"d{i}")).alias(f"z{i}") for i in range(d)))
    z = z.withColumn("size", F.greatest(F.sqrt(_sum([F.col(f"z{i}") * F.col(f"z{i}") for i in range(d)])), F.lit(1e-6)))
    unit = {f"t{i}": F.round(F.tanh(f"z{i}") * UNIT).cast("long") for i in range(d)}
    unit |= {f"u{i}": F.round(F.col(f"z{i}") / F.col("size") * UNIT).cast("long") for i in range(d)}
    moments = z.withColumns(unit).groupBy("g").agg(
        F.count(F.lit(1)).alias("n"),
        *(F.sum(f"{k}{i}").alias(f"{k}{i}") for k in "tu" for i in range(d)),
        *(F.sum(F.col(f"{k}{i}") * F.col(f"{k}{j}")).alias(f"{k}{i}{j}") for k in "tu" for i in range(d) for j in range(i + 1)),
    )
    both = stored(moments).join(wide, "g")

    def covariance(k: str, i: int, j: int) -> Column:
        n = F.col("n")
        return F.col(f"{k}{i}{j}") / n - F.col(f"{k}{i}") / n * (F.col(f"{k}{j}") / n)

    def correlation(k: str, i: int, j: int) -> Column:
        # A squared unit more in each variance: a constant has correlation 0, and rounding gives none above 1.
        return covariance(k, i, j) / F.sqrt((covariance(k, i, i) + 1) * (covariance(k, j, j) + 1))

    def scatter(name: str, k: str) -> Column:
        cells = []
        for i in range(d):
            for j in range(i + 1):
                r = F.lit(1.0) if i == j else correlation(k, i, j) if k else F.lit(0.0)
                cells.append((r * F.col(f"d{i}") * F.col(f"d{j}")).alias(f"s{i}{j}"))
        return F.struct(F.lit(name).alias("start"), *cells)

    starts = F.array(*(scatter(name, k) for name, k in zip(STARTS, ("", "t", "u"), strict=True)))
    return _factored(both.select("g", "n", *(f"m{i}" for i in range(d)), F.inline(starts)))


def _middle(counts: DataFrame) -> DataFrame:
    """The lower median of each (g, axis) from a written table (g, axis, v, count).

    It is written first: otherwise one exchange by group would serve
    counting and cumulating, and bring a large group's counts of every map task
    to one place.
    """
    by = Window.partitionBy("g", "axis")
    return (
        counts.withColumn("up_to", F.sum("count").over(by.orderBy("v")))
        .withColumn("all", F.sum("count").over(by))
        .where(2 * F.col("up_to") >= F.col("all"))
        .groupBy("g", "axis")
        .agg(F.min("v").alias("m"))
    )


def _factored(model: DataFrame) -> DataFrame:
    """g, start, n, centre, lower Cholesky factor, log of the determinant and a hash of the state: a small written table."""
    d = len(STATS)
    for j in range(d):
        model = model.withColumn(
            f"l{j}{j}", F.sqrt(F.greatest(F.col(f"s{j}{j}") - _sum([F.lit(0.0), *(F.pow(f"l{j}{k}", 2) for k in range(j))]), F.lit(1e-9)))
        )
        for i in range(j + 1, d):
            inner = _sum([F.lit(0.0), *(F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j))])
            model = model.withColumn(f"l{i}{j}", (F.col(f"s{i}{j}") - inner) / F.col(f"l{j}{j}"))
    values = [*(f"m{i}" for i in range(d)), *(f"l{i}{j}" for i in range(d) for j in range(i + 1))]
    logdet = 2 * _sum([F.log(f"l{i}{i}") for i in range(d)])
    return stored(model.select("g", "start", "n", *values, logdet.alias("logdet"), F.xxhash64(*values).alias("state")))


def _distance(rows: DataFrame, model: DataFrame, how: str = "left") -> DataFrame:
    """The rows with d2, the squared Mahalanobis distance; null without a model."""
    out = rows.join(model, "g", how)
    for i, c in enumerate(STATS):
        inner = _sum([F.lit(0.0), *(F.col(f"l{i}{k}") * F.col(f"y{k}") for k in range(i))])
        out = out.withColumn(f"y{i}", (F.col(c) / SCALE - F.col(f"m{i}") - inner) / F.col(f"l{i}{i}"))
    d2 = _sum([F.col(f"y{i}") * F.col(f"y{i}") for i in range(len(STATS))])
    also = [c for c in ("start", "n") if c in model.columns]
    return out.select(*rows.columns, *also, F.round(d2, 6).alias("d2"))


def _concentrated(fit: DataFrame, model: DataFrame) -> DataFrame:
    """Centre and scatter of the nearest H share of each group, for each start.

    The share ends with the first bin of the logarithmic distance that reaches it.
    """
    d = len(STATS)
    far = _distance(fit, model, "inner").withColumn("bin", F.floor(F.log(F.col("d2") + 1e-6) * BINS))
    bins = stored(far.groupBy("g", "start", "n", "bin").count())
    limit = (
        bins.withColumn("up_to", F.sum("count").over(Window.partitionBy("g", "start").orderBy("bin")))
        .where(F.col("up_to") >= F.ceil(F.col("n") * H))
        .groupBy("g", "start")
        .agg(F.min("bin").alias("limit"))
    )
    near = far.join(stored(limit), ["g", "start"]).where("bin <= limit")
    whole = [F.col(c).cast("decimal(18,0)") for c in STATS]
    sums = near.groupBy("g", "start").agg(
        F.first("n").alias("n"),
        F.count(F.lit(1)).alias("h"),
        *(F.sum(x).alias(f"a{i}") for i, x in enumerate(whole)),
        *(F.sum(whole[i] * whole[j]).alias(f"b{i}{j}") for i in range(d) for j in range(i + 1)),
    )
    mean = {f"m{i}": F.col(f"a{i}").cast("double") / F.col("h") / SCALE for i in range(d)}
    scatter = {
        f"s{i}{j}": (
            F.col(f"b{i}{j}").cast("double") / F.col("h") / SCALE**2
            - F.col(f"a{i}").cast("double") / F.col("h") / SCALE * (F.col(f"a{j}").cast("double") / F.col("h") / SCALE)
        )
        * CONSISTENT
        + F.lit(FLOOR[STATS[i]] ** 2 if i == j else 0.0)
        for i in range(d)
        for j in range(i + 1)
    }
    return _factored(sums.withColumns(mean | scatter))


def clean(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep."""
    row = docs.select(F.struct("*").alias("__doc"), "text", "lang", "source")
    return judged(row, keep=("__doc",)).where("kept").select("__doc.*")
