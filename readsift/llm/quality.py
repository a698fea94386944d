"""Quality rules: base counts per text, then robust multivariate outliers per language and source.

The minimum covariance determinant is approached by concentration steps, as DataFrame aggregates: from
medians and absolute deviations, each step takes the HALF of a group's rows that lie closest and refits
mean and covariance on them, until the determinant no longer falls. There is a fit for each source of a
language, for each language and over all rows; location and scatter of a source's n rows are drawn towards
its language's, which are drawn towards those of all rows, with weight SHRINK / (n + SHRINK). Rows beyond the
cut in Mahalanobis distance are rejected. Everything is DataFrame expressions; what a group contributes to a
shuffle is sums.
"""

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from readsift.functions.binding import let
from readsift.llm.native import SPACES, grams, words
from readsift.llm.storage import stored

HALF = 0.75  # share of a group's rows that a concentration step keeps
STAYS = 1e-3  # a logarithm of a determinant that falls by less has stayed
SHRINK = 25  # rows that the wider fit counts for beside a fit's own
PRIOR_ROWS = 10  # rows that the typical spreads count for beside a fit's own
CUT = 35.888  # squared distance that a chi-square with five degrees of freedom passes once in a million: clean texts have heavy tails
MEDIAN_CHI2 = 4.351  # median of that chi-square (fixed value)
SMALL_GROUPS = 50_000  # groups whose parameters (some 25 numbers each) are broadcast
#: Transformed statistics, and the spread added to a fit's own: small beside a statistic's range, so that each can pass CUT by itself.
STATISTICS = {
    "x0": ("log(n_words)", 0.2),
    "x1": ("log(word_chars / n_words)", 0.05),
    "x2": ("sqrt(n_symbols / word_chars)", 0.03),
    "x3": ("sqrt(n_dup_lines / n_lines)", 0.14),
    "x4": ("sqrt(n_repeat_words / n_words)", 0.1),
}
#: A passage that occurs twice raises both: the floors of repeated lines and words go together.
TOGETHER = {("x4", "x3"): 0.7}
#: Spreads that texts have anywhere, for fits over few rows.
TYPICAL = {"x0": 1.0, "x1": 0.1}
X = list(STATISTICS)
PAIRS = [(i, k) for i in range(len(X)) for k in range(i + 1)]
MEANS, COVARIANCES = [f"m_{i}" for i in range(len(X))], [f"c_{i}_{k}" for i, k in PAIRS]
FACTORS = [f"l_{i}_{k}" for i, k in PAIRS]
GROUP = ["g_lang", "g_source"]


def repeat_words(hashes):
    """Words inside 8-word windows that occur twice or more, from the windows' hashes in order."""

    def covered(places):
        steps = F.transform(places, lambda p, k: F.when(k == 0, 8).otherwise(F.least(F.lit(8), p - F.get(places, k - 1))))
        return F.aggregate(steps, F.lit(0), lambda a, b: a + b)

    def twice(ranked):
        same = lambda a, b: F.get(ranked, a)["h"] == F.get(ranked, b)["h"]
        marked = F.transform(ranked, lambda r, k: F.when(F.coalesce(same(k, k - 1), F.lit(False)) | F.coalesce(same(k, k + 1), F.lit(False)), r["i"]))
        return let(F.array_sort(F.filter(marked, lambda i: i.isNotNull())), covered)

    ranked = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return let(ranked, twice)


def base_statistics(docs: DataFrame) -> DataFrame:
    """Counts of each row: see `quality`."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(g) for g, c in zip(GROUP, ("lang", "source"), strict=True)), text.alias("body"))
    rows = rows.withColumn("w", words(F.col("body"))).withColumn("lines", F.filter(F.split("body", "\n"), lambda s: F.btrim(s, F.lit(SPACES)) != ""))
    rows = rows.withColumn("h", F.coalesce(grams("w", 8, F.xxhash64), F.array().cast("array<bigint>")))
    n = F.size("w").cast("long")
    counted = rows.select(
        "doc_id", *GROUP, n.alias("n_words"), F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        (F.length("body") - F.length(F.regexp_replace("body", "[#*$%&|<>]", ""))).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"), (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.size(F.array_distinct("h")) < F.size("h"), repeat_words(F.col("h"))).otherwise(0).cast("long").alias("n_repeat_words"),
    )
    return counted.withColumn("base_failed", F.expr("n_words < 20 or 100 * n_repeat_words > 30 * n_words"))


def _fit_names() -> dict:
    """The fits that a row belongs to, from the narrowest: source of a language, language, all rows."""
    own = F.concat(F.lit("s"), F.length("g_lang"), F.lit(" "), F.col("g_lang"), F.col("g_source"))
    return {"s": own, "l": F.concat(F.lit("l"), F.col("g_lang")), "a": F.lit("")}


def _with_distance(rows: DataFrame) -> DataFrame:
    """Adds d2, the squared Mahalanobis distance to the fit whose columns the row has, by forward substitution."""
    out = rows
    for i, x in enumerate(X):
        rest = F.col(x) - F.col(f"m_{i}")
        for k in range(i):
            rest = rest - F.col(f"l_{i}_{k}") * F.col(f"z_{k}")
        out = out.withColumn(f"z_{i}", rest / F.col(f"l_{i}_{i}"))
    d2 = sum((F.col(f"z_{i}") * F.col(f"z_{i}") for i in range(1, len(X))), F.col("z_0") * F.col("z_0"))
    return out.withColumn("d2", d2)


def _fitted(rows: DataFrame, fits: DataFrame) -> DataFrame:
    return _with_distance(rows.join(fits, "fit")).select(*rows.columns, "d2")


def _regular(fits: DataFrame) -> DataFrame:
    """Covariance columns c_i_k of n rows, with the floors and the typical spreads added."""
    floors = [f for _, f in STATISTICS.values()]
    prior = F.lit(float(PRIOR_ROWS)) / (F.col("n") + PRIOR_ROWS)
    out = {}
    for i, k in PAIRS:
        out[f"c_{i}_{k}"] = F.col(f"c_{i}_{k}") + floors[i] * floors[k] * TOGETHER.get((X[i], X[k]), 0.0)
        if i == k:
            out[f"c_{i}_{k}"] += floors[i] ** 2 + prior * TYPICAL.get(X[i], 0.0) ** 2
    return fits.withColumns(out)


def _cholesky(fits: DataFrame) -> DataFrame:
    """Adds columns l_i_k of the lower factor and `det`, the logarithm of the determinant; spreads far below the floor are raised."""
    floors = [f for _, f in STATISTICS.values()]
    for i, k in PAIRS:
        value = F.col(f"c_{i}_{k}")
        for j in range(k):
            value = value - F.col(f"l_{i}_{j}") * F.col(f"l_{k}_{j}")
        value = F.sqrt(F.greatest(value, F.lit(floors[i] ** 2 / 4))) if i == k else value / F.col(f"l_{k}_{k}")
        fits = fits.withColumn(f"l_{i}_{k}", value)
    return fits.withColumn("det", 2 * sum((F.log(f"l_{i}_{i}") for i in range(1, len(X))), F.log("l_0_0")))


def _ready(fits: DataFrame) -> DataFrame:
    """The written fits, broadcast if their count allows."""
    fits = stored(fits, "fits")
    return F.broadcast(fits) if fits.count() <= SMALL_GROUPS else fits


def _start(rows: DataFrame) -> DataFrame:
    """Medians and absolute deviations per fit, as a diagonal fit; its determinant is no bound."""
    middles = _ready(rows.groupBy("fit").agg(*[F.percentile_approx(x, 0.5, 1000).alias(f"m_{i}") for i, x in enumerate(X)]))
    apart = rows.join(middles, "fit").groupBy("fit").agg(
        F.count("*").alias("n"),
        *[F.first(m).alias(m) for m in MEANS],
        *[F.percentile_approx(F.abs(F.col(x) - F.col(f"m_{i}")), 0.5, 1000).alias(f"a_{i}") for i, x in enumerate(X)],
    )
    spread = {f"c_{i}_{k}": F.pow(1.4826 * F.col(f"a_{i}"), 2) if i == k else F.lit(0.0) for i, k in PAIRS}
    return _ready(_cholesky(_regular(apart.withColumns(spread))).select("fit", *MEANS, *COVARIANCES, *FACTORS, F.lit(float("inf")).alias("det")))


def _concentrate(rows: DataFrame, fits: DataFrame) -> DataFrame:
    """Mean and covariance of the HALF of each fit's rows that are closest to it."""
    bounds = _ready(_fitted(rows, fits).groupBy("fit").agg(F.percentile_approx("d2", HALF, 1000).alias("bound")))
    sums = _fitted(rows, fits).join(bounds, "fit").where("d2 <= bound").groupBy("fit").agg(
        F.count("*").alias("n"),
        *[F.avg(x).alias(f"m_{i}") for i, x in enumerate(X)],
        *[F.covar_pop(X[i], X[k]).alias(f"c_{i}_{k}") for i, k in PAIRS],
    )
    return _cholesky(_regular(sums)).select("fit", *MEANS, *COVARIANCES, *FACTORS, "det")


def robust_fits(rows: DataFrame) -> DataFrame:
    """(fit, rows, m_i, c_i_k) per fit of rows (fit, x0 ...): concentrated until each determinant stays, then scaled.

    A determinant that fell by STAYS or more moves on to another step, the others are done, so the loop ends. The covariance is scaled
    up where the median squared distance is above the chi-square's.
    """
    moving, done = _start(rows), []
    while True:
        before = moving.select("fit", *[F.col(c).alias(f"_{c}") for c in (*MEANS, *COVARIANCES, *FACTORS, "det")])
        fell = F.col("_det") - F.col("det")
        step = _concentrate(rows, moving).join(before, "fit").withColumn("falls", fell >= STAYS)
        kept = [F.when(fell >= 0, F.col(c)).otherwise(F.col(f"_{c}")).alias(c) for c in (*MEANS, *COVARIANCES, *FACTORS, "det")]
        step = stored(step.select("fit", *kept, "falls"), "step")
        done.append(step.where("not falls").drop("falls"))
        moving = _ready(step.where("falls").drop("falls"))
        if moving.isEmpty():
            break
    fits = _ready(reduce(DataFrame.unionByName, done))
    middle = _fitted(rows, fits).groupBy("fit").agg(F.count("*").alias("rows"), F.percentile_approx("d2", 0.5, 1000).alias("mid"))
    scale = F.greatest(F.col("mid") / MEDIAN_CHI2, F.lit(1.0))
    return stored(fits.join(middle, "fit").select("fit", "rows", *MEANS, *[(F.col(c) * scale).alias(c) for c in COVARIANCES]), "robust-fits")


def shrunk(groups: DataFrame, fits: DataFrame) -> DataFrame:
    """(GROUP, m_i, l_i_k): the fit that judges a group's rows, its own drawn towards its language's and that towards the one over all rows."""
    out = groups
    for level, name in _fit_names().items():
        side = fits.select(F.col("fit").alias(f"{level}_fit"), *[F.col(c).alias(f"{level}_{c}") for c in ("rows", *MEANS, *COVARIANCES)])
        out = out.withColumn(f"{level}_fit", name).join(side, f"{level}_fit")
    mixed = {}
    for c in (*MEANS, *COVARIANCES):
        mixed[c] = F.col(f"a_{c}")
        for level in ("l", "s"):
            own = F.col(f"{level}_rows") / (F.col(f"{level}_rows") + SHRINK)
            mixed[c] = own * F.col(f"{level}_{c}") + (1 - own) * mixed[c]
    return _ready(_cholesky(out.select(*GROUP, *[v.alias(c) for c, v in mixed.items()])).select(*GROUP, *MEANS, *FACTORS))


def quality(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, distance, kept) per row.

    Rows that fail the base rules are not kept, nor used for a fit (distance null). Others are kept unless their squared
    robust distance from the fit of their language and source passes CUT; fits of few rows lean on wider ones, by a weight that
    changes little with one row more. Null text has no words and fails; null language or source is a group of its own, with the
    empty string. Repeated rows count as often as they occur; other columns are ignored.
    """
    stats = stored(base_statistics(docs), "statistics")
    passed = stats.where("not base_failed")
    vectors = {x: F.expr(e).cast("double") for x, (e, _) in STATISTICS.items()}
    rows = stored(passed.select(F.explode(F.array(*_fit_names().values())).alias("fit"), *[v.alias(x) for x, v in vectors.items()]), "vectors")
    fits = shrunk(passed.select(*GROUP).distinct(), robust_fits(rows))
    judged = _with_distance(stats.join(fits, GROUP, "left").withColumns({x: F.when(~F.col("base_failed"), v) for x, v in vectors.items()}))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", F.sqrt("d2").alias("distance"),
        (~F.col("base_failed") & F.coalesce(F.col("d2") <= CUT, F.lit(False))).alias("kept"),
    )
