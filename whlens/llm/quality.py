"""Quality rules with robust multivariate outliers, in DataFrame functions only.

One pass over the texts computes statistics. Per language and source, a minimum
covariance determinant (MCD) estimate of the transformed statistics is found by
concentration steps: distances to the current estimate, then the estimate of the
nearest three quarters. Each step is one aggregation: rows are summed up by the
logarithm of their distance, and the nearest bins are added up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from whlens.llm.common import SALTS, drop, table

WINDOW = 8
#: Rows that a (language, source) needs for an estimate of its own.
MIN_ROWS = 200
#: Share of the rows that the estimate covers, concentration steps, bins for each
#: doubling of the squared distance.
COVERED, STEPS, BINS = 0.75, 5, 32
#: Squared robust distance beyond which a document is rejected: the 0.9999 quantile of
#: chi-squared with five degrees of freedom.
CUTOFF = 25.745
#: Least standard deviation of each transformed statistic: most documents have no
#: symbols or repeats at all, which says nothing against a few. Each statistic can
#: reject alone: the square roots of 17 % of the lines or of the words are beyond the cutoff.
FLOORS = {"size": 0.5, "word": 0.08, "symbols": 0.08, "lines": 0.08, "repeats": 0.08}
#: So many duplicate lines and repeated words count as none: one passage that a clean
#: document gives twice.
PASSAGE_LINES, PASSAGE_WORDS = 2, 48
X = list(FLOORS)
#: Median of chi-squared with five degrees of freedom.
CHI_MEDIAN = 4.351

SPACE = r"[\x20\x09-\x0D]+"


def statistics(docs: DataFrame) -> DataFrame:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of each whole text
    (null: none), with doc_id, lang and source.

    Repeated windows are found by 64-bit hashes of eight words' hashes within the
    document; only documents that have any are sorted.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", F.col("lang").cast("string"), F.col("source").cast("string"), text.alias("text"))
    lines = F.filter(F.split("text", "\n"), lambda line: F.translate(line, " \t\n\x0b\f\r", "") != "")
    rows = rows.select("doc_id", "lang", "source",
                       F.length(F.translate("text", " \t\n\x0b\f\r", "")).cast("long").alias("word_chars"),
                       (F.length("text") - F.length(F.translate("text", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
                       lines.alias("lines"),
                       F.transform(F.array_remove(F.split("text", SPACE), ""), lambda w: F.xxhash64(w)).alias("words"))
    ints = F.array().cast("array<int>")
    at = F.when(F.size("words") >= WINDOW, F.sequence(F.lit(1), F.size("words") - WINDOW + 1)).otherwise(ints)
    rows = rows.select("doc_id", "lang", "source", "word_chars", "n_symbols",
                       F.size("words").cast("long").alias("n_words"), F.size("lines").cast("long").alias("n_lines"),
                       (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
                       F.transform(at, lambda i: F.xxhash64(F.slice("words", i, WINDOW))).alias("windows"))
    ordered = F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    repeated = F.size(F.array_distinct("windows")) < F.size("windows")
    rows = rows.withColumn("ordered", F.when(repeated, ordered)).drop("windows")
    of = lambda j: F.get("ordered", j)["h"]
    twice = F.filter(F.sequence(F.lit(0), F.size("ordered") - 1),
                     lambda j: F.coalesce(of(j) == of(j + 1), F.lit(False)) | F.coalesce((j > 0) & (of(F.greatest(j - 1, F.lit(0))) == of(j)), F.lit(False)))
    rows = rows.withColumn("starts", F.when(F.col("ordered").isNotNull(), F.sort_array(F.transform(twice, lambda j: F.get("ordered", j)["i"])))).drop("ordered")
    covered = F.aggregate(F.transform("starts", lambda p, j: F.least(F.coalesce(F.get("starts", j + 1) - p, F.lit(WINDOW)), F.lit(WINDOW))),
                          F.lit(0).cast("long"), lambda a, b: a + b)
    return rows.select("doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines",
                       F.coalesce(covered, F.lit(0).cast("long")).alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def transformed(stats: DataFrame) -> DataFrame:
    """Statistics on scales where clean documents are about normal."""
    return stats.withColumns({
        "size": F.log1p("n_words"),
        "word": F.log((F.col("word_chars") + 1) / (F.col("n_words") + 1)),
        "symbols": F.sqrt(F.col("n_symbols") / (F.col("word_chars") + 1)),
        "lines": F.when(F.col("n_dup_lines") > PASSAGE_LINES, F.sqrt(F.col("n_dup_lines") / (F.col("n_lines") + 1))).otherwise(0.0),
        "repeats": F.when(F.col("n_repeat_words") > PASSAGE_WORDS, F.sqrt(F.col("n_repeat_words") / (F.col("n_words") + 1))).otherwise(0.0),
    })


def _salt() -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")


def grouped(stats: DataFrame, min_rows: int) -> DataFrame:
    """Adds ``grp``: its language and source if they have ``min_rows`` rows that pass
    the base rules; the language's smaller sources are one group, the smaller of
    those are one again. ``grp`` is null if even that is too small. The table of
    groups is repeated for each salt, so that a hot source is no hot key."""
    by = ["lang", "source"]
    counts = stats.where(~F.col("base_failed")).groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    rest = lambda *keys: F.sum(F.when(F.col("own").isNull(), F.col("n")).otherwise(0)).over(Window.partitionBy(*keys))
    mark = lambda n, *parts: F.when(F.col("n_" + n) >= min_rows, F.xxhash64(F.lit(n), *parts))
    counts = counts.withColumn("n_source", F.col("n")).withColumn("own", mark("source", "lang", "source", F.col("lang").isNull(), F.col("source").isNull()))
    counts = counts.withColumn("n_lang", rest("lang")).withColumn("own", F.coalesce("own", mark("lang", "lang", F.col("lang").isNull())))
    counts = counts.withColumn("n_all", rest(F.lit(0))).withColumn("own", F.coalesce("own", mark("all")))
    groups = counts.select(*[F.col(c).alias("of_" + c) for c in by], F.col("own").alias("grp"), _salt())
    rows = stats.withColumn("salt", F.pmod(F.xxhash64("doc_id", "n_words", "word_chars"), F.lit(SALTS)).cast("int"))
    same = F.col("lang").eqNullSafe(F.col("of_lang")) & F.col("source").eqNullSafe(F.col("of_source"))
    return rows.withColumnRenamed("salt", "row_salt").join(groups, same & (F.col("row_salt") == F.col("salt")), "left").drop("of_lang", "of_source", "row_salt", "salt")


def _cholesky(moments: DataFrame) -> DataFrame:
    """From n, sums s_i and products s_i_j: means m_i, the lower triangle l_i_j of the
    covariance's Cholesky factor (with the floors on its diagonal) and log_det."""
    d = range(len(X))
    out = moments.select("grp", "start", *[(F.col(f"s_{i}") / F.col("n")).alias(f"m_{i}") for i in d],
                         *[(F.col(f"s_{i}_{j}") / F.col("n")).alias(f"c_{i}_{j}") for i in d for j in d if j <= i])
    floor = [v * v for v in FLOORS.values()]
    for i in d:
        for j in d:
            if j <= i:
                cov = F.col(f"c_{i}_{j}") - F.col(f"m_{i}") * F.col(f"m_{j}") + (floor[i] if i == j else 0.0)
                for k in range(j):
                    cov = cov - F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}")
                out = out.withColumn(f"l_{i}_{j}", F.sqrt(F.greatest(cov, F.lit(floor[i] / 2))) if i == j else cov / F.col(f"l_{j}_{j}"))
    return out.withColumn("log_det", sum(2 * F.log(F.col(f"l_{i}_{i}")) for i in d)).drop(*[f"c_{i}_{j}" for i in d for j in d if j <= i])


def distances(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """``rows`` with each of their group's ``estimates`` and the squared distance ``d2``."""
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id", "n_words", "word_chars"), F.lit(SALTS)).cast("int"))
    out = salted.join(estimates.select("*", _salt()), ["grp", "salt"])
    for i in range(len(X)):
        y = F.col(X[i]) - F.col(f"m_{i}")
        for k in range(i):
            y = y - F.col(f"l_{i}_{k}") * F.col(f"y_{k}")
        out = out.withColumn(f"y_{i}", y / F.col(f"l_{i}_{i}"))
    return out.withColumn("d2", sum(F.col(f"y_{i}") * F.col(f"y_{i}") for i in range(len(X))))


def _bin() -> Column:
    return F.floor(BINS * F.log2(F.col("d2") + 1e-6)).cast("int")


def concentrate(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """The estimates of each group's nearest ``COVERED`` rows (whole bins of the distance)."""
    d = range(len(X))
    sums = [F.count(F.lit(1)).alias("n"), *[F.sum(X[i]).alias(f"s_{i}") for i in d],
            *[F.sum(F.col(X[i]) * F.col(X[j])).alias(f"s_{i}_{j}") for i in d for j in d if j <= i]]
    bins = distances(rows, estimates).groupBy("grp", "start", _bin().alias("bin")).agg(*sums)
    own = Window.partitionBy("grp", "start")
    bins = bins.withColumn("before", F.coalesce(F.sum("n").over(own.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    near = bins.withColumn("all", F.sum("n").over(own)).where(F.col("before") < COVERED * F.col("all"))
    names = ["n", *[f"s_{i}" for i in d], *[f"s_{i}_{j}" for i in d for j in d if j <= i]]
    return _cholesky(near.groupBy("grp", "start").agg(*[F.sum(c).alias(c) for c in names]))


def estimate(rows: DataFrame, steps: int = STEPS) -> DataFrame:
    """An MCD estimate per ``grp`` of the rows, with ``scale``, which makes the median
    distance that of normal statistics (never smaller: the floors alone can do that).

    Two starts: medians and quartile ranges of each statistic by itself, and all
    rows' mean and covariance. After ``steps`` concentrations the one with the
    smaller determinant stays.
    """
    d = range(len(X))
    quarters = rows.groupBy("grp").agg(*[F.percentile_approx(X[i], [0.25, 0.5, 0.75], 1000).alias(f"q_{i}") for i in d])
    alone = quarters.select(
        "grp", F.lit(0).alias("start"), *[F.get(f"q_{i}", F.lit(1)).alias(f"m_{i}") for i in d],
        *[(F.greatest((F.get(f"q_{i}", F.lit(2)) - F.get(f"q_{i}", F.lit(0))) / 1.349, F.lit(FLOORS[X[i]])) if i == j else F.lit(0.0)).alias(f"l_{i}_{j}")
          for i in d for j in d if j <= i], F.lit(0.0).alias("log_det"))
    every = _cholesky(rows.groupBy("grp").agg(F.lit(1).alias("start"), F.count(F.lit(1)).alias("n"), *[F.sum(X[i]).alias(f"s_{i}") for i in d],
                                              *[F.sum(F.col(X[i]) * F.col(X[j])).alias(f"s_{i}_{j}") for i in d for j in d if j <= i]))
    now = table(alone.unionByName(every), "estimates")
    for _ in range(steps):
        now, old = table(concentrate(rows, now), "estimates"), now
        drop(old)
    best = now.withColumn("rank", F.row_number().over(Window.partitionBy("grp").orderBy("log_det", "start"))).where("rank = 1").drop("rank")
    own = Window.partitionBy("grp")
    bins = distances(rows, best).groupBy("grp", _bin().alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    bins = bins.withColumn("upto", F.sum("n").over(own.orderBy("bin"))).withColumn("all", F.sum("n").over(own))
    half = bins.where("2 * upto >= all").groupBy("grp").agg((F.pow(F.lit(2.0), (F.min("bin") + 0.5) / BINS) / CHI_MEDIAN).alias("scale"))
    return best.join(half, "grp").withColumn("scale", F.greatest("scale", F.lit(1.0)))


def judge(docs: DataFrame, min_rows: int = MIN_ROWS, cutoff: float = CUTOFF) -> DataFrame:
    """Statistics of each whole text (null: none), base_failed, kept and distance.

    kept: false if the base rules fail, or if the squared robust distance to the
    document's language and source exceeds ``cutoff``. Groups too small to
    estimate reject nothing (distance null). Null languages and sources are groups
    like others; rows of one doc_id are rows of their own. No rows, no result.
    """
    stats = table(transformed(statistics(docs).withColumn("base_failed", base_failed())), "statistics")
    rows = table(grouped(stats, min_rows), "grouped")
    fit = rows.where("not base_failed and grp is not null")
    found = table(estimate(fit), "estimates")
    far = distances(fit, found).select("doc_id", "lang", "source", *_COUNTS, "base_failed", (F.col("d2") / F.col("scale")).alias("distance"))
    rest = rows.where("base_failed or grp is null").select("doc_id", "lang", "source", *_COUNTS, "base_failed", F.lit(None).cast("double").alias("distance"))
    return far.unionByName(rest).withColumn("kept", ~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= cutoff))


_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = judge(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", *_COUNTS, "base_failed", "kept", "distance")
