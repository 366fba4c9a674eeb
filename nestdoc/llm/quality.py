"""Quality rules: plain floors on text statistics, then robust multivariate outliers.

The statistics of a text become a vector (`FEATURES`). For every language and source the minimum
covariance determinant estimate of centre and scatter is taken: from two starts (medians with
median deviations, and plain moments) the `SUPPORT` share of documents nearest by Mahalanobis
distance gives the next centre and scatter, `STEPS` times; of both results the one of the smaller
determinant counts. Distances are scaled so that their median is that of a chi-square variable.
Texts beyond `CUTOFF` are rejected. All of it is DataFrame expressions; every step is a sum or a
quantile by group, added up in the tasks first, so a group may hold any share of the rows.

Groups of under `LEAST` usable texts are put together by language, and those of languages that
are still too small in one group; if that is too small as well, its texts are not judged.
Scatter has a floor (`FLOOR`), so that a statistic that hardly varies in a group does not reject
texts for trifles.

Defined results: a null text has no words, as an empty one; both fail the base rules; null
languages and sources are groups of their own; repeated rows are judged alike; an empty table
gives an empty result; columns other than the four named are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nestdoc.llm._frames import WORD, pinned, quoted, sent, table

SUPPORT = 0.75
STEPS = 3
LEAST = 60
#: Squared distance beyond which a text is rejected: five degrees of freedom pass it once in 10**9.
CUTOFF = 50.0
#: Median of a chi-square variable of five degrees of freedom.
MEDIAN = 4.351460
MIN_WORDS = 50
REPEAT_PERCENT = 50

FEATURES = ("x0", "x1", "x2", "x3", "x4")
#: Least standard deviation of each feature.
FLOOR = (0.05, 0.05, 0.1, 0.1, 0.3)
_D = len(FEATURES)
_CELLS = [(i, j) for i in range(_D) for j in range(i + 1)]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once for the row."""
    return F.transform(F.array(value), body)[0]


def repeated_words(words: Column) -> Column:
    """How many words are in a window of three words that the text has twice or more."""

    def windows(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.struct(F.xxhash64(w[i], w[i + 1], w[i + 2]).alias("h"), i.alias("i")))

    def places(g: Column) -> Column:
        again = F.filter(g, lambda x, k: (F.get(g, k + 1)["h"] == x["h"]) | (F.get(g, k - 1)["h"] == x["h"]))
        return F.sort_array(F.transform(again, lambda x: x["i"]))

    def covered(p: Column) -> Column:
        gaps = F.transform(p, lambda x, k: F.least(F.coalesce(F.get(p, k + 1) - x, F.lit(3)), F.lit(3)))
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda a, x: a + x)

    found = let(words, lambda w: let(F.sort_array(windows(w)), lambda g: let(places(g), covered)))
    return F.when(F.size(words) >= 3, found).otherwise(F.lit(0).cast("long"))


def text_statistics(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """(doc_id, lang, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    t = F.coalesce(quoted(text), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(WORD))
    dup_lines = let(lines, lambda a: F.size(a) - F.size(F.array_distinct(a)))
    words = F.regexp_extract_all(t, F.lit(WORD), F.lit(0))
    counted = let(words, lambda w: F.struct(F.size(w).cast("long").alias("n_words"), repeated_words(w).alias("n_repeat_words")))
    return docs.select(
        quoted(doc_id).alias("doc_id"),
        quoted(lang).alias("lang"),
        quoted(source).alias("source"),
        counted.alias("counted"),
        (F.length(t) - F.regexp_count(t, F.lit(r"[\x20\x09-\x0D]"))).cast("long").alias("word_chars"),
        F.regexp_count(t, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        dup_lines.cast("long").alias("n_dup_lines"),
    ).select("doc_id", "lang", "source", "counted.n_words", "word_chars", "n_symbols", "n_dup_lines", "counted.n_repeat_words")


def features() -> dict[str, Column]:
    """Transformed statistics of a text that passes the base rules."""
    n = F.nullif(F.col("n_words").cast("double"), F.lit(0.0))
    return dict(
        zip(
            FEATURES,
            (
                F.log(F.col("word_chars") / n),
                F.sqrt(F.col("n_symbols") / n),
                F.sqrt(F.col("n_dup_lines") / n),
                F.sqrt(F.col("n_repeat_words") / n),
                F.log(n),
            ),
            strict=True,
        )
    )


def _estimate(moments: DataFrame) -> DataFrame:
    """Sums of a group to (grp, m: centre, w: whitening matrix by rows, det: log determinant)."""
    mean = [F.col(f"s{i}") / F.col("n") for i in range(_D)]
    scatter = {f"v{i}_{j}": F.col(f"s{i}_{j}") / F.col("n") - mean[i] * mean[j] for i, j in _CELLS}
    return _factored(moments.select("grp", F.array(*mean).alias("m"), *[c.alias(k) for k, c in scatter.items()]))


def _factored(scatter: DataFrame) -> DataFrame:
    """(grp, m, v0_0, ...: scatter) to (grp, m, w, det): w is the inverse of the Cholesky factor,
    det the sum of the logarithms of its diagonal."""
    df = scatter
    for i, j in _CELLS:
        rest = F.col(f"v{i}_{j}")
        for c in range(j):
            rest = rest - F.col(f"l{i}_{c}") * F.col(f"l{j}_{c}")
        low = F.sqrt(F.greatest(rest, F.lit(0.0)) + FLOOR[i] ** 2) if i == j else rest / F.col(f"l{j}_{j}")
        df = df.withColumn(f"l{i}_{j}", low)
    for i, j in _CELLS:
        rest = F.lit(1.0 if i == j else 0.0)
        for c in range(j, i):
            rest = rest - F.col(f"l{i}_{c}") * F.col(f"i{c}_{j}")
        df = df.withColumn(f"i{i}_{j}", rest / F.col(f"l{i}_{i}"))
    det = F.lit(0.0)
    for i in range(_D):
        det = det + F.log(F.col(f"l{i}_{i}"))
    return df.select("grp", "m", F.array(*[F.col(f"i{i}_{j}") for i, j in _CELLS]).alias("w"), det.alias("det"))


def _distance() -> Column:
    """Squared Mahalanobis distance of a row to the estimate that is joined to it."""
    total = F.lit(0.0)
    for i in range(_D):
        z = F.lit(0.0)
        for j in range(i + 1):
            z = z + F.col("w")[_CELLS.index((i, j))] * (F.col(FEATURES[j]) - F.col("m")[j])
        total = total + z * z
    return total


def _moments(rows: DataFrame) -> DataFrame:
    sums = [F.sum(f).alias(f"s{i}") for i, f in enumerate(FEATURES)]
    products = [F.sum(F.col(FEATURES[i]) * F.col(FEATURES[j])).alias(f"s{i}_{j}") for i, j in _CELLS]
    return rows.groupBy("grp").agg(F.count("*").cast("double").alias("n"), *sums, *products)


def _by_group(rows: DataFrame, estimate: DataFrame) -> DataFrame:
    return rows.join(sent(estimate, 100_000), "grp")


def robust_estimates(rows: DataFrame) -> DataFrame:
    """(grp, m, w, scale) of rows (grp, features): centre, whitening matrix, and the factor that
    gives distances the median of a chi-square variable."""
    at = [F.percentile_approx(f, 0.5).alias(f"c{i}") for i, f in enumerate(FEATURES)]
    centres = pinned(rows.groupBy("grp").agg(*at))
    off = [F.percentile_approx(F.abs(F.col(f) - F.col(f"c{i}")), 0.5).alias(f"a{i}") for i, f in enumerate(FEATURES)]
    spread = _by_group(rows, centres).groupBy("grp").agg(*off).join(centres, "grp")
    middle = F.array(*[F.col(f"c{i}") for i in range(_D)]).alias("m")
    diagonal = [((F.col(f"a{i}") * 1.4826) ** 2 if i == j else F.lit(0.0)).alias(f"v{i}_{j}") for i, j in _CELLS]
    starts = [_factored(spread.select("grp", middle, *diagonal)), _estimate(_moments(rows))]
    ends = []
    for estimate in starts:
        estimate = pinned(estimate)
        for _ in range(STEPS):
            near = _by_group(rows, estimate).withColumn("d", _distance())
            border = pinned(near.groupBy("grp").agg(F.percentile_approx("d", SUPPORT).alias("border")))
            inner = near.join(sent(border, 100_000), "grp").where(F.col("d") <= F.col("border"))
            estimate = pinned(_estimate(_moments(inner)))
        ends.append(estimate)
    best = ends[0].union(ends[1]).groupBy("grp").agg(F.min_by(F.struct("m", "w"), "det").alias("b")).select("grp", "b.m", "b.w")
    best = pinned(best)
    middle = _by_group(rows, best).groupBy("grp").agg(F.percentile_approx(_distance(), 0.5).alias("middle"))
    return pinned(best.join(middle, "grp").select("grp", "m", "w", (F.lit(MEDIAN) / F.greatest("middle", F.lit(MEDIAN))).alias("scale")))


def _groups(usable: DataFrame) -> DataFrame:
    """(lang, source) to the group that its texts are judged in."""
    pairs = usable.groupBy("lang", "source").agg(F.count("*").alias("n"))
    large = F.col("n") >= LEAST
    rest = pairs.where(~large).groupBy(F.col("lang").alias("l")).agg(F.sum("n").alias("of_lang"))
    joined = pairs.join(rest, F.col("lang").eqNullSafe(F.col("l")), "left")
    name = F.when(large, F.struct(F.lit(0).alias("k"), F.col("lang").alias("a"), F.col("source").alias("b")))
    name = name.when(F.col("of_lang") >= LEAST, F.struct(F.lit(1).alias("k"), F.col("lang").alias("a"), F.lit(None).cast("string").alias("b")))
    name = name.otherwise(F.struct(F.lit(2).alias("k"), F.lit(None).cast("string").alias("a"), F.lit(None).cast("string").alias("b")))
    # A key without nulls, so that joins on it are plain.
    key = F.to_json(name, {"ignoreNullFields": "false"})
    return pinned(joined.select("lang", "source", key.alias("grp"), "n"))


def quality_verdicts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """Statistics of every document, `base_failed`, the scaled squared `distance` (null if it is
    not judged) and `kept`."""
    stats = text_statistics(docs, doc_id, text, lang, source)
    stats = stats.withColumn("lang", F.col("lang").cast("string")).withColumn("source", F.col("source").cast("string"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    stats = pinned(stats.withColumn("base_failed", failed))
    usable = stats.where(~F.col("base_failed"))
    groups = _groups(usable)
    large = groups.groupBy("grp").agg(F.sum("n").alias("size")).where(F.col("size") >= LEAST).select("grp")
    named = groups.select(F.col("lang").alias("l"), F.col("source").alias("s"), "grp").join(large, "grp")
    named = sent(pinned(named), 100_000)
    on = F.col("lang").eqNullSafe(F.col("l")) & F.col("source").eqNullSafe(F.col("s"))
    rows = pinned(usable.join(named, on).select("grp", *[c.alias(f) for f, c in features().items()]))
    estimates = robust_estimates(rows)
    judged = stats.join(named, on & ~F.col("base_failed"), "left").drop("l", "s")
    judged = judged.withColumns(features()).join(sent(estimates, 100_000), "grp", "left")
    distance = F.when(~F.col("base_failed"), _distance() * F.col("scale"))
    kept = ~F.col("base_failed") & (F.coalesce(distance, F.lit(0.0)) <= CUTOFF)
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", distance.alias("distance"), kept.alias("kept")
    )


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics and verdict of every whole text."""
    return quality_verdicts(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"))
