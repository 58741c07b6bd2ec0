"""Quality rules with robust multivariate outliers, by DataFrame operations only.

Each text has a few whole-number counts and from them a vector of transformed statistics. For each language and source
a minimum covariance determinant estimate gives the centre and the covariance of the most compact three
quarters of its texts; a text is rejected by its Mahalanobis distance from them.

The estimate starts from medians and absolute deviations and takes concentration steps: distances from
the present estimate, the closest three quarters, their mean and covariance. Which texts are
closest is read off a histogram of distances, and means and covariances are exact sums of whole numbers, so that a group of
any size is handled by partial sums and the result does not depend on the order of rows.
"""

from math import erf, exp, pi, sqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from souk.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "[#*$%&|<>]"
MIN_WORDS, MAX_REPEATED = 50, 50

#: Statistics are kept as whole thousandths.
SCALE = 1000
NAMES = ("word_length", "symbols", "repeated_lines", "repeated_words", "length")
#: The least standard deviation of each statistic: differences below it never make a text an outlier.
FLOORS = (1.0, 0.15, 0.25, 0.12, 1.0)
#: The share of a group's texts that an estimate rests on, concentration steps, and the chi-square probability beyond which texts go.
SUBSET, STEPS, PROBABILITY = 0.75, 4, 0.9995
#: Bins of a distance of one.
BINS = 64

P = len(NAMES)
PAIRS = [(i, j) for i in range(P) for j in range(i + 1)]


def chi_square(x: float, freedom: int) -> float:
    """The distribution function for an odd number of degrees of freedom."""
    out = erf(sqrt(x / 2))
    term = sqrt(2 * x / pi) * exp(-x / 2)
    for k in range(1, freedom - 1, 2):
        out -= term
        term *= x / (k + 2)
    return out


def chi_square_point(probability: float, freedom: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square(middle, freedom) < probability else (low, middle)
    return high


#: A normal sample's covariance over that of its most compact part.
CONSISTENCY = SUBSET / chi_square(chi_square_point(SUBSET, P), P + 2)
CUTOFF = chi_square_point(PROBABILITY, P)


def _let(value: Column, use) -> Column:
    return F.transform(F.array(value), use)[0]


def repeated_words(words: Column) -> Column:
    """Words that stand in a three-word window found twice or more in the text.

    Most texts repeat no window, which counting the distinct ones tells; in the others windows are sorted with their
    places, and the places of equal neighbours cover up to three words each.
    """

    def places(w: Column) -> Column:
        return F.when(F.size(w) >= 3, F.sequence(F.lit(0), F.size(w) - 3)).otherwise(F.array().cast("array<int>"))

    def covered(h: Column) -> Column:
        found = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def again(s: Column) -> Column:
            twice = F.filter(
                s,
                lambda x, i: ((i > 0) & (s[F.greatest(i - 1, F.lit(0))]["h"] == x["h"]))
                | ((i < F.size(s) - 1) & (s[F.least(i + 1, F.size(s) - 1)]["h"] == x["h"])),
            )
            at = F.array_sort(F.transform(twice, lambda x: x["i"]))
            return _let(
                at,
                lambda a: F.size(a) * 3
                - F.aggregate(
                    F.transform(a, lambda x, i: F.when(i > 0, F.greatest(F.lit(0), 3 - (x - a[F.greatest(i - 1, F.lit(0))]))).otherwise(0)),
                    F.lit(0),
                    lambda acc, x: acc + x,
                ),
            )

        return F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(_let(found, again))

    hashes = _let(words, lambda w: F.transform(places(w), lambda i: F.xxhash64(w[i], w[i + 1], w[i + 2])))
    return _let(hashes, covered).cast("long")


def base_counts(docs: DataFrame, text_col: str) -> DataFrame:
    """``docs`` with the counts of the whole text in place of the text; a null text has none."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    rest = [c for c in docs.columns if c != text_col]
    counted = docs.select(
        *rest, words.alias("_words"), lines.alias("_lines"), F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols")
    )
    return counted.select(
        *rest,
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        "n_symbols",
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("_words")).alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"),
    )


def statistics() -> list[Column]:
    """The transformed statistics, from the counts of a text with at least one word."""
    words = F.col("n_words").cast("double")
    return [
        F.round(SCALE * F.col("word_chars") / words),
        F.round(SCALE * F.sqrt(F.col("n_symbols") / words)),
        F.round(SCALE * F.sqrt(F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)).cast("double"))),
        F.round(SCALE * F.col("n_repeat_words") / words),
        F.round(SCALE * F.ln(words)),
    ]


def _start(rows: DataFrame) -> DataFrame:
    """Per group the medians as centre and squared deviations from them on the diagonal."""
    medians = [F.percentile(f"x{i}", 0.5).alias(f"m{i}") for i in range(P)]
    middle = materialize(rows.groupBy("g").agg(*medians), "medians")  # small: joined without a shuffle of the rows
    off = rows.join(middle, "g").groupBy("g").agg(
        *[F.percentile(F.abs(F.col(f"x{i}") - F.col(f"m{i}")), 0.5).alias(f"d{i}") for i in range(P)]
    )
    spread = [
        (F.greatest(F.col(f"d{i}") * 1.4826, F.lit(FLOORS[i] * SCALE)) * F.greatest(F.col(f"d{i}") * 1.4826, F.lit(FLOORS[i] * SCALE))).alias(f"c{i}{i}")
        if i == j
        else F.lit(0.0).alias(f"c{i}{j}")
        for i, j in PAIRS
    ]
    return middle.join(off, "g").select("g", *[f"m{i}" for i in range(P)], *spread)


def _factored(estimate: DataFrame) -> DataFrame:
    """The lower triangular root ``l`` of each covariance."""
    out = estimate
    for i, j in PAIRS:  # row by row
        rest = F.col(f"c{i}{j}")
        for k in range(j):
            rest = rest - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
        out = out.withColumn(f"l{i}{j}", F.sqrt(rest) if i == j else rest / F.col(f"l{j}{j}"))
    return out.select("g", *[f"m{i}" for i in range(P)], *[f"l{i}{j}" for i, j in PAIRS])


def _distances(rows: DataFrame, estimate: DataFrame) -> DataFrame:
    """``rows`` with the Mahalanobis distance ``dist`` from their group's estimate."""
    out = rows.join(materialize(_factored(estimate), "estimates"), "g")
    for i in range(P):
        rest = F.col(f"x{i}") - F.col(f"m{i}")
        for k in range(i):
            rest = rest - F.col(f"l{i}{k}") * F.col(f"z{k}")
        out = out.withColumn(f"z{i}", rest / F.col(f"l{i}{i}"))
    square = F.col("z0") * F.col("z0")
    for i in range(1, P):
        square = square + F.col(f"z{i}") * F.col(f"z{i}")
    return out.select(*rows.columns, F.sqrt(square).alias("dist"))


def _concentrated(rows: DataFrame, estimate: DataFrame) -> DataFrame:
    """Mean and covariance of the closest ``SUBSET`` of each group, with the floors added to the variances."""
    near = _distances(rows, estimate).withColumn("bin", F.least(F.floor(F.col("dist") * BINS), F.lit(1 << 40)))
    # sums of each bin, then of all bins up to the one that completes the subset
    whole = "decimal(38,0)"
    binned = near.groupBy("g", "bin").agg(
        F.count("*").alias("n"),
        *[F.sum(F.col(f"x{i}").cast("decimal(18,0)")).cast(whole).alias(f"s{i}") for i in range(P)],
        *[F.sum((F.col(f"x{i}") * F.col(f"x{j}")).cast("decimal(19,0)")).cast(whole).alias(f"s{i}{j}") for i, j in PAIRS],
    )
    up_to = Window.partitionBy("g").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    all_of = Window.partitionBy("g")
    before = F.coalesce(F.sum("n").over(up_to), F.lit(0))
    kept = binned.withColumn("before", before).withColumn("total", F.sum("n").over(all_of)).where(F.col("before") < SUBSET * F.col("total"))
    sums = kept.groupBy("g").agg(
        F.sum("n").cast("double").alias("n"),
        *[F.sum(f"s{i}").cast("double").alias(f"s{i}") for i in range(P)],
        *[F.sum(f"s{i}{j}").cast("double").alias(f"s{i}{j}") for i, j in PAIRS],
    )
    n = F.col("n")
    covariance = [
        (
            CONSISTENCY * (F.col(f"s{i}{j}") / n - (F.col(f"s{i}") / n) * (F.col(f"s{j}") / n))
            + (F.lit((FLOORS[i] * SCALE) * (FLOORS[i] * SCALE)) if i == j else F.lit(0.0))
        ).alias(f"c{i}{j}")
        for i, j in PAIRS
    ]
    return sums.select("g", *[(F.col(f"s{i}") / n).alias(f"m{i}") for i in range(P)], *covariance)


def rated(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    group_cols: tuple[str, ...] = ("lang", "source"),
) -> DataFrame:
    """``(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, distance, kept)`` for every row.

    Texts that fail the base rules are not kept, take no part in the estimates and have no distance. Nulls in the group
    columns are a group of their own. In a group of one text, or of equal texts, the distance is 0. Repeated
    rows count as often as they are there. An empty table gives no rows.
    """
    named = base_counts(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.to_json(F.struct(*[F.col(c).alias(f"g{k}") for k, c in enumerate(group_cols)])).alias("g"),
            F.col(text_col).alias("_text"),
        ),
        "_text",
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    named = materialize(named.withColumn("base_failed", failed), "text-counts")
    passed = named.where("not base_failed")
    rows = passed.select("g", *[x.cast("long").alias(f"x{i}") for i, x in enumerate(statistics())])
    estimate = materialize(_start(rows), "estimates")
    for _ in range(STEPS):
        estimate = materialize(_concentrated(rows, estimate), "estimates")
    shown = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    wide = passed.select("g", *shown, *[x.cast("long").alias(f"x{i}") for i, x in enumerate(statistics())])
    measured = _distances(wide, estimate).select(*shown, F.col("dist").alias("distance"))
    measured = measured.withColumn("kept", F.col("distance") * F.col("distance") <= CUTOFF)
    rest = named.where("base_failed").select(*shown, F.lit(None).cast("double").alias("distance"), F.lit(False).alias("kept"))
    return measured.unionByName(rest)
