"""Quality rules: minimum-covariance-determinant estimates per language and source.

All of it is DataFrame and SQL functions. Text statistics are computed in the row. Location and
scatter come from concentration steps: each takes the rows nearest to the present estimate (a share
``support`` of the group) and estimates anew from them. A step is one aggregation: rows are summed
by (group, distance bin), at most a few thousand sums a group, and the bins up to the wanted share
are added up. So a group with a third of all rows is pre-aggregated in every task, nothing is
sampled, and the estimate does not depend on how rows are dealt out.

Edge cases: a NULL text has no words; NULL languages and sources form groups of their own; groups
with fewer than ``min_rows`` rows that pass the base rule are estimated together with the other small
groups of their language, or of all; where even those are fewer, and for groups without such rows, there is no
estimate and the base verdict stands. Repeated rows count as often as they occur. Extra columns pass
through; columns named like the results are replaced.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annexport.llm.common import WORD, fresh
from annexport.session import staged

SUPPORT = 0.75
STEPS = 3
MIN_ROWS = 50
TAIL = 1e-6  # share of rows a normal population would lose

# Fixed tolerances: the smallest standard deviation a statistic is given in its transformed unit,
# so that a group of copies, or a statistic that is zero nearly everywhere, rejects no ordinary text.
FEATURES = {
    "log_words": 0.5,
    "log_word_length": 0.08,
    "root_symbols": 0.05,
    "root_dup_lines": 0.2,
    "root_repeats": 0.2,
}
MAX_SENT = 50_000  # groups whose estimates (about 200 bytes each) are broadcast
BINS = 16  # per unit of the logarithm of a squared distance
QUANTILE_BINS = 200  # per transformed unit
P = len(FEATURES)
PAIRS = [(j, k) for j in range(P) for k in range(j + 1)]
MIN_WORDS = 50
MAX_REPEATS = 50  # per cent of the words

RESULT = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the statistics named in ``RESULT`` and ``n_lines``.

    Repeats: hashes of 3-word windows are sorted, equal ones next to each other; equal neighbours are repeats,
    and the union of the intervals [place, place + 3) is the sum of min(3, distance to the next).
    Windows are compared by a 64-bit hash of their words: within one text of a million words, two
    different windows get the same hash with a chance of about 1e-7.
    """
    docs = docs.drop(*RESULT, "n_lines")
    names = {}
    for name in ("_text", "_words", "_lines", "_windows", "_order", "_places"):
        names[name] = fresh(docs, name)
    c = {k: F.col(v) for k, v in names.items()}
    rows = docs.withColumn(names["_text"], F.coalesce(F.col(text), F.lit("")))
    rows = rows.withColumns({
        names["_words"]: F.regexp_extract_all(c["_text"], F.lit(WORD), F.lit(0)),
        names["_lines"]: F.filter(
            F.split(c["_text"], "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")
        ),
    })
    rows = rows.withColumn(
        names["_windows"],
        F.when(
            F.size(c["_words"]) >= 3,
            F.transform(
                F.sequence(F.lit(0), F.size(c["_words"]) - 3),
                lambda i: F.xxhash64(
                    F.get(c["_words"], i), F.get(c["_words"], i + 1), F.get(c["_words"], i + 2)
                ),
            ),
        ).otherwise(F.array().cast("array<bigint>")),
    )
    # Only texts that repeat a window at all are sorted: hash prefixes with the place in the low
    # bits, as plain longs. Where two windows share a prefix but not a hash, their places could
    # alternate; such a text is sorted by whole hash and place.
    low = F.when(F.size(c["_windows"]) < 2**24, F.lit(2**24 - 1)).otherwise(F.lit(2**31 - 1)).cast("long")
    rows = rows.withColumn(
        names["_order"],
        F.when(
            F.size(F.array_distinct(c["_windows"])) < F.size(c["_windows"]),
            F.sort_array(F.transform(
                c["_windows"], lambda h, i: h.bitwiseAND(F.bitwise_not(low)).bitwiseOR(i.cast("long"))
            )),
        ).otherwise(F.array().cast("array<bigint>")),
    )
    order, windows = c["_order"], c["_windows"]
    place = lambda x: x.bitwiseAND(low).cast("int")

    def mixed(e: Column, k: Column) -> Column:
        both = e.bitwiseXOR(F.get(order, k + 1))
        return (both <= low) & (both >= 0) & (F.get(windows, place(e)) != F.get(windows, place(F.get(order, k + 1))))

    rows = rows.withColumn(
        names["_order"],
        F.when(
            F.exists(F.transform(order, mixed), lambda x: F.coalesce(x, F.lit(False))),
            F.transform(
                F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), lambda x: x["i"]
            ),
        ).otherwise(F.transform(order, place)),
    )

    def same(i: Column, other: Column) -> Column:
        return F.get(windows, i) == F.get(windows, other)

    rows = rows.withColumn(
        names["_places"],
        F.sort_array(F.filter(
            F.transform(order, lambda i, k: F.when(same(i, F.get(order, k + 1)) | same(i, F.get(order, k - 1)), i)),
            lambda i: i.isNotNull(),
        )),
    )
    places = c["_places"]
    repeats = F.aggregate(
        F.transform(places, lambda i, k: F.least(F.lit(3), F.coalesce(F.get(places, k + 1) - i, F.lit(3)))),
        F.lit(0), lambda a, x: a + x,
    )
    rows = rows.withColumns({
        "n_words": F.size(c["_words"]).cast("long"),
        "word_chars": F.length(F.array_join(c["_words"], "")).cast("long"),
        "n_symbols": F.regexp_count(c["_text"], F.lit(r"[#*$%&|<>]")).cast("long"),
        "n_lines": F.size(c["_lines"]).cast("long"),
        "n_dup_lines": (F.size(c["_lines"]) - F.size(F.array_distinct(c["_lines"]))).cast("long"),
        "n_repeat_words": repeats.cast("long"),
    }).drop(*names.values())
    return rows.withColumn(
        "base_failed",
        (F.col("n_words") < MIN_WORDS)
        | (100 * F.col("n_repeat_words") > MAX_REPEATS * F.col("n_words")),
    )


def features() -> dict[str, Column]:
    """The transformed statistics, each near to normal in ordinary prose."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    return {
        "log_words": F.log1p(F.col("n_words").cast("double")),
        "log_word_length": F.log1p(F.col("word_chars") / words),
        "root_symbols": F.sqrt(F.col("n_symbols") / F.greatest(F.col("word_chars"), F.lit(1))),
        "root_dup_lines": F.sqrt(F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))),
        "root_repeats": F.sqrt(F.col("n_repeat_words") / words),
    }


def chi2_cdf(x: float, k: int) -> float:
    """Chi-square distribution function, by the series of the incomplete gamma function."""
    a, x = k / 2, x / 2
    if x <= 0:
        return 0.0
    term = total = 1 / a
    n = 0
    while term > total * 1e-17:
        n += 1
        term *= x / (a + n)
        total += term
    return min(1.0, total * math.exp(a * math.log(x) - x - math.lgamma(a)))


def chi2_quantile(q: float, k: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_cdf(mid, k) < q else (low, mid)
    return (low + high) / 2


def consistency(support: float) -> float:
    """Factor that makes the scatter of the nearest share right for a normal population."""
    return support / chi2_cdf(chi2_quantile(support, P), P + 2)


def _with_group(rows: DataFrame, groups: DataFrame, on: str, how: str = "inner") -> DataFrame:
    """``rows`` with their group's row. The groups are sent to all tasks if they are counted to be
    few, so that a group with a third of the rows stays spread. More are joined by a shuffle whose
    skewed partitions Spark splits, and the result is staged before anything is grouped."""
    if groups.count() <= MAX_SENT:
        return rows.join(F.broadcast(groups), on, how)
    return staged(rows.join(groups, on, how), "joined")


def _start(rows: DataFrame, key: str) -> DataFrame:
    """Medians and quartile ranges by group, from counts by bin: the first estimate."""
    cells = staged(rows.select(
        key, F.posexplode(F.array(*[F.floor(F.col(f"x{j}") * QUANTILE_BINS) for j in range(P)])).alias("j", "bin")
    ).groupBy(key, "j", "bin").count(), "bins")
    upto = Window.partitionBy(key, "j").orderBy("bin")
    whole = Window.partitionBy(key, "j")
    ranks = cells.select(
        key, "j", "bin", F.sum("count").over(upto).alias("c"), F.sum("count").over(whole).alias("n")
    )

    def at(q: float) -> Column:
        return (F.min(F.when(F.col("c") >= q * F.col("n"), F.col("bin"))) + F.lit(0.5)) / QUANTILE_BINS

    quartiles = ranks.groupBy(key, "j").agg(
        at(0.25).alias("a"), at(0.5).alias("m"), at(0.75).alias("b"), F.max("n").alias("n")
    )
    floors = F.array(*[F.lit(v) for v in FEATURES.values()])
    spread = F.sqrt(F.pow((F.col("b") - F.col("a")) / 1.349, 2) + F.pow(F.get(floors, F.col("j")), 2))
    return quartiles.groupBy(key).agg(
        F.max("n").alias("n"),
        *[F.max(F.when(F.col("j") == j, F.col("m"))).alias(f"m{j}") for j in range(P)],
        *[
            (F.max(F.when(F.col("j") == j, spread)) if j == k else F.first(F.lit(0.0))).alias(f"l{j}{k}")
            for j, k in PAIRS
        ],
    )


def _distance(rows: DataFrame) -> DataFrame:
    """Adds the squared Mahalanobis distance ``d2``, by forward substitution with the factor."""
    for j in range(P):
        rest = reduce(
            lambda a, k: a - F.col(f"l{j}{k}") * F.col(f"y{k}"), range(j), F.col(f"x{j}") - F.col(f"m{j}")
        )
        rows = rows.withColumn(f"y{j}", rest / F.col(f"l{j}{j}"))
    return rows.withColumn("d2", reduce(lambda a, b: a + b, [F.col(f"y{j}") * F.col(f"y{j}") for j in range(P)]))


def _step(rows: DataFrame, estimate: DataFrame, key: str, support: float) -> DataFrame:
    """One concentration step: a new centre and Cholesky factor by group."""
    # Staged, so that the tasks' sums meet by (group, bin), and only whole bins by group.
    near = staged(_distance(_with_group(rows, estimate, key)).groupBy(
        key, F.floor(F.log(F.col("d2") + 1e-9) * BINS).alias("bin")
    ).agg(
        F.count(F.lit(1)).alias("c"),
        *[F.sum(f"x{j}").alias(f"s{j}") for j in range(P)],
        *[F.sum(F.col(f"x{j}") * F.col(f"x{k}")).alias(f"s{j}{k}") for j, k in PAIRS],
    ), "bins")
    before = Window.partitionBy(key).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    near = near.withColumn("before", F.coalesce(F.sum("c").over(before), F.lit(0))).withColumn(
        "n", F.sum("c").over(Window.partitionBy(key))
    ).where(F.col("before") < support * F.col("n"))
    sums = near.groupBy(key).agg(
        F.max("n").alias("n"), F.sum("c").alias("h"),
        *[F.sum(f"s{j}").alias(f"s{j}") for j in range(P)],
        *[F.sum(f"s{j}{k}").alias(f"s{j}{k}") for j, k in PAIRS],
    )
    sums = sums.withColumns({f"m{j}": F.col(f"s{j}") / F.col("h") for j in range(P)})
    scale, floors = consistency(support), list(FEATURES.values())
    sums = sums.withColumns({
        f"v{j}{k}": scale * (F.col(f"s{j}{k}") / F.col("h") - F.col(f"m{j}") * F.col(f"m{k}"))
        + (floors[j] ** 2 if j == k else 0.0)
        for j, k in PAIRS
    })
    for j, k in PAIRS:
        rest = reduce(lambda a, i: a - F.col(f"l{j}{i}") * F.col(f"l{k}{i}"), range(k), F.col(f"v{j}{k}"))
        sums = sums.withColumn(f"l{j}{k}", F.sqrt(rest) if j == k else rest / F.col(f"l{k}{k}"))
    return sums.select(key, "n", *[f"m{j}" for j in range(P)], *[f"l{j}{k}" for j, k in PAIRS])


def outlier_verdicts(
    rows: DataFrame, by: tuple[str, ...] = ("lang", "source"), support: float = SUPPORT,
    steps: int = STEPS, min_rows: int = MIN_ROWS, tail: float = TAIL,
) -> DataFrame:
    """Rows of ``with_statistics`` with ``distance`` (squared; NULL without an estimate) and ``kept``.

    ``kept`` is false for rows that fail the base rule and for rows beyond the chi-square quantile
    of their group's estimate. Rows are staged once; only five numbers a row are read again.
    """
    rows = staged(rows.drop("distance", "kept"), "statistics")
    key, key_name = fresh(rows, "group_key"), fresh(rows, "_group")
    rows = rows.withColumn(key_name, F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in by]))
    # Small groups are estimated together, by the first of the grouping columns, and what is still
    # few all together.
    passed = rows.where(~F.col("base_failed"))
    sizes = passed.groupBy(key_name, F.xxhash64(F.coalesce(F.col(by[0]).cast("string"), F.lit("\0"))).alias("wide")).count()
    small = F.col("count") < min_rows
    pooled = F.sum(F.when(small, F.col("count"))).over(Window.partitionBy("wide"))
    groups = staged(sizes.select(key_name, F.when(~small, F.col(key_name)).when(
        pooled >= min_rows, F.xxhash64("wide", F.lit("pooled"))
    ).otherwise(F.lit(0)).alias(key)), "groups")
    # x0.. are computed in a fixed order from the staged statistics, in every pass.
    vectors = _with_group(passed, groups, key_name).select(
        key, *[x.alias(f"x{j}") for j, x in enumerate(features().values())]
    )
    estimate = staged(_start(vectors, key).where(F.col("n") >= min_rows), "estimate")
    for _ in range(steps):
        estimate = staged(_step(vectors, estimate, key, support), "estimate")
    limit = chi2_quantile(1 - tail, P)
    # The distance is one expression of the row and its group's estimate, kept in one struct, so
    # that no input column can clash with it.
    own = fresh(rows, "_estimate")
    packed = groups.join(estimate, key).select(key_name, F.struct(*estimate.columns).alias(own))
    joined = _with_group(rows, staged(packed, "estimate"), key_name, "left")
    x = list(features().values())
    e = F.col(own)
    y: list[Column] = []
    solved = [fresh(rows, f"_y{j}") for j in range(P)]
    for j in range(P):
        rest = reduce(lambda a, k: a - e[f"l{j}{k}"] * F.col(solved[k]), range(j), x[j] - e[f"m{j}"])
        joined = joined.withColumn(solved[j], rest / e[f"l{j}{j}"])
        y.append(F.col(solved[j]))
    joined = joined.withColumn("distance", reduce(lambda a, b: a + b, [v * v for v in y]))
    return joined.withColumn(
        "kept", ~F.col("base_failed") & F.coalesce(F.col("distance") <= limit, F.lit(True))
    ).drop(own, key_name, *solved)
