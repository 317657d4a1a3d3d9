"""Quality rules by robust multivariate outliers, with DataFrame and SQL functions only.

Each document has counts of its words, their characters, symbols, repeated lines and repeated three-word
windows, and of these a vector of transformed statistics: logarithms of the number and the mean length of
words, and arc sines of the roots of the shares of symbols, repeated lines and words in repeated windows.
Per language and source the minimum-covariance-determinant estimate is found by concentration steps: from
the mean and covariance of a subset, take the `SHARE` of rows with the smallest distances as the next one. Two
deterministic starts (all rows; distances from medians and median deviations) run side by side, the one
with the smaller determinant counts, and one step that weighs rows by their distance follows. A row is
rejected if its Mahalanobis distance from that estimate passes the fence of its group: the upper quartile of
the group's distances and `FENCE` times what lies between the quartiles more (for normal data a squared distance of
about 16), but not less than `LEAST_CUT`.

A step is one aggregation: rows add their counts, sums and products to a bin of their distance, and the
subset is the bins up to the one in which the share is reached. So no task orders the rows of a group, and a
group with a third of all rows costs no more than its rows. Statistics are whole multiples of 1e-6 and sums
are decimals, so results don't depend on the order of rows. The variances of `LEAST_SPREAD` are added to
each covariance, as most rows of a group may agree in a statistic. Groups with fewer than `MIN_ROWS` rows are
pooled by language, and pools that are still too small with each other.

Defined results: a null or empty text has no words, fails the base rules and is not kept; such rows take no
part in the estimates. Null languages and sources are groups like others. A pool with fewer than twice as
many rows as statistics rejects nothing. Repeated rows get equal results, an empty table gives an empty one,
other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardwatch.llm.common import SPACES, save

MIN_WORDS = 50
REPEAT_PERCENT = 50
SHARE = 0.75
STEPS = 6
MIN_ROWS = 100
#: Bins of the squared distance are this many per factor e.
BIN = 50
UNIT = 1_000_000
STATS = ["log_words", "log_word_chars", "symbols", "dup_lines", "repeats"]
LEAST_SPREAD = [0.25, 0.05, 0.05, 0.15, 0.15]
#: Quantiles of chi squared with five degrees of freedom: half, 97.5 % and 99.9 %.
MEDIAN, WEIGHT_LIMIT, LEAST_CUT = 4.3515, 12.8325, 20.5150
FENCE = 1.5
P = len(STATS)
PAIRS = [(i, j) for i in range(P) for j in range(i + 1)]


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the counts of each text."""
    spaces = " \t\n\x0b\x0c\r"
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        "lang",
        "source",
        F.btrim(text, F.lit(spaces)).alias("body"),
        F.length(F.translate(text, spaces, "")).cast("bigint").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).cast("bigint").alias("n_symbols"),
        F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(spaces)) != "").alias("lines"),
    )
    rows = rows.select(
        "doc_id",
        "lang",
        "source",
        "word_chars",
        "n_symbols",
        F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.when(F.col("body") == "", F.array().cast("array<string>")).otherwise(F.split("body", SPACES)).alias("words"),
    )
    base = ["doc_id", "lang", "source", "word_chars", "n_symbols", "n_lines", "n_dup_lines"]
    windows = "transform(sequence(0, size(words) - 3), i -> xxhash64(words[i], words[i + 1], words[i + 2]))"
    rows = rows.select(
        *base,
        F.size("words").cast("bigint").alias("n_words"),
        F.expr(f"if(size(words) >= 3, {windows}, cast(array() AS array<bigint>))").alias("hashes"),
    )
    # places of the windows found twice or more: those with a neighbour of equal hash in the sorted order
    rows = rows.select(
        *base,
        "n_words",
        F.expr("""
            if(size(array_distinct(hashes)) < size(hashes),
               sort_array(transform(hashes, (h, i) -> struct(h, i))), NULL)
        """).alias("sorted"),
    )
    rows = rows.select(
        *base,
        "n_words",
        F.expr("""
            if(sorted IS NULL, cast(array() AS array<int>), sort_array(filter(
                transform(array(struct(sorted.h AS h, sorted.i AS i)), s -> transform(s.i, (x, j) ->
                    if(get(s.h, j - 1) <=> get(s.h, j) OR get(s.h, j + 1) <=> get(s.h, j), x, -1)))[0],
                i -> i >= 0)))
        """).alias("places"),
    )
    covered = "aggregate(transform(places, (x, j) -> least(3, coalesce(get(places, j + 1) - x, 3))), 0, (a, x) -> a + x)"
    return rows.select(*base, "n_words", F.expr(covered).cast("bigint").alias("n_repeat_words"))


def _vector() -> list[Column]:
    def share(a: str, b: str) -> Column:
        return F.asin(F.sqrt(F.least(F.lit(1.0), F.col(a) / F.greatest(F.lit(1), F.col(b)))))

    values = [
        F.log1p("n_words"),
        F.log(F.greatest(F.lit(1), F.col("word_chars")) / F.greatest(F.lit(1), F.col("n_words"))),
        share("n_symbols", "word_chars"),
        share("n_dup_lines", "n_lines"),
        share("n_repeat_words", "n_words"),
    ]
    return [F.round(v * UNIT).cast("bigint").alias(f"x{i}") for i, v in enumerate(values)]


def _pooled(rows: DataFrame, min_rows: int) -> DataFrame:
    """The rows with the column g: the group whose estimate counts for them."""
    name = lambda *c: F.to_json(F.struct(*c), {"ignoreNullFields": "false"})
    fine = rows.groupBy("lang", "source").agg(F.count("*").alias("n"))
    fine = fine.withColumn("small", F.col("n") < min_rows)
    fine = fine.withColumn("pool", F.sum(F.when(F.col("small"), F.col("n")).otherwise(0)).over(Window.partitionBy("lang")))
    g = F.when(~F.col("small"), name("lang", "source")).when(F.col("pool") >= min_rows, name("lang")).otherwise("{}")
    named = save(fine.select(F.col("lang").alias("g_lang"), F.col("source").alias("g_source"), g.alias("g")), "groups")
    same = F.col("lang").eqNullSafe(F.col("g_lang")) & F.col("source").eqNullSafe(F.col("g_source"))
    return rows.join(named, same).drop("g_lang", "g_source")


def _moments() -> list[Column]:
    x = [F.col(f"x{i}").cast("decimal(19,0)") for i in range(P)]
    sums = [F.sum(x[i]).cast("decimal(38,0)").alias(f"s{i}") for i in range(P)]
    products = [F.sum((x[i] * x[j]).cast("decimal(38,0)")).alias(f"p{i}{j}") for i, j in PAIRS]
    return [F.count("*").alias("n"), *sums, *products]


def _estimate(sums: DataFrame) -> DataFrame:
    """Means, the Cholesky factor of the covariance and the logarithm of its determinant from moments."""
    keys = [c for c in sums.columns if c in ("g", "start")]
    n = F.col("n").cast("double")
    mean = [F.col(f"s{i}").cast("double") / n / UNIT for i in range(P)]
    rows = sums.select(*keys, "n", *[m.alias(f"m{i}") for i, m in enumerate(mean)], *[f"p{i}{j}" for i, j in PAIRS])
    for i in range(P):
        for j in range(i + 1):
            own = F.col(f"p{i}{j}").cast("double") / n / UNIT / UNIT - F.col(f"m{i}") * F.col(f"m{j}")
            if i == j:
                own = F.greatest(own, F.lit(0.0)) + LEAST_SPREAD[i] ** 2
            for k in range(j):
                own = own - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            rows = rows.withColumn(f"l{i}{j}", F.sqrt(F.greatest(own, F.lit(1e-12))) if i == j else own / F.col(f"l{j}{j}"))
    det = sum((F.log(F.col(f"l{i}{i}")) for i in range(P)), F.lit(0.0)) * 2
    return rows.select(*keys, *[f"m{i}" for i in range(P)], *[f"l{i}{j}" for i, j in PAIRS], det.alias("log_det"))


def _distance(rows: DataFrame) -> DataFrame:
    """The squared Mahalanobis distance d2 by forward substitution."""
    for i in range(P):
        left = F.col(f"x{i}") / UNIT - F.col(f"m{i}")
        for k in range(i):
            left = left - F.col(f"l{i}{k}") * F.col(f"z{k}")
        rows = rows.withColumn(f"z{i}", left / F.col(f"l{i}{i}"))
    return rows.withColumn("d2", sum((F.col(f"z{i}") ** 2 for i in range(P)), F.lit(0.0)))


def _bin(d2: Column) -> Column:
    return F.floor(F.log(d2 + 1e-9) * BIN).cast("int")


def _concentrate(rows: DataFrame, share: float) -> DataFrame:
    """Moments of the rows in the bins up to the one in which the share is reached, per group and start."""
    bins = rows.groupBy("g", "start", _bin(F.col("d2")).alias("bin")).agg(*_moments())
    w = Window.partitionBy("g", "start")
    run = F.sum("n").over(w.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1))
    bins = bins.withColumn("seen", F.coalesce(run, F.lit(0))).withColumn("whole", F.sum("n").over(w))
    names = ["n", *[f"s{i}" for i in range(P)], *[f"p{i}{j}" for i, j in PAIRS]]
    return bins.where(F.col("seen") < F.ceil(F.col("whole") * share)).groupBy("g", "start").agg(
        *[F.sum(c).alias(c) for c in names]
    )


def _medians(rows: DataFrame) -> DataFrame:
    """Median c and median deviation r of each statistic per group, from counts of its rounded values."""
    value = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.expr(f"x{i} div 1000").alias("v")) for i in range(P)]))
    counts = rows.select("g", value.alias("x")).groupBy("g", "x.i", "x.v").agg(F.count("*").alias("n"))
    w = Window.partitionBy("g", "i")

    def half(df: DataFrame, by: str) -> DataFrame:
        df = df.withColumn("run", F.sum("n").over(w.orderBy(by))).withColumn("whole", F.sum("n").over(w))
        return df.where(F.col("run") * 2 >= F.col("whole")).groupBy("g", "i").agg(F.min(by).alias("mid"))

    centre = half(counts, "v").withColumnRenamed("mid", "c")
    away = counts.join(centre, ["g", "i"]).withColumn("v", F.abs(F.col("v") - F.col("c")))
    away = away.groupBy("g", "i", "v").agg(F.sum("n").alias("n"))
    both = centre.join(half(away, "v").withColumnRenamed("mid", "r"), ["g", "i"])
    out = both.groupBy("g").pivot("i", list(range(P))).agg(F.first("c").alias("c"), F.first("r").alias("r"))
    return out.select(
        "g",
        *[(F.col(f"{i}_c") / 1000).alias(f"c{i}") for i in range(P)],
        *[F.greatest(F.col(f"{i}_r") / 1000 * 1.4826, F.lit(LEAST_SPREAD[i])).alias(f"r{i}") for i in range(P)],
    )


def estimates(rows: DataFrame, share: float = SHARE, steps: int = STEPS) -> DataFrame:
    """The estimate of each group g: means, Cholesky factor, and the factor that makes distances consistent."""
    middle = save(_medians(rows), "medians")  # a row per group
    away = sum((((F.col(f"x{i}") / UNIT - F.col(f"c{i}")) / F.col(f"r{i}")) ** 2 for i in range(P)), F.lit(0.0))
    one = rows.select("*", F.lit(0).alias("start"), F.lit(0.0).alias("d2"))
    two = rows.join(middle, "g").select(*rows.columns, F.lit(1).alias("start"), away.alias("d2"))
    now = save(_estimate(_concentrate(one.union(two), share)), "mcd")
    for _ in range(steps):
        now = save(_estimate(_concentrate(_distance(rows.join(now, "g")), share)), "mcd")
    best = Window.partitionBy("g").orderBy("log_det", "start")
    now = now.withColumn("r", F.row_number().over(best)).where("r = 1").drop("r")
    return _consistent(rows, save(_reweighted(rows, _consistent(rows, now)), "mcd"))


def _consistent(rows: DataFrame, now: DataFrame) -> DataFrame:
    """Add the factor that brings the median of the squared distances to that of chi squared, and the fence."""
    bins = _distance(rows.join(now, "g")).groupBy("g", _bin(F.col("d2")).alias("bin")).agg(F.count("*").alias("n"))
    w = Window.partitionBy("g")
    bins = bins.withColumn("run", F.sum("n").over(w.orderBy("bin"))).withColumn("whole", F.sum("n").over(w))
    part = lambda k: F.min(F.when(F.col("run") * 4 >= F.col("whole") * k, F.exp((F.col("bin") + 0.5) / BIN)))
    quarters = bins.groupBy("g").agg(*[part(k).alias(f"q{k}") for k in (1, 2, 3)], F.first("whole").alias("n_rows"))
    factor = MEDIAN / F.greatest(F.col("q2"), F.lit(MEDIAN / 100))
    low, high = F.sqrt(F.col("q1") * factor), F.sqrt(F.col("q3") * factor)
    cut = F.greatest(F.lit(LEAST_CUT), (high + FENCE * (high - low)) ** 2)
    return now.join(quarters.select("g", factor.alias("factor"), cut.alias("cut"), "n_rows"), "g")


def _reweighted(rows: DataFrame, now: DataFrame) -> DataFrame:
    near = _distance(rows.join(now, "g")).where(F.col("d2") * F.col("factor") <= WEIGHT_LIMIT)
    return _estimate(near.groupBy("g").agg(*_moments())).withColumn("start", F.lit(0))


def verdicts(docs: DataFrame, min_rows: int = MIN_ROWS, share: float = SHARE, steps: int = STEPS) -> DataFrame:
    """Counts, base_failed, the squared robust distance, the cut of its group and kept of each row."""
    counts = save(statistics(docs), "statistics")
    rows = counts.where("n_words > 0").select("lang", "source", *_vector())
    fitted = save(_pooled(rows, min_rows).drop("lang", "source"), "vectors")
    found = save(estimates(fitted, share, steps), "mcd")
    pools = save(_pooled(counts.where("n_words > 0").select("lang", "source"), min_rows).distinct(), "pools")
    pools = pools.select(F.col("lang").alias("g_lang"), F.col("source").alias("g_source"), "g")
    found = pools.join(found, "g").drop("g")
    same = F.col("lang").eqNullSafe(F.col("g_lang")) & F.col("source").eqNullSafe(F.col("g_source"))
    placed = _distance(counts.select("*", *_vector()).join(found, same, "left"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    d2 = F.when(F.col("n_words") > 0, F.col("d2") * F.col("factor"))
    inside = (d2 <= F.col("cut")) | (F.col("n_rows") < 2 * P)
    return placed.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & F.coalesce(inside, F.lit(True))).alias("kept"),
        d2.alias("distance2"),
        "cut",
    )
