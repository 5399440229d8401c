"""Quality rules: robust multivariate outliers, in DataFrame operations only.

Every text gives a vector of transformed statistics. Per language and source, the minimum-covariance-determinant
estimate of centre and scatter is found by concentration steps: each step takes the share ``CORE`` of rows with the
smallest Mahalanobis distances and estimates again, until the determinant falls no more (at most ``STEPS``). Steps
begin at the medians with three scatters, of absolute deviations alone and with correlations of spatial signs or of
hyperbolic tangents, of which the first step takes the nearer half; the result of the least determinant stays. A step is two aggregations
with partial results per task, over a stored table of vectors, so a language or source of any size is no hot spot.
Distances come from a Cholesky factor, whose entries are columns of the small table of groups.

Scatter has a floor per statistic (``FLOOR``), because most texts have no symbols and no repeats at all and would
otherwise make a single symbol an outlier. By one law at all sizes, the estimate of n rows is mixed with the one above
it, of the language over all rows and of the group over its language: its own has the weight n / (n + ``STRENGTH``), and
the distance of both centres counts as scatter. A null language or source is a group value like any other.

Null and empty texts have no words and fail the base rule. Ties of distance stay together. Repeated rows count as
often as they occur. If no row passes the base rule, nothing is estimated and nothing is kept.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.base import stored

_BLANK = " \\x09-\\x0D"
#: The transformed statistics, as SQL.
VECTOR = {
    "v_words": "log1p(n_words)",
    "v_length": "ln(try_divide(word_chars, n_words))",
    "v_symbols": "log1p(try_divide(n_symbols * 100, word_chars))",
    "v_lines": "log1p(n_dup_lines)",
    "v_repeats": "sqrt(try_divide(n_repeat_words, n_words))",
}
FLOOR = {"v_words": 0.15, "v_length": 0.05, "v_symbols": 0.15, "v_lines": 0.25, "v_repeats": 0.08}
CORE, STEPS = 0.75, 50
#: So many rows weigh as much as the estimate above a group.
STRENGTH = 10
#: A determinant that falls by less, in its logarithm, has converged.
SETTLED = 1e-9
#: Parts of every group in joins of rows with group estimates, whose rows are repeated so often.
PARTS = 64
#: Quantiles of the chi-squared distribution with five degrees of freedom: the median, and the one of 0.999.
CHI2_MEDIAN, CUTOFF = 4.351, 20.515


def statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, source) and the counts of every whole text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", "lang", "source", text.alias("text"))
    rows = rows.withColumn("words", F.array_remove(F.split("text", f"[{_BLANK}]+"), ""))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(f"[^{_BLANK}]"))
    # Windows of three words, sorted by hash: equal ones are neighbours.
    threes = F.expr(
        "IF(size(words) < 3, array(), transform(sequence(0, size(words) - 3), i -> struct("
        "xxhash64(get(words, i), get(words, i + 1), get(words, i + 2)) AS h, i AS i)))"
    )
    rows = rows.select("*", lines.alias("lines"), F.sort_array(threes).alias("threes"))
    twice = F.expr("transform(filter(threes, (x, k) -> x.h = get(threes, k - 1).h OR x.h = get(threes, k + 1).h), x -> x.i)")
    rows = rows.withColumn("twice", F.sort_array(twice))
    covered = F.expr("aggregate(transform(twice, (x, k) -> least(3, coalesce(get(twice, k + 1) - x, 3))), 0L, (a, x) -> a + x)")
    return rows.select(
        "doc_id",
        "lang",
        "source",
        F.size("words").cast("bigint").alias("n_words"),
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        F.length(F.regexp_replace("text", "[^#*$%&|<>]+", "")).cast("bigint").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        covered.alias("n_repeat_words"),
    ).withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def _dealt(rows: DataFrame) -> DataFrame:
    """Rows with a part, by their place in the table: equal rows are dealt out as well. To be stored before use."""
    return rows.withColumn("_part", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(PARTS)).cast("int"))


def _with_estimates(rows: DataFrame, estimates: DataFrame, group: str) -> DataFrame:
    """Join rows with the estimates of their group, in parts, so that rows of one group meet in no single task."""
    parts = estimates.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
    return rows.join(parts, [group, "_part"]).drop("_part")


def _squared_distance(values: list[str]) -> Column:
    """Mahalanobis distance, squared, by forward substitution with the factor's columns."""
    solved: list[Column] = []
    for i, name in enumerate(values):
        rest = F.col(name) - F.col(f"m_{name}")
        for j in range(i):
            rest = rest - F.col(f"l_{i}_{j}") * solved[j]
        solved.append(rest / F.col(f"l_{i}_{i}"))
    return sum((z * z for z in solved[1:]), solved[0] * solved[0])


def _factored(groups: DataFrame, values: list[str], floor: dict[str, float], raised: bool = False) -> DataFrame:
    """Groups with the Cholesky factor of their scatter c_i_j, each variance raised by its floor if not ``raised`` before."""
    for i, name in enumerate(values):
        for j in range(i + 1):
            entry = F.col(f"c_{i}_{j}") + (floor[name] ** 2 if i == j and not raised else 0.0)
            for k in range(j):
                entry = entry - F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}")
            # The floor keeps every pivot above zero, up to rounding.
            value = F.sqrt(F.greatest(entry, F.lit(floor[name] ** 2 / 4))) if i == j else entry / F.col(f"l_{j}_{j}")
            groups = groups.withColumn(f"l_{i}_{j}", value)
    groups = groups.withColumn("log_det", sum((F.log(f"l_{i}_{i}") for i in range(1, len(values))), F.log("l_0_0")))
    return stored(groups.drop(*[f"c_{i}_{j}" for i in range(len(values)) for j in range(i + 1)]), "scatter")


def _starts(rows: DataFrame, group: str, floor: dict[str, float]) -> DataFrame:
    """Three starts per group, all at the medians: scatter by absolute deviations, with different correlations."""
    values = list(floor)
    pairs = [(i, j) for i in range(len(values)) for j in range(i)]
    median = {v: F.percentile_approx(v, 0.5).alias(f"m_{v}") for v in values}
    centre = stored(rows.groupBy(group).agg(*median.values()), "centre")
    spread = _with_estimates(rows, centre, group).groupBy(group).agg(
        *[F.first(f"m_{v}").alias(f"m_{v}") for v in values],
        *[(1.4826 * F.percentile_approx(F.abs(F.col(v) - F.col(f"m_{v}")), 0.5)).alias(f"s_{v}") for v in values],
    )
    spread = stored(spread, "spread")
    z = [((F.col(v) - F.col(f"m_{v}")) / F.sqrt(F.col(f"s_{v}") ** 2 + floor[v] ** 2)).alias(f"z_{v}") for v in values]
    scaled = _with_estimates(rows, spread, group).select(group, *z)
    size = F.sqrt(sum((F.col(f"z_{v}") ** 2 for v in values[1:]), F.col(f"z_{values[0]}") ** 2))
    sign = lambda v: F.coalesce(F.try_divide(f"z_{v}", "_size"), F.lit(0.0))
    bent = lambda v: F.tanh(f"z_{v}")
    alike = lambda x, y: F.coalesce(F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y)), F.lit(0.0))
    found = scaled.withColumn("_size", size).groupBy(group).agg(
        *[alike(f(values[i]), f(values[j])).alias(f"{k}_{i}_{j}") for k, f in (("sign", sign), ("bent", bent)) for i, j in pairs]
    )
    entry = lambda i, j, r: (F.col(f"s_{values[i]}") * F.col(f"s_{values[j]}") * r).alias(f"c_{i}_{j}")
    kinds = [
        F.struct(
            F.lit(n).alias("_start"),
            *[entry(i, i, F.lit(1.0)) for i in range(len(values))],
            *[entry(i, j, F.col(f"{k}_{i}_{j}") if k else F.lit(0.0)) for i, j in pairs],
        )
        for n, k in enumerate((None, "sign", "bent"))
    ]
    return spread.join(found, group).select(group, *[f"m_{v}" for v in values], F.explode(F.array(*kinds)).alias("_kind")).select("*", "_kind.*").drop("_kind")


def robust_scatter(rows: DataFrame, group: str, floor: dict[str, float], core: float = CORE, steps: int = STEPS) -> DataFrame:
    """Centre and factor of each group of ``rows``, with ``scale``, which makes the median distance that of chi-squared."""
    values, key = list(floor), [group, "_start"]
    rows = rows if "_part" in rows.columns else stored(_dealt(rows), "dealt")
    found = _factored(_starts(rows, group, floor), values, floor).withColumn("log_det", F.lit(float("inf")))
    settled = []
    for step in range(steps):
        # From a start, the nearer half is taken first: outliers draw on medians and correlations as well.
        share = core if step else 0.5
        distances = _with_estimates(rows, found, group).select(*key, _squared_distance(values).alias("_d"))
        border = stored(distances.groupBy(*key).agg(F.percentile_approx("_d", share, F.lit(1000)).alias("_border")), "border")
        inner = _with_estimates(rows, found.join(border, key), group).filter(_squared_distance(values) <= F.col("_border"))
        better = _factored(
            inner.groupBy(*key).agg(
                F.first("log_det").alias("_before"),
                *[F.avg(v).alias(f"m_{v}") for v in values],
                *[F.covar_pop(v, values[j]).alias(f"c_{i}_{j}") for i, v in enumerate(values) for j in range(i + 1)],
            ),
            values,
            floor,
        )
        if not step:
            found = better.withColumn("log_det", F.lit(float("inf"))).drop("_before")
            continue
        falls = F.col("log_det") < F.col("_before") - SETTLED
        settled.append(better.filter(~falls).drop("_before"))
        found = better.filter(falls).drop("_before")
        if found.isEmpty():
            break
    ends = reduce(DataFrame.unionByName, settled, found)
    best = F.min_by(F.struct(*[c for c in ends.columns if c not in key]), F.struct("log_det", "_start")).alias("_best")
    found = stored(ends.groupBy(group).agg(best).select(group, "_best.*"), "best")
    typical = _with_estimates(rows, found, group).groupBy(group).agg(
        F.percentile_approx(_squared_distance(values), 0.5, F.lit(1000)).alias("_median"), F.count(F.lit(1)).alias("n_fitted")
    )
    # The core is narrower than the whole; a scale below one would only sharpen a floor.
    return stored(found.join(typical, group).withColumn("scale", F.greatest(F.lit(1.0), F.col("_median") / CHI2_MEDIAN)).drop("_median"), "robust")


def _mixed(above: DataFrame, own: DataFrame, values: list[str]) -> DataFrame:
    """Estimates ``above`` (m_v and c_i_j by ``_key``), each mixed with the ``own`` one of its key, if there is one."""
    names = [c for c in above.columns if c.startswith(("m_", "c_"))]
    both = above.select(*[F.col(c).alias(f"up_{c}" if c in names else c) for c in above.columns]).join(own, "_key", "left")
    weight = F.coalesce(F.col("n_fitted") / (F.col("n_fitted") + STRENGTH), F.lit(0.0))
    mix = lambda c: weight * F.col(c) + (1 - weight) * F.col(f"up_{c}")
    apart = lambda k: F.col(f"m_{values[k]}") - F.col(f"up_m_{values[k]}")
    mixed = {c: mix(c) for c in names if c.startswith("m_")}
    for i in range(len(values)):
        for j in range(i + 1):
            mixed[f"c_{i}_{j}"] = mix(f"c_{i}_{j}") + weight * (1 - weight) * apart(i) * apart(j)
    kept = [c for c in above.columns if c not in names]
    return stored(both.select(*kept, *[F.coalesce(e, f"up_{c}").alias(c) for c, e in mixed.items()]), "mixed")


def judge(stats: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """All rows of ``statistics`` with ``distance`` (squared, scaled) and ``kept``."""
    names = list(VECTOR)
    group = F.concat(F.lit("group "), F.to_json(F.struct("lang", "source"))).alias("_group")
    lang = F.concat(F.lit("language "), F.to_json(F.struct("lang"))).alias("_lang")
    rows = stored(_dealt(stats.select("*", group, lang, *[F.expr(v).alias(k) for k, v in VECTOR.items()])), "vectors")
    # Every row counts in its group, its language and the whole.
    levels = F.explode(F.array("_group", "_lang", F.lit("whole"))).alias("_group")
    fit = stored(rows.filter(~F.col("base_failed")).select(levels, "_part", *names), "levels")
    found = robust_scatter(fit, "_group", FLOOR)
    entry = lambda i, j: F.col("scale") * sum((F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}") for k in range(1, j + 1)), F.col(f"l_{i}_0") * F.col(f"l_{j}_0"))
    entries = [entry(i, j).alias(f"c_{i}_{j}") for i in range(len(names)) for j in range(i + 1)]
    own = stored(found.select(F.col("_group").alias("_key"), "n_fitted", *[f"m_{v}" for v in names], *entries), "moments")
    groups = stored(rows.select("_group", "_lang").distinct(), "groups")
    whole = own.filter("_key = 'whole'").drop("n_fitted").withColumnRenamed("_key", "_whole")
    languages = groups.select(F.col("_lang").alias("_key"), F.lit("whole").alias("_whole")).distinct().join(whole, "_whole", "left").drop("_whole")
    above = _mixed(languages, own, names).withColumnRenamed("_key", "_lang")
    mixed = _mixed(groups.withColumnRenamed("_group", "_key").join(above, "_lang", "left").drop("_lang"), own, names)
    estimates = _factored(mixed.withColumnRenamed("_key", "_group"), names, FLOOR, raised=True)
    judged = _with_estimates(rows, estimates, "_group").withColumn("distance", _squared_distance(names))
    kept = ~F.col("base_failed") & F.coalesce(F.col("distance") <= cutoff, F.lit(False))
    return judged.select(*stats.columns, "distance", kept.alias("kept"))
