"""Quality rules with robust multivariate outliers (operator 4). DataFrame functions only.

Base rules reject a text of under 20 words, or one in which more than 30 % of the
words lie in repeated 8-word windows. Of the rest, each (lang, source) group gets a
minimum-covariance-determinant estimate of its transformed statistics. It is sought from
three starts: medians with median deviations, mean and covariance, and medians with the covariance
of the directions from them (spatial signs). Each concentration step takes the 75 % of the group nearest to the
current centre and computes mean and covariance from them anew; a start is done when a step no
longer lowers its determinant. Of a group's starts that with the least determinant stays. Its
covariance times CONSISTENT[0] (what the nearest 75 % of a normal distribution fall short of) weighs the
texts once more: mean and covariance of those within REWEIGHT, times CONSISTENT[1], judge all.
Texts whose squared Mahalanobis distance passes CUTOFF are rejected.

The statistic vector: log of the mean word length, and square roots of symbols
per word, duplicate lines per line with a word, and repeated words per word.
All are counts over a length, so that each text's own vector is uncertain by about 1 / (4 length)
in variance, a count of one (repeated words come eight at a time: 2 / length). The mean of it over the group is
added to each covariance: a group in which nearly all texts have no symbol at all has
no spread of its own there, and still does not reject every text with one.

Defined cases
  * null and empty texts have no words and fail the base rules.
  * null lang or source is a value of its own.
  * groups of under ``min_group`` texts are pooled by language, and pooled languages of
    under ``min_group`` in one rest group; a rest group of under ``min_pool`` rejects nothing,
    as four means and ten covariances of so few texts say little.
  * repeated rows are judged as rows of their own; an empty table gives an empty result;
    further columns are ignored, or kept with ``keep``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeshelf.llm.common import SPACES, read, stored, words
from lakeshelf.operators.joins import fits, maybe_broadcast

MIN_WORDS, REPEAT_PERCENT, WINDOW = 20, 30, 8
SYMBOLS = "#*$%&|<>"
P = 4
STARTS = 3
# Steps go on until no determinant falls; the bound ends a group whose ties make it swing.
SHARE, MAX_STEPS = 0.75, 30
# Chi-squared with 4 degrees of freedom: the 0.999995 and 0.975 quantiles, and what the covariance of the nearest 75 % and 97.5 % is multiplied by.
CUTOFF, REWEIGHT = 30.0, 11.143
CONSISTENT = (1.486, 1.0645)
MIN_GROUP, MIN_POOL = 200, 40
# The estimates (one row per group) are broadcast up to so many rows, else joined by shuffle.
MAX_BROADCAST_GROUPS = 100_000


def _total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0).cast("long"), lambda s, x: s + x)


def statistics(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns and n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines (long)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    d = docs.select(*keep, words(text).alias("_w"), lines.alias("_l"), text.alias("_t"))
    d = d.select(*keep, F.transform("_w", lambda w: F.xxhash64(w)).alias("_h"), F.size("_l").cast("long").alias("n_lines"),
                 (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
                 _total(F.transform("_w", lambda w: F.length(w).cast("long"))).alias("word_chars"),
                 (F.length("_t") - F.length(F.regexp_replace("_t", f"[{SYMBOLS}]", ""))).cast("long").alias("n_symbols"))
    rolled = F.transform(F.sequence(F.lit(1), F.size("_h") - (WINDOW - 1)), lambda i: F.xxhash64(F.slice("_h", i, WINDOW)))
    d = d.withColumn("n_words", F.size("_h").cast("long")).withColumn("_r", F.when(F.size("_h") > WINDOW, rolled)).drop("_h")
    # Only texts with some repeated window are looked at closer: windows sorted by hash, equal neighbours, their positions.
    again = F.size(F.array_distinct("_r")) < F.size("_r")
    d = d.withColumn("_s", F.when(again, F.array_sort(F.transform("_r", lambda x, i: F.struct(x.alias("x"), i.alias("i")))))).drop("_r")
    twice = F.filter("_s", lambda e, j: (F.get("_s", j - 1)["x"].eqNullSafe(e["x"])) | (F.get("_s", j + 1)["x"].eqNullSafe(e["x"])))
    d = d.withColumn("_p", F.array_sort(F.transform(twice, lambda e: e["i"]))).drop("_s")
    covered = F.transform("_p", lambda x, j: F.least(F.lit(WINDOW), F.coalesce(F.get("_p", j + 1) - x, F.lit(WINDOW))).cast("long"))
    return d.withColumn("n_repeat_words", F.coalesce(_total(covered), F.lit(0).cast("long"))).drop("_p")


def _vector() -> list[Column]:
    n = F.greatest(F.col("n_words"), F.lit(1))
    return [F.log(F.greatest(F.col("word_chars"), F.lit(1)) / n), F.sqrt(F.col("n_symbols") / n),
            F.sqrt(F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))), F.sqrt(F.col("n_repeat_words") / n)]


def _noise() -> list[Column]:
    """Variances of the vector's coordinates that a text's own length leaves."""
    n = F.greatest(F.col("n_words"), F.lit(1))
    return [0.25 / n, 0.25 / n, 0.25 / F.greatest(F.col("n_lines"), F.lit(1)), 2.0 / n]


def _grouped(stats: DataFrame, min_group: int) -> DataFrame:
    """Adds _g, the group whose estimate judges the row (null for base failures)."""
    sizes = stats.filter(~F.col("base_failed")).groupBy("lang", "source").count()
    sizes = sizes.withColumn("_own", F.col("count") >= min_group)
    pooled = F.sum(F.when(~F.col("_own"), F.col("count")).otherwise(0)).over(Window.partitionBy("lang"))
    key = F.to_json(F.struct(F.coalesce("lang", F.lit("\0")).alias("l"), F.coalesce("source", F.lit("\0")).alias("s")))
    by_lang = F.to_json(F.struct(F.coalesce("lang", F.lit("\0")).alias("l")))
    sizes = sizes.withColumn("_g", F.when(F.col("_own"), key).when(pooled >= min_group, by_lang).otherwise("rest"))
    sizes = stored(sizes.select(F.col("lang").alias("_l"), F.col("source").alias("_s"), "_g"), "groups")
    on = F.col("lang").eqNullSafe(F.col("_l")) & F.col("source").eqNullSafe(F.col("_s")) & ~F.col("base_failed")
    return stats.join(maybe_broadcast(sizes, fits(sizes, MAX_BROADCAST_GROUPS)), on, "left").drop("_l", "_s")


def _factored(est: DataFrame, factor: float = 1.0) -> DataFrame:
    """Rows of _g, m0.., c00.. (covariances), r0.. (noise) to _k, _det (log of the determinant), m0.., l00.. (factor of covariance times ``factor`` plus noise)."""
    cov = [[F.col(f"c{max(i, j)}{min(i, j)}") * factor + (F.col(f"r{i}") if i == j else 0.0) for j in range(P)] for i in range(P)]
    kept = [*[f"m{i}" for i in range(P)], *[f"r{i}" for i in range(P)]]
    est = est.select("_g", *kept, *[cov[i][j].alias(f"l{i}{j}") for i in range(P) for j in range(i + 1)])
    for i in range(P):  # column by column, so that no expression is written out again and again
        for j in range(i + 1):
            rest = reduce(lambda a, k: a - F.col(f"l{i}{k}") * F.col(f"l{j}{k}"), range(j), F.col(f"l{i}{j}"))
            est = est.withColumn(f"l{i}{j}", F.sqrt(F.greatest(rest, F.lit(1e-12))) if i == j else rest / F.col(f"l{j}{j}"))
    det = reduce(lambda a, b: a + b, [F.log(f"l{i}{i}") for i in range(P)])
    return stored(est.withColumn("_det", det).withColumnRenamed("_g", "_k"), "estimate")


def _small(df: DataFrame) -> DataFrame:
    return maybe_broadcast(df, fits(df, MAX_BROADCAST_GROUPS))


def _distances(rows: DataFrame, est: DataFrame) -> DataFrame:
    """Adds _d2, the squared Mahalanobis distance by the row's group (null without one)."""
    j = rows.join(_small(est), F.col("_g") == F.col("_k"), "left")
    for i in range(P):
        rest = reduce(lambda a, k: a - F.col(f"l{i}{k}") * F.col(f"_y{k}"), range(i), F.col(f"x{i}") - F.col(f"m{i}"))
        j = j.withColumn(f"_y{i}", rest / F.col(f"l{i}{i}"))
    d2 = reduce(lambda a, b: a + b, [F.col(f"_y{i}") * F.col(f"_y{i}") for i in range(P)])
    return j.select(*rows.columns, d2.alias("_d2"))


def _moments(x: str = "x") -> list[Column]:
    return [F.avg(f"{x}{i}").alias(f"m{i}") for i in range(P)] + [
        F.covar_pop(f"{x}{i}", f"{x}{j}").alias(f"c{i}{j}") for i in range(P) for j in range(i + 1)]


def _named(values: dict) -> list[Column]:
    return [c.alias(a) for a, c in values.items()]


def _starts(base: DataFrame) -> DataFrame:
    """_g, _s (start), means, covariances and noise of each group's starts."""
    half = lambda c: F.percentile_approx(c, 0.5, 10000)  # noqa: E731  a sketch of bounded size
    noise = [F.avg(f"v{i}").alias(f"r{i}") for i in range(P)]
    centre = base.groupBy("_g").agg(*noise, *[half(F.col(f"x{i}")).alias(f"h{i}") for i in range(P)], *_moments())
    centre = stored(centre.withColumnRenamed("_g", "_k"), "centres")
    off = base.join(_small(centre), F.col("_g") == F.col("_k"))
    norm = F.sqrt(reduce(lambda a, b: a + b, [F.pow(F.col(f"x{i}") - F.col(f"h{i}"), 2) / F.col(f"r{i}") for i in range(P)]))
    off = off.withColumn("_far", F.greatest(norm, F.lit(1e-9)))
    off = off.select("*", *[((F.col(f"x{i}") - F.col(f"h{i}")) / F.col("_far")).alias(f"z{i}") for i in range(P)])
    around = lambda i, j: F.avg(F.col(f"z{i}") * F.col(f"z{j}")).alias(f"z{i}{j}")
    more = off.groupBy("_g").agg(half(F.pow("_far", 2)).alias("_wide"), *[half(F.abs(F.col(f"x{i}") - F.col(f"h{i}"))).alias(f"s{i}") for i in range(P)],
                                 *[around(i, j) for i in range(P) for j in range(i + 1)])
    both = stored(more, "spreads").join(_small(centre), F.col("_g") == F.col("_k"))
    pairs = [(i, j) for i in range(P) for j in range(i + 1)]
    medians = {f"m{i}": F.col(f"h{i}") for i in range(P)}
    noise = {f"r{i}": F.col(f"r{i}") for i in range(P)}
    starts = [
        {**medians, **{f"c{i}{j}": F.pow(F.col(f"s{i}") * 1.4826, 2) if i == j else F.lit(0.0) for i, j in pairs}, **noise},
        {**{f"m{i}": F.col(f"m{i}") for i in range(P)}, **{f"c{i}{j}": F.col(f"c{i}{j}") for i, j in pairs}, **noise},
        {**medians, **{f"c{i}{j}": F.col(f"z{i}{j}") * F.col("_wide") for i, j in pairs}, **noise},
    ]
    each = F.array(*[F.struct(F.lit(k).alias("_s"), *_named(values)) for k, values in enumerate(starts)])
    return both.select("_g", F.explode(each).alias("e")).select("_g", "e.*")


def _concentrated(far: DataFrame, est: DataFrame) -> DataFrame:
    """The estimates from the nearest SHARE of the rows, by the distances in ``far``."""
    reach = stored(far.groupBy("_g").agg(F.percentile_approx("_d2", SHARE, 10000).alias("_q")).withColumnRenamed("_g", "_k"), "reach")
    near = far.join(_small(reach), F.col("_g") == F.col("_k")).filter("_d2 <= _q")
    return _with_noise(near, est)


def _with_noise(near: DataFrame, est: DataFrame) -> DataFrame:
    noise = est.select("_k", *[f"r{i}" for i in range(P)])
    return near.groupBy("_g").agg(*_moments()).join(_small(noise), F.col("_g") == F.col("_k")).drop("_k")


def _least_determinant(base: DataFrame) -> DataFrame:
    """The factored estimate of each group with the least determinant over all starts, and its number of texts in _n."""
    begin = _starts(base).withColumn("_g", F.struct(F.col("_g").alias("g"), F.col("_s").alias("s"))).drop("_s")
    keys = F.explode(F.array(*[F.struct(F.col("_g").alias("g"), F.lit(k).alias("s")) for k in range(STARTS)]))
    each = base.select(keys.alias("_g"), *[f"x{i}" for i in range(P)])
    open_ = _factored(begin)
    # What a start says of itself is no subset's determinant: the first step's is the first to count.
    open_ = _factored(_concentrated(_distances(each, open_), open_))
    done = []
    for _ in range(MAX_STEPS):
        rows = each.join(_small(open_.select("_k")), F.col("_g") == F.col("_k"), "left_semi")
        new = _factored(_concentrated(_distances(rows, open_), open_))
        old = open_.select("_k", F.col("_det").alias("_old"))
        both = stored(new.join(_small(old), "_k").withColumn("_fell", F.col("_det") < F.col("_old") - 1e-9), "step")
        done.append(open_.join(_small(both.filter("not _fell").select("_k")), "_k", "left_semi"))
        open_ = both.filter("_fell").drop("_old", "_fell")
        if open_.isEmpty():
            break
    found = reduce(DataFrame.unionByName, [*done, open_])
    names = [c for c in found.columns if c not in ("_k", "_det")]
    best = found.groupBy(F.col("_k.g").alias("_k")).agg(F.min(F.struct("_det", F.col("_k.s").alias("_s"), *names)).alias("e"))
    return stored(best.select("_k", "e._det", *[f"e.{c}" for c in names]), "least")


def _consistent(est: DataFrame, factor: float) -> DataFrame:
    """The estimate with its covariance, but not its noise, multiplied: from the factor back to covariances and on."""
    product = lambda i, j: reduce(lambda a, b: a + b, [F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j + 1)])
    back = [(product(i, j) - (F.col(f"r{i}") if i == j else 0.0)).alias(f"c{i}{j}") for i in range(P) for j in range(i + 1)]
    return _factored(est.select(F.col("_k").alias("_g"), *[f"m{i}" for i in range(P)], *[f"r{i}" for i in range(P)], *back), factor)


def judged(docs: DataFrame, keep: list[str] | None = None, min_group: int = MIN_GROUP, min_pool: int = MIN_POOL) -> DataFrame:
    """``keep`` columns (default doc_id) with the statistics, base_failed, kept."""
    keep = ["doc_id"] if keep is None else keep
    own = {c: f"_in_{i}" for i, c in enumerate(keep)}  # input columns may have the names used here
    need = docs.select(*[docs[c].alias(a) for c, a in own.items()], docs["text"], docs["lang"], docs["source"])
    s = statistics(need, [*own.values(), "lang", "source"])
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    s = s.withColumn("base_failed", failed)
    s = stored(s.select("*", *[x.alias(f"x{i}") for i, x in enumerate(_vector())], *[x.alias(f"v{i}") for i, x in enumerate(_noise())]), "statistics")
    rows = _grouped(s, min_group)
    vectors = [f"x{i}" for i in range(P)]
    base = stored(rows.filter("_g is not null").select("_g", *vectors, *[f"v{i}" for i in range(P)]), "vectors")

    raw = _consistent(_least_determinant(base), CONSISTENT[0])
    near = _distances(base.select("_g", *vectors), raw).filter(F.col("_d2") <= REWEIGHT)
    est = _factored(_with_noise(near, raw), CONSISTENT[1])
    many = stored(base.groupBy(F.col("_g").alias("_many")).agg(F.count("*").alias("_n")).filter(F.col("_n") >= min_pool), "sizes")
    out = _distances(rows, est).join(_small(many), F.col("_g") == F.col("_many"), "left")
    outlier = F.col("_n").isNotNull() & (F.col("_d2") > CUTOFF)
    return out.select(*[F.col(a).alias(c) for c, a in own.items()], *[F.col(c).alias(c) for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed") if c not in own],
        (~F.col("base_failed") & ~F.coalesce(outlier, F.lit(False))).alias("_kept" if "kept" in own else "kept"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(read(spark, sf_dir, "documents"))
