"""Line dedup with a log-template tree (operator 10). DataFrame functions only.

Lines (split at \\n) with a word get templates:
  * the line with each word that holds a digit replaced by ``<*>``;
  * from LEAF_TOKENS words on, those of its leaf in a tree of fixed depth (word count, then the first DEPTH
    masked words). A leaf may hold lines of several kinds and prose between them, so there is one template a level: a
    position keeps the line's own word if at least the level's share of the leaf's lines (and MIN_DOCS of them) have it
    there, and becomes ``<*>`` otherwise. Lines of one kind so agree at some level, be they a half or a hundredth of their leaf, and
    at the last level however few they are. A template counts if at least SIMILAR of the line's words are kept.
A template that occurs in MIN_DOCS documents or more recurs (in SHORT_DOCS, for lines of under SHORT words, which prose repeats by
chance); its lines are dropped from all documents but the one with the smallest doc_id.

A document is a copy if another one, the first of the lines' templates, holds the very lines
that have 90 % of its words. Copies stay whole for the near-duplicate stage, unless
``spare_copies`` is off, as in the query and its SQL: then all documents lose their recurring lines, however many.

Defined cases
  * null text: no lines, and the text stays null; a line without words is a line, and is kept.
  * documents with a null doc_id are not counted and lose nothing.
  * rows that share a doc_id are one document for counting, and each loses its own lines.
  * an empty table gives an empty result; further columns are kept, whatever their names.

Counts are partially aggregated before each shuffle, and a table joined by template is a
written one, so that Spark broadcasts it when small; else it is joined by shuffle, in which
adaptive execution splits a template of very many lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshelf.llm.common import SPACE_CLASS, fresh, read, release, stored, written
from lakeshelf.operators.joins import maybe_broadcast

SHORT, DEPTH, LEAF_TOKENS = 4, 3, 4
MIN_DOCS, SHORT_DOCS, SIMILAR, COPY_PERCENT = 3, 6, 0.7, 90
LEVELS = (0.5, 0.1, 0.01, 0.0)
ANY = "<*>"
# Line numbers of documents are broadcast up to so many (40 bytes each at most), else joined by shuffle.
MAX_BROADCAST_LINES = 1_000_000


def _masked_words(line: Column) -> Column:
    """Words of a line, those with a digit as ``<*>``; lines without digits and odd spaces are split the cheap way."""
    masked = F.regexp_replace(line, r"[^\x20\x09-\x0D]*[0-9][^\x20\x09-\x0D]*", ANY)
    return F.array_remove(F.when(line.rlike(r"[0-9\t\x0B-\r]"), F.split(masked, SPACE_CLASS + "+")).otherwise(F.split(line, " ")), "")


def _exact(w: Column) -> Column:
    return F.xxhash64(F.lit("line"), w)


def _lines(docs: DataFrame) -> DataFrame:
    """d, k (number of the line), raw (hash of the line), words, exact (the line's own template), leaf, of each line that can have a template."""
    rows = docs.filter("doc_id is not null").select(F.col("doc_id").alias("d"), F.posexplode_outer(F.split("text", "\n")).alias("k", "line"))
    rows = rows.select("d", "k", F.xxhash64("line").alias("raw"), _masked_words(F.col("line")).alias("w"))
    leaf = F.when(F.size("w") >= LEAF_TOKENS, F.xxhash64(F.size("w"), F.slice("w", 1, DEPTH)))
    rows = rows.select("d", "k", "raw", F.size("w").alias("words"), _exact(F.col("w")).alias("exact"), leaf.alias("leaf"))
    return rows.filter("words > 0")


def _leaf_templates(docs: DataFrame, lines: DataFrame, min_docs: int) -> DataFrame:
    """exact, template: the template of its leaf, for each distinct line that is similar to it."""
    kinds = lines.filter("leaf is not null").groupBy("exact").agg(
        F.first("leaf").alias("leaf"), F.count("*").alias("c"), F.min("d").alias("a"), F.max("d").alias("b"), F.min(F.struct("d", "k")).alias("at"))
    kinds = stored(kinds, "kinds")
    # Leaves in which no template can recur, or no line differs from another, are left out before words are compared.
    leaves = kinds.groupBy(F.col("leaf").alias("g")).agg(F.sum("c").alias("n"), F.count("*").alias("differ"), F.min("a").alias("a"), F.max("b").alias("b"))
    leaves = stored(leaves.filter((F.col("n") >= min_docs) & (F.col("differ") > 1) & (F.col("a") != F.col("b"))).select("g", "n"), "leaves")
    open_ = kinds.join(leaves, F.col("leaf") == F.col("g")).select("exact", "g", "n", "c", "at")
    # Each distinct line is read once more, from the first document that has it.
    wanted = open_.groupBy(F.col("at.d").alias("wd")).agg(F.collect_list(F.struct("at.k", "exact", "g", "n", "c")).alias("want"))
    wanted = stored(wanted, "wanted-lines")
    small = (wanted.agg(F.sum(F.size("want"))).first()[0] or 0) <= MAX_BROADCAST_LINES
    found = docs.select("doc_id", "text").join(maybe_broadcast(wanted, small), F.col("doc_id") == F.col("wd"))
    found = found.select(F.split("text", "\n").alias("all"), F.explode_outer("want").alias("x"))
    found = found.select(_masked_words(F.get("all", F.col("x.k"))).alias("w"), "x.exact", "x.g", "x.n", "x.c")
    # Rows that share a doc_id may have other lines at this place.
    found = stored(found.filter(_exact(F.col("w")) == F.col("exact")).dropDuplicates(["exact"]), "leaf-lines")
    at = found.select("exact", "g", "n", "c", F.posexplode_outer("w").alias("p", "t")).filter(F.col("p") >= DEPTH)
    often = at.groupBy("g", "p", "t").agg(F.sum("c").alias("lines")).filter(F.col("lines") >= min_docs)
    often = stored(often.toDF("g_", "p_", "t_", "lines"), "leaf-words")
    own = at.join(often, (F.col("g") == F.col("g_")) & (F.col("p") == F.col("p_")) & (F.col("t") == F.col("t_")))
    # A line's words that come often, with their share of the leaf's lines.
    own = own.groupBy("exact").agg(F.map_from_entries(F.collect_list(F.struct("p", (F.col("lines") / F.col("n")).alias("share")))).alias("shares"))
    own = stored(own.withColumnRenamed("exact", "x"), "leaf-shares")
    general = found.join(own, F.col("exact") == F.col("x"), "left")
    general = general.select("exact", "w", F.transform("w", lambda t, i: F.when(i < DEPTH, 1.0).otherwise(F.coalesce(F.element_at("shares", i), F.lit(-1.0)))).alias("shares"))
    general = general.select("exact", "w", "shares", F.explode_outer(F.array(*[F.lit(x) for x in LEVELS])).alias("level"))
    kept = F.size(F.filter("shares", lambda x: x >= F.col("level")))
    masked = F.zip_with("w", "shares", lambda t, x: F.when(x >= F.col("level"), t).otherwise(ANY))
    general = general.filter((kept >= SIMILAR * F.size("w")) & (kept < F.size("w"))).select(F.col("exact").alias("e"), F.xxhash64(F.lit("leaf"), masked).alias("template"))
    return stored(general.distinct(), "leaf-templates")


def recurring_lines(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """doc_id, line (number from 0), words: the lines whose template recurs, but for those of its first document;
    held_by: this first document, where the least of its lines by hash with the template is equal to the line."""
    lines = stored(_lines(docs), "lines")
    general = _leaf_templates(docs, lines, min_docs)
    every = lines.select("d", "k", "raw", "words", F.col("exact").alias("template")).unionByName(
        lines.join(general, F.col("exact") == F.col("e")).select("d", "k", "raw", "words", "template"))
    every = stored(every, "templates")
    found = (every.groupBy("template", "d").agg(F.min("raw").alias("raw"), F.min("words").alias("words")).groupBy("template").agg(
        F.count("*").alias("docs"), F.min("words").alias("words"), F.min(F.struct("d", "raw")).alias("first"))
             .filter(F.col("docs") >= F.when(F.col("words") < SHORT, F.greatest(F.lit(SHORT_DOCS), F.lit(min_docs))).otherwise(min_docs)).select(F.col("template").alias("t"), F.col("first.d").alias("first"), F.col("first.raw").alias("first_raw")))
    again = every.join(stored(found, "recurring"), F.col("template") == F.col("t")).filter("d > first")
    held = F.min(F.when(F.col("raw") == F.col("first_raw"), F.col("first")))
    return again.groupBy("d", "k").agg(F.first("words").alias("words"), held.alias("held_by")).select(
        F.col("d").alias("doc_id"), F.col("k").alias("line"), "words", "held_by")


def without_recurring(docs: DataFrame, min_docs: int = MIN_DOCS, spare_copies: bool = True) -> DataFrame:
    """``docs`` with its columns, the lines dropped from ``text``, and two more at the end: how many lines it had and lost (long;
    _n_lines and _n_removed, with underscores more if ``docs`` has these names)."""
    before = written()
    drops = recurring_lines(docs, min_docs).groupBy("doc_id", "held_by").agg(F.collect_list("line").alias("drop"), F.sum("words").alias("words"))
    drops = drops.groupBy("doc_id").agg(F.array_sort(F.flatten(F.collect_list("drop"))).alias("drop"),
                                        F.max(F.when(F.col("held_by").isNotNull(), F.col("words")).otherwise(0)).alias("held"))
    drops = stored(drops.select(F.col("doc_id").alias("d"), "drop", "held"), "drops")
    release(docs.sparkSession, before, drops)
    small = (drops.agg(F.sum(F.size("drop"))).first()[0] or 0) <= MAX_BROADCAST_LINES
    # All columns of ``docs`` travel in one struct, so that their names meet none of those used here.
    out = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"), docs["doc_id"].alias("id"), docs["text"].alias("text"))
    out = out.join(maybe_broadcast(drops, small), F.col("id") == F.col("d"), "left")
    n_words = F.size(F.array_remove(F.split("text", SPACE_CLASS + "+"), ""))
    copy = 100 * F.col("held") >= COPY_PERCENT * n_words
    use = F.col("drop").isNotNull() & (~copy if spare_copies else F.lit(True))
    out = out.withColumn("drop", F.when(use, F.col("drop"))).withColumn("all", F.split("text", "\n"))
    # The kept lines between two dropped ones are a slice each.
    n = F.size("drop")
    end = lambda i: F.coalesce(F.get("drop", i), F.size("all"))
    start = lambda i: F.coalesce(F.get("drop", i - 1), F.lit(-1))
    runs = F.transform(F.sequence(F.lit(0), n), lambda i: F.when(end(i) > start(i) + 1, F.slice("all", start(i) + 2, end(i) - start(i) - 1)))
    text = F.when(F.col("drop").isNull(), F.col("text")).otherwise(F.array_join(F.flatten(F.array_compact(runs)), "\n"))
    return out.select(*[text.alias(c) if c == "text" else F.col("doc").getField(c).alias(c) for c in docs.columns],
                      F.coalesce(F.size("all"), F.lit(0)).cast("long").alias(fresh(docs.columns, "_n_lines")),
                      F.coalesce(n, F.lit(0)).cast("long").alias(fresh(docs.columns, "_n_removed")))


def op10_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_lines, n_removed, kept_sha256 (of the remaining text) for all documents."""
    out = without_recurring(read(spark, sf_dir, "documents").select("doc_id", "text"), spare_copies=False)
    return out.select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_removed").alias("n_removed"),
                      F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


OP10_SQL = r"""
WITH l AS (SELECT rowid AS r, doc_id AS d, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS k
           FROM (SELECT row_number() OVER () AS rowid, * FROM documents) WHERE text IS NOT NULL),
m AS (SELECT r, d, k, line, list_filter(regexp_split_to_array(CASE WHEN regexp_matches(line, '[0-9]')
        THEN regexp_replace(line, '[^\x20\x09-\x0D]*[0-9][^\x20\x09-\x0D]*', '<*>', 'g') ELSE line END, '[ \t-\r]+'), lambda x: x <> '') AS w FROM l),
t AS (SELECT *, CASE WHEN len(w) >= 4 THEN list_concat([CAST(len(w) AS VARCHAR)], w[1:3]) END AS leaf FROM m WHERE len(w) >= 1 AND d IS NOT NULL),
leaves AS (SELECT leaf, count(*) AS n FROM t WHERE leaf IS NOT NULL GROUP BY leaf HAVING count(*) >= 3 AND min(d) <> max(d)),
kinds AS (SELECT DISTINCT leaf, n, w FROM t JOIN leaves USING (leaf)),
pos AS (SELECT leaf, x, p, count(*) AS c FROM (SELECT leaf, unnest(w) AS x, unnest(range(len(w))) AS p FROM t JOIN leaves USING (leaf)) WHERE p >= 3 GROUP BY ALL HAVING count(*) >= 3),
word AS (SELECT leaf, n, w, unnest(w) AS x, unnest(range(len(w))) AS p FROM kinds),
share AS (SELECT w, list(CASE WHEN p < 3 THEN 1.0 ELSE coalesce(CAST(c AS DOUBLE) / n, -1.0) END ORDER BY p) AS s FROM word LEFT JOIN pos USING (leaf, x, p) GROUP BY w),
levels AS (SELECT w, s, unnest([0.5, 0.1, 0.01, 0.0]) AS lv FROM share),
g AS (SELECT DISTINCT w, list_concat(['leaf'], [CASE WHEN s[i + 1] >= lv THEN w[i + 1] ELSE '<*>' END FOR i IN range(len(w))]) AS tpl FROM levels
      WHERE len(list_filter(s, lambda z: z >= lv)) >= 0.7 * len(w) AND len(list_filter(s, lambda z: z >= lv)) < len(w)),
every AS (SELECT r, d, k, list_concat(['line'], w) AS tpl, len(w) AS words FROM t UNION ALL SELECT r, d, k, tpl, len(w) AS words FROM t JOIN g USING (w)),
rec AS (SELECT tpl, min(d) AS first FROM every GROUP BY tpl HAVING count(DISTINCT d) >= CASE WHEN min(words) < 4 THEN 6 ELSE 3 END),
drops AS (SELECT DISTINCT d, k FROM every JOIN rec USING (tpl) WHERE d > first),
per AS (SELECT d, list(k) AS ks FROM drops GROUP BY d),
judged AS (SELECT documents.doc_id, text, coalesce(ks, []) AS ks FROM documents LEFT JOIN per ON doc_id = d)
SELECT doc_id, CAST(coalesce(len(string_split(text, chr(10))), 0) AS BIGINT) AS n_lines, CAST(len(ks) AS BIGINT) AS n_removed,
  sha256(coalesce(array_to_string([string_split(text, chr(10))[i + 1] FOR i IN range(len(string_split(text, chr(10)))) IF NOT list_contains(ks, i)], chr(10)), '')) AS kept_sha256
FROM judged
"""
