"""Chat formatting from reply trees (operator 8). DataFrame functions only.

Messages form trees (``msg_id`` -> ``parent_id`` within a conversation).
Iterative self-joins by pointer doubling find each message's depth and the
score sum of its path to the root in log2(depth) joins; leaves are ranked by the
mean score of their path, and each chosen root-to-leaf path is formatted as one
conversation.

Defined cases
  * null text or role: the empty string; null conv_id: a conversation of its own.
  * a parent that does not exist: the message is a root.
  * messages on a reply cycle have no root and are on no path.
  * repeated rows of a turn-ordered table are turns of their own, ordered by
    (turn, role, text), nulls first; ties between leaves go to the longer path,
    then to the smaller message id.
  * an empty table gives an empty result; further columns are ignored.

Template: each turn is ``<|im_start|>role\\ntext<|im_end|>\\n``. A control string
inside a text gets one backslash after its first character (``</s>`` becomes
``<\\/s>``; one that has backslashes there already gets one more), so the
escape is reversible and no text can open or close a turn.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeshelf.llm.common import read, release, stored, written

START, END = "<|im_start|>", "<|im_end|>\n"
# Control strings of common chat templates.
CONTROL = ["<|im_start|>", "<|im_end|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]
_TAILS = "|".join(re.escape(c[1:]) for c in CONTROL)
ESCAPE = rf"([<\[])(\\*)({_TAILS})"
UNESCAPE = rf"([<\[])\\(\\*)({_TAILS})"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPE, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, UNESCAPE, "$1$2$3")


def _escape_role(role: Column) -> Column:
    one_line = F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A"))
    return escape(one_line)


def _unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def as_tree(turns: DataFrame) -> DataFrame:
    """Turn-ordered rows (conv_id, turn, role, text) as messages, each replying to the one before."""
    order = Window.partitionBy("conv_id").orderBy(*[F.col(c).asc_nulls_first() for c in ("turn", "role", "text")])
    n = F.row_number().over(order).cast("long")
    return turns.select("conv_id", n.alias("msg_id"), F.when(n > 1, n - 1).alias("parent_id"),
                        F.lit(0.0).alias("score"), "role", "text")


def reply_paths(messages: DataFrame, paths_per_conversation: int = 1) -> DataFrame:
    """Root-to-leaf paths of the best branches: conv_id, path (leaf id), msg_id, depth, path_score.

    ``messages``: conv_id, msg_id, parent_id, score. Pointer doubling: after round k
    each message points 2^k replies up; the tables of all rounds then
    expand the chosen leaves into their paths, doubling the covered distance with
    each join. Keys are (conv_id, msg_id), which are unique, so no join is skewed.
    """
    m = messages.select("conv_id", "msg_id", "parent_id", F.coalesce("score", F.lit(0.0)).alias("score"))
    ids = m.select(F.col("conv_id").alias("c"), F.col("msg_id").alias("i")).distinct()
    known = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("parent_id") == F.col("i"))
    at = stored(m.join(ids, known, "left").select(
        "conv_id", "msg_id", F.col("i").alias("anc"), F.col("i").isNotNull().cast("long").alias("depth"), "score"), "reply-0")
    rooted, climbing, jumps, covered = at.filter("anc is null"), at.filter("anc is not null"), [], 0
    while (left := climbing.count()) > 0 and 2 ** len(jumps) <= 2 * max(covered, left):  # no path is longer than all messages; cycles end here
        covered = max(covered, left)
        jumps.append(climbing.select(F.col("conv_id").alias("c"), F.col("msg_id").alias("i"), F.col("anc").alias("up")))
        b = rooted.unionByName(climbing).select(F.col("conv_id").alias("c"), F.col("msg_id").alias("i"), F.col("anc").alias("b_anc"),
                                               F.col("depth").alias("b_depth"), F.col("score").alias("b_score"))
        on = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("anc") == F.col("i"))
        at = stored(climbing.join(b, on).select(
            "conv_id", "msg_id", F.col("b_anc").alias("anc"), (F.col("depth") + F.col("b_depth")).alias("depth"),
            (F.col("score") + F.col("b_score")).alias("score")), f"reply-{len(jumps)}")
        rooted, climbing = rooted.unionByName(at.filter("anc is null")), at.filter("anc is not null")
    rooted = rooted.select("conv_id", "msg_id", "depth", "score")

    parents = m.select(F.col("conv_id").alias("c"), F.col("parent_id").alias("i")).filter("i is not null").distinct()
    leaves = rooted.join(parents, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("msg_id") == F.col("i")), "left_anti")
    rank = Window.partitionBy("conv_id").orderBy(F.desc("path_score"), F.desc("depth"), F.asc("msg_id"))
    best = (leaves.withColumn("path_score", F.col("score") / (F.col("depth") + 1))
            .withColumn("r", F.row_number().over(rank)).filter(F.col("r") <= paths_per_conversation)
            .select("conv_id", F.col("msg_id").alias("path"), "msg_id", "path_score"))
    best = stored(best, "path-leaves")
    for k, up in enumerate(jumps):  # each round adds the messages that it reaches
        above = best.join(up, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("msg_id") == F.col("i")))
        best = best.unionByName(stored(above.select("conv_id", "path", F.col("up").alias("msg_id"), "path_score"), f"path-{k}"))
    depths = rooted.select(F.col("conv_id").alias("c"), F.col("msg_id").alias("i"), "depth")
    return best.join(depths, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("msg_id") == F.col("i"))).select(
        "conv_id", "path", "msg_id", "depth", "path_score")


def format_paths(messages: DataFrame, paths: DataFrame) -> DataFrame:
    """One row per path: conv_id, path, path_score, formatted, turn_starts, loss_spans.

    ``turn_starts``: where each turn begins in ``formatted``; ``loss_spans``: array of
    (turn, start, length), the assistants' texts, in code points from 0.
    """
    text = messages.select(F.col("conv_id").alias("c"), F.col("msg_id").alias("i"),
                           F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    head = F.concat(F.lit(START), _escape_role(F.col("role")), F.lit("\n"))
    turns = (paths.join(text, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("msg_id") == F.col("i")))
             .withColumns({"head": head, "body": escape(F.col("text"))})
             .withColumn("size", F.length("head").cast("long") + F.length("body") + len(END)))
    order = Window.partitionBy("conv_id", "path").orderBy("depth")
    turns = turns.withColumn("start", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    one = F.struct("depth", "start", F.concat("head", "body", F.lit(END)).alias("piece"),
                   F.length("head").cast("long").alias("head_chars"), F.length("body").cast("long").alias("body_chars"),
                   (F.lower("role") == "assistant").alias("loss"))
    grouped = turns.groupBy("conv_id", "path").agg(F.first("path_score").alias("path_score"), F.array_sort(F.collect_list(one)).alias("t"))
    return grouped.select(
        "conv_id", "path", "path_score",
        F.array_join(F.col("t.piece"), "").alias("formatted"),
        F.col("t.start").alias("turn_starts"),
        F.transform(F.filter("t", lambda x: x["loss"]), lambda x: F.struct(
            x["depth"].alias("turn"), (x["start"] + x["head_chars"]).alias("start"), x["body_chars"].alias("length"))).alias("loss_spans"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Parse the formatted text: adds turns (array of role, text) and loss_texts (array of
    the unescaped texts under the loss mask)."""
    raw = F.slice(F.split("formatted", re.escape(START)), 2, F.greatest(F.size("turn_starts"), F.lit(1)))
    opened = formatted.withColumn("raw", raw)
    role = lambda p: F.substring_index(p, "\n", 1)
    turn = lambda p: F.struct(_unescape_role(role(p)).alias("role"),
                              unescape(F.substr(p, F.length(role(p)) + 2, F.length(p) - F.length(role(p)) - 1 - len(END))).alias("text"))
    def masked(s):
        begin = F.get("turn_starts", s["turn"].cast("int")) + len(START)
        return unescape(F.substr(F.get("raw", s["turn"].cast("int")), (s["start"] - begin + 1).cast("int"), s["length"].cast("int")))
    return opened.withColumns({"turns": F.transform("raw", turn), "loss_texts": F.transform("loss_spans", masked)}).drop("raw")


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``conversations`` and conversation -7, formatted and read back."""
    probe = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]
    schema = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
                           T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(spark.createDataFrame(probe, schema))
    before = written()
    messages = stored(as_tree(turns), "messages")
    formatted = stored(format_paths(messages, reply_paths(messages)), "formatted")
    release(spark, before, formatted)
    out = read_back(formatted)
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learnt = F.array_join("loss_texts", "")
    return out.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told.cast("binary"), 256).alias("turns_sha256"),
                      F.length(learnt).cast("long").alias("loss_chars"), F.sha2(learnt.cast("binary"), 256).alias("loss_sha256"),
                      F.length("formatted").cast("long").alias("formatted_chars"))


OP8_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, role AS r0, text AS t0 FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]', 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]', 'assistant', '</s>[INST] ok [/INST]'
), sized AS (
  SELECT *, length('<|im_start|>') + 1 + length('<|im_end|>') + 1
    + length(regexp_replace(replace(replace(role, '%', '%25'), chr(10), '%0A'), '([<\[])(\\*)(\|im_start\|>|\|im_end\|>|s>|/s>|INST\]|/INST\]|<SYS>>|</SYS>>)', '\1\\\2\3', 'g'))
    + length(regexp_replace(text, '([<\[])(\\*)(\|im_start\|>|\|im_end\|>|s>|/s>|INST\]|/INST\]|<SYS>>|</SYS>>)', '\1\\\2\3', 'g')) AS chars
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, r0 NULLS FIRST, t0 NULLS FIRST)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (lower(role) = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, r0 NULLS FIRST, t0 NULLS FIRST) FILTER (lower(role) = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""
