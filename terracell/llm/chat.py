"""Chat formatting by prefix-target expansion, in DataFrame operations only.

Every assistant turn becomes an example of its own: all preceding turns are
its context and only the reply is trainable. As each example's text is a
prefix of its conversation's text, examples carry spans into it: the text ends
where the reply ends.

Template: each turn is ``<s>[INST] role [/INST] text </s>``. Inside texts,
backslashes are doubled and each control string gets a backslash after its
first character, so no text can open or close a turn; undoing both in reverse
order gives the text back. Roles are URL-encoded, which leaves plain names as
they are.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The template's control strings; each has at least two characters and no backslash.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]")
OPEN, CLOSE = "<s>[INST] ", " </s>"
HEAD = " [/INST] "
TARGET_ROLE = "assistant"


def _replace(text: Column, old: str, new: str) -> Column:
    return F.replace(text, F.lit(old), F.lit(new))


def escaped(text: Column) -> Column:
    return reduce(lambda t, c: _replace(t, c, f"{c[0]}\\{c[1:]}"), CONTROLS, _replace(text, "\\", "\\\\"))


def unescaped(text: Column) -> Column:
    return _replace(reduce(lambda t, c: _replace(t, f"{c[0]}\\{c[1:]}", c), CONTROLS, text), "\\\\", "\\")


def rendered(role: Column, text: Column) -> Column:
    """One turn in the template."""
    return F.concat(F.lit(OPEN), F.url_encode(role), F.lit(HEAD), escaped(text), F.lit(CLOSE))


def examples(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", target_role: str = TARGET_ROLE) -> DataFrame:
    """(conv_id, example, text, loss_start, loss_end): one row for each assistant turn of each conversation.

    text is the rendered conversation up to and with that reply; loss_start
    and loss_end (code points, end exclusive) mark the reply's own, escaped
    text. Turns after a conversation's last reply, and conversations without
    one, get one more row with an empty loss span, so that no turn is lost.
    Turns sort by turn number, then role and text; null sorts first. Null
    roles and texts count as empty; rows with a null conv_id form one
    conversation. Repeated rows are repeated turns. Other columns are ignored.
    """
    turns = df.select(
        F.col(conv).alias("conv_id"),
        F.struct(F.col(turn).alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")).alias("said"),
    )
    talks = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list("said")).alias("said"))
    talks = talks.withColumn("parts", F.transform("said", lambda s: rendered(s["role"], s["text"])))
    talks = talks.withColumn("ends", F.aggregate("parts", F.array().cast("array<int>"), lambda found, p: F.concat(found, F.array(F.coalesce(F.try_element_at(found, F.lit(-1)), F.lit(0)) + F.char_length(p)))))
    talks = talks.select("conv_id", "said", F.array_join("parts", "").alias("whole"), "ends")
    spot = F.transform(
        "said",
        lambda s, i: F.struct(
            (i + 1).alias("upto"),
            ((s["role"] == target_role) | (i + 1 == F.size("said"))).alias("shown"),
            F.element_at("ends", i + 1).alias("end"),
            F.when(s["role"] == target_role, F.char_length(escaped(s["text"]))).otherwise(F.lit(0)).alias("loss"),
        ),
    )
    spots = talks.select("conv_id", "whole", F.explode(F.filter(spot, lambda s: s["shown"])).alias("spot"))
    end = F.col("spot.end") - F.when(F.col("spot.loss") > 0, len(CLOSE)).otherwise(0)
    return spots.select("conv_id", F.col("spot.upto").alias("example"), F.substring(F.col("whole"), F.lit(1), F.col("spot.end")).alias("text"), (end - F.col("spot.loss")).alias("loss_start"), end.alias("loss_end"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of conversations, read from the formatted examples alone.

    The longest example of a conversation has all of its turns; each example's
    loss span gives one reply.
    """
    whole = F.max_by("text", "example")
    replies = F.array_sort(F.collect_list(F.struct("example", F.substring("text", F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start")).alias("reply"))))
    talks = formatted.groupBy("conv_id").agg(whole.alias("whole"), replies.alias("replies"), F.sum(F.char_length("text")).alias("formatted_chars"))
    pieces = F.filter(F.split(F.col("whole"), "</s>", -1), lambda p: p != "")

    def turn(piece: Column) -> Column:
        body = F.substring(piece, F.lit(len(OPEN) + 1), F.char_length(piece))
        cut = F.instr(body, HEAD)
        said = F.substring(body, cut + len(HEAD), F.char_length(body) - cut - len(HEAD))
        return F.concat(F.url_decode(F.substring(body, F.lit(1), cut - 1)), F.lit("\n"), unescaped(said), F.lit("\n"))

    talks = talks.select("conv_id", "formatted_chars", F.transform(pieces, turn).alias("turns"), F.array_join(F.transform("replies", lambda r: unescaped(r["reply"])), "").alias("loss"))
    return talks.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join("turns", "").cast("binary"), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.col("formatted_chars").cast("long"),
    )


#: What SQL can say of the same digests: they are those of the turns themselves.
SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
shaped AS (
  SELECT *, replace(replace(replace(replace(replace(text, '\', '\\'), '<s>', '<\s>'), '</s>', '<\/s>'), '[INST]', '[\INST]'), '[/INST]', '[\/INST]') AS safe FROM rows),
placed AS (
  SELECT *, sum(length('<s>[INST] ' || role || ' [/INST] ' || safe || ' </s>')) OVER w AS upto,
    role = 'assistant' OR row_number() OVER w = count(*) OVER (PARTITION BY conv_id) AS shown
  FROM shaped WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING))
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(upto) FILTER (WHERE shown)::BIGINT AS formatted_chars
FROM placed GROUP BY conv_id
"""


def with_probe(df: DataFrame) -> DataFrame:
    """conversations plus conversation -7, whose texts are control strings of the template."""
    probe = df.sparkSession.createDataFrame([(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")], "conv_id long, turn long, role string, text string")
    return df.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text").unionByName(probe)
