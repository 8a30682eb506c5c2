"""Chat turns to one training text per conversation, with its loss mask, and back.

The template marks a run of adjacent turns of one role as

    <|im_start|>role<|im_sep|>text<|im_next|>text ...<|im_end|>

A control string inside a role or text gets a backslash after its first character
(one more, if it has some already), which reading back takes away again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

START, SEP, NEXT, END = "<|im_start|>", "<|im_sep|>", "<|im_next|>", "<|im_end|>"
# Control strings: the template's own, and those of other common templates, which a
# tokenizer might still take for special tokens.
CONTROL = r"(?:\|im_start\|>|\|im_sep\|>|\|im_next\|>|\|im_end\|>|\|endoftext\|>|/?s>|/?INST\])"


def escape(c) -> Column:
    """Text without a control string; ``unescape`` gives the original back."""
    return F.regexp_replace(c, rf"([<\[])(\\*)(?={CONTROL})", r"$1\\$2")


def unescape(c) -> Column:
    return F.regexp_replace(c, rf"([<\[])\\(\\*)(?={CONTROL})", r"$1$2")


def format_chats(
    turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    trained: str = "assistant",
) -> DataFrame:
    """One row per conversation: id, ``segments`` (text, loss) and ``formatted``, their concatenation.

    ``loss`` is true on exactly the texts of ``trained`` turns. Turns go by ``turn``
    (NULL first); ties by role and text, repeated rows stay. A NULL role or text is
    empty; rows with a NULL id form one conversation. An empty table gives no rows.
    Other columns are left out.

    A conversation is one output value, so its turns meet in one row; they are
    escaped before the shuffle, and all later steps are linear in its length.
    """
    rows = turns.select(
        F.col(conv_id).alias("c"),
        F.struct(
            F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"),
            F.coalesce(F.col(text), F.lit("")).alias("raw")).alias("t"))
    packed = rows.groupBy("c").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    # The first turn of each run of one role, then the runs themselves.
    packed = packed.withColumn("starts", F.filter(
        F.sequence(F.lit(1), F.size("turns")),
        lambda i: (i == 1) | (F.element_at("turns", F.greatest(i - 1, F.lit(1)))["role"] != F.element_at("turns", i)["role"])))
    packed = packed.withColumn("runs", F.transform("starts", lambda s, k: F.struct(
        F.element_at("turns", s)["role"].alias("role"),
        F.slice("turns", s, F.coalesce(F.get("starts", k + 1), F.size("turns") + 1) - s).alias("turns"))))

    def pieces(run):
        texts = F.flatten(F.transform(run["turns"], lambda t, i: F.array(
            F.struct(F.when(i == 0, F.concat(F.lit(START), escape(run["role"]), F.lit(SEP))).otherwise(NEXT).alias("text"),
                     F.lit(False).alias("loss")),
            F.struct(escape(t["raw"]).alias("text"), (run["role"] == trained).alias("loss")))))
        return F.concat(texts, F.array(F.struct(F.lit(END).alias("text"), F.lit(False).alias("loss"))))

    segments = F.flatten(F.transform("runs", pieces))
    return packed.select(F.col("c").alias(conv_id), segments.alias("segments")).select(
        conv_id, "segments", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"))


def read_back(formatted: Column) -> Column:
    """The (role, text) turns of a formatted conversation; every run is cut in role and body once."""
    runs = F.filter(F.split(formatted, r"<\|im_end\|>"), lambda r: r != "")
    cut = F.transform(runs, lambda r: F.split(r, r"<\|im_sep\|>", 2))
    named = F.transform(cut, lambda p: F.struct(
        unescape(F.regexp_replace(p[0], r"^<\|im_start\|>", "")).alias("role"), F.split(p[1], r"<\|im_next\|>").alias("texts")))
    return F.flatten(F.transform(named, lambda r: F.transform(r["texts"], lambda t: F.struct(
        r["role"].alias("role"), unescape(t).alias("text")))))


def trained_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")


def digests(formatted: DataFrame, conv_id: str = "conv_id") -> DataFrame:
    """What a formatted table holds, read back from it: counts and SHA-256 digests."""
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return formatted.select(
        conv_id, read_back(F.col("formatted")).alias("turns"), trained_text(F.col("segments")).alias("loss"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    ).select(
        conv_id, F.size("turns").cast("long").alias("n_turns"), F.sha2(turns, 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")
