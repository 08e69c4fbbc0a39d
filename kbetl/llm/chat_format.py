"""Conversations as training text: sorted turns, adjacent turns of one role merged, a mask for the loss.

Template, one block for each run of turns with the same role, further turns of the run after ``[NEXT]``:

    <s>[INST:role]text[NEXT]text</s>

Strings that start like those of the template, or of other common chat templates, are broken inside texts by a
backslash after their first character; a backslash of the text becomes two. In roles ``% ] [ <`` are
percent-encoded. So no text can be read as a control string, and undoing this gives it back exactly.

DataFrame expressions only. Turns are collected once by conversation, sorted as structs, cut into runs by
slices and concatenated; all steps are linear in the length of a conversation. A conversation becomes one
row: it must fit in one task, which is the nature of the output, and no other rows are gathered with it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import pick, table

OPEN, ROLE_END, NEXT, CLOSE = "<s>[INST:", "]", "[NEXT]", "</s>"
LEARNED_ROLE = "assistant"
EXTRA_CONVERSATION = -7
# What follows < or [ in a control string; none of these holds a < or [ itself.
_STARTS = r"/?s>|/?INST|/?NEXT|/?SYS|\||/?SEP|/?CLS|/?PAD|/?unk>|/?pad>"
_PERCENT = [("%", "%25"), ("]", "%5D"), ("[", "%5B"), ("<", "%3C")]


def escape(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, rf"([<\[])(?={_STARTS})", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def encode_role(role: Column) -> Column:
    for plain, code in _PERCENT:
        role = F.replace(role, F.lit(plain), F.lit(code))
    return role


def decode_role(role: Column) -> Column:
    for plain, code in reversed(_PERCENT):
        role = F.replace(role, F.lit(code), F.lit(plain))
    return role


def format_conversations(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """One row per conversation: ``conv_id, formatted, mask``.

    ``mask`` is the loss mask as runs ``chars, is_text, learned`` of code points that cover ``formatted`` from its
    start; a run is learned if it is the (escaped) text of an assistant's turn, and all else is markup or not learned.

    * A null text or role is the empty one. Turns with a null number come first; ties are ordered by role, then text.
    * Repeated rows are turns of their own. Rows with a null ``conv_id`` are one conversation.
    * Empty texts give a run of length 0. An empty table gives no rows. Further columns are ignored.
    """
    source = pick(turns, conv_id=conv_col, turn=turn_col, role=role_col, text=text_col)
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    sorted_ = source.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    first = F.transform("turns", lambda t, i: F.when((i == 0) | (t["role"] != F.get("turns", i - 1)["role"]), i + 1))
    starts = sorted_.withColumn("starts", F.filter(first, lambda i: i.isNotNull()))

    def run(start: Column, k: Column) -> Column:
        end = F.coalesce(F.get("starts", k + 1), F.size("turns") + 1)
        members = F.slice("turns", start, end - start)
        return F.struct(
            encode_role(F.get("turns", start - 1)["role"]).alias("role"),
            (F.get("turns", start - 1)["role"] == LEARNED_ROLE).alias("learned"),
            F.transform(members, lambda t: escape(t["text"])).alias("texts"),
        )

    runs = starts.select("conv_id", F.transform("starts", run).alias("runs"))
    block = F.transform("runs", lambda r: F.concat(F.lit(OPEN), r["role"], F.lit(ROLE_END), F.array_join(r["texts"], NEXT), F.lit(CLOSE)))

    def stretch(chars: Column, is_text: bool, learned: Column) -> Column:
        return F.struct(chars.cast("long").alias("chars"), F.lit(is_text).alias("is_text"), learned.alias("learned"))

    no = F.lit(False)
    mask = F.flatten(
        F.transform(
            "runs",
            lambda r: F.concat(
                F.flatten(
                    F.transform(
                        r["texts"],
                        lambda t, i: F.array(
                            stretch(F.when(i == 0, F.length(r["role"]) + len(OPEN) + len(ROLE_END)).otherwise(len(NEXT)), False, no),
                            stretch(F.length(t), True, r["learned"]),
                        ),
                    )
                ),
                F.array(stretch(F.lit(len(CLOSE)), False, no)),
            ),
        )
    )
    return runs.select("conv_id", F.array_join(block, "").alias("formatted"), mask.alias("mask"))


def parse_formatted(formatted: Column) -> Column:
    """The turns of a formatted conversation: an array of ``role, text``, in order, unescaped."""
    blocks = F.filter(F.split(formatted, r"\Q" + CLOSE + r"\E", -1), lambda b: b != "")

    def of_block(block: Column) -> Column:
        # The first end mark is the role's: a role holds none.
        role_chars = F.instr(block, ROLE_END) - len(OPEN) - 1
        role = decode_role(F.substring(block, F.lit(len(OPEN) + 1), role_chars))
        body = F.substring(block, F.instr(block, ROLE_END) + len(ROLE_END), F.length(block))
        return F.transform(F.split(body, r"\Q" + NEXT + r"\E", -1), lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(blocks, of_block))


def text_runs(mask: Column) -> Column:
    """The runs of a mask that are texts, in the order of the turns; the rest is markup."""
    return F.filter(mask, lambda m: m["is_text"])


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = pick(table(spark, sf_dir, "conversations"), conv_id="conv_id", turn="turn", role="role", text="text")
    extra = spark.range(2).select(
        F.lit(EXTRA_CONVERSATION).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise(LEARNED_ROLE).alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    made = format_conversations(turns.unionByName(extra))
    back = made.withColumn("back", parse_formatted(F.col("formatted")))
    # The mask's learned flags, without those of markup, are in step with the turns read back.
    texts = text_runs(F.col("mask"))
    said = F.array_join(F.transform("back", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.zip_with("back", "texts", lambda t, m: F.when(m["learned"], t["text"]).otherwise("")), "")
    return back.withColumn("texts", texts).withColumn("loss", loss).select(
        "conv_id",
        F.size("back").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


OP4_SQL = r"""
with t as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]'
  union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e as (
  select *, replace(replace(replace(replace(role, '%', '%25'), ']', '%5D'), '[', '%5B'), '<', '%3C') as code,
    regexp_replace(replace(text, '\', '\\'),
      '([<\[])(/?s>|/?INST|/?NEXT|/?SYS|\||/?SEP|/?CLS|/?PAD|/?unk>|/?pad>)', '\1\\\2', 'g') as escaped,
    lag(role) over (partition by conv_id order by turn nulls first, role, text) as before,
    row_number() over (partition by conv_id order by turn nulls first, role, text) as nth
  from t)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by nth)) as turns_sha256,
  coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by nth) filter (role = 'assistant'), '')) as loss_sha256,
  sum(length(escaped) + case when before = role then 6 else length(code) + 14 end)::bigint as formatted_chars
from e group by conv_id
"""
