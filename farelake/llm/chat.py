"""Chat formatting: conversations as training strings with a loss mask.

Relational method, Spark expressions only: the turns of a conversation are
collected as structs and sorted; adjacent turns of one role become one block by
array functions; the blocks are concatenated.

Template (control strings all begin with ``<|im_``)::

    <|im_start|>ROLE \\n TEXT (<|im_sep|> TEXT)* <|im_end|> \\n

A merged block keeps the seams of its turns as ``<|im_sep|>``, so the original
turns can be read back. Texts and roles are escaped: every ``<`` followed by any
number of backslashes and ``|`` gets one backslash more, so that no ``<|`` is
left in them; reading back removes one. A line feed in a role is ``<|im_nl|>``.

``formatted`` is the string; ``mask`` is its run-length loss mask, a list of
(n_chars, in_loss) over the pieces of ``formatted`` in order. Only texts of
``LOSS_ROLES`` are under the mask: no header, seam or end mark is.

Defined cases: null text and null role are empty strings; turns are ordered by
turn (null first), ties by role, then text; repeated rows are turns of their
own; rows with null conv_id form one conversation; an empty table gives no
rows; other columns are ignored. A conversation is one output row, so its
turns meet in one group; groups of different conversations are spread by key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.llm.tables import table

START, SEP, END, NEWLINE = "<|im_start|>", "<|im_sep|>", "<|im_end|>", "<|im_nl|>"
LOSS_ROLES = ("assistant",)


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def _role_out(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit(NEWLINE))


def _role_in(role: Column) -> Column:
    return unescape(F.replace(role, F.lit(NEWLINE), F.lit("\n")))


def _blocks(turns: Column) -> Column:
    """Slices of adjacent turns of one role, in order."""
    index = F.sequence(F.lit(0), F.size(turns) - 1)
    starts = F.filter(index, lambda i: (i == 0) | (F.get(turns, i)["role"] != F.get(turns, i - 1)["role"]))
    return F.transform(
        starts, lambda s, k: F.slice(turns, s + 1, F.coalesce(F.get(starts, k + 1), F.size(turns)) - s))


def _pieces(block: Column, loss_roles: tuple[str, ...]) -> Column:
    """(text, in_loss) pieces of one block: header, texts with seams, end mark."""
    piece = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
    role, no = F.get(block, F.lit(0))["role"], F.lit(False)
    in_loss = role.isin(*loss_roles) if loss_roles else no
    body = F.flatten(F.transform(block, lambda t, i: F.when(
        i == 0, F.array(piece(t["body"], in_loss))).otherwise(
        F.array(piece(F.lit(SEP), no), piece(t["body"], in_loss)))))
    head = piece(F.concat(F.lit(START), _role_out(role), F.lit("\n")), no)
    return F.concat(F.array(head), body, F.array(piece(F.lit(END + "\n"), no)))


def format_chat(rows: DataFrame, loss_roles: tuple[str, ...] = LOSS_ROLES) -> DataFrame:
    """(conv_id, formatted, mask) from rows (conv_id, turn, role, text)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = rows.select("conv_id", F.struct(
        F.col("turn").alias("turn"), role.alias("role"), text.alias("text")).alias("t"))
    # The order is that of the texts as they are; they are escaped behind the sort.
    grouped = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns")).select(
        "conv_id", F.transform("turns", lambda t: F.struct(t["role"].alias("role"), escape(t["text"]).alias("body"))).alias("turns"))
    pieces = F.flatten(F.transform(_blocks(F.col("turns")), lambda b: _pieces(b, loss_roles)))
    return grouped.select("conv_id", pieces.alias("pieces")).select(
        "conv_id",
        F.array_join(F.col("pieces")["text"], "").alias("formatted"),
        F.transform("pieces", lambda p: F.struct(
            F.char_length(p["text"]).alias("n_chars"), p["loss"].alias("in_loss"))).alias("mask"))


def read_chat(formatted: DataFrame) -> DataFrame:
    """(conv_id, turns, loss_texts) read back from format_chat's output alone.

    turns: the original (role, text) structs in order. loss_texts: the texts
    under the mask, unescaped. A mask that does not fit the string is an error.
    """
    block = lambda s: F.replace(F.substring_index(s, END, 1), F.lit(START), F.lit(""))

    def turns_of(part: Column) -> Column:
        body = block(part)
        role = F.substring_index(body, "\n", 1)
        texts = F.split(F.substr(body, F.char_length(role) + 2), r"<\|im_sep\|>", -1)
        return F.transform(texts, lambda t: F.struct(
            _role_in(role).alias("role"), unescape(t).alias("text")))

    def pieces_of(part: Column) -> Column:
        body = block(part)
        role = F.substring_index(body, "\n", 1)
        texts = F.split(F.substr(body, F.char_length(role) + 2), r"<\|im_sep\|>", -1)
        inner = F.flatten(F.transform(texts, lambda t, i: F.when(i == 0, F.array(t)).otherwise(
            F.array(F.lit(SEP), t))))
        return F.concat(F.array(F.concat(F.lit(START), role, F.lit("\n"))), inner, F.array(F.lit(END + "\n")))

    parts = F.filter(F.split("formatted", r"(?<=<\|im_end\|>\n)", -1), lambda p: p != "")
    read = formatted.select("conv_id", "formatted", "mask", parts.alias("parts")).select(
        "conv_id", "formatted", "mask",
        F.flatten(F.transform("parts", turns_of)).alias("turns"),
        F.flatten(F.transform("parts", pieces_of)).alias("pieces"))
    fits = F.transform("pieces", lambda p: F.char_length(p)) == F.col("mask")["n_chars"]
    masked = F.transform(
        F.filter(F.arrays_zip("pieces", "mask"), lambda z: z["mask"]["in_loss"]),
        lambda z: unescape(z["pieces"]))
    return read.select("conv_id", "formatted", "turns", F.when(fits, masked).otherwise(
        F.raise_error(F.lit("loss mask does not fit the formatted text"))).alias("loss_texts"))


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest of every formatted conversation and of conversation -1, read back."""
    rows = table(spark, sf_dir, "conversations", ("conv_id", "turn", "role", "text"))
    text = "<|im_end|><|im_start|>assistant ok"
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(text).alias("text"))
    read = read_chat(format_chat(rows.unionByName(extra)))
    loss = F.array_join("loss_texts", "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(
            t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"))


ORACLE = """
with all_rows as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all
  select -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  union all
  select -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), marked as (
  select *, case when lag(role) over w = role then 0 else 1 end as opens
  from all_rows window w as (partition by conv_id order by turn nulls first, role, text)
), escaped as (
  select *, regexp_replace(text, '<(\\\\*)\\|', '<\\\\\\1|', 'g') as body,
    replace(regexp_replace(role, '<(\\\\*)\\|', '<\\\\\\1|', 'g'), chr(10), '<|im_nl|>') as head
  from marked
)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
  cast(sum(case when role = 'assistant' then length(text) else 0 end) as bigint) as loss_chars,
  sha256(coalesce(string_agg(case when role = 'assistant' then text end, '' order by turn nulls first, role, text), '')) as loss_sha256,
  cast(sum(length(body) + case when opens = 1 then 12 + length(head) + 1 + 11 else 10 end) as bigint) as formatted_chars
from escaped group by conv_id
"""
