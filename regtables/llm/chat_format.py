"""Chat formatting with relational expressions only.

Turns of a conversation are collected as structs, sorted, merged where neighbours have one role, and joined to
one string:

    <|role|>user<|text|>first turn<|also|>second turn of the same role<|end|><|role|>assistant<|text|>…<|end|>

Inside roles and texts every ``<``, any number of ``\\\\`` and ``|`` in a row gets one more backslash, so no control
string can stand in them, and taking it away again gives the text back. ``loss`` has the (start, length) of each
assistant text in characters, and the same in bytes (start_byte, n_bytes).

Turns are ordered by ``turn``, then role and text where it ties; a null turn comes first, a null role or text
counts as empty, rows without conv_id are one conversation. Other columns are ignored; an empty table gives no
rows. A conversation is one string, so it is gathered in one row; conversations are dealt by conv_id. Work grows with
the turns and characters of a conversation, however long."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from regtables.functions.binding import let

ROLE, TEXT, ALSO, END = "<|role|>", "<|text|>", "<|also|>", "<|end|>"
TRAINED_ROLE = "assistant"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def merged_turns(turns: Column) -> Column:
    """Sorted turns (turn, role, text) as blocks (role, texts): one for each run of turns of a role."""
    places = F.sequence(F.lit(0), F.size(turns) - 1)
    heads = F.filter(places, lambda i: (i == 0) | (F.get(turns, i)["role"] != F.get(turns, i - 1)["role"]))
    ends = F.concat(F.slice(heads, 2, F.size(heads)), F.array(F.size(turns)))
    return F.transform(
        F.arrays_zip(heads.alias("a"), ends.alias("b")),
        lambda r: F.struct(F.get(turns, r["a"])["role"].alias("role"), F.transform(F.slice(turns, r["a"] + 1, r["b"] - r["a"]), lambda t: t["text"]).alias("texts")),
    )


def _block(b: Column) -> Column:
    texts = F.array_join(F.transform(b["texts"], escaped), ALSO)
    return F.concat(F.lit(ROLE), escaped(b["role"]), F.lit(TEXT), texts, F.lit(END))


def _sizes(blocks: Column) -> Column:
    """Each text in order: what stands before it since the last and behind it, and its own length, in characters and
    bytes. Control strings are ASCII."""

    def of_text(b: Column, t: Column, i: Column) -> Column:
        role = escaped(b["role"])
        before = lambda size: F.when(i == 0, size(role) + len(ROLE) + len(TEXT)).otherwise(len(ALSO)).cast("bigint")
        return F.struct(
            before(F.length).alias("before"), F.length(escaped(t)).cast("bigint").alias("length"),
            before(F.octet_length).alias("bytes_before"), F.octet_length(escaped(t)).cast("bigint").alias("n_bytes"),
            F.when(i == F.size(b["texts"]) - 1, len(END)).otherwise(0).alias("after"),
            (b["role"] == TRAINED_ROLE).alias("trained"),
        )

    return F.flatten(F.transform(blocks, lambda b: F.transform(b["texts"], lambda t, i: of_text(b, t, i))))


def formatted(rows: DataFrame) -> DataFrame:
    """rows: conv_id, turn, role, text. One row per conversation: conv_id, formatted, loss."""
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    turns = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    blocks = turns.select("conv_id", merged_turns(F.col("turns")).alias("blocks"))
    whole = blocks.select("conv_id", F.array_join(F.transform("blocks", _block), "").alias("formatted"), _sizes(F.col("blocks")).alias("sizes"))
    # Running sums over a conversation's texts: its rows are where its string is, so nothing is moved for them.
    each = whole.select("conv_id", "formatted", F.posexplode("sizes").alias("pos", "s"))
    each = each.select("conv_id", F.when(F.col("pos") == 0, F.col("formatted")).alias("formatted"), "pos", "s.*")
    so_far = Window.partitionBy("conv_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    stop = F.sum(F.col("before") + F.col("length") + F.col("after")).over(so_far) - F.col("after")
    stop_byte = F.sum(F.col("bytes_before") + F.col("n_bytes") + F.col("after")).over(so_far) - F.col("after")
    placed = each.withColumns({"start": stop - F.col("length"), "start_byte": stop_byte - F.col("n_bytes")})
    span = F.struct(*(F.col(c).cast("int").alias(c) for c in ("start", "length", "start_byte", "n_bytes")))
    return placed.groupBy("conv_id").agg(F.max("formatted").alias("formatted"), F.array_sort(F.collect_list(F.when(F.col("trained"), span))).alias("loss"))


def read_turns(text: Column) -> Column:
    """The turns (role, text) of a formatted conversation."""
    blocks = F.slice(F.split(text, r"<\|end\|>"), 1, F.size(F.split(text, r"<\|end\|>")) - 1)
    parts = F.transform(blocks, lambda b: F.split(F.substring(b, len(ROLE) + 1, 1 << 30), r"<\|text\|>"))
    return F.flatten(
        F.transform(
            parts,
            lambda p: F.transform(F.split(F.get(p, F.lit(1)), r"<\|also\|>"), lambda t: F.struct(unescaped(F.get(p, F.lit(0))).alias("role"), unescaped(t).alias("text"))),
        )
    )


def digests(formatted_rows: DataFrame) -> DataFrame:
    """What the formatted conversations hold, read back from them."""
    turns = F.transform(read_turns(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    # By bytes: characters would be counted from the beginning for each span.
    text_at = lambda data, s: unescaped(F.substring(data, s["start_byte"] + 1, s["n_bytes"]).cast("string"))
    trained = let(F.col("formatted").cast("binary"), lambda data: F.array_join(F.transform("loss", lambda s: text_at(data, s)), ""))
    read = formatted_rows.select("conv_id", "formatted", turns.alias("turns"), trained.alias("trained"))
    return read.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join("turns", ""), 256).alias("turns_sha256"),
        F.length("trained").cast("bigint").alias("loss_chars"),
        F.sha2("trained", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )
