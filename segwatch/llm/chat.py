"""Chat template with a grammar that is read back: render, reparse, compare, escape what conflicts.

DataFrame functions only. The grammar of a formatted conversation is::

    conversation = { turn }
    turn = "<|im_start|>" role "\\n" text "<|im_end|>" "\\n"

Inside role and text a sign ``<``, any number of backslashes and ``|`` stand for the same with one
backslash less, so no control string can occur there. A role also writes its line breaks and percent
signs as %0A and %25. Escaping leaves every other text as it is; reading back always undoes it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"
LEARNED_ROLE = "assistant"


def escape_text(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape_text(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    return escape_text(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape_text(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def _turn(role: Column, text: Column) -> Column:
    return F.concat(F.lit(START), role, F.lit("\n"), text, F.lit(END))


def parse(formatted: Column) -> Column:
    """The turns (``role, text``) of a formatted conversation; NULL where it breaks the grammar."""
    parts = F.split(formatted, F.lit(r"<\|im_end\|>\n"))
    # What follows the last turn must be empty.
    turns = F.slice(parts, F.lit(1), F.size(parts) - 1)

    def read(part: Column) -> Column:
        header = F.substring_index(part, "\n", 1)
        body = F.substr(part, F.length(header) + 2)
        role = F.substr(header, F.lit(len(START) + 1))
        good = F.startswith(part, F.lit(START)) & F.contains(part, F.lit("\n")) & ~F.contains(role, F.lit("<|im_")) & ~F.contains(body, F.lit("<|im_"))
        return F.when(good, F.struct(unescape_role(role).alias("role"), unescape_text(body).alias("text")))

    found = F.transform(turns, read)
    broken = F.exists(found, lambda t: t.isNull()) | (F.get(parts, F.size(parts) - 1) != "")
    return F.when(~broken, found)


def format_conversations(
    df: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """``conversation, formatted, loss_spans, n_turns, n_escaped``: one row for each conversation.

    Every turn is rendered as it is, parsed by the grammar and compared with its source; a turn that
    does not come back the same is rendered with its content escaped, and so on until all turns are
    identical, which one round of escaping ensures. The whole conversation is then parsed once more and a
    difference fails the query. ``loss_spans`` are the ``start, end`` code points (end exclusive) of the
    text of each assistant turn inside ``formatted``.

    Turns are ordered by turn number, then role and text, so repeated and tied rows have a fixed
    place and all are kept. NULL texts and roles count as empty, NULL conversations form one
    conversation of their own, an empty table gives none, and other columns are not read. A conversation is one value, so its turns
    meet in one row; nothing else is brought together.
    """
    rows = df.select(
        F.col(conversation).alias("c"), F.col(turn).alias("t"),
        F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    plain = parse(_turn(F.col("role"), F.col("text")))
    same = F.coalesce(
        (F.size(plain) == 1) & (F.get(plain, 0)["role"] == F.col("role")) & (F.get(plain, 0)["text"] == F.col("text")),
        F.lit(False),
    )
    rows = rows.withColumn("plain", same).withColumn("shown_text", F.when(F.col("plain"), F.col("text")).otherwise(escape_text(F.col("text"))))
    shown_role = F.when(F.col("plain"), F.col("role")).otherwise(escape_role(F.col("role")))
    rendered = _turn(shown_role, F.col("shown_text"))
    rows = rows.select(
        "c", "role", "text", "plain", F.length("shown_text").cast("bigint").alias("inner"), rendered.alias("rendered"),
        # Where the turn ends in the formatted text.
        F.sum(F.length(rendered).cast("bigint")).over(
            Window.partitionBy("c").orderBy("t", "role", "text").rowsBetween(Window.unboundedPreceding, 0)
        ).alias("end"),
    )
    # The ends rise from turn to turn, so sorting by them is sorting by turn.
    turns = F.array_sort(F.collect_list(F.struct("end", "role", "text", "inner", "rendered")))
    gathered = rows.groupBy("c").agg(turns.alias("turns"), F.count_if(~F.col("plain")).alias("n_escaped"))
    whole = gathered.select(
        F.col("c").alias(conversation), "turns", "n_escaped",
        F.array_join(F.transform("turns", lambda x: x["rendered"]), "").alias("formatted"),
    )
    source = F.transform("turns", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text")))
    failure = F.raise_error(F.lit("a formatted conversation does not read back as its source"))
    checked = F.when(F.coalesce(parse(F.col("formatted")) == source, F.lit(False)), F.col("formatted")).otherwise(failure.cast("string"))
    spans = F.transform(
        F.filter("turns", lambda x: x["role"] == LEARNED_ROLE),
        lambda x: F.struct((x["end"] - len(END) - x["inner"]).alias("start"), (x["end"] - len(END)).alias("end")),
    )
    return whole.select(
        conversation, checked.alias("formatted"), spans.alias("loss_spans"), F.size("turns").cast("bigint").alias("n_turns"), "n_escaped",
    )
