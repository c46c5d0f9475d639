"""Conversations from messages that quote each other.

Lines that begin with `>` are quotations, nested by the number of marks. What a message
says itself, and each passage that it quotes, is normalised and hashed, whole, by paragraphs
and by lines; each of these belongs to the earliest message that says it. A passage that
is not quoted whole goes to the message that most of it belongs to. A message replies to
the latest of the messages that it quotes at the lowest level, and replies make
conversations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardinel.llm.common import let, prefix_sums, saved

QUOTED = r"^[ \t]*(>[ \t]*)+"
INTRODUCTION = r"^.{0,200}\b(wrote|schrieb|escribió|a écrit)\s*:\s*$"


def _level(line: Column) -> Column:
    marks = F.regexp_extract(line, r"^([ \t]*>)*", 0)
    return F.length(F.regexp_replace(marks, r"[^>]", ""))


def normalised(text: Column) -> Column:
    """Small letters, white space as single blanks, none at the ends."""
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def passages(text: Column) -> Column:
    """Runs of lines with one quotation level: `level` and `text` without the marks.

    Blank lines end no passage, but stay between its paragraphs; lines that introduce a
    quotation are left out where a quotation follows. Linear in the number of lines.
    """
    lines = F.transform(
        F.split(F.coalesce(text, F.lit("")), "\r?\n"),
        lambda x: F.struct(_level(x).alias("level"), F.regexp_replace(x, QUOTED, "").alias("text")),
    )

    def build(own: Column) -> Column:
        kept = F.filter(own, lambda x, i: ~(
            x["text"].rlike(INTRODUCTION)
            & (F.coalesce(F.get(own, i + 1)["level"], F.lit(0)) > x["level"])
        ))
        text = lambda x: F.when(F.trim(x["text"]) == "", "").otherwise(x["text"])
        numbered = F.transform(kept, lambda x, i: F.struct(
            i.alias("at"), x["level"].alias("level"), text(x).alias("text")))
        return let(numbered, runs)

    def runs(lines: Column) -> Column:
        solid = F.filter(lines, lambda x: x["text"] != "")
        firsts = let(solid, lambda own: F.filter(
            own, lambda x, i: (i == 0) | (F.get(own, i - 1)["level"] != x["level"])))

        def cut(starts: Column) -> Column:
            def passage(x: Column, i: Column) -> Column:
                end = F.coalesce(F.get(starts, i + 1)["at"], F.size(lines))
                own = F.transform(F.slice(lines, x["at"] + 1, end - x["at"]), lambda y: y["text"])
                whole = F.regexp_replace(F.array_join(own, "\n"), r"\n+\z", "")
                return F.struct(x["level"].alias("level"), whole.alias("text"))

            return F.transform(starts, passage)

        return let(firsts, cut)

    return let(lines, build)


def units(text: Column) -> Column:
    """A passage (`kind` 2), its paragraphs (1) and lines (0), where they are not the same."""

    def parts(kind: int, cut: str) -> Column:
        own = F.transform(F.split(text, cut), normalised)
        return F.transform(
            F.when(F.size(own) > 1, own).otherwise(F.array()),
            lambda x: F.struct(F.lit(kind).alias("kind"), F.xxhash64(x).alias("hash"), F.length(x).alias("size")),
        )

    whole = normalised(text)
    first = F.struct(F.lit(2).alias("kind"), F.xxhash64(whole).alias("hash"), F.length(whole).alias("size"))
    found = F.concat(F.array(first), parts(1, r"\n\n+"), parts(0, r"\n+"))
    return F.filter(found, lambda x: x["size"] > 0)


def link(messages: DataFrame, scope: list[str]) -> DataFrame:
    """Adds `body` (without quotations), `quotes` and `reply_to` to messages.

    Messages come as `message_id`, `sent` (any order) and `text`, with `scope` columns
    that say which messages can quote each other (all, if empty). A quotation of
    nothing known, or of a later message only, links to nothing. Of messages with one
    text the earliest is the original. If a passage is not the whole of what somebody
    said, its paragraphs, or else its lines, must belong by half to one earlier message.
    `quotes` is the number of passages that link.
    """
    split = messages.withColumn("_passages", passages(F.col("text")))
    own = F.filter("_passages", lambda x: x["level"] == 0)
    quotes = F.filter("_passages", lambda x: x["level"] > 0)
    split = saved(
        split.withColumn("body", F.regexp_replace(
            F.array_join(F.transform(own, lambda x: x["text"]), "\n"), r"\n\n+", "\n"))
        .withColumn("_own", F.flatten(F.transform(own, lambda x: F.transform(units(x["text"]), lambda u: u["hash"]))))
        .withColumn("_quotes", F.transform(quotes, lambda x, i: F.struct(
            i.alias("run"), x["level"].alias("level"), units(x["text"]).alias("units"))))
        .drop("_passages"),
        "messages",
    )
    whole = F.xxhash64(normalised(F.col("body")))
    said = split.select(
        *scope,
        F.explode(F.array_distinct(F.concat("_own", F.array(whole)))).alias("hash"),
        F.struct("sent", "message_id").alias("_said"),
    )
    place = F.struct(*[F.col(c) for c in scope], F.col("hash")).alias("_place")
    originals = said.groupBy(place).agg(F.min("_said").alias("_said"))
    asked = split.select("message_id", "sent", *scope, F.inline("_quotes"))
    asked = asked.withColumn("_whole", F.element_at("units", 1)["size"])
    asked = asked.select("message_id", "sent", *scope, "run", "level", "_whole", F.inline("units"))
    asked = asked.withColumn("_place", F.struct(*[F.col(c) for c in scope], F.col("hash")))
    earlier = F.col("_said") < F.struct("sent", "message_id")
    found = asked.join(originals, "_place").filter(earlier)
    found = found.groupBy("message_id", "run", "level", "_whole", "kind", "_said").agg(F.sum("size").alias("_size"))
    # Blanks between paragraphs or lines are in the whole only.
    found = found.filter(2 * F.col("_size") >= F.col("_whole") - 1)
    found = found.groupBy("message_id", "run", "level").agg(
        F.max(F.struct("kind", "_size", "_said"))["_said"].alias("_said")
    )
    # The lowest level first, then the latest message.
    best = found.groupBy("message_id").agg(
        F.max(F.struct(-F.col("level"), F.col("_said"))).alias("_best"),
        F.count(F.lit(1)).alias("quotes"),
    )
    best = best.select("message_id", "quotes", F.col("_best._said.message_id").alias("reply_to"))
    return split.drop("_own", "_quotes").join(best, "message_id", "left").withColumn(
        "quotes", F.coalesce("quotes", F.lit(0))
    )


def threads(linked: DataFrame) -> DataFrame:
    """`thread` (the first message) and `depth` for every message, by pointer doubling."""
    at = linked.select(
        "message_id",
        F.coalesce("reply_to", "message_id").alias("thread"),
        F.col("reply_to").isNotNull().cast("long").alias("depth"),
    ).distinct()
    at = saved(at, "threads")
    settled, moving = at.filter("thread = message_id"), at.filter("thread <> message_id")
    while not moving.isEmpty():
        # Only messages that have not reached their first one are joined again.
        up = settled.union(moving).select(
            F.col("message_id").alias("thread"), F.col("thread").alias("_up"), F.col("depth").alias("_more")
        )
        moved = saved(moving.join(up, "thread").select(
            "message_id", F.col("_up").alias("thread"), (F.col("depth") + F.col("_more")).alias("depth"),
            (F.col("_up") == F.col("thread")).alias("_there"),
        ), "threads")
        settled = settled.union(moved.filter("_there").drop("_there"))
        moving = moved.filter("not _there").drop("_there")
    return settled


def build(messages: DataFrame, scope: list[str]) -> DataFrame:
    """Messages as conversations: `thread`, `position`, `depth`, `reply_to` and `body`.

    A reply comes after what it replies to, as positions follow the order of sending. Ids
    must be unique and not null; rows without an id are left out, and of rows with one
    id the one with the smallest text is kept. Null texts are empty bodies.
    """
    columns = ["message_id", "sent", "text", *scope]
    rest = [c for c in messages.columns if c not in columns]
    first = F.min(F.struct("text", "sent", *scope, *rest)).alias("_row")
    unique = messages.filter("message_id is not null").groupBy("message_id").agg(first)
    unique = unique.select("message_id", "_row.*")
    linked = saved(link(unique, scope), "linked-messages")
    placed = linked.join(threads(linked), "message_id")
    rows = placed.withColumn("_one", F.lit(1).cast("long")).withColumn("_bucket", F.col("depth"))
    return _ordered(rows).drop("_one", "_bucket", "text")


def _ordered(rows: DataFrame) -> DataFrame:
    """Positions by depth, then time: every reply after its message, no long sorts."""
    order = [F.col("sent"), F.col("message_id")]
    return prefix_sums(rows, ["thread"], "_bucket", order, "_one", "position")


def quoting(turns: DataFrame, levels: int = 2) -> DataFrame:
    """Turns of chats as mail: each quotes the turns before it, nested, above its own text.

    Rows of conv_id, turn and text become messages with ids `conv_id/turn`.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = turns.withColumn("_row", F.row_number().over(order))
    quoted = F.lit(None).cast("string")
    for level in range(levels, 0, -1):
        before = F.lag("text", level).over(order)
        lines = F.regexp_replace(before, r"(?m)^", "> " * level)
        quoted = F.concat_ws("\n", quoted, F.when(before.isNotNull(), lines))
    text = F.concat_ws("\n", F.when(quoted != "", quoted), F.col("text"))
    return rows.select(
        F.concat_ws("/", F.coalesce(F.col("conv_id").cast("string"), F.lit("")), F.col("_row").cast("string")).alias("message_id"),
        F.col("_row").cast("long").alias("sent"),
        text.alias("text"),
        "conv_id",
        "turn",
        "role",
    )
