"""Reply-ordered conversations from messages that quote each other, DataFrame only.

Quote marks at the start of a line give its level; runs of lines of one level are passages.
Normalised passages are hashed and joined, inside a conversation, to the messages that say
the same in their own words (whole, or one line of ``MIN_LINE_WORDS`` words or more). The
shallowest quoted passage with a match names the parent; a message's depth is the length of
its chain of parents, found by pointer doubling. The conversation is read by depth and
message id, each message without its quotes.

Messages: conv_id, msg_id, role, text.

Defined results: null texts count as empty. A message without a match is a root of depth 0.
If several messages say the same, the one with the least id is the original; a message never
replies to itself, and of messages that name each other as parents none has a depth (null):
they come last. Messages with the same (conv_id, msg_id) count as one, the one whose text is
least. A null id takes part in no link.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lendmart.llm.common import stored

MIN_LINE_WORDS = 5
#: Doubling rounds: chains of up to 2^40 replies.
MAX_ROUNDS = 40
_MARKS = r"^(?:[ \t]?>)+"


def normalised(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def _passages(text: Column) -> Column:
    """array<struct<level, lines>>: runs of lines of one quote level."""
    parsed = F.transform(F.split(text, "\n"), lambda line: F.struct(
        F.length(F.regexp_replace(F.regexp_extract(line, _MARKS, 0), "[^>]", "")).alias("level"),
        F.when(line.rlike(_MARKS), F.regexp_replace(line, _MARKS + " ?", "")).otherwise(line).alias("line"),
    ))
    return parsed


def parsed_messages(messages: DataFrame) -> DataFrame:
    """(row, conv_id, msg_id, role, own, quotes): own words, and quoted passages as
    array<struct<level, lines>> in the order of the text. ``row`` tells messages apart."""
    columns = ["conv_id", "msg_id", "role", "text"]
    said = messages.select("conv_id", "msg_id", "role", F.coalesce("text", F.lit("")).alias("text")).distinct()
    row = F.xxhash64(*columns, *[F.col(c).isNull() for c in columns])
    rows = said.select(row.alias("row"), "conv_id", "msg_id", "role", _passages(F.col("text")).alias("lines"))
    lines = F.col("lines")
    heads = F.filter(
        F.sequence(F.lit(0), F.size("lines") - 1),
        lambda i: (i == 0) | (F.get(lines, i)["level"] != F.get(lines, i - 1)["level"]),
    )
    with_heads = rows.withColumn("heads", heads)
    head = F.col("heads")
    runs = F.transform(head, lambda start, k: F.struct(
        F.get(lines, start)["level"].alias("level"),
        F.transform(
            F.slice(lines, start + 1, F.coalesce(F.get(head, k + 1), F.size(lines)) - start), lambda x: x["line"]
        ).alias("lines"),
    ))
    cut = with_heads.withColumn("runs", runs)
    own = F.flatten(F.transform(F.filter("runs", lambda r: r["level"] == 0), lambda r: r["lines"]))
    return cut.select(
        "row", "conv_id", "msg_id", "role", F.trim(F.array_join(own, "\n")).alias("own"),
        F.filter("runs", lambda r: r["level"] > 0).alias("quotes"),
    )


def _keys(lines: Column) -> Column:
    """array<struct<whole, hash>>: of the passage and of its longer lines."""
    one = lambda t, whole: F.struct(F.lit(whole).alias("whole"), F.md5(t).alias("hash"))
    longer = F.filter(
        F.transform(lines, normalised), lambda t: F.size(F.split(t, " ")) >= MIN_LINE_WORDS
    )
    whole = normalised(F.array_join(lines, "\n"))
    return F.concat(
        F.when(whole != "", F.array(one(whole, 1))).otherwise(F.array().cast("array<struct<whole:int,hash:string>>")),
        F.transform(longer, lambda t: one(t, 0)),
    )


def reply_links(parsed: DataFrame) -> DataFrame:
    """(row, parent, above) of every message with a matched quotation: the id of the message
    it answers and that one's row. A message without an id is nobody's parent."""
    said = parsed.where("msg_id IS NOT NULL").select(
        "conv_id", F.struct("msg_id", "row").alias("by"), F.explode(_keys(F.split("own", "\n"))).alias("k")
    ).select("conv_id", "by", F.col("k.hash").alias("hash"))
    # The two least are enough: one of them is not the quoting message itself.
    first = said.groupBy("conv_id", "hash").agg(F.min("by").alias("first"))
    second = said.join(first, ["conv_id", "hash"]).where("by.row <> first.row").groupBy("conv_id", "hash").agg(
        F.min("by").alias("second")
    )
    originals = first.join(second, ["conv_id", "hash"], "left")
    quoted = parsed.select("conv_id", "row", F.explode("quotes").alias("q")).select(
        "conv_id", "row", F.col("q.level").alias("level"), F.explode(_keys(F.col("q.lines"))).alias("k")
    ).select("conv_id", "row", "level", "k.whole", "k.hash")
    hits = quoted.join(originals, ["conv_id", "hash"]).withColumn(
        "parent", F.when(F.col("first.row") != F.col("row"), F.col("first")).otherwise(F.col("second"))
    ).where(F.col("parent").isNotNull())
    return hits.groupBy("row").agg(
        F.min(F.struct("level", (-F.col("whole")).alias("part"), "parent")).alias("best")
    ).select("row", F.col("best.parent.msg_id").alias("parent"), F.col("best.parent.row").alias("above"))


def conversations(messages: DataFrame) -> DataFrame:
    """(conv_id, msg_id, parent, depth, role, text): every message without its quotes. Read
    a conversation in the order of depth and msg_id."""
    parsed = stored(parsed_messages(messages), "quotes")
    links = stored(reply_links(parsed), "quotes")
    # A row is open while the message above it has a parent itself; only open rows move.
    linked = links.select(F.col("row").alias("above"), F.lit(True).alias("open"))
    state = stored(
        links.select("row", "above", F.lit(1).cast("long").alias("steps"))
        .join(linked, "above", "left").withColumn("open", F.coalesce("open", F.lit(False))), "quotes",
    )
    for _ in range(MAX_ROUNDS):
        if state.where("open").isEmpty():
            break
        up = state.select(
            F.col("row").alias("above"), F.col("above").alias("next"), F.col("steps").alias("more"),
            F.col("open").alias("still"),
        )
        moved = state.where("open").join(up, "above").select(
            F.col("next").alias("above"), "row", (F.col("steps") + F.col("more")).alias("steps"),
            F.col("still").alias("open"),
        )
        state = stored(state.where("not open").unionByName(moved), "quotes")
    state = state.where("not open")  # what is open still runs in a circle
    depths = state.select("row", "steps")
    return parsed.join(links, "row", "left").join(depths, "row", "left").select(
        "conv_id", "msg_id", "parent",
        F.when(F.col("parent").isNull(), F.lit(0).cast("long")).otherwise(F.col("steps")).alias("depth"),
        "role", F.col("own").alias("text"),
    )
