"""Chat formatting by quotation linking, in DataFrame operations only.

Lines are parsed into quote level and content; consecutive lines of one level are a passage. Its lines, and
where it has several also its sentences, whatever their line breaks, are normalised and hashed, and linked with
the latest earlier message of the conversation that has them in its own words. Every level is linked. A message
replies to the one that most of its outermost linked quotes come from; without a linked quote to
the message before it. Quotes are then cut out of the text.

The replies of a conversation form trees. The first reply to a message continues its branch, any other one opens
a new branch, so messages in order of (branch, turn) are in reply order and no branch is mixed with
another. Only messages that reply to another one than that before them can open a branch: what is
between two of them is one segment, and only segments are followed up to their beginnings, by
doubling, in rounds that are written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from civiclake.plans.scratch import written

#: Turns of one conversation that a window orders together; longer conversations are cut into slices.
SLICE_TURNS = 4096

QUOTE_MARK = r"^((?:[ \t]*>)+)"
SENTENCE_ENDS = "[.!?]+"

#: Marks of a passage's beginning, of the end of its level and of its line breaks, while a message is one text.
PASSAGE, CONTENT, BREAK = "\x01", "\x02", "\x03"


def quote_level(line: Column) -> Column:
    """How many ``>`` a line starts with."""
    return F.length(F.regexp_replace(F.regexp_extract(line, QUOTE_MARK, 1), r"[ \t]", ""))


def normalised(line: Column) -> Column:
    """A line without quote marks, in lower case, runs of other characters than letters and digits as one blank."""
    bare = F.regexp_replace(line, QUOTE_MARK, "")
    return F.trim(F.regexp_replace(F.lower(bare), r"[^\p{L}\p{N}]+", " "))


def units(text: Column | str) -> Column:
    """array<struct<level, unit>>: normalised lines, and sentences of passages of several lines; no empty ones."""
    lines = F.split(F.translate(text, PASSAGE + CONTENT + BREAK, "   "), "\n")
    levels = F.transform(lines, quote_level)
    before = F.concat(F.array(F.lit(-1)), F.slice(levels, 1, F.greatest(F.size(levels) - 1, F.lit(0))))
    begins = F.zip_with(
        levels,
        before,
        lambda level, last: F.when(level == last, F.lit(BREAK)).otherwise(
            F.concat(F.lit(PASSAGE), level.cast("string"), F.lit(CONTENT))
        ),
    )
    marked = F.zip_with(begins, lines, lambda begin, line: F.concat(begin, F.regexp_replace(line, QUOTE_MARK, "")))
    passages = F.split(F.array_join(marked, ""), PASSAGE)

    def parts(passage: Column) -> Column:
        level = F.substring_index(passage, CONTENT, 1).cast("bigint")
        body = F.substring_index(passage, CONTENT, -1)
        sentences = F.split(F.translate(body, BREAK, " "), SENTENCE_ENDS)
        whole = F.when(F.contains(body, F.lit(BREAK)), sentences).otherwise(F.array().cast("array<string>"))
        each = F.concat(F.split(body, BREAK), whole)
        return F.transform(each, lambda u: F.struct(level.alias("level"), normalised(u).alias("unit")))

    found = F.flatten(F.transform(F.filter(passages, lambda p: p != ""), parts))
    return F.filter(found, lambda u: u["unit"] != "")


def latest_before(rows: DataFrame, keys: list[str], order: str, value: str, name: str) -> DataFrame:
    """``rows`` with the last non-null ``value`` of rows of the same keys and a smaller ``order``.

    Slices of ``SLICE_TURNS`` orders are windows of their own; the last value of each slice is
    carried to the next by a window over one row per slice, so a key with a third of all rows is
    not one task's work. Rows of equal order do not see each other.
    """
    sliced = rows.withColumn("__slice", F.floor(F.col(order) / SLICE_TURNS))
    inside = W.partitionBy(*keys, "__slice").orderBy(order).rangeBetween(W.unboundedPreceding, -1)
    last = F.max_by(value, F.when(F.col(value).isNotNull(), F.col(order)))
    ends = sliced.groupBy(*keys, "__slice").agg(last.alias("__last"))
    before = W.partitionBy(*keys).orderBy("__slice").rowsBetween(W.unboundedPreceding, -1)
    carried = ends.select(*keys, "__slice", F.last("__last", ignorenulls=True).over(before).alias("__carried"))
    found = sliced.withColumn("__own", F.last(value, ignorenulls=True).over(inside))
    same = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in [*keys, "__slice"]]
    joined = found.alias("l").join(carried.alias("r"), same, "left")
    return joined.select("l.*", F.coalesce("l.__own", "r.__carried").alias(name)).drop("__slice", "__own")


def turns_before(turns: DataFrame) -> DataFrame:
    """Distinct (c, t) with ``previous``, the turn before, and ``first``, the first of the conversation.

    Cut into slices like ``latest_before``.
    """
    sliced = turns.withColumn("__slice", F.floor(F.col("t") / SLICE_TURNS))
    inside = W.partitionBy("c", "__slice").orderBy("t")
    ends = sliced.groupBy("c", "__slice").agg(F.max("t").alias("__last"), F.min("t").alias("__least"))
    upto = W.partitionBy("c").orderBy("__slice")
    carried = ends.select(
        "c", "__slice", F.lag("__last").over(upto).alias("__carried"), F.min("__least").over(upto).alias("first")
    )
    found = sliced.withColumn("__own", F.lag("t").over(inside))
    joined = found.join(carried, ["c", "__slice"])
    return joined.select("c", "t", F.coalesce("__own", "__carried").alias("previous"), "first")


def branches(turns: DataFrame, replies: DataFrame) -> DataFrame | None:
    """(c, t, thread, branch) of the conversations in which a message replies to another one than that before it.

    ``thread`` is the turn that a tree of replies begins with, ``branch`` the one that a branch begins with.
    None if there is no such conversation. ``turns`` has previous and first, ``replies`` quoted_turn.
    """
    known = turns.join(replies.select("c", "t", "quoted_turn"), ["c", "t"], "left")
    jump = F.col("quoted_turn") != F.col("previous")
    jumps = written(known.where(jump).select("c", "t", F.col("quoted_turn").alias("parent")), "jumps")
    if jumps.isEmpty():
        return None
    concerned = turns.join(jumps.select("c").distinct(), "c", "left_semi")
    marked = concerned.join(jumps.select("c", "t", F.lit(True).alias("jumps")), ["c", "t"], "left")
    opens = marked.withColumn("opens", F.when(F.col("jumps") | F.col("previous").isNull(), F.col("t")))
    placed = latest_before(opens, ["c"], "t", "opens", "before")
    placed = written(placed.select("c", "t", "previous", "jumps", F.coalesce("opens", "before").alias("segment")), "segments")
    # a message that the next one answers has its first reply already; else the earliest jump to it is that
    answered = placed.where("jumps IS NULL AND previous IS NOT NULL").select("c", F.col("previous").alias("parent"), F.lit(True).alias("answered"))
    earliest = jumps.groupBy("c", "parent").agg(F.min("t").alias("earliest"))
    stands = placed.select("c", F.col("t").alias("parent"), F.col("segment").alias("above"))
    links = jumps.join(earliest, ["c", "parent"]).join(stands, ["c", "parent"]).join(answered, ["c", "parent"], "left")
    goes_on = F.col("answered").isNull() & (F.col("t") == F.col("earliest"))
    # per segment: a segment above it in its tree, and in its branch
    nodes = links.select("c", F.col("t").alias("segment"), F.col("above").alias("thread"), F.when(goes_on, F.col("above")).otherwise(F.col("t")).alias("branch"))
    nodes = written(nodes, "branches")
    while True:
        up_thread = nodes.select("c", F.col("segment").alias("thread"), F.col("thread").alias("__thread"))
        up_branch = nodes.select("c", F.col("segment").alias("branch"), F.col("branch").alias("__branch"))
        moved = nodes.join(up_thread, ["c", "thread"], "left").join(up_branch, ["c", "branch"], "left")
        changed = (F.col("__thread") != F.col("thread")) | (F.col("__branch") != F.col("branch"))
        moved = moved.select(
            "c", "segment", F.coalesce("__thread", "thread").alias("thread"), F.coalesce("__branch", "branch").alias("branch"),
            F.coalesce(changed, F.lit(False)).alias("changed"),
        )
        moved = written(moved, "branches")
        nodes = moved.drop("changed")
        if moved.where("changed").isEmpty():
            break
    return placed.join(nodes, ["c", "segment"], "left").select(
        "c", "t", F.coalesce("thread", "segment").alias("thread"), F.coalesce("branch", "segment").alias("branch")
    )


def format_chats(
    messages: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """Per message: conversation, turn, role, ``reply_to`` (a turn), ``thread``, ``branch``, quote counts, texts.

    In order of (conversation, branch, turn) the rows are conversations in reply order: each
    message stands behind the one it replies to, with no other branch between. ``thread`` is the turn that a
    tree of replies begins with, ``branch`` the turn that its branch begins with.
    ``n_quoted`` lines are quoted at any level, ``quote_depth`` is the deepest level, ``n_linked`` quoted
    lines and sentences, of all levels, were found in an earlier message. ``own_text`` is the text without
    quoted lines, ``formatted`` puts the role before it. Null texts count as empty, a null role as
    user. Messages of one turn do not reply to each other; a null turn or conversation replies to
    nothing, is replied to by nothing and has no thread. Repeated rows pass through, each linked alike. Blank
    lines are not linked. An empty table gives an empty table; other columns are not read.
    """
    m = messages.select(
        F.col(conversation).alias("c"), F.col(turn).cast("bigint").alias("t"), F.col(role).alias("r"),
        F.coalesce(F.col(text), F.lit("")).alias("x"),
    )
    lines = F.split("x", "\n")
    levels = F.transform(lines, quote_level)
    own = F.array_join(F.filter(lines, lambda line: quote_level(line) == 0), "\n")
    parsed = m.select(
        "c", "t", "r",
        F.trim(own).alias("own_text"),
        F.size(F.filter(levels, lambda n: n > 0)).cast("bigint").alias("n_quoted"),
        F.array_max(levels).cast("bigint").alias("quote_depth"),
    )

    placed = m.where("c IS NOT NULL AND t IS NOT NULL")

    def exploded(rows: DataFrame) -> DataFrame:
        each = rows.select("c", "t", F.explode(units("x")).alias("u"))
        return each.select("c", "t", "u.level", F.xxhash64("u.unit").alias("h"))

    # messages of one turn share their quotes: counts per (conversation, turn, level, unit) come first
    quotes = exploded(placed.where(F.contains("x", F.lit(">")))).where("level > 0")
    quotes = written(quotes.groupBy("c", "t", "level", "h").agg(F.count(F.lit(1)).alias("n")), "quotes")
    # only conversations that quote anything are searched for originals
    heard = placed.join(quotes.select("c").distinct(), "c", "left_semi")
    said = exploded(heard).where("level = 0").select("c", "t", "h")
    originals = said.join(quotes.select("c", "h").distinct(), ["c", "h"], "left_semi").distinct()
    nothing = F.lit(None).cast("bigint")
    sides = originals.select("c", "t", "h", F.col("t").alias("origin"), nothing.alias("level"), nothing.alias("n"))
    sides = sides.unionByName(quotes.withColumn("origin", nothing))
    linked = latest_before(sides, ["c", "h"], "t", "origin", "source").where("n IS NOT NULL AND source IS NOT NULL")
    per_source = linked.groupBy("c", "t", "level", "source").agg(F.sum("n").alias("n"))
    # the outermost linked level decides
    order = F.struct((-F.col("level")).alias("level"), "n", "source")
    replies = per_source.groupBy("c", "t").agg(F.max_by("source", order).alias("quoted_turn"), F.sum("n").alias("n_linked"))
    replies = written(replies, "replies")
    turns = turns_before(placed.select("c", "t").distinct())
    known = turns.join(replies, ["c", "t"], "left")
    branched = branches(turns, replies)
    if branched is None:
        known = known.withColumns({"thread": F.col("first"), "branch": F.col("first")})
    else:
        known = known.join(branched, ["c", "t"], "left").withColumns(
            {n: F.coalesce(n, F.col("first")) for n in ("thread", "branch")}
        )
    speaker = F.coalesce("r", F.lit("user"))
    return parsed.join(known, ["c", "t"], "left").select(
        F.col("c").alias(conversation),
        F.col("t").alias(turn),
        F.col("r").alias(role),
        F.coalesce("quoted_turn", "previous").alias("reply_to"),
        "thread",
        "branch",
        "n_quoted",
        "quote_depth",
        F.coalesce("n_linked", F.lit(0).cast("bigint")).alias("n_linked"),
        "own_text",
        F.concat(F.lit("<|"), speaker, F.lit("|>\n"), F.col("own_text"), F.lit("\n")).alias("formatted"),
    )
