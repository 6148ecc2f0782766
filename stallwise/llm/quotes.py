"""Chat formatting: quotation linking.

Lines that begin with ``>`` are quotes; the number of marks is the level, own lines have level 0. A run of lines of one level is
a passage. Its text is normalised across its line breaks (marks taken off, lower case, blanks collapsed) and hashed sentence
by sentence, so a quote that was wrapped anew, spans several lines or leaves sentences out still has the hashes of the
original; every line is hashed as well, for quotes of lines that end within a sentence. Each hash of a quote is joined to the
latest earlier message of the conversation that has it in a passage of its own. A message replies to the message that most
of its quoted hashes come from, looked for at the outermost level that finds any; of equals to the latest. Conversations
are then ordered by thread, each reply after what it replies to, and quotes are left out.

Scale. All is joins and windows over lines and sentences. The look-up is an as-of join cut into ranges, so a sentence that is
in every message of a conversation with a third of all rows is no hot group, and no pairs are formed. Threads follow by
pointer jumping in as many rounds as the depth has binary digits. Places come from running counts over ranges.

Defined cases. A null text is a message without lines; blank lines and bare marks quote nothing. Quotes that no earlier
message explains are dropped like others, as are parts of a sentence that are no line of the original. Messages that share
conversation and turn are told apart by a number given in order of role and text; equal rows stay equal rows. Texts of any
length are read whole, a message in one row. Null conversations form one conversation, null turns come first. Other columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallwise.llm.asof import latest_earlier
from stallwise.operators.prefix import running_sums
from stallwise.session import durable

MARKS = r"^((?:[ ]?>)+)[ ]?"
# They separate passages and their levels while a message is one text; such characters of the text itself are taken out.
NEXT, LEVEL = "\x01", "\x02"


def level(line: Column) -> Column:
    return F.length(F.regexp_replace(F.regexp_extract(line, MARKS, 1), "[^>]", ""))


def content(line: Column) -> Column:
    return F.regexp_replace(line, MARKS, "")


def normalised(line: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(line, r"[ \t\r\x0B\f]+", " ")))


def numbered(messages: DataFrame) -> DataFrame:
    """conv, turn, role, lines and a unique ``message`` that follows conversation, turn, role and text, stored."""
    rows = messages.select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"),
        F.col("text").cast("string").alias("text"), F.monotonically_increasing_id().alias("_row"),
    )
    order = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), F.xxhash64("text").asc(), F.col("_row").asc()]
    ranked = running_sums(rows, [], order, {"message": F.lit(1).cast("bigint")})
    return durable(ranked.select("conv", "turn", "role", "message", F.split("text", "\n").alias("lines")))


def passages(lines: Column) -> Column:
    """Passages of a message as ``level LEVEL text``: its lines, each led in by a blank or by the mark of a new passage."""
    def piece(line: Column, at: Column) -> Column:
        before = F.try_element_at(lines, F.when(at > 0, at).otherwise(1))
        same = (at > 0) & (level(line) == level(before))
        return F.concat(F.when(same, F.lit(" ")).otherwise(F.concat(F.lit(NEXT), level(line).cast("string"), F.lit(LEVEL))), F.translate(content(line), NEXT + LEVEL, ""))

    return F.split(F.array_join(F.transform(lines, piece), ""), NEXT)


def sentences(text: Column) -> Column:
    return F.split(F.regexp_replace(text, "([.!?]) ", f"$1{NEXT}"), NEXT)


def quoted_parts(messages: DataFrame) -> DataFrame:
    """conv, message, level (0: own) and hash of every line and of every sentence of every passage that says something."""
    lines = messages.select("conv", "message", F.explode("lines").alias("line"))
    single = lines.select("conv", "message", level(F.col("line")).alias("level"), normalised(content(F.col("line"))).alias("said"))
    runs = messages.select("conv", "message", F.explode(passages(F.col("lines"))).alias("run")).where(F.col("run") != "")
    whole = F.substring_index("run", LEVEL, -1)
    told = runs.select("conv", "message", F.substring_index("run", LEVEL, 1).cast("int").alias("level"), F.explode(sentences(normalised(whole))).alias("said"))
    parts = single.unionByName(told).where("said <> ''")
    return parts.select("conv", "message", "level", F.md5(F.col("said").cast("binary")).alias("hash"))


def parents(messages: DataFrame) -> DataFrame:
    """message, parent of every message whose quotes lead to an earlier one."""
    lines = quoted_parts(messages).groupBy("conv", "message", "level", "hash").agg(F.count("*").alias("times"))
    keyed = lines.withColumn("key", F.md5(F.concat_ws("/", F.coalesce(F.col("conv").cast("string"), F.lit("none")), "hash").cast("binary")))
    # own lines come after the quotes of their message: a message does not quote itself
    rows = keyed.select("key", "message", "level", "times", (F.col("level") == 0).alias("own"))
    looked_up = latest_earlier(rows, "key", ["message", "own", "level"], F.col("own"), ["message"], "source")
    found = looked_up.where(~F.col("own") & F.col("source").isNotNull()).withColumn("parent", F.col("source")["message"])
    votes = found.groupBy("message", "level", "parent").agg(F.sum("times").alias("votes"))
    return votes.groupBy("message").agg(F.max_by("parent", F.struct(-F.col("level"), "votes", "parent")).alias("parent"))


def threads(messages: DataFrame, replies: DataFrame) -> DataFrame:
    """message, parent, root, depth of every message.

    A message points at one above it and how far that is; in each round it takes over the pointer found there, so distances
    double. A message whose pointer has arrived at the first of its thread takes no part in later rounds, so these shrink.
    """
    told = messages.select("message").join(replies, "message", "left").withColumn("final", F.col("parent").isNull())
    state = durable(told.select("message", "parent", F.coalesce("parent", "message").alias("root"), (~F.col("final")).cast("int").alias("depth"), "final"))
    settled, active = state.where("final"), state.where("not final")
    while not active.isEmpty():
        up = settled.unionByName(active).select(F.col("message").alias("at"), F.col("root").alias("above"), F.col("depth").alias("more"), F.col("final").alias("arrived"))
        step = durable(active.join(up, F.col("root") == F.col("at")).select(
            "message", "parent", F.col("above").alias("root"), (F.col("depth") + F.col("more")).alias("depth"), F.col("arrived").alias("final")))
        settled, active = settled.unionByName(step.where("final")), step.where("not final")
    return settled.drop("final")


def linked(messages: DataFrame) -> DataFrame:
    """conv_id, place (from 0 in the conversation), turn, role, parent_turn, root_turn, depth, body of every message."""
    told = numbered(messages)
    placed = threads(told, parents(told)).join(told.select("message", "conv", "turn", "role"), "message")
    ordered = running_sums(placed, ["conv"], [F.col("root").asc(), F.col("message").asc()], {"place": F.lit(1).cast("bigint")})
    turns = told.select(F.col("message").alias("_message"), F.col("turn").alias("_turn"))
    with_root = ordered.join(turns.withColumnsRenamed({"_message": "_root", "_turn": "root_turn"}), F.col("root") == F.col("_root"))
    with_parent = with_root.join(turns.withColumnsRenamed({"_message": "_parent", "_turn": "parent_turn"}), F.col("parent") == F.col("_parent"), "left")
    own = F.array_join(F.filter("lines", lambda x: level(x) == 0), "\n")
    bodies = told.select(F.col("message").alias("_own"), F.when(F.col("lines").isNotNull(), own).alias("body"))
    return with_parent.join(bodies, F.col("message") == F.col("_own")).select(
        F.col("conv").alias("conv_id"), "place", "turn", "role", "parent_turn", "root_turn", F.col("depth").cast("int").alias("depth"), "body"
    )
