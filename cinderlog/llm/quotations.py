"""Chat formatting by quotation linking, in DataFrame operations.

Lines of a message are parsed into quote levels; lines of one level that follow one another
are a passage. Normalised passages and lines of quotes are hashed and joined to the lines and
passages that messages of the same conversation wrote themselves. What a message quotes at
its outermost level makes it a reply; replies form trees, and a conversation is its trees one
after the other, every message after the one it answers, without the quoted text.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinderlog.operators.ranking import positions
from cinderlog.session import write_table

MARKS = r"^(?:[ \t]*>)+"
# A line that announces a quote: dropped where a quoted line follows.
ANNOUNCES = r"(?i)^(on\b.{0,200}\bwrote:|am\b.{0,200}\bschrieb.{0,100}:|le\b.{0,200}\bécrit ?:|el\b.{0,200}\bescribió:)\s*$"


def normal(text):
    """Letters and digits of a text, lower-cased, words apart by one space."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def parse(messages: DataFrame) -> DataFrame:
    """One row per line: conv_id, turn, message, line, level (0: own text), body."""
    lines = messages.select("conv_id", "turn", "message", F.posexplode(F.split("text", "\n")).alias("line", "raw"))
    marks = F.regexp_extract("raw", MARKS, 0)
    return lines.select(
        "conv_id", "turn", "message", "line",
        (F.length(marks) - F.length(F.replace(marks, F.lit(">"), F.lit("")))).alias("level"),
        F.trim(F.regexp_replace("raw", MARKS, "")).alias("body"),
    )


def _messages(conversations: DataFrame) -> DataFrame:
    turn = F.col("turn").cast("long")
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), turn.alias("turn"),
        F.col("role").cast("string").alias("role"), F.coalesce(F.col("text"), F.lit("")).alias("text"),
    ).where("conv_id is not null and turn is not null").distinct().withColumn(
        "message", F.sha2(F.concat_ws("\x00", "conv_id", "turn", F.coalesce("role", F.lit("\x01")), "text"), 256)
    )


def _passages(lines: DataFrame) -> DataFrame:
    """Runs of lines of one level, and every line by itself: (conv_id, turn, message, level, body)."""
    # One message is one bounded group: its own lines, in order.
    of_message = lines.groupBy("conv_id", "turn", "message").agg(
        F.sort_array(F.collect_list(F.struct("line", "level", "body"))).alias("all"))
    whole = "array<struct<level:int,body:string>>"

    def step(runs, x):
        last = F.try_element_at(runs, F.lit(-1))
        same = F.coalesce(last["level"] == x["level"], F.lit(False))
        more = F.struct(x["level"].alias("level"), F.concat_ws(" ", last["body"], x["body"]).alias("body"))
        alone = F.struct(x["level"].alias("level"), x["body"].alias("body"))
        return F.when(same, F.concat(F.slice(runs, 1, F.size(runs) - 1), F.array(more))).otherwise(
            F.concat(runs, F.array(alone)))

    runs = F.aggregate("all", F.array().cast(whole), step)
    singles = F.transform("all", lambda x: F.struct(x["level"].alias("level"), x["body"].alias("body")))
    return of_message.select(
        "conv_id", "turn", "message", F.explode(F.concat(runs, singles)).alias("p")
    ).select("conv_id", "turn", "message", "p.level", normal(F.col("p.body")).alias("body")).where("body <> ''").select(
        "conv_id", "turn", "message", "level", F.length("body").alias("size"), F.sha2("body", 256).alias("hash"))


def links(lines: DataFrame) -> DataFrame:
    """Quoting messages and what they answer: (message, parent, parent_turn, linked).

    A passage comes from the earliest message of the conversation that has it as own text;
    it links if that is an earlier turn. Of several origins a message answers the one whose
    text it quotes at the outermost level, then the one it quotes most of, then the latest."""
    passages = write_table(_passages(lines), "passages")
    # One row per distinct passage of a conversation, however many messages repeat it.
    origins = passages.where("level = 0").groupBy("conv_id", "hash").agg(
        F.min(F.struct("turn", "message")).alias("origin"))
    quotes = passages.where("level > 0").groupBy("conv_id", "turn", "message", "hash").agg(
        F.min("level").alias("level"), F.max("size").alias("size"))
    found = quotes.join(origins, ["conv_id", "hash"]).where("origin.turn < turn")
    weighed = found.groupBy("conv_id", "message", "origin").agg(
        F.min("level").alias("level"), F.sum("size").alias("size"), F.count("*").alias("linked"))
    best = F.struct(-F.col("level"), "size", "origin.turn", "origin.message")
    return weighed.groupBy("message").agg(
        F.max_by("origin", best).alias("origin"), F.sum("linked").alias("linked")
    ).select("message", F.col("origin.message").alias("parent"), "linked")


def _roots(nodes: DataFrame) -> DataFrame:
    """message, root, root_turn, depth from message, turn, parent: every step doubles the reach
    of all pointers, so a chain of n replies takes log n steps."""
    state = write_table(nodes.select(
        "message", F.coalesce("parent", "message").alias("up"), F.col("parent").isNotNull().cast("int").alias("depth")
    ), "threads")
    while True:
        above = state.select(F.col("message").alias("up"), F.col("up").alias("up2"), F.col("depth").alias("more"))
        state = write_table(state.join(above, "up").select(
            "message", F.col("up2").alias("up"), (F.col("depth") + F.col("more")).alias("depth"),
            (F.col("up") != F.col("up2")).alias("moved"),
        ), "threads")
        if state.where("moved").isEmpty():
            break
        state = state.drop("moved")
    roots = nodes.select(F.col("message").alias("up"), F.col("turn").alias("root_turn"))
    return state.drop("moved").join(roots, "up").select("message", F.col("up").alias("root"), "root_turn", "depth")


def thread(conversations: DataFrame) -> DataFrame:
    """Conversations in reply order: conv_id, position (from 1), turn, role, reply_to (turn
    answered; null if none), depth in its tree, quoted (quoted lines), linked (passages and
    lines of them with an origin), body (own text without quotes and announcements of quotes).

    Trees stand in order of their first turn, messages of a tree in order of turn, so each
    comes after the one it answers. Equal rows are one message; several messages of a turn are
    in order of a hash of their contents. Rows without conv_id or turn belong to no conversation
    and are left out. A null text is an empty body; a null role stays null. Other columns are
    not read."""
    messages = write_table(_messages(conversations), "messages")
    lines = write_table(parse(messages), "lines")
    nodes = write_table(
        messages.select("conv_id", "turn", "message").join(links(lines), "message", "left"), "replies")
    threads = _roots(nodes)
    next_level = F.expr("lead(level) over (partition by conv_id, message order by line)")
    own = lines.withColumn("next", next_level).withColumn(
        "kept", (F.col("level") == 0) & ~(F.col("body").rlike(ANNOUNCES) & (F.coalesce("next", F.lit(0)) > 0)))
    bodies = own.groupBy("message").agg(
        F.trim(F.array_join(F.transform(F.sort_array(F.collect_list(
            F.when(F.col("kept"), F.struct("line", "body")))), lambda x: x["body"]), "\n"), F.lit(" \n")).alias("body"),
        F.count_if(F.col("level") > 0).alias("quoted"),
    )
    answered = messages.select(F.col("message").alias("parent"), F.col("turn").alias("reply_to"))
    rows = nodes.join(threads, "message").join(bodies, "message").join(
        messages.select("message", "role"), "message").join(answered, "parent", "left")
    order = ["root_turn", "root", "turn", "message"]
    placed = positions(rows.select(
        "conv_id", *order, "role", "reply_to", "depth", "quoted",
        F.coalesce("linked", F.lit(0)).alias("linked"), "body"), order, ["conv_id"])
    return placed.select("conv_id", "position", "turn", "role", "reply_to", "depth", "quoted", "linked", "body")
