"""Log template mining, independent of how the lines are partitioned.

A line's shape is its masked content with every digit-bearing token hidden; there are
about as many shapes as log statements, however many lines. Lines of one shape share a
template. Shapes are counted with partial aggregation, similar shapes of a leaf (same
token count and leading tokens) get one template, and the result is joined back to the lines.

Which shapes are similar follows from their set alone, not from counts or order: a group of them
is one template if enough positions hold the same word throughout; otherwise it is split by the
position with the fewest words, which tells statements rather than values apart. All large groups
are split at once, from counts of words per group and position, so a leaf of any size is spread
over the tasks like everything else; groups of bounded size are split inside a task.

A digit-bearing token that never varies within its shape belongs to the template. Between
the two scans of the lines it is known by its hash only, as a token "#<hash>" in a pattern:
the aggregation then has fixed-width buffers and hashes instead of sorting, and each line
holds the token's text anyway. Shapes have no digits, so any digit marks such a token.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinderlog import constants as K
from cinderlog.functions.text import hide_digit_tokens, mask, squeeze
from cinderlog.operators.splitting import split_groups
from cinderlog.session import write_table

# Characters of a group's patterns up to which one task splits the group to the end.
SMALL_GROUP = 1_000_000


def with_shape(lines: DataFrame, masks=K.MASKS) -> DataFrame:
    """Adds masked (the masked content) and shape."""
    masked = squeeze(mask(F.coalesce("content", F.lit("")), masks))
    return lines.withColumn("masked", masked).withColumn("shape", hide_digit_tokens(F.col("masked")))


def skeletons(shaped: DataFrame) -> DataFrame:
    """Per shape: n_lines, first_line and skeleton, the shape with "#<hash>" in place of
    those digit-bearing tokens that are the same in all of its lines. One aggregation:
    each line gives an entry per such token, and entry -1 for the line itself."""
    tokens = F.transform(
        F.split("masked", " "), lambda t, i: F.struct(i.alias("pos"), t.alias("token"))
    )
    shown = F.filter(tokens, lambda e: e["token"].rlike(r"\d"))
    line = F.array(F.struct(F.lit(-1).alias("pos"), F.lit("").alias("token")))
    entries = shaped.select("shape", "line_id", F.inline(F.concat(line, shown))).withColumn(
        "token", F.xxhash64("token")
    )
    per_position = entries.groupBy("shape", "pos").agg(
        F.count("*").alias("n"),
        F.min("line_id").alias("first_line"),
        F.min("token").alias("low"),
        F.max("token").alias("high"),
    )
    fixed = (F.col("pos") >= 0) & (F.col("low") == F.col("high"))
    per_shape = per_position.groupBy("shape").agg(
        F.max("n").alias("n_lines"),
        F.min("first_line").alias("first_line"),
        F.map_from_entries(F.collect_list(F.when(fixed, F.struct("pos", "low")))).alias("_fixed"),
    )
    restored = F.transform(
        F.split("shape", " "),
        lambda t, i: F.coalesce(F.concat(F.lit("#"), F.col("_fixed")[i].cast("string")), t),
    )
    return per_shape.withColumn("skeleton", F.array_join(restored, " ")).drop("_fixed")


def leaf_key(pattern: Column, depth=K.MINING_DEPTH) -> Column:
    """Token count and the first depth - 2 tokens, digit-bearing ones hidden."""
    tokens = F.split(pattern, " ")
    lead = F.array_join(F.slice(tokens, 1, max(depth - 2, 1)), " ")
    return F.concat(F.size(tokens).cast("string"), F.lit(" "), hide_digit_tokens(lead))


def _position_words(members: DataFrame) -> DataFrame:
    """Per group and position: how many words its patterns have there, and one of them."""
    words = members.select("group", F.posexplode(F.split("pattern", " ")).alias("pos", "word"))
    # Words are made distinct first: counting them per group keeps no set in a buffer.
    return words.groupBy("group", "pos", "word").agg(F.lit(1).alias("one")).groupBy("group", "pos").agg(
        F.count("*").alias("words"), F.min("word").alias("word"))


def _group_state(members: DataFrame, similarity: float) -> DataFrame:
    """Per group: template (the words shared by all its patterns, wildcards between), is_one
    (enough positions are shared), and the position to split at otherwise."""
    shared = F.col("words") == 1
    state = _position_words(members).groupBy("group").agg(
        F.count("*").alias("width"),
        F.count_if(shared & (F.col("word") != K.WILDCARD)).alias("fixed"),
        F.min(F.when(~shared, F.struct("words", "pos"))).alias("cut"),
        F.sort_array(F.collect_list(F.struct(
            "pos", F.when(shared, F.col("word")).otherwise(F.lit(K.WILDCARD)).alias("word")))).alias("slots"),
    )
    return state.select(
        "group", F.array_join("slots.word", " ").alias("template"), F.col("cut.pos").alias("cut"),
        (F.col("cut").isNull() | (F.col("fixed") >= similarity * F.col("width"))).alias("is_one"))


def merge_similar(patterns: DataFrame, depth=K.MINING_DEPTH, similarity=K.MINING_SIMILARITY) -> DataFrame:
    """Adds template to distinct patterns; their other columns pass through.

    A leaf starts as one group. A group whose patterns agree in at least similarity of their
    positions, wildcards not counted, becomes the template of the words they agree in; any other
    one is split by its words at the position that has the fewest (ties: the leftmost). Every
    split fixes a position. Groups of more than SMALL_GROUP characters are spread over the tasks
    and split once a round; smaller ones are dealt out whole, and split to the end where they are.
    So rounds end when no large group is left, not when the last few patterns are told apart.
    """
    members = write_table(patterns.withColumn("group", leaf_key(F.col("pattern"), depth)), "patterns")
    columns = [*patterns.columns, "template"]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in patterns.schema.fields)
    finish, closed = split_groups(similarity, K.WILDCARD), None
    while True:
        sizes = members.groupBy("group").agg(F.sum(F.length("pattern") + 1).alias("size"))
        large = write_table(sizes.where(F.col("size") > SMALL_GROUP).select("group"), "large_groups")
        small = members.join(large, "group", "left_anti").repartition("group").sortWithinPartitions("group")
        done = small.mapInPandas(finish, f"{kinds}, template string").select(*columns)
        closed = done if closed is None else closed.unionByName(done)
        if large.isEmpty():
            return closed
        open_ = members.join(large, "group", "left_semi")
        placed = open_.join(write_table(_group_state(open_, similarity), "groups"), "group")
        closed = closed.unionByName(placed.where("is_one").select(*columns))
        word = F.get(F.split("pattern", " "), F.col("cut"))
        inner = F.md5(F.concat_ws(" ", "group", "cut", word))
        members = write_table(placed.where("not is_one").withColumn("group", inner).select(*patterns.columns, "group"), "members")


def mine_templates(shaped: DataFrame, depth=K.MINING_DEPTH, similarity=K.MINING_SIMILARITY) -> DataFrame:
    """Catalogue: shape, pattern, n_lines, first_line."""
    found = write_table(skeletons(shaped), "skeletons")
    patterns = found.select(F.col("skeleton").alias("pattern")).distinct()
    mapping = merge_similar(patterns, depth, similarity)
    catalogue = found.join(mapping, found["skeleton"] == mapping["pattern"]).select(
        "shape", F.col("template").alias("pattern"), "n_lines", "first_line"
    )
    return write_table(catalogue, "catalogue")


def _values(token: Column, slot: Column) -> Column:
    """The texts behind the wildcards of one template token."""
    pieces = F.split(slot, r"<\*>")
    before, after = F.get(pieces, F.lit(0)), F.get(pieces, F.lit(1))
    inner = F.substring(
        token, F.length(before) + 1, F.length(token) - F.length(before) - F.length(after)
    )
    return (
        F.when(slot == K.WILDCARD, F.array(token))
        .when(~slot.contains(K.WILDCARD), F.array().cast("array<string>"))
        .when(F.size(pieces) == 2, F.array(inner))
        .otherwise(_by_pattern(token, slot))
    )


def open_positions(slots: Column) -> Column:
    """Positions of the template tokens that hold, or may hold, a wildcard."""
    numbered = F.transform(slots, lambda t, i: F.struct(t.alias("t"), i.alias("i")))
    wild = F.filter(numbered, lambda e: e["t"].contains(K.WILDCARD) | e["t"].startswith("#"))
    return F.transform(wild, lambda e: e["i"])


def parameters(raw: Column, slots: Column, positions=None) -> Column:
    """The texts behind the template's wildcards, in order, from the content's and the
    template's tokens. Both have the same tokens, so values are cut out token by token;
    only a token with several wildcards, or a mask that swallowed blanks, needs a pattern."""
    positions = open_positions(slots) if positions is None else positions
    found = F.flatten(F.transform(positions, lambda i: _values(F.get(raw, i), F.get(slots, i))))
    return F.when(F.size(raw) == F.size(slots), found).otherwise(
        _by_pattern(F.array_join(raw, " "), F.array_join(slots, " "))
    )


def _by_pattern(text: Column, template: Column) -> Column:
    pieces = F.transform(
        F.split(template, r"<\*>"), lambda p: F.concat(F.lit(r"\Q"), p, F.lit(r"\E"))
    )
    pattern = F.concat(F.lit("^"), F.array_join(pieces, "(.*?)"), F.lit("$"))
    groups = F.size(pieces) - 1
    return F.when(groups < 1, F.array().cast("array<string>")).otherwise(
        F.transform(
            F.sequence(F.lit(1), F.greatest(groups, F.lit(1))),
            lambda i: F.call_function("regexp_extract", text, pattern, i),
        )
    )


def event_key(template: Column) -> Column:
    return F.left(F.md5(template), F.lit(8))


def assign_templates(shaped: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Adds event_template, event_id (the head of its md5) and parameters to lines.

    The catalogue is a stored table, so Catalyst broadcasts it when its measured size
    allows; otherwise it shuffles both sides and AQE splits the partition of a heavy
    shape. What depends on the pattern alone is computed on the catalogue's side.
    """
    pattern, slots = F.col("pattern"), F.split("pattern", " ")
    known = catalogue.select(
        "shape", "pattern", slots.alias("_tokens"), open_positions(slots).alias("_open"),
        event_key(pattern).alias("_id"), pattern.rlike("[0-9]").alias("_fixed"),
    )
    own = F.zip_with(
        "_tokens", F.split("masked", " "), lambda p, t: F.when(p.startswith("#"), t).otherwise(p)
    )
    raw = F.split(F.trim(F.coalesce("content", F.lit(""))), r"\s+")
    found = shaped.join(known, "shape", "left").withColumns(
        {"_slots": F.when(F.col("_fixed"), own).otherwise(F.col("_tokens")), "_raw": raw}
    )
    template = F.when(F.col("_fixed"), F.array_join("_slots", " ")).otherwise(pattern)
    named = found.withColumn("event_template", template)
    return named.withColumns(
        {
            "event_id": F.when(F.col("_fixed"), event_key(F.col("event_template"))).otherwise(F.col("_id")),
            "parameters": parameters(F.col("_raw"), F.col("_slots"), F.col("_open")),
        }
    ).drop("shape", "masked", "pattern", "_tokens", "_open", "_id", "_fixed", "_slots", "_raw")


def template_table(structured: DataFrame) -> DataFrame:
    """The templates of structured lines with their line count and first line."""
    return structured.groupBy("event_id", "event_template").agg(
        F.count("*").alias("n_lines"), F.min("line_id").alias("first_line")
    )


def template_counts(structured: DataFrame, k=None) -> DataFrame:
    """Lines per template, most frequent first; the top k if given."""
    counts = structured.groupBy("event_id", "event_template").agg(F.count("*").alias("event_count"))
    ranked = counts.orderBy(F.desc("event_count"), "event_id")
    return ranked if k is None else ranked.limit(k)


def content_skeletons(texts: DataFrame, column: str, masks=K.MASKS) -> DataFrame:
    """Distinct masked contents with their counts."""
    return texts.groupBy(mask(F.col(column), masks).alias("skeleton")).agg(
        F.count("*").alias("n_lines")
    )
