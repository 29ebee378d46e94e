"""Near-duplicate lines by a deletion-neighbourhood join (DataFrame operations only).

A line is a sequence of words; an edit inserts, deletes or replaces one word
and the bound is one edit.  A line and each variant of it with one word
deleted are emitted as hashed keys.  Two lines are within the bound exactly if
one of them, whole, equals a variant of the other, or if both give the same
variant by a deletion at the same place.  So the lines that meet in a key need
no pairs: per key, and per key and place, the earliest line decides, found by
a grouped minimum.  The one witness chosen for each line is then verified by
its words.

Not all lines emit variants.  One word in a few is much of a line: below
``min_words`` words only equal lines meet, by the hash of the whole line.  One edit leaves the first or the last half of a
line as it was, so only lines that share a half with another one go on; equal
lines are one line all along.  Hashes of deletions come from running XORs over
the words, so a line costs time in proportion to its length.  The lines that go on
are numbered in the order of their first places (a range shuffle), so what meets in
a key is compared and sent as one number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crease.llm._common import partitions, saved, whole_text

_SPACE = r"[\x20\x09-\x0D]+"


def _plain(line: Column) -> Column:
    """The words of a line with one blank between them."""
    # most lines hold single blanks only: these stay as they are
    uneven = F.regexp_like(line, F.lit(r"[\x09-\x0D]|\x20\x20|^\x20|\x20$"))
    return F.when(uneven, F.array_join(F.filter(F.split(line, _SPACE, -1), lambda w: w != ""), " ")) \
        .otherwise(line)


def _plain_lines(text: Column) -> Column:
    """The plain lines of a text."""
    every = F.split(text, "\n", -1)
    # most texts hold no blank but single ones within lines: one look at the text tells
    uneven = F.startswith(text, F.lit(" ")) | F.endswith(text, F.lit(" "))
    for blank in ("\t", "\x0b", "\x0c", "\r", "  ", "\n ", " \n"):
        uneven = uneven | F.contains(text, F.lit(blank))
    return F.when(uneven, F.transform(every, _plain)).otherwise(every)


def _key(plain: Column) -> Column:
    return F.unhex(F.md5(plain.cast("binary")))


def _half_keys(plain: Column, n: Column) -> Column:
    """Hashes of the first and last words, as many as stay clear of each other in
    lines of ``n`` words and of one word more or less."""
    def both(size: Column) -> list[Column]:
        return [F.xxhash64(F.lit(side), size, F.call_function(
            "substring_index", plain, F.lit(" "), sign * size))
            for side, sign in (("first", 1), ("last", -1))]

    small, large = F.floor((n - 1) / 2).cast("int"), F.floor(n / 2).cast("int")
    # the two sizes are one where n is odd
    return F.when(n % 2 == 1, F.array(*both(large))).otherwise(F.array(*both(small), *both(large)))


def _within_one_edit(a: Column, b: Column) -> Column:
    """Whether two word sequences differ by one inserted, deleted or replaced word."""
    def same(x: Column, y: Column) -> Column:
        differ = F.array_position(F.zip_with(x, y, lambda p, q: ~p.eqNullSafe(q)), True)
        return F.when(differ > 0, differ - 1).otherwise(F.greatest(F.size(x), F.size(y)))

    longest = F.greatest(F.size(a), F.size(b))
    return (F.abs(F.size(a) - F.size(b)) <= 1) & \
        (same(a, b) + same(F.reverse(a), F.reverse(b)) >= longest - 1)


def _variants(lines: DataFrame) -> DataFrame:
    """``(variant, place, line)`` for ``lines(line, copy, words)``: the line as it is at
    place -1 and the line without its word at each place."""
    n = F.size("words")
    words = lines.select("line", "copy", n.alias("n"),
                         F.posexplode("words").alias("place", "w"))
    words = words.withColumns({"here": F.xxhash64("w", "place"),
                               "moved": F.xxhash64("w", F.col("place") - 1)})
    order = Window.partitionBy("line", "copy").orderBy("place")
    until = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    words = words.withColumns({
        "here_to": F.expr("bit_xor(here)").over(until),
        "moved_to": F.expr("bit_xor(moved)").over(until),
        "moved_all": F.expr("bit_xor(moved)").over(Window.partitionBy("line", "copy")),
        "last": F.col("place") == F.col("n") - 1})
    before = F.col("here_to").bitwiseXOR(F.col("here"))
    after = F.col("moved_all").bitwiseXOR(F.col("moved_to"))
    without = F.struct(F.xxhash64(before.bitwiseXOR(after), F.col("n") - 1).alias("variant"),
                       F.col("place"))
    whole = F.struct(F.xxhash64(F.col("here_to"), F.col("n")).alias("variant"),
                     F.lit(-1).alias("place"))
    both = F.when(F.col("last"), F.array(without, whole)).otherwise(F.array(without))
    return words.select("line", F.explode(both).alias("v")).select(
        "v.variant", "v.place", "line")


def _witnesses(variants: DataFrame) -> DataFrame:
    """``(line, witness)``: the earliest other line within the bound, if it is earlier;
    lines are numbered by their first places."""
    by_place = saved(variants.groupBy("variant", "place").agg(
        F.min("line").alias("low"), F.count(F.lit(1)).alias("n")), "by_place")
    deleted = F.col("place") >= 0
    by_key = saved(by_place.groupBy("variant").agg(
        F.min(F.when(deleted, F.col("low"))).alias("low_deleted"),
        F.min(F.when(~deleted, F.col("low"))).alias("low_whole"),
        F.sum("n").alias("n")).where("n > 1").drop("n"), "by_key")
    # keys that one line alone has are settled before anything meets again
    low = saved(by_place.select("variant", "place", F.col("low").alias("low_place"))
                .join(by_key, "variant"), "low")
    met = variants.join(low, ["variant", "place"])
    against = F.when(deleted, F.least("low_place", "low_whole")).otherwise(F.col("low_deleted"))
    return (met.select("line", against.alias("witness")).where("witness < line")
            .groupBy("line").agg(F.min("witness").alias("witness")))


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
                   min_words: int = 5) -> tuple[DataFrame, DataFrame]:
    """``(source, removed)``: the rows as ``(doc, tie, text)`` and, per text that loses
    lines, the sorted numbers of these lines (from 0)."""
    text = whole_text(text_col)
    source = docs.select(F.col(id_col).alias("doc"), F.xxhash64(text).alias("tie"),
                         text.alias("text"))
    # plain lines come out of the generator, so that no later expression makes them again
    lines = source.select("doc", "tie", F.posexplode(_plain_lines(F.col("text")))
                          .alias("line_no", "plain")).where("plain <> ''")
    blanks = F.octet_length("plain") - F.octet_length(F.replace("plain", F.lit(" "), F.lit("")))
    lines = lines.withColumn("n", blanks + 1)
    # short lines have no variants: they meet whole only
    found = saved(lines.select("doc", "tie", "line_no", _key(F.col("plain")).alias("line"), F.when(
        F.col("n") >= min_words, _half_keys(F.col("plain"), F.col("n"))).alias("halves")), "lines")
    once = saved(found.groupBy("line").agg(
        F.min(F.struct("doc", "tie", "line_no")).alias("first"),
        F.count(F.lit(1)).alias("copies"), F.min("halves").alias("halves")), "once")

    halves = once.select("line", F.explode("halves").alias("half"))
    shared = saved(halves.groupBy("half").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
                   .select("half"), "shared")
    partner = saved(halves.join(shared, "half", "left_semi").select("line").distinct(), "partner")
    near = once.join(partner, "line", "left_semi").select("line", "first")
    near = saved(near.repartitionByRange(partitions(docs.sparkSession), "first")
                 .sortWithinPartitions("first")
                 .withColumn("number", F.monotonically_increasing_id()), "near")
    # the words of the lines that go on, from their first places
    wanted = saved(near.select("first.doc", "first.tie", F.struct(
        F.col("first.line_no"), "number").alias("want")).groupBy("doc", "tie")
        .agg(F.collect_list("want").alias("wants")), "wanted")
    # merged at every size: a side that is small enough to send today grows with the corpus
    held = source.join(wanted.hint("merge"), (source["doc"].eqNullSafe(wanted["doc"]))
                       & (source["tie"] == wanted["tie"])) \
        .select(source["doc"], source["tie"], F.split("text", "\n", -1).alias("body"), "wants")
    bodies = held.select("doc", "tie", "body", F.explode("wants").alias("want")).select(
        F.col("want.number").alias("line"),
        F.split(_plain(F.col("body")[F.col("want.line_no")]), " ", -1).alias("words"))
    # rows that repeat both id and text give a line more than once, told apart by ``copy``
    bodies = saved(bodies.withColumn("copy", F.monotonically_increasing_id()), "bodies")
    variants = saved(_variants(bodies), "variants")
    pairs = saved(_witnesses(variants), "pairs")
    mine = bodies.select("line", F.col("words").alias("a"))
    other = bodies.select(F.col("line").alias("witness"), F.col("words").alias("b"))
    edited = saved(pairs.join(mine, "line").join(other, "witness")
                   .where(_within_one_edit(F.col("a"), F.col("b")))
                   .select(F.col("line").alias("number")).distinct(), "edited")
    edited = near.join(edited, "number", "left_semi").select("line")

    judged = saved(once.select("line", "first", "copies")
                   .join(edited.withColumn("edited", F.lit(True)), "line", "left")
                   .where("copies > 1 OR edited"), "judged")
    gone = found.select("doc", "tie", "line_no", "line").join(judged, "line").where(
        F.col("edited").isNotNull()
        | ~F.struct("doc", "tie", "line_no").eqNullSafe(F.col("first")))
    removed = gone.groupBy("doc", "tie").agg(
        F.sort_array(F.collect_set("line_no")).alias("removed"))
    return source, saved(removed, "removed")


def _flags(removed: Column) -> Column:
    """For sorted line numbers, whether each line up to the last one is in them."""
    def until(at: Column, j: Column) -> Column:
        before = F.coalesce(F.get(removed, j - 1), F.lit(-1))
        return F.concat(F.array_repeat(F.lit(False), at - before - 1), F.array(F.lit(True)))

    return F.flatten(F.transform(removed, until))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
               min_words: int = 5) -> DataFrame:
    """``(row, n_lines, n_removed, kept_text)`` per input row; ``row`` is a struct of
    all its columns.

    Lines are what ``\\n`` separates.  A line with a word is removed if an earlier
    line (smaller id, or earlier in the document) has the same words; of lines of ``min_words``
    words or more, also if it has them but for one edit.  A line without words always
    stays.  Lines are judged on the input, not on what is
    left.  A NULL text is one empty line.
    NULL ids come first; rows that share an id are ordered by a hash of their
    text, and rows that are the same in both are one document with one result.
    Other columns are carried along, whatever their names; an empty table gives
    an empty result.
    """
    _, removed = repeated_lines(docs, id_col, text_col, min_words=min_words)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    text = whole_text(F.col(f"row.`{text_col}`"))
    rows = rows.select("row", F.col(f"row.`{id_col}`").alias("__doc"),
                       F.xxhash64(text).alias("__tie"))
    joined = rows.join(removed.hint("merge"), rows["__doc"].eqNullSafe(removed["doc"])
                       & (rows["__tie"] == removed["tie"]), "left")
    lines = F.split(text, "\n", -1)  # after the join: the row carries its text once
    out = joined.select("row", lines.alias("__lines"), "removed",
                        _flags(F.col("removed")).alias("__gone"))
    kept = F.filter("__lines", lambda _, i: ~F.coalesce(F.get(F.col("__gone"), i), F.lit(False)))
    return out.select(
        "row", F.size("__lines").cast("bigint").alias("n_lines"),
        F.coalesce(F.size("removed"), F.lit(0)).cast("bigint").alias("n_removed"),
        F.array_join(kept, "\n").alias("kept_text"))
