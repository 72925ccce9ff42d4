"""Fuzzy line deduplication with DataFrame operations only.

Lines are normalised (lower case, runs of anything but letters and digits to one blank) and
get a SimHash of six blocks of 16 bits. Their distinct words are dealt to the blocks by
hash, and a block's bits are the majority of its own words alone. One word replaced touches
two blocks at most and leaves the others equal, whatever the length of the line; two words
touch four. Every line enters fifteen tables, one for each two blocks that hold words, so
such pairs meet. Lines of ``SMALL`` distinct words or fewer also, or under ``DEALT`` words only,
have one block a word: they enter a table for each word left out, for each two words from
``TWO_OUT`` words on, and one for none. With
``short_lines`` lines under ``MIN_WORDS`` words take part, too: up to ``SHORT`` characters they
have one block a character, so a pair one character apart meets; beyond, their runs of
``GRAM`` characters are dealt like words, so scripts without blanks are compared as well.

Lines under one key are sorted by size and each is compared with the one before it. Under
keys whose lines are still apart all members of different groups are compared, in tiles of
``TILE`` lines a side where a key is crowded. So every two lines of like size that share a key are
compared or already in one group. Pairs are verified by edit similarity. Of every connected group of equal or linked lines the first occurrence stays,
by document id, line number and a hash of the text; the others go.

Defined results: null texts stay null and empty ones empty. A document is an id and a text,
null ids included: rows equal in both count as one and keep the same lines, rows that share
only the id are documents of their own. A document whose lines all go keeps an empty text
(``drop_empty`` leaves it out). A null id comes first in the order. Lines without a letter or
digit stay.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from lendmart.llm.common import components, new_column, quoted, stored
from lendmart.operators.joins import hot_keys, spread_join

MIN_WORDS = 5
SMALL = 16
TWO_OUT = 5
DEALT = 12
SHORT = 32
GRAM = 2
MIN_SIMILARITY = 0.8
FILTER_SIZE = 1 << 20
#: Edits that are tried first, and the number that counts from which lines are long.
FEW_EDITS = 6
LONG_EDITS = 32
#: Characters of a piece of a long line, and the different pieces that characters can stand for.
PIECE = 4
PIECES = 1 << 20
#: Lines of one key that are compared in one piece.
TILE = 256
#: Words that are counted in eight 8-bit counts a long, with room for the test of the majority.
CHUNK = 63
BLOCKS = 6
#: The bits of one block in a long that interlaces four.
LANE = 0x0303030303030303
#: The pairs of blocks that make a key.
TABLES = tuple((i, j) for i in range(BLOCKS) for j in range(i + 1, BLOCKS))


def _normal(text: str) -> Column:
    """A text whose lines are normalised but for blanks at their ends."""
    # Single blanks stay as they are, which saves most of the replacing.
    return F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}\n ][^\p{L}\p{N}\n]*| [^\p{L}\p{N}\n]+", " ")


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, row, line, norm): all lines, normalised; ``row`` is a hash of the whole text,
    which tells rows of one id apart. A text is normalised once, as a whole; the
    generator's output is then a plain column that no later step computes again."""
    whole = _normal(text_col)
    return docs.select(
        F.col(id_col).alias("doc"), F.xxhash64(text_col).alias("row"),
        F.posexplode(F.split(whole, "\n")).alias("line", "raw"),
    ).select("doc", "row", "line", F.trim("raw").alias("norm"))


def _dealt(hash_: Column) -> Column:
    """A hash with the number of its block, by bits that the SimHash does not use, ahead of those
    that it does."""
    block = F.shiftrightunsigned(hash_, 2).bitwiseAND(F.lit(63)) % F.lit(BLOCKS)
    return F.shiftleft(block, 60).bitwiseOR(hash_.bitwiseAND(F.lit(LANE)))


def _count_up(block: Column, mask: int) -> Column:
    """Sum of the masked bits of a block's hashes."""
    return F.aggregate(block, F.lit(0).cast("long"), lambda have, w: have + w.bitwiseAND(F.lit(mask)))


def _block_bits(block: Column) -> Column:
    """A block's 16 bits, those that over half of its words have: 0, 1, 8, 9, ... 56, 57 of a
    long."""
    ones, half = F.lit(0x0101010101010101), F.floor(F.size(block) / 2)
    # A count and what its majority lacks to 64 add up to 64 or more, in all eight at once.
    sums = [F.shiftrightunsigned(_count_up(block, 0x0101010101010101 << t), t) + (CHUNK - half) * ones for t in range(2)]
    fast = F.lit(0).cast("long")
    for t, eight in enumerate(sums):
        fast = fast.bitwiseOR(F.shiftrightunsigned(eight.bitwiseAND(F.lit(0x4040404040404040)), 6 - t))
    places = F.array(*[F.lit(8 * k + t) for k in range(8) for t in range(2)])
    has = lambda w, at: F.call_function("shiftrightunsigned", w, at).bitwiseAND(F.lit(1)) == 1
    slow = F.aggregate(places, F.lit(0).cast("long"), lambda have, at: F.when(
        2 * F.size(F.filter(block, lambda w: has(w, at))) > F.size(block),
        have.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), at)),
    ).otherwise(have))
    return F.when(F.size(block) <= CHUNK, fast).otherwise(slow)


def _left_out_keys(lines: DataFrame) -> DataFrame:
    """(h, size, key) of lines (h, size, small) without one or two of their words, or without
    one of their characters. A key may come twice for one line."""
    nothing = F.lit(0).cast("long")
    split = lines.withColumn("words", F.split("small", " "))
    hashed = split.select("h", "size", "small", F.size("words").alias("n"), F.array_distinct(
        F.transform("words", lambda w: F.xxhash64(w))).alias("hashes"))
    words = hashed.withColumn("whole", F.aggregate("hashes", nothing, lambda have, w: have.bitwiseXOR(w))).where(
        F.size("hashes").between(3, SMALL))
    # One generator's output: the whole is computed once a line, not once a word.
    words = words.select("h", "size", "hashes", F.explode(F.array("whole")).alias("whole"))
    words = words.withColumn("less", F.transform("hashes", lambda w: w.bitwiseXOR(F.col("whole"))))
    two = F.when(F.size("hashes") >= TWO_OUT, F.flatten(F.transform("less", lambda rest, i: F.transform(
        F.slice("hashes", i + 2, SMALL), lambda v: rest.bitwiseXOR(v)
    )))).otherwise(F.array().cast("array<bigint>"))
    left = words.select("h", "size", F.explode(F.concat(F.array("whole"), "less", two)).alias("left"))
    size = F.length("small")
    chars = hashed.where((F.col("n") < MIN_WORDS) & size.between(5, SHORT)).select("h", "size", F.explode(F.array_distinct(F.concat(
        F.array("small"), F.transform(F.sequence(F.lit(1), F.greatest(size, F.lit(1))), lambda i: F.concat(
            F.left("small", i - 1), F.substring("small", i + 1, size)))))).alias("left"))
    return left.select("h", "size", F.xxhash64(F.lit(1), "left").alias("key")).unionByName(
        chars.select("h", "size", F.xxhash64(F.lit(2), "left").alias("key")))


def line_prints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", short_lines: bool = True
) -> DataFrame:
    """(doc, row, line, h, check, size, low, high, small) of every line that takes part. ``h`` names
    equal normalised lines, ``check`` is a second hash. ``low`` holds the SimHash's first four
    blocks and ``high`` the other two, null for lines without them; ``small`` is the text of
    lines that have keys by what is left out.

    Each distinct word of a line counts once, or the commonest words would decide. Counts
    stay within the row, so no word is shuffled; they are exact up to 2^31 - 1 words a line.
    """
    lines = _lines(docs, id_col, text_col).where(F.length("norm") > 0)
    # Columns that a later step uses more than once are computed once, by compiled code.
    split = lines.withColumn("words", F.split("norm", " "))
    size, few = F.length("norm"), F.size("words") < MIN_WORDS
    if not short_lines:
        split = split.where(~few)
    runs = F.transform(
        F.sequence(F.lit(1), F.greatest(size - (GRAM - 1), F.lit(1))), lambda i: F.substring("norm", i, F.lit(GRAM)))
    features = F.when(few & (size > SHORT), runs).otherwise(F.col("words"))
    hashed = split.select(
        "doc", "row", "line", "norm", few.alias("few"), size.alias("size"),
        F.array_distinct(F.transform(features, lambda w: F.xxhash64(w))).alias("hashes"),
    )
    n = F.size("hashes")
    # Sorted, a block's hashes lie between the bare numbers of this block and the next.
    numbers = F.array(*[F.lit(b << 60) for b in range(BLOCKS)])
    dealt = hashed.select(
        "doc", "row", "line", "norm", "size", (F.col("few") | (n <= SMALL)).alias("is_small"),
        F.when(
            F.when(F.col("few"), F.col("size") > SHORT).otherwise(n >= DEALT),
            F.sort_array(F.concat(numbers, F.transform("hashes", _dealt))),
        ).alias("dealt"),
    )
    start = [F.array_position("dealt", F.lit(b << 60)).cast("int") for b in range(BLOCKS)] + [F.size("dealt") + 1]
    blocks = dealt.select("doc", "row", "line", "norm", "size", "is_small", *[
        F.slice("dealt", start[b] + 1, start[b + 1] - start[b] - 1).alias(f"b{b}") for b in range(BLOCKS)
    ])
    summed = blocks.select("doc", "row", "line", "norm", "size", "is_small", *[
        F.when(F.col(f"b{b}").isNotNull(), _block_bits(F.col(f"b{b}"))).alias(f"s{b}") for b in range(BLOCKS)
    ])
    # Four blocks interlaced in a long, two in the next.
    joined = lambda first, last: reduce(lambda x, y: x.bitwiseOR(y), [
        F.shiftleft(f"s{b}", 2 * (b - first)) for b in range(first, last)
    ])
    return summed.select(
        "doc", "row", "line", F.xxhash64("norm").alias("h"), F.xxhash64(F.lit(1), "norm").alias("check"), "size",
        joined(0, 4).alias("low"), joined(4, 6).alias("high"),
        F.when(F.col("is_small"), F.col("norm")).alias("small"),
    )


def _block_keys() -> Column:
    """Keys of every two blocks, null unless both hold words."""
    block = lambda b: F.shiftrightunsigned("low" if b < 4 else "high", 2 * (b % 4)).bitwiseAND(F.lit(LANE))
    return F.array(*[
        # Tables have keys of their own by the hash of their number.
        F.when((block(i) != 0) & (block(j) != 0), F.xxhash64(F.lit(t), F.shiftleft(block(i), 2).bitwiseOR(block(j))))
        for t, (i, j) in enumerate(TABLES)
    ])


def _keyed(prints: DataFrame) -> DataFrame:
    """(key, h, size) of the different lines; two texts under one h would show in the
    second hash, and such lines are left alone."""
    dealt = prints.where("low is not null").groupBy("h").agg(
        F.min("low").alias("low"), F.min("high").alias("high"), F.min("size").alias("size"),
        F.min("check").alias("least"), F.max("check").alias("most"),
    ).where("least = most").select("h", "size", _block_keys().alias("keys")).select(
        # The outer form infers no filter that would compute the keys twice.
        "h", "size", F.explode_outer("keys").alias("key")).where("key is not null")
    small = _left_out_keys(prints.where("small is not null").select("h", "size", "small").distinct())
    return dealt.unionByName(small).select("key", "h", "size")


def _most(a: str, b: str) -> Column:
    """Edits that ``MIN_SIMILARITY`` allows two lines of the sizes ``a`` and ``b``."""
    return F.floor(F.greatest(a, b) * F.lit(1 - MIN_SIMILARITY) + F.lit(1e-9)).cast("int")


def _like_sizes(a: str, b: str) -> Column:
    return F.abs(F.col(a) - F.col(b)) <= _most(a, b)


def _similar_lines(pairs: DataFrame) -> DataFrame:
    """The rows of (a, b, text_a, text_b) with an edit similarity of ``MIN_SIMILARITY`` or more.

    The bounded distance costs its bound times the length and a walk of the length squared.
    So lines of as many words are compared word by word first: these edits suffice, though
    fewer may. The others lose the words that they begin and end with alike, which takes no
    edit; a word beside the difference stays, for its blank counts. Then a small bound is tried
    first. Long lines beyond it are compared in pieces of up to ``PIECE`` characters before the
    bound that counts is tried on the characters: such edits suffice, too, at a tenth of the work.
    """
    pairs = pairs.select("a", "b", _most(F.length("text_a"), F.length("text_b")).alias("most"), F.explode(F.array(F.struct(
        F.split("text_a", " ").alias("a"), F.split("text_b", " ").alias("b"),
    ))).alias("words"))
    one, other = F.col("words.a"), F.col("words.b")
    fewer = F.least(F.size(one), F.size(other))
    alike = lambda x, y: F.array_position(
        F.concat(F.zip_with(x, y, lambda v, w: v.eqNullSafe(w)), F.array(F.lit(False))), F.lit(False)).cast("int") - 1
    by_word = F.when(F.size(one) == F.size(other), F.aggregate(
        F.zip_with(one, other, lambda v, w: F.when(v == w, 0).otherwise(F.levenshtein(v, w))),
        F.lit(0), lambda have, edits: have + edits,
    ))
    measured = pairs.select("a", "b", "most", "words", F.explode(F.array(F.struct(
        by_word.alias("by_word"), alike(one, other).alias("head"), alike(F.reverse(one), F.reverse(other)).alias("tail"),
    ))).alias("m"))
    head = F.least(F.col("m.head"), fewer)
    tail = F.greatest(F.least(F.col("m.tail"), fewer - head) - F.when(head == 0, 1).otherwise(0), F.lit(0))
    start = F.greatest(head, F.lit(1))
    middle = lambda w: F.array_join(F.slice(w, start, F.size(w) - (start - 1) - tail), " ")
    enough = F.coalesce(F.col("m.by_word") <= F.col("most"), F.lit(False))
    left = measured.select("a", "b", "most", enough.alias("enough"), F.explode(F.array(F.when(
        ~enough, F.struct(middle(one).alias("a"), middle(other).alias("b"))))).alias("rest"))
    few = (F.lit(FEW_EDITS) < F.col("most")) & F.expr(f"levenshtein(rest.a, rest.b, {FEW_EDITS}) >= 0")
    tried = left.select("a", "b", "most", "rest", F.explode(F.array(F.col("enough") | few)).alias("enough"))
    pieces = lambda c: F.regexp_extract_all(f"rest.{c}", F.lit(f"[^ ]{{1,{PIECE - 1}}} ?| "), F.lit(0))
    cut = tried.select("a", "b", "most", "rest", "enough", F.explode(F.array(F.when(
        ~F.col("enough") & (F.col("most") > LONG_EDITS), F.struct(pieces("a").alias("a"), pieces("b").alias("b"))))).alias("cut"))
    known = F.array_distinct(F.concat("cut.a", "cut.b"))
    coded = cut.select("a", "b", "most", "rest", "enough", "cut", F.explode(F.array(known)).alias("known"))
    apart = F.size(F.array_distinct(F.transform("known", _slot))) == F.size("known")
    coded = coded.withColumn("apart", F.explode(F.array(apart)))
    # Each edit of a piece stands for at most as many as it has characters.
    by_piece = (F.size("known") < PIECES) & (F.call_function(
        "levenshtein", _symbols("cut.a"), _symbols("cut.b"), F.floor(F.col("most") / PIECE).cast("int")) >= 0)
    return coded.where(F.col("enough") | by_piece | F.expr("levenshtein(rest.a, rest.b, most) >= 0"))


def _slot(piece: Column) -> Column:
    return F.pmod(F.xxhash64(piece), F.lit(PIECES))


def _symbols(pieces: str) -> Column:
    """One character a piece: by its hash if the ``known`` have hashes ``apart``, else by its place among
    them. Past the surrogates all numbers are characters."""
    at = lambda w: F.when(F.col("apart"), _slot(w)).otherwise(F.array_position("known", w))
    return F.decode(F.unhex(F.array_join(F.transform(
        pieces, lambda w: F.lpad(F.hex(at(w) + F.lit(0xE000)), 8, "0")), "")), "UTF-32")


def _place() -> Column:
    return F.xxhash64("doc", "row", "line")


def _let_through(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows of (place, ...) whose place is wanted (place), and few others: a broadcast bit
    map of ``FILTER_SIZE`` longs at most, whatever the data, so the others stay out of shuffles
    as long as the wanted are fewer than its bits."""
    slot = F.pmod(F.shiftrightunsigned("place", 6), F.lit(FILTER_SIZE)).alias("slot")
    bit = F.col("place").bitwiseAND(F.lit(63)).cast("int")
    one = F.call_function("shiftleft", F.lit(1).cast("long"), bit)
    bits = wanted.select(slot, one.alias("bit")).groupBy("slot").agg(F.bit_or("bit").alias("bits"))
    return rows.withColumn("slot", slot).join(F.broadcast(bits), "slot").where(
        F.col("bits").bitwiseAND(one) != 0).drop("slot", "bits")


def _texts(wanted: DataFrame, prints: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(h, norm) of the wanted lines (h). Only their first occurrences are normalised again and
    dealt out, not the other lines of their documents."""
    holders = prints.join(wanted, "h", "left_semi").groupBy("h").agg(
        F.min(F.struct("doc", "row", "line")).alias("first")
    ).select("first.*").select(_place().alias("place"))
    said = docs.select(
        F.col(id_col).alias("doc"), F.xxhash64(text_col).alias("row"),
        F.posexplode(F.split(text_col, "\n")).alias("line", "raw"),
    ).select(_place().alias("place"), "raw")
    # A generator's output is a plain column that no later step computes again.
    own = _let_through(said, holders).select(F.explode(F.array(F.trim(_normal("raw")))).alias("norm"))
    return own.select(F.xxhash64("norm").alias("h"), "norm").join(wanted, "h", "left_semi").dropDuplicates(["h"])


def _verified(pairs: DataFrame, prints: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Of the stored pairs (a, b) of lines those with similar texts."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("h")).distinct()
    texts = stored(_texts(wanted, prints, docs, id_col, text_col), "lines")
    one = texts.select(F.col("h").alias("a"), F.col("norm").alias("text_a"))
    other = texts.select(F.col("h").alias("b"), F.col("norm").alias("text_b"))
    # Dealt by pair in a fixed number: few bytes, but much work a pair.
    tasks = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    both = pairs.select("a", "b").distinct().join(one, "a").join(other, "b").repartition(tasks, "a", "b")
    return _similar_lines(both).select("a", "b")


def _across(grouped: DataFrame) -> DataFrame:
    """(root_a, root_b, a, b): all pairs of like size of (key, h, size, root) that share a key
    and have different roots, each once. A key's lines are dealt to tiles, and every two tiles meet in a
    task's piece of their own, so no task takes a crowded key whole."""
    held = grouped.groupBy("key").agg(
        F.min("root").alias("lo"), F.max("root").alias("hi"), F.ceil(F.count("*") / TILE).alias("tiles")
    ).where("lo < hi").select("key", "tiles")
    dealt = grouped.join(held, "key").withColumn("tile", F.pmod(F.xxhash64("h"), F.col("tiles")))
    placed = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1))).select(
        "key", F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j"), "tile", "h", "size", "root")
    side = lambda s: placed.select("key", "i", "j", *[F.col(c).alias(f"{c}_{s}") for c in ("tile", "h", "size", "root")])
    return side("a").join(side("b"), ["key", "i", "j"]).where(
        (F.col("root_a") < F.col("root_b")) & _like_sizes("size_a", "size_b")
        & ((F.col("i") == F.col("j")) | (F.col("tile_a") != F.col("tile_b")))
    ).select("root_a", "root_b", F.least("h_a", "h_b").alias("a"), F.greatest("h_a", "h_b").alias("b")).distinct()


def line_groups(docs: DataFrame, prints: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(h, root) of the lines that are linked to a different line."""
    # Most keys have one line: they go before lines are sorted by size.
    by_key = Window.partitionBy("key")
    held = _keyed(prints).withColumn("n", F.count("*").over(by_key)).where("n > 1")
    by_size = by_key.orderBy("size", "h")
    shared = stored(held.select(
        "key", "h", "size", F.lag("h").over(by_size).alias("before"), F.lag("size").over(by_size).alias("size_before"),
        (F.col("n") > 2).alias("many"),
    ), "lines")
    chained = shared.where((F.col("before") != F.col("h")) & _like_sizes("size", "size_before")).select(
        F.least("h", "before").alias("a"), F.greatest("h", "before").alias("b")
    ).distinct()
    links = stored(_verified(stored(chained, "lines"), prints, docs, id_col, text_col), "lines")
    first = components(links, "lines")

    # Under a key of three lines and more that several groups hold, all members of different
    # groups meet.
    grouped = shared.where("many").select("key", "h", "size").join(
        first.withColumnRenamed("node", "h"), "h", "left"
    ).withColumn("root", F.coalesce("root", "h"))
    paired = _across(stored(grouped, "lines")).join(links, ["a", "b"], "left_anti")
    rest = stored(paired, "lines")
    more = _verified(rest, prints, docs, id_col, text_col)
    joined = stored(rest.join(more, ["a", "b"]).select(F.col("root_a").alias("a"), F.col("root_b").alias("b")), "lines")
    second = components(joined, "lines")
    merged = first.unionByName(
        # lines that stood alone in the first step and were linked in the second
        second.join(first, "node", "left_anti").select("node", F.col("node").alias("root"))
    )
    return merged.join(
        second.select(F.col("node").alias("root"), F.col("root").alias("last")), "root", "left"
    ).select(F.col("node").alias("h"), F.coalesce("last", "root").alias("root"))


def repeated_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", short_lines: bool = True
) -> DataFrame:
    """(doc, row, line) of every occurrence but the first of its group."""
    prints = stored(line_prints(docs, id_col, text_col, short_lines), "lines")
    groups = stored(line_groups(docs, prints, id_col, text_col), "lines")
    named = stored(prints.join(groups, "h", "left").select(
        "doc", "row", "line", F.coalesce("root", "h").alias("name"),
        F.when(F.col("root").isNull(), F.col("check")).otherwise(F.lit(0)).alias("part"),
    ), "lines")
    place = F.struct("doc", "line", "row")
    first = named.groupBy("name", "part").agg(F.count("*").alias("n"), F.min(place).alias("first")).where("n > 1")
    # One line may have very many copies; their rows are spread.
    often = hot_keys(named.select(F.xxhash64("name", "part").alias("copies")), "copies")["copies"]
    return spread_join(named, first, ["name", "part"], "inner", ["doc", "row", "line"], often).where(
        ~place.eqNullSafe(F.col("first"))
    ).select("doc", "row", "line")


def without_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    count_col: str | None = None, drop_empty: bool = False, short_lines: bool = True,
) -> DataFrame:
    """``docs`` without repeated lines, all columns; ``count_col``, a new one, adds how many
    went."""
    new_column(docs, count_col)
    # A set: equal rows name the same lines, each once.
    gone = repeated_lines(docs, id_col, text_col, short_lines).groupBy("doc", "row").agg(
        F.collect_set("line").alias("gone_lines")
    )
    gone = gone.select(F.col("doc").alias("gone_doc"), F.col("row").alias("gone_row"), "gone_lines")
    whole = docs.select(
        F.col(id_col).alias("id"), F.xxhash64(text_col).alias("own"),
        F.struct(*quoted(docs.columns)).alias("row"),
    )
    same = whole["id"].eqNullSafe(gone["gone_doc"]) & (whole["own"] == gone["gone_row"])
    # The same plan at every size: no broadcast of a small table's lists.
    joined = whole.join(gone.hint("merge"), same, "left")
    text = F.col("row")[text_col]
    # The lines are a generator's output: a plain column, split once a document.
    lines = joined.select(
        "row", "gone_lines", F.explode(F.array(F.when(F.col("gone_lines").isNotNull(), F.split(text, "\n")))).alias("lines")
    )
    # array_except looks up hashes, so the cost follows the number of lines.
    kept = lines.select("row", "gone_lines", "lines", F.explode(F.array(F.when(
        F.col("lines").isNotNull(), F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "gone_lines")
    ))).alias("kept"))
    if drop_empty:
        kept = kept.where(F.col("gone_lines").isNull() | (F.size("kept") > 0))
    text = F.when(F.col("gone_lines").isNull(), text).otherwise(
        F.array_join(F.transform("kept", lambda k: F.get("lines", k)), "\n")
    )
    columns = [(text if c == text_col else F.col("row")[c]).alias(c) for c in docs.columns]
    if count_col:
        columns.append(F.coalesce(F.size("gone_lines"), F.lit(0)).alias(count_col))
    return kept.select(*columns)
