"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A paragraph is a sentence of a line. A sentence beyond SENTENCE characters is cut where the hash of
neighbouring words says so, and what is still long (text without spaces) where that of neighbouring
characters does: cuts depend on the text around them only, so an edit changes the paragraphs it meets.

The set of a document's paragraph digests is sketched in cells of (count, xor of digests, xor of
check hashes). There is a table of cells for each of HASHES hashes, and a digest is in one cell of
each. Tables have a power of two of cells, by the text's number of digests; a larger sketch folds
into a smaller one by the remainder of its cells' places. Cells of two versions subtract, which
cancels what they share. Peeling takes the digests out of cells that hold just one, table by table,
until all cells are zero: then the digests by which the versions differ are recovered.

``near_edited`` and ``near_next`` subtract the cells of the two fingerprints in the size of the smaller
one. Where that doesn't peel, the difference of sketches in tables for all digests of both texts
counts, then of tables twice as large, as long as there are failures. The likeness is the share of common
digests among all. Everything is built-in functions: digests are exploded into rows, cells are
aggregates of them, and peeling is a chain of aggregates on one exchange by document.

Defined results: a null text counts as empty; two documents without paragraphs are alike (1.0);
documents with equal ids follow each other by a hash of their texts, null ids come last; rows that
repeat id and text take one place in that order and each get its result; a single document is
followed by itself; other columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyweek.llm.shared import landed, landed_observed

#: Sentences beyond SENTENCE characters are cut into chunks of WORDS words on average.
SENTENCE, WORDS = 200, 8
HASHES = 3
#: Digests for a cell of a table on average, and the least cells of a table.
LOAD, LEAST = 2, 4
#: Tables that are peeled in an attempt, in turn; what needs more is tried in larger tables.
STEPS = 12
#: Digests of all versions held by a task, some 250 MB of cells.
TASK_DIGESTS = 500_000


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def runs(rows: Column, starts: Callable[[Column, Column], Column], use: Callable[[Column], Column]) -> Column:
    """``use`` of each run of the rows; a run starts at place i (from 1) where ``starts(rows, i)``."""
    def cut(r: Column) -> Column:
        places = F.filter(F.sequence(F.lit(1), F.size(r)), lambda i: (i == 1) | starts(r, i))
        return bound(places, lambda at: F.transform(at, lambda i, j: use(F.slice(r, i, F.coalesce(F.get(at, j + 1), F.size(r) + 1) - i))))

    return bound(rows, lambda r: F.when(F.size(r) > 0, cut(r)).otherwise(F.array()))


def chunks(text: Column, between: str, window: int, mean: int) -> Column:
    """The text cut after units whose hash, with that of the units before, is one in ``mean``."""
    def starts(units: Column, i: Column) -> Column:
        near = [F.coalesce(F.get(units, i - 2 - k), F.lit("")) for k in range(window)]
        return F.pmod(F.xxhash64(*near), F.lit(mean)) == 0

    return runs(F.split(text, between), starts, lambda units: F.array_join(units, between))


def digests(text: Column) -> Column:
    """The different hashes of the text's paragraphs that aren't empty."""
    def short(sentence: Column) -> Column:
        by_words = F.transform(
            chunks(sentence, " ", 2, WORDS), lambda c: F.when(F.length(c) > 2 * SENTENCE, chunks(c, "", 4, 64)).otherwise(F.array(c))
        )
        return F.when(F.length(sentence) > SENTENCE, F.flatten(by_words)).otherwise(F.array(sentence))

    # One split of the whole text: a pattern inside a lambda would be compiled for every line.
    sentences = F.filter(F.split(text, "\n|(?<=[.!?]) "), lambda p: p != "")
    return F.array_distinct(F.transform(F.flatten(F.transform(sentences, short)), lambda p: F.xxhash64(p)))


def table_size(n: Column) -> Column:
    """The least power of two that gives a cell of a table at most LOAD of n digests on average."""
    least = F.greatest(F.lit(LEAST), F.ceil(n / LOAD))
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), F.length(F.bin(2 * least - 1)) - 1)


def check(key: Column) -> Column:
    return F.xxhash64(key, F.lit("check"))


def cell_of(key: Column, j: int, per_table: Column) -> Column:
    """The digest's cell in table j: table and place in one number."""
    return F.pmod(F.xxhash64(key, F.lit(j)), per_table) * HASHES + j


def _summed(rows: DataFrame) -> DataFrame:
    """The cells that aren't zero. Rows are partitioned by the key alone, so there is no exchange."""
    cells = rows.groupBy("key", "v", "per_table", "cell").agg(F.sum("c").alias("c"), F.bit_xor("k").alias("k"), F.bit_xor("h").alias("h"))
    return cells.where("c != 0 OR k != 0 OR h != 0")


def sketch(sets: DataFrame) -> DataFrame:
    """Rows (key, v, per_table, cell, c, k, h) of sets (key, v, per_table, plus, minus) of digests: the
    cells of the sketch of ``plus`` less those of ``minus``."""
    sides = F.array(*[F.struct(F.lit(sign).cast("bigint").alias("c"), F.col(name).alias("found")) for sign, name in ((1, "plus"), (-1, "minus"))])
    members = sets.select("key", "v", "per_table", F.inline(sides)).select("key", "v", "per_table", "c", F.explode("found").alias("k"))
    cells = F.array(*[cell_of(F.col("k"), j, F.col("per_table")) for j in range(HASHES)])
    return _summed(members.select("key", "v", "per_table", F.explode(cells).alias("cell"), "c", "k", check(F.col("k")).alias("h")))


#: The number of a row that counts the digests taken out of a sketch.
TALLY = -1


def peeled(cells: DataFrame) -> DataFrame:
    """Rows (key, v, n, left): the digests taken out of each sketch, and the cells left. Sketches
    without cells have no row."""
    for step in range(STEPS):
        own = step % HASHES  # within one table no digest is in two cells, so none is taken twice
        row = lambda cell, c, k, h: F.struct(cell.cast("bigint").alias("cell"), c.alias("c"), k.alias("k"), h.alias("h"))
        c, k, h, zero = F.col("c"), F.col("k"), F.col("h"), F.lit(0).cast("bigint")
        pure = (F.col("cell") % HASHES == own) & (F.abs(c) == 1) & (h == check(k))
        others = [row(cell_of(k, j, F.col("per_table")), -c, k, h) for j in range(HASHES) if j != own]
        taken = F.array(row(F.lit(TALLY), F.lit(1).cast("bigint"), zero, zero), *others)
        kept = F.array(row(F.col("cell"), c, k, h))
        cells = _summed(cells.select("key", "v", "per_table", F.inline(F.when(pure, taken).otherwise(kept))))
    tally = F.col("cell") == TALLY
    return cells.groupBy("key", "v").agg(
        F.coalesce(F.sum(F.when(tally, F.col("c"))), F.lit(0)).alias("n"), F.count(F.when(~tally, 1)).alias("left")
    )


def printed(found: DataFrame, tasks: int) -> DataFrame:
    """Rows (key, fingerprint, edited_fingerprint): the sketches of own and changed digests as text:
    the numbers of digests and of cells per table, then each cell that isn't zero as cell.count.sums,
    where sums is base64 of both xors, eight bytes each."""
    none = F.array().cast("array<bigint>")
    sides = [F.struct(F.lit(v).alias("v"), table_size(F.size(name)).alias("per_table"), F.col(name).alias("plus"), none.alias("minus")) for v, name in enumerate(("own", "changed"))]
    dealt = found.select("key", "own", "changed").repartition(tasks, "key")
    cells = sketch(dealt.select("key", F.inline(F.array(*sides))))
    sums = F.base64(F.unhex(F.concat(F.lpad(F.hex("k"), 16, "0"), F.lpad(F.hex("h"), 16, "0"))))
    text = F.concat_ws(".", F.col("cell").cast("string"), F.col("c").cast("string"), F.rtrim(sums, F.lit("=")))
    cells = cells.select("key", "v", F.struct("cell", text.alias("text")).alias("one"))
    lists = cells.groupBy("key").agg(*[F.array_sort(F.collect_list(F.when(F.col("v") == v, F.col("one")))).alias(f"cells_{v}") for v in (0, 1)])
    return lists.select("key", *[F.array_join(F.transform(f"cells_{v}", lambda x: x["text"]), ",").alias(name) for v, name in enumerate(("fingerprint", "edited_fingerprint"))])


def _compared(found: DataFrame, attempts: list[int]) -> DataFrame:
    """Sets to be subtracted, own digests against changed (pair 0) and other ones (pair 1): in the
    smaller fingerprint's size at attempt 0, then in one for all digests, doubled from attempt to attempt.
    v is twice the attempt plus the pair."""
    own, sides = F.col("own"), []
    for attempt in attempts:
        for pair, name in enumerate(("changed", "other")):
            both = table_size(F.size(own) + F.size(name))
            size = both * 2 ** (attempt - 1) if attempt else F.least(table_size(F.size(own)), table_size(F.size(name)))
            sides.append(F.struct(F.lit(2 * attempt + pair).alias("v"), size.cast("bigint").alias("per_table"), own.alias("plus"), F.col(name).alias("minus")))
    return found.select("key", F.inline(F.array(*sides)))


def differences(found: DataFrame, tasks: int) -> DataFrame:
    """Rows (key, apart_0, apart_1): the number of digests by which own and changed, and own and other
    ones differ. Pairs without a row don't differ."""
    done, attempts, todo = [], [0, 1], found.select("key", "own", "changed", "other")
    while True:
        result = peeled(sketch(_compared(todo.repartition(tasks, "key"), attempts)))
        pair = F.col("v") % 2
        tried = result.groupBy("key").agg(*[
            c for p in (0, 1) for c in (
                F.min(F.when((pair == p) & (F.col("left") == 0), F.struct("v", "n")))["n"].alias(f"apart_{p}"),
                F.coalesce(F.max(pair == p), F.lit(False)).alias(f"seen_{p}"),
            )
        ])
        failed = " OR ".join(f"(seen_{p} AND apart_{p} IS NULL)" for p in (0, 1))
        tried, counts = landed_observed(tried.withColumn("failed", F.expr(failed)), "sketch-peeled", failures=F.count(F.when(F.col("failed"), 1)))
        done.append(tried.where("NOT failed").select("key", "apart_0", "apart_1"))
        if not counts["failures"]:
            break
        # Both pairs of a document are tried again: what has peeled does so in larger tables as a rule.
        digests_left = F.sum(F.size("own") + F.size("changed") + F.size("other"))
        todo, counts = landed_observed(todo.join(tried.where("failed").select("key"), "key"), "sketch-retry", digests=digests_left)
        attempts, tasks = [attempts[-1] + 1], -(-counts["digests"] // TASK_DIGESTS)
    out = done[0]
    for more in done[1:]:
        out = out.union(more)
    return out


def following(rows: DataFrame) -> DataFrame:
    """Rows (key, id, copies, after, half): the key that follows in descending id, the first after
    the last.

    Rows are range-sorted; within a sorted partition a window finds the next row, and only the
    first row of each partition takes part in a window over all partitions.
    """
    order = [F.col("id").desc_nulls_last(), F.col("key").asc()]
    half = F.floor(F.col("n_chars") / 2).cast("int").alias("half")
    dealt = rows.select("key", "id", half).groupBy("key", "id", "half").agg(F.count(F.lit(1)).alias("copies")).repartitionByRange(*order)
    dealt = landed(dealt.withColumn("block", F.spark_partition_id()), "id-order")
    inside = Window.partitionBy("block").orderBy(*order)
    placed = dealt.withColumn("after", F.lead("key").over(inside)).withColumn("first", F.row_number().over(inside) == 1)
    heads = placed.where("first").select("block", F.col("key").alias("head"))
    blocks = Window.orderBy("block")  # a row per partition
    whole = blocks.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = heads.select("block", F.coalesce(F.lead("head").over(blocks), F.first("head").over(whole)).alias("next_head"))
    joined = placed.join(heads, "block")
    return joined.select("key", "id", "copies", F.coalesce("after", "next_head").alias("after"), "half")


def versions(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Each different document with its edited text's digests, its own, and the next text's.

    The key stands for id and text. Texts are exchanged once by it: the copy that is edited and the
    copy that follows another document come from the same exchange.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    named = F.concat_ws("/", F.coalesce(F.col("id").cast("string"), F.lit("none")), F.md5(F.col("text").cast("binary")))
    rows = rows.withColumn("key", F.unhex(F.md5(named.cast("binary"))))
    after = following(rows.withColumn("n_chars", F.length("text"))).withColumnRenamed("key", "of")
    texts = rows.groupBy("key").agg(F.first("text").alias("text"))
    starts = texts.join(after, texts.key == after.after)
    starts = starts.select("of", "id", "copies", F.col("text").substr(F.lit(1), F.col("half")).alias("start"), digests(F.col("text")).alias("other"), "half")
    both = texts.join(starts, texts.key == starts.of)
    n = F.length("text")
    edited = F.concat(F.col("text").substr(F.lit(1), n - F.col("half")), F.col("start"))
    both = both.select("key", "id", "copies", n.cast("bigint").alias("n_chars"), digests(F.col("text")).alias("own"), "other", edited.alias("edited"))
    both = both.select("key", "id", "copies", "n_chars", "own", "other", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), digests(F.col("edited")).alias("changed"))
    return both


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)."""
    all_digests = F.sum(F.size("own") + F.size("changed") + F.size("other"))
    found, counts = landed_observed(versions(docs, id_col, text_col), "sketch-digests", digests=all_digests)
    tasks = -(-(counts["digests"] or 1) // TASK_DIGESTS)
    own, changed, other = F.size("own"), F.size("changed"), F.size("other")
    heads = found.select("key", "id", "copies", "n_chars", "edited_sha256", own.alias("own"), changed.alias("changed"), other.alias("other"))
    rows = heads.join(printed(found, tasks), "key", "left").join(differences(found, tasks), "key", "left")

    def shown(n: str, cells: str) -> Column:
        return F.concat_ws("-", F.col(n).cast("string"), table_size(F.col(n)).cast("string"), F.coalesce(F.col(cells), F.lit(""))).alias(cells)

    def near(n: str, apart: str) -> Column:
        total, away = F.col("own") + F.col(n), F.coalesce(F.col(apart), F.lit(0))
        return F.when(total == 0, 1.0).otherwise((total - away) / (total + away))

    rows = rows.select(
        "id", "n_chars", "edited_sha256", shown("own", "fingerprint"), shown("changed", "edited_fingerprint"),
        near("changed", "apart_0").alias("near_edited"), near("other", "apart_1").alias("near_next"),
        F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"),
    )
    return rows.drop("copy")
