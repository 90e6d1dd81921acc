"""Line runs that repeat in a corpus, by prefix doubling over line ids; later copies are deleted.

Everything here is DataFrame functions; no Python runs on the executors.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.operators.groups import free, stored, storing

# Anything but \x20 and \x09-\x0D is part of a word.
WORD = r"[^\x20\x09-\x0D]"
ROW, ORDER = "_ld_row", "_ld_order"
NAME = ["name", "check"]


def has_word(line: Column) -> Column:
    return line.rlike(WORD)


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with a row number, stored, so that a repeated task finds the same numbers."""
    return stored(docs.withColumn(ROW, F.monotonically_increasing_id()))


def line_ids(rows: DataFrame, text: str, order: list[str], min_words: int) -> DataFrame:
    """A row per line with a word: place in the corpus, 96-bit id, and whether it has ``min_words`` words."""
    lines = F.filter(F.split(F.coalesce(F.col(text), F.lit("")), "\n"), has_word)
    place = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)], F.col(ROW).alias("row"))
    return rows.select(ROW, place.alias(ORDER), F.posexplode(lines).alias("pos", "line")).select(
        ROW,
        ORDER,
        F.col("pos").cast("long").alias("pos"),
        F.xxhash64("line").alias("name"),
        F.hash("line").alias("check"),
        (F.regexp_count("line", F.lit(WORD + "+")) >= min_words).alias("long"),
    )


def shared(suffixes: DataFrame) -> DataFrame:
    """The suffixes whose name occurs more than once, each with the first place of that name.

    Names are counted before they are shuffled, and the names that repeat are stored: a frequent
    name is then one row of one side of a join, whose other side Spark can split.
    """
    place = F.struct(ORDER, "pos")
    names = suffixes.groupBy(*NAME).agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
    repeated = stored(names.filter(F.col("n") > 1).drop("n"))
    return stored(suffixes.join(repeated, NAME))


def doubled(suffixes: DataFrame, lines: int) -> DataFrame:
    """Names of twice the lines: of a suffix and of the suffix so many lines on, if it is shared too."""
    ahead = Window.partitionBy(ROW).orderBy("pos").rangeBetween(lines, lines)
    both = suffixes.withColumns({"name2": F.first("name").over(ahead), "check2": F.first("check").over(ahead)})
    pair = [*NAME, "name2", "check2"]
    return both.filter(F.col("name2").isNotNull()).select(
        ROW, ORDER, "pos", F.xxhash64(*pair).alias("name"), F.hash(*pair).alias("check"), "long"
    )


def rounds_of_names(lines: DataFrame) -> list[tuple[int, DataFrame]]:
    """For 1, 2, 4, ... lines: the suffixes whose name for so many lines occurs more than once.

    A suffix whose name occurs once drops out, so the rounds end with the longest repeat.
    """
    rounds, size = [], 1
    current = shared(lines)
    while not current.isEmpty():
        rounds.append((size, current))
        current = shared(doubled(current, size))
        size *= 2
    free(current)
    return rounds


def bounded(rounds: list[tuple[int, DataFrame]]) -> DataFrame:
    """The suffixes that begin with a line seen earlier, with bounds of how many such lines follow; stored.

    ``size`` is the highest round in which an earlier suffix has the same name, ``first`` the first
    such suffix. Neighbours of one size whose firsts are neighbours too have a whole stretch in
    common with one place, so ``length`` lines at least. A suffix n lines on that has m lines at
    most leaves n + m here, a suffix without any n: ``open`` are those where the least and the
    most that their row allows still differ.
    """
    later = (F.col("first.pos") != F.col("pos")) | (F.col(f"first.{ORDER}.row") != F.col(ROW))
    found = [
        names.filter(later).select(ROW, "pos", F.struct(F.lit(size).cast("long").alias("size"), "first", "long", ORDER, *NAME).alias("e"))
        for size, names in rounds
    ]
    best = reduce(DataFrame.unionAll, found).groupBy(ROW, "pos").agg(F.max("e").alias("e")).select(ROW, "pos", "e.*")
    back = Window.partitionBy(ROW).orderBy(F.col("pos").desc())
    so_far = back.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    adjacent = F.coalesce(F.lag("pos").over(back) == F.col("pos") + 1, F.lit(False))
    joined = (
        adjacent
        & (F.lag("size").over(back) == F.col("size"))
        & (F.lag(f"first.{ORDER}.row").over(back) == F.col(f"first.{ORDER}.row"))
        & (F.lag("first.pos").over(back) == F.col("first.pos") + 1)
    )
    best = best.withColumns({"joined": joined, "most": F.col("pos") + F.when(adjacent, 2 * F.col("size") - 1).otherwise(1)})
    last = F.last(F.when(~F.col("joined"), F.col("pos")), ignorenulls=True).over(so_far)
    best = best.withColumns({"length": last - F.col("pos") + F.col("size"), "most": F.min("most").over(so_far)}).drop("joined")
    ahead = Window.partitionBy(ROW).orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    least = F.max(F.col("pos") + F.col("length")).over(ahead)
    return stored(best.withColumn("open", least < F.col("most")).drop("most"))


def refined(rounds: list[tuple[int, DataFrame]], best: DataFrame) -> DataFrame:
    """Exact lengths (row, pos, length, first) of the suffixes in ``best`` that share a name with an open one.

    The intervals of suffixes with a common prefix are walked down from the highest round. An
    interval holds its first suffix and, of every narrower interval below it that has been split
    off, the first one; all others went on into the narrower ones. A suffix that is not the first
    with its next 2^k lines in its interval goes on behind them, the first one stays, and goes along
    as the place to compare with. So each suffix is in one interval, beside one first suffix for
    each, and it ends where its lines occurred earlier for the last time.
    """
    interval = ["size", *NAME]
    heads = stored(best.filter("open").groupBy(*interval).agg(F.min("first").alias("first")))
    state = [ROW, ORDER, "pos", *interval, "length", "first", "guest"]
    length = F.col("size").alias("length")
    members = best.join(heads.select(*interval), interval, "left_semi").select(
        ROW, ORDER, "pos", *interval, length, "first", F.lit(False).alias("guest")
    )
    guests = heads.select(
        F.col(f"first.{ORDER}.row").alias(ROW), F.col(f"first.{ORDER}").alias(ORDER), F.col("first.pos").alias("pos"),
        *interval, length, "first", F.lit(True).alias("guest"),
    )
    items = stored(members.unionByName(guests))
    for size, names in reversed(rounds[:-1]):
        lines = F.lit(size).cast("long")
        step = names.select(ROW, F.col("pos").alias("at"), F.col("name").alias("name2"), F.col("check").alias("check2"))
        ready = items.filter(F.col("size") > lines).withColumn("at", F.col("pos") + F.col("length"))
        ready = stored(ready.join(step, [ROW, "at"], "left").drop("at"))
        narrower = [*interval, "length", "name2", "check2"]
        split = ready.filter(F.col("name2").isNotNull()).groupBy(*narrower)
        split = split.agg(F.min(F.struct(ORDER, "pos")).alias("first2"), F.count(F.lit(1)).alias("n"))
        split = stored(split.filter(F.col("n") > 1).drop("n"))
        goes = F.col("first2").isNotNull() & ((F.col("first2.pos") != F.col("pos")) | (F.col(f"first2.{ORDER}.row") != F.col(ROW)))
        pair = [*NAME, "name2", "check2"]
        behind = {"name": F.xxhash64(*pair), "check": F.hash(*pair), "length": F.col("length") + lines, "first": F.col("first2")}
        met = ready.join(split, narrower, "left").withColumn("goes", F.coalesce(goes, F.lit(False)))
        met = met.withColumns({c: F.when(F.col("goes"), new).otherwise(F.col(c)) for c, new in behind.items()})
        along = split.select(
            F.col(f"first2.{ORDER}.row").alias(ROW), F.col(f"first2.{ORDER}").alias(ORDER), F.col("first2.pos").alias("pos"),
            "size", *[new.alias(c) for c, new in behind.items()], F.lit(True).alias("guest"),
        )
        before = items
        items = stored(
            items.filter(F.col("size") <= lines).unionByName(met.select(*state)).unionByName(along.select(*state))
        )
        free(before, ready, split)
    return items.filter(~F.col("guest")).select(ROW, "pos", F.col("length").alias("exact"), F.col("first").alias("exact_first"))


def earlier_lengths(lines: DataFrame) -> DataFrame:
    """row, pos, n_lines, from_row, from_start, long: of each suffix how many of its first lines occurred earlier.

    Only suffixes of which at least one did. Runs that lie inside the run of a suffix before them
    may be given too short; all others are exact, and so is the longest that holds a line.
    """
    rounds = rounds_of_names(lines)
    if not rounds:
        return lines.select(
            ROW, "pos", F.lit(0).cast("long").alias("n_lines"), F.col(ROW).alias("from_row"), F.col("pos").alias("from_start"), "long"
        ).filter("false")
    best = bounded(rounds)
    if not best.filter("open").isEmpty():
        best = best.join(refined(rounds, best), [ROW, "pos"], "left")
        best = best.withColumns({"length": F.coalesce("exact", "length"), "first": F.coalesce("exact_first", "first")})
    return best.select(
        ROW, "pos", F.col("length").alias("n_lines"), F.col(f"first.{ORDER}.row").alias("from_row"),
        F.col("first.pos").alias("from_start"), "long",
    )


def not_inside(runs: DataFrame) -> DataFrame:
    """Runs (row, start, n_lines) that lie in no run before them; ``reach`` is where the runs before end."""
    before = Window.partitionBy(ROW).orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    ends = runs.withColumn("end", F.col("start") + F.col("n_lines"))
    return ends.withColumn("reach", F.coalesce(F.max("end").over(before), F.lit(0))).filter(F.col("end") > F.col("reach"))


def repeated_runs(lines: DataFrame) -> DataFrame:
    """Maximal runs of lines that occurred earlier: row, start, n_lines, the earlier row and start, long.

    No run lies inside another one; ``long`` tells that its first line has enough words.
    """
    return not_inside(earlier_lengths(lines).withColumnRenamed("pos", "start")).drop("end", "reach")


def disjoint(runs: DataFrame) -> DataFrame:
    """Per row, the lines that its runs cover: sorted (gap, length) pairs; and its longest run."""
    # What a run covers beyond the runs before it; a gap is what none of them covers.
    piece = F.struct(
        "start", "end", F.greatest(F.col("start") - F.col("reach"), F.lit(0)).cast("int").alias("gap"),
        (F.col("end") - F.greatest("start", "reach")).cast("int").alias("length"),
    )
    return not_inside(runs).groupBy(ROW).agg(
        F.sort_array(F.collect_list(piece)).alias("_ld_pieces"), F.max("n_lines").alias("_ld_longest")
    )


def dedup_lines(
    docs: DataFrame, text: str = "text", order: tuple[str, ...] = ("doc_id",), min_lines: int = 2, min_words: int = 8
) -> DataFrame:
    """``docs`` with later copies of repeated lines taken out of ``text``.

    A line goes if it lies in a run of at least ``min_lines`` lines, or is itself a line of at
    least ``min_words`` words, that occurred earlier: in a row before it by ``order`` (NULL first,
    rows that tie in any fixed order) or higher up in its own text. Lines end at \\n and are
    compared as they are. Lines without a word stay and don't interrupt a run. Added are n_lines
    (lines with a word), n_deleted and longest_run (lines of the longest such run, 0 for none).
    NULL texts stay NULL with no lines; an empty table gives an empty one; other columns are kept,
    those named like an added one are replaced. One document's lines meet in one task.
    """
    rows = numbered(docs)
    with storing() as scope:
        lines = stored(line_ids(rows, text, list(order), min_words))
        runs = earlier_lengths(lines).withColumnRenamed("pos", "start")
        alone = F.when(F.col("long"), 1)
        runs = runs.select(ROW, "start", F.when(F.col("n_lines") >= min_lines, F.col("n_lines")).otherwise(alone).alias("n_lines"))
        covered = scope.keep(stored(disjoint(runs.filter(F.col("n_lines").isNotNull()))))
    all_lines = F.split(F.coalesce(F.col(text), F.lit("")), "\n")
    numbers = F.sequence(F.lit(0), F.size("_ld_lines") - 1)
    worded = F.filter(numbers, lambda i: has_word(F.col("_ld_lines")[i]))
    flags = F.flatten(
        F.transform(
            "_ld_pieces", lambda r: F.concat(F.array_repeat(F.lit(False), r["gap"]), F.array_repeat(F.lit(True), r["length"]))
        )
    )
    marked = F.zip_with(worded, flags, lambda i, gone: F.when(gone, i))
    gone = F.array_compact(marked)
    left = F.array_except(numbers, F.col("_ld_gone"))
    # Rows that lose nothing stay where they are; covered rows grow with the input and are always
    # merged by key, at every size.
    listed = in_row_map(covered)
    cut = rows.filter(listed).join(covered.hint("merge"), ROW, "left")
    nothing = [F.lit(None).cast(covered.schema[c].dataType).alias(c) for c in ("_ld_pieces", "_ld_longest")]
    whole = rows.filter(~listed).select(*rows.columns, *nothing)
    made = (
        cut.unionByName(whole)
        .withColumn("_ld_lines", all_lines)
        .withColumn("_ld_gone", F.when(F.col("_ld_pieces").isNotNull(), gone))
        .withColumn("n_lines", F.size(worded).cast("long"))
    )
    rest = F.array_join(F.transform(left, lambda i: F.col("_ld_lines")[i]), "\n")
    return (
        made.withColumn(text, F.when(F.col("_ld_gone").isNotNull(), rest).otherwise(F.col(text)))
        .withColumn("n_deleted", F.coalesce(F.size("_ld_gone"), F.lit(0)).cast("long"))
        .withColumn("longest_run", F.coalesce("_ld_longest", F.lit(0)).cast("long"))
        .drop(ROW, "_ld_pieces", "_ld_longest", "_ld_lines", "_ld_gone")
    )


# Bits of the map of rows for each row that is in it, and the most it may have.
ROW_BITS, MOST_BITS = 8, 1 << 25


def in_row_map(covered: DataFrame) -> Column:
    """Whether a row may be covered: true for all that are, and for few others while the map has room.

    A map of at most 4 MB of bits, put together by Spark and asked for by a scalar subquery.
    """
    words = 1 << max(10, (ROW_BITS * covered.count()).bit_length())
    words = min(words, MOST_BITS) // 64
    bit = F.pmod(F.xxhash64(ROW), F.lit(64 * words))
    marks = covered.select(bit.alias("bit")).groupBy(F.floor(F.col("bit") / 64).cast("long").alias("id"))
    marks = marks.agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 AS int))")).alias("bits"))
    dense = covered.sparkSession.range(words).join(marks, "id", "left").select("id", F.coalesce("bits", F.lit(0)).alias("bits"))
    table = stored(dense.agg(F.sort_array(F.collect_list(F.struct("id", "bits")))["bits"].alias("map"))).scalar()
    held = F.element_at(table, (F.floor(bit / 64) + 1).cast("int"))
    return F.getbit(held, F.pmod(bit, F.lit(64)).cast("int")) == 1


def dedup_sql(table: str, min_words: int = 8) -> str:
    """The same for runs of two lines or more, as DuckDB SQL over a table with unique doc_id."""
    word = r"[^\x20\x09-\x0D]"
    return f"""
    with lines as (
      select doc_id, unnest(range(len(parts))) as no, unnest(parts) as line
      from (select doc_id, string_split(coalesce(text, ''), chr(10)) as parts from {table})
    ), worded as (
      select doc_id, no, line, row_number() over (partition by doc_id order by no) as pos,
        len(regexp_extract_all(line, '{word}+')) as words
      from lines where regexp_matches(line, '{word}')
    ), pairs as (
      select *, lead(line) over (partition by doc_id order by pos) as after from worded
    ), seen as (
      select *, row_number() over (partition by line order by doc_id, pos) > 1 and words >= {min_words} as alone,
        after is not null and row_number() over (partition by line, after order by doc_id, pos) > 1 as pair
      from pairs
    ), gone as (
      select doc_id, no from (
        select doc_id, no, alone or pair or coalesce(lag(pair) over (partition by doc_id order by pos), false) as dead
        from seen) where dead
    )
    select d.doc_id, case when d.text is null then null else coalesce(k.text, '') end as text,
      coalesce(w.n, 0)::bigint as n_lines, coalesce(g.n, 0)::bigint as n_deleted
    from {table} d
    left join (select doc_id, string_agg(line, chr(10) order by no) as text from lines
      where (doc_id, no) not in (select (doc_id, no) from gone) group by doc_id) k using (doc_id)
    left join (select doc_id, count(*) as n from worded group by doc_id) w using (doc_id)
    left join (select doc_id, count(*) as n from gone group by doc_id) g using (doc_id)"""
