"""Line dedup over line-ID sequences by distributed prefix doubling (operator 8).

A text is a sequence of line IDs (two hashes of the line without blanks at its
ends).  Its suffixes are sorted by prefix doubling: the rank of a suffix by its
first line is the place of the line's ID among the sorted IDs, and the rank by
the first 2^(k+1) lines is the place of the pair (rank by 2^k lines, rank by
2^k lines at the position 2^k further on) among the sorted pairs.  Ranks follow
the order of the suffixes and are equal where the prefixes are.  Only suffixes
whose prefix occurs elsewhere go on to the next level, so a rank that is absent
stands for a prefix that does not repeat.

The suffixes with a common prefix of n lines form a longest-common-prefix
interval.  Two ranks of the level 2^k <= n < 2^(k+1), at the first of the n
lines and 2^k lines before their end, name it without a search.

Deleted is every line of a maximal run of lines that has at least
``min_words`` words and occurs earlier, in another document or before itself
without overlap; of equal runs the one in the smallest (document, position)
stays.  A maximal run of that size is exactly the union of the smallest runs
with ``min_words`` words inside it: those that start at one of its lines, and
those that end at one.  These have at most ``min_words`` lines (a line counts
as one word at least), so doubling ends at the last power of two up to
``min_words``: deeper levels would order suffixes that are deleted alike.

Everything is DataFrame code.  Windows partition by document only.  Ranks and
intervals are joined to their rows by :func:`join_spread`, which deals the rows
of each hot line or run over tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from filingflow.llm.common import join_spread, work_table

_DOC = ["_ff_id", "_ff_text"]


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _along() -> WindowSpec:
    return Window.partitionBy(*_DOC).orderBy("pos")


def _keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Adds the document's identity: its key and a hash of its text."""
    return docs.withColumns({"_ff_id": F.col(key), "_ff_text": F.xxhash64(text)})


def rank_repeated(rows: DataFrame, by: list[str]) -> DataFrame:
    """``rows`` whose values of ``by`` (not null) occur twice at least, with
    their ``rank`` in place of ``by``: ranks ascend with the values, with gaps."""
    classes = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    classes = classes.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("rank", F.monotonically_increasing_id())
    return join_spread(rows, work_table(classes, "ranks"), by, "n").drop(*by)


def repeated_lines(docs: DataFrame, min_words: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(document, pos, island, words, rank) of the lines whose content occurs at
    two places at least; an island is a run of such lines, and those below
    ``min_words`` words hold nothing to delete."""
    rows = _keyed(docs.select(key, text).where(F.col(text).isNotNull()), key, text).select(*_DOC, F.posexplode(_lines(F.col(text))).alias("pos", "line"))
    words = F.greatest(F.lit(1), F.regexp_count("line", F.lit(r"[^\s]+"))).cast("long")
    content = F.trim("line")
    rows = rows.select(*_DOC, "pos", words.alias("words"), F.xxhash64(content).alias("a"), F.xxhash64(F.lit(1), content).alias("b"))
    rows = rank_repeated(rows, ["a", "b"])
    rows = rows.withColumn("before", F.lag("pos").over(_along())).where("before IS NULL OR before < pos").drop("before")  # equal rows count once
    rows = rows.withColumn("island", F.col("pos") - F.row_number().over(_along()))
    total = F.sum("words").over(Window.partitionBy(*_DOC, "island"))
    return rows.withColumn("total", total).where(F.col("total") >= min_words).drop("total")


def suffix_ranks(lines: DataFrame, depth: int) -> DataFrame:
    """(document, pos, k, rank): rank of the suffix at ``pos`` by its first 2^k
    lines, for every 2^k up to ``depth`` and every prefix that repeats."""
    level = lines.select(*_DOC, "pos", "rank")
    levels = level.withColumn("k", F.lit(0))
    for k in range(depth.bit_length() - 1):
        further = F.max("rank").over(_along().rangeBetween(1 << k, 1 << k))
        pairs = level.select(*_DOC, "pos", F.col("rank").alias("a"), further.alias("b")).where("b IS NOT NULL")
        level = work_table(rank_repeated(pairs, ["a", "b"]), "suffixes")
        levels = levels.unionByName(level.withColumn("k", F.lit(k + 1)))
    return levels


def qualifying_runs(lines: DataFrame, min_words: int) -> DataFrame:
    """Smallest runs of ``min_words`` words that start or end at a line:
    (document, start, len)."""
    block = [*_DOC, "island"]
    along = Window.partitionBy(*block).orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = lines.withColumn("ends", F.sum("words").over(along)).withColumn("begins", F.col("ends") - F.col("words"))
    ahead = Window.partitionBy(*block).orderBy("begins").rangeBetween(0, min_words - 1)
    behind = Window.partitionBy(*block).orderBy("ends").rangeBetween(-(min_words - 1), 0)
    f_end = F.when(F.max("ends").over(ahead) - F.col("begins") >= min_words, F.max("pos").over(ahead))
    b_start = F.when(F.col("ends") - F.min("begins").over(behind) >= min_words, F.min("pos").over(behind))
    rows = rows.select(*_DOC, "pos", f_end.alias("f_end"), b_start.alias("b_start"))
    both = F.expr("array(struct(pos AS start, f_end AS stop), struct(b_start AS start, pos AS stop))")
    runs = rows.select(*_DOC, F.explode(both).alias("run")).select(*_DOC, "run.start", "run.stop")
    return runs.where("start IS NOT NULL AND stop IS NOT NULL").select(*_DOC, "start", F.expr("stop - start + 1").alias("len")).distinct()


def repeated_runs(runs: DataFrame, ranks: DataFrame) -> DataFrame:
    """``runs`` with the name (``len, first, second``) of their
    longest-common-prefix interval; runs without a rank do not repeat."""

    def look_up(found: DataFrame, pos: str, name: str) -> DataFrame:
        place = ranks.select(F.col("_ff_id").alias("r_id"), F.col("_ff_text").alias("r_text"), F.col("pos").alias("r_pos"), F.col("k").alias("r_k"), F.col("rank").alias(name))
        same = F.col("_ff_id").eqNullSafe(F.col("r_id")) & (F.col("_ff_text") == F.col("r_text")) & (F.expr(pos) == F.col("r_pos")) & (F.col("k") == F.col("r_k"))
        return found.join(place, same).drop("r_id", "r_text", "r_pos", "r_k")

    runs = runs.withColumn("k", F.floor(F.log2(F.col("len") + 0.5)).cast("int"))  # 2^k <= len < 2^(k+1)
    return look_up(look_up(runs, "start", "first"), "start + len - shiftleft(1, k)", "second").drop("k")


def copied_lines(runs: DataFrame) -> DataFrame:
    """(document, pos) of every line in a run that has an earlier copy."""
    runs = work_table(runs, "runs")
    interval = ["len", "first", "second"]
    firsts = runs.groupBy(*interval).agg(F.min(F.struct(*_DOC, "start")).alias("origin"), F.count(F.lit(1)).alias("n")).where("n > 1")
    both = join_spread(runs, work_table(firsts, "intervals"), interval, "n")
    elsewhere = ~(F.col("_ff_id").eqNullSafe(F.col("origin._ff_id")) & (F.col("_ff_text") == F.col("origin._ff_text")))
    later = both.where(elsewhere | (F.col("start") - F.col("origin.start") >= F.col("len")))
    return later.select(*_DOC, F.explode(F.expr("sequence(start, start + len - 1)")).alias("pos")).distinct()


def dedup_lines(docs: DataFrame, min_words: int = 25, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the repeated line runs deleted from ``text`` and the
    columns ``n_lines``, ``n_removed`` (lines), ``n_runs`` (maximal deleted
    runs) more.

    A text without a deleted line is returned unchanged, null stays null (no
    lines); if all lines go the text is empty.  A null key comes before all
    others.  Rows with equal key and text are one document: they get the same
    result and are no copies of each other.  An empty table gives an empty
    result; input columns named like the three results are replaced."""
    docs = docs.drop("n_lines", "n_removed", "n_runs")
    min_words = max(min_words, 1)
    lines = work_table(repeated_lines(docs, min_words, key, text), "lines")
    gone = copied_lines(repeated_runs(qualifying_runs(lines, min_words), suffix_ranks(lines, min_words)))
    new_run = F.coalesce(F.col("pos") - F.lag("pos").over(_along()) > 1, F.lit(True))
    gone = gone.withColumn("opens", new_run.cast("long")).groupBy(*_DOC).agg(
        F.collect_list("pos").alias("_ff_gone"), F.sum("opens").alias("_ff_runs")
    )
    gone = gone.select(F.col("_ff_id").alias("_ff_g_id"), F.col("_ff_text").alias("_ff_g_text"), "_ff_gone", "_ff_runs")
    # The split happens below the join: a lambda would repeat it for each line.
    split = _keyed(docs, key, text).withColumn("_ff_lines", _lines(F.col(text)))
    joined = split.join(gone, F.col("_ff_id").eqNullSafe(F.col("_ff_g_id")) & (F.col("_ff_text") == F.col("_ff_g_text")), "left")
    kept = F.array_except(F.sequence(F.lit(0), F.size("_ff_lines") - 1), F.col("_ff_gone"))
    rebuilt = F.array_join(F.transform(kept, lambda i: F.col("_ff_lines")[i]), "\n")
    counts = {
        "n_lines": F.when(F.col(text).isNull(), 0).otherwise(F.size("_ff_lines")).cast("long"),
        "n_removed": F.when(F.col(text).isNull(), 0).otherwise(F.coalesce(F.size("_ff_gone"), F.lit(0))).cast("long"),
        "n_runs": F.when(F.col(text).isNull(), 0).otherwise(F.coalesce("_ff_runs", F.lit(0))).cast("long"),
        text: F.when(F.col("_ff_gone").isNotNull() & F.col(text).isNotNull(), rebuilt).otherwise(F.col(text)),
    }
    return joined.select(*[counts.get(c, F.col(c)).alias(c) for c in docs.columns], *[counts[c].alias(c) for c in ("n_lines", "n_removed", "n_runs")])
