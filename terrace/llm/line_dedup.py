"""Removal of repeated runs of lines, by winnowing over line hashes. DataFrame functions only.

Of every ``RUN`` lines in a row the one with the smallest hash is a fingerprint (the last
of equal ones), so two equal runs of at least ``RUN`` lines share a fingerprint. Positions
of equal fingerprints are joined; around those that occur more than once the match is
extended line by line both ways, as far as every string of ``RUN`` lines through the
fingerprint; and a line goes when a string that covers it occurs earlier, by (doc_id,
line), be it in another document or its own. What goes is therefore the whole repeated
run, whichever earlier places its parts come from.

Lines are what newlines separate, compared byte for byte; lines without a word are no part
of runs and stay. Strings are compared by the 64-bit hashes of each of their lines.
Positions are counted and their firsts found before the shuffle where they can be. What
they are then joined with is a stored table, so that Spark splits a fingerprint or a string
that a third of the documents hold.

With ``words``, runs of fewer lines count as well if they have that many words together:
each is a string of its own besides the fingerprints', as long lines are few for their text.

Defined cases: null texts have no lines and an empty kept text; texts of fewer lines than
a run stay whole unless ``words`` says otherwise; repeated rows (same id) do not remove each other and give repeated rows;
rows with a null id stay whole and remove nothing; an empty table gives none; other
columns take no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import WORD, stored, text_or_empty

RUN = 3
#: Words with which fewer lines are a run as well, where that is asked for.
WORDS = 50


def lines_of(text: Column) -> Column:
    """(at, hash) of the lines with a word; at counts all lines from 0."""
    numbered = F.transform(
        F.split(text, "\n", -1),
        lambda line, k: F.struct(k.alias("at"), F.xxhash64(line).alias("hash"), line.rlike(WORD).alias("worded")),
    )
    return F.transform(F.filter(numbered, lambda x: x["worded"]), lambda x: F.struct(x["at"], x["hash"]))


def fingerprints(lines: Column, run: int = RUN) -> Column:
    """Indices, among the worded lines, of the minima of all windows of ``run`` lines."""

    def least(start: Column) -> Column:
        # Smallest hash, and the last of equal ones, as the largest (-rank, index).
        window = F.slice(lines, start + 1, run)
        ranked = F.transform(window, lambda x, k: F.struct(x["hash"], (-k).alias("back")))
        return start - F.array_min(ranked)["back"]

    starts = F.sequence(F.lit(0), F.size(lines) - run)
    return F.array_distinct(F.transform(starts, least))


def long_strings(docs: DataFrame, run: int, words: int) -> DataFrame:
    """doc_id, start, hashes, ats: the strings of fewer than ``run`` lines with ``words`` words or more."""
    lines = F.col("lines")
    numbered = F.transform(
        F.split("text", "\n", -1),
        lambda line, k: F.struct(k.alias("at"), F.xxhash64(line).alias("hash"), F.regexp_count(line, F.lit(WORD)).alias("n")),
    )

    def of(size: int) -> Column:
        """All strings of ``size`` lines that are long enough."""

        def string(line: Column, k: Column) -> Column:
            part = F.slice(lines, k + 1, size)
            return F.struct(
                k.alias("start"),
                F.transform(part, lambda x: x["hash"]).alias("hashes"),
                F.transform(part, lambda x: x["at"]).alias("ats"),
                F.aggregate(part, F.lit(0), lambda n, x: n + x["n"]).alias("n"),
            )

        return F.filter(F.transform(lines, string), lambda x: (F.size(x["ats"]) == size) & (x["n"] >= words))

    return (
        docs.filter("doc_id IS NOT NULL AND text IS NOT NULL")
        .select(F.col("doc_id").cast("long"), F.filter(numbered, lambda x: x["n"] > 0).alias("lines"))
        .select("doc_id", F.explode(F.concat(*(of(size) for size in range(1, run)))).alias("string"))
        .select("doc_id", "string.start", "string.hashes", "string.ats")
    )


def repeated_lines(docs: DataFrame, run: int = RUN, words: int | None = None) -> DataFrame:
    """doc_id, gone, ranks: the lines in a later repeat, per document that has any.

    ``gone`` counts all lines from 0, ``ranks`` those with a word.
    """
    lined = (
        docs.filter("doc_id IS NOT NULL AND text IS NOT NULL")
        .select(F.col("doc_id").cast("long"), lines_of(F.col("text")).alias("lines"))
        .filter(F.size("lines") >= run)
    )
    # Only what belongs to a fingerprint goes along with it, never all lines of the text.
    lines = F.col("lines")

    def mark(k: Column) -> Column:
        first = F.greatest(k - (run - 1), F.lit(0))
        # All lines that strings of ``run`` lines through the fingerprint hold.
        around = F.slice(lines, first + 1, k - first + run)
        return F.struct(lines[k]["hash"].alias("mark"), first.alias("first"), around.alias("around"))

    found = lined.select("doc_id", F.explode(F.transform(fingerprints(lines, run), mark)).alias("found"))
    marks = stored(found.select("doc_id", "found.*"), "marks")
    several = stored(marks.groupBy("mark").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("mark"), "several")
    shared = marks.join(several, "mark")
    strings = F.transform(
        F.sequence(F.lit(1), F.size("around") - run + 1), lambda s: F.slice("around", s, run)
    )
    string = shared.select("doc_id", "first", F.posexplode(strings).alias("offset", "string")).select(
        "doc_id",
        (F.col("first") + F.col("offset")).alias("start"),
        F.transform("string", lambda x: x["hash"]).alias("hashes"),
        F.transform("string", lambda x: x["at"]).alias("ats"),
    )
    if words and run > 1:
        string = string.unionByName(long_strings(docs, run, words))
    string = stored(string.dropDuplicates(["doc_id", "start", "hashes"]), "strings")
    place = F.struct("doc_id", "start")
    firsts = (
        string.groupBy("hashes")
        .agg(F.min(place).alias("earliest"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select("hashes", "earliest")
    )
    firsts = stored(firsts, "firsts")
    later = string.join(firsts, "hashes").filter(place > F.col("earliest"))
    ranks = F.sequence("start", F.col("start") + F.size("ats") - 1)
    together = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c))))
    return later.groupBy("doc_id").agg(together("ats").alias("gone"), together(ranks).alias("ranks"))


def drop_repeated_lines(docs: DataFrame, run: int = RUN, words: int | None = None) -> DataFrame:
    """One row per document: doc_id, n_lines (with a word), n_removed, n_runs, kept (text)."""
    gone = stored(repeated_lines(docs, run, words), "gone").withColumnRenamed("doc_id", "gone_id")
    parts = F.split(text_or_empty(), "\n", -1)
    n_lines = F.size(F.filter(parts, lambda line: line.rlike(WORD)))
    # The lines go through the join as such: what looks them up by number then has them at hand.
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), parts.alias("parts"), n_lines.cast("long").alias("n_lines"))
    # Sorted and merged at any size: what is moved then grows as the texts do.
    held = rows.join(gone.hint("merge"), F.col("doc_id") == F.col("gone_id"), "left")
    none = F.array().cast("array<int>")
    held = held.withColumns({"gone": F.coalesce("gone", none), "ranks": F.coalesce("ranks", none)})
    stay = F.array_except(F.sequence(F.lit(0), F.size("parts") - 1), F.col("gone"))
    return held.select(
        "doc_id",
        "n_lines",
        F.size("gone").cast("long").alias("n_removed"),
        # A run begins where the worded line before stays: at ranks whose neighbour is none of them.
        F.size(F.array_except(F.transform("ranks", lambda r: r - 1), F.col("ranks"))).cast("long").alias("n_runs"),
        F.when(F.size("gone") == 0, F.array_join("parts", "\n"))
        .otherwise(F.array_join(F.transform(stay, lambda k: F.col("parts")[k]), "\n"))
        .alias("kept"),
    )
