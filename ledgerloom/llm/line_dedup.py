"""Lines that many documents share, found with levelled sorted runs of line hashes.

Documents come in batches with falling ids.  A batch's line hashes are anti-joined with the runs: a
hash that no run holds is new, so its largest holder is in this batch; a hash that a run holds only
adds to the number of holders.  Both go into a new sorted run of level 0; a level with ``fanout``
runs is merged into one run of the next level.  Everything is DataFrame work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .storage import ascii_lower, keep

BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"
KEY = ["h1", "h2"]


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


class LineRuns:
    """Runs of (h1, h2, top, holders) by level, each sorted by hash in its files."""

    def __init__(self, fanout: int = 3):
        self.fanout = fanout
        self.levels: list[list[DataFrame]] = []

    def all(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def add(self, lines: DataFrame) -> None:
        """lines: (id, h1, h2), a row per document and different line; ids below those of earlier batches."""
        fresh = lines.groupBy(*KEY).agg(F.max("id").alias("top"), F.count("*").alias("holders"))
        if runs := self.all():
            held = runs[0].select(*KEY)
            for run in runs[1:]:
                held = held.union(run.select(*KEY))
            fresh = keep(fresh, "lines-batch")
            new = fresh.join(held, KEY, "left_anti")
            again = fresh.join(held, KEY, "left_semi").withColumn("top", F.lit(None).cast("long"))
            fresh = new.unionByName(again)
        self._put(0, fresh)

    def _put(self, level: int, run: DataFrame) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(keep(run.repartition(*KEY).sortWithinPartitions(*KEY), f"lines-run{level}"))
        if len(self.levels[level]) >= self.fanout:
            full, self.levels[level] = self.levels[level], []
            self._put(level + 1, merged(full))

    def compacted(self) -> DataFrame:
        return merged(self.all())


def merged(runs: list[DataFrame]) -> DataFrame:
    union = runs[0]
    for run in runs[1:]:
        union = union.unionByName(run)
    return union.groupBy(*KEY).agg(F.max("top").alias("top"), F.sum("holders").alias("holders"))


def shared_line_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = 20,
    min_docs: int = 3,
    batches: int = 4,
    fanout: int = 3,
) -> DataFrame:
    """One row per input row: id, n_lines, n_dropped, kept_text.

    Text is cut at \\n; null or empty text is one empty line.  A line's key is the line without blanks
    at its ends, A-Z lower-cased.  Keys of at least ``min_chars`` code points in at least
    ``min_docs`` documents lose all their lines except in the document with the largest id.  Rows
    that repeat id and text count as one document; rows that repeat an id with another text count
    apart, and if that id is the largest, all of them keep the line.  Rows with a null id neither
    count nor lose lines.  Other columns are not read; an empty table gives no rows.  Keys are
    compared by 128 bits of hash.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("text_hash"), F.split(text, "\n", -1).alias("lines"))
    hashes = keep(
        rows.filter("id IS NOT NULL")
        .select("id", "text_hash", F.posexplode("lines").alias("pos", "line"))
        .select("id", "text_hash", "pos", line_key(F.col("line")).alias("key"))
        .filter(F.char_length("key") >= min_chars)
        .select("id", "text_hash", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("line"), F.col("key")).alias("h2")),
        "lines",
    )
    single = hashes.select("id", "text_hash", *KEY).distinct()
    runs = LineRuns(fanout)
    for upper, lower in falling_ranges(hashes, "id", batches):
        part = single
        if upper is not None:
            part = part.filter(F.col("id") <= upper)
        if lower is not None:
            part = part.filter(F.col("id") > lower)
        runs.add(part)
    shared = keep(runs.compacted().filter(F.col("holders") >= min_docs).select(*KEY, "top"), "lines-shared")
    drops = (
        hashes.join(shared, KEY)
        .filter(F.col("id") < F.col("top"))
        .groupBy("id", "text_hash")
        .agg(F.array_sort(F.collect_set("pos")).alias("drops"))
    )
    marked = rows.join(drops, ["id", "text_hash"], "left")
    return marked.select(
        F.col("id").alias(id_col),
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("drops"), F.lit(0)).cast("long").alias("n_dropped"),
        F.array_join(F.when(F.col("drops").isNull(), F.col("lines")).otherwise(_without("lines", "drops")), "\n").alias("kept_text"),
    )


def falling_ranges(df: DataFrame, column: str, parts: int) -> list[tuple[int | None, int | None]]:
    """(upper, lower] ranges of about equal numbers of rows, the largest first; None is open."""
    steps = [i / parts for i in range(1, parts)]
    cuts = (df.select(F.percentile_approx(column, steps).alias("c")).first().c or []) if steps else []
    edges = sorted(set(cuts))
    return list(zip([*edges, None], [None, *edges]))[::-1]


def _without(lines: str, drops: str) -> Column:
    """The lines between the dropped positions (sorted), in time linear in the lines."""
    starts = F.concat(F.array(F.lit(0)), F.transform(drops, lambda d: d + 1))
    ends = F.concat(F.col(drops), F.array(F.size(lines)))
    return F.flatten(F.zip_with(starts, ends, lambda a, b: F.slice(F.col(lines), a + 1, b - a)))
