"""How far the sources of a language differ in their terms, in exact whole numbers.

Arrow kernels cut and count inside the tasks: ``ascii_lower``, ``split_pattern_regex``, ``dictionary_encode`` and a hash
``group_by`` make partial counts per language, source and term, which Spark adds up.  A language's kept
terms are then dealt into shards, each led by a row with the totals of all sources.  A shard is worked
through in matrices of terms by sources, which give partial sums per pair of sources and the best terms.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from .hashing import blocks, text_bytes
from .storage import keep

#: All ASCII but letters lies between terms.
GAPS = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
LEAST_DOCS = 30
SMOOTH = 5
ONE = 1_000_000_000
TOP = 50
#: Distinct (language, source, term) that a task holds before it passes them on.
HELD = 1 << 18
#: Kept terms of a shard, about; and cells of a matrix.
SHARD_TERMS, CELLS = 2_000, 1 << 21


def _counts(batch: pa.RecordBatch) -> Iterator[pa.Table]:
    """(lang, source, term, n, docs) of blocks of a batch's documents, with columns lang, source, text."""
    _, offsets = text_bytes(batch.column("text"))
    for first, last in blocks(offsets):
        part = batch.slice(first, last - first)
        # lowered before the cast: of a slice that was cast, ascii_lower reads the wrong bytes
        lists = pc.split_pattern_regex(pc.ascii_lower(part.column("text")).cast(pa.large_string()), GAPS)
        parents, terms = pc.list_parent_indices(lists), pc.list_flatten(lists)
        some = pc.not_equal(terms, pa.scalar("", pa.large_string()))
        terms, parents = terms.filter(some).dictionary_encode(), parents.filter(some)
        in_doc = pa.table({"doc": parents, "code": terms.indices}).group_by(["doc", "code"], use_threads=False).aggregate([([], "count_all")])
        group = pa.table({"lang": part.column("lang"), "source": part.column("source")}).take(in_doc.column("doc"))
        named = group.append_column("code", in_doc.column("code")).append_column("n", in_doc.column("count_all"))
        own = named.group_by(["lang", "source", "code"], use_threads=False).aggregate([("n", "sum"), ([], "count_all")])
        words = terms.dictionary.take(own.column("code").combine_chunks()).cast(pa.string())
        yield pa.table({"lang": own.column("lang"), "source": own.column("source"), "term": words, "n": own.column("n_sum"), "docs": own.column("count_all")})


def _merged(tables: list[pa.Table]) -> pa.Table:
    added = pa.concat_tables(tables).group_by(["lang", "source", "term"], use_threads=False).aggregate([("n", "sum"), ("docs", "sum")])
    return added.select(["lang", "source", "term", "n_sum", "docs_sum"]).rename_columns(["lang", "source", "term", "n", "docs"])


def partial_counts(docs: DataFrame, held: int = HELD) -> DataFrame:
    """docs (lang, source, text, without nulls); (lang, source, term, n, docs), a few rows per task and term."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[pa.Table] = []
        for batch in batches:
            for table in _counts(batch):
                parts.append(table)
                if sum(p.num_rows for p in parts) > held:
                    parts = [_merged(parts)]
                    if parts[0].num_rows > held // 2:
                        yield from parts[0].to_batches(max_chunksize=1 << 16)
                        parts = []
        if parts:
            yield from _merged(parts).to_batches(max_chunksize=1 << 16)

    return docs.mapInArrow(count, "lang string, source string, term string, n long, docs long")


def kept_terms(docs: DataFrame, least_docs: int) -> DataFrame:
    """(lang, term, sources, counts) of the terms in at least so many documents of the language."""
    key = ["lang", "source", "term"]
    summed = partial_counts(docs).groupBy(*key).agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    by_term = summed.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("held"))
    return by_term.filter(F.col("docs") >= least_docs).select("lang", "term", F.col("held.source").alias("sources"), F.col("held.n").alias("counts"))


def scaled(counts: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(ONE * counts / total), exact: nine digits in three steps, as counts are at most total."""
    rest, out = counts, np.zeros_like(counts)
    for _ in range(3):
        rest = rest * 1000
        out = out * 1000 + rest // total
        rest = rest % total
    return out + 1


def _shares(terms: list[dict], sources: list[str], totals: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Partial sums per pair of sources, and the best terms of each source, of some terms of a language in their order."""
    place = {s: i for i, s in enumerate(sources)}
    counts = np.zeros((len(terms), len(sources)), np.int64)
    for row, term in enumerate(terms):
        counts[row, [place[s] for s in term["sources"]]] = term["counts"]
    own = scaled(counts + SMOOTH, totals[None, :-1])
    all_of = scaled(counts.sum(axis=1) + SMOOTH, np.full(len(terms), totals[-1]))
    for i in range(len(sources) - 1):
        apart = np.abs(own[:, i + 1 :] - own[:, i : i + 1]).sum(axis=0)
        yield _rows([sources[i]] * len(apart), "pair", sources[i + 1 :], apart)
    above = np.where(counts > 0, own - all_of[:, None], 0)
    for i, source in enumerate(sources):
        some = np.flatnonzero(above[:, i] > 0)
        best = some[np.argsort(-above[some, i], kind="stable")[:TOP]]
        yield _rows([source] * len(best), "term", [terms[b]["term"] for b in best], above[best, i])


def _rows(sources: list[str], part: str, items: list[str], values: np.ndarray) -> pa.RecordBatch:
    text = lambda x: pa.array(x, pa.string())
    return pa.RecordBatch.from_pydict({"source": text(sources), "part": text([part] * len(sources)), "item": text(items), "value": pa.array(values, pa.int64())})


def shard_sums(shards: DataFrame, cells: int = CELLS) -> DataFrame:
    """Rows (lang, shard, term, sources, counts) sorted by these, the one without a term first: (lang, source, part, item, value).

    That first row has all sources of the language, in order, and what ONE is divided by for each of them and, last, for all.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, terms = None, []

        def done() -> Iterator[pa.RecordBatch]:
            totals = np.array(head["counts"], np.int64)
            for rows in _parted(_shares(terms, head["sources"], totals)):
                yield rows.add_column(0, "lang", pa.array([head["lang"]] * rows.num_rows, pa.string()))

        for batch in batches:
            for row in batch.to_pylist():
                if row["term"] is None:
                    if head:
                        yield from done()
                    head, terms = row, []
                else:
                    terms.append(row)
                    if len(terms) * len(head["sources"]) >= cells:
                        yield from done()
                        terms = []
        if head:
            yield from done()

    def _parted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The same rows in fewer batches."""
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) > 1 << 16:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held = []
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    return shards.mapInArrow(work, "lang string, source string, part string, item string, value long")


def source_divergence(
    docs: DataFrame, least_docs: int = LEAST_DOCS, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
    shard_terms: int = SHARD_TERMS, cells: int = CELLS,
) -> DataFrame:
    """lang, source, part, item, value, rank: for each source of a language its distances to the others and its own terms.

    Terms are runs of ASCII letters and non-ASCII characters, A-Z lower-cased, of whole texts however long; a language keeps those found in
    ``least_docs`` of its documents.  A kept term's share is 1 + floor(10^9 (count + 5) / (N + 5 V)), N the kept
    terms' occurrences in the source or the language, V their number.  ``pair``: value is the sum of the differences
    of all shares to another source's (0 without kept terms).  ``term``: the 50 terms of the source whose share is most
    above the language's.  Ranks go by value, then by item as UTF-8.  Null text, language and source count as empty;
    rows that repeat count each time.  Other columns are not read; an empty table gives no rows.
    """
    empty = lambda c, name: F.coalesce(F.col(c), F.lit("")).alias(name)
    rows = docs.select(empty(lang_col, "lang"), empty(source_col, "source"), empty(text_col, "text"))
    terms = keep(kept_terms(rows, least_docs), "kept-terms")
    sizes = terms.groupBy("lang").agg(F.count("*").alias("v"))
    held = terms.select("lang", F.explode(F.arrays_zip("sources", "counts")).alias("h")).groupBy("lang", F.col("h.sources").alias("source"))
    groups = rows.select("lang", "source").distinct().join(held.agg(F.sum("h.counts").alias("n")), ["lang", "source"], "left")
    ordered = F.sort_array(F.collect_list(F.struct("source", F.coalesce("n", F.lit(0)).alias("n"))))
    languages = groups.groupBy("lang").agg(ordered.alias("g"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).join(sizes, "lang", "left")
    heads = keep(
        languages.select(
            "lang",
            (F.coalesce("v", F.lit(0)) / shard_terms).cast("int").alias("last"),
            F.col("g.source").alias("sources"),
            F.transform(F.concat("g.n", F.array("n")), lambda n: n + SMOOTH * F.coalesce("v", F.lit(0))).alias("counts"),
        ),
        "source-totals",
    )
    first = heads.select("lang", F.explode(F.sequence(F.lit(0), "last")).alias("shard"), F.lit(None).cast("string").alias("term"), "sources", "counts")
    number = F.pmod(F.xxhash64("term"), F.col("last") + 1).cast("int")
    dealt = terms.join(heads.select("lang", "last"), "lang").select("lang", number.alias("shard"), "term", "sources", "counts")
    shards = first.unionByName(dealt).repartition("lang", "shard").sortWithinPartitions("lang", "shard", F.col("term").asc_nulls_first())
    found = keep(shard_sums(shards, cells), "divergence-parts")
    pairs = found.filter("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    both = pairs.unionByName(pairs.select("lang", F.col("item").alias("source"), "part", F.col("source").alias("item"), "value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item"))
    best = found.filter("part = 'term'").withColumn("rank", rank).filter(F.col("rank") <= TOP)
    return both.withColumn("rank", rank).unionByName(best).select("lang", "source", "part", "item", "value", "rank")
