"""Dedup of repeated passages: content-defined chunks of lines. DataFrame functions only.

A rolling hash over the hashes of the last two lines decides whether a chunk ends after a line, on average after every
second. So boundaries depend on nearby lines only: a passage that several documents share is cut alike in all of them,
wherever it stands, save for its edges. Chunks of two lines or more that occur more than once are removed except for
their first occurrence, after their bytes were compared.

Chunks miss the edges of a passage, and short passages altogether. `dedup_passages` removes whole passages: it compares
every two neighbouring lines, wherever they stand, and long lines alone, so that no boundary is in the way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import WORD, Workspace

#: A chunk ends after a line with the chance of one in so many.
EVERY = 2
LEAST_LINES = 2
#: A line of so many bytes is a passage of its own; every line of more than 50 words has as many.
LONG_LINE = 100
_FACTOR = 31
_LAST = (1 << 63) - 1


def _line_hash(line: Column) -> Column:
    """28 bits of MD5, so that sums stay far below 64 bits."""
    return F.conv(F.substring(F.md5(line.cast("binary")), 1, 7), 16, 10).cast("long")


def _once(df: DataFrame, **columns: Column) -> DataFrame:
    """Computes columns where they stand. A generator keeps them from being copied into lambdas, which would compute
    them again for each element."""
    return df.select(F.inline(F.array(F.struct(*[column.alias(name) for name, column in columns.items()]))))


def chunked(docs: DataFrame) -> DataFrame:
    """doc_id, seal (MD5 of the text), lines, chunks (start, count; from 0) of every row."""
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    split = _once(docs, doc_id=docs["doc_id"].cast("long"), seal=F.md5(text.cast("binary")), lines=F.split(text, "\n", -1))
    hashed = _once(split, doc_id=F.col("doc_id"), seal=F.col("seal"), lines=F.col("lines"), hashes=F.transform("lines", _line_hash))
    before = F.concat(F.array(F.lit(0).cast("long")), F.slice("hashes", F.lit(1), F.size("hashes") - 1))
    rolled = F.zip_with("hashes", before, lambda own, last: own + _FACTOR * last)
    stops = F.filter(F.transform(rolled, lambda value, place: F.when(value % EVERY == 0, place)), lambda place: place.isNotNull())
    ended = _once(
        hashed, doc_id=F.col("doc_id"), seal=F.col("seal"), lines=F.col("lines"), ends=F.array_union(stops, F.array(F.size("lines") - 1))
    )
    ahead = F.concat(F.array(F.lit(-1)), F.slice("ends", F.lit(1), F.size("ends") - 1))
    chunks = F.zip_with("ends", ahead, lambda end, last: F.struct((last + 1).alias("start"), (end - last).alias("count")))
    return _once(ended, doc_id=F.col("doc_id"), seal=F.col("seal"), lines=F.col("lines"), chunks=chunks)


def chunk_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, seal, start, count, key, chunk): one row per chunk of at least `LEAST_LINES` lines; chunk is its text."""
    large = F.filter("chunks", lambda c: c["count"] >= LEAST_LINES)
    shown = F.transform(
        large,
        lambda c: F.struct(c["start"].alias("start"), c["count"].alias("count"), F.array_join(F.slice("lines", c["start"] + 1, c["count"]), "\n").alias("chunk")),
    )
    return _keyed(chunked(docs).select("doc_id", "seal", F.inline(shown)))


def _keyed(rows: DataFrame) -> DataFrame:
    return rows.withColumn("key", F.conv(F.substring(F.md5(F.col("chunk").cast("binary")), 1, 15), 16, 10).cast("long"))


def passage_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, seal, start, count, key, chunk), as `chunk_rows` has them: one row per long line, and one from each line to
    the next, unless both are long. Blank lines are no neighbours: they lie within a row or between rows.

    A passage of several lines is repeated just where its rows are, so extending matches line by line would add nothing.
    """
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    split = _once(docs, doc_id=docs["doc_id"].cast("long"), seal=F.md5(text.cast("binary")), lines=F.split(text, "\n", -1))
    shown = F.transform("lines", lambda line, place: F.struct(place.alias("at"), F.octet_length(line).alias("size"), line.rlike(WORD).alias("shown")))
    placed = _once(split, doc_id=F.col("doc_id"), seal=F.col("seal"), lines=F.col("lines"), own=F.filter(shown, lambda s: s["shown"]))
    after = F.slice("own", F.lit(2), F.greatest(F.size("own") - 1, F.lit(0)))
    pairs = F.zip_with(F.slice("own", F.lit(1), F.size(after)), after, lambda own, other: F.struct(
        own["at"].alias("start"), (other["at"] - own["at"] + 1).alias("count"), (F.least(own["size"], other["size"]) < LONG_LINE).alias("wanted")
    ))
    single = F.transform("own", lambda own: F.struct(own["at"].alias("start"), F.lit(1).alias("count"), (own["size"] >= LONG_LINE).alias("wanted")))
    spans = _once(placed, doc_id=F.col("doc_id"), seal=F.col("seal"), lines=F.col("lines"), spans=F.filter(F.concat(single, pairs), lambda s: s["wanted"]))
    texts = F.transform(
        "spans",
        lambda s: F.struct(s["start"].alias("start"), s["count"].alias("count"), F.array_join(F.slice("lines", s["start"] + 1, s["count"]), "\n").alias("chunk")),
    )
    return _keyed(spans.select("doc_id", "seal", F.inline(texts)))


def repeated_chunks(docs: DataFrame, space: Workspace) -> DataFrame:
    return _repeated(chunk_rows(docs), space)


def _repeated(rows: DataFrame, space: Workspace) -> DataFrame:
    """(doc_id, seal, start, count) of the chunk occurrences to remove.

    Keys are counted first, which combines before the shuffle, and only chunks whose key repeats go on. They are grouped
    by key and text, so different texts with one key stay apart. Of each text the first occurrence stays: that in
    the smallest doc_id, NULL being last, then by seal and place. A chunk with a third of all occurrences is the
    skewed side of the last join, which adaptive execution splits. All joins are sort-merge joins: what repeats
    grows with the table, so a plan that broadcasts it while it is small would be another one at scale.
    """
    keys = space.table("keys", rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key"))
    repeated = space.table("repeated", rows.join(keys.hint("merge"), "key", "left_semi"))
    place = F.struct(F.coalesce("doc_id", F.lit(_LAST)).alias("id"), "seal", "start")
    first = repeated.groupBy("key", "chunk").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first <> last")
    return repeated.withColumn("place", place).join(first.hint("merge"), ["key", "chunk"]).where("place <> first").select("doc_id", "seal", "start", "count")


def dedup_lines(docs: DataFrame, space: Workspace) -> DataFrame:
    """doc_id, text, n_lines, removed_lines and removed_chunks of every row: its text without the repeated chunks.

    Lines end at line feeds; what is kept is joined by line feeds again. NULL text counts as the empty text, which has one
    empty line. Rows with equal doc_id and text are one document: what one keeps, both keep. Rows with a NULL doc_id
    take part. An empty table gives no rows; other columns are ignored.
    """
    return _without(docs, _spans(repeated_chunks(docs, space)), space)


def dedup_passages(docs: DataFrame, space: Workspace) -> DataFrame:
    """doc_id, text, n_lines, removed_lines and removed_passages of every row: its text without the repeated passages.

    A passage is a run of lines in which two neighbours, blank lines between them included, or a line of `LONG_LINE` bytes
    occur before: in a smaller doc_id, NULL being last, then by seal and place. So runs of one line, too, shrink to
    its first. Of each line that goes, an occurrence stays. Blank lines alone, and the rest, are as in `dedup_lines`.
    """
    spans = _spans(_repeated(passage_rows(docs), space))
    # Rows overlap: what lies in any of them goes, in as few spans as there are.
    gone = F.array_distinct(F.flatten(F.transform("spans", lambda s: F.sequence(s["start"], s["start"] + s["count"] - 1))))
    spans = _once(spans, _id=F.col("_id"), _seal=F.col("_seal"), gone=gone)
    spans = _once(spans, _id=F.col("_id"), _seal=F.col("_seal"), gone=F.col("gone"), next=F.transform("gone", lambda at: at + 1))
    starts, ends = F.array_sort(F.array_except("gone", "next")), F.array_sort(F.array_except("next", "gone"))
    merged = F.zip_with(starts, ends, lambda start, end: F.struct(start.alias("start"), (end - start).alias("count")))
    return _without(docs, spans.select("_id", "_seal", merged.alias("spans")), space).withColumnRenamed("removed_chunks", "removed_passages")


def _spans(repeated: DataFrame) -> DataFrame:
    """What goes from each document: _id, _seal, spans (start, count), sorted."""
    return (
        repeated.distinct()
        .groupBy("doc_id", "seal")
        .agg(F.sort_array(F.collect_list(F.struct("start", "count"))).alias("spans"))  # within one document
        .select(F.col("doc_id").alias("_id"), F.col("seal").alias("_seal"), "spans")
    )


def _without(docs: DataFrame, gone: DataFrame, space: Workspace) -> DataFrame:
    gone = space.table("gone", gone)
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    sealed = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text.alias("text"), F.md5(text.cast("binary")).alias("seal"))
    met = sealed.join(gone.hint("merge"), sealed["doc_id"].eqNullSafe(gone["_id"]) & (sealed["seal"] == gone["_seal"]), "left")
    lines = _once(met, doc_id=F.col("doc_id"), text=F.col("text"), spans=F.col("spans"), lines=F.split("text", "\n", -1))
    # What is kept lies between the removed spans: from the end of one to the start of the next.
    begins = F.concat(F.array(F.lit(0)), F.transform("spans", lambda s: s["start"] + s["count"]))
    ends = F.concat(F.transform("spans", lambda s: s["start"]), F.array(F.size("lines")))
    kept = F.flatten(F.transform(F.arrays_zip(begins.alias("low"), ends.alias("high")), lambda s: F.slice("lines", s["low"] + 1, s["high"] - s["low"])))
    clean = F.when(F.col("spans").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    return lines.select(
        "doc_id",
        clean.alias("text"),
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.aggregate("spans", F.lit(0), lambda total, s: total + s["count"]), F.lit(0)).cast("long").alias("removed_lines"),
        F.when(F.col("spans").isNull(), 0).otherwise(F.size("spans")).cast("long").alias("removed_chunks"),
    )
