"""Line dedup by content-defined chunks of lines.

A text is cut at line feeds and each line hashed. A rolling hash over two line
hashes stands at every line, and a line begins a chunk where it is a local
minimum, so cuts move with the content and a passage is cut alike wherever it
stands. Two minima are never neighbours, and the first and last line never stand
alone; longer stretches are cut into twos, the last being a three, so every
chunk has two or three lines. This is done with each of ``FACTORS``: a short
passage that one cutting misses is met by another.

A chunk that stands at an earlier place anywhere in the corpus is removed (places
go by id, then line; the first place stays). Hashes only find the candidates:
chunks that follow each other here and at the first place make a run, and the
text of a run is compared with that at the first place before it goes. Around it
the match grows, line by line and compared as text, over up to ``REACH`` lines on
either side; a longer passage has further chunks there. A removed line therefore
always has its equal at an earlier place.

NULL texts stay NULL and have no lines; an empty text is one empty line. A text
of one line is never removed. Rows that share id and text are one document and share
their fate; a NULL id comes first; of rows that share an id only, the smaller
hash of the text does. A text whose lines all go becomes empty. Texts of any length are
cut whole. Other columns, of whatever names, stay in `row`. An empty table
gives no rows. Only built-in functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridclime.llm.common import id_key, stage, text_key

#: A prime, and per cutting the multipliers of the two line hashes in the rolling hash; line hashes have 32 bits.
PRIME = 2_147_483_647
FACTORS = ((31, 1), (1009, 77), (65_537, 12_345))
#: Lines on either side of a chunk that a match can grow over.
REACH = 3


def lines_of(text: str = "text") -> Column:
    return F.split(F.col(text), "\n", -1)


def line_hash(line: Column) -> Column:
    return F.conv(F.substring(F.md5(line.cast("binary")), 1, 8), 16, 10).cast("long")


def bound(value: Column, body) -> Column:
    """``body`` of a value that is computed once; named in place, an array would be computed again for every element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def starts_of(hashes: Column, one: int, two: int) -> Column:
    """First lines (from 0) of the chunks of one cutting, from line hashes."""
    n = F.size(hashes)
    value = lambda i: F.when(i + 1 < n, (hashes[i] * one + hashes[i + 1] * two) % PRIME).otherwise(F.lit(PRIME))

    def cuts(rolling: Column) -> Column:
        least = lambda i: (rolling[i] < rolling[i - 1]) & (rolling[i] <= rolling[i + 1])
        return F.when(n >= 4, F.filter(F.sequence(F.lit(2), n - 2), least)).otherwise(F.array().cast("array<int>"))

    def chunks(bounds: Column) -> Column:
        def parts(k: Column) -> Column:
            size = bounds[k + 1] - bounds[k]
            return F.transform(F.sequence(F.lit(0), F.floor(size / 2).cast("int") - 1), lambda j: bounds[k] + 2 * j)

        return F.flatten(F.transform(F.sequence(F.lit(0), F.size(bounds) - 2), parts))

    rolling = F.transform(F.sequence(F.lit(0), n - 1), value)
    bounds = F.concat(F.array(F.lit(0)), bound(rolling, cuts), F.array(n))
    return F.when(n >= 2, bound(bounds, chunks)).otherwise(F.array().cast("array<int>"))


def spans_of(lines: Column) -> Column:
    """array<struct<first, size>>: the chunks of all cuttings, each span once."""

    def of(hashes: Column) -> Column:
        n = F.size(hashes)

        def spans(starts: Column) -> Column:
            end = lambda k: F.when(k + 1 < F.size(starts), starts[k + 1]).otherwise(n)
            return F.transform(starts, lambda s, k: F.struct(s.alias("first"), (end(k) - s).alias("size")))

        return F.array_distinct(F.concat(*[bound(starts_of(hashes, a, b), spans) for a, b in FACTORS]))

    return bound(F.transform(lines, line_hash), of)


def _chunk_rows(docs: DataFrame) -> DataFrame:
    """(id, text_key, first, size, hash) of all chunks, without their text."""
    lined = docs.where("text IS NOT NULL").select(id_key().alias("id"), text_key().alias("text_key"), lines_of().alias("all_lines")).where("size(all_lines) > 1")

    def hashed(lines: Column, span: Column) -> Column:
        first, size = span.getField("first"), span.getField("size")
        return F.struct(first.alias("first"), size.alias("size"), F.xxhash64(F.array_join(F.slice(lines, first + 1, size), "\n")).alias("hash"))

    made = bound(F.struct("all_lines"), lambda a: F.transform(spans_of(a.getField("all_lines")), lambda c: hashed(a.getField("all_lines"), c)))
    return lined.select("id", "text_key", F.explode(made).alias("c")).select("id", "text_key", "c.*")


def _runs(docs: DataFrame) -> DataFrame:
    """(id, text_key, low_id, low_key, offset, start, stop): runs of chunks whose hashes stand, in one piece, at an earlier place.

    Counting combines before the shuffle, and the join is a sorted merge at
    every size, whose hot keys Spark splits. No text is shuffled here.
    """
    place = F.struct("id", "text_key", "first")
    rows = _chunk_rows(docs)
    lows = rows.groupBy("hash").agg(F.min(place).alias("low"), F.max(place).alias("high")).where("low < high").select("hash", "low")
    met = rows.join(stage(lows).hint("merge"), "hash").where(place > F.col("low"))
    source = {"low_id": F.col("low.id"), "low_key": F.col("low.text_key"), "offset": F.col("first") - F.col("low.first")}
    met = met.select("id", "text_key", "first", (F.col("first") + F.col("size")).alias("stop"), *[c.alias(n) for n, c in source.items()])
    one = ["id", "text_key", *source]
    along = Window.partitionBy(*one).orderBy("first")  # the chunks of one document
    reached = F.max("stop").over(along.rowsBetween(Window.unboundedPreceding, -1))
    begins = met.withColumn("begins", F.when(F.coalesce(F.col("first") <= reached, F.lit(False)), 0).otherwise(1))
    numbered = begins.withColumn("run", F.sum("begins").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*one, "run").agg(F.min("first").alias("start"), F.max("stop").alias("stop")).drop("run")


def _cuttings(docs: DataFrame, runs: DataFrame) -> DataFrame:
    """For every run its own text and that of its first place, with up to ``REACH`` lines before (backwards) and after; stored.

    A document's text is read once for all runs in it and all that begin there,
    however many those are.
    """
    own = F.struct(*[F.col(c) for c in ("start", "stop", "low_id", "low_key", "offset")])
    first = F.struct((F.col("start") - F.col("offset")).alias("start"), (F.col("stop") - F.col("offset")).alias("stop"))
    none = lambda c: F.lit(None).cast(runs.select(c.alias("c")).schema["c"].dataType)
    asked = runs.select("id", "text_key", own.alias("own"), none(first).alias("first"))
    asked = asked.unionByName(runs.select(F.col("low_id").alias("id"), F.col("low_key").alias("text_key"), none(own).alias("own"), first.alias("first")))
    wanted = asked.groupBy("id", "text_key").agg(F.collect_set("own").alias("own"), F.collect_set("first").alias("first"))
    whole = docs.where("text IS NOT NULL").select(id_key().alias("id"), text_key().alias("text_key"), "text")
    whole = whole.groupBy("id", "text_key").agg(F.min("text").alias("text"))  # rows that are equal in both are one
    held = whole.join(wanted.hint("merge"), ["id", "text_key"]).select("id", "text_key", "own", "first", lines_of().alias("lines"))

    def cut(lines: Column, span: Column, is_own: bool) -> Column:
        start, stop = span.getField("start"), span.getField("stop")
        near = F.least(start, F.lit(REACH))
        missing = {"low_id": "long", "low_key": "long", "offset": "int"}
        more = [(span.getField(c) if is_own else F.lit(None)).cast(kind).alias(c) for c, kind in missing.items()]
        return F.struct(
            F.lit(is_own).alias("own"),
            start.alias("start"),
            stop.alias("stop"),
            *more,
            F.array_join(F.slice(lines, start + 1, stop - start), "\n").alias("text"),
            F.reverse(F.slice(lines, start - near + 1, near)).alias("before"),
            F.slice(lines, stop + 1, F.lit(REACH)).alias("after"),
        )

    made = bound(
        F.struct("lines", "own", "first"),
        lambda a: F.concat(
            F.transform(a.getField("own"), lambda s: cut(a.getField("lines"), s, True)),
            F.transform(a.getField("first"), lambda s: cut(a.getField("lines"), s, False)),
        ),
    )
    return stage(held.select("id", "text_key", F.explode(made).alias("c")).select("id", "text_key", "c.*"))


def _grown(mine: str, theirs: str) -> Column:
    """How many lines are equal from the chunk on."""
    same = [F.coalesce(F.get(mine, F.lit(i)) == F.get(theirs, F.lit(i)), F.lit(False)) for i in range(REACH)]
    out = F.lit(0)
    for own in reversed(same):
        out = F.when(own, out + 1).otherwise(F.lit(0))
    return out


def removed_spans(docs: DataFrame) -> DataFrame:
    """(id, text_key, start, stop) of every run of lines that stands at an earlier place."""
    cuttings = _cuttings(docs, stage(_runs(docs)))
    low = {"id": "low_id", "text_key": "low_key", "start": "low_start", "stop": "low_stop", "text": "low_text", "before": "low_before", "after": "low_after"}
    firsts = cuttings.where("NOT own").select(*[F.col(c).alias(n) for c, n in low.items()])
    own = cuttings.where("own").withColumns({"low_start": F.col("start") - F.col("offset"), "low_stop": F.col("stop") - F.col("offset")})
    same = own.join(firsts.hint("merge"), ["low_id", "low_key", "low_start", "low_stop"]).where("text = low_text")
    start = F.col("start") - _grown("before", "low_before")
    stop = F.col("stop") + _grown("after", "low_after")
    return same.select("id", "text_key", start.alias("start"), stop.alias("stop"))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """All columns of ``docs`` in `row`, and n_lines, n_chunks, removed (numbers of lines from 0), lines_removed, kept_text."""
    spans = removed_spans(docs).groupBy("id", "text_key").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))
    gone = F.flatten(F.transform("spans", lambda s: F.sequence(s.getField("start"), s.getField("stop") - 1)))
    gone = stage(spans.select("id", "text_key", F.array_sort(F.array_distinct(gone)).alias("removed")))
    rows = docs.select(F.struct("*").alias("row"), id_key().alias("id"), text_key().alias("text_key"))
    joined = rows.join(gone.hint("merge"), ["id", "text_key"], "left").select("row", "id", "removed")

    def kept(a: Column) -> Column:
        lines, removed = a.getField("lines"), a.getField("removed")
        stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), removed)
        text = F.array_join(F.transform(stay, lambda i: lines[i]), "\n")
        return F.struct(F.size(lines).alias("n_lines"), F.size(spans_of(lines)).alias("n_chunks"), text.alias("text"))

    none = F.array().cast("array<int>")
    inputs = F.struct(lines_of("row.text").alias("lines"), F.coalesce("removed", none).alias("removed"))
    result = F.when(F.col("row.text").isNotNull(), bound(inputs, kept))
    return joined.withColumn("result", result).select(
        "row",
        F.coalesce("result.n_lines", F.lit(0)).alias("n_lines"),
        F.coalesce("result.n_chunks", F.lit(0)).alias("n_chunks"),
        F.coalesce("removed", none).alias("removed"),
        F.coalesce(F.size("removed"), F.lit(0)).alias("lines_removed"),
        F.col("result.text").alias("kept_text"),
    )
