"""Line dedup by runs of lines, with no cuts: every repeated run of two lines or more goes.

A text is cut at line feeds. Two lines that follow each other are a pair; a pair
that occurs at an earlier place (smaller id, then position) is repeated, and both
of its lines go. So a passage of two lines or more that stands at an earlier
place goes from its first line to its last, and a whole copy becomes empty. The
first occurrence of a line stays always. Hashes only find the candidates; a pair
is removed after its text was compared.

NULL texts stay NULL and have no lines; an empty text is one empty line. Rows
that share id and text are one document and share their fate; a NULL id comes
first. A text whose lines all go becomes empty. Texts of any
length are cut whole; other columns, of whatever names, stay in `row`. An empty
table gives no rows. Only built-in functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridclime.llm.common import id_key, stage, text_key
from gridclime.llm.line_chunks import lines_of


def _bound(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _pair(lines: Column, at: Column) -> Column:
    return F.concat(lines[at], F.lit("\n"), lines[at + 1])


def _pair_rows(docs: DataFrame) -> DataFrame:
    """(id, text_key, at, hash) of all pairs; `at` is the first line, from 0."""
    lined = docs.where("instr(text, '\n') > 0").select(id_key().alias("id"), text_key().alias("text_key"), lines_of().alias("lines"))
    hashes = _bound(
        F.struct("lines"),
        lambda a: F.transform(F.sequence(F.lit(0), F.size(a.getField("lines")) - 2), lambda i: F.xxhash64(_pair(a.getField("lines"), i))),
    )
    return lined.select("id", "text_key", F.posexplode(hashes).alias("at", "hash"))


def repeated_pairs(docs: DataFrame) -> DataFrame:
    """(id, text_key, at) of every pair that occurs at an earlier place.

    Pairs are counted and joined by hash alone; only the texts of pairs whose
    hash occurs at two places or more are looked up and compared.
    """
    rows = _pair_rows(docs)
    place = F.struct("id", "text_key", "at")
    found = rows.groupBy("hash").agg(F.min(place).alias("low"), F.max(place).alias("high")).where("low < high").select("hash")
    suspects = rows.join(stage(found).hint("merge"), "hash").groupBy("id", "text_key").agg(F.collect_set("at").alias("places"))
    texts = docs.where("text IS NOT NULL").select(id_key().alias("id"), text_key().alias("text_key"), lines_of().alias("lines"))
    looked_up = _bound(
        F.struct("lines", "places"),
        lambda a: F.transform(a.getField("places"), lambda i: F.struct(i.alias("at"), _pair(a.getField("lines"), i).alias("pair"))),
    )
    pairs = stage(
        texts.join(suspects.hint("merge"), ["id", "text_key"])
        .select("id", "text_key", F.explode(looked_up).alias("p"))
        .select("id", "text_key", F.col("p.at").alias("at"), F.col("p.pair").alias("pair"))
    )
    firsts = stage(pairs.groupBy("pair").agg(F.min(place).alias("low"), F.max(place).alias("high")).where("low < high"))
    return pairs.join(firsts.hint("merge"), "pair").where(place > F.col("low")).select("id", "text_key", "at").distinct()


def dedup_runs(docs: DataFrame) -> DataFrame:
    """All columns of ``docs`` in `row`, and n_lines, lines_removed, kept_text."""
    gone = stage(repeated_pairs(docs).groupBy("id", "text_key").agg(F.collect_set("at").alias("pairs")))
    rows = docs.select(F.struct("*").alias("row"), id_key().alias("id"), text_key().alias("text_key"))
    joined = rows.join(gone.hint("merge"), ["id", "text_key"], "left").select("row", "pairs")

    def kept(a: Column) -> Column:
        lines, pairs = a.getField("lines"), a.getField("pairs")
        both = F.concat(pairs, F.transform(pairs, lambda i: i + 1))
        stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), both)
        return _bound(
            F.struct(lines.alias("lines"), stay.alias("stay")),
            lambda b: F.struct(
                F.size(b.getField("lines")).alias("n_lines"),
                F.size(b.getField("stay")).alias("n_kept"),
                F.array_join(F.transform(b.getField("stay"), lambda i: b.getField("lines")[i]), "\n").alias("text"),
            ),
        )

    none = F.array().cast("array<int>")
    inputs = F.struct(lines_of("row.text").alias("lines"), F.coalesce("pairs", none).alias("pairs"))
    result = F.when(F.col("row.text").isNotNull(), _bound(inputs, kept))
    return joined.withColumn("result", result).select(
        "row",
        F.coalesce("result.n_lines", F.lit(0)).alias("n_lines"),
        F.coalesce(F.col("result.n_lines") - F.col("result.n_kept"), F.lit(0)).alias("lines_removed"),
        F.col("result.text").alias("kept_text"),
    )
