"""Verdicts on URLs by a list of host and path rules.

A URL is read as host (after the first ``://`` up to ``/``, ``?``, ``#`` or the
end, A-Z lower-cased) and path (from there up to ``?``, ``#`` or the end). A
rule fits its host and all subdomains, if the path starts with the rule's path;
of the rules that fit, the one with the most characters wins, on a tie the one
with the longer host, then block before allow. Without a rule the verdict is
``allow``, the method's own.

Each host and path is expanded into expressions, host suffixes at dots times
path prefixes that end in a slash (and the empty one). A rule's anchor is its
host and its path up to the last slash, so every rule that fits has its anchor
among the expressions. Expressions meet anchors by the first 32 bits of their
SHA-256; then full digests, and what a rule's path has after its last slash, are
confirmed. Suffixes of more labels, and prefixes of more slashes, than any rule
has cannot fit and are not made, so a very long URL costs no more than the rules
ask for.

The verdict depends on the host and on as much of the path as the longest rule
has, so each such site is judged once, however many pages share it. Rules are
broadcast up to ``BROADCAST`` of them, counted first, and merged beyond.

NULL URLs and those without ``://`` have an empty host and path; an empty host
fits only rules of an empty host. A rule's NULL host or path counts as empty;
repeated rules count once. Repeated pages, NULL and repeated page ids stay rows
of their own; pages may have columns of any other name but ``host``, ``path``,
``rule`` and ``verdict``, which are replaced. Empty tables give no rows, or
``allow`` where there is no rule. Only built-in functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DEFAULT = "allow"
#: Parts that a site's pages are dealt into where they meet its verdict.
SALTS = 32
#: Rules up to which their table is broadcast: at most some 20 MB.
BROADCAST = 100_000
_MARK = "\x00"  # between host and path in what is hashed; no URL host has it


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def _digest(host: Column, anchor: Column) -> Column:
    return F.sha2(F.concat(host, F.lit(_MARK), anchor), 256)


def _short(digest: Column) -> Column:
    return F.substring(digest, 1, 8)


def _slashes(path: Column) -> Column:
    return F.size(F.split(path, "/", -1)) - 1


def _anchor(path: Column) -> Column:
    """The path up to its last slash, which it includes."""
    return F.regexp_extract(path, "(?s)^(.*/)?", 0)


def anchors(rules: DataFrame) -> DataFrame:
    """(short, digest, r_host, r_path, r_verdict) of distinct rules (host, path, verdict)."""
    host = F.translate(F.coalesce("host", F.lit("")), UPPER, LOWER)
    path = F.coalesce("path", F.lit(""))
    plain = rules.select(host.alias("r_host"), path.alias("r_path"), F.col("verdict").alias("r_verdict")).distinct()
    found = plain.withColumn("digest", _digest(F.col("r_host"), _anchor(F.col("r_path"))))
    return found.withColumn("short", _short(F.col("digest")))


def expressions(sites: DataFrame, labels: Column | int, slashes: Column | int) -> DataFrame:
    """Sites (host, head) once per expression, with its ``short`` and ``digest``.

    ``labels`` and ``slashes`` are the most that any rule has.
    """
    labels, slashes = (v if isinstance(v, Column) else F.lit(v) for v in (labels, slashes))
    names = F.split("host", r"\.", -1)
    parts = F.split("head", "/", -1)
    bound = sites.withColumns({"_names": names, "_parts": parts})
    last = F.size("_names")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.least(last, labels)),
        lambda n: F.array_join(F.slice("_names", last - n + 1, n), "."),
    )
    counted = F.sequence(F.lit(0), F.least(F.size("_parts") - 1, slashes))
    prefixes = F.transform(
        counted,
        lambda n: F.concat(F.array_join(F.slice("_parts", F.lit(1), n), "/"), F.when(n > 0, F.lit("/")).otherwise(F.lit(""))),
    )
    rows = bound.withColumns({"suffix": F.explode(suffixes)}).withColumn("prefix", F.explode(prefixes))
    rows = rows.withColumn("digest", _digest(F.col("suffix"), F.col("prefix")))
    return rows.select("host", "head", _short(F.col("digest")).alias("short"), "digest")


def judge(pages: DataFrame, rules: DataFrame, broadcast_limit: int = BROADCAST) -> DataFrame:
    """All columns of ``pages``, and host, path, rule, verdict."""
    held = anchors(rules)
    sizes = held.agg(
        F.count("*").alias("n"),
        F.max(F.size(F.split("r_host", r"\.", -1))).alias("labels"),
        F.max(_slashes(F.col("r_path"))).alias("slashes"),
        F.max(F.length("r_path")).alias("chars"),
    ).first()  # four numbers
    host, path = host_and_path(F.col("url"))
    taken = {"host", "path", "rule", "verdict"}
    row = F.struct(*[F.col(f"`{c}`") for c in pages.columns if c not in taken]).alias("row")
    read = pages.select(row, host.alias("host"), path.alias("path"))
    if not sizes["n"]:
        return read.select("row.*", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(DEFAULT).alias("verdict"))
    head = F.substring("path", 1, max(1, sizes["chars"]))
    sites = read.select("host", head.alias("head")).distinct()
    held = F.broadcast(held) if sizes["n"] <= broadcast_limit else held.hint("merge")
    # The 32 bits find candidates; the digest and the rest of the path confirm them.
    met = expressions(sites, sizes["labels"], sizes["slashes"]).withColumnRenamed("digest", "own").join(held, "short")
    fits = met.where((F.col("own") == F.col("digest")) & F.startswith("head", F.col("r_path")))
    rank = F.struct(
        (F.length("r_host") + F.length("r_path")).alias("chars"),
        F.length("r_host").alias("host_chars"),
        F.col("r_verdict").alias("verdict"),
        F.concat("r_host", "r_path").alias("rule"),
    )
    best = fits.groupBy("host", "head").agg(F.max(rank).alias("best"))
    # A site may hold any share of the pages: its pages are dealt over salts, and each salt has the verdict.
    salts = F.array(*[F.lit(i) for i in range(SALTS)])
    dealt = read.withColumns({"head": head, "salt": F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int")})
    found = dealt.join(best.withColumn("salt", F.explode(salts)).hint("merge"), ["host", "head", "salt"], "left")
    return found.select(
        "row.*", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(DEFAULT)).alias("verdict")
    )
