"""Each operator against a brute-force version on a small table with every odd case."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
import tiktoken
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from gridclime.llm import (
    catalog,
    components,
    exact_mph,
    fair_mix,
    line_chunks,
    line_runs,
    pieces,
    quality,
    quartile_digest,
    relative_lz,
    shuffle_shards,
    simhash,
    training_order,
)
from gridclime.llm.common import text_bytes, words_of
from gridclime.llm.feistel import Feistel

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, row string, id long, hash long, slot long"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def prose(rng: random.Random, n: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" + rng.choice(["", "", ".", ",\n", "é"]) for _ in range(n))


@pytest.fixture(scope="module")
def rows() -> list[tuple]:
    """NULLs, empty and blank texts, a very long one, copies, near copies, shared passages, repeated rows and ids."""
    rng = random.Random(4)
    passage = prose(rng, 40)
    lines = "\n".join(prose(rng, 6) for _ in range(12))
    texts = [None, "", "  \t\n", "a", "A", prose(rng, 20_000), lines, "x\n" + lines, lines + "\ny", "one two three"]
    texts += [prose(rng, 60) + " " + passage + " " + prose(rng, 30) for _ in range(12)]
    texts += [prose(rng, 30) + "\n" + lines + "\n" + prose(rng, 8) for _ in range(6)]
    base = prose(rng, 300)
    texts += [base] * 5 + [base.upper()] + [base + f" tail{i}" for i in range(8)]
    texts += ["tick tock " * 50, "tick tock " * 50, "日本 語 " * 30, "ſ İ K"]
    out = [(i * 3, t) for i, t in enumerate(texts)]
    out += [out[5], out[12], (out[14][0], "another text under an id that is taken"), (None, base), (None, None)]
    rng.shuffle(out)
    sources = [None, "b", "a", "Z", "é"]
    return [(d, t, "en", sources[(d or 7) % 5], None if t is None else len(t), "x", 1, 2, 3) for d, t in out]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, COLUMNS).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], COLUMNS)


def key(doc_id):
    return -(2**63) if doc_id is None else doc_id


def test_words_of_texts_that_lie_end_to_end():
    texts = ["ab c", "", "d", "  e\x0bf\x85g "]
    data, ends = text_bytes(pa.array(texts))
    starts, stops, own = words_of(data, ends)
    got = [(int(t), data[a:b].tobytes()) for a, b, t in zip(starts, stops, own, strict=True)]
    assert got == [(i, w.encode()) for i, t in enumerate(texts) for w in WORDS.findall(t)]


# ------------------------------------------------------------------ 1


def test_digest_against_plain_counting():
    text = prose(random.Random(1), 500).encode()
    counts = np.zeros(quartile_digest.BUCKETS, dtype=int)
    for at in range(4, len(text)):
        for (i, j), (a, b, c) in zip(quartile_digest.TRIPLETS, quartile_digest._TABLES.astype(int), strict=True):
            counts[(a[text[at]] + b[text[at - i]] + c[text[at - j]]) % 256] += 1
    q = np.sort(counts)[[63, 127, 191]]
    want = [sum(int(x > y) for y in q) for x in counts]
    got = quartile_digest.digests([b"other text", text, b"abc"])[1][2:]
    assert [int(byte) >> s & 3 for byte in got for s in (6, 4, 2, 0)] == want


def test_digest_likeness():
    a, b, c = quartile_digest.digests([b"abc", b"abd", b"abc"])
    assert quartile_digest.likeness(a[None], c[None])[0] == 1
    assert 0 <= quartile_digest.likeness(a[None], b[None])[0] < 0.5


def test_fingerprints_with_next(docs, rows):
    got = sorted((tuple(r) for r in quartile_digest.with_next(docs, 4).collect()), key=str)
    order = sorted(rows, key=lambda r: (-key(r[0]), (r[1] or "").encode()))
    want = []
    for i, r in enumerate(order):
        text, following = r[1] or "", order[(i + 1) % len(order)][1] or ""
        cut = len(text) // 3
        edited = text[: len(text) - cut] + following[:cut]
        own, other, after = (quartile_digest.digests([t.encode()]) for t in (text, edited, following))
        want.append((r[0], len(text), hashlib.sha256(edited.encode()).hexdigest(), own[0].tobytes().hex(), other[0].tobytes().hex(),
                     float(quartile_digest.likeness(own, other)[0]), float(quartile_digest.likeness(own, after)[0])))
    assert got == sorted(want, key=str)


def test_fingerprints_of_one_and_of_none(spark, docs, empty):
    assert quartile_digest.with_next(empty).count() == 0
    one = quartile_digest.with_next(docs.where("doc_id = 30")).collect()
    assert len(one) == 1 and one[0].near_next == 1


# ------------------------------------------------------------------ 2


def test_context_sums_against_loops():
    rng = np.random.default_rng(1)
    slots, text = rng.integers(0, quality.SLOTS, 40), np.sort(rng.integers(0, 5, 40))
    want = np.zeros((quality.SLOTS, quality.DIMENSIONS), dtype=int)
    for i in range(40):
        for j in range(max(0, i - quality.REACH), min(40, i + quality.REACH + 1)):
            if text[i] == text[j]:
                for d, s in zip(quality._WHERE[slots[j]], quality._SIGN[slots[j]], strict=True):
                    want[slots[i], d] += s
    assert (quality.context_sums(slots, text) == want).all()


def test_quality_learns_and_holds_out(spark):
    rng = random.Random(2)
    good = ["the of and " + prose(rng, 30) for _ in range(300)]
    bad = [" ".join(w + "###" for w in prose(rng, 30).split()) for _ in range(150)]
    table = [(i, t, int(i < 300)) for i, t in enumerate(good + bad)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in table] + [(900, None), (901, ""), (5, table[5][1])], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y if zlib.crc32(str(i).encode()) % 4 != 2 else 1 - y) for i, _, y in table] + [(5, None), (77777, 1)], "doc_id long, quality int")
    scores = {r.doc_id: r for r in quality.score(docs, *quality.fit(docs, labels)).withColumn("out", quality.held_out()).collect()}
    assert len(scores) == 452 and all(0 <= r.score <= 1 for r in scores.values())
    held = [(r.score >= 0.5) == bool(y) for i, _, y in table if (r := scores[i]).out]
    assert len(held) > 60 and np.mean(held) > 0.95  # the held-out labels are wrong on purpose
    assert scores[900].score == scores[901].score


def test_quality_without_labels(spark, docs, empty):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in quality.score(docs, *quality.fit(docs, none)).collect()} == {0.5}
    assert quality.score(empty, *quality.fit(empty, none)).count() == 0


# ------------------------------------------------------------------ 3


def spans_by_hand(lines):
    """(first, size) of the chunks of every cutting."""
    hashes = [int(hashlib.md5(x.encode()).hexdigest()[:8], 16) for x in lines]
    n, out = len(lines), set()
    for one, two in line_chunks.FACTORS if n > 1 else ():
        rolling = [(hashes[i] * one + hashes[i + 1] * two) % line_chunks.PRIME for i in range(n - 1)] + [line_chunks.PRIME]
        bounds = [0, *[i for i in range(2, n - 1) if rolling[i - 1] > rolling[i] <= rolling[i + 1]], n]
        for a, b in zip(bounds, bounds[1:]):
            starts = list(range(a, b - 1, 2))
            out |= {(s, t - s) for s, t in zip(starts, [*starts[1:], b])}
    return out


def kept_by_hand(documents):
    """For each (id, text) the number of chunks and the lines that stay; documents are in order."""
    first, gone = {}, defaultdict(set)
    split = [d[-1].split("\n") for d in documents]
    places = sorted((d, s, n) for d, lines in enumerate(split) for s, n in spans_by_hand(lines))
    for d, s, n in places:
        first.setdefault("\n".join(split[d][s : s + n]), (d, s))
    for d, s, n in places:
        e, t = first["\n".join(split[d][s : s + n])]
        if (e, t) == (d, s):
            continue
        mine, theirs = split[d], split[e]
        left = next((k for k in range(line_chunks.REACH) if s - k < 1 or t - k < 1 or mine[s - k - 1] != theirs[t - k - 1]), line_chunks.REACH)
        right = next((k for k in range(line_chunks.REACH) if mine[s + n + k : s + n + k + 1] != theirs[t + n + k : t + n + k + 1] or s + n + k >= len(mine)), line_chunks.REACH)
        gone[d] |= set(range(s - left, s + n + right))
    return [(len(spans_by_hand(lines)), [x for i, x in enumerate(lines) if i not in gone[d]]) for d, lines in enumerate(split)]


def test_line_dedup(docs, rows, empty):
    got = Counter((r.row.doc_id, r.row.text, r.n_lines, r.n_chunks, r.lines_removed, r.kept_text) for r in line_chunks.dedup_lines(docs).collect())
    documents = sorted({(key(r[0]), xxhash.xxh64_intdigest(r[1].encode(), 42), r[1]) for r in rows if r[1] is not None}, key=lambda d: (d[0], d[1] - (d[1] >> 63 << 64)))
    kept = {(d[0], d[2]): k for d, k in zip(documents, kept_by_hand(documents), strict=True)}
    want = Counter()
    for r in rows:
        if r[1] is None:
            want[(r[0], None, 0, 0, 0, None)] += 1
            continue
        chunks, stay = kept[key(r[0]), r[1]]
        lines = r[1].count("\n") + 1
        want[(r[0], r[1], lines, chunks, lines - len(stay), "\n".join(stay))] += 1
    assert got == want and any(k[4] for k in want)
    assert line_chunks.dedup_lines(empty).count() == 0


def test_line_dedup_removes_planted_passages(spark):
    """Of passages of four lines and more, at least 0.9 of the lines go, and no line beside them; copies become empty."""
    rng = random.Random(9)
    line = lambda: f"line {rng.getrandbits(64)}"
    rows, planted, alone = [], {}, {}
    for length in (4, 5, 6, 8, 10, 40):
        for _ in range(30):
            passage = [line() for _ in range(length)]
            for _ in range(2):
                head, tail = ([line() for _ in range(rng.randrange(1, 12))] for _ in range(2))
                alone[len(rows)] = head + tail
                rows.append((len(rows), "\n".join(head + passage + tail)))
            planted[len(rows) - 1] = passage
    copies = {len(rows) + i: text for i, (_, text) in enumerate(rows[:40])}
    rows += list(copies.items())
    rows.append((len(rows), "a text\nof lines that\nstand nowhere else\n" + line()))
    got = {r.row.doc_id: r.kept_text.split("\n") for r in line_chunks.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    left = sum(len(set(got[d]) & set(p)) for d, p in planted.items())
    assert left <= 0.1 * sum(map(len, planted.values()))
    assert all(set(lines) <= set(got[d]) for d, lines in alone.items())
    assert all(got[d] == [""] for d in copies)
    assert got[len(rows) - 1] == rows[-1][1].split("\n")


def test_repeated_lines(docs, rows, empty):
    got = Counter((r.row.doc_id, r.row.text, r.n_lines, r.lines_removed, r.kept_text) for r in line_runs.dedup_runs(docs).collect())
    seen, kept = set(), {}
    documents = {(key(r[0]), xxhash.xxh64_intdigest(r[1].encode(), 42), r[1]) for r in rows if r[1] is not None}
    for d in sorted(documents, key=lambda d: (d[0], d[1] - (d[1] >> 63 << 64))):
        lines, gone = d[2].split("\n"), set()
        for i, pair in enumerate(zip(lines, lines[1:])):
            gone |= {i, i + 1} if pair in seen else set()
            seen.add(pair)
        kept[d[0], d[2]] = (len(lines), len(gone), "\n".join(x for i, x in enumerate(lines) if i not in gone))
    want = Counter((r[0], r[1], *((0, 0, None) if r[1] is None else kept[key(r[0]), r[1]])) for r in rows)
    assert got == want and any(k[3] for k in want)
    assert line_runs.dedup_runs(empty).count() == 0


def test_repeated_lines_of_planted_passages(spark):
    rng = random.Random(8)
    line = lambda: f"line {rng.getrandbits(64)}"
    texts, want = [], []
    for length in (2, 3, 4, 6, 10, 40):
        passage, first, head, tail = ([line() for _ in range(n)] for n in (length, 3, 4, 5))
        texts += [first + passage + [line()], head + passage + tail, passage, passage + [line()]]
        want += [texts[-4], head + tail, [], texts[-1][-1:]]
    rows = [(i, "\n".join(t)) for i, t in enumerate(texts)]
    got = line_runs.dedup_runs(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.row.doc_id: r.kept_text for r in got} == {i: "\n".join(t) for i, t in enumerate(want)}


# ------------------------------------------------------------------ 4


def test_substring_dedup(docs, rows, empty):
    got = Counter((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in relative_lz.dedup_substrings(docs).collect())
    words = [(r[0], WORDS.findall(r[1] or "")) for r in rows]
    first: dict = {}
    for d, w in words:
        for i in range(len(w) - 12):
            k = tuple(w[i : i + 13])
            first[k] = min(first.get(k, 2**63), key(d))
    want = Counter()
    for d, w in words:
        gone = {p for i in range(len(w) - 12) if first[tuple(w[i : i + 13])] < key(d) for p in range(i, i + 13)}
        want[(d, len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone))] += 1
    assert got == want and sum(k[2] for k in want) > 100
    assert relative_lz.dedup_substrings(empty).count() == 0


def test_windows_that_straddle_factors(spark):
    """Two documents share halves with the first ones, and whole windows across the halves only with a third."""
    w = [f"q{i}" for i in range(60)]
    texts = [" ".join(w[:20]) + " end", "start " + " ".join(w[20:]), " ".join(w[10:30]), " ".join(w)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    removed = {r.doc_id: r.n_removed for r in relative_lz.dedup_substrings(docs).collect()}
    assert removed == {0: 0, 1: 0, 2: 0, 3: 60}


# ------------------------------------------------------------------ 5


def test_tokens_equal_the_library():
    coder = training_order.Tokens(open(training_order.RANKS, "rb").read())
    rng = random.Random(3)
    odd = "\x1c\x1f\x85\xa0\u1680\u2000\u200a\u2028\u2029\u202f\u205f\u3000«“→ㅤ"
    texts = ["".join(rng.choice("ab cd  \n\t.,'s\xa0é中😀01|# \x1c\r") for _ in range(rng.randrange(50))) for _ in range(500)] + ["", " "]
    texts += ["".join(rng.choice("ab  c" + c) for _ in range(20)) for c in odd for _ in range(8)] + [c for c in odd]
    data, ends = text_bytes(pa.array(texts))
    ids, bounds = coder.encode(data, ends)
    want = [coder.coder.encode_ordinary(t) for t in texts]
    assert [ids[bounds[i] : bounds[i + 1]].tolist() for i in range(len(texts))] == want
    coder.memory.most = 300  # drops what it holds again and again
    for at in range(0, len(texts), 25):
        data, ends = text_bytes(pa.array(texts[at : at + 25]))
        ids, bounds = coder.encode(data, ends)
        assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == want[at : at + 25]


def test_shards_hold_every_token_once(spark, docs, rows, empty, tmp_path):
    path = str(tmp_path / "shards")
    index = {r.slot: r for r in training_order.write_shards(docs, path, length=64, records=16).collect()}
    stored = {r.slot: r for r in training_order.read_shards(spark, path).collect()}
    assert sorted(index) == sorted(stored) == list(range(len(index)))
    coder = training_order.Tokens(open(training_order.RANKS, "rb").read())
    want = Counter(t for r in rows for t in [*coder.coder.encode_ordinary(r[1] or ""), coder.end])
    got = Counter(t for s, r in stored.items() for t in np.frombuffer(r.tokens, "<u2")[: index[s].n_tokens].tolist())
    assert got == want
    for r in index.values():
        name = next((tmp_path / "shards").glob(f"shards/*/shard={r.shard}/part-*"))
        assert name.read_bytes()[r.byte_offset :][:128] == bytes(stored[r.slot].tokens) and r.byte_offset == r.record * 129
    again = {r.slot: r.doc_ids for r in training_order.write_shards(docs.repartition(3), str(tmp_path / "b"), length=64, records=16).collect()}
    assert again == {s: r.doc_ids for s, r in index.items()}
    for slot in (0, 5, 16, len(index) - 1):
        read = list(training_order.read_from(spark, path, slot, ahead=3))
        assert [s for s, _ in read] == list(range(slot, len(index)))
        assert all(t.tobytes() == bytes(stored[s].tokens) for s, t in read)
    assert training_order.write_shards(empty, str(tmp_path / "none")).count() == 0
    assert training_order.read_shards(spark, str(tmp_path / "none")).count() == 0
    assert list(training_order.read_from(spark, str(tmp_path / "none"))) == []


def test_shards_of_other_sequences_are_refused(spark, docs, tmp_path):
    path = str(tmp_path / "shards")
    write = lambda rows, **how: training_order.write_shards(rows, path, **({"length": 64, "records": 16} | how)).count()
    n = write(docs, key=1)
    files = sorted((f, f.stat().st_mtime_ns) for f in (tmp_path / "shards").rglob("part-*"))
    assert write(docs.repartition(2), key=1) == n  # the same: nothing is written again
    assert sorted((f, f.stat().st_mtime_ns) for f in (tmp_path / "shards").rglob("part-*")) == files
    for rows, how in ((docs, {"key": 2}), (docs, {"key": 1, "records": 8}), (docs.where("doc_id > 9"), {"key": 1})):
        with pytest.raises(ValueError, match="other shards"):
            write(rows, **how)


def test_queries_of_empty_tables(spark, empty, tmp_path):
    empty.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(str(tmp_path / "documents.parquet"))
    for name in ("op3_line_dedup", "op5_training_order", "op13_lexical_search"):
        spark.createDataFrame([(1, "a b")], "item_id long, text string").write.mode("overwrite").parquet(str(tmp_path / "benchmark.parquet"))
        assert catalog.QUERIES[name](spark, str(tmp_path)).count() == 0


# ------------------------------------------------------------------ 6


def plain_simhash(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(pairs, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("hot", [256, 1])
def test_simhash(docs, rows, hot):
    got = Counter((r.doc_id, r.fp % 2**64, r.component) for r in simhash.near_duplicates(docs, hot=hot).collect())
    marks = [(key(r[0]), plain_simhash(r[1])) for r in rows]
    prints = sorted({f for _, f in marks})
    linked = roots([(a, b) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= 2], prints)
    low = {}
    for d, f in marks:
        low[linked[f]] = min(d, low.get(linked[f], 2**63))
    assert got == Counter((r[0], f, low[linked[f]]) for r, (_, f) in zip(rows, marks, strict=True))


@pytest.mark.parametrize("hot", [256, 2])
def test_links_connect_all_near_fingerprints(spark, hot):
    rng = random.Random(9)
    prints = {rng.getrandbits(64) for _ in range(20)}
    for p in list(prints):
        for _ in range(15):
            for _ in range(rng.randrange(1, 4)):
                p ^= 1 << rng.randrange(64)
            prints.add(p)
    signed = sorted(p - (p >> 63 << 64) for p in prints)
    frame = spark.createDataFrame([(p,) for p in signed], "fp long")
    found = {r.node: r.root for r in components.components(simhash.links(frame, hot=hot)).collect()}
    want = roots([(a, b) for a in signed for b in signed if a < b and ((a ^ b) % 2**64).bit_count() <= 2], signed)
    assert {p: found.get(p, p) for p in signed} == want


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 300), (300, 300)], "a long, b long")
    found = {r.node: r.root for r in components.components(links).collect()}
    assert found == {i: 0 for i in range(201)} | {300: 300, 500: 300}


def test_keep_one(docs, empty):
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    found = simhash.near_duplicates(docs)
    assert sorted(key(r.doc_id) for r in kept.collect()) == sorted(r.component for r in found.select("component").distinct().collect())
    assert simhash.keep_one(empty).count() == 0


# ------------------------------------------------------------------ 7


@pytest.mark.parametrize("size", [0, 1, 2, 5, 64, 1000])
def test_feistel_is_a_permutation(size):
    numbers = np.arange(size)
    for seed in (1, 2):
        image = Feistel(size, seed).permute(numbers)
        assert sorted(image.tolist()) == numbers.tolist()
        assert (Feistel(size, seed).invert(image) == numbers).all()


def test_sharding(docs, rows, empty):
    got = shuffle_shards.shard(docs, 4).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter(
        (r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows
    )
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
        assert shuffle_shards.row_at(np.array([r.shard]), np.array([r.slot]), len(rows), 4, 20260)[0] == r.row_number
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    again = shuffle_shards.shard(docs.repartition(2), 4).collect()
    assert Counter(map(str, again)) == Counter(map(str, got))
    assert shuffle_shards.shard(empty).count() == 0


# ------------------------------------------------------------------ 8


def test_minimal_perfect_hash():
    rng = np.random.default_rng(3)
    known, strange = (np.frombuffer(rng.bytes(32 * n), dtype=">u8").reshape(-1, 4).astype(np.uint64) for n in (3000, 500))
    levels, slots = exact_mph.build_hash(known)
    assert sorted(slots.tolist()) == list(range(3000))
    assert (exact_mph.slots_of(known, levels) == slots).all()
    assert (exact_mph.slots_of(strange, levels) < 3000).all()


@pytest.mark.parametrize("cut", [-1, 40, 10**6])
def test_exact_dedup(docs, rows, cut):
    older = F.col("doc_id").isNull() | (F.col("doc_id") <= cut)
    got = Counter(tuple(r)[:5] for r in exact_mph.dedup(docs.where(older), docs.where(~older)).collect())
    lower = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    groups = defaultdict(list)
    for r in rows:
        groups[lower(r[1])].append(key(r[0]))
    want = Counter()
    for r in rows:
        g = groups[lower(r[1])]
        top = max(g)
        want[(r[0], None if top == key(None) else top, len(g), key(r[0]) == top, hashlib.sha256(lower(r[1]).encode()).hexdigest())] += 1
    assert got == want


def test_equal_digests_of_different_texts_are_told_apart(docs, rows, monkeypatch):
    """With a digest that knows only the length, the byte check alone makes the groups."""
    monkeypatch.setattr(exact_mph.F, "sha2", lambda text, bits: F.lpad(F.hex(F.length(text)), 64, "0"))
    some = docs.where("doc_id < 60")
    got = {(r.doc_id, r.keep_id, r.group_size) for r in exact_mph.dedup(some.where("doc_id < 30"), some.where("doc_id >= 30")).collect()}
    lower = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    groups = defaultdict(list)
    for r in rows:
        if r[0] is not None and r[0] < 60:
            groups[lower(r[1])].append(r[0])
    assert got == {(d, max(g), len(g)) for g in groups.values() for d in g}


def test_exact_dedup_of_nothing(empty):
    assert exact_mph.dedup(empty, empty).count() == 0


# ------------------------------------------------------------------ 9


def test_pieces_equal_the_library(spark, docs, rows):
    model = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    coded = pieces.decode(pieces.encode(docs)).collect()
    assert len(coded) == len(rows)
    for r in coded:
        assert r.piece_ids == (None if r.text is None else model.encode(r.text))
        assert r.decoded == r.text


def test_pieces_of_odd_texts():
    model = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    own = pieces.Pieces(open(pieces.MODEL, "rb").read())
    rng = random.Random(8)
    texts = ["".join(rng.choice("the in er  \n\t.,▁éß中😀0<>|#") for _ in range(rng.randrange(60))) for _ in range(800)]
    texts += ["", " ", " " * 40 + "x", "x" * 3000, "\x00a", "<s></s><unk><0x0A>", "▁▁ ▁"]
    data, ends = text_bytes(pa.array(texts))
    ids, bounds = own.encode(data, ends)
    for i, t in enumerate(texts):
        assert ids[bounds[i] : bounds[i + 1]].tolist() == model.encode(t)
        assert own.decode(ids[bounds[i] : bounds[i + 1]]) == t.replace("▁", " ")


def test_pieces_of_nothing(empty):
    assert pieces.decode(pieces.encode(empty)).count() == 0


# ------------------------------------------------------------------ 10


def plain_targets(sizes: dict, weights=(3, 1, 2)) -> dict:
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    budget, target, open_ = 1.5 * sum(sizes.values()), {}, set(order)
    while open_:
        level = (budget - sum(target.values())) / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > 2 * sizes[s]}
        if not over:
            return target | {s: level * weight[s] for s in open_}
        target |= {s: 2.0 * sizes[s] for s in over}
        open_ -= over
    return target


def test_mixing(docs, rows, empty):
    got = fair_mix.mix(docs, rows_a_bucket=4).collect()
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len(WORDS.findall(r[1] or ""))
    target = plain_targets(sizes)
    assert Counter((r.doc_id, r.source, r["size"]) for r in got) == Counter((r[0], r[3], len(WORDS.findall(r[1] or ""))) for r in rows)
    taken = Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and math.isclose(r.target, target[r.source])
        assert r.taken in (0, r["size"], 2 * r["size"])
        taken[r.source] += r.taken
    assert sum(taken.values()) <= 1.5 * sum(sizes.values())
    longest = max(r["size"] for r in got)
    assert all(abs(taken[s] - target[s]) <= longest for s in target)
    again = fair_mix.mix(docs.repartition(2), rows_a_bucket=1000).collect()  # the layout changes nothing
    assert Counter((r.doc_id, r.text_key, r.taken) for r in again) == Counter((r.doc_id, r.text_key, r.taken) for r in got)
    assert fair_mix.mix(empty).count() == 0


def test_mixed_rows_are_taken_as_often_as_said(docs, empty):
    said = Counter()
    for r in fair_mix.mix(docs).collect():
        said[(r.doc_id, r.text_key, r.source)] += r.copies
    rows = fair_mix.mixed(docs)
    assert rows.columns == docs.columns
    found = Counter((r.doc_id, r.k, r.source) for r in rows.withColumn("k", F.xxhash64("text")).select("doc_id", "k", "source").collect())
    assert found == +said
    assert fair_mix.mixed(empty).count() == 0


# ------------------------------------------------------------------ pipeline


def test_pipeline_against_its_parts(spark, docs, rows, tmp_path):
    labels = [(r[0], int("tick" not in (r[1] or "")), 0) for r in rows if r[0] is not None]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    before = docs
    for name, work in corpus_pipeline.STAGES[:-1]:
        after = work(spark, before, str(tmp_path))
        assert after.columns == before.columns, name
        if name == "quality_classifier":
            scores = quality.score(before, *quality.fit(before, spark.read.parquet(str(tmp_path / "labels.parquet"))))
            assert after.count() == scores.where(F.col("score") >= 0.7).count() > 0
        if name == "line_dedup":
            assert sorted(str(r.text) for r in after.collect()) == sorted(str(r.kept_text) for r in line_chunks.dedup_lines(before).collect())
        path = str(tmp_path / name)
        after.write.parquet(path)
        before = spark.read.parquet(path)
    last = corpus_pipeline.STAGES[-1][1](spark, before, str(tmp_path)).collect()
    assert len(last) == before.count() and all(r.n_pieces == len(r.piece_ids or []) for r in last)


def test_pipeline_leaves_one_of_exact_copies(spark, tmp_path):
    rng = random.Random(12)
    rows = []
    for length in (2, 3, 5, 10, 40):
        for _ in range(4):
            text = "\n".join(" ".join(f"{rng.getrandbits(32):x}" for _ in range(8)) for _ in range(length))
            rows += [(len(rows) + i, text, "en", "a", len(text)) for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.selectExpr("doc_id", "1 AS quality", "0 AS toxic").write.parquet(str(tmp_path / "labels.parquet"))
    for name, work in corpus_pipeline.STAGES[:3]:
        docs = work(spark, docs, str(tmp_path))
    left = {r.doc_id: (r.text, r.n_chars) for r in docs.where("text <> ''").collect()}
    assert left == {r[0]: (r[1], r[4]) for r in rows[::3]}
    assert {r.doc_id for r in corpus_pipeline.mixing(spark, docs, str(tmp_path)).collect()} <= set(left)


def test_pipeline_of_nothing(spark, empty, tmp_path):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    rows = empty
    for _, work in corpus_pipeline.STAGES:
        rows = work(spark, rows, str(tmp_path))
    assert rows.count() == 0


def test_tokeniser_pattern_is_the_published_one():
    assert tiktoken.Encoding("p", pat_str=training_order.PATTERN, mergeable_ranks={bytes([b]): b for b in range(256)}, special_tokens={}).encode_ordinary("a") == [97]
