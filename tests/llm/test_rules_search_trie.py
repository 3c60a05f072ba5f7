"""URL rules, lexical search and the conversation trie against brute force on small tables with every odd case."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gridclime.llm import catalog, fp_search, prefix_trie, url_rules
from gridclime.llm.common import text_bytes

# ------------------------------------------------------------------ 11


def rebuilt_by_hand(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            mark = f"{len(role.encode())}:{role}{text}"
            own[conv].append((turn is not None, turn or 0, hashlib.sha256(mark.encode()).hexdigest(), role, text))
    own = {c: [x[3:] for x in sorted(v)] for c, v in own.items()}
    out = {}
    for c, turns in own.items():
        base, h = c - math.fmod(c, 5), zlib.crc32(str(c).encode()) % 9
        out[c] = turns if base == c else own.get(int(base), [])[:h] + turns[h:]
    return out


def trie_by_hand(rows):
    members, ends = defaultdict(set), defaultdict(list)
    for c, turns in rebuilt_by_hand(rows).items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].add(c)
        ends[tuple(turns)].append(c)
    out = []
    for node, convs in members.items():
        below = [n for n in members if n[: len(node)] == node]
        saved = sum((len(members[n]) - 1) * len(n[-1][1].encode()) for n in below if n)
        leaves = [n for n in below if not any(len(m) == len(n) + 1 and m[:-1] == n for m in below)]
        children = [n for n in below if len(n) == len(node) + 1]
        listed = ",".join(str(c) for c in sorted(ends.get(node, [])))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(convs), len(node), parent, len(convs), len(children), len(leaves), saved, hashlib.sha256(listed.encode()).hexdigest()))
    return sorted(out, key=str)


CONVERSATION = "conv_id long, turn long, role string, text string, depth string, k1 int, part string"


@pytest.fixture(scope="module")
def conversations():
    rng = random.Random(11)
    rows = []
    for c in [*range(60), 1000, 1001, 1004, 2003, -5, -3, -1, 10**12]:
        n = rng.choice([1, 1, 2, 3, 4, 9, 12])
        rows += [(c, t, rng.choice(["user", "assistant", None]), rng.choice(["a", "b", "é", "", None, "long " * 50])) for t in range(n)]
    rows += [(70, t, "user", f"turn {t % 7}") for t in range(700)]  # far longer than a block of the test
    rows += [(c, t, "user", "same") for c in range(100, 180, 5) for t in range(10)]  # copies
    rows += [(c, 0, "user", "x") for c in (201, 202, 203)]  # their base is absent; some become turnless
    rows += [(300, None, "user", "n"), (300, None, "user", "m"), (300, 1, "user", "k"), (300, 1, "user", "k"), (None, 1, "user", "lost")]
    rng.shuffle(rows)
    return rows


def test_trie_against_brute_force(spark, conversations):
    table = spark.createDataFrame([(*r, "x", 1, "y") for r in conversations], CONVERSATION).repartition(7)
    got = sorted((tuple(r) for r in prefix_trie.trie(table).collect()), key=str)
    assert got == trie_by_hand(conversations)


def test_trie_blocks_and_pieces_have_no_influence(spark, conversations):
    table = spark.createDataFrame([(*r, "x", 1, "y") for r in conversations], CONVERSATION)
    turns, parts = prefix_trie.numbered(table)
    _, rebuilt = prefix_trie.rebuild(turns, parts)
    small = {tuple(r) for r in prefix_trie.prefixes(rebuilt, block=3).collect()}
    assert small == {tuple(r) for r in prefix_trie.prefixes(rebuilt).collect()}
    members = spark.createDataFrame([(1, 7, 7, c) for c in range(50)] + [(1, 8, 7, 3)], "depth long, k1 long, k2 long, conv_id long")
    want = {(7, hashlib.sha256(",".join(map(str, range(50))).encode()).hexdigest()), (8, hashlib.sha256(b"3").hexdigest())}
    assert {(r.k1, r.ends_sha256) for r in prefix_trie.end_hashes(members, piece=4).collect()} == want


def test_trie_of_empty_and_turnless_tables(spark):
    assert prefix_trie.trie(spark.createDataFrame([], CONVERSATION)).count() == 0
    turnless = next(c for c in range(1, 1000) if c % 5 and zlib.crc32(str(c).encode()) % 9)
    (only,) = prefix_trie.trie(spark.createDataFrame([(turnless, 0, "user", "t", "", 0, "")], CONVERSATION)).collect()
    assert tuple(only) == (turnless, 0, None, 1, 0, 1, 0, hashlib.sha256(str(turnless).encode()).hexdigest())


# ------------------------------------------------------------------ 12


def site_by_hand(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, tail = rest[:end], rest[end:]
    stop = min([tail.find(c) for c in "?#" if c in tail], default=len(tail))
    return host.translate(str.maketrans(url_rules.UPPER, url_rules.LOWER)), tail[:stop]


def verdict_by_hand(url, rules):
    host, path = site_by_hand(url)
    fit = [(len(h + p), len(h), v, h + p) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, max(fit)[3], max(fit)[2]) if fit else (host, path, None, "allow")


URLS = [
    None, "", "no scheme", "http://", "http://NET", "http://net/", "https://a.NET/x?y#z", "ftp://example.net/en/", "x://a.example.net/en/q",
    "x://badexample.net/en/q", "http://example.com/de", "http://example.com/de/", "http://EXAMPLE.com/De/", "http://a.org/fr/b/c/d?e=/f",
    "http://a.org?fr/", "http://a.org#/fr/", "http://u@b.org:80/fr/", "http://é.org/fr/É", "a://b://net/x", "http://a..net/", "http://.net/",
    "http://net./", "http:///en/", "http://" + "a." * 3000 + "net/" + "b/" * 3000, "http://x.net/en/a\nb", "http://x.net/en/\x00",
]
MANY = [*catalog.URL_RULES, ("allow", "net", "/en"), ("block", "a.b", ""), ("block", "b", "/x/yy"), ("allow", "a.b", "/x/y"), ("allow", "", "/en/"), ("allow", "net", "/en"), ("block", "org", "/fr/")]


@pytest.mark.parametrize("limit", [url_rules.BROADCAST, 0])
def test_verdicts_against_brute_force(spark, limit):
    rng = random.Random(12)
    urls = URLS * 2 + [
        f"http://{'.'.join(rng.choices(['a', 'b', 'net', 'example', 'com', 'org'], k=rng.randrange(1, 5)))}{rng.choice(['', '/'])}{'/'.join(rng.choices(['x', 'yy', 'en', 'de', 'fr', 'e'], k=rng.randrange(4)))}{rng.choice(['', '/', '?q'])}"
        for _ in range(400)
    ]
    pages = spark.createDataFrame([(i // 2 if i % 9 else None, u, "old", 1) for i, u in enumerate(urls)], "page_id long, url string, host string, head int")
    for chosen in (catalog.URL_RULES, MANY):
        rules = spark.createDataFrame([(v, h.upper(), p) for v, h, p in chosen], "verdict string, host string, path string")
        found = url_rules.judge(pages, rules, limit).select("page_id", "head", "url", "host", "path", "rule", "verdict").collect()
        want = Counter((i // 2 if i % 9 else None, 1, u, *verdict_by_hand(u, chosen)) for i, u in enumerate(urls))
        assert Counter(tuple(r) for r in found) == want


def test_verdicts_of_empty_tables_and_null_rules(spark):
    kinds = "verdict string, host string, path string"
    pages = spark.createDataFrame([(1, "http://a.net/b"), (2, None)], "page_id long, url string")
    none = url_rules.judge(pages, spark.createDataFrame([], kinds)).collect()
    assert sorted((r.page_id, r.rule, r.verdict) for r in none) == [(1, None, "allow"), (2, None, "allow")]
    empty = spark.createDataFrame([("block", None, None)], kinds)
    assert sorted((r.page_id, r.rule, r.verdict) for r in url_rules.judge(pages, empty).collect()) == [(1, None, "allow"), (2, "", "block")]
    assert url_rules.judge(pages.limit(0), empty).count() == 0


# ------------------------------------------------------------------ 13


def ranking_by_hand(docs, items, top=fp_search.TOP):
    lists = [(d, fp_search.terms_of(t)) for d, t in docs]
    lists = [(d, Counter(t), len(t)) for d, t in lists if t]
    total, size = len(lists), sum(n for *_, n in lists)
    df = Counter(t for _, c, _ in lists for t in c)
    out = []
    for item, text in items:
        scores = []
        for d, c, n in lists:
            m = 10 + (90 * n * total) // size
            score = 0
            for t in set(fp_search.terms_of(text)) & set(c):
                score += math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                scores.append((-score, d is None, d or 0, d))
        out += [(item, k + 1, d, -s) for k, (s, _, _, d) in enumerate(sorted(scores, key=lambda x: x[:3])[:top])]
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(13)
    words = [f"w{i}" for i in range(300)]
    text = lambda n: " ".join(words[min(299, int(rng.expovariate(1 / 40)))].title() + rng.choice(["", ".", "-x", "é"]) for _ in range(n))
    docs = [(i, text(rng.randrange(1, 80))) for i in range(900)]
    docs += [(1000 + i, docs[5][1]) for i in range(40)] + [(None, docs[5][1]), (None, docs[5][1]), docs[6], docs[6]]
    docs += [(2000, None), (2001, ""), (2002, "., !"), (2003, text(20_000)), (2004, "日本 w5"), (-7, "w5 w5 w5")]
    items = [(i, text(12)) for i in range(30)] + [(40, None), (41, "?!"), (42, "unseen"), (3, text(5)), (3, text(5)), (None, docs[5][1]), (50, docs[5][1]), (51, "w5"), (52, "日本")]
    rng.shuffle(docs)
    return docs, items


@pytest.mark.parametrize("group", [fp_search.GROUP, 37])
def test_search_against_brute_force(spark, corpus, group, monkeypatch):
    docs, items = corpus
    monkeypatch.setattr(fp_search, "GROUP", group)
    monkeypatch.setattr(fp_search, "ITEMS", 17)  # several passes
    rows = spark.createDataFrame([(d, t, 1, "x") for d, t in docs], "doc_id long, text string, n int, terms string").repartition(5)
    asked = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, rank int")
    got = sorted((tuple(r) for r in fp_search.search(rows, asked).collect()), key=str)
    assert got == ranking_by_hand(docs, items)


def test_search_in_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert fp_search.search(docs.limit(0), items).count() == 0
    assert fp_search.search(docs, items.limit(0)).count() == 0
    blank = docs.select("doc_id", F.lit("  ").alias("text"))
    assert fp_search.search(blank, items).count() == 0


def test_terms_of_texts_that_lie_end_to_end():
    texts = ["Ab1-c", "", "d", "  e\x7fÉ日 "]
    data, ends = text_bytes(pa.array(texts))
    starts, stops, own = fp_search._spans(fp_search._LOWER_ARRAY[data], ends)
    lowered = data.tobytes().translate(fp_search._LOWER)
    got = [(int(t), lowered[a:b].decode()) for a, b, t in zip(starts, stops, own, strict=True)]
    assert got == [(i, w) for i, t in enumerate(texts) for w in fp_search.terms_of(t)]


def test_tree_ranges_and_bounds():
    """Children part their node; every node's documents share its path, and its figures bound theirs."""
    rng = np.random.default_rng(3)
    vectors = [np.unique(rng.integers(0, 12, rng.integers(1, 7))) for _ in range(300)]
    rows = [(t, rng.integers(1, 5, len(t))) for t in vectors] * 2
    held = fp_search.grown(np.arange(600), np.repeat(rng.integers(10, 400, 300), 2), rows, 12, 3)
    tree = fp_search.Tree(held.ids, held.m, held.offsets, held.terms, held.tfs, 12, bunch=5)
    paths = [tuple(tree.terms[a:b]) for a, b in zip(tree.offsets[:-1], tree.offsets[1:], strict=True)]
    assert paths == sorted(paths)
    for v, kids in enumerate(tree.kids):
        a, b = tree.low[v], tree.high[v]
        assert (b - a <= 5) == (not kids)
        if kids:
            spans = [(tree.low[k], tree.high[k]) for k in kids]
            assert [x for x, _ in spans] == [a, *[y for _, y in spans[:-1]]] and spans[-1][1] == b
            own = [p for p in zip(*[paths[i] for i in range(a, b)])]
            shared = next((d for d, p in enumerate(own) if len(set(p)) > 1), len(own))
            outside = [i for i, p in enumerate(paths) if p[:shared] == paths[a][:shared] and not a <= i < b]
            assert not outside
        for i in range(a, b):
            at = slice(tree.offsets[i], tree.offsets[i + 1])
            assert (tree.tops[v][tree.terms[at]] >= tree.part[at]).all()
