"""Filter audit, prefix trie and URL rules against plain Python, on small tables with every odd row."""

import hashlib
import random
import re
import zlib
from collections import defaultdict
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from shopstream.llm import filter_audit, prefix_trie, url_filter

WORD = re.compile("[^\x20\x09-\x0d]+")
DOCS = "doc_id long, text string, source string, part string, fails int, kind int, total string"
LABELS = "doc_id long, quality int, toxic int, kind string"
TURNS = "conv_id long, turn long, role string, text string, depth int, size string, top int"


# Filter audit

def plain_audit(docs, labels):
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    ids = defaultdict(list)
    for d, t, _ in docs:
        ids[t or ""].append(d)
    marked = []
    for d, t, part in docs:
        t = t or ""
        w = WORD.findall(t)
        fails = set()
        if len(w) < 200:
            fails.add("A")
        if 100 * len(set(w)) < 50 * len(w):
            fails.add("B")
        if 100 * len(re.findall("[A-Z]", t)) > 2 * len(t):
            fails.add("C")
        if re.search("[#$%&*|]", t):
            fails.add("D")
        if d is not None and any(o is not None and o < d for o in ids[t]):
            fails.add("E")
        marked.append((part or "", d in good, d in toxic, fails))
    out = []
    for part in {m[0] for m in marked}:
        rows, own = [m for m in marked if m[0] == part], defaultdict(int)
        found = []
        for order in map("".join, permutations("ABCDE")):
            left = rows
            for step, f in enumerate(order, 1):
                gone = [m for m in left if f in m[3]]
                left = [m for m in left if f not in m[3]]
                failing = sum(f in m[3] for m in rows)
                own[f] += len(gone)
                found.append([part, order, step, len(left), len(gone), failing - len(gone), sum(m[3] == {f} for m in rows),
                              sum(m[1] for m in gone), sum(m[2] for m in gone), f])
        out += [(*r[:-1], own[r[-1]]) for r in found]
    return sorted(out)


def audit_rows(seed):
    draw = random.Random(seed)
    texts = [None, "", " \n", "A", "x " * 300, " ".join(f"w{i}" for i in range(250)), " ".join(f"W{i}" for i in range(250)),
             " ".join(f"w{i}" for i in range(250)) + " #", "é" * 40, "Z" + "é" * 49, "y " * 40000 + "$"]
    docs = [(draw.choice([None, *range(40)]), draw.choice(texts), draw.choice([None, "", "a", "a", "a", "b"])) for _ in range(150)]
    docs += docs[:5]
    labels = [(draw.choice([None, *range(40)]), draw.choice([0, 1, None]), draw.choice([0, 1, None])) for _ in range(30)]
    return docs, labels


@pytest.mark.parametrize("seed", [1, 2])
def test_audit_equals_running_every_order(spark, seed):
    docs, labels = audit_rows(seed)
    got = filter_audit.audit(spark.createDataFrame([(d, t, s, "x", 9, 9, "x") for d, t, s in docs], DOCS).repartition(5),
                             spark.createDataFrame([(*r, "x") for r in labels], LABELS))
    assert dict(got.dtypes)["step"] == "int" and {t for c, t in got.dtypes[3:]} == {"bigint"}
    assert sorted(tuple(r) for r in got.collect()) == plain_audit(docs, labels)


def test_audit_of_nothing(spark):
    docs, labels = spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)
    assert filter_audit.audit(docs, labels).count() == 0
    one = spark.createDataFrame([(1, None, None, None, None, None, None)], DOCS)
    rows = filter_audit.audit(one, labels).collect()
    assert len(rows) == 600 and {r.part for r in rows} == {""} and {r.removed for r in rows if r.filter_order[r.step - 1] == "A"} == {1}


def test_carry_save_counts_equal_a_plain_count():
    draw = np.random.default_rng(0)
    for n, groups in ((0, 3), (1, 1), (2, 5), (1000, 7), (50000, 3)):
        words = draw.integers(0, 1 << 32, n, dtype=np.uint32)
        group = np.sort(draw.integers(0, groups, n))
        want = np.zeros((groups, 32), np.int64)
        np.add.at(want, group, (words[:, None] >> np.arange(32, dtype=np.uint32) & 1).astype(np.int64))
        assert (filter_audit.positional_popcount(words, group, groups) == want).all()


# Prefix trie

def plain_trie(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            key = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[c].append((turn is not None, turn or 0, key, role, text))
    own = {c: [t[3:] for t in sorted(ts)] for c, ts in own.items()}
    built = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = own.get(c - (c % 20 if c >= 0 else -(-c % 20)), [])[:h] + ts[h:]
    nodes = defaultdict(list)
    for c, ts in built.items():
        for d in range(len(ts) + 1):
            nodes[tuple(ts[:d])].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for p in nodes:
        if p:
            children[p[:-1]] += 1
    for p, members in nodes.items():
        words = len(WORD.findall(p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += children[p] == 0
            saved[p[:d]] += (len(members) - 1) * words
    return sorted((min(m), len(p), min(nodes[p[:-1]]) if p else -1, len(m), children[p], leaves[p], saved[p],
                   hashlib.sha256(",".join(str(c) for c in sorted(m) if len(built[c]) == len(p)).encode()).hexdigest())
                  for p, m in nodes.items())


def turn_rows(seed, n=120):
    draw = random.Random(seed)
    rows = [(c, draw.choice([None, 0, 1, t]), draw.choice(["u", "a", None]), draw.choice(["hi there", "a  b\nc", "", None, f"only {c}"]))
            for c in [*range(n), -5, -20, -40, 10**15] for t in range(draw.choice([1, 1, 2, 3, 5]))]
    rows += [(c, t, "u", "same opening words") for c in range(200, 260) for t in range(4)]  # copies of one conversation
    rows += [(300, t, "u", f"word {t % 3}") for t in range(60)] + [(320, t, "u", f"word {t % 3}") for t in range(50)]
    rows += rows[:7] + [(None, 1, "u", "of no conversation"), (400, 1, "u", "long " * 30000)]
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,cells,piece", [(1, 1 << 24, 4096), (2, 16, 3), (3, 1 << 24, 2)])
def test_trie_equals_a_plain_trie(spark, monkeypatch, seed, cells, piece):
    monkeypatch.setattr(prefix_trie, "PIECE", piece)
    rows = turn_rows(seed)
    got = prefix_trie.trie(spark.createDataFrame([(*r, 1, "x", 2) for r in rows], TURNS).repartition(5), cells)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert {t for c, t in got.dtypes[:-1]} == {"bigint"}
    assert sorted(tuple(-1 if v is None else v for v in r) for r in got.collect()) == plain_trie(rows)


def test_trie_of_little(spark):
    assert prefix_trie.trie(spark.createDataFrame([], TURNS)).count() == 0
    assert prefix_trie.trie(spark.createDataFrame([(None, 1, "u", "x", 1, "x", 2)], TURNS)).count() == 0
    rows = [(7, None, None, None)]
    got = prefix_trie.trie(spark.createDataFrame([(*r, 1, "x", 2) for r in rows], TURNS)).collect()
    assert sorted(tuple(-1 if v is None else v for v in r) for r in got) == plain_trie(rows)


def test_sketch_screens_what_only_one_conversation_has(spark):
    rows = [(c, t, "u", f"{c} {t}") for c in range(0, 4000, 20) for t in range(5)]
    prefixes = prefix_trie.rebuilt(spark.createDataFrame([(*r, 1, "x", 2) for r in rows], TURNS)).cache()
    found = prefix_trie.screened(prefixes, spark).where("depth > 0")
    assert found.where("top = 1").count() > 0.9 * found.count()  # all are alone after the root
    bits = prefix_trie.sketch(prefixes, 1 << 12)
    assert bits.shape == (4, 512) and np.unpackbits(bits).sum() < 4 * 250


# URL rules

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
URLS = [None, "", "no scheme", "http://", "http://NET", "http://net/", "https://a.b.NET/x?y://z", "http://xnet/", "http://www.example.net/en/1",
        "http://example.net/en", "http://example.net/EN/", "ftp://a.example.com/de/?q", "http://example.com/de", "http://example.com.de/",
        "http://x.org/fr/a#b", "http://x.org#/fr/", "http://x.org?/fr/", "http://org/fr//", "://é.net/é", "a://b://net/c", "http://u:p@net:80/",
        "http://..net/", "http://net./", "http://" + "a." * 20000 + "net/" + "x" * 20000, "http://net/", "http://nét.net/en/é"]


def plain_urls(urls, rules):
    out = []
    for i, url in enumerate(urls):
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host = re.match("[^/?#]*", rest).group()
        path = re.match("[^?#]*", rest[len(host):]).group()
        host = re.sub("[A-Z]", lambda m: m.group().lower(), host)
        fits = [(len(h + p), h.count("."), a, h + p) for h, p, a in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits, default=None)
        out.append((i, host, path, best[3] if best else "", best[2] if best else "allow"))
    return sorted(out)


def judged(spark, urls, rules, **limits):
    pages = spark.createDataFrame([(i, u, "x", "y", None) for i, u in enumerate(urls)],
                                  "page_id long, url string, host string, rule string, _row string").repartition(3)
    got = url_filter.judge(pages, spark.createDataFrame(rules, "host string, path string, action string"), **limits)
    assert got.columns == ["page_id", "host", "path", "rule", "verdict"]
    return sorted(tuple("" if v is None else v for v in r) for r in got.collect())


def test_urls_equal_a_scan_of_the_rules(spark):
    assert judged(spark, URLS, RULES) == plain_urls(URLS, RULES)
    assert judged(spark, URLS, RULES, most_rules=3) == plain_urls(URLS, RULES)  # joined


def test_many_rules_and_urls(spark):
    draw = random.Random(5)
    host = lambda: ".".join(draw.choice("abc") for _ in range(draw.randint(1, 4)))
    path = lambda: "".join("/" + draw.choice(["", "x", "xy", "é"]) for _ in range(draw.randint(0, 3)))
    rules = [(host(), path(), draw.choice(["allow", "block"])) for _ in range(300)]
    kept = {h + p: (h, p, "block" if (h, p, "block") in rules else "allow") for h, p, a in rules}
    urls = [f"http://{host()}{path()}{draw.choice(['', '?q', '#f', 'z'])}" for _ in range(2000)]
    want = plain_urls(urls, list(kept.values()))
    assert judged(spark, urls, [*rules, (None, "/", "block"), ("", "/", "block"), ("a", None, "other")]) == want
    assert judged(spark, urls, rules, most_bytes=10) == want


def test_urls_of_nothing(spark):
    assert judged(spark, ["http://net/"], [(None, None, None)]) == [(0, "net", "/", "", "allow")]
    empty = spark.createDataFrame([], "page_id long, url string")
    assert url_filter.judge(empty, spark.createDataFrame(RULES, "host string, path string, action string")).count() == 0


def test_equal_digests_are_told_apart_by_the_string(spark):
    name = url_filter.write_index(spark, np.array([5, 5, 5, 9]), [b"a.b/", b"c/", b"d/e", b"x/"], [1, 0, 1, 0])
    from pyspark import SparkFiles
    index = url_filter.Index(SparkFiles.get(name))
    at, there = index.hits(np.array([5, 7, 9, 10]))
    assert there.tolist() == [True, False, True, False]
    assert [index.confirm(int(at[0]), 5, t) for t in (b"d/e", b"c/", b"a.b/", b"nothing")] == [2, 1, 0, None]
    assert index.confirm(int(at[2]), 9, b"c/") is None and isinstance(index.keys, np.memmap)
    assert spark.range(1).select(F.lit(name)).count() == 1
