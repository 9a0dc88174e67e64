"""Mixing, line dedup, host rules and sharding against plain Python, on small tables with every odd row."""

import hashlib
import os
import random
import re
import subprocess
import sys
import zlib
from collections import Counter, defaultdict
from math import ceil, floor

import pytest
from pyspark.sql import functions as F

from shopstream.llm import host_quality, line_dedup, mixing, oracles, sharding

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [
    (None, None, None, None, None), (None, "a b", "en", None, 3), (1, "", "en", "a", 0), (2, None, "en", "a", None),
    (3, "x " * 30000, "de", "b", 60000), (4, "same text", "en", "c", 9), (4, "same text", "en", "c", 9), (5, " \n\t\n", None, "a", 4),
]


def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS)


# Mixing

@pytest.mark.parametrize("shares", [{"*": 1}, {"a": 1, "b": 1, "*": 1}, {"a": 7, "b": 2, "*": 1}, {"a": 33, "b": 33, "c": 1, "d": 12, "*": 5}])
def test_every_class_has_its_share_to_within_a_block(spark, shares):
    plan = mixing.schedule(spark, shares).collect()
    assert sorted((r.mix_class, r.share, r.nth, r.turn) for r in plan) == sorted(oracles.turns(shares))
    period, done = sum(shares.values()), Counter()
    for r in sorted(plan, key=lambda r: r.turn):
        assert floor(r.nth * period / r.share) <= r.turn < ceil((r.nth + 1) * period / r.share)
        done[r.mix_class] += 1
        for c, s in shares.items():
            assert abs(done[c] - (r.turn + 1) * s / period) < 1


def test_mix_places_every_row_once(spark):
    rows = [(i, "t", "en", "abcd"[i % 7 % 4], 1) for i in range(700)] + ODD
    got = mixing.mix(docs(spark, rows), {"a": 3, "b": 1, "*": 2}, 8)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "mix_class", "block", "slot", "position", "in_mix"]
    found = got.collect()
    assert len(found) == len(rows) and len({r.position for r in found}) == len(rows)
    assert {r.source for r in found if r.mix_class == "*"} == {"c", "d", None}
    mixed = sorted(r.position for r in found if r.in_mix)
    assert mixed == list(range(len(mixed))) and len(mixed) > 300
    share, counts = {"a": 3, "b": 1, "*": 2}, Counter()
    for n, r in enumerate(sorted((r for r in found if r.in_mix), key=lambda r: r.position), 1):
        counts[r.mix_class] += 1
        for c, s in share.items():
            assert abs(counts[c] - n * s / 6) < 2 * 8  # a block done and a block begun


def test_mix_is_the_same_however_rows_are_dealt(spark):
    rows = docs(spark, [(i, "t", "en", "ab"[i % 3 % 2], 1) for i in range(200)])
    one = mixing.mix(rows.coalesce(1), {"a": 2, "*": 1}, 4).select("doc_id", "position").collect()
    two = mixing.mix(rows.repartition(7, F.rand()), {"a": 2, "*": 1}, 4).select("doc_id", "position").collect()
    assert sorted(one) == sorted(two)


def test_rows_of_one_id_are_ordered_by_the_whole_row(spark):
    rows = docs(spark, [(7, f"t{i}", "en", "ab"[i % 2], 1) for i in range(200)])
    one = mixing.mix(rows.coalesce(1), {"a": 2, "*": 1}, 4).select("text", "position").collect()
    two = mixing.mix(rows.repartition(7, F.rand()), {"a": 2, "*": 1}, 4).select("text", "position").collect()
    assert sorted(one) == sorted(two) and len({r.position for r in one}) == 200


def test_mix_of_nothing_and_wrong_shares(spark):
    assert mixing.mix(docs(spark, []), {"a": 1}, 4).count() == 0
    extra = docs(spark, ODD).withColumns({c: F.lit("own") for c in ("slot", "mix_class", "_index", "_key", "_piece", "turn", "_id", "_text", "_share")})
    assert mixing.mix(extra, {"a": 1}, 4).where("cast(slot as string) = 'own'").count() == 0
    for bad in ({}, {"a": 0}, {"a": 0.5}):
        with pytest.raises(ValueError):
            mixing.schedule(spark, bad)


# Sharding

def place(rows, shards, points):
    """Keys to the first shard clockwise that has room, arcs in ring order."""
    heads = sharding.ring(shards, points)
    arc_of = {}
    for k in {r[0] for r in rows}:
        h = hashlib.md5(("=" + str(k) if k is not None else "null").encode()).hexdigest()
        arc_of[k] = next((i for i, (x, _) in enumerate(heads) if x >= h), 0)
    arcs = Counter(arc_of[r[0]] for r in rows)
    room = [len(rows) // shards + (s < len(rows) % shards) for s in range(shards)]
    out = Counter()
    for a in sorted(arcs):
        at, left = a, arcs[a]
        while left:
            s = heads[at % len(heads)][1]
            n = min(left, room[s])
            room[s] -= n
            left -= n
            out[a, s] += n
            at += 1
    return arc_of, out


@pytest.mark.parametrize("n, shards, points", [(500, 7, 5), (40, 40, 3), (5, 8, 2), (0, 4, 2)])
def test_shards_fill_clockwise(spark, n, shards, points):
    rows = ([(i, f"t{i}", "en", "a", 1) for i in range(n - len(ODD))] + ODD)[:n] if n > len(ODD) else [(i, "t", "en", "a", 1) for i in range(n)]
    got = sharding.assign(docs(spark, rows), shards, points, ties=("text",)).collect()
    arc_of, want = place(rows, shards, points)
    assert Counter((arc_of[r.doc_id], r.shard) for r in got) == want
    sizes = Counter(r.shard for r in got)
    assert not rows or max(sizes.values()) - min(sizes.get(s, 0) for s in range(shards)) <= 1
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_a_hot_id_overflows_and_more_load_moves_less(spark):
    hot = docs(spark, [(9, f"t{i}", "en", "a", 1) for i in range(300)] + [(i, "t", "en", "a", 1) for i in range(600)])
    sizes = Counter(r.shard for r in sharding.assign(hot, 6, 16, ties=("text",)).collect())
    assert sorted(sizes.values()) == [150] * 6
    few = docs(spark, [(i, "t", "en", "a", 1) for i in range(2000)])

    def moved(load):
        before = {r.doc_id: r.shard for r in sharding.assign(few, 8, 64, load).collect()}
        after = {r.doc_id: r.shard for r in sharding.assign(few, 9, 64, load).collect()}
        return sum(before[k] != after[k] for k in before)

    assert moved(1.5) < moved(1.0) < 2000
    assert 2000 / 9 * 0.5 < moved(1.5) < 2000 / 9 * 2.5


# Line dedup

def test_recurring_templates_go_but_for_their_first_line(spark):
    rows = []
    for i in range(12):
        body = f"unique words number {'abcdefghijkl'[i]} stand here alone\nPage {i} of 40 printed by user{i}\nshort one\nlast line of {i}"
        rows.append((50 + i, body, "en", "a", 1))
    rows += [(80 + i, rows[3][1], "en", "a", 1) for i in range(9)] + ODD  # copies of one text count once
    got = {(r.doc_id, r.text): r for r in line_dedup.drop_lines(docs(spark, rows), min_docs=5).collect()}
    by_id = {k[0]: v for k, v in got.items()}
    assert by_id[50].text == rows[0][1] and by_id[50].n_dropped == 0
    for i in range(51, 62):
        assert "Page" not in by_id[i].text and "last line" not in by_id[i].text and by_id[i].text.endswith("short one")
        assert by_id[i].n_dropped >= 2 and by_id[i].n_lines == 4
    assert len({by_id[80 + i].text for i in range(9)}) == 1
    assert by_id[2].text is None and by_id[2].n_lines == 0 and by_id[1].text == "" and by_id[5].text == " \n\t\n"
    assert line_dedup.drop_lines(docs(spark, rows)).count() == len(rows)


def test_a_leaf_generalises_words_that_differ(spark):
    names = ["ann", "bob", "cid", "dot", "eve", "fay"]
    rows = [(i, f"Posted today at the by {n} in the city of london\nbody {n * 3} stays", "en", "a", 1) for i, n in enumerate(names)]
    found = line_dedup.templates(docs(spark, rows).select("doc_id", "text"), min_docs=5).collect()
    assert {r.template for r in found if r.template.startswith("Posted")} == {"Posted today at the by <*> in the city of london"}
    assert {r.n_docs for r in found if r.template.startswith("Posted")} == {6}
    assert [r.doc_id for r in found if r["first"] and r.template.startswith("Posted")] == [0]
    other = [(i, f"Posted today at {n} {n} {n} {n} {n}", "en", "a", 1) for i, n in enumerate(names)]
    assert line_dedup.templates(docs(spark, other).select("doc_id", "text"), min_docs=5).count() == 0


def test_rows_of_numbers_and_short_prose_stay(spark):
    words = "answer question reason problem method result".split()
    rows = [(i, f"19{90 + i} 12.{i} {300 + i}\nWhat is the {w}\n{i} 7.{i} a{i} total\nSee page {i} of text\nown {w * 2}", "en", "a", 1)
            for i, w in enumerate(words)]
    found = line_dedup.templates(docs(spark, rows).select("doc_id", "text"), min_docs=5).collect()
    assert {r.template for r in found} == {"See page <*> of text"} and len(found) == 6
    got = {r.doc_id: r.text for r in line_dedup.drop_lines(docs(spark, rows)).collect()}
    assert all(got[i] == (t if i == 0 else t.replace(f"See page {i} of text\n", "")) for i, t, *_ in rows)


def test_a_leaf_holds_several_templates(spark):
    names = ["ann", "bob", "cid", "dot", "eve", "fay", "gus", "hal"]
    lines = ["Click here to follow {} and all of the others", "Click here to leave the list of {} right now",
             "Click here to read what {} said about us all"]
    rows = [(i, "\n".join(x.format(n) for x in lines) + f"\nClick here to {n} {n}a {n}b {n}c {n}d {n}e {n}f", "en", "a", 1)
            for i, n in enumerate(names)]
    found = line_dedup.templates(docs(spark, rows).select("doc_id", "text"), min_docs=5).collect()
    assert {(r.template, r.n_docs) for r in found} == {(x.format("<*>"), 8) for x in lines} and len(found) == 24
    assert [r.n_dropped for r in line_dedup.drop_lines(docs(spark, rows)).orderBy("doc_id").collect()] == [0] + [3] * 7


def plain_drops(texts, min_docs=5, depth=3, similar=0.7, min_tokens=3, constant=0.5):
    """(doc_id, at) of the lines to drop from a dict of texts, leaf by leaf and seed by seed."""
    leaves = defaultdict(lambda: defaultdict(list))
    for d, text in texts.items():
        for at, line in enumerate(text.split("\n") if text is not None else []):
            mask = tuple("<*>" if re.search("[0-9]", t) else t for t in re.split("[ \t\x0b\f\r]+", line) if t)
            if len(mask) >= min_tokens and sum(t != "<*>" for t in mask) >= constant * len(mask) - 1e-9:
                leaves[(len(mask), mask[:depth])][mask].append((d, at))
    drops = set()
    for masks in leaves.values():
        n = {m: len({texts[d] for d, _ in where}) for m, where in masks.items()}
        if len({texts[d] for where in masks.values() for d, _ in where}) < min_docs:
            continue
        most = floor((1 - similar) * (len(next(iter(masks))) - depth) + 1e-9)

        def pieces(m):
            rest = m[depth:]
            return [(j, rest[j * len(rest) // (most + 1):(j + 1) * len(rest) // (most + 1)]) for j in range(most + 1)]

        left, group = set(masks) if most > 0 else set(), {m: m for m in masks}
        while True:
            total, first = Counter(), {}
            for m in left:
                for p in pieces(m):
                    total[p] += n[m]
            able = [m for m in left if (o := sum(total[p] - n[m] for p in pieces(m))) > 0 and n[m] + o >= min_docs]
            if not able:
                break
            rank = {m: (-n[m], " ".join(m)) for m in able}
            for m in able:
                for p in pieces(m):
                    first[p] = min(first.get(p, rank[m]), rank[m])
            seeds = [m for m in able if all(first[p] == rank[m] for p in pieces(m))]
            taken = {}
            for m in left:
                near = [s for s in seeds if set(pieces(s)) & set(pieces(m)) and sum(a != b for a, b in zip(m, s, strict=True)) <= most]
                if near:
                    taken[m] = min(near, key=rank.get)
            group |= taken
            left -= set(taken)
        lines = defaultdict(list)
        for m, where in masks.items():
            lines[group[m]] += where
        for where in lines.values():
            if len({texts[d] for d, _ in where}) >= min_docs:
                drops |= set(where) - {min(where)}
    return drops


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_lines_dropped_equal_a_plain_search(spark, seed):
    draw = random.Random(seed)

    def line():
        n = draw.choice([3, 4, 6, 7, 9, 10])
        words = [draw.choice(["a", "b"]) for _ in range(min(n, 3))] + [draw.choice(["p", "p", "p", "q", "7", "r2", "s"]) for _ in range(n - 3)]
        return draw.choice(["", " ", "\t"]) + draw.choice([" ", "  ", "\t "]).join(words) + draw.choice(["", " ", "\r"])

    texts = {i: "\n".join(line() for _ in range(draw.randint(0, 12))) for i in range(60)} | {70: None, 71: "", 72: "a a a p p p p p p p\n" * 300}
    texts |= {80: texts[3], 81: texts[4], 82: texts[4]}
    got = line_dedup.drop_lines(docs(spark, [(i, t, "en", "a", 1) for i, t in texts.items()]).repartition(4)).collect()
    drops = plain_drops(texts)
    assert len(drops) > 40
    for r in got:
        own = texts[r.doc_id]
        kept = None if own is None else "\n".join(x for at, x in enumerate(own.split("\n")) if (r.doc_id, at) not in drops)
        assert r.text == kept and r.n_dropped == sum(d == r.doc_id for d, _ in drops)


def test_given_documents_lose_the_lines_a_plain_search_finds(spark):
    found = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    texts = {r.doc_id: r.text for r in found.collect()}
    drops = Counter(d for d, _ in plain_drops(texts))
    got = {r.doc_id: r.n_dropped for r in line_dedup.drop_lines(found).collect()}
    assert got == {d: drops[d] for d in texts} and sum(drops.values()) > 100


MANY_LINES = r"""
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import functions as F
from shopstream.llm import line_dedup
from shopstream.session import get_session
spark = get_session("lines", "local[2]", **{"spark.driver.memory": "1800m", "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "2"})
long = spark.range(1).select(F.lit(0).cast("long").alias("doc_id"),
                             F.array_join(F.transform(F.sequence(F.lit(1), F.lit(200000)), lambda i: F.concat(F.lit("See page "), i, F.lit(" of it"))), "\n").alias("text"))
rest = spark.range(1, 6).select(F.col("id").alias("doc_id"), F.concat(F.lit("See page 1 of it\nown "), F.col("id")).alias("text"))
print(sorted((r.doc_id, r.n_lines, r.n_dropped) for r in line_dedup.drop_lines(long.union(rest)).drop("text").collect()))
"""


def test_a_document_of_very_many_lines(tmp_path):
    root = os.path.join(os.path.dirname(__file__), "..", "..")
    done = subprocess.run([sys.executable, "-c", MANY_LINES, root], capture_output=True, text=True, timeout=240, cwd=tmp_path,
                          env={**os.environ, "TMPDIR": str(tmp_path)})
    assert done.stdout.splitlines()[-1:] == ["[(0, 200000, 199999)" + "".join(f", ({i}, 2, 1)" for i in range(1, 6)) + "]"], done.stderr[-2000:]


def test_lines_of_nothing(spark):
    assert line_dedup.drop_lines(docs(spark, [])).count() == 0
    extra = docs(spark, ODD).withColumn("n_lines", F.lit("own")).withColumn("line", F.lit("own"))
    assert line_dedup.drop_lines(extra).columns == [*extra.columns[:5], "line", "n_lines", "n_dropped"]
    clash = docs(spark, ODD).withColumns({c: F.lit("own") for c in ("_text", "_id", "_drop", "_leaf", "at", "template")})
    assert sorted(map(str, line_dedup.drop_lines(clash).drop("n_lines", "n_dropped").collect())) == sorted(map(str, clash.collect()))
    assert sharding.assign(clash.withColumn("_arc", F.lit("own")), 2, 2).where("_arc = 'own' and _text = 'own'").count() == len(ODD)


# Host rules

def counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def test_rules_and_verdicts(spark):
    texts = ["one two three four five six seven eight nine ten eleven", "a b c d e f a b c d e f g h i j k l m n o p q r s t u v w x y z",
             "spam " * 12, "é # $ % ü\n\nx\nx\n x", "1 2 3 4 5 6 7 8 9 10 11\u0085 12 13"]
    rows = [(i, texts[i % 5], "en", f"h{i % 3}", 1) for i in range(30)] + [(100 + i, "bad", "en", "spam", 1) for i in range(40)]
    rows += [(150 + i, texts[0], "en", "spam", 1) for i in range(2)] + [(200, "bad", "en", "tiny", 1)] + ODD
    got = host_quality.judge(docs(spark, rows)).collect()
    want = {(r[0], r[1]): counts(r[1]) for r in rows}
    assert len(got) == len(rows)
    names = host_quality.COUNTS
    assert sorted(tuple(r[c] for c in names) for r in got) == sorted(want[r[0], r[1]] for r in rows)
    failed = Counter()
    total = Counter()
    for r in rows:
        n = counts(r[1])
        total[r[3]] += 1
        failed[r[3]] += n[0] < 10 or 100 * n[4] > 20 * n[0]
    hosts = [h for h in total if h is not None]
    mean = sum(failed[h] for h in hosts) / sum(total[h] for h in hosts)
    rates = [failed[h] / total[h] for h in hosts]
    spread = sum((x - sum(rates) / len(rates)) ** 2 for x in rates) / len(rates)
    strength = min(1000.0, max(1.0, mean * (1 - mean) / spread - 1))
    for r in got:
        if r.host is None:
            assert r.host_rate is None and r.kept == (not r.base_failed)
            continue
        rate = (failed[r.host] + mean * strength) / (total[r.host] + strength)
        assert r.host_rate == pytest.approx(rate, abs=1e-6)
        assert r.kept == (not r.base_failed and rate <= 0.5)
    assert not any(r.kept for r in got if r.host == "spam") and any(not r.base_failed for r in got if r.host == "spam")


def test_rules_of_nothing(spark):
    assert host_quality.judge(docs(spark, [])).count() == 0
    extra = docs(spark, ODD).withColumn("host", F.lit(1)).withColumn("n_words", F.lit("own"))
    assert host_quality.judge(extra).count() == len(ODD)


def test_sizes_and_digests_of_whole_texts(spark):
    text = "ü" * 70000
    row = docs(spark, [(1, text, "en", "a", 1)]).select(F.crc32(F.col("text").cast("binary")), F.octet_length("text")).first()
    assert tuple(row) == (zlib.crc32(text.encode()), 140000)
