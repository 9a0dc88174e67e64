"""Passages repeated across documents, found by content-defined chunks.

A gear hash rolls over the bytes of a text; a chunk ends where the hash is the
smallest within ``REACH`` bytes either side, so boundaries depend on nearby
bytes only and survive insertions elsewhere. A chunk's digest that occurs at
two places makes both occurrences repeats; consecutive repeats of enough words
are a passage. A passage grows past its whole chunks, word by word, as far as
its text is that of another occurrence, and is judged by its words after that.
"""

from __future__ import annotations

import os.path
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WHITE_CHARS, stored

REACH = 16
EDGE = 96  # characters a passage may grow by at each end: a chunk and the reach around it hardly ever have more
LONGEST = 4096  # bytes after which a chunk without a boundary is cut
GEAR = np.random.default_rng(2024).integers(0, 1 << 32, 256, dtype=np.uint32)
WHITE = np.zeros(256, bool)
WHITE[[32, 9, 10, 11, 12, 13]] = True
FIELD = 13  # bits of a packed row for a chunk's characters, and for its words


def rolling(data: np.ndarray) -> np.ndarray:
    """Gear hash of the 8 bytes up to each byte: the sum of gear[byte] << age, by doubling."""
    h = GEAR[data]
    for k in range(3):
        after = h.copy()
        after[1 << k:] += h[:-(1 << k)] << np.uint32(1 << k)
        h = after
    return h


def _lowest(h: np.ndarray, n: int) -> np.ndarray:
    """The smallest of each value and the n - 1 after it (fewer at the end)."""
    low, span = h.copy(), 1
    while span < n:
        step = min(span, n - span)
        after = low.copy()
        np.minimum(low[:-step], low[step:], out=after[:-step]) if step < len(low) else None
        low, span = after, span + step
    return low


def boundaries(data: np.ndarray) -> np.ndarray:
    """Ends of the chunks of a text's bytes; characters are never cut."""
    n = len(data)
    if n <= 2 * REACH + 1:
        return np.array([n])
    h = rolling(data)
    ahead = _lowest(h, REACH + 1)
    at = np.arange(REACH, n - REACH)
    inner = h[at]
    cut = at[(inner <= ahead[at]) & (inner < _lowest(h, REACH)[at - REACH])] + 1
    ends = np.append(cut, n)
    sizes = np.diff(ends, prepend=0)
    if (sizes > LONGEST).any():
        starts = ends - sizes
        ends = np.unique(np.concatenate([ends, *[np.arange(s + LONGEST, e, LONGEST) for s, e in zip(starts, ends, strict=True)
                                                 if e - s > LONGEST]]))
    heads = np.append(np.flatnonzero((data & 0xC0) != 0x80), n)
    return np.unique(heads[np.searchsorted(heads, ends)])


def chunks(docs: DataFrame) -> DataFrame:
    """(doc_id, _text, digest, place) per chunk of a whole text; ``place`` packs start, characters and words."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("_text"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, digests, texts = b["doc_id"], b["_text"], b["text"].to_pylist()
            for i, text in enumerate(texts):
                if not text:
                    continue
                whole = text.encode()
                data = np.frombuffer(whole, np.uint8)
                ends = boundaries(data)
                starts = np.append(0, ends[:-1])
                letters = np.cumsum(np.append(0, (data & 0xC0) != 0x80))
                space = WHITE[data]
                words = np.cumsum(np.append(0, ~space & np.append(True, space[:-1])))
                size, count = letters[ends] - letters[starts], words[ends] - words[starts]
                place = (letters[starts] << (2 * FIELD)) | (size << FIELD) | count
                found = [xxhash.xxh64_intdigest(whole[s:e]) for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids[i].as_py()] * len(ends), pa.int64()), pa.array([digests[i].as_py()] * len(ends), pa.int64()),
                     pa.array(np.array(found, np.uint64).view(np.int64)), pa.array(place)],
                    ["doc_id", "_text", "digest", "place"])

    return rows.mapInArrow(_gathered(run), "doc_id long, _text long, digest long, place long")


def _gathered(run, rows: int = 20_000):
    """Join the small batches that ``run`` yields into batches of about ``rows`` rows."""
    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in run(batches):
            held.append(b)
            n += b.num_rows
            if n >= rows:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, n = [], 0
        if held:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
    return out


def growth(own: str, other: str, side: int) -> tuple[int, int]:
    """(characters, words) that ``own`` shares with ``other`` next to a passage, in whole words of ``own``.

    Side 0 is the text before a passage, led by one character more; side 1 the
    text after it, between one character more at each end.
    """
    if side == 0:
        n = len(os.path.commonprefix([own[:0:-1], other[:0:-1]]))
        while n and (own[-n] in WHITE_CHARS or own[-n - 1] not in WHITE_CHARS):
            n -= 1
        inner = range(len(own) - n, len(own))
    else:
        n = len(os.path.commonprefix([own[1:-1], other[1:-1]]))
        while n and (own[n] in WHITE_CHARS or own[n + 1] not in WHITE_CHARS):
            n -= 1
        inner = range(1, n + 1)
    return n, sum(own[i] not in WHITE_CHARS and own[i - 1] in WHITE_CHARS for i in inner)


def _beside(text: str, at: int, side: int, room: int) -> str:
    """The text of ``room`` characters before (0) or after (1) a place, as ``growth`` takes it."""
    if side == 0:
        low = max(0, at - room)
        return (text[low - 1] if low else " ") + text[low:at]
    high = min(len(text), at + room)
    return text[at - 1] + text[at:high] + (text[high] if high < len(text) else " ")


ASK = ["at", "side", "room", "digest", "which", "_part"]


def _texts(docs: DataFrame, asks: DataFrame) -> DataFrame:
    """``asks`` (doc_id, _text and ASK) with ``beside``: the text at their places. Each text travels once."""
    asks = (asks.groupBy(F.col("doc_id").alias("_id"), F.col("_text").alias("_of"))
            .agg(F.collect_list(F.struct(*ASK)).alias("asks")))  # a text's chunks at most
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("_text"), "text")
    rows = rows.join(asks, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_text") == F.col("_of")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                text, flat = b["text"][i].as_py(), b["asks"].slice(i, 1).flatten()
                at, side, room = (flat.field(k).to_pylist() for k in range(3))
                found = [_beside(text, *x) for x in zip(at, side, room, strict=True)]
                one = [pa.array([b[c][i].as_py()] * len(found), pa.int64()) for c in ("doc_id", "_text")]
                yield pa.RecordBatch.from_arrays([*one, *(flat.field(k) for k in range(len(ASK))), pa.array(found)],
                                                 ["doc_id", "_text", *ASK, "beside"])

    return rows.select("doc_id", "_text", "text", "asks").mapInArrow(
        _gathered(run), "doc_id long, _text long, at long, side int, room long, digest long, which int, _part long, beside string")


def _grown(docs: DataFrame, rows: DataFrame, runs: DataFrame) -> DataFrame:
    """(doc_id, _text, _part, side, chars, words): by how much the ends of runs grow.

    A later occurrence (which = 0) is compared with the first one of its outer
    chunk, so what is cut from it stays there; the first one (which = 1) with
    one other. Runs never grow into each other's chunks.
    """
    along = Window.partitionBy("doc_id", "_text").orderBy("start")
    which = F.when(F.col("kept"), 1).otherwise(0).alias("which")
    near = runs.withColumn("_back", F.col("start") - F.coalesce(F.lag("end").over(along), F.lit(0)))
    near = near.withColumn("_ahead", F.coalesce(F.lead("start").over(along) - F.col("end"), F.lit(EDGE)))

    def ends(side: int, at: str, room: str, chunk: str) -> DataFrame:
        return near.where(F.col(room) > 0).select(
            "doc_id", "_text", F.col(at).alias("at"), F.lit(side).alias("side"), F.least(F.lit(EDGE), room).cast("long").alias("room"),
            F.col(chunk).alias("digest"), which, F.col("_part").cast("long").alias("_part"))

    own = ends(0, "start", "_back", "_head").unionByName(ends(1, "end", "_ahead", "_tail"))
    choice = Window.partitionBy("digest", "which").orderBy("_text", "start")
    others = (rows.where("kept or _one")
              .select("digest", F.when(F.col("kept"), 0).otherwise(1).alias("which"), "doc_id", "_text", "start", "end")
              .withColumn("_nth", F.row_number().over(choice)).where("_nth = 1"))
    wanted = own.select("digest", "which", "side").distinct().join(others, ["digest", "which"]).select(
        "doc_id", "_text", F.when(F.col("side") == 0, F.col("start")).otherwise(F.col("end")).alias("at"), "side",
        F.lit(EDGE).cast("long").alias("room"), "digest", "which", F.lit(None).cast("long").alias("_part"))
    texts = stored(_texts(docs, own.unionByName(wanted)), "edges")
    other = texts.where("_part is null").groupBy("digest", "which", "side").agg(F.min("beside").alias("other"))
    pairs = texts.where("_part is not null").join(stored(other, "others"), ["digest", "which", "side"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            side = b["side"].to_pylist()
            grown = [growth(*x) for x in zip(b["beside"].to_pylist(), b["other"].to_pylist(), side, strict=True)]
            chars, words = ([g[k] for g in grown] for k in (0, 1))
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"], b["_text"], b["_part"], b["side"], pa.array(chars, pa.int64()), pa.array(words, pa.int64())],
                ["doc_id", "_text", "_part", "side", "chars", "words"])

    return (pairs.select("doc_id", "_text", "_part", "side", "beside", "other")
            .mapInArrow(run, "doc_id long, _text long, _part long, side int, chars long, words long").where("chars > 0"))


def repeats(docs: DataFrame, min_words: int = 16) -> DataFrame:
    """(doc_id, start, end, n_words, first_doc, kept): passages that occur at more than one place.

    start and end are characters (code points), end exclusive. A passage is a
    run of chunks that each occur elsewhere too, in another document or in this
    one, grown at both ends by the words next to it that another occurrence has
    too (at most EDGE characters), ``min_words`` words or more in all. It comes
    in parts where its chunks turn from being first here (kept) to being first
    elsewhere; first_doc is the latest of a part's first documents, and doc_id
    itself where a part repeats an earlier one of the same text. Documents are
    told apart by doc_id and text, so a repeated row is no repeat of itself;
    null ids count as documents but are never first. Null, empty and
    shared-nothing texts and empty tables have no rows; very long texts are
    read whole; other columns are left out.
    """
    every = stored(chunks(docs), "chunks")
    place = F.xxhash64("doc_id", "_text", "place")
    shared = (every.groupBy("digest").agg(F.min("doc_id").alias("first_doc"), F.min(place).alias("_low"),
                                          F.max(place).alias("_high"))
              .where("_low <> _high"))
    shared = stored(shared, "shared")  # a join with a stored table deals both sides, so a common digest can be split
    mask = F.lit((1 << FIELD) - 1)
    rows = every.join(shared, "digest").select(
        "doc_id", "_text", "digest", "first_doc", place.isin(F.col("_low"), F.col("_high")).alias("_one"),
        F.shiftright("place", 2 * FIELD).alias("start"),
        F.shiftright("place", FIELD).bitwiseAND(mask).alias("_size"), F.col("place").bitwiseAND(mask).alias("_words"))
    rows = rows.repartition("doc_id", "_text").distinct().withColumn("end", F.col("start") + F.col("_size")).drop("_size")
    same = Window.partitionBy("doc_id", "_text", "digest")
    first = (F.col("first_doc") == F.col("doc_id")) & (F.col("start") == F.min("start").over(same))
    rows = stored(rows.withColumn("kept", F.coalesce(first, F.lit(False))), "repeated")

    text = ["doc_id", "_text"]
    along = Window.partitionBy(*text).orderBy("start")
    opens = F.when(F.lag("end").over(along) == F.col("start"), 0).otherwise(1)
    turns = F.when((F.col("_opens") == 1) | (F.lag("kept").over(along) != F.col("kept")), 1).otherwise(0)
    runs = (rows.withColumn("_opens", opens).withColumn("_part", F.sum(turns).over(along))
            .groupBy(*text, "_part", "kept")
            .agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sum("_words").alias("n_words"),
                 F.max("first_doc").alias("first_doc"), F.min_by("digest", "start").alias("_head"),
                 F.max_by("digest", "start").alias("_tail")))
    runs = stored(runs, "runs")
    grown = _grown(docs.select("doc_id", "text"), rows, runs)

    def side(k: int, value: str) -> Column:
        return F.coalesce(F.max(F.when(F.col("side") == k, F.col(value))), F.lit(0))

    wide = (runs.drop("_head", "_tail").unionByName(grown, allowMissingColumns=True).groupBy(*text, "_part")
            .agg(*(F.max(c).alias(c) for c in ("kept", "start", "end", "n_words", "first_doc")),
                 side(0, "chars").alias("_left"), side(0, "words").alias("_before"),
                 side(1, "chars").alias("_right"), side(1, "words").alias("_after")))
    wide = (wide.withColumn("end", F.col("end") + F.col("_right")).withColumn("_from", F.col("start") - F.col("_left"))
            .withColumn("_last", F.lag("end").over(along)))
    # where a run's growth meets that of the one before it, its words there are counted once
    wide = (wide.withColumn("n_words", F.col("n_words") + F.col("_after") + F.when(F.col("_from") < F.col("_last"), 0).otherwise(F.col("_before")))
            .withColumn("_opens", F.when(F.col("_from") <= F.col("_last"), 0).otherwise(1))
            .withColumn("start", F.greatest("_from", "_last"))
            .withColumn("_turns", F.when((F.col("_opens") == 1) | (F.lag("kept").over(along) != F.col("kept")), 1).otherwise(0))
            .withColumn("_run", F.sum("_opens").over(along)).withColumn("_part", F.sum("_turns").over(along)))
    whole = Window.partitionBy(*text, "_run")  # a text's chunks at most
    return (wide.withColumn("_all", F.sum("n_words").over(whole)).where(F.col("_all") >= min_words)
            .groupBy(*text, "_part", "kept")
            .agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sum("n_words").alias("n_words"),
                 F.max("first_doc").alias("first_doc"))
            .select(*text, "start", "end", "n_words", "first_doc", "kept"))


def drop_repeats(docs: DataFrame, min_words: int = 16) -> DataFrame:
    """``docs`` with texts cut by the passages that are first elsewhere.

    Null and empty texts, clashing column names and empty tables pass through;
    repeated rows are cut alike.
    """
    cuts = (repeats(docs.select("doc_id", "text"), min_words).where("not kept")
            .groupBy(F.col("doc_id").alias("_id"), F.col("_text").alias("_of"))
            .agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("_cuts")))
    rows = docs.select(F.struct("*").alias("_row"), F.xxhash64("text").alias("_text"))
    rows = rows.join(cuts, F.col("_row.doc_id").cast("long").eqNullSafe(F.col("_id")) & (F.col("_text") == F.col("_of")), "left")
    whole = F.col("_row.text")

    def before(i: Column) -> Column:
        """Where the text left of cut i begins."""
        return F.coalesce(F.get("_cuts", i - 1).end, F.lit(0))

    left = F.transform("_cuts", lambda c, i: F.substring(whole, (before(i) + 1).cast("int"), (c.start - before(i)).cast("int")))
    tail = F.substring(whole, (F.element_at("_cuts", -1).end + 1).cast("int"), F.length(whole))
    text = F.when(F.col("_cuts").isNull(), whole).otherwise(F.concat(F.array_join(left, ""), tail)).alias("text")
    return rows.select(*(text if c == "text" else F.col("_row")[c].alias(c) for c in docs.columns))
