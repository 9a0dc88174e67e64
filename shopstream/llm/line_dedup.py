"""Drop lines that recur across documents, found by a log-template tree.

The tree has a fixed depth: a line goes down by its number of tokens and its
first ``depth`` tokens, where a token with a digit counts as variable. A line
with less than a share ``constant`` of other tokens is no template: rows of
numbers are content. In a leaf, the line of most documents is the template;
lines that agree with it in a share ``similar`` of the tokens beyond the path
join it, and tokens that differ among them become variable. The rest of the
leaf is seeded again in the same way, and so on. Lines that nothing joins are
templates of their own.

A text is masked as a whole, cut once, and only its id, digest and lines leave
the cut. From there on lines are 64-bit keys of their leaf and their mask.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

VARIABLE = "<*>"


def _masked(text: str) -> Column:
    """A text with single blanks between tokens, none at the ends of lines, and tokens with a digit as VARIABLE."""
    even = F.regexp_replace(text, r"[ \t\x0B\f\r]+", " ")
    even = F.trim(F.replace(F.replace(even, F.lit(" \n"), F.lit("\n")), F.lit("\n "), F.lit("\n")))
    # every token follows a blank or a line end, so a match starts only there and reads its token once
    masked = F.regexp_replace(F.concat(F.lit("\n"), even), r"([ \n])[^ \n0-9]*+[0-9][^ \n]*+", "$1" + VARIABLE)
    return F.substring(masked, 2, (1 << 31) - 1)


def lines(docs: DataFrame, depth: int, min_tokens: int, constant: float) -> DataFrame:
    """(doc_id, _text, at, mask, _leaf, _id): the lines that may be templates, each with the key of its leaf and of its mask there."""
    cut = docs.where("text is not null").select("doc_id", F.xxhash64("text").alias("_text"), F.split(_masked("text"), "\n").alias("_lines"))
    # outer, as a plain explode would also filter on the size of the array, and cut every text twice for it
    cut = cut.select("doc_id", "_text", F.posexplode_outer("_lines").alias("at", "mask"))
    blanks = F.length("mask") - F.length(F.replace("mask", F.lit(" "), F.lit("")))
    n = F.when(F.col("mask") == "", 0).otherwise(blanks + 1)
    fixed = F.when(F.contains("mask", F.lit(VARIABLE)), F.size(F.array_remove(F.split("mask", " "), VARIABLE))).otherwise(n)
    cut = cut.where((n >= min_tokens) & (fixed >= constant * n - 1e-9))
    leaf = F.xxhash64(F.concat_ws(" ", n, F.substring_index("mask", " ", depth)))
    return cut.withColumn("_leaf", leaf).withColumn("_id", F.xxhash64("_leaf", "mask"))


def _beyond(mask: str, depth: int) -> Column:
    tokens = F.split(mask, " ")
    return F.slice(tokens, depth + 1, F.greatest(F.size(tokens) - depth, F.lit(0)))


def _apart(a: str, b: str, depth: int) -> Column:
    """How many tokens beyond the path differ between two masks of a leaf."""
    pairs = F.zip_with(_beyond(a, depth), _beyond(b, depth), lambda x, y: (x != y).cast("int"))
    return F.aggregate(pairs, F.lit(0), lambda n, x: n + x)


def _joined(masks: DataFrame, min_docs: int, depth: int, similar: float) -> DataFrame:
    """(_id, _seed) of the masks (_id, _leaf, mask, _n) that are or join a seed.

    A mask that may differ from its seed in d tokens beyond the path equals it
    in one of d + 1 pieces, and masks meet by keys of these. Each round, the
    masks that are first (most texts, then least text) in every piece they
    have are seeds and take what is near enough of the masks they share a
    piece with; the round is written and the rest goes on. Masks whose pieces
    hold too few texts for ``min_docs`` are no seeds, the pieces that no
    possible seed has are dropped, and the rounds end when there is none.
    """
    most = F.floor((1 - similar) * F.size("_rest") + 1e-9).cast("int")
    size = F.size("_rest")

    def piece(j: Column) -> Column:
        start, end = F.floor(j * size / (F.col("_most") + 1)).cast("int"), F.floor((j + 1) * size / (F.col("_most") + 1)).cast("int")
        return F.xxhash64("_leaf", F.concat_ws(" ", j, F.slice("_rest", start + 1, end - start)))

    left = (masks.withColumn("_rest", _beyond("mask", depth)).withColumn("_most", most).where("_most > 0")
            .select("_id", "_n", "_most", F.explode_outer(F.transform(F.sequence(F.lit(0), "_most"), piece)).alias("_piece")))
    left = stored(left, "left")
    texts = masks.select("_id", "mask", "_n")
    of_seed = texts.select(F.col("_id").alias("_seed"), F.col("mask").alias("_of"), (-F.col("_n")).alias("_less"))
    taken = None
    while True:
        total = stored(left.groupBy("_piece").agg(F.sum("_n").alias("_all"), F.count(F.lit(1)).alias("_c")).where("_c > 1"), "pieces")
        able = stored(left.join(total, "_piece").groupBy("_id", "_n").agg(F.sum(F.col("_all") - F.col("_n")).alias("_others"))
                      .where(F.col("_n") + F.col("_others") >= min_docs).select("_id"), "able")
        if able.isEmpty():
            return masks.select("_id", F.col("_id").alias("_seed")).limit(0) if taken is None else taken
        first = F.struct((-F.col("_n")).alias("_less"), F.col("mask").alias("_of"), F.col("_id").alias("_seed")).alias("_first")
        mine = stored(left.join(able, "_id", "left_semi").join(texts.drop("_n"), "_id").select("_id", "_piece", first), "able-pieces")
        top = stored(mine.groupBy("_piece").agg(F.min("_first").alias("_top")), "top")
        seeds = stored(mine.join(top, "_piece").groupBy("_id").agg(F.min((F.col("_top._seed") == F.col("_id")).cast("int")).alias("_all"))
                       .where("_all = 1").select("_id"), "seeds")
        spread = stored(mine.join(seeds, "_id", "left_semi").select("_piece", F.col("_id").alias("_seed")), "seed-pieces")
        pairs = stored(left.join(spread, "_piece").select("_id", "_most", "_seed").distinct(), "pairs")
        near = (pairs.join(texts.drop("_n"), "_id").join(of_seed, "_seed").where(_apart("mask", "_of", depth) <= F.col("_most"))
                .groupBy("_id").agg(F.min(F.struct("_less", "_of", "_seed")).alias("_by")).select("_id", "_by._seed"))
        near = stored(near, "near")
        taken = near if taken is None else stored(taken.union(near), "taken")
        kept = stored(mine.select("_piece").distinct(), "kept")
        left = stored(left.join(kept, "_piece", "left_semi").join(near, "_id", "left_anti"), "left")


def _recurring(docs: DataFrame, min_docs: int, depth: int, similar: float, min_tokens: int,
               constant: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Masks (_id, mask, _group), lines (doc_id, _text, at, _group) and the groups that recur (_group, n_docs, _first)."""
    every = stored(lines(docs, depth, min_tokens, constant), "lines")
    # stored, so that the join deals both sides itself and Spark can split a leaf with very many lines
    leaves = stored(every.select("_leaf", "_text").distinct().groupBy("_leaf").agg(F.count(F.lit(1)).alias("_c"))
                    .where(F.col("_c") >= min_docs).select("_leaf"), "leaves")
    found = every.join(leaves, "_leaf", "left_semi")
    found, masks = stored(found.drop("mask", "_leaf"), "found"), found.groupBy("_id").agg(
        F.first("_leaf").alias("_leaf"), F.first("mask").alias("mask"))
    texts = found.select("_id", "_text").distinct().groupBy("_id").agg(F.count(F.lit(1)).alias("_n"))
    masks = stored(masks.join(stored(texts, "texts"), "_id"), "masks")
    joined = stored(_joined(masks, min_docs, depth, similar), "joined")
    group = F.coalesce("_seed", "_id").alias("_group")
    tagged = stored(found.join(joined, "_id", "left").select("doc_id", "_text", "at", "_id", group), "tagged")
    size = (tagged.select("_group", "_text").distinct().groupBy("_group").agg(F.count(F.lit(1)).alias("n_docs"))
            .where(F.col("n_docs") >= min_docs))
    first = tagged.groupBy("_group").agg(F.min(F.struct("doc_id", "_text", F.col("at").alias("_at"))).alias("_first"))
    return masks.join(joined, "_id", "left").select("_id", "mask", group), tagged, stored(size.join(first, "_group"), "recurring")


_IS_FIRST = "struct(doc_id, _text, at as _at) <=> _first"


def templates(docs: DataFrame, min_docs: int = 5, depth: int = 3, similar: float = 0.7,
              min_tokens: int = 3, constant: float = 0.5) -> DataFrame:
    """(doc_id, _text, at, template, n_docs, first): lines whose template recurs in ``min_docs`` different texts.

    ``first`` marks the template's first line (smallest doc_id, text digest, line).
    """
    masks, tagged, recurring = _recurring(docs, min_docs, depth, similar, min_tokens, constant)
    seeds = masks.where("_id = _group").select("_group", F.col("mask").alias("_of"))
    differ = F.zip_with(F.split("mask", " "), F.split("_of", " "), lambda a, b: (a != b).cast("int"))
    # the tokens of a seed that differ in some member; a template has as many at most as a line has tokens
    loose = (masks.where("_id <> _group").join(seeds, "_group").select("_group", F.posexplode(differ).alias("_at", "_d")).where("_d = 1")
             .select("_group", "_at").distinct().groupBy("_group").agg(F.collect_list("_at").alias("_loose")))
    text = F.concat_ws(" ", F.transform(F.split("_of", " "), lambda t, i: F.when(
        F.array_contains("_loose", i), F.lit(VARIABLE)).otherwise(t)))
    named = seeds.join(loose, "_group", "left").select(
        "_group", F.when(F.col("_loose").isNull(), F.col("_of")).otherwise(text).alias("template"))
    return tagged.join(stored(recurring.join(named, "_group"), "named"), "_group").select(
        "doc_id", "_text", "at", "template", "n_docs", F.expr(_IS_FIRST).alias("first"))


def drop_lines(docs: DataFrame, min_docs: int = 5, depth: int = 3, similar: float = 0.7,
               min_tokens: int = 3, constant: float = 0.5) -> DataFrame:
    """``docs`` without recurring template lines, plus n_lines and n_dropped (int).

    One line of each recurring template stays: the first. Copies of one text
    count as one document. A document without such lines keeps its text to the
    byte; one that loses all lines has an empty text; null text stays null
    (no lines). Lines of fewer tokens than ``min_tokens`` stay. Repeated rows
    are treated alike. Texts of any number of lines pass, an empty table stays
    empty. Columns of the same names are replaced.
    """
    keep = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    _, tagged, recurring = _recurring(docs.select("doc_id", "text"), min_docs, depth, similar, min_tokens, constant)
    drops = stored(tagged.join(recurring, "_group").where(f"not ({_IS_FIRST})")
                   .groupBy(F.col("doc_id").alias("_id"), F.col("_text").alias("_of")).agg(F.collect_set("at").alias("_drop")), "drops")
    rows = docs.select(F.struct(*keep).alias("_row"), F.xxhash64("text").alias("_text"))  # whatever the columns are called
    rows = rows.join(drops, F.col("_row.doc_id").eqNullSafe(F.col("_id")) & (F.col("_text") == F.col("_of")), "left")
    before, dropped = F.split("_row.text", "\n"), F.col("_drop").isNotNull()
    places = F.array_except(F.sequence(F.lit(0), F.size("_before") - 1), "_drop")
    left = F.array_join(F.transform(places, lambda i: F.get("_before", i)), "\n")
    text = F.when(dropped, left).otherwise(F.col("_row.text")).alias("text")
    return rows.withColumn("_before", before).select(
        *(text if c == "text" else F.col("_row")[c].alias(c) for c in keep),
        F.when(F.col("_row.text").isNull(), 0).otherwise(F.size("_before")).alias("n_lines"),
        F.when(dropped, F.size("_drop")).otherwise(0).alias("n_dropped"))
