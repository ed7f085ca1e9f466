"""Benchmark decontamination by spaced-seed hashing, in DataFrame operations only.

A seed is the hash of the words that a fixed mask leaves at one position; positions that the mask skips may
differ.  The masks for each length of item together hit every overlap that counts.  Seeds of every benchmark item and of every document position are joined on the hash; each hit names a
diagonal (document position minus item position), along which the overlap is then verified word by word.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.llm.common import document_key, fresh, text_of
from graphloom.session import cut

#: seeds of an item by its least number of words; 1 marks the positions that count.  No overlap that counts escapes
#: them: n words without a hit hold more than n // 5 differing ones (tests/llm/test_native.py enumerates this)
MASKS = {
    5: ("1111", "11101", "11011", "10111"),
    6: ("1111", "11011"),
    7: ("11111", "111011", "110111"),
    8: ("11111", "111011"),
    10: ("11111", "111011", "11010011"),
    12: ("11111", "111011"),
}
#: an overlap counts from this many equal words on, or from this part of a shorter item
LEAST_WORDS, LEAST_PART = 13, 0.8
#: worst part of differing words in an overlap is one in five
MISMATCH = 4
#: items with fewer words are no evidence and are never reported
SHORTEST_ITEM = 5
#: benchmark seeds up to this number (three numbers each) and item texts up to these bytes are broadcast; beyond
#: either both sides shuffle by the hash
BROADCAST_SEEDS, BROADCAST_BYTES = 1_000_000, 32 << 20


def words(text: str) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.regexp_extract_all(F.lower(text_of(text)), F.lit(r"[\p{L}\p{N}]+"), 0)


def _seed(number: int, mask: str) -> Column:
    """Hash of what the mask leaves at ``place``; null where the mask reaches over the end."""
    kept = [F.expr(f"words[place + {i}]") for i, kept in enumerate(mask) if kept == "1"]
    return F.when(F.expr(f"place + {len(mask)} <= size(words)"), F.xxhash64(F.lit(number), *kept))


def _kind() -> Column:
    """Which masks an item of ``n`` words is sought by."""
    return F.greatest(*[F.when(F.col("n") >= least, least) for least in MASKS], F.lit(0))


def _seeds(rows: DataFrame, kind: int) -> DataFrame:
    """Rows with ``words`` -> the same with ``place`` and ``seed``, one for each position and mask of the kind.

    The kinds are joined one by one: a join right behind the explode never writes down the words beside every seed.
    """
    masks, kept = MASKS[kind], rows.columns
    least = min(map(len, masks))
    placed = rows.filter(F.size("words") >= least).select(*kept, F.explode(F.expr(f"sequence(0, size(words) - {least})")).alias("place"))
    seeds = F.array(*[_seed(100 * kind + n, mask) for n, mask in enumerate(masks)])
    return placed.select(*kept, "place", F.explode(seeds).alias("seed")).filter("seed is not null")


def _best_segment() -> Column:
    """Longest-scoring stretch of ``equal``: +1 for an equal word, -4 for another, so at least 4 in 5 agree."""
    state = "named_struct('score', 0, 'same', 0, 'size', 0, 'best', 0, 'matched', 0, 'overlap', 0)"
    return F.expr(f"""
        aggregate(equal, {state}, (s, e) -> CASE
            WHEN e THEN named_struct('score', s.score + 1, 'same', s.same + 1, 'size', s.size + 1,
                'best', greatest(s.best, s.score + 1),
                'matched', if(s.score + 1 > s.best, s.same + 1, s.matched),
                'overlap', if(s.score + 1 > s.best, s.size + 1, s.overlap))
            WHEN s.score < {MISMATCH} THEN named_struct('score', 0, 'same', 0, 'size', 0,
                'best', s.best, 'matched', s.matched, 'overlap', s.overlap)
            ELSE named_struct('score', s.score - {MISMATCH}, 'same', s.same, 'size', s.size + 1,
                'best', s.best, 'matched', s.matched, 'overlap', s.overlap) END)""")


def _close_stretch() -> Column:
    """(matched, overlap) of a stretch of ``equal`` with 13 agreeing words at least, four of five; null without one.

    Any such stretch splits into parts of 13 to 25 agreeing words, one of which is as good, so 31 words are the longest to try.
    """
    longest = (2 * LEAST_WORDS - 1) * (MISMATCH + 1) // MISMATCH
    state = "named_struct('same', 0, 'size', 0, 'matched', 0, 'overlap', 0)"
    return F.expr(f"""
        array_max(transform(sequence(1, size(equal)), i -> aggregate(slice(equal, i, {longest}), {state}, (s, e) -> named_struct(
            'same', s.same + int(e), 'size', s.size + 1,
            'matched', if(e AND s.same + 1 >= {LEAST_WORDS} AND (s.size - s.same) * {MISMATCH} <= s.same + 1, s.same + 1, s.matched),
            'overlap', if(e AND s.same + 1 >= {LEAST_WORDS} AND (s.size - s.same) * {MISMATCH} <= s.same + 1, s.size + 1, s.overlap)),
            s -> if(s.matched > 0, named_struct('matched', s.matched, 'overlap', s.overlap), NULL))))""")


def contaminated(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                 item_column: str = "item_id", item_text: str = "text") -> DataFrame:
    """(id, text_key, item, matched, overlap): documents and the benchmark items they overlap, best diagonal each.

    An overlap is a stretch along one diagonal in which at least four of five words agree; it counts from
    13 agreeing words on, for a shorter item from four fifths of its words on, and where four fifths of a whole
    item agree.  A null or empty text overlaps
    nothing; items under five words are never reported.  Rows that repeat id and text are one document
    (``text_key`` is the text's hash); null ids are an id like others.  Repeated items are reported alike.
    Empty tables give an empty result.  Only the named columns are read.
    """
    items = benchmark.select(F.col(item_column).alias("item"), words(item_text).alias("words"))
    items = items.withColumn("n", F.size("words")).filter(F.col("n") >= SHORTEST_ITEM)
    # an item is known by a number; rows that repeat it are one
    items = cut(items.withColumn("kind", _kind()).withColumn("no", F.xxhash64("item", "words")).dropDuplicates(["no"]))
    kinds = [r["kind"] for r in items.select("kind").distinct().orderBy("kind").collect()]
    seeds = cut(reduce(DataFrame.unionByName, [_seeds(items.filter(F.col("kind") == k), k) for k in kinds or [max(MASKS)]])
                .select("no", "seed", F.col("place").alias("item_place")))
    texts = items.select("no", "item", F.col("words").alias("item_words"))
    held = items.agg(F.sum(F.octet_length(F.concat_ws(" ", "words"))).alias("bytes")).first()["bytes"] or 0

    rows = docs.select(*document_key(id_column, text_column), words(text_column).alias("words"))
    diagonal = (F.col("place") - F.col("item_place")).alias("diagonal")
    key = ["id", "text_key", "item", "no", "diagonal"]
    # the stretch of the document that lies along the item
    first = F.greatest(-F.col("diagonal"), F.lit(0))
    stop = F.least(F.size("item_words"), F.size("words") - F.col("diagonal"))
    along = [
        F.slice("words", F.col("diagonal") + first + 1, stop - first).alias("here"),
        F.slice("item_words", first + 1, stop - first).alias("there"), F.size("item_words").alias("n")]
    if seeds.count() <= BROADCAST_SEEDS and held <= BROADCAST_BYTES:
        hits = [part.join(F.broadcast(seeds), "seed").select("id", "text_key", "no", diagonal, "words").join(F.broadcast(texts), "no").select(*key, *along)
                for part in (_seeds(rows, k) for k in kinds or [max(MASKS)])]
        # hits on one diagonal are neighbours in one task and fold before the shuffle
        near = reduce(DataFrame.unionByName, hits).groupBy(*key).agg(*[F.first(c).alias(c) for c in ("here", "there", "n")])
    else:
        hits = reduce(DataFrame.unionByName, [
            part.drop("words").join(seeds, "seed").select("id", "text_key", "no", diagonal)
            for part in (_seeds(rows, k) for k in kinds or [max(MASKS)])]).distinct()
        same = F.col("h.id").eqNullSafe(F.col("r.id")) & (F.col("h.text_key") == F.col("r.text_key"))
        near = (
            hits.alias("h").join(rows.dropDuplicates(["id", "text_key"]).alias("r"), same)
            .select("h.*", "words").join(texts, "no").select(*key, *along))
    scored = (
        near.withColumn("equal", F.zip_with("here", "there", lambda a, b: a == b))
        .withColumn("s", _best_segment())
        .withColumn("same", F.size(F.filter("equal", lambda e: e)))
    )
    whole = F.ceil(F.col("n") * LEAST_PART)
    scored = scored.select(
        "id", "text_key", "item",
        # an item that agrees as a whole counts as a whole, wherever its differing words stand
        F.when(F.col("same") >= whole, F.struct(F.col("same").alias("matched"), F.size("equal").alias("overlap")))
        .when(F.col("s.matched") >= F.least(F.lit(LEAST_WORDS), whole), F.struct("s.matched", "s.overlap"))
        # the best stretch may be a shorter one, or four of five throughout and no better than none
        .when(F.col("same") >= F.least(F.lit(LEAST_WORDS), whole), _close_stretch()).alias("hit"),
    ).filter("hit is not null")
    best = F.max("hit").alias("best")
    return scored.groupBy("id", "text_key", "item").agg(best).select("id", "text_key", "item", "best.matched", "best.overlap")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents that overlap no benchmark item, with all their columns."""
    id_name, key_name = fresh("id"), fresh("key")
    bad = contaminated(docs, benchmark, id_column, text_column).select("id", "text_key").distinct().toDF(id_name, key_name)
    same = F.col(id_column).eqNullSafe(F.col(id_name)) & (F.xxhash64(text_of(text_column)) == F.col(key_name))
    return docs.join(bad, same, "left_anti")
