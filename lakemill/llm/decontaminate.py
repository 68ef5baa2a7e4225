"""Benchmark decontamination with a positional inverted index.

The index is written once per call: of every row a block with the hashes of its words in order, from which a scan
yields postings (term, row, position). Terms are pairs of adjacent words, which are the words' own lists intersected at
an offset of one; single words of a language are far too frequent to start from. Corpus frequencies of the
benchmark's terms pick the rarest term of each window of ten item words; its postings, less the term's offset in the
item, give the diagonals (row, item, position - offset) on which the item may stand. On these diagonals alone the
remaining words' postings, shifted likewise, are intersected, and runs of matches as long as a window are exact
occurrences.

Proximity: a window is near a start s of a row if one of its slack + 1 rarest terms stands at its own place, counted
from s, and all its distinct words stand in the row between s - slack and s + window - 1 + slack. An insertion breaks
one term, so of a window with up to slack insertions one of these terms is whole.

Texts are tokenised once. What is shuffled follows the diagonals found and not the corpus: only the postings of the
rarest terms, and of rows with a diagonal, leave a task. A diagonal is one row however many windows it serves.
Everything is native. Words are compared by 64-bit hashes.

Defined results: null text has no words; a row without words is never hit; an item of fewer than ten words is one
window, an item without words has none; equal windows of several items count for each; every row is judged by its own
text, also those with a null or a repeated doc_id; repeated rows give equal result rows; a benchmark without words hits
nothing; an item_id that occurs twice counts once, and a null item_id counts as an item of no name; other columns are
passed on by drop_contaminated, whatever their names; empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemill.llm.common import NOT_ALNUM, free_name, lower_ascii, sized, written


def words_of(col: Column) -> Column:
    """The words of a text, in order."""
    return F.filter(F.split(lower_ascii(F.coalesce(col, F.lit(""))), NOT_ALNUM), lambda x: x != "")


def _hashed(col: Column) -> Column:
    return F.transform(words_of(col), lambda x: F.xxhash64(x))


def positional_index(docs: DataFrame) -> DataFrame:
    """row (a number), doc_id, h (tells rows of one doc_id apart), n_words, w (the words' hashes): written, one block a row of docs."""
    d = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("h"), _hashed(F.col("text")).alias("w"))
    # the ids are those of the written table, whatever tasks were run twice
    return written(d.select(F.monotonically_increasing_id().alias("row"), "doc_id", "h", F.size("w").alias("n_words"), "w"))


def items_of(benchmark: DataFrame) -> DataFrame:
    """item (a number for each id and text), item_id, w (its words' hashes): the items that have words."""
    b = benchmark.select("item_id", _hashed(F.col("text")).alias("w")).where(F.size("w") > 0).distinct()
    return b.select(F.xxhash64("item_id", "w").alias("item"), "item_id", "w")


def _pairs(w: str) -> Column:
    """Each word of the array with the word behind it (null behind the last)."""
    return F.arrays_zip(F.col(w).alias("term"), F.slice(w, 2, F.greatest(F.size(w), F.lit(1))).alias("next"))


def postings(index: DataFrame) -> DataFrame:
    """row, pos, term, next of every word of the index."""
    return index.select("row", F.posexplode(_pairs("w")).alias("pos", "p")).select("row", "pos", "p.term", "p.next")


def counted_terms(index: DataFrame, items: DataFrame) -> DataFrame:
    """item, len, off, term, next, cf: the terms of the items with the number of their postings, 0 included."""
    terms = items.select("item", F.size("w").alias("len"), F.posexplode(_pairs("w")).alias("off", "p")).select("item", "len", "off", "p.term", "p.next").where("next is not null")
    kinds = written(terms.select("term", "next").distinct())
    seen = postings(index).select("term", "next").join(sized(kinds), ["term", "next"], "left_semi").groupBy("term", "next").agg(F.count("*").alias("cf"))
    return written(terms.join(sized(written(seen)), ["term", "next"], "left").select("item", "len", "off", "term", "next", F.coalesce("cf", F.lit(0)).alias("cf")))


def anchors(terms: DataFrame, items: DataFrame, length: int, tries: int = 1) -> DataFrame:
    """item, first, n, off, term, next: of every window (its first word and size) the `tries` rarest terms and their places in the item.

    Terms without postings are left out, and with tries = 1, for exact matches, so are windows that hold such a term. A
    window of one word has a null next.
    """
    n = F.least(F.col("len"), F.lit(length))
    # a window holds the terms that begin in it, but for its last word
    spread = terms.select("item", n.alias("n"), "off", "term", "next", "cf", F.explode(F.sequence(F.greatest(F.lit(0), F.col("off") - n + 2), F.least(F.col("off"), F.col("len") - n))).alias("first"))
    rare = spread.groupBy("item", "first", "n").agg(F.sort_array(F.collect_list(F.struct("cf", "off", "term", "next"))).alias("all"))
    rare = rare.select("item", "first", "n", F.explode(F.slice("all", 1, tries)).alias("a")).where("a.cf > 0").select("item", "first", "n", "a.off", "a.term", "a.next")
    single = items.where("size(w) = 1").select("item", F.lit(0).alias("first"), F.lit(1).alias("n"), F.lit(0).alias("off"), F.get("w", F.lit(0)).alias("term"), F.lit(None).cast("long").alias("next"))
    return rare.unionByName(single)


def places(index: DataFrame, found: DataFrame) -> DataFrame:
    """row and the columns of anchors, with diag: where each window's term puts its item's first word."""
    found = written(found)
    two, one = found.where("next is not null"), found.where("next is null")
    out = postings(index).join(sized(two), ["term", "next"])
    if one.head(1):  # items of a single word
        out = out.unionByName(postings(index).drop("next").join(sized(one), "term").select(*out.columns))
    return out.select("row", "item", "first", "n", (F.col("pos") - F.col("off")).alias("diag")).where("diag + first >= 0")


def _blocks(index: DataFrame, rows: DataFrame) -> DataFrame:
    """row, pos, term of the rows listed (distinct, written)."""
    few = index.select("row", "w").join(sized(rows), "row", "left_semi")
    return few.select("row", F.posexplode("w").alias("pos", "term"))


def exact_matches(index: DataFrame, items: DataFrame, terms: DataFrame, length: int = 10) -> DataFrame:
    """row, item, start, n: every longest run of an item's words in a row that is a window or more."""
    # one row for each place of the item, with the last window that it serves
    rare = anchors(terms, items, length).groupBy("item", "off", "term", "next").agg(F.max("first").alias("first"), F.max("n").alias("n"))
    diagonals = written(places(index, rare).select("row", "item", "diag").distinct())
    # the item may begin before the row does
    need = diagonals.join(items.select("item", "w"), "item").select("row", "item", "diag", F.size("w").alias("len"), F.posexplode("w").alias("off", "term")).withColumn("pos", F.col("diag") + F.col("off")).where("pos >= 0")
    hit = need.join(_blocks(index, written(diagonals.select("row").distinct())), ["row", "pos", "term"]).select("row", "item", "diag", "len", "pos")
    run = F.col("pos") - F.row_number().over(Window.partitionBy("row", "item", "diag").orderBy("pos"))
    runs = hit.withColumn("run", run).groupBy("row", "item", "diag", "run", "len").agg(F.min("pos").alias("start"), F.count("*").alias("n"))
    return runs.where(F.col("n") >= F.least(F.col("len"), F.lit(length))).select("row", "item", "start", F.col("n").cast("int").alias("n"))


def proximity_matches(index: DataFrame, items: DataFrame, terms: DataFrame, length: int = 10, slack: int = 3) -> DataFrame:
    """row, item, first, start: the windows that are near a start of a row."""
    cand = places(index, anchors(terms, items, length, slack + 1)).select("row", "item", "first", "n", (F.col("diag") + F.col("first")).alias("start")).distinct()
    cand = written(cand)
    ws = F.array_distinct(F.slice("w", F.col("first") + 1, F.col("n")))
    need = cand.join(sized(items).select("item", "w"), "item").select("row", "item", "first", "start", "n", ws.alias("ws"))
    # only the words around a start are looked at; blocks meet their candidates whole, and no position is a row
    begin = F.greatest(F.col("start") - slack, F.lit(0))
    around = F.slice("w", begin + 1, F.col("start") + F.col("n") + slack - begin)
    blocks = index.select("row", "w").join(sized(written(cand.select("row").distinct())), "row", "left_semi")
    near = need.join(blocks, "row").where(F.size(F.array_except("ws", around)) == 0)
    return near.select("row", "item", "first", "start")


def contamination(docs: DataFrame, benchmark: DataFrame, length: int = 10, slack: int = 3) -> DataFrame:
    """Per row of docs: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, n_near (items with a window near a start of the row)."""
    index, items = positional_index(docs.select("doc_id", "text")), written(items_of(benchmark))
    terms = counted_terms(index, items)
    hits = written(exact_matches(index, items, terms, length))
    name = items.select("item", F.col("item_id").cast("string").alias("item_id"))
    # words covered by the union of the occurrences
    words_hit = hits.select("row", F.explode(F.sequence("start", F.col("start") + F.col("n") - 1)).alias("pos")).distinct().groupBy("row").agg(F.count("*").alias("n_hit"))
    # a row's items are at most the benchmark's
    ids = hits.select("row", "item").distinct().join(name, "item").groupBy("row").agg(F.sort_array(F.collect_set(F.coalesce("item_id", F.lit("")))).alias("ids"))
    near = proximity_matches(index, items, terms, length, slack).select("row", "item").distinct().join(name, "item").groupBy("row").agg(F.count_distinct(F.coalesce("item_id", F.lit(""))).alias("n_near"))
    out = index.select("row", "doc_id", F.col("n_words").cast("long").alias("n_words")).join(words_hit, "row", "left").join(ids, "row", "left").join(near, "row", "left")
    count = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    return out.select(
        "doc_id", "n_words", count(F.col("n_hit")).alias("n_hit"), F.size(F.coalesce("ids", F.array().cast("array<string>"))).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.concat_ws(",", "ids"), F.lit("")), 256).alias("items_sha256"), F.col("n_hit").isNotNull().alias("contaminated"), count(F.col("n_near")).alias("n_near"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, length: int = 10) -> DataFrame:
    """The rows of docs, unchanged, in which no window of the benchmark occurs."""
    index, items = positional_index(docs.select("doc_id", "text")), written(items_of(benchmark))
    hits = exact_matches(index, items, counted_terms(index, items), length).select("row").distinct()
    doc, own, h = (free_name(docs.columns, n) for n in ("_doc", "_own", "_h"))
    gone = written(index.select("row", F.col("doc_id").alias(doc), F.col("h").alias(h)).join(hits, "row", "left_semi").select(doc, h).distinct())
    rows = docs.withColumn(own, F.xxhash64("doc_id", "text"))
    return rows.join(sized(gone), (F.col(own) == F.col(h)) & F.col("doc_id").eqNullSafe(F.col(doc)), "left_anti").select(*docs.columns)
