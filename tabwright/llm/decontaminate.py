"""Benchmark decontamination with a distributed positional inverted index (DataFrame only).

1. Each benchmark item is cut into windows of ``window`` consecutive words (a shorter, non-empty
   item is one window).  Corpus frequencies of the windows' words are counted over all documents.
2. Every window is represented by its rarest words.  The index stores, for those words only,
   postings (term, document, sorted positions); the rest of the corpus vocabulary is never stored.
3. A window's posting lists are shifted by the word's offset in the window and intersected inside
   each document, rarest first (only documents with the rarest word are looked into); what remains are start positions, which are compared with all
   words of the window for an exact phrase match.  ``proximity`` instead reports documents in
   which the shifted lists of the rarest words come within ``slop`` words of each other.

Words: runs of ``[0-9a-z]`` and everything at or above U+0080, after lower-casing A-Z.

Edge cases: null texts have no words, null document ids are kept, items without words match
nothing, items without an id do so unless ``unnamed`` (then their windows count, all as one item
that the list of ids leaves out), equal windows of several items report every item, rows equal in id and text get one decision,
an empty table or benchmark gives no hits; other columns are never touched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.llm.common import K1, K2, ROW, ascii_lower, bounded, cut, keyed, keyed_rows, written

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
RAREST = 3


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(text), NOT_WORD, -1), "")


def item_windows(items: DataFrame, window: int, id_col: str, text_col: str, unnamed: bool = False) -> DataFrame:
    """Distinct windows: ``win`` (long id), ``words``, the ``items`` that hold it, and whether an item
    without an id does (``null_item``)."""
    w = items.select(F.col(id_col).cast("string").alias("item"),
                     words_of(F.coalesce(F.col(text_col), F.lit(""))).alias("w"))
    w = w.where((F.size("w") > 0) & (F.lit(unnamed) | F.col("item").isNotNull()))
    n = F.size("w")
    starts = F.when(n >= window, F.sequence(F.lit(1), F.greatest(n - window + 1, F.lit(1)))).otherwise(F.array(F.lit(1)))
    each = (w.select("item", "w", F.explode(starts).alias("at"))
            .select("item", F.slice("w", F.col("at"), window).alias("words")))
    return (each.groupBy("words").agg(F.collect_set("item").alias("items"), F.max(F.col("item").isNull()).alias("null_item"))
            .select(F.xxhash64("words").alias("win"), "words", "items", "null_item"))


def rarest_slots(docs: DataFrame, windows: DataFrame, known: bool = False) -> DataFrame:
    """``win, slots``: each window's rarest words as (freq, offset, term), rarest first; windows with
    a word that no document holds cannot occur and are left out.  ``known`` chooses among the words
    that documents hold instead, and leaves out windows of several words with less than two such."""
    slots = windows.select("win", F.posexplode("words").alias("offset", "term"))
    terms = cut(slots.select("term").distinct())
    counts = (docs.select(F.explode(words_of(F.col("text"))).alias("term"))
              .join(bounded(terms, 64), "term").groupBy("term").agg(F.count(F.lit(1)).alias("freq")))
    slots = slots.join(counts, "term", "left").groupBy("win").agg(F.sort_array(F.collect_list(
        F.struct(F.coalesce("freq", F.lit(0)).alias("freq"), "offset", "term"))).alias("slots"))
    if known:
        held = F.filter("slots", lambda s: s["freq"] > 0)
        slots = slots.where(F.size(held) >= F.least(F.size("slots"), F.lit(2))).withColumn("slots", held)
    return (slots.where(F.col("slots")[0]["freq"] > 0).withColumn("slots", F.slice("slots", 1, RAREST)))


def positional_index(docs: DataFrame, slots: DataFrame) -> DataFrame:
    """Postings of the chosen terms, stored in the shared folder: row key, ``term`` and its sorted
    ``positions``."""
    terms = bounded(slots.select(F.explode("slots.term").alias("term")).distinct(), 64)
    postings = (docs.select(K1, K2, F.posexplode(words_of(F.col("text"))).alias("pos", "term"))
                .join(terms, "term")
                .groupBy(K1, K2, "term").agg(F.sort_array(F.collect_set("pos")).alias("positions")))
    return written(postings, "positional-index")


def shifted_lists(index: DataFrame, slots: DataFrame, slop: int = 0) -> DataFrame:
    """Row key, ``win`` and ``starts``: where the window would begin by its rarest word, kept while
    every further word's shifted list has a start within ``slop``.  The rarest word chooses the
    documents; the next ones only look into these."""
    lists = (index.join(bounded(slots.select(F.col("slots")[0]["term"].alias("term"), "win", "slots"), 256), "term")
             .select(K1, K2, "win", "slots", F.transform(
                 "positions", lambda p: p - F.col("slots")[0]["offset"]).alias("starts")))
    for i in range(1, RAREST):
        slot = F.get("slots", F.lit(i))
        shifted = F.transform("positions", lambda p: p - slot["offset"])
        near = F.array_intersect("starts", shifted) if slop == 0 else F.filter(
            "starts", lambda s: F.exists(shifted, lambda t: F.abs(t - s) <= slop))
        # windows of fewer words have no such slot: their lists pass as they are
        lists = (lists.withColumn("term", slot["term"]).join(index, [K1, K2, "term"], "left")
                 .select(K1, K2, "win", "slots", F.when(F.size("slots") <= i, F.col("starts"))
                         .otherwise(F.coalesce(near, F.array().cast("array<int>"))).alias("starts"))
                 .where(F.size("starts") > 0))
    return lists.select(K1, K2, "win", "starts")


def phrase_matches(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """Row key, ``win``, ``n`` (its words) and ``at`` (0-based start word) of exact matches."""
    slots = cut(rarest_slots(docs, windows))
    lists = shifted_lists(positional_index(docs, slots), slots)
    cand = lists.select(K1, K2, "win", F.filter("starts", lambda s: s >= 0).alias("starts")) \
        .where(F.size("starts") > 0)
    cand = cut(cand.join(windows.select("win", "words"), "win"))
    # a row key's equal rows hold the same words: one copy is enough to compare
    full = (docs.select(K1, K2, "text")
            .join(bounded(cand.select(K1, K2).distinct(), 32), [K1, K2], "left_semi").dropDuplicates([K1, K2])
            .select(K1, K2, words_of(F.col("text")).alias("doc_words")))
    ok = F.filter("starts", lambda s: F.slice(F.col("doc_words"), s + 1, F.size("words")) == F.col("words"))
    return (cand.join(full, [K1, K2]).select(K1, K2, "win", F.size("words").alias("n"), ok.alias("starts"))
            .where(F.size("starts") > 0)
            .select(K1, K2, "win", "n", F.explode("starts").alias("at")))


def proximity_matches(docs: DataFrame, items: DataFrame, window: int = 10, slop: int = 5,
                      id_col: str = "doc_id", text_col: str = "text",
                      item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``doc_id, item, at``: documents where the rarest known words of one of the item's windows all stand
    within ``slop`` words of where the phrase would put them (exact matches included); ``at`` is
    where the window would begin by its rarest word."""
    d = keyed(docs, id_col, text_col)
    windows = cut(item_windows(items, window, item_id, item_text))
    slots = cut(rarest_slots(d, windows, known=True))
    hit = (shifted_lists(positional_index(d, slots), slots, slop)
           .select(K1, K2, "win", F.explode("starts").alias("at"))
           .join(windows.select("win", F.explode("items").alias("item")), "win")
           .select(K1, K2, "item", "at").distinct())
    return d.select("doc_id", K1, K2).join(hit, [K1, K2]).select("doc_id", "item", "at")


def near_items(docs: DataFrame, items: DataFrame, window: int = 10, slop: int = 5,
               id_col: str = "doc_id", text_col: str = "text",
               item_id: str = "item_id", item_text: str = "text", unnamed: bool = False) -> DataFrame:
    """Per input row: ``doc_id, items`` (ids with a proximity match, sorted as strings) and ``n_items``."""
    d = keyed(docs, id_col, text_col)
    windows = cut(item_windows(items, window, item_id, item_text, unnamed))
    slots = cut(rarest_slots(d, windows, known=True))
    which = (shifted_lists(positional_index(d, slots), slots, slop).select(K1, K2, "win").distinct()
             .join(windows.select("win", "null_item", F.explode_outer("items").alias("item")), "win")
             .groupBy(K1, K2).agg(F.sort_array(F.collect_set("item")).alias("items"), F.max("null_item").alias("null_item")))
    return (d.select("doc_id", K1, K2).join(which, [K1, K2], "left")
            .select("doc_id", F.coalesce("items", F.array().cast("array<string>")).alias("items"),
                    F.coalesce(F.size("items") + F.col("null_item").cast("int"), F.lit(0)).cast("long").alias("n_items")))


def hits(d: DataFrame, items: DataFrame, window: int, item_id: str, item_text: str,
         unnamed: bool = False) -> DataFrame:
    """Row key, ``n_hit`` (words inside matches), ``items`` (sorted) and ``null_item`` of the matching documents."""
    windows = cut(item_windows(items, window, item_id, item_text, unnamed))
    found = cut(phrase_matches(d, windows))
    covered = (found.select(K1, K2, F.explode(F.sequence(F.col("at"), F.col("at") + F.col("n") - 1)).alias("p"))
               .distinct().groupBy(K1, K2).agg(F.count(F.lit(1)).alias("n_hit")))
    which = (found.select(K1, K2, "win").distinct()
             .join(windows.select("win", "null_item", F.explode_outer("items").alias("item")), "win")
             .groupBy(K1, K2).agg(F.sort_array(F.collect_set("item")).alias("items"), F.max("null_item").alias("null_item")))
    return covered.join(which, [K1, K2])


def decontaminate(docs: DataFrame, items: DataFrame, window: int = 10,
                  id_col: str = "doc_id", text_col: str = "text",
                  item_id: str = "item_id", item_text: str = "text", unnamed: bool = False) -> DataFrame:
    """Per input row: ``doc_id, n_words, n_hit, items`` (ids whose windows occur, sorted as strings) and
    ``n_items`` (with one for the items without an id)."""
    d = keyed(docs, id_col, text_col)
    h = hits(d, items, window, item_id, item_text, unnamed)
    return (d.select("doc_id", K1, K2, F.size(words_of(F.col("text"))).cast("long").alias("n_words")).join(h, [K1, K2], "left")
            .select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.coalesce("items", F.array().cast("array<string>")).alias("items"),
                    F.coalesce(F.size("items") + F.col("null_item").cast("int"), F.lit(0)).cast("long").alias("n_items")))


def clean_documents(docs: DataFrame, items: DataFrame, window: int = 10,
                    id_col: str = "doc_id", text_col: str = "text",
                    item_id: str = "item_id", item_text: str = "text", unnamed: bool = False) -> DataFrame:
    """The input rows, all columns, without those that hold a window of the benchmark."""
    h = hits(keyed(docs, id_col, text_col), items, window, item_id, item_text, unnamed)
    rows = keyed_rows(docs, id_col, text_col).join(h.select(K1, K2), [K1, K2], "left_anti")
    return rows.select(*[F.col(f"{ROW}.`{c}`").alias(c) for c in docs.columns])
