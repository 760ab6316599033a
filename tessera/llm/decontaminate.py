"""Benchmark decontamination as a prefix-filtered set join, in DataFrame
operations only.

A window of an item (ten consecutive words, or a whole shorter item) is the set
of its positioned word shingles. It occurs in a document exactly when all its
shingles stand there at consecutive positions, so one shingle is a necessary
prefix of it, and the rarest in the documents is the cheapest. The join goes

1. document shingles that are item shingles at all (hash join, the item side
   broadcast only when its counted rows are few),
2. their frequency over all documents, which orders each window's shingles,
3. candidates from each window's rarest shingle, dropped where the window would
   start before the text or end after it (length and positional bounds),
4. verification: every shingle of the window at its position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.scratch import Scratch

WINDOW = 10
#: Words to a shingle; items with fewer words are joined by shingles of that many.
SHINGLE = 5
#: Item shingles (16 bytes each) up to this number are broadcast.
BROADCAST_ROWS = 1 << 20
_SPLIT = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z and nothing else; plain ASCII takes the fast way."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def word_array(text: Column) -> Column:
    """Runs of 0-9, a-z and characters beyond ASCII, A-Z lower-cased; null has none."""
    found = F.filter(F.split(lower_ascii(F.coalesce(text, F.lit(""))), _SPLIT), lambda w: w != "")
    return F.coalesce(found, F.array().cast("array<string>"))


def _shingle(words: Column, at: Column, size: int) -> Column:
    return F.xxhash64(F.lit(size), *[F.get(words, at + k) for k in range(size)])


def _placed(size: int):
    return lambda i: F.struct(i.alias("pos"), _shingle(F.col("words"), i, size).alias("shingle"))


def item_windows(benchmark: DataFrame, window: int) -> DataFrame:
    """(item_id, offset, len, words) of every window of every item with words."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), word_array(F.col("text")).alias("words"))
    items = items.where(F.size("words") > 0)
    last = F.greatest(F.size("words") - window, F.lit(0))
    return items.select("item_id", "words", F.explode(F.sequence(F.lit(0), last)).alias("offset")).select(
        "item_id", F.slice("words", F.col("offset") + 1, window).alias("words")
    )


def row_key(doc_id: Column, text: Column) -> Column:
    """The id as text; rows without one are told apart by a digest of their text,
    which is all that their result depends on."""
    digest = F.concat(F.lit("text "), F.sha2(F.coalesce(text, F.lit("")), 256))
    return F.when(doc_id.isNotNull(), doc_id.cast("long").cast("string")).otherwise(digest)


def contamination_spans(docs: DataFrame, benchmark: DataFrame, scratch: Scratch, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """(key, doc_id, n_words) of every row of ``docs`` (key, doc_id, text), and
    (key, start, len, items) of every occurrence of a window, counted in words;
    items are the ids of the items that hold it, none where all are null."""
    # distinct windows with a number; a window that several items share is joined once
    windows = item_windows(benchmark, window)
    numbered = windows.groupBy("words").agg(F.collect_set("item_id").alias("items"))
    numbered = scratch.table(numbered.select(F.xxhash64("words").alias("window"), "words", F.size("words").alias("len"), "items"), "windows")
    parts = numbered.select(
        "window", "len", "words", F.least(F.lit(SHINGLE), F.col("len")).alias("size")
    ).select("window", "len", "words", "size", F.explode(F.sequence(F.lit(0), F.col("len") - F.col("size"))).alias("shift"))
    sizes = sorted(r["size"] for r in parts.select("size").distinct().collect())  # at most SHINGLE numbers
    hashed = F.lit(None).cast("long")
    for size in sizes:
        hashed = F.when(F.col("size") == size, _shingle(F.col("words"), F.col("shift"), size)).otherwise(hashed)
    parts = scratch.table(parts.select("window", "len", "size", "shift", hashed.alias("shingle")), "window-shingles")
    wanted = parts.select("shingle").distinct()
    if wanted.count() <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)

    # one row per document (pos -1, its number of words) and one per item shingle in it
    words = docs.select("key", "doc_id", word_array(F.col("text")).alias("words")).select("key", "doc_id", "words", F.size("words").alias("n"))
    rows = F.array(F.struct(F.lit(-1).alias("pos"), F.col("n").cast("long").alias("shingle")))
    for size in sizes:
        at = F.when(F.col("n") >= size, F.sequence(F.lit(0), F.col("n") - size)).otherwise(F.array().cast("array<int>"))
        rows = F.concat(rows, F.transform(at, _placed(size)))
    rows = words.select("key", "doc_id", F.explode(rows).alias("r")).select("key", "doc_id", "r.pos", "r.shingle")
    flagged = rows.join(wanted.select(F.col("shingle").alias("known")), F.col("shingle") == F.col("known"), "left")
    matched = scratch.table(flagged.where("pos = -1 or known is not null").select("key", "doc_id", "pos", "shingle"), "item-shingles")
    counts = matched.where("pos = -1").select("key", "doc_id", F.col("shingle").alias("n_words"))
    matched = matched.where("pos >= 0").select("key", "pos", "shingle").distinct()

    # each window's rarest shingle; windows with a shingle that no document holds fall out
    seen = matched.groupBy("shingle").agg(F.count("*").alias("seen"))
    ranked = parts.join(seen, "shingle", "left").groupBy("window", "len").agg(
        F.min(F.struct("seen", "shingle", "shift")).alias("least"), F.count("*").alias("n"), F.count("seen").alias("found")
    )
    prefix = ranked.where("n = found").select("window", "len", "n", F.col("least.shingle").alias("shingle"), F.col("least.shift").alias("shift"))
    prefix = scratch.table(prefix, "window-prefixes")
    candidates = (
        matched.join(prefix, "shingle")
        .select("key", (F.col("pos") - F.col("shift")).alias("start"), "window", "len", "n")
        .join(counts.where("n_words > 0").select("key", "n_words").distinct(), "key")
        .where((F.col("start") >= 0) & (F.col("start") + F.col("len") <= F.col("n_words")))
        .select("key", "start", "window", "len", "n")
    )
    expected = candidates.join(parts.select("window", "shift", "shingle"), "window").select(
        "key", "start", "window", "len", "n", (F.col("start") + F.col("shift")).alias("pos"), "shingle"
    )
    verified = (
        expected.join(matched, ["key", "pos", "shingle"])
        .groupBy("key", "start", "window", "len", "n")
        .agg(F.count("*").alias("held"))
        .where("held = n")
        .join(numbered.select("window", "items"), "window")
        .select("key", "start", "len", "items")
    )
    return counts, verified


def _judged(docs: DataFrame, benchmark: DataFrame, window: int) -> DataFrame:
    with Scratch(docs.sparkSession) as scratch:
        source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        source = source.select(row_key(F.col("doc_id"), F.col("text")).alias("key"), "doc_id", "text")
        counts, spans = contamination_spans(source, benchmark, scratch, window)
        spans = scratch.table(spans, "spans")
        word = F.explode(F.sequence("start", F.col("start") + F.col("len") - 1)).alias("word")
        hits = spans.select("key", "start", "len").distinct().select("key", word).distinct()
        hits = hits.groupBy("key").agg(F.count("*").alias("n_hit"))
        items = spans.select("key", F.explode("items").alias("item_id")).distinct()
        items = items.groupBy("key").agg(F.sort_array(F.collect_list("item_id")).alias("items"))
        result = counts.join(hits, "key", "left").join(items, "key", "left").select(
            "key",
            "doc_id",
            "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        )
        return scratch.keep(result, "decontaminated")


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit (words inside an
    occurrence of an item's window), items (sorted ids of the items with one),
    n_items, contaminated (n_hit > 0).

    Null and empty texts have no words; an item without words matches nothing;
    an item of fewer words than ``window`` matches whole. An item without an
    item_id hits words like others, but is neither in items nor in n_items.
    Repeated items and texts count like others, other columns are ignored. doc_id
    is distinct but for repeated rows, which each get the result; rows without one
    are judged like others. An empty table of documents gives an empty result, an
    empty benchmark no hits.
    """
    result = _judged(docs, benchmark, window).drop("key")
    return result.select("*", F.size("items").cast("long").alias("n_items"), (F.col("n_hit") > 0).alias("contaminated"))


def keep_uncontaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` that hold no window of an item, with or without a
    doc_id; all columns."""
    hit = _judged(docs, benchmark, window).where("n_hit > 0").select(F.col("key").alias("_hit_key")).hint("merge")
    return docs.join(hit, row_key(docs["doc_id"], docs["text"]) == hit["_hit_key"], "left_anti")
