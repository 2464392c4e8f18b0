"""Benchmark decontamination by a prefix-filtered set join, in DataFrame operations alone.

A window of a benchmark item is a set of word shingles that a document must hold
all of, so that the necessary prefix is one token: the window's rarest shingle,
counted over all documents. Document shingles are joined with these tokens. The
token's place in the window says where the window would have to begin in the
document (positional bound) and whether it fits in there (length bound), and what
is left is compared word by word. Windows whose rarest shingle no document holds
are never looked for.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlive.llm.common import saved, text_of

#: What lies between words, once A-Z are in lower case: runs of ASCII other than letters and digits.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Words of a window, and of the shingles that windows are found by.
WINDOW, SHINGLE = 10, 3
#: Windows looked for in one pass over the documents: broadcast, at most some 300 bytes each.
BLOCK_WINDOWS = 500_000


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case and nothing else; ``lower`` does the same where all is ASCII, and is faster."""
    upper = "".join(map(chr, range(ord("A"), ord("Z") + 1)))
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, upper, upper.lower()))


def with_words(rows: DataFrame, text: Column, name: str) -> DataFrame:
    """Adds the words of ``text`` as an array: what a split leaves, but for the empty ends.

    The array is never null, which spares the plan null checks that would split the text again.
    """
    split = rows.withColumn(name, F.split(ascii_lower(text), BETWEEN))
    first, last = F.get(name, F.lit(0)) == "", F.get(name, F.size(name) - 1) == ""
    inside = F.size(name) - first.cast("int") - last.cast("int")
    trimmed = F.slice(name, first.cast("int") + 1, F.greatest(inside, F.lit(0)))
    return split.withColumn(name, F.coalesce(trimmed, F.array().cast("array<string>")))


def shingles(words: str, size: int) -> Column:
    """Structs of ``size`` consecutive words, by the place of the first; null instead of those that would run over."""
    ahead = [F.slice(words, place + 1, F.greatest(F.size(words) - size + 1, F.lit(0))) for place in range(size)]
    return F.arrays_zip(*[part.alias(f"w{place}") for place, part in enumerate(ahead)])


def shingle_key(size: int) -> Column:
    return F.xxhash64(F.lit(size), *[F.col(f"shingle.w{place}") for place in range(size)])


def windows_of(items: DataFrame, window: int, shingle: int) -> DataFrame:
    """(item, words, length, size) of every distinct window of an item; ``size`` is that of its shingles."""
    words = with_words(items.select(F.col("item_id").cast("string").alias("item"), "text"), text_of("text"), "all")
    starts = F.explode(F.sequence(F.lit(1), F.greatest(F.size("all") - window + 1, F.lit(1)))).alias("start")
    cut = words.where(F.size("all") > 0).select("item", "all", starts)
    cut = cut.select("item", F.slice("all", F.col("start"), window).alias("words")).distinct()
    length = F.size("words")
    return cut.select("item", "words", length.alias("length"), F.least(length, F.lit(shingle)).alias("size"))


def with_item_sets(windows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Windows once each with the number of their set of items, and (set, item) of every such set.

    Windows that belong to the same items share a set, so that documents that hold
    them need not list the items of each.
    """
    digest = F.sha2(F.concat_ws(",", F.array_sort(F.collect_set("item"))), 256)
    once = saved(windows.groupBy("words", "length", "size").agg(digest.alias("set")), "item-windows")
    members = windows.join(once, ["words", "length", "size"]).where("item IS NOT NULL").select("set", "item").distinct()
    return once, saved(members, "item-sets")


def tokens(windows: DataFrame, size: int) -> DataFrame:
    """(words, length, set, offset, key) of every shingle of the windows with shingles of this size."""
    own = windows.where(F.col("size") == size)
    found = own.select("words", "length", "set", F.posexplode(shingles("words", size)).alias("offset", "shingle"))
    return found.select("words", "length", "set", "offset", shingle_key(size).alias("key"))


def prefix_tokens(documents: DataFrame, windows: DataFrame, size: int) -> DataFrame:
    """The rarest shingle of every window, by its number in all documents; of windows with one that none holds, nothing."""
    every = tokens(windows, size)
    in_text = documents.select(F.explode(shingles("words", size)).alias("shingle")).select(shingle_key(size).alias("key"))
    held = in_text.join(F.broadcast(every.select("key").distinct()), "key", "left_semi").groupBy("key").count()
    counted = every.join(held, "key", "left")
    rarest = F.min(F.struct(F.coalesce("count", F.lit(0)).alias("count"), "key", "offset")).alias("rarest")
    found = counted.groupBy("words", "length", "set").agg(rarest).where("rarest.count > 0")
    return saved(found.select("words", "length", "set", "rarest.key", "rarest.offset"), "prefix-tokens")


def hits(documents: DataFrame, prefix: DataFrame, size: int) -> DataFrame:
    """(row columns, start, length, set) of every place where a window occurs in a document."""
    rows = documents.select("doc_id", "k1", "k2", "words", F.posexplode(shingles("words", size)).alias("place", "shingle"))
    rows = rows.withColumn("key", shingle_key(size)).drop("shingle")
    sought = prefix.withColumnRenamed("words", "sought")
    start = F.col("place") - F.col("offset")
    fits = (start >= 0) & (start + F.col("length") <= F.size("words"))
    same = F.slice("words", start + 1, F.col("length")) == F.col("sought")
    near = rows.join(F.broadcast(sought), "key").where(fits & same)
    return near.select("doc_id", "k1", "k2", start.alias("start"), "length", "set")


def covered(spans: str) -> Column:
    """Words inside any of the (start, length) spans, which are sorted."""

    def add(seen: Column, span: Column) -> Column:
        end = span["start"] + span["length"]
        more = F.greatest(F.lit(0), end - F.greatest(span["start"], seen["end"]))
        return F.struct((seen["words"] + more).alias("words"), F.greatest(seen["end"], end).alias("end"))

    nothing = F.struct(F.lit(0).cast("long").alias("words"), F.lit(0).alias("end"))
    return F.aggregate(spans, nothing, add, lambda seen: seen["words"])


def blocks_of(windows: DataFrame, most: int) -> Sequence[DataFrame]:
    """The windows in as few blocks of about ``most`` as there need be, dealt by a hash."""
    count = max(1, -(-windows.count() // most))
    block = F.pmod(F.xxhash64("words"), F.lit(count))
    return [windows.where(block == number) for number in range(count)] if count > 1 else [windows]


def contaminated(
    documents: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, block_windows: int = BLOCK_WINDOWS
) -> DataFrame:
    """(doc_id, n_words, n_hit, items, contaminated) of every row of ``documents`` (doc_id, text).

    ``items`` (item_id, text) are cut into windows of ``window`` consecutive words,
    an item of fewer words but not none into one of all its words. A document word
    inside any place where a window occurs is hit. ``items`` lists the ids, as
    sorted strings, of the items with a window that occurs. Null text has no words.
    Rows repeated, and rows without a doc_id, each get a row. Items that share an
    id are one; items without one are looked for and hit words, but are not listed.
    No items at all hit nothing. Extra columns of either table are left out.

    What is broadcast is one block of windows; a benchmark of more than
    ``block_windows`` takes a pass over the documents for each block.
    """
    text = text_of("text")
    keys = [F.xxhash64(F.lit(word), text).alias(word) for word in ("k1", "k2")]
    docs = with_words(documents.select("doc_id", *keys, "text"), text, "words").drop("text")
    windows, members = with_item_sets(saved(windows_of(items, window, shingle), "windows"))
    sizes = [row["size"] for row in windows.select("size").distinct().collect()]  # 1 to ``shingle``
    rows = docs.select("doc_id", "k1", "k2", F.size("words").alias("n_words"))
    none = [F.lit(None).cast(kind).alias(name) for name, kind in (("start", "int"), ("length", "int"), ("set", "string"))]
    rows = rows.select("*", *none)
    for size in sizes:
        for block in blocks_of(windows.where(F.col("size") == size), block_windows):
            found = hits(docs, prefix_tokens(docs, block, size), size)
            rows = rows.unionByName(found.withColumn("n_words", F.lit(None).cast("int")))
    span = F.when(F.col("start").isNotNull(), F.struct("start", "length"))
    whole = rows.groupBy("doc_id", "k1", "k2").agg(
        F.max("n_words").alias("n_words"),
        F.count("n_words").alias("copies"),
        F.array_sort(F.collect_set(span)).alias("spans"),
        F.array_sort(F.collect_set("set")).alias("sets"),
    )
    whole = whole.withColumn("signature", F.when(F.size("sets") > 0, F.sha2(F.concat_ws(",", "sets"), 256)))
    whole = saved(
        whole.select("doc_id", "copies", F.col("n_words").cast("long").alias("n_words"), covered("spans").alias("n_hit"), "sets", "signature"),
        "document-hits",
    )
    # documents that hold windows of the same items list the same ids; the list is made once for all of them
    listed = whole.where("signature IS NOT NULL").groupBy("signature").agg(F.first("sets").alias("sets"))
    listed = listed.select("signature", F.explode("sets").alias("set")).join(members, "set", "left")
    listed = listed.groupBy("signature").agg(F.array_sort(F.collect_set("item")).alias("items"))
    clean = whole.where("signature IS NULL").withColumn("items", F.array().cast("array<string>"))
    hit = whole.where("signature IS NOT NULL").join(listed, "signature")
    names = ["doc_id", "n_words", "n_hit", "items"]
    every = clean.select(*names, "copies").unionByName(hit.select(*names, "copies"))
    every = every.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return every.select(*names, (F.col("n_hit") > 0).alias("contaminated"))
