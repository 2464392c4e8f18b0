"""How far the sources of a language are from each other and from the language, term by term, in whole numbers.

Every term of a language is a row of its sources with their shares, in one fixed
order of sources. Between two sources the distance over all terms is first taken
as if neither term had an occurrence in both: that needs only each source's own
histogram of shares. What terms that both sources hold add to it is a correction
per pair. The rows form a frequent-pattern tree: sorted, they run through it
depth first, a row's first entries that agree with the row before are nodes
already there, and a node's multiplicity is the number of rows through it. The
correction of a node with each of its ancestors is computed once and multiplied.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchlive.llm.common import saved, small_batches, text_of
from matchlive.llm.words import string_buffers

#: Documents that a term needs in its language, and the rank down to which a source's terms are listed.
LEAST_DOCUMENTS, TOP_TERMS = 30, 50
#: Shares are in billionths; so many occurrences are added to each term.
UNIT, ADDED = 1_000_000_000, 5
#: Bytes of text counted at once; rows of counts held by a task; entries of a tree handled at once.
TEXT_BYTES, COUNTED_ROWS, TREE_ENTRIES = 2 << 20, 200_000, 1 << 18


def folded_bytes() -> np.ndarray:
    """A-Z in lower case; every other ASCII character but a-z a space."""
    out = np.arange(256, dtype=np.uint8)
    out[[byte for byte in range(128) if not chr(byte).isalpha()]] = 0x20
    out[ord("A") : ord("Z") + 1] += 32
    return out


FOLDED = folded_bytes()


def text_slices(texts: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """(number of the first text, folded texts) of runs of about TEXT_BYTES."""
    flat, offsets = string_buffers(texts)
    flat, low = FOLDED[flat], 0
    while low < len(texts):
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + TEXT_BYTES, "right")) - 1)
        at = offsets[low : high + 1]
        data = pa.py_buffer(flat[at[0] : at[-1]].tobytes())
        yield low, pa.LargeStringArray.from_buffers(high - low, pa.py_buffer((at - at[0]).tobytes()), data)
        low = high


def counted(langs: pa.Array, sources: pa.Array, texts: pa.Array) -> pa.Table:
    """(lang, source, term, number, holding): occurrences of each term, and documents that hold it."""
    lists = pc.ascii_split_whitespace(texts)
    words = lists.flatten()
    document = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
    real = pc.greater(pc.binary_length(words), 0)
    coded, document = words.filter(real).dictionary_encode(), document[real.to_numpy(zero_copy_only=False)]
    size = max(1, len(coded.dictionary))
    in_document, number = np.unique(document * size + coded.indices.to_numpy(), return_counts=True)
    lang, source = langs.dictionary_encode(), sources.dictionary_encode()
    of = lang.indices.to_numpy().astype(np.int64) * len(source.dictionary) + source.indices.to_numpy()
    key = of[in_document // size] * size + in_document % size
    key, place, holding = np.unique(key, return_inverse=True, return_counts=True)
    of, term = np.divmod(key, size)
    return pa.table(
        {
            "lang": lang.dictionary.take(pa.array(of // len(source.dictionary))),
            "source": source.dictionary.take(pa.array(of % len(source.dictionary))),
            "term": coded.dictionary.take(pa.array(term)).cast(pa.string()),
            "number": np.bincount(place, number, len(key)).astype(np.int64),
            "holding": holding.astype(np.int64),
        }
    )


COUNTS = "lang string, source string, term string, number long, holding long"


def added_up(parts: list[pa.Table]) -> pa.Table:
    sums = pa.concat_tables(parts).group_by(["lang", "source", "term"], use_threads=False)
    sums = sums.aggregate([("number", "sum"), ("holding", "sum")])
    return sums.rename_columns(["lang", "source", "term", "number", "holding"])


def count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of a task's documents, added up as long as they are not too many rows."""
    parts: list[pa.Table] = []
    rows = 0
    for batch in batches:
        for low, texts in text_slices(batch.column("text")):
            names = [batch.column(name).slice(low, len(texts)) for name in ("lang", "source")]
            parts.append(counted(*names, texts))
            rows += parts[-1].num_rows
            if rows > 2 * COUNTED_ROWS:
                parts = [added_up(parts)]
                rows = parts[0].num_rows
            if rows > COUNTED_ROWS and len(parts) == 1:
                yield from parts[0].combine_chunks().to_batches(max_chunksize=50_000)
                parts, rows = [], 0
    if parts:
        yield from added_up(parts).combine_chunks().to_batches(max_chunksize=50_000)


def term_counts(documents: DataFrame) -> DataFrame:
    """(lang, source, term, number, holding) over all documents; null text, language and source count as empty."""
    rows = small_batches(documents).select(*named_columns(), text_of("text").alias("text"))
    parts = rows.mapInArrow(count_terms, COUNTS)
    return parts.groupBy("lang", "source", "term").agg(F.sum("number").alias("number"), F.sum("holding").alias("holding"))


def named_columns() -> list[Column]:
    return [text_of(name).alias(name) for name in ("lang", "source")]


def share(number: Column, total: Column, terms: Column) -> Column:
    """1 + floor(UNIT * (number + ADDED) / (total + ADDED * terms)), exactly."""
    above = (number + F.lit(ADDED)).cast("decimal(27,0)") * F.lit(UNIT)
    below = (total + F.lit(ADDED) * terms).cast("decimal(27,0)")
    return F.lit(1).cast("long") + F.call_function("div", above, below)


def apart(one: Column | str, other: Column | str) -> Column:
    one, other = (F.col(x) if isinstance(x, str) else x for x in (one, other))
    return F.abs(one - other)


def corrections(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, a, b, value) of the tree that a task's sorted rows (lang, path) form, added up by block of rows."""
    for batch in batches:
        lists = batch.column("path")
        size = np.diff(lists.offsets.to_numpy())
        total = np.concatenate(([0], np.cumsum(size)))
        low = 0
        while low < batch.num_rows:
            high = max(low + 1, int(np.searchsorted(total, total[low] + TREE_ENTRIES, "right")) - 1)
            yield from tree(batch.column("lang").slice(low, high - low), lists.slice(low, high - low))
            low = high


def tree(langs: pa.Array, paths: pa.ListArray) -> Iterator[pa.RecordBatch]:
    """Depth by depth: nodes are where a path leaves that of the row before; they last until the next such row."""
    lang = langs.dictionary_encode()
    code = lang.indices.to_numpy().astype(np.int64)
    items = paths.flatten()
    source, own, base = (items.field(name).to_numpy() for name in ("source", "share", "base"))
    length = np.diff(paths.offsets.to_numpy())
    first = np.cumsum(length) - length
    agree = shared_prefix(code, first, length, source, own)
    keys, values = [], []
    for depth in range(1, int(length.max(initial=0))):
        ends = np.flatnonzero(agree <= depth)
        node, until = ends, np.append(ends[1:], len(length))
        real = length[node] > depth
        node, times = node[real], (until - node)[real]
        at = first[node] + depth
        above = first[node][:, None] + np.arange(depth)
        p, p0, q, q0 = own[above], base[above], own[at][:, None], base[at][:, None]
        value = (np.abs(p - q) - np.abs(p - q0) - np.abs(p0 - q) + np.abs(p0 - q0)) * times[:, None]
        some = value != 0
        pair = np.stack([np.broadcast_to(x, value.shape)[some] for x in (code[node][:, None], source[above], source[at][:, None])])
        keys.append(pair)
        values.append(value[some])
    if not values or not sum(map(len, values)):
        return
    pair, value = np.concatenate(keys, 1), np.concatenate(values)
    order = np.lexsort(pair[::-1])
    pair, value = pair[:, order], value[order]
    start = np.flatnonzero(np.append(True, (pair[:, 1:] != pair[:, :-1]).any(0)))
    yield pa.RecordBatch.from_pydict(
        {
            "lang": lang.dictionary.take(pa.array(pair[0, start])),
            "a": pa.array(pair[1, start].astype(np.int32)),
            "b": pa.array(pair[2, start].astype(np.int32)),
            "value": np.add.reduceat(value, start),
        }
    )


def shared_prefix(code: np.ndarray, first: np.ndarray, length: np.ndarray, source: np.ndarray, own: np.ndarray) -> np.ndarray:
    """How many first entries each path has in common with the row before it, in one language."""
    agree = np.zeros(len(length), np.int64)
    most = np.minimum(length[1:], length[:-1]) * (code[1:] == code[:-1])
    going = np.flatnonzero(most) + 1
    depth = 0
    while len(going):
        here, before = first[going] + depth, first[going - 1] + depth
        same = (source[here] == source[before]) & (own[here] == own[before])
        going = going[same]
        depth += 1
        agree[going] = depth
        going = going[most[going - 1] > depth]
    return agree


def audited(documents: DataFrame, least_documents: int = LEAST_DOCUMENTS, top_terms: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank) for every source of a language in ``documents`` (text, lang, source).

    Part ``pair`` has every other source of the language as item, and as value the
    distance between both sources' shares over all kept terms. Part ``term`` has
    the ``top_terms`` kept terms that the source holds and whose share there is
    furthest above the language's. Terms are runs of ASCII letters, in lower case,
    and of what is beyond ASCII; kept ones are in ``least_documents`` documents of
    the language. Ranks follow falling values, then items as UTF-8.

    Null text, language and source count as empty. A source without terms, or a
    language without kept ones, still has its pairs; a source alone in its
    language has no row but its terms. Rows repeated count each. No documents give
    no rows. Extra columns are left out. Values are exact while sums fit 64 bits.

    A term's row and a source's pairs hold an entry per source of the language, as
    the result does.
    """
    groups = saved(documents.select(*named_columns()).distinct(), "sources")
    counts = saved(term_counts(documents), "term-counts")
    in_lang = counts.groupBy("lang", "term").agg(F.sum("holding").alias("holding"), F.sum("number").alias("in_lang"))
    kept = in_lang.where(F.col("holding") >= least_documents).drop("holding")
    numbers = saved(counts.drop("holding").join(kept, ["lang", "term"]), "kept-counts")
    lang_sums = numbers.select("lang", "term", "in_lang").distinct().groupBy("lang").agg(
        F.sum("in_lang").alias("lang_total"), F.count("*").alias("terms")
    )
    source_sums = numbers.groupBy("lang", "source").agg(F.sum("number").alias("total"), F.count("*").alias("held"))
    facts = groups.join(source_sums, ["lang", "source"], "left").join(lang_sums, "lang", "left")
    zero = F.lit(0).cast("long")
    facts = facts.fillna(0, ["total", "held", "lang_total", "terms"])
    base = F.when(F.col("terms") > 0, share(zero, F.col("total"), F.greatest("terms", F.lit(1)))).otherwise(zero)
    # rare shares first: sources with few words have few different ones
    place = F.row_number().over(Window.partitionBy("lang").orderBy("total", "source"))
    facts = saved(facts.withColumn("base", base).withColumn("place", place), "source-facts")
    shares = numbers.join(facts, ["lang", "source"])
    shares = shares.withColumn("share", share(F.col("number"), F.col("total"), F.col("terms")))
    shares = shares.withColumn("lang_share", share(F.col("in_lang"), F.col("lang_total"), F.col("terms")))
    shares = saved(shares.select("lang", "source", "place", "term", "share", "base", "lang_share"), "shares")
    return terms_apart(shares, top_terms).unionByName(pairs_apart(facts, shares))


def terms_apart(shares: DataFrame, most: int) -> DataFrame:
    above = shares.where("share > lang_share")
    found = above.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), apart("share", "lang_share").alias("value"))
    return ranked(found).where(F.col("rank") <= most)


def ranked(found: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return found.withColumn("rank", F.row_number().over(order).cast("int"))


def alone(facts: DataFrame, shares: DataFrame) -> DataFrame:
    """(lang, place, other, value): what a source's held terms add to its distance from another that holds none of them.

    The sum of |share - other's base| - |own base - other's base| over the held
    terms, for every other source: shares and bases of a language in one order,
    with running numbers and sums of the shares.
    """
    points = shares.groupBy("lang", "place", F.col("share").alias("at")).agg(F.count("*").alias("times"))
    points = points.withColumn("other", F.lit(None).cast("int"))
    own = facts.select("lang", "place", F.col("base").alias("own"), "held")
    others = facts.select("lang", F.col("place").alias("other"), F.col("base").alias("at"))
    sought = own.join(others, "lang").where("place <> other").select("lang", "place", "at", F.lit(0).cast("long").alias("times"), "other")
    both = points.unionByName(sought)
    order = Window.partitionBy("lang", "place").orderBy("at", F.col("other").isNotNull())
    below, whole = order.rowsBetween(Window.unboundedPreceding, 0), Window.partitionBy("lang", "place")
    weight = F.col("times") * F.col("at")
    sums = both.select(
        "lang", "place", "other", "at",
        F.sum("times").over(below).alias("n"), F.sum(weight).over(below).alias("s"),
        F.sum("times").over(whole).alias("all_n"), F.sum(weight).over(whole).alias("all_s"),
    ).where("other IS NOT NULL")
    value = F.col("at") * F.col("n") - F.col("s") + (F.col("all_s") - F.col("s")) - F.col("at") * (F.col("all_n") - F.col("n"))
    return sums.select("lang", "place", "other", "at", value.alias("value"))


def pairs_apart(facts: DataFrame, shares: DataFrame) -> DataFrame:
    one = facts.select("lang", "place", "source", "base", "held", "terms")
    other = one.select("lang", *[F.col(name).alias(f"{name}_b") for name in ("place", "source", "base", "held")])
    pairs = one.join(other, "lang").where("place < place_b")
    held = alone(facts, shares).select("lang", "place", "other", "value")
    first = held.select("lang", "place", F.col("other").alias("place_b"), F.col("value").alias("alone_a"))
    second = held.select("lang", F.col("place").alias("place_b"), F.col("other").alias("place"), F.col("value").alias("alone_b"))
    entry = F.struct(F.col("place").alias("source"), "share", "base")
    paths = shares.groupBy("lang", "term").agg(F.array_sort(F.collect_list(entry)).alias("path"))
    rows = paths.where(F.size("path") > 1).select("lang", "path").repartitionByRange("lang", "path").sortWithinPartitions("lang", "path")
    both = rows.mapInArrow(corrections, "lang string, a int, b int, value long")
    both = both.groupBy("lang", F.col("a").alias("place"), F.col("b").alias("place_b")).agg(F.sum("value").alias("both"))
    keys = ["lang", "place", "place_b"]
    every = pairs.join(first, keys, "left").join(second, keys, "left").join(both, keys, "left")
    gap = apart("base", "base_b")
    left = F.col("terms") - F.col("held") - F.col("held_b")
    value = F.coalesce("alone_a", F.lit(0)) + F.coalesce("alone_b", F.lit(0)) + gap * left + F.coalesce("both", F.lit(0))
    every = saved(every.select("lang", "source", "source_b", value.cast("long").alias("value")), "source-pairs")
    there = every.select("lang", "source", F.col("source_b").alias("item"), "value")
    back = every.select("lang", F.col("source_b").alias("source"), F.col("source").alias("item"), "value")
    found = there.unionByName(back).withColumn("part", F.lit("pair"))
    return ranked(found).select("lang", "source", "part", "item", "value", "rank")
