"""Filter interaction audit on sorted posting lists.

Each filter keeps, for every part of the corpus, the sorted list of the rows that fail it. Rows are dealt out in ranges
of (part, id), so a list is a sequence of short pieces, one for each id range, and a task holds a few thousand entries of
one range at a time. Within a range:

- the union of each subset of filters comes from a galloping k-way merge of the lists: the list whose head is the
  smallest gives all its entries below the next list's head at once, found by doubling steps and a binary search;
- the rows that a filter removes behind the filters of a subset are a galloping difference, list minus union, in the
  same steps.

Only their sizes (rows, good rows, toxic rows) leave the task, and are summed over the ranges. Every number of the report
follows from them: what a filter removes at a step depends on the *set* of filters before it, of which there are
2^k, not on the k! orders.

Rows that agree in id, part, text and failures are one entry with a count, so neither a group of copies nor a
repeated id grows a task. The copy filter needs no join on texts: the first id of each text is grouped (map-side first), and a
row is a copy if (its id, its text) is no such first one; ids spread that join.

Defined results: a null text is empty; a null part is the empty string; rows without an id have no smaller id, no label, and
are counted; an id that the labels repeat is good (toxic) if one of its rows says so; rows that repeat an id are counted each; the
first rows of a text are no copies, also when they repeat their id; an empty table has no parts and gives no rows. Other
columns, whatever their names, are not read.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from itertools import permutations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, written

FILTERS = "ABCDE"
#: Entries of one id range, the unit that is merged in memory.
RANGE = 10_000


def gallop(items: list[int], value: int, start: int) -> int:
    """First place from ``start`` on whose item is not below ``value``: doubling steps, then a binary search."""
    step, n = 1, len(items)
    low = high = start
    while high < n and items[high] < value:
        low = high + 1
        high = low + step
        step *= 2
    return bisect_left(items, value, low, min(high, n))


def union(lists: list[list[int]]) -> list[int]:
    """Sorted union of sorted lists: the smallest head's list gives its entries below every other head at once."""
    lists = [x for x in lists if x]
    heads, out = [0] * len(lists), []
    while len(lists) > 1:
        values = [x[h] for x, h in zip(lists, heads)]
        low = min(values)
        first = values.index(low)
        rest = [v for v in values if v != low]
        if len(rest) == len(values) - 1:  # one list alone has the smallest head
            end = gallop(lists[first], min(rest), heads[first])
            out += lists[first][heads[first]:end]
            heads[first] = end
        else:
            out.append(low)
            heads = [h + (v == low) for h, v in zip(heads, values)]
        if any(h == len(x) for x, h in zip(lists, heads)):
            live = [(x, h) for x, h in zip(lists, heads) if h < len(x)]
            lists, heads = [x for x, _ in live], [h for _, h in live]
    return out + lists[0][heads[0]:] if lists else out


def difference(items: list[int], gone: list[int]) -> list[int]:
    """Items of a sorted list that another sorted list lacks, in runs."""
    out, at, g = [], 0, 0
    while at < len(items):
        g = gallop(gone, items[at], g)
        if g == len(gone):
            return out + items[at:]
        if gone[g] == items[at]:
            at += 1
            continue
        end = gallop(items, gone[g], at)
        out += items[at:end]
        at = end
    return out


def removals(lists: list[list[int]], weights: list[list[int]]) -> Iterator[tuple[int, int, list[int]]]:
    """(filters before as bits, filter, weights removed) of one id range, where anything is removed.

    ``lists``: for each filter its sorted entries; ``weights``: for each measure a value per entry.
    """
    k = len(lists)
    for before in range(1 << k):
        if before.bit_count() == k:
            continue
        gone = union([x for f, x in enumerate(lists) if before >> f & 1])
        for f, items in enumerate(lists):
            if before >> f & 1 or not items:
                continue
            if left := difference(items, gone):
                yield before, f, [sum([w[i] for i in left]) for w in weights]


def _range_sizes(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[tuple]:
    """Summed sizes of the id ranges of a task: rows arrive sorted by part and id."""
    for batch in batches:
        parts = batch.column(0).to_pylist()
        start = 0
        while start < len(parts):
            end = start
            while end < len(parts) and end - start < RANGE and parts[end] == parts[start]:
                end += 1
            bits, *weights = [c.slice(start, end - start).to_pylist() for c in batch.columns[1:]]
            lists: list[list[int]] = [[] for _ in range(k)]
            for i, b in enumerate(bits):
                for f in range(k):
                    if b >> f & 1:
                        lists[f].append(i)
            for before, f, sums in removals(lists, weights):
                yield parts[start], before, f, *sums
            start = end


def removal_sizes(failing: DataFrame, order: list[str], k: int) -> DataFrame:
    """part, before, filter, removed, good_lost, toxic_lost over all id ranges.

    ``failing``: part, bits, n, good, toxic and the columns of ``order``, which sort the entries of a part.
    """
    partitions = int(failing.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = failing.repartitionByRange(partitions, "part", *order).sortWithinPartitions("part", *order)
    names = ["part", "before", "filter", "removed", "good_lost", "toxic_lost"]
    kinds = [pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple, list[int]] = defaultdict(lambda: [0, 0, 0])

        def flush() -> pa.RecordBatch:
            rows = [(*key, *values) for key, values in sums.items()]
            sums.clear()
            columns = zip(*rows) if rows else [()] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, kinds)], names=names)

        for part, before, f, *values in _range_sizes(batches, k):
            found = sums[part, before, f]
            for i, v in enumerate(values):
                found[i] += v
            if len(sums) >= RANGE:
                yield flush()
        yield flush()

    sizes = dealt.select("part", "bits", "n", "good", "toxic").mapInArrow(
        run, "part string, before int, filter int, removed long, good_lost long, toxic_lost long")
    return sizes.groupBy("part", "before", "filter").agg(
        *[F.sum(c).alias(c) for c in ("removed", "good_lost", "toxic_lost")])


def text_failures(docs: DataFrame) -> DataFrame:
    """doc_id, part, text digest and bits of the filters that look at one text alone (A to D), with a count of equal rows."""
    text = F.coalesce(F.col("text"), F.lit(""))
    words = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("lang", F.lit("")).alias("part"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"), F.char_length(text).alias("chars"),
        F.regexp_count(text, F.lit("[A-Z]")).alias("capitals"), F.regexp_like(text, F.lit("[#$%&*|]")).alias("symbols"),
        F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("words"))
    sized = words.withColumns({"n_words": F.size("words"), "n_distinct": F.size(F.array_distinct("words"))})
    conditions = [
        F.col("n_words") < 100,
        100 * F.col("n_distinct").cast("long") < 80 * F.col("n_words").cast("long"),
        100 * F.col("capitals").cast("long") > 10 * F.col("chars").cast("long"),
        F.col("symbols"),
    ]
    bits = sum([F.when(c, 1 << i).otherwise(0) for i, c in enumerate(conditions)], F.lit(0))
    return sized.select("doc_id", "part", "digest", bits.cast("int").alias("bits")).groupBy(
        "doc_id", "part", "digest", "bits").agg(F.count(F.lit(1)).alias("n"))


def marked(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``text_failures`` with the copy filter's bit (E), and how many of the rows are good and toxic.

    Rows without an id meet nothing; they are spread by their text.
    """
    first = rows.where("doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("doc_id")).select(
        "doc_id", F.lit(0).alias("salt"), "digest", F.lit(True).alias("is_first"))
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality", "toxic").where("doc_id is not null").groupBy(
        "doc_id").agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("is_good"),
                      F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("is_toxic")).withColumn("salt", F.lit(0))
    salted = rows.withColumn("salt", F.when(F.col("doc_id").isNull(), F.pmod(F.xxhash64("digest"), F.lit(1 << 20)).cast("int"))
                             .otherwise(0))
    found = salted.join(first, ["doc_id", "salt", "digest"], "left").join(known, ["doc_id", "salt"], "left")
    copy = F.col("doc_id").isNotNull() & F.col("is_first").isNull()
    return found.select(
        "doc_id", "part", "digest", (F.col("bits") + F.when(copy, 16).otherwise(0)).cast("int").alias("bits"), "n",
        F.when(F.col("is_good"), F.col("n")).otherwise(0).alias("good"),
        F.when(F.col("is_toxic"), F.col("n")).otherwise(0).alias("toxic"))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every order of the five filters, step by step, for every part of the documents.

    part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.
    """
    rows = written(text_failures(docs), "audit-texts")
    entries = written(marked(rows, labels), "audit-entries")
    k = len(FILTERS)
    sizes = removal_sizes(entries.where("bits <> 0"), ["doc_id", "digest", "bits"], k)
    totals = rows.groupBy("part").agg(F.sum("n").alias("total"))
    # At most k 2^(k-1) sizes for a part.
    by_part = sizes.groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct(
        (F.col("before") * k + F.col("filter")).alias("key"),
        F.struct("removed", "good_lost", "toxic_lost").alias("value")))).alias("sizes"))
    orders = F.explode(F.array(*[F.lit("".join(o)) for o in permutations(FILTERS)])).alias("filter_order")
    steps = totals.join(by_part, "part", "left").select("part", "total", "sizes", orders).select(
        "*", F.explode(F.sequence(F.lit(1), F.lit(k))).alias("step"))
    letter = F.substring("filter_order", F.col("step"), F.lit(1))
    earlier = F.substring("filter_order", F.lit(1), F.col("step") - 1)
    before = sum([F.when(F.contains(earlier, F.lit(f)), 1 << i).otherwise(0) for i, f in enumerate(FILTERS)], F.lit(0))
    placed = steps.withColumns({"letter": letter, "before": before})
    at = F.expr(f"instr('{FILTERS}', letter) - 1")

    def size(bits: Column, name: str) -> Column:
        return F.coalesce(F.try_element_at("sizes", (bits * k + at).cast("int"))[name], F.lit(0)).cast("long")

    everything = F.lit((1 << k) - 1) - F.expr(f"shiftleft(1, instr('{FILTERS}', letter) - 1)")
    counted = placed.select(
        "part", "filter_order", F.col("step").cast("int").alias("step"), "letter", "total",
        size(F.col("before"), "removed").alias("removed"), size(F.lit(0), "removed").alias("fails"),
        size(everything, "removed").alias("unique_fails"), size(F.col("before"), "good_lost").alias("good_lost"),
        size(F.col("before"), "toxic_lost").alias("toxic_lost"))
    # Windows of a few steps: one order of a part, and one filter of a part in all orders.
    so_far = Window.partitionBy("part", "filter_order").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    return counted.select(
        "part", "filter_order", "step", (F.col("total") - F.sum("removed").over(so_far)).alias("kept"), "removed",
        (F.col("fails") - F.col("removed")).alias("redundant"), "unique_fails", "good_lost", "toxic_lost",
        F.sum("removed").over(Window.partitionBy("part", "letter")).alias("shapley"))
