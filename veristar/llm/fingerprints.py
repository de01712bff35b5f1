"""Document fingerprints: bottom-k sketches of word-shingle hashes, in DataFrame functions only.

A text's words are the runs without ASCII white space, A-Z in lower case; its shingles are
every ``SHINGLE`` words in a row (with fewer words, the whole sequence). The sketch is the
``K`` smallest distinct hashes (32 of xxhash64's bits, ascending), so that of a union
is the ``K`` smallest of two sketches: parts of a text or of a corpus can be sketched apart and
merged, and equal sets have equal sketches. Of the smallest ``K`` hashes of a union, the share that both
sketches hold estimates the resemblance; it and the numbers of distinct shingles, estimated from the
kth hash, give the containment.

The fingerprint is the sketch in hex, eight digits a hash.

Defined results: null and empty texts and texts without words have an empty sketch and fingerprint;
two empty sketches are alike (1), an empty one and another are not (0).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import lower_ascii

K = 128
SHINGLE = 5
_LOWEST = -(1 << 31)
_RANGE = float(1 << 32)


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once a row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """White space becomes one blank, so that a plain split finds the words."""
    plain = F.translate(lower_ascii(F.coalesce(text, F.lit(""))), "\t\n\x0b\x0c\r", "     ")
    return F.filter(F.split(plain, " "), lambda w: w != "")


def sketch(text: Column, k: int = K, n: int = SHINGLE) -> Column:
    """array<int>, ascending: the k smallest distinct shingle hashes."""
    def of_words(w: Column) -> Column:
        last = F.greatest(F.size(w) - n + 1, F.lit(1))
        rows = F.transform(F.sequence(F.lit(1), last),
                           lambda i: F.shiftright(F.xxhash64(F.slice(w, i, n)), 32).cast("int"))
        return F.when(F.size(w) == 0, F.array().cast("array<int>")).otherwise(smallest(rows, k))

    return _let(words(text), of_words)


def smallest(hashes: Column, k: int = K) -> Column:
    return F.slice(F.array_sort(F.array_distinct(hashes)), 1, k)


def merged(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of the union of two parts."""
    return smallest(F.concat(a, b), k)


def merge_groups(rows: DataFrame, keys: list[str], sketch_col: str, k: int = K) -> DataFrame:
    """keys, sketch: sketches of any number of parts merged by key.

    Distinct hashes are combined before the shuffle; ranks are cut to k in each part of the
    input first (Spark's group limit), so a hot key sends k rows a task.
    """
    at = F.row_number().over(Window.partitionBy(*keys).orderBy("hash"))
    hashes = rows.select(*keys, F.explode(sketch_col).alias("hash")).distinct()
    best = hashes.withColumn("at", at).filter(F.col("at") <= k)
    return best.groupBy(*keys).agg(F.array_sort(F.collect_list("hash")).alias("sketch"))


def distinct_shingles(s: Column, k: int = K) -> Column:
    """Exact below k, else (k - 1) / (kth hash as a share of the range)."""
    share = (F.element_at(s, k).cast("double") - _LOWEST + 1) / _RANGE
    return F.when(F.size(s) < k, F.size(s).cast("double")).otherwise((k - 1) / share)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Share of the union's k smallest hashes that both sketches hold."""
    def of_union(u: Column) -> Column:
        both = F.size(F.array_intersect(F.array_intersect(u, a), b))
        return F.when(F.size(u) == 0, 1.0).otherwise(both / F.size(u))

    return _let(merged(a, b, k), of_union)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Share of ``a``'s shingles that ``b`` holds: resemblance times the union over the size of ``a``."""
    part = resemblance(a, b, k) * distinct_shingles(merged(a, b, k), k) / distinct_shingles(a, k)
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(part, F.lit(1.0)))


def fingerprint(s: Column) -> Column:
    return F.array_join(F.transform(s, lambda h: F.lpad(F.lower(F.hex(h.cast("long").bitwiseAND((1 << 32) - 1))),
                                                       8, "0")), "")


#: Ids of one bucket are put in order in one task: as many distinct ids at most.
ID_BUCKET = 4096
_NULL_ID = -(1 << 63)


def following_ids(ids: DataFrame) -> DataFrame:
    """id, next for distinct ids: the next larger id, after the last the first.

    Order within buckets of ``ID_BUCKET`` consecutive ids, then between the first ids of
    the buckets, and so on upwards: no task ever holds more than ``ID_BUCKET`` ids.
    """
    span = ids.agg(F.min("id").alias("low"), F.max("id").alias("high")).first()
    if span.low is None:
        return ids.withColumn("next", F.col("id"))

    def level(rows: DataFrame, width: int) -> DataFrame:
        if (span.high // width) - (span.low // width) < ID_BUCKET:
            order = Window.orderBy("id")
            return rows.select("id", F.coalesce(F.lead("id").over(order), F.lit(span.low)).alias("next"))
        up = width * ID_BUCKET
        place = F.shiftright("id", up.bit_length() - 1)
        rows = rows.withColumn("bucket", place)
        heads = rows.groupBy("bucket").agg(F.min("id").alias("id"))
        heads = level(heads.select("id"), up).select(place.alias("bucket"), F.col("next").alias("after"))
        order = Window.partitionBy("bucket").orderBy("id")
        return (rows.withColumn("near", F.lead("id").over(order)).join(heads, "bucket")
                .select("id", F.coalesce("near", "after").alias("next")))

    return level(ids, 1)


def edited_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, a row for each row.

    The edited text: the last quarter of the code points replaced by the first as many of the
    next document. Rows of one id have one next document; where its id is repeated, the smallest
    of its texts. A null id comes before all others.

    Texts are dealt by id once; of the next document only the needed beginning and its sketch are sent.
    """
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(_NULL_ID))
    # Both joins use the same columns of it, so that they share one exchange; the id comes back from the key.
    base = docs.select(key.alias("key"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    lengths = base.groupBy("key").agg(F.max(F.char_length("text")).alias("longest"))
    ids = lengths.select(F.col("key").alias("id"))
    wanted = (following_ids(ids).join(lengths, F.col("id") == F.col("key"))
              .select(F.col("next").alias("key"), F.col("id").alias("before"),
                      F.floor(F.col("longest") / 4).cast("int").alias("want")))
    sketched = base.withColumn("sketch", sketch(F.col("text"), k))
    # min over rows of a repeated id: the smallest text (its beginning, and the sketch with it).
    nexts = (sketched.join(wanted, "key")
             .select(F.col("before").alias("key"), F.substring("text", F.lit(1), F.col("want")).alias("head"),
                     F.col("sketch").alias("next_sketch"))
             .groupBy("key").agg(F.min(F.struct("head", "next_sketch")).alias("n")))
    rows = sketched.join(nexts, "key").select(F.nullif("key", F.lit(_NULL_ID)).alias("doc_id"), "text", "sketch", "n.head", "n.next_sketch")
    n = F.char_length("text")
    cut = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), (n - cut).cast("int")), F.substring("head", F.lit(1), cut))
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), "sketch", "next_sketch", edited.alias("edited"))
    rows = rows.select("doc_id", "n_chars", "sketch", "next_sketch", F.sha2("edited", 256).alias("edited_sha256"),
                       sketch(F.col("edited"), k).alias("edited_sketch"))
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", fingerprint(F.col("sketch")).alias("fingerprint"),
        fingerprint(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("edited_sketch"), k).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch"), k).alias("near_next"))
