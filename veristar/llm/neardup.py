"""Near-duplicate documents by an LSH forest over MinHash signatures.

Sets. A-Z is lower-cased, words are runs without ASCII white space, and a document's set holds
its distinct shingles of ``width`` words (with fewer words, its whole sequence; without words nothing, and it is
linked with nothing). Shingles are 64-bit hashes. Two documents are linked if
100 * |A & B| >= 80 * |A | B|; components are those of the links.

Classes. Documents with equal sets form a class, found by a digest of the set; only one document of each
class, the smallest, goes on, so copies are never expanded into pairs.

Forest. A signature of ``TREES * DEPTH`` minima gives ``TREES`` sorted orders of ``DEPTH`` values. Two
documents that share the first ``SHORTEST`` values of an order stand in one region of it. Two linked
documents miss each other in all orders with a chance of at most (1 - 0.8**3)**16 = 1e-5.
Regions with more than ``REGION`` documents are split at the next value, and so on (adaptive
depth); documents equal in all values are split by a hash of their id.

Candidates grow with the number of documents, not of pairs:

1. Each region of each depth has a pivot, the pivot of its largest child. A document is compared with the
   pivot that most of its regions name.
2. Documents not yet joined are compared with the other pivots of their regions and with the
   ``NEIGHBOURS`` next documents in each order (longest common prefix).
3. An exact pass finds every link that the forest left: a prefix-filter join between components. The shingles of each
   set are put in one order of all shingles, those of few documents first: a table of ``PLACES`` counts over all documents,
   of fixed size (shingles of one place are counted together). At the first shingle that two linked
   sets share, at places p and q, the rest of both holds the overlap that a link needs:
   ``(100 + SHARED) * min(n - p, m - q) >= SHARED * (n + m)``. Places that can meet this with no partner are not written. Shingles
   that stay within one component are dropped, and postings that no other one of their shingle can be linked with, by places, sizes and, of two,
   sketches; the others are joined under that condition and that of a sketch of each set, whose bits cannot differ more than the sets. The order decides only how many pairs are tried, not which links are found.

Every link is confirmed on the full sets.

Defined results of ``linked_components``: null text is empty; a null id is never linked (component null, kept);
repeated ids count as one document of the class of each row; ties go to the smaller id; an empty table gives an
empty result; other columns stay out. ``without_near_copies`` counts every different row as a document of its own, also where ids
repeat or are null, and keeps of each component one row: that of the smallest id (of rows that repeat an id, that of the smallest hash
of all columns); rows equal in all columns are one row; texts without words are near copies of nothing.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, fresh, kept_in_worker, shuffles_dropped, slices, written

TREES = 16
DEPTH = 8
SHORTEST = 3
REGION = 512
NEIGHBOURS = 3
SHARED = 80
#: Words of a shingle unless the caller says otherwise.
WIDTH = 2
#: Tasks that the members of one component are dealt over where they meet its label.
LABEL_SALTS = 32
#: Places of the table that counts the documents of each shingle (a power of two), and of one of its blocks.
PLACES, BLOCK = 1 << 23, 1 << 12
#: 64-bit words of the sketch that goes with each posting.
SHORT = 4
BITMAP_BITS = 1 << 23
#: Sizes of sets are told apart by this factor when a shingle's postings are looked at together.
BAND = 1.02

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_CHUNK = 1 << 18


def _powers() -> tuple[np.ndarray, np.ndarray]:
    up = np.full(_CHUNK, _BASE, dtype=_U)
    down = np.full(_CHUNK, _BASE_INVERSE, dtype=_U)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = (x ^ (x >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


class Hasher:
    """Texts to sets of shingle hashes and to signatures."""

    def __init__(self, width: int = WIDTH, seed: int = 1):
        self.width = width
        self.up, self.down = _powers()
        rng = np.random.default_rng(seed)
        n = TREES * DEPTH
        self.a = rng.integers(0, 1 << 63, n, dtype=np.int64).astype(_U) * _U(2) + _U(1)
        self.b = rng.integers(0, 1 << 63, n, dtype=np.int64).astype(_U)

    def words(self, data: bytes) -> np.ndarray:
        """A hash for each word: the polynomial of its bytes, without its place."""
        parts, start = [], 0
        data = data.translate(_LOWER)
        while start < len(data):
            end = len(data)
            if end - start > _CHUNK:  # cut behind the last white space of the chunk
                end = start + _CHUNK
                cut = max(data.rfind(s, start, end) for s in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c"))
                if cut < 0:  # one word longer than a chunk
                    stop = min((i for s in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c")
                                if (i := data.find(s, end)) >= 0), default=len(data))
                    word = data[start:stop].strip(b" \t\n\r\x0b\x0c")
                    digest = hashlib.blake2b(word, digest_size=8).digest()
                    parts.append(np.frombuffer(digest, dtype=_U))
                    start = stop
                    continue
                end = cut + 1
            parts.append(self._words(np.frombuffer(data, dtype=np.uint8, count=end - start, offset=start)))
            start = end
        return np.concatenate(parts) if parts else np.zeros(0, _U)

    def _words(self, b: np.ndarray) -> np.ndarray:
        space = (b == 32) | ((b >= 9) & (b <= 13))
        edge = np.diff(np.concatenate([[True], space, [True]]).astype(np.int8))
        starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        if not len(starts):
            return np.zeros(0, _U)
        total = np.concatenate([np.zeros(1, _U), np.cumsum((b.astype(_U) + _U(1)) * self.up[:len(b)])])
        value = (total[ends] - total[starts]) * self.down[starts]
        return mixed(value ^ (ends - starts).astype(_U))

    def shingles(self, text: str | None) -> np.ndarray:
        """The sorted set."""
        w = self.words((text or "").encode("utf-8", "surrogatepass"))
        if not len(w):
            return w
        n = max(1, len(w) - self.width + 1)
        whole = mixed(w[:n] + _U(7))
        for j in range(1, min(self.width, len(w))):
            whole = mixed(whole * _U(0xD6E8FEB86659FD93) + mixed(w[j:j + n] + _U(j)))
        if len(w) < self.width:  # no sequence of other length has its hash
            whole = mixed(whole + _U(len(w)))
        return np.unique(whole)

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        low = np.full(len(self.a), ~_U(0))
        for start in range(0, len(shingles), 2048):
            part = shingles[start:start + 2048]
            low = np.minimum(low, (self.a[:, None] * part + self.b[:, None]).min(axis=1))
        return (low >> _U(32)).astype(np.uint32)


def sets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """doc_id, n_shingles, digest (of the set), signature, for each row; beside them, for each task, rows of block and counts only.

    The texts are cut once for both. A task counts in ``PLACES`` bytes for how many of its texts a shingle stands at each place (at most 255).
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h: Hasher = kept_in_worker(f"neardup-hasher-{width}", lambda: Hasher(width))
        types = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int32(), pa.binary()]
        names = ["doc_id", "n_shingles", "digest", "signature", "block", "counts"]
        table = np.zeros(PLACES, np.uint8)
        for batch in slices(batches):
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                s = h.shingles(text)
                at = places(s)
                table[at] += table[at] < 255
                rows.append((doc_id, len(s), hashlib.blake2b(s.tobytes(), digest_size=16).digest(),
                             h.signature(s).astype(">u4").tobytes() if len(s) else None, None, None))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
        for block, part in enumerate(table.reshape(-1, BLOCK)):
            if part.any():
                row = (None, None, None, None, block, zlib.compress(part.tobytes(), 1))
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names=names)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, "doc_id long, n_shingles long, digest binary, signature binary, block int, counts binary")


def orders(classes: DataFrame) -> DataFrame:
    """tree, values (the tree's part of the signature), node: a row for each class and tree."""
    trees = F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree")
    return classes.select("node", "signature", trees).select(
        "node", "tree", F.substring("signature", F.col("tree") * (4 * DEPTH) + 1, F.lit(4 * DEPTH)).alias("values"))


def _prefix(depth: int):
    return F.substring("values", 1, 4 * depth)


def pivots(placed: DataFrame) -> DataFrame:
    """tree, depth, prefix, size, pivot of the regions with two or more documents, the shortest first.

    The deepest are summed from documents, each other depth from its children.
    """
    level = placed.groupBy("tree", "values").agg(F.count("*").alias("size"), F.min("node").alias("pivot"))
    found = None
    for depth in range(DEPTH, SHORTEST - 1, -1):
        if depth < DEPTH:
            best = F.max_by("pivot", F.struct("size", -F.col("pivot")))
            level = (level.groupBy("tree", _prefix(depth).alias("values"))
                     .agg(best.alias("pivot"), F.sum("size").alias("size")))
        part = level.filter("size > 1").select("tree", F.lit(depth).alias("depth"), F.col("values").alias("prefix"),
                                               "size", "pivot")
        found = part if found is None else found.unionByName(part)
    return found


def components(edges: DataFrame, purpose: str, scratch: Scratch) -> DataFrame:
    """node, label: the smallest node that each node of ``edges`` (a, b) reaches."""
    both = scratch.written(edges.select(F.col("a").alias("node"), F.col("b").alias("other"))
                           .unionByName(edges.select(F.col("b").alias("node"), F.col("a").alias("other"))).distinct(),
                           f"{purpose}-edges")
    labels = scratch.written(both.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("label")),
                             f"{purpose}-labels")
    while True:
        near = (both.join(labels.select(F.col("node").alias("other"), F.col("label").alias("near")), "other")
                .groupBy("node").agg(F.min("near").alias("near")))
        step = scratch.written(labels.select("node", "label").join(near, "node").select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("label")), f"{purpose}-steps")
        # A label is a node too: its own label is a shortcut. Each label looks it up once.
        moved = (step.select("label").distinct()
                 .join(step.select(F.col("node").alias("label"), F.col("label").alias("ahead")), "label")
                 .filter("ahead < label"))
        done = scratch.written(_moved_on(step, moved), f"{purpose}-labels")
        changed = not done.filter("label != old").isEmpty()
        scratch.drop(step, labels)
        if not changed:
            scratch.drop(both)
            return done
        labels = done


def _moved_on(labels: DataFrame, moved: DataFrame) -> DataFrame:
    """``labels`` with ``ahead`` in place of each label that ``moved`` (label, ahead) has.

    The members of a label, of which one component may have any number, meet it in several tasks.
    """
    ahead = moved.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(LABEL_SALTS - 1))))
    salted = labels.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(LABEL_SALTS)).cast("int"))
    return salted.join(ahead, ["label", "salt"], "left").withColumn("label", F.coalesce("ahead", "label")).select(*labels.columns)


def extended(labels: DataFrame, edges: DataFrame, purpose: str, scratch: Scratch) -> DataFrame:
    """node, label: ``labels`` after further edges (a, b). Only the components that these edges name are walked, a node for each."""
    labels = labels.select("node", "label")
    ends = edges.select("a", "b")
    for side in "ab":
        of = labels.select(F.col("node").alias(side), F.col("label").alias("of"))
        ends = ends.join(of, side, "left").withColumn(side, F.coalesce("of", side)).drop("of")
    ends = scratch.written(ends.filter("a != b").distinct(), f"{purpose}-ends")
    met = components(ends, purpose, scratch).select("node", "label")
    scratch.drop(ends)
    known = _moved_on(labels, met.select(F.col("node").alias("label"), F.col("label").alias("ahead")))
    found = scratch.written(known.unionByName(met.join(labels, "node", "left_anti")), f"{purpose}-labels")
    return found


def bitmap(ids: DataFrame) -> bytes:
    """A filter of fixed size (1 MB): the hashed ids that may be needed."""
    at = F.pmod(F.xxhash64("node"), F.lit(BITMAP_BITS)) + 1
    rows = (ids.groupBy(F.bitmap_bucket_number(at).alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits")).collect())
    out = bytearray(BITMAP_BITS // 8)
    for r in rows:
        start = (r.bucket - 1) * 4096
        out[start:start + len(r.bits)] = r.bits
    return bytes(out)


def set_table(docs: DataFrame, nodes: DataFrame, id_col: str, text_col: str, width: int, scratch: Scratch) -> DataFrame:
    """node, shingles of at least the given documents, without a shuffle of texts."""
    bits = bitmap(nodes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h: Hasher = kept_in_worker(f"neardup-hasher-{width}", lambda: Hasher(width))
        for batch in slices(batches):
            node, at = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            text = batch.column(1)
            kept = [i for i, p in enumerate(at) if bits[p >> 3] >> (p & 7) & 1]
            yield pa.RecordBatch.from_arrays(
                [pa.array([node[i] for i in kept], pa.int64()),
                 pa.array([h.shingles(text[i].as_py()).tobytes() for i in kept], pa.binary())],
                names=["node", "shingles"])

    at = F.pmod(F.xxhash64(F.col(id_col).cast("long")), F.lit(BITMAP_BITS))
    rows = docs.filter(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("node"), F.col(text_col).alias("text"), at.cast("int").alias("at"))
    return scratch.written(rows.mapInArrow(run, "node long, shingles binary"), "neardup-sets")


def similar(x: np.ndarray, y: np.ndarray, shared: int = SHARED) -> bool:
    """Whether 100 * |X & Y| >= shared * |X | Y| (sorted sets)."""
    small, large = (x, y) if len(x) <= len(y) else (y, x)
    if 100 * len(small) < shared * len(large) or not len(small):
        return False
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    both = int((large[at] == small).sum())
    return 100 * both >= shared * (len(x) + len(y) - both)


def confirmed(pairs: DataFrame, table: DataFrame, purpose: str, scratch: Scratch) -> DataFrame:
    """a, b, linked for each candidate pair, on the full sets.

    Sets of ``a`` go to ``b``; pairs of one hot ``b`` are dealt over several tasks by Spark's skew join.
    """
    one = table.select(F.col("node").alias("a"), F.col("shingles").alias("of_a"))
    two = table.select(F.col("node").alias("b"), F.col("shingles").alias("of_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = batch.column(2), batch.column(3)
            linked = [similar(np.frombuffer(x[i].as_buffer(), _U), np.frombuffer(y[i].as_buffer(), _U))
                      for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(linked, pa.bool_())],
                                             names=["a", "b", "linked"])

    rows = pairs.select("a", "b").distinct().join(one, "a").join(two, "b").select("a", "b", "of_a", "of_b")
    return scratch.written(rows.mapInArrow(run, "a long, b long, linked boolean"), purpose)


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs (a < b) of different components, with their labels."""
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a != b").distinct()
    for side in ("a", "b"):
        known = labels.select(F.col("node").alias(side), F.col("label").alias(f"label_{side}"))
        pairs = pairs.join(known, side, "left").withColumn(
            f"label_{side}", F.coalesce(f"label_{side}", side))
    return pairs.filter("label_a != label_b")


def neighbours(placed: DataFrame, regions: DataFrame) -> DataFrame:
    """a, b: documents next to each other in an order, in regions of adaptive depth."""
    rows = placed
    # The depth of a document's region: the first at which it holds no more than REGION documents.
    large = regions.filter(F.col("size") > REGION).select("tree", "depth", "prefix")
    deep = F.lit(SHORTEST)
    for depth in range(SHORTEST, DEPTH + 1):
        mark = (large.filter(F.col("depth") == depth)
                .select("tree", F.col("prefix").alias(f"p{depth}"), F.lit(True).alias(f"large{depth}")))
        rows = rows.withColumn(f"p{depth}", _prefix(depth)).join(mark, ["tree", f"p{depth}"], "left")
        deep = F.when(F.col(f"large{depth}"), F.lit(depth + 1)).otherwise(deep)
    rows = rows.withColumn("deep", deep).withColumn(
        "salt", F.when(F.col("deep") > DEPTH, F.pmod(F.xxhash64("node"), F.lit(1 << 16))))
    # Documents equal in all values have no order of their own; equal neighbours of a hash will do.
    region = F.substring("values", F.lit(1), F.least(F.col("deep"), F.lit(DEPTH)) * 4)
    order = Window.partitionBy("tree", region, F.pmod(F.col("salt"), F.lit(64))).orderBy("values", "node")
    near = [F.struct(F.lag("node", i).over(order).alias("a"), F.col("node").alias("b"))
            for i in range(1, NEIGHBOURS + 1)]
    return (rows.select(F.array(*near).alias("pairs")).select(F.explode("pairs").alias("p"))
            .select("p.a", "p.b").filter("a is not null").distinct())


def places(shingles: np.ndarray) -> np.ndarray:
    """Where the table of counts counts each shingle."""
    return (shingles >> _U(65 - PLACES.bit_length())).astype(np.int64)


def document_counts(docs: DataFrame, text_col: str, width: int) -> np.ndarray:
    """For each place, how many documents have a shingle there (at most 65,535), over all documents."""
    return summed_counts(sets(docs.select(F.lit(None).alias("id"), F.col(text_col).alias("text")), "id", "text", width))


def summed_counts(found: DataFrame) -> np.ndarray:
    """``document_counts`` of what ``sets`` gives: the tables of its tasks are summed block by block."""
    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, counts in zip(batch.column(0).to_pylist(), batch.column(1)):
                if block not in sums:
                    sums[block] = np.zeros(BLOCK, np.uint32)
                sums[block] += np.frombuffer(zlib.decompress(counts.as_buffer()), np.uint8)
        for block, counts in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int32()), pa.array([np.minimum(counts, 65535).astype(np.uint16).tobytes()])],
                names=["block", "counts"])

    schema = "block int, counts binary"
    with shuffles_dropped(found.sparkSession):
        found = (found.filter("block is not null").select("block", "counts")
                 .repartition("block").mapInArrow(total, schema).toArrow())
    table = np.zeros((PLACES // BLOCK, BLOCK), np.uint16)
    for block, counts in zip(found.column(0).to_pylist(), found.column(1)):
        table[block] = np.frombuffer(counts.as_buffer(), np.uint16)
    return table.reshape(-1)


def rare_first(shingles: np.ndarray, common: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A set in the order of all shingles: by count (0 if not common), then by hash."""
    if not len(common):
        return shingles
    at = np.searchsorted(common, shingles)
    at[at == len(common)] = 0
    return shingles[np.lexsort((shingles, np.where(common[at] == shingles, counts[at], 0)))]


def prefix_size(n: int, shared: int = SHARED) -> int:
    """The places of a set of ``n`` at which the first shared shingle of a link may stand."""
    least = (n + (shared * n + 99) // 100) * shared  # with the smallest partner
    return n - -(-least // (100 + shared)) + 1 if n else 0


def sketch(shingles: np.ndarray) -> bytes:
    """A bitmap of at least 2 bits a shingle: each flips its bit."""
    bits = max(256, 1 << (2 * len(shingles) - 1).bit_length())
    flips = np.bincount((shingles % _U(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(flips.astype(np.uint8)).tobytes()


def folded(bitmap: bytes, words: int = SHORT) -> np.ndarray:
    """A sketch folded to ``words`` 64-bit words."""
    x = np.frombuffer(bitmap, np.int64)
    while len(x) > words:
        x = x[:len(x) // 2] ^ x[len(x) // 2:]
    return x


def may_link(n: int, x: np.ndarray, m: int, y: np.ndarray, shared: int = SHARED) -> bool:
    """Whether sketches of sets of ``n`` and ``m`` allow a link: sets differ in at least as many shingles as sketches in bits."""
    while len(x) > len(y):  # a smaller sketch is the larger one folded
        x = x[:len(x) // 2] ^ x[len(x) // 2:]
    while len(y) > len(x):
        y = y[:len(y) // 2] ^ y[len(y) // 2:]
    overlap = -(-shared * (n + m) // (100 + shared))
    return int(np.bitwise_count(x ^ y).sum()) <= n + m - 2 * overlap


def allowed(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """The pairs whose sketches allow a link."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m, x, y = batch.column(2).to_pylist(), batch.column(3).to_pylist(), batch.column(4), batch.column(5)
            good = [may_link(n[i], np.frombuffer(x[i].as_buffer(), _U), m[i], np.frombuffer(y[i].as_buffer(), _U))
                    for i in range(batch.num_rows)]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    one = sketches.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("sketch").alias("of_a"))
    two = sketches.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("sketch").alias("of_b"))
    rows = pairs.join(one, "a").join(two, "b").select("a", "b", "n_a", "n_b", "of_a", "of_b")
    return rows.mapInArrow(run, "a long, b long").distinct()


def prefixes(docs: DataFrame, counts: np.ndarray, id_col: str, text_col: str, width: int) -> DataFrame:
    """node, digest, n, sketch, short (the sketch folded), rare: the shingles of each set's prefix, in order."""
    order = docs.sparkSession.sparkContext.broadcast(counts)  # 2 * PLACES bytes
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h: Hasher = kept_in_worker(f"neardup-hasher-{width}", lambda: Hasher(width))
        for batch in slices(batches):
            rows = []
            for node, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                s = h.shingles(text)
                rare = rare_first(s, s, order.value[places(s)])[:prefix_size(len(s))]
                bits = sketch(s)
                rows.append((node, hashlib.blake2b(s.tobytes(), digest_size=16).digest(), len(s), bits, folded(bits),
                             rare.view(np.int64)))
            types = [pa.int64(), pa.binary(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                             names=["node", "digest", "n", "sketch", "short", "rare"])

    rows = docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("node"),
                                                         F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "node long, digest binary, n long, sketch binary, short array<long>, rare array<long>").filter("n > 0")


def with_partner(rows: DataFrame, words: list[str]) -> DataFrame:
    """The postings that another one of their shingle may be linked with (rows: shingle, node, label, n, rest, words of the sketch).

    What is known of a shingle's postings together decides, so no pair is made: a shingle of one component
    alone makes none. Of two postings, places, sizes and sketches (their exclusive or) are compared in full. Of more, a
    posting stays if one of another size that its place allows may be there: sizes are marked as bands in 64 bits, one band
    a factor of ``BAND``, sizes further apart share a bit.
    """
    def band(size: str) -> str:
        return f"cast(floor(ln({size}) / ln({BAND}D)) as int)"

    of = Window.partitionBy("shingle")
    rows = rows.withColumn("bit", F.expr(f"shiftleft(1L, pmod({band('n')}, 64))"))
    rows = rows.withColumns({
        "k": F.count("*").over(of), "low": F.min("label").over(of), "high": F.max("label").over(of),
        "all_n": F.sum("n").over(of), "least": F.min("rest").over(of),
        "bits": F.bit_or("bit").over(of), "odd": F.bit_xor("bit").over(of),
        **{f"x_{w}": F.bit_xor(w).over(of) for w in words}})
    differ = " + ".join(f"bit_count(x_{w})" for w in words)
    two = f"{100 + SHARED} * least >= {SHARED} * all_n and {differ} <= {_bits_apart('all_n')}"
    # Sizes of partners: SHARED percent of n at least, and what the place leaves at most.
    most = f"({100 + SHARED}D * rest / {SHARED} - n)"
    # A band more on either side, for rounding.
    first, last = f"({band(f'{SHARED / 100}D * n')} - 1)", f"({band(f'greatest({most}, 1D)')} + 1)"
    run = f"(shiftleft(1L, least({last} - {first} + 1, 63)) - 1)"
    start = f"pmod({first}, 64)"
    wanted = f"(shiftleft({run}, {start}) | if({start} = 0, 0L, shiftrightunsigned({run}, 64 - {start})))"
    # The own band counts if it holds another: an even number, or three, which leaves at most k - 2 bands.
    others = "(bits & ~if((odd & bit) = 0 or bit_count(bits) <= k - 2, 0L, bit))"
    many = f"{last} >= {first} and ({others} & {wanted}) != 0"
    return rows.filter("k > 1 and low < high").filter(f"if(k = 2, {two}, {many})")


def _bits_apart(both: str) -> str:
    """SQL: in how many shingles two linked sets of so many together may differ."""
    return f"({both} - 2 * (({SHARED} * ({both}) + {99 + SHARED}) div {100 + SHARED}))"


def across(prefix: DataFrame, scratch: Scratch) -> DataFrame:
    """a, b: all pairs of different components whose prefixes and sketches allow a link (prefix: node, label, n, sketch, short, rare)."""
    known = scratch.written(prefix.select("node", "label", "n", "sketch", "short", "rare"), "neardup-prefixes")
    words = [f"s{i}" for i in range(SHORT)]
    rows = known.select("node", "label", "n", *[F.get("short", F.lit(i)).alias(w) for i, w in enumerate(words)],
                        F.posexplode("rare").alias("pos", "shingle")).withColumn("rest", F.col("n") - F.col("pos")).drop("pos")
    rows = scratch.written(with_partner(rows, words).select("shingle", "node", "label", "n", *words, "rest"), "neardup-postings")
    one, two = (rows.select("shingle", *[F.col(c).alias(f"{c}_{side}") for c in ("node", "label", "n", "rest", *words)])
                for side in "ab")
    enough = (100 + SHARED) * F.least("rest_a", "rest_b") >= SHARED * (F.col("n_a") + F.col("n_b"))
    # The join itself refuses pairs whose sketches differ in more bits than linked sets can in shingles.
    differ = sum((F.bit_count(F.col(f"{w}_a").bitwiseXOR(F.col(f"{w}_b"))) for w in words), F.lit(0))
    close = differ <= F.expr(_bits_apart("n_a + n_b"))
    pairs = one.join(two, "shingle").filter(
        (F.col("node_a") < F.col("node_b")) & (F.col("label_a") != F.col("label_b")) & enough & close)
    pairs = scratch.written(pairs.select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct(), "neardup-pairs")
    scratch.drop(rows)
    return allowed(pairs, known.select("node", "n", "sketch"))


def linked_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, for each row of ``docs``."""
    scratch = Scratch(docs.sparkSession)
    found = scratch.written(sets(docs, id_col, text_col, width), "neardup-signatures")
    rows = found.filter("block is null").select("doc_id", "n_shingles", "digest", "signature")
    full = rows.filter("n_shingles > 0 and doc_id is not null")
    of_class = scratch.written(full.groupBy("digest").agg(F.min("doc_id").alias("node"), F.count("*").alias("n")),
                               "neardup-classes")
    # A document can be in several classes only if its id is repeated with other texts.
    heads = full.join(of_class.select("digest", F.col("node").alias("doc_id")), ["digest", "doc_id"], "left_semi")
    classes = scratch.written(heads.groupBy(F.col("doc_id").alias("node")).agg(F.min("signature").alias("signature")),
                              "neardup-heads")
    placed = orders(classes)
    regions = scratch.written(pivots(placed), "neardup-regions")
    # Regions of two or more at the shortest depth hold all candidates; the rest is dropped here.
    roots = regions.filter(F.col("depth") == SHORTEST).select("tree", F.col("prefix").alias("root"))
    placed = scratch.written(placed.withColumn("root", _prefix(SHORTEST)).join(roots, ["tree", "root"]).drop("root"),
                             "neardup-orders")
    met = None
    for depth in range(SHORTEST, DEPTH + 1):
        of = regions.filter(F.col("depth") == depth).select("tree", F.col("prefix").alias("p"), "pivot")
        part = placed.withColumn("p", _prefix(depth)).join(of, ["tree", "p"]).select("node", "pivot", "tree")
        met = part if met is None else met.unionByName(part)
    met = scratch.written(met.filter("node != pivot").groupBy("node", "pivot").agg(F.count("*").alias("n")),
                          "neardup-pivots")
    nearby = scratch.written(neighbours(placed, regions), "neardup-neighbours")
    scratch.drop(placed, regions)

    # Nodes that any candidate names; their sets are read once.
    named = (met.select("node").union(met.select("pivot")).union(nearby.select("a")).union(nearby.select("b")))
    stored = set_table(docs, named.toDF("node"), id_col, text_col, width, scratch)
    table = stored.join(classes.select("node"), "node", "left_semi")
    first = met.groupBy("node").agg(F.max_by("pivot", F.struct("n", -F.col("pivot"))).alias("pivot"))
    tried = confirmed(first.select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")),
                      table, "neardup-first", scratch)
    labels = components(tried.filter("linked").select("a", "b"), "neardup-first", scratch)

    more = _apart(met.select(F.col("node").alias("a"), F.col("pivot").alias("b")).unionByName(nearby), labels)
    more = scratch.written(more.select("a", "b").join(tried.select("a", "b"), ["a", "b"], "left_anti"), "neardup-more")
    second = confirmed(more, table, "neardup-second", scratch)
    scratch.drop(stored, met, nearby, more)
    tried = tried.unionByName(second)
    labels = extended(labels, second.filter("linked"), "neardup-second", scratch)

    scratch.drop(classes)
    # Labels meet the classes first, so prefixes are dealt out once.
    heads = of_class.select("digest", "node").join(labels.select("node", "label"), "node", "left").select(
        "digest", "node", F.coalesce("label", "node").alias("label"))
    prefix = prefixes(docs, summed_counts(found), id_col, text_col, width).join(heads, ["digest", "node"])
    left = scratch.written(across(prefix, scratch).join(tried.select("a", "b"), ["a", "b"], "left_anti"), "neardup-left")
    ends = left.select(F.col("a").alias("node")).union(left.select("b"))
    rest = set_table(docs, ends, id_col, text_col, width, scratch)
    third = confirmed(left, rest.join(ends.distinct(), "node", "left_semi"), "neardup-third", scratch)
    scratch.drop(rest, left)
    labels = extended(labels, third.filter("linked"), "neardup-third", scratch)

    # From classes back to documents: only digests of classes that hold more than one document, or are linked.
    known = of_class.join(labels.select("node", "label"), "node", "left").select("digest", F.coalesce("label", "node").alias("component_id"))
    out = rows.join(known, "digest", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("n_shingles") > 0, F.when(F.col("doc_id").isNotNull(), F.col("component_id")))
        .otherwise(F.col("doc_id")).alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def numbered(docs: DataFrame, id_col: str, node: str) -> tuple[DataFrame, DataFrame | None]:
    """``docs`` with a number for each different row: its id, and one beyond all ids for further rows of an id and rows without.

    Also the further numbers (number, id), if there are any.
    """
    rows = docs.withColumn(node, F.col(id_col).cast("long"))
    ids = rows.select(F.col(node).alias("i"))
    repeated = written(ids.groupBy("i").agg(F.count("*").alias("n")).filter("n > 1 or i is null").select("i"), "neardup-repeated")
    if repeated.isEmpty():
        return rows, None
    h1, h2 = fresh(rows, "h1", "h2")
    present = [F.col(f"`{c}`").isNull().cast("int") for c in docs.columns]
    values = [F.col(f"`{c}`") for c in docs.columns]
    rows = rows.withColumns({h: F.xxhash64(F.lit(i), *present, *values) for i, h in enumerate((h1, h2))})
    keys = rows.select(F.col(node).alias("i"), F.col(h1).alias("x"), F.col(h2).alias("y"))
    keys = keys.join(repeated.select(F.col("i").alias("r")), F.col("i").eqNullSafe(F.col("r")), "left_semi").distinct()
    first = keys.filter("i is not null").groupBy("i").agg(F.min(F.struct("x", "y")).alias("m")).select("i", "m.x", "m.y")
    further = written(keys.join(first, ["i", "x", "y"], "left_anti"), "neardup-further")
    top = ids.agg(F.coalesce(F.max("i"), F.lit(0))).first()[0]
    # Numbers go by place in a written table, and are written at once.
    extra = written(further.select(F.col("i").alias("ei"), F.col("x").alias("ex"), F.col("y").alias("ey"),
                                   (F.monotonically_increasing_id() + F.lit(top + 1)).alias("extra")), "neardup-numbers")
    same = F.col(node).eqNullSafe(F.col("ei")) & (F.col(h1) == F.col("ex")) & (F.col(h2) == F.col("ey"))
    out = rows.join(extra, same, "left").withColumn(node, F.coalesce("extra", F.col(node)))
    return written(out.select(*docs.columns, node), "neardup-numbered"), extra.select(F.col("extra").alias("number"), F.col("ei").alias("id"))


def without_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """One row of each component; columns as in ``docs``."""
    (node,) = fresh(docs, "node_number")
    rows, further = numbered(docs, id_col, node)
    found = linked_components(rows, node, text_col, width)
    if further is None:
        kept = found.filter("kept").select("doc_id").distinct()
    else:
        own = F.when(F.col("number").isNull(), F.col("doc_id")).otherwise(F.col("id"))
        best = F.min(F.struct(own.isNull().alias("none"), own.alias("own"), "doc_id"))
        kept = found.join(further, F.col("doc_id") == F.col("number"), "left").groupBy("component_id").agg(best.alias("m")).select("m.doc_id")
    kept = kept.select(F.col("doc_id").alias(f"{node}_kept"))
    return rows.join(kept, F.col(node) == F.col(f"{node}_kept"), "left_semi").dropDuplicates([node]).select(*docs.columns)
