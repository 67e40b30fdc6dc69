"""SimHash near-duplicates: fingerprints, pivot distance tables, and connected groups.

A fingerprint has 64 bits; two rows are linked where theirs differ in at most max_distance bits, and a group is what links
connect. Equal fingerprints are one node from the start, so copies never meet pair by pair.

The pivot table holds each fingerprint's Hamming distances to fixed reference fingerprints, eight to a number. By the triangle
inequality two fingerprints whose distances to any pivot differ by more than max_distance are not linked: such pairs are
discarded by the pivot table alone, and the survivors are verified by the exact distance. Pivot distances can't say which
pairs to look at (a coordinate of random fingerprints has a standard deviation of 4 in 64 bits, so one pivot lets through
almost half of all pairs), so pairs come from buckets: the 64 bits are cut into blocks, and fingerprints within max_distance
agree in all bits of some `blocks - max_distance` blocks. No link is lost.

keep_one() goes by the same fingerprints, blocks and pivot table, here of a text's distinct five-word shingles: each set is held
against the first one of its group of fingerprints, by the exact Jaccard similarity. What differs in more bits than fingerprints can
tell from strangers (at a similarity of 0.8 they are ten bits apart) is sought beside, in MinHash buckets, but not again what the
fingerprints have settled.

Inside a bucket not all pairs are looked at; see graph.bucket_groups().

Defined cases: null and empty texts have fingerprint zero, linked like any other; a null id is larger than all others, and a
group of null ids alone has a null component; repeated rows are copies; an empty table gives no rows; other columns are not
read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import discard, hidden, stored
from sluice.llm.graph import bucket_groups, sizes_allow

#: Shingles that are hashed and counted at a time, which bounds memory for very long texts.
CHUNK = 1 << 18


def _majority(ones: np.ndarray, n: int) -> int:
    return int(np.packbits(2 * ones > n).view(">i8")[0])


def _ones(h: np.ndarray) -> np.ndarray:
    """How many of the hashes have each of the 64 bits."""
    return np.unpackbits(h.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)


def set_fingerprint(h: np.ndarray) -> int:
    """The SimHash of a set of hashes, as a signed number; of none, zero."""
    return _majority(sum((_ones(h[at : at + CHUNK]) for at in range(0, len(h), CHUNK)), np.zeros(64, dtype=np.int64)), len(h))


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """The SimHash of the word shingles of a text, A-Z lower-cased, as a signed number."""
    w = (text or "").encode().lower().split()  # bytes: ASCII only, in both
    if not w:
        return 0
    n = max(1, len(w) - shingle + 1)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, CHUNK):
        part = w[at : at + CHUNK + shingle - 1]
        grams = zip(*(part[k:] for k in range(shingle)), strict=False) if len(w) >= shingle else [w]
        h = np.fromiter((xxhash.xxh64_intdigest(g, seed) for g in map(b" ".join, grams)), dtype=np.uint64)
        ones += _ones(h)
    return _majority(ones, n)


def with_fingerprints(df: DataFrame, id_col: str, text_col: str = "text", shingle: int = 3, seed: int = 42) -> DataFrame:
    """(id_col, fingerprint long) for each row of df."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = pa.array([fingerprint(x.as_py(), shingle, seed) for x in b.column(1)], type=pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), fp], names=[id_col, "fingerprint"])

    return df.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {df.schema[id_col].dataType.simpleString()}, fingerprint long")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def pivots(n: int, seed: int = 7) -> list[int]:
    """Reference fingerprints: hashes of numbers."""
    return [_signed(xxhash.xxh64_intdigest(str(k), seed)) for k in range(n)]


def block_keys(fp: Column, blocks: int, agree: int) -> Column:
    """One hash for each choice of `agree` blocks, of the choice and the bits in them."""
    edges = [round(64 * k / blocks) for k in range(blocks + 1)]
    masks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges[:-1], edges[1:], strict=True)]
    choices = [sum(masks[k] for k in c) for c in combinations(range(blocks), agree)]
    return F.array(*(F.xxhash64(F.lit(k), fp.bitwiseAND(F.lit(_signed(m)))) for k, m in enumerate(choices)))


def _apart(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def pivot_table(fp: Column, n_pivots: int) -> list[Column]:
    """Distances to the pivots, eight to a number, named p0, p1, ..."""
    far = [F.bit_count(fp.bitwiseXOR(F.lit(p))).cast("long") for p in pivots(n_pivots)]
    return [reduce(lambda x, y: x.bitwiseOR(y), (F.shiftleft(d, 8 * k) for k, d in enumerate(far[at : at + 8]))).alias(f"p{at // 8}") for at in range(0, n_pivots, 8)]


def near_groups(items: DataFrame, max_distance: int, blocks: int = 6, n_pivots: int = 16, name: str = "near") -> DataFrame:
    """(id, component), stored, of every item that is linked to another one. items: (id, fp: long), ids distinct."""
    table = pivot_table(F.col("fp"), n_pivots)
    keyed = items.select("id", F.explode(block_keys(F.col("fp"), blocks, blocks - max_distance)).alias("key"), *table)

    def close(a: Callable[[str], Column], b: Callable[[str], Column]) -> Column:
        """The largest difference of pivot distances is within max_distance."""
        at = lambda x, k: F.shiftright(x(f"p{k // 8}"), 8 * (k % 8)).bitwiseAND(F.lit(255))
        return reduce(lambda x, y: x & y, (F.abs(at(a, k) - at(b, k)) <= max_distance for k in range(n_pivots)))

    def verify(pairs: DataFrame) -> DataFrame:
        both = pairs.join(items.toDF("a", "fa"), "a").join(items.toDF("b", "fb"), "b")
        return stored(both.where(_apart("fa", "fb") <= max_distance).select("a", "b"), f"{name}-links")

    return bucket_groups(keyed, verify, name, close, tuple(f"p{k}" for k in range(-(-n_pivots // 8))))


def groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_distance: int = 3, blocks: int = 6, seed: int = 42) -> DataFrame:
    """(id_col, fingerprint long, component_id): the smallest id reachable over links, for each row of df; all links are found.

    Texts are read once and never shuffled; what is shuffled is one fingerprint per row and, for each distinct fingerprint,
    one key for each choice of blocks."""
    fps = stored(with_fingerprints(df, id_col, text_col, shingle, seed), "fingerprints")
    least = fps.groupBy("fingerprint").agg(F.min(id_col).alias("least"))
    items = stored(least.select(F.col("fingerprint").alias("id"), F.col("fingerprint").alias("fp")), "items")
    found = near_groups(items, max_distance, blocks)
    nodes = stored(least.join(found.withColumnRenamed("id", "fingerprint"), "fingerprint", "left").withColumn("component", F.coalesce("component", "fingerprint")), "nodes")
    heads = nodes.groupBy("component").agg(F.min("least").alias("component_id"))
    for old in (items, found):
        discard(old)
    return fps.join(nodes.join(heads, "component").select("fingerprint", "component_id"), "fingerprint")


def shingles(text: str | None, shingle: int = 5, seed: int = 42) -> np.ndarray:
    """The distinct hashes of the word shingles of a text, A-Z lower-cased, ascending; of all words where they are fewer."""
    w = (text or "").encode().lower().split()
    out = np.empty(0, dtype=np.uint64)
    if not w:
        return out
    if len(w) < shingle:
        return np.array([xxhash.xxh64_intdigest(b" ".join(w), seed)], dtype=np.uint64)
    for at in range(0, len(w) - shingle + 1, CHUNK):
        part = w[at : at + CHUNK + shingle - 1]
        grams = zip(*(part[k:] for k in range(shingle)), strict=False)
        out = np.union1d(out, np.fromiter((xxhash.xxh64_intdigest(g, seed) for g in map(b" ".join, grams)), dtype=np.uint64))
    return out


def minhash_keys(h: np.ndarray, agree: int, tables: int) -> list[int]:
    """One key for each table, of `agree` minima of mixes of h; two sets of similarity J share each with probability J**agree."""
    if not len(h):
        return [0]
    out = []
    for t in range(tables):
        least = np.empty(agree, dtype=np.uint64)
        for k in range(agree):
            x = (h + np.uint64((0x9E3779B97F4A7C15 * (t * agree + k + 1)) % (1 << 64))) * np.uint64(0xBF58476D1CE4E5B9)
            x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
            least[k] = (x ^ (x >> np.uint64(32))).min()
        out.append(_signed(xxhash.xxh64_intdigest(least.tobytes(), t)))
    return out


def _similar_pairs(texts: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """(a, b) of the rows (a, b, ta, tb) whose texts' shingle sets have a Jaccard similarity of at least `similarity`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for x, y in zip(b.column(2), b.column(3), strict=True):
                x, y = shingles(x.as_py(), shingle), shingles(y.as_py(), shingle)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(both >= similarity * (len(x) + len(y) - both) - 1e-9)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array(keep, type=pa.bool_()))

    return texts.select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long")


def print_pairs(least: DataFrame, max_distance: int) -> DataFrame:
    """(a, b), a < b, stored, of the sets (id, fp) whose fingerprints are linked, over others or not: each with the first of its group."""
    items = stored(least.select(F.col("fp").alias("id"), "fp").distinct(), "copy-items")
    found = near_groups(items, max_distance, name="copy-prints")
    nodes = least.select("id", "fp").join(found.withColumnRenamed("id", "fp"), "fp", "left").select("id", F.coalesce("component", "fp").alias("c"))
    heads = nodes.groupBy("c").agg(F.min("id").alias("a"), F.count(F.lit(1)).alias("n")).where("n > 1")
    pairs = stored(nodes.join(heads, "c").where("id <> a").select("a", F.col("id").alias("b")), "copy-pairs")
    for old in (items, found):
        discard(old)
    return pairs


def keep_one(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, similarity: float = 0.8, agree: int = 4, tables: int = 20, max_distance: int = 3
) -> DataFrame:
    """The rows of df without those that another row of their group stands for: the one with the smallest id stays; of rows
    that share this id, the ones with the smallest 64-bit hash of id and text (rows equal in both: one of them). Null ids are
    larger than all others. Texts without words are copies of each other.

    Links are pairs whose sets of five-word shingles have a Jaccard similarity of at least 0.8, by exact count. Pairs to count are
    those of print_pairs(), and those that share a MinHash bucket: 1 - (1 - 0.8**4)**20 = 0.99997 of those at 0.8 do, and more above."""
    row = hidden(df, "row")[0]
    keyed = df.withColumn(row, F.struct(F.col(id_col).isNull().alias("z"), F.col(id_col).alias("i"), F.xxhash64(id_col, text_col).alias("h")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [shingles(x.as_py(), shingle) for x in b.column(1)]
            ids = pa.array([_signed(xxhash.xxh64_intdigest(h.tobytes())) for h in sets], type=pa.int64())
            keys = pa.array([minhash_keys(h, agree, tables) for h in sets], type=pa.list_(pa.int64()))
            prints = pa.array([set_fingerprint(h) for h in sets], type=pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), ids, pa.array([len(h) for h in sets], type=pa.int32()), keys, prints], names=["row", "id", "size", "keys", "fp"])

    kind = keyed.schema[row].dataType.simpleString()
    rows = keyed.select(F.col(row).alias("row"), F.col(text_col).alias("t"))
    sets = stored(rows.mapInArrow(run, f"row {kind}, id long, size int, keys array<long>, fp long"), "shingles")
    least = stored(sets.groupBy("id").agg(F.min("row").alias("row"), F.min("size").alias("size"), F.min("keys").alias("keys"), F.min("fp").alias("fp")), "least")

    def verify(pairs: DataFrame) -> DataFrame:
        ids = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
        found = rows.join(least.select("id", "row").join(ids, "id"), "row").select("id", "t").dropDuplicates(["id"])
        texts = stored(found, "copy-texts")
        both = pairs.join(texts.withColumnsRenamed({"id": "a", "t": "ta"}), "a").join(texts.withColumnsRenamed({"id": "b", "t": "tb"}), "b")
        links = stored(_similar_pairs(both, shingle, similarity), "copy-links")
        discard(texts)
        return links

    pairs = print_pairs(least, max_distance)
    links = verify(pairs)
    found = bucket_groups(least.select("id", F.explode("keys").alias("key"), "size"), verify, "copies", sizes_allow(similarity), known=(pairs, links))
    # Rows that stay are those of their group's first set and place; of rows equal in id and text one, hence the drop of repeats.
    one = least.join(found, "id", "left").groupBy(F.coalesce("component", "id").alias("c")).agg(F.min("row").alias("row")).select("row")
    one = stored(one, "copies-kept")
    twice = stored(sets.groupBy("row").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("row").join(one, "row"), "copies-twice")
    for old in (sets, least, found, pairs, links):
        discard(old)
    kept = keyed.join(one.withColumnRenamed("row", row), row, "left_semi")
    if twice.take(1):
        again = kept.join(twice.withColumnRenamed("row", row), row, "left_semi").dropDuplicates([row])
        kept = kept.join(twice.withColumnRenamed("row", row), row, "left_anti").unionByName(again)
    return kept.select(*(F.col(f"`{c}`") for c in df.columns))
