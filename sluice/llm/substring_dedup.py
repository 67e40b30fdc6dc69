"""Substring dedup: words in passages that an earlier document has too are found by FM-index and cut.

A window is `length` consecutive words. It goes if its word sequence also starts in a document with a smaller id.

1. Anchors. Of the word k-grams in a window, the one with the smallest hash is its anchor; equal windows have equal anchors,
   wherever they stand. Consecutive windows with one anchor make a segment. Anchors met in one place only can't be part of a
   shared window and end here: they are counted over all documents by one shuffle of (anchor, block) numbers.
2. Segments. Documents are dealt to blocks by hash. A block sends its segments with shared anchors, each distinct one once,
   to the shard of their anchor. Segments of very frequent anchors are sent as single windows, to the shard of the window's
   own hash, so that no anchor fills a shard.
3. Shards. Each shard builds a compressed FM-index over its distinct segments and streams every segment through it: backward
   search over the wavelet matrix gives, for each window, how far it matches elsewhere, and for matches of full length the
   interval of suffixes, hence the smallest document id over all occurrences.
4. Blocks get back these ids, mark the words, and put together what is kept.

Work and memory: texts are shuffled once (both uses of the blocks read the same exchange), a block has about block_bytes of
text and a shard a fraction of that, whatever the input. Nothing of the corpus goes to the driver but its size in bytes.

Defined cases: null and empty texts have no words; documents shorter than a window keep all; repeated rows have one id, so
none of them is earlier than another; a null id counts as larger than all others; an empty table gives no rows; extra
columns are not read. Ids are integers. Word identity in anchors is by 32-bit hash; windows are compared word by word.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.fm_index import FMIndex

#: Larger than all ids.
LAST = (1 << 63) - 1
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


class Windows:
    """The windows of some texts and their runs of one anchor. Runs: doc, key (anchor's hash), first and last window; a
    window is numbered by its first word among the words of all texts."""

    def __init__(self, texts: list[str | None], length: int, gram: int) -> None:
        split = [(x or "").encode().split() for x in texts]
        self.count = np.fromiter(map(len, split), dtype=np.int64, count=len(split))
        self.words = [w for s in split for w in s]
        n, m = len(self.words), len(self.words) - length + 1
        none = np.zeros(0, dtype=np.int64)
        self.key, self.first, self.last, self.doc = none.astype(np.uint64), none, none, none
        if m < 1:
            return
        h = np.fromiter(map(zlib.crc32, self.words), dtype=np.uint64, count=n)  # collisions make anchors that are not shared, no more
        doc = np.repeat(np.arange(len(split)), self.count)
        g = h[: n - gram + 1].copy()
        for j in range(1, gram):
            g = (g ^ (g >> np.uint64(29))) * _MIX[0] + h[j : n - gram + 1 + j]
        g = (g ^ (g >> np.uint64(32))) * _MIX[1]
        g ^= g >> np.uint64(31)
        best, wide, span = g, 1, length - gram + 1
        while 2 * wide <= span:  # the least of each `wide` neighbours
            best, wide = np.minimum(best[:-wide], best[wide:]), 2 * wide
        best = np.minimum(best[:m], best[span - wide : span - wide + m])
        own = np.flatnonzero(doc[:m] == doc[length - 1 :])
        if not own.size:
            return
        new = np.r_[True, (best[own][1:] != best[own][:-1]) | (own[1:] != own[:-1] + 1)]
        place = np.arange(own.size)
        new |= (place - np.maximum.accumulate(np.where(new, place, 0))) % span == 0  # where one anchor repeats, runs stay short
        begins = np.flatnonzero(new)
        self.first, self.last = own[begins], own[np.r_[begins[1:], own.size] - 1]
        self.key, self.doc = best[self.first], doc[self.first]


def _with_keys(w: Windows, keys: np.ndarray, hot: np.ndarray) -> Iterator[tuple[int, int, bool]]:
    """(run, place in keys, hot) of the runs whose key is among keys (sorted)."""
    if keys.size and w.key.size:
        k = np.minimum(np.searchsorted(keys, w.key), keys.size - 1)
        for r in np.flatnonzero(keys[k] == w.key):
            yield int(r), int(k[r]), bool(hot[k[r]])


def _parts(w: Windows, run: int, hot: bool, length: int) -> Iterator[tuple[int, bytes]]:
    """(first window, words joined by spaces) of what a run sends: itself, or its windows one by one."""
    first, last = int(w.first[run]), int(w.last[run])
    for i, j in ((i, i) for i in range(first, last + 1)) if hot else ((first, last),):
        yield i, b" ".join(w.words[i : j + length])


def _shard(rows: pd.DataFrame, length: int) -> pd.DataFrame:
    """For each row (block, key, hot, seg, lo, hi): the smallest document of each of its windows, where that is news."""
    least: dict[bytes, int] = {}
    for seg, lo in zip(rows["seg"], rows["lo"], strict=True):
        least[seg] = min(lo, least.get(seg, LAST))
    number: dict[bytes, int] = {}
    seqs = [[number.setdefault(x, len(number) + 1) for x in seg.split(b" ")] for seg in least]
    sizes = np.fromiter(map(len, seqs), dtype=np.int64, count=len(seqs))
    starts = np.cumsum(sizes + 1) - sizes  # a 0 stands before each segment
    seq = np.zeros(int((sizes + 1).sum()), dtype=np.int64)
    of = np.zeros(seq.size, dtype=np.int64)
    for k, (at, s) in enumerate(zip(starts, seqs, strict=True)):
        seq[at : at + len(s)] = s
        of[at - 1 : at + len(s)] = k
    windows = sizes - length + 1
    mine = np.repeat(np.arange(len(seqs)), windows)
    within = np.arange(int(windows.sum())) - np.repeat(np.cumsum(windows) - windows, windows)
    own = np.fromiter(least.values(), dtype=np.int64, count=len(least))
    mins = own[mine]
    if len(seqs) > 1:
        index = FMIndex(seq, length)
        got, lo, hi = index.search(seq, starts[mine] + within + length, length)
        full = np.flatnonzero(got == length)
        if full.size:
            docs = np.r_[own[of[index.order]], LAST]
            mins[full] = np.minimum.reduceat(docs, np.stack([lo[full], hi[full]], axis=1).ravel())[::2]
    found = dict(zip(least, np.split(mins, np.cumsum(windows)[:-1]), strict=True))
    out = [(r.block, r.key, r.hot, xxhash.xxh3_128_digest(r.seg), m.tolist()) for r in rows.itertuples(index=False) if (m := found[r.seg]).min() < r.hi]
    return pd.DataFrame(out, columns=["block", "key", "hot", "digest", "mins"])


def cut_repeats(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = 13,
    gram: int = 5,
    block_bytes: int = 8_000_000,
    hot_documents: int = 2000,
) -> DataFrame:
    """(id_col, n_words, n_removed, removed array<struct<start, end>> of word numbers, kept: the words left, by one space)."""
    id_type = df.schema[id_col].dataType.simpleString()
    size = df.agg(F.sum(F.octet_length(text_col)).alias("n")).first()["n"] or 0
    n_blocks = max(1, -(-size // block_bytes))
    n_shards = 4 * n_blocks
    rows = df.select(
        F.pmod(F.xxhash64(id_col, text_col), F.lit(n_blocks)).cast("int").alias("block"),
        F.col(id_col).alias("id"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("ord"),
        F.col(text_col).alias("text"),
    )

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                b = batch.slice(at, 1000)
                w = Windows(b.column(1).to_pylist(), length, gram)
                block = b.column(0).to_numpy()[w.doc]
                o = np.lexsort((w.key, block))
                key, block, doc = w.key[o], block[o], w.doc[o]
                new = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (block[1:] != block[:-1])]) if key.size else np.zeros(0, dtype=np.int64)
                n = np.diff(np.r_[new, key.size])
                yield pa.RecordBatch.from_arrays([pa.array(key[new].view(np.int64)), pa.array(block[new] | (np.minimum(n, 1 << 30).astype(np.int64) << 32))], names=["key", "place"])

    # place: the block, and above 32 bits how many runs of it have the key here.
    seen = rows.select("block", "text").mapInArrow(anchors, "key long, place long")
    total = F.expr("sum(shiftright(place, 32)) over (partition by key)")
    shared = seen.withColumn("total", total).where("total > 1")
    shared = shared.select(F.col("place").bitwiseAND(F.lit((1 << 32) - 1)).cast("int").alias("block"), "key", (F.col("total") > hot_documents).alias("hot")).distinct()

    def segments(docs: pd.DataFrame, keys: pd.DataFrame) -> pd.DataFrame:
        out: dict[tuple[int, bool, bytes], list[int]] = {}
        if len(docs) and len(keys):
            keys = keys.assign(u=keys["key"].to_numpy().view(np.uint64)).sort_values("u")
            known, hot = keys["u"].to_numpy(), keys["hot"].to_numpy()
            w = Windows(list(docs["text"]), length, gram)
            ords = docs["ord"].to_numpy()
            for run, k, is_hot in _with_keys(w, known, hot):
                o = int(ords[w.doc[run]])
                for _, seg in _parts(w, run, is_hot, length):
                    x = out.setdefault((k, is_hot, seg), [o, o])
                    x[0], x[1] = min(x[0], o), max(x[1], o)
        block = int(docs["block"].iloc[0]) if len(docs) else 0
        made = [((xxhash.xxh3_64_intdigest(seg) if h else int(known[k])) % n_shards, block, int(known[k].view(np.int64)), h, seg, lo, hi) for (k, h, seg), (lo, hi) in out.items()]
        return pd.DataFrame(made, columns=["shard", "block", "key", "hot", "seg", "lo", "hi"])

    def finish(docs: pd.DataFrame, news: pd.DataFrame) -> pd.DataFrame:
        w = Windows(list(docs["text"]), length, gram)
        gone = np.zeros(len(w.words), dtype=bool)
        if len(news) and len(docs):
            news = news.assign(u=news["key"].to_numpy().view(np.uint64))
            mins = dict(zip(news["digest"].map(bytes), news["mins"], strict=True))
            keys = news.drop_duplicates("u").sort_values("u")
            ords = docs["ord"].to_numpy()
            for run, _, is_hot in _with_keys(w, keys["u"].to_numpy(), keys["hot"].to_numpy()):
                o = ords[w.doc[run]]
                for first, seg in _parts(w, run, is_hot, length):
                    found = mins.get(xxhash.xxh3_128_digest(seg))
                    if found is None:
                        continue
                    older = found < o
                    if older.all():
                        gone[first : first + older.size - 1 + length] = True
                        continue
                    for i in np.flatnonzero(older):
                        gone[first + i : first + i + length] = True
        ends = np.cumsum(w.count)
        out = []
        for k, e in enumerate(ends):
            s = e - w.count[k]
            g = gone[s:e]
            edges = np.flatnonzero(np.diff(np.r_[False, g, False].astype(np.int8)))
            spans = [{"start": int(a), "end": int(b)} for a, b in zip(edges[::2], edges[1::2], strict=True)]
            kept = [x for x, y in zip(w.words[s:e], g, strict=True) if not y] if spans else w.words[s:e]
            out.append((int(w.count[k]), int(g.sum()), spans, b" ".join(kept).decode()))
        res = pd.DataFrame(out, columns=["n_words", "n_removed", "removed", "kept"])
        res.insert(0, id_col, docs["id"].to_numpy())
        return res

    blocks = rows.groupBy("block")
    sent = blocks.cogroup(shared.groupBy("block")).applyInPandas(segments, "shard int, block int, key long, hot boolean, seg binary, lo long, hi long")
    news = sent.groupBy("shard").applyInPandas(lambda pdf: _shard(pdf, length), "block int, key long, hot boolean, digest binary, mins array<long>")
    schema = f"`{id_col}` {id_type}, n_words long, n_removed long, removed array<struct<start: long, end: long>>, kept string"
    return blocks.cogroup(news.groupBy("block")).applyInPandas(finish, schema)
