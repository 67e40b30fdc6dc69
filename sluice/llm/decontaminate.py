"""Benchmark decontamination: an Aho-Corasick automaton over the benchmark's word windows, run once over every text.

Texts are normalised to lower-case words (letters and digits of ASCII, and everything beyond ASCII) joined by one space; a
window is `window` consecutive words of an item, or all of a shorter item. The automaton is built in each Python worker from
the windows, which travel as a broadcast variable; every match is mapped back to words, and on demand to offsets in the
original text.

The benchmark is cut into shards of about max_chars characters of windows, each with an automaton of its own. A usual
benchmark is one shard and each text is then scanned once; a larger one takes a pass over the texts for each shard, and the
hit words of all passes are merged text by text.

Defined cases: null and empty texts have no words and no hits; items without words match nothing; an empty benchmark
contaminates nothing; repeated rows are judged each by itself; extra columns pass through, whatever their names in
drop_contaminated(); scan() refuses names that it would add.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from sluice.llm.common import stored

#: Everything that is not a word character: ASCII but for digits and letters. After lower-casing no A-Z is left.
_BETWEEN = {c: " " for c in range(128) if not (48 <= c <= 57 or 97 <= c <= 122)} | {c: chr(c + 32) for c in range(65, 91)}
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def norm_words(text: str | None) -> list[str]:
    """Lower-case words of a text."""
    return [w for w in (text or "").translate(_BETWEEN).split(" ") if w]


class Automaton:
    """Aho-Corasick over windows of words. Keys are space + words joined by spaces + space, so that matches end at words."""

    def __init__(self, items: list[tuple[object, str]], window: int = 10) -> None:
        owners: dict[str, list] = defaultdict(list)
        for item, text in items:
            w = norm_words(text)
            for i in range(max(1, len(w) - window + 1) if w else 0):
                owners[" ".join(w[i : i + window])].append(item)
        self.tree = ahocorasick.Automaton()
        for key, ids in owners.items():
            self.tree.add_word(f" {key} ", (key.count(" ") + 1, tuple(dict.fromkeys(ids))))
        self.empty = not owners
        if owners:
            self.tree.make_automaton()

    def find(self, w: list[str]) -> tuple[np.ndarray, set]:
        """Which of the words are hit, and the items with occurring windows."""
        hit, items = np.zeros(len(w), dtype=bool), set()
        if self.empty or not w:
            return hit, items
        ends = None
        for end, (n, ids) in self.tree.iter(f" {' '.join(w)} "):
            if ends is None:
                ends = np.cumsum(np.fromiter(map(len, w), dtype=np.int64, count=len(w)) + 1)
            last = int(np.searchsorted(ends, end))
            hit[last - n + 1 : last + 1] = True
            items.update(ids)
        return hit, items


def spans(text: str, hit: np.ndarray) -> list[tuple[int, int]]:
    """Runs of hit words as (start, end) offsets of code points in the original text."""
    out: list[tuple[int, int]] = []
    before = False
    for now, m in zip(hit, _WORD.finditer(text), strict=True):
        if now and before:
            out[-1] = (out[-1][0], m.end())
        elif now:
            out.append((m.start(), m.end()))
        before = bool(now)
    return out


def benchmark_shards(benchmark: DataFrame, id_col: str, text_col: str, window: int, max_chars: int) -> list[DataFrame]:
    """The benchmark in parts whose windows have at most about max_chars characters, by a hash of the item."""
    chars = benchmark.agg(F.sum(F.length(text_col)).alias("n")).first()["n"] or 0
    n = max(1, -(-chars * window // max_chars))
    rows = benchmark.select(id_col, text_col)
    return [rows.where(F.pmod(F.xxhash64(id_col), F.lit(n)) == k) if n > 1 else rows for k in range(n)]


def scan(df: DataFrame, benchmark: DataFrame, text_col: str = "text", id_col: str = "item_id", item_text_col: str = "text", window: int = 10, max_chars: int = 64_000_000) -> DataFrame:
    """df's columns, then _n_words, _n_hit (long), _items (array of the item ids with occurring windows, as strings, sorted)
    and _spans (array of structs start, end: hit passages of the text).

    What is broadcast at a time is one shard, whose size benchmark_shards() bounds. With one shard, the usual case, each text
    is scanned once and nothing is stored or shuffled; with more, each shard's pass writes what it found beside the rows."""
    added = {"_n_words": "long", "_n_hit": "long", "_items": "array<string>", "_spans": "array<struct<start: long, end: long>>"}
    if twice := {c.lower() for c in df.columns} & {"_mask", *added}:
        raise ValueError(f"columns that scan() would add are there already: {sorted(twice)}")
    parts = benchmark_shards(benchmark, id_col, item_text_col, window, max_chars)
    names = df.columns
    at, out = names.index(text_col), df
    for k, part in enumerate(parts):
        rows = df.sparkSession.sparkContext.broadcast([(r[0], r[1]) for r in part.collect()])
        last = k == len(parts) - 1
        more = ", ".join(f"{c} {t}" for c, t in (added if last else {"_mask": "binary", "_items": "array<string>"}).items())
        out = out.mapInArrow(_pass(rows, names, at, window, last), StructType([*df.schema, *DataType.fromDDL(more)]))
        out = out if last else stored(out, "hits")
    return out


def _pass(rows: Broadcast, names: list[str], at: int, window: int, last: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = Automaton(rows.value, window)
        for b in batches:
            texts, n_words, masks, items = b.column(at).to_pylist(), [], [], []
            before = [x.to_pylist() for x in b.columns[len(names) :]]
            for i, text in enumerate(texts):
                w = norm_words(text)
                hit, found = tree.find(w)
                found = set(map(str, found))
                if before:
                    hit |= np.unpackbits(np.frombuffer(before[0][i], np.uint8), count=len(w)).astype(bool)
                    found |= set(before[1][i])
                n_words.append(len(w))
                masks.append(hit)
                items.append(sorted(found))
            ids = pa.array(items, type=pa.list_(pa.string()))
            if not last:
                yield pa.RecordBatch.from_arrays([*b.columns[: len(names)], pa.array([np.packbits(m).tobytes() for m in masks], type=pa.binary()), ids], names=[*names, "_mask", "_items"])
                continue
            found_at = [[{"start": s, "end": e} for s, e in spans(t, m)] if m.any() else [] for t, m in zip(texts, masks, strict=True)]
            cols = [
                pa.array(n_words, type=pa.int64()),
                pa.array([int(m.sum()) for m in masks], type=pa.int64()),
                ids,
                pa.array(found_at, type=pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
            ]
            yield pa.RecordBatch.from_arrays([*b.columns[: len(names)], *cols], names=[*names, "_n_words", "_n_hit", "_items", "_spans"])

    return run


def drop_contaminated(df: DataFrame, benchmark: DataFrame, text_col: str = "text", **options: object) -> DataFrame:
    """The rows of df in whose text no window of the benchmark occurs."""
    own = df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("own"), F.col(f"`{text_col}`").alias("text"))
    return scan(own, benchmark, "text", **options).where("_n_hit = 0").select("own.*")
