"""Token files: ids of all documents in order, in blocks of a patched frame of reference, written and read back by Spark.

A segment holds whole documents, about SEGMENT_IDS ids: a header, the documents' ids and lengths, an index of block starts, and
blocks of BLOCK ids. A block is its smallest id, and what each id is above it, packed in so many bits as the given percentile of
these differences needs; what is wider is patched: its low bits are packed, its position and its high bits are in the block's
list of exceptions. The index makes any range of ids readable without the blocks before it.

Documents are dealt by ranges of their id (of equal ids, by a hash of the text and the scan's partition), sorted, encoded and packed
where they arrive: a task holds one segment and one text. Segments are the records of plain binary files that Spark's own file
writer commits, each followed by one newline byte, so a task that runs again leaves no second copy and any store that Spark
writes to will do. A segment says which task's part it is in (by that part's first document) and how many ids of the part are
before it; what is before the parts is one small sum for each.

Ids come from the tokenizers library. Where the file's own rules cut texts at white space into pieces that are encoded each by
itself, the library is asked once for each piece that a worker meets, and remembers a bounded number of them.

Format, little-endian: b"PFR1", length of what follows (u32), crc32 of it (u32), then:
  documents (u32), ids (u64), ids of the part before (u64), part's first document: null (u8), id (i64), hash (i64), partition (i32),
  number of blocks (u32); per document: null (u8 each), id (i64 each), ids (u32 each); block starts (u32 each, one more than blocks);
  blocks: smallest id (u32), width (u8), exceptions (u8), bytes of their high bits (u8), packed differences, positions (u8 each), high bits.

Defined cases: null and empty texts are documents of the end id alone; rows that repeat are documents each; null ids come last;
documents of equal ids are in the order of a hash of their text; an empty table gives files without segments, and no rows; a text
of any length is one document of one segment; ids that are no integers are an error; other columns are not read.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.llm.common import stored

BLOCK, SEGMENT_IDS, FILE_SEGMENTS = 256, 1 << 18, 64
MAGIC = b"PFR1"
_HEAD = struct.Struct("<IQQBqqiI")
_BLOCK_HEAD = np.dtype([("low", "<u4"), ("width", "u1"), ("patched", "u1"), ("bytes", "u1")])
#: The longest piece that a worker remembers the ids of.
_LONG_PIECE = 40


def _to_bits(values: np.ndarray, width: int) -> np.ndarray:
    """The low `width` bits of each row's numbers, packed, highest bit first."""
    bits = np.unpackbits(values.astype(">u4").view(np.uint8).reshape(*values.shape, 4), axis=-1)
    return np.packbits(bits[:, :, 32 - width :].reshape(len(values), -1), axis=1)


def _from_bits(packed: np.ndarray, width: int) -> np.ndarray:
    bits = np.zeros((len(packed), BLOCK, 32), dtype=np.uint8)
    bits[:, :, 32 - width :] = np.unpackbits(packed, axis=1).reshape(len(packed), BLOCK, width)
    return np.packbits(bits, axis=-1).view(">u4").reshape(len(packed), BLOCK)


def pack_blocks(ids: np.ndarray, percentile: float = 0.9) -> tuple[np.ndarray, bytes]:
    """(block starts, blocks) of ids; the last block is filled up with its last id, which readers leave out."""
    n = -(-len(ids) // BLOCK)
    if not n:
        return np.zeros(1, dtype="<u4"), b""
    full = np.concatenate([ids, np.full(n * BLOCK - len(ids), ids[-1], dtype=ids.dtype)]).astype(np.int64).reshape(n, BLOCK)
    low = full.min(axis=1)
    above = full - low[:, None]
    needed = np.ceil(np.log2(above + 1.0)).astype(np.int64)
    at = min(BLOCK - 1, max(0, int(np.ceil(percentile * BLOCK)) - 1))
    width = np.partition(needed, at, axis=1)[:, at]
    high = above >> width[:, None]
    rows, cols = np.nonzero(high)
    patched = np.bincount(rows, minlength=n)
    size = np.ceil(np.ceil(np.log2(high.max(axis=1) + 1.0)) / 8).astype(np.int64)
    heads = np.zeros(n, dtype=_BLOCK_HEAD)
    heads["low"], heads["width"], heads["patched"], heads["bytes"] = low, width, patched, size
    packed: list[bytes] = [b""] * n
    for w in np.unique(width[width > 0]).tolist():
        which = np.flatnonzero(width == w)
        for k, x in zip(which.tolist(), _to_bits(above[which], w), strict=True):
            packed[k] = x.tobytes()
    ends = np.r_[0, np.cumsum(patched)].tolist()
    where, what = cols.astype("u1").tobytes(), high[rows, cols].astype("<u4").view("u1").reshape(-1, 4)
    what = what[np.arange(4) < size[rows, None]].tobytes()  # as many bytes of each as the block's largest needs
    at = np.r_[0, np.cumsum(patched * size)].tolist()
    head, h = heads.tobytes(), _BLOCK_HEAD.itemsize
    out = [b"".join((head[k * h : (k + 1) * h], packed[k], where[ends[k] : ends[k + 1]], what[at[k] : at[k + 1]])) for k in range(n)]
    starts = np.r_[0, np.cumsum([len(x) for x in out])].astype("<u4")
    return starts, b"".join(out)


def unpack_blocks(starts: np.ndarray, blocks: bytes, first: int = 0, last: int | None = None) -> np.ndarray:
    """The ids of blocks first up to, not including, last."""
    last = len(starts) - 1 if last is None else last
    at, n = starts[first:last].astype(np.int64), last - first
    if n <= 0:
        return np.zeros(0, dtype=np.uint32)
    raw, size = np.frombuffer(blocks, dtype=np.uint8), _BLOCK_HEAD.itemsize
    heads = np.ascontiguousarray(raw[at[:, None] + np.arange(size)]).view(_BLOCK_HEAD).ravel()
    width, patched = heads["width"].astype(np.int64), heads["patched"].astype(np.int64)
    out = np.zeros((n, BLOCK), dtype=np.int64)
    for w in np.unique(width[width > 0]).tolist():
        which = np.flatnonzero(width == w)
        out[which] = _from_bits(raw[at[which, None] + size + np.arange(BLOCK * w // 8)], w)
    rows = np.repeat(np.arange(n), patched)
    nth = np.arange(len(rows)) - np.repeat(np.cumsum(patched) - patched, patched)
    lists = at + size + BLOCK * width // 8
    cols = raw[lists[rows] + nth]
    high, wide = np.zeros(len(rows), dtype=np.int64), heads["bytes"].astype(np.int64)[rows]
    for b in range(4):
        has = wide > b
        high[has] |= raw[(lists + patched)[rows[has]] + wide[has] * nth[has] + b].astype(np.int64) << 8 * b
    out[rows, cols] += high << width[rows]
    return (out + heads["low"].astype(np.int64)[:, None]).ravel().astype(np.uint32)


@dataclass
class Segment:
    """A segment as read: documents with their ids (None: null), how many ids each has, and blocks of which any range can be had."""

    before: int
    part: tuple[int, int, int, int]
    doc_ids: list[int | None]
    lengths: np.ndarray
    n: int
    starts: np.ndarray
    blocks: bytes

    def ids(self, start: int = 0, length: int | None = None) -> np.ndarray:
        """Ids from a place on; only the blocks that hold them are read."""
        stop = self.n if length is None else min(self.n, start + length)
        first = start // BLOCK
        return unpack_blocks(self.starts, self.blocks, first, -(-stop // BLOCK))[start - first * BLOCK : stop - first * BLOCK]


def write_segment(doc_ids: list[int | None], ids: list[np.ndarray], before: int, part: tuple[int, int, int, int], percentile: float = 0.9) -> bytes:
    every = np.concatenate(ids)
    starts, blocks = pack_blocks(every, percentile)
    body = b"".join(
        (
            _HEAD.pack(len(doc_ids), len(every), before, *part, len(starts) - 1), np.array([x is None for x in doc_ids], dtype="u1").tobytes(),
            np.array([x or 0 for x in doc_ids], dtype="<i8").tobytes(), np.array([len(x) for x in ids], dtype="<u4").tobytes(), starts.tobytes(), blocks,
        )
    )
    return b"".join((MAGIC, struct.pack("<II", len(body), zlib.crc32(body)), body))


def read_segments(data: bytes) -> Iterator[Segment]:
    at = 0
    while at < len(data):
        if data[at : at + 4] != MAGIC:
            raise ValueError("not a token file")
        size, crc = struct.unpack_from("<II", data, at + 4)
        body = data[at + 12 : at + 12 + size]
        if zlib.crc32(body) != crc:
            raise ValueError("a segment of a token file is damaged")
        docs, n, before, *part, n_blocks = _HEAD.unpack_from(body)
        p = _HEAD.size
        nulls = np.frombuffer(body, dtype="u1", count=docs, offset=p)
        known = np.frombuffer(body, dtype="<i8", count=docs, offset=p + docs).tolist()
        lengths = np.frombuffer(body, dtype="<u4", count=docs, offset=p + 9 * docs)
        starts = np.frombuffer(body, dtype="<u4", count=n_blocks + 1, offset=p + 13 * docs)
        blocks = body[p + 13 * docs + 4 * (n_blocks + 1) :]
        yield Segment(before, tuple(part), [None if z else i for z, i in zip(nulls.tolist(), known, strict=True)], lengths, n, starts, blocks)
        at += 13 + size  # and the newline


class Remembered:
    """A map of bounded size: when one generation is full, only what is asked for again stays."""

    def __init__(self, size: int = 400_000) -> None:
        self.size, self.now, self.old = size, {}, {}

    def missing(self, keys: set[str]) -> list[str]:
        """Of keys, those without a value. The others can be had from now until the next call."""
        if len(self.now) + len(keys) > self.size:
            self.now, self.old = {}, self.now
        keys = keys.difference(self.now)
        self.now.update((k, self.old[k]) for k in keys & self.old.keys())
        return list(keys.difference(self.now))


#: The rules of files whose texts are cut at white space into pieces that are encoded each by itself.
_RULE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_NORMAL = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
_SPLIT = [{"type": "Split", "pattern": {"Regex": _RULE}, "behavior": "Removed", "invert": True}, {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]
#: In texts of printable ASCII, white space and the letters from U+00C0 to U+00FF, lower-cased, _PIECE finds what the rule finds.
_UNUSUAL = r"[^\t-\r\x20-\x7eÀ-ÖØ-öø-ÿ]"
_PIECE = r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^ \t-\ra-zß-öø-ÿ0-9]+"
#: Bytes of text that are cut into pieces at once.
_AT_ONCE = 1 << 22


class Encoder:
    """Token ids of texts by a tokenizers file, with the end id after each, as unsigned numbers. All ids come from the library: for
    files of the rules above, once for each piece that a worker meets, and from memory after that; else for each text."""

    def __init__(self, path: str, end: int) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tok, self.end = Tokenizer.from_file(path), end
        self.kind = np.dtype("<u2" if self.tok.get_vocab_size() <= 1 << 16 and end < 1 << 16 else "<u4")
        self.added = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.divided = (spec["normalizer"] or {}).get("normalizers") == _NORMAL and (spec["pre_tokenizer"] or {}).get("pretokenizers") == _SPLIT and not spec.get("post_processor")
        self.divided &= model["type"] == "BPE" and model.get("end_of_word_suffix") == "</w>" and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix"))
        if self.divided:
            self.plain = Tokenizer.from_file(path)  # for pieces, which need no more normalising or cutting
            self.plain.normalizer = None
            self.plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
            self.last = np.zeros(self.tok.get_vocab_size(), dtype=bool)
            self.last[[k for x, k in self.tok.get_vocab().items() if x.endswith("</w>")]] = True
        self.pieces = Remembered()

    def _whole(self, text: str) -> np.ndarray:
        return np.array([*self.tok.encode(text, add_special_tokens=False).ids, self.end], dtype=self.kind)

    def _asked(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces, many of them in one text: each piece's last id is one that ends a word."""
        out: list[bytes] = []
        for at in range(0, len(pieces), 512):
            some = pieces[at : at + 512]
            ids = np.array(self.plain.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, dtype=self.kind)
            ends = (np.flatnonzero(self.last[ids]) + 1).tolist()
            if len(ends) != len(some):
                raise ValueError("a piece has more than one end")
            raw, size = ids.tobytes(), self.kind.itemsize
            out += [raw[a * size : e * size] for a, e in zip([0, *ends], ends, strict=False)]
        return out

    def _by_pieces(self, texts: pa.Array) -> list[np.ndarray]:
        """Each distinct piece of some texts is looked up once; the rest is taking ids by number."""
        cut = pc.ascii_split_whitespace(pc.replace_substring_regex(pc.utf8_lower(texts), _PIECE, r"\0 "))
        coded = cut.flatten().dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        new = self.pieces.missing({x for x in distinct if x})
        self.pieces.now.update(zip(new, self._asked(new), strict=True))
        each = [self.pieces.now[x] if x else b"" for x in distinct] + [np.array([self.end], dtype=self.kind).tobytes()]
        for x in new:
            if len(x) > _LONG_PIECE:
                del self.pieces.now[x]
        pool, lengths = np.frombuffer(b"".join(each), dtype=self.kind), np.array([len(x) for x in each]) // self.kind.itemsize
        ends = cut.offsets.to_numpy()[1:] - cut.offsets[0].as_py()
        which = np.insert(coded.indices.to_numpy(), ends, len(distinct))  # the end id after each text
        n = lengths[which]
        after = np.cumsum(n)
        ids = pool[np.repeat((np.cumsum(lengths) - lengths)[which] - after + n, n) + np.arange(after[-1])]
        return np.split(ids, after[ends + np.arange(len(ends))][:-1])

    def __call__(self, texts: pa.Array) -> Iterator[np.ndarray]:
        texts = texts.fill_null("")
        if not self.divided:
            yield from (self._whole(t.as_py()) for t in texts)
            return
        size = np.cumsum(pc.binary_length(texts).to_numpy())
        bounds = [0, *(np.flatnonzero(np.diff(size // _AT_ONCE)) + 1).tolist(), len(texts)]
        for a, e in zip(bounds, bounds[1:], strict=False):
            part = texts.slice(a, e - a)
            odd = pc.match_substring_regex(part, "|".join([_UNUSUAL, *map(re.escape, self.added)]))
            usual = part.filter(pc.invert(odd))
            plain = iter(self._by_pieces(usual) if len(usual) else [])
            yield from (self._whole(part[k].as_py()) if o else next(plain) for k, o in enumerate(odd.to_pylist()))


@lru_cache(maxsize=1)
def encoder(path: str, end: int) -> Encoder:
    """One for each Python worker, whatever the number of its tasks."""
    return Encoder(path, end)


def write_files(df: DataFrame, path: str, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", percentile: float = 0.9, segment_ids: int = SEGMENT_IDS) -> None:
    """Writes the ids of all rows to the folder path."""
    if df.schema[id_col].dataType.simpleString() not in ("tinyint", "smallint", "int", "bigint"):
        raise TypeError(f"{id_col} must be an integer")
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("h"), F.spark_partition_id().alias("p"))
    order = [F.col("id").asc_nulls_last(), F.col("h"), F.col("p")]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_all = encoder(tokenizer_path, end_id)
        docs: list[int | None] = []
        ids: list[np.ndarray] = []
        held, before, part = 0, 0, None
        give = lambda: pa.RecordBatch.from_arrays([pa.array([write_segment(docs, ids, before, part, percentile)], type=pa.binary())], names=["segment"])
        for batch in batches:
            own = batch.column(0).to_pylist()
            if part is None and own:
                part = (int(own[0] is None), own[0] or 0, batch.column(2)[0].as_py(), batch.column(3)[0].as_py())
            for i, x in zip(own, encode_all(batch.column(1)), strict=True):
                docs.append(i)
                ids.append(x)
                held += len(x)
                if held >= segment_ids:
                    yield give()
                    before, held, docs, ids = before + held, 0, [], []
        if docs:
            yield give()

    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    segments = dealt.mapInArrow(encode, "segment binary")
    segments.select(F.col("segment").cast("string").alias("segment")).write.option("maxRecordsPerFile", FILE_SEGMENTS).text(path)


def read_documents(spark: SparkSession, path: str, id_col: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """(id_col, start, n_tokens, ids_crc32[, ids array<long>]) of every document in the files of a folder: start is the number of ids
    of all documents before it. The files are read once; what is known of documents is stored."""
    files = spark.read.format("binaryFile").load(path).select("content")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                for s in read_segments(content.as_py()):
                    ids = s.ids()
                    ends = np.cumsum(s.lengths, dtype=np.int64)
                    starts = ends - s.lengths
                    each = [ids[a:e] for a, e in zip(starts.tolist(), ends.tolist(), strict=True)]
                    n = len(each)
                    cols = [
                        pa.array(s.doc_ids, type=pa.int64()), *(pa.array([v] * n, type=t) for v, t in zip(s.part, (pa.int32(), pa.int64(), pa.int64(), pa.int32()), strict=True)), pa.array(starts + s.before), pa.array(s.lengths.astype(np.int64)),
                        pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in each], type=pa.int64()),
                    ]
                    names = ["id", "z", "i", "h", "p", "own_start", "n", "crc"]
                    if with_ids:
                        cols, names = [*cols, pa.array([x.astype(np.int64) for x in each], type=pa.list_(pa.int64()))], [*names, "ids"]
                    yield pa.RecordBatch.from_arrays(cols, names=names)

    docs = stored(files.mapInArrow(read, "id long, z int, i long, h long, p int, own_start long, n long, crc long" + (", ids array<long>" if with_ids else "")), "token-documents")
    part = ["z", "i", "h", "p"]
    sizes = docs.groupBy(*part).agg(F.sum("n").alias("part_ids"))  # a row for each task that has written
    bases = sizes.select(*part, (F.sum("part_ids").over(Window.orderBy(*part)) - F.col("part_ids")).alias("base"))
    out = docs.join(F.broadcast(bases), part)
    return out.select(F.col("id").alias(id_col), (F.col("base") + F.col("own_start")).alias("start"), F.col("n").alias("n_tokens"), F.col("crc").alias("ids_crc32"), *(["ids"] if with_ids else []))
