"""Packing: token sequences of bounded length, filled by vector bin packing.

Documents become token ids and are cut at every max_tokens ids. Full pieces are sequences of their own. What remains of each
document is dealt by a hash of the row's place in the scan to groups of about group_rows rows, and each group is packed in one task: pieces and
bins are vectors of tokens, segments and loss-bearing tokens; a bin is filled with the piece whose demand has the largest
dot product with what the bin has left, both measured in shares of the limits. Where no piece fits any more, one is cut, so
that bins end full; only the last bin of a group is padded.

Memory is bounded by the group, whatever the input: a group holds group_rows pieces of fewer than max_tokens ids. Only those
pieces are shuffled; a full piece travels as a few numbers.

Defined cases: null and empty texts are documents of one id, the end; repeated rows are packed each by itself; a null id
stays null; an empty table gives no pieces; other columns are not read. A text is encoded whole, so memory also holds the
longest text's ids.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Texts of so many characters or more are encoded straight into an array, without a list of their ids.
_LONG_TEXT = 1 << 20
#: Fixed value: the pre-tokenisation that byte-level tokenizers files name by "use_regex".
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_of() -> dict[str, int]:
    """The byte for each character of a byte-level vocabulary: printable ones stand for themselves, the others follow 255."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def ranked(path: str) -> object | None:
    """The tokenizers file as a tiktoken encoding, which gives the same ids in less time; None if the file is of another kind.

    It is of this kind if nothing but byte-level pre-tokenisation and plain merges happens and ids ascend as merges do."""
    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, pre = spec["model"], spec["pre_tokenizer"] or {}
    if spec["normalizer"] or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True):
        return None
    if model.get("type") != "BPE" or any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")):
        return None
    vocab, byte_of = model["vocab"], _byte_of()
    merged = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    if merged != sorted(merged) or len(merged) + 256 != len(vocab) or any(c not in byte_of for x in vocab for c in x):
        return None
    return tiktoken.Encoding("file", pat_str=_PATTERN, mergeable_ranks={bytes(byte_of[c] for c in x): k for x, k in vocab.items()}, special_tokens={})


class Encoder:
    """Token ids of texts by a tokenizers file, with the end id after each text, as unsigned little-endian numbers.

    Texts with one of the file's added tokens, and all texts where ranked() gives None, are encoded by tokenizers itself."""

    def __init__(self, path: str, end: int) -> None:
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.wide = self.tok.get_vocab_size() > 1 << 16 or end >= 1 << 16
        self.kind = np.dtype("<u4" if self.wide else "<u2")
        self.end = end
        self.quick = ranked(path)
        self.added = [t.content for t in self.tok.get_added_tokens_decoder().values()]

    def _quickly(self, text: str) -> np.ndarray | list[int] | None:
        """None if the text is not for the quick encoding: it gives up on white space in runs of many thousands."""
        if self.quick is None or any(x in text for x in self.added):
            return None
        try:
            return self.quick.encode_ordinary(text) if len(text) < _LONG_TEXT else self.quick.encode_to_numpy(text, disallowed_special=())
        except ValueError:
            return None

    def __call__(self, text: str | None) -> np.ndarray:
        ids = self._quickly(text or "")
        if ids is None:
            ids = self.tok.encode(text or "", add_special_tokens=False).ids
        out = np.empty(len(ids) + 1, dtype=self.kind)
        out[:-1], out[-1] = ids, self.end
        return out


@lru_cache(maxsize=1)
def encoder(path: str, end: int) -> Encoder:
    """One for each Python worker, whatever the number of its tasks."""
    return Encoder(path, end)


@dataclass(frozen=True)
class Limits:
    tokens: int = 2048
    segments: int = 128
    loss_tokens: int = 2048
    #: Pieces are not cut into parts shorter than this, but for a document's own end.
    least_cut: int = 16


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def fill(size: np.ndarray, loss_from: np.ndarray, limits: Limits) -> list[list[tuple[int, int, int]]]:
    """Bins of (piece, from, to), for pieces of size tokens of which those from loss_from on bear loss."""
    n = len(size)
    start, left = np.zeros(n, dtype=np.int64), size.astype(np.int64).copy()
    bins: list[list[tuple[int, int, int]]] = []
    cap = np.array([limits.tokens, limits.segments, limits.loss_tokens], dtype=float)
    open_, rest = None, cap
    while (todo := np.flatnonzero(left > 0)).size:
        if open_ is None:
            open_, rest = [], cap.copy()
            bins.append(open_)
        loss = np.maximum(0, size[todo] - np.maximum(loss_from[todo], start[todo]))
        demand = np.stack([left[todo], np.ones(todo.size), loss], axis=1)
        fits = (demand <= rest).all(axis=1)
        if fits.any():
            dot = np.where(fits, (demand / cap) @ (rest / cap), -1.0)
            k = todo[int(dot.argmax())]
            take = int(left[k])
        else:  # cut the largest piece so that it fills the bin, if tokens are what the bin lacks
            room = int(rest[0])
            k = todo[int(left[todo].argmax())]
            take = min(room, int(left[k]) - 1)
            bears = max(0, int(start[k] + take - max(loss_from[k], start[k])))
            if rest[1] < 1 or take < limits.least_cut or bears > rest[2]:
                open_ = None
                continue
        lost = max(0, int(start[k] + take - max(loss_from[k], start[k])))
        open_.append((int(k), int(start[k]), int(start[k] + take)))
        rest -= (take, 1, lost)
        start[k] += take
        left[k] -= take
        if rest[0] < 1 or rest[1] < 1:
            open_ = None
    return bins


def pack(
    df: DataFrame,
    tokenizer_path: str,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    prompt_tokens_col: str | None = None,
    prompt_text_col: str | None = None,
    limits: Limits = Limits(),  # noqa: B008
    group_rows: int = 2000,
    with_ids: bool = False,
) -> DataFrame:
    """A row per piece: (id_col, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids array<int>]).

    prompt_tokens_col: tokens at a document's start that bear no loss; prompt_text_col: a text before the document's, whose tokens
    are its first and bear no loss; none if not given. with_ids: pieces carry their ids, full ones too. sequence_id: the group's number times 2**32 plus the sequence's number in the group."""
    assert limits.loss_tokens > 0 and limits.segments > 0
    id_type = df.schema[id_col].dataType.simpleString()
    prompt = F.col(prompt_tokens_col).cast("long") if prompt_tokens_col else F.lit(0).cast("long")
    rows = df.select(F.col(id_col).alias("id"), F.coalesce(prompt, F.lit(0)).alias("prompt"), (F.col(prompt_text_col) if prompt_text_col else F.lit(None).cast("string")).alias("lead"), F.col(text_col).alias("text"))
    n_groups = max(1, -(-df.count() // group_rows))
    full = min(limits.tokens, limits.loss_tokens)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encode, row = encoder(tokenizer_path, end_id), TaskContext.get().partitionId() << 33
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                b = batch.slice(at, 128)
                out: dict[str, list] = {k: [] for k in ("id", "row", "start", "length", "crc", "total", "loss_from", "ids")}
                for i, prompt, lead, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), b.column(3), strict=True):
                    ids, row = encode(text.as_py()), row + 1
                    if lead := lead.as_py():
                        before = encode(lead)[:-1]
                        ids, prompt = np.r_[before, ids], len(before)
                    for s in range(0, len(ids), full):
                        part = ids[s : s + full]
                        whole = len(part) == limits.tokens
                        crc = _crc(part)
                        for k, v in zip(out, (i, row, s, len(part), crc, len(ids), max(0, prompt - s), None if whole and not with_ids else part.astype("<u4" if encode.wide else "<u2").tobytes()), strict=True):
                            out[k].append(v)
                yield pa.RecordBatch.from_arrays([pa.array(out["id"], type=b.column(0).type), *(pa.array(out[k], type=pa.int64()) for k in ("row", "start", "length", "crc", "total", "loss_from")), pa.array(out["ids"], type=pa.binary())], names=list(out))

    def bins(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["total", "start", "crc", "id", "row"], kind="stable").reset_index(drop=True)
        base = int(pdf["group"].iloc[0]) << 32
        out: list[tuple] = []
        seq = 0
        whole = (pdf["length"] == limits.tokens).to_numpy()
        width = 2 if pdf["ids"].isna().all() else max(2, max(len(x) // n for x, n in zip(pdf["ids"], pdf["length"], strict=True) if x is not None))
        get = lambda x: np.frombuffer(x, dtype="<u2" if width == 2 else "<u4")
        for r in pdf[whole].itertuples(index=False):
            out.append((r.id, r.start, r.length, r.crc, r.total, base + seq, 0, get(r.ids).astype(np.int32) if with_ids else None))
            seq += 1
        rest = pdf[~whole].reset_index(drop=True)
        ids = [get(x) for x in rest["ids"]]
        for b in fill(rest["length"].to_numpy(), rest["loss_from"].to_numpy(), limits):
            offset = 0
            for k, s, e in b:
                part = ids[k][s:e]
                out.append((rest["id"][k], int(rest["start"][k]) + s, e - s, _crc(part), rest["total"][k], base + seq, offset, part.astype(np.int32) if with_ids else None))
                offset += e - s
            seq += 1
        res = pd.DataFrame(out, columns=[id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"])
        return res if with_ids else res.drop(columns="ids")

    pieces = rows.mapInArrow(cut, f"id {id_type}, row long, start long, length long, crc long, total long, loss_from long, ids binary")
    # By the row's place in its scan: no id and no text, however often it occurs, makes a large group.
    dealt = pieces.withColumn("group", F.pmod(F.xxhash64("row", "start"), F.lit(n_groups)))
    schema = f"`{id_col}` {id_type}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + (", ids array<int>" if with_ids else "")
    return dealt.groupBy("group").applyInPandas(bins, schema)
