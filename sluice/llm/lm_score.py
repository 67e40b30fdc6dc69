"""LM scoring: a unigram model over subwords, summed over all segmentations of a text.

A text is its words (A-Z lower-cased), each written as a space and its bytes, then an end. A segmentation is a sequence of
pieces of an existing vocabulary, single bytes included, so every text has one; a piece may begin with the space of a word
but doesn't reach into the next. The probability of a word is the sum over its segmentations, by forward recursion in log
space; that of a text is the product over its words and the end, as no piece crosses words.

The vocabulary's own scores weight the pieces; by default one round of expectation-maximisation (forward-backward) adjusts
them to the training words that were seen once, which are what words not seen at all look like. A word's lattice also has an
arc for the whole word, weighted by the word's share of the training tokens; the mixing weights are chosen on leave-one-out
counts, so that a word seen once counts as unseen. Where training rows have classes, such as languages, each has shares of
its own and a text's probability is the sum over classes, weighted by their shares of the training rows; a scored text's own
class is not read. The README has the held-out figures with and without each of these.

Shape: each distinct word is handled once, whatever its count. Word counts, expected piece counts and the words of each
block are shuffled; a block of documents gets back its distinct words with counts and log probabilities. What goes to the
driver is bounded by the vocabulary and the number of classes.

Defined cases: null and empty texts are the end alone; repeated rows count as often as they occur; an empty training set
leaves the vocabulary's own weights; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import discard, stored

#: Stands for the end among words; it holds white space, so no word equals it.
END = "\n"
_B = np.uint64(0x100000001B3)
_LOG10 = float(np.log(10.0))
#: Words that the lattice takes at a time, and the length from which a word is handled by itself.
_BATCH, _LONG = 20_000, 64


def vocabulary(model_path: str) -> tuple[list[bytes], np.ndarray]:
    """Pieces as bytes, "▁" as a space, and weights that sum to 1. Single bytes come from the model's byte pieces.

    Scores of a vocabulary with probabilities are logarithms; where scores are ranks, as in byte-pair vocabularies, the
    weight is one over the rank, which is how frequencies fall off."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
    pieces: dict[bytes, float] = {}
    least = min(sp.get_score(i) for i in range(sp.get_piece_size()))
    for i in range(sp.get_piece_size()):
        if sp.is_control(i) or sp.is_unknown(i):
            continue
        name, score = sp.id_to_piece(i), sp.get_score(i)
        raw = bytes([int(name[3:-1], 16)]) if sp.is_byte(i) else name.replace("▁", " ").encode()
        weight = (1e-7 if least < -1000 else float(np.exp(least))) if sp.is_byte(i) else float(1 / (1 - score)) if least < -1000 else float(np.exp(score))
        if b" " not in raw[1:] and not (len(raw) > 1 and raw.isspace()):
            pieces[raw] = max(pieces.get(raw, 0.0), weight)
    for k in range(256):
        pieces.setdefault(bytes([k]), 1e-7)
    names = sorted(pieces)
    w = np.array([pieces[x] for x in names])
    return names, w / w.sum()


class Lattice:
    """Vocabulary pieces found in many words at once, by rolling hashes and an open table."""

    def __init__(self, names: list[bytes], bits: int = 20) -> None:
        self.longest = max(map(len, names))
        self.lengths = sorted({len(x) for x in names})
        self.bits = np.uint64(64 - bits)
        self.tables: list[tuple[np.uint64, np.ndarray, np.ndarray]] = []
        keys = np.array([self._hash_one(x) for x in names], dtype=np.uint64)
        assert np.unique(keys).size == keys.size
        left, mult = np.arange(len(names)), 0x9E3779B97F4A7C15
        while left.size:  # what finds its slot taken goes to the next table
            at = (keys[left] * np.uint64(mult)) >> self.bits
            _, firsts = np.unique(at, return_index=True)
            key, value = np.zeros(1 << bits, dtype=np.uint64), np.full(1 << bits, -1, dtype=np.int32)
            key[at[firsts]], value[at[firsts]] = keys[left[firsts]], left[firsts]
            self.tables.append((np.uint64(mult), key, value))
            left, mult = np.delete(left, firsts), (mult * 6364136223846793005 + 1442695040888963407) % (1 << 64) | 1

    @staticmethod
    def _hash_one(x: bytes) -> int:
        h = 0
        for c in x:
            h = (h * int(_B) + c + 1) % (1 << 64)
        return h ^ (len(x) << 56)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Piece numbers of hashes, -1 for none."""
        out = np.full(h.shape, -1, dtype=np.int32)
        for mult, key, value in self.tables:
            at = (h * mult) >> self.bits
            hit = (key[at] == h) & (value[at] >= 0)
            out[hit] = value[at][hit]
        return out

    def arcs(self, words: list[bytes]) -> tuple[int, list[tuple[int, int, np.ndarray, np.ndarray]]]:
        """For words of one length: (length, arcs), each arc as (from, to, rows, pieces)."""
        n, t = len(words), len(words[0])
        m = np.frombuffer(b"".join(words), dtype=np.uint8).reshape(n, t).astype(np.uint64) + np.uint64(1)
        out = []
        for i in range(t):
            h = np.zeros(n, dtype=np.uint64)
            for k in range(1, min(self.longest, t - i) + 1):
                h = h * _B + m[:, i + k - 1]
                if k in self.lengths:
                    p = self.find(h ^ np.uint64(k << 56))
                    rows = np.flatnonzero(p >= 0)
                    if rows.size:
                        out.append((i, i + k, rows, p[rows]))
        return t, out

    def forward(self, words: list[bytes], logp: np.ndarray) -> tuple[np.ndarray, list]:
        """For words of one length, the log probability of all segmentations up to each position by each row of logp, as an
        array (rows of logp, positions, words); and the arcs."""
        t, arcs = self.arcs(words)
        a = np.full((len(logp), t + 1, len(words)), -np.inf)
        a[:, 0] = 0.0
        for i, j, rows, p in arcs:  # ascending by start
            a[:, j, rows] = np.logaddexp(a[:, j, rows], a[:, i, rows] + logp[:, p])
        return a, arcs

    def expected(self, words: list[bytes], counts: np.ndarray, logp: np.ndarray, into: np.ndarray) -> None:
        """Adds the expected number of uses of each piece under one row of weights."""
        a, arcs = self.forward(words, logp[None])
        a = a[0]
        b = np.full_like(a, -np.inf)
        b[-1] = 0.0
        for i, j, rows, p in reversed(arcs):
            b[i, rows] = np.logaddexp(b[i, rows], logp[p] + b[j, rows])
        for i, j, rows, p in arcs:
            share = np.exp(a[i, rows] + logp[p] + b[j, rows] - a[-1, rows])
            into += np.bincount(p, weights=share * counts[rows], minlength=into.size)


def by_length(words: list[str]) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    """(places, words as a space and bytes) of equal length, some thousands at a time."""
    raw = [b" " + w.encode() for w in words]
    sizes = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw))
    order = np.argsort(sizes, kind="stable")
    cuts = np.flatnonzero(np.diff(sizes[order])) + 1
    for part in np.split(order, cuts):
        step = _BATCH if part.size == 0 or sizes[part[0]] < _LONG else max(1, _BATCH * _LONG // int(sizes[part[0]]))
        for at in range(0, part.size, step):
            places = part[at : at + step]
            yield places, [raw[k] for k in places]


def _gathered(batches: Iterator[pa.RecordBatch], rows: int = 200_000) -> Iterator[pa.Table]:
    """Batches put together to about that many rows: words are handled by length, and long arrays are what numpy is quick with."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        held.append(b)
        if sum(x.num_rows for x in held) >= rows:
            yield pa.Table.from_batches(held)
            held = []
    if held:
        yield pa.Table.from_batches(held)


@lru_cache(maxsize=2)
def _lattice(path: str) -> tuple[Lattice, int]:
    names, _ = vocabulary(path)
    return Lattice(names), len(names)


def tokens(text: str | None) -> list[bytes]:
    """A-Z lower-cased words, by ASCII white space only, and the end."""
    return [*(text or "").encode().lower().split(), END.encode()]


def classes(df: DataFrame, trains: Column, class_col: str | None) -> list[tuple[object, int]]:
    """(value, training rows) of each class; null is one like any other. Their number is taken to be small, as of languages."""
    if class_col is None:
        return [(None, df.where(trains).count())]
    found = [(r[0], r[1]) for r in df.where(trains).groupBy(class_col).count().orderBy(F.desc("count"), class_col).collect()]
    return found or [(None, 0)]


def token_counts(df: DataFrame, text_col: str, trains: Column, class_of: Column, n_classes: int) -> DataFrame:
    """(word, c, c0, c1, ...): each distinct token of all rows, and its count in training rows, of all and of each class."""
    names = [f"c{k}" for k in range(n_classes)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 10_000):
                b = batch.slice(at, 10_000)
                every, train = set(), [Counter() for _ in names]
                for text, k in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                    w = tokens(text)
                    if k < 0:
                        every.update(w)
                    else:
                        train[k].update(w)
                words = list(every.union(*train))
                yield pa.RecordBatch.from_arrays([pa.array([w.decode() for w in words], type=pa.string()), *(pa.array([c[w] for w in words], type=pa.int64()) for c in train)], names=["word", *names])

    found = df.select(F.col(text_col).alias("t"), F.when(trains, class_of).otherwise(-1).alias("k"))
    found = found.mapInArrow(run, "word string, " + ", ".join(f"{x} long" for x in names)).groupBy("word").agg(*(F.sum(x).alias(x) for x in names))
    return found.select("word", sum((F.col(x) for x in names), F.lit(0)).alias("c"), *names)


def fit_pieces(counts: DataFrame, model_path: str, rounds: int = 1, strength: float = 0.05) -> np.ndarray:
    """Natural logarithms of the pieces' weights: the vocabulary's own, then EM over the words of counts (word, c) with c = 1. The
    vocabulary's weights stay in as `strength` uses for each use found, and one for each piece."""
    names, prior = vocabulary(model_path)
    logp = np.log(prior)
    once = counts.where((F.col("c") == 1) & (F.col("word") != END)).select("word")
    for _ in range(rounds):
        given = logp

        def run(batches: Iterator[pa.RecordBatch], given: np.ndarray = given) -> Iterator[pa.RecordBatch]:
            lattice, n = _lattice(model_path)
            into = np.zeros(n)
            for b in _gathered(batches):
                for places, group in by_length(b.column(0).to_pylist()):
                    lattice.expected(group, np.ones(len(places)), given, into)
            at = np.flatnonzero(into)
            yield pa.RecordBatch.from_arrays([pa.array(at, type=pa.int64()), pa.array(into[at])], names=["piece", "uses"])

        # One row per piece: the vocabulary bounds what is collected.
        uses = np.zeros(len(names))
        for r in once.mapInArrow(run, "piece long, uses double").groupBy("piece").agg(F.sum("uses").alias("uses")).collect():
            uses[r["piece"]] = r["uses"]
        uses += prior * (strength * uses.sum() + len(prior))
        logp = np.log(uses / uses.sum())
    return logp


#: Candidates for the weights of the whole-word arcs: by the class's counts, by all counts.
ARCS = ((0.0, 0.0), (0.4, 0.3), (0.6, 0.3), (0.7, 0.2), (0.75, 0.2), (0.8, 0.1), (0.85, 0.1), (0.9, 0.05))


def score(
    df: DataFrame,
    model_path: str,
    trains: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    class_col: str | None = None,
    rounds: int = 1,
    block_bytes: int = 16_000_000,
) -> DataFrame:
    """(id_col, n_tokens, n_known, train_tokens long, base_score, score double): log10 probabilities of whole texts, base_score
    by add-one word counts, score by the lattice. trains says which rows are learned from; class_col, if given, names the
    classes of training rows (a language, say); of scored rows it is not read."""
    id_type = df.schema[id_col].dataType.simpleString()
    size = df.agg(F.sum(F.octet_length(text_col)).alias("n")).first()["n"] or 0
    n_blocks = max(1, -(-size // block_bytes))
    found = classes(df, trains, class_col)
    k_all = len(found)
    class_of = F.lit(0)
    for k, (value, _) in enumerate(found[1:], 1):
        class_of = F.when(F.col(class_col).eqNullSafe(F.lit(value)), k).otherwise(class_of)
    counts = stored(token_counts(df, text_col, trains, class_of, k_all), "words")
    names = [f"c{k}" for k in range(k_all)]
    n, v, *of = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count_if(F.col("c") > 0), *(F.coalesce(F.sum(x), F.lit(0)) for x in names)).first()
    logp = fit_pieces(counts, model_path, rounds)
    rows_all = sum(m for _, m in found)
    log_end = float(np.log((rows_all + 1.0) / (n + 2.0)))
    prior = np.log((np.array([m for _, m in found], dtype=float) + 0.5) / (rows_all + 0.5 * k_all))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice, _ = _lattice(model_path)
        for b in _gathered(batches):
            words = b.column(0).to_pylist()
            out = np.full(len(words), log_end)
            real = np.array([k for k, w in enumerate(words) if w != END], dtype=np.int64)
            for places, group in by_length([words[k] for k in real]):
                a, _ = lattice.forward(group, logp[None])
                out[real[places]] = a[0, -1] + np.log1p(-np.exp(log_end))
            more = pa.table([*b.columns, pa.array(out.astype(np.float32))], names=["word", "c", *names, "l"])
            yield from more.to_batches(max_chunksize=10_000)

    cols = ", ".join([f"{x} long" for x in ("c", *names)] + ["l float"])
    words = stored(counts.mapInArrow(weigh, f"word string, {cols}"), "word-scores")
    discard(counts)

    def mixed(arcs: tuple[float, float], k: int, less: int) -> Column:
        """ln of a word's probability in class k, with `less` of its occurrences left out."""
        share = lambda x, total: F.greatest(F.col(x) - less, F.lit(0)) / F.lit(float(max(1, total - less)))
        whole = F.lit(arcs[0]) * share(f"c{k}", of[k]) + F.lit(arcs[1]) * share("c", n)
        rest = F.col("l") + F.lit(float(np.log1p(-sum(arcs))))
        return F.when(whole > 0, F.greatest(F.log(whole), rest) + F.log1p(F.exp(-F.abs(F.log(whole) - rest)))).otherwise(rest)

    # Weights of the whole-word arcs: what fits leave-one-out counts best, in one pass with a column for each candidate.
    fit = words.where("c > 0").agg(*(sum((F.sum(F.when(F.col(f"c{k}") > 0, F.col(f"c{k}") * mixed(a, k, 1)).otherwise(0.0)) for k in range(k_all)), F.lit(0.0)).alias(str(i)) for i, a in enumerate(ARCS))).first()
    arcs = ARCS[max(range(len(ARCS)), key=lambda i: (fit[i] if fit[i] is not None else float("-inf"), -i))]
    scored = words.select("word", "c", *(mixed(arcs, k, 0).cast("float").alias(f"p{k}") for k in range(k_all)))

    rows = df.select(F.pmod(F.xxhash64(id_col, text_col), F.lit(n_blocks)).cast("int").alias("block"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    need = rows.groupBy("block").applyInArrow(_distinct, "block int, word string")
    got = need.join(scored, "word")

    def finish(docs: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        place = dict(zip(map(str.encode, found["word"]), range(len(found)), strict=True))
        c, lp = found["c"].to_numpy(), found[[f"p{k}" for k in range(k_all)]].to_numpy(dtype=float)
        base = np.log10((c + 1.0) / (n + 1.0 * (v + 1)))
        out = []
        for text in docs["text"]:
            w = np.fromiter(map(place.__getitem__, tokens(text)), dtype=np.int64)
            each = prior + lp[w].sum(axis=0)
            out.append((len(w), int((c[w] > 0).sum()), n, float(base[w].sum()), float(np.logaddexp.reduce(each)) / _LOG10))
        res = pd.DataFrame(out, columns=["n_tokens", "n_known", "train_tokens", "base_score", "score"])
        res.insert(0, id_col, docs["id"].to_numpy())
        return res

    schema = f"`{id_col}` {id_type}, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return rows.groupBy("block").cogroup(got.groupBy("block")).applyInPandas(finish, schema)


def _distinct(t: pa.Table) -> pa.Table:
    """The distinct tokens of one block."""
    found = {END.encode()}
    for x in t.column("text").to_pylist():
        found.update(tokens(x))
    block = t.column("block")[0].as_py()
    return pa.table({"block": pa.array(np.full(len(found), block, dtype=np.int32)), "word": pa.array([x.decode() for x in found], type=pa.string())})
