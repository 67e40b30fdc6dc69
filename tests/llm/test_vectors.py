"""Centroid clustering, token files and whitening against plain numpy, exact round trips, and their defined cases."""

import hashlib
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")

from sluice.llm import centroids, queries, token_files, whitening  # noqa: E402

WORDS = public_tokenizers.path("word_bpe_49k.json")
NAN, INF = float("nan"), float("inf")
#: Names that the operators use inside.
EXTRA = "id v x lead rest cluster distance n sums component data m kind h p segment content base z i own_start crc".split()


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({c: F.lit(1) for c in EXTRA})


def vectors(seed, n, dims, spread=0.3):
    rnd = np.random.default_rng(seed)
    middle = rnd.normal(size=(5, dims))
    return (middle[rnd.integers(0, 5, n)] + spread * rnd.normal(size=(n, dims)) * np.linspace(1, 0.05, dims)).astype(np.float32)


# --- clustering -------------------------------------------------------------------------------------------------------


def plain_clusters(ids, x, k, rounds):
    """Lists of integers and no bounds: (cluster, distance) of each row, and the last centroids."""
    order = sorted(range(len(x)), key=lambda i: (ids[i] is None, hashlib.sha256(f"2:{ids[i]}".encode()).hexdigest(), x[i]))
    c = [list(x[i]) for i in order[:k]]
    for t in range(rounds + 1):
        far = [[sum((a - b) ** 2 for a, b in zip(v, m, strict=True)) for m in c] for v in x]
        own = [d.index(min(d)) for d in far]
        if t < rounds:
            for j in range(len(c)):
                if mine := [v for v, o in zip(x, own, strict=True) if o == j]:
                    c[j] = [sum(z) // len(mine) for z in zip(*mine, strict=True)]
    return [(o, d[o]) for o, d in zip(own, far, strict=True)], c


@pytest.mark.parametrize("n, k, dims", [(120, 7, 6), (5, 8, 3), (60, 60, 4)])
def test_clusters_as_plain_code(spark, n, k, dims):
    x = vectors(n, n, dims)
    x[n // 2 :: 4] = x[0]  # copies
    ids = [i if i % 9 else None for i in range(n)]
    ids[1] = ids[2]
    rows = [*zip(ids, x.tolist(), strict=True), (500, None), (501, [1.0] * (dims - 1) + [None]), (502, [1.0] * (dims - 1) + [NAN]), (503, [1.0] * (dims - 1) + [-INF]), (504, [1.0] * (dims + 1)), (505, [])]
    got = centroids.cluster(frame(spark, rows), k=k, rounds=3, dims=dims).collect()
    whole = [[int(np.floor(float(c) * 256)) for c in v] for v in x]
    want, c = plain_clusters(ids, whole, k, 3)
    inertia = {j: sum(d for o, d in want if o == j) for j in range(k)}
    key = lambda r: str(r)
    assert sorted(((r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, list(r.centroid)) for r in got), key=key) == sorted(((i, o, d, inertia[o], sum(inertia.values()), c[o]) for i, (o, d) in zip(ids, want, strict=True)), key=key)


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**31), st.integers(1, 12), st.sampled_from([0.3, 0.6, 0.9, 1.0]), st.sampled_from([1, 300, 1 << 20]))
def test_bounds_lose_no_centroid(seed, k, held, scale):
    rnd = np.random.default_rng(seed)
    x = rnd.integers(-scale, scale + 1, (40, 9))
    c = np.concatenate([x[:k], x[:k] + rnd.integers(0, 2, (k, 9))])  # ties and near ties
    f = centroids.Frame(x.astype(np.float64), held)
    at, rest = f.place(x.astype(np.float64))
    cluster, distance, computed = centroids.nearest(x, at.astype(np.float32), rest, c, f)
    exact = ((x[:, None] - c[None]) ** 2).sum(2)
    assert (cluster == exact.argmin(1)).all() and (distance == exact.min(1)).all() and computed <= len(x) * (len(c) + 1)


def test_bounds_spare_distances():
    x = np.floor(vectors(3, 2000, 32, 0.1) * 256).astype(np.int64)
    f = centroids.Frame(x.astype(np.float64), 0.9)
    at, rest = f.place(x.astype(np.float64))
    assert centroids.nearest(x, at.astype(np.float32), rest, x[:40], f)[2] < 2000 * 20


def test_clusters_of_nothing(spark):
    out = centroids.cluster(frame(spark, [(1, None)]), k=3, dims=2)
    assert out.count() == 0 and out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"]
    with pytest.raises(Exception, match="or more"):
        centroids.cluster(frame(spark, [(1, [1e30, 1.0])]), k=1, dims=2).collect()


def test_one_hot_id(spark):
    """Rows of one id, more than the sample and the hash threshold can hold."""
    rows = spark.range(9000).select(F.when(F.col("id") % 3 < 2, F.lit(7)).otherwise(F.col("id")).alias("vec_id"), F.array((F.col("id") % 11).cast("float"), (F.col("id") % 5).cast("float")).alias("embedding"))
    out = centroids.cluster(rows, k=4, rounds=2, dims=2)
    assert out.count() == 9000 and out.select("vec_id", "distance").where("vec_id = 7").count() == 6000


def test_registered_clusters_as_sql(spark, sf_dir):
    con = duckdb.connect()
    con.sql(f"create view embeddings as select * from '{sf_dir}/embeddings.parquet'")
    want = con.sql(queries.SQL["op11_centroid_clustering"]).df()
    got = queries.op11_centroid_clustering(spark, sf_dir).toPandas()[list(want.columns)]
    key = lambda df: sorted(map(tuple, df.itertuples(index=False)))
    assert key(got) == key(want)


# --- token files ------------------------------------------------------------------------------------------------------


@settings(max_examples=80, deadline=None)
@given(st.integers(0, 900), st.sampled_from([0, 1, 200, 49_407, 2**32 - 1]), st.sampled_from([0.01, 0.5, 0.9, 1.0]), st.integers(0, 2**31))
def test_blocks_round_trip(n, most, percentile, seed):
    rnd = np.random.default_rng(seed)
    ids = np.where(rnd.random(n) < 0.9, rnd.integers(0, most // 50 + 1, n), rnd.integers(0, most, n, endpoint=True)).astype(np.uint32)
    starts, blocks = token_files.pack_blocks(ids, percentile)
    assert (token_files.unpack_blocks(starts, blocks)[:n] == ids).all() and starts[-1] == len(blocks)
    segment = next(token_files.read_segments(token_files.write_segment([5, None], [ids[: n // 3], ids[n // 3 :]], 77, (0, 5, -1, 2), percentile)))
    a = int(rnd.integers(0, n + 1))
    assert segment.before == 77 and segment.doc_ids == [5, None] and (segment.ids(a, 300) == ids[a : a + 300]).all()


def test_a_range_reads_only_its_blocks():
    ids = np.arange(3000, dtype=np.uint32)
    s = next(token_files.read_segments(token_files.write_segment([1], [ids], 0, (0, 1, 0, 0))))
    s.blocks = b"\0" * int(s.starts[4]) + s.blocks[s.starts[4] : s.starts[6]]  # nothing else is there
    assert (s.ids(1030, 400) == ids[1030:1430]).all()


def test_patches_hold_what_is_wide():
    narrow = np.full(4096, 3, dtype=np.uint32)
    wide = narrow.copy()
    wide[::100] = 40_000
    assert len(token_files.pack_blocks(narrow)[1]) < 200 and len(token_files.pack_blocks(wide)[1]) < 400


def test_damage_is_seen():
    data = bytearray(token_files.write_segment([1], [np.arange(50)], 0, (0, 1, 0, 0)))
    data[-3] ^= 1
    with pytest.raises(ValueError, match="damaged"):
        list(token_files.read_segments(bytes(data)))


ODD = [
    (1, None), (2, ""), (3, "a"), (3, "a"), (3, "b"), (None, "nobody"), (-4, " \n\t "), (6, "é ü \x0b b\x1cc\x85d"), (7, "x" * 70_000), (8, "word " * 40_000), (9, "İstanbul ΣΑΣ naïve don't y'all've 'tis"),
    (10, "a <|endoftext|> b"), (11, "l'homme ’s 12,5 ×÷ ŒUF straße é"), (12, "\n\nA\r\nb  c\n"), (13, "日本語 текст 😀 mixed"), (2**40, "last"),
]


def whole(texts):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(WORDS)
    return [[*tok.encode(t or "", add_special_tokens=False).ids, 2] for t in texts]


def test_pieces_give_the_librarys_ids(spark, sf_dir):
    texts = [t for _, t in ODD] + [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]
    encode = token_files.Encoder(WORDS, 2)
    assert encode.divided
    encode.pieces = token_files.Remembered(50)  # forgets nearly all between batches
    assert [x.tolist() for x in encode(pa.array(texts))] == whole(texts)
    encode.divided = False
    assert [x.tolist() for x in encode(pa.array(texts[:30]))] == whole(texts[:30])


@pytest.mark.parametrize("segment_ids", [1, 500, 1 << 18])
def test_files_round_trip(spark, tmp_path, segment_ids):
    df = spark.createDataFrame(ODD * 2, "doc_id long, text string").withColumns({c: F.lit(1) for c in EXTRA}).repartition(5)
    token_files.write_files(df, f"{tmp_path}/files", WORDS, 2, segment_ids=segment_ids)
    got = token_files.read_documents(spark, f"{tmp_path}/files", with_ids=True).orderBy("start").collect()
    want = {}
    for (i, _), ids in zip(ODD * 2, whole([t for _, t in ODD * 2]), strict=True):
        want.setdefault(i, []).append(ids)
    start, order = 0, []
    for r in got:
        ids = list(r.ids)
        want[r.doc_id].remove(ids)
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()))
        start += len(ids)
        order.append((r.doc_id is None, r.doc_id or 0))
    assert not any(want.values()) and order == sorted(order)


def test_files_of_nothing(spark, tmp_path):
    token_files.write_files(spark.createDataFrame([], "doc_id long, text string"), f"{tmp_path}/none", WORDS, 2)
    assert token_files.read_documents(spark, f"{tmp_path}/none").count() == 0
    with pytest.raises(TypeError):
        token_files.write_files(spark.createDataFrame([("a", "b")], "doc_id string, text string"), f"{tmp_path}/bad", WORDS, 2)


def test_registered_files(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    ids = whole([r.text for r in rows])
    starts = np.cumsum([0, *map(len, ids)]).tolist()
    want = [(r.doc_id, s, len(x), zlib.crc32(np.array(x, dtype="<u4").tobytes())) for r, s, x in zip(rows, starts, ids, strict=False)]
    assert sorted(tuple(r) for r in queries.op12_token_files(spark, sf_dir).collect()) == sorted(want)


# --- whitening --------------------------------------------------------------------------------------------------------


def whitened_plainly(x, p):
    """(whitened, explained) by the covariance matrix itself."""
    c = x - x.mean(axis=0)
    v = c.T @ c / len(x)
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:p], u[:, ::-1][:, :p]
    return c @ u / np.sqrt(e), e / np.trace(v)


def held_against(out, ids, x, p):
    want, share = whitened_plainly(x.astype(float), p)
    got = out.pivot(index="vec_id", columns="component", values="whitened").loc[ids].to_numpy()
    assert np.abs(got * np.sign((got * want).sum(axis=0)) - want).max() < 1e-8
    assert np.abs(out.groupby("component").explained.first().to_numpy() / share - 1).max() < 1e-9
    s, n = [int(v) for v in x.sum(axis=0)], len(x)
    deviation = {i: sum((n * int(a) - b) ** 2 for a, b in zip(v, s, strict=True)) for i, v in zip(ids, x, strict=True)}
    assert out[out.component == 1].set_index("vec_id").deviation.to_dict() == deviation and (out.n == n).all()
    assert out.identity_error.nunique() == 1 and out.identity_error.iloc[0] < 1e-9


def test_whitening_as_plain_code(spark):
    x = vectors(5, 300, 12)
    rows = [*enumerate(x.tolist()), (900, None), (901, [None] * 12), (902, [NAN] * 12), (903, [INF] * 12), (904, [1.0] * 3), (905, [])]
    out = whitening.whitened(frame(spark, rows).repartition(3), components=7).toPandas()
    assert len(out) == 300 * 7 and sorted(out.columns) == sorted("vec_id component n deviation whitened explained identity_error".split())
    held_against(out, list(range(300)), np.floor(x.astype(float) * 64).astype(np.int64) + 1_000_000, 7)


def test_registered_whitening(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()
    x = np.floor(np.array([r.embedding for r in rows], dtype=np.float64) * 64).astype(np.int64) + 1_000_000
    held_against(queries.op13_embedding_whitening(spark, sf_dir).toPandas(), [r.vec_id for r in rows], x, 32)


@pytest.mark.parametrize("kind", ["spread", "equal eigenvalues", "one direction", "few rows", "zeros"])
def test_bidiagonalisation(kind):
    rnd = np.random.default_rng(8)
    x = {
        "spread": lambda: rnd.normal(size=(200, 20)) * np.logspace(0, -5, 20), "equal eigenvalues": lambda: np.repeat(np.vstack([np.eye(9), -np.eye(9)]), 3, axis=0), "one direction": lambda: np.outer(rnd.normal(size=50), rnd.normal(size=6)),
        "few rows": lambda: rnd.normal(size=(4, 10)), "zeros": lambda: np.zeros((5, 4)),
    }[kind]()
    d = x.shape[1]
    squares, axes, steps = whitening.bidiagonalise(lambda a: (float((x @ a) @ (x @ a)), x.T @ (x @ a)), d, d)
    assert np.allclose(axes.T @ axes, np.eye(d), atol=1e-12) and steps <= d
    assert np.allclose(squares, np.linalg.eigvalsh(x.T @ x)[::-1], atol=1e-12 * max(1, np.abs(x.T @ x).max()))
    assert np.abs(x.T @ (x @ axes) - axes * squares).max() <= 1e-12 * max(1, np.abs(x.T @ x).max())


def test_few_steps_where_few_components_matter():
    rnd = np.random.default_rng(9)
    x = rnd.normal(size=(400, 300)) * np.r_[100.0, 50, 20, np.full(297, 1e-6)]
    assert whitening.bidiagonalise(lambda a: (float((x @ a) @ (x @ a)), x.T @ (x @ a)), 300, 3)[2] < 40


def test_directions_without_deviation(spark):
    rows = [(i, [float(i), 2.0 * i, 5.0]) for i in range(8)] * 2
    out = whitening.whitened(frame(spark, rows), components=3).toPandas()
    assert len(out) == 48 and out[out.component > 1].whitened.isna().all() and (out[out.component > 1].explained == 0).all()
    assert out[out.component == 1].explained.round(12).eq(1).all() and out.identity_error.max() < 1e-9
    one = whitening.whitened(frame(spark, [(1, [1.0, 2.0])])).toPandas()
    assert len(one) == 2 and one.whitened.isna().all() and (one.deviation == 0).all()
    assert whitening.whitened(frame(spark, [(1, None)])).count() == 0
