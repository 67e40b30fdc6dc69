import random

from sluice.llm import simhash_dedup as S


def test_copies_are_found_by_fingerprints(spark, monkeypatch):
    """With MinHash keys that nothing shares, copies within three bits still go."""
    rnd = random.Random(4)
    rows, want = [], set()
    for k in range(40):
        w = [f"w{rnd.randrange(10**7)}" for _ in range(600)]
        v = [*w[:-1], "other"]
        rows += [(2 * k, " ".join(w)), (2 * k + 1, " ".join(v))]
        far = S.set_fingerprint(S.shingles(rows[-2][1])) ^ S.set_fingerprint(S.shingles(rows[-1][1]))
        want |= {2 * k} | ({2 * k + 1} if bin(far % (1 << 64)).count("1") > 3 else set())
    assert 40 <= len(want) <= 45
    real = S.bucket_groups

    def alone(keyed, verify, name, *args, **kw):
        if name == "copies":
            keyed = keyed.selectExpr("id", "xxhash64(id, key) as key", "size")
        return real(keyed, verify, name, *args, **kw)

    monkeypatch.setattr(S, "bucket_groups", alone)
    assert {r["doc_id"] for r in S.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()} == want


def test_linked_fingerprints_are_held_against_the_similarity(spark, monkeypatch):
    """Fingerprints that agree although the texts don't make candidates, not copies."""
    monkeypatch.setattr(S, "print_pairs", lambda least, bits: _all_pairs(least))
    rows = [(k, " ".join(f"w{k}x{j}" for j in range(50))) for k in range(6)]
    assert S.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).count() == 6


def _all_pairs(least):
    return S.stored(least.selectExpr("id as a").join(least.selectExpr("id as b"), how="cross").where("a < b"), "pairs")
