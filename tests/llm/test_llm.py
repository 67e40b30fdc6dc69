"""The text operators against brute force, round trips and held-out accuracy, and their defined cases."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")

from sluice.llm import chat_format, decontaminate, fm_index, graph, line_dedup, lm_score, packing, quality_rules, queries, rule_classifier, simhash_dedup, substring_dedup, toxicity  # noqa: E402

BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string"
#: Nulls, empties, ties, repeated rows, odd white space, very long texts.
ODD = [(1, None), (2, ""), (3, "a"), (3, "a"), (4, " \n\t "), (None, "x y z"), (5, "w " * 30_000), (6, "é ü \x0b b"), (7, "one " * 15), (8, "Same line here\nSame line here")]


#: Names that operators use inside.
CLASHING = "_w _l _h _p _s _q _own _text _n_words _n_lines _k1 _k2 removed _removed_ _row row _id h1 size norm own p_good _n_hit _items _spans has_text _has_text label t g".split()


def docs(spark, rows=ODD):
    """With columns whose names clash with what operators use inside."""
    return spark.createDataFrame(rows, SCHEMA).withColumns({"word": F.lit(1), "key": F.lit("k"), "component": F.lit(2), "n": F.lit(3), "id": F.lit(4), "block": F.lit(5)} | {c: F.lit(6) for c in CLASHING})


def random_docs(seed, n=60, words=40):
    rnd = random.Random(seed)
    vocab = ["w%d" % k for k in range(300)]
    base = [[rnd.choice(vocab) for _ in range(rnd.randint(0, words * 2))] for _ in range(n)]
    for k in range(0, n, 3):  # copies, near-copies and shared passages
        other = base[rnd.randrange(n)]
        base[k] = (list(other), [*other[:-1], "changed"], base[k][:10] + other[: rnd.randint(0, 30)] + base[k][10:])[k % 9 // 3]
    return [(i * 7 % 101, " ".join(w) if i % 5 else "\n".join([" ".join(w[:12]), " ".join(w[12:])])) for i, w in enumerate(base)]


def find(links, nodes):
    up = {x: x for x in nodes}

    def root(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {x: root(x) for x in nodes}


# --- components -------------------------------------------------------------------------------------------------------


def test_components(spark):
    rnd = random.Random(3)
    links = [(rnd.randrange(120), rnd.randrange(120)) for _ in range(70)] + [(k, k + 1) for k in range(200, 260)] + [(300, 300)]
    got = {r["id"]: r["component"] for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == find(links, {x for e in links for x in e})
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- 1 line dedup -----------------------------------------------------------------------------------------------------


def norm(x):
    return " ".join(re.findall(r"[^\W_]+", x.lower()))


def alike(a, b):
    """Edit similarity of 0.8, in words if the longer form has 32, and lengths in letters that allow it."""
    x, y = (a.split(" "), b.split(" ")) if max(a.count(" "), b.count(" ")) >= 31 else (a, b)
    most = int(0.2 * max(len(x), len(y)) + 1e-9)
    return min(len(a), len(b)) >= 0.8 * max(len(a), len(b)) - 1e-9 and abs(len(x) - len(y)) <= most and edit(x, y) <= most


def edit(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def majority(hashes):
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def removed_by_hand(rows):
    lines = [(i, k, norm(x)) for i, t in rows if t is not None for k, x in enumerate(t.split("\n"))]
    lines = sorted((x for x in lines if x[2]), key=lambda x: (x[0] is None, x[0] or 0, x[1]))
    texts = sorted({x[2] for x in lines})
    seen_in = {}
    for k, t in enumerate(texts):
        for w in set(t.split(" ")):
            seen_in.setdefault(w, set()).add(k)
    near = {(i, j) for s in seen_in.values() for i in s for j in s if j < i} if len(texts) > 300 else {(i, j) for i in range(len(texts)) for j in range(i)}
    links = [(i, j) for i, j in near if min(len(texts[i]), len(texts[j])) >= 0.8 * max(len(texts[i]), len(texts[j])) - 1e-9 and alike(texts[i], texts[j])]
    of, seen, out = find(links, range(len(texts))), set(), {}
    at = {t: k for k, t in enumerate(texts)}
    for i, k, t in lines:
        g = of[at[t]]
        if g in seen:
            out.setdefault(i, []).append(k)
        seen.add(g)
    return out


def test_lines_against_brute_force(spark):
    base = ["The quick brown fox jumps over the lazy dog and runs away from number %d again" % k for k in range(4)]
    long = " ".join(f"w{k}x" for k in range(150))
    rows = [(1, "\n".join([base[0], "", "--", long])), (2, base[1].upper() + "\nunique " + "abc " * 3), (3, long.replace("w77x", "w77y") + "\n" + base[2]), (4, None), (5, "short\nshort\nother"), (9, "short")]
    got = {r["doc_id"]: r for r in line_dedup.dedup_lines(docs(spark, rows)).collect()}
    want = removed_by_hand(rows)
    assert {i: r["_removed"] for i, r in got.items() if r["_removed"]} == want
    for i, t in rows:
        kept = None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in want.get(i, []))
        assert got[i]["text"] == kept


def test_lines_odd(spark):
    df = docs(spark)
    got = line_dedup.dedup_lines(df)
    assert got.columns == [*df.columns, "_removed"] and got.count() == len(ODD)
    by = {(r["doc_id"], r["text"]) for r in got.collect()}
    assert (1, None) in by and (8, "Same line here") in by and (2, "") in by
    assert line_dedup.dedup_lines(df.limit(0)).count() == 0


def test_similar_bounds(spark):
    rnd = random.Random(5)
    pairs = []
    for _ in range(80):
        a = [rnd.choice("ab") * rnd.randint(1, 4) for _ in range(rnd.randint(1, 80))]
        b = [rnd.choice("abc") if rnd.random() < 0.2 else x for x in a]
        pairs.append((" ".join(a), " ".join(b[: rnd.randint(1, len(b))] if rnd.random() < 0.3 else b)))
    n = lambda c: F.size(F.split(c, " "))
    df = spark.createDataFrame(pairs, "a string, b string").selectExpr("*", "a as ta", "b as tb").withColumns({"sa": F.when(n("a") >= 25.6, line_dedup.symbols(F.col("a"))), "sb": F.when(n("b") >= 25.6, line_dedup.symbols(F.col("b")))})
    lengths = {"size_x": F.length("a"), "size_y": F.length("b"), "words_x": n("a"), "words_y": n("b")}
    allowed = line_dedup.lengths_allow(0.8)(lambda c: F.col(f"{c}_x"), lambda c: F.col(f"{c}_y"))
    for r in df.withColumns(lengths).select("a", "b", allowed.alias("allowed")).collect():
        assert r["allowed"] or not alike(r["a"], r["b"])
        x, y = r["a"].count(" ") + 1, r["b"].count(" ") + 1
        assert not (r["allowed"] and max(x, y) >= 32 and abs(x - y) > max(x, y) // 5)
    got = df.select("a", "b", line_dedup._similar(0.8).alias("s")).collect()

    def want(a, b):
        x, y = (a.split(" "), b.split(" ")) if max(a.count(" "), b.count(" ")) >= 31 else (a, b)
        return abs(len(x) - len(y)) <= 0.2 * max(len(x), len(y)) and edit(x, y) <= int(0.2 * max(len(x), len(y)) + 1e-9)

    assert all(r["s"] == want(r["a"], r["b"]) for r in got) and 10 < sum(r["s"] for r in got) < 70


def test_lines_around_one_passage(spark):
    """Lines that share half of their words are strangers in one bucket; near-copies among them are found all the same."""
    rnd = random.Random(4)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(3, 9)))
    passage = ["longestword%02d" % k for k in range(20)]
    rows = []
    for k in range(100):
        own = [word() for _ in range(22)]
        at = rnd.randrange(20)
        w = own[:at] + passage + own[at:]
        near = [word() if i in (2, 40) else x for i, x in enumerate(w)]
        rows += [(2 * k, " ".join(w)), (2 * k + 1, " ".join(near))]
    got = {r["doc_id"] for r in line_dedup.dedup_lines(spark.createDataFrame(rows, SCHEMA)).collect() if r["_removed"]}
    assert not {i for i in got if i % 2 == 0} and len(got) >= 95


def test_line_links_against_plain_edit_distance(spark):
    """Pairs with one word replaced, or a typo in a short line."""
    rnd = random.Random(11)
    vocab = ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rnd.randint(3, 9))) for _ in range(3000)]
    lines, pairs = [], 0
    for n in (3, 6, 10, 12, 20, 30):
        for _ in range(15):
            w = [rnd.choice(vocab) for _ in range(n)]
            v = list(w)
            k = rnd.randrange(n)
            v[k] = rnd.choice(vocab) if n > 6 else v[k][:-1] + "z"
            lines += [" ".join(w), " ".join(v)]
            pairs += edit(lines[-2], lines[-1]) <= int(0.2 * max(len(lines[-2]), len(lines[-1])) + 1e-9)
    rnd.shuffle(lines)
    rows = list(enumerate(lines))
    links = [(i, j) for i in range(len(lines)) for j in range(i) if abs(len(lines[i]) - len(lines[j])) <= 30 and set(lines[i].split()) & set(lines[j].split()) and alike(lines[i], lines[j])]
    of = find(links, range(len(lines)))
    got = {r["doc_id"] for r in line_dedup.dedup_lines(spark.createDataFrame(rows, SCHEMA)).collect() if r["_removed"]}
    want = {i for i in of if of[i] != i}
    assert len(want) >= 0.8 * pairs > 50
    assert got <= want and len(got) >= 0.97 * len(want)


# --- 2 simhash --------------------------------------------------------------------------------------------------------


def fp_by_hand(text, shingle=3):
    w = (text or "").encode().lower().split()
    grams = [b" ".join(w[i : i + shingle]) for i in range(len(w) - shingle + 1)] or ([b" ".join(w)] if w else [])
    return majority([xxhash.xxh64_intdigest(g, 42) for g in grams]) if grams else 0


def test_simhash_against_brute_force(spark):
    rows = random_docs(1) + [(500, None), (501, ""), (502, "a b"), (503, "x " * 5000)]
    fps = {}
    for i, t in rows:
        fps.setdefault(i, set()).add(fp_by_hand(t))
    got = simhash_dedup.groups(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    values = sorted({v for s in fps.values() for v in s})
    of = find([(a, b) for a in values for b in values if a < b and (a ^ b).bit_count() <= 3], values)
    least = {}
    for i, s in fps.items():
        for v in s:
            least[of[v]] = min(i, least.get(of[v], 1 << 60))
    for r in got:
        v = r["fingerprint"] % (1 << 64)
        assert v in fps[r["doc_id"]] and r["component_id"] == least[of[v]]


def test_near_groups_lose_no_link(spark):
    rnd = random.Random(9)
    seeds = [rnd.getrandbits(64) for _ in range(20)]
    fps = {s ^ sum(1 << rnd.randrange(64) for _ in range(rnd.randint(0, 4))) & (1 << 64) - 1 for s in seeds for _ in range(25)}
    signed = {x - (1 << 64) if x >> 63 else x: x for x in fps}
    items = spark.createDataFrame([(k, k) for k in signed], "id long, fp long")
    got = {r["id"]: r["component"] for r in simhash_dedup.near_groups(items, 3).collect()}
    ids = sorted(signed)
    of = find([(a, b) for a in ids for b in ids if a < b and (signed[a] ^ signed[b]).bit_count() <= 3], ids)
    groups = lambda m: {frozenset(x for x in ids if m.get(x, x) == c) for c in {m.get(x, x) for x in ids}}
    assert groups(got) == groups(of)


def test_keep_one(spark):
    rnd = random.Random(2)
    text = [f"w{rnd.randrange(10**6)}" for _ in range(400)]
    near = list(text)
    for k in (50, 150, 250, 350):
        near[k] = "other"
    rows = [(3, " ".join(text)), (1, " ".join(near)), (2, " ".join(f"v{rnd.randrange(10**6)}" for _ in range(400))), (4, None), (5, ""), (6, "solo"), (6, "solo"), (None, "last one")]
    df = docs(spark, rows)
    got = simhash_dedup.keep_one(df)
    assert got.columns == df.columns
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1) for r in got.collect()) == [-1, 1, 2, 4, 6]
    assert simhash_dedup.keep_one(df.limit(0)).count() == 0


def test_keep_one_against_plain_jaccard(spark):
    """Pairs just above the similarity of 0.8 lose one row, pairs just below it none."""
    rnd = random.Random(8)
    rows, want = [], set()
    for k in range(160):
        w = [f"w{rnd.randrange(10**7)}" for _ in range(204)]
        v = list(w)
        for at in range(10, 10 + 20 * rnd.randint(3, 6), 20):
            v[at] = f"x{rnd.randrange(10**7)}"
        a, b = ({tuple(x[i : i + 5]) for i in range(200)} for x in (w, v))
        rows += [(2 * k, " ".join(w)), (2 * k + 1, " ".join(v))]
        want |= {2 * k} | ({2 * k + 1} if len(a & b) < 0.8 * len(a | b) else set())
    assert 180 < len(want) < 300
    assert {r["doc_id"] for r in simhash_dedup.keep_one(spark.createDataFrame(rows, SCHEMA)).collect()} == want


# --- 3 LM scoring -----------------------------------------------------------------------------------------------------


def test_lattice_is_the_sum_over_segmentations():
    names = [b"a", b"b", b" ", b" a", b"ab", b" ab", b"ba"]
    logp = np.log(np.linspace(1, 2, 7) / np.linspace(1, 2, 7).sum())
    lattice = lm_score.Lattice(names)

    def brute(x):
        return 1.0 if not x else sum(math.exp(logp[k]) * brute(x[len(n) :]) for k, n in enumerate(names) if x.startswith(n))

    for word in (b" ab", b" abab", b" aabba", b" bbbb"):
        a, _ = lattice.forward([word, word], logp[None])
        assert math.isclose(math.exp(a[0, -1, 1]), brute(word))
        uses = np.zeros(7)
        lattice.expected([word], np.array([2.0]), logp, uses)
        assert math.isclose(sum(u * len(n) for u, n in zip(uses, names)), 2 * len(word))


def test_scores(spark):
    rows = [(i, t) for i, t in random_docs(4, n=40)] + [(700, None), (701, ""), (702, "ÉTÉ " * 300), (703, "x" * 5000)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("word", F.lit(0))
    trains = F.col("doc_id") % 3 != 0
    got = {(r["doc_id"], r["n_tokens"]): r for r in lm_score.score(df, public_tokenizers.path("piece_bpe_32k.model"), trains, block_bytes=2000).collect()}
    split = lambda t: [w.decode() for w in (t or "").encode().lower().split()] + ["\n"]
    c = Counter(w for i, t in rows if i % 3 for w in split(t))
    n, v = sum(c.values()), len(c)
    for i, t in rows:
        r = got[i, len(split(t))]
        assert r["n_known"] == sum(c[w] > 0 for w in split(t)) and r["train_tokens"] == n
        assert math.isclose(r["base_score"], sum(math.log10((c[w] + 1) / (n + v + 1)) for w in split(t)), rel_tol=1e-9)
        assert math.isfinite(r["score"]) and r["score"] < 0
    assert got[700, 1]["score"] == got[701, 1]["score"]
    assert lm_score.score(df.limit(0), public_tokenizers.path("piece_bpe_32k.model"), trains).count() == 0


def test_score_against_brute_force(spark):
    path = public_tokenizers.path("piece_bpe_32k.model")
    rows = [(i, t) for i, t in random_docs(5, n=30, words=15)] + [(900, "Zebra crossing"), (901, None)]
    names, prior = lm_score.vocabulary(path)
    own = dict(zip(names, prior, strict=True))
    longest = max(map(len, names))

    def sums(raw, p):
        a = [1.0] + [0.0] * len(raw)
        for j in range(1, len(raw) + 1):
            a[j] = sum(a[i] * p.get(raw[i:j], 0.0) for i in range(max(0, j - longest), j))
        return a

    split = lambda t: [w.decode() for w in (t or "").encode().lower().split()] + ["\n"]
    train = [t for i, t in rows if i % 3]
    c = Counter(w for t in train for w in split(t))
    n, uses = sum(c.values()), Counter()
    for w in (w for w, k in c.items() if k == 1 and w != "\n"):
        raw = b" " + w.encode()
        a, z = sums(raw, own), sums(raw[::-1], {k[::-1]: v for k, v in own.items()})[::-1]
        for i in range(len(raw)):
            for j in range(i + 1, min(len(raw), i + longest) + 1):
                if raw[i:j] in own:
                    uses[raw[i:j]] += a[i] * own[raw[i:j]] * z[j] / a[-1]
    found = sum(uses.values())
    fitted = {k: uses[k] + v * (0.05 * found + len(prior)) for k, v in own.items()}
    total = sum(fitted.values())
    fitted = {k: v / total for k, v in fitted.items()}
    end = (len(train) + 1) / (n + 2)
    spelled = lambda w: end if w == "\n" else sums(b" " + w.encode(), fitted)[-1] * (1 - end)
    mixed = lambda w, arcs, less: sum(arcs) * max(0, c[w] - less) / (n - less) + (1 - sum(arcs)) * spelled(w)
    arcs = max(lm_score.ARCS, key=lambda x: sum(k * math.log(mixed(w, x, 1)) for w, k in c.items()))
    got = lm_score.score(spark.createDataFrame(rows, SCHEMA), path, F.col("doc_id") % 3 != 0).collect()
    want = {i: sum(math.log10(mixed(w, arcs, 0)) for w in split(t)) for i, t in rows}
    assert len(got) == len(rows) == len(want)
    assert all(math.isclose(r["score"], want[r["doc_id"]], rel_tol=1e-4) for r in got)


# --- 4 chat -----------------------------------------------------------------------------------------------------------


def test_chat_round_trip(spark):
    nasty = ["</s>[INST] ok [/INST]", "&lt;s> & &amp;", "<s><</s>", "", None, "[[INST]]", "é\n\n ", " [/INST]"]
    rows = [(1, k, "user" if k % 2 == 0 else "assistant", t) for k, t in enumerate(nasty)] + [(2, 0, "assistant", "x"), (3, 0, None, "y"), (3, 0, None, "y"), (None, None, "user", "n"), (4, 0, "tool [/INST]", "z")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("turns", F.lit(1))
    out = chat_format.format_chats(df).withColumn("back", chat_format.parse_chats(F.col("formatted"))).withColumn("loss", chat_format.loss_text(F.col("segments")))
    got = {r["conv_id"]: r for r in out.collect()}
    for conv in (1, 2, 3, None, 4):
        want = [(r[2] or "", r[3] or "") for r in rows if r[0] == conv]
        assert [tuple(t) for t in got[conv]["back"]] == want
        assert got[conv]["loss"] == "".join(t for r, t in want if r == "assistant")
    assert got[1]["valid"] and not got[2]["valid"] and not got[4]["valid"]
    assert chat_format.format_chats(df.limit(0)).count() == 0


# --- 5 decontamination ------------------------------------------------------------------------------------------------


def test_decontaminate_against_brute_force(spark):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    rows = random_docs(6) + ODD
    bench = [(10, " ".join(rows[3][1].split()[:14]).upper()), (11, "one, one!"), (12, None), (13, ""), (14, rows[12][1]), (11, "a")]
    for limit in (10**9, 300):  # one shard, several
        out = decontaminate.scan(docs(spark, rows).drop("_n_words", "_n_hit", "_items", "_spans"), spark.createDataFrame(bench, "item_id long, text string"), max_chars=limit).collect()
        assert len(out) == len(rows)
        for r in out:
            w = words(r["text"])
            hit, items = set(), set()
            for item, t in bench:
                b = words(t)
                for k in range(max(1, len(b) - 9) if b else 0):
                    x = b[k : k + 10]
                    for i in range(len(w) - len(x) + 1):
                        if w[i : i + len(x)] == x:
                            hit |= set(range(i, i + len(x)))
                            items.add(str(item))
            assert (r["_n_words"], r["_n_hit"], r["_items"]) == (len(w), len(hit), sorted(items))
            assert sum(len(words(r["text"][s["start"] : s["end"]])) for s in r["_spans"]) == len(hit)
    assert decontaminate.drop_contaminated(docs(spark), spark.createDataFrame([], "item_id long, text string")).count() == len(ODD)


# --- 6, 8 classifiers -------------------------------------------------------------------------------------------------


def test_classifiers_on_held_out_rows(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").toPandas().set_index("doc_id")
    got = queries.op6_rule_classifier(spark, sf_dir).toPandas()
    assert got.score.between(0, 1).all() and (got.held_out == got.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 4 == 2)).all()
    known = got[got.held_out & got.doc_id.isin(labels.index)]
    right = (known.predicted == labels.quality.loc[known.doc_id].to_numpy()).mean()
    assert right >= 0.85
    tox = queries.op8_toxicity(spark, sf_dir).toPandas().set_index("doc_id")
    both = labels.join(tox, rsuffix="_found")
    assert (both.toxic_found & (both.toxic == 0)).mean() < 0.05 and len(tox) == len(got)


def test_toxicity_on_held_out_rows(spark):
    """Half of the labels are learned from; of the others, toxic texts are found, and more severe ones are worse."""
    sf = "/root/testdata/sf0.1"
    fold = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    df = spark.read.parquet(f"{sf}/documents.parquet").join(labels.select("doc_id"), "doc_id", "left_semi")
    found = toxicity.severity(df, labels, trains=fold).withColumnRenamed("toxic", "found").join(labels.select("doc_id", F.col("toxic").alias("y")), "doc_id").where(~fold).toPandas()
    assert len(found) > 500
    assert found[found.y == 1].found.mean() >= 0.8 and found[found.y == 0].found.mean() <= 0.03
    assert found[found.y == 1].severity.mean() > 4 * found[found.y == 0].severity.mean()


def test_classifiers_odd(spark):
    df = docs(spark)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert rule_classifier.classify(df, none, F.lit(True)).where("score between 0 and 1").count() == len(ODD)
    assert toxicity.severity(df, none).where("not toxic").count() == len(ODD)
    one = spark.createDataFrame([(3, 1, 1), (99, 0, 0)], "doc_id long, quality int, toxic int")
    assert rule_classifier.classify(df, one, F.lit(True)).count() == len(ODD)
    assert toxicity.severity(df.limit(0), one).count() == 0


def test_ordinal_thresholds_ascend():
    rnd = np.random.default_rng(1)
    rows = [(np.array([0, 1]), np.array([x, x]), int(x > 1)) for x in rnd.uniform(0, 3, 200)]
    m = toxicity.fit_ordinal({"t": 0}, rows)
    assert (np.diff(m.thresholds) >= 0).all() and m.weights[1] > 0


# --- 7 quality rules --------------------------------------------------------------------------------------------------


def test_statistics_against_brute_force(spark):
    rows = random_docs(8) + ODD + [(900, "a b c d e f g h " * 3), (901, "| # x\n\n| # x\n y")]
    for r in quality_rules.statistics(docs(spark, rows)).collect():
        t = r["text"] or ""
        w = WORD.findall(t)
        n = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
        cover = {j for i in range(len(w) - 7) if n[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        assert (r["_n_words"], r["_word_chars"], r["_n_symbols"]) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)))
        assert (r["_n_dup_lines"], r["_n_repeat_words"]) == (len(lines) - len(set(lines)), len(cover))


def test_label_model_learns_which_rules_are_right():
    rnd = random.Random(1)
    seen = Counter()
    for _ in range(4000):
        good = rnd.random() < 0.8
        vote = lambda acc: (1 if (rnd.random() < acc) == good else -1) if rnd.random() < 0.9 else 0
        seen[vote(0.95), vote(0.9), vote(0.6)] += 1
    m = quality_rules.fit_label_model(list(seen.items()), 3)
    assert abs(m.prior - 0.8) < 0.08
    spread = [g - b for b, g in m.says_good]
    assert spread[0] > spread[2] and spread[1] > spread[2]
    assert quality_rules.fit_label_model([], 3).prior == 0.7


def test_rules_keep_clean_rows_and_columns(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = quality_rules.keep(df)
    assert kept.columns == df.columns
    got = queries.op7_quality_rules(spark, sf_dir).toPandas()
    assert sorted(r["doc_id"] for r in kept.select("doc_id").collect()) == sorted(got[got.kept].doc_id)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").toPandas().set_index("doc_id")
    own = got[~got.base_failed & got.doc_id.isin(labels.index)]
    clean = labels.quality.loc[own.doc_id].to_numpy() == 1
    assert own.kept[clean].mean() > 0.97
    assert quality_rules.keep(docs(spark)).count() == 0 and quality_rules.keep(df.limit(0)).count() == 0


def test_kept_against_brute_force(spark, sf_dir):
    """Votes and expectation-maximisation by hand, from the texts."""
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").toPandas()
    stop, votes, failed = set(quality_rules.STOP_WORDS), {}, set()
    for i, t in zip(texts.doc_id, texts.text, strict=True):
        t = t or ""
        w, lines = WORD.findall(t), [x for x in t.split("\n") if WORD.search(x)]
        n = Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
        again = len({j for k in range(len(w) - 7) if n[tuple(w[k : k + 8])] > 1 for j in range(k, k + 8)})
        marks, dup, ended = len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), sum(bool(re.search(r"[.!?:;。]['\")\]]*[\x20\x09-\x0D]*$", x)) for x in lines)
        k, chars, known = len(w), sum(map(len, w)), sum(x.lower() in stop for x in w)
        said = lambda good, bad: 1 if good else -1 if bad else 0
        votes[i] = (
            said(False, k < 12), said(False, chars < 2.2 * k or chars > 14 * k), said(marks * 20 <= k, marks * 4 > k), said(False, dup * 5 > 2 * len(lines)), said(False, again * 4 > k),
            said(known * 20 >= k > 0, k >= 20 and known * 50 < k), said(ended * 2 > len(lines), len(lines) > 3 and ended * 10 < len(lines)), said(False, k >= 20 and len(set(w)) * 12 < k),
        )
        if k < 20 or 100 * again > 30 * k:
            failed.add(i)
    prior, acc, total = 0.7, np.tile([[0.15, 0.85]], (8, 1)), len(votes)
    v = np.array(list(votes.values()))

    def posterior():
        up, down = np.log(acc[:, 1] / acc[:, 0]), np.log((1 - acc[:, 1]) / (1 - acc[:, 0]))
        return 1 / (1 + np.exp(-(math.log(prior / (1 - prior)) + (v == 1) @ up + (v == -1) @ down)))

    for _ in range(50):
        q = posterior()
        new = []
        for j in range(8):
            sides = []
            for weight, start in ((1 - q, 0.15), (q, 0.85)):
                yes, all_ = weight[v[:, j] == 1].sum(), weight[v[:, j] != 0].sum()
                sides.append((yes + 0.05 * total * start) / (all_ + 0.05 * total))
            new.append(sides if sides[0] < sides[1] else [0.5, 0.5])
        acc, moved = np.array(new), abs(q.mean() - prior)
        prior = min(0.999, max(0.001, q.mean()))
        if moved < 1e-9:
            break
    want = {i for i, p in zip(votes, posterior(), strict=True) if p >= 0.5 and i not in failed}
    got = queries.op7_quality_rules(spark, sf_dir).toPandas()
    assert set(got[got.kept].doc_id) == want and set(got[got.base_failed].doc_id) == failed


# --- 9 substring dedup ------------------------------------------------------------------------------------------------


def test_fm_index():
    rnd = np.random.default_rng(5)
    seq = np.r_[0, rnd.integers(1, 4, 60), 0, rnd.integers(1, 4, 40)]
    index = fm_index.FMIndex(seq, 5)
    ends = np.arange(6, len(seq) + 1)
    got, lo, hi = index.search(seq, ends, 5)
    every = [tuple(seq[i : i + 5]) for i in range(len(seq))]
    for e, g, a, b in zip(ends, got, lo, hi):
        if g == 5:
            assert sorted(index.order[a:b]) == [i for i, x in enumerate(every) if x == tuple(seq[e - 5 : e])]
        else:
            assert every.count(tuple(seq[e - 5 : e])) == 1


@pytest.mark.parametrize("hot", [2000, 1])
def test_substrings_against_brute_force(spark, hot):
    rows = random_docs(11, n=80, words=60) + ODD
    first = {}
    split = lambda t: WORD.findall(t or "")
    order = lambda i: math.inf if i is None else i
    for i, t in rows:
        w = split(t)
        for k in range(len(w) - 12):
            x = tuple(w[k : k + 13])
            first[x] = min(order(i), first.get(x, math.inf))
    got = substring_dedup.cut_repeats(docs(spark, rows), block_bytes=4000, hot_documents=hot).collect()
    want = Counter()
    for i, t in rows:
        w = split(t)
        gone = {j for k in range(len(w) - 12) if first[tuple(w[k : k + 13])] < order(i) for j in range(k, k + 13)}
        want[i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)] += 1
    assert Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in got) == want
    assert substring_dedup.cut_repeats(docs(spark).limit(0)).count() == 0


# --- 10 packing -------------------------------------------------------------------------------------------------------


def test_encoder_equals_the_library():
    e, rnd = packing.Encoder(BPE, 1), random.Random(1)
    bits = ["a", "The", "é", " ", "  ", "\n", "\n\n", "\t", ".", ",", "'s", "'", "!", "1", "23", "_", "-", ")", "(", " ", "<|endoftext|>", "日本", "́", "x.y", "\x01", "…", "½"]
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 9))) for _ in range(5000)]
    texts += [" " * 300_000, "x" * 300_000, "\n" * 70_000 + "a" + " " * 1_100_000, "été 12 " * 200_000, ""]
    assert e.quick is not None and sum(len(x) >= packing._LONG_TEXT for x in texts) == 2
    assert [e(x).tolist() for x in texts] == [x.ids + [1] for x in e.tok.encode_batch(texts, add_special_tokens=False)]
    assert packing.ranked(public_tokenizers.path("word_bpe_49k.json")) is None


@pytest.mark.parametrize("limits", [packing.Limits(), packing.Limits(tokens=64, segments=3, loss_tokens=40)])
def test_packing(spark, limits):
    rows = [(k, t) for k, (_, t) in enumerate(random_docs(12, n=90) + ODD)] + [(None, "last"), (7, rows_again := "twice " * 40), (7, rows_again)]
    df = docs(spark, rows).withColumn("prompt", F.lit(5))
    got = packing.pack(df, BPE, 1, prompt_tokens_col="prompt", limits=limits, group_rows=40, with_ids=True).toPandas()
    tok = packing.Encoder(BPE, 1).tok
    ids = Counter(tuple(tok.encode(t or "", add_special_tokens=False).ids + [1]) for _, t in rows)
    assert got.length.sum() == sum(len(x) * n for x, n in ids.items())
    for _, s in got.groupby("sequence_id"):
        s = s.sort_values("offset")
        assert s.offset.tolist() == [0, *s.length.cumsum().tolist()[:-1]]
        assert s.length.sum() <= limits.tokens and len(s) <= limits.segments
        assert sum(max(0, r.start + r.length - max(5, r.start)) for r in s.itertuples()) <= limits.loss_tokens
    assert all(zlib.crc32(np.asarray(r.ids, dtype="<u4").tobytes()) == r.ids_crc32 and len(r.ids) == r.length for r in got.itertuples())
    for k, t in rows:  # each document's pieces, in order, are its ids, without a gap or a repeat
        mine = (got[got.doc_id.isna()] if k is None else got[got.doc_id == k]).sort_values("start")
        if k != 7:
            assert np.concatenate(mine.ids.to_list()).tolist() == tok.encode(t or "", add_special_tokens=False).ids + [1]
            assert mine.start.tolist() == [0, *mine.length.cumsum().tolist()[:-1]] and set(mine.doc_tokens) == {mine.length.sum()}
    assert packing.pack(df.limit(0), BPE, 1).count() == 0


def test_packing_chats(spark, sf_dir):
    got = queries.packing_chats(spark, sf_dir).toPandas()
    chats = spark.read.parquet(f"{sf_dir}/conversations.parquet").toPandas()
    assert set(got.conv_id) == set(chats.conv_id)
    ids, prompt = {}, {}
    tok = packing.Encoder(BPE, 1).tok
    size = lambda x: len(tok.encode(x, add_special_tokens=False).ids)
    rows = chat_format.format_chats(spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")).select("conv_id", "segments").collect()
    for r in rows:
        k = next((k for k, s in enumerate(r["segments"]) if s["loss"]), len(r["segments"]))
        lead, text = ("".join(s["text"] for s in part) for part in (r["segments"][:k], r["segments"][k:]))
        prompt[r["conv_id"]] = size(lead)
        ids[r["conv_id"]] = prompt[r["conv_id"]] + size(text) + 1
    assert got.groupby("conv_id").length.sum().to_dict() == ids
    got["loss"] = [max(0, r.start + r.length - max(prompt[r.conv_id], r.start)) for r in got.itertuples()]
    each = got.groupby("sequence_id").agg(tokens=("length", "sum"), segments=("length", "size"), loss=("loss", "sum"))
    assert each.tokens.max() <= 2048 and each.segments.max() <= 12 and each.loss.max() <= 1536


# --- the pipeline -----------------------------------------------------------------------------------------------------


def plain_jaccard_keeps(rows):
    """Ids that stay if one of each group of texts with a Jaccard similarity of 0.8 stays, the first."""
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set()))
    at = {}
    for k, s in enumerate(sets):
        for x in s:
            at.setdefault(x, []).append(k)
    both = Counter((i, j) for ks in at.values() for i in ks for j in ks if j < i)
    links = [(i, j) for (i, j), n in both.items() if n >= 0.8 * (len(sets[i]) + len(sets[j]) - n) - 1e-9]
    none = [k for k, s in enumerate(sets) if not s]
    of = find(links + [(none[0], k) for k in none[1:]], range(len(rows)))
    least = {}
    for k, (i, _) in enumerate(rows):
        least[of[k]] = min(i, least.get(of[k], 1 << 60))
    return set(least.values())


def test_pipeline_against_brute_force(spark, sf_dir, tmp_path):
    """run() on the small table with planted near-copies, repeated lines and benchmark passages, each stage held against plain code
    on what the stage before kept."""
    import corpus_pipeline

    rnd = random.Random(6)
    base = spark.read.parquet(f"{sf_dir}/documents.parquet")
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    kinds, rows = base.schema, [tuple(r) for r in base.collect()]
    at, long = rows[0], [r for r in rows if r[1] and len(r[1].split()) > 150][:12]
    passages = [r[1] for r in bench.select("item_id", "text").collect() if r[1] and len(r[1].split()) >= 12]
    make = lambda i, t, like: tuple({"doc_id": i, "text": t, "n_chars": len(t)}.get(f.name, x) for f, x in zip(kinds, like, strict=True))
    for k, r in enumerate(long):
        w = r[1].split(" ")
        near = [("swapped" if j in (len(w) // 3, 2 * len(w) // 3) else x) for j, x in enumerate(w)]
        rows += [make(100_000 + k, " ".join(near), r), make(200_000 + k, f"{' '.join(w[: len(w) // 2])} {rnd.choice(passages)} {' '.join(w[len(w) // 2 :])}", r)]
    there = [c for c in ("doc_id", "text", "lang", "source", "n_chars") if c in base.columns]
    assert there == base.columns and at
    spark.createDataFrame(rows, kinds).write.parquet(f"{tmp_path}/documents.parquet")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    docs_in, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs_in, str(tmp_path))
        assert out.columns == base.columns
        seen[name] = (docs_in.toPandas(), out.toPandas())
        docs_in = spark.createDataFrame(seen[name][1], kinds)
    pairs = lambda x: list(zip(x.doc_id.tolist(), x.text.tolist(), strict=True))
    before, after = seen["quality_rules"]
    got = queries.op7_quality_rules(spark, str(tmp_path)).toPandas()
    assert sorted(after.doc_id) == sorted(got[got.kept].doc_id)
    before, after = seen["line_dedup"]
    want, text = removed_by_hand(pairs(before)), dict(pairs(before))
    off = [r for r in after.itertuples() if r.text != "\n".join(x for k, x in enumerate(text[r.doc_id].split("\n")) if k not in want.get(r.doc_id, []))]
    assert len(off) <= 0.02 * max(1, len(want)) and all(r.n_chars == len(r.text) for r in after.itertuples())  # candidates are not exhaustive
    before, after = seen["simhash_dedup"]
    assert set(after.doc_id) == plain_jaccard_keeps(pairs(before))
    before, after = seen["decontaminate"]
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    known = {tuple(w[k : k + 10]) for w in (words(r["text"]) for r in bench.collect()) for k in range(max(1, len(w) - 9)) if w}
    sizes = {len(x) for x in known}
    hit = {i for i, t in pairs(before) if any(tuple(words(t)[k : k + n]) in known for n in sizes for k in range(len(words(t))))}
    assert set(before.doc_id) - set(after.doc_id) == hit and sum(i >= 200_000 for i in hit) >= 1
    packed = corpus_pipeline.run(spark, str(tmp_path)).toPandas()
    tok = packing.Encoder(BPE, 1).tok
    assert packed.groupby("doc_id").length.sum().to_dict() == {i: len(tok.encode(t, add_special_tokens=False).ids) + 1 for i, t in pairs(after)}


def test_pipeline_odd(spark, tmp_path):
    """Nulls, repeats, clashing names and empty tables pass through every stage."""
    import corpus_pipeline

    spark.createDataFrame([(1, "what is the height of the old tower by the river in spring")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    some = docs(spark, [*ODD, (20, "A sentence of the kind that is kept, with the words that it has in it, and it ends. " * 2), (20, "Another that is kept, with the words of it, as it is in the table by the wall, and it ends here with a stop.")])
    for df in (some, some.limit(0)):
        out = df
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, out, str(tmp_path))
            assert out.columns == df.columns
        assert corpus_pipeline.STAGES[-1][1](spark, out, str(tmp_path)).count() >= 0
