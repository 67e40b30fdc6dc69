"""Groups of linked rows: connected components over an edge table, and links among rows that share a bucket."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import discard, stored


#: Rows outside a bucket's largest group from which on the bucket is crowded, where the caller says what to do with crowds.
CROWDED = 64
#: Leaders of a crowded bucket in a round, and the share by which rows outside the largest groups must fall for another round.
LEADERS, _FALL = 8, 0.1
#: Rows of a bucket, about, that meet another part's in a task.
BLOCK = 2048


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, name: str = "edges", rounds: int | None = None) -> DataFrame:
    """(id, component) for every node of edges (a, b: long); component is the smallest id reachable, or, if the given number of
    rounds is not enough, one that is reachable.

    Each round is two shuffles of the edges; the number of rounds grows with the logarithm of the longest path.
    Nothing but two sums a round reaches the driver. Self loops and repeated edges are allowed; no edges, no rows.
    """
    nodes = edges.where("a = b").select(F.col("a").alias("id"), F.col("a").alias("component"))
    e = stored(edges.where("a <> b").select(F.col("a").alias("u"), F.col("b").alias("v")), name)
    mark, done = None, 0
    while done != rounds:
        new, done = stored(_small_star(_large_star(e)), name), done + 1
        if rounds:
            discard(e)
            e = new
            continue
        now = new.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        discard(e)
        e = new
        if tuple(now) == mark:
            break
        mark = tuple(now)
    stars = e.select(F.col("u").alias("id"), F.col("v").alias("component"))
    heads = e.select(F.col("v").alias("id"), F.col("v").alias("component"))
    return stars.unionByName(heads).unionByName(nodes).groupBy("id").agg(F.min("component").alias("component"))


#: Whether two rows of a bucket may be linked: over (a, b), which take the name of a carried column to that of either row.
Close = Callable[[Callable[[str], Column], Callable[[str], Column]], Column]


def sizes_allow(similarity: float) -> Close:
    """For rows that carry a size: the smaller one is at least `similarity` of the larger one."""
    return lambda a, b: F.least(a("size"), b("size")) >= F.greatest(a("size"), b("size")) * F.lit(similarity) - F.lit(1e-9)


def _side(mark: str) -> Callable[[str], Column]:
    return lambda c: F.col(f"{c}{mark}")


@dataclass(frozen=True)
class Crowd:
    """What a caller knows of items in crowded buckets. verify: as for all items, but for pairs of these. meet: takes their distinct rows
    (id, carry..., g) and returns different pairs (a, b), a < b, of different groups: all that may be linked, whether they share a
    bucket or not, but those of two rows for which `stays` holds, which go on meeting in their buckets. done: called at the end."""

    verify: Callable[[DataFrame], DataFrame]
    meet: Callable[[DataFrame], DataFrame]
    stays: Column
    done: Callable[[], None]


def pairs_between(split: DataFrame, carry: tuple[str, ...], marks: tuple[str, ...], close: Close) -> DataFrame:
    """(a, b), a < b, of the rows (id, key, g, top, carry..., marks...) that share a bucket, are close, and are of different groups. A pair
    that shares several buckets is made once, in the one with the smallest key: no row has the same key twice, and a row's smaller
    keys, of which there are no more than an item has buckets, tell. A bucket of more than BLOCK rows outside its largest group (others,
    where split has it) is dealt to parts, each of which meets all rows of the bucket."""
    smaller = Window.partitionBy("id").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    split, cols = split.withColumn("below", F.collect_list("key").over(smaller)), ("id", *carry, *marks, "below", "g")
    parts = F.ceil(F.col("others") / BLOCK).cast("int") if "others" in split.columns else F.lit(1)
    part = F.pmod(F.xxhash64("id"), parts).cast("int").alias("part")
    x = split.where("g <> top").select("key", part, *(F.col(c).alias(f"{c}_x") for c in cols))
    y = split.select("key", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"), "top", *(F.col(c).alias(f"{c}_y") for c in cols))
    once = (F.col("g_y") == F.col("top")) | (F.col("id_x") < F.col("id_y"))
    same = (x["key"] == y["key"]) & (x["part"] == y["part"])
    met = x.join(y, same & (F.col("g_x") != F.col("g_y")) & once & close(_side("_x"), _side("_y")) & ~F.arrays_overlap("below_x", "below_y"))
    return met.select(F.least("id_x", "id_y").alias("a"), F.greatest("id_x", "id_y").alias("b"))


def bucket_groups(
    keyed: DataFrame, verify: Callable[[DataFrame], DataFrame], name: str, close: Close, carry: tuple[str, ...] = ("size",), crowds: Callable[[DataFrame], Crowd] | None = None, marked: Callable[[DataFrame], DataFrame] | None = None, agree: Close | None = None,
    known: tuple[DataFrame, DataFrame] | None = None,
) -> DataFrame:
    """(id, component), stored, of every item that is linked to another one.

    keyed: (id long, key long, carry...), a row for each bucket of an item. Pairs that share a bucket and
    are `close` by what their rows carry are candidates. verify: takes stored candidates (a, b), a < b, and returns the links
    among them, stored.

    Inside a bucket not all pairs are looked at: each item is compared with its bucket's leader first, and then only pairs from
    different groups are, of which one is outside the bucket's largest group. The groups are those of all links, as a pair that
    is left out has both sides in one group. Such a pair is made in one of its buckets, see pairs_between().

    crowds: takes the ids (id) of buckets in which many rows are outside the largest group, and says how these meet, see Crowd.
    Such buckets have more leaders first, of what is outside the largest group, in rounds for as long as these join much; what
    is left meets by Crowd.meet. No pair of a bucket is left out by it but those that can't be linked.

    marked: takes ids (id) and returns (id, mark) of those that have one; agree: whether pairs from different groups may be linked by their
    marks, which only rows of buckets with several groups need. Both rule out what verify would not link, and nothing else.

    known: stored pairs (a, b), a < b, that were verified before, and the links among them, which count as this function's own."""
    dealt, row = keyed.repartition("key"), F.xxhash64("id", *carry)  # of all columns, so that both sides of the join read one exchange
    shared = dealt.groupBy("key").agg(F.min(row).alias("low"), F.max(row).alias("high")).where("low <> high").select("key")
    buckets = stored(dealt.join(shared.hint("shuffle_hash"), "key"), f"{name}-buckets")

    leaders = buckets.groupBy("key").agg(F.min("id").alias("a"), F.min_by(F.struct(*carry), "id").alias("s"))
    leaders = leaders.select("key", "a", *(F.col(f"s.{c}").alias(f"{c}_a") for c in carry))
    stars = buckets.join(leaders, "key").where((F.col("a") != F.col("id")) & close(_side("_a"), _side("")))
    fresh = stars.select("a", F.col("id").alias("b")).distinct()
    tried = stored(fresh.join(known[0], ["a", "b"], "left_anti") if known else fresh, f"{name}-pairs")
    firsts = [verify(tried)]
    first, tries = firsts[0], tried
    if known:
        first, tries = first.unionByName(known[1]), tried.unionByName(known[0])
    groups = stored(components(first, name, rounds=2), f"{name}-groups")  # what these don't join is only compared once more

    def parted(rows: DataFrame) -> DataFrame:
        """(key, top, others) of buckets with several groups: the largest, and how many rows are outside it."""
        sizes = rows.groupBy("key", "g").agg(F.count(F.lit(1)).alias("n"))
        found = sizes.groupBy("key").agg(F.max_by("g", F.struct("n", "g")).alias("top"), (F.sum("n") - F.max("n")).alias("others")).where("others > 0")
        return stored(found, f"{name}-parted")

    g = buckets.join(groups.withColumnRenamed("component", "g"), "id", "left").withColumn("g", F.coalesce("g", "id"))
    b = stored(g.select("key", "id", *carry, "g"), f"{name}-buckets")
    most = parted(b)
    left = [b, most, groups]

    def merged(rows: DataFrame, joined: DataFrame) -> DataFrame:
        """rows with the groups that links joined in place of those they had. joined: (id, component) of groups."""
        to = joined.select(F.col("id").alias("g"), "component")
        return stored(rows.join(to, "g", "left").withColumn("g", F.coalesce("component", "g")).select("key", "id", *carry, "g"), f"{name}-buckets")

    crowd, met_of_crowd = None, None
    if crowds:
        crowded = most.where(F.col("others") > CROWDED).select("key")
        rows = stored(b.join(crowded, "key", "left_semi"), f"{name}-crowd")
        left.append(rows)
        if rows.take(1):
            crowd, now, n, outside = crowds(rows.select("id").distinct()), parted(rows), 0, 0
            left.append(now)
            while True:
                many = now.where(F.col("others") > CROWDED)
                n, before, outside = n + 1, outside, many.agg(F.sum("others")).first()[0] or 0
                if not outside or (before and outside > before * (1 - _FALL)):
                    break
                many = rows.join(many.select("key", "top"), "key")
                one = many.where("g <> top").groupBy("key", F.pmod(F.xxhash64("id", F.lit(n)), F.lit(LEADERS)).alias("slot")).agg(F.min_by(F.struct("id", *carry, "g"), F.struct(F.xxhash64(F.lit(n), "id"), "id")).alias("s"))
                led = one.select("key", *(F.col(f"s.{c}").alias(f"{c}_l") for c in ("id", *carry, "g")))
                new = many.join(led, "key").where((F.col("g") != F.col("g_l")) & close(_side("_l"), _side("")))
                new = new.select(F.least("id", "id_l").alias("a"), F.greatest("id", "id_l").alias("b")).distinct()
                pairs = stored(new.join(tries, ["a", "b"], "left_anti"), f"{name}-pairs")
                links, of = crowd.verify(pairs), rows.select("id", "g").distinct()
                edges = links.join(of.toDF("a", "ga"), "a").join(of.toDF("b", "gb"), "b").select(F.col("ga").alias("a"), F.col("gb").alias("b"))
                joined = stored(components(edges, name, rounds=2), f"{name}-groups")
                rows = merged(rows, joined)
                now = parted(rows)
                first, tries = first.unionByName(links), tries.unionByName(pairs)
                left += [pairs, links, joined, rows, now]
            met_of_crowd = crowd.meet(rows.join(now.where(F.col("others") > CROWDED).select("key"), "key", "left_semi").select("id", *carry, "g").distinct())
    split, extra = b.join(most, "key"), ()
    if crowd:
        again = rows.join(now, "key").where((F.col("others") <= CROWDED) | crowd.stays)
        split = split.where(F.col("others") <= CROWDED).unionByName(again)
    split = stored(split, f"{name}-split")
    left.append(split)
    if marked and agree:
        marks = stored(marked(split.select("id").distinct()), f"{name}-marks")
        left.append(marks)
        split, extra, before = split.join(marks, "id", "left"), ("mark",), close
        close = lambda a, b: before(a, b) & agree(a, b)
    met = pairs_between(split, carry, extra, close)
    met = met.unionByName(met_of_crowd).distinct() if met_of_crowd else met
    rest = stored(met.join(tries, ["a", "b"], "left_anti"), f"{name}-pairs")
    second = verify(rest)
    out = stored(components(first.unionByName(second), name), f"{name}-groups")
    for old in (buckets, *left, tried, rest, *firsts, second):
        discard(old)
    if crowd:
        crowd.done()
    return out
