"""Data quality: all rules of a table in one aggregate, profiles, schema checks and row quarantine (DQ operators)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class QualityError(ValueError):
    """Data quality validation failed."""


@dataclass(frozen=True)
class Rule:
    """kind: completeness, uniqueness, range, pattern (or regex), freshness, outlier. A threshold of None is the kind's own."""

    name: str
    kind: str
    columns: tuple[str, ...]
    threshold: float | None = None
    low: float | None = None
    high: float | None = None
    pattern: str | None = None
    as_of: str | None = None
    max_hours: float | None = None
    max_z: float = 3.0
    severity: str = "error"
    enabled: bool = True


_KINDS = ("completeness", "uniqueness", "range", "pattern", "freshness", "outlier")


def rule_from_config(c: dict) -> Rule:
    """A rule from a configuration entry; both spellings in use are taken (column/columns, regex/pattern, min/min_value, ...)."""
    kind = {"regex": "pattern"}.get(c["type"], c["type"])
    if kind not in _KINDS:
        raise ValueError(f"Unknown rule type: {c['type']}")
    cols = c.get("columns", c.get("column"))
    pick = lambda *names: next((c[n] for n in names if n in c), None)
    return Rule(
        name=c.get("name", kind), kind=kind, columns=(cols,) if isinstance(cols, str) else tuple(cols), threshold=c.get("threshold"),
        low=pick("min", "min_value"), high=pick("max", "max_value"), pattern=pick("pattern", "regex"), as_of=c.get("as_of"),
        max_hours=pick("max_hours", "max_age_hours"), severity=c.get("severity", "error"), enabled=c.get("enabled", True),
    )


def _row_predicate(r: Rule) -> Column:
    """Whether one row passes a rule that can be told from the row."""
    if r.kind == "completeness":
        return reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in r.columns))
    x = F.col(r.columns[0])
    if r.kind == "range":
        tests = [x.isNotNull(), *([x >= r.low] if r.low is not None else []), *([x <= r.high] if r.high is not None else [])]
        return F.coalesce(reduce(lambda a, b: a & b, tests), F.lit(False))
    return F.coalesce(x.rlike(r.pattern), F.lit(False))


def _aggregates(r: Rule) -> list[Column]:
    """(passed, total) of a rule as aggregates."""
    if r.kind == "uniqueness":
        # A struct counts nulls as a value.
        passed = F.count_distinct(F.struct(*r.columns))
    elif r.kind == "freshness":
        hours = (F.lit(r.as_of).cast("timestamp").cast("double") - F.max(F.col(r.columns[0]).cast("timestamp")).cast("double")) / 3600
        passed = F.when(hours <= r.max_hours, F.count(F.lit(1))).otherwise(0)
    elif r.kind == "outlier":
        passed = F.count_if(F.coalesce(F.abs(F.col(f"_z_{r.columns[0]}")) <= r.max_z, F.lit(True)))
    else:
        passed = F.count_if(_row_predicate(r))
    return [passed.cast("long"), F.count(F.lit(1)).cast("long")]


RESULT = "rule string, kind string, severity string, passed_records long, failed_records long, total long, score double, threshold double, passed boolean, details string"


def validate(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """DQ01-DQ05, DQ07, DQ08, DQ11: a row per enabled rule, from one aggregate over df, then unpivoted.

    score = passed / total; failed_records = total - passed. Empty data fails every rule."""
    rules = [r for r in rules if r.enabled]
    for r in rules:
        for c in r.columns:
            if c not in df.columns:
                raise ValueError(f"Column not found: {c}")
    if not rules:
        return df.sparkSession.createDataFrame([], RESULT)
    # Outliers need mean and deviation first: one more aggregate, joined as its one row.
    z = sorted({r.columns[0] for r in rules if r.kind == "outlier"})
    if z:
        stats = df.agg(*(f(c).alias(f"_{n}_{c}") for c in z for n, f in (("m", F.avg), ("s", F.stddev))))
        df = df.join(F.broadcast(stats)).withColumns({f"_z_{c}": F.try_divide(F.col(c) - F.col(f"_m_{c}"), F.col(f"_s_{c}")) for c in z})
    found = df.agg(*(a.alias(f"{n}{k}") for k, r in enumerate(rules) for n, a in zip("pt", _aggregates(r), strict=True)))
    return _results(found, rules)


def _results(found: DataFrame, rules: list[Rule]) -> DataFrame:
    """One row (p0, t0, p1, t1, ...) as a row per rule."""
    rows = F.array(*(
        F.struct(
            F.lit(r.name).alias("rule"), F.lit(r.kind).alias("kind"), F.lit(r.severity).alias("severity"),
            F.col(f"p{k}").alias("passed_records"), F.col(f"t{k}").alias("total"), F.lit(float(1.0 if r.threshold is None else r.threshold)).alias("threshold"),
        )
        for k, r in enumerate(rules)
    ))
    out = found.select(F.inline(rows))
    score = F.coalesce(F.try_divide(F.col("passed_records").cast("double"), F.col("total")), F.lit(0.0))
    return out.select(
        "rule", "kind", "severity", "passed_records", (F.col("total") - F.col("passed_records")).alias("failed_records"), "total",
        score.alias("score"), "threshold", ((score >= F.col("threshold")) & (F.col("total") > 0)).alias("passed"),
        F.when(F.col("total") == 0, "Dataset is empty").otherwise("").alias("details"),
    )


#: Parameters of the sketches that merge: of distinct values 2**16 registers (relative error 0.5 %), of quantiles k = 800 (rank error 0.4 %).
DISTINCT_LG, QUANTILE_K = 16, 800


def state_of(df: DataFrame, rules: list[Rule], exact: bool = True) -> dict[str, DataFrame]:
    """STR05, DQ12: what the rules need to know of a part of the data so that parts can be judged together: "sums", one row of counts,
    maxima, moments and sketches, and, if exact, "keys<k>" for each uniqueness rule: its distinct values with their number."""
    cols, out = [F.count(F.lit(1)).alias("total")], {}
    for k, r in enumerate(x for x in rules if x.enabled):
        key, x = F.struct(*r.columns), F.col(r.columns[0])
        if r.kind == "uniqueness" and exact:
            out[f"keys{k}"] = df.groupBy(*r.columns).agg(F.count(F.lit(1)).alias("_n"))
        elif r.kind == "uniqueness":
            cols.append(F.hll_sketch_agg(F.xxhash64(F.to_json(key, {"ignoreNullFields": "false"})), DISTINCT_LG).alias(f"h{k}"))
        elif r.kind == "freshness":
            cols.append(F.max(x.cast("timestamp")).alias(f"m{k}"))
        elif r.kind == "outlier":
            v = x.cast("double")
            cols += [F.count(v).alias(f"n{k}"), F.avg(v).alias(f"a{k}"), F.var_pop(v).alias(f"v{k}"), F.kll_sketch_agg_double(v, QUANTILE_K).alias(f"q{k}")]
        else:
            cols.append(F.count_if(_row_predicate(r)).alias(f"p{k}"))
    return {"sums": df.agg(*cols)} | out


def merged_results(state: Callable[[str], DataFrame], rules: list[Rule], exact: bool = True) -> DataFrame:
    """STR05: the results of validate(), from the states of all parts; state: gives the stored frames of a name. Freshness, range,
    pattern and completeness are exact, so is uniqueness if exact; else it is estimated, and so is the share of outliers always: mean and
    deviation are exact, how many values lie within is read off the merged quantiles."""
    rules = [r for r in rules if r.enabled]
    sums = state("sums")
    means = [k for k, r in enumerate(rules) if r.kind == "outlier"]
    if means:  # the mean of all parts, next to each part's own moments
        whole = sums.agg(*(F.try_divide(F.sum(F.col(f"a{k}") * F.col(f"n{k}")), F.sum(f"n{k}")).alias(f"w{k}") for k in means))
        sums = sums.join(F.broadcast(whole))
    aggs, last = [F.sum("total").alias("total")], {}
    for k, r in enumerate(rules):
        if r.kind == "uniqueness" and not exact:
            aggs.append(F.hll_sketch_estimate(F.hll_union_agg(f"h{k}")).alias(f"d{k}"))
            last[k] = F.least(F.col(f"d{k}"), F.col("total"))
        elif r.kind == "freshness":
            aggs.append(F.max(f"m{k}").alias(f"m{k}"))
            hours = (F.lit(r.as_of).cast("timestamp").cast("double") - F.col(f"m{k}").cast("double")) / 3600
            last[k] = F.when(hours <= r.max_hours, F.col("total")).otherwise(0)
        elif r.kind == "outlier":
            squares = F.sum(F.col(f"n{k}") * (F.col(f"v{k}") + (F.col(f"a{k}") - F.col(f"w{k}")) ** 2))
            aggs += [F.sum(f"n{k}").alias(f"n{k}"), F.max(f"w{k}").alias(f"w{k}"), F.sqrt(F.try_divide(squares, F.sum(f"n{k}") - 1)).alias(f"s{k}"), F.kll_merge_agg_double(f"q{k}", QUANTILE_K).alias(f"q{k}")]
            n, w, s = F.col(f"n{k}"), F.col(f"w{k}"), F.col(f"s{k}")
            steps = F.kll_sketch_get_quantile_double(f"q{k}", F.array(*(F.lit((i + 0.5) / 1000) for i in range(1000))))
            inside = F.size(F.filter(steps, lambda x: F.abs(x - w) <= r.max_z * s)) / 1000  # noqa: B023  a thousandth of the values each; called at once
            last[k] = F.when((n < 2) | (s == 0), F.col("total")).otherwise(F.col("total") - n + F.round(inside * n).cast("long"))
        elif r.kind != "uniqueness":
            aggs.append(F.sum(f"p{k}").alias(f"p{k}"))
            last[k] = F.col(f"p{k}")
    found = sums.agg(*aggs)
    for k, r in enumerate(rules):
        if r.kind == "uniqueness" and exact:
            found = found.join(F.broadcast(state(f"keys{k}").groupBy(*r.columns).agg(F.lit(1).alias("_one")).agg(F.count(F.lit(1)).alias(f"d{k}"))))
            last[k] = F.col(f"d{k}")
    total = F.coalesce("total", F.lit(0)).cast("long")
    each = [F.coalesce(last[k], F.lit(0)).cast("long").alias(f"p{k}") for k in range(len(rules))]
    return _results(found.select(*each, *(total.alias(f"t{k}") for k in range(len(rules)))), rules)


def enforce(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """DQ08, fail fast: raises QualityError if a rule of severity error fails; the results otherwise. Reads one row a rule."""
    out = validate(df, rules)
    rows = out.collect()
    failed = [r["rule"] for r in rows if not r["passed"] and r["severity"] == "error"]
    if failed:
        raise QualityError(f"Data quality validation failed: {', '.join(failed)}")
    return df.sparkSession.createDataFrame(rows, RESULT) if rows else out


def summary(results: DataFrame) -> DataFrame:
    """DQ09: the mean score and the numbers of rules, in one row."""
    return results.agg(F.avg("score").alias("overall_score"), F.count(F.lit(1)).alias("total_rules"), F.count_if("passed").alias("passed_rules"), F.count_if(~F.col("passed")).alias("failed_rules"))


def score_history(results: DataFrame, dataset: str, as_of: str) -> DataFrame:
    """DQ12: rows to append to a history table."""
    return results.select(F.lit(dataset).alias("dataset"), "rule", "score", "passed", F.lit(as_of).cast("timestamp").alias("recorded_at"))


def check_schema(df: DataFrame, expected: list[tuple[str, str | None]]) -> dict:
    """DQ06: missing and extra columns, columns of another type, and matched / expected. Reads no data."""
    have = dict(df.dtypes)
    missing = [n for n, _ in expected if n not in have]
    wrong = [n for n, t in expected if n in have and t is not None and have[n] != t]
    extra = [n for n in have if n not in {n for n, _ in expected}]
    matched = len(expected) - len(missing) - len(wrong)
    return {"missing": missing, "extra": extra, "wrong_type": wrong, "score": matched / len(expected) if expected else 1.0, "passed": not missing and not wrong}


def profile(df: DataFrame, exact_distinct: bool = False) -> DataFrame:
    """DQ10: a row per column: type, nulls, completeness, min, max, mean, standard deviation, distinct values, cardinality.

    One aggregate over all columns. Distinct counts are approximate (HyperLogLog++) unless exact is asked for, which plans an
    expansion of the rows by column. Rows are then spread over tasks first, as a task holds the distinct values of what it reads."""
    df = df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))) if exact_distinct else df
    distinct = F.count_distinct if exact_distinct else F.approx_count_distinct
    numeric = {f.name for f in df.schema if isinstance(f.dataType, T.NumericType)}
    aggs, parts = [], []
    for k, (name, kind) in enumerate(df.dtypes):
        x = F.col(f"`{name}`")
        number = x.cast("double") if name in numeric else F.lit(None).cast("double")
        aggs += [F.count(x).alias(f"c{k}"), F.min(x).cast("string").alias(f"l{k}"), F.max(x).cast("string").alias(f"h{k}"), F.avg(number).alias(f"m{k}"), F.stddev(number).alias(f"s{k}"), distinct(x).alias(f"d{k}")]
        parts.append(F.struct(F.lit(name).alias("column"), F.lit(kind).alias("type"), *(F.col(f"{a}{k}").alias(b) for a, b in (("c", "non_null"), ("l", "min"), ("h", "max"), ("m", "mean"), ("s", "stddev"), ("d", "distinct")))))
    one = df.agg(F.count(F.lit(1)).alias("n"), *aggs)
    return one.select("n", F.inline(F.array(*parts))).select(
        "column", "type", F.col("n").alias("total"), (F.col("n") - F.col("non_null")).alias("nulls"), F.coalesce(F.try_divide(F.col("non_null").cast("double"), F.col("n")), F.lit(0.0)).alias("completeness"),
        "min", "max", "mean", "stddev", "distinct", F.coalesce(F.try_divide(F.col("distinct").cast("double"), F.col("n")), F.lit(0.0)).alias("cardinality"),
    )


def quarantine(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """DQ13: df with violations, the names of the row rules (completeness, range, pattern) that a row breaks."""
    rows = [r for r in rules if r.enabled and r.kind in ("completeness", "range", "pattern")]
    marks = [F.when(~_row_predicate(r), F.lit(r.name)) for r in rows]
    return df.withColumn("violations", F.array_compact(F.array(*marks)) if marks else F.array().cast("array<string>"))
