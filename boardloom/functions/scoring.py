"""Scoring of titles and bodies with a rule pack.

The work is staged over projections: normal forms first, then one array of hits per tier, then the sums. Every
pattern is so evaluated once a row; a single nested expression would normalise the text anew for each pattern.
"""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boardloom.functions.rules import RulePack
from boardloom.functions.text import normalized

_FLAGS = "(?Ud)"


def _hits(text: Column, patterns: tuple[str, ...], hint: str | None = None) -> Column:
    """array<boolean>: which patterns occur; all false without a look where the hint doesn't."""
    found = F.array(*[text.rlike(_FLAGS + p) for p in patterns])
    none = F.array_repeat(F.lit(False), len(patterns))
    return F.when(text.rlike(hint), found).otherwise(none) if hint else found


def _first(hits: Column, names: tuple[str, ...]) -> Column:
    """Name of the first hit, NULL without one."""
    return F.get(F.array(*map(F.lit, names)), F.array_position(hits, True).cast("int") - 1) if names else F.lit(None).cast("string")


def _named(hits: Column, names: tuple[str, ...], mark: str = "") -> Column:
    pairs = F.arrays_zip(hits.alias("h"), F.array(*[F.lit(mark + n) for n in names]).alias("n"))
    return F.transform(F.filter(pairs, lambda x: x["h"]), lambda x: x["n"])


def _kept(df: DataFrame, condition: Column) -> DataFrame:
    """The rows that fulfil a condition on columns of the last stage.

    A plain filter would be pushed below the stages, with the normal forms written out for every pattern in it; a
    column that isn't deterministic keeps it above them.
    """
    return df.withColumn("__row", F.monotonically_increasing_id()).where(condition & (F.col("__row") >= 0)).drop("__row")


def classify(df: DataFrame, text: Column, title: Column, pack: RulePack, threshold: float = 0.45, veto: bool = True, require_strong: bool = False, out: str = "c", only: bool = False) -> DataFrame:
    """df with struct `out`: is_match, score, category, signals, title_hit.

    The weights are added in the pack's order, as doubles, and clamped to 0..1 at the end. A match needs the
    threshold (on the unrounded score), no veto where `veto`, and a strong rule where `require_strong`.
    Patterns are looked for in title and text joined by a space. NULL texts are empty texts. With `only`, rows that
    don't match leave; most of them after the first tiers, since weak rules alone don't reach the threshold.
    """
    d = df.withColumns({"__head": normalized(title), "__body": normalized(text)}).withColumn("__hay", F.concat("__head", F.lit(" "), "__body"))
    head, hay = F.col("__head"), F.col("__hay")
    first = {"__strong": _hits(hay, pack.strong, pack.hints.get("strong")), "__medium": _hits(hay, pack.medium, pack.hints.get("medium"))}
    tiers = {} if only else first
    if only:
        need = ("__strong",) if require_strong else ("__strong", "__medium") if pack.weak_weight[0] * pack.weak_weight[1] < threshold else ()
        tiers = {n: c for n, c in first.items() if n not in need}
        hit = [F.exists(n, lambda x: x) for n in need]
        no_veto = [~reduce(or_, [hay.rlike(_FLAGS + p) for p in pack.vetoes])] if veto and pack.vetoes else []
        d = _kept(d.withColumns({n: first[n] for n in need}), reduce(and_, [*([reduce(or_, hit)] if hit else []), *no_veto, F.lit(True)]))
        veto = False  # looked for already
    tiers |= {
        "__strong_up": _hits(head, pack.strong, pack.hints.get("strong")),
        "__medium_up": _hits(head, pack.medium, pack.hints.get("medium")),
        "__weak": _hits(hay, pack.weak),
        "__guard": _hits(hay, pack.guards),
        "__cat": F.coalesce(*[F.when(hay.rlike(_FLAGS + "(?:" + "|".join(ps) + ")"), n) for n, ps in pack.categories], F.lit(pack.otherwise)),
    }
    if veto:
        tiers["__veto"] = _hits(hay, pack.vetoes)
    d = d.withColumns(tiers)

    def weighed(at: str, up: str, weights: tuple[float, float]) -> Column:
        pairs = F.arrays_zip(F.col(at).alias("a"), F.col(up).alias("u"))
        parts = F.transform(pairs, lambda x: F.array(F.when(x["a"], weights[0]).otherwise(0.0), F.when(x["a"] & x["u"], weights[1]).otherwise(0.0)))
        return F.flatten(parts)

    weak = F.size(F.filter("__weak", lambda x: x))
    lift = F.array(F.least(weak, F.lit(pack.weak_weight[1])) * F.lit(pack.weak_weight[0]))
    guards = F.transform("__guard", lambda x: F.when(x, -pack.guard_weight).otherwise(0.0))
    steps = F.concat(weighed("__strong", "__strong_up", pack.strong_weight), weighed("__medium", "__medium_up", pack.medium_weight), lift, guards)
    total = F.aggregate(steps, F.lit(0.0), lambda acc, x: acc + x)
    d = d.withColumn("__score", F.greatest(F.lit(0.0), F.least(total, F.lit(1.0))))
    first_veto = _first(F.col("__veto"), pack.vetoes) if veto else F.lit(None).cast("string")
    match = (F.col("__score") >= threshold) & first_veto.isNull()
    if require_strong:
        match = match & F.exists("__strong", lambda x: x)
    up = F.exists(F.arrays_zip("__strong", "__strong_up"), lambda x: x["__strong"] & x["__strong_up"]) | F.exists(F.arrays_zip("__medium", "__medium_up"), lambda x: x["__medium"] & x["__medium_up"])
    signals = F.concat(_named(F.col("__strong"), pack.strong), _named(F.col("__medium"), pack.medium), _named(F.col("__guard"), pack.guards, "-"), F.when(first_veto.isNotNull(), F.array(F.concat(F.lit("VETO:"), first_veto))).otherwise(F.array().cast("array<string>")))
    told = F.struct(match.alias("is_match"), F.round("__score", 3).alias("score"), F.col("__cat").alias("category"), signals.alias("signals"), up.alias("title_hit"))
    d = d.select(*df.columns, told.alias(out))
    return _kept(d, F.col(out).is_match) if only else d
