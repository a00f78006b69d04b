"""Mapping free-entered values to a canonical list (problem 1).

A prefix-filter set-similarity join over the distinct values. Names become sets of character bigrams and trigrams,
ordered by global rarity; only the rare prefix of each set is joined, length and positional filters thin the
candidates, the Jaccard similarity is then computed exactly and the best entry is kept. As only the best counts, the
join is made for a high threshold first, whose prefixes are short and rare, and again for lower ones with the values
that have found nothing; the result is that of the lowest threshold.

Words that stand beside the names of several entries ("n. 1 ...", "... esterno") say nothing of the entry meant; they
are found in the values themselves and left out. An exact check follows: a word that only the entry kept has must show
in the value, whole, shortened or with its letters in disorder, else the value means no entry (0).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boardloom.plans.work import durable, join_small, spread

#: Thresholds of the joins, the last of which is the least Jaccard similarity of a match.
JACCARD = (0.8, 0.55, 0.3)
#: A word is left out if it stands beside so many entries' names.
BESIDE = 3
#: From this similarity on a match needs no check; letters of a word that must show in some stretch of the value as long as it.
SURE, SHOWN = 0.8, 0.7
_ACCENTS = "àáâäãåèéêëìíîïòóôöõùúûüçñ"
_PLAIN = "aaaaaaeeeeiiiiooooouuuucn"
_KEY = ["field", "text"]


def name_words(c: Column) -> Column:
    """Words without case and accents; letters joined by dots are one word."""
    low = F.translate(F.lower(c), _ACCENTS, _PLAIN)
    found = F.regexp_extract_all(low, F.lit(r"[\p{L}\p{N}]+(?:\.[\p{L}\p{N}]+)*"), F.lit(0))
    return F.transform(found, lambda w: F.replace(w, F.lit("."), F.lit("")))


def grams(c: Column) -> Column:
    """Distinct character bigrams and trigrams of a text; one character is a gram of its own."""
    # a look-ahead matches at every place, so the grams overlap
    pairs, threes = (F.regexp_extract_all(c, F.lit(f"(?s)(?=({'.' * n}))"), F.lit(1)) for n in (2, 3))
    return F.when(F.length(c) > 1, F.array_distinct(F.concat(pairs, threes))).otherwise(F.filter(F.array(c), lambda g: g != ""))


def framing_words(values: DataFrame, names: DataFrame) -> DataFrame:
    """(k): field and word of the words that stand beside at least BESIDE entries' names in some value; words of names are none.

    `values` has field and words, `names` field, item_id and words.
    """
    longest = names.agg(F.max(F.size("words"))).head()[0] or 0
    n = F.size("words")
    starts = F.sequence(F.lit(1), F.greatest(n, F.lit(1)))
    spans = F.flatten(F.transform(starts, lambda a: F.transform(F.sequence(F.lit(1), F.lit(max(longest, 1))), lambda size: F.struct(a.alias("a"), size.alias("size")))))
    inside = F.filter(spans, lambda x: (x["a"] + x["size"] <= n + 1) & (x["size"] < n))
    parts = values.where((n > 1)).select("field", "words", F.explode(inside).alias("s"))
    keyed = parts.withColumn("k", F.concat_ws("\u0001", "field", F.array_join(F.slice("words", F.col("s.a"), F.col("s.size")), " ")))
    whole = names.select(F.concat_ws("\u0001", "field", F.array_join("words", " ")).alias("k"), "item_id").distinct()
    rest = F.filter("words", lambda w, i: (i + 1 < F.col("s.a")) | (i + 1 >= F.col("s.a") + F.col("s.size")))
    beside = join_small(keyed, whole, "k").select("item_id", F.explode(F.transform(rest, lambda w: F.concat_ws("\u0001", F.col("field"), w))).alias("k"))
    common = beside.groupBy("k").agg(F.count_distinct("item_id").alias("entries")).where(F.col("entries") >= BESIDE).select("k")
    return common.join(names.select(F.explode(F.transform("words", lambda w: F.concat_ws("\u0001", F.col("field"), w))).alias("k")), "k", "left_anti")


def _ordered(sets: DataFrame, rarity: DataFrame, key: list[str]) -> DataFrame:
    """The key with its grams from rare to frequent."""
    tokens = join_small(sets.select(*key, F.explode("grams").alias("token")), rarity, "token")
    return tokens.groupBy(*key).agg(F.transform(F.sort_array(F.collect_list(F.struct("seen", "token"))), lambda x: x["token"]).alias("grams"))


def ordered_sets(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides with their grams in the order of global rarity; `left` has field and text, `right` field, item_id and text."""
    a, b = durable(left.withColumn("grams", grams(F.col("text")))), right.withColumn("grams", grams(F.col("text")))
    every = a.select(F.explode("grams").alias("token")).unionAll(b.select(F.explode("grams").alias("token")))
    rarity = durable(every.groupBy("token").agg(F.count("*").alias("seen")))
    return durable(_ordered(a, rarity, _KEY)), durable(_ordered(b, rarity, ["field", "item_id", "text"]))


def candidates(a: DataFrame, b: DataFrame, least: float) -> DataFrame:
    """(field, text, item_id, name, grams, others): pairs that the prefix, length and positional filters for Jaccard >= `least` leave, each once.

    Sides are as ordered_sets() gives them; `grams` and `others` are the whole sets of both.
    """
    n, m, pos, at = F.col("n"), F.col("m"), F.col("pos") + 1, F.col("at") + 1

    def prefix(size: str, grams: str) -> Column:
        return F.slice(grams, 1, F.col(size) - F.ceil(F.col(size) * least - 1e-9).cast("int") + 1)

    left = a.withColumn("n", F.size("grams")).select("*", F.posexplode(prefix("n", "grams")).alias("pos", "token"))
    right = b.select("field", "item_id", F.col("text").alias("name"), F.col("grams").alias("others"), F.size("grams").alias("m"))
    right = right.select("*", F.posexplode(prefix("m", "others")).alias("at", "token"))
    left, right = (x.withColumn("k", F.concat_ws("\u0001", "field", "token")).drop("token") for x in (left, right))
    pairs = join_small(left, right.drop("field"), "k").where((m >= n * least - 1e-9) & (n >= m * least - 1e-9))
    # grams before this one and itself, at most as many as on either side, and those after it
    most = F.least(pos, at) + F.least(n - pos, m - at)
    near = pairs.where(most >= F.ceil((n + m) * (least / (1 + least)) - 1e-9))
    # a pair meets at each gram of both prefixes; it counts at the first
    first = F.get(F.array_intersect(F.slice("grams", 1, pos), F.slice("others", 1, at)), F.lit(0)) == F.get("grams", F.col("pos"))
    return near.where(first).select(*_KEY, "item_id", "name", "grams", "others")


def similar(a: DataFrame, b: DataFrame, least: float) -> DataFrame:
    """(field, text, item_id, name, jaccard): the pairs of at least `least`; sides as ordered_sets() gives them."""
    both = F.size(F.array_intersect("grams", "others"))
    scored = candidates(a, b, least).withColumn("jaccard", both / (F.size("grams") + F.size("others") - both))
    return scored.where(F.col("jaccard") >= least - 1e-9).select(*_KEY, "item_id", "name", "jaccard")


def best_entries(a: DataFrame, b: DataFrame) -> DataFrame:
    """(field, text, item_id, name, jaccard): the most similar entry of each text that has one; ties go to the smaller item_id."""
    found, left = None, a
    for least in JACCARD:
        order = F.struct(F.round("jaccard", 9).alias("jaccard"), (-F.col("item_id")).alias("minus"), "name")
        best = durable(similar(left, b, least).groupBy(*_KEY).agg(F.max(order).alias("best")))
        found = best if found is None else found.unionByName(best)
        left = a.join(found.select(*_KEY), _KEY, "left_anti")
    return found.select(*_KEY, (-F.col("best.minus")).alias("item_id"), "best.name", "best.jaccard")


def shows(word: str, typed: list[str]) -> bool:
    """Whether `word` is in the typed words: shortened to three letters or more, or by its letters in a stretch of its length."""
    if any(len(x) > 2 and word.startswith(x) for x in typed):
        return True
    text, n, want = "".join(typed), len(word), Counter(word)
    seen = Counter(text[:n])
    shared = (seen & want).total()
    for i in range(n, len(text)):
        if shared >= SHOWN * n:
            break
        new, old = text[i], text[i - n]
        seen[new] += 1
        shared += seen[new] <= want[new]
        shared -= seen[old] <= want[old]
        seen[old] -= 1
    return shared >= SHOWN * n


def _meant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = zip(batch.column("words").to_pylist(), batch.column("own").to_pylist(), batch.column("jaccard").to_pylist(), strict=True)
        keep = pa.array([j >= SURE or all(shows(w, typed) for w in own or ()) for typed, own, j in rows], pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column(c).filter(keep) for c in ("field", "text", "item_id")], names=["field", "text", "item_id"])


def map_values(values: DataFrame, reference: DataFrame) -> DataFrame:
    """(field, value, item_id) of every distinct (field, value); item_id 0 where no entry is meant.

    `reference` has item_id, field, label and alias; both names of an entry count. Defined cases: values
    without letters or digits mean nothing (0); ties go to the smaller item_id; an empty list maps everything to 0; NULL
    values have to be dropped before; values of any length are compared whole.
    """
    listed = F.explode(F.filter(F.array("label", "alias"), lambda n: n.isNotNull() & (n != "")))
    names = reference.select("field", "item_id", listed.alias("name")).distinct().select("field", "item_id", name_words(F.col("name")).alias("words"))
    names = durable(names.where(F.size("words") > 0).distinct())
    typed = durable(values.select("field", "value", name_words(F.col("value")).alias("words")))
    framing = durable(framing_words(typed.where(F.size("words") > 0), names).distinct())
    told = typed.select("field", "value", F.posexplode("words").alias("pos", "word")).withColumn("k", F.concat_ws("\u0001", "field", "word"))
    less = join_small(told, framing, "k", "left_anti").groupBy("field", "value").agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "word"))), lambda x: x["word"]).alias("kept"))
    # a value of such words alone is compared as it is
    bare = typed.join(less, ["field", "value"], "left").select("field", "value", F.coalesce("kept", "words").alias("words"))
    bare = durable(bare.withColumn("text", F.array_join("words", "")))
    texts = bare.where("text != ''").groupBy(*_KEY).agg(F.min("words").alias("words"))
    named = names.select("field", "item_id", F.array_join("words", "").alias("text")).distinct()
    best = best_entries(*ordered_sets(texts.select(*_KEY), named))
    words = names.select("field", "item_id", F.array_join("words", "").alias("name"), F.explode("words").alias("w"))
    only = words.groupBy("field", "w").agg(F.count_distinct("item_id").alias("n")).where("n = 1 AND length(w) > 3")
    own = words.join(only, ["field", "w"]).groupBy(F.concat_ws("\u0001", "field", "item_id", "name").alias("k")).agg(F.collect_set("w").alias("own"))
    checked = join_small(best.withColumn("k", F.concat_ws("\u0001", "field", "item_id", "name")), own, "k", "left").join(texts, _KEY)
    meant = checked.select("field", "text", "item_id", "words", "own", "jaccard").mapInArrow(_meant, "field string, text string, item_id bigint")
    return bare.join(meant, _KEY, "left").select("field", "value", F.coalesce("item_id", F.lit(0)).cast("bigint").alias("item_id"))


def typed_values(findings: DataFrame, reference: DataFrame) -> DataFrame:
    """(row_id, field, value): the values of profilo and category that are neither empty nor a label of their field."""
    fields = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in ("profilo", "category")])
    long = spread(findings.select("row_id", "profilo", "category")).select("row_id", F.explode(fields).alias("v")).select("row_id", "v.field", "v.value").where("value IS NOT NULL AND value != ''")
    labels = reference.select("field", F.col("label").alias("value")).distinct().withColumn("k", F.concat_ws("\u0001", "field", "value")).select("k", F.lit(True).alias("label"))
    keyed = join_small(long.withColumn("k", F.concat_ws("\u0001", "field", "value")), labels, "k", "left")
    return keyed.where("label IS NULL").select("row_id", "field", "value", "k")


def canonical_findings(findings: DataFrame, reference: DataFrame) -> DataFrame:
    """(row_id, field, value, item_id) of every typed value of findings (see map_values)."""
    typed = typed_values(findings, reference)
    mapped = durable(map_values(typed.select("field", "value").distinct(), reference)).withColumn("k", F.concat_ws("\u0001", "field", "value"))
    return join_small(typed, mapped.select("k", "item_id"), "k", max_rows=200_000).select("row_id", "field", "value", "item_id")


def unmatched(findings: DataFrame, reference: DataFrame) -> DataFrame:
    """(field, value, rows): the report of the values that mean no entry."""
    return canonical_findings(findings, reference).where("item_id = 0").groupBy("field", "value").agg(F.count("*").alias("rows"))
