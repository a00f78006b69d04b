"""Subject areas of documents (problem 9).

Normalised document vectors of all documents, labelled or not, are clustered by bisecting k-means. Beyond CLUSTERED
documents, parts of this size are first clustered apart, into small clusters that keep the sums and numbers of their
documents; these are merged in the same way until the rest is bisected, and the centroids are the means over all
documents. The leaves are labelled by their discriminative terms, that is by the subjects for which these terms speak; a
leaf whose terms speak for none has no subject. A document is a mixture of leaves, made from its passages, and gets each subject whose
leaves hold enough of the mixture.

What a word tells is learned from all labelled documents, counted by the tasks, and weighs the vectors; how
rare it is comes from all documents. Words that frame passing mentions and menus are learned too: where they stand, the subject named is often none of the document's, so passages with them don't count.
"""

from __future__ import annotations

import html
import math
import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boardloom.plans.work import join_small, spread, stored, work_folder

#: Documents that are clustered at once, parts whose small clusters are merged at once, small clusters for each leaf.
CLUSTERED, MERGED, SMALL = 20_000, 8, 2
#: A term is used if it tells at least so much and stands in so many labelled documents.
TELLS, SEEN = 0.1, 1.5
#: Leaves, at least and for each subject. A leaf speaks if its best subject has so much of what lies above an equal share.
LEAVES, LEAVES_EACH, SPEAKS = 96, 8, 0.2
SEED = 11
#: Passages judged at once; bounds the memory that very long documents and batches take.
BLOCK = 2_048
#: A passage counts if its best term tells so much (1: the subject for sure), fully from SURE on; a subject needs LEAST mass and share.
TOLD, SURE, LEAST = 0.195, 0.52, (1.1, 0.18)
# words, and the ends of sentences, items and menu entries
_PIECE = re.compile(r"[^\W\d_]{3,}|[.;:!?…](?=\s)|\n(?=\s*\n|[^\sa-zà-ÿ0-9])|[|»·>](?=\s)|\t")
# Letters that scanned text shows as digits.
_DIGIT_LETTERS = re.compile(r"[01](?<=[^\W\d_].)(?=[^\W\d_])|0(?<=[^\W\d_]{2}.)\b")
_TAGS = re.compile(r"<[^<>]{1,200}>")
_HYPHEN = re.compile(r"-\n(?=[^\W\d_])")
_GONE = re.compile("[­​‌‍﻿]")


def passages(text: str) -> list[list[str]]:
    """Words of each sentence, item or menu entry of a text."""
    text = html.unescape(text) if "&" in text else text
    text = _TAGS.sub(" ", text) if "<" in text else text
    text = unicodedata.normalize("NFKC", _GONE.sub("", text))
    text = _HYPHEN.sub("", text) if "-\n" in text else text
    text = _DIGIT_LETTERS.sub(lambda m: "o" if m.group() == "0" else "l", text)
    found, words = [], []
    for piece in "\0".join(_PIECE.findall(text)).lower().split("\0"):
        if len(piece) > 1:
            words.append(piece)
        elif words:
            found.append(words if len(words) > 2 else [*words, "<short>"])
            words = []
    if words:
        found.append(words if len(words) > 2 else [*words, "<short>"])
    return found


def terms(words: list[str]) -> list[str]:
    """Words and pairs of neighbouring words."""
    return words + [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]


def _shares(like: np.ndarray) -> np.ndarray:
    """Shares of the leaves from likenesses to their centroids."""
    like = np.maximum(like, 0) ** 2
    return like / (like.sum(axis=-1, keepdims=True) + 1e-9)


def _add(sums: np.ndarray, at: np.ndarray, values: np.ndarray) -> None:
    """Add rows of values to the rows `at` of sums; equal ones stand together."""
    starts = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    sums[at[starts]] += np.add.reduceat(values, starts)


@dataclass
class Rows:
    """Sparse unit vectors, one after the other: terms and values of row i lie in ptr[i]:ptr[i + 1]; no row is empty."""

    ids: np.ndarray
    values: np.ndarray
    ptr: np.ndarray
    width: int

    @staticmethod
    def of(vectors: list[tuple[np.ndarray, np.ndarray]], width: int) -> Rows:
        ids = np.concatenate([np.zeros(0, np.int32), *(i for i, _ in vectors)])
        return Rows(ids, np.concatenate([np.zeros(0, np.float32), *(v for _, v in vectors)]), np.cumsum([0, *(len(i) for i, _ in vectors)]), width)

    def __len__(self) -> int:
        return len(self.ptr) - 1

    def __getitem__(self, rows: int | np.ndarray) -> np.ndarray | Rows:
        if np.ndim(rows) == 0:
            at, out = slice(self.ptr[rows], self.ptr[rows + 1]), np.zeros(self.width)
            out[self.ids[at]] = self.values[at]
            return out
        rows = np.flatnonzero(rows) if rows.dtype == bool else rows
        sizes = np.diff(self.ptr)[rows]
        ptr = np.concatenate([[0], np.cumsum(sizes)])
        at = np.repeat(self.ptr[rows] - ptr[:-1], sizes) + np.arange(ptr[-1])
        return Rows(self.ids[at], self.values[at], ptr, self.width)

    def __matmul__(self, other: np.ndarray) -> np.ndarray:
        return np.add.reduceat(self.values * other[self.ids], self.ptr[:-1])

    def mean(self, axis: int = 0) -> np.ndarray:
        return np.bincount(self.ids, self.values, self.width) / len(self)


@dataclass
class Model:
    """What is shipped to the tasks: term numbers, leaf centroids and the leaves' subjects."""

    subjects: list[str]
    number: dict[str, int]
    weight: np.ndarray
    tells: np.ndarray
    speaks: np.ndarray
    trust: dict[str, float] = field(default_factory=dict)
    least: tuple[float, float] = LEAST

    def __post_init__(self) -> None:
        self._derive()
        self.set_leaves(np.zeros((0, len(self.number))), np.zeros(0, np.int64))

    def __getstate__(self) -> dict:
        """What tasks need; the rest is made of it there."""
        return {k: v for k, v in self.__dict__.items() if k not in ("telling", "leading", "by_term", "pull", "leaf_terms", "members", "speaks")}

    def __setstate__(self, told: dict) -> None:
        self.__dict__.update(told)
        self._derive()
        self._turn()

    def reader(self) -> Model:
        """The model without leaves, for tasks that only turn texts into terms."""
        return replace(self)

    def _derive(self) -> None:
        self.telling = self.tells.tolist()
        self.leading = {t.partition(" ")[0] for t in self.number if " " in t}  # words that begin a known pair

    def _turn(self) -> None:
        """Rows of a term's weights lie together."""
        self.by_term = np.ascontiguousarray(self.centroids.T)
        self.pull = (self.by_term * self.weight[:, None]).astype(np.float32)

    def set_leaves(self, sums: np.ndarray, members: np.ndarray) -> None:
        """Take the leaves from the sums of their documents' vectors; their discriminative terms label them."""
        self.members = members
        means = sums / np.maximum(members, 1)[:, None]
        self.centroids = means / (np.linalg.norm(means, axis=1, keepdims=True) + 1e-9)
        self.centroids = self.centroids.astype(np.float32)
        self._turn()
        above = means - sums.sum(axis=0) / max(members.sum(), 1)
        top = np.argsort(-above, axis=1, kind="stable")[:, :24]
        names = list(self.number)
        self.leaf_terms = [[names[i] for i in own[:8]] for own in top]
        votes = (np.take_along_axis(above, top, 1)[:, :, None].clip(0) * self.speaks[top]).sum(axis=1)
        votes /= votes.sum(axis=1, keepdims=True) + 1e-9
        equal = 1 / max(len(self.subjects), 1)
        votes[votes.max(axis=1, initial=0) < equal + SPEAKS * (1 - equal)] = 0
        self.leaf_subject = votes

    def vector(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Terms and values of a text's unit vector; None where it has no known term."""
        counts = Counter(i for words in passages(text) for i in self.ids_of(words))
        ids = np.fromiter(counts, np.int32, len(counts))
        values = self.weight[ids] * (1 + np.log(np.fromiter(counts.values(), np.float64, len(counts))))
        size = np.linalg.norm(values)
        return (ids, (values / size).astype(np.float32)) if size > 0 else None

    def ids_of(self, words: list[str]) -> list[int]:
        """Numbers of the known words and pairs."""
        number, leading = self.number, self.leading
        found = [i for w in words if (i := number.get(w)) is not None]
        found += [i for a, b in zip(words, words[1:], strict=False) if a in leading and (i := number.get(f"{a} {b}")) is not None]
        return found

    def parsed(self, text: str | None) -> tuple[list[int], list[int], list[float]]:
        """Known terms of a text passage by passage, the terms of each passage, and how much it tells (0: it doesn't count)."""
        every, sizes, told = [], [], []
        for words in passages(text) if text and not text.isspace() else ():
            ids = self.ids_of(words)
            if ids:
                most = max([self.telling[i] for i in ids])
                every += ids
                sizes.append(len(ids))
                told.append(0.0 if most < TOLD or any(w in self.trust for w in words) else min(1.0, most / SURE))
        return every, sizes, told

    def leaves_like(self, ids: np.ndarray, sizes: np.ndarray) -> Iterator[np.ndarray]:
        """Likeness of passages to the leaves, a block at a time."""
        starts = np.concatenate([[0], np.cumsum(sizes)])
        for at in range(0, len(sizes), BLOCK):
            end = min(at + BLOCK, len(sizes))
            yield np.add.reduceat(self.pull[ids[starts[at] : starts[end]]], starts[at:end] - starts[at])

    def masses(self, ids: np.ndarray, sizes: np.ndarray, told: np.ndarray, owner: np.ndarray, count: int) -> np.ndarray:
        """Mass of each leaf over the passages of each of `count` texts; `owner` is the text of each passage, in order."""
        leaves = np.zeros((count, len(self.centroids)))
        counts = told > 0
        ids, sizes, told, owner = ids[np.repeat(counts, sizes)], sizes[counts], told[counts], owner[counts]
        if not len(sizes) or not len(self.centroids):
            return leaves
        # what the whole document is about resolves words of several leaves
        whole, done = np.zeros_like(leaves), 0
        for like in self.leaves_like(ids, sizes):
            _add(whole, owner[done : done + len(like)], like)
            done += len(like)
        prior, done = np.sqrt(0.05 + _shares(whole)), 0
        for like in self.leaves_like(ids, sizes):
            own = owner[done : done + len(like)]
            _add(leaves, own, _shares(like * prior[own]) * told[done : done + len(like), None])
            done += len(like)
        return leaves

    def mixture(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Mass of each subject and of each leaf over the passages of a text."""
        ids, sizes, told = self.parsed(text)
        leaves = self.masses(np.array(ids, np.int64), np.array(sizes, np.int64), np.array(told), np.zeros(len(sizes), np.int64), 1)[0]
        return leaves @ self.leaf_subject, leaves

    def enough(self, mass: np.ndarray) -> np.ndarray:
        """Which subjects texts with these masses are about."""
        return (mass >= self.least[0]) & (mass >= self.least[1] * mass.sum(axis=-1, keepdims=True))

    def subjects_of(self, text: str) -> list[str]:
        """The subjects a text is about."""
        return [self.subjects[i] for i in np.flatnonzero(self.enough(self.mixture(text)[0]))]


def bisect(x: np.ndarray | Rows, leaves: int, seed: int = SEED, rounds: int = 12, weight: np.ndarray | None = None) -> np.ndarray:
    """Leaf number of each row by bisecting k-means on unit vectors; the widest leaf is split next.

    With `weight`, each row is the sum of so many unit vectors, which stay together.
    """
    rng = np.random.default_rng(seed)
    mass = np.ones(len(x)) if weight is None else weight
    leaf = np.zeros(len(x), np.int64)
    spread_of = {0: np.inf}
    while len(spread_of) < leaves:
        at = max(spread_of, key=spread_of.get)
        rows = np.flatnonzero(leaf == at)
        if spread_of[at] <= 0 or mass[rows].sum() < 8 or len(rows) < 2:
            spread_of[at] = -1.0
            if max(spread_of.values()) <= 0:
                break
            continue
        part = x[rows]
        a = part[rng.integers(len(rows))]
        b = part[int((part @ a / mass[rows]).argmin())]
        if weight is not None:
            a, b = (c / (np.linalg.norm(c) + 1e-9) for c in (a, b))
        side = np.zeros(len(rows), bool)
        for _ in range(rounds):
            new = part @ b > part @ a
            if (new == side).all() and _ > 0 or new.all() or not new.any():
                break
            side = new
            a, b = (c / (np.linalg.norm(c) + 1e-9) for c in (part[~side].mean(axis=0), part[side].mean(axis=0)))
        if side.all() or not side.any():
            spread_of[at] = -1.0
            continue
        new_leaf = len(spread_of)
        leaf[rows[side]] = new_leaf
        for k, r in ((at, rows[~side]), (new_leaf, rows[side])):
            own = mass[r].sum()
            c = x[r].mean(axis=0) * (len(r) / own)
            spread_of[k] = float(own * (1 - np.linalg.norm(c))) if own >= 8 else -1.0
    return leaf


def weigh(texts: list[str], labels: list[set[str]], subjects: dict[str, str], rarity: dict[str, float]) -> Model:
    """A model without leaves: the terms of labelled texts and what they tell; `rarity` gives the idf of their words over all documents."""
    names = sorted(subjects)
    read = [passages(t) for t in texts]
    for name in names:  # a description is a labelled text
        read.append(passages(f"{subjects[name]}. {subjects[name]}"))
    labels = [*labels, *({n} for n in names)]
    index = {n: i for i, n in enumerate(names)}
    share = np.zeros((len(read), len(names)))
    for i, own in enumerate(labels):
        for s in own:
            if s in index:
                share[i, index[s]] = 1 / len(own)
    total = share.sum(axis=0) + 1
    by_term: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(len(names)))
    for i, doc in enumerate(read):
        for t in {t for p in doc for t in terms(p)}:
            by_term[t] += share[i]
    kept = sorted(by_term)
    matrix = np.array([by_term[t] for t in kept]).reshape(len(kept), len(names))
    top = np.flatnonzero(_telling(kept, matrix, total))
    return _weighted(names, [kept[i] for i in top], matrix[top], total, rarity)


def _tells(matrix: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For which subjects each term speaks, and how much it tells, from the shares of the labelled documents that have it."""
    base = total / total.sum()
    p = (matrix + base) / (matrix.sum(axis=1, keepdims=True) + 1.0)
    return p, (p * np.log(p / base)).sum(axis=1) / math.log(max(len(total), 2))


def _telling(found: list[str], matrix: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Which terms are used."""
    return (matrix.sum(axis=1) >= SEEN) & (_tells(matrix, total)[1] >= TELLS) & np.array([t != "<short>" for t in found], bool)


def _weighted(names: list[str], kept: list[str], matrix: np.ndarray, total: np.ndarray, rarity: dict[str, float]) -> Model:
    """The model of the terms that are used."""
    p, tells = _tells(matrix, total)
    number = {t: i for i, t in enumerate(kept)}
    # a pair is as rare as its rarer word; what tells most weighs most, else the leaves part languages and frames
    weight = np.array([max(rarity.get(w, 5.0) for w in t.split(" ")) for t in number]) * tells**3
    return Model(names, number, weight, tells, p)


def labelled_terms(labelled: DataFrame, names: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The terms that are used, their shares by subject and the subjects' shares, counted over all rows of (text, subjects)."""
    index = {n: i for i, n in enumerate(names)}
    total = np.ones(len(names))
    for r in labelled.select(F.explode("subjects").alias("s"), F.size("subjects").alias("own")).groupBy("s", "own").count().orderBy("s", "own").collect():
        if r["s"] in index:
            total[index[r["s"]]] += r["count"] / r["own"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def flush() -> pa.RecordBatch:
            keys = list(held)
            columns = [pa.array([k[n] for k in keys], t) for n, t in enumerate((pa.string(), pa.int32(), pa.int32()))]
            out = pa.RecordBatch.from_arrays([*columns, pa.array(list(held.values()), pa.int64())], names=["term", "subject", "own", "n"])
            held.clear()
            return out

        for batch in batches:
            for text, own in zip(batch.column("text").to_pylist(), batch.column("subjects").to_pylist(), strict=True):
                known = [index[x] for x in own if x in index]
                if known:
                    held.update((t, k, len(own)) for t in {t for p in passages(text) for t in terms(p)} for k in known)
                if len(held) > 500_000:
                    yield flush()
        if held:
            yield flush()

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column("term").to_pylist()
            matrix = np.zeros((len(found), len(names)))
            for i, own in enumerate(batch.column("held").to_pylist()):
                for x in own:
                    matrix[i, x["subject"]] += x["n"] / x["own"]
            top = np.flatnonzero(_telling(found, matrix, total))
            yield pa.RecordBatch.from_arrays([pa.array([found[i] for i in top], pa.string()), pa.array(list(matrix[top]), pa.list_(pa.float64()))], names=["term", "shares"])

    counts = labelled.select("text", "subjects").mapInArrow(count, "term string, subject int, own int, n bigint").groupBy("term", "subject", "own").agg(F.sum("n").alias("n"))
    held = counts.groupBy("term").agg(F.sort_array(F.collect_list(F.struct("subject", "own", "n"))).alias("held"))
    used = sorted((r["term"], r["shares"]) for r in held.mapInArrow(tell, "term string, shares array<double>").collect())
    return [t for t, _ in used], np.array([v for _, v in used]).reshape(len(used), len(names)), total


def _leaves(model: Model) -> int:
    return max(LEAVES, LEAVES_EACH * len(model.subjects))


def _summed(rows: Rows, leaf: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the vectors of each leaf, and how many documents it has."""
    count = int(leaf.max()) + 1 if len(leaf) else 0
    at = np.repeat(leaf, np.diff(rows.ptr)) * rows.width + rows.ids
    return np.bincount(at, rows.values, count * rows.width).reshape(count, rows.width), np.rint(np.bincount(leaf, weight, minlength=count)).astype(np.int64)


def split(model: Model, rows: Rows, weight: np.ndarray | None = None) -> None:
    """Give the model its leaves by bisecting k-means over the vectors, or over small clusters of them with their weights."""
    leaf = bisect(rows, _leaves(model), weight=weight)
    model.set_leaves(*_summed(rows, leaf, np.ones(len(leaf)) if weight is None else weight))


def _trusted(model: Model, texts: list[str], labels: list[set[str]]) -> tuple[Counter, Counter]:
    """Of each word, how many telling passages it stands in, and in how many the leaves' subject is the text's."""
    right, seen = Counter(), Counter()
    for text, own in zip(texts, labels, strict=True):
        rows = [(words, ids) for words in passages(text) if (ids := [i for i in model.ids_of(words) if model.telling[i] >= TOLD])]
        ids, sizes, done = np.array([i for _, ids in rows for i in ids], np.int64), np.array([len(ids) for _, ids in rows], np.int64), 0
        for like in model.leaves_like(ids, sizes) if len(model.centroids) else ():
            mass = _shares(like) @ model.leaf_subject
            for (words, _), best, spoken in zip(rows[done : done + len(like)], mass.argmax(axis=1), mass.sum(axis=1), strict=True):
                if spoken < 0.5:  # leaves without a subject say nothing of the words
                    continue
                ok = model.subjects[best] in own
                for w in set(words):
                    seen[w] += 1
                    right[w] += ok
            done += len(like)
    return seen, right


def learn_trust(model: Model, texts: list[str], labels: list[set[str]]) -> None:
    """Learn from labelled texts the words near which the leaves' subject is often none of the text's."""
    seen, right = _trusted(model, texts, labels)
    model.trust = {w: (right[w] + 2) / (n + 2) for w, n in seen.items() if n >= 8 and (right[w] + 2) / (n + 2) < 0.5}


def learn_trust_of(model: Model, labelled: DataFrame) -> None:
    """As learn_trust(), over all rows of (text, subjects), counted by the tasks."""
    shared = labelled.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen, right = _trusted(shared.value, batch.column("text").to_pylist(), [set(x) for x in batch.column("subjects").to_pylist()])
            words = list(seen)
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), *(pa.array([int(c[w]) for w in words], pa.int64()) for c in (seen, right))], names=["word", "n", "ok"])

    sums = labelled.select("text", "subjects").mapInArrow(run, "word string, n bigint, ok bigint").groupBy("word").agg(F.sum("n").alias("n"), F.sum("ok").alias("ok"))
    found = sums.where("n >= 8").withColumn("trust", (F.col("ok") + 2) / (F.col("n") + 2)).where("trust < 0.5").collect()
    shared.destroy()
    model.trust = {r["word"]: r["trust"] for r in found}


def fit(texts: list[str], labels: list[set[str]], subjects: dict[str, str], rarity: dict[str, float], others: list[str] | None = None) -> Model:
    """Learn the model from labelled texts and cluster these and `others`, which have no labels."""
    model = weigh(texts, labels, subjects, rarity)
    split(model, Rows.of([v for t in [*texts, *(others or [])] if (v := model.vector(t)) is not None], len(model.number)))
    learn_trust(model, texts, labels)
    return model


def rarity_of(documents: DataFrame, words: set[str]) -> dict[str, float]:
    """idf of the given words, those of the terms, counted over all documents."""
    if not words:
        return {}
    wanted = documents.sparkSession.createDataFrame([(w,) for w in sorted(words)], "word string")  # bounded by the terms
    held = documents.select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}{3,}"), F.lit(0)))).alias("word"))
    counts = {r["word"]: r["count"] for r in held.join(F.broadcast(wanted), "word").groupBy("word").count().collect()}
    total = documents.count()
    return {w: math.log((1 + total) / counts.get(w, 1)) for w in words}


def vectors(documents: DataFrame, model: Model) -> DataFrame:
    """(doc_id, ids, vals, n) of the documents with a known term, n being 1, as a table in the shared folder."""
    shared = documents.sparkSession.sparkContext.broadcast(model.reader())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.vector(t) if t else None for t in batch.column("text").to_pylist()]
            kept = pa.array([v is not None for v in found], pa.bool_())
            ids, values = (pa.array([v[k] for v in found if v is not None], pa.list_(kind)) for k, kind in ((0, pa.int32()), (1, pa.float32())))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").filter(kept), ids, values, pa.array([1] * len(ids), pa.int64())], names=["doc_id", "ids", "vals", "n"])

    kind = dict(documents.dtypes)["doc_id"]
    out = stored(documents.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids array<int>, vals array<float>, n bigint"), "vectors")
    shared.destroy()
    return out


def _merged(rows: DataFrame, leaves: int, width: int, most: int) -> DataFrame:
    """The rows (part, place, ids, vals, n) of each part, clustered into so many sums; a part of more than `most` rows in several turns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        weight: list[int] = []
        part = turn = None

        def flush() -> pa.RecordBatch:
            own, mass = Rows.of(held, width), np.array(weight, np.float64)
            ids, vals, counts = [], [], []
            leaf = bisect(own, leaves, weight=mass)
            for k in range(int(leaf.max()) + 1):
                some = own[leaf == k]
                at, back = np.unique(some.ids, return_inverse=True)
                ids.append(at.astype(np.int32))
                vals.append(np.bincount(back, some.values).astype(np.float32))
                counts.append(int(mass[leaf == k].sum()))
            size = len(ids)
            held.clear()
            weight.clear()
            columns = [pa.array([part] * size, pa.int32()), pa.array(range(turn, turn + size), pa.int64()), pa.array(ids, pa.list_(pa.int32())), pa.array(vals, pa.list_(pa.float32())), pa.array(counts, pa.int64())]
            return pa.RecordBatch.from_arrays(columns, names=["part", "place", "ids", "vals", "n"])

        for batch in batches:
            for at, ids, vals, n in zip(batch.column("part").to_pylist(), batch.column("ids"), batch.column("vals"), batch.column("n").to_pylist(), strict=True):
                if held and (at != part or len(held) >= most):
                    yield flush()
                    turn += leaves
                if at != part:
                    part, turn = at, 0
                held.append((ids.values.to_numpy(), vals.values.to_numpy()))
                weight.append(n)
        if held:
            yield flush()

    dealt = rows.repartition("part").sortWithinPartitions("part", "place")
    return stored(dealt.mapInArrow(run, "part int, place bigint, ids array<int>, vals array<float>, n bigint"), "clusters")


def cluster(documents: DataFrame, model: Model, clustered: int = CLUSTERED) -> None:
    """Give the model its leaves, from the vectors of all documents; the driver gets at most `clustered` of them, or as many small clusters as MERGED parts have."""
    rows = vectors(documents, model)
    parts = -(-rows.count() // clustered)
    order = "doc_id"
    if parts > 1:
        part = F.pmod(F.xxhash64(F.lit(SEED + 1), F.col("doc_id")), F.lit(parts)).cast("int")
        rows, order = rows.select(part.alias("part"), F.col("doc_id").alias("place"), "ids", "vals", "n"), "place"
        small = SMALL * _leaves(model)
        rows = _merged(rows, small, len(model.number), 2 * clustered)
        while parts > MERGED:
            parts = -(-parts // MERGED)
            place = F.col("part").cast("bigint") * (1 << 40) + F.col("place")
            rows = _merged(rows.select((F.col("part") / MERGED).cast("int").alias("part"), place.alias("place"), "ids", "vals", "n"), small, len(model.number), 2 * MERGED * small)
        rows = rows.withColumn("place", F.col("part").cast("bigint") * (1 << 40) + F.col("place"))
    got = rows.orderBy(order).select("ids", "vals", "n").toArrow()
    ids, values = (got.column(c).combine_chunks() for c in ("ids", "vals"))
    own = Rows(ids.flatten().to_numpy(), values.flatten().to_numpy(), np.concatenate([[0], np.cumsum(ids.value_lengths().to_numpy())]).astype(np.int64), len(model.number))
    split(model, own, got.column("n").to_numpy().astype(np.float64) if order == "place" else None)


def numbered(documents: DataFrame, model: Model) -> DataFrame:
    """(doc_id, ids, sizes, told): what parsed() gives of each document, as a table in the shared folder; texts are read once for it."""
    spark = documents.sparkSession
    shared, kind = spark.sparkContext.broadcast(model.reader()), dict(documents.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.parsed(t) for t in batch.column("text").to_pylist()]
            columns = [pa.array([x[n] for x in found], pa.list_(t)) for n, t in enumerate((pa.int32(), pa.int32(), pa.float32()))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=["doc_id", "ids", "sizes", "told"])

    schema, path = f"doc_id {kind}, ids array<int>, sizes array<int>, told array<float>", work_folder(spark, "subjects")
    documents.select("doc_id", "text").mapInArrow(run, schema).write.option("compression", "zstd").parquet(path)
    shared.destroy()
    return spark.read.schema(schema).parquet(path)


def _lists(batch: pa.RecordBatch, *names: str) -> list[tuple[np.ndarray, np.ndarray]]:
    """Values of list columns, one after the other, and how many each row has."""
    return [(batch.column(c).flatten().to_numpy(zero_copy_only=False), batch.column(c).value_lengths().to_numpy(zero_copy_only=False)) for c in names]


def settle(documents: DataFrame, model: Model) -> None:
    """Make each leaf the mean of all documents that are nearest to it; at most leaves x terms sums reach the driver. `documents` as numbered() gives them."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        width = len(own.number)
        # whole numbers, so that the sums don't depend on the order; the last column counts the documents
        sums = np.zeros((len(own.centroids), width + 1), np.int64)
        for batch in batches:
            ((ids, lengths),) = _lists(batch, "ids")
            place, counts = np.unique(np.repeat(np.arange(len(lengths)), lengths) * width + ids, return_counts=True)
            if not len(place):
                continue
            row, ids = place // width, place % width
            starts = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
            values = own.weight[ids] * (1 + np.log(counts))
            values /= np.repeat(np.sqrt(np.add.reduceat(values**2, starts)), np.diff([*starts, len(row)]))
            for at in range(0, len(starts), BLOCK // 8):
                some = starts[at : at + BLOCK // 8]
                end = starts[at + BLOCK // 8] if at + BLOCK // 8 < len(starts) else len(row)
                part = slice(some[0], end)
                leaf = np.add.reduceat(own.by_term[ids[part]] * values[part, None], some - some[0]).argmax(axis=1)
                np.add.at(sums, (np.repeat(leaf, np.diff([*some, end])), ids[part]), np.rint(values[part] * (1 << 24)).astype(np.int64))
                np.add.at(sums[:, -1], leaf, 1)
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums.ravel()[at])], names=["place", "n"])

    got = documents.select("ids").mapInArrow(run, "place bigint, n bigint").groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    shared.destroy()
    sums = np.zeros((len(model.centroids), len(model.number) + 1), np.int64)
    sums.ravel()[got.column("place").to_numpy()] = got.column("n").to_numpy()
    model.set_leaves(sums[:, :-1] / (1 << 24), sums[:, -1])


def learn(documents: DataFrame, labels: DataFrame, subjects: DataFrame, clustered: int = CLUSTERED) -> Model:
    """Learn the terms from all labelled documents and cluster all documents, `clustered` of them at once."""
    spark = documents.sparkSession
    own = labels.groupBy("doc_id").agg(F.collect_set("subject").alias("subjects"))
    given = stored(join_small(documents.select("doc_id", "text").where("text IS NOT NULL"), own, "doc_id").select("text", "subjects"), "labelled")
    described = {r["subject"]: r["description"] or "" for r in subjects.collect()}
    names = sorted(described)
    # a description is a labelled text
    rows = spark.createDataFrame([(f"{described[n]}. {described[n]}", [n]) for n in names], "text string, subjects array<string>")
    kept, matrix, total = labelled_terms(given.unionByName(rows), names)
    model = _weighted(names, kept, matrix, total, rarity_of(documents, {w for t in kept for w in t.split(" ") if w[0] != "<"}))
    if model.number:
        cluster(documents, model, clustered)
        learn_trust_of(model, given)
    return model


def assign(documents: DataFrame, model: Model) -> DataFrame:
    """(doc_id, subject): one row for each subject of each document; `documents` as numbered() gives them.

    Defined cases: NULL, empty and blank texts have no subject; repeated texts get the same subjects; a
    document may have none, one or several.
    """
    kind = dict(documents.dtypes)["doc_id"]
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = pa.array(shared.value.subjects, pa.string())
        for batch in batches:
            (ids, _), (sizes, passages_of), (told, _) = _lists(batch, "ids", "sizes", "told")
            leaves = shared.value.masses(ids, sizes, told, np.repeat(np.arange(batch.num_rows), passages_of), batch.num_rows)
            row, subject = np.nonzero(shared.value.enough(leaves @ shared.value.leaf_subject))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(row)), names.take(pa.array(subject))], names=["doc_id", "subject"])

    return documents.mapInArrow(run, f"doc_id {kind}, subject string")


def document_subjects(documents: DataFrame, labels: DataFrame, subjects: DataFrame) -> DataFrame:
    """(doc_id, subject) of the documents without a row in labels."""
    source = spread(documents.select("doc_id", "text"))
    model = learn(source, labels, subjects)
    read = numbered(source, model)
    if len(model.centroids):
        settle(read, model)
    # texts aren't shuffled: labelled documents are judged too and leave the short result
    return assign(read, model).join(labels.select("doc_id").distinct(), "doc_id", "left_anti")


def composition(documents: DataFrame, labels: DataFrame, subjects: DataFrame) -> DataFrame:
    """(subject, documents, share): how much of the corpus is about each subject, given labels included."""
    found = document_subjects(documents, labels, subjects).unionByName(labels.select("doc_id", "subject").distinct())
    total = documents.count()
    return found.groupBy("subject").agg(F.count("*").alias("documents")).withColumn("share", F.round(F.col("documents") / F.lit(max(total, 1)), 6))
