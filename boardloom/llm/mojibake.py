"""Garbled text from a wrong character encoding (problem 4).

A best-first search runs over the readings of a text. A state is the tuple of the text's non-ASCII runs
and entities; its neighbours come from encoding every run with one character set and decoding the bytes
with another, or from unescaping entities. Visited states are kept in a hash set. The cost of a state says
how implausible its characters are beside their neighbours; the search always expands the cheapest state and
ends with the cheapest reachable text. A text is garbled if that text is cheaper by a margin, or if a
replacement character shows that something was lost. Where a text has so many differently damaged runs that the states outnumber STATES,
each run is searched by itself as well: costs add up over the runs, so nothing is given up.
"""

from __future__ import annotations

import heapq
import html
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache, wraps

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boardloom.plans.work import spread

LOST = "�"
# Character sets in which text is commonly misread, and elided Italian words.
WRONG = ("cp1252", "latin-1", "mac_roman", "cp437", "cp850", "cp1251", "cp1253", "cp1250", "iso8859-15", "cp866", "koi8-r", "cp1254")
RIGHT = ("utf-8", "cp1252")
ELIDED = {"l", "d", "dell", "nell", "all", "dall", "sull", "un", "quest", "anch", "sant", "com", "dov", "quell"}
MARGIN, EACH, STEP, DEPTH = 0.95, 0.3, 0.3, 4
#: States of all runs together; where there are more, every run is searched by itself as well.
STATES = 400
#: Runs up to which results are remembered.
SHORT = 64
_RUN = re.compile(r"(?:[^\x00-\x7f]|&(?:#\d{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z]{2,8}\d?);)+")
_OPEN, _CLOSE = set("“‘«„‹"), set("”’»›")
_NEAR = 12


def _remembered(most: int):
    """Cache by arguments, for short runs only."""

    def wrap(f):
        cached = lru_cache(most)(f)
        return wraps(f)(lambda run, *rest: cached(run, *rest) if len(run) <= SHORT else f(run, *rest))

    return wrap


def _bytes(run: str, charset: str) -> bytes | None:
    """The bytes that `charset` reads as `run`; the holes of cp1252 stand for the control of the same number."""
    try:
        return run.encode(charset)
    except UnicodeEncodeError:
        if charset not in ("cp1252", "cp1250", "cp1253", "cp1254"):
            return None
    out = bytearray()
    for ch in run:
        try:
            out += ch.encode(charset)
        except UnicodeEncodeError:
            if not 0x80 <= ord(ch) <= 0x9F:
                return None
            out.append(ord(ch))
    return bytes(out)


@_remembered(200_000)
def reread(run: str, wrong: str, right: str, after: str) -> str | None:
    """`run` as `right` would have read its bytes.

    A UTF-8 sequence that ends early becomes a lost character; before white space or the end a lone C3 is an "à" whose
    second byte, a no-break space, was taken for white space.
    """
    if "&" in run or LOST in run:
        return None
    raw = _bytes(run, wrong)
    if raw is None or raw == run.encode("utf-8"):
        return None
    try:
        got = raw.decode(right)
    except UnicodeDecodeError as e:
        if right != "utf-8" or after.isalpha() or e.end != len(raw) or "unexpected end" not in e.reason:
            return None
        got = (raw + b"\xa0" * (raw[-1] == 0xC3 and (not after or after.isspace()))).decode(right, "replace")
    return got if got != run else None


def _script(ch: str) -> str:
    o = ord(ch)
    return "greek" if 0x370 <= o < 0x400 else "cyrillic" if 0x400 <= o < 0x530 else "latin" if o < 0x250 or 0x1E00 <= o < 0x1F00 else "other"


def _letter_cost(ch: str, left: str, right: str, before: str) -> float:
    near = [x for x in (left, right) if x.isalpha()]
    if _script(ch) in ("greek", "cyrillic"):
        return 4.0 if any(_script(x) != _script(ch) for x in near) else 0.3 if near else 2.5
    if _script(ch) == "other":
        return 0.3
    if ch in "ªº":
        return 0.5 if left.isdigit() or left in ".aonr" and left else 2.5
    if not near and ch in "èÈàÀòÒ":
        return 0.4
    if ch == "ƒ" or not near:
        return 2.5
    if ch.isupper() and left.islower() and not right.isupper():
        return 1.0 if len(before) == 1 and ch in "ÀÈÉÌÒÙ" else 4.0
    if ch in "ÃÂ" and not right.isalpha():
        return 3.0
    if ch in "àèéìòùÀÈÉÌÒÙ":
        return 0.2 if left.isalpha() and not right.isalpha() else 0.6
    if ch in "þðýŽžšÿœŒ" and ch.islower() and not right.isalpha():
        return 2.0
    if right.isalpha() and before.lower() in ELIDED and ch.islower():
        return 2.0
    return 1.0 if right.isalpha() or ch.isupper() else 1.2


def _char_cost(ch: str, left: str, right: str, before: str) -> float:
    """Implausibility of one non-ASCII character between `left` and `right`, after the word part `before`."""
    if ch == LOST:
        return 2.0
    o = ord(ch)
    if 0x80 <= o <= 0x9F:
        return 5.0
    if ch.isalpha() and o != 0xAA and o != 0xBA or ch in "ªº":
        return _letter_cost(ch, left, right, before)
    starts = not left or left.isspace() or left in "([/-\"'" or left in _OPEN or unicodedata.category(left) in ("Pd", "Zs")
    ends = not right or right.isspace() or right in ".,;:!?)]/-\"'|…" or right in _CLOSE or unicodedata.category(right) in ("Pd", "Zs")
    if ch == "’":
        return 0.2 if left.isalnum() and (ends or before.lower() in ELIDED) else 1.0 if left.isalpha() else 0.5
    if ch in _OPEN:
        return (0.2 if starts and right and not right.isspace() else 1.5) + (ch in "„‹") * 1.0
    if ch == "»" and starts and (not right or right.isspace()):
        return 0.5  # an item mark
    if ch in _CLOSE:
        return (0.2 if ends and left and not left.isspace() else 1.5) + (ch == "›") * 1.0
    if ch in "–—":
        return 0.2 if (not left or left.isspace()) and (not right or right.isspace()) else 0.8
    if o in (0xA0, 0x202F, 0x3000) or 0x2000 <= o <= 0x200B or ch == "…":
        return 0.3
    if ch in "•©€°®·№−×":
        return 4.0 if left.isalpha() and right.isalpha() else 0.5 if not left.isalpha() or ch in "©®°•" else 3.0
    if ch in "™":
        return 0.5 if left.isalpha() and ends else 4.0
    if 0x2500 <= o <= 0x25A0 or ch in "√∫∂∑∏π∆Ω◊≈≠≤≥∞‡†¬¦¨¸¯´´¢¥¤¶§±µ˜ˆ‚‰¿¡·¹²³¼½¾":
        return 2.5 if ch in "½¼¾²³§±µ¿¡´" and not left.isalpha() else 4.0
    if unicodedata.category(ch) in ("So", "Mn", "Sk", "Cf") and o > 0x2600:
        return 0.8
    return 2.5


@_remembered(400_000)
def run_cost(run: str, left: str, right: str, before: str) -> float:
    """Implausibility of a run between the characters left and right, after the ASCII word part `before`."""
    if "&" in run:
        run = html.unescape(run)
    total, word = 0.0, before
    for i, ch in enumerate(run):
        a, b = run[i - 1] if i else left, run[i + 1] if i + 1 < len(run) else right
        total += _char_cost(ch, a, b, word)
        word = word + ch if ch.isalpha() else ""
    return total


def _places(text: str) -> list[tuple[str, str, str, str]]:
    """Every run of a text with its neighbours and the word part before it."""
    found = []
    for m in _RUN.finditer(text):
        a, b = m.span()
        i = a
        while i > 0 and a - i < _NEAR and text[i - 1].isalpha():
            i -= 1
        found.append((m.group(), text[a - 1 : a], text[b : b + 1], text[i:a]))
    return found


@lru_cache(100_000)
def _hope(run: str, left: str, right: str, before: str) -> float:
    """The most that any chain of readings can take off one run's cost."""
    here = run_cost(run, left, right, before)
    best, seen, todo = here, {run}, [(run, 0)]
    while todo:
        state, depth = todo.pop()
        for new in _steps(state, right):
            if new and new not in seen and depth < DEPTH:
                seen.add(new)
                best = min(best, run_cost(new, left, right, before))
                todo.append((new, depth + 1))
    return here - best


@_remembered(100_000)
def _alone(run: str, left: str, right: str, before: str) -> tuple[str, int]:
    """The cheapest reading of one run that any chain of at most DEPTH steps reaches, and its steps."""
    best, seen = (run_cost(run, left, right, before), 0, run), {run}
    heap = [best]
    while heap:
        at, depth, state = heapq.heappop(heap)
        best = min(best, (at, depth, state))
        if depth == DEPTH:
            continue
        for new in _steps(state, right):
            if new and new not in seen:
                seen.add(new)
                heapq.heappush(heap, (run_cost(new, left, right, before) + STEP * (depth + 1), depth + 1, new))
    return best[2], best[1]


def _steps(run: str, after: str) -> Iterator[str | None]:
    if "&" in run:
        yield html.unescape(run)
        return
    for wrong in WRONG:
        for right in RIGHT:
            if wrong != right:
                yield reread(run, wrong, right, after)


def search(text: str) -> tuple[bool, str | None]:
    """(garbled, restored text or None where something was lost) of one text."""
    places = _places(text)
    if not places:
        return False, None
    lost = any(LOST in p[0] for p in places)
    if not lost and sum((_hope if len(p[0]) <= SHORT else _hope.__wrapped__)(*p) for p in places) < MARGIN:
        return False, None
    start = tuple(p[0] for p in places)

    def cost(state: tuple[str, ...]) -> float:
        return sum(run_cost(s or " ", *p[1:]) for s, p in zip(state, places, strict=True))

    first = cost(start)
    heap, seen, best = [(first, 0, start)], {start}, (first, start)
    while heap and len(seen) < STATES:
        at, depth, state = heapq.heappop(heap)
        if at < best[0]:
            best = (at, state)
        if depth == DEPTH:
            continue
        moves = [tuple(html.unescape(s) for s in state)]
        for wrong in WRONG:
            for right in RIGHT:
                if wrong != right:
                    moves.append(tuple(_better(s, reread(s, wrong, right, p[2]) if s else None, p) for s, p in zip(state, places, strict=True)))
        for new in moves:
            if new not in seen:
                seen.add(new)
                heapq.heappush(heap, (cost(new) + STEP * (depth + 1), depth + 1, new))
    if heap:  # many runs, damaged in different ways: costs add up over runs, so each may be read at its own cheapest
        each = [_alone(*p) for p in places]
        state = tuple(s for s, _ in each)
        best = min(best, (cost(state) + STEP * max(n for _, n in each), state))
    changed = sum(len(html.unescape(a)) for a, b in zip(start, best[1], strict=True) if a != b)
    garbled = lost or first - best[0] >= max(MARGIN, EACH * changed)
    if not garbled:
        return False, None
    if lost or any(LOST in s for s in best[1]):
        return True, None
    out, at = [], 0
    for m, new in zip(_RUN.finditer(text), best[1], strict=True):
        out += [text[at : m.start()], new]
        at = m.end()
    return True, "".join([*out, text[at:]])


def _better(run: str, new: str | None, place: tuple[str, str, str, str]) -> str:
    """The new reading of a run, unless the old one is fine or the new one much less plausible."""
    here = run_cost(run, *place[1:]) if run else 0.0
    return run if not new or here < 0.05 + 0.2 * len(run) or run_cost(new, *place[1:]) > here + 1.0 else new


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [search(t) for t in batch.column("text").to_pylist()]
        keep = pa.array([g for g, _ in found])
        restored = pa.array([r for g, r in found if g], pa.string())
        yield pa.RecordBatch.from_arrays([batch.column("key").filter(keep), batch.column("text").filter(keep), restored], names=["key", "text", "restored"])


def garbled(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key string, text, restored) of the rows whose text was decoded wrongly, in whole or in part.

    `restored` is NULL where something was lost. Defined cases: NULL and empty texts are fine texts; pure
    ASCII without entities can't be garbled and is skipped before Python; repeated rows come out repeatedly;
    empty tables yield no rows.
    """
    source = df.select(F.col(key).cast("string").alias("key"), F.col(text).alias("text"))
    suspects = source.where(F.col("text").rlike(r"[^\x00-\x7F]|&[A-Za-z#]"))
    return suspects.mapInArrow(_judge, "key string, text string, restored string")


def garbled_values(findings: DataFrame, schools: DataFrame) -> DataFrame:
    """(tab, rec_key, text, restored) of findings.title and schools.name."""
    a = garbled(spread(findings.select("row_id", "title")), "row_id", "title").withColumn("tab", F.lit("findings"))
    b = garbled(schools.select("code", "name"), "code", "name").withColumn("tab", F.lit("schools"))
    return a.unionByName(b).select("tab", F.col("key").alias("rec_key"), "text", "restored")
