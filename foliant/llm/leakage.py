"""Evaluation texts that occur, whole or in part, in training texts."""

from __future__ import annotations

import math
import re
import unicodedata
from bisect import bisect_left
from collections import Counter
from dataclasses import dataclass
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WRAP = re.compile(r"(?<=[^\W\d_])[-­‐][ \t]*(?:\r\n|[\r\n\x0b\x0c\x85  ])[ \t]*(?=[^\W\d_])|­")
ACCENTS = re.compile("[̀-ͯ]")
WORD = re.compile(r"[^\W_]+")
CJK = re.compile("[぀-ヿ㐀-䶿一-鿿豈-﫿]")


def normal(text: str) -> str:
    """Without case, accents, compatibility forms, and hyphens at line ends."""
    text = WRAP.sub("", text).casefold()
    if text.isascii():
        return text
    return unicodedata.normalize("NFC", ACCENTS.sub("", unicodedata.normalize("NFKD", text)))


@dataclass(frozen=True)
class Unit:
    """What a run is counted in: its length, the edits it may hold, the units of an index term."""

    run: int
    edits: int
    gram: int

    @property
    def passage(self) -> int:
        return 3 * (self.run + self.edits)


#: Twelve words with two edits; 24 characters with three, as about one in ten.
WORDS, CHARS = Unit(12, 2, 2), Unit(24, 3, 3)


def words(text: str) -> list[str]:
    return WORD.findall(text)


def chars(text: str) -> list[str]:
    return list("".join(WORD.findall(text)))


def in_chars(text: str) -> bool:
    """Whether a text is counted in characters: a third of its letters at least are Chinese or Japanese."""
    return 3 * len(CJK.findall(text)) >= sum(c.isalpha() for c in text) > 0


def grams(units: list[str], n: int) -> list[tuple[str, ...]]:
    return list(zip(*(units[k:] for k in range(n)), strict=False))


NEXT, LAST = itemgetter(0), 1 << 62


class Index:
    """BM25 index of items, for block-max WAND.

    An impact is divided by its item's threshold: the least score that a run of the item keeps if every allowed edit takes
    its dearest terms. So a passage holds such a run only if its score for the item is 1 or more, and none is lost.
    """

    K1, B, BLOCK = 1.2, 0.75, 8

    def __init__(self, items: list[tuple[int, list[str]]], unit: Unit, whole: bool = True) -> None:
        self.unit, self.whole = unit, whole
        self.items = sorted((i, u) for i, u in items if len(u) >= unit.run)
        self.vocabulary = {u: k for k, u in enumerate(sorted({u for _, own in self.items for u in own}))}
        self.codes = [np.array([self.vocabulary[u] for u in own]) for _, own in self.items]
        counted = [Counter(grams(u, unit.gram)) for _, u in self.items]
        mean = sum(c.total() for c in counted) / max(1, len(counted))
        df = Counter(t for c in counted for t in c)
        postings: dict[tuple[str, ...], list[tuple[int, float]]] = {}
        for k, c in enumerate(counted):
            norm = self.K1 * (1 - self.B + self.B * c.total() / mean)
            impact = {t: math.log(1 + (len(counted) - df[t] + 0.5) / (df[t] + 0.5)) * (self.K1 + 1) * n / (n + norm) for t, n in c.items()}
            terms, size, lost = grams(self.items[k][1], unit.gram), unit.run - unit.gram + 1, unit.edits * unit.gram
            least = min(sum(sorted(impact[t] for t in set(terms[s : s + size]))[: max(1, len(set(terms[s : s + size])) - lost)]) for s in range(len(terms) - size + 1))
            for t, x in impact.items():
                postings.setdefault(t, []).append((k, x / least))
        self.postings = postings
        # Terms as numbers, in order, with the greatest impact of each.
        self.terms = sorted(postings, key=lambda t: [self.vocabulary[u] for u in t])
        self.numbers = self._numbers(np.array([[self.vocabulary[u] for u in t] for t in self.terms]).reshape(-1, unit.gram).T)
        self.bounds = np.array([max(x for _, x in postings[t]) for t in self.terms])
        self.lists = {}
        for t, p in postings.items():
            blocks = [p[s : s + self.BLOCK] for s in range(0, len(p), self.BLOCK)]
            self.lists[t] = ([k for k, _ in p], [x for _, x in p], [b[-1][0] for b in blocks], [max(x for _, x in b) for b in blocks], max(x for _, x in p))

    def search(self, terms: set[tuple[str, ...]]) -> list[int]:
        """All items whose score reaches 1 - 1e-9, by block-max WAND: lists in order of their next item; no item is scored
        unless the lists' bounds, and then those of their blocks at it, reach the threshold."""
        enough, found = 1 - 1e-9, []
        # The next item of a list, its place, then the list's items, impacts, last items and bounds of blocks, and bound.
        lists = [[own[0][0], 0, *own] for own in map(self.lists.get, terms) if own]
        while lists:
            lists.sort(key=NEXT)
            bound = 0.0
            for pivot, x in enumerate(lists, 1):
                bound += x[6]
                if bound >= enough:
                    break
            else:
                break
            item = lists[pivot - 1][0]
            while pivot < len(lists) and lists[pivot][0] == item:
                pivot += 1
            heads, inside, target = lists[:pivot], 0.0, lists[pivot][0] if pivot < len(lists) else LAST
            for _, _, _, _, lasts, bounds, _ in heads:
                block = bisect_left(lasts, item)
                if block < len(lasts):
                    inside += bounds[block]
                    target = min(target, lasts[block] + 1)
            if inside < enough:
                target = max(target, item + 1)
            else:
                score, target = 0.0, item + 1
                for x in heads:
                    x[1] = bisect_left(x[2], item, x[1])
                    if x[1] < len(x[2]) and x[2][x[1]] == item:
                        score += x[3][x[1]]
                if score >= enough:
                    found.append(item)
            done = False
            for x in heads:
                x[1] = k = bisect_left(x[2], target, x[1])
                if k < len(x[2]):
                    x[0] = x[2][k]
                else:
                    x[0], done = LAST, True
            if done:
                lists = [x for x in lists if x[0] < LAST]
        return found

    def _numbers(self, parts: np.ndarray) -> np.ndarray:
        """Terms, given as a row of codes for each of their places, as numbers; -1 for those with a unit that no item has."""
        if len(self.vocabulary) ** self.unit.gram >= 1 << 62:
            raise ValueError("more units than terms of this length can be numbered for")
        out = np.zeros(parts.shape[1], dtype=np.int64)
        for row in parts:
            out = out * len(self.vocabulary) + row
        return np.where((parts < 0).any(axis=0), -1, out)

    def leaks(self, units: list[str]) -> set[int]:
        """Ids of the items of which a text, in its units, holds a run."""
        out: set[int] = set()
        if not self.items or len(units) < self.unit.run - self.unit.edits:
            return out
        get = self.vocabulary.get
        codes = np.array([get(u, -1) for u in units])
        numbers = self._numbers(np.stack([codes[k : len(codes) - self.unit.gram + 1 + k] for k in range(self.unit.gram)]))
        at = np.minimum(np.searchsorted(self.numbers, numbers), len(self.numbers) - 1)
        known = self.numbers[at] == numbers
        sums = np.concatenate([[0.0], np.cumsum(np.where(known, self.bounds[at], 0.0))])
        size, stride = self.unit.passage, self.unit.passage - self.unit.run - self.unit.edits
        starts = np.arange(0, max(1, len(units) - (size - stride)), stride)
        ends = np.minimum(len(numbers), starts + size - self.unit.gram + 1)
        for a, b in zip(*(x[sums[ends] - sums[starts] >= 1 - 1e-6].tolist() for x in (starts, ends)), strict=True):
            for k in self.search({self.terms[t] for t in at[a:b][known[a:b]].tolist()}):
                item, own, passage = self.items[k][0], self.codes[k], codes[a : a + size]
                if item in out:
                    continue
                held = likely(own, passage, self.unit)
                if held or held is None and (holds_whole if self.whole else holds)(own, passage, self.unit):
                    out.add(item)
        return out


def _coded(item: list[str], passage: list[str]) -> tuple[np.ndarray, np.ndarray]:
    codes: dict[str, int] = {}
    a = [codes.setdefault(u, len(codes)) for u in item]
    return np.array(a), np.array([codes.get(u, -1) for u in passage])


def likely(a: np.ndarray, b: np.ndarray, unit: Unit) -> bool | None:
    """True for an unaltered run; False only if no run is held: of `run` consecutive units of the item, at least `run - edits` have
    an equal in the passage, and no two of these are moved by more than `edits` places against each other; else None."""
    x, y = np.nonzero(a[:, None] == b[None, :])
    least, across = unit.run - unit.edits, len(a) + 1
    if len(x) < least:
        return False
    places = np.sort((y - x + len(a)) * across + x)
    if len(places) >= unit.run and (places[unit.run - 1 :] - places[: 1 - unit.run] == unit.run - 1).any():
        return True
    # Of so many matches in order of how far they are moved, the last is moved little further than the first.
    if (places[least - 1 :] // across - places[: len(places) - least + 1] // across > unit.edits).all():
        return False
    moved = np.zeros((len(a) + len(b) + unit.edits, across), dtype=bool)
    for k in range(unit.edits + 1):
        moved[y - x + len(a) - 1 + k, x + 1] = True
    sums = np.cumsum(moved, axis=1, dtype=np.int16)
    return None if (sums[:, unit.run :] - sums[:, : -unit.run]).max() >= least else False


def holds_run(item: list[str], passage: list[str], unit: Unit) -> bool:
    """Whether some `run` consecutive units of the item lie in the passage with at most `edits` altered, dropped or added.

    All windows of the item go through one table of edit distances, row by row of the window, that lets the passage's ends free.
    """
    return holds(*_coded(item, passage), unit)


def holds(a: np.ndarray, b: np.ndarray, unit: Unit) -> bool:
    """`holds_run` of units as numbers, -1 for those of the passage that the item lacks."""
    if len(a) < unit.run or (b >= 0).sum() < unit.run - unit.edits:
        return False
    windows = np.lib.stride_tricks.sliding_window_view(a, unit.run)
    row = np.zeros((len(windows), len(b) + 1), dtype=np.int16)
    step = np.arange(len(b) + 1, dtype=np.int16)
    for k in range(unit.run):
        change = row[:, :-1] + (windows[:, k : k + 1] != b)
        new = np.empty_like(row)
        new[:, 0] = k + 1
        new[:, 1:] = np.minimum(change, row[:, 1:] + 1)
        row = np.minimum.accumulate(new - step, axis=1) + step  # units added in the passage
        if row.min() > unit.edits:
            return False
    return True


def holds_whole_run(item: list[str], passage: list[str], unit: Unit) -> bool:
    """Whether at least `run` consecutive units of the item, the first and the last of them unaltered, lie in the passage with
    at most `edits` edits between, in any alignment; so edits at a run's ends don't make it long enough.

    Of a longer run with no more edits, the first `run` units and those up to the next match are one: `run + edits` units suffice.
    """
    return holds_whole(*_coded(item, passage), unit)


def holds_whole(a: np.ndarray, b: np.ndarray, unit: Unit) -> bool:
    """`holds_whole_run` of units as numbers, -1 for those of the passage that the item lacks."""
    a = np.concatenate([a, np.full(unit.edits, -2)])
    windows = np.lib.stride_tricks.sliding_window_view(a, unit.run + unit.edits)
    row = np.full((len(windows), len(b) + 1), unit.edits + 1, dtype=np.int16)
    row[:, 1:][windows[:, :1] == b] = 0
    step = np.arange(len(b) + 1, dtype=np.int16)
    row = np.minimum.accumulate(row - step, axis=1) + step
    for k in range(1, unit.run + unit.edits):
        same = windows[:, k : k + 1] == b
        if k >= unit.run - 1 and (same & (row[:, :-1] <= unit.edits)).any():
            return True
        new = np.full_like(row, unit.edits + 1)
        new[:, 1:] = np.minimum(row[:, :-1] + ~same, row[:, 1:] + 1)
        row = np.minimum.accumulate(new - step, axis=1) + step
        if row.min() > unit.edits:
            return False
    return False


def leaked_items(documents: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "item_text", most_items: int = 100_000) -> DataFrame:
    """One row per document and item of which it holds a run: `doc_id, item_id`.

    The evaluation set is small by its nature and goes to all tasks; more than `most_items` raise an error. Documents
    are read once where they lie, whatever their skew: nothing is shuffled. Repeated documents count each; of items that
    share an id each is looked for, and the id given once. Null, empty and shorter texts hold nothing.
    """
    rows = items.where(F.col(item_text).isNotNull()).select(F.col(item_id).cast("long"), F.col(item_text).cast("string")).limit(most_items + 1).collect()
    if len(rows) > most_items:
        raise ValueError(f"more than {most_items} evaluation items")
    normed = [(i, normal(t)) for i, t in rows]
    sets = [(i, t, in_chars(t)) for i, t in normed]
    by_word = Index([(i, words(t)) for i, t, c in sets if not c], WORDS)
    by_char = Index([(i, chars(t)) for i, t, c in sets if c], CHARS)
    shared = documents.sparkSession.sparkContext.broadcast((by_word, by_char))

    def run(batches):
        word_index, char_index = shared.value
        for batch in batches:
            docs, found = [], []
            for d, t in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if not t:
                    continue
                t = normal(t)
                got = word_index.leaks(words(t))
                if char_index.items and CJK.search(t):
                    got |= char_index.leaks(chars(t))
                docs += [d] * len(got)
                found += sorted(got)
            yield pa.record_batch([pa.array(docs, pa.int64()), pa.array(found, pa.int64())], names=["doc_id", "item_id"])

    return documents.select(F.col(doc_id).cast("long"), F.col(text).cast("string")).mapInArrow(run, "doc_id long, item_id long")
