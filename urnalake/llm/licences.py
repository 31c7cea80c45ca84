"""Licence scan: word windows of whole texts against templates by Dice over word bigrams.

Windows may begin and end at any word. A window with a coefficient of t or more holds at least
t / (2 - t) of a template's bigrams and at most (2 - t) / t times as many bigrams as the template, so
only places where that many template bigrams lie that close together are looked at. A window that
begins or ends at any other bigram is less like the template than without it.
"""

from __future__ import annotations

import heapq
import math
import re
from bisect import bisect_left
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urnalake.checks.registry import check
from urnalake.llm.common import ship, table
from urnalake.llm.licence_texts import TEMPLATES

#: Dice coefficient from which a unit is a licence text.
LEAST = 0.75

_WORD = re.compile(r"[a-z0-9]+(?:\.[0-9]+)*")
_OWNER = re.compile(r"^\W*(?:copyright|\(c\)|©)[^\n]*$", re.IGNORECASE | re.MULTILINE)


def normalised(text: str) -> list[str]:
    """Words in lower case; punctuation, white space and lines that name a copyright owner go."""
    return _WORD.findall(_OWNER.sub(" ", text).lower())


def bigrams(words: list[str]) -> Counter:
    return Counter(zip(words, words[1:], strict=False))


def dice(a: Counter, b: Counter) -> float:
    total = a.total() + b.total()
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    return 2 * sum(min(n, large[gram]) for gram, n in small.items()) / total if total else 0.0


@dataclass
class Templates:
    """Templates by size: with a coefficient of t or more, sizes differ by a factor of (2 - t) / t at most."""

    least: float
    known: list[tuple[int, str, Counter]]
    vocabulary: frozenset[str]

    @classmethod
    def of(cls, texts: dict[str, list[str]], least: float) -> Templates:
        known = []
        for name, variants in texts.items():
            known += [(len(words) - 1, name, bigrams(words)) for words in map(normalised, variants)]
        words = frozenset(w for _, _, grams in known for gram in grams for w in gram)
        return cls(least, sorted(known, key=lambda k: (k[0], k[1])), words)

    def best(self, words: list[str]) -> tuple[str, float] | None:
        """The template most like a unit of text; ties go to the name that sorts first."""
        size, t = len(words) - 1, self.least
        if size < 1 or not self.known[0][0] * t <= size * (2 - t) or size * t > self.known[-1][0] * (2 - t):
            return None
        # Bigrams in common are made of words that templates have: too few of them, no match.
        common = [w in self.vocabulary for w in words]
        possible = sum(a and b for a, b in zip(common, common[1:], strict=False))
        if possible * (2 - t) < t * size:
            return None
        grams, found = bigrams(words), None
        for length, name, template in self.known:
            if length * (2 - t) < size * t:
                continue
            if length * t > size * (2 - t):
                break
            value = dice(grams, template)
            if value >= t and (found is None or (-value, name) < (-found[1], found[0])):
                found = name, value
        return found

    def units(self, text: str | None) -> list[tuple[int, int, str, float]]:
        """(first word, word after the last, licence, dice) of units: the whole text, else paragraphs, else lines.

        A unit inside one that matches is not looked at. ``Windows.find`` looks at all windows.
        """
        if not text:
            return []
        words = normalised(text)
        whole = self.best(words)
        if whole:
            return [(0, len(words), *whole)]
        found, at = [], 0

        def enter(unit: str, at: int) -> tuple[bool, int]:
            words = normalised(unit)
            match = self.best(words)
            if match:
                found.append((at, at + len(words), *match))
            return match is not None, at + len(words)

        for paragraph in re.split(r"\n[ \t\r]*\n", text):
            matched, after = enter(paragraph, at)
            lines = paragraph.split("\n")
            if not matched and len(lines) > 1:
                for line in lines:
                    at = enter(line, at)[1]
            at = after
        return found

    def scan(self, text: str | None) -> list[tuple[str, float]]:
        """A match for each unit that has one."""
        return [(name, value) for _, _, name, value in self.units(text)]


def owner_lines(text: str) -> list[str]:
    """What ``normalised`` leaves out: a notice may stand beside the owner's name."""
    return [m.group() for m in _OWNER.finditer(text)]


class Windows:
    """Finds the word windows of a text that are like a template.

    Each template has its best windows (highest coefficient, then longest, then first) that do not
    overlap. Where those of several templates overlap, the one that lies most above the least
    coefficient, in bigrams, is the match, and the words around it are searched again. In the end
    every window that reaches the least coefficient is a match or overlaps one.

    The coefficient of a match is its window's, or that of the text, paragraph or line around it that
    reaches the least by itself.
    """

    def __init__(self, texts: dict[str, list[str]], least: float):
        known = [(name, normalised(v)) for name, variants in texts.items() for v in variants]
        known = sorted(((len(words) - 1, name, words) for name, words in known if len(words) > 1), key=lambda k: k[:2])
        self.least = least
        self.templates = Templates.of(texts, least)
        self.names = [name for _, name, _ in known]
        self.lengths = [length for length, _, _ in known]
        #: Bigrams in common that a window needs at least, and bigrams that it has at most.
        self.need = np.array([max(1, math.ceil(n * least / (2 - least) - 1e-9)) for n in self.lengths], dtype=np.int64)
        self.most = [math.floor(n * (2 - least) / least + 1e-9) for n in self.lengths]
        self.numbers = {w: i for i, w in enumerate(sorted({w for _, _, words in known for w in words}))}
        coded = [self._codes(np.array([self.numbers[w] for w in words], dtype=np.int64)) for _, _, words in known]
        self.codes = np.unique(np.concatenate(coded)) if coded else np.empty(0, dtype=np.int64)
        self.counts = np.zeros((len(known), len(self.codes)), dtype=np.int32)
        for row, codes in zip(self.counts, coded, strict=True):
            np.add.at(row, np.searchsorted(self.codes, codes), 1)
        self.member = self.counts > 0

    def _codes(self, ids: np.ndarray) -> np.ndarray:
        return ids[:-1] * len(self.numbers) + ids[1:]

    def find(self, text: str | None) -> list[tuple[str, float]]:
        """(licence, dice) of all matches of a text, and of its owner lines by themselves."""
        if not text:
            return []
        found = self.spans(normalised(text))
        for a, b, name, value in self.templates.units(text) if found else []:
            within = [k for k, (first, last, n, _) in enumerate(found) if a <= first and last <= b and n == name]
            if within:
                k = max(within, key=lambda k: found[k][3])
                found[k] = (*found[k][:3], value)
        for line in owner_lines(text):
            found += self.spans(_WORD.findall(line.lower()))
        return [(name, value) for _, _, name, value in found]

    def spans(self, words: list[str]) -> list[tuple[int, int, str, float]]:
        """(first word, word after the last, licence, dice) of each match, in order."""
        if len(words) < 2 or not len(self.codes):
            return []
        get = self.numbers.get
        ids = np.array([get(w, -1) for w in words], dtype=np.int64)
        at = np.flatnonzero((ids[:-1] >= 0) & (ids[1:] >= 0))
        codes = ids[at] * len(self.numbers) + ids[at + 1]
        grams = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        real = self.codes[grams] == codes
        return sorted(self._matches(at[real], grams[real], 0, len(words), np.arange(len(self.names))))

    def _matches(
        self, at: np.ndarray, grams: np.ndarray, begin: int, end: int, templates: np.ndarray
    ) -> list[tuple[int, int, str, float]]:
        """Matches among the words from ``begin`` to ``end``; ``at`` are the places of known bigrams."""
        inside = slice(*np.searchsorted(at, (begin, end - 1)))
        at, grams = at[inside], grams[inside]
        if not len(at):
            return []
        hits = np.count_nonzero(self.member[np.ix_(templates, grams)], axis=1)
        found = []
        for t in templates[hits >= self.need[templates]].tolist():
            own = self.member[t, grams]
            for first, last, common in self._best_windows(t, at[own], grams[own]):
                both = last - first - 1 + self.lengths[t]
                found.append((self.least * both - 2 * common, -2 * common / both, first, self.names[t], last, t))
        taken: list[tuple[int, int, str, float]] = []
        again = set()
        for _, value, first, name, last, t in sorted(found):
            k = bisect_left(taken, (first,))
            if (k and taken[k - 1][1] > first) or (k < len(taken) and taken[k][0] < last):
                again.add(t)
            else:
                taken.insert(k, (first, last, name, -value))
        if not again:
            return taken
        rest = np.array(sorted(again))
        edges = [begin, *(x for first, last, _, _ in taken for x in (first, last)), end]
        gaps = list(zip(edges[::2], edges[1::2], strict=True))
        return taken + [m for a, b in gaps if b - a > 1 for m in self._matches(at, grams, a, b, rest)]

    def _best_windows(self, t: int, at: np.ndarray, grams: np.ndarray) -> list[tuple[int, int, int]]:
        """(first word, word after the last, bigrams in common) of one template's best windows.

        ``at`` are the places of its bigrams and ``grams`` their numbers. A bigram counts in a window
        unless the window has as many of the same before it as the template has in all.
        """
        need, most, length = int(self.need[t]), self.most[t], self.lengths[t]
        n = len(at)
        close = at[need - 1 :] - at[: n - need + 1] < most
        if not close.any():
            return []
        order = np.argsort(grams, kind="stable")
        ranked = grams[order]
        source = np.arange(n) - self.counts[t, ranked]
        valid = (source >= 0) & (ranked[np.maximum(source, 0)] == ranked)
        before, after = np.full(n, -1), np.full(n, n)
        before[order[valid]] = order[source[valid]]
        after[order[source[valid]]] = order[valid]
        # Where the bigram one place earlier would count as well, the window that begins there is better.
        later = np.append(at, at[-1] + 2 * most + 2)[after]
        better = np.zeros(n, dtype=bool)
        better[1:] = (at[1:] - at[:-1] == 1) & (later[:-1] >= at[1:] + most)
        heap: list[tuple[float, int, int, int, int]] = []
        current: dict[int, int] = {}
        starts: list[int] = []
        gone = np.zeros(n, dtype=bool)

        def look(k: int) -> None:
            """Enters the best window that begins at bigram k and ends before the next one taken."""
            current.pop(k, None)
            stop = int(at[k]) + most
            following = bisect_left(starts, int(at[k]))
            if following < len(starts):
                stop = min(stop, starts[following] - 1)
            end = int(np.searchsorted(at, stop))
            if end - k < need:
                return
            common = np.cumsum(before[k:end] < k)
            values = 2 * common / (at[k:end] - at[k] + 1 + length)
            j = end - 1 - int(np.argmax(values[::-1]))
            value = float(values[j - k])
            if value >= self.least:
                current[k] = j
                heapq.heappush(heap, (-value, int(at[k] - at[j]), k, j, int(common[j - k])))

        for k in np.flatnonzero(close & ~better[: len(close)]).tolist():
            look(k)
        windows = []
        while heap:
            _, _, k, j, common = heapq.heappop(heap)
            if current.get(k) != j:
                continue
            first, last = int(at[k]), int(at[j]) + 2
            windows.append((first, last, common))
            starts.insert(bisect_left(starts, first), first)
            free = int(np.searchsorted(at, last))
            gone[k:free] = True
            for i in range(k, free):
                current.pop(i, None)
            for i in range(int(np.searchsorted(at, first - most - 1)), k):
                if i in current and at[current[i]] + 2 > first:
                    look(i)
            # The first bigram after the window may have been passed over for one inside it.
            if free < n and free not in current and not gone[free]:
                look(free)
        return windows


def scan_licences(
    docs: DataFrame, text: str = "text", texts: dict[str, list[str]] | None = None, least: float = LEAST
) -> DataFrame:
    """``docs`` with ``licences``: array of (licence, dice), a row for each window that is one, best first.

    Windows are runs of words of any length at any place. Null and empty texts have none. The
    column ``licences`` is replaced if there is one; other columns and all rows stay.
    """
    ship(docs.sparkSession)
    windows = Windows(texts or TEMPLATES, least)

    @F.pandas_udf("array<struct<licence:string,dice:double>>")
    def scan(column: pd.Series) -> pd.Series:
        return pd.Series(
            [[{"licence": n, "dice": d} for n, d in sorted(windows.find(t), key=lambda m: (-m[1], m[0]))] for t in column]
        )

    return docs.withColumn("licences", scan(F.col(text)))


@check()
def op6_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = scan_licences(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select(
        "doc_id",
        F.size("licences").cast("long").alias("n_matches"),
        F.get("licences", F.lit(0))["licence"].alias("licence"),
        F.get("licences", F.lit(0))["dice"].alias("dice"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("licences", lambda m: m["licence"]))), ",").alias("all_licences"),
    )
