"""Periodic runs of words in every text: stretches that repeat with a smallest period, as long as they last.

A run with period q and length >= max(SHORTEST, TIMES * q) holds a stretch of
length - q words that equal the word q further on.  So for each period a grid of
places, as wide as the shortest such stretch, hits every run; over all periods
the grid has n log n places.  At each place the common extension to the right
and to the left of (place, place + q) gives the whole run.

Extensions come from a difference cover.  Only suffixes at places that are in
the cover modulo ``PERIOD`` are sorted, by doubling ranks.  For any two places a
few words lead to two sorted suffixes at once, whose common prefix is a range
minimum over neighbours in the sorted order, from a sparse table.

Texts are independent.  A task joins many of them to one array, with numbers for
words that no two texts share; texts where no place of the grid has a few equal
words beside it are left out.  Nothing is shuffled; memory is that of one group
of texts, or of the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

#: the shortest run in words, and in periods
SHORTEST, TIMES = 24, 3
#: a difference cover: every difference modulo PERIOD is one of two members
PERIOD, COVER = 7, (0, 1, 3)
#: words that are worked on at a time; a longer text is a group of its own
GROUP_WORDS = 200_000
#: places of the grids that are compared at a time
_PLACES = 1_000_000
#: a run's stretch has 16 equal words or more, so at any place in it this many more are equal on one side
_NEAR = 4

_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
_SCHEMA = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def _meeting() -> np.ndarray:
    """For residues a, b the least d with a + d and b + d in the cover."""
    member = np.zeros(PERIOD, bool)
    member[list(COVER)] = True
    r = np.arange(PERIOD)
    table = np.full((PERIOD, PERIOD), -1)
    for d in range(PERIOD - 1, -1, -1):
        hit = member[(r[:, None] + d) % PERIOD] & member[(r[None, :] + d) % PERIOD]
        table[hit] = d
    return table.ravel()


_MEET = _meeting()


def _rank(keys: np.ndarray) -> tuple[np.ndarray, int]:
    """Dense ranks of numbers, and how many different ones there are."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    steps = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
    ranks = np.empty(len(keys), np.int64)
    ranks[order] = steps
    return ranks, int(steps[-1]) + 1


class Extensions:
    """Longest common extensions to the right of any two places of a row of words.

    ``words`` are numbers from 0; behind the end stand words that occur once.
    """

    def __init__(self, words: np.ndarray) -> None:
        n = len(words)
        top = int(words.max(initial=-1)) + 1
        self.words = np.concatenate([words, top + np.arange(2 * PERIOD)])
        span = n + PERIOD
        self.places = np.flatnonzero(np.isin(np.arange(span) % PERIOD, COVER))
        self.number = np.full(span + PERIOD, -1)
        self.number[self.places] = np.arange(len(self.places))
        self._sort(top + 2 * PERIOD)

    def _sort(self, kinds: int) -> None:
        """Ranks of the sampled suffixes by their first PERIOD, 2 PERIOD, 4 PERIOD ... words, until all differ."""
        ranks, different, taken = self.words[self.places], kinds, 1
        while taken < PERIOD:
            key, room = ranks, different
            # as many words as one number holds
            while taken < PERIOD and room < (1 << 62) // kinds:
                key, room, taken = key * kinds + self.words[self.places + taken], room * kinds, taken + 1
            ranks, different = _rank(key)
        self.levels = [(PERIOD, ranks)]
        width, count = PERIOD, len(self.places)
        while different < count:
            after = self._after(ranks, width)
            ranks, different = _rank(ranks * (count + 1) + after)
            width *= 2
            self.levels.append((width, ranks))
        order = np.argsort(ranks)
        self.rank = ranks
        common = np.zeros(count, np.int64)
        common[1:] = self._common(order[:-1], order[1:])
        self.minima = [common]
        while (step := 1 << (len(self.minima) - 1)) * 2 <= count:
            last = self.minima[-1]
            self.minima.append(np.minimum(last[:-step], last[step:]))

    def _after(self, ranks: np.ndarray, width: int) -> np.ndarray:
        """The rank ``width`` words further on, from 1; 0 behind the end."""
        place = self.places + width
        inside = place < len(self.number)
        at = np.where(inside, self.number[np.where(inside, place, 0)], -1)
        return np.where(at >= 0, ranks[at] + 1, 0)

    def _common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Common prefixes of neighbouring sampled suffixes, from the ranks of all widths, then word by word."""
        a, b = self.places[a], self.places[b]
        common = np.zeros(len(a), np.int64)
        for width, ranks in reversed(self.levels):
            x, y = a + common, b + common
            inside = np.maximum(x, y) < len(self.number)
            i = np.where(inside, self.number[np.where(inside, x, 0)], -1)
            j = np.where(inside, self.number[np.where(inside, y, 0)], -1)
            common += width * ((i >= 0) & (j >= 0) & (ranks[i] == ranks[j]))
        return common + self._compare(a + common, b + common, np.full(len(a), PERIOD))[0]

    def _compare(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Equal words from two places on, ``limit`` at most; and where all of them are equal."""
        equal = np.zeros(len(a), np.int64)
        left = np.flatnonzero(limit > 0)
        last = len(self.words) - 1
        for t in range(PERIOD):
            same = self.words[np.minimum(a[left] + t, last)] == self.words[np.minimum(b[left] + t, last)]
            left = left[same]
            equal[left] += 1
            left = left[limit[left] > t + 1]
            if not len(left):
                break
        return equal, equal == limit

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The number of equal words from the places ``a`` and ``b`` on, which differ."""
        ahead = _MEET[(a % PERIOD) * PERIOD + b % PERIOD]
        common, through = self._compare(a, b, ahead)
        rest = np.flatnonzero(through)
        i, j = (self.rank[self.number[x[rest] + ahead[rest]]] for x in (a, b))
        low, high = np.minimum(i, j) + 1, np.maximum(i, j) + 1
        level = np.frexp(high - low)[1] - 1
        found = np.empty(len(rest), np.int64)
        for k in np.unique(level):
            at = np.flatnonzero(level == k)
            table = self.minima[k]
            found[at] = np.minimum(table[low[at]], table[high[at] - (1 << int(k))])
        common[rest] += found
        return common


def _grid(n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, periods) that hit every run of a text of ``n`` words, in bounded portions."""
    periods = np.arange(1, n // TIMES + 1)
    steps = np.maximum(SHORTEST - periods, (TIMES - 1) * periods)
    counts = -(-(n - periods) // steps)
    ends = np.cumsum(counts)
    first = 0
    while first < len(periods):
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + _PLACES, "right")))
        some = counts[first:last]
        period = np.repeat(periods[first:last], some)
        index = np.arange(len(period)) - np.repeat(np.cumsum(some) - some, some)
        yield index * np.repeat(steps[first:last], some), period
        first = last


def _near(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, periods) of the grid where the stretch of equal words may be long: _NEAR more are equal on one side."""
    padded = np.concatenate([np.arange(-_NEAR, 0), words, np.arange(-2 * _NEAR, -_NEAR)])
    places, periods = [], []
    for place, period in _grid(len(words)):
        place = place + _NEAR
        hit = np.flatnonzero(padded[place] == padded[place + period])
        place, period = place[hit], period[hit]
        sides = []
        for side in (1, -1):
            left = np.arange(len(place))
            for t in range(1, _NEAR + 1):
                at = place[left] + side * t
                left = left[padded[at] == padded[at + period[left]]]
            sides.append(left)
        hit = np.union1d(*sides)
        places.append(place[hit] - _NEAR)
        periods.append(period[hit])
    return np.concatenate(places), np.concatenate(periods)


def runs_of(texts: list[np.ndarray]) -> np.ndarray:
    """Runs of texts, each an array of word numbers from 0, as rows (text, start, length, period) in order."""
    hits, used, base, kinds = [], [], 0, 0
    for i, words in enumerate(texts):
        if len(words) < SHORTEST:
            continue
        place, period = _near(words)
        if len(place):      # only texts with such places are joined, with numbers that no other text has
            hits.append((place + base, period))
            used.append((i, base, words + kinds))
            base, kinds = base + len(words), kinds + int(words.max()) + 1
    none = np.empty((0, 4), np.int64)
    if not hits:
        return none
    numbers = np.concatenate([words for _, _, words in used])
    right, left = Extensions(numbers), Extensions(numbers[::-1])
    places, periods = (np.concatenate(x) for x in zip(*hits))
    found = []
    for first in range(0, len(places), _PLACES):
        place, period = places[first:first + _PLACES], periods[first:first + _PLACES]
        forward = right(place, place + period)
        backward = left(base - place, base - place - period)
        long = np.flatnonzero(forward + backward >= np.maximum(SHORTEST - period, (TIMES - 1) * period))
        begin = place[long] - backward[long]
        found.append(np.unique(np.stack([begin, place[long] + period[long] + forward[long], period[long]], 1), axis=0))
    rows = np.unique(np.concatenate(found), axis=0)
    if not len(rows):
        return none
    # one stretch with several periods: the smallest, which divides the others
    rows = rows[np.concatenate([[True], (rows[1:, :2] != rows[:-1, :2]).any(1)])]
    bases = np.array([b for _, b, _ in used])
    own = np.searchsorted(bases, rows[:, 0], "right") - 1
    rows = np.stack([np.array([i for i, _, _ in used])[own], rows[:, 0] - bases[own], rows[:, 1] - rows[:, 0], rows[:, 2]], 1)
    return rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]


def _collapsed(words: list[str], runs: np.ndarray) -> str:
    """The words without what any run repeats after its first period."""
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, runs[:, 1] + runs[:, 3], 1)
    np.add.at(change, runs[:, 1] + runs[:, 2], -1)
    return " ".join([words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()])


def _solve(ids: list, texts: list[list[bytes]]) -> pa.RecordBatch:
    numbered = []
    for words in texts:
        known: dict[bytes, int] = {}
        numbered.append(np.array([known.setdefault(w, len(known)) for w in words], np.int64))
    runs = runs_of(numbered)
    bounds = np.searchsorted(runs[:, 0], np.arange(len(texts) + 1))
    kept = []
    for i, words in enumerate(texts):
        own = runs[bounds[i]:bounds[i + 1]]
        whole = [w.decode() for w in words]
        kept.append(_collapsed(whole, own) if len(own) else " ".join(whole))
    fields = pa.StructArray.from_arrays([pa.array(runs[:, k]) for k in (1, 2, 3)], ["start", "length", "period"])
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array([len(words) for words in texts], pa.int64()),
         pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), fields).cast(_RUNS), pa.array(kept, pa.string())],
        ["doc_id", "n_words", "runs", "collapsed"])


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ids, texts, gathered = [], [], 0
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            words = text.as_py().encode().split()       # bytes split at ASCII white space only
            if texts and gathered + len(words) > GROUP_WORDS:
                yield _solve(ids, texts)
                ids, texts, gathered = [], [], 0
            ids.append(doc_id)
            texts.append(words)
            gathered += len(words)
    if texts:
        yield _solve(ids, texts)


def periodic_runs(documents: DataFrame) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) for every row.

    ``runs`` lists start, length and period of every run in order of start and
    period; words are numbered from 0.  ``collapsed`` is the text with one blank
    between words and without what runs repeat after their first period.  Words
    are what ASCII white space separates.  Null and empty texts have no words,
    no runs and an empty ``collapsed``.  Repeated rows each have a result; only
    doc_id and text are read, whatever other columns are called.
    """
    return documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(_find, _SCHEMA)


def best_run(runs: Column) -> Column:
    """The run with the most repetitions, exactly; of equal ones the first, then the one of smaller period.  Null without runs."""
    first = F.get(runs, F.lit(0))
    more = F.aggregate(runs, first, lambda best, run: F.when(
        run["length"] * best["period"] > best["length"] * run["period"], run).otherwise(best))
    return F.when(F.size(runs) > 0, more)


def planted(documents: DataFrame) -> DataFrame:
    """(doc_id, text): every tenth text, by the CRC of its id, made periodic from some word on; the others as they are.

    A null doc_id has no CRC, and its text stays.
    """
    crc = F.crc32(F.col("doc_id").cast("bigint").cast("string"))
    text = F.coalesce("text", F.lit(""))
    words = F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")

    def repeated(w: Column) -> Column:
        # n, a and p are bound once, and so are the words
        n = F.size(w).cast("bigint")
        return F.transform(F.array(F.struct(w.alias("w"), n.alias("n"), (F.col("g") % n).alias("a"))), lambda x: F.transform(
            F.array(F.struct(x["w"].alias("w"), x["a"].alias("a"),
                             (1 + F.floor((x["n"] - x["a"]) / (3 + F.col("g") % 8))).alias("p"))),
            lambda y: F.array_join(F.transform(y["w"], lambda word, i: F.when(i < y["a"], word).otherwise(
                F.get(y["w"], (y["a"] + (i - y["a"]) % y["p"]).cast("int")))), " "))[0])[0]

    changed = F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, repeated(w)).otherwise(F.lit("")))[0]
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"),
                            crc.alias("h"), F.floor(crc / 10).alias("g"))
    return rows.select("doc_id", F.when(F.col("h") % 10 == 0, changed).otherwise(F.col("text")).alias("text"))


def most_repeated(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """``best_run`` of plain (start, length, period), for tests and single texts."""
    return min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
