"""Periodic runs of words, found on the Re-Pair grammar of each text.

A run is a stretch of words with smallest period q (words q apart are equal),
of at least max(min_length, 2 * q) words, that no neighbouring word extends.

Method, per text. Re-Pair joins the most frequent pair of neighbouring
symbols into a nonterminal until no pair is there twice (of equally frequent
pairs the one that came first, which keeps the grammar shallow). What is left
is cut in halves by a balanced tree of further nonterminals. A run that
stands in a nonterminal's text and in neither child's crosses the boundary
between the children; those are computed once a nonterminal, at one of its
positions: for each period q, how far the words on both sides of the boundary
agree with those q on (or q back) tells how far a run of period q reaches.
The agreement of two places is read from ranks of all blocks of 2**k words,
longest first. Then every nonterminal's runs are moved to all places where the
grammar derives it, and intervals of one period that lie in another are
merged into it: of a run, the nonterminal that holds it whole gives all, and
those below give the parts.

Re-Pair never joins a pair that occurs once, and a run is made of pairs that
occur twice (but for one in the middle of a square). So words of which both
pairs occur once are set aside before; only stretches of min_length words
or more that hold none are compressed.

Cost. n log n steps in numpy for the runs, and a heap of pairs in Python for the
grammar of what is left. Memory is bounded by one text: boundaries are taken
in blocks of ``BLOCK`` (boundary, period) cells.

Edge cases. Null or empty text has no words and no runs. Texts are taken whole,
whatever their length. Repeated rows each get their runs. An empty table gives
no rows. Other columns come back in ``row``, whatever their names.
"""

from __future__ import annotations

from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructType

from riskspark.llm.common import chunks, ship_package

BLOCK = 1 << 21
CHUNK = 1 << 20
RUN = ArrayType(StructType().add("start", LongType()).add("length", LongType()).add("period", LongType()))


def word_numbers(words: list[bytes]) -> np.ndarray:
    """Equal words get equal numbers, from 0 in order of their first place."""
    seen: dict[bytes, int] = {}
    return np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))


def repeated_stretches(ids: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Stretches of ``least`` words or more whose every word belongs to a pair that occurs twice."""
    n = len(ids)
    if n < least:
        return []
    if least < 3:                        # a word said twice is one pair
        return [(0, n)] if n else []
    pairs = ids[:-1] * (ids.max() + 1) + ids[1:]
    order = np.argsort(pairs, kind="stable")
    same = pairs[order[1:]] == pairs[order[:-1]]
    twice = np.zeros(n - 1, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    held = np.zeros(n + 2, np.int8)
    held[1:n] |= twice
    held[2:n + 1] |= twice
    edges = np.flatnonzero(np.diff(held))
    return [(a, b) for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()) if b - a >= least]


def repair(symbols: list[int], fresh: int) -> tuple[list[int], list[tuple[int, int]]]:
    """(what is left, rules): rule k is the pair that nonterminal ``fresh`` + k stands for. Symbols below 0 join nothing."""
    symbols, n = symbols[:], len(symbols)
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))
    places: dict[tuple[int, int], list[int]] = {}
    for i in range(n - 1):
        a, b = symbols[i], symbols[i + 1]
        if a >= 0 and b >= 0:
            places.setdefault((a, b), []).append(i)
    agenda = [(-len(p), k, pair) for k, (pair, p) in enumerate(places.items()) if len(p) > 1]
    heapify(agenda)
    came, rules, gone = len(agenda), [], -1 << 60
    while agenda:
        count, k, pair = heappop(agenda)
        a, b = pair
        valid, times, end = [], 0, -1
        for i in places.pop(pair):
            if symbols[i] == a and (j := after[i]) < n and symbols[j] == b:
                valid.append(i)
                if i >= end:                           # a pair of equals doesn't overlap itself
                    times, end = times + 1, j + 1
        if times < 2:
            continue
        if times < -count:
            places[pair] = valid
            heappush(agenda, (-times, k, pair))
            continue
        new = fresh + len(rules)
        rules.append(pair)
        made: dict[tuple[int, int], list[int]] = {}
        for i in valid:
            j = after[i]
            if symbols[i] != a or j >= n or symbols[j] != b:
                continue
            symbols[i], symbols[j] = new, gone
            after[i] = over = after[j]
            if over < n:
                before[over] = i
                if symbols[over] >= 0:
                    made.setdefault((new, symbols[over]), []).append(i)
            left = before[i]
            if left >= 0 and symbols[left] >= 0:
                made.setdefault((symbols[left], new), []).append(left)
        for p, at in made.items():
            if len(at) > 1:
                at.sort()
                places[p] = at
                heappush(agenda, (-len(at), came, p))
                came += 1
    return [s for s in symbols if s != gone], rules


class Agreement:
    """How many words agree from two places on, or up to two places, within one sequence of numbers."""

    def __init__(self, ids: np.ndarray):
        self.ranks, size, n = [ids], 1, len(ids)
        while 2 * size <= n:
            last = self.ranks[-1]
            both = last[:-size] * (int(last.max()) + 1) + last[size:]
            self.ranks.append(np.unique(both, return_inverse=True)[1].astype(np.int64))
            size *= 2

    def forward(self, x: np.ndarray, y: np.ndarray, most: np.ndarray) -> np.ndarray:
        got = np.zeros(len(x), np.int64)
        for k in range(len(self.ranks) - 1, -1, -1):
            rank, last = self.ranks[k], len(self.ranks[k]) - 1
            fits = got + (1 << k) <= most
            got += (fits & (rank[np.minimum(x + got, last)] == rank[np.minimum(y + got, last)])) << k
        return got

    def backward(self, x: np.ndarray, y: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Of the words before ``x`` and before ``y``."""
        got = np.zeros(len(x), np.int64)
        for k in range(len(self.ranks) - 1, -1, -1):
            rank, size = self.ranks[k], 1 << k
            fits = got + size <= most
            got += (fits & (rank[np.maximum(x - got - size, 0)] == rank[np.maximum(y - got - size, 0)])) << k
        return got


def crossing_runs(ids: np.ndarray, agree: Agreement, first: np.ndarray, middle: np.ndarray, end: np.ndarray, least: int):
    """(node, start, stop, period) of the runs of ids[first:end] that cross ``middle``, of each node."""
    found = []
    widths = np.maximum(end - middle, middle - first)
    at = 0
    while at < len(first):
        upto = at + max(1, int(np.searchsorted(np.cumsum(widths[at:]), BLOCK, "right")))
        width = widths[at:upto]
        node = np.repeat(np.arange(at, upto), width)
        q = np.arange(len(node)) - np.repeat(np.cumsum(width) - width, width) + 1
        lo, c, hi = first[node], middle[node], end[node]
        top = len(ids) - 1
        # The run has a whole period right of the boundary: the word before it stands again q on. Or left of it: the word behind does q back.
        right = (c + q <= hi) & (ids[np.minimum(c + q - 1, top)] == ids[c - 1])
        left = (c - q >= lo) & (ids[np.maximum(c - q, 0)] == ids[c])
        for keep, x in ((right, c), (left, c - q)):
            k = np.flatnonzero(keep)
            if not len(k):
                continue
            kq, kx, klo, khi = q[k], x[k], lo[k], hi[k]
            ahead = agree.forward(kx, kx + kq, khi - kx - kq)
            back = agree.backward(kx, kx + kq, kx - klo)
            start, stop = kx - back, kx + kq + ahead
            good = (ahead + back >= kq) & (stop - start >= least)
            found.append(np.stack([node[k], start, stop, kq], 1)[good])
        at = upto
    if not found:
        return np.zeros((0, 4), np.int64)
    all_found = np.concatenate(found)
    all_found = all_found[np.lexsort(all_found.T[::-1])]         # by node, start, stop, period
    new = np.ones(len(all_found), bool)                            # of one interval the smallest period
    new[1:] = (all_found[1:, :3] != all_found[:-1, :3]).any(1)
    return all_found[new]


def runs(ids: np.ndarray, least: int = 12) -> np.ndarray:
    """(start, length, period) of all runs of a text's word numbers, by start, then period."""
    stretches = repeated_stretches(ids, least)
    if not stretches:
        return np.zeros((0, 3), np.int64)
    # the stretches side by side, with a number of its own between two
    text, begins, at = [], [], 0
    for k, (a, b) in enumerate(stretches):
        text += [ids[a:b], [-1 - k]]
        begins.append(at)
        at += b - a + 1
    flat = np.concatenate(text)
    fresh = int(ids.max()) + 1
    rest, rules = repair(flat.tolist(), fresh)
    sizes = dict.fromkeys(range(fresh), 1)
    for k, (a, b) in enumerate(rules):
        sizes[fresh + k] = sizes[a] + sizes[b]
    places: dict[int, list[np.ndarray]] = {}
    nodes: list[tuple[int, int, int]] = []            # (first, middle, end) at one place of a nonterminal
    moved: list[np.ndarray] = []                      # and by how much its other places lie further

    def seen(symbol: int, at: np.ndarray):
        if sizes[symbol] >= least:
            places.setdefault(symbol, []).append(at)

    # the tree over what is left: each stretch in halves
    at, parts = 0, [[]]
    for s in rest:
        if s < 0:
            at += 1
            parts.append([])
        else:
            parts[-1].append((s, at))
            at += sizes[s]
    for part in parts:
        todo = [(0, len(part))] if part else []
        while todo:
            i, j = todo.pop()
            if j - i == 1:
                seen(part[i][0], np.array([part[i][1]]))
                continue
            lo, hi = part[i][1], part[j - 1][1] + sizes[part[j - 1][0]]
            if hi - lo < least:
                continue
            m = (i + j) // 2
            nodes.append((lo, part[m][1], hi))
            moved.append(np.zeros(1, np.int64))
            todo += [(i, m), (m, j)]
    # nonterminals from the last rule on: all places of a rule are known when its turn comes
    for k in range(len(rules) - 1, -1, -1):
        if (found := places.pop(fresh + k, None)) is None:
            continue
        at = found[0] if len(found) == 1 else np.concatenate(found)
        a, b = rules[k]
        first = int(at[0])
        nodes.append((first, first + sizes[a], first + sizes[fresh + k]))
        moved.append(at - first)
        seen(a, at)
        seen(b, at + sizes[a])
    if not nodes:
        return np.zeros((0, 3), np.int64)
    numbers = np.unique(flat, return_inverse=True)[1].astype(np.int64)
    first, middle, end = np.array(nodes, np.int64).T
    own = crossing_runs(numbers, Agreement(numbers), first, middle, end, least)
    if not len(own):
        return np.zeros((0, 3), np.int64)
    times = np.array([len(m) for m in moved])[own[:, 0]]
    by = np.concatenate([moved[k] for k in own[:, 0].tolist()])
    each = np.repeat(own, times, axis=0)
    start, stop, period = each[:, 1] + by, each[:, 2] + by, each[:, 3]
    # merge: of one period, what lies in an interval that begins no later goes
    order = np.lexsort((-stop, start, period))
    start, stop, period = start[order], stop[order], period[order]
    reach = np.maximum.accumulate(stop + period * (2 * len(flat)))
    keep = np.ones(len(start), bool)
    keep[1:] = stop[1:] + period[1:] * (2 * len(flat)) > reach[:-1]
    start, stop, period = start[keep], stop[keep], period[keep]
    begins = np.array(begins)
    k = np.searchsorted(begins, start, "right") - 1
    out = np.stack([start - begins[k] + np.array([a for a, _ in stretches])[k], stop - start, period], 1)
    return out[np.lexsort((out[:, 2], out[:, 0]))]


def after_first_period(found: np.ndarray, n: int) -> np.ndarray:
    """Whether a word is in some run after that run's first period."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, found[:, 0] + found[:, 2], 1)
    np.add.at(edge, found[:, 0] + found[:, 1], -1)
    return np.cumsum(edge[:n]) > 0


def find(docs: DataFrame, text: str = "text", least: int = 12) -> DataFrame:
    """(row, n_words, runs, collapsed): ``runs`` by start, then period; ``collapsed`` is the text's words but those of
    a run after its first period, joined by spaces. ``row`` holds the other columns."""
    ship_package(docs.sparkSession)
    carried = [F.col(f"`{c}`") for c in docs.columns if c != text] or [F.lit(None).cast("int").alias("none")]
    rows = docs.select(F.struct(*carried).alias("row"), F.col(f"`{text}`").cast("string").cast("binary").alias("text"))
    schema = rows.select("row").schema.add("n_words", "long").add("runs", RUN).add("collapsed", "binary")
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def judged(data: bytes | None):
        words = data.split() if data else []          # of bytes, at the six blanks
        found = runs(word_numbers(words), least)
        if len(found):
            lost = after_first_period(found, len(words))
            words_kept = [w for w, x in zip(words, lost.tolist()) if not x]
        else:
            words_kept = words
        return len(words), [{"start": a, "length": b, "period": c} for a, b, c in found.tolist()], b" ".join(words_kept)

    def run(batches):
        for batch in batches:
            for first, end in chunks(pc.fill_null(pc.binary_length(batch["text"]), 0).to_pylist(), CHUNK):
                part = batch.slice(first, end - first)
                out = [judged(t) for t in part["text"].to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part["row"], pa.array([n for n, _, _ in out], pa.int64()), pa.array([r for _, r, _ in out], kind),
                     pa.array([t for _, _, t in out], pa.binary())], names=["row", "n_words", "runs", "collapsed"])

    return rows.mapInArrow(run, schema).withColumn("collapsed", F.col("collapsed").cast("string"))
