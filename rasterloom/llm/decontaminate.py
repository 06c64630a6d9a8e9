"""Benchmark decontamination: CGK embedding, bit-sampling LSH, exact edit verification.

Texts and items are sequences of words. The CGK embedding walks over a
sequence: at step t it emits the word under the cursor and then moves on or
stays, by a random bit of (t, word). Sequences at a small edit distance get
embeddings at a small Hamming distance, so LSH by sampled embedding positions
finds them. An item's walk covers the whole item, two steps a word on average;
the sampled steps are drawn uniformly from all of it. In a document a walk
starts at every word, as long as the longest item needs, so every item-sized
window is embedded. Several sets of steps are sampled from each walk, and
several walks are drawn.

Walks that meet at a word go on as one, as their moves depend on step and word
alone. All walks of a text are therefore advanced together and those that met
are kept once; after t steps about one in sqrt(pi t) is left. The words at the
sampled steps are compared in turn, against items of about one length at a time,
and only walks that still agree with some item are looked up further. No walk
starts where the text has too few words of such items for a near copy to begin.

A match aligns the item with the document and is verified there by Myers'
bit-parallel edit distance. Before that, the place must hold enough of the
item's words in any order, without which it cannot be near.
The number of walks comes from the target recall, measured for each length of
item on copies with the largest allowed number of random word edits. Lengths that
other such copies show short of the target, and items too long to be tried, are
found exactly: of edits + 1 pieces of an item one is in any near copy unchanged.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rasterloom.llm.encoding import pieces

WORD = re.compile(r"\w+")
#: Scripts written without spaces between words: Thai and Lao, Burmese, Khmer, Tai, kana and Bopomofo, Han.
_UNSPACED = (
    "\u0e00-\u0eff\u1000-\u109f\ua9e0-\ua9ff\uaa60-\uaa7f\u1780-\u17ff\u1950-\u19df\u1a20-\u1aaf\u3005-\u3007\u3021-\u3029\u3031-\u303c"
    "\u3041-\u312f\u31a0-\u31bf\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U0001aff0-\U0001b16f\U00020000-\U0003ffff"
)
UNSPACED = re.compile(f"[{_UNSPACED}]")
#: Their characters are words of their own.
WORD_OR_CHARACTER = re.compile(rf"[^\W{_UNSPACED}]+|(?=\w)[{_UNSPACED}]")
#: Words of the items searched for in one pass over the documents, if more than one item; more go in several passes.
BLOCK_WORDS = 1 << 20
#: Sampled steps of a set, how many of them must fall into an item, sets of a walk, walks at most.
SAMPLES, LEAST_SAMPLES, SETS, MAX_WALKS = 3, 2, 12, 8
#: Words of a piece that are compared.
PIECE_WORDS = 10
#: Edited items of each length class that stop the walks, and as many others that measure the recall.
TRIALS = 400
#: Words of copies that are searched at once.
TRIAL_WORDS = 1 << 16
#: Longer items are not tried but found exactly.
TRIED_WORDS = 256
#: Walks are added until the length classes short of the recall hold no more than this share of the items; those are found exactly.
STRAGGLERS = 0.1
#: Words of documents handled at once.
GROUP_WORDS = 1 << 18
#: Words are told apart modulo this in an item's bag; clashes only let more candidates through.
BAG = 1021
#: Stands between documents and equals no item's word.
BETWEEN = -1


def split_words(text: str) -> list[str]:
    return (WORD if text.isascii() or not UNSPACED.search(text) else WORD_OR_CHARACTER).findall(text)


def words_of(text: str | None) -> list[str]:
    return split_words(text.lower()) if text else []


def word_ids(text: str | None, vocabulary: dict[str, int]) -> np.ndarray:
    """The text's words as numbers of the vocabulary, 0 for others."""
    get = vocabulary.get
    found = [np.array([get(w, 0) for w in split_words(p)], np.int64) for p in pieces((text or "").lower())]
    return found[0] if len(found) == 1 else np.concatenate(found)


def allowed_edits(words: int, similarity: float) -> int:
    return math.floor(words * (1 - similarity) + 1e-9)


def window_distance(item: list[int], masks: dict[int, int], window: list[int]) -> tuple[int, int]:
    """(least edit distance of the item to any stretch of the window, where that stretch ends)."""
    m = len(item)
    full, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best, end = full, 0, m, m, 0
    for i, w in enumerate(window):
        eq = masks.get(w, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph, mh = mv | ~(xh | pv) & full, pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph, mh = ph << 1 & full, mh << 1 & full
        pv, mv = mh | ~(xv | ph) & full, ph & xv
        if score < best:
            best, end = score, i + 1
    return best, end


@dataclass
class Samples:
    """Words compared in turn, and the items' keys of them."""

    band: int  # number of the band of item lengths
    steps: np.ndarray
    first: np.ndarray  # words that some item has at the first step
    prefixes: list[np.ndarray]  # sorted keys of the items that reach step j and go on
    complete: list[tuple[np.ndarray, np.ndarray, np.ndarray]]  # keys, items, place in the item at the first step, of those whose last step is j


@dataclass
class Walk:
    """``bits[t // 64, word]`` holds the moves of 64 steps; the last column, that of BETWEEN, never moves."""

    bits: np.ndarray
    sets: list[Samples]

    def moves(self, t: int) -> np.ndarray:
        return (self.bits[t >> 6] >> np.uint64(t & 63) & np.uint64(1)).astype(np.int64)


@dataclass
class ItemIndex:
    item_ids: list[int | None]
    items: list[list[int]]
    vocabulary: dict[str, int]
    edits: list[int]
    walks: list[Walk]
    pieces: Samples | None = None  # of the items that are found exactly
    recalls: dict[int, float] = field(default_factory=dict)  # measured, by length class, of the items that walks find
    exact_items: int = 0

    def bands(self) -> list[Band]:
        """Of the items that are tried, by number of the band."""
        lengths = [len(i) for i in self.items]
        tops = band_tops(max((n for n in lengths if n <= TRIED_WORDS), default=1))
        bands = [Band([], np.zeros(len(self.vocabulary) + 2, bool)) for _ in tops]
        for item, n, edits in zip(self.items, lengths, self.edits, strict=True):
            if n <= TRIED_WORDS:
                band = bands[int(np.searchsorted(tops, n))]
                band.words[item] = True
                if (n, edits) not in band.sizes:
                    band.sizes.append((n, edits))
        return bands

    def bags(self) -> np.ndarray:
        """[item, word % BAG]: whether the item holds such a word."""
        out = np.zeros((len(self.items), BAG), bool)
        for n, item in enumerate(self.items):
            out[n, np.array(item) % BAG] = True
        return out

    def masks(self) -> list[dict[int, int]]:
        """For each item the places of its words, as bits."""
        out = []
        for item in self.items:
            mask: dict[int, int] = {}
            for i, w in enumerate(item):
                mask[w] = mask.get(w, 0) | 1 << i
            out.append(mask)
        return out


def _mix(key, word):
    """Rolls a word into 40-bit keys; the product stays inside 63 bits."""
    return (key * 1_000_003 + word + 1) & ((1 << 40) - 1)


def band_tops(words: int) -> list[int]:
    """The longest item of each band, up to one that holds items of so many words; each is about a third longer than the one before."""
    tops = [1]
    while tops[-1] < words:
        tops.append(max(tops[-1] + 1, tops[-1] * 4 // 3))
    return tops


def _walk(rng: np.random.Generator, items: list[list[int]], chosen: np.ndarray, vocabulary: int) -> Walk:
    """A walk with SETS sets of sampled steps for each band of the chosen items."""
    lengths = np.array([len(i) for i in items])
    tops = band_tops(int(lengths[chosen].max()))
    bands = np.searchsorted(tops, lengths)
    bits = rng.integers(0, 1 << 64, size=(-(-2 * tops[-1] // 64), vocabulary + 2), dtype=np.uint64)
    bits[:, -1] = 0
    walk = Walk(bits, [])
    for band in np.unique(bands[chosen]).tolist():
        members = np.flatnonzero(chosen & (bands == band))
        ends = np.cumsum(lengths[members] + 1) - 1
        begins = ends - lengths[members]
        words = np.array([w for n in members for w in (*items[n], BETWEEN)], np.int64)
        cursor, cursors = begins.copy(), []
        for t in range(2 * tops[band]):
            cursors.append(cursor)
            cursor = cursor + walk.moves(t)[words[cursor]]
        for _ in range(SETS):
            steps = np.sort(rng.choice(2 * tops[band], min(SAMPLES, 2 * tops[band]), replace=False))
            found = np.array([words[cursors[t]] for t in steps])
            enough = (found >= 0).sum(axis=0) >= min(LEAST_SAMPLES, tops[band])
            walk.sets.append(_samples(band, steps, list(found[:, enough]), members[enough], (cursors[steps[0]] - begins)[enough]))
    return walk


def _samples(band: int, steps: np.ndarray, found: list[np.ndarray], members: np.ndarray, offsets: np.ndarray) -> Samples:
    """``found``: the members' words at each step, BETWEEN where the item has ended."""
    key, prefixes, complete = np.zeros(len(members), np.int64), [], []
    for j, here in enumerate(found):
        inside = here >= 0
        key = np.where(inside, _mix(key, here), key)
        more = found[j + 1] >= 0 if j + 1 < len(found) else np.zeros(len(members), bool)
        last = np.flatnonzero(inside & ~more)
        last = last[np.argsort(key[last], kind="stable")]
        prefixes.append(np.unique(key[more]))
        complete.append((key[last], members[last], offsets[last]))
    return Samples(band, steps, np.unique(found[0][found[0] >= 0]), prefixes, complete)


def _pieces(items: list[list[int]], edits: list[int], chosen: np.ndarray) -> Samples:
    """Of ``edits + 1`` pieces of an item one has no edit; of one longer than PIECE_WORDS the beginning is compared."""
    members, starts, held = [], [], []
    for n in np.flatnonzero(chosen).tolist():
        item, parts = items[n], edits[n] + 1
        for i in range(parts):
            members.append(n)
            starts.append(len(item) * i // parts)
            piece = item[starts[-1] : len(item) * (i + 1) // parts][:PIECE_WORDS]
            held.append(piece + [BETWEEN] * (PIECE_WORDS - len(piece)))
    return _samples(0, np.arange(PIECE_WORDS), list(np.array(held, np.int64).T), np.array(members), np.array(starts))


def _without(samples: Samples, dropped: np.ndarray) -> Samples:
    """Without the dropped items; keys on the way to them may stay."""
    complete = [tuple(c[~dropped[who]] for c in (keys, who, start)) for keys, who, start in samples.complete]
    return Samples(samples.band, samples.steps, samples.first, samples.prefixes, complete)


def _among(keys: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if len(ordered) == 0:
        return np.zeros(len(keys), bool)
    at = np.searchsorted(ordered, keys)
    at[at == len(ordered)] = 0
    return ordered[at] == keys


def _agreeing(samples: Samples, starts: np.ndarray, cursor: np.ndarray, here: np.ndarray, later) -> list[tuple[np.ndarray, np.ndarray]]:
    """(items, word at which each would begin) for walks that agree at all steps.

    ``starts`` name the walks, ``cursor`` and ``here`` are their places and words at the first step;
    ``later(j, starts)`` gives their words at step j.
    """
    key, out = np.zeros(len(starts), np.int64), []
    for j in range(len(samples.steps)):
        if len(starts) == 0:
            break
        if j:
            here = later(j, starts)
        key = _mix(key, here)
        keys, who, offset = samples.complete[j]
        if len(keys):
            lo, hi = np.searchsorted(keys, key, "left"), np.searchsorted(keys, key, "right")
            hits = np.flatnonzero((hi > lo) & (here >= 0))
            counts = (hi - lo)[hits]
            rows = np.repeat(lo[hits], counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            out.append((who[rows], np.repeat(cursor[hits], counts) - offset[rows]))
        # The rest must agree with an item that goes on.
        keep = np.flatnonzero(_among(key, samples.prefixes[j]) & (here >= 0))
        starts, cursor, key = starts[keep], cursor[keep], key[keep]
    return out


@dataclass
class Band:
    """Items of about one length: (length, edits) of each, and which words they have."""

    sizes: list[tuple[int, int]]
    words: np.ndarray

    def openings(self, words: np.ndarray) -> np.ndarray:
        """Whether a near copy of one of the items could begin at the word or up to three words from it.

        A copy holds all the item's words but ``edits``, in at most ``length + edits`` words.
        """
        n = len(words)
        known = np.concatenate([[0], np.cumsum(self.words[words], dtype=np.int32)])
        found = np.zeros(n, bool)
        for size, slack in self.sizes:
            span = min(n, size + slack)
            found[: n - span + 1] |= known[span:] - known[: n + 1 - span] >= size - slack
            found[n - span + 1 :] |= known[n] - known[n - span + 1 : n] >= size - slack
        near = found.copy()
        for d in (1, 2, 3):
            near[d:] |= found[:-d]
            near[:-d] |= found[d:]
        return near & (words >= 0)


def counted(opens: list[np.ndarray]) -> list[np.ndarray]:
    """How many openings there are before each word."""
    return [np.concatenate([[0], np.cumsum(o, dtype=np.int32)]) for o in opens]


def walk_candidates(words: np.ndarray, walk: Walk, opens: list[np.ndarray], counts: list[np.ndarray]) -> np.ndarray:
    """[item, word at which it would begin] of the walks that agree with an item at the steps of some set.

    ``words`` holds 0 for words of no item, BETWEEN after each document; ``opens`` says by band where walks start, ``counts`` how many do before.
    """
    last = {}
    for samples in walk.sets:
        last[samples.band] = max(last.get(samples.band, 0), int(samples.steps[-1]))
    needed = {int(t) for s in walk.sets for t in s.steps}
    begun, going, at = False, {}, {}
    starts = cursor = np.empty(0, np.int64)
    size = len(walk.bits[0])
    for t in range(max(needed, default=-1) + 1):
        still = frozenset(band for band in last if last[band] >= t)
        if still != going:  # walks of the bands that are done are dropped
            going = still
            if not begun:
                starts = cursor = np.flatnonzero(np.logical_or.reduce([opens[band] for band in going]))
                begun = True
            else:
                held = np.append(starts[1:], len(words))
                kept = np.logical_or.reduce([counts[band][held] > counts[band][starts] for band in going])
                starts, cursor = starts[kept], cursor[kept]
        here = words[cursor]
        if t in needed:
            at[t] = (starts, cursor, here)
        cursor = cursor + walk.moves(t)[here]
        if t < 8 or t % 4 == 0:  # one of those that met
            apart = np.concatenate([[True], cursor[1:] != cursor[:-1]]) if len(cursor) else np.empty(0, bool)
            starts, cursor = starts[apart], cursor[apart]
    out, first = [], np.zeros(size, bool)
    for samples in walk.sets:
        began, place, here = at[int(samples.steps[0])]
        first[samples.first] = True
        left = np.flatnonzero(first[here])
        first[samples.first] = False
        held, opened = np.append(began[1:], len(words))[left], counts[samples.band]
        left = left[opened[held] > opened[began[left]]]

        def later(j: int, of: np.ndarray, steps=samples.steps) -> np.ndarray:
            then, _, held = at[int(steps[j])]
            return held[np.searchsorted(then, of, "right") - 1]

        out += _agreeing(samples, began[left], place[left], here[left], later)
    return _pairs(out)


def piece_candidates(words: np.ndarray, pieces: Samples, vocabulary: int) -> np.ndarray:
    first = np.zeros(vocabulary + 2, bool)
    first[pieces.first] = True
    starts = np.flatnonzero(first[words])
    return _pairs(_agreeing(pieces, starts, starts, words[starts], lambda j, of: words[np.minimum(of + j, len(words) - 1)]))


def _pairs(found: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    if not found:
        return np.empty((0, 2), np.int64)
    return np.unique(np.stack([np.concatenate(c) for c in zip(*found, strict=True)], axis=1), axis=0)


def candidates(words: np.ndarray, index: ItemIndex, bands: list[Band]) -> np.ndarray:
    pairs = []
    if index.walks:
        opens = [band.openings(words) for band in bands]
        counts = counted(opens)
        pairs = [walk_candidates(words, walk, opens, counts) for walk in index.walks]
    if index.pieces is not None:
        pairs.append(piece_candidates(words, index.pieces, len(index.vocabulary)))
    return np.unique(np.concatenate(pairs), axis=0) if pairs else np.empty((0, 2), np.int64)


def _edited(rng: np.random.Generator, item: list[int], edits: int) -> list[int]:
    out = list(item)
    for _ in range(edits):
        kind, at = rng.integers(3), int(rng.integers(len(out))) if out else 0
        if kind == 0 and out:
            out[at] = 0
        elif kind == 1 and out:
            del out[at]
        else:
            out.insert(at, 0)
    return out


def build_index(rows: list[tuple[int | None, str | None]], similarity: float, recall: float, seed: int) -> ItemIndex:
    """Index of the items that have a word."""
    vocabulary: dict[str, int] = {}
    ids, items = [], []
    for item_id, text in rows:
        words = words_of(text)
        if words:
            ids.append(item_id)
            items.append([vocabulary.setdefault(w, len(vocabulary) + 1) for w in words])
    index = ItemIndex(ids, items, vocabulary, [allowed_edits(len(i), similarity) for i in items], [])
    if not items:
        return index
    exact = np.ones(len(items), bool)
    if recall < 1:
        exact = _add_walks(index, recall, np.random.default_rng(seed))
    index.exact_items = int(exact.sum())
    if index.exact_items:
        index.walks = [] if exact.all() else [Walk(w.bits, [_without(s, exact) for s in w.sets]) for w in index.walks]
        index.pieces = _pieces(items, index.edits, exact)
    return index


def length_class(words: int) -> int:
    """The number of words up to 64, then steps of a fifth."""
    return words if words <= 64 else 64 + math.ceil(4 * math.log2(words / 64))


class _Trials:
    """Edited copies of items, TRIALS of each class, and which of them some walk has found."""

    def __init__(self, rng: np.random.Generator, index: ItemIndex, members: list[np.ndarray]):
        self.edits, self.lengths = np.array(index.edits), np.array([len(i) for i in index.items])
        self.item = np.concatenate([rng.choice(m, TRIALS) for m in members])
        self.found, self.parts, bands = np.zeros(len(self.item), bool), [], index.bands()
        words, begin, end, first = [], [], [], 0
        for n, item in enumerate(self.item.tolist()):
            begin.append(len(words))
            words += _edited(rng, index.items[item], index.edits[item])
            end.append(len(words))
            words.append(BETWEEN)
            if len(words) >= TRIAL_WORDS or n == len(self.item) - 1:
                held = np.array(words, np.int64)
                self.parts.append((first, held, np.array(begin), np.array(end), [band.openings(held) for band in bands]))
                words, begin, end, first = [], [], [], n + 1

    def search(self, walk: Walk) -> np.ndarray:
        """The share found so far, by class; a copy is found if all of it is in the window that would be verified."""
        for first, words, begin, end, opens in self.parts:
            who, where = walk_candidates(words, walk, opens, counted(opens)).T
            slack = self.edits[who] + 1
            trial = np.maximum(np.searchsorted(begin, where + slack, "right") - 1, 0)
            whole = (where - slack <= begin[trial]) & (end[trial] <= where + self.lengths[who] + slack)
            self.found[first + trial[whole & (self.item[first + trial] == who)]] = True
        return self.found.reshape(-1, TRIALS).mean(axis=1)


def _add_walks(index: ItemIndex, recall: float, rng: np.random.Generator) -> np.ndarray:
    """Adds walks until the length classes but a few stragglers have the recall; true for the items that are left without it."""
    exact = np.array([len(i) > TRIED_WORDS for i in index.items])
    classes = np.array([length_class(len(i)) for i in index.items])
    names = np.unique(classes[~exact])
    members = [np.flatnonzero((classes == c) & ~exact) for c in names]
    if not members:
        return exact
    tried = ~exact
    sizes = np.array([len(m) for m in members])
    stopping, measuring = _Trials(rng, index, members), _Trials(rng, index, members)
    while len(index.walks) < MAX_WALKS:
        walk = _walk(rng, index.items, tried, len(index.vocabulary))
        index.walks.append(walk)
        reached, measured = stopping.search(walk), measuring.search(walk)
        # Half the misses that are allowed, or chance would leave many classes just short of the target.
        short = 1 - reached > (1 - recall) / 2 + 1e-9
        if sizes[short].sum() <= STRAGGLERS * sizes.sum():
            break
    for name, m, share in zip(names.tolist(), members, measured, strict=True):
        if share < recall:
            exact[m] = True
        else:
            index.recalls[name] = float(share)
    return exact


def holds_enough(index: ItemIndex, bags: np.ndarray, words: np.ndarray, pairs: np.ndarray, chunk: int = 1 << 14) -> np.ndarray:
    """Whether the window of each (item, place) holds as many words of the item as ``words - edits``."""
    lengths, edits = np.array([len(i) for i in index.items]), np.array(index.edits)
    known = np.concatenate([[0], np.cumsum(words > 0)])
    who, at = pairs.T
    low, high = np.clip(at - edits[who] - 1, 0, len(words)), np.clip(at + lengths[who] + edits[who] + 1, 0, len(words))
    likely = np.flatnonzero(known[high] - known[low] >= lengths[who] - edits[who])
    keep = np.zeros(len(pairs), bool)
    for lo in range(0, len(likely), chunk):
        rows = likely[lo : lo + chunk]
        who, at = pairs[rows].T
        slack, size = edits[who] + 1, lengths[who]
        places = (at - slack)[:, None] + np.arange(int((size + 2 * slack).max()))
        inside = (places < (at + size + slack)[:, None]) & (places >= 0) & (places < len(words))
        held = words[np.where(inside, places, 0)]
        found = bags[who[:, None], held % BAG] & (held > 0) & inside
        keep[rows] = found.sum(axis=1) >= size - edits[who]
    return keep


def search(index: ItemIndex, bags: np.ndarray, masks: list[dict[int, int]], bands: list[Band], docs: list[np.ndarray]) -> list[list[tuple[int | None, int, int, int]]]:
    """Per document (its word numbers): (item id, item's words, edits, first word) of each item found, at its least distance."""
    out: list[list[tuple]] = [[] for _ in docs]
    if not index.items:
        return out
    gap = np.full(1, BETWEEN, np.int64)
    sizes = np.array([len(d) for d in docs], np.int64)
    end = np.cumsum(sizes + 1) - 1
    begin = end - sizes
    words = np.concatenate([part for d in docs for part in (d, gap)]) if docs else gap[:0]
    best: dict[tuple[int, int], tuple[int, int]] = {}
    distinct = candidates(words, index, bands)
    for n, at in distinct[holds_enough(index, bags, words, distinct)].tolist():
        item, edits = index.items[n], index.edits[n]
        slack = edits + 1
        # The window may begin before its document where words were deleted from it.
        doc = int(np.searchsorted(begin, at + slack, "right")) - 1
        for d in {max(doc, 0), max(int(np.searchsorted(begin, at, "right")) - 1, 0)}:
            lo, hi = max(int(begin[d]), at - slack), min(int(end[d]), at + len(item) + slack)
            held = best.get((d, n))
            if hi <= lo or held is not None and held[0] == 0:
                continue
            window = words[lo:hi].tolist()
            if len(masks[n].keys() & set(window)) < len(masks[n]) - edits:  # an edit takes away one of the item's different words at most
                continue
            distance, stop = window_distance(item, masks[n], window)
            if distance <= edits and (held is None or distance < held[0]):
                best[d, n] = (distance, max(0, lo + stop - len(item) - int(begin[d])))
    for (d, n), (distance, first) in sorted(best.items()):
        out[d].append((index.item_ids[n], len(index.items[n]), distance, first))
    return out


LEAKS = "array<struct<item_id:bigint,item_words:int,edits:int,first_word:int>>"
_LEAK = {"item_id": pa.int64(), "item_words": pa.int32(), "edits": pa.int32(), "first_word": pa.int32()}
_LEAK_TYPE = pa.list_(pa.struct(list(_LEAK.items())))


def searcher(index: ItemIndex) -> Callable[[pa.Array], list[list[tuple[int | None, int, int, int]]]]:
    """A function of texts that gives what ``search`` finds in each."""
    bags, masks, bands = index.bags(), index.masks(), index.bands()

    def found_in(texts: pa.Array) -> list[list[tuple]]:
        found: list[list[tuple]] = []
        held: list[np.ndarray] = []
        size = 0
        for t in texts:
            held.append(word_ids(t.as_py(), index.vocabulary))
            size += len(held[-1])
            if size >= GROUP_WORDS:
                found += search(index, bags, masks, bands, held)
                held, size = [], 0
        return found + search(index, bags, masks, bands, held)

    return found_in


def leaks_column(spark, index: ItemIndex, text: Column) -> Column:
    shared = spark.sparkContext.broadcast(cloudpickle.dumps(index))  # of BLOCK_WORDS words or one item at most

    @F.arrow_udf(LEAKS)
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        found_in = searcher(cloudpickle.loads(shared.value))
        for texts in batches:
            yield pa.array([[dict(zip(_LEAK, leak, strict=True)) for leak in leaks] for leaks in found_in(texts)], _LEAK_TYPE)

    return of(text)


def leak_rows(docs: DataFrame, index: ItemIndex) -> DataFrame:
    """A row for each document row and item found in it. Not by ``leaks_column``, beside which the executor would hold the rows, texts and all."""
    shared = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(index))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found_in = searcher(cloudpickle.loads(shared.value))
        for batch in batches:
            found = found_in(batch.column("text"))
            rows = pa.array([n for n, leaks in enumerate(found) for _ in leaks], pa.int64())
            leaks = pa.array([dict(zip(_LEAK, leak, strict=True)) for leaks in found for leak in leaks], _LEAK_TYPE.value_type)
            yield pa.record_batch([batch.column("doc_id").take(rows), *leaks.flatten()], ["doc_id", *_LEAK])

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(of, "doc_id long, item_id long, item_words int, edits int, first_word int")


def item_blocks(benchmark: DataFrame, most: int | None = None) -> Iterator[list[tuple[int | None, str | None]]]:
    """Items in blocks of ``most`` words, streamed partition by partition; a longer item is a block of its own. At least one block, maybe empty."""
    most = most or BLOCK_WORDS
    held: list[tuple] = []
    size, yielded = 0, False
    slim = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).where(F.col("text").isNotNull())
    for row in slim.toLocalIterator():
        words = len(words_of(row[1]))
        if held and size + words > most:
            yield held
            held, size, yielded = [], 0, True
        held.append(tuple(row))
        size += words
    if held or not yielded:
        yield held


def find_leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8, recall: float = 0.99, seed: int = 7) -> DataFrame:
    """``doc_id, item_id, item_words, edits, first_word``: the documents that contain an
    item with at most ``(1 - similarity) * words`` word edits, one row per
    document row and item, at the least distance.

    Words are runs of letters, digits and underscores, lower-cased; in scripts
    without spaces every character is a word. Whole texts are searched at every word. Null, empty and wordless texts contain nothing;
    items without a word match nothing, those of one to four words match exact
    copies; items that repeat are reported each by its item_id, null included. Rows that
    repeat are reported each on its own. Empty tables give no rows; other
    columns are not read.
    """
    out = None
    for block in item_blocks(benchmark):
        rows = leak_rows(docs, build_index(block, similarity, recall, seed))
        out = rows if out is None else out.unionByName(rows)
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8, recall: float = 0.99, seed: int = 7) -> DataFrame:
    """The rows of ``docs`` that contain no item, by the rules of ``find_leaks``; columns stay as they are.

    Null, empty and wordless texts stay, as does every row if there is no item
    with a word. Rows that repeat stay or go together; empty tables give no rows.
    """
    for block in item_blocks(benchmark):
        index = build_index(block, similarity, recall, seed)
        leaks = leaks_column(docs.sparkSession, index, F.col("text").cast("string"))
        docs = docs.where(F.size(leaks) == 0)
    return docs
