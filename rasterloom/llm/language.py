"""Language identification by cross-parsing entropy.

Each language has the suffix automaton of a bounded sample of its labelled
text. A text is parsed greedily into the longest phrases that occur in that
sample; the fewer phrases it needs per letter, normalised by the logarithm of
the sample's size, the smaller the cross entropy. The least entropy wins.

The automaton's transitions are laid out as a table over the letters of its own
language, in which a missing transition leads back over the root and marks a
phrase end, so that thousands of stretches of text advance one letter at a time
in numpy. Stretches are parsed side by side as if a phrase began with each; then
the parse of each one is carried on into the next until both begin a phrase at
the same letter, from where they agree. The result is the parse of the whole
text. Languages of many letters keep sorted transitions instead of a table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rasterloom.llm.encoding import pieces

UNKNOWN = "und"
#: Bounds of the training sample: letters for each language, documents for each language and characters of each.
SAMPLE_CHARS, SAMPLE_DOCS, SAMPLE_DOC_CHARS = 24_000, 64, 1_000
#: With more than 16 languages their samples share the letters of 16, but each keeps at least so many.
LEAST_CHARS = 4_000
#: Entries of the tables of all languages together; those of more than their share of it keep sorted transitions.
TABLE_ENTRIES = 48_000_000
#: Length of the stretches that are parsed side by side; it changes the work, never the parse.
STRETCH = 256
#: Letters parsed at once.
GROUP = 1 << 22
_END = 1 << 30


def suffix_automaton(codes: list[int]) -> list[dict[int, int]]:
    """Transitions of the minimal automaton of all substrings; state 0 is the root."""
    nxt, link, length, last = [{}], [-1], [0], 0
    for c in codes:
        cur = len(nxt)
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(nxt)
                nxt.append(dict(nxt[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and nxt[p].get(c) == q:
                    nxt[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    return nxt


def parse_table(codes: list[int], alphabet: int) -> np.ndarray:
    """Entry [state * alphabet + letter]: the next state times alphabet, plus _END where a phrase ends before the letter.

    Codes from ``alphabet`` on separate documents and have no column. The last
    state is that after a letter which the sample lacks: a phrase of its own,
    so the next letter begins another.
    """
    states = suffix_automaton(codes)
    root = _root_moves(states, alphabet)
    table = np.tile(root, (len(states) + 1, 1))
    table[0] &= _END - 1  # at the text's start a letter ends no phrase
    for s, moves in enumerate(states):
        for c, t in moves.items():
            if c < alphabet:
                table[s, c] = t * alphabet
    return table.astype(np.int32).reshape(-1)


def _root_moves(states: list[dict[int, int]], alphabet: int) -> np.ndarray:
    """By letter, the entry of a transition that is missing: a phrase ends, and the letter begins one."""
    root = np.full(alphabet, _END + len(states) * alphabet, np.int64)
    for c, s in states[0].items():
        if c < alphabet:
            root[c] = _END + s * alphabet
    return root


@dataclass
class Transitions:
    """An automaton over the letters of its own language; a letter that its sample lacks is a phrase of its own."""

    local: np.ndarray  # code of the model -> code of the language, the last for letters that the sample lacks
    alphabet: int
    table: np.ndarray | None  # as of parse_table
    keys: np.ndarray | None  # or sorted state * alphabet + letter of the transitions there are,
    to: np.ndarray | None  # their entries,
    root: np.ndarray | None  # and those of missing ones by letter

    def step(self, state: np.ndarray, letter: np.ndarray) -> np.ndarray:
        at = state + self.local.take(letter)
        if self.table is not None:
            return self.table.take(at)
        where = np.minimum(np.searchsorted(self.keys, at), len(self.keys) - 1)
        return np.where(self.keys.take(where) == at, self.to.take(where), self.root.take(at % self.alphabet))


def transitions(codes: list[int], alphabet: int, entries: int) -> Transitions:
    """Over the model's ``alphabet``; codes from there on separate documents."""
    own = sorted({c for c in codes if c < alphabet})
    local = np.full(alphabet, len(own), np.intp)
    local[own] = np.arange(len(own))
    width = len(own) + 1
    known = local.tolist()
    coded = [known[c] if c < alphabet else width for c in codes]
    if 2 * len(codes) * width <= entries:  # an automaton has fewer than twice as many states as letters
        return Transitions(local, width, parse_table(coded, width), None, None, None)
    states = suffix_automaton(coded)
    root = _root_moves(states, width)
    edges = [(s * width + c, t * width) for s, moves in enumerate(states) for c, t in moves.items() if c < width]
    # At the text's start a letter ends no phrase.
    edges += [(c, int(root[c]) & (_END - 1)) for c in range(width) if c not in states[0]]
    keys, to = np.array(sorted(edges), np.int64).T
    return Transitions(local, width, None, np.ascontiguousarray(keys), np.ascontiguousarray(to), root)


@dataclass
class LanguageModel:
    languages: list[str]
    letters: str
    tables: list[Transitions]
    log_sizes: np.ndarray

    def lookup(self) -> np.ndarray:
        """Code of every character of the basic plane, or beyond as far as letters go: 0 no letter, 1.. the letters, the last for letters of no sample."""
        other = len(self.letters) + 1
        points = [ord(c) for c in self.letters]
        size = max([1 << 16, *(p + 1 for p in points)])
        codes = np.array([other if chr(c).isalpha() else 0 for c in range(size)], dtype=np.uint8 if other < 256 else np.int32)
        codes[points] = np.arange(1, other)
        return codes


def to_codes(text: str, lookup: np.ndarray, other: int) -> np.ndarray:
    parts = [_piece_codes(p, lookup, other) for p in pieces(text.lower())]
    codes = parts[0] if len(parts) == 1 else np.concatenate(parts)
    if len(codes) > 1:  # white space, digits and marks between two letters count once
        codes = codes[np.concatenate([[True], (codes[1:] != 0) | (codes[:-1] != 0)])]
    return codes


def _piece_codes(text: str, lookup: np.ndarray, other: int) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    codes = lookup[np.minimum(points, len(lookup) - 1)]
    beyond = np.flatnonzero(points >= len(lookup))
    if len(beyond):
        codes[beyond] = [other if chr(p).isalpha() else 0 for p in points[beyond]]
    return codes


def count_phrases(codes: list[np.ndarray], tables: list[np.ndarray | Transitions], stretch: int | None = None) -> np.ndarray:
    """[language, text] phrases of the greedy parse of each whole text."""
    stretch = stretch or STRETCH
    sizes = np.array([len(c) for c in codes])
    out = np.zeros((len(tables), len(codes)), np.int64)
    if sizes.sum() == 0:
        return out
    flat = np.concatenate(codes)
    parts = -(-sizes // stretch)
    owner = np.repeat(np.arange(len(codes)), parts)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)
    begin = np.repeat(np.cumsum(sizes) - sizes, parts) + nth * stretch
    length = np.minimum(stretch, np.repeat(sizes, parts) - nth * stretch)
    order = np.argsort(-length, kind="stable")
    owner, nth, begin, length = owner[order], nth[order], begin[order], length[order]
    active = len(length) - np.searchsorted(length[::-1], np.arange(length[0]), side="right")
    # Where the stretch that goes on from this one stands, or -1.
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    after = np.where(nth + 1 < parts[owner], place[np.minimum(order + 1, len(order) - 1)], -1)
    state = [np.zeros(len(owner), np.int64) for _ in tables]
    ends = [np.zeros((length[0], len(owner)), np.int8) for _ in tables]  # [step, stretch]: a phrase ends before the letter
    for step, n in enumerate(active):
        letter = flat[begin[:n] + step]
        for table, at, found in zip(tables, state, ends, strict=True):
            moved = _moved(table, at[:n], letter)
            np.right_shift(moved, 30, out=found[step, :n], casting="unsafe")
            np.bitwise_and(moved, _END - 1, out=at[:n])
    for k, table in enumerate(tables):
        _carry_on(table, flat, begin, length, after, state[k], ends[k])
        found = ends[k].sum(axis=0, dtype=np.int64)
        # The last phrase of a text is ended by its end.
        out[k] = np.bincount(owner, weights=found, minlength=len(codes)).astype(np.int64) + (sizes > 0)
    return out


def _moved(table: np.ndarray | Transitions, state: np.ndarray, letter: np.ndarray) -> np.ndarray:
    return table.step(state, letter) if isinstance(table, Transitions) else table.take(state + letter)


def _carry_on(table, flat: np.ndarray, begin: np.ndarray, length: np.ndarray, after: np.ndarray, state: np.ndarray, ends: np.ndarray) -> None:
    """Corrects ``ends`` and the last states of stretches to the parse that comes from the stretch before.

    A stretch whose last state has changed is carried on once more.
    """
    changed = np.flatnonzero(after >= 0)
    while len(changed):
        into, at = after[changed], state[changed]
        step, again = 0, []
        while len(into):
            moved = _moved(table, at, flat[begin[into] + step])
            ended = (moved >> 30).astype(np.int8)
            same = (ended == 1) & (ends[step, into] == 1)  # both begin a phrase here
            ends[step, into] = ended
            at = moved & (_END - 1)
            step += 1
            over = ~same & (length[into] == step)  # the stretch is over and they never agreed
            state[into[over]] = at[over]
            again.append(into[over])
            going = ~same & ~over
            into, at = into[going], at[going]
        changed = np.concatenate(again)
        changed = changed[after[changed] >= 0]


def train(labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id") -> LanguageModel:
    """Fit on a bounded sample: of each language the ``SAMPLE_DOCS`` rows that come
    first by hash of ``key``. All labelled languages and all letters of their samples are learned.

    Rows whose text or language is null take no part.
    """
    picked = sample(labelled, text, lang, key)
    letters = "".join(sorted({c for texts in picked.values() for t in texts for c in t.lower() if c.isalpha()}))
    model = LanguageModel(sorted(picked), letters, [], np.empty(0))
    lookup, sizes = model.lookup(), []
    for name in model.languages:
        codes = sample_codes(picked[name], lookup, len(letters) + 1, len(picked))
        model.tables.append(transitions(codes, len(letters) + 2, TABLE_ENTRIES // max(16, len(picked))))
        sizes.append(max(2, len(codes)))
    model.log_sizes = np.log2(np.array(sizes, float))
    return model


def sample(labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id") -> dict[str, list[str]]:
    """By language, the beginnings of the documents to learn from."""
    rows = labelled.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).where(F.length(F.trim(text)) > 0)
    names = sorted(r[0] for r in rows.select(lang).distinct().collect())
    by_hash = Window.partitionBy(lang).orderBy(F.xxhash64(F.col(key)), F.col(key))
    slim = rows.select(
        F.col(lang).alias("lang"), F.substring(text, 1, SAMPLE_DOC_CHARS).alias("text"), F.col(key).alias("key"), F.row_number().over(by_hash).alias("n")
    )
    picked: dict[str, list[str]] = {n: [] for n in names}
    for r in slim.where(F.col("n") <= SAMPLE_DOCS).orderBy("lang", "n").collect():
        picked[r.lang].append(r.text)
    return picked


def sample_codes(texts: list[str], lookup: np.ndarray, other: int, languages: int) -> list[int]:
    """A language's sample; ``other + 1`` stands after each document."""
    budget = max(LEAST_CHARS, SAMPLE_CHARS * 16 // max(16, languages))
    codes: list[int] = []
    for t in texts:
        if len(codes) >= budget:
            break
        codes += to_codes(t, lookup, other)[: budget - len(codes)].tolist() + [other + 1]
    return codes


def predict_column(spark, model: LanguageModel, text: Column, once: bool = False) -> Column:
    """``struct<lang_pred, score>``: the score is how much less the winner's entropy is than the runner-up's.

    ``und`` with score 0 if the text is null or has no letter, or nothing was
    learned. Equal entropies go to the language first by name. With ``once`` a
    filter on the prediction does not parse the texts a second time.
    """
    shared = spark.sparkContext.broadcast(cloudpickle.dumps(model))  # bounded by the sample of each language

    @F.arrow_udf("lang_pred string, score double")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = cloudpickle.loads(shared.value)
        lookup, other = model.lookup(), len(model.letters) + 1
        for texts in batches:
            names: list[str] = []
            scores: list[float] = []
            held: list[np.ndarray] = []
            size = 0
            for t in texts:
                t = t.as_py()
                held.append(to_codes(t, lookup, other) if t else np.empty(0, np.uint8))
                size += len(held[-1])
                if size >= GROUP:
                    _decide(model, held, names, scores)
                    held, size = [], 0
            _decide(model, held, names, scores)
            yield pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["lang_pred", "score"])

    return (of.asNondeterministic() if once else of)(text)


def _decide(model: LanguageModel, codes: list[np.ndarray], names: list[str], scores: list[float]) -> None:
    if not codes:
        return
    found = count_phrases(codes, model.tables) if model.tables else np.zeros((0, len(codes)))
    for i, c in enumerate(codes):
        if not model.tables or not c.any():
            names.append(UNKNOWN)
            scores.append(0.0)
            continue
        entropy = found[:, i] * model.log_sizes / len(c)
        best = int(np.argmin(entropy))
        rest = np.delete(entropy, best)
        names.append(model.languages[best])
        scores.append(float(1 - entropy[best] / rest.min()) if len(rest) else 1.0)


def held_out(doc_id: Column) -> Column:
    """crc32 of the doc_id as text leaves 2 when divided by 4; false for a null doc_id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def fit_documents(docs: DataFrame) -> LanguageModel:
    """Learn from documents that are not held out; a null doc_id is never learned from."""
    return train(docs.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))))


def identify(docs: DataFrame, model: LanguageModel | None = None) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` per row, from whole texts.

    Language, source and doc_id are never inputs of a prediction. Rows that
    repeat are predicted each on its own, an empty table gives no rows, other
    columns are not read.
    """
    model = model or fit_documents(docs)
    out = predict_column(docs.sparkSession, model, F.col("text").cast("string"))
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), out.alias("p"))
    return slim.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "p.lang_pred", "p.score")


def keep_known(docs: DataFrame, model: LanguageModel | None = None) -> DataFrame:
    """The rows of ``docs`` in a learned language, with ``lang`` set to the predicted one; those told ``und`` go.

    Null, empty and letterless texts go, and all rows if nothing could be
    learned. Other columns stay as they are, whatever their names; a table
    without ``lang`` gets it, a table with it keeps its place. Rows that repeat
    stay or go together, an empty table gives no rows.
    """
    model = model or fit_documents(docs)
    out = predict_column(docs.sparkSession, model, F.col("text").cast("string"), once=True)
    return docs.withColumn("lang", out["lang_pred"].alias("lang")).where(F.col("lang") != UNKNOWN)
