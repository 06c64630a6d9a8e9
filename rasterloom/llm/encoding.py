"""Whole-text token ids with a bounded cache of words and parts.

A tokenizer whose normaliser and pre-tokenizer drop white space and never look
across it gives the same ids for a text as for its space-separated words, one
after the other. For such files (checked in ``words_are_independent``) each
distinct word, or part of one, is encoded once while it stays in the cache; any
other tokenizer encodes whole texts.
"""

from __future__ import annotations

import json
import os
import re
import sys
import types
import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

#: Distinct parts (and distinct words of other scripts) kept per Python worker, about 100 MB at most.
CACHE_PARTS = 500_000
#: Longer ones are encoded but not kept.
CACHE_PART_CHARS = 64
#: Texts are handled in groups of about so many characters.
GROUP_CHARS = 1 << 19


#: Longer texts are worked on in pieces of about this many characters, cut at a space or newline.
PIECE_CHARS = 1 << 20
_CUT = re.compile(r"[ \n]")


def pieces(text: str) -> Iterator[str]:
    """The text in pieces of bounded length; only a longer run without a space or newline stays whole."""
    at = 0
    while len(text) - at > PIECE_CHARS:
        cut = _CUT.search(text, at + PIECE_CHARS)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:] if at else text


def words_are_independent(path: str) -> bool:
    """True if ids of a text are the ids of its words between spaces and newlines."""
    with open(path, encoding="utf-8") as src:
        spec = json.load(src)
    norm, pre = spec.get("normalizer") or {}, spec.get("pre_tokenizer") or {}
    norms = norm.get("normalizers", [norm] if norm else [])
    pres = pre.get("pretokenizers", [pre] if pre else [])
    for n in norms:
        squeeze = n["type"] == "Replace" and n.get("pattern") == {"Regex": "\\s+"} and n.get("content") == " "
        if not (squeeze or n["type"] in ("NFC", "NFKC", "Lowercase")):
            return False
    split = pres[0] if pres else {}
    drops = split.get("type") == "Split" and split.get("behavior") == "Removed" and split.get("invert") is True
    pattern = split.get("pattern", {}).get("Regex", " ")
    if not drops or any(c.isspace() for c in pattern) or "\\s" in pattern.replace("^\\s", ""):
        return False
    if re.search(r"\\(?![sdpNL{}])", pattern) or re.search(r"\\p\{(?!L\}|N\})", pattern):
        return False
    rest = all(p["type"] == "ByteLevel" and not p.get("add_prefix_space") and not p.get("use_regex") for p in pres[1:])
    added = all(not any(c.isspace() for c in t["content"]) for t in spec.get("added_tokens", ()))
    return rest and added and not spec.get("truncation") and not spec.get("padding")


class _Parts(dict):
    """Ids of a pre-tokenizer's parts, from the library's model when first asked for."""

    def __init__(self, model, byte_level: bool):
        super().__init__()
        self._tokenize = model.tokenize
        self._letters = {b: chr(c) for b, c in _byte_letters().items()} if byte_level else None

    def __missing__(self, part: str) -> bytes:
        text = part if part.isascii() or self._letters is None else "".join([self._letters[b] for b in part.encode()])
        ids = array("I", [t.id for t in self._tokenize(text)]).tobytes()
        if len(part) <= CACHE_PART_CHARS:
            self[part] = ids
        return ids


class _Words(dict):
    """Ids of words when first asked for: of plain ones by their parts, of others from the whole tokenizer."""

    def __init__(self, tokenizer, plain_ids):
        super().__init__({"": b""})
        self._tokenizer, self._plain_ids = tokenizer, plain_ids

    def __missing__(self, word: str) -> bytes:
        ids = self._plain_ids(word)
        if ids is None:
            ids = array("I", self._tokenizer.encode(word, add_special_tokens=False).ids).tobytes()
        if len(word) <= CACHE_PART_CHARS:
            self[word] = ids
        return ids


class _Splitter:
    """Texts of a tokenizer whose words are independent.

    The library's normaliser and pre-tokenizer cost more than its merges. For
    texts of ASCII and Latin-1 letters both are plain: composed already, lower
    case letter by letter, split by the file's own pattern. Their parts go to
    the library's model, each distinct one once while it is kept. Any other text
    goes word by word, its other words through the whole tokenizer.
    """

    #: Inside the plain texts, what the pattern's classes stand for.
    LETTERS, DIGITS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff", "0-9"

    def __init__(self, tokenizer, spec: dict):
        norm = spec.get("normalizer") or {}
        self._lower = any(n["type"] == "Lowercase" for n in norm.get("normalizers", [norm]) if n)
        pre = spec["pre_tokenizer"]
        pres = pre.get("pretokenizers", [pre])
        pattern = pres[0]["pattern"]["Regex"].replace(r"\p{L}", self.LETTERS).replace(r"\p{N}", self.DIGITS)
        self._split = self._split_bare = re.compile(pattern).findall
        choices = pattern.split("|")
        if "(" not in pattern:  # no groups: choices that begin with an apostrophe need one in the text
            self._split_bare = re.compile("|".join(c for c in choices if not c.startswith("'"))).findall
        self._plain = re.compile(rf"[\x09-\x0d\x20-\x7e{self.LETTERS}]*+").fullmatch
        added = [re.escape(t["content"]) for t in spec.get("added_tokens", ())]
        self._added = re.compile("|".join(added)).search if added else None
        self.parts = _Parts(tokenizer.model, any(p["type"] == "ByteLevel" for p in pres))
        self.words = _Words(tokenizer, self.plain_ids)

    def ids(self, text: str) -> bytes:
        for cache in (self.parts, self.words):  # start anew; what is common is back at once
            if len(cache) > CACHE_PARTS:
                cache.clear()
        ids = self.plain_ids(text)
        return b"".join(map(self.words.__getitem__, text.replace("\n", " ").split(" "))) if ids is None else ids

    def plain_ids(self, text: str) -> bytes | None:
        """None for a text or word that is not plain."""
        if not self._plain(text) or self._added and self._added(text):
            return None
        text = text.lower() if self._lower else text
        return b"".join(map(self.parts.__getitem__, (self._split if "'" in text else self._split_bare)(text)))


def _byte_letters() -> dict[int, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for code points from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {b: b for b in plain} | {b: 256 + n for n, b in enumerate(rest)}


class TextEncoder:
    """Encodes texts to little-endian unsigned 32-bit ids, each with ``end_id`` appended."""

    def __init__(self, tokenizer_path: str, end_id: int | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(tokenizer_path)
        self._end = b"" if end_id is None else array("I", [end_id]).tobytes()
        self._splitter = None
        if words_are_independent(tokenizer_path):
            with open(tokenizer_path, encoding="utf-8") as src:
                self._splitter = _Splitter(self._tokenizer, json.load(src))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Null counts as an empty text."""
        end = self._end
        if self._splitter is None:
            found = self._tokenizer.encode_batch_fast([t or "" for t in texts], add_special_tokens=False)
            return [array("I", e.ids).tobytes() + end for e in found]
        ids = self._splitter.ids
        return [b"".join(map(ids, pieces(t))) + end if t else end for t in texts]


def worker_encoder(tokenizer_path: str, end_id: int | None) -> TextEncoder:
    """The encoder of this Python worker, kept with its cache for the worker's later tasks.

    Functions reach workers by value, so a module's globals end with a task; an
    entry in ``sys.modules`` does not.
    """
    kept = sys.modules.setdefault("_rasterloom_worker", types.ModuleType("_rasterloom_worker")).__dict__
    key = f"encoder:{tokenizer_path}:{end_id}"
    if key not in kept:
        kept[key] = TextEncoder(tokenizer_path, end_id)
    return kept[key]


def grouped(ids: pa.Array, texts: pa.Array, chars: int = GROUP_CHARS) -> Iterator[tuple[list, list[str | None]]]:
    """Slices of a batch of about ``chars`` bytes of text each; a longer text stands alone."""
    sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(texts), 0))
    begin, held = 0, 0
    for i, size in enumerate(sizes):
        if held and held + size > chars:
            yield ids.slice(begin, i - begin).to_pylist(), texts.slice(begin, i - begin).to_pylist()
            begin, held = i, 0
        held += int(size) + 1
    if begin < len(sizes):
        yield ids.slice(begin).to_pylist(), texts.slice(begin).to_pylist()


def encode_batches(
    batches: Iterable[pa.RecordBatch], encoder: TextEncoder
) -> Iterator[tuple[list[int | None], list[bytes]]]:
    """(doc ids, id bytes) of small groups of rows; columns are doc id, text."""
    for batch in batches:
        for ids, texts in grouped(batch.column(0), batch.column(1)):
            yield ids, encoder.encode(texts)


def crc_of(ids: bytes | np.ndarray) -> int:
    """Unsigned crc32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids if isinstance(ids, bytes) else np.ascontiguousarray(ids, dtype="<u4").tobytes())
