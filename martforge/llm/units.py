"""Exact tokenisation through a cache of text units.

A tokenizer file of the ``tokenizers`` library splits a text into pre-tokens
and encodes each of them on its own. A *unit* is a stretch of text whose ends
are always pre-token ends, so encoding a text equals joining the encodings of
its units, and a unit that repeats is encoded once per worker:

* ``spaces="drop"`` (white space only separates): units are what stands between
  spaces, tabs and line ends, with full stops and commas apart where they are
  single marks.
* ``spaces="keep"`` (a word takes the space before it; other white space forms
  tokens of its own): a unit is a space and what follows up to the next space.
  Inside longer runs of white space such an end may lie within a token; texts
  that have such a run (:data:`RUN`) are one unit as a whole. Line feeds, full
  stops and commas that stand single are token ends too.

Units are split and made distinct by Arrow; Python sees each distinct unit of
a batch once. Special strings inside texts hold no white space, so the library
treats a unit that contains one as it would the whole text.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

from tokenizers import Tokenizer  # noqa: E402

#: White space, a space, then white space or the end of the text.
SPACE = r"[\t-\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
RUN = SPACE + " (" + SPACE + r"|\z)"
#: Texts in which a full stop or comma may continue a run of marks, or white
#: space a run of white space; in all others these are token ends as well.
MARKS = {"drop": r"[^A-Za-z0-9ß-öø-ÿ][.,]",  # letters that normalisation leaves alone
         "keep": r"[^\pL\pN][.,]"}
SPACES = SPACE + "{2}"
#: Units made of one word and at most one mark: two pre-tokens whose byte-level
#: spelling can be given to the BPE model itself, which skips the pipeline.
PLAIN = {"drop": re.compile("()([a-zß-öø-ÿ]+)([.,]?)"),
         "keep": re.compile("( ?)([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,]?)")}
#: Bytes of text handled at once.
CHUNK_BYTES = 16_000_000

_ENCODERS: dict[tuple, UnitEncoder] = {}


def byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves,
    the others for the code points from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def split_units(texts: pa.Array, spaces: str) -> pa.ListArray:
    """The units of each text of a string array without nulls."""
    texts = texts.cast(pa.large_string())
    single = pc.invert(pc.match_substring_regex(texts, MARKS[spaces]))
    if spaces == "drop":
        for white in "\n\t\r":
            texts = pc.replace_substring(texts, white, " ")
        # these tokenizers lower the case anyway; doing it first makes units
        # repeat more often. Special strings are case-sensitive: leave those.
        if not pc.any(pc.match_substring(texts, "<|")).as_py():
            texts = pc.ascii_lower(texts)
        texts = pc.if_else(single, _before(_before(texts, ".", " "), ",", " "), texts)
        return pc.split_pattern(texts, " ")
    if pc.any(pc.match_substring(texts, "\x00")).as_py():  # NUL in a text: no splitting
        return pa.LargeListArray.from_arrays(
            np.arange(len(texts) + 1, dtype=np.int64), pa.concat_arrays([texts]))
    whole = pc.match_substring_regex(texts, RUN)
    single = pc.and_(single, pc.invert(pc.match_substring_regex(texts, SPACES)))
    cut = _before(texts, " ")
    fine = _before(_before(pc.replace_substring(cut, "\n", "\x00\n\x00"), "."), ",")
    return pc.split_pattern(pc.if_else(whole, texts, pc.if_else(single, fine, cut)), "\x00")


def _before(texts: pa.Array, mark: str, cut: str = "\x00") -> pa.Array:
    return pc.replace_substring(texts, mark, cut + mark)


class UnitEncoder:
    """Encodes texts through a bounded per-worker cache ``unit -> ids``.

    ``known`` is an optional first tier that stays resident. Beyond it at most
    ``limit`` units are held: once half as many are new, those seen before them
    and not since are dropped; that costs time, never results.
    With ``counts`` only the number of ids is kept."""

    def __init__(self, path: str, spaces: str, counts: bool = False,
                 limit: int = 1_000_000) -> None:
        self.spaces, self.counts, self.limit = spaces, counts, limit
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = byte_letters()
        self.known: dict = {}
        self.cache: dict = {}
        self.older: dict = {}

    def encode_unit(self, unit: str):
        m = PLAIN[self.spaces].fullmatch(unit)
        if m is None:
            ids = self.tokenizer.encode(unit, add_special_tokens=False).ids
        else:
            letters = self.letters
            ids = [t.id for t in self.model.tokenize(
                "".join([letters[b] for b in (m[1] + m[2]).encode()]))]
            if m[3]:
                ids += [t.id for t in self.model.tokenize(m[3])]
        return len(ids) if self.counts else array("I", ids).tobytes()

    def results(self, units: list[str]) -> list:
        cache, older, known = self.cache, self.older, self.known
        out = list(map(cache.get, units))
        for i, (u, found) in enumerate(zip(units, out, strict=True)):
            if found is None:
                found = known.get(u)
                if found is None:
                    found = older.get(u)
                out[i] = found = self.encode_unit(u) if found is None else found
                if len(cache) >= max(1, self.limit // 2):
                    self.older, self.cache = older, cache = cache, {}
                cache[u] = found
        return out

    def _distinct(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, list]]:
        """Per chunk of texts: list offsets, unit numbers, result per number."""
        sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
        cuts = [0, *(np.flatnonzero(np.diff(sizes // CHUNK_BYTES)) + 1).tolist(), len(texts)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if a < b:
                units = split_units(texts.slice(a, b - a), self.spaces)
                offsets = units.offsets.to_numpy().astype(np.int64)
                coded = units.flatten().dictionary_encode()
                yield (offsets - offsets[0], coded.indices.to_numpy(),
                       self.results(coded.dictionary.to_pylist()))

    def count(self, texts: pa.Array) -> np.ndarray:
        """Number of ids of each text."""
        parts = [np.zeros(0, np.int64)]
        for offsets, number, found in self._distinct(texts):
            each = np.concatenate([[0], np.cumsum(np.array([*found, 0], np.int64)[number])])
            parts.append(each[offsets[1:]] - each[offsets[:-1]])
        return np.concatenate(parts)

    def ids(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The uint32 ids of each text, in order."""
        for offsets, number, found in self._distinct(texts):
            flat = np.frombuffer(b"".join(found), "<u4")
            size = np.fromiter(map(len, found), np.int64, len(found)) // 4
            start = np.cumsum(size) - size
            length = size[number]
            end = np.concatenate([[0], np.cumsum(length)])
            take = np.arange(end[-1]) + np.repeat(start[number] - end[:-1], length)
            out = flat[take]
            for a, b in zip(end[offsets[:-1]].tolist(), end[offsets[1:]].tolist(), strict=True):
                yield out[a:b]


def encoder(path: str, spaces: str, counts: bool = False,
            limit: int = 1_000_000) -> UnitEncoder:
    """This worker's encoder for a tokenizer file."""
    key = (path, spaces, counts)
    if key not in _ENCODERS:
        _ENCODERS[key] = UnitEncoder(path, spaces, counts)
    _ENCODERS[key].limit = limit
    return _ENCODERS[key]
