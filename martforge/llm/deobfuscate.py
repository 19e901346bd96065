"""Noisy-channel restoration of disguised words.

The sender's text is letters; the channel replaces letters by look-alikes,
repeats them, or puts separators between them. The observed characters form a
lattice: every character can stand for what it shows or for what it may
disguise, a run of equal letters for one, two or all of them, a separator
between characters for a word end or for nothing, a look-alike mark at an end
of the word for nothing. A Viterbi search
finds the reading with the least total cost under the channel and a character
trigram model of the corpus.
"""

from __future__ import annotations

import re

import numpy as np

#: Letters that a character may stand for (fixed values).
LOOKALIKES = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e",
}
#: Channel costs in nats.
SWAP, KEEP_MARK, SHORTEN, KEEP_RUN, JOIN, PART = 1.0, 6.0, 1.0, 4.0, 0.5, 4.0
DROP = 6.0
#: Symbols of the trigram model: 0 a word end, 1-26 the letters, 27 any other
#: letter.
SYMBOLS = 28
SEPARATORS = " .-_*"
EDGE = ".,;:?\"'()[]{}…!“”‘’„«»"
_MARKS = re.escape("".join(m for m in LOOKALIKES if not m.isalnum()))
_SINGLE = rf"(?:[^\W_]|[{_MARKS}])"
_OUTSIDE = rf"[^\s{re.escape(EDGE)}]"
#: Three or more single characters, letters or look-alikes, with the same
#: separator, once or more, between them.
SPACED = re.compile(rf"(?<!{_OUTSIDE}){_SINGLE}(?:"
                    + "|".join(rf"(?:{re.escape(s)}+{_SINGLE}){{2,}}" for s in SEPARATORS)
                    + rf")(?!{_OUTSIDE})")
#: Every text with a match of SPACED has one of this (RE2 syntax).
SPACED_HINT = rf"[\p{{L}}\p{{N}}{_MARKS}](?:[ ._*-]+[\p{{L}}\p{{N}}{_MARKS}]){{2}}(?:[^\p{{L}}\p{{N}}]|$)"
#: A spaced-out word may follow one of these written with the same spaces.
ONE_LETTER_WORDS = "aàeoóuy"
#: A word whose lattice has more than one path.
AMBIGUOUS = re.compile(rf"[{re.escape(''.join(LOOKALIKES))}]|(.)\1|.[{re.escape(SEPARATORS)}].", re.S)
#: Marks at the ends of a word that stand for no letter.
PLAIN_EDGE = "".join(c for c in EDGE if c not in LOOKALIKES)
#: Steps of a lattice: a stretch of characters that stand for themselves only,
#: or else one character and its repeats.
STEP = re.compile(rf"((?:([^{re.escape(''.join(LOOKALIKES) + SEPARATORS)}])(?!\2))+)|(.)\3*", re.S)
#: A character and its repeats.
RUN = re.compile(r"(.)\1*", re.S)
#: Words of a reading: letters (with combining marks) or digits.
WORD = re.compile(r"(?:[^\W\d_]|[\u0300-\u036f])+|\d+")
#: Stretches of a shown word between marks of any kind.
PIECE = re.compile(r"(?:[^\W_]|[\u0300-\u036f])+")


def symbol_of(char: str) -> int:
    if "a" <= char <= "z":
        return ord(char) - 96
    return 27 if char.isalpha() else 0


def _extend(flat: list[float], best: dict[int, tuple[float, tuple]],
            readings: list[tuple[str, float, list[int]]]) -> dict[int, tuple[float, tuple]]:
    """The cheapest way to each state after one more step."""
    if len(best) == len(readings) == 1:  # a single path needs no costs
        ((state, (so_far, path)), (out, _, symbols)), = zip(best.items(), readings, strict=True)
        for z in symbols[-2:]:
            state = state % SYMBOLS * SYMBOLS + z
        return {state: (so_far, (path, out))}
    step: dict[int, tuple[float, tuple]] = {}
    for begin, (so_far, path) in best.items():
        for out, channel, symbols in readings:
            state, total = begin, so_far + channel
            for z in symbols:
                at = state * SYMBOLS + z
                total += flat[at]
                state = at % SYMBOLS ** 2
            if state not in step or total < step[state][0]:
                step[state] = (total, (path, out))
    return step


class Restorer:
    """Restores disguised words under trigram counts (``SYMBOLS ** 3``)."""

    def __init__(self, counts: np.ndarray) -> None:
        c = counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS).astype(np.float64)
        # interpolated with the bigram and unigram shares
        one = (c.sum((0, 1)) + 1) / (c.sum() + SYMBOLS)
        two = (c.sum(0) + 5 * one) / (c.sum((0, 2)) + 5)[:, None]
        three = (c + 5 * two) / (c.sum(2) + 5)[:, :, None]
        self.cost = (-np.log(three)).tolist()
        self.flat = [c for rows in self.cost for row in rows for c in row]
        self.cache: dict[str, str] = {}
        self.known: dict[tuple[str, int], list[tuple[str, float, list[int]]]] = {}

    def readings(self, run: str, first: bool, last: bool,
                 letter_first: bool = False) -> list[tuple[str, float]]:
        """The readings of a character and its repeats, with their channel
        costs; ``first`` and ``last`` tell if it starts or ends the text."""
        char, n = run[0], len(run)
        if char in SEPARATORS and not first and not last:
            return [("", JOIN), ("  ", PART)]  # two word ends, as counted
        letters = LOOKALIKES.get(char, "")
        shown = KEEP_MARK if letters else 0.0
        readings: list[tuple[str, float]] = []
        for letter, cost in [(char, shown), *((x, SWAP) for x in letters)]:
            readings.append((letter * n, cost + (KEEP_RUN if n > 2 else 0)))
            if n > 1:
                readings.append((letter, cost + SHORTEN))
            if n > 2:
                readings.append((letter * 2, cost + SHORTEN))
        if letter_first and first and letters:
            readings = [(out, cost) for out, cost in readings if out[0] != char]
        elif letters and not char.isalnum() and (first or last):
            readings.append(("", DROP))  # punctuation
        return readings

    def options(self, text: str, letter_first: bool = False) -> list[list[tuple[str, float]]]:
        """The lattice: per step the readings and their channel costs;
        with ``letter_first`` a look-alike at the start is a letter."""
        return [self.readings(m[0], m.start() == 0, m.end() == len(text), letter_first)
                for m in RUN.finditer(text)]

    def _step(self, run: str, first: bool, last: bool,
              letter_first: bool) -> list[tuple[str, float, list[int]]]:
        """:meth:`readings` with their symbols; those of short ASCII runs are kept."""
        key = (run, first + 2 * last + 4 * letter_first)
        found = self.known.get(key)
        if found is None:
            found = [(out, cost, [symbol_of(c) for c in out])
                     for out, cost in self.readings(run, first, last, letter_first)]
            if len(run) < 4 and run.isascii():
                self.known[key] = found
        return found

    def decode(self, text: str, letter_first: bool = False) -> str:
        """The most likely reading of a lower-case piece of text."""
        flat, size = self.flat, len(text)
        # last two symbols (x * SYMBOLS + y) -> (cost, reading)
        best: dict[int, tuple[float, tuple]] = {0: (0.0, ())}
        for m in STEP.finditer(text):
            stretch = m[1]
            if stretch is None:
                best = _extend(flat, best, self._step(m[0], m.start() == 0, m.end() == size,
                                                      letter_first))
                continue
            at = 0
            while at < len(stretch) and len(best) > 1:  # at most two: then the states agree
                best = _extend(flat, best, [(stretch[at], 0.0, [symbol_of(stretch[at])])])
                at += 1
            if at < len(stretch):  # a single path needs no costs
                (state, (so_far, path)), = best.items()
                for char in stretch[at:][-2:]:
                    state = state % SYMBOLS * SYMBOLS + symbol_of(char)
                best = {state: (so_far, (path, stretch[at:]))}
        if len(best) > 1:
            best = _extend(flat, best, [("", 0.0, [0])])  # the word ends
        path, parts = min(best.values(), key=lambda v: v[0])[1], []
        while path:
            path, out = path
            parts.append(out)
        return "".join(reversed(parts)).strip()

    def restore_word(self, word: str) -> str:
        """A white-space-delimited word, lower-cased and restored."""
        core = word.lower().strip(PLAIN_EDGE)
        if not AMBIGUOUS.search(core):
            return core
        if core not in self.cache:
            if len(self.cache) > 50_000:
                self.cache.clear()
            self.cache[core] = " ".join(self.decode(core).strip(EDGE).split())
        return self.cache[core]

    def words(self, shown: str) -> set[str]:
        """The words in a white-space-delimited string: of its restored
        reading, of the reading in which a look-alike at its start is a
        letter, and of the stretches between its marks."""
        core = shown.lower().strip(PLAIN_EDGE)
        if core.isalpha():
            return {self.restore_word(core)}
        readings = [self.restore_word(core)]
        if core[:1] in LOOKALIKES and not core[0].isalnum():
            readings.append(self.decode(core, letter_first=True))
        pieces = PIECE.findall(core)
        if pieces != [core]:
            readings += [self.restore_word(p) for p in pieces if len(p) > 1]
        return {w for r in readings for w in WORD.findall(r)}

    def restore_spaced(self, text: str) -> list[str]:
        """The words hidden in runs of single characters."""
        found = []
        for m in SPACED.finditer(text.lower()):
            words = self.decode(m[0]).split()
            found += words
            if m[0][0] in ONE_LETTER_WORDS and len(words[0]) > 1:  # or a word of its own
                found += self.decode(m[0][1:].lstrip(SEPARATORS)).split()
        return found


def trigram_counts(texts: list[str]) -> np.ndarray:
    """Counts of symbol trigrams; words are separated by two word ends."""
    if not texts:
        return np.zeros(SYMBOLS ** 3, np.int64)
    joined = "".join(["  " + text.lower() + "  " for text in texts])
    codes = np.frombuffer(joined.encode("utf-32-le"), "<u4")
    symbol = np.zeros(len(codes), np.uint16)
    ascii_letter = (codes >= 97) & (codes <= 122)
    symbol[ascii_letter] = codes[ascii_letter] - 96
    symbol[codes >= 170] = 27  # other letters; marks beyond ASCII are rare
    # leave a second word end where a word starts, as decode() does
    symbol = np.repeat(symbol, 1 + (symbol == 0))
    total = np.bincount(symbol[:-2] * np.uint16(SYMBOLS ** 2) + symbol[1:-1] * np.uint16(SYMBOLS)
                        + symbol[2:], minlength=SYMBOLS ** 3)
    total[0] -= 2 * (len(texts) - 1)  # trigrams across two texts: word ends only
    return total
