"""Words and shingles of Arrow text batches as 64-bit hashes, without a Python loop over words.

Texts are read as UTF-8 bytes. ``A``-``Z`` are lower-cased, a byte table says which bytes
belong to words, and each maximal run of such bytes inside one text is a word. Word and
shingle identity is a 64-bit hash; two different ones are taken as equal with a chance of
about 2**-64 per compared pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Texts are worked on in runs of about so many bytes, which bounds a task's memory.
RUN_BYTES = 4 << 20

SPACES = bytes([0x20, *range(0x09, 0x0E)])


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A fixed 64-bit mixing of integers (the splitmix64 finaliser)."""
    with np.errstate(over="ignore"):
        x = x + U64((salt * 0x9E3779B97F4A7C15 + 0x9E3779B97F4A7C15) % 2**64)
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
        return x ^ (x >> U64(31))


def word_table(kind: str) -> np.ndarray:
    """Which bytes belong to words: ``space`` splits at ASCII white space, ``symbol`` at all
    ASCII characters but digits and letters."""
    table = np.ones(256, bool)
    if kind == "space":
        table[list(SPACES)] = False
    elif kind == "symbol":
        for first, last in ((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)):
            table[first : last + 1] = False
    else:
        raise ValueError(f"unknown kind of words: {kind}")
    return table


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_EXACT = mix(np.arange(256, dtype=U64), 1)
_BYTE = _EXACT[_LOWER]
_TABLES = {kind: word_table(kind) for kind in ("space", "symbol")}
_MULTIPLIER = 0xD6E8FEB86659FD93


def _powers(n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.concatenate(
            [np.ones(1, U64), np.cumprod(np.full(max(n - 1, 0), _MULTIPLIER, U64))]
        )[: max(n, 1)]


_POWERS = _powers(64)


class Run:
    """Words of a few texts: ``hashes`` of all words in order, ``first[i]:first[i+1]`` are
    those of text ``i`` of the run, which is row ``row + i`` of the batch."""

    def __init__(self, row: int, hashes: np.ndarray, first: np.ndarray):
        self.row, self.hashes, self.first = row, hashes, first

    def __len__(self) -> int:
        return len(self.first) - 1


def text_buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a string array; a null is an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()) if texts.type != pa.large_string() else texts
    if texts.null_count:
        texts = texts.fill_null("")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(texts) + 1, texts.offset * 8) if offsets else np.zeros(1, np.int64)
    return offsets, np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)


def _run(row: int, bytes_: np.ndarray, ends: np.ndarray, table: np.ndarray, values: np.ndarray = _BYTE) -> Run:
    n = len(bytes_)
    starts_of_texts = np.concatenate([np.zeros(1, np.int64), ends])
    if not n:
        return Run(row, np.zeros(0, U64), np.zeros(len(starts_of_texts), np.int64))
    inside = table[bytes_]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    at = starts_of_texts[:-1][starts_of_texts[:-1] < n]
    opens[at] = inside[at]
    starts = np.flatnonzero(opens)
    first = np.searchsorted(starts, starts_of_texts)
    if not len(starts):
        return Run(row, np.zeros(0, U64), first)
    spans = np.diff(starts, append=n)
    place = np.arange(starts[0], n) - np.repeat(starts, spans)
    tail = inside[starts[0] :]
    place *= tail  # separators count nothing, whatever stands there
    longest = int(place.max()) + 1
    powers = _POWERS if longest <= len(_POWERS) else _powers(longest)
    with np.errstate(over="ignore"):
        value = values[bytes_[starts[0] :]] * powers[place]
        value *= tail
        hashes = np.add.reduceat(value, starts - starts[0])
    return Run(row, mix(hashes), first)


def runs(texts: pa.Array, kind: str = "space", fold: bool = True, size: int = RUN_BYTES) -> Iterator[Run]:
    """All texts of a batch, a few megabytes at a time; a longer text is a run of its own.
    Without ``fold`` words that differ in case differ."""
    offsets, data = text_buffers(texts)
    table, values, row, count = _TABLES[kind], _BYTE if fold else _EXACT, 0, len(offsets) - 1
    while row < count:
        last = int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1
        last = min(max(last, row + 1), count)
        lo = offsets[row]
        yield _run(row, data[lo : offsets[last]], offsets[row + 1 : last + 1] - lo, table, values)
        row = last


def windows(hashes: np.ndarray, size: int, salt: int = 7) -> np.ndarray:
    """Hash of every run of ``size`` neighbouring words, text borders not regarded."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, U64)
    total = np.zeros(n, U64)
    with np.errstate(over="ignore"):
        for k, factor in enumerate(mix(np.arange(size, dtype=U64), salt) | U64(1)):
            total += hashes[k : k + n] * factor
    return mix(total, salt)


def shingles(run: Run, size: int) -> Iterator[np.ndarray]:
    """Per text its distinct shingle hashes, ascending. Fewer words than ``size`` make one
    shingle of all words, no words none."""
    every = windows(run.hashes, size)
    for i in range(len(run)):
        lo, hi = run.first[i], run.first[i + 1]
        n = hi - lo
        if n >= size:
            yield np.unique(every[lo : hi - size + 1])
        elif n:
            yield windows(run.hashes[lo:hi], int(n), 100 + int(n))
        else:
            yield np.zeros(0, U64)


class Ranges:
    """Hashes of any ranges of a run's words, by prefix sums: equal words give equal hashes
    wherever they stand."""

    _up = _down = np.ones(1, U64)

    def __init__(self, hashes: np.ndarray):
        n = len(hashes)
        if len(Ranges._up) <= n:
            room = 1 << int(n).bit_length()
            with np.errstate(over="ignore"):
                for name, factor in (("_up", _MULTIPLIER), ("_down", pow(_MULTIPLIER, -1, 2**64))):
                    steps = np.full(room, factor, U64)
                    steps[0] = 1
                    setattr(Ranges, name, np.cumprod(steps, dtype=U64))
        with np.errstate(over="ignore"):
            self.sums = np.concatenate([np.zeros(1, U64), np.cumsum(hashes * Ranges._up[:n], dtype=U64)])

    def __call__(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Hash of the words ``lo:hi`` of the run, for arrays of both."""
        with np.errstate(over="ignore"):
            return mix((self.sums[hi] - self.sums[lo]) * Ranges._down[lo] + mix((hi - lo).astype(U64), 5))


def rightmost_least(values: np.ndarray, size: int) -> np.ndarray:
    """For each window of ``size`` neighbours the place of its least value, the last of equal ones."""
    at, reach = np.arange(len(values)), 1
    while reach < size:
        step = min(reach, size - reach)
        left, right = at[:-step], at[step:]
        at = np.where(values[right] <= values[left], right, left)
        reach += step
    return at
