"""BPE encoding and decoding with forced boundaries.

A pair of neighbouring bytes that no vocabulary token has inside is a certain cut: no merge
can ever span it. ``inner_pairs`` computes the others from the vocabulary. Of the certain
cuts those before a space are used, where the character before is not white space: there the
pre-tokenizer starts anew too, whatever stands on either side (white space always opens a
new pre-token after another character, and no look-ahead of the pattern reaches over the
cut from the left). Texts fall into fragments there, each different fragment is encoded
once while it is remembered, and the ids are concatenated. New fragments are encoded
together, as one text that is cut at the same boundaries again. Decoding works on the ids
alone: the bytes of all tokens, joined, then read as UTF-8 with replacement.

Memory: the memo of a task holds at most ``MEMO`` fragments of at most ``MEMO_CHARS``
characters and is emptied when full; longer ones are encoded in place. A text is held
whole, as its row is.

Defined results: a null or empty text has no ids and decodes to the empty text; strings
that spell special tokens become those tokens, as the plain tokenizer does it; repeated
rows and ids are encoded one by one; no other column is read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MEMO = 400_000
MEMO_CHARS = 64

#: How the byte-level pre-tokenizer cuts texts (a fixed value of the file format).
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)


def byte_alphabet() -> dict[str, int]:
    """Character to byte in byte-level vocabularies: printable Latin-1 stands for itself,
    the rest follow from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def token_bytes(path: str) -> list[bytes]:
    """Bytes of each id of a byte-level tokenizer file."""
    from tokenizers import Tokenizer

    tokenizer, alphabet = Tokenizer.from_file(path), byte_alphabet()
    table = [b""] * tokenizer.get_vocab_size()
    for token, i in tokenizer.get_vocab().items():
        try:
            table[i] = bytes(alphabet[c] for c in token)
        except KeyError:
            table[i] = token.encode()
    return table


def inner_pairs(tokens: list[bytes]) -> np.ndarray:
    """256 x 256: whether the pair of bytes stands inside some token."""
    found = np.zeros((256, 256), bool)
    for token in tokens:
        if len(token) > 1:
            b = np.frombuffer(token, np.uint8)
            found[b[:-1], b[1:]] = True
    return found


def no_cut(tokens: list[bytes]) -> re.Pattern:
    """Matches a space that is not taken as a forced boundary: after white space, or after
    a character whose last byte some token has before a space. Characters beyond 16 bits
    count among these."""
    last = set(np.flatnonzero(inner_pairs(tokens)[:, 0x20]).tolist())
    plain = "".join(re.escape(chr(b)) for b in sorted(last) if b < 0x80)
    wide = "".join(chr(c) for c in range(0x80, 0xD800) if 0x80 | c & 0x3F in last)
    wide += "".join(chr(c) for c in range(0xE000, 0x10000) if 0x80 | c & 0x3F in last)
    return re.compile(f"[\\s{plain}{wide}\U00010000-\U0010ffff] ")


class Codec:
    """Encoder and decoder of one task."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.whole.no_truncation()
        self.whole.no_padding()
        self.tokens = token_bytes(path)
        self.specials = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, self.specials)) or "(?!)").search
        ids = {t: i for i, t in enumerate(self.tokens) if t.decode("utf-8", "replace") not in self.specials}
        self.merges = tiktoken.Encoding("fragments", pat_str=PATTERN, mergeable_ranks=ids, special_tokens={})
        self.no_cut = no_cut(self.tokens)
        self.sizes = np.array([len(t) for t in self.tokens], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(self.tokens), np.uint8)
        self.memo: dict[str, bytes] = {}  # of fragments without their leading space

    def _one(self, fragment: str) -> bytes:
        if self.special(fragment):
            return np.asarray(self.whole.encode(fragment, add_special_tokens=False).ids, "<u4").tobytes()
        return np.asarray(self.merges.encode_ordinary(fragment), "<u4").tobytes()

    def _learn(self, pieces: list[str]) -> None:
        """Remembers pieces that end in no white space: joined, they are cut between each other."""
        joined = "".join([" " + p for p in pieces])
        ids = np.asarray(self.merges.encode_ordinary(joined), "<u4")
        ends = np.cumsum([len(p.encode()) + 1 for p in pieces])
        upto = (np.searchsorted(np.cumsum(self.sizes[ids]), ends, "left") + 1) * 4
        raw, last = ids.tobytes(), 0
        for p, end in zip(pieces, upto.tolist(), strict=True):
            self.memo[p] = raw[last:end]
            last = end

    def fragments(self, text: str) -> list[str]:
        """The fragments of a text, all but the first without the space they begin with."""
        pieces = text.split(" ")
        if not self.no_cut.search(text):
            return pieces
        whole, part = [], pieces[0]
        for p in pieces[1:]:
            if part and not self.no_cut.match(part[-1] + " "):
                whole.append(part)
                part = p
            else:
                part = f"{part} {p}"
        return [*whole, part]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        memo, cut, new = self.memo, [], set()
        for t in texts:
            first, *pieces = self.fragments(t)
            last = pieces.pop() if pieces else None
            cut.append((first, pieces, last))
            new.update(pieces)
        new = [p for p in new if p not in memo]
        if len(memo) + len(new) > MEMO:
            memo.clear()
            new = list({p for _, pieces, _ in cut for p in pieces})
        plain = [p for p in new if len(p) <= MEMO_CHARS and p and not self.special(p) and not p[-1].isspace()]
        for at in range(0, len(plain), 50_000):
            self._learn(plain[at : at + 50_000])
        apart = {p: self._one(" " + p) for p in set(new).difference(plain)}
        get = memo.__getitem__ if not apart else (lambda p: apart[p] if p in apart else memo[p])
        return [
            self._one(first) + b"".join(map(get, pieces)) + (self._one(" " + last) if last is not None else b"")
            for first, pieces, last in cut
        ]

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def decode_bytes(self, ids: bytes) -> bytes:
        """The decoded text in UTF-8."""
        every = np.frombuffer(ids, "<u4")
        sizes = self.sizes[every]
        places = np.arange(sizes.sum()) + np.repeat(self.starts[every] - np.cumsum(sizes) + sizes, sizes)
        return self.bytes[places].tobytes().decode("utf-8", "replace").encode()


def _coded(batches: Iterator[pa.RecordBatch], path: str, digest: bool) -> Iterator[pa.RecordBatch]:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
    codec = Codec(path)
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            ids = codec.encode_all([t or "" for t in part.column(1).to_pylist()])
            counts = pa.array([len(x) // 4 for x in ids], pa.int64())
            if digest:
                columns = [
                    counts,
                    pa.array([hashlib.sha256(x).hexdigest() for x in ids]),
                    pa.array([hashlib.sha256(codec.decode_bytes(x)).hexdigest() for x in ids]),
                ]
                names = ["n_tokens", "ids_sha256", "decoded_sha256"]
            else:
                columns = [counts, pa.array(ids, pa.binary()), pa.array([codec.decode_bytes(x).decode() for x in ids])]
                names = ["n_tokens", "ids", "decoded"]
            yield pa.RecordBatch.from_arrays([part.column(0), *columns], names=[batch.schema.names[0], *names])


def _apply(docs: DataFrame, path: str, id_col: str, text_col: str, digest: bool, columns: str) -> DataFrame:
    rows = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("__text"))
    kind = rows.schema[0].dataType.simpleString()
    return rows.mapInArrow(lambda batches: _coded(batches, path, digest), f"`{id_col}` {kind}, {columns}")


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_tokens, ids (binary, little-endian unsigned 32-bit), decoded text."""
    return _apply(docs, path, id_col, text_col, False, "n_tokens long, ids binary, decoded string")


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_tokens, and SHA-256 of the ids and of the decoded text, made in the
    task so that ids and texts need not leave it."""
    return _apply(docs, path, id_col, text_col, True, "n_tokens long, ids_sha256 string, decoded_sha256 string")
