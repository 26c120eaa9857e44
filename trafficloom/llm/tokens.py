"""Byte-pair tokens of whole texts: ids, and the exact token count of every prefix.

Texts are cut before white space that follows something else; byte-level pairs never cross such a
place, so a text's ids are the ids of its chunks one after the other, and chunks repeat. Ids are
those of the tokenizer library. Prefix counts come from dynamic programming over the bytes of a piece:
the encoding of a prefix ends with the one token that leaves a prefix whose own last token it may
follow; so every prefix has its count after one walk, without encoding it.
"""

from __future__ import annotations

import json
import re
import struct
from itertools import chain
from operator import sub

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_small_batches, use_cache

VOCABULARY = "byte_bpe_50k.json"
#: White space and what follows it.
CHUNK = re.compile(r"\s*\S+|\s+")
#: Python counts 0x1C to 0x1F as white space, the library does not; 0 and 1 are marks below.
ODD = re.compile("[\x00\x01\x1c-\x1f]")
#: A blank or line end inside such a run, or at the end after white space, is no place to cut.
CLOSE = re.compile(r"\s\s(?:\s|\Z)")
#: Pieces that the vocabulary's pattern takes whole although their first two letters are not one.
CONTRACTIONS = ("'re", "'ve", "'ll")
WIDE, RUN = re.compile(r"\s\s"), regex.compile(r"\s{2,}(?=\S)")
#: Chunks remembered per Python worker, and the longest that is remembered.
REMEMBERED = 500_000
LONGEST = 48


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def chunks(text: str, close: re.Pattern = CLOSE) -> list[str]:
    """The text's chunks by key: of one that starts with a blank the rest, of one that starts with
    a line end 0 and the rest, of another 1 and the whole. Splitting at blanks is what Python does
    fastest; texts with runs of white space are cut by the pattern instead."""
    if not text:
        return []
    if ODD.search(text):
        return ["\1" + text]
    if close.search(text):
        return ["\1" + c for c in CHUNK.findall(text)]
    return ("\1" + text).replace("\n", " \0").split(" ")


def chunk_of(key: str) -> str:
    mark = key[:1]
    return key[1:] if mark == "\1" else "\n" + key[1:] if mark == "\0" else " " + key


class _Remembered(dict):
    """Remembered chunks by key; others are worked out."""

    def __init__(self, work, most: int = REMEMBERED):
        super().__init__()
        self.work, self.most = work, most

    def __missing__(self, chunk: str) -> bytes:
        value = self.work(chunk_of(chunk))
        if len(chunk) <= LONGEST and len(self) < self.most:
            self[chunk] = value
        return value


class Vocabulary:
    """Tokens, merges and special tokens of a byte-level BPE vocabulary file."""

    def __init__(self, path: str):
        import public_tokenizers

        with open(path, encoding="utf-8") as file:
            given = json.load(file)
        kind = (given.get("pre_tokenizer") or {}).get("type")
        if given.get("normalizer") or given["model"].get("type", "BPE") != "BPE" or kind != "ByteLevel":
            raise ValueError("a byte-level BPE vocabulary without normaliser is needed")
        char = self._byte_characters()
        self.special = [t["content"] for t in given["added_tokens"]]
        self.tokens = {
            bytes(char[c] for c in token): i
            for token, i in given["model"]["vocab"].items()
            if token not in self.special
        }
        pairs = (m.split(" ") if isinstance(m, str) else m for m in given["model"]["merges"])
        self.merges = [tuple(bytes(char[c] for c in x) for x in pair) for pair in pairs]
        self.pattern = public_tokenizers.PATTERN

    @staticmethod
    def _byte_characters() -> dict[str, int]:
        """The printable characters stand for themselves, other bytes for those from 256 on."""
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        rest = [b for b in range(256) if b not in set(plain)]
        return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}

    def has_special(self, text: str) -> bool:
        return any(map(text.__contains__, self.special))


class Ids:
    """Token ids of texts as unsigned little-endian 32-bit numbers.

    The ids are the tokenizer library's. Chunks without special strings go through the same
    vocabulary in tiktoken, which gives the same ids four times as fast (where ids follow the
    order of the merges, as they must there); chunks with special strings go through the library.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.vocabulary = own = Vocabulary(path)
        made = [own.tokens[a + b] for a, b in own.merges]
        self.fast = None
        if made == sorted(made):
            self.fast = tiktoken.Encoding(
                "own", pat_str=own.pattern, mergeable_ranks=own.tokens, special_tokens={}
            )
        self.known = _Remembered(self.of_chunk)

    def caches(self) -> tuple[dict, ...]:
        return (self.known,)

    def of_chunk(self, chunk: str) -> bytes:
        if self.fast is None or self.vocabulary.has_special(chunk):
            ids = self.library.encode(chunk, add_special_tokens=False).ids
        else:
            ids = self.fast.encode_ordinary(chunk)
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.known.__getitem__, chunks(text)))


class Prefixes:
    """Token counts of all prefixes of a chunk, by dynamic programming."""

    def __init__(self, path: str):
        self.vocabulary = own = Vocabulary(path)
        self.tokens = own.tokens
        #: Rank of the merge of two tokens, by both ids in one number; what a token is merged
        #: from, and when (-1: single bytes are there from the start).
        self.rank: dict[int, int] = {}
        size = max(self.tokens.values()) + 1
        self.left, self.right, self.order = [-1] * size, [-1] * size, [-1] * size
        for i, (a, b) in enumerate(own.merges):
            x, y, made = self.tokens[a], self.tokens[b], self.tokens[a + b]
            self.rank[x << 20 | y] = i
            self.left[made], self.right[made], self.order[made] = x, y, i
        self.longest = max(map(len, self.tokens))
        self.pieces = regex.compile(own.pattern)
        self.split = regex.compile("|".join(map(regex.escape, sorted(own.special))))
        self.may_follow: dict[int, bool] = {}
        self.formed: dict[int, bool] = {}
        self.known = _Remembered(self.steps)
        self.known_pieces: dict[str, bytes] = {}

    def caches(self) -> tuple[dict, ...]:
        return self.known, self.known_pieces, self.may_follow

    def _formed(self, token: int) -> bool:
        """Whether the token's own bytes are encoded as the token."""
        if self.order[token] < 0:
            return True
        a, b = self.left[token], self.right[token]
        return self._formed(a) and self._formed(b) and self._stay(a, b, self.order[token])

    def _stay(self, left: int, right: int, until: int = 1 << 60) -> bool:
        """Whether no merge before the given rank joins bytes of the two tokens: undo the younger
        of the two at the border again and again, and look whether its neighbour would have been
        joined before it was made. Of equal merges the left one comes first."""
        rank, order = self.rank, self.order
        while True:
            if rank.get(left << 20 | right, until) < until:
                return False
            a, b = order[left], order[right]
            if a > b:
                left, until = self.right[left], a
            elif b >= 0:
                right, until = self.left[right], b + 1
            else:
                return True

    def of_bytes(self, data: bytes) -> list[int]:
        """Token count of data[:i] for i from 1."""
        counts, last = [0], [-1]
        get, longest, memo, formed, stay = (
            self.tokens.get, self.longest, self.may_follow, self.formed, self._stay
        )
        for i in range(1, len(data) + 1):
            # One token ends here; it is short more often than not.
            for j in range(i - 1, i - longest - 1 if i > longest else -1, -1):
                token = get(data[j:i])
                if token is None:
                    continue
                if j:
                    key = last[j] << 20 | token
                    fine = memo.get(key)
                    if fine is None:
                        fine = stay(last[j], token)
                        if len(memo) < REMEMBERED:
                            memo[key] = fine
                else:
                    fine = formed.get(token)
                    if fine is None:
                        fine = formed[token] = self._formed(token)
                if fine:
                    counts.append(counts[j] + 1)
                    last.append(token)
                    break
            else:
                raise ValueError("a byte is missing in the vocabulary")
        return counts[1:]

    def of_piece(self, piece: str) -> list[int] | bytes:
        """Token count of piece[:i], i from 1 in characters, the prefix encoded as one piece."""
        held = self.known_pieces.get(piece)
        if held is None:
            data = piece.encode("utf-8")
            held = self.of_bytes(data)
            if len(data) > len(piece):  # only where a character ends
                held = [c for c, after in zip(held, data[1:] + b" ") if after & 0xC0 != 0x80]
            if len(piece) <= LONGEST:
                held = bytes(held)
                if len(self.known_pieces) < REMEMBERED:
                    self.known_pieces[piece] = held
        return held

    def of_text(self, text: str) -> list[int]:
        """Token count of text[:i] for i from 1, special tokens read as the library does."""
        if not self.vocabulary.has_special(text):
            return self._plain(text)
        marks = self.split.finditer(text)
        out, at, base = [], 0, 0
        for m in marks:
            # Inside the mark it is ordinary text, which may join what stands before.
            inside = self._plain(text[at : m.end() - 1])
            before = self._plain(text[at : m.start()]) if m.start() > at else []
            out += [base + c for c in before]
            out += [base + c for c in inside[len(before) :]]
            base += (before[-1] if before else 0) + 1
            out.append(base)
            at = m.end()
        return out + [base + c for c in (self._plain(text[at:]) if at < len(text) else [])]

    def _plain(self, text: str) -> list[int] | bytes:
        if text[1:].isalpha() and (text[0] == " " or text[0].isalpha()):
            return self.of_piece(text)
        out: list[int] = []
        base = 0
        for piece in self.pieces.findall(text):
            own = self.of_piece(piece)
            if piece in CONTRACTIONS:
                own = [1, 2, own[-1]]  # cut after two characters it is two pieces
            out += [base + c for c in own] if base else own
            base += own[-1]
        if WIDE.search(text):
            # White space before a word: a prefix that ends inside the run is one piece there.
            for m in RUN.finditer(text):
                start = out[m.start() - 1] if m.start() else 0
                out[m.start() : m.end()] = [start + c for c in self.of_piece(m.group())]
        return out

    def steps(self, chunk: str) -> bytes:
        """Change of the count with each character of the chunk."""
        counts = self.of_text(chunk)
        return struct.pack(f"<{len(counts)}h", *map(sub, counts, chain((0,), counts)))

    def encode(self, text: str) -> bytes:
        """The steps of a whole text."""
        return b"".join(map(self.known.__getitem__, chunks(text, WIDE)))


_MADE: dict = {}


def reader(kind, vocabulary: str):
    """One per Python worker and vocabulary."""
    key = (kind, vocabulary)
    if key not in _MADE:
        _MADE[key] = kind(vocabulary_path(vocabulary))
    use_cache(*_MADE[key].caches())
    return _MADE[key]


def counts_of(steps: bytes) -> np.ndarray:
    """Token count of every prefix, the empty one first, from the stored steps."""
    return np.concatenate([[0], np.cumsum(np.frombuffer(steps, "<i2"), dtype=np.int64)])


def tokens_in_prefix(steps: bytes, characters: int) -> int:
    """Tokens of the text's first characters."""
    return int(counts_of(steps)[min(characters, len(steps) // 2)])


def longest_prefix(steps: bytes, budget: int) -> int:
    """Characters of the longest prefix with at most this many tokens."""
    return int(np.flatnonzero(counts_of(steps) <= budget)[-1])


def prefix_counts(
    docs: DataFrame,
    budget: int = 1024,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str = VOCABULARY,
) -> DataFrame:
    """Per row: doc_id, n_bytes, n_tokens, fits_chars (characters of the longest prefix within the
    budget) and steps: two bytes for each character, the change of the token count with it, from
    which counts_of, tokens_in_prefix and longest_prefix answer without encoding again.

    Null and empty texts have no bytes and no tokens. Rows are answered one by one: repeated ids
    and null ids stay. An empty table gives no rows; other columns are not read.
    """

    def work(batches):
        made = reader(Prefixes, vocabulary)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                texts = [t or "" for t in batch.column(1).slice(at, 256).to_pylist()]
                steps = [made.encode(t) for t in texts]
                sums = [np.cumsum(np.frombuffer(s, "<i2"), dtype=np.int64) for s in steps]
                fits = [
                    len(s) if not len(s) or s.max() <= budget else int(np.flatnonzero(np.concatenate([[0], s]) <= budget)[-1])
                    for s in sums
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, 256).cast(pa.int64()),
                        pa.array([len(t.encode()) for t in texts], pa.int64()),
                        pa.array([int(s[-1]) if len(s) else 0 for s in sums], pa.int64()),
                        pa.array(fits, pa.int64()),
                        pa.array(steps, pa.binary()),
                    ],
                    ["doc_id", "n_bytes", "n_tokens", "fits_chars", "steps"],
                )

    docs = in_small_batches(docs)
    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(
        work, "doc_id long, n_bytes long, n_tokens long, fits_chars long, steps binary"
    )
