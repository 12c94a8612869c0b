"""Exact byte-pair encoding by a backtracking encoder, and decoding by an offset table.

The merges of a word are found without replaying them: an Aho-Corasick pass gives the longest token at
every place; the encoder walks through the word, takes the longest token that may stand beside its
predecessor and steps back where none may. Two tokens may stand side by side if undoing their merges
never shows a pair that would have been merged across their border first.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator
from pathlib import Path

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from tideline.llm.common import Memory, held, slices

# Fixed values of the vocabulary's format: end of word, pieces of a normalized text, white space.
WORD_END = "</w>"
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SPACES = re.compile(f"[{SPACE}]+")
SEPARATORS = re.compile("[\x1c-\x1f]")

MOST_PIECES = 150_000
MOST_PAIRS = 250_000
LONGEST_KEY = 64
DECODED_AT_ONCE = 1 << 16
TAIL = 0x1000


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(plain)]
    symbols = {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}
    return [symbols[b] for b in range(256)]


def pieces_pattern() -> re.Pattern:
    """Contractions, runs of letters, single numbers, and runs of other characters, by Unicode category."""
    classes = {"L": "", "N": ""}
    kinds = (unicodedata.category(chr(c))[0] for c in range(0x110000))
    for kind, run in itertools.groupby(enumerate(kinds), key=lambda pair: pair[1]):
        if kind in classes:
            places = [c for c, _ in run]
            classes[kind] += f"\\U{places[0]:08x}-\\U{places[-1]:08x}"
    letter, number = classes["L"], classes["N"]
    return re.compile(f"{CONTRACTIONS}|[{letter}]+|[{number}]|[^{SPACE}{letter}{number}]+")


class WordBpe:
    """The tables of one vocabulary; tokens are numbered by rank: single symbols, then merges in order."""

    def __init__(self, raw: bytes):
        spec = json.loads(raw)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.split_special = re.compile("|".join(re.escape(t) for t in sorted(self.special, key=len, reverse=True)) or r"(?!)")
        self.pieces = pieces_pattern()
        self.symbols = byte_symbols()
        names = [*self.symbols, *(c + WORD_END for c in self.symbols)]
        forms = [*self.symbols, *(chr(TAIL + ord(c)) for c in self.symbols)]
        rank = {name: k for k, name in enumerate(names)}
        self.parts = [(k, k) for k in range(len(names))]
        self.merged: dict[tuple[int, int], int] = {}
        for left, right in (m.split(" ") if isinstance(m, str) else m for m in merges):
            pair = rank[left], rank[right]
            self.merged[pair] = rank[left + right] = len(names)
            self.parts.append(pair)
            names.append(left + right)
            forms.append(forms[pair[0]] + forms[pair[1]])
        self.id_bytes = [vocab[n].to_bytes(4, "little") for n in names]
        by_form = {form: k for k, form in enumerate(forms)}
        if len(by_form) != len(forms):
            raise ValueError("two merges give one token")
        self.lengths = lengths = [len(form) for form in forms]
        self.shorter = [
            next((by_form[form[:n]] for n in range(len(form) - 1, 0, -1) if form[:n] in by_form), -1) for form in forms
        ]
        self.automaton = ahocorasick.Automaton()
        for k, form in enumerate(forms):
            self.automaton.add_word(form, (lengths[k] - 1, k))
        self.automaton.make_automaton()
        self.fits = Memory(lambda pair: self.compatible(*pair), MOST_PAIRS)
        by_id = {i: n for n, i in [*vocab.items(), *self.special.items()]}
        strings = [(by_id.get(i, "") + " ").encode() for i in range(max(by_id) + 1)]
        self.blob = np.frombuffer(b"".join(strings), np.uint8)
        self.offsets = np.concatenate([[0], np.cumsum([len(s) for s in strings])])
        self.encoded = Memory(self.encode_piece, MOST_PIECES, LONGEST_KEY)
        self.chunks = Memory(self.encode_chunk, MOST_PIECES, LONGEST_KEY)

    def compatible(self, left: int, right: int) -> bool:
        """Whether ``left`` and ``right`` stay two tokens when their bytes are encoded together.

        The later merge of the two is undone again and again; with equal ranks that on the right happened
        later. A pair seen on the way must not have a merge of its own that comes before those undone.
        """
        merged, parts = self.merged.get, self.parts
        newest = len(parts)
        while True:
            across = merged((left, right))
            if across is not None and across < newest:
                return False
            if left > right:
                newest, left = left, parts[left][1]
                if left == newest:
                    return True
            else:
                newest, right = right + 1, parts[right][0]
                if right + 1 == newest:
                    return True

    def encode_piece(self, piece: str) -> bytes:
        """Ids of the tokens of one piece of normalized text."""
        if not (piece.isascii() and piece.isprintable()):
            piece = "".join([self.symbols[b] for b in piece.encode()])
        form = piece[:-1] + chr(TAIL + ord(piece[-1]))
        size = len(form)
        longest = [0] * size
        for end, (before, k) in self.automaton.iter(form):
            longest[end - before] = k  # later ends are longer matches
        lengths, fits = self.lengths, self.fits
        taken: list[int] = []
        open_at = None
        at, token, last = 0, longest[0], -1
        while True:
            end = at + lengths[token]
            fit = (open_at is None or open_at[end]) and (last < 0 or fits[last, token])
            if fit:
                taken.append(token)
                if end == size:
                    return b"".join([self.id_bytes[k] for k in taken])
                at, last, token = end, token, longest[end]
            elif self.shorter[token] >= 0:
                token = self.shorter[token]
            else:
                open_at = open_at or bytearray(b"\x01") * (size + 1)
                open_at[at] = 0
                token = taken.pop()
                last = taken[-1] if taken else -1
                at -= lengths[token]

    def encode_chunk(self, chunk: str) -> bytes:
        """Ids, as little-endian 32-bit integers, of a text without white space and special tokens."""
        normal = unicodedata.normalize("NFC", chunk)
        normal = normal.lower() if "Σ" not in normal else "".join([c.lower() for c in normal])
        return b"".join(map(self.encoded.__getitem__, self.pieces.findall(normal)))

    def encode(self, text: str) -> bytes:
        """Ids of a whole text, as little-endian 32-bit integers."""
        if "<" not in text or not self.split_special.search(text):
            return self._plain(text)
        out, at = [], 0
        for found in self.split_special.finditer(text):
            out += [self._plain(text[at : found.start()]), self.special[found[0]].to_bytes(4, "little")]
            at = found.end()
        return b"".join([*out, self._plain(text[at:])])

    def _plain(self, text: str) -> bytes:
        chunks = text.split() if not SEPARATORS.search(text) else [c for c in SPACES.split(text) if c]
        return b"".join(map(self.chunks.__getitem__, chunks))

    def decoded(self, ids: np.ndarray) -> Iterator[bytes]:
        """The token strings joined by blanks, piece by piece, in UTF-8."""
        for at in range(0, len(ids), DECODED_AT_ONCE):
            part = ids[at : at + DECODED_AT_ONCE]
            starts, sizes = self.offsets[part], self.offsets[part + 1] - self.offsets[part]
            ends = np.cumsum(sizes)
            places = np.arange(ends[-1]) + np.repeat(starts - (ends - sizes), sizes)
            if at + DECODED_AT_ONCE >= len(ids):
                places = places[:-1]
            yield self.blob[places].tobytes()


def _tables(shared) -> WordBpe:
    """The tables of a broadcast vocabulary."""
    mark, raw = shared.value
    return held(mark, lambda: WordBpe(raw))


def _share(df: DataFrame, vocab_path: str):
    raw = Path(vocab_path).read_bytes()
    return df.sparkSession.sparkContext.broadcast((hashlib.sha256(raw).hexdigest(), raw))


def _mapped(df: DataFrame, vocab_path: str, in_col: str, made: list[tuple[str, str, pa.DataType]], fill) -> DataFrame:
    """``df`` with the columns ``made`` from column ``in_col``; of the same name, the new ones win."""
    shared, names = _share(df, vocab_path), [n for n, _, _ in made]
    kept = [c for c in df.columns if c not in names]
    schema = df.select(*[f"`{c}`" for c in kept]).schema
    schema = StructType([*schema, *StructType.fromDDL(", ".join(f"{n} {k}" for n, k, _ in made))])
    source = df.withColumn("__in", df[f"`{in_col}`"]).select(*[f"`{c}`" for c in kept], "__in")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = _tables(shared)
        for batch in slices(batches):
            values = fill(tables, batch.column(len(kept)))
            arrays = [pa.array(v, t) for v, (_, _, t) in zip(values, made)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *arrays], names=[*kept, *names])

    return source.mapInArrow(run, schema)


def encode(
    df: DataFrame, vocab_path: str, text_col: str = "text", ids_col: str = "ids", decoded_col: str | None = None
) -> DataFrame:
    """``df`` with the token ids of each whole text as an array; null and empty texts have none.

    With ``decoded_col`` the text that the ids decode to comes along, from the same pass.
    """
    made = [(ids_col, "array<int>", pa.list_(pa.int32()))]
    if decoded_col is not None:
        made.append((decoded_col, "string", pa.string()))

    def fill(tables: WordBpe, column: pa.Array):
        ids = [np.frombuffer(tables.encode(t or ""), "<u4").astype(np.int32) for t in column.to_pylist()]
        if decoded_col is None:
            return [ids]
        return ids, [b"".join(tables.decoded(i)).decode() for i in ids]

    return _mapped(df, vocab_path, text_col, made, fill)


def decode(df: DataFrame, vocab_path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``df`` with the text of each id array; a null array gives an empty text, a null or unknown id in one nothing."""

    def fill(tables: WordBpe, column: pa.Array):
        arrays = (np.array([i for i in v or () if i is not None and 0 <= i < len(tables.offsets) - 1], np.int64) for v in column.to_pylist())
        return [[b"".join(tables.decoded(ids)).decode() for ids in arrays]]

    return _mapped(df, vocab_path, ids_col, [(text_col, "string", pa.string())], fill)


def round_trip(df: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, number of tokens, SHA-256 of its ids and of the text decoded from them.

    A null text is empty: no tokens, digests of nothing. Repeated rows give one row each.
    """

    def fill(tables: WordBpe, column: pa.Array):
        counts, marks, texts = [], [], []
        for text in column.to_pylist():
            raw = tables.encode(text or "")
            ids, digest = np.frombuffer(raw, "<u4").astype(np.int64), hashlib.sha256()
            for piece in tables.decoded(ids):
                digest.update(piece)
            counts.append(len(ids))
            marks.append(hashlib.sha256(raw).hexdigest())
            texts.append(digest.hexdigest())
        return counts, marks, texts

    made = [
        ("n_tokens", "long", pa.int64()),
        ("ids_sha256", "string", pa.string()),
        ("decoded_sha256", "string", pa.string()),
    ]
    narrow = df.select(id_col, text_col)
    return _mapped(narrow, vocab_path, text_col, made, fill).drop(text_col)
