"""Quality rules: counts of words, symbols and repetition, then what public tokenisers make of a text."""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from pathlib import Path

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import held, modest, slices

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\v\f\r"
WINDOW = 8
MOST_WORDS = 80_000
LONGEST_WORD = 64
MOST_TOKENS = 1 << 14
WORDS_AT_ONCE = 10_000
#: Tokens of a window of entropy; a shorter text is one window, the last of a longer one takes the rest in.
ENTROPY_WINDOW = 1_024

# First code point of stretches of Unicode blocks, and the script of their letters.
SCRIPT_STARTS = [
    (0x0041, "Latn"), (0x0370, "Grek"), (0x0400, "Cyrl"), (0x0530, "Armn"), (0x0590, "Hebr"), (0x0600, "Arab"),
    (0x0900, "Deva"), (0x0980, "Zzzz"), (0x0E00, "Thai"), (0x0E80, "Zzzz"), (0x1100, "Hang"), (0x1200, "Zzzz"),
    (0x1E00, "Latn"), (0x1F00, "Grek"), (0x2000, "Zzzz"), (0x3040, "Kana"), (0x3100, "Hani"), (0xAC00, "Hang"),
    (0xD7B0, "Zzzz"), (0xF900, "Hani"), (0xFB00, "Zzzz"), (0x20000, "Hani"), (0x323B0, "Zzzz"),
]


@dataclass(frozen=True)
class Band:
    """What a text of ``n`` words may measure.

    Characters per token of either vocabulary lie between two bounds, the lower one less ``slack`` over the
    root of ``n``, since short texts scatter; the share of byte tokens is at most, and the entropy of the
    tokens at least so much. It is taken in windows of ``ENTROPY_WINDOW`` tokens that cover the whole text, in
    parts of the logarithm of their number, and averaged: over a whole text the logarithm grows with length
    while the entropy of a language does not.
    """

    chars_per_piece: tuple[float, float]
    chars_per_byte_token: tuple[float, float]
    slack: float
    fallback_share: float
    window_entropy: float


@dataclass(frozen=True)
class Bands:
    """A band per language, for texts whose language is not listed per script, and one for all others."""

    by_lang: dict[str, Band] = field(default_factory=dict)
    by_script: dict[str, Band] = field(default_factory=dict)
    other: Band = Band((0.1, 12.0), (0.1, 12.0), 0.0, 0.9, 0.4)


def _script_band(per_piece: float, fallback: float, slack: float = 0.5) -> Band:
    return Band((per_piece, 7.0), (0.2, 7.0), slack, fallback, 0.3)


# Lower bounds between what plain prose and letters drawn at random measure with the two public vocabularies. In Greek and
# Hebrew script nearly every letter is a token of its own, so there the bands tell the share of byte tokens only.
LATIN = Band((1.7, 7.0), (1.4, 7.0), 0.9, 0.05, 0.4)
SCRIPT_BANDS = {
    "Latn": LATIN, "Cyrl": _script_band(1.55, 0.05, 1.0), "Grek": _script_band(0.7, 0.05), "Hebr": _script_band(0.7, 0.05),
    "Arab": _script_band(0.8, 0.10), "Armn": _script_band(0.7, 0.33), "Deva": _script_band(0.58, 0.35), "Thai": _script_band(0.7, 0.2),
    "Hang": _script_band(0.45, 0.5), "Kana": _script_band(0.65, 0.3), "Hani": _script_band(0.4, 0.45),
}
BANDS = Bands(
    by_lang={
        "en": Band((2.14, 7.0), (2.13, 7.0), 1.4, 0.05, 0.4),
        "de": Band((2.18, 7.0), (1.97, 7.0), 1.4, 0.05, 0.4),
        "fr": Band((1.95, 7.0), (1.79, 7.0), 1.2, 0.05, 0.4),
        "es": Band((1.90, 7.0), (1.73, 7.0), 1.2, 0.05, 0.4),
    },
    by_script=SCRIPT_BANDS,
)


def script(text: str) -> str:
    """Script of most letters of a text; ``Zzzz`` without letters or for scripts not listed."""
    if text.isascii():
        return "Latn" if any(map(str.isalpha, text)) else "Zzzz"
    counts = np.zeros(len(SCRIPT_STARTS), np.int64)
    letters = "".join(filter(str.isalpha, text))
    points = np.frombuffer(letters.encode("utf-32-le", "surrogatepass"), np.uint32)
    starts = np.array([s for s, _ in SCRIPT_STARTS])
    counts += np.bincount(np.searchsorted(starts, points, side="right") - 1, minlength=len(starts))[: len(starts)]
    sums: dict[str, int] = {}
    for (_, name), n in zip(SCRIPT_STARTS, counts.tolist()):
        sums[name] = sums.get(name, 0) + n
    best = max(sums, key=lambda name: sums[name])
    return best if sums[best] else "Zzzz"


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of ``WINDOW`` words found twice or more, its first place included."""
    n = len(words) - WINDOW + 1
    if n < 2 or len(set(words)) == len(words):
        return 0
    marks = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    windows = np.zeros(n, np.uint64)
    for k in range(WINDOW):
        windows = windows * np.uint64(0x9E3779B97F4A7C15) + marks[k : k + n]
    order = np.argsort(windows, kind="stable")
    same = windows[order[1:]] == windows[order[:-1]]
    if not same.any():
        return 0
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, np.flatnonzero(twice), 1)
    np.add.at(edges, np.flatnonzero(twice) + WINDOW, -1)
    return int((np.cumsum(edges[:-1]) > 0).sum())


def duplicate_lines(text: str) -> int:
    """Lines with a word that equal an earlier line of the text."""
    lines = [line for line in text.split("\n") if line.strip(BLANKS)]
    return len(lines) - len(set(lines))


def window_entropies(ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Mean entropy of the windows of each of many texts, whose ``ids`` follow one another, ``sizes`` of each.

    The entropy of a window is taken in parts of the logarithm of its length (1 for a length of one); the windows
    of a text are weighted by their lengths. A text without ids has 0.
    """
    windows = np.maximum(sizes // ENTROPY_WINDOW, 1)
    first = np.concatenate([[0], np.cumsum(windows)])
    lengths = np.full(first[-1], ENTROPY_WINDOW, np.int64)
    lengths[first[1:] - 1] = sizes - (windows - 1) * ENTROPY_WINDOW
    marks = (np.repeat(np.arange(len(lengths)), lengths) << 16) | ids
    marks.sort()
    starts = np.flatnonzero(np.concatenate([[True], marks[1:] != marks[:-1]])) if len(marks) else np.zeros(0, np.int64)
    runs = np.diff(np.append(starts, len(marks)))
    weight = np.bincount(marks[starts] >> 16, runs * np.log2(runs), minlength=len(lengths))
    whole = 1 - weight / (np.maximum(lengths, 2) * np.log2(np.maximum(lengths, 2)))
    return np.add.reduceat(whole * lengths, first[:-1]) / np.maximum(sizes, 1)


class Tokenisers:
    """Both vocabularies over words; a word is encoded as it stands after a blank."""

    def __init__(self, piece_model: bytes, byte_ranks: bytes):
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=piece_model)
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, byte_ranks.splitlines())}
        pattern = r" ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+"
        self.bytes = tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.size = self.pieces.get_piece_size()
        self.is_byte = np.array([self.pieces.is_byte(k) for k in range(self.size)])
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def encoded(self, words: set[bytes]) -> dict[bytes, bytes]:
        """Of each word its piece numbers, then ``size`` plus the number of its byte-level tokens (in parts, if very many).

        Words seen before are remembered in two generations of ``MOST_WORDS``; new ones are encoded together.
        """
        out, new, young, old = {}, [], self.young, self.old
        for word in words:
            value = young.get(word)
            if value is None:
                value = old.get(word)
                if value is None:
                    new.append(word)
                    continue
                young[word] = value
            out[word] = value
        count, size = self.bytes.encode_ordinary, self.size
        for at in range(0, len(new), WORDS_AT_ONCE):
            part = new[at : at + WORDS_AT_ONCE]
            texts = [word.decode() for word in part]
            for word, text, ids in zip(part, texts, self.pieces.encode(texts, num_threads=1)):
                tokens = len(count(" " + text))
                ids += [size + MOST_TOKENS] * (tokens // MOST_TOKENS)
                ids.append(size + tokens % MOST_TOKENS)
                out[word] = value = array("H", ids).tobytes()
                if len(word) <= LONGEST_WORD:
                    young[word] = value
        if len(young) >= MOST_WORDS:
            self.old, self.young = young, {}
        return out

    def measure_all(self, texts: list[list[bytes]], word_chars: list[int]) -> list[tuple[float, float, float, float]]:
        """Of each text, given as its words: characters per piece and per byte-level token, share of byte pieces, entropy.

        The entropy is the mean of windows of pieces that cover the whole text; see ``window_entropies``.
        """
        known = self.encoded(set().union(*texts))
        raw = [b"".join(map(known.__getitem__, words)) for words in texts]
        ids = np.frombuffer(b"".join(raw), np.uint16).astype(np.int64)
        ends = np.cumsum([len(r) // 2 for r in raw])
        is_piece = ids < self.size
        upto = lambda values: np.diff(np.concatenate([[0], np.concatenate([[0], np.cumsum(values)])[ends]]))
        n, tokens = upto(is_piece), upto(np.where(is_piece, 0, ids - self.size))
        pieces = ids[is_piece]
        fallback = np.concatenate([[0], np.cumsum(self.is_byte[pieces])])[np.cumsum(n)]
        fallback = np.diff(np.concatenate([[0], fallback])) / np.maximum(n, 1)
        chars = np.array(word_chars, np.int64)
        flatness = window_entropies(pieces, n)
        return list(zip((chars / np.maximum(n, 1)).tolist(), (chars / np.maximum(tokens, 1)).tolist(), fallback.tolist(), flatness.tolist()))


def judge_all(texts: list[str | None], langs: list[str | None], tools: Tokenisers, bands: Bands) -> list[tuple]:
    """All measures of each text; see ``RESULT``."""
    texts = [t or "" for t in texts]
    words = [t.encode().split() for t in texts]
    chars = [len(t) - sum(map(t.count, BLANKS)) for t in texts]
    out = []
    for text, own, n_chars, lang, measured in zip(texts, words, chars, langs, tools.measure_all(words, chars)):
        repeats = repeated_words(own)
        failed = len(own) < 20 or 100 * repeats > 30 * len(own)
        per_piece, per_token, fallback, flatness = measured
        band = bands.by_lang.get(lang or "")
        band = band or bands.by_script.get(script(text), bands.other)
        slack = band.slack / max(len(own), 1) ** 0.5
        inside = (
            band.chars_per_piece[0] - slack <= per_piece <= band.chars_per_piece[1]
            and band.chars_per_byte_token[0] - slack <= per_token <= band.chars_per_byte_token[1]
            and fallback <= band.fallback_share
            and flatness >= band.window_entropy
        )
        out.append((
            len(own), n_chars, sum(map(text.count, SYMBOLS)), duplicate_lines(text), repeats,
            failed, not failed and inside, *(round(x, 6) for x in measured),
        ))
    return out


RESULT = [
    *((n, "long", pa.int64()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
    *((n, "boolean", pa.bool_()) for n in ("base_failed", "kept")),
    *((n, "double", pa.float64()) for n in ("chars_per_piece", "chars_per_token", "fallback_share", "window_entropy")),
]


def judged(docs: DataFrame, piece_path: str, byte_path: str, bands: Bands = BANDS, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` (none named as in ``RESULT``) of every row with the measures and the verdict on its text.

    The verdict rests on the whole text. A null text has no words, so it fails as an empty one does. The band
    is that of the row's ``lang`` if there is one for it, else that of the script of most letters.
    """
    raw = docs.sparkSession.sparkContext.broadcast((Path(piece_path).read_bytes(), Path(byte_path).read_bytes()))
    lang = docs["lang"] if "lang" in docs.columns else F.lit(None).cast("string")
    source = docs.select(*[docs[f"`{c}`"] for c in keep], docs["text"].alias("__text"), lang.alias("__lang"))
    schema = docs.select(*[f"`{c}`" for c in keep]).schema
    for name, kind, _ in RESULT:
        schema = schema.add(name, kind)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = held(("rules", piece_path, byte_path), lambda: Tokenisers(*raw.value))
        for batch in slices(batches, 500):
            texts, langs = (batch.column(len(keep) + k).to_pylist() for k in (0, 1))
            rows = judge_all(texts, langs, tools, bands)
            made = [pa.array(list(v), kind) for v, (_, _, kind) in zip(zip(*rows) if rows else [()] * len(RESULT), RESULT)]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *made], names=schema.names)

    return modest(source).mapInArrow(run, schema)


def filtered(docs: DataFrame, piece_path: str, byte_path: str, bands: Bands = BANDS) -> DataFrame:
    """The rows of ``docs`` whose text is kept, with all their columns."""
    packed = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("__row"), docs["text"].alias("text"), *([docs["lang"].alias("lang")] if "lang" in docs.columns else []))
    return judged(packed, piece_path, byte_path, bands, keep=("__row",)).where("kept").select("__row.*")
