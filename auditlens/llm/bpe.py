"""BPE encoding by backtracking over longest matches, and decoding by an offset table.

The vocabulary is put into one Aho-Corasick automaton. A word is encoded from the left with the
longest token that starts there; a token may follow another one only if they are compatible,
that is, if merging the two tokens' bytes by rank would leave the border between them alone.
A position from which no token leads on is dead, and the last token is taken back. Each prefix
of a word has one valid last token, so every position dies at most once and the work is linear
in the word. Distinct words are encoded once per task. Decoding copies spans of one byte array
that holds all token texts, found through their offsets.

The tokenizer file is a parameter; it is read on the driver and broadcast (its size is bounded
by its vocabulary). Files of this kind are understood: special tokens cut from the raw text,
NFC, lower case by character, a split into letters, single digits, other characters and
English clitics, bytes as characters, merges by rank, and a word-end suffix; decoded tokens are
joined by one space.

Defined results: a null or empty text has no tokens and decodes to the empty text; repeated
rows get equal rows; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditlens.llm.packed import thrifty, tuned

CACHED_WORDS = 300_000
_END = "\ue000"  # stands for the word-end suffix; no byte character has this code
# The word pattern of the tokenizer file, white space being dropped.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+"


def byte_characters() -> list[str]:
    """The printable character that stands for each byte: itself where it is printable,
    otherwise the next free one from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    free = iter(range(256, 512))
    return [chr(b if b in printable else next(free)) for b in range(256)]


class Encoder:
    """Tables of one tokenizer file (its JSON text)."""

    def __init__(self, source: str):
        spec = json.loads(source)
        model = spec["model"]
        suffix = model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.texts = {**{i: t for t, i in model["vocab"].items()}, **{i: t for t, i in self.special.items()}}
        own = lambda t: t[: -len(suffix)] + _END if t.endswith(suffix) and t != suffix else t
        ids = {own(t): i for t, i in model["vocab"].items()}
        self.merged: dict[tuple[int, int], int] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        self.rank = {i: -1 for i in ids.values()}  # base symbols were there before all merges
        for rank, pair in enumerate(model["merges"]):
            a, b = (ids[own(t)] for t in (pair if isinstance(pair, list) else pair.split(" ")))
            whole = ids[own("".join(pair) if isinstance(pair, list) else pair.replace(" ", ""))]
            self.merged[a, b] = whole
            self.halves[whole] = (a, b)
            self.rank[whole] = rank
        self.automaton = ahocorasick.Automaton()
        for t, i in ids.items():
            if i in self.halves or len(t) == 1 or t[1:] == _END:
                self.automaton.add_word(t, (len(t), i))
        self.automaton.make_automaton()
        self.pairs: dict[tuple[int, int], bool] = {}
        self.bytes = byte_characters()
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.pieces = regex.compile(PIECES)
        # offset table: texts of all ids, and of their decimal forms, each with the joining space
        top = max(self.texts) + 1
        self.text_bytes, self.text_at = _table([self.texts.get(i, "").encode() + b" " for i in range(top)])
        self.number_bytes, self.number_at = _table([b"%d " % i for i in range(top)])

    def compatible(self, a: int, b: int) -> bool:
        """Whether merging by rank leaves the border between tokens a and b alone.

        Both tokens are taken apart in the reverse order of their merges. As long as two parts
        face each other across the border, their own merge would have had to come first.
        """
        known = self.pairs.get((a, b))
        if known is None:
            known = self.pairs[a, b] = self._border_holds(a, b)
            if len(self.pairs) > 2_000_000:
                self.pairs.clear()
        return known

    def _border_holds(self, a: int, b: int) -> bool:
        # `until`: the parts face each other only before this moment, as (rank, place); of equal
        # ranks the merge further left comes first
        until = (len(self.merged), 0)
        while True:
            whole = self.merged.get((a, b))
            if whole is not None and (self.rank[whole], 1) < until:
                return False
            ra, rb = self.rank[a], self.rank[b]
            if ra < 0 and rb < 0:
                return True
            if ra > rb:
                until, a = (ra, 0), self.halves[a][1]
            else:
                until, b = (rb, 2), self.halves[b][0]

    def word(self, piece: str) -> list[int]:
        """Token ids of one piece of text."""
        chars = "".join([self.bytes[b] for b in piece.encode()]) + _END
        n = len(chars)
        starts: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        for last, (length, token) in self.automaton.iter(chars):
            starts[last - length + 1].append((length, token))  # for one start, longer ones come later
        dead, tokens, tried, pos, i = set(), [], [], 0, len(starts[0]) - 1
        while pos < n:
            while i >= 0:
                length, token = starts[pos][i]
                if pos + length not in dead and (not tokens or self.compatible(tokens[-1], token)):
                    break
                i -= 1
            if i >= 0:
                tokens.append(token)
                tried.append((pos, i))
                pos += length
                i = len(starts[pos]) - 1 if pos < n else -1
            else:
                dead.add(pos)
                pos, i = tried.pop()
                tokens.pop()
                i -= 1
        return tokens

    def split(self, text: str) -> list[str | int]:
        """Pieces of a text, and the ids of special tokens."""
        if self.split_special is not None and self.split_special.search(text):
            out: list[str | int] = []
            for part in self.split_special.split(text):
                out += [self.special[part]] if part in self.special else self._plain(part)
            return out
        return self._plain(text)

    def _plain(self, text: str) -> list[str]:
        if not text.isascii():
            # lower case goes by character: no other form of sigma at the end of a word
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return self.pieces.findall(text.lower())


def _table(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])


def copy_spans(source: np.ndarray, at: np.ndarray, which: np.ndarray) -> np.ndarray:
    """Concatenation of source[at[i]:at[i + 1]] over ``which``."""
    start, length = at[which], at[which + 1] - at[which]
    end = np.cumsum(length)
    return source[np.repeat(start - (end - length), length) + np.arange(int(end[-1]) if len(end) else 0)]


class _Words(dict):
    """Index of each distinct word in a growing table of token ids."""

    def __init__(self, encoder: Encoder):
        super().__init__()
        self.encoder, self.ids, self.ends = encoder, [], [0]

    def __missing__(self, word):
        self.ids += [word] if isinstance(word, int) else self.encoder.word(word)
        self.ends.append(len(self.ids))
        self[word] = n = len(self.ends) - 2
        return n


def encoded(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row of ``docs`` (doc_id, text)."""
    spark = tuned(docs.sparkSession)
    with open(tokenizer, encoding="utf-8") as f:
        source = spark.sparkContext.broadcast(f.read())

    def encode(batches):
        encoder = Encoder(source.value)
        words = _Words(encoder)
        for batch in batches:
            if len(words) > CACHED_WORDS:
                words = _Words(encoder)
            index = [np.fromiter(map(words.__getitem__, encoder.split(t.as_py() or "")), np.int64) for t in batch.column(1)]
            flat, at = np.array(words.ids, np.int64), np.array(words.ends, np.int64)
            n, ids_hash, text_hash = [], [], []
            for which in index:
                ids = copy_spans(flat, at, which)
                n.append(len(ids))
                ids_hash.append(hashlib.sha256(copy_spans(encoder.number_bytes, encoder.number_at, ids)[:-1].tobytes()).hexdigest())
                text_hash.append(hashlib.sha256(copy_spans(encoder.text_bytes, encoder.text_at, ids)[:-1].tobytes()).hexdigest())
            columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(ids_hash, pa.string()), pa.array(text_hash, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    ddl = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(thrifty(encode), ddl)
