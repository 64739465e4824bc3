"""Operator 6: BPE encoding and decoding of whole documents.

The encoder finds all vocabulary tokens in a word with one Aho-Corasick pass,
then takes the longest token at each place whose pair with the token before it
is compatible, and backtracks where none is; a place from which no way leads on
is marked, so each is left at most once and the time is linear.  Two tokens are
compatible if the merges would leave them apart: the merges of the text across
their border are undone from the latest on, and none of lower rank may join
them.  Answers are kept in a table.  The result is what applying the merges in
order gives.  Decoding reads token strings from one blob by an offset table.

Works for a tokenizer file of model BPE with a word-end suffix, byte-level
alphabet, normaliser NFC / white space / lower case and no decoder (tokens are
joined by a space).
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.llm.chunks import GROUP_BYTES, ChunkCache, by_text
from reviewlens.llm.words import as_bytes, groups, lean, slices

_WORD_END = "</w>"
_PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
#: answers kept in each worker process; emptied when full
_PAIRS_KEPT, _PIECES_KEPT = 200_000, 60_000


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary, to that byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Bpe:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            config = json.load(f)
        model = config["model"]
        if model["type"] != "BPE" or model["end_of_word_suffix"] != _WORD_END or config["decoder"] is not None:
            raise ValueError("not a BPE file with word ends and without a decoder")
        vocab: dict[str, int] = model["vocab"]
        alphabet = byte_alphabet()

        def symbols(token: str) -> str:
            """A character for each byte; that of a word's last byte is 256 higher."""
            ends = token.endswith(_WORD_END)
            s = "".join(chr(alphabet[c]) for c in (token[: -len(_WORD_END)] if ends else token))
            return s[:-1] + chr(ord(s[-1]) + 256) if ends else s

        self.special = {t["content"]: t["id"] for t in config["added_tokens"]}
        self.size = max([*vocab.values(), *self.special.values()]) + 1
        self.length = [0] * self.size
        self.rank = [-1] * self.size  # of the merge that makes a token; -1: a single symbol
        self.parts = [(0, 0)] * self.size
        self.merge: dict[int, int] = {}  # pair -> token
        of = {symbols(t): i for t, i in vocab.items()}
        for r, (a, b) in enumerate(model["merges"]):
            x, y, z = vocab[a], vocab[b], vocab[a + b]
            if self.rank[z] < 0:
                self.rank[z], self.parts[z] = r, (x, y)
            self.merge[x * self.size + y] = z
        self.find = ahocorasick.Automaton()
        for s, i in of.items():
            self.length[i] = len(s)
            self.find.add_word(s, i)
        self.find.make_automaton()
        self.shorter = [-1] * self.size  # the longest token that a token begins with
        for s, i in of.items():
            self.shorter[i] = next((of[s[:k]] for k in range(len(s) - 1, 0, -1) if s[:k] in of), -1)
        self.compatible: dict[int, bool] = {}
        self.pieces: dict[str, list[int]] = {}
        strings = [""] * self.size
        for t, i in [*vocab.items(), *self.special.items()]:
            strings[i] = t
        encoded = [s.encode() + b" " for s in strings]
        self.blob = np.frombuffer(b"".join(encoded), np.uint8)
        self.offset = np.append(0, np.cumsum([len(x) for x in encoded]))
        decimal = [b"%d " % i for i in range(self.size)]
        self.decimal, self.decimal_offset = np.frombuffer(b"".join(decimal), np.uint8), np.append(0, np.cumsum([len(x) for x in decimal]))
        self._special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None

    def fits(self, left: int, right: int) -> bool:
        """Whether the merges leave these two tokens apart when one follows the other."""
        if len(self.compatible) > _PAIRS_KEPT:
            self.compatible.clear()
        known = self.compatible[left * self.size + right] = self._fits(left, right)
        return known

    def _fits(self, left: int, right: int) -> bool:
        rank, limit = self.rank, len(self.merge) + 1  # merges below the limit have had their turn before what was undone
        while True:
            joined = self.merge.get(left * self.size + right)
            if joined is not None and rank[joined] < limit:
                return False
            # undo the later of the two merges; of equal ones the right token's first (the left one was made first)
            if rank[left] > rank[right]:
                limit, left = rank[left], self.parts[left][1]
            elif rank[right] >= 0:
                limit, right = rank[right] + 1, self.parts[right][0]
            else:
                return True

    def encode_symbols(self, s: str) -> list[int]:
        n, length = len(s), self.length
        longest = [-1] * n
        for end, token in self.find.iter(s):
            longest[end - length[token] + 1] = token  # a later end is a longer token
        if length[longest[0]] == n:
            return [longest[0]]
        open_ = bytearray(b"\1") * (n + 1)
        out: list[int] = []
        known, size, shorter = self.compatible, self.size, self.shorter
        at, token, before = 0, longest[0], -1
        while at < n:
            while token >= 0:
                if open_[at + length[token]]:
                    fits = before < 0 or known.get(before * size + token)
                    if fits is None:
                        fits = self.fits(before, token)
                    if fits:
                        break
                token = shorter[token]
            if token >= 0:
                out.append(token)
                at += length[token]
                before, token = token, longest[at] if at < n else -1
            else:
                open_[at] = 0
                token = out.pop()
                at -= length[token]
                before = out[-1] if out else -1
        return out

    def encode_chunk(self, chunk: bytes) -> list[int]:
        """Ids of a text (or of a run of it between white space)."""
        text, out = chunk.decode("utf-8", "replace"), []
        for part in self._special.split(text) if self._special and "<|" in text else (text,):
            if part in self.special:
                out.append(self.special[part])
                continue
            if not part.isascii():
                part = unicodedata.normalize("NFC", part).replace("Σ", "σ")  # sigma is lower-cased without its context
            for piece in _PIECES.findall(part.lower()):
                ids = self.pieces.get(piece)
                if ids is None:
                    s = piece.encode().decode("latin-1")
                    ids = self.encode_symbols(s[:-1] + chr(ord(s[-1]) + 256))
                    if len(piece) <= 64:
                        if len(self.pieces) >= _PIECES_KEPT:
                            self.pieces.clear()
                        self.pieces[piece] = ids
                out += ids
        return out

    @staticmethod
    def _strings(blob: np.ndarray, offset: np.ndarray, ids: np.ndarray) -> bytes:
        first = offset[ids]
        n = offset[ids + 1] - first
        to = np.cumsum(n)
        return blob[np.arange(int(to[-1]) if len(to) else 0) + np.repeat(first - to + n, n)].tobytes()

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        """Each token's string and a space after it."""
        return self._strings(self.blob, self.offset, ids)

    def decimal_bytes(self, ids: np.ndarray) -> bytes:
        """Each id in decimal and a space after it."""
        return self._strings(self.decimal, self.decimal_offset, ids)

    def decode(self, ids: list[int]) -> str:
        return self.decode_bytes(np.asarray(ids, np.int64))[:-1].decode()


@lru_cache(maxsize=2)
def load(path: str) -> tuple[Bpe, ChunkCache]:
    """One encoder and cache for each worker process."""
    bpe = Bpe(path)

    def pieces(chunks: list[bytes]) -> list[bytes]:
        """Each chunk's ids (int32)."""
        all_ids: list[int] = []
        at = [0]
        for c in chunks:
            all_ids += bpe.encode_chunk(c)
            at.append(len(all_ids))
        binary = np.asarray(all_ids, np.int32).tobytes()
        return [binary[4 * a:4 * b] for a, b in zip(at, at[1:])]

    return bpe, ChunkCache(pieces)


_TYPES = {"n_tokens": ("long", pa.int64()), "ids": ("array<int>", pa.list_(pa.int32())), "decoded": ("string", pa.string()),
          "ids_sha256": ("string", pa.string()), "decoded_sha256": ("string", pa.string())}


def encode_documents(docs: DataFrame, path: str, outputs: tuple[str, ...] = ("n_tokens", "ids", "decoded"), keep: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """The columns ``keep`` of docs, and of each row's text the outputs asked for.

    n_tokens; ids; decoded (text of the ids); ids_sha256 (of the decimal ids
    joined by a space) and decoded_sha256 (lowercase hex), made beside the text
    so that long lists need not leave the task.  Null texts count as empty, of
    which the ids are empty; each of repeated rows gets its row.
    """
    rows = docs.select(F.col(text_col).cast("string").alias("_text"), *keep)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[1:]] + [f"{o} {_TYPES[o][0]}" for o in outputs])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, cache = load(path)
        for batch in slices(batches):
            for g in groups(as_bytes(batch.column(0)), GROUP_BYTES):
                made: dict[str, list] = {o: [] for o in outputs}
                for pieces in by_text(g, cache):
                    ids = np.frombuffer(b"".join(pieces), np.int32)
                    decoded = bpe.decode_bytes(ids)[:-1] if "decoded" in made or "decoded_sha256" in made else b""
                    for o, to in made.items():
                        if o == "n_tokens":
                            to.append(len(ids))
                        elif o == "ids":
                            to.append(ids)
                        elif o == "decoded":
                            to.append(decoded.decode())
                        elif o == "ids_sha256":
                            to.append(hashlib.sha256(bpe.decimal_bytes(ids)[:-1]).hexdigest())
                        else:
                            to.append(hashlib.sha256(decoded).hexdigest())
                kept = [batch.column(k).slice(g.first, len(g.texts)) for k in range(1, batch.num_columns)]
                yield pa.RecordBatch.from_arrays([*kept, *(pa.array(v, _TYPES[o][1]) for o, v in made.items())], [*keep, *outputs])
        cache.rest()
        bpe.pieces.clear()

    return rows.mapInArrow(lean(run), schema)


def decode_ids(rows: DataFrame, path: str, ids_col: str = "ids", out: str = "decoded", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and the text of each row's ids (null ids: empty)."""
    chosen = rows.select(F.col(ids_col).cast("array<int>").alias("_ids"), *keep)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields[1:]] + [f"{out} string"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, _ = load(path)
        for batch in batches:
            texts = [bpe.decode(x or []) for x in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(texts, pa.string())], [*keep, out])

    return chosen.mapInArrow(lean(run), schema)
