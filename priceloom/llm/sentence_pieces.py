"""Encoding with a sentencepiece BPE model, and decoding.

Greedy BPE takes the best-scored adjacent pair, the leftmost of equals, until no pair is a piece. A run of
symbols then follows the same course whether it stands alone or beside others, as long as no merge crosses
its ends; so a sequence of tokens is the encoding of its text exactly if each adjacent two are the encoding
of their own text. Hence every prefix of a text has one last token: the match of a piece ending there that
goes with the last token of what lies before it. One pass of an Aho-Corasick automaton fills this table of
last tokens, and the ids are read off it backwards, in time linear in the text.

Space is written as U+2581, which no piece holds after another character: no token crosses from a word to
the space behind it. Texts are cut there, and what was found for a chunk is remembered. A new chunk is cut
once more wherever no piece has the two characters side by side, so that a known word before a full stop is
not worked out again.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

SPACE = "▁"
_NORMAL, _UNKNOWN, _CONTROL, _BYTE = 1, 2, 3, 6


class PrefixTable:
    """Ids of texts by the table of last tokens. Raises ValueError for a model of another kind.

    It must be a BPE model with an identity normalizer and none but normal, unknown, control and byte pieces.
    """

    MOST = 700_000  # remembered chunks of at most LONG characters, about 150 MB
    LONG = 48
    MOST_PAIRS = 1_000_000

    def __init__(self, path: str) -> None:
        import ahocorasick
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        with open(path, "rb") as file:
            content = file.read()
        model = sentencepiece_model_pb2.ModelProto()
        model.ParseFromString(content)
        shape = model.normalizer_spec
        kinds = {p.type for p in model.pieces}
        if model.trainer_spec.model_type != 2 or not kinds <= {_NORMAL, _UNKNOWN, _CONTROL, _BYTE}:
            raise ValueError(f"{path}: not a BPE model of normal and byte pieces")
        if shape.precompiled_charsmap or shape.remove_extra_whitespaces or not shape.escape_whitespaces:
            raise ValueError(f"{path}: its normalizer changes more than spaces")
        if model.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError(f"{path}: marks the ends of words")
        self._first = SPACE if shape.add_dummy_prefix else ""
        self._library = SentencePieceProcessor(model_proto=content)
        self._piece = {p.piece: n for n, p in enumerate(model.pieces) if p.type == _NORMAL}
        self._all, self._ids_of = set(self._piece), self._piece.__getitem__
        self._score = {p.piece: p.score for p in model.pieces if p.type == _NORMAL}
        self._bytes = {int(p.piece[3:-1], 16): n for n, p in enumerate(model.pieces) if p.type == _BYTE}
        self._unknown = next(n for n, p in enumerate(model.pieces) if p.type == _UNKNOWN)
        self._longest = max(map(len, self._piece), default=1)
        self._automaton = ahocorasick.Automaton()
        for piece in self._piece:
            self._automaton.add_word(piece, (piece, len(piece)))
        self._automaton.make_automaton()
        apart = not any(SPACE in piece.lstrip(SPACE) for piece in self._piece)
        self._chunks = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+" if apart else r"(?s:.+)").findall
        self._beside = {piece[i : i + 2] for piece in self._piece for i in range(len(piece) - 1)}
        self._known: dict[str, bytes] = {}
        self._pairs: dict[tuple[str, str], bool] = {}

    def greedy(self, text: str) -> list[str]:
        """Greedy BPE by its definition; for the few characters of two pieces."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self._score.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def compatible(self, left: str, right: str) -> bool:
        """Whether ``left`` and ``right`` stay as they are side by side; an empty ``left`` is the text's start."""
        pair = (left, right)
        known = self._pairs.get(pair)
        if known is None:
            if len(self._pairs) >= self.MOST_PAIRS:
                self._pairs.clear()
            known = self._pairs[pair] = self.greedy(left + right) == ([left, right] if left else [right])
        return known

    def pieces(self, text: str) -> list[str]:
        """The tokens of a text written with U+2581: last tokens forwards, then the way back."""
        last = [""] * (len(text) + 1)
        pairs, compatible = self._pairs.get, self.compatible
        done = -1
        for end, (piece, size) in self._automaton.iter(text):
            if end == done:
                continue
            start = end + 1 - size
            left = last[start]
            if not left and start:  # the character before is no piece
                left = last[start] = text[start - 1]
            known = pairs((left, piece))
            if compatible(left, piece) if known is None else known:
                last[end + 1] = piece
                done = end
        found, at = [], len(text)
        while at:
            piece = last[at] or text[at - 1]
            found.append(piece)
            at -= len(piece)
        return found[::-1]

    def _ids(self, chunk: str) -> bytes:
        pieces = self.pieces(chunk)
        ids = array("i", map(self._ids_of, pieces)) if self._all.issuperset(pieces) else array("i")
        if not ids:
            for piece in pieces:
                if piece in self._all:
                    ids.append(self._piece[piece])
                elif self._bytes:
                    ids.extend(self._bytes[b] for b in piece.encode())
                else:
                    ids.append(self._unknown)
        return ids.tobytes()

    def _remembered(self, chunk: str, ids: bytes) -> bytes:
        if len(chunk) <= self.LONG:
            if len(self._known) >= self.MOST:
                self._known.clear()
            self._known[chunk] = ids
        return ids

    def _learn(self, chunk: str) -> bytes:
        """Ids of a new chunk, from those of its parts."""
        beside, known = self._beside, self._known
        cuts = [i for i in range(1, len(chunk)) if chunk[i - 1 : i + 1] not in beside]
        if not cuts:
            return self._remembered(chunk, self._ids(chunk))
        parts = [chunk[a:b] for a, b in zip([0, *cuts], [*cuts, len(chunk)], strict=True)]
        found = [known.get(part) or self._remembered(part, self._ids(part)) for part in parts]
        return self._remembered(chunk, b"".join(found))

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, np.int32)
        chunks = self._chunks(self._first + text.replace(" ", SPACE))
        found = list(map(self._known.get, chunks))
        if None in found:
            found = [self._learn(chunk) if ids is None else ids for chunk, ids in zip(chunks, found, strict=True)]
        return np.frombuffer(b"".join(found), np.int32)

    def decode(self, ids: list[int]) -> str:
        return self._library.decode(ids)


@lru_cache(maxsize=2)  # workers are reused: what a table has seen serves later tasks
def prefix_table(model: str) -> PrefixTable:
    import os

    if os.path.isabs(model):
        return PrefixTable(model)
    import public_tokenizers

    return PrefixTable(public_tokenizers.path(model))


def encode(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text", decoded: bool = False) -> DataFrame:
    """(key, ids) of every row, and with ``decoded`` the text that the ids give again.

    ``ids`` has no begin or end id. ``model`` is the file's path or, for public ones, its name: each executor
    looks for its own copy. A null or empty text has no ids and decodes to the empty text. Repeated rows and
    null keys are rows like others; other columns are not looked at. Texts are taken whole, a few at a time;
    memory is that of the longest.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = prefix_table(model)
        for batch in batches:
            start = 0
            while start < batch.num_rows:  # some texts at a time, long ones alone
                ids, texts, held = [], [], 0
                while start + len(ids) < batch.num_rows and held < 1 << 20:
                    value = batch.column(1)[start + len(ids)].as_py() or ""
                    ids.append(table.encode(value))
                    held += len(value)
                    if decoded:
                        texts.append(table.decode(ids[-1].tolist()))
                ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
                columns = [batch.column(0).slice(start, len(ids)), pa.ListArray.from_arrays(ends, np.concatenate(ids))]
                if decoded:
                    columns.append(pa.array(texts, pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names)
                start += len(ids)

    names = ["key", "ids", "decoded"] if decoded else ["key", "ids"]
    kind = docs.schema[key].dataType.simpleString()
    shape = f"key {kind}, ids array<int>" + (", decoded string" if decoded else "")
    rows = docs.select(F.col(key), F.col(text).cast("string"))
    return rows.mapInArrow(run, shape).withColumnRenamed("key", key)


def decode(rows: DataFrame, model: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(key, text) of rows of ids, by the library; null ids give a null text, and ids out of range raise."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = prefix_table(model)
        for batch in batches:
            held = (v.as_py() for v in batch.column(1))
            texts = [None if v is None else table.decode(v) for v in held]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["key", "text"])

    kind = rows.schema[key].dataType.simpleString()
    found = rows.select(F.col(key), F.col(ids).cast("array<int>")).mapInArrow(run, f"key {kind}, text string")
    return found.withColumnRenamed("key", key)
