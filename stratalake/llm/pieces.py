"""SentencePiece encoding and decoding (operator 6).

An Aho-Corasick automaton over all pieces reads a text once. At each end position
its output links name every piece that ends there, and each relaxes the best score
of that position from the best score of the piece's start; so one pass finds the
segmentation of the highest total score. A character that is no piece becomes its
UTF-8 bytes, so decoding gives back the text exactly.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm.common import list_texts

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
CACHED_SEGMENTS = 160_000  # in each of two generations
CACHED_LENGTH = 48


@dataclass(frozen=True)
class Vocabulary:
    """Pieces by id. ``kinds``: n normal, b byte, c control, u unknown, x unused."""

    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    kinds: str


def load_vocabulary(path: str = MODEL) -> Vocabulary:
    """Read a model file in the driver.

    A unigram model's scores are log probabilities. Those of a BPE model are merge
    ranks (whole numbers from 0 down), which do not add up to anything; they become
    log probabilities by Zipf's law, -ln(rank + 2). Pieces that the model itself
    rules out by a score (-1e9: runs of spaces) are decoded but not produced.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    pieces = tuple(model.id_to_piece(i) for i in range(n))
    scores = [model.get_score(i) for i in range(n)]
    kinds = "".join(
        "b" if model.is_byte(i)
        else "c" if model.is_control(i)
        else "u" if model.is_unknown(i)
        else "x" if model.is_unused(i) or (scores[i] <= -1e9 and len(pieces[i]) > 1)
        else "n"
        for i in range(n)
    )
    normal = [s for s, k in zip(scores, kinds, strict=True) if k == "n"]
    if all(s == int(s) for s in normal):
        scores = [-math.log(min(max(-s, 0.0), n) + 2) for s in scores]
    return Vocabulary(pieces, tuple(scores), kinds)


class Codec:
    """Encoder and decoder of one vocabulary; built once per Python worker."""

    def __init__(self, vocabulary: Vocabulary):
        self.automaton = ahocorasick.Automaton()
        self.bytes_of: list[bytes] = []
        self.byte_ids: dict[int, int] = {}
        self.length = [len(p) for p in vocabulary.pieces]
        normal = []
        for i, (piece, kind) in enumerate(zip(vocabulary.pieces, vocabulary.kinds, strict=True)):
            if kind == "n":
                normal.append(piece)
                self.automaton.add_word(piece, (len(piece), vocabulary.scores[i], i))
            if kind == "b":
                value = int(piece[3:5], 16)
                self.byte_ids[value] = i
                self.bytes_of.append(bytes([value]))
            elif kind == "c":
                self.bytes_of.append(b"")
            elif kind == "u":
                self.bytes_of.append(" ⁇ ".encode())
            else:
                self.bytes_of.append(piece.replace(SPACE, " ").encode())
        self.automaton.make_automaton()
        self.single = {p for p in normal if len(p) == 1}
        # where no piece crosses a space or a line break, the best segmentation does not either
        joined = any(SPACE in p[1:] or ("\n" in p and len(p) > 1) for p in normal)
        self.segment = re.compile(
            r"(?s).+" if joined else f"{SPACE}[^{SPACE}\\n]*|\\n|[^{SPACE}\\n]+"
        )
        scores = [s for s, k in zip(vocabulary.scores, vocabulary.kinds, strict=True) if k == "n"]
        self.fallback = min(scores, default=0.0) - 10.0
        self.cache = _Segments(self)

    def viterbi(self, segment: str) -> list[int]:
        """Ids of the segmentation with the highest total score."""
        n = len(segment)
        best = [-math.inf] * (n + 1)
        best[0] = 0.0
        back = [-1] * (n + 1)
        if self.single.issuperset(segment):
            # every position is reached by the piece of its own character at least
            for last, (length, score, piece) in self.automaton.iter(segment):
                total = best[last + 1 - length] + score
                if total > best[last + 1]:
                    best[last + 1] = total
                    back[last + 1] = piece
        else:
            self._with_bytes(segment, best, back)
        out: list[int] = []
        end = n
        while end:
            piece = back[end]
            if piece >= 0:
                out.append(piece)
                end -= self.length[piece]
            else:
                end -= 1
                out.extend(self.byte_ids[b] for b in reversed(segment[end].encode()))
        out.reverse()
        return out

    def _with_bytes(self, segment: str, best: list[float], back: list[int]) -> None:
        """The same pass, where each character may also go as its bytes."""
        done = 0
        for last, (length, score, piece) in [*self.automaton.iter(segment), (len(segment), (0, 0.0, -1))]:
            while done < last:
                # all pieces that end here have been seen
                done += 1
                if best[done - 1] + self.fallback > best[done]:
                    best[done] = best[done - 1] + self.fallback
                    back[done] = -1
            if piece >= 0 and best[last + 1 - length] + score > best[last + 1]:
                best[last + 1] = best[last + 1 - length] + score
                back[last + 1] = piece

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text; none for an empty one."""
        if not text:
            return np.empty(0, np.int32)
        # the mark for a space, where a text holds it itself, goes as bytes
        literal = np.array([self.byte_ids.get(b, 0) for b in SPACE.encode()], np.int32).tobytes()
        out = []
        for i, part in enumerate(text.split(SPACE)):
            if i:
                out.append(literal)
            known = self.segment.findall((SPACE if not i else "") + part.replace(" ", SPACE))
            out.extend(map(self.cache.__getitem__, known))
        return np.frombuffer(b"".join(out), np.int32)

    def decode(self, ids: Sequence[int]) -> str:
        ids = ids.tolist() if isinstance(ids, np.ndarray) else ids
        text = b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text[:1] == " " else text


class _Segments(dict):
    """Ids of segments met before, as bytes; bounded in number and in length.

    When full it becomes the older generation, from which what is met again comes
    back, so frequent segments stay.
    """

    def __init__(self, codec: Codec):
        super().__init__()
        self.codec = codec
        self.older: dict[str, bytes] = {}

    def __missing__(self, segment: str) -> bytes:
        ids = self.older.get(segment)
        if ids is None:
            ids = np.array(self.codec.viterbi(segment), np.int32).tobytes()
        if len(segment) <= CACHED_LENGTH:
            if len(self) >= CACHED_SEGMENTS:
                self.older = dict(self)
                self.clear()
            self[segment] = ids
        return ids


_CODECS: dict[int, Codec] = {}


def codec_of(shared: Broadcast) -> Codec:
    vocabulary = shared.value
    mark = hash(vocabulary)
    if mark not in _CODECS:
        _CODECS.clear()
        _CODECS[mark] = Codec(vocabulary)
    return _CODECS[mark]


def share(spark: SparkSession, path: str = MODEL) -> Broadcast:
    """The vocabulary, whose size does not follow the data, for all executors."""
    return spark.sparkContext.broadcast(load_vocabulary(path))


def _lists(rows: list[np.ndarray]) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum([len(ids) for ids in rows])]).astype(np.int32)
    flat = np.concatenate(rows) if rows else np.empty(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int32()))


def encode_documents(
    docs: DataFrame, vocabulary: Broadcast, keep: Sequence[str] = ("doc_id",), text_col: str = "text"
) -> DataFrame:
    """Columns ``keep`` with ``ids`` (array), ``n_tokens`` and ``round_trip``.

    ``round_trip`` says that decoding the ids gives back the text. One pass over
    whole texts, nothing is shuffled. Null and empty texts have no tokens.
    Repeated rows and null ids come out as they went in. A cache of short segments
    is bounded.
    """
    types = dict(docs.dtypes)
    schema = ", ".join(f"`{c}` {types[c]}" for c in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(vocabulary)
        for batch in batches:
            for start, texts in list_texts(batch.column("_text")):
                coded = [codec.encode(t) for t in texts]
                same = [codec.decode(c) == t for c, t in zip(coded, texts, strict=True)]
                kept = [batch.column(c).slice(start, len(texts)) for c in keep]
                yield pa.RecordBatch.from_arrays(
                    [*kept, _lists(coded), pa.array([len(c) for c in coded], pa.int64()), pa.array(same)],
                    [*keep, "ids", "n_tokens", "round_trip"],
                )

    return docs.select(*keep, F.col(text_col).alias("_text")).mapInArrow(
        run, f"{schema}, ids array<int>, n_tokens long, round_trip boolean"
    )


def decode_documents(
    coded: DataFrame, vocabulary: Broadcast, keep: Sequence[str] = ("doc_id",), ids_col: str = "ids"
) -> DataFrame:
    """Columns ``keep`` with ``text``. Null ids are an empty text; a null or unknown
    id within them reads as the unknown mark."""
    types = dict(coded.dtypes)
    schema = ", ".join(f"`{c}` {types[c]}" for c in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(vocabulary)
        top = len(codec.bytes_of)
        for batch in batches:
            texts = [
                codec.decode([i if i is not None and 0 <= i < top else 0 for i in ids.as_py() or []])
                for ids in batch.column("_ids")
            ]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in keep], pa.array(texts, pa.string())], [*keep, "text"]
            )

    return coded.select(*keep, F.col(ids_col).alias("_ids")).mapInArrow(
        run, f"{schema}, text string"
    )
