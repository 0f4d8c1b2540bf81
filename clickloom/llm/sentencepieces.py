"""Encode and decode texts with a merge-type SentencePiece vocabulary.

Encoding keeps an agenda of the adjacent symbol pairs whose concatenation is a piece, ordered
by the piece's score and then from left to right; the best pair is merged and its new
neighbours enter the agenda, until it is empty. Symbols outside the vocabulary become their
UTF-8 bytes.

A merge never joins two characters that stand side by side in no piece. Texts are cut at such
places, which the vocabulary itself names, so that each different span is merged once per task
and then remembered. In every Arrow slice some whole texts are encoded and decoded by the
sentencepiece library too, and any difference ends the job.

Null texts count as empty: no ids, and an empty decoded text. Each input row gives one row,
repeated or not; a null ``doc_id`` stays null and extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from clickloom.llm.text import SpanIds, map_texts

MARK = "▁"
_NORMAL, _BYTE = 1, 6


class PieceModel:
    """A vocabulary of scored pieces with byte fallback, and the agenda that merges symbols."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        normal, trainer = model.normalizer_spec, model.trainer_spec
        kinds = {p.type for p in model.pieces}
        if (
            trainer.model_type != trainer.BPE
            or not trainer.byte_fallback
            or normal.precompiled_charsmap
            or not normal.add_dummy_prefix
            or normal.remove_extra_whitespaces
            or not normal.escape_whitespaces
            or trainer.treat_whitespace_as_suffix
            or kinds - {1, 2, 3, 6}
        ):
            raise ValueError("needs a merge-type model with byte fallback, a space prefix and no normalisation")
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.ids = {p.piece: k for k, p in enumerate(model.pieces) if p.type == _NORMAL}
        self.rank = {p.piece: -p.score for p in model.pieces if p.type == _NORMAL}
        self.byte_ids = [0] * 256
        content = []
        for k, p in enumerate(model.pieces):
            if p.type == _BYTE:
                value = int(p.piece[1:-1], 16)
                self.byte_ids[value] = k
                content.append(bytes([value]))
            else:
                content.append(p.piece.replace(MARK, " ").encode() if p.type == _NORMAL else b"")
        self.content = np.frombuffer(b"".join(content), np.uint8)
        self.content_length = np.array([len(c) for c in content])
        self.content_start = np.cumsum(self.content_length) - self.content_length
        digits = [b"%d," % k for k in range(len(content))]
        width = max(map(len, digits))
        self.digits = np.array(digits, f"S{width}").view(np.uint8).reshape(len(digits), width)
        self.digit_count = np.array([len(d) for d in digits])
        self.joined = self._joined()
        self.cache = SpanIds(lambda spans: [np.array(self.merge(s.decode()), np.int32) for s in spans])

    def _joined(self) -> np.ndarray:
        """Whether two bytes that stand side by side in a text may lie in one piece."""
        joined = np.zeros((256, 256), bool)
        joined[128:, :] = joined[:, 128:] = True
        spaced = False  # does a piece have a space after a character outside ASCII?
        for piece in self.ids:
            plain = piece.replace(MARK, " ")
            for a, b in zip(plain, plain[1:], strict=False):
                if ord(a) < 128 and ord(b) < 128:
                    joined[ord(a), ord(b)] = True
                spaced |= ord(a) >= 128 and b == " "
        if not spaced:
            joined[128:, 32] = False
        return joined

    def merge(self, text: str) -> list[int]:
        """Ids of a span (its spaces are marks), by the agenda."""
        symbols: list[str] = list(text.replace(" ", MARK))
        rank, n = self.rank.get, len(symbols)
        agenda = []
        for k in range(n - 1):
            pair = symbols[k] + symbols[k + 1]
            if (r := rank(pair)) is not None:
                agenda.append((r, k, len(pair), k + 1))
        if agenda:
            heapq.heapify(agenda)
            before, after = list(range(-1, n - 1)), list(range(1, n + 1))
            pop, push = heapq.heappop, heapq.heappush
            while agenda:
                _, left, size, right = pop(agenda)
                a, b = symbols[left], symbols[right]
                if not a or not b or len(a) + len(b) != size:
                    continue
                symbols[left], symbols[right] = (a := a + b), ""
                after[left] = last = after[right]
                if last < n:
                    before[last] = left
                    pair = a + symbols[last]
                    if (r := rank(pair)) is not None:
                        push(agenda, (r, left, len(pair), last))
                if (first := before[left]) >= 0:
                    pair = symbols[first] + a
                    if (r := rank(pair)) is not None:
                        push(agenda, (r, first, len(pair), left))
        out: list[int] = []
        for s in symbols:
            if s:
                known = self.ids.get(s)
                if known is None:
                    out += [self.byte_ids[b] for b in s.encode()]
                else:
                    out.append(known)
        return out

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in order, and the offsets of the texts in them."""
        raw = data.tobytes()
        mark = MARK.encode()
        if mark in raw:  # a mark in a text is a space to the model
            texts = [raw[a:b].replace(mark, b" ") for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            data = np.frombuffer(b"".join(texts), np.uint8)
            offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
        filled = np.diff(offsets) > 0
        data = np.insert(data, offsets[:-1][filled], 32)
        offsets = offsets + np.concatenate(([0], np.cumsum(filled)))
        n = len(data)
        cut = np.zeros(n + 1, bool)
        cut[offsets] = True
        if n:
            cut[n] = True
            cut[1:n] |= ~self.joined[data[:-1], data[1:]]
        at = np.flatnonzero(cut)
        starts, ends = (at[:-1], at[1:]) if n else (at[:0], at[:0])
        ids, counts = self.cache.tokens(data, starts, ends)
        return ids, np.concatenate(([0], np.cumsum(counts)))[np.searchsorted(starts, offsets)]

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
        """The texts (UTF-8) of several sequences of ids, without the space that encoding puts first."""
        length = self.content_length[ids]
        total = int(length.sum())
        ends = np.concatenate(([0], np.cumsum(length)))
        index = np.arange(total) + np.repeat(self.content_start[ids] - ends[:-1], length)
        raw = self.content[index].tobytes()
        at = ends[bounds].tolist()
        return [raw[a + 1 : b] if raw[a : a + 1] == b" " else raw[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]

    def listed(self, ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
        """Decimal ids joined by commas."""
        flat = self.digits[ids].ravel()
        raw = flat[flat != 0].tobytes()
        at = np.concatenate(([0], np.cumsum(self.digit_count[ids])))[bounds].tolist()
        return [raw[a : max(a, b - 1)] for a, b in zip(at[:-1], at[1:], strict=True)]


_models: dict[str, PieceModel] = {}


def piece_model(path: str) -> PieceModel:
    """One model, and one cache, for a task; for the worker, where it has this package itself."""
    if path not in _models:
        _models[path] = PieceModel(path)
    return _models[path]


def encode_documents(docs: DataFrame, model: str, check_every: int = 32, with_ids: bool = False, text: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` and, on demand, ``ids`` and ``decoded``.

    In every slice, each ``check_every``-th text is held against the sentencepiece library whole.
    """
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (
        ", ids array<int>, decoded string" if with_ids else ""
    )

    def encode(kept: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray) -> dict:
        pieces = piece_model(model)
        ids, bounds = pieces.encode(data, offsets)
        decoded = pieces.decode(ids, bounds)
        for k in range(0, len(decoded), check_every):
            whole = data[offsets[k] : offsets[k + 1]].tobytes().decode()
            expected = pieces.library.encode(whole)
            if expected != ids[bounds[k] : bounds[k + 1]].tolist() or pieces.library.decode(expected) != decoded[k].decode():
                raise ValueError(f"doc_id {kept.column('doc_id')[k]}: the agenda and the sentencepiece library differ")
        out = {
            "doc_id": kept.column("doc_id"),
            "n_tokens": np.diff(bounds),
            "ids_sha256": [hashlib.sha256(x).hexdigest() for x in pieces.listed(ids, bounds)],
            "decoded_sha256": [hashlib.sha256(x).hexdigest() for x in decoded],
        }
        if with_ids:
            out["ids"] = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))
            out["decoded"] = [x.decode() for x in decoded]
        return out

    return map_texts(docs, ["doc_id"], schema, encode, text)
