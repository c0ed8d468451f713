"""SentencePiece encoding and decoding by weighted finite-state transduction.

:class:`PieceTransducer` is compiled from a ``.model`` file: the normaliser (dummy prefix,
spaces to the word mark), one path for every piece, and byte fallback for characters that
no piece spells. Composing it with a text gives a lattice over the positions of the text;
its shortest path in the tropical semiring is the segmentation.

* Unigram models: an arc weighs minus the score of its piece.
* BPE models: pieces are also composed with an acceptor of piece pairs. A pair weighs 0
  when merging its joined text yields exactly that pair, and infinity otherwise. A piece
  sequence is the model's segmentation exactly when all its neighbours are such pairs, so
  one path of weight 0 reaches each position and the search keeps one state for it.
  (Shortest paths over scores alone would give another segmentation than the model's.)

Texts are first cut where no piece can cross: between two characters that stand together
in no piece. Those fragments are what workers cache.

Defined cases: a null or empty text has no pieces and decodes to an empty text; characters
without a piece become their UTF-8 bytes' pieces, and the unknown piece only if the model
has no byte pieces; result columns replace input columns of the same name. Decoding gives
back every text that does not itself hold the word mark U+2581.
"""

from __future__ import annotations

import gc
import hashlib
from heapq import heappop, heappush
from math import inf

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from sentencepiece import sentencepiece_model_pb2 as pb

from shelfline.llm.common import kept_in_worker, with_scanned

MARK = "▁"
#: Cached fragments and words of a worker before its caches are emptied.
CACHE = 400_000

# Piece types and model types of the file format.
NORMAL, UNKNOWN, USER_DEFINED, BYTE = 1, 2, 4, 6
UNIGRAM, BPE = 1, 2

PIECES = T.StructField("pieces", T.ArrayType(T.IntegerType(), False))
DIGESTS = T.StructType(
    [
        T.StructField("n_pieces", T.LongType()),
        T.StructField("pieces_sha256", T.StringType()),
        T.StructField("decoded_chars", T.LongType()),
        T.StructField("decoded_sha256", T.StringType()),
    ]
)


class PieceTransducer:
    """Encoder and decoder compiled from the bytes of a model file."""

    def __init__(self, model: bytes, cache: int = CACHE):
        proto = pb.ModelProto()
        proto.ParseFromString(model)
        spec = proto.normalizer_spec
        if spec.precompiled_charsmap or not spec.escape_whitespaces:
            raise ValueError("only the identity normaliser with escaped spaces is compiled")
        self.kind = proto.trainer_spec.model_type
        if self.kind not in (UNIGRAM, BPE):
            raise ValueError("the model is neither unigram nor BPE")
        self.dummy_prefix = spec.add_dummy_prefix
        self.squeeze = spec.remove_extra_whitespaces
        spelled = [(i, p) for i, p in enumerate(proto.pieces) if p.type in (NORMAL, USER_DEFINED)]
        self.ids = {p.piece: i for i, p in spelled}
        self.score = {p.piece: p.score for _, p in spelled}
        self.text = {i: p.piece for i, p in spelled}
        self.longest = max(map(len, self.ids))
        self.size = len(proto.pieces)
        # The states of the transducer: arcs by character, and the piece that ends here or -1.
        self.start: tuple[dict, int] = ({}, -1)
        for piece, i in self.ids.items():
            arcs = self.start[0]
            for char in piece[:-1]:
                arcs = arcs.setdefault(char, ({}, -1))[0]
            arcs[piece[-1]] = (arcs.get(piece[-1], ({}, -1))[0], i)
        self.bytes = {int(p.piece[1:-1], 16): i for i, p in enumerate(proto.pieces) if p.type == BYTE}
        self.unknown = next(i for i, p in enumerate(proto.pieces) if p.type == UNKNOWN)
        self.joined = {piece[k : k + 2] for piece in self.ids for k in range(len(piece) - 1)}
        self.out = [b""] * len(proto.pieces)
        for i, p in enumerate(proto.pieces):
            self.out[i] = p.piece.encode() if i in self.text else b""
        for b, i in self.bytes.items():
            self.out[i] = bytes([b])
        self.out[self.unknown] = proto.trainer_spec.unk_surface.encode()
        gc.freeze()  # the states live as long as the worker; collections need not visit them
        self.pairs: dict[int, bool] = {}
        transducer = self

        class Fragments(dict):
            def __missing__(self, fragment: str) -> bytes:
                found = np.array(transducer.shortest(fragment), np.int32).tobytes()
                if len(self) >= cache:
                    self.clear()
                self[fragment] = found
                return found

        class Words(dict):
            def __missing__(self, word: str) -> bytes:
                found = transducer.cut(MARK + word)
                if len(self) >= cache:
                    self.clear()
                self[word] = found
                return found

        self.fragments, self.words = Fragments(), Words()
        self.cache = cache

    # -- the acceptor of piece pairs ------------------------------------------------

    def merged(self, text: str) -> list[str]:
        """Merge the best-scored neighbours, leftmost first, until none spells a piece."""
        parts: list[str | None] = list(text)
        after = list(range(1, len(parts) + 1))
        before = list(range(-1, len(parts) - 1))
        heap: list[tuple[float, int, str]] = []

        def offer(i: int) -> None:
            j = after[i] if i >= 0 else len(parts)
            if j < len(parts):
                both = parts[i] + parts[j]
                if both in self.score:
                    heappush(heap, (-self.score[both], i, both))

        for i in range(len(parts)):
            offer(i)
        while heap:
            _, i, both = heappop(heap)
            j = after[i]
            if parts[i] is None or j >= len(parts) or parts[i] + parts[j] != both:
                continue
            parts[i], parts[j] = both, None
            after[i] = after[j]
            if after[i] < len(parts):
                before[after[i]] = i
            offer(before[i])
            offer(i)
        return [p for p in parts if p is not None]

    def fits(self, left: int, right: int) -> bool:
        """Whether two pieces may stand side by side; left is -1 at a start or after bytes."""
        key = left * self.size + right
        found = self.pairs.get(key)
        if found is None:
            if len(self.pairs) >= self.cache:
                self.pairs.clear()
            second = self.text[right]
            first = [self.text[left]] if left >= 0 else []
            found = self.pairs[key] = self.merged("".join([*first, second])) == [*first, second]
        return found

    # -- composition and shortest path ----------------------------------------------

    def shortest(self, text: str) -> list[int]:
        """Piece ids of the shortest path through the lattice of one fragment.

        ``came[k]`` is the arc that ends the shortest path to position k: its start and
        its piece, or -1 where the character became bytes.
        """
        n, ids, bpe = len(text), self.ids, self.kind == BPE
        if bpe and text in ids and self.fits(-1, ids[text]):
            return [ids[text]]
        cost = [0.0] + [inf] * n
        came: list[tuple[int, int]] = [(0, -1)] * (n + 1)
        pairs, size = self.pairs, self.size
        for start in range(n):
            here, last = cost[start], came[start][1]
            if here == inf:
                continue
            arcs, end = self.start[0], start
            for char in text[start : start + self.longest]:
                state = arcs.get(char)
                if state is None:
                    break
                arcs, i = state
                end += 1
                if i < 0:
                    continue
                if bpe:
                    if cost[end] and ((fit := pairs.get(last * size + i)) or fit is None and self.fits(last, i)):
                        cost[end], came[end] = 0.0, (start, i)
                elif here - self.score[self.text[i]] < cost[end]:
                    cost[end], came[end] = here - self.score[self.text[i]], (start, i)
            if cost[start + 1] == inf and text[start] not in ids:
                # Byte fallback: the only arc of a character that no piece spells.
                cost[start + 1], came[start + 1] = here, (start, -1)
        out: list[int] = []
        end = n
        while end:
            start, i = came[end]
            if i >= 0:
                out.append(i)
            elif self.bytes:
                out.extend(self.bytes[b] for b in reversed(text[start].encode()))
            else:
                out.append(self.unknown)
            end = start
        return out[::-1]

    def cut(self, text: str) -> bytes:
        """Ids of a text, fragment by fragment, as little-endian 32-bit integers."""
        found, start, joined = [], 0, self.joined
        for k in range(1, len(text)):
            if text[k - 1 : k + 1] not in joined:
                found.append(self.fragments[text[start:k]])
                start = k
        found.append(self.fragments[text[start:]])
        return b"".join(found)

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self.squeeze:
            text = " ".join(x for x in text.split(" ") if x)
        if not text:
            return b""
        text = text.replace(MARK, " ")
        words = text.split(" ")
        # An empty word stands between spaces, which pieces of several marks may join.
        if "" in words:
            return self.marked((MARK if self.dummy_prefix else "") + text.replace(" ", MARK))
        if self.dummy_prefix:
            return b"".join(map(self.words.__getitem__, words))
        return self.cut(words[0]) + b"".join(map(self.words.__getitem__, words[1:]))

    def marked(self, text: str) -> bytes:
        """Cut before every run of marks; no piece has a mark after another character."""
        found, start = [], 0
        at = text.find(MARK, 1)
        while at > 0:
            if text[at - 1] != MARK:
                found.append(self.cut(text[start:at]))
                start = at
            at = text.find(MARK, at + 1)
        return b"".join([*found, self.cut(text[start:])])

    def decode(self, ids: np.ndarray) -> str:
        raw = b"".join(map(self.out.__getitem__, ids.tolist())).decode(errors="replace").replace(MARK, " ")
        return raw[1:] if self.dummy_prefix and raw.startswith(" ") else raw


def _sent(docs: DataFrame, path: str):
    with open(path, "rb") as file:
        return docs.sparkSession.sparkContext.broadcast(file.read())


def _transducer(model: bytes, cache: int = CACHE) -> PieceTransducer:
    return kept_in_worker("pieces", (hashlib.sha256(model).digest(), cache), lambda: PieceTransducer(model, cache))


def _lists(encoded: list[bytes]) -> pa.Array:
    lengths = np.fromiter(map(len, encoded), np.int64, len(encoded)) // 4
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    values = pa.array(np.frombuffer(b"".join(encoded), np.int32))
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def encode(docs: DataFrame, path: str, text: str = "text", cache: int = CACHE) -> DataFrame:
    """``docs`` with ``pieces``, the piece ids of the whole text, by the model at ``path``.

    ``cache`` is how many fragments and words a worker remembers; results do not depend on it.
    """
    sent = _sent(docs, path)

    def start():
        transducer = _transducer(sent.value, cache)
        return lambda texts: [_lists([transducer.encode(t) for t in texts.to_pylist()])]

    return with_scanned(docs, text, T.StructType([PIECES]), start)


def decode(docs: DataFrame, path: str, pieces: str = "pieces") -> DataFrame:
    """``docs`` with ``decoded``, the text of the piece ids; null ids give an empty text."""
    sent = _sent(docs, path)

    def start():
        transducer = _transducer(sent.value)

        def step(column: pa.Array) -> list[pa.Array]:
            rows = (np.array(x or [], np.int32) for x in column.to_pylist())
            return [pa.array([transducer.decode(x) for x in rows], pa.string())]

        return step

    return with_scanned(docs, pieces, T.StructType([T.StructField("decoded", T.StringType())]), start)


def digests(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Encode and decode in one pass: counts and digests of the piece ids and of the decoded text.

    ``pieces_sha256`` is over the ids as little-endian 32-bit integers.
    """
    sent = _sent(docs, path)

    def start():
        transducer = _transducer(sent.value)

        def step(texts: pa.Array) -> list[pa.Array]:
            counts, digest, chars, back = [], [], [], []
            for value in texts.to_pylist():
                ids = transducer.encode(value)
                decoded = transducer.decode(np.frombuffer(ids, np.int32))
                counts.append(len(ids) // 4)
                digest.append(hashlib.sha256(ids).hexdigest())
                chars.append(len(decoded))
                back.append(hashlib.sha256(decoded.encode()).hexdigest())
            return [pa.array(counts, pa.int64()), pa.array(digest), pa.array(chars, pa.int64()), pa.array(back)]

        return step

    return with_scanned(docs, text, DIGESTS, start)


def report(docs: DataFrame, path: str) -> DataFrame:
    """Per document: counts, digests, and whether decoding gave the text back."""
    text = F.coalesce(F.col("text"), F.lit(""))
    found = digests(docs.select("doc_id", "text"), path)
    same = F.sha2(F.encode(text, "UTF-8"), 256) == F.col("decoded_sha256")
    return found.select("doc_id", *DIGESTS.names, same.alias("round_trip"))
