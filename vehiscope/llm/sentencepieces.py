"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

Encoding keeps a score-ordered agenda of adjacent symbol pairs: the pair whose
union is the best-scored piece is merged first (ties: the leftmost), its new
neighbours enter the agenda, until no adjacent pair is a piece; symbols that are
no piece fall back to byte pieces. Merges cannot cross a place that lies inside
no piece, so a text is cut before each run of space marks and around line ends,
and each distinct segment is encoded once per batch and remembered by a bounded
cache. Many short segments run their agendas side by side on arrays; long ones
use a heap.

Every distinct segment is checked against the sentencepiece library in the same
Arrow batch; a difference ends the task. Decoding is the library's.

Defined results
    null or empty text: no ids, empty decoded text; very long texts and very long
    words are encoded whole; ties and repeated rows: the same ids; empty table:
    empty result; other input columns are carried unchanged.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MARK = "▁"
#: Segments longer than this use the heap, so that the rounds on arrays stay few.
SHORT = 48
#: Segments a Python worker remembers.
CACHE = 250_000
#: Agenda entry without a pair; symbol that was merged into its left neighbour.
NONE, GONE = 1 << 62, -(1 << 40)
ENCODED = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def default_model() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def packed(ids: list[int]) -> bytes:
    """Ids as they are remembered: four bytes each."""
    return array("i", ids).tobytes()


class PieceEncoder:
    """Agenda encoder for one model file."""

    def __init__(self, path: str, cache: int = CACHE):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as proto

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        model = proto.ModelProto()
        model.ParseFromString(self.library.serialized_model_proto())
        spec = model.normalizer_spec
        if (model.trainer_spec.model_type != 2 or spec.name != "identity" or not spec.add_dummy_prefix
                or spec.remove_extra_whitespaces or not spec.escape_whitespaces
                or model.trainer_spec.treat_whitespace_as_suffix or not model.trainer_spec.byte_fallback):
            raise ValueError("only merge-type models with identity normalisation and byte fallback")
        if any(p.type in (4, 5) for p in model.pieces):
            raise ValueError("models with user-defined or unused pieces are not supported")
        normal = {p.piece: i for i, p in enumerate(model.pieces) if p.type == 1}
        self.byte_ids = [self.library.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        # symbols: the normal pieces by id, then single characters that are none
        self.symbol = dict(normal)
        self.n_ids = len(model.pieces)
        for p in normal:
            for c in p:
                self.symbol.setdefault(c, self.n_ids + len(self.symbol))
        scores = sorted({model.pieces[i].score for i in normal.values()}, reverse=True)
        rank = {s: r for r, s in enumerate(scores)}
        pairs = {}
        for p, i in normal.items():
            for k in range(1, len(p)):
                a, b = self.symbol.get(p[:k]), self.symbol.get(p[k:])
                if a is not None and b is not None:
                    pairs[a, b] = (rank[model.pieces[i].score], i)
        self.pairs = pairs
        keys = np.array([(a << 32) | b for a, b in pairs], dtype=np.int64)
        order = np.argsort(keys)
        self.keys = keys[order]
        self.ranks = np.array([v[0] for v in pairs.values()], dtype=np.int64)[order]
        self.merged = np.array([v[1] for v in pairs.values()], dtype=np.int64)[order]
        self.of_char = -1 - np.arange(0x110000, dtype=np.int64)  # below zero: in no piece
        for p, i in self.symbol.items():
            if len(p) == 1:
                self.of_char[ord(p)] = i
        if any(re.search(f"[^{MARK}]{MARK}", p) for p in normal):
            self.segment = re.compile(r"(?s).+")
        elif any("\n" in p for p in normal):
            self.segment = re.compile(f"(?s){MARK}*[^{MARK}]+|{MARK}+")
        else:
            self.segment = re.compile(f"\n|{MARK}*[^{MARK}\n]+|{MARK}+")
        self.numerals = [str(i) for i in range(self.n_ids)]
        self.cache: dict[str, bytes] = {}
        self.limit = cache

    # ---------------------------------------------------------------- agendas
    def _characters(self, segment: str) -> list[int]:
        """Symbols of a segment; a character of no piece is coded below zero."""
        return [self.symbol.get(c, -1 - ord(c)) for c in segment]

    def _finish(self, symbols: list[int], chars: dict[int, str]) -> bytes:
        """Ids, four bytes each; symbols that are no piece as the byte pieces of
        their UTF-8."""
        out: list[int] = []
        for s in symbols:
            if 0 <= s < self.n_ids:
                out.append(s)
            else:
                c = chr(-1 - s) if s < 0 else chars[s]
                out += [self.byte_ids[b] for b in c.encode()]
        return packed(out)

    def by_heap(self, segment: str) -> bytes:
        """One segment; the agenda is a heap of (rank, left, right, piece)."""
        sym = self._characters(segment)
        n = len(sym)
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        alive = [True] * n
        agenda: list[tuple[int, int, int, int, int, int]] = []

        def offer(left: int, right: int) -> None:
            hit = self.pairs.get((sym[left], sym[right]))
            if hit:
                heapq.heappush(agenda, (hit[0], left, right, hit[1], sym[left], sym[right]))

        for i in range(n - 1):
            offer(i, i + 1)
        while agenda:
            _, left, right, piece, a, b = heapq.heappop(agenda)
            if not (alive[left] and alive[right]) or nxt[left] != right or sym[left] != a or sym[right] != b:
                continue
            sym[left], alive[right] = piece, False
            nxt[left] = nxt[right]
            if nxt[left] < n:
                prv[nxt[left]] = left
                offer(left, nxt[left])
            if prv[left] >= 0:
                offer(prv[left], left)
        chars = {self.symbol[c]: c for c in set(segment) if c in self.symbol}
        return self._finish([s for s, live in zip(sym, alive) if live], chars)

    def _find(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = (a << 32) | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return at, (self.keys[at] == key) & (a >= 0) & (b >= 0)

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of each pair in the high half; NONE if it is no piece."""
        at, hit = self._find(a, b)
        return np.where(hit, self.ranks[at] << 32, NONE)

    def _union(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return self.merged[self._find(a, b)[0]]

    def by_arrays(self, segments: list[str]) -> list[bytes]:
        """Short segments side by side, their symbols in one array: each round
        takes every segment's best pair (lowest rank, then leftmost) off its
        agenda and merges it; links skip the symbols that were merged away."""
        codes = np.frombuffer("".join(segments).encode("utf-32-le"), dtype=np.uint32)
        sym = self.of_char[codes]
        length = np.fromiter(map(len, segments), dtype=np.int64, count=len(segments))
        start = np.cumsum(length) - length
        n = len(sym)
        nxt, prv = np.arange(1, n + 1), np.arange(-1, n - 1)
        nxt[start + length - 1] = n  # n and -1: none
        prv[start] = -1
        where = np.arange(n)
        agenda = np.full(n + 1, NONE, dtype=np.int64)  # rank and position of the pair that starts here
        agenda[:-1] = self._rank(sym, np.append(sym[1:], -1)) | where
        agenda[start + length - 1] = NONE
        sym = np.append(sym, -1)
        while True:
            best = np.minimum.reduceat(agenda[:-1], start)
            left = (best[best < NONE] & 0xFFFFFFFF)
            if not len(left):
                break
            right = nxt[left]
            sym[left] = self._union(sym[left], sym[right])
            sym[right] = GONE
            after = nxt[right]
            nxt[left] = after
            inner = after < n
            prv[after[inner]] = left[inner]
            agenda[right] = NONE
            agenda[left] = np.where(inner, self._rank(sym[left], sym[after]) | left, NONE)
            before = prv[left]
            b, at = before[before >= 0], left[before >= 0]
            agenda[b] = self._rank(sym[b], sym[at]) | b
        stays = sym[:-1] != GONE
        ids = sym[:-1][stays]
        raw = ids.astype(np.int32).tobytes()
        ends = np.cumsum(np.add.reduceat(stays, start, dtype=np.int64)).tolist()
        odd = np.logical_or.reduceat((sym[:-1] != GONE) & ((sym[:-1] < 0) | (sym[:-1] >= self.n_ids)), start).tolist()
        out, at = [], 0
        for s, end, bad in zip(segments, ends, odd):
            out.append(self._finish(ids[at:end].tolist(), {self.symbol[c]: c for c in set(s) if c in self.symbol})
                       if bad else raw[4 * at:4 * end])
            at = end
        return out

    # ---------------------------------------------------------------- batches
    def learn(self, segments: list[str], check: bool = True) -> None:
        """Encode segments that are not in the cache, and check them."""
        short = sorted((s for s in segments if len(s) <= SHORT), key=len)
        for k in range(0, len(short), 8192):
            part = short[k:k + 8192]
            self.cache.update(zip(part, self.by_arrays(part)))
        for s in segments:
            if len(s) > SHORT:
                self.cache[s] = self.by_heap(s)
        if check:
            self.check(segments)

    def check(self, segments: list[str]) -> None:
        """Compare the ids of segments with the library's. The library puts a
        space mark before every text that is not empty, so segments of a
        mark alone or without one follow a line end."""
        head = packed(self.library.encode("\n"))
        plain = [s[0] == MARK and s != MARK for s in segments]
        texts = [s[1:] if p else "\n" + s for s, p in zip(segments, plain)]
        for s, p, ids in zip(segments, plain, self.library.encode(texts, num_threads=1)):
            own = self.cache[s] if p else head + self.cache[s]
            if packed(ids) != own:
                raise ValueError(f"the library encodes {s!r} as {ids}, the agenda as {list(own)}")

    def segments(self, text: str | None) -> list[str]:
        if not text:
            return []
        return self.segment.findall(MARK + text.replace(" ", MARK))

    def encode_batch(self, texts: list[str | None]) -> Iterator[list[int]]:
        """Ids of each text of one batch."""
        cut = [self.segments(t) for t in texts]
        new = set(chain.from_iterable(cut)).difference(self.cache)
        if len(self.cache) + len(new) > self.limit:
            self.cache.clear()
            new = set(chain.from_iterable(cut))
        self.learn(list(new))
        cache = self.cache
        for parts in cut:
            yield np.frombuffer(b"".join([cache[s] for s in parts]), dtype=np.int32).tolist()


@lru_cache(maxsize=2)
def _encoder(path: str) -> PieceEncoder:
    return PieceEncoder(path)


def _pieces(texts: pd.Series, batch_chars: int = 1_000_000) -> Iterator[list[str | None]]:
    """Texts of a batch in portions of bounded length."""
    part, size = [], 0
    for t in texts:
        part.append(t)
        size += len(t or "")
        if size >= batch_chars:
            yield part
            part, size = [], 0
    if part:
        yield part


def encoded_column(model: str | None = None, with_ids: bool = False):
    """A vectorised function text -> struct(n_tokens, ids_sha256,
    decoded_sha256[, ids]). ``model`` is a path that every executor can read."""
    path = model or default_model()

    @F.pandas_udf(ENCODED + (", ids array<int>" if with_ids else ""))
    def encoded(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        enc = _encoder(path)
        numerals = enc.numerals
        for texts in batches:
            rows = []
            for part in _pieces(texts):
                for ids in enc.encode_batch(part):
                    row = (len(ids), hashlib.sha256(",".join([numerals[i] for i in ids]).encode()).hexdigest(),
                           hashlib.sha256(enc.library.decode(ids).encode()).hexdigest())
                    rows.append((*row, np.array(ids, dtype=np.int32)) if with_ids else row)
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * with_ids)
    return encoded


def encode(docs: DataFrame, model: str | None = None) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256, ids`` of every document."""
    e = docs.select("doc_id", encoded_column(model, True)("text").alias("e"))
    return e.select("doc_id", "e.*")


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and round trip of every whole text."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    e = docs.select("doc_id", encoded_column()("text").alias("e"))
    return e.select("doc_id", "e.*")
