"""Alignment of two tokenizers over the bytes of the same texts.

Both tokenizers read space + text. Byte offsets where a token of each ends cut the
tokens into groups; every A token of a group is linked to every B token of it. A
pair of ids counts the documents that hold it linked.

Most groups are one A token and one B token of the same bytes. For these an array
known beforehand leads from the A id to the B id of the same bytes, so such pairs
are counted in vectors of vocabulary length, one a task, and no pair of them is
ever shuffled. Only pairs of the other, irregular groups enter the pair shuffle,
counted batch by batch before it. The counts go back to the documents the same
way: two vectors (the count of the identity pair and the highest count of an A
id) and the ``FREQUENT`` most frequent irregular pairs, all of fixed size, are
broadcast; the rare pairs of documents are joined to their counts.

Neither tokenizer looks across a single space between two visible characters, so
a text is cut there and each different piece is encoded once a worker (a bounded
cache), many pieces in one call. That the pieces' tokens end at the cuts and join
to the bytes of the text is checked on every call; pieces that do not are encoded
alone. Long pieces and such with characters beyond Latin-1 go through the
``tokenizers`` library; the others through ``tiktoken`` with the same vocabulary,
and every ``CHECKED``th call is compared with the library.

Defined results
    null or empty text, or one whose tokens do not give back its bytes: zeros and
    an empty digest; every row is a document of its own (repeated rows count
    again); very long texts and pieces are encoded whole; empty table: empty
    result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import math
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vehiscope.llm.common import scratch, table, written

#: Irregular pairs with the highest counts that every worker holds.
FREQUENT = 1 << 19
#: Pieces a worker remembers; a longer piece is only known to its batch.
CACHE, LONG = 200_000, 200
#: Characters of text, and pieces of one call, that a task handles at once.
PORTION, CALL = 1 << 20, 8192
CHECKED = 16
#: A group with more links than this is expanded by its distinct ids.
WIDE = 1 << 16

ALIGNED = ("row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
           "own array<int>, own_n array<int>, pairs array<long>, pairs_n array<int>")

#: White space, control and format characters: no cut beside one of these.
_HIDDEN = "".join(chr(c) for lo, hi in ((0x0, 0x20), (0x7F, 0xA0), (0xAD, 0xAD), (0x34F, 0x34F), (0x61C, 0x61C),
                                        (0x1680, 0x1680), (0x180B, 0x180F), (0x2000, 0x206F), (0x2581, 0x2581),
                                        (0x3000, 0x3000), (0xFE00, 0xFE0F), (0xFEFF, 0xFEFF)) for c in range(lo, hi + 1))
_CUT = re.compile(f" (?<=[^{re.escape(_HIDDEN)}] )(?=[^{re.escape(_HIDDEN)}])")
#: The same characters for Arrow's expressions, and those in which a space is no
#: cut, pieces that may be joined, and such of Latin-1 alone.
_HID = "".join(f"\\x{{{ord(c):X}}}" for c in _HIDDEN)
_ODD_SPACE = f"^ | $|[{_HID}] | [{_HID}]"
_JOINABLE = f"^[^{_HID}]$|^[^{_HID}](?s:.)*[^{_HID}]$"
_LATIN = r"^[\x{0}-\x{FF}]*$"


def default_paths() -> tuple[str, str]:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write bytes with: printable
    Latin-1 stands for itself, the others follow from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


class Store:
    """What is known of pieces, as arrays with one entry a piece."""

    def __init__(self):
        self.index: dict[str, int] = {}
        self.strings: list[str] = []
        self.numbers = _Joined(np.zeros((0, 5), dtype=np.int64))  # n_a, n_b, n_groups, n_links, whole
        self.own, self.pairs = _Lists(), _Lists()


class _Joined:
    """An array that grows by pieces and is joined when it is read."""

    def __init__(self, first: np.ndarray):
        self.parts = [first]

    def add(self, part: np.ndarray) -> None:
        self.parts.append(part)

    def all(self) -> np.ndarray:
        if len(self.parts) > 1:
            self.parts = [np.concatenate(self.parts)]
        return self.parts[0]


class _Lists:
    """A list of (value, times) for each piece, one after the other."""

    def __init__(self):
        self.size, self.value, self.times = (_Joined(np.zeros(0, dtype=np.int64)) for _ in range(3))

    def add(self, pieces: int, piece: np.ndarray, value: np.ndarray, times: np.ndarray) -> None:
        """``piece`` in ascending order."""
        self.size.add(np.bincount(piece, minlength=pieces))
        self.value.add(value)
        self.times.add(times)

    def of(self, pieces: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All entries of some pieces: place in ``pieces``, value, times."""
        sizes = self.size.all()
        size = sizes[pieces]
        place = np.repeat(np.arange(len(pieces)), size)
        first = (np.cumsum(sizes) - sizes)[pieces] - (np.cumsum(size) - size)
        at = np.arange(len(place)) + first[place]
        return place, self.value.all()[at], self.times.all()[at]


def _summed(group: np.ndarray, value: np.ndarray, times: np.ndarray, values: int):
    """Distinct (group, value) in order, with their summed times; a value is
    below ``values``."""
    key = group * values + value
    order = np.argsort(key)
    key = key[order]
    new = np.flatnonzero(np.append(True, key[1:] != key[:-1])[:len(key)])
    group, value = np.divmod(key[new], values)
    return group, value, np.add.reduceat(times[order], new) if len(new) else times


def _texts_joined(texts: pa.Array, sizes: np.ndarray, by: str) -> pa.Array:
    """Consecutive texts joined, ``sizes`` of them at a time."""
    offsets = pa.array(np.append(0, np.cumsum(sizes)), pa.int32())
    return pc.binary_join(pa.ListArray.from_arrays(offsets, texts.cast(pa.large_string())),
                          pa.scalar(by, pa.large_string()))


class Aligner:
    """Both tokenizers, the identity map, and the pieces known so far."""

    def __init__(self, a_path: str, b_path: str, cache: int = CACHE):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        import tiktoken
        from sentencepiece import sentencepiece_model_pb2 as proto
        from tokenizers import Tokenizer

        with open(a_path, encoding="utf-8") as f:
            spec = json.load(f)
        before = spec["pre_tokenizer"]
        if spec["normalizer"] or before["type"] != "ByteLevel" or before["add_prefix_space"] or not before["use_regex"]:
            raise ValueError("only byte-level tokenizers with the usual pattern and no normaliser")
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        model = proto.ModelProto()
        model.ParseFromString(self.b.serialized_model_proto())
        if any(re.search("[^▁]▁", p.piece) for p in model.pieces if p.type == 1):
            raise ValueError("a piece with a space mark inside crosses the cuts")
        letters = byte_letters()
        vocabulary = spec["model"]["vocab"]
        special = {t["id"]: t["content"].encode() for t in spec["added_tokens"]}
        self.a_bytes = [b""] * (1 + max(chain(vocabulary.values(), special)))
        for token, i in vocabulary.items():
            self.a_bytes[i] = special.get(i) or bytes(letters[c] for c in token)
        for i, raw in special.items():
            self.a_bytes[i] = raw
        self.b_bytes, normal = [], {}
        for i, p in enumerate(model.pieces):
            raw = bytes([int(p.piece[3:5], 16)]) if p.type == 6 else p.piece.replace("▁", " ").encode() if p.type == 1 else b""
            self.b_bytes.append(raw)
            if p.type == 1:
                normal.setdefault(raw, i)
        for i, raw in enumerate(self.b_bytes):
            if raw:
                normal.setdefault(raw, i)
        self.identity = np.array([normal.get(raw, -1) for raw in self.a_bytes], dtype=np.int64)
        self.a_size = np.array([len(x) for x in self.a_bytes], dtype=np.int64)
        self.b_size = np.array([len(x) for x in self.b_bytes], dtype=np.int64)
        self.numerals = pa.array([str(i) for i in range(max(len(self.a_bytes), len(self.b_bytes)))])
        self.codes = len(self.a_bytes) * len(self.b_bytes)
        if self.codes >= 1 << 40:
            raise ValueError("vocabularies too large for the keys of a portion")
        # the quick way needs ids in the order of the merges
        merged = [vocabulary["".join(m if isinstance(m, list) else m.split(" "))] for m in spec["model"]["merges"]]
        ranks = {raw: i for i, raw in enumerate(self.a_bytes) if raw and i not in special}
        self.quick = None
        if merged == sorted(merged) and len(ranks) + len(special) == len(self.a_bytes):
            self.quick = tiktoken.Encoding("a", pat_str=(
                r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"),
                mergeable_ranks=ranks, special_tokens={})
        self.calls, self.limit = 0, cache
        self.store = Store()

    # -------------------------------------------------------------- encoding
    def _encode_a(self, text: str, quick: bool) -> list[int]:
        if not quick or self.quick is None:
            return self.a.encode(text, add_special_tokens=False).ids
        ids = self.quick.encode_ordinary(text)
        self.calls += 1
        if self.calls % CHECKED == 1 and ids != self.a.encode(text, add_special_tokens=False).ids:
            raise ValueError("the two implementations of tokenizer A differ")
        return ids

    def _joined(self, pieces: list[str], quick: bool) -> bool:
        """Learn pieces in one call of each tokenizer; False, with nothing
        learned, if the tokens do not fit the pieces."""
        text = " " + " ".join(pieces)
        a, b = self._encode_a(text, quick), self.b.encode(text[1:], num_threads=1)
        raw = text.encode()
        if b"".join([self.a_bytes[i] for i in a]) != raw or b"".join([self.b_bytes[i] for i in b]) != raw:
            return False
        a, b = np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)
        a_end, b_end = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        ends = np.cumsum([1 + len(p.encode()) for p in pieces])
        common = np.intersect1d(a_end, b_end, assume_unique=True)
        if len(np.intersect1d(common, ends, assume_unique=True)) != len(ends):
            return False
        self._learned(pieces, a, b, np.searchsorted(common, a_end), np.searchsorted(common, b_end),
                      np.searchsorted(ends, common))
        return True

    def _learned(self, pieces: list[str], a: np.ndarray, b: np.ndarray, a_group: np.ndarray, b_group: np.ndarray,
                 owner: np.ndarray) -> None:
        """Enter pieces whose tokens lie in groups, ``owner`` being a group's piece."""
        n, groups = len(pieces), len(owner)
        na, nb = np.bincount(a_group, minlength=groups), np.bincount(b_group, minlength=groups)
        a0, b0 = np.cumsum(na) - na, np.cumsum(nb) - nb
        links = na * nb
        single = (links == 1) & (self.identity[a[a0]] == b[b0])
        wide = np.flatnonzero(links > WIDE)
        rest = np.flatnonzero(~single & (links <= WIDE))
        g = np.repeat(rest, links[rest])
        k = np.arange(len(g)) - np.repeat(np.cumsum(links[rest]) - links[rest], links[rest])
        found = [(owner[g], a[a0[g] + k // nb[g]], b[b0[g] + k % nb[g]], np.ones(len(g), dtype=np.int64))]
        for w in wide.tolist():
            x, xn = np.unique(a[a0[w]:a0[w] + na[w]], return_counts=True)
            y, yn = np.unique(b[b0[w]:b0[w] + nb[w]], return_counts=True)
            found.append((np.full(len(x) * len(y), owner[w]), np.repeat(x, len(y)), np.tile(y, len(x)),
                          np.repeat(xn, len(y)) * np.tile(yn, len(x))))
        piece, x, y, times = (np.concatenate(c) for c in zip(*found))
        same = self.identity[x] == y  # an identity pair counts as one, whatever its group
        own = _summed(np.append(owner[single], piece[same]), np.append(a[a0[single]], x[same]),
                      np.append(np.ones(int(single.sum()), dtype=np.int64), times[same]), self.codes)
        pairs = _summed(piece[~same], x[~same] * len(self.b_bytes) + y[~same], times[~same], self.codes)
        s = self.store
        s.own.add(n, *own)
        s.pairs.add(n, *pairs)
        count = np.bincount(owner, minlength=n)
        first = np.cumsum(count) - count
        s.numbers.add(np.column_stack([np.add.reduceat(v, first) for v in (na, nb, np.ones_like(na), links)]
                                      + [np.ones(n, dtype=np.int64)]))
        both = [_texts_joined(self.numerals.take(pa.array(ids)), sizes, ",") for ids, sizes in ((a, na), (b, nb))]
        strings = _texts_joined(pc.binary_join_element_wise(*both, pa.scalar("|", pa.large_string())), count, ";").to_pylist()
        s.index.update(zip(pieces, range(len(s.strings), len(s.strings) + n)))
        s.strings += strings

    def _broken(self, piece: str) -> None:
        """A piece whose tokens do not give back its bytes."""
        s, none = self.store, np.zeros(0, dtype=np.int64)
        s.index[piece] = len(s.strings)
        s.strings.append("")
        s.numbers.add(np.zeros((1, 5), dtype=np.int64))
        s.own.add(1, none, none, none)
        s.pairs.add(1, none, none, none)

    def learn(self, pieces: pa.Array) -> None:
        short = pc.less_equal(pc.utf8_length(pieces), LONG)
        fits = pc.and_(short, pc.match_substring_regex(pieces, _JOINABLE))
        latin = pc.and_(fits, pc.match_substring_regex(pieces, _LATIN))
        alone = pieces.filter(pc.invert(fits)).to_pylist()
        for some, quick in ((latin, True), (pc.and_not(fits, latin), False)):
            part = pieces.filter(some).to_pylist()
            for k in range(0, len(part), CALL):
                if not self._joined(part[k:k + CALL], quick):
                    alone += part[k:k + CALL]
        for p in alone:
            if not self._joined([p], False):
                self._broken(p)

    # --------------------------------------------------------------- batches
    def _cut(self, texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
        """Pieces in a row for each text, and their number; an empty or null
        text has none."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        size = np.zeros(len(texts), dtype=np.int64)
        odd = pc.match_substring_regex(texts, _ODD_SPACE).to_numpy(zero_copy_only=False)
        empty = pc.equal(texts, "").to_numpy(zero_copy_only=False)
        lists = pc.split_pattern(texts, " ")
        if not (odd | empty).any():
            return np.diff(np.asarray(lists.offsets)), lists.flatten()
        cut: list[pa.Array] = []
        start = 0
        for k in [*np.flatnonzero(odd | empty).tolist(), len(texts)]:
            if k > start:
                run = lists.slice(start, k - start)
                cut.append(run.flatten())
                size[start:k] = np.diff(np.asarray(run.offsets))
            if k < len(texts) and not empty[k]:
                own = _CUT.split(texts[k].as_py())
                cut.append(pa.array(own, pa.large_string()))
                size[k] = len(own)
            start = k + 1
        return size, pa.concat_arrays(cut) if cut else pa.array([], pa.large_string())

    def align(self, texts: pa.Array) -> tuple[np.ndarray, list[str], tuple, tuple]:
        """Of texts: numbers, digests, and (text, code, times) of the identity
        pairs and of the irregular ones, in order and distinct for each text."""
        size, flat = self._cut(texts)
        coded = flat.dictionary_encode()
        known = coded.dictionary.to_pylist()
        new = [p for p in known if p not in self.store.index]
        if len(self.store.strings) + len(new) > self.limit:
            self.store, new = Store(), known
        self.learn(pa.array(new, pa.large_string()))
        s = self.store
        place = np.array([s.index[p] for p in known], dtype=np.int64)
        inner = coded.indices.to_numpy()
        piece = place[inner]
        text = np.repeat(np.arange(len(size)), size)
        facts = s.numbers.all()[piece]
        whole = size > 0
        whole[text[facts[:, 4] == 0]] = False
        numbers = np.zeros((len(size), 4), dtype=np.int64)
        some = np.flatnonzero(size)
        if len(some):
            numbers[some] = np.add.reduceat(facts[:, :4], (np.cumsum(size) - size)[some])
        numbers[~whole] = 0
        strings = pa.array([s.strings[i] for i in place.tolist()], pa.large_string()).take(coded.indices)
        digests = [hashlib.sha256(d.encode()).hexdigest() if ok else "" for d, ok
                   in zip(_texts_joined(strings, size, ";").to_pylist(), whole.tolist())]
        keep = whole[text]
        kinds = max(1, len(s.strings))
        key, times = np.unique(text[keep] * kinds + piece[keep], return_counts=True)
        text, piece = np.divmod(key, kinds)
        out = []
        for lists in (s.own, s.pairs):
            at, value, inside = lists.of(piece)
            out.append(_summed(text[at], value, inside * times[at], self.codes))
        for p in new:
            if len(p) > LONG:  # not remembered; its entry is given up with the store
                del s.index[p]
        return numbers, digests, out[0], out[1]


@lru_cache(maxsize=1)
def _aligner(a_path: str, b_path: str) -> Aligner:
    return Aligner(a_path, b_path)


def _lists(rows: int, found: tuple, kind: pa.DataType) -> list[pa.Array]:
    """Lists of values and of times for each row."""
    row, value, times = found
    offsets = pa.array(np.append(0, np.cumsum(np.bincount(row, minlength=rows))), pa.int32())
    return [pa.ListArray.from_arrays(offsets, pa.array(value).cast(kind)),
            pa.ListArray.from_arrays(offsets, pa.array(times).cast(pa.int32()))]


def _portions(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, pa.Array]]:
    """Ids and texts of rows whose texts add up to a bounded size."""
    for b in batches:
        texts, ids = b.column("text"), b.column("doc_id").cast(pa.int64())
        sizes = pc.fill_null(pc.utf8_length(texts), 0).to_numpy(zero_copy_only=False)
        portion = np.cumsum(sizes.astype(np.int64)) // PORTION
        starts = np.flatnonzero(np.append(True, portion[1:] != portion[:-1])[:len(sizes)]).tolist()
        for start, end in zip(starts, [*starts[1:], len(sizes)]):
            yield ids.slice(start, end - start), texts.slice(start, end - start)


def aligned(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """One row a document: its numbers, digest and distinct pairs."""
    names = [c.split()[0] for c in ALIGNED.split(", ")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(a_path, b_path)
        row = TaskContext.get().partitionId() << 33
        for ids, texts in _portions(batches):
            numbers, digests, own, pairs = aligner.align(texts)
            n = len(texts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(row, row + n)), ids, *(pa.array(numbers[:, k]) for k in range(4)),
                 pa.array(digests, pa.string()), *_lists(n, own, pa.int32()), *_lists(n, pairs, pa.int64())], names=names)
            row += n

    return docs.select("doc_id", "text").mapInArrow(work, ALIGNED)


def _values(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False)


def pair_counts(docs: DataFrame, size: int, size_b: int) -> DataFrame:
    """``a, b, n``: documents of each pair, from `aligned` rows; identity pairs
    have b = -1. The sizes are those of the vocabularies."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vector = np.zeros(size, dtype=np.int64)
        for batch in batches:
            vector += np.bincount(_values(batch.column("own")), minlength=size)
            code, n = np.unique(_values(batch.column("pairs")), return_counts=True)
            yield _counts(code // size_b, code % size_b, n)
        used = np.flatnonzero(vector)
        yield _counts(used, np.full(len(used), -1), vector[used])

    rows = docs.select("own", "pairs").mapInArrow(work, "a int, b int, n long")
    return rows.groupBy("a", "b").agg(F.sum("n").alias("n"))


def _counts(a: np.ndarray, b: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a).cast(pa.int32()), pa.array(b).cast(pa.int32()),
                                       pa.array(n).cast(pa.int64())], names=["a", "b", "n"])


def _vector(rows: DataFrame, size: int) -> np.ndarray:
    """(a, n) rows, at most one for each id of vocabulary A, as an array."""
    out = np.zeros(size, dtype=np.int64)
    for a, n in rows.collect():
        out[a] = n
    return out


def _bucket(n="n"):
    return F.floor(F.log2(F.col(n).cast("double")) * 4).cast("int")


def frequent_from(counts: DataFrame, most: int) -> int:
    """The smallest count class from which on there are at most ``most``
    irregular pairs; a class is a quarter of a power of two."""
    classes = counts.where("b >= 0").groupBy(_bucket().alias("k")).count().orderBy(F.desc("k")).collect()
    least, total = math.inf, 0
    for k, n in classes:  # at most 4 * 63 rows
        total += n
        if total > most:
            break
        least = k
    return least if least != math.inf else 4 * 64


def _sizes(a_path: str, b_path: str) -> tuple[int, int]:
    """The lengths of both vocabularies."""
    import sentencepiece

    with open(a_path, encoding="utf-8") as f:
        spec = json.load(f)
    return (1 + max(chain(spec["model"]["vocab"].values(), (t["id"] for t in spec["added_tokens"]))),
            sentencepiece.SentencePieceProcessor(model_file=b_path).get_piece_size())


def align(docs: DataFrame, a_path: str | None = None, b_path: str | None = None, frequent: int = FREQUENT) -> DataFrame:
    """Every document with its numbers, digest, and the counts of its links."""
    spark = docs.sparkSession
    a_path, b_path = a_path or default_paths()[0], b_path or default_paths()[1]
    size, size_b = _sizes(a_path, b_path)
    code = F.col("a").cast("long") * size_b + F.col("b")
    with scratch(spark):
        rows = written(aligned(docs, a_path, b_path), "align-rows")
        counts = written(pair_counts(rows, size, size_b), "align-counts")
        own = _vector(counts.where("b = -1").select("a", "n"), size)
        best = _vector(counts.groupBy("a").agg(F.max("n")), size)
        least = frequent_from(counts, frequent)
        high = counts.where("b >= 0").where(_bucket() >= least).select(
            code.alias("code"), "n").toArrow()
        codes = high.column("code").to_numpy()
        order = np.argsort(codes)
        known = spark.sparkContext.broadcast((own, best, codes[order], high.column("n").to_numpy()[order], size_b))
        first = rows.mapInArrow(_looked_up(known), LOOKED_UP)
        rare = (counts.where("b >= 0").where(_bucket() < least)
                .select(code.alias("code"), "a", "n")
                .join(F.broadcast(counts.groupBy("a").agg(F.max("n").alias("top"))), "a")
                .select("code", "n", (F.col("n") == F.col("top")).cast("long").alias("is_best")))
        late = (rows.mapInArrow(_rare(known), "row long, code long, times long").join(rare, "code")
                .groupBy("row").agg(F.sum(F.col("times") * F.col("is_best")).alias("late_best"),
                                    F.sum(F.col("times") * F.col("n")).alias("late_sum")))
        zero = F.lit(0).cast("long")
        out = first.join(late, "row", "left").select(
            "doc_id", "n_a", "n_b", "n_groups", "n_links", (F.col("n_best") + F.coalesce("late_best", zero)).alias("n_best"),
            (F.col("count_sum") + F.coalesce("late_sum", zero)).alias("count_sum"), "groups_sha256")
        return written(out, "align", keep=True)


LOOKED_UP = ("row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
             "n_best long, count_sum long")


def _place(codes: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of codes in a sorted array, and which of them are there."""
    if not len(codes):
        return np.zeros(len(wanted), dtype=np.int64), np.zeros(len(wanted), dtype=bool)
    at = np.minimum(np.searchsorted(codes, wanted), len(codes) - 1)
    return at, codes[at] == wanted


def _looked_up(known):
    """Counts of the links whose pairs every worker knows."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, best, codes, counts, size_b = known.value
        for batch in batches:
            n = batch.num_rows
            a, code = _values(batch.column("own")), _values(batch.column("pairs"))
            at, here = _place(codes, code)
            count = np.append(own[a], np.where(here, counts[at] if len(counts) else 0, 0))
            top = np.append(best[a], best[code // size_b])
            times = np.append(_values(batch.column("own_n")), _values(batch.column("pairs_n"))).astype(np.int64)
            row = np.append(_row_of(batch.column("own")), _row_of(batch.column("pairs")))
            sums, bests = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
            np.add.at(sums, row, count * times)
            np.add.at(bests, row, np.where(count == top, times, 0))
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")]
                + [pa.array(bests), pa.array(sums)], names=[c.split()[0] for c in LOOKED_UP.split(", ")])
    return work


def _row_of(column: pa.Array) -> np.ndarray:
    return np.repeat(np.arange(len(column)), np.diff(np.asarray(column.offsets)))


def _rare(known):
    """Pairs of documents that are not among the frequent ones."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = known.value[2]
        for batch in batches:
            code = _values(batch.column("pairs"))
            late = ~_place(codes, code)[1]
            row = batch.column("row").to_numpy()[_row_of(batch.column("pairs"))[late]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(row), pa.array(code[late]), pa.array(_values(batch.column("pairs_n"))[late].astype(np.int64))],
                names=["row", "code", "times"])
    return work


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level and SentencePiece ids of every whole text, aligned."""
    return align(table(spark, sf_dir, "documents"))
