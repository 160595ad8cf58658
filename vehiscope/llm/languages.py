"""Language identification by cross-parsing entropy over suffix automata.

Each language is known by a bounded sample of its labelled text, held as a suffix
automaton: the walk from its root along the bytes of another text goes exactly as
far as the sample has that run of bytes. A text is parsed greedily: each phrase is
the longest match that starts where the one before ended (a byte the sample does
not have is a phrase of its own). Few long phrases mean a small cross entropy
``phrases * log2(sample length) / text length``; the language with the smallest
one wins, ties go to the smaller name.

Texts are lower-cased; ASCII characters that are no letters become one space a
run. A text is parsed whole, in blocks of ``BLOCK`` bytes at whose ends a phrase
ends too, for all languages alike, so that all blocks of an Arrow batch walk the
automaton side by side.

The fit reads labelled rows only. The sample is bounded by ``SAMPLE_BYTES`` in
all, ``LANGUAGE_BYTES`` a language (less for more than eight languages),
``SAMPLE_TEXTS`` texts a language and the ``LANGUAGES`` languages with the most
texts; it takes whole distinct texts of at most the language's bytes in the order
of their hash. The tables of an automaton are built once a Python worker.

Defined results
    null text, or no letter: ``und`` with score 0; nothing learned: the same for
    all; null doc_id: neither held out nor learned from; null lang: not learned
    from; very long texts are parsed whole; repeated rows get the same result;
    empty table: empty result; other columns are not read. The score is the
    margin ``1 - best / second`` of the two smallest entropies (1 for a single
    learned language).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vehiscope.llm.common import table

SAMPLE_BYTES, LANGUAGE_BYTES = 1 << 18, 1 << 15
SAMPLE_TEXTS, LANGUAGES = 256, 64
BLOCK = 128
#: Bytes of text parsed at once by a task (one longer text is parsed alone).
PORTION = 1 << 22
#: Stands between sample texts; no normalised text has it.
BREAK = 0

PREDICTED = "doc_id long, held_out boolean, lang_pred string, score double"

_FOLD = np.full(256, 32, dtype=np.uint8)
_FOLD[128:] = np.arange(128, 256)
_FOLD[97:123] = np.arange(97, 123)


def held_out_column(id_col: str = "doc_id"):
    """crc32 of the id as text, modulo 3, is 1 (null id: false)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


# ------------------------------------------------------------------- the model
def suffix_automaton(codes: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of a sequence; state 0 is the root and
    no transition leads to it."""
    step: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in codes:
        new = len(step)
        step.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = new
            p = link[p]
        if p >= 0:
            q = step[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                copy = len(step)
                step.append(dict(step[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                link[q] = link[new] = copy
                while p >= 0 and step[p].get(c) == q:
                    step[p][c] = copy
                    p = link[p]
        last = new
    return step


def normal_bytes(raw: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Folded bytes of lower-cased texts with runs of spaces as one, and the new
    starts; ``starts`` has one more entry than there are texts."""
    folded = _FOLD[raw]
    space = folded == 32
    keep = ~(space & np.append(False, space[:-1]))
    keep[starts[:-1][np.diff(starts) > 0]] = True  # a run does not reach into the next text
    return folded[keep], np.append(0, np.cumsum(keep))[starts]


def _normal(text: str) -> bytes:
    raw = np.frombuffer(text.lower().encode(), dtype=np.uint8)
    return normal_bytes(raw, np.array([0, len(raw)]))[0].tobytes()


class Language:
    """Automaton of one language as a table of states by symbols."""

    def __init__(self, texts: list[str]):
        sample = bytes([BREAK]).join(_normal(t) for t in texts)
        self.weight = math.log2(max(2, len(sample)))
        seen = sorted(set(sample))
        self.width = len(seen) + 1  # symbol 0: a byte the sample does not have
        self.code = np.zeros(256, dtype=np.int64)
        self.code[seen] = np.arange(1, self.width)
        step = suffix_automaton(self.code[np.frombuffer(sample, dtype=np.uint8)].tolist())
        states = np.repeat(np.arange(len(step)), [len(s) for s in step])
        table_ = np.zeros(len(step) * self.width, dtype=np.int32)
        symbols = np.fromiter((c for s in step for c in s), dtype=np.int64, count=len(states))
        table_[states * self.width + symbols] = np.fromiter(
            (t for s in step for t in s.values()), dtype=np.int64, count=len(states))
        self.table = table_
        self.code[BREAK] = 0

    def phrases(self, blocks: np.ndarray, active: list[int]) -> np.ndarray:
        """Phrases of each block; ``blocks[t]`` has the byte t of all blocks, of
        which the first ``active[t]`` are that long."""
        lanes = blocks.shape[1]
        state = np.zeros(lanes, dtype=np.int64)
        count = np.zeros(lanes, dtype=np.int64)
        for t, n in enumerate(active):
            code = self.code[blocks[t, :n]]
            s = state[:n]
            onward = self.table[s * self.width + code]
            ended = onward == 0
            count[:n] += ended | (s == 0)
            state[:n] = np.where(ended, self.table[code], onward)
        return count


class Languages:
    """All learned languages."""

    def __init__(self, samples: tuple[tuple[str, tuple[str, ...]], ...]):
        self.names = [name for name, _ in samples]
        self.models = [Language(list(texts)) for _, texts in samples]

    def entropies(self, raw: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Cross entropy (text, language) of lower-cased UTF-8 texts."""
        data, at = normal_bytes(raw, starts)
        size = np.diff(at)
        blocks = -(-size // BLOCK)
        text = np.repeat(np.arange(len(size)), blocks)
        inner = (np.arange(len(text)) - np.repeat(np.cumsum(blocks) - blocks, blocks)) * BLOCK
        length = np.minimum(BLOCK, size[text] - inner)
        order = np.argsort(-length, kind="stable")
        text, first, length = text[order], (at[:-1][text] + inner)[order], length[order]
        active = np.searchsorted(-length, -np.arange(length[0] if len(length) else 0), side="left").tolist()
        matrix = np.zeros((len(active), len(text)), dtype=np.uint8)
        for t, n in enumerate(active):
            matrix[t, :n] = data[first[:n] + t]
        out = np.zeros((len(size), len(self.models)))
        for k, m in enumerate(self.models):
            phrases = np.bincount(text, weights=m.phrases(matrix, active), minlength=len(size))
            out[:, k] = phrases * m.weight / np.maximum(size, 1)
        return out

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        """Language and score of each text."""
        low = pc.utf8_lower(texts.cast(pa.large_string()))
        letter = pc.fill_null(pc.match_substring_regex(low, r"\p{L}"), False).to_numpy(zero_copy_only=False)
        if not self.names:
            letter[:] = False
        offsets = np.frombuffer(low.buffers()[1], dtype=np.int64)[low.offset:low.offset + len(low) + 1]
        data = low.buffers()[2]
        raw = np.frombuffer(data, dtype=np.uint8) if data and data.size else np.zeros(0, dtype=np.uint8)
        pred, score = ["und"] * len(low), np.zeros(len(low))
        start = 0
        while start < len(low):
            end = max(start + 1, int(np.searchsorted(offsets, offsets[start] + PORTION, side="right")) - 1)
            rows = np.flatnonzero(letter[start:end]) + start
            if len(rows):
                part = offsets[start:end + 1]
                h = self.entropies(raw[part[0]:part[-1]], part - part[0])[rows - start]
                order = np.argsort(h, axis=1, kind="stable")
                best = h[np.arange(len(rows)), order[:, 0]]
                score[rows] = 1 - best / h[np.arange(len(rows)), order[:, 1]] if h.shape[1] > 1 else 1.0
                for r, k in zip(rows.tolist(), order[:, 0].tolist()):
                    pred[r] = self.names[k]
            start = end
        return pred, score


@lru_cache(maxsize=1)
def _languages(samples: tuple) -> Languages:
    return Languages(samples)


# ------------------------------------------------------------------ on Spark
def fit(docs: DataFrame, sample_bytes: int = SAMPLE_BYTES, language_bytes: int = LANGUAGE_BYTES,
        sample_texts: int = SAMPLE_TEXTS, languages: int = LANGUAGES) -> tuple[tuple[str, tuple[str, ...]], ...]:
    """The bounded sample of each language, by name."""
    learn = (docs.where(~held_out_column() & F.col("doc_id").isNotNull() & F.col("lang").isNotNull())
             .select("lang", "text", F.xxhash64("text").alias("h"), F.octet_length("text").alias("size"))
             .where("size between 1 and " + str(language_bytes)))
    seen = (learn.groupBy("lang").agg(F.count("*").alias("n"), F.approx_count_distinct("h").alias("texts"))
            .orderBy(F.desc("n"), "lang").limit(languages).collect())
    names = [r.lang for r in seen]
    if not names:
        return ()
    each = min(language_bytes, sample_bytes // len(names))
    # the smallest hashes of a language lie below this share of all hashes, so that
    # only some multiples of the sample are sorted
    share = F.create_map(*[F.lit(v) for r in seen for v in (r.lang, min(1.0, 8 * sample_texts / r.texts))])
    low = F.col("h").cast("double") / 2.0 ** 64 + 0.5 <= share[F.col("lang")]
    by_hash = W.partitionBy("lang").orderBy("h", "size")
    picked = (learn.where(F.col("lang").isin(names) & (F.col("size") <= each) & low).select("lang", "h", "size").distinct()
              .withColumn("k", F.row_number().over(by_hash)).where(F.col("k") <= sample_texts)
              .withColumn("sofar", F.sum("size").over(by_hash.rowsBetween(W.unboundedPreceding, 0)))
              .where(F.col("sofar") <= each).select("lang", "h", "size"))
    # at most languages * sample_texts rows, whose texts add up to sample_bytes
    rows = (learn.join(F.broadcast(picked), ["lang", "h", "size"]).groupBy("lang", "h").agg(F.min("text").alias("text"))
            .orderBy("lang", "h").collect())
    out: dict[str, list[str]] = {}
    for r in rows:
        out.setdefault(r.lang, []).append(r.text)
    return tuple((name, tuple(texts)) for name, texts in sorted(out.items()))


def identify(docs: DataFrame, samples: tuple[tuple[str, tuple[str, ...]], ...]) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every document."""
    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _languages(samples)
        for b in batches:
            pred, score = model.predict(b.column("text"))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").cast(pa.int64()), b.column("held_out"), pa.array(pred, pa.string()), pa.array(score)],
                names=["doc_id", "held_out", "lang_pred", "score"])

    return docs.select("doc_id", held_out_column().alias("held_out"), "text").mapInArrow(parse, PREDICTED)


def op12_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every whole text."""
    docs = table(spark, sf_dir, "documents")
    return identify(docs, fit(docs))
