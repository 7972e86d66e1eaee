"""Document likelihood over the lattice of all subword segmentations.

A text is its words, lower-cased (A-Z), each with the vocabulary's mark in
front, and one end. Every way to spell a word with pieces of an existing
vocabulary is a path of its lattice; a forward recursion in log space adds up
the paths. No piece runs over the mark, so the probability of a document is the
product over its words and the end.

Piece weights start from the vocabulary's own scores. These are ranks, hence a
Zipf law: weight 1 / (1 - score). One expectation step over all learning texts
(forward and backward, weighted by the words' counts) turns them into
probabilities, with the start weights as ``PRIOR`` pseudo-counts.

Each distinct word is worked out once. Blocks of documents send their distinct
words to buckets by a hash; a bucket answers every block. So a word that all
documents hold reaches its bucket once from each block. What goes through the
driver: the corpus totals and one number for each piece of the vocabulary.

Defined results: a NULL or empty text is the end alone; ids may repeat or be
NULL (then held out from nothing: fold 0, a learning row); with nothing to
learn from, the start weights hold.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slicewright.llm.common import pieces_of, saved, text_bytes

MARK = "▁"
BLOCK_BYTES = 8 << 20
BUCKET_BYTES = 4 << 20
#: Distinct words that a learning task gathers before it passes them on.
GATHER = 200_000
PRIOR = 1_000.0
END = -1


def words_of(text: bytes | None) -> list[bytes]:
    """bytes.lower changes A-Z alone; bytes.split cuts at the six white-space characters."""
    return text.lower().split() if text else []


def bucket_of(word: bytes, buckets: int) -> int:
    return xxhash.xxh3_64_intdigest(word) % buckets


class Lattice:
    """Pieces with log weights; sums over all segmentations of a word."""

    def __init__(self, weights: dict[str, float], byte_weights: list[float]):
        self.log = {p: math.log(w) for p, w in weights.items()}
        self.byte_log = [math.log(w) for w in byte_weights]
        self.starts = {p[:i] for p in weights for i in range(1, len(p) + 1)}

    def arcs(self, word: str) -> list[list[tuple[int, float, str]]]:
        """For each place, where its pieces end, their log weights and the pieces."""
        out, log, starts, n = [], self.log.get, self.starts, len(word)
        for i in range(n):
            own, j = [], i + 1
            while j <= n and (s := word[i:j]) in starts:
                if (w := log(s)) is not None:
                    own.append((j, w, s))
                j += 1
            if not own or own[0][0] != i + 1:  # a character without a piece is spelled in bytes
                own.append((i + 1, sum(self.byte_log[b] for b in word[i].encode("utf-8", "replace")), ""))
            out.append(own)
        return out

    @staticmethod
    def forward(arcs: list) -> list[float]:
        exp, log1p = math.exp, math.log1p
        reach: list = [0.0] + [None] * len(arcs)
        for i, own in enumerate(arcs):
            here = reach[i]
            for j, w, _ in own:
                new, old = here + w, reach[j]
                if old is None:
                    reach[j] = new
                elif old > new:
                    reach[j] = old + log1p(exp(new - old))
                else:
                    reach[j] = new + log1p(exp(old - new))
        return reach

    def score(self, word: str) -> float:
        """Natural log of the word's marginal probability."""
        return self.forward(self.arcs(word))[-1]

    def expect(self, word: str, n: int, into: dict) -> None:
        """Add the expected use of each piece in ``n`` of the word."""
        arcs = self.arcs(word)
        reach = self.forward(arcs)
        back: list[float] = [0.0] * (len(arcs) + 1)
        for i in range(len(arcs) - 1, -1, -1):
            ahead = [w + back[j] for j, w, _ in arcs[i]]
            top = max(ahead)
            back[i] = top + math.log(sum([math.exp(a - top) for a in ahead]))
        whole = reach[-1]
        for i, own in enumerate(arcs):
            for j, w, s in own:
                share = n * math.exp(reach[i] + w + back[j] - whole)
                if s:
                    into[s] = into.get(s, 0.0) + share
                else:
                    for b in word[i].encode("utf-8", "replace"):
                        into[b] = into.get(b, 0.0) + share


def vocabulary(model_file: str) -> dict:
    """Start weight of each piece (by text) and each byte (by value), adding up to 1."""
    from sentencepiece import SentencePieceProcessor

    lib = SentencePieceProcessor(model_file=model_file)
    raw: dict = {}
    for i in range(lib.get_piece_size()):
        piece = lib.id_to_piece(i)
        if lib.is_byte(i):
            raw[int(piece[3:5], 16)] = 1.0 / (1.0 + lib.get_piece_size())
        elif not (lib.is_control(i) or lib.is_unknown(i)):
            raw[piece] = 1.0 / (1.0 + max(0.0, -lib.get_score(i)))
    total = sum(raw.values())
    return {p: w / total for p, w in raw.items()}


def lattice_of(weights: dict) -> Lattice:
    return Lattice({p: w for p, w in weights.items() if isinstance(p, str)}, [weights[b] for b in range(256)])


def _blobs(words: list[bytes], counts: list[int] | None, buckets: int) -> Iterator[tuple[int, bytes, bytes]]:
    """The words, by bucket, as compressed lines; their counts beside them."""
    dealt: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        dealt.setdefault(bucket_of(w, buckets), []).append(i)
    squeeze = zstandard.ZstdCompressor(level=3)
    for bucket, own in dealt.items():
        n = np.array([counts[i] for i in own], np.int64).tobytes() if counts else b""
        yield bucket, squeeze.compress(b"\n".join([words[i] for i in own])), squeeze.compress(n)


def _lines(blob: bytes) -> list[bytes]:
    return zstandard.ZstdDecompressor().decompress(blob).split(b"\n")


def _table(types: dict, rows: list[tuple]) -> pa.Table:
    cols = list(zip(*rows)) or [()] * len(types)
    return pa.table({c: pa.array(v, t) for (c, t), v in zip(types.items(), cols)})


def _count_words(docs: DataFrame, buckets: int) -> DataFrame:
    """``bucket``, ``word``, ``c`` over the learning rows."""
    sent = {"bucket": pa.int64(), "words": pa.binary(), "counts": pa.binary()}

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for text in batch["text"].cast(pa.binary()).to_pylist():
                held.update(words_of(text))
                if len(held) > GATHER:
                    yield from _table(sent, list(_blobs(list(held), list(held.values()), buckets))).to_batches()
                    held.clear()
        yield from _table(sent, list(_blobs(list(held), list(held.values()), buckets))).to_batches()

    def add(bucket: pa.Table) -> pa.Table:
        held: Counter = Counter()
        for words, n in zip(bucket["words"].to_pylist(), bucket["counts"].to_pylist()):
            counts = np.frombuffer(zstandard.ZstdDecompressor().decompress(n), np.int64).tolist()
            for w, c in zip(_lines(words), counts):
                held[w] += c
        own = bucket["bucket"][0].as_py()
        return pa.table(
            {"bucket": pa.array([own] * len(held), pa.int64()), "word": pa.array(list(held), pa.binary()), "c": pa.array(list(held.values()), pa.int64())}
        )

    return (
        docs.select("text")
        .mapInArrow(gather, "bucket long, words binary, counts binary")
        .groupBy("bucket")
        .applyInArrow(add, "bucket long, word binary, c long")
    )


def _estimate(types: DataFrame, start: dict, ends: int) -> dict:
    """Piece probabilities after one expectation step; ``END`` is the document's end."""

    def expected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice, into = lattice_of(start), {}
        for batch in batches:
            for word, n in zip(batch["word"].to_pylist(), batch["c"].to_pylist()):
                lattice.expect(MARK + word.decode("utf-8", "replace"), n, into)
        names = [p if isinstance(p, str) else f"<{p}>" for p in into]
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array([isinstance(p, int) for p in into]), pa.array(list(into.values()), pa.float64())],
            names=["piece", "is_byte", "n"],
        )

    rows = types.select("word", "c").mapInArrow(expected, "piece string, is_byte boolean, n double")
    found = rows.groupBy("piece", "is_byte").agg(F.sum("n").alias("n")).collect()  # a row for each piece at most
    used = {int(r.piece[1:-1]) if r.is_byte else r.piece: r.n for r in found}
    total = sum(used.values()) + ends + PRIOR + 1.0
    return {p: (used.get(p, 0.0) + PRIOR * w) / total for p, w in start.items()} | {END: (ends + 1.0) / total}


def score_documents(
    docs: DataFrame,
    model_file: str,
    learning: Column,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``id_col``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score`` of each row.

    ``base_score`` is the smoothed word unigram, ``score`` the lattice; both are
    log10 probabilities and learn from the rows for which ``learning`` holds.
    """
    total = text_bytes(docs, text_col)
    blocks, buckets = pieces_of(total, BLOCK_BYTES), pieces_of(total, BUCKET_BYTES)
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(text_col).cast("string").alias("text"),
        F.coalesce(learning, F.lit(False)).alias("learning"),
    )
    types = saved(_count_words(rows.where("learning"), buckets), "word-counts")
    ends = rows.where("learning").count()
    words, distinct = types.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    tokens = words + ends
    base_unit = math.log10(tokens + 0.5 * (distinct + (ends > 0) + 1))
    weights = _estimate(types, vocabulary(model_file), ends)
    end_score, end_base = math.log10(weights[END]), math.log10(ends + 0.5)
    ln10 = math.log(10)

    dealt = rows.select(
        "id", "text", F.pmod(F.xxhash64("id", F.when(F.col("id").isNull(), F.col("text"))), F.lit(blocks)).alias("block")
    )

    def distinct_words(block: pa.Table) -> dict[int, list[bytes]]:
        seen: dict[bytes, None] = {}
        for text in sorted(t for t in block["text"].cast(pa.binary()).to_pylist() if t):
            seen.update(dict.fromkeys(words_of(text)))
        return seen

    def ask(block: pa.Table) -> pa.Table:
        own = block["block"][0].as_py()
        asked = [(bucket, own, w) for bucket, w, _ in _blobs(list(distinct_words(block)), None, buckets)]
        return _table({"bucket": pa.int64(), "block": pa.int64(), "words": pa.binary()}, asked)

    def answer(asked: pa.Table, known: pa.Table) -> pa.Table:
        lattice = lattice_of(weights)
        counts = dict(zip(known["word"].to_pylist(), known["c"].to_pylist()))
        logs: dict[bytes, float] = {}
        out = []
        squeeze = zstandard.ZstdCompressor(level=3)
        for block, blob in zip(asked["block"].to_pylist(), asked["words"].to_pylist()):
            lines = _lines(blob)
            for w in lines:
                if w not in logs:
                    logs[w] = lattice.score(MARK + w.decode("utf-8", "replace"))
            body = np.array([counts.get(w, 0) for w in lines], np.int64).tobytes()
            body += np.array([logs[w] for w in lines]).tobytes()
            out.append((block, blob, squeeze.compress(body)))
        return _table({"block": pa.int64(), "words": pa.binary(), "body": pa.binary()}, out)

    def finish(block: pa.Table, told: pa.Table) -> pa.Table:
        place: dict[bytes, int] = {}
        counts, logs = [np.zeros(0, np.int64)], [np.zeros(0)]
        for blob, body in zip(told["words"].to_pylist(), told["body"].to_pylist()):
            lines = _lines(blob)
            place.update(zip(lines, range(len(place), len(place) + len(lines))))
            body = zstandard.ZstdDecompressor().decompress(body)
            counts.append(np.frombuffer(body, np.int64, len(lines)))
            logs.append(np.frombuffer(body, np.float64, len(lines), 8 * len(lines)))
        count, log = np.concatenate(counts), np.concatenate(logs) / ln10
        base, known = np.log10(count + 0.5), count > 0
        out = []
        for doc, text in zip(block["id"].to_pylist(), block["text"].cast(pa.binary()).to_pylist()):
            own = words_of(text)
            at = np.fromiter(map(place.__getitem__, own), np.int64, len(own))
            n = len(own) + 1
            out.append(
                (doc, n, int(known[at].sum()) + (ends > 0), tokens, float(base[at].sum()) + end_base - n * base_unit, float(log[at].sum()) + end_score)
            )
        types = {id_col: pa.int64()} | dict.fromkeys(["n_tokens", "n_known", "train_tokens"], pa.int64())
        return _table(types | dict.fromkeys(["base_score", "score"], pa.float64()), out)

    answers = (
        dealt.groupBy("block")
        .applyInArrow(ask, "bucket long, block long, words binary")
        .groupBy("bucket")
        .cogroup(types.groupBy("bucket"))
        .applyInArrow(answer, "block long, words binary, body binary")
    )
    return (
        dealt.groupBy("block")
        .cogroup(answers.groupBy("block"))
        .applyInArrow(finish, f"`{id_col}` long, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    )
