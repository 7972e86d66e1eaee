"""SentencePiece encoding and decoding for merge-type vocabularies.

Encoding keeps an agenda of adjacent symbol pairs. The pair whose joined piece
has the best score is merged first (ties: the leftmost), its new neighbours
enter the agenda, and pairs that a merge has overtaken are skipped. A symbol
without a piece becomes its UTF-8 bytes.

No piece of such a vocabulary has its space mark behind another character
(``MergeCoder`` checks this), so no merge crosses the start of a word, and the
text may be cut there. The new cuts of a batch are coded together: each has its
agenda in a row of a matrix, and all take their best pair at once; long cuts, and
those with characters without a piece, go one by one. Each distinct cut is coded once per worker, and in every
Arrow batch the new ones are compared with the sentencepiece library itself; a
difference fails the job.

Defined results: a NULL text counts as empty; an empty text has the begin and
end ids alone and decodes to an empty text; repeated rows are coded each;
only the id and the text column are read, so other columns cannot clash.
"""

from __future__ import annotations

import codecs
import heapq
import re
import struct
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slicewright.llm.common import lasts_a_stage, small_slices

SPACE = "▁"
#: Fixed value: how the library spells the unknown id.
UNKNOWN = " \u2047 "
CUTS = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
#: Distinct cuts that a worker remembers; the ones not met since as many others are forgotten.
MEMORY = 100_000
#: Text that is coded at once.
CODE_BYTES = 1 << 20
#: Symbols beyond which the agenda is a heap.
LONG = 48
NEVER = float("inf")
#: Cuts that are coded together, and the rank of a pair that is no piece.
TOGETHER, NO_RANK = 4_096, np.int32(2**31 - 1)
MIX = 0x9E3779B97F4A7C15


codecs.register_error("mark_each_byte", lambda e: ("\ufffd" * (e.end - e.start), e.end))


class Pairs:
    """Which two symbols join to which piece, and how soon, looked up for whole arrays."""

    def __init__(self, cost: dict[str, float]):
        names = [*cost, *({c for p in cost for c in p} - cost.keys())]
        self.symbols = {p: i for i, p in enumerate(names)}
        self.unknown = len(names)
        self.base = self.unknown + 1
        self.sizes = np.array([*map(len, names), 1])
        self.of_char = np.full(0x110000, self.unknown, np.int32)
        for name, i in self.symbols.items():
            if len(name) == 1:
                self.of_char[ord(name)] = i
        rank = {c: i for i, c in enumerate(sorted(set(cost.values())))}
        found = {}
        for piece, c in cost.items():
            for k in range(1, len(piece)):
                a, b = self.symbols.get(piece[:k]), self.symbols.get(piece[k:])
                if a is not None and b is not None:
                    found[a * self.base + b] = (self.symbols[piece], rank[c])
        # a hash table with free slots enough that a look-up mostly ends at its first one
        bits = max(8, (8 * len(found)).bit_length())
        self.shift, self.last = np.uint64(64 - bits), (1 << bits) - 1
        self.codes = np.full(1 << bits, -1, np.int64)
        self.joined = np.zeros(1 << bits, np.int32)
        self.rank = np.full(1 << bits, NO_RANK, np.int32)
        for code, (piece, soon) in found.items():
            slot = (code * MIX % 2**64) >> int(self.shift)
            while self.codes[slot] >= 0:
                slot = (slot + 1) & self.last
            self.codes[slot], self.joined[slot], self.rank[slot] = code, piece, soon

    def look_up(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Slot of each pair in ``joined`` and ``rank``; a free slot, of no rank, where the two do not join."""
        wanted = left.astype(np.int64) * self.base + right
        slot = ((wanted.view(np.uint64) * np.uint64(MIX)) >> self.shift).astype(np.int64)
        found = self.codes[slot]
        todo = np.flatnonzero((found != wanted) & (found >= 0))
        while len(todo):
            slot[todo] = (slot[todo] + 1) & self.last
            found = self.codes[slot[todo]]
            todo = todo[(found != wanted[todo]) & (found >= 0)]
        return slot

    def merge(self, cuts: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of each cut of at most ``width`` characters after all merges, and their number."""
        sizes = np.array([len(c) for c in cuts])
        symbols = self.of_char[np.array(cuts, f"<U{width}").view(np.uint32).reshape(len(cuts), width)]
        place = np.arange(width)[None, :]
        at = self.look_up(symbols[:, :-1].ravel(), symbols[:, 1:].ravel())
        agenda = np.where(place[:, 1:] < sizes[:, None], self.rank[at].reshape(len(cuts), -1), NO_RANK)
        agenda = np.append(agenda, np.full((len(cuts), 1), NO_RANK), 1)
        out, rows = symbols.copy(), np.arange(len(cuts))
        while True:
            best = agenda.argmin(1)
            go = agenda[np.arange(len(rows)), best] != NO_RANK
            if not go.all():
                out[rows[~go]] = symbols[~go]
                rows, symbols, agenda, best = rows[go], symbols[go], agenda[go], best[go]
            if not len(rows):
                return out, sizes
            own = np.arange(len(rows))
            joined = self.joined[self.look_up(symbols[own, best], symbols[own, best + 1])]
            moved = np.minimum(place + (place > best[:, None]), width - 1)
            symbols, agenda = np.take_along_axis(symbols, moved, 1), np.take_along_axis(agenda, np.minimum(place + (place >= best[:, None]), width - 1), 1)
            symbols[own, best] = joined
            sizes[rows] -= 1
            after = np.minimum(best + 1, width - 1)
            ends = best + 1 < sizes[rows]
            agenda[own, best] = np.where(ends, self.rank[self.look_up(joined, symbols[own, after])], NO_RANK)
            has = np.flatnonzero(best)
            agenda[has, best[has] - 1] = self.rank[self.look_up(symbols[has, best[has] - 1], joined[has])]


class MergeCoder:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, model_file: str, check: bool = True):
        from sentencepiece import SentencePieceProcessor

        self.library = lib = SentencePieceProcessor(model_file=model_file)
        self.check = check
        ids = range(lib.get_piece_size())
        self.bytes_at = {int(lib.id_to_piece(i)[3:5], 16): i for i in ids if lib.is_byte(i)}
        plain = [i for i in ids if not (lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i))]
        self.piece_id = {lib.id_to_piece(i): i for i in plain}
        self.cost = {p: -lib.get_score(i) for p, i in self.piece_id.items()}
        if len(self.bytes_at) != 256 or any(SPACE in p.lstrip(SPACE) for p in self.piece_id):
            raise ValueError(f"not a merge-type vocabulary with byte fallback: {model_file}")
        spelled = {i: p.replace(SPACE, " ").encode() for p, i in self.piece_id.items()}
        spelled |= {i: bytes([b]) for b, i in self.bytes_at.items()}
        spelled[lib.unk_id()] = UNKNOWN.encode()
        self.no_mark = {*self.bytes_at.values(), lib.unk_id()}
        self.spelling = [spelled.get(i, b"") for i in ids]
        self.begin, self.end = lib.bos_id(), lib.eos_id()
        self.pairs = Pairs(self.cost)
        self.id_of = np.array([self.piece_id.get(s, -1) for s in self.pairs.symbols] + [-1], np.int64)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        #: The cuts remembered that are not decoded to themselves.
        self.altered: dict[str, bytes] = {}

    def merge(self, text: str) -> list[int]:
        """Ids of a text whose spaces are marks already."""
        symbols = self._merge_long(text) if len(text) > LONG else self._merge_short(text)
        out: list[int] = []
        for s in symbols:
            at = self.piece_id.get(s)
            out.extend([at] if at is not None else [self.bytes_at[b] for b in s.encode()])
        return out

    def _merge_short(self, text: str) -> list[str]:
        """The agenda as a list beside the symbols: entry i is the cost of joining i and i + 1."""
        symbols, cost = list(text), self.cost.get
        agenda = [cost(a + b, NEVER) for a, b in zip(symbols, symbols[1:])]
        while agenda and (best := min(agenda)) != NEVER:
            i = agenda.index(best)
            symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]
            del agenda[i]
            if i < len(agenda):
                agenda[i] = cost(symbols[i] + symbols[i + 1], NEVER)
            if i:
                agenda[i - 1] = cost(symbols[i - 1] + symbols[i], NEVER)
        return symbols

    def _merge_long(self, text: str) -> list[str]:
        """The agenda as a heap, so that a word of any length takes n log n steps."""
        symbols: list[str] = list(text)
        n = len(symbols)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        agenda: list[tuple[float, int, int, str]] = []

        def offer(left: int, right: int) -> None:
            joined = symbols[left] + symbols[right]
            if (s := self.cost.get(joined)) is not None:
                heapq.heappush(agenda, (s, left, right, joined))

        for i in range(n - 1):
            offer(i, i + 1)
        while agenda:
            _, left, right, joined = heapq.heappop(agenda)
            if after[left] != right or symbols[left] + symbols[right] != joined:
                continue  # one of the two is part of an earlier merge
            symbols[left], symbols[right] = joined, ""
            after[left] = nxt = after[right]
            after[right] = -2
            if nxt >= 0:
                before[nxt] = left
                offer(left, nxt)
            if before[left] >= 0:
                offer(before[left], left)
        return [s for s in symbols if s]

    def merge_together(self, cuts: list[str]) -> list[bytes]:
        """Packed ids of each cut."""
        out = [b""] * len(cuts)
        order = sorted(range(len(cuts)), key=lambda i: len(cuts[i]))
        for start in range(0, len(order), TOGETHER):
            some = order[start : start + TOGETHER]
            symbols, sizes = self.pairs.merge([cuts[i] for i in some], len(cuts[some[-1]]) + 1)
            ids = self.id_of[symbols]
            whole = ((ids >= 0) | (np.arange(ids.shape[1])[None, :] >= sizes[:, None])).all(1)
            packed, row = ids.astype("<u4").tobytes(), 4 * ids.shape[1]
            for k, (i, n, good) in enumerate(zip(some, sizes.tolist(), whole.tolist())):
                out[i] = packed[k * row : k * row + 4 * n] if good else self._with_bytes(cuts[i], symbols[k, :n])
        return out

    def _with_bytes(self, cut: str, symbols: np.ndarray) -> bytes:
        """Packed ids where some symbols have no piece."""
        out, at = [], 0
        for i, size in zip(self.id_of[symbols].tolist(), self.pairs.sizes[symbols].tolist()):
            out.extend([i] if i >= 0 else [self.bytes_at[b] for b in cut[at].encode()])
            at += size
        return struct.pack(f"<{len(out)}I", *out)

    def _learn(self, cuts: set[str]) -> None:
        """Code the cuts that are not remembered."""
        new = []
        for cut in cuts:
            if (seen := self.older.get(cut)) is not None:
                self.known[cut] = seen
            else:
                new.append(cut)
        # long cuts, and one more so that this way stays checked too, are merged by themselves
        alone = [c for k, c in enumerate(new) if not k or len(c) > LONG]
        short = [c for k, c in enumerate(new) if k and len(c) <= LONG]
        packed = [struct.pack(f"<{len(ids)}I", *ids) for ids in map(self.merge, alone)] + self.merge_together(short)
        new = alone + short
        if self.check:
            self._compare(new, packed)
        self.known.update(zip(new, packed))
        if self._spelled(b"".join(packed)) != "".join(new).replace(SPACE, " ").encode():
            spelled = zip(new, map(self._spelled, packed))
            self.altered |= {c: s for c, s in spelled if s != c.replace(SPACE, " ").encode()}

    def _spelled(self, packed: bytes) -> bytes:
        return b"".join(map(self.spelling.__getitem__, memoryview(packed).cast("I")))

    def _compare(self, cuts: list[str], packed: list[bytes]) -> None:
        """Fail where the library codes a cut in another way."""
        wanted = self.library.encode([c[1:] for c in cuts], num_threads=1)
        ours = [b"" if c == SPACE else p for c, p in zip(cuts, packed)]
        sizes = [4 * len(w) for w in wanted]
        if sizes != list(map(len, ours)) or array("I", chain.from_iterable(wanted)).tobytes() != b"".join(ours):
            bad = next(c for c, w, o in zip(cuts, wanted, ours) if array("I", w).tobytes() != o)
            raise AssertionError(f"ids differ from the library's for {bad!r}")

    def encode_batch(self, texts: list[str]) -> tuple[list[bytes], list[str]]:
        """Packed ids, with begin and end, and the decoded text of each text."""
        if len(self.known) > MEMORY:
            self.known, self.older = {}, self.known
            self.altered = {c: s for c, s in self.altered.items() if c in self.older}
        cuts = [CUTS.findall(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        ids, decoded = [], []
        frame = struct.pack("<2I", self.begin, self.end)
        words = set().union(*cuts)
        self._learn(words - self.known.keys())
        altered = words & self.altered.keys()
        for text, own in zip(texts, cuts):
            ids.append(frame[:4] + b"".join(map(self.known.__getitem__, own)) + frame[4:])
            if altered and not altered.isdisjoint(own):
                spelled = [self.altered[c] if c in altered else c.replace(SPACE, " ").encode() for c in own]
                decoded.append(b"".join(spelled)[1:].decode())  # without the mark put in front
            else:
                decoded.append(text if SPACE not in text else text.replace(SPACE, " "))
        return ids, decoded

    def decode(self, ids: Iterable[int]) -> str:
        """Text of any ids; each byte that is no UTF-8 becomes a replacement character."""
        shown = [i for i in ids if self.spelling[i]]
        text = b"".join([self.spelling[i] for i in shown]).decode("utf-8", "mark_each_byte")
        return text[1:] if shown and shown[0] not in self.no_mark and text[:1] == " " else text


@lru_cache(2)
def coder(model_file: str, check: bool) -> MergeCoder:
    """One coder for all tasks that a worker runs for a stage, so that what it remembers serves them all."""
    return MergeCoder(model_file, check)


lasts_a_stage(coder.cache_clear)


def encode_decode(
    docs: DataFrame, model_file: str, *, id_col: str = "doc_id", text_col: str = "text", check: bool = True
) -> DataFrame:
    """``id_col``, ``ids`` (little-endian unsigned 32-bit integers) and ``decoded`` of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_slices(batches, "text", CODE_BYTES):
            ids, decoded = coder(model_file, check).encode_batch([t or "" for t in batch["text"].to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [batch["id"], pa.array(ids, pa.binary()), pa.array(decoded, pa.string())],
                names=[id_col, "ids", "decoded"],
            )

    kind = docs.schema[id_col].dataType
    out = T.StructType(
        [T.StructField(id_col, kind), T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.StringType())]
    )
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, out)
