"""Brings equal windows of different documents together, and removes the later ones.

Shared by the two substring operators, which differ in the unit (byte or word),
in how a window picks its minimiser, and in how a bucket finds equal windows.

1. Documents are dealt to blocks by a hash of their id; one block fits a task.
2. Each window names one minimiser: the smallest hash among the short grams it
   holds. Equal windows name the same one. Consecutive windows with the same
   minimiser form a run.
3. Every block sends its distinct minimisers to their buckets, each with a byte
   for the units on either side of the gram. Two equal windows hold the gram at
   one place, and with it half of the remaining units on its left or on its
   right: runs whose sides both differ hold no equal windows. What comes back are
   the minimisers that meet one of another block so. All other windows occur in
   one block.
4. Runs whose minimiser came back, or meets another in the block, travel as one
   packed string each to the minimiser's bucket; equal runs of a block travel
   once, with the smallest document id. That is what keeps copies, however
   many, from meeting in one task.
5. The bucket compares the windows exactly and answers, for parts of runs, the
   smallest document id that holds the window. The block removes what its later
   documents cover with them.

A minimiser with very many distinct runs (``HOT_RUNS``, summed over the blocks)
would make one bucket large, as a short line does whose surroundings differ from
document to document. Its windows travel one by one instead, to the bucket of
their own hash. Blocks send the number of distinct runs with each minimiser, so
the split depends on the size of the group and not on that of the table.

Short grams recur by chance the more often the larger the table is. The sides
keep what travels at the share of windows that do repeat, whatever the size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from slicewright.llm.common import NO_ID, pieces_of, text_bytes

BLOCK_BYTES = 12 << 20
BUCKET_BYTES = 3 << 20
HOT_BLOCKS = 4_096
#: Distinct runs of one minimiser in a bucket at most; of ``LONGEST_RUN`` windows each at most.
HOT_RUNS = 4_096
#: Runs of one minimiser that a block counts up to.
MOST_RUNS = 2**16 - 1
#: Windows whose minimisers are found at once (places in them have 16 bits), and windows of one run at most.
STRETCH, LONGEST_RUN = (1 << 16) - 256, 256
#: Minimisers travel as 48 bits; a chance agreement only sends a run in vain.
KEY_BITS, KEY_BYTES = np.uint64(16), 6
#: The lower 16 bits beside a minimiser: a byte for the left and one for the right side of its gram.
SIDE, SIDE_BITS = np.uint64(255), np.uint64(8)
#: A side that no window reaches over, as the text ends before; one that may be equal to any.
NO_SIDE, ANY_SIDE = 0, 255


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` neighbours."""
    reach = 1
    while reach * 2 <= width:
        x = np.minimum(x[:-reach], x[reach:])
        reach *= 2
    return np.minimum(x[: len(x) - (width - reach)], x[width - reach :]) if width > reach else x


def _counted(n: np.ndarray) -> np.ndarray:
    """0 to n - 1, for each n in turn."""
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)


def key_bytes(keys: np.ndarray) -> bytes:
    return np.ascontiguousarray(keys).view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES].tobytes()


def keys_from(data: bytes) -> np.ndarray:
    wide = np.zeros((len(data) // KEY_BYTES, 8), np.uint8)
    wide[:, :KEY_BYTES] = np.frombuffer(data, np.uint8).reshape(-1, KEY_BYTES)
    return wide.view(np.uint64).ravel()


@dataclass(frozen=True)
class Units:
    """How an operator reads a text: ``width`` units make a window."""

    width: int
    #: text -> units; anything with a length that ``minimisers`` and ``packed`` take
    split: Callable
    #: units, first and last window -> a 64-bit minimiser for each window, of which the upper 48 count
    minimisers: Callable
    #: units, first unit, end unit -> bytes
    packed: Callable
    #: packed strings, keys -> for each window of all strings in turn, the number of its class
    classes: Callable
    #: packed string -> units in it
    size: Callable
    #: texts, text and place of grams -> the 16 bits of their sides; without it, runs meet by the minimiser alone.
    #: The lower 16 bits of a minimiser are then the place of the first such gram, from the first window on
    sides: Callable | None = None
    #: several texts' units -> those of one text that holds them one after another, to be read at once
    joined: Callable | None = None


def runs(units: Units, text) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First window, windows, minimiser (48 bits) and place of the gram of each run of a text; -1: at several places."""
    windows = len(text) - units.width + 1
    if windows <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    parts = []
    for low in range(0, windows, STRETCH):
        cut, n, key, at = _stretch(units.minimisers(text, low, min(windows, low + STRETCH)))
        parts.append((cut + low, n, key, np.where(at < 0, at, at + low)))
    return parts[0] if len(parts) == 1 else tuple(np.concatenate(p) for p in zip(*parts))


def _stretch(found: np.ndarray, breaks: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The runs among the minimisers of windows side by side; one starts at each of ``breaks``."""
    key = found >> KEY_BITS
    new = np.empty(len(key), bool)
    new[0] = True
    np.not_equal(key[1:], key[:-1], out=new[1:])
    if breaks is not None:
        new[breaks] = True
    cut = np.flatnonzero(new)
    n = np.diff(np.append(cut, len(key)))
    if n.max() > LONGEST_RUN:
        pieces = -(-n // LONGEST_RUN)
        cut = np.repeat(cut, pieces) + _counted(pieces) * LONGEST_RUN
        n = np.diff(np.append(cut, len(key)))
    # equal windows name the first of equal grams, which stays in place within a run or comes nearer its end
    at = np.where(found[cut] == found[cut + n - 1], (found[cut] & np.uint64(0xFFFF)).astype(np.int64), -1)
    return cut, n, key[cut], at


def _runs_of(units: Units, texts: list, first_row: int) -> tuple[np.ndarray, ...]:
    """Row and runs of several texts, of at most STRETCH units together or one alone."""
    size = np.array([len(t) for t in texts], np.int64)
    if len(texts) == 1 or size.sum() < units.width:
        parts = [(np.full(len(r[0]), first_row + i), *r) for i, t in enumerate(texts) for r in [runs(units, t)]]
        return tuple(np.concatenate(p) for p in zip(*parts))
    start = np.cumsum(size) - size
    stop = start + np.maximum(0, size - (units.width - 1))  # windows from there on reach into the next text
    windows = int(size.sum()) - (units.width - 1)
    breaks = np.concatenate([start, stop])
    cut, n, key, at = _stretch(units.minimisers(units.joined(texts), 0, windows), breaks[breaks < windows])
    row = np.searchsorted(start, cut, side="right") - 1
    own = np.flatnonzero(cut < stop[row])
    row, cut, n, key, at = (x[own] for x in (row, cut, n, key, at))
    return row + first_row, cut - start[row], n, key, np.where(at < 0, at, at - start[row])


def _documents(block: pa.Table) -> list[tuple[int, bytes]]:
    """Id and UTF-8 text, by id; rows without an id come last."""
    ids = block["id"].fill_null(NO_ID).to_pylist()
    texts = block["text"].cast(pa.binary()).fill_null(b"").to_pylist()
    return sorted(zip(ids, texts))


@dataclass
class Cut:
    """The runs of a block's documents, in order."""

    #: document (row of the block), first window and windows of each run
    row: np.ndarray
    first: np.ndarray
    n: np.ndarray
    #: minimiser and sides
    entry: np.ndarray


def _cut(units: Units, texts: list) -> Cut:
    edges, held = [0], 0
    for i, text in enumerate(texts):
        if i and (units.joined is None or held + len(text) > STRETCH):
            edges.append(i)
            held = 0
        held += len(text)
    each = [_runs_of(units, texts[a:b], a) for a, b in zip(edges, [*edges[1:], len(texts)])]
    row, first, n, key, at = (np.concatenate(c) for c in zip(*each))
    del each
    sides = np.full(len(at), ANY_SIDE | ANY_SIDE << 8, np.uint64)
    if units.sides and (once := np.flatnonzero(at >= 0)).size:
        sides[once] = units.sides(texts, row[once], at[once])
    return Cut(row, first, n, key << KEY_BITS | sides)


def _beside(x: np.ndarray) -> np.ndarray:
    """Which of sorted numbers have an equal one next to them."""
    out = np.zeros(len(x), bool)
    same = x[1:] == x[:-1]
    out[1:] = same
    out[:-1] |= same
    return out


def _meeting(entries: np.ndarray) -> np.ndarray:
    """Which entries have another one with their minimiser and an equal side."""
    order = np.argsort(entries)
    at = order[_beside(entries[order] >> KEY_BITS)]
    found = entries[at]
    key, left, right = found >> KEY_BITS, found >> SIDE_BITS & SIDE, found & SIDE
    met = _beside(found >> SIDE_BITS) & (left != NO_SIDE)
    by_right = key << SIDE_BITS | right
    turned = np.argsort(by_right, kind="stable")
    met[turned] |= _beside(by_right[turned]) & (right[turned] != NO_SIDE)
    met |= _member(key, key[left == ANY_SIDE])
    out = np.zeros(len(entries), bool)
    out[at] = met
    return out


def _distinct_runs(units: Units, block: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Minimisers of a block with their sides, and how many different runs each has."""
    texts = [units.split(t) for _, t in _documents(block)]
    cut = _cut(units, texts)
    entries, back, held = np.unique(cut.entry, return_inverse=True, return_counts=True)
    again = np.flatnonzero(held[back] > 1)  # the others have one run
    seen = {
        (k, xxhash.xxh3_64_intdigest(units.packed(texts[r], a, a + m - 1 + units.width)))
        for k, r, a, m in zip(*(x[again].tolist() for x in (back, cut.row, cut.first, cut.n)))
    }
    held[back[again]] = 0
    np.add.at(held, np.fromiter((k for k, _ in seen), np.int64, len(seen)), 1)
    return entries, np.minimum(held, MOST_RUNS).astype(np.uint16)


def _distinct_minimisers(units: Units, block: pa.Table, buckets: int) -> pa.Table:
    number = block["block"][0].as_py()
    entries, held = _distinct_runs(units, block)
    bucket = (entries >> KEY_BITS) % np.uint64(buckets)
    order = np.argsort(bucket, kind="stable")
    entries, held, bucket = entries[order], held[order], bucket[order]
    edges, ends = _groups(bucket)
    keys, sides, held = key_bytes(entries >> KEY_BITS), entries.astype(np.uint16).tobytes(), held.tobytes()
    cut = lambda x, size: pa.array([x[a * size : b * size] for a, b in zip(edges.tolist(), ends.tolist())], pa.binary())
    return pa.table(
        {
            "bucket": pa.array(bucket[edges].astype(np.int64)),
            "block": pa.array([number] * len(edges), pa.int64()),
            "keys": cut(keys, KEY_BYTES),
            "sides": cut(sides, 2),
            "runs": cut(held, 2),
        }
    )


def _groups(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches of equal values."""
    edge = np.flatnonzero(np.concatenate([np.ones(min(len(x), 1), bool), x[1:] != x[:-1]]))
    return edge, np.append(edge[1:], len(x))[: len(edge)]


def _shared_minimisers(bucket: pa.Table, hot_blocks: int, hot_runs: int) -> pa.Table:
    blocks = bucket["block"].to_numpy()
    sent = bucket["keys"].to_pylist()
    ends = np.cumsum([len(k) // KEY_BYTES for k in sent])
    keys = keys_from(b"".join(sent))
    entries = keys << KEY_BITS | np.frombuffer(b"".join(bucket["sides"].to_pylist()), np.uint16).astype(np.uint64)
    shared = _meeting(entries)
    # blocks that hold a key, and its runs: a message has a key's entries one after another
    new = np.concatenate([np.ones(min(len(keys), 1), bool), keys[1:] != keys[:-1]])
    new[ends[:-1][ends[:-1] < len(keys)]] = True
    found, back = np.unique(keys, return_inverse=True)
    held = np.bincount(back, np.frombuffer(b"".join(bucket["runs"].to_pylist()), np.uint16), len(found))
    hot = ((held > hot_runs) | (np.bincount(back[new], minlength=len(found)) >= hot_blocks))[back]
    out = []
    for block, a, b in zip(blocks.tolist(), [0, *ends.tolist()], ends.tolist()):
        common, split = entries[a:b][shared[a:b]], keys[a:b][hot[a:b] & new[a:b]]
        if len(common) or len(split):
            out.append((block, common.tobytes(), key_bytes(split)))
    cols = list(zip(*out)) or [(), (), ()]
    return pa.table({c: pa.array(v, t) for (c, t), v in zip([("block", pa.int64()), ("shared", pa.binary()), ("hot", pa.binary())], cols)})


def _member(keys: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Which keys are in the sorted array ``of``."""
    if not len(of):
        return np.zeros(len(keys), bool)
    return of[np.minimum(np.searchsorted(of, keys), len(of) - 1)] == keys


@dataclass
class Travelling:
    """The distinct runs of a block that travel, by bucket and then in the order they were met."""

    strings: list
    keys: np.ndarray
    first_doc: np.ndarray
    #: buckets, and where their runs start and end
    buckets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    #: the places of all runs, run after run: number of the run, document (row of the block), first window
    run: np.ndarray
    row: np.ndarray
    first: np.ndarray


def _travelling(units: Units, docs: list, shared: np.ndarray, hot: np.ndarray, buckets: int) -> Travelling:
    texts = [units.split(t) for _, t in docs]
    cut = _cut(units, texts)
    chosen = np.flatnonzero(_member(cut.entry, shared) | _meeting(cut.entry))
    row, first, n, keys = cut.row[chosen], cut.first[chosen], cut.n[chosen], cut.entry[chosen] >> KEY_BITS
    del cut
    split = _member(keys, hot)
    if split.any():  # window by window
        times = np.where(split, n, 1)
        first = np.repeat(first, times) + _counted(times)
        row, keys, n, split = (np.repeat(x, times) for x in (row, keys, np.where(split, 1, n), split))
    number: dict[bytes, int] = {}
    strings = (units.packed(texts[r], a, e) for r, a, e in zip(row.tolist(), first.tolist(), (first + n - 1 + units.width).tolist()))
    run = np.fromiter((number.setdefault(s, len(number)) for s in strings), np.int64, len(row))
    met = np.empty(len(number), np.int64)
    met[run[::-1]] = np.arange(len(run))[::-1]  # equal strings have one minimiser; documents are in order
    strings, keys, split, first_doc = list(number), keys[met], split[met], np.array([d for d, _ in docs], np.int64)[row[met]]
    del number
    for i in np.flatnonzero(split).tolist():
        keys[i] = xxhash.xxh3_64_intdigest(strings[i]) >> 16
    bucket = (keys % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    starts, ends = _groups(bucket[order])
    return Travelling([strings[i] for i in order.tolist()], keys[order], first_doc[order], bucket[order][starts], starts, ends, place[run], row, first)


def _told(answers: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Minimisers of a block that runs of others meet, with their sides; hot minimisers."""
    shared = np.frombuffer(b"".join(x for x in answers["shared"].to_pylist() if x), np.uint64)
    hot = keys_from(b"".join(x for x in answers["hot"].to_pylist() if x))
    return np.sort(shared), np.sort(hot)


def _pack(units: Units, block: pa.Table, answers: pa.Table, buckets: int) -> pa.Table:
    rows = []
    if block.num_rows:
        squeeze = zstandard.ZstdCompressor(level=3)
        go = _travelling(units, _documents(block), *_told(answers), buckets)
        number, sizes = block["block"][0].as_py(), np.array([len(s) for s in go.strings], np.uint32)
        for bucket, a, b in zip(go.buckets.tolist(), go.starts.tolist(), go.ends.tolist()):
            about = sizes[a:b].tobytes() + go.keys[a:b].tobytes() + go.first_doc[a:b].tobytes()
            rows.append((bucket, number, b - a, squeeze.compress(b"".join(go.strings[a:b])), squeeze.compress(about)))
    cols = list(zip(*rows)) or [(), (), (), (), ()]
    types = {"bucket": pa.int64(), "block": pa.int64(), "n": pa.int64(), "packed": pa.binary(), "about": pa.binary()}
    return pa.table({c: pa.array(v, t) for (c, t), v in zip(types.items(), cols)})


def _least_holder(units: Units, strings: list, keys: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest document id for each window of all strings in turn, and the windows of each string."""
    number: dict[bytes, int] = {}
    same = np.fromiter((number.setdefault(s, len(number)) for s in strings), np.int64, len(strings))
    once = list(number)
    key = np.empty(len(once), np.uint64)
    key[same] = keys  # equal strings have one minimiser
    windows = np.array([units.size(s) for s in once], np.int64) - (units.width - 1)
    holder = np.full(len(once), NO_ID, np.int64)
    np.minimum.at(holder, same, docs)
    # windows are compared where a minimiser has several strings; alone, a string's windows have its holders
    _, back, n = np.unique(key, return_inverse=True, return_counts=True)
    open_ = n[back] > 1
    of_window = np.repeat(open_, windows)
    least = np.repeat(holder, windows)
    if open_.any():
        kind = units.classes([once[i] for i in np.flatnonzero(open_)], key[open_])
        found = np.full(int(kind.max()) + 1, NO_ID, np.int64)
        np.minimum.at(found, kind, least[of_window])
        least[of_window] = found[kind]
    start = np.cumsum(windows) - windows
    n = windows[same]
    return least[_counted(n) + np.repeat(start[same], n)], n


def _first_holders(units: Units, bucket: pa.Table) -> pa.Table:
    """For each block, the parts of its runs whose windows a smaller document id holds."""
    open_ = zstandard.ZstdDecompressor().decompress
    strings, keys, docs, origin = [], [], [], []
    for n, packed, about in zip(*(bucket[c].to_pylist() for c in ("n", "packed", "about"))):
        packed, about = open_(packed), open_(about)
        ends = np.cumsum(np.frombuffer(about, np.uint32, n)).tolist()
        strings += [packed[a:b] for a, b in zip([0, *ends], ends)]
        keys.append(np.frombuffer(about, np.uint64, n, 4 * n))
        docs.append(np.frombuffer(about, np.int64, n, 12 * n))
    keys, docs = np.concatenate(keys), np.concatenate(docs)
    least, windows = _least_holder(units, strings, keys, docs)
    doc = np.repeat(docs, windows)
    run = np.repeat(np.arange(len(strings)), windows)
    offset = _counted(windows)
    earlier = least < doc
    new = earlier & np.concatenate([[True], (run[1:] != run[:-1]) | (least[1:] != least[:-1]) | ~earlier[:-1]])
    at = np.flatnonzero(new)
    end = np.flatnonzero(earlier & np.concatenate([(run[1:] != run[:-1]) | (least[1:] != least[:-1]) | ~earlier[1:], [True]]))
    out, base = [], 0
    squeeze = zstandard.ZstdCompressor(level=3)
    for block, n in zip(bucket["block"].to_pylist(), bucket["n"].to_pylist()):
        low, high = np.searchsorted(run[at], [base, base + n])
        if high > low:
            a, e = at[low:high], end[low:high]
            body = np.stack([run[a] - base, offset[a], e - a + 1, least[a]]).astype(np.int64).tobytes()
            out.append((block, bucket["bucket"][0].as_py(), squeeze.compress(body)))
        base += n
    cols = list(zip(*out)) or [(), (), ()]
    types = {"block": pa.int64(), "bucket": pa.int64(), "parts": pa.binary()}
    return pa.table({c: pa.array(v, t) for (c, t), v in zip(types.items(), cols)})


def _removed(units: Units, docs: list, answers: pa.Table, buckets: int) -> list[list[tuple[int, int]]]:
    """Per document of a block, the unit ranges to remove: merged, by place."""
    go = _travelling(units, docs, *_told(answers), buckets)
    ids = np.array([d for d, _ in docs], np.int64)
    # in a document later than the run's first one, all of its windows are repeats
    size = np.array([units.size(s) for s in go.strings], np.int64)
    whole = np.flatnonzero(ids[go.row] > go.first_doc[go.run])
    found = [(go.row[whole], go.first[whole], go.first[whole] + size[go.run[whole]])]
    open_ = zstandard.ZstdDecompressor().decompress
    told = []
    for bucket, parts in zip(answers["bucket"].to_pylist(), answers["parts"].to_pylist()):
        if parts is not None:
            told.append(np.frombuffer(open_(parts), np.int64).reshape(4, -1).copy())
            told[-1][0] += go.starts[np.searchsorted(go.buckets, bucket)]
    if told:
        run, offset, n, least = np.concatenate(told, axis=1)
        order = np.argsort(go.run, kind="stable")
        held = np.bincount(go.run, minlength=len(go.strings))
        place = order[np.repeat((np.cumsum(held) - held)[run], held[run]) + _counted(held[run])]
        offset, n, least = (np.repeat(x, held[run]) for x in (offset, n, least))
        row, low = go.row[place], go.first[place] + offset
        later = ids[row] > least
        found.append((row[later], low[later], (low + n - 1 + units.width)[later]))
    gone: list[list[tuple[int, int]]] = [[] for _ in docs]
    for row, low, high in merged(*(np.concatenate(x) for x in zip(*found))):
        gone[row].append((low, high))
    return gone


def merged(row: np.ndarray, low: np.ndarray, high: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """The ranges of each row, by place; those that overlap or touch are one."""
    order = np.lexsort((low, row))
    row, low, high = row[order], low[order], high[order]
    apart = row << 40  # no text is as long
    reach = np.maximum.accumulate(high + apart)
    start = np.flatnonzero(np.concatenate([np.ones(min(len(row), 1), bool), (low + apart)[1:] > reach[:-1]]))
    end = np.append(start[1:], len(row))[: len(start)] - 1
    return zip(row[start].tolist(), low[start].tolist(), (reach[end] - apart[end]).tolist())


def remove_repeats(
    docs: DataFrame,
    units: Units,
    finish: Callable,
    result: str,
    *,
    id_col: str,
    text_col: str,
    block_bytes: int = BLOCK_BYTES,
    bucket_bytes: int = BUCKET_BYTES,
    hot_blocks: int = HOT_BLOCKS,
    hot_runs: int = HOT_RUNS,
) -> DataFrame:
    """Rows made by ``finish(id, text, removed ranges)``, one for each row of ``docs``."""
    total = text_bytes(docs, text_col)
    blocks, buckets = pieces_of(total, block_bytes), pieces_of(total, bucket_bytes)
    names = [c.split()[0] for c in result.split(",")]
    dealt = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).withColumn(
        "block", F.pmod(F.xxhash64("id", F.when(F.col("id").isNull(), F.col("text"))), F.lit(blocks))
    )
    shared = (
        dealt.groupBy("block")
        .applyInArrow(lambda t: _distinct_minimisers(units, t, buckets), "bucket long, block long, keys binary, sides binary, runs binary")
        .groupBy("bucket")
        .applyInArrow(lambda t: _shared_minimisers(t, hot_blocks, hot_runs), "block long, shared binary, hot binary")
    )
    holders = (
        dealt.groupBy("block")
        .cogroup(shared.groupBy("block"))
        .applyInArrow(lambda t, s: _pack(units, t, s, buckets), "bucket long, block long, n long, packed binary, about binary")
        .groupBy("bucket")
        .applyInArrow(lambda t: _first_holders(units, t), "block long, bucket long, parts binary")
    )
    answers = shared.withColumns({"bucket": F.lit(None).cast("long"), "parts": F.lit(None).cast("binary")}).unionByName(
        holders.withColumns({"shared": F.lit(None).cast("binary"), "hot": F.lit(None).cast("binary")})
    )

    def apply(block: pa.Table, told: pa.Table) -> pa.Table:
        own = _documents(block) if block.num_rows else []
        gone = _removed(units, own, told, buckets) if own else []
        rows = [finish(None if d == NO_ID else d, t, g) for (d, t), g in zip(own, gone)]
        cols = list(zip(*rows)) or [()] * len(names)
        return pa.table({c: pa.array(v, t) for (c, t), v in zip(arrow.items(), cols)})

    arrow = {f.name: f.type for f in to_arrow_schema(StructType.fromDDL(result))}
    return dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(apply, result)


def kept_ranges(size: int, gone: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    at = 0
    for a, b in gone:
        if a > at:
            yield at, a
        at = b
    if at < size:
        yield at, size
