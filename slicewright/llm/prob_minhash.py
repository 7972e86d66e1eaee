"""Near-duplicates by ProbMinHash signatures, banding and verification.

Texts are lower-cased (A-Z) and read as words; shingles are five words in a row,
weighted by how often they occur. Two texts are near-duplicates from a
probability Jaccard similarity of 0.8 on; for sets it is the plain Jaccard
similarity. Classes are what links connect; a class is named by its smallest id.

1. Texts with the same words are one; only the smallest id of each goes on, so
   copies never meet in a group.
2. A signature has 32 bands of 4 registers. A pair at 0.8 shares a band with
   probability 1 - 5e-8. In each band group all members are verified against
   the smallest id: one pair for each member.
3. Groups that this leaves in several components are taken up again. Members
   of different components whose signatures agree in at least ``MAYBE`` of the
   registers (four standard deviations below 0.8) are verified as pairs; where
   that would be many more pairs than members, inside the task, which returns
   only links that connect. A pair that shares several bands is looked at in
   the first, by the keys that groups are made by. Groups above ``CHUNK`` members are dealt out as pairs of chunks, so
   no task ever holds more than two chunks.

No link is left out but by the two probabilities named, and nothing is capped.

Defined results: a text without a word (NULL, empty, white space) is a class of
its own; fewer than five words are one shingle; a NULL id has a NULL class;
rows that repeat an id share a class, also where their texts differ, as the id connects them.
Every input row gives one row. Texts are told apart by id and digest throughout.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slicewright.llm.common import lasts_a_stage, saved, small_slices
from slicewright.llm.components import components
from slicewright.llm.ordering import numbered
from slicewright.llm.window_exchange import mixed

SIMILARITY, MAYBE = 0.8, 0.65
CHUNK = 1_024
#: Pairs for each member of a group up to which they travel as rows.
SPARSE = 4

SHINGLE = 5
BANDS, ROWS = 32, 4
REGISTERS = BANDS * ROWS
STEP = np.uint64(0x9E3779B97F4A7C15)
#: Word hashes that a worker remembers before it starts afresh.
MEMORY = 60_000
#: Text that a worker signs at once.
SIGN_BYTES = 1 << 19
#: Distinct shingles of the texts that a worker holds while it verifies pairs.
HELD = 1_000_000


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


HASHES = WordHashes()
lasts_a_stage(HASHES.clear)


def shingle_weights(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles, in rising order, and how often each occurs."""
    if len(HASHES) > MEMORY:
        HASHES.clear()
    h = np.fromiter(map(HASHES.__getitem__, words), np.uint64, len(words))
    n = min(SHINGLE, len(h))
    x = h[: len(h) - n + 1]
    for j in range(1, n):
        x = x * STEP + h[j : len(h) - n + 1 + j]
    return np.unique(mixed(x), return_counts=True)


def signatures(sets: list[tuple[np.ndarray, np.ndarray]], registers: int = REGISTERS) -> np.ndarray:
    """A row of ``registers`` shingle hashes for each weighted set.

    Every shingle is a Poisson process whose rate is its weight; each arrival
    falls into a random register, which keeps the shingle that came first. All
    sets advance together by one arrival of each shingle; a shingle stops once
    its last arrival came after every register of its set was reached, as no
    later one can change them. Two registers agree with the probability Jaccard
    similarity of their sets.
    """
    size = np.array([len(e) for e, _ in sets], np.int64)
    best = np.full(len(sets) * registers, np.inf)
    out = np.zeros(len(sets) * registers, np.uint64)
    if not size.sum():
        return out.reshape(len(sets), registers)
    row = np.repeat(np.arange(len(sets)), size)
    element = np.concatenate([e for e, _ in sets])
    rate = np.concatenate([w for _, w in sets]).astype(np.float64)
    clock = np.zeros(len(element))
    arrival = 0
    while len(element):
        arrival += 1
        r = mixed(element + np.uint64(arrival * int(STEP) % 2**64))
        clock = clock - np.log(((r >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / rate
        at = row * registers + (mixed(r) % np.uint64(registers)).astype(np.int64)
        np.minimum.at(best, at, clock)
        first = clock == best[at]
        out[at[first]] = element[first]
        go = clock < best.reshape(len(sets), registers).max(1)[row]
        row, element, rate, clock = row[go], element[go], rate[go], clock[go]
    return out.reshape(len(sets), registers)


def band_keys(signature: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """A key for each band of each signature; the band's number is part of it."""
    parts = signature.reshape(len(signature), bands, signature.shape[1] // bands)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * STEP, parts.shape[:2]).copy()
    for j in range(parts.shape[2]):
        key = mixed(key ^ parts[:, :, j])
    return key.view(np.int64)


def probability_jaccard(a: tuple, b: tuple) -> float:
    """Exact probability Jaccard similarity of two weighted sets.

    A shared shingle i counts 1 / sum over j of max(x_j / x_i, y_j / y_i); in the
    order of x_j / y_j these sums are prefix sums.
    """
    every = np.union1d(a[0], b[0])
    if not len(every):
        return 0.0
    x, y = np.zeros(len(every)), np.zeros(len(every))
    x[np.searchsorted(every, a[0])] = a[1]
    y[np.searchsorted(every, b[0])] = b[1]
    with np.errstate(divide="ignore"):
        ratio = x / y
    order = np.argsort(ratio, kind="stable")
    x, y = x[order], y[order]
    xs, ys = x.sum() - np.concatenate([[0.0], np.cumsum(x)[:-1]]), np.concatenate([[0.0], np.cumsum(y)[:-1]])
    both = (x > 0) & (y > 0)
    return float((1.0 / (xs[both] / x[both] + ys[both] / y[both])).sum())


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "replace").lower().split() if text else []


def sign(docs: DataFrame) -> DataFrame:
    """``id``, ``digest`` of the words (NULL for none); ``bands`` and ``sketch`` once for each digest of a slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_slices(batches, "text", SIGN_BYTES):
            ids = batch["id"].to_pylist()
            sets, digests, holder = {}, [], {}
            for row, text in enumerate(batch["text"].to_pylist()):
                words = words_of(text)
                digest = xxhash.xxh3_128_digest(b" ".join(words)) if words else None
                digests.append(digest)
                if digest is not None and ids[row] is not None:
                    if digest not in holder or ids[row] < ids[holder[digest]]:
                        holder[digest] = row
                    if digest not in sets:
                        sets[digest] = shingle_weights(words)
            own = signatures(list(sets.values()))
            keys = dict(zip(sets, band_keys(own).tolist()))
            sketch = dict(zip(sets, own.astype(np.uint8)))
            first = {row: digest for digest, row in holder.items()}
            yield pa.RecordBatch.from_arrays(
                [
                    batch["id"],
                    pa.array(digests, pa.binary()),
                    pa.array([keys[first[r]] if r in first else None for r in range(len(ids))], pa.list_(pa.int64())),
                    pa.array([sketch[first[r]].tobytes() if r in first else None for r in range(len(ids))], pa.binary()),
                ],
                names=["id", "digest", "bands", "sketch"],
            )

    return docs.mapInArrow(run, "id long, digest binary, bands array<long>, sketch binary")


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs ``a``, ``b`` whose texts are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets: dict = {}
            keep, held = [], 0
            for a, b, x, y in zip(*(batch[c] for c in ("a", "b", "x", "y"))):
                a, b = a.as_py(), b.as_py()
                for i, t in ((a, x), (b, y)):
                    if i not in sets:
                        if held > HELD:
                            sets = {k: sets[k] for k in (a, b) if k in sets}
                            held = sum(len(e) for e, _ in sets.values())
                        sets[i] = shingle_weights(words_of(t.as_py()))
                        held += len(sets[i][0])
                keep.append(probability_jaccard(sets[a], sets[b]) >= SIMILARITY)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    x = texts.select(F.col("id").alias("a"), F.col("text").alias("x"))
    y = texts.select(F.col("id").alias("b"), F.col("text").alias("y"))
    return pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def _maybe(unit: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids and components of a unit, and its pairs (places) to look at more closely."""
    unit = unit.take(pa.compute.sort_indices(unit["id"]))
    ids, comp, chunk = (unit[c].to_numpy() for c in ("id", "comp", "chunk"))
    band, across = unit["band"][0].as_py(), unit["ci"][0].as_py() != unit["cj"][0].as_py()
    sketch = np.frombuffer(b"".join(unit["sketch"].to_pylist()), np.uint8).reshape(len(ids), -1)
    keys = pa.compute.list_flatten(unit["bands"]).to_numpy().reshape(len(ids), -1)
    left, right = [], []
    for low in range(0, len(ids), 64):
        for start in range(low, len(ids), 512):
            a, b = slice(low, low + 64), slice(start, start + 512)
            good = comp[a, None] != comp[None, b]
            if across:
                good &= chunk[a, None] != chunk[None, b]
            good &= np.arange(len(ids))[a, None] < np.arange(len(ids))[None, b]
            if not good.any():
                continue
            good &= (sketch[a, None, :] == sketch[None, b, :]).mean(2) >= MAYBE
            x, y = np.nonzero(good)
            x, y = x + low, y + start
            # the keys that groups are made by, as bytes alone may agree in a band that is not shared
            first = np.concatenate([(keys[x[i : i + 4_096]] == keys[y[i : i + 4_096]]).argmax(1) for i in range(0, len(x), 4_096)] or [x])
            left.append(x[first >= band])
            right.append(y[first >= band])
    none = np.zeros(0, np.int64)
    return ids, comp, np.concatenate([none, *left]), np.concatenate([none, *right])


def _look(unit: pa.Table) -> pa.Table:
    """Pairs to verify or, where these are many, the members to verify among themselves (``b`` NULL)."""
    ids, _, left, right = _maybe(unit)
    if len(left) <= SPARSE * len(ids):
        a, b = ids[left].tolist(), ids[right].tolist()
    else:
        a = ids[np.unique(np.concatenate([left, right]))].tolist()
        b = [None] * len(a)
    same = {c: pa.array([unit[c][0].as_py()] * len(a), unit.schema.field(c).type) for c in ("key", "ci", "cj")}
    return pa.table(same | {"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _connect(unit: pa.Table) -> pa.Table:
    """Links between components of a dense unit, as many as connect them."""
    sets = {i: t for i, t in zip(unit["id"].to_pylist(), unit["text"].to_pylist())}
    ids, comp, left, right = _maybe(unit.drop_columns(["text"]))
    weights = [shingle_weights(words_of(sets[i])) for i in ids.tolist()]
    up = {c: c for c in comp.tolist()}

    def top(c: int) -> int:
        while up[c] != c:
            up[c] = c = up[up[c]]
        return c

    out = []
    for x, y in zip(left.tolist(), right.tolist()):
        c, d = top(int(comp[x])), top(int(comp[y]))
        if c != d and probability_jaccard(weights[x], weights[y]) >= SIMILARITY:
            up[c] = d
            out.append((int(ids[x]), int(ids[y])))
    a, b = zip(*out) if out else ((), ())
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _between(groups: DataFrame, links: DataFrame, sketches: DataFrame, texts: DataFrame, chunk: int) -> DataFrame:
    """Links between components that share a band group."""
    part = groups.join(components(links), "id", "left").withColumn("comp", F.coalesce("comp", "id"))
    open_ = part.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.count("*").alias("n"))
    open_ = open_.where("low < high").select("key", F.ceil(F.col("n") / chunk).cast("int").alias("chunks"))
    own = F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int")
    rows = part.join(open_, "key").withColumn("chunk", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    units = saved(
        rows.select("key", "band", "id", "comp", "chunk", F.least("chunk", "other").alias("ci"), F.greatest("chunk", "other").alias("cj")),
        "near-units",
    )
    unit = ["key", "ci", "cj"]
    drawn = units.join(sketches, "id")
    found = saved(drawn.groupBy(*unit).applyInArrow(_look, "key long, ci int, cj int, a long, b long"), "near-pairs")
    pairs = verified(found.where("b IS NOT NULL").select("a", "b").distinct(), texts)
    dense = found.where("b IS NULL").select(*unit, F.col("a").alias("id"))
    inside = drawn.join(dense, [*unit, "id"]).join(texts, "id").groupBy(*unit).applyInArrow(_connect, "a long, b long")
    return pairs.unionAll(inside)


def with_digest(rows: DataFrame, text: str, name: str) -> DataFrame:
    """``rows``, all columns, and as ``name`` the digest that ``sign`` gives their text."""
    schema = T.StructType([*rows.schema.fields, T.StructField(name, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_slices(batches, text):
            words = map(words_of, batch[text].to_pylist())
            digests = [xxhash.xxh3_128_digest(b" ".join(w)) if w else None for w in words]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(digests, pa.binary())], names=schema.fieldNames())

    return rows.mapInArrow(run, schema)


def linked(rows: DataFrame, chunk: int = CHUNK) -> tuple[DataFrame, DataFrame, DataFrame]:
    """From ``id``, ``text``: the signed rows, the distinct texts and their classes.

    A text (``digest``) is known by the smallest id that has it, ``rep``, and its ``place`` in the order of
    (rep, digest), so that an id with several texts has a place for each.  Classes are ``place`` and ``comp``,
    the smallest place of the class, for texts that have a near-duplicate.
    """
    signed = saved(sign(rows), "signatures")
    copies = signed.where("digest IS NOT NULL AND id IS NOT NULL").groupBy("digest").agg(F.min("id").alias("rep"))
    copies = saved(numbered(copies, [], [F.col("rep").asc(), F.col("digest").asc()]), "texts")
    own = signed.where("bands IS NOT NULL").withColumnRenamed("id", "rep")
    signs = own.join(copies, ["rep", "digest"]).select(F.col("place").alias("id"), "bands", "sketch")
    keys = signs.select("id", F.posexplode("bands").alias("band", "key"))
    leaders = keys.groupBy("key").agg(F.min("id").alias("leader"), F.count("*").alias("n")).where("n > 1")
    groups = saved(keys.join(leaders.drop("n"), "key"), "band-groups")
    members = copies.join(groups.select(F.col("id").alias("place")).distinct(), "place")
    found = with_digest(rows.withColumnRenamed("id", "rep"), "text", "digest").join(members, ["rep", "digest"])
    texts = saved(found.dropDuplicates(["rep", "digest"]).select(F.col("place").alias("id"), "text"), "near-texts")
    star = groups.where("id <> leader").select(F.col("leader").alias("a"), F.col("id").alias("b")).distinct()
    links = saved(verified(star, texts), "near-links")
    sketches = signs.select("id", "sketch", "bands").dropDuplicates(["id"])
    more = saved(_between(groups.drop("leader"), links, sketches, texts, chunk), "near-links")
    return signed, copies, saved(links.unionAll(more), "near-links")


def _of_class(copies: DataFrame, links: DataFrame) -> DataFrame:
    """``digest`` and ``class_id``, the smallest id of the class, of every distinct text."""
    comps = components(links).select(F.col("id").alias("place"), "comp")
    named = copies.join(comps, "place", "left").withColumn("comp", F.coalesce("comp", "place"))
    first = copies.select(F.col("place").alias("comp"), F.col("rep").alias("class_id"))
    return named.join(first, "comp").select("digest", "class_id", (F.col("comp") == F.col("place")).alias("leads"))


def classes(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK) -> DataFrame:
    """``id_col`` and ``class_id`` of each row."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    signed, copies, links = linked(rows, chunk)
    # an id with several texts connects them
    placed = signed.where("id IS NOT NULL").select("id", "digest").join(copies, "digest")
    several = placed.groupBy("id").agg(F.min("place").alias("a"), F.max("place").alias("z")).where("a < z")
    same = placed.join(several, "id").where("place > a").select("a", F.col("place").alias("b"))
    named = saved(_of_class(copies, links.unionAll(same)), "near-classes")
    with_text = signed.select("id", "digest").where("id IS NOT NULL AND digest IS NOT NULL").join(named, "digest").select("id", "class_id")
    bare = signed.where("id IS NULL OR digest IS NULL").select("id")
    of_id = with_text.join(bare.distinct(), "id", "left_semi").distinct()  # rows of an id have one class
    rest = bare.join(of_id, "id", "left").select("id", F.coalesce("class_id", "id").alias("class_id"))
    return with_text.unionAll(rest).withColumnRenamed("id", id_col)


def first_of_each_class(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK) -> DataFrame:
    """The rows of ``docs``, with all their columns, that are the first of their near-duplicate class: the row with the
    smallest id, then digest of the words; of rows alike in both the first in the order of text.  Rows without
    an id or a word stay.  An id with several texts is judged by each of them.

    One shuffle of the rows, by id and digest; those that stay anyway are not in it.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    digest = "_digest"
    while any(c.startswith(digest) for c in docs.columns):
        digest += "_"
    _, copies, links = linked(rows, chunk)
    lead = _of_class(copies, links).where("leads").select(F.col("digest").alias(f"{digest}_led"), F.col("class_id").alias(f"{digest}_id"))
    marked = with_digest(docs, text_col, digest)
    no_group = F.col(id_col).isNull() | F.col(digest).isNull()
    same = (F.col(id_col).cast("long") == F.col(f"{digest}_id")) & (F.col(digest) == F.col(f"{digest}_led"))
    firsts = marked.where(~no_group).join(saved(lead, "near-leads").hint("merge"), same).drop(f"{digest}_id", f"{digest}_led")
    turn = f"{digest}_turn"
    again = Window.partitionBy(F.col(id_col).cast("long"), digest).orderBy(text_col)
    firsts = firsts.withColumn(turn, F.row_number().over(again)).where(F.col(turn) == 1)
    return firsts.select(docs.columns).unionAll(marked.where(no_group).select(docs.columns))
