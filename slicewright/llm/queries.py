"""Queries over the test tables, one per operator, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slicewright.llm import (
    decontamination,
    lattice_scoring,
    merge_coding,
    merkle_manifest,
    pii,
    prob_minhash,
    rank_profiles,
    robust_outliers,
    source_mix,
    spelling_variants,
    suffix_refinement,
    super_kmers,
    toxicity,
)
from slicewright.llm.common import fold, saved, send_package, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(run)
    def sent(spark: SparkSession, sf_dir: str) -> DataFrame:
        send_package(spark)
        return run(spark, sf_dir)

    QUERIES[run.__name__] = sent
    return sent


@query
def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document, as digests."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    coded = merge_coding.encode_decode(table(spark, sf_dir, "documents"), model)
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by the profiles of the learning folds."""
    docs = table(spark, sf_dir, "documents")
    profiles = rank_profiles.learn(docs.where(fold(F.col("doc_id")) != 0))
    return rank_profiles.predict(docs, profiles).select(
        "doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "lang_pred", "score"
    )


@query
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a passage of at least 0.8 similarity to a benchmark item."""
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 50-byte strings of smaller ids."""
    out = suffix_refinement.remove_repeated_bytes(table(spark, sf_dir, "documents"))
    return out.withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")


@query
def op9_super_kmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 50-word windows of smaller ids."""
    out = super_kmers.remove_repeated_words(table(spark, sf_dir, "documents"))
    return out.withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")


@query
def op3_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lattice and word-unigram score of every document."""
    held_out = F.coalesce(fold(F.col("doc_id")) == 1, F.lit(False))
    model = public_tokenizers.path("piece_bpe_32k.model")
    scored = lattice_scoring.score_documents(table(spark, sf_dir, "documents"), model, ~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labels of the learning folds."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = toxicity.score(docs, labels, fold(F.col("doc_id")) != 0)
    return scored.select(
        "doc_id",
        (fold(F.col("doc_id")) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query
def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document."""
    return prob_minhash.classes(table(spark, sf_dir, "documents"))


@query
def op1_robust_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts of every document, and whether its statistics are within reach of its group's."""
    return robust_outliers.judge(table(spark, sf_dir, "documents"))


@query
def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data in every document."""
    found = pii.find_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        *(pii.count_of(k).alias(f"n_{k}") for k in pii.BASE),
        F.sha2(pii.as_text("base"), 256).alias("base_sha256"),
        pii.as_text("spans").alias("spans"),
    )


@query
def op11_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words taken of every document by the mix, with its source's size and target."""
    docs = table(spark, sf_dir, "documents")
    taken, sources = source_mix.mix(docs, source_mix.word_count(F.col("text")), F.array("source"))
    own = F.col("parts")[0]["source"].eqNullSafe(F.col("source"))
    return taken.join(sources, own).select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


@query
def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near words, form and root of every word of the documents."""
    words = saved(spelling_variants.counted_words(table(spark, sf_dir, "documents")), "words")
    return spelling_variants.grouped_variants(words)


@query
def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, subroot, root and proof of every document, and what the proof of a tampered one folds to."""
    names = ("doc_id", "source", "lang", "n_chars", "text")
    more = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    out = merkle_manifest.manifest(
        table(spark, sf_dir, "documents"), {n: F.col(n) for n in names}, group="lang", order="doc_id", changed={"n_chars": more}
    )
    out = out.withColumn("folded_root", merkle_manifest.folded(F.col("changed_leaf"), F.col("sides"), F.col("proof")))
    return out.select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )


ORACLES["op5_suffix_dedup"] = """
WITH b AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
win AS (SELECT doc_id, i, substr(h, 2 * i - 1, 100) AS s FROM b, unnest(range(1, length(h) // 2 - 48)) t(i)),
firsts AS (SELECT s, min(doc_id) AS d FROM win GROUP BY s HAVING count(*) > 1),
hit AS (SELECT w.doc_id, w.i FROM win w JOIN firsts f ON f.s = w.s WHERE f.d < w.doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS k FROM hit),
runs AS (SELECT doc_id, k, k - row_number() OVER (PARTITION BY doc_id ORDER BY k) AS r FROM gone),
spans AS (SELECT doc_id, min(k) AS a, max(k) AS z FROM runs GROUP BY doc_id, r),
pieces AS (
SELECT doc_id, a, z, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM spans),
kept AS (
SELECT doc_id, string_agg(substr(h, 2 * before + 1, 2 * (a - 1 - before)), '' ORDER BY a) AS head,
       max(z) AS z, count(*) AS n_spans, sum(z - a + 1) AS n FROM pieces JOIN b USING (doc_id) GROUP BY doc_id)
SELECT b.doc_id, CAST(length(b.h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(concat(coalesce(head, ''), substr(b.h, 2 * coalesce(z, 0) + 1)))) AS kept_sha256
FROM b LEFT JOIN kept USING (doc_id)"""

ORACLES["op9_super_kmers"] = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (
SELECT doc_id, i, array_to_string(ws[i:i + 49], ' ') AS s FROM w, unnest(range(1, len(ws) - 48)) t(i)),
firsts AS (SELECT s, min(doc_id) AS d FROM win GROUP BY s HAVING count(*) > 1),
hit AS (SELECT w.doc_id, w.i FROM win w JOIN firsts f ON f.s = w.s WHERE f.d < w.doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS k FROM hit),
word AS (SELECT doc_id, k, ws[k] AS c FROM w, unnest(range(1, len(ws) + 1)) t(k)),
kept AS (
SELECT doc_id, string_agg(c, ' ' ORDER BY k) AS t, count(*) AS n FROM word ANTI JOIN gone USING (doc_id, k) GROUP BY 1)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(kept.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)"""

_FIELD = "coalesce(concat(strlen(CAST({0} AS VARCHAR)), ':', {0}), '-')"
_LEAF = "sha256(concat(" + ", ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "{0}", "text")) + "))"
#: Unsigned crc32 of a list of bytes, bit by bit.
_CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295, {0}),
lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)),
lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)))"""
_DIGITS = "list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))"

ORACLES["op13_merkle"] = f"""
WITH RECURSIVE
leaves AS (
SELECT doc_id, coalesce('=' || lang, '') AS tree, {_LEAF.format("n_chars")} AS leaf,
       {_LEAF.format(f"(CASE WHEN {_CRC32.format(_DIGITS)} % 7 = 0 THEN n_chars + 1 ELSE n_chars END)")} AS changed
FROM documents),
placed AS (
SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
       count(*) OVER (PARTITION BY tree) AS n FROM leaves),
up AS (
SELECT tree, 0 AS level, pos, n, leaf AS h FROM placed
UNION ALL
SELECT tree, level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM up
WHERE n > 1 GROUP BY tree, level, pos // 2, n),
subs AS (SELECT tree, h, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM up WHERE n = 1),
top AS (
SELECT 0 AS level, pos, n, h FROM subs
UNION ALL
SELECT level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM top
WHERE n > 1 GROUP BY level, pos // 2, n),
within AS (
SELECT doc_id, tree, leaf, changed AS f, '' AS proof, 0 AS level, pos, n FROM placed
UNION ALL
SELECT w.doc_id, w.tree, w.leaf,
       sha256(CASE WHEN s.h IS NULL THEN w.f WHEN w.pos % 2 = 1 THEN s.h || w.f ELSE w.f || s.h END),
       w.proof || coalesce(s.h, ''), w.level + 1, w.pos // 2, (w.n + 1) // 2
FROM within w LEFT JOIN up s ON s.tree = w.tree AND s.level = w.level AND s.pos = xor(w.pos, 1) WHERE w.n > 1),
over_all AS (
SELECT w.doc_id, w.leaf, s.h AS subroot, w.f, w.proof, 0 AS level, s.pos, s.n FROM within w JOIN subs s USING (tree) WHERE w.n = 1
UNION ALL
SELECT w.doc_id, w.leaf, w.subroot,
       sha256(CASE WHEN s.h IS NULL THEN w.f WHEN w.pos % 2 = 1 THEN s.h || w.f ELSE w.f || s.h END),
       w.proof || coalesce(s.h, ''), w.level + 1, w.pos // 2, (w.n + 1) // 2
FROM over_all w LEFT JOIN top s ON s.level = w.level AND s.pos = xor(w.pos, 1) WHERE w.n > 1)
SELECT doc_id, leaf, subroot, top.h AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = top.h AS verified
FROM over_all o JOIN top ON top.n = 1 WHERE o.n = 1"""

ORACLES["op11_mix"] = r"""
WITH sized AS (
SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
src AS (
SELECT source, CAST(sum(size) AS BIGINT) AS s, [5.0::DOUBLE, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w
FROM sized GROUP BY source),
state AS (
SELECT *, sum(s) OVER () * 1.5::DOUBLE - coalesce(sum(2.0::DOUBLE * s) OVER earlier, 0) AS room, sum(w) OVER () - coalesce(sum(w) OVER earlier, 0) AS weight
FROM src WINDOW earlier AS (ORDER BY s / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
judged AS (SELECT *, room * w / weight > 2 * s AS capped FROM state),
open AS (SELECT max(weight) AS weight, min(room) FILTER (weight = (SELECT max(weight) FROM judged WHERE NOT capped)) AS room FROM judged WHERE NOT capped),
aimed AS (
SELECT source, s, CASE WHEN capped THEN 2.0::DOUBLE * s ELSE (SELECT room FROM open) * w / (SELECT weight FROM open) END AS target FROM judged),
line AS (
SELECT doc_id, size, s, target, CAST(floor(target + 0.5) AS BIGINT) AS f,
       CAST(sum(size) OVER (PARTITION BY sized.source ORDER BY sha256(concat('mix:', doc_id)), doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING) AS BIGINT) - size AS b
FROM sized JOIN aimed ON aimed.source IS NOT DISTINCT FROM sized.source)
SELECT doc_id, size, s AS source_size, target,
       CAST(greatest(0, least(b + size, f) - b) + greatest(0, least(s + b + size, f) - s - b) AS BIGINT) AS taken
FROM line"""

_BYTES = "list_transform(range(1, strlen(s) + 1), lambda i: CAST(concat('0x', hex(encode(s))[2 * i - 1:2 * i]) AS BIGINT))"

ORACLES["op12_spelling"] = f"""
WITH RECURSIVE
run AS (
SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS d, translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS r, count(*) AS c
FROM documents, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) t(w) WHERE length(w) >= 5 GROUP BY ALL),
marked AS (SELECT r, c, {_CRC32.format(_BYTES)} AS h FROM (SELECT *, concat(d, ':', r) AS s FROM run)),
word AS (
SELECT w, CAST(sum(c) AS BIGINT) AS n FROM (
SELECT CASE WHEN h % 97 = 0 THEN substr(r, 1, h % length(r)) || substr(r, h % length(r) + 2) ELSE r END AS w, c FROM marked)
WHERE length(w) >= 5 GROUP BY w HAVING sum(c) >= 3),
less AS (SELECT w, n, i, substr(w, 1, i - 1) || substr(w, i + 1) AS v FROM word, unnest(range(1, length(w) + 1)) t(i)),
pair AS (
SELECT a.w, b.w AS o, b.n AS o_n FROM less a JOIN less b ON a.v = b.v AND a.i = b.i AND a.w <> b.w
UNION SELECT l.w, b.w, b.n FROM less l JOIN word b ON l.v = b.w
UNION SELECT b.w, l.w, l.n FROM less l JOIN word b ON l.v = b.w),
best AS (
SELECT w, count(*) AS n_near, first(o ORDER BY o_n DESC, o) AS o, max(o_n) AS o_n FROM pair GROUP BY w),
formed AS (
SELECT word.w, n, coalesce(n_near, 0) AS n_near, CASE WHEN o_n >= 2 * n THEN o END AS form, CASE WHEN o_n >= 2 * n THEN o_n END AS form_n
FROM word LEFT JOIN best USING (w)),
path AS (
SELECT w, w AS at FROM formed
UNION ALL SELECT p.w, f.form FROM path p JOIN formed f ON f.w = p.at WHERE f.form IS NOT NULL)
SELECT f.w AS word, f.form, p.at AS root, f.n, CAST(f.n_near AS BIGINT) AS n_near, f.form_n
FROM formed f JOIN path p ON p.w = f.w JOIN formed e ON e.w = p.at AND e.form IS NULL"""

QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
