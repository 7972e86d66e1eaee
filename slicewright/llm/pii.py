"""Personal data: fixed patterns, and more spans by weak supervision.

The patterns (``BASE``) always count. Further candidates, written-out addresses,
groups of digits and long tokens, are judged by labelers that vote for, against
or not at all: a pattern for the shape, a gazetteer of prefixes and units, the
words before, the signs around, and the variety of characters. Expectation
maximisation over the counts of vote patterns estimates how reliable each
labeler is, without labels; the resulting probabilities train a logistic
regression over the votes, the kind and the length, which is the final span
classifier. What leaves the tasks for this are counts of vote patterns, at most
``3 ** 5`` for each kind and length class.

Positions come from the pieces between matches, so a pattern is run on the whole
text and nothing is searched twice. All steps are column expressions.

Defined results: a NULL text is empty; matches that fail their check are dropped
without another try; a candidate inside a base span is not reported
again; without candidates only the base spans count; repeated rows give repeated
results. Only the named columns are read.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slicewright.llm.common import saved

# The base patterns. Runs are taken whole (possessive), and may start only where
# a run starts or a match has ended, which finds the same matches in linear time.
LOCAL, DOMAIN = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
BASE = {
    "email": rf"(?:(?<!{LOCAL})|\G){LOCAL}++@{DOMAIN}++(?:\.{DOMAIN}++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}+",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){11,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
NEEDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][ -]?[0-9]", "phone": r"\+[0-9]"}
BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"

# Candidates beyond the base patterns, by kind.
MORE = {
    "contact": rf"(?<!{LOCAL}){LOCAL}++ ?[(\[]at[)\]] ?{DOMAIN}++(?:(?:\.| ?[(\[]dot[)\]] ?){DOMAIN}++)++",
    "number": r"(?<![0-9A-Za-z+.(-])\(?[0-9][0-9() -]{6,40}[0-9](?![0-9A-Za-z])",
    "secret": r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*+[0-9])(?=[0-9+/_=-]*+[A-Za-z])[A-Za-z0-9+/_=-]{16,}+",
}
MORE_NEEDS = {"contact": r"[(\[]at[)\]]", "number": "[0-9][0-9() -]{6}", "secret": "[0-9]"}
KINDS = [*BASE, *MORE]

# Shapes, gazetteers and words that the labelers know.
SHAPE_FOR = r"^\(?[0-9]{3}\)?[ -][0-9]{3}[ -][0-9]{4}$|^[0-9]{3}-[0-9]{2}-[0-9]{4}$|^[0-9a-fA-F]{32,}$|[(\[]at[)\]]|^[A-Za-z0-9+/_-]{32,}={0,2}$"
SHAPE_AGAINST = r"^(?:19|20)[0-9]{2}[ -]+(?:19|20)?[0-9]{2}|^[0-9]{4}-[0-9]{2}-[0-9]{2}|^(.)\1*$|^[A-Za-z]+(?:[-_/=][A-Za-z]+)*[0-9]{0,2}$"
GAZETTEER_FOR = r"^(?:sk|pk|ghp|gho|xox[abp]|AKIA|ASIA|AIza|eyJ)|(?:gmail|yahoo|hotmail|outlook|example|mail)|^(?:DE|FR|ES|GB|IT|NL)[0-9]{2}"
GAZETTEER_AGAINST = r"^\s?(?:kg|km|cm|mm|g|m|%|eur|usd|euros?|dollars?|years?|items?|pages?)\b"
WORDS_FOR = r"(?i)(?:token|secret|key|password|passwd|pwd|auth|bearer|phone|tel|call|fax|mobile|e-?mail|contact|ssn|social security|passport|account|iban|card|visa)\W{0,6}\w{0,8}\W{0,6}$"
WORDS_AGAINST = r"(?i)(?:isbn|issn|doi|version|page|pages|chapter|commit|sha|md5|hash|figure|table|from|since|between)\W{0,6}$"
LABELERS = ["shape", "gazetteer", "words", "signs", "variety"]

CONTEXT = 40
ROUNDS = 25


def matches(text: str, pattern: str, needs: str) -> tuple[Column, Column]:
    """Pieces between the matches of a pattern, and the matches."""
    quoted = pattern.replace("'", "\\'")
    present = F.col(text).rlike(needs)
    none = F.array().cast("array<string>")
    gaps = F.when(present, F.expr(f"split(`{text}`, r'{quoted}', -1)")).otherwise(none)
    found = F.when(present, F.expr(f"regexp_extract_all(`{text}`, r'{quoted}', 0)")).otherwise(none)
    return gaps, found


def positions(gaps: Column, found: Column) -> Column:
    """Array of (start, end, match), in code points, end exclusive."""
    rows = F.arrays_zip(gaps.alias("gap"), found.alias("hit"))
    empty = F.array().cast("array<struct<start:int,end:int,hit:string>>")
    step = lambda a, x: F.struct(
        (a["at"] + F.length(x["gap"]) + F.coalesce(F.length(x["hit"]), F.lit(0))).alias("at"),
        F.when(
            x["hit"].isNotNull(),
            F.concat(
                a["spans"],
                F.array(
                    F.struct(
                        (a["at"] + F.length(x["gap"])).alias("start"),
                        (a["at"] + F.length(x["gap"]) + F.length(x["hit"])).alias("end"),
                        x["hit"].alias("hit"),
                    )
                ),
            ),
        )
        .otherwise(a["spans"])
        .alias("spans"),
    )
    return F.when(F.size(found) == 0, empty).otherwise(
        F.aggregate(rows, F.struct(F.lit(0).alias("at"), empty.alias("spans")), step, lambda a: a["spans"])
    )


def digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def valid(kind: str, hit: Column) -> Column:
    """Whether a match passes the check of its kind."""
    if kind == "ip":
        return hit.rlike(rf"^{BYTE}(?:\.{BYTE}){{3}}$")
    if kind == "card":
        return F.call_function("luhn_check", digits(hit)) & F.length(digits(hit)).between(12, 19)
    if kind == "phone":
        return F.length(digits(hit)).between(9, 15)
    return F.lit(True)


def _checked(number: int, kind: str) -> Column:
    passed = F.filter(f"_{kind}", lambda s: valid(kind, s["hit"]))
    return F.transform(passed, lambda s: F.struct(s["start"].alias("start"), F.lit(number).alias("kind"), s["end"].alias("end")))


def with_base(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` and ``base``: array of (start, kind number, end) of the base spans, in order."""
    for kind, pattern in BASE.items():
        gaps, found = matches(text, pattern, NEEDS[kind])
        docs = docs.withColumns({f"_g_{kind}": gaps, f"_f_{kind}": found})
    docs = docs.withColumns({f"_{kind}": positions(F.col(f"_g_{kind}"), F.col(f"_f_{kind}")) for kind in BASE})
    spans = [_checked(k, kind) for k, kind in enumerate(BASE)]
    drop = [f"{p}{kind}" for kind in BASE for p in ("_g_", "_f_", "_")]
    return docs.withColumn("base", F.sort_array(F.concat(*spans))).drop(*drop)


def _vote(for_: Column, against: Column) -> Column:
    return F.when(for_, 1).when(against, -1).otherwise(0)


def with_candidates(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` and ``more``: array of candidates with kind number, place, length class and votes."""
    for kind, pattern in MORE.items():
        gaps, found = matches(text, pattern, MORE_NEEDS[kind])
        docs = docs.withColumns({f"_g_{kind}": gaps, f"_f_{kind}": found})
    docs = docs.withColumns({f"_{kind}": positions(F.col(f"_g_{kind}"), F.col(f"_f_{kind}")) for kind in MORE})

    def candidate(s: Column, k: int) -> Column:
        hit = s["hit"]
        first = F.greatest(s["start"] - CONTEXT, F.lit(0))
        before = F.substring(F.col(text), first + 1, s["start"] - first)
        after = F.substring(F.col(text), s["end"] + 1, F.lit(12))
        variety = F.size(F.array_distinct(F.split(hit, "")))
        return F.struct(
            s["start"].alias("start"),
            F.lit(k).alias("kind"),
            s["end"].alias("end"),
            F.least(F.floor(F.length(hit) / 8), F.lit(7)).cast("int").alias("size"),
            _vote(hit.rlike(SHAPE_FOR), hit.rlike(SHAPE_AGAINST)).alias("shape"),
            _vote(hit.rlike(GAZETTEER_FOR), after.rlike(GAZETTEER_AGAINST)).alias("gazetteer"),
            _vote(before.rlike(WORDS_FOR), before.rlike(WORDS_AGAINST)).alias("words"),
            _vote(before.rlike(r"[=:]\s*[\"']?$"), before.rlike(r"[/\\.]$") | after.rlike(r"^[/\\]")).alias("signs"),
            _vote(variety >= 8, variety <= 4).alias("variety"),
        )

    free = lambda s: ~F.exists("base", lambda b: (b["start"] <= s["start"]) & (s["end"] <= b["end"]))

    def judged(k: int, kind: str) -> Column:
        return F.transform(F.filter(f"_{kind}", free), lambda s: candidate(s, k))

    parts = [judged(k, kind) for k, kind in enumerate(MORE, len(BASE))]
    drop = [f"{p}{kind}" for kind in MORE for p in ("_g_", "_f_", "_")]
    return docs.withColumn("more", F.concat(*parts)).drop(*drop)


def reliabilities(patterns: list[tuple[tuple[int, ...], int]]) -> dict[tuple[int, ...], float]:
    """Probability that a vote pattern belongs to personal data, by expectation maximisation.

    Labelers are taken as independent given the truth. The start is the majority.
    """
    votes = (-1, 0, 1)
    truth = {p: 1 / (1 + math.exp(-1.5 * sum(p))) for p, _ in patterns}
    total = sum(n for _, n in patterns)
    for _ in range(ROUNDS):
        share = {c: (sum(n * (truth[p] if c else 1 - truth[p]) for p, n in patterns) + 1) / (total + 2) for c in (0, 1)}
        rate = {}
        for k in range(len(LABELERS)):
            for c in (0, 1):
                seen = {v: 1.0 + 2.0 * (v == (1 if c else -1)) for v in votes}  # better than chance, before any data
                for p, n in patterns:
                    seen[p[k]] += n * (truth[p] if c else 1 - truth[p])
                whole = sum(seen.values())
                rate |= {(k, c, v): math.log(seen[v] / whole) for v in votes}
        for p, _ in patterns:
            odds = math.log(share[1] / share[0]) + sum(rate[k, 1, v] - rate[k, 0, v] for k, v in enumerate(p))
            truth[p] = 1 / (1 + math.exp(-max(-500.0, min(500.0, odds))))
    return truth


def _features(c: Column) -> dict[str, Column]:
    out = {f"{name}_{v}": (c[name] == v).cast("double") for name in LABELERS for v in (-1, 1)}
    out |= {f"kind_{k}": (c["kind"] == k).cast("double") for k in range(len(BASE), len(KINDS))}
    return out | {"size": c["size"].cast("double") / 8}


def classifier(found: DataFrame) -> dict[str, float] | None:
    """Weights of the span classifier, from the candidates of all documents; None without candidates."""
    flat = found.select(F.explode("more").alias("c")).select("c.kind", "c.size", *(f"c.{x}" for x in LABELERS))
    counts = saved(flat.groupBy("kind", "size", *LABELERS).agg(F.count("*").alias("n")), "vote-patterns")
    rows = counts.groupBy(*LABELERS).agg(F.sum("n").alias("n")).collect()  # 3 ** 5 at most
    if not rows:
        return None
    truth = reliabilities(sorted((tuple(r[x] for x in LABELERS), r.n) for r in rows))
    known = found.sparkSession.createDataFrame([(*p, t) for p, t in truth.items()], [*LABELERS, "truth"])
    table = counts.join(F.broadcast(known.select(*(F.col(x).cast("int").alias(x) for x in LABELERS), "truth")), LABELERS)
    table = table.select(F.struct("kind", "size", *LABELERS).alias("c"), "n", "truth")
    names = list(_features(F.col("c")))
    table = table.select(*(v.alias(k) for k, v in _features(F.col("c")).items()), "n", "truth")
    both = table.withColumns({"label": F.lit(1.0), "weight": F.col("n") * F.col("truth")}).unionAll(
        table.withColumns({"label": F.lit(0.0), "weight": F.col("n") * (1 - F.col("truth"))})
    )
    ready = VectorAssembler(inputCols=names, outputCol="x").transform(both)
    model = LogisticRegression(featuresCol="x", weightCol="weight", regParam=1e-3, maxIter=50).fit(ready)
    return dict(zip(names, model.coefficients.toArray().tolist())) | {"": model.intercept}


def find_spans(docs: DataFrame, *, text_col: str = "text") -> DataFrame:
    """``docs`` and two arrays of (start, kind number, end), in order: ``base`` and ``spans``, all of them."""
    plain = docs.withColumn("_text", F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    found = with_candidates(with_base(plain, "_text"), "_text").drop("_text")
    weights = classifier(found)
    added = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    if weights is not None:

        def is_personal(c: Column) -> Column:
            return sum((v * weights[k] for k, v in _features(c).items()), F.lit(weights[""])) >= 0

        added = F.transform(F.filter("more", is_personal), lambda c: F.struct(c["start"], c["kind"], c["end"]))
    return found.withColumn("spans", F.sort_array(F.concat("base", added.cast("array<struct<start:int,kind:int,end:int>>")))).drop("more")


def as_text(spans: str) -> Column:
    """kind:start:end of each span, joined by commas."""
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["end"])))


def count_of(kind: str, spans: str = "base") -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("long")


def redacted(text: str, spans: str) -> Column:
    """The text with each run of overlapping spans replaced by the kind of its first in brackets."""
    names = F.array(*(F.lit(f"[{k}]") for k in KINDS))
    body = F.coalesce(F.col(text), F.lit(""))
    step = lambda a, s: F.when(
        s["start"] >= a["at"],
        F.struct(
            s["end"].alias("at"),
            F.concat(a["out"], F.array(F.substring(body, a["at"] + 1, s["start"] - a["at"]), names[s["kind"]])).alias("out"),
        ),
    ).otherwise(F.struct(F.greatest(a["at"], s["end"]).alias("at"), a["out"].alias("out")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    whole = lambda a: F.concat(F.array_join(a["out"], ""), F.substring(body, a["at"] + 1, F.length(body)))
    return F.when(F.size(spans) == 0, F.col(text)).otherwise(F.aggregate(spans, start, step, whole))
