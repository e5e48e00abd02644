"""Quality rules with risk-controlled cutoffs (operator 3).

Each rule scores a text; a document is rejected when a score lies above the
rule's cutoff in the document's stratum (its language). Copies of a text are
one draw: labelled texts count once, and are split in two by a hash of the
text, so that no text is in both halves. One half proposes, per stratum, a
ladder of cutoff vectors: rung 0 rejects beyond the worst score that any good
document has, the next ones beyond fixed upper quantiles of the good
documents' scores. The other half, the holdout, decides: a rung is certified
when the exact binomial test on the holdout's good documents rejects "this
rung rejects more than ``risk`` of them" at level ``error / strata``
(Bonferroni over the strata). Rungs are tested from the most lenient up and
testing ends at the first that fails, so all certified rungs hold at once and
the choice among them is free: the one that rejects most documents labelled
bad, less ``prudence`` times the good ones lost. A stratum with too few
labelled documents, or without gain, is left to the base rule.

With probability ``1 - error``, in no stratum the rules together reject more
than ``risk`` of the good texts.

Defined results: a null or empty text has no words and fails the base rule; a
null language is a stratum of its own; labels repeated for an id, and those of
copies of one text, count once and as bad if any says so, null labels are left
out; a very long text is measured whole, in a slice of its own; scores equal to
a cutoff pass, equal gains go to the more lenient rung; documents of strata
without labels are judged by the base rule only; an empty table gives an empty
result; extra columns of any name are kept by ``good_documents``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staffmart.llm.common import BLANKS, fresh, materialise, slices

RISK = 0.02
ERROR = 0.05
PRUDENCE = 10.0
# Shares of the good documents above each rung's cutoffs, from the most lenient rung up.
QUANTILES = [0.0, 0.0005, 0.001, 0.002, 0.005, 0.01]
# Fixed values of the contract.
SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
# Scores in thousandths, larger is worse, 0 to 1000.
RULES = ["symbols", "duplicate_lines", "repeated_words", "capitals", "digits", "long_words",
         "short_words"]
SCORE_MAX = 1000
_ASCII_CAPITALS = bytes(range(65, 91))
_ASCII_DIGITS = bytes(range(48, 58))


def repeated_words(docs: list[list[bytes]], window: int = WINDOW) -> np.ndarray:
    """Per document, the words inside windows found at least twice in it.

    Words become 64-bit codes, windows a polynomial of these; one sort finds
    equal windows of all the documents at once.
    """
    lengths = np.array([len(d) for d in docs], dtype=np.int64)
    out = np.zeros(len(docs), dtype=np.int64)
    if lengths.max(initial=0) <= window:
        return out
    ids: dict[bytes, int] = {}
    flat = np.fromiter((ids.setdefault(w, len(ids)) for d in docs for w in d), dtype=np.int64,
                       count=int(lengths.sum()))
    rng = np.random.default_rng(len(ids))
    code = rng.integers(1, 2**63, size=len(ids), dtype=np.uint64)[flat]
    doc = np.repeat(np.arange(len(docs)), lengths)
    n = len(flat) - window + 1
    step = np.uint64(0x9E3779B97F4A7C15)
    total, factor = np.zeros(n, dtype=np.uint64), np.uint64(1)
    with np.errstate(over="ignore"):
        for j in range(window):
            total += code[j:j + n] * factor
            factor = factor * step
        # windows of different documents must differ
        total += (doc[:n].astype(np.uint64) + np.uint64(1)) * np.uint64(0xD1B54A32D192ED03)
    starts = np.flatnonzero(doc[:n] == doc[window - 1:])
    values = total[starts]
    order = np.argsort(values, kind="stable")
    ranked = values[order]
    same = ranked[1:] == ranked[:-1]
    repeated = np.zeros(len(starts), dtype=bool)
    repeated[order[1:][same]] = True
    repeated[order[:-1][same]] = True
    hits = starts[repeated]
    cover = np.zeros(len(flat) + 1, dtype=np.int64)
    np.add.at(cover, hits, 1)
    np.add.at(cover, hits + window, -1)
    covered = np.cumsum(cover[:-1]) > 0
    np.add.at(out, doc[covered], 1)
    return out


def measures(texts: list[str | None]) -> pd.DataFrame:
    """The base counts and the rule scores of whole texts."""
    rows, words_of = [], []
    for text in texts:
        text = text or ""
        raw = text.encode("utf-8", "surrogatepass")
        words = raw.split()  # splits at exactly the six ASCII blanks
        words_of.append(words)
        chars = len(text) - sum(text.count(c) for c in BLANKS)
        symbols = sum(text.count(c) for c in SYMBOLS)
        lines = [line for line in text.split("\n") if line.strip(BLANKS)]
        capitals = len(raw) - len(raw.translate(None, _ASCII_CAPITALS))
        digits = len(raw) - len(raw.translate(None, _ASCII_DIGITS))
        rows.append((len(words), chars, symbols, len(lines) - len(set(lines)), len(lines),
                     capitals, digits))
    m = pd.DataFrame(rows, columns=["n_words", "word_chars", "n_symbols", "n_dup_lines", "lines",
                                    "n_capitals", "n_digits"], dtype="int64")
    m["n_repeat_words"] = repeated_words(words_of) if words_of else np.zeros(0, dtype=np.int64)
    words, chars = m.n_words.clip(lower=1), m.word_chars.clip(lower=1)

    def thousandths(part: pd.Series, whole: pd.Series) -> pd.Series:
        return (SCORE_MAX * part // whole).clip(0, SCORE_MAX)

    m["symbols"] = thousandths(m.n_symbols, chars)
    m["duplicate_lines"] = thousandths(m.n_dup_lines, m.lines.clip(lower=1))
    m["repeated_words"] = thousandths(m.n_repeat_words, words)
    m["capitals"] = thousandths(m.n_capitals, chars)
    m["digits"] = thousandths(m.n_digits, chars)
    # mean word length as a share of 32 code points, and how far it stays below them
    m["long_words"] = thousandths(m.word_chars, words * 32)
    m["short_words"] = SCORE_MAX - m.long_words
    return m


MEASURE_TYPE = T.StructType([T.StructField(c, T.LongType()) for c in [*BASE, *RULES]])


def with_measures(docs: DataFrame, out: str) -> DataFrame:
    """``docs`` with one struct column more; texts go through Arrow in small slices."""
    names = [*BASE, *RULES]
    schema = T.StructType([*docs.schema.fields, T.StructField(out, MEASURE_TYPE)])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                m = measures(part.column("text").to_pylist())
                struct = pa.StructArray.from_arrays(
                    [pa.array(m[c].to_numpy(), pa.int64()) for c in names], names=names)
                yield pa.RecordBatch.from_arrays([*part.columns, struct],
                                                 names=[*part.schema.names, out])

    return docs.mapInArrow(add, schema)


def base_failed(m: Column) -> Column:
    return (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * m["n_words"])


def stratum(lang: Column) -> Column:
    """Never null: grouping and joining by it treat a null language as one value."""
    return F.coalesce(F.concat(F.lit("="), lang.cast("string")), F.lit(""))


def text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) of a binomial(n, p): the exact p-value of "the rate is above p"."""
    if k >= n:
        return 1.0
    i = np.arange(k + 1)
    logs = (math.lgamma(n + 1) - np.array([math.lgamma(x + 1) + math.lgamma(n - x + 1) for x in i])
            + i * math.log(p) + (n - i) * math.log1p(-p))
    return float(min(1.0, np.exp(logs).sum()))


def choose_rung(lost: list[int], n_good: int, caught: list[int], n_bad: int, risk: float,
                level: float, prudence: float) -> int | None:
    """The certified rung with the best gain; None rejects nothing.

    ``lost`` and ``caught``: holdout documents that each rung rejects, good
    and bad, from the most lenient rung up.
    """
    best, gain = None, 0.0
    if not n_good or not n_bad:
        return best
    for rung, (k, hits) in enumerate(zip(lost, caught, strict=True)):
        if binomial_tail(k, n_good, risk) > level:
            break
        value = hits / n_bad - prudence * k / n_good
        if value > gain:
            best, gain = rung, value
    return best


LADDER_TYPE = T.StructType([T.StructField("stratum", T.StringType()), *[
    T.StructField(r, T.ArrayType(T.LongType())) for r in RULES]])
CUTOFF_TYPE = T.StructType([T.StructField("stratum", T.StringType()),
                            *[T.StructField(r, T.LongType()) for r in RULES]])


def ladder(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Cutoffs per rung and rule from a stratum's histogram (rule, score, n) of good documents."""
    out = {}
    for rule in RULES:
        own = rows[rows.rule == rule].sort_values("score")
        scores, above = own.score.to_numpy(), own.n.sum() - own.n.cumsum().to_numpy()
        out[rule] = [int(scores[np.argmax(above <= q * own.n.sum())]) for q in QUANTILES]
    return pd.DataFrame([{"stratum": key[0], **out}])


def cutoffs(measured: DataFrame, labels: DataFrame, risk: float = RISK, error: float = ERROR,
            prudence: float = PRUDENCE) -> DataFrame:
    """One row per stratum with labels: the cutoff of each rule.

    ``measured``: doc_id, text_key, stratum, measures. All labelled texts count. A
    task of the pandas steps gets a histogram of rules x 1001 rows at most, or
    one row of counts.
    """
    verdicts = (labels.filter(F.col("quality").isNotNull()).groupBy("doc_id")
                .agg(F.min("quality").alias("quality")))
    texts = (measured.join(verdicts, "doc_id").filter(~base_failed(F.col("measures")))
             .groupBy("stratum", "text_key").agg(F.min("quality").alias("quality"),
                                                 F.any_value("measures").alias("measures")))
    labelled = materialise(
        texts.select("stratum", (F.col("quality") > 0).alias("good"), "measures",
                     (F.pmod(F.xxhash64(F.lit(3), "text_key"), F.lit(2)) == 0).alias("holdout")),
        "quality-labelled")
    scores = F.array(*[F.struct(F.lit(r).alias("rule"), F.col(f"measures.{r}").alias("score"))
                       for r in RULES])
    proposed = (labelled.filter("good AND NOT holdout")
                .select("stratum", F.explode(scores).alias("s"))
                .groupBy("stratum", "s.rule", "s.score").agg(F.count(F.lit(1)).alias("n"))
                .groupBy("stratum").applyInPandas(ladder, LADDER_TYPE))
    rungs = materialise(proposed, "quality-ladder")
    tested = labelled.filter("holdout").join(rungs, "stratum")
    rejects = [F.greatest(*[F.col(f"measures.{r}") > F.get(r, F.lit(g)) for r in RULES])
               for g in range(len(QUANTILES))]
    good = F.col("good")
    counted = tested.groupBy("stratum").agg(
        F.count_if(good).alias("n_good"), F.count_if(~good).alias("n_bad"),
        F.array(*[F.count_if(good & x) for x in rejects]).alias("lost"),
        F.array(*[F.count_if(~good & x) for x in rejects]).alias("caught"),
        *[F.first(r).alias(r) for r in RULES])
    counted = materialise(counted, "quality-holdout")
    level = error / max(1, counted.count())

    def certify(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in frames:
            chosen = []
            for row in rows.itertuples(index=False):
                rung = choose_rung(list(row.lost), row.n_good, list(row.caught), row.n_bad,
                                   risk, level, prudence)
                chosen.append({"stratum": row.stratum, **{
                    r: SCORE_MAX if rung is None else int(getattr(row, r)[rung]) for r in RULES}})
            yield pd.DataFrame(chosen, columns=["stratum", *RULES])

    return counted.mapInPandas(certify, CUTOFF_TYPE)


def rejecting_rules(m: Column, cut: str) -> Column:
    """Names of the rules that reject, in the order of RULES."""
    return F.filter(F.array(*[F.when(m[r] > F.col(f"{cut}.{r}"), F.lit(r)) for r in RULES]),
                    lambda r: r.isNotNull())


def judged(docs: DataFrame, labels: DataFrame, **options) -> tuple[DataFrame, str, str]:
    """``docs`` with measures and verdict columns; their names come along.

    The verdict is a struct (base_failed, kept, rules). Texts are not
    shuffled: the cutoffs, a row per stratum, are what is joined.
    """
    m, v, s, c = (fresh(docs, x) for x in ("measures_", "verdict_", "stratum_", "cutoffs_"))
    rows = with_measures(docs, m).withColumn(s, stratum(F.col("lang")))
    narrow = materialise(rows.select("doc_id", text_key(F.col("text")).alias("text_key"), F.col(s).alias("stratum"),
                                     F.col(m).alias("measures")), "quality-measures")
    chosen = materialise(cutoffs(narrow, labels, **options), "quality-cutoffs")
    chosen = chosen.select(F.col("stratum").alias(s), F.struct(*RULES).alias(c))
    out = rows.join(chosen, s, "left")
    rules = F.coalesce(rejecting_rules(F.col(m), c), F.array().cast("array<string>"))
    failed = base_failed(F.col(m))
    verdict = F.struct(failed.alias("base_failed"), (~failed & (F.size(rules) == 0)).alias("kept"),
                       rules.alias("rules"))
    return out.withColumn(v, verdict).drop(s, c), m, v


def good_documents(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that pass the base rule and all certified rules."""
    out, _, v = judged(docs, labels, **options)
    return out.filter(F.col(f"{v}.kept")).select(*[F.col(f"`{c}`") for c in docs.columns])


# --------------------------------------------------------------- the query


def op3_quality_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The texts are measured once; the verdicts follow from the narrow table."""
    measured = materialise(
        with_measures(docs.select("doc_id", "lang", "text"), "measures")
        .select("doc_id", text_key(F.col("text")).alias("text_key"), stratum(F.col("lang")).alias("stratum"),
                "measures"), "quality-measures")
    chosen = materialise(cutoffs(measured, labels), "quality-cutoffs")
    out = measured.join(chosen.select("stratum", F.struct(*RULES).alias("cutoffs")), "stratum", "left")
    m = F.col("measures")
    rules = F.coalesce(rejecting_rules(m, "cutoffs"), F.array().cast("array<string>"))
    return out.select("doc_id", *[f"measures.{c}" for c in BASE], base_failed(m).alias("base_failed"),
                      (~base_failed(m) & (F.size(rules) == 0)).alias("kept"),
                      F.array_join(rules, ",").alias("rejected_by"))
