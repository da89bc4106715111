"""Quality rules (8): text statistics and learned decision lists.

``text_stats`` counts, per whole text, what the rules look at. ``learn`` fits
an ordered list of interpretable threshold conjunctions by sequential covering:
grow a conjunction by FOIL gain on two thirds of the labelled rows, prune its
last conditions on the other third, keep it if it is precise enough there,
take away what it covers, go on. ``verdict`` turns the list into one Spark
conditional expression, so the decision itself runs in the JVM.

Defined results: a null or empty text has zero counts (and fails the base rule
of 50 words); repeated rows each get their own row; an empty table gives an
empty result; without labelled rows of both classes the list is empty and only
the base rule decides. Words are `[^\x20\x09-\x0D]+`.
"""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import words as W
from .common import annotate, fresh, prepare, quoted, read_documents

#: symbols of the base statistics
SYMBOLS = "#*$%&|<>"
STATS = {"n_words": "long", "word_chars": "long", "n_symbols": "long", "n_dup_lines": "long",
         "n_repeat_words": "long", "n_lines": "long", "n_upper": "long", "n_digits": "long",
         "n_marks": "long"}
#: at most this many labelled rows are used to fit the list (by hash of the id)
MAX_LABELLED = 20_000

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS.encode())] = True
_UPPER = np.zeros(256, bool)
_UPPER[0x41:0x5B] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[0x30:0x3A] = True
_MARK = np.zeros(256, bool)
_MARK[[b for b in range(0x21, 0x7F) if not chr(b).isalnum()]] = True
_MARK &= ~_SYMBOL
_BLANK = " \t\n\v\f\r"


def repeated_window_words(h: np.ndarray, doc: np.ndarray, n: int = 3) -> np.ndarray:
    """Marks the words in an n-word window found twice or more in its text."""
    covered = np.zeros(len(h), bool)
    if len(h) < n:
        return covered
    g = W.grams(h, n)
    at = np.flatnonzero(doc[:len(g)] == doc[n - 1:])
    key = W.mix(g[at] ^ W.mix(doc[at].astype(np.uint64) + np.uint64(1)))
    order = np.argsort(key, kind="stable")
    s = key[order]
    same = s[1:] == s[:-1]
    twice = np.zeros(len(s), bool)
    twice[1:] |= same
    twice[:-1] |= same
    hit = at[order[twice]]
    for k in range(n):
        covered[hit + k] = True
    return covered


def _per_text(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[at[1:]] - sums[at[:-1]]


def stats_of(texts: list) -> dict:
    w = W.split(W.utf8(texts))
    char = (w.buf & 0xC0) != 0x80
    covered = repeated_window_words(w.hashes(), w.doc())
    dup, lines = [], []
    for t in texts:
        kept = [x for x in (t or "").split("\n") if x.strip(_BLANK)]
        lines.append(len(kept))
        dup.append(len(kept) - len(set(kept)))
    return {"n_words": w.counts, "word_chars": _per_text(char & W.WORD_BYTES[w.buf], w.at),
            "n_symbols": _per_text(_SYMBOL[w.buf], w.at), "n_dup_lines": dup,
            "n_repeat_words": _per_text(covered, w.first), "n_lines": lines,
            "n_upper": _per_text(_UPPER[w.buf], w.at), "n_digits": _per_text(_DIGIT[w.buf], w.at),
            "n_marks": _per_text(_MARK[w.buf], w.at)}


def text_stats(docs: DataFrame, keep: list[str], text_col: str = "text", prefix: str = "") -> DataFrame:
    """The columns ``keep`` plus one long column per statistic."""
    return annotate(docs, text_col, {prefix + k: v for k, v in STATS.items()},
                    lambda texts: {prefix + k: v for k, v in stats_of(texts).items()}, keep)


def base_failed(prefix: str = "") -> Column:
    n, r = F.col(prefix + "n_words"), F.col(prefix + "n_repeat_words")
    return (n < 50) | (100 * r > 50 * n)


#: what rules compare with thresholds: a name and (numerator, denominator or None)
FEATURES = {
    "words": ("n_words", None), "word_length": ("word_chars", "n_words"),
    "symbols_per_word": ("n_symbols", "n_words"), "dup_line_share": ("n_dup_lines", "n_lines"),
    "repeat_share": ("n_repeat_words", "n_words"), "words_per_line": ("n_words", "n_lines"),
    "upper_per_char": ("n_upper", "word_chars"), "digits_per_char": ("n_digits", "word_chars"),
    "marks_per_word": ("n_marks", "n_words"),
}


def _feature(name: str, prefix: str) -> Column:
    a, b = FEATURES[name]
    num = F.col(prefix + a).cast("double")
    return num if b is None else num / F.greatest(F.col(prefix + b), F.lit(1)).cast("double")


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self, x: np.ndarray, names: list[str]) -> np.ndarray:
        v = x[:, names.index(self.feature)]
        return v > self.threshold if self.above else v <= self.threshold

    def column(self, prefix: str) -> Column:
        v = _feature(self.feature, prefix)
        return v > F.lit(self.threshold) if self.above else v <= F.lit(self.threshold)


def _covers(rule: list[Condition], x: np.ndarray, names: list[str]) -> np.ndarray:
    out = np.ones(len(x), bool)
    for c in rule:
        out &= c.holds(x, names)
    return out


def _best_condition(x: np.ndarray, y: np.ndarray, names: list[str]) -> tuple[float, Condition | None]:
    """The condition of highest FOIL gain among all midpoints of all features."""
    p0, n0 = int(y.sum()), int((~y).sum())
    best: tuple[float, Condition | None] = (1e-9, None)
    if not p0 or not n0:
        return best
    base = math.log2(p0 / (p0 + n0))
    for j, name in enumerate(names):
        order = np.argsort(x[:, j], kind="stable")
        v, yy = x[order, j], y[order]
        cut = np.flatnonzero(v[1:] > v[:-1])
        if not len(cut):
            continue
        below = np.cumsum(yy)[cut]
        for above, p, n in ((False, below, cut + 1 - below),
                            (True, p0 - below, n0 - (cut + 1 - below))):
            ok = p > 0
            gain = np.where(ok, p * (np.log2(np.maximum(p, 1) / np.maximum(p + n, 1)) - base), -1.0)
            k = int(np.argmax(gain))
            if gain[k] > best[0]:
                best = (float(gain[k]), Condition(name, above, float((v[cut[k]] + v[cut[k] + 1]) / 2)))
    return best


def learn_list(x: np.ndarray, reject: np.ndarray, prune_on: np.ndarray, names: list[str], *,
               min_precision: float = 0.9, max_conditions: int = 4, max_rules: int = 16,
               min_covered: int = 3) -> list[list[Condition]]:
    """Sequential covering over labelled rows; every rule rejects what it covers."""
    rules: list[list[Condition]] = []
    left = np.ones(len(x), bool)
    while len(rules) < max_rules and reject[left].any():
        grow, prune = left & ~prune_on, left & prune_on
        rule: list[Condition] = []
        cover = grow.copy()
        while len(rule) < max_conditions and (~reject[cover]).any():
            _, cond = _best_condition(x[cover], reject[cover], names)
            if cond is None:
                break
            rule.append(cond)
            cover &= cond.holds(x, names)

        def worth(r: list[Condition], rows: np.ndarray) -> float:
            c = rows & _covers(r, x, names)
            p = int(reject[c].sum())
            return (2 * p - int(c.sum())) / max(1, int(c.sum()))

        while len(rule) > 1 and worth(rule[:-1], prune) >= worth(rule, prune):
            rule = rule[:-1]
        c = left & _covers(rule, x, names) if rule else np.zeros(len(x), bool)
        if not rule or c.sum() < min_covered or reject[c].mean() < min_precision:
            break
        rules.append(rule)
        left &= ~c
    return rules


def learn(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
          max_labelled: int = MAX_LABELLED, **kw) -> list[list[Condition]]:
    """Fit the list on at most ``max_labelled`` labelled documents.

    The bound is on training rows only; the sample is the rows of smallest id
    hash, so reruns agree. Several labels of one document: the mean decides.
    Several rows of one id: the smallest text counts.
    """
    lab = (labels.where(F.col(id_col).isNotNull() & F.col("quality").isNotNull())
           .groupBy(id_col).agg((F.avg("quality") < 0.5).alias("reject"))
           .orderBy(F.xxhash64(id_col), id_col).limit(max_labelled))
    # at most max_labelled (id, boolean) rows: a few hundred KB
    rows = (docs.select(id_col, text_col).join(F.broadcast(lab), id_col)
            .groupBy(id_col).agg(F.min(text_col).alias("text"), F.first("reject").alias("reject")))
    pdf = text_stats(rows, [id_col, "reject"], "text").toPandas().sort_values(id_col)
    # the base rule decides these anyway
    pdf = pdf[(pdf.n_words >= 50) & (100 * pdf.n_repeat_words <= 50 * pdf.n_words)]
    names = list(FEATURES)
    x = np.column_stack([pdf[a] if b is None else pdf[a] / np.maximum(pdf[b], 1)
                         for a, b in FEATURES.values()]).astype(float) if len(pdf) else np.empty((0, len(names)))
    prune_on = np.array([zlib.crc32(f"p{i}".encode()) % 3 == 0 for i in pdf[id_col]], bool)
    return learn_list(x, pdf["reject"].to_numpy(bool), prune_on, names, **kw)


def verdict(rules: list[list[Condition]], prefix: str = "") -> Column:
    """True where no rule of the ordered list rejects."""
    out = F.when(base_failed(prefix), F.lit(False))
    for rule in rules:
        cond = rule[0].column(prefix)
        for c in rule[1:]:
            cond &= c.column(prefix)
        out = out.when(cond, F.lit(False))
    return out.otherwise(F.lit(True))


def filter_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the base rule and the learned list keep, all columns unchanged."""
    rules = learn(docs, labels)
    prefix = fresh("q__", docs)
    while any(c.lower().startswith(prefix) for c in docs.columns):
        prefix = "_" + prefix
    return text_stats(docs, docs.columns, prefix=prefix).where(verdict(rules, prefix)).select(
        *[quoted(c) for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir)
    rules = learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return text_stats(docs, ["doc_id"]).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed().alias("base_failed"), verdict(rules).alias("kept"))


__all__ = ["filter_documents", "learn", "learn_list", "prepare", "query", "text_stats", "verdict"]
