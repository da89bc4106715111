r"""LM scoring (9): prediction by partial matching over bytes.

The model is the byte-context trie of orders ORDER to 0, counted over all
training documents, with PPMC escapes and symbol exclusion. A position's code
depends on its ORDER bytes of history and its symbol only, so the corpus is one
table of (ORDER + 1)-grams: each pack sends its distinct grams with counts, the
trie's levels are groupings of that table, and the codes come back to the packs
that asked. Nothing is broadcast or collected; the table grows with the text.

Because a shorter context has seen every successor of the longer one, exclusion
needs per context only its total, its number of successors, and how often the
shorter context saw those successors. Level by level, from order 0 up, each
(context, symbol) gets the log probability of coding the symbol after an escape.

The base score is a unigram model of words with add-one smoothing, the end of a
text counted as a token; word counts travel the same way.

Texts are lower-cased (A-Z). Defined results: a null or empty text has one token
(its end); without training documents all symbols are equally likely; a null id
counts as the empty string; repeated rows each train and get their row.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import packs as P
from . import words as W
from .common import read_documents, stored
from ..session import checkpoint_dir

ORDER = 4
END = 256
SYMBOLS = 257
PACK_CHARS = 4 << 20
#: characters that the kernels look at together
SLICE_CHARS = 1 << 20
_END_NAME = np.uint64(0x454E44)


def is_training(doc_id: int | None) -> bool:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 != 2


def words_of(texts: list) -> tuple[W.Words, np.ndarray]:
    w = W.split(W.utf8(texts), lower=True)
    return w, w.hashes()


def byte_grams(texts: list, order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """(packed gram of every symbol, offsets of the texts). A gram is the last
    ``order`` bytes (zeros before the start) and nine bits of symbol."""
    raws = W.utf8(texts)
    pad = b"\0" * order
    buf = W.LOWER[np.frombuffer(pad + pad.join(r for r in raws) + pad if raws else pad, np.uint8)]
    size = np.array([len(r) for r in raws], np.int64)
    first = np.concatenate([[0], np.cumsum(size + 1)])
    # text i begins at order * (i + 1) + bytes before it; its last symbol is the end
    begin = order * (np.arange(len(raws)) + 1) + np.concatenate([[0], np.cumsum(size)])[:-1]
    at = np.repeat(begin - first[:-1], size + 1) + np.arange(first[-1])
    sym = buf[at].astype(np.uint64)
    sym[first[1:] - 1] = END
    key = np.zeros(len(at), np.uint64)
    for k in range(order, 0, -1):
        key = (key << np.uint64(8)) | buf[at - k]
    return (key << np.uint64(9)) | sym, first


def _counted(names: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    u, inv = np.unique(np.concatenate(names), return_inverse=True)
    return u, np.bincount(inv.ravel(), weights=np.concatenate(counts), minlength=len(u)).astype(np.int64)


def ask_words(ids: list, texts: list) -> tuple[np.ndarray, dict]:
    train = np.array([is_training(i) for i in ids])
    names, counts = [np.array([_END_NAME])], [np.array([train.sum()])]
    for lo, hi in W.slices(texts, SLICE_CHARS):
        w, h = words_of(texts[lo:hi])
        u, inv = np.unique(h, return_inverse=True)
        names.append(u)
        counts.append(np.bincount(inv.ravel(), weights=np.repeat(train[lo:hi], w.counts), minlength=len(u)))
    u, n = _counted(names, counts)
    return u, {"names": u, "n": n}


def _numbered(names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct names in order, and the place of every name in them."""
    u, inv = np.unique(names, return_inverse=True)
    return u, inv.ravel().astype(np.int32)


def ask_grams(ids: list, texts: list) -> tuple[np.ndarray, dict]:
    train = np.array([is_training(i) for i in ids])
    names, counts = [], []
    for lo, hi in W.slices(texts, SLICE_CHARS):
        g, first = byte_grams(texts[lo:hi])
        u, inv = np.unique(g, return_inverse=True)
        names.append(u)
        counts.append(np.bincount(inv.ravel(), weights=np.repeat(train[lo:hi], np.diff(first)), minlength=len(u)))
    u, n = _counted(names, counts)
    return u, {"names": u, "n": n.astype(np.int64)}


def _totals(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    names = np.frombuffer(b"".join(pdf["names"]), np.uint64)
    n = np.frombuffer(b"".join(pdf["n"]), np.int64)
    u, inv = np.unique(names, return_inverse=True)
    inv = inv.ravel()
    # whole numbers far below 2**53, so doubles add them exactly
    return u, np.bincount(inv, weights=n, minlength=len(u)).astype(np.int64), inv


def answer_words(pdf: pd.DataFrame) -> pd.DataFrame:
    """A count per asked name; one more row (pack -1) with the part's tokens and distinct names."""
    u, total, inv = _totals(pdf)
    ends = np.cumsum([len(b) // 8 for b in pdf["names"]])
    told = [total[inv[e - len(b) // 8:e]].tobytes() for e, b in zip(ends, pdf["names"])]
    stats = np.array([total.sum(), (total > 0).sum()], np.int64).tobytes()
    part = int(pdf["part"].iloc[0])
    return pd.DataFrame({"pack": [*pdf["pack"], -1], "part": [*pdf["part"], part], "told": [*told, stats]})


def codes(grams: DataFrame, order: int = ORDER) -> DataFrame:
    """(part, gram, code): log10 probability of each gram's symbol after its history.

    ``grams`` (part, gram, n) holds every gram of every text, n = 0 where only
    held-out texts have it.
    """
    full = grams.select("part", "gram", F.shiftright("gram", 9).alias("c"),
                        F.col("gram").bitwiseAND(F.lit(511)).alias("s"), "n")
    levels = [full]
    for k in range(order - 1, -1, -1):
        # every level is a grouping of the next longer one, which is smaller than the table
        c = F.col("c").bitwiseAND(F.lit((1 << 8 * k) - 1))
        levels.insert(0, levels[0].groupBy(c.alias("c"), "s").agg(F.sum("n").alias("n")))
    per = Window.partitionBy("c")  # at most SYMBOLS rows per context

    def summed(df: DataFrame) -> DataFrame:
        return df.withColumn("t", F.sum("n").over(per)).withColumn("d", F.sum((F.col("n") > 0).cast("long")).over(per))

    lev = summed(levels[0])
    left = F.lit(SYMBOLS) - F.col("d")
    # below order 0 all symbols not seen at all are equally likely
    lev = lev.withColumn("e", F.when(left > 0, F.log10(F.lit(1.0) / left)).otherwise(F.lit(0.0)))
    for k in range(1, order + 1):
        mask = F.lit((1 << 8 * (k - 1)) - 1)
        up = lev.select(F.col("c").alias("pc"), F.col("s").alias("ps"), F.col("n").alias("pn"),
                        F.col("t").alias("pt"), F.col("d").alias("pd"), F.col("e").alias("pe"))
        j = levels[k].join(up, (F.col("c").bitwiseAND(mask) == F.col("pc")) & (F.col("s") == F.col("ps")))
        j = summed(j).withColumn("x", F.sum(F.when(F.col("n") > 0, F.col("pn")).otherwise(F.lit(0))).over(per))
        # what the shorter context offers once this context's successors are excluded
        room, new = F.col("pt") - F.col("x"), F.col("pd") - F.col("d")
        whole = (room + new).cast("double")
        e = (F.when(whole <= 0, F.col("pe"))
             .when(F.col("pn") > 0, F.log10(F.col("pn") / whole))
             .otherwise(F.log10(new / whole) + F.col("pe")))
        # a successor of this context never escapes from it
        lev = j.withColumn("e", F.when(F.col("n") > 0, F.lit(0.0)).otherwise(e)).drop("pc", "ps", "pn", "pt", "pd", "pe", "x")
    whole = (F.col("t") + F.col("d")).cast("double")
    code = (F.when(F.col("n") > 0, F.log10(F.col("n") / whole))
            .when(F.col("t") > 0, F.log10(F.col("d") / whole) + F.col("e")).otherwise(F.col("e")))
    return lev.select("part", "gram", code.alias("code"))


def _asked_by_part(asked: DataFrame, parts: int, table: str) -> DataFrame:
    """Written bucketed by part: read twice without a second shuffle."""
    spark = asked.sparkSession
    (P.by_part(asked, parts).write.bucketBy(P.tasks(spark, parts), "part")
     .option("path", f"{checkpoint_dir(spark)}/{table}").saveAsTable(table))
    return spark.table(table)


def score_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row."""
    spark, written, asked_table = docs.sparkSession, P.new_table(), P.new_table()
    packs, parts = P.packed(docs, id_col, text_col, PACK_CHARS, written)
    told_words = stored(P.by_part(P.ask(packs, ["names", "n"], parts, ask_words), parts).groupBy("part").applyInPandas(
        answer_words, "pack long, part int, told binary"), "ppm-words")
    tokens, distinct = _stats(told_words)
    asked = _asked_by_part(P.ask(packs, ["names", "n"], parts, ask_grams), parts, asked_table)

    def total(pdf: pd.DataFrame) -> pd.DataFrame:
        u, n, _ = _totals(pdf)
        return pd.DataFrame({"part": pdf["part"].iloc[0], "gram": u.astype(np.int64), "n": n})

    grams = stored(asked.groupBy("part").applyInPandas(total, "part int, gram long, n long"), "ppm-grams")
    code = codes(grams)

    def reply(pdf: pd.DataFrame, table: pd.DataFrame) -> pd.DataFrame:
        order = np.argsort(table["gram"].to_numpy())
        gram, value = table["gram"].to_numpy()[order].astype(np.uint64), table["code"].to_numpy()[order]
        told = [value[np.searchsorted(gram, np.frombuffer(b, np.uint64))].tobytes() for b in pdf["names"]]
        return pd.DataFrame({"pack": pdf["pack"], "part": pdf["part"], "told": told})

    told_grams = asked.groupBy("part").cogroup(code.groupBy("part")).applyInPandas(
        reply, "pack long, part int, told binary")
    known = P.with_answers(packs, told_words.where("pack >= 0"), parts, "words")
    known = P.with_answers(known, told_grams, parts, "codes")
    schema = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
              "base_score double, score double")

    def apply(batches):
        for batch in batches:
            cols = [batch.column(c) for c in ("ids", "texts", "words", "codes")]
            for i in range(batch.num_rows):
                out = _scores(*[c[i].as_py() for c in cols], parts, tokens, distinct)
                yield pa.RecordBatch.from_pydict(out)

    out = stored(known.select("ids", "texts", "words", "codes").mapInArrow(apply, schema), "ppm-scores")
    # what follows reads the scores only
    P.drop(spark, written)
    P.drop(spark, asked_table)
    return out


def _stats(told_words: DataFrame) -> tuple[int, int]:
    """Training tokens and distinct training tokens, summed over parts in Spark."""
    def unpack(frames):
        for pdf in frames:
            x = np.array([np.frombuffer(b, np.int64) for b in pdf["told"]]).reshape(-1, 2)
            yield pd.DataFrame({"n": x[:, 0], "v": x[:, 1]})
    r = told_words.where("pack = -1").select("told").mapInPandas(unpack, "n long, v long").agg(
        F.sum("n").alias("n"), F.sum("v").alias("v")).first()
    return r["n"] or 0, r["v"] or 0


def _scores(ids: list, texts: list, words: list | None, codes_: list | None, parts: int,
            tokens: int, distinct: int) -> dict:
    # every slice is read once: its counts and bounds, and places in its distinct names
    counts, word_slices, gram_slices = [], [], []
    for a, b in W.slices(texts, SLICE_CHARS):
        w, h = words_of(texts[a:b])
        counts.append(w.counts)
        word_slices.append((*_numbered(h), w.first))
        g, first = byte_grams(texts[a:b])
        gram_slices.append((*_numbered(g), first))
    wu = np.unique(np.concatenate([[_END_NAME], *[u for u, _, _ in word_slices]]).astype(np.uint64))
    wc = P.told(words, wu, parts, np.int64)
    base = np.log10((wc + 1.0) / (tokens + 1.0 * (distinct + 1)))
    end = int(np.searchsorted(wu, _END_NAME))
    gu = np.unique(np.concatenate([u for u, _, _ in gram_slices]))
    gc = P.told(codes_, gu, parts, np.float64)
    n_tokens, n_known, base_score, score = [], [], [], []
    for n, (u, inv, first), (v, place, bounds) in zip(counts, word_slices, gram_slices):
        at = np.searchsorted(wu, u)
        n_tokens.append(n + 1)
        n_known.append(_sums((wc[at] > 0).astype(np.int64)[inv], first) + int(wc[end] > 0))
        base_score.append(_sums(base[at][inv], first) + base[end])
        score.append(_sums(gc[np.searchsorted(gu, v)][place], bounds))
    return {"doc_id": pa.array(ids, pa.int64()), "held_out": pa.array([not is_training(i) for i in ids]),
            "n_tokens": pa.array(np.concatenate(n_tokens)), "n_known": pa.array(np.concatenate(n_known)),
            "train_tokens": pa.array(np.full(len(ids), tokens, np.int64)),
            "base_score": pa.array(np.concatenate(base_score)), "score": pa.array(np.concatenate(score))}


def _sums(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums per text (texts may be empty), each over its own values only."""
    out = np.zeros(len(first) - 1, x.dtype)
    full = np.flatnonzero(np.diff(first) > 0)
    if len(full):
        out[full] = np.add.reduceat(x, first[full])
    return out


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(read_documents(spark, sf_dir))
