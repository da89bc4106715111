r"""N-gram Jaccard join (10): blocked sparse matrix product.

Documents are rows, distinct word n-grams columns of a 0/1 matrix; entries of
the product of the matrix with its transpose are overlap counts, and two
documents link when ``100 * overlap >= percent * union``. Size-derived bounds
keep the product sparse without losing a link:

* equal sets are one row (grouped by the 128-bit hash of the set);
* a link needs an overlap of ``ceil(t n)`` of the smaller-or-equal size n, so two
  linked sets share a column among the first ``n - ceil(t n) + 1`` of each, in
  any fixed order of columns. The order is rare columns first, by a count table
  of fixed size over all documents;
* a shared column at places i, j of that order leaves at most
  ``min(n - i, m - j)`` for the overlap, and sizes must be within the ratio.

The product is taken by blocks of columns, one group each. Columns held by few rows
add up, for each pair of rows that the size bounds allow, the columns that both
have and what is left behind the last of them; the sums over all blocks are the
overlap so far, and pairs whose overlap so far and rest are below the bound go.
Parity sketches drop pairs that surely differ too much, the overlap of the others
is completed on the whole sets. Columns held by many rows (families of near copies) never emit
pairs (two rows that share one meet in their family, whatever the sums above
leave out): columns that the count table shows to be common are dealt out by row,
so no group holds all rows of one. Rows that hang together by such columns form a family, families are cut
into blocks of bounded size by size class and hash, and a pair of blocks that
the bounds allow is one dense product in one task, which returns no more edges
than a spanning forest of the links it found. First every block meets the first one of
its class and of the classes next to it; then, for the other pairs of blocks, sketches
name the rows that may link with a row they do not hang together with yet, and only
those are sent there as whole sets. A family of copies hangs together after the first
step, one of texts that merely share a phrase names few rows, so the sets that are sent
do not grow with a family's square. The components of all links are
then found by star contraction.

Words `[^\x20\x09-\x0D]+`, A-Z lower-cased. A text with fewer than ``n`` words
is one n-gram, its whole sequence. Defined results: without words or text a set
is empty and links with nothing; a null id is ignored when the smallest id is
taken (null if a component has no other); repeated rows have equal sets; an
empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import packs as P
from . import words as W
from .common import fresh, quoted, read_documents, stored
from .components import components

SHINGLE = 3
PERCENT = 90
SLOTS = 1 << 18
CHUNKS = 16
#: columns with more rows than this go to blocks
HOT = 64
#: a column with more than this share of all rows is common: its entries are dealt out by row
COMMON = 100
#: the place of an entry that was dealt out by row
_BY_ROW = np.iinfo(np.uint32).max
BLOCK_ROWS = 256
BLOCK_ENTRIES = 400_000
#: blocks whose sketches meet in one task
SKETCH_BLOCKS = 16
_U = np.uint64


def sets_of(texts: list, n: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct n-gram hashes of every text."""
    out = []
    for lo, hi in W.slices(texts, 2 << 20):
        w = W.split(W.utf8(texts[lo:hi]), lower=True)
        h = w.hashes()
        g = W.grams(h, n)
        for a, b in zip(w.first[:-1], w.first[1:]):
            if b - a >= n:
                out.append(np.unique(g[a:b - n + 1]))
            elif b > a:
                # a short sequence is told apart from every n-gram by its length
                out.append(W.mix(W.grams(h[a:b], b - a) + _U(b - a)))
            else:
                out.append(np.empty(0, np.uint64))
    return out


def slot_of(h: np.ndarray) -> np.ndarray:
    return (h >> _U(46)).astype(np.int64)


def set_name(s: np.ndarray) -> bytes:
    """128 bits that depend on every member."""
    with np.errstate(over="ignore"):
        a = W.mix(s + _U(0x9E3779B97F4A7C15)).sum(dtype=np.uint64)
        b = np.bitwise_xor.reduce(W.mix(s ^ _U(0xC2B2AE3D27D4EB4F)) * _U(0x165667B19E3779F9)) if len(s) else _U(0)
        return np.array([a ^ _U(len(s)), b + a], np.uint64).tobytes()


def prefix(s: np.ndarray, table: np.ndarray, percent: int) -> np.ndarray:
    """The columns of a set that a link must touch, rarest first."""
    n = len(s)
    order = np.lexsort((s, table[slot_of(s)]))
    return s[order[:n - -(-percent * n // 100) + 1]]


def least_overlap(n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """100 x >= percent (n + m - x) for the overlap x."""
    return -(-(percent * (n + m)) // (100 + percent))


# --- passes over the packs: a row is rid = pack * 2**20 + its place -----------------

def _documents_and_table(packs: DataFrame, shingle: int) -> DataFrame:
    """(kind, rid, doc_id, n, name, blob): a row per document, and per task the
    chunks of its column counts."""
    schema = "kind int, rid long, doc_id long, n long, name binary, blob binary"
    types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]

    def run(batches):
        table = np.zeros(SLOTS, np.uint32)
        for batch in batches:
            for i in range(batch.num_rows):
                pack = batch.column("pack")[i].as_py()
                sets = sets_of(batch.column("texts")[i].as_py(), shingle)
                every = np.concatenate([np.empty(0, np.uint64), *sets])
                table += np.bincount(slot_of(every), minlength=SLOTS).astype(np.uint32)
                k = len(sets)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                    [[0] * k, [(pack << 20) + j for j in range(k)], batch.column("ids")[i].as_py(),
                     [len(s) for s in sets], [set_name(s) if len(s) else None for s in sets], [None] * k], types)],
                    names=["kind", "rid", "doc_id", "n", "name", "blob"])
        step = SLOTS // CHUNKS
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
            [[1] * CHUNKS, list(range(CHUNKS)), [None] * CHUNKS, [0] * CHUNKS, [None] * CHUNKS,
             [table[c * step:(c + 1) * step].tobytes() for c in range(CHUNKS)]], types)],
            names=["kind", "rid", "doc_id", "n", "name", "blob"])

    return packs.select("pack", "ids", "texts").mapInArrow(run, schema)


def _column_table(rows: DataFrame) -> np.ndarray:
    """SLOTS counts (a megabyte or two, whatever the corpus) over all documents."""
    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(b, np.uint32).astype(np.int64) for b in pdf["blob"])
        return pd.DataFrame({"chunk": [pdf["rid"].iloc[0]], "blob": [total.tobytes()]})
    got = rows.where("kind = 1").groupBy("rid").applyInPandas(add, "chunk long, blob binary").collect()
    table = np.zeros(SLOTS, np.int64)
    step = SLOTS // CHUNKS
    for r in got:
        table[r["chunk"] * step:(r["chunk"] + 1) * step] = np.frombuffer(r["blob"], np.int64)
    return table


def _chosen(packs: DataFrame, rids: DataFrame, out: str) -> DataFrame:
    """The packs that hold some of the rids, with their places."""
    at = rids.groupBy(F.shiftright("rid", 20).alias("c_pack")).agg(
        F.collect_list(F.col("rid").bitwiseAND(F.lit((1 << 20) - 1)).cast("int")).alias(out))
    return packs.join(at.hint("shuffle_hash"), F.col("pack") == F.col("c_pack")).select("pack", "texts", out)


def _postings(packs: DataFrame, reps: DataFrame, parts: int, table: np.ndarray, shingle: int,
              percent: int, least: int, common: int) -> DataFrame:
    """(part, pack, cols, rids, sizes, places): the prefix entries of the representatives.
    Entries of a column are of one part, but for those counted more than ``common`` times."""
    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                pack, texts, at = [batch.column(c)[i].as_py() for c in ("pack", "texts", "at")]
                at = sorted(at)
                sets = sets_of([texts[j] for j in at], shingle)
                pre = [prefix(s, table, percent) if len(s) >= least else np.empty(0, np.uint64) for s in sets]
                k = np.array([len(p) for p in pre], np.int64)
                cols = np.concatenate([np.empty(0, np.uint64), *pre])
                place = np.arange(len(cols)) - np.repeat(np.cumsum(k) - k, k)
                rid = np.repeat((pack << 20) + np.array(at, np.int64), k)
                size = np.repeat(np.array([len(s) for s in sets], np.int64), k)
                many = table[slot_of(cols)] > common
                place[many] = _BY_ROW
                got = P.deal_rows(pack, np.where(many, rid.view(np.uint64), cols), parts, {"cols": cols, "rids": rid, "sizes": size.astype(np.uint32),
                                                      "places": place.astype(np.uint32)}, {})
                if got is not None:
                    yield got
    return _chosen(packs, reps, "at").mapInArrow(
        run, "part int, pack long, cols binary, rids binary, sizes binary, places binary")


PAIRS = "kind int, a long, b long, shared long, left_a long, left_b long, need long"


def pairs_and_hot(percent: int, hot: int):
    """Per part of columns (a block of the product): overlap counts (kind 0: a, b, shared
    columns, entries behind the last of them, overlap that a link needs) of the columns with
    few rows, and memberships (kind 1: rid, column) of those with many."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        col = np.frombuffer(b"".join(pdf["cols"]), np.uint64)
        rid = np.frombuffer(b"".join(pdf["rids"]), np.int64)
        size = np.frombuffer(b"".join(pdf["sizes"]), np.uint32).astype(np.int64)
        place = np.frombuffer(b"".join(pdf["places"]), np.uint32).astype(np.int64)
        order = np.lexsort((rid, size, col))
        col, rid, size, place = col[order], rid[order], size[order], place[order]
        begin = np.flatnonzero(np.append(True, col[1:] != col[:-1]))
        count = np.diff(np.append(begin, len(col)))
        of = np.repeat(np.arange(len(begin)), count)
        rest = size - place
        cold = (count[of] <= hot) & (place != _BY_ROW)
        # entries of the product by rows: a, b, 1, left_a, left_b, need
        found = [np.empty((0, 6), np.int64)]
        # neighbours at distance d in a column, sizes ascending: a is the smaller of a pair in every column
        for d in range(1, int(min(hot, count[of][cold].max(initial=0)))):
            i = np.arange(len(col) - d)
            i = i[(of[:-d] == of[d:]) & cold[:-d]]
            if not len(i):
                break
            j = i + d
            need = least_overlap(size[i], size[j], percent)
            # at most all places before are shared, and all behind
            ok = (100 * size[i] >= percent * size[j]) & (
                np.minimum(place[i], place[j]) + np.minimum(rest[i], rest[j]) >= need)
            i, j, need = i[ok], j[ok], need[ok]
            found.append(np.column_stack([rid[i], rid[j], np.ones_like(i), rest[i] - 1, rest[j] - 1, need]))
        all_ = np.concatenate(found)
        all_ = all_[np.lexsort((all_[:, 1], all_[:, 0]))]
        at = np.flatnonzero(np.append(True, (all_[1:, :2] != all_[:-1, :2]).any(axis=1))[:len(all_)])
        got = all_[at]
        if len(at):
            got[:, 2] = np.add.reduceat(all_[:, 2], at)
            got[:, 3] = np.minimum.reduceat(all_[:, 3], at)
            got[:, 4] = np.minimum.reduceat(all_[:, 4], at)
        warm = np.flatnonzero(~cold)
        more = np.zeros((len(warm), 6), np.int64)
        more[:, 0], more[:, 1] = rid[warm], col[warm].view(np.int64)
        out = pd.DataFrame(np.concatenate([got, more]), columns=["a", "b", "shared", "left_a", "left_b", "need"])
        out.insert(0, "kind", np.repeat([0, 1], [len(got), len(more)]))
        return out
    return run


def accumulated(found: DataFrame) -> DataFrame:
    """The pairs (a, b) whose overlap, added up over all blocks of columns, and what is left
    behind the last shared column reach what a link needs."""
    return found.where("kind = 0").groupBy("a", "b").agg(
        F.sum("shared").alias("shared"), F.min("left_a").alias("left_a"), F.min("left_b").alias("left_b"),
        F.first("need").alias("need")).where("shared + least(left_a, left_b) >= need").select("a", "b")


def sketch(s: np.ndarray) -> bytes:
    """Parities of the members hashed to 2**k bits, k after the size (one bit per
    member or two). Two sets differ in at least as many members as bits."""
    k = max(8, int(len(s)).bit_length())
    at = (W.mix(s ^ _U(0x94D049BB133111EB)) >> _U(64 - k)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=1 << k) & 1).astype(np.uint8)).tobytes()


def differing(x: bytes, y: bytes) -> int:
    """Bits in which two sketches differ; the longer one is folded first."""
    if len(x) < len(y):
        x, y = y, x
    while len(x) > len(y):
        bits = np.unpackbits(np.frombuffer(x, np.uint8))
        x = np.packbits(bits[0::2] ^ bits[1::2]).tobytes()
    return (int.from_bytes(x, "big") ^ int.from_bytes(y, "big")).bit_count()


def _sets(packs: DataFrame, rids: DataFrame, shingle: int, form=np.ndarray.tobytes) -> DataFrame:
    """(rid, n, members) of the chosen rows; ``members`` as ``form`` gives them."""
    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                pack, texts, at = [batch.column(c)[i].as_py() for c in ("pack", "texts", "at")]
                sets = sets_of([texts[j] for j in at], shingle)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([(pack << 20) + j for j in at], pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([form(s) for s in sets], pa.binary())], names=["rid", "n", "members"])
    return _chosen(packs, rids, "at").mapInArrow(run, "rid long, n long, members binary")


def _overlap(x: bytes, y: bytes) -> tuple[int, int, int]:
    a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    if len(a) > len(b):
        a, b = b, a
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    return int((b[at] == a).sum()), len(a), len(b)


def _matched(pairs: DataFrame, sets: DataFrame, ok) -> DataFrame:
    """The pairs (a, b) whose two rows of ``sets`` satisfy ``ok(n, m, x, y)``."""
    x = sets.select(F.col("rid").alias("ra"), F.col("n").alias("na"), F.col("members").alias("ma"))
    y = sets.select(F.col("rid").alias("rb"), F.col("n").alias("nb"), F.col("members").alias("mb"))
    both = pairs.join(x, F.col("a") == F.col("ra")).join(y, F.col("b") == F.col("rb")).select(
        "a", "b", "na", "nb", "ma", "mb")

    def run(frames):
        for pdf in frames:
            keep = [ok(n, m, p, q) for n, m, p, q in zip(pdf["na"], pdf["nb"], pdf["ma"], pdf["mb"])]
            yield pdf.loc[np.array(keep, bool), ["a", "b"]]

    return both.mapInPandas(run, "a long, b long")


def _rids(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("rid")).union(pairs.select("b")).distinct()


def _counted_links(packs: DataFrame, pairs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs (a, b) that link. Sketches, a small part of the sets' size, first
    drop the pairs that differ in too many members; the overlap of the others is
    counted on their whole sets."""
    near = stored(_matched(pairs, _sets(packs, _rids(pairs), shingle, sketch), lambda n, m, x, y: differing(x, y)
                           <= n + m - 2 * least_overlap(n, m, percent)), "join-near")

    def links(n, m, x, y):
        o, _, _ = _overlap(x, y)
        return 100 * o >= percent * (n + m - o)

    return _matched(near, _sets(packs, _rids(near), shingle), links)


# --- families of near copies -----------------------------------------------------

def product(left: list[np.ndarray], right: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """Overlap counts of all left with all right rows: a dense product, some
    columns at a time. Columns with one row only count for nothing and go first."""
    rows = [*left, *right]
    size = np.array([len(r) for r in rows], np.int64)
    every = np.concatenate([np.empty(0, np.uint64), *rows])
    u, inv, n = np.unique(every, return_inverse=True, return_counts=True)
    keep = n[inv] > 1
    name = np.cumsum(n > 1) - 1
    row, col = np.repeat(np.arange(len(rows)), size)[keep], name[inv.ravel()[keep]]
    out = np.zeros((len(left), len(right)), np.float32)
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    for c in range(0, int((n > 1).sum()), columns):
        s, e = np.searchsorted(col, [c, c + columns])
        m = np.zeros((len(rows), columns), np.float32)
        m[row[s:e], col[s:e] - c] = 1
        out += m[:len(left)] @ m[len(left):].T
    return out.astype(np.int64)


def forest(n: int, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """The edges that join two trees, in order: at most n - 1."""
    root = list(range(n))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    out = []
    for x, y in zip(a.tolist(), b.tolist()):
        i, j = find(x), find(y)
        if i != j:
            root[max(i, j)] = min(i, j)
            out.append((x, y))
    return out


def block_links(percent: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        rid = pdf["rid"].to_numpy()
        sets = [np.frombuffer(b, np.uint64) for b in pdf["members"]]
        first = np.flatnonzero(pdf["side"].to_numpy() == 0)
        second = np.flatnonzero(pdf["side"].to_numpy() == 1)
        same = len(second) == 0
        if same:
            second = first
        left, right = [sets[i] for i in first], [sets[i] for i in second]
        o = product(left, right)
        n, m = np.array([len(s) for s in left])[:, None], np.array([len(s) for s in right])[None, :]
        link = 100 * o >= percent * (n + m - o)
        i, j = np.nonzero(np.triu(link, 1) if same else link)
        edges = forest(len(rid), first[i], second[j])
        return pd.DataFrame({"a": [rid[x] for x, _ in edges], "b": [rid[y] for _, y in edges]}, dtype="int64")
    return run


def _folded(x: bytes, size: int) -> bytes:
    """A sketch at ``size`` bytes, as it would have been made with fewer bits."""
    while len(x) > size:
        bits = np.unpackbits(np.frombuffer(x, np.uint8))
        x = np.packbits(bits[0::2] ^ bits[1::2]).tobytes()
    return x


def block_candidates(percent: int):
    """Per pair of groups of blocks (x, y) of sketches: the rows that may link with a row
    of another component, once for each pair of blocks (family, k, x, next, y) that holds such a row."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        family, k, nxt = (int(pdf[c].iloc[0]) for c in ("family", "k", "next"))
        rid, n, cut, comp, side = (pdf[c].to_numpy(np.int64) for c in ("rid", "n", "cut", "comp", "side"))
        least = min(len(b) for b in pdf["members"])
        bits = np.frombuffer(b"".join(_folded(b, least) for b in pdf["members"]), np.uint64).reshape(len(pdf), -1)
        same = nxt == 0 and pdf["x"].iloc[0] == pdf["y"].iloc[0]
        left = np.flatnonzero(side == 0)
        right = left if same else np.flatnonzero(side == 1)
        right = right[np.argsort(cut[right], kind="stable")]
        if not len(left) or not len(right):
            return pd.DataFrame({c: np.empty(0, np.int64) for c in TASK})
        cuts, starts = np.unique(cut[right], return_index=True)
        mine, at = np.unique(cut[left], return_inverse=True)
        to_right, to_left = np.zeros((len(left), len(cuts)), bool), np.zeros((len(right), len(mine)), bool)
        m, other, theirs = n[right], comp[right], bits[right]
        for p, i in enumerate(left):
            most = n[i] + m - 2 * least_overlap(n[i], m, percent)
            near = (comp[i] != other) & (100 * np.minimum(n[i], m) >= percent * np.maximum(n[i], m))
            near[near] = np.bitwise_count(theirs[near] ^ bits[i]).sum(axis=1, dtype=np.int64) <= most[near]
            if near.any():
                to_right[p] = np.logical_or.reduceat(near, starts)
                to_left[near, at[p]] = True
        i, c = np.nonzero(to_right)
        row, own, partner, where = left[i], cut[left[i]], cuts[c], np.zeros(len(i), np.int64)
        if not same:
            j, d = np.nonzero(to_left)
            row, own, partner = (np.concatenate(v) for v in (
                (row, right[j]), (own, cut[right[j]]), (partner, mine[d])))
            where = np.concatenate([where, np.ones(len(j), np.int64)])
        if nxt:
            x, y = np.where(where == 0, own, partner), np.where(where == 0, partner, own)
        else:
            x, y, where = np.minimum(own, partner), np.maximum(own, partner), (own > partner).astype(np.int64)
        return pd.DataFrame({"rid": rid[row], "family": family, "k": k, "x": x, "next": nxt, "y": y, "side": where})
    return run


TASK = ["rid", "family", "k", "x", "next", "y", "side"]


def _met(cut, cuts, above, below, chosen=lambda c: F.lit(True)):
    """The pairs of blocks of a row in block ``cut``: its own with each of its own class
    and of the classes next to it, as far as ``chosen``."""
    def each(many, pair):
        return F.transform(F.filter(F.sequence(F.lit(0), many), lambda c: (c < many) & chosen(c)), pair)

    own = each(cuts, lambda c: F.struct(
        F.col("klass").alias("k"), F.least(cut, c).alias("x"), F.lit(0).alias("next"), F.greatest(cut, c).alias("y"),
        F.when(cut <= c, 0).otherwise(1).alias("side")))
    up = each(above, lambda c: F.struct(
        F.col("klass").alias("k"), cut.alias("x"), F.lit(1).alias("next"), c.alias("y"), F.lit(0).alias("side")))
    down = each(below, lambda c: F.struct(
        (F.col("klass") - 1).alias("k"), c.alias("x"), F.lit(1).alias("next"), cut.alias("y"), F.lit(1).alias("side")))
    return F.explode(F.concat(own, up, down)).alias("t")


def _family_links(packs: DataFrame, member: DataFrame, sizes: DataFrame, known: DataFrame, shingle: int,
                  percent: int) -> DataFrame:
    """Links inside families, beside the ``known`` ones, that make up the same components
    as all links; ``member`` (rid, col) of columns with many rows."""
    # a family: rows that hang together by such columns
    least = member.groupBy("col").agg(F.min("rid").alias("m"))
    star = member.join(least.withColumnRenamed("col", "lc"), F.col("col") == F.col("lc")).select(
        F.col("m").alias("a"), F.col("rid").alias("b"))
    family = components(star)
    # the ratio of sizes puts a link into one class or two adjacent ones
    klass = F.floor(F.log(F.col("n").cast("double")) / F.lit(math.log(100 / percent)) + 1e-9).cast("int")
    rows = stored(family.join(sizes.withColumnRenamed("rid", "s_rid"), F.col("node") == F.col("s_rid")).select(
        F.col("node").alias("rid"), F.col("root").alias("family"), "n", klass.alias("klass")), "join-families")
    blocks = rows.groupBy(F.col("family").alias("bf"), F.col("klass").alias("bk")).agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS), F.ceil(F.sum("n") / BLOCK_ENTRIES)).cast("int").alias("cuts"))
    blocks = stored(blocks, "join-blocks")
    up = blocks.select(F.col("bf").alias("uf"), (F.col("bk") - 1).alias("uk"), F.col("cuts").alias("above"))
    down = blocks.select(F.col("bf").alias("df"), (F.col("bk") + 1).alias("dk"), F.col("cuts").alias("below"))
    plan = (blocks.join(up, (F.col("bf") == F.col("uf")) & (F.col("bk") == F.col("uk")), "left")
            .join(down, (F.col("bf") == F.col("df")) & (F.col("bk") == F.col("dk")), "left")
            .select("bf", "bk", "cuts", F.coalesce("above", F.lit(0)).alias("above"),
                    F.coalesce("below", F.lit(0)).alias("below")))
    cut = F.pmod(F.xxhash64("rid"), F.col("cuts")).cast("int")
    placed = rows.join(plan, (F.col("family") == F.col("bf")) & (F.col("klass") == F.col("bk"))).withColumn("cut", cut)

    def products(tasks: DataFrame) -> DataFrame:
        sets = _sets(packs, tasks.select("rid").distinct(), shingle).select(F.col("rid").alias("m_rid"), "members")
        return tasks.join(sets, F.col("rid") == F.col("m_rid")).drop("m_rid").groupBy(
            "family", "k", "x", "next", "y").applyInPandas(block_links(percent), "a long, b long")

    block, many, above, below = F.col("cut"), F.col("cuts"), F.col("above"), F.col("below")
    first = placed.select("rid", "family", _met(block, many, above, below, lambda c: (c == 0) | (block == 0)))
    links = stored(products(first.select("rid", "family", "t.*")), "join-first")
    others = placed.where("cut > 0")
    if others.isEmpty():
        return links
    # what links the first blocks have is known; the others meet as sketches
    roots = stored(components(known.union(links)), "join-first-roots")
    sketches = _sets(packs, others.select("rid"), shingle, sketch).select(F.col("rid").alias("m_rid"), "members")
    group = lambda c: F.ceil(c / SKETCH_BLOCKS).cast("int")
    meet = others.join(roots, F.col("rid") == F.col("node"), "left").select(
        "rid", "family", "n", "cut", F.coalesce("root", "rid").alias("comp"),
        _met(F.floor(block / SKETCH_BLOCKS).cast("int"), group(many), group(above), group(below)))
    asked = stored(meet.select("rid", "family", "n", "cut", "comp", "t.*").join(sketches, F.col("rid") == F.col("m_rid"))
                   .drop("m_rid").groupBy("family", "k", "x", "next", "y")
                   .applyInPandas(block_candidates(percent), "rid long, family long, k int, x int, next int, y int, side int"),
                   "join-asked").distinct()
    return links.union(products(asked))


# --- the operator ---------------------------------------------------------------

def join_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                   percent: int = PERCENT, hot: int = HOT) -> DataFrame:
    """rid, doc_id, n_shingles, component_id of every row (rid: a number of the row)."""
    spark, written = docs.sparkSession, P.new_table()
    packs, parts = P.packed(docs, id_col, text_col, table=written)
    rows = stored(_documents_and_table(packs, shingle), "join-rows")
    table = _column_table(rows)
    each = rows.where("kind = 0").select("rid", "doc_id", "n", "name")
    names = stored(each.where("name IS NOT NULL").groupBy("name").agg(
        F.min("rid").alias("rid"), F.min("doc_id").alias("least"), F.first("n").alias("n")), "join-names")
    # smaller sets than this link with equal ones only
    least = next((n for n in range(1, 10_000) if 100 * n >= percent * (n + 1)), 1 << 62)
    common = max(hot, each.count() // COMMON)
    asked = _postings(packs, names.where(F.col("n") >= least).select("rid"), parts, table, shingle, percent, least, common)
    found = stored(P.by_part(asked, parts).groupBy("part").applyInPandas(pairs_and_hot(percent, hot), PAIRS), "join-found")
    pairs = stored(accumulated(found), "join-pairs")
    links = stored(_counted_links(packs, pairs, shingle, percent), "join-links")
    member = found.where("kind = 1").select(F.col("a").alias("rid"), F.col("b").alias("col"))
    if not member.isEmpty():
        links = links.union(_family_links(packs, member, names.select("rid", "n"), links, shingle, percent))
    roots = stored(components(links), "join-roots")
    # what follows reads written tables of ids and names only
    P.drop(spark, written)
    labelled = stored(names.join(roots, F.col("rid") == F.col("node"), "left").select(
        "name", "least", F.coalesce("root", "rid").alias("root")), "join-labels")
    smallest = labelled.groupBy(F.col("root").alias("r")).agg(F.min("least").alias("component"))
    label = labelled.join(smallest, F.col("root") == F.col("r")).select(F.col("name").alias("l_name"), "component")
    return each.join(label, F.col("name") == F.col("l_name"), "left").select(
        "rid", "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("name").isNull(), F.col("doc_id")).otherwise(F.col("component")).alias("component_id"))


def drop_near_copies(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """One document of every component stays (the first row of the smallest id);
    documents without words stay. All columns unchanged.

    Rows without an id get none of their own here: a number of the row decides."""
    row = fresh("join_row", docs)
    base = stored(docs.withColumn(row, F.monotonically_increasing_id()), "join-documents")
    found = join_documents(base, id_col=row, text_col=text_col, **kw)
    keep = found.where("n_shingles = 0").select(F.col("doc_id").alias(f"{row}_k")).union(
        _first_rows(base, found, row, id_col))
    return base.join(keep, F.col(row) == F.col(f"{row}_k"), "left_semi").select(
        *[quoted(c) for c in docs.columns])


def _first_rows(base: DataFrame, found: DataFrame, row: str, id_col: str) -> DataFrame:
    ids = base.select(F.col(row).alias("i_row"), F.col(id_col).cast("long").alias("i_id"))
    some = found.where("n_shingles > 0").join(ids, F.col("doc_id") == F.col("i_row"))
    best = some.groupBy("component_id").agg(F.min(F.struct(
        F.col("i_id").isNull().alias("none"), "i_id", "i_row")).alias("best"))
    return best.select(F.col("best.i_row"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_documents(read_documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id")
