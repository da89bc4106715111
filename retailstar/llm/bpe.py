"""BPE encoding and decoding (1): tree concatenation.

Short texts are encoded where they are read. A text longer than ``chunk_chars``
is cut where the pre-tokenizer surely splits (after a non-space before a space,
between an ASCII letter and digit, around special tokens); the chunks are
encoded in parallel tasks and simply follow each other. What cannot be cut that
way is one long unsplit pre-token: it is halved anywhere, the parts are encoded
in parallel, and a tree of joins puts neighbours together. A join re-encodes a
window around the seam and grows it until its first and last token agree with
what both sides had there. A sequence is the BPE result of its text exactly if
every two adjacent tokens are the result of their own text, so such agreement
makes the joined sequence exact.

Chunks are keyed by the text's SHA-256, so equal long texts are encoded once
and repeated rows need no row identity. A document's own tokens come together
in one row at the end, as its text did at the start.

Defined results: a null or empty text has no tokens (both digests are those of
the empty string); repeated rows each get their row.
"""

from __future__ import annotations

import json
import os
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SLICE_CHARS, annotate, quoted, read_documents, sha256, stored
from .words import slices

CHUNK_CHARS = 32_768
_SPACES = " \n\t\r"


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


@lru_cache(maxsize=4)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return tok


#: the byte-level pre-tokenizer's pattern (fixed value, public with the vocabulary)
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabularies:
    printable Latin-1 for itself, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@lru_cache(maxsize=4)
def _fast(path: str):
    """(encode, decode, special tokens, number of ids): the same vocabulary in the
    tiktoken library, about three times as fast. Only for plain byte-level BPE files,
    else None. Read from the file itself, so a worker that encodes short texts holds
    the vocabulary once and not in the other library, too."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre, model, added = spec.get("pre_tokenizer") or {}, spec["model"], spec.get("added_tokens") or []
    if (model.get("type") != "BPE" or spec.get("normalizer") or pre.get("type") != "ByteLevel" or model.get("ignore_merges")
            or pre.get("add_prefix_space", True) or not pre.get("use_regex", True) or model.get("dropout")
            or any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in added)):
        return None
    import tiktoken
    byte = _byte_alphabet()
    special = {t["content"]: t["id"] for t in added}
    ranks = {bytes(byte[c] for c in t): i for t, i in model["vocab"].items() if t not in special}
    enc = tiktoken.Encoding("byte-level", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def encode(text: str) -> list[int]:
        return enc.encode(text, allowed_special="all")

    def decode(ids: list[int]) -> bytes:
        return enc.decode_bytes(ids).decode("utf-8", "replace").encode("utf-8")

    return encode, decode, tuple(special), enc.n_vocab


def _encode_all(texts: list[str], path: str) -> list[list[int]]:
    fast = _fast(path)
    if fast:
        return [fast[0](t) for t in texts]
    return [e.ids for e in _tokenizer(path).encode_batch_fast(texts, add_special_tokens=False)]


def _decode_all(ids: list[list[int]], path: str) -> list[bytes]:
    fast = _fast(path)
    if fast:
        return [fast[1](i) for i in ids]
    return [t.encode("utf-8") for t in _tokenizer(path).decode_batch(ids, skip_special_tokens=False)]


@lru_cache(maxsize=4)
def _numbers(path: str) -> list[str]:
    fast = _fast(path)
    return [str(i) for i in range(fast[3] if fast else _tokenizer(path).get_vocab_size(with_added_tokens=True))]


@lru_cache(maxsize=4)
def _specials(path: str) -> tuple[str, ...]:
    fast = _fast(path)
    return fast[2] if fast else tuple(t.content for t in _tokenizer(path).get_added_tokens_decoder().values())


# --- cutting -----------------------------------------------------------------

def is_cut(text: str, p: int) -> bool:
    """The pre-tokenizer splits here whatever stands around."""
    a, b = text[p - 1], text[p]
    if b in _SPACES:
        return not a.isspace()
    return a.isascii() and b.isascii() and (a.isalpha() and b.isdigit() or a.isdigit() and b.isalpha())


def _segments(text: str, path: str, chunk: int) -> list[str]:
    """Safe cuts: chunks of at most ``chunk`` characters where cuts allow it."""
    # special tokens go first: they stand alone and nothing cuts them
    marks, at = [], 0
    for s in _specials(path):
        i = text.find(s)
        while i >= 0:
            marks.append((i, i + len(s)))
            i = text.find(s, i + len(s))
    out = []
    for lo, hi in [*sorted(marks), (len(text), len(text))]:
        if lo < at:
            continue
        while lo - at > chunk:
            p = at + chunk
            while p > at and not is_cut(text, p):
                p -= 1
            if p == at:
                p = at + chunk + 1
                while p < lo and not is_cut(text, p):
                    p += 1
            out.append(text[at:p])
            at = p
        if lo > at:
            out.append(text[at:lo])
        if hi > lo:
            out.append(text[lo:hi])
        at = hi
    return out


def cut(text: str, path: str, chunk: int) -> list[tuple[int, int, int, bool, str]]:
    """(run, node, nodes of the run, raw, text) of every chunk, in order.

    A run of several nodes is one unsplit pre-token in the byte alphabet
    (``raw``); all others are plain text between safe cuts.
    """
    out: list[tuple[int, int, int, bool, str]] = []
    plain: list[str] = []
    run = size = 0

    def flush() -> None:
        nonlocal run, size
        if plain:
            out.append((run, 0, 1, False, "".join(plain)))
            plain.clear()
            run, size = run + 1, 0

    for seg in _segments(text, path, chunk):
        if len(seg) <= chunk or seg in _specials(path):
            if size + len(seg) > chunk:
                flush()
            plain.append(seg)
            size += len(seg)
            continue
        flush()
        for piece, _ in _tokenizer(path).pre_tokenizer.pre_tokenize_str(seg):
            n = -(-len(piece) // chunk)
            for k in range(n):
                out.append((run, k, n, True, piece[k * chunk:(k + 1) * chunk]))
            run += 1
    flush()
    return out


# --- encoding and joining ------------------------------------------------------

def encode_raw(piece: str, path: str) -> list[int]:
    """Tokens of a part of one pre-token, given in the byte alphabet."""
    return [t.id for t in _tokenizer(path).model.tokenize(piece)]


def join_tokens(left: list[int], right: list[int], path: str, window: int = 8) -> list[int]:
    """The tokens of two neighbouring parts of one pre-token, put together."""
    name = _tokenizer(path).id_to_token
    while True:
        a, b = max(0, len(left) - window), min(len(right), window)
        mid = encode_raw("".join(map(name, left[a:] + right[:b])), path)
        if (not a or mid[0] == left[a]) and (b == len(right) or mid[-1] == right[b - 1]):
            return left[:a] + mid + right[b:]
        window *= 2


def _as_ids(blob: bytes) -> list[int]:
    return np.frombuffer(blob, np.int32).tolist()


def _join_pair(path: str):
    def join(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("node")
        first = pdf.iloc[0]
        ids = first["ids"]
        if len(pdf) == 2:
            ids = np.array(join_tokens(_as_ids(ids), _as_ids(pdf.iloc[1]["ids"]), path), np.int32).tobytes()
        return pd.DataFrame({"sha": [first["sha"]], "run": [first["run"]], "node": [first["node"] // 2],
                             "nodes": [(first["nodes"] + 1) // 2], "ids": [ids]})
    return join


_NODE = "sha string, run long, node long, nodes long, ids binary"


def encode_long(texts: DataFrame, path: str, chunk: int) -> DataFrame:
    """(sha, n_tokens, csv, decoded, ids) of texts (sha, text), each cut and joined as above."""

    def chunks(frames):
        for pdf in frames:
            for sha, text in zip(pdf["sha"], pdf["text"]):
                for row in cut(text, path, chunk):
                    yield pd.DataFrame([(sha, *row)], columns=["sha", "run", "node", "nodes", "raw", "part"])

    def encode(frames):
        for pdf in frames:
            # a chunk's ids are packed at once: as Python numbers they take ten times as much
            yield pdf[["sha", "run", "node", "nodes"]].assign(
                ids=[np.array(encode_raw(p, path) if raw else _encode_all([p], path)[0], np.int32).tobytes()
                     for raw, p in zip(pdf["raw"], pdf["part"])])

    parts = texts.mapInPandas(chunks, "sha string, run long, node long, nodes long, raw boolean, part string")
    # one row per chunk of a different text, dealt out evenly however long a text is
    parts = parts.groupBy("sha", "run", "node").agg(
        F.first("nodes").alias("nodes"), F.first("raw").alias("raw"), F.first("part").alias("part"))
    nodes = stored(parts.mapInPandas(encode, _NODE), "bpe-chunks")
    done = nodes.where("nodes = 1")
    open_ = nodes.where("nodes > 1")
    most = nodes.agg(F.max("nodes")).first()[0] or 1
    while most > 1:
        open_ = stored(open_.groupBy("sha", "run", F.expr("node div 2").alias("pair"))
                       .applyInPandas(_join_pair(path), _NODE), "bpe-join")
        most = (most + 1) // 2
    runs = done.unionByName(open_)

    def spell(frames):
        number = _numbers(path)
        for pdf in frames:
            blobs = pdf["ids"].tolist()
            for lo, hi in slices(blobs, SLICE_CHARS):
                ids = [_as_ids(b) for b in blobs[lo:hi]]
                yield pd.DataFrame({"sha": pdf["sha"].iloc[lo:hi].tolist(), "run": pdf["run"].iloc[lo:hi].tolist(),
                                    "n": [len(i) for i in ids],
                                    "csv": [",".join([number[j] for j in i]) for i in ids],
                                    "decoded": [d.decode("utf-8") for d in _decode_all(ids, path)],
                                    "ids": [np.frombuffer(b, np.int32) for b in blobs[lo:hi]]})

    spelt = runs.mapInPandas(spell, "sha string, run long, n long, csv string, decoded string, ids array<int>")
    whole = spelt.groupBy("sha").agg(F.sort_array(F.collect_list(
        F.struct("run", "n", "csv", "decoded", "ids"))).alias("r"))
    return whole.select(
        "sha", F.expr("aggregate(r, 0L, (a, x) -> a + x.n)").alias("n_tokens"),
        F.expr("array_join(transform(filter(r, x -> x.n > 0), x -> x.csv), ',')").alias("csv"),
        F.expr("array_join(transform(r, x -> x.decoded), '')").alias("decoded"),
        F.expr("flatten(transform(r, x -> x.ids))").alias("ids"))


def encode_documents(docs: DataFrame, keep: list[str], text_col: str = "text", path: str | None = None,
                     chunk_chars: int = CHUNK_CHARS, with_ids: bool = False) -> DataFrame:
    """``keep`` plus n_tokens, ids_sha256, decoded_sha256 (and ``ids``) of every whole text."""
    path = path or default_path()
    fields = {"n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string"}
    if with_ids:
        fields["ids"] = "array<int>"

    def short(texts: list) -> dict:
        number = _numbers(path)
        ids = _encode_all([t or "" for t in texts], path)
        decoded = _decode_all(ids, path)
        out = {"n_tokens": [len(i) for i in ids],
               "ids_sha256": [sha256(",".join([number[j] for j in i])) for i in ids],
               "decoded_sha256": [sha256(t) for t in decoded]}
        return out | ({"ids": ids} if with_ids else {})

    size = F.length(text_col)
    near = annotate(docs.where(size.isNull() | (size <= chunk_chars)), text_col, fields, short, keep)
    far = docs.where(size > chunk_chars)
    sha = F.sha2(F.encode(text_col, "UTF-8"), 256).alias("sha")
    long = encode_long(far.select(sha, F.col(text_col).alias("text")), path, chunk_chars).select(
        F.col("sha").alias("__sha"), F.col("n_tokens").alias("__n"),
        F.sha2(F.encode("csv", "UTF-8"), 256).alias("__i"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("__d"), F.col("ids").alias("__ids"))
    keep = [quoted(c) for c in keep]
    joined = far.select(*keep, sha.alias("__key")).join(long, F.col("__key") == F.col("__sha"))
    new = {"n_tokens": "__n", "ids_sha256": "__i", "decoded_sha256": "__d", "ids": "__ids"}
    return near.union(joined.select(*keep, *[F.col(new[f]).alias(f) for f in fields]))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(read_documents(spark, sf_dir), ["doc_id"])
