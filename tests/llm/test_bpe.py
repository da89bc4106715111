"""BPE (1) against the tokenizers library and an exact round trip."""

import hashlib
import os
import pathlib
import random
import subprocess
import sys

import pytest

from retailstar.llm import bpe

PATH = bpe.default_path()
PARTS = ["abcdefghij", "the", "ing", "éàü", "0123", "!!!", "'s", " ", "\n", "  ", "<|endoftext|>", "日本", "😀", "aaaa",
         "'re", "==", "\x1c", " ", " "]


def whole(text):
    return bpe._tokenizer(PATH).encode(text, add_special_tokens=False).ids


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def random_text(rnd, n):
    return "".join(rnd.choice(PARTS[:rnd.choice([3, 6, len(PARTS)])]) for _ in range(rnd.randint(0, n)))


def test_chunks_joined_by_growing_windows_equal_the_whole():
    rnd = random.Random(1)
    for _ in range(1500):
        t = random_text(rnd, 60)
        runs = {}
        for run, _, _, raw, part in bpe.cut(t, PATH, rnd.choice([3, 5, 8, 20])):
            ids = bpe.encode_raw(part, PATH) if raw else bpe._encode_all([part], PATH)[0]
            runs[run] = bpe.join_tokens(runs[run], ids, PATH, window=1) if run in runs else ids
        assert [i for r in sorted(runs) for i in runs[r]] == whole(t)


def test_fast_encoder_equals_the_library():
    rnd = random.Random(2)
    texts = [random_text(rnd, 80) for _ in range(800)]
    assert bpe._encode_all(texts, PATH) == [whole(t) for t in texts]


@pytest.mark.parametrize("chunk", [16, 100_000])
def test_documents(spark, chunk):
    rnd = random.Random(chunk)
    rows = [(i, random_text(rnd, 200)) for i in range(40)]
    rows += [(100, None), (101, ""), (102, "x" * 5000), (103, " " * 900 + "z"), (104, rows[3][1]), (3, rows[3][1]),
             (None, "no id"), (105, "é" * 700 + "!" * 700), (106, "ab" * 333 + "'s"), (107, "x" * 5000)]
    df = spark.createDataFrame([(i, t, "clash") for i, t in rows], "doc_id long, text string, ids string").repartition(3)
    out = bpe.encode_documents(df.select("doc_id", "text"), ["doc_id"], chunk_chars=chunk, with_ids=True).collect()
    got = sorted([(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256, list(r.ids)) for r in out], key=str)
    want = []
    for i, t in rows:
        ids = whole(t or "")
        want.append((i, len(ids), sha(",".join(map(str, ids))), sha(t or ""), ids))
    assert got == sorted(want, key=str)


def test_short_texts_take_the_vocabulary_once():
    """A worker that cuts, encodes and spells plain texts loads one library's vocabulary."""
    code = ("from retailstar.llm import bpe; p = bpe.default_path(); t = 'a plain text <|endoftext|> of 7 words ' * 30; "
            "ids = bpe._encode_all([x[4] for x in bpe.cut(t, p, 100)], p); assert bpe._decode_all(ids, p); "
            "assert bpe._numbers(p)[-1] == '50256' and bpe._specials(p) == ('<|endoftext|>',); "
            "assert bpe._tokenizer.cache_info().currsize == 0")
    root = pathlib.Path(__file__).resolve().parents[2]
    subprocess.run([sys.executable, "-c", code], check=True, cwd=root, env=os.environ | {"PYTHONPATH": str(root)})


def test_long_texts_are_spelt_in_small_batches(spark):
    """A batch of more than a megabyte of ids is spelt in several pieces, with the same result."""
    texts = [f"w{i} " * 150_000 for i in range(4)]
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "sha string, text string").coalesce(1)
    got = {r.sha: r for r in bpe.encode_long(df, PATH, bpe.CHUNK_CHARS).collect()}
    for i, t in enumerate(texts):
        ids = whole(t)
        assert (got[str(i)].n_tokens, list(got[str(i)].ids), got[str(i)].decoded) == (len(ids), ids, t)
        assert got[str(i)].csv == ",".join(map(str, ids))


def test_empty_table(spark):
    assert bpe.encode_documents(spark.createDataFrame([], "doc_id long, text string"), ["doc_id"]).count() == 0


def test_query_over_the_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = bpe.query(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r.ids_sha256 == sha(",".join(map(str, whole(texts[r.doc_id])))) and r.decoded_sha256 == sha(texts[r.doc_id])
