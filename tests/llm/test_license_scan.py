"""License scans (5): base places by brute force; templates with edits found, clean text not."""

import random
import re

from retailstar.llm import license_scan as L

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def base(t):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    w = WORD.findall(low)
    at, labels = [], set()
    for phrase, label in L.PHRASES.items():
        p = phrase.split()
        for i in range(len(w) - len(p) + 1):
            if w[i:i + len(p)] == p:
                at.append(i)
                labels.add(label)
    return len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


def filler(rnd, n):
    return " ".join(rnd.choice(["alpha", "béta", "of", "the", "42", "日本"]) + str(rnd.randrange(99)) for _ in range(n))


def edited(rnd, text):
    w = text.split()
    k = rnd.randrange(len(w) // 3, 2 * len(w) // 3)
    return " ".join(w[:k] + ["inserted", "words"] + w[k + 1:])


def test_rows(spark):
    rnd = random.Random(4)
    rows, planted = [], {}
    i = 0
    for label, texts in L.TEMPLATES.items():
        for t in texts:
            long = len(t.split()) > 20
            rows.append((i, f"{filler(rnd, 30)}\n{edited(rnd, t) if long else t}\n{filler(rnd, 20)} {t if long else ''}"))
            planted[i] = label
            i += 1
    clean = list(range(i, i + 20))
    rows += [(j, filler(rnd, 80) + " the license of the software") for j in clean]
    rows += [(900, None), (901, ""), (902, "cc by cc-by CC BY all rights reserved All Rights  Reserved!"), (903, "general public"),
             (902, "cc by cc-by CC BY all rights reserved All Rights  Reserved!"), (None, "ccé by cc_by")]
    df = spark.createDataFrame([(a, t, 3) for a, t in rows], "doc_id long, text string, score int").repartition(4)
    out = L.scan_documents(df, ["doc_id"]).collect()
    got = sorted([(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in out], key=str)
    assert got == sorted([(a, *base(t)) for a, t in rows], key=str)
    by = {r.doc_id: r for r in out}
    for j, label in planted.items():
        assert label in by[j].labels.split(","), (j, label, by[j])
        assert by[j].score >= L.MIN_SHARE
    assert all(by[j].labels == "" and by[j].score == 0.0 for j in clean)
    assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) for r in out)
    assert L.scan_documents(df.limit(0), ["doc_id"]).count() == 0


def test_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = L.query(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base(texts[r.doc_id])
        assert 0.0 <= r.score <= 1.0
        t = texts[r.doc_id]
        for line, label in (("Released under the MIT License.", "mit"), ("Licensed under CC BY-NC 4.0.", "cc-by-nc"),
                            ("Licensed under the Apache License, Version 2.0.", "apache-2.0")):
            if line in t:
                assert label in r.labels.split(",")
        if "icens" not in t and "ights reserved" not in t:
            assert r.labels == ""


def test_share_in_order():
    assert L.share_in_order(["a", "x", "b", "c"], ["a", "b", "c"]) == 1.0
    assert L.share_in_order([], ["a"]) == 0.0


CC_HTML = ('This work is licensed under a <a rel="license" href="http://creativecommons.org/licenses/by/4.0/">'
           "Creative Commons Attribution 4.0 International License</a>.")


def brute_chain(words, template, parts):
    """All sets of parts in order."""
    best = 0
    parts = sorted(parts, key=lambda x: (x[1], x[2]))
    for mask in range(1, 1 << len(parts)):
        n, last = 0, None
        for i, (d, lo, hi) in enumerate(parts):
            if mask >> i & 1:
                begin = lo
                if last:
                    if lo - last[2] > L.GAP or lo < last[1]:
                        break
                    begin = max(lo, last[2], last[2] - last[0] + d)
                    if begin >= hi:
                        break
                n += sum(words[x] == template[x - d] for x in range(begin, hi))
                last = (d, lo, hi)
        else:
            best = max(best, n)
    return best / len(template)


def test_chains_by_brute_force():
    rnd = random.Random(7)
    for _ in range(200):
        template = [f"w{rnd.randrange(6)}" for _ in range(14)]
        words = [rnd.choice(template) if rnd.random() < 0.5 else f"x{rnd.randrange(9)}" for _ in range(60)]
        parts = []
        for _ in range(rnd.randrange(2, 7)):
            t = rnd.randrange(11)
            n = rnd.randrange(3, min(8, 15 - t))
            lo = rnd.randrange(60 - n)
            words[lo:lo + n] = template[t:t + n]
            parts.append((lo - t, lo, lo + n))
        assert abs(L.chained_share(words, template, parts) - brute_chain(words, template, parts)) < 1e-9


def test_words_put_into_notices(spark):
    rnd = random.Random(9)
    rows, want = [(0, CC_HTML + " " + filler(rnd, 20))], {0: "cc-by-4.0"}
    for label in ("mit", "bsd", "isc", "mpl-2.0", "proprietary", "apache-2.0"):
        w = max(L.TEMPLATES[label], key=len).split()
        for n in (4, 8, 12):
            k = rnd.randrange(8, len(w) - 8)
            i = len(rows)
            rows.append((i, f"{filler(rnd, 40)} {' '.join(w[:k])} {filler(rnd, n)} {' '.join(w[k:])} {filler(rnd, 9)}"))
            want[i] = label
    # several places whose diagonals lie near each other; halves far apart or in the wrong order
    one = max(L.TEMPLATES["isc"], key=len)
    i = len(rows)
    rows.append((i, f"{' '.join(one.split()[:12])} {one} {one}"))
    want[i] = "isc"
    w = max(L.TEMPLATES["bsd"], key=len).split()
    clean = [i + 1, i + 2]
    rows.append((i + 1, f"{' '.join(w[:20])} {filler(rnd, 60)} {' '.join(w[20:])}"))
    rows.append((i + 2, f"{' '.join(w[20:])} {filler(rnd, 5)} {' '.join(w[:20])}"))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    by = {r.doc_id: r for r in L.scan_documents(df, ["doc_id"]).collect()}
    for j, label in want.items():
        assert label in by[j].labels.split(","), (j, label, by[j])
    assert all("bsd" not in by[j].labels for j in clean)


def test_long_text_of_many_hits(spark):
    rnd = random.Random(3)
    text = " ".join("in the software without " + filler(rnd, 3) for _ in range(30_000)) + " " + max(L.TEMPLATES["mit"], key=len)
    row = L.scan_documents(spark.createDataFrame([(1, text)], "doc_id long, text string"), ["doc_id"]).first()
    assert len(text) > 1_000_000 and row.labels == "mit" and row.n_words > 200_000
