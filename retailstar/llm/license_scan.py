"""License scans (5): diagonal voting.

Every rolling word k-gram of every text is joined to the positions of the same
k-gram in the license templates; a hit votes for the offset diagonal (position
in the text less position in the template). Votes are added up per document,
template and diagonal; neighbouring diagonals (a word more or less shifts the
rest) are merged, and a merged span is verified word by word against its
template from every voted start. Spans of one template that follow each other in
order, with at most GAP words of text put between two of them, are chained and
count together (markup or words inserted into a notice). The template table is fixed text of a few hundred k-grams, so tasks
drop k-grams that no template has before anything is joined or shuffled.

Base phrases are counted at every place of the whole text; the method's labels
are added to theirs. ``score`` is the best share of a template's words found in
order in a verified span, 1.0 for a base phrase, 0.0 without any label.

Words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after lower-casing A-Z. Defined
results: a null or empty text has no words and no labels (empty strings, null
places); a very long text is scanned whole; repeated rows each get their row; an
empty table gives an empty result.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import words as W
from .common import annotate, quoted, read_documents, stored

# fixed values: phrases and labels of the base scan
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
# fixed values: public license notices, as they are written in files
TEMPLATES = {
    "apache-2.0": ["Licensed under the Apache License, Version 2.0.",
                   "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in"
                   " compliance with the License. You may obtain a copy of the License at"
                   " http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in"
                   " writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT"
                   " WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."],
    "mit": ["Released under the MIT License.", "Licensed under the MIT License.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and"
            " associated documentation files (the \"Software\"), to deal in the Software without restriction,"
            " including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense,"
            " and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so,"
            " subject to the following conditions: The above copyright notice and this permission notice shall be"
            " included in all copies or substantial portions of the Software."],
    "bsd": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided"
            " that the following conditions are met: Redistributions of source code must retain the above copyright"
            " notice, this list of conditions and the following disclaimer."],
    "isc": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is"
            " hereby granted, provided that the above copyright notice and this permission notice appear in all"
            " copies."],
    "gnu-gpl": ["This work is licensed under the GNU General Public License, version 3.",
                "This program is free software: you can redistribute it and/or modify it under the terms of the GNU"
                " General Public License as published by the Free Software Foundation, either version 3 of the"
                " License, or (at your option) any later version."],
    "gnu-lgpl": ["This library is free software; you can redistribute it and/or modify it under the terms of the GNU"
                 " Lesser General Public License as published by the Free Software Foundation."],
    "mpl-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of"
                " the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0.",
                 "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "cc-by-sa": ["Licensed under CC BY-SA 4.0.",
                 "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "cc-by-4.0": ["Licensed under CC BY 4.0.",
                  "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "unlicense": ["This is free and unencumbered software released into the public domain."],
    "proprietary": ["All rights reserved. No part of this publication may be reproduced, distributed, or transmitted"
                    " in any form or by any means without the prior written permission of the publisher."],
}
K = 3
#: diagonals this near each other belong to one span
SLACK = 3
#: words of text that may stand between two spans of a chain; templates that are chained have
#: at least CHAINED words (fewer could be put together from words of another notice)
GAP = 24
CHAINED = 12
#: share of a template's words that a verified span must hold in order
MIN_SHARE = 0.8


def _split(texts: list) -> W.Words:
    return W.split(W.utf8(texts), W.ALNUM_BYTES, lower=True)


def word_list(text: str) -> list[str]:
    w = _split([text])
    return [w.buf[s:e].tobytes().decode("utf-8", "replace") for s, e in zip(w.start, w.end)]


@lru_cache(maxsize=1)
def _templates() -> tuple[list[tuple[str, list[str]]], np.ndarray, np.ndarray, np.ndarray]:
    """(label, words) per template; sorted k-gram hashes with template and position."""
    out = [(label, word_list(t)) for label, ts in TEMPLATES.items() for t in ts]
    grams, tmpl, pos = [], [], []
    for i, (_, ws) in enumerate(out):
        g = W.grams(_split([" ".join(ws)]).hashes(), K)
        grams.append(g)
        tmpl += [i] * len(g)
        pos += range(len(g))
    g = np.concatenate(grams)
    order = np.argsort(g, kind="stable")
    return out, g[order], np.array(tmpl)[order], np.array(pos)[order]


def template_positions(spark: SparkSession) -> DataFrame:
    """(gram, template, t_pos): one row per template word, a fixed few hundred."""
    _, g, tmpl, pos = _templates()
    return spark.createDataFrame(
        [(int(a), int(b), int(c)) for a, b, c in zip(g.view(np.int64), tmpl, pos)],
        "gram long, template int, t_pos int")


@lru_cache(maxsize=1)
def _phrase_grams() -> list[tuple[str, int, np.uint64]]:
    out = []
    for phrase, label in PHRASES.items():
        n = len(phrase.split())
        out.append((label, n, W.grams(_split([phrase]).hashes(), n)[0]))
    return out


def _within(g: np.ndarray, w: W.Words, doc: np.ndarray, n: int) -> np.ndarray:
    """Marks n-grams whose words are all of one text."""
    return doc[:len(g)] == doc[n - 1:] if len(g) else np.zeros(0, bool)


BASE = {"n_words": "long", "n_base": "long", "first_word": "long", "last_word": "long", "base_labels": "string"}
HITS = {"hit_pos": "array<int>", "hit_gram": "array<long>", "from_word": "int", "span_words": "array<string>"}


def base_and_hits(texts: list) -> dict:
    w = _split(texts)
    h, doc, n = w.hashes(), w.doc(), len(texts)
    places: list[list[int]] = [[] for _ in range(n)]
    labels: list[set[str]] = [set() for _ in range(n)]
    for label, size, want in _phrase_grams():
        g = W.grams(h, size)
        for i in np.flatnonzero((g == want) & _within(g, w, doc, size)).tolist():
            places[doc[i]].append(i - int(w.first[doc[i]]))
            labels[doc[i]].add(label)
    out = {"n_words": w.counts, "n_base": [len(p) for p in places],
           "first_word": [min(p) if p else None for p in places],
           "last_word": [max(p) if p else None for p in places],
           "base_labels": [",".join(sorted(x)) for x in labels],
           "hit_pos": [None] * n, "hit_gram": [None] * n, "from_word": [None] * n, "span_words": [None] * n}
    _, known, _, _ = _templates()
    g = W.grams(h, K)
    at = np.minimum(np.searchsorted(known, g), len(known) - 1)
    hit = np.flatnonzero((known[at] == g) & _within(g, w, doc, K))
    for d in np.unique(doc[hit]).tolist():
        mine = hit[doc[hit] == d]
        lo, hi = max(int(w.first[d]), int(mine[0]) - K), min(int(w.first[d + 1]), int(mine[-1]) + 2 * K)
        base = int(w.first[d])
        out["hit_pos"][d] = (mine - base).tolist()
        out["hit_gram"][d] = g[mine].view(np.int64).tolist()
        out["from_word"][d] = lo - base
        out["span_words"][d] = [w.buf[s:e].tobytes().decode("utf-8", "replace")
                                for s, e in zip(w.start[lo:hi], w.end[lo:hi])]
    return out


def diagonals(hits: DataFrame, templates: DataFrame) -> DataFrame:
    """(row, template, lo, hi, votes, parts) of (row, hit_pos, hit_gram): votes per
    diagonal, neighbouring diagonals merged; a part is a diagonal with its places."""
    each = hits.select("row", F.explode(F.arrays_zip("hit_pos", "hit_gram")).alias("x")).select(
        "row", F.col("x.hit_pos").alias("pos"), F.col("x.hit_gram").alias("h_gram"))
    # the template table is fixed text (a few hundred rows)
    votes = each.join(F.broadcast(templates), F.col("h_gram") == F.col("gram")).groupBy(
        "row", "template", (F.col("pos") - F.col("t_pos")).alias("diagonal")).agg(
        F.count(F.lit(1)).alias("votes"), F.min("pos").alias("lo"), F.max("pos").alias("hi"))
    w = Window.partitionBy("row", "template").orderBy("diagonal")
    new = (F.col("diagonal") - F.lag("diagonal").over(w) > SLACK).cast("int")
    runs = votes.withColumn("new", F.coalesce(new, F.lit(0))).withColumn("run", F.sum("new").over(w))
    return runs.groupBy("row", "template", "run").agg(
        F.sum("votes").alias("votes"), F.min("lo").alias("lo"), (F.max("hi") + K).alias("hi"),
        F.collect_list(F.struct("diagonal", "lo", (F.col("hi") + K).alias("hi"))).alias("parts")).drop("run")


def share_in_order(found: list[str], template: list[str]) -> float:
    """Longest common subsequence of words, as a share of the template."""
    row = [0] * (len(template) + 1)
    for f in found:
        prev = 0
        for j, t in enumerate(template, 1):
            prev, row[j] = row[j], prev + 1 if f == t else max(row[j], row[j - 1])
    return row[-1] / len(template)


def chained_share(words: list[str], template: list[str], parts: list[tuple[int, int, int]]) -> float:
    """Most template words in a chain of parts (diagonal, lo, hi), as a share of the template.

    Parts follow each other in the text and in the template; words count where they
    stand on their part's diagonal.
    """
    parts = sorted(parts, key=lambda x: (x[1], x[2]))
    same = []
    for d, lo, hi in parts:
        marks = [words[x] == template[x - d] for x in range(lo, hi)]
        same.append([0, *accumulate(marks)])
    score, best, first = [], 0, 0
    for j, (d, lo, hi) in enumerate(parts):
        score.append(same[j][-1])
        # an earlier part spans the template at most
        while parts[first][1] < lo - GAP - len(template):
            first += 1
        for i in range(first, j):
            e, _, end = parts[i]
            # after the earlier part in the text and in the template
            begin = max(lo, end, end - e + d)
            if begin < hi and lo - end <= GAP:
                score[j] = max(score[j], score[i] + same[j][-1] - same[j][begin - lo])
        best = max(best, score[j])
    return best / len(template)


def verified(span_words: list[str], from_word: int, spans: list[dict], min_share: float) -> tuple[set[str], float]:
    labels, best = set(), 0.0
    parts: dict[int, list[tuple[int, int, int]]] = {}
    shares = []
    for s in spans:
        template = _templates()[0][s["template"]][1]
        lo, hi = s["lo"] - from_word, s["hi"] - from_word
        mine = [(p["diagonal"] - from_word, p["lo"] - from_word, p["hi"] - from_word) for p in s["parts"]]
        parts.setdefault(s["template"], []).extend(mine)
        pad = SLACK if len(template) > 2 * K else 0
        if hi - lo + 2 * pad < min_share * len(template):
            continue
        # a span much longer than its template holds several places of it
        short = hi - lo <= len(template) + 2 * SLACK
        for a in [lo] if short else sorted({max(d, lo) for d, _, _ in mine}):
            a = max(0, a - pad)
            shares.append((s["template"], share_in_order(
                span_words[a:min(a + len(template) + 2 * SLACK, hi + pad)], template)))
    shares += [(i, chained_share(span_words, _templates()[0][i][1], x)) for i, x in parts.items()
               if len(_templates()[0][i][1]) >= CHAINED and len(x) > 1]
    for i, share in shares:
        if share >= min_share:
            labels.add(_templates()[0][i][0])
            best = max(best, share)
    return labels, best


def scan_documents(docs: DataFrame, keep: list[str], text_col: str = "text", min_share: float = MIN_SHARE) -> DataFrame:
    """``keep`` plus base counts, labels and score of every whole text."""
    spark = docs.sparkSession
    named = docs.select(*[F.col(quoted(c)).alias(f"k__{i}") for i, c in enumerate(keep)], F.col(text_col).alias("text"))
    kept = [f"k__{i}" for i in range(len(keep))]
    rows = stored(annotate(named, "text", BASE | HITS, base_and_hits, kept).withColumn(
        "row", F.monotonically_increasing_id()), "license-rows")
    hits = rows.where("hit_pos IS NOT NULL")
    spans = diagonals(hits, template_positions(spark)).groupBy(F.col("row").alias("s_row")).agg(
        F.collect_list(F.struct("template", "lo", "hi", "votes", "parts")).alias("spans"))

    def verify(frames):
        for pdf in frames:
            got = [verified(list(ws), int(f), [s if isinstance(s, dict) else s.asDict() for s in ss], min_share)
                   for ws, f, ss in zip(pdf["span_words"], pdf["from_word"], pdf["spans"])]
            yield pd.DataFrame({"v_row": pdf["row"], "more": [sorted(g[0]) for g in got], "share": [g[1] for g in got]})

    more = hits.select("row", "span_words", "from_word").join(spans, F.col("row") == F.col("s_row")).select(
        "row", "span_words", "from_word", "spans").mapInPandas(verify, "v_row long, more array<string>, share double")
    base = F.filter(F.split("base_labels", ","), lambda x: x != "")
    out = rows.select(*kept, "row", *BASE).join(more, F.col("row") == F.col("v_row"), "left")
    return out.select(*[F.col(k).alias(c) for k, c in zip(kept, keep)], *BASE, F.array_join(F.array_sort(
        F.array_distinct(F.concat(base, F.coalesce("more", F.array().cast("array<string>"))))), ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_documents(read_documents(spark, sf_dir), ["doc_id"])
