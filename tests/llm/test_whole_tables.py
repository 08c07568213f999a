"""Operators that once left rows out or cut texts, against brute force."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from splicedf.llm import license_scan, quality_rules, token_tables
from tests.llm.test_operators import ws, xx, xx_pair


def quality_scores(rows, labels):
    """The scores by brute force, each document against all others."""
    buckets = quality_rules.BUCKETS
    trusted = {i for i, q, t in labels if q == 1 and not t}
    grams = []
    for _, text in rows:
        h = [xx(w.encode()) for w in ws(text)]
        grams.append(Counter(x % buckets for x in h + [xx_pair(a, b) for a, b in zip(h, h[1:])]))
    out = []
    for (i, _), own in zip(rows, grams):
        raw, good = Counter(), Counter()
        for (j, _), g in zip(rows, grams):
            if g is not own:
                raw += g
                good += g if j in trusted else Counter()
        share = sum(good.values()) / max(1, sum(raw.values()))
        weight = lambda b: math.log((good[b] + quality_rules.PRIOR) / (share * raw[b] + quality_rules.PRIOR))  # noqa: B023, E731
        out.append((i, sum(c * round(weight(b) * quality_rules.SCALE) for b, c in own.items())))
    return out


def test_quality_scores_leave_own_counts_out(spark):
    r = random.Random(3)
    rows = [(i, " ".join(r.choice("abcdefgh") * r.randint(1, 2) for _ in range(r.randint(0, 40)))) for i in range(30)]
    rows += [(30, None), (31, ""), (32, rows[0][1]), (33, "own words alone here")]
    labels = [(i, int(i % 3 > 0), int(i % 7 == 0)) for i in range(20)] + [(33, 1, 0)]
    d, lab = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = quality_rules.judged(d, lab).select("doc_id", "gram_score").collect()
    assert sorted(map(tuple, got)) == sorted(quality_scores(rows, labels))
    assert {x["gram_score"] for x in quality_rules.judged(d, lab.limit(0)).collect()} == {0}


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
@pytest.mark.parametrize("parts", [2, 5, 10])
def test_quality_keeps_clean_documents(spark, sf, parts):
    """One part of the labels is given; of the clean documents of the rest nearly all stay."""
    d, lab = (spark.read.parquet(f"/root/testdata/{sf}/{t}.parquet") for t in ("documents", "labels"))
    part = F.pmod(F.xxhash64("doc_id"), F.lit(parts)) == 0
    out = quality_rules.judged(d.select("doc_id", "text"), lab.filter(part)).filter("NOT base_failed").join(lab.filter(~part), "doc_id")
    n, kept = out.filter("quality = 1 AND toxic = 0").agg(F.count("*"), F.sum(F.col("kept").cast("int"))).first()
    assert n > 20 and kept >= 0.97 * n


def test_added_tokens_are_encoded_as_the_library_does():
    P = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = P.path("byte_bpe_50k.json")
    t, c = Tokenizer.from_file(path), token_tables.Coder(path)
    assert [*memoryview(c.encoded("a <|endoftext|> b")).cast("H")] == [64, 220, 50256, 275]
    for text in ("<|endoftext|>", "x<|endoftext|><|endoftext|>y z", "a\nb <|endoftext|>", "a <|endof text|> b", "it's 12,5 plain words\nand more", "a  <|endoftext|>\n\nb"):
        assert [*memoryview(c.encoded(text)).cast("H")] == t.encode(text, add_special_tokens=False).ids


GPL3 = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.

You should have received a copy of the GNU General Public License
along with this program.  If not, see <https://www.gnu.org/licenses/>."""
BSD3 = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission."""
MIT = """MIT License

Copyright (c) 2020 Some One

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE."""


def test_licence_notices_as_they_are_usual(spark):
    notices = {"GPL-3.0-or-later": (GPL3, "gpl-free,gpl-hope,gpl-received"), "BSD-3-Clause": (BSD3, "bsd-grant,bsd-source,bsd-binary,bsd-name"), "MIT": (MIT, "mit-ref,mit-grant,mit-notice,mit-as-is")}
    rows = [(mark + text.replace("\n", "\n" + mark), ids, name) for name, (text, ids) in notices.items() for mark in ("", "# ", " * ", "//   ", "    ")]
    rows += [(s + end, i, None) for i, of in license_scan.SENTENCES.items() for s in of for end in ("", ".", ".\nMore text")]
    rows += [("All rights\nreserved.", "reserved", None), ("ALL  RIGHTS  RESERVED", "reserved", None), ("This is free and unencumbered software released into the public domain.", "unlicense", "Unlicense")]
    rows += [("MIT License\nCopyright (c) 2020 A", "mit-ref", "MIT"), ("not all rights reserved", "", ""), ("all rights reserved by me", "", "")]
    d = spark.createDataFrame([(k, r[0]) for k, r in enumerate(rows)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in license_scan.licensed(d).collect()}
    for k, (text, ids, name) in enumerate(rows):
        assert got[k]["sentence_ids"] == ids, text
        assert name is None or got[k]["licenses"] == name, text
