"""Tokens, mixing, quality, URLs, licences and the pipeline against plain versions."""

import random
import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ordermill.llm import quality, queries, url_rules
from ordermill.llm.bpe import SETTLED, Encoder, Places, stretches
from ordermill.llm.frames import new_path
from ordermill.llm.licenses import JOINED, RULES, SENTENCES, scan
from ordermill.llm.mixing import mix, mixed_rows, water_filled, weighed
from ordermill.llm.quality import clean_only, judged
from ordermill.llm.token_counts import common_cut, count_tokens, spliced, with_offsets
from ordermill.llm.token_files import encoded_once, pack, read_tokens, unpack, with_starts, write_tokens
from ordermill.llm.url_rules import filter_urls, matched, mined_rules

from . import brute
from tests.conftest import plan, tuples

BPE = public_tokenizers.path("byte_bpe_50k.json")
ODD = "ab1 2.,'  \n\t\r'strevldm't\x85\xa0é½²ªß-_\x1c\x00Ā中😀"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BPE)


@pytest.fixture(scope="module")
def encoder():
    return Encoder(BPE)


def plain_ids(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def strange_texts(n=4000):
    pick = random.Random(4)
    settled = [chr(c) for c in range(SETTLED)]
    return (["".join(pick.choice(ODD) for _ in range(pick.randint(0, 25))) for _ in range(n)]
            + ["".join(pick.choice(settled) for _ in range(20)) for _ in range(n)]
            + ["<|endoftext|> a", "a <|endoftext|>b", "<|endo", "", "'s", " 's", "it's we've I'LL they'd'd", "a\n\n b", "  "])


def test_pieces_give_the_librarys_ids(encoder, library):
    texts = strange_texts()
    ids, before = encoder.encode(texts)
    for k, text in enumerate(texts):
        assert ids[before[k]:before[k + 1]].tolist() == plain_ids(library, text), repr(text)


def test_forgetting_changes_nothing(library):
    small = Encoder(BPE)
    small.REMEMBERED = 5
    for text in ("one two three", "four five six seven", "one two three"):
        assert small.encode([text])[0].tolist() == plain_ids(library, text)


def test_places_of_keys():
    rng = np.random.default_rng(5)
    keys = np.unique(rng.integers(0, 2**64, 3000, np.uint64))
    keys = np.concatenate([keys, np.arange(40, dtype=np.uint64), np.uint64(2**64 - 1) - np.arange(40, dtype=np.uint64)])  # crowds at both ends of the table
    rng.shuffle(keys)
    places = Places(4)
    for part in np.split(keys, [1, 7, 8, 900]):
        assert (places.find(part) == -1).all()
        places.add(part)
    assert len(places) == len(keys) and (places.find(keys) == np.arange(len(keys))).all()
    assert (places.find(keys + np.uint64(2**40)) == -1).all() and len(places.find(keys[:0])) == 0


@pytest.mark.parametrize("chunk,together", [(1, 1), (20, 50), (300, 10_000)])
def test_stretches_of_long_texts(encoder, library, chunk, together):
    pick = random.Random(chunk)
    texts = ["".join(pick.choice(ODD + "     abcdefgh") for _ in range(pick.randint(0, 900))) + "<|endoftext|>" * (k % 3) + " unbroken" * (k % 40) for k in range(60)]
    ids, before = encoded_once(encoder, texts, chunk, together)
    assert len(before) == len(texts) + 1
    for k, text in enumerate(texts):
        assert "".join(stretches(text, chunk)) == text
        assert ids[before[k]:before[k + 1]].tolist() == plain_ids(library, text), repr(text)


def test_known_pieces_of_long_texts_need_no_library(library):
    encoder, text = Encoder(BPE), "a plain text " * 10_000
    encoded_once(encoder, [text])
    encoder.library = None
    assert encoded_once(encoder, ["", text])[0].tolist() == plain_ids(library, text)


@pytest.mark.parametrize("chunk,overlap", [(20, 2), (64, 8), (300, 1)])
def test_spliced_chunks(encoder, library, chunk, overlap):
    pick = random.Random(chunk)
    for k in range(60):
        text = "".join(pick.choice(ODD + "     abcdefgh") for _ in range(pick.randint(0, 900)))
        text += "<|endoftext|>" * (k % 3) + "unbroken" * (k % 40)
        assert spliced(with_offsets(encoder), text, chunk, overlap).tolist() == plain_ids(library, text)


def test_cuts_stand_before_a_blank_after_something_solid():
    assert common_cut("ab cd", np.array([0, 2]), np.array([2]), 0, 5) == 2
    assert common_cut("ab  cd", np.array([0, 2, 3]), np.array([3]), 0, 5) is None


def test_count_tokens(documents, prose, library):
    want = sorted(((key, len((text or "").encode()), n := len(plain_ids(library, text)), n > 50) for key, text in prose), key=repr)
    assert tuples(count_tokens(documents, BPE, limit=50)) == want
    assert tuples(count_tokens(documents, BPE, limit=50, chunk=200, overlap=10)) == want


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "piece_bpe_32k.model"])
def test_other_tokenizers(spark, name):
    import sentencepiece

    path = public_tokenizers.path(name)
    texts = ["Hello there, it's   fine", "", "día 日本", "a" * 300]
    if name.endswith("json"):
        want = [len(Tokenizer.from_file(path).encode(t, add_special_tokens=False).ids) for t in texts]
    else:
        want = [len(x) for x in sentencepiece.SentencePieceProcessor(model_file=path).encode(texts, num_threads=1)]
    got = count_tokens(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), path)
    assert [r.n_tokens for r in got.orderBy("doc_id").collect()] == want


@pytest.mark.parametrize("n", [0, 1, 3, 4, 5, 1000])
def test_codes_round_trip(n):
    ranks = np.random.default_rng(n).integers(0, [256, 2**16, 2**24, 2**32][n % 4], n).astype(np.uint32)
    control, data = pack(ranks)
    assert len(control) == -(-n // 4)
    assert (unpack(control, data, n) == ranks).all()


def test_code_bytes():
    assert pack(np.array([1, 256, 65536, 16777216, 7], np.uint32)) == (bytes([0b11100100, 0]), bytes([1, 0, 1, 0, 0, 1, 0, 0, 0, 1, 7]))


def test_token_files(spark, documents, prose, library):
    folder = new_path(spark, "test")
    write_tokens(documents, folder, BPE, end_id=2)
    rows = with_starts(read_tokens(spark, folder)).orderBy("start").collect()
    assert [r.doc_id for r in rows] == sorted((key for key, _ in prose), key=lambda k: (k is not None, k or 0))
    assert [r.start for r in rows] == [0, *np.cumsum([r.n_tokens for r in rows])[:-1].tolist()]
    assert sorted((repr(r.doc_id), tuple(r.ids)) for r in rows) == sorted((repr(key), (*plain_ids(library, text), 2)) for key, text in prose)
    digest = {(r.position, r.ids_crc32) for r in read_tokens(spark, folder, digest=True).collect()}
    assert digest == {(r.position, zlib.crc32(np.array(r.ids, "<u4").tobytes())) for r in rows}
    counts = Counter(i for r in rows for i in r.ids)
    ranks = [r.token for r in spark.read.parquet(f"{folder}/ranks").orderBy("rank").collect()]
    assert ranks == sorted(counts, key=lambda t: (-counts[t], t))


def test_empty_token_files(spark, nothing):
    folder = new_path(spark, "test")
    write_tokens(nothing, folder, BPE)
    assert with_starts(read_tokens(spark, folder)).count() == 0
    assert count_tokens(nothing, BPE).count() == 0


@pytest.mark.parametrize("share,epochs", [(1.5, 2), (0.5, 1), (3.0, 2), (1.0, 1)])
def test_water_filling(spark, share, epochs):
    sizes = {"a": 1000, "b": 10, "c": 0, "d": 500, "é": 77, "z": 3000, None: 40}
    sources = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in water_filled(weighed(sources, (3, 1, 2)), share, epochs).collect()}
    weights = dict(zip(sorted(sizes, key=lambda s: (s is None, s or "")), (3, 1, 2, 3, 1, 2, 3)))
    capped = brute.poured(sizes, weights, share, epochs)
    assert got == pytest.approx({s: min(t, epochs * sizes[s]) for s, t in capped.items()})


def test_named_weights(spark):
    sources = spark.createDataFrame([("a", 10), ("b", 10), (None, 10)], "source string, source_size long")
    got = {r.source: r.target for r in water_filled(weighed(sources, {"a": 1, None: 2}), 0.5, 2).collect()}
    assert got == pytest.approx({"a": 5.0, "b": 0.0, None: 10.0})


def test_mix(documents, prose):
    rows = mix(documents, (3, 1, 2)).collect()
    assert sorted((repr(r.doc_id), r.size) for r in rows) == sorted((repr(key), len(brute.WORD.findall(text or ""))) for key, text in prose)
    assert all(0 <= r.taken <= 2 * r.size and r.taken == r.size * r.repeats for r in rows)
    for source in {r.source for r in rows}:
        own = [r for r in rows if r.source == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= max(r.size for r in own) / 2 + 1e-6
        assert sum(r.size for r in own) == own[0].source_size
    assert Counter(map(tuple, rows)) == Counter(map(tuple, mix(documents.repartition(7), (3, 1, 2)).collect()))


def test_slices_of_a_source_change_nothing(documents, monkeypatch):
    from ordermill.llm import mixing

    whole = tuples(mix(documents, (1, 1, 1)))
    monkeypatch.setattr(mixing, "SLICE_ROWS", 3)
    assert tuples(mix(documents, (1, 1, 1))) == whole


def test_mixed_rows(documents):
    rows = mixed_rows(documents, (3, 1, 2))
    assert rows.columns == documents.columns
    want = Counter()
    for r in mix(documents, (3, 1, 2)).collect():
        want[repr(r.doc_id)] += r.repeats
    assert Counter(repr(r.doc_id) for r in rows.collect()) == +want


def test_empty_mix(nothing):
    assert mix(nothing, (1,)).count() == mixed_rows(nothing, (1,)).count() == 0


def test_base_counts(documents, prose, spark):
    trusted = spark.createDataFrame([(k,) for k in range(40)], "doc_id long")
    got = judged(documents, trusted).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert tuples(got) == sorted(((key, *brute.quality(text)) for key, text in prose), key=repr)


def test_lines_and_symbols(spark):
    rows = [(1, "a b\n \na b\nc#|\na b\n"), (2, "a b c d e f a b c d e a b c d e x"), (3, "<|>%$*&#")]
    got = judged(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([], "doc_id long"))
    assert {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.score) for r in got.collect()} == {
        k: (*brute.quality(text), 0.0) for k, text in rows}


def test_base_counts_of_odd_texts(spark):
    texts = ["", " \t", "\n\n", "a b c d e", "a b c d e a b c d e", "é ü\u00a0x\n é ü\u00a0x\né ü\u00a0x\n", "x " * 9, "\u2028 # 漢字 😀 <\r\n#\r\n#",
             "q w e r t\n" * 4, "0 1 2 3 4 5 6 0 1 2 3 4 9 2 3 4 5 6"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = judged(rows, rows.select("doc_id").limit(0)).drop("score", "kept")
    assert tuples(got) == sorted(((k, *brute.quality(text)) for k, text in enumerate(texts)), key=repr)


def test_words_are_cut_once_and_sorted_without_lambdas(documents, spark):
    for rows in (judged(documents, spark.range(1).toDF("doc_id")), clean_only(documents, spark.range(1).toDF("doc_id"))):
        assert r", [\x20\x09-\x0D]" not in plan(rows) and "array_sort" not in plan(rows)


def test_scores_part_junk_from_clean_text(spark):
    pick = random.Random(1)
    clean = lambda: " ".join(pick.choice(["river", "stone", "light", "under", "grows", "slowly", "the", "a"]) + str(pick.randint(0, 99)) for _ in range(40)) + "."
    junk = lambda: " ".join(pick.choice(["WIN", "FREE", "CLICK"]) + "!!" + str(pick.randint(0, 999)) for _ in range(40))
    rows = [(k, clean() if k % 3 else junk()) for k in range(600)]
    trusted = spark.createDataFrame([(k,) for k in range(600) if k % 3 and k % 2], "doc_id long")
    got = judged(spark.createDataFrame(rows, "doc_id long, text string"), trusted).collect()
    assert {r.doc_id for r in got if not r.kept} == {k for k in range(0, 600, 3)}


def test_score_is_the_mean_weight(spark, documents, prose):
    trusted = spark.createDataFrame([(k,) for k in range(20)] + [(3,), (None,)], "doc_id long")
    weights = quality.fitted(documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), trusted)
    assert len(weights) == quality.BUCKETS
    low, high = weights.min(), weights.max()
    assert all(low <= r.score <= high or r.score == 0 for r in judged(documents, trusted).collect())


def test_clean_only(documents, spark, nothing):
    trusted = spark.createDataFrame([(k,) for k in range(40)], "doc_id long")
    rows = clean_only(documents, trusted)
    assert rows.columns == documents.columns
    assert Counter(repr(r.doc_id) for r in rows.collect()) == Counter(repr(r.doc_id) for r in judged(documents, trusted).where("kept").collect())
    assert clean_only(nothing, trusted).count() == judged(nothing, trusted).count() == 0


RULES_OF_URLS = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"))


def test_url_parts_and_rules(spark):
    urls = {
        1: ("https://WWW.Example.com/en/x?y=/de/", "www.example.com", "/en/x", "www.example.com/en/", "allow"),
        2: ("http://a.example.com/en/", "a.example.com", "/en/", "example.com/en/", "block"),
        3: ("http://a.example.com/en", "a.example.com", "/en", "com/", "allow"),
        4: ("http://badexample.com/en/", "badexample.com", "/en/", "com/", "allow"),
        5: ("http://x.net#/es/", "x.net", "", None, "allow"), 6: ("http://x.net/es/1#f://q/", "x.net", "/es/1", "net/es/", "block"),
        7: ("no scheme", "", "", None, "allow"), 8: (None, "", "", None, "allow"), 9: ("://com/", "com", "/", "com/", "allow"),
        10: ("http://É.com", "É.com", "", None, "allow"), 11: ("a://b\nc.net/es/?://d/", "b\nc.net", "/es/", "net/es/", "block"), 12: ("", "", "", None, "allow")}
    pages = spark.createDataFrame([(k, v[0], "h", "c") for k, v in urls.items()], "page_id long, url string, host string, rule string")
    pages = pages.union(pages.where("page_id in (2, 8)"))
    got = filter_urls(pages, spark.createDataFrame([], "url string, bad boolean"), RULES_OF_URLS)
    assert Counter(tuple(r)[:5] for r in got.collect()) == Counter((k, *urls[k][1:]) for k in [*urls, 2, 8])
    assert filter_urls(pages.limit(0), spark.createDataFrame([], "url string, bad boolean"), RULES_OF_URLS).count() == 0


def labelled_urls(spark):
    pick = random.Random(6)
    rows = []
    for k in range(900):
        host, ending, query = pick.choice(["alpha", "beta", "gamma"]), pick.choice(["html", "php"]), pick.choice(["ref", "page"])
        bad = pick.random() < (0.95 if host == "beta" and query == "ref" else 0.05)
        rows.append((f"https://{host}.site.org/{k}/{pick.choice('abcdef')}.{ending}?{query}=1", bad))
    return spark.createDataFrame(rows + [(None, True)], "url string, bad boolean")


def test_mined_rules_are_the_confident_ones(spark):
    rows = labelled_urls(spark)
    rules = [(set(r.rule), r.confidence, r.key) for r in mined_rules(rows, support=0.02, confidence=0.8).collect()]
    assert any(rule == {"host:beta", "query:ref"} for rule, _, _ in rules)
    assert all({"host:beta", "query:ref"} <= rule and confidence >= 0.8 and key in rule for rule, confidence, key in rules)
    assert all(not any(other < rule and sure >= confidence for other, sure, _ in rules) for rule, confidence, _ in rules)
    found = {r.url for r in matched(rows.select("url"), mined_rules(rows, 0.02, 0.8)).collect()}
    assert found == {r.url for r in rows.where("url is not null").collect() if "//beta." in r.url and "?ref=" in r.url}


def plain_rules(rows, support, confidence):
    """All sets of tokens with their figures; those that are frequent and sure, and not more so without some tokens."""
    n = len(rows)
    sets = {frozenset(c) for tokens, _ in rows for k in range(1, len(tokens) + 1) for c in combinations(sorted(tokens), k)}
    found = {}
    for s in sets:
        held = [bad for tokens, bad in rows if s <= tokens]
        if sum(held) >= support * n and sum(held) / len(held) >= confidence:
            found[s] = (sum(held) / len(held), sum(held) / n)
    return {s: f for s, f in found.items() if not any(o < s and found[o][0] >= f[0] for o in found)}


@pytest.mark.parametrize("seed, support, confidence", [(1, 0.05, 0.5), (2, 0.1, 0.3), (3, 0.01, 0.8)])
def test_mined_rules_and_matches_are_those_of_a_plain_miner(spark, seed, support, confidence):
    pick = random.Random(seed)
    urls = [f"http://{pick.choice('ab')}.{pick.choice(['x', 'y'])}/{pick.choice(['en', 'es', 'fr'])}/{pick.choice(['p', 'q'])}{pick.choice(['', '?k=1', '#f'])}" for _ in range(160)]
    rows = [(u, ("es" in u and "a." in u) or pick.random() < 0.25) for u in urls]
    df = spark.createDataFrame(rows, "url string, bad boolean")
    tokens = {r.url: frozenset(r.t) for r in df.select("url", url_rules.url_tokens(F.col("url")).alias("t")).distinct().collect()}
    plain = plain_rules([(tokens[u], bad) for u, bad in rows], support, confidence)
    got = mined_rules(df, support, confidence).collect()
    # tokens that always stand together are named together: such a rule holds the same rows as the plain one without some of them
    rows_of = lambda s: frozenset(u for u in tokens if s <= tokens[u])
    assert {(rows_of(frozenset(r.rule)), round(r.confidence, 9), round(r.support, 9)) for r in got} == {(rows_of(s), round(c, 9), round(p, 9)) for s, (c, p) in plain.items()}
    hit = {r.url: r.confidence for r in matched(df.select("url"), mined_rules(df, support, confidence)).collect()}
    assert hit.keys() == {u for u in tokens if any(s <= tokens[u] for s in plain)}
    assert all(abs(c - max(f[0] for s, f in plain.items() if s <= tokens[u])) < 1e-9 for u, c in hit.items())


def test_many_tokens_are_mined_in_seconds(spark):
    long = "https://" + ".".join(f"h{chr(97 + k)}" for k in range(20)) + "/" + "/".join(f"p{chr(97 + k)}" for k in range(20))
    rows = spark.createDataFrame([(long, True)] * 1000 + [(f"http://ok.org/{k}", False) for k in range(1000)], "url string, bad boolean")
    rules = mined_rules(rows).collect()
    assert [(len(r.rule), r.confidence) for r in rules] == [(41, 1.0)]
    assert matched(rows.select("url"), mined_rules(rows)).count() == 1


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_rules_are_mined_from_the_tables_and_change_verdicts(spark, sf):
    folder = f"/root/testdata/{sf}"
    labelled = queries._labelled_urls(spark, folder)
    rules = mined_rules(labelled).collect()
    assert rules and all(r.confidence >= url_rules.CONFIDENCE for r in rules)
    got = queries.op2_url_filters(spark, folder)
    assert got.where("rule is null and verdict = 'block'").count() > 0 < got.where("rule is null and verdict = 'allow'").count()


def test_mined_rules_judge_what_no_rule_fits(spark):
    rows = labelled_urls(spark)
    pages = rows.select(F.monotonically_increasing_id().alias("page_id"), "url")
    got = filter_urls(pages, rows, RULES_OF_URLS, support=0.02, confidence=0.8).collect()
    assert {r.verdict for r in got if r.host == "beta.site.org" and r.mined} == {"block"}
    assert all(r.verdict == "allow" for r in got if not r.mined)


def test_licences(spark, nothing):
    mit = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), "
           "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
           "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n"
           "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.")
    rows = {
        1: ("Text. Licensed under the Apache License, Version 2.0. More", None), 2: (mit, ("MIT", True, "mitgrant;mitnotice;")),
        3: ("released UNDER the  mit-license!\nAll rights reserved.", ("MIT,all-rights-reserved", False, "mit;reserved;")),
        4: ("a licence to kill", None), 5: (None, None), 6: ("", None),
        7: ("See the License for the specific language governing permissions and limitations under the License.", ("", False, "apache2see;")),
        8: ("Licensed under CC BY-NC 4.0.\nx\nLicensed under CC BY-NC 4.0.", ("CC-BY-NC-4.0", False, "ccbync4;ccbync4;")),
    }
    rows[1] = (rows[1][0].replace("2.0. More", "2.0.\nMore"), ("Apache-2.0", True, "apache2;"))
    docs = spark.createDataFrame([(k, v[0], "s") for k, v in rows.items()] + [(None, rows[1][0], "s"), (3, rows[3][0], "s")], "doc_id long, text string, sentences string")
    want = Counter((k, *v[1]) for k, v in rows.items() if v[1]) + Counter([(None, *rows[1][1]), (3, *rows[3][1])])
    assert Counter(map(tuple, scan(docs).collect())) == want
    assert scan(nothing).count() == 0


APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software."""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution."""
NAMES = """

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission."""
GPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version."""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/."""
CC = """This work is licensed under a Creative Commons
Attribution 4.0 International License."""
ORIGINALS = [
    (APACHE, "Apache-2.0", "apache2;apache2comply;apache2copy;apache2asis;apache2see;"), (MIT, "MIT", "mitgrant;mitnotice;"),
    (BSD, "BSD-2-Clause", "bsdgrant;bsdsource;bsdbinary;"), (BSD + NAMES, "BSD-3-Clause", "bsdgrant;bsdsource;bsdbinary;bsdnames;"),
    (BSD.replace("1.", "*").replace("2.", "*"), "BSD-2-Clause", "bsdgrant;bsdsource;bsdbinary;"),
    (GPL, "GPL-3.0", "gpl3;"), (GPL.replace("version 3", "version 2"), "GPL-2.0", "gpl2;"), (MPL, "MPL-2.0", "mpl2;"), (CC, "CC-BY-4.0", "ccby4;"),
]


def test_licences_wrapped_and_on_one_line(spark):
    forms = [lambda t: t, lambda t: " ".join(t.split()), lambda t: t.replace("\n", "\r\n"), lambda t: "\n".join(f" * {x}" for x in t.split("\n")),
             lambda t: "\n\n".join(" ".join(p.split()) for p in t.split("\n\n")), lambda t: f"Copyright 2020 Someone\n{t}\nMore text"]
    rows = [(k, name, ids, form(text)) for text, name, ids in ORIGINALS for k, form in enumerate(forms)]
    docs = spark.createDataFrame([(k, row[3]) for k, row in enumerate(rows)], "doc_id long, text string")
    got = {r.doc_id: (r.licences, r.sentences) for r in scan(docs).collect()}
    assert [(rows[k][:3], got.get(k)) for k in range(len(rows)) if got.get(k) != rows[k][1:3]] == []
    apart = spark.createDataFrame([(1, "Released into\n\nthe public domain"), (2, "Released into the. Public domain")], "doc_id long, text string")
    assert scan(apart).count() == 0


def test_licence_sentences_with_odd_gaps(spark):
    known = list((SENTENCES | JOINED).items())
    gaps = ["\t", "-", "  ", " , ", "\n", "\r\n\t", " — ", "\n# "]
    rows = [(text.upper().replace(" ", gap) + ".", ids + ";") for text, ids in known for gap in gaps]
    docs = spark.createDataFrame([(k, text) for k, (text, _) in enumerate(rows)], "doc_id long, text string")
    got = {r.doc_id: r.sentences for r in scan(docs).collect()}
    assert [(row, got.get(k)) for k, row in enumerate(rows) if got.get(k) != row[1]] == []


def test_every_licence_identifier_is_read_by_a_rule():
    for identifier in set(SENTENCES.values()):
        assert any(re.search(rf"\b{identifier};", pattern) for pattern, _, _ in RULES)


def test_pipeline_is_its_stages(spark):
    import corpus_pipeline

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    ids = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, folder)
        rows = docs.collect()
        ids[name] = Counter(r.doc_id for r in rows)
        assert name == corpus_pipeline.STAGES[-1][0] or docs.columns == before.columns
        docs = spark.createDataFrame(rows, docs.schema)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert all(not brute.quality(texts[k])[-1] for k in ids["quality_rules"])
    assert set(ids["near_duplicates"]) == {k for k, _, _, kept in brute.components([(k, texts[k]) for k in ids["quality_rules"]]) if kept}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    leaked = {k for k, _ in brute.leaks([(k, texts[k]) for k in ids["near_duplicates"]], items)}
    assert leaked and set(ids["decontamination"]) == set(ids["near_duplicates"]) - leaked
    assert set(ids["source_mixing"]) <= set(ids["decontamination"]) and max(ids["source_mixing"].values()) <= 2
    assert ids["token_output"] == ids["source_mixing"]
    assert sorted(map(tuple, corpus_pipeline.run(spark, folder).collect())) == sorted(map(tuple, rows))


def test_pipeline_on_empty_tables(spark, tmp_path):
    import corpus_pipeline

    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_pipeline_with_nulls_ties_and_odd_columns(spark, tmp_path):
    import corpus_pipeline

    clean = [f"A clean sentence number {k} about gardens, rivers and the quiet work of people who mend old boats in winter." for k in range(6)]
    rows = [(k, clean[k], None, "x") for k in range(5)] + [(None, clean[5], "web", "y"), (None, None, "web", "z"), (7, None, None, None), (8, "", "web", None), (3, clean[3], None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, `key` string").withColumn("lang", F.lit("en")).withColumn("n_chars", F.length("text"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    passed = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        passed = stage(spark, passed, str(tmp_path))
        assert passed.columns == docs.columns
    kept = Counter((r.doc_id, r.text, r.key) for r in passed.collect())
    assert {k for k in kept} <= {(a, b, d) for a, b, _, d in rows if b} and max(kept.values()) <= 2 and len(kept) >= 3
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter(r.doc_id for r in out) == Counter({k: sum(n for (i, _, _), n in kept.items() if i == k) for k in {i for i, _, _ in kept}})
