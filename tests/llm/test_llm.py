"""The training-data operators: SQL or brute force on whole small tables, and defined cases."""

import base64
import collections
import hashlib
import itertools
import math
import os
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
needs_tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
NAMES = (
    "op1_quality_rules op2_warc op3_license_scan op4_exact_dedup op5_bpe op6_substring_dedup "
    "op7_suffix_dedup op8_mix_sources op9_quality_classifier op10_near_dedup pipeline"
).split()

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept int, _id string"


@pytest.fixture(scope="module")
def docs(spark):
    """Nulls in every column, empty and long texts, repeated rows, ties, clashing extra columns."""
    random.seed(5)
    words = ["the", "of", "Straße", "and,", "run.", "naïve", "42", "x", "漢字", "is"]
    body = [" ".join(random.choices(words, k=n)) + "." for n in (3, 60, 200, 200, 4000)]
    rows = [(i, t) for i, t in enumerate(body)]
    rows += [(10, body[1]), (11, body[1]), (11, body[1]), (11, body[2]), (12, None), (13, ""), (14, " \n\t")]
    rows += [(15, body[2] + " tail " + body[3]), (16, "one two"), (None, body[1]), (None, None)]
    rows += [(17, "x" * 5000), (18, "ab " * 700), (19, "a | b | c\n" * 30), (20, body[3] + " end")]
    sources = itertools.cycle(["s1", None, "s2", "s1"])
    return spark.createDataFrame(
        [(i, t, "en", next(sources), None if t is None else len(t), 1, "y") for i, t in rows], SCHEMA
    )


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def pairs(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def counted(rows):
    return collections.Counter(tuple(r) for r in rows)


def sha(data):
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def table(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@needs_tables
def test_all_queries_are_registered():
    assert set(NAMES) <= set(entry_points.queries())


# 1


def test_quality_figures(docs, none):
    from tillwork.llm.quality_rules import judge_documents, keep_clean

    for row in judge_documents(docs).collect():
        text = row.text or ""
        words = text.encode().split()
        windows = collections.Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
        inside = {
            j for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)
        }
        lines = [x for x in text.split("\n") if x.encode().split()]
        assert row.n_words == len(words)
        assert row.word_chars == sum(len(w.decode()) for w in words)
        assert row.n_symbols == sum(text.count(c) for c in "#*$%&|<>")
        assert row.n_dup_lines == len(lines) - len(set(lines))
        assert row.n_repeat_words == len(inside)
        assert row.base_failed == (len(words) < 10 or 100 * len(inside) > 20 * len(words))
    assert keep_clean(docs).columns == docs.columns
    assert judge_documents(none).count() == keep_clean(none).count() == 0


def test_failing_lines_go_and_lossy_documents_too(spark):
    from tillwork.llm.quality_rules import keep_clean

    prose = "\n".join(f"Sentence w{i}a has w{i}b and w{i}c with w{i}d." for i in range(8))
    rows = [
        (1, prose),
        (2, prose + "\nHome | About | Contact"),
        (3, prose + "\nWe use a cookie policy."),
        (4, "\n".join(f"Menu{i} | Link{i} | Item{i} | More{i}" for i in range(8))),
        (5, "\n".join(f"WOW!! BUY!! NUMBER!! {i}!!" for i in range(8))),
    ]
    kept = {r.doc_id: r.text for r in keep_clean(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert kept == {1: prose, 2: prose, 3: prose}


# 2


def test_archives_round_trip(spark, tmp_path):
    from tillwork.llm.warc import base32_sha1, read_records, write_archives

    rows = [(3, "u3", "same"), (1, "u\n1", "same"), (2, None, None), (4, "u4", ""), (None, "u5", "same"),
            (5, "u6", "é" * 40000), (1, "u\n1", "same")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload", F.lit(1))
    folder = str(tmp_path / "warc")
    index = write_archives(pages, folder)
    records = read_records(index, folder).collect()
    got = counted((r.page_id, r.record_type, r.refers_to, r.payload_digest) for r in records)
    d = base32_sha1
    assert got == collections.Counter(
        [(1, "response", None, d(b"same"))] * 2
        + [(3, "revisit", 1, d(b"same")), (None, "revisit", 1, d(b"same"))]
        + [(2, "response", None, d(b"")), (4, "revisit", 2, d(b""))]
        + [(5, "response", None, d(("é" * 40000).encode()))]
    )
    one = read_records(index.where("page_id = 5"), folder).collect()
    assert [bytes(r.payload) for r in one] == [("é" * 40000).encode()]
    least = read_records(write_archives(pages, str(tmp_path / "b"), least_bytes=5), str(tmp_path / "b"))
    assert {r.record_type for r in least.collect()} == {"response"}
    assert write_archives(pages.limit(0), str(tmp_path / "c")).count() == 0


# 3


@needs_tables
def test_license_scan_finds_the_templates(spark):
    from tillwork.llm.license_scan import TEMPLATES

    texts = dict(pairs(table(spark)))
    for row in entry_points.queries()["op3_license_scan"](spark, SF_DIR).collect():
        assert set(row.licenses) == {name for name, wording in TEMPLATES if wording in texts[row.doc_id]}


def test_license_wording(docs, none):
    from tillwork.llm.license_scan import identify, scan, scan_licenses

    assert identify("This is released under the MIT License.")[0] == "MIT"
    assert identify("Licensed under the Apache License, Version 2.0.")[0] == "Apache-2.0"
    assert identify("Licensed under the Apache License, Version 1.1.") is None
    assert identify("Her driving license is old.") is None
    assert [f["license"] for f in scan("Hi.\nAll rights reserved. Licensed under CC BY-NC 4.0.")] == [
        "proprietary", "CC-BY-NC-4.0",
    ]
    assert scan(None) == scan("") == []
    assert scan_licenses(docs).count() == docs.count()
    assert scan_licenses(none).count() == 0


def test_license_lead_ins():
    from tillwork.llm.license_scan import TEMPLATES, identify

    for name, wording in TEMPLATES:
        if wording.startswith("Licensed under"):
            for lead in ("This work is l", "This program is l", "The text is hereby l", "L"):
                assert identify(lead + wording[1:])[0] == name


BSD_TEXT = (
    "Copyright (c) 2020, Ann. Redistribution and use in source and binary forms, with or without modification, are "
    "permitted provided that the following conditions are met:\n\n1. Redistributions of source code must retain the "
    "above copyright notice, this list of conditions and the following disclaimer.\n2. Redistributions in binary form "
    "must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution.\n"
)
THIRD = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission.\n"
)


@pytest.mark.parametrize(
    "text, licenses",
    [
        (BSD_TEXT, {"BSD-2-Clause"}),
        (BSD_TEXT + THIRD, {"BSD-3-Clause"}),
        ("This is not licensed under the MIT License.", set()),
        ("It isn't licensed under the MIT License.", set()),
        ("It is no longer released under the MIT License.", set()),
        ("We did not ask. Licensed under the MIT License.", {"MIT"}),
        ("It is licensed under the MIT License, not licensed under CC BY 4.0.", {"MIT"}),
        ("// SPDX-License-Identifier: MIT\nint x;", {"MIT"}),
        ("# SPDX-License-Identifier: Apache-2.0", {"Apache-2.0"}),
        ("# SPDX-License-Identifier: Apache-9.0", set()),
        ("# SPDX-License-Identifier: MITRE", set()),
        ("Licensed under a Creative Commons Attribution 4.0 International License.", {"CC-BY-4.0"}),
        ("Licensed under a Creative Commons Attribution 2.0 International License.", set()),
        ("This is free and unencumbered software released into the public domain.", {"Unlicense"}),
        ("This is costly software, not in the public domain.", set()),
        ("Distributed under the Boost Software License, Version 1.0.", {"BSL-1.0"}),
        ("Distributed under the Boost Software License, Version 2.0.", set()),
    ],
)
def test_license_near_misses(text, licenses):
    from tillwork.llm.license_scan import scan

    assert {f["license"] for f in scan(text)} - {None} == licenses


def test_license_versions_are_told_apart():
    from tillwork.llm.license_scan import TEMPLATES, scan

    for name, wording in TEMPLATES:
        for changed in (wording, wording.replace("either ", "").replace("a Creative", "Creative")):
            assert [f["license"] for f in scan(f"Some text.\n{changed}\nMore.") if f["license"]] == [name]
        other = re.sub(r"\d", "7", wording)
        if other != wording:
            assert not [f for f in scan(other) if f["license"]]


def test_license_wrapped():
    from tillwork.llm.license_scan import TEMPLATES, scan

    for name, wording in TEMPLATES:
        for end in ("\n", "\r\n", "\n# ", "\n * "):
            for width in (1, 3, 7, 40):
                split = wording.split()
                lines = [" ".join(split[i : i + width]) for i in range(0, len(split), width)]
                (found,) = scan(f"Some words.\n{end.join(lines)}\nAnd others.")
                assert (found["license"], found["differences"]) == (name, [])
                assert found["block"] == end.join(lines).strip()
    # Every block has a cue, and ends of sentences are words that differ.
    assert [f["license"] for f in scan("All rights. Reserved seats.\nNo license.\nNone.")] == [None]


def test_license_in_long_lines():
    from tillwork.llm.license_scan import TEMPLATES, scan

    rng = random.Random(3)
    for name, wording in TEMPLATES:
        (alone,) = scan(wording.upper())
        assert alone["license"] == name
        for n in (10, 100, 3000):
            around = [f"{rng.choice('abcdef')}{rng.randrange(999)}x" for _ in range(n)]
            line = " ".join(around[: n // 2]) + f" {wording.rstrip('.')} " + " ".join(around[n // 2 :])
            (found,) = scan(line)
            assert (found["license"], found["reduction"]) == (name, alone["reduction"])
            assert found["differences"] == [f"+{w}" for w in around]


def test_license_several_in_a_block():
    from tillwork.llm import license_scan
    from tillwork.llm.license_scan import TEMPLATES, scan

    dual = "Licensed under the MIT License or licensed under the Apache License, Version 2.0, at your option."
    assert [f["license"] for f in scan(dual)] == ["MIT", "Apache-2.0"]
    assert [f[0] for f in license_scan.identified(dual)] == ["MIT", "Apache-2.0"]
    assert [f["differences"] for f in scan(dual)] == [["+or"], ["+at", "+your", "+option"]]
    every = ", ".join(wording.rstrip(".") for _, wording in TEMPLATES)
    assert [f["license"] for f in scan(every)] == [name for name, _ in TEMPLATES]
    # One winner for one stretch, though the wordings of its relatives are near.
    lesser = "This work is licensed under the GNU Lesser General Public License, version 3"
    assert [f["license"] for f in scan(f"{lesser}; {lesser}")] == ["LGPL-3.0"] * 2
    many = scan("All rights reserved, " * 20_000)
    assert len(many) == 20_000 and sum(len(f["block"]) for f in many) < 420_000


def test_license_pattern_lets_wrapped_notices_through(spark):
    from tillwork.llm.license_scan import TEMPLATES, scan_licenses

    rows = [(name, "\n * ".join(wording.split()).upper()) for name, wording in TEMPLATES]
    for row in scan_licenses(spark.createDataFrame(rows, "name string, text string")).collect():
        assert [f.license for f in row.licenses] == [row.name]


def test_license_compression_ranks_before_wording(monkeypatch):
    from tillwork.llm import license_scan
    from tillwork.llm.license_scan import TEMPLATES, ranked, reductions, scan, words

    # One word in another place: fewer words differ from GPL-3.0, but the block tells more of AGPL-3.0.
    moved = "This work is licensed under the GNU General Affero Public License, version 3"
    by_rank = [TEMPLATES[i][0] for i in ranked(" ".join(words(moved)))]
    assert by_rank[0] == "AGPL-3.0"
    for around in ("{}", "A lesser library.\n{}\nMore.", "Lesser General Public License? {}, or so."):
        assert [f["license"] for f in scan(around.format(moved)) if f["license"]] == ["AGPL-3.0"]
    # Every candidate is compressed with every template, and only then aligned with all, in order of rank.
    steps, compress, align = [], license_scan.reductions, license_scan._confirmed
    monkeypatch.setattr(license_scan, "reductions", lambda block: steps.append(block) or compress(block))
    monkeypatch.setattr(license_scan, "_confirmed", lambda i, *block: steps.append(i) or align(i, *block))
    block = "her driving license is old"
    order = ranked(block)
    del steps[:]
    assert [f["license"] for f in scan("Her driving license is old.")] == [None]
    assert steps == [block, *order] and len(reductions(block)) == len(order) == len(TEMPLATES)


def test_license_far_from_its_cue():
    from tillwork.llm.license_scan import scan

    # A long line is taken in blocks; a notice without a cue of its own counts in a sentence that has one.
    notice = "You may not use this file except in compliance with the terms"
    for n in range(0, 400, 7):
        line = "license " + "word " * n + notice + " word" * (399 - n)
        assert [f["license"] for f in scan(line)] == ["Apache-2.0"]


def test_license_notices_match_brute_force():
    from tillwork.llm.license_scan import LEAST_ALIKE, TEMPLATES, notices, words

    def price(a, b):
        rows = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, j in itertools.product(range(len(a) + 1), range(len(b) + 1)):
            ways = [rows[i - 1][j] + (100 if a[i - 1][0].isdigit() else 1)] if i else []
            ways += [rows[i][j - 1] + (100 if b[j - 1][0].isdigit() else 1)] if j else []
            ways += [rows[i - 1][j - 1]] if i and j and a[i - 1] == b[j - 1] else []
            rows[i][j] = min(ways, default=0)
        return rows[-1][-1]

    rng = random.Random(8)
    wordings = [words(w) for _, w in TEMPLATES]
    other = ["x", "the", "license", "under", "2", "4.0", "."]
    for turn in range(60):
        tokens = list(wordings[turn % len(wordings)])
        for _ in range(rng.randrange(5)):
            place = rng.randrange(len(tokens) + 1)
            tokens[place : place + rng.randrange(2)] = rng.choices(other, k=rng.randrange(2))
        tokens = rng.choices(other, k=3) + tokens + rng.choices(other, k=3)
        best = min(
            (
                (price(w, tokens[s:e]), -i)
                for i, w in enumerate(wordings)
                for s, e in itertools.combinations(range(len(tokens) + 1), 2)
                if abs(e - s - len(w)) <= (1 - LEAST_ALIKE) * len(w)
                and price(w, tokens[s:e]) <= (1 - LEAST_ALIKE) * len(w)
            ),
            default=None,
        )
        found = notices(tokens)
        assert (min(found)[0] if found else None) == (best[0] if best else None)


# 4


def test_exact_groups(docs, none):
    from tillwork.llm.exact_dedup import copy_groups, drop_copies

    rows = pairs(docs)
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    for keep, best in (("max", max), ("min", min)):
        order = lambda i: (i is not None, i or 0)
        stay = {t: best(ids, key=order) for t, ids in groups.items()}
        got = copy_groups(docs, keep).collect()
        want = [(i, stay[t or ""], len(groups[t or ""]), sha(t or "")) for i, t in rows]
        assert counted((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == counted(want)
        assert sum(r.kept for r in got) == len(groups)
        left = drop_copies(docs, keep)
        assert left.columns == docs.columns
        assert counted(left.select("doc_id", F.coalesce("text", F.lit(""))).collect()) == counted(
            (i, t) for t, i in stay.items()
        )
    assert copy_groups(none).count() == drop_copies(none).count() == 0


def test_runs_are_sorted_and_merged(docs):
    from tillwork.llm.exact_dedup import KEY, _members, merge_runs

    merged = merge_runs(_members(docs, "doc_id", "text"))
    plan = merged._jdf.queryExecution().toString()
    assert "SortAggregate" in plan and "Python" not in plan
    # One exchange for the members, and one in each of two rounds.
    executed = merged._jdf.queryExecution().sparkPlan().toString()
    assert executed.count("SortAggregate") == 4 and merged.columns == [*KEY, "_keep_id", "_size"]


# 5


@pytest.fixture(scope="module")
def vocabulary(spark):
    from tillwork.llm.bpe import public_vocabulary

    pytest.importorskip("public_tokenizers")
    return public_vocabulary(spark)


def reference_encoding():
    tiktoken = pytest.importorskip("tiktoken")
    import public_tokenizers as P

    with open(P.path("byte_bpe_multi_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={}), ranks


def test_encoder_equals_the_library(vocabulary):
    from tillwork.llm.bpe import Encoder, Transducer, read_ranks

    library, ranks = reference_encoding()
    encoder = Encoder(read_ranks(vocabulary.data), vocabulary.pattern)
    random.seed(1)
    letters = "abcdeéüñ  \n\t'st1239.,!?*#\x1c\x85 漢字😀ABCth"
    for n in [*range(60)] * 20:
        text = "".join(random.choices(letters, k=n))
        assert encoder.encode(text).tolist() == library.encode_ordinary(text)
    for text in ("a" * 5000, "thereing" * 900, "".join(random.choices("erinthao", k=20000))):
        assert encoder.encode(text).tolist() == library.encode_ordinary(text)
    transducer = Transducer(ranks)
    for word in ("unbelievable", "straßenbahn", "zzzz", "  \n"):
        data = word.encode()
        ways = [transducer.encode(data) for _ in range(3)]
        assert ways[0] == ways[1] == ways[2] == transducer._follow(data)


def test_chunks_change_nothing(vocabulary, monkeypatch):
    from tillwork.llm import bpe

    library, ranks = reference_encoding()
    monkeypatch.setattr(bpe, "CHUNK_CHARS", 7)
    text = "Some words,  and\n\nothers 12 345 'll don't   x " * 9
    assert bpe.Encoder(ranks, vocabulary.pattern).encode(text).tolist() == library.encode_ordinary(text)


def test_streaming_decoder_waits_for_whole_characters():
    from tillwork.llm.bpe import StreamDecoder

    machine = StreamDecoder({0: b"\xe6", 1: b"\xbc\xa2", 2: b"a", 3: b"\xff"})
    assert machine.feed([2, 0]) == (b"a\xe6", "a")
    assert machine.feed([1, 3, 0]) == (b"\xbc\xa2\xff\xe6", "漢�")
    assert machine.finish() == "�"


def test_token_digests(docs, none, vocabulary):
    from tillwork.llm.bpe import decode_documents, encode_documents, token_digests

    library, _ = reference_encoding()
    want = []
    for i, t in pairs(docs):
        ids = library.encode_ordinary(t or "")
        want.append((i, len(ids), sha(np.array(ids, "<u4").tobytes()), sha(t or ""), len(t or "")))
    assert counted(token_digests(docs, vocabulary).collect()) == counted(want)
    coded = decode_documents(encode_documents(docs, vocabulary), vocabulary)
    assert coded.columns == [*docs.columns, "token_ids", "decoded", "decoded_chars"]
    got = coded.select("doc_id", F.sha2("token_ids", 256), F.sha2("decoded", 256), "decoded_chars")
    assert counted(got.collect()) == counted((i, *rest) for i, _, *rest in want)
    assert token_digests(none, vocabulary).count() == 0


# 6


def test_repeated_words(docs, none):
    from tillwork.llm.substring_dedup import without_repeats

    rows, first = pairs(docs), {}
    for i, t in rows:
        words = (t or "").encode().split()
        for k in range(len(words) - 49 if i is not None else 0):
            run = tuple(words[k : k + 50])
            first[run] = min(first.get(run, i), i)
    want = []
    for i, t in rows:
        words = (t or "").encode().split()
        gone = set()
        for k in range(len(words) - 49 if i is not None else 0):
            if first[tuple(words[k : k + 50])] < i:
                gone.update(range(k, k + 50))
        kept = b" ".join(w for k, w in enumerate(words) if k not in gone).decode()
        want.append((i, len(words), len(gone), kept))
    assert counted(without_repeats(docs).collect()) == counted(want)
    assert without_repeats(none).count() == 0


# 7


@pytest.mark.parametrize("crowd", [4096, 1])
def test_repeated_bytes(spark, docs, none, crowd):
    from tillwork.llm.suffix_dedup import without_repeats

    rows = pairs(docs) + [(100 + i, f"{i} start " + "passage that many documents share " * 8 + f"{i}") for i in range(9)]
    seen = collections.Counter()
    for _, t in rows:
        data = (t or "").encode()
        seen.update(data[k : k + 200] for k in range(len(data) - 199))
    want = []
    for i, t in rows:
        data = (t or "").encode()
        gone = np.zeros(len(data) + 1, int)
        for k in range(len(data) - 199):
            if seen[data[k : k + 200]] > 1:
                gone[k] += 1
                gone[k + 200] -= 1
        gone = np.cumsum(gone)[: len(data)] > 0
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(1 for k in range(len(data)) if gone[k] and (k == 0 or not gone[k - 1]))
        want.append((i, len(data), int(gone.sum()), spans, kept))
    texts = spark.createDataFrame(rows, "doc_id long, text string")
    got = without_repeats(texts, crowd=crowd).collect()
    assert counted((*r[:4], bytes(r[4])) for r in got) == counted(want)
    assert without_repeats(none).count() == 0


def test_maximal_repeats_of_random_strings():
    from tillwork.llm.suffix_dedup import maximal_repeats, suffix_array

    random.seed(3)
    for _ in range(150):
        text = "".join(random.choices("ab", k=random.randint(1, 50)))
        symbols = np.array([*map(ord, text), 999])
        order, shared = suffix_array(symbols, 2)
        before = np.concatenate([[-1], symbols[:-1]])
        got = {(n, tuple(sorted(p.tolist()))) for n, p in maximal_repeats(order, shared, before, 2)}
        places = collections.defaultdict(list)
        for i in range(len(text)):
            for j in range(i + 2, len(text) + 1):
                places[text[i:j]].append(i)
        want = set()
        for part, at in places.items():
            lefts = {text[i - 1] if i else None for i in at}
            rights = {text[i + len(part) : i + len(part) + 1] for i in at}
            if len(at) > 1 and len(lefts) > 1 and len(rights) > 1:
                want.add((len(part), tuple(at)))
        assert got == want


# 8


def test_water_filling_by_rounds(spark):
    from tillwork.llm.mixing import source_targets

    random.seed(2)
    for _ in range(4):
        sizes = {f"={i:02}": random.choice([0, 5, 50, 900, 20000]) for i in range(11)}
        weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sorted(sizes))}
        total, full = 1.5 * sum(sizes.values()), set()
        while True:
            rest = total - sum(2 * sizes[s] for s in full)
            free = sum(w for s, w in weight.items() if s not in full)
            share = {s: rest * w / free for s, w in weight.items() if s not in full} if free else {}
            over = {s for s in share if share[s] > 2 * sizes[s]}
            if not over:
                break
            full |= over
        want = {s: 2 * sizes[s] if s in full else share[s] for s in sizes}
        table_ = spark.createDataFrame([*sizes.items()], "_src string, _source_size long")
        got = {r._src: r._target for r in source_targets(table_).collect()}
        assert got == pytest.approx(want, abs=1e-6)


def test_many_sources_are_ranked_in_ranges(spark):
    from tillwork.llm import mixing

    rng = random.Random(4)
    sizes = {f"={i:05}": rng.choice([0, 5, 50, 900, 20000]) for i in range(3000)} | {"": 77}
    table_ = spark.createDataFrame([*sizes.items()], "_src string, _source_size long")
    targets = mixing.source_targets(table_)
    # No window is over all sources: only ranges are ranked as a whole.
    plan = targets._jdf.queryExecution().analyzed().toString()
    windows = plan.split("windowspecdefinition(")[1:]
    assert windows and all(w.startswith("_part#") for w in windows)
    merged = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranged = mixing.in_ranges(table_, "test-ranges", "_src").groupBy("_part").count().collect()
        apart = {r._src: r._target for r in mixing.source_targets(table_).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", merged)
    assert len(ranged) > 1 and max(r["count"] for r in ranged) < 3001

    names = sorted(sizes, key=lambda s: (s == "", s))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    order = sorted(names, key=lambda s: (2 * sizes[s] / weight[s], s == "", s))
    budget, spent, open_, want = 1.5 * sum(sizes.values()), 0, sum(weight.values()), {}
    for s in order:
        full = 2 * sizes[s] * open_ <= (budget - spent) * weight[s]
        want[s] = float(2 * sizes[s]) if full else None
        spent, open_ = spent + 2 * sizes[s], open_ - weight[s]
    free = budget - sum(t for t in want.values() if t is not None)
    opened = sum(weight[s] for s, t in want.items() if t is None)
    want = {s: free * weight[s] / opened if t is None else t for s, t in want.items()}
    assert 0 < opened < sum(weight.values())
    assert {r._src: r._target for r in targets.collect()} == apart == want


def test_frames_are_counted_without_sorting_the_seeds(spark):
    from tillwork.llm.suffix_dedup import counted_frames

    rng = random.Random(8)
    seeds = [(rng.choice([None, 1, 2]), i, 3 * i, rng.randrange(5), rng.randrange(4), 7 * i) for i in range(500)]
    schema = "_id long, _row long, at long, gram long, frame long, room long"
    frames = counted_frames(spark.createDataFrame(seeds, schema).repartition(5))
    got, known = frames.collect(), {(s[3], s[4], s[1]): s for s in seeds}
    assert {(r.gram, r.frame): r.n for r in got} == collections.Counter(s[3:5] for s in seeds)
    # The place is that of one seed, not put together from several.
    assert all((r._id, r._row, r.at, r.gram, r.frame, r.room) == known[r.gram, r.frame, r._row] for r in got)
    assert "Sort" not in frames._jdf.queryExecution().executedPlan().toString()


def test_words_are_counted_without_an_array_of_them(spark):
    from tillwork.llm.common import word_count, words_of
    from tillwork.llm.mixing import mix_documents

    rng = random.Random(5)
    texts = ["".join(rng.choices(" \t\n\x0b\x0c\r\x1c\x85\u3000abé漢\\", k=rng.randrange(12))) for _ in range(400)]
    rows = list(enumerate([None, "", " ", "\n \n", "a", " a", "a\n", "a  \t b", *texts]))
    docs = spark.createDataFrame([(*row, "s") for row in rows], "doc_id long, text string, source string")
    text = F.col("text")
    assert docs.where(~word_count(text).eqNullSafe(F.size(words_of(text)).cast("long"))).count() == 0
    want = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows}
    mix = mix_documents(docs)
    assert {r.doc_id: r.size for r in mix.select("doc_id", "mix.size").collect()} == want
    assert "split(" not in mix._jdf.queryExecution().analyzed().toString()


def test_mix_meets_its_targets(docs, none):
    from tillwork.llm.mixing import mix_documents, mixed

    rows = mix_documents(docs).select("source", "doc_id", "mix.*").collect()
    assert len(rows) == docs.count()
    by = collections.defaultdict(list)
    for r in rows:
        by[r.source].append(r)
    for mine in by.values():
        largest = max(r.size for r in mine)
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= largest / 2 + 1
        assert all(r.taken == r.copies * r.size <= 2 * r.size for r in mine)
    again = mix_documents(docs).select("source", "doc_id", "mix.*").collect()
    assert counted(rows) == counted(again)
    assert mixed(docs).columns == docs.columns
    assert mixed(docs).count() == sum(r.copies for r in rows)
    assert mix_documents(none).count() == mixed(none).count() == 0


# 9


@needs_tables
def test_classifier_on_held_out_rows(spark):
    sf = SF_DIR.replace("sf0.001", "sf0.01") if os.path.isdir(SF_DIR.replace("sf0.001", "sf0.01")) else SF_DIR
    rows = entry_points.queries()["op9_quality_classifier"](spark, sf).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    known = [r for r in rows if r.held_out and r.doc_id in labels]
    assert sum(r.predicted == labels[r.doc_id] for r in known) >= 0.95 * len(known)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


def test_classifier_cases(spark, docs, none):
    from tillwork.llm.quality_model import AdditiveModel, fitted, measured, scored

    figures = measured(docs)
    no_labels = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in scored(figures, fitted(figures, no_labels)).collect()} == {0.5}
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 1), (17, 0), (19, 0), (4, 1)], "doc_id long, quality int")
    assert scored(figures, fitted(figures, labels)).count() == docs.count()
    assert measured(none).count() == 0
    # Only a pair of features tells these apart.
    rng = np.random.default_rng(1)
    x = rng.random((2000, 16))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = AdditiveModel().fit(x, y)
    assert (0, 1) in model.pair_tables
    assert ((model.score(x) >= 0.5) == y).mean() > 0.9


# 10


def brute_weights(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    width = min(5, len(words))
    runs = [tuple(words[i : i + width]) for i in range(len(words) - width + 1)] if words else []
    return {run: 1 + math.log(n) for run, n in collections.Counter(runs).items()}


def brute_similarity(a, b):
    """The definition, term by term."""
    every = sorted(a.keys() | b.keys())
    x, y = (np.array([s.get(j, 0.0) for j in every]) for s in (a, b))
    return sum(1 / np.maximum(x / a[i], y / b[i]).sum() for i in a.keys() & b.keys())


def brute_classes(rows, least=0.8):
    texts = sorted({t or "" for _, t in rows})
    weights = [brute_weights(t) for t in texts]
    label = list(range(len(texts)))
    for a, b in itertools.combinations(range(len(texts)), 2):
        if label[a] != label[b] and brute_similarity(weights[a], weights[b]) >= least - 1e-9:
            old, new = label[a], label[b]
            label = [new if c == old else c for c in label]
    first = {}
    for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        first.setdefault(label[texts.index(t or "")], i)
    return counted((i, first[label[texts.index(t or "")]]) for i, t in rows)


def test_probability_jaccard():
    from tillwork.llm.near_dedup import probability_jaccard, signatures

    a, b = {1: 2.0, 2: 1.0, 3: 0.5}, {1: 1.0, 2: 3.0, 4: 1.0}
    want = sum(1 / sum(max(a.get(j, 0) / a[i], b.get(j, 0) / b[i]) for j in a | b) for i in (1, 2))
    arrays = [(np.array(sorted(s), np.uint64), np.array([s[k] for k in sorted(s)])) for s in (a, b)]
    assert probability_jaccard(*arrays) == pytest.approx(want)
    m = 4000
    x, y = (signatures(*s, np.zeros(3, np.int64), 1, m)[0] for s in arrays)
    assert (x == y).mean() == pytest.approx(want, abs=0.05)


@pytest.mark.parametrize(
    "block, block_bytes, agreeing", [(2048, 1 << 24, None), (2, 1 << 24, None), (3, 900, None), (2048, 1 << 24, 0)]
)
def test_near_classes(spark, docs, none, monkeypatch, block, block_bytes, agreeing):
    from tillwork.llm import near_dedup

    monkeypatch.setattr(near_dedup, "BLOCK", block)
    monkeypatch.setattr(near_dedup, "BLOCK_BYTES", block_bytes)
    random.seed(9)
    base = [f"w{random.randrange(400)}" for _ in range(120)]
    rows = pairs(docs)
    for i in range(40):
        words = list(base)
        for _ in range(i % 6):
            words[random.randrange(120)] = f"new{random.randrange(10**6)}"
        rows.append((200 + i, " ".join(words)))
    texts = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_dedup.near_classes(texts, agreeing=agreeing).collect()
    assert counted((r.doc_id, r.class_id) for r in got) == brute_classes(rows)
    kept = near_dedup.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len({r.class_id for r in near_dedup.near_classes(docs).collect()} | {0}) + extra(docs)
    assert near_dedup.near_classes(none).count() == near_dedup.keep_one_of_each(none).count() == 0


def test_texts_that_only_share_a_passage_are_not_dealt(spark, monkeypatch):
    from tillwork.llm import near_dedup

    seen = {}

    def spy(name, function):
        def noted(*args):
            rows = function(*args)
            seen[name] = (args[0].count(), rows.count())
            return rows

        monkeypatch.setattr(near_dedup, name, noted)

    spy("_met_in_pairs", near_dedup._met_in_pairs)
    spy("_in_parts", near_dedup._in_parts)
    random.seed(4)
    passage = [f"p{random.randrange(10**6)}" for _ in range(120)]

    def text(own):
        return " ".join(passage + [f"q{random.randrange(10**6)}" for _ in range(own)])

    rows = [(i, text(60)) for i in range(80)]  # half alike
    twin = rows[0][1].split()
    rows.append((90, " ".join([*twin[:-4], "a", "b", "c", "d"])))
    got = near_dedup.near_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert counted((r.doc_id, r.class_id) for r in got) == brute_classes(rows)
    shared, dealt = seen["_met_in_pairs"]
    assert shared > 100 and 0 < dealt <= shared  # sketches, once each
    assert seen["_in_parts"][0] <= 4  # texts


def extra(docs):
    """Classes that share an identifier with another: two texts of one doc_id, or of none."""
    classes = brute_classes(pairs(docs))
    return len(brute_labels(docs)) - len({c for _, c in classes} | {0})


def brute_labels(docs):
    heads = []
    for text in sorted({t or "" for _, t in pairs(docs)}):
        weights = brute_weights(text)
        if not any(brute_similarity(weights, h) >= 0.8 - 1e-9 for h in heads):
            heads.append(weights)
    return heads


# The pipeline


@needs_tables
def test_pipeline_equals_its_stages_by_hand(spark):
    import corpus_pipeline
    from tillwork.llm.mixing import mix_documents

    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "exact_dedup", "near_dedup", "mix_sources", "bpe",
    ]
    documents = table(spark)
    clean = corpus_pipeline.quality_rules(spark, documents, SF_DIR)
    judged = entry_points.queries()["op1_quality_rules"](spark, SF_DIR).where("kept")
    assert clean.columns == documents.columns
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in judged.collect()}
    texts = {}
    for i, t in pairs(clean):
        texts[t] = max(i, texts.get(t, i))
    rows = [(i, t) for t, i in texts.items()]
    stay = {i for i, c in brute_classes(rows) if i == c}
    left = clean.where(F.col("doc_id").isin(*stay))
    library, _ = reference_encoding()
    want = collections.Counter()
    for r in mix_documents(left).select("doc_id", "text", "mix.copies").collect():
        ids = library.encode_ordinary(r.text)
        row = (r.doc_id, len(ids), sha(np.array(ids, "<u4").tobytes()), sha(r.text), len(r.text))
        want[row] += r.copies
    assert counted(corpus_pipeline.run(spark, SF_DIR).collect()) == +want
