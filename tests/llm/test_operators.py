"""Operators against plain Python on small documents with every awkward case."""

import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from granulake.llm import bpe, components, decontamination, jaccard_join, language, language_model, licenses, quality, substring_dedup, suffix_dedup, toxicity

SPREAD = " ".join(f"word{i}" for i in range(120))
TEXTS = {
    0: SPREAD,
    1: "before " + SPREAD + " after",
    2: SPREAD,
    3: None,
    4: "",
    5: " \n\t ",
    6: "%" * 700 + " tail",
    7: "a b c d e f g h " * 30,
    8: "Höhe ñandú " * 40 + "\nLicensed under CC BY-NC 4.0.",
    9: "one",
    10: "one",
    11: " ".join(f"word{i}" for i in range(40, 100)),
    12: "x" * 3000,
    13: "Released under the MIT License. Released under the MIT License.",
    14: " ".join(f"W{i % 7}" for i in range(5000)),
    15: " ".join(f"word{i}" if i != 60 else "other" for i in range(120)),
}
SCHEMA = "doc_id long, text string, lang string, source string, id string, n long, words string"


@pytest.fixture(scope="module")
def docs(spark):
    """Columns with names the operators use themselves."""
    return spark.createDataFrame([(i, t, "en" if i % 2 else None, "s", "clash", 1, "w") for i, t in TEXTS.items()], SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return (text or "").encode().split()


def by_id(df, *columns):
    return {r.doc_id: tuple(r[c] for c in columns) for r in df.collect()}


def test_substring_dedup(docs, none):
    first, expected = {}, {}
    for i in sorted(TEXTS):
        w = words(TEXTS[i])
        for k in range(len(w) - 49):
            first.setdefault(tuple(w[k : k + 50]), i)
    for i, t in TEXTS.items():
        w = words(t)
        gone = {j for k in range(len(w) - 49) if first[tuple(w[k : k + 50])] < i for j in range(k, k + 50)}
        expected[i] = (len(w), b" ".join(x for j, x in enumerate(w) if j not in gone).decode())
    assert by_id(substring_dedup.dedup(docs), "n_words", "kept") == expected
    assert substring_dedup.dedup(none).count() == 0


def test_suffix_dedup(docs, none):
    count = Counter((t or "").encode()[k : k + 200] for t in TEXTS.values() for k in range(len((t or "").encode()) - 199))
    expected = {}
    for i, t in TEXTS.items():
        b = (t or "").encode()
        gone = {j for k in range(len(b) - 199) if count[b[k : k + 200]] > 1 for j in range(k, k + 200)}
        expected[i] = (len(b), bytes(x for j, x in enumerate(b) if j not in gone))
    done = suffix_dedup.cut_repeats(docs)
    assert {r.row.doc_id: (r.n_bytes, bytes(r.kept)) for r in done.collect()} == expected
    left = suffix_dedup.without_repeats(docs)
    assert left.columns == docs.columns and by_id(left, "text")[3] == (None,)
    assert suffix_dedup.without_repeats(none).count() == 0


def test_long_row_after_empty_ones_is_cut_in_the_same_parts(monkeypatch):
    from granulake.llm import repeats

    class Rows:
        def mapInArrow(self, work, schema):  # noqa: N802
            return work

    monkeypatch.setattr(repeats, "PART", 1000)
    draw = np.random.default_rng(2)
    flat = draw.integers(0, 1 << 60, 5200).astype(np.uint64)
    ends, ids = np.array([0, 0, 100, 3400, 3400, 3700, 5200]), np.arange(10, 17)
    work = repeats.run_table(Rows(), lambda batch: [(ids, flat, ends)], 50, 12)
    covered, begin = Counter(), dict(zip(ids.tolist(), [0, *ends[:-1].tolist()], strict=True))
    stop = dict(zip(ids.tolist(), ends.tolist(), strict=True))
    for out in work([None]):
        for id, start, count in zip(*(out.column(n).to_pylist() for n in ("id", "start", "count")), strict=True):
            covered.update((id, start + k) for k in range(count))
            cuts = list(repeats.parts(stop[id] - begin[id], 50))
            assert any(lo <= start and start + count - 1 <= hi - 50 for lo, hi in cuts), (id, start, count)
    assert set(covered.values()) == {1}
    assert len(covered) == sum(max(0, stop[i] - begin[i] - 49) for i in stop)


def test_runs_cut_anywhere_give_the_same_windows():
    draw = np.random.default_rng(1)
    tokens = draw.integers(0, 3, 4000).astype(np.uint64) * np.uint64(suffix_dedup.MIX)
    from granulake.llm import repeats

    ends = np.array([1500, 1510, 4000])
    row, start, count, anchor, whole = repeats.runs_of(tokens, ends, 50, 12)
    covered = Counter((int(r), int(s) + k) for r, s, c in zip(row, start, count, strict=True) for k in range(c))
    assert set(covered.values()) == {1} and len(covered) == (1500 - 49) + (2490 - 49)


def jaccard_expected():
    low = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
    sets, parent = {}, {i: i for i in TEXTS}
    for i, t in TEXTS.items():
        w = words((t or "").encode().translate(low).decode())
        sets[i] = set(zip(w, w[1:], w[2:], strict=False)) if len(w) >= 3 else ({tuple(w)} if w else set())

    def root(i):
        return i if parent[i] == i else root(parent[i])

    for i in TEXTS:
        for j in TEXTS:
            both = len(sets[i] & sets[j])
            if i < j and both and 100 * both >= 90 * len(sets[i] | sets[j]):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    return {i: (len(sets[i]), root(i)) for i in TEXTS}


def test_jaccard_join(docs, none):
    expected = jaccard_expected()
    assert by_id(jaccard_join.joined(docs), "n_shingles", "component_id") == expected
    assert set(by_id(jaccard_join.one_of_each(docs), "n")) == {i for i, (_, c) in expected.items() if i == c}
    assert jaccard_join.joined(none).count() == 0


def test_jaccard_join_of_drifting_copies(spark):
    """A chain of near copies, each linked only with its neighbours, and a star around one text."""
    base = [f"t{i}" for i in range(130)]
    chain = [" ".join([*[f"c{k}" for k in range(i, i + 110)]]) for i in range(0, 40, 4)]
    star = [" ".join([*base[: 10 * i], "new", *base[10 * i + 1 :]]) for i in range(1, 12)]
    rows = [(i, t) for i, t in enumerate([*chain, " ".join(base), *star])]
    found = by_id(jaccard_join.joined(spark.createDataFrame(rows, "doc_id long, text string")), "component_id")
    assert {c for (c,) in found.values()} == {0, len(chain)}


def test_near_copies_of_five_words_and_four_fifths(spark):
    """Brute force at other parameters; the pipeline's stage drops a copy with 20 of 1,000 words changed."""
    import corpus_pipeline

    draw = np.random.default_rng(5)
    base = [f"b{i}" for i in range(1000)]
    texts = [base, [f"new{i}" if i % 50 == 25 else w for i, w in enumerate(base)], base[:850], base[:780]]
    for size in (4, 5, 8, 9, 12, 30, 57, 120, 400):
        words = [f"{size}w{i}" for i in range(size)]
        for cut in (0, 1, 2, 5, 20, 60):
            texts += [words[: max(1, size - cut)], [w if draw.random() > 0.02 * cut else f"x{draw.integers(99)}" for w in words]]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    for n, percent in ((5, 80), (2, 60), (3, 90), (1, 95)):
        sets = [{tuple(t[k : k + n]) for k in range(len(t) - n + 1)} or {tuple(t)} for t in texts]
        group = list(range(len(texts)))
        for i, a in enumerate(sets):
            for j, b in enumerate(sets[:i]):
                if 100 * len(a & b) >= percent * len(a | b):
                    old, new = max(group[i], group[j]), min(group[i], group[j])
                    group = [new if g == old else g for g in group]
        found = by_id(jaccard_join.joined(docs, n=n, percent=percent), "n_shingles", "component_id")
        assert found == {i: (len(s), g) for i, (s, g) in enumerate(zip(sets, group, strict=True))}, (n, percent)
    stays = {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs.where("doc_id < 4"), "").collect()}
    assert stays == {0}  # 3 hangs on 2
    assert {r.doc_id for r in jaccard_join.one_of_each(docs.where("doc_id < 2")).collect()} == {0, 1}


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(20)] + [(30, 31), (32, 31), (40, 40)], "u long, v long")
    found = {r.node: r.component for r in components.components(edges).collect()}
    assert found == {**{i: 0 for i in range(21)}, 30: 30, 31: 30, 32: 30}


def test_bpe_equals_the_library(docs, none):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    expected = {}
    for i, t in TEXTS.items():
        ids = library.encode(t or "", add_special_tokens=False).ids
        expected[i] = (ids, library.decode(ids, skip_special_tokens=False))
    done = bpe.encode_decode(docs, path)
    assert by_id(done, "ids", "decoded") == expected
    assert bpe.encode_decode(none, path).count() == 0
    own = bpe.WordBpe(path)
    for text in ("<|endoftext|>It'll 12½ ΑΣ Σas İx́\x85<|startoftext|><|end", "a" * 5000, "hahaha" * 50):
        assert own.encode_batch([text])[0].as_py() == library.encode(text, add_special_tokens=False).ids


def test_decontamination(docs, none, spark):
    items = spark.createDataFrame([(1, " ".join(f"word{i}" for i in range(20, 50))), (2, "too short"), (3, None), (4, "not there at all in any of them")], "item_id long, text string")
    found = {(r.doc_id, r.item_id): r.n_common for r in decontamination.contaminated(docs, items).collect()}
    assert found == {(0, 1): 26, (1, 1): 26, (2, 1): 26, (15, 1): 26}
    assert set(by_id(decontamination.without_contaminated(docs, items), "n")) == set(TEXTS) - {0, 1, 2, 15}
    assert decontamination.contaminated(none, items).count() == decontamination.contaminated(docs, items.limit(0)).count() == 0


def test_rows_without_id_are_judged_too(spark):
    item = " ".join(f"word{i}" for i in range(30))
    rows = [(None, "before " + item, "en", "h"), (None, "the cat and the dog are there", "en", "h"), (None, "123 %%", "en", "h"), (1, item, "en", "h"), (2, "the cat and the dog", "en", "h")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    items = spark.createDataFrame([(7, item), (None, item + " more"), (None, "not there at all in any of them")], "item_id long, text string")
    found = sorted(((r.doc_id, r.item_id) for r in decontamination.contaminated(docs, items).collect()), key=str)
    assert found == sorted([(None, 7), (None, None), (1, 7), (1, None)], key=str)
    assert {r.text for r in decontamination.without_contaminated(docs, items).collect()} == {rows[1][1], rows[2][1], rows[4][1]}
    kept = language.known_language(docs)
    assert kept.columns == docs.columns and {r.text for r in kept.collect()} == {r[1] for r in rows} - {"123 %%"}


def test_quality_features(docs, none, spark):
    expected = {}
    for i, t in TEXTS.items():
        w = words(t)
        seen = Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
        again = {j for k in range(len(w) - 7) if seen[tuple(w[k : k + 8])] > 1 for j in range(k, k + 8)}
        lines = [x for x in (t or "").split("\n") if words(x)]
        expected[i] = (len(w), sum(len(x.decode()) for x in w), sum((t or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(again))
    found = quality.features(docs)
    assert by_id(found, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words") == expected
    labels = spark.createDataFrame([(0, 1), (0, None)], "doc_id long, quality int")
    assert set(by_id(quality.judged(docs, labels), "kept").values()) == {(True,), (False,)}
    assert quality.judged(none, labels).count() == 0


def test_binomial_tail_and_cutoffs(spark):
    from math import comb

    for k, n, p in ((0, 50, 0.02), (3, 400, 0.02), (12, 400, 0.05)):
        row = spark.range(1).select(quality.at_most(F.lit(k).cast("long"), F.lit(n).cast("long"), p).alias("p")).first()
        assert row.p == pytest.approx(sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1)))
    # 4,000 clean texts and 200 full of symbols: a cutoff between them is safe
    rows = [(i, " ".join(f"w{j + i}" for j in range(30)) if i % 21 else "a# b% c$ " * 9, "en") for i in range(4200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i % 21 > 0)) for i in range(4200)], "doc_id long, quality int")
    measured = quality.features(docs).withColumn("base_failed", F.lit(False))
    assert quality.cutoffs(measured, labels).where("rule = 'symbols_per_word'").count() == 1
    assert quality.cutoffs(measured, labels.where("doc_id < 400")).count() == 0  # too few to be sure


def test_planted_junk_is_rejected_on_a_given_table(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{n}.parquet") for n in ("documents", "labels"))
    found = quality.judged(docs, labels).join(labels, "doc_id").where("stratum <> 'es' and not base_failed").select("doc_id", "kept", "quality", "n_symbols", "n_words")
    rows = {r.doc_id: r for r in found.collect()}
    assert not rows[39].kept  # full of '$$$ %%% ###'
    junk = [r.kept for r in rows.values() if not r.quality and 2 * r.n_symbols > r.n_words]
    good = [r.kept for r in rows.values() if r.quality]
    assert len(junk) > 50 and not any(junk) and np.mean(good) > 0.98


def test_licenses(docs):
    found = by_id(licenses.scan(docs), "verdict")
    assert found[8] == ("CC-BY-NC-4.0",) and found[13] == ("MIT",) and found[3] == found[4] == ("NONE",)


def test_license_rules_in_order(spark):
    text = "\n".join(licenses.SENTENCES[i] + "." for i in ("apache-2-long", "apache-comply", "apache-copy", "gpl-see", "mit-grant"))
    row = licenses.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row.licenses == ["MIT", "Apache-2.0"] and row.verdict == "UNKNOWN"  # a sentence no rule takes


#: As their owners print them; `{}` stands for what begins a line.
LICENSE_TEXTS = {
    "MIT": """Copyright (c) 2020 Somebody

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
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.""",
    "Apache-2.0": """Copyright 2020 Somebody

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.""",
    "BSD-3-Clause": """Copyright (c) 2020, Somebody
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

3. Neither the name of Some Body, Inc. nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT OWNER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES
WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR
ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF
OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
}
GNU = """This {what} is free software{mark} you can redistribute it and/or modify
it under the terms of the GNU {name}General Public License as published by
the Free Software Foundation{then} either version {number} of the License, or
(at your option) any later version.

This {what} is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU {name}General Public License for more details.

You should have received a copy of the GNU {name}General Public License
along with this {what}{end} <https://www.gnu.org/licenses/>."""
for licence, what, name, mark, then, number, end in (
    ("GPL-3.0-or-later", "program", "", ":", ",", "3", ".  If not, see"),
    ("GPL-2.0-or-later", "program", "", ";", ";", "2", "; if not, see"),
    ("LGPL-2.1-or-later", "library", "Lesser ", ";", ";", "2.1", "; if not, see"),
    ("AGPL-3.0-or-later", "program", "Affero ", ":", ",", "3", ".  If not, see"),
):
    LICENSE_TEXTS[licence] = GNU.format(what=what, name=name, mark=mark, then=then, number=number, end=end)


def test_licences_wrapped_on_one_line_and_in_comments(spark):
    rows, expected = [], {}
    for name, text in LICENSE_TEXTS.items():
        lines = text.split("\n")
        narrow = "\n\n".join("\n".join(p.split()[i] if k == 0 else " ".join(p.split()[i : i + 4]) for k, i in enumerate([0, *range(1, len(p.split()), 4)])) for p in text.split("\n\n"))
        forms = [text, text.replace("\n", "\r\n"), " ".join(text.split()), narrow]
        forms += ["\n".join(sign + x for x in lines) for sign in ("// ", "# ", " * ", ";; ", "dnl ", "! ")] + ["/* " + text + " */", "Some prose\n\n" + text + "\n\nmore prose"]
        for form in forms:
            expected[len(rows)] = (name,)
            rows.append((len(rows), form))
    for name, ids in licenses.RULES:
        for joint in (". ", ".\n", "; ", "\n"):
            expected[len(rows)] = (name,)
            rows.append((len(rows), joint.join(licenses.SENTENCES[i] for i in ids) + "."))
    found = by_id(licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")), "verdict")
    wrong = {i: (found[i], expected[i], rows[i][1]) for i in expected if found[i] != expected[i]}
    assert not wrong, list(wrong.values())[:3]


ASF = """Licensed to the Apache Software Foundation (ASF) under one
or more contributor license agreements.  See the NOTICE file
distributed with this work for additional information
regarding copyright ownership.  The ASF licenses this file
to you under the Apache License, Version 2.0 (the
"License"); you may not use this file except in compliance
with the License.  You may obtain a copy of the License at

  http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing,
software distributed under the License is distributed on an
"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY
KIND, either express or implied.  See the License for the
specific language governing permissions and limitations
under the License."""


def test_what_stands_between_licence_sentences_counts(spark):
    mit, bsd = LICENSE_TEXTS["MIT"], LICENSE_TEXTS["BSD-3-Clause"]
    advertising = "4. All advertising materials mentioning features must display an acknowledgement.\n\nTHIS SOFTWARE IS"
    grant, rest = mit.split("\n\nThe above")
    only = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by\nthe Free Software Foundation, version 3."
    cases = [
        (mit.replace("THE SOFTWARE IS", "The Software shall be used for Good, not Evil.\n\nTHE SOFTWARE IS", 1), "UNKNOWN"),
        (bsd.replace("THIS SOFTWARE IS", advertising, 1), "UNKNOWN"),
        (grant + "\n" + "Some prose goes on. " * 50 + "\n\nThe above" + rest, "UNKNOWN"),
        (ASF, "Apache-2.0"),
        ("# " + ASF.replace("\n", "\n# "), "Apache-2.0"),
        (only, "GPL-3.0-only"),
        (only.replace("version 3.", "version 3 of the License."), "GPL-3.0-only"),
        ("// SPDX-License-Identifier: MIT\nint main() {}", "MIT"),
        ("/* SPDX-License-Identifier: GPL-2.0-or-later */", "GPL-2.0-or-later"),
        ("SPDX-License-Identifier: Apache-2.0\nCopyright 2020 Somebody\n\n" + mit, "MIT AND Apache-2.0"),
        (mit + "\n\nOther prose.\n\n" + LICENSE_TEXTS["ISC"], "ISC AND MIT"),
        (None, "NONE"),
        ("", "NONE"),
        ("prose " * 100_000, "NONE"),
        (mit, "MIT"),
        (mit, "MIT"),
    ]
    docs = spark.createDataFrame([(i, t, "x") for i, (t, _) in enumerate(cases)], "doc_id long, text string, sequence string")
    found = {r.doc_id: r.verdict for r in licenses.scan(docs).collect()}
    assert [found[i] for i in range(len(cases))] == [verdict for _, verdict in cases]
    assert licenses.scan(docs.limit(0)).count() == 0


def test_language(spark):
    rows = [(i, t, lang, "h") for i, (t, lang) in enumerate([("the cat and the dog are there", "en"), ("der hund und die katze sind da", "de")] * 20)]
    rows += [(100, None, "en", None), (101, "123 %%", "de", "h"), (102, "und die katze", None, "h")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    found = by_id(language.of_documents(docs), "lang", "kept")
    assert found[0] == ("en", True) and found[1] == ("de", True) and found[102] == ("de", True)
    assert found[100] == ("und", False) and found[101] == ("und", False)
    assert language.of_documents(docs.limit(0)).count() == 0


@pytest.mark.parametrize("most", [language_model.KNOWN, 30, 0])
def test_language_model(docs, none, monkeypatch, most):
    """With all words sent to the tasks, some, and none."""
    import math

    monkeypatch.setattr(language_model, "KNOWN", most)
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in TEXTS}
    tokens = {i: [*(t or "").encode().lower().split(), None] for i, t in TEXTS.items()}
    counts = Counter(x for i, w in tokens.items() if not held[i] for x in w)
    total, kinds = sum(counts.values()), len(counts)
    found = by_id(language_model.score(docs), "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
    for i, w in tokens.items():
        base = sum(math.log10((counts[x] + 1) / (total + kinds + 1)) for x in w)
        assert found[i][:4] == (held[i], len(w), sum(counts[x] > 0 for x in w), total)
        assert found[i][4] == pytest.approx(base) and found[i][5] < 0
    assert language_model.score(none).count() == 0


def test_class_probabilities_are_normalised():
    pairs = np.random.default_rng(0).integers(0, 50, (30, 30)).astype(float)
    assert (10 ** language_model.train(pairs)).sum(axis=1) == pytest.approx(np.ones(30))


def test_toxicity(spark):
    insults = ["moron", "idiot", "scumbag"]
    rows = [(i, f"the word{i % 40} of page{i % 30} is here. a {insults[i % 3] if i % 4 == 0 else 'table'} stood by the door{i}", "en") for i in range(400)]
    rows += [(1000, "what an id-iot he is", "en"), (1001, None, "en"), (1002, "", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)], "doc_id long, toxic int")
    found = by_id(toxicity.score(docs, labels), "held_out", "predicted", "score")
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert held and all(found[i][0] for i in held)
    assert np.mean([found[i][1] == (i % 4 == 0) for i in held]) > 0.95
    assert found[1000][2] > found[1001][2] == found[1002][2]
    assert toxicity.score(docs.limit(0), labels).count() == 0
    assert toxicity.score(docs, labels.limit(0)).count() == len(rows)


def test_toxicity_of_gapped_split_and_repeated_insults(spark):
    """Also ties, repeated rows, long texts, null ids and labels, and columns with names of the operator's own."""
    draw = np.random.default_rng(3)
    parts = ["ta", "lo", "mi", "ren", "so", "ka", "ve", "dun"]

    def sentence(*more):
        words = ["".join(draw.choice(parts, draw.integers(1, 4))) for _ in range(8)]
        words[3:3] = more
        return " ".join(words) + ". "

    insults = ["worthless", "moron", "pathetic", "scum"]
    rows = [(i, "".join(sentence(*[insults[i % 4]] * (i % 3 == 0 and k == 2)) for k in range(6))) for i in range(600)]
    forms = ["worth-less", "w o r t h l e s s", "worxthless", "wor thless", "W0RTHLESS", "pathe.tic", "p a t h e t i c", "mor on", "mooron"]
    rows += [(1000 + i, sentence() + sentence(form) + sentence()) for i, form in enumerate(forms)]
    clean = [sentence() + sentence() + sentence() for _ in range(9)]
    rows += [(2000 + i, t) for i, t in enumerate(clean)] + [(3000, clean[0] * 3000 + sentence("moron") * 3), (None, clean[0]), (None, clean[0]), (4000, rows[0][1])]
    docs = spark.createDataFrame([(i, t, 0.5, "s", 1, 2) for i, t in rows], "doc_id long, text string, score double, first string, toxic int, number int")
    labels = [(i, int(i % 3 == 0)) for i in range(600)] + [(1, None), (None, 1), (3, 1), (3, 0), (9999, 1)]
    result = toxicity.score(docs.repartition(4), spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert result.columns[:4] == ["doc_id", "held_out", "score", "predicted"] and result.count() == len(rows)
    found = {r.doc_id: r for r in result.collect()}
    assert [found[1000 + i].predicted for i in range(len(forms))] == [1] * len(forms), [found[1000 + i].score for i in range(len(forms))]
    assert sum(found[2000 + i].predicted for i in range(9)) <= 1
    assert found[3000].predicted == 1 and found[None].score == found[2000].score and found[4000].score == found[0].score
    held = [i for i in range(600) if found[i].held_out]
    assert np.mean([found[i].predicted == (i % 3 == 0) for i in held]) > 0.95


def test_worst_stretches_by_brute_force():
    items = [" idiot ", " a ", " an old idi ot here and x ", "  "]
    landmarks = toxicity.Landmarks(["idiot", "old"])
    table = landmarks.table(np.array([1.0, -0.25]))
    stretches = toxicity.Stretches(items)
    highest, at = stretches.worst(table)
    kernels = stretches.kernels(at, landmarks)
    assert kernels @ np.array([1.0, -0.25]) == pytest.approx(highest, abs=1e-5)
    for item, start, value in zip(items, stretches.starts, highest, strict=True):
        codes = toxicity.letter_codes(item + toxicity.APART)
        sums = []
        for first in range(len(codes)):
            total = 0.0
            for i in range(first, min(first + toxicity.WINDOW, len(codes))):
                for j in range(i + 1, i + toxicity.SPAN - 1):
                    for k in range(j + 1, i + toxicity.SPAN):
                        if k < len(codes) and codes[i] and codes[j] and codes[k]:
                            total += toxicity.DECAY ** (k - i + 1) * table[codes[i] << 12 | codes[j] << 6 | codes[k]]
            sums.append(total)
        assert max(sums) == pytest.approx(value, abs=1e-5) and start >= 0
    assert landmarks.decays[:, 0] @ landmarks.decays[:, 0] * (1 / (landmarks.decays[:, 0] ** 2).sum()) == pytest.approx(1)


def test_queries_and_sql(spark):
    from granulake.llm.oracles import oracle_sql
    from granulake.llm.queries import queries
    from oracle_check import difference

    assert {int(n.split("_")[0][2:]) for n in queries() if n.startswith("op")} == set(range(1, 14))
    for name, sql in oracle_sql().items():
        assert difference(spark, "/root/testdata/sf0.001", name, queries()[name], sql) in (None, "no rows"), name


def test_pipeline(spark):
    import corpus_pipeline

    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    texts = {r.doc_id: r.n_tokens for r in rows}
    assert len(texts) == len(rows) and 100 < len(rows) <= 200


def test_a_jaccard_join_hands_wide_rows_to_python_in_small_batches(spark, monkeypatch):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before, seen, plain = spark.conf.get(name), {}, jaccard_join.saved

    def saved(df, label):
        seen[label] = spark.conf.get(name)
        return plain(df, label)

    monkeypatch.setattr(jaccard_join, "saved", saved)
    words = [f"w{i}" for i in range(60)]
    docs = spark.createDataFrame([(i, " ".join([*words, f"x{i}"])) for i in range(3)], "doc_id long, text string")
    assert [r.component_id for r in jaccard_join.joined(docs).collect()] == [0, 0, 0]
    assert {"set-chunks", "shared-lists", "sets", "pivot-distances"} <= set(seen) and set(seen.values()) == {"4m"}
    assert spark.conf.get(name) == before


def test_texts_are_handed_to_python_in_small_batches_and_once(spark, monkeypatch):
    from granulake.llm import repeats

    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before, seen = spark.conf.get(name), {}
    for module in (repeats, language):
        def saved(df, label, plain=module.saved):
            seen[label] = spark.conf.get(name)
            return plain(df, label)

        monkeypatch.setattr(module, "saved", saved)
    shared = "".join(chr(97 + i * i % 23) for i in range(300))
    docs = spark.createDataFrame([(i, shared + str(i), "en", "h") for i in range(2)], "doc_id long, text string, lang string, source string")
    done = suffix_dedup.cut_repeats(docs)
    assert [(r.n_bytes, bytes(r.kept)) for r in done.orderBy("row.doc_id").collect()] == [(301, b"0"), (301, b"1")]
    below = done._jdf.queryExecution().analyzed().toString().split("MapInArrow")[1].split("\n", 1)[1]
    assert below.lstrip(" +-:").startswith("Union") and "Project [row#" in below.split("\n")[1]
    language.of_documents(docs).collect()
    assert {seen[label] for label in ("runs", "blocks", "windows", "text-evidence")} == {"4m"}
    assert spark.conf.get(name) == before


def test_only_texts_with_repeats_are_shuffled(spark, monkeypatch):
    from granulake.llm import repeats

    plans, plain = {}, repeats.saved

    def saved(df, label):
        plans[label] = df._jdf.queryExecution().optimizedPlan().toString()
        return plain(df, label)

    monkeypatch.setattr(repeats, "saved", saved)
    shared = "".join(chr(97 + i * i % 23) for i in range(300))
    docs = spark.createDataFrame([(0, shared + "x"), (1, shared + "y"), (2, "z" * 100), (3, None)], "doc_id long, text string")
    done = suffix_dedup.cut_repeats(docs)
    plan = done._jdf.queryExecution().optimizedPlan().toString()
    assert "bits" in plans["texts-asked"] and "bits" in plan and "Union" in plan
    left = suffix_dedup.without_repeats(docs).orderBy("doc_id").collect()
    assert [r.text for r in left] == ["x", "y", "z" * 100, None]


def test_bpe_holds_a_trie_for_some_words_at_a_time(monkeypatch):
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    text = " ".join(f"word{i} was{i * 7 % 11}ing" for i in range(40))
    whole, own, sizes = bpe.WordBpe(path).encode_batch([text]).to_pylist(), bpe.WordBpe(path), []
    monkeypatch.setattr(bpe, "TRIE_WORDS", 5)
    learn = own._learn
    monkeypatch.setattr(own, "_learn", lambda words: (sizes.append(len(words)), learn(words)))
    assert own.encode_batch([text]).to_pylist() == whole
    assert len(sizes) > 1 and max(sizes) == 5


def test_sets_meet_once_under_a_pivot_however_many_lists_they_share(spark, monkeypatch):
    import random

    from granulake.llm import jaccard_join

    draw, texts = random.Random(5), []
    for family in range(3):
        base = [f"w{family}_{i}" for i in range(200)]
        for _ in range(14):
            own = list(base)
            for place in draw.sample(range(200), draw.randrange(2, 14)):
                own[place] = f"x{draw.random()}"
            texts.append(" ".join(own))
    tables, saved = {}, jaccard_join.saved

    def noted(df, label):
        tables[label] = saved(df, label)
        return tables[label]

    monkeypatch.setattr(jaccard_join, "saved", noted)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in jaccard_join.joined(docs, n=5, percent=80).collect()}

    grams = [{tuple(t.split()[i : i + 5]) for i in range(196)} for t in texts]
    want = list(range(len(texts)))
    for _ in texts:
        for a in range(len(texts)):
            for b in range(a):
                if 100 * len(grams[a] & grams[b]) >= 80 * len(grams[a] | grams[b]):
                    want[a] = want[b] = min(want[a], want[b])
    assert found == dict(enumerate(want))
    placed = tables["placed"]
    assert tables["lists"].count() > placed.count() > 0
    assert placed.count() == placed.select("pivot", "key").distinct().count()


def test_shared_codes_of_a_bucket_take_time_in_proportion_to_the_codes():
    import time

    import numpy as np
    import pyarrow as pa

    from granulake.llm.jaccard_join import met_elsewhere

    def bucket(sent):
        codes = pa.array([np.array(own, dtype=np.uint32).tobytes() for own in sent], pa.binary())
        return pa.table({"chunk": list(range(len(sent))), "bucket": [7] * len(sent), "codes": codes})

    few = [[1, 5, 9], [2, 5], [], [9]]
    bits = [np.unpackbits(np.frombuffer(b, dtype=np.uint8), count=len(own)).tolist() for b, own in zip(met_elsewhere(bucket(few)).column("bits").to_pylist(), few)]
    assert bits == [[0, 1, 1], [0, 1], [], [1]]

    # every code is sent by two chunks
    many = bucket([np.arange(1000) + 1000 * (chunk // 2) for chunk in range(1600)])
    start = time.process_time()
    np.unique(np.concatenate([np.frombuffer(c, dtype=np.uint32) for c in many.column("codes").to_pylist()]), return_inverse=True)
    least = time.process_time() - start
    start = time.process_time()
    met_elsewhere(many)
    assert time.process_time() - start < 5 * least + 1


def test_copies_let_through_by_the_bit_map_make_no_more_pairs(spark, monkeypatch):
    from granulake.llm import jaccard_join

    tables, saved = {}, jaccard_join.saved

    def noted(df, label):
        tables[label] = saved(df, label)
        return tables[label]

    monkeypatch.setattr(jaccard_join, "saved", noted)
    monkeypatch.setattr(jaccard_join, "likely", lambda docs, wanted: docs)
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join([*words, f"x{i // 4}"]) for i in range(12)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.component_id for r in jaccard_join.joined(docs).collect()} == {0}
    assert tables["sets"].count() > tables["sets"].select("key").distinct().count()
    for name in ("pivot-distances", "placed"):
        assert tables[name].count() == tables[name].distinct().count() > 0


def test_sets_of_a_pivot_meet_in_cells_of_bounded_size(spark, monkeypatch):
    import random

    from granulake.llm import jaccard_join

    draw, texts, plans, saved = random.Random(8), [], {}, jaccard_join.saved

    def noted(df, label):
        plans[label] = df._jdf.queryExecution().analyzed().toString()
        return saved(df, label)

    base = [f"w{i}" for i in range(120)]
    for kind in range(20):
        own = list(base)
        for place in draw.sample(range(120), 4 + kind % 3):
            own[place] = f"x{kind}_{place}"
        texts += [" ".join(own), " ".join([*own, f"y{kind}"])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    monkeypatch.setattr(jaccard_join, "saved", noted)
    monkeypatch.setattr(jaccard_join, "CELL_ROWS", 3, raising=False)
    monkeypatch.setattr(jaccard_join, "BIN_ROWS", 20, raising=False)
    found = {r.doc_id: r.component_id for r in jaccard_join.joined(docs).collect()}
    assert "FlatMapGroupsInArrow" in plans["pairs-left"]

    grams = [{tuple(t.split()[i : i + 3]) for i in range(len(t.split()) - 2)} for t in texts]
    want = list(range(len(texts)))
    for _ in texts:
        for a in range(len(texts)):
            for b in range(a):
                if 100 * len(grams[a] & grams[b]) >= 90 * len(grams[a] | grams[b]):
                    want[a] = want[b] = min(want[a], want[b])
    assert found == dict(enumerate(want))


def test_pairs_that_no_bound_holds_apart_by_brute_force():
    import random

    import numpy as np
    import pyarrow as pa

    from granulake.llm.jaccard_join import WORDS, bit_map, most_apart, undecided

    draw, rows, want = random.Random(3), [], set()
    sets = []
    for key in range(40):
        grams = np.unique(np.array([draw.getrandbits(64) if draw.random() < 0.04 else i * 7919 << 20 for i in range(100 + key % 3)], dtype=np.uint64))
        apart = draw.choice([None, draw.randrange(30)])
        sets.append((key, len(grams), apart, apart is not None and apart < 10, draw.choice([0, key]), bit_map(grams)))
    for x in sets:
        for y in sets:
            limit = int(most_apart(np.array([x[1] + y[1]]), 90)[0])
            bits = sum(((a ^ b) & ((1 << 64) - 1)).bit_count() for a, b in zip(x[5], y[5]))
            known = x[2] is not None and y[2] is not None
            if x[0] < y[0] and x[4] != y[4] and not (x[3] and y[3]) and 100 * min(x[1], y[1]) >= 90 * max(x[1], y[1]):
                if bits <= limit and (not known or abs(x[2] - y[2]) <= limit):
                    want.add((x[0], y[0], known and x[2] + y[2] <= limit))
    for slots in (1, 4):
        rows = [(5, x[0] % slots, other, *x) for x in sets for other in range(slots)]
        names = ["pivot", "slot", "other", "key", "n", "apart", "linked", "group", "bits"]
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.list_(pa.int64(), -1)]
        table = pa.table({name: pa.array(c, kind) for name, c, kind in zip(names, zip(*rows), kinds)})
        found = undecided(table, 90).to_pylist()
        assert len(found) == len(want) > 20 and {(r["a"], r["b"], r["sure"]) for r in found} == want
    assert len(sets[0][5]) == WORDS
